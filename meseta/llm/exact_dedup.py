"""Exact deduplication against a persistent digest index.

The index is a table of one row per distinct text, bucketed and sorted by the
text's SHA-256. A batch is reduced to one row per digest, compared with the index
by a sort-merge anti join that leaves the index where it lies, and what is new is
appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from meseta.llm.common import free_name, stage
from meseta.llm.registry import query, table
from meseta.session import scratch_path


def with_digest(docs: DataFrame, text_col: str = "text", out: str = "__digest") -> DataFrame:
    """``docs`` and ``out``: SHA-256 of the text with A-Z lower-cased, as UTF-8.

    A null text counts as empty. ``bytes.lower`` changes A-Z only, so no other
    character is touched.
    """
    schema = StructType([*docs.schema.fields, StructField(out, BinaryType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            digests = [hashlib.sha256((text or "").encode().lower()).digest() for text in texts]
            yield batch.append_column(out, pa.array(digests, pa.binary()))

    return docs.mapInArrow(digest, schema)


class DigestIndex:
    """Digests seen so far, in ``buckets`` buckets below ``path``.

    The files outlive the session: opening the same path again continues the index. A
    text keeps the id it entered with: of equal texts in one batch that is the largest,
    and later batches don't change it.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, id_type: str = "BIGINT"):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{hashlib.md5(path.encode()).hexdigest()}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, firsts: DataFrame) -> DataFrame:
        """Rows of ``firsts`` (digest, keep_id) whose digest the index lacks."""
        # Both sides have the bucket layout: the index is read bucket by bucket and not shuffled.
        laid_out = firsts.repartition(self.buckets, "digest")
        return laid_out.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, digests: DataFrame, id_col: str = "doc_id") -> None:
        """Append the digests of a batch that are new; of equal texts the largest id stays.

        Rows of one digest are combined before the shuffle, so a text that fills a
        third of the batch arrives as one row per task.
        """
        firsts = digests.groupBy("digest").agg(F.max(id_col).alias("keep_id"))
        fresh = stage(self.unseen(firsts), "fresh")  # an insert can't read the table it writes
        # by bucket number, so that one task writes each bucket and an append adds one file to it at most
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        fresh.repartition(self.buckets, bucket).sortWithinPartitions("digest").write.insertInto(self.name)


def exact_dedup(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: ``id_col``, keep_id, group_size, kept, text_sha256, n_rows.

    The documents enter the index in two batches, larger ids first; the second meets
    the first through the anti join. Rows repeating both id and text are one
    document: they count in group_size and come out once. A null id loses against
    any other; a text held only by rows with null ids keeps that row. With an index that
    holds earlier batches, a text known from them is not kept here, and group_size counts
    the rows of this batch.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"))
    digests = stage(
        with_digest(rows, "body").groupBy("doc", F.col("__digest").alias("digest")).agg(F.count("*").alias("n")),
        "digests")
    low, high = digests.agg(F.min("doc"), F.max("doc")).first()
    # ids without a middle, such as strings, enter in one batch
    middle = F.lit((low + high) // 2 if isinstance(low, int) else None)
    later = F.coalesce(F.col("doc") <= middle, F.lit(True))
    index.add(digests.where(~later), "doc")
    index.add(digests.where(later), "doc")
    sizes = digests.groupBy("digest").agg(F.sum("n").alias("group_size"))
    classes = stage(sizes.join(index.rows(), "digest"), "classes")
    # Both sides are shuffled here, so adaptive execution splits the digest of a large group.
    return digests.join(classes, "digest").select(
        F.col("doc").alias(id_col), "keep_id", "group_size",
        F.col("doc").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), F.col("n").alias("n_rows"))


def drop_copies(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; repeated rows come out once."""
    digest = free_name(docs, "__digest")
    stays = stage(
        exact_dedup(docs, index, id_col, text_col).where("kept")
        .select(F.col(id_col).alias("id"), F.unhex("text_sha256").alias("sha"), "n_rows"), "stays")

    def staying(which: DataFrame) -> DataFrame:
        keyed = with_digest(docs, text_col, digest)
        same = keyed[id_col].eqNullSafe(which["id"]) & (keyed[digest] == which["sha"])
        return keyed.join(which, same, "left_semi")

    kept, repeated = staying(stays.where("n_rows = 1")), stays.where("n_rows > 1")
    if not repeated.isEmpty():
        kept = kept.unionByName(staying(repeated).dropDuplicates([id_col, digest]))
    return kept.drop(digest)


@query("op1_exact_dedup", sql="""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)""")
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = DigestIndex(spark, scratch_path(spark, "digest-index"))
    return exact_dedup(table(spark, folder, "documents"), index).drop("n_rows")
