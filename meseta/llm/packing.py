"""Packing documents into sequences of a fixed length by cutting-stock column generation.

Documents longer than a sequence give up whole sequences first, and a rest of more
than half a sequence gives up a half: two rests over a half never share a sequence,
so leaving them whole would pad a tenth of all tokens. The histogram of piece lengths goes through a
linear program over patterns of lengths; the rounded patterns are handed to the
pieces by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meseta.llm.common import arrow_map, stage
from meseta.llm.cutting_stock import plan
from meseta.llm.registry import query, table
from meseta.llm.tokens import default_vocabulary, encoder

GRAIN = 4
"""Lengths are planned in steps of this many tokens. Pieces of one length go in bundles of
as many, which fit the steps exactly, where a sequence holds more of them so; that is most
lengths under 64. Another piece is padded by less than a step."""
SALTS = 256
"""Ranks within a length are counted in this many parts at least, so that a length that a
third of all pieces share is spread over many tasks."""
PER_SALT = 100_000
"""Pieces of a length in one part, about; a length with more has more parts."""


def pieces(
    docs: DataFrame, length: int = 2048, end_id: int = 1, vocabulary: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc, start, n, crc, doc_tokens: ids of each text with ``end_id``, cut into sequences, a half and a rest."""
    path = vocabulary or default_vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        encode = encoder(path).ids
        rows: list[tuple] = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.array([*(encode(text) if text else ()), end_id], "<u4")
            cuts = [*range(0, len(ids), length), len(ids)]
            if cuts[-1] - cuts[-2] > length // 2:
                cuts.insert(-1, cuts[-2] + length // 2)
            for start, end in zip(cuts, cuts[1:]):
                part = ids[start:end]
                rows.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
        yield dict(zip(("doc", "start", "n", "crc", "doc_tokens"), zip(*rows)))

    return arrow_map(
        docs.select(id_col, text_col), cut, f"doc {kind}, start long, n long, crc long, doc_tokens long")


def place(
    cut: DataFrame, length: int = 2048, grain: int = GRAIN, salts: int = SALTS,
) -> DataFrame:
    """``cut`` with sequence_id and offset.

    Rows that repeat doc and start are pieces of their own.
    """
    spark = cut.sparkSession
    units = length // grain
    bundles = [n for n in range(1, units + 1) if units // n * grain > units // -(-n // grain)]
    # the length of pieces that are bundled, minus the steps of others
    kind = F.when(F.col("n").isin(bundles), F.col("n")).otherwise(-F.least(F.ceil(F.col("n") / grain), F.lit(units))).cast("int")
    cut = stage(cut.withColumn("kind", kind), "pieces")
    histogram = {  # at most as many rows as a sequence has tokens
        row["kind"]: row["n"] for row in cut.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    salts = max([salts, *(-(-n // PER_SALT) for n in histogram.values())])
    counts: dict[int, int] = {}
    kinds = []  # kind, how many of its ranks are bundled, width and first item of the bundles, and of the others
    for which, n in sorted(histogram.items()):
        bundled = n - n % grain if which > 0 else 0
        alone = -which if which < 0 else -(-which // grain)
        first_bundle = counts.get(which, 0) if bundled else 0
        if bundled:
            counts[which] = first_bundle + bundled // grain
        first_alone = counts.get(alone, 0)
        if n > bundled:
            counts[alone] = first_alone + n - bundled
        kinds.append((which, bundled, which, first_bundle, alone, first_alone))
    table_of_kinds = spark.createDataFrame(
        kinds, "kind int, bundled long, bundle_width int, first_bundle long, alone_width int, first_alone long")
    full = counts.pop(units, 0)
    widths = sorted(counts)
    patterns = plan(widths, [counts[w] for w in widths], units)
    if full:
        patterns.append(({units: 1}, full))

    # slots: pieces of a width with ranks from first on fill the sequences of one pattern
    slots, taken, sequence = [], dict.fromkeys([*counts, units], 0), 0
    for pattern, times in patterns:
        place_in = 0
        for width, each in sorted(pattern.items(), reverse=True):
            slots.append((width, taken[width], taken[width] + each * times, each, sequence, place_in))
            taken[width] += each * times
            place_in += each
        sequence += times
    table_of_slots = spark.createDataFrame(
        slots, "width int, first long, beyond long, each long, sequence long, place long")

    # rank within a kind: count by salt, then add what earlier salts hold
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc", "start", "crc"), F.lit(salts)))
    before = Window.partitionBy("kind").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("kind", "salt").agg(F.count("*").alias("here")).select(
        "kind", "salt", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("kind", "salt").orderBy("doc", "start", "crc")) - 1
    of_kind = F.col("before") + F.col("within")
    in_bundle = of_kind < F.col("bundled")
    # kinds and slots are a few per width and pattern: bounded by the sequence length
    ranked = salted.withColumn("within", within).join(offsets, ["kind", "salt"]).join(
        F.broadcast(table_of_kinds), "kind").select(
        "doc", "start", "n", "crc", "doc_tokens",
        F.when(in_bundle, F.col("bundle_width")).otherwise(F.col("alone_width")).alias("units"),
        F.when(in_bundle, F.col("first_bundle") + F.floor(of_kind / grain)).otherwise(
            F.col("first_alone") + of_kind - F.col("bundled")).alias("rank"),
        F.when(in_bundle, of_kind % grain).otherwise(0).alias("of_bundle"))
    own = (F.col("units") == F.col("width")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("beyond"))
    placed = ranked.join(F.broadcast(table_of_slots), own).select(
        "doc", "start", "n", "crc", "doc_tokens",
        (F.col("sequence") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))).alias("sequence_id"),
        (F.col("place") + (F.col("rank") - F.col("first")) % F.col("each")).alias("place"), "of_bundle")
    in_order = Window.partitionBy("sequence_id").orderBy("place", "of_bundle").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("n").over(in_order), F.lit(0)))


def pack(
    docs: DataFrame, length: int = 2048, end_id: int = 1, vocabulary: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text counts as empty and packs its end id alone.
    """
    return place(pieces(docs, length, end_id, vocabulary, id_col, text_col), length).select(
        F.col("doc").alias(id_col), "start", F.col("n").alias("length"), F.col("crc").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")


def sequences(
    docs: DataFrame, placed: DataFrame, end_id: int = 1, vocabulary: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """sequence_id and input_ids, by encoding the texts once more; ids of ``docs`` must be unique."""
    path = vocabulary or default_vocabulary()
    kind = docs.schema[id_col].dataType.simpleString()

    def encode(batch: pa.RecordBatch) -> Iterator[dict]:
        ids_of = encoder(path).ids
        ids = [[*(ids_of(text) if text else ()), end_id] for text in batch.column(1).to_pylist()]
        yield {"doc": batch.column(0), "ids": ids}

    encoded = arrow_map(docs.select(id_col, text_col), encode, f"doc {kind}, ids array<int>")
    parts = placed.withColumnRenamed(id_col, "doc").join(encoded, "doc").select(
        "sequence_id", "offset", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids"))
    return parts.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("input_ids"))


@query("op3_packing")
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))
