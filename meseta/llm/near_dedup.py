"""MinHash near-deduplication: banding, signature verification, exact confirmation, components.

Documents with one set of shingles are one class from the start, so exact copies cost
one row. Classes that share a band are candidates. First every class is compared with
the least class of each of its bands, which joins most groups; then, in the bands whose
members are still in different components, those outside the largest are compared with
all others in blocks.
No list of all pairs of a group is ever made, and no group is cut short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meseta.llm.common import arrow_map, arrow_stream, free_name, slices, sorted_groups, stage, utf8
from meseta.llm.components import components
from meseta.llm.registry import query, table
from meseta.llm.shingles import shingle_hashes, shingle_set, word_hashes

BANDS, ROWS = 32, 4
"""A pair at the threshold of 0.75 shares no band with probability (1 - 0.75^4)^32 = 5e-6."""
AGREE = 72
"""Equal minima of 128 that a candidate needs; a pair at the threshold has fewer with probability 5e-7."""
BLOCK = 512
"""Members of a band compared in one step."""


def _functions(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-add functions, strongly universal in their upper bits."""
    draw = np.random.default_rng(20_05)
    return (draw.integers(0, 2 ** 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1),
            draw.integers(0, 2 ** 63, bands * rows, np.uint64))


def _minima(hashes: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """16 bits of each minimum, by document and function."""
    found = np.empty((len(starts), bands * rows), np.uint16)
    for k, (a, b) in enumerate(zip(*_functions(bands, rows))):
        found[:, k] = (np.minimum.reduceat(hashes * a + b, starts) >> np.uint64(16)).astype(np.uint16)
    return found


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc, sum, n_shingles, class (hash of the whole set, null for no shingles), minima (binary).

    ``sum`` is a 64-bit checksum of the text; with the id it finds the row again.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def sign(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column("body").to_pylist()
        for first, end in slices(np.array([len(text) for text in texts]), 400_000):
            hashes = [shingle_hashes(word_hashes(text)) for text in texts[first:end]]
            sets = [np.unique(h) for h in hashes]
            filled = [k for k, s in enumerate(sets) if len(s)]
            minima: list[bytes | None] = [None] * len(sets)
            if filled:
                sizes = np.array([len(sets[k]) for k in filled])
                found = _minima(np.concatenate([sets[k] for k in filled]), np.cumsum(sizes) - sizes, bands, rows)
                for k, row in zip(filled, found):
                    minima[k] = row.tobytes()
            yield {
                "doc": batch.column("doc").slice(first, end - first),
                "sum": batch.column("sum").slice(first, end - first), "n_shingles": [len(s) for s in sets],
                "class": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], "minima": minima}

    return arrow_map(
        docs.select(F.col(id_col).alias("doc"), F.xxhash64(utf8(text_col)).alias("sum"), utf8(text_col).alias("body")),
        sign, f"doc {kind}, sum long, n_shingles long, class binary, minima binary")


def _agreeing(a: pa.Array, b: pa.Array, width: int) -> np.ndarray:
    def matrix(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, width)

    return (matrix(a) == matrix(b)).sum(axis=1)


def star_pairs(members: DataFrame, classes: DataFrame, agree: int, width: int) -> DataFrame:
    """u, v, agree: members of bands with the least class of the band, if the minima agree enough."""
    pairs = members.where("class <> least").select(F.col("class").alias("u"), F.col("least").alias("v")).distinct()
    minima = classes.select("class", "minima")
    both = pairs.join(minima.select(F.col("class").alias("u"), F.col("minima").alias("m")), "u").join(
        minima.select(F.col("class").alias("v"), F.col("minima").alias("w")), "v")

    def compare(batch: pa.RecordBatch) -> Iterator[dict]:
        equal = _agreeing(batch.column("m"), batch.column("w"), width)
        keep = pa.array(equal >= agree)
        yield {"u": batch.column("u").filter(keep), "v": batch.column("v").filter(keep), "agree": equal[equal >= agree]}

    return arrow_map(both, compare, "u binary, v binary, agree int")


def block_edges(
    members: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, agree: int, width: int,
    rows_of_band: int, block: int,
) -> DataFrame:
    """u, v: links between components that share a band; enough of them to join what is linked.

    In every band, members outside its largest component ask all others. Both sides are
    dealt into blocks, and a pair of blocks is compared inside a task on minima and then
    on whole sets. Only links that join two components leave the task, so a group has
    fewer rows out than in; a group holds about two blocks, whatever the band holds.
    """
    labelled = stage(members.where("n > 2").join(
        labels.select(F.col("node").alias("class"), "label"), "class", "left").select(
        "band", "bucket", "class", F.coalesce("label", "class").alias("label")), "labelled")
    parts = labelled.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    bands = stage(parts.groupBy("bucket").agg(
        F.max_by("label", F.struct("size", "label")).alias("largest"), F.max("size").alias("most"),
        F.sum("size").alias("n")).where("n > most"), "open-bands")
    askers = F.ceil((F.col("n") - F.col("most")) / block)
    blocks = F.ceil(F.col("n") / block)
    known = labelled.join(bands, "bucket")

    def all_of(count):
        return F.explode(F.sequence(F.lit(0), count - 1))

    own = F.xxhash64("class")
    asked = known.select(
        "band", "bucket", "class", "label", F.lit(False).alias("asks"), F.pmod(own, blocks).alias("t"), all_of(askers).alias("q"))
    asking = known.where("label <> largest").select(
        "band", "bucket", "class", "label", F.lit(True).alias("asks"), F.pmod(own, askers).alias("q"), all_of(blocks).alias("t"))
    rows = asked.unionByName(asking).join(classes.select("class", "minima"), "class").join(sets, "class")
    rows = rows.repartition("bucket", "t", "q").sortWithinPartitions("bucket", "t", "q")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        us, vs = [], []
        for group in sorted_groups(batches, ["bucket", "t", "q"]):
            asks = np.array(group.column("asks").to_pylist(), bool)
            names = group.column("class").to_pylist()
            code = np.unique(np.array(group.column("label").to_pylist(), object), return_inverse=True)[1]
            if code.max() == 0 or not asks.any():
                continue
            minima = np.frombuffer(b"".join(group.column("minima").to_pylist()), np.uint16).reshape(-1, width)
            found = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
            others = np.flatnonzero(~asks)
            band = group.column("band")[0].as_py()
            for k in np.flatnonzero(asks):
                near = others[code[others] != code[k]]
                equal = minima[near] == minima[k]
                # a pair is compared in the first band it shares, not in every one
                first = equal.reshape(len(near), width // rows_of_band, rows_of_band).all(axis=2).argmax(axis=1)
                near = near[(equal.sum(axis=1) >= agree) & (first == band)]
                if not len(near):
                    continue
                sizes = np.array([len(found[h]) for h in near])
                values = np.concatenate([found[h] for h in near])
                at = np.minimum(np.searchsorted(found[k], values), len(found[k]) - 1)
                owner = np.repeat(np.arange(len(near)), sizes)
                common = np.bincount(owner[found[k][at] == values], minlength=len(near))
                for h in near[100 * common >= percent * (sizes + len(found[k]) - common)]:
                    if code[h] != code[k]:
                        us.append(min(names[k], names[h]))
                        vs.append(max(names[k], names[h]))
                        code[code == code[h]] = code[k]
            if len(us) > 50_000:
                yield {"u": us, "v": vs}
                us, vs = [], []
        yield {"u": us, "v": vs}

    return arrow_stream(rows, compare, "u binary, v binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """u, v of the pairs with 100 * intersection >= percent * union of their whole sets."""
    both = pairs.select("u", "v").join(sets.select(F.col("class").alias("u"), F.col("shingles").alias("s")), "u").join(
        sets.select(F.col("class").alias("v"), F.col("shingles").alias("t")), "v")

    def verify(batch: pa.RecordBatch) -> Iterator[dict]:
        keep = []
        for s, t in zip(batch.column("s"), batch.column("t")):
            a, b = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * common >= percent * (len(a) + len(b) - common))
        keep = pa.array(keep, pa.bool_())
        yield {"u": batch.column("u").filter(keep), "v": batch.column("v").filter(keep)}

    return arrow_map(both, verify, "u binary, v binary")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """class, shingles of the wanted (doc, sum, class) rows, from the texts once more."""
    def build(batch: pa.RecordBatch) -> Iterator[dict]:
        sets = [shingle_set(text).tobytes() for text in batch.column("body").to_pylist()]
        names = [xxhash.xxh3_128_digest(s) if s else None for s in sets]
        keep = [k for k, (name, own) in enumerate(zip(names, batch.column("class").to_pylist())) if name == own]
        yield {"class": [names[k] for k in keep], "shingles": [sets[k] for k in keep]}

    texts = docs.select(
        F.col(id_col).alias("doc"), F.xxhash64(utf8(text_col)).alias("sum"), utf8(text_col).alias("body"))
    same = texts["doc"].eqNullSafe(wanted["doc"]) & (texts["sum"] == wanted["sum"])
    found = texts.join(wanted, same).select("body", "class")
    return arrow_map(found, build, "class binary, shingles binary")


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
    bands: int = BANDS, rows: int = ROWS, agree: int = AGREE, block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_shingles, component_id, kept, text_sum.

    Null and empty texts have no shingles and are linked with nothing, so each is its
    own component. ``component_id`` is the smallest id of the component; rows that
    share an id are documents of their own, and null ids never win.
    """
    width = bands * rows
    signed = stage(signatures(docs, id_col, text_col, bands, rows), "signatures")
    classes = stage(
        signed.where("class IS NOT NULL").groupBy("class").agg(
            F.min("doc").alias("doc"), F.min(F.struct("doc", "sum")).alias("one"), F.first("minima").alias("minima")),
        "classes")
    keys = F.array(*[
        F.xxhash64(F.lit(band), F.substring("minima", 2 * rows * band + 1, 2 * rows)) for band in range(bands)])
    banded = classes.select("class", F.posexplode(keys).alias("band", "bucket"))
    shared = stage(
        banded.groupBy("bucket").agg(F.min("class").alias("least"), F.count("*").alias("n")).where("n > 1"), "shared")
    members = stage(banded.join(shared, "bucket"), "members")

    first = stage(star_pairs(members, classes, agree, width), "star-pairs")
    sets = stage(_sets(
        docs, classes.join(members.select("class").distinct(), "class").select("one.doc", "one.sum", "class"),
        id_col, text_col,
    ).dropDuplicates(["class"]), "sets")
    # one partner each is enough to join most of a group; the rest follow only where they still matter
    best = first.groupBy("u").agg(F.max(F.struct("agree", "v")).alias("best")).select("u", F.col("best.v").alias("v"))
    edges = stage(confirmed(best, sets, percent), "edges")
    labels = stage(components(edges), "labels")
    # star pairs that weren't tried first still matter where their ends are apart
    rest = first.join(best, ["u", "v"], "left_anti")
    a = labels.select(F.col("node").alias("u"), F.col("label").alias("label_u"))
    b = labels.select(F.col("node").alias("v"), F.col("label").alias("label_v"))
    apart = rest.join(a, "u", "left").join(b, "v", "left").where(
        F.coalesce("label_u", "u") != F.coalesce("label_v", "v"))
    late = stage(confirmed(apart, sets, percent).unionByName(
        block_edges(members, labels, classes, sets, percent, agree, width, rows, block)).distinct(), "late-edges")
    if not late.isEmpty():
        labels = stage(components(edges.unionByName(late)), "labels")
    named = classes.select("class", "doc").join(
        labels.select(F.col("node").alias("class"), "label"), "class", "left").select(
        "class", "doc", F.coalesce("label", "class").alias("label"))
    named = stage(named, "named")
    least = stage(named.groupBy("label").agg(F.min("doc").alias("component")), "least")
    of_class = stage(named.join(least, "label").select("class", "component"), "component-of")
    found = signed.where("class IS NOT NULL").join(of_class, "class").select("doc", "sum", "n_shingles", "component")
    alone = signed.where("class IS NULL").select(
        "doc", "sum", "n_shingles", F.col("doc").alias("component"))
    return found.unionByName(alone).select(
        F.col("doc").alias(id_col), "n_shingles", F.col("component").alias("component_id"),
        F.col("doc").eqNullSafe(F.col("component")).alias("kept"), F.col("sum").alias("text_sum"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents whose id names their component, with all their columns.

    Should documents of one component share that id, the one with the least checksum
    stays; repeated rows come out once.
    """
    result = near_dedup(docs, id_col, text_col, **options)
    key = free_name(docs, "__key")
    stays = result.where("kept").groupBy(F.col(id_col).alias("id"), (F.col("n_shingles") == 0).alias("bare")).agg(
        F.min("text_sum").alias("sum"), F.count("*").alias("n")).drop("bare")
    stays = stage(stays, "stays")

    def staying(which: DataFrame) -> DataFrame:
        keyed = docs.withColumn(key, F.xxhash64(utf8(text_col)))
        same = keyed[id_col].eqNullSafe(which["id"]) & (keyed[key] == which["sum"])
        return keyed.join(which, same, "left_semi")

    kept, several = staying(stays.where("n = 1")), stays.where("n > 1")
    if not several.isEmpty():
        kept = kept.unionByName(staying(several).dropDuplicates([id_col, key]))
    return kept.drop(key)


@query("op8_near_dedup")
def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup(table(spark, folder, "documents")).drop("text_sum")
