"""Suffix-array deduplication: removal of long byte strings that occur more than once.

Texts are sampled at anchors that equal windows share. The corpus-wide suffix array
is built over the anchors only, in parts: suffixes that start with one gram lie
together. What is told apart or settled by hashes of whole contexts never reaches it;
the rest forms groups whose enhanced suffix array yields the maximal repeats with all
their occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meseta.llm.anchors import SEGMENT, Anchors, anchors, distinct
from meseta.llm.common import arrow_map, arrow_stream, slices, sorted_groups, stage, utf8
from meseta.llm.interval_tree import maximal_repeats
from meseta.llm.registry import query, table

WINDOW, GRAM = 200, 50
GROUP = 4096
"""Contexts of one gram that meet in one suffix array. A gram with more of them, such as
the edge of a passage that a third of all documents share, is counted window by window."""

_SPAN = "doc {kind}, sum binary, first long, end long"


def _bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, sum, body: a row is known by its id and 128 bits of its text's MD5; equal rows share their result."""
    return docs.select(
        F.col(id_col).alias("doc"), F.unhex(F.md5(utf8(text_col))).alias("sum"), utf8(text_col).alias("body"))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _alike(found: Anchors) -> tuple[Anchors, np.ndarray, list[list[dict]]]:
    """One anchor of each kind in a text, how many there are, and what those of a repeated kind cover."""
    first, kind = distinct(found)
    counts = np.bincount(kind, minlength=len(first))
    covers: list[list[dict]] = [[] for _ in first]
    if len(first) < len(kind):
        starts, ends = found.place - found.left, found.place + found.right
        order = np.argsort(kind, kind="stable")
        bounds = np.cumsum(counts) - counts
        for k in np.flatnonzero(counts > 1):
            rows = order[bounds[k]:bounds[k] + counts[k]]
            covers[k] = [
                {"first": a, "end": b} for a, b in zip(*map(np.ndarray.tolist, _merged(starts[rows], ends[rows])))]
    return Anchors(*(column[first] for column in found)), counts, covers


def anchor_rows(bodies: DataFrame, window: int, gram: int, segment: int = SEGMENT) -> DataFrame:
    """gram, context, doc, sum, place, left, right of an anchor of each kind in a text, n and covers of all of them."""
    kind = bodies.schema["doc"].dataType.simpleString()

    def find(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column("body").to_pylist()
        for low, high in slices(np.array([len(text) for text in texts]), 4_000_000):
            alike = [_alike(anchors(text, window, gram, segment)) for text in texts[low:high]]
            found = [one[0] for one in alike]
            counts = [len(f.place) for f in found]
            if not sum(counts):
                continue
            rows = pa.array(np.repeat(np.arange(low, high), counts))
            yield {
                "gram": _signed(np.concatenate([f.gram for f in found])),
                "context": _signed(np.concatenate([f.context for f in found])),
                "doc": batch.column("doc").take(rows), "sum": batch.column("sum").take(rows),
                "place": np.concatenate([f.place for f in found]),
                "left": np.concatenate([f.left for f in found]), "right": np.concatenate([f.right for f in found]),
                "n": np.concatenate([one[1] for one in alike]), "covers": [c for one in alike for c in one[2]]}

    return arrow_map(
        bodies, find, f"gram long, context long, doc {kind}, sum binary, place long, left short, right short, n long, "
        "covers array<struct<first:long,end:long>>")


def _contexts(bodies: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes around the wanted anchors: gram, part, doc, sum, place, left, right, before (reversed), after.

    Where a long text is cut into segments, one place can be the anchor on both sides:
    two rows that only left and right tell apart. Repeated rows of ``bodies`` give one.
    """
    kind = bodies.schema["doc"].dataType.simpleString()
    lists = wanted.groupBy("doc", "sum").agg(
        F.collect_set(F.struct("gram", "part", "place", "left", "right")).alias("at"))  # at most a text's anchors
    lists = lists.withColumnsRenamed({"doc": "__doc", "sum": "__sum"})
    found = bodies.join(lists, bodies["doc"].eqNullSafe(lists["__doc"]) & (bodies["sum"] == lists["__sum"])).drop(
        "__doc", "__sum")

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        for row in range(batch.num_rows):
            at, body = batch.column("at")[row], batch.column("body")[row].as_py()
            values = at.values
            place, left, right = (values.field(name).to_numpy() for name in ("place", "left", "right"))
            repeat = pa.array(np.full(len(place), row))
            yield {
                "gram": values.field("gram"), "part": values.field("part"), "doc": batch.column("doc").take(repeat),
                "sum": batch.column("sum").take(repeat), "place": place, "left": left, "right": right,
                "before": [body[p - n:p][::-1] for p, n in zip(place.tolist(), left.tolist())],
                "after": [body[p:p + n] for p, n in zip(place.tolist(), right.tolist())]}

    rows = arrow_map(
        found, cut, f"gram long, part int, doc {kind}, sum binary, place long, left short, right short, before binary, "
        "after binary")
    return rows.dropDuplicates(["gram", "doc", "sum", "place", "left", "right"])


def _by_gram(contexts: DataFrame) -> DataFrame:
    """Suffixes that start with one gram lie together; at most ``GROUP`` of them."""
    return contexts.repartition("gram").sortWithinPartitions("gram")


def _suffixes(group: pa.Table) -> tuple[list[bytes], list[bytes], list[int]]:
    return tuple(group.column(name).to_pylist() for name in ("before", "after", "place"))


def repeat_groups(contexts: DataFrame, window: int) -> DataFrame:
    """repeat (hash of the string), length, occurrences (doc, sum, first): the maximal repeats of each gram."""
    kind = contexts.schema["doc"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for group in sorted_groups(batches, ["gram"]):
            lefts, rights, places = _suffixes(group)
            docs, sums = group.column("doc").to_pylist(), group.column("sum").to_pylist()
            rows = []
            for before, after, members in maximal_repeats(lefts, rights, window) if len(places) > 1 else ():
                text = lefts[members[0]][:before][::-1] + rights[members[0]][:after]
                rows.append((xxhash.xxh3_64_intdigest(text) - 2 ** 63, len(text), [
                    {"doc": docs[m], "sum": sums[m], "first": places[m] - before} for m in members]))
            if rows:
                yield dict(zip(("repeat", "length", "occurrences"), zip(*rows)))

    return arrow_stream(
        _by_gram(contexts), scan,
        f"repeat long, length long, occurrences array<struct<doc:{kind},sum:binary,first:long>>")


def repeat_spans(contexts: DataFrame, window: int) -> DataFrame:
    """doc, sum, first, end: for each context, what its maximal repeats cover.

    All repeats of a context contain its anchor, so what they cover is one range: rows
    out are at most rows in, however many repeats nest around an anchor.
    """
    kind = contexts.schema["doc"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for group in sorted_groups(batches, ["gram"]):
            if group.num_rows < 2:
                continue
            lefts, rights, places = _suffixes(group)
            reach: dict[int, tuple[int, int]] = {}
            for before, after, members in maximal_repeats(lefts, rights, window):
                for m in members:
                    left, right = reach.get(m, (0, 0))
                    reach[m] = max(left, before), max(right, after)
            if reach:
                rows = pa.array(list(reach))
                yield {
                    "doc": group.column("doc").take(rows), "sum": group.column("sum").take(rows),
                    "first": [places[m] - left for m, (left, _) in reach.items()],
                    "end": [places[m] + right for m, (_, right) in reach.items()]}

    return arrow_stream(_by_gram(contexts), scan, _SPAN.format(kind=kind))


def window_repeats(contexts: DataFrame, window: int) -> DataFrame:
    """doc, sum, first, end of windows that occur twice, counted one by one; for grams with too many contexts."""
    kind = contexts.schema["doc"].dataType.simpleString()

    def windows(batch: pa.RecordBatch) -> Iterator[dict]:
        for row in range(batch.num_rows):
            before, after = batch.column("before")[row].as_py(), batch.column("after")[row].as_py()
            text, place = before[::-1] + after, batch.column("place")[row].as_py() - len(before)
            starts = range(len(text) - window + 1)
            repeat = pa.array(np.full(len(starts), row))
            yield {
                "doc": batch.column("doc").take(repeat), "sum": batch.column("sum").take(repeat),
                "first": [place + s for s in starts], "end": [place + s + window for s in starts],
                "name": [hashlib.blake2b(text[s:s + window], digest_size=16).digest() for s in starts]}

    rows = stage(arrow_map(contexts, windows, _SPAN.format(kind=kind) + ", name binary"), "windows")
    twice = stage(rows.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name"), "twice")
    return rows.join(twice, "name").drop("name")


def repeated_spans(
    bodies: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP, segment: int = SEGMENT,
) -> tuple[DataFrame, DataFrame]:
    """Spans (doc, sum, first, end) covered by repeated windows, and the contexts that were compared.

    ``repeat_groups`` of the contexts lists the maximal repeats among them.
    """
    rows = anchor_rows(bodies, window, gram, segment)
    # grams that occur once are most of them and end here; rows of a gram combine before the shuffle
    again = stage(rows.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"), "grams")
    shared = stage(rows.join(again, "gram"), "anchors")
    contexts = stage(shared.groupBy("gram", "context").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc", "sum", "place", "left", "right")).alias("one")), "contexts")
    kinds = stage(contexts.groupBy("gram").agg(F.count("*").alias("kinds")), "kinds")
    # a context met twice settles all its windows
    twice = stage(contexts.where("n > 1").select("gram", "context"), "twice")
    only = F.array(F.struct(
        (F.col("place") - F.col("left")).alias("first"), (F.col("place") + F.col("right")).alias("end")))
    whole = shared.join(twice, ["gram", "context"]).select(
        "doc", "sum", F.inline(F.when(F.col("n") > 1, F.col("covers")).otherwise(only)))
    # of every context one occurrence is compared, where the gram has others
    compared = contexts.join(kinds.where("kinds > 1"), "gram").select(
        "gram", "kinds", "one.*", (F.col("kinds") > group).cast("int").alias("part"))
    around = stage(_contexts(bodies, compared), "around")
    spans = whole.unionByName(repeat_spans(around.where("part = 0"), window))
    large = around.where("part = 1")
    if not large.isEmpty():
        spans = spans.unionByName(window_repeats(large, window))
    return spans, around


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges as disjoint ranges that don't touch."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))
    return starts[new], ends[last]


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
    group: int = GROUP, segment: int = SEGMENT,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_bytes, n_removed, n_spans, kept (bytes), removed (ranges).

    Null texts are empty. Texts shorter than a window lose nothing. What is kept can
    end inside a character, since strings are judged as bytes.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    bodies = _bodies(docs, id_col, text_col)
    spans, _ = repeated_spans(bodies, window, gram, group, segment)
    spans = spans.groupBy("doc", "sum").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    spans = stage(spans, "spans").withColumnsRenamed({"doc": "__doc", "sum": "__sum"})
    joined = bodies.join(
        spans, bodies["doc"].eqNullSafe(spans["__doc"]) & (bodies["sum"] == spans["__sum"]), "left").select(
        "doc", "body", "spans")

    def remove(batch: pa.RecordBatch) -> Iterator[dict]:
        bodies_, kept, removed = batch.column("body").to_pylist(), [], []
        for row, body in enumerate(bodies_):
            found = batch.column("spans")[row]
            if not found.is_valid:
                kept.append(body)
                removed.append([])
                continue
            starts, ends = _merged(
                found.values.field("first").to_numpy(), found.values.field("end").to_numpy())
            cuts = [0, *np.stack((starts, ends), 1).ravel().tolist(), len(body)]
            kept.append(b"".join(body[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
            removed.append([{"first": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())])
        yield {
            "doc": batch.column("doc"), "n_bytes": [len(body) for body in bodies_],
            "n_removed": [len(body) - len(k) for body, k in zip(bodies_, kept)],
            "n_spans": [len(r) for r in removed], "kept": kept, "removed": removed}

    return arrow_map(
        joined, remove, f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept binary, "
        "removed array<struct<first:long,end:long>>").withColumnRenamed("doc", id_col)


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
