"""Benchmark decontamination with one Aho-Corasick automaton over word windows.

Test items and documents are normalised to the same words. Every ``window`` consecutive
words of an item are a pattern (a shorter item is one pattern), and one automaton of all
patterns scans each text once. What it finds is mapped to code points of the original.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from meseta.llm.common import arrow_map, arrow_stream, discard, stage
from meseta.llm.registry import query, table

# a word before A-Z is lower-cased: digits, letters and whatever isn't ASCII
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# of UTF-8 bytes: A-Z to a-z, other bytes of words as they are, the rest to a space
_NORMAL = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256))
CHUNK = 1 << 20
"""Characters of a text split into words at once; longer texts go on at the next word."""

RESULT = (
    "struct<n_words:long, n_hit:long, "
    "spans:array<struct<word_from:long, word_to:long, start:long, end:long>>, items:array<string>>")


def word_chunks(text: str, size: int = CHUNK) -> Iterator[list[bytes]]:
    """The normalised words of a text, in order, in lists of bounded length."""
    at = 0
    while len(text) - at > size:
        end = at + size
        whole = WORD.match(text, end)  # a word that the cut would divide
        end = whole.end() if whole else end
        yield text[at:end].encode().translate(_NORMAL).split()
        at = end
    yield (text[at:] if at else text).encode().translate(_NORMAL).split()


class Automaton:
    """Windows of test items as one automaton over word numbers."""

    def __init__(self, windows: list[str], owners: list[list[str]]):
        import ahocorasick

        self.number: dict[bytes, int] = {}
        self.widths: list[int] = []
        self.owners = owners
        self._machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for at, window in enumerate(windows):
            words = window.encode().split(b" ")
            self._machine.add_word(
                tuple(self.number.setdefault(word, len(self.number) + 1) for word in words), at)
            self.widths.append(len(words))
        self._machine.make_automaton()
        self._carry = max(self.widths, default=1) - 1
        self._least = min(self.widths, default=1)

    def _matches(self, numbers: list[int]) -> Iterator[tuple[int, int]]:
        """(end, window) of each occurrence.

        No window spans a word that none of them has, and there the automaton stands at its
        root; so it runs over the stretches in between that are long enough for a window.
        """
        gaps = np.concatenate(([-1], np.flatnonzero(np.array(numbers) == 0), [len(numbers)]))
        for at in np.flatnonzero(np.diff(gaps) > self._least):
            start, stop = int(gaps[at]) + 1, int(gaps[at + 1])
            for end, which in self._machine.iter(tuple(numbers[start:stop])):
                yield start + end, which

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Words of the text, merged ranges of hit words (end exclusive), and the items found."""
        known, seen, carry, ranges, items = self.number.get, 0, [], [], set()
        for words in word_chunks(text):
            numbers = carry + list(map(known, words, repeat(0)))
            first = seen - len(carry)
            for end, which in self._matches(numbers) if self.widths else ():
                ranges.append((first + end + 1 - self.widths[which], first + end + 1))
                items.update(self.owners[which])
            seen += len(words)
            carry = numbers[-self._carry:] if self._carry else []
            ranges = merged(ranges)
        return seen, ranges, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint ranges in order that cover the same words; touching ones become one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return out


def located(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Ranges of words with the code points of the original text that they cover."""
    spans, wanted = [], iter(ranges)
    low, high = next(wanted, (-1, -1))
    start = 0
    for at, match in enumerate(WORD.finditer(text)):
        if at == low:
            start = match.start()
        if at == high - 1:
            spans.append({"word_from": low, "word_to": high, "start": start, "end": match.end()})
            low, high = next(wanted, (-1, -1))
            if high < 0:
                break
    return spans


def item_windows(items: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct (pattern, item, width): windows of every item's words."""

    def cut(batch: pa.RecordBatch) -> Iterator[dict]:
        for item, text in zip(batch.column("item").to_pylist(), batch.column("body").to_pylist()):
            words = [word.decode() for chunk in word_chunks(text) for word in chunk]
            width = min(window, len(words))
            windows = list({" ".join(words[at:at + width]) for at in range(len(words) - width + 1)} if width else ())
            for at in range(0, len(windows), 10_000):
                part = windows[at:at + 10_000]
                yield {"pattern": part, "item": [item] * len(part), "width": [width] * len(part)}

    rows = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    return arrow_map(rows, cut, "pattern string, item string, width int").distinct()


_machines: dict[str, Automaton] = {}


def _machine(key: str, patterns: Broadcast) -> Automaton:
    """One automaton per Python worker, built from the broadcast patterns."""
    if key not in _machines:
        _machines.clear()
        _machines[key] = Automaton(*patterns.value)
    return _machines[key]


def _scan_block(docs: DataFrame, patterns: Broadcast, text_col: str, out: str, keep: list[str]) -> DataFrame:
    """``docs`` with the struct ``out``; what an earlier block found there is merged."""
    key, earlier = uuid.uuid4().hex, out in docs.columns
    schema = StructType([docs.schema[name] for name in keep]).add(out, _parse_datatype_string(RESULT))
    kind = to_arrow_schema(schema).field(out).type

    def scan(batch: pa.RecordBatch, keep=tuple(keep)) -> Iterator[dict]:
        machine, found = _machine(key, patterns), []
        before = batch.column(out).to_pylist() if earlier else [None] * batch.num_rows
        for text, old in zip(batch.column(text_col).to_pylist(), before):
            n_words, ranges, items = machine.scan(text or "")
            if old:
                ranges = merged(ranges + [(span["word_from"], span["word_to"]) for span in old["spans"]])
                items.update(old["items"])
            found.append({
                "n_words": n_words, "n_hit": sum(high - low for low, high in ranges),
                "spans": located(text, ranges) if ranges else [], "items": sorted(items)})
        yield {name: batch.column(name) for name in keep} | {out: pa.array(found, kind)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                yield from scan(batch)

    return arrow_stream(docs, run, schema)


def scan(
    docs: DataFrame, items: DataFrame, *, window: int = 10, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", out: str = "leaks", keep: list[str] | None = None, block_words: int = 2_000_000,
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) and the struct ``out`` of what leaked into the text.

    n_words and n_hit count words, spans are the maximal runs of hit words (word numbers
    and code points, ends exclusive) and items the ids found, sorted as strings. Null texts
    have no words; items without words leak nowhere; a null item id is the empty string,
    and rows that repeat an item id are one item. A column called ``out`` must not exist.

    The patterns are broadcast, at most ``block_words`` words of them at a time. More than
    that is split into blocks, and each block's automaton scans all documents, adding to
    what the blocks before it found.
    """
    if out in docs.columns:
        raise ValueError(f"Column {out} exists already; name another with out=.")
    spark = docs.sparkSession
    keep = list(docs.columns) if keep is None else list(keep)
    pairs = stage(item_windows(items, window, item_col, item_text_col), "item-windows")
    total = pairs.agg(F.sum("width")).first()[0] or 0
    blocks = max(1, -(-2 * total // block_words) if total > block_words else 1)
    current = docs.select(*dict.fromkeys([*keep, text_col]))
    for block in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("pattern", "item"), F.lit(blocks)) == block)
        owners: dict[str, list[str]] = {}
        for row in mine.select("pattern", "item").toLocalIterator():
            owners.setdefault(row["pattern"], []).append(row["item"])
        patterns = spark.sparkContext.broadcast((list(owners), list(owners.values())))
        last = block == blocks - 1
        done = _scan_block(current, patterns, text_col, out, keep if last else [c for c in current.columns if c != out])
        if not last:  # one automaton in memory at a time
            done = stage(done, "leaks")
            if block:
                discard(current)
        current = done
    return current


def drop_contaminated(docs: DataFrame, items: DataFrame, *, min_share: float = 0.0, **options) -> DataFrame:
    """Rows of ``docs`` whose hit words are at most ``min_share`` of their words; columns stay as they are."""
    out = next(name for name in ("leaks", *(f"leaks_{k}" for k in range(len(docs.columns) + 1)))
               if name not in docs.columns)
    found = scan(docs, items, out=out, **options)
    return found.where(F.col(f"{out}.n_hit") <= min_share * F.col(f"{out}.n_words")).drop(out)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query("op12_decontamination", sql=f"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, list_slice(w, s, s + least(10, len(w)) - 1) AS win, least(10, len(w)) AS k
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
widths AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, s, k, list_slice(w, s, s + k - 1) AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, widths WHERE len(w) >= k)),
m AS (SELECT r, s, dw.k, item FROM dw JOIN bw USING (win)),
h AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + k)) AS p FROM m) GROUP BY r),
i AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)""")
def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = scan(docs, table(spark, folder, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "leaks.n_words", "leaks.n_hit", F.size("leaks.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leaks.items", ","), 256).alias("items_sha256"),
        (F.col("leaks.n_hit") > 0).alias("contaminated"))
