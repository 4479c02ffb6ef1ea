"""Quality rules: statistics of whole texts, a fixed base, and a learned decision list."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meseta.llm.common import arrow_map
from meseta.llm.decision_list import Rule, sequential_covering, verdict
from meseta.llm.registry import query, table

SAMPLE = 6000
"""Labelled documents that rules are learned from, at most; chosen by a hash of the id."""

# Fixed values
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
          "n_marks", "n_distinct_words")

_NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))
_NOT_UPPER = bytes(set(range(256)) - set(range(65, 91)))
_NOT_DIGITS = bytes(set(range(256)) - set(range(48, 58)))
_NOT_MARKS = bytes(set(range(256)) - set(b"!?"))
_CONTINUED = bytes(range(128, 192))
_WORD = re.compile(rb"[^\x20\x09-\x0d]")


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words inside windows of ``size`` words that occur twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    windows = sum(
        hashes[k:n + k] * np.uint64(factor)
        for k, factor in zip(range(size), (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)))
    order = np.argsort(windows, kind="stable")
    equal = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    inside = np.zeros(len(words), bool)
    for k in range(size):
        inside[k:n + k] |= twice
    return int(inside.sum())


def text_counts(text: bytes) -> tuple[int, ...]:
    """``COUNTS`` of a text in UTF-8."""
    words = text.split()
    bare = len(text) - len(text.translate(None, SPACES))
    lines = text.split(b"\n")
    filled = [line for line in lines if _WORD.search(line)]
    return (
        len(words), len(text.translate(None, _CONTINUED)) - bare, len(text.translate(None, _NOT_SYMBOLS)),
        len(filled) - len(set(filled)), repeated_words(words), len(filled), len(text.translate(None, _NOT_UPPER)),
        len(text.translate(None, _NOT_DIGITS)), len(text.translate(None, _NOT_MARKS)), len(set(words)))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the counts, and shares that rules are made of; a null text counts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        rows = [text_counts((text or "").encode()) for text in batch.column(1).to_pylist()]
        yield {"doc": batch.column(0)} | dict(zip(COUNTS, zip(*rows)))

    counted = arrow_map(
        docs.select(id_col, text_col), count, f"doc {kind}, " + ", ".join(f"{name} long" for name in COUNTS))

    def share(part: str, whole: str):
        return F.col(part) / F.greatest(F.col(whole), F.lit(1)).cast("double")

    return counted.withColumnRenamed("doc", id_col).withColumns({
        "symbol_share": share("n_symbols", "word_chars"), "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"), "mark_share": share("n_marks", "word_chars"),
        "word_length": share("word_chars", "n_words"), "line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"), "distinct_share": share("n_distinct_words", "n_words")})


LEARNED_FROM = ("symbol_share", "upper_share", "digit_share", "mark_share", "word_length", "line_share",
                "repeat_share", "distinct_share", "n_words")


def learn_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
    held_out=None,
) -> list[Rule]:
    """A decision list for documents labelled as bad, from at most ``sample`` labelled rows."""
    usable = F.col("quality").isNotNull() & F.col(id_col).isNotNull()
    if held_out is not None:
        usable = usable & ~held_out
    chosen = labels.where(usable).select(F.col(id_col), F.col("quality").cast("int")).orderBy(
        F.xxhash64(id_col), "quality").limit(sample)
    chosen = F.broadcast(chosen)  # at most ``sample`` rows
    known = docs.select(id_col, text_col).join(chosen, id_col, "left_semi")
    rows = statistics(known, id_col, text_col).join(chosen, id_col).select("quality", *LEARNED_FROM).toPandas()
    rows = rows.sort_values(list(rows.columns)).reset_index(drop=True)
    columns = {name: rows[name].to_numpy(float) for name in LEARNED_FROM}
    return sequential_covering(columns, rows["quality"].to_numpy() == 0)


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add base_failed, rule (first that holds) and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("rule", verdict(rules)).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rules = learn_rules(docs, table(spark, folder, "labels"))
    return judge(statistics(docs), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
