"""Encoding texts inside tasks with a public byte-level BPE vocabulary, and exact length histograms."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meseta.llm.common import arrow_map, stage
from meseta.llm.registry import query, table


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of a byte-level BPE ``tokenizer.json``, without tokens added around a text.

    Strings of special tokens inside a text are those tokens, as the reference
    implementation has it by default; such texts are left to it.

    The merges of the file, in order, are the ids of the vocabulary, so the file can
    also be read as ranks, which encodes three times as fast. What that reading can't
    take, such as huge runs of white space, goes to the reference implementation.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        special = {token.content for token in self._slow.get_added_tokens_decoder().values()}
        self._special = tuple(special)
        # printable stand-ins of bytes: those that print stay, the others follow from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [byte for byte in range(256) if byte not in set(printable)]
        byte_of = {chr(byte): byte for byte in printable} | {chr(256 + k): byte for k, byte in enumerate(others)}
        ranks = {
            bytes(byte_of[c] for c in piece): rank for piece, rank in vocabulary.items() if piece not in special}
        self._fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        try:
            if any(token in text for token in self._special):
                return self._slow.encode(text, add_special_tokens=False).ids
            return self._fast.encode_ordinary(text)
        except BaseException as error:  # a panic of the native library is no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return self._slow.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(path)


def encoded_lengths(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``n_tokens`` of every row; a null text counts as empty."""

    def lengths(batch: pa.RecordBatch) -> Iterator[dict]:
        encode = encoder(vocabulary).ids
        yield {"n_tokens": [len(encode(text)) if text else 0 for text in batch.column(0).to_pylist()]}

    return arrow_map(docs.select(F.col(text_col).alias("body")), lengths, "n_tokens long")


_BAND = 1024


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``n_tokens``, n_docs and sums over all documents at least or more than that long.

    docs_from and tokens_from count the documents of this length or more. For a
    context limit of n_tokens, tokens_kept is the corpus total after truncating every
    document to the limit, tokens_cut what truncation loses and docs_cut how many
    documents it touches; share_within is the share of documents that fit whole.

    Sums run inside bands of lengths and over the band totals, so no task sorts all
    lengths of a corpus with very long documents.
    """
    counts = lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    counts = stage(counts.withColumn("band", F.floor(F.col("n_tokens") / _BAND)), "lengths")
    tokens = F.col("n_tokens") * F.col("n_docs")
    longest_first = Window.orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bands = counts.groupBy("band").agg(F.sum("n_docs").alias("d"), F.sum(tokens).alias("t")).select(
        "band", F.coalesce(F.sum("d").over(longest_first), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(longest_first), F.lit(0)).alias("tokens_above"))
    within = Window.partitionBy("band").orderBy(F.col("n_tokens").desc())
    totals = counts.agg(F.sum("n_docs").alias("all_docs"), F.sum(tokens).alias("all_tokens")).first()
    docs_total, tokens_total = (totals["all_docs"] or 0, totals["all_tokens"] or 0)
    docs_from = F.sum("n_docs").over(within) + F.col("docs_above")
    tokens_from = F.sum(tokens).over(within) + F.col("tokens_above")
    sums = counts.join(bands, "band").select(
        "n_tokens", "n_docs", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"))
    docs_cut = F.col("docs_from") - F.col("n_docs")
    tokens_cut = (F.col("tokens_from") - tokens) - docs_cut * F.col("n_tokens")
    return sums.select(
        "*", docs_cut.alias("docs_cut"), tokens_cut.alias("tokens_cut"),
        (F.lit(tokens_total) - tokens_cut).alias("tokens_kept"),
        ((F.lit(docs_total) - docs_cut) / F.lit(float(max(docs_total, 1)))).alias("share_within"))


def truncated_total(histogram: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut to ``limit``."""
    at = histogram.where(F.col("n_tokens") > limit).agg(
        F.max("docs_from").alias("docs"), F.max("tokens_from").alias("tokens")).first()
    total = histogram.agg(F.max("tokens_from")).first()[0] or 0
    return total - ((at["tokens"] or 0) - (at["docs"] or 0) * limit)


def quantile(histogram: DataFrame, share: float) -> int | None:
    """The shortest length that at least ``share`` of the documents don't exceed."""
    return histogram.where(F.col("share_within") >= share).agg(F.min("n_tokens")).first()[0]


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    lengths = encoded_lengths(table(spark, folder, "documents"), default_vocabulary())
    return length_histogram(lengths)
