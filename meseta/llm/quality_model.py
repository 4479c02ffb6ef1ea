"""Quality by attention-based multiple-instance learning.

A text is a bag of passages. Every passage is encoded from its bytes; gated attention
weighs the passages, and the weighted representation is scored. Labels belong to
documents only: the weights of the passages are learned from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from meseta.llm.common import arrow_map, free_name, ship, slices, stage, utf8
from meseta.llm.registry import query, table

PASSAGE = 1000
"""Bytes of a passage."""
SAMPLE = 4000
"""Labelled documents that a model is fitted on, at most; chosen by a hash of the id."""
SAMPLE_PASSAGES = 100_000
"""Passages of the labelled documents that a model is fitted on, at most. Documents enter
whole, in the order of the hash; one that would exceed the sum is no part of the sample."""
THRESHOLD = 0.7

_KINDS = 16


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, 15, np.uint16)  # first bytes of longer characters
    groups = (
        range(ord("a"), ord("z") + 1), range(ord("A"), ord("Z") + 1), range(ord("0"), ord("9") + 1),
        b" ", b"\n", b"\t\r\x0b\x0c", b".,", b";:", b"!?", b"'\"`", b"()[]{}", b"#*$%&", b"|<>\\/", b"-_+=~^@",
        range(128, 192))
    for kind, group in enumerate(groups):
        kinds[list(group)] = kind
    return kinds


_KIND_OF = _byte_kinds()
_STEPS = 8
FEATURES = 256 + _KINDS * _KINDS + _STEPS


def _variety(body: np.ndarray, n: int) -> np.ndarray:
    """In which of eight steps the share of different strings of 8 bytes in each passage lies."""
    grams = np.zeros((n, PASSAGE), np.uint32)
    padded = np.zeros(n * PASSAGE + 7, np.uint32)
    padded[:len(body)] = body
    strings = np.zeros(n * PASSAGE, np.uint32)
    for k in range(8):
        strings = strings * np.uint32(0x01000193) + padded[k:k + n * PASSAGE]
    grams[:] = strings.reshape(n, PASSAGE)
    sizes = np.full(n, PASSAGE)
    sizes[-1] = len(body) - (n - 1) * PASSAGE
    grams[-1, max(sizes[-1] - 7, 0):] = 0  # strings that run past the end of the text
    grams.sort(axis=1)
    different = (grams[:, 1:] != grams[:, :-1]).sum(1) + 1
    share = np.clip(different / np.maximum(sizes - 7, 1), 0, 1)
    steps = np.zeros((n, _STEPS))
    steps[np.arange(n), np.minimum((share * _STEPS).astype(int), _STEPS - 1)] = 1
    return steps


def passage_features(text: bytes, first: int, end: int) -> np.ndarray:
    """Shares of bytes and of pairs of byte kinds in passages ``first`` to ``end``, and their variety.

    Square roots, so that rare ones count.
    """
    body = np.frombuffer(text, np.uint8)[first * PASSAGE:end * PASSAGE]
    n = max(end - first, 1)
    row = np.arange(len(body)) // PASSAGE
    single = np.bincount(row * 256 + body, minlength=n * 256).reshape(n, 256)
    kinds = _KIND_OF[body]
    pairs = row[:-1] * _KINDS ** 2 + kinds[:-1] * _KINDS + kinds[1:]
    double = np.bincount(pairs, minlength=n * _KINDS ** 2).reshape(n, _KINDS ** 2)
    sizes = np.maximum(np.bincount(row, minlength=n), 1)[:, None]
    shares = np.sqrt(np.concatenate((single, double), 1) / sizes)
    return np.concatenate((shares, _variety(body, n)), 1).astype(np.float32)


def n_passages(text: bytes) -> int:
    return max(-(-len(text) // PASSAGE), 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AttentionModel:
    """Weights of encoder (w, b), gated attention (v, u, a) and scorer (c, d)."""

    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    d: np.ndarray

    @classmethod
    def start(cls, features: int, width: int = 24, gate: int = 12, seed: int = 7) -> AttentionModel:
        draw = np.random.default_rng(seed)
        normal = lambda *shape: (draw.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        return cls(normal(features, width), np.zeros(width, np.float32), normal(width, gate), normal(width, gate),
                   normal(gate), normal(width), np.zeros(1, np.float32))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        h = np.tanh(x @ self.w + self.b)
        t, g = np.tanh(h @ self.v), _sigmoid(h @ self.u)
        return h, t, g, (t * g) @ self.a

    @staticmethod
    def attention(logits: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        top = np.repeat(np.maximum.reduceat(logits, starts), counts)
        weight = np.exp(logits - top)
        return weight / np.repeat(np.add.reduceat(weight, starts), counts)

    def scores(self, h: np.ndarray, logits: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """One score per bag; ``counts`` passages each, one at least."""
        starts = np.cumsum(counts) - counts
        weight = self.attention(logits, starts, counts)
        return _sigmoid(np.add.reduceat(h * weight[:, None], starts) @ self.c + self.d)

    def gradients(self, x: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy, in the order of the fields."""
        starts, n = np.cumsum(counts) - counts, len(counts)
        h, t, g, logits = self.encode(x)
        weight = self.attention(logits, starts, counts)
        z = np.add.reduceat(h * weight[:, None], starts)
        error = (_sigmoid(z @ self.c + self.d) - labels) / n
        dz = np.repeat(error[:, None] * self.c, counts, axis=0)
        along = (dz * h).sum(1)
        mean = np.repeat(np.add.reduceat(weight * along, starts), counts)
        dlogit = weight * (along - mean)
        dt, dg = dlogit[:, None] * self.a * g * (1 - t * t), dlogit[:, None] * self.a * t * g * (1 - g)
        dh = (dz * weight[:, None] + dt @ self.v.T + dg @ self.u.T) * (1 - h * h)
        return [x.T @ dh, dh.sum(0), h.T @ dt, h.T @ dg, (t * g).T @ dlogit, z.T @ error, error.sum(keepdims=True)]


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 30, batch: int = 64, seed: int = 7) -> AttentionModel:
    """Adam with weight decay; the same bags give the same model."""
    model, draw = AttentionModel.start(FEATURES, seed=seed), np.random.default_rng(seed)
    fields = list(model.__dataclass_fields__)
    first = {f: np.zeros_like(getattr(model, f)) for f in fields}
    second = {f: np.zeros_like(getattr(model, f)) for f in fields}
    step = 0
    for _ in range(epochs if len(bags) else 0):
        order = draw.permutation(len(bags))
        for chosen in np.array_split(order, max(len(bags) // batch, 1)):
            step += 1
            counts = np.array([len(bags[k]) for k in chosen])
            found = model.gradients(
                np.concatenate([bags[k] for k in chosen]).astype(np.float32), counts, labels[chosen])
            for f, grad in zip(fields, found):
                value = getattr(model, f)
                first[f] = 0.9 * first[f] + 0.1 * grad
                second[f] = 0.999 * second[f] + 0.001 * grad * grad
                move = (first[f] / (1 - 0.9 ** step)) / (np.sqrt(second[f] / (1 - 0.999 ** step)) + 1e-8)
                setattr(model, f, (value - 0.004 * (move + 1e-3 * value)).astype(np.float32))
    return model


def held_out(id_col: str = "doc_id"):
    """Rows that a model never learns from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_bags(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
    sample: int = SAMPLE, passages: int = SAMPLE_PASSAGES,
) -> tuple[list[np.ndarray], np.ndarray]:
    """All passages, and the labels, of at most ``sample`` labelled documents that aren't held out.

    Rows that repeat id and label count once; of rows of ``docs`` that repeat the id, the
    one with the least text is taken.
    """
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("doc"), F.col(label_col).cast("int").alias("label")).distinct().orderBy(
        F.xxhash64("doc"), "label").limit(sample)
    texts = docs.select(F.col(id_col).alias("doc"), utf8(text_col).alias("body"))
    rows = stage(texts.join(F.broadcast(chosen), "doc").groupBy("doc", "label").agg(F.min("body").alias("body")), "bags")
    taken = F.sum(F.greatest(F.ceil(F.octet_length("body") / PASSAGE), F.lit(1))).over(
        Window.orderBy(F.xxhash64("doc"), "label").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = rows.select("doc", "label", taken.alias("taken")).where(F.col("taken") <= passages)  # of ``sample`` rows
    rows = rows.join(F.broadcast(within), ["doc", "label"])

    def bags(batch: pa.RecordBatch) -> Iterator[dict]:
        found = []
        for text in batch.column("body").to_pylist():
            n = n_passages(text)
            found.append(np.concatenate([
                passage_features(text, k, min(k + 500, n)) for k in range(0, n, 500)]).astype(np.float16).tobytes())
        yield {"doc": batch.column("doc"), "label": batch.column("label"), "bag": found}

    kind = docs.schema[id_col].dataType.simpleString()
    got = arrow_map(rows.select("doc", "label", "body"), bags, f"doc {kind}, label int, bag binary").collect()
    got = sorted(got, key=lambda row: (row["doc"], row["label"]))
    return ([np.frombuffer(row["bag"], np.float16).reshape(-1, FEATURES) for row in got],
            np.array([row["label"] for row in got], np.float32))


def score(
    docs: DataFrame, model: AttentionModel, id_col: str = "doc_id", text_col: str = "text", out: str = "__score",
) -> DataFrame:
    """``docs`` and ``out``, the score of every whole text; a null text counts as empty.

    The score takes the place of a column called ``out``; name a free one to keep both.
    """
    docs = docs.drop(out)
    ship(docs.sparkSession)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(text or "").encode() for text in batch.column(text_col).to_pylist()]
            scores: list[np.ndarray] = []
            for low, high in slices(np.array([len(text) for text in texts]), 2_000_000):
                parts, counts = [], []
                for text in texts[low:high]:
                    n = n_passages(text)
                    counts.append(n)
                    for first in range(0, n, 2000):
                        h, _, _, logits = model.encode(passage_features(text, first, min(first + 2000, n)))
                        parts.append((h, logits))
                scores.append(model.scores(
                    np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.array(counts)))
            values = np.concatenate(scores).astype(np.float64) if scores else np.zeros(0)
            yield batch.append_column(out, pa.array(values))

    return docs.mapInArrow(apply, StructType([*docs.schema.fields, StructField(out, DoubleType())]))


def quality_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> AttentionModel:
    return fit(*labelled_bags(docs, labels, "quality", id_col, text_col))


def good_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents scored at ``threshold`` or more, with all their columns."""
    model = quality_model(docs, labels, id_col, text_col)
    out = free_name(docs, "__score")
    return score(docs, model, id_col, text_col, out).where(F.col(out) >= threshold).drop(out)


@query("op7_quality_mil")
def op7_quality_mil(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_model(docs, table(spark, folder, "labels"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))
