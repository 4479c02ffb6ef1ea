"""Secret scans: fixed patterns, and a character network over every other candidate.

The network learns from findings of the fixed patterns with their keyword or prefix
masked, so that it learns the shape of keys and not the patterns. Candidates without a
finding are no negatives: they are what the network is asked about. Negatives are those
that have the structure of e-mail addresses, links, paths, dates or joined words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meseta.llm.char_cnn import WIDTH, CharCNN, codes, fit, platt, recall_threshold
from meseta.llm.common import arrow_map, arrow_stream, discard, stage
from meseta.llm.registry import query, table

SAMPLE_CANDIDATES = 3_000
"""Candidates of each label that the network is fitted on, at most; of all documents, by a hash of the window."""
WORDS = 50
"""Negative rows, at least: where candidates give fewer, or fewer than there are positive ones, ordinary words are added."""
STEPS = 1200
"""Steps of fitting, at least."""
RECALL = 0.98
"""Share of the findings of each kind that the threshold must find among all candidates outside the fit."""
BINS, FAR = 64, 30
"""Bins per unit of the histogram of scores, which ends at plus and minus ``FAR``."""
BEFORE = 24
"""Characters of context in front of a candidate."""

# Fixed values
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=@:~-]{12,}")
_TELLING = re.compile(r"[0-9]|[a-z][A-Z]|[A-Z][a-z]+[A-Z]")
_PREFIX = re.compile(r"(?i:password|passwd|secret|token|api_?key)|AKIA", re.ASCII)
_MAIL = re.compile(r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+[.:]?")
_LINK = re.compile(r"[A-Za-z]{2,6}://|www\.|//")
_JOINED = re.compile(r"(?:[A-Z]?[a-z]{1,20}|[A-Z]{1,12}|[0-9]{1,4})(?:[+/_.=@:~-]+(?:[A-Z]?[a-z]{1,20}|[A-Z]{1,12}|[0-9]{1,4}))*[+/_.=@:~-]*")

_WORD = re.compile(r"[^\W\d_]{4,}")
NEGATIVE, POSITIVE, WORD = range(3)
UNLABELLED = "unlabelled"

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points, by start and then kind."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of 12 or more characters of keys, with a digit or letters of mixed case."""
    return [m.span() for m in _CANDIDATE.finditer(text) if _TELLING.search(m[0])]


def ordinary(run: str) -> bool:
    """Whether a candidate has the structure of an e-mail address, a link, a path, a date or joined words."""
    return bool(_MAIL.fullmatch(run) or _LINK.search(run) or _JOINED.fullmatch(run.lstrip("+/_.=@:~-")))


def windows(text: str, start: int, end: int) -> list[str]:
    """The candidate with the context before it, in as many windows as its length needs."""
    step = WIDTH - BEFORE
    return [text[max(at - BEFORE, 0):at].rjust(BEFORE, "\0") + text[at:at + step] for at in range(start, end, step)]


def bare(text: str, start: int, end: int) -> list[str]:
    """The windows of a candidate with keywords and prefixes masked."""
    return [_PREFIX.sub(lambda m: "\0" * len(m[0]), window) for window in windows(text, start, end)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


@dataclass
class SecretModel:
    """A network with its calibration and threshold."""

    network: CharCNN
    slope: float
    offset: float
    threshold: float

    def scores(self, found: list[list[str]]) -> np.ndarray:
        """Probability of each candidate, the highest of its windows."""
        return calibrated(best_logits(self.network, found), self.slope, self.offset)


def best_logits(network: CharCNN, found: list[list[str]]) -> np.ndarray:
    """The highest output among the windows of each candidate."""
    if not found:
        return np.zeros(0)
    counts = np.array([len(w) for w in found])
    logits = network.logits(codes([one for w in found for one in w]))
    return np.maximum.reduceat(logits, np.cumsum(counts) - counts)


def calibrated(logits: np.ndarray, slope: float, offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * logits + offset, -30, 30)))


class _Covered:
    """Whether a range meets any of some spans; a search by bisection, since texts can hold very many."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted((start, end) for _, start, end in spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end) - 1  # the last span that starts before the range ends
        return at >= 0 and self.ends[at] > start


def words(text: str, base: _Covered) -> Iterator[str]:
    """Windows of a few words spread over a text, without those that show a finding or a candidate."""
    places = (_WORD.search(text, at) for at in range(0, len(text), len(text) // 8 + 1))
    for found in {m.start(): m for m in places if m}.values():
        window = windows(text, found.start(), found.start() + 1)[0]
        if not base.meets(found.start() - BEFORE, found.start() + WIDTH - BEFORE) and not candidates(window):
            yield window


def sample(docs: DataFrame, text_col: str = "text") -> dict[int, list[str]]:
    """Windows of each label (``NEGATIVE``, ``POSITIVE``, ``WORD``), those with the least hashes of all documents.

    A task hands on no more rows of a label than the sample takes.
    """

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        kept: dict[int, dict[str, int]] = {NEGATIVE: {}, POSITIVE: {}, WORD: {}}

        def trim(limit: int) -> None:
            for name, rows in kept.items():
                if len(rows) > limit:
                    kept[name] = dict(sorted(rows.items(), key=lambda row: (row[1], row[0]))[:SAMPLE_CANDIDATES])

        def add(name: int, window: str) -> None:
            kept[name][window] = xxhash.xxh3_64_intdigest(window.encode()) - 2 ** 63

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                base = _Covered(base_spans(text))
                for start, end in candidates(text):
                    if base.meets(start, end):
                        add(POSITIVE, bare(text, start, end)[0])
                        add(POSITIVE, windows(text, start, end)[0])
                    elif ordinary(text[start:end]):
                        add(NEGATIVE, windows(text, start, end)[0])
                for window in words(text, base):
                    add(WORD, window)
                trim(4 * SAMPLE_CANDIDATES)
        trim(SAMPLE_CANDIDATES)
        rows = [(name, window, order) for name, found in kept.items() for window, order in found.items()]
        if rows:
            yield dict(zip(("label", "window", "order"), map(list, zip(*rows))))

    rows = stage(arrow_stream(docs.select(text_col), label, "label int, window string, order long"), "windows")
    found = {}
    for name in (NEGATIVE, POSITIVE, WORD):  # tasks keep their least, and these are merged in parts
        least = rows.where(F.col("label") == name).select("order", "window").distinct().orderBy("order", "window")
        found[name] = [row["window"] for row in least.limit(SAMPLE_CANDIDATES).collect()]
    discard(rows)
    return found


def histogram(docs: DataFrame, network: CharCNN, fitted: frozenset[str], text_col: str = "text") -> list[tuple]:
    """(in the fit, kinds, bin, n) of all candidates: those of ``docs`` by the kinds they meet and their score.

    Kinds are joined by commas, empty for negative candidates, and candidates that are
    neither are counted as ``UNLABELLED``. Findings are shown without keyword and prefix,
    which is how others look. A bin is known by its lower end.
    """

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        counts: Counter = Counter()
        asked: list[tuple[bool, str]] = []
        found: list[list[str]] = []

        def count() -> None:
            bins = np.floor(np.clip(best_logits(network, found), -FAR, FAR) * BINS).astype(int).tolist()
            counts.update((*key, at) for key, at in zip(asked, bins))
            asked.clear()
            found.clear()

        for text in batch.column(0).to_pylist():
            if not text:
                continue
            base = base_spans(text)
            known = {kind: _Covered([span for span in base if span[0] == kind]) for kind in KINDS}
            for start, end in candidates(text):
                kinds = ",".join(k for k in KINDS if known[k].meets(start, end))
                shown = bare(text, start, end) if kinds else windows(text, start, end)
                asked.append((shown[0] in fitted, kinds or ("" if ordinary(text[start:end]) else UNLABELLED)))
                found.append(shown)
                if len(asked) >= 2000:
                    count()
        count()
        if counts:
            yield {
                "fit": [key[0] for key in counts], "kinds": [key[1] for key in counts],
                "bin": [key[2] for key in counts], "n": list(counts.values())}

    rows = arrow_map(docs.select(text_col), judge, "fit boolean, kinds string, bin int, n long")
    rows = rows.groupBy("fit", "kinds", "bin").agg(F.sum("n").alias("n"))
    return [tuple(row) for row in rows.orderBy("fit", "kinds", "bin").collect()]


def calibrate(rows: list[tuple], network: CharCNN, recall: float = RECALL) -> SecretModel:
    """Calibration over the candidates outside the fit; the threshold keeps the recall of every kind.

    A label or kind that the fit holds whole is judged by its rows in the fit.
    """

    def outside(chosen: list[tuple]) -> list[tuple]:
        return [row for row in chosen if not row[0]] or chosen

    rows = [row for row in rows if row[1] != UNLABELLED]
    good, bad = outside([row for row in rows if row[1]]), outside([row for row in rows if not row[1]])
    logits = np.array([row[2] / BINS for row in good + bad])
    labels = np.repeat([1.0, 0.0], [len(good), len(bad)])
    slope, offset = platt(logits, labels, weights=np.array([float(row[3]) for row in good + bad]))
    limits = []
    for kind in KINDS:
        of_kind = outside([row for row in rows if kind in row[1].split(",")])
        if of_kind:
            scores = calibrated(np.array([row[2] / BINS for row in of_kind]), slope, offset)
            counts = np.array([row[3] for row in of_kind])
            limits.append(recall_threshold(scores, np.ones(len(scores)), recall, counts))
    return SecretModel(network, slope, offset, min(limits))


_ALPHABETS = (
    "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyz0123456789",
    *2 * ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",),
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_TAGS = ("", "", "", "key_", "gh_", "pk-", "x.", "id:")


def respelled(good: list[str], contexts: list[str], each: int = 3, seed: int = 2) -> list[str]:
    """Findings with other letters of other alphabets, lengths and places, so that no one make stands for all keys."""
    draw = np.random.default_rng(seed)
    found = []
    for window in good:
        for _ in range(each):
            alphabet = list(_ALPHABETS[draw.integers(len(_ALPHABETS))])
            key = _TAGS[draw.integers(len(_TAGS))] + "".join(draw.choice(alphabet, int(draw.integers(12, 41))))
            other = contexts[draw.integers(len(contexts))] if contexts and draw.random() < 0.7 else window
            before = other[:BEFORE - 3] + ("   ", " = ", ": \"", " '")[draw.integers(4)]
            found.append(before[-BEFORE:].rjust(BEFORE, "\0") + key + other[BEFORE:])
    return [window[:WIDTH] for window in found]


def ordinary_runs(contexts: list[str], seed: int = 3) -> list[str]:
    """Addresses, links, paths, dates and joined words made of the words of the documents."""
    draw = np.random.default_rng(seed)
    bag = [word for window in contexts for word in _WORD.findall(window) if word.isascii()] or ["word"]
    makes = (
        "{0}.{1}{n}@{2}.com", "{0}{n}@{1}.example.org", "{0}_{1}@{2}-{3}.net", "https://{0}.{1}.com/{2}/{n}/{3}-{4}",
        "www.{0}.com/{1}?{2}={n}", "{0}-{1}-{2}-{n}", "/{0}/{1}/{2}.{3}", "{y}-{m:02d}-{d:02d}T{m:02d}:{d:02d}", "{0}_{1}_{2}{n}",
        "+{y}-{n}-{m}{d}{y}", "v{m}.{d}.{n}-{0}", "{0}/{1}/{n}", "{0}{n}.{1}@{2}.{3}.com", "//{0}.{1}/{y}/{m:02d}/{2}-{3}-{n}",
        "{n}.{m}.{d}.{n}", "1{d}.2{m}.{n}.{d}", "{0}{n}@{1}{m}.{2}.com", "{0}.{n}@{1}{d}.{2}.com", "{0}-{1}@{2}.net")
    found = []
    for k, window in enumerate(contexts):
        lower = [bag[i].lower() for i in draw.integers(len(bag), size=5)]
        run = makes[k % len(makes)].format(
            *lower, n=int(draw.integers(1000)), y=int(draw.integers(1980, 2030)), m=int(draw.integers(1, 13)), d=int(draw.integers(1, 29)))
        found.append(window[:BEFORE - 1].rjust(BEFORE - 1, "\0") + " " + run + " " + window[BEFORE:])
    return [window[:WIDTH] for window in found]


def train(docs: DataFrame, text_col: str = "text", recall: float = RECALL) -> SecretModel | None:
    """A model of the findings of the fixed patterns in all documents, however few they are.

    Candidates that overlap a finding are positive, with and without their keyword or
    prefix, and once more respelled in other alphabets and places. Those with an ordinary structure and, where these are few, words are negative;
    the others have no label and take no part in the fit. Addresses, links and joined
    words made of the documents' words are further negatives. The network is fitted on a bounded sample, less a third of
    it; calibration and threshold come from every candidate outside the fit, in all
    documents. Without any positive candidate nothing can be learned: the result is None,
    and a scan then has base spans only.
    """
    found = sample(docs, text_col)
    good, bad = found[POSITIVE], found[NEGATIVE]
    if not good:
        return None
    bad = bad + found[WORD][:max(max(WORDS, len(good)) - len(bad), 0)]
    good, bad = ([row for k, row in enumerate(rows) if k % 3 != 2] for rows in (good, bad))
    contexts = found[WORD]
    keys = good + respelled(good * -(-WORDS // len(good)), contexts)
    runs = ordinary_runs((contexts or [""]) * -(-2 * len(keys) // max(len(contexts), 1)))[:2 * len(keys)]
    others = bad + contexts[:len(keys)] + runs
    labels = np.repeat([1, 0], [len(keys), len(others)]).astype(np.float32)
    batches = max(len(labels) // 64, 1)
    network = fit(codes(keys + others), labels, epochs=max(6, -(-STEPS // batches)))
    return calibrate(histogram(docs, network, frozenset(good + bad), text_col), network, recall)


def scan(
    docs: DataFrame, model: SecretModel | None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, the counts, base and all spans; a null text counts as empty.

    The network judges every candidate that no base span overlaps; kind ``learned``
    marks what it adds. Base spans always stay. A model of None, which ``train`` gives for
    documents without any positive candidate, adds nothing.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def find(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = [text or "" for text in batch.column(1).to_pylist()]
        base = [base_spans(text) for text in texts]
        added: list[list[Span]] = [[] for _ in texts]
        if model is not None:
            asked: list[tuple[int, int, int]] = []
            found: list[list[str]] = []

            def judge() -> None:
                for (row, start, end), score in zip(asked, model.scores(found)):
                    if score >= model.threshold:
                        added[row].append(("learned", start, end))
                asked.clear()
                found.clear()

            for row, text in enumerate(texts):
                known = _Covered(base[row])
                for start, end in candidates(text):
                    if not known.meets(start, end):
                        asked.append((row, start, end))
                        found.append(windows(text, start, end))
                        if len(asked) >= 2000:
                            judge()
            judge()
        order = {name: k for k, name in enumerate((*KINDS, "learned"))}
        everything = [sorted(b + a, key=lambda span: (span[1], order[span[0]])) for b, a in zip(base, added)]
        counts = {f"n_{k}": [sum(span[0] == k for span in b) for b in base] for k in KINDS}
        yield {"doc": batch.column(0), **counts, "base": [joined(b) for b in base], "spans": [joined(e) for e in everything]}

    return arrow_map(
        docs.select(id_col, text_col), find,
        f"doc {kind}, n_assign long, n_access long, n_hex long, base string, spans string",
    ).withColumnRenamed("doc", id_col)


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return scan(docs, train(docs)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")
