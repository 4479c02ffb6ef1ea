"""Packing, token counts, chat formatting and mixing."""

import zlib

import numpy as np
import pandas as pd
import pytest
from fixture import CLASHING, WORD, documents, texts
from pyspark.sql import functions as F

from meseta.llm import chat, cutting_stock, mixing, packing, tokens


@pytest.fixture(scope="module")
def encoder():
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokens.default_vocabulary())
    return lambda text: slow.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_reference_library(encoder):
    fast = tokens.Encoder(tokens.default_vocabulary())
    for text in [t or "" for _, t, _ in texts()] + [
            "<|endoftext|> a<|endoftext|>", "it's we'll 'S", "   x  y\n\n\n z \t", "日本語 \U0001f600‍", "a" * 3000,
            " " * 5000, "\x00\x01\x7f", "é"]:
        assert fast.ids(text) == encoder(text)


def check_packing(found: pd.DataFrame, rows, encoder, length=2048):
    lengths = {}
    for doc, text, _ in rows:
        ids = np.array([*encoder(text or ""), 1], "<u4")
        parts = found[found["doc_id"].isna() if doc is None else found["doc_id"] == doc]
        parts = parts[parts["doc_tokens"] == len(ids)]
        assert len(parts)
        for row in parts.itertuples():
            piece = ids[row.start:row.start + row.length]
            lengths.setdefault(doc, set()).add((row.start, row.length))
            if doc is not None:
                assert zlib.crc32(piece.tobytes()) == row.ids_crc32
    for _, one in found.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert (one["offset"] == one["length"].cumsum() - one["length"]).all()
        assert one["length"].sum() <= length


def test_packing(spark, encoder):
    rows = texts()
    found = packing.pack(documents(spark)).toPandas()
    check_packing(found, rows, encoder)
    total = sum(len(encoder(text or "")) + 1 for _, text, _ in rows)
    assert found["length"].sum() == total
    assert packing.pack(documents(spark).limit(0)).count() == 0


def test_packing_pads_little_and_sequences_hold_the_ids(spark, encoder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    placed = packing.pack(docs).cache()
    found = placed.toPandas()
    used = found.groupby("sequence_id")["length"].sum()
    padded = used[[n & (n - 1) != 0 for n in used]]
    assert (2048 - padded).sum() <= 0.01 * used.sum()
    pieces = found.groupby("doc_id")["length"].sum()
    assert (pieces == found.groupby("doc_id")["doc_tokens"].first()).all()
    one = found[found["doc_id"] == 3].sort_values("start")
    text = docs.where("doc_id = 3").first()["text"]
    sequences = {r["sequence_id"]: r["input_ids"] for r in packing.sequences(docs, placed).where(
        f"sequence_id IN ({','.join(map(str, one['sequence_id']))})").collect()}
    back = [i for row in one.itertuples() for i in sequences[row.sequence_id][row.offset:row.offset + row.length]]
    assert back == [*encoder(text), 1]
    placed.unpersist()


@pytest.mark.parametrize("tokens_each", [3, 5, 33, 200, 257])
def test_equal_texts_are_padded_little(spark, tokens_each):
    cut = spark.range(20_000).select(
        F.lit(None).cast("long").alias("doc"), F.lit(0).cast("long").alias("start"),
        F.lit(tokens_each).cast("long").alias("n"), F.col("id").alias("crc"), F.lit(tokens_each).cast("long").alias("doc_tokens"))
    found = packing.place(cut).toPandas()
    assert len(found) == 20_000
    for _, one in found.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert (one["offset"] == one["n"].cumsum() - one["n"]).all()
    used = found.groupby("sequence_id")["n"].sum()
    assert used.max() <= 2048
    fewest = -(-20_000 // (2048 // tokens_each))
    assert len(used) <= fewest * (1.01 if tokens_each < 33 else 1.04) + 1


def test_special_tokens_inside_texts_are_those_of_the_library(spark, encoder):
    text = "a </s> b <s> <|endoftext|> <pad>"
    rows = [(1, text, "a"), (2, "plain", "a")]
    found = packing.pack(documents(spark, rows)).toPandas()
    check_packing(found, rows, encoder)
    lengths = tokens.encoded_lengths(documents(spark, rows), tokens.default_vocabulary()).collect()
    assert sorted(row["n_tokens"] for row in lengths) == sorted(len(encoder(t)) for _, t, _ in rows)


def test_mix_of_text_ids_and_taken_names(spark):
    docs = documents(spark).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    repeated = mixing.repeat_documents(docs)
    assert repeated.columns == docs.columns and dict(repeated.dtypes)["doc_id"] == "string"
    row = repeated.first()
    assert all(row[name] == name for name in CLASHING)


def test_knapsack_and_plan():
    widths, values = np.array([3, 5, 7]), np.array([2.0, 4.5, 6.0])
    best = max(
        (a * 2 + b * 4.5 + c * 6, a, b, c) for a in range(7) for b in range(5) for c in range(3)
        if 3 * a + 5 * b + 7 * c <= 20)
    assert cutting_stock.knapsack(values, widths, 20)[0] == pytest.approx(best[0])
    draw = np.random.default_rng(0)
    sizes = sorted({int(s) for s in draw.integers(1, 60, 40)})
    demand = [int(d) for d in draw.integers(1, 500, len(sizes))]
    plan = cutting_stock.plan(sizes, demand, 100)
    made = dict.fromkeys(sizes, 0)
    for pattern, times in plan:
        assert sum(w * n for w, n in pattern.items()) <= 100
        for w, n in pattern.items():
            made[w] += n * times
    assert made == dict(zip(sizes, demand))
    assert sum(times for _, times in plan) <= 1.01 * sum(w * d for w, d in zip(sizes, demand)) / 100 + len(sizes)
    assert cutting_stock.plan([], [], 100) == []


def test_length_histogram(spark, encoder):
    counts = sorted(len(encoder(text or "")) for _, text, _ in texts())
    histogram = tokens.length_histogram(tokens.encoded_lengths(documents(spark), tokens.default_vocabulary())).cache()
    for row in histogram.collect():
        limit = row["n_tokens"]
        assert row["n_docs"] == counts.count(limit)
        assert row["docs_from"] == sum(n >= limit for n in counts)
        assert row["tokens_from"] == sum(n for n in counts if n >= limit)
        assert row["tokens_kept"] == sum(min(n, limit) for n in counts)
        assert row["tokens_cut"] == sum(counts) - row["tokens_kept"]
    for limit in (0, 1, 17, 100, 10 ** 6):
        assert tokens.truncated_total(histogram, limit) == sum(min(n, limit) for n in counts)
    assert tokens.quantile(histogram, 0.5) == counts[-(-len(counts) // 2) - 1]
    empty = tokens.length_histogram(tokens.encoded_lengths(documents(spark).limit(0), tokens.default_vocabulary()))
    assert empty.count() == 0 and tokens.truncated_total(empty, 5) == 0 and tokens.quantile(empty, 0.5) is None
    histogram.unpersist()


def test_escape_round_trip():
    for text in [*chat.CONTROLS, "\\", "<\\|end|>", "\\\\<|end|>\\", "a\n<|turn|>b", "", "<<|end|>"]:
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text and not any(c in escaped for c in chat.CONTROLS)


def test_visitor_keeps_order_references_and_tokens():
    flat = chat.Flattener().flatten([
        {"type": "text", "text": "see <|en"}, {"type": "text", "text": "d|>"},
        {"type": "image", "ref": "i.png", "width": 57, "height": 28},
        {"type": "document", "ref": "d.pdf", "parts": [{"type": "text", "text": "in"}, {"type": "audio", "ref": "a", "seconds": 1.5}]},
        {"type": "document", "ref": "e.pdf", "pages": 3}, {"type": "video", "ref": "v"}, {}])
    assert [(a.kind, a.ref, a.tokens) for a in flat.attachments] == [
        ("image", "i.png", 3), ("document", "d.pdf", 0), ("audio", "a", 38), ("document", "e.pdf", 1536), ("video", "v", 1)]
    assert all(flat.body[a.at:].startswith(chat.SLOT + a.kind) for a in flat.attachments)
    assert flat.body.startswith("see <\\|end|>")


def test_chat_of_awkward_turns(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a</s>\\"), (1, 1, "assistant", "b"), (None, None, None, "x"),
            (2, 5, "assistant", "<|end|>\n<|turn|>"), (2, None, "system", "")]
    turns = spark.createDataFrame(rows, "conv long, turn long, role string, text string").selectExpr(
        "conv", "turn", "role",
        "array(named_struct('type', 'text', 'text', text, 'ref', '', 'width', 0, 'height', 0, 'seconds', 0D, 'pages', 0)) AS parts")
    found = {r["conv"]: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in found.items()} == {1: (3, 7), None: (1, 0), 2: (2, 16)}
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


def expected_targets(sizes: dict, weights=(5, 2, 1), limit=3.0) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, full = {}, set()
    while True:
        free = sum(sizes.values()) - sum(limit * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: limit * sizes[s] if s in full else free * weight[s] / share for s in names}
        over = {s for s in names if s not in full and target[s] > limit * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixing(spark):
    rows = texts()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    target = expected_targets(sizes)
    docs = documents(spark)
    found = mixing.mix(docs).toPandas()
    assert len(found) == len(rows)
    assert (found["taken"] <= 3 * found["size"]).all() and (found["taken"] % found["size"].clip(lower=1) == 0).all()
    for source, size in sizes.items():
        assert found[found["source_size"] == size]["target"].iloc[0] == pytest.approx(target[source])
    key = ["doc_id", "salt", "copies"]
    again = mixing.mix(docs.repartition(5)).toPandas()
    assert found[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))
    repeated = mixing.repeat_documents(docs)
    assert repeated.columns == docs.columns and repeated.count() == found["copies"].sum()
    assert mixing.mix(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [64, 3])
def test_mix_meets_targets_at_every_depth_of_the_tree(spark, block):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = mixing.mix(docs, block=block).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    by_source = found.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), most=("size", "max"))
    assert ((by_source["taken"] - by_source["target"]).abs() <= by_source["most"]).all()
    ratio = found["copies"] - (found["target"] / found["source_size"])
    assert (ratio.abs() < 1).all()


def test_mixing_uses_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
