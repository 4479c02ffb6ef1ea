"""Benchmark decontamination against windows compared one by one."""

import hashlib
import re

import pytest
from fixture import documents, ordered, words

from meseta.llm import decontamination as leak

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, items, window=10):
    windows: dict[tuple, set] = {}
    for item, text in items:
        found = WORD.findall((text or "").translate(LOWER))
        width = min(window, len(found))
        for at in range(len(found) - width + 1 if width else 0):
            windows.setdefault(tuple(found[at:at + width]), set()).add("" if item is None else str(item))
    out = []
    for doc, text, _ in rows:
        found = WORD.findall((text or "").translate(LOWER))
        hit, ids = set(), set()
        for at in range(len(found)):
            for width in range(1, min(window, len(found) - at) + 1):
                owners = windows.get(tuple(found[at:at + width]))
                if owners:
                    hit |= set(range(at, at + width))
                    ids |= owners
        out.append((doc, len(found), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()))
    return out


PASSAGE = words(25, 77)
ITEMS = [(1, PASSAGE), (2, "What IS the answer?"), (3, None), (4, "...!!"), (None, "only here été"), (12, PASSAGE + " more words"),
         (2, "another row of item two with rather more than ten words in it, so windows"), (100, "answer")]
ROWS = [
    (1, "before " + PASSAGE.upper().replace("É", "é").replace("Ñ", "ñ") + " after", "a"), (2, None, "a"), (3, "", "a"), (4, "?! .", "a"),
    (5, "so: what is\nthe-ANSWER, and what is the", "a"), (6, " ".join(PASSAGE.split()[5:16]), "b"),
    (7, " ".join(PASSAGE.split()[:9]), "b"), (7, " ".join(PASSAGE.split()[:9]), "b"), (None, "only\there... Été ÉTÉ été", "c"),
    (8, (words(300, 5) + " ") * 40 + PASSAGE + " tail", "c"), (9, "x" * 50_000, "c"),
    (10, "another row of item two with rather more than ten words in it so windows", "a")]


def found(spark, **options):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = leak.scan(documents(spark, ROWS), items, **options)
    return ordered(
        (row["doc_id"], row["leaks"]["n_words"], row["leaks"]["n_hit"], len(row["leaks"]["items"]),
         hashlib.sha256(",".join(row["leaks"]["items"]).encode()).hexdigest()) for row in rows.collect())


def test_equals_plain_windows(spark):
    assert found(spark) == ordered(plain(ROWS, ITEMS))


def test_blocks_of_patterns_give_the_same(spark):
    assert found(spark, block_words=60) == ordered(plain(ROWS, ITEMS))


def test_chunks_of_a_text_give_the_same(monkeypatch):
    machine = leak.Automaton([" ".join(PASSAGE.lower().split()[at:at + 10]) for at in range(16)], [["1"]] * 16)
    text = words(200, 3) + " " + PASSAGE + " " + words(200, 4)
    whole = machine.scan(text)
    for size in (1, 7, 64):
        chunks = leak.word_chunks
        monkeypatch.setattr(leak, "word_chunks", lambda text, size=size: chunks(text, size))
        assert machine.scan(text) == whole
        monkeypatch.setattr(leak, "word_chunks", chunks)


def test_spans_are_those_of_the_original(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for row in leak.scan(documents(spark, ROWS), items).collect():
        for span in row["leaks"]["spans"]:
            part = row["text"][span["start"]:span["end"]].translate(LOWER)
            assert len(WORD.findall(part)) == span["word_to"] - span["word_from"]
            assert WORD.fullmatch(part[0]) and WORD.fullmatch(part[-1])


def test_empty_tables_and_columns_that_stay(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, ROWS).withColumnRenamed("body", "leaks")
    kept = leak.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    clean = [row[0] for row in plain(ROWS, ITEMS) if row[2] == 0]
    assert ordered([row["doc_id"]] for row in kept.collect()) == ordered([doc] for doc in clean)
    assert leak.drop_contaminated(docs, none).count() == len(ROWS)
    assert leak.drop_contaminated(docs.limit(0), items).count() == 0
    with pytest.raises(ValueError, match="exists already"):
        leak.scan(docs, items)
