"""The prefix trie against plain dictionaries of prefixes."""

import hashlib
import random
import zlib

import pytest
from fixture import ordered

from meseta.llm import prefix_trie as trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn int, role string, text string, path string, depth string, head string, n int"


def plain_nodes(paths: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for conv, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    found = []
    for prefix, convs in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        kids = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(paths[c]) == len(prefix)))
        parent = min(members[prefix[:-1]]) if prefix else None
        found.append((min(convs), len(prefix), parent, len(convs), len(kids), len(leaves), saved,
                      hashlib.sha256(ends.encode()).hexdigest()))
    return found


def by_conversation(rows) -> dict[int, list[tuple[str, str]]]:
    turns: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [row[2:] for row in sorted(found)] for conv, found in turns.items()}


def conversations(spark, rows):
    return spark.createDataFrame([(*row, "p", "d", "h", 1) for row in rows], SCHEMA)


def nodes(spark, rows, limit):
    found = trie.prefix_trie(trie.paths(conversations(spark, rows)), container_turns=limit)
    assert found.columns == COLUMNS
    return ordered(found.collect())


AWKWARD = [
    (1, 0, "user", "a"), (1, 1, "assistant", None), (2, 0, "user", "a"), (2, 1, "assistant", ""), (3, None, None, "é"),
    (3, None, None, "é"), (3, 0, "user", "a"), (-4, 0, "us", "era"), (-4, 0, "user", "a"), (None, 0, "user", "lost"),
    (5, 0, "user", "x" * 100_000), (2 ** 40, 7, "user", "a"), (6, 2, "b", "2"), (6, 2, "b", "1"), (6, 2, "a", "3")]


@pytest.mark.parametrize("limit", [1, 4, 1000])
def test_awkward_turns(spark, limit):
    assert nodes(spark, AWKWARD, limit) == ordered(plain_nodes(by_conversation(AWKWARD)))


@pytest.mark.parametrize("seed,limit", [(1, 1), (2, 5), (3, 40), (4, 10_000)])
def test_random_tries(spark, seed, limit):
    draw = random.Random(seed)
    rows, conv = [], 0
    for _ in range(60):  # few different turns, so that prefixes are shared and conversations repeat
        conv += draw.randint(1, 9)
        rows += [(conv, k, "user", draw.choice("abé")) for k in range(draw.randint(1, 6))]
    for k in range(40):  # one conversation, recorded again after each turn
        rows += [(10_000 + k, at, "user", f"t{at}") for at in range(k)]
    assert nodes(spark, rows, limit) == ordered(plain_nodes(by_conversation(rows)))


def test_few_rounds_however_long_the_common_opening(spark, monkeypatch):
    rounds = []
    path_nodes = trie._path_nodes
    monkeypatch.setattr(trie, "_path_nodes", lambda *args: rounds.append(1) or path_nodes(*args))
    rows = [(conv, at, "user", f"t{at}" if at < 150 else f"{conv}-{at}") for conv in range(20) for at in range(155)]
    found = nodes(spark, rows, 20)
    assert found == ordered(plain_nodes(by_conversation(rows)))
    assert len(rounds) <= 3


def test_no_conversations(spark):
    assert nodes(spark, [], 10) == []
    assert nodes(spark, [(None, 0, "user", "a")], 10) == []


def test_member_digests_of_many_sparse_ids(spark):
    ids = [k * 40_000 - 5 for k in range(50)]
    members = spark.createDataFrame([(b"s", conv) for conv in ids] + [(b"t", 3)], "seq binary, conv long")
    found = {bytes(row["seq"]): row["ends"] for row in trie.member_digests(members.repartition(7)).collect()}
    assert found == {b"s": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     b"t": hashlib.sha256(b"3").hexdigest()}


def test_shared_openings(spark):
    rows = [(conv, k, "user", f"{conv}:{k}") for conv in (0, 1, 2, 3, 4, 6, 7, 10, 12, 13, 29) for k in range(conv % 7)]
    own = by_conversation(rows)
    expected = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 9
        expected[conv] = own.get(conv - conv % 5, [])[:h] + own[conv][h:]
    assert any(not turns for turns in expected.values())
    found = trie.prefix_trie(trie.shared_openings(trie.paths(conversations(spark, rows))), container_turns=10)
    assert ordered(found.collect()) == ordered(plain_nodes(expected))
