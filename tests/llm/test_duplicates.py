"""Exact and near duplicates, and repeated passages, against plain versions."""

import hashlib

import numpy as np
import pytest
from fixture import LOWER, documents, near_components, ordered, texts, without_repeats
from hypothesis import given, settings
from hypothesis import strategies as st

from meseta.llm import anchors, exact_dedup, interval_tree, near_dedup, repeats
from meseta.llm.components import components
from meseta.session import scratch_path


def index_of(spark, buckets=4):
    return exact_dedup.DigestIndex(spark, scratch_path(spark, "test-index"), buckets)


def test_exact_dedup(spark):
    rows = texts()
    groups = {}
    for doc, text, _ in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc)
    expected = set()
    for doc, text, _ in rows:
        key = (text or "").translate(LOWER)
        ids = groups[key]
        keep = max((i for i in ids if i is not None), default=None)
        expected.add((doc, keep, len(ids), doc == keep, hashlib.sha256(key.encode()).hexdigest()))
    found = exact_dedup.exact_dedup(documents(spark), index_of(spark)).drop("n_rows").collect()
    assert ordered(found) == ordered(expected)


def test_index_outlives_its_object_and_keeps_the_first(spark):
    path = scratch_path(spark, "test-index")
    first = exact_dedup.with_digest(spark.createDataFrame([(1, "A"), (2, "b")], "doc_id long, text string"))
    second = exact_dedup.with_digest(spark.createDataFrame([(9, "a"), (8, "c")], "doc_id long, text string"))
    for batch in (first, second):
        exact_dedup.DigestIndex(spark, path, 4).add(batch.withColumnRenamed("__digest", "digest"))
    rows = exact_dedup.DigestIndex(spark, path, 4).rows()
    assert {row["keep_id"] for row in rows.collect()} == {1, 2, 8}


def test_index_is_read_by_bucket_and_not_shuffled(spark):
    index = index_of(spark)
    batch = exact_dedup.with_digest(spark.createDataFrame([(1, "A")], "doc_id long, text string"))
    firsts = batch.select("__digest", "doc_id").toDF("digest", "keep_id")
    index.add(firsts, "keep_id")
    plan = index.unseen(firsts)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan


def test_drop_copies_keeps_columns_and_one_row_each(spark):
    docs = documents(spark)
    kept = exact_dedup.drop_copies(docs, index_of(spark))
    assert kept.columns == docs.columns
    found = [row["text"] for row in kept.collect()]
    assert len(found) == len({(t or "").translate(LOWER) for _, t, _ in texts()})


def test_near_dedup(spark):
    expected = [(d, n, c, d == c) for d, n, c in near_components(texts())]
    found = near_dedup.near_dedup(documents(spark)).drop("text_sum").collect()
    assert ordered(found) == ordered(expected)


def test_near_dedup_compares_members_that_their_band_left_apart(spark):
    """A chain: neighbours are alike, the ends are not, and blocks of two force many block pairs."""
    from fixture import words

    tokens = words(300, 77).split()
    rows = [(k, " ".join(tokens[6 * k:6 * k + 80]), "a") for k in range(12)]
    rows += [(50 + k, " ".join(tokens[200:290]) + f" tail{k}", "a") for k in range(8)]
    expected = [(d, n, c, d == c) for d, n, c in near_components(rows)]
    found = near_dedup.near_dedup(documents(spark, rows), block=2).drop("text_sum").collect()
    assert ordered(found) == ordered(expected)


def test_drop_near_copies(spark):
    docs = documents(spark)
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(row["doc_id"]) for row in kept.select("doc_id").collect())
    expected = {str(d) for d, _, c in near_components(texts()) if d == c}
    assert set(ids) == expected and ids.count("25") == 1


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (5, 5)]
    found = {row["node"]: row["label"] for row in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**dict.fromkeys(range(1, 41), 1), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}


@pytest.mark.parametrize("group", [4096, 2])
def test_repeats(spark, group):
    found = repeats.drop_repeats(documents(spark), group=group).collect()
    found = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
             for r in found]
    assert ordered(found) == ordered(without_repeats(texts()))


@pytest.mark.parametrize("group", [4096, 2])
def test_repeats_that_begin_or_end_at_a_cut(spark, group):
    """Passages whose windows lie on one side of a cut, where both sides choose the same anchor."""
    draw, cut = np.random.default_rng(7), 1000

    def text(n):
        return draw.integers(97, 123, n).astype(np.uint8).tobytes().decode()

    rows, sides = [], 0
    for k in range(16):
        body = text(2600)
        found = anchors.anchors(body.encode(), segment=cut)
        at = [a for a in (1, 2) if (found.place == found.place[np.searchsorted(found.place - found.left, a * cut)]).sum() > 1]
        sides += len(at)
        rows.append((3 * k, body, "a"))
        for a in at or [1]:
            rows.append((3 * k + 1, text(30) + body[a * cut - 40:a * cut + 199 - k] + text(90), "a"))
            rows.append((3 * k + 2, text(50) + body[a * cut + k:a * cut + 230] + text(70), "a"))
    assert sides > 8
    rows.append(rows[0])
    found = repeats.drop_repeats(documents(spark, rows), group=group, segment=cut).collect()
    found = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
             for r in found]
    assert ordered(found) == ordered(without_repeats(rows))


def test_repeat_groups_hold_all_occurrences(spark):
    from fixture import words

    shared = words(60, 5)
    rows = [(k, words(20, 100 + k) + shared + words(20, 200 + k), "a") for k in range(5)]
    bodies = repeats._bodies(documents(spark, rows), "doc_id", "text")
    _, contexts = repeats.repeated_spans(bodies)
    groups = repeats.repeat_groups(contexts, 200).collect()
    assert max(len(row["occurrences"]) for row in groups) == 5
    whole = {doc: text.encode() for doc, text, _ in rows}
    for row in groups:
        assert len({whole[o["doc"]][o["first"]:o["first"] + row["length"]] for o in row["occurrences"]}) == 1


def test_windows_of_long_texts_do_not_depend_on_the_cut():
    text = np.random.default_rng(1).integers(97, 101, 6000).astype(np.uint8).tobytes()
    whole, cut = anchors.anchors(text), anchors.anchors(text, segment=700)
    assert set(whole.place) == set(cut.place)
    owned = np.zeros(len(text), int)
    for p, left, right in zip(cut.place, cut.left, cut.right):
        owned[p - left:p + right - 199] += 1
    assert (owned[:len(text) - 199] == 1).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=6), st.text("ab", max_size=6)), min_size=2, max_size=7), st.integers(2, 8))
def test_interval_tree_finds_the_longest_repeat_of_every_member(parts, least):
    lefts, rights = [a.encode() for a, _ in parts], [("c" + b).encode() for _, b in parts]
    cover = [set() for _ in parts]
    for before, after, members in interval_tree.maximal_repeats(lefts, rights, least):
        assert len(members) > 1 and before + after >= least
        assert len({lefts[m][:before] for m in members}) == len({rights[m][:after] for m in members}) == 1
        for m in members:
            cover[m] |= set(range(-before, after))
    for m in range(len(parts)):
        expected = set()
        for o in range(len(parts)):
            if o != m:
                before = interval_tree.common(lefts[m], lefts[o])
                after = interval_tree.common(rights[m], rights[o])
                if before + after >= least:
                    expected |= set(range(-before, after))
        assert cover[m] == expected
