"""Quality classifier, quality rules and secret scans."""

import hashlib
import zlib

import numpy as np
import pytest
from fixture import WORD, documents, ordered, texts

from meseta.llm import char_cnn, decision_list, quality_model, quality_rules, secret_scan

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))


def test_quality_on_held_out_rows(spark, tables):
    docs, labels = tables
    rows = quality_model.op7_quality_mil(spark, FOLDER).join(labels, "doc_id").toPandas()
    assert (rows["held_out"] == [zlib.crc32(str(d).encode()) % 4 == 2 for d in rows["doc_id"]]).all()
    held = rows[rows["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() >= 0.97
    assert ((rows["score"] >= 0.7) == (rows["predicted"] == 1)).all()


def test_quality_of_awkward_texts(spark, tables):
    model = quality_model.quality_model(*tables)
    docs = documents(spark)
    rows = quality_model.score(docs, model).collect()
    assert len(rows) == len(texts()) and all(0 <= row["__score"] <= 1 for row in rows)
    again = {row["text"]: row["__score"] for row in quality_model.score(docs.repartition(3), model).collect()}
    assert all(again[row["text"]] == pytest.approx(row["__score"], abs=1e-5) for row in rows)
    assert quality_model.good_documents(docs, tables[1]).columns == docs.columns
    assert quality_model.score(docs.limit(0), model).count() == 0


def test_gradients_of_attention():
    draw = np.random.default_rng(0)
    x, counts, labels = draw.normal(size=(7, 5)), np.array([3, 1, 3]), np.array([1.0, 0, 1])
    model = quality_model.AttentionModel.start(5, 4, 3)
    for name in model.__dataclass_fields__:
        setattr(model, name, getattr(model, name).astype(float))

    def loss():
        h, _, _, logits = model.encode(x)
        p = model.scores(h, logits, counts)
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for name, gradient in zip(model.__dataclass_fields__, model.gradients(x, counts, labels)):
        value = getattr(model, name)
        at = tuple(draw.integers(0, n) for n in value.shape)
        old = value[at]
        value[at] = old + 1e-5
        high = loss()
        value[at] = old - 1e-5
        low = loss()
        value[at] = old
        assert gradient[at] == pytest.approx((high - low) / 2e-5, abs=1e-6)


def test_labels_outside_the_sample_rule_are_not_read(spark, tables):
    docs, labels = tables
    none = labels.where(quality_model.held_out())
    bags, found = quality_model.labelled_bags(docs, none, "quality")
    assert not bags and not len(found)
    assert quality_model.quality_model(docs, none) is not None


def _counts(text):
    found = WORD.findall(text)
    windows = [tuple(found[k:k + 3]) for k in range(len(found) - 2)]
    inside = set()
    for k, window in enumerate(windows):
        if windows.count(window) > 1:
            inside |= {k, k + 1, k + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(inside))


def test_rule_statistics(spark):
    rows = [row for row in texts() if len(row[1] or "") < 20_000]
    found = quality_rules.statistics(documents(spark, rows)).select("doc_id", *quality_rules.COUNTS[:5]).collect()
    assert ordered(found) == ordered((doc, *_counts(text or "")) for doc, text, _ in rows)


def test_rules_keep_good_documents(spark, tables):
    rows = quality_rules.op9_quality_rules(spark, FOLDER).join(tables[1], "doc_id").toPandas()
    base = (rows["n_words"] < 50) | (100 * rows["n_repeat_words"] > 50 * rows["n_words"])
    assert (rows["base_failed"] == base).all()
    assert rows[(rows["quality"] == 1) & ~base]["kept"].mean() >= 0.97
    assert rows[rows["quality"] == 0]["kept"].mean() <= 0.2


def test_rules_without_labels_and_rows(spark, tables):
    docs = documents(spark)
    assert quality_rules.learn_rules(docs, tables[1].limit(0)) == []
    judged = quality_rules.judge(quality_rules.statistics(docs), [])
    assert judged.where("kept = base_failed").count() == 0
    assert quality_rules.statistics(docs.limit(0)).count() == 0


def test_covering_finds_a_conjunction_and_its_expression(spark):
    draw = np.random.default_rng(1)
    table = {"a": draw.random(3000), "b": draw.random(3000)}
    bad = (table["a"] > 0.7) & (table["b"] < 0.4)
    rules = decision_list.sequential_covering(table, bad)
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in zip(table["a"], table["b"])], "a double, b double")
    judged = [row["r"] is not None for row in frame.select(decision_list.verdict(rules).alias("r")).collect()]
    assert (np.array(judged) == bad).mean() >= 0.98


def test_base_spans():
    text = 'Token= "abc/def+ghi=jkl" ſecret=abcdefghijklmn é AKIAABCDEFGHIJKLMN0 deadbeefdeadbeef00 token=x'
    spans = secret_scan.base_spans(text)
    assert [s[0] for s in spans] == ["assign", "access", "hex"]
    assert [text[a:b] for _, a, b in spans][1:] == ["AKIAABCDEFGHIJKLMN0", "deadbeefdeadbeef00"]
    # a match that is too short is dropped together with what it covered
    assert secret_scan.base_spans("secret:token:abcdefghijkl1") == []


def test_covered_ranges():
    spans = [("hex", 5, 9), ("assign", 7, 12), ("hex", 20, 22)]
    known = secret_scan._Covered(spans)
    for start in range(25):
        for end in range(start + 1, 26):
            assert known.meets(start, end) == any(s < end and start < e for _, s, e in spans)


def test_secret_scan(spark, tables):
    model = secret_scan.train(tables[0].unionByName(tables[0]))
    found = {row["doc_id"]: row for row in secret_scan.scan(documents(spark), model).collect()}
    assert (found[23]["n_assign"], found[23]["n_access"], found[23]["n_hex"]) == (2, 1, 1)
    for doc, text, _ in texts():
        if doc is not None:
            base = secret_scan.base_spans(text or "")
            assert found[doc]["base"] == secret_scan.joined(base)
            assert set(found[doc]["spans"].split(",")) >= set(found[doc]["base"].split(","))
    assert secret_scan.train(tables[0].limit(0)) is None
    assert secret_scan.scan(documents(spark).limit(0), None).count() == 0


@pytest.mark.parametrize("findings", [1, 7])
def test_few_findings_among_many_documents_still_train_the_network(spark, findings):
    key = "Zx9Qk27LmP4tVb81"
    rows = [(k, f"nothing of note stands in this text of number {k}", "a") for k in range(300)]
    rows += [(None, f"the secret = {hashlib.sha256(str(k).encode()).hexdigest()} of it", "a") for k in range(findings)]
    rows += [(900, f"the secert = {key}{hashlib.md5(b'x').hexdigest().upper()} of it", "a")]
    docs = documents(spark, rows)
    model = secret_scan.train(docs)
    assert model is not None and model.threshold <= 1
    found = {row["doc_id"]: row for row in secret_scan.scan(docs, model).collect()}
    assert all("learned" not in found[k]["spans"] for k in range(300))
    assert secret_scan.train(docs.where("doc_id < 300")) is None  # no findings, no labels


def test_threshold_keeps_the_recall_of_a_kind_that_the_sample_lacks(spark, monkeypatch):
    """Keys of one kind are many, those of another few and, by their hashes, outside a small sample."""
    monkeypatch.setattr(secret_scan, "SAMPLE_CANDIDATES", 40)
    draw = np.random.default_rng(5)
    rows = [(k, f"see {hashlib.sha256(str(k).encode()).hexdigest()} and page-{k}-of-the-book", "a") for k in range(400)]
    access = ["AKIA" + "".join(draw.choice(list("ABCDEFGHIJKLMNOP2"), 16)) for _ in range(30)]
    rows += [(None, f"use {key} for it", "a") for key in access]
    docs = documents(spark, rows)
    model = secret_scan.train(docs)
    counted = secret_scan.histogram(docs, model.network, frozenset())
    assert sum(n for _, kinds, _, n in counted if kinds == "access") == sum(
        bool(secret_scan.candidates(key)) for key in access)
    for kind in ("hex", "access"):
        texts_ = [r[1] for r in rows if any(s[0] == kind for s in secret_scan.base_spans(r[1]))]
        found = [secret_scan.windows(t, *c) for t in texts_ for c in secret_scan.candidates(t)
                 if secret_scan._Covered(secret_scan.base_spans(t)).meets(*c)]
        assert found and (model.scores(found) >= model.threshold - 1e-6).mean() >= 0.95


def test_weights_stand_for_rows():
    draw = np.random.default_rng(4)
    logits, labels, n = draw.normal(size=60), draw.integers(0, 2, 60).astype(float), draw.integers(1, 5, 60)
    assert char_cnn.platt(logits, labels, weights=n.astype(float)) == pytest.approx(
        char_cnn.platt(np.repeat(logits, n), np.repeat(labels, n)), abs=1e-6)
    for recall in (0.5, 0.9, 0.98, 1.0):
        positive = np.sort(np.repeat(logits[labels == 1], n[labels == 1]))
        expected = positive[int(np.floor((1 - recall) * len(positive) + 1e-9))]
        assert char_cnn.recall_threshold(logits, labels, recall, n) == expected
        assert char_cnn.recall_threshold(np.repeat(logits, n), np.repeat(labels, n), recall) == expected


def test_query_runs_the_network_on_small_tables(spark, monkeypatch):
    models = []
    scan = secret_scan.scan
    monkeypatch.setattr(secret_scan, "scan", lambda docs, model: models.append(model) or scan(docs, model))
    rows = secret_scan.op2_secret_scan(spark, "/root/testdata/sf0.001").collect()
    assert models[0] is not None and models[0].threshold <= 1
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    judged = 0
    for row in rows:
        spans = {tuple(s.split(":")) for s in row["spans"].split(",") if s}
        base = secret_scan.base_spans(text[row["doc_id"]] or "")
        learned = {(int(a), int(b)) for kind, a, b in spans if kind == "learned"}
        asked = [c for c in secret_scan.candidates(text[row["doc_id"]] or "")
                 if not secret_scan._Covered(base).meets(*c)]
        scores = models[0].scores([secret_scan.windows(text[row["doc_id"]], *c) for c in asked])
        assert learned == {c for c, score in zip(asked, scores) if score >= models[0].threshold}
        judged += len(asked)
    assert judged


def test_query_hashes_the_base_spans(spark):
    rows = secret_scan.op2_secret_scan(spark, "/root/testdata/sf0.001").limit(50).collect()
    texts_ = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for row in rows:
        base = secret_scan.joined(secret_scan.base_spans(texts_[row["doc_id"]]))
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()


def test_network_learns_and_threshold_keeps_recall():
    draw = np.random.default_rng(3)
    good = ["the quick brown fox of " + "".join(draw.choice(list("abcdefgh"), 30)) for _ in range(200)]
    bad = ["the quick brown fox of " + "".join(draw.choice(list("0123456789ABC"), 30)) for _ in range(200)]
    x, y = char_cnn.codes(good + bad), np.repeat([0.0, 1.0], 200).astype(np.float32)
    model = char_cnn.fit(x, y, epochs=3)
    slope, offset = char_cnn.platt(model.logits(x), y)
    scores = 1 / (1 + np.exp(-(slope * model.logits(x) + offset)))
    threshold = char_cnn.recall_threshold(scores, y, 0.95)
    assert (scores[y == 1] >= threshold).mean() >= 0.95 and (scores[y == 0] >= threshold).mean() <= 0.02


def plain_base_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns character by character, without regular expressions."""
    ascii_ = lambda s: set(s)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    value = ascii_(upper + lower + digits + "+/_.=-")

    def run(at, allowed):
        end = at
        while end < len(text) and text[end] in allowed:
            end += 1
        return end

    def assign(at):
        for keyword in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if "".join(chr(ord(c) + 32) if c in upper else c for c in text[at:at + len(keyword)]) == keyword:
                here = at + len(keyword)
                here += text[here:here + 1] in ("'", '"')
                here = run(here, " ")
                if text[here:here + 1] not in (":", "="):
                    return None
                here = run(here + 1, " ")
                here += text[here:here + 1] in ("'", '"')
                end = run(here, value)
                return (end, end - here >= 12) if end > here else None
        return None

    def access(at):
        if text[at:at + 4] != "AKIA":
            return None
        end = run(at + 4, ascii_(upper + digits))
        return (end, end - at >= 18) if end > at + 4 else None

    def hexadecimal(at):
        end = run(at, ascii_("abcdef" + digits))
        return (end, end - at >= 16) if end > at else None

    found = []
    for rank, (kind, match) in enumerate((("assign", assign), ("access", access), ("hex", hexadecimal))):
        at = 0
        while at < len(text):
            hit = match(at)
            if hit and hit[1]:
                found.append((at, rank, kind, hit[0]))
            at = hit[0] if hit else at + 1
    return [(kind, at, end) for at, _, kind, end in sorted(found)]


def test_base_spans_equal_a_plain_scanner():
    draw = np.random.default_rng(9)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", "  ", '"', "'", "abc", "Zx9Qk27LmP4t",
             "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef", "é", "ſ", "\n", "-", ".", "K"]
    for _ in range(3000):
        text = "".join(draw.choice(parts, draw.integers(1, 14)))
        assert secret_scan.base_spans(text) == plain_base_spans(text), text


def _keys(draw, n):
    """Secrets that no fixed pattern matches, of several makes."""
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    makes = ["client_key = {}", "use {} to log in", "ghp_{}", "pwd: {}", "Authorization: Bearer {}", "sk-{}"]
    return [(makes[k % len(makes)], "".join(draw.choice(letters, int(draw.integers(16, 41))))) for k in range(n)]


def test_secrets_without_a_fixed_pattern_are_found_and_addresses_left_alone(spark, tables):
    draw = np.random.default_rng(11)
    keys = _keys(draw, 300)
    names = ["anna.lopez", "j.smith42", "info", "support-team", "maria_garcia.88"]
    hosts = ["example.com", "mail.example.org", "shop-online.example.net"]
    harmless = [f"write to {names[k % 5]}{k}@{hosts[k % 3]} soon" for k in range(150)]
    harmless += [f"see https://{hosts[k % 3]}/articles/2024/{k:02d}/a-long-title-{k} now" for k in range(150)]
    rows = [(10_000 + k, "It is said: " + make.format(key) + " and more.", "a") for k, (make, key) in enumerate(keys)]
    rows += [(20_000 + k, text, "a") for k, text in enumerate(harmless)]
    assert not any(secret_scan.base_spans(text) for _, text, _ in rows)
    model = secret_scan.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    found = {row["doc_id"]: row["spans"] for row in secret_scan.scan(documents(spark, rows), model).collect()}
    recall = np.mean(["learned" in found[10_000 + k] for k in range(len(keys))])
    taken = np.mean(["learned" in found[20_000 + k] for k in range(len(harmless))])
    assert recall >= 0.9 and taken <= 0.02, (recall, taken)


def test_scan_of_repeated_rows_and_taken_names(spark, tables):
    model = secret_scan.train(tables[0])
    rows = [(1, "token = Zx9Qk27LmP4tVb81", "a")] * 3 + [(None, None, "a"), (None, "", None)]
    found = secret_scan.scan(documents(spark, rows), model)
    assert found.count() == 5 and found.where("doc_id = 1").distinct().count() == 1
    assert found.where("doc_id IS NULL AND spans = ''").count() == 2
