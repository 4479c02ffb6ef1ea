"""The pipeline stage by stage, and the queries of the package."""

import __spark_entry__ as driver
import corpus_pipeline
import pytest
from fixture import documents, near_components, texts

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    names = driver.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)) and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "near dedup", "mixing", "packing"]


def test_stages_on_awkward_documents(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        if name != "packing":
            assert result.columns == docs.columns
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
        result.count()


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert set(rows.columns) == {
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    assert rows.groupby("sequence_id")["length"].sum().max() <= 2048


def test_near_stage_keeps_one_of_each_group(spark):
    kept = corpus_pipeline.unlike_texts(spark, documents(spark), FOLDER)
    ids = {row["doc_id"] for row in kept.collect()}
    assert ids == {d for d, _, c in near_components(texts()) if d == c}


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op4_chat_format", "op11_prefix_trie", "op12_decontamination"])
def test_oracles(spark, name):
    from oracle import connect, differences

    assert differences(spark, connect(FOLDER), FOLDER, name, driver.queries()[name], driver.oracle_sql()[name]) == []
