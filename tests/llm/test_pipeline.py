"""Every stage of the pipeline on its own input, and that its decisions take effect."""

import pytest

import corpus_pipeline
from tabwright.llm.rows import id_and_text
from tests.llm.cases import empty, messy
from tests.llm.test_exact_dedup import norm
from tests.llm.test_near_dedup import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir):
    from tabwright.session import materialize

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = materialize(stage(spark, docs, sf_dir), f"test-{name}")
        after = {r.doc_id: r.asDict() for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "tokens":
            assert set(after) == set(before) and all(r["round_trip"] and len(r["ids"]) == 4 * r["n_tokens"] for r in after.values())
            continue
        assert docs.columns == COLUMNS and all(after[i]["text"] == before[i] for i in after)
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            assert all(i in after for i in before if labels.get(i) == 1)
            assert sum(i not in after for i in before if labels.get(i) == 0) > 0
        if name == "exact":
            first = {}
            for i in sorted(before):
                first.setdefault(norm(before[i]), i)
            assert set(after) == set(first.values()) and len(after) < len(before)
        if name == "near":
            assert set(after) == {i for i, _, c in brute(list(before.items()), 5) if i == c}
        if name == "decontaminate":
            items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert all(i not in after for i, t in before.items() if any(x in t for x in items))


def test_run(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "n_tokens", "ids", "round_trip"] and found.count() > 100


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[1:])
def test_stages_take_messy_rows(spark, sf_dir, name, stage):
    assert stage(spark, messy(spark), sf_dir).count() > 0
    assert stage(spark, empty(spark), sf_dir).collect() == []


def test_texts_are_whole(spark):
    assert {r.text for r in id_and_text(messy(spark)).collect()} >= {"y" * 5000, ""}
