"""The shape of physical plans: what must not be in them, and what must be pushed down."""

import re

import pytest

from __spark_entry__ import queries
from registry.tables import RECORD, inference_log, table
from tabwright.operators.inference_log import parse_inference_log
from tabwright.operators.transform import segment_filter

RUNS_STREAMS = re.compile(r"^(t\d|c7|s\d)")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in queries() if not RUNS_STREAMS.match(n)))
def test_no_cross_join_and_no_python(name, spark, sf_dir):
    text = plan(queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    python = re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", text)
    assert not python or name.startswith("ml7_")  # a model from outside Spark


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(segment_filter(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING").select("c_custkey"))
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    assert re.search(r"ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>", text)


def test_split_does_not_shuffle(spark, sf_dir):
    for name in ("f4_hash_split", "p2_cast", "p5_normalize_date", "c1_prepare", "j5_parse_inference_log"):
        assert "Exchange" not in plan(queries()[name](spark, sf_dir))


def test_payloads_are_parsed_once(spark, sf_dir):
    log = inference_log(table(spark, sf_dir, "events"))
    text = plan(parse_inference_log(log, RECORD, "m"))
    assert len(re.findall(r"from_json\(StructField\(dataframe_records", text)) == 1


def test_checks_are_one_aggregate(spark, sf_dir):
    text = plan(queries()["v3_check_nulls"](spark, sf_dir))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_quality_is_one_shuffle_of_partial_counts(spark, sf_dir):
    text = plan(queries()["flagship_window_quality"](spark, sf_dir))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_buckets_are_joined_without_a_shuffle(spark, sf_dir):
    """Three bucketed tables: one exchange, that of the asking side."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(queries()["j1_bucketed_lookups"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and text.count("FileScan") == 4


def test_drift_reads_each_side_once(spark, sf_dir, monkeypatch):
    from tabwright.operators import drift

    stored = []
    real = drift.materialize
    monkeypatch.setattr(drift, "materialize", lambda df, label: stored.append(plan(df)) or real(df, label))
    events = table(spark, sf_dir, "events")
    final = plan(drift.numeric_drift(events.where("value < 50"), events.where("value >= 50"), ["value", "user_id"]))
    assert len(stored) == 1 and stored[0].count("FileScan") == 2
    assert "events.parquet" not in final


def test_tables_with_a_key_are_computed_once(spark):
    """A frame that differs whenever it is computed is stored as it was checked."""
    from registry.tables import fresh_name
    from tabwright.operators.features import create_feature_table

    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    name = fresh_name("once")
    create_feature_table(spark.range(1000).mapInArrow(counted, "id long"), name, ["id"])
    assert made.value == 1000 and spark.table(name).count() == 1000
