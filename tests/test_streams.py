"""Streams over many files give what the batch form gives."""

import pytest
from pyspark.sql import functions as F

from registry.tables import RECORD, booking_features, fresh_name, inference_log, label_sources, table
from tabwright.operators.features import read_features
from tabwright.operators.inference_log import build_monitoring, dropped_payloads, parse_inference_log
from tabwright.operators.keys import latest_per_key
from tabwright.operators.profile import quality_profile
from tabwright.plans.monitoring import label_pending, refresh_monitoring, store_records
from tabwright.session import work_dir
from tabwright.streaming.monitoring import stream_inference_log, stream_quality, sync_features, write_available


@pytest.fixture(scope="module")
def files(spark, sf_dir):
    """Events in time order, one file per week."""
    path = work_dir(spark, "weeks")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for week in range(5):
        part = events.where(F.floor((F.dayofmonth("ts") - 1) / 7) == week)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, files):
    schema = spark.read.parquet(files).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(files)


def judged(df):
    return df.selectExpr("ts", "CAST(event_type = 'purchase' AS INT) AS y", "CAST(value > 50 AS INT) AS p")


def test_closed_windows_equal_batch(spark, files):
    out = work_dir(spark, "out")
    quality = stream_quality(judged(stream(spark, files)), "ts", "y", "p", granularity="1 hour")
    write_available(quality, out, work_dir(spark, "checkpoint"))
    got = spark.read.parquet(out)
    want = quality_profile(judged(spark.read.parquet(files)), "ts", "y", "p", granularity="1 hour")
    assert got.exceptAll(want).isEmpty()
    assert 0 <= want.count() - got.count() <= 2  # the windows still open


def test_monitoring_rows_equal_batch_without_repeats(spark, files):
    """Five files, one micro-batch each, run twice; labels come after the first labelling."""
    events = spark.read.parquet(files)
    records, name = fresh_name("records"), fresh_name("monitored")
    log = inference_log(stream(spark, files))
    twice = log.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    checkpoint, path = work_dir(spark, "checkpoint"), work_dir(spark, records)
    for _ in range(2):
        stream_inference_log(twice, RECORD, "m", records, checkpoint, path=path)
    where = work_dir(spark, name)
    for sources in ([s.where("booking_id % 2 = 0") for s in label_sources(events)], label_sources(events)):
        label_pending(
            spark, records, name, sources, booking_features(events), "booking_id", "booking_status", order=["version"], path=where
        )
    want = build_monitoring(
        inference_log(events), RECORD, "m", label_sources(events), booking_features(events), "booking_id", "booking_status",
        order=["version"],
    )
    got = spark.table(name).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_sync_equals_latest(spark, files):
    name, checkpoint = fresh_name("synced"), work_dir(spark, "checkpoint")
    narrow = ["user_id", "ts", "event_id", "value"]
    for _ in range(2):
        sync_features(stream(spark, files).select(*narrow), name, ["user_id"], ["ts", "event_id"], checkpoint)
    want = latest_per_key(spark.read.parquet(files).select(*narrow), ["user_id"], ["ts", "event_id"])
    got = read_features(spark, name)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


PAYLOADS = [
    ("good", '{"dataframe_records":[{"booking_id":1,"amount":2.5,"kind":"a"},{"booking_id":2}]}', '{"predictions":[1,0]}'),
    ("bad", '{"dataframe_rec', '{"predictions":[1]}'),
    ("null", None, None),
    ("none", '{"dataframe_records":[]}', '{"predictions":[]}'),
    ("short", '{"dataframe_records":[{"booking_id":3},{"booking_id":4}]}', '{"predictions":[1]}'),
    ("unanswered", '{"dataframe_records":[{"booking_id":5}]}', "oops"),
    ("extra", '{"dataframe_records":[{"booking_id":6,"other":1}],"more":2}', '{"predictions":[0],"output":{"trace":"t"}}'),
]


@pytest.fixture(scope="module")
def payloads(spark):
    rows = [(1700000000999, r, 3, q, a) for r, q, a in PAYLOADS]
    schema = "timestamp_ms long, request_id string, execution_time_ms long, request string, response string"
    return spark.createDataFrame(rows, schema)


def test_payload_cases(payloads):
    parsed = parse_inference_log(payloads, RECORD, "m")
    got = sorted((r.request_id, r.position, r.booking_id, r.prediction) for r in parsed.collect())
    assert got == [
        ("extra", 0, 6, 0), ("good", 0, 1, 1), ("good", 1, 2, 0), ("short", 0, 3, 1), ("short", 1, 4, None),
        ("unanswered", 0, 5, None),
    ]
    first = parse_inference_log(payloads, RECORD, "m", first_only=True)
    assert {(r.booking_id, r.prediction) for r in first.where("request_id = 'good'").collect()} == {(1, 1), (2, 1)}
    assert {r[0] for r in parsed.select(F.unix_millis("timestamp")).collect()} == {1700000000000}
    exact = parse_inference_log(payloads, RECORD, "m", exact_time=True)
    assert {r[0] for r in exact.select(F.unix_millis("timestamp")).collect()} == {1700000000999}


def test_dropped_payloads(payloads):
    got = {r.reason: r.n for r in dropped_payloads(payloads, RECORD).collect()}
    assert got == {"unreadable request": 2, "no records": 1, "unreadable response": 2}


def test_refresh_twice_adds_nothing(spark, files):
    events = spark.read.parquet(files)
    name, path = fresh_name("monitoring"), work_dir(spark, "monitoring")
    counts = []
    for _ in range(2):
        found = refresh_monitoring(
            spark, name, inference_log(events), RECORD, "m", label_sources(events), booking_features(events), "booking_id",
            "booking_status", ["amount"], order=["version"], path=path,
        )
        counts.append(spark.table(name).count())
    assert counts[0] == counts[1] > 0
    # nothing new: no payload is parsed; alerts and profiles of a period read their days only
    assert store_records(inference_log(events), RECORD, "m", f"{name}_records") == 0
    assert "PartitionFilters: [isnotnull(day" in found.alerts()._jdf.queryExecution().toString().replace("#", " #").replace(" #", "#")
    newest = spark.table(name).agg(F.max("day")).first()[0]
    assert "PartitionFilters: [isnotnull(day" in found.quality(newest)._jdf.queryExecution().toString()
    assert found.quality(newest).exceptAll(found.quality()).isEmpty()
    assert found.columns().where("n + nulls = 0").isEmpty()
