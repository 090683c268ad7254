"""Records that wait in the stream for their labels, and no longer than they may."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabwright.session import work_dir
from tabwright.streaming.monitoring import write_available
from tabwright.streaming.waiting import label_in_stream

RECORDS = "request_id string, position int, k long, prediction int, timestamp timestamp, amount double"
LABELS = "k long, y int, told timestamp, rank int"


def at(hours):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=hours)


@pytest.fixture
def run(spark):
    """Gives each call's rows to the streams, runs to their end, returns all that came out so far."""
    places = {name: work_dir(spark, name) for name in ("records", "labels", "out", "checkpoint")}

    def step(records=(), labels=(), **options):
        for name, rows, schema in (("records", records, RECORDS), ("labels", labels, LABELS)):
            spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(places[name])
        streams = [spark.readStream.schema(s).parquet(places[n]) for n, s in (("records", RECORDS), ("labels", LABELS))]
        found = label_in_stream(*streams, "k", "y", "told", "10 hours", "1 hour", **options)
        write_available(found, places["out"], places["checkpoint"])
        return sorted((r.request_id, r.position, r.k, r.y) for r in spark.read.schema(found.schema).parquet(places["out"]).collect())

    return step


def record(name, k, hours, prediction=1, position=0):
    return name, position, k, prediction, at(hours), 0.1


def test_records_wait_for_labels_and_labels_for_records(run):
    assert run([record("a", 1, 0), record("b", 2, 0), record("c", None, 0), record("d", 3, 0, None)]) == []
    assert run(labels=[(1, 1, at(1), 0), (4, 0, at(1), 0)]) == [("a", 0, 1, 1)]
    # repeated records come once; a label that came before serves a later record
    got = run([record("a", 1, 0), record("e", 4, 2), record("e", 4, 2, position=1)], [(2, 0, at(2), 0)])
    assert got == [("a", 0, 1, 1), ("b", 0, 2, 0), ("e", 0, 4, 0), ("e", 1, 4, 0)]


def test_the_first_source_counts(run):
    assert run([record("a", 1, 0)], [(1, 0, at(0), 1), (1, 1, at(0), 0), (1, 0, at(0), 2)]) == [("a", 0, 1, 1)]


@pytest.mark.parametrize("keep", [False, True])
def test_records_are_given_up_after_the_timeout(run, keep):
    options = {"keep_unlabelled": keep}
    gone = [("a", 0, 1, None)] if keep else []
    assert run([record("a", 1, 0)], **options) == []
    # both streams have passed the time of "a" by more than ten hours
    run([record("z", 99, 30)], [(98, 1, at(30), 0)], **options)
    assert run([record("z2", 99, 31)], [(98, 1, at(31), 0)], **options) == gone
    assert run([record("z3", 99, 32)], [(1, 1, at(32), 0)], **options) == gone


def test_records_of_one_key_can_be_spread(run, spark):
    rows = [record(f"r{i}", 7, 0) for i in range(50)]
    got = run(rows, [(7, 1, at(0), 0)], spread=4)
    assert len(got) == 50 and {r[3] for r in got} == {1}


def test_times_and_numbers_are_kept(spark):
    places = {name: work_dir(spark, name) for name in ("records", "labels", "out", "checkpoint")}
    exact = dt.datetime(2024, 2, 29, 23, 59, 59, 123456, tzinfo=dt.timezone.utc)
    spark.createDataFrame([("a", 0, 1, 1, exact, 0.1 + 0.2)], RECORDS).write.parquet(places["records"])
    spark.createDataFrame([(1, 0, exact, 0)], LABELS).write.parquet(places["labels"])
    streams = [spark.readStream.schema(s).parquet(places[n]) for n, s in (("records", RECORDS), ("labels", LABELS))]
    found = label_in_stream(*streams, "k", "y", "told")
    write_available(found, places["out"], places["checkpoint"])
    r = spark.read.parquet(places["out"]).select(F.unix_micros("timestamp").alias("t"), "amount").first()
    assert r.t == int(exact.timestamp()) * 1_000_000 + 123456 and r.amount == 0.1 + 0.2


def test_keys_share_entries_of_the_state(run, spark):
    rows = [record(f"r{i}", i, i % 5) for i in range(400)]
    assert run(rows, parts=8) == []
    places = {name: work_dir(spark, name) for name in ("records", "labels", "checkpoint")}
    spark.createDataFrame(rows, RECORDS).write.parquet(places["records"])
    spark.createDataFrame([], LABELS).write.parquet(places["labels"])
    streams = [spark.readStream.schema(s).parquet(places[n]) for n, s in (("records", RECORDS), ("labels", LABELS))]
    found = label_in_stream(*streams, "k", "y", "told", "10 hours", parts=8)
    query = found.writeStream.format("noop").option("checkpointLocation", places["checkpoint"]).trigger(availableNow=True).start()
    query.awaitTermination()
    held = [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"] if o["operatorName"].startswith("transformWithState")]
    assert held and max(held) <= 8 * 8
    assert run(labels=[(i, i % 2, at(1), 0) for i in range(100, 300)], parts=8) == sorted((f"r{i}", 0, i, i % 2) for i in range(100, 300))


def test_records_of_a_part_are_due_each_at_its_own_time(run):
    rows = [record(f"r{i}", i, i) for i in range(9)]
    options = {"keep_unlabelled": True, "parts": 1}
    assert run(rows, **options) == []
    # the watermark is an hour behind: 14 hours less 10 are past after the second batch
    run([record("z", 99, 15)], [(98, 1, at(15), 0)], **options)
    got = run([record("y", 99, 15)], [(98, 1, at(15), 0)], **options)
    assert got == [(f"r{i}", 0, i, None) for i in range(5)]
    assert run(labels=[(7, 1, at(15), 0)], **options)[-1] == ("r7", 0, 7, 1)
