"""Stored parts of profiles: merged they give what all rows give, and only new days are read."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from registry.tables import RECORD, booking_features, fresh_name, inference_log, label_sources, table
from tabwright.operators.partials import merged_columns, merged_quality, partial_profile
from tabwright.operators.profile import column_profile, quality_profile
from tabwright.plans import monitoring as mon
from tabwright.session import work_dir

COLUMNS = ["value", "user_id", "nothing", "even"]


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "ts", "to_date(ts) AS day", "CAST(user_id % 2 AS STRING) AS m", "user_id", "CASE WHEN event_id % 13 <> 0 THEN value END AS value",
        "CAST(NULL AS INT) AS nothing", "CAST(event_id % 2 * 2.0 AS DOUBLE) - 1e6 AS even",
        "CAST(value > 50 AS INT) AS p", "CAST(event_type = 'purchase' AS INT) AS y",
    )


@pytest.mark.parametrize("granularity", ["30 minutes", "1 day", "9 days"])
def test_merged_parts_equal_the_profile_of_all_rows(spark, rows, granularity):
    halves = [rows.where(F.dayofmonth("ts") % 2 == i) for i in (0, 1)]
    parts = [partial_profile(h, "ts", "y", "p", COLUMNS, ["m"], granularity) for h in halves]
    both = parts[0].unionByName(parts[1])
    want = quality_profile(rows, "ts", "y", "p", ["m"], granularity)
    got = merged_quality(both, ["m"])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    if granularity == "30 minutes":
        return
    exact = {(r.window.start, r.m, r.column): r for r in column_profile(rows, "ts", COLUMNS, ["m"], granularity).collect()}
    found = merged_columns(both, ["m"]).collect()
    assert len(found) == len(exact)
    for r in found:
        e = exact[r.window.start, r.m, r.column]
        assert (r.n, r.nulls, r.min, r.max) == (e.n, e.nulls, e.min, e.max)
        for a, b in ((r["mean"], e["mean"]), (r["std"], e["std"])):
            assert a == b or abs(a - b) <= 1e-9 * max(1.0, abs(b))
        assert abs(r.distinct - e.distinct) <= max(1, 0.05 * e.distinct)


def test_medians_of_parts_are_near_in_rank(spark):
    rng = random.Random(3)
    values = [rng.lognormvariate(0, 2) for _ in range(4000)]
    frame = spark.createDataFrame([(dt.datetime(2024, 1, 1 + i % 3), dt.date(2024, 1, 1 + i % 3), v, 0, 1) for i, v in enumerate(values)], "ts timestamp, day date, v double, y int, p int")
    found = merged_columns(partial_profile(frame, "ts", "y", "p", ["v"], granularity="30 days")).first()
    assert found.n == 4000 and abs(sum(v < found["median"] for v in values) - 2000) <= 0.02 * 4000


def test_no_rows(spark, rows):
    none = partial_profile(rows.limit(0), "ts", "y", "p", COLUMNS, ["m"])
    assert merged_quality(none, ["m"]).collect() == [] and merged_columns(none, ["m"]).collect() == []


def refresh(spark, events, name, path, approx=False, granularity="1 day"):
    return mon.refresh_monitoring(
        spark, name, inference_log(events), RECORD, "m", label_sources(events), booking_features(events), "booking_id",
        "booking_status", ["amount", "guest"], order=["version"], path=path, approx=approx, granularity=granularity,
    )


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_refresh_profiles_new_days_only(spark, sf_dir, monkeypatch):
    events = table(spark, sf_dir, "events")
    name, path = fresh_name("profiled"), work_dir(spark, "profiled")
    read = []
    real = mon.partial_profile
    monkeypatch.setattr(mon, "partial_profile", lambda rows, *a, **k: read.append(rows) or real(rows, *a, **k))
    refresh(spark, events.where("dayofmonth(ts) <= 10"), name, path)
    read.clear()
    found = refresh(spark, events.where("dayofmonth(ts) <= 11"), name, path)
    assert [sorted({r.day.day for r in rows.select("day").distinct().collect()}) for rows in read] == [[11]]
    monitored = spark.table(name)
    assert same(found.quality(), quality_profile(monitored, "timestamp", "booking_status", "prediction", ["model_name"], "1 day"))
    files = set(spark.table(mon.profile_of(name)).where("dayofmonth(day) <= 10").inputFiles())
    refresh(spark, events.where("dayofmonth(ts) <= 11"), name, path)
    assert set(spark.table(mon.profile_of(name)).where("dayofmonth(day) <= 10").inputFiles()) == files


def test_late_labels_renew_the_parts_of_their_day(spark, sf_dir):
    events = table(spark, sf_dir, "events").where("dayofmonth(ts) <= 4")
    name, path = fresh_name("late"), work_dir(spark, "late")
    early = [s.where("booking_id % 2 = 0") for s in label_sources(events)]
    records = f"{name}_records"
    mon.store_records(inference_log(events), RECORD, "m", records, path=f"{path}_records")
    for sources in (early, label_sources(events)):
        mon.label_pending(spark, records, name, sources, booking_features(events), "booking_id", "booking_status", order=["version"], path=path)
        found = mon.Monitoring(name, "booking_status", ("amount",), "1 day", 0.7, True)
        want = quality_profile(spark.table(name), "timestamp", "booking_status", "prediction", ["model_name"], "1 day")
        assert same(found.quality(), want)  # parts given up are made from the rows
        mon.refresh_profiles(spark, name, "booking_status", ["amount"], "1 day", f"{path}_profile")
        assert same(found.quality(), want) and mon.days_of(spark, name) == mon.days_of(spark, mon.profile_of(name))
        counts = {(r.window.start, r.n + r.nulls) for r in found.columns().collect()}
        assert counts == {(r.window.start, r.n) for r in want.collect()}
    assert mon.refresh_profiles(spark, name, "booking_status", ["amount"], "1 day") == []
    # other windows: all parts are made anew
    assert len(mon.refresh_profiles(spark, name, "booking_status", ["amount"], "2 days", f"{path}_profile")) == 4
