"""Queries of the composed plans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from registry import query
from registry.models import PARAMETERS
from registry.tables import (
    BOOKINGS,
    MONITORING_SQL,
    PARSED_SQL,
    PREPARED_SQL,
    RECORD,
    booking_features,
    bookings,
    flat_quality,
    fresh_name,
    hash_sql,
    inference_log,
    label_sources,
    quality_sql,
    rounded,
    table,
)
from tabwright.functions.dates import lead_time
from tabwright.operators.features import Lookup, read_features
from tabwright.operators.inference_log import parse_inference_log
from tabwright.operators.profile import quality_profile
from tabwright.operators.split import hash_split
from tabwright.plans.ingest import ingest, prepare, split
from tabwright.plans.monitoring import build_inference_set, refresh_monitoring
from tabwright.plans.training import build_features, refresh_features, train_and_compare
from tabwright.session import work_dir
from tabwright.sources.files import write_csv
from tabwright.sources.tables import append_stamped, newest_batch

DATES = ("date_of_arrival", "date_of_booking")
PREPARED = [*(c.alias for c in BOOKINGS.columns), *DATES]
_TYPES = {d: "VARCHAR" for d in DATES} | {c.alias: "SMALLINT" for c in BOOKINGS.numeric if c.dtype == "int16"}
PREPARED_TEXT_SQL = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS {t}) AS {c}' for c, t in _TYPES.items())}) FROM ({PREPARED_SQL})"
RUN_TIME = datetime(2024, 2, 1, 6, 0)


def _dates_as_text(df):
    return df.withColumns({d: F.col(d).cast("string") for d in DATES})


@query("c1_prepare", PREPARED_TEXT_SQL)
def c1_prepare(spark, sf_dir):
    return _dates_as_text(prepare(bookings(spark, sf_dir), BOOKINGS).df)


PART_SQL = f"""CASE WHEN market_segment_type <> 'Online' THEN 'extra'
                    WHEN {hash_sql('booking_id')} < {int(0.2 * (1 << 60))} THEN 'test' ELSE 'train' END"""


@query("c2_ingest", f"SELECT *, {PART_SQL} AS part FROM ({PREPARED_TEXT_SQL})")
def c2_ingest(spark, sf_dir):
    raw = work_dir(spark, "bookings-csv")
    write_csv(bookings(spark, sf_dir), raw)
    tables = {part: fresh_name(part) for part in ("train", "test", "extra")}
    places = {part: work_dir(spark, part) for part in tables}
    ingest(spark, raw, BOOKINGS, tables, "booking_id", ("market_segment_type", "Online"), ts=RUN_TIME, locations=places)
    parts = [spark.table(name).select(*PREPARED).withColumn("part", F.lit(part)) for part, name in tables.items()]
    return _dates_as_text(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("c3_build_features", "SELECT c_custkey, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal FROM customer")
def c3_build_features(spark, sf_dir):
    train, test = hash_split(table(spark, sf_dir, "customer"), ["c_custkey"])
    name = fresh_name("features")
    columns = "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE"
    build_features(spark, name, [train, test], columns, ["c_custkey"], work_dir(spark, "features"))
    return spark.table(name)


def _daily(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("day"))


LAST_DAY = "CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"


@query(
    "c4_refresh_append",
    f"""SELECT event_id, user_id, value FROM events WHERE event_type = 'view'
        UNION ALL SELECT event_id, user_id, value FROM events WHERE {LAST_DAY}""",
)
def c4_refresh_append(spark, sf_dir):
    name = fresh_name("event_features")
    views = table(spark, sf_dir, "events").where("event_type = 'view'")
    columns = "event_id BIGINT, user_id BIGINT, value DOUBLE"
    build_features(spark, name, [views], columns, ["event_id"], work_dir(spark, "event-features"))
    refresh_features(spark, name, [_daily(spark, sf_dir)], ["event_id", "user_id", "value"], stamp_column="day")
    return spark.table(name)


@query(
    "c4_refresh_upsert",
    f"""SELECT event_id, value + 1 AS value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE {LAST_DAY}
        UNION ALL SELECT event_id, value, CAST(CAST(ts AS DATE) AS VARCHAR) FROM events WHERE NOT {LAST_DAY}""",
)
def c4_refresh_upsert(spark, sf_dir):
    name = fresh_name("event_features")
    daily = _daily(spark, sf_dir).select("event_id", "value", "day")
    daily.write.option("path", work_dir(spark, "event-features")).saveAsTable(name)
    changed = daily.withColumn("value", F.col("value") + 1)
    refresh_features(spark, name, [changed], ["event_id", "value"], ["event_id"], "upsert", "day", work_dir(spark, "states"))
    return read_features(spark, name).withColumn("day", F.col("day").cast("string"))


@query(
    "c4_refresh_newest_batch",
    """SELECT c_custkey, c_acctbal, CAST(CASE WHEN c_custkey % 4 = 3 THEN 2 ELSE 1 END AS INTEGER) AS parts FROM customer WHERE c_custkey % 4 > 0""",
)
def c4_refresh_newest_batch(spark, sf_dir):
    """Two batch tables, each of two batches; the features take over the newest batch of both, by append and by upsert."""
    customer, names, columns = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), [], "c_custkey BIGINT, c_acctbal DOUBLE"
    for first, second in ((0, 1), (2, 3)):
        name = fresh_name("batches")
        append_stamped(customer.where(f"c_custkey % 4 = {first}"), name, RUN_TIME, work_dir(spark, name))
        append_stamped(customer.where(f"c_custkey % 4 = {second}"), name, RUN_TIME)
        names.append(name)
    appended, upserted = fresh_name("features"), fresh_name("features")
    build_features(spark, appended, [customer.where("c_custkey % 4 = 2")], columns, ["c_custkey"], work_dir(spark, appended))
    refresh_features(spark, appended, names, ["c_custkey", "c_acctbal"])
    for _ in range(2):
        refresh_features(spark, upserted, names, ["c_custkey", "c_acctbal"], ["c_custkey"], "upsert", root=work_dir(spark, "states"))
    both = spark.table(appended).unionByName(read_features(spark, upserted).where("c_custkey % 4 = 3").select("c_custkey", "c_acctbal"))
    return both.groupBy("c_custkey", "c_acctbal").agg(F.count(F.lit(1)).cast("int").alias("parts"))


@query(
    "c2_scheduled_ingest",
    f"""SELECT booking_id, lead_time, booking_status, CASE WHEN {hash_sql('booking_id')} < {int(0.2 * (1 << 60))} THEN 'test' ELSE 'train' END AS part
        FROM ({PREPARED_SQL})""",
)
def c2_scheduled_ingest(spark, sf_dir):
    """All rows written as CSV, read back, prepared and split without a segment."""
    path, names = work_dir(spark, "scheduled"), {part: fresh_name(part) for part in ("train", "test")}
    write_csv(bookings(spark, sf_dir), path)
    saved = ingest(spark, path, BOOKINGS, names, "booking_id", locations={part: work_dir(spark, part) for part in names})
    parts = [newest_batch(spark, name).select("booking_id", "lead_time", "booking_status", F.lit(part).alias("part")) for part, name in saved.items()]
    return parts[0].unionByName(parts[1])


@query(
    "c5_build_inference_set",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY'",
)
def c5_build_inference_set(spark, sf_dir):
    extra, name = fresh_name("extra"), fresh_name("inference")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    append_stamped(customer, extra, RUN_TIME, work_dir(spark, "extra"))
    build_inference_set(spark.table(extra), "c_mktsegment", "MACHINERY", name, RUN_TIME, work_dir(spark, "inference"))
    return spark.table(name).drop("update_timestamp_utc")


@query(
    "c6_train_and_compare",
    f"""WITH held AS (SELECT booking_status AS label FROM ({PREPARED_SQL}) WHERE {hash_sql('booking_id')} < {int(0.2 * (1 << 60))})
        SELECT CAST(label AS VARCHAR) AS class, count(*) AS support, true AS valid FROM held GROUP BY label
        UNION ALL SELECT class, (SELECT count(*) FROM held), true FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) t(class)""",
)
def c6_train_and_compare(spark, sf_dir):
    """Feature table from both splits, refreshed by appending, then training with lookups from it."""
    state = prepare(bookings(spark, sf_dir), BOOKINGS)
    train, test = split(state, "booking_id")
    name = fresh_name("features")
    columns = "booking_id STRING, repeated_guest SMALLINT, no_of_weekend_nights SMALLINT"
    looked_up = ("repeated_guest", "no_of_weekend_nights")
    build_features(spark, name, [train, test], columns, ["booking_id"], work_dir(spark, "features"))
    refresh_features(spark, name, [train], ["booking_id", *looked_up], stamp_column="date_of_booking")
    result = train_and_compare(
        train.drop("lead_time", *looked_up),
        test.drop("lead_time", *looked_up),
        "booking_status",
        BOOKINGS.numeric_features,
        BOOKINGS.categorical_features,
        "booking_id",
        [Lookup(spark.table(name), ("booking_id",), looked_up)],
        {"lead_time": lead_time(F.col("date_of_arrival"), F.col("date_of_booking"))},
        PARAMETERS,
        latest=lambda df: df.withColumn("prediction", (F.col("avg_price_per_room") > 250000).cast("int")),
        exclude=["market_segment_type"],
    )
    valid = F.col("precision").between(0, 1) & F.col("recall").between(0, 1) & F.lit(result.comparison.challenger_wins in (True, False))
    return result.report.select("class", F.col("support").cast("long").alias("support"), valid.alias("valid"))


def _refreshed(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    name, path = fresh_name("monitoring"), work_dir(spark, "monitoring")
    result = None
    for _ in range(2):  # the second refresh finds nothing new
        result = refresh_monitoring(
            spark,
            name,
            inference_log(events),
            RECORD,
            "rule",
            label_sources(events),
            booking_features(events),
            "booking_id",
            "booking_status",
            ["amount", "guest"],
            granularity="1 day",
            threshold=0.95,
            order=["version"],
            path=path,
        )
    return result


MODEL_SQL = f"SELECT *, 'rule' AS model_name FROM ({MONITORING_SQL})"
DAILY_SQL = quality_sql(MODEL_SQL, "booking_status", "prediction", "second // 86400 * 86400", "model_name")


@query("c7_refresh_monitoring", DAILY_SQL)
def c7_refresh_monitoring(spark, sf_dir):
    return flat_quality(_refreshed(spark, sf_dir).quality(), ("model_name",))


@query(
    "c7_refresh_monitoring_alert",
    f"""SELECT * FROM ({DAILY_SQL}) WHERE accuracy_score < 0.95
        AND window_start = (SELECT max(second // 86400 * 86400) FROM ({MONITORING_SQL}))""",
)
def c7_refresh_monitoring_alert(spark, sf_dir):
    return flat_quality(_refreshed(spark, sf_dir).alerts(), ("model_name",))


@query(
    "c7_refresh_monitoring_columns",
    " UNION ALL ".join(
        f"""SELECT second // 86400 * 86400 AS window_start, 'rule' AS model_name, '{c}' AS "column", count({c}) AS n,
                   count(*) - count({c}) AS nulls, CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max",
                   round(avg({c}) + 1e-10, 6) AS mean, round(stddev_samp({c}), 6) AS std, count(DISTINCT {c}) AS "distinct",
                   round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median
            FROM ({MONITORING_SQL}) GROUP BY 1"""
        for c in ("amount", "guest")
    ),
)
def c7_refresh_monitoring_columns(spark, sf_dir):
    # sums of doubles depend on their order in the last bit, which decides exact halves: both sides move them up
    found = _refreshed(spark, sf_dir).columns().withColumn("mean", F.col("mean") + 1e-10)
    found = rounded(found, "mean", "std", "median")
    start = F.unix_seconds(F.col("window.start")).alias("window_start")
    return found.select(start, *[c for c in found.columns if c != "window"])


# --- the flagship: payloads to quality windows --------------------------------

FLAGSHIP_SQL = f"""
    SELECT second, prediction, CASE WHEN kind = 'purchase' THEN 1 ELSE 0 END AS label
    FROM ({PARSED_SQL}) WHERE prediction IS NOT NULL"""


@query("flagship_window_quality", quality_sql(FLAGSHIP_SQL, "label", "prediction", "second // 1800 * 1800"))
def flagship_window_quality(spark, sf_dir):
    log = inference_log(table(spark, sf_dir, "events"))
    parsed = parse_inference_log(log, RECORD, "rule").where("prediction IS NOT NULL")
    labelled = parsed.withColumn("label", (F.col("kind") == "purchase").cast("int"))
    return flat_quality(quality_profile(labelled, "timestamp", "label", "prediction"))
