"""Inference sets and the monitoring refresh."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.dates import event_time
from tabwright.operators.inference_log import PayloadFormat, monitoring_rows, parse_inference_log
from tabwright.operators.partials import merged_columns, merged_quality, partial_profile
from tabwright.operators.profile import alert, column_profile
from tabwright.operators.transform import drop_columns, segment_filter
from tabwright.session import materialize, observed
from tabwright.sources.tables import (
    BATCH,
    STAMP,
    drop_table,
    mark_for_change_capture,
    overwrite,
    overwrite_partitions,
    set_table_properties,
    stamp,
    table_properties,
)

#: Table property of stored parts: what they were made with.
SETTINGS = "profile_settings"


def build_inference_set(
    df: DataFrame, column: str, value: Any, table: str, ts: datetime | None = None, path: str | None = None
) -> None:
    """Replace the inference set by the rows of one segment under a new timestamp."""
    rows = drop_columns(segment_filter(df, column, value), [STAMP, BATCH])
    overwrite(stamp(rows, ts), table, path)


def days_of(spark: SparkSession, table: str) -> set[date]:
    """The days of a table that is partitioned by them, from its list of partitions."""
    if not spark.catalog.tableExists(table):
        return set()
    listed = [r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]  # one row per day
    return {date.fromisoformat(d) for d in listed if d[:1].isdigit()}


def append_new(rows: DataFrame, table: str, key: Sequence[str], path: str | None = None, profile: str | None = None) -> int:
    """Append rows whose key the table does not hold yet, partitioned by the ``day`` of the rows; how many they are.

    Only the days that the new rows touch are read, and files are written by day. A row
    that comes twice is stored once, also when a step is run again; rows of one key on
    different days are different rows. Stored parts of these days in ``profile`` are given
    up before the rows are written, so a broken run leaves none that is out of date.
    """
    spark = rows.sparkSession
    new = rows.dropDuplicates([*key, "day"])
    if spark.catalog.tableExists(table):
        new = materialize(new, "new-rows")  # read for its days and for its rows
        days = [r["day"] for r in new.select("day").distinct().collect()]  # one value per day
        if not days:
            return 0
        held = spark.table(table).where(F.col("day").isin(days)).select("day", *key)
        new = new.join(held, ["day", *key], "left_anti")
        if profile and spark.catalog.tableExists(profile):
            for day in filter(None, days):
                spark.sql(f"ALTER TABLE {profile} DROP IF EXISTS PARTITION (day = DATE'{day}')")
    counted = Observation()
    found = new.observe(counted, F.count(F.lit(1)).alias("n")).hint("rebalance", "day")
    writer = found.write.format("parquet").mode("append").partitionBy("day")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return observed(counted).get("n", 0)


def store_records(
    log: DataFrame,
    record: T.StructType,
    model_name: str,
    table: str,
    fmt: PayloadFormat = PayloadFormat(),
    path: str | None = None,
) -> int:
    """Parse payloads that were not parsed before and append their records to ``table``; how many are new.

    A table of requests beside it (``<table>_requests``) remembers every payload, the
    unreadable ones as well, so none is parsed twice.
    """
    spark = log.sparkSession
    requests = f"{table}_requests"
    dated = log.withColumn("day", F.to_date(event_time(F.col(fmt.time_ms))))
    if spark.catalog.tableExists(requests):
        days = [r["day"] for r in dated.select("day").distinct().collect()]
        held = spark.table(requests).where(F.col("day").isin(days)).select("day", fmt.request_id)
        dated = dated.join(held, ["day", fmt.request_id], "left_anti")
    parsed = parse_inference_log(dated.drop("day"), record, model_name, fmt)
    added = append_new(parsed.withColumn("day", F.to_date("timestamp")), table, [fmt.request_id, "position"], path)
    append_new(dated.select("day", fmt.request_id), requests, [fmt.request_id], path and f"{path}_requests")
    return added


def label_pending(
    spark: SparkSession,
    records: str,
    table: str,
    label_sources: Sequence[DataFrame],
    features: DataFrame,
    key: str,
    label: str,
    fmt: PayloadFormat = PayloadFormat(),
    order: Sequence[str] = (),
    unique: bool = False,
    since: date | None = None,
    path: str | None = None,
) -> None:
    """Move records to the monitoring table as soon as they have a label, whenever it comes.

    Records that are there already are left out, day by day; ``since`` leaves out the days
    before it, once no labels are expected for them any more.
    """
    pending = spark.table(records)
    if since is not None:
        pending = pending.where(F.col("day") >= F.lit(since))
    if spark.catalog.tableExists(table):
        done = spark.table(table)
        if since is not None:
            done = done.where(F.col("day") >= F.lit(since))
        pending = pending.join(done.select("day", fmt.request_id, "position"), ["day", fmt.request_id, "position"], "left_anti")
    rows = monitoring_rows(pending, label_sources, features, key, label, order, unique)
    append_new(rows, table, [fmt.request_id, "position"], path, profile_of(table))


def profile_of(table: str) -> str:
    """The table of stored parts beside a monitoring table."""
    return f"{table}_profile"


def refresh_profiles(
    spark: SparkSession, table: str, label: str, numeric: Sequence[str], granularity: str, path: str | None = None
) -> list[date]:
    """Store the parts of the days that have none yet, and only these days are read; which days they are.

    Parts made with other columns or windows are all made anew.
    """
    name, made_with = profile_of(table), json.dumps([label, list(numeric), granularity])
    if spark.catalog.tableExists(name) and table_properties(spark, name).get(SETTINGS) != made_with:
        drop_table(spark, name)
    missing = sorted(days_of(spark, table) - days_of(spark, name))
    if not missing:
        return missing
    rows = spark.table(table).where(F.col("day").isin(missing))
    parts = partial_profile(rows, "timestamp", label, "prediction", numeric, ["model_name"], granularity)
    if spark.catalog.tableExists(name):
        overwrite_partitions(parts.hint("rebalance", "day"), name, ["day"])
        return missing
    writer = parts.hint("rebalance", "day").write.format("parquet").mode("overwrite").partitionBy("day")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    set_table_properties(spark, name, {SETTINGS: made_with})
    return missing


@dataclass(frozen=True)
class Monitoring:
    """A monitoring table and its profiles; a profile costs nothing until it is asked for.

    Quality is merged from the stored parts of each day, and so are column statistics with
    ``approx``; days without parts are read, so both are of all rows at any time. Exact
    distinct counts and medians need the rows. With ``since`` a profile takes the days from
    then on only; alerts take the newest days.
    """

    table: str
    label: str
    numeric: tuple[str, ...]
    granularity: str
    threshold: float
    approx: bool

    def rows(self, since: date | None = None) -> DataFrame:
        found = SparkSession.active().table(self.table)
        return found if since is None else found.where(F.col("day") >= F.lit(since))

    def parts(self, since: date | None = None) -> DataFrame:
        """The parts of all days, stored or made now."""
        spark = SparkSession.active()
        stored = days_of(spark, profile_of(self.table))
        made = partial_profile(
            self.rows(since).where(~F.col("day").isin(*stored)), "timestamp", self.label, "prediction", self.numeric, ["model_name"], self.granularity
        )
        if not stored:
            return made
        kept = spark.table(profile_of(self.table))
        kept = kept if since is None else kept.where(F.col("day") >= F.lit(since))
        return kept.unionByName(made) if days_of(spark, self.table) - stored else kept

    def quality(self, since: date | None = None) -> DataFrame:
        """Quality per window and model."""
        return merged_quality(self.parts(since), ["model_name"])

    def columns(self, since: date | None = None) -> DataFrame:
        """Column statistics per window and model."""
        if self.approx:
            return merged_columns(self.parts(since), ["model_name"])
        return column_profile(self.rows(since), "timestamp", self.numeric, ["model_name"], self.granularity)

    def alerts(self) -> DataFrame:
        """Models whose latest window breaches the threshold; the newest day comes from the table's list of partitions."""
        days = days_of(SparkSession.active(), self.table)
        # a window may begin on the day before
        since = max(days) - timedelta(days=1) if days else None
        return alert(self.quality(since), threshold=self.threshold)


def refresh_monitoring(
    spark: SparkSession,
    table: str,
    log: DataFrame,
    record: T.StructType,
    model_name: str,
    label_sources: Sequence[DataFrame],
    features: DataFrame,
    key: str,
    label: str,
    numeric: Sequence[str],
    fmt: PayloadFormat = PayloadFormat(),
    granularity: str = "30 minutes",
    threshold: float = 0.70,
    order: Sequence[str] = (),
    unique: bool = False,
    approx: bool = False,
    since: date | None = None,
    path: str | None = None,
) -> Monitoring:
    """Parse new payloads, label what has got a label, and offer the profiles and alerts of the table.

    Records are kept in ``<table>_records`` by day until their label comes, so payloads
    are parsed once and a refresh can be repeated; see :func:`store_records` and
    :func:`label_pending`. Profiles are kept by day in ``<table>_profile``; only days with
    new rows are profiled again, see :func:`refresh_profiles`.
    """
    records = f"{table}_records"
    store_records(log, record, model_name, records, fmt, path and f"{path}_records")
    label_pending(spark, records, table, label_sources, features, key, label, fmt, order, unique, since, path)
    refresh_profiles(spark, table, label, numeric, granularity, path and profile_of(path))
    mark_for_change_capture(spark, [table])
    return Monitoring(table, label, tuple(numeric), granularity, threshold, approx)
