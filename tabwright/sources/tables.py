"""Catalog tables on Parquet: append, overwrite, create, insert, versions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"
STAMP = "update_timestamp_utc"
# Fixed value: the property that asks for change capture.
CHANGE_FEED = "delta.enableChangeDataFeed"


def stamp(df: DataFrame, ts: datetime | None = None, column: str = STAMP) -> DataFrame:
    """Add one timestamp for the whole batch."""
    ts = ts or datetime.now(timezone.utc)
    text = ts.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f") if ts.tzinfo else ts.isoformat(" ")
    # The text carries no zone, so read it as UTC whatever the session zone is.
    return df.withColumn(column, F.lit(f"{text}+00:00").cast("timestamp"))


def append_stamped(
    df: DataFrame, table: str, ts: datetime | None = None, path: str | None = None
) -> int:
    """Append a batch with its timestamp; returns the version it created.

    Tables are partitioned by batch: the version comes from the list of partitions, and
    :func:`newest_batch` reads one of them. Single writer per table.
    """
    spark = df.sparkSession
    version = (data_version(spark, table) or 0) + 1
    batch = stamp(df, ts).withColumn(BATCH, F.lit(version).cast("int"))
    writer = batch.write.format("parquet").mode("append").partitionBy(BATCH)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return version


def data_version(spark: SparkSession, table: str) -> int | None:
    """The newest batch number, or None when the table is missing or has no batches; reads the list of partitions."""
    try:
        listed = spark.sql(f"SHOW PARTITIONS {table}").collect()  # one row per batch
    except AnalysisException:
        return None
    batches = [int(value) for r in listed for name, _, value in [r[0].partition("=")] if name == BATCH and value.isdigit()]
    return max(batches, default=None)


def latest_version(spark: SparkSession, table: str) -> DataFrame:
    """:func:`data_version` as a one-row frame ``(version)``; no file is scanned."""
    return spark.createDataFrame([(data_version(spark, table),)], "version int")


def newest_batch(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the newest batch; only its partition is read."""
    version = data_version(spark, table)
    return spark.table(table).where(F.lit(False) if version is None else F.col(BATCH) == version)


def overwrite(df: DataFrame, table: str, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Replace a table, or only the partitions the frame has rows for."""
    spark = df.sparkSession
    if partition_by and spark.catalog.tableExists(table):
        overwrite_partitions(df, table, partition_by)
        return
    writer = df.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def overwrite_partitions(df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that the frame has rows for; others keep their files.

    The mode is an option of this write, so the session's settings stay as they are.
    """
    spark = df.sparkSession
    columns = spark.table(table).schema.fields
    rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in columns])
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(location(spark, table))
    spark.sql(f"MSCK REPAIR TABLE {table}")  # lists folders, for partitions that are new
    spark.catalog.refreshTable(table)


def location(spark: SparkSession, table: str) -> str:
    """The folder of a table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return described[0]["data_type"]


def create_table(
    spark: SparkSession, table: str, columns: str, key: Sequence[str], path: str | None = None, replace: bool = True
) -> None:
    """An empty typed table whose key columns are NOT NULL.

    ``columns`` is DDL text such as ``"id STRING, n INT"``. The key is kept in
    the table properties; ``insert_select`` refuses nulls in it and
    ``check_key`` tells whether it is unique.
    """
    fields = [T.StructField(f.name, f.dataType, f.nullable and f.name not in key) for f in T.StructType.fromDDL(columns).fields]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in fields)
    if replace:
        drop_table(spark, table)
        if path:  # dropping a table at a path of its own leaves its files
            spark.createDataFrame([], T.StructType(fields)).write.mode("overwrite").parquet(path)
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE {table} ({ddl}) USING parquet{location} TBLPROPERTIES ('primary_key' = '{','.join(key)}')"
    )


def insert_select(source: DataFrame, target: str, columns: Sequence[str]) -> None:
    """Append a projection of ``source`` to a table with the same columns in the same order.

    Parquet tables do not enforce NOT NULL, so a null in the declared key fails the job here.
    """
    key = table_properties(source.sparkSession, target).get("primary_key", "").split(",")
    names = dict(zip(columns, source.sparkSession.table(target).columns))
    source.select(
        *[
            F.coalesce(F.col(c), F.raise_error(F.lit(f"null in key {names[c]} of {target}"))).alias(c)
            if names[c] in key
            else F.col(c)
            for c in columns
        ]
    ).write.insertInto(target)


def set_table_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    """Set table properties; on Parquet tables they are information only."""
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def mark_for_change_capture(spark: SparkSession, tables: Iterable[str]) -> None:
    """Mark tables whose new files a stream will follow."""
    for table in tables:
        set_table_properties(spark, table, {CHANGE_FEED: "true"})


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """The properties of a table, as a dict."""
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table if it is there."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
