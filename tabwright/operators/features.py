"""Keyed feature tables: writing, refreshing, looking up."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.contract import ContractViolation
from tabwright.operators.checks import null_counts, observing, refuse, violations
from tabwright.operators.keys import content_hash, keyed_join, keyed_joins, latest_per_key
from tabwright.session import materialize, planned_bytes, work_dir
from tabwright.sources.changes import APPLIED, record_changes
from tabwright.sources.tables import drop_table, overwrite_partitions, set_table_properties, table_properties


@dataclass(frozen=True)
class Lookup:
    """Features to add by key.

    ``order`` picks the newest row of a repeated key. ``unique=True`` says the
    table keeps one row per key already, which saves the reduction.
    """

    table: DataFrame
    key: tuple[str, ...]
    names: tuple[str, ...]
    order: tuple[str, ...] = ()
    unique: bool = False

    def rows(self) -> DataFrame:
        """One row per key with just the named features."""
        narrow = self.table.select(*dict.fromkeys([*self.key, *self.names, *self.order]))
        if not self.unique:
            narrow = latest_per_key(narrow, self.key, self.order or self.names)
        return narrow.select(*self.key, *self.names)


def feature_lookup(
    df: DataFrame,
    table: DataFrame,
    key: Sequence[str],
    names: Sequence[str],
    order: Sequence[str] = (),
    unique: bool = False,
    skew: str = "auto",
) -> DataFrame:
    """Add named features by key; a missing key gives nulls, no row is lost or repeated."""
    lookup = Lookup(table, tuple(key), tuple(names), tuple(order), unique)
    return keyed_join(df, lookup.rows(), key, skew=skew)


def training_set(
    df: DataFrame,
    label: str,
    lookups: Sequence[Lookup] = (),
    functions: Mapping[str, Column] | None = None,
    exclude: Sequence[str] = (),
    skew: str = "auto",
) -> DataFrame:
    """Lookups, computed columns and exclusions in one plan; lookups on one key share a shuffle."""
    groups: dict[tuple[str, ...], list[Lookup]] = {}
    for lookup in lookups:
        groups.setdefault(lookup.key, []).append(lookup)
    for key, members in groups.items():
        df = keyed_joins(df, [(m.rows(), "left") for m in members], key, skew=skew)
    if functions:
        df = df.withColumns(dict(functions))
    if label in exclude:
        raise ValueError(f"the label {label} cannot be excluded")
    return df.drop(*exclude)


def lookup_keys(features: DataFrame, keys: DataFrame, key: Sequence[str], unique: bool = True) -> DataFrame:
    """Features of the asked keys; a key without features gives nulls."""
    names = [c for c in features.columns if c not in key]
    return feature_lookup(keys.select(*key), features, key, names, unique=unique)


def create_feature_table(
    df: DataFrame, table: str, key: Sequence[str], path: str | None = None, lookup_buckets: int | None = None
) -> None:
    """Write a feature table that declares its key, if the key holds.

    The frame is computed once: it is written under another name (below ``path`` or in the
    warehouse), nulls in the key are counted while it is written, and repeated keys are
    looked for in the written key columns alone. Only then does it take the table's name,
    so a frame that fails leaves the table as it was, and a frame that differs whenever it
    is computed is stored as it was checked.

    With ``lookup_buckets`` the files are bucketed by the key as Spark's joins deal rows
    out: lookups in tables of as many buckets shuffle the asking side once and the tables
    not at all.
    """
    spark = df.sparkSession
    nulls = [(check, column, agg) for check, column, agg in null_counts(df) if column in key]
    counted, seen = observing(df, nulls)
    beside = f"{table}_{uuid.uuid4().hex}"
    if lookup_buckets:
        dealt = counted.repartition(lookup_buckets, *[F.col(f"`{k}`") for k in key])  # one file per bucket
        writer = dealt.write.format("parquet").bucketBy(lookup_buckets, *key).sortBy(*key)
    else:
        writer = counted.write.format("parquet")
    if path:
        writer = writer.option("path", f"{path}/{uuid.uuid4().hex}")
    writer.saveAsTable(beside)
    repeats = spark.table(beside).groupBy(*[F.col(f"`{k}`") for k in key]).agg(F.count("*").alias("n")).where("n > 1").count()
    try:
        refuse([*violations(seen, nulls), ("key_unique", ",".join(key), repeats)])
    except ContractViolation:
        drop_table(spark, beside)
        raise
    set_table_properties(spark, beside, {"primary_key": ",".join(key)})
    drop_table(spark, table)
    spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")


BUCKET = "_bucket"
# Table properties: how many buckets, and where rows wait that a broken run may not have put in place.
BUCKETS, PENDING = "key_buckets", "pending_buckets"
BUCKET_BYTES, LEAST_BUCKETS, MOST_BUCKETS = 64 << 20, 16, 4096


def key_bucket(key: Sequence[str], buckets: int) -> Column:
    """The bucket of a key: a hash, so that one row per key fills all buckets alike."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets)).cast("int")


def read_features(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a feature table without the column of its buckets."""
    return spark.table(table).drop(BUCKET)


def lookup_in_table(spark: SparkSession, table: str, keys: DataFrame) -> DataFrame:
    """Features of the asked keys (all columns of ``keys``) from a table in buckets; only their buckets are read.

    A key without features gives nulls, a key that is asked twice comes twice.
    """
    key, buckets = keys.columns, int(table_properties(spark, table).get(BUCKETS, 0))
    if not buckets:
        return lookup_keys(read_features(spark, table), keys, key)
    keys = keys.select(*[F.col(k).cast(spark.table(table).schema[k].dataType).alias(k) for k in key])
    asked = [r[0] for r in keys.select(key_bucket(key, buckets)).distinct().collect()]  # one value per bucket
    rows = spark.table(table).where(F.col(BUCKET).isin(asked)).drop(BUCKET)
    return lookup_keys(rows, keys, key)


def _same_key(left: DataFrame, right: DataFrame, key: Sequence[str]) -> Column:
    return reduce(and_, [left[f"`{k}`"].eqNullSafe(right[f"`_{k}`"]) for k in key])


def newer_rows(current: DataFrame, fresh: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of ``fresh`` that change ``current``: of new keys, newer, or as new and different.

    Both frames have one row per key; null keys are keys like others. Only keys, order and
    a hash of ``current`` are shuffled.
    """
    fields = [f for f in current.schema.fields if f.name in fresh.columns]
    held = current.select(
        *[F.col(f"`{k}`").alias(f"_{k}") for k in key], F.struct(*order).alias("_held"), content_hash(fields).alias("_was")
    )
    marked = fresh.withColumn("_is", content_hash(fields))
    joined = marked.join(held, _same_key(marked, held, key), "left")
    given = F.struct(*order)
    wins = F.col("_held").isNull() | (given > F.col("_held")) | ((given == F.col("_held")) & (F.col("_is") != F.col("_was")))
    return joined.where(wins).select(*fresh.columns)


def _without(rows: DataFrame, gone: DataFrame, key: Sequence[str]) -> DataFrame:
    other = gone.select(*[F.col(f"`{k}`").alias(f"_{k}") for k in key])
    return rows.join(other, _same_key(rows, other, key), "left_anti")


def _in_buckets(df: DataFrame, table: str, key: Sequence[str], buckets: int, root: str | None) -> None:
    writer = df.withColumn(BUCKET, key_bucket(key, buckets)).hint("rebalance", BUCKET).write.format("parquet").partitionBy(BUCKET)
    if root:
        writer = writer.option("path", f"{root}/{table}-{uuid.uuid4().hex}")
    writer.saveAsTable(table)
    set_table_properties(df.sparkSession, table, {"primary_key": ",".join(key), BUCKETS: str(buckets), APPLIED: "1"})


def _put_in_place(spark: SparkSession, table: str, version: str, path: str) -> None:
    """Overwrite the buckets for which rows wait; doing so again changes nothing."""
    rows = spark.read.schema(spark.table(table).schema).parquet(path)
    overwrite_partitions(rows.hint("rebalance", BUCKET), table, [BUCKET])
    set_table_properties(spark, table, {PENDING: "", APPLIED: version})


def upsert_features(
    spark: SparkSession,
    table: str,
    update: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    root: str | None = None,
    buckets: int | None = None,
) -> int:
    """Apply the newest rows to a keyed table; how many buckets were written.

    A feature table is partitioned by a hash of its key (``_bucket``, see
    :func:`read_features`). An update writes the buckets of keys it changes and no others;
    rows that are older than those held, or equal to them, change nothing, so applying the
    same rows again writes nothing. ``buckets`` counts for a new table; without it there is
    one per 64 MB of the first rows, 16 at least. A table that has no buckets yet is
    written anew once. New tables lie below ``root``, or in the warehouse.

    The buckets' new rows are written to the shared folder first and noted in the table's
    properties; a run that breaks off while they are put in place is completed by the next
    one. On tables marked for change capture the changed rows are kept, see
    :func:`tabwright.sources.changes.table_changes`. Single writer per table.
    """
    key, order = list(key), list(order)
    if not spark.catalog.tableExists(table):
        first = latest_per_key(update, key, order)
        _in_buckets(first, table, key, buckets or _fitting(update), root)
        return len(spark.sql(f"SHOW PARTITIONS {table}").collect())
    properties = table_properties(spark, table)
    if BUCKETS not in properties:
        _give_buckets(spark, table, key, buckets, root)
        properties = table_properties(spark, table)
    if properties.get(PENDING):
        _put_in_place(spark, table, *properties[PENDING].split(" ", 1))
        properties = table_properties(spark, table)
    schema = read_features(spark, table).schema
    typed = update.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    fresh = latest_per_key(typed, key, order).withColumn(BUCKET, key_bucket(key, int(properties[BUCKETS])))
    fresh = materialize(fresh, "update")  # read three times
    winners = materialize(newer_rows(_buckets_of(spark, table, fresh), fresh, key, order), "winners")
    held = _buckets_of(spark, table, winners)
    touched = [r[0] for r in winners.select(BUCKET).distinct().collect()]
    if not touched:
        return 0
    version = int(properties[APPLIED]) + 1
    record_changes(held.drop(BUCKET), winners.drop(BUCKET), table, key, version, root)
    path = work_dir(spark, "buckets")
    _without(held, winners, key).unionByName(winners).write.parquet(path)
    set_table_properties(spark, table, {PENDING: f"{version} {path}"})
    _put_in_place(spark, table, str(version), path)
    return len(touched)


def _buckets_of(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """The table's rows in the buckets that ``rows`` names: at most as many values as buckets."""
    return spark.table(table).where(F.col(BUCKET).isin([r[0] for r in rows.select(BUCKET).distinct().collect()]))


def _fitting(df: DataFrame) -> int:
    return min(max(planned_bytes(df) // BUCKET_BYTES, LEAST_BUCKETS), MOST_BUCKETS)


def _give_buckets(spark: SparkSession, table: str, key: Sequence[str], buckets: int | None, root: str | None) -> None:
    """Write a plain keyed table anew with buckets, then let it take the old one's name."""
    old, beside = spark.table(table), f"{table}_{uuid.uuid4().hex}"
    kept = {k: v for k, v in table_properties(spark, table).items() if not k.startswith("transient")}
    _in_buckets(old, beside, key, buckets or _fitting(old), root)
    set_table_properties(spark, beside, kept | {"primary_key": ",".join(key)})
    drop_table(spark, table)
    spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")
