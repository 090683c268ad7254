"""Tables as of a version, and the rows that changed between versions.

A version is a numbered batch of :func:`tabwright.sources.tables.append_stamped`, or an
update of a feature table by :func:`tabwright.operators.features.upsert_features`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.keys import content_hash, latest_per_key
from tabwright.session import materialize
from tabwright.sources.tables import BATCH, CHANGE_FEED, STAMP, data_version, overwrite_partitions, table_properties

# The columns and kinds of a change feed.
CHANGE, VERSION = "_change_type", "_commit_version"
INSERT, BEFORE, AFTER, DELETE = "insert", "update_preimage", "update_postimage", "delete"
#: Table property with the last update of a feature table that is in place.
APPLIED = "applied_version"


def table_version(spark: SparkSession, table: str) -> int | None:
    """The version of a feature table or a batch table; None for other tables."""
    applied = table_properties(spark, table).get(APPLIED) if spark.catalog.tableExists(table) else None
    return int(applied) if applied else data_version(spark, table)


def read_as_of(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The rows of a batch table up to a version, all of them without one; other batches are not read."""
    newest = data_version(spark, table)
    if newest is None:
        raise ValueError(f"{table} has no batches")
    if version is None:
        return spark.table(table)
    if not 1 <= version <= newest:
        raise ValueError(f"{table} has versions 1 to {newest}, not {version}")
    return spark.table(table).where(F.col(BATCH) <= version)


def state_as_of(
    spark: SparkSession,
    table: str,
    key: Sequence[str],
    version: int | None = None,
    order: Sequence[str] = (),
    deleted: str | None = None,
    snapshots: bool = False,
) -> DataFrame:
    """One row per key of a batch table as it was at a version, without batch and stamp.

    The newest batch of a key counts, within a batch the greatest ``order``. A row whose
    ``deleted`` column is true ends its key. With ``snapshots`` every batch is a whole
    state, so the rows of one batch are read.
    """
    return _alive(_newest(read_as_of(spark, table, version), _snapshot_of(spark, table, version, snapshots), key, order), deleted)


def _snapshot_of(spark: SparkSession, table: str, version: int | None, snapshots: bool) -> int | None:
    return (version or data_version(spark, table)) if snapshots else None


def _newest(rows: DataFrame, snapshot: int | None, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    if snapshot is not None:
        rows = rows.where(F.col(BATCH) == snapshot)
    return latest_per_key(rows, key, [BATCH, *order])


def _alive(rows: DataFrame, deleted: str | None) -> DataFrame:
    if deleted:
        rows = rows.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)
    return rows.drop(BATCH, STAMP)


def _same_key(left: DataFrame, right: DataFrame, key: Sequence[str], prefix: str = "_k_") -> Column:
    return reduce(and_, [left[f"`{k}`"].eqNullSafe(right[f"`{prefix}{k}`"]) for k in key])


def _named(key: Sequence[str], prefix: str = "_k_") -> list[Column]:
    return [F.col(f"`{k}`").alias(f"{prefix}{k}") for k in key]


def row_changes(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inserts, updates (both images) and deletes that turn one keyed frame into another.

    Both have one row per key and the same columns; null keys are keys like others. Keys
    and row hashes alone are compared; whole rows are read for the changed keys only,
    which are written once so that their real size decides how they are joined. Rows count
    as equal when their 64-bit hashes are.
    """
    columns = before.columns
    after = after.select(*columns)
    old = before.select(*_named(key, "_o_"), content_hash(before.schema.fields).alias("_was"), F.lit(True).alias("_old"))
    new = after.select(*_named(key, "_n_"), content_hash(after.schema.fields).alias("_is"), F.lit(True).alias("_new"))
    same = reduce(and_, [old[f"`_o_{k}`"].eqNullSafe(new[f"`_n_{k}`"]) for k in key])
    kind = F.when(F.col("_old").isNull(), INSERT).when(F.col("_new").isNull(), DELETE).when(F.col("_was") != F.col("_is"), AFTER)
    keys = [F.when(F.col("_old").isNull(), F.col(f"`_n_{k}`")).otherwise(F.col(f"`_o_{k}`")).alias(f"_k_{k}") for k in key]
    changed = old.join(new, same, "full_outer").select(*keys, kind.alias(CHANGE)).where(F.col(CHANGE).isNotNull())
    changed = materialize(changed, "changed-keys")

    def images(rows: DataFrame, kinds: tuple[str, str], update: str) -> DataFrame:
        hit = changed.where(F.col(CHANGE).isin(*kinds))
        label = F.when(F.col(CHANGE) == AFTER, update).otherwise(F.col(CHANGE)).alias(CHANGE)
        return rows.join(hit, _same_key(rows, hit, key)).select(*[rows[f"`{c}`"] for c in columns], label)

    return images(after, (INSERT, AFTER), AFTER).unionByName(images(before, (DELETE, AFTER), BEFORE))


def table_changes(
    spark: SparkSession,
    table: str,
    since: int,
    until: int | None = None,
    key: Sequence[str] = (),
    order: Sequence[str] = (),
    deleted: str | None = None,
    snapshots: bool = False,
) -> DataFrame:
    """The changed rows of a table after version ``since`` up to ``until``, with ``_change_type``.

    Feature tables marked for change capture have recorded every update, so all changes
    come with their ``_commit_version``. For batch tables, which need the key, the changes
    from the one version to the other are found: of an append log only the later batches
    and the earlier rows of their keys are compared, of ``snapshots`` the two batches.
    ``since=0`` is the empty table.
    """
    recorded = f"{table}_changes"
    if not key:
        if not spark.catalog.tableExists(recorded):
            raise ValueError(f"{table} has no recorded changes; name its key to compare its batches")
        newest = int(table_properties(spark, table)[APPLIED])
        last = newest if until is None else min(until, newest)
        return spark.table(recorded).where((F.col(VERSION) > since) & (F.col(VERSION) <= last))
    rows = read_as_of(spark, table, until)
    last = _snapshot_of(spark, table, until, snapshots)
    earlier, later = rows.where(F.col(BATCH) <= since), rows.where(F.col(BATCH) > since)
    after = _newest(later, last, key, order)
    if not snapshots:  # keys without later rows have not changed
        asked = later.select(*_named(key)).distinct()
        earlier = earlier.join(asked, _same_key(earlier, asked, key), "left_semi")
    before = _newest(earlier, since if snapshots else None, key, order)
    return row_changes(_alive(before, deleted), _alive(after, deleted), key)


def replay(base: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``base`` after the changes; of several changes of a key the one of the last version counts."""
    if VERSION in changes.columns:
        changes = latest_per_key(changes.where(F.col(CHANGE) != BEFORE), key, [VERSION])
    gone = changes.select(*_named(key)).distinct()
    kept = base.join(gone, _same_key(base, gone, key), "left_anti")
    return kept.unionByName(changes.where(F.col(CHANGE).isin(INSERT, AFTER)).select(*base.columns))


def record_changes(held: DataFrame, changed: DataFrame, table: str, key: Sequence[str], version: int, root: str | None = None) -> None:
    """Keep what an update of a marked table changes in ``<table>_changes``, one partition per version.

    A version that is recorded again replaces what a broken run left. Only rows of
    ``changed`` keys are kept.
    """
    spark = held.sparkSession
    if table_properties(spark, table).get(CHANGE_FEED) != "true":
        return
    mine = changed.select(*_named(key))
    before = held.join(mine, _same_key(held, mine, key), "left_semi").withColumn(CHANGE, F.lit(BEFORE))
    known = held.select(*_named(key), F.lit(True).alias("_known"))
    kind = F.when(F.col("_known"), AFTER).otherwise(INSERT).alias(CHANGE)
    after = changed.join(known, _same_key(changed, known, key), "left").select(*[changed[f"`{c}`"] for c in changed.columns], kind)
    rows = before.unionByName(after).withColumn(VERSION, F.lit(version))
    name = f"{table}_changes"
    if spark.catalog.tableExists(name):
        overwrite_partitions(rows, name, [VERSION])
        return
    writer = rows.write.format("parquet").partitionBy(VERSION)
    if root:
        writer = writer.option("path", f"{root}/{name}")
    writer.saveAsTable(name)
