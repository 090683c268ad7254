"""Queries of the readers, writers and tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from registry import query
from registry.tables import contract, fresh_name, table
from tabwright.operators.features import create_feature_table, read_features, upsert_features
from tabwright.session import work_dir
from tabwright.sources.files import read_csv, read_table, well_formed, write_csv
from tabwright.sources.changes import CHANGE, VERSION, read_as_of, replay, state_as_of, table_changes
from tabwright.sources.tables import append_stamped, create_table, insert_select, latest_version, mark_for_change_capture, overwrite

ORDERS = contract(
    [("o_orderkey", "int64", "o_orderkey"), ("o_custkey", "int64", "o_custkey"), ("o_totalprice", "float64", "price")],
    [("o_orderdate", "object", "o_orderdate"), ("o_orderpriority", "object", "o_orderpriority")],
    ("o_orderstatus", "object", "o_orderstatus"),
)
CUSTOMER = contract(
    [("c_custkey", "int64", "c_custkey"), ("c_nationkey", "int32", "c_nationkey"), ("c_acctbal", "float64", "c_acctbal")],
    [("c_name", "object", "c_name")],
    ("c_mktsegment", "object", "c_mktsegment"),
)
BATCH_TIME = datetime(2024, 2, 1, 12, 30)


@query(
    "s1_read_csv",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
              CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""",
)
def s1_read_csv(spark, sf_dir):
    path = work_dir(spark, "orders-csv")
    write_csv(table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate")), path)
    return well_formed(read_csv(spark, path, ORDERS))


@query("s2_read_table", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def s2_read_table(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"])


@query(
    "s3_append_stamped",
    """SELECT event_id, user_id, event_type, value, CAST(event_id % 2 + 1 AS INTEGER) AS batch_id,
              '2024-02-01 12:30:00' AS update_timestamp_utc FROM events""",
)
def s3_append_stamped(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    name = fresh_name("appended")
    for part in (0, 1):
        append_stamped(events.where(f"event_id % 2 = {part}"), name, BATCH_TIME, work_dir(spark, name) if not part else None)
    return spark.table(name).withColumn("update_timestamp_utc", F.col("update_timestamp_utc").cast("string"))


@query("s4_overwrite", "SELECT event_id, value FROM events WHERE event_type = 'purchase'")
def s4_overwrite(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    name, path = fresh_name("replaced"), work_dir(spark, "replaced")
    overwrite(events.select("event_id", "value"), name, path)
    overwrite(events.where("event_type = 'purchase'").select("event_id", "value"), name, path)
    return spark.table(name)


@query(
    "s4_overwrite_partitions",
    "SELECT event_id, CASE WHEN event_type = 'click' THEN -1.0::DOUBLE ELSE value END AS value, event_type FROM events",
)
def s4_overwrite_partitions(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    name, path = fresh_name("by_type"), work_dir(spark, "by-type")
    overwrite(events, name, path, ["event_type"])
    clicks = events.where("event_type = 'click'").withColumn("value", F.lit(-1.0))
    overwrite(clicks, name, path, ["event_type"])
    return spark.table(name)


@query(
    "s6_insert_select",
    "SELECT c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier",
)
def s6_insert_select(spark, sf_dir):
    name = fresh_name("parties")
    create_table(spark, name, "id BIGINT, balance DOUBLE", ["id"], work_dir(spark, "parties"))
    for source, prefix, key in (("customer", "c", "c_custkey"), ("supplier", "s", "s_suppkey")):
        insert_select(table(spark, sf_dir, source), name, [key, f"{prefix}_acctbal"])
    return spark.table(name)


@query("s5_create_table", "SELECT c_custkey AS id, CAST(c_acctbal AS DECIMAL(10, 2)) AS balance, c_name AS name FROM customer")
def s5_create_table(spark, sf_dir):
    """A table made twice at one path holds the rows inserted after the second time only."""
    name, path = fresh_name("made"), work_dir(spark, "made")
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "CAST(c_acctbal AS DECIMAL(10,2)) AS balance", "struct(c_name AS name) AS whole")
    for _ in range(2):
        create_table(spark, name, "id BIGINT, balance DECIMAL(10,2), whole STRUCT<name: STRING>", ["id"], path)
        insert_select(customer, name, ["id", "balance", "whole"])
    return spark.table(name).select("id", "balance", "whole.name")


@query("s9_data_version", "SELECT CAST(count(DISTINCT c_custkey % 3) AS INTEGER) AS version FROM customer")
def s9_data_version(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    name, path = fresh_name("versions"), work_dir(spark, "versions")
    for part in range(3):
        append_stamped(customer.where(f"c_custkey % 3 = {part}"), name, BATCH_TIME, path if part == 0 else None)
    return latest_version(spark, name)


@query("s10_write_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s10_write_csv(spark, sf_dir):
    path = work_dir(spark, "customer-csv")
    write_csv(table(spark, sf_dir, "customer"), path)
    return well_formed(read_csv(spark, path, CUSTOMER))


NEWEST_SQL = """SELECT user_id, epoch_us(ts) AS ts, event_id, event_type, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"""


@query("s11_upsert_features", NEWEST_SQL)
def s11_upsert_features(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), "event_id", "event_type", "value"
    )
    middle = F.lit(1705363200000000)  # 2024-01-16
    name, root = fresh_name("latest_event"), work_dir(spark, "states")
    # the later half first, so that the earlier one must not win; then the same rows again
    for part in (events.where(F.col("ts") >= middle), events.where(F.col("ts") < middle), events):
        upsert_features(spark, name, part, ["user_id"], ["ts", "event_id"], root)
    return read_features(spark, name)


def _balances(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", F.lit(1).alias("seq"))


UPDATED = "c_custkey % 50 = 7"


@query(
    "s11_upsert_touched_buckets",
    f"""SELECT c_custkey, c_nationkey, CASE WHEN {UPDATED} THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
               CAST(CASE WHEN {UPDATED} THEN 2 ELSE 1 END AS INTEGER) AS seq, true AS only_theirs
        FROM customer
        UNION ALL SELECT -1, 0, 0.5, 2, true""",
)
def s11_upsert_touched_buckets(spark, sf_dir):
    """Some customers change and one is new; the files of buckets without them stay, a repetition writes nothing."""
    customer, root = _balances(spark, sf_dir), work_dir(spark, "balances")
    name = fresh_name("balances")
    upsert_features(spark, name, customer, ["c_custkey"], ["seq"], root, buckets=64)
    update = customer.where(UPDATED).withColumns({"c_acctbal": F.col("c_acctbal") + 1, "seq": F.lit(2)})
    update = update.unionByName(spark.sql("SELECT -1L AS c_custkey, 0L AS c_nationkey, 0.5D AS c_acctbal, 2 AS seq"))
    held = set(spark.table(name).inputFiles())
    written = upsert_features(spark, name, update, ["c_custkey"], ["seq"], root)
    again = upsert_features(spark, name, update, ["c_custkey"], ["seq"], root)
    fresh = {f.rsplit("/", 2)[1] for f in spark.table(name).inputFiles() if f not in held}
    return read_features(spark, name).withColumn("only_theirs", F.lit(again == 0 and len(fresh) == written))


def _changing_log(spark, sf_dir):
    """Three batches: most customers; then new, changed and ended ones; then some changed again."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    name, path = fresh_name("customer_log"), work_dir(spark, "customer-log")
    alive = F.lit(False).alias("ended")
    append_stamped(customer.where("c_custkey % 10 <> 0").select("*", alive), name, BATCH_TIME, path)
    later = customer.where("c_custkey % 10 = 0 OR c_custkey % 7 = 0 OR c_custkey % 11 = 0")
    append_stamped(later.withColumn("c_acctbal", F.col("c_acctbal") + 1).withColumn("ended", F.expr("c_custkey % 11 = 0")), name, BATCH_TIME)
    append_stamped(customer.where("c_custkey % 21 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 2).select("*", alive), name, BATCH_TIME)
    return name


VERSION_1_SQL = "SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 10 <> 0"
VERSION_2_SQL = """SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 10 = 0 OR c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
                   FROM customer WHERE c_custkey % 11 <> 0"""
VERSION_3_SQL = f"""SELECT * FROM ({VERSION_2_SQL}) WHERE c_custkey % 21 <> 0
                    UNION ALL SELECT c_custkey, c_nationkey, c_acctbal + 2 FROM customer WHERE c_custkey % 21 = 0"""


@query("s7_replay_changes", VERSION_2_SQL)
def s7_replay_changes(spark, sf_dir):
    """The changes from version 1 to version 2, applied to version 1."""
    name, key = _changing_log(spark, sf_dir), ["c_custkey"]
    changes = table_changes(spark, name, 1, 2, key, deleted="ended")
    return replay(state_as_of(spark, name, key, 1, deleted="ended"), changes, key)


@query(
    "s7_table_changes",
    f"""WITH a AS ({VERSION_1_SQL}), b AS ({VERSION_3_SQL}),
             changed AS (SELECT a.c_custkey AS k FROM a JOIN b USING (c_custkey) WHERE a.c_acctbal <> b.c_acctbal)
        SELECT *, 'update_preimage' AS _change_type FROM a WHERE c_custkey IN (SELECT k FROM changed)
        UNION ALL SELECT *, 'update_postimage' FROM b WHERE c_custkey IN (SELECT k FROM changed)
        UNION ALL SELECT *, 'insert' FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM a)
        UNION ALL SELECT *, 'delete' FROM a WHERE c_custkey NOT IN (SELECT c_custkey FROM b)""",
)
def s7_table_changes(spark, sf_dir):
    """Net changes over two batches of an append log."""
    return table_changes(spark, _changing_log(spark, sf_dir), 1, 3, ["c_custkey"], deleted="ended")


@query(
    "s7_snapshot_changes",
    """SELECT CAST(count(*) FILTER (c_custkey % 3 = 0 AND c_custkey % 5 <> 0) AS BIGINT) AS n, 'insert' AS _change_type FROM customer
       UNION ALL SELECT count(*) FILTER (c_custkey % 5 = 0 AND c_custkey % 3 <> 0), 'delete' FROM customer
       UNION ALL SELECT count(*) FILTER (c_custkey % 15 = 0), 'update_preimage' FROM customer
       UNION ALL SELECT count(*) FILTER (c_custkey % 15 = 0), 'update_postimage' FROM customer""",
)
def s7_snapshot_changes(spark, sf_dir):
    """Two whole states, one in five customers and one in three; those in both differ."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    name = fresh_name("snapshots")
    append_stamped(customer.where("c_custkey % 5 = 0"), name, BATCH_TIME, work_dir(spark, "snapshots"))
    append_stamped(customer.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1), name, BATCH_TIME)
    return table_changes(spark, name, 1, 2, ["c_custkey"], snapshots=True).groupBy(CHANGE).agg(F.count("*").alias("n"))


@query(
    "s7_recorded_changes",
    f"""SELECT c_custkey, c_acctbal, CAST(1 AS INTEGER) AS seq, 'update_preimage' AS _change_type, CAST(2 AS INTEGER) AS _commit_version, true AS replayed
        FROM customer WHERE {UPDATED}
        UNION ALL SELECT c_custkey, c_acctbal + 1, 2, 'update_postimage', 2, true FROM customer WHERE {UPDATED}
        UNION ALL SELECT -c_custkey, c_acctbal, 3, 'insert', 3, true FROM customer WHERE {UPDATED}""",
)
def s7_recorded_changes(spark, sf_dir):
    """What two updates of a marked feature table changed; replayed on the first state they give the last."""
    customer, root = _balances(spark, sf_dir).drop("c_nationkey"), work_dir(spark, "recorded")
    name, key = fresh_name("recorded"), ["c_custkey"]
    upsert_features(spark, name, customer, key, ["seq"], root)
    mark_for_change_capture(spark, [name])
    update = customer.where(UPDATED)
    for part in (
        update.withColumns({"c_acctbal": F.col("c_acctbal") + 1, "seq": F.lit(2)}),
        update.withColumns({"c_custkey": -F.col("c_custkey"), "seq": F.lit(3)}),
        update,  # older: no version
    ):
        upsert_features(spark, name, part, key, ["seq"], root)
    changes = table_changes(spark, name, 1)
    now, then = read_features(spark, name), replay(customer, changes, key)
    same = now.exceptAll(then.select(*now.columns)).isEmpty() and then.select(*now.columns).exceptAll(now).isEmpty()
    return changes.withColumn("replayed", F.lit(same)).withColumn(VERSION, F.col(VERSION).cast("int"))


@query("s9_read_as_of", "SELECT c_custkey, CAST(c_custkey % 3 + 1 AS INTEGER) AS batch_id FROM customer WHERE c_custkey % 3 < 2")
def s9_read_as_of(spark, sf_dir):
    """The second of three versions, read after the third was written."""
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    name, path = fresh_name("as_of"), work_dir(spark, "as-of")
    for part in range(3):
        append_stamped(customer.where(f"c_custkey % 3 = {part}"), name, BATCH_TIME, path if part == 0 else None)
    return read_as_of(spark, name, 2).drop("update_timestamp_utc")


@query("s12_create_feature_table", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def s12_create_feature_table(spark, sf_dir):
    name = fresh_name("customers")
    features = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    create_feature_table(features, name, ["c_custkey"], work_dir(spark, "customers"))
    return spark.table(name)
