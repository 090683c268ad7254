"""Queries of lookups, inference logs, labels and monitoring rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.tables import (
    FEATURES_SQL,
    MONITORING_SQL,
    PARSED_SQL,
    RECORD,
    booking_features,
    fresh_name,
    inference_log,
    label_sources,
    table,
)
from tabwright.functions.dates import lead_time
from tabwright.operators.features import Lookup, create_feature_table, feature_lookup, lookup_in_table, lookup_keys, training_set, upsert_features
from tabwright.operators.inference_log import (
    attach_features,
    attach_labels,
    build_monitoring,
    dropped_payloads,
    new_only,
    parse_inference_log,
)
from tabwright.operators.keys import latest_per_key
from tabwright.session import work_dir

# A third of all orders belong to one customer, and some customers have no features.
SKEWED = "CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END"


@query(
    "g1_latest_per_key",
    """SELECT user_id, event_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
)
def g1_latest_per_key(spark, sf_dir):
    newest = latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", "value")


@query(
    "j1_feature_lookup",
    """SELECT o_orderkey, o_custkey AS c_custkey, c_acctbal, c_nationkey FROM orders
       LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey""",
)
def j1_feature_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey AS c_custkey")
    features = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    return feature_lookup(orders, features, ["c_custkey"], ["c_acctbal", "c_nationkey"], unique=True)


@query(
    "j1_feature_lookup_hot_key",
    f"""SELECT o_orderkey, o.c_custkey, c_acctbal, c_nationkey
        FROM (SELECT o_orderkey, {SKEWED} AS c_custkey FROM orders) o
        LEFT JOIN customer c ON o.c_custkey = c.c_custkey""",
)
def j1_feature_lookup_hot_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{SKEWED} AS c_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    # every customer is listed twice; the row with the higher balance counts
    doubled = customer.unionByName(customer.withColumn("c_acctbal", F.col("c_acctbal") - 1))
    names = ["c_acctbal", "c_nationkey"]
    return feature_lookup(orders, doubled, ["c_custkey"], names, order=["c_acctbal"], skew="salt")


@query(
    "j2_training_set",
    """SELECT l_orderkey, l_partkey, l_returnflag, p_size, o_custkey,
              CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS lead_time
       FROM lineitem LEFT JOIN (SELECT p_partkey, p_size FROM part) ON l_partkey = p_partkey
       LEFT JOIN (SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""",
)
def j2_training_set(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").withColumnRenamed("o_orderkey", "l_orderkey")
    return training_set(
        lines,
        "l_returnflag",
        [
            Lookup(parts, ("l_partkey",), ("p_size",)),
            Lookup(orders, ("l_orderkey",), ("o_custkey",), unique=True),
            Lookup(orders, ("l_orderkey",), ("o_orderdate",), unique=True),
        ],
        {"lead_time": lead_time(F.col("l_shipdate"), F.col("o_orderdate"))},
        exclude=["l_shipdate", "o_orderdate"],
    )


@query(
    "j3_attach_labels",
    """SELECT doc_id, CAST(CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS INTEGER) AS prediction,
              CAST(CASE WHEN doc_id % 2 = 0 THEN quality ELSE toxic END AS INTEGER) AS label
       FROM documents JOIN labels USING (doc_id) WHERE doc_id % 10 <> 3""",
)
def j3_attach_labels(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "CASE WHEN doc_id % 10 <> 3 THEN CAST(n_chars > 500 AS INT) END AS prediction"
    )
    labels = table(spark, sf_dir, "labels")
    first = labels.where("doc_id % 2 = 0").selectExpr("doc_id", "quality AS label")
    second = labels.selectExpr("doc_id", "toxic AS label")
    return attach_labels(documents, [first, second], "doc_id", "label")


@query(
    "j4_attach_features",
    f"""SELECT event_id AS booking_id, value, guest FROM events LEFT JOIN ({FEATURES_SQL}) f ON event_id = f.booking_id""",
)
def j4_attach_features(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    scored = events.selectExpr("event_id AS booking_id", "value")
    return attach_features(scored, booking_features(events), "booking_id", order=["version"])


PARSED = ("timestamp_ms", "second", "request_id", "position", "booking_id", "amount", "kind", "prediction")


def _with_second(df):
    return df.withColumn("second", F.unix_seconds("timestamp"))


@query(
    "j5_parse_inference_log",
    f"""SELECT * REPLACE (CAST(prediction AS BIGINT) AS prediction)
        FROM (SELECT {', '.join(PARSED)}, 'rule' AS model_name FROM ({PARSED_SQL}))""",
)
def j5_parse_inference_log(spark, sf_dir):
    parsed = parse_inference_log(inference_log(table(spark, sf_dir, "events")), RECORD, "rule")
    return _with_second(parsed).select(*PARSED, "model_name")


@query(
    "j5_parse_first_prediction",
    f"""SELECT request_id, position, booking_id,
               max(CASE WHEN position = 0 THEN prediction END) OVER (PARTITION BY request_id) AS prediction
        FROM ({PARSED_SQL})""",
)
def j5_parse_first_prediction(spark, sf_dir):
    log = inference_log(table(spark, sf_dir, "events"))
    parsed = parse_inference_log(log, RECORD, "rule", first_only=True)
    return parsed.select("request_id", "position", "booking_id", F.col("prediction").cast("int").alias("prediction"))


@query(
    "j5_dropped_payloads",
    """SELECT 'unreadable request' AS reason, count(*) AS n FROM events WHERE event_id % 97 = 0
       UNION ALL SELECT 'no records', count(*) FROM events WHERE event_id % 97 <> 0 AND event_id % 101 = 0
       UNION ALL SELECT 'unreadable response', 0""",
)
def j5_dropped_payloads(spark, sf_dir):
    return dropped_payloads(inference_log(table(spark, sf_dir, "events")), RECORD)


MONITORED = (*PARSED, "booking_status", "guest")


@query("j6_build_monitoring", f"SELECT {', '.join(MONITORED)} FROM ({MONITORING_SQL})")
def j6_build_monitoring(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rows = build_monitoring(
        inference_log(events),
        RECORD,
        "rule",
        label_sources(events),
        booking_features(events),
        "booking_id",
        "booking_status",
        order=["version"],
    )
    return _with_second(rows).select(*MONITORED)


@query(
    "j6_build_monitoring_again",
    f"SELECT request_id, position, booking_id, booking_status FROM ({MONITORING_SQL}) WHERE booking_id % 5 <> 0",
)
def j6_build_monitoring_again(spark, sf_dir):
    """A refresh over the whole log when a fifth of the bookings are loaded already."""
    events = table(spark, sf_dir, "events")
    log = inference_log(events)
    loaded = parse_inference_log(log, RECORD, "rule").where("booking_id % 5 = 0")
    rows = build_monitoring(
        log,
        RECORD,
        "rule",
        label_sources(events),
        booking_features(events),
        "booking_id",
        "booking_status",
        order=["version"],
        existing=loaded,
    )
    return rows.select("request_id", "position", "booking_id", "booking_status")


@query(
    "j1_bucketed_lookups",
    """SELECT o_orderkey, c_mktsegment, c_acctbal, c_nationkey FROM orders LEFT JOIN customer ON o_custkey * 2 = c_custkey""",
)
def j1_bucketed_lookups(spark, sf_dir):
    """Three tables bucketed by their key; only the orders are shuffled, once."""
    customer, lookups = table(spark, sf_dir, "customer"), []
    for column in ("c_mktsegment", "c_acctbal", "c_nationkey"):
        name = fresh_name(column)
        create_feature_table(customer.select("c_custkey", column), name, ["c_custkey"], work_dir(spark, column), lookup_buckets=8)
        lookups.append(Lookup(spark.table(name), ("c_custkey",), (column,), unique=True))
    asking = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey * 2 AS c_custkey")
    return training_set(asking, "o_orderkey", lookups, skew="off").drop("c_custkey")


@query(
    "j7_lookup_in_buckets",
    """SELECT o_custkey * 2 AS c_custkey, c_name, c_acctbal FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 100 = 0)
       LEFT JOIN customer ON o_custkey * 2 = c_custkey""",
)
def j7_lookup_in_buckets(spark, sf_dir):
    """Some keys from a table in buckets."""
    name = fresh_name("customers")
    features = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    upsert_features(spark, name, features, ["c_custkey"], ["c_acctbal"], work_dir(spark, "customers"), buckets=64)
    asked = table(spark, sf_dir, "orders").where("o_orderkey % 100 = 0").selectExpr("o_custkey * 2 AS c_custkey").distinct()
    return lookup_in_table(spark, name, asked)


@query(
    "j7_lookup_keys",
    """SELECT DISTINCT o_custkey * 2 AS c_custkey, c_name, c_acctbal FROM orders
       LEFT JOIN customer ON o_custkey * 2 = c_custkey""",
)
def j7_lookup_keys(spark, sf_dir):
    asked = table(spark, sf_dir, "orders").selectExpr("o_custkey * 2 AS c_custkey").distinct()
    features = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return lookup_keys(features, asked, ["c_custkey"])


@query(
    "j8_new_only",
    """SELECT c_custkey, c_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def j8_new_only(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 400000").withColumnRenamed("o_custkey", "c_custkey")
    return new_only(customer, orders, ["c_custkey"])
