"""Queries of renaming, conversion, correction, dates and selection."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import query
from registry.tables import BOOKINGS, BOOKINGS_SQL, PREPARED_SQL, bookings, contract, table
from tabwright.functions.dates import booking_date, event_time, lead_time, normalize_date, register_lead_time
from tabwright.operators.transform import (
    cast,
    cast_prediction,
    combine,
    correct_values,
    drop_columns,
    flatten_record,
    from_records_json,
    recode_target,
    rename,
    rename_back,
    select_features,
    tag_model,
    to_records_json,
)
from tabwright.sources.tables import stamp

ORDERS = contract(
    [("o_orderkey", "int64", "key"), ("o_custkey", "int64", "customer"), ("o_totalprice", "float64", "price")],
    [("o_orderpriority", "object", "priority")],
    ("o_orderstatus", "object", "status"),
)
NARROW = contract(
    [("l_extendedprice", "int16", "l_extendedprice"), ("l_discount", "int8", "l_discount"), ("l_quantity", "int64", "l_quantity")],
    [("l_linenumber", "object", "l_linenumber")],
    ("l_returnflag", "object", "l_returnflag"),
)


MANY = {5: None, 20: "many", **{100 + i: f"code {i % 7}" for i in range(40)}}


@query(
    "p3_correct_many",
    """SELECT l_partkey, l_linenumber, l_orderkey,
              CASE WHEN l_partkey = 5 THEN NULL WHEN l_partkey = 20 THEN 'many'
                   WHEN l_partkey BETWEEN 100 AND 139 THEN 'code ' || (l_partkey - 100) % 7
                   ELSE CAST(l_partkey AS VARCHAR) END AS part FROM lineitem""",
)
def p3_correct_many(spark, sf_dir):
    """Forty-two corrections of a text column by integer keys, one of them to null."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_partkey", "l_linenumber", "l_orderkey", "CAST(l_partkey AS STRING) AS part")
    return correct_values(rows, {"part": MANY})


@query(
    "p1_rename",
    """SELECT o_orderkey AS key, o_custkey AS customer, o_totalprice AS price, o_orderpriority AS priority,
              o_orderstatus AS status FROM orders""",
)
def p1_rename(spark, sf_dir):
    return rename(table(spark, sf_dir, "orders").drop("o_orderdate"), ORDERS)


@query("p1_rename_back", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus FROM orders")
def p1_rename_back(spark, sf_dir):
    return rename_back(rename(table(spark, sf_dir, "orders").drop("o_orderdate"), ORDERS), ORDERS)


@query(
    "p2_cast",
    """SELECT l_orderkey, try_cast(trunc(l_extendedprice) AS SMALLINT) AS l_extendedprice,
              CAST(trunc(l_discount * 100) AS TINYINT) AS l_discount, CAST(trunc(l_quantity) AS BIGINT) AS l_quantity,
              CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag FROM lineitem""",
)
def p2_cast(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_extendedprice", "l_discount * 100 AS l_discount", "l_quantity", "l_linenumber", "l_returnflag"
    )
    return cast(lines, NARROW)


@query(
    "p3_correct_values",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE o_orderstatus END AS o_orderstatus
       FROM orders""",
)
def p3_correct_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return correct_values(orders, {"o_orderstatus": {"F": 1, "O": 0}})


@query(
    "p3_correct_chain",
    """SELECT l_orderkey, CASE WHEN l_linenumber IN (1, 2) THEN 3 WHEN l_linenumber = 7 THEN 1 ELSE l_linenumber END
              AS l_linenumber FROM lineitem""",
)
def p3_correct_chain(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return correct_values(lines, {"l_linenumber": {1: 2, 2: 3, 7: 1}})


@query(
    "p4_recode_target",
    f"SELECT Booking_ID, CASE WHEN booking_status = 'Canceled' THEN 1 ELSE 0 END AS booking_status FROM ({BOOKINGS_SQL})",
)
def p4_recode_target(spark, sf_dir):
    return recode_target(bookings(spark, sf_dir).select("Booking_ID", "booking_status"), "booking_status")


@query("p5_normalize_date", f"SELECT booking_id, CAST(date_of_arrival AS VARCHAR) AS date_of_arrival FROM ({PREPARED_SQL})")
def p5_normalize_date(spark, sf_dir):
    arrival = normalize_date(F.col("arrival_year"), F.col("arrival_month"), F.col("arrival_date"))
    return bookings(spark, sf_dir).select(F.col("Booking_ID").alias("booking_id"), arrival.cast("string").alias("date_of_arrival"))


@query(
    "p6_booking_date",
    """SELECT o_orderkey, CAST(CAST(CAST(o_orderdate AS DATE) - CAST(o_custkey % 365 AS INTEGER) AS DATE) AS VARCHAR) AS booked
       FROM orders""",
)
def p6_booking_date(spark, sf_dir):
    booked = booking_date(F.col("o_orderdate"), F.expr("o_custkey % 365"))
    return table(spark, sf_dir, "orders").select("o_orderkey", booked.cast("string").alias("booked"))


LEAD_SQL = """SELECT l_orderkey, l_linenumber, l_partkey,
                     CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS lead_time
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _shipped(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


@query("p7_lead_time", LEAD_SQL)
def p7_lead_time(spark, sf_dir):
    days = lead_time(F.col("l_shipdate"), F.col("o_orderdate")).alias("lead_time")
    return _shipped(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", days)


@query("ud1_register_lead_time", LEAD_SQL)
def ud1_register_lead_time(spark, sf_dir):
    name = register_lead_time(spark)
    days = f"{name}(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS lead_time"
    return _shipped(spark, sf_dir).selectExpr("l_orderkey", "l_linenumber", "l_partkey", days)


@query(
    "p8_select_features",
    f"""SELECT no_of_adults, no_of_weekend_nights, lead_time, repeated_guest, avg_price_per_room, type_of_meal_plan,
               booking_status, Booking_ID AS booking_id FROM ({BOOKINGS_SQL})""",
)
def p8_select_features(spark, sf_dir):
    return select_features(rename(bookings(spark, sf_dir), BOOKINGS), BOOKINGS, ["booking_id"])


@query("p9_drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def p9_drop_columns(spark, sf_dir):
    unwanted = ["o_orderstatus", "o_orderdate", "o_orderpriority", "not_there"]
    return drop_columns(table(spark, sf_dir, "orders"), unwanted)


@query("p12_stamp", "SELECT c_custkey, '2024-03-01 08:00:00.5' AS update_timestamp_utc FROM customer")
def p12_stamp(spark, sf_dir):
    stamped = stamp(table(spark, sf_dir, "customer").select("c_custkey"), datetime(2024, 3, 1, 8, 0, 0, 500000))
    return stamped.withColumn("update_timestamp_utc", F.col("update_timestamp_utc").cast("string"))


@query(
    "p15_cast_prediction",
    """SELECT doc_id, CAST(trunc(n_chars / 1000.0) AS INTEGER) AS prediction, CAST(quality AS INTEGER) AS quality
       FROM documents JOIN labels USING (doc_id)""",
)
def p15_cast_prediction(spark, sf_dir):
    scored = table(spark, sf_dir, "documents").selectExpr("doc_id", "n_chars / 1000.0D AS prediction")
    labelled = scored.join(table(spark, sf_dir, "labels").selectExpr("doc_id", "CAST(quality AS DOUBLE) AS quality"), "doc_id")
    return cast_prediction(labelled, ["prediction", "quality"])


@query(
    "p16_event_time",
    """SELECT event_id, epoch_us(ts) // 1000000 * 1000000 AS whole, epoch_us(ts) // 1000 * 1000 AS exact FROM events""",
)
def p16_event_time(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(event_time(ms)).alias("whole"), F.unix_micros(event_time(ms, exact=True)).alias("exact")
    )


@query("p13_tag_model", "SELECT c_custkey, 'rule' AS model_name FROM customer")
def p13_tag_model(spark, sf_dir):
    return tag_model(table(spark, sf_dir, "customer").select("c_custkey"), "rule")


@query("p14_flatten_record", "SELECT c_nationkey, c_custkey AS id, c_acctbal AS balance FROM customer")
def p14_flatten_record(spark, sf_dir):
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")).alias("record")
    return flatten_record(table(spark, sf_dir, "customer").select("c_nationkey", record), "record")


@query("p17_records_json", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def p17_records_json(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return from_records_json(to_records_json(customer), customer.schema)


@query(
    "p17_records_text",
    """SELECT '{"o_orderkey":' || o_orderkey || ',"day":"' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '","none":null}'
       AS record FROM orders""",
)
def p17_records_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.lit(None).cast(T.StringType()).alias("none")
    )
    return to_records_json(orders)


@query(
    "u1_combine",
    "SELECT c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier",
)
def u1_combine(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_acctbal AS balance")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS id")
    return combine(customers, suppliers)
