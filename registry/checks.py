"""Queries of the data checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import query
from registry.tables import table
from tabwright.operators.checks import cast_losses, check_not_empty, check_nulls
from tabwright.operators.keys import check_key, repeated_keys

LINEITEM = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "l_note",
)
NOTE = "CASE WHEN l_quantity > 40 THEN NULL ELSE l_tax END"
MIXED = "CASE WHEN o_orderkey % 7 = 0 THEN 'x' || o_custkey ELSE CAST(o_orderkey * 5 AS VARCHAR(20)) END"


@query(
    "v3_check_nulls",
    " UNION ALL ".join(
        f"""SELECT 'not_null' AS "check", '{c}' AS "column", count(*) - count({c}) AS violations
            FROM (SELECT *, {NOTE} AS l_note FROM lineitem)"""
        for c in LINEITEM
    ),
)
def v3_check_nulls(spark, sf_dir):
    return check_nulls(table(spark, sf_dir, "lineitem").withColumn("l_note", F.expr(NOTE)))


@query(
    "v4_check_not_empty",
    """SELECT 'all' AS part, 'not_empty' AS "check", '*' AS "column",
              CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations FROM orders
       UNION ALL SELECT 'none', 'not_empty', '*', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END
       FROM orders WHERE o_totalprice < 0""",
)
def v4_check_not_empty(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    parts = {"all": orders, "none": orders.where("o_totalprice < 0")}
    found = [check_not_empty(df).select(F.lit(name).alias("part"), "*") for name, df in parts.items()]
    return found[0].unionByName(found[1])


@query(
    "v6_cast_losses",
    f"""SELECT 'cast' AS "check", 'mixed' AS "column",
               CAST(sum(CASE WHEN try_cast(mixed AS SMALLINT) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS violations
        FROM (SELECT {MIXED} AS mixed FROM orders)
        UNION ALL SELECT 'cast', 'price',
               CAST(sum(CASE WHEN trunc(o_totalprice) > 32767 THEN 1 ELSE 0 END) AS BIGINT) FROM orders""",
)
def v6_cast_losses(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    mixed = orders.select(F.expr(MIXED.replace("VARCHAR(20)", "STRING")).alias("mixed"), F.col("o_totalprice").alias("price"))
    return cast_losses(mixed, {"mixed": T.ShortType(), "price": T.ShortType()})


@query(
    "v7_check_key",
    """SELECT 'key_not_null' AS "check", 'l_orderkey,l_linenumber' AS "column", count(*) AS violations
       FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL
       UNION ALL SELECT 'key_unique', 'l_orderkey,l_linenumber', count(*)
       FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def v7_check_key(spark, sf_dir):
    return check_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "v7_repeated_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def v7_repeated_keys(spark, sf_dir):
    return repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
