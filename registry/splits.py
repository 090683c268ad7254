"""Queries of filters, splits, samples and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.tables import hash_sql, table, uniform_sql
from tabwright.operators.split import evaluation_sample, exact_split, hash_split, sample_with_replacement
from tabwright.operators.transform import drop_nulls, latest_batch, limit, partition_by_predicate, segment_filter

SEGMENT = "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END"


def _parts(*named):
    frames = [df.withColumn("part", F.lit(name)) for name, df in named]
    return frames[0].unionByName(frames[1])


@query(
    "f1_partition_by_predicate",
    f"""SELECT CASE WHEN segment = 'BUILDING' THEN 'match' ELSE 'rest' END AS part, c_custkey
        FROM (SELECT c_custkey, {SEGMENT} AS segment FROM customer)""",
)
def f1_partition_by_predicate(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.expr(SEGMENT).alias("segment"))
    match, rest = partition_by_predicate(customer, F.col("segment") == "BUILDING")
    return _parts(("match", match), ("rest", rest)).select("part", "c_custkey")


@query("f2_segment_filter", "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def f2_segment_filter(spark, sf_dir):
    return segment_filter(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING").select("c_custkey", "c_acctbal")


@query(
    "f3_latest_batch",
    """SELECT event_id, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events
       WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""",
)
def f3_latest_batch(spark, sf_dir):
    daily = table(spark, sf_dir, "events").select("event_id", "value", F.to_date("ts").alias("day"))
    return latest_batch(daily, "day").withColumn("day", F.col("day").cast("string"))


@query(
    "f4_hash_split",
    f"""SELECT o_orderkey, CASE WHEN {hash_sql('o_orderkey')} < {int(0.2 * (1 << 60))} THEN 'test' ELSE 'train' END AS part
        FROM orders""",
)
def f4_hash_split(spark, sf_dir):
    train, test = hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return _parts(("train", train), ("test", test))


@query(
    "f5_exact_split",
    f"""SELECT o_orderkey, CASE WHEN r <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS part
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {hash_sql('o_orderkey')}) AS r, count(*) OVER () AS n
              FROM orders)""",
)
def f5_exact_split(spark, sf_dir):
    train, test = exact_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return _parts(("train", train), ("test", test))


@query(
    "f5_exact_split_by_group",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN before < ceil(0.2 * n) THEN 'test' ELSE 'train' END AS part
        FROM (SELECT *, count(*) OVER (ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                        - count(*) OVER (PARTITION BY h) AS before, count(*) OVER () AS n
              FROM (SELECT *, {hash_sql('l_suppkey')} AS h FROM lineitem))""",
)
def f5_exact_split_by_group(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    train, test = exact_split(lines, ["l_suppkey"])
    return _parts(("train", train), ("test", test)).drop("l_suppkey")


@query("f6_drop_nulls", f"SELECT c_custkey, {SEGMENT} AS segment FROM customer WHERE {SEGMENT} IS NOT NULL")
def f6_drop_nulls(spark, sf_dir):
    return drop_nulls(table(spark, sf_dir, "customer").select("c_custkey", F.expr(SEGMENT).alias("segment")), ["segment"])


@query("f7_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def f7_limit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return limit(orders, 100, [F.col("o_totalprice").desc(), "o_orderkey"])


@query("f7_evaluation_sample", f"SELECT o_orderkey FROM orders ORDER BY {hash_sql('o_orderkey')} LIMIT 100")
def f7_evaluation_sample(spark, sf_dir):
    return evaluation_sample(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 100)


@query(
    "f8_sample_with_replacement",
    f"""WITH ranked AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY {hash_sql('o_orderkey')}, o_orderkey) - 1 AS nth FROM orders),
             drawn AS (SELECT CAST(floor({uniform_sql('i', 'draw')} * (SELECT count(*) FROM orders)) AS BIGINT) AS nth FROM range(3000) t(i))
        SELECT o_orderkey, o_totalprice FROM drawn JOIN ranked USING (nth)""",
)
def f8_sample_with_replacement(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sample_with_replacement(orders, 3000, ["o_orderkey"])


