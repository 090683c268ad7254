"""Keyed rows and joins on data where one key holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tabwright.contract import ContractViolation
from tabwright.operators import keys as ks
from tabwright.operators.checks import check_all, enforce
from tabwright.operators.features import create_feature_table, feature_lookup, read_features, upsert_features
from tabwright.session import work_dir


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 997).alias("k")
    return spark.range(30000).select(key, F.col("id").alias("v"))


def test_hot_keys_are_found(spark, skewed):
    hot = ks.hot_keys(skewed, ["k"], share=0.05)
    assert hot == [spark.range(1).select(F.xxhash64(F.lit(5).cast("bigint"))).first()[0]]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("skew", ["auto", "salt", "off"])
def test_skewed_join(spark, skewed, how, skew):
    right = spark.range(0, 997, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("f"))
    joined = ks.keyed_join(skewed, right, ["k"], how, skew=skew)
    rows = skewed.collect()
    want = sorted(
        (r.k, r.v, r.k * 10 if r.k % 2 == 0 else -1) for r in rows if how == "left" or r.k % 2 == 0
    )
    assert sorted((r.k, r.v, -1 if r.f is None else r.f) for r in joined.collect()) == want
    assert joined.columns == ["k", "v", "f"]


@pytest.mark.parametrize("columns", [["k", "v"], ["k"]])
def test_hot_rows_are_spread(spark, skewed, columns):
    """Also when the rows of the hot key are all equal."""
    right = spark.range(997).select(F.col("id").alias("k"), F.col("id").alias("f"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = ks.keyed_join(skewed.select(*columns), right, ["k"])
        assert joined.where("k <> f").isEmpty()
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30000
        assert max(sizes) < 0.3 * 30000  # the hot key alone would be a third in one task
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


@pytest.mark.parametrize("columns", [["k", "v"], ["k"]])
@pytest.mark.parametrize("nested", ["array(map('a', {0}))", "named_struct('m', map('a', {0}))", "array(named_struct('v', parse_json(cast({0} as string))))"])
def test_maps_inside_other_types(spark, skewed, nested, columns):
    """Left columns that hold a map or variant at any depth, beside columns that tell rows apart and without them."""
    left = skewed.select(*columns, F.expr(nested.format("v")).alias("deep"))
    right = spark.range(997).select(F.col("id").alias("k"), (F.col("id") * 10).alias("f"))
    joined = ks.keyed_join(left, right, ["k"], skew="salt")
    assert joined.columns == [*columns, "deep", "f"]
    kept = joined.select("k", "f", F.to_json(F.struct("deep")).alias("deep")).collect()
    want = left.select("k", F.to_json(F.struct("deep")).alias("deep")).collect()
    assert sorted((r.k, r.f, r.deep) for r in kept) == sorted((r.k, 10 * r.k, r.deep) for r in want)


def test_two_joins_on_one_layout(spark, skewed):
    a = spark.range(997).select(F.col("id").alias("k"), (F.col("id") + 1).alias("a"))
    b = spark.range(0, 997, 5).select(F.col("id").alias("k"), (F.col("id") + 2).alias("b"))
    rows = ks.keyed_joins(skewed, [(a, "inner"), (b, "left")], ["k"], skew="salt").collect()
    assert len(rows) == 30000
    assert all(r.a == r.k + 1 and r.b == (r.k + 2 if r.k % 5 == 0 else None) for r in rows)


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([(None, 1), (1, 2)], "k int, v int")
    right = spark.createDataFrame([(None, 9), (1, 8)], "k int, f int")
    for skew in ("salt", "off"):
        got = sorted((r.v, r.f) for r in ks.keyed_join(left, right, ["k"], skew=skew).collect())
        assert got == [(1, None), (2, 8)]


def test_latest_with_nulls_and_ties(spark):
    rows = [(1, None, 5, "old"), (1, 3, 1, "a"), (1, 3, 2, "b"), (2, None, 1, "only")]
    df = spark.createDataFrame(rows, "k int, t int, n int, s string")
    assert sorted((r.k, r.s) for r in ks.latest_per_key(df, ["k"], ["t", "n"]).collect()) == [(1, "b"), (2, "only")]


def test_check_key_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a int, b int")
    got = {r["check"]: r["violations"] for r in ks.check_key(df, ["a", "b"]).collect()}
    assert got == {"key_not_null": 2, "key_unique": 1}
    with pytest.raises(ContractViolation, match="key_unique"):
        enforce(ks.check_key(df, ["a", "b"]))
    empty = {r["check"]: r["violations"] for r in ks.check_key(df.limit(0), ["a"]).collect()}
    assert empty == {"key_not_null": 0, "key_unique": 0}


def test_check_all(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, c string")
    assert {(r["check"], r["column"]): r["violations"] for r in check_all(df).collect()} == {
        ("not_empty", "*"): 0, ("not_null", "a.b"): 0, ("not_null", "c"): 1,
    }
    with pytest.raises(ContractViolation, match="not_empty"):
        enforce(check_all(df.limit(0)))


def test_lookup_keeps_row_count_with_repeated_features(spark, skewed):
    table = spark.range(997).select(F.col("id").alias("k"), F.lit(1).alias("f"))
    looked = feature_lookup(skewed, table.unionByName(table), ["k"], ["f"], skew="salt")
    assert looked.count() == 30000


def test_feature_table_refuses_repeated_keys(spark):
    with pytest.raises(ContractViolation):
        create_feature_table(spark.createDataFrame([(1,), (1,)], "k int"), "never_written", ["k"])
    assert not spark.catalog.tableExists("never_written")


def test_upsert_keeps_newer_rows_and_is_repeatable(spark):
    name = "upserted_" + work_dir(spark, "x").rsplit("-", 1)[1]

    def apply(*rows):
        upsert_features(spark, name, spark.createDataFrame(list(rows), "k int, t int, v string"), ["k"], ["t"])
        return sorted((r.k, r.t, r.v) for r in read_features(spark, name).collect())

    assert apply((1, 1, "a"), (2, 5, "b")) == [(1, 1, "a"), (2, 5, "b")]
    assert apply((2, 3, "late"), (1, 2, "new"), (1, 1, "old"), (3, None, "c")) == [(1, 2, "new"), (2, 5, "b"), (3, None, "c")]
    assert apply((2, 3, "late"), (1, 2, "new"), (3, None, "c")) == [(1, 2, "new"), (2, 5, "b"), (3, None, "c")]
    assert apply((2, 5, "tie")) == [(1, 2, "new"), (2, 5, "tie"), (3, None, "c")]
