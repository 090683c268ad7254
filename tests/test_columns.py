"""Dates, corrections and conversions against plain Python."""

import bisect
import calendar
import datetime as dt
import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.dates import event_time, normalize_date
from tabwright.functions.values import converted, resolve_chain
from tabwright.operators.transform import correct_values, preview, recode_target


def first_valid(year, month, day):
    """The first date of the calendar whose parts, compared one after another, are not below the given ones."""
    near = [y for y in {1, year, year + 1} if 1 <= y <= 9999]
    valid = sorted((y, m, d) for y in near for m in range(1, 13) for d in range(1, calendar.monthrange(y, m)[1] + 1))
    at = bisect.bisect_left(valid, (year, month, day))
    return dt.date(*valid[at]) if at < len(valid) else None


LITERAL = [
    (2018, 2, 28, "2018-02-28"), (2018, 2, 29, "2018-03-01"), (2020, 2, 29, "2020-02-29"), (2023, 12, 32, "2024-01-01"),
    (2025, 2, 1, "2025-02-01"), (2025, 2, 29, "2025-03-01"), (2025, 2, 31, "2025-03-01"), (2025, 13, 1, "2026-01-01"),
]


def test_literal_dates(spark):
    df = spark.createDataFrame(LITERAL, "y int, m int, d int, want string")
    assert df.where(normalize_date(F.col("y"), F.col("m"), F.col("d")).cast("string") != F.col("want")).isEmpty()


def test_dates_are_the_first_valid_ones(spark):
    years = [-3, 0, 1, 1900, 2000, 2018, 2020, 9998, 9999]
    cases = list(itertools.product(years, range(-2, 16), range(-2, 36)))
    rows = [(y, m, d, first_valid(y, m, d)) for y, m, d in cases]
    df = spark.createDataFrame(rows, "y int, m int, d int, want date")
    found = df.where(~normalize_date(F.col("y"), F.col("m"), F.col("d")).eqNullSafe(F.col("want")))
    assert found.collect() == []


def test_dates_out_of_range(spark):
    df = spark.createDataFrame([(10000, 1, 1), (None, 1, 1), (2020, 1, None)], "y int, m int, d int")
    assert [r[0] for r in df.select(normalize_date(F.col("y"), F.col("m"), F.col("d"))).collect()] == [None] * 3


def test_event_time_before_the_epoch(spark):
    df = spark.createDataFrame([(1500,), (-1,), (-1000,)], "ms long")
    assert [r[0] for r in df.select(F.unix_seconds(event_time(F.col("ms")))).collect()] == [1, -1, -1]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 6), st.integers(0, 6)), st.integers(0, 7))
def test_chain_is_one_by_one(corrections, value):
    one_by_one = value
    for old, new in corrections.items():
        one_by_one = new if one_by_one == old else one_by_one
    assert resolve_chain(corrections).get(value, value) == one_by_one


def test_literal_corrections(spark):
    df = spark.createDataFrame([(0, 0, -1), (5, 1, -2), (6, 0, 0)], "Education int, Marriage int, Pay int")
    fixed = correct_values(df, {"Education": {0: 4, 5: 4, 6: 4}, "Marriage": {0: 3}, "Pay": {-1: 0, -2: 0}})
    assert [tuple(r) for r in fixed.collect()] == [(4, 3, 0), (4, 1, 0), (4, 3, 0)]


def test_many_corrections_use_a_table(spark):
    df = spark.range(50).withColumn("id", F.col("id").cast("int"))
    fixed = correct_values(df, {"id": {i: i + 100 for i in range(40)}})
    assert sorted(r[0] for r in fixed.collect()) == list(range(40, 50)) + list(range(100, 140))


@pytest.mark.parametrize("extra", [0, 14, 15, 38])
def test_corrections_do_not_depend_on_their_number(spark, extra):
    """Null targets, nulls and values without a correction, for integers and for text with integer keys."""
    changes = {0: None, 1: 5, **{100 + i: 200 + i for i in range(extra)}}
    df = spark.createDataFrame([(0, "0"), (1, "1"), (2, "2"), (None, None), (100, "100")], "n bigint, s string")
    fixed = correct_values(df, {"n": changes, "s": changes})
    last = 200 if extra else 100
    assert [tuple(r) for r in fixed.collect()] == [(None, None), (5, "5"), (2, "2"), (None, None), (last, str(last))]
    assert fixed.schema["s"].dataType == T.StringType()
    strict = correct_values(df.where("n < 2"), {"n": changes}, strict=True)
    assert sorted(r.n for r in strict.where("n is not null").collect()) == [5]


def test_unknown_target(spark):
    df = spark.createDataFrame([("Canceled",), ("Lost",), (None,)], "s string")
    lenient = recode_target(df, "s", strict=False)
    assert [r[0] for r in lenient.collect()] == ["1", "Lost", None]
    with pytest.raises(Exception, match="unmapped value in s: Lost"):
        recode_target(df, "s").collect()
    assert recode_target(df.where("s <> 'Lost' or s is null"), "s").schema["s"].dataType == T.IntegerType()


@pytest.mark.parametrize(
    ("source", "target", "pairs"),
    [
        ("double", T.ShortType(), [(2.9, 2), (-2.9, -2), (32767.9, 32767), (32768.0, None), (-32768.9, -32768), (float("nan"), None)]),
        ("double", T.LongType(), [(9.3e18, None), (-(2.0**63), -(2**63)), (1e18, 10**18), (float("inf"), None)]),
        ("bigint", T.ByteType(), [(127, 127), (128, None), (-128, -128), (-129, None)]),
        ("string", T.ShortType(), [("3", 3), ("3.7", 3), (" 4 ", 4), ("x", None), ("40000", None), ("1e2", 100), ("", None)]),
        ("string", T.LongType(), [("9007199254740993", 9007199254740993), ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None)]),
        ("string", T.DoubleType(), [("3.5", 3.5), ("x", None)]),
        ("int", T.StringType(), [(3, "3"), (None, None)]),
    ],
)
def test_conversions(spark, source, target, pairs):
    df = spark.createDataFrame([(a,) for a, _ in pairs], f"v {source}")
    got = [r[0] for r in df.select(converted(F.col("v"), df.schema["v"].dataType, target)).collect()]
    assert got == [b for _, b in pairs]


def test_preview_is_the_ordered_start(spark):
    df = spark.range(100).select((F.col("id") * 37 % 100).alias("v"))
    assert [r.v for r in preview(df, 3, [F.desc("v")])] == [99, 98, 97]
    assert preview(df.limit(0), 3, ["v"]) == []


def test_ddl_with_commas_through_build_features(spark):
    from registry.tables import fresh_name
    from tabwright.plans.training import build_features

    name = fresh_name("ddl")
    made = spark.sql("SELECT 'k' AS id, CAST(1.5 AS DECIMAL(10,2)) AS n, named_struct('a', 1, 'b', 'x') AS s")
    build_features(spark, name, [made, made.withColumn("id", F.lit("l"))], "id STRING, n DECIMAL(10,2), s STRUCT<a: INT, b: STRING>", ["id"])
    assert sorted((r.id, str(r.n), r.s.b) for r in spark.table(name).collect()) == [("k", "1.50", "x"), ("l", "1.50", "x")]
