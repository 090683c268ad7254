import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tabwright.operators import split as sp


@pytest.mark.parametrize("n", [0, 1, 7, 1000, 12345])
@pytest.mark.parametrize("test", [0.0, 0.2, 0.125, 1.0])
def test_exact_counts(spark, n, test):
    train, held = sp.exact_split(spark.range(n), ["id"], test)
    assert held.count() == math.ceil(test * n)
    assert train.count() + held.count() == n


def test_small_ranges_are_refined(spark, monkeypatch):
    monkeypatch.setattr(sp, "_SMALL", 0)
    train, held = sp.exact_split(spark.range(5000), ["id"])
    assert (train.count(), held.count()) == (4000, 1000)


def test_copies_of_a_key_stay_together(spark, monkeypatch):
    monkeypatch.setattr(sp, "_SMALL", 10)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("id"))
    train, held = sp.exact_split(df, ["id"])
    assert train.join(held, "id", "left_semi").isEmpty()
    assert train.count() + held.count() == 3000 and held.count() >= 600


def test_parts_are_disjoint_and_complete(spark):
    df = spark.range(20000)
    train, held = sp.hash_split(df, ["id"], 0.2, 1)
    assert train.unionByName(held).distinct().count() == 20000
    assert train.count() + held.count() == 20000
    assert abs(held.count() - 4000) < 250


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000)
    for method in (sp.hash_split, sp.exact_split):
        one = {r[0] for r in method(df.repartition(1), ["id"])[1].collect()}
        many = {r[0] for r in method(df.repartition(13), ["id"])[1].collect()}
        assert one == many
        assert one != {r[0] for r in method(df, ["id"], seed=7)[1].collect()}


@pytest.mark.parametrize("rows, n", [(50, 100), (1, 7), (7, 1), (30000, 900), (9000, 9000), (50, 0)])
def test_sample_with_replacement(spark, rows, n):
    """Against ranks and draws worked out plainly."""
    df = spark.range(rows).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = sorted(map(tuple, sp.sample_with_replacement(df.repartition(5), n, ["k"], 3).collect()))

    def digest(text):
        return hashlib.md5(f"{text}|3".encode()).hexdigest()

    ranked = sorted(range(rows), key=lambda k: digest(k)[:15])
    drawn = [ranked[int(int(digest(f"{i}|draw")[:13], 16) / 2**52 * rows)] for i in range(n)]
    assert got == sorted((k, 2 * k) for k in drawn) and len(got) == n


def test_sample_of_repeated_keys_and_of_nothing(spark):
    drawn = sp.sample_with_replacement(spark.range(300).selectExpr("id % 3 AS k", "id AS v"), 600, ["k"])
    assert drawn.count() == 600 and drawn.where("k <> v % 3").isEmpty() and drawn.select("v").distinct().count() > 200
    assert sp.sample_with_replacement(spark.range(0), 5, ["id"]).count() == 0
