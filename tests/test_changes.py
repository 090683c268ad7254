"""Feature tables in buckets, tables as of a version, and changes between versions."""

import pytest
from pyspark.sql import functions as F

from registry.tables import fresh_name
from tabwright.operators import features as ft
from tabwright.session import work_dir
from tabwright.sources import changes as ch
from tabwright.sources import tables as tb

SCHEMA = "k int, g string, t int, v string"
KEY = ["k", "g"]


def rows(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def held(spark, name):
    return sorted(((r.k, r.g, r.t, r.v) for r in ft.read_features(spark, name).collect()), key=repr)


def files(spark, name):
    return set(spark.table(name).inputFiles())


@pytest.fixture
def wide(spark):
    """2,000 keys in 32 buckets."""
    name = fresh_name("wide")
    made = spark.range(2000).selectExpr("CAST(id AS INT) AS k", "'a' AS g", "1 AS t", "CAST(id AS STRING) AS v")
    assert ft.upsert_features(spark, name, made, KEY, ["t"], work_dir(spark, "wide"), buckets=32) == 32
    return name


def test_untouched_buckets_keep_their_files(spark, wide):
    before = files(spark, wide)
    assert ft.upsert_features(spark, wide, rows(spark, (5, "a", 2, "new"), (-7, "a", 1, "first")), KEY, ["t"]) in (1, 2)
    after = files(spark, wide)
    assert len(before - after) <= 2 and len(before & after) >= 30
    assert spark.table(wide).count() == 2001
    assert ft.read_features(spark, wide).where("k = 5").first().v == "new"


def test_rows_that_change_nothing_write_nothing(spark, wide):
    before = files(spark, wide)
    same = spark.table(wide).drop(ft.BUCKET)
    assert ft.upsert_features(spark, wide, same.unionByName(rows(spark, (5, "a", 0, "older"))), KEY, ["t"]) == 0
    assert files(spark, wide) == before
    # as new, but different: the update counts
    assert ft.upsert_features(spark, wide, rows(spark, (5, "a", 1, "tie")), KEY, ["t"]) == 1


def test_null_keys_and_null_order(spark):
    name = fresh_name("nulls")

    def apply(*given):
        ft.upsert_features(spark, name, rows(spark, *given), KEY, ["t"])
        return held(spark, name)

    first = [(1, None, 1, "a"), (None, None, None, "b")]
    assert apply(*first) == apply(*first) == sorted(first, key=repr)
    assert apply((1, None, 2, "c"), (None, None, 0, "d")) == sorted([(1, None, 2, "c"), (None, None, 0, "d")], key=repr)
    assert apply((None, None, None, "older")) == sorted([(1, None, 2, "c"), (None, None, 0, "d")], key=repr)


def test_a_plain_table_gets_buckets_and_keeps_its_rows(spark, tmp_path):
    name = fresh_name("plain")
    rows(spark, (1, "a", 1, "x"), (2, "b", 1, "y")).write.option("path", str(tmp_path / "plain")).saveAsTable(name)
    tb.mark_for_change_capture(spark, [name])
    ft.upsert_features(spark, name, rows(spark, (2, "b", 2, "z")), KEY, ["t"], str(tmp_path))
    assert held(spark, name) == [(1, "a", 1, "x"), (2, "b", 2, "z")]
    properties = tb.table_properties(spark, name)
    assert properties["primary_key"] == "k,g" and properties[ft.BUCKETS] == "16" and properties[tb.CHANGE_FEED] == "true"


def test_update_types_follow_the_table(spark, wide):
    ft.upsert_features(spark, wide, spark.sql("SELECT 5L AS k, 'a' AS g, 9L AS t, 12 AS v"), KEY, ["t"])
    assert [r.v for r in spark.table(wide).where("k = 5").collect()] == ["12"]


def test_a_broken_run_is_completed(spark, wide, monkeypatch):
    """The run stops when the buckets are written but not in place; then they are half in place."""
    real = ft.overwrite_partitions

    def lost(rows_, table, by):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(ft, "overwrite_partitions", lost)
    with pytest.raises(RuntimeError):
        ft.upsert_features(spark, wide, rows(spark, (5, "a", 2, "new"), (6, "a", 2, "new")), KEY, ["t"])
    monkeypatch.setattr(ft, "overwrite_partitions", real)
    pending = tb.table_properties(spark, wide)[ft.PENDING]
    bucket = spark.table(wide).where("k = 6").first()[ft.BUCKET]
    spark.sql(f"ALTER TABLE {wide} DROP PARTITION ({ft.BUCKET} = {bucket})")
    assert pending.startswith("2 ")
    ft.upsert_features(spark, wide, rows(spark, (7, "a", 2, "newer")), KEY, ["t"])
    got = {r.k: r.v for r in spark.table(wide).collect()}
    assert len(got) == 2000 and (got[5], got[6], got[7], got[8]) == ("new", "new", "newer", "8")
    properties = tb.table_properties(spark, wide)
    assert properties[ft.PENDING] == "" and properties[ch.APPLIED] == "3"


def test_lookup_reads_the_buckets_of_the_asked_keys(spark, wide):
    asked = spark.createDataFrame([(5, "a"), (5, "a"), (-1, "a")], "k int, g string")
    found = ft.lookup_in_table(spark, wide, asked)
    assert sorted((r.k, r.v) for r in found.collect()) == [(-1, None), (5, "5"), (5, "5")]
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [_bucket" in plan


def test_recorded_changes(spark, wide):
    tb.mark_for_change_capture(spark, [wide])
    first = ft.read_features(spark, wide)
    base = spark.createDataFrame(first.collect(), first.schema)
    ft.upsert_features(spark, wide, rows(spark, (5, "a", 2, "two"), (9999, "a", 1, "in")), KEY, ["t"])
    ft.upsert_features(spark, wide, rows(spark, (5, "a", 3, "three")), KEY, ["t"])
    ft.upsert_features(spark, wide, rows(spark, (5, "a", 1, "late")), KEY, ["t"])
    found = ch.table_changes(spark, wide, 1)
    assert sorted((r[ch.VERSION], r[ch.CHANGE], r.k, r.v) for r in found.collect()) == [
        (2, "insert", 9999, "in"), (2, "update_postimage", 5, "two"), (2, "update_preimage", 5, "5"),
        (3, "update_postimage", 5, "three"), (3, "update_preimage", 5, "two"),
    ]
    assert {r.v for r in ch.table_changes(spark, wide, 2).collect()} == {"two", "three"}
    now = ft.read_features(spark, wide)
    again = ch.replay(base, found, KEY)
    assert again.exceptAll(now).isEmpty() and now.exceptAll(again).isEmpty()
    with pytest.raises(ValueError):
        ch.table_changes(spark, "nowhere", 1)


def brute_changes(before, after):
    out = []
    for k in {*before, *after}:
        if k not in before:
            out.append(("insert", *k, *after[k]))
        elif k not in after:
            out.append(("delete", *k, *before[k]))
        elif before[k] != after[k]:
            out += [("update_preimage", *k, *before[k]), ("update_postimage", *k, *after[k])]
    return sorted(out, key=repr)


def test_row_changes_against_brute_force(spark):
    def state(seed):
        made = {(i if i % 17 else None, "g" if i % 5 else None): (i % seed, str(i // seed)) for i in range(300) if (i * seed) % 7 > 1}
        return made, rows(spark, *((*k, *v) for k, v in made.items()))

    (a, before), (b, after) = state(4), state(9)
    found = ch.row_changes(before, after.select("v", "t", "g", "k"), KEY)
    assert sorted(((r[ch.CHANGE], r.k, r.g, r.t, r.v) for r in found.collect()), key=repr) == brute_changes(a, b)
    assert ch.row_changes(before, before, KEY).isEmpty()
    assert {r[ch.CHANGE] for r in ch.row_changes(before.limit(0), after, KEY).collect()} == {"insert"}
    whole = ch.replay(before, found, KEY)
    assert sorted(map(tuple, whole.select("k", "g", "t", "v").collect()), key=repr) == sorted(((*k, *v) for k, v in b.items()), key=repr)


def test_maps_and_structs_can_change(spark):
    before = spark.sql("SELECT 1 AS k, map('a', 1) AS m, named_struct('x', 1) AS s UNION ALL SELECT 2, map('b', 2), named_struct('x', 2)")
    after = spark.sql("SELECT 1 AS k, map('a', 5) AS m, named_struct('x', 1) AS s UNION ALL SELECT 2, map('b', 2), named_struct('x', 2)")
    assert sorted((r.k, r.m["a"], r[ch.CHANGE]) for r in ch.row_changes(before, after, ["k"]).collect()) == [
        (1, 1, "update_preimage"), (1, 5, "update_postimage"),
    ]


@pytest.fixture(scope="module")
def log(spark):
    name = fresh_name("log")
    for i, batch in enumerate([[(1, "a", 1, "x"), (2, "a", 1, "y"), (3, "a", 1, "z")], [(2, "a", 2, "yy"), (4, "a", 1, "w")], [(1, "a", 2, None)]]):
        tb.append_stamped(rows(spark, *batch).withColumn("gone", F.lit(i == 2)), name)
    return name


def test_versions_of_a_log(spark, log):
    def at(version):
        return sorted((r.k, r.v) for r in ch.state_as_of(spark, log, ["k"], version, deleted="gone").collect())

    assert at(1) == [(1, "x"), (2, "y"), (3, "z")]
    assert at(2) == [(1, "x"), (2, "yy"), (3, "z"), (4, "w")]
    assert at(3) == at(None) == [(2, "yy"), (3, "z"), (4, "w")]
    assert ch.read_as_of(spark, log, 2).count() == 5 and ch.read_as_of(spark, log).count() == 6
    for wrong in (0, 4):
        with pytest.raises(ValueError):
            ch.read_as_of(spark, log, wrong)
    with pytest.raises(ValueError):
        ch.read_as_of(spark, "nowhere", 1)
    assert "PartitionFilters: [isnotnull(batch_id" in ch.read_as_of(spark, log, 1)._jdf.queryExecution().toString()


def test_changes_of_a_log(spark, log):
    def between(since, until=None):
        found = ch.table_changes(spark, log, since, until, ["k"], deleted="gone")
        return sorted((r.k, r.v, r[ch.CHANGE]) for r in found.collect())

    assert between(1, 2) == [(2, "y", "update_preimage"), (2, "yy", "update_postimage"), (4, "w", "insert")]
    assert between(2) == [(1, "x", "delete")]
    assert between(0, 1) == [(1, "x", "insert"), (2, "y", "insert"), (3, "z", "insert")]
    assert between(3) == []
