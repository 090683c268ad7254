import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from registry.tables import BOOKINGS, bookings, fresh_name
from tabwright.contract import ContractViolation
from tabwright.operators import synth
from tabwright.operators.checks import cast_losses, enforce
from tabwright.operators.transform import partition_by_predicate
from tabwright.plans.ingest import Prepared, check_processed, check_unprocessed, ingest, prepare, split
from tabwright.session import shared_dir, work_dir
from tabwright.sources import tables as tb
from tabwright.sources.files import CORRUPT, read_csv, well_formed, write_csv


def test_csv_columns_are_matched_by_name(spark, tmp_path, sf_dir):
    source = bookings(spark, sf_dir)
    path = str(tmp_path / "csv")
    write_csv(source.select(*reversed(source.columns)), path)
    back = well_formed(read_csv(spark, path, BOOKINGS))
    assert back.schema["lead_time"].dataType.simpleString() == "smallint"
    assert back.select(*source.columns).exceptAll(source.selectExpr(*[
        f"CAST({c} AS SMALLINT) AS {c}" if back.schema[c].dataType.simpleString() == "smallint" else c for c in source.columns
    ])).isEmpty()


def test_bad_csv_records_are_kept_apart(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("Booking_ID,lead_time,extra\nA,3,x\nB,many,y\nC,4\n")
    rows = read_csv(spark, str(path), BOOKINGS)
    assert sorted(r["Booking_ID"] for r in well_formed(rows).collect()) == ["A"]
    assert sorted(r[CORRUPT] for r in rows.where(F.col(CORRUPT).isNotNull()).collect()) == ["B,many,y", "C,4"]


def test_csv_files_must_agree_on_their_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n20,10\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_csv_errors(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_csv(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("a,b\n")
    for name in ("empty.csv", "header.csv"):
        with pytest.raises(ContractViolation):
            read_csv(spark, str(tmp_path / name))


def test_ingest_stops_at_a_malformed_record(spark, sf_dir, tmp_path):
    rows = bookings(spark, sf_dir).limit(5).collect()
    names = rows[0].asDict()
    lines = [",".join(names), *[",".join(str(r[n]) for n in names) for r in rows]]
    path = tmp_path / "bookings.csv"

    def run():
        tables = {part: fresh_name(part) for part in ("train", "test", "extra")}
        places = {part: work_dir(spark, part) for part in tables}
        made = ingest(spark, str(path), BOOKINGS, tables, "booking_id", ("market_segment_type", "Online"), locations=places)
        return sum(spark.table(name).count() for name in made.values())

    path.write_text("\n".join(lines))
    assert run() == 5
    path.write_text("\n".join([*lines, "B9,1,2"]))
    with pytest.raises(ContractViolation, match="well_formed"):
        run()


def test_versions_and_properties(spark):
    name = fresh_name("t")
    assert tb.data_version(spark, name) is None
    df = spark.range(3)
    assert tb.append_stamped(df, name, path=work_dir(spark, name)) == 1
    assert tb.append_stamped(df, name) == 2
    assert tb.data_version(spark, name) == 2
    stamps = [r[0] for r in spark.table(name).groupBy(tb.BATCH).agg(F.count_distinct(tb.STAMP)).select(F.col(tb.BATCH)).collect()]
    assert sorted(stamps) == [1, 2]
    tb.mark_for_change_capture(spark, [name])
    assert tb.table_properties(spark, name)[tb.CHANGE_FEED] == "true"
    tb.drop_table(spark, name)
    tb.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_create_table_declares_its_key(spark):
    name = fresh_name("t")
    tb.create_table(spark, name, "id STRING, n INT, m INT", ["id"], work_dir(spark, name))
    assert spark.table(name).columns == ["id", "n", "m"] and spark.table(name).isEmpty()
    assert tb.table_properties(spark, name)["primary_key"] == "id"
    with pytest.raises(Exception, match="(?i)null"):
        tb.insert_select(spark.createDataFrame([(None, 1, 2)], "id string, n int, m int"), name, ["id", "n", "m"])


def test_versions_come_from_the_list_of_partitions(spark):
    name = fresh_name("batches")
    assert tb.data_version(spark, name) is None
    for i in range(12):
        tb.append_stamped(spark.range(i, i + 2), name)
    assert tb.data_version(spark, name) == 12
    newest = tb.newest_batch(spark, name)
    assert sorted(r.id for r in newest.collect()) == [11, 12]
    plan = newest._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "FileScan" not in tb.latest_version(spark, name)._jdf.queryExecution().toString()


def test_a_table_made_again_is_empty(spark):
    name, path = fresh_name("again"), work_dir(spark, "again")
    for _ in range(2):
        tb.create_table(spark, name, "id STRING, price DECIMAL(10,2), pair STRUCT<a: INT, b: INT>", ["id"], path)
        assert spark.table(name).isEmpty()
        tb.insert_select(spark.sql("SELECT 'k' AS id, CAST(1.5 AS DECIMAL(10,2)) AS price, named_struct('a', 1, 'b', 2) AS pair"), name, ["id", "price", "pair"])
        assert spark.table(name).count() == 1


def test_stamp_is_the_same_instant_in_any_zone(spark):
    aware = dt.datetime(2024, 5, 1, 12, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    naive = dt.datetime(2024, 5, 1, 10)
    got = {r[0] for ts in (aware, naive) for r in tb.stamp(spark.range(2), ts).select(F.unix_seconds(tb.STAMP)).collect()}
    assert got == {int(dt.datetime(2024, 5, 1, 10, tzinfo=dt.timezone.utc).timestamp())}


def test_scratch_follows_the_session_setting(spark):
    assert work_dir(spark, "a").startswith(shared_dir(spark))
    assert work_dir(spark, "a") != work_dir(spark, "a")


def test_prepared_bookings(spark, sf_dir):
    state = prepare(bookings(spark, sf_dir), BOOKINGS)
    df = state.df
    assert df.where("date_of_arrival <> date_add(date_of_booking, lead_time)").isEmpty()
    match, rest = partition_by_predicate(df, F.col("market_segment_type") == "Online")
    assert match.count() + rest.count() == df.count()
    train, test = split(state, "booking_id", exact=True)
    assert test.count() == -(-df.count() // 5)


def test_order_of_steps(spark, sf_dir):
    raw = bookings(spark, sf_dir)
    with pytest.raises(ContractViolation, match="prepared before"):
        split(raw, "booking_id")
    with pytest.raises(ContractViolation, match="raw data"):
        check_unprocessed(Prepared(raw, BOOKINGS))
    assert check_unprocessed(raw) is raw
    assert check_processed(Prepared(raw, BOOKINGS)).df is raw


def test_preparation_refuses_nulls_and_emptiness(spark, sf_dir):
    raw = bookings(spark, sf_dir)
    with pytest.raises(ContractViolation, match="not_null outside"):
        prepare(raw.withColumn("outside", F.when(F.col("lead_time") > 5, 1)), BOOKINGS)
    with pytest.raises(ContractViolation, match="not_empty"):
        prepare(raw.where("lead_time < 0"), BOOKINGS)
    with pytest.raises(ContractViolation, match="not_null no_of_adults"):
        prepare(raw.withColumn("no_of_adults", F.lit(99999)), BOOKINGS)
    with pytest.raises(ContractViolation, match="no_of_adults"):
        enforce(cast_losses(raw.withColumn("no_of_adults", F.lit(99999)).withColumnRenamed("Booking_ID", "booking_id"), BOOKINGS))


@pytest.fixture(scope="module")
def made(spark, sf_dir):
    source = bookings(spark, sf_dir)
    return synth.synthesize(source, BOOKINGS, 5000, "booking_id", ("market_segment_type", "Online"))


def test_synthetic_rows(spark, sf_dir, made):
    source = bookings(spark, sf_dir)
    assert made.columns == source.columns
    assert made.count() == 5000 and made.select("Booking_ID").distinct().count() == 5000
    assert {r[0] for r in made.select("market_segment_type").distinct().collect()} == {"Online"}
    assert made.where("lead_time < 0 or avg_price_per_room < 0").isEmpty()
    drawn = prepare(made, BOOKINGS).df  # synthetic rows go through the same preparation
    assert drawn.count() == 5000


def test_synthetic_shares_are_near(spark, sf_dir, made):
    online = bookings(spark, sf_dir).where("market_segment_type = 'Online'")
    want = {r[0]: r["count"] / online.count() for r in online.groupBy("booking_status").count().collect()}
    for r in made.groupBy("booking_status").count().collect():
        assert abs(r["count"] / 5000 - want[r["booking_status"]]) < 0.03


def test_synthetic_rows_do_not_depend_on_partitions(spark, sf_dir, made):
    profile = synth.fit_profile(bookings(spark, sf_dir), BOOKINGS, ("market_segment_type", "Online"), "booking_id")
    again = synth.generate(spark, profile, BOOKINGS, 5000, made.columns, "booking_id")
    assert again.repartition(3).exceptAll(made).isEmpty()
    other = synth.generate(spark, profile, BOOKINGS, 5000, made.columns, "booking_id", seed=1)
    assert other.select("Booking_ID").intersect(made.select("Booking_ID")).isEmpty()


def test_drawing_from_many_values(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), (F.col("id") % 700).cast("string")))
    source = spark.range(9000).select(hot.alias("c"))
    profile = synth.categorical_profile(source, ["c"])
    listed = profile.orderBy("low").collect()
    assert listed[0].low == 0 and listed[-1].high == 9000
    assert all(a.high == b.low for a, b in zip(listed, listed[1:]))
    drawn = synth.gen_categorical(synth.rows(spark, 6000), profile, ["c"])
    assert drawn.count() == 6000 and drawn.where("c is null").isEmpty()
    assert abs(drawn.where("c = 'hot'").count() / 6000 - 1 / 3) < 0.03
