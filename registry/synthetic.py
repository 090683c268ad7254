"""Queries of profiles for synthetic rows and of the rows drawn from them.

As many rows are drawn as the fitted table has.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.tables import BOOKINGS, BOOKINGS_SQL, bookings, rounded, table, uniform_sql
from tabwright.operators import synth

NUMERIC = [c.alias for c in BOOKINGS.numeric]
FITTED_SQL = f"SELECT * FROM ({BOOKINGS_SQL}) WHERE market_segment_type = 'Online'"
ONLINE = ("market_segment_type", "Online")


def _profile(spark, sf_dir):
    return synth.fit_profile(bookings(spark, sf_dir), BOOKINGS, ONLINE, "booking_id")


@query(
    "y1_fit_profile_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std FROM ({FITTED_SQL})"""
        for c in NUMERIC
    ),
)
def y1_fit_profile_numeric(spark, sf_dir):
    return rounded(_profile(spark, sf_dir).numeric, "mean", "std", digits=3)


@query(
    "y1_fit_profile_categorical",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS "value", count(*) AS n,
                   round(count(*) / (SELECT count(*) FROM ({FITTED_SQL})), 6) AS share FROM ({FITTED_SQL}) GROUP BY {c}"""
        for c in ("type_of_meal_plan", "market_segment_type", "booking_status")
    ),
)
def y1_fit_profile_categorical(spark, sf_dir):
    return rounded(synth.with_share(_profile(spark, sf_dir).categorical), "share")


def _normal_sql(name: str) -> str:
    u = f"({uniform_sql('i', name)} + 1 / 4503599627370496.0::DOUBLE)"
    return f"sqrt(-2.0 * ln({u})) * cos(2.0 * pi() * {uniform_sql('i', name, start=14)})"


@query(
    "y2_gen_numeric",
    f"""SELECT i AS row_number, round(abs({_normal_sql('o_totalprice')} * std + mean), 2) AS o_totalprice
        FROM (SELECT unnest(range(n)) AS i, mean, std
              FROM (SELECT count(*) AS n, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS std FROM orders))""",
)
def y2_gen_numeric(spark, sf_dir):
    fitted = synth.numeric_profile(table(spark, sf_dir, "orders"), ["o_totalprice"]).first()
    drawn = synth.gen_numeric(fitted["mean"], fitted["std"], "o_totalprice").alias("o_totalprice")
    return synth.rows(spark, fitted["n"]).select(F.col(synth.ROW).alias("row_number"), drawn)


def _drawn_sql(source: str, column: str) -> str:
    """The value that owns the drawn position, found by a range join."""
    return f"""
      WITH counts AS (SELECT CAST({column} AS VARCHAR) AS v, count(*) AS c FROM {source} GROUP BY 1),
      owned AS (SELECT v, sum(c) OVER w - c AS low, sum(c) OVER w AS high FROM counts
                WINDOW w AS (ORDER BY substr(md5(v), 1, 2), v)),
      draws AS (SELECT i, floor({uniform_sql('i', column)} * (SELECT count(*) FROM {source})) AS pos
                FROM (SELECT unnest(range(count(*))) AS i FROM {source}))
      SELECT i AS row_number, v AS {column} FROM draws JOIN owned ON pos >= low AND pos < high"""


def _drawn(spark, source, column):
    profile = synth.categorical_profile(source, [column])
    drawn = synth.gen_categorical(synth.rows(spark, source.count()), profile, [column])
    return drawn.select(F.col(synth.ROW).alias("row_number"), column)


@query("y3_gen_categorical", _drawn_sql("customer", "c_mktsegment"))
def y3_gen_categorical(spark, sf_dir):
    return _drawn(spark, table(spark, sf_dir, "customer"), "c_mktsegment")


@query("y3_gen_categorical_many_values", _drawn_sql("orders", "o_custkey"))
def y3_gen_categorical_many_values(spark, sf_dir):
    return _drawn(spark, table(spark, sf_dir, "orders"), "o_custkey")


@query(
    "y4_gen_key",
    "SELECT c_custkey AS row_number, md5('42|' || c_custkey) AS key, c_mktsegment AS segment FROM customer",
)
def y4_gen_key(spark, sf_dir):
    """New keys for the rows of a table, from their old numbers."""
    made = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", synth.ROW)
    return made.select(F.col(synth.ROW).alias("row_number"), synth.gen_key().alias("key"), F.col("c_mktsegment").alias("segment"))


def _short_drawn(column: str, name: str) -> str:
    return f"""SELECT i, v FROM (
        SELECT i, floor({uniform_sql('i', name)} * (SELECT count(*) FROM fitted)) AS pos FROM numbered) JOIN (
        SELECT v, sum(c) OVER w - c AS low, sum(c) OVER w AS high
        FROM (SELECT {column} AS v, count(*) AS c FROM fitted GROUP BY 1)
        WINDOW w AS (ORDER BY substr(md5(v), 1, 2), v)) ON pos >= low AND pos < high"""


@query(
    "y5_synthesize",
    f"""WITH fitted AS ({FITTED_SQL}), numbered AS (SELECT unnest(range(count(*))) AS i FROM orders),
        moments AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in NUMERIC)} FROM fitted)
        SELECT md5('42|' || n.i) AS Booking_ID, meal.v AS type_of_meal_plan, status.v AS booking_status,
               'Online' AS market_segment_type,
               {', '.join(f'''CAST(trunc(round(abs({_normal_sql(c).replace('CAST(i', 'CAST(n.i')} * s_{c} + m_{c}), 2)) AS SMALLINT) AS {c}''' for c in NUMERIC if c != 'avg_price_per_room')},
               round(abs({_normal_sql('avg_price_per_room').replace('CAST(i', 'CAST(n.i')} * s_avg_price_per_room + m_avg_price_per_room), 2)
                 AS avg_price_per_room
        FROM numbered n JOIN ({_short_drawn('type_of_meal_plan', 'type_of_meal_plan')}) meal ON n.i = meal.i
        JOIN ({_short_drawn('booking_status', 'booking_status')}) status ON n.i = status.i CROSS JOIN moments""",
)
def y5_synthesize(spark, sf_dir):
    source = bookings(spark, sf_dir)
    return synth.synthesize(source, BOOKINGS, source.count(), "booking_id", ONLINE)
