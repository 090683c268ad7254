"""Given tables and the stand-ins derived from them, as text both engines read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.contract import Contract, parse_contract
from tabwright.functions.records import to_record

_ENVIRONMENT = {"catalog_name": "", "schema_name": "", "pipeline_id": None}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(label: str) -> str:
    """A table name nothing else uses."""
    return f"{label}_{uuid.uuid4().hex}"


def contract(numeric, categorical, target, features=((), ())) -> Contract:
    """A contract from ``(name, dtype, alias)`` triples."""

    def entry(c):
        return dict(zip(("name", "dtype", "alias"), c))

    return parse_contract(
        {
            "dev": _ENVIRONMENT,
            "experiment_name": "registry",
            "model": {"name": "registry", "artifact_path": "registry"},
            "parameters": {"learning_rate": 0.1, "n_estimators": 3, "num_leaves": 8},
            "num_features": [entry(c) for c in numeric],
            "cat_features": [entry(c) for c in categorical],
            "target": entry(target),
            "features": {"numerical": list(features[0]), "categorical": list(features[1])},
        }
    )


# --- bookings from orders -----------------------------------------------------

BOOKING_COLUMNS = {
    "Booking_ID": "'B' || CAST(o_orderkey AS STRING)",
    "no_of_adults": "o_orderkey % 4",
    "no_of_weekend_nights": "o_custkey % 3",
    "type_of_meal_plan": "o_orderpriority",
    "lead_time": "o_custkey % 365",
    "arrival_year": "year(o_orderdate)",
    "arrival_month": "o_orderkey % 14",
    "arrival_date": "(o_orderkey * 7) % 34",
    "market_segment_type": "CASE WHEN o_custkey % 5 < 3 THEN 'Online' ELSE 'Offline' END",
    "repeated_guest": "o_custkey % 2",
    "avg_price_per_room": "o_totalprice",
    "booking_status": "CASE WHEN o_orderstatus = 'F' THEN 'Canceled' ELSE 'Not_Canceled' END",
}
BOOKINGS_SQL = (
    "SELECT " + ", ".join(f"{e} AS {c}" for c, e in BOOKING_COLUMNS.items()) + " FROM orders"
).replace("AS STRING", "AS VARCHAR")

BOOKINGS = contract(
    numeric=[
        ("no_of_adults", "int16", "no_of_adults"),
        ("no_of_weekend_nights", "int16", "no_of_weekend_nights"),
        ("lead_time", "int16", "lead_time"),
        ("arrival_year", "int16", "arrival_year"),
        ("arrival_month", "int16", "arrival_month"),
        ("arrival_date", "int16", "arrival_date"),
        ("repeated_guest", "int16", "repeated_guest"),
        ("avg_price_per_room", "float64", "avg_price_per_room"),
    ],
    categorical=[
        ("Booking_ID", "object", "booking_id"),
        ("type_of_meal_plan", "object", "type_of_meal_plan"),
        ("market_segment_type", "object", "market_segment_type"),
    ],
    target=("booking_status", "category", "booking_status"),
    features=(
        ("no_of_adults", "no_of_weekend_nights", "lead_time", "repeated_guest", "avg_price_per_room"),
        ("type_of_meal_plan",),
    ),
)

# The prepared booking, written for the SQL engine by date arithmetic: move to
# the first of the month, add the days, and stop at the first of the next month.
PREPARED_SQL = f"""
    SELECT Booking_ID AS booking_id, no_of_adults, no_of_weekend_nights, type_of_meal_plan, lead_time,
           arrival_year, arrival_month, arrival_date, market_segment_type, repeated_guest, avg_price_per_room,
           CASE WHEN booking_status = 'Canceled' THEN 1 ELSE 0 END AS booking_status,
           arrival AS date_of_arrival, CAST(arrival - CAST(lead_time AS INTEGER) AS DATE) AS date_of_booking
    FROM (
      SELECT *, CASE
          WHEN arrival_month < 1 THEN first_day
          WHEN arrival_month > 12 THEN first_day
          ELSE least(first_day + CAST(greatest(arrival_date, 1) - 1 AS INTEGER),
                     CAST(first_day + INTERVAL 1 MONTH AS DATE)) END AS arrival
      FROM (
        SELECT *, CASE
          WHEN arrival_month < 1 THEN make_date(arrival_year, 1, 1)
          WHEN arrival_month > 12 THEN make_date(arrival_year + 1, 1, 1)
          ELSE make_date(arrival_year, arrival_month, 1) END AS first_day
        FROM ({BOOKINGS_SQL})))"""


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in BOOKING_COLUMNS.items()])


# --- inference log from events ------------------------------------------------

RECORD = T.StructType(
    [
        T.StructField("booking_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("kind", T.StringType()),
    ]
)


def inference_log(events: DataFrame) -> DataFrame:
    """Requests of two records per event; some unreadable, some empty, some short of a prediction."""
    first = F.struct(
        F.col("event_id").alias("booking_id"), F.col("value").alias("amount"), F.col("event_type").alias("kind")
    )
    second = F.struct(
        (-F.col("event_id") - 1).alias("booking_id"), (F.col("value") / 2).alias("amount"), F.lit("pair").alias("kind")
    )
    whole = to_record([F.array(first, second).alias("dataframe_records")])
    request = (
        F.when(F.expr("event_id % 97 = 0"), F.lit('{"dataframe_rec'))
        .when(F.expr("event_id % 101 = 0"), F.lit('{"dataframe_records": []}'))
        .otherwise(whole)
    )
    hits = [F.expr("CAST(value > 50 AS INT)"), F.expr("CAST(value > 20 AS INT)")]
    predictions = F.when(F.expr("event_id % 89 = 0"), F.array(hits[0])).otherwise(F.array(*hits))
    return events.select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
        F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
        F.lit(5).cast("bigint").alias("execution_time_ms"),
        request.alias("request"),
        to_record([predictions.alias("predictions")]).alias("response"),
    )


# The records of that log straight from the events, without any JSON.
PARSED_SQL = """
    SELECT epoch_us(ts) // 1000 AS timestamp_ms, epoch_us(ts) // 1000000 AS second, 'req-' || event_id AS request_id,
           0 AS position, event_id AS booking_id, value AS amount, event_type AS kind,
           CASE WHEN value > 50 THEN 1 ELSE 0 END AS prediction
    FROM events WHERE event_id % 97 <> 0 AND event_id % 101 <> 0
    UNION ALL
    SELECT epoch_us(ts) // 1000, epoch_us(ts) // 1000000, 'req-' || event_id, 1, -event_id - 1, value / 2, 'pair',
           CASE WHEN event_id % 89 = 0 THEN NULL WHEN value > 20 THEN 1 ELSE 0 END
    FROM events WHERE event_id % 97 <> 0 AND event_id % 101 <> 0"""


def label_sources(events: DataFrame) -> list[DataFrame]:
    """Two sources of late labels; they overlap, contradict each other and leave rows without label."""
    first = events.where("event_id % 3 = 0").selectExpr(
        "event_id AS booking_id", "CAST(event_type = 'purchase' AS INT) AS booking_status"
    )
    second = events.where("event_id % 3 < 2").selectExpr(
        "event_id AS booking_id", "CAST(event_type <> 'click' AS INT) AS booking_status"
    )
    pairs = events.where("event_id % 2 = 0").selectExpr(
        "-event_id - 1 AS booking_id", "CAST(user_id % 2 AS INT) AS booking_status"
    )
    return [first, second.unionByName(pairs)]


LABELS_SQL = """
    SELECT event_id AS booking_id,
           CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END
                ELSE CASE WHEN event_type <> 'click' THEN 1 ELSE 0 END END AS booking_status
    FROM events WHERE event_id % 3 < 2
    UNION ALL
    SELECT -event_id - 1, CAST(user_id % 2 AS INTEGER) FROM events WHERE event_id % 2 = 0"""


def booking_features(events: DataFrame) -> DataFrame:
    """Features of three in four bookings, each listed twice; the higher version counts."""
    kept = events.where("event_id % 4 <> 0")
    old = kept.selectExpr("event_id AS booking_id", "user_id + 1000000 AS guest", "1 AS version")
    new = kept.selectExpr("event_id AS booking_id", "user_id AS guest", "2 AS version")
    return old.unionByName(new)


FEATURES_SQL = "SELECT event_id AS booking_id, user_id AS guest FROM events WHERE event_id % 4 <> 0"

MONITORING_SQL = f"""
    SELECT p.booking_id, p.second, p.timestamp_ms, p.request_id, p.position, p.amount, p.kind, p.prediction,
           l.booking_status, f.guest
    FROM ({PARSED_SQL}) p JOIN ({LABELS_SQL}) l ON p.booking_id = l.booking_id
    LEFT JOIN ({FEATURES_SQL}) f ON p.booking_id = f.booking_id
    WHERE p.prediction IS NOT NULL"""

# 60 uniform bits of a key, and the two uniforms of a draw.
HASH_SQL = "CAST('0x' || substr(md5({key} || '|{seed}'), 1, 15) AS BIGINT)"


def hash_sql(key: str, seed: int = 42) -> str:
    return HASH_SQL.format(key=f"CAST({key} AS VARCHAR)", seed=seed)


def uniform_sql(row: str, name: str, seed: int = 42, start: int = 1) -> str:
    digest = f"md5(CAST({row} AS VARCHAR) || '|{name}|{seed}')"
    return f"(CAST('0x' || substr({digest}, {start}, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def quality_sql(rows: str, label: str, prediction: str, window: str, by: str = "") -> str:
    """Quality per window written as plain sums."""
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    sums = ", ".join(
        f"CAST(sum(CASE WHEN {label} = {y} AND {prediction} = {p} THEN 1 ELSE 0 END) AS BIGINT) AS {c}"
        for c, (y, p) in cells.items()
    )
    group = f"{window}{', ' + by if by else ''}"
    return f"""
    SELECT *, round((tp + tn) / n, 6) AS accuracy_score,
           round((tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2, 6) AS auc_hard,
           round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
           round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
           round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
    FROM (SELECT {window} AS window_start{', ' + by if by else ''}, count(*) AS n, {sums}
          FROM ({rows}) GROUP BY {group})"""


QUALITY = ("accuracy_score", "auc_hard", "precision", "recall", "f1")


def flat_quality(profile: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Window start in epoch seconds and rounded metrics."""
    return profile.select(
        F.unix_seconds(F.col("window.start").cast("timestamp")).alias("window_start"),
        *by,
        "n",
        "tp",
        "fp",
        "fn",
        "tn",
        *[F.round(m, 6).alias(m) for m in QUALITY],
    )


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
