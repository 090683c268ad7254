"""Inference logs: JSON payloads to scored records, labels and monitoring rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.dates import event_time
from tabwright.operators.features import Lookup
from tabwright.operators.keys import keyed_join, keyed_joins
from tabwright.operators.transform import flatten_record, tag_model


@dataclass(frozen=True)
class PayloadFormat:
    """Names of the log columns and of the two lists inside the payloads."""

    request_id: str = "request_id"
    time_ms: str = "timestamp_ms"
    duration_ms: str = "execution_time_ms"
    request: str = "request"
    response: str = "response"
    records: str = "dataframe_records"
    predictions: str = "predictions"

    def request_schema(self, record: T.StructType) -> T.StructType:
        return T.StructType([T.StructField(self.records, T.ArrayType(record))])

    def response_schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.predictions, T.ArrayType(T.LongType()))])


# The log format written by the hosted serving tables.
HOSTED_FORMAT = PayloadFormat(request_id="databricks_request_id")

# The fields of one booking record in a request.
BOOKING_RECORD = T.StructType(
    [
        T.StructField("booking_id", T.StringType()),
        T.StructField("no_of_adults", T.IntegerType()),
        T.StructField("no_of_children", T.IntegerType()),
        T.StructField("no_of_weekend_nights", T.IntegerType()),
        T.StructField("no_of_week_nights", T.IntegerType()),
        T.StructField("type_of_meal_plan", T.StringType()),
        T.StructField("required_car_parking_space", T.IntegerType()),
        T.StructField("room_type_reserved", T.StringType()),
        T.StructField("lead_time", T.IntegerType()),
        T.StructField("avg_price_per_room", T.DoubleType()),
        T.StructField("no_of_special_requests", T.IntegerType()),
        T.StructField("date_of_arrival", T.TimestampType()),
        T.StructField("date_of_booking", T.TimestampType()),
    ]
)


def parse_inference_log(
    log: DataFrame,
    record: T.StructType,
    model_name: str,
    fmt: PayloadFormat = PayloadFormat(),
    first_only: bool = False,
    exact_time: bool = False,
) -> DataFrame:
    """One row per record of a request, with its own prediction.

    Payloads whose request cannot be read or holds no records give no rows;
    :func:`dropped_payloads` counts them. ``first_only`` attaches the first
    prediction to every record. Works on batch and streaming frames; the
    payload texts are dropped before the records are unfolded.
    """
    parsed = log.select(
        event_time(F.col(fmt.time_ms), exact_time).alias("timestamp"),
        fmt.time_ms,
        fmt.request_id,
        fmt.duration_ms,
        F.from_json(fmt.request, fmt.request_schema(record))[fmt.records].alias("_records"),
        F.from_json(fmt.response, fmt.response_schema())[fmt.predictions].alias("_predictions"),
    )
    # The outer form, then a filter: the inner one would make the optimizer test
    # the list for emptiness before unfolding it, and so parse every text again.
    unfolded = parsed.select(
        "timestamp",
        fmt.time_ms,
        fmt.request_id,
        fmt.duration_ms,
        "_predictions",
        F.posexplode_outer("_records").alias("position", "_record"),
    ).where("position is not null")
    which = F.lit(0) if first_only else F.col("position")
    scored = unfolded.select(
        "timestamp",
        fmt.time_ms,
        fmt.request_id,
        fmt.duration_ms,
        "position",
        "_record",
        F.get("_predictions", which).alias("prediction"),
    )
    return tag_model(flatten_record(scored, "_record"), model_name)


def dropped_payloads(log: DataFrame, record: T.StructType, fmt: PayloadFormat = PayloadFormat()) -> DataFrame:
    """``(reason, n)``: payloads without readable records, without records, without predictions."""
    records = F.from_json(fmt.request, fmt.request_schema(record))[fmt.records]
    predictions = F.from_json(fmt.response, fmt.response_schema())[fmt.predictions]
    parsed = log.select(records.alias("r"), predictions.alias("p"))
    totals = parsed.agg(
        F.count_if(F.col("r").isNull()).alias("unreadable request"),
        F.count_if(F.size("r") == 0).alias("no records"),
        F.count_if(F.col("p").isNull()).alias("unreadable response"),
    )
    return totals.unpivot([], totals.columns, "reason", "n")


def label_per_key(sources: Sequence[DataFrame], key: str, label: str) -> DataFrame:
    """One known label per key: that of the first source that has one.

    All sources go through one aggregate. If a source has several labels for
    a key, the smallest is taken, so the result does not depend on row order.
    """
    numbered = [
        s.select(key, F.col(label).cast("int").alias(label), F.lit(i).alias("_source")) for i, s in enumerate(sources)
    ]
    rows = numbered[0]
    for other in numbered[1:]:
        rows = rows.unionByName(other)
    first = F.min(F.struct("_source", label))[label].alias(label)
    return rows.where(F.col(label).isNotNull()).groupBy(key).agg(first)


def _predicted(df: DataFrame, prediction: str) -> DataFrame:
    return df.withColumn(prediction, F.col(prediction).cast("int")).where(F.col(prediction).isNotNull())


def attach_labels(
    predictions: DataFrame,
    sources: Sequence[DataFrame],
    key: str,
    label: str,
    prediction: str = "prediction",
    skew: str = "auto",
) -> DataFrame:
    """Add the label from the first source that has one; rows without label or prediction are dropped.

    Dropping unlabelled rows makes this an inner join against one reduced
    label frame, however many sources there are.
    """
    known = label_per_key(sources, key, label)
    return keyed_join(_predicted(predictions, prediction), known, [key], "inner", skew=skew)


def attach_features(
    df: DataFrame, features: DataFrame, key: str, order: Sequence[str] = (), unique: bool = False, skew: str = "auto"
) -> DataFrame:
    """Add all features of a keyed table; a missing key gives nulls."""
    names = tuple(c for c in features.columns if c != key and c not in order)
    return keyed_join(df, Lookup(features, (key,), names, tuple(order), unique).rows(), [key], skew=skew)


def monitoring_rows(
    parsed: DataFrame,
    label_sources: Sequence[DataFrame],
    features: DataFrame,
    key: str,
    label: str,
    order: Sequence[str] = (),
    unique: bool = False,
    skew: str = "auto",
) -> DataFrame:
    """Parsed records with label and features; both joins share one shuffle of the records."""
    names = tuple(c for c in features.columns if c != key and c not in order)
    lookup = Lookup(features, (key,), names, tuple(order), unique)
    rights = [(label_per_key(label_sources, key, label), "inner"), (lookup.rows(), "left")]
    return keyed_joins(_predicted(parsed, "prediction"), rights, [key], skew=skew)


def build_monitoring(
    log: DataFrame,
    record: T.StructType,
    model_name: str,
    label_sources: Sequence[DataFrame],
    features: DataFrame,
    key: str,
    label: str,
    fmt: PayloadFormat = PayloadFormat(),
    first_only: bool = False,
    order: Sequence[str] = (),
    unique: bool = False,
    existing: DataFrame | None = None,
) -> DataFrame:
    """From payloads to monitoring rows; with ``existing`` only records not loaded before."""
    parsed = parse_inference_log(log, record, model_name, fmt, first_only)
    if existing is not None:
        parsed = new_only(parsed, existing, [fmt.request_id, "position"])
    return monitoring_rows(parsed, label_sources, features, key, label, order, unique)


def new_only(df: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the existing rows."""
    return df.join(existing.select(*key), list(key), "left_anti")
