"""Streaming forms of log parsing, quality windows and feature refresh.

Streams run to the end of the available input and stop; run again with the
same checkpoint they go on where they stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.operators.features import upsert_features
from tabwright.operators.inference_log import PayloadFormat
from tabwright.operators.profile import quality_profile
from tabwright.plans.monitoring import store_records


def stream_quality(
    log: DataFrame,
    ts: str,
    label: str,
    prediction: str,
    by: Sequence[str] = (),
    granularity: str = "30 minutes",
    lateness: str = "1 hour",
) -> DataFrame:
    """Quality per closed window; a window is emitted once the watermark has passed it."""
    timed = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    return quality_profile(timed, ts, label, prediction, by, granularity)


def stream_inference_log(
    log: DataFrame,
    record: T.StructType,
    model_name: str,
    table: str,
    checkpoint: str,
    fmt: PayloadFormat = PayloadFormat(),
    path: str | None = None,
) -> None:
    """Store the records of all available payloads in ``table``, by day, then stop.

    Payloads may come in any order and more than once; a micro-batch that is run again
    adds nothing. Labels and features are joined afterwards, by
    :func:`tabwright.plans.monitoring.label_pending`, so a record waits for a late label.
    """

    def apply(batch: DataFrame, _: int) -> None:
        store_records(batch, record, model_name, table, fmt, path)

    query = log.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def write_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what is available to Parquet files and stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def sync_features(
    stream: DataFrame, table: str, key: Sequence[str], order: Sequence[str], checkpoint: str, root: str | None = None
) -> None:
    """Apply new rows of a stream to a keyed table, then stop.

    A micro-batch that is run twice leaves the table as running it once does,
    because the newest row per key wins. Every micro-batch writes the buckets of the keys
    it changes, see :func:`tabwright.operators.features.upsert_features`.
    """

    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            upsert_features(batch.sparkSession, table, batch, key, order, root)

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
