"""Queries of the streams; each reads the events to their end and stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.joins import MONITORED
from registry.metrics import EVENTS_SQL
from registry.sources import NEWEST_SQL
from registry.tables import (
    MONITORING_SQL,
    RECORD,
    booking_features,
    flat_quality,
    fresh_name,
    inference_log,
    label_sources,
    quality_sql,
    table,
)
from tabwright.operators.features import read_features
from tabwright.operators.inference_log import attach_features, parse_inference_log
from tabwright.plans.monitoring import label_pending
from tabwright.session import work_dir
from tabwright.streaming.monitoring import stream_inference_log, stream_quality, sync_features, write_available
from tabwright.streaming.waiting import label_in_stream


def stream(spark, sf_dir, name):
    """A file stream over one given table."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query(
    "t1_stream_quality",
    f"""SELECT * FROM ({quality_sql(EVENTS_SQL, 'label', 'prediction', 'second // 1800 * 1800', 'model')})
        WHERE window_start + 1800 <= (SELECT epoch(max(ts)) - 3600 FROM events)""",
)
def t1_stream_quality(spark, sf_dir):
    events = stream(spark, sf_dir, "events").selectExpr(
        "ts", "user_id % 2 AS model", "CAST(event_type = 'purchase' AS INT) AS label", "CAST(value > 50 AS INT) AS prediction"
    )
    path = work_dir(spark, "stream-quality")
    quality = stream_quality(events, "ts", "label", "prediction", ["model"])
    write_available(quality, path, work_dir(spark, "checkpoint"))
    return flat_quality(spark.read.schema(quality.schema).parquet(path), ("model",))


@query("t2_sync_features", NEWEST_SQL)
def t2_sync_features(spark, sf_dir):
    events = stream(spark, sf_dir, "events").select(
        "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), "event_id", "event_type", "value"
    )
    name, checkpoint, root = fresh_name("synced"), work_dir(spark, "checkpoint"), work_dir(spark, "states")
    for _ in range(2):  # the second run finds nothing new
        sync_features(events, name, ["user_id"], ["ts", "event_id"], checkpoint, root)
    return read_features(spark, name)


def _labelled(spark, records, name, sources, known):
    label_pending(spark, records, name, sources, booking_features(known), "booking_id", "booking_status", order=["version"])
    return spark.table(name).withColumn("second", F.unix_seconds("timestamp")).select(*MONITORED)


MONITORED_SQL = f"SELECT {', '.join(MONITORED)} FROM ({MONITORING_SQL})"


@query("t3_stream_inference_log", MONITORED_SQL)
def t3_stream_inference_log(spark, sf_dir):
    """Every payload comes twice."""
    known, records = table(spark, sf_dir, "events"), fresh_name("records")
    log = inference_log(stream(spark, sf_dir, "events"))
    repeated = log.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    stream_inference_log(repeated, RECORD, "rule", records, work_dir(spark, "checkpoint"), path=work_dir(spark, records))
    return _labelled(spark, records, fresh_name("monitored"), label_sources(known), known)


@query("t3_late_labels", MONITORED_SQL)
def t3_late_labels(spark, sf_dir):
    """No record has a label at first; all labels come before a second run."""
    known, records, name = table(spark, sf_dir, "events"), fresh_name("records"), fresh_name("monitored")
    stream_inference_log(
        inference_log(stream(spark, sf_dir, "events")), RECORD, "rule", records, work_dir(spark, "checkpoint"), path=work_dir(spark, records)
    )
    _labelled(spark, records, name, [s.where("false") for s in label_sources(known)], known)
    return _labelled(spark, records, name, label_sources(known), known)


@query("t3_out_of_order", MONITORED_SQL)
def t3_out_of_order(spark, sf_dir):
    """Payload files come newest first, each in a run of its own."""
    known, records, checkpoint = table(spark, sf_dir, "events"), fresh_name("records"), work_dir(spark, "checkpoint")
    files, where = work_dir(spark, "payloads"), work_dir(spark, records)
    schema = known.schema
    for low, high in ((20, 31), (10, 19), (1, 9)):
        known.where(F.dayofmonth("ts").between(low, high)).write.mode("append").parquet(files)
        source = spark.readStream.schema(schema).parquet(files)
        stream_inference_log(inference_log(source), RECORD, "rule", records, checkpoint, path=where)
    return _labelled(spark, records, fresh_name("monitored"), label_sources(known), known)


@query("t3_waiting_labels", MONITORED_SQL)
def t3_waiting_labels(spark, sf_dir):
    """Every record waits in the stream: the first run has payloads only, the second the labels."""
    known = table(spark, sf_dir, "events")
    given, out, checkpoint = work_dir(spark, "labels"), work_dir(spark, "labelled"), work_dir(spark, "checkpoint")
    dated = [
        source.join(known.selectExpr("event_id AS booking_id", "CAST(ts AS TIMESTAMP) AS told_at"), "booking_id").unionByName(
            source.join(known.selectExpr("-event_id - 1 AS booking_id", "CAST(ts AS TIMESTAMP) AS told_at"), "booking_id")
        ).withColumn("rank", F.lit(i))
        for i, source in enumerate(label_sources(known))
    ]
    labels = dated[0].unionByName(dated[1])
    labels.limit(0).write.parquet(given)
    # the state is kept in as many stores as there are shuffle partitions when a stream first runs
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.shuffle.partitions": "4",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for _ in range(2):
            records = parse_inference_log(inference_log(stream(spark, sf_dir, "events")), RECORD, "rule")
            told = spark.readStream.schema(labels.schema).parquet(given)
            write_available(label_in_stream(records, told, "booking_id", "booking_status", "told_at", "60 days"), out, checkpoint)
            labels.write.mode("append").parquet(given)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    schema = label_in_stream(records, told, "booking_id", "booking_status", "told_at").schema
    found = attach_features(spark.read.schema(schema).parquet(out), booking_features(known), "booking_id", ["version"])
    return found.withColumn("second", F.unix_seconds("timestamp")).select(*MONITORED)
