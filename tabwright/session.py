"""Session settings, the shared scratch folder and small planning helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def get_session(app: str = "tabwright", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, skew handling and UTC.

    Cluster settings (executors, memory, shared folders) come from the
    submit command; only settings the operators rely on are fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a session of one process without that setting, as in tests, gets a folder of its
    own; on a cluster a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tabwright-"))
    return context.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder.

    All paths of one application lie in one folder, which can be deleted when
    the application has ended.
    """
    return f"{shared_dir(spark)}/tabwright/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives the loss of executors, is computed once however often
    it is used, and has a file size the planner can base join choices on.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(counted: Observation) -> dict:
    """The metrics of a written frame; nothing when the planner found that it has no rows and left the metrics out."""
    try:
        return counted.get
    except Py4JJavaError:
        return {}


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate for ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1 when off)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"kb": 1 << 10, "k": 1 << 10, "mb": 1 << 20, "m": 1 << 20, "gb": 1 << 30, "g": 1 << 30, "b": 1}
    for unit, factor in units.items():
        if text.endswith(unit) and text[: -len(unit)].strip().lstrip("-").isdigit():
            return int(text[: -len(unit)]) * factor
    return int(text)
