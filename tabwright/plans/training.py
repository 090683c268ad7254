"""Feature tables from splits, training and comparison of models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabwright.operators.features import Lookup, training_set, upsert_features
from tabwright.operators.metrics import Comparison, accuracy, auc_hard, champion_challenger, classification_report
from tabwright.operators.model import score, train
from tabwright.operators.transform import latest_batch
from tabwright.session import materialize
from tabwright.sources.changes import table_version
from tabwright.sources.tables import STAMP, create_table, insert_select, newest_batch


def build_features(
    spark: SparkSession,
    table: str,
    sources: Sequence[DataFrame],
    columns: str,
    key: Sequence[str],
    path: str | None = None,
) -> None:
    """Create the feature table and append the projection of every source."""
    create_table(spark, table, columns, key, path)
    names = T.StructType.fromDDL(columns).fieldNames()
    for source in sources:
        insert_select(source, table, names)


def refresh_features(
    spark: SparkSession,
    table: str,
    sources: Sequence[DataFrame | str],
    columns: Sequence[str],
    key: Sequence[str] = (),
    mode: str = "append",
    stamp_column: str = STAMP,
    root: str | None = None,
) -> None:
    """Take over the newest batch of every source.

    Of a batch table given by its name only the partition of its newest batch is read; a
    frame is read for its greatest stamp first.
    ``append`` adds the rows as they are, so a rerun repeats them. ``upsert``
    keeps one row per key, the newest by the stamp, which the feature table
    must then carry.
    """
    for source in sources:
        newest = newest_batch(spark, source) if isinstance(source, str) else latest_batch(source, stamp_column)
        if mode == "append":
            insert_select(newest, table, columns)
        else:
            names = list(dict.fromkeys([*columns, stamp_column]))
            upsert_features(spark, table, newest.select(*names), key, [stamp_column], root)


@dataclass(frozen=True)
class TrainingResult:
    """A fitted model, its metrics on the test rows and the comparison with the registered one.

    ``versions`` holds the version of every named table that the model was trained on, for
    :func:`tabwright.sources.changes.read_as_of`.
    """

    model: PipelineModel
    accuracy: DataFrame
    auc_hard: DataFrame
    report: DataFrame
    comparison: Comparison | None
    versions: dict[str, int | None] = field(default_factory=dict)


def train_and_compare(
    train_rows: DataFrame,
    test_rows: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    key: str,
    lookups: Sequence[Lookup],
    functions: Mapping[str, Any],
    parameters: Mapping[str, Any],
    latest: Callable[[DataFrame], DataFrame] | None = None,
    exclude: Sequence[str] = (),
    seed: int = 42,
    tables: Sequence[str] = (),
) -> TrainingResult:
    """Look up features, train, evaluate, and compare with the latest registered model.

    ``latest`` adds its ``prediction``. Both predictions are held in one row
    per test record, so they are compared pair by pair, over all test rows. The versions
    of ``tables``, those the rows and lookups come from, are read before training and
    kept with the model.
    """
    versions = {name: table_version(train_rows.sparkSession, name) for name in tables}
    wanted = [key, label, *numeric, *categorical]
    fitted_on = training_set(train_rows, label, lookups, functions, exclude).select(*wanted)
    model = train(fitted_on, label, numeric, categorical, parameters, seed)
    held_out = training_set(test_rows, label, lookups, functions, exclude).select(*wanted)
    scored = score(model, held_out).withColumnRenamed("prediction", "current")
    if latest is not None:
        scored = latest(scored).withColumnRenamed("prediction", "latest")
    scored = materialize(scored, "scored")  # read by every metric below
    comparison = None
    if latest is not None:
        comparison = champion_challenger(scored, label, "current", "latest")
    return TrainingResult(
        model,
        accuracy(scored, label, "current"),
        auc_hard(scored, label, "current"),
        classification_report(scored, label, "current"),
        comparison,
        versions,
    )
