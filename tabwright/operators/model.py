"""Training and batch scoring with Spark ML, and scoring with any Python model."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.contract import check_signature, signature
from tabwright.operators.features import Lookup, create_feature_table, training_set
from tabwright.operators.transform import combine
from tabwright.session import shared_dir

FEATURES = "_features"


def encoder_stages(categorical: Sequence[str]) -> list:
    """Stages for one-hot vectors: categories sorted, an unknown one gives all zeros."""
    if not categorical:
        return []
    indexed = [f"_{c}_index" for c in categorical]
    hot = [f"_{c}_hot" for c in categorical]
    return [
        StringIndexer(
            inputCols=list(categorical), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        # the slot kept for unknown values comes last and is the one dropped
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
    ]


def one_hot(df: DataFrame, categorical: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Add one 0/1 column per known category, named ``column_category``."""
    fitted = Pipeline(stages=encoder_stages(categorical)).fit(df if fit_on is None else fit_on)
    indexer: StringIndexerModel = fitted.stages[0]
    coded = fitted.transform(df)
    indicators = [
        vector_to_array(F.col(f"_{c}_hot"))[i].cast("int").alias(f"{c}_{value}")
        for c, values in zip(categorical, indexer.labelsArray)
        for i, value in enumerate(values)
    ]
    return coded.select(*df.columns, *indicators)


def feature_stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """One-hot categories first, then the numeric columns as they are."""
    inputs = [f"_{c}_hot" for c in categorical] + list(numeric)
    return [*encoder_stages(categorical), VectorAssembler(inputCols=inputs, outputCol=FEATURES)]


def filled_stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """As :func:`feature_stages`, for numbers that may be missing: the fitted mean and a 0/1 mark in their place."""
    if not numeric:
        return feature_stages(numeric, categorical)
    doubles = [f"_{c}_double" for c in numeric]
    filled, missing = [f"_{c}_filled" for c in numeric], [f"_{c}_missing" for c in numeric]
    marks = [
        f"CAST(`{c}` AS DOUBLE) AS `{d}`, CAST(`{c}` IS NULL OR isnan(CAST(`{c}` AS DOUBLE)) AS DOUBLE) AS `{m}`"
        for c, d, m in zip(numeric, doubles, missing, strict=True)
    ]
    inputs = [f"_{c}_hot" for c in categorical] + filled + missing
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(marks)} FROM __THIS__"),
        Imputer(strategy="mean", inputCols=doubles, outputCols=filled),
        *encoder_stages(categorical),
        VectorAssembler(inputCols=inputs, outputCol=FEATURES),
    ]


def assemble(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Add the feature vector of a frame, with the encoder fitted on it."""
    coded = Pipeline(stages=feature_stages(numeric, categorical)).fit(df).transform(df)
    return coded.select(*df.columns, FEATURES)


def tree_settings(parameters: Mapping[str, Any]) -> dict[str, Any]:
    """Booster settings from ``learning_rate``, ``n_estimators`` and ``num_leaves``.

    Trees here grow level by level, so a number of leaves becomes the depth
    that holds at least as many.
    """
    named = {
        "learning_rate": lambda v: ("stepSize", float(v)),
        "n_estimators": lambda v: ("maxIter", int(v)),
        "num_leaves": lambda v: ("maxDepth", max(1, math.ceil(math.log2(v)))),
    }
    return dict(named[k](v) if k in named else (k, v) for k, v in parameters.items())


def train(
    df: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    parameters: Mapping[str, Any],
    seed: int = 42,
) -> PipelineModel:
    """Gradient-boosted trees on one-hot and numeric features; numbers may be missing, in training and in scoring."""
    shared_dir(df.sparkSession)  # lineage of many rounds is cut there
    booster = GBTClassifier(
        featuresCol=FEATURES, labelCol=label, seed=seed, checkpointInterval=10, **tree_settings(parameters)
    )
    stages = [*filled_stages(numeric, categorical), booster]
    return Pipeline(stages=stages).fit(df.select(label, *numeric, *categorical))


def score(model: PipelineModel, df: DataFrame, probability: str | None = None) -> DataFrame:
    """Add ``prediction`` as an integer and, if named, the probability of class 1."""
    scored = model.transform(df)
    extra = [vector_to_array(F.col("probability"))[1].alias(probability)] if probability else []
    return scored.select(*df.columns, F.col("prediction").cast("int").alias("prediction"), *extra)


def score_with_lookup(
    model: PipelineModel, df: DataFrame, label: str, lookups: Sequence[Lookup], functions: Mapping | None = None
) -> DataFrame:
    """Score rows that carry only keys and request columns; lookups add the rest, nulls where a key is unknown."""
    return score(model, training_set(df, label, lookups, functions))


def wrap_model(
    df: DataFrame,
    model: Any,
    inputs: Sequence[str],
    output: str = "prediction",
    output_type: T.DataType = T.LongType(),
    predict: Callable | None = None,
) -> DataFrame:
    """Add predictions of any Python model, batch by batch on the executors.

    ``predict(model, frame)`` defaults to ``model.predict(frame)``. Only the inputs go to
    Python; all other columns stay as they are. The model travels inside the function, so
    a class from the main script works, too.
    """
    call = predict or (lambda m, frame: m.predict(frame))
    inputs = list(inputs)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for frame in frames:
            yield pd.Series(call(model, frame[inputs])).reset_index(drop=True)

    predicted = F.pandas_udf(run, output_type)
    return df.withColumn(output, predicted(F.struct(*[F.col(f"`{c}`").alias(c) for c in inputs])))


def score_to_table(
    frames: Sequence[DataFrame],
    scorer: Callable[[DataFrame], DataFrame],
    table: str,
    key: str,
    features: Sequence[str],
    output: str = "Predicted_Default",
    path: str | None = None,
) -> None:
    """Score the union of frames and keep key, features and prediction as a feature table."""
    scored = scorer(combine(*frames))
    create_feature_table(scored.select(key, *features, F.col("prediction").alias(output)), table, [key], path)


def save_model(model: PipelineModel, path: str, inputs: T.StructType, outputs: T.StructType) -> None:
    """Write the model with its signature beside it."""
    model.write().overwrite().save(path)
    text = json.dumps(signature(inputs, outputs))
    note = SparkSession.active().createDataFrame([(text,)], "value string")
    note.coalesce(1).write.mode("overwrite").text(f"{path}/signature")


def load_model(path: str) -> tuple[PipelineModel, dict]:
    """A saved model and its signature."""
    text = SparkSession.active().read.text(f"{path}/signature").first()["value"]
    return PipelineModel.load(path), json.loads(text)


def score_checked(path: str, df: DataFrame) -> DataFrame:
    """Load a saved model, check the frame against its signature, score."""
    model, stored = load_model(path)
    return score(model, check_signature(df, stored))

