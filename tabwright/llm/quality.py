"""Quality classifier: hashed word n-grams, logistic regression with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.rows import id_and_text, slices, text_buffer
from tabwright.llm.words import _LOWER, grams, mix, shape_hashes, span_hashes, spans


@dataclass(frozen=True)
class Settings:
    """What is learned, and how.

    ``sample`` bounds the labelled rows that a model is fitted on; scoring has no bound.
    """

    bits: int = 18
    sample: int = 20_000
    shards: int = 8
    epochs: int = 4
    scale: float = 20.0
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, one per bucket and the intercept last
    settings: Settings


def features(part: pa.RecordBatch, settings: Settings, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts of a batch, and the index of each text's first one.

    Runs of one and two words, of one to three word shapes, and a mark for each word
    that repeats the one before. A text of no words has none.
    """
    data, offsets = text_buffer(part.column(column))
    starts, ends, first = spans(data, offsets)
    words, shapes = span_hashes(_LOWER, data, starts, ends), shape_hashes(data, starts, ends)
    kinds: list[tuple[np.ndarray, np.ndarray]] = [(words, first), grams(words, first, 2)]
    kinds += [grams(shapes, first, n) for n in (1, 2, 3)]
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[first[:-1][first[:-1] < len(same)]] = False
    kinds.append((np.full(int(same.sum()), 1, np.uint64), np.concatenate([[0], np.cumsum(same)])[first]))
    total = np.zeros(len(offsets), np.int64)
    for _, runs in kinds:
        total += runs
    out = np.empty(int(total[-1]), np.int64)
    place = total[:-1].copy()
    for kind, (h, runs) in enumerate(kinds):
        bucket = (mix(h + np.uint64(kind)) >> np.uint64(64 - settings.bits)).astype(np.int64)
        counts = np.diff(runs)
        out[np.repeat(place - runs[:-1], counts) + np.arange(len(h))] = bucket
        place += counts
    return out, total


def probabilities(part: pa.RecordBatch, model: Model, column: str = "text") -> np.ndarray:
    """Probability of label 1 per text: the intercept plus a sparse dot product of weights and n-gram shares."""
    buckets, first = features(part, model.settings, column)
    counts = np.diff(first)
    sums = np.concatenate([[0.0], np.cumsum(model.weights[buckets].astype(np.float64))])
    dots = model.settings.scale * (sums[first[1:]] - sums[first[:-1]]) / np.maximum(counts, 1)
    return 1.0 / (1.0 + np.exp(-np.clip(dots + float(model.weights[-1]), -35, 35)))


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> np.ndarray:
    """Weights after passing the rows (buckets, values, label) in order, updated row by row."""
    size = (1 << settings.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weight(at: np.ndarray) -> np.ndarray:
        zs, rate = z[at], (settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2
        penalty = np.where(at == size - 1, 0.0, settings.l1)
        return np.where(np.abs(zs) <= penalty, 0.0, (np.sign(zs) * penalty - zs) / rate)

    for _ in range(settings.epochs):
        for at, x, label in rows:
            w = weight(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            moved = n[at] + g * g
            z[at] += g - (np.sqrt(moved) - np.sqrt(n[at])) / settings.alpha * w
            n[at] = moved
    return weight(np.arange(size))


def example(buckets: np.ndarray, label: int, settings: Settings) -> tuple[np.ndarray, np.ndarray, int]:
    at, counts = np.unique(buckets, return_counts=True)
    x = settings.scale * counts / max(len(buckets), 1)
    return np.append(at, 1 << settings.bits), np.append(x, 1.0), label


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, id_col="doc_id", text_col="text",
        label_id="doc_id", label_col="quality") -> Model:
    """A model of ``label_col`` (0 or 1) fitted on at most about ``settings.sample`` labelled rows.

    Rows are chosen and ordered by a hash of the id, so a rerun gives the same model.
    The ids and labels of the sample, bounded by ``settings.sample``, are sent to the
    scan of ``docs``; each shard of the sample is trained by itself and the weights are
    averaged by bucket, so what reaches the driver is one weight per bucket. Null ids
    and labels are left out; an id with several labels counts with their mean, rounded;
    repeated rows of an id are each an example. Without labelled rows every score is 0.5.
    """
    s = settings or Settings()
    clean = (
        labels.select(labels[f"`{label_id}`"].alias("id"), labels[f"`{label_col}`"].cast("double").alias("label"))
        .where("id IS NOT NULL AND label IS NOT NULL")
        .groupBy("id").agg(F.round(F.avg("label")).cast("int").alias("label"))
    )
    share = min(1.0, s.sample / max(clean.count(), 1))
    pick = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20))
    chosen = F.broadcast(clean.where(pick))
    # only ids and texts of the sample are shuffled
    sample = id_and_text(docs, id_col, text_col).join(chosen, "id").repartition(s.shards, F.xxhash64("id", F.lit("shard")))
    sample = sample.sortWithinPartitions(F.xxhash64("id", F.lit("order")), "text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for part in slices(batch):
                buckets, first = features(part, s)
                for k, label in enumerate(part.column("label").to_pylist()):
                    rows.append(example(buckets[first[k] : first[k + 1]], label, s))
        if rows:
            w = fit_rows(rows, s)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(w[at] * len(rows)), pa.array(np.full(len(at), len(rows)))], ["at", "w", "n"]
            )

    shards = sample.mapInArrow(train, "at long, w double, n long")
    merged = shards.groupBy("at").agg(F.sum("w").alias("w")).toPandas()
    rows = sample.count() if len(merged) else 1
    weights = np.zeros((1 << s.bits) + 1, np.float32)
    weights[merged["at"].to_numpy(np.int64)] = merged["w"].to_numpy() / rows
    return Model(weights, s)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row: the probability (0 to 1) that its whole text has label 1.

    A null text counts as empty; texts without words get the score of the intercept.
    Rows are independent, repeated rows get the same score, an empty table gives none.
    """
    frame = id_and_text(docs, id_col, text_col)
    sent = frame.sparkSession.sparkContext.broadcast(model)  # (1 << bits) + 1 weights of 4 bytes: 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(probabilities(part, sent.value))], ["id", "score"]
                )

    return frame.mapInArrow(run, f"id {frame.schema['id'].dataType.simpleString()}, score double")


def good(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, with all their columns.

    A null text counts as empty; texts without words have the score of the intercept. Ids
    play no part, equal rows stay or go together, an empty table gives none, and columns
    of any name come back as they are.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        found = [probabilities(part, sent.value) for part in slices(batch)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return docs.where(scores(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))) >= least)
