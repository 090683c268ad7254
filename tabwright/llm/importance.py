"""Target-distribution importance resampling by hashed features and bit-sliced sums.

A document's counts per bucket become bit planes, one bit per bucket; so do the gains of
the buckets, split by sign. The sum of count times gain is then a sum of powers of two
times the number of bits that a count plane and a gain plane share, exact in integers.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.rows import id_and_text, slices, text_buffer
from tabwright.llm.words import SIGNS, spans
from tabwright.session import materialize

#: Documents whose planes are built together, and bytes of a word taken by array steps.
STEP_DOCS, STEP_WORD = 64, 48


@dataclass(frozen=True)
class Settings:
    """``percent`` of the documents with ``least_words`` words are drawn; runs of up to two words are features."""

    buckets: int = 10_000
    percent: int = 25
    least_words: int = 20
    seed: int = 7


def _crc_table() -> np.ndarray:
    """The remainders of all bytes under the reflected polynomial of zlib's CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _step(register: np.ndarray, octets) -> np.ndarray:
    return _CRC[(register ^ octets) & 0xFF] ^ (register >> np.uint32(8))


class _Words:
    """Words of a text buffer, longest first, for running their bytes through registers."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, lengths = data, ends - starts
        self.order = np.argsort(-lengths, kind="stable")
        self.starts, self.lengths = starts[self.order], lengths[self.order]
        steps = np.arange(min(int(lengths.max(initial=0)), STEP_WORD))
        self.active = np.searchsorted(-self.lengths, -steps, "left").tolist()  # words longer than that many bytes
        self.long = int(np.searchsorted(-self.lengths, -STEP_WORD, "left"))

    def run(self, register: np.ndarray) -> np.ndarray:
        """Registers after the bytes of every word."""
        r = register[self.order]
        for k, n in enumerate(self.active):
            r[:n] = _step(r[:n], self.data[self.starts[:n] + k])
        for i in range(self.long):  # the rest of the few long words, one at a time
            a = self.starts[i]
            rest = self.data[a + STEP_WORD : a + self.lengths[i]].tobytes()
            r[i] = zlib.crc32(rest, int(r[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
        out = np.empty_like(r)
        out[self.order] = r
        return out


def features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``document, bucket`` of every feature of packed texts, and the words of each text.

    A feature is a word or two neighbours with one blank between; its bucket is the
    CRC-32 of its bytes modulo ``buckets``. Only A-Z are lower-cased.
    """
    data = _LOWER[data]
    starts, ends, first = spans(data, offsets, SIGNS)
    n_words = np.diff(first)
    document = np.repeat(np.arange(len(n_words)), n_words)
    words = _Words(data, starts, ends)
    one = words.run(np.full(len(starts), 0xFFFFFFFF, np.uint32))
    two = words.run(np.concatenate([one[:1], _step(one[:-1], np.uint32(32))]))  # the first is not used
    paired = np.flatnonzero(document[1:] == document[:-1]) + 1
    found = (np.concatenate([one, two[paired]]) ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)
    return np.concatenate([document, document[paired]]), found.astype(np.int64), n_words


def planes(numbers: np.ndarray) -> list[np.ndarray]:
    """Bit planes of rows of non-negative numbers, lowest bit first, packed into 64-bit words."""
    out, shift = [], 0
    top = int(numbers.max(initial=0))
    while top >> shift:
        packed = np.packbits((numbers >> shift & 1).astype(bool), axis=-1)
        packed = np.pad(packed, [(0, 0)] * (numbers.ndim - 1) + [(0, -packed.shape[-1] % 8)])
        out.append(packed.view(np.uint64))
        shift += 1
    return out


class Gains:
    """Signed gains of the buckets as planes."""

    def __init__(self, gains: np.ndarray):
        signed = [(1, np.maximum(gains, 0)), (-1, np.maximum(-gains, 0))]
        self.planes = [(sign * (1 << i), p) for sign, part in signed for i, p in enumerate(planes(part)) if p.any()]

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """The exact sum of count times gain for each row of ``counts``."""
        total = np.zeros(len(counts), np.int64)
        for j, plane in enumerate(planes(counts)):
            for worth, gain in self.planes:
                total += np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) * (worth << j)
        return total


def bucket_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket.

    Every task adds up what it reads and sends one row per bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                counts += np.bincount(features(*text_buffer(part.column("text")), buckets)[1], minlength=buckets)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[hit])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """``floor(1000 ln)`` of each bucket's smoothed share in the target over that in the source."""
    s_all, t_all = sum(source.values()), sum(target.values())
    return np.array(
        [
            math.floor(
                1000 * math.log(float(target.get(b, 0) + 1) * float(s_all + buckets) / (float(source.get(b, 0) + 1) * float(t_all + buckets)))
            )
            for b in range(buckets)
        ],
        np.int64,
    )


def _noise(h: int) -> int:
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, settings: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, n_features, weight, score`` of every row: the floored mean gain, and that plus drawn noise."""
    frame = id_and_text(docs, id_col, text_col)
    key = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    drawn = frame.withColumn("h", F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long"))
    buckets = settings.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = Gains(gain)
        for batch in batches:
            for part in slices(batch):
                document, bucket, n_words = features(*text_buffer(part.column("text")), buckets)
                n_features = np.bincount(document, minlength=len(n_words))
                place = np.argsort(document, kind="stable")
                document, bucket = document[place], bucket[place]
                total = np.zeros(len(n_words), np.int64)
                for low in range(0, len(n_words), STEP_DOCS):
                    high = min(low + STEP_DOCS, len(n_words))
                    a, b = np.searchsorted(document, [low, high])
                    cells = np.bincount((document[a:b] - low) * buckets + bucket[a:b], minlength=(high - low) * buckets)
                    total[low:high] = sliced.sums(cells.reshape(high - low, buckets))
                weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
                score = weight + np.array([_noise(h) for h in part.column("h").to_pylist()], np.int64)
                columns = [pa.array(c.astype(np.int64)) for c in (n_words, n_features, weight, score)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], ["id", "n_words", "n_features", "weight", "score"])

    kind = frame.schema["id"].dataType.simpleString()
    return drawn.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long, score long")


def with_ranks(scored: DataFrame, settings: Settings) -> DataFrame:
    """``scored`` with ``rank``: 1 for the highest score of those drawn, ties to the smaller id; null for the others.

    Scores are whole numbers of a bounded range (about +-45,000 from the gains, -3,200 to
    22,500 from the noise), so the table of counts per score is bounded whatever the
    input; running totals over it give every score its first rank and the score at which
    the draw ends. Rows are then ordered within one score only. The noise keeps any score
    below 1 of 2,000 rows, even among equal texts.
    """
    asked = F.col("n_words") >= settings.least_words
    per_score = scored.where(asked).groupBy("score").agg(F.count("*").alias("n")).withColumn("band", F.floor(F.col("score") / 256))
    bands = per_score.groupBy("band").agg(F.sum("n").alias("in_band"))
    bands = bands.select("band", F.sum("in_band").over(Window.orderBy(F.desc("band"))).alias("upto"), "in_band")
    inside = Window.partitionBy("band").orderBy(F.desc("score"))
    above = (
        per_score.join(bands, "band")
        .select("score", (F.col("upto") - F.col("in_band") + F.sum("n").over(inside) - F.col("n")).alias("above"))
    )
    drawn = scored.where(asked).agg(F.floor(F.count("*") * settings.percent / 100).alias("drawn")).scalar()
    above = materialize(above.withColumn("drawn", drawn).where("above < drawn"), "ranks")
    last = above.agg(F.min("score")).scalar()
    picked = asked & F.coalesce(F.col("score") >= last, F.lit(False))
    rank = F.col("above") + F.row_number().over(Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last()))
    top = scored.where(picked).join(above, "score").select(*scored.columns, F.when(rank <= F.col("drawn"), rank).alias("rank"))
    return top.unionByName(scored.where(~picked).withColumn("rank", F.lit(None).cast("long")))


def importance_resample(
    docs: DataFrame, target: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", target_text: str = "text"
) -> DataFrame:
    """``id, n_words, n_features, weight, score, rank`` of every row of ``docs``.

    Documents that look like ``target`` weigh more; adding Gumbel noise told by the id and
    taking the highest scores draws without replacement by weight. Null texts count as
    empty and have no features and weight 0; a null id is drawn as the empty text and
    ranks last among ties. Repeated rows are documents of their own with the same score
    and neighbouring ranks. An empty table gives no rows, an empty target is a uniform
    one. Texts are taken whole; other columns play no part.
    """
    source = bucket_counts(id_and_text(docs, id_col, text_col), settings.buckets)
    wanted = bucket_counts(target.select(F.coalesce(target[f"`{target_text}`"].cast("string"), F.lit("")).alias("text")), settings.buckets)
    # at most one row per bucket each
    gain = gains(*({r.bucket: r.n for r in counts.collect()} for counts in (source, wanted)), settings.buckets)
    return with_ranks(materialize(weighted(docs, gain, settings, id_col, text_col), "scored"), settings)
