"""Shared helpers: plain named columns, Arrow batches cut to a bounded size, packed text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of array code looks at together (a longer text is a step of its own).
STEP_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id`` and ``text`` alone, a null text as the empty one; other columns never clash."""
    return docs.select(
        docs[f"`{id_col}`"].alias("id"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text")
    )


#: Bits of a mark table: 1 MB, whatever is marked.
MARK_BITS = 1 << 23
BITMAP = 1 << 15  # bits of one value of bitmap_construct_agg


def marks(keys: DataFrame, hashed: str, bits: int = MARK_BITS) -> DataFrame:
    """A table of fixed size (``bits / 8`` bytes in all) with a bit set for each value of a column of hashes."""
    bit = F.pmod(F.col(hashed), F.lit(bits))
    return (
        keys.select(bit.alias("bit"))
        .groupBy(F.floor(F.col("bit") / BITMAP).cast("int").alias("_mark_bucket"))
        .agg(F.bitmap_construct_agg(F.col("bit") % BITMAP).alias("_mark_bits"))
    )


def with_mark(df: DataFrame, hashed: str, table: DataFrame, bits: int = MARK_BITS) -> DataFrame:
    """``df`` with ``marked``: false only where the hash was never marked.

    The table is broadcast; its size is fixed. Wrong marks grow with what is marked and
    cost work, never a result.
    """
    bit = F.pmod(F.col(hashed), F.lit(bits))
    place = (bit % BITMAP).cast("int")
    octet = F.conv(F.hex(F.substring(F.col("_mark_bits"), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return (
        df.withColumn("_mark_bucket", F.floor(bit / BITMAP).cast("int"))
        .join(F.broadcast(table), "_mark_bucket", "left")
        .withColumn("_mark_octet", octet)
        .withColumn("_mark_place", place % 8)
        .withColumn("marked", F.coalesce(F.expr("(shiftright(_mark_octet, _mark_place) & 1) = 1"), F.lit(False)))
        .drop("_mark_bucket", "_mark_bits", "_mark_octet", "_mark_place")
    )


def join_same(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """A join on equal columns in which null equals null; the columns come from ``left``."""
    other = right.withColumnsRenamed({c: f"{c}_of_right" for c in columns})
    same = [F.col(c).eqNullSafe(F.col(f"{c}_of_right")) for c in columns]
    return left.join(other, same, how).drop(*[f"{c}_of_right" for c in columns])


def keep_decided(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``decided(id, row, stays)`` sends away; ``row`` is the hash of a text.

    Rows it does not name stay. Of rows with one id and text that it lets stay, one does.
    Only rows whose text hash is marked are shuffled, the rest is a filter. All columns
    of ``docs`` come back, in order.
    """
    text = F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))
    whole = docs.select(F.struct(*docs.columns).alias("whole"), docs[f"`{id_col}`"].alias("id"), F.xxhash64(text).alias("row"))
    whole = with_mark(whole, "row", marks(decided, "row"))
    verdicts = decided.select(F.col("id").alias("same_id"), F.col("row").alias("same_row"), "stays").distinct()
    known = F.col("row").eqNullSafe(F.col("same_row")) & F.col("id").eqNullSafe(F.col("same_id"))
    asked = whole.where("marked").join(verdicts, known, "left")
    one = asked.where("stays").dropDuplicates(["id", "row"])
    return whole.where("NOT marked").select("whole.*").union(asked.where("stays IS NULL").select("whole.*")).union(one.select("whole.*"))


def slices(batch: pa.RecordBatch, column: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of a batch whose texts hold about ``size`` bytes, one row at least."""
    offsets = text_buffer(batch.column(column))[1]
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), rows)
        yield batch.slice(start, end - start)
        start = end


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column and the offsets of each (one more than rows), from 0."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
