"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Built from DataFrame functions only. Each step looks at more of a text, but only
of texts that the step before could not tell apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.rows import id_and_text, keep_decided, marks, with_mark
from tabwright.session import materialize

#: Characters under the prefix hash.
PREFIX = 64


def normalised(text: Column) -> Column:
    """Every run of blanks, tabs and line ends as one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def _stage_keys(frame: DataFrame) -> DataFrame:
    return frame.withColumn("norm", normalised(F.col("text"))).select(
        "id", "norm", F.xxhash64("text").alias("row"), F.length("norm").alias("n"), F.xxhash64(F.substring("norm", 1, PREFIX)).alias("p")
    )


def _rows_and_groups(frame: DataFrame, digest: bool) -> tuple[DataFrame, DataFrame]:
    keys = materialize(_stage_keys(frame).select("n", "p"), "exact-keys")
    same_length = keys.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("n")
    same_prefix = keys.join(same_length, "n", "left_semi").groupBy("n", "p").agg(F.count(F.lit(1)).alias("rows"))
    table = marks(same_prefix.where("rows > 1").select(F.xxhash64("n", "p").alias("key")), "key")
    rows = with_mark(_stage_keys(frame).withColumn("key", F.xxhash64("n", "p")), "key", table)
    full = F.sha2(F.col("norm").cast("binary"), 256)
    more = [full.alias("digest")] if digest else []
    rows = rows.select("id", "row", "n", "p", F.when(F.col("marked"), full).alias("full"), *more)
    rows = materialize(rows, "exact-rows")
    groups = (
        rows.where("full IS NOT NULL")
        .groupBy("n", "p", "full")
        .agg(F.min("id").alias("keep_id"), F.min(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    )
    return rows, groups


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``id, keep_id, group_size, kept`` (and ``digest``).

    Texts are equal when identical after :func:`normalised`; a null text equals the
    empty one. ``keep_id`` is the smallest id among the equal texts, ``kept`` whether
    the row carries it: rows that repeat a whole row are each counted, and each
    carries the smallest id. A null id counts in its group and stays only if all ids
    of the group are null. ``digest`` adds the SHA-256 of each normalised text, which
    means reading all of them in full. An empty table gives an empty result.

    First pass: (length, prefix hash) per row, and the groups of these that have more
    than one row. They mark bits of a table of fixed size. Second pass: full hash of
    the marked rows alone; a wrongly marked row is hashed in vain, nothing else. Only
    ids and hashes are shuffled, never texts, and counts are combined before the
    shuffle, so a large group of copies costs one row per task. The join that brings
    the counts back is one that adaptive execution splits when a key is hot.
    """
    rows, groups = _rows_and_groups(id_and_text(docs, id_col, text_col), digest)
    out = rows.join(groups, ["n", "p", "full"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return out.select(
        "id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        *(["digest"] if digest else []),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the smallest id (a null id is the smallest here).

    Null and empty texts are equal; of rows equal in id and text one stays. An empty table
    gives none, and columns of any name come back as they are.
    """
    rows, groups = _rows_and_groups(id_and_text(docs, id_col, text_col), False)
    decided = rows.join(groups.where("group_size > 1"), ["n", "p", "full"])
    stays = F.struct("id", "row").eqNullSafe(F.col("keep"))
    return keep_decided(docs, materialize(decided.select("id", "row", stays.alias("stays")), "exact-decided"), id_col, text_col)
