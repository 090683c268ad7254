"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Names that operators use inside; as extra columns they must do no harm.
CLASHING = ("id", "row", "ids", "n", "p", "full", "key", "print", "class", "kept", "marked", "words", "score", "_id", "_row", "stays", "label", "spans", "item", "tree")

PASSAGE = "every morning the old keeper walks along the grey harbour wall and counts the boats that came in overnight"
TEXTS: list[tuple[int | None, str | None]] = [
    (1, PASSAGE),
    (2, PASSAGE.upper()),
    (3, PASSAGE + " before breakfast"),
    (4, None),
    (5, ""),
    (6, " \t\n"),
    (7, "word"),
    (8, "word"),
    (8, "word"),  # a repeated row
    (9, "two  words"),
    (9, "another text under the same id, which says something else entirely"),
    (10, "two words"),
    (None, "word"),
    (None, None),
    (11, "line one\nline two\n\nline three\nline one\nline two"),
    (12, "x " * 3000 + PASSAGE),
    (13, "naïve café — ünïcödé 日本語 🙂 " + PASSAGE),
    (14, "y" * 5000),
    (15, "y" * 200),
    (16, "line one\nline two\nand more <|endoftext|> text"),
]


def messy(spark: SparkSession, rows=TEXTS) -> DataFrame:
    extra = [f"`{c}` string" for c in CLASHING]
    schema = ", ".join(["doc_id long", "text string", *extra])
    return spark.createDataFrame([(i, t, *["zzz"] * len(extra)) for i, t in rows], schema)


def empty(spark: SparkSession) -> DataFrame:
    return messy(spark).limit(0)


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


def documents(spark: SparkSession, sf_dir: str) -> list[tuple[int, str]]:
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
