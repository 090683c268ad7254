"""A training corpus from raw documents: quality, exact and near copies, benchmark leaks, tokens.

Each stage reads all that the one before kept and returns the columns of ``documents``;
the last returns packed token ids.

All stages take a null text as the empty one, null ids, rows that share an id, and further
columns of any name, which come back as they are (the last stage leaves them out). An
empty table gives an empty one. Of rows that are equal in id and text one stays after the
stages that drop copies; the others treat every row by itself.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.bpe import bpe_round_trip
from tabwright.llm.decontaminate import drop_contaminated
from tabwright.llm.exact_dedup import drop_exact_duplicates
from tabwright.llm.near_dedup import Settings, drop_near_duplicates
from tabwright.llm.quality import fit, good
from tabwright.llm.queries import QUALITY, held_out
from tabwright.llm.rows import read_table
from tabwright.session import materialize

#: Near copies share shingles of five words at a similarity of 0.8 or more.
NEAR = Settings(words=5, percent=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels that are not held out.

    A text without words has the score of the intercept, so all of them stay or go together.
    """
    labels = read_table(spark, sf_dir, "labels").where(~held_out())
    return good(docs, fit(docs, labels), QUALITY)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id stays.

    Null and empty texts are equal; a null id is the smallest.
    """
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of near copies join the one with the smallest id stays.

    Texts without words are linked with nothing and stay; a null id is the smallest.
    """
    return drop_near_duplicates(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold most of a benchmark item go; texts too short to hold one stay."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every document, their number, and whether decoding gives the text back.

    An empty text has no ids, which give it back.
    """
    path = tokenizer_path("byte_bpe_50k.json")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    keyed = docs.select(F.struct("doc_id", digest.alias("before")).alias("key"), "text")
    both = bpe_round_trip(keyed, path, "key")
    return both.select(
        F.col("id.doc_id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.sha2("text", 256) == F.col("id.before")).alias("round_trip"),
    )


STAGES = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("decontaminate", decontaminate),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written before the next reads them."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
