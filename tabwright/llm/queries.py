"""Queries of the training-data operators on whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.bpe import bpe_round_trip
from tabwright.llm.decontaminate import contaminated
from tabwright.llm.exact_dedup import exact_duplicates
from tabwright.llm.fill_middle import fill_in_middle, restore
from tabwright.llm.importance import importance_resample
from tabwright.llm.line_dedup import drop_repeated_lines
from tabwright.llm.near_dedup import near_duplicates
from tabwright.llm.packing import pack
from tabwright.llm.pages import extract_text
from tabwright.llm.personal_data import KINDS, personal_data, spans_text
from tabwright.llm.quality import fit, score
from tabwright.llm.rows import read_table
from tabwright.llm.substring_dedup import drop_repeated_strings
from tabwright.llm.token_counts import count_tokens

#: From this score on a document counts as good.
QUALITY = 0.3
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def held_out(id_col: str = "doc_id"):
    """A fifth of the ids: their labels are never learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


@_query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = score(docs, fit(docs, labels.where(~held_out())))
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= QUALITY).cast("int").alias("predicted"),
    )


@_query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_strings(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@_query("op3_minhash_near_dedup")
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@_query(
    "op4_line_dedup",
    r"""WITH split AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                              unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
            full_lines AS (SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS t FROM split
                           WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
            pairs AS (SELECT doc_id, i, lead(i) OVER w AS j, t, lead(t) OVER w AS u FROM full_lines
                      WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
            ranked AS (SELECT doc_id, i, j, row_number() OVER (PARTITION BY t, u ORDER BY doc_id, i) AS nth
                       FROM pairs WHERE j IS NOT NULL),
            long AS (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS nth FROM full_lines
                     WHERE len(string_split_regex(t, '[ \t\x0b\x0c\r]+')) >= 50),
            gone AS (SELECT s.doc_id, s.i FROM split s JOIN ranked r
                     ON s.doc_id = r.doc_id AND s.i BETWEEN r.i AND r.j WHERE r.nth > 1
                     UNION SELECT doc_id, i FROM long WHERE nth > 1)
       SELECT s.doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(g.i) AS INTEGER) AS n_removed,
              sha256(coalesce(string_agg(s.line, chr(10) ORDER BY s.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
       FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id""",
)
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_lines(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


@_query("op5_personal_data")
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda m: ~m["added"])
    return found.select(
        F.col("id").alias("doc_id"),
        *[F.size(F.filter(base, _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda m: m["added"])).cast("long").alias("n_added"),
    )


@_query("op6_html_extraction")
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(read_table(spark, sf_dir, "pages"))
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n", -1)))
    return found.select(F.col("id").alias("page_id"), lines.cast("long").alias("n_lines"), "text")


@_query("op7_bpe_round_trip")
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("byte_bpe_50k.json")
    both = bpe_round_trip(read_table(spark, sf_dir, "documents"), path)
    return both.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@_query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return count_tokens(docs, tokenizer_path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


@_query(
    "op9_exact_dedup",
    """WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents),
            g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
       SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
       FROM t JOIN g USING (norm)""",
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(read_table(spark, sf_dir, "documents"), digest=True)
    return found.withColumnsRenamed({"id": "doc_id", "digest": "text_sha256"})


@_query("op10_benchmark_decontamination")
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = contaminated(docs, read_table(spark, sf_dir, "benchmark"))
    ids = docs.select(docs["doc_id"].alias("id"))
    return ids.join(found, "id", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n_items").isNotNull().alias("contaminated"),
        F.col("n_items").isNull().alias("kept"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.col("item").alias("item_id"),
        F.coalesce("covered_share", F.lit(0.0)).alias("covered_share"),
    )


@_query("op11_sequence_packing")
def op11_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_query("op12_importance_resampling")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance_resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


@_query(
    "op13_fill_in_middle",
    """WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
            d AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS r1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS r2,
                         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS p3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS p4 FROM t),
            f AS (SELECT doc_id, text, n, least(r1, r2) AS a, greatest(r1, r2) AS b,
                         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR p3 >= 90 THEN 'plain'
                              WHEN p4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
            c AS (SELECT *, substring(text, 1, a) AS pre, substring(text, a + 1, b - a) AS mid, substring(text, b + 1) AS suf FROM f)
       SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
              sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
                               ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
              sha256(text) AS restored_sha256 FROM c""",
)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = restore(fill_in_middle(read_table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", *digests)
