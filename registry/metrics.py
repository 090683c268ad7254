"""Queries of aggregates, classification metrics, profiles, drift and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import query
from registry.tables import flat_quality, quality_sql, rounded, table
from tabwright.operators import profile as pr
from tabwright.operators.drift import categorical_drift, numeric_drift
from tabwright.operators.metrics import accuracy, auc, auc_hard, classification_report, compare_predictions, confusion
from tabwright.operators.metrics import champion_challenger

SCORED_SQL = """SELECT doc_id, lang, n_chars, quality AS label, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS prediction,
                       CASE WHEN n_chars > 900 THEN 1 ELSE 0 END AS other
                FROM documents JOIN labels USING (doc_id)"""


def scored(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "lang", "n_chars", "CAST(n_chars > 500 AS INT) AS prediction", "CAST(n_chars > 900 AS INT) AS other"
    )
    return documents.join(table(spark, sf_dir, "labels").selectExpr("doc_id", "quality AS label"), "doc_id")


EVENTS_SQL = """SELECT epoch_us(ts) // 1000000 AS second, event_id, user_id, value, user_id % 2 AS model,
                       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label,
                       CASE WHEN value > 50 THEN 1 ELSE 0 END AS prediction FROM events"""


def judged(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "ts", "event_id", "user_id", "event_type", "value", "user_id % 2 AS model",
        "CAST(event_type = 'purchase' AS INT) AS label", "CAST(value > 50 AS INT) AS prediction",
    )


@query("a1_max_timestamp", "SELECT epoch_us(max(ts)) AS ts FROM events")
def a1_max_timestamp(spark, sf_dir):
    newest = pr.max_timestamp(table(spark, sf_dir, "events"), "ts")
    return newest.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"))


PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "a2_numeric_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std
            FROM lineitem"""
        for c in PROFILED
    ),
)
def a2_numeric_profile(spark, sf_dir):
    return rounded(pr.numeric_profile(table(spark, sf_dir, "lineitem"), PROFILED), "mean", "std", digits=3)


@query(
    "a3_value_counts",
    """SELECT c_mktsegment, count(*) AS n, round(count(*) / (SELECT count(*) FROM customer), 6) AS share
       FROM customer GROUP BY c_mktsegment""",
)
def a3_value_counts(spark, sf_dir):
    return rounded(pr.value_counts(table(spark, sf_dir, "customer"), "c_mktsegment", normalize=True), "share")


@query("a4_distinct_values", "SELECT DISTINCT o_custkey FROM orders")
def a4_distinct_values(spark, sf_dir):
    return pr.distinct_values(table(spark, sf_dir, "orders"), "o_custkey")


@query(
    "a4_distinct_count",
    """SELECT count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_suppkey) AS l_suppkey,
              count(DISTINCT l_returnflag) AS l_returnflag FROM lineitem""",
)
def a4_distinct_count(spark, sf_dir):
    return pr.distinct_count(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey", "l_returnflag"])


@query(
    "a4_distinct_count_approx",
    """SELECT count(DISTINCT l_partkey) AS l_partkey, count(DISTINCT l_suppkey) AS l_suppkey,
              true AS l_partkey_near, true AS l_suppkey_near FROM lineitem""",
)
def a4_distinct_count_approx(spark, sf_dir):
    """The exact counts, and whether the approximate ones are within five percent of them."""
    lineitem, keys = table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"]
    both = pr.distinct_count(lineitem, keys).withColumn("exact", F.lit(True))
    both = both.unionByName(pr.distinct_count(lineitem, keys, approx=True).withColumn("exact", F.lit(False)))
    exact, about = ({k: F.max(F.when(F.col("exact") == which, F.col(k))) for k in keys} for which in (True, False))
    near = [(F.abs(about[k] - exact[k]) <= 0.05 * exact[k]).alias(f"{k}_near") for k in keys]
    return both.agg(*[exact[k].alias(k) for k in keys], *near)


@query("a5_shape", 'SELECT count(*) AS "rows", 11 AS "columns" FROM lineitem')
def a5_shape(spark, sf_dir):
    return pr.shape(table(spark, sf_dir, "lineitem"))


@query("a6_confusion", f"SELECT lang, label, prediction, count(*) AS n FROM ({SCORED_SQL}) GROUP BY ALL")
def a6_confusion(spark, sf_dir):
    return confusion(scored(spark, sf_dir), "label", "prediction", ["lang"])


@query(
    "a7_accuracy",
    f"""SELECT lang, count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1 ELSE 0 END), 6) AS accuracy
        FROM ({SCORED_SQL}) GROUP BY lang""",
)
def a7_accuracy(spark, sf_dir):
    return rounded(accuracy(scored(spark, sf_dir), "label", "prediction", ["lang"]), "accuracy")


@query(
    "a8_auc_hard",
    f"""SELECT round((avg(CASE WHEN label = 1 THEN prediction END) + avg(CASE WHEN label = 0 THEN 1 - prediction END)) / 2, 6)
        AS auc_hard FROM ({SCORED_SQL})""",
)
def a8_auc_hard(spark, sf_dir):
    return rounded(auc_hard(scored(spark, sf_dir), "label", "prediction"), "auc_hard")


def _auc_sql(rows: str, score: str, by: str = "") -> str:
    """Rank sum with mean ranks for ties."""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    ties = f"PARTITION BY {by + ', ' if by else ''}{score}"
    return f"""
      SELECT {by + ',' if by else ''} CAST(sum(label) AS BIGINT) AS positives,
             CAST(count(*) - sum(label) AS BIGINT) AS negatives,
             round((sum(label * mean_rank) - sum(label) * (sum(label) + 1) / 2)
                   / nullif(sum(label) * (count(*) - sum(label)), 0), 6) AS auc
      FROM (SELECT *, rank() OVER ({part}ORDER BY {score}) + (count(*) OVER ({ties}) - 1) / 2 AS mean_rank FROM ({rows}))
      {group}"""


@query("a8_auc", _auc_sql(EVENTS_SQL, "value"))
def a8_auc(spark, sf_dir):
    return rounded(auc(judged(spark, sf_dir), "label", "value"), "auc")


@query("a8_auc_by_group", _auc_sql(SCORED_SQL, "n_chars", "lang"))
def a8_auc_by_group(spark, sf_dir):
    return rounded(auc(scored(spark, sf_dir), "label", "n_chars", ["lang"]), "auc")


def _report_sql(rows: str, label: str, prediction: str) -> str:
    return f"""
      WITH pairs AS (SELECT CAST({label} AS VARCHAR) AS y, CAST({prediction} AS VARCHAR) AS p FROM ({rows})),
      classes AS (SELECT y AS c FROM pairs UNION SELECT p FROM pairs),
      cells AS (SELECT c, (SELECT count(*) FROM pairs WHERE y = c AND p = c) AS tp,
                       (SELECT count(*) FROM pairs WHERE y <> c AND p = c) AS fp,
                       (SELECT count(*) FROM pairs WHERE y = c AND p <> c) AS fn FROM classes),
      scored AS (SELECT c, coalesce(tp / nullif(tp + fp, 0), 0) AS pr, coalesce(tp / nullif(tp + fn, 0), 0) AS re,
                        coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, tp + fn AS support, tp FROM cells)
      SELECT c AS class, round(pr, 6) AS "precision", round(re, 6) AS recall, round(f1, 6) AS f1, support FROM scored
      UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
                       round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scored
      UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT)
                FROM scored
      UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 6),
                       round(sum(re * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                       CAST(sum(support) AS BIGINT) FROM scored"""


@query("a9_classification_report", _report_sql(SCORED_SQL, "label", "prediction"))
def a9_classification_report(spark, sf_dir):
    return rounded(classification_report(scored(spark, sf_dir), "label", "prediction"), "precision", "recall", "f1")


KINDS_SQL = "SELECT l_returnflag AS y, CASE WHEN l_quantity > 30 THEN 'R' WHEN l_tax > 0.04 THEN 'A' ELSE 'X' END AS p FROM lineitem"


@query("a9_classification_report_classes", _report_sql(KINDS_SQL, "y", "p"))
def a9_classification_report_classes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_returnflag AS y", "CASE WHEN l_quantity > 30 THEN 'R' WHEN l_tax > 0.04D THEN 'A' ELSE 'X' END AS p"
    )
    return rounded(classification_report(lines, "y", "p"), "precision", "recall", "f1")


@query("a10_quality_profile", quality_sql(EVENTS_SQL, "label", "prediction", "second // 1800 * 1800", "model"))
def a10_quality_profile(spark, sf_dir):
    return flat_quality(pr.quality_profile(judged(spark, sf_dir), "ts", "label", "prediction", ["model"]), ("model",))


@query(
    "a10_report_profile",
    """WITH pairs AS (SELECT epoch_us(ts) // 86400000000 * 86400 AS w, event_type AS y,
                             CASE WHEN value > 80 THEN 'purchase' WHEN value > 20 THEN 'view' ELSE 'click' END AS p FROM events),
       sides AS (SELECT w, y AS class, CASE WHEN y = p THEN 1 ELSE 0 END AS tp, 1 AS actual, 0 AS guessed FROM pairs
                 UNION ALL SELECT w, p, 0, 0, 1 FROM pairs),
       cells AS (SELECT w, class, sum(tp) AS tp, sum(actual) AS actual, sum(guessed) AS guessed FROM sides GROUP BY ALL),
       ratios AS (SELECT w, class, coalesce(tp / nullif(guessed, 0), 0) AS pr, coalesce(tp / nullif(actual, 0), 0) AS re, tp, actual FROM cells),
       lines AS (SELECT w, class, pr, re, actual FROM ratios
                 UNION ALL SELECT w, 'accuracy', sum(tp) / sum(actual), sum(tp) / sum(actual), sum(actual) FROM ratios GROUP BY w
                 UNION ALL SELECT w, 'macro avg', avg(pr), avg(re), sum(actual) FROM ratios GROUP BY w
                 UNION ALL SELECT w, 'weighted avg', sum(pr * actual) / sum(actual), sum(re * actual) / sum(actual), sum(actual) FROM ratios GROUP BY w)
       SELECT w AS window_start, class, round(pr, 6) AS "precision", round(re, 6) AS recall, CAST(actual AS BIGINT) AS support FROM lines""",
)
def a10_report_profile(spark, sf_dir):
    guess = "CASE WHEN value > 80 THEN 'purchase' WHEN value > 20 THEN 'view' ELSE 'click' END AS guess"
    rows = table(spark, sf_dir, "events").selectExpr("ts", "event_type", guess)
    found = pr.report_profile(rows, "ts", "event_type", "guess", granularity="1 day")
    return (
        rounded(found, "precision", "recall")
        .select(F.unix_seconds(F.col("window.start").cast("timestamp")).alias("window_start"), "class", "precision", "recall", "support")
    )


def _profile_sql(column: str) -> str:
    return f"""SELECT second // 86400 * 86400 AS window_start, model, '{column}' AS "column", count(x) AS n,
                      count(*) - count(x) AS nulls, min(x) AS "min", max(x) AS "max", round(avg(x), 6) AS mean,
                      round(stddev_samp(x), 6) AS std, count(DISTINCT x) AS "distinct",
                      round(quantile_cont(x, 0.5), 6) AS median
               FROM (SELECT *, CAST(CASE WHEN event_id % 13 = 0 THEN NULL ELSE {column} END AS DOUBLE) AS x FROM ({EVENTS_SQL}))
               GROUP BY 1, 2"""


def _with_gaps(spark, sf_dir):
    rows = judged(spark, sf_dir)
    gap = F.expr("event_id % 13 <> 0")
    return rows.select("ts", "model", F.when(gap, F.col("value")).alias("value"), F.when(gap, F.col("user_id")).alias("user_id"))


@query("a11_column_profile", _profile_sql("value") + " UNION ALL " + _profile_sql("user_id"))
def a11_column_profile(spark, sf_dir):
    found = pr.column_profile(_with_gaps(spark, sf_dir), "ts", ["value", "user_id"], ["model"], "1 day")
    return rounded(found, "mean", "std", "median").select(
        F.unix_seconds(F.col("window.start").cast("timestamp")).alias("window_start"), "model", "column",
        "n", "nulls", "min", "max", "mean", "std", "distinct", "median",
    )


@query(
    "a11_column_profile_approx",
    f"""SELECT window_start, model, "column", n, nulls, "min", "max", mean, std, true AS distinct_near, true AS median_near
        FROM ({_profile_sql("value")} UNION ALL {_profile_sql("user_id")})""",
)
def a11_column_profile_approx(spark, sf_dir):
    """The exact columns; distinct counts within a twentieth, medians between the values next to the middle."""
    rows, columns = _with_gaps(spark, sf_dir), ["value", "user_id"]
    found = pr.column_profile(rows, "ts", columns, ["model"], "1 day", approx=True)
    exact = pr.column_profile(rows, "ts", columns, ["model"], "1 day").select(
        "window", "model", "column", F.col("distinct").alias("all"), F.col("median").alias("middle")
    )
    ordered = rows.select(F.window("ts", "1 day").alias("window"), "model", *[F.col(c).cast("double") for c in columns])
    ordered = ordered.unpivot(["window", "model"], columns, "column", "value").where("value IS NOT NULL")
    keys = ["window", "model", "column"]
    beside = ordered.join(found.select(*keys, F.col("median").alias("about")), keys).groupBy(*keys).agg(
        F.count_if(F.col("value") < F.col("about")).alias("below"), F.count_if(F.col("value") <= F.col("about")).alias("up_to"), F.count("value").alias("known")
    )
    both = rounded(found, "mean", "std").join(exact, keys).join(beside, keys, "left")
    half = F.col("known") / 2
    return both.select(
        F.unix_seconds(F.col("window.start").cast("timestamp")).alias("window_start"), "model", "column", "n", "nulls", "min", "max", "mean", "std",
        (F.abs(F.col("distinct") - F.col("all")) <= F.greatest(F.lit(1), 0.05 * F.col("all"))).alias("distinct_near"),
        F.coalesce((F.col("below") <= half + 1) & (F.col("up_to") >= half - 1), F.col("n") == 0).alias("median_near"),
    )


def _drift_sql(column: str) -> str:
    edges = ", ".join(f"{i / 10}" for i in range(1, 10))
    return f"""
      SELECT '{column}' AS "column", (
        SELECT round(max(abs(fp - fq)), 6) FROM (
          SELECT sum(p) OVER (ORDER BY x) / sum(p) OVER () AS fp, sum(q) OVER (ORDER BY x) / sum(q) OVER () AS fq
          FROM (SELECT {column} AS x, sum(CASE WHEN late THEN 0 ELSE 1 END) AS p, sum(CASE WHEN late THEN 1 ELSE 0 END) AS q
                FROM halves GROUP BY 1))) AS ks, (
        SELECT round(sum((q - p) * ln(q / p)), 6) FROM (
          SELECT greatest(sum(CASE WHEN late THEN 0 ELSE n END) / sum(sum(CASE WHEN late THEN 0 ELSE n END)) OVER (), 1e-6) AS p,
                 greatest(sum(CASE WHEN late THEN n ELSE 0 END) / sum(sum(CASE WHEN late THEN n ELSE 0 END)) OVER (), 1e-6) AS q
          FROM (SELECT late, len(list_filter(
                  (SELECT quantile_cont(CAST({column} AS DOUBLE), [{edges}]) FROM halves WHERE NOT late), lambda e: e < {column})) AS bin,
                  1 AS n FROM halves
                UNION ALL SELECT false, i, 0 FROM range(10) t(i))
          GROUP BY bin)) AS psi"""


HALVES_SQL = "WITH halves AS (SELECT *, epoch_us(ts) >= 1705363200000000 AS late FROM events) "


def _halves(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("value", "user_id", "event_type", F.expr("ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00'").alias("late"))
    return events.where("not late"), events.where("late")


@query("a12_numeric_drift", HALVES_SQL + _drift_sql("value") + " UNION ALL " + _drift_sql("user_id"))
def a12_numeric_drift(spark, sf_dir):
    return rounded(numeric_drift(*_halves(spark, sf_dir), ["value", "user_id"]), "ks", "psi")


@query(
    "a12_categorical_drift",
    HALVES_SQL
    + """, cells AS (SELECT event_type, sum(CASE WHEN late THEN 0 ELSE 1 END) AS a, sum(CASE WHEN late THEN 1 ELSE 0 END) AS b
                     FROM halves GROUP BY 1),
       shares AS (SELECT *, a / sum(a) OVER () AS p, b / sum(b) OVER () AS q, (a + b) * sum(a) OVER () / sum(a + b) OVER () AS ea,
                         (a + b) * sum(b) OVER () / sum(a + b) OVER () AS eb FROM cells)
       SELECT 'event_type' AS "column", round(sum((a - ea) ** 2 / ea + (b - eb) ** 2 / eb), 6) AS chi_square,
              round(sum(abs(p - q)) / 2, 6) AS total_variation,
              round(sqrt(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END) / 2
                         + sum(CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2), 6) AS js_distance FROM shares""",
)
def a12_categorical_drift(spark, sf_dir):
    found = categorical_drift(*_halves(spark, sf_dir), ["event_type"])
    return rounded(found, "chi_square", "total_variation", "js_distance")


WINDOWS_SQL = quality_sql(EVENTS_SQL, "label", "prediction", "second // 1800 * 1800", "model")


@query(
    "a13_alert",
    f"""SELECT * FROM ({WINDOWS_SQL}) w WHERE accuracy_score < 0.95
        AND window_start = (SELECT max(second // 1800 * 1800) FROM ({EVENTS_SQL}))""",
)
def a13_alert(spark, sf_dir):
    quality = pr.quality_profile(judged(spark, sf_dir), "ts", "label", "prediction", ["model"])
    return flat_quality(pr.alert(quality, threshold=0.95), ("model",))


@query(
    "g2_metric_change",
    f"""SELECT window_start, model, accuracy_score,
               round(accuracy_score - lag(accuracy_score) OVER (PARTITION BY model ORDER BY window_start), 6) AS change
        FROM ({WINDOWS_SQL})""",
)
def g2_metric_change(spark, sf_dir):
    quality = pr.quality_profile(judged(spark, sf_dir), "ts", "label", "prediction", ["model"])
    changed = pr.metric_change(quality.withColumn("accuracy_score", F.round("accuracy_score", 6)), "accuracy_score", ["model"])
    start = F.unix_seconds(F.col("window.start").cast("timestamp")).alias("window_start")
    return changed.select(start, "model", "accuracy_score", F.round("change", 6).alias("change"))


def _hard_auc(prediction: str) -> str:
    return f"""round((avg(CASE WHEN label = 1 THEN {prediction} END) + avg(CASE WHEN label = 0 THEN 1 - {prediction} END)) / 2, 6)"""


@query(
    "ml6_champion_challenger",
    f"""SELECT *, CAST(CASE WHEN round(accuracy_current, 2) > round(accuracy_latest, 2) THEN 1 ELSE 0 END AS INTEGER) AS challenger_wins
        FROM (SELECT count(*) AS n, round(avg(CASE WHEN label = other THEN 1 ELSE 0 END), 6) AS accuracy_current,
                     round(avg(CASE WHEN label = prediction THEN 1 ELSE 0 END), 6) AS accuracy_latest,
                     {_hard_auc('other')} AS auc_current, {_hard_auc('prediction')} AS auc_latest FROM ({SCORED_SQL}))""",
)
def ml6_champion_challenger(spark, sf_dir):
    rows = scored(spark, sf_dir)
    verdict = champion_challenger(rows, "label", "other", "prediction")
    metrics = ("accuracy_current", "accuracy_latest", "auc_current", "auc_latest")
    found = rounded(compare_predictions(rows, "label", "other", "prediction"), *metrics)
    return found.withColumn("challenger_wins", F.lit(int(verdict.challenger_wins)))
