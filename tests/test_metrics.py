import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tabwright.operators import drift as dr
from tabwright.operators import metrics as mt
from tabwright.operators import profile as pr
from tabwright.operators.running import exact_quantiles

# Counts of label and prediction of a stored model.
GOLDEN = {(0, 0): 2677, (0, 1): 295, (1, 0): 453, (1, 1): 1218}


@pytest.fixture(scope="module")
def golden(spark):
    cells = spark.createDataFrame([(y, p, n) for (y, p), n in GOLDEN.items()], "y int, p int, n int")
    return cells.select("y", "p", F.explode(F.sequence(F.lit(1), "n")).alias("i")).repartition(8)


def test_golden_metrics(golden):
    assert {(r.label, r.prediction): r.n for r in mt.confusion(golden, "y", "p").collect()} == GOLDEN
    assert round(mt.accuracy(golden, "y", "p").first()["accuracy"], 4) == 0.8389
    assert round(mt.auc_hard(golden, "y", "p").first()["auc_hard"], 4) == 0.8148
    rows = {r["class"]: r for r in mt.classification_report(golden, "y", "p").collect()}
    one = rows["1"]
    assert [round(one[c], 4) for c in ("precision", "recall", "f1")] == [0.8050, 0.7289, 0.7651]
    assert one["support"] == 1671 and rows["macro avg"]["support"] == 4643
    assert round(rows["accuracy"]["f1"], 4) == 0.8389


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    rows = {r["class"]: r for r in mt.classification_report(df, "y", "p").collect()}
    assert rows["a"]["precision"] == 0.0 and rows["c"]["f1"] == 0.0
    assert rows["b"]["recall"] == 1.0


def test_auc_with_one_class_is_unknown(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert mt.auc(df, "y", "s").first()["auc"] is None
    assert mt.auc_hard(df.withColumn("p", F.lit(1)), "y", "p").first()["auc_hard"] is None


@pytest.mark.parametrize("distinct", [3, 500, 10**9])
def test_auc_equals_the_evaluator(spark, distinct):
    score = F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.pmod(F.xxhash64("id"), F.lit(distinct)) / distinct)
    df = spark.range(20000).select(
        score.alias("s"), (F.pmod(F.xxhash64(F.col("id") + 7), F.lit(10)) < 3).cast("int").alias("y")
    ).withColumn("y", F.when(F.col("s") > 0.8, 1).otherwise(F.col("y")))
    want = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    found = mt.auc(df, "y", "s").first()
    assert abs(found["auc"] - want) < 1e-9
    assert found["positives"] + found["negatives"] == 20000


@pytest.mark.parametrize(("current", "latest", "wins"), [(84, 83, True), (83, 83, False), (82, 83, False)])
def test_challenger_must_be_strictly_better(spark, current, latest, wins):
    df = spark.range(100).select(
        (F.col("id") % 2).alias("y"),
        F.when(F.col("id") < current, F.col("id") % 2).otherwise(1 - F.col("id") % 2).alias("a"),
        F.when(F.col("id") < latest, F.col("id") % 2).otherwise(1 - F.col("id") % 2).alias("b"),
    )
    verdict = mt.champion_challenger(df, "y", "a", "b")
    assert verdict.challenger_wins is wins
    assert round(verdict.improvement, 6) == (1.0 if wins else 0.0)


def test_challenger_needs_more_than_rounding(spark):
    df = spark.range(1000).select(
        F.lit(1).alias("y"), (F.col("id") < 834).cast("int").alias("a"), (F.col("id") < 831).cast("int").alias("b")
    )
    assert not mt.champion_challenger(df, "y", "a", "b").challenger_wins


def test_exact_quantiles_on_skewed_groups(spark):
    rng = np.random.default_rng(3)
    groups = {
        "normal": rng.normal(size=20000), "hot": np.concatenate([np.full(9000, 1.5), rng.exponential(size=11000)]),
        "one": np.array([4.0]), "two": np.array([1.0, 2.0]), "constant": np.full(500, -3.0),
        "wide": np.array([-1e300, 0.0, 1e300] * 40),
    }
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("normal", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(8)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    found = {r.g: r for r in exact_quantiles(df, ["g"], "x", probabilities, accuracy=200).collect()}
    assert set(found) == set(groups)
    for g, xs in groups.items():
        assert found[g].n == len(xs)
        np.testing.assert_allclose(found[g].quantiles, np.quantile(xs, probabilities), rtol=1e-12, atol=1e-12)


def test_quantiles_without_groups(spark):
    found = exact_quantiles(spark.range(101), [], "id", [0.5, 0.25]).first()
    assert list(found.quantiles) == [50.0, 25.0]


def test_ks_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    p, q = rng.normal(size=3000), np.concatenate([np.zeros(1500), rng.normal(0.3, size=2500)])
    frame = lambda xs: spark.createDataFrame([(float(x),) for x in xs], "x double")
    grid = np.sort(np.concatenate([p, q]))
    want = np.abs(
        np.searchsorted(np.sort(p), grid, "right") / len(p) - np.searchsorted(np.sort(q), grid, "right") / len(q)
    ).max()
    assert abs(dr.ks_distance(frame(p), frame(q), ["x"]).first()["ks"] - want) < 1e-12


def test_no_drift_against_itself(spark):
    df = spark.range(2000).select((F.col("id") % 37).alias("x"), (F.col("id") % 5).cast("string").alias("c"))
    found = dr.numeric_drift(df, df, ["x"]).first()
    assert found["ks"] == 0.0 and abs(found["psi"]) < 1e-12
    found = dr.categorical_drift(df, df, ["c"]).first()
    assert (found["chi_square"], found["total_variation"], found["js_distance"]) == (0.0, 0.0, 0.0)


def test_disjoint_categories(spark):
    a = spark.createDataFrame([("x",)] * 4, "c string")
    b = spark.createDataFrame([("y",)] * 4, "c string")
    found = dr.categorical_drift(a, b, ["c"]).first()
    assert found["total_variation"] == 1.0 and found["js_distance"] == 1.0 and found["chi_square"] == 8.0


def test_alert_looks_at_the_latest_window(spark):
    rows = [("2024-01-01 00:10:00", 1, 0), ("2024-01-01 00:40:00", 1, 1), ("2024-01-01 00:50:00", 1, 0)]
    df = spark.createDataFrame(rows, "ts string, y int, p int").withColumn("ts", F.to_timestamp("ts"))
    quality = pr.quality_profile(df, "ts", "y", "p")
    assert [r.accuracy_score for r in pr.alert(quality).collect()] == [0.5]
    assert pr.alert(quality, threshold=0.5).isEmpty()
    changed = pr.metric_change(quality, "accuracy_score").orderBy("window").collect()
    assert [r.change for r in changed] == [None, 0.5]


def test_approximate_profile_is_near(spark):
    df = spark.range(5000).select(F.lit("2024-01-01").cast("timestamp").alias("ts"), F.col("id").alias("x"))
    near = pr.column_profile(df, "ts", ["x"], approx=True).first()
    exact = pr.column_profile(df, "ts", ["x"]).first()
    assert near["mean"] == exact["mean"] and exact["distinct"] == 5000 and exact["median"] == 2499.5
    assert abs(near["distinct"] - 5000) < 500 and abs(near["median"] - 2499.5) < 5


def test_stability_index_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    p, q = rng.normal(size=4000), np.concatenate([np.full(1500, 0.25), rng.normal(0.5, size=3000)])
    frame = lambda xs: spark.createDataFrame([(float(x), None) for x in xs], "x double, y double")
    edges = np.quantile(p, np.arange(1, 10) / 10)
    a, b = (np.bincount(np.searchsorted(edges, xs), minlength=10) / len(xs) for xs in (p, q))
    a, b = np.maximum(a, 1e-6), np.maximum(b, 1e-6)
    found = {r["column"]: r["psi"] for r in dr.stability_index(frame(p), frame(q), ["x", "y"]).collect()}
    assert set(found) == {"x"} and abs(found["x"] - ((b - a) * np.log(b / a)).sum()) < 1e-9
    assert dr.stability_index(frame(p), frame(q), ["y"]).isEmpty()


def test_profile_tells_large_integers_apart(spark):
    df = spark.range(1000).selectExpr("timestamp'2024-01-01 00:00:00' AS ts", "9007199254740992 + id AS big", "CASE WHEN id % 2 = 0 THEN 0.0D ELSE -0.0D END AS zero")
    found = {r["column"]: r for r in pr.column_profile(df, "ts", ["big", "zero"]).collect()}
    assert found["big"]["distinct"] == 1000 and found["zero"]["distinct"] == 1
    rough = {r["column"]: r for r in pr.column_profile(df, "ts", ["big", "zero"], approx=True).collect()}
    assert abs(rough["big"]["distinct"] - 1000) < 100
