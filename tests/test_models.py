import pytest
from pyspark.sql import functions as F

from registry.models import PARAMETERS, PriceRule, _labelled
from registry.tables import fresh_name
from tabwright.contract import ContractViolation
from tabwright.operators import model as md
from tabwright.operators.features import Lookup
from tabwright.operators.metrics import auc
from tabwright.operators.split import hash_split
from tabwright.plans.training import train_and_compare
from tabwright.session import work_dir


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return _labelled(spark, sf_dir)


@pytest.fixture(scope="module")
def fitted(rows):
    return md.train(rows, "label", ["o_totalprice"], ["o_orderpriority"], PARAMETERS)


def test_settings():
    assert md.tree_settings({"learning_rate": 0.02, "n_estimators": 500, "num_leaves": 17}) == {
        "stepSize": 0.02, "maxIter": 500, "maxDepth": 5,
    }


def test_unknown_category_is_all_zero(spark):
    known = spark.createDataFrame([("b",), ("a",)], "c string")
    asked = spark.createDataFrame([("a",), ("z",)], "c string")
    coded = md.one_hot(asked, ["c"], fit_on=known)
    assert coded.columns == ["c", "c_a", "c_b"]
    assert sorted(tuple(r) for r in coded.collect()) == [("a", 1, 0), ("z", 0, 0)]


def test_scores_beat_chance(rows, fitted):
    scored = md.score(fitted, rows, probability="p")
    assert scored.columns == [*rows.columns, "prediction", "p"]
    assert auc(scored, "label", "p").first()["auc"] > 0.8
    assert scored.where((F.col("prediction") == 1) != (F.col("p") > 0.5)).isEmpty()


def test_saved_model_checks_its_input(spark, rows, fitted):
    path = work_dir(spark, "model")
    outputs = md.score(fitted, rows).select("prediction").schema
    inputs = rows.select("o_totalprice", "o_orderpriority").schema
    md.save_model(fitted, path, inputs, outputs)
    again = md.score_checked(path, rows)
    assert again.exceptAll(md.score(fitted, rows)).isEmpty()
    with pytest.raises(ContractViolation, match="o_totalprice"):
        md.score_checked(path, rows.drop("o_totalprice"))


def test_python_model(rows):
    scored = md.wrap_model(rows, PriceRule(), ["o_totalprice", "o_orderpriority"])
    assert scored.count() == rows.count()
    assert scored.where("(prediction = 1) <> (o_totalprice > 250000 AND o_orderpriority <> '5-LOW')").isEmpty()
    assert rows.columns[-1] == "label"


def test_score_to_table_refuses_repeated_keys(rows):
    rule = lambda df: df.withColumn("prediction", F.lit(1))
    with pytest.raises(ContractViolation):
        md.score_to_table([rows, rows], rule, fresh_name("twice"), "o_orderkey", [])


def test_training_replaces_a_worse_model(spark, rows):
    train, test = hash_split(rows, ["o_orderkey"])
    prices = rows.select("o_orderkey", "o_totalprice")
    result = train_and_compare(
        train.drop("o_totalprice"), test.drop("o_totalprice"), "label", ["o_totalprice"], ["o_orderpriority"], "o_orderkey",
        [Lookup(prices, ("o_orderkey",), ("o_totalprice",), unique=True)], {}, PARAMETERS,
        latest=lambda df: df.withColumn("prediction", F.lit(0)),
    )
    assert result.comparison.challenger_wins
    assert result.accuracy.first()["n"] == test.count()


def test_model_class_from_the_main_script(rows):
    """A class that workers cannot import travels with the function."""
    scope = {"__name__": "__main__"}
    exec("class Above:\n    def predict(self, frame):\n        return (frame['o_totalprice'] > 9).astype('int64')", scope)
    assert md.wrap_model(rows, scope["Above"](), ["o_totalprice"]).where("prediction <> CAST(o_totalprice > 9 AS INT)").isEmpty()


def test_scoring_with_missing_numbers(spark, rows):
    gaps = rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_totalprice")))
    fitted = md.train(gaps, "label", ["o_totalprice"], ["o_orderpriority"], PARAMETERS)
    assert md.score(fitted, gaps).where("prediction IS NULL").isEmpty()
    assert md.score(fitted, rows.withColumn("o_totalprice", F.lit(None).cast("double"))).count() == rows.count()
