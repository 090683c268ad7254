"""Queries of encoding, training and scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import query
from registry.tables import fresh_name, hash_sql, table
from tabwright.operators import model as md
from tabwright.operators.features import Lookup
from tabwright.operators.metrics import classification_report
from tabwright.operators.split import hash_split
from tabwright.session import work_dir

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PARAMETERS = {"learning_rate": 0.3, "n_estimators": 3, "num_leaves": 8}


@query(
    "ml1_one_hot",
    "SELECT o_orderkey, "
    + ", ".join(f"""CAST(o_orderpriority = '{p}' AS INTEGER) AS "o_orderpriority_{p}" """ for p in PRIORITIES)
    + ", "
    + ", ".join(f"CAST(o_orderstatus = '{s}' AS INTEGER) AS o_orderstatus_{s}" for s in ("F", "O"))
    + " FROM orders",
)
def ml1_one_hot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    known = orders.where("o_orderstatus <> 'P'")  # P is unknown when encoding
    return md.one_hot(orders, ["o_orderpriority", "o_orderstatus"], fit_on=known).drop("o_orderpriority", "o_orderstatus")


@query(
    "ml2_assemble",
    f"""SELECT o_orderkey, {', '.join(f"CAST(o_orderpriority = '{p}' AS DOUBLE) AS f{i}" for i, p in enumerate(PRIORITIES))},
               o_totalprice AS f5 FROM orders""",
)
def ml2_assemble(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    assembled = md.assemble(orders, ["o_totalprice"], ["o_orderpriority"])
    vector = vector_to_array(F.col(md.FEATURES))
    return assembled.select("o_orderkey", *[vector[i].alias(f"f{i}") for i in range(len(PRIORITIES) + 1)])


def _labelled(spark, sf_dir):
    """Orders whose label depends on price and priority, with every ninth flipped."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        "o_totalprice",
        "CAST((o_totalprice > 250000 OR o_orderpriority = '1-URGENT') <> (o_orderkey % 9 = 0) AS INT) AS label",
    )


def _model(spark, sf_dir):
    train, test = hash_split(_labelled(spark, sf_dir), ["o_orderkey"])
    return md.train(train, "label", ["o_totalprice"], ["o_orderpriority"], PARAMETERS), test


LABEL_SQL = "CAST((o_totalprice > 250000 OR o_orderpriority = '1-URGENT') <> (o_orderkey % 9 = 0) AS INTEGER)"
TEST_SQL = f"SELECT o_orderkey, {LABEL_SQL} AS label FROM orders WHERE {hash_sql('o_orderkey')} < {int(0.2 * (1 << 60))}"


def above_majority(scored, label="label", prediction="prediction"):
    """Whether the predictions are right more often than the more frequent label alone would be."""
    hits = F.count_if(F.col(label) == F.col(prediction))
    return scored.agg(hits > F.greatest(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0))).first()[0]


@query(
    "ml3_train",
    f"""SELECT CAST(label AS VARCHAR) AS class, count(*) AS support, true AS above_majority FROM ({TEST_SQL}) GROUP BY label
        UNION ALL SELECT class, (SELECT count(*) FROM ({TEST_SQL})), true FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) t(class)""",
)
def ml3_train(spark, sf_dir):
    fitted, test = _model(spark, sf_dir)
    scored = md.score(fitted, test)
    report = classification_report(scored, "label", "prediction").select("class", F.col("support").cast("long").alias("support"))
    return report.withColumn("above_majority", F.lit(above_majority(scored)))


@query("ml4_score", f"SELECT o_orderkey, label, true AS is_class FROM ({TEST_SQL})")
def ml4_score(spark, sf_dir):
    fitted, test = _model(spark, sf_dir)
    path = work_dir(spark, "model")
    md.save_model(fitted, path, test.schema, md.score(fitted, test).select("prediction").schema)
    return md.score_checked(path, test).select("o_orderkey", "label", F.col("prediction").isin(0, 1).alias("is_class"))


def _looked_up(spark, sf_dir, known):
    """Every order scored with features of the customers that ``known`` keeps."""
    orders = _labelled(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey").where(known)
    lookup = Lookup(customers, ("o_custkey",), ("c_acctbal", "c_mktsegment"), unique=True)
    fitted = md.train(
        md.training_set(orders, "label", [lookup]), "label", ["o_totalprice", "c_acctbal"], ["c_mktsegment"], PARAMETERS
    )
    asked = orders.select("o_orderkey", "o_custkey", "o_totalprice", "label")
    return md.score_with_lookup(fitted, asked, "label", [lookup]).select(
        "o_orderkey", "label", F.col("prediction").isin(0, 1).alias("is_class")
    )


SCORED_SQL = f"SELECT o_orderkey, {LABEL_SQL} AS label, true AS is_class FROM orders"


@query("ml5_score_with_lookup", SCORED_SQL)
def ml5_score_with_lookup(spark, sf_dir):
    return _looked_up(spark, sf_dir, "true")


@query("ml5_missing_keys", SCORED_SQL)
def ml5_missing_keys(spark, sf_dir):
    """A seventh of the customers is not among the features, neither in training nor in scoring."""
    return _looked_up(spark, sf_dir, "o_custkey % 7 <> 0")


class PriceRule:
    """A model from outside Spark: anything with ``predict``."""

    def predict(self, frame):
        return ((frame["o_totalprice"] > 250000) & (frame["o_orderpriority"] != "5-LOW")).astype("int64")


RULE_SQL = "CASE WHEN o_totalprice > 250000 AND o_orderpriority <> '5-LOW' THEN 1 ELSE 0 END"


@query("ml7_wrap_model", f"SELECT o_orderkey, o_totalprice, o_orderpriority, CAST({RULE_SQL} AS BIGINT) AS prediction FROM orders")
def ml7_wrap_model(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return md.wrap_model(orders, PriceRule(), ["o_totalprice", "o_orderpriority"])


@query(
    "ml7_wrap_model_wide",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN 9007199254740993 + o_orderkey END AS big, CAST(o_orderdate AS VARCHAR) AS day,
               [o_orderkey, o_custkey] AS pair, CAST({RULE_SQL} AS BIGINT) AS prediction FROM orders""",
)
def ml7_wrap_model_wide(spark, sf_dir):
    """Columns that the model does not use come through unchanged: nullable large integers, timestamps, arrays."""
    big = "CASE WHEN o_orderkey % 5 > 0 THEN 9007199254740993 + o_orderkey END AS big"
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", big, "o_orderdate", "array(o_orderkey, o_custkey) AS pair", "o_totalprice", "o_orderpriority"
    )
    scored = md.wrap_model(orders, PriceRule(), ["o_totalprice", "o_orderpriority"])
    return scored.select("o_orderkey", "big", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("day"), "pair", "prediction")


@query(
    "ml8_score_to_table",
    f"SELECT o_orderkey, o_custkey, CAST({RULE_SQL} AS INTEGER) AS Predicted_Default FROM orders",
)
def ml8_score_to_table(spark, sf_dir):
    train, test = hash_split(table(spark, sf_dir, "orders"), ["o_orderkey"])
    rule = lambda df: df.withColumn("prediction", F.expr(RULE_SQL).cast(T.IntegerType()))
    name = fresh_name("scored")
    md.score_to_table([train, test], rule, name, "o_orderkey", ["o_custkey"], path=work_dir(spark, "scored"))
    return spark.table(name)
