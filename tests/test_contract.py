import textwrap

import pytest
from pyspark.sql import types as T

from tabwright.contract import (
    Contract,
    ContractViolation,
    check_present_after,
    check_required,
    check_signature,
    check_types,
    load_contract,
    signature,
)
from tabwright.operators.transform import cast, rename, rename_back, reorder, split_xy

SMALL = textwrap.dedent(
    """
    dev: {catalog_name: c_dev, schema_name: s, pipeline_id: p1}
    acc: {catalog_name: c_acc, schema_name: s, pipeline_id: p2}
    prd: {catalog_name: c_prd, schema_name: s, pipeline_id: p3}
    experiment_name: e
    model: {name: m, artifact_path: a}
    parameters: {learning_rate: 0.01, n_estimators: 1000}
    num_features:
      - {name: ID, dtype: int64, alias: Id}
      - {name: CREDIT_MAX, dtype: float64, alias: Credit_max}
    target: {name: next.bill.unpaid, dtype: int64, alias: Unpaid}
    features: {numerical: [Id, Credit_max], categorical: []}
    something_else: 1
    """
)


@pytest.fixture
def small(tmp_path) -> str:
    path = tmp_path / "contract.yml"
    path.write_text(SMALL)
    return str(path)


def test_environments_and_unknown_keys(small):
    for env, catalog in (("dev", "c_dev"), ("acc", "c_acc"), ("prd", "c_prd")):
        contract = load_contract(small, env)
        assert contract.catalog_name == catalog
        assert contract.table("t") == f"{catalog}.s.t"
    assert load_contract(small).categorical == ()
    assert load_contract(small).parameters["n_estimators"] == 1000


def test_load_errors(small, tmp_path):
    with pytest.raises(KeyError):
        load_contract(small, "nowhere")
    with pytest.raises(FileNotFoundError):
        load_contract(str(tmp_path / "none.yml"))
    for old, new in (("dtype: float64", "dtype: object"), ("name: ID, ", ""), ("experiment_name: e", "")):
        broken = tmp_path / "broken.yml"
        broken.write_text(SMALL.replace(old, new))
        with pytest.raises(ContractViolation):
            load_contract(str(broken))


def test_shipped_contract():
    contract: Contract = load_contract("tabwright/contracts/bookings.yml")
    assert len(contract.columns) == 19
    assert len(contract.numeric_features) == 11 and len(contract.categorical_features) == 2
    assert contract.schema()["lead_time"].dataType == T.ShortType()
    assert contract.schema(["x", "lead_time"], typed=False).names == ["x", "lead_time"]


def test_names_with_dots(spark, small):
    contract = load_contract(small)
    df = spark.createDataFrame([(1, 2.5, 1)], "ID long, CREDIT_MAX double, `next.bill.unpaid` long")
    renamed = rename(check_required(df, contract), contract)
    assert renamed.columns == ["Id", "Credit_max", "Unpaid"]
    assert reorder(rename_back(renamed, contract), df.columns).collect() == df.collect()
    assert check_types(cast(renamed, contract), contract).first()["Unpaid"] == 1
    x, y = split_xy(renamed, "Unpaid")
    assert x.columns == ["Id", "Credit_max"] and y.columns == ["Unpaid"]


def test_violations_name_the_columns(spark, small):
    contract = load_contract(small)
    with pytest.raises(ContractViolation, match="CREDIT_MAX"):
        check_required(spark.createDataFrame([(1, 1)], "ID long, `next.bill.unpaid` long"), contract)
    with pytest.raises(ContractViolation, match="target.*Unpaid"):
        check_present_after(spark.createDataFrame([(1, 2.0)], "Id long, Credit_max double"), contract)
    with pytest.raises(ContractViolation, match="Credit_max: declared float64"):
        check_types(spark.createDataFrame([(1, "a", 1)], "Id long, Credit_max string, Unpaid long"), contract)


def test_signature(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    stored = signature(df.schema, T.StructType([T.StructField("prediction", T.IntegerType())]))
    assert check_signature(df.withColumn("z", df.x), stored) is not None
    with pytest.raises(ContractViolation, match="x"):
        check_signature(df.withColumn("x", df.x.cast("string")), stored)
