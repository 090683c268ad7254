"""CSV and Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.contract import Contract, ContractViolation

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, contract: Contract | None = None, typed: bool = True) -> DataFrame:
    """Read CSV files with a header, without an inference pass over the data.

    Names and their order come from the header, types from the contract. A file whose
    header names other columns, or the same in another order, fails the job.
    Records that do not fit are kept, with their text in ``_corrupt_record``.
    With ``typed=False`` all columns are text, ready for ``cast`` to count what
    a conversion loses. A missing path and a file without rows are errors.
    """
    names = spark.read.option("header", True).csv(path).columns
    if not names:
        raise ContractViolation(f"no data in {path}")
    if contract is None or not typed:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    else:
        schema = contract.schema(names)
    frame = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    if frame.select(F.col(f"`{names[0]}`")).isEmpty():
        raise ContractViolation(f"no rows in {path}")
    return frame


def well_formed(frame: DataFrame) -> DataFrame:
    """The records that fitted the read schema."""
    return frame.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files with a header, written by the executors."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, or Parquet files when ``name`` is a path; optionally a projection."""
    frame = spark.read.parquet(name) if "/" in name else spark.table(name)
    return frame.select(*columns) if columns else frame
