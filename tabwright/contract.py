"""Declared table contracts: names, aliases, types and roles of columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

try:  # only needed to read contracts from files
    import yaml
except ImportError:  # pragma: no cover
    yaml = None

# Type names of the contract format and the Spark types they mean.
SPARK_TYPES: dict[str, T.DataType] = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float64": T.DoubleType(),
    "object": T.StringType(),
    "category": T.StringType(),
}
# Type names each role may use.
ROLE_TYPES: dict[str, frozenset[str]] = {
    "numeric": frozenset({"float64", "int64", "int32", "int16", "int8"}),
    "categorical": frozenset({"object", "category"}),
    "target": frozenset({"float64", "int64", "int32", "object", "category"}),
}


class ContractViolation(ValueError):
    """A table or a contract file does not meet what was declared."""


@dataclass(frozen=True)
class Column:
    """One declared column."""

    name: str
    dtype: str
    alias: str
    role: str = "numeric"

    def __post_init__(self) -> None:
        if self.role not in ROLE_TYPES:
            raise ContractViolation(f"{self.name}: unknown role {self.role!r}")
        if self.dtype not in ROLE_TYPES[self.role]:
            raise ContractViolation(
                f"{self.name}: {self.dtype!r} is not a {self.role} type, use one of {sorted(ROLE_TYPES[self.role])}"
            )

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.dtype]

    def accepts(self, actual: T.DataType) -> bool:
        """Whether a Spark type fits; a category may be text or an integer code."""
        if self.dtype == "category":
            return isinstance(actual, (T.StringType, T.IntegerType))
        return actual == self.spark_type


@dataclass(frozen=True)
class Contract:
    """Columns of a table plus the settings of one environment."""

    numeric: tuple[Column, ...]
    categorical: tuple[Column, ...]
    target: Column
    numeric_features: tuple[str, ...] = ()
    categorical_features: tuple[str, ...] = ()
    parameters: Mapping[str, Any] = field(default_factory=dict)
    catalog_name: str = ""
    schema_name: str = ""
    pipeline_id: str | None = None
    experiment_name: str = ""
    model_name: str = ""
    model_path: str = ""

    @property
    def columns(self) -> tuple[Column, ...]:
        return (*self.numeric, *self.categorical, self.target)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def aliases(self) -> list[str]:
        return [c.alias for c in self.columns]

    @property
    def features(self) -> list[str]:
        return [*self.numeric_features, *self.categorical_features]

    def schema(self, order: Iterable[str] | None = None, typed: bool = True) -> T.StructType:
        """Read schema by source name, in ``order`` (for files) or declared order.

        Columns of ``order`` outside the contract are read as text.
        """
        declared = {c.name: c.spark_type for c in self.columns}
        order = list(declared) if order is None else list(order)
        text = T.StringType()
        return T.StructType([T.StructField(n, declared.get(n, text) if typed else text, True) for n in order])

    def table(self, name: str) -> str:
        """Qualified table name in this environment."""
        return ".".join(part for part in (self.catalog_name, self.schema_name, name) if part)


def load_contract(path: str, env: str = "dev") -> Contract:
    """Read a contract file and merge the block of one environment.

    Unknown top-level keys are ignored; a missing environment is a KeyError,
    a missing file a FileNotFoundError.
    """
    if yaml is None:  # pragma: no cover
        raise RuntimeError("reading contract files needs a YAML reader; use parse_contract with a dict instead")
    with open(path, encoding="utf-8") as handle:
        return parse_contract(yaml.safe_load(handle), env)


def parse_contract(raw: Mapping[str, Any], env: str = "dev") -> Contract:
    """Contract from the parsed content of a contract file."""
    settings = raw[env]

    def columns(key: str, role: str) -> tuple[Column, ...]:
        return tuple(_column(entry, role) for entry in raw.get(key) or ())

    for key in ("experiment_name", "parameters", "num_features", "target", "features", "model"):
        if key not in raw:
            raise ContractViolation(f"contract lacks {key!r}")
    return Contract(
        numeric=columns("num_features", "numeric"),
        categorical=columns("cat_features", "categorical"),
        target=_column(raw["target"], "target"),
        numeric_features=tuple(raw["features"]["numerical"]),
        categorical_features=tuple(raw["features"]["categorical"]),
        parameters=dict(raw["parameters"]),
        catalog_name=settings["catalog_name"],
        schema_name=settings["schema_name"],
        pipeline_id=settings["pipeline_id"],
        experiment_name=raw["experiment_name"],
        model_name=raw["model"]["name"],
        model_path=raw["model"]["artifact_path"],
    )


def _column(entry: Mapping[str, Any], role: str) -> Column:
    lacking = {"name", "dtype", "alias"} - set(entry)
    if lacking:
        raise ContractViolation(f"column entry {dict(entry)} lacks {sorted(lacking)}")
    return Column(str(entry["name"]), str(entry["dtype"]), str(entry["alias"]), role)


# --- checks on names and types: metadata only, no data pass -----------------


def column_difference(wanted: Iterable[str], present: Iterable[str]) -> list[str]:
    """Wanted names that are not present, in the order they were asked for."""
    have = set(present)
    return [name for name in wanted if name not in have]


def check_required(df: DataFrame, contract: Contract) -> DataFrame:
    """Every source column exists."""
    missing = column_difference(contract.names, df.columns)
    if missing:
        raise ContractViolation(f"the data lacks {missing}")
    return df


def check_present_after(df: DataFrame, contract: Contract) -> DataFrame:
    """Every alias exists once cleaning is done; the message names the role."""
    for role, columns in (
        ("numeric", contract.numeric),
        ("categorical", contract.categorical),
        ("target", (contract.target,)),
    ):
        missing = column_difference([c.alias for c in columns], df.columns)
        if missing:
            raise ContractViolation(f"preparation left no {role} column named {missing}")
    return df


def check_types(df: DataFrame, contract: Contract) -> DataFrame:
    """Every aliased column has its declared type."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{c.alias}: declared {c.dtype}, found {actual[c.alias].simpleString()}"
        for c in contract.columns
        if not c.accepts(actual[c.alias])
    ]
    if wrong:
        raise ContractViolation("; ".join(wrong))
    return df


def signature(inputs: T.StructType, outputs: T.StructType) -> dict[str, Any]:
    """Input and output schema of a model, as plain JSON data to store beside it."""
    return {"inputs": inputs.jsonValue(), "outputs": outputs.jsonValue()}


def check_signature(df: DataFrame, stored: Mapping[str, Any]) -> DataFrame:
    """The frame offers every stored input column with the stored type."""
    wanted = T.StructType.fromJson(dict(stored["inputs"]))
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in wanted.fields if actual.get(f.name) != f.dataType]
    if wrong:
        raise ContractViolation(f"frame does not fit the model signature in {wrong}")
    return df
