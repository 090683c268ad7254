"""Spark-native building blocks for the data work around tabular models.

Everything is a function from DataFrame to DataFrame; rows stay on the
executors from source to sink.
"""

from tabwright.contract import Column, Contract, ContractViolation, load_contract
from tabwright.session import get_session, materialize, work_dir

__version__ = "0.1.0"

__all__ = [
    "Column",
    "Contract",
    "ContractViolation",
    "get_session",
    "load_contract",
    "materialize",
    "work_dir",
]
