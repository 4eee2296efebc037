"""sparkrecon: quality checks, ledger reconciliation and governance tables on Spark DataFrames."""

from .params import DEFAULT_RULES, Rules
from .schemas import SOURCE_SCHEMA, TARGET_SCHEMA

__all__ = ["DEFAULT_RULES", "Rules", "SOURCE_SCHEMA", "TARGET_SCHEMA"]
