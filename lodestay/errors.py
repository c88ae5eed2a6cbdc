"""Two error families: bad rules fail while the plan is built, bad data fails in a check job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class RuleError(ValueError):
    """A rule, column name or parameter does not fit the table."""


class DataError(ValueError):
    """A value in the table breaks what an operator needs."""


def require_columns(df: DataFrame, columns: Iterable[str], operator: str) -> None:
    """Fail at plan-build time if a column is absent; names every absent column."""
    present = set(df.columns)
    absent = [c for c in dict.fromkeys(columns) if c not in present]
    if absent:
        raise RuleError(f"{operator}: columns not found in data: {', '.join(absent)}")


def require_rows(df: DataFrame, problems: Mapping[str, Column], strict: bool = True) -> None:
    """Evaluate every data check in one aggregate and fail with the messages that apply.

    ``problems`` maps a message to the condition of a *bad* row. One scan, one result row.
    """
    if not strict or not problems:
        return
    counted = [F.count_if(bad).alias(f"p{i}") for i, bad in enumerate(problems.values())]
    row = df.agg(*counted).first()
    hit = [f"{message} ({row[i]} rows)" for i, message in enumerate(problems) if row[i]]
    if hit:
        raise DataError("; ".join(hit))
