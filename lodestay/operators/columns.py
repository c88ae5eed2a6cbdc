"""Projection, renaming, typing and currency conversion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import RuleError, require_columns
from ..functions.text import parse_value
from ..rules import City, CurrencyRule
from .lookup import lookup_join, pin


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep ``columns`` in the given order."""
    require_columns(df, columns, "select_columns")
    return df.select(*columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; positions stay. An unknown old name fails before anything changes."""
    require_columns(df, mapping, "rename_columns")
    return df.withColumnsRenamed(dict(mapping))


def set_types(df: DataFrame, types: Mapping[str, str], lenient: bool = False) -> DataFrame:
    """Convert the listed columns. Text is trimmed and freed of ``$`` and ``,``; blank text becomes null.

    Text that is no number, or a fraction where a whole number is wanted, fails the job with the value in the
    message; ``lenient`` gives null instead.
    """
    require_columns(df, types, "set_types")
    converted = {}
    for column, type_name in types.items():
        if isinstance(df.schema[column].dataType, T.StringType):
            converted[column] = parse_value(F.col(column), type_name, lenient)
        else:
            converted[column] = _whole(df, column, type_name, lenient)
    return df.withColumns(converted)


def _whole(df: DataFrame, column: str, type_name: str, lenient: bool) -> Column:
    """A cast that does not cut off decimals."""
    value = F.col(column)
    fractional = isinstance(df.schema[column].dataType, T.FractionalType)
    if not fractional or type_name.lower() not in ("tinyint", "smallint", "int", "integer", "bigint", "long"):
        return value.cast(type_name)
    cut = F.lit(None) if lenient else F.raise_error(
        F.concat(F.lit(f"set_types: {column} is not a whole number: "), value.cast("string")))
    return F.when(value.isNull() | (value == F.floor(value)), value.cast(type_name)).otherwise(cut.cast(type_name))


def rate_of(rule: CurrencyRule, currency: str) -> float:
    if currency not in rule.exchange_rates:
        raise RuleError(f"convert_currency: unknown currency: {currency}")
    rate = rule.exchange_rates[currency]
    if not rate > 0:
        raise RuleError(f"convert_currency: exchange rate for {currency} must be positive, got {rate}")
    return float(rate)


def convert_currency(df: DataFrame, rule: CurrencyRule, currency: str | None = None, *,
                     cities: Mapping[str, City] | None = None, city_column: str = "city") -> DataFrame:
    """Multiply the amounts by a rate: one ``currency`` for the table, or each row's city decides.

    With ``cities`` every known city must have a positive rate (checked here, before the plan runs). A row
    of a city that is not in ``cities`` has no rate and fails the job.
    """
    require_columns(df, rule.columns, "convert_currency")
    if currency is not None:
        rate = F.lit(rate_of(rule, currency))
        return df.withColumns({c: F.col(c) * rate for c in rule.columns})
    if cities is None:
        raise RuleError("convert_currency: give a currency or the cities")
    require_columns(df, [city_column], "convert_currency")
    rates = df.sparkSession.createDataFrame(
        [(name, rate_of(rule, c.currency)) for name, c in cities.items()], f"{city_column} string, __rate double")
    joined = lookup_join(df, pin(rates, "rates"), [city_column])
    # the rate feeds the amounts, so the check cannot be pruned away before them
    rate = F.coalesce(F.col("__rate"), F.raise_error(
        F.concat(F.lit("convert_currency: no currency for city "), F.coalesce(F.col(city_column), F.lit("null")))
    ).cast("double"))
    return joined.withColumns({c: F.col(c) * rate for c in rule.columns}).drop("__rate")


def label_terms(df: DataFrame, column: str, labels: Mapping[str, str], target: str = "label",
                required: bool = False) -> DataFrame:
    """Readable text for a name column. An unlabelled name keeps its name, or fails if ``required``."""
    require_columns(df, [column], "label_terms")
    table = df.sparkSession.createDataFrame(list(labels.items()), f"{column} string, __label string")
    joined = lookup_join(df, pin(table, "labels"), [column])
    fallback = F.col(column)
    if required:
        fallback = F.raise_error(F.concat(F.lit("label_terms: no label for "), F.col(column))).cast("string")
    return joined.withColumn(target, F.coalesce(F.col("__label"), fallback)).drop("__label")
