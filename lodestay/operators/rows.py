"""Operators that drop rows: duplicates, zeros, implausible sizes, outliers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import RuleError, require_columns, require_rows
from ..rules import OutlierRule, PlausibilityRule
from .lookup import lookup_join, pin
from .quantiles import group_quantiles


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the first row per key in the order of ``order_by``.

    The ``row_number() = 1`` filter becomes a group limit on the map side, so at most one row per key and
    task is shuffled, however many copies one key has. Rows are sorted by their keys twice; a sort compares the
    first key by its leading bytes, so numbers stand before texts, few of which may be distinct.
    """
    require_columns(df, [*keys, *order_by], "dedupe_first")
    numbers_first = sorted(keys, key=lambda c: not isinstance(df.schema[c].dataType, T.NumericType))
    window = Window.partitionBy(*numbers_first).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def drop_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a zero in any of ``columns``; missing values stay."""
    require_columns(df, columns, "drop_zero")
    if not columns:
        return df
    zero = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) == 0, F.lit(False)) for c in columns])
    return df.filter(~zero)


def filter_plausible(df: DataFrame, rules: Sequence[PlausibilityRule], strict: bool = True,
                     keep_unknown: bool = False) -> DataFrame:
    """Keep rows that satisfy ``column <= factor * max_of + offset`` for every rule.

    A missing operand is an error. Without ``strict`` such rows are dropped, or kept for a later check with
    ``keep_unknown``.
    """
    if not rules:
        return df
    used = list(dict.fromkeys(c for r in rules for c in (r.column, r.max_of)))
    require_columns(df, used, "filter_plausible")
    require_rows(df, {f"filter_plausible: column {c} has a missing value": F.col(c).isNull() for c in used}, strict)
    kept = [F.col(r.column) <= F.lit(r.factor) * F.col(r.max_of) + F.lit(r.offset) for r in rules]
    condition = reduce(lambda a, b: a & b, kept)
    return df.filter(F.coalesce(condition, F.lit(True)) if keep_unknown else condition)


def outlier_fences(df: DataFrame, rule: OutlierRule, by: Sequence[str] = (), *, strict: bool = True,
                   approximate: bool = False) -> DataFrame:
    """Per group and column: ``lo_<column>``, ``hi_<column>`` = Q1 - m*IQR, Q3 + m*IQR on the rule's scale."""
    if rule.method != "iqr":
        raise RuleError(f"unknown outlier method {rule.method}")
    if rule.action != "drop_row":
        raise RuleError(f"unknown outlier action {rule.action}")
    if rule.scale not in ("raw", "log"):
        raise RuleError(f"unknown outlier scale {rule.scale}")
    require_columns(df, [*rule.columns, *by], "outliers")
    # ln is null for 0 and below, so one check of the value counts covers missing and undefined values
    scaled = {c: F.ln(F.col(c).cast("double")) if rule.scale == "log" else F.col(c) for c in rule.columns}
    outputs = {}
    for c in rule.columns:
        outputs[f"q1_{c}"] = (scaled[c], 0.25)
        outputs[f"q3_{c}"] = (scaled[c], 0.75)
    message = f"outliers: a column of {', '.join(rule.columns)} has a missing value"
    if rule.scale == "log":
        message += " or a value of 0 or below"
    quartiles = group_quantiles(df, outputs, by, null_message=message if strict else None, approximate=approximate)
    m = F.lit(float(rule.iqr_multiplier))
    fences = []
    for c in rule.columns:
        q1, q3 = F.col(f"q1_{c}"), F.col(f"q3_{c}")
        fences += [(q1 - m * (q3 - q1)).alias(f"lo_{c}"), (q3 + m * (q3 - q1)).alias(f"hi_{c}")]
    return quartiles.select(*by, *fences)


def drop_outliers(df: DataFrame, rule: OutlierRule, by: Sequence[str] = (), *, strict: bool = True,
                  approximate: bool = False) -> DataFrame:
    """Drop rows strictly outside the fences in any column; all fences come from the full table."""
    fences = pin(outlier_fences(df, rule, by, strict=strict, approximate=approximate), "fences")
    joined = lookup_join(df, fences, list(by), null_safe=True)

    def inside(c: str):
        value = F.ln(F.col(c).cast("double")) if rule.scale == "log" else F.col(c)
        return (value >= F.col(f"lo_{c}")) & (value <= F.col(f"hi_{c}"))

    kept = joined.filter(reduce(lambda a, b: a & b, [inside(c) for c in rule.columns]))
    return kept.select(*df.columns)
