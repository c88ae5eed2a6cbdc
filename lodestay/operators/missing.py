"""Ordered missing-value rules."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import RuleError, require_columns
from ..functions.text import parse_bathrooms
from ..rules import (DROP_ROW, ENTIRE_HOME, FILL_FROM_TEXT, FILL_ZERO, IMPUTE_MEDIAN, IMPUTE_OR_DROP, MissingRule)
from .lookup import lookup_join, pin
from .quantiles import group_quantiles

ACTIONS = (DROP_ROW, FILL_ZERO, IMPUTE_MEDIAN, IMPUTE_OR_DROP, FILL_FROM_TEXT)


def missing_drop(df: DataFrame, column: str) -> DataFrame:
    require_columns(df, [column], "missing_drop")
    return df.dropna(subset=[column])


def missing_fill_zero(df: DataFrame, column: str) -> DataFrame:
    require_columns(df, [column], "missing_fill_zero")
    kind = df.schema[column].dataType
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(0).cast(kind)))


def impute_group_median(df: DataFrame, columns: Sequence[str], group_by: str, by: Sequence[str] = (),
                        source: DataFrame | None = None) -> DataFrame:
    """Missing -> median of the known values of the same group; a missing group value is its own group.

    All ``columns`` share one statistics pass. ``source`` gives other rows to learn the medians from.
    """
    columns = list(columns)
    require_columns(df, [*columns, group_by, *by], "impute_group_median")
    keys = [*by, group_by]
    medians = group_quantiles(source if source is not None else df,
                              {f"__median_{c}": (c, 0.5) for c in columns}, keys)
    joined = lookup_join(df, pin(medians, "medians"), keys, null_safe=True)
    return joined.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"__median_{c}")) for c in columns}
                              ).select(*df.columns)


def impute_or_drop_label(df: DataFrame, columns: Sequence[str], group_by: str, label: str = ENTIRE_HOME,
                         by: Sequence[str] = ()) -> DataFrame:
    """Drop missing rows of one group label, impute the other groups with their median.

    Rows of the label either have a value or are dropped, so their medians are never needed and several
    columns can share one pass over the other groups without changing a result.
    """
    require_columns(df, [*columns, group_by, *by], "impute_or_drop_label")
    labelled = F.col(group_by).eqNullSafe(F.lit(label))
    kept = df
    for c in columns:
        kept = kept.filter(~(F.col(c).isNull() & labelled))
    return impute_group_median(kept, columns, group_by, by, source=kept.filter(~labelled))


def fill_from_text(df: DataFrame, column: str, text_column: str) -> DataFrame:
    """Missing -> number parsed from the text; rows without one are dropped."""
    require_columns(df, [column, text_column], "fill_from_text")
    filled = F.coalesce(F.col(column).cast("double"), parse_bathrooms(F.col(text_column)))
    return df.withColumn(column, filled).dropna(subset=[column])


def missing_rules(df: DataFrame, rules: Sequence[MissingRule], *, group_by: str = "room_type",
                  label: str = ENTIRE_HOME, text_column: str = "bathrooms_text", by: Sequence[str] = ()) -> DataFrame:
    """Apply the rules from first to last; each sees the result of the earlier ones."""
    for rule in rules:
        if rule.action not in ACTIONS:
            raise RuleError(f"unknown missing value rule {rule.action} for column {rule.column}")
    require_columns(df, [r.column for r in rules], "missing_rules")
    # neighbouring rules of one kind are independent of each other when their columns differ
    for action, run in groupby(rules, key=lambda r: r.action):
        columns = list(dict.fromkeys(r.column for r in run))
        if action == DROP_ROW:
            df = df.dropna(subset=columns)
        elif action == FILL_ZERO:
            for c in columns:
                df = missing_fill_zero(df, c)
        elif action == IMPUTE_MEDIAN:
            df = impute_group_median(df, columns, group_by, by)
        elif action == IMPUTE_OR_DROP:
            df = impute_or_drop_label(df, columns, group_by, label, by)
        else:
            for c in columns:
                df = fill_from_text(df, c, text_column)
    return df
