"""Batch checks of apartments to score: allowed ranges, locations, default ratings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import RuleError, require_columns, require_rows
from ..rules import DistanceRule, InputRule, LocationRule, PlausibilityRule
from .features import distance_to_center
from .lookup import lookup_join, pin
from .quantiles import group_quantiles


def input_bounds(df: DataFrame, train: DataFrame, rules: Sequence[InputRule], plausibility: Sequence[PlausibilityRule], *,
                 by: Sequence[str] = (), room_type: str = "room_type", strict: bool = True) -> DataFrame:
    """Add ``lo_<column>`` and ``hi_<column>`` for every rule.

    A fixed limit is used as it is; an open one is the smallest or largest training value of the room type.
    Plausibility rules lower the upper limit by another column of the row. Limits of whole-number columns
    are rounded inwards. A room type without training rows, or a missing other answer, is an error.
    """
    keys = [*by, room_type]
    require_columns(df, keys, "input_bounds")
    needed = [(r, p) for r in rules for p in plausibility if p.column == r.column]
    for r, p in needed:
        if p.max_of not in df.columns:
            raise RuleError(f"answer for {p.max_of} is needed before {r.column}")
    opened = [r for r in rules if r.min is None or r.max is None]
    out = df
    problems = {f"answer for {p.max_of} is needed before {r.column}": F.col(p.max_of).isNull() for r, p in needed}
    if opened:
        require_columns(train, [*keys, *[r.column for r in opened]], "input_bounds")
        aggs = [F.count(F.lit(1)).alias("__rows")]
        for r in opened:
            aggs += [F.min(r.column).cast("double").alias(f"__min_{r.column}"),
                     F.max(r.column).cast("double").alias(f"__max_{r.column}")]
        out = lookup_join(df, pin(train.groupBy(*keys).agg(*aggs), "bounds"), keys)
        problems[f"no training listings with this {room_type}"] = F.col("__rows").isNull()
    require_rows(out, problems, strict)
    made = {}
    for r in rules:
        lo = F.col(f"__min_{r.column}") if r.min is None else F.lit(float(r.min))
        hi = F.col(f"__max_{r.column}") if r.max is None else F.lit(float(r.max))
        for p in plausibility:
            if p.column == r.column:
                limit = F.lit(p.factor) * F.col(p.max_of) + F.lit(p.offset)
                hi = F.when(hi.isNotNull() & limit.isNotNull(), F.least(hi, limit))
        made[f"lo_{r.column}"] = F.ceil(lo).cast("double") if r.whole else lo
        made[f"hi_{r.column}"] = F.floor(hi).cast("double") if r.whole else hi
    return out.withColumns(made).select(*df.columns, *made)


def validate_inputs(df: DataFrame, train: DataFrame, rules: Sequence[InputRule],
                    plausibility: Sequence[PlausibilityRule], *, key: Sequence[str] = ("id",), by: Sequence[str] = (),
                    room_type: str = "room_type", group: str | None = None, inclusive: bool = True) -> DataFrame:
    """One row per apartment and question: ``key, column, value, lo, hi, ok``.

    A value is accepted if it is a number (a whole one where the rule says so) inside the bounds. With
    ``group`` each apartment answers only the questions of its group.
    """
    require_columns(df, [*key, *[r.column for r in rules]], "validate_inputs")
    bounded = input_bounds(df, train, rules, plausibility, by=by, room_type=room_type, strict=False)
    answers = []
    for r in rules:
        text = F.trim(F.col(r.column).cast("string"))
        value = text.try_cast("double")
        whole = value.isNotNull() & ((value == F.floor(value)) if r.whole else F.lit(True))
        lo, hi = F.col(f"lo_{r.column}"), F.col(f"hi_{r.column}")
        inside = ((value >= lo) & (value <= hi)) if inclusive else ((value > lo) & (value < hi))
        asked = F.col(group).isin(list(r.groups)) if group else F.lit(True)
        answers.append(F.struct(F.lit(r.column).alias("column"), value.alias("value"), lo.alias("lo"), hi.alias("hi"),
                                F.coalesce(whole & inside, F.lit(False)).alias("ok"), asked.alias("asked")))
    long = bounded.select(*key, F.inline(F.array(*answers)))
    return long.filter("asked").drop("asked")


def validate_location(df: DataFrame, train: DataFrame, distance: DistanceRule, rule: LocationRule, *,
                      center: tuple[float, float] | None = None, cities=None, city_column: str = "city",
                      by: Sequence[str] = ()) -> DataFrame:
    """Add ``location_ok``: inside the training extremes plus margin, and not farther out than any listing plus margin."""
    require_columns(df, [distance.latitude, distance.longitude, *by], "validate_location")
    require_columns(train, [distance.latitude, distance.longitude, distance.target, *by], "validate_location")
    lat, lon = F.col(distance.latitude), F.col(distance.longitude)
    extent = train.groupBy(*by).agg(
        F.min(lat).alias("__lat_lo"), F.max(lat).alias("__lat_hi"), F.min(lon).alias("__lon_lo"),
        F.max(lon).alias("__lon_hi"), F.max(distance.target).alias("__far"))
    joined = lookup_join(df, pin(extent, "extent"), list(by))
    there = DistanceRule("__km", distance.latitude, distance.longitude)
    joined = distance_to_center(joined, there, center=center, cities=cities, city_column=city_column)
    margin, reach = F.lit(rule.coordinate_margin_deg), F.lit(rule.distance_margin_km)
    ok = ((lat >= F.col("__lat_lo") - margin) & (lat <= F.col("__lat_hi") + margin)
          & (lon >= F.col("__lon_lo") - margin) & (lon <= F.col("__lon_hi") + margin)
          & (F.col("__km") <= F.col("__far") + reach))
    return joined.withColumn("location_ok", F.coalesce(ok, F.lit(False))).drop(
        "__lat_lo", "__lat_hi", "__lon_lo", "__lon_hi", "__far", "__km")


def default_rating(df: DataFrame, train: DataFrame, *, rating: str = "review_scores_rating", group: str = "group",
                   by: Sequence[str] = ()) -> DataFrame:
    """New apartments get the median training rating; listed ones keep their own."""
    require_columns(df, [rating, group, *by], "default_rating")
    medians = group_quantiles(train, {"__median": (rating, 0.5)}, by)
    joined = lookup_join(df, pin(medians, "rating"), list(by))
    value = F.when(F.col(group) == "new", F.col("__median")).otherwise(F.col(rating))
    return joined.withColumn(rating, value).drop("__median")
