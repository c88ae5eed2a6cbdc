"""Feature operators: caps, dummies, ratios, distances, rare categories, centred squares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import RuleError, require_columns, require_rows
from ..functions.geo import haversine_km
from ..rules import CapRule, CategoryRule, City, DistanceRule, DummyRule, RatioRule, SquareRule
from .lookup import Lookup, lookup_join, pin
from .quantiles import group_quantiles


def group_caps(df: DataFrame, rule: CapRule, by: Sequence[str] = (), strict: bool = True, weight: str | None = None) -> DataFrame:
    """``floor(quantile)`` per group: columns ``by``, the group column, ``cap_<column>``. A row stands for ``weight`` rows."""
    require_columns(df, [*rule.columns, rule.group_by, *by], "group_caps")
    keys = [*by, rule.group_by]
    message = f"group_caps: a column of {', '.join(rule.columns)} has a missing value" if strict else None
    raw = group_quantiles(df, {f"cap_{c}": (c, rule.quantile) for c in rule.columns}, keys, null_message=message, weight=weight)
    return raw.select(*keys, *[F.floor(f"cap_{c}").cast("double").alias(f"cap_{c}") for c in rule.columns])


def cap_values(df: DataFrame, caps: DataFrame | Lookup, rule: CapRule, by: Sequence[str] = (),
               strict: bool = True) -> DataFrame:
    """Lower values above their group's cap to the cap; column types stay. No cap for a group is an error."""
    require_columns(df, [*rule.columns, rule.group_by, *by], "cap_values")
    keys = [*by, rule.group_by]
    caps = caps if isinstance(caps, Lookup) else pin(caps, "caps")
    joined = lookup_join(df, caps, keys)
    require_rows(joined, {f"cap_values: no cap for a value of {rule.group_by}": F.col(f"cap_{rule.columns[0]}").isNull()},
                 strict)
    lowered = {}
    for c in rule.columns:
        cap = F.col(f"cap_{c}")
        lowered[c] = F.when(F.col(c) > cap, cap.cast(df.schema[c].dataType)).otherwise(F.col(c))
    return joined.withColumns(lowered).select(*df.columns)


def contains_any(text: Column, keywords: Sequence[str]) -> Column:
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [lowered.contains(k) for k in keywords], F.lit(False))


def keyword_dummies(df: DataFrame, rules: Sequence[DummyRule], strict: bool = True) -> DataFrame:
    """1 if the lower-cased source contains one of the keywords, else 0. A missing text is an error, or 0."""
    require_columns(df, [r.source for r in rules], "keyword_dummies")
    sources = dict.fromkeys(r.source for r in rules)
    require_rows(df, {f"keyword_dummies: column {s} has a missing value": F.col(s).isNull() for s in sources}, strict)
    flags = {r.target: F.coalesce(contains_any(F.col(r.source), r.keywords), F.lit(False)).cast("int") for r in rules}
    gone = {r.source for r in rules if r.delete and r.source != r.target}
    return df.withColumns(flags).drop(*gone)


def amenity_columns(rules: Sequence[DummyRule], source: str = "amenities") -> list[str]:
    """Targets built from the amenities text, in rule order."""
    return [r.target for r in rules if r.source == source]


def multi_hot(df: DataFrame, selected: str, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """One 0/1 column per known name from an array of chosen names; an unknown name is an error."""
    require_columns(df, [selected], "multi_hot")
    known = F.array(*[F.lit(c) for c in columns])
    require_rows(df, {f"multi_hot: {selected} holds a name that is not a known column":
                      F.size(F.array_except(F.col(selected), known)) > 0}, strict)
    return df.withColumns({c: F.coalesce(F.array_contains(selected, c), F.lit(False)).cast("int") for c in columns})


def ratio(df: DataFrame, rule: RatioRule, strict: bool = True) -> DataFrame:
    """numerator / denominator; a missing or zero denominator is an error (null if not strict)."""
    require_columns(df, [rule.numerator], "ratio")
    if isinstance(rule.denominator, str):
        require_columns(df, [rule.denominator], "ratio")
        d = F.col(rule.denominator)
        require_rows(df, {f"ratio: denominator {rule.denominator} has a missing value": d.isNull(),
                          f"ratio: denominator {rule.denominator} contains a value equal to 0": d == 0}, strict)
        value = F.try_divide(F.col(rule.numerator).cast("double"), d.cast("double"))
    else:
        if rule.denominator == 0:
            raise RuleError(f"ratio: denominator of {rule.target} is 0")
        value = F.col(rule.numerator).cast("double") / F.lit(float(rule.denominator))
    result = df.withColumn(rule.target, value)
    if rule.delete:
        result = result.drop(rule.numerator, *([rule.denominator] if isinstance(rule.denominator, str) else []))
    return result


def city_frame(df: DataFrame, cities: Mapping[str, City], city_column: str = "city") -> DataFrame:
    """The city dimension: city, centre and currency."""
    rows = [(n, float(c.latitude), float(c.longitude), c.currency) for n, c in cities.items()]
    return df.sparkSession.createDataFrame(
        rows, f"{city_column} string, center_latitude double, center_longitude double, currency string")


def distance_to_center(df: DataFrame, rule: DistanceRule, *, center: tuple[float, float] | None = None,
                       cities: Mapping[str, City] | None = None, city_column: str = "city") -> DataFrame:
    """Great-circle km to one ``center`` (latitude, longitude) or to the centre of each row's city."""
    require_columns(df, [rule.latitude, rule.longitude], "distance_to_center")
    if center is not None:
        located = df.withColumns({"__clat": F.lit(float(center[0])), "__clon": F.lit(float(center[1]))})
    elif cities is not None:
        require_columns(df, [city_column], "distance_to_center")
        dim = city_frame(df, cities, city_column).select(
            city_column, F.col("center_latitude").alias("__clat"), F.col("center_longitude").alias("__clon"))
        located = lookup_join(df, pin(dim, "centers"), [city_column])
    else:
        raise RuleError("distance_to_center: give a center or the cities")
    km = haversine_km(F.col(rule.latitude), F.col(rule.longitude), F.col("__clat"), F.col("__clon"))
    result = located.withColumn(rule.target, km).drop("__clat", "__clon")
    return result.drop(rule.latitude, rule.longitude) if rule.delete else result


def frequent_categories(df: DataFrame, rule: CategoryRule, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Category values with at least ``min_count`` rows: ``by``, the column, ``n``. A row stands for ``weight`` rows."""
    require_columns(df, [rule.column, *by], "frequent_categories")
    counts = df.groupBy(*by, rule.column).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    return counts.filter(F.col("n") >= rule.min_count)


def group_rare(df: DataFrame, kept: DataFrame | Lookup, rule: CategoryRule, by: Sequence[str] = ()) -> DataFrame:
    """Replace every value that is not in ``kept`` with the other-label."""
    require_columns(df, [rule.column, *by], "group_rare")
    keys = [*by, rule.column]
    if not isinstance(kept, Lookup):
        kept = pin(kept.select(*keys), "kept")
    marked = Lookup(kept.frame.select(*keys, F.lit(True).alias("__kept")), kept.small)
    joined = lookup_join(df, marked, keys)
    value = F.when(F.col("__kept"), F.col(rule.column)).otherwise(F.lit(rule.other_label))
    return joined.withColumn(rule.column, value).select(*df.columns)


def square_centers(df: DataFrame, rules: Sequence[SquareRule], by: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """``center_<source>`` per group: the mean, or 0 for rules without centring."""
    require_columns(df, [*by, *[r.source for r in rules]], "square_centers")
    require_rows(df, {f"square_centers: column {r.source} has a missing value": F.col(r.source).isNull()
                      for r in rules}, strict)
    aggs = [(F.avg(r.source) if r.center else F.first(F.lit(0.0))).alias(f"center_{r.source}") for r in rules]
    return df.groupBy(*by).agg(*aggs)


def centered_squares(df: DataFrame, centers: DataFrame | Lookup, rules: Sequence[SquareRule],
                     by: Sequence[str] = ()) -> DataFrame:
    """``target = (source - center)^2`` with centres learned elsewhere (normally on the training rows)."""
    require_columns(df, [*by, *[r.source for r in rules]], "centered_squares")
    joined = lookup_join(df, centers if isinstance(centers, Lookup) else pin(centers, "centers"), list(by))
    squared = {r.target: F.pow(F.col(r.source) - F.col(f"center_{r.source}"), F.lit(2.0)) for r in rules}
    return joined.withColumns(squared).drop(*[f"center_{r.source}" for r in rules])
