"""Benchmarks of apartments against the market: occupancy, assessment, revenue, comparables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import RuleError, require_columns, require_rows
from ..rules import DAYS_PER_YEAR, DistanceRule, OccupancyRule
from .lookup import Lookup, lookup_join, pin
from .quantiles import group_quantiles
from .spatial import nearest_k

COMPARABLE_COLUMNS = ("district", "accommodates", "bedrooms", "price", "review_scores_rating")
GROUPS = ("listed", "new")


def occupancy_tables(train: DataFrame, rule: OccupancyRule, quantiles: Mapping[str, float], by: Sequence[str] = (),
                     value: str = "occupancy_rate", strict: bool = True) -> tuple[Lookup, Lookup]:
    """Quantiles per fine group (with its size) and per fallback group."""
    by = list(by)
    fine_keys, coarse_keys = [*by, *rule.group_by], [*by, rule.fallback]
    require_columns(train, [*fine_keys, *coarse_keys, value], "occupancy_reference")
    fine = group_quantiles(train, {f"__fine_{n}": (value, q) for n, q in quantiles.items()}, fine_keys,
                           sizes={"__fine_n": value}, null_message=f"missing value in {value}" if strict else None)
    coarse = group_quantiles(train, {f"__coarse_{n}": (value, q) for n, q in quantiles.items()}, coarse_keys)
    return pin(fine, "occupancy-fine"), pin(coarse, "occupancy-coarse")


def occupancy_reference(df: DataFrame, train: DataFrame, rule: OccupancyRule, quantiles: Mapping[str, float] | None = None,
                        by: Sequence[str] = (), *, value: str = "occupancy_rate", strict: bool = True,
                        tables: tuple[Lookup, Lookup] | None = None) -> DataFrame:
    """Add a quantile of the occupancy of comparable listings; small groups fall back to the wider group.

    ``quantiles`` maps new column names to quantiles. A row whose fallback group is unknown is an error.
    """
    quantiles = dict(quantiles or {"occupancy_reference": 0.5})
    by = list(by)
    require_columns(df, [*by, *rule.group_by, rule.fallback], "occupancy_reference")
    fine, coarse = tables or occupancy_tables(train, rule, quantiles, by, value, strict)
    joined = lookup_join(df, coarse, [*by, rule.fallback])
    joined = lookup_join(joined, fine, [*by, *rule.group_by])
    first = next(iter(quantiles))
    require_rows(joined, {f"no listings with this {rule.fallback}": F.col(f"__coarse_{first}").isNull()}, strict)
    own = F.coalesce(F.col("__fine_n") >= rule.min_count, F.lit(False))
    made = {n: F.when(own, F.col(f"__fine_{n}")).otherwise(F.col(f"__coarse_{n}")) for n in quantiles}
    return joined.withColumns(made).select(*df.columns, *quantiles)


def assess_listing(df: DataFrame, *, current: str = "price", lower: str = "lower", upper: str = "upper",
                   occupancy: str = "occupancy", reference: str = "reference") -> DataFrame:
    """Add ``status`` and ``difference`` (distance to the nearest bound, 0 inside; bounds count as inside)."""
    require_columns(df, [current, lower, upper, occupancy, reference], "assess_listing")
    c, lo, hi = F.col(current), F.col(lower), F.col(upper)
    booked = F.col(occupancy) >= F.col(reference)
    known = c.isNotNull() & lo.isNotNull() & hi.isNotNull()
    status = (F.when(~known, F.lit(None))
              .when(c < lo, F.when(booked, "underpriced").otherwise("not_price_problem"))
              .when(c > hi, F.when(booked, "unexplained_premium").otherwise("overpriced"))
              .otherwise("in_line"))
    difference = F.when(known, F.greatest(lo - c, c - hi, F.lit(0.0)))
    return df.withColumns({"status": status, "difference": difference})


def revenue_estimate(df: DataFrame, *, group: str = "group", reference: str = "reference",
                     booked: str = "estimated_occupancy_l365d", price: str = "price") -> DataFrame:
    """Add ``nights, revenue, revenue_lower, revenue_upper, own_revenue``.

    A listed apartment uses its own nights and gets a range; a new one gets the typical occupancy of the year
    and no range. Needs ``mean, lower, upper`` from the price range.
    """
    require_columns(df, [group, reference, booked, "mean", "lower", "upper", price], "revenue_estimate")
    listed = F.col(group) == "listed"
    nights = F.when(listed, F.col(booked).cast("double")).otherwise(F.col(reference) * F.lit(float(DAYS_PER_YEAR)))
    n = F.col("nights")
    return df.withColumn("nights", nights).withColumns({
        "revenue": F.col("mean") * n, "revenue_lower": F.when(listed, F.col("lower") * n),
        "revenue_upper": F.when(listed, F.col("upper") * n), "own_revenue": F.when(listed, F.col(price) * n)})


def comparable_listings(queries: DataFrame, listings: DataFrame, *, n: int = 5, query_key: Sequence[str] = ("id",),
                        by: Sequence[str] = (), distance: DistanceRule = DistanceRule(), order_by: Sequence[str] = ("id",),
                        columns: Sequence[str] = COMPARABLE_COLUMNS, room_type: str = "room_type",
                        bedrooms: str = "bedrooms", **options) -> DataFrame:
    """The ``n`` nearest listings with the same room type and bedrooms; room type alone if fewer than ``n`` match.

    Columns: ``query_key``, ``columns`` of the listing, ``distance_km``, ``rank``.
    """
    if n < 1:
        raise RuleError(f"{n} comparable listings were asked for, one is the least")
    by = list(by)
    require_columns(listings, [*by, room_type, bedrooms, *columns], "comparable_listings")
    require_columns(queries, [*by, room_type, bedrooms, *query_key], "comparable_listings")
    # a bedroom count is never negative, so -1 can stand for "any"
    anything = F.lit(-1.0)
    rooms = F.col(bedrooms).cast("double")
    scope = [*by, room_type, "__rooms"]
    sized = listings.withColumn("__rooms", rooms)
    enough = pin(sized.groupBy(*scope).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= n)
                 .filter(F.col("__rooms").isNotNull()), "scope-sizes")
    asked = lookup_join(queries.withColumn("__rooms", rooms), enough, scope)
    asked = asked.withColumn("__rooms", F.when(F.col("__n").isNotNull(), F.col("__rooms")).otherwise(anything))
    used = pin(asked.select(*scope).distinct().withColumn("__used", F.lit(True)), "scopes")
    both = sized.filter(F.col("__rooms").isNotNull()).unionByName(sized.withColumn("__rooms", anything))
    candidates = lookup_join(both, used, scope, how="inner").drop("__used")
    carried = [c for c in columns if c not in (*by, room_type)]
    best = nearest_k(asked.drop("__n"), candidates, n, query_key=query_key, scope=scope, carry=carried, order_by=order_by,
                     latitude=distance.latitude, longitude=distance.longitude, **options)
    points = [f"point_{c}" if c in query_key else c for c in order_by]
    return best.select(*query_key, *[c for c in by if c not in query_key], "rank", *points, *columns, "distance_km")
