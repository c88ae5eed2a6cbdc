"""Market tables: overview, price histogram, price by room type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import RuleError, require_columns
from .lookup import lookup_join, pin
from .quantiles import group_quantiles


def market_overview(df: DataFrame, by: Sequence[str] = (), *, price: str = "price",
                    revenue: str = "estimated_revenue") -> DataFrame:
    """``by, listings, price_median, price_q1, price_q3, revenue_median``."""
    require_columns(df, [*by, price, revenue], "market_overview")
    quantiles = group_quantiles(
        df, {"price_median": (price, 0.5), "price_q1": (price, 0.25), "price_q3": (price, 0.75),
             "revenue_median": (revenue, 0.5)}, by)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("listings"))
    return lookup_join(sizes, pin(quantiles, "overview"), list(by), null_safe=True).select(
        *by, "listings", "price_median", "price_q1", "price_q3", "revenue_median")


def price_histogram(df: DataFrame, by: Sequence[str] = (), *, price: str = "price", nbins: int = 20) -> DataFrame:
    """Counts per equal-width bin between the lowest and highest price; missing prices are skipped.

    Columns ``by, bin (1..nbins), bin_start, bin_end, n``; the last bin includes the highest price, empty bins
    are left out.
    """
    if nbins < 1:
        raise RuleError(f"nbins must be at least 1, got {nbins}")
    require_columns(df, [*by, price], "price_histogram")
    known = df.filter(F.col(price).isNotNull())
    extent = known.groupBy(*by).agg(F.min(price).cast("double").alias("__lo"), F.max(price).cast("double").alias("__hi"))
    joined = lookup_join(known.select(*by, price), pin(extent, "price-extent"), list(by), null_safe=True)
    width = (F.col("__hi") - F.col("__lo")) / nbins
    at = F.coalesce(F.floor((F.col(price) - F.col("__lo")) / F.nullif(width, F.lit(0.0))), F.lit(0))
    binned = joined.withColumn("bin", (F.least(at, F.lit(nbins - 1)) + 1).cast("int"))
    counted = binned.groupBy(*by, "bin", "__lo", "__hi").agg(F.count(F.lit(1)).alias("n"))
    start = F.col("__lo") + (F.col("bin") - 1) * width
    return counted.select(*by, "bin", start.alias("bin_start"), (start + width).alias("bin_end"), "n")


def price_boxplot(df: DataFrame, min_count: int, by: Sequence[str] = (), *, price: str = "price",
                  group_by: str = "room_type") -> DataFrame:
    """Five numbers per group with at least ``min_count`` rows, the largest group first."""
    keys = [*by, group_by]
    require_columns(df, [*keys, price], "price_boxplot")
    # quantiles 0 and 1 are the extremes, so everything comes from one pass over the value counts
    numbers = group_quantiles(df, {"low": (price, 0.0), "q1": (price, 0.25), "median": (price, 0.5),
                                   "q3": (price, 0.75), "high": (price, 1.0)}, keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    joined = lookup_join(sizes, pin(numbers, "boxplot"), keys, null_safe=True)
    return joined.orderBy(*by, F.desc("n"), group_by)
