"""Coefficient tables and the tips read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import require_columns
from .lookup import lookup_join
from .regression import INTERCEPT, Fit


def coefficients(fit: Fit, name: str | None = None) -> DataFrame:
    """by, model, term, source, level, position, coef, se, t, p; aliased terms have null se, t and p."""
    return fit.coefficients(name)


def significant_terms(fit: Fit, name: str | None = None, alpha: float = 0.05) -> DataFrame:
    """Terms with p strictly below ``alpha``, the intercept included."""
    return coefficients(fit, name).filter(F.col("p") < alpha).select(*fit.by, "model", "position", "term", "p")


def term_effects(fit: Fit, name: str) -> DataFrame:
    """term, pct and pvalue of every term but the intercept; pct is the coefficient itself without a log."""
    b = F.col("coef")
    pct = F.lit(100.0) * (F.exp(b) - 1) if fit.spec(name).log_scale else b
    return (coefficients(fit, name).filter(F.col("term") != INTERCEPT)
            .select(*fit.by, "position", "term", pct.alias("pct"), F.col("p").alias("pvalue")))


def rating_effects(fit: Fit, name: str, columns: Sequence[str], *, step: float = 0.1, alpha: float = 0.05) -> DataFrame:
    """Percent price change per ``step`` points of each significant, positive score; others are left out."""
    chosen = coefficients(fit, name).filter(
        F.col("term").isin(list(columns)) & F.col("level").isNull() & (F.col("p") < alpha) & (F.col("coef") > 0))
    pct = F.lit(100.0) * (F.exp(F.lit(step) * F.col("coef")) - 1)
    return chosen.select(*fit.by, F.col("term").alias("score"), pct.alias("pct_per_step")).orderBy(
        *fit.by, F.desc("pct_per_step"), "score")


def superhost_tip(df: DataFrame, fit: Fit, name: str, *, flag: str = "is_superhost", alpha: float = 0.05,
                  column: str = "superhost_pct") -> DataFrame:
    """Add the percent effect of ``flag`` for rows without it, if significant and positive; else null."""
    require_columns(df, [flag], "superhost_tip")
    effect = (term_effects(fit, name).filter((F.col("term") == flag) & (F.col("pvalue") < alpha) & (F.col("pct") > 0))
              .select(*fit.by, F.col("pct").alias("__pct")))
    joined = lookup_join(df, fit.lookup(effect), list(fit.by), null_safe=True)
    return joined.withColumn(column, F.when(F.col(flag) != 1, F.col("__pct"))).drop("__pct")


def amenity_tips(df: DataFrame, fit: Fit, name: str, amenities: Sequence[str], *, mean: str = "mean",
                 alpha: float = 0.05, min_effect_pct: float = 1.0, column: str = "tips") -> DataFrame:
    """Add ``array<struct<amenity, change, change_pct>>``, the largest change first; empty if nothing qualifies.

    An amenity qualifies if the row lacks it, its term is significant and ``100 * (exp(b) - 1)`` reaches
    ``min_effect_pct``. ``mean`` holds the mean prediction of the row as it is. No shuffle: the qualifying
    effects of a group travel as one small array.
    """
    require_columns(df, [*amenities, mean, *fit.by], "amenity_tips")
    size = F.lit(100.0) * (F.exp("coef") - 1)
    candidates = coefficients(fit, name).filter(
        F.col("term").isin(list(amenities)) & (F.col("p") < alpha) & (size >= min_effect_pct))
    effects = candidates.groupBy(*fit.by).agg(F.collect_list(F.struct("term", "coef")).alias("__effects"))
    joined = lookup_join(df, fit.lookup(effects), list(fit.by), null_safe=True)
    lacking = F.array_compact(F.array(*[F.when(F.col(a) == 0, F.lit(a)) for a in amenities]))
    base = F.col(mean)

    def tip(e: Column) -> Column:
        change = base * (F.exp(e["coef"]) - 1) if fit.spec(name).log_scale else e["coef"]
        return F.struct(e["term"].alias("amenity"), change.alias("change"),
                        (F.lit(100.0) * change / base).alias("change_pct"))

    open_effects = F.filter("__effects", lambda e: F.array_contains(F.col("__lacking"), e["term"]))

    def larger_first(a: Column, b: Column) -> Column:
        return (F.when(a["change"] > b["change"], -1).when(a["change"] < b["change"], 1)
                .when(a["amenity"] < b["amenity"], -1).when(a["amenity"] > b["amenity"], 1).otherwise(0))

    tips = F.array_sort(F.transform(open_effects, tip), larger_first)
    empty = F.array().cast("array<struct<amenity:string,change:double,change_pct:double>>")
    joined = joined.withColumn("__lacking", lacking)
    return joined.withColumn(column, F.coalesce(tips, empty)).drop("__effects", "__lacking")


def amenity_effects(df: DataFrame, fit: Fit, name: str, amenities: Sequence[str], *, keep: Sequence[str],
                    first: int | None = None, **options) -> DataFrame:
    """One row per row and tip: ``keep``, amenity, change, change_pct, rank (1 = largest change)."""
    tips = amenity_tips(df, fit, name, amenities, column="__tips", **options)
    shown = F.col("__tips") if first is None else F.slice("__tips", 1, first)
    return (tips.select(*keep, F.posexplode(shown).alias("at", "tip"))
            .select(*keep, "tip.amenity", "tip.change", "tip.change_pct", (F.col("at") + 1).alias("rank")))
