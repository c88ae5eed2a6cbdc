"""Pricing apartments against fitted models and the training listings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import require_columns, require_rows
from ..operators.effects import amenity_tips, rating_effects, superhost_tip
from ..operators.lookup import lookup_join
from ..operators.pricing import GROUPS, assess_listing, comparable_listings, occupancy_reference, occupancy_tables, revenue_estimate
from ..operators.regression import price_range
from ..rules import DAYS_PER_YEAR, STATUS_MESSAGES, TERM_LABELS, AMENITY_LABELS, Rules
from .analysis import Analysis


def apartment_key(df: DataFrame, key: Sequence[str], by: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([*by, *key]))


def price_apartments(prepared: DataFrame, analysis: Analysis, rules: Rules = Rules(), *, group: str = "group",
                     strict: bool = True) -> DataFrame:
    """Range, nights, revenue, assessment and tips of every prepared apartment, without shuffling them."""
    by = list(analysis.by)
    require_columns(prepared, [group, *by], "price_apartments")
    fits = analysis.fits
    out = price_range(prepared, fits, "price", level=rules.interval_level, strict=False)
    levels = {"reference": 0.5, "high_reference": rules.occupancy.high_quantile}
    out = occupancy_reference(out, analysis.train, rules.occupancy, levels, by, strict=False,
                              tables=occupancy_tables(analysis.train, rules.occupancy, levels, by, strict=strict))
    # one check job for all steps
    require_rows(out, {
        "an apartment has a missing predictor or a category level the model does not know": F.col("median").isNull(),
        f"no listings with this {rules.occupancy.fallback}": F.col("reference").isNull(),
        f"{group} must be listed or new": ~F.coalesce(F.col(group).isin(*GROUPS), F.lit(False))}, strict)
    out = revenue_estimate(out, group=group)
    listed = F.col(group) == "listed"
    out = out.withColumns({"occupancy": F.col("nights") / F.lit(float(DAYS_PER_YEAR)),
                           "current_price": F.when(listed, F.col("price").cast("double"))})
    out = assess_listing(out, current="current_price", reference="high_reference")
    out = superhost_tip(out, fits, "price", alpha=rules.significance_level)
    out = amenity_tips(out, fits, "price", rules.actionable_amenities, alpha=rules.significance_level,
                       min_effect_pct=rules.min_effect_pct)
    ratings = rating_effects(fits, "price_explain", rules.rating_tips.columns, step=rules.rating_tips.step,
                             alpha=rules.significance_level)
    larger_first = F.sort_array(F.collect_list(F.struct("pct_per_step", "score")), asc=False)
    per_group = ratings.groupBy(*by).agg(larger_first.alias("__ratings"))
    out = lookup_join(out, fits.lookup(per_group), by, null_safe=True)
    shape = "array<struct<pct_per_step:double,score:string>>"
    return out.withColumn("rating_tips", F.coalesce(F.col("__ratings"), F.array()).cast(shape)).drop("__ratings")


def prediction_run(prepared: DataFrame, analysis: Analysis, rules: Rules = Rules(), *, key: Sequence[str] = ("id",),
                   group: str = "group", strict: bool = True, **search) -> DataFrame:
    """One row per apartment: price, revenue and assessment structs, arrays of tips and comparable listings."""
    by = list(analysis.by)
    keys = apartment_key(prepared, key, by)
    # a table of apartments may be one file that one task reads, and a row's interval and tips are long sums: they are dealt out by key, as the join wants them
    dealt = prepared.repartition(int(prepared.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    priced = price_apartments(dealt, analysis, rules, group=group, strict=strict)
    near = comparable_listings(prepared, analysis.train, n=rules.comparables, query_key=keys, by=by,
                               distance=rules.distance, **search)
    columns = [c for c in near.columns if c not in keys]
    gathered = near.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", *[c for c in columns if c != "rank"]))
                                                    ).alias("comparables"))
    bundle = priced.select(
        *keys, group, F.lit(rules.interval_level).alias("level"), "district", "room_type",
        F.struct("median", "mean", "lower", "upper").alias("price_range"), "nights",
        F.struct(F.col("revenue").alias("estimate"), F.col("revenue_lower").alias("lower"),
                 F.col("revenue_upper").alias("upper"), F.col("own_revenue").alias("own")).alias("revenue"),
        "current_price", F.struct("status", "difference").alias("assessment"),
        F.col("superhost_pct").alias("superhost"), "tips", "rating_tips")
    right = gathered.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "comparables")
    condition = reduce(lambda a, b: a & b, [bundle[k] == right[f"__k_{k}"] for k in keys])
    return bundle.join(right, condition, "left").drop(*[f"__k_{k}" for k in keys])


def pricing_report(bundle: DataFrame, rules: Rules = Rules(), strict: bool = True) -> DataFrame:
    """Readable rows of the result: labelled district, status message, the first tips, similar listings."""
    status = F.col("assessment.status")
    known = F.col("assessment.status").isNull() | status.isin(list(STATUS_MESSAGES))
    require_rows(bundle, {"no message for a status": ~known}, strict)
    messages = F.create_map(*[F.lit(x) for pair in STATUS_MESSAGES.items() for x in pair])
    amenity_names = F.create_map(*[F.lit(x) for pair in AMENITY_LABELS.items() for x in pair])
    term_names = F.create_map(*[F.lit(x) for pair in TERM_LABELS.items() for x in pair])

    def tip(t: Column) -> Column:
        unnamed = F.raise_error(F.concat(F.lit("no label for amenity "), t["amenity"])).cast("string") if strict else t["amenity"]
        return F.struct(F.coalesce(amenity_names[t["amenity"]], unnamed).alias("label"), t["change"].alias("change"),
                        t["change_pct"].alias("change_pct"))

    def rating(t: Column) -> Column:
        return F.struct(F.coalesce(term_names[t["score"]], t["score"]).alias("label"),
                        t["pct_per_step"].alias("pct_per_step"))

    place = F.when(F.col("district") == rules.category.other_label, F.lit("other districts")).otherwise(F.col("district"))
    where = (F.when(status.isin("underpriced", "not_price_problem"), "below the range")
             .when(status.isin("overpriced", "unexplained_premium"), "above the range")
             .when(status == "in_line", "inside the range"))
    kept = [c for c in bundle.columns if c not in ("district", "tips", "rating_tips", "assessment")]
    return bundle.select(
        *kept, place.alias("district"), status.alias("status"), F.col("assessment.difference").alias("difference"),
        where.alias("position"), messages[status].alias("message"),
        F.transform(F.slice("tips", 1, rules.tips_shown), tip).alias("tips"),
        F.transform("rating_tips", rating).alias("rating_tips"))
