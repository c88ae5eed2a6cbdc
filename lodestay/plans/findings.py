"""Market findings as tables, and the whole-market job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import format_eur, signed_percent
from ..operators.effects import rating_effects, term_effects
from ..operators.market import market_overview
from ..rules import AMENITY_LABELS, TERM_LABELS, Rules
from .analysis import Analysis, analysis_run
from .training import training_run


def detail_lines(analysis: Analysis, rules: Rules = Rules()) -> DataFrame:
    """Room types, significant amenities and rating effects: ``by, line, label, pct, text``."""
    by = list(analysis.by)
    amenity_names = F.create_map(*[F.lit(x) for pair in AMENITY_LABELS.items() for x in pair])
    term_names = F.create_map(*[F.lit(x) for pair in TERM_LABELS.items() for x in pair])
    amenity = amenity_names[F.col("term")]
    terms = term_effects(analysis.fits, "price").filter(
        F.col("term").startswith("room_type: ")
        | (amenity.isNotNull() & (F.col("pvalue") < rules.significance_level)))
    lines = terms.select(*by, F.col("position").alias("line"),
                         F.coalesce(F.lower(amenity), term_names[F.col("term")], F.col("term")).alias("label"), "pct",
                         signed_percent(F.col("pct")).alias("text"))
    if not any(s.name == "price_explain" for s in analysis.fits.specs):
        return lines
    step = rules.rating_tips.step
    ratings = rating_effects(analysis.fits, "price_explain", rules.rating_tips.columns, step=step,
                             alpha=rules.significance_level)
    name = F.coalesce(term_names[F.col("score")], F.col("score"))
    return lines.unionByName(ratings.select(
        *by, F.lit(1_000_000).alias("line"), F.concat(name, F.lit(f", per {step} point")).alias("label"),
        F.col("pct_per_step").alias("pct"), signed_percent(F.col("pct_per_step"), 1).alias("text")))


def market_findings(analysis: Analysis, rules: Rules = Rules(), *, importance: DataFrame | None = None) -> DataFrame:
    """``by, section, line, label, value, text`` (``line`` orders a section's rows): overview, model quality, what drives the price, detail lines."""
    by = list(analysis.by)
    everything = analysis.train.unionByName(analysis.test)
    overview = market_overview(everything, by)
    numbers = F.array(*[
        F.struct(F.lit(i).alias("line"), F.lit(label).alias("label"), F.col(c).cast("double").alias("value"),
                 (format_eur(F.col(c)) if c != "listings" else F.col(c).cast("string")).alias("text"))
        for i, (label, c) in enumerate((
            ("listings", "listings"), ("median price", "price_median"), ("first quartile price", "price_q1"),
            ("third quartile price", "price_q3"), ("median revenue", "revenue_median")))])
    first = overview.select(*by, F.lit("overview").alias("section"), F.inline(numbers))
    model = F.array_position(F.lit([s.name for s in analysis.fits.specs]), F.col("model")).cast("int")
    quality = analysis.scores.select(
        *by, F.lit("model quality").alias("section"), model.alias("line"), F.col("model").alias("label"),
        F.col("r2_model_scale").alias("value"),
        F.concat(F.bround(F.lit(100) * F.col("r2_model_scale")).cast("int").cast("string"),
                 F.lit("% explained, typical error "), format_eur(F.col("median_ae"))).alias("text"))
    importance = importance if importance is not None else analysis.importance(rules)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc_nulls_last("shown"), "group"))
    drivers = importance.select(*by, F.lit("what drives the price").alias("section"), place.alias("line"), F.col("group").alias("label"),
                                F.col("shown").alias("value"), F.format_number("shown", 3).alias("text"))
    details = detail_lines(analysis, rules).select(*by, F.lit("in detail").alias("section"), F.col("line").cast("int").alias("line"), "label",
                                                   F.col("pct").alias("value"), "text")
    return first.unionByName(quality).unionByName(drivers).unionByName(details)


def market_job(raw: DataFrame, rules: Rules = Rules(), *, by: Sequence[str] = ("city",), **options) -> DataFrame:
    """All cities in one run: clean, fit, score; one summary row per city and model."""
    df, _ = training_run(raw, rules, by=by, drop_text=True, **options)
    return analysis_run(df, rules, by=by).scores
