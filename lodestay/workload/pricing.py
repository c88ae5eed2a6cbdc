"""Queries over benchmarks and market tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.market import market_overview, price_boxplot, price_histogram
from ..operators.pricing import assess_listing, comparable_listings, occupancy_reference, revenue_estimate
from ..operators.regression import price_range
from ..rules import DAYS_PER_YEAR
from ..sources.staging import stage
from .checks import Z_90, check, km, one_number_model, t_value
from .cleaning import _OVERVIEW, _overview, booked, deduped, fill, typed
from .fixture import BY, RULES, apartments
from .modelling import _TRAIN, SIZE, _fit, sides
from .registry import query, rounded

_SIZE_SQL = one_number_model("accommodates", "train", "s")
_FINE = """fine AS (SELECT city, district, room_type, count(*) AS n, quantile_cont(occ, 0.5) AS q50,
    quantile_cont(occ, 0.75) AS q75 FROM (SELECT *, CAST(estimated_occupancy_l365d AS DOUBLE) / 365 AS occ FROM {source})
    GROUP BY city, district, room_type),
  coarse AS (SELECT city, room_type, quantile_cont(occ, 0.5) AS q50, quantile_cont(occ, 0.75) AS q75 FROM
    (SELECT *, CAST(estimated_occupancy_l365d AS DOUBLE) / 365 AS occ FROM {source}) GROUP BY city, room_type),
  referenced AS (SELECT a.*, CASE WHEN fine.n >= 20 THEN fine.q50 ELSE coarse.q50 END AS reference,
    CASE WHEN fine.n >= 20 THEN fine.q75 ELSE coarse.q75 END AS high_reference
    FROM apartments a JOIN coarse USING (city, room_type) LEFT JOIN fine ON a.city = fine.city
      AND a.district = fine.district AND a.room_type = fine.room_type)"""
_QUANTILES = {"reference": 0.5, "high_reference": 0.75}


def with_occupancy(df):
    return df.withColumn("occupancy_rate", F.col("estimated_occupancy_l365d").cast("double") / DAYS_PER_YEAR)


@query("occupancy_reference", check(("deduped", "apartments"), """SELECT id, round(reference, 6) AS reference,
    round(high_reference, 6) AS high_reference FROM referenced""", _FINE.format(source="deduped")))
def occupancy_reference_query(spark, sf_dir):
    train = with_occupancy(stage(deduped(spark, sf_dir).select("city", "district", "room_type", "estimated_occupancy_l365d"),
                                 "rows"))
    found = occupancy_reference(apartments(spark, sf_dir), train, RULES.occupancy, _QUANTILES, BY)
    return found.select("id", rounded("reference"), rounded("high_reference"))


_RANGED = f"""ranged AS (SELECT r.*, exp(linear) * smearing AS mean, exp(linear - half) AS lower, exp(linear + half) AS upper
    FROM (SELECT a.*, smearing, g.a + slope * accommodates AS linear, {t_value(Z_90, 'dof')} * sqrt(sigma2 * (1 +
      1.0 / g.n + pow(accommodates - mx, 2) / sxx)) AS half FROM referenced a JOIN s_group g USING (city, room_type)
      JOIN s_fit USING (city)) r)"""
_PRICED = (_TRAIN, _FINE.format(source="train"), _SIZE_SQL, _RANGED)


def _ranged(spark, sf_dir):
    train, _ = sides(spark, sf_dir)
    priced = price_range(apartments(spark, sf_dir), _fit(train, SIZE), "size", level=0.8)
    return occupancy_reference(priced, with_occupancy(train), RULES.occupancy, _QUANTILES, BY)


@query("assess_listing", check(("split", "apartments"), """SELECT id, CASE WHEN price < lower THEN CASE WHEN
    occupancy >= high_reference THEN 'underpriced' ELSE 'not_price_problem' END WHEN price > upper THEN CASE WHEN
    occupancy >= high_reference THEN 'unexplained_premium' ELSE 'overpriced' END ELSE 'in_line' END AS status,
    round(greatest(lower - price, price - upper, 0), 6) AS difference
    FROM (SELECT *, estimated_occupancy_l365d / 365.0 AS occupancy FROM ranged)""", *_PRICED))
def assess_listing_query(spark, sf_dir):
    ranged = _ranged(spark, sf_dir).withColumn("occupancy", F.col("estimated_occupancy_l365d") / F.lit(365.0))
    return assess_listing(ranged, reference="high_reference").select("id", "status", rounded("difference"))


@query("revenue_estimate", check(("split", "apartments"), """SELECT id, round(nights, 6) AS nights,
    round(mean * nights, 2) AS revenue, round(CASE WHEN "group" = 'listed' THEN lower * nights END, 2) AS revenue_lower,
    round(CASE WHEN "group" = 'listed' THEN upper * nights END, 2) AS revenue_upper,
    round(CASE WHEN "group" = 'listed' THEN price * nights END, 2) AS own_revenue
    FROM (SELECT *, CASE WHEN "group" = 'listed' THEN estimated_occupancy_l365d ELSE reference * 365 END AS nights
    FROM ranged)""", *_PRICED))
def revenue_estimate_query(spark, sf_dir):
    revenue = revenue_estimate(_ranged(spark, sf_dir))
    return revenue.select("id", rounded("nights"), *[
        rounded(c, digits=2) for c in ("revenue", "revenue_lower", "revenue_upper", "own_revenue")])


@query("comparable_listings", check(("deduped", "apartments"), f"""SELECT id, rank, listing, district,
    accommodates, bedrooms, round(price, 6) AS price, round(review_scores_rating, 6) AS review_scores_rating, distance_km
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance_km, listing) AS rank FROM matched
      WHERE same_rooms OR n_same < 5) WHERE rank <= 5""", f"""
    matched AS (SELECT a.id, l.id AS listing, l.district, l.accommodates, l.bedrooms, l.price, l.review_scores_rating,
      round({km('l.latitude', 'l.longitude', 'a.latitude', 'a.longitude')}, 6) AS distance_km,
      coalesce(l.bedrooms = a.bedrooms, FALSE) AS same_rooms,
      count(CASE WHEN l.bedrooms = a.bedrooms THEN 1 END) OVER (PARTITION BY a.id) AS n_same
      FROM apartments a JOIN deduped l ON a.city = l.city AND a.room_type = l.room_type)"""))
def comparable_listings_query(spark, sf_dir):
    points = stage(deduped(spark, sf_dir).withColumnRenamed("id", "listing"), "rows")
    found = comparable_listings(apartments(spark, sf_dir), points, n=5, query_key=["id"], by=BY, order_by=["listing"],
                                round_km=6)
    return found.select("id", "rank", "listing", "district", "accommodates", "bedrooms", rounded("price"),
                        rounded("review_scores_rating"), "distance_km")


@query("market_overview", check("filled", _OVERVIEW.format(source="filled")))
def market_overview_query(spark, sf_dir):
    return _overview(market_overview(fill(stage(booked(spark, sf_dir), "booked")), BY))


@query("price_histogram", check("booked", """SELECT city, bin, round(lo + (bin - 1) * width, 6) AS bin_start,
    round(lo + (bin - 1) * width + width, 6) AS bin_end, count(*) AS n FROM (
    SELECT city, lo, width, CAST(least(floor((price - lo) / width), 19) + 1 AS INTEGER) AS bin FROM booked JOIN (
      SELECT city, min(price) AS lo, (max(price) - min(price)) / 20 AS width FROM booked GROUP BY city) USING (city))
    GROUP BY city, bin, lo, width"""))
def price_histogram_query(spark, sf_dir):
    bins = price_histogram(booked(spark, sf_dir), BY)
    return bins.select("city", "bin", rounded("bin_start"), rounded("bin_end"), "n")


@query("price_boxplot", check("booked", """SELECT city, room_type, count(*) AS n, round(min(price), 6) AS low,
    round(quantile_cont(price, 0.25), 6) AS q1, round(median(price), 6) AS median,
    round(quantile_cont(price, 0.75), 6) AS q3, round(max(price), 6) AS high FROM booked GROUP BY city, room_type
    HAVING count(*) >= 30"""))
def price_boxplot_query(spark, sf_dir):
    boxes = price_boxplot(booked(spark, sf_dir), RULES.min_room_type_count, BY)
    return boxes.select("city", "room_type", "n", *[rounded(c) for c in ("low", "q1", "median", "q3", "high")])
