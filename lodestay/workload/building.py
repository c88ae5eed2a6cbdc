"""Queries over features and checks of apartments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.features import (amenity_columns, cap_values, centered_squares, distance_to_center,
                                  frequent_categories, group_caps, group_rare, keyword_dummies, multi_hot, ratio,
                                  square_centers)
from ..operators.rows import drop_zero
from ..operators.spatial import nearest_category
from ..operators.validation import default_rating, input_bounds, validate_inputs, validate_location
from ..rules import AMENITIES, CapRule, CategoryRule, DummyRule, InputRule, RatioRule
from ..sources.staging import stage
from .checks import AMENITY_LIST, check, has_keyword, km
from .cleaning import deduped, typed
from .fixture import BY, RULES, apartments
from .registry import query, rounded

_CAP = CapRule(("accommodates", "number_ratings"), "room_type", 0.9)
_CAP_SQL = """, caps AS (SELECT city, room_type, floor(quantile_cont(accommodates, 0.9)) AS cap_accommodates,
    floor(quantile_cont(number_ratings, 0.9)) AS cap_number_ratings FROM typed GROUP BY city, room_type) """


@query("group_caps", check("typed", _CAP_SQL + """SELECT city, room_type, cap_accommodates, cap_number_ratings
    FROM caps"""))
def group_caps_query(spark, sf_dir):
    return group_caps(typed(spark, sf_dir), _CAP, BY)


@query("cap_values", check("typed", _CAP_SQL + """SELECT city, id, copy_order,
    CASE WHEN accommodates > cap_accommodates THEN CAST(cap_accommodates AS INTEGER) ELSE accommodates END AS accommodates,
    CASE WHEN number_ratings > cap_number_ratings THEN CAST(cap_number_ratings AS BIGINT) ELSE number_ratings END
      AS number_ratings FROM typed JOIN caps USING (city, room_type)"""))
def cap_values_query(spark, sf_dir):
    df = stage(typed(spark, sf_dir), "typed")
    return cap_values(df, group_caps(df, _CAP, BY), _CAP, BY).select(
        "city", "id", "copy_order", "accommodates", "number_ratings")


_FLAG_SQL = ", ".join(f"CASE WHEN {has_keyword(r.source, r.keywords)} THEN 1 ELSE 0 END AS {r.target}"
                      for r in RULES.dummies if r.source == "amenities")


@query("keyword_dummies", check("typed", f"SELECT city, id, copy_order, {_FLAG_SQL} FROM typed"))
def keyword_dummies_query(spark, sf_dir):
    rules = [r for r in RULES.dummies if r.source == "amenities"]
    return keyword_dummies(typed(spark, sf_dir), rules).select("city", "id", "copy_order", *[r.target for r in rules])


@query("multi_hot", check("apartments", f"SELECT id, {AMENITY_LIST} FROM apartments"))
def multi_hot_query(spark, sf_dir):
    columns = amenity_columns(RULES.dummies)
    chosen = F.array_compact(F.array(*[F.when(F.col(a) == 1, F.lit(a)) for a in AMENITIES]))
    return multi_hot(apartments(spark, sf_dir).select("id", chosen.alias("selected")), "selected", columns).drop("selected")


@query("ratio", check("typed", """SELECT city, id, copy_order,
    round(CAST(estimated_occupancy_l365d AS DOUBLE) / 365, 6) AS occupancy_rate,
    round(CAST(estimated_occupancy_l365d AS DOUBLE) / availability_365, 6) AS ratio_occupancy_availability FROM typed
    WHERE availability_365 <> 0"""))
def ratio_query(spark, sf_dir):
    df = drop_zero(typed(spark, sf_dir), RULES.ratio_denominators)
    for rule in RULES.ratios:
        df = ratio(df, rule)
    return df.select("city", "id", "copy_order", rounded("occupancy_rate"), rounded("ratio_occupancy_availability"))


@query("haversine", check(("typed", "cities"), f"""SELECT city, id, copy_order,
    round({km('latitude', 'longitude', 'clat', 'clon')}, 6) AS proximity_city_center FROM typed JOIN cities USING (city)"""))
def haversine(spark, sf_dir):
    df = distance_to_center(typed(spark, sf_dir), RULES.distance, cities=RULES.cities)
    return df.select("city", "id", "copy_order", rounded("proximity_city_center"))


@query("frequent_categories", check("typed", """SELECT city, district, count(*) AS n FROM typed GROUP BY city, district
    HAVING count(*) >= 100"""))
def frequent_categories_query(spark, sf_dir):
    return frequent_categories(typed(spark, sf_dir), CategoryRule("district", 100), BY)


@query("room_type_options", check("typed", """SELECT city, room_type FROM typed GROUP BY city, room_type
    HAVING count(*) >= 30"""))
def room_type_options(spark, sf_dir):
    rule = CategoryRule("room_type", RULES.min_room_type_count)
    return frequent_categories(typed(spark, sf_dir), rule, BY).select("city", "room_type").orderBy("city", "room_type")


@query("group_rare", check("typed", """, kept AS (SELECT city, district FROM typed GROUP BY city, district
    HAVING count(*) >= 100) SELECT typed.city, id, copy_order, CASE WHEN kept.district IS NULL THEN '_other'
    ELSE typed.district END AS district FROM typed LEFT JOIN kept ON typed.city = kept.city
    AND typed.district = kept.district"""))
def group_rare_query(spark, sf_dir):
    df, rule = typed(spark, sf_dir), CategoryRule("district", 100)
    return group_rare(df, frequent_categories(df, rule, BY), rule, BY).select("city", "id", "copy_order", "district")


@query("centered_square", check("typed", """, c AS (SELECT city, avg(accommodates) AS ca, avg(number_ratings) AS cr
    FROM typed GROUP BY city) SELECT city, id, copy_order, round(pow(accommodates - ca, 2), 6) AS accommodates_sq
    FROM typed JOIN c USING (city)"""))
def centered_square(spark, sf_dir):
    df, rules = typed(spark, sf_dir), RULES.squares[:1]
    squared = centered_squares(df, square_centers(df, rules, BY), rules, BY)
    return squared.select("city", "id", "copy_order", rounded("accommodates_sq"))


@query("nearest_category", check(("deduped", "apartments"), f"""SELECT id, city, district, distance_km FROM (
    SELECT a.id, a.city, l.district, round({km('l.latitude', 'l.longitude', 'a.latitude', 'a.longitude')}, 6)
      AS distance_km, row_number() OVER (PARTITION BY a.id ORDER BY
      round({km('l.latitude', 'l.longitude', 'a.latitude', 'a.longitude')}, 6), l.id) AS rn
    FROM apartments a JOIN deduped l ON a.city = l.city) WHERE rn = 1"""))
def nearest_category_query(spark, sf_dir):
    points = deduped(spark, sf_dir).withColumnRenamed("id", "listing")
    found = nearest_category(apartments(spark, sf_dir), points, query_key=["id"], by=BY, order_by=["listing"], round_km=6)
    return found.select("id", "city", "district", "distance_km")


_BOUNDED = (InputRule("accommodates", True, 1), InputRule("bedrooms", True), InputRule("beds", True, 1),
            InputRule("bathrooms", False, 0.5), InputRule("review_scores_rating", False, 1.0, 5.0))
_BOUNDS_SQL = """, extent AS (SELECT city, room_type, max(accommodates) AS max_acc, min(bedrooms) AS min_bedrooms,
    max(bedrooms) AS max_bedrooms, max(beds) AS max_beds, max(bathrooms) AS max_bathrooms FROM typed
    GROUP BY city, room_type),
  bounded AS (SELECT a.*, 1.0 AS lo_accommodates, floor(max_acc) AS hi_accommodates, ceil(min_bedrooms) AS lo_bedrooms,
    floor(least(max_bedrooms, accommodates)) AS hi_bedrooms, 1.0 AS lo_beds,
    floor(least(max_beds, 2.0 * accommodates)) AS hi_beds, 0.5 AS lo_bathrooms,
    least(max_bathrooms, bedrooms + 2) AS hi_bathrooms, 1.0 AS lo_review_scores_rating, 5.0 AS hi_review_scores_rating
    FROM apartments a JOIN extent USING (city, room_type)) """
_BOUND_COLUMNS = [f"{side}_{r.column}" for r in _BOUNDED for side in ("lo", "hi")]


@query("input_bounds", check(("typed", "apartments"), _BOUNDS_SQL + "SELECT id, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in _BOUND_COLUMNS) + " FROM bounded"))
def input_bounds_query(spark, sf_dir):
    bounded = input_bounds(apartments(spark, sf_dir), typed(spark, sf_dir), _BOUNDED, RULES.plausibility, by=BY)
    return bounded.select("id", *_BOUND_COLUMNS)


@query("validate_inputs", check(("typed", "apartments"), _BOUNDS_SQL + " UNION ALL ".join(
    f"SELECT id, '{r.column}' AS column_name, round(CAST({r.column} AS DOUBLE), 6) AS value, "
    f"CAST(lo_{r.column} AS DOUBLE) AS lo, CAST(hi_{r.column} AS DOUBLE) AS hi, "
    f"{r.column} BETWEEN lo_{r.column} AND hi_{r.column}"
    f"{f' AND {r.column} = floor({r.column})' if r.whole else ''} AS ok FROM bounded" for r in _BOUNDED)))
def validate_inputs_query(spark, sf_dir):
    checked = validate_inputs(apartments(spark, sf_dir), typed(spark, sf_dir), _BOUNDED, RULES.plausibility, by=BY)
    return checked.select("id", F.col("column").alias("column_name"), rounded("value"), "lo", "hi", "ok")


@query("validate_location", check(("typed", "apartments"), f""", far AS (SELECT city, min(latitude) AS lat_lo,
    max(latitude) AS lat_hi, min(longitude) AS lon_lo, max(longitude) AS lon_hi,
    max({km('latitude', 'longitude', 'clat', 'clon')}) AS reach FROM typed JOIN cities USING (city) GROUP BY city)
    SELECT id, city, latitude BETWEEN lat_lo - 0.005 AND lat_hi + 0.005 AND longitude BETWEEN lon_lo - 0.005 AND
      lon_hi + 0.005 AND {km('latitude', 'longitude', 'clat', 'clon')} <= reach + 0.5 AS location_ok
    FROM apartments JOIN cities USING (city) JOIN far USING (city)"""))
def validate_location_query(spark, sf_dir):
    train = distance_to_center(typed(spark, sf_dir), RULES.distance, cities=RULES.cities)
    checked = validate_location(apartments(spark, sf_dir), train, RULES.distance, RULES.location, cities=RULES.cities, by=BY)
    return checked.select("id", "city", "location_ok")


@query("default_rating", check(("typed", "apartments"), """SELECT a.id, round(CASE WHEN a."group" = 'new' THEN m.rating
    ELSE a.review_scores_rating END, 6) AS review_scores_rating FROM apartments a JOIN (SELECT city,
    median(review_scores_rating) AS rating FROM typed GROUP BY city) m USING (city)"""))
def default_rating_query(spark, sf_dir):
    rated = default_rating(apartments(spark, sf_dir), typed(spark, sf_dir), by=BY)
    return rated.select("id", rounded("review_scores_rating"))


_TV = (DummyRule("amenities", "has_tv", ("tv",), delete=True),)


@query("dummy_and_ratio_delete", check("typed", """SELECT city, id, copy_order, CASE WHEN contains(lower(amenities), 'tv')
    THEN 1 ELSE 0 END AS has_tv, round(CAST(estimated_occupancy_l365d AS DOUBLE) / accommodates, 6) AS nights_per_guest
    FROM typed"""))
def dummy_and_ratio_delete(spark, sf_dir):
    df = typed(spark, sf_dir).select("city", "id", "copy_order", "amenities", "estimated_occupancy_l365d", "accommodates")
    df = keyword_dummies(df, _TV)
    df = ratio(df, RatioRule("nights_per_guest", "estimated_occupancy_l365d", "accommodates", delete=True))
    return df.withColumn("nights_per_guest", F.round("nights_per_guest", 6))
