"""Queries over reading, typing, dropping and filling rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import format_eur, parse_bathrooms
from ..operators.columns import convert_currency, label_terms, rename_columns, select_columns, set_types
from ..operators.features import city_frame
from ..operators.lookup import lookup_join, pin
from ..operators.market import market_overview
from ..operators.missing import (fill_from_text, impute_group_median, impute_or_drop_label, missing_drop,
                                 missing_fill_zero, missing_rules)
from ..operators.rows import dedupe_first, drop_outliers, drop_zero, filter_plausible, outlier_fences
from ..rules import COLUMN_TYPES, LABEL_MAPPING, RELEVANT_COLUMNS, SUBSCORES, TERM_LABELS
from ..sources.listings import city_path, file_system_of, read_apartments, read_cities, read_listings
from ..sources.reports import save_report
from ..sources.staging import stage, staging_path
from .checks import PARSE_BATHROOMS, check
from .fixture import BY, FIXTURE_CITIES, ORDER, RULES, apartments, listings
from .registry import query, rounded


def typed(spark, sf_dir):
    df = select_columns(listings(spark, sf_dir), [*BY, "copy_order", *RULES.relevant_columns])
    df = set_types(rename_columns(df, RULES.label_mapping), RULES.column_types)
    return convert_currency(df, RULES.currency, cities=RULES.cities)


def deduped(spark, sf_dir):
    return dedupe_first(typed(spark, sf_dir), [*BY, "id"], ORDER)


def booked(spark, sf_dir):
    return drop_zero(deduped(spark, sf_dir), RULES.no_booking_columns)


def fill(df):
    return missing_rules(df, RULES.missing, by=BY)


_DOUBLES = ("latitude", "longitude", "bathrooms", "review_scores_rating", "reviews_per_month", *SUBSCORES)
_SCAN = ", ".join(
    f"round({c}, 6) AS {c}" if c in _DOUBLES else
    f"CAST({c} AS DOUBLE) AS {c}" if c in ("beds", "bedrooms", "minimum_nights", "estimated_revenue_l365d") else
    f"CAST({c} AS INTEGER) AS {c}" if c in ("availability_365", "number_of_reviews") else c
    for c in RELEVANT_COLUMNS)


def _scan_output(df, *more):
    return df.select(*more, *[rounded(c) if c in _DOUBLES else F.col(c) for c in RELEVANT_COLUMNS])


@query("scan_listings", check("listings", f"SELECT {_SCAN} FROM listings"))
def scan_listings(spark, sf_dir):
    path = city_path("all", staging_path(spark, "csv"))
    listings(spark, sf_dir).select(*RELEVANT_COLUMNS).write.option("header", True).option("escape", '"').csv(path)
    return _scan_output(read_listings(spark, path))


@query("scan_cities", check("listings", f"SELECT city, {_SCAN} FROM listings"))
def scan_cities(spark, sf_dir):
    folder = staging_path(spark, "csv")
    raw = listings(spark, sf_dir).select(*RELEVANT_COLUMNS, "city")
    # one pass writes the folders of all cities; each then gets the name that the reader looks for
    written = staging_path(spark, "cities")
    raw.write.partitionBy("city").option("header", True).option("escape", '"').csv(written)
    file_system, root = file_system_of(spark, folder)
    file_system.mkdirs(root)
    for city in FIXTURE_CITIES:
        found, named = (file_system_of(spark, p)[1] for p in (f"{written}/city={city}", city_path(city, folder)))
        if not file_system.exists(found):
            raw.filter(F.lit(False)).drop("city").write.option("header", True).csv(named.toString())
        elif not file_system.rename(found, named):
            raise OSError(f"{found.toString()} was not renamed to {named.toString()}")
    return _scan_output(read_cities(spark, {**FIXTURE_CITIES, **RULES.cities, "NOWHERE": FIXTURE_CITIES["ASIA"]}, folder),
                        "city")


@query("scan_apartments", check("apartments", """SELECT accommodates, availability_365, bathrooms, bedrooms, beds, city,
    district, id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, round(price, 6) AS price,
    "group" AS listing_group FROM apartments"""))
def scan_apartments(spark, sf_dir):
    df = read_apartments(apartments(spark, sf_dir))
    return df.select("accommodates", "availability_365", "bathrooms", "bedrooms", "beds", "city", "district", "id",
                     rounded("latitude"), rounded("longitude"), rounded("price"), F.col("group").alias("listing_group"))


_OVERVIEW = """SELECT city, count(*) AS listings, round(median(price), 6) AS price_median,
    round(quantile_cont(price, 0.25), 6) AS price_q1, round(quantile_cont(price, 0.75), 6) AS price_q3,
    round(median(estimated_revenue), 6) AS revenue_median FROM {source} GROUP BY city"""


def _overview(df):
    return df.select("city", "listings", *[rounded(c) for c in ("price_median", "price_q1", "price_q3",
                                                                "revenue_median")])


@query("sink_report", check("typed", _OVERVIEW.format(source="typed")))
def sink_report(spark, sf_dir):
    report = market_overview(typed(spark, sf_dir), BY)
    folder = staging_path(spark, "report")
    save_report(report, folder)
    # a second save replaces the first
    return _overview(spark.read.parquet(save_report(report, folder)))


@query("dim_cities", check(("listings", "cities"), """SELECT city, clat AS center_latitude, clon AS center_longitude,
    currency, count(*) AS listings FROM listings JOIN cities USING (city) GROUP BY city, clat, clon, currency"""))
def dim_cities(spark, sf_dir):
    raw = listings(spark, sf_dir)
    sizes = raw.groupBy("city").agg(F.count(F.lit(1)).alias("listings"))
    joined = lookup_join(sizes, pin(city_frame(raw, RULES.cities)), ["city"], how="inner")
    return joined.select("city", "center_latitude", "center_longitude", "currency", "listings")


@query("select_columns", check("listings", "SELECT id, room_type, accommodates, price FROM listings"))
def select_columns_query(spark, sf_dir):
    return select_columns(listings(spark, sf_dir), ["id", "room_type", "accommodates", "price"])


@query("rename_columns", check("listings", """SELECT id, neighbourhood_cleansed AS district, host_is_superhost AS
    is_superhost, number_of_reviews AS number_ratings, estimated_revenue_l365d AS estimated_revenue FROM listings"""))
def rename_columns_query(spark, sf_dir):
    old = ["id", "neighbourhood_cleansed", "host_is_superhost", "number_of_reviews", "estimated_revenue_l365d"]
    return rename_columns(listings(spark, sf_dir).select(*old), LABEL_MAPPING)


@query("set_types", check("listings", f"""SELECT id, copy_order,
    round(CAST(replace(replace(trim(price), '$', ''), ',', '') AS DOUBLE), 6) AS price,
    CAST(estimated_revenue_l365d AS DOUBLE) AS estimated_revenue, CAST(beds AS DOUBLE) AS beds,
    CAST(bedrooms AS DOUBLE) AS bedrooms, CAST(minimum_nights AS DOUBLE) AS minimum_nights,
    {', '.join(f'round({c}, 6) AS {c}' for c in ('bathrooms', *SUBSCORES))} FROM listings"""))
def set_types_query(spark, sf_dir):
    df = set_types(rename_columns(listings(spark, sf_dir), LABEL_MAPPING), COLUMN_TYPES)
    whole = ["estimated_revenue", "beds", "bedrooms", "minimum_nights"]
    return df.select("id", "copy_order", rounded("price"), *whole, *[rounded(c) for c in ("bathrooms", *SUBSCORES)])


@query("convert_currency", check("typed", """SELECT city, id, copy_order, round(price, 6) AS price,
    round(estimated_revenue, 6) AS estimated_revenue FROM typed"""))
def convert_currency_query(spark, sf_dir):
    return typed(spark, sf_dir).select("city", "id", "copy_order", rounded("price"), rounded("estimated_revenue"))


@query("format_money", check("listings", """SELECT id, copy_order, cents_up,
    concat('€', format('{:,}', CAST(cents_up AS BIGINT)), '.00') AS shown, concat('€-', format('{:,}',
    CAST(cents_up AS BIGINT))) AS negative FROM (SELECT id, copy_order, estimated_revenue_l365d + 1 AS cents_up
    FROM listings)"""))
def format_money(spark, sf_dir):
    df = listings(spark, sf_dir).select("id", "copy_order", (F.col("estimated_revenue_l365d") + 1).alias("cents_up"))
    amount = F.col("cents_up").cast("double")
    return df.select("id", "copy_order", "cents_up", format_eur(amount, 2).alias("shown"),
                     format_eur(-amount).alias("negative"))


@query("label_terms", check("listings", """SELECT term, coalesce(label, term) AS label, n FROM (
    SELECT concat('room_type: ', room_type) AS term, count(*) AS n FROM listings GROUP BY room_type) LEFT JOIN
    (VALUES ('room_type: Private room', 'private room instead of entire home')) l(term, label) USING (term)"""))
def label_terms_query(spark, sf_dir):
    terms = listings(spark, sf_dir).groupBy(F.concat(F.lit("room_type: "), "room_type").alias("term")).agg(
        F.count(F.lit(1)).alias("n"))
    return label_terms(terms, "term", TERM_LABELS).select("term", "label", "n")


@query("dedupe_first", check("deduped", "SELECT city, id, copy_order, round(price, 6) AS price, district FROM deduped"))
def dedupe_first_query(spark, sf_dir):
    return deduped(spark, sf_dir).select("city", "id", "copy_order", rounded("price"), "district")


@query("drop_zero", check("typed", """SELECT city, id, copy_order FROM typed WHERE
    (estimated_revenue IS NULL OR estimated_revenue <> 0) AND (availability_365 IS NULL OR availability_365 <> 0)"""))
def drop_zero_query(spark, sf_dir):
    return drop_zero(typed(spark, sf_dir), ["estimated_revenue", "availability_365"]).select("city", "id", "copy_order")


@query("missing_drop", check("typed", """SELECT city, id, copy_order, round(review_scores_rating, 6) AS rating FROM typed
    WHERE review_scores_rating IS NOT NULL"""))
def missing_drop_query(spark, sf_dir):
    df = missing_drop(typed(spark, sf_dir), "review_scores_rating")
    return df.select("city", "id", "copy_order", rounded("review_scores_rating", "rating"))


@query("missing_fill_zero", check("typed", """SELECT city, id, copy_order,
    round(coalesce(reviews_per_month, 0), 6) AS reviews_per_month FROM typed"""))
def missing_fill_zero_query(spark, sf_dir):
    df = missing_fill_zero(typed(spark, sf_dir), "reviews_per_month")
    return df.select("city", "id", "copy_order", rounded("reviews_per_month"))


@query("impute_group_median", check("typed", """SELECT city, id, copy_order,
    coalesce(bedrooms, median(bedrooms) OVER (PARTITION BY city, room_type)) AS bedrooms,
    coalesce(beds, median(beds) OVER (PARTITION BY city, room_type)) AS beds FROM typed"""))
def impute_group_median_query(spark, sf_dir):
    df = impute_group_median(typed(spark, sf_dir), ["bedrooms", "beds"], "room_type", BY)
    return df.select("city", "id", "copy_order", "bedrooms", "beds")


@query("impute_or_drop_label", check("typed", """SELECT city, id, copy_order,
    coalesce(bedrooms, median(bedrooms) OVER (PARTITION BY city, room_type)) AS bedrooms FROM typed
    WHERE NOT (bedrooms IS NULL AND room_type = 'Entire home/apt')"""))
def impute_or_drop_label_query(spark, sf_dir):
    df = impute_or_drop_label(typed(spark, sf_dir), ["bedrooms"], "room_type", by=BY)
    return df.select("city", "id", "copy_order", "bedrooms")


@query("fill_from_text", check("typed", f"""SELECT city, id, copy_order, bathrooms, parsed FROM (
    SELECT city, id, copy_order, coalesce(bathrooms, {PARSE_BATHROOMS}) AS bathrooms, {PARSE_BATHROOMS} AS parsed
    FROM typed) WHERE bathrooms IS NOT NULL"""))
def fill_from_text_query(spark, sf_dir):
    df = fill_from_text(typed(spark, sf_dir), "bathrooms", "bathrooms_text")
    return df.select("city", "id", "copy_order", "bathrooms", parse_bathrooms(F.col("bathrooms_text")).alias("parsed"))


@query("missing_rules", check("filled", """SELECT city, id, copy_order, bedrooms, beds, bathrooms,
    round(reviews_per_month, 6) AS reviews_per_month FROM filled"""))
def missing_rules_query(spark, sf_dir):
    return fill(stage(booked(spark, sf_dir), "booked")).select(
        "city", "id", "copy_order", "bedrooms", "beds", "bathrooms", rounded("reviews_per_month"))


@query("outlier_fences", check("booked", """SELECT city, round(p1 - 1.5 * (p3 - p1), 6) AS lo_price,
    round(p3 + 1.5 * (p3 - p1), 6) AS hi_price, round(r1 - 1.5 * (r3 - r1), 6) AS lo_revenue,
    round(r3 + 1.5 * (r3 - r1), 6) AS hi_revenue FROM (SELECT city, quantile_cont(ln(price), 0.25) AS p1,
    quantile_cont(ln(price), 0.75) AS p3, quantile_cont(ln(estimated_revenue), 0.25) AS r1,
    quantile_cont(ln(estimated_revenue), 0.75) AS r3 FROM booked GROUP BY city)"""))
def outlier_fences_query(spark, sf_dir):
    fences = outlier_fences(booked(spark, sf_dir), RULES.outliers, BY)
    return fences.select("city", rounded("lo_price"), rounded("hi_price"),
                         rounded("lo_estimated_revenue", "lo_revenue"), rounded("hi_estimated_revenue", "hi_revenue"))


@query("outliers_iqr", check("booked", """, q AS (SELECT city, quantile_cont(ln(price), 0.25) AS p1,
    quantile_cont(ln(price), 0.75) AS p3, quantile_cont(ln(estimated_revenue), 0.25) AS r1,
    quantile_cont(ln(estimated_revenue), 0.75) AS r3 FROM booked GROUP BY city)
    SELECT city, id, round(price, 6) AS price, round(estimated_revenue, 6) AS estimated_revenue
    FROM booked JOIN q USING (city) WHERE ln(price) BETWEEN p1 - 1.5 * (p3 - p1) AND p3 + 1.5 * (p3 - p1)
      AND ln(estimated_revenue) BETWEEN r1 - 1.5 * (r3 - r1) AND r3 + 1.5 * (r3 - r1)"""))
def outliers_iqr(spark, sf_dir):
    df = drop_outliers(stage(booked(spark, sf_dir), "booked"), RULES.outliers, BY)
    return df.select("city", "id", rounded("price"), rounded("estimated_revenue"))


@query("filter_plausible", check("filled", """SELECT city, id, accommodates, bedrooms, beds, bathrooms FROM filled
    WHERE bedrooms <= accommodates AND bathrooms <= bedrooms + 2 AND beds <= 2 * accommodates"""))
def filter_plausible_query(spark, sf_dir):
    df = filter_plausible(fill(stage(booked(spark, sf_dir), "booked")), RULES.plausibility)
    return df.select("city", "id", "accommodates", "bedrooms", "beds", "bathrooms")
