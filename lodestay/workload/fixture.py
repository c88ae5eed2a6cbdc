"""A listing-shaped table over the star schema, and the rules used with it.

The column expressions are plain SQL that Spark and other engines read alike, so the same text builds the
table for the registered queries and for the checking SQL.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import AMENITIES, CategoryRule, City, CurrencyRule, OccupancyRule, Rules

TABLES = ("lineitem", "orders", "customer", "nation", "region", "part")

HELPERS = {
    "acc": "CAST(l_quantity AS INT) % 16 + 1",
    "occ": "CAST(l_quantity AS INT) * 5",
    "bd": "CAST(l_partkey % 5 + 1 AS INT)",
    "ac": "CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END",
}
CENTS = ("(3000 + 1200 * acc + 900 * bd + 700 * ac + (l_orderkey * 7919 + l_linenumber * 104729) % 4000) * "
         "(CASE WHEN l_orderkey % 997 = 0 THEN 400 ELSE 1 END)")

_ITEMS = (
    ("ac = 1", "Air conditioning"), ("l_partkey % 3 = 0", "Washer"), ("l_partkey % 3 = 1", "Dishwasher"),
    ("l_suppkey % 4 = 0", "Pool"), ("l_suppkey % 4 = 1", "Pool table"), ("l_partkey % 8 = 0", "Balcony"),
    ("l_suppkey % 9 = 0", "Pets allowed"), ("l_orderkey % 2 = 0", "Kitchen"), ("l_orderkey % 3 = 0", "TV"),
    ("l_orderkey % 5 = 0", "Hot water kettle"), ("l_orderkey % 7 = 0", "Elevator"),
    ("l_orderkey % 11 = 0", "Self check-in"),
)
_AMENITIES = "concat('[\"Wifi\"', " + ", ".join(
    f"CASE WHEN {condition} THEN ', \"{name}\"' ELSE '' END" for condition, name in _ITEMS) + ", ']')"
_SMALL = "lpad(CAST(cents % 100 AS VARCHAR(20)), 2, '0')"
_PRICE = (
    "CASE WHEN cents >= 100000 THEN concat('$', CAST(CAST(floor(cents / 100000) AS BIGINT) AS VARCHAR(20)), ',', "
    "lpad(CAST(CAST(floor(cents / 100) AS BIGINT) % 1000 AS VARCHAR(20)), 3, '0'), '.', " + _SMALL + ") "
    "ELSE concat('$', CAST(CAST(floor(cents / 100) AS BIGINT) AS VARCHAR(20)), '.', " + _SMALL + ") END")


def _score(k: int) -> str:
    return f"4 + ((l_partkey * {k}) % 11) * CAST(0.1 AS DOUBLE)"


COLUMNS = {
    "id": "l_orderkey * 10 + l_linenumber",
    "city": "r_name",
    "room_type": ("CASE WHEN p_size <= 30 THEN 'Entire home/apt' WHEN p_size <= 47 THEN 'Private room' "
                  "WHEN p_size <= 49 THEN 'Shared room' ELSE 'Hotel room' END"),
    "accommodates": "acc",
    "bedrooms": "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE bd END",
    "beds": "CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_suppkey % 7 + 1 END",
    "bathrooms": "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE 1 + (l_suppkey % 4) * CAST(0.5 AS DOUBLE) END",
    "bathrooms_text": ("CASE l_partkey % 28 WHEN 0 THEN 'Half-bath' WHEN 7 THEN '1.5 shared baths' "
                       "WHEN 14 THEN 'Bathroom' WHEN 21 THEN '0 baths' ELSE '1 bath' END"),
    "neighbourhood_cleansed": ("CASE WHEN c_custkey % 50 = 0 THEN concat('D', CAST(c_custkey AS VARCHAR(20))) "
                               "ELSE n_name END"),
    "latitude": "CAST(37.9 AS DOUBLE) + (c_custkey % 97) * CAST(0.002 AS DOUBLE)",
    "longitude": "CAST(23.6 AS DOUBLE) + (c_custkey % 89) * CAST(0.003 AS DOUBLE)",
    "amenities": _AMENITIES,
    "minimum_nights": "l_linenumber + 1",
    "estimated_occupancy_l365d": "occ",
    "availability_365": "l_suppkey % 100 * 3",
    "host_is_superhost": ("CASE WHEN o_orderpriority = '1-URGENT' THEN 't' WHEN o_orderpriority = '5-LOW' "
                          "AND l_linenumber = 7 THEN NULL ELSE 'f' END"),
    "review_scores_rating": ("CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE 3 + (l_suppkey % 20) * "
                             "CAST(0.1 AS DOUBLE) END"),
    "number_of_reviews": "l_suppkey",
    "reviews_per_month": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax * 10 END",
    "review_scores_accuracy": _score(1),
    "review_scores_cleanliness": _score(2),
    "review_scores_checkin": _score(3),
    "review_scores_communication": _score(4),
    "review_scores_location": _score(5),
    "review_scores_value": "4 + (l_partkey % 9) * CAST(0.1 AS DOUBLE)",
    "price": _PRICE,
    "estimated_revenue_l365d": ("CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 0 "
                                "ELSE occ * CAST(floor(cents / 100) AS BIGINT) END"),
    # decides which copy of a listing is the first; not part of a listing
    "copy_order": "l_partkey * 100000000 + l_suppkey * 1000 + CAST(l_quantity AS INT)",
}

# one apartment to price per customer: the whole customer table
APARTMENT_HELPERS = {
    "acc": "CAST(c_custkey % 16 + 1 AS INT)",
    "bd": "CAST((c_custkey * 7) % 5 + 1 AS INT)",
    "mix": "(c_custkey * 7919 + c_nationkey * 104729) % 1009",
}


def _flag(k: int) -> str:
    return f"CAST((c_custkey * {k}) % 11 % 2 AS INT)"


APARTMENT_COLUMNS = {
    "id": "c_custkey",
    "city": "r_name",
    "room_type": ("CASE WHEN mix <= 605 THEN 'Entire home/apt' WHEN mix <= 940 THEN 'Private room' "
                  "WHEN mix <= 980 THEN 'Shared room' ELSE 'Hotel room' END"),
    "district": "CASE WHEN c_custkey % 50 = 0 THEN concat('D', CAST(c_custkey AS VARCHAR(20))) ELSE n_name END",
    "latitude": "CAST(37.9 AS DOUBLE) + mix * CAST(0.0002137 AS DOUBLE)",
    "longitude": "CAST(23.6 AS DOUBLE) + ((c_custkey * 31) % 881) * CAST(0.0003371 AS DOUBLE)",
    "accommodates": "acc",
    "bedrooms": "CAST(bd AS DOUBLE)",
    "beds": "CAST(c_custkey % 7 + 1 AS DOUBLE)",
    "bathrooms": "1 + (c_custkey % 4) * CAST(0.5 AS DOUBLE)",
    "minimum_nights": "CAST(c_custkey % 7 + 2 AS DOUBLE)",
    "is_superhost": "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END",
    "review_scores_rating": "3 + (c_custkey % 20) * CAST(0.1 AS DOUBLE)",
    "estimated_occupancy_l365d": "CAST(mix % 250 + 1 AS INT)",
    "availability_365": "CAST(c_custkey % 99 + 1 AS INT)",
    "price": "(3000 + 1200 * acc + 900 * bd + (mix * 17) % 6000) / CAST(100 AS DOUBLE) * CAST(0.9 AS DOUBLE)",
    "group": "CASE WHEN c_nationkey % 2 = 0 THEN 'listed' ELSE 'new' END",
    **{name: _flag(k) for k, name in enumerate(AMENITIES, start=2)},
}

LISTINGS_SQL = f"""
base AS (
  SELECT *, {CENTS} AS cents FROM (
    SELECT *, {', '.join(f'{expr} AS {name}' for name, expr in HELPERS.items())}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      JOIN part ON l_partkey = p_partkey) joined),
listings AS (SELECT {', '.join(f'{expr} AS "{name}"' for name, expr in COLUMNS.items())} FROM base)"""

APARTMENTS_SQL = f"""
apartments AS (
  SELECT {', '.join(f'{expr} AS "{name}"' for name, expr in APARTMENT_COLUMNS.items())} FROM (
    SELECT *, {', '.join(f'{expr} AS {name}' for name, expr in APARTMENT_HELPERS.items())}
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) joined)"""

FIXTURE_CITIES = {
    "AFRICA": City(37.95, 23.70, "USD"),
    "AMERICA": City(38.00, 23.75, "USD"),
    "ASIA": City(37.98, 23.65, "USD"),
    "EUROPE": City(37.9838, 23.7275, "EUR"),
    "MIDDLE EAST": City(38.05, 23.80, "EUR"),
}
BY = ("city",)
RULES = replace(
    Rules(), cities=FIXTURE_CITIES, currency=CurrencyRule(("price", "estimated_revenue"), "EUR", {"USD": 0.89, "EUR": 1.0}),
    category=CategoryRule("district", 40), occupancy=OccupancyRule(("district", "room_type"), 20, "room_type", 0.75))
# copies of a listing have equal ids; which one is first is decided by all their differences
ORDER = ("copy_order", "estimated_revenue", "latitude", "longitude", "amenities")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing table. Only the columns a query uses are read from the star schema."""
    t = {name: table(spark, sf_dir, name) for name in TABLES}
    joined = (t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
              .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
              .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
              .join(t["part"], F.col("l_partkey") == F.col("p_partkey")))
    base = joined.withColumns({n: F.expr(e) for n, e in HELPERS.items()}).withColumn("cents", F.expr(CENTS))
    return base.select(*[F.expr(e).alias(n) for n, e in COLUMNS.items()])


def apartments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apartments to price: one per customer."""
    t = {name: table(spark, sf_dir, name) for name in ("customer", "nation", "region")}
    joined = (t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
              .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")))
    base = joined.withColumns({n: F.expr(e) for n, e in APARTMENT_HELPERS.items()})
    return base.select(*[F.expr(e).alias(n) for n, e in APARTMENT_COLUMNS.items()])
