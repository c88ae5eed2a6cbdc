"""SQL building blocks of the checks: the cleaning chain and the models as common table expressions."""

from __future__ import annotations

from ..rules import AMENITIES, DUMMY_RULES, SUBSCORES
from .fixture import APARTMENTS_SQL, FIXTURE_CITIES, LISTINGS_SQL, RULES

_RATES = RULES.currency.exchange_rates
_CITY_ROWS = ", ".join(
    f"('{n}', CAST({c.latitude} AS DOUBLE), CAST({c.longitude} AS DOUBLE), '{c.currency}', "
    f"CAST({_RATES[c.currency]} AS DOUBLE))" for n, c in FIXTURE_CITIES.items())
_SUBSCORE_LIST = ", ".join(SUBSCORES)
PARSE_BATHROOMS = ("CASE WHEN contains(lower(bathrooms_text), 'half') THEN 0.5 ELSE "
                   "TRY_CAST(split_part(trim(lower(bathrooms_text)), ' ', 1) AS DOUBLE) END")


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians({lat1}) - radians({lat2})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon1}) - radians({lon2})) / 2), 2))))")


def has_keyword(source: str, keywords) -> str:
    return " OR ".join(f"contains(lower({source}), '{k}')" for k in keywords)


_FLAGS = ", ".join(f"CASE WHEN {has_keyword(r.source, r.keywords)} THEN 1 ELSE 0 END AS {r.target}"
                   for r in DUMMY_RULES if r.source == "amenities")
_CAPPED = ", ".join(
    f"CASE WHEN {c} > cap_{c} THEN CAST(cap_{c} AS {t}) ELSE {c} END AS {c}"
    for c, t in (("accommodates", "INTEGER"), ("bedrooms", "DOUBLE"), ("beds", "DOUBLE"), ("bathrooms", "DOUBLE")))

PARTS = {
    "listings": LISTINGS_SQL,
    "apartments": APARTMENTS_SQL,
    "cities": f"cities(city, clat, clon, currency, rate) AS (VALUES {_CITY_ROWS})",
    "typed": f"""typed AS (
      SELECT city, copy_order, id, room_type, accommodates, CAST(beds AS DOUBLE) AS beds,
        CAST(bedrooms AS DOUBLE) AS bedrooms, bathrooms, bathrooms_text, latitude, longitude,
        neighbourhood_cleansed AS district, amenities, CAST(minimum_nights AS DOUBLE) AS minimum_nights,
        estimated_occupancy_l365d, availability_365, host_is_superhost AS is_superhost, review_scores_rating,
        number_of_reviews AS number_ratings, reviews_per_month, {_SUBSCORE_LIST},
        CAST(replace(replace(trim(price), '$', ''), ',', '') AS DOUBLE) * rate AS price,
        CAST(estimated_revenue_l365d AS DOUBLE) * rate AS estimated_revenue
      FROM listings JOIN cities USING (city))""",
    "deduped": """deduped AS (
      SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city, id ORDER BY copy_order,
        estimated_revenue, latitude, longitude, amenities) AS rn FROM typed) WHERE rn = 1)""",
    "booked": "booked AS (SELECT * FROM deduped WHERE estimated_revenue IS NULL OR estimated_revenue <> 0)",
    "filled": f"""
      m1 AS (SELECT * REPLACE (coalesce(reviews_per_month, 0) AS reviews_per_month) FROM booked
        WHERE price IS NOT NULL AND estimated_revenue IS NOT NULL AND is_superhost IS NOT NULL
          AND review_scores_rating IS NOT NULL),
      m2 AS (SELECT * REPLACE (coalesce(bedrooms, median(bedrooms) OVER (PARTITION BY city, room_type)) AS bedrooms)
        FROM m1 WHERE NOT (bedrooms IS NULL AND room_type = 'Entire home/apt')),
      m3 AS (SELECT * REPLACE (coalesce(beds, median(beds) OVER (PARTITION BY city, room_type)) AS beds)
        FROM m2 WHERE NOT (beds IS NULL AND room_type = 'Entire home/apt')),
      m4 AS (SELECT * REPLACE (coalesce(bathrooms, {PARSE_BATHROOMS}) AS bathrooms) FROM m3),
      filled AS (SELECT * FROM m4 WHERE bathrooms IS NOT NULL AND minimum_nights IS NOT NULL AND
        {' AND '.join(f'{c} IS NOT NULL' for c in SUBSCORES)})""",
    "clean": """
      open_days AS (SELECT * FROM filled WHERE availability_365 <> 0),
      quartiles AS (SELECT city, quantile_cont(ln(price), 0.25) AS p1, quantile_cont(ln(price), 0.75) AS p3,
        quantile_cont(ln(estimated_revenue), 0.25) AS r1, quantile_cont(ln(estimated_revenue), 0.75) AS r3
        FROM open_days GROUP BY city),
      clean AS (SELECT open_days.* FROM open_days JOIN quartiles USING (city)
        WHERE ln(price) BETWEEN p1 - 1.5 * (p3 - p1) AND p3 + 1.5 * (p3 - p1)
          AND ln(estimated_revenue) BETWEEN r1 - 1.5 * (r3 - r1) AND r3 + 1.5 * (r3 - r1)
          AND bedrooms <= accommodates AND bathrooms <= bedrooms + 2 AND beds <= 2 * accommodates)""",
    "caps": """caps AS (SELECT city, room_type, floor(quantile_cont(accommodates, 0.995)) AS cap_accommodates,
        floor(quantile_cont(bedrooms, 0.995)) AS cap_bedrooms, floor(quantile_cont(beds, 0.995)) AS cap_beds,
        floor(quantile_cont(bathrooms, 0.995)) AS cap_bathrooms FROM clean GROUP BY city, room_type)""",
    "capped": f"""capped AS (SELECT clean.* REPLACE ({_CAPPED}) FROM clean JOIN caps USING (city, room_type))""",
    "kept": "kept AS (SELECT city, district FROM capped GROUP BY city, district HAVING count(*) >= 40)",
    "centers": """centers AS (SELECT city, avg(accommodates) AS c_acc, avg(review_scores_rating) AS c_rating
        FROM capped GROUP BY city)""",
    "prepared": f"""prepared AS (
      SELECT city, id, copy_order, room_type, accommodates, bedrooms, beds, bathrooms, minimum_nights, price,
        estimated_revenue, estimated_occupancy_l365d, latitude, longitude, review_scores_rating, {_SUBSCORE_LIST},
        {_FLAGS}, CASE WHEN contains(lower(is_superhost), 't') THEN 1 ELSE 0 END AS is_superhost,
        CAST(estimated_occupancy_l365d AS DOUBLE) / 365 AS occupancy_rate,
        CAST(estimated_occupancy_l365d AS DOUBLE) / availability_365 AS ratio_occupancy_availability,
        {km('latitude', 'longitude', 'clat', 'clon')} AS proximity_city_center,
        CASE WHEN kept.district IS NULL THEN '_other' ELSE capped.district END AS district,
        pow(accommodates - c_acc, 2) AS accommodates_sq, pow(review_scores_rating - c_rating, 2) AS rating_sq
      FROM capped JOIN cities USING (city) JOIN centers USING (city)
        LEFT JOIN kept ON capped.city = kept.city AND capped.district = kept.district)""",
    # exact split of the de-duplicated rows
    "split": """split AS (
      SELECT * EXCLUDE (rn, n), rn > n - CAST(round_even(0.2 * n, 0) AS BIGINT) AS is_test FROM (
        SELECT *, row_number() OVER (PARTITION BY city ORDER BY md5(concat(CAST(id AS VARCHAR), ':42')), id) AS rn,
          count(*) OVER (PARTITION BY city) AS n FROM deduped))""",
    # the split, the size model and the price ranges at the end of the whole run
    "final_split": """final_split AS (
      SELECT * EXCLUDE (rn, n), rn > n - CAST(round_even(0.2 * n, 0) AS BIGINT) AS is_test FROM (
        SELECT *, row_number() OVER (PARTITION BY city ORDER BY md5(concat(CAST(id AS VARCHAR), ':42')), id) AS rn,
          count(*) OVER (PARTITION BY city) AS n FROM prepared)),
      train AS (SELECT * FROM final_split WHERE NOT is_test), test AS (SELECT * FROM final_split WHERE is_test)""",
    "inferred": """inferred AS (SELECT c.* REPLACE (CASE WHEN kept.district IS NULL THEN '_other' ELSE c.district END AS
        district), pow(review_scores_rating - c_rating, 2) AS rating_sq FROM (
      SELECT a.* REPLACE (least(accommodates, CAST(cap_accommodates AS INTEGER)) AS accommodates,
        least(bedrooms, cap_bedrooms) AS bedrooms, least(beds, cap_beds) AS beds, least(bathrooms, cap_bathrooms) AS bathrooms)
      FROM apartments a JOIN caps USING (city, room_type)) c
      JOIN centers USING (city) LEFT JOIN kept ON c.city = kept.city AND c.district = kept.district)""",
}
_NEEDS = {
    "typed": ("listings", "cities"), "deduped": ("typed",), "booked": ("deduped",), "filled": ("booked",),
    "clean": ("filled",), "caps": ("clean",), "capped": ("caps",), "kept": ("capped",), "centers": ("capped",),
    "prepared": ("kept", "centers"), "split": ("deduped",), "final_split": ("prepared",),
    "inferred": ("apartments", "caps", "kept", "centers"),
}


def one_number_model(x: str, source: str, prefix: str) -> str:
    """OLS of ln(price) on room type and one number, from within-group sums.

    Gives ``<prefix>_group`` (city, room_type, a: intercept, n, mx) and ``<prefix>_fit`` (city, slope, sxx, sse,
    n, dof, sigma2, smearing, base).
    """
    return f"""
      {prefix}_rows AS (SELECT city, room_type, CAST({x} AS DOUBLE) AS x, ln(price) AS y FROM {source}),
      {prefix}_mean AS (SELECT city, room_type, count(*) AS n, avg(x) AS mx, avg(y) AS my FROM {prefix}_rows
        GROUP BY city, room_type),
      {prefix}_slope AS (SELECT city, sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS slope,
        sum((x - mx) * (x - mx)) AS sxx FROM {prefix}_rows JOIN {prefix}_mean USING (city, room_type) GROUP BY city),
      {prefix}_group AS (SELECT city, room_type, m.n, mx, my - slope * mx AS a
        FROM {prefix}_mean m JOIN {prefix}_slope USING (city)),
      {prefix}_base AS (SELECT city, room_type AS base FROM (SELECT city, room_type, row_number() OVER
        (PARTITION BY city ORDER BY n DESC, room_type) AS rn FROM {prefix}_mean) WHERE rn = 1),
      {prefix}_fit AS (SELECT city, any_value(slope) AS slope, any_value(sxx) AS sxx, count(*) AS n,
        count(*) - count(DISTINCT room_type) - 1 AS dof,
        sum(pow(y - a - slope * x, 2)) / (count(*) - count(DISTINCT room_type) - 1) AS sigma2,
        avg(exp(y - a - slope * x)) AS smearing, any_value(base) AS base
        FROM {prefix}_rows JOIN {prefix}_group USING (city, room_type) JOIN {prefix}_slope USING (city)
          JOIN {prefix}_base USING (city) GROUP BY city),
      {prefix}_terms AS (
        SELECT city, '(Intercept)' AS term, a AS coef, sqrt(sigma2 * (1.0 / g.n + mx * mx / sxx)) AS se
        FROM {prefix}_group g JOIN {prefix}_fit f USING (city) WHERE room_type = base
        UNION ALL
        SELECT city, '{x}', slope, sqrt(sigma2 / sxx) FROM {prefix}_fit
        UNION ALL
        SELECT f.city, concat('room_type: ', g.room_type), g.a - b.a,
          sqrt(sigma2 * (1.0 / g.n + 1.0 / b.n + pow(g.mx - b.mx, 2) / sxx))
        FROM {prefix}_fit f JOIN {prefix}_group g ON f.city = g.city AND g.room_type <> f.base
          JOIN {prefix}_group b ON f.city = b.city AND b.room_type = f.base)"""


def t_value(z: float, dof: str) -> str:
    """Student-t quantile for many degrees of freedom from the normal quantile ``z`` (error below 1e-9)."""
    return (f"({z} + (pow({z}, 3) + {z}) / (4.0 * {dof}) + (5 * pow({z}, 5) + 16 * pow({z}, 3) + 3 * {z}) / "
            f"(96.0 * {dof} * {dof}) + (3 * pow({z}, 7) + 19 * pow({z}, 5) + 17 * pow({z}, 3) - 15 * {z}) / "
            f"(384.0 * {dof} * {dof} * {dof}))")


Z_90 = 1.2815515655446004
Z_975 = 1.959963984540054


def check(needs: str | tuple[str, ...], select: str, *extra: str) -> str:
    """``WITH`` everything ``needs`` depends on, then ``extra`` expressions, then ``select``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for inner in _NEEDS.get(name, ()):
            add(inner)
        if name not in ordered:
            ordered.append(name)

    for name in (needs,) if isinstance(needs, str) else needs:
        add(name)
    parts = [PARTS[n].strip() for n in ordered] + [e.strip() for e in extra]
    # a select that starts with a comma brings expressions of its own
    return f"WITH {', '.join(parts)}{'' if select.lstrip().startswith(',') else ' '}{select}"


AMENITY_LIST = ", ".join(AMENITIES)
