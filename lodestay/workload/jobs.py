"""Whole runs: training, analysis, inference, prediction, reports, streaming."""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import functions as F

from ..operators.effects import coefficients
from ..operators.moments import INTERCEPT, feature, response
from ..operators.regression import fit_moments, linear_predictors
from ..plans.analysis import analysis_run
from ..plans.findings import market_findings, market_job
from ..plans.scoring import prediction_run, pricing_report
from ..plans.snapshots import add_counts, add_moments, fitted_from_counts, merged_moments
from ..plans.training import clean_listings, inference_run, training_run
from ..plans.versions import publish_version
from ..rules import AMENITIES, STATUS_MESSAGES
from ..sources.staging import stage, staging_path
from ..streaming.scorer import stream_refreshed, stream_score
from .checks import Z_90, check, km, one_number_model, t_value
from .fixture import BY, ORDER, RULES, apartments, listings
from .modelling import BASES, SIZE, split_rows
from .registry import query, rounded

train = partial(training_run, rules=RULES, by=BY, order_by=ORDER, keep=("copy_order",), drop_text=True)
_FLOATS = ("bathrooms", "beds", "bedrooms", "accommodates_sq", "rating_sq", "proximity_city_center", "occupancy_rate",
           "ratio_occupancy_availability", "price", "estimated_revenue", "minimum_nights")
_WHOLE = ("city", "id", "room_type", "district", "accommodates", "is_superhost", *AMENITIES)


@query("training_run", check("prepared", f"""SELECT {', '.join(_WHOLE)}, {', '.join(f'round({c}, 6) AS {c}' for c in _FLOATS)}
    FROM prepared"""))
def training_run_query(spark, sf_dir):
    df, _ = train(listings(spark, sf_dir))
    return df.select(*_WHOLE, *[rounded(c) for c in _FLOATS])


_TRAIN_SIDE = """
  clean_split AS (SELECT * EXCLUDE (rn, n), rn > n - CAST(round_even(0.2 * n, 0) AS BIGINT) AS is_test FROM (
    SELECT *, row_number() OVER (PARTITION BY city ORDER BY md5(concat(CAST(id AS VARCHAR), ':42')), id) AS rn,
      count(*) OVER (PARTITION BY city) AS n FROM clean)),
  t_caps AS (SELECT city, room_type, floor(quantile_cont(accommodates, 0.995)) AS cap FROM clean_split WHERE NOT is_test GROUP BY city, room_type),
  t_capped AS (SELECT c.* REPLACE (CASE WHEN accommodates > cap THEN CAST(cap AS INTEGER) ELSE accommodates END AS accommodates)
    FROM clean_split c LEFT JOIN t_caps USING (city, room_type)),
  t_kept AS (SELECT city, district FROM clean_split WHERE NOT is_test GROUP BY city, district HAVING count(*) >= 40),
  t_centers AS (SELECT city, avg(accommodates) AS c_acc, avg(review_scores_rating) AS c_rating FROM t_capped WHERE NOT is_test GROUP BY city)"""


@query("training_run_train", check("clean", """SELECT c.city, id, is_test, accommodates,
    CASE WHEN k.district IS NULL THEN '_other' ELSE c.district END AS district, round(pow(accommodates - c_acc, 2), 6) AS accommodates_sq,
    round(pow(review_scores_rating - c_rating, 2), 6) AS rating_sq
    FROM t_capped c JOIN t_centers USING (city) LEFT JOIN t_kept k ON k.city = c.city AND k.district = c.district""", _TRAIN_SIDE))
def training_run_train(spark, sf_dir):
    df, _ = train(listings(spark, sf_dir), fit_on="train")
    return df.select("city", "id", "is_test", "accommodates", "district", rounded("accommodates_sq"), rounded("rating_sq"))


def _snapshots(rows):
    """A table as three snapshots of unlike sizes."""
    return {name: rows.filter(f"id % 10 {which}") for name, which in (("first", "< 2"), ("second", "= 2"), ("third", "> 2"))}


@query("training_run_snapshots", check(("caps", "kept", "centers"), """
    SELECT city, 'cap' AS learned, room_type AS name, cap_accommodates AS value, cap_bedrooms AS bedrooms, cap_beds AS beds, cap_bathrooms AS bathrooms FROM caps
    UNION ALL SELECT city, 'kept', district, NULL, NULL, NULL, NULL FROM kept
    UNION ALL SELECT city, 'accommodates', NULL, round(c_acc, 6), NULL, NULL, NULL FROM centers
    UNION ALL SELECT city, 'review_scores_rating', NULL, round(c_rating, 6), NULL, NULL, NULL FROM centers"""))
def training_run_snapshots(spark, sf_dir):
    clean = stage(clean_listings(listings(spark, sf_dir), RULES, by=BY, order_by=ORDER, keep=("copy_order",)), "clean")
    root = staging_path(spark, "snapshots")
    for name, rows in _snapshots(clean).items():
        add_counts(rows, root, name, RULES, by=BY)
    fitted = fitted_from_counts(spark, root, RULES, by=BY)
    none = F.lit(None).cast("double")

    def told(table, learned, name, value):
        caps = [F.col(f"cap_{c}") if learned == "cap" else none for c in ("bedrooms", "beds", "bathrooms")]
        return table.frame.select("city", F.lit(learned).alias("learned"), name.cast("string").alias("name"), value.alias("value"),
                                  *[c.alias(n) for c, n in zip(caps, ("bedrooms", "beds", "bathrooms"))])

    out = told(fitted.caps, "cap", F.col("room_type"), F.col("cap_accommodates")).unionByName(told(fitted.kept, "kept", F.col("district"), none))
    for c in ("accommodates", "review_scores_rating"):
        out = out.unionByName(told(fitted.centers, c, F.lit(None), rounded(f"center_{c}")))
    return out


@query("ols_fit_snapshots", check("split", """SELECT city, term, round(coef, 6) AS coef, round(se, 6) AS se, n, dof,
    round(sigma2, 6) AS sigma2 FROM s_terms JOIN s_fit USING (city)""", "train AS (SELECT * FROM split WHERE NOT is_test)",
    one_number_model("accommodates", "train", "s")))
def ols_fit_snapshots(spark, sf_dir):
    root = staging_path(spark, "snapshots")
    for name, rows in _snapshots(split_rows(spark, sf_dir).filter(~F.col("is_test"))).items():
        add_moments(rows, root, name, [SIZE], by=BY)
    fit = fit_moments(merged_moments(spark, root), [SIZE], reference_levels=BASES)
    return coefficients(fit, "size").join(fit.of("size").select("city", "n", "dof", "sigma2"), "city").select(
        "city", "term", rounded("coef"), rounded("se"), "n", "dof", rounded("sigma2"))


_INFERRED = ("accommodates_sq", "rating_sq", "proximity_city_center", "occupancy_rate", "ratio_occupancy_availability",
             "bedrooms", "beds", "bathrooms")


@query("inference_run", check(("caps", "kept", "centers", "apartments", "cities"), f"""SELECT id, room_type, accommodates,
    CASE WHEN kept.district IS NULL THEN '_other' ELSE c.district END AS district,
    round(pow(accommodates - c_acc, 2), 6) AS accommodates_sq, round(pow(review_scores_rating - c_rating, 2), 6) AS rating_sq,
    round({km('latitude', 'longitude', 'clat', 'clon')}, 6) AS proximity_city_center,
    round(CAST(estimated_occupancy_l365d AS DOUBLE) / 365, 6) AS occupancy_rate,
    round(CAST(estimated_occupancy_l365d AS DOUBLE) / availability_365, 6) AS ratio_occupancy_availability,
    bedrooms, beds, bathrooms
    FROM (SELECT a.* REPLACE (least(accommodates, CAST(cap_accommodates AS INTEGER)) AS accommodates,
      least(bedrooms, cap_bedrooms) AS bedrooms, least(beds, cap_beds) AS beds, least(bathrooms, cap_bathrooms) AS bathrooms)
      FROM apartments a JOIN caps USING (city, room_type)) c
    JOIN cities USING (city) JOIN centers USING (city) LEFT JOIN kept ON c.city = kept.city AND c.district = kept.district"""))
def inference_run_query(spark, sf_dir):
    _, fitted = train(listings(spark, sf_dir))
    df = inference_run(apartments(spark, sf_dir), fitted, RULES)
    return df.select("id", "room_type", "accommodates", "district", *[rounded(c) for c in _INFERRED])


@query("prediction_inputs", check("prepared", """SELECT city, count(*) AS listings, round(avg(price), 6) AS price,
    CAST(sum(has_pool) AS BIGINT) AS pools, CAST(sum(is_superhost) AS BIGINT) AS superhosts,
    count(DISTINCT district) AS districts FROM prepared GROUP BY city"""))
def prediction_inputs(spark, sf_dir):
    df, _ = train(listings(spark, sf_dir))
    return df.groupBy("city").agg(
        F.count(F.lit(1)).alias("listings"), F.round(F.avg("price"), 6).alias("price"), F.sum("has_pool").alias("pools"),
        F.sum("is_superhost").alias("superhosts"), F.count_distinct("district").alias("districts"))


def analysed(spark, sf_dir, rules=RULES):
    df, fitted = train(listings(spark, sf_dir))
    return analysis_run(df, rules, by=BY), fitted


# the same runs with models that have a closed form in SQL
SMALL = replace(RULES, models=tuple(replace(m, predictors=("room_type", "accommodates"), log1p_predictors=())
                                    for m in RULES.models))
_SMALL_SQL = one_number_model("accommodates", "train", "s")
_SMALL_RANGE = f"""ranged AS (SELECT r.*, exp(linear) AS median, exp(linear) * smearing AS mean, exp(linear - half) AS lower,
    exp(linear + half) AS upper FROM (SELECT a.*, smearing, g.a + slope * accommodates AS linear,
      {t_value(Z_90, 'dof')} * sqrt(sigma2 * (1 + 1.0 / g.n + pow(accommodates - mx, 2) / sxx)) AS half
    FROM inferred a JOIN s_group g USING (city, room_type) JOIN s_fit USING (city)) r)"""
_SMALL_REFERENCE = """
  fine AS (SELECT city, district, room_type, count(*) AS n, quantile_cont(occupancy_rate, 0.5) AS q50,
    quantile_cont(occupancy_rate, 0.75) AS q75 FROM train GROUP BY city, district, room_type),
  coarse AS (SELECT city, room_type, quantile_cont(occupancy_rate, 0.5) AS q50, quantile_cont(occupancy_rate, 0.75) AS q75
    FROM train GROUP BY city, room_type),
  referenced AS (SELECT a.*, CASE WHEN fine.n >= 20 THEN fine.q50 ELSE coarse.q50 END AS reference,
    CASE WHEN fine.n >= 20 THEN fine.q75 ELSE coarse.q75 END AS high_reference, a.estimated_occupancy_l365d / 365.0 AS own
    FROM ranged a JOIN coarse USING (city, room_type) LEFT JOIN fine ON a.city = fine.city
      AND a.district = fine.district AND a.room_type = fine.room_type)"""


_SMALL_SCORES = check("final_split", """SELECT city, count(*) AS n,
    round(1 - sum(pow(y - linear, 2)) / (var_pop(y) * count(*)), 6) AS r2_model_scale,
    round(1 - sum(pow(price - predicted, 2)) / (var_pop(price) * count(*)), 6) AS r2,
    round(median(abs(price - predicted)), 6) AS median_ae, round(avg(abs(price - predicted)), 6) AS mae
    FROM scored GROUP BY city""", _SMALL_SQL, """scored AS (SELECT test.city, price, ln(price) AS y,
      a + slope * accommodates AS linear, exp(a + slope * accommodates) * smearing AS predicted
      FROM test JOIN s_group USING (city, room_type) JOIN s_fit USING (city))""")


@query("market_job_small", _SMALL_SCORES)
def market_job_small(spark, sf_dir):
    scores = market_job(listings(spark, sf_dir), SMALL, by=BY, order_by=ORDER, keep=("copy_order",)).filter("model = 'price'")
    return scores.select("city", "n", *[rounded(c) for c in ("r2_model_scale", "r2", "median_ae", "mae")])


@query("market_findings_small", check("final_split", """
    SELECT city, section, line, label, round(value, 6) AS value FROM (
      SELECT city, 'overview' AS section, unnest(range(5))::INTEGER AS line,
        unnest(['listings', 'median price', 'first quartile price', 'third quartile price', 'median revenue']) AS label,
        unnest([count(*)::DOUBLE, median(price), quantile_cont(price, 0.25), quantile_cont(price, 0.75), median(estimated_revenue)]) AS value
      FROM final_split GROUP BY city
      UNION ALL SELECT city, 'model quality', 1, 'price', 1 - sum(pow(ln(price) - a - slope * accommodates, 2)) / (var_pop(ln(price)) * count(*))
      FROM test JOIN s_group USING (city, room_type) JOIN s_fit USING (city) GROUP BY city)""", _SMALL_SQL))
def market_findings_small(spark, sf_dir):
    found = market_findings(analysed(spark, sf_dir, SMALL)[0], replace(SMALL, importance_groups={"size": ("accommodates",)}))
    shown = (F.col("section") == "overview") | ((F.col("section") == "model quality") & (F.col("label") == "price"))
    return found.filter(shown).select("city", "section", "line", "label", rounded("value"))


@query("analysis_run_small", _SMALL_SCORES)
def analysis_run_small(spark, sf_dir):
    scores = analysed(spark, sf_dir, SMALL)[0].scores.filter("model = 'price'")
    return scores.select("city", "n", *[rounded(c) for c in ("r2_model_scale", "r2", "median_ae", "mae")])


@query("prediction_run_small", check(("final_split", "inferred"), f"""SELECT city, id, "group" AS listing_group, district,
    room_type, round(median, 6) AS median, round(mean, 6) AS mean, round(lower, 6) AS lower, round(upper, 6) AS upper,
    round(nights, 6) AS nights, round(mean * nights, 2) AS revenue, CASE WHEN "group" = 'listed' THEN
      CASE WHEN price < lower THEN CASE WHEN own >= high_reference THEN 'underpriced' ELSE 'not_price_problem' END
      WHEN price > upper THEN CASE WHEN own >= high_reference THEN 'unexplained_premium' ELSE 'overpriced' END
      ELSE 'in_line' END END AS status, round(near_km, 6) AS near_km
    FROM (SELECT *, CASE WHEN "group" = 'listed' THEN estimated_occupancy_l365d ELSE reference * 365 END AS nights
      FROM referenced) JOIN near USING (id)""", _SMALL_SQL, _SMALL_RANGE, _SMALL_REFERENCE, f"""
    near AS (SELECT id, sum(distance_km) AS near_km FROM (SELECT id, distance_km, row_number() OVER (PARTITION BY id
      ORDER BY distance_km) AS rn FROM (SELECT a.id,
        {km('l.latitude', 'l.longitude', 'a.latitude', 'a.longitude')} AS distance_km,
        coalesce(l.bedrooms = a.bedrooms, FALSE) AS same,
        count(CASE WHEN l.bedrooms = a.bedrooms THEN 1 END) OVER (PARTITION BY a.id) AS n_same
        FROM inferred a JOIN train l ON a.city = l.city AND a.room_type = l.room_type)
      WHERE same OR n_same < 5) WHERE rn <= 5 GROUP BY id)"""))
def prediction_run_small(spark, sf_dir):
    analysis, fitted = analysed(spark, sf_dir, SMALL)
    df = prediction_run(inference_run(apartments(spark, sf_dir), fitted, SMALL), analysis, SMALL)
    near = F.aggregate("comparables", F.lit(0.0), lambda acc, c: acc + c["distance_km"])
    return df.select("city", "id", F.col("group").alias("listing_group"), "district", "room_type",
                     *[rounded(f"price_range.{c}", c) for c in ("median", "mean", "lower", "upper")], rounded("nights"),
                     rounded("revenue.estimate", "revenue", 2), "assessment.status", rounded(near, "near_km"))


_STATUS = """CASE WHEN "group" = 'listed' THEN
      CASE WHEN price < lower THEN CASE WHEN own >= high_reference THEN 'underpriced' ELSE 'not_price_problem' END
      WHEN price > upper THEN CASE WHEN own >= high_reference THEN 'unexplained_premium' ELSE 'overpriced' END
      ELSE 'in_line' END END"""
_MESSAGES = ", ".join(f"('{k}', '{v}')" for k, v in STATUS_MESSAGES.items())


@query("pricing_report_small", check(("final_split", "inferred"), f"""SELECT city, id,
    CASE WHEN district = '_other' THEN 'other districts' ELSE district END AS district, room_type, status,
    round(CASE WHEN "group" = 'listed' THEN greatest(lower - price, price - upper, 0.0) END, 6) AS difference,
    CASE WHEN price < lower THEN 'below the range' WHEN price > upper THEN 'above the range' ELSE 'inside the range' END AS position, message
    FROM (SELECT *, {_STATUS} AS status FROM referenced) JOIN messages USING (status) UNION ALL
    SELECT city, id, CASE WHEN district = '_other' THEN 'other districts' ELSE district END, room_type, NULL, NULL, NULL, NULL
    FROM referenced WHERE "group" <> 'listed'""", _SMALL_SQL, _SMALL_RANGE, _SMALL_REFERENCE,
    f"messages(status, message) AS (VALUES {_MESSAGES})"))
def pricing_report_small(spark, sf_dir):
    analysis, fitted = analysed(spark, sf_dir, SMALL)
    bundle = prediction_run(inference_run(apartments(spark, sf_dir), fitted, SMALL), analysis, SMALL)
    return pricing_report(bundle, SMALL).select("city", "id", "district", "room_type", "status", rounded("difference"), "position", "message")


@query("analysis_run")
def analysis_run_query(spark, sf_dir):
    return analysed(spark, sf_dir)[0].scores


@query("ols_fit_full")
def ols_fit_full(spark, sf_dir):
    return coefficients(analysed(spark, sf_dir)[0].fits)


_CATEGORIES = ("room_type", "district")
_PRICE = RULES.model("price")


@query("normal_equations_full", check("final_split", "SELECT city, term, 0.0::DOUBLE AS imbalance, n FROM (" + " UNION ALL ".join(
    [f"SELECT city, '{t}' AS term, count(*) AS n FROM train GROUP BY city" for t in (INTERCEPT, *(c for c in _PRICE.predictors if c not in _CATEGORIES))]
    + [f"SELECT city, concat('{c}: ', {c}), count(*) FROM train GROUP BY city, {c}" for c in _CATEGORIES]) + ")"))
def normal_equations_full(spark, sf_dir):
    """Least squares with every predictor has no closed form, but its residuals are orthogonal to each column: shown for every term of the price model."""
    analysis, _ = analysed(spark, sf_dir)
    scored = linear_predictors(analysis.train, analysis.fits, ["price"]).withColumn("e", response(_PRICE) - F.col("linear_price"))
    parts = [F.struct(F.lit(INTERCEPT).alias("term"), F.lit(1.0).alias("x"))]
    parts += [F.struct(F.concat(F.lit(f"{c}: "), c).alias("term"), F.lit(1.0).alias("x")) if c in analysis.fits.categories else
              F.struct(F.lit(c).alias("term"), feature(c, _PRICE).alias("x")) for c in _PRICE.predictors]
    long = scored.select("city", "e", F.inline(F.array(*parts)))
    size = F.sqrt(F.sum(F.col("x") * F.col("x")) * F.sum(F.col("e") * F.col("e")))
    imbalance = F.round(F.abs(F.coalesce(F.sum(F.col("x") * F.col("e")) / F.nullif(size, F.lit(0.0)), F.lit(0.0))), 6)
    return long.groupBy("city", "term").agg(imbalance.alias("imbalance"), F.count(F.lit(1)).alias("n"))


@query("group_importance_full")
def group_importance_full(spark, sf_dir):
    return analysed(spark, sf_dir)[0].importance(RULES)


def predicted(spark, sf_dir):
    analysis, fitted = analysed(spark, sf_dir)
    return prediction_run(inference_run(apartments(spark, sf_dir), fitted, RULES), analysis, RULES)


@query("prediction_run")
def prediction_run_query(spark, sf_dir):
    df = predicted(spark, sf_dir)
    return df.select("city", "id", "group", "district", "room_type", "price_range.median", "price_range.mean",
                     "price_range.lower", "price_range.upper", "nights", F.col("revenue.estimate").alias("revenue"),
                     "assessment.status", "superhost", F.size("tips").alias("n_tips"),
                     F.size("comparables").alias("n_comparables"))


@query("pricing_report")
def pricing_report_query(spark, sf_dir):
    report = pricing_report(predicted(spark, sf_dir), RULES)
    return report.select("city", "id", "district", "room_type", "status", "difference", "position", "message",
                         F.to_json("tips").alias("tips"), F.to_json("rating_tips").alias("rating_tips"),
                         F.to_json("comparables").alias("comparables"))


@query("market_findings")
def market_findings_query(spark, sf_dir):
    return market_findings(analysed(spark, sf_dir)[0], RULES)


@query("market_job")
def market_job_query(spark, sf_dir):
    return market_job(listings(spark, sf_dir), RULES, by=BY, order_by=ORDER, keep=("copy_order",))


@query("stream_score", check(("final_split", "inferred"), """SELECT city, id,
    CASE WHEN ok THEN round(median, 6) END AS median, CASE WHEN ok THEN round(mean, 6) END AS mean,
    CASE WHEN ok THEN round(lower, 6) END AS lower, CASE WHEN ok THEN round(upper, 6) END AS upper,
    CASE WHEN NOT ok THEN 'missing accommodates' END AS reject_reason
    FROM (SELECT *, review_scores_rating > 3 AS ok FROM ranged)""", _SMALL_SQL, _SMALL_RANGE))
def stream_score_query(spark, sf_dir):
    analysis, fitted = analysed(spark, sf_dir, SMALL)
    # a feed has gaps: the worst-rated apartments do not say how many guests they take and are rejected
    feed = apartments(spark, sf_dir).withColumn(
        "accommodates", F.when(F.col("review_scores_rating") > 3, F.col("accommodates")))
    path = staging_path(spark, "feed")
    feed.write.parquet(path)
    source = spark.readStream.schema(feed.schema).parquet(path)
    output = staging_path(spark, "stream")
    run = stream_score(source, fitted, analysis, output=output, checkpoint=staging_path(spark, "progress"), rules=SMALL)
    run.awaitTermination()
    scored = spark.read.parquet(f"{output}/scored").withColumn("reject_reason", F.lit(None).cast("string"))
    rejected = spark.read.parquet(f"{output}/rejected")
    shown = ["city", "id", *[rounded(c) for c in ("median", "mean", "lower", "upper")], "reject_reason"]
    return scored.select(*shown).unionByName(rejected.select(*shown))


_OPENED_LATER = min(RULES.cities)


@query("stream_refreshed", check(("final_split", "inferred"), f"""SELECT city, id, CASE WHEN ok THEN round(median, 6) END AS median,
    CASE WHEN ok THEN round(lower, 6) END AS lower, CASE WHEN ok THEN round(upper, 6) END AS upper,
    CASE WHEN NOT ok THEN 'unknown category or city' END AS reject_reason, 2 - early AS fit_version
    FROM (SELECT *, early = 0 OR city <> '{_OPENED_LATER}' AS ok FROM (SELECT *, CASE WHEN id % 2 = 0 THEN 1 ELSE 0 END AS early FROM ranged))""",
                                 _SMALL_SQL, _SMALL_RANGE))
def stream_refreshed_query(spark, sf_dir):
    """One city's models arrive as a second version, between the micro-batches of even and of odd ids."""
    analysis, fitted = analysed(spark, sf_dir, SMALL)
    fits, versions, path = analysis.fits, staging_path(spark, "versions"), staging_path(spark, "feed")
    feed = apartments(spark, sf_dir)
    without = {n: replace(getattr(fits, n), frame=getattr(fits, n).frame.filter(F.col("city") != _OPENED_LATER)) for n in ("table", "levels")}
    publish_version(fitted, replace(fits, **without), versions)
    feed.filter("id % 2 = 0").write.parquet(path)
    output = staging_path(spark, "stream")
    run = stream_refreshed(spark.readStream.schema(feed.schema).parquet(path), versions, output=output, checkpoint=staging_path(spark, "progress"),
                           rules=SMALL, available_now=False)
    try:
        run.processAllAvailable()
        publish_version(fitted, fits, versions)
        feed.filter("id % 2 <> 0").write.mode("append").parquet(path)
        run.processAllAvailable()
    finally:
        run.stop()
    scored = spark.read.parquet(f"{output}/scored").withColumn("reject_reason", F.lit(None).cast("string"))
    rejected = spark.read.parquet(f"{output}/rejected")
    ok = F.col("reject_reason").isNull()
    shown = ["city", "id", *[F.when(ok, rounded(c)).alias(c) for c in ("median", "lower", "upper")], "reject_reason",
             F.substring("fit_version", 1, 12).cast("int").alias("fit_version")]
    return scored.select(*shown).unionByName(rejected.select(*shown))
