"""Queries over splitting, fitting, predicting and scoring.

The checked models have one number and the room type, for which ordinary least squares has a closed form in
SQL (sums within room types); the models with every predictor run in ``jobs``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.effects import (amenity_effects, coefficients, rating_effects, significant_terms, superhost_tip,
                                 term_effects)
from ..operators.features import keyword_dummies
from ..operators.regression import (fit_models, group_importance, log_transforms, model_scores, predict,
                                    predicted_vs_actual, price_range, r2)
from ..operators.split import split_exact
from ..rules import MOST_COMMON, ModelSpec
from ..sources.staging import stage
from .checks import Z_90, Z_975, check, has_keyword, one_number_model, t_value
from .cleaning import deduped, typed
from .fixture import BY, RULES, apartments
from .registry import query, rounded

SIZE = ModelSpec("size", "price", ("room_type", "accommodates"))
COOL = ModelSpec("cool", "price", ("room_type", "has_AC"))
BASES = {"room_type": MOST_COMMON}


def split_rows(spark, sf_dir):
    columns = ["city", "id", "room_type", "accommodates", "price", "estimated_occupancy_l365d", "district", "latitude",
               "longitude", "bedrooms", "review_scores_rating", "minimum_nights", "amenities"]
    marked = split_exact(stage(deduped(spark, sf_dir).select(*columns), "rows"), 0.2, seed=42, by=BY)
    return stage(marked, "split")


def sides(spark, sf_dir):
    rows = split_rows(spark, sf_dir)
    return rows.filter(~F.col("is_test")), rows.filter("is_test")


_TRAIN = "train AS (SELECT * FROM split WHERE NOT is_test), test AS (SELECT * FROM split WHERE is_test)"
_SIZE_SQL = one_number_model("accommodates", "train", "s")
_AC = next(r for r in RULES.dummies if r.target == "has_AC")
_COOL_ROWS = (f"cool AS (SELECT *, CASE WHEN {has_keyword('amenities', _AC.keywords)} THEN 1 ELSE 0 END AS has_AC "
              "FROM train)")
_COOL_SQL = one_number_model("has_AC", "cool", "s")


@query("split_exact", check("split", "SELECT city, id, is_test FROM split"))
def split_exact_query(spark, sf_dir):
    return split_exact(stage(deduped(spark, sf_dir).select("city", "id"), "keys"), 0.2, seed=42, by=BY).select(
        "city", "id", "is_test")


@query("split_last", check("deduped", """SELECT city, id, rn > n - CAST(round_even(0.2 * n, 0) AS BIGINT) AS is_test FROM
    (SELECT city, id, row_number() OVER (PARTITION BY city ORDER BY id) AS rn, count(*) OVER (PARTITION BY city) AS n
    FROM deduped)"""))
def split_last(spark, sf_dir):
    keys = stage(deduped(spark, sf_dir).select("city", "id"), "keys")
    return split_exact(keys, 20, by=BY, random_selection=False).select("city", "id", "is_test")


@query("log_transforms", check("typed", """SELECT city, id, copy_order, round(ln(1 + minimum_nights), 6) AS
    minimum_nights, round(ln(price), 6) AS log_price FROM typed"""))
def log_transforms_query(spark, sf_dir):
    df = log_transforms(typed(spark, sf_dir), RULES.model("price"))
    return df.select("city", "id", "copy_order", rounded("minimum_nights"), rounded("log_price"))


def _fit(train, spec):
    return fit_models(train, [spec], by=BY, reference_levels=BASES)


@query("ols_fit", check("split", """SELECT t.city, term, round(coef, 6) AS coef, round(se, 6) AS se,
    round(coef / se, 3) AS t, n, dof, round(sigma2, 6) AS sigma2, round(smearing, 6) AS smearing
    FROM s_terms t JOIN s_fit f USING (city)""", _TRAIN, _SIZE_SQL))
def ols_fit(spark, sf_dir):
    fit = _fit(sides(spark, sf_dir)[0], SIZE)
    return coefficients(fit, "size").join(fit.of("size").select("city", "n", "dof", "sigma2", "smearing"), "city").select(
        "city", "term", rounded("coef"), rounded("se"), rounded("t", digits=3), "n", "dof", rounded("sigma2"),
        rounded("smearing"))


_PREDICTED = """SELECT test.*, exp(a + slope * accommodates) * smearing AS predicted, a + slope * accommodates AS linear,
    ln(price) AS y FROM test JOIN s_group USING (city, room_type) JOIN s_fit USING (city)"""


@query("ols_predict", check("split", f"""SELECT city, id, round(predicted, 6) AS predicted FROM ({_PREDICTED})""",
                            _TRAIN, _SIZE_SQL))
def ols_predict(spark, sf_dir):
    train, test = sides(spark, sf_dir)
    return predict(test, _fit(train, SIZE), "size").select("city", "id", rounded("predicted"))


@query("predicted_vs_actual", check("split", f"""SELECT city, id, round(price, 6) AS actual, round(predicted, 6) AS
    predicted FROM ({_PREDICTED})""", _TRAIN, _SIZE_SQL))
def predicted_vs_actual_query(spark, sf_dir):
    train, test = sides(spark, sf_dir)
    pairs = predicted_vs_actual(test, _fit(train, SIZE), "size", keep=["id"])
    return pairs.select("city", "id", rounded("actual"), rounded("predicted"))


@query("price_range", check("split", f"""SELECT city, id, round(exp(linear), 6) AS median,
    round(exp(linear) * smearing, 6) AS mean, round(exp(linear - half), 6) AS lower, round(exp(linear + half), 6) AS upper
    FROM (SELECT city, id, smearing, a + slope * accommodates AS linear, {t_value(Z_90, 'dof')} * sqrt(sigma2 * (1 +
      1.0 / g.n + pow(accommodates - mx, 2) / sxx)) AS half FROM test JOIN s_group g USING (city, room_type)
      JOIN s_fit USING (city))""", _TRAIN, _SIZE_SQL))
def price_range_query(spark, sf_dir):
    train, test = sides(spark, sf_dir)
    ranged = price_range(test, _fit(train, SIZE), "size", level=0.8)
    return ranged.select("city", "id", *[rounded(c) for c in ("median", "mean", "lower", "upper")])


@query("model_scores", check("split",
    """SELECT city, count(*) AS n, round(1 - sum(pow(y - linear, 2)) / sum(pow(y - my, 2)), 6) AS r2_model_scale,
    round(1 - sum(pow(price - predicted, 2)) / sum(pow(price - mp, 2)), 6) AS r2,
    round(median(abs(price - predicted)), 6) AS median_ae, round(avg(abs(price - predicted)), 6) AS mae
    FROM scored JOIN m USING (city) GROUP BY city""", _TRAIN, _SIZE_SQL, f"scored AS ({_PREDICTED})",
    "m AS (SELECT city, avg(y) AS my, avg(price) AS mp FROM scored GROUP BY city)"))
def model_scores_query(spark, sf_dir):
    train, test = sides(spark, sf_dir)
    scores = model_scores(test, _fit(train, SIZE))
    return scores.select("city", "n", *[rounded(c) for c in ("r2_model_scale", "r2", "median_ae", "mae")])


@query("r2", check("typed", """SELECT city, count(*) AS n, round(1 - sum(pow(price - guess, 2)) / sum(pow(price - mean, 2)),
    6) AS r2 FROM (SELECT city, price, 30 + 12.0 * accommodates AS guess, avg(price) OVER (PARTITION BY city) AS mean
    FROM typed) GROUP BY city"""))
def r2_query(spark, sf_dir):
    guessed = typed(spark, sf_dir).withColumn("guess", F.lit(30.0) + F.lit(12.0) * F.col("accommodates"))
    return r2(guessed, "price", "guess", BY).select("city", "n", rounded("r2"))


@query("group_importance", check("split", """SELECT city, 'Size' AS group_name,
    round((room_sse - full_sse) / sst, 6) AS r2_loss FROM errors UNION ALL
    SELECT city, 'Room type', round((size_sse - full_sse) / sst, 6) FROM errors""", _TRAIN, _SIZE_SQL, """
    line AS (SELECT city, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM s_rows GROUP BY city),
    errors AS (SELECT city, sum(pow(y - f_hat, 2)) AS full_sse, sum(pow(y - my, 2)) AS room_sse,
      sum(pow(y - a0 - b * accommodates, 2)) AS size_sse, var_pop(y) * count(*) AS sst FROM (
        SELECT test.city, accommodates, ln(price) AS y, g.a + slope * accommodates AS f_hat, my, line.a AS a0, b
        FROM test JOIN s_group g USING (city, room_type) JOIN s_mean USING (city, room_type) JOIN s_fit USING (city)
          JOIN line USING (city)) GROUP BY city)"""))
def group_importance_query(spark, sf_dir):
    train, test = sides(spark, sf_dir)
    losses = group_importance(train, test, SIZE, {"Size": ("accommodates",), "Room type": ("room_type",)}, by=BY,
                              reference_levels=BASES)
    return losses.select("city", F.col("group").alias("group_name"), rounded("r2_loss"))


@query("significant_terms", check("split", f"""SELECT city, term FROM s_terms JOIN s_fit USING (city)
    WHERE abs(coef / se) > {t_value(Z_975, 'dof')}""", _TRAIN, _SIZE_SQL))
def significant_terms_query(spark, sf_dir):
    return significant_terms(_fit(sides(spark, sf_dir)[0], SIZE), "size").select("city", "term")


@query("term_effects", check("split", """SELECT city, term, round(100 * (exp(coef) - 1), 6) AS pct FROM s_terms
    WHERE term <> '(Intercept)'""", _TRAIN, _SIZE_SQL))
def term_effects_query(spark, sf_dir):
    return term_effects(_fit(sides(spark, sf_dir)[0], SIZE), "size").select("city", "term", rounded("pct"))


@query("rating_effects", check("split", f"""SELECT city, term AS score, round(100 * (exp(0.1 * coef) - 1), 6) AS
    pct_per_step FROM s_terms JOIN s_fit USING (city) WHERE term = 'accommodates' AND coef > 0
    AND abs(coef / se) > {t_value(Z_975, 'dof')}""", _TRAIN, _SIZE_SQL))
def rating_effects_query(spark, sf_dir):
    fit = _fit(sides(spark, sf_dir)[0], SIZE)
    return rating_effects(fit, "size", ["accommodates", "review_scores_value"]).select(
        "city", "score", rounded("pct_per_step"))


def _cool_fit(spark, sf_dir):
    train = keyword_dummies(sides(spark, sf_dir)[0], [_AC])
    return _fit(train, COOL)


_SIGNIFICANT = f"abs(coef / se) > {t_value(Z_975, 'dof')}"


@query("superhost_tip", check(("split", "apartments"), f"""SELECT a.id, round(CASE WHEN a.has_AC <> 1 THEN pct END, 6) AS
    tip_pct FROM apartments a LEFT JOIN (SELECT city, 100 * (exp(coef) - 1) AS pct FROM s_terms JOIN s_fit USING (city)
    WHERE term = 'has_AC' AND coef > 0 AND {_SIGNIFICANT}) USING (city)""", _TRAIN, _COOL_ROWS, _COOL_SQL))
def superhost_tip_query(spark, sf_dir):
    tips = superhost_tip(apartments(spark, sf_dir), _cool_fit(spark, sf_dir), "cool", flag="has_AC", column="tip_pct")
    return tips.select("id", rounded("tip_pct"))


@query("amenity_effects", check(("split", "apartments"), f"""SELECT a.id, 'has_AC' AS amenity,
    round(exp(g.a + slope * a.has_AC) * smearing * (exp(slope) - 1), 6) AS change,
    round(100 * (exp(slope) - 1), 6) AS change_pct, 1 AS rank
    FROM apartments a JOIN s_group g USING (city, room_type) JOIN s_fit USING (city)
      JOIN (SELECT city FROM s_terms JOIN s_fit USING (city) WHERE term = 'has_AC' AND {_SIGNIFICANT}
        AND 100 * (exp(coef) - 1) >= 1.0) USING (city) WHERE a.has_AC = 0""", _TRAIN, _COOL_ROWS, _COOL_SQL))
def amenity_effects_query(spark, sf_dir):
    fit = _cool_fit(spark, sf_dir)
    priced = predict(apartments(spark, sf_dir), fit, "cool", column="mean")
    tips = amenity_effects(priced, fit, "cool", RULES.actionable_amenities, keep=["id"], first=RULES.tips_shown)
    return tips.select("id", "amenity", rounded("change"), rounded("change_pct"), "rank")
