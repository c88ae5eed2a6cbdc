import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestay.errors import DataError, RuleError
from lodestay.functions.student_t import t_quantile, two_sided_p
from lodestay.operators.effects import (amenity_effects, coefficients, rating_effects, significant_terms, superhost_tip,
                                        term_effects)
from lodestay.operators.pricing import assess_listing, occupancy_reference, revenue_estimate
from lodestay.operators.regression import (fit_models, group_importance, log_transforms, model_scores, predict,
                                           predicted_vs_actual, price_range, r2)
from lodestay.operators.split import split_dataset, split_exact
from lodestay.rules import MOST_COMMON, ModelSpec, OccupancyRule


def test_student_t():
    assert t_quantile(0.9, 10) == pytest.approx(1.3721836, abs=1e-7)
    assert t_quantile(0.9, 8000) == pytest.approx(1.2816574, abs=1e-7)
    assert two_sided_p(t_quantile(0.975, 7), 7) == pytest.approx(0.05, abs=1e-12)


@pytest.fixture(scope="module")
def hundred(spark):
    return spark.createDataFrame([(i, float(i)) for i in range(100)], "id int, v double")


def test_split_counts(hundred):
    train, test = split_dataset(hundred, 0.2, seed=42)
    assert (train.count(), test.count()) == (80, 20)
    assert train.intersect(test).count() == 0 and train.union(test).distinct().count() == 100
    again = split_dataset(hundred.repartition(7), 20, seed=42)[1]
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in test.collect())
    other = split_dataset(hundred, 0.2, seed=43)[1]
    assert sorted(r.id for r in other.collect()) != sorted(r.id for r in test.collect())
    unseeded = split_exact(hundred, 0.3)
    assert unseeded.filter("is_test").count() == 30
    last = split_dataset(hundred, 0.2, random_selection=False)[1]
    assert sorted(r.id for r in last.collect()) == list(range(80, 100))


def test_split_rounds_to_even_and_rejects_empty_sides(hundred):
    assert split_dataset(hundred.filter("id < 25"), 0.1, seed=1)[1].count() == 2  # 2.5 -> 2
    assert split_dataset(hundred.filter("id < 35"), 0.1, seed=1)[1].count() == 4  # 3.5 -> 4
    for bad in (0, -0.1, 1, 100, 150):
        with pytest.raises(RuleError):
            split_exact(hundred, bad)
    with pytest.raises(RuleError, match="empty test"):
        split_exact(hundred.limit(2), 0.1, seed=1)
    with pytest.raises(RuleError, match="empty training"):
        split_exact(hundred.limit(2), 0.9, seed=1)


def test_log_transforms(spark):
    df = spark.createDataFrame([(0.0, 1, 100.0), (1.0, 2, 200.0)], "reviews double, rooms int, price double")
    out = log_transforms(df, ModelSpec("m", "price", ("reviews",), True, ("reviews",))).orderBy("rooms").collect()
    assert [r.reviews for r in out] == pytest.approx([0.0, math.log(2)])
    assert [r.log_price for r in out] == pytest.approx([math.log(100), math.log(200)])
    for bad, what in (((-1.0, 1, 5.0), "<= -1"), ((None, 1, 5.0), "missing"), ((0.0, 1, 0.0), "<= 0")):
        with pytest.raises(DataError, match=what):
            log_transforms(spark.createDataFrame([bad], df.schema), ModelSpec("m", "price", ("reviews",), True, ("reviews",)))


def test_noisy_line(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0), (3.0, 6.0), (4.0, 9.0)], "x double, y double")
    fit = fit_models(df, [ModelSpec("line", "y", ("x",), log_scale=False)])
    coef = {r.term: r.coef for r in coefficients(fit).collect()}
    assert coef["x"] == pytest.approx(2.2) and coef["(Intercept)"] == pytest.approx(0.0, abs=1e-9)
    scores = model_scores(df, fit).first()
    assert scores.r2 == pytest.approx(0.968) and scores.mae == pytest.approx(0.4)
    assert fit.table.frame.first().smearing == 1.0


def test_exact_log_model(spark):
    df = spark.createDataFrame([(x, math.exp(1 + 0.3 * x)) for x in range(1, 7)] * 10, "accommodates int, price double")
    spec = ModelSpec("m", "price", ("accommodates",))
    fit = fit_models(df, [spec])
    assert fit.table.frame.first().smearing == pytest.approx(1.0)
    got = predict(df.limit(1).withColumn("accommodates", F.lit(7)), fit, "m").first()
    assert got.predicted == pytest.approx(math.exp(1 + 0.3 * 7))
    pairs = predicted_vs_actual(df, fit, "m").collect()
    assert len(pairs) == 60 and all(r.predicted == pytest.approx(r.actual) for r in pairs)
    with pytest.raises(DataError):
        predicted_vs_actual(df.limit(0), fit, "m")
    with pytest.raises(RuleError, match="fitted are m"):
        fit.spec("other")


def _sample(n=600, seed=11):
    rng = np.random.default_rng(seed)
    city = rng.choice(["A", "B"], n, p=[0.3, 0.7])
    kind = rng.choice(["x", "y", "z"], n, p=[0.5, 0.3, 0.2])
    size = rng.integers(1, 9, n)
    nights = rng.integers(0, 30, n)
    flag = rng.integers(0, 2, n)
    effect = np.select([kind == "x", kind == "y"], [0.0, 0.4], -0.3)
    price = np.exp(3 + 0.1 * size + effect + 0.05 * np.log1p(nights) + 0.2 * flag + rng.normal(0, 0.2, n))
    return [(i, str(c), str(k), int(s), float(m), int(f), float(p))
            for i, (c, k, s, m, f, p) in enumerate(zip(city, kind, size, nights, flag, price))]


SCHEMA = "id int, city string, kind string, size int, nights double, has_AC int, price double"
FULL = ModelSpec("m", "price", ("kind", "size", "nights", "has_AC"), True, ("nights",))


def _reference(rows, base):
    """Plain least squares on the dense design of one group."""
    levels = [k for k in sorted({r[2] for r in rows}) if k != base]
    x = np.array([[1.0, *[float(r[2] == k) for k in levels], r[3], math.log1p(r[4]), r[5]] for r in rows])
    y = np.log([r[6] for r in rows])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    residual = y - x @ beta
    sigma2 = residual @ residual / (len(y) - x.shape[1])
    inverse = np.linalg.inv(x.T @ x)
    names = ["(Intercept)", *[f"kind: {k}" for k in levels], "size", "nights", "has_AC"]
    return names, beta, np.sqrt(sigma2 * np.diag(inverse)), sigma2, inverse, x, np.mean(np.exp(residual))


@pytest.mark.parametrize("partitions", [1, 4, 32])
def test_fit_matches_dense_least_squares(spark, partitions):
    rows = _sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    fit = fit_models(df, [FULL], by=["city"], reference_levels={"kind": MOST_COMMON, "unused": MOST_COMMON})
    for city in ("A", "B"):
        part = [r for r in rows if r[1] == city]
        names, beta, se, sigma2, inverse, x, smearing = _reference(part, "x")
        got = coefficients(fit, "m").filter(F.col("city") == city).orderBy("position").collect()
        assert [r.term for r in got] == names
        assert [r.coef for r in got] == pytest.approx(list(beta), rel=1e-9)
        assert [r.se for r in got] == pytest.approx(list(se), rel=1e-9)
        assert got[1].p == pytest.approx(two_sided_p(beta[1] / se[1], len(part) - len(beta)), abs=1e-12)
        summary = fit.of("m").filter(F.col("city") == city).first()
        assert summary.smearing == pytest.approx(smearing, rel=1e-9)
        ranged = price_range(df.filter(F.col("city") == city), fit, "m").orderBy("id").collect()
        t = t_quantile(0.9, len(part) - len(beta))
        half = t * np.sqrt(sigma2 * (1 + np.einsum("ij,jk,ik->i", x, inverse, x)))
        assert [r.upper for r in ranged] == pytest.approx(list(np.exp(x @ beta + half)), rel=1e-8)
        assert [r.lower for r in ranged] == pytest.approx(list(np.exp(x @ beta - half)), rel=1e-8)
        assert [r["mean"] for r in ranged] == pytest.approx([r["median"] * smearing for r in ranged])


def test_reference_levels(spark):
    df = spark.createDataFrame([(k, float(v)) for k, v in zip("AAABBBBBCCCC", range(1, 13))], "kind string, y double")
    spec = ModelSpec("m", "y", ("kind",), log_scale=False)

    def terms(reference):
        return [r.term for r in coefficients(fit_models(df, [spec], reference_levels=reference)).orderBy("position").collect()]

    assert terms({}) == ["(Intercept)", "kind: B", "kind: C"]
    assert terms({"kind": MOST_COMMON}) == ["(Intercept)", "kind: A", "kind: C"]
    assert terms({"kind": "C", "other": "q"}) == ["(Intercept)", "kind: A", "kind: B"]
    with pytest.raises(Exception, match="does not occur"):
        terms({"kind": "Z"})


def test_collinear_term_is_dropped(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), 2 * float(a) + 1, float(a + rng.normal())) for a in rng.normal(size=50)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    got = {r.term: r for r in coefficients(fit_models(df, [ModelSpec("m", "y", ("a", "b"), log_scale=False)])).collect()}
    assert got["b"].coef == 0.0 and got["b"].p is None and got["a"].p is not None


def test_bad_rows_and_unknown_levels(spark):
    rows = _sample(100)
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("size", "price", "kind"):
        gap = df.withColumn(c, F.when(F.col("id") != 3, F.col(c)))
        with pytest.raises(DataError, match=c):
            fit_models(gap, [FULL])
    with pytest.raises(DataError, match="<= 0"):
        fit_models(df.withColumn("price", F.when(F.col("id") != 3, F.col("price")).otherwise(0.0)), [FULL])
    with pytest.raises(DataError, match="<= -1"):
        fit_models(df.withColumn("nights", F.lit(-1.0)), [FULL])
    fit = fit_models(df, [FULL])
    strange = df.limit(2).withColumn("kind", F.lit("new"))
    with pytest.raises(DataError, match="does not know"):
        predict(strange, fit, "m")
    assert predict(strange, fit, "m", strict=False).filter("predicted IS NULL").count() == 2


@pytest.mark.parametrize("y,fitted,expected", [([1, 2, 3], [1, 2, 3], 1.0), ([1, 2, 3], [2, 2, 2], 0.0),
                                               ([1, 2, 3], [1, 2, 4], 0.5), ([1, 2, 3], [3, 2, 1], -3.0)])
def test_r2(spark, y, fitted, expected):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, fitted)], "y double, f double")
    assert r2(df, "y", "f").first().r2 == pytest.approx(expected)


def test_r2_errors(spark):
    schema = "y double, f double"
    for rows, what in (([], "no rows"), ([(1.0, 1.0), (1.0, 2.0)], "constant"), ([(1.0, None), (2.0, 1.0)], "missing")):
        with pytest.raises(DataError, match=what):
            r2(spark.createDataFrame(rows, schema), "y", "f")


def test_group_importance_equals_refits(spark):
    rows = _sample()
    df = spark.createDataFrame(rows, SCHEMA)
    train, test = df.filter("id % 5 != 0"), df.filter("id % 5 = 0")
    groups = {"Size": ("size",), "Kind": ("kind",), "Rest": ("nights", "has_AC")}
    got = group_importance(train, test, FULL, groups, by=["city"], reference_levels={"kind": MOST_COMMON})
    losses = {(r.city, r.group): r.r2_loss for r in got.collect()}

    def score(spec):
        fit = fit_models(train, [spec], by=["city"], reference_levels={"kind": MOST_COMMON})
        return {r.city: r.r2_model_scale for r in model_scores(test, fit).collect()}

    full = score(FULL)
    for name, columns in groups.items():
        reduced = score(FULL.without(columns))
        for city in ("A", "B"):
            assert losses[city, name] == pytest.approx(full[city] - reduced[city], abs=1e-9)
    ordered = [r.r2_loss for r in got.collect() if r.city == "A"]
    assert ordered == sorted(ordered, reverse=True)


def test_effect_tables(spark):
    df = spark.createDataFrame(_sample(), SCHEMA)
    fit = fit_models(df, [FULL])
    b = {r.term: r.coef for r in coefficients(fit).collect()}
    assert "(Intercept)" in [r.term for r in significant_terms(fit, "m").collect()]
    effects = {r.term: r.pct for r in term_effects(fit, "m").collect()}
    assert "(Intercept)" not in effects
    assert effects["has_AC"] == pytest.approx(100 * (math.exp(b["has_AC"]) - 1))
    scores = rating_effects(fit, "m", ["size", "absent"], step=0.1).collect()
    assert [r.score for r in scores] == ["size"]
    assert scores[0].pct_per_step == pytest.approx(100 * (math.exp(0.1 * b["size"]) - 1))
    tipped = superhost_tip(df, fit, "m", flag="has_AC").orderBy("id").collect()
    assert all((r.superhost_pct is None) == (r.has_AC == 1) for r in tipped)

    priced = predict(df, fit, "m", column="mean")
    tips = amenity_effects(priced, fit, "m", ["has_AC", "size"], keep=["id", "mean", "has_AC"]).collect()
    assert {r.id for r in tips if r.amenity == "has_AC"} == {r.id for r in df.filter("has_AC = 0").collect()}
    switched = {r.id: r["mean"] for r in predict(df.withColumn("has_AC", F.lit(1)), fit, "m", column="mean").collect()}
    for r in tips[:50]:
        assert r.change == pytest.approx(switched[r.id] - r["mean"])
        assert r.change_pct == pytest.approx(100 * (switched[r.id] / r["mean"] - 1))
    assert amenity_effects(priced, fit, "m", ["has_AC"], keep=["id"], min_effect_pct=99.0).count() == 0


def test_rating_step_example():
    assert 100 * (math.exp(0.1 * 0.122) - 1) == pytest.approx(1.2275, abs=1e-4)


def test_assessment(spark):
    cases = [("underpriced", 71.0, 0.5, 9.0), ("not_price_problem", 79.0, 0.1, 1.0), ("in_line", 80.0, 0.9, 0.0), ("in_line", 120.0, 0.0, 0.0),
             ("overpriced", 133.0, 0.49, 13.0), ("unexplained_premium", 121.0, 0.9, 1.0)]
    df = spark.createDataFrame([(*c, 80.0, 120.0, 0.5) for c in cases],
                               "want string, price double, occupancy double, diff double, lower double, upper double, reference double")
    for r in assess_listing(df).collect():
        assert (r.status, r.difference) == (r.want, r["diff"])


def test_occupancy_reference(spark):
    rows = [("A", "E", v) for v in (0.2, 0.4, 0.6, 0.9)] + [("B", "E", v) for v in (0.1, 0.3)] + [("C", "P", 0.5)]
    train = spark.createDataFrame(rows, "district string, room_type string, occupancy_rate double")
    rule = OccupancyRule(("district", "room_type"), 4, "room_type", 0.75)
    asked = spark.createDataFrame([(1, "A", "E"), (2, "B", "E"), (3, "Z", "E"), (4, "C", "P")], "id int, district string, room_type string")
    got = occupancy_reference(asked, train, rule, {"mid": 0.5, "high": 0.75}).orderBy("id").collect()
    assert [r.mid for r in got] == pytest.approx([0.5, 0.35, 0.35, 0.5])
    assert [r.high for r in got] == pytest.approx([0.675, 0.55, 0.55, 0.5])
    with pytest.raises(DataError):
        occupancy_reference(asked.withColumn("room_type", F.lit("Tent")), train, rule)


def test_revenue(spark):
    df = spark.createDataFrame([(1, "listed", 100, 0.7, 90.0, 60.0, 130.0, 85.0), (2, "new", None, 0.2, 110.0, 60.0, 130.0, None)],
                               "id int, group string, estimated_occupancy_l365d int, reference double, mean double, lower double, upper double, price double")
    listed, new = revenue_estimate(df).orderBy("id").collect()
    assert (listed.nights, listed.revenue, listed.revenue_lower, listed.revenue_upper, listed.own_revenue) == (100.0, 9000.0, 6000.0, 13000.0, 8500.0)
    assert (new.nights, new.revenue) == (pytest.approx(73.0), pytest.approx(8030.0))
    assert new.revenue_lower is None and new.own_revenue is None
