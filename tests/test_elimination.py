"""Least squares with an eliminated category against the dense design matrix."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestay.functions.student_t import t_quantile, two_sided_p
from lodestay.operators import elimination
from lodestay.operators.moments import moments
from lodestay.operators.regression import fit_models, price_range
from lodestay.rules import MOST_COMMON, ModelSpec

SPEC = ModelSpec("m", "price", ("kind", "district", "size", "nights", "twice"), True, ("nights",))
PLAIN = ModelSpec("plain", "price", ("size",), False)


def _rows(districts, each, seed):
    rng = np.random.default_rng(seed)
    n = districts * each
    at = np.concatenate([np.arange(districts), rng.integers(0, districts, n - districts)])
    size, nights, kind = rng.integers(1, 9, n), rng.integers(0, 40, n).astype(float), rng.choice(["x", "y", "z"], n, p=[0.5, 0.3, 0.2])
    price = np.exp(4 + 0.07 * size + 0.1 * np.log1p(nights) + rng.normal(0, 0.5, districts)[at] + 0.2 * (kind == "y") + rng.normal(0, 0.2, n))
    # ``twice`` follows from size and is given no effect of its own
    return pd.DataFrame({"id": np.arange(n), "city": "A", "district": [f"d{k:05d}" for k in at], "kind": kind, "size": size, "nights": nights, "twice": 2 * size + 3, "price": price})


def test_matches_the_dense_design(spark, monkeypatch):
    monkeypatch.setattr(elimination, "CHUNK_LEVELS", 17)
    data = _rows(200, 8, 1)
    other = _rows(5, 30, 2).assign(city="B")
    both = pd.concat([data, other], ignore_index=True)
    both["id"] = np.arange(len(both))
    df = spark.createDataFrame(both).repartition(5)
    fit = fit_models(df, [SPEC, PLAIN], by=["city"], reference_levels={"district": MOST_COMMON, "kind": "y"})
    assert fit.eliminated == {"m": "district", "plain": None}
    ranged = price_range(df, fit, "m").orderBy("id").toPandas()
    for city, part in both.groupby("city"):
        counts = part["district"].value_counts()
        base = min(counts.index, key=lambda d: (-counts[d], d))
        levels = [d for d in sorted(counts.index) if d != base]
        names = ["(Intercept)", "kind: x", "kind: z", *[f"district: {d}" for d in levels], "size", "nights", "twice"]
        x = np.column_stack([np.ones(len(part)), part["kind"] == "x", part["kind"] == "z", *[part["district"] == d for d in levels], part["size"], np.log1p(part["nights"])]).astype(float)
        y = np.log(part["price"].to_numpy())
        inverse = np.linalg.inv(x.T @ x)
        beta = inverse @ x.T @ y
        residual = y - x @ beta
        dof = len(y) - x.shape[1]
        sigma2 = residual @ residual / dof
        se = np.sqrt(sigma2 * np.diag(inverse))
        got = fit.coefficients("m").filter(F.col("city") == city).orderBy("position").collect()
        assert [r.term for r in got] == names and [r.position for r in got] == list(range(len(names)))
        assert [r.coef for r in got[:-1]] == pytest.approx(list(beta), rel=1e-9, abs=1e-11)
        assert [r.se for r in got[:-1]] == pytest.approx(list(se), rel=1e-9)
        assert [r.p for r in got[:-1]] == pytest.approx([two_sided_p(t, dof) for t in beta / se], abs=1e-9)
        assert (got[-1].coef, got[-1].se, got[-1].p) == (0.0, None, None)
        half = t_quantile(0.9, dof) * np.sqrt(sigma2 * (1 + np.einsum("ij,jk,ik->i", x, inverse, x)))
        mine = ranged[ranged["city"] == city]
        assert np.log(mine["upper"].to_numpy()) == pytest.approx(x @ beta + half, rel=1e-9)
        assert np.log(mine["lower"].to_numpy()) == pytest.approx(x @ beta - half, rel=1e-9)
        summary = fit.of("m").filter(F.col("city") == city).first()
        assert (summary.n, summary.dof) == (len(part), dof) and summary.sigma2 == pytest.approx(sigma2, rel=1e-9)
    with pytest.raises(Exception, match="does not occur"):
        fit_models(df, [SPEC], by=["city"], reference_levels={"district": "nowhere"})


def test_many_levels_leave_a_small_system(spark):
    """20,000 districts: what the solving task gets does not grow with them; the slopes are those of differences from district means."""
    data = _rows(20_000, 3, 3)
    df = spark.createDataFrame(data)
    spec = ModelSpec("m", "price", ("district", "size", "nights"), True, ("nights",))
    learned = moments(df, [spec])
    assert learned.table(()).count() + elimination._reduction(elimination._level_sums(learned, "district"), learned).count() < 60
    fit = fit_models(df, [spec], learned=learned)
    y = np.log(data["price"])
    x = pd.DataFrame({"size": data["size"].astype(float), "nights": np.log1p(data["nights"])})
    own = data["district"]
    x_in, y_in = x - x.groupby(own).transform("mean"), y - y.groupby(own).transform("mean")
    beta = np.linalg.lstsq(x_in.to_numpy(), y_in.to_numpy(), rcond=None)[0]
    effects = y.groupby(own).mean() - x.groupby(own).mean() @ beta
    got = {r.term: r.coef for r in fit.coefficients("m").collect()}
    assert [got["size"], got["nights"]] == pytest.approx(list(beta), rel=1e-9)
    assert got["(Intercept)"] == pytest.approx(effects.iloc[0], rel=1e-9) and len(got) == 20_002
    assert [got[f"district: {d}"] for d in effects.index[1:]] == pytest.approx(list(effects.iloc[1:] - effects.iloc[0]), rel=1e-7, abs=1e-10)
