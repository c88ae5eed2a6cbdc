import shutil
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestay import (DataError, RuleError, Rules, add_counts, add_moments, drop_snapshot, fitted_from_counts, merged_moments,
                      snapshot_names)
from lodestay.operators.effects import coefficients
from lodestay.operators.features import cap_values, frequent_categories, group_caps
from lodestay.operators.regression import fit_models, fit_moments
from lodestay.rules import CapRule, CategoryRule, ModelSpec, SquareRule

RULES = replace(Rules(), caps=CapRule(("rooms", "baths"), "kind", 0.9), category=CategoryRule("district", 30),
                squares=(SquareRule("rooms", "rooms_sq"), SquareRule("stars", "stars_sq"), SquareRule("baths", "baths_sq", False)))
SCHEMA = "city string, kind string, district string, rooms int, baths double, stars double, price double"
SPECS = (ModelSpec("price", "price", ("kind", "district", "rooms", "stars"), True, ("rooms",)),
         ModelSpec("plain", "price", ("rooms", "baths"), False))


def _rows(seed, n, start):
    """Three cities, of which one has half of the rows and one is in later snapshots only."""
    rng = np.random.default_rng(seed)
    city = rng.choice(["A", "A", "B", "C"] if start else ["A", "B"], n)
    kind, district = rng.choice(["x", "y", "z"], n), rng.integers(0, 12, n) ** 2 // 12
    rooms, stars = rng.integers(1, 15 + start, n), np.round(rng.normal(4, 0.5, n), 2)
    baths = rng.integers(1, 8, n) / 2
    price = np.exp(3 + 0.1 * rooms + 0.2 * stars + 0.05 * district + rng.normal(0, 0.3, n))
    return [(str(c), str(k), f"d{d}", int(r), float(b), float(s), float(p))
            for c, k, d, r, b, s, p in zip(city, kind, district, rooms, baths, stars, price)]


@pytest.fixture
def parts(spark, tmp_path):
    """Snapshots as files, which a test may take away once they are counted."""
    folders = []
    for k, n in enumerate((400, 700, 300)):
        folders.append(str(tmp_path / f"rows{k}"))
        spark.createDataFrame(_rows(k, n, 6 * k), SCHEMA).write.parquet(folders[-1])
    return folders


def _values(fitted):
    return [sorted(map(tuple, getattr(fitted, n).frame.collect())) for n in ("caps", "kept", "centers")]


def _direct(df, by):
    caps = group_caps(df, RULES.caps, by)
    capped = cap_values(df, caps, RULES.caps, by)
    kept = frequent_categories(df, RULES.category, by).select(*by, "district")
    centers = capped.groupBy(*by).agg(F.avg("rooms"), F.avg("stars"), F.lit(0.0))
    return [sorted(map(tuple, t.collect())) for t in (caps, kept, centers)]


@pytest.mark.parametrize("by,city", [(("city",), None), ((), "Athens")])
def test_values_of_a_union_are_those_of_its_snapshots(spark, tmp_path, parts, by, city):
    root, union = str(tmp_path / "state"), spark.read.parquet(*parts)
    caps, kept, centers = _direct(union, by)
    for k, path in enumerate(parts):
        add_counts(spark.read.parquet(path), root, f"2024-0{k}", RULES, by=by)
        shutil.rmtree(path)  # only a new snapshot is ever read
    got = _values(fitted_from_counts(spark, root, RULES, by=by, city=city))
    assert got[0] == caps and got[1] == kept
    assert [r[:len(by)] for r in got[2]] == [r[:len(by)] for r in centers]
    assert [x for r in got[2] for x in r[len(by):]] == pytest.approx([x for r in centers for x in r[len(by):]], rel=1e-9)


def test_a_snapshot_counts_once_and_can_go(spark, tmp_path, parts):
    root = str(tmp_path / "state")
    with pytest.raises(RuleError, match="no snapshot at all"):
        fitted_from_counts(spark, root, RULES)
    for k, path in enumerate(parts):
        add_counts(spark.read.parquet(path), root, f"s{k}", RULES)
    add_counts(spark.createDataFrame([], SCHEMA), root, "none", RULES)
    with pytest.raises(RuleError, match="s1 is counted already"):
        add_counts(spark.read.parquet(parts[1]), root, "s1", RULES)
    with pytest.raises(RuleError, match="letters"):
        add_counts(spark.read.parquet(parts[1]), root, "a/b", RULES)
    # a writer that was lost before it named its tables has left nothing to read
    spark.read.parquet(parts[0]).write.parquet(f"{root}/counts/s9@0/values")
    assert snapshot_names(spark, root) == ["none", "s0", "s1", "s2"]
    two = _values(fitted_from_counts(spark, root, RULES, names=["s0", "s2"]))
    assert two[:2] == _direct(spark.read.parquet(parts[0], parts[2]), ["city"])[:2]
    drop_snapshot(spark, root, "s1")
    assert _values(fitted_from_counts(spark, root, RULES))[:2] == two[:2]
    for wrong in (lambda: drop_snapshot(spark, root, "s1"), lambda: fitted_from_counts(spark, root, RULES, names=["s1"])):
        with pytest.raises(RuleError, match="no snapshot s1"):
            wrong()


def test_missing_values_of_a_snapshot(spark, tmp_path):
    root = str(tmp_path / "state")
    rows = [("A", "x", "d", 2, 1.0, None, 1.0), ("A", "x", None, None, 2.0, 4.0, 1.0), ("A", None, "d", 4, 3.0, 5.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(DataError, match="stars"):
        add_counts(df, root, "s", RULES)
    assert snapshot_names(spark, root) == []
    add_counts(df, root, "s", RULES, strict=False)
    few = replace(RULES, category=CategoryRule("district", 2))
    fitted = fitted_from_counts(spark, root, few)
    assert {(r.kind, r.cap_rooms) for r in fitted.caps.frame.collect()} == {("x", 2.0), (None, 4.0)}
    assert [r.district for r in fitted.kept.frame.collect()] == ["d"]
    center = fitted.centers.frame.first()
    assert (center.center_rooms, center.center_stars, center.center_baths) == (3.0, 4.5, 0.0)


@pytest.mark.parametrize("by", [("city",), ()])
def test_models_of_a_union_are_those_of_its_snapshots(spark, tmp_path, parts, by):
    root, union = str(tmp_path / "state"), spark.read.parquet(*parts)
    wanted = fit_models(union, SPECS, by=by)
    for k, path in enumerate(parts):
        add_moments(spark.read.parquet(path), root, f"s{k}", SPECS, by=by)
    keys = [*by, "model", "term"]

    def terms(fit):
        return {tuple(r[k] for k in keys): (r.coef, r.se, r.p) for r in fit.coefficients().collect()}

    expected = terms(wanted)
    sigmas = {(*(r[k] for k in by), r.model): r.sigma2 for r in wanted.table.frame.collect()}
    whole = fit_models(union, SPECS, by=by, learned=merged_moments(spark, root))
    smearing = sorted(r.smearing for r in wanted.table.frame.collect())
    assert sorted(r.smearing for r in whole.table.frame.collect()) == pytest.approx(smearing, rel=1e-9)
    for path in parts:
        shutil.rmtree(path)
    fit = fit_moments(merged_moments(spark, root), SPECS)
    got = terms(fit)
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert got[k] == pytest.approx(v, rel=1e-8, abs=1e-10), k
    assert {(*(r[k] for k in by), r.model): r.sigma2 for r in fit.table.frame.collect()} == pytest.approx(sigmas, rel=1e-9)
    assert coefficients(fit, "plain").count() == 3 * (3 if by else 1)


def test_snapshots_of_other_predictors_do_not_mix(spark, tmp_path, parts):
    root = str(tmp_path / "state")
    df = spark.read.parquet(parts[0])
    add_moments(df, root, "s0", SPECS)
    add_moments(df, root, "s1", SPECS[1:])
    with pytest.raises(RuleError, match="different groups or predictors"):
        merged_moments(spark, root)
    assert merged_moments(spark, root, names=["s1"]).layout.categories == ()
    with pytest.raises(DataError):
        add_moments(df.limit(0), root, "s2", SPECS)
