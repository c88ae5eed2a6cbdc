"""Log-linear models from sufficient statistics.

All models of a run, for all groups (cities), come from two narrow passes over the training rows (``moments``). The largest
category is eliminated (``elimination``), so a group's normal equations have the size of the other terms; the rows themselves never meet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DataError, RuleError, require_columns, require_rows
from ..functions.student_t import t_quantile
from ..rules import ModelSpec
from .elimination import eliminated, per_group, solve_models
from .lookup import Lookup, lookup_join, pin
from .moments import INTERCEPT, Gram, Moments, feature, independent, log_problems, moments, response
from .quantiles import group_quantiles

# ---------------------------------------------------------------- log transforms

def log_transforms(df: DataFrame, spec: ModelSpec, strict: bool = True) -> DataFrame:
    """log1p of the listed predictors in place, and ``log_<target>`` for a log model."""
    require_columns(df, [*spec.log1p_predictors, spec.target], "log_transforms")
    require_rows(df, log_problems([spec]), strict)
    out = df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in spec.log1p_predictors})
    return out.withColumn(spec.response, F.ln(F.col(spec.target).cast("double"))) if spec.log_scale else out


def _solve(gram: Gram, spec: ModelSpec, references: Mapping[str, str]):
    terms, bases = gram.design(spec, references)
    columns = [t[3] for t in terms]
    y = gram.layout.response_index(spec)
    xx = gram.matrix[np.ix_(columns, columns)]
    xy = gram.matrix[columns, y]
    kept = independent(xx)
    scale = 1.0 / np.sqrt(np.diag(xx)[kept])
    inverse = np.linalg.inv(xx[np.ix_(kept, kept)] * np.outer(scale, scale)) * np.outer(scale, scale)
    beta = np.zeros(len(terms))
    beta[kept] = inverse @ xy[kept]
    covariance = np.zeros((len(terms),) * 2)
    covariance[np.ix_(kept, kept)] = inverse
    residual = max(float(gram.matrix[y, y] - 2 * beta @ xy + beta @ xx @ beta), 0.0)
    return terms, bases, kept, beta, covariance, residual


# ---------------------------------------------------------------- fitting

@dataclass(frozen=True)
class Fit:
    """Fitted models, ready to be joined to tables of any size.

    ``table`` has one row per group and model, with the terms but for the levels of its eliminated category. Those are rows of ``levels``, each with
    its coefficient and what it adds to an interval; the base level is among them.
    """

    by: tuple[str, ...]
    specs: tuple[ModelSpec, ...]
    categories: tuple[str, ...]
    table: Lookup
    levels: Lookup
    eliminated: Mapping[str, str | None]

    def spec(self, name: str) -> ModelSpec:
        for s in self.specs:
            if s.name == name:
                return s
        raise RuleError(f"no fit named {name}; fitted are {', '.join(s.name for s in self.specs)}")

    def of(self, name: str) -> DataFrame:
        self.spec(name)
        return self.table.frame.filter(F.col("model") == name)

    def coefficients(self, name: str | None = None) -> DataFrame:
        """by, model, term, source, level, position, coef, se, t, p of all terms."""
        table = self.table.frame if name is None else self.of(name)
        terms = table.select(*self.by, "model", F.inline("terms"))
        levels = self.levels.frame.filter(~F.col("is_base") & (F.lit(True) if name is None else F.col("model") == name))
        return terms.unionByName(levels.select(*terms.columns))

    def numeric(self, name: str) -> list[str]:
        return [p for p in self.spec(name).predictors if p not in self.categories]

    def lookup(self, frame: DataFrame) -> Lookup:
        """A table with no more rows than the fit itself."""
        return Lookup(frame, self.table.small)


def fit_models(df: DataFrame, specs: Sequence[ModelSpec], *, by: Sequence[str] = (),
               reference_levels: Mapping[str, str] | None = None, strict: bool = True,
               learned: Moments | None = None) -> Fit:
    """Ordinary least squares of every spec in every group, with smearing factors.

    ``reference_levels`` names the base level per category (``most_common`` or a level); the default is the
    first level in order. ``learned`` reuses moments of the same rows.
    """
    specs, by = tuple(specs), tuple(by)
    return _with_smearing(df, fit_moments(learned or moments(df, specs, by, strict=strict), specs, reference_levels=reference_levels))


def fit_moments(learned: Moments, specs: Sequence[ModelSpec], *, reference_levels: Mapping[str, str] | None = None) -> Fit:
    """The same from moments alone. The smearing factor is a mean over rows under the final coefficients, so it is not there: terms,
    effects and linear predictors can be had, predictions in the target's units need ``fit_models(..., learned=...)``."""
    specs = tuple(specs)
    gone = eliminated(learned, specs)
    tables = [solve_models(learned, [s for s in specs if gone[s.name] == c], c, dict(reference_levels or {})) for c in dict.fromkeys(gone.values())]
    solved, levels = tables[0]
    for more, other in tables[1:]:
        solved, levels = solved.unionByName(more), levels.unionByName(other)
    return Fit(learned.by, specs, learned.layout.categories, pin(solved, "fits"), pin(levels, "levels"), gone)


def _with_smearing(df: DataFrame, fit: Fit) -> Fit:
    """Mean of exp(residual) on the training rows for log models, 1 otherwise: one more narrow pass."""
    logged = [s for s in fit.specs if s.log_scale]
    table = fit.table.frame
    if not logged:
        return replace(fit, table=Lookup(table.withColumn("smearing", F.lit(1.0)), fit.table.small))
    scored = linear_predictors(df, fit, [s.name for s in logged])
    means = scored.groupBy(*fit.by).agg(
        *[F.avg(F.exp(response(s) - F.col(f"linear_{s.name}"))).alias(s.name) for s in logged])
    pairs = F.array(*[F.struct(F.lit(s.name).alias("model"), F.col(s.name).alias("smearing")) for s in logged])
    factors = pin(means.select(*fit.by, F.inline(pairs)), "smearing")
    joined = lookup_join(table, factors, [*fit.by, "model"], null_safe=True)
    joined = joined.withColumn("smearing", F.coalesce("smearing", F.lit(1.0)))
    return replace(fit, table=pin(joined, "fits"))


# ---------------------------------------------------------------- prediction

def _of_models(value: Column, names: Sequence[str], alias: str) -> list[Column]:
    return [F.first(F.when(F.col("model") == n, value), ignorenulls=True).alias(f"{alias}_{n}") for n in names]


def _group_table(fit: Fit, names: Sequence[str], smearing: bool, interval: str | None, quantile: Column | None) -> Lookup:
    """One row a group: every model's intercept and numeric coefficients, and what intervals of one of them need."""
    plain = F.transform(F.filter("terms", lambda t: t["level"].isNull()), lambda t: t["coef"])
    wanted = _of_models(plain, names, "__b") + (_of_models(F.col("smearing"), names, "__s") if smearing else [])
    table = fit.table.frame
    if interval is not None:
        table = table.withColumn("__t", quantile)
        for column, alias in (("factor", "__f"), ("base_at", "__g"), ("base_weight", "__w"), ("sigma2", "__v"), ("__t", "__t")):
            wanted += _of_models(F.col(column), [interval], alias)
    return pin(table.groupBy(*fit.by).agg(*wanted), "models")


def _level_table(fit: Fit, category: str, names: Sequence[str], interval: str | None) -> Lookup:
    """One row a group and level, the base included: the coefficients of every model, and the level's part of an interval."""
    parts = []
    none = F.lit(None).cast("double").alias("weight")
    if any(fit.eliminated[n] == category for n in names):
        parts.append(fit.levels.frame.filter(F.col("source") == category).select(*fit.by, "model", F.col("level").alias(category), "coef", "at", "weight"))
    if any(fit.eliminated[n] != category for n in names):
        terms, bases = (fit.table.frame.select(*fit.by, "model", F.inline(c)).filter((F.col("source") == category) & F.col("level").isNotNull())
                        for c in ("terms", "bases"))
        at = fit.table.frame.select(*fit.by, "model", F.inline("level_factors")).filter(F.col("source") == category)
        empty = F.lit(None).cast("array<double>").alias("at")
        coefs = terms.select(*fit.by, "model", F.col("level").alias(category), "coef", empty, none).unionByName(
            bases.select(*fit.by, "model", F.col("level").alias(category), F.lit(0.0).alias("coef"), empty, none))
        parts += [coefs, at.select(*fit.by, "model", F.col("level").alias(category), F.lit(None).cast("double").alias("coef"), "at", none)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    wanted = _of_models(F.col("coef"), names, f"__l_{category}")
    if interval in names:
        wanted += _of_models(F.col("at"), [interval], f"__at_{category}") + _of_models(F.col("weight"), [interval], f"__w_{category}")
    return pin(rows.groupBy(*fit.by, category).agg(*wanted), "level-effects")


def _score(df: DataFrame, fit: Fit, names: Sequence[str], *, smearing: bool = False, interval: str | None = None, level: float = 0.8) -> tuple[DataFrame, list[str]]:
    """``linear_<model>`` of every model from one join for the groups and one for each category, and the helper columns to drop.

    ``smearing`` adds ``__s_<model>``, ``interval`` adds ``__half``, half the width of that model's prediction interval on its own scale.
    """
    quantile = None if interval is None else _t_quantiles(F.lit((1 + level) / 2), F.col("dof").cast("double"))
    before, out = set(df.columns), lookup_join(df, _group_table(fit, names, smearing, interval, quantile), list(fit.by), null_safe=True)
    users = {p: [n for n in names if p in fit.spec(n).predictors] for n in names for p in fit.spec(n).predictors if p in fit.categories}
    for p, own in users.items():
        out = lookup_join(out, _level_table(fit, p, own, interval), [*fit.by, p])
    made = {}
    for name in names:
        spec, total = fit.spec(name), F.col(f"__b_{name}")[0]
        for at, p in enumerate(fit.numeric(name), start=1):
            total = total + F.col(f"__b_{name}")[at] * feature(p, spec)
        for p in spec.predictors:
            if p in fit.categories:
                total = total + F.col(f"__l_{p}_{name}")
        made[f"linear_{name}"] = total
    if interval is not None:
        spec, gone = fit.spec(interval), fit.eliminated[interval]
        values = [feature(p, spec) for p in fit.numeric(interval)]
        small = [p for p in spec.predictors if p in fit.categories and p != gone]
        centre, weight = (F.col(f"__g_{interval}"), F.col(f"__w_{interval}")) if gone is None else (F.col(f"__at_{gone}_{interval}"), F.col(f"__w_{gone}_{interval}"))

        def square(mean: Column, i: Column) -> Column:
            apart = -mean
            for k, x in enumerate(values):
                apart = apart + x * F.get(F.col(f"__f_{interval}")[k], i)
            for p in small:
                apart = apart + F.get(F.col(f"__at_{p}_{interval}"), i)
            return apart * apart

        leverage = F.aggregate(F.transform(centre, square), F.lit(0.0), lambda total, x: total + x) + weight
        made["__half"] = F.col(f"__t_{interval}") * F.sqrt(F.col(f"__v_{interval}") * (F.lit(1.0) + leverage))
    out = out.withColumns(made)
    return out, [c for c in out.columns if c.startswith("__") and c not in before]


def linear_predictors(df: DataFrame, fit: Fit, names: Sequence[str] | None = None) -> DataFrame:
    """Add ``linear_<model>``: the prediction on the model's own scale; null for a level without a coefficient."""
    out, gone = _score(df, fit, list(names or [s.name for s in fit.specs]))
    return out.drop(*gone)


def _require_scored(df: DataFrame, column: str, name: str, strict: bool) -> None:
    require_rows(df, {f"model {name}: a row has a missing predictor or a category level the model does not know":
                      F.col(column).isNull()}, strict)


def predict(df: DataFrame, fit: Fit, name: str, *, column: str = "predicted", strict: bool = True) -> DataFrame:
    """The mean prediction in the target's units: ``exp(linear) * smearing`` for a log model."""
    spec = fit.spec(name)
    require_columns(df, spec.predictors, f"predict {name}")
    require_rows(df, log_problems([spec], target=False), strict)
    scored, gone = _score(df, fit, [name], smearing=True)
    _require_scored(scored, f"linear_{name}", name, strict)
    linear = F.col(f"linear_{name}")
    mean = F.exp(linear) * F.col(f"__s_{name}") if spec.log_scale else linear
    return scored.withColumn(column, mean).drop(f"linear_{name}", *gone)


@F.pandas_udf(T.DoubleType())
def _t_quantiles(probability: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_quantile(p, d) if d > 0 else float("nan") for p, d in zip(probability, dof)])


def price_range(df: DataFrame, fit: Fit, name: str, *, level: float = 0.8, strict: bool = True) -> DataFrame:
    """Add ``median, mean, lower, upper``: a prediction interval that covers a share ``level``.

    The variance of a prediction is ``sigma2 * (1 + leverage)``; the leverage is a sum of squares over the terms that are not levels of the
    eliminated category, plus one over the rows of the level.
    """
    if not 0 < level < 1:
        raise RuleError(f"level must be between 0 and 1, got {level}")
    spec = fit.spec(name)
    require_columns(df, spec.predictors, f"price_range {name}")
    require_rows(df, log_problems([spec], target=False), strict)
    out, gone = _score(df, fit, [name], smearing=True, interval=name, level=level)
    _require_scored(out, f"linear_{name}", name, strict)
    centre, half = F.col(f"linear_{name}"), F.col("__half")
    back = F.exp if spec.log_scale else (lambda c: c)
    mean = F.exp(centre) * F.col(f"__s_{name}") if spec.log_scale else centre
    out = out.withColumns({"median": back(centre), "mean": mean, "lower": back(centre - half), "upper": back(centre + half)})
    return out.drop(f"linear_{name}", *gone)


# ---------------------------------------------------------------- scores

def r2(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """``1 - SSE/SST`` per group. No rows, a missing value or a constant ``actual`` is an error."""
    require_columns(df, [actual, predicted, *by], "r2")
    y, fitted = F.col(actual).cast("double"), F.col(predicted).cast("double")
    result = pin(df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.pow(y - fitted, F.lit(2.0))).alias("sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("sst"), F.min(y).alias("low"), F.max(y).alias("high"),
        F.count_if(y.isNull() | fitted.isNull()).alias("unknown")), "r2").frame
    bad = result.agg(F.count(F.lit(1)).alias("groups"), F.max("unknown").alias("unknown"), F.min("n").alias("n"),
                     F.max((F.col("low") == F.col("high")).cast("int")).alias("constant")).first()
    if not bad["groups"] or not bad["n"]:
        raise DataError("r2: no rows")
    if bad["unknown"]:
        raise DataError("r2: actual or predicted has missing values")
    if bad["constant"]:
        raise DataError("r2: undefined for a constant actual value")
    return result.select(*by, "n", (F.lit(1.0) - F.col("sse") / F.col("sst")).alias("r2"))


def model_scores(df: DataFrame, fit: Fit, names: Sequence[str] | None = None, *, strict: bool = True) -> DataFrame:
    """Per group and model: ``n, r2_model_scale, r2, median_ae, mae`` on rows the model has not seen."""
    names = list(names or [s.name for s in fit.specs])
    specs = [fit.spec(n) for n in names]
    require_rows(df, log_problems(specs), strict)
    scored, _ = _score(df, fit, names, smearing=True)
    columns = []
    for spec in specs:
        linear = F.col(f"linear_{spec.name}")
        mean = F.exp(linear) * F.col(f"__s_{spec.name}") if spec.log_scale else linear
        columns.append(F.struct(F.lit(spec.name).alias("model"), response(spec).alias("y_model"), linear.alias("linear"),
                                F.col(spec.target).cast("double").alias("y"), mean.alias("predicted")))
    long = scored.select(*fit.by, F.inline(F.array(*columns)))
    keys = [*fit.by, "model"]
    error = F.abs(F.col("predicted") - F.col("y"))

    def explained(y: str, fitted: str) -> Column:
        sse = F.sum(F.pow(F.col(y) - F.col(fitted), F.lit(2.0)))
        return F.lit(1.0) - sse / F.nullif(F.var_pop(y) * F.count(F.lit(1)), F.lit(0.0))

    summary = pin(long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), explained("y_model", "linear").alias("r2_model_scale"),
        explained("y", "predicted").alias("r2"), F.avg(error).alias("mae"),
        F.count_if(F.col("predicted").isNull()).alias("__unknown"),
        (F.min("y") == F.max("y")).alias("__constant")), "scores")
    bad = summary.frame.agg(F.max("__unknown").alias("unknown"), F.max("__constant").alias("constant")).first()
    if strict and bad["unknown"]:
        raise DataError("a test row has a missing predictor or a category level the model does not know")
    if strict and bad["constant"]:
        raise DataError("R2 is undefined for a constant target")
    medians = group_quantiles(long.withColumn("error", error), {"median_ae": ("error", 0.5)}, keys)
    joined = lookup_join(summary.frame, pin(medians, "median-errors"), keys, null_safe=True)
    return joined.select(*keys, "n", "r2_model_scale", "r2", "median_ae", "mae")


def predicted_vs_actual(df: DataFrame, fit: Fit, name: str, keep: Sequence[str] = (), strict: bool = True) -> DataFrame:
    """(actual, predicted) of every row; an empty table is an error."""
    spec = fit.spec(name)
    if strict and df.isEmpty():
        raise DataError("predicted_vs_actual: no rows")
    scored = predict(df, fit, name, strict=strict)
    return scored.select(*fit.by, *keep, F.col(spec.target).cast("double").alias("actual"), "predicted")


# ---------------------------------------------------------------- importance

def group_importance(train: DataFrame, test: DataFrame, spec: ModelSpec, groups: Mapping[str, Sequence[str]], *,
                     by: Sequence[str] = (), reference_levels: Mapping[str, str] | None = None,
                     strict: bool = True) -> DataFrame:
    """R2 (model scale, test rows) lost without each group of predictors: ``group, r2_loss, shown``.

    One moments table per side serves the full model and every reduced one: a model without some predictors
    is a sub-matrix, and its test error follows from the test side's cross products.
    """
    by = tuple(by)
    references = dict(reference_levels or {})
    a = moments(train, [spec], by, strict=strict)
    b = moments(test, [spec], by, shift=a.shift, strict=strict)
    layout, shift = a.layout, a.shift
    reduced = {name: spec.without(columns) for name, columns in groups.items()}
    for name, smaller in reduced.items():
        if not smaller.predictors:
            raise RuleError(f"group_importance: no predictor is left without {name}")
    schema = T.StructType([train.schema[c] for c in by] + [
        T.StructField("group", T.StringType()), T.StructField("r2_loss", T.DoubleType())])
    keys = list(by)

    def losses(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = [pdf[pdf["is_test"] == flag] for flag in (False, True)]
        if any(len(side) == 0 for side in sides):
            raise ValueError("group_importance: a group has no training or no test rows")
        fitted, tested = (Gram(side, layout, shift) for side in sides)

        def test_r2(model: ModelSpec) -> float:
            terms, bases, _, beta, _, _ = _solve(fitted, model, references)
            for category, _ in bases:
                c = layout.categories.index(category)
                unknown = set(tested.levels[c]) - set(fitted.levels[c])
                if unknown:
                    raise ValueError(f"{category} has test levels without training rows: {sorted(unknown)}")
            y = layout.response_index(model)
            at = [(k, tested.column_of(source, level, model)) for k, (_, source, level, _) in enumerate(terms)]
            at = [(k, column) for k, column in at if column is not None]
            weights, columns = beta[[k for k, _ in at]], [column for _, column in at]
            m = tested.matrix
            sse = m[y, y] - 2 * weights @ m[columns, y] + weights @ m[np.ix_(columns, columns)] @ weights
            return 1.0 - sse / (m[y, y] - m[0, y] ** 2 / m[0, 0])

        full = test_r2(spec)
        out = pd.DataFrame({"group": list(reduced), "r2_loss": [full - test_r2(s) for s in reduced.values()]})
        for position, key in enumerate(keys):
            out.insert(position, key, [pdf[key].iloc[0]] * len(out))
        return out

    both = a.table(layout.categories).withColumn("is_test", F.lit(False)).unionByName(b.table(layout.categories).withColumn("is_test", F.lit(True)))
    result = per_group(both, by).applyInPandas(losses, schema)
    return result.withColumn("shown", F.greatest("r2_loss", F.lit(0.0))).orderBy(*by, F.desc("r2_loss"), "group")
