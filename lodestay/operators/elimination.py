"""Least squares with the largest category eliminated.

The dummies of one category never stand in a row together: their block ``D`` of ``X'X`` is diagonal, the row counts of the levels. Eliminating it leaves the
cross products inside levels, ``S - sum over levels of B B' / d`` with a level's column sums ``B`` and rows ``d``, a matrix over the other terms
alone. The sum is taken level by level in many tasks, so what one task solves has the same size with ten districts and with ten million; the levels'
coefficients then follow one by one from their own sums. All levels are used in place of the intercept and told as differences from the base level.

With ``Q`` the matrix that is left and ``Q^-1 = F F'`` a triangular factor, a row with columns ``u`` in a level with means ``m`` has the leverage
``|F'(u - m)|^2 + 1 / d``: a sum of squares, from the rows of ``F`` and one vector ``F'm`` a level.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.student_t import two_sided_p
from ..rules import MOST_COMMON, ModelSpec
from ..sources.staging import stage
from .moments import INTERCEPT, Gram, Layout, Moments, independent

#: Levels of a group whose coefficients one task computes at a time.
CHUNK_LEVELS = 5_000
_NUMBERS = T.ArrayType(T.DoubleType())
TERM = T.StructType([
    T.StructField("term", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("level", T.StringType()), T.StructField("position", T.IntegerType()),
    T.StructField("coef", T.DoubleType()), T.StructField("se", T.DoubleType()),
    T.StructField("t", T.DoubleType()), T.StructField("p", T.DoubleType()),
])
_BASE = T.StructType([T.StructField("source", T.StringType()), T.StructField("level", T.StringType())])
_FACTOR = T.StructType([T.StructField("source", T.StringType()), T.StructField("level", T.StringType()), T.StructField("at", _NUMBERS)])
#: What the later pass over the levels needs of a solved model.
_INNER = [T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("beta", _NUMBERS), T.StructField("rows", T.ArrayType(_NUMBERS)),
          T.StructField("moved", _NUMBERS), T.StructField("base_level", T.StringType()), T.StructField("base_rank", T.IntegerType()),
          T.StructField("start", T.IntegerType()), T.StructField("base_effect", T.DoubleType()), T.StructField("total", T.LongType())]
_OUTER = [T.StructField("model", T.StringType()), T.StructField("n", T.LongType()), T.StructField("dof", T.LongType()), T.StructField("sigma2", T.DoubleType()),
          T.StructField("terms", T.ArrayType(TERM)), T.StructField("bases", T.ArrayType(_BASE)), T.StructField("factor", T.ArrayType(_NUMBERS)),
          T.StructField("level_factors", T.ArrayType(_FACTOR)), T.StructField("base_at", _NUMBERS), T.StructField("base_weight", T.DoubleType())]
_LEVEL = [T.StructField("model", T.StringType()), *TERM.fields, T.StructField("is_base", T.BooleanType()), T.StructField("at", _NUMBERS), T.StructField("weight", T.DoubleType())]


def eliminated(learned: Moments, specs: Sequence[ModelSpec]) -> dict[str, str | None]:
    """The category each model is rid of: the one of its predictors with the most levels, the first of equals, none without categories."""
    names = learned.layout.categories
    counts = learned.cells.agg(*[F.count_distinct(c).alias(c) for c in names]).first().asDict() if names else {}
    return {s.name: max((p for p in s.predictors if p in counts), key=counts.__getitem__, default=None) for s in specs}


def _level_sums(learned: Moments, category: str | None) -> DataFrame:
    """by, level, sums, parts, sizes (row counts of the other categories' combinations), rank and total of the levels in their group."""
    others = [F.col(c).cast("string") for c in learned.layout.categories if c != category]
    level = F.lit("") if category is None else F.col(category).cast("string")
    sums = F.array(*[F.sum(f"z{i}") for i in range(learned.layout.width)])
    rows = learned.cells.select("*", level.alias("level")).groupBy(*learned.by, "level").agg(
        sums.alias("sums"), F.collect_list(F.array(*others).cast("array<string>")).alias("parts"), F.collect_list("z0").alias("sizes"))
    group = Window.partitionBy(*learned.by)
    return stage(rows.withColumn("rank", F.row_number().over(group.orderBy("level")) - 1).withColumn("total", F.count("*").over(group)), "level-sums")


def _column_sums(rows: pd.DataFrame, width: int, shift: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Names and sums, a row a level, of the shifted numeric columns and of the other categories' dummies."""
    raw = np.array([np.asarray(v, dtype=float) for v in rows["sums"]]).reshape(len(rows), width)
    dummies: dict[str, dict[int, float]] = {}
    for at, (parts, sizes) in enumerate(zip(rows["parts"], rows["sizes"])):
        for levels, n in zip(parts, sizes):
            for c, level in enumerate(levels):
                column = dummies.setdefault(f"{c}:{level}", {})
                column[at] = column.get(at, 0.0) + n
    shifted = raw - np.outer(raw[:, 0], shift)
    shifted[:, 0] = raw[:, 0]
    extra = np.zeros((len(rows), len(dummies)))
    for k, column in enumerate(dummies.values()):
        extra[list(column), k] = list(column.values())
    return [*map(str, range(width)), *dummies], np.hstack([shifted, extra])


def _reduction(levels: DataFrame, learned: Moments) -> DataFrame:
    """by, row, column, value: the sum over levels of ``B B' / d``; every task adds up its levels first."""
    width, shift, by = learned.layout.width, np.array(learned.shift), list(learned.by)
    schema = T.StructType([levels.schema[c] for c in by] + [T.StructField("row", T.StringType()), T.StructField("column", T.StringType()), T.StructField("value", T.DoubleType())])

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple, np.ndarray] = {}
        for batch in batches:
            groups = batch.groupby(by, dropna=False, sort=False).indices.items() if by else [((), np.arange(len(batch)))]
            for name, where in groups:
                keys, sums = _column_sums(batch.iloc[where], width, shift)
                key = (name if isinstance(name, tuple) else (name,), tuple(keys))
                product = (sums / sums[:, :1]).T @ sums
                totals[key] = totals[key] + product if key in totals else product
        for (name, keys), total in totals.items():
            i, j = np.indices(total.shape).reshape(2, -1)
            out = pd.DataFrame({"row": [keys[k] for k in i], "column": [keys[k] for k in j], "value": total.ravel()})
            for position, c in enumerate(by):
                out.insert(position, c, [name[position]] * len(out))
            yield out

    return levels.select(*by, "sums", "parts", "sizes").mapInPandas(add_up, schema).groupBy(*by, "row", "column").agg(F.sum("value").alias("value"))


def _base_rows(levels: DataFrame, by: Sequence[str], wanted: str | None) -> DataFrame:
    """The base level's row of every group: the first, the most common (ties by name), or the one named."""
    first = F.struct((-F.col("sums")[0]).alias("n"), "level") if wanted == MOST_COMMON else F.struct(
        (F.lit(False) if wanted is None else F.col("level") != wanted).alias("n"), "level")
    row = F.min_by(F.struct("level", "sums", "parts", "sizes", "rank", "total"), first)
    return levels.groupBy(*by).agg(row.alias("base")).select(*by, "base.level", F.col("base.sums").alias("base_sums"), "base.parts", "base.sizes", "base.rank", "base.total")


class _Inside:
    """A group's cross products inside the levels of the eliminated category."""

    def __init__(self, pdf: pd.DataFrame, layout: Layout, shift: Sequence[float]):
        self.gram = Gram(pdf[pdf["row"].isna() & pdf["base_sums"].isna()], layout, shift)
        self.layout, self.shift = layout, np.array(shift)
        self.place = {str(i): i for i in range(layout.width)} | {f"{c}:{level}": at for (c, level), at in self.gram.columns.items()}
        self.names = {at: key for key, at in self.place.items()}
        within, part = self.gram.matrix.copy(), pdf[pdf["row"].notna()]
        np.subtract.at(within, ([self.place[k] for k in part["row"]], [self.place[k] for k in part["column"]]), part["value"].to_numpy(dtype=float))
        self.within = (within + within.T) / 2
        self.base = pdf[pdf["base_sums"].notna()].iloc[0]
        keys, sums = _column_sums(pd.DataFrame([self.base]).assign(sums=[self.base["base_sums"]]), layout.width, self.shift)
        self.means = np.zeros(len(within))
        self.means[[self.place[k] for k in keys]] = sums[0] / sums[0, 0]
        self.rows = float(sums[0, 0])

    def solve(self, spec: ModelSpec, category: str | None, references: Mapping[str, str]) -> dict:
        """A solved model, without its group's columns."""
        total, y = int(self.base["total"]), self.layout.response_index(spec)
        terms, bases, start, position = [], [], 0, 1
        for p in spec.predictors:
            if p == category:
                start, position = position, position + total - 1
                continue
            if p not in self.layout.categories:
                terms.append((p, p, None, self.layout.index(p, spec), position))
            else:
                c, base = self.layout.categories.index(p), self.gram.base(p, references.get(p))
                bases.append((p, base))
                for level in self.gram.levels[c]:
                    if level != base:
                        terms.append((f"{p}: {level}", p, level, self.gram.columns[c, level], position + len([t for t in terms if t[1] == p])))
            position += 1 if p not in self.layout.categories else len(self.gram.levels[c]) - 1
        columns = [t[3] for t in terms]
        xx, xy = self.within[np.ix_(columns, columns)], self.within[columns, y]
        kept = independent(xx, np.diag(self.gram.matrix)[columns])
        scale = 1.0 / np.sqrt(np.diag(xx)[kept])
        factor = np.zeros((len(terms), len(kept)))
        factor[kept] = scale[:, None] * np.linalg.inv(np.linalg.cholesky(xx[np.ix_(kept, kept)] * np.outer(scale, scale))).T
        beta = factor @ (factor.T @ xy)
        residual = max(float(self.within[y, y] - 2 * beta @ xy + beta @ xx @ beta), 0.0)
        n = int(round(self.gram.n))
        dof = n - len(kept) - total
        sigma2 = residual / dof if dof > 0 else float("nan")
        shift = np.array([self.shift[c] if c < self.layout.width else 0.0 for c in columns])
        means = self.means[columns]
        effect = float(self.means[y] - means @ beta)
        intercept = effect + float(self.shift[y] - shift @ beta)
        zero = factor.T @ (-shift - means)
        told = [_term(INTERCEPT, INTERCEPT, None, 0, intercept, float(zero @ zero) + 1 / self.rows, sigma2, dof)]
        told += [_term(*t[:3], t[4], float(b), float(row @ row) if k in kept else None, sigma2, dof) for k, (t, b, row) in enumerate(zip(terms, beta, factor))]
        at = {(t[1], t[2]): row.tolist() for t, row in zip(terms, factor)}
        listed = [{"source": s, "level": v, "at": at[s, v]} for s, v in at if v is not None] + [{"source": s, "level": v, "at": [0.0] * len(kept)} for s, v in bases]
        moved = factor.T @ shift
        return {"model": spec.name, "n": n, "dof": dof, "sigma2": sigma2, "terms": told, "bases": [{"source": s, "level": v} for s, v in bases],
                "factor": [row.tolist() for t, row in zip(terms, factor) if t[2] is None], "level_factors": listed, "base_at": (factor.T @ means + moved).tolist(),
                "base_weight": 1 / self.rows, "keys": [self.names[c] for c in [*columns, y]], "beta": beta.tolist(), "rows": factor.tolist(), "moved": moved.tolist(),
                "base_level": self.base["level"], "base_rank": int(self.base["rank"]), "start": start, "base_effect": effect, "total": total}


def _term(term, source, level, position, coef, spread, sigma2, dof) -> dict:
    """``spread``: the coefficient's variance over sigma2; None for a term that follows from those before it."""
    se = float(np.sqrt(max(sigma2 * spread, 0.0))) if dof > 0 and spread is not None else None
    t = None if se is None else (coef / se if se > 0 else float("inf"))
    return {"term": term, "source": source, "level": level, "position": position, "coef": coef, "se": se, "t": t, "p": None if t is None else two_sided_p(t, dof)}


def solve_models(learned: Moments, specs: Sequence[ModelSpec], category: str | None, references: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Solved models (a row a group and model) and the levels of ``category`` (a row a group, model and level).

    The levels stand before all other terms: a term that is a linear combination of levels and earlier terms has coefficient 0 and no p-value.
    """
    by, shift = list(learned.by), learned.shift
    layout = replace(learned.layout, categories=tuple(c for c in learned.layout.categories if c != category))
    levels = _level_sums(learned, category)
    wanted = references.get(category) if category else None
    whole = learned.table(layout.categories).unionByName(_reduction(levels, learned), allowMissingColumns=True).unionByName(
        _base_rows(levels, by, wanted), allowMissingColumns=True)
    schema = T.StructType([whole.schema[c] for c in by] + _OUTER + _INNER)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        inside = _Inside(pdf, layout, shift)
        if wanted not in (None, MOST_COMMON, inside.base["level"]):
            raise ValueError(f"reference level {wanted} does not occur in {category}")
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in by}, **inside.solve(s, category, references)} for s in specs], columns=[f.name for f in schema.fields])

    solved = stage(per_group(whole, by).applyInPandas(solve, schema), "solved")
    outer = solved.select(*by, *[f.name for f in _OUTER])
    told = T.StructType([whole.schema[c] for c in by] + _LEVEL)
    if category is None:
        return outer, solved.sparkSession.createDataFrame([], told)

    def tell(rows: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
        out = []
        if not len(rows):
            return pd.DataFrame(out, columns=[f.name for f in told.fields])
        keys, sums = _column_sums(rows, layout.width, np.array(shift))
        means = sums / sums[:, :1]
        place = {k: i for i, k in enumerate(keys)}
        for m in models.itertuples(index=False):
            own = np.array([means[:, place[k]] if k in place else np.zeros(len(means)) for k in m.keys]).T
            beta, factor = np.array(m.beta), np.array([np.asarray(r, dtype=float) for r in m.rows]).reshape(len(m.beta), len(m.moved))
            at = own[:, :-1] @ factor
            moved = np.asarray(m.moved, dtype=float)
            coef = own[:, -1] - own[:, :-1] @ beta - m.base_effect
            apart = at - (np.asarray(m.base_at, dtype=float) - moved)
            spread = (apart ** 2).sum(axis=1) + 1 / sums[:, 0] + m.base_weight
            for k, (level, rank) in enumerate(zip(rows["level"], rows["rank"])):
                base = rank == m.base_rank
                term = _term(f"{category}: {level}", category, level, -1 if base else int(m.start + rank - (rank > m.base_rank)), 0.0 if base else float(coef[k]),
                             None if base else float(spread[k]), m.sigma2, m.dof)
                out.append({**{c: rows[c].iloc[0] for c in by}, "model": m.model, **term, "is_base": bool(base), "at": (at[k] + moved).tolist(), "weight": 1 / sums[k, 0]})
        return pd.DataFrame(out, columns=[f.name for f in told.fields])

    chunks = F.ceil(F.col("total") / CHUNK_LEVELS).cast("int")
    left = levels.withColumn("chunk", F.pmod(F.hash("level"), chunks))
    right = solved.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return outer, left.groupBy(*by, "chunk").cogroup(right.groupBy(*by, "chunk")).applyInPandas(tell, told)


def per_group(table: DataFrame, by: Sequence[str]):
    return table.groupBy(*by) if by else table.withColumn("__all", F.lit(1)).groupBy("__all")
