"""Sufficient statistics of least squares: what all models of all groups need to know of the training rows.

Two narrow passes over the rows:

1. per combination of categories: row count and the sum of every numeric column (plain ``groupBy``);
2. cross products of the numeric columns, as one partial matrix per task, shifted by the means of pass 1.

Together they hold the whole ``X'X`` and ``X'y`` including every dummy column, because a dummy times a
number is a sum inside a category.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DataError, require_columns
from ..rules import MOST_COMMON, ModelSpec
from ..sources.staging import stage

INTERCEPT = "(Intercept)"
ALIAS_TOLERANCE = 1e-11


def log_problems(specs: Sequence[ModelSpec], target: bool = True) -> dict[str, Column]:
    problems: dict[str, Column] = {}
    for spec in specs:
        for c in spec.log1p_predictors:
            problems[f"missing value in column {c}"] = F.col(c).isNull()
            problems[f"value <= -1 in column {c}"] = F.col(c) <= -1
        if target:
            problems[f"missing value in column {spec.target}"] = F.col(spec.target).isNull()
            if spec.log_scale:
                problems[f"value <= 0 in column {spec.target}"] = F.col(spec.target) <= 0
    return problems


def feature(column: str, spec: ModelSpec) -> Column:
    """A numeric predictor as it enters the model."""
    value = F.col(column).cast("double")
    return F.log1p(value) if column in spec.log1p_predictors else value


def response(spec: ModelSpec) -> Column:
    value = F.col(spec.target).cast("double")
    return F.ln(value) if spec.log_scale else value


# ---------------------------------------------------------------- layout

@dataclass(frozen=True)
class Layout:
    """Which numeric columns exist (position 0 is the constant 1) and which predictors are categories."""

    categories: tuple[str, ...]
    numeric: tuple[tuple[str, bool], ...]
    responses: tuple[tuple[str, bool], ...]

    @classmethod
    def of(cls, df: DataFrame, specs: Sequence[ModelSpec]) -> "Layout":
        for spec in specs:
            require_columns(df, [spec.target, *spec.predictors], f"model {spec.name}")
        text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        names = dict.fromkeys(p for s in specs for p in s.predictors if p in text)
        numeric = dict.fromkeys((p, p in s.log1p_predictors) for s in specs for p in s.predictors if p not in text)
        return cls(tuple(names), tuple(numeric), tuple(dict.fromkeys((s.target, s.log_scale) for s in specs)))

    @property
    def width(self) -> int:
        return 1 + len(self.numeric) + len(self.responses)

    def columns(self) -> list[Column]:
        made = [F.lit(1.0)]
        made += [F.log1p(F.col(c).cast("double")) if logged else F.col(c).cast("double") for c, logged in self.numeric]
        made += [F.ln(F.col(c).cast("double")) if logged else F.col(c).cast("double") for c, logged in self.responses]
        return [c.alias(f"z{i}") for i, c in enumerate(made)]

    def index(self, column: str, spec: ModelSpec) -> int:
        return 1 + self.numeric.index((column, column in spec.log1p_predictors))

    def response_index(self, spec: ModelSpec) -> int:
        return 1 + len(self.numeric) + self.responses.index((spec.target, spec.log_scale))


# ---------------------------------------------------------------- sufficient statistics

@dataclass(frozen=True)
class Moments:
    """``cells``: by, categories and sums (one row per category combination); ``block``: by, i, j, value (cross products)."""

    layout: Layout
    by: tuple[str, ...]
    shift: tuple[float, ...]
    cells: DataFrame
    block: DataFrame

    def table(self, categories: Sequence[str]) -> DataFrame:
        """Both as one table: ``by, levels, sums`` of the combinations of ``categories``, or ``by, i, j, value``."""
        empty = F.lit(None)
        levels = F.array(*[F.col(c).cast("string") for c in categories]).cast("array<string>")
        sums = F.array(*[F.sum(f"z{i}") for i in range(self.layout.width)])
        return self.cells.groupBy(*self.by, *categories).agg(sums.alias("sums")).select(
            *self.by, levels.alias("levels"), "sums", empty.cast("int").alias("i"), empty.cast("int").alias("j"),
            empty.cast("double").alias("value"),
        ).unionByName(self.block.select(
            *self.by, empty.cast("array<string>").alias("levels"), empty.cast("array<double>").alias("sums"), "i", "j", "value"))


def _checks(specs: Sequence[ModelSpec], layout: Layout) -> dict[str, Column]:
    problems = {f"missing value in column {c}": F.col(c).isNull()
                for c in dict.fromkeys([*layout.categories, *(c for c, _ in layout.numeric)])}
    return problems | log_problems(specs)


def moments(df: DataFrame, specs: Sequence[ModelSpec], by: Sequence[str] = (), *, shift: Sequence[float] | None = None,
            strict: bool = True) -> Moments:
    """Sufficient statistics of all ``specs`` per group. ``shift`` reuses the shift of other moments."""
    layout = Layout.of(df, specs)
    by = tuple(by)
    z = [f"z{i}" for i in range(layout.width)]
    problems = _checks(specs, layout)
    # one bit per check, folded into the first pass
    masks = []
    for start in range(0, len(problems), 60):
        part = list(problems.values())[start:start + 60]
        bits = [F.when(bad, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, bad in enumerate(part)]
        total = bits[0]
        for b in bits[1:]:
            total = total + b
        masks.append(total.alias(f"mask{len(masks)}"))
    rows = df.select(*by, *layout.categories, *layout.columns(), *masks)
    cells = stage(
        rows.groupBy(*by, *layout.categories)
        .agg(*[F.sum(c).alias(c) for c in z], *[F.bit_or(f"mask{i}").alias(f"mask{i}") for i in range(len(masks))]),
        "moment-cells")
    overall = cells.agg(*[F.sum(c).alias(c) for c in z],
                        *[F.bit_or(f"mask{i}").alias(f"mask{i}") for i in range(len(masks))]).first()
    if overall["z0"] is None:
        raise DataError("no rows to learn from")
    names = list(problems)
    hit = [names[60 * m + i] for m in range(len(masks)) for i in range(60) if (overall[f"mask{m}"] or 0) >> i & 1]
    if hit and strict:
        raise DataError("; ".join(hit))
    if shift is None:
        shift = [0.0] + [float((overall[c] or 0.0) / overall["z0"]) for c in z[1:]]

    partial = T.StructType([df.schema[c] for c in by] + [
        T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("value", T.DoubleType())])
    offsets = np.array(shift)
    upper_i, upper_j = np.triu_indices(layout.width)
    keys = list(by)

    def cross_products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            values = batch[z].to_numpy(dtype=float) - offsets
            groups = (batch.groupby(keys, dropna=False, sort=False).indices.items() if keys
                      else [((), np.arange(len(batch)))])
            for name, where in groups:
                name = name if isinstance(name, tuple) else (name,)
                part = values[where]
                product = part.T @ part
                sums[name] = sums[name] + product if name in sums else product
        for name, total in sums.items():
            out = pd.DataFrame({"i": upper_i, "j": upper_j, "value": total[upper_i, upper_j]})
            for position, key in enumerate(keys):
                out.insert(position, key, [name[position]] * len(out))
            yield out

    block = (rows.select(*by, *z).mapInPandas(cross_products, partial)
             .groupBy(*by, "i", "j").agg(F.sum("value").alias("value")))
    return Moments(layout, by, tuple(shift), cells, block)


class Gram:
    """The cross-product matrix of one group over [1, numerics, responses, dummies]."""

    def __init__(self, pdf: pd.DataFrame, layout: Layout, shift: Sequence[float]):
        width, s = layout.width, np.array(shift)
        block = pdf[pdf["i"].notna()]
        core = np.zeros((width, width))
        i, j = block["i"].to_numpy(dtype=int), block["j"].to_numpy(dtype=int)
        core[i, j] = block["value"].to_numpy(dtype=float)
        core[j, i] = core[i, j]
        cells = pdf[pdf["i"].isna()]
        names = [list(v) for v in cells["levels"]]
        raw = np.array([np.asarray(v, dtype=float) for v in cells["sums"]]).reshape(len(names), width)
        sums = raw - np.outer(raw[:, 0], s)
        sums[:, 0] = raw[:, 0]
        self.levels = [sorted({n[c] for n in names}) for c in range(len(layout.categories))]
        self.columns = {(c, level): width + at for at, (c, level) in enumerate(
            (c, level) for c in range(len(layout.categories)) for level in self.levels[c])}
        matrix = np.zeros((width + len(self.columns),) * 2)
        matrix[:width, :width] = core
        for name, row in zip(names, sums):
            at = [self.columns[c, level] for c, level in enumerate(name)]
            for a in at:
                matrix[a, :width] += row
                matrix[:width, a] += row
                for b in at:
                    matrix[a, b] += row[0]
        self.matrix = matrix
        self.layout = layout
        self.n = float(core[0, 0])

    def base(self, category: str, wanted: str | None) -> str:
        c = self.layout.categories.index(category)
        if wanted is None:
            return self.levels[c][0]
        if wanted == MOST_COMMON:
            return min(self.levels[c], key=lambda v: (-self.matrix[0, self.columns[c, v]], v))
        if wanted not in self.levels[c]:
            raise ValueError(f"reference level {wanted} does not occur in {category}")
        return wanted

    def design(self, spec: ModelSpec, references: Mapping[str, str]):
        """Terms of a model as (term, source, level, matrix column), and the base level per category."""
        terms, bases = [(INTERCEPT, INTERCEPT, None, 0)], []
        for p in spec.predictors:
            if p not in self.layout.categories:
                terms.append((p, p, None, self.layout.index(p, spec)))
                continue
            c = self.layout.categories.index(p)
            base = self.base(p, references.get(p))
            bases.append((p, base))
            terms += [(f"{p}: {v}", p, v, self.columns[c, v]) for v in self.levels[c] if v != base]
        return terms, bases

    def column_of(self, source: str, level: str | None, spec: ModelSpec) -> int | None:
        if source == INTERCEPT:
            return 0
        if level is None:
            return self.layout.index(source, spec)
        return self.columns.get((self.layout.categories.index(source), level))


def independent(gram: np.ndarray, size: np.ndarray | None = None) -> list[int]:
    """Columns, in order, that are not linear combinations of earlier ones; ``size`` is what their squares are measured against."""
    work = gram.copy()
    size = np.diag(gram).copy() if size is None else size
    kept = []
    for c in range(len(work)):
        if size[c] > 0 and work[c, c] > ALIAS_TOLERANCE * size[c]:
            kept.append(c)
            work[c + 1:, c + 1:] -= np.outer(work[c + 1:, c], work[c, c + 1:]) / work[c, c]
    return kept
