"""Exact grouped quantiles (linear interpolation) by selecting ranks from value counts.

Rows are reduced once to ``(group, column, value) -> count``: copies collapse on the map side, so a hot value is one row a task, and a hot group is
spread over its values. The counts are staged; everything after reads them, not the rows. Each wanted rank has a bracket of values. While a bracket
holds more values than one task should order, approximate quantiles of the values in it cut it to cells of about equal numbers of values, exact sums of
their counts tell the cell with the rank, and the cell is the next bracket. A pass divides the number of values by the number of cells whatever their
distribution; it is the measured number that ends the passes. The few values left are ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import DataError, RuleError
from ..sources.staging import stage
from .lookup import lookup_join, pin

#: Values one task orders, and the cells a larger bracket is cut to.
BRACKET_ROWS, CELLS = 10_000, 32


def group_quantiles(
    df: DataFrame,
    outputs: Mapping[str, tuple[str | Column, float]],
    by: Sequence[str] = (),
    *,
    sizes: Mapping[str, str] | None = None,
    null_message: str | None = None,
    bracket_rows: int = BRACKET_ROWS,
    approximate: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """One row per group. ``outputs`` maps a result name to ``(column, q)``.

    ``sizes`` maps a result name to a column (one of those in ``outputs``) whose known values are counted.
    ``null_message`` turns missing values into a ``DataError``; by default they are skipped.
    ``approximate`` uses ``percentile_approx`` in a single pass instead, after the same check.
    ``weight`` names a whole-number column: how many rows a row stands for (exact quantiles only).
    """
    if approximate and weight:
        raise RuleError("approximate quantiles take plain rows, not weighted ones")
    by = list(by)
    sizes = dict(sizes or {})
    sources: dict[str, tuple[str, Column]] = {}

    def register(source: str | Column) -> str:
        key = source if isinstance(source, str) else str(source)
        if key not in sources:
            expr = F.col(source) if isinstance(source, str) else source
            sources[key] = (f"c{len(sources)}", expr.cast("double"))
        return sources[key][0]

    wanted = {name: (register(source), float(q)) for name, (source, q) in outputs.items()}
    sized = {name: register(source) for name, source in sizes.items()}
    names = [c for c, _ in sources.values()]
    copies = F.lit(1) if weight is None else F.col(weight)
    named = df.select(*by, *[expr.alias(c) for c, expr in sources.values()], copies.cast("long").alias("__n"))

    if approximate:
        aggs = [F.percentile_approx(c, q, 10_000).alias(name) for name, (c, q) in wanted.items()]
        aggs += [F.count(c).alias(name) for name, c in sized.items()]
        gaps = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in names])
        told = pin(named.groupBy(*by).agg(*aggs, gaps.alias("__gaps")), "quantiles").frame
        _no_gaps(told, "__gaps", null_message)
        return told.drop("__gaps")

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in names])
    counts = stage(named.select(*by, "__n", F.inline(pairs)).groupBy(*by, "column", "value").agg(F.sum("__n").alias("n")), "value-counts")
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    shape = pin(counts.groupBy(*by, "column").agg(
        F.coalesce(F.sum(known), F.lit(0)).alias("n"), F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("gaps"),
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("value").alias("m")), "value-shapes").frame
    _no_gaps(shape, "gaps", null_message)

    asked = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(c).alias("of"), F.lit(q).alias("q")) for name, (c, q) in wanted.items()])
    each = shape.filter("n > 0").select("*", F.inline(asked)).filter("of = column").withColumn("position", F.col("q") * (F.col("n") - 1))
    both_ranks = F.array_distinct(F.array(F.floor("position"), F.ceil("position")))
    targets = each.select(*by, "column", "name", "position", F.explode(both_ranks).alias("rank"), "lo", "hi", "m", F.lit(0).cast("long").alias("before"))
    found = select_ranks(counts.filter(F.col("value").isNotNull()), targets, [*by, "column"], bracket_rows=bracket_rows)

    below = F.max(F.when(F.col("rank") == F.floor("position"), F.col("value")))
    above = F.max(F.when(F.col("rank") == F.ceil("position"), F.col("value")))
    part = F.max("position") - F.floor(F.max("position"))
    values = found.groupBy(*by, "name").agg((below + part * (above - below)).alias("v"))
    wide = values.groupBy(*by).agg(*[F.max(F.when(F.col("name") == n, F.col("v"))).alias(n) for n in wanted])
    base = shape.groupBy(*by).agg(F.count(F.lit(1)).alias("__columns"), *[
        F.coalesce(F.sum(F.when(F.col("column") == c, F.col("n"))), F.lit(0)).alias(name) for name, c in sized.items()])
    return lookup_join(base, pin(wide, "quantiles"), by, null_safe=True).select(*by, *wanted, *sizes)


def _no_gaps(table: DataFrame, column: str, message: str | None) -> None:
    if message and not table.filter(F.col(column) > 0).isEmpty():
        raise DataError(message)


def select_ranks(values: DataFrame, targets: DataFrame, keys: Sequence[str], *, bracket_rows: int = BRACKET_ROWS, cells: int = CELLS) -> DataFrame:
    """The value at each wanted rank (0-based, copies counted): the columns of ``targets`` but for the bracket's, and ``value``.

    ``values``: ``keys, value, n``, values of any numeric type. ``targets``: ``keys, rank``, further names of a target, and its bracket ``lo, hi, before,
    m``: the values that contain the rank, the copies below them and the number of rows between them.
    """
    keys = list(keys)
    names = [c for c in targets.columns if c not in (*keys, "lo", "hi", "m", "before")]

    def inside(brackets: DataFrame, small: bool) -> DataFrame:
        b = brackets.select(*[F.col(c).alias(f"__k_{c}") for c in keys], *[c for c in brackets.columns if c not in keys])
        same = [values[c].eqNullSafe(b[f"__k_{c}"]) for c in keys]
        hit = reduce(lambda x, y: x & y, same + [values["value"] >= b["lo"], values["value"] <= b["hi"]])
        return values.join(F.broadcast(b) if small else b, hit).drop(*[f"__k_{c}" for c in keys])

    current = pin(targets, "rank-brackets")
    wide = (F.col("m") > bracket_rows) & (F.col("lo") < F.col("hi"))
    while not current.frame.filter(wide).isEmpty():
        open_ = current.frame.filter(wide)
        cuts = F.percentile_approx("value", F.array(*[F.lit(i / cells) for i in range(1, cells)]), 100 * cells)
        edges = pin(inside(open_, current.small).groupBy(*keys, *names).agg(cuts.alias("edges")), "rank-edges")
        cut = lookup_join(open_, edges, [*keys, *names], null_safe=True)
        # a value that is an edge has a cell of its own
        cell = F.size(F.filter("edges", lambda e: e < F.col("value"))) + F.size(F.filter("edges", lambda e: e <= F.col("value")))
        sums = inside(cut, current.small).withColumn("cell", cell).groupBy(*keys, *names, "before", "cell").agg(
            F.sum("n").alias("copies"), F.count(F.lit(1)).alias("m"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        upto = F.col("before") + F.sum("copies").over(Window.partitionBy(*keys, *names).orderBy("cell"))
        next_ = (sums.withColumn("upto", upto).filter((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("copies") <= F.col("rank")))
                 .withColumn("before", F.col("upto") - F.col("copies")).select(*targets.columns))
        current = pin(current.frame.filter(~wide).unionByName(next_), "rank-brackets")
    settled = current.frame.filter(F.col("lo") == F.col("hi")).select(*keys, *names, F.col("lo").alias("value"))
    running = F.col("before") + F.sum("n").over(Window.partitionBy(*keys, *names).orderBy("value"))
    ordered = inside(current.frame.filter(F.col("lo") < F.col("hi")), current.small).withColumn("upto", running)
    found = ordered.filter((F.col("upto") > F.col("rank"))).groupBy(*keys, *names).agg(F.min("value").alias("value"))
    return settled.unionByName(found)
