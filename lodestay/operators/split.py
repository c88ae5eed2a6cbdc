"""Exact-count train/test split without a global ranking.

Rows are ordered by ``md5(key:seed)`` (random) or by a numeric key. The cut is one row, found by rank selection, and every other row is
compared with it. Digests are spread evenly: their leading hex digits cut a group to cells of about equal size, so one count by cell tells the cell
with the cut, and only its rows are ranked. Numeric keys may lie anywhere: the numbers that can hold the cut are narrowed until few are left.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DataError, RuleError, require_columns
from ..sources.staging import stage
from .lookup import Lookup, lookup_join, pin
from .quantiles import select_ranks

#: Leading hex digits of a digest that name its cell, and the rows of a cell that one task puts in order.
DIGITS, CELL_ROWS = 3, 500_000


def as_fraction(test_size: float) -> float:
    fraction = test_size / 100 if test_size > 1 else test_size
    if not 0 < fraction < 1:
        raise RuleError(f"test_size must be between 0 and 1 (or between 1 and 100 percent), got {test_size}")
    return float(fraction)


def _check_sides(totals: DataFrame, by: Sequence[str], test_size: float) -> None:
    bad = totals.filter((F.col("n_test") == 0) | (F.col("n_train") == 0)).limit(1).collect()
    if bad:
        side = "test" if bad[0]["n_test"] == 0 else "training"
        where = "".join(f" in {c}={bad[0][c]}" for c in by)
        raise RuleError(f"test_size {test_size} gives an empty {side} set{where}")


def split_exact(df: DataFrame, test_size: float, *, seed: int | None = None, key: Sequence[str] = ("id",),
                by: Sequence[str] = (), random_selection: bool = True) -> DataFrame:
    """Add a boolean ``is_test`` with exactly ``round(fraction * n)`` true rows per group (ties to even).

    ``key`` must identify a row within its group. With ``random_selection=False`` the rows with the largest
    value of the single numeric key are the test rows; a missing key is an error.
    """
    fraction = as_fraction(test_size)
    key, by = list(key), list(by)
    require_columns(df, [*key, *by], "split_exact")
    n_test = F.bround(F.lit(fraction) * F.col("n_rows")).cast("long")

    if random_selection:
        # an unseeded draw is still one draw: its seed is fixed here, not per row or per retry
        salt = F.lit(uuid.uuid4().hex if seed is None else str(seed))
        return _split_by_digest(df, F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in key], salt).cast("binary")), key, by, n_test, test_size)
    if len(key) != 1:
        raise RuleError("split_exact: an ordered split needs one numeric key")
    order = F.col(key[0]) if isinstance(df.schema[key[0]].dataType, T.NumericType) else F.col(key[0]).cast("double")

    values = df.select(*by, order.alias("value"), F.lit(1).cast("long").alias("n"))
    values = values if by else values.withColumn("__all", F.lit(1))
    groups = by or ["__all"]
    totals = pin(
        values.groupBy(*groups).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("gaps"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .withColumn("n_test", n_test).withColumn("n_train", F.col("n_rows") - n_test), "split-totals").frame
    if not totals.filter("gaps > 0").isEmpty():
        raise DataError(f"split_exact: missing value in column {key[0]}")
    _check_sides(totals, by, test_size)
    targets = totals.select(*groups, "n_train", (F.col("n_train") - 1).alias("rank"), "lo", "hi", F.col("n_rows").alias("m"), F.lit(0).cast("long").alias("before"))
    cut = pin(select_ranks(values, targets, groups).select(*by, F.col("value").alias("__cut")), "split-cut")
    return lookup_join(df, cut, by, null_safe=True).withColumn("is_test", order > F.col("__cut")).drop("__cut")


def _split_by_digest(df: DataFrame, digest: Column, key: Sequence[str], by: Sequence[str], n_test: Column, test_size: float) -> DataFrame:
    """The rows behind the cut in the order of digest and key. Two passes over the keys find it, however many copies a key has."""
    rest = [f"__k{i}" for i in range(len(key))]
    rows = df.select(*by, digest.alias("__h"), *[F.col(k).alias(r) for k, r in zip(key, rest)])

    def cells(table: DataFrame, digits: int, copies: Column) -> DataFrame:
        """Each cell's copies, distinct rows and the copies of its group up to its end, in order."""
        sums = table.groupBy(*by, F.substring("__h", 1, digits).alias("__cell")).agg(F.sum(copies).alias("copies"), F.count(F.lit(1)).alias("m"))
        group = Window.partitionBy(*by)
        return sums.withColumn("upto", F.sum("copies").over(group.orderBy("__cell"))).withColumn("n_rows", F.sum("copies").over(group))

    def holds(rank: str) -> Column:
        return (F.col("upto") >= F.col(rank)) & (F.col("upto") - F.col("copies") < F.col(rank))

    counted = cells(rows, DIGITS, F.lit(1)).withColumn("n_test", n_test).withColumn("n_train", F.col("n_rows") - F.col("n_test"))
    # a side that is empty has no cut; its group is told by its first cell
    first = F.col("upto") == F.col("copies")
    found = pin(counted.filter(holds("n_train") | first).select(*by, "__cell", "m", "n_test", "n_train", (F.col("n_train") - (F.col("upto") - F.col("copies"))).alias("__rank"),
                                                               holds("n_train").alias("__holds")), "split-cells")
    _check_sides(found.frame, by, test_size)
    cell = found.frame.filter("__holds").select(*by, "__cell", "__rank")
    largest = found.frame.filter("__holds").agg(F.max("m")).first()[0]
    inside = _in_cells(rows, Lookup(cell, found.small), by, DIGITS).groupBy(*by, "__rank", "__h", *rest).agg(F.count(F.lit(1)).alias("n"))
    digits = DIGITS
    if (largest or 0) > CELL_ROWS:
        inside = stage(inside, "split-inside")
        largest = inside.groupBy(*by).count().agg(F.max("count")).first()[0]
        while largest > CELL_ROWS and digits < 32:
            digits += DIGITS
            ranks = inside.select(*by, "__rank").distinct()
            narrowed = pin(lookup_join(cells(inside, digits, F.col("n")), pin(ranks, "split-ranks"), by, null_safe=True).filter(holds("__rank"))
                           .select(*by, "__cell", "m", (F.col("__rank") - (F.col("upto") - F.col("copies"))).alias("__rank")), "split-cells")
            largest = narrowed.frame.agg(F.max("m")).first()[0]
            inside = _in_cells(inside.drop("__rank"), Lookup(narrowed.frame.drop("m"), narrowed.small), by, digits)
    order = F.struct("__h", *rest)
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy(order))
    reached = inside.withColumn("upto", upto).filter(F.col("upto") >= F.col("__rank"))
    last = pin(reached.groupBy(*by).agg(F.min(order).alias("__last")).select(*by, F.col("__last.__h").alias("__cut"), "__last"), "split-cut")
    joined = lookup_join(df.withColumn("__h", digest), last, by, null_safe=True)
    same = F.struct("__h", *[F.col(k).alias(r) for k, r in zip(key, rest)])
    behind = (F.col("__h") > F.col("__cut")) | ((F.col("__h") == F.col("__cut")) & (same > F.col("__last")))
    return joined.withColumn("is_test", behind).drop("__h", "__cut", "__last")


def _in_cells(rows: DataFrame, cells: Lookup, by: Sequence[str], digits: int) -> DataFrame:
    """Rows whose digest begins with the cell of their group, with the cell's other columns."""
    marked = rows.withColumn("__cell", F.substring("__h", 1, digits))
    return lookup_join(marked, cells, [*by, "__cell"], how="inner", null_safe=True).drop("__cell")


def split_dataset(df: DataFrame, test_size: float, **options) -> tuple[DataFrame, DataFrame]:
    """The two sides of :func:`split_exact`."""
    marked = split_exact(df, test_size, **options)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")
