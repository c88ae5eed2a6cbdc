"""Joining per-group statistics to big tables.

A statistics table is *pinned*: if it proves small (rows and bytes are both checked) it becomes a local
relation and every join broadcasts it; if not, it is staged and joined by a salted shuffle, so that a
group holding a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import require_columns
from ..sources.staging import stage

MAX_ROWS = 100_000
MAX_BYTES = 32 << 20
SALTS = 16


@dataclass(frozen=True)
class Lookup:
    frame: DataFrame
    small: bool


def pin(df: DataFrame, label: str = "lookup", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Lookup:
    """Evaluate a statistics table once. At most ``max_rows + 1`` rows ever reach the driver."""
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows <= max_rows and table.nbytes <= max_bytes:
        return Lookup(df.sparkSession.createDataFrame(table, schema=df.schema), True)
    return Lookup(stage(df, label), False)


def constant(value, kind: T.DataType) -> str:
    """A value of a one-row lookup as SQL text, structs and arrays included."""
    if value is None:
        return f"CAST(NULL AS {kind.simpleString()})"
    if isinstance(kind, T.StructType):
        return "named_struct(" + ", ".join(f"'{f.name}', {constant(v, f.dataType)}" for f, v in zip(kind, value)) + ")"
    if isinstance(kind, T.ArrayType):
        return f"CAST(array({', '.join(constant(v, kind.elementType) for v in value)}) AS {kind.simpleString()})"
    if isinstance(kind, T.StringType):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(kind, T.DoubleType):
        return f"{value!r}D" if math.isfinite(value) else f"CAST('{value}' AS DOUBLE)"
    return f"CAST({value} AS {kind.simpleString()})"


def lookup_join(df: DataFrame, lookup: Lookup | DataFrame, on: Sequence[str], how: str = "left",
                null_safe: bool = False) -> DataFrame:
    """Add the lookup's columns to ``df``. ``on`` empty: the lookup is one row of constants."""
    if isinstance(lookup, DataFrame):
        lookup = pin(lookup)
    values = [c for c in lookup.frame.columns if c not in on]
    if not on:
        row = lookup.frame.first()
        types = lookup.frame.schema
        return df.withColumns({c: F.expr(constant(None if row is None else row[c], types[c].dataType)) for c in values})
    require_columns(df, on, "lookup_join")
    keyed = lookup.frame.select(*[F.col(c).alias(f"__k_{c}") for c in on], *values)
    if lookup.small:
        right, left, extra = F.broadcast(keyed), df, []
    else:
        right = keyed.withColumn("__k_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        left = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
        extra = [F.col("__salt") == F.col("__k_salt")]

    def same(c: str) -> Column:
        return left[c].eqNullSafe(right[f"__k_{c}"]) if null_safe else left[c] == right[f"__k_{c}"]

    condition = reduce(lambda a, b: a & b, [same(c) for c in on] + extra)
    joined = left.join(right, condition, how)
    return joined.drop(*[f"__k_{c}" for c in on], "__salt", "__k_salt")
