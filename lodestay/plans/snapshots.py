"""What growing snapshots teach, kept so that a new one is read alone.

Caps, kept districts and centres follow from value counts; coefficients, standard errors and p-values follow from cell sums and cross products. Both only ever
add up, so each snapshot (a file, a month, a city) leaves its own small tables and the union of any snapshots is their sum: none is read again when another comes,
and one that is dropped is out of the sum. A snapshot's tables are written first and named last, in one step. A name counts once, however often its
writer was repeated.

Counts have one row for each value of a group and cross products one for each pair of columns, whatever the number of listings. Cross products of
snapshots were taken about different means; they are moved to the mean of the union, which is where one pass over all rows would have put them.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import RuleError, require_columns, require_rows
from ..operators.features import frequent_categories, group_caps
from ..operators.lookup import lookup_join, pin
from ..operators.moments import Layout, Moments, moments
from ..rules import ModelSpec, Rules
from ..sources.listings import file_system_of
from ..sources.staging import stage
from .training import Fitted

_NAME = re.compile(r"[\w.-]+")


def _complete(spark: SparkSession, root: str, kind: str) -> dict[str, str]:
    """Folder by name of all complete snapshots; of two writers of one name the first in order is taken."""
    file_system, where = file_system_of(spark, f"{root}/{kind}/names")
    if not file_system.exists(where):
        return {}
    marks = sorted((f.getPath().getName() for f in file_system.listStatus(where)), reverse=True)
    return {m.rpartition("@")[0]: f"{root}/{kind}/{m}" for m in marks if "@" in m}


def snapshot_names(spark: SparkSession, root: str, kind: str = "counts") -> list[str]:
    """Names of the snapshots whose ``kind`` (``counts`` or ``moments``) is complete."""
    return sorted(_complete(spark, root, kind))


def _publish(spark: SparkSession, root: str, kind: str, name: str, frames: dict[str, DataFrame]) -> None:
    mark = f"{name}@{uuid.uuid4().hex}"
    for part, frame in frames.items():
        frame.write.parquet(f"{root}/{kind}/{mark}/{part}")
    file_system, where = file_system_of(spark, f"{root}/{kind}/names/{mark}")
    file_system.create(where, False).close()


def _new_name(spark: SparkSession, root: str, kind: str, name: str) -> None:
    if not _NAME.fullmatch(name):
        raise RuleError(f"a snapshot's name has letters, digits, _ . and - only, got {name}")
    if name in _complete(spark, root, kind):
        raise RuleError(f"snapshot {name} is counted already")


def _read(spark: SparkSession, root: str, kind: str, part: str, names: Sequence[str] | None) -> DataFrame:
    there = _complete(spark, root, kind)
    absent = sorted(set(names or ()) - set(there))
    if absent or not there:
        raise RuleError(f"no snapshot {', '.join(absent) or 'at all'} in {root}")
    return spark.read.parquet(*[f"{there[n]}/{part}" for n in (sorted(there) if names is None else dict.fromkeys(names))])


def drop_snapshot(spark: SparkSession, root: str, name: str) -> None:
    """Take a snapshot out of every later sum, names before tables. Unknown names are an error."""
    found = False
    for kind in ("counts", "moments"):
        while name in (there := _complete(spark, root, kind)):
            found, folder = True, there[name]
            for path in (f"{root}/{kind}/names/{folder.rpartition('/')[2]}", folder):
                file_system, where = file_system_of(spark, path)
                file_system.delete(where, True)
    if not found:
        raise RuleError(f"no snapshot {name} in {root}")


# ---------------------------------------------------------------- values of the training run

def _counted(rules: Rules) -> list[str]:
    return list(dict.fromkeys([*rules.caps.columns, *(r.source for r in rules.squares)]))


def add_counts(clean: DataFrame, root: str, name: str, rules: Rules = Rules(), *, by: Sequence[str] = ("city",), strict: bool = True) -> None:
    """Count one snapshot of cleaned listings: ``by, group, column, value, level, n``, from one pass with a sum on the map side.

    A missing value in a counted column is an error; with ``strict=False`` it is left out, as in the statistics of a training run. A table without
    rows is a snapshot that adds nothing.
    """
    by, numbers, label = list(by), _counted(rules), rules.category.column
    require_columns(clean, [*by, rules.caps.group_by, *numbers, label], "add_counts")
    spark = clean.sparkSession
    _new_name(spark, root, "counts", name)
    require_rows(clean, {f"column {c} has a missing value": F.col(c).isNull() for c in [*numbers, label]}, strict)
    # a district is counted without its room type
    group = F.col(rules.caps.group_by).cast("string")
    none = F.lit(None).cast("string")
    cells = [F.struct(group.alias("group"), F.lit(c).alias("column"), F.col(c).cast("double").alias("value"), none.alias("level")) for c in numbers]
    cells.append(F.struct(none.alias("group"), F.lit(label).alias("column"), F.lit(None).cast("double").alias("value"),
                          F.col(label).cast("string").alias("level")))
    rows = clean.select(*by, F.inline(F.array(*cells))).filter("value IS NOT NULL OR level IS NOT NULL")
    counts = rows.groupBy(*by, "group", "column", "value", "level").agg(F.count(F.lit(1)).alias("n"))
    _publish(spark, root, "counts", name, {"values": counts})


def fitted_from_counts(spark: SparkSession, root: str, rules: Rules = Rules(), *, by: Sequence[str] = ("city",), city: str | None = None,
                       names: Sequence[str] | None = None) -> Fitted:
    """Caps, kept districts and centres of the union of snapshots (all, or ``names``), as ``training_run`` learns them from its rows."""
    by, group, label = list(by), rules.caps.group_by, rules.category.column
    if bool(by) == (city is not None):
        raise RuleError("give the city of the table, or by=('city',) for a table of many cities")
    read = _read(spark, root, "counts", "values", names)
    # values with a sign of zero and without are one
    total = stage(read.groupBy(*by, "group", "column", (F.col("value") + F.lit(0.0)).alias("value"), "level").agg(F.sum("n").alias("n")), "counts")
    numbers = _counted(rules)
    wide = total.filter(F.col("level").isNull()).select(*by, F.col("group").alias(group), "n", *[
        F.when(F.col("column") == c, F.col("value")).alias(c) for c in numbers])
    caps = pin(group_caps(wide, rules.caps, by, strict=False, weight="n"), "caps")
    districts = total.filter(F.col("column") == label).select(*by, F.col("level").alias(label), "n").filter(F.col(label).isNotNull())
    kept = pin(frequent_categories(districts, rules.category, by, weight="n").select(*by, label), "kept")
    capped = lookup_join(wide, caps, [*by, group], null_safe=True)
    middles = []
    for rule in rules.squares:
        value = F.col(rule.source)
        if rule.source in rules.caps.columns:
            value = F.least(value, F.when(value.isNotNull(), F.col(f"cap_{rule.source}")))
        mean = F.sum(value * F.col("n")) / F.sum(F.when(value.isNotNull(), F.col("n")))
        middles.append((mean if rule.center else F.first(F.lit(0.0))).alias(f"center_{rule.source}"))
    return Fitted(tuple(by), caps, kept, pin(capped.groupBy(*by).agg(*middles), "centers"), city)


# ---------------------------------------------------------------- models

def add_moments(rows: DataFrame, root: str, name: str, specs: Sequence[ModelSpec], *, by: Sequence[str] = ("city",), strict: bool = True) -> None:
    """Sums and cross products of one snapshot of prepared training rows. All snapshots need the features of one ``Fitted``. No rows is an error."""
    spark = rows.sparkSession
    _new_name(spark, root, "moments", name)
    learned = moments(rows, specs, by, strict=strict)
    layout, width = learned.layout, learned.layout.width
    shifts = F.array(*[F.lit(s) for s in learned.shift])
    about = json.dumps([list(by), list(layout.categories), [list(x) for x in layout.numeric], [list(x) for x in layout.responses]])
    block = learned.block.select("*", shifts[F.col("i")].alias("shift_i"), shifts[F.col("j")].alias("shift_j"), F.lit(uuid.uuid4().hex).alias("source"))
    _publish(spark, root, "moments", name, {
        "cells": learned.cells.select(*by, *layout.categories, *[f"z{i}" for i in range(width)]), "block": block,
        "about": spark.createDataFrame([(about,)], "about string").coalesce(1)})


def merged_moments(spark: SparkSession, root: str, *, names: Sequence[str] | None = None) -> Moments:
    """The moments of the union of snapshots (all, or ``names``); ``fit_moments`` makes models of them without a look at the rows."""
    abouts = [r.about for r in _read(spark, root, "moments", "about", names).distinct().limit(2).collect()]
    if len(abouts) > 1:
        raise RuleError(f"snapshots in {root} were taken for different groups or predictors")
    by, categories, numeric, responses = json.loads(abouts[0])
    layout = Layout(tuple(categories), tuple(map(tuple, numeric)), tuple(map(tuple, responses)))
    z = [f"z{i}" for i in range(layout.width)]
    cells = stage(_read(spark, root, "moments", "cells", names).groupBy(*by, *categories).agg(*[F.sum(c).alias(c) for c in z]), "moment-cells")
    overall = cells.agg(*[F.sum(c).alias(c) for c in z]).first()
    shift = (0.0, *(overall[c] / overall["z0"] for c in z[1:]))
    block = _read(spark, root, "moments", "block", names)
    # row 0 of a block has the rows and the column sums about its own shift
    pair = F.struct("j", "value")
    sums = block.filter("i = 0").groupBy(*by, "source").agg(F.map_from_entries(F.collect_list(pair)).alias("sums"))
    keyed = sums.select(*[F.col(c).alias(f"__k_{c}") for c in [*by, "source"]], "sums")
    same = F.col("source") == F.col("__k_source")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"__k_{c}"))
    target = F.array(*[F.lit(s) for s in shift])
    a, b = F.col("shift_i") - target[F.col("i")], F.col("shift_j") - target[F.col("j")]
    moved = F.col("value") + b * F.col("sums")[F.col("i")] + a * F.col("sums")[F.col("j")] + a * b * F.col("sums")[F.lit(0)]
    together = block.join(keyed, same).groupBy(*by, "i", "j").agg(F.sum(moved).alias("value"))
    return Moments(layout, tuple(by), shift, cells, stage(together, "moment-block"))
