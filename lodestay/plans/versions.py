"""Fitted state in versions, so that whatever scores can take a new fit while it runs.

A version is a folder of plain tables and an empty file that names it. The file is made last, in one step, so a reader never sees half a version, and a fit
that fails or is written twice leaves at most a folder nobody reads. Names order by number; two writers at once get two versions, in the order of their names.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..errors import RuleError
from ..operators.lookup import pin
from ..operators.regression import Fit
from ..rules import Rules
from ..sources.listings import file_system_of
from .training import Fitted

_NAME = re.compile(r"\d{12}-[0-9a-f]{32}")
_TABLES = ("caps", "kept", "centers", "table", "levels")


@dataclass(frozen=True)
class Version:
    """What one version holds: the values of the training run and the models."""

    name: str
    fitted: Fitted
    fits: Fit


def version_names(spark: SparkSession, root: str) -> list[str]:
    """Names of all complete versions, oldest first; a folder that does not exist has none."""
    file_system, where = file_system_of(spark, f"{root}/versions")
    if not file_system.exists(where):
        return []
    return sorted(n for n in (f.getPath().getName() for f in file_system.listStatus(where)) if _NAME.fullmatch(n))


def publish_version(fitted: Fitted, fits: Fit, root: str) -> str:
    """Write a new version under ``root`` and return its name; readers take it from now on."""
    if tuple(fitted.by) != tuple(fits.by):
        raise RuleError(f"values by {fitted.by} and models by {fits.by} do not belong together")
    frames: dict[str, DataFrame] = {n: getattr(fitted if n in _TABLES[:3] else fits, n).frame for n in _TABLES}
    spark = fits.table.frame.sparkSession
    mark = uuid.uuid4().hex
    for name, frame in frames.items():
        frame.write.parquet(f"{root}/state-{mark}/{name}")
    about = {"by": list(fits.by), "city": fitted.city, "categories": list(fits.categories), "eliminated": dict(fits.eliminated),
             "models": {s.name: list(s.predictors) for s in fits.specs}}
    spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.parquet(f"{root}/state-{mark}/about")
    names = version_names(spark, root)
    name = f"{int(names[-1][:12]) + 1 if names else 1:012d}-{mark}"
    file_system, where = file_system_of(spark, f"{root}/versions/{name}")
    file_system.create(where, False).close()
    return name


def load_version(spark: SparkSession, root: str, rules: Rules = Rules(), name: str | None = None) -> Version:
    """A version by name, else the latest. Its tables are pinned: small ones are held, so the files may go while they are in use."""
    names = version_names(spark, root)
    if not names or name is not None and name not in names:
        raise RuleError(f"no version {name} in {root}" if names else f"no version in {root}")
    name = name or names[-1]
    folder = f"{root}/state-{name[13:]}"
    about = json.loads(spark.read.parquet(f"{folder}/about").first().about)
    specs = tuple(rules.model(m) for m in about["models"])
    changed = [s.name for s in specs if list(s.predictors) != about["models"][s.name]]
    if changed:
        raise RuleError(f"version {name} was fitted with other predictors: {', '.join(changed)}")
    held = {n: pin(spark.read.parquet(f"{folder}/{n}"), n) for n in _TABLES}
    by = tuple(about["by"])
    return Version(name, Fitted(by, held["caps"], held["kept"], held["centers"], about["city"]),
                   Fit(by, specs, tuple(about["categories"]), held["table"], held["levels"], about["eliminated"]))


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove all but the latest ``keep`` versions, names before tables, and return what went."""
    if keep < 1:
        raise RuleError("keep one version at least")
    gone = version_names(spark, root)[:-keep]
    for name in gone:
        for path in (f"{root}/versions/{name}", f"{root}/state-{name[13:]}"):
            file_system, where = file_system_of(spark, path)
            file_system.delete(where, True)
    return gone
