"""From raw listings to model-ready rows, for many cities in one run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import RuleError, require_columns, require_rows
from ..operators.columns import convert_currency, rename_columns, select_columns, set_types
from ..operators.features import (cap_values, centered_squares, distance_to_center, frequent_categories, group_caps,
                                  group_rare, keyword_dummies, ratio)
from ..operators.lookup import Lookup, pin
from ..operators.missing import missing_rules
from ..operators.rows import dedupe_first, drop_outliers, drop_zero, filter_plausible
from ..operators.split import split_exact
from ..rules import Rules
from ..sources.staging import stage


@dataclass(frozen=True)
class Fitted:
    """Values learned on the listings, reused on every apartment: small tables keyed by city."""

    by: tuple[str, ...]
    caps: Lookup
    kept: Lookup
    centers: Lookup
    city: str | None = None

    def save(self, path: str) -> None:
        for name in ("caps", "kept", "centers"):
            getattr(self, name).frame.write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark, path: str, by: Sequence[str] = ("city",), city: str | None = None) -> "Fitted":
        parts = {n: pin(spark.read.parquet(f"{path}/{n}"), n) for n in ("caps", "kept", "centers")}
        return cls(tuple(by), parts["caps"], parts["kept"], parts["centers"], city)


def clean_listings(raw: DataFrame, rules: Rules = Rules(), *, by: Sequence[str] = ("city",), city: str | None = None,
                   order_by: Sequence[str] | None = None, keep: Sequence[str] = (), strict: bool = True,
                   defer_checks: bool = False) -> DataFrame:
    """Select, rename, type, convert, de-duplicate, fill or drop missing values, drop outliers and implausible rows.

    The only full shuffle is the de-duplication; its result is staged, so that the statistics passes that
    follow (medians, fences) read a few columns each. ``order_by`` decides which copy is the first.
    ``defer_checks`` keeps rows with missing sizes for the caller to check.
    """
    by = list(by)
    if bool(by) == (city is not None):
        raise RuleError("give the city of the table, or by=('city',) for a table of many cities")
    df = select_columns(raw, [*dict.fromkeys([*by, *keep, *rules.relevant_columns])])
    df = rename_columns(df, rules.label_mapping)
    df = set_types(df, rules.column_types)
    if by:
        df = convert_currency(df, rules.currency, cities=rules.cities, city_column=by[0])
    else:
        if city not in rules.cities:
            raise RuleError(f"unknown city {city}")
        df = convert_currency(df, rules.currency, rules.cities[city].currency)
    order = list(order_by or [c for c in df.columns if c not in by])
    df = dedupe_first(df, [*by, *rules.deduplicate_columns], order)
    df = stage(drop_zero(df, rules.no_booking_columns), "listings")
    df = missing_rules(df, rules.missing, group_by=rules.room_type_column, label=rules.entire_home_label,
                       text_column=rules.bathrooms_text_column, by=by)
    df = drop_zero(df, rules.ratio_denominators)
    df = drop_outliers(df, rules.outliers, by, strict=strict)
    return filter_plausible(df, rules.plausibility, strict and not defer_checks, keep_unknown=strict and defer_checks)


def training_run(raw: DataFrame, rules: Rules = Rules(), *, by: Sequence[str] = ("city",), city: str | None = None,
                 order_by: Sequence[str] | None = None, keep: Sequence[str] = (), drop_text: bool = False,
                 strict: bool = True, fit_on: str = "all", key: Sequence[str] = ("id",)) -> tuple[DataFrame, Fitted]:
    """Cleaned listings with every feature, and the values an apartment needs later.

    After the staged de-duplication everything is narrow: statistics come back as small lookups. ``drop_text``
    leaves the long texts out of the result once the dummies are made, which keeps the second staged
    table small.

    ``fit_on="train"`` splits the cleaned listings first (``key`` names a row), learns caps, kept districts and centres from the training side alone and
    keeps the side as ``is_test``, which the analysis then uses. No later step drops rows, so it is the split the analysis would make.
    """
    if fit_on not in ("all", "train"):
        raise RuleError(f"fit_on must be all or train, got {fit_on}")
    by = list(by)
    df = clean_listings(raw, rules, by=by, city=city, order_by=order_by, keep=keep, strict=strict,
                        defer_checks=True)
    # dummies first, so that the texts need not be read again; their gaps are checked below with the rest
    gap = reduce(lambda a, b: a | b, [F.col(r.source).isNull() for r in rules.dummies], F.lit(False))
    df = keyword_dummies(df.withColumn("__gap", gap), rules.dummies, strict=False)
    if drop_text:
        targets = {r.target for r in rules.dummies}
        df = df.drop(rules.bathrooms_text_column, *[r.source for r in rules.dummies if r.source not in targets])
    df = stage(df, "clean")
    needed = dict.fromkeys([*(c for r in rules.plausibility for c in (r.column, r.max_of)),
                            *(r.source for r in rules.squares), *rules.outliers.columns, *rules.ratio_denominators,
                            rules.category.column, rules.distance.latitude, rules.distance.longitude])
    require_rows(df, {f"column {c} has a missing value": F.col(c).isNull() for c in needed}
                 | {f"a text of {', '.join(dict.fromkeys(r.source for r in rules.dummies))} is missing": F.col("__gap")},
                 strict)
    df = df.drop("__gap")
    if fit_on == "train":
        df = stage(split_exact(df, rules.test_size, seed=rules.split_seed, key=key, by=by), "clean-split")

    def side(rows: DataFrame) -> DataFrame:
        return rows.filter(~F.col("is_test")) if fit_on == "train" else rows

    caps = pin(group_caps(side(df), rules.caps, by, strict), "caps")
    kept = pin(frequent_categories(side(df), rules.category, by).select(*by, rules.category.column), "kept")
    df = cap_values(df, caps, rules.caps, by, strict=False)
    centers = pin(side(df).groupBy(*by).agg(*[
        (F.avg(r.source) if r.center else F.first(F.lit(0.0))).alias(f"center_{r.source}") for r in rules.squares]),
        "centers")
    for rule in rules.ratios:
        df = ratio(df, rule, strict=False)
    if by:
        df = distance_to_center(df, rules.distance, cities=rules.cities, city_column=by[0])
    else:
        here = rules.cities[city]
        df = distance_to_center(df, rules.distance, center=(here.latitude, here.longitude))
    df = group_rare(df, kept, rules.category, by)
    df = centered_squares(df, centers, rules.squares, by)
    return df, Fitted(tuple(by), caps, kept, centers, city)


def inference_run(apartments: DataFrame, fitted: Fitted, rules: Rules = Rules(), *, model: str = "price",
                  strict: bool = True) -> DataFrame:
    """The training features for apartments, with the learned values. Stateless, so it also runs on a stream.

    Cleaning steps are not applied. A ratio is made only if its columns are there. With ``strict=False``
    unknown groups leave nulls behind instead of failing.
    """
    by = list(fitted.by)
    here = (rules.distance.latitude, rules.distance.longitude)
    require_columns(apartments, here, "inference_run")
    require_rows(apartments, {f"column {c} has a missing value": F.col(c).isNull() for c in here}, strict)
    df = cap_values(apartments, fitted.caps, rules.caps, by, strict)
    for rule in rules.ratios:
        absent = {rule.numerator, *([rule.denominator] if isinstance(rule.denominator, str) else [])} - set(df.columns)
        if not absent:
            df = ratio(df, rule, strict)
    if by:
        df = distance_to_center(df, rules.distance, cities=rules.cities, city_column=by[0])
    else:
        here = rules.cities[fitted.city]
        df = distance_to_center(df, rules.distance, center=(here.latitude, here.longitude))
    df = group_rare(df, fitted.kept, rules.category, by)
    df = centered_squares(df, fitted.centers, rules.squares, by)
    absent = [p for p in rules.model(model).predictors if p not in df.columns]
    if absent:
        raise RuleError(f"input is missing: {', '.join(absent)}")
    require_columns(df, by, "inference_run")
    return df
