"""Split, fit every model, score every model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.regression import Fit, fit_models, group_importance, model_scores
from ..operators.split import split_exact
from ..rules import Rules
from ..sources.staging import stage


@dataclass(frozen=True)
class Analysis:
    by: tuple[str, ...]
    fits: Fit
    scores: DataFrame
    train: DataFrame
    test: DataFrame

    def importance(self, rules: Rules = Rules(), model: str = "price") -> DataFrame:
        return group_importance(self.train, self.test, rules.model(model), rules.importance_groups, by=self.by,
                                reference_levels=rules.reference_levels)


def analysis_run(df: DataFrame, rules: Rules = Rules(), *, by: Sequence[str] = ("city",), key: Sequence[str] = ("id",),
                 strict: bool = True, drop: Sequence[str] = ("amenities", "bathrooms_text")) -> Analysis:
    """Fit on the training side and score on the test side, every city on its own.

    The split rows are staged without the long texts: fitting and scoring read them several times. Rows that
    carry their side already, as ``is_test``, keep it.
    """
    df = df.drop(*drop)
    marked = df if "is_test" in df.columns else split_exact(df, rules.test_size, seed=rules.split_seed, key=key, by=by)
    rows = stage(marked, "split")
    train, test = (rows.filter(F.col("is_test") == flag).drop("is_test") for flag in (False, True))
    fits = fit_models(train, rules.models, by=by, reference_levels=rules.reference_levels, strict=strict)
    return Analysis(tuple(by), fits, model_scores(test, fits, strict=strict), train, test)
