"""Scoring a stream of apartments; rows that cannot be scored go to a reject sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..errors import RuleError
from ..plans.analysis import Analysis
from ..plans.training import Fitted, inference_run
from ..plans.versions import Version, load_version, version_names
from ..operators.regression import Fit, price_range
from ..rules import Rules


def score_rows(apartments: DataFrame, fitted: Fitted, models: Analysis | Fit, rules: Rules = Rules()) -> DataFrame:
    """Prepared and priced rows with ``reject_reason`` (null for a scored row). Batch or stream, no state."""
    fits = models if isinstance(models, Fit) else models.fits
    spec = rules.model("price")
    prepared = inference_run(apartments, fitted, rules, strict=False)
    priced = price_range(prepared, fits, "price", level=rules.interval_level, strict=False)
    unknown_room = F.col("median").isNull()
    # what the predictors are made of: a gap in it is a gap in the price
    made = [(rules.distance.target, c) for c in (rules.distance.latitude, rules.distance.longitude)]
    made += [(r.target, c) for r in rules.ratios for c in (r.numerator, r.denominator)] + [(r.target, r.source) for r in rules.squares]
    wanted = dict.fromkeys([*spec.predictors, *[c for target, c in made if target in spec.predictors and isinstance(c, str)]])
    own = [c for c in wanted if c in apartments.columns]
    reason: Column = F.lit(None).cast("string")
    for c in reversed(own):
        reason = F.when(F.col(c).isNull(), F.lit(f"missing {c}")).otherwise(reason)
    reason = F.coalesce(reason, F.when(unknown_room, F.lit("unknown category or city")))
    return priced.withColumn("reject_reason", reason)


def _store(batch: DataFrame, batch_id: int, output: str) -> None:
    """Accepted and other rows of a micro-batch, each in the batch's own sub-folder."""
    batch.persist()
    for name, rows in (("scored", batch.filter("reject_reason IS NULL").drop("reject_reason")),
                       ("rejected", batch.filter("reject_reason IS NOT NULL"))):
        rows.write.mode("overwrite").parquet(f"{output}/{name}/batch={batch_id}")
    batch.unpersist()


def stream_score(source: DataFrame, fitted: Fitted, analysis: Analysis, *, output: str, checkpoint: str,
                 rules: Rules = Rules(), available_now: bool = True) -> StreamingQuery:
    """Start the scorer: accepted rows to ``<output>/scored``, others to ``<output>/rejected``.

    Each micro-batch writes its own sub-folder with overwrite, so a batch repeated after a failure replaces
    its earlier attempt and every apartment is stored once.
    """
    if not source.isStreaming:
        raise RuleError("stream_score: the source is not a stream")
    scored = score_rows(source, fitted, analysis, rules)
    writer = scored.writeStream.foreachBatch(lambda batch, batch_id: _store(batch, batch_id, output)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_refreshed(source: DataFrame, versions: str, *, output: str, checkpoint: str, rules: Rules = Rules(),
                     available_now: bool = True) -> StreamingQuery:
    """``stream_score`` with the latest fit in the folder ``versions`` at the start of each micro-batch.

    All rows of a batch are scored by one version, kept with them as ``fit_version``. A batch repeated after a failure may take a newer version than
    its lost attempt; it replaces all that the attempt wrote. The tables of a version are read once, when it first appears.
    """
    if not source.isStreaming:
        raise RuleError("stream_refreshed: the source is not a stream")
    spark = source.sparkSession
    held: list[Version] = [load_version(spark, versions, rules)]

    def score(batch: DataFrame, batch_id: int) -> None:
        if held[0].name != version_names(spark, versions)[-1]:
            held[0] = load_version(spark, versions, rules)
        rows = score_rows(batch, held[0].fitted, held[0].fits, rules)
        _store(rows.withColumn("fit_version", F.lit(held[0].name)), batch_id, output)

    writer = source.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
