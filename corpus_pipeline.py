"""The corpus pipeline: five stages, each of which works on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.llm import decontaminate, language_id, mixing, sequences, simhash
from lodestay.llm.common import crc_bucket, table
from lodestay.llm.queries import prepared, tokenizer
from lodestay.sources.staging import stage

#: Documents whose best language gets less than this share of their bytes' probability are rejected.
LEAST_LANGUAGE = 0.4
#: Of an Arrow batch; its rows are whole documents, which tasks of all stages hold beside their own work.
BATCH_BYTES = "2m"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those no language fits."""
    rated = language_id.identify(docs, crc_bucket("doc_id", 4) == 2, rest=tuple(docs.columns))
    fitting = rated.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE))
    return fitting.select(*[F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def _numbered(docs: DataFrame) -> DataFrame:
    """``row, doc``: the rows, each with a number of its own; the id where it is one, else numbers fixed in a staged copy."""
    if docs.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        return docs.select(F.col("doc_id").cast("long").alias("row"), F.struct(*docs.columns).alias("doc"))
    return stage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "pipeline-rows")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, the one with the smallest id; null ids are last, and rows of one id stand in any fixed order."""
    rows = _numbered(docs)
    groups = simhash.near_groups(rows.select("row", "doc.text"), id_col="row").select(F.col("doc_id").alias("row"), "component_id")
    ids = rows.select("row", F.col("doc.doc_id").alias("id")).join(groups, "row")
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")).select("first.row")
    return rows.join(first, "row").select("doc.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go; rows are told apart by their own numbers, so null and repeated ids lose nothing else."""
    rows = _numbered(docs)
    leaks = decontaminate.find_leaks(rows.select("row", "doc.text"), table(spark, sf_dir, "benchmark"), id_col="row").select(F.col("doc_id").alias("row")).distinct()
    return rows.join(leaks, "row", "left_anti").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last taking of one may end inside it. Null and empty texts are never taken."""
    return mixing.repeated(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files; the documents read back from them. Null and empty texts are their end id alone, null ids come first."""
    return sequences.read_documents(sequences.write_sequences(docs, tokenizer("byte_bpe_50k.json")))


def _stage(function):
    return lambda spark, docs, sf_dir: function(prepared(spark, BATCH_BYTES), docs, sf_dir)


STAGES = [("language_id", _stage(identify_language)), ("simhash", _stage(drop_near_copies)), ("decontaminate", _stage(drop_leaks)),
          ("mixing", _stage(mix_sources)), ("sequences", _stage(write_ids))]
#: Trained models and tokenizers are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from all documents."""
    docs = table(prepared(spark, BATCH_BYTES), sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
