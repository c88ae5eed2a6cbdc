"""The registered queries of the operators, thin wrappers that derive the columns each query promises."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from . import (decontaminate, language_id, language_model, license_scan, mixing, prefix_trie, quality, repeats, sequences, simhash, spelling,
               token_counts, vector_index)
from .common import crc_bucket, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepared(spark: SparkSession, batch_bytes: str | None = None) -> SparkSession:
    """Session settings of the package, and Arrow batches that stay small with long texts; their bytes are those of the application if none are given."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    most = "spark.sql.execution.arrow.maxBytesPerBatch"
    batch_bytes = batch_bytes or spark.sparkContext.getConf().get(most)
    if batch_bytes:
        spark.conf.set(most, batch_bytes)
    else:
        spark.conf.unset(most)
    return tune(spark)


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = lambda spark, sf_dir: function(prepared(spark), sf_dir)
        if sql:
            ORACLES[name] = sql
        return function

    return register


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), crc_bucket("doc_id", 4) == 2)


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op4_decontaminate")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_sequences")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sequences.read_documents(sequences.write_sequences(docs, tokenizer("byte_bpe_50k.json")))


@query("op6_vector_index")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_index.link_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_bucket("doc_id", 5) == 0)


@query("op8_mixing", mixing.ORACLE_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_language_model")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return language_model.score(docs, crc_bucket("doc_id", 5) == 1)


@query("op10_repeats")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op11_licenses", license_scan.ORACLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query("op12_spelling", spelling.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


@query("op13_prefix_trie", prefix_trie.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
