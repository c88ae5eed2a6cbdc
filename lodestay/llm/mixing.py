"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a target number of words. Blocks of equal length are seats: the Sainte-Laguë method (highest quotients of
target / 1, 3, 5, ...) turns targets into whole numbers of blocks, first for the sources, then for the shards of each
source by the words they hold. Inside a shard documents stand in a seeded order and the quota runs through it, as often as needed.
Shards hold a bounded number of documents, so a source with a third of all rows is many shards and a small one is a single shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import WORD

BLOCK_WORDS = 16
SHARD_ROWS = 50_000
MOST_REPEATS = 3
SEED = "mix"


def apportion(votes: DataFrame, group: str, key: list[str]) -> DataFrame:
    """Adds ``won``: the whole seats of each row by Sainte-Laguë, from ``votes`` (double) and its group's ``seats`` (long).

    Rounded shares miss the number of seats by half a seat a row at most; the missing ones go to the highest next quotients, the ones too many
    are taken from the lowest. A row can gain or lose no more than its share of the difference, one seat rounding included, so the quotients to rank
    number about as many as the rows. Ties go by ``key``; rows without votes get nothing.
    """
    every = W.partitionBy(group)
    share = F.col("votes") / F.sum("votes").over(every)
    base = votes.withColumn("part", F.when(F.sum("votes").over(every) > 0, share).otherwise(0.0)).withColumn(
        "base", F.floor(F.col("part") * F.col("seats") + 0.5))
    base = base.withColumn("rows", F.count("*").over(every)).withColumn(
        "miss", F.when(F.sum("votes").over(every) > 0, F.col("seats") - F.sum("base").over(every)).otherwise(0))
    most = F.least(F.abs("miss"), F.floor(F.col("part") * (F.abs("miss") + F.col("rows"))) + 1)
    steps = F.when((F.col("miss") == 0) | (F.col("votes") <= 0), 0).when(F.col("miss") > 0, most).otherwise(F.least(most, F.col("base")))
    nth = base.withColumn("steps", steps).where("steps > 0").withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("steps"))))
    seat = F.when(F.col("miss") > 0, F.col("base") + F.col("j")).otherwise(F.col("base") - F.col("j") + 1)
    quotient = F.col("votes") / (2 * seat - 1)
    ranked = nth.withColumn("rank", F.row_number().over(
        every.orderBy(F.when(F.col("miss") > 0, -quotient).otherwise(quotient), *key)))
    moved = ranked.where(F.col("rank") <= F.abs("miss")).groupBy(*key).agg(F.sum(F.signum("miss")).cast("long").alias("moved"))
    return base.join(moved, key, "left").withColumn("won", F.col("base") + F.coalesce("moved", F.lit(0))).drop(
        "part", "base", "rows", "miss", "moved")


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS, seed: str = SEED) -> DataFrame:
    """The rows with ``size, source_size, target, taken`` (words the mix takes of each); columns of these names are replaced.

    A null text has size 0 and is never taken; a null source is a source of its own, ordered last. Shard and order of a row follow from its id and text
    together, so rows with a null or one id are spread like others; repeated rows are separate documents. Other columns stay as they are, whatever
    their names. Empty tables give empty results.
    """
    docs = docs.drop("size", "source_size", "target", "taken")
    own = "_"
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    source, shard, order, before = (f"{own}{c}" for c in ("source", "shard", "order", "before"))
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text_col), F.lit(""))))
    keyed = docs.withColumn(source, F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("t")))
    # a source has shards for its own rows only: a small one is not cut into as many as a large one
    shards = stage(keyed.groupBy(source).agg(F.ceil(F.count("*") / shard_rows).alias(f"{own}shards")), "mix-shards")
    placed = keyed.join(shards, source).withColumn("size", _size(F.col(text_col))).withColumn(order, digest).withColumn(
        shard, F.pmod(F.conv(F.substring(order, 25, 8), 16, 10).cast("long"), F.col(f"{own}shards"))).drop(f"{own}shards")
    sums = stage(placed.groupBy(F.col(source).alias("_source"), F.col(shard).alias("_shard")).agg(F.sum("size").alias("shard_size")), "mix-sizes")
    quotas = stage(_quotas(sums, block_words), "mix-quotas").toDF(source, shard, "source_size", "target", f"{own}full", f"{own}rest")
    seen = F.coalesce(F.sum("size").over(W.partitionBy(source, shard).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = placed.withColumn(before, seen).join(quotas, [source, shard])
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col(f"{own}rest") - F.col(before)))
    return rows.withColumn("taken", (F.col(f"{own}full") * F.col("size") + extra).cast("long")).select(
        *docs.columns, "size", "source_size", "target", "taken")


def _quotas(sums: DataFrame, block_words: int) -> DataFrame:
    """Per source and shard: the source's size and target, full passes through the shard, and the words of the pass after them."""
    sources = sums.groupBy("_source").agg(F.sum("shard_size").alias("source_size")).withColumn("_all", F.lit(0))
    rank = F.row_number().over(W.partitionBy("_all").orderBy("_source"))
    sources = sources.withColumn("weight", ((rank - 1) % 3 + 1).cast("double")).withColumn("cap", (MOST_REPEATS * F.col("source_size")).cast("double"))
    by_ratio = W.partitionBy("_all").orderBy(F.col("cap") / F.col("weight"), "_source")
    below = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    weights = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(W.partitionBy("_all"))
    # the level that capped sources leave to the others rises up to the first that is not capped, then falls
    levels = sources.withColumn("total", total).withColumn("level", (total - below) / weights)
    targets = levels.withColumn("target", F.least(F.col("cap"), F.max("level").over(W.partitionBy("_all")) * F.col("weight")))
    seats = targets.select("_all", "_source", "source_size", "target", F.col("target").alias("votes"),
                           F.floor(F.col("total") / block_words + 0.5).alias("seats"))
    won = apportion(seats, "_all", ["_source"]).select("_source", "source_size", "target", F.col("won").alias("seats"))
    shards = sums.join(won, "_source").withColumn("votes", F.col("shard_size").cast("double"))
    quota = apportion(shards, "_source", ["_source", "_shard"])
    words = F.least(F.col("won") * block_words, MOST_REPEATS * F.col("shard_size"))
    full = F.when(F.col("shard_size") > 0, F.floor(words / F.col("shard_size"))).otherwise(0)
    return quota.select("_source", "_shard", "source_size", "target", full.alias("_full"), (words - full * F.col("shard_size")).alias("_rest"))


def repeated(docs: DataFrame, text_col: str = "text", count_col: str = "n_chars", **options) -> DataFrame:
    """The mixed corpus: each row as often as ``mix`` takes it whole, and once more cut after the last word taken of it.

    Rows without words, null texts among them, are never taken; an empty table stays empty. ``count_col``, if it is there, counts a cut text anew.
    """
    own = "_"
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    whole, part, nth = (f"{own}{c}" for c in ("whole", "part", "nth"))
    mixed = mix(docs, text_col=text_col, **options).where("taken > 0")
    times = mixed.withColumn(whole, F.floor(F.col("taken") / F.col("size"))).withColumn(part, F.col("taken") - F.col(whole) * F.col("size"))
    copies = times.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(whole) + F.when(F.col(part) > 0, 1).otherwise(0))))
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(pieces, F.lit(1), F.col(part).cast("int")), "")
    last = F.col(nth) > F.col(whole)
    out = copies.withColumn(text_col, F.when(last, head).otherwise(F.col(text_col)))
    if count_col in docs.columns:
        out = out.withColumn(count_col, F.when(last, F.length(text_col)).otherwise(F.col(count_col)).cast(docs.schema[count_col].dataType))
    return out.select(*docs.columns)


def _apportion_sql(votes: str, group: str, key: str, name: str) -> str:
    return f"""
{name}_base AS (SELECT *, CASE WHEN sum(votes) OVER g > 0 THEN votes / sum(votes) OVER g ELSE 0.0::DOUBLE END AS part,
    floor((CASE WHEN sum(votes) OVER g > 0 THEN votes / sum(votes) OVER g ELSE 0.0::DOUBLE END) * seats + 0.5)::BIGINT AS base
    FROM {votes} WINDOW g AS (PARTITION BY {group})),
{name}_miss AS (SELECT *, count(*) OVER g AS n_rows, CASE WHEN sum(votes) OVER g > 0 THEN seats - sum(base) OVER g ELSE 0 END AS miss
    FROM {name}_base WINDOW g AS (PARTITION BY {group})),
{name}_nth AS (SELECT *, unnest(generate_series(1, CASE WHEN votes <= 0 THEN 0 WHEN miss >= 0 THEN abs(miss) ELSE least(abs(miss), base) END::BIGINT)) AS j FROM {name}_miss),
{name}_rank AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY
    CASE WHEN miss > 0 THEN -votes / (2 * (base + j) - 1) ELSE votes / (2 * (base - j + 1) - 1) END, {key}) AS rnk FROM {name}_nth),
{name}_moved AS (SELECT {key}, sum(sign(miss)) AS moved FROM {name}_rank WHERE rnk <= abs(miss) GROUP BY {key}),
{name} AS (SELECT m.*, m.base + coalesce(v.moved, 0) AS won FROM {name}_miss m LEFT JOIN {name}_moved v USING ({key}))"""


ORACLE_SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    coalesce('s' || source, 't') AS src, md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS ord FROM documents),
placed AS (SELECT *, ('0x' || substr(ord, 25, 8))::BIGINT % ((count(*) OVER (PARTITION BY src) + {SHARD_ROWS - 1}) // {SHARD_ROWS}) AS shard FROM docs),
sums AS (SELECT src, shard, sum(size)::BIGINT AS shard_size FROM placed GROUP BY ALL),
sources AS (SELECT src, sum(shard_size)::BIGINT AS source_size FROM sums GROUP BY ALL),
weighted AS (SELECT *, ((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::DOUBLE AS weight, ({MOST_REPEATS} * source_size)::DOUBLE AS cap FROM sources),
levels AS (SELECT *, sum(source_size) OVER () AS total,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
targets AS (SELECT 0 AS every, src, source_size, least(cap, max(level) OVER () * weight) AS target, floor(total / {BLOCK_WORDS}::DOUBLE + 0.5)::BIGINT AS seats FROM levels),
votes AS (SELECT *, target AS votes FROM targets),
{_apportion_sql("votes", "every", "src", "won")},
shards AS (SELECT sums.src, shard, shard_size, source_size, target, won AS seats, shard_size::DOUBLE AS votes FROM sums JOIN won USING (src)),
{_apportion_sql("shards", "src", "src, shard", "quota")},
passes AS (SELECT *, least(won * {BLOCK_WORDS}, {MOST_REPEATS} * shard_size) AS quota_words FROM quota),
runs AS (SELECT *, CASE WHEN shard_size > 0 THEN quota_words // shard_size ELSE 0 END AS full_passes FROM passes)
SELECT doc_id, size, source_size, target, (full_passes * size + greatest(0, least(size, quota_words - full_passes * shard_size
    - coalesce(sum(size) OVER (PARTITION BY src, shard ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS taken
FROM placed JOIN runs USING (src, shard)
"""
