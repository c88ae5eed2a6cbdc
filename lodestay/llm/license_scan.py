"""License scans: fixed phrases, and an exact set-similarity join of text blocks with license statements.

A block is ``2 * step`` consecutive words that start at a multiple of ``step``, one less than the words of the longest statement, so every passage as long
as a statement lies whole in a block. A block meets a statement if it holds the given share of the statement's distinct words. The words of the
statements are put in one global order, rarest in the documents first, and blocks and statements are joined on them:

- length filter: a block with fewer statement words than the needed overlap meets nothing;
- prefix filter: a block and a statement that meet share a word among the first ``size - overlap + 1`` of each, so only those are joined;
- positional filter: a shared word at positions i and j leaves room for ``1 + min(rest of either)`` shared words, which must reach the overlap.

Pairs that pass are compared whole. Words in no statement count nowhere, so blocks are reduced to statement words while the text is read; this one pass
over the texts is the only one. All of it is built-in functions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
STATEMENTS = (
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
#: Percent of a statement's distinct words a block must hold.
PERCENT = 90
#: The statements' words are broadcast and stand in the plan; more than this is refused.
MOST_WORDS = 20_000


def text_words(text: str) -> list[str]:
    """The words of a phrase or statement, by the rule of the scanned texts."""
    return [w for w in re.split(SEPARATORS, text.translate(str.maketrans(UPPER, LOWER))) if w]


def needed(size: int, percent: int = PERCENT) -> int:
    """The fewest shared words that reach ``percent`` of ``size``."""
    return -(-size * percent // 100)


def _starts(phrase: list[str]) -> Column:
    """The places where the words of ``phrase`` stand in a row."""
    here = lambda i: F.forall(F.sequence(F.lit(0), F.lit(len(phrase) - 1)), lambda k: F.coalesce(
        F.get("words", (i + k).cast("int")) == F.get(F.array(*map(F.lit, phrase)), k), F.lit(False)))
    found = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: (F.get("words", i) == phrase[0]) & here(i))
    return F.when(F.array_contains("words", max(phrase, key=len)), found).otherwise(F.array().cast("array<int>"))


def _index(statements: Sequence[tuple[str, str]], order: list[str], percent: int) -> list[tuple]:
    """``word, at, size, overlap, members, label`` for each word of a statement's prefix."""
    place, out = {w: i for i, w in enumerate(order)}, []
    for label, statement in statements:
        members = sorted(set(text_words(statement)), key=place.__getitem__)
        overlap = needed(len(members), percent)
        out += [(w, i, len(members), overlap, members, label) for i, w in enumerate(members[:len(members) - overlap + 1])]
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Sequence[tuple[str, str]] = PHRASES,
                  statements: Sequence[tuple[str, str]] = STATEMENTS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row.

    ``n_base`` counts all places of all phrases; ``first_word`` and ``last_word`` are the smallest and largest place, null without one. ``labels`` are
    the phrases' and the met statements', distinct, sorted and joined by commas, ``score`` the largest share of a statement met, 1 with a phrase, 0 with
    neither. Null and empty texts have no words and no labels. Rows with equal or null ids stay rows of their own; other columns are not read.
    """
    parts = [(label, text_words(t)) for label, t in phrases]
    vocabulary = sorted({w for _, t in statements for w in text_words(t)})
    if not all(p for _, p in parts) or not all(text_words(t) for _, t in statements):
        raise ValueError("a phrase or statement has no words")
    if not 0 < percent <= 100 or len(vocabulary) > MOST_WORDS:
        raise ValueError(f"percent must be 1 to 100 and the statements' words {MOST_WORDS} at most")
    step = max([2] + [len(text_words(t)) for _, t in statements]) - 1
    least = min([needed(len(set(text_words(t))), percent) for _, t in statements], default=1)
    known = F.array(*map(F.lit, vocabulary)) if vocabulary else F.array().cast("array<string>")

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(F.col(id_col).alias("id"), F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), "").alias("words"))
    blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("words") / step).cast("int") - 2))
    sets = F.transform(blocks, lambda b: F.array_intersect(known, F.slice("words", b * step + 1, 2 * step)))
    places = [_starts(p) for _, p in parts]
    scanned = stage(split.select("id", "words", *[p.alias(f"p{i}") for i, p in enumerate(places)]).select(
        F.monotonically_increasing_id().alias("rid"), "id", F.size("words").cast("long").alias("n_words"),
        F.concat(F.array().cast("array<int>"), *[f"p{i}" for i in range(len(parts))]).alias("places"),
        F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, label) for i, (label, _) in enumerate(parts)]).cast("array<string>")).alias("base"),
        F.array_intersect(known, "words").alias("known"),
        F.array_distinct(F.filter(sets, lambda s: F.size(s) >= least)).alias("sets")), "license-blocks")

    # as many rows as the statements have words
    counts = dict(scanned.select(F.explode("known").alias("w")).groupBy("w").count().collect())
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    index = scanned.sparkSession.createDataFrame(_index(statements, order, percent), "word string, i int, size int, overlap int, members array<string>, label string")
    ordered = F.array_intersect(F.array(*map(F.lit, order)), "s") if order else F.col("s")
    held = scanned.select("rid", F.explode("sets").alias("s")).select("rid", ordered.alias("s")).distinct().select("rid", "s", F.posexplode("s").alias("j", "word"))
    rest = F.least(F.col("size") - F.col("i"), F.size("s") - F.col("j"))
    pairs = held.join(F.broadcast(index), "word").where((F.size("s") >= F.col("overlap")) & (F.col("j") <= F.size("s") - F.col("overlap")) & (rest >= F.col("overlap")))
    shared = F.size(F.array_intersect("members", "s"))
    met = pairs.where(shared >= F.col("overlap")).select("rid", "label", (shared / F.col("size")).alias("share"))
    best = met.groupBy("rid").agg(F.collect_set("label").alias("own"), F.max("share").alias("share"))

    none = F.array().cast("array<string>")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return scanned.drop("known", "sets").join(best, "rid", "left").select(
        F.col("id").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"), joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", F.coalesce("own", none))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))


def _oracle() -> str:
    rows = ", ".join(f"({k}, '{label}', '{w}', {len(set(text_words(t)))}, {needed(len(set(text_words(t))))})"
                     for k, (label, t) in enumerate(STATEMENTS) for w in sorted(set(text_words(t))))
    step = max(len(text_words(t)) for _, t in STATEMENTS) - 1
    phrases = "\nUNION ALL\n".join(
        f"SELECT rid, pos, '{label}' AS label FROM placed WHERE " + " AND ".join(f"w{i} = '{w}'" for i, w in enumerate(text_words(t))) for label, t in PHRASES)
    return rf"""
WITH split AS (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
places AS (SELECT rid, unnest(words) AS w0, unnest(range(len(words))) AS pos FROM split),
placed AS (SELECT rid, pos, w0, lead(w0, 1) OVER o AS w1, lead(w0, 2) OVER o AS w2 FROM places WINDOW o AS (PARTITION BY rid ORDER BY pos)),
phrases AS ({phrases}),
base AS (SELECT rid, count(*) AS n, min(pos) AS first_word, max(pos) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM phrases GROUP BY rid),
statements(k, label, word, size, overlap) AS (VALUES {rows}),
blocks AS (SELECT rid, pos // {step} AS block, w0 FROM places UNION SELECT rid, pos // {step} - 1, w0 FROM places WHERE pos >= {step}),
met AS (SELECT rid, label, count(*) / size AS share FROM blocks JOIN statements ON w0 = word GROUP BY rid, block, k, label, size, overlap HAVING count(*) >= overlap),
best AS (SELECT rid, list(DISTINCT label) AS labels, max(share) AS share FROM met GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
    coalesce(array_to_string(base.labels, ','), '') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(best.labels, [])))), ',') AS labels,
    CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM split LEFT JOIN base USING (rid) LEFT JOIN best USING (rid)
"""


ORACLE_SQL = _oracle()
