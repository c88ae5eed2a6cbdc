"""Spelling variant grouping by blocked Gram matrices of letter counts.

An inserted or deleted letter moves a word's letter counts by a squared distance of 1, a replaced one by 2. NumPy products of the count vectors of two
blocks of words give all their squared distances; only pairs of equal length at 2 and of adjacent lengths at 1 are kept and their letters compared.

Which words share a block: the letters are dealt to three classes. One edit touches two letters at most, so words one edit apart have equal counts in one
class at least. Words are dealt to blocks by each class' counts and sorted by length inside, and a product is only made of tiles that share counts
and stand at adjacent lengths. Counts shared by more words than a block holds are dealt to parts, and each pair of parts is a block, so no task gets
a whole crowd. A block sends on one row for each word, its links counted and the best of them, not the links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import arrow_map, crc_ctes, ranges

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: One in so many runs loses a letter; a form is so many times as frequent as its variant.
DROPPED, TIMES = 31, 10
#: Words of a block, and rows of a tile whose product is one matrix.
BLOCK_WORDS, TILE = 16_384, 512
CLASSES = 3
#: Columns of the count vectors, by code point: a-z, then U+00C0 to U+00FF.
_COLUMN = np.zeros(256, dtype=np.int64)
_COLUMN[97:123], _COLUMN[192:256] = np.arange(26), np.arange(26, 90)
_COLUMNS = 90
#: Letters of squared counts a float32 holds exactly.
_EXACT_LENGTH = 4000


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(31))


_WEIGHTS = np.zeros((_COLUMNS, CLASSES), dtype=np.uint64)
_WEIGHTS[np.arange(_COLUMNS), np.arange(_COLUMNS) % CLASSES] = _mixed((np.arange(_COLUMNS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """Words as bytes (all letters are below U+0100), their lengths, count vectors and the key of each class' counts."""

    def __init__(self, words: list[str]):
        coded = [w.encode("latin-1") for w in words]
        self.length = np.array([len(c) for c in coded], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.letters = np.frombuffer(b"".join(coded), dtype=np.uint8)
        cells = np.repeat(np.arange(len(coded)) * _COLUMNS, self.length) + _COLUMN[self.letters]
        counts = np.bincount(cells, minlength=len(coded) * _COLUMNS).reshape(-1, _COLUMNS)
        self.keys = _mixed((counts.astype(np.uint64)[:, :, None] * _WEIGHTS).sum(axis=1, dtype=np.uint64)).view(np.int64)
        self.counts = counts.astype(np.float32 if self.length.max(initial=0) <= _EXACT_LENGTH else np.float64)
        self.squares = (self.counts * self.counts).sum(axis=1)

    def padded(self, rows: np.ndarray, width: int) -> np.ndarray:
        out, size = np.zeros((len(rows), width), dtype=np.uint8), self.length[rows]
        out[np.repeat(np.arange(len(rows)), size), ranges(np.zeros(len(rows), dtype=np.int64), size)] = self.letters[ranges(self.start[rows], size)]
        return out


def one_edit(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words ``a`` and ``b``, whose lengths differ by one at most, are one inserted, deleted or replaced letter apart."""
    short, long = np.where(words.length[a] <= words.length[b], a, b), np.where(words.length[a] <= words.length[b], b, a)
    good = np.zeros(len(a), dtype=bool)
    step, at = max(1, (4 << 20) // max(1, int(words.length[long].max(initial=1)))), 0
    while at < len(a):
        part = slice(at, at + step)
        width = int(words.length[long[part]].max()) + 1
        s, t, size = words.padded(short[part], width), words.padded(long[part], width), words.length[short[part]][:, None]
        inside = np.arange(width - 1) < size
        unlike = (s[:, :-1] != t[:, :-1]) & inside
        first = np.where(unlike.any(axis=1), unlike.argmax(axis=1), size[:, 0])[:, None]
        rest = inside & (np.arange(width - 1) >= first)
        moved = ~((s[:, :-1] != t[:, 1:]) & rest).any(axis=1)
        good[part] = np.where(words.length[long[part]] == size[:, 0], unlike.sum(axis=1) == 1, moved)
        at += step
    return good


def _tiles(left: np.ndarray, right: np.ndarray, run: np.ndarray, length: np.ndarray, same: bool, size: int):
    """Pairs of tiles of two row lists, each ordered by run and length, that share a run at adjacent lengths."""
    for i in range(0, len(left), size):
        a = left[i:i + size]
        for j in range(i if same else 0, len(right), size):
            b = right[j:j + size]
            if (run[b[0]], length[b[0]]) > (run[a[-1]], length[a[-1]] + 1):
                break
            if (run[b[-1]], length[b[-1]]) >= (run[a[0]], length[a[0]] - 1):
                yield a, b, same and i == j


def links(words: Words, klass: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Rows of words one edit apart, one of ``left`` and one of ``right``, which agree in their class and in no class before it."""
    key = words.keys[np.arange(len(klass)), klass]
    run = np.unique(np.rec.fromarrays([klass, key]), return_inverse=True)[1]
    left, right = (rows[np.lexsort((words.length[rows], run[rows]))] for rows in (left, right))
    found = [(left[:0], left[:0])]
    for a, b, own in _tiles(left, right, run, words.length, same, tile):
        distance = words.squares[a][:, None] + words.squares[b] - 2 * (words.counts[a] @ words.counts[b].T)
        x, y = np.nonzero(distance <= 2)
        if own:
            x, y = x[x < y], y[x < y]
        gap, x, y = distance[x, y], a[x], b[y]
        kept = (run[x] == run[y]) & (np.abs(words.length[x] - words.length[y]) == 2 - gap)
        x, y = x[kept], y[kept]
        for g in range(CLASSES - 1):
            kept = (klass[x] <= g) | (words.keys[x, g] != words.keys[y, g])
            x, y = x[kept], y[kept]
        kept = one_edit(words, x, y)
        found.append((x[kept], y[kept]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _block(block: pa.Table) -> pa.Table:
    """``word, n_near, form, form_n`` of the words of a block that have links in it: the number of links and the best linked word."""
    names, counts, klass, part = block.column("word").to_pylist(), block.column("n").to_numpy(), block.column("g").to_numpy(), block.column("part").to_numpy()
    i, j = block.column("i")[0].as_py(), block.column("j")[0].as_py()
    words, rows = Words(names), np.arange(len(names))
    x, y = links(words, klass, rows if i == j else rows[part == i], rows if i == j else rows[part == j], i == j)
    rank = np.empty(len(names), dtype=np.int64)
    rank[sorted(rows.tolist(), key=names.__getitem__)] = rows
    owner, other = np.concatenate([x, y]), np.concatenate([y, x])
    order = np.lexsort((rank[other], -counts[other], owner))
    owner, other = owner[order], other[order]
    owners, first, times = np.unique(owner, return_index=True, return_counts=True)
    return pa.table({"word": pa.array([names[k] for k in owners.tolist()], pa.string()), "n_near": pa.array(times.astype(np.int64)),
                     "form": pa.array([names[k] for k in other[first].tolist()], pa.string()), "form_n": pa.array(counts[other[first]])})


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: the words of all texts after the seeded deletions; null texts have none, a null id counts as empty text."""
    # shorter runs cannot become words
    run = F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{LEAST_LENGTH},}})"), F.lit(1)))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(name.alias("id"), run.alias("run")).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % DROPPED == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= LEAST_LENGTH).groupBy(
        "word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, n_near, form, form_n`` for the words (``word, n``, distinct) with near words: their number and the most frequent one."""

    def keyed(batch):
        names = batch.column(0).to_pylist()
        keys = Words(names).keys
        for g in range(CLASSES):
            yield pa.record_batch([pa.array(np.full(len(names), g, dtype=np.int32)), pa.array(np.ascontiguousarray(keys[:, g])), batch.column(0), batch.column(1)],
                                  names=["g", "key", "word", "n"])

    rows = arrow_map(words.select("word", "n"), keyed, "g int, key long, word string, n long")
    sizes = stage(rows.groupBy("g", "key").count(), "class-sizes")
    crowded = sizes.where(F.col("count") > block_words).select("g", "key", F.ceil(F.col("count") / block_words).cast("int").alias("parts"))
    buckets = max(1, -(-(sizes.agg(F.sum("count")).first()[0] or 0) // block_words))
    dealt = rows.join(crowded, ["g", "key"], "left").withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("word"), "parts")).otherwise(0).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts") - 1, F.lit(0))))
    paired = dealt.withColumn("other", others).select(
        F.when(F.col("parts") > 1, F.col("g")).otherwise(-1).alias("crowd"), F.when(F.col("parts") > 1, F.col("key")).otherwise(F.pmod(F.xxhash64("g", "key"), F.lit(buckets))).alias("bucket"),
        F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "g", "word", "n", "part")
    found = paired.groupBy("crowd", "bucket", "i", "j").applyInArrow(_block, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus")).alias("form_n"))


def group_spellings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n``, one row for each word.

    Words are counted over all texts (:func:`count_words`). A word's form is its most frequent near word, ties by code points, if that is ``TIMES`` as
    frequent at least; its root is the last of the forms that follow from it. Every form is ten times as frequent as what it is a form of, so a
    chain has fewer than twenty links and each round doubles the part that is followed. Null and empty texts add nothing; equal texts count as often as they
    stand; no words, no rows. Other columns are not read.
    """
    words = stage(count_words(docs, id_col, text_col), "words")
    near = words.join(near_words(words, block_words), "word", "left")
    is_form = F.col("form_n") >= F.col("n") * TIMES
    forms = stage(near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("form")).alias("form"),
                              F.when(is_form, F.col("form_n")).alias("form_n")), "forms")
    hops, moved = forms.where("form is not null").select("word", F.col("form").alias("root")), True
    while moved:
        onward = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hops = stage(hops.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = not hops.where("moved").isEmpty()
        hops = hops.drop("moved")
    return forms.join(hops, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE_SQL = f"""
WITH RECURSIVE runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
counted AS (SELECT id || ':' || run AS s, run, count(*) AS n FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
{crc_ctes("SELECT s FROM counted")},
cut AS (SELECT CASE WHEN crc % {DROPPED} = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n FROM counted JOIN crcs USING (s)),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(cut.n) >= {LEAST_COUNT}),
shorter AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) AS t(i)),
pairs AS (SELECT a.word, b.word AS near FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word FROM shorter a JOIN words b ON a.rest = b.word UNION SELECT b.word, a.word FROM shorter a JOIN words b ON a.rest = b.word),
ranked AS (SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS place
    FROM pairs p JOIN words w ON w.word = p.near),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {TIMES} * n THEN near END AS form, CASE WHEN near_n >= {TIMES} * n THEN near_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1),
chain AS (SELECT word, coalesce(form, word) AS root, form IS NULL AS ended FROM forms
    UNION ALL SELECT c.word, coalesce(f.form, f.word), f.form IS NULL FROM chain c JOIN forms f ON f.word = c.root WHERE NOT ended)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN chain USING (word) WHERE ended
"""
