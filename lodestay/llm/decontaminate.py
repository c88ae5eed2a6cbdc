"""Benchmark decontamination: rare n-gram seeds join texts to test items, Smith-Waterman alignment scores the places they meet.

The words and n-grams of the items are counted in all texts. An item's most common ones are left out only as far as every text that can reach the
score still holds one that is kept (``_best_without``); of the lengths that allow this, the one whose kept n-grams occur least gives the item's seeds.
So a line that many texts share does not join them to an item, and no copy is lost for how often its n-grams occur. Around its seeds a text is aligned
with the item word by word, with mismatches and gaps, so edited copies score as well; places whose words or word pairs are too few for the score are not
aligned. The items' n-grams are broadcast in blocks of bounded size; every block reads all texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import lean, lower_words, slices
from .repeats import _MIX, _numbered, _word_hashes, rolling

GRAM, SCORE = 3, 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
#: n-grams of one broadcast block (8 bytes each), whatever the number of items.
BLOCK_GRAMS = 1 << 20


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local score, and where in the text its alignment ends (exclusive)."""
    best, end, steps = 0, 0, np.arange(len(text)) * -GAP
    row = np.zeros(len(text), dtype=np.int64)
    for word in item:
        diagonal = np.concatenate([[0], row[:-1]]) + np.where(text == word, MATCH, MISMATCH)
        row = np.maximum(np.maximum(diagonal, row + GAP), 0)
        row = np.maximum.accumulate(row + steps) - steps
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at + 1
    return best, end


def _grams(tokens: list[list[bytes]], sizes: list[int]):
    """The texts' word hashes, where texts start in them (and the end), and for each size the hash, text number and start of every n-gram."""
    hashes = _word_hashes([w for t in tokens for w in t], 9)
    counts = np.array([len(t) for t in tokens], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(tokens)), counts)
    start = np.arange(len(hashes)) - begins[owner]
    made = []
    for size in sizes:
        h = rolling(hashes, size)
        inside = start[: len(h)] + size <= counts[owner[: len(h)]]
        made.append((size, h[inside].view(np.int64), owner[: len(h)][inside], start[: len(h)][inside]))
    return hashes, begins, made


def _best_without(kept: np.ndarray, length: int, size: int) -> int:
    """No alignment scores more if it holds none of an item's n-grams that start at ``kept`` (ascending).

    A word that is not matched costs its match. A longer n-gram is broken most cheaply by a gap between two of its words, which breaks all that
    span it: other words and missing ones cost at least as much as gaps on both their sides. So the cost is the fewest places that lie in all.
    """
    if size == 1:
        return MATCH * (length - len(kept))
    cuts, last = 0, -1
    for p in kept.tolist():
        if p > last:
            cuts, last = cuts + 1, p + size - 2
    return MATCH * length + GAP * cuts


def _kept(often: np.ndarray, length: int, size: int, least: float) -> np.ndarray | None:
    """Starts of the n-grams to keep, the most common left out as far as texts without the kept ones stay under ``least``; none if even all are too few."""
    order = np.argsort(often, kind="stable")
    if _best_without(np.arange(len(often)), length, size) >= least:
        return None
    few, enough = 0, len(order)
    while enough - few > 1:
        middle = (few + enough) // 2
        few, enough = (few, middle) if _best_without(np.sort(order[:middle]), length, size) < least else (middle, enough)
    return order[:enough]


def _may_reach(wanted: np.ndarray, text: np.ndarray, least: float) -> bool:
    """False only where the item's words, or pairs of them, that the text has are too few for the score."""
    if MATCH * np.isin(wanted, text).sum() < least:
        return False
    if len(wanted) < 2:
        return True
    pairs, there = (w[:-1] * _MIX + w[1:] for w in (wanted, text))
    return MATCH * len(wanted) + GAP * (len(pairs) - np.isin(pairs, there).sum()) >= least


def _items(items: DataFrame, item_col: str, text_col: str):
    """Items in blocks whose n-grams fit one broadcast: (ids, words) lists. Read partition by partition; one block is held at a time."""
    ids, tokens, held = [], [], 0
    for r in items.select(F.col(item_col).alias("i"), F.col(text_col).cast("string").alias("t")).orderBy("i").toLocalIterator():
        w = lower_words(r.t)
        if w:
            ids.append(r.i)
            tokens.append(w)
            held += len(w)
        if held >= BLOCK_GRAMS:
            yield ids, tokens
            ids, tokens, held = [], [], 0
    if ids:
        yield ids, tokens


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               least_score: float = SCORE, gram: int = GRAM) -> DataFrame:
    """``doc_id, item_id, score, end_word``: each text with each item it holds at ``least_score`` or more of the item's own score.

    ``end_word`` is where the best alignment ends. Seeds have up to ``gram`` words. Null and empty texts and items match nothing.
    Repeated rows are reported each; a row with a null id is reported with that null.
    """
    rows = _numbered(docs, id_col, text_col)
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, end_word long"
    found = None
    for ids, tokens in _items(items, item_col, item_text_col):
        leaks = _block_leaks(rows, ids, tokens, schema, least_score, gram)
        found = leaks if found is None else found.union(leaks)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def _block_leaks(rows: DataFrame, ids: list, tokens: list, schema: str, least_score: float, gram: int) -> DataFrame:
    context = rows.sparkSession.sparkContext
    least = [least_score * MATCH * len(w) for w in tokens]
    codes, begins, made = _grams(tokens, list(range(1, gram + 1)))
    wanted = [codes[a:b] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]
    seeds = {}
    for size, h, owner, _ in made:
        whole = {n: _best_without(np.arange(n - size + 1), n, size) for n in {len(w) for w in tokens if len(w) >= size}}
        sure = np.array([len(w) >= size and (whole[len(w)] < least[k] or size == 1) for k, w in enumerate(tokens)])
        if sure.any():
            seeds[size] = h[sure[owner]], owner[sure[owner]]
    grams = {size: np.unique(h) for size, (h, _) in seeds.items()}
    shared = context.broadcast(grams)

    def hits(tokens, wanted):
        """Word hashes and where texts start in them; for each size what n-grams of items the texts hold, the text number and start."""
        codes, begins, made = _grams(tokens, list(wanted))
        found = []
        for size, h, owner, start in made:
            known = wanted[size]
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            inside = known[at] == h
            found.append((size, at[inside], owner[inside], start[inside]))
        return codes, begins, found

    def count(batches):
        sums = {size: np.zeros(len(g), dtype=np.int64) for size, g in shared.value.items()}
        for batch in batches:
            for part in slices(batch, 0):
                for size, at, _, _ in hits([lower_words(t) for t in part.column(0).to_pylist()], shared.value)[2]:
                    sums[size] += np.bincount(at, minlength=len(sums[size]))
        for size, n in sums.items():
            some = np.flatnonzero(n)
            yield pa.record_batch([pa.array(np.full(len(some), size)), pa.array(some), pa.array(n[some])], names=["size", "at", "n"])

    totals = {size: np.zeros(len(g), dtype=np.int64) for size, g in grams.items()}
    for r in rows.select("text").mapInArrow(lean(count), "size long, at long, n long").groupBy("size", "at").agg(F.sum("n").alias("n")).toLocalIterator():
        totals[r.size][r.at] = r.n
    chosen: dict[int, tuple[int, int, np.ndarray]] = {}
    for size, (h, owner) in seeds.items():
        edges = np.searchsorted(owner, np.arange(len(tokens) + 1))
        often = totals[size][np.searchsorted(grams[size], h)]
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if a == b:
                continue
            kept = _kept(often[a:b], len(tokens[k]), size, least[k])
            kept = np.arange(b - a) if kept is None else kept
            uses = int(often[a:b][kept].sum())
            if k not in chosen or uses < chosen[k][0]:
                chosen[k] = uses, size, h[a:b][kept]
    plan = {}
    for size in seeds:
        own = [(h, k) for k, (_, n, hs) in chosen.items() if n == size for h in np.unique(hs).tolist()]
        if own:
            h, k = (np.array(x, dtype=np.int64) for x in zip(*sorted(own)))
            plan[size] = h, k
    wide = context.broadcast((plan, ids, wanted, least))

    def score(batches):
        planned, names, items, enough = wide.value
        known = {size: np.unique(h) for size, (h, _) in planned.items()}
        for batch in batches:
            for part in slices(batch, 1):
                out = []
                places: dict[tuple[int, int], list[int]] = {}
                codes, begins, found = hits([lower_words(t) for t in part.column(1).to_pylist()], known)
                for size, at, owner, start in found:
                    seed_hash, seed_item = planned[size]
                    h = known[size][at]
                    low, high = np.searchsorted(seed_hash, h), np.searchsorted(seed_hash, h, side="right")
                    for doc, s, a, b in zip(owner.tolist(), start.tolist(), low.tolist(), high.tolist()):
                        for item in seed_item[a:b].tolist():
                            places.setdefault((doc, item), []).append(s)
                for (doc, item), at in sorted(places.items()):
                    text, own = codes[begins[doc]:begins[doc + 1]], items[item]
                    # an alignment that reaches the score has no more words of the text than this
                    around = max(2 * len(own), int(len(own) + (MATCH * len(own) - enough[item]) / -GAP) + 1)
                    best, end = 0, 0
                    for low, high in _regions(sorted(at), around, len(text)):
                        if not _may_reach(own, text[low:high], enough[item]):
                            continue
                        value, stop = align(own, text[low:high])
                        if value > best:
                            best, end = value, low + stop
                    if best and best >= enough[item]:
                        out.append((doc, names[item], best / (MATCH * len(own)), end))
                if out:
                    docs, found_items, scores, ends = zip(*out)
                    yield pa.table({"doc_id": part.column(0).take(pa.array(docs)), "item_id": pa.array(found_items), "score": pa.array(scores), "end_word": pa.array(ends)}).to_batches()[0]

    return stage(rows.select("id", "text").mapInArrow(lean(score), schema), "leaks")


def _regions(places: list[int], around: int, length: int):
    """Stretches of the text around seeds, joined where they meet."""
    low, high = max(0, places[0] - around), places[0] + around
    for p in places[1:]:
        if p - around > high:
            yield low, min(high, length)
            low = p - around
        high = p + around
    yield low, min(high, length)
