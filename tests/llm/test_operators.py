"""Every operator on rows with nulls, empty and long texts, repeated rows, clashing columns and no rows, against brute-force versions."""

import collections
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lodestay.llm import decontaminate, language_id, language_model, mixing, quality, repeats, sequences, simhash, token_counts, vector_index
from lodestay.llm.common import arrow_map, components, crc_bucket, kept, lean
from lodestay.llm.queries import prepared, tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, size long, score double, h long"
EN = "the quick brown fox jumps over the lazy dog and runs far away from the old house near the river "
DE = "der schnelle braune Fuchs springt über den faulen Hund und läuft weit weg von dem alten Haus am Fluss "
LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [(1, EN * 3, "en", "a", 7, 0.1, 1), (2, DE * 3, "de", "b", None, None, 2), (3, None, None, None, 1, 1.0, None), (4, "", "en", "a", 1, 1.0, 1),
        (5, " \t\n ", "en", "a", 1, 1.0, 1), (6, "123 456", "en", "b", 1, 1.0, 1), (7, LONG, "en", "b", 1, 1.0, 1), (8, "x " + LONG + " y", "en", "c", 1, 1.0, 1),
        (9, EN * 2000, "en", "a", 1, 1.0, 1), (1, EN * 3, "en", "a", 7, 0.1, 1), (None, "no id here", "en", None, 1, 1.0, 1), (10, "<s> ▁ é\x00日本", "de", "c", 1, 1.0, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (3, 4), (9, 8), (7, 7)], "a long, b long")
    assert rows(components(edges)) == [(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8)]


def test_simhash(docs, none):
    def fp(text):
        w = (text or "").encode().lower().split()
        shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0

    prints = [fp(r[1]) for r in ROWS]
    group = list(range(len(ROWS)))
    for _ in ROWS:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if bin(a ^ b).count("1") <= 3:
                    group[i] = group[j] = min(group[i], group[j])
    least = [min((ROWS[j][0] for j in range(len(ROWS)) if group[j] == g and ROWS[j][0] is not None), default=None) for g in group]
    want = sorted(((r[0], f"{p:016x}", c) for r, p, c in zip(ROWS, prints, least)), key=str)
    assert rows(simhash.near_groups(docs)) == want
    assert rows(simhash.near_groups(docs, run_limit=1)) == want
    assert rows(simhash.near_groups(none)) == []


def test_crowded_keys_link_the_same(spark):
    random = np.random.default_rng(1)
    values = {int(v) for v in random.integers(0, 2 ** 62, 5)}
    for _ in range(300):
        values.add(random.choice(list(values)).item() ^ (1 << int(random.integers(0, 62))) ^ (1 << int(random.integers(0, 62))))
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    few, many = (dict(map(tuple, components(simhash.links(frame, run_limit=n)).collect())) for n in (2, 4096))
    assert few == many and len(set(few.values())) < len(few)


def test_similar_texts_form_groups(spark, docs, none):
    """Against the Jaccard similarity of all pairs, where the estimate cannot be in doubt; a group of copies over several parts included."""
    random = np.random.default_rng(5)

    def edited(words, edits):
        words = list(words)
        for at in random.choice(len(words), edits, replace=False):
            words[at] = f"e{random.integers(10**9)}"
        return words

    texts = []
    for base in range(12):
        words = [f"b{base}w{random.integers(10**6)}" for _ in range(200)]
        texts += [words] + [edited(words, n) for n in (1, 2, 3, 12, 30)]
    crowd = [f"c{i}" for i in range(300)]
    texts += [edited(crowd, 1) for _ in range(700)]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").repartition(5)
    group = dict(simhash.near_groups(frame, shingle=5, similarity=0.8).select("doc_id", "component_id").collect())
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in texts[:72]]
    alike = [[len(a & b) / len(a | b) for b in sets] for a in sets]
    for i in range(72):
        for j in range(i):
            if alike[i][j] >= 0.85:
                assert group[i] == group[j], (i, j, alike[i][j])
        if sorted(alike[i])[-2] < 0.68:
            assert group[i] == i
            assert sum(g == i for g in group.values()) == 1
    assert {group[i] for i in range(72, len(texts))} == {72}
    plain = dict(simhash.near_groups(docs, shingle=5).where("doc_id is not null").select("doc_id", "component_id").collect())
    wide = dict(simhash.near_groups(docs, shingle=5, similarity=0.8).where("doc_id is not null").select("doc_id", "component_id").collect())
    assert wide == {**plain, 8: 7}
    assert rows(simhash.near_groups(none, similarity=0.8)) == []


def test_links_are_exact(spark):
    """Pairs whose estimates lie on the wrong side: none below the similarity is linked, none from it on is lost."""
    texts, alike = [], []
    for k in range(150):
        for changed in ((36, 44) if k % 2 else (40, 50)):
            base = [f"{changed}.{k}.{i}" for i in range(404)]
            texts += [" ".join(base), " ".join(base[:-changed] + [f"{w}new" for w in base[-changed:]])]
            alike.append((400 - changed) / (400 + changed))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = dict(simhash.near_groups(frame, shingle=5, similarity=0.8).select("doc_id", "component_id").collect())
    plain = dict(simhash.near_groups(frame, shingle=5).select("doc_id", "component_id").collect())
    for i, a in enumerate(alike):
        assert (group[2 * i + 1] == group[2 * i]) == (a >= 0.8 or plain[2 * i + 1] == plain[2 * i]), a


def test_a_star_is_one_group(spark, monkeypatch):
    """Texts similar to one text and not to each other stay together, though they are far more than meet in a group."""
    monkeypatch.setattr(simhash, "PART_ROWS", 16)
    random = np.random.default_rng(6)
    words = [f"w{i}" for i in range(404)]
    texts = [" ".join(words)]
    for k in range(1500):
        at, edited = int(random.integers(0, 365)), list(words)
        edited[at:at + 38] = [f"n{k}.{i}" for i in range(38)]
        texts.append(" ".join(edited))
    sets = [{tuple(w[i:i + 5]) for i in range(400)} for w in map(str.split, texts)]
    want = [0] + [0 if len(s & sets[0]) >= 0.8 * len(s | sets[0]) else None for s in sets[1:]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    group = dict(simhash.near_groups(frame, shingle=5, similarity=0.8).select("doc_id", "component_id").collect())
    assert sum(w == 0 for w in want) > 1000 and all(group[i] == 0 for i, w in enumerate(want) if w == 0)


def test_pipeline_keeps_rows_without_a_key(spark, tmp_path):
    """Rows with a null or repeated id are documents of their own: only copies and leaks go."""
    import corpus_pipeline

    made = {k: " ".join(f"{k}.{i}" for i in range(60)) for k in "abcdefg"}
    rows_in = [(None, made["a"]), (None, made["b"]), (None, made["c"]), (1, made["d"]), (1, made["e"]), (2, made["d"]), (3, made["a"]), (0, made["e"]), (None, made["g"]), (1, made["g"])]
    frame = spark.createDataFrame(rows_in, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, frame, "")
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(None, made["b"]), (None, made["c"]), (1, made["d"]), (3, made["a"]), (0, made["e"]), (1, made["g"])], key=str)
    spark.createDataFrame([(1, made["b"]), (2, made["d"])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.drop_leaks(spark, kept, str(tmp_path))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([(None, made["c"]), (3, made["a"]), (0, made["e"]), (1, made["g"])], key=str)


def test_token_counts(docs, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    want = sorted(((r[0], len((r[1] or "").encode()), len(model.encode(r[1] or "")), len(model.encode(r[1] or "")) > 4096) for r in ROWS), key=str)
    assert rows(token_counts.count_tokens(docs, tokenizer("piece_bpe_32k.model"))) == want
    assert rows(token_counts.count_tokens(none, tokenizer("piece_bpe_32k.model"))) == []
    machine = token_counts.transducer(tokenizer("piece_bpe_32k.model"))
    texts = ["a" * 1500, "aaaa bb " * 100, "\n\t  é①", " " * 500]
    assert machine.counts(texts).tolist() == [len(t) for t in model.encode(texts)]


def test_sequences(docs, none):
    from tokenizers import Tokenizer

    coder, at, want = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), 0, []
    for r in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = coder.encode(r[1] or "", add_special_tokens=False).ids + [0]
        want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    manifest = sequences.write_sequences(docs, tokenizer("byte_bpe_50k.json"), length=64)
    assert rows(sequences.read_documents(manifest)) == sorted(want, key=str)
    table, ids = sequences.read_sequences(manifest.first().ids_file)
    assert len(ids) == 64 * table.num_rows and sum(sum(m) for m in table.column("mask").to_pylist()) == manifest.first().n_ids
    assert rows(sequences.read_documents(sequences.write_sequences(none, tokenizer("byte_bpe_50k.json")))) == []


def test_encoder_recovers_from_a_failed_batch(monkeypatch):
    coder = sequences.Encoder(tokenizer("byte_bpe_50k.json"))
    wanted = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in ("one two", "two three")]

    class Broken:
        def encode_batch_fast(self, *_, **__):
            raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(coder, "tokenizer", Broken())
        with pytest.raises(RuntimeError):
            coder.encode(["one two"])
    ids, counts = coder.encode(["one two", "two three"])
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == wanted


def test_an_encoder_stays_with_its_worker(spark):
    """Tasks by value have new globals; what is kept outlives them: of many tasks only the first of each worker finds nothing."""
    def first(batches):
        for _ in batches:
            home = kept("test")
            home["seen"] = home.get("seen", 0) + 1
            yield pa.RecordBatch.from_pydict({"first": [home["seen"] == 1]})

    found = [r.first for r in spark.range(64).repartition(64).mapInArrow(first, "first boolean").collect()]
    assert sum(found) < len(found) / 2


def test_an_encoder_is_bounded_by_bytes(monkeypatch):
    """Few long pieces weigh as much as many short ones; what is used most stays, and no ids change."""
    monkeypatch.setattr(sequences, "CACHE", 1 << 16)
    coder = sequences.Encoder(tokenizer("byte_bpe_50k.json"))
    for i in range(200):
        texts = ["often used", f"{i}x" * 400 + f" short{i}"]
        ids, counts = coder.encode(texts)
        want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
        assert sum(map(sys.getsizeof, coder.known)) <= (1 << 16) + 4096
    assert " used" in coder.known and "0x" * 400 not in coder.known
    ids, counts = coder.encode(["y" * 70000])
    assert ids.tolist() == coder.tokenizer.encode("y" * 70000, add_special_tokens=False).ids
    assert coder.encode(["often used"])[0].tolist() == coder.tokenizer.encode("often used", add_special_tokens=False).ids


def test_a_worker_drops_what_other_operators_kept(spark):
    def keep(batches):
        for batch in batches:
            kept("mine")["large"] = bytes(1 << 20)
            kept("others")["large"] = bytes(1 << 20)
            yield pa.RecordBatch.from_pydict({"n": [1]})

    def look(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"mine": [len(kept("mine"))], "others": [len(kept("others"))]})

    spark.range(32).repartition(32).mapInArrow(keep, "n long").collect()
    found = spark.range(32).repartition(32).mapInArrow(lean(look, "mine"), "mine long, others long").collect()
    assert sum(r.mine for r in found) and not sum(r.others for r in found)
    found = spark.range(32).repartition(32).select("id").transform(lambda df: arrow_map(df, lambda b: look([b]), "mine long, others long")).collect()
    assert not sum(r.mine for r in found)


def test_batches_of_the_pipeline_are_bounded_by_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes], "n": [batch.num_rows]})

    seen = []
    stage = corpus_pipeline._stage(lambda spark, docs, _: seen.extend(docs.mapInArrow(sizes, "size long, n long").collect()))
    stage(spark, spark.range(12).select(F.repeat(F.lit("x"), 1 << 20).alias("text")).coalesce(1), "")
    assert sum(r.n for r in seen) == 12 and max(r.size for r in seen) < 5 << 20
    prepared(spark)  # other queries' batches are as before
    texts = spark.range(12).select(F.repeat(F.lit("x"), 1 << 20).alias("text")).coalesce(1)
    assert [r.n for r in texts.mapInArrow(sizes, "size long, n long").collect()] == [12]


def test_mixing(docs, none):
    made = mixing.mix(docs, block_words=4, shard_rows=3).collect()
    assert len(made) == len(ROWS)
    by = collections.defaultdict(list)
    for r in made:
        assert 0 <= r.taken <= 3 * r.size and r.size == len((r.text or "").encode().split())
        by[r.source].append(r)
    for own in by.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 4 and own[0].target <= 3 * own[0].source_size
    assert rows(mixing.mix(docs)) == rows(mixing.mix(docs)) and rows(mixing.mix(none)) == []
    repeated = mixing.repeated(docs.drop("size"), block_words=4, shard_rows=3).collect()
    assert sum(len(r.text.encode().split()) for r in repeated) == sum(r.taken for r in made)


def test_repeats(docs, none):
    split = [(r[1] or "").encode().split() for r in ROWS]
    seen = collections.Counter(tuple(t[i:i + 35]) for t in split for i in range(len(t) - 34))
    want = []
    for r, t in zip(ROWS, split):
        gone = {j for i in range(len(t) - 34) if seen[tuple(t[i:i + 35])] > 1 for j in range(i, i + 35)}
        want.append((r[0], len(t), len(gone), b" ".join(w for i, w in enumerate(t) if i not in gone).decode()))
    assert rows(repeats.remove_repeats(docs)) == sorted(want, key=str)
    assert rows(repeats.remove_repeats(none)) == []


def test_language_model(docs, none):
    made = language_model.score(docs, crc_bucket("doc_id", 5) == 1).collect()
    split = [((r[1] or "").encode().lower().split() + [None], zlib.crc32(str(r[0]).encode()) % 5 == 1 if r[0] is not None else False) for r in ROWS]
    counts = collections.Counter(w for t, held in split if not held for w in t)
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((len(t), sum(counts[w] > 0 for w in t), round(sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t), 5)) for t, _ in split)
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 5)) for r in made) == want
    assert all(r.train_tokens == total and r.score < 0 for r in made) and rows(language_model.score(none, F.lit(False))) == []


def small_vocabulary(texts):
    counts = collections.Counter(w for t in texts for w in t.decode().split())
    return language_model.Vocabulary(list(counts), np.array(list(counts.values())), len(texts), np.zeros((language_model.BUCKETS, 2)))


@pytest.mark.parametrize("back", [2, 3])
def test_language_model_uses_words_further_back(back):
    """A change of the word two or three back changes the features; inside a class the last two words and the one before count as well."""
    vocab = small_vocabulary([b"a b c d e f g h i"])
    model = language_model.Model(vocab.mass, vocab.symbol, 12)
    codes = np.arange(6, dtype=np.uint32)
    other = codes.copy()
    other[5 - back] = 8
    for at, used in enumerate((language_model._TOP_FEATURES, language_model._INNER_FEATURES)):
        found = [model.features(c, language_model.symbols_of(c, vocab.symbol), np.array([0]))[at] for c in (codes, other)]
        assert [k for k in used if found[0][k, 5] != found[1][k, 5]] == ([1, 2] if back == 2 else [3] if at == 0 else [])


def plain_model(texts, rounds, vocab):
    """The same training, token by token, with a dictionary for each feature row."""
    m = language_model
    code, model = vocab.codes(), m.Model(vocab.mass, vocab.symbol, m.row_bits(vocab.total))
    weights = [collections.defaultdict(lambda: np.zeros(m.CLASSES)), collections.defaultdict(lambda: np.zeros(m.PER_CLASS))]

    def tokens(text):
        codes = np.array([*(code[w] for w in text.lower().split()), m._END_CODE], dtype=np.uint32)
        symbols = m.symbols_of(codes, vocab.symbol)
        return list(zip(symbols, *(f.T for f in model.features(codes, symbols, np.array([0])))))

    def chances(symbol, *found):
        for table, bias, rows in zip(weights, (model.class_bias, model.inner_bias[symbol // m.PER_CLASS]), found):
            logits = np.exp(bias + sum(table[r] for r in rows))
            yield logits / logits.sum()

    def gain(seen, share, w):
        expected = seen.sum() * share
        return np.log1p(np.maximum((seen - expected - m.PENALTY * w) / (expected + m.PENALTY), -0.9))

    seen = [collections.defaultdict(lambda n=n: np.zeros(n)) for n in (m.CLASSES, m.PER_CLASS)]
    for text in texts:
        for s, *found in tokens(text):
            for table, rows, which in zip(seen, found, (s // m.PER_CLASS, s % m.PER_CLASS)):
                for r in rows:
                    table[r][which] += 1
    for table, held, share in zip(weights, seen, (np.exp(model.class_bias), np.exp(model.inner_bias).mean(axis=0))):
        for r in held:
            table[r] = m.START * gain(held[r], share, table[r])
    for at in range(m.ROUNDS):
        sums = [collections.defaultdict(float), collections.defaultdict(float)]
        for text, dealt in zip(texts, rounds):
            if dealt == at:
                for s, *found in tokens(text):
                    for table, p, rows in zip(sums, chances(s, *found), found):
                        for r in rows:
                            table[r] = table[r] + p
        for table, held, expected in zip(weights, seen, sums):
            for r, e in expected.items():
                table[r] = table[r] + m.STEP * gain(held[r], e / e.sum(), table[r])
    return lambda text: sum(np.log10(top[s // m.PER_CLASS] * inner[s % m.PER_CLASS]) for s, *f in tokens(text) for top, inner in [chances(s, *f)])


def sentences(n):
    random = np.random.default_rng(3)
    names = [f"n{i}" for i in range(30)]
    return [" ".join(f"the {random.choice(names)} likes {a} and {a[::-1]}x" for a in random.choice(names, 1 + i % 9)) for i in range(n)]


def test_language_model_scores_by_brute_force_and_for_any_tasks(spark):
    texts = sentences(160)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = F.col("doc_id") % 4 == 3
    made = [{r.doc_id: r for r in language_model.score(frame.repartition(n, "doc_id"), held).collect()} for n in (2, 32)]
    training = [t.encode() for i, t in enumerate(texts) if i % 4 != 3]
    rounds = [r[0] for r in frame.where(~held).orderBy("doc_id").select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(language_model.ROUNDS))).collect()]
    plain = plain_model(training, rounds, small_vocabulary(training))
    for i, text in enumerate(texts):
        assert made[0][i].score == pytest.approx(made[1][i].score, rel=1e-6)
        if not set(text.split()) - {w for t in training for w in t.decode().split()}:  # an unseen word has a share of its bucket besides
            assert made[0][i].score == pytest.approx(plain(text.encode()), rel=1e-4)
    for one in made:
        assert sum(r.score - r.base_score for r in one.values() if r.held_out) > 0


def test_language_model_joins_words_outside_the_head(spark, docs, monkeypatch):
    """A head of a few words leaves the others to the join; counts and base scores stay the same."""
    whole = {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6), r.train_tokens) for r in language_model.score(docs, F.col("doc_id") == 2).collect()}
    monkeypatch.setattr(language_model, "HEAD", 12)
    made = {(r.doc_id, r.n_tokens): (r.n_known, round(r.base_score, 6), r.train_tokens) for r in language_model.score(docs, F.col("doc_id") == 2).collect()}
    assert made == whole


def test_language_id(docs, none):
    made = language_id.identify(docs, F.lit(False), rest=("size", "h")).collect()
    for r in made:
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 6))
    assert {r.doc_id: r.lang_pred for r in made}[2] == "de" and {r.doc_id: r.lang_pred for r in made}[9] == "en"
    assert rows(language_id.identify(none, F.lit(False))) == [] and {r.lang_pred for r in language_id.identify(docs, F.lit(True)).collect()} == {"und"}


def test_gradients_of_the_network():
    random = np.random.default_rng(0)
    network = language_id.Network(["a", "b"])
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    lanes, labels = random.integers(0, 9, (5, 3)), np.array([0, 1, 1])

    def loss():
        return -np.log(network.probabilities(lanes)[:, np.arange(3), labels]).mean()

    for name, g in network.gradients(lanes, labels).items():
        place = np.unravel_index(np.abs(g).argmax(), g.shape)
        value, step = network.p[name][place], 1e-3
        network.p[name][place] = value + step
        up = loss()
        network.p[name][place] = value - step
        assert abs((up - loss()) / (2 * step) - g[place]) < 1e-3 * max(1, abs(g[place]))
        network.p[name][place] = value


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (7, None), (99, 0)], "doc_id long, quality int")
    made = quality.score_quality(docs, labels, F.lit(False)).collect()
    assert len(made) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in made)
    assert {r.score for r in quality.score_quality(docs, labels.limit(0), F.lit(False)).collect()} == {0.5}
    assert rows(quality.score_quality(none, labels, F.lit(False))) == []


def test_leaks(spark, docs, none):
    items = spark.createDataFrame([(1, LONG), (2, None), (3, ""), (4, "an item that no text of these holds at all")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()} == {(7, 1), (8, 1)}
    edited = LONG.split()
    edited[5], edited[25], edited[40] = "A", "B", "C D"
    more = spark.createDataFrame([(20, "start " + " ".join(edited) + " end"), (21, " ".join(LONG.split()[:12]))], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.find_leaks(more, items).collect()] == [20]
    assert rows(decontaminate.find_leaks(none, items)) == [] and rows(decontaminate.find_leaks(docs, items.limit(0))) == []


@pytest.mark.parametrize("verbatim", [0, 3])
def test_edited_copies_are_leaks(spark, verbatim):
    """Every copy that reaches the score is found, however its n-grams are spread over texts; each is checked by an alignment of the whole text."""
    random = np.random.default_rng(8)
    common = [f"c{i}" for i in range(4)]
    texts, items = [], []
    for k, length in enumerate((1, 2, 5, 6, 12, 38, 39, 60)):
        item = [f"i{k}.{i}" if i % 3 else common[int(random.integers(4))] for i in range(1, length + 1)]
        items.append((k, " ".join(item)))
        texts += [item] * verbatim
        for step in (2, 3, 4, 5, 6):
            texts += [["new" if i % step == step - 1 else w for i, w in enumerate(item)], [w for i, w in enumerate(item) if i % step != step - 1],
                      [x for i, w in enumerate(item) for x in ([w, "more"] if i % step == step - 1 else [w])]]
        for share in (0.1, 0.15, 0.2):
            texts += [["other" if random.random() < share else w for w in item] for _ in range(10)]
    texts = [[*random.choice(common, 20).tolist(), *t, *random.choice(common, 20).tolist()] for t in texts] + [random.choice(common, 50).tolist() for _ in range(100)]
    want = set()
    for k, item in items:
        wanted = np.array([hash(w) for w in item.split()])
        want |= {(i, k) for i, t in enumerate(texts) if decontaminate.align(wanted, np.array([hash(w) for w in t]))[0] >= 1.2 * len(wanted)}
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = decontaminate.find_leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want)


def test_vectors(spark):
    random = np.random.default_rng(3)
    base = random.standard_normal((40, 8))
    made = [(i, (base[i % 40] + random.standard_normal(8) * 0.03 * (i >= 40)).tolist(), i % 40 % 2) for i in range(120)]
    made += [(200, made[0][1], 0), (201, None, 0), (202, [0.0] * 8, 0), (203, [None] + [1.0] * 7, 0), (204, [float("nan")] * 8, 0), (205, made[0][1], None), (206, [], 0)]
    frame = spark.createDataFrame(made, "vec_id long, embedding array<double>, label int")
    good = [m for m in made if m[0] <= 200]
    unit = np.array([m[1] for m in good])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & np.equal.outer([m[2] for m in good], [m[2] for m in good])
    got = {r.vec_id: r for r in vector_index.link_vectors(frame, block_rows=4).collect()}
    found = sum(got[m[0]].n_links for m in good)
    assert 0.9 * (near.sum() - len(good)) <= found <= near.sum() - len(good)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(201, 207))
    assert got[200].component_id == 0 and not got[200].kept and rows(vector_index.link_vectors(frame.limit(0))) == []


def test_tiny_and_huge_vectors_change_no_link(spark):
    random = np.random.default_rng(5)
    base = random.standard_normal((20, 8))
    made = [(i, base[i % 20] + random.standard_normal(8) * 0.02) for i in range(60)]
    made += [(60, np.full(8, 1e-200)), (61, np.full(8, 5e-324)), (62, np.full(8, 1e200)), (63, np.full(8, 1.7e308)), (64, base[0] * 1e-210), (65, base[1] * 1e250), (66, np.array([1e-200] + [1.0] * 7))]
    unit = np.array([v / np.abs(v).max() for _, v in made])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in made], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in vector_index.link_vectors(frame).collect()}
    assert [got[i] for i in range(len(made))] == (near.sum(axis=1) - 1).tolist() and got[60] >= 3 and got[64] >= 2


def test_mixing_small_sources_null_ids_and_clashing_names(spark):
    """A small source beside a large one reaches its target, null ids spread over shards, and columns named like the operator's own stay."""
    rows_in = [(None if i % 3 else i, "small" if i < 60 else "large", f"{i} two three" if i < 60 else " ".join([str(i)] * 200), i, i, i, i, i) for i in range(2060)]
    frame = spark.createDataFrame(rows_in, "doc_id long, source string, text string, _shard int, _full int, __order int, _rest int, taken int").repartition(4)
    made = mixing.mix(frame, shard_rows=100).collect()
    small = [r for r in made if r.source == "small"]
    assert sum(r.taken for r in small) == 540 == small[0].target and small[0].source_size == 180
    large = [r for r in made if r.source == "large"]
    assert abs(sum(r.taken for r in large) - large[0].target) <= 16 and all(r.taken <= 3 * r["size"] for r in made)
    assert sorted((r._shard, r._full, r["__order"], r._rest) for r in made) == [(i,) * 4 for i in range(2060)]
    assert len({r.taken for r in large if r.doc_id is None}) > 1
    again = mixing.repeated(frame.drop("taken"), shard_rows=100)
    assert again.columns == frame.drop("taken").columns and again.where("source = 'small'").count() == 180
