"""License scans, spelling groups and prefix tries against brute-force versions, on nulls, ties, repeated rows, clashing columns and no rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lodestay.llm import license_scan, prefix_trie, spelling


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def lowered(text):
    return text.translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))


def test_license_scan(spark):
    mit = license_scan.STATEMENTS[6][1]
    words = mit.split()
    texts = [None, "", "  ...  ", "CC BY 4.0, cc-by; CC by", "ALL RIGHTS RESERVED", "all rights all rights reserved", "the GNU General Public\nLicense", "x " * 3000 + mit + " y" * 50,
             " ".join(words[:7] + ["oops"] + words[8:]), " ".join(words[:5] + ["oops", "oops", "oops"] + words[8:]), " ".join(reversed(words)), "mit released license the under",
             "released under the license", "İALL rights reserved", "License license LICENSE", "released " + "w " * 60 + "under the mit license", "all rights reserved"]
    data = [(i if i % 5 else None, t, "w", [1]) for i, t in enumerate(texts)] + [(1, texts[3], "w", None)]
    frame = spark.createDataFrame(data, "doc_id long, text string, words string, sets array<int>").repartition(3)
    statements = [(label, s.split()) for label, s in license_scan.STATEMENTS]
    step = max(len(s) for _, s in statements) - 1
    want = []
    for doc_id, text, *_ in data:
        w = [x for x in re.split(license_scan.SEPARATORS, lowered(text or "")) if x]
        base = [(i, label) for label, p in license_scan.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        met = [(len(set(s) & set(w[b:b + 2 * step])) / len(set(s)), label) for b in range(0, len(w), step) for label, s in statements]
        met = [(share, label) for share, label in met if round(share * 1000) >= license_scan.PERCENT * 10]
        names = {label for _, label in base}
        want.append((doc_id, len(w), len(base), min(base)[0] if base else None, max(base)[0] if base else None, ",".join(sorted(names)),
                     ",".join(sorted(names | {label for _, label in met})), 1.0 if base else max(met, default=(0.0,))[0]))
    assert rows(license_scan.scan_licenses(frame)) == sorted(want, key=str)
    assert {"mit", "gpl", "cc-by", "reserved"} == {x for r in want for x in r[6].split(",") if x}
    assert rows(license_scan.scan_licenses(frame.limit(0))) == []
    assert {r[7] for r in rows(license_scan.scan_licenses(frame, statements=()))} == {0.0, 1.0}
    with pytest.raises(ValueError):
        license_scan.scan_licenses(frame, statements=(("x", "..."),))


def edits(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_tiles_lose_no_pair():
    dice = random.Random(3)
    names = sorted({"".join(dice.choice("abé") for _ in range(dice.randint(3, 7))) for _ in range(600)})
    words, rows = spelling.Words(names), np.arange(len(names))
    want = {(i, j) for i in range(len(names)) for j in range(i) if edits(names[i], names[j])}
    for tile in (8, 512):
        found, part = [], rows % 3
        for g in range(spelling.CLASSES):
            found += zip(*spelling.links(words, np.full(len(names), g), rows, rows, True, tile))
        assert sorted((max(x), min(x)) for x in found) == sorted(want)
        crowd = [zip(*spelling.links(words, np.full(len(names), 0), rows[part == i], rows[part == j], i == j, tile)) for i in range(3) for j in range(i, 3)]
        assert sorted((max(x), min(x)) for c in crowd for x in c) == sorted((i, j) for i, j in want if words.keys[i, 0] == words.keys[j, 0])


@pytest.mark.parametrize("block_words", [16_384, 40])
def test_spelling_groups(spark, block_words):
    """Small blocks deal one crowd of words to many parts."""
    dice = random.Random(4)
    base = ["".join(dice.choice("abcdeéÿÉ") for _ in range(dice.randint(7, 10))) for _ in range(25)] + ["aaaaaaa", "aaaaaaaa", "x" * 5000]
    texts = []
    for w in base:
        near = [w[:i] + dice.choice("abzè") + w[i + dice.randint(0, 1):] for i in (0, 2, 5, len(w) - 1)] + [w[:3] + w[4:], w[1] + w[0] + w[2:]]
        for n, v in zip((300, 30, 25, 3, 2, 2, 1), [w, *near]):
            texts += [v.upper() if v.isascii() and n == 25 else v] * n
    dice.shuffle(texts)
    data = [(k % 40 if k % 7 else None, "1" + "-".join(texts[k * 10:k * 10 + 10]) + " short", "w", 1) for k in range(-(-len(texts) // 10))] + [(1, None, "w", 1), (2, "", None, None)]
    counts = collections.Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: sorted((v for v in words if edits(w, v)), key=lambda v: (-words[v], v)) for w in words}
    form = {w: v[0] if v and words[v[0]] >= 10 * words[w] else None for w, v in near.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    frame = spark.createDataFrame(data, "doc_id long, text string, word string, n long").repartition(3)
    want = [(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words]
    assert rows(spelling.group_spellings(frame, block_words=block_words)) == sorted(want, key=str)
    assert len({w[2] for w in want}) < len(want) / 2 and any(form[w] and form[form[w]] for w in words)
    assert rows(spelling.group_spellings(frame.limit(0))) == []


def test_radix_tree_layouts():
    dice, root = random.Random(1), prefix_trie.Node(b"")
    keys = {bytes(dice.choice((0, dice.randrange(256))) for _ in range(dice.randint(0, 6))) for _ in range(4000)} | {bytes([i]) * 40 for i in range(256)}
    for i, key in enumerate(sorted(keys, key=lambda k: zlib.crc32(k))):
        prefix_trie.insert(root, key, i)
    sizes, found, stack = set(), [], [(root, b"")]
    while stack:
        node, before = stack.pop()
        sizes.add(node.size)
        if node.value is not None:
            found.append(before + node.path)
        labels = [i for i in range(256) if node.child(i) is not None]
        assert [node.child(i) for i in labels] == list(node.children())
        stack += [(node.child(i), before + node.path + bytes([i])) for i in reversed(labels)]
    assert sizes == {4, 16, 48, 256} and found == sorted(keys)


@pytest.mark.parametrize("range_rows", [1, 7, 20_000])
def test_prefix_trie(spark, range_rows):
    dice = random.Random(2)
    turns = [("user" if i % 2 else None, None if i == 3 else " ".join("w" * (i % 4 + 1) for _ in range(i % 6))) for i in range(9)]
    hot = [turns[0], turns[4]]
    data = []
    for conv in (0, 1, 2, 5, *range(20, 75), -7, -20, 100, 10**15):
        own = hot if conv % 3 == 0 else [*hot, *dice.choices(turns, k=dice.randint(0, 4))] if conv % 3 == 1 else dice.choices(turns, k=dice.randint(1, 6))
        data += [(conv, None if t == 0 and conv % 4 == 0 else t, role, text, "k") for t, (role, text) in enumerate(own)]
    data += [(2, 0, "user", "tie", "k"), (2, 0, "user", "tie", "k"), (2, 0, "user", "other tie", "k"), (None, 1, "user", "no conversation", "k")]
    data += [(conv, 0, "user", "alone", "k") for conv in range(205, 212)]
    data += [(61, t, "user", "long one", "k") for t in range(50, 400)]

    def name(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]

    talks = collections.defaultdict(list)
    for conv, turn, role, text, _ in data:
        if conv is not None:
            talks[conv].append((turn is not None, turn or 0, name(role or "", text or ""), len((text or "").split())))
    talks = {c: [x[2:] for x in sorted(v)] for c, v in talks.items()}
    rebuilt = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = talks.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:]
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, s in rebuilt.items():
        ends[tuple(x[0] for x in s)].append(c)
        for d in range(len(s) + 1):
            members[tuple(x[0] for x in s[:d])].append(c)
    last = {tuple(x[0] for x in s[:d]): s[d - 1][1] if d else 0 for s in rebuilt.values() for d in range(len(s) + 1)}
    below = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, own in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not below[k]
            saved[k[:d]] += (len(own) - 1) * last[k]
    want = [(min(own), len(k), min(members[k[:-1]]) if k else None, len(own), below[k], leaves[k], saved[k], hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
            for k, own in members.items()]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, key string").repartition(3)
    assert rows(prefix_trie.prefix_trie(frame, range_rows=range_rows)) == sorted(want, key=str)
    assert rows(prefix_trie.prefix_trie(frame.limit(0))) == [] and any(not s for s in rebuilt.values())
