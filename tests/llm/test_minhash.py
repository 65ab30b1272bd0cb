"""Circulant MinHash against all pairs of sets."""

import math
import random
import re

import numpy as np

from commuta.llm import minhash

SCHEMA = "doc_id long, text string, node string, n string, key string, root string"


def shingles(text, size=2):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def plain(docs, size=2, least=80):
    sets = {}
    for i, t in docs:
        sets.setdefault(shingles(t, size), []).append(i)
    nodes = [s for s in sets if s]
    root = {s: s for s in nodes}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if 100 * min(len(a), len(b)) >= least * max(len(a), len(b)) and 100 * len(a & b) >= least * len(a | b):
                root[find(a)] = find(b)
    first = {}
    for s in nodes:
        ids = [i for i in sets[s] if i is not None]
        first.setdefault(find(s), []).extend(ids)
    out = []
    for i, t in docs:
        s = shingles(t, size)
        component = min(first[find(s)], default=None) if s else i
        out.append((i, len(s), component, i == component))
    return sorted(out, key=repr)


def run(spark, docs, **more):
    df = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in docs], SCHEMA)
    got = minhash.near_duplicates(df, **more)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def changed(words, share, rng):
    return [rng.choice(VOCABULARY) if rng.random() < share else w for w in words]


VOCABULARY = [f"w{k}" for k in range(400)]


def test_signatures_are_circulant_and_estimate_jaccard():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    for s in (0.3, 0.5, 0.8):
        shared = int(2000 * 2 * s / (1 + s))
        a, b = np.unique(base[:2000]), np.unique(np.concatenate([base[:shared], rng.integers(0, 1 << 63, 2000 - shared).astype(np.uint64)]))
        got = np.concatenate([minhash.signatures([a, b], 4096)[0:2]])
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((got[0] == got[1]).mean() - exact) < 4 * math.sqrt(exact * (1 - exact) / 4096)
    # Coordinate k of a set is coordinate 0 of the set moved by k places: one permutation serves all.
    moved = minhash._scattered(a[:5]) + np.uint32(7)
    alone = minhash.signatures([a[:5]], 8)[0]
    assert alone[7] == min(second(int(x)) for x in moved)


def second(x):
    """The second permutation, of one number."""
    x = x * 0x9E3779B1 % 2**32
    x = (x ^ x >> 15) * 0x85EBCA77 % 2**32
    return (x ^ x >> 13) * 0xC2B2AE3D % 2**32


def test_blocks_do_not_change_signatures():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 5, 40_000, 3, 20_000, 20_000, 1)]
    assert (minhash.signatures(sets, 12) == np.concatenate([minhash.signatures([s], 12) for s in sets])).all()


def test_bands_follow_from_the_probability():
    for rows in (4, 6, 8):
        bands = minhash.band_count(80, rows, 1e-6)
        assert (1 - 0.8**rows) ** bands <= 1e-6 < (1 - 0.8**rows) ** (bands - 1)


def test_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = plain(docs)
    assert any(not r[3] for r in expected)
    assert run(spark, docs) == expected


def test_pairs_around_the_threshold(spark):
    rng = random.Random(5)
    docs = []
    for k in range(300):
        words = [rng.choice(VOCABULARY) for _ in range(rng.choice([4, 8, 30, 120]))]
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(changed(words, rng.choice([0.02, 0.05, 0.08, 0.12]), rng)))]
    expected = plain(docs)
    assert 100 < sum(not r[3] for r in expected) < 290
    assert run(spark, docs) == expected


def test_hot_groups(spark):
    """A family under the threshold, one chained above it, and copies: buckets split into blocks give the same classes."""
    rng = random.Random(6)
    first, second_ = ([rng.choice(VOCABULARY) for _ in range(80)] for _ in range(2))
    docs = [(k, " ".join(changed(first, 0.06, rng))) for k in range(300)] + [(1000 + k, "same text here") for k in range(300)]
    docs += [(2000 + k, " ".join(second_[k // 2 : k // 2 + 40] + [f"u{k}"])) for k in range(60)]
    expected = plain(docs)
    assert run(spark, docs) == expected
    kept = {c: getattr(minhash, c) for c in ("SIDE", "LARGE", "COLUMNS")}
    minhash.SIDE, minhash.LARGE, minhash.COLUMNS = 32, 40, 100
    try:
        assert run(spark, docs) == expected
    finally:
        for c, v in kept.items():
            setattr(minhash, c, v)


def test_sets_find_their_class_once(spark, monkeypatch):
    """What is joined with the classes has a row for each set that shares a bucket, not one for each bucket it is in."""
    made, write = {}, minhash.written_table
    monkeypatch.setattr(minhash, "written_table", lambda df, name="table": made.setdefault(name, []).append(write(df, name)) or made[name][-1])
    rng = random.Random(8)
    first = [rng.choice(VOCABULARY) for _ in range(100)]
    docs = [(k, " ".join(changed(first, 0.01, rng))) for k in range(40)]
    assert run(spark, docs) == plain(docs)
    (buckets,) = made["buckets"]
    assert 2 <= buckets.count() == buckets.select("node").distinct().count() <= len(docs)


def test_rows_formed_in_a_family_below_the_threshold(spark):
    """Hundreds of sets that are alike but not linked: what leaves a task is links, not the pairs that were compared."""
    rng = random.Random(7)
    first = [rng.choice(VOCABULARY) for _ in range(100)]
    docs = spark.createDataFrame([(k, " ".join(changed(first, 0.07, rng))) for k in range(400)], "doc_id long, text string")
    made = minhash.sketches(docs.selectExpr("doc_id as id", "xxhash64(text) as body_key", "text as body"), ["id", "body_key"], "body", 2, 6, 46)
    sketched = made.select("carried.id", "carried.body_key", "node", "n", "bands", "sketch").cache()
    search = minhash._Search(docs, "text", 2, 80, sketched, 276)
    rows = sketched.selectExpr("node", "n", "node as root", "1L as group")
    assert search._in_groups(rows).count() < 400


def test_awkward_rows(spark):
    docs = [
        (None, "a b c d e f"), (4, "A b c d e f"), (None, "p q r"), (None, "p q r"), (7, None), (6, ""), (5, " \t\n"), (6, ""), (3, "one"), (9, "ONE"),
        (8, "É é"), (10, "é é"), (11, "x " * 20_000), (12, "x x"), (13, "x x"), (2, "a\x0bb c d\x0ce f"), (2, "a b c d e f"),
    ]
    assert run(spark, docs) == plain(docs)
    assert run(spark, docs, size=5) == plain(docs, size=5)
    assert run(spark, []) == []
