"""Spelling variants against all pairs of words, by the definition."""

import random
import zlib
from collections import Counter

import pytest

from commuta.llm import variants
from commuta.llm.numbering import in_order

SCHEMA = "doc_id long, text string, word string, at long, n string"


def near(a, b):
    """One inserted, deleted or replaced character."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(docs, least_chars=7, least_n=2, times=10, slip=31):
    import re

    counts = Counter()
    for i, text in docs:
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", folded):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= least_chars:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= least_n}
    found, forms = {}, {}
    for w, n in counts.items():
        others = sorted((v for v in counts if abs(len(v) - len(w)) < 2 and near(v, w)), key=lambda v: (-counts[v], v))
        if others and counts[others[0]] >= times * n:
            forms[w] = others[0]
        found[w] = [w, forms.get(w), w, n, len(others), counts.get(forms.get(w))]
    for w in found:
        while found[w][2] in forms:
            found[w][2] = forms[found[w][2]]
    return sorted(map(tuple, found.values()), key=repr)


def run(spark, docs, **more):
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], SCHEMA)
    got = variants.spelling_variants(df, **more)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_random_words(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(40)]
    docs = []
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 30)):
            w = stems[min(int(rng.expovariate(0.15)), 39)]
            k = rng.randrange(len(w))
            kind = rng.random()
            if kind < 0.05:
                w = w[:k] + w[k + 1 :]
            elif kind < 0.1:
                w = w[:k] + rng.choice("abéz") + w[k:]
            elif kind < 0.15:
                w = w[:k] + rng.choice("abéÿ") + w[k + 1 :]
            words.append(w.capitalize() if rng.random() < 0.2 else w)
        docs.append((i, " ".join(words)))
    expected = plain(docs, least_chars=6, times=3)
    assert sum(r[1] is not None for r in expected) > 20 and any(r[1] != r[2] and r[1] for r in expected)
    assert run(spark, docs, least_chars=6, times=3) == expected


def test_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert run(spark, docs) == plain(docs)


def test_awkward_rows(spark):
    docs = [
        (None, "wonderful " * 3), (1, None), (2, ""), (2, "Wonderful wonderfull WONDERFULL"), (2, "Wonderful wonderfull WONDERFULL"),
        (3, "aaaaaaaa aaaaaaaa aaaaaaa aaaaaaa aaaaaab aaaaaab"), (4, "wonder-ful x÷÷÷÷÷÷÷÷ x÷÷÷÷÷÷÷÷"), (5, "​größere größere grösere grösere"),
    ]
    assert run(spark, docs, slip=0) == plain(docs, slip=0)
    assert run(spark, docs, slip=2) == plain(docs, slip=2)
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, docs, times=1)


def test_long_words(spark):
    docs = []
    for n in (22, 23, 24, 25, 253, 254, 255, 256, 257, 258, 400):
        rng = random.Random(n)
        word = "".join(rng.choice("abcdé") for _ in range(n))
        k = rng.randrange(n)
        docs.append((n, " ".join([word] * 20 + [word[:k] + word[k + 1 :], word[:k] + "q" + word[k:], word[:k] + "r" + word[k + 1 :]] * 2)))
    assert run(spark, docs, slip=0) == plain(docs, slip=0)


def test_very_long_word_is_filed_in_memory_of_its_size():
    word = "ab" * 50_000
    assert sum(len(key) for key, _ in variants.rotation_keys(word)) <= 17 * (2 * len(word) + 1)


def test_groups_are_small(spark):
    """A group holds one place and one context, whatever the table: no key becomes hot and no pair is formed."""
    rows = [("abcdef" + c + "ghij", 5) for c in map(chr, [*range(97, 123), *range(0xC0, 0x100)])]
    words = in_order(spark.createDataFrame(rows, "word string, n long"), "word")
    filed = words.mapInArrow(variants._rotations, "key binary, role int, at long, n long")
    sizes = filed.groupBy("key").count().orderBy("count", ascending=False).limit(1).collect()
    assert sizes[0]["count"] == len(rows) == 90
    assert {r.n_near for r in variants.near_words(words).collect()} == {89}
