"""SimHash classes against a comparison of all pairs."""

import random

import numpy as np
import pytest
import xxhash

from commuta.llm import simhash
from commuta.llm.components import components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    """Smallest position each position reaches over links of at most two bits."""
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    keys = np.array(distinct, np.uint64)
    for i, p in enumerate(distinct):
        for j in np.flatnonzero(simhash.ones(keys[i + 1 :] ^ keys[i]) <= 2):
            a, b = find(p), find(distinct[i + 1 + int(j)])
            root[max(a, b)] = min(a, b)
    return [find(p) for p in prints]


def signed(p):
    return p - (1 << 64) if p >> 63 else p


def test_fingerprint_matches_spark_hash(spark):
    text = "The quick Brown\tfox"
    grams = ["the quick brown", "quick brown fox"]
    hashes = spark.createDataFrame([(g,) for g in grams], "g string").selectExpr("xxhash64(g) as h").collect()
    assert sorted(r.h % 2**64 for r in hashes) == sorted(xxhash.xxh64_intdigest(g, seed=42) for g in grams)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One two", "a b c d e f", "Ä É x \x85 y Z", "w " * 200_000])
def test_fingerprint_edges(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_blocks_of_hashes(monkeypatch):
    text = " ".join(f"w{k % 37}" for k in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES", 7)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def planted(draw, n):
    """Fingerprints with chains, dense groups and lone ones."""
    out = [0, (1 << 64) - 1]
    while len(out) < n:
        base = draw.getrandbits(64)
        out.append(base)
        for _ in range(draw.randrange(6)):
            base ^= 1 << draw.randrange(64)
            if draw.random() < 0.5:
                base ^= 1 << draw.randrange(64)
            out.append(base)
        if draw.random() < 0.02:  # a dense group in a few bits
            bits = [draw.randrange(64) for _ in range(9)]
            out += [base ^ sum(1 << b for b in set(bits) if draw.random() < 0.5) for _ in range(150)]
    return out


@pytest.mark.parametrize("node_rows", [1 << 16, 20])
def test_links_connect_what_all_pairs_connect(spark, node_rows):
    prints = planted(random.Random(node_rows), 1500)
    # A common prefix makes one node of the first trie hold many.
    prints += [0xABCDEF << 40 | random.Random(k).getrandbits(12) << 20 | 0x12345 for k in range(400)]
    frame = spark.createDataFrame([(signed(p),) for p in set(prints)], "fingerprint long")
    links = simhash.near_links(frame, node_rows)
    got = {r.node % 2**64: r.root for r in components(links, "a", "b").collect()}
    assert links.count() <= 3 * len(set(prints)) * (1 if node_rows > 1000 else 22)
    classes = {}
    for p, root in zip(prints, plain_classes(prints), strict=True):
        classes.setdefault(root, set()).add(p)
    for members in classes.values():
        roots = {got.get(p, signed(p)) for p in members}
        assert roots == {min(signed(p) for p in members)}


def test_small_frontier_gives_the_same(monkeypatch):
    keys = np.array(sorted(set(planted(random.Random(3), 600))), np.uint64)
    n = len(keys)
    ends = [np.array([x]) for x in (0, n, 0, n, 63, 0)]
    whole = simhash.trie_links(keys, *ends)
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    monkeypatch.setattr(simhash, "LEAVES", 1)
    again = simhash.trie_links(keys, *ends)
    expected = plain_classes(keys.tolist())
    for roots in (whole, again):
        assert len(set(zip(roots.tolist(), expected, strict=True))) == len(set(expected)) == len(set(roots.tolist()))


def test_components(spark):
    draw = random.Random(1)
    edges = [(k, k + 1) for k in range(300)] + [(1000, k) for k in range(1001, 1500)] + [(5, 5), (700, 701), (701, 702), (702, 700)]
    draw.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{k: 0 for k in range(1, 301)}, **{k: 1000 for k in range(1001, 1500)}, 701: 700, 702: 700}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_documents_with_nulls_ties_and_clashing_columns(spark):
    long = " ".join(f"w{k}" for k in range(300))
    rows = [
        (5, long, "a", 1), (3, long.upper(), "b", 2), (9, None, None, 3), (8, "", "c", None), (None, " ", "d", 5),
        (7, long + " x", "e", 6), (4, "quite another text here", "f", 7), (4, "quite another text here", "f", 7), (3, long.upper(), "b", 2),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, rows int")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(r[1]) for r in rows]
    classes = plain_classes(prints)
    for r, p, c in zip(rows, prints, classes, strict=True):
        ids = [x[0] for x, k in zip(rows, classes, strict=True) if k == c and x[0] is not None]
        assert got[r[0], signed(p)] == min(ids, default=None)
    assert simhash.near_duplicates(docs).count() == len(rows)
    stays = simhash.drop_near_duplicates(docs)
    assert stays.columns == docs.columns
    kept = rows_of(stays)
    assert len(kept) == len(set(classes))
    assert (3, long.upper(), "b", 2) in kept and (None, " ", "d", 5) in kept and (4, "quite another text here", "f", 7) in kept
    assert simhash.near_duplicates(docs.limit(0)).count() == simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_query_on_a_whole_table(spark, sf_dir):
    from commuta.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(d.text) for d in docs]
    classes = plain_classes(prints)
    least = {}
    for d, c in zip(docs, classes, strict=True):
        least[c] = min(least.get(c, d.doc_id), d.doc_id)
    expected = sorted((d.doc_id, f"{p:016x}", least[c]) for d, p, c in zip(docs, prints, classes, strict=True))
    found = QUERIES["op1_simhash_near_dedup"](spark, sf_dir)
    assert rows_of(found.select("doc_id", "fingerprint", "component_id")) == sorted(expected, key=repr)
