"""The manifest against trees built by hand."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from commuta.llm import merkle

SCHEMA = "doc_id long, text string, source string, n_chars long, tree string, pos long, hash string, n string"
FIELDS = ["doc_id", "source", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return H(*[framed(row[f]) for f in FIELDS])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k : k + 16]) for k in range(0, len(out[-1]), 16)])
    return out


def way(tree, index):
    """(own place, siblings) at each level below the root."""
    for level in tree[:-1]:
        run = level[index // 16 * 16 : index // 16 * 16 + 16]
        yield index % 16, run[: index % 16] + run[index % 16 + 1 :]
        index //= 16


def plain(rows):
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    by = {s: sorted((r for r in rows if r["source"] == s), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for s in sources}
    trees = {s: levels([leaf(r) for r in by[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            steps = [*way(trees[s], i), *way(top, k)]
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"]) if r["text"] is not None else None
            folded = leaf(r | {"text": text}) if tampered else leaf(r)
            for at, near in steps:
                folded = H(*near[:at], folded, *near[at:])
            root = top[-1][0]
            out.append((r["doc_id"], leaf(r), trees[s][-1][0], root, H(*[h for _, near in steps for h in near]), folded, folded == root))
    return sorted(out, key=repr)


def manifest(spark, rows):
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["source"], r["n_chars"], "a", 1, "b", "c") for r in rows], SCHEMA)
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.build(df, "doc_id", "source", FIELDS, {"text": F.lower("text")}, where)


def made(n, source, rng, first=0):
    return [{"doc_id": first + i, "text": rng.choice(["Some Text", "plain", "", None, "É"]) and f"Row {i}", "source": source, "n_chars": i % 7} for i in range(n)]


def proved(spark, rows):
    got = merkle.proofs(manifest(spark, rows))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_trees_of_all_shapes(spark):
    rng = random.Random(1)
    sizes = [1, 2, 15, 16, 17, 31, 32, 33, 255, 256, 257, 300, 1, 1, 1, 3, 4, 16, 272, 1]
    rows = [r for k, n in enumerate(sizes) for r in made(n, f"s{k:02}" if k else None, rng, 10_000 * k)]
    rng.shuffle(rows)
    expected = plain(rows)
    assert 0 < sum(not r[-1] for r in expected) < len(rows) / 2
    assert proved(spark, rows) == expected


@pytest.mark.parametrize("n", [4095, 4096, 4097, 9000])
def test_several_builders(spark, n):
    rows = made(n, "hot", random.Random(2)) + made(40, "ü", random.Random(3), n)
    assert proved(spark, rows) == plain(rows)


def test_log_is_in_postorder_and_places_have_a_closed_form(spark):
    rows = made(4400, "a", random.Random(4)) + made(70, "b", random.Random(5), 5000)
    m = manifest(spark, rows)
    log = {r.pos: r for r in m.log.collect()}
    assert sorted(log) == list(range(len(log)))  # every place is taken once
    order = []

    def post(tree, nodes):
        def walk(level, index):
            if level:
                for k in range(index * 16, min(index * 16 + 16, len(nodes[level - 1]))):
                    walk(level - 1, k)
            order.append((tree, level, index, nodes[level][index]))

        walk(len(nodes) - 1, 0)

    trees = [levels([leaf(r) for r in rows if r["source"] == s]) for s in "ab"]
    for k, t in enumerate(trees):
        post(k, t)
    order.append((merkle.TOP, 1, 0, H(*[t[-1][0] for t in trees])))
    assert [(r.tree, r.level, r["index"], r.hash.hex()) for _, r in sorted(log.items())] == order
    assert m.root == order[-1][-1]
    spots = m.log.filter(F.col("tree") >= 0).join(m.trees.select("tree", "n", "base"), "tree")
    assert spots.filter(F.col("pos") != F.col("base") + merkle.place(F.col("level"), F.col("index"), F.col("n"))).isEmpty()


def test_awkward_rows(spark):
    row = {"doc_id": 5, "text": "Same", "source": None, "n_chars": None}
    rows = [row] * 20 + [row | {"doc_id": None}, row | {"doc_id": None, "text": None}, row | {"text": "A" * 100_000}, row | {"source": ""}, row | {"source": "", "text": None}]
    assert proved(spark, rows) == plain(rows)
    assert proved(spark, [row]) == plain([row])
    assert proved(spark, []) == []


def test_a_hot_id_is_dealt_to_several_ranges(spark):
    rows = made(50, "s", random.Random(6)) + [{"doc_id": 7, "text": "copy", "source": "s", "n_chars": 1}] * 3000
    assert proved(spark, rows) == plain(rows)
