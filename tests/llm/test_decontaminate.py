"""Verbatim matches against a plain search of every window."""

import random
import re

import pytest

from commuta.llm import decontaminate


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text, items, window=13):
    words, hit, names = plain_words(text), set(), set()
    for name, item in items:
        iw = plain_words(item)
        n = min(len(iw), window)
        for s in range(len(iw) - n + 1) if n else []:
            for p in range(len(words) - n + 1):
                if words[p : p + n] == iw[s : s + n]:
                    hit.update(range(p, p + n))
                    names.add(name)
    return len(words), len(hit), sorted(names)


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(k, t, "x", None) for k, t in enumerate(docs)], "doc_id long, text string, matches string, n_hit int")
    i = spark.createDataFrame(items, "item_id string, text string")
    rows = decontaminate.benchmark_matches(d, i, ["doc_id"], **options).collect()
    assert len(rows) == len(docs)
    return {r.carried.doc_id: (r.n_words, r.n_hit, sorted({m.item_id for m in r.matches})) for r in rows}


def texts(seed):
    draw = random.Random(seed)
    vocabulary = ["a", "b", "The", "été", "x1", "Ünd", "zz"]
    items = [(str(k), " ".join(draw.choice(vocabulary) for _ in range(draw.choice([0, 1, 2, 5, 12, 13, 14, 30])))) for k in range(12)]
    items.append((items[5][0], items[5][1]))  # a repeated row
    docs = []
    for _ in range(60):
        parts = []
        for _ in range(draw.randrange(4)):
            parts.append(" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(20))))
            item = draw.choice(items)[1].split()
            lo = draw.randrange(len(item) + 1)
            parts.append("  ,".join(item[lo : lo + draw.randrange(25)]).upper())
        docs.append("\n".join(parts))
    return docs + [None, "", "...", items[3][1], "x" * 50_000], items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_every_window(spark, seed):
    docs, items = texts(seed)
    got = found(spark, docs, items)
    assert got == {k: plain(t, items) for k, t in enumerate(docs)}


def test_many_blocks_and_small_shards_give_the_same(spark, monkeypatch):
    docs, items = texts(4)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 50)
    got = found(spark, docs, items, block_bytes=200)
    assert got == {k: plain(t, items) for k, t in enumerate(docs)}


def test_wide_vocabulary(spark):
    items = [(str(k), " ".join(f"w{k * 40 + j}" for j in range(40))) for k in range(1800)]  # over 65,536 words
    docs = [items[k][1] + " end " + " ".join(items[k + 1][1].split()[:12]) for k in (0, 900, 1700)]
    got = found(spark, docs, items)
    assert got == {n: (53, 40, [str(k)]) for n, k in enumerate((0, 900, 1700))}


def test_matches_are_the_longest(spark):
    item = " ".join(f"i{k}" for k in range(50))
    doc = "before " + " ".join(f"i{k}" for k in range(10, 45)) + " after"
    d = spark.createDataFrame([(1, doc)], "doc_id long, text string")
    i = spark.createDataFrame([("q", item), (None, "i10 i11")], "item_id string, text string")
    matches = decontaminate.benchmark_matches(d, i, ["doc_id"]).first().matches
    assert sorted(tuple(m) for m in matches) == [("", 1, 0, 2), ("q", 1, 10, 35)]


def test_one_word_repeated_in_both(monkeypatch):
    """All places of a document meet all places of an item: pairs are formed a part at a time, and one match a diagonal stays."""
    import tracemalloc

    def matched(n, m):
        items = decontaminate.TestItems([("q", "la " * m)])
        return decontaminate._matches(["la " * n, "so " + "la " * 12 + "so"], items)[1]

    got = matched(40, 30)
    want = {(max(0, k), max(0, -k)): min(40 - max(0, k), 30 - max(0, -k)) for k in range(-29, 40)}
    assert {(m["doc_word"], m["item_word"]): m["n_words"] for m in got[0]} == {k: v for k, v in want.items() if v >= 13} and got[1] == []
    monkeypatch.setattr(decontaminate, "PAIRS", 50)
    assert sorted(map(repr, matched(40, 30)[0])) == sorted(map(repr, got[0]))
    monkeypatch.undo()
    tracemalloc.start()
    many = matched(20_000, 20_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(many[0]) == 2 * (20_000 - 13) + 1 and peak < 500 << 20


def test_dropping_and_threshold(spark):
    item = " ".join(f"i{k}" for k in range(13))
    filler = " ".join(["word"] * 300)
    rows = [(1, item, "a"), (2, item + " " + " ".join(["word"] * 247), "b"), (3, item + " " + " ".join(["word"] * 248), "c"), (None, None, "d"), (4, filler, None), (4, filler, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, carried string")
    items = spark.createDataFrame([("q", item)], "item_id string, text string")
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted(rows[2:], key=repr)
    assert decontaminate.drop_contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == len(rows)


def test_query_matches_sql(spark, sf_dir):
    from commuta.llm.queries import QUERIES, SQL
    from workload.check import compare, connect

    con = connect(sf_dir)
    for t in ("documents", "benchmark"):
        con.execute(f"create or replace view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = QUERIES["op3_decontamination"](spark, sf_dir)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    cur = con.execute(SQL["op3_decontamination"])
    assert compare(df.columns, df.collect(), [d[0] for d in cur.description], cur.fetchall()) is None
