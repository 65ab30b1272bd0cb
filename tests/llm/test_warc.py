"""Merkle trees and the audit against plain versions."""

import hashlib
import random

from commuta.llm import warc
from commuta.llm.queries import QUERIES, SQL
from workload.check import compare, connect


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_tree(records, top):
    levels, groups = {}, {}
    for f, o, n, h in sorted(records):
        groups.setdefault((f, o // warc.RANGE), []).append(f"{o}:{n}:{h}")
    at = {k: sha(";".join(v)) for k, v in groups.items()}
    for level in range(1, top + 1):
        levels |= {(level, f, k): h for (f, k), h in at.items()}
        up = {}
        for (f, k), h in sorted(at.items()):
            inside = level < warc.INNER
            up.setdefault((f, k // warc.FAN) if inside else (f // warc.FAN, 0), []).append(f"{k if inside else f}:{h}")
        at = {k: sha(";".join(v)) for k, v in up.items()}
    return levels


def made(draw, files=20, most=120):
    out = []
    for f in range(files):
        at = 0
        for _ in range(draw.randrange(most)):
            n = draw.randrange(100, 60_000)
            out.append((f * 3, at, n, sha(str(draw.random()))))
            at += n
    return out


SCHEMA = "file long, offset long, length long, sha256 string"


def test_tree_and_audit(spark):
    draw = random.Random(6)
    left = made(draw)
    right, states = [], {}
    for r in left:
        kind = draw.random()
        if kind < 0.01:
            states[r[0], r[1]] = "missing"
            continue
        if kind < 0.03:
            states[r[0], r[1]] = "altered"
            r = (r[0], r[1], r[2] + draw.randrange(2), sha("other" + r[3]))
        right.append(r)
    right.append((60_000, 0, 10, sha("a file more")))
    states[60_000, 0] = "added"
    frames = [spark.createDataFrame(x, SCHEMA) for x in (left, right)]
    top = warc.levels_over(*frames)
    assert top == warc.INNER + 4 and warc.levels_over(frames[0]) == warc.INNER + 2 and warc.levels_over(frames[0].limit(0)) == warc.INNER
    trees = [warc.tree(f, top) for f in frames]
    for rows, t in zip((left, right), trees, strict=True):
        assert {(r.level, r.file, r.node): r.hash for r in t.collect()} == plain_tree(rows, top)
    got = {(r.file, r.offset): r.state for r in warc.audit(*frames, *trees, top).collect()}
    assert got == states
    assert warc.audit(frames[0], frames[0], trees[0], trees[0], top).count() == 0


def test_empty_and_one_sided(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(0, 0, 5, "x")], SCHEMA)
    trees = [warc.tree(f, warc.INNER) for f in (none, one)]
    assert warc.audit(none, none, trees[0], trees[0], warc.INNER).count() == 0
    assert [r.state for r in warc.audit(one, none, trees[1], trees[0], warc.INNER).collect()] == ["missing"]
    assert [r.state for r in warc.audit(none, one, *trees, warc.INNER).collect()] == ["added"]


def test_layout_with_nulls_and_repeated_rows(spark):
    rows = [(k, f"http://h/{k}", "b" * (k * 31 % 500), "x") for k in range(400)]
    rows += [(None, None, None, "n"), (None, "u", "", "m"), (5, "http://h/5", "b" * 155, "x"), (2000, "é", "é" * 1000, "long")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, file string").repartition(3)
    digests = warc.digests(pages)
    laid = sorted((tuple(r) for r in warc.layout(digests, 20_000).select("file", "offset", "length", "page_id", "sha256").collect()), key=lambda r: r[:2])
    assert len(laid) == len(rows)
    order = [(-1 if r[3] is None else r[3], r[4]) for r in laid]
    assert order == sorted(order)
    at = {}
    for f, o, n, _, _ in laid:
        assert o == at.get(f, 0)
        at[f] = o + n
    assert len(at) > 5 and max(at.values()) < 20_000 + 3000
    bodies = {(r[0], r[1]): f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{'' if r[0] is None else r[0]}>\r\nWARC-Target-URI: {r[1] or ''}\r\nContent-Length: {len((r[2] or '').encode())}\r\n\r\n{r[2] or ''}\r\n\r\n" for r in rows}
    assert {r[4] for r in laid} == {sha(b) for b in bodies.values()}
    assert warc.layout(warc.digests(pages.limit(0))).count() == 0


def test_query_matches_sql(spark, sf_dir):
    df = QUERIES["op10_warc_fixity"](spark, sf_dir)
    con = connect(sf_dir)
    con.execute(f"create or replace view pages as select * from '{sf_dir}/pages.parquet'")
    cur = con.execute(SQL["op10_warc_fixity"])
    assert compare(df.columns, df.collect(), [d[0] for d in cur.description], cur.fetchall()) is None


def test_query_with_repeated_and_null_ids(spark, tmp_path):
    """Records that share an id, whole rows that repeat, and rows without an id: each has its own place and its own state."""
    def state(i):
        return "missing" if i is not None and i * 104729 % 389 == 7 else "altered" if i is not None and i * 7919 % 211 == 5 else "intact"

    altered = next(i for i in range(1000) if state(i) == "altered")
    missing = next(i for i in range(1000) if state(i) == "missing")
    rows = [(3, "u", "same")] * 3 + [(4, "one", "a"), (4, "two", "b"), (None, "n", "x"), (None, "n", "x"), (None, None, None)]
    rows += [(altered, "u", "body")] * 2 + [(missing, "v", "body"), (missing, "w", "other"), (9, "z", "é" * 10)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op10_warc_fixity"](spark, str(tmp_path)).collect()
    assert sorted(map(repr, [(r.page_id, r.state) for r in got])) == sorted(map(repr, [(r[0], state(r[0])) for r in rows]))
    assert len({(r.file, r.offset) for r in got}) == len(rows)
