"""Exact duplicates on small tables of every awkward kind."""

import hashlib
from collections import Counter

from commuta.llm import exact
from commuta.llm.queries import QUERIES, SQL
from workload.check import compare, connect

ROWS = [
    (1, "same", "a", 1), (7, "same", "b", 2), (4, "same", "c", 3), (9, None, "d", 4), (2, "", None, 5), (5, "Same", "e", 6),
    (6, "same ", "f", 7), (None, "nameless", "g", 8), (None, "nameless", "h", 9), (None, "same", "i", 10),
    (8, "twice", "j", 11), (8, "twice", "j", 11), (8, "other text", "k", 12), (3, "x" * 200_000, "l", 13), (10, "x" * 200_000, "m", 14),
    (11, "x" * 199_999 + "y", "n", 15), (12, "é", "o", 16), (13, "é", "p", 17),
]
SCHEMA = "doc_id long, text string, keep_id string, open int"


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for r in rows:
        same = groups[r[1] or ""]
        keep = max((i for i in same if i is not None), default=None)
        out.append((r[0], keep, len(same), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return out


def test_groups(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    found = exact.exact_duplicates(docs, digest_all=True).collect()
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256.hex()) for r in found]
    assert Counter(got) == Counter(plain(ROWS))
    lazily = exact.exact_duplicates(docs).collect()
    assert Counter(tuple(r)[:4] for r in lazily) == Counter(g[:4] for g in got)
    sizes = {r.doc_id: (r.group_size, r.text_sha256) for r in lazily}
    assert sizes[5][1] is None and sizes[11][1] is not None  # told apart by its prefix hash, or only by the whole text
    assert all(r.text_sha256 is not None for r in lazily if r.group_size > 1)


def test_unique_lengths_are_not_hashed(spark):
    docs = spark.createDataFrame([(k, "w" * k) for k in range(50)], "doc_id long, text string")
    assert exact.exact_duplicates(docs).filter("text_sha256 is not null").count() == 0


def test_dropping(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    rows = [tuple(r) for r in kept.collect()]
    assert Counter(r[1] or "" for r in rows) == Counter({(r[1] or ""): 1 for r in ROWS})
    by_text = {r[1] or "": r for r in rows}
    assert by_text["same"][0] == 7 and by_text[""][0] == 9 and by_text["twice"] == (8, "twice", "j", 11)
    assert by_text["x" * 200_000][0] == 10 and by_text["nameless"][0] is None


def test_few_slots_change_nothing(spark, monkeypatch):
    from commuta.llm import bitmaps

    monkeypatch.setattr(bitmaps, "SLOTS", 64)
    docs = spark.createDataFrame(ROWS, SCHEMA)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_duplicates(docs).collect()) == Counter(p[:4] for p in plain(ROWS))
    assert exact.drop_exact_duplicates(docs).count() == len({r[1] or "" for r in ROWS})


def test_empty_table_and_map_columns(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact.exact_duplicates(docs).count() == 0 and exact.drop_exact_duplicates(docs).count() == 0
    mapped = spark.createDataFrame([(1, "a", {"x": 1}), (2, "a", {"y": 2})], "doc_id long, text string, extra map<string,int>")
    assert [r.doc_id for r in exact.drop_exact_duplicates(mapped).collect()] == [2]


def test_large_group_of_copies(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then repeat('copy ', 50) else concat('text ', id) end as text")
    found = exact.exact_duplicates(docs).filter("group_size > 1")
    assert found.count() == 1000 and found.filter("keep_id = 2997").count() == 1000 and exact.drop_exact_duplicates(docs).count() == 2001


def test_no_text_is_shuffled(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = exact.exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.replace("text_sha256", "")


def test_query_matches_sql(spark, sf_dir):
    found = QUERIES["op2_exact_dedup"](spark, sf_dir)
    con = connect(sf_dir)
    con.execute(f"create or replace view documents as select * from '{sf_dir}/documents.parquet'")
    cur = con.execute(SQL["op2_exact_dedup"])
    assert compare(found.columns, found.collect(), [d[0] for d in cur.description], cur.fetchall()) is None
