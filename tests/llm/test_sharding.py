"""Extendible hashing against a plain directory that splits one bucket at a time."""

from collections import Counter, defaultdict

import pytest

from commuta.llm import sharding
from commuta.llm.queries import QUERIES, SQL
from workload.check import compare, connect


def plain(rows, limit):
    """rows: (hash, bytes); the prefix of each row's bucket, None where all bits are used up."""
    out = [None] * len(rows)
    todo = [(0, 0, list(range(len(rows))))]
    while todo:
        depth, prefix, held = todo.pop()
        size = sum(rows[k][1] for k in held)
        if size <= limit or len(held) == 1:
            for k in held:
                out[k] = (format(prefix, f"0{depth}b") if depth else "", size, len(held))
        elif depth < sharding.BITS:
            halves = defaultdict(list)
            for k in held:
                halves[rows[k][0] >> (sharding.BITS - depth - 1)].append(k)
            todo += [(depth + 1, p, part) for p, part in halves.items()]
    return out


def hashes(spark, docs):
    from pyspark.sql import functions as F

    return docs.select(sharding.hash_of(F.col("doc_id"), F.col("text")).alias("h"), "doc_id", F.expr("octet_length(coalesce(text, ''))").alias("n")).collect()


@pytest.mark.parametrize("limit", [50, 400, 5000, 10**9])
def test_against_plain_directory(spark, limit):
    rows = [(k, "é" * (k * 37 % 90), "x") for k in range(300)] + [(1000, None, None), (None, "no id", "y"), (1001, "z" * 3000, "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(4)
    found = {r.doc_id: r for r in sharding.shards(docs, limit).collect()}
    keyed = hashes(spark, docs)
    for h, expected in zip(keyed, plain([(h.h, h.n) for h in keyed], limit), strict=True):
        r = found[h.doc_id]
        assert (r.shard, r.shard_bytes, r.shard_docs, r.n_bytes) == (*expected, h.n) and len(r.shard) == r.depth
    assert len(found) == len(rows)


def test_repeated_rows_are_paged(spark):
    rows = [(7, "same row " * 10)] * 500 + [(k, f"other {k}") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = sharding.shards(docs, 1000).collect()
    assert len(found) == 600
    size = Counter()
    for r in found:
        size[r.shard] += r.n_bytes
    assert max(size.values()) <= 1000 and all(size[r.shard] == r.shard_bytes for r in found)
    pages = {r.shard for r in found if "." in r.shard}
    assert len(pages) == -(-500 // (1000 // 90)) and all(len(p.split(".")[0]) == 60 for p in pages)
    assert sum("." in r.shard for r in found) == 500


def test_empty_table_and_writing(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shards(docs).count() == 0
    docs = spark.createDataFrame([(k, "t" * 100, "e") for k in range(40)], "doc_id long, text string, extra string")
    sharding.write_shards(docs, str(tmp_path / "out"), 1000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40 and max(r["count"] for r in back.groupBy("shard").count().collect()) <= 10
    assert sorted(tuple(r) for r in back.select(*docs.columns).collect()) == sorted(tuple(r) for r in docs.collect())


def test_query_matches_sql(spark, sf_dir):
    df = QUERIES["op8_extendible_sharding"](spark, sf_dir)
    con = connect(sf_dir)
    con.execute(f"create or replace view documents as select * from '{sf_dir}/documents.parquet'")
    cur = con.execute(SQL["op8_extendible_sharding"])
    assert compare(df.columns, df.collect(), [d[0] for d in cur.description], cur.fetchall()) is None
