"""Sharding by extendible hashing: a directory of hash prefixes in which only buckets that are too large split.

A document's hash is 60 bits of an MD5 over its id and text. The directory starts as one bucket; a bucket over the byte
limit splits on its next bit, the others stay. The tree is worked out on sums: documents are added up in cells of a
few bits more than the total needs, cells are added up to all prefixes, and a cell belongs to the shortest prefix that
fits. Only the documents of cells that are still too large take part in the next round, with more bits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from commuta.operators.lineage import written_table

#: Fixed: hash bits; and the bits a round looks ahead of the even split.
BITS = 60
AHEAD = 2
LIMIT_BYTES = 1 << 20


def hash_of(id: Column, text: Column) -> Column:
    """60 bits as a long; rows share it only if they have the same id and text. Nulls count as empty."""
    key = F.concat_ws(":", F.coalesce(id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def _prefix(bits: Column | int) -> Column:
    return F.call_function("shiftrightunsigned", F.col("hash"), (F.lit(BITS) - bits).cast("int"))


def _bits(prefix: Column, depth: Column) -> Column:
    return F.when(depth == 0, "").otherwise(F.lpad(F.bin(prefix), depth, F.lit("0")))


def shards(docs: DataFrame, limit_bytes: int = LIMIT_BYTES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The shard of every document: ``doc_id``, ``shard``, ``depth``, ``n_bytes``, ``shard_bytes``, ``shard_docs``.

    ``shard`` is the bucket's hash prefix as 0s and 1s (empty while one bucket holds all), ``n_bytes`` the text in UTF-8.
    A shard keeps to ``limit_bytes`` unless it is a single larger document. Repeated rows share all bits; where they alone
    pass the limit they are dealt in turn over pages ``prefix.0``, ``prefix.1`` and on. Null texts have no bytes, null ids
    count as empty, and an empty table has no shards. Only ``id`` and ``text`` are read; no text is shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = written_table(
        docs.select(F.col(id).alias("doc_id"), hash_of(F.col(id), F.col(text)).alias("hash"), F.octet_length(body).cast("long").alias("n_bytes")),
        "sizes",
    )
    done: list[DataFrame] = []
    columns = ["doc_id", "shard", "depth", "n_bytes", "shard_bytes", "shard_docs"]
    over, depth = rows, -1
    while True:
        total = over.agg(F.sum("n_bytes"), F.count(F.lit(1))).first()
        if not total[1]:
            break
        wanted = math.ceil(math.log2(max(1, (total[0] or 0) / limit_bytes))) + AHEAD
        deep = min(BITS, max(0, depth) + max(AHEAD, wanted))
        cells = over.groupBy(_prefix(deep).alias("cell")).agg(F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("docs"))
        levels = cells.withColumn("level", F.explode(F.sequence(F.lit(depth + 1), F.lit(deep)))).withColumn(
            "prefix", F.call_function("shiftrightunsigned", F.col("cell"), F.lit(deep) - F.col("level"))
        )
        # Also those too large at the last level: they are looked at again, or paged.
        fits = levels.groupBy("level", "prefix").agg(F.sum("n_bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs")).filter(
            (F.col("shard_bytes") <= limit_bytes) | (F.col("shard_docs") == 1)
        )
        leaf = F.min(F.struct("level", "prefix", "shard_bytes", "shard_docs")).alias("leaf")
        found = levels.select("cell", "level", "prefix").join(fits, ["level", "prefix"]).groupBy("cell").agg(leaf)
        placed = written_table(
            over.withColumn("cell", _prefix(deep)).join(found, "cell", "left").select("doc_id", "hash", "n_bytes", "leaf"), "placed"
        )
        done.append(placed.filter("leaf is not null").select(
            "doc_id", _bits(F.col("leaf.prefix"), F.col("leaf.level")).alias("shard"), F.col("leaf.level").alias("depth"),
            "n_bytes", "leaf.shard_bytes", "leaf.shard_docs",
        ))
        over, depth = placed.filter("leaf is null").drop("leaf"), deep
        if deep == BITS:
            done.append(_pages(over, limit_bytes).select(*columns))
            break
    out = done[0] if done else rows.select("doc_id", F.lit("").alias("shard"), F.lit(0).alias("depth"), "n_bytes", F.col("n_bytes").alias("shard_bytes"), F.lit(0).cast("long").alias("shard_docs"))
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _pages(same: DataFrame, limit_bytes: int) -> DataFrame:
    """Deal rows that share all bits, and so their size, over pages; numbered within a partition, then across them."""
    part = written_table(same.withColumn("part", F.spark_partition_id()), "same")
    counts = part.groupBy("hash", "part").agg(F.count(F.lit(1)).alias("docs"), F.max("n_bytes").alias("each"))
    before = Window.partitionBy("hash").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("hash")
    starts = counts.select("hash", "part", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("at"), F.sum("docs").over(whole).alias("all_docs"))
    number = F.row_number().over(Window.partitionBy("hash", "part").orderBy("n_bytes")) - 1
    a_page = F.greatest(F.lit(1), F.floor(F.lit(limit_bytes) / F.greatest("n_bytes", F.lit(1))))
    rows = part.withColumn("number", number).join(starts, ["hash", "part"]).withColumn("page", F.floor((F.col("number") + F.col("at")) / a_page))
    docs = F.least(a_page, F.col("all_docs") - F.col("page") * a_page).cast("long")
    return rows.select(
        "doc_id", F.concat_ws(".", _bits(F.col("hash"), F.lit(BITS)), F.col("page").cast("string")).alias("shard"),
        F.lit(BITS).alias("depth"), "n_bytes", (docs * F.col("n_bytes")).alias("shard_bytes"), docs.alias("shard_docs"),
    )


def write_shards(docs: DataFrame, folder: str, limit_bytes: int = LIMIT_BYTES, id: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` as Parquet, one folder ``shard=...`` for each shard; ids must be unique, rows keep all columns."""
    found = shards(docs, limit_bytes, id, text).select(F.col("doc_id").alias("_of"), F.concat(F.lit("b"), "shard").alias("shard"))
    rows = docs.select(F.struct("*").alias("doc")).join(found, F.col(f"doc.`{id}`").eqNullSafe(F.col("_of")))
    rows.repartition("shard").select("doc.*", "shard").write.partitionBy("shard").parquet(folder)
