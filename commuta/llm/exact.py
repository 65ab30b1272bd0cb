"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each step leaves a bitmap of the groups that still hold more than one row. Its size does not depend on the corpus, so
it can be broadcast; two groups that share a bit only mean a text too many is hashed. No text
is shuffled to find the groups, and a text is hashed whole only if another text has its length and prefix hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commuta.llm.bitmaps import bitmap, marked, order_key
from commuta.operators.lineage import written_table

PREFIX_CHARS = 128


def _shared(rows: DataFrame, key: list[str]) -> DataFrame:
    """Bitmap of the keys that more than one row has."""
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return bitmap(groups, key)


def _open_texts(docs: DataFrame, text: str, carried: dict[str, Column]) -> DataFrame:
    """``carried``, ``body``, ``size``, ``head`` and ``open`` of every document, refined by length and prefix hash."""
    rows = docs.select(
        *[c.alias(name) for name, c in carried.items()], F.coalesce(F.col(text), F.lit("")).alias("body")
    ).withColumn("size", F.octet_length("body"))
    lengths = _shared(rows.select("size"), ["size"])
    heads = F.xxhash64(F.substring("body", 1, PREFIX_CHARS))
    same_length = marked(rows, ["size"], lengths).filter("open").select("size", heads.alias("head"))
    return marked(rows.withColumn("head", heads), ["size", "head"], _shared(same_length, ["size", "head"]))


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", digest_all: bool = False) -> DataFrame:
    """Group documents whose texts are identical; of each group the row with the largest ``id`` stays.

    Returns one row per input row: ``doc_id``, ``keep_id``, ``group_size`` (long), ``kept`` and ``text_sha256``
    (binary; null for texts that needed no full hash, unless ``digest_all``). Only ``id`` and ``text`` are read, so
    further columns of any name do no harm. A null text counts as empty. A null id is smaller than any other; in a
    group of null ids alone all are kept. Rows repeated with the same id are one document: each says the same.
    An empty table gives an empty result.
    """
    rows = _open_texts(docs, text, {"id": F.col(id)})
    digest = F.unhex(F.sha2("body", 256))
    hashed = written_table(
        rows.select(
            "id", "size", "open", (digest if digest_all else F.when(F.col("open"), digest)).alias("digest")
        ),
        "exact",
    )
    groups = (
        hashed.filter("open")
        .groupBy("size", "digest")
        .agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )
    groups = written_table(groups, "groups")  # so that the join deals both sides itself and can split a hot text
    keep = F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("last"))
    return hashed.join(groups, ["size", "digest"], "left").select(
        F.col("id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text: the one with the largest ``id``.

    Rows that refinement has told apart pass without a shuffle; the others are summed per text, on the map side
    first, so a group of a third of all rows reaches the shuffle as one row per task. Of rows repeated with the same
    id and text one stays. Nulls as in :func:`exact_duplicates`; all columns are returned as they came.
    """
    rows = _open_texts(docs, text, {"doc": F.struct("*"), "id": F.col(id)})
    plain = rows.filter("not open").select("doc.*")
    stays = (
        rows.filter("open")
        .groupBy("size", F.sha2("body", 256).alias("digest"))
        .agg(F.max_by("doc", F.struct("id", order_key(docs, "doc"))).alias("doc"))
        .select("doc.*")
    )
    return plain.unionByName(stays)
