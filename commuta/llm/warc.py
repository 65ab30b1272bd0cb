"""WARC fixity: Merkle trees over records and offset ranges, compared from the roots down.

A file's records are laid end to end. A leaf is a record (offset, length, SHA-256); a node of level 1 covers the records
that begin in a range of RANGE bytes, each further level FAN ranges of the one below, up to the file; files are joined
FAN at a time up to one root. Two replicas with equal roots are equal. Otherwise only children of nodes that differ are
compared, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commuta.llm.numbering import in_order, part
from commuta.operators.joins import running_totals
from commuta.operators.lineage import written_table

#: A file is closed when it has reached FILE_BYTES; the ranges of level 1; children of a node.
FILE_BYTES = 4 << 20
RANGE = 1 << 16
FAN = 16
#: Levels of nodes inside files: file offsets end below RANGE * FAN ** (INNER - 1).
INNER = 3


def record(page_id: Column, url: Column, body: Column) -> Column:
    """A WARC response record as text; null parts are empty."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), blank(page_id), F.lit(">\r\nWARC-Target-URI: "),
        blank(url), F.lit("\r\nContent-Length: "), F.octet_length(blank(body)).cast("string"), F.lit("\r\n\r\n"), blank(body), F.lit("\r\n\r\n"),
    )


def digests(pages: DataFrame, id: str = "page_id", url: str = "url", body: str = "html", **more: Column) -> DataFrame:
    """``page_id``, ``length`` (bytes), ``sha256`` of each page's record, and ``more``; the bodies are read once, where they lie."""
    whole = record(F.col(id), F.col(url), F.col(body))
    return pages.select(F.col(id).alias("page_id"), F.octet_length(whole).cast("long").alias("length"), F.sha2(whole, 256).alias("sha256"), *[c.alias(n) for n, c in more.items()])


def layout(found: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Lay records into files in the order of page id and digest: ``file`` and ``offset`` before the columns of ``found``.

    Null ids come first, and each of several equal rows has a place of its own. Offsets are running sums inside ranges of the
    order, which even one id is dealt to several of, and only one row a range is summed in order.
    """
    ordered = in_order(found, "page_id", "sha256")
    summed = running_totals(ordered, part(), "at", {"reached": "length"}).withColumn("start", F.col("reached") - F.col("length"))
    placed = written_table(summed.withColumn("file", F.floor(F.col("start") / file_bytes)).drop("at", "reached"), "layout")
    first = placed.groupBy("file").agg(F.min("start").alias("first"))
    return placed.join(first, "file").select("file", (F.col("start") - F.col("first")).alias("offset"), *found.columns)


def _hash(entries: Column) -> Column:
    return F.sha2(F.array_join(entries, ";"), 256)


def levels_over(*replicas: DataFrame) -> int:
    """Levels of a tree over the files of all replicas: INNER and as many as join the files into one root."""
    last = max([r.agg(F.max("file")).first()[0] or 0 for r in replicas])
    outer = 0
    while FAN**outer <= last:
        outer += 1
    return INNER + outer


def tree(records: DataFrame, levels: int) -> DataFrame:
    """All nodes of a replica's tree: ``level``, ``file``, ``node``, ``hash``; files are numbers.

    Levels 1 to INNER lie inside files, INNER being a file's root; further levels join files, and the last has one
    node. A node holds the hashes of its children in order, with their places; a level has a FANth of the nodes below,
    and a group of rows has FAN children, or the records that begin in RANGE bytes.
    """
    entry = F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "length", "sha256"))),
        lambda r: F.concat_ws(":", r["offset"].cast("string"), r["length"].cast("string"), r["sha256"]),
    )
    at = written_table(
        records.groupBy("file", F.floor(F.col("offset") / RANGE).alias("node")).agg(_hash(entry).alias("hash")).withColumn("level", F.lit(1)), "nodes"
    )
    made = [at]
    child = F.transform(F.array_sort(F.collect_list(F.struct("place", "hash"))), lambda r: F.concat_ws(":", r["place"].cast("string"), r["hash"]))
    for level in range(2, levels + 1):
        inside = level <= INNER
        place = F.col("node") if inside else F.col("file")
        up = at.select(
            (F.col("file") if inside else F.floor(F.col("file") / FAN)).alias("file"),
            (F.floor(F.col("node") / FAN) if inside else F.lit(0).cast("long")).alias("node"), place.alias("place"), "hash",
        )
        at = up.groupBy("file", "node").agg(_hash(child).alias("hash")).withColumn("level", F.lit(level))
        made.append(at)
    out = made[0].select("level", "file", "node", "hash")
    for part in made[1:]:
        out = out.unionByName(part.select("level", "file", "node", "hash"))
    return written_table(out, "tree")


def audit(left: DataFrame, right: DataFrame, left_tree: DataFrame, right_tree: DataFrame, levels: int) -> DataFrame:
    """Where two replicas differ: ``file``, ``offset`` and ``state`` (altered, missing or added on the right).

    Starts at the roots and joins, level by level, only the children of nodes that differ; records are read only in
    the ranges that differ. Equal replicas give no rows after comparing one pair of hashes.
    """
    def nodes(t: DataFrame, level: int, name: str) -> DataFrame:
        return t.filter(F.col("level") == level).select("file", "node", F.col("hash").alias(name))

    def differing(l: DataFrame, r: DataFrame) -> DataFrame:
        return l.join(r, ["file", "node"], "full_outer").filter(~F.col("l").eqNullSafe(F.col("r"))).select("file", "node")

    open_ = written_table(differing(nodes(left_tree, levels, "l"), nodes(right_tree, levels, "r")), "differ")
    if not open_.isEmpty():
        for level in range(levels - 1, 0, -1):
            # A node's parent: FAN nodes of a file make one below a file's root, FAN files one above it.
            up = [F.col("file"), F.floor(F.col("node") / FAN)] if level < INNER else [F.floor(F.col("file") / FAN), F.lit(0).cast("long")]
            parents = open_.select(F.col("file").alias("up_file"), F.col("node").alias("up_node"))
            below = (up[0] == F.col("up_file")) & (up[1] == F.col("up_node"))
            open_ = differing(nodes(left_tree, level, "l").join(parents, below, "left_semi"), nodes(right_tree, level, "r").join(parents, below, "left_semi"))
            if level in (INNER, 1):  # a cut where the plan would double again
                open_ = written_table(open_, "differ")
    ranges = open_.select(F.col("file").alias("in_file"), F.col("node").alias("in_node"))
    inside = (F.col("file") == F.col("in_file")) & (F.floor(F.col("offset") / RANGE) == F.col("in_node"))
    l, r = (
        s.join(ranges, inside, "left_semi").groupBy("file", "offset").agg(F.sort_array(F.collect_list(F.struct("length", "sha256"))).alias(n))
        for s, n in ((left, "l"), (right, "r"))
    )
    state = F.when(F.col("r").isNull(), "missing").when(F.col("l").isNull(), "added").otherwise("altered")
    return l.join(r, ["file", "offset"], "full_outer").filter(~F.col("l").eqNullSafe(F.col("r"))).select("file", "offset", state.alias("state"))
