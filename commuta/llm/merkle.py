"""Merkle manifest of a dataset: an append log of nodes in the order in which they are completed, and proofs read from it.

Each source has a tree over its documents, and one more tree stands over the sources. A builder takes an aligned stretch of
FAN ** STEP nodes and appends a node as soon as its last child is there, so its part of the log is in postorder. The place
of a node in the whole log has a closed form: a node is completed right after its last leaf, leaf i comes after i leaves
and i // FAN + i // FAN ** 2 + ... inner nodes, and a tree begins after the sizes of the trees before it. Builders need no
numbers from one another, and a proof addresses each sibling by its place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commuta.llm.batches import bounded
from commuta.llm.numbering import in_order, numbered, part
from commuta.operators.joins import running_totals
from commuta.operators.lineage import written_table

#: Children of a node (2 ** BITS), and levels that one builder adds to its stretch.
BITS = 4
FAN = 1 << BITS
STEP = 3
#: Levels of a tree at most: 2 ** 60 leaves.
LEVELS = 15
#: The tree over the sources has this number; the trees of sources are numbered from 0 in the order of the sources.
TOP = -1
#: Rows of a batch that a task returns.
ROWS = 4096

_NODE = "tree long, level int, index long, pos long, hash binary"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: ``doc_id``, ``tree``, ``rank`` and the digests; ``trees``: ``tree``, ``source``, ``n``, ``base``; ``log``: ``tree``,
    ``level``, ``index``, ``pos`` and ``hash`` of every node; ``n_trees`` and ``root`` (hex, None without documents)."""

    leaves: DataFrame
    trees: DataFrame
    log: DataFrame
    n_trees: int
    root: str | None


def _sum(terms: list[Column]) -> Column:
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def before_leaf(i: Column) -> Column:
    """Nodes of a tree that are completed before its leaf ``i``, which is also the leaf's place."""
    return i + _sum([F.shiftright(i, BITS * k) for k in range(1, LEVELS)])


def height(n: Column) -> Column:
    """Levels above the leaves of a tree with ``n`` of them."""
    return _sum([(F.shiftright(n - 1, BITS * k) > 0).cast("int") for k in range(LEVELS)])


def place(level: Column, index: Column, n: Column) -> Column:
    """The place of a node in its tree of ``n`` leaves: ``level`` places after its last leaf."""
    last = F.least(F.call_function("shiftleft", index + 1, level * BITS), n) - 1
    return before_leaf(last) + level


def framed(c: Column) -> Column:
    """A field as it is hashed: ``-`` for null, else its length in bytes, a colon and the value."""
    value = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_hash(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[framed(c) for c in fields]), 256))


def _hex_hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _log_batch(rows: list[tuple[int, int, int, int, str]]) -> pa.RecordBatch:
    tree, level, index, pos, hashes = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict({
        "tree": pa.array(tree, pa.int64()), "level": pa.array(level, pa.int32()), "index": pa.array(index, pa.int64()),
        "pos": pa.array(pos, pa.int64()), "hash": pa.array([bytes.fromhex(h) for h in hashes], pa.binary()),
    })


def _builder(first: int):
    """Appends the nodes over aligned stretches of level ``first`` (and its leaves, if that is 0), as they are completed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[list[str]] = [[] for _ in range(STEP)]
        out: list[tuple[int, int, int, int, str]] = []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("tree", "index", "pos", "n", "hash")]
            for tree, index, pos, n, raw in zip(*columns, strict=True):
                digest, last = raw.hex(), n - 1  # pos is that of the node itself; a parent follows its last child
                if first == 0:
                    out.append((tree, 0, index, pos, digest))
                for k in range(STEP):
                    level = first + k
                    final = last >> (BITS * level)  # index of the last node of this level
                    if not final:
                        break  # the only one: the root
                    runs[k].append(digest)
                    if index % FAN != FAN - 1 and index != final:
                        break
                    digest, index, pos = _hex_hash(runs[k]), index // FAN, pos + 1
                    runs[k].clear()
                    out.append((tree, level + 1, index, pos, digest))
            while len(out) >= ROWS:
                yield _log_batch(out[:ROWS])
                del out[:ROWS]
        if out:
            yield _log_batch(out)

    return run


def _built(nodes: DataFrame, sizes: DataFrame | None, most: int) -> DataFrame:
    """The log of the trees over ``nodes`` (``tree``, ``index``, ``pos``, ``hash``); ``sizes`` has ``tree`` and ``n``, at most ``most``.

    Without ``sizes`` there is one tree of ``most`` leaves.
    """
    log, first = None, 0
    while True:
        stretch = F.shiftright("index", BITS * STEP)
        sized = nodes.withColumn("n", F.lit(most).cast("long")) if sizes is None else nodes.join(sizes.select("tree", "n"), "tree")
        dealt = sized.withColumn("stretch", stretch)
        dealt = dealt.repartition("tree", "stretch").sortWithinPartitions("tree", "index").select("tree", "index", "pos", "n", "hash")
        made = written_table(dealt.mapInArrow(_builder(first), _NODE), "nodes")
        log = made if log is None else log.unionByName(made)
        first += STEP
        if (most - 1) >> (BITS * first) == 0:
            return log
        nodes = made.filter(F.col("level") == first).select("tree", "index", "pos", "hash")


def build(docs: DataFrame, id: str, source: str, fields: list[str], altered: dict[str, Column] | None = None, where: Column | None = None) -> Manifest:
    """The manifest of ``docs``: a tree for each ``source`` (null first, then by code points), leaves by ``id`` (null first).

    A leaf hashes ``fields`` in their order. Where ``where`` holds, ``leaves.changed`` has the hash of the row with the columns
    ``altered`` in place of its own, for :func:`proofs`; else null. Rows that are equal in id and source go by their hash, so
    repeated rows are neighbours. An empty table has no trees, no log and no root. Other columns are not read.
    """
    bounded(docs.sparkSession)
    own = [F.col(f"`{f}`") for f in fields]
    other = leaf_hash([(altered or {}).get(f, c) for f, c in zip(fields, own, strict=True)])
    changed = F.when(where, other) if where is not None else F.lit(None).cast("binary")
    hashed = docs.select(F.col(f"`{source}`").alias("source"), F.col(f"`{id}`").alias("doc_id"), leaf_hash(own).alias("hash"), changed.alias("changed"))
    ordered = in_order(written_table(hashed, "leaves"), "source", "doc_id", "hash")
    counts = ordered.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    size = before_leaf(F.col("n") - 1) + height(F.col("n")) + 1
    sources = in_order(counts, "source").select("*", size.alias("size"), F.lit(1).alias("one"))
    sources = running_totals(sources, part(), "at", {"number": "one", "end": "size"})
    tree = F.col("number") - 1
    between = before_leaf(tree) - tree  # nodes of the top tree that are completed before this tree's
    trees = written_table(sources.select(tree.alias("tree"), "source", "n", "size", (F.col("end") - F.col("size") + between).alias("base")), "trees")
    most, n_trees = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    ranked = numbered(ordered, "source", "rank").withColumnRenamed("source", "_source")
    leaves = ranked.join(trees, F.col("_source").eqNullSafe(F.col("source")))
    leaves = written_table(leaves.select("tree", "rank", "doc_id", "hash", "changed", (F.col("base") + before_leaf(F.col("rank"))).alias("pos")), "ranked")
    log = _built(leaves.select("tree", F.col("rank").alias("index"), "pos", "hash"), trees, most or 1)
    if not n_trees:
        return Manifest(leaves, trees, log, 0, None)
    ends = trees.withColumn("pos", F.col("base") + F.col("size") - 1)
    subroots = ends.join(log.select("pos", "hash"), "pos")
    tops = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("index"), "pos", "hash")
    above = written_table(_built(tops, None, n_trees).filter(F.col("level") > 0), "nodes")
    whole = log.unionByName(above)
    root = whole.select(F.max(F.struct("pos", "hash")).alias("last")).select(F.lower(F.hex("last.hash"))).first()[0]
    return Manifest(leaves, trees, whole, n_trees, root)


def _siblings(nodes: DataFrame, n: Column, first: int, index: Column, keep: list[str]) -> DataFrame:
    """``keep``, ``level`` and ``sibling`` (an index) of all siblings, from level ``first`` on, of nodes with ``index`` at that level."""
    levels = F.sequence(F.lit(first), height(n) - 1)
    rows = nodes.filter(height(n) > first).select(*keep, n.alias("n"), index.alias("index"), F.explode(levels).alias("level"))
    rows = rows.withColumn("index", F.call_function("shiftright", F.col("index"), (F.col("level") - first) * BITS))
    begin = F.call_function("shiftleft", F.call_function("shiftright", F.col("index"), F.lit(BITS)), F.lit(BITS))
    end = F.least(begin + (FAN - 1), F.call_function("shiftright", F.col("n") - 1, F.col("level") * BITS))
    rows = rows.select(*keep, "n", "level", "index", F.explode(F.sequence(begin, end)).alias("sibling"))
    return rows.filter("sibling != index").drop("index")


_NEAR = "array<struct<level:int,sibling:bigint,hash:binary>>"


def _paths(manifest: Manifest) -> DataFrame:
    """``tree``, ``stretch``, ``n``, ``subroot`` and the siblings above the stretch: ``inner`` in its tree, ``outer`` in the top tree."""
    trees, log, total = manifest.trees, manifest.log, F.lit(manifest.n_trees).cast("long")
    listed = F.sort_array(F.collect_list(F.struct("level", "sibling", "hash")))
    hashes = log.select("pos", "hash")
    ends = trees.select("tree", (F.col("base") + F.col("size") - 1).alias("pos")).join(hashes, "pos").select("tree", F.col("hash").alias("subroot"))
    # The top tree: a sibling stands right after the last tree that it covers.
    asked = _siblings(trees, total, 0, F.col("tree"), ["tree"])
    covered = F.least(F.call_function("shiftleft", F.col("sibling") + 1, F.col("level") * BITS), total) - 1
    spots = trees.select(F.col("tree").alias("covered"), (F.col("base") + F.col("size") - 1).alias("end"))
    asked = asked.withColumn("covered", covered).join(spots, "covered").withColumn("pos", F.col("end") + F.col("level"))
    outer = asked.join(hashes, "pos").groupBy("tree").agg(listed.alias("outer"))
    heads = trees.join(ends, "tree").join(outer, "tree", "left")
    stretches = heads.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, BITS * STEP))))
    tall = trees.withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, BITS * STEP))))
    within = _siblings(tall, F.col("n"), STEP, F.col("stretch"), ["tree", "stretch", "base"])
    within = within.withColumn("pos", F.col("base") + place(F.col("level"), F.col("sibling"), F.col("n")))
    upper = log.filter((F.col("level") >= STEP) & (F.col("tree") != TOP)).select("pos", "hash")
    inner = within.join(upper, "pos").groupBy("tree", "stretch").agg(listed.alias("inner"))
    return stretches.join(inner, ["tree", "stretch"], "left").select("tree", "stretch", "n", "base", "subroot", "inner", "outer")


def _by_level(found: list[dict] | None) -> list[tuple[int, list[tuple[int, str]]]]:
    levels: dict[int, list[tuple[int, str]]] = {}
    for f in found or []:
        levels.setdefault(f["level"], []).append((f["sibling"], f["hash"].hex()))
    return sorted(levels.items())


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document its siblings up to the root, addressed by their places, and the root that its hash leads to."""
    out: dict[str, list] = {c: [] for c in ("doc", "leaf", "subroot", "proof", "folded")}
    held: dict[int, str] = {}
    n = base = tree = 0
    head: list = []
    subroot = ""

    def leaf_place(i: int) -> int:
        return i + sum(i >> (BITS * k) for k in range(1, LEVELS))

    def run_of(level: int, index: int) -> tuple[int, list[str | None]]:
        """Place in its run, and the run's hashes, of a node of the stretch."""
        begin, last = index // FAN * FAN, (n - 1) >> (BITS * level)
        ends = [min((j + 1) << (BITS * level), n) - 1 for j in range(begin, min(begin + FAN - 1, last) + 1)]
        return index - begin, [held[base + leaf_place(e) + level] for e in ends]

    def steps(rank: int) -> list[tuple[int, list[str]]]:
        """(place among them, siblings) at each level from the leaf on."""
        found = []
        for level in range(STEP):
            if not (n - 1) >> (BITS * level):
                break
            at, run = run_of(level, rank >> (BITS * level))
            found.append((at, run[:at] + run[at + 1 :]))
        return found + head

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("kind", "tree", "stretch", "pos", "hash", "changed", "doc", "path")]
        for kind, of, stretch, pos, digest, changed, doc, path in zip(*columns, strict=True):
            if kind == 0:
                held, n, base, tree, subroot = {}, path["n"], path["base"], of, path["subroot"].hex()
                head, known = [], (dict(_by_level(path["inner"])), dict(_by_level(path["outer"])))
                for found, size, begin, first in ((known[0], n, stretch, STEP), (known[1], path["trees"], tree, 0)):
                    for level in range(first, LEVELS):
                        if not (size - 1) >> (BITS * level):
                            break
                        index = begin >> (BITS * (level - first))
                        near = found.get(level, [])
                        head.append((sum(s < index for s, _ in near), [h for _, h in near]))
            elif kind == 1:
                held[pos] = digest.hex()
            else:
                way = steps(pos)
                folded = (changed or digest).hex()
                for at, near in way:
                    folded = _hex_hash([*near[:at], folded, *near[at:]])
                for c, v in zip(out, (doc, digest.hex(), subroot, _hex_hash([h for _, near in way for h in near]), folded), strict=True):
                    out[c].append(v)
        if len(out["doc"]) >= ROWS:
            yield pa.RecordBatch.from_pydict({c: pa.array(v, batch["doc"].type if c == "doc" else pa.string()) for c, v in out.items()})
            out = {c: [] for c in out}
    if out["doc"]:
        yield pa.RecordBatch.from_pydict({c: pa.array(v, batch["doc"].type if c == "doc" else pa.string()) for c, v in out.items()})


def proofs(manifest: Manifest) -> DataFrame:
    """One row per document: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` (hex), ``verified``.

    ``proof_sha256`` hashes the siblings from the leaf's to those under the root, left to right in each run. ``folded_root`` is
    worked out anew from the changed hash of a row, if it has one, and those siblings. A task holds one stretch of nodes at a time.
    """
    spark = manifest.log.sparkSession
    bounded(spark)
    paths = _paths(manifest).withColumn("trees", F.lit(manifest.n_trees).cast("long"))
    path = F.struct("n", "base", "trees", "subroot", *[F.col(c).cast(_NEAR).alias(c) for c in ("inner", "outer")])
    kind = manifest.leaves.schema["doc_id"].dataType.simpleString()
    nothing = {"hash": "binary", "changed": "binary", "doc": kind, "pos": "long", "path": paths.select(path.alias("p")).schema["p"].dataType.simpleString()}

    def rows(df: DataFrame, which: int, **columns: Column) -> DataFrame:
        return df.select(
            "tree", "stretch", F.lit(which).alias("kind"),
            *[columns.get(c, F.lit(None).cast(t)).cast(t).alias(c) for c, t in nothing.items()],
        )

    nodes = manifest.log.filter((F.col("level") < STEP) & (F.col("tree") != TOP))
    nodes = nodes.withColumn("stretch", F.call_function("shiftright", F.col("index"), (STEP - F.col("level")) * BITS))
    docs = manifest.leaves.withColumn("stretch", F.shiftright("rank", BITS * STEP))
    parts = rows(paths, 0, path=path).unionByName(rows(nodes, 1, pos=F.col("pos"), hash=F.col("hash")))
    parts = parts.unionByName(rows(docs, 2, pos=F.col("rank"), hash=F.col("hash"), changed=F.col("changed"), doc=F.col("doc_id")))
    dealt = parts.repartition("tree", "stretch").sortWithinPartitions("tree", "stretch", "kind", "pos")
    made = dealt.mapInArrow(_prove, f"doc {kind}, leaf string, subroot string, proof string, folded string")
    root = F.lit(manifest.root).cast("string")
    return made.select(
        F.col("doc").alias("doc_id"), "leaf", "subroot", root.alias("root"), F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == root).alias("verified"),
    )
