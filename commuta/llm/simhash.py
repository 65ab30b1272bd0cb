"""SimHash near-duplicates: a self-join of binary tries over the fingerprints.

Two fingerprints with at most ``BITS_APART`` = 2 differing bits agree on one of three blocks of bits. For each block there
is a trie with that block first, so a linked pair walks the first levels of one of the tries on the diagonal (a node
paired with itself): Spark shuffles by that node. Below it, pairs of nodes are walked together; differing bits add up
and a pair is dropped when there are more than two. A node with too many fingerprints is first walked some levels as
rows, so that its node pairs go to different tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commuta.llm.batches import alone, bodies, carrying
from commuta.llm.bitmaps import bitmap, marked, order_key
from commuta.llm.components import components
from commuta.operators.lineage import written_table

BITS_APART = 2
#: First bit and length of each trie's first block.
BLOCKS = ((0, 22), (22, 21), (43, 21))
#: More fingerprints under one node pair than this are walked STEP levels further before they go to a task.
NODE_ROWS = 1 << 16
STEP = 4
#: Node pairs held at a time, node pairs of so few leaves that they are compared at once, and hashes counted at a time.
FRONTIER = 1 << 17
LEAVES = 16
HASHES = 1 << 16

_PARITY = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def ones(x: np.ndarray) -> np.ndarray:
    """Number of one bits of unsigned 64-bit integers."""
    return sum(_PARITY[((x >> np.uint64(s)) & np.uint64(0xFFFF)).astype(np.int64)].astype(np.int64) for s in (0, 16, 32, 48))


def shingles(text: str | None, size: int) -> list[bytes]:
    found = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space alone
    if size == 1 or not found:
        return found
    if len(found) < size:
        return [b" ".join(found)]
    if size == 3:
        return [b"%b %b %b" % g for g in zip(found, found[1:], found[2:])]
    return [b" ".join(g) for g in zip(*[found[k:] for k in range(size)])]


def fingerprint(text: str | None, size: int = 3) -> int:
    """Bit i is 1 if it is set in over half the shingles' XXH64; 0 without words."""
    digest, total, count = xxhash.xxh64_digest, np.zeros(64, np.int64), 0
    found = shingles(text, size)
    for k in range(0, len(found), HASHES):
        block = np.frombuffer(b"".join([digest(s, 42) for s in found[k : k + HASHES]]), np.uint8).reshape(-1, 8)
        total += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
        count += len(block)
    return int.from_bytes(np.packbits(total * 2 > count).tobytes(), "big")


def fingerprints(docs: DataFrame, carry: list[str], text: str = "text", size: int = 3) -> DataFrame:
    """``carried`` (a struct of ``carry``) and ``fingerprint`` (long, the 64 bits as a signed number) per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("simhash")
        for batch in batches:
            made = np.array([fingerprint(t, size) for t in bodies(batch, text).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"carried": batch["carried"], "fingerprint": pa.array(made)})

    rows = carrying(docs, carry, text)
    return rows.mapInArrow(run, rows.select("carried").schema.add("fingerprint", "long"))


class _Union:
    """Union-find over positions, many pairs at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if (up == x).all():
                return x
            x = up

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart])
            np.minimum.at(self.parent, a, b)


def _split(keys: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """Where the right child of each node [low, high) begins: its keys agree above ``bit`` and are sorted."""
    border = ((keys[low] >> np.uint64(bit)) | np.uint64(1)) << np.uint64(bit)
    low, high = low.copy(), high.copy()
    while (busy := low < high).any():
        middle = (low + high) >> 1
        right = busy & (keys[np.where(busy, middle, 0)] < border)
        low = np.where(right, middle + 1, low)
        high = np.where(busy & ~right, middle, high)
    return low


def trie_links(keys: np.ndarray, low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray, first_bit: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Walk tries over sorted ``keys``, from the given node pairs; return each key's representative (its position).

    A node is a range of keys; first_bit is the highest bit below its prefix, apart the differing bits so far. The
    representatives form a spanning forest of all links, so their number never passes that of the keys.
    """
    union = _Union(len(keys))
    todo = []
    for bit in np.unique(first_bit)[::-1].tolist():
        at = first_bit == bit
        todo.append((bit, np.stack([low[at], high[at], low2[at], high2[at], apart[at]])))
    while todo:
        bit, pairs = todo.pop()
        if pairs.shape[1] > FRONTIER:
            todo.append((bit, pairs[:, FRONTIER:]))
            pairs = pairs[:, :FRONTIER]
        a0, a1, b0, b1, d = pairs
        itself = (a0 == b0) & (a1 == b1)
        n, m = a1 - a0, b1 - b0
        few = (n * m <= LEAVES) | (bit < 0)
        if few.any():
            x0, y0, width, cells = a0[few], b0[few], m[few], (n * m)[few]
            pair = np.repeat(np.arange(len(cells)), cells)
            cell = np.arange(len(pair)) - np.repeat(np.cumsum(cells) - cells, cells)
            x, y = x0[pair] + cell // width[pair], y0[pair] + cell % width[pair]
            near = x != y
            x, y = x[near], y[near]
            near = ones(keys[x] ^ keys[y]) <= BITS_APART
            union.add(x[near], y[near])
        on = ~few & ~(itself & (n < 2))
        if not on.any():
            continue
        a0, a1, b0, b1, d, itself = a0[on], a1[on], b0[on], b1[on], d[on], itself[on]
        am = _split(keys, a0, a1, bit)
        bm = np.where(itself, am, 0)
        if not itself.all():
            bm[~itself] = _split(keys, b0[~itself], b1[~itself], bit)
        more = d < BITS_APART
        cross = more & ~itself
        below = np.concatenate([
            np.stack([a0, am, b0, bm, d]), np.stack([am, a1, bm, b1, d]),
            np.stack([a0, am, bm, b1, d + 1])[:, more], np.stack([am, a1, b0, bm, d + 1])[:, cross],
        ], axis=1)
        below = below[:, (below[0] < below[1]) & (below[2] < below[3])]
        for k in range(0, below.shape[1], FRONTIER):
            todo.append((bit - 1, below[:, k : k + FRONTIER]))
    return union.roots(np.arange(len(keys)))


_PAIR = ["trie", "depth", "a", "b", "apart"]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Link the fingerprints of node pairs; the rows of a pair come together, in the order of their keys."""
    def linked(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
        keys = columns["key"].view(np.uint64)
        names = np.stack([columns[c] for c in _PAIR])
        begin = np.flatnonzero(np.append(True, (names[:, 1:] != names[:, :-1]).any(axis=0)))
        end = np.append(begin[1:], len(keys))
        on = end - begin > 1
        begin, end = begin[on], end[on]
        trie, depth, a, b, apart = names[:, begin]
        # The rows under b come after those under a.
        cut = np.array([
            lo + np.searchsorted(keys[lo:hi], np.uint64(nb << (64 - w))) if na != nb else hi
            for lo, hi, na, nb, w in zip(begin.tolist(), end.tolist(), a.tolist(), b.tolist(), depth.tolist(), strict=True)
        ], np.int64) if (a != b).any() else end
        same = a == b
        root = trie_links(keys, begin, cut, np.where(same, begin, cut), np.where(same, cut, end), 63 - depth, apart)
        far = np.flatnonzero(root != np.arange(len(keys)))
        turn = np.array([s for s, _ in BLOCKS], np.uint64)[columns["trie"][far]]
        back = [((k >> turn) | (k << ((np.uint64(64) - turn) % np.uint64(64)))).view(np.int64) for k in (keys[far], keys[root[far]])]
        return pa.RecordBatch.from_pydict({"a": pa.array(back[0]), "b": pa.array(back[1])})

    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        new = {c: batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in [*_PAIR, "key"]}
        held = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in new}
        n = len(held["key"])
        if n == 0:
            continue
        differs = np.zeros(n, bool)
        for c in _PAIR:
            differs |= held[c] != held[c][-1]
        last = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0  # the last pair may go on in the next batch
        if last:
            yield linked({c: x[:last] for c, x in held.items()})
            held = {c: x[last:] for c, x in held.items()}
    if held is not None and len(held["key"]):
        yield linked(held)


def near_links(prints: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``fingerprint``) that connect all within reach.

    Of the pairs within two bits, a spanning forest per node pair is returned: at most three links a fingerprint.
    """
    turned = "(shiftleft(fingerprint, {0}) | shiftrightunsigned(fingerprint, 64 - {0}))"
    routes = F.array(*[
        F.expr(
            f"named_struct('trie', {k}, 'depth', {width}, 'key', {turned.format(first) if first else 'fingerprint'})"
        )
        for k, (first, width) in enumerate(BLOCKS)
    ])
    rows = prints.select(F.inline(routes)).withColumn("a", F.expr("shiftrightunsigned(key, 64 - depth)"))
    rows = rows.withColumn("b", F.col("a")).withColumn("apart", F.lit(0))
    ready: list[DataFrame] = []
    while True:
        large = written_table(rows.groupBy(*_PAIR).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > node_rows), "nodes")
        ready.append(rows.join(large.drop("rows"), _PAIR, "left_anti") if not large.isEmpty() else rows)
        if large.isEmpty():
            break
        # Walk STEP levels with the rows of the large node pairs: a row goes to each pair its node is in.
        heavy = rows.join(large.drop("rows"), _PAIR, "left_semi").withColumn("node", F.expr("shiftrightunsigned(key, 64 - depth)"))
        heavy = heavy.withColumn("own", F.expr(f"cast(shiftrightunsigned(shiftleft(key, depth), 64 - {STEP}) as int)"))
        heavy = heavy.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit((1 << STEP) - 1))))
        heavy = heavy.withColumn("apart2", F.expr("apart + bit_count(own ^ other)")).filter(F.col("apart2") <= BITS_APART)
        mine, theirs = f"node * {1 << STEP} + own", f"(a + b - node) * {1 << STEP} + other"
        rows = written_table(heavy.select(
            "trie", F.expr(f"depth + {STEP}").alias("depth"), "key",
            F.expr(f"least({mine}, {theirs})").alias("a"), F.expr(f"greatest({mine}, {theirs})").alias("b"),
            F.col("apart2").alias("apart"),
        ), "rows")
    links = []
    for part in ready:
        dealt = part.select(*_PAIR, "key", F.expr("key ^ (-9223372036854775807L - 1L)").alias("order"))
        dealt = dealt.repartition("trie", "a", "b").sortWithinPartitions(*_PAIR, "order")
        links.append(dealt.mapInArrow(_walk, "a long, b long"))
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found


def _classes(prints: DataFrame, links: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``fingerprint``, ``root`` of every distinct fingerprint: the smallest fingerprint its links reach."""
    distinct = prints.select("fingerprint").distinct()
    linked = written_table(components(links(distinct), "a", "b"), "roots")
    alone = distinct.join(linked, F.col("fingerprint") == F.col("node"), "left_anti")
    return linked.select(F.col("node").alias("fingerprint"), "root").unionByName(
        alone.select("fingerprint", F.col("fingerprint").alias("root"))
    )


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """Class of each document under near-duplicate links: ``doc_id``, ``fingerprint`` (long), ``component_id``.

    Documents whose fingerprints over ``size`` words differ in at most two bits are linked, and classes are what the
    links connect; ``component_id`` is the smallest id in the class. Fingerprints are made distinct before the join,
    so copies cost nothing there, and no link between different fingerprints is lost. Documents without words (null,
    empty) have fingerprint 0 and are linked like others. Null ids count as no id: a class of null ids alone has a
    null component. Repeated rows return repeated rows. Only ``id`` and ``text`` are read.
    """
    prints = written_table(fingerprints(docs, [id], text, size).select(F.col(f"carried.`{id}`").alias("doc_id"), "fingerprint"), "prints")
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    classes = _classes(prints, near_links).join(first, "fingerprint")
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    found = classes.join(least, "root").select("fingerprint", "component_id")
    return prints.join(found, "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3,
    prints_of: Callable[..., DataFrame] = fingerprints, links: Callable[[DataFrame], DataFrame] = near_links,
) -> DataFrame:
    """The rows of ``docs`` that stay, one for each class of near-duplicates: the one with the smallest id.

    ``prints_of`` and ``links`` make the fingerprints and link them: those of this module, or of ``jaccard``.
    Only rows that are to go, and the few that share a bit with them in a bitmap of bounded size, are shuffled. Rows
    are known by id and text; null ids come first, ties are broken by a hash of the text, and of rows repeated with
    both one stays. All columns are returned as they came.
    """
    body_key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    keyed = docs.select(F.struct("*").alias("doc"), F.col(id).alias("id"), body_key.alias("body_key"))
    rows = docs.select(F.col(id).alias("id"), body_key.alias("body_key"), F.col(text).alias("body"))
    prints = prints_of(rows, ["id", "body_key"], "body", size).select("carried.*", "fingerprint")
    prints = written_table(prints.groupBy("id", "body_key", "fingerprint").agg(F.count(F.lit(1)).alias("rows")), "prints")
    first = prints.groupBy("fingerprint").agg(F.min(F.struct("id", "body_key")).alias("first"))
    classes = _classes(prints, links).join(first, "fingerprint")
    stays = classes.groupBy("root").agg(F.min("first").alias("stays"))
    stays = classes.join(stays, "root").select("fingerprint", "stays")
    goes = F.struct("id", "body_key") != F.col("stays")
    listed = written_table(
        prints.join(stays, "fingerprint").filter(goes | (F.col("rows") > 1)).select("id", "body_key", goes.alias("goes")).distinct(), "goes"
    )
    rows = marked(keyed, ["id", "body_key"], bitmap(listed, ["id", "body_key"]))
    named = listed.select(F.col("id").alias("id2"), F.col("body_key").alias("body_key2"), "goes")
    same = F.col("id").eqNullSafe(F.col("id2")) & (F.col("body_key") == F.col("body_key2"))
    checked = rows.filter("open").join(named, same, "left").filter("goes is null or not goes")
    again = checked.filter("goes is not null").groupBy("id", "body_key").agg(F.max_by("doc", order_key(docs, "doc")).alias("doc"))
    return (
        rows.filter("not open").select("doc.*")
        .unionByName(checked.filter("goes is null").select("doc.*"))
        .unionByName(again.select("doc.*"))
    )
