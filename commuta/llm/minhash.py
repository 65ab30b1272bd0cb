"""MinHash near-duplicates by circulant signatures, banding, and exact Jaccard similarity.

All coordinates of a signature come from two permutations of the numbers of 32 bits: the first scatters the shingles, the
second is shifted circularly by one place for each coordinate, and a coordinate is the least value over a set. Sets that
agree on all ROWS coordinates of a band share a bucket. The number of bands follows from MISS, the probability with which
a pair at the threshold is in no bucket together. Buckets only propose pairs: a link is what the full sets confirm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commuta.llm.batches import alone, bodies, carrying
from commuta.llm.bitmaps import bitmap, marked
from commuta.llm.components import components
from commuta.operators.lineage import written_table

#: The least similarity that links, in hundredths.
LEAST = 80
#: Coordinates of a band, and the probability that a pair at the threshold is missed.
ROWS = 6
MISS = 1e-6
#: Shingles whose coordinates are worked out at a time.
BLOCK = 1 << 15
#: Buckets of more sets than LARGE are compared by blocks of full sets: so many sets and shingles in a block, about.
LARGE = 64
SIDE = 256
SIDE_SHINGLES = 1 << 19
#: Shared shingles that are counted at a time in a pair of blocks.
COLUMNS = 1 << 12
#: While buckets hold more than so many pairs of sets of different classes for each set, they meet one of their sets first.
CELLS_A_ROW = 8
#: Standard deviations by which the coordinates that agree may fall short of those expected at the threshold.
SHORT = 5.0


def band_count(least: int = LEAST, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that let a pair at the threshold slip with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log1p(-((least / 100) ** rows)))


def agreement(least: int, coordinates: int) -> int:
    """Bytes of two sketches that must agree: SHORT deviations below what the threshold lets expect."""
    p = least / 100 + (1 - least / 100) / 256
    return math.floor(coordinates * p - SHORT * math.sqrt(coordinates * p * (1 - p)))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct 64-bit hashes of the ``size``-word shingles in ascending order; of all words if there are fewer; none without words."""
    found = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space alone
    if not found:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    if len(found) < size:
        return np.array([digest(b" ".join(found))], np.uint64)
    distinct = set(zip(*[found[k:] for k in range(size)], strict=False))
    return np.unique(np.fromiter(map(digest, map(b" ".join, distinct)), np.uint64, len(distinct)))


def _scattered(keys: np.ndarray) -> np.ndarray:
    """The first permutation, of 64-bit hashes folded to 32 bits."""
    x = (keys ^ (keys >> np.uint64(32))).astype(np.uint32)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    return x ^ (x >> np.uint32(16))


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Signatures of sets that are not empty, a row each: coordinate k is the least of the second permutation, shifted by k places."""
    out = np.empty((len(sets), coordinates), np.uint32)
    begin = 0
    while begin < len(sets):
        end, held = begin + 1, len(sets[begin])
        while end < len(sets) and held + len(sets[end]) <= BLOCK:
            held += len(sets[end])
            end += 1
        x = _scattered(np.concatenate(sets[begin:end]))
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[begin : end - 1]])]).astype(np.int64) if end - begin > 1 else np.zeros(1, np.int64)
        t, u = np.empty_like(x), np.empty_like(x)
        for k in range(coordinates):
            np.add(x, np.uint32(k), out=t)
            np.multiply(t, np.uint32(0x9E3779B1), out=t)
            np.right_shift(t, np.uint32(15), out=u)
            np.bitwise_xor(t, u, out=t)
            np.multiply(t, np.uint32(0x85EBCA77), out=t)
            np.right_shift(t, np.uint32(13), out=u)
            np.bitwise_xor(t, u, out=t)
            np.multiply(t, np.uint32(0xC2B2AE3D), out=t)
            out[begin:end, k] = np.minimum.reduceat(t, starts)
        begin = end
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature; the number of the band is part of the key."""
    bands = signature.reshape(len(signature), -1, rows)
    keys = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), bands.shape[:2]).copy()
    for k in range(rows):
        keys ^= bands[:, :, k]
        keys *= np.uint64(0xFF51AFD7ED558CCD)
        keys ^= keys >> np.uint64(32)
        keys *= np.uint64(0xC4CEB9FE1A85EC53)
        keys ^= keys >> np.uint64(29)
    return keys


def sketches(docs: DataFrame, carry: list[str], text: str, size: int, rows: int, bands: int) -> DataFrame:
    """``carried`` (a struct of ``carry``), ``node`` (hash of the whole set), ``n`` (its size), ``bands`` and ``sketch`` (a byte a coordinate)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("minhash")
        for batch in batches:
            sets = [shingle_set(t, size) for t in bodies(batch, text).to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(sizes)
            keys, bytes_ = np.zeros((0, bands), np.uint64), np.zeros((0, rows * bands), np.uint8)
            if len(some):
                made = signatures([sets[k] for k in some], rows * bands)
                keys, bytes_ = band_keys(made, rows), (made >> np.uint32(8)).astype(np.uint8)
            edges = np.concatenate([[0], np.cumsum(sizes > 0)])
            raw = pa.py_buffer(np.ascontiguousarray(bytes_).tobytes())
            yield pa.RecordBatch.from_pydict({
                "carried": batch["carried"],
                "node": pa.array(np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)),
                "n": pa.array(sizes),
                "bands": pa.ListArray.from_arrays(pa.array((edges * bands).astype(np.int32)), pa.array(keys.view(np.int64).ravel())),
                "sketch": pa.Array.from_buffers(pa.binary(), len(sets), [None, pa.py_buffer((edges * rows * bands).astype(np.int32).tobytes()), raw]),
            })

    found = carrying(docs, carry, text)
    schema = found.select("carried").schema.add("node", "long").add("n", "long").add("bands", T.ArrayType(T.LongType())).add("sketch", "binary")
    return found.mapInArrow(run, schema)


def _alike(least: int, coordinates: int):
    """Keeps the pairs of sketches ``sketch_a`` and ``sketch_b`` that agree on enough bytes."""
    enough = agreement(least, coordinates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, coordinates) for c in ("sketch_a", "sketch_b"))
            yield batch.select(["a", "b"]).filter(pa.array((left == right).sum(axis=1) >= enough))

    return run


class _Search:
    """Links between the distinct sets of a table of sketches."""

    def __init__(self, docs: DataFrame, text: str, size: int, least: int, sketched: DataFrame, coordinates: int):
        self.docs, self.text, self.size, self.least, self.sketched, self.coordinates = docs, text, size, least, sketched, coordinates

    def _of(self, asked: DataFrame, columns: list[str]) -> DataFrame:
        """One row of the sketches for each node of ``asked``."""
        some = marked(self.sketched.select("node", *columns), ["node"], bitmap(asked, ["node"])).filter("open").drop("open")
        return some.join(asked, "node", "left_semi").dropDuplicates(["node"])

    def _sets(self, asked: DataFrame) -> DataFrame:
        """``node`` and ``keys``, the full set, for each node of ``asked``: made again from the texts, of which few are asked for."""
        wanted = written_table(self._of(asked, ["body_key"]).select("body_key"), "wanted")
        rows = self.docs.select(F.col(f"`{self.text}`").alias("body")).withColumn("body_key", F.xxhash64(F.coalesce("body", F.lit(""))))
        rows = marked(rows, ["body_key"], bitmap(wanted, ["body_key"])).filter("open").join(wanted, "body_key", "left_semi")
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = [shingle_set(t, size) for t in batch["body"].to_pylist()]
                nodes = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_pydict({"node": pa.array(nodes), "keys": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))})

        made = rows.dropDuplicates(["body_key"]).select("body").mapInArrow(run, "node long, keys array<long>")
        return written_table(made.dropDuplicates(["node"]), "sets")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a``, ``b`` whose full sets have the similarity that links."""
        asked = written_table(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "asked")
        sketch = written_table(self._of(asked, ["sketch"]), "sketch")
        left, right = (sketch.select(F.col("node").alias(c), F.col("sketch").alias(f"sketch_{c}")) for c in "ab")
        likely = pairs.join(left, "a").join(right, "b").select("a", "b", "sketch_a", "sketch_b")
        likely = written_table(likely.mapInArrow(_alike(self.least, self.coordinates), "a long, b long"), "likely")
        asked = written_table(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "asked")
        sets = self._sets(asked)
        left, right = (sets.select(F.col("node").alias(c), F.col("keys").alias(f"keys_{c}")) for c in "ab")
        both = likely.join(left, "a").join(right, "b")
        met = both.select("a", "b", F.size(F.array_intersect("keys_a", "keys_b")).alias("both"), (F.size("keys_a") + F.size("keys_b")).alias("all"))
        return met.filter(f"100L * both >= {self.least}L * (all - both)").select("a", "b")

    def _in_buckets(self, rows: DataFrame) -> DataFrame:
        """The pairs of ``rows`` (``key``, ``node``, ``n``, ``root``, ``group``) of one key that are alike, but for those of one class or group.

        A key has at most LARGE rows, which a task holds at a time.
        """
        asked = written_table(rows.select("node").distinct(), "asked")
        rows = rows.join(self._of(asked, ["sketch"]), "node").select("key", "node", "n", "root", "group", "sketch")
        least, enough, coordinates = self.least, agreement(self.least, self.coordinates), self.coordinates

        def pairs_of(held: list[dict]) -> Iterator[pa.RecordBatch]:
            node, n, root, group = (np.array([h[c] for h in held], np.int64) for c in ("node", "n", "root", "group"))
            sketch = np.frombuffer(b"".join(h["sketch"] for h in held), np.uint8).reshape(-1, coordinates)
            for k in range(len(held) - 1):
                m = n[k + 1 :]
                near = (100 * np.minimum(m, n[k]) >= least * np.maximum(m, n[k])) & (root[k + 1 :] != root[k]) & (group[k + 1 :] != group[k])
                at = np.flatnonzero(near) + k + 1
                at = at[(sketch[at] == sketch[k]).sum(axis=1) >= enough]
                if len(at):
                    yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(node[at], node[k])), "b": pa.array(np.maximum(node[at], node[k]))})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[dict] = []
            for batch in batches:
                for row in batch.to_pylist():
                    if held and row["key"] != held[0]["key"]:
                        yield from pairs_of(held)
                        held = []
                    held.append(row)
            if held:
                yield from pairs_of(held)

        return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").distinct()

    def _in_groups(self, rows: DataFrame) -> DataFrame:
        """Links between ``rows`` (``node``, ``n``, ``root``, ``group``) of one group but classes apart, by full sets: a forest for each task.

        A row goes to the pairs of blocks that its own block is in, and a task holds one pair of blocks at a time: of about
        SIDE sets or SIDE_SHINGLES shingles each. The largest class of a group has blocks of its own, which meet those of the
        others only. However alike the sets of a group are, no pair leaves a task that is no link.
        """
        needed = f"cast(ceil(greatest(sum(rows) / {SIDE}, sum(size) / {SIDE_SHINGLES})) as int)"
        classes = rows.groupBy("group", "root").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("size"))
        main = classes.groupBy("group").agg(F.max(F.struct("rows", "root"))["root"].alias("main"))
        halves = classes.join(main, "group").groupBy("group", "main", (F.col("root") == F.col("main")).alias("in_main")).agg(F.expr(needed).alias("blocks"))
        counts = halves.groupBy("group", "main").agg(*[
            F.coalesce(F.max(F.when(side, F.col("blocks"))), F.lit(0)).alias(name) for name, side in (("mains", F.col("in_main")), ("others", ~F.col("in_main")))
        ]).filter("others > 0")
        sets = self._sets(written_table(rows.select("node").distinct(), "asked"))
        dealt = rows.join(counts, "group")
        place = "cast(pmod(xxhash64(node, 11), {0}) as int)"
        dealt = dealt.withColumn("own", F.expr(f"if(root = main, others + {place.format('mains')}, {place.format('others')})"))
        dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, if(root = main, others, others + mains) - 1)")))
        dealt = dealt.select("group", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "root")
        dealt = dealt.join(sets, "node").repartition("group", "low", "high").sortWithinPartitions("group", "low", "high")
        least = self.least

        def linked(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            node, root, own = (np.concatenate([h[c].to_numpy() for h in held]) for c in ("node", "root", "own"))
            sizes = np.concatenate([pc.list_value_length(h["keys"]).to_numpy() for h in held]).astype(np.int64)
            keys = np.concatenate([h["keys"].flatten().to_numpy() for h in held])
            # Shared shingles of all pairs: products of the tables of who has which, for those that several sets have.
            _, column, times = np.unique(keys, return_inverse=True, return_counts=True)
            owner = np.repeat(np.arange(len(node)), sizes)
            several = times[column] > 1
            number = np.cumsum(times > 1) - 1
            column, owner = number[column[several]], owner[several]
            order = np.argsort(column, kind="stable")
            column, owner = column[order], owner[order]
            shared = np.zeros((len(node), len(node)), np.float32)
            for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
                lo, hi = np.searchsorted(column, [begin, begin + COLUMNS])
                table = np.zeros((len(node), COLUMNS), np.float32)
                table[owner[lo:hi], column[lo:hi] - begin] = 1
                shared += table @ table.T
            both = shared.astype(np.int64)
            wanted = (100 * both >= least * (sizes[:, None] + sizes[None, :] - both)) & (root[:, None] != root[None, :])
            if held[0]["low"][0].as_py() != held[0]["high"][0].as_py():
                wanted &= own[:, None] != own[None, :]
            parent = {r: r for r in root.tolist()}
            links = []
            for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(wanted, 1))), strict=True):
                a, b = int(root[i]), int(root[j])
                while parent[a] != a:
                    a = parent[a]
                while parent[b] != b:
                    b = parent[b]
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    links.append((int(node[i]), int(node[j])))
            return pa.RecordBatch.from_pydict({"a": pa.array([min(x) for x in links], pa.int64()), "b": pa.array([max(x) for x in links], pa.int64())})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            last: tuple | None = None
            for batch in batches:
                names = np.stack([batch[c].to_numpy() for c in ("group", "low", "high")]) if batch.num_rows else np.zeros((3, 0), np.int64)
                cuts = (np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1).tolist()
                for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                    if begin == end:
                        continue
                    if held and tuple(names[:, begin].tolist()) != last:
                        yield linked(held)
                        held = []
                    last = tuple(names[:, begin].tolist())
                    held.append(batch.slice(begin, end - begin))
            if held:
                yield linked(held)

        return dealt.select("group", "low", "high", "own", "node", "root", "keys").mapInArrow(run, "a long, b long")

    def _rest(self, left: DataFrame, sizes: DataFrame) -> DataFrame:
        """Links between sets of different classes in the open buckets ``left`` (``key``, ``node``, ``n``, ``root``).

        Sets that share a large bucket, or large buckets with others that do, are a group and compared all with all. Pairs of
        small buckets are proposed by their sketches, unless their group has them already.
        """
        large = written_table(sizes.filter(F.col("all") > LARGE).select("key"), "large")
        crowd = left.join(large, "key", "left_semi")
        spokes = crowd.join(crowd.groupBy("key").agg(F.min("node").alias("low")), "key").select("node", "low")
        hubs = components(spokes, "node", "low").select("node", F.col("root").alias("hub"))
        members = crowd.select("node", "n", "root").distinct().join(hubs, "node", "left")
        members = written_table(members.select("node", "n", "root", F.coalesce("hub", "node").alias("group")), "groups")
        found = written_table(self._in_groups(members), "links")
        few = left.join(large, "key", "left_anti").join(members.select("node", "group"), "node", "left")
        few = few.select("key", "node", "n", "root", F.coalesce("group", F.col("node")).alias("group"))
        return found.unionByName(self.verified(written_table(self._in_buckets(few), "pairs")))

    def links(self) -> DataFrame:
        """Pairs ``a``, ``b`` of nodes that connect all pairs of the similarity that links and share a bucket.

        While that leaves a quarter, each bucket meets one of its sets, another one each time; sets found alike become one
        class, and a bucket of one class is done. What stays together in a bucket without being of one class is compared
        in ``_rest``, all of it.
        """
        rows = self.sketched.filter("n > 0").select("node", "n", F.explode("bands").alias("key"))
        several = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low != high").select("key")
        rows = rows.join(written_table(several, "several"), "key", "left_semi")
        owned = written_table(rows.groupBy("node").agg(F.first("n").alias("n"), F.collect_set("key").alias("keys")), "buckets")
        found = written_table(self.sketched.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b")), "links")
        classes, before, turn = None, None, 0
        while True:
            # Classes are of sets: each set finds its own once, whatever the number of its buckets.
            if classes is None:
                rooted = owned.withColumn("root", F.col("node"))
            else:
                rooted = owned.join(classes.withColumnRenamed("root", "_root"), "node", "left").withColumn("root", F.coalesce("_root", "node"))
            left = rooted.select(F.explode("keys").alias("key"), "node", "n", "root")
            sizes = left.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
            sizes = sizes.groupBy("key").agg(F.sum("size").alias("all"), F.sum(F.col("size") * F.col("size")).alias("same"))
            sizes = written_table(sizes.filter("same < all * all").select("key", "all", F.expr("all * all - same").alias("cells")), "open")
            cells, members = sizes.agg(F.sum("cells"), F.sum("all")).first()
            if not cells:
                return found
            left = written_table(left.join(sizes.select("key"), "key"), "open")
            if cells <= CELLS_A_ROW * members or (before is not None and 4 * cells > before):
                return written_table(found.unionByName(self._rest(left, sizes)), "links")
            drawn = F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "n", "root")).alias("one")
            met = left.join(left.groupBy("key").agg(drawn), "key").filter("root != one.root")
            met = met.filter(f"100L * least(n, one.n) >= {self.least}L * greatest(n, one.n)")
            pairs = met.select(F.least("node", "one.node").alias("a"), F.greatest("node", "one.node").alias("b")).distinct()
            found = written_table(found.unionByName(self.verified(written_table(pairs, "pairs"))), "links")
            classes = written_table(components(found, "a", "b").select("node", "root"), "roots")
            before, turn = cells, turn + 1


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 2, least: int = LEAST, rows: int = ROWS, miss: float = MISS
) -> DataFrame:
    """Class of each document: ``doc_id``, ``n_shingles`` (long), ``component_id`` (the smallest id of its class), ``kept``.

    Documents are linked if the intersection of their sets of ``size``-word shingles is at least ``least`` hundredths of the
    union, and classes are what links connect. Words are runs of anything but ASCII white space, A-Z lower-cased; a text of
    fewer words than ``size`` has them all as one shingle. Documents without words (null, empty) have a set of size 0 and are a
    class each. Ids that are null count as no id: a class of null ids alone has a null component. ``kept`` is true where the id
    is the component. Repeated rows return repeated rows; an empty table gives an empty result. Only ``id`` and ``text`` are
    read. Sets are told apart by 64-bit hashes. A linked pair is missed, unless others connect it, with a probability of about ``miss`` at most.
    """
    bands = band_count(least, rows, miss)
    body = docs.select(F.col(f"`{id}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("body_key"), F.col(f"`{text}`").alias("body"))
    made = sketches(body, ["id", "body_key"], "body", size, rows, bands)
    sketched = written_table(made.select("carried.id", "carried.body_key", "node", "n", "bands", "sketch"), "sketches")
    links = _Search(docs, text, size, least, sketched, rows * bands).links()
    classes = written_table(components(links, "a", "b"), "roots")
    prints = sketched.select(F.col("id").alias("doc_id"), "n", "node")
    first = prints.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    rooted = first.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least_ids = rooted.groupBy("root").agg(F.min("first").alias("least"))
    found = written_table(rooted.join(least_ids, "root").select("node", "least"), "classes")
    joined = prints.join(found, "node", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
