"""Near-duplicates by SimHash tries and the exact Jaccard similarity of shingle sets, every link verified.

The tries of ``simhash`` propose pairs first, at most two bits apart. Texts of a similarity of 0.8 can differ in more bits, so
a prefix-filtered self-join is the exact way for what the verified ones among them leave apart:
sets of Jaccard similarity s >= 0.8 share at least 0.8 of the larger one, so in any one order of all shingles they share
one of the first n - ceil(0.8 n) + 1 of each: joining those finds every pair. The order is by the number of documents,
counted over all of them in a table of fixed size, so that a common passage is seldom joined on: shingles that share a slot
only come later than they might. At the first shingle that two such sets share, what is left of either holds all they share, so
pairs with less left are not formed. A candidate is a link only if the full sets of hashes say so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commuta.llm import simhash
from commuta.llm.batches import alone, bodies, bounded, carrying
from commuta.llm.bitmaps import bitmap, marked
from commuta.llm.components import components
from commuta.operators.lineage import written_table

#: The least similarity that links, as a fraction.
LEAST, OF = 4, 5
#: Bits of the table that counts the documents of shingles, and rows of it in one batch.
SLOT_BITS = 20
COUNT_ROWS = 1 << 15
#: While all pairs left are more than this many a row, rows are compared with a few of their shingle first.
PAIRS_A_ROW = 4
#: So many rows of a shingle are then drawn, and all others compared with them.
DRAWN = 4


def hashes(text: str | None, size: int) -> np.ndarray:
    """The distinct 64-bit shingle hashes in ascending order; none without words."""
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(s) for s in simhash.shingles(text, size)), np.uint64))


def slots(keys: np.ndarray) -> np.ndarray:
    """The place of each shingle hash in the table of counts."""
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def document_counts(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """How many documents hold a shingle of each slot, over all documents: a table of fixed size, whatever the corpus.

    Tasks add their documents up first, so a row for each slot and task is shuffled.
    """
    bounded(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("jaccard")
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for t in batch["body"].to_pylist():
                at, times = np.unique(slots(hashes(t, size)), return_counts=True)
                total[at] += times
        used = np.flatnonzero(total)
        for k in range(0, len(used), COUNT_ROWS):
            yield pa.RecordBatch.from_pydict({"slot": pa.array(used[k : k + COUNT_ROWS].astype(np.int32)), "n": pa.array(total[used[k : k + COUNT_ROWS]])})

    counted = docs.select(F.col(f"`{text}`").alias("body")).mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    table = counted.toArrow()  # at most a row for each slot
    out = np.zeros(1 << SLOT_BITS, np.int64)
    out[table["slot"].to_numpy()] = table["n"].to_numpy()
    return out


def identity(keys: np.ndarray) -> int:
    """A set's fingerprint: a hash of its hashes in ascending order."""
    return xxhash.xxh3_64_intdigest(keys.tobytes())


def prefix_size(n: int) -> int:
    """So many of the first shingles of a set of ``n``, in any one order, hold one that a set linked with it holds among as many."""
    return n * (OF - LEAST) // OF + 1


def shingle_sets(docs: DataFrame, carry: list[str], text: str, size: int, whole: bool = True) -> DataFrame:
    """``carried`` (a struct of ``carry``), ``fingerprint`` (long, of the whole set), ``bits``, ``n`` and ``keys`` per document.

    ``keys`` are the distinct shingle hashes, those first whose slot fewer documents have; ``bits`` the SimHash fingerprint.
    Unless ``whole``, only the prefix of ``keys`` is kept: ``whole_sets`` makes the full sets again where they are asked for.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(np.minimum(document_counts(docs, text, size), (1 << 32) - 1).astype(np.uint32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("jaccard")
        often = shipped.value
        for batch in batches:
            made, prints, bits, sizes = [], [], [], []
            for t in bodies(batch, text).to_pylist():
                keys = hashes(t, size)
                bits.append(simhash.fingerprint(t, size))
                prints.append(identity(keys))
                sizes.append(len(keys))
                ordered = keys[np.argsort(often[slots(keys)], kind="stable")]
                made.append(ordered if whole else ordered[: prefix_size(len(keys))])
            yield pa.RecordBatch.from_pydict({
                "carried": batch["carried"], "fingerprint": pa.array(np.array(prints, np.uint64).view(np.int64)),
                "bits": pa.array(np.array(bits, np.uint64).view(np.int64)), "n": pa.array(np.array(sizes, np.int32)), "keys": _lists(made),
            })

    rows = carrying(docs, carry, text)
    kept = rows.select("carried").schema.add("fingerprint", "long").add("bits", "long").add("n", "integer")
    return rows.mapInArrow(run, kept.add("keys", T.ArrayType(T.LongType())))


def _lists(made: list[np.ndarray]) -> pa.ListArray:
    edge = np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edge), pa.array(np.concatenate([*made, np.zeros(0, np.uint64)]).view(np.int64)))


def whole_sets(docs: DataFrame, text: str, size: int) -> DataFrame:
    """``fingerprint``, ``n`` and all ``keys`` of each document, in ascending order of their hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("jaccard")
        for batch in batches:
            made = [hashes(t, size) for t in batch["body"].to_pylist()]
            prints = np.array([identity(keys) for keys in made], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"fingerprint": pa.array(prints), "n": pa.array(np.array([len(m) for m in made], np.int32)), "keys": _lists(made)})

    return docs.select(F.col(f"`{text}`").alias("body")).mapInArrow(run, "fingerprint long, n integer, keys array<long>")


def proposed(sets: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` of fingerprints of ``sets`` that the SimHash tries link, as a forest, to be verified.

    Sets of the same ``bits`` are paired with the least of them, and these along the links of the tries: at most four pairs a set.
    """
    prints = written_table(sets.filter("n > 0").select("fingerprint", "bits").distinct(), "bits")
    first = prints.groupBy("bits").agg(F.min("fingerprint").alias("first"))
    same = prints.join(first, "bits").select(F.col("first").alias("a"), F.col("fingerprint").alias("b"))
    ends = [first.select(F.col("bits").alias(f"{c}_bits"), F.col("first").alias(c)) for c in "ab"]
    links = simhash.near_links(first.select(F.col("bits").alias("fingerprint"))).toDF("a_bits", "b_bits")
    near = links.join(ends[0], "a_bits").join(ends[1], "b_bits").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return same.unionByName(near).filter("a != b").distinct()


def _meeting(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with the sizes ``n_a`` and ``n_b`` and how many of the ``keys`` of both sides are ``shared``."""
    left, right = (sets.select(F.col("fingerprint").alias(c), F.col("n").cast("long").alias(f"n_{c}"), F.col("keys").alias(f"keys_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("keys_a", "keys_b")).cast("long").alias("shared"))


def verified(pairs: DataFrame, heads: DataFrame, whole: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The pairs ``a``, ``b`` of fingerprints whose sets have a Jaccard similarity of LEAST / OF or more.

    ``heads`` have the part of each prefix that other sets hold too. A shingle that both sets hold is shared by the prefixes
    or comes after the prefix that ends first, so most pairs are ruled out without the full sets. ``whole`` gives the full sets
    (``fingerprint``, ``n``, ``keys``) of the fingerprints asked for, and may give others too.
    """
    most = f"(shared + greatest(n_a, n_b) - greatest(n_a, n_b) * {OF - LEAST}L div {OF} - 1)"
    enough = f"* {LEAST + OF}L >= (n_a + n_b) * {LEAST}L"
    likely = written_table(_meeting(pairs, heads).filter(f"{most} {enough}").select("a", "b"), "likely")
    asked = written_table(likely.select(F.explode(F.array("a", "b")).alias("fingerprint")).distinct(), "asked")
    some = whole(asked).join(asked, "fingerprint", "left_semi").dropDuplicates(["fingerprint"])
    return _meeting(likely, some).filter(f"shared {enough}").select("a", "b")


def _apart(a: str, b: str) -> str:
    """Rows of classes apart that can be linked if the shingle is the first one they share: by their sizes and what is left of them."""
    rest = f"{LEAST + OF}L * least({a}.n - {a}.place, {b}.n - {b}.place) >= {LEAST}L * ({a}.n + {b}.n)"
    return f"{a}.root != {b}.root and {OF}L * least({a}.n, {b}.n) >= {LEAST}L * greatest({a}.n, {b}.n) and {rest}"


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("x.fingerprint", "y.fingerprint").alias("a"), F.greatest("x.fingerprint", "y.fingerprint").alias("b")).distinct()


def near_links(sets: DataFrame, whole: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Links ``a``, ``b`` between fingerprints of ``sets`` that connect all pairs of similarity LEAST / OF or more.

    ``whole`` gives the full sets of fingerprints (see ``verified``) where ``sets`` have the prefixes of their ``keys`` alone.

    The pairs that the SimHash tries propose are verified first. The rest meet by rows, a shingle of a set's prefix each: where many sets share one they are compared with a few drawn rows first, and
    again with others as long as that halves the pairs left; only pairs of rows still in classes apart are then compared, all of
    them, in a join that adaptive execution can split. No node or group is held whole by one worker.
    """
    if whole is None:
        def whole(asked: DataFrame) -> DataFrame:
            return marked(sets.select("fingerprint", "n", "keys"), ["fingerprint"], bitmap(asked, ["fingerprint"])).filter("open").drop("open")

    prefix = F.expr(f"slice(keys, 1, cast(n * {OF - LEAST}L div {OF} as int) + 1)")
    rows = sets.filter("n > 0").select("fingerprint", "n", F.posexplode(prefix).alias("place", "key"))
    # Rows are counted and not sets: a shingle that only documents of one set hold is of one class, and done at once.
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("key")
    shared = written_table(shared, "shared")
    rows = marked(rows, ["key"], bitmap(shared, ["key"])).filter("open").select("key", "fingerprint", "n", "place")
    rows = written_table(rows.join(shared, "key", "left_semi").distinct(), "members")
    heads = written_table(rows.groupBy("fingerprint").agg(F.first("n").alias("n"), F.collect_list("key").alias("keys")), "heads")
    compared = written_table(proposed(sets), "pairs")
    found = written_table(verified(compared, heads, whole), "links")
    before, turn = None, 0
    while True:
        classes = written_table(components(found, "a", "b"), "roots")
        left = rows.join(classes, F.col("fingerprint") == F.col("node"), "left").select(
            "key", "fingerprint", "n", "place", F.coalesce("root", "fingerprint").alias("root")
        )
        # A shingle is done when its rows are of one class; the rows of its largest class need no comparing with one another.
        sizes = left.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
        sizes = sizes.groupBy("key").agg(F.max(F.struct("size", "root")).alias("main"), F.sum("size").alias("all"))
        sizes = written_table(sizes.filter("main.size < all").select("key", F.col("main.root").alias("main"), F.expr("all - main.size").alias("rest"), "all"), "open")
        state = sizes.agg(F.sum(F.col("rest") * F.col("all")), F.sum("all")).first()
        if not state[0]:
            return found
        left = written_table(left.join(sizes.select("key", "main", "rest"), "key"), "open")
        others = left.filter("root != main")
        last = state[0] <= PAIRS_A_ROW * state[1] or (before is not None and 2 * state[0] > before)
        if not last:
            order = Window.partitionBy("key").orderBy(F.xxhash64("fingerprint", F.lit(turn)), "fingerprint")
            others = others.withColumn("draw", F.row_number().over(order)).filter(F.col("draw") <= DRAWN)
        joined = others.alias("x").join(left.alias("y"), (F.col("x.key") == F.col("y.key")) & F.expr(_apart("x", "y")))
        pairs = written_table(_pairs(joined).join(compared, ["a", "b"], "left_anti"), "pairs")
        found = written_table(found.unionByName(verified(pairs, heads, whole)), "links")
        if last:
            return found
        compared = compared.unionByName(pairs)
        # A shingle is also done when all its rows outside the largest class were drawn.
        rows = left.filter(F.col("rest") > DRAWN).select("key", "fingerprint", "n", "place")
        before, turn = state[0], turn + 1


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay, one for each class of near-duplicates: the one with the smallest id.

    Classes are what links connect, and texts are linked if their sets of ``size``-word shingles have a Jaccard
    similarity of LEAST / OF or more, whether SimHash tries or shared shingles propose them; texts without words are linked with one another alone. The rest is as in ``simhash``.
    """
    made: list[DataFrame] = []
    read: list[tuple[DataFrame, list[str], str]] = []

    def prints_of(rows: DataFrame, carry: list[str], body: str, words: int) -> DataFrame:
        read.append((rows, carry, body))
        made.append(written_table(shingle_sets(rows, carry, body, words, whole=False), "sets"))
        return made[0]

    def whole(asked: DataFrame) -> DataFrame:
        """Full sets are some times the size of a text and few are asked for, so they are made again and not kept."""
        rows, carry, body = read[0]
        named = made[0].join(asked, "fingerprint", "left_semi").select("carried.*")
        return whole_sets(marked(rows, carry, bitmap(named, carry)).filter("open"), body, size)

    return simhash.drop_near_duplicates(docs, id, text, size, prints_of, lambda prints: near_links(made[0].drop("carried"), whole))
