"""Benchmark decontamination with suffix arrays over the training documents.

Each task builds suffix arrays over blocks of its documents (word ids, documents set apart by 0) and binary-searches
every suffix of the test items in them. Suffixes that begin with four words no test window begins with cannot match
and are left out before sorting. No text is shuffled; test items travel in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commuta.llm.batches import alone, bodies, carrying
from commuta.operators.lineage import written_table

WINDOW = 13
#: Bytes of test items searched in one pass; more items mean more passes.
ITEM_BLOCK_BYTES = 4 << 20
#: Bytes of documents in one suffix array; a longer document has one of its own.
SHARD_BYTES = 4 << 20
#: Bits of the table of first words, and pairs of places formed at a time.
FIRST_BITS = 20
PAIRS = 1 << 19

MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("doc_word", T.IntegerType()),
    T.StructField("item_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
]))
# A word is a run of 0-9, a-z (after lower-casing A-Z) and any character past ASCII.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


class TestItems:
    """The windows of a block of test items as sorted word keys, and where each window occurs."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.ids = [name for name, _ in items]
        places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        sequence, base = [0], []  # the items' words, a 0 before and after each item
        for at, (_, text) in enumerate(items):
            item = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            base.append(len(sequence))
            sequence += [*item, 0]
            for start in range(max(1, len(item) - window + 1) if item else 0):
                places.setdefault(tuple(item[start : start + window]), []).append((at, start))
        self.sequence, self.base = np.array(sequence, np.int64), np.array(base, np.int64)
        self.bits = 16 if len(self.vocabulary) < 1 << 16 else 32
        self.per_key = 64 // self.bits
        self.n_keys = -(-window // self.per_key)
        self.window = window
        ordered = sorted(places)
        self.length = np.array([len(w) for w in ordered], np.int64)
        padded = np.zeros((len(ordered), self.n_keys * self.per_key), np.uint64)
        for row, w in enumerate(ordered):
            padded[row, : len(w)] = w
        self.low = self.packed(padded)
        padded[np.arange(padded.shape[1])[None, :] >= self.length[:, None]] = (1 << self.bits) - 1
        self.high = self.packed(padded)
        counts = np.array([len(places[w]) for w in ordered], np.int64)
        self.place_from = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.places = np.array([p for w in ordered for p in places[w]], np.int64).reshape(-1, 2)
        # First words of the windows: for windows of fewer words than a key holds, of that many words.
        self.first = []
        for n in sorted({min(int(x), self.per_key) for x in self.length}):
            mask = np.uint64(((1 << (n * self.bits)) - 1) << (64 - n * self.bits))
            table = np.zeros(1 << FIRST_BITS, bool)
            table[self.slot(self.low[np.minimum(self.length, self.per_key) == n, 0] & mask)] = True
            self.first.append((mask, table))

    def packed(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros((len(ids), self.n_keys), np.uint64)
        for k in range(ids.shape[1]):
            out[:, k // self.per_key] |= ids[:, k] << np.uint64(64 - self.bits * (k % self.per_key + 1))
        return out

    @staticmethod
    def slot(key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FIRST_BITS)).astype(np.int64)


class SuffixArray:
    """Suffixes of a shard of documents in the order of their words, as far as windows reach."""

    def __init__(self, sequence: np.ndarray, items: TestItems):
        n, reach = len(sequence), items.n_keys * items.per_key
        wide = np.concatenate([sequence, np.zeros(reach, np.int64)]).astype(np.uint64)
        first = np.zeros(n, np.uint64)
        for k in range(items.per_key):
            first |= wide[k : k + n] << np.uint64(64 - items.bits * (k + 1))
        starts = np.zeros(n, bool)
        for mask, table in items.first:
            starts |= table[items.slot(first & mask)]
        at = np.flatnonzero(starts & (sequence > 0))
        keys = items.packed(wide[at[:, None] + np.arange(reach)[None, :]])
        order = np.lexsort(keys.T[::-1])
        self.position, self.keys = at[order], keys[order]

    @staticmethod
    def _first_at_least(column: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, past: bool) -> np.ndarray:
        """In each range [low, high) of a column sorted there: the first place >= wanted, or > wanted if ``past``."""
        low, high = low.copy(), high.copy()
        while (busy := low < high).any():
            middle = (low + high) >> 1
            seen = column[np.where(busy, middle, 0)]
            right = busy & ((seen <= wanted) if past else (seen < wanted))
            low = np.where(right, middle + 1, low)
            high = np.where(busy & ~right, middle, high)
        return low

    def search(self, items: TestItems) -> tuple[np.ndarray, np.ndarray]:
        """Binary search of every test window: (window, place in the sequence) of all occurrences."""
        low = np.zeros(len(items.length), np.int64)
        high = np.full(len(items.length), len(self.position), np.int64)
        if len(self.position):
            for k in range(items.n_keys):
                column = self.keys[:, k]
                after = self._first_at_least(column, low, high, items.high[:, k], True)
                low = self._first_at_least(column, low, high, items.low[:, k], False)
                high = np.maximum(low, after)
        found = high - low
        window = np.repeat(np.arange(len(found)), found)
        inside = np.arange(len(window)) - np.repeat(np.cumsum(found) - found, found)
        return window, self.position[low[window] + inside] if len(window) else np.zeros(0, np.int64)


def _longest(sequence: np.ndarray, window: np.ndarray, position: np.ndarray, items: TestItems) -> tuple[np.ndarray, ...]:
    """Maximal matches: place in the sequence, item, word of the item and length, from the windows found at positions.

    Windows that follow one another in both texts are one match. It begins at a window before which the two texts differ
    and ends at one after which they do, so of all pairs of places, formed PAIRS at a time, only those two are kept.
    """
    times = items.place_from[window + 1] - items.place_from[window]
    reached = np.cumsum(times)
    begins: list[np.ndarray] = []
    ends: list[np.ndarray] = []
    at = 0
    while at < len(window):
        to = max(at + 1, int(np.searchsorted(reached, (reached[at - 1] if at else 0) + PAIRS, "right")))
        which = np.repeat(np.arange(at, to), times[at:to])
        inside = np.arange(len(which)) - np.repeat(np.cumsum(times[at:to]) - times[at:to], times[at:to])
        item, item_word = items.places[items.place_from[window[which]] + inside].T
        place, length = position[which], items.length[window[which]]
        there = items.base[item] + item_word
        before, after = sequence[place - 1], sequence[place + length]
        first = (before == 0) | (before != items.sequence[there - 1])
        last = (after == 0) | (after != items.sequence[there + length])
        begins.append(np.stack([item[first], (place - item_word)[first], place[first], item_word[first]]))
        ends.append(np.stack([item[last], (place - item_word)[last], (place + length)[last]]))
        at = to
    begun, ended = np.concatenate(begins, axis=1), np.concatenate(ends, axis=1)
    begun, ended = begun[:, np.lexsort(begun[2::-1])], ended[:, np.lexsort(ended[2::-1])]
    return begun[2], begun[0], begun[3], ended[2] - begun[2]


def _matches(texts: list[str | None], items: TestItems) -> tuple[list[int], list[list[dict]]]:
    """Words of each document, and its maximal verbatim matches with the items."""
    known, sequence, begin = items.vocabulary, [], [0]
    for text in texts:
        sequence += [known.get(w, 0) for w in words(text)]
        sequence.append(0)
        begin.append(len(sequence))
    starts = np.array(begin, np.int64)
    found: list[list[dict]] = [[] for _ in texts]
    sequence = np.array(sequence, np.int64)
    window, position = SuffixArray(sequence, items).search(items)
    if len(window):
        position, item, item_word, length = _longest(sequence, window, position, items)
        doc = np.searchsorted(starts, position, "right") - 1
        rows = zip(doc.tolist(), item.tolist(), (position - starts[doc]).tolist(), item_word.tolist(), length.tolist(), strict=True)
        for d, i, at, at_item, n in rows:
            found[d].append({"item_id": items.ids[i], "doc_word": at, "item_word": at_item, "n_words": n})
    return (np.diff(starts) - 1).tolist(), found


def covered(matches: list[dict]) -> int:
    """Words inside at least one match."""
    total, reached = 0, 0
    for at, end in sorted((m["doc_word"], m["doc_word"] + m["n_words"]) for m in matches):
        total += max(0, end - max(at, reached))
        reached = max(reached, end)
    return total


def _shards(texts: list[str | None]) -> Iterator[slice]:
    begin, size = 0, 0
    for at, text in enumerate(texts):
        if at > begin and size + len(text or "") > SHARD_BYTES:
            yield slice(begin, at)
            begin, size = at, 0
        size += len(text or "")
    if begin < len(texts):
        yield slice(begin, len(texts))


def _search_step(docs: DataFrame, shipped, text: str, keep_text: bool) -> DataFrame:
    """Add the matches with one block of test items to ``matches``, and recount ``n_hit``."""
    schema = T.StructType([f for f in docs.schema.fields if f.name not in ("body", "matches")])
    keep_text = keep_text and "body" in docs.columns
    if keep_text:
        schema.add("body", T.StringType())
    schema.add("n_words", T.LongType()).add("n_hit", T.LongType()).add("matches", MATCHES)
    arrow = pa.list_(pa.struct([("item_id", pa.string()), ("doc_word", pa.int32()), ("item_word", pa.int32()), ("n_words", pa.int32())]))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("decontaminate")
        items = shipped.value
        for whole in batches:
            texts = bodies(whole, text).to_pylist()
            for part in _shards(texts):
                batch = whole.slice(part.start, part.stop - part.start)
                counts, found = _matches(texts[part], items)
                before = batch["matches"].to_pylist()
                all_matches = [(a or []) + b for a, b in zip(before, found, strict=True)]
                columns = {c: batch[c] for c in batch.schema.names if c not in ("matches", "body")}
                if keep_text:
                    columns["body"] = batch["body"]
                columns["n_words"] = pa.array(counts, pa.int64())
                columns["n_hit"] = pa.array([covered(m) if m else 0 for m in all_matches], pa.int64())
                columns["matches"] = pa.array(all_matches, arrow)
                yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(step, schema)


def benchmark_matches(
    docs: DataFrame, items: DataFrame, carry: list[str], text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_bytes: int = ITEM_BLOCK_BYTES,
) -> DataFrame:
    """Find every verbatim passage that documents share with test items, at least a window of ``window`` words long.

    An item of fewer words, but not none, is one window. Returns one row per document: the columns ``carry`` as
    ``carried`` (a struct), ``n_words``, ``n_hit`` (words inside a match) and ``matches``: item, first word in the
    document and in the item, and length of each longest match. Null texts have no words; an item without an id is
    searched under the name ''. Repeated items count once each; without items no word is hit. Only ``carry`` and
    ``text`` of the documents are read.
    """
    spark = docs.sparkSession
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("body")).distinct()
    total = named.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    dealt = named.withColumn("block", F.pmod(F.xxhash64("name", "body"), F.lit(blocks)))
    rows = carrying(docs, carry, text).withColumn("matches", F.lit(None).cast(MATCHES))
    for k in range(blocks):  # each pass takes a bounded block of the test items over all documents
        block = TestItems([tuple(r) for r in dealt.filter(F.col("block") == k).select("name", "body").collect()], window)
        rows = _search_step(rows, spark.sparkContext.broadcast(block), text, keep_text=k + 1 < blocks)
        if k + 1 < blocks:
            rows = written_table(rows, "matches").drop("n_words", "n_hit")
    return rows


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit"):
    """A document goes if at least a twentieth of its words are hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without the contaminated ones, all columns as they came."""
    found = benchmark_matches(docs, items, docs.columns, text, **options)
    return found.filter(~contaminated()).select("carried.*")
