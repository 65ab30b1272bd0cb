"""Spelling variants by permuterm rotations: words that differ by one inserted, deleted or replaced character.

A word X c Y with a terminator, rotated so that c comes last, reads Y$Xc. All words that have another character in the place
of c, or none, have a rotation in the range of the prefix Y$X: those with one more character than the prefix, and the one
word whose rotation is the prefix itself. Each rotation is therefore filed under the prefix that skips its last character, and
under itself as a whole; one scan over the sorted keys meets every pair of near words in one group. A group has one place and one
context, so it holds at most one word for each character of the alphabet.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commuta.llm.batches import alone, bodies, bounded, carrying
from commuta.llm.numbering import in_order
from commuta.operators.lineage import written_table

#: Fixed value: the letters words are made of.
LETTERS = "A-Za-zÀ-ÿ"
TERMINATOR = "$"
#: Words and characters counted in a task before they are handed on.
HELD_WORDS = 1 << 16
HELD_CHARS = 8 << 20
#: Keys of more bytes are filed by a digest; words of more characters have theirs worked out from sums over their prefixes.
KEY_BYTES = 24
LONG = 256
#: Rows of keys in one batch.
KEY_ROWS = 1 << 15
#: How a word is in a group: whole, or without a character that is the first of a run of equal ones, or not the first.
WHOLE, FIRST, LATER = 0, 1, 2
_PRIME, _BASE = (1 << 127) - 1, 0x5DEECE66D1CE4E5B9F3A7C15


def count_words(docs: DataFrame, id: str = "doc_id", text: str = "text", least_chars: int = 7, slip: int = 31) -> DataFrame:
    """``word`` and ``n``: how often each word of at least ``least_chars`` characters occurs in all texts.

    Words are maximal runs of LETTERS with A-Z lower-cased. Where ``slip`` divides the CRC-32 h of ``id:word`` the
    character h % length is left out; 0 leaves all as they are. A null id counts as an empty one.
    """
    pattern = re.compile(f"[{LETTERS}]{{{max(1, least_chars)},}}")

    def batch_of(held: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("variants")
        held: dict[str, int] = {}
        chars = 0
        for batch in batches:
            ids = batch["carried"].field("id").to_pylist()
            for i, body in zip(ids, pc.ascii_lower(bodies(batch, text)).to_pylist(), strict=True):
                begun = zlib.crc32(f"{'' if i is None else i}:".encode())
                for word, times in Counter(pattern.findall(body or "")).items():
                    if slip:
                        h = zlib.crc32(word.encode(), begun)
                        if h % slip == 0:
                            k = h % len(word)
                            word = word[:k] + word[k + 1 :]
                            if len(word) < least_chars:
                                continue
                    if word in held:
                        held[word] += times
                    else:
                        held[word] = times
                        chars += len(word)
                if len(held) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield batch_of(held)
                    held, chars = {}, 0
        if held:
            yield batch_of(held)

    rows = carrying(docs.select(F.col(f"`{id}`").cast("string").alias("id"), F.col(f"`{text}`").alias(text)), ["id"], text)
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _filed(key: str) -> bytes:
    raw = key.encode()
    return raw if len(raw) <= KEY_BYTES else b"\0" + xxhash.xxh3_128_digest(raw)


def rotation_keys(word: str) -> Iterator[tuple[bytes, int]]:
    """The keys ``word`` is filed under: its rotations, and its rotations without their last character."""
    n = len(word)
    if n <= LONG - 1:
        for i in range(n + 1):
            yield _filed(word[i:] + TERMINATOR + word[:i]), WHOLE
        for i in range(n):
            yield _filed(word[i + 1 :] + TERMINATOR + word[:i]), FIRST if i == 0 or word[i] != word[i - 1] else LATER
        return
    # Sums of c * base^k over prefixes give the digest of every rotation in one step.
    sums, powers = [0], [1]
    for c in word:
        sums.append((sums[-1] * _BASE + ord(c)) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)

    def digest(begin: int, end: int) -> bytes:
        """Of word[begin:], the terminator and word[:end]."""
        tail = (sums[n] - sums[begin] * powers[n - begin]) % _PRIME
        whole = ((tail * _BASE + ord(TERMINATOR)) * powers[end] + sums[end]) % _PRIME
        return b"\1" + whole.to_bytes(16, "little")

    for i in range(n + 1):
        yield digest(i, i), WHOLE
    for i in range(n):
        kind = FIRST if i == 0 or word[i] != word[i - 1] else LATER
        # A key as long as the longest that is filed as text must be filed like it.
        yield (_filed(word[i + 1 :] + TERMINATOR + word[:i]) if n == LONG else digest(i + 1, i)), kind


def _rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys: list[bytes] = []
        roles: list[int] = []
        which: list[int] = []
        ids, counts = batch["at"].to_pylist(), batch["n"].to_pylist()

        def rows(ids=ids, counts=counts, keys=keys, roles=roles, which=which) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "key": pa.array(keys, pa.binary()), "role": pa.array(roles, pa.int32()),
                "at": pa.array([ids[k] for k in which], pa.int64()), "n": pa.array([counts[k] for k in which], pa.int64()),
            })

        for k, word in enumerate(batch["word"].to_pylist()):
            for key, role in rotation_keys(word):
                keys.append(key)
                roles.append(role)
                which.append(k)
                if len(keys) >= KEY_ROWS:
                    yield rows()
                    keys.clear(), roles.clear(), which.clear()
        if keys:
            yield rows()


def _neighbours(group: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Of each word of a group (role, n, at): at, near words, and n and at of the best of them."""
    whole = [g for g in group if g[0] == WHOLE]
    skipped = sorted((g for g in group if g[0] != WHOLE), key=lambda g: (-g[1], g[2]))
    for k, (role, _, at) in enumerate(skipped):
        near = [skipped[0 if k else 1]] if len(skipped) > 1 else []
        near += whole if role == FIRST else []
        if near:
            _, n, best = min(near, key=lambda g: (-g[1], g[2]))
            yield at, len(skipped) - 1 + (len(whole) if role == FIRST else 0), n, best
    firsts = [g for g in skipped if g[0] == FIRST]
    if whole and firsts:
        yield whole[0][2], len(firsts), firsts[0][1], firsts[0][2]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The groups of rows sorted by key, one after the other."""
    last: bytes | None = None
    group: list[tuple[int, int, int]] = []
    for batch in batches:
        keys = np.array([last, *batch["key"].to_pylist()], object)
        role, n, at = (batch[c].to_pylist() for c in ("role", "n", "at"))
        starts = np.flatnonzero(keys[1:] != keys[:-1]).tolist()
        found = []
        begin = 0
        for end in [*starts, len(at)]:
            group += zip(role[begin:end], n[begin:end], at[begin:end], strict=True)
            if end < len(at):
                if len(group) > 1:
                    found += _neighbours(group)
                group = []
            begin = end
        last = keys[-1]
        yield _near_batch(found)
    if len(group) > 1:
        yield _near_batch(list(_neighbours(group)))


def _near_batch(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True)) or [()] * 4
    return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in zip(("at", "near", "best_n", "best"), columns, strict=True)})


def near_words(words: DataFrame) -> DataFrame:
    """``at``, ``n_near`` and ``best`` (a struct of ``n`` and ``at``) of every word that has a near word.

    ``words`` are distinct and have ``word``, ``n`` and ``at``, a number that ascends with the word. ``best`` has the
    largest n, the smallest at among equals. No pair is formed: a group tells each of its words how many others it
    holds and which is the best, and every pair of near words meets in one group only.
    """
    bounded(words.sparkSession)
    filed = words.select("word", "n", "at").mapInArrow(_rotations, "key binary, role int, at long, n long")
    dealt = filed.repartition("key").sortWithinPartitions("key", "role")
    found = dealt.mapInArrow(_scan, "at long, near long, best_n long, best long")
    best = F.max(F.struct("best_n", (-F.col("best")).alias("back")))
    return found.groupBy("at").agg(F.sum("near").alias("n_near"), best.alias("best")).select(
        "at", "n_near", F.struct(F.col("best.best_n").alias("n"), (-F.col("best.back")).alias("at")).alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``at`` and ``root`` of every word with a form: where its chain of forms ends. Steps double from round to round.

    A form occurs at least ``times`` as often as the word, so chains are short and have no rings.
    """
    reached = written_table(forms.select("at", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("at").alias("root"), F.col("root").alias("next"))
        joined = reached.join(further, "root", "left")
        step = written_table(joined.select("at", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if step.filter("moved").isEmpty():
            return step.select("at", "root")
        reached = step.select("at", "root")


def spelling_variants(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least_chars: int = 7, least_n: int = 2, times: int = 10, slip: int = 31
) -> DataFrame:
    """Words of all texts, grouped with the frequent word they are a variant of.

    Returns ``word``, ``form`` (its near word of the largest n, the first in code-point order among equals, if that n is at
    least ``times`` the word's; else null), ``root`` (where forms lead in the end; the word itself without one), ``n``, ``n_near``
    (0 if none) and ``form_n``, for each word of ``least_chars`` characters and ``least_n`` occurrences or more. ``times`` must be over 1.
    Null and empty texts have no words; a null id counts as an empty one; repeated rows are counted as often as they
    come; an empty table gives an empty result. Only ``id`` and ``text`` are read. Words may be of any length: a long one is
    filed by digests of 127 bits, which hold its rotations in memory of its own size.
    """
    if times <= 1:
        raise ValueError("a form must occur more often than its variant")
    counted = written_table(count_words(docs, id, text, least_chars, slip).filter(F.col("n") >= least_n), "words")
    words = in_order(counted, "word")
    near = written_table(near_words(words), "near")
    forms = near.join(words.select("at", "n"), "at").filter(F.col("best.n") >= times * F.col("n"))
    forms = written_table(forms.select("at", F.col("best.at").alias("form"), F.col("best.n").alias("form_n")), "forms")
    form_words = words.select(F.col("at").alias("form"), F.col("word").alias("form_word"))
    root_words = words.select(F.col("at").alias("root"), F.col("word").alias("root_word"))
    named = forms.join(form_words, "form").join(_roots(forms), "at").join(root_words, "root")
    found = words.join(near.select("at", "n_near"), "at", "left").join(named.select("at", "form_word", "form_n", "root_word"), "at", "left")
    return found.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )
