"""Byte-pair encoding by backtracking, decoding by an offset table.

An Aho-Corasick automaton gives the longest token that starts at each byte. The encoder takes it if it is compatible
with the token before it, else the next shorter prefix that is a token, else it steps back one token; places that have
failed once are never tried again, so the time is linear. Two tokens are compatible if merging their joined bytes would
give the same two tokens again: their merges are undone latest first, and at no point may a pair across the border have
an earlier merge. A sequence whose neighbours are all compatible is what merging by rank gives.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commuta.llm.batches import alone, bodies, carrying

#: Fixed value: the pattern that splits texts before byte-level merges.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Encoded pieces in one generation of a worker's memory, the longest piece remembered, and pairs of tokens remembered.
CACHED_PIECES = 150_000
CACHED_CHARS = 48
CACHED_PAIRS = 100_000
#: Bytes of text encoded before their rows are handed on.
ROWS_BYTES = 2 << 20


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class BytePairCodec:
    """Encoder and decoder for a byte-level tokenizer file (``tokenizers`` JSON)."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = all(not t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        if (
            model["type"] != "BPE" or spec.get("normalizer") or not plain or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("ignore_merges")
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        ):
            raise ValueError("only byte-level BPE without a normalizer, prefix space or suffixes is supported")
        letters = byte_letters()
        spelled = {tuple(letters[c] for c in t): i for t, i in model["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]

        # Tokens are numbered by rank: the 256 bytes, then one for each merge.
        self.bytes: list[bytes] = [bytes([b]) for b in range(256)]
        self.left, self.right = list(range(256)), list(range(256))
        rank_of = {b: r for r, b in enumerate(self.bytes)}
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in merges:
            left, right = (rank_of[bytes(letters[c] for c in x)] for x in (a, b))
            token = self.bytes[left] + self.bytes[right]
            rank = len(self.bytes)
            self.joined[left, right] = rank
            self.bytes.append(token)
            self.left.append(left)
            self.right.append(right)
            rank_of.setdefault(token, rank)
        self.id_of_rank = [spelled[tuple(t)] for t in self.bytes]

        # A token counts only if merging its own bytes gives it back.
        whole = [True] * 256
        for r in range(256, len(self.bytes)):
            left, right = self.left[r], self.right[r]
            whole.append(rank_of[self.bytes[r]] == r and whole[left] and whole[right] and self.compatible(left, right, r))
        tokens = {t: r for t, r in rank_of.items() if whole[r]}
        self.shorter = [next((tokens[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in tokens), -1) for t in self.bytes]
        self.length = [len(t) for t in self.bytes]
        self.automaton = ahocorasick.Automaton()
        for t, r in tokens.items():  # reversed: a match that ends somewhere in the reversed text starts there in the text
            self.automaton.add_word(t[::-1].decode("latin-1"), r)
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}

        self.pieces = regex.compile(PIECES)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        found = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.special_pattern = regex.compile(f"({found})") if found else None
        self.remembered = CACHED_PIECES
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

        # Offset table: the bytes of token i are blob[offset[i] : offset[i + 1]].
        by_id = {i: self.bytes[r] for r, i in enumerate(self.id_of_rank)} | {i: s.encode() for s, i in self.special.items()}
        parts = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.offset = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(parts), np.uint8)

    def compatible(self, a: int, b: int, limit: int = 1 << 62) -> bool:
        """Whether ``a`` and ``b`` stay side by side when merges of a rank under ``limit`` are applied to their bytes."""
        while True:
            if self.joined.get((a, b), limit) < limit:
                return False
            # Undo the later of the two merges; of equal ones the right, since the left one is applied first.
            if a > b and a >= 256:
                limit, a = a, self.right[a]
            elif b >= 256:
                limit, b = b + 1, self.left[b]
            else:
                return True

    def _fit(self, a: int, b: int) -> bool:
        if len(self.fits) >= min(CACHED_PAIRS, self.remembered):
            self.fits.clear()
        good = self.fits[a, b] = self.compatible(a, b)
        return good

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one piece of text, without the pattern and without special tokens."""
        text = piece.encode("utf-8").decode("latin-1")
        size = len(text)
        length = self.length
        longest = [-1] * size
        last = size - 1
        for end, rank in self.automaton.iter(text[::-1]):  # of matches that end at one place the longest comes first
            if longest[last - end] < 0:
                longest[last - end] = rank
        if length[longest[0]] == size:
            return [self.id_of_rank[longest[0]]]
        failed = bytearray(size + 1)
        out: list[int] = []
        at, token, before = 0, longest[0], -1
        shorter, fits, fit = self.shorter, self.fits.get, self._fit
        while at < size:
            while token >= 0:
                end = at + length[token]
                if not failed[end]:
                    good = before < 0 or fits((before, token))
                    if good or good is None and fit(before, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, before = end, token
                token = longest[at] if at < size else -1
            else:  # nothing goes on from here: take the last token back and try a shorter one
                failed[at] = 1
                token = out.pop()
                before = out[-1] if out else -1
                at -= length[token]
                token = shorter[token]
        ids = self.id_of_rank
        return [ids[r] for r in out]

    def _learn(self, piece: str) -> bytes:
        """Packed ids of a piece this generation does not know; two generations are kept, so frequent pieces stay."""
        ids = self.before.get(piece) or array("i", self.encode_piece(piece)).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self.known) >= self.remembered:
                self.before = dict(self.known)
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; the strings of special tokens become those tokens. Null counts as empty."""
        out: list[bytes] = []
        parts = self.special_pattern.split(text or "") if self.special_pattern else [text or ""]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.int32(self.special[part]).tobytes())
            elif part:
                known, learn = self.known.get, self._learn
                out += [known(p) or learn(p) for p in self.pieces.findall(part)]
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids: their bytes from the offset table, one after the other."""
        begin = self.offset[ids]
        size = self.offset[np.asarray(ids, np.int64) + 1] - begin
        total = int(size.sum())
        source = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(total)
        return self.blob[source].tobytes().decode("utf-8", "replace")


_CODECS: dict[int, BytePairCodec] = {}


def _codec(definition: str) -> BytePairCodec:
    key = hash(definition)
    if key not in _CODECS:
        _CODECS[key] = BytePairCodec(definition)
    return _CODECS[key]


def _forget() -> None:
    _CODECS.clear()


def _parts(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    begin, reached = 0, 0
    for at, n in enumerate(sizes.tolist()):
        if at > begin and reached + n > most:
            yield batch.slice(begin, at - begin)
            begin, reached = at, 0
        reached += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def _mapped(docs: DataFrame, tokenizer: str, source: str, added: dict[str, T.DataType], step, remembered: int = CACHED_PIECES) -> DataFrame:
    """Add columns that ``step(codec, values of source)`` makes, a bounded part of a batch at a time."""
    with open(tokenizer, encoding="utf-8") as f:  # a vocabulary file: one or two MB, sent to each executor once
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())
    names = list(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("bpe", _forget)
        codec = _codec(shipped.value)
        codec.remembered = remembered
        for whole in batches:
            column = bodies(whole, source)
            length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
            for batch in _parts(whole, length(column).fill_null(0).to_numpy(), ROWS_BYTES):
                made = step(codec, bodies(batch, source))
                yield pa.RecordBatch.from_pydict({"carried": batch["carried"]} | {f"made{k}": made[n] for k, n in enumerate(names)})

    kept = [c for c in docs.columns if c not in added]
    rows = carrying(docs, kept, source)
    schema = T.StructType([rows.schema["carried"], *[T.StructField(f"made{k}", added[n]) for k, n in enumerate(names)]])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(f"carried.`{c}`") for c in kept], *[F.col(f"made{k}").alias(n) for k, n in enumerate(names)])


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


IDS = T.ArrayType(T.IntegerType(), False)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array of int) with the tokens of the whole ``text``; null counts as empty and gives no tokens.

    ``tokenizer`` is the path of the vocabulary file on the driver. A column already named ``ids`` is replaced.
    """
    return _mapped(docs, tokenizer, text, {ids: IDS}, lambda codec, column: {ids: _lists([codec.encode(t) for t in column.to_pylist()])})


def decode(tokens: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``, the text of ``ids``; null ids give an empty text."""
    def step(codec: BytePairCodec, column: pa.Array) -> dict[str, pa.Array]:
        return {text: pa.array([codec.decode(np.array(x or [], np.int32)) for x in column.to_pylist()], pa.string())}

    return _mapped(tokens, tokenizer, ids, {text: T.StringType()}, step)


def round_trip(
    docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", remembered: int = CACHED_PIECES
) -> DataFrame:
    """Add ``ids`` and the text ``decoded`` from them, in one pass over the documents.

    A worker remembers up to twice ``remembered`` encoded pieces; fewer take less room and more time, and give the same.
    """
    def step(codec: BytePairCodec, column: pa.Array) -> dict[str, pa.Array]:
        rows = [codec.encode(t) for t in column.to_pylist()]
        return {ids: _lists(rows), decoded: pa.array([codec.decode(r) for r in rows], pa.string())}

    return _mapped(docs, tokenizer, text, {ids: IDS, decoded: T.StringType()}, step, remembered)
