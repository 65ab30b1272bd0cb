"""Token ids as flat binary files with 64-bit document offsets, to be memory-mapped.

Documents are dealt by ranges of their ids, so the files follow one another in id order. Each task encodes its range
and streams it into three files: ``NAME.bin`` (ids, unsigned 16 or 32 bits, little-endian), ``NAME.idx`` (64-bit
offsets of the documents in the file, one more than documents) and ``NAME.ids`` (64-bit document ids; a null id is
the smallest number). Sums over the files before a file give its base, the place of its first token in the whole.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commuta.llm.batches import alone, bounded
from commuta.operators.lineage import written_table

NULL_ID = -(1 << 63)
#: Encoded words in one generation of a worker's memory, the longest word remembered, and words encoded in one call.
CACHED_WORDS = 500_000
CACHED_BYTES = 48
WORDS_PER_CALL = 2048
#: Text encoded at a time.
PIECE_BYTES = 8 << 20
#: Fixed value: the pattern of tokenizers that are asked word by word. No match of it holds white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words in UTF-8: a whole run of a-z and the letters from À to ÿ, or else all up to white space. A match of the pattern
#: ends where such a run ends, unless a combining mark or another letter past ASCII may follow.
_WORDS = re.compile(rb"(?:[a-z]+|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++(?![\x80-\xff])|\S+")
BAR, SPECIAL = b"|", b"<|"
#: Bytes of token ids returned in one batch by the reader, and documents in it.
READ_BYTES = 4 << 20
READ_ROWS = 4096


class WordEncoder:
    """The tokenizers library, asked once for each word where that gives the ids of whole texts.

    That holds if the definition normalises character by character and its pattern is WORD_PATTERN: then nothing reaches
    across white space or past the end of a run of letters, and lower case makes no difference. A worker remembers two
    generations of words, so frequent ones stay. Texts that may hold special tokens are asked for whole, and so are all
    texts of other tokenizers.
    """

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        spec = json.loads(definition)
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        first = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.bar = self._ids(BAR)
        self.by_word = (
            [n["type"] for n in steps] == ["NFC", "Replace", "Lowercase"] and steps[1]["pattern"] == {"Regex": r"\s+"}
            and first.get("pattern") == {"Regex": WORD_PATTERN} and first["behavior"] == "Removed" and first["invert"]
            and all(SPECIAL in t["content"].encode() for t in spec["added_tokens"]) and len(self.bar) == 1
        )
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _ids(self, text: bytes) -> list[int]:
        return self.library.encode(text.decode(), add_special_tokens=False).ids

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _encode_words(self, found: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words, many in one call: a bar between them has an id that no word without a bar gives."""
        out = {w: self._packed(self._ids(w)) for w in found if BAR in w}
        rest = [w for w in found if BAR not in w]
        for k in range(0, len(rest), WORDS_PER_CALL):
            part = rest[k : k + WORDS_PER_CALL]
            ids = np.array(self._ids(b" | ".join(part)), self.dtype)
            cut = np.flatnonzero(ids == self.bar[0])
            raw, ends = ids.tobytes(), [*(cut * ids.itemsize).tolist(), len(ids) * ids.itemsize]
            assert len(ends) == len(part)
            begin = 0
            for w, end in zip(part, ends, strict=True):
                out[w] = raw[begin:end]
                begin = end + ids.itemsize
        return out

    def _learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words not known in this generation; long ones are not remembered."""
        before = self.before
        found = {w: before[w] for w in new if w in before}
        found.update(self._encode_words(list(new.difference(found))))
        self.known.update(found if max(map(len, found)) <= CACHED_BYTES else {w: ids for w, ids in found.items() if len(w) <= CACHED_BYTES})
        return found

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The packed ids of each text."""
        bodies = [(t or "").encode() for t in texts]
        whole = [not self.by_word or SPECIAL in b for b in bodies]
        split = [[] if w else _WORDS.findall(b.lower()) for b, w in zip(bodies, whole, strict=True)]
        if len(self.known) >= CACHED_WORDS:
            self.before, self.known = self.known, {}
        known = self.known
        new = set().union(*split).difference(known)
        found = self._learn(new) if new else {}
        if any(len(w) > CACHED_BYTES for w in found):
            rows = [b"".join([known[w] if w in known else found[w] for w in ws]) for ws in split]
        else:
            rows = [b"".join(map(known.__getitem__, ws)) for ws in split]
        return [self._packed(self._ids(b)) if w else row for b, w, row in zip(bodies, whole, rows, strict=True)]


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(definition: str) -> WordEncoder:
    key = hash(definition)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(definition)
    return _ENCODERS[key]


def _forget() -> None:
    _ENCODERS.clear()


def _store(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder given as a path or URI."""
    parsed = urlparse(folder)
    if parsed.scheme in ("", "file"):
        return arrow_fs.LocalFileSystem(), parsed.path
    return arrow_fs.FileSystem.from_uri(folder)


def _pieces(texts: list[str | None], most: int = PIECE_BYTES) -> Iterator[slice]:
    begin, size = 0, 0
    for at, text in enumerate(texts):
        if at > begin and size + len(text or "") > most:
            yield slice(begin, at)
            begin, size = at, 0
        size += len(text or "")
    if begin < len(texts):
        yield slice(begin, len(texts))


MANIFEST = "file string, n_docs long, n_tokens long, width int"


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = None, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode every whole text, append ``end_id``, and write the ids in ascending ``id`` order to files in ``folder``.

    ``tokenizer`` is a vocabulary file of the tokenizers library; no special tokens are added. Returns the manifest,
    itself written: ``file``, ``n_docs``, ``n_tokens``, ``width`` (bytes of an id) and ``base`` (ids in all files before).
    Null texts count as empty; null ids come first; rows repeated with one id each have their place. An empty table
    gives no files. ``folder`` must be seen by all executors; a file is written under a name of the attempt and moved
    to its own when complete, so a lost or repeated task leaves nothing half-written.
    """
    with open(tokenizer, encoding="utf-8") as f:  # a vocabulary file: one or two MB
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("tokenfiles", _forget)
        encoder = _encoder(shipped.value)
        end = b"" if end_id is None else encoder.dtype.type(end_id).tobytes()
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():08d}"
        attempt = f"{root}/_{name}-{uuid.uuid4().hex}"
        outs, reached, n_docs = None, 0, 0
        for batch in batches:
            texts = batch["body"].to_pylist()
            for part in _pieces(texts):
                if outs is None:
                    outs = {kind: store.open_output_stream(f"{attempt}.{kind}") for kind in ("bin", "idx", "ids")}
                    outs["idx"].write(np.zeros(1, "<i8").tobytes())
                packed = [x + end for x in encoder.encode_all(texts[part])]
                offsets = reached + np.cumsum([len(x) // encoder.dtype.itemsize for x in packed])
                outs["bin"].write(b"".join(packed))
                outs["idx"].write(offsets.astype("<i8").tobytes())
                ids = batch["id"].slice(part.start, part.stop - part.start).fill_null(NULL_ID)
                outs["ids"].write(ids.to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                reached, n_docs = int(offsets[-1]), n_docs + len(packed)
        if outs is not None:
            for kind, out in outs.items():
                out.close()
                store.move(f"{attempt}.{kind}", f"{root}/{name}.{kind}")
            yield pa.RecordBatch.from_pydict({
                "file": pa.array([f"{folder}/{name}"]), "n_docs": pa.array([n_docs], pa.int64()),
                "n_tokens": pa.array([reached], pa.int64()), "width": pa.array([encoder.dtype.itemsize], pa.int32()),
            })

    bounded(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    tie = F.xxhash64("body")  # lets the ranges divide an id that many rows share
    ordered = rows.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
    files = written_table(ordered.mapInArrow(write, MANIFEST), "manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return written_table(files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Map the files of a manifest: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids``.

    ``ids`` holds the document's ids as little-endian unsigned 32-bit integers (binary). Files on a mounted file
    system are memory-mapped; those of a remote store are read through it.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            store, path = _store(row["file"])

            def mapped(kind: str, dtype: str, store=store, path=path) -> np.ndarray:
                if isinstance(store, arrow_fs.LocalFileSystem):
                    return np.memmap(f"{path}.{kind}", dtype, "r") if os.path.getsize(f"{path}.{kind}") else np.zeros(0, dtype)
                with store.open_input_file(f"{path}.{kind}") as f:
                    return np.frombuffer(f.read(), dtype)

            tokens, offsets, ids = mapped("bin", f"<u{row['width']}"), mapped("idx", "<i8"), mapped("ids", "<i8")
            most = READ_BYTES // 4
            begin = 0
            while begin < len(ids):
                stop = int(np.searchsorted(offsets, offsets[begin] + most, "right")) - 1
                stop = min(max(stop, begin + 1), begin + READ_ROWS, len(ids))
                part = np.asarray(offsets[begin : stop + 1])
                values = tokens[part[0] : part[-1]].astype("<u4")
                at = pa.py_buffer(((part - part[0]) * 4).astype(np.int32).tobytes())
                packed = pa.Array.from_buffers(pa.binary(), stop - begin, [None, at, pa.py_buffer(values.tobytes())])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(np.asarray(ids[begin:stop]), mask=np.asarray(ids[begin:stop]) == NULL_ID),
                    "start": pa.array(part[:-1] + row["base"]),
                    "n_tokens": pa.array(np.diff(part)), "ids": packed,
                })
                begin = stop

    rows = manifest.select("file", "width", "base")
    dealt = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # a few files to each task
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
