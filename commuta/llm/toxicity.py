"""Toxicity: a support vector machine on a gapped subsequence kernel, made linear by Nyström landmarks.

Two words are alike as far as they share ORDER letters in the same order, gaps allowed (a word's edges count as letters);
a subsequence that spans d characters counts DECAY ** d in each word. Punctuation inside a word only widens gaps, so
``i.d-iot`` is still close to ``idiot``. Landmarks are words of labelled sentences: K(landmarks)^(-1/2) K(landmarks, word)
are a word's Nyström features, a linear machine is fitted to them, and since the kernel is a product of sums over
subsequences the fitted machine folds into one weight for each. A logistic function of its few most toxic words scores a text.
"""

from __future__ import annotations

import math
import re
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cache, lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commuta.llm.batches import alone, bodies, carrying

#: Bounds of the fit: labelled documents read, and distinct words of theirs used (the most frequent).
SAMPLE_DOCS = 8000
SAMPLE_WORDS = 20_000
LEAST_DOCS = 3
LANDMARKS = 1024
ORDER = 3
DECAY = 0.6
THRESHOLD = 0.7
#: A document is judged by its TOP most toxic distinct words; words under FLOOR do not tell.
TOP, FLOOR = 4, -0.5
#: Longer words are read as overlapping windows of this many bytes.
WINDOW, WINDOW_STEP = 14, 4
#: Words in one generation of a worker's memory, and characters of text scored at a time.
CACHED_WORDS = 100_000
PART_BYTES = 4 << 20

#: Symbols: a-z, any digit, eight for all other letters, both edges of a word, and what only makes a gap.
SYMBOLS = 38
FIRST, LAST, GAP = 35, 36, 37
CODES = SYMBOLS**ORDER
_SYMBOL = np.array([b - 97 if 97 <= b <= 122 else 26 if 48 <= b <= 57 else 27 + (b & 7) if b >= 128 else GAP for b in range(256)], np.int64)
_EDGES = bytes(b for b in range(33, 127) if not chr(b).isalnum())
#: What is dropped before accents are composed, what is dropped anywhere, and what is folded: all but ASCII and Latin-1 letters.
_FORMAT = re.compile("[\xad\u034f\u061c\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufe00-\ufe0f\ufeff]+")
_IGNORED = re.compile("[\u0300-\u036f\u115f\u1160\u17b4\u17b5\u180b-\u180f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\u3164\ufe00-\ufe0f\ufe20-\ufe2f\uffa0\U000e0100-\U000e01ef]")
_FOLDED = re.compile("[\x80-\xbf\xd7\xf7\u0100-\U0010ffff]+")
_LETTERS_APART = re.compile(rb"(?<!\S)\S(?:[ \t]\S){2,}[!-/:-@\[-`{-~]*(?!\S)")


@cache
def _picks(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all subsequences of ORDER symbols in a word of ``length``, and the weight of each."""
    at = np.array(list(combinations(range(length), ORDER)), np.int64)
    return at, DECAY ** (at[:, -1] - at[:, 0] + 1.0)


@lru_cache(1 << 16)
def _folded(char: str) -> str:
    """A character past ASCII as characters of one byte: none, a space, a gap, ASCII letters or digits, or a hashed letter."""
    kind = unicodedata.category(char)
    if kind == "Cf" or _IGNORED.match(char):
        return ""
    if char.isspace():
        return " "
    parts = unicodedata.normalize("NFKD", char).lower()
    if kind[0] in "PSC" and kind not in ("Cn", "Co", "Cs") and not any(c.isalnum() for c in parts):
        return "-"
    return "".join(
        "" if _IGNORED.match(c) else (c if c.isalnum() else "-") if c < "\x80" else "0" if c.isdecimal()
        else chr(0x80 | (ord(c) * 0x9E3779B1 & 0xFFFFFFFF) >> 25)
        for c in parts
    )


def one_byte(text: str) -> bytes:
    """A byte for each character: ASCII and Latin-1 letters are their own, others are folded to these or hashed to a letter.

    Format characters and marks above and below letters are dropped, punctuation and symbols past ASCII make a gap, and
    spaces past ASCII are spaces.
    """
    if not text.isascii():
        text = unicodedata.normalize("NFC", _FORMAT.sub("", text)).lower()
        text = _FOLDED.sub(lambda run: "".join(map(_folded, run.group())), text)
        return text.encode("latin-1")
    return text.lower().encode()


def words(text: str | None) -> set[bytes]:
    """The distinct words of a text, and as one word each run of letters that stand apart."""
    body = one_byte(text or "")
    found = set(body.split())
    found.update(m.translate(None, b" \t") for m in _LETTERS_APART.findall(body))
    return found


def windows(word: bytes) -> list[bytes]:
    word = word.strip(_EDGES)
    if len(word) <= WINDOW:
        return [word] if len(word) >= 3 else []
    starts = range(0, len(word) - WINDOW + WINDOW_STEP, WINDOW_STEP)
    return [word[min(s, len(word) - WINDOW) :][:WINDOW] for s in starts]


def _coded(strings: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For strings of one length, some at a time: their places, codes of their subsequences (-1 with a gap), weights.

    The weights of a string are scaled so that its kernel with itself is 1 where no subsequence occurs twice.
    """
    lengths = np.array([len(s) for s in strings])
    for n in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == n)
        at, weight = _picks(n + 2)
        for k in range(0, len(places), 1024):
            some = places[k : k + 1024]
            symbols = np.empty((len(some), n + 2), np.int64)
            symbols[:, 0], symbols[:, -1] = FIRST, LAST
            symbols[:, 1:-1] = _SYMBOL[np.frombuffer(b"".join([strings[x] for x in some]), np.uint8).reshape(-1, n)]
            code, gap = np.zeros((len(some), len(at)), np.int64), np.zeros((len(some), len(at)), bool)
            for j in range(ORDER):
                code *= SYMBOLS
                code += symbols[:, at[:, j]]
            if (symbols == GAP).any():
                for j in range(ORDER):
                    gap |= symbols[:, at[:, j]] == GAP
                code[gap] = -1
                norm = np.sqrt((~gap * weight**2).sum(axis=1, keepdims=True))
            else:
                norm = np.sqrt((weight**2).sum())
            yield some, code, np.broadcast_to(weight, code.shape) / np.maximum(norm, 1e-12)


def kernel(strings: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    """Gapped-subsequence kernel of strings (of 3 to WINDOW bytes) with landmarks."""
    held = np.unique(np.concatenate([np.unique(code) for _, code, _ in _coded(landmarks)])) if landmarks else np.zeros(0, np.int64)
    held = held[held >= 0]
    row_of = np.full(CODES + 1, len(held), np.int32)  # the last row for codes no landmark has, and for gaps
    row_of[held] = np.arange(len(held))
    table = np.zeros((len(held) + 1, len(landmarks)), np.float32)
    for some, code, weight in _coded(landmarks):
        for row, place in enumerate(some):
            np.add.at(table[:, place], row_of[code[row]], weight[row])
    table[-1] = 0
    out = np.zeros((len(strings), len(landmarks)), np.float32)
    for some, code, weight in _coded(strings):
        for k in range(0, len(some), 16):
            out[some[k : k + 16]] = np.einsum("wt,wtm->wm", weight[k : k + 16].astype(np.float32), table[row_of[code[k : k + 16]]])
    return out


def _hinge(z: np.ndarray, toxic: np.ndarray, clean: np.ndarray, cost: float = 1.0) -> np.ndarray:
    """Linear machine (last entry: bias) with squared hinge loss; a row counts ``toxic`` times +1 and ``clean`` times -1.

    Newton steps; the rows are taken some at a time, and steps are drawn in until the rows inside the margin settle.
    """
    size = z.shape[1] + 1
    theta = np.zeros(size)
    for turn in range(40):
        a, b = np.eye(size), np.zeros(size)
        a[-1, -1] = 1e-6
        for k in range(0, len(z), 2048):
            x = np.hstack([z[k : k + 2048], np.ones((len(z[k : k + 2048]), 1))]).astype(np.float64)
            f = x @ theta
            up, down = toxic[k : k + 2048] * (f < 1), clean[k : k + 2048] * (f > -1)
            inside = up + down > 0
            x, up, down = x[inside], up[inside], down[inside]
            a += 2 * cost * (x.T * (up + down)) @ x
            b += 2 * cost * x.T @ (up - down)
        step = np.linalg.solve(a, b) - theta
        theta = theta + step * (0.7 if turn < 3 else 1.0)
        if np.abs(step).max() < 1e-4:
            break
    return theta


def _logistic(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights (last entry: offset) that turn rows of ``x`` into probabilities, with labels drawn in a little."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = 0.1 * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + ridge, x.T @ (target - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


class _Memory:
    """Values of words under the model a worker used last."""

    def __init__(self):
        self.name, self.known, self.before = "", {}, {}

    def of(self, name: str) -> _Memory:
        if name != self.name:
            self.name, self.known, self.before = name, {}, {}
        return self


_MEMORY = _Memory()


def _forget() -> None:
    _MEMORY.of("")
    _folded.cache_clear()
    _picks.cache_clear()


@dataclass
class Model:
    """``weights`` of the subsequences and ``bias`` of the machine; ``document``, the logistic weights of its features."""

    weights: np.ndarray
    bias: float
    document: np.ndarray = field(default_factory=lambda: np.zeros(TOP + 2))
    landmarks: list[bytes] = field(default_factory=list)
    name: str = field(default_factory=lambda: uuid.uuid4().hex)
    remembered: int = CACHED_WORDS

    def values(self, found: list[bytes]) -> np.ndarray:
        """The machine's value for each word: that of its most toxic window."""
        strings, owner = [], []
        for at, w in enumerate(found):
            for s in windows(w):
                strings.append(s)
                owner.append(at)
        out = np.full(len(found), self.bias)
        if strings:
            value = np.full(len(strings), self.bias)
            for some, code, weight in _coded(strings):
                value[some] += (self.weights[code] * weight).sum(axis=1)
            best = np.full(len(found), -np.inf)
            np.maximum.at(best, owner, value)
            out = np.where(np.isfinite(best), best, out)
        return out

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Of each text the values of its TOP most toxic distinct words, FLOOR at least, and the log of its words."""
        memory = _MEMORY.of(self.name)
        if len(memory.known) >= self.remembered:  # two generations are kept, so frequent words stay
            memory.before, memory.known = memory.known, {}
        known, before = memory.known, memory.before
        split = [words(t) for t in texts]
        missing = set().union(*split).difference(known)
        known.update((w, before[w]) for w in missing if w in before)
        new = list(missing.difference(known))
        fresh = dict(zip(new, self.values(new).tolist(), strict=True))
        known.update((w, v) for w, v in fresh.items() if len(w) <= 48)
        out = np.full((len(texts), TOP + 1), FLOOR)
        for row, found in enumerate(split):
            high = [v for v in (known[w] if w in known else fresh[w] for w in found) if v > FLOOR]
            if high:
                high = sorted(high, reverse=True)[:TOP]
                out[row, : len(high)] = high
            out[row, TOP] = math.log1p(len(found))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = self.features(texts) @ self.document[:-1] + self.document[-1]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _mapped(docs: DataFrame, model: Model, carry: list[str], text: str, of: str) -> DataFrame:
    """``carried``, a struct of ``carry``, and ``made``: what the model's function ``of`` gives for each text."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a weight for each of CODES subsequences
    kind = T.DoubleType() if of == "scores" else T.ArrayType(T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("toxicity", _forget)
        used = getattr(shipped.value, of)
        for batch in batches:
            texts, made, begin, size = bodies(batch, text).to_pylist(), [], 0, 0
            for at, t in enumerate(texts):
                size += len(t or "")
                if size >= PART_BYTES or at + 1 == len(texts):
                    made += used(texts[begin : at + 1]).tolist()
                    begin, size = at + 1, 0
            yield pa.RecordBatch.from_pydict({"carried": batch["carried"], "made": pa.array(made, pa.float64() if of == "scores" else pa.list_(pa.float64()))})

    rows = carrying(docs, carry, text)
    return rows.mapInArrow(run, rows.select("carried").schema.add("made", kind))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The label of each document with each of its distinct words, read as scoring reads them: long ones in windows."""
    alone("toxicity", _forget)
    for batch in batches:
        for label, text in zip(batch["toxic_label"].to_pylist(), batch["body"].to_pylist(), strict=True):
            found = list({s for w in words(text) for s in windows(w)})
            yield pa.RecordBatch.from_pydict({"toxic_label": pa.array([label] * len(found), pa.int32()), "word": pa.array(found, pa.binary())})


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS,
) -> Model:
    """Fit the machine to at most ``sample_docs`` labelled documents, chosen by a hash of their ids.

    A sentence bears its document's label, and each word that of its sentences: a word in t toxic and c clean documents
    counts t times as toxic and c times as clean. Words are counted by Spark; the ``sample_words`` most frequent come to
    the driver. Landmarks are the words that tell the classes apart best and the most frequent others. Documents whose
    labels are null or contradict one another are left out. Without both classes every score is about the share of toxic labels.
    """
    chosen = (
        labels.groupBy(F.col(id).alias("label_id")).agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .filter("low = high and label_id is not null").select("label_id", F.col("low").cast("int").alias("toxic_label"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(sample_docs)
    )
    sample = docs.select(F.col(id).alias("doc"), F.col(text).alias("body")).join(F.broadcast(chosen), F.col("doc") == F.col("label_id"))
    counted = (
        sample.select("toxic_label", "body").mapInArrow(_counted, "toxic_label int, word binary").groupBy("word")
        .agg(F.sum("toxic_label").alias("toxic"), F.sum(1 - F.col("toxic_label")).alias("clean"))
        .filter(F.col("toxic") + F.col("clean") >= LEAST_DOCS).orderBy(F.desc(F.col("toxic") + F.col("clean")), "word").limit(sample_words)
    ).collect()
    folded = {bytes(r.word): (r.toxic, r.clean) for r in counted}
    names = sorted(folded)
    toxic, clean = (np.array([folded[w][k] for w in names], float) for k in (0, 1))
    if not names or not toxic.sum() or not clean.sum():
        share = chosen.agg(F.avg("toxic_label")).first()[0] or 0.0
        flat = Model(np.zeros(CODES + 1), -1.0)
        flat.document[-1] = math.log((share + 1e-3) / (1 - share + 1e-3))
        return flat
    expected = (toxic + clean) * toxic.sum() / (toxic.sum() + clean.sum())
    apart = (toxic - expected) / np.sqrt(expected + 1)
    order = np.argsort(-apart, kind="stable")
    telling = [int(x) for x in order[: LANDMARKS // 2] if apart[x] > 1.5]
    common = [int(x) for x in np.argsort(-(toxic + clean), kind="stable") if int(x) not in set(telling)]
    landmarks = [names[x] for x in telling + common[: LANDMARKS - len(telling)]]
    value, vector = np.linalg.eigh(kernel(landmarks, landmarks))
    half = vector @ np.diag(np.where(value > 1e-6, 1 / np.sqrt(np.maximum(value, 1e-6)), 0)) @ vector.T
    features, whiten = kernel(names, landmarks), half.astype(np.float32)
    for k in range(0, len(names), 2048):
        features[k : k + 2048] = features[k : k + 2048] @ whiten
    theta = _hinge(features, toxic, clean)
    each_landmark = half @ theta[:-1]
    weights = np.zeros(CODES + 1)
    for some, code, weight in _coded(landmarks):
        for row, place in enumerate(some):
            np.add.at(weights, code[row], each_landmark[place] * weight[row])
    weights[-1] = 0
    model = Model(weights, float(theta[-1]), landmarks=landmarks)
    seen = _mapped(sample.select("toxic_label", "body"), model, ["toxic_label"], "body", "features").select("carried.*", "made").collect()
    model.document = _logistic(np.array([r.made for r in seen]), np.array([r.toxic_label for r in seen], float))
    return model


def scored(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """The columns ``carry`` as ``carried`` (a struct) and ``score`` (0 to 1) of every whole text.

    Null and empty texts score as texts without words. Only ``carry`` and ``text`` are read; rows stay where they are.
    """
    return _mapped(docs, model, carry, text, "scores").withColumnRenamed("made", "score")


def held_out(id: str = "doc_id") -> Column:
    """A third of the documents, by the CRC-32 of their ids, whose labels are never learnt from. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, remembered: int = CACHED_WORDS) -> DataFrame:
    """The documents that score under ``threshold``, all columns as they came.

    A worker remembers the values of up to twice ``remembered`` words; fewer take less room and more time, and give the same.
    """
    return scored(docs, replace(model, remembered=remembered), docs.columns, text).filter(F.col("score") < threshold).select("carried.*")
