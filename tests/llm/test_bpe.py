"""The backtracking encoder against the tokenizers library, and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from commuta.llm import bpe

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def codec():
    with open(FILE, encoding="utf-8") as f:
        return bpe.BytePairCodec(f.read())


def same(codec, library, text):
    ids = codec.encode(text).tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids, repr(text[:80])
    assert codec.decode(np.array(ids, np.int32)) == library.decode(ids, skip_special_tokens=False) == text


EDGES = [
    "", " ", "\n\n  \n", "a", "  two  spaces ", "don't we'll I've 'S", "<|endoftext|>", "x<|endoftext|><|endoftext|> y",
    "<|endoftext", "ÀÉîõü ñ ß", "日本語の文章。", "🙂👩‍👩‍👧 emoji", "\x00\x01\x1c\x1f\x85\u2028 \u3000x", "1234567890 3.14",
    "e\u0301\u0300", "aaaaaaaaaaaaaaaaaaaaaaaa" * 50, "=" * 3000, "ab" * 5000, "\t\t\tif x:\r\n\r\n",
]


@pytest.mark.parametrize("text", EDGES)
def test_edges(codec, library, text):
    same(codec, library, text)


def test_random_letters_long(codec, library):
    draw = random.Random(5)
    for alphabet in ("ab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "01", "äöüß", "的一是", "-=_*#", "aA1 \n'"):
        for n in (1, 2, 3, 7, 40, 400, 6000):
            same(codec, library, "".join(draw.choice(alphabet) for _ in range(n)))


def test_every_code_point_between_letters(codec, library):
    points = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 64):
        same(codec, library, "".join(f"a{c}b {c} 1" for c in points[k : k + 64]))


def test_every_token_spelled_alone(codec, library):
    texts = [codec.bytes[r] for r in range(256, len(codec.bytes), 7)]
    for t in texts:
        try:
            same(codec, library, t.decode("utf-8"))
        except UnicodeDecodeError:
            pass


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(codec, library, text):
    same(codec, library, text)


def test_cache_bounds(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 3)
    same(codec, library, " ".join(f"w{n}x" for n in range(50)))


def test_refuses_other_kinds():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        bpe.BytePairCodec(f.read())


def test_frames(spark, library):
    rows = [(1, "the cat", "x"), (2, None, None), (None, "", "y"), (2, None, None), (4, "long " * 30000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    made = bpe.encode(docs, FILE)
    assert made.columns == ["doc_id", "text", "ids"]
    back = bpe.decode(made, FILE).collect()
    assert len(back) == 5
    for r in back:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    both = bpe.round_trip(docs, FILE, decoded="text").collect()
    assert sorted((r.text, len(r.ids)) for r in both) == sorted((r.decoded, len(r.ids)) for r in back)
    assert bpe.encode(docs.limit(0), FILE).count() == 0


def test_query_on_a_whole_table(spark, sf_dir, library):
    import hashlib

    from commuta.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op5_bpe_round_trip"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
