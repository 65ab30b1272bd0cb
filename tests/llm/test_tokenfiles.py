"""Token files against whole-text encoding by the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from commuta.llm import tokenfiles

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def encoder():
    with open(FILE, encoding="utf-8") as f:
        return tokenfiles.WordEncoder(f.read())


def whole(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def same(encoder, library, texts):
    got = [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode_all(texts)]
    assert got == [whole(library, t) for t in texts]


def test_edges(encoder, library):
    assert encoder.by_word
    same(encoder, library, [
        None, "", " ", "a", "A  b\n\tC", "don't 'S we'LL", "<|endoftext|>x <|startoftext|>", "ΣΑΣ Σ ς", "e ́ é",
        "x y z\x85w\x1cv", "日本語 テキスト", "🙂👩‍👩‍👧", "ñ" * 300, "ab" * 4000, "\x00 \x01", "1234 5,6", "İ I ı",
    ])


def test_every_code_point_at_a_word_edge(encoder, library):
    points = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    same(encoder, library, ["".join(f"a{c} {c}b {c} a" for c in points[k : k + 64]) for k in range(0, len(points), 64)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_texts(encoder, library, texts):
    same(encoder, library, texts)


def test_cache_starts_anew(encoder, library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHED_WORDS", 2)
    monkeypatch.setattr(tokenfiles, "CACHED_BYTES", 4)
    same(encoder, library, ["alpha beta alpha", "beta b", "alphabet soup of the day"])


def test_files(spark, library, tmp_path):
    draw = random.Random(2)
    texts = [" ".join(draw.choice(["the", "cat", "sat", "Ünder", "x" * 40, "1.5"]) for _ in range(draw.randrange(60))) for _ in range(200)]
    rows = [(draw.randrange(-50, 10**12), t, k) for k, t in enumerate(texts)]
    rows += [(7, "again", 1), (7, "again", 1), (None, "no id", 2), (None, None, 3), (9, "word " * 20000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base int").repartition(5)
    folder = f"file://{tmp_path}/out"
    manifest = tokenfiles.write_token_files(docs, FILE, folder, end_id=2)
    got = tokenfiles.read_token_files(manifest).collect()
    assert len(got) == len(rows)
    expected = sorted((r[0] is not None, r[0] or 0, whole(library, r[1]) + [2]) for r in rows)
    read = sorted((g.doc_id is not None, g.doc_id or 0, np.frombuffer(g.ids, "<u4").tolist()) for g in got)
    assert read == expected
    ordered = sorted(got, key=lambda g: g.start)
    keys = [-1 << 63 if g.doc_id is None else g.doc_id for g in ordered]
    assert keys == sorted(keys)
    at = 0
    for g in ordered:
        assert g.start == at and g.n_tokens == len(g.ids) // 4
        at += g.n_tokens
    # The files by themselves, in the order of their names.
    names = sorted(p.stem for p in (tmp_path / "out").glob("part-*.bin"))
    flat = np.concatenate([np.fromfile(tmp_path / "out" / f"{n}.bin", "<u2") for n in names])
    assert flat.tolist() == [i for g in ordered for i in np.frombuffer(g.ids, "<u4").tolist()]
    assert not list((tmp_path / "out").glob("_*"))


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    manifest = tokenfiles.write_token_files(docs, FILE, str(tmp_path / "none"), end_id=2)
    assert manifest.count() == 0 and tokenfiles.read_token_files(manifest).count() == 0


def test_tokenizer_that_keeps_white_space(spark):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        keeps = tokenfiles.WordEncoder(f.read())
    assert not keeps.by_word
    got = np.frombuffer(keeps.encode_all(["two  words"])[0], keeps.dtype).tolist()
    assert got == keeps.library.encode("two  words", add_special_tokens=False).ids


def test_query_on_a_whole_table(spark, sf_dir, library):
    from commuta.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op6_token_files"](spark, sf_dir).collect()}
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    assert len(got) == len(docs)
    at = 0
    for d in docs:
        ids = np.array(whole(library, d.text) + [2], "<u4")
        g = got[d.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
