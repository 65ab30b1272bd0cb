"""The pipeline's stages, one by one and together."""

import subprocess
import sys
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from commuta.llm import decontaminate, simhash, toxicity
from commuta.llm.queries import QUERIES, SQL
from commuta.operators.lineage import written_table

STAGES = dict(corpus_pipeline.STAGES)


def test_stage_names_and_queries():
    import __spark_entry__ as entry_points

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "decontamination", "tokens"]
    names = list(entry_points.queries())
    assert [n for n in range(1, 14) if sum(q.startswith(f"op{n}_") for q in names) != 1] == [] and "pipeline" in names
    assert set(SQL) == {"op2_exact_dedup", "op3_decontamination", "op4_chat_formatting", "op8_extendible_sharding", "op10_warc_fixity", "op11_spelling_variants", "op12_merkle_manifest", "op13_circulant_minhash"} <= set(QUERIES)


def test_library_does_not_need_the_corpus_operators():
    code = (
        "import sys\nclass No:\n def find_spec(s, name, *a):\n  if name in ('corpus_pipeline', 'commuta.llm') or name.startswith('commuta.llm.'):\n"
        "   raise ModuleNotFoundError(name, name=name)\nsys.meta_path.insert(0, No())\nimport __spark_entry__ as e\n"
        "assert len(e.queries()) > 100 and 'pipeline' not in e.queries() and set(e.oracle_sql()) == set(e.queries())"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


@pytest.mark.parametrize("package", ["public_tokenizers", "ahocorasick", "xxhash", "regex"])
def test_library_does_not_need_their_packages(package):
    code = (
        f"import sys\nclass No:\n def find_spec(s, name, *a):\n  if name == '{package}':\n   raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, No())\nimport __spark_entry__ as e\nassert len(e.queries()) > 100 and 'pipeline' not in e.queries()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage returns on a whole table, written and read again."""
    sf_dir = "/root/testdata/sf0.01"
    out, docs = [], spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs, docs := written_table(stage(spark, docs, sf_dir)), sf_dir))
    return {name: (before, after, sf_dir) for name, before, after, sf_dir in out}


def jaccard(a, b):
    x, y = set(simhash.shingles(a, 5)), set(simhash.shingles(b, 5))
    return len(x & y) / max(1, len(x | y))


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_columns(steps):
    for name, (before, after, _) in steps.items():
        if name != "tokens":
            assert after.dtypes == before.dtypes and 0 < after.count() < before.count(), name


def test_toxicity_stage(spark, steps):
    before, after, sf_dir = steps["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~toxicity.held_out()))
    score = dict(zip(rows(before), model.scores([r.text for r in rows(before).values()]).tolist(), strict=True))
    assert set(rows(after)) == {d for d, s in score.items() if s < 0.7}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert not [d for d in rows(before) if d not in rows(after) and labels.get(d) == 0]


def test_exact_stage(steps):
    before, after, _ = steps["exact dedup"]
    last = {}
    for d, r in rows(before).items():
        last[r.text] = max(last.get(r.text, d), d)
    assert set(rows(after)) == set(last.values()) and all(rows(before)[d] == r for d, r in rows(after).items())


def test_near_stage_leaves_unlike_texts(steps):
    before, after, _ = steps["near dedup"]
    all_, kept = rows(before), rows(after)
    gone = [d for d in all_ if d not in kept]
    for d in gone:
        assert max(jaccard(all_[d].text, r.text) for k, r in all_.items() if k != d) >= 0.8, d
    texts = list(kept.values())
    words = [set(r.text.split()) for r in texts]
    for i, a in enumerate(texts):
        for j in range(i):
            if len(words[i] & words[j]) > 0.8 * min(len(words[i]), len(words[j])) and len(words[i]) > 30:
                assert jaccard(a.text, texts[j].text) < 0.8


def test_decontamination_stage(spark, steps):
    before, after, sf_dir = steps["decontamination"]
    windows = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        w = decontaminate.words(r.text)
        windows |= {tuple(w[k : k + 13]) for k in range(max(1, len(w) - 12))} - {()}
    for d, r in rows(before).items():
        w, hit = decontaminate.words(r.text), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
        assert (d in rows(after)) == (not hit or 20 * len(hit) < len(w)), d


def test_token_stage_and_run(spark, steps):
    before, after, sf_dir = steps["tokens"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {d: r.text for d, r in rows(before).items()}
    for d, r in rows(after).items():
        assert r.text == texts[d] and r.n_tokens == len(r.ids) and r.ids == library.encode(r.text, add_special_tokens=False).ids
    got = corpus_pipeline.run(spark, sf_dir)
    assert Counter(r.doc_id for r in got.collect()) == Counter(list(rows(after))) and got.columns == after.columns


AWKWARD = [
    (1, "plain text of some words", "en", "a", 5, "x"), (1, "plain text of some words", "en", "a", 5, "x"), (None, "no id at all", None, None, None, None),
    (None, None, None, None, None, None), (2, None, "en", "b", 0, "y"), (3, "", "de", "c", 0, "z"), (4, "long word " * 40_000, "en", "d", 1, "l"),
    (5, "x" * 100_000, "en", "e", 1, "m"), (6, "plain text of some words", "en", "f", 5, "twin"), (7, "<|endoftext|> 🙂 \x00 é", "fr", "g", 3, None),
]
EXTRA = ["n_tokens", "carried", "body", "open", "fingerprint", "score", "matches", "doc", "id", "rows", "a.b", "digest", "size", "goes", "made"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
AWKWARD = [(*r[:5], *[r[5]] * len(EXTRA)) for r in AWKWARD]


@pytest.mark.parametrize("name", list(STAGES))
def test_awkward_rows(spark, sf_dir, name):
    docs = spark.createDataFrame(AWKWARD, SCHEMA)
    out = STAGES[name](spark, docs, sf_dir)
    got = out.collect()
    assert spark.createDataFrame([], docs.schema).count() == STAGES[name](spark, docs.limit(0), sf_dir).count() == 0
    if name == "tokens":
        assert Counter(r.doc_id for r in got) == Counter(r[0] for r in AWKWARD)
        assert Counter(r.text for r in got) == Counter(r[1] or "" for r in AWKWARD)
        return
    assert out.columns == docs.columns
    kept = Counter(tuple(r) for r in got)
    assert set(kept) <= set(AWKWARD)
    if name in ("toxicity", "decontamination"):
        assert kept == Counter(AWKWARD)
    else:
        assert max(kept.values()) == 1
        texts = [r.text or "" for r in got]
        assert len(texts) == len(set(texts)) and (name != "exact dedup" or set(texts) == {r[1] or "" for r in AWKWARD})
