"""The subsequence kernel against its definition, and held-out accuracy of the machine."""

from itertools import combinations

import numpy as np

from commuta.llm import toxicity
from commuta.llm.queries import QUERIES


def plain_features(word):
    symbols = [toxicity.FIRST, *(int(toxicity._SYMBOL[c]) for c in word), toxicity.LAST]
    out, norm = {}, 0.0
    for at in combinations(range(len(symbols)), toxicity.ORDER):
        code = tuple(symbols[x] for x in at)
        if toxicity.GAP not in code:
            weight = toxicity.DECAY ** (at[-1] - at[0] + 1)
            out[code] = out.get(code, 0) + weight
            norm += weight**2
    return {c: v / max(norm, 1e-24) ** 0.5 for c, v in out.items()}


def plain_kernel(s, t):
    a, b = plain_features(s), plain_features(t)
    return sum(v * b.get(c, 0) for c, v in a.items())


def test_kernel_by_definition():
    strings = [b"moron", b"m.o.r.o.n", b"moxron", b"mor0n", b"abc", b"---", b"aaaaa", toxicity.one_byte("NaÏve"), b"worthlessness"]
    landmarks = [b"moron", b"aaaa", b"worthless"]
    got = toxicity.kernel(strings, landmarks)
    assert np.allclose(got, [[plain_kernel(s, t) for t in landmarks] for s in strings], atol=1e-6)
    assert got[1, 0] > 0.8 * got[0, 0] and got[0, 0] > got[2, 0] > 4 * got[4, 0]


def test_folded_weights_equal_the_nystroem_machine(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    found = [b"idiot", b"idi-ot", b"thonder", b"of"]
    got = model.values(found)
    assert got[0] > got[1] > 0 > got[2] and got[3] == model.bias
    gram = toxicity.kernel(model.landmarks, model.landmarks)
    assert np.allclose(gram, gram.T) and np.linalg.eigvalsh(gram).min() > -1e-6


def test_words_and_windows():
    assert toxicity.words("i d i o t!") >= {b"idiot!"} and toxicity.words("É") == {b"\xe9"} and toxicity.words(None) == set()
    long = b"x" * 30 + b"worthless" + b"y" * 30
    assert any(b"worthless" in w for w in toxicity.windows(long)) and toxicity.windows(b"..") == []


def test_edges(spark):
    insults, nice = ("you idiot {}", "you moron {}"), "thank you dear friend {}"
    rows = [(k, (insults[k % 2] if k % 3 == 0 else nice).format("word " * (k % 7)), "x") for k in range(90)]
    rows += [(None, None, "n"), (1000, "", "e"), (1000, "", "e"), (1001, "you i d i o t", "s"), (1002, "you id-iot", "g"), (1003, "idiot " * 30000, "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(90)] + [(None, 1), (5, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model, ["doc_id"]).select("carried.doc_id", "score").collect()}
    assert got[0] > 0.9 and got[1] < 0.3 and got[1000] < 0.3 and got[None] < 0.3
    assert got[1001] > 0.7 and got[1002] > 0.7 and got[1003] > 0.7
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.filter("doc_id = 1000").count() == 2 and kept.filter("doc_id = 0").count() == 0
    assert toxicity.scored(docs.limit(0), model, ["doc_id"]).count() == 0


def test_one_class_or_no_labels(spark):
    docs = spark.createDataFrame([(k, f"word number {k}") for k in range(20)], "doc_id long, text string")
    for labels in ([], [(k, 0) for k in range(20)], [(k, 1) for k in range(20)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        scores = {r.score for r in toxicity.scored(docs, model, ["doc_id"]).collect()}
        assert len(scores) == 1 and (scores.pop() >= 0.7) == bool(labels and labels[0][1])


def test_held_out_accuracy(spark):
    import zlib

    sf_dir = "/root/testdata/sf0.1"
    found = QUERIES["op7_toxicity"](spark, sf_dir).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in found)
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    toxic, clean = [h for h in held if h[2]], [h for h in held if not h[2]]
    higher = sum((a[0] > b[0]) + 0.5 * (a[0] == b[0]) for a in toxic for b in clean) / (len(toxic) * len(clean))
    recall, wrong = sum(h[1] for h in toxic) / len(toxic), sum(h[1] for h in clean) / len(clean)
    print(f"AUC {higher:.4f} recall {recall:.4f} false alarms {wrong:.4f} of {len(clean)}")
    assert higher > 0.97 and recall > 0.7 and wrong < 0.01  # in this table few labels, and clean texts hold the rarer insults by chance
