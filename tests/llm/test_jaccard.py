"""Near-duplicates by exact similarity against Jaccard similarities of all pairs."""

import random
from itertools import combinations

import pytest

import corpus_pipeline
from commuta.llm import jaccard, simhash


def similar_at(a, b, size=5):
    x, y = set(simhash.shingles(a, size)), set(simhash.shingles(b, size))
    return 5 * len(x & y) >= 4 * len(x | y) if x and y else not x and not y


def expected(rows):
    """The smallest id of each class that links at 0.8 and more make, from all pairs."""
    root = {d: d for d, _ in rows}

    def up(d):
        while root[d] != d:
            d = root[d]
        return d

    for (a, s), (b, t) in combinations(rows, 2):
        if similar_at(s, t):
            a, b = up(a), up(b)
            root[max(a, b)] = min(a, b)
    return {up(d) for d, _ in rows}


def versions(draw, base, vocabulary, changes):
    out = list(base)
    for at in draw.sample(range(len(base)), changes):
        out[at] = draw.choice(vocabulary)
    return " ".join(out)


def near_the_threshold(seed):
    """Pairs on both sides of 0.8, short texts, texts of one set, and texts without words."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts = ["", None, " ", "one", "One", "one two three", "a b c d e", "a b c d e a b c d e"]
    for _ in range(120):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([20, 100, 200]))]
        texts += [" ".join(base), versions(draw, base, vocabulary, max(1, len(base) * draw.choice([2, 3, 4, 5]) // 200))]
    for _ in range(60):  # one side longer
        base = [draw.choice(vocabulary) for _ in range(104)]
        texts += [" ".join(base), " ".join(base + [draw.choice(vocabulary) for _ in range(draw.randrange(20, 30))])]
    draw.shuffle(texts)
    return list(enumerate(texts))


def kept(spark, rows, stage):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id for r in stage(docs).collect()}


@pytest.fixture(scope="module")
def threshold(spark):
    rows = near_the_threshold(1)
    return expected(rows), kept(spark, rows, lambda docs: corpus_pipeline.near_stage(spark, docs, ""))


def test_nothing_goes_without_a_link_at_the_threshold(threshold):
    stays, got = threshold
    assert not stays - got


def test_every_pair_at_the_threshold_and_above_is_found(threshold):
    stays, got = threshold
    assert not got - stays


@pytest.mark.parametrize("pairs_a_row", [0, 1 << 30])
def test_hot_group_and_common_passage(spark, monkeypatch, pairs_a_row):
    monkeypatch.setattr(jaccard, "PAIRS_A_ROW", pairs_a_row)
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = [draw.choice(vocabulary) for _ in range(120)]
    texts = [versions(draw, base, vocabulary, draw.randrange(6)) for _ in range(150)]
    texts += [" ".join(base[:100] + [draw.choice(vocabulary) for _ in range(draw.randrange(10, 60))]) for _ in range(100)]
    texts += [" ".join(draw.choice(vocabulary) for _ in range(80)) for _ in range(40)]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    assert kept(spark, rows, jaccard.drop_near_duplicates) == expected(rows)


def test_no_rows(spark):
    assert kept(spark, [], jaccard.drop_near_duplicates) == set()


def sets_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = jaccard.written_table(jaccard.shingle_sets(docs, ["doc_id"], "text", 5), "sets")
    return sets, {r.doc_id: r.fingerprint for r in sets.select("carried.doc_id", "fingerprint").collect()}


def test_tries_propose_and_every_proposal_is_verified(spark, monkeypatch):
    draw = random.Random(6)
    words = [f"w{k}" for k in range(3000)]
    base = [draw.choice(words) for _ in range(400)]
    alike = [" ".join(base), " ".join(["zz", *base[1:]]), " ".join([*base[:-1], "zz"])]
    unlike = [" ".join(["x"] * 400 + [draw.choice(words) for _ in range(30)]) for _ in range(2)]  # of the same bits, by one shingle
    sets, named = sets_of(spark, [*alike, *unlike, " ".join(draw.choice(words) for _ in range(80))])
    classes = [{tuple(r) for r in jaccard.components(jaccard.proposed(sets), "a", "b").collect()}]
    groups = {}
    for node, root in classes[0]:
        groups.setdefault(root, set()).add(node)
    assert sorted(map(sorted, (g | {r} for r, g in groups.items()))) == sorted(map(sorted, ({named[k] for k in ks} for ks in ((0, 1, 2), (3, 4)))))

    walked = []
    monkeypatch.setattr(jaccard.simhash, "near_links", lambda prints, links=simhash.near_links: walked.append(prints.count()) or links(prints))
    stay = kept(spark, list(enumerate([*alike, *unlike])), lambda docs: corpus_pipeline.near_stage(spark, docs, ""))
    assert stay == {0, 3, 4} and len(walked) == 1


def test_pairs_with_too_little_left_are_not_formed(spark, monkeypatch):
    base = [f"b{k}" for k in range(80)]
    sets, _ = sets_of(spark, [" ".join([f"t{k}x{j}" for j in range(8)] + base + [f"t{k}y{j}" for j in range(3)]) for k in range(60)])
    formed = []
    monkeypatch.setattr(jaccard, "_pairs", lambda joined, pairs=jaccard._pairs: formed.append(joined.count()) or pairs(joined))
    assert jaccard.near_links(sets.drop("carried")).count() == 0 and sum(formed) == 0


def apart(n, shared=85, own=15):
    """Texts that share most of their words, and shingles of their prefixes, but stay under the threshold."""
    base = [f"b{k}" for k in range(shared)]
    return [" ".join(base + [f"t{k}x{j}" for j in range(own)]) for k in range(n)]


def test_prefixes_alone_are_written(spark, monkeypatch):
    tables = []
    write = jaccard.written_table
    monkeypatch.setattr(jaccard, "written_table", lambda df, name="table": tables.append((name, write(df, name))) or tables[-1][1])
    base = [f"c{k}" for k in range(100)]
    texts = [*apart(3), " ".join(base), " ".join(["zz", *base[1:]])]
    assert kept(spark, list(enumerate(texts)), jaccard.drop_near_duplicates) == {0, 1, 2, 3}
    sets = [t for name, t in tables if name == "sets"]
    assert len(sets) == 1 and sets[0].filter("size(keys) != n div 5 + 1").count() == 0


def test_a_shingle_of_few_sets_takes_one_turn(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS_A_ROW", 0)
    sets, _ = sets_of(spark, apart(3))
    turns = []
    monkeypatch.setattr(jaccard, "_pairs", lambda joined, pairs=jaccard._pairs: turns.append(1) or pairs(joined))
    assert jaccard.near_links(sets.drop("carried")).count() == 0 and len(turns) == 1
