"""Words past ASCII and long words, in the fit as in scoring."""

from commuta.llm import toxicity


def symbols(word):
    return [int(toxicity._SYMBOL[b]) for b in word]


def test_format_characters_do_not_split_or_gap_words():
    for c in "\u200b\u200c\u200d\u2060\ufeff\xad\u202e":
        assert toxicity.words(f"idi{c}ot") == {b"idiot"}


def test_letters_fold_and_spaces_split():
    assert toxicity.words("ＩＤＩＯＴ \U0001d422\U0001d41d\U0001d422\U0001d428\U0001d42d ⓘⓓⓘⓞⓣ idi\u0305ot") == {b"idiot"}
    assert toxicity.words("ne\u0301e ĀB") == {b"n\xe9e", b"ab"}
    assert toxicity.words("one\u3000two\xa0three\u2003four") == {b"one", b"two", b"three", b"four"}
    assert toxicity.windows(toxicity.one_byte("„idiot“…")) == [b"idiot"] and toxicity.one_byte("idi–ot") == b"idi-ot"


def test_other_scripts_are_letters():
    for word in ("дурак", "کودن", "म\u0942र\u094dख", "傻瓜笨蛋", "ಮೂರ\u0ccdಖ", "ηλίθιε", "Ἀχιλλεύς", "바보"):
        (made,) = toxicity.words(word)
        assert len(made) >= 3 and all(27 <= s < toxicity.FIRST for s in symbols(made)), word
    assert toxicity.words("дурак") != toxicity.words("добро")
    for code in [*range(0x100, 0xD800), *range(0xE000, 0x30000)]:
        c = chr(code)
        if c.isalpha():
            assert not set(toxicity.one_byte(c)) & set(b" \t\n\r\x0b\x0c"), hex(code)


def test_other_scripts_are_learnt(spark):
    insults, nice = ("ты дурак {}", "you {} mouron"), "спасибо тебе друг {}"
    rows = [(k, (insults[0] if k % 3 == 0 else nice).format("слово " * (k % 7))) for k in range(90)]
    rows += [(1000, "ты ду\u200bрак"), (1001, "тебе слово")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(90)], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model, ["doc_id"]).select("carried.doc_id", "score").collect()}
    assert got[0] > 0.7 and got[1000] > 0.7 and got[1] < 0.3 and got[1001] < 0.3


def test_long_words_are_learnt(spark):
    long = "donaudampfschiffvollpfosten", "donaudampfschifffahrtswitwe"
    rows = [(k, f"{long[0 if k % 3 == 0 else 1]} word {'more ' * (k % 5)}") for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(90)], "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.scored(docs, model, ["doc_id"]).select("carried.doc_id", "score").collect()}
    assert got[0] > 0.7 and got[1] < 0.3
