"""Secret scans: three patterns, and character Markov models of random strings against ordinary identifiers.

Everything here is DataFrame and SQL functions. Matches of a pattern are placed without a search for positions: the text
is split at the pattern, and the lengths of the pieces between the matches add up to where each match begins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The kinds in order, and the pattern of each. (?i: ) holds for A-Z alone.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Only maximal runs can match here, so a run that is too short holds no later match of its own.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

#: Letters of the Markov models, and the runs they judge.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
RUN = r"[A-Za-z0-9+/=_-]{16,}"
#: A run is taken for random if the log-likelihood ratio is at least this in all, and at least this for each letter.
LEAST_RATIO = 12.0
LEAST_MEAN = 0.4
LEAST_LETTERS = 8
#: Bound of the fit: documents read for each class.
SAMPLE_DOCS = 2000

_FOUND = "cast(array() as array<struct<start:int,end:int,kind:int,m:string>>)"


def _spans(text: Column, pattern: str, kind: int, fits: Column | None = None) -> Column:
    """The spans of leftmost matches that do not overlap, start and end in code points; ``fits`` filters the column m."""
    lit = F.lit(pattern)
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, lit, 0)
    both = F.arrays_zip(between.alias("gap"), found.alias("m"))  # one gap more than matches

    def place(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["m"].alias("m"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.expr(_FOUND).alias("spans"))
    placed = F.aggregate(both, empty, place, lambda state: state["spans"])
    real = F.filter(placed, lambda s: s["m"].isNotNull() & (fits(s["m"]) if fits is not None else F.lit(True)))
    return F.when(text.rlike(pattern), real).otherwise(F.expr(_FOUND))


def _assigned(m: Column) -> Column:
    """The value of an assignment: group 2 of the pattern, the run of value letters that ends the match."""
    return F.regexp_extract(m, f"^{ASSIGN}", 1)


def base_spans(text: Column) -> Column:
    """Spans of the three patterns by start, then kind."""
    found = F.concat(
        _spans(text, ASSIGN, 0, lambda m: F.length(_assigned(m)) >= LEAST_VALUE), _spans(text, ACCESS, 1), _spans(text, HEX, 2)
    )
    return F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))


@dataclass
class Markov:
    """Log-likelihood ratio, random against ordinary, of a letter after a letter: row 0 for the first letter, then row by row."""

    ratios: list[float]


def _letters(run: Column) -> Column:
    return F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _steps(run: Column) -> Column:
    """Each letter with the one before it, as numbers from 1; 0 stands before the first."""
    letters = _letters(run)
    return F.arrays_zip(F.concat(F.array(F.lit(0)), letters).alias("before"), letters.alias("letter"))


def _counts(strings: DataFrame) -> dict[tuple[int, int], int]:
    """How often each letter follows each: a row for each pair of letters comes to the driver."""
    steps = strings.select(F.explode(_steps(F.col("s"))).alias("x")).select("x.before", "x.letter").filter("letter > 0")
    return {(r.before, r.letter): r["count"] for r in steps.groupBy("before", "letter").count().collect()}


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> Markov:
    """Fit both models to labelled samples of at most ``sample_docs`` documents of quality 1, chosen by a hash of their ids.

    Ordinary: the words and identifiers of these documents outside the three patterns. Random: what the patterns find
    there, and digests of the ids written in base 16 and 64. Without labelled documents nothing is ever found random.
    """
    chosen = (
        labels.filter("quality = 1").select(F.col(id).alias("label_id")).filter("label_id is not null").distinct()
        .orderBy(F.xxhash64("label_id"), "label_id").limit(sample_docs)
    )
    sample = docs.select(F.col(id).alias("id"), F.col(text).alias("body")).join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
    plain = F.regexp_replace("body", f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    ordinary = sample.select(F.explode(F.regexp_extract_all(plain, F.lit("[A-Za-z][A-Za-z0-9_-]{3,}"), F.lit(0))).alias("s"))
    values = [F.regexp_extract_all("body", F.lit(ASSIGN), F.lit(1)), F.regexp_extract_all("body", F.lit(f"{ACCESS}|{HEX}"), F.lit(0))]
    digest = F.sha2(F.concat(F.lit("sample:"), F.col("label_id").cast("string")), 256)
    coded = F.base64(F.unhex(digest))
    made = F.array(digest, coded, F.upper(coded), F.translate(coded, "+/", "-_"))
    random = chosen.select(F.explode(made).alias("s"))
    for v in values:
        random = random.unionByName(sample.select(F.explode(F.filter(v, lambda x: F.length(x) >= 16)).alias("s")))
    seen = [_counts(random), _counts(ordinary)]
    n = len(ALPHABET)
    ratios = []
    for before in range(n + 1):
        totals = [sum(c.get((before, k), 0) for k in range(1, n + 1)) for c in seen]
        for letter in range(1, n + 1):
            p = [(c.get((before, letter), 0) + 0.5) / (total + 0.5 * n) for c, total in zip(seen, totals, strict=True)]
            ratios.append(math.log(p[0] / p[1]))
    return Markov(ratios if all(seen) else [-1.0] * len(ratios))


def ratio(run: Column, model: Markov) -> Column:
    """Log-likelihood ratio of a run of ALPHABET, random against ordinary."""
    table = F.from_json(F.lit("[" + ",".join(f"{x:.6f}" for x in model.ratios) + "]"), "array<double>")  # folded to one literal
    add = lambda total, x: total + F.when(x["letter"] > 0, F.element_at(table, x["before"] * len(ALPHABET) + x["letter"])).otherwise(0.0)
    return F.aggregate(F.filter(_steps(run), lambda x: x["letter"].isNotNull()), F.lit(0.0), add)


def all_spans(text: Column, model: Markov) -> Column:
    """Base spans, and the runs that the models take for random and that no base span touches."""
    base = base_spans(text)

    def is_random(m: Column) -> Column:
        enough = F.greatest(F.lit(LEAST_RATIO), F.length(m) * LEAST_MEAN)
        mixed = m.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(m, ""))) >= LEAST_LETTERS)  # numbers alone are no secrets
        return mixed & (ratio(m, model) >= enough)

    found = F.transform(_spans(text, RUN, 3, is_random), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    alone = F.filter(found, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.array_sort(F.concat(base, alone))


def find_secrets(docs: DataFrame, model: Markov, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` of every whole text: an array of ``kind``, ``start``, ``end`` (code points, end exclusive).

    Kinds are those of KINDS; spans stand by start, then kind. A null text counts as empty; null ids and repeated rows are
    returned as they come. Only ``id`` and ``text`` are read, and nothing is shuffled.
    """
    names = F.array(*[F.lit(k) for k in KINDS])
    named = lambda s: F.struct(F.element_at(names, s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id).alias("doc_id"), F.transform(all_spans(body, model), named).alias("spans"))
