"""Chat formatting: tool calls linked to their results, in an order that respects what refers to what, as canonical JSON.

Calls and results meet in a hash join on conversation and identifier. An argument {"$result": ID} refers to the result of
another call; calls are ordered level by level, a call's level being one more than those it refers to. Everything is
DataFrame functions; arguments are read as variants, whose keys are sorted, so equal arguments give equal JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commuta.operators.lineage import written_table

#: Levels of what has no call to follow: messages come before the calls of their turn, the rest after all levels.
MESSAGE_LEVEL = -1
LAST_LEVEL = 1 << 30
REFERENCE = r'"\$result"\s*:\s*"([^"]+)"'
#: Kinds a schema may name, and the variant types each accepts.
KINDS = {
    "string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "boolean": "BOOLEAN",
    "object": "OBJECT.*", "array": "ARRAY.*",
}


def canonical(text: Column) -> Column:
    """JSON text with sorted keys and without spaces; null if it is not JSON."""
    return F.to_json(F.try_parse_json(text))


def _errors(arguments: Column, specs: Column) -> Column:
    """What is wrong with the arguments of a known tool, sorted and joined by ';'; 'valid' if nothing is."""
    values = arguments.try_cast("map<string,variant>")
    types = F.transform_values(values, lambda _, v: F.schema_of_variant(v))
    accepts = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])

    def of(spec: Column) -> Column:
        kind = F.element_at(types, spec["parameter"])
        wrong = ~kind.rlike("^OBJECT<`\\$result`: STRING>$") & ~F.regexp_like(kind, F.concat(F.lit("^"), F.coalesce(F.element_at(accepts, spec["kind"]), F.lit(".*")), F.lit("$")))
        return (
            F.when(kind.isNull() & spec["required"], F.concat(F.lit("missing:"), spec["parameter"]))
            .when(kind.isNotNull() & wrong, F.concat(F.lit("wrong_type:"), spec["parameter"]))
        )

    known = F.transform(specs, lambda s: s["parameter"])
    extra = F.transform(F.array_except(F.map_keys(types), known), lambda k: F.concat(F.lit("unexpected:"), k))
    found = F.array_sort(F.concat(F.filter(F.transform(specs, of), lambda e: e.isNotNull()), extra))
    return (
        F.when(arguments.isNull(), "bad_json").when(types.isNull(), "not_an_object")
        .when(F.size(found) == 0, "valid").otherwise(F.array_join(found, ";"))
    )


def _jumps(single: DataFrame) -> DataFrame:
    """Where the chain from each call with one reference first comes to a call with another number of them.

    ``single`` has ``conv_id``, ``call_id``, ``turn`` and ``ref``. Returns ``to``, ``steps`` and ``latest`` (turn on the way). Each round
    follows a jump with the jump from where it ends, so a chain takes as many rounds as its length has binary digits.
    Chains that run into a circle are left out.
    """
    key = ["conv_id", "call_id"]
    jumps = written_table(single.select(*key, F.col("ref").alias("to"), F.lit(1).alias("steps"), F.col("turn").alias("latest")), "jumps")
    longest = single.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(longest.bit_length()):
        on = jumps.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("steps").alias("more"), F.col("latest").alias("later"))
        if jumps.join(on, ["conv_id", "to"], "left_semi").isEmpty():
            return jumps
        jumps = written_table(jumps.join(on, ["conv_id", "to"], "left").select(
            *key, F.coalesce("next", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.greatest("latest", "later").alias("latest"),
        ), "jumps")
    return jumps.join(single.select("conv_id", F.col("call_id").alias("to")), ["conv_id", "to"], "left_anti")


def _levels(calls: DataFrame) -> DataFrame:
    """``conv_id``, ``call_id``, ``level`` and ``anchor`` (latest turn it waits for) of each call that is in no circle.

    Calls with one reference are skipped over first (``_jumps``). Each further round settles the calls all of whose references
    lead to settled ones, and is joined with those of the round before only: there are as many rounds as calls with several
    references follow one another. References to calls that do not exist hold nothing up.
    """
    refs = calls.select("conv_id", "call_id", "turn", F.explode(F.array_distinct(F.regexp_extract_all("arguments", F.lit(REFERENCE), F.lit(1)))).alias("ref"))
    there = calls.select("conv_id", F.col("call_id").alias("ref"))
    refs = written_table(refs.join(there, ["conv_id", "ref"], "left_semi"), "refs")
    key = ["conv_id", "call_id"]
    counted = written_table(refs.groupBy(*key).agg(F.count(F.lit(1)).alias("refs")), "counts")
    single = refs.join(counted.filter("refs = 1"), key, "left_semi")
    jumps = _jumps(single)
    new = written_table(calls.join(counted, key, "left_anti").select(*key, F.lit(0).alias("level"), F.col("turn").alias("anchor")), "settled")
    levels = [new]
    # References of the other calls, each led on to a call that is not skipped over, or nowhere if it runs into a circle.
    over = single.select("conv_id", F.col("call_id").alias("ref"), F.lit(True).alias("skipped")).join(
        jumps.select("conv_id", F.col("call_id").alias("ref"), "to", "steps", "latest"), ["conv_id", "ref"], "left"
    )
    several = refs.join(counted.filter("refs > 1"), key, "left_semi").join(over, ["conv_id", "ref"], "left")
    waiting = written_table(several.select(
        *key, F.when(F.col("skipped"), F.col("to")).otherwise(F.col("ref")).alias("to"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps"),
        F.greatest("turn", "latest").alias("latest"), F.lit(None).cast("int").alias("level"), F.lit(None).cast(new.schema["anchor"].dataType).alias("anchor"),
    ), "waiting")
    while not waiting.isEmpty():
        on = new.select("conv_id", F.col("call_id").alias("to"), F.col("level").alias("_level"), F.col("anchor").alias("_anchor"))
        waiting = written_table(waiting.join(on, ["conv_id", "to"], "left").select(
            *key, "to", "steps", "latest", F.coalesce("level", "_level").alias("level"), F.coalesce("anchor", "_anchor").alias("anchor"),
        ), "waiting")
        new = written_table(
            waiting.groupBy(*key).agg(
                F.count(F.lit(1)).alias("refs"), F.count("level").alias("found"), F.max(F.col("level") + F.col("steps")).alias("level"),
                F.max(F.greatest("latest", "anchor")).alias("anchor"),
            ).filter("refs = found").select(*key, F.col("level").cast("int").alias("level"), "anchor"), "settled"
        )
        if new.isEmpty():
            break  # the rest refer to one another in a circle
        levels.append(new)
        waiting = waiting.join(new, key, "left_anti")
    out = levels[0]
    for part in levels[1:]:
        out = out.unionByName(part)
    ends = out.select("conv_id", F.col("call_id").alias("to"), F.col("level").alias("_level"), F.col("anchor").alias("_anchor"))
    skipped = jumps.join(ends, ["conv_id", "to"]).select(
        *key, (F.col("_level") + F.col("steps")).cast("int").alias("level"), F.greatest("latest", "_anchor").alias("anchor")
    )
    return out.unionByName(skipped)


def format_chats(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row of canonical JSON for every message, call and result.

    ``messages``: ``conv_id``, ``turn``, ``role``, ``content``, ``tool_calls`` (array of struct ``id``, ``name``,
    ``arguments``), ``tool_call_id`` (for role ``tool``). ``schemas``: ``tool``, ``parameter``, ``kind``, ``required``; a
    tool without parameters has a row with a null parameter. Further columns are ignored.

    Returns ``conv_id``, ``anchor``, ``level``, ``step``, ``turn``, ``place`` (in this order the rows of a conversation
    are topologically sorted: calls follow the results they refer to, results their calls), ``kind`` (message, call,
    result), ``call_id``, ``status`` and ``json``. A call's status is ``valid``, or what is wrong with it (``bad_json``,
    ``not_an_object``, ``unknown_tool``, ``missing:P``, ``wrong_type:P``, ``unexpected:P``, joined by ';'), with
    ``repeated_id`` for an identifier used before in the conversation, ``cycle`` for a call that waits for itself, and
    ``+unanswered`` added when no result has come. A result's status is ``linked`` (the first for its call),
    ``repeated`` or ``orphan``; orphans and cycles come last in their turn. Null ids never meet. Repeated rows are returned
    repeated. Messages are not shuffled; an identifier that a large part of the rows share is joined with one row.
    """
    speech = messages.filter(~F.col("role").eqNullSafe("tool"))
    tools = messages.filter("role = 'tool'").select("conv_id", "turn", F.col("tool_call_id").alias("call_id"), "content")
    opened = speech.select("conv_id", "turn", F.posexplode("tool_calls").alias("place", "call"))
    raw = written_table(opened.select(
        "conv_id", "turn", "place", F.col("call.id").alias("call_id"), F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments"),
    ), "calls")
    key = ["conv_id", "call_id"]
    first = raw.filter("conv_id is not null and call_id is not null").groupBy(*key).agg(F.min(F.struct("turn", "place", "name", "arguments")).alias("c"))
    unique = written_table(first.select(*key, "c.turn", "c.place", "c.name", "c.arguments"), "unique")
    levels = written_table(_levels(unique), "levels")

    answered = written_table(tools.filter("conv_id is not null and call_id is not null").groupBy(*key).agg(
        F.min(F.struct("turn", F.xxhash64("content").alias("body"))).alias("answer")
    ).join(unique.select(*key), key, "left_semi"), "answered")

    specs = schemas.groupBy(F.col("tool").alias("name")).agg(
        F.array_sort(F.collect_list(F.when(F.col("parameter").isNotNull(), F.struct("parameter", "kind", "required")))).alias("specs")
    )
    parsed = F.try_parse_json("arguments")
    checked = F.when(F.col("specs").isNull(), "unknown_tool").otherwise(_errors(parsed, F.col("specs")))
    placed = levels.select(*key, "level", "anchor")
    owner = unique.select(*key, F.col("turn").alias("first_turn"), F.col("place").alias("first_place"))
    calls = (
        raw.join(specs, "name", "left").withColumn("checked", checked)
        .join(owner, key, "left").join(placed, key, "left").join(answered, key, "left")
    )
    repeated = ~((F.col("turn") == F.col("first_turn")) & (F.col("place") == F.col("first_place")))
    status = (
        F.when(F.col("first_turn").isNull(), F.concat(F.col("checked"), F.lit("+unanswered")))
        .when(repeated, "repeated_id").when(F.col("level").isNull(), "cycle")
        .when(F.col("answer").isNull(), F.concat(F.col("checked"), F.lit("+unanswered"))).otherwise(F.col("checked"))
    )
    in_order = F.col("level").isNotNull() & ~F.coalesce(repeated, F.lit(True))
    call_json = F.when(
        parsed.isNotNull(), F.to_json(F.struct(parsed.alias("arguments"), F.col("call_id").alias("id"), "name"))
    ).otherwise(F.to_json(F.struct(F.col("call_id").alias("id"), "name", F.col("arguments").alias("raw"))))

    def row(anchor: Column, level: Column, step: int, place: Column, kind: str, status: Column, json: Column, call_id: Column) -> list[Column]:
        return [
            F.col("conv_id"), anchor.alias("anchor"), level.cast("int").alias("level"), F.lit(step).alias("step"), F.col("turn"),
            place.cast("int").alias("place"), F.lit(kind).alias("kind"), call_id.alias("call_id"), status.alias("status"), json.alias("json"),
        ]

    none = F.lit(None).cast("string")
    said = speech.select(*row(
        F.col("turn"), F.lit(MESSAGE_LEVEL), 0, F.lit(0), "message", F.lit("said"), F.to_json(F.struct("content", "role", "turn")), none
    ))
    called = calls.select(*row(
        F.when(in_order, F.col("anchor")).otherwise(F.col("turn")), F.when(in_order, F.col("level")).otherwise(F.lit(LAST_LEVEL)),
        1, F.col("place"), "call", status, call_json, F.col("call_id"),
    ))
    best = (F.col("turn") == F.col("answer.turn")) & (F.xxhash64("content") == F.col("answer.body"))
    linked = tools.join(answered, key, "left").join(placed, key, "left")
    results = linked.select(*row(
        F.coalesce("anchor", "turn"), F.coalesce("level", F.lit(LAST_LEVEL)), 2, F.lit(0), "result",
        F.when(F.col("answer").isNull(), "orphan").when(best, "linked").otherwise("repeated"),
        F.to_json(F.struct("content", F.lit("tool").alias("role"), F.col("call_id").alias("tool_call_id"))), F.col("call_id"),
    ))
    return said.unionByName(called).unionByName(results)
