"""Tables for the queries that need more than the given ones hold; all are derived from those by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tools and their parameters.
TOOLS = [
    ("search", "query", "string", True), ("search", "limit", "integer", False), ("lookup", "key", "string", True),
    ("convert", "value", "number", True), ("convert", "unit", "string", True),
]

#: Calls of an assistant's turn, as SQL that Spark and DuckDB both read: number k, identifier, tool, arguments.
N_CALLS = "(conv_id + turn) % 3"
CALL_ID = "concat('c', cast(conv_id as varchar(20)), '-', cast(turn as varchar(20)), '-', cast(k as varchar(20)))"
TOOL = "case (conv_id + turn + 2 * k) % 4 when 0 then 'search' when 1 then 'lookup' when 2 then 'convert' else 'oracle' end"
_CONV = "cast(conv_id as varchar(20))"
ARGUMENTS = f"""case (conv_id + turn + 2 * k) % 4
  when 0 then case
    when n % 7 = 0 then concat('{{"query": "q', cast(turn as varchar(20)), '", "limit": "ten"}}')
    when n % 2 = 0 and k = 0 and turn >= 3 then concat('{{"query": {{"$result": "c', {_CONV}, '-', cast(turn - 2 as varchar(20)), '-0"}}, "limit": ', cast(n % 50 as varchar(20)), '}}')
    else concat('{{"query" : "q', cast(turn as varchar(20)), '",  "limit": ', cast(n % 50 as varchar(20)), ' }}') end
  when 1 then case when n % 11 = 0 then '{{"key": ' when n % 3 = 0 then concat('{{"key": ', cast(n % 10 as varchar(20)), '}}')
    else concat('{{"key": "k', cast(n % 10 as varchar(20)), '"}}') end
  when 2 then case
    when k = 1 then concat('{{"value": {{"$result": "c', {_CONV}, '-', cast(turn as varchar(20)), '-0"}}, "unit": "km"}}')
    when n % 5 = 0 then '{{"unit": "km"}}' when n % 4 = 0 then '{{"value": 1.5, "unit": "km", "extra": true}}' else '{{"value": 2, "unit": "mi"}}' end
  else '{{}}' end"""


def tool_chats(conversations: DataFrame) -> DataFrame:
    """The given conversations with tool calls in assistants' turns, and results for most: some early, repeated or lost."""
    sized = conversations.withColumn("n", F.length("text"))
    calls = F.expr(
        f"case when role = 'assistant' and {N_CALLS} > 0 then transform(sequence(0, cast({N_CALLS} - 1 as int)), k -> "
        f"named_struct('id', {CALL_ID}, 'name', {TOOL}, 'arguments', {ARGUMENTS})) end"
    )
    none = F.lit(None).cast("string")
    said = sized.select("conv_id", "turn", "role", F.col("text").alias("content"), calls.alias("tool_calls"), none.alias("tool_call_id"))
    made = sized.filter("role = 'assistant'").withColumn("k", F.explode(F.expr(
        f"case when {N_CALLS} > 0 then sequence(0, cast({N_CALLS} - 1 as int)) else cast(array() as array<int>) end"
    ))).withColumn("id", F.expr(CALL_ID))
    late = F.expr("case when k = 1 then greatest(turn - 1, 0) else turn + 1 end")
    answers = made.filter("(conv_id + turn + k) % 5 <> 0").select("conv_id", late.alias("turn"), F.concat(F.lit("result of "), "id").alias("content"), "id")
    again = made.filter("(conv_id + turn) % 17 = 0").select("conv_id", (F.col("turn") + 2).alias("turn"), F.concat(F.lit("again "), "id").alias("content"), "id")
    lost = sized.filter("role = 'assistant' and (conv_id * 7 + turn) % 13 = 0").select(
        "conv_id", "turn", F.lit("lost").alias("content"), F.expr("concat('lost-', cast(conv_id as varchar(20)))").alias("id")
    )
    tools = answers.unionByName(again).unionByName(lost).select(
        "conv_id", "turn", F.lit("tool").alias("role"), "content", F.lit(None).cast(said.schema["tool_calls"].dataType).alias("tool_calls"),
        F.col("id").alias("tool_call_id"),
    )
    return said.unionByName(tools)


def worn_body() -> Column:
    """A page's body in a worn copy: some have a wrong first letter."""
    return F.when(F.expr("page_id * 7919 % 211 = 5"), F.concat(F.lit("?"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))


def lost_page() -> Column:
    """Whether a page is missing in a worn copy."""
    return F.coalesce(F.expr("page_id * 104729 % 389 = 7"), F.lit(False))
