"""The registered queries of this subpackage and, where SQL can say it, the same as SQL."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commuta.llm import bpe, chat, decontaminate, exact, fixtures, merkle, minhash, secrets, sharding, simhash, sql, tokenfiles, toxicity, variants, warc
from commuta.operators.lineage import shared_folder, written_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(text: str | None = None):
    def put(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if text is not None:
            SQL[build.__name__] = text
        return build

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@registered()
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


@registered("""
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id is not distinct from max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)
    return found.withColumn("text_sha256", F.lower(F.hex("text_sha256")))


_FOLDED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _FOLDED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Contamination of each document as SQL; {documents} and {benchmark} are tables.
CONTAMINATION = f"""
words as (select doc_id, {_WORDS.format("text")} as w from {{documents}}),
item_words as (select item_id, {_WORDS.format("text")} as w from {{benchmark}}),
item_windows as (
  select distinct item_id, least(len(w), 13) as n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from item_words where len(w) > 0)),
sizes as (select distinct n from item_windows),
doc_windows as (
  select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from words, sizes where len(w) >= n)),
hits as (select doc_id, i, n, item_id from doc_windows join item_windows using (n, win)),
hit_words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
hit_items as (select doc_id, list_sort(list(distinct cast(item_id as varchar))) as items from hits group by doc_id)
"""


@registered("with " + CONTAMINATION.format(documents="documents", benchmark="benchmark") + """
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(len(items), 0) as n_items,
       sha256(coalesce(array_to_string(items, ','), '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from words left join hit_words using (doc_id) left join hit_items using (doc_id)
""")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    items = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return found.select(
        "carried.doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"),
    )


@registered()
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded="text")
    return made.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@registered()
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    manifest = tokenfiles.write_token_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder, end_id=2
    )
    return tokenfiles.read_token_files(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@registered()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    found = toxicity.scored(docs, model, ["doc_id"]).select("carried.doc_id", "score")
    return found.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


@registered()
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find_secrets(docs, secrets.fit(docs, table(spark, sf_dir, "labels")))

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(of("assign", "access", "hex")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


_MADE = "select c.*, length(text) as n, k from conversations c, unnest(range(0, " + fixtures.N_CALLS + ")) t(k) where role = 'assistant'"


@registered(f"""
with recursive made as (select *, {fixtures.CALL_ID} as id, {fixtures.TOOL} as name, {fixtures.ARGUMENTS} as args from ({_MADE})),
calls as (select m.*, o.id as ref from (select *, regexp_extract(args, '"\\$result": "([^"]+)"', 1) as wants from made) m
          left join made o on o.conv_id = m.conv_id and o.id = m.wants and m.wants <> ''),
levels as (
  select conv_id, id, turn, 0 as level, turn as anchor from calls where ref is null
  union all
  select c.conv_id, c.id, c.turn, l.level + 1, greatest(c.turn, l.anchor) from calls c join levels l on l.conv_id = c.conv_id and l.id = c.ref),
answers as (
  select conv_id, case when k = 1 then greatest(turn - 1, 0) else turn + 1 end as turn, 'result of ' || id as content, id, 'linked' as status
  from made where (conv_id + turn + k) % 5 <> 0
  union all
  select conv_id, turn + 2, 'again ' || id, id, case when (conv_id + turn + k) % 5 <> 0 then 'repeated' else 'linked' end from made where (conv_id + turn) % 17 = 0
  union all
  select conv_id, turn, 'lost', 'lost-' || conv_id, 'orphan' from conversations where role = 'assistant' and (conv_id * 7 + turn) % 13 = 0),
checked as (
  select *, case name when 'oracle' then 'unknown_tool'
    when 'search' then case when n % 7 = 0 then 'wrong_type:limit' else 'valid' end
    when 'lookup' then case when n % 11 = 0 then 'bad_json' when n % 3 = 0 then 'wrong_type:key' else 'valid' end
    else case when k = 1 then 'valid' when n % 5 = 0 then 'missing:value' when n % 4 = 0 then 'unexpected:extra' else 'valid' end end as status,
    case name when 'oracle' then '{{}}'
    when 'search' then case when n % 7 = 0 then '{{"limit":"ten","query":"q' || turn || '"}}'
      when n % 2 = 0 and k = 0 and turn >= 3 then '{{"limit":' || n % 50 || ',"query":{{"$result":"' || wants || '"}}}}'
      else '{{"limit":' || n % 50 || ',"query":"q' || turn || '"}}' end
    when 'lookup' then case when n % 3 = 0 then '{{"key":' || n % 10 || '}}' else '{{"key":"k' || n % 10 || '"}}' end
    else case when k = 1 then '{{"unit":"km","value":{{"$result":"' || wants || '"}}}}' when n % 5 = 0 then '{{"unit":"km"}}'
      when n % 4 = 0 then '{{"extra":true,"unit":"km","value":1.5}}' else '{{"unit":"mi","value":2}}' end end as canonical
  from calls)
select conv_id, turn as anchor, -1 as level, 0 as step, turn, 0 as place, 'message' as kind, null as call_id, 'said' as status,
       '{{"content":' || to_json(text) || ',"role":"' || role || '","turn":' || turn || '}}' as json from conversations
union all
select c.conv_id, l.anchor, l.level, 1, c.turn, c.k, 'call', c.id,
       c.status || case when (c.conv_id + c.turn + c.k) % 5 = 0 and (c.conv_id + c.turn) % 17 <> 0 then '+unanswered' else '' end,
       case when c.status = 'bad_json' then '{{"id":"' || c.id || '","name":"lookup","raw":' || to_json(c.args) || '}}'
            else '{{"arguments":' || c.canonical || ',"id":"' || c.id || '","name":"' || c.name || '"}}' end
from checked c join levels l using (conv_id, id)
union all
select a.conv_id, coalesce(l.anchor, a.turn), coalesce(l.level, {chat.LAST_LEVEL}), 2, a.turn, 0, 'result', a.id, a.status,
       '{{"content":"' || a.content || '","role":"tool","tool_call_id":"' || a.id || '"}}'
from answers a left join levels l using (conv_id, id)
""")
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = spark.createDataFrame(fixtures.TOOLS + [("oracle_of_old", None, None, None)], "tool string, parameter string, kind string, required boolean")
    return chat.format_chats(fixtures.tool_chats(table(spark, sf_dir, "conversations")), schemas)


@registered(f"""
with hashed as (
  select doc_id, strlen(coalesce(text, '')) as n_bytes,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 15) as bigint) as hash
  from documents),
levels as (select *, unnest(range(0, 41)) as depth from hashed),
sums as (select *, hash >> cast(60 - depth as int) as prefix, sum(n_bytes) over w as shard_bytes, count(*) over w as shard_docs
         from levels window w as (partition by depth, hash >> cast(60 - depth as int)))
select doc_id, case when depth = 0 then '' else lpad(bin(prefix), cast(depth as int), '0') end as shard, depth, n_bytes,
       cast(shard_bytes as bigint) as shard_bytes, shard_docs
from sums where shard_bytes <= {sharding.LIMIT_BYTES} or shard_docs = 1
qualify row_number() over (partition by doc_id order by depth) = 1
""")
def op8_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


@registered(f"""
with records as (
  select page_id, html, concat(E'WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:', page_id, E'>\r\nWARC-Target-URI: ', url,
         E'\r\nContent-Length: ', strlen(html), E'\r\n\r\n', html, E'\r\n\r\n') as record from pages),
summed as (select page_id, strlen(record) as length, sha256(record) as sha256,
                  cast(sum(strlen(record)) over (order by page_id rows unbounded preceding) as bigint) - strlen(record) as start from records),
filed as (select *, start // {warc.FILE_BYTES} as file from summed),
placed as (select *, start - min(start) over (partition by file) as offs from filed),
l1 as (select file, offs // {warc.RANGE} as node, sha256(string_agg(offs || ':' || length || ':' || sha256, ';' order by offs)) as hash from placed group by all),
l2 as (select file, node // {warc.FAN} as node, sha256(string_agg(node || ':' || hash, ';' order by node)) as hash from l1 group by file, node // {warc.FAN}),
l3 as (select file, sha256(string_agg(node || ':' || hash, ';' order by node)) as hash from l2 group by file)
select page_id, file, offs as "offset", length, sha256, hash as file_root,
       case when page_id * 104729 % 389 = 7 then 'missing' when page_id * 7919 % 211 = 5 then 'altered' else 'intact' end as state
from placed join l3 using (file)
""")
def op10_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    worn = warc.record(F.col("page_id"), F.col("url"), fixtures.worn_body())
    both = warc.digests(pages, copy_length=F.octet_length(worn).cast("long"), copy_sha256=F.sha2(worn, 256), lost=fixtures.lost_page())
    both = written_table(warc.layout(both), "records")  # a record and its copy have one place, whatever ids they bear
    stored = both.select("file", "offset", "page_id", "length", "sha256")
    copied = both.filter("not lost").select("file", "offset", "page_id", F.col("copy_length").alias("length"), F.col("copy_sha256").alias("sha256"))
    levels = warc.levels_over(stored, copied)
    trees = [warc.tree(r, levels) for r in (stored, copied)]
    differ = warc.audit(stored, copied, *trees, levels)
    roots = trees[0].filter(F.col("level") == warc.INNER).select("file", F.col("hash").alias("file_root"))
    return stored.join(differ, ["file", "offset"], "left").join(roots, "file").select(
        "page_id", "file", "offset", "length", "sha256", "file_root", F.coalesce("state", F.lit("intact")).alias("state")
    )


@registered(sql.VARIANTS)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


@registered(sql.MANIFEST)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    folded = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    return merkle.proofs(merkle.build(table(spark, sf_dir, "documents"), "doc_id", "source", fields, {"text": folded}, tampered))


@registered(sql.MINHASH)
def op13_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))
