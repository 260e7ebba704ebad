"""Registered queries of the operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespark.llm import chat, decontam, language, licenses, media, mixing, neardup, quality, repeats, secrets, toxicity, trie, whiten
from lakespark.llm.common import crc_of_id, table
from lakespark.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def load() -> tuple[dict, dict]:
    return QUERIES, ORACLES


def held_out(parts: int, which: int):
    return F.coalesce(crc_of_id() % parts == which, F.lit(False))


@query
def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every whole text; documents with crc32 remainder 1 of 3 are never learned from."""
    docs = table(spark, sf, "documents")
    model = language.learn(docs, crc_of_id() % 3 != 1)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


@query
def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every whole text; labels with crc32 remainder 0 of 5 are never learned from."""
    docs = table(spark, sf, "documents")
    model = toxicity.learn(docs, table(spark, sf, "labels"), crc_of_id() % 5 != 0)
    found = toxicity.score(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op6_minmax_neardup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate component of every document, on 4-word shingles at a similarity of 0.8."""
    return neardup.near_duplicates(table(spark, sf, "documents"), k=4, percent=80)


@query
def op3_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted form."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.format_conversations(turns.unionByName(probe)))


@query
def op8_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets in every whole text: counts and digest of the patterns, and all spans."""
    found = secrets.find_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] < 3)

    def count(kind: str):
        of = secrets.KINDS.index(kind)
        return F.size(F.filter("secrets", lambda s: s["kind"] == of)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, secrets.KINDS[:3]), F.sha2(secrets.spelled(base), 256).alias("base_sha256"), secrets.spelled(F.col("secrets")).alias("spans"))


@query
def op5_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Words that a mix of the sources by weight takes of every document."""
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), mixing.taken(mixed).alias("taken"))


@query
def op10_webp_media(spark: SparkSession, sf: str) -> DataFrame:
    """Every whole text as a lossless WebP file, read back."""
    return media.read(media.store(table(spark, sf, "documents")))


@query
def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items that documents hold, copied or edited, with the place of the best passage."""
    return decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op7_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What every document loses to units that stood earlier: counts, and spans in code points."""
    docs = table(spark, sf, "documents").select("doc_id", repeats.text_key().alias("text_key"))
    lost = repeats.repeated_spans(table(spark, sf, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    none = F.lit(0).cast("long")
    return docs.join(lost, ["doc_id", "text_key"], "left").select(
        "doc_id", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("removed_words", none).alias("removed_words"), F.coalesce(spans, F.lit("")).alias("spans")
    )


@query
def op9_license_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Licenses of every whole text by sentence rules, with their places."""
    found = licenses.scan(table(spark, sf, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["license"], s["start"], s["end"])), ",")
    return found.select("doc_id", "n_sentences", "licenses", spans.alias("spans"))


@query
def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Prefix trie of all conversations, rebuilt so that families of five may open alike."""
    turns = settle(trie.numbered(table(spark, sf, "conversations")))
    return trie.prefix_trie(trie.share_openings(turns), turns.select("conv_id"))


@query
def op12_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every whole text; labels with crc32 remainder 0 of 5 are never learned from."""
    docs = table(spark, sf, "documents")
    model = quality.learn(docs, table(spark, sf, "labels"), crc_of_id() % 5 != 0)
    found = quality.score(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        F.col("quality").alias("score"),
        (F.col("quality") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op13_whiten(spark: SparkSession, sf: str) -> DataFrame:
    """The first whitened components of every usable embedding."""
    return whiten.whiten(table(spark, sf, "embeddings"))


ORACLES["op5_source_mix"] = f"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
    cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, 15) as bigint) as key_
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as nth
  from d group by source),
w as (select *, [3e0, 1e0, 2e0][cast(nth % 3 as integer) + 1] as w, 2e0*source_size as cap from s),
l as (
  select *, cap/w as full_at, row_number() over along as k,
    (1.5e0*sum(source_size) over () - coalesce(sum(cap) over (along rows between unbounded preceding and 1 preceding), 0e0))
      / (sum(w) over () - coalesce(sum(w) over (along rows between unbounded preceding and 1 preceding), 0e0)) as level
  from w window along as (order by cap/w, nth)),
t as (
  select source, source_size, least(cap, coalesce((select arg_min(level, k) from l where full_at > level)*w, cap)) as target from l),
b as (select greatest(1, cast(floor(coalesce(sum(size), 0)/{mixing.BLOCKS}e0) as bigint)) as block from d),
q as (
  select *, cast(ceil(source_size/cast(block as double)) as bigint) as blocks, cast(round(target/block) as bigint) as quota from t, b),
r as (
  select *, coalesce(sum(size) over (partition by source order by key_, doc_id, size rows between unbounded preceding and 1 preceding), 0) as start
  from d)
select doc_id, size, source_size, round(target, 6) as target,
  cast(greatest(0, least(start + size, quota*block) - start) + greatest(0, least(start + size, (quota - blocks)*block) - start) as bigint) as taken
from r join q on r.source is not distinct from q.source"""

ORACLES["op3_chat_format"] = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
m as (
  select *, length(text) - length(translate(text, '\#<', '')) as in_text, length(role) - length(translate(role, '\#<:', '')) as in_role,
    case when regexp_matches(role, '^[A-Z]') then 1 else 0 end as capital from t)
select conv_id, cast(count(*) as bigint) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(14 + length(role) + in_role + capital + length(text) + in_text) as bigint) as formatted_chars
from m group by conv_id"""
