"""Registered queries of the subpackage and their check SQL for DuckDB."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adstrata.llm import (
    bpe, chat, decontaminate, divergence, jaccard, langid, licenses, merkle, pii, quality, sharding, token_counts, token_store,
)
from adstrata.llm.frames import scratch_path, stored, table
from adstrata.session import apply_text_conf

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 24
TOKEN_LIMIT = 1024


def op1_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    docs = table(apply_text_conf(spark), folder, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, WORDS, packed="packed").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in 24 shards of near equal bytes; equal texts lie together."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("digest"),
    )
    placed = sharding.assign_shards(docs, SHARDS, F.col("size"), F.col("digest"), F.col("doc_id"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that leak a benchmark item, one row for each such pair."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", "leak.item_id", "leak.n_covered", "leak.n_words", "leak.coverage",
        F.size("leak.tiles").cast("long").alias("n_tiles"),
    )


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements and verdict of the current policy for every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(quality.BASE)).alias("base_failed"),
        quality.passes(quality.CURRENT).alias("kept"),
        F.col("failures").bitwiseAND(F.lit(quality.CURRENT.mask).cast("long")).alias("failures"),
    )


OP4_SQL = """
with words as (
  select doc_id, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from documents
),
numbered as (select row_number() over () as row, * from words),
windows as (
  select row, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from numbered, unnest(range(1, len(w) - 1)) as r(i)
),
repeated as (select row, i from windows qualify count(*) over (partition by row, g) > 1),
covered as (
  select row, count(distinct i + k) as n from repeated, (values (0), (1), (2)) as o(k) group by row
),
measured as (
  select doc_id, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as bigint) as n_upper,
    cast(length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) as bigint) as n_digits,
    cast(length(t) - length(replace(t, '!', '')) as bigint) as n_bangs,
    cast(len(lines) as bigint) as n_lines,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words
  from numbered left join covered using (row)
),
failed as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    cast(
      if(n_words < 50, 1, 0) + if(100 * n_repeat_words > 50 * n_words, 2, 0) + if(100 * n_symbols > 10 * n_words, 4, 0)
      + if(n_dup_lines > 2 and 100 * n_dup_lines > 30 * n_lines, 512, 0) + if(word_chars < 3 * n_words, 16, 0)
      + if(word_chars > 10 * n_words, 32, 0) + if(100 * n_upper > 30 * word_chars, 64, 0)
      + if(100 * n_digits > 20 * word_chars, 128, 0) + if(100 * n_bangs > 30 * n_words, 256, 0)
    as bigint) as failures
  from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failures = 0 as kept, failures
from failed
"""


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation and one with control strings in it, formatted, written, and read back."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    blocks = stored(chat.format_conversations(rows, BYTES), "chat")
    return chat.summarise(blocks).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "n_loss_tokens"
    )


def op7_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, written to a store and read back."""
    out = scratch_path(spark, "token-store")
    token_store.write_store(table(spark, folder, "documents"), out, WORDS)
    return token_store.read_store(spark, out).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("packed").alias("ids_crc32")
    )


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data and revealing words of every document."""
    found = pii.find(table(spark, folder, "documents").select("doc_id", "text"))
    n_of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    return found.select(
        "doc_id",
        *[n_of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(written(F.filter("spans", lambda s: s["kind"] != pii.TERM)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """The component of similar documents that every document is in."""
    found = jaccard.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


OP9_SQL = """
with recursive words as (
  select row_number() over () as r, doc_id,
    list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
),
shingles as (
  select distinct r, array_to_string(w[i : i + 4], ' ') as s
  from words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as t(i) where len(w) > 0
),
sizes as (select r, count(*) as n from shingles group by r),
pairs as (
  select a.r as x, b.r as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.r < b.r group by all
),
links as (
  select x, y from pairs join sizes a on a.r = x join sizes b on b.r = y where 100 * c >= 75 * (a.n + b.n - c)
),
both_ways as (select x, y from links union all select y, x from links),
reached as (
  select r, r as t from words
  union
  select reached.r, y from reached join both_ways on x = t
)
select d.doc_id, cast(coalesce(any_value(n), 0) as bigint) as n_shingles, min(o.doc_id) as component_id
from reached join words d on d.r = reached.r join words o on o.r = t left join sizes on sizes.r = d.r
group by d.r, d.doc_id
"""


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document under the byte-level vocabulary."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, BYTES).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Distances between the sources of a language, and the terms that set them apart."""
    return divergence.audit(table(spark, folder, "documents"))


OP11_SQL = """
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as t from documents
),
found as (
  select r, lang, source, unnest(regexp_extract_all(
    translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+'
  )) as term
  from docs
),
kept as (select lang, term, count(*) as n from found group by all having count(distinct r) >= 10),
sizes as (select lang, count(*) as v, sum(n) as total from kept group by lang),
counts as (select lang, source, term, count(*) as n from found join kept using (lang, term) group by all),
sources as (
  select lang, source, coalesce(v, 0) as v, coalesce(sizes.total, 0) as lang_total, coalesce(sum(n), 0) as total
  from (select distinct lang, source from docs) left join sizes using (lang) left join counts using (lang, source)
  group by all
),
shares as (
  select s.lang, s.source, k.term, coalesce(c.n, 0) as n,
    1 + cast(1000000000 as hugeint) * (coalesce(c.n, 0) + 2) // (s.total + 2 * s.v) as p,
    1 + cast(1000000000 as hugeint) * (k.n + 2) // (s.lang_total + 2 * s.v) as q
  from sources s join kept k using (lang) left join counts c using (lang, source, term)
),
apart as (
  select lang, source, term as item, cast((p - q) * (p - q) // (p + q) as bigint) as value
  from shares where n > 0 and p > q
),
near as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
pairs as (
  select a.lang, a.source, b.source as item, cast(coalesce(value, 0) as bigint) as value
  from sources a join sources b on a.lang = b.lang and a.source <> b.source
  left join near n on n.lang = a.lang and n.source = a.source and n.item = b.source
)
select lang, source, part, item, value,
  cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
from (select *, 'pair' as part from pairs union all select *, 'term' as part from apart)
qualify part = 'pair' or rank <= 10
"""


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's proof against the root, folded again from a text that may have been changed."""
    docs = table(spark, folder, "documents")
    changed = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    text = F.when(changed, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    later = merkle.row_digest([text if c == "text" else F.col(c) for c in FIELDS])
    manifest = merkle.build(docs, FIELDS, carried={"doc_id": F.col("doc_id"), "later": later})
    asked = manifest.leaves.select("part", "rank", "doc_id", F.col("digest").alias("leaf"), "later")
    proofs = merkle.verify(manifest.prove(asked), F.col("later"))
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified"
    )


def _tree_sql(name: str, rows: str, depth: int) -> str:
    """Levels of a tree over ``rows`` (s, r, d); a group with one node left stays as it is."""
    levels = [f"{name}0 as (select s, r, d, count(*) over (partition by s) as n from {rows})"]
    for i in range(depth):
        levels.append(
            f"{name}{i + 1} as (select s, r // 3 as r, (any_value(n) + 2) // 3 as n,"
            f" if(any_value(n) = 1, any_value(d), sha256(string_agg(d, '' order by r))) as d"
            f" from {name}{i} group by s, r // 3)"
        )
    return ",\n".join(levels)


def _walk_sql(name: str, start: str, depth: int) -> str:
    """Siblings and the folded digest on the way up from ``start`` (s, k, r, id, sib, cur)."""
    steps = [f"{name}_w0 as (select *, r as at from {start})"]
    for i in range(depth):
        # A level with one node has no siblings and is not folded.
        steps.append(
            f"{name}_w{i + 1} as (select w.s, w.k, w.id, w.r, w.at // 3 as at,"
            f" w.sib || coalesce(string_agg(t.d, '' order by t.r) filter (t.r <> w.at), '') as sib,"
            f" if(any_value(t.n) = 1, w.cur, sha256(coalesce(string_agg(if(t.r = w.at, w.cur, t.d), '' order by t.r), ''))) as cur"
            f" from {name}_w{i} w join {name}{i} t on t.s = w.s and t.r // 3 = w.at // 3"
            f" group by w.s, w.k, w.id, w.r, w.at, w.sib, w.cur)"
        )
    return ",\n".join(steps)


SOURCE_DEPTH, TOP_DEPTH = 11, 5  # levels for 177,147 documents a source and 243 sources
OP12_SQL = f"""
with docs as (
  select row_number() over () as id, doc_id, coalesce('=' || source, '') as s, source, lang, n_chars, text,
    list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) as crc
  from documents
),
encoded as (
  select *, coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head,
    if(xor(crc, 4294967295) % 2 = 0, replace(text, chr(10), ''), text) as changed
  from docs
),
leaves as (
  select id, doc_id, s, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as d,
    sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) as later
  from encoded
),
placed as (select *, row_number() over (partition by s order by doc_id nulls first, d) - 1 as r from leaves),
{_tree_sql("low", "placed", SOURCE_DEPTH)},
subroots as (select '' as s, s as of, row_number() over (order by s) - 1 as r, d from low{SOURCE_DEPTH}),
{_tree_sql("top", "subroots", TOP_DEPTH)},
asked as (select s, '' as k, r, id, '' as sib, later as cur from placed),
{_walk_sql("low", "asked", SOURCE_DEPTH)},
inner_done as (select '' as s, w.s as k, o.r, w.id, w.sib, w.cur from low_w{SOURCE_DEPTH} w join subroots o on o.of = w.s),
{_walk_sql("top", "inner_done", TOP_DEPTH)}
select doc_id, leaves.d as leaf, subroots.d as subroot, top{TOP_DEPTH}.d as root, sha256(sib) as proof_sha256,
  cur as folded_root, cur = top{TOP_DEPTH}.d as verified
from top_w{TOP_DEPTH} w join leaves using (id) join subroots on subroots.of = leaves.s cross join top{TOP_DEPTH}
"""


def op13_languages(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    third = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    docs = docs.select("*", F.coalesce(third == 1, F.lit(False)).alias("held_out"))
    learned = docs.filter((third != 1) & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    model = langid.train(learned)
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", F.coalesce("lang_pred", F.lit("und")).alias("lang_pred"), "score", "accepted", "cross_entropy"
    )


QUERIES = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_shards": op2_shards,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_licenses": op5_licenses,
    "op6_chat": op6_chat,
    "op7_token_store": op7_token_store,
    "op8_pii": op8_pii,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_token_counts": op10_token_counts,
    "op11_divergence": op11_divergence,
    "op12_merkle": op12_merkle,
    "op13_languages": op13_languages,
}
CHECKS = {"op4_quality": OP4_SQL, "op9_jaccard_join": OP9_SQL, "op11_divergence": OP11_SQL, "op12_merkle": OP12_SQL}
