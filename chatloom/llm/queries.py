"""Queries over the given tables, one for each operator of this subpackage."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip
from .chat import format_chats
from .common import crc_fold, scratch, table
from .embeddings import cosine_groups
from .licenses import scan_licenses
from .packing import pack
from .quality import fit_quality, score_quality
from .pages import extract_pages
from .repair import damaged, repair_conversations, repaired_digest
from .simhash import simhash_groups
from .tokenfiles import read_token_files, write_token_files
from .topk import top_k
from .toxicity import fit_toxicity, score_toxicity
from .whitening import embedding_blocks, fit_whitening, whiten


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn with the repair of its dialogue and its part of the rendered text."""
    return format_chats(table(spark, sf_dir, "conversations"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints over three words link at two bits or fewer."""
    return simhash_groups(table(spark, sf_dir, "documents"), k=3, bits=2)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that each document names: base phrases, and the rules' labels and score."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back: start, size and checksum of each document."""
    path = f"{scratch(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path).drop("ids")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into sequences of 1024 ids: the pieces."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a sparse rule ensemble fitted outside the held-out fold."""
    docs, held_out = table(spark, sf_dir, "documents"), crc_fold("doc_id", 3) == 1
    model = fit_quality(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each document, as digests."""
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors linked by a cosine of 0.95 or more."""
    return cosine_groups(table(spark, sf_dir, "embeddings"), least=0.95)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the class models fitted outside the held-out fold."""
    docs, held_out = table(spark, sf_dir, "documents"), crc_fold("doc_id", 4) == 2
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector over all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.filter("vec_id % 20 = 0"), vectors, k=20, scale=64)


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings: every vector along the eight components of largest variance of all vectors."""
    blocks, dims = embedding_blocks(table(spark, sf_dir, "embeddings"), scale=1024)
    return whiten(blocks, fit_whitening(blocks, dims, k=8))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with faults put in, repaired: what was wrong, the cost, the edits and a hash of the repaired turns."""
    turns = table(spark, sf_dir, "conversations")
    repair = repair_conversations(damaged(turns))
    found = repair.conversations().join(repaired_digest(repair).withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    ids = turns.select(turns["conv_id"].cast("long").alias("id")).distinct()
    out = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    zeros = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("id").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _repair_sql() -> str:
    """A plain dynamic program over the rows of a conversation, which keeps the least (cost, audit, repaired) of each state."""
    gone = "case when {q}.c is not null then {{'c': {q}.c + 4, 'a': {q}.a || 'D', 'o': {q}.o}} end"
    kept = "case when {q}.c is not null and f.f < 2 and f.i = '{i}' then {{'c': {q}.c + 3 * f.f, 'a': {q}.a || 'K', 'o': list_append({q}.o, f.r || ':' || f.x)}} end"
    told = "case when {q}.c is not null and f.f < 2 then {{'c': {q}.c + 3 + 3 * f.f, 'a': {q}.a || 'R', 'o': list_append({q}.o, '{r}:' || f.x)}} end"
    put = "case when {q}.c is not null then {{'c': {q}.c + 3, 'a': {q}.a || 'I', 'o': list_append({q}.o, '{r}:')}} end"
    least = lambda *ways: "list_min([" + ", ".join(ways) + "])"
    to_u = [w.format(q=q, i="u", r="user") for q in ("p.z", "p.s", "p.a") for w in (kept, told)]
    to_a = [w.format(q="p.u", i="a", r="assistant") for w in (kept, told)]
    step = f"{gone.format(q='p.z')} as z, {least(gone.format(q='p.s'), kept.format(q='p.z', i='s'))} as s, {least(gone.format(q='p.u'), *to_u)} as u, {least(gone.format(q='p.a'), *to_a)} as a"
    fill_u = least("n.u", *(put.format(q=q, r="user") for q in ("n.z", "n.s", "n.a")))
    fill_a = least("m.a", put.format(q="m.u", r="assistant"))
    filled = "select m.c, m.k, m.z, m.s, m.u, " + fill_a + " as a from (select n.c, n.k, n.z, n.s, n.a, " + fill_u + " as u from (@) n) m"
    none = "cast(null as struct(c bigint, a varchar, o varchar[]))"
    first = f"select distinct conv_id as c, cast(0 as bigint) as k, cast({{'c': 0, 'a': '', 'o': []}} as struct(c bigint, a varchar, o varchar[])) as z, {none} as s, {none} as u, {none} as a from conversations"
    space = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
with recursive crc as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t
), d as (
  select conv_id as c, turn as t, coalesce(role, ' ') as r, coalesce(text, ' ') as x,
    xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda e: cast(ascii(e) as bigint))),
      lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as k
  from conversations, crc
), e as (
  select c, t, case when k = 4 then 'user' else r end as r, case when k = 1 then '' when k = 2 then regexp_replace(x, '[.!?]', '', 'g') else x end as x,
    unnest(case when k = 3 then [0, 1] else [0] end) as n
  from d where k <> 0
), g as (
  select c, t, r, x, row_number() over (partition by c order by t nulls first, r, x, n) as k, row_number() over (partition by c, r, x order by t nulls first, n) as m,
    lag(left(r, 1)) over (partition by c order by t nulls first, r, x, n) || left(r, 1) as pair, rtrim(x, {space}) as y
  from e
), f as (
  select c, t, r, x, k, left(r, 1) as i, pair, y = '' as blank, y <> '' and m > 1 as dup, y <> '' and m = 1 and right(y, 1) not in ('.', '!', '?') as cut,
    case when y = '' or m > 1 then 2 when right(y, 1) not in ('.', '!', '?') then 1 else 0 end as f
  from g
), p(c, k, z, s, u, a) as (
  {filled.replace("@", first)}
  union all
  {filled.replace("@", f"select p.c, p.k + 1 as k, {step} from p join f on f.c is not distinct from p.c and f.k = p.k + 1")}
), w as (
  select c, list_min([z, a]) as w from p qualify row_number() over (partition by c order by k desc) = 1
), q as (
  select c, max(t) - min(t) + 1 - count(distinct t) as gaps, count_if(blank) as blank, count_if(dup) as duplicate, count_if(cut) as truncated, count_if(pair not in ('su', 'ua', 'au')) as illegal
  from f group by c
)
select w.c as conv_id, coalesce(q.gaps, 0) as gaps, cast(coalesce(q.blank, 0) as bigint) as blank, cast(coalesce(q.duplicate, 0) as bigint) as duplicate, cast(coalesce(q.truncated, 0) as bigint) as truncated,
  cast(coalesce(q.illegal, 0) as bigint) as illegal, w.w.c as cost, w.w.a as audit, sha256(array_to_string(w.w.o, chr(10))) as repaired_sha256
from w left join q on q.c is not distinct from w.c
"""


QUERIES = {f.__name__: f for f in (op1_chat_format, op2_simhash, op3_licenses, op4_token_files, op5_packing, op6_quality, op7_bpe, op8_embeddings, op9_toxicity, op10_top_k, op11_main_text, op12_whitening, op13_conversation_repair)}
ORACLES: dict[str, str] = {
    "op8_embeddings": """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), l as (
  select a.vec_id as u, b.vec_id as w from v a join v b on a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.95
), r(u, w) as (
  select vec_id, vec_id from embeddings union select r.u, l.w from r join l on l.u = r.w
), n as (select u, count(*) as n from l group by u)
select e.vec_id, coalesce(any_value(n.n), 0) as n_links, min(r.w) as component_id, e.vec_id = min(r.w) as kept
from embeddings e join r on r.u = e.vec_id left join n on n.u = e.vec_id group by e.vec_id
""",
    "op10_top_k": """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
), r as (
  select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from s
)
select query_id, rank, vec_id, score from r where rank <= 20
""",
    "op13_conversation_repair": _repair_sql(),
}
