"""Dialogue, set, sampling and feedback operators over the given tables, with SQL twins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chatloom.operators import dialogue as dl
from chatloom.operators import evaluation as ev
from chatloom.operators import sets
from chatloom.operators.numbering import numbered_within

from .common import table

QUERIES, SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("""select conv_id, turn // 1000 as part, to_json(list({'role': role, 'content': text} order by turn))::varchar as messages, count(*) as turns from conversations where role in ('user', 'assistant') group by conv_id, turn // 1000""")
def DLG1_assemble(spark, d):
    a = dl.assemble(table(spark, d, "conversations"), ["user", "assistant"])
    return a.select("conv_id", "part", F.to_json("messages").alias("messages"), F.size("messages").cast("long").alias("turns"))


@query("""with r as (select conv_id, turn, case when role = 'system' then 'user' else role end as role, text from conversations),
n as (select *, case when role = lag(role) over (partition by conv_id order by turn) then 0 else 1 end as new from r),
u as (select *, sum(new) over (partition by conv_id order by turn) as run from n)
select conv_id, min(turn) as turn, arg_min(role, turn) as role, string_agg(text, chr(10) order by turn) as text, cast(count(*) - 1 as int) as merged from u group by conv_id, run""")
def DLG2_merge_turns(spark, d):
    turns = table(spark, d, "conversations").withColumn("role", F.when(F.col("role") == "system", "user").otherwise(F.col("role")))
    return dl.merge_same_role(turns)


@query("""with r as (select *, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn) as asked from conversations where role in ('user', 'assistant')),
f as (select conv_id, asked, min(turn) as at, arg_min(text, turn) as answer from r where role = 'assistant' and asked is not null group by conv_id, asked)
select f.conv_id || '_single_' || (row_number() over (partition by f.conv_id order by f.at) - 1) as pair_id, f.conv_id, q.text as question, f.answer from f join conversations q on q.conv_id = f.conv_id and q.turn = f.asked""".replace(" as at,", " as pos,").replace("f.at)", "f.pos)"))
def DLG4_qa_pairs(spark, d):
    return dl.qa_pairs(table(spark, d, "conversations"))


@query("""with u as (select conv_id, min(turn) as asked, arg_min(text, turn) as question from conversations where role = 'user' and length(trim(text)) > 0 group by conv_id)
select c.conv_id, any_value(question) as question, arg_min(c.text, c.turn) as answer from conversations c join u using (conv_id) where c.role = 'assistant' and length(trim(c.text)) > 0 and c.turn > u.asked group by c.conv_id""")
def DLG5_first_pair(spark, d):
    return dl.first_pair(table(spark, d, "conversations"))


@query("""select conv_id, count(*) filter (where role = 'user') as users, count(*) filter (where role = 'assistant') as assistants,
count(*) filter (where role = 'user') = 1 and count(*) filter (where role = 'assistant') = 1 as single from conversations group by conv_id""")
def DLG6_shape(spark, d):
    return dl.shape(table(spark, d, "conversations"))


@query("select conv_id, arg_max(text, turn) as query from conversations where role = 'user' and length(trim(text)) > 0 group by conv_id")
def DLG7_last_query(spark, d):
    return dl.last_query(table(spark, d, "conversations"))


_POOL = ["I cannot say.", "Please ask again.", "That is all."]


@query(f"""with u as (select conv_id, min(turn) as asked, arg_min(text, turn) as question from conversations where role = 'user' and length(trim(text)) > 0 group by conv_id),
p as (select c.conv_id, any_value(question) as question, arg_min(c.text, c.turn) as answer from conversations c join u using (conv_id) where c.role = 'assistant' and length(trim(c.text)) > 0 and c.turn > u.asked group by c.conv_id)
select conv_id, question as prompt, answer as chosen, {_POOL}[cast(('0x' || md5(cast(conv_id as varchar))[1:8]) as bigint) % {len(_POOL)} + 1] as rejected from p""")
def DLG8_preference_pairs(spark, d):
    pick = F.conv(F.substring(F.md5(F.col("conv_id").cast("string")), 1, 8), 16, 10).cast("long") % len(_POOL)
    return dl.first_pair(table(spark, d, "conversations")).select("conv_id", F.col("question").alias("prompt"), F.col("answer").alias("chosen"), F.get(F.array(*map(F.lit, _POOL)), pick).alias("rejected"))


@query("""select conv_id, turn // 1000 as part, 'sft' as split, to_json(list({'role': role, 'content': text} order by turn))::varchar as messages from conversations where role in ('user', 'assistant') group by conv_id, turn // 1000""")
def DLG8_sft_view(spark, d):
    a = dl.assemble(table(spark, d, "conversations"), ["user", "assistant"])
    return a.select("conv_id", "part", F.lit("sft").alias("split"), F.to_json("messages").alias("messages"))


@query("""with u as (select conv_id, min(turn) as asked, arg_min(text, turn) as question from conversations where role = 'user' and length(trim(text)) > 0 group by conv_id),
p as (select c.conv_id, any_value(question) as question, arg_min(c.text, c.turn) as answer from conversations c join u using (conv_id) where c.role = 'assistant' and length(trim(c.text)) > 0 and c.turn > u.asked group by c.conv_id)
select conv_id, to_json([{'role': 'user', 'content': question}])::varchar as messages, answer as reference, 0.6::double as accuracy, 0.4::double as format from p""")
def DLG8_prompt_view(spark, d):
    """Prompts with the reference answer and the rubric's weights."""
    message = F.to_json(F.array(F.struct(F.lit("user").alias("role"), F.col("question").alias("content"))))
    return dl.first_pair(table(spark, d, "conversations")).select("conv_id", message.alias("messages"), F.col("answer").alias("reference"), F.lit(0.6).alias("accuracy"), F.lit(0.4).alias("format"))


@query("""select conv_id, arg_min(text, turn) as text, case when regexp_matches(arg_min(text, turn), '(?i)the') then 'english' when regexp_matches(arg_min(text, turn), '(?i)der|ung') then 'german' else 'other' end as intent from conversations group by conv_id""")
def DLG9_classification_view(spark, d):
    first = table(spark, d, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    return first.withColumn("intent", F.when(F.col("text").rlike("(?i)the"), "english").when(F.col("text").rlike("(?i)der|ung"), "german").otherwise("other"))


@query("select conv_id, arg_min(text, turn) as question, arg_max(text, turn) as answer from conversations group by conv_id")
def DLG9_faq_view(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("question"), F.max_by("text", "turn").alias("answer"))


@query("""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents),
s as (select *, case when length(trim(line)) > 0 then line end as said from l),
n as (select *, last_value(said ignore nulls) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding) as before,
first_value(said ignore nulls) over (partition by doc_id order by pos rows between 1 following and unbounded following) as after from s)
select doc_id, cast(pos as int) as pos, before, after, concat_ws(chr(10), before, after) as context from n where regexp_matches(line, '(?i)licen[sc]e')""")
def DLG11_neighbours(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return dl.neighbours(lines, "doc_id", "pos", "line", F.col("line").rlike("(?i)licen[sc]e"))


@query("""with a as (select conv_id, count(*) filter (where role = 'user') as users, count(*) filter (where role = 'assistant') as replies, sum(case when role in ('user', 'assistant') then length(coalesce(text, '')) else 0 end) as size,
count(*) filter (where role = 'user' and lower(trim(text)) not in ('ok', 'hi', 'thanks')) as worthy, max(case when role = 'assistant' then length(text) end) as longest from conversations group by conv_id)
select conv_id, case when users = 0 then 'no_user' when replies = 0 then 'no_reply' when size < 12 then 'too_short' when size > 6000 then 'too_long' when worthy = 0 then 'low_value' when longest < 40 then 'reply_too_short' end as reason from a""")
def FLT11_drop_reason(spark, d):
    return dl.drop_reason(table(spark, d, "conversations"), ["ok", "hi", "thanks"], shortest=40)


_LOW, _POLICY = "(?i)^[a-z ]{0,24}[.!]?$", "(?i)license|reserved|not in"


@query(f"""with q as (select conv_id, count(*) filter (where role = 'user') as u, count(*) filter (where role = 'assistant') as r, min(case when role = 'assistant' then length(text) end) as least, count(*) filter (where length(text) > 300) as truncated,
count(*) filter (where role = 'user' and not regexp_matches(trim(text), '{_LOW}')) as worthy, coalesce(bool_or(role = 'assistant' and regexp_matches(text, '{_POLICY}')), false) as policy, sum(least(length(text), 300))::bigint as chars from conversations group by conv_id)
select conv_id, case when u = 0 then 'no_user' when r = 0 then 'no_reply' when coalesce(least, 0) < 40 then 'short_reply' when worthy = 0 then 'low_value' else 'ok' end as verdict, truncated, policy, chars from q""")
def FLT16_turn_quality(spark, d):
    return dl.turn_quality(table(spark, d, "conversations"), _LOW, _POLICY, 40, 300)


@query("""select conv_id, coalesce(bool_or(role <> 'system' and regexp_matches(text, '(?i)ignore (all|previous)|system prompt')), false) as injection,
coalesce(bool_or(role = 'user' and regexp_matches(text, '(?i)weather|football')) and not bool_or(role = 'user' and regexp_matches(text, '(?i)the')), false) as off_topic from conversations group by conv_id""")
def FLT15_guard(spark, d):
    user, t = F.col("role") == "user", F.col("text")
    a = table(spark, d, "conversations").groupBy("conv_id").agg(F.bool_or((F.col("role") != "system") & t.rlike("(?i)ignore (all|previous)|system prompt")).alias("injection"), F.bool_or(user & t.rlike("(?i)weather|football")).alias("off"), F.bool_or(user & t.rlike("(?i)the")).alias("on"))
    return a.select("conv_id", F.coalesce("injection", F.lit(False)).alias("injection"), F.coalesce(F.col("off") & ~F.col("on"), F.lit(False)).alias("off_topic"))


def hash_sql(numbers: bool, size: int, source: str = "conversations") -> str:
    text = "trim(lower(coalesce(text, '')))"
    text = f"regexp_replace({text}, '[0-9]+', '<NUM>', 'g')" if numbers else text
    return f"""select conv_id, sha256(string_agg(t, chr(10) order by segment))[1:{size}] as hash from (select conv_id, turn // 1000 as segment, sha256(string_agg(sha256(role || ':' || regexp_replace({text}, '[ \\t\\n\\r\\f]+', ' ', 'g')), chr(10) order by turn)) as t
from {source} group by conv_id, turn // 1000) group by conv_id"""


@query(f"with h as ({hash_sql(True, 20)}) select hash, min(conv_id) as conv_id from h group by hash")
def SET1_dialogue_dedup(spark, d):
    return sets.keep_first(dl.dialogue_hash(table(spark, d, "conversations")), ["hash"], ["conv_id"])


@query(hash_sql(False, 64))
def SET2_dialogue_hash(spark, d):
    return dl.dialogue_hash(table(spark, d, "conversations"), numbers=False, size=64)


_PRIO = "case when source < 'src10' then 0 when source < 'src15' then 1 else 2 end"


@query(f"with r as (select {_PRIO} as prio, row_number() over (partition by md5(text) order by {_PRIO}, doc_id) as n from documents) select cast(prio as int) as prio, count(*) filter (where n = 1) as added, count(*) filter (where n > 1) as skipped from r group by prio")
def SET3_prioritised_union(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.md5("text").alias("sig"))
    parts = [docs.filter(f"{_PRIO} = {i}") for i in range(3)]
    return sets.prioritised_union(parts, "sig", "doc_id")[1]


@query("""with b as (select doc_id, md5(text) as sig from documents where lang = 'en'), e as (select doc_id, md5(text) as sig from documents where lang <> 'en'),
f as (select *, row_number() over (partition by sig order by doc_id) as n from e where sig not in (select sig from b))
select doc_id, sig from b union all select doc_id, sig from f where n = 1""")
def SET4_merge_base_wins(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", F.md5("text").alias("sig"))
    return sets.merge_base_wins(docs.filter("lang = 'en'").drop("lang"), docs.filter("lang <> 'en'").drop("lang"), "sig", "doc_id")


@query("""with e as (select distinct sha256(text) as sig from documents where source <= 'src4'), g as (select doc_id, sha256(text) as sig from documents where source > 'src4')
select sig, min(doc_id) as doc_id from g where sig not in (select sig from e) group by sig""")
def SET5_incremental_merge(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("sig"))
    fresh = docs.filter("source > 'src4'").join(docs.filter("source <= 'src4'").select("sig").distinct(), "sig", "left_anti")
    return sets.keep_first(fresh, ["sig"], ["doc_id"]).select("sig", "doc_id")


@query("""select lang, source, min(doc_id) as doc_id from documents where n_chars >= 100 group by lang, source""")
def SET6_composite_first(spark, d):
    return sets.keep_first(table(spark, d, "documents").filter("n_chars >= 100").select("lang", "source", "doc_id"), ["lang", "source"], ["doc_id"])


@query("""with m as (select doc_id, cast(cast(('0x' || md5(cast(doc_id as varchar))) as uhugeint) % 10 as int) as m from documents)
select doc_id, m as bucket, case m when 0 then 'val' when 1 then 'test' else 'train' end as split from m""")
def SET7_md5_split(spark, d):
    m = sets.md5_mod(F.col("doc_id").cast("string"), 10)
    return table(spark, d, "documents").select("doc_id", m.alias("bucket")).withColumn("split", F.when(F.col("bucket") == 0, "val").when(F.col("bucket") == 1, "test").otherwise("train"))


_SHARE = "(cast(('0x' || md5(cast(doc_id as varchar))[1:8]) as bigint) / 4294967295.0::double)"


@query(f"select doc_id, {_SHARE} < 0.1 as canary from documents")
def SET8_canary(spark, d):
    return table(spark, d, "documents").select("doc_id", (sets.md5_share(F.col("doc_id").cast("string")) < 0.1).alias("canary"))


@query(f"select doc_id, case when {_SHARE} < 0.94 then 'train' when {_SHARE} < 0.97 then 'val' else 'test' end as split from documents")
def SET9_weighted_split(spark, d):
    return table(spark, d, "documents").select("doc_id", sets.weighted_split(F.col("doc_id").cast("string"), [("train", 0.94), ("val", 0.03), ("test", 0.03)]).alias("split"))


@query("""with r as (select doc_id, coalesce(lang, 'UNLABELED') as stratum, row_number() over (partition by coalesce(lang, 'UNLABELED') order by md5(doc_id || ':7'), doc_id) as n from documents)
select stratum, doc_id from r where n <= 12""")
def SMP1_stratified_cap(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("lang", F.lit("UNLABELED")).alias("stratum"))
    return sets.capped(docs, ["stratum"], [F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":7"))), "doc_id"], 12).select("stratum", "doc_id")


@query("""with c(lang, cap) as (values ('en', 20), ('de', 10), ('fr', 5)),
r as (select d.doc_id, lang, source, cap, row_number() over (partition by lang, source order by sha1(doc_id || '|' || source), doc_id) as n from documents d join c using (lang))
select lang, source, doc_id from r where n <= cap""")
def SMP2_stable_sample(spark, d):
    caps = spark.createDataFrame([("en", 20), ("de", 10), ("fr", 5)], "lang string, cap int")
    docs = table(spark, d, "documents").select("doc_id", "lang", "source").join(F.broadcast(caps), "lang")
    return sets.capped(docs, ["lang", "source"], [F.sha1(F.concat_ws("|", "doc_id", "source")), "doc_id"], F.col("cap")).select("lang", "source", "doc_id")


@query("""with r as (select doc_id, source, row_number() over (partition by source order by case when lang = 'en' then 0 else 1 end, case when contains(lower(text), 'license') then 0 else 1 end, case when n_chars >= 1000 then 0 else 1 end, md5(cast(doc_id as varchar)), doc_id) as n from documents)
select source, doc_id from r where n <= 5""")
def SMP3_quality_sample(spark, d):
    order = [F.when(F.col("lang") == "en", 0).otherwise(1), F.when(F.lower("text").contains("license"), 0).otherwise(1), F.when(F.col("n_chars") >= 1000, 0).otherwise(1), F.md5(F.col("doc_id").cast("string")), "doc_id"]
    return sets.capped(table(spark, d, "documents"), ["source"], order, 5).select("source", "doc_id")


@query("""with c as (select lang, count(*) as n from documents group by lang), q as (select lang, 100 * n / (sum(n) over ())::double as x from c),
r as (select lang, floor(x) as f, row_number() over (order by x - floor(x) desc, lang) as rank, 100 - sum(floor(x)) over () as rest from q)
select lang, cast(f + case when rank <= rest then 1 else 0 end as bigint) as quota from r""")
def SMP5_largest_remainder(spark, d):
    return sets.largest_remainder(table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n")), "lang", "n", 100)


@query("select doc_id, copy from (select doc_id, unnest(range(1, case when quality = 0 then 9 else 5 end)) as copy from labels)".replace("copy from (", "cast(copy as int) as copy from ("))
def SMP8_weighted_repeat(spark, d):
    return sets.repeated(table(spark, d, "labels"), F.when(F.col("quality") == 0, 8).otherwise(4)).select("doc_id", "copy")


_FORMS = [("plain", "{text}"), ("please", "Please explain: {text}"), ("short", "{text} Answer in short.")]


@query(" union all ".join(f"select item_id, '{n}' as variant, '{f.split('{text}')[0]}' || text || '{f.split('{text}')[1]}' as query from benchmark" for n, f in _FORMS))
def SMP9_variants(spark, d):
    return sets.variants(table(spark, d, "benchmark"), "text", _FORMS).select("item_id", "variant", "query")


def preds_sql(every: int = 7) -> str:
    return f"select d.doc_id, l.quality as gold, case when d.doc_id % {every} = 0 then 1 - l.quality else l.quality end as pred, d.text, d.lang, d.n_chars, l.toxic from documents d join labels l using (doc_id)"


_PREDS = preds_sql()


def predictions(spark, d, every: int = 7):
    """Predictions with gold: quality labels, flipped for every seventh (or other) document."""
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    pred = F.when(F.col("doc_id") % every == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    return rows.select("doc_id", F.col("quality").alias("gold"), pred.alias("pred"), "text", "lang", "n_chars", "toxic")


#: Cases lack every eleventh id; every thirteenth has an empty query; English ones and every fourth other must name a term.
_ASK_FORMS, _CAP = ("{query}", "Please help: {query}"), 20
_PACK = f"""fl as (select doc_id as id, gold, pred, n_chars >= 30 as ok from ({_PREDS}) where gold = 1 and pred = 0),
cs as (select doc_id as id, trim(case when doc_id % 13 = 0 then ' ' else string_split(text, chr(10))[1] end) as query, case when lang = 'en' then ['class', 'nowhere'] when doc_id % 4 = 0 then ['nowhere'] else [] end as must from documents where doc_id % 11 <> 0),
jo as (select fl.id, gold, pred, query, must, case when cs.id is null then 'missing_case' when coalesce(query, '') = '' then 'no_query' else 'pool' end as fate from (select * from fl where ok) fl left join cs using (id)),
ca as (select *, row_number() over (partition by gold order by md5(id::varchar), id) as n from jo where fate = 'pool'),
ch as (select id, gold, query, must, 'This is of class ' || gold || '.' as chosen, 'This is of class ' || pred || '.' as rejected from ca where n <= {_CAP}),
ro as (select k.kind || '_' || gold || '_' || id || '_' || lpad(f.k::varchar, 2, '0') as row_id, k.kind, f.before || query as prompt, chosen, case when k.kind = 'dpo' then rejected end as rejected, id, gold
from ch, (values (1, ''), (2, 'Please help: ')) f(k, before), (values ('sft'), ('dpo')) k(kind) where len(must) = 0 or len(list_filter(must, lambda t: contains(chosen, t))) > 0)"""


def _pack(spark, d):
    failed = predictions(spark, d).filter("gold <> pred").select(F.col("doc_id").alias("id"), "gold", "pred", (F.col("n_chars") >= 30).alias("request_ok"))
    must = F.when(F.col("lang") == "en", F.array(F.lit("class"), F.lit("nowhere"))).when(F.col("doc_id") % 4 == 0, F.array(F.lit("nowhere"))).otherwise(F.array().cast("array<string>"))
    query = F.when(F.col("doc_id") % 13 == 0, " ").otherwise(F.split("text", "\n")[0])
    cases = table(spark, d, "documents").filter("doc_id % 11 <> 0").select(F.col("doc_id").alias("id"), query.alias("query"), must.alias("must"))
    reply = lambda c: F.concat(F.lit("This is of class "), F.col(c).cast("string"), F.lit("."))
    return ev.confusion_pack(failed, cases, [1], 0, reply("gold"), reply("pred"), _ASK_FORMS, _CAP)


@query(f"with {_PACK} select * from ro")
def FBK1_confusion_repair(spark, d):
    """Good texts that were taken for bad ones, as training rows with chosen and rejected replies."""
    return _pack(spark, d)[0]


@query(f"with {_PACK} select fate as counter, count(*) as n from jo group by fate union all select * from (select 'quality', count(*) as n from ch where len(must) > 0 and len(list_filter(must, lambda t: contains(chosen, t))) = 0) where n > 0 union all select 'rows_' || kind, count(*) from ro group by kind")
def FBK1_counters(spark, d):
    """What became of the failures that the pack is made of."""
    return _pack(spark, d)[1]


@query("""with p as (select doc_id, lang, row_number() over (partition by lang order by doc_id) - 1 as i, count(*) over (partition by lang) as n from documents where lang in ('es', 'fr')),
k as (select lang, n, unnest(range(50)) as k from (select distinct lang, n from p))
select k.lang, cast(k.k as int) as k, p.doc_id from k join p on p.lang = k.lang and p.i = cast(('0x' || md5(k.lang || ':' || k.k)[1:8]) as bigint) % k.n""")
def FBK4_weak_class_boost(spark, d):
    pool = table(spark, d, "documents").filter("lang in ('es', 'fr')").select("doc_id", "lang")
    pool, sizes = numbered_within(pool, "lang", ["doc_id"], "i")
    wanted = sizes.withColumnRenamed("size", "n").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(49))))
    draw = F.conv(F.substring(F.md5(F.concat("lang", F.lit(":"), F.col("k").cast("string"))), 1, 8), 16, 10).cast("long") % F.col("n")
    return wanted.withColumn("i", draw).join(pool, ["lang", "i"]).select("lang", "k", "doc_id")


@query("""with p as (select doc_id, lang, row_number() over (partition by lang order by md5(cast(doc_id as varchar)), doc_id) as k from documents where lang in ('es', 'fr'))
select cast(a.k as int) as k, a.doc_id as left_id, b.doc_id as right_id from p a join p b on a.k = b.k and a.lang = 'es' and b.lang = 'fr' where a.k <= 20""")
def FBK4_contrast_pairs(spark, d):
    """Texts of two classes that are taken for each other, side by side."""
    pool = table(spark, d, "documents").filter("lang in ('es', 'fr')").select("doc_id", "lang")
    k = F.row_number().over(Window.partitionBy("lang").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id"))
    pool = pool.withColumn("k", k).filter("k <= 20")
    return pool.filter("lang = 'es'").select("k", F.col("doc_id").alias("left_id")).join(pool.filter("lang = 'fr'").select("k", F.col("doc_id").alias("right_id")), "k")


@query("""with t as (select l.doc_id, 0.5 + quality * 0.4 as teacher from labels l join documents d using (doc_id) where l.doc_id % 9 <> 0 and trim(string_split(text, chr(10))[1]) <> ''), s as (select doc_id, (n_chars % 100) / 100.0 as student from documents where doc_id % 5 <> 0)
select t.doc_id, case when coalesce(student, 0) < 0.75 or teacher - coalesce(student, 0) >= 0.2 then 4 else 2 end as weight from t left join s using (doc_id)""")
def FBK5_teacher_student(spark, d):
    """Teacher's answers, of which every ninth is empty and drops out, beside a student's scores, of which every fifth is missing."""
    docs = table(spark, d, "documents")
    answer = docs.select("doc_id", F.when(F.col("doc_id") % 9 == 0, " ").otherwise(F.split("text", "\n")[0]).alias("answer"))
    teacher = table(spark, d, "labels").select("doc_id", (F.lit(0.5) + F.col("quality") * 0.4).alias("teacher")).join(answer, "doc_id")
    student = docs.filter("doc_id % 5 <> 0").select("doc_id", ((F.col("n_chars") % 100) / 100.0).alias("student"))
    return ev.distilled(teacher, student, "doc_id")
