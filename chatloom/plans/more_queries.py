"""Further projections, sampling, feedback, retrieval and evaluation queries, with SQL twins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chatloom.functions import text as tx
from chatloom.operators import dialogue as dl
from chatloom.operators import parsing as ps
from chatloom.operators import retrieval as rt
from chatloom.operators import rules as rl
from chatloom.operators import sets

from .common import sql_rules, sql_sentences, table
from .dialogue_queries import _PREDS, _SHARE, predictions
from .eval_queries import r6
from .retrieval_queries import _CHUNKS, _FULL, _LEX, _LINES, _lexical, _second

QUERIES, SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_SCAFFOLD = [(r"(?s)<think>.*?</think>", ""), (r"\*\*|__", ""), (r"(?i)(ticket|flow)[ #:]*[A-Z0-9]{4,}", ""), (r"(?m)^(Step|Note) ?[0-9]*:[ ]*", ""), (r"\(\)|\[\]", ""), (r"!{2,}", "!"), (r"\.{2,}", ".")]


@query(f"""with t as (select conv_id, turn, case when turn % 3 = 1 then 'Note 1: ' || text || '!!! ()' else text end as t from conversations where role = 'assistant'), r as (select conv_id, turn, {sql_rules("t", _SCAFFOLD)} as t from t),
l as (select conv_id, turn, {sql_sentences("t")} as s from r), m as (select conv_id, turn, list_filter(s, lambda x, i: length(x) < 8 or list_position(s, x) = i) as k from l) select conv_id, turn, array_to_string(k, ' ') as text from m""")
def TXT10_sanitise(spark, d):
    """Replies as plain text, within a think block and emphasis, or as the answer field of a JSON object; repeated sentences go."""
    turns = table(spark, d, "conversations").filter("role = 'assistant'")
    wrapped = F.when(F.col("turn") % 3 == 0, F.to_json(F.struct(F.col("text").alias("answer")))).when(F.col("turn") % 3 == 1, F.concat(F.lit("<think>"), "role", F.lit("</think>**Note 1: "), "text", F.lit("!!! ()"))).otherwise(F.col("text"))
    turns = turns.withColumn("w", wrapped)
    answer = F.coalesce(F.get_json_object(ps.json_object(F.col("w")), "$.answer"), F.col("w"))
    return turns.select("conv_id", "turn", F.array_join(tx.new_sentences(tx.replace_all(answer, _SCAFFOLD)), " ").alias("text"))


def _formed(props="props"):
    """JSON as it is, in a fence, within text, nested, or not there."""
    m, p = F.col("event_id") % 5, F.col(props)
    return F.when(m == 0, p).when(m == 1, F.concat(F.lit("So: ```json\n"), p, F.lit("\n```"))).when(m == 2, F.concat(F.lit("it is "), p, F.lit(" and {more"))).when(m == 3, F.concat(F.lit('{"a": '), p, F.lit("} tail"))).otherwise(F.lit("none"))


@query("""select event_id, case when json_valid(props) and event_id % 5 <> 4 then try_cast(json_extract_string(props, '$.k') as bigint) end as k, coalesce(json_valid(props) and event_id % 5 <> 4, false) as valid from events""")
def TXT12_json_objects(spark, d):
    found = ps.json_object(_formed())
    return table(spark, d, "events").select("event_id", F.coalesce(F.get_json_object(found, "$.k"), F.get_json_object(found, "$.a.k")).try_cast("long").alias("k"), found.isNotNull().alias("valid"))


@query("select conv_id, turn, case turn % 4 when 3 then role || ': ' || text else text end as content from conversations")
def TXT13_flatten_content(spark, d):
    """Contents as text, as an object with text or content, and as a list of parts, flattened to one string."""
    m, t = F.col("turn") % 4, F.col("text")
    parts = F.to_json(F.array(F.struct(F.concat("role", F.lit(": ")).alias("text")), F.struct(t.alias("text"))))
    content = F.when(m == 1, F.to_json(F.struct(t.alias("text")))).when(m == 2, F.to_json(F.struct(t.alias("content")))).when(m == 3, parts).otherwise(t)
    return table(spark, d, "conversations").select("conv_id", "turn", ps.flat_content(content).alias("content"))


@query("""select event_id, event_type as kind, case when length(props) > 6 then props[1:6] || '…' else coalesce(props, '') end as props, user_id::varchar as who from events""")
def TXT15_sections(spark, d):
    """Three labelled sections in an order that turns with the row."""
    labels = ["kind", "props", "who"]
    made = {"kind": F.col("event_type"), "props": F.coalesce("props", F.lit("")), "who": F.col("user_id").cast("string")}
    text = F.lit(None).cast("string")
    for k in range(3):
        order = labels[k:] + labels[:k]
        text = F.when(F.col("event_id") % 3 == k, F.concat_ws(" ", *(x for n in order for x in (F.lit(n + ":"), made[n])))).otherwise(text)
    rows = table(spark, d, "events").select("event_id", text.alias("t"))
    return rows.select("event_id", *(ps.section(F.col("t"), n, labels, 6 if n == "props" else None).alias(n) for n in labels))


@query("""select event_id, case when event_id % 4 = 3 then 'none' else event_type end as name, case when event_id % 4 = 3 then '' else user_id::varchar end as who, case when event_id % 4 = 2 then 2 else 1 end as calls from events""".replace("case when event_id % 4 = 2 then 2 else 1 end", "case event_id % 4 when 2 then 2 when 3 then 0 else 1 end"))
def TXT16_tool_calls(spark, d):
    """Calls as JSON with arguments or args, as markup, two in one text, or none."""
    m = F.col("event_id") % 4
    calls = ps.tool_calls(_called(m == 0, m == 1, m == 2))
    first = F.get(calls, F.lit(0))
    return table(spark, d, "events").select("event_id", F.coalesce(first["name"], F.lit("none")).alias("name"), F.coalesce(F.get_json_object(first["args"], "$.who"), F.lit("")).alias("who"), F.size(calls).alias("calls"))


def _called(plain, short, marked, who=None):
    """A reply with a call of the event's type for its user: as JSON, as JSON with args, as two of markup, or without a call."""
    user = F.col("user_id").cast("string") if who is None else who
    args = F.struct(user.alias("who"))
    wrap = lambda x: F.concat(F.lit("ok <tool_call>"), x, F.lit("</tool_call> done"))
    xml = F.concat(F.lit("<function="), "event_type", F.lit("><parameter=who> "), user, F.lit(" </parameter></function>"))
    return F.when(plain, wrap(F.to_json(F.struct(F.col("event_type").alias("name"), args.alias("arguments"))))).when(short, wrap(F.to_json(F.struct(F.col("event_type").alias("name"), args.alias("args"))))).when(marked, F.concat(wrap(xml), wrap(xml))).otherwise(F.lit("no call"))


@query("""select page_id, to_json({'query': 'Describe the page.', 'response': url, 'images': [url]})::varchar as swift, to_json([{'from': 'human', 'value': 'Describe the page.'}, {'from': 'gpt', 'value': url}])::varchar as share,
to_json([{'role': 'user', 'content': [{'type': 'image', 'value': url}, {'type': 'text', 'value': 'Describe the page.'}]}, {'role': 'assistant', 'content': [{'type': 'text', 'value': url}]}])::varchar as parts from pages""")
def DLG10_export_layouts(spark, d):
    ask, url = F.lit("Describe the page."), F.col("url")
    swift = F.to_json(F.struct(ask.alias("query"), url.alias("response"), F.array(url).alias("images")))
    share = F.to_json(F.array(F.struct(F.lit("human").alias("from"), ask.alias("value")), F.struct(F.lit("gpt").alias("from"), url.alias("value"))))
    part = lambda kind, x: F.struct(F.lit(kind).alias("type"), x.alias("value"))
    turn = lambda role, *content: F.struct(F.lit(role).alias("role"), F.array(*content).alias("content"))
    parts = F.to_json(F.array(turn("user", part("image", url), part("text", ask)), turn("assistant", part("text", url))))
    return table(spark, d, "pages").select("page_id", swift.alias("swift"), share.alias("share"), parts.alias("parts"))


@query("""select l.l_orderkey, l.l_linenumber, v.kind, case v.kind when 'call' then 'order ' || l.l_orderkey else 'order ' || l.l_orderkey || ' is ' || coalesce(o.o_orderstatus, 'unknown') end as text
from lineitem l left join orders o on o.o_orderkey = l.l_orderkey, (values ('call'), ('answer')) v(kind)""")
def DLG12_tool_expansion(spark, d):
    calls = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").join(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey", "left")
    call = F.concat(F.lit("order "), F.col("l_orderkey").cast("string"))
    rows = F.array(F.struct(F.lit("call").alias("kind"), call.alias("text")), F.struct(F.lit("answer").alias("kind"), F.concat(call, F.lit(" is "), F.coalesce("o_orderstatus", F.lit("unknown"))).alias("text")))
    return calls.select("l_orderkey", "l_linenumber", F.explode(rows).alias("r")).select("l_orderkey", "l_linenumber", "r.kind", "r.text")


_TOTAL, _SINGLE = 60, 30
_POOLS = f"""u as (select conv_id, count(*) filter (where role = 'user') = 1 and count(*) filter (where role = 'assistant') = 1 as single from conversations group by conv_id),
ra as (select *, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn) as asked from conversations where role in ('user', 'assistant')),
qa as (select conv_id, asked, arg_min(text, turn) as answer from ra where role = 'assistant' and asked is not null group by conv_id, asked), qq as (select qa.conv_id, qa.asked, md5(lower(c.text || chr(10) || answer)) as digest from qa join conversations c on c.conv_id = qa.conv_id and c.turn = qa.asked),
po as (select 'single' as kind, conv_id || '-' || asked as id from (select *, row_number() over (partition by digest order by conv_id, asked) as n from qq) where n = 1 union all select 'multi', conv_id::varchar from u where not single),
c as (select count(*) filter (where kind = 'single') as s, count(*) filter (where kind = 'multi') as m from po),
t1 as (select *, least(s, {_SINGLE}) as ts, case when s < {_SINGLE} then least(m, {_TOTAL} - s) else {_TOTAL - _SINGLE} end as tm from c), t2 as (select case when m < tm then least(s, ts + tm - m) else ts end as take_s, least(m, tm) as take_m from t1),
r as (select po.*, row_number() over (partition by kind order by md5(id), id) as n from po)"""


@query(f"with {_POOLS} select kind, id from r, t2 where n <= case when kind = 'single' then take_s else take_m end")
def SMP4_ratio_rebalance(spark, d):
    """60 rows, half of them single turns: dialogues of one, and pairs out of longer ones, each text once. Where one pool is short the
    other fills up. The pools' sizes, one row, reach no driver."""
    turns = table(spark, d, "conversations")
    pairs = dl.qa_pairs(turns).withColumn("digest", F.md5(F.lower(F.concat_ws("\n", "question", "answer"))))
    asked = turns.filter("role = 'user'").select("conv_id", F.col("text").alias("question"), "turn")
    first = pairs.join(asked, ["conv_id", "question"]).groupBy("pair_id", "conv_id", "digest").agg(F.min("turn").alias("asked"))
    single = sets.keep_first(first, ["digest"], ["conv_id", "asked"]).select(F.lit("single").alias("kind"), F.concat_ws("-", "conv_id", "asked").alias("id"))
    pool = single.unionByName(dl.shape(turns).filter("not single").select(F.lit("multi").alias("kind"), F.col("conv_id").cast("string").alias("id")))
    s, m = F.col("s"), F.col("m")
    c = pool.agg(F.count_if(F.col("kind") == "single").alias("s"), F.count_if(F.col("kind") == "multi").alias("m"))
    c = c.select("s", "m", F.least(s, F.lit(_SINGLE)).alias("ts"), F.when(s < _SINGLE, F.least(m, _TOTAL - s)).otherwise(_TOTAL - _SINGLE).alias("tm"))
    take = c.select(F.when(m < F.col("tm"), F.least(s, F.col("ts") + F.col("tm") - m)).otherwise(F.col("ts")).alias("take_s"), F.least(m, F.col("tm")).alias("take_m"), F.lit(1).alias("one"))
    ranked = pool.withColumn("n", F.row_number().over(Window.partitionBy("kind").orderBy(F.md5("id"), "id"))).filter(F.col("n") <= _TOTAL)
    return ranked.withColumn("one", F.lit(1)).join(F.broadcast(take), "one").filter(F.col("n") <= F.when(F.col("kind") == "single", F.col("take_s")).otherwise(F.col("take_m"))).select("kind", "id")


_QUOTA, _ATTEMPTS = 12, 50


@query(f"""with p as (select conv_id, turn, text, case when regexp_matches(text, '(?i)the') then 'ask' when regexp_matches(text, '(?i)der|ung') then 'tell' else 'other' end as bucket from conversations where role = 'assistant' and length(text) > 0),
n as (select *, row_number() over (partition by bucket order by conv_id, turn) - 1 as i, count(*) over (partition by bucket) as size from p), t as (select distinct bucket, size, unnest(range({_QUOTA * _ATTEMPTS})) as k from n),
x as (select bucket, k, cast(('0x' || md5(bucket || ':a:' || k)[1:8]) as bigint) % size as a, cast(('0x' || md5(bucket || ':b:' || k)[1:8]) as bigint) % size as b from t),
y as (select x.bucket, k, md5(na.text || chr(10) || nb.text) as digest from x join n na on na.bucket = x.bucket and na.i = a join n nb on nb.bucket = x.bucket and nb.i = b where a <> b),
z as (select bucket, digest, min(k) as k from y group by all), r as (select *, row_number() over (partition by bucket order by k) as place from z) select bucket, cast(place as int) as place, digest from r where place <= {_QUOTA}""")
def SMP7_pool_generation(spark, d):
    """Dialogues of two replies drawn from a bucket of the replies there are: distinct ones up to a quota, in at most 50 draws each."""
    t = table(spark, d, "conversations").filter("role = 'assistant' and length(text) > 0")
    pool = t.select("conv_id", "turn", "text", F.when(F.col("text").rlike("(?i)the"), "ask").when(F.col("text").rlike("(?i)der|ung"), "tell").otherwise("other").alias("bucket"))
    return sets.drawn_pairs(pool, "bucket", "text", ["conv_id", "turn"], _QUOTA, _ATTEMPTS)


@query("""with g as (select n_nationkey as k, n_name as term, 'number ' || n_nationkey || ' of region ' || n_regionkey as definition, n_regionkey as r from nation), p as (select k as a, k + 1 as b from g union all select k, k + 100 from g),
q as (select 'definition' as kind, term, null as related, 'What is ' || term || '?' as question, definition as answer from g union all select 'usage', term, null, 'How is ' || term || ' used?', definition from g union all select 'misconception', term, null, 'What is ' || term || ' not?', definition from g
union all select 'relation', x.term, y.term, 'How do ' || x.term || ' and ' || y.term || ' relate?', case when x.r = y.r then 'same' else 'apart' end from p join g x on x.k = a join g y on y.k = b union all select 'comparison', x.term, y.term, 'Compare ' || x.term || ' with ' || y.term || '.', x.definition || ' / ' || y.definition from p join g x on x.k = a join g y on y.k = b)
select * from q""")
def SMP10_glossary_expansion(spark, d):
    """Nations as a glossary, with pairs of them, of which some name terms that it lacks."""
    g = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("term"), F.concat(F.lit("number "), F.col("n_nationkey").cast("string"), F.lit(" of region "), F.col("n_regionkey").cast("string")).alias("definition"), F.col("n_regionkey").alias("r"))
    pairs = g.select(F.col("k").alias("a"), F.explode(F.array(F.col("k") + 1, F.col("k") + 100)).alias("b"))
    x, y = (g.select(F.col("k").alias(key), F.col("term").alias(f"term_{key}"), F.col("definition").alias(f"d_{key}"), F.col("r").alias(f"r_{key}")) for key in "ab")
    row = lambda kind, term, related, question, answer: F.struct(F.lit(kind).alias("kind"), term.alias("term"), related.alias("related"), question.alias("question"), answer.alias("answer"))
    t, none = F.col("term"), F.lit(None).cast("string")
    one = F.array(*(row(k, t, none, F.concat(F.lit(a), t, F.lit(b)), F.col("definition")) for k, a, b in (("definition", "What is ", "?"), ("usage", "How is ", " used?"), ("misconception", "What is ", " not?"))))
    a, b = F.col("term_a"), F.col("term_b")
    two = F.array(row("relation", a, b, F.concat(F.lit("How do "), a, F.lit(" and "), b, F.lit(" relate?")), F.when(F.col("r_a") == F.col("r_b"), "same").otherwise("apart")), row("comparison", a, b, F.concat(F.lit("Compare "), a, F.lit(" with "), b, F.lit(".")), F.concat_ws(" / ", "d_a", "d_b")))
    return g.select(F.explode(one).alias("x")).select("x.*").unionByName(pairs.join(x, "a").join(y, "b").select(F.explode(two).alias("x")).select("x.*"))


@query("select event_id, v.variant, w.layout from events, (values ('exact'), ('short'), ('typed')) v(variant), (values ('sft'), ('dpo')) w(layout) where event_id % 6 = 1")
def FBK3_argument_repair(spark, d):
    """Replies that call the right tool with wrong arguments, in three variants and two layouts."""
    rows = _replies(spark, d).withColumn("s", ps.tool_score(F.col("reply"), F.col("event_type"), F.col("args"), F.array(F.lit("done"))))
    bad = rows.filter("s.called and not s.matched").select("event_id")
    variants = lambda *x: F.explode(F.array(*map(F.lit, x)))
    return bad.withColumn("variant", variants("exact", "short", "typed")).withColumn("layout", variants("sft", "dpo"))


@query(f"""with {_CHUNKS.replace("from documents", "from " + _LINES)}, ch as (select id, row_number() over (partition by id order by p.char_start) - 1 as chunk_index, p.chunk as chunk from c),
mk as (select id, chunk_index, chunk, unnest(list_distinct(regexp_extract_all(chunk, '\\[P([0-9]+)\\]', 1)))::bigint as marker from ch), f as (select marker, arg_min(chunk, {{'id': id, 'at': chunk_index}}) as chunk from mk group by marker)
select page_id, case when length(chunk) >= 40 then chunk end as context, coalesce(length(chunk) >= 40, false) as usable, coalesce(regexp_extract(chunk, '[A-Za-z]{{4,}}'), '') as topic, {_SHARE.replace('doc_id', 'page_id')} < 0.1 as held_out from pages left join f on marker = page_id""")
def FBK6_page_samples(spark, d):
    """Pages as media records, each with the first chunk that mentions the paragraph of its number: context, topic and split."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(x) > 0)
    marked = F.array_join(F.transform(lines, lambda x, i: F.concat(F.lit("[P"), (i + 1).cast("string"), F.lit("] "), x)), "\n")
    found = rt.chunks(table(spark, d, "documents"), "doc_id", marked)
    markers = F.array_distinct(F.regexp_extract_all("chunk", F.lit(r"\[P([0-9]+)\]"), F.lit(1)))
    first = found.select(F.explode(markers).alias("page_id"), F.struct("id", "chunk_index").alias("place"), "chunk").groupBy(F.col("page_id").cast("long").alias("page_id")).agg(F.min_by("chunk", "place").alias("chunk"))
    rows = table(spark, d, "pages").select("page_id").join(first, "page_id", "left")
    long = F.coalesce(F.length("chunk") >= 40, F.lit(False))
    return rows.select("page_id", F.when(long, F.col("chunk")).alias("context"), long.alias("usable"), F.coalesce(F.regexp_extract("chunk", "[A-Za-z]{4,}", 0), F.lit("")).alias("topic"), (sets.md5_share(F.col("page_id").cast("string")) < 0.1).alias("held_out"))


@query("select item_id, d.doc_id is not null as found, array_to_string(string_split(d.text, chr(10))[1:2], ' ') as hint from benchmark b left join documents d on d.doc_id = b.item_id")
def FBK7_eval_assembly(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), "text")
    rows = table(spark, d, "benchmark").select("item_id").join(docs.withColumn("there", F.lit(True)), "item_id", "left")
    return rows.select("item_id", F.coalesce("there", F.lit(False)).alias("found"), F.array_join(F.slice(F.split("text", "\n"), 1, 2), " ").alias("hint"))


@query("""with q as (select item_id as query_id, list_distinct(string_split(text, '')) as c, list_distinct(list_transform(list_zip(string_split(text, '')[1:-2], string_split(text, '')[2:]), lambda p: p[1] || p[2])) as p from benchmark),
t as (select doc_id as id, string_split(text[1:1000], '') as cs from documents), d as (select id, list_distinct(cs) as c, list_distinct(list_transform(list_zip(cs[1:-2], cs[2:]), lambda p: p[1] || p[2])) as p from t),
f as (select query_id, id, len(list_intersect(q.c, d.c)) + 2 * len(list_intersect(q.p, d.p)) as n from q, d), o as (select *, row_number() over (partition by query_id order by n desc, id) as place from f)
select query_id, id, n, cast(place as int) as place from o where place <= 5""")
def RET13_character_fallback(spark, d):
    """All documents ranked for each item by the characters and pairs of characters of it that their beginnings hold."""
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("q"))
    return rt.fallback(asked, table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"))


@query(f"""with {_LEX}, h as (select rk.query_id, rk.id, rk.rank, md5(lower(d.text[1:100])) as sig, d.source, lower(d.text) as t, d.n_chars >= 600 as long, list_distinct(regexp_extract_all(lower(b.text), '[\\p{{L}}]{{12,}}')) as words from rk join documents d on d.doc_id = rk.id join benchmark b on b.item_id = rk.query_id where rank <= 10),
k as (select query_id, rank, len(list_filter(words, lambda w: contains(t, w))) > 0 as hit from h where rank <= 3)
select query_id, count(*) as hits, round(1 - count(distinct sig)::double / count(*), 6) as duplicates, count(distinct source) as sources, count(*) filter (where not long) as short_hits, max(case when rank = 1 and long then 1 else 0 end)::int as top_long,
round(coalesce(1.0::double / (select min(rank) from k where k.query_id = h.query_id and hit), 0), 6) as keyword_rr from h group by query_id""")
def EVL7_hit_quality(spark, d):
    """Hits of an item: the share of those whose beginnings repeat, their sources, how many are short texts (which stand for images),
    whether the first is long, and the reciprocal rank, within three, of the first that holds one of the item's long words."""
    texts = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.md5(F.lower(F.substring("text", 1, 100))).alias("sig"), "source", F.lower("text").alias("t"), (F.col("n_chars") >= 600).alias("long"))
    words = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]{12,}"), F.lit(0))).alias("words"))
    h = _lexical(spark, d, 10).join(texts, "id").join(words, "query_id")
    first = F.min(F.when((F.col("rank") <= 3) & F.exists("words", lambda w: F.contains(F.col("t"), w)), F.col("rank")))
    return h.groupBy("query_id").agg(
        F.count("*").alias("hits"), r6(1 - F.count_distinct("sig") / F.count("*")).alias("duplicates"), F.count_distinct("source").alias("sources"), F.count_if(~F.col("long")).alias("short_hits"),
        F.max(F.when((F.col("rank") == 1) & F.col("long"), 1).otherwise(0)).alias("top_long"), r6(F.coalesce(1.0 / first, F.lit(0.0))).alias("keyword_rr"),
    )


def _replies(spark, d):
    """Replies to events, which expect a call of the event's type for its user: right as JSON, with another user, right as markup
    with the number as text, a call of another tool, none, and a call with another user before the right one."""
    m, wrong = F.col("event_id") % 6, (F.col("user_id") + 1).cast("string")
    right = _called(m == 0, F.lit(False), m == 2)
    other = F.concat(F.lit("done <tool_call>"), F.to_json(F.struct(F.lit("lookup").alias("name"), F.struct("user_id").alias("args"))), F.lit("</tool_call>"))
    both = F.concat(_called(F.lit(False), m == 5, F.lit(False), wrong), _called(m == 5, F.lit(False), F.lit(False)))
    reply = F.when(m == 1, _called(F.lit(False), m == 1, F.lit(False), wrong)).when(m == 3, other).when(m == 5, both).otherwise(right)
    return table(spark, d, "events").select("event_id", "event_type", reply.alias("reply"), F.to_json(F.struct(F.col("user_id").alias("who"))).alias("args"))


@query("""select event_id, event_id % 6 in (0, 1, 2, 5) as called, event_id % 6 in (0, 2, 5) as matched, true as valid, round(case when event_id % 6 in (0, 1, 2, 5) then 0.4::double else 0 end + case when event_id % 6 in (0, 2, 5) then 0.35::double else 0 end + 0.15::double + case when event_id % 6 = 4 then 0.0::double else 0.1::double end, 6) as score from events""")
def EVL14_tool_score(spark, d):
    s = ps.tool_score(F.col("reply"), F.col("event_type"), F.col("args"), F.array(F.lit("done")))
    return _replies(spark, d).select("event_id", s.alias("s")).select("event_id", "s.called", "s.matched", "s.valid", r6(F.col("s.score")).alias("score"))


_GRID = [(k, c) for k in (1, 3, 5) for c in (0.0, 0.5)]


@query(f"""with {_FULL}, bs as (select item_id, regexp_replace(text, '\\s+', '', 'g') as passage from benchmark), swv as (select * from (values {", ".join(f"({k}, {c}::double)" for k, c in _GRID)}) x(top_k, least)),
swh as (select v.*, b.item_id, co.id, co.coverage, co.rank, coalesce(contains(regexp_replace(co.text, '\\s+', '', 'g'), passage), false) as good from swv v join bs b on true left join co on co.query_id = b.item_id and co.rank <= v.top_k and co.coverage >= v.least),
swq as (select top_k, least, item_id, min(case when good then rank end) as first, count(id) as hits, avg(coverage) as coverage from swh group by all),
swm as (select top_k, least, round(avg(case when first is not null then 1.0::double else 0.0::double end), 6) as recall, round(avg(coalesce(1.0::double / first, 0)), 6) as mrr, round(avg(coalesce(coverage, 0)), 6) as coverage, round(avg(hits), 6) as hits from swq group by all)
select * from swm order by recall desc, mrr desc, coverage desc, hits, top_k limit 5""".replace("limit 5", ", least limit 5").replace("top_k ,", "top_k,"))
def EVL18_sweep(spark, d):
    """Retrieval with several numbers of hits and least coverages: the five best by recall, reciprocal rank, coverage, fewer hits."""
    full = _second(spark, d).withColumn("coverage", rt.coverage(F.col("terms"), F.col("text"))).withColumn("good", F.contains(F.regexp_replace("text", r"[ \t\n\r\f\x0B]+", ""), F.regexp_replace("q", r"[ \t\n\r\f\x0B]+", "")))
    grid = F.explode(F.array(*(F.struct(F.lit(k).alias("top_k"), F.lit(c).alias("least")) for k, c in _GRID)))
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id")).withColumn("v", grid).select("query_id", "v.*")
    hits = full.select("query_id", "id", "rank", "coverage", "good").withColumn("v", grid).select("query_id", "v.*", "id", "rank", "coverage", "good").filter("rank <= top_k and coverage >= least")
    q = asked.join(hits, ["query_id", "top_k", "least"], "left").groupBy("query_id", "top_k", "least").agg(F.min(F.when(F.col("good"), F.col("rank"))).alias("first"), F.count("id").alias("hits"), F.avg("coverage").alias("coverage"))
    m = q.groupBy("top_k", "least").agg(r6(F.avg(F.when(F.col("first").isNotNull(), 1.0).otherwise(0.0))).alias("recall"), r6(F.avg(F.coalesce(1.0 / F.col("first"), F.lit(0.0)))).alias("mrr"), r6(F.avg(F.coalesce("coverage", F.lit(0.0)))).alias("coverage"), r6(F.avg("hits")).alias("hits"))
    return m.orderBy(F.desc("recall"), F.desc("mrr"), F.desc("coverage"), "hits", "top_k", "least").limit(5)


_STANCE = "case when regexp_matches({t}, '(?i)not|never') and regexp_matches({t}, '(?i)yes|true') then 'mixed' when regexp_matches({t}, '(?i)not|never') then 'deny' when regexp_matches({t}, '(?i)yes|true') then 'affirm' else 'unknown' end"


def _stance(t):
    deny, affirm = t.rlike("(?i)not|never"), t.rlike("(?i)yes|true")
    return F.when(deny & affirm, "mixed").when(deny, "deny").when(affirm, "affirm").otherwise("unknown")


_JUDGED = f"""p as ({_PREDS}), v as (select p.*, {_STANCE.format(t='p.text')} as stance, regexp_matches(p.text, '(?i)licen[sc]e|contact') as evidence, d.source from p join documents d using (doc_id)),
j as (select *, case when gold = pred and evidence then 'supported' when gold = pred and stance = 'unknown' then 'right_unclear' when gold = pred then 'right_unsupported' when evidence then 'wrong_with_evidence' when source in ('src0', 'src1') then 'wrong_source' else 'wrong' end as verdict from v)"""


def _judged(spark, d):
    p = predictions(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id").withColumn("stance", _stance(F.col("text"))).withColumn("evidence", F.col("text").rlike("(?i)licen[sc]e|contact"))
    right = F.col("gold") == F.col("pred")
    verdict = F.when(right & F.col("evidence"), "supported").when(right & (F.col("stance") == "unknown"), "right_unclear").when(right, "right_unsupported").when(F.col("evidence"), "wrong_with_evidence").when(F.col("source").isin("src0", "src1"), "wrong_source").otherwise("wrong")
    return p.withColumn("verdict", verdict)


@query(f"with {_JUDGED} select doc_id, stance, verdict from j")
def EVL19_judge_labels(spark, d):
    """Verdicts from the gold and predicted label, the text's stance, its evidence and its source."""
    return _judged(spark, d).select("doc_id", "stance", "verdict")


@query(f"""with {_FULL}, a as (select query_id, list_distinct(list(file)) as f, arg_min(text, rank) as t from co where rank <= 5 group by query_id), sb as (select *, row_number() over (partition by query_id order by round(coverage, 9) desc, id) as r2 from co),
b as (select query_id, list_distinct(list(file)) as f, arg_min(text, r2) as t from sb where r2 <= 5 group by query_id),
c as (select query_id, {_STANCE.format(t='a.t')} = {_STANCE.format(t='b.t')} as same_stance, a.t = b.t as exact, contains(a.t, q.text) as gold_a, contains(b.t, q.text) as gold_b, round(len(list_intersect(a.f, b.f))::double / len(list_distinct(list_concat(a.f, b.f))), 6) as sources from a join b using (query_id) join benchmark q on q.item_id = query_id)
select *, case when exact then 'same_answer' when same_stance and gold_a = gold_b then 'consistent' when same_stance then 'one_right' else 'conflict' end as verdict from c""")
def EVL20_consistency(spark, d):
    """Two retrieval models for each item: whether their first hits take the same stance, are the same, hold the item, and how far
    the files of their five best are the same; and a verdict."""
    full = _second(spark, d)
    b = rt.top(full.withColumn("score", rt.coverage(F.col("terms"), F.col("text"))), "query_id", "score", "id", 5)
    side = lambda rows, n: rows.filter("rank <= 5").groupBy("query_id").agg(F.collect_set("file").alias(f"f{n}"), F.min_by("text", "rank").alias(f"t{n}"))
    q = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("q"))
    both = side(full, 1).join(side(b, 2), "query_id").join(q, "query_id")
    c = both.select("query_id", (_stance(F.col("t1")) == _stance(F.col("t2"))).alias("same_stance"), (F.col("t1") == F.col("t2")).alias("exact"), F.contains("t1", "q").alias("gold_a"), F.contains("t2", "q").alias("gold_b"), r6(F.size(F.array_intersect("f1", "f2")) / F.size(F.array_union("f1", "f2"))).alias("sources"))
    return c.withColumn("verdict", F.when(F.col("exact"), "same_answer").when(F.col("same_stance") & (F.col("gold_a") == F.col("gold_b")), "consistent").when(F.col("same_stance"), "one_right").otherwise("conflict"))


_FINDINGS = [("error_rate", 0.15, "high", "too many errors"), ("mean_value", 20.0, "medium", "slow on average"), ("low_share", 0.5, "low", "many small values")]


@query("""with s as (select avg(case when event_type = 'error' then 1.0::double else 0.0::double end) as error_rate, avg(value) as mean_value, avg(case when value < 10 then 1.0::double else 0.0::double end) as low_share from events)
""" + " union all ".join(f"select '{sev}' as severity, '{m}' as metric, '{text}' as finding from s where {m} > {t}" for m, t, sev, text in _FINDINGS))
def LOG7_findings(spark, d):
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    s = table(spark, d, "events").agg(F.avg(one(F.col("event_type") == "error")).alias("error_rate"), F.avg("value").alias("mean_value"), F.avg(one(F.col("value") < 10)).alias("low_share"))
    found = F.array(*(F.when(F.col(m) > t, F.struct(F.lit(sev).alias("severity"), F.lit(m).alias("metric"), F.lit(text).alias("finding"))) for m, t, sev, text in _FINDINGS))
    return s.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("r")).select("r.*")


@query("""select l_orderkey, l_linenumber, case l_linenumber % 4 when 0 then 'european' when 1 then 'ratio' when 2 then 'european' else 'none' end as formula, case when l_linenumber % 4 < 3 then l_extendedprice::decimal(18,2)::double end as first, case l_linenumber % 4 when 1 then l_discount::decimal(4,2)::double when 0 then (1 + l_discount)::decimal(4,2)::double when 2 then (1 + l_discount)::decimal(4,2)::double end as second from lineitem""")
def RUL5_arguments(spark, d):
    """Questions that name a formula and label its numbers, in either order, or only give them in place, and ones of none."""
    price, share = (F.col(c).cast("decimal(18,2)").cast("string") for c in ("l_extendedprice", "l_discount"))
    odds, m = (1 + F.col("l_discount").cast("decimal(4,2)")).cast("decimal(4,2)").cast("string"), F.col("l_linenumber") % 4
    text = F.when(m == 0, F.concat(F.lit("odds "), odds, F.lit(", stake "), price)).when(m == 1, F.concat(F.lit("a share of "), share, F.lit(" from amount: "), price)).when(m == 2, F.concat(F.lit("a bet of "), price, F.lit(" at "), odds)).otherwise(F.lit("hello"))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.alias("t"))
    a = rl.formula_arguments(F.col("t"), [("ratio", "share|ratio", ["amount", "share of"]), ("european", "odds|bet|stake", ["stake", "odds"])])
    return rows.select("l_orderkey", "l_linenumber", a.alias("a")).select("l_orderkey", "l_linenumber", "a.formula", F.get("a.numbers", F.lit(0)).alias("first"), F.get("a.numbers", F.lit(1)).alias("second"))
