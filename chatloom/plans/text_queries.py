"""Text projections and quality gates over the given tables, with SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions import text as tx
from chatloom.operators import quality as ql

from .common import NOISE, PII, RISK, SECRETS, TERMS, sql_form, sql_lines, sql_rules, sql_sentences, sql_squeeze, sql_strip, table

QUERIES, SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t():
    return F.col("text")


@query(f"""select page_id, {sql_strip("regexp_replace(replace(regexp_replace(regexp_replace(replace(html, chr(13), ' '), '<[^>]+>', ' ', 'g'), '(?i)https?://[^ \\t\\n\\x0B\\f\\r]+', ' <URL> ', 'g'), '&nbsp;', ' '), '[ \\t\\n\\x0B\\f\\r\\x{A0}\\x{3000}]+', ' ', 'g')")} as text from pages""")
def TXT1_normalize(spark, d):
    return table(spark, d, "pages").select("page_id", tx.normalize(F.col("html")).alias("text"))


@query(f"select doc_id, {sql_rules('text', PII)} as text from documents")
def TXT2_mask_pii(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.replace_all(_t(), PII).alias("text"))


@query(f"select doc_id, {sql_rules('text', SECRETS)} as text, text <> {sql_rules('text', SECRETS)} as changed from documents")
def TXT3_redact_secrets(spark, d):
    made = tx.replace_all(_t(), SECRETS)
    return table(spark, d, "documents").select("doc_id", made.alias("text"), (_t() != made).alias("changed"))


@query(f"""with l as (select doc_id, {sql_lines('text')} as a, len(string_split(text, chr(10))) as n from documents),
k as (select doc_id, n, list_filter(a, lambda x: length(x) <= 2500 and not regexp_matches(x, '(?i){"|".join(f"(?:{p})" for p in NOISE)}')) as b from l)
select doc_id, array_to_string(b, chr(10)) as text, cast(n - len(b) as int) as removed from k""")
def TXT4_noise_lines(spark, d):
    kept = tx.clean_lines(_t(), NOISE)
    return table(spark, d, "documents").select("doc_id", F.array_join(kept, "\n").alias("text"), (F.size(F.split(_t(), "\n")) - F.size(kept)).alias("removed"))


@query(f"""with l as (select doc_id, {sql_lines('text')} as a from documents),
x as (select doc_id, unnest(a) as line, generate_subscripts(a, 1) as i from l),
y as (select *, case when line = lag(line) over (partition by doc_id order by i) then 0 else 1 end as fresh from x),
z as (select *, sum(fresh) over (partition by doc_id order by i) as run from y),
r as (select doc_id, run, count(*) as n from z group by all),
m as (select doc_id, max(n) as longest from r group by all),
k as (select doc_id, string_agg(line, chr(10) order by i) filter (where fresh = 1) as text, count(*) - sum(fresh) as removed from z group by all)
select l.doc_id, coalesce(k.text, '') as text, cast(coalesce(removed, 0) as int) as removed, cast(coalesce(longest, 0) as int) as longest_run
from l left join k using (doc_id) left join m using (doc_id)""")
def TXT5_adjacent_lines(spark, d):
    a = table(spark, d, "documents").select("doc_id", tx.lines(_t()).alias("a"))
    kept = tx.unrepeated(F.col("a"))
    return a.select("doc_id", F.array_join(kept, "\n").alias("text"), (F.size("a") - F.size(kept)).alias("removed"), tx.longest_run(F.col("a")).alias("longest_run"))


@query(f"""with l as (select doc_id, {sql_lines('text')} as a from documents),
x as (select doc_id, unnest(a) as line, generate_subscripts(a, 1) as i from l),
y as (select *, {sql_form('line')} as form, row_number() over (partition by doc_id, {sql_form('line')} order by i) as k from x)
select l.doc_id, coalesce(string_agg(line, chr(10) order by i) filter (where k = 1 and form <> ''), '') as text,
cast(count(i) filter (where k > 1 or form = '') as int) as removed from l left join y using (doc_id) group by l.doc_id""")
def TXT6_line_dedup(spark, d):
    a = table(spark, d, "documents").select("doc_id", tx.lines(_t()).alias("a"))
    kept = tx.first_of_each(F.col("a"), tx.line_form)
    return a.select("doc_id", kept.alias("k"), F.size("a").alias("n")).select("doc_id", F.array_join("k", "\n").alias("text"), (F.col("n") - F.size("k")).alias("removed"))


@query(f"""with x as (select doc_id, unnest({sql_lines('text')}) as line, generate_subscripts({sql_lines('text')}, 1) as i from documents),
y as (select *, {sql_form('line')} as form from x)
select doc_id as id, arg_min(line, i) as line, count(*) as count from y where length(form) >= 4 group by doc_id, form having count(*) >= 2""")
def TXT7_repeated_lines(spark, d):
    return ql.repeated_lines(table(spark, d, "documents"), "doc_id", _t())


@query(f"""select doc_id, array_to_string(list_distinct_in_order, chr(10)) as text from (
select doc_id, list_filter(a, lambda x, i: list_position(a, x) = i) as list_distinct_in_order from (
select doc_id, list_filter({sql_lines('text')}, lambda x: len(regexp_extract_all(x, '\\p{{L}}')) >= 4 and len(regexp_extract_all(x, '\\p{{L}}')) >= 0.35 * length({sql_squeeze('x')}) and not regexp_matches(x, '[%$&*#|!]{{3,}}')) as a from documents))""")
def TXT8_script_lines(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(tx.script_lines(_t()), "\n").alias("text"))


@query(f"""with s as (select doc_id, {sql_sentences('text')} as a from documents),
x as (select doc_id, unnest(a) as s, generate_subscripts(a, 1) as i from s),
y as (select *, row_number() over (partition by doc_id, s order by i) as k from x)
select s.doc_id, coalesce(string_agg(s, ' ' order by i) filter (where k = 1 or length(s) < 8), '') as text,
coalesce(bool_or(k > 1 and length(s) >= 8), false) as changed from s left join y using (doc_id) group by s.doc_id""".replace("select s.doc_id, coalesce(string_agg(s,", "select s.doc_id, coalesce(string_agg(y.s,").replace("length(s) < 8)", "length(y.s) < 8)").replace("length(s) >= 8)", "length(y.s) >= 8)"))
def TXT9_sentence_dedup(spark, d):
    s = table(spark, d, "documents").select("doc_id", tx.sentences(_t()).alias("s"), tx.new_sentences(_t()).alias("k"))
    return s.select("doc_id", F.array_join("k", " ").alias("text"), (F.size("s") != F.size("k")).alias("changed"))


@query(f"""select conv_id, turn, {sql_strip("regexp_replace(regexp_replace('<think>' || role || chr(10) || '</think>' || text, '(?is)<think>.*?</think>', '', 'g'), '(?is)```think.*?```', '', 'g')")} as text from conversations""")
def TXT11_strip_think(spark, d):
    wrapped = F.concat(F.lit("<think>"), "role", F.lit("\n</think>"), "text")
    return table(spark, d, "conversations").select("conv_id", "turn", tx.without_think(wrapped).alias("text"))


@query("""select event_id, list_filter(list_transform(string_split_regex(event_type || ',' || coalesce(props, ''), '[,;:]'), lambda x: trim(x)), lambda x: x <> '') as items,
case when event_type in ('purchase', 'signup') then true when event_type in ('error') then false end as flag from events""")
def TXT14_coercion(spark, d):
    items = F.filter(F.transform(F.split(F.concat("event_type", F.lit(","), F.coalesce("props", F.lit(""))), "[,;:]"), lambda x: F.trim(x)), lambda x: x != "")
    flag = F.when(F.col("event_type").isin("purchase", "signup"), True).when(F.col("event_type").isin("error"), False)
    return table(spark, d, "events").select("event_id", items.alias("items"), flag.alias("flag"))


@query(f"""with s as (select doc_id, unnest({sql_sentences('text')}) as s, generate_subscripts({sql_sentences('text')}, 1) as i from documents),
f as (select doc_id, s, min(i) as i from s where length(s) >= 6 group by all),
g as (select *, case when regexp_matches(s, '(?i)(licensed|released|contact|call)') then 3 else 0 end + case when regexp_matches(s, '[0-9]') then 2 else 0 end + case when length(s) <= 60 then 1 else 0 end as score from f),
r as (select *, row_number() over (partition by doc_id order by score desc, length(s), i) as rank from g)
select doc_id, cast(rank as int) as rank, s as sentence, cast(score as int) as score from r where rank <= 3""")
def TXT17_ranked_sentences(spark, d):
    from pyspark.sql import Window

    s = table(spark, d, "documents").select("doc_id", F.posexplode(tx.sentences(_t())).alias("i", "sentence")).filter("length(sentence) >= 6")
    s = s.groupBy("doc_id", "sentence").agg(F.min("i").alias("i"))
    score = F.when(F.col("sentence").rlike("(?i)(licensed|released|contact|call)"), 3).otherwise(0) + F.when(F.col("sentence").rlike("[0-9]"), 2).otherwise(0) + F.when(F.length("sentence") <= 60, 1).otherwise(0)
    s = s.withColumn("score", score).withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("score"), F.length("sentence"), "i")))
    return s.filter("rank <= 3").select("doc_id", "rank", "sentence", "score")


@query("""select item_id, list_filter(list_filter(a, lambda x, i: list_position(a, x) = i), lambda x: x not in ('the', 'of')) as terms from (select item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as a from benchmark)""")
def TXT18_terms(spark, d):
    return table(spark, d, "benchmark").select("item_id", tx.terms(_t(), ["the", "of"]).alias("terms"))


_ACCENTS = r"[\x{C0}-\x{24F}]"


@query(f"""with t as (select item_id, regexp_extract_all(lower(regexp_replace(text, '{_ACCENTS}', ' ', 'g')), '[\\p{{L}}\\p{{N}}]+') as a, string_split(regexp_replace(text, '[^\\x{{C0}}-\\x{{24F}}]', '', 'g'), '') as cs from (select doc_id as item_id, text from documents))
select item_id, list_sort(list_distinct(list_filter(list_concat(a, list_transform(list_zip(cs[1:-2], cs[2:]), lambda p: p[1] || p[2])), lambda x: x not in ('the', 'of')))) as terms from t""")
def TXT18_script_pairs(spark, d):
    """Terms with pairs of characters of a script, here accented letters; in order of the alphabet."""
    return table(spark, d, "documents").select(F.col("doc_id").alias("item_id"), F.array_sort(tx.terms(_t(), ["the", "of"], _ACCENTS)).alias("terms"))


def _gram_sql(n: int, least: int) -> str:
    return f"""with b as (select doc_id as id, {sql_squeeze("coalesce(text, '')")} as s from documents),
g as (select id, length(s) as size, substring(s, cast(i as bigint), {n}) as gram from b, unnest(range(1, length(s) - {n} + 2)) as u(i) where length(s) >= {max(n, least)}),
c as (select id, size, gram, count(*) as n from g group by all), m as (select id, size, max(n) as most from c group by all)"""


@query(_gram_sql(12, 80) + " select id, most, most >= 6 and most * 12 >= 0.35 * size as heavy from m")
def FLT1_heavy_repetition(spark, d):
    return ql.heavy_repetition(table(spark, d, "documents"), "doc_id", _t())


@query(_gram_sql(8, 0) + " select b.id, coalesce(most, 1) as score from b left join m using (id)")
def FLT2_span_score(spark, d):
    return ql.span_score(table(spark, d, "documents"), "doc_id", _t())


@query(f"""with s as (select doc_id as id, unnest({sql_sentences('text')}) as sentence from documents)
select id, sentence, count(*) as count from s where length(sentence) >= 8 group by all having count(*) >= 3""")
def FLT3_repeated_sentences(spark, d):
    return ql.repeated_sentences(table(spark, d, "documents"), "doc_id", _t())


@query("select doc_id, list_sort(list_filter([" + ", ".join(f"case when regexp_matches(text, '(?i){'|'.join(f'(?:{p})' for p in ps)}') then '{k}' end" for k, ps in RISK.items()) + "], lambda x: x is not null)) as labels from documents")
def FLT4_risk_labels(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.labels_of(_t(), RISK).alias("labels"))


@query("select doc_id from documents where regexp_matches(text, '(?i)(?:licen[sc]e)|(?:password)|(?:!!)')")
def FLT5_any_pattern(spark, d):
    return table(spark, d, "documents").filter(_t().rlike("(?i)(?:licen[sc]e)|(?:password)|(?:!!)")).select("doc_id")


@query("""with h as (select doc_id, text, regexp_matches(text, '(?i)license')::int + regexp_matches(text, '(?i)reserved')::int + regexp_matches(text, '(?i)password')::int as n from documents)
select doc_id, regexp_matches(text, '[A-Z]{2}[0-9]{5,}') or n >= 2 or (n >= 1 and regexp_matches(text, '[0-9]{13,19}')) as ticket from h""")
def FLT6_k_of_n(spark, d):
    return table(spark, d, "documents").select("doc_id", ql.ticket_like(_t(), "[A-Z]{2}[0-9]{5,}", ["license", "reserved", "password"], "[0-9]{13,19}").alias("ticket"))


def _meant_sql(term: str, negations: str, left: int, right: int, text: str = "text", actions: tuple[str, ...] = (), i: str = "i") -> str:
    n = len(term)
    around = lambda a, b: f"substring({text}, greatest({i} - {a}, 1), {i} - greatest({i} - {a}, 1) + {n} + {b})"
    called = " and (" + " or ".join(_meant_sql(x, negations, 10, 8, around(18, 22), i="j") for x in actions) + ")" if actions else ""
    # none of the terms can overlap itself, so the parts between them tell their places
    parts = f"string_split(lower({text}), '{term}')"
    places = f"list_transform(range(1, len({parts})), lambda {i}k: cast(list_sum(list_transform(({parts})[1:{i}k], lambda {i}p: length({i}p))) + ({i}k - 1) * {n} + 1 as bigint))"
    return f"len(list_filter({places}, lambda {i}: not regexp_matches({around(left, right)}, '(?i){negations}'){called})) > 0"


#: Terms that count as promotion, and what must be called for beside them.
_PROMOTION, _ACTIONS = ("license", "reserved"), ("under", "all", "code")


@query("select doc_id, list_sort(list_filter([" + ", ".join(f"case when {_meant_sql(t, 'not|no |never|without', 14, 18, actions=_ACTIONS if t in _PROMOTION else ())} then '{t}' end" for t in TERMS) + "], lambda x: x is not null)) as hits from documents")
def FLT7_meant_terms(spark, d):
    """Terms that are meant; those of promotion only beside a call to act that isn't denied."""
    found = F.array(*(F.when(tx.meant(_t(), t, ["not", "no ", "never", "without"], actions=_ACTIONS if t in _PROMOTION else ()), F.lit(t)) for t in TERMS))
    return table(spark, d, "documents").select("doc_id", F.array_sort(F.filter(found, lambda x: x.isNotNull())).alias("hits"))


@query(f"select doc_id, contains(lower(text), 'license') as mentions, {_meant_sql('license', 'under the', 16, 16)} as risky from documents")
def FLT8_safe_context(spark, d):
    return table(spark, d, "documents").select("doc_id", F.lower(_t()).contains("license").alias("mentions"), tx.meant(_t(), "license", ["under the"], 16, 16).alias("risky"))


_GROUPS = {"insult": ["idiot", "moron", "trash"], "legal": ["license", "reserved"]}


@query(" union all ".join(f"select '{g}' as \"group\", '{k}' as keyword, count(*) as texts from documents where contains(lower(text), '{k}') having count(*) > 0" for g, ks in _GROUPS.items() for k in ks))
def FLT9_keyword_audit(spark, d):
    return ql.keyword_audit(table(spark, d, "documents"), _t(), _GROUPS)


_HELD = "list_filter([" + ", ".join(f"case when contains(lower(text), '{k}') then '{g}' end" for g, ks in _GROUPS.items() for k in ks) + "], lambda x: x is not null)"
_TOLD = "list_filter([" + ", ".join(f"case when contains(lower(text), '{k}') then '{k}' end" for ks in _GROUPS.values() for k in ks) + "], lambda x: x is not null)"
_LONG = f"list_filter({sql_lines('text')}, lambda x: length(x) >= 4)"


@query(f"""with a as (select doc_id as id, list_sort(list_distinct({_HELD})) as groups, list_sort({_TOLD}) as terms, len({_LONG}) > len(list_distinct({_LONG})) as repeated, regexp_matches(ltrim(text), '^(?:Analysis|The |Der )') as prefixed from documents)
select *, len(groups) > 0 or repeated or prefixed as contaminated from a""")
def FLT9_contaminated(spark, d):
    """Texts that hold a keyword, repeat a line or begin with a prefix."""
    return ql.contaminated(table(spark, d, "documents"), "doc_id", _t(), _GROUPS, "Analysis|The |Der ")


@query("""select conv_id, turn, regexp_matches(trim(string_split(text, chr(10))[1]), '^(The|In|Of)[a-z]*') as prefix, regexp_matches(text, '(?i)</?think>') as leak from conversations""")
def FLT10_prefix_leak(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.trim(F.split(_t(), "\n")[0]).rlike("^(The|In|Of)[a-z]*").alias("prefix"), _t().rlike("(?i)</?think>").alias("leak"))


@query("select d.doc_id, source from documents d where doc_id not in (select doc_id from labels where quality = 0)")
def FLT13_deny_list(spark, d):
    return ql.denied(table(spark, d, "documents"), table(spark, d, "labels").filter("quality = 0"), "doc_id").select("doc_id", "source")


@query(f"""with t as (select page_id, {sql_lines("regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]+>', chr(10), 'g')")} as a from pages)
select page_id, len(a) >= 2 and len(regexp_extract_all(array_to_string(a, ''), '\\p{{L}}')) >= 40 and len(list_filter(a, lambda x: length(x) >= 20)) >= 2 as good from t""")
def FLT14_page_gate(spark, d):
    plain = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), "<[^>]+>", "\n")
    a = F.col("a")
    good = (F.size(a) >= 2) & (F.regexp_count(F.array_join(a, ""), F.lit(r"\p{L}")) >= 40) & (F.size(F.filter(a, lambda x: F.length(x) >= 20)) >= 2)
    return table(spark, d, "pages").select("page_id", tx.lines(plain).alias("a")).select("page_id", good.alias("good"))


@query(f"""with x as (select doc_id as id, unnest(case when len({sql_lines('text')}) = 0 then [null] else {sql_lines('text')} end) as line, generate_subscripts(case when len({sql_lines('text')}) = 0 then [null] else {sql_lines('text')} end, 1) as pos from documents),
f as (select *, coalesce(regexp_matches(line, 'idiot|!!'), false) as bad, length(line) >= 8 and len(regexp_extract_all(line, '\\p{{L}}')) >= 6 and not regexp_matches(line, 'idiot|!!') and len(regexp_extract_all(line, '\\p{{L}}')) >= 0.45 * length({sql_squeeze('line')}) as fine from x),
n as (select *, case when fine then len(regexp_extract_all(line, '(?i)the|der|que')) else 0 end as n from f),
r as (select *, bool_or(bad) over (partition by id) as banned, row_number() over (partition by id order by coalesce(fine, false) desc, n desc, length(line) desc, pos) as rank from n),
o as (select id, count(*) filter (where fine) as kept, cast(sum(n) as bigint) as hits, bool_or(banned) as banned from r where rank <= 8 group by id)
select id, kept, hits, case when banned then 'banned' when kept = 0 then 'no_lines' when hits < 2 then 'low_relevance' else 'ok' end as reason from o""")
def FLT17_best_lines(spark, d):
    return ql.best_lines(table(spark, d, "documents"), "doc_id", _t(), ["the", "der", "que"], banned="idiot|!!")


@query("""select event_id, list_filter([case when list_sort(json_keys(props)) <> ['k'] then 'keys' end, case when event_type not in ('click', 'purchase', 'signup', 'view') then 'type' end, case when value is null then 'value' end], lambda x: x is not null) as violations from events""")
def FLT18_row_contract(spark, d):
    found = F.array(F.when(F.array_sort(F.json_object_keys("props")) != F.array(F.lit("k")), "keys"), F.when(~F.col("event_type").isin("click", "purchase", "signup", "view"), "type"), F.when(F.col("value").isNull(), "value"))
    return table(spark, d, "events").select("event_id", F.filter(found, lambda x: x.isNotNull()).alias("violations"))


@query(f"""with t as (select doc_id, {sql_lines("text")} as a, regexp_replace(text, '<[^>]*>|https?://[^ \\n]*', '', 'g') as v from documents)
select doc_id, len(a) >= 2 and len(regexp_extract_all(array_to_string(a, ''), '\\p{{L}}')) >= 12 as context, len(regexp_extract_all(v, '\\p{{L}}')) < 40 or len(regexp_extract_all(v, '\\p{{L}}')) < 0.5 * length({sql_squeeze("v")}) as low_signal from t""")
def FLT14_context_gate(spark, d):
    """Whether a text is enough as a context, and whether what is visible of it says little."""
    letters, v = F.lit(r"\p{L}"), F.regexp_replace(_t(), r"<[^>]*>|https?://[^ \n]*", "")
    a = table(spark, d, "documents").select("doc_id", tx.lines(_t()).alias("a"), v.alias("v"))
    n = F.regexp_count("v", letters)
    return a.select("doc_id", ((F.size("a") >= 2) & (F.regexp_count(F.array_join("a", ""), letters) >= 12)).alias("context"), ((n < 40) | (n < 0.5 * F.length(tx.squeeze(F.col("v"))))).alias("low_signal"))
