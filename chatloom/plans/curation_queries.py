"""Curation of the given dialogues and documents, with SQL twins. Rule packs are ones that these texts exercise."""

from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions import text as tx
from chatloom.operators import curation as cu
from chatloom.operators import sets

from .common import NOISE, PII, sql_form, sql_lines, sql_normalize, sql_rules, sql_sentences, sql_squeeze, sql_strip, table
from .dialogue_queries import hash_sql

QUERIES, SQL = {}, {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


GATES = cu.Gates(
    low=["ok", "hi"], leak=["eaea", "keitkeit"], ticket_hard="ñll ?[a-z]+ll", ticket_soft=["blebl", "zuzu", "quequ"], ticket_flow="eaueau", marketing=["^Der ", "^El ", "^Thth"],
    risk={"double": ["ouou", "ungung"], "sharp": ["ßß"]}, least=40, most=6000, shortest=40,
)


def _any(patterns) -> str:
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns)


# lines of a turn in an array, cleaned, masked and without adjacent repeats
_CLEAN = f"""rw as (select conv_id, turn, lower(trim(role)) as role, list_transform(string_split(replace(coalesce(text, ''), chr(13), chr(10)), chr(10)), lambda l: {sql_normalize('l')}) as ls from conversations where lower(trim(role)) in ('user', 'assistant')),
kp as (select *, list_filter(ls, lambda x: x <> '' and length(x) <= 2500 and not regexp_matches(x, '{_any(NOISE)}')) as k from rw),
mk as (select *, string_split({sql_rules("array_to_string(k, chr(10))", PII)}, chr(10)) as m from kp),
un as (select *, list_filter(m, lambda x, i: i = 1 or x <> m[i - 1]) as f from mk),
wh as (select *, array_to_string(f, chr(10)) as whole from un),
cm as (select conv_id, turn, role, {sql_strip('whole[1:1200]')} as text, len(ls) - len(k) as noise, len(m) - len(f) as repeats, case when length(whole) > 1200 then 1 else 0 end as truncated from wh where {sql_strip('whole')} <> ''),
gr as (select conv_id, turn, unnest(list_transform(range(1, length({sql_squeeze('text')}) - 10), lambda i: substring({sql_squeeze('text')}, i, 12))) as g, length({sql_squeeze('text')}) as size from cm where role = 'assistant' and length({sql_squeeze('text')}) >= 80),
gc as (select conv_id, turn, g, any_value(size) as size, count(*) as n from gr group by all), hv as (select conv_id, turn, max(n) >= 6 and max(n) * 12 >= 0.35 * any_value(size) as heavy from gc group by conv_id, turn),
ok as (select cm.* from cm left join hv using (conv_id, turn) where not coalesce(heavy, false)),
nw as (select *, case when role = lag(role) over (partition by conv_id order by turn) then 0 else 1 end as new from ok), ru as (select *, sum(new) over (partition by conv_id order by turn) as run from nw),
ct as (select conv_id, min(turn) as turn, arg_min(role, turn) as role, string_agg(text, chr(10) order by turn) as text, cast(count(*) - 1 as int) as merged from ru group by conv_id, run)"""


@query(f"with {_CLEAN} select conv_id, turn, role, text, merged from ct")
def DLG3_clean_messages(spark, d):
    return cu.cleaned_turns(table(spark, d, "conversations"), NOISE, PII)


@query(f"with {_CLEAN} select conv_id, cast(sum(noise) as bigint) as noise, cast(sum(repeats) as bigint) as repeats, cast(sum(truncated) as bigint) as truncated, count(*) filter (where coalesce(heavy, false)) as repetitive from cm left join hv using (conv_id, turn) group by conv_id")
def DLG3_cleaning_statistics(spark, d):
    rows = cu.clean_messages(table(spark, d, "conversations"), NOISE, PII)
    return rows.groupBy("conv_id").agg(*(F.sum(c).cast("long").alias(c) for c in ("noise", "repeats", "truncated")), F.count_if("repetitive").alias("repetitive"))


def _said(pattern: str) -> str:
    return f"coalesce(bool_or(role = 'assistant' and regexp_matches(text, '{pattern}')), false)"


_SOFT = " + ".join(f"{_said('(?i)' + p)}::int" for p in GATES.ticket_soft)
_RISKS = ", ".join(f"case when bool_or(regexp_matches(text, '{_any(p)}')) then '{k}' end" for k, p in GATES.risk.items())
_REASONS = f"""{_CLEAN}, fl as (select conv_id, count(*) filter (where role = 'user') as users, count(*) filter (where role = 'assistant') as replies, sum(length(text)) as size, count(*) filter (where role = 'user' and lower(trim(text)) not in ('ok', 'hi')) as worthy,
max(case when role = 'assistant' then length(text) end) as longest, {_said(_any(GATES.leak))} as leak, {_said(GATES.ticket_hard)} as hard, {_said(GATES.ticket_flow)} as flow, {_SOFT} as soft, bool_or(regexp_matches(text, '{_any(GATES.marketing)}')) as marketing,
list_sort(list_filter([{_RISKS}], lambda x: x is not null)) as risks from ct group by conv_id),
se as (select conv_id, unnest({sql_sentences('text')}) as s from ct where role = 'assistant'), rs as (select distinct conv_id from (select conv_id, s from se where length(s) >= 8 group by all having count(*) >= 3)),
ha as ({hash_sql(True, 20, 'ct')}),
rr as (select fl.conv_id, risks, hash, case when users = 0 then 'no_user' when replies = 0 then 'no_reply' when size < 40 then 'too_short' when size > 6000 then 'too_long' when worthy = 0 then 'low_value' when longest < 40 then 'reply_too_short' when leak then 'structured_leak'
when hard or soft >= 2 or (soft >= 1 and flow) then 'ticket_template' when rs.conv_id is not null then 'sentence_repetition' when marketing then 'marketing' when len(risks) > 0 then 'risk' end as why from fl join ha using (conv_id) left join rs on rs.conv_id = fl.conv_id),
re as (select conv_id, risks, case when why is null and conv_id > min(case when why is null then conv_id end) over (partition by hash) then 'duplicate' else why end as reason from rr)"""


def _reasons(spark, d):
    return cu.reject_reason(cu.cleaned_turns(table(spark, d, "conversations"), NOISE, PII), GATES)


@query(f"with {_REASONS} select coalesce(reason, 'kept') as reason, count(*) as n from re group by 1")
def CUR1_curation_report(spark, d):
    return _reasons(spark, d).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"with {_REASONS} select conv_id, reason, case when reason = 'risk' then risks end as risks from re where reason is not null order by conv_id limit 200")
def CUR1_rejected_examples(spark, d):
    """The first 200 rejected dialogues, as the report has them."""
    bad = _reasons(spark, d).filter("reason is not null").orderBy("conv_id").limit(200)
    return bad.select("conv_id", "reason", F.when(F.col("reason") == "risk", F.col("risks")).alias("risks"))


@query(f"with {_REASONS} select ct.conv_id, ct.turn, ct.role, ct.text from ct join re using (conv_id) where reason is null")
def CUR1_kept_turns(spark, d):
    turns = cu.cleaned_turns(table(spark, d, "conversations"), NOISE, PII)
    kept = cu.reject_reason(turns, GATES).filter("reason is null").select("conv_id")
    return turns.join(kept, "conv_id", "left_semi").select("conv_id", "turn", "role", "text")


SEVERE, DROP, FILLER = {"chant": "haha", "loop": "zuzu"}, ["^(the|die|la|el) ", "^.{0,9}$"], [".{0,40}"]
_LINES = f"list_filter({sql_lines('text')}, lambda x: not regexp_matches(x, '{_any(DROP)}'))"
_DECON = f"""l as (select conv_id, turn, role, text, {sql_lines("coalesce(text, '')")} as a from conversations), k as (select *, list_filter(a, lambda x: not regexp_matches(x, '{_any(DROP)}')) as b from l),
n as (select *, list_transform(b, lambda x: {sql_form('x')}) as fs from k), u as (select *, list_filter(b, lambda x, i: fs[i] <> '' and list_position(fs, fs[i]) = i) as f, len(list_filter(fs, lambda x: x <> '')) as formed from n),
c as (select *, len(f) >= 2 and len(list_filter(f, lambda x: not regexp_matches(x, '{_any([f"^(?:{p})$" for p in FILLER])}'))) = 0 as sole from u),
g as (select *, case when role = 'assistant' then array_to_string(case when sole then f[1:1] else f end, chr(10)) else text end as clean, role = 'assistant' as reply from c),
m as (select conv_id, {", ".join(f"bool_or(reply and regexp_matches(text, '(?i){p}')) as s{i}" for i, p in enumerate(SEVERE.values()))}, sum(case when reply then len(a) - len(b) else 0 end) as dropped, sum(case when reply then formed - len(f) else 0 end) as repeats, bool_or(reply and sole) as collapsed,
sum(case when reply then length(clean) else 0 end) as chars, count(*) filter (where reply and length(clean) > 0) as left_, count(*) filter (where role = 'user') as users from g group by conv_id),
w as (select conv_id, list_filter([{", ".join(f"case when s{i} then 'severe:{k}' end" for i, k in enumerate(SEVERE))}], lambda x: x is not null) as bad, list_filter([case when dropped > 0 then 'drop_line' end, case when repeats > 0 then 'dedupe_lines:' || cast(repeats as bigint) end, case when collapsed then 'collapse_filler_only' end,
case when chars = 0 then 'empty_after_clean' when chars + greatest(left_ - 1, 0) < 12 and users > 0 then 'too_short_after_clean' end], lambda x: x is not null) as soft from m),
dn as (select conv_id, case when len(bad) > 0 or list_contains(soft, 'empty_after_clean') or list_contains(soft, 'too_short_after_clean') then 'drop' when len(soft) > 0 then 'modify' else 'keep' end as action, list_sort(case when len(bad) > 0 then bad else soft end) as reasons from w)"""


def _decontaminated(spark, d):
    return cu.decontaminate(table(spark, d, "conversations"), SEVERE, DROP, FILLER)


@query(f"with {_DECON} select conv_id, action, reasons from dn")
def FLT12_keep_modify_drop(spark, d):
    return _decontaminated(spark, d)[0]


@query(f"with {_DECON} select g.conv_id, turn, role, clean as text from g join dn using (conv_id) where action <> 'drop' and (not reply or length(clean) > 0)")
def FLT12_cleaned_turns(spark, d):
    return _decontaminated(spark, d)[1]


@query(f"""with {_DECON}, r as (select unnest(reasons) as reason from dn), t as (select count(*) as total from dn), rc as (select reason, count(*) as n from r group by reason order by n desc, reason limit 20)
select 'action' as kind, action as name, count(*) as n, round(count(*) / any_value(total)::double, 6) as ratio from dn, t group by action union all select 'reason', reason, n, round(n / total::double, 6) from rc, t""")
def CUR2_decontaminate(spark, d):
    """Dialogues by action, and the 20 commonest reasons, with their shares."""
    done = _decontaminated(spark, d)[0].select("action", "reasons")
    counts = done.select(F.explode(F.concat(F.array(F.struct(F.lit("action").alias("kind"), F.col("action").alias("name"))), F.transform("reasons", lambda r: F.struct(F.lit("reason").alias("kind"), r.alias("name"))))).alias("x")).groupBy("x.kind", "x.name").agg(F.count("*").alias("n"))
    top = counts.filter("kind = 'action'").unionByName(counts.filter("kind = 'reason'").orderBy(F.desc("n"), "name").limit(20))
    total = done.agg(F.count("*").alias("total"), F.lit(1).alias("one"))
    return top.withColumn("one", F.lit(1)).join(F.broadcast(total), "one").select("kind", "name", "n", F.round(F.col("n") / F.col("total"), 6).alias("ratio"))


_STAGES = ["merged", "strict"]
_COVERED = ["license", "password", "idiot"]


@query(f"""with m as (select doc_id, source, text, row_number() over (partition by md5(text) order by source, doc_id) as n from documents), k as (select * from m where n = 1),
c as (select doc_id, array_to_string(list_filter({sql_lines("text")}, lambda x: length(x) <= 2500 and not regexp_matches(x, '{_any(NOISE)}')), chr(10)) as t from k), s as (select * from c where t <> '' and not regexp_matches(t, '(?i)idiot|%%%|!!'))
""" + " union all ".join(f"select '{stage}' as stage, count(*) as rows, " + ", ".join(f"count(*) filter (where contains(lower({t}), '{w}')) as {w}" for w in _COVERED) + f" from {source}" for stage, t, source in (("merged", "text", "k"), ("cleaned", "t", "c"), ("strict", "t", "s"))))
def CUR3_merge_clean_coverage(spark, d):
    """Documents merged by text, cleaned of noise lines and filtered strictly; rows and terms' coverage after each stage."""
    merged = sets.keep_first(table(spark, d, "documents").select("doc_id", "source", "text"), [F.md5("text")], ["source", "doc_id"])
    rows = merged.select(F.lower("text").alias("a"), F.array_join(tx.clean_lines(F.col("text"), NOISE), "\n").alias("t"))
    strict = (F.col("t") != "") & ~F.col("t").rlike("(?i)idiot|%%%|!!")
    stages = F.array(F.struct(F.lit("merged").alias("stage"), F.col("a").alias("t")), F.struct(F.lit("cleaned").alias("stage"), F.lower("t").alias("t")), F.when(strict, F.struct(F.lit("strict").alias("stage"), F.lower("t").alias("t"))))
    rows = rows.select(F.explode(F.filter(stages, lambda x: x.isNotNull())).alias("x")).select("x.*")
    return rows.groupBy("stage").agg(F.count("*").alias("rows"), *(F.count_if(F.contains("t", F.lit(w))).alias(w) for w in _COVERED))
