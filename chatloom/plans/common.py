"""Helpers of the registered queries and of their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Rule packs fit for the given tables; every operator takes its own.
PII = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<MAIL>"),
    (r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", "<IP>"),
    (r"[0-9]{13,19}", "<BANK_CARD>"),
    (r"[0-9]{6,12}", "<ACCOUNT>"),
]
SECRETS = [
    (r"https?://[^ \n]+", "<URL>"),
    (r"(?i)(password|token|api_key|secret)( ?[:=] ?)[^ \n]+", "$1$2<SECRET>"),
    (r"@[A-Za-z0-9_]{3,}", "<HANDLE>"),
    (r"[A-Za-z0-9_]{24,}", "<TOKEN>"),
]
NOISE = ["traceback", "exception", "api error", r"^ *at .*\(.+\) *$", "</?html", "</?body"]
RISK = {
    "insult": ["idiot", "moron", "stupid", "loser"],
    "legal": ["licen[sc]e", "copyright", "all rights reserved"],
    "personal": ["@", "password", "[0-9]{13,19}"],
    "shouting": ["!!"],
}
TERMS = ["license", "password", "idiot", "reserved"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WS = "[ \\t\\n\\x0B\\f\\r\\x{A0}\\x{3000}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def sql_squeeze(x: str) -> str:
    return f"regexp_replace({x}, '{_WS}+', '', 'g')"


def sql_lines(x: str) -> str:
    return f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: {sql_strip('l')}), lambda l: l <> '')"


def sql_sentences(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex({x}, '[.!?;\\n…。！？；]+'), lambda l: {sql_strip('l')}), lambda l: l <> '')"


def sql_form(x: str) -> str:
    return f"regexp_replace({sql_squeeze(x)}, '[\\p{{P}}\\p{{S}}]+$', '')"


def sql_rules(x: str, rules) -> str:
    for pattern, to in rules:
        to = to.replace("$1", "\\1").replace("$2", "\\2")
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return x


def sql_normalize(x: str) -> str:
    for pattern, to in (("\\r", " "), ("<[^>]+>", " "), ("(?i)https?://[^ \\t\\n\\x0B\\f\\r]+", " <URL> "), ("&nbsp;", " "), (f"{_WS}+", " ")):
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return sql_strip(x)


def chain_sql(rows: str, span: float) -> str:
    """CTE c (key, x): of rows (key, id, tm) those let through one at a time, x being (tm, id)."""
    return f"c(key, x) as (select key, min({{'tm': tm, 'id': id}}) from {rows} group by key union all select c.key, min({{'tm': o.tm, 'id': o.id}}) from c join {rows} o on o.key is not distinct from c.key and o.tm >= c.x.tm + {span} group by c.key)"
