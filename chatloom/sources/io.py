"""Scans and sinks of dialogue and evaluation files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.functions.text import normalize
from chatloom.operators.storage import reachable, stored


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One object per line; a malformed line is an error, blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_counting(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects): malformed lines go to rejects as (line, reason)."""
    rows = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    parsed = rows.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"), F.expr("try_parse_json(value)").alias("v"))
    bad = F.col("v").isNull() | (F.schema_of_variant("v").startswith("OBJECT") == F.lit(False))
    return parsed.filter(~bad).select("r.*"), parsed.filter(bad).select(F.col("value").alias("line"), F.lit("invalid_json").alias("reason"))


def read_eval_csv(spark: SparkSession, path: str, arrays: Sequence[str] = ("must_include_json", "tags_json"), aliases: Sequence[str] = ("user_query", "query", "prompt")) -> DataFrame:
    """A CSV with a header whose *_json cells hold JSON: arrays are parsed, `user_query` is the first alias that is there."""
    rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    there = [F.col(a) for a in aliases if a in rows.columns]
    rows = rows.withColumn("user_query", F.coalesce(*there) if there else F.lit(None).cast("string"))
    for c in arrays:
        if c in rows.columns:
            rows = rows.withColumn(c.removesuffix("_json"), F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))).drop(c)
    return rows


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, source_type, unit_type, unit_id, text): a unit for each text file that is not empty when cleaned. A file is one value;
    for large ones there is `read_corpus_parts`."""
    rows = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("source_file"))
    kind = F.lower(F.regexp_extract("source_file", r"\.([A-Za-z0-9]+)$", 1))
    return rows.select("source_file", kind.alias("source_type"), F.lit("doc").alias("unit_type"), F.lit("1").alias("unit_id"), normalize(F.col("value")).alias("text")).filter("text <> ''")


#: Characters of a part of a file, about.
PART = 1 << 19


def _runs(size: int):
    """Lines (path, name, start, value) of blocks of files as parts of whole lines: (path, name, start, part, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, chars = None, 0, 0
        lines: list[str] = []

        def made() -> pa.RecordBatch:
            return pa.record_batch([pa.array([x]) for x in (*held, n, "\n".join(lines))], names=["path", "name", "start", "part", "text"])

        for batch in batches:
            for *key, line in zip(*(batch.column(c).to_pylist() for c in ("path", "name", "start", "value")), strict=True):
                if held is not None and (key != held or chars >= size):
                    yield made()
                    n, chars = n + 1 if key == held else 0, 0
                    lines.clear()
                held = key
                lines.append(line)
                chars += len(line) + 1
        if held is not None:
            yield made()

    return run


def read_corpus_parts(spark: SparkSession, path: str, part: int = PART) -> DataFrame:
    """(path, source_file, source_type, start, part, text): the cleaned texts of `read_corpus` in parts, in order of start and part,
    without empty ones; joined by a space they are a file's text. No file is held whole, and one may be read by many tasks.

    A part has whole lines of about `part` characters. A tag may go on over parts: whether one is open where a part begins, and whether it is
    ever closed, is known from one row of each part.
    """
    reachable(spark)
    rows = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("start"), "value")
    parts = stored(rows.mapInArrow(_runs(part), "path string, name string, start long, part long, text string"), "corpus-parts")
    key, at = ["path", "start", "part"], F.struct("start", "part")
    # after a > no tag is open; one is where a < came later
    opens = F.contains(F.substring_index("text", ">", -1), F.lit("<"))
    marks = parts.select(*key, F.when(F.contains("text", F.lit(">")), at).alias("closes"), F.when(opens, at).alias("opens"))
    line = Window.partitionBy("path").orderBy("start", "part")
    before, after = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(1, Window.unboundedFollowing)
    open_ = F.max("opens").over(before).isNotNull() & (F.max("closes").over(before).isNull() | (F.max("opens").over(before) >= F.max("closes").over(before)))
    known = marks.select(*key, open_.alias("open"), F.max("closes").over(after).isNotNull().alias("closed"))
    closing, t = F.contains("text", F.lit(">")), F.col("text")
    met = parts.join(known, key)
    # what is left of a tag that began before, and of one that ends later, is nothing, as normalize makes a space of a tag
    t = F.when(F.col("open") & closing, F.substr(t, F.locate(">", t) + 1)).when(F.col("open") & F.col("closed"), "").otherwise(t)
    met = met.withColumn("text", t)
    tail = F.substring_index("text", ">", -1)
    cut = F.when(F.col("closed"), F.concat(F.left("text", F.length("text") - F.length(tail)), F.substring_index(tail, "<", 1))).otherwise(F.col("text"))
    kind = F.lower(F.regexp_extract("name", r"\.([A-Za-z0-9]+)$", 1))
    return met.select("path", F.col("name").alias("source_file"), kind.alias("source_type"), "start", "part", normalize(cut).alias("text")).filter("text <> ''")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, digest = None, None
    for batch in batches:
        for *key, text in zip(*(batch.column(c).to_pylist() for c in ("path", "source_file", "source_type", "text")), strict=True):
            if key != held:
                if held is not None:
                    yield pa.record_batch([pa.array([x]) for x in (*held, digest.hexdigest())], names=["path", "source_file", "source_type", "digest"])
                held, digest = key, hashlib.md5(usedforsecurity=False)
            else:
                digest.update(b" ")
            digest.update(text.encode())
    if held is not None:
        yield pa.record_batch([pa.array([x]) for x in (*held, digest.hexdigest())], names=["path", "source_file", "source_type", "digest"])


def corpus_digests(parts: DataFrame) -> DataFrame:
    """(path, source_file, source_type, digest): MD5 of each file's cleaned text. A file's parts pass through one task in order, one at a
    time, as the digest has it."""
    reachable(parts.sparkSession)
    return parts.repartition("path").sortWithinPartitions("path", "start", "part").mapInArrow(_digests, "path string, source_file string, source_type string, digest string")


def page_titles(pages: DataFrame) -> DataFrame:
    """(page_id, url, title, text): scripts, styles and tags go, titles fall back to the address."""
    plain = F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    title = F.trim(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    return pages.select("page_id", "url", F.when(title != "", title).otherwise(F.col("url")).alias("title"), normalize(plain).alias("text"))


def page_units(pages: DataFrame, size: int = 600, overlap: int = 120) -> DataFrame:
    """(unit_id, source_url, title, text) of pages (page_id, url, html), in chunks of their texts."""
    from chatloom.operators.retrieval import chunks

    rows = page_titles(pages)
    return chunks(rows, "page_id", F.col("text"), size, overlap).join(rows.select(F.col("page_id").alias("id"), "url", "title"), "id").select(F.concat_ws("-", "id", "chunk_index").alias("unit_id"), F.col("url").alias("source_url"), "title", F.col("chunk").alias("text"))


def write_jsonl(rows: DataFrame, path: str) -> None:
    """One object per row."""
    rows.write.json(path)


def write_flat_csv(rows: DataFrame, path: str) -> None:
    """Nested columns as compact JSON text."""
    nested = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.ArrayType | T.StructType | T.MapType)]
    rows.withColumns({c: F.to_json(c) for c in nested}).write.option("header", True).option("escape", '"').csv(path)


def write_split(rows: DataFrame, path: str, key: str) -> DataFrame:
    """One folder for each key; returns (key, rows)."""
    rows.write.partitionBy(key).parquet(path)
    return rows.groupBy(key).agg(F.count("*").alias("rows"))


def strip_columns(rows: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """rows without the named columns, and how many rows had a value in each."""
    counts = rows.agg(F.count("*").alias("rows"), *(F.count_if(F.col(n).isNotNull()).alias(n) for n in names))
    return rows.drop(*names), counts


def run_report(rows: DataFrame, reason: str, order: str, most: int = 200) -> tuple[DataFrame, DataFrame]:
    """(counts by reason, most first; the first `most` rejected rows): the feature is a report of bounded length."""
    bad = rows.filter(F.col(reason).isNotNull())
    return bad.groupBy(reason).agg(F.count("*").alias("n")).orderBy(F.desc("n"), reason), bad.orderBy(order).limit(most)


Rule = tuple[str, Column]
