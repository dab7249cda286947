"""Round trips of scans and sinks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatloom.sources import io

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])


def test_jsonl(spark, tmp_path):
    rows = spark.createDataFrame([(1, "é\n\"x\""), (2, None)], SCHEMA)
    io.write_jsonl(rows, str(tmp_path / "j"))
    assert sorted(map(tuple, io.read_jsonl(spark, str(tmp_path / "j"), SCHEMA).collect())) == sorted(map(tuple, rows.collect()))
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"id": 1, "text": "a"}\n\nnot json\n[1]\n{"id": 2}\n')
    good, rejects = io.read_jsonl_counting(spark, str(bad), SCHEMA)
    assert sorted((r.id, r.text) for r in good.collect()) == [(1, "a"), (2, None)]
    assert sorted(r.line for r in rejects.collect()) == ["[1]", "not json"]
    with pytest.raises(Exception):  # noqa: B017
        io.read_jsonl(spark, str(bad), SCHEMA).collect()


def test_eval_csv(spark, tmp_path):
    rows = spark.createDataFrame([("1", "q, \"x\"", ["a", "b"])], "id string, query string, tags_json array<string>")
    io.write_flat_csv(rows, str(tmp_path / "c"))
    got = io.read_eval_csv(spark, str(tmp_path / "c")).first()
    assert (got.user_query, got.tags) == ('q, "x"', ["a", "b"])


def test_corpus_and_split(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_text("one\n two")
    (tmp_path / "t" / "b.md").write_text("  \n")
    assert [(r.source_file, r.source_type, r.text) for r in io.read_corpus(spark, str(tmp_path / "t")).collect()] == [("a.txt", "txt", "one two")]
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], SCHEMA)
    assert {r.text: r.rows for r in io.write_split(rows, str(tmp_path / "s"), "text").collect()} == {"x": 2, "y": 1}
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3
    counts, examples = io.run_report(rows.withColumn("why", F.when(F.col("id") > 1, "late")), "why", "id", 1)
    assert counts.first().n == 2 and examples.first().id == 2
    assert io.strip_columns(rows, ["text"])[1].first().text == 3
