"""The queries over the smallest tables beside plain Python, and the pipeline from end to end."""

import itertools
import os
import re
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from chatloom.llm import licenses, quality, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_op1_costs_by_a_plain_automaton(spark):
    """Least costs by a search over what is written so far: [system] then user, assistant in turn."""
    costs = {"merge": 1, "relabel": 6, "relabel_unknown": 2, "insert": 4}
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    def best(roles):
        ways = {"": 0}
        for role in roles:
            new = {}
            for at, c in ways.items():
                for _ in range(3):  # empty turns before it
                    for to in "sua":
                        change = 0 if to == role else costs["relabel" if role else "relabel_unknown"]
                        if to in after[at]:
                            new[to] = min(new.get(to, 999), c + change)
                        if to == at:
                            new[to] = min(new.get(to, 999), c + change + costs["merge"])
                    at, c = ("a" if at == "u" else "u"), c + costs["insert"]
            ways = new
        return min(c + {"a": 0, "u": 1, "s": 2, "": 2}[at] * costs["insert"] for at, c in ways.items())

    rows = queries.op1_chat_format(spark, SF).collect()
    turns = spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect()
    want = {c: best([{"system": "s", "user": "u", "assistant": "a"}.get((r.role or "").strip().lower()) for r in rs]) for c, rs in itertools.groupby(turns, lambda r: r.conv_id)}
    assert {r.conv_id: r.cost for r in rows} == want and len(rows) == len(turns)


def test_op2_by_plain_fingerprints(spark, texts):
    def fingerprint(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOW))
        found = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in found]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: fingerprint(t) for i, t in texts.items()}
    group = {i: i for i in prints}
    for _ in range(20):
        for a, b in itertools.combinations(prints, 2):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                group[a] = group[b] = min(group[a], group[b])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash(spark, SF).collect()}
    assert got == {i: (f"{prints[i]:016x}", group[i]) for i in prints}


def test_op3_base_columns(spark, texts):
    for r in queries.op3_licenses(spark, SF).collect():
        words, at, labels = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r.doc_id].translate(LOW)), [], set()
        for phrase, label in licenses.BASE.items():
            found = [k for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
            at, labels = at + found, labels | ({label} if found else set())
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))


def test_op4_op5_op7_by_the_library(spark, texts):
    word, byte = library("word_bpe_49k.json"), library("byte_bpe_50k.json")
    start, coded = 0, {i: np.array([*word.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in sorted(texts.items())}
    files = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op4_token_files(spark, SF).collect()}
    for i, ids in coded.items():
        assert files[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    coded = {i: np.array(byte.encode(t, add_special_tokens=False).ids, "<u4") for i, t in texts.items()}
    for r in queries.op7_bpe(spark, SF).collect():
        decoded = byte.decode(coded[r.doc_id].tolist(), skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(coded[r.doc_id]), sha256(coded[r.doc_id].tobytes()).hexdigest(), sha256(decoded.encode()).hexdigest())
    whole, filled, pieces = {i: np.append(x, 0).astype("<u4") for i, x in coded.items()}, {}, queries.op5_packing(spark, SF).collect()
    seen = dict.fromkeys(whole, 0)
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        assert r.start == seen[r.doc_id] and zlib.crc32(whole[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        seen[r.doc_id] += r.length
    assert seen == {i: len(x) for i, x in whole.items()}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert all(filled[s] == 1024 for s in range(len(filled) - 1))


def test_op6_scores_are_those_of_the_rules(spark, texts):
    model = quality.fit_quality(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), queries.crc_fold("doc_id", 3) != 1)
    for r in queries.op6_quality(spark, SF).collect():
        x = quality.statistics(texts[r.doc_id])
        total = model.bias + sum(w for rule, w in zip(model.rules, model.weights, strict=True) if all((x[f] > t) == above for f, above, t in rule))
        assert abs(r.score - 1 / (1 + np.exp(-total))) < 1e-9 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_pipeline_from_end_to_end(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10**6)
    noid = docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit("a text of its own without an id at all"))
    odd = docs.union(docs.limit(5)).union(extra).union(noid).withColumns({"score": F.lit("kept"), "_score": F.lit(1), "tx": F.lit(2), "id": F.lit("z")})
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    left = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, stage(spark, left, str(tmp_path)).cache()
        assert left.columns == odd.columns and 0 < left.count() <= before.count()
    ids = [r.doc_id for r in left.select("doc_id").collect()]
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None}) and {r.score for r in left.select("score").collect()} == {"kept"}
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(ids)
    empty = str(tmp_path / "empty")
    odd.filter("doc_id = -1").write.parquet(f"{empty}/documents.parquet")
    labels.write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
