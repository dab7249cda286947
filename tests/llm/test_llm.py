"""Operators of the llm subpackage beside brute force, round trips and edge cases."""

import itertools
import math
import os
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from chatloom.llm import bpe, chat, embeddings, licenses, nearcopies, packing, quality, simhash, tokenfiles, topk, toxicity
from chatloom.llm.components import components

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, t string, score double, id long, fp string, p int, v string"
ODD = ["", None, " ", "a", "Hello <|endoftext|> world", "x  y\n\n z\t", "é́ İstanbul ΣΑΣ don't I'LL 's", "日本語 テキスト", "same text here now", "same text here now", "\x1ca\x1c b", "<|startoftext|>Q"]


def docs_of(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "x", 1.0, 7, "f", 3, "v") for i, t in zip(ids, texts, strict=True)], DOCS)


def library(path, text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def noise(seed, n, letters="aB'stré \n\t12!&<|>́ \x1c日İΣſK"):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(n)]


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, j) for j in range(5001, 5100)]
    df = spark.createDataFrame([*edges, (None, 3), (4, 4)], "a long, b long")
    got = {r.node: r.component for r in components(df, "a", "b").collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in parent}
    assert components(df.filter("a < -1"), "a", "b").count() == 0


def test_bpe_equals_library(spark):
    texts = ODD + noise(2, 60)
    got = {r.doc_id: r for r in bpe.bpe_round_trip(docs_of(spark, texts), BYTE, keep_ids=True).collect()}
    for i, t in enumerate(texts):
        ids, back = library(BYTE, t)
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].decoded == back and got[i].n_tokens == len(ids)
    assert bpe.bpe_round_trip(docs_of(spark, texts).filter("doc_id < 0"), BYTE).count() == 0


def test_bpe_cache_can_be_tiny():
    pairs = bpe.BytePairs(BYTE)
    pairs.words.limit = pairs.pieces.limit = 2
    assert np.frombuffer(pairs.encode("one two three, one two."), "<u4").tolist() == library(BYTE, "one two three, one two.")[0]


@pytest.mark.parametrize("bits", [1, 3, 40, 5000])
def test_elias_fano(bits):
    draw = np.random.default_rng(bits)
    values = np.sort(draw.integers(0, 1 << min(bits, 40), 700))
    ef = tokenfiles.EliasFano.of(values)
    assert (ef.all() == values).all() and [ef[i] for i in range(700)] == values.tolist()
    some = draw.permutation(700)[:90]
    assert (ef.get(np.arange(700)) == values).all() and (ef.get(some) == values[some]).all()
    empty = tokenfiles.EliasFano.of(np.zeros(0))
    assert empty.all().tolist() == [] == empty.get(np.arange(0)).tolist()
    assert len(ef.low) * 8 + len(ef.high) * 8 <= 700 * (2 + max(1, np.log2(max(2, values[-1] / 700)))) + 64


def test_token_files(spark, tmp_path):
    texts = ODD + noise(3, 40)
    ids = [5 * i % 53 for i in range(len(texts))]
    tokenfiles.write_token_files(docs_of(spark, texts, ids).repartition(3), str(tmp_path / "t"), WORD, end_id=1)
    got = tokenfiles.read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    start = 0
    for r, (i, t) in zip(got, sorted(zip(ids, texts, strict=True), key=lambda x: x[0]), strict=True):
        want = np.array([*library(WORD, t)[0], 1], "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) == (i, start, len(want) // 4, zlib.crc32(want), want)
        start += r.n_tokens
    tokenfiles.write_token_files(docs_of(spark, [], []), str(tmp_path / "e"), WORD)
    assert tokenfiles.read_token_files(spark, str(tmp_path / "e")).count() == 0


def test_packing(spark):
    texts = [*ODD, "long word " * 700]
    rows = packing.pack(docs_of(spark, texts).repartition(3), BYTE, size=64, end_id=0, keep_ids=True).collect()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        pieces = sorted(of[i], key=lambda r: r.start)
        assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == [*library(BYTE, t)[0], 0]
        assert all(zlib.crc32(r.ids) == r.ids_crc32 and r.doc_tokens == sum(x.length for x in pieces) for r in pieces)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert sorted(filled) == list(range(len(filled))) and all(n == 64 for s, n in filled.items() if s != len(filled) - 1)
    assert packing.pack(docs_of(spark, [], []), BYTE).count() == 0


def test_chat_repair_is_cheapest():
    costs = chat.COSTS
    for n in range(1, 5):
        for roles in itertools.product(("system", "user", "assistant", None), repeat=n):
            best = {chat.START: 0}
            for role in roles:
                now = {}
                for a, b, c, *_ in chat.steps(role, costs):
                    if a in best:
                        now[b] = min(now.get(b, chat.NONE), best[a] + c)
                best = now
            total, leave = min((c + chat.end_cost(costs)[s], s) for s, c in best.items())
            way = chat.repair_part(list(roles), chat.START, leave, costs)
            cost, last, out = chat.end_cost(costs)[leave], None, []
            for role, (to, kind, inserted) in zip(roles, way, strict=True):
                cost += 0 if to == role else costs["relabel" if role else "relabel_unknown"]
                cost += costs["merge"] * kind.startswith("merge") + costs["insert"] * bool(inserted)
                assert not kind.startswith("merge") or to == last
                out += [inserted] * bool(inserted) + [to] * (not kind.startswith("merge"))
                last = to
            assert cost == total
            assert "system" not in out[1:] and all(a != b for a, b in itertools.pairwise(out)) and (out[0] != "system" or out[1:2] != ["assistant"])


def test_chat_format(spark):
    rows = [(1, 0, "User", "hi"), (1, 1, "user", "again <|x"), (1, 2, "bot", "yes"), (2, 0, "assistant", None), (None, 0, "user", "q"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    turns = spark.createDataFrame([(*r, 1, "s") for r in rows], "conv_id long, turn long, role string, text string, c int, seg string")
    got = chat.format_chats(turns).orderBy("conv_id", "part").collect()
    whole = {c: "".join(r.rendered for r in rs) for c, rs in itertools.groupby(got, lambda r: r.conv_id)}
    assert whole[1] == "<|user|>\nhi\nagain <​|x<|end|>\n<|assistant|>\nyes<|end|>\n"
    assert whole[2] in ("<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n",) and whole[None].startswith("<|user|>\nq")
    assert [r.kind for r in got if r.conv_id == 3] == ["keep", "merge"]
    again = {c: "".join(r.rendered for r in rs) for c, rs in itertools.groupby(chat.format_chats(turns, segment=1).orderBy("conv_id", "part").collect(), lambda r: r.conv_id)}
    assert again == whole and chat.format_chats(turns.filter("turn > 9")).count() == 0


def simhash_brute(docs, k, bits):
    prints = {i: simhash.fingerprint(t or "", k) for i, t in docs}
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits and root(a) != root(b):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (f"{prints[i]:016x}", root(i)) for i in prints}


def test_simhash_groups(spark):
    draw, words = random.Random(4), [f"w{i}" for i in range(400)]
    texts = list(ODD)
    for _ in range(12):
        base = [draw.choice(words) for _ in range(draw.randint(30, 400))]
        texts.append(" ".join(base))
        for _ in range(6):
            copy = list(base)
            copy[draw.randrange(len(copy))] = "edited"
            texts.append(" ".join(copy).upper())
    docs = docs_of(spark, texts)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_groups(docs, 3, 2).collect()}
    assert got == simhash_brute(list(enumerate(texts)), 3, 2)
    assert simhash.simhash_groups(docs.filter("doc_id < 0")).count() == 0


@pytest.mark.parametrize("large", [1, 4, 32])
def test_large_postings_lose_no_link(spark, large):
    draw = random.Random(large)
    base = draw.getrandbits(64)
    prints = {base ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))) for _ in range(150)} | {draw.getrandbits(64) for _ in range(50)}
    prints = sorted(prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)], "fp long, rep long")
    got = {r.node: r.component for r in components(simhash.fingerprint_links(df, 2, large), "u", "v").collect()}
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert all(got.get(i, i) == root(i) for i in range(len(prints)))


def test_near_copies(spark):
    draw, words = random.Random(5), [f"w{i}" for i in range(3000)]
    texts, origin = [], []
    for k in range(25):
        base = [draw.choice(words) for _ in range(draw.randint(80, 300))]
        for c in range(4):
            copy = list(base)
            if c:
                copy[draw.randrange(len(copy))] = "edited"
            texts.append(" ".join(copy))
            origin.append(k)
    docs = docs_of(spark, [*texts, None, ""]).withColumn("doc_id", F.col("doc_id") + 10)
    got = {r.doc_id - 10: r.component_id - 10 for r in nearcopies.near_copies(docs).collect()}
    assert got == {i: 4 * origin[i] for i in range(100)} | {100: 100, 101: 100}
    kept = nearcopies.keep_one(docs.union(docs).unionByName(docs_of(spark, ["no id"], [None])))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, *(4 * k + 10 for k in range(25)), 110] and kept.columns == docs.columns
    assert nearcopies.near_copies(docs.filter("doc_id < 0")).count() == 0


def shingle_set(text, k=5):
    words = simhash.words_of(text or "")
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def near_copies_brute(texts, similarity=0.8):
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if root(a) != root(b) and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("parts,large", [(3, 4096), (20, 8)])
def test_near_copies_equal_brute_force(spark, parts, large, monkeypatch):
    """Similarities from 0.6 to 1, texts of a few words too, and a passage that most texts share."""
    monkeypatch.setattr(nearcopies, "LARGE", large)
    monkeypatch.setattr(nearcopies, "CHUNK", 5)
    draw, words = random.Random(11), [f"w{i}" for i in range(500)]
    passage, texts = " ".join(draw.choices(words, k=120)), ["", None, " "]
    for n in (4, 5, 6, 8, 9, 12, 30, 100, 400):
        base = draw.choices(words, k=n)
        for edits in (0, 0, 1, 1, 1, 2, 3, 5, 8):
            copy = list(base)
            for _ in range(min(edits, n // 3)):
                copy[draw.randrange(n)] = f"e{draw.randrange(10**6)}"
            texts += [" ".join(copy), " ".join([*copy, f"e{draw.randrange(10**6)}"])]
    for own in (4, 8, 12, 14, 18, 25, 40):
        texts += [passage + " " + " ".join(f"e{draw.randrange(10**6)}" for _ in range(own)) for _ in range(12)]
    docs = docs_of(spark, texts).repartition(parts)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.doc_id: r.component_id for r in nearcopies.near_copies(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = near_copies_brute(texts)
    assert [got[i] for i in range(len(texts))] == want and len(set(want)) < 0.8 * len(texts)


def test_near_copies_need_the_exact_index(spark, monkeypatch):
    """Without links from fingerprints the groups stay; without the exact index some are missed."""
    draw, words = random.Random(12), [f"w{i}" for i in range(900)]
    texts = []
    for _ in range(60):
        base = draw.choices(words, k=9)
        texts += [" ".join(base[:8]), " ".join(base)]
    want = near_copies_brute(texts)
    monkeypatch.setattr(nearcopies, "LEAST_BYTES", 129)
    got = {r.doc_id: r.component_id for r in nearcopies.near_copies(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want == [i - i % 2 for i in range(120)]


def test_one_id_of_several_texts(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = docs_of(spark, ["other words stand here for once", long, long, long + " more", "other words stand here for once", None], [1, 1, 1, 2, 7, 3])
    kept = sorted((r.doc_id, r.text) for r in nearcopies.keep_one(rows).fillna("").collect())
    assert kept == [(1, "other words stand here for once"), (1, long), (3, "")]


WORD_RUN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_licenses(spark):
    texts = [*ODD, "Licensed under the Apache License, Version 2.0.", "MIT-license; mit\nlicense", "CC BY-NC 4.0 and CC by", "commit license", "GNU General Public License, version 3. The GNU  general public licenses", "SPDX-License-Identifier: BSD-3-Clause"]
    got = {r.doc_id: r for r in licenses.scan_licenses(docs_of(spark, texts)).collect()}
    low = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    for i, t in enumerate(texts):
        words, at, labels = WORD_RUN.findall((t or "").translate(low)), [], set()
        for phrase, label in licenses.BASE.items():
            parts = phrase.split()
            found = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
            at += found
            labels |= {label} if found else set()
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[len(texts) - 1].labels == "bsd-3-clause" and [d.version for d in got[len(ODD)].detections] == ["2.0"]
    assert len(licenses.make_rules()) > 200


@pytest.mark.parametrize(
    "text,labels,version",
    [
        ('Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files (the "Software")', "mit", None),
        ("Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions are met:", "bsd", None),
        ("http://www.apache.org/licenses/LICENSE-2.0", "apache", "2.0"),
        ("redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 3 of the License", "gpl", "3"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice", "isc", None),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl", "2.0"),
        ("https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa", "4.0"),
        ("This is free and unencumbered software released into the public domain.", "unlicense", None),
    ],
)
def test_licence_bodies(text, labels, version):
    found = licenses.detect(text.encode().lower())
    assert {d.label for d in found} == {labels} and found[0].version == version


def test_licence_overlaps_are_resolved_fast():
    draw = random.Random(9)
    for n in (400, 100_000):
        found = [licenses.Detection(a := draw.randrange(n * 3), a + draw.randint(1, 40), draw.choice("ab"), draw.randint(0, 4), 1.0, None) for _ in range(n)]
        start = time.time()
        got = licenses.without_contained(found)
        assert time.time() - start < 5
        if n == 400:
            kept = []
            for d in sorted(found, key=lambda d: (d.priority, d.start - d.end, d.start, d.label)):
                if not any(k.start <= d.start and d.end <= k.end for k in kept):
                    kept.append(d)
            assert sorted(kept, key=lambda d: (d.start, d.end, d.priority, d.label)) == got


def test_cosine_groups_are_exact_with_the_widest_margin(spark):
    draw = np.random.default_rng(6)
    base = draw.normal(size=(40, 16))
    x = np.concatenate([base, base[:20] + 0.08 * draw.normal(size=(20, 16)), base[:5] + 0.1 * draw.normal(size=(5, 16)), base[:3], 2 * base[:2], np.repeat(base[39:], 30, 0) + 0.01 * draw.normal(size=(30, 16))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, []), (905, [1.0, 2.0]), (None, x[0].tolist())]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, n int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.cosine_groups(df, cells=6, margin=1.0, block=16).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    comp = np.arange(len(u))
    while True:
        new = np.minimum(comp, np.where(linked, comp[None, :], len(u)).min(1))
        if (new == comp).all():
            break
        comp = new
    assert {i: (int(linked[i].sum()), int(comp[i]), bool(comp[i] == i)) for i in range(len(u))} == {i: got[i] for i in range(len(u))}
    assert all(got[i] == (0, i, True) for i in range(900, 906)) and got[None] == (0, None, True)
    assert embeddings.cosine_groups(df.filter("vec_id < 0")).count() == 0


def test_top_k_with_ties(spark):
    draw = np.random.default_rng(7)
    x = draw.integers(-2, 3, (300, 8)) / 2
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(990, None), (991, [float("inf")] * 8), (992, [None] * 8), (993, [1.0, 2.0]), (None, x[0].tolist())]
    df = spark.createDataFrame([(*r, 0, 1) for r in rows], "vec_id long, embedding array<double>, q int, v int").repartition(3)
    s = np.floor(64 * x).astype(np.int64)
    s = s @ s.T
    for bins, size in ((2, 7), (256, 64)):
        got = {}
        for r in topk.top_k(df.filter("vec_id % 20 = 0"), df, k=9, query_rows=5, rows=size, bins=bins).collect():
            got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
        for q in range(0, 300, 20):
            want = sorted(((-s[q, c], c) for c in range(300) if c != q))[:9]
            assert got[q] == {k + 1: (c, -v) for k, (v, c) in enumerate(want)}
    few = topk.top_k(df.filter("vec_id = 0"), df.filter("vec_id in (0, 1, 2)"), k=9).collect()
    assert sorted(r.vec_id for r in few) == [1, 2] and topk.top_k(df.filter("vec_id < 0"), df.filter("vec_id < 0")).count() == 0


def test_vectors_of_any_size(spark):
    big = [[1e300, 2e300], [2e-60, 4e-60], [1.0, 2.0], [-3.0, 1.0], [5e-324, 1e-323], [1e12, 1.0]]
    df = spark.createDataFrame(list(enumerate(big)), "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.cosine_groups(df).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (0, 3), 4: (3, 0), 5: (0, 5)}
    scores = {(r.query_id, r.vec_id): r.score for r in topk.top_k(df, df, k=9).collect()}
    whole = lambda x: max(-(1 << 62), min(1 << 62, math.floor(64 * x))) if abs(64 * x) < float("inf") else (1 << 62) * (1 if x > 0 else -1)
    for a, b in itertools.permutations(range(6), 2):
        want = sum(whole(x) * whole(y) for x, y in zip(big[a], big[b], strict=True))
        assert scores[a, b] == max(1 - (1 << 62), min((1 << 62) - 1, want))


@pytest.mark.parametrize("rank", [4, 16, 64])
def test_default_margin_finds_links(spark, rank):
    draw = np.random.default_rng(rank)
    base = draw.normal(size=(250, rank))
    x = np.concatenate([base + s * draw.normal(size=base.shape) for s in (0.02, 0.12, 0.2, 0.25)]) @ draw.normal(size=(rank, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = sum(r.n_links for r in embeddings.cosine_groups(df, cells=30).collect())
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert found >= 0.99 * (((u @ u.T) >= 0.95).sum() - len(u))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no tables here")
def test_classifiers_on_held_out_rows(spark):
    from chatloom.llm import queries

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for query, label, least in ((queries.op6_quality, "quality", 0.98), (queries.op9_toxicity, "toxic", 0.93)):
        rows = query(spark, sf).filter("held_out").join(labels, "doc_id").select("score", label).toPandas()
        ones = rows[label] == 1
        rank = rows.score.rank()
        assert (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum()) > least


def test_classifier_edges(spark):
    texts = ["fine words here " * 9, "idiot " * 30, None, "", *(["good plain text of some words"] * 40), *(["you utter idiot of words"] * 40)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, int("idiot" not in (t or "")), int("idiot" in (t or ""))) for i, t in enumerate(texts)] + [(None, 1, 1), (3, None, None), (5555, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert got[50] > 0.5 > got[10] and all(0 <= s <= 1 for s in got.values())
    assert {r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels.filter("doc_id < 0"))).collect()} <= {0.0} | {x for x in got.values() if x < 1e-9} | {r for r in [1 / (1 + np.exp(60.0))]}
    for some in (labels, labels.filter("quality = 1"), labels.filter("doc_id < 0")):
        scored = quality.score_quality(docs, quality.fit_quality(docs, some)).collect()
        assert len(scored) == len(texts) and all(0 <= r.score <= 1 for r in scored)
    assert quality.score_quality(docs.filter("doc_id < 0"), quality.fit_quality(docs, labels)).count() == 0


@pytest.mark.parametrize("held", [50, 4_000_000])
def test_toxicity_is_plain_kneser_ney(spark, held, monkeypatch):
    monkeypatch.setattr(toxicity, "HELD", held)
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6))) for _ in range(300)]
    texts = [" ".join(draw.choices(words, k=60) + ["slur"] * (i % 3 == 0)) for i in range(240)] + [None, "", " ".join(words[:3]), " ".join(words[:3])]
    draw.shuffle(texts[:160])
    marks = {i: int(i % 3 == 0) for i in range(160)}
    docs = docs_of(spark, texts)
    model = toxicity.fit_toxicity(docs.repartition(3), spark.createDataFrame(list(marks.items()), "doc_id long, toxic int"))

    split = lambda t: toxicity.expressions(t)
    contexts: dict = {}
    classes: tuple = ({}, {})
    for i, t in enumerate(texts):
        left = 0
        for w in split(t):
            contexts.setdefault(w, set()).add(left)
            if i in marks:
                classes[marks[i]].setdefault(w, set()).add(left)
            left = toxicity.context(w)
    real = lambda s: -65536 * np.log1p(-len(s) / 65536)
    n, (o, t) = {w: real(c) for w, c in contexts.items()}, ({w: real(c) for w, c in k.items()} for k in classes)

    def ratio(w):
        shared = (n[w] - 0.75 + 0.75) / sum(n.values()) if w in n else None
        p = []
        for c in (t, o):
            off = sum(min(x, 2.0) for x in c.values())
            p.append((max(c.get(w, 0) - 2, 0) / sum(c.values()), off / sum(c.values())))
        return np.log((p[0][0] + p[0][1] * shared) / (p[1][0] + p[1][1] * shared)) if shared and max(p[0][0], p[1][0]) else np.log(p[0][1] / p[1][1])

    fresh = ["never seen slur", "slur", *texts]
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs_of(spark, fresh), model).collect()}
    assert len(got) == len(fresh)
    for i, text in enumerate(fresh):
        x = [ratio(w) for w in split(text)]
        top = sorted((ratio(w) / 3 for w in set(split(text))), reverse=True)[:3]
        top += [0.0] * (3 - len(top))
        at = np.dot(model.weights, [1, sum(x) / (len(x) + 2), top[0], sum(top) / 3])
        assert abs(got[i] - 1 / (1 + np.exp(-max(-60.0, min(60.0, at))))) < 1e-6
    assert got[1] > 0.5 > got[2 + 1]


def test_rules_compile_to_what_they_hold(spark):
    draw = np.random.default_rng(8)
    x = draw.random((400, len(quality.STATISTICS)))
    y = ((x[:, 3] > 0.5) & (x[:, 7] < 0.6)).astype(int)
    model = quality.fit_rules(x, y)
    df = spark.createDataFrame([(r.tolist(),) for r in x], "s array<double>")
    got = np.array([r.p for r in df.select(model.column(F.col("s")).alias("p")).collect()])
    want = 1 / (1 + np.exp(-(model.bias + sum(w * quality._holds(r, x) for r, w in zip(model.rules, model.weights, strict=True)))))
    assert np.allclose(got, want) and ((got >= 0.5) == y).mean() > 0.97


def test_pipeline_rejects_what_the_operator_marks(spark, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: None)
    monkeypatch.setattr(corpus_pipeline, "fit_toxicity", lambda *a: None)
    monkeypatch.setattr(corpus_pipeline, "score_toxicity", lambda docs, model, name: docs.withColumn(name, F.col("s")))
    docs = spark.createDataFrame([(1, 0.1), (2, 0.29), (3, 0.3), (4, 0.45), (5, 0.6)], "doc_id long, s double")
    assert {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, "").collect()} == {1, 2}
