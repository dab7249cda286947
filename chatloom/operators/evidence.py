"""Passages looked for in texts: one automaton over all of them, so that a text is read once however many there are."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .storage import reachable

#: Characters of passages that an automaton is made of, about, at most; of more, several are made, and texts are read for each.
MOST = 8_000_000


def holding(texts: DataFrame, passages: DataFrame, most: int = MOST) -> DataFrame:
    """(key, id), each once: which passages (key, passage) stand in which texts (id, text), character by character.

    Null and empty passages stand nowhere, null texts hold none. Equal passages of several keys are found for each, and a
    passage within another as well.
    """
    reachable(texts.sparkSession)
    wanted = passages.select("key", F.col("passage").cast("string").alias("passage")).filter("length(passage) > 0")
    blocks = max(1, -(-(wanted.agg(F.sum(F.length("passage"))).first()[0] or 0) // most))
    kinds = {"key": wanted.schema["key"].dataType, "id": texts.schema["id"].dataType}
    schema = pa.schema([(n, to_arrow_type(k)) for n, k in kinds.items()])
    rows = texts.select("id", F.col("text").cast("string").alias("text")).filter("text is not null")
    out = None
    for block in range(blocks):
        # about `most` characters each, as hashes deal passages evenly; one longer than that is alone in being so
        mine = wanted.filter(F.pmod(F.xxhash64("passage"), F.lit(blocks)) == block).toArrow()
        of: dict[str, list] = {}
        for key, passage in zip(mine.column("key").to_pylist(), mine.column("passage").to_pylist(), strict=True):
            of.setdefault(passage, []).append(key)
        sent = texts.sparkSession.sparkContext.broadcast(of)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = ahocorasick.Automaton()
            for passage, keys in sent.value.items():
                known.add_word(passage, keys)
            if len(known):
                known.make_automaton()
            for batch in batches if len(known) else ():
                found = [(key, i) for i, t in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True) for key in {k for _, keys in known.iter(t.as_py()) for k in keys}]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True) if found else ([], []), schema, strict=True)], schema=schema)

        part = rows.mapInArrow(run, f"key {kinds['key'].simpleString()}, id {kinds['id'].simpleString()}")
        out = part if out is None else out.union(part)
    return out.distinct()
