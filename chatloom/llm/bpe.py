"""Byte-level byte-pair encoding and decoding.

A text is cut where white space follows other characters: there every tokenizer of this kind starts a new piece, so
the parts encode alike wherever they stand. Parts and pieces seen before come from bounded dictionaries that live as
long as the Python worker; only new pieces go through the merges.

The merges of a piece: symbols form a doubly linked list, a heap holds (rank, place) of each neighbouring pair that
may merge. A popped entry is stale, and skipped, when its two symbols are no longer those that it was pushed for.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import reachable

#: The Unicode property White_Space.
WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed by the tokenizer format: how a byte-level tokenizer cuts text into pieces.
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WS}\p{{L}}\p{{N}}]+|[{WS}]+(?![^{WS}])|[{WS}]+"
PARTS = re.compile(rf"[{WS}]*[^{WS}]+|[{WS}]+")
_ODD = re.compile(r"[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Entries that a worker's dictionary may hold before it starts anew.
CACHE = 700_000


def byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write the 256 bytes: printable ones stand for themselves, the rest follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def odd_spaces(text: str) -> bool:
    """Whether some space has white space beside it, or the text holds rarer white space than spaces and line ends.

    Where that is not so, every space starts a piece, and a text can be cut at all of its spaces.
    """
    return text[:1] == " " or text[-1:] == " " or "  " in text or " \n" in text or "\n " in text or _ODD.search(text) is not None


class Known(dict):
    """A dictionary that makes missing entries and starts anew when full."""

    def __init__(self, make, limit: int = CACHE):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        self[key] = made = self.make(key)
        return made


class BytePairs:
    """Encoder and decoder for a byte-level vocabulary file (its JSON form)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        spell = lambda word: bytes(letters[x] for x in word)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ids = {spell(word): i for word, i in model["vocab"].items() if word not in self.special}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.strings = [b""] * size
        for word, i in ids.items():
            self.strings[i] = word
        for word, i in self.special.items():
            self.strings[i] = word.encode()
        self.first = [ids[bytes([b])] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = map(spell, pair.split(" ") if isinstance(pair, str) else pair)
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.cut = regex.compile(PIECES)
        self.pieces = Known(lambda piece: array("I", self.merged(piece.encode())).tobytes(), CACHE // 4)
        self.words = Known(self._word)

    def _word(self, part: str) -> bytes:
        """Ids of a space and the part. Words of letters alone are single pieces; others are put together from theirs."""
        if part.isalpha():
            return array("I", self.merged(b" " + part.encode())).tobytes()
        return b"".join([self.words[x[1:]] if x[0] == " " and x[1:].isalpha() else self.pieces[x] for x in self.cut.findall(" " + part)])

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if odd_spaces(text):
            return b"".join([b"".join(map(self.pieces.__getitem__, self.cut.findall(part))) for part in PARTS.findall(text)])
        head, *parts = text.split(" ")
        return b"".join(map(self.pieces.__getitem__, self.cut.findall(head))) + b"".join(map(self.words.__getitem__, parts))

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        symbols = [self.first[b] for b in piece]
        n, merges = len(symbols), self.merges
        if n == 1:
            return symbols
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(*found, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (found := merges.get((symbols[i], symbols[i + 1])))]
        heap = [(rank, i, new, a, b) for rank, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if found := merges.get((new, symbols[k])):
                    heapq.heappush(heap, (found[0], i, found[1], new, symbols[k]))
            if (h := before[i]) >= 0 and (found := merges.get((symbols[h], new))):
                heapq.heappush(heap, (found[0], h, found[1], symbols[h], new))
        out, i = [], 0
        while i >= 0:
            out.append(symbols[i])
            i = after[i]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        if self.split is None or "<" not in text or not self.split.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.split.finditer(text):
            out.append(self._plain(text[at : m.start()]))
            out.append(self.special[m[0]].to_bytes(4, "little"))
            at = m.end()
        out.append(self._plain(text[at:]))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, in UTF-8; bytes that are not UTF-8 become U+FFFD."""
        found = b"".join(map(self.strings.__getitem__, array("I", ids)))
        return found.decode("utf-8", "replace").encode()


_loaded: dict[str, BytePairs] = {}


def loaded(path: str) -> BytePairs:
    """One encoder for each file and Python worker."""
    if path not in _loaded:
        _loaded[path] = BytePairs(path)
    return _loaded[path]


def bpe_round_trip(docs: DataFrame, path: str, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text with the byte-level vocabulary at path (a path that executors see).

    Returns id_col, n_tokens, ids_sha256, decoded_sha256 and, with keep_ids, ids (little-endian unsigned 32-bit) and
    decoded. A null text counts as empty: no ids, an empty decoded text. Ids may be null or repeat; rows stay as they
    are, in number and order. Other columns are not read.
    """
    reachable(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    more = [("ids", pa.binary()), ("decoded", pa.string())] if keep_ids else []
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = loaded(path)
        for batch in batches:
            out = [[] for _ in schema]
            for text in batch.column(1):
                ids = pairs.encode(text.as_py() or "")
                back = pairs.decode(ids)
                for column, x in zip(out[1:], (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), ids, back.decode())):  # noqa: B905
                    column.append(x)
            yield pa.record_batch([batch.column(0), *(pa.array(x, f.type) for x, f in zip(out[1:], list(schema)[1:], strict=True))], schema=schema)

    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * keep_ids
    return rows.mapInArrow(run, kinds).withColumnRenamed("doc_id", id_col)
