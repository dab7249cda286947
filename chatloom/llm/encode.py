"""Token ids by the tokenizers library, with what repeats encoded once.

Two kinds of tokenizer files are known to encode parts of a text independently: byte-level ones without a normalizer,
at white space after other characters (see bpe.py), and those that turn runs of white space into one space and drop
it. For these, parts and pieces come from bounded dictionaries and the library's model sees new pieces only. For any
other file, and for parts with special tokens or letters whose case or composition is not plain, the library gets the
text itself.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np
import regex

from .bpe import CACHE, PARTS, PIECES, WS, Known, byte_letters, odd_spaces

#: Fixed by the tokenizer format: how the lower-casing word tokenizer cuts text.
WORD_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{WS}\p{{L}}\p{{N}}]+"
_WORDS = regex.compile(rf"[^{WS}]+")
#: Above this code point, case and composition are left to the library.
_PLAIN = "\u024f"


class Encoder:
    """encode(text) gives a text's ids as bytes of dtype: uint16 if the vocabulary allows, else uint32, little-endian."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype, self.code = np.dtype("<u2" if small else "<u4"), "H" if small else "I"
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        self.kind = "other"
        if pre.get("type") == "ByteLevel" and not norm and not pre.get("add_prefix_space") and pre.get("use_regex", True):
            self.kind, self.cut = "bytes", regex.compile(PIECES)
        elif norm and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]:
            split, spaces = pre["pretokenizers"][0], norm["normalizers"][1]
            if spaces["pattern"] == {"Regex": r"\s+"} and split["invert"] and split["behavior"] == "Removed" and split["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}:
                self.kind, self.cut = "words", regex.compile(WORD_PIECES)
        self.letters = {b: x for x, b in byte_letters().items()}
        self.words = Known(self._led if self.kind == "bytes" else self._word)
        self.pieces = Known(self._model, CACHE // 4)

    def _model(self, piece: str) -> bytes:
        """Ids of one piece by the library's model, which takes bytes as letters."""
        spelt = piece if piece.isascii() and piece.isalpha() else "".join([self.letters[b] for b in piece.encode()])
        return array(self.code, [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _library(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _led(self, part: str) -> bytes:
        """Ids of a space and the part, for a byte-level tokenizer."""
        if part.isalpha():
            return self._model(" " + part)
        return b"".join([self.words[x[1:]] if x[0] == " " and x[1:].isalpha() else self.pieces[x] for x in self.cut.findall(" " + part)])

    def _word(self, part: str) -> bytes:
        """Ids of a part, for a tokenizer that drops white space."""
        if max(part) > _PLAIN or max(low := part.lower()) > _PLAIN or ("<" in part and any(x in part for x in self.special)):
            return self._library(part)
        if low.isalpha():
            return self._model(low) if low == part else self.words[low]
        return b"".join([self.words[x] if x.isalpha() else self.pieces[x] for x in self.cut.findall(low)])

    def encode(self, text: str) -> bytes:
        if self.kind == "words":
            parts = _WORDS.findall(text) if any(x in text for x in "\x1c\x1d\x1e\x1f") else text.split()
            return b"".join(map(self.words.__getitem__, parts))
        if self.kind == "other" or ("<" in text and any(x in text for x in self.special)):
            return self._library(text)
        if odd_spaces(text):
            return b"".join([b"".join(map(self.pieces.__getitem__, self.cut.findall(part))) for part in PARTS.findall(text)])
        head, *parts = text.split(" ")
        return b"".join(map(self.pieces.__getitem__, self.cut.findall(head))) + b"".join(map(self.words.__getitem__, parts))


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]
