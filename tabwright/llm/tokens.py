"""Token ids of whole texts with a given tokenizer file, worked out once for each distinct part of a word.

White space separates tokens in a word tokenizer, so a text's ids are those of its white-space-free pieces in turn.
The different plain pieces of a slice (letters of Latin script, ASCII digits and signs) are cut into runs of letters, digits and
signs in one pass, and only runs that are not remembered go to the byte-pair model. All other pieces, and all
pieces of any other kind of tokenizer, go through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa

from tabwright.llm.batches import ranges, split_words

# Distinct parts remembered in a Python worker, in two generations of this size.
REMEMBERED = 250_000
_LOADED: dict[str, "TextEncoder"] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes themselves, then 256 upwards."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class TextEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec.get("normalizer") or {}
        kinds = [s.get("type") for s in steps.get("normalizers", [])]
        first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_words = kinds == ["NFC", "Replace", "Lowercase"] and first.get("invert") is True
        if self.by_words and first.get("behavior") != "Removed":
            self.by_words = False
        letters = byte_letters()
        self.bytes_as_letters = {b: letters[b] for b in range(256)}
        self.parts = re.compile(r"[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+|\n")
        # beyond plain pieces: apostrophes, the dotted capital i, signs among the letters, marks of special tokens
        self.odd = re.compile(r"[^\n!-&(-~À-įı-ɏ]|[×÷]|<\|")
        self.young: dict[str, bytes] = {}  # ids as unsigned 32-bit numbers
        self.old: dict[str, bytes] = {}
        self.model = self.whole.model

    def _remembered(self, part: str, make) -> bytes:
        ids = self.young.get(part)
        if ids is None:
            ids = self.old.get(part)
            if ids is None:
                ids = make(part)
            if len(self.young) >= REMEMBERED:
                self.young, self.old = {}, self.young
            self.young[part] = ids
        return ids

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(self.bytes_as_letters)
        return array("I", [t.id for t in self.model.tokenize(part)]).tobytes()

    def _whole(self, piece: str) -> bytes:
        return array("I", self.whole.encode(piece[1:], add_special_tokens=False).ids).tobytes()

    def pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each piece, and all their ids in turn. Pieces have no ASCII white space."""
        joined = "\n".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        if not unicodedata.is_normalized("NFC", joined):
            odd = {k for k, w in enumerate(words) if self.odd.search(w) or not unicodedata.is_normalized("NFC", w)}
        else:
            odd = set(np.searchsorted(ends, [m.start() for m in self.odd.finditer(joined)], side="right").tolist())
        if odd:
            joined = "\n".join(["" if k in odd else w for k, w in enumerate(words)])
        parts = self.parts.findall(joined.lower())
        parts.append("\n")
        numbers: dict[str, int] = {"\n": 0}
        codes = np.array([numbers.setdefault(p, len(numbers)) for p in parts], np.int64)
        known = [self._remembered(p, self._part) if p != "\n" else b"" for p in numbers]
        places = np.cumsum(codes == 0) - (codes == 0)  # the piece of each part
        for k in odd:  # one part that is a piece of its own, remembered under a name no part has
            numbers["\n" + words[k]] = len(known)
            known.append(self._remembered("\n" + words[k], self._whole))
        if odd:
            own = np.array(sorted(odd), np.int64)
            more = np.array([numbers["\n" + words[k]] for k in own.tolist()], np.int64)
            order = np.argsort(np.concatenate((places, own)), kind="stable")
            places, codes = np.concatenate((places, own))[order], np.concatenate((codes, more))[order]
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(known), np.uint32)
        return np.bincount(places, weights=lengths[codes], minlength=len(words)).astype(np.int64), flat[ranges(starts[codes], lengths[codes])]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of each text's ids, and all ids in turn."""
        if not self.by_words:
            found = [np.array(e.ids, np.uint32) for e in self.whole.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int64)
            return offsets, np.concatenate([np.zeros(0, np.uint32), *found])
        rows, codes, words = split_words(texts)
        if not len(words):
            return np.zeros(len(rows), np.int64), np.zeros(0, np.uint32)
        lengths, flat = self.pieces(words.to_pylist())
        starts = np.cumsum(lengths) - lengths
        each = lengths[codes]
        ids = flat[ranges(starts[codes], each)]
        return np.concatenate(([0], np.cumsum(each)))[rows], ids


def encoder(path: str) -> TextEncoder:
    """The encoder of a tokenizer file, loaded once in a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = TextEncoder(path)
    return _LOADED[path]


def forget() -> None:
    """Let go of remembered pieces, when a worker turns to other work that needs the room."""
    for own in _LOADED.values():
        own.young, own.old = {}, {}


def with_end(offsets: np.ndarray, ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text's ids."""
    count = len(offsets) - 1
    longer = np.empty(len(ids) + count, np.uint32)
    ends = offsets[1:] + np.arange(count)
    mask = np.ones(len(longer), bool)
    mask[ends] = False
    longer[mask] = ids
    longer[ends] = end_id
    return offsets + np.arange(count + 1), longer
