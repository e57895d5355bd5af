"""Token ids of whole texts with a vocabulary file of the tokenizers library, words cached.

A byte-pair tokenizer whose pre-tokenizer never joins text across a blank
gives the same ids for the parts of a text as for the whole, if the cut is
at such a blank. ``Encoder`` finds out from the vocabulary file which cuts
are safe, encodes each distinct part once, and joins the ids:

- byte-level pre-tokenizer: a single space between two non-blank characters
  begins a pre-token and a single line end is one, so the text is cut before
  either;
- a pre-tokenizer that drops blanks (lower-casing and NFC are the only other
  steps): the text is cut at blanks, which go;
- any other file: the text is encoded as a whole.

A part that is letters and then ASCII punctuation is two pre-tokens in
either kind of file, looked up one by one when the part as a whole is not
known yet; letters go straight to the library's merge model, the rest through
its whole pipeline. Caches hold two
generations of at most ``CACHE`` entries; the older one is dropped when the
newer is full.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

import numpy as np

CACHE = 200_000
LONGEST_CACHED = 48
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# What makes a cut at each single space or line end unsafe: runs of blanks, other blanks.
_RUNS = ("  ", " \n", "\n ", "\n\n")
_OTHER_BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_SPECIAL = "<|"
# Control characters that Python counts as blanks and the vocabulary files' patterns do not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def _cut_rule(spec: dict) -> str:
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "space"
    steps = pre.get("pretokenizers", [])
    kinds = [x.get("type") for x in (norm or {}).get("normalizers", [])]
    if kinds == ["NFC", "Replace", "Lowercase"] and len(steps) == 2 and steps[0].get("type") == "Split" and \
            steps[0].get("invert") and steps[0].get("behavior") == "Removed" and \
            not steps[1].get("add_prefix_space") and not steps[1].get("use_regex"):
        return "blank"
    return "whole"


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()


class Cache:
    """Two generations of a bounded dict."""

    def __init__(self):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        v = self.new.get(key)
        if v is None and (v := self.old.get(key)) is not None:
            self.put(key, v)
        return v

    def put(self, key: str, value: bytes) -> None:
        if len(key) <= LONGEST_CACHED:
            if len(self.new) >= CACHE:
                self.old, self.new = self.new, {}
            self.new[key] = value


class Encoder:
    """``ids(text)``: the ids of a whole text as a numpy array."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            self.rule = _cut_rule(json.load(f))
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.words, self.plain = Cache(), Cache()  # as they stand behind a blank; as they stand alone

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _word(self, word: str) -> bytes:
        """Ids of one pre-token of letters (with its leading space, if any)."""
        if not word.isascii() or word[0] == " ":  # letters of ASCII stand for themselves
            word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()

    def _cached(self, cache: Cache, key: str, lead: str, letters: bool) -> bytes:
        v = cache.get(key)
        if v is None:
            v = self._word(lead + key) if letters else self._whole([lead + key])[0]
            cache.put(key, v)
        return v

    def _part(self, part: str) -> bytes:
        """Ids of a part that the newer cache doesn't have; it is there afterwards, with its punctuation."""
        v = self.words.get(part)
        if v is None:
            v = self._looked_up(part)
            self.words.put(part, v)
        return v

    def _looked_up(self, part: str) -> bytes:
        """Ids of a part that isn't cached as it is."""
        line, cache, lead = b"", self.words, " " if self.rule == "space" else ""
        if part[0] == "\n":  # only where cuts are made at line ends
            line, part, cache, lead = self._cached(self.plain, "\n", "", False), part[1:], self.plain, ""
        word = part.rstrip(PUNCTUATION)
        if not word.isalpha() or _SPECIAL in part or not (word.isascii() or max(word) < "\u2000"):
            return line + self._cached(cache, part, lead, False)
        if len(word) == len(part):
            return line + (self._word(lead + word) if cache is self.words else self._cached(cache, word, lead, True))
        return line + self._cached(cache, word, lead, True) + self._cached(self.plain, part[len(word):], "", False)

    def _join(self, parts: list[str]) -> bytes:
        found = list(map(self.words.new.get, parts))
        if None in found:
            found = [self._part(p) if v is None else v for p, v in zip(parts, found)]
        return b"".join(found)

    def raw(self, text: str) -> bytes:
        """Little-endian ids (``dtype``) as bytes."""
        if not text:
            return b""
        if self.rule == "space":
            if any(map(text.__contains__, _RUNS)) or text[0] in " \n" or text[-1] in " \n" or \
                    any(map(text.__contains__, _OTHER_BLANKS)):
                parts = _SAFE_SPACE.split(text)
                return b"".join(self._whole([parts[0], *[" " + p for p in parts[1:]]]))
            parts = text.replace("\n", " \n").split(" ")
            return self._whole(parts[:1])[0] + self._join(parts[1:])
        if self.rule == "blank" and not any(map(text.__contains__, _SEPARATORS)):
            # The library lower-cases character by character; Python does too, but for a final sigma.
            if text.isascii() or unicodedata.is_normalized("NFC", text) and "\u03a3" not in text:
                return self._join(text.lower().split())
        return self._whole([text])[0]

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.raw(text), dtype=self.dtype)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per vocabulary file and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
