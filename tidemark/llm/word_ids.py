"""Token ids of whole texts by a public word vocabulary, exactly as
``tokenizers`` gives them, with each word's ids computed once.

The vocabulary's rules never look across a space or newline, so the ids of a
text are those of its words in order.  A word of printable ASCII and Latin-1
letters is split by the vocabulary's own pattern and its parts go to the BPE
model; any other word (other scripts, combining marks, special-token strings)
goes through the whole tokenizer.  Caches are bounded and only save time.
"""

from __future__ import annotations

import re

import numpy as np

# The vocabulary's pattern, for lower-case ASCII and Latin-1 letters.
_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xdf-\xf6\xf8-\xff]+")
_PLAIN = re.compile(r"[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+\Z")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level BPE."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds:
    """``ids(text)``: little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, path: str, max_words: int = 500_000, max_parts: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        self.max_words, self.max_parts = max_words, max_parts

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        out = self.parts.get(part)
        if out is None:
            spelt = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
            out = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelt)])
            if len(self.parts) < self.max_parts and len(part) <= 40:
                self.parts[part] = out
        return out

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if _PLAIN.match(word) and "<|" not in word:
            low = word.lower()
            out = self._part(low) if low.isalpha() else b"".join([self._part(p) for p in _PART.findall(low)])
        else:
            out = self.whole(word)
        if len(self.words) < self.max_words and len(word) <= 40:
            self.words[word] = out
        return out

    def ids(self, text: str) -> bytes:
        known, miss = self.words.get, self._word
        return b"".join([known(w) or miss(w) for w in text.replace("\n", " ").split(" ")])


_LOADED: dict[str, WordIds] = {}


def loaded(path: str) -> WordIds:
    """One tokenizer per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
