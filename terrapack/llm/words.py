"""Words of a text as numpy arrays of 64-bit hashes, for the operators that read whole texts in Python."""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: A-Z to lower case; all other bytes stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hashes a worker remembers at once.
REMEMBERED = 500_000


class Words:
    """Hashes of words, remembered so that each distinct word is hashed once. bytes.split() parts at the six ASCII spaces."""

    def __init__(self, fold: bool = True):
        self.fold, self.known = fold, {}

    def __call__(self, text: str | None) -> np.ndarray:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = (raw.translate(FOLD) if self.fold else raw).split()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of n words, in order; with fewer words the whole sequence as one; none without words."""
    if not len(words):
        return words
    k = min(n, len(words))
    out = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        out = (out ^ (out >> np.uint64(29))) * MIX + words[j : len(words) - k + 1 + j]
    out ^= out >> np.uint64(32)
    out *= MIX
    return out ^ (out >> np.uint64(29))


_SHAPES = [(re.compile(r"[a-z\x80-\U0010ffff]+"), "a"), (re.compile("[A-Z]+"), "A"), (re.compile("[0-9]+"), "0")]


def shape(word: bytes) -> bytes:
    """The word with its runs of lower-case (or non-ASCII), upper-case and digit characters as one letter each."""
    text = word.decode("utf-8", "replace")
    text = "".join(c.lower() if not c.isascii() and c.islower() else "A" if not c.isascii() and c.isupper() else c for c in text)
    for pattern, to in _SHAPES:
        text = pattern.sub(to if to != "a" else "\x01", text)
    return text.replace("\x01", "a").encode()[:32]
