"""Hashed word features of whole texts, for the linear models on words."""

from __future__ import annotations

import functools
import re

import numpy as np
import xxhash

#: Hash buckets of each kind of feature.
BITS = 18
BUCKETS = 1 << BITS
#: Entries after which a worker's cache of words is emptied, and the longest word (characters) that is kept in it.
CACHE, CACHED_LENGTH = 300_000, 64

_FIRST, _LAST = re.compile(r"\w"), re.compile(r".*\w", re.S)


def bare(word: str) -> str:
    """Lower case, without punctuation at either end (the word itself if nothing else is in it)."""
    low = word.lower()
    first = _FIRST.search(low)
    return low[first.start() : _LAST.match(low).end()] if first else word


def shape(word: str) -> str:
    """Letters as a or A (all capitals), digits as 0, other characters as they are."""
    if word.isupper() and len(word) > 1:
        word = re.sub(r"[^\W\d_]+", "A", word)
    else:
        word = re.sub(r"[^\W\d_]+", "a", word)
    return re.sub(r"[0-9]+", "0", word)


def bucket(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term) & (BUCKETS - 1)


class _Words(dict):
    """Word to (bucket of its bare form, then of its shape) in one integer; emptied when full. Words are read whole,
    long ones without being kept."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        found = bucket("w:" + bare(word)) << BITS | bucket("s:" + shape(word))
        if len(word) <= CACHED_LENGTH:
            self[word] = found
        return found


@functools.lru_cache(maxsize=1)
def _cache() -> _Words:
    return _Words()


def codes(text: str | None) -> np.ndarray:
    """One integer for each word of the whole text: its bare bucket and its shape bucket."""
    if not text:
        return np.empty(0, np.int64)
    words = text.split()
    return np.fromiter(map(_cache().__getitem__, words), dtype=np.int64, count=len(words))


def bare_buckets(code: np.ndarray) -> np.ndarray:
    return code >> BITS


def shape_buckets(code: np.ndarray) -> np.ndarray:
    return code & (BUCKETS - 1)


def mixed(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Buckets of pairs."""
    h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (
        (b.astype(np.uint64) + np.uint64(salt)) * np.uint64(0xC2B2AE3D27D4EB4F)
    )
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0x165667B19E3779F9) >> np.uint64(64 - BITS)).astype(np.int64)


def _stems(word: str) -> list[int]:
    """The buckets of a word, read whole, and of its leading 4, 5 and 6 letters."""
    kept = bare(word)
    whole = bucket("w:" + kept)
    return [whole] + [bucket(f"{n}:{kept[:n]}") if len(kept) > n else whole for n in (4, 5, 6)]


class _Stems(dict):
    """Word to its row in a table of buckets; emptied when full."""

    def __init__(self):
        super().__init__()
        self.table = np.zeros((CACHE + 1, 4), dtype=np.int32)

    def __missing__(self, word: str) -> int:
        row = len(self)
        self.table[row] = _stems(word)
        self[word] = row
        return row


@functools.lru_cache(maxsize=1)
def _stem_cache() -> _Stems:
    return _Stems()


def stem_buckets(text: str | None) -> np.ndarray:
    """The different buckets of the words of a whole text and of their beginnings, in order."""
    if not text:
        return np.empty(0, np.int64)
    words, cache, found = set(text.split()), _stem_cache(), []
    long = [w for w in words if len(w) > CACHED_LENGTH]
    found = [np.array(_stems(w), dtype=np.int32) for w in long]
    short = list(words.difference(long))
    for k in range(0, len(short), CACHE // 4):
        part = short[k : k + CACHE // 4]
        if len(cache) + len(part) > CACHE:
            cache.clear()
        rows = np.fromiter(map(cache.__getitem__, part), dtype=np.int64, count=len(part))
        found.append(np.unique(cache.table[rows]))
    return np.unique(np.concatenate(found)).astype(np.int64) if found else np.empty(0, np.int64)
