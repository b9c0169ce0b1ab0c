"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte positions that hold token ids. Every adjacent pair that makes a token waits in
the bucket of that token's rank, by position; a bitmap of two levels of 256-bit words marks the buckets in use, so the
lowest rank is found by two find-first-set steps. A merge leaves the entries of the pairs it destroyed in their
buckets; they are skipped when they come up, as the rank at their position has changed, and those left when no pair
lives are dropped with the queue. The cost is that of the
merges, not of rescans, so very long pre-tokens stay linear but for the order within a bucket.

Ids of a pre-token are kept in a cache of two generations in each Python worker, of bounded size. Decoding gathers the
bytes of a batch's ids from one table.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import table

#: Entries of one generation of the cache, and the longest pre-token (characters) that is kept in it.
CACHE, CACHED_LENGTH = 320_000, 64
#: Ids after which a batch of results is passed on.
BATCH_IDS = 4_000_000
#: Bits of a word of the bitmap, as a power of two, and each of them.
_WORD = 8
_MASK = (1 << _WORD) - 1
_BIT = [1 << k for k in range(1 << _WORD)]


def finder(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a pattern in a text. Character classes by property are spelled out for the basic plane, so that
    the faster engine can take texts of that plane; texts beyond it, and patterns the engine doesn't know, go the other
    way."""
    full = regex.compile(pattern).findall
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    for name in sorted(set(re.findall(r"\\p\{\w+\}", pattern)) | {r"\s"}):
        runs = [m[0] for m in regex.finditer(name + "+", every)]
        spelled = "".join(f"\\u{ord(run[0]):04x}-\\u{ord(run[-1]):04x}" for run in runs)
        inside = re.compile(r"(\[[^\[\]]*?)" + re.escape(name))
        while inside.search(pattern):
            pattern = inside.sub(lambda m: m[1] + spelled, pattern)  # noqa: B023
        pattern = pattern.replace(name, f"[{spelled}]")
        if name == r"\s":
            pattern = pattern.replace(r"\S", f"[^{spelled}]")
    try:
        quick = re.compile(pattern).findall
    except re.error:
        return full

    def find(text: str) -> list[str]:
        plain = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return quick(text) if plain else full(text)

    return find


class Encoder:
    """Encodes and decodes by one table of ranks; a pattern cuts the text into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = finder(pattern)
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.binary())
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.bytes = [ranks[bytes([b])] for b in range(256)]
        #: By a left token's id: the tokens that it makes with the tokens to its right.
        self.pairs: list[dict[int, int]] = [{} for _ in range(size)]
        get = ranks.get
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = get(token[:k]), get(token[k:])
                if left is not None and right is not None:
                    self.pairs[left][right] = rank
        #: The same for two bytes.
        self.first = [[self.pairs[a].get(b, -1) for b in self.bytes] for a in self.bytes]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, pairs, bit, first = len(piece), self.pairs, _BIT, self.first
        ids = [*map(self.bytes.__getitem__, piece)]
        after, before = list(range(1, n + 1)), list(range(-1, n))
        # the rank of the pair that begins at a position, and how many pairs have one
        waiting = [first[a][b] for a, b in zip(piece, piece[1:])]  # noqa: B905
        waiting.append(-1)
        live = 0
        # the queue: positions by rank (one, or a heap of several), and the bitmap of ranks in use
        buckets, words, top = {}, {}, 0
        for at, rank in enumerate(waiting):
            if rank >= 0:
                live += 1
                if rank in buckets:
                    bucket = buckets[rank]
                    if type(bucket) is int:
                        buckets[rank] = [bucket, at]
                    else:
                        bucket.append(at)  # the greatest: still a heap
                else:
                    buckets[rank] = at
                    high = rank >> _WORD
                    words[high] = words.get(high, 0) | bit[rank & _MASK]
                    top |= 1 << high
        while live:
            high = (top & -top).bit_length() - 1
            word = words[high]
            rank = (high << _WORD) + (word & -word).bit_length() - 1
            bucket = buckets[rank]
            if type(bucket) is int:
                at, bucket = bucket, None
            else:
                at = heappop(bucket)
            if not bucket:
                del buckets[rank]
                words[high] = word = word & (word - 1)
                if not word:
                    top &= top - 1
            if waiting[at] != rank:
                continue  # stale
            gone = after[at]
            stop = after[at] = after[gone]
            ids[at] = rank
            live -= 1
            if waiting[gone] >= 0:
                waiting[gone] = -1
                live -= 1
            right, left = -1, before[at]
            if stop < n:
                before[stop] = at
                right = pairs[rank].get(ids[stop], -1)
            waiting[at] = right
            if left < 0:
                fresh = ((right, at),)
            else:
                if waiting[left] >= 0:
                    live -= 1
                new = waiting[left] = pairs[ids[left]].get(rank, -1)
                fresh = ((right, at), (new, left))
            for rank, at in fresh:
                if rank >= 0:
                    live += 1
                    if rank in buckets:
                        bucket = buckets[rank]
                        if type(bucket) is int:
                            buckets[rank] = [bucket, at] if bucket < at else [at, bucket]
                        else:
                            heappush(bucket, at)
                    else:
                        buckets[rank] = at
                        high = rank >> _WORD
                        words[high] = words.get(high, 0) | bit[rank & _MASK]
                        top |= 1 << high
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def _miss(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            ids = self.merge(piece.encode("utf-8", "replace"))
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_LENGTH:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        pieces = self.find(text)
        out = list(map(self.young.get, pieces))
        at = -1
        try:
            while True:
                at = out.index(None, at + 1)
                out[at] = self.young.get(pieces[at]) or self._miss(pieces[at])
        except ValueError:
            return b"".join(out)

    def decoded(self, ids: np.ndarray, offsets: np.ndarray) -> list[memoryview]:
        """The bytes of ids[offsets[k] : offsets[k + 1]] for each k."""
        data = self.tokens.take(pa.array(ids.astype(np.int64))).buffers()[2] if len(ids) else None
        ends = np.concatenate([[0], np.cumsum(self.lengths[ids])])[offsets]
        view = memoryview(data) if data is not None else memoryview(b"")
        return [view[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        return bytes(self.decoded(ids, np.array([0, len(ids)]))[0])


@functools.lru_cache(maxsize=2)
def encoder(raw: bytes, pattern: str) -> Encoder:
    """The encoder of a rank file's content; one for each worker."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}
    return Encoder(ranks, pattern)


def read_ranks(path: str) -> bytes:
    """The content of a rank file on the driver (under 1 MB); it goes to the executors with the task."""
    with open(path, "rb") as f:
        return f.read()


def _coded(batch: pa.RecordBatch, code: Encoder) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, list[bytes]]]:
    """(doc_id, ids, offsets, ids of each text as bytes) of a batch (doc_id, text), a bounded number of ids at a time."""
    first, size, parts = 0, 0, []
    texts = batch.column(1)
    for k in range(len(texts)):
        parts.append(code.encode(texts[k].as_py() or ""))
        size += len(parts[-1]) // 4
        if size >= BATCH_IDS or k + 1 == len(texts):
            offsets = np.cumsum([0] + [len(p) // 4 for p in parts])
            yield batch.column(0).slice(first, len(parts)), np.frombuffer(b"".join(parts), dtype="<i4"), offsets, parts
            first, size, parts = k + 1, 0, []


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def encode(docs: DataFrame, raw: bytes, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) for each row of docs, in no order; a null text counts as empty and has no ids.

    Texts are whole whatever their length; repeated rows and null ids are passed through one by one. Other columns of
    docs are ignored, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(raw, pattern)
        for batch in batches:
            for doc_id, ids, offsets, _ in _coded(batch, code):
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([doc_id, lists], names=["doc_id", "ids"])

    return _narrow(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, raw: bytes, pattern: str) -> DataFrame:
    """(doc_id, decoded binary) for each row of (doc_id, ids); a null list counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(raw, pattern)
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            texts = code.decoded(lists.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(bytes, texts), pa.binary())], names=["doc_id", "decoded"]
            )

    none = F.array().cast("array<int>")
    return tokens.select("doc_id", F.coalesce("ids", none).alias("ids")).mapInArrow(run, "doc_id bigint, decoded binary")


def round_trip(docs: DataFrame, raw: bytes, pattern: str) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256. Texts are encoded, their ids decoded, and
    both hashed in one pass over the table; odd rows as in `encode`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, sha = encoder(raw, pattern), hashlib.sha256
        for batch in batches:
            for doc_id, ids, offsets, parts in _coded(batch, code):
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_id,
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array([sha(p).hexdigest() for p in parts], pa.string()),
                        pa.array([sha(t).hexdigest() for t in code.decoded(ids, offsets)], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return _narrow(docs).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def default_vocabulary() -> tuple[bytes, str]:
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


QUERY = "op6_byte_bpe"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), *default_vocabulary())
