"""Byte-level BPE with a hierarchical-bitmap rank queue.

Merging one pre-token keeps its parts in a linked list over byte offsets.  Every
adjacent pair whose bytes form a vocabulary entry waits in the bucket of that
entry's rank; a three-level bitmap over the ranks tells which buckets hold
something, so find-first-set (lowest bit of each level) yields the lowest rank in
constant time whatever the pre-token's length.  A merge never searches its
bucket for the pairs it destroys: an entry is stale when its offset no longer
starts a part or its pair now has another rank, and is skipped when it comes up.
Within a bucket the leftmost offset goes first, which is the order that the
rank files are defined by.

Spark distributes the documents; a task encodes its rows one by one with
a bounded cache of what it has already merged.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import cached_property
from heapq import heappop, heappush
from itertools import chain

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.llm.common import kept, map_batches

#: Entries of each generation of the cache of a task's process.
CACHE_ENTRIES = 1_000_000
#: Ids that a task gathers before it hands rows on.
IDS_HELD = 200_000
#: Longer strings are merged each time and not kept.
CACHE_LENGTH = 48


def read_ranks(path: str) -> dict[bytes, int]:
    """The merge ranks of a file of base64 tokens and their ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Merges pre-tokens; the buckets and bitmaps are empty between two of them.

    ``low`` has a bit for each rank with a filled bucket, ``mid`` a bit for each
    word of ``low`` that isn't 0, ``top`` a bit for each word of ``mid``."""

    def __init__(self, ranks: dict[bytes, int]):
        n = max(ranks.values(), default=0) + 1
        self.ranks = ranks
        self.buckets: list[list[int]] = [[] for _ in range(n)]
        self.low = [0] * (n // 64 + 1)
        self.mid = [0] * (n // 4096 + 1)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token."""
        find, buckets, low, mid, top = self.ranks.get, self.buckets, self.low, self.mid, 0
        n = len(piece)
        after = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n))  # where the part to the left starts
        waiting: list[int | None] = [None] * n  # rank of the pair that starts here
        # offsets whose pair has to enter the queue; at first all
        entering = range(n - 1)
        while True:
            for i in entering:
                waiting[i] = rank = find(piece[i:after[after[i]]])
                if rank is None:
                    continue
                if bucket := buckets[rank]:
                    heappush(bucket, i)
                    continue
                bucket.append(i)
                if not low[word := rank >> 6]:
                    mid[high := word >> 6] |= 1 << (word & 63)
                    top |= 1 << high
                low[word] |= 1 << (rank & 63)
            while top:  # the leftmost of the lowest rank that isn't stale
                bits = mid[high := (top & -top).bit_length() - 1]
                bits = low[word := high << 6 | (bits & -bits).bit_length() - 1]
                bucket = buckets[rank := word << 6 | (bits & -bits).bit_length() - 1]
                i = heappop(bucket)
                if not bucket:
                    low[word] = bits = bits & bits - 1
                    if not bits:
                        mid[high] = bits = mid[high] & mid[high] - 1
                        if not bits:
                            top &= top - 1
                if waiting[i] == rank:
                    break
            else:
                break
            waiting[j := after[i]] = None
            waiting[i] = None
            after[i] = end = after[j]
            before[end] = i
            h = before[i]
            entering = ([h, i] if end < n else [h]) if h >= 0 else [i] if end < n else []
        ranks, ids, i = self.ranks, [], 0
        while i < n:
            ids.append(ranks[piece[i:after[i]]])
            i = after[i]
        return ids


class Cache:
    """Two generations of remembered results: when the young one is full, it
    becomes the old one, so what is asked for often stays."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries, self.young, self.old = entries, {}, {}

    def kept(self, key: str | bytes) -> tuple[int, ...] | None:
        found = self.old.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key: str | bytes, value: tuple[int, ...]) -> None:
        if len(key) <= CACHE_LENGTH:
            if len(self.young) >= self.entries:
                self.old, self.young = self.young, {}
            self.young[key] = value

    def keep_all(self, results: list[tuple]) -> None:
        """Keeps some results at once, a part of a generation at a time."""
        part = max(1, self.entries // 16)
        short = [x for x in results if len(x[0]) <= CACHE_LENGTH]
        for at in range(0, len(short), part):
            if len(self.young) + part > self.entries:
                self.old, self.young = self.young, {}
            self.young.update(short[at:at + part])


class Codec:
    """Encodes and decodes texts by merge ranks (rank = token id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, entries: int = CACHE_ENTRIES):
        self.ranks, self.entries = ranks, entries
        self.pattern = regex.compile(pattern)
        self.queue = RankQueue(ranks)
        self.chunks = Cache(entries)  # of chunks, and of pre-tokens by their bytes

    @cached_property
    def token(self) -> dict[int, bytes]:
        return {rank: token for token, rank in self.ranks.items()}

    @cached_property
    def decimal(self) -> dict[int, str]:
        return {rank: str(rank) for rank in self.ranks.values()}

    def piece(self, data: bytes) -> tuple[int, ...]:
        """The ids of one pre-token: its own entry if it has one, else merged."""
        if data in self.ranks:
            return (self.ranks[data],)
        ids = self.chunks.young.get(data) or self.chunks.kept(data)
        if ids is None:
            ids = tuple(self.queue.merge(data))
            self.chunks.keep(data, ids)
        return ids

    def chunk(self, chunk: str) -> tuple[int, ...]:
        ids = self.chunks.kept(chunk)
        if ids is None:
            pieces = self.pattern.findall(chunk)
            if pieces == [chunk] and len(chunk) <= CACHE_LENGTH:  # remembered as a chunk alone
                data = chunk.encode()
                rank = self.ranks.get(data)
                ids = tuple(self.queue.merge(data)) if rank is None else (rank,)
            else:
                ids = tuple(chain.from_iterable(self.piece(p.encode()) for p in pieces))
            self.chunks.keep(chunk, ids)
        return ids

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for chunk in space_chunks(text):
            ids += self.chunks.young.get(chunk) or self.chunk(chunk)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


# A space after white space starts no chunk of its own unless a word follows.
_JOINED = re.compile(r"\s (?:\s|\Z)")
one_chunk = _JOINED.search


def space_chunks(text: str) -> list[str]:
    """``text`` cut before each space, at places where the pre-token pattern of
    these vocabularies always cuts (a space belongs to the word behind it), so
    chunks can be encoded alone.  A text with a space between white space,
    where that doesn't hold, stays one chunk."""
    if not text:
        return []
    if _JOINED.search(text):
        return [text]
    first, *rest = text.split(" ")
    chunks = [" " + x for x in rest]
    return [first, *chunks] if first else chunks


def held_codec(ranks: dict[bytes, int], pattern: str, entries: int = CACHE_ENTRIES) -> Codec:
    """One codec for all tasks that a worker process runs with the same broadcast
    vocabulary, so the next task finds what the last one cached; a task of another
    operator frees it."""
    return kept(("codec", id(ranks), pattern, entries), lambda: Codec(ranks, pattern, entries))


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str,
                     schema: str = "ids array<int>",
                     result: Callable[[Codec, list[int]], tuple] = lambda codec, ids: (ids,),
                     id_col: str = "doc_id", text_col: str = "text",
                     entries: int = CACHE_ENTRIES) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` and the columns of ``schema``,
    which ``result(codec, ids)`` makes of the document's ids in the same task
    (by default the ids themselves).

    A null or empty text has no ids.  A null or repeated id is carried along.
    ``pattern`` must give a space to the word behind it (see ``space_chunks``).
    The vocabulary (some 50,000 entries, at most ``MAX_VOCABULARY``) is broadcast.
    A worker process remembers at most twice ``entries`` results, and hands on
    rows when they hold ``IDS_HELD`` ids.
    """
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{len(ranks)} ranks; at most {MAX_VOCABULARY} are broadcast")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def start():
        codec = held_codec(shared.value, pattern, entries)

        def step(keys: list, texts: list):
            rows, held = [], 0
            for key, text in zip(keys, texts, strict=True):
                ids = codec.encode(text or "")
                rows.append((key, *result(codec, ids)))
                held += len(ids)
                if held >= IDS_HELD:
                    yield [*map(list, zip(*rows, strict=True))]
                    rows, held = [], 0
            if rows:
                yield [*map(list, zip(*rows, strict=True))]

        return step

    source = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = source.schema[0].dataType.simpleString()
    return map_batches(source, f"`{id_col}` {kind}, {schema}", start, keeps=True)


MAX_VOCABULARY = 1_000_000


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id",
                     ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``decoded`` (binary) of each row; null ids decode to no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def start():
        token = {rank: token for token, rank in shared.value.items()}
        return lambda keys, lists: [keys, [b"".join(map(token.__getitem__, x or []))
                                           for x in lists]]

    source = encoded.select(id_col, ids_col)
    kind = source.schema[0].dataType.simpleString()
    return map_batches(source, f"`{id_col}` {kind}, decoded binary", start)
