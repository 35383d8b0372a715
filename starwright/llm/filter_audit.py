"""How filters interact: what each of five filters removes in every order.

Four filters depend on a text alone.  The fifth, identical to a text of a
smaller id, takes radix tries: prefixes are deepened until each of them covers
at most ``RANGE_BYTES`` of text or one text alone, so every prefix is a range of
the texts' order; a task inserts whole texts into a compressed trie whose
terminals hold the least id, first over its own rows (copies leave a task once),
then over a range.  Traversing the ranges' tries gives the first id of each
text; all other rows of the text are duplicates.

Each row then is a mask of the filters that it fails, and the rows shrink to
counts by part, mask and label.  All orders are read off those counts.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.llm.common import map_batches

FILTERS = "ABCDE"
RANGE_BYTES = 8 << 20
#: Bytes of text that a task's trie holds before it is emptied.
TRIE_BYTES = 16 << 20
#: Length of the first prefixes; a prefix that covers too much is taken DEEPER times as long.
FIRST_PREFIX, DEEPER = 16, 8

UPPER = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"
CONTINUATION = bytes(range(0x80, 0xC0))


class Trie:
    """A compressed trie of texts; an edge is a run of bytes, a terminal holds the
    least id of its text.  No id (None) is greater than any other."""

    __slots__ = ("edges", "ends", "least", "size")

    def __init__(self):
        self.edges: dict[int, list] = {}      # first byte: [label, child]
        self.ends, self.least, self.size = False, None, 0

    def insert(self, text: bytes, key: int | None) -> None:
        node, at = self, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                node.edges[text[at]] = [text[at:], child := Trie()]
                self.size += len(text) - at + 200
                node = child
                break
            label = edge[0]
            if not text.startswith(label, at):
                same = _common(label, text[at:at + len(label)])
                middle = Trie()
                middle.edges[label[same]] = [label[same:], edge[1]]
                edge[:] = [label[:same], middle]
                label = edge[0]
                self.size += 200
            node, at = edge[1], at + len(label)
        if not node.ends:
            node.ends, node.least = True, key
        elif key is not None and (node.least is None or key < node.least):
            node.least = key

    def terminals(self) -> Iterator[tuple[bytes, int | None]]:
        """The texts in order of their bytes, with their least ids."""
        waiting = [(b"", self)]
        while waiting:
            text, node = waiting.pop()
            if node.ends:
                yield text, node.least
            waiting.extend((text + node.edges[c][0], node.edges[c][1])
                           for c in sorted(node.edges, reverse=True))


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def _prefix_hash(text: bytes, length: int) -> int:
    return xxhash.xxh3_64_intdigest(text[:length], length) - (1 << 63)


def heavy_prefixes(texts: DataFrame, limit: int = RANGE_BYTES) -> list[np.ndarray]:
    """For each prefix length (FIRST_PREFIX, times DEEPER and so on) the hashes of the
    prefixes that cover more than ``limit`` bytes and more than one text, sorted.
    At most 8 bytes for ``limit`` bytes of text and a length reach the driver."""
    found: list[np.ndarray] = []
    while True:
        length = FIRST_PREFIX * DEEPER ** len(found)
        above = list(found)

        def start(length: int = length, above: list[np.ndarray] = above):
            def step(some: list) -> list:
                held: dict[int, list] = {}
                for text in some:
                    if text is not None and _depth(text, above) == len(above):
                        own = held.setdefault(_prefix_hash(text, length), [0, 0])
                        own[0] += len(text)
                        own[1] = max(own[1], len(text))
                return [list(held), *(map(list, zip(*held.values(), strict=True))
                                      if held else ([], []))]
            return step

        sums = map_batches(texts, "prefix long, size long, longest long", start)
        heavy = sums.groupBy("prefix").agg(
            F.sum("size").alias("size"), F.max("longest").alias("longest")).where(
            (F.col("size") > limit) & (F.col("longest") > length))
        rows = [r["prefix"] for r in heavy.select("prefix").collect()]
        if not rows:
            return found
        found.append(np.sort(np.array(rows, np.int64)))


def _depth(text: bytes, heavy: list[np.ndarray]) -> int:
    """How many of the prefix lengths are too heavy for a text."""
    for depth, some in enumerate(heavy):
        key = _prefix_hash(text, FIRST_PREFIX * DEEPER ** depth)
        at = int(np.searchsorted(some, key))
        if at == len(some) or some[at] != key:
            return depth
    return len(heavy)


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def first_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               limit: int = RANGE_BYTES) -> DataFrame:
    """``id`` and ``digest`` (128 bits) of each distinct text of ``docs`` under its
    least id (null if it has none); a null text counts as an empty one."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(
        F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    heavy = docs.sparkSession.sparkContext.broadcast(
        heavy_prefixes(source.select("text"), limit))

    def emptied(trie: Trie, prefixes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """The terminals, their texts at most 4 MB at a time (a longer one alone)."""
        some, held = [], 0
        for text, least in trie.terminals():
            depth = _depth(text, prefixes)
            some.append((_prefix_hash(text, FIRST_PREFIX * DEEPER ** depth), text, least))
            held += len(text)
            if held >= 4 << 20:
                yield _batch(some)
                some, held = [], 0
        if some:
            yield _batch(some)

    def own_rows(batches):
        prefixes, trie = heavy.value, Trie()
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                trie.insert(text, key)
                if trie.size >= TRIE_BYTES:
                    yield from emptied(trie, prefixes)
                    trie = Trie()
        yield from emptied(trie, prefixes)

    def ranges(batches):
        """Rows come sorted by range: one trie at a time."""
        now, trie = None, Trie()
        for batch in batches:
            made: list[tuple] = []
            for place, text, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != now:
                    made += ((least, _digest(t)) for t, least in trie.terminals())
                    now, trie = place, Trie()
                trie.insert(text, key)
            yield _firsts(made)
        yield _firsts([(least, _digest(t)) for t, least in trie.terminals()])

    parts = source.mapInArrow(own_rows, "place long, text binary, least long")
    return parts.repartition("place").sortWithinPartitions("place").mapInArrow(
        ranges, "id long, digest binary")


def _batch(some: list[tuple]) -> pa.RecordBatch:
    place, text, least = zip(*some, strict=True)
    return pa.RecordBatch.from_pydict({
        "place": pa.array(place, pa.int64()), "text": pa.array(text, pa.binary()),
        "least": pa.array(least, pa.int64())})


def _firsts(made: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "id": pa.array([m[0] for m in made], pa.int64()),
        "digest": pa.array([m[1] for m in made], pa.binary())})


def text_mask(text: bytes) -> int:
    """The filters A (1), B (2), C (4) and D (8) that a text fails."""
    words = text.split()
    n = len(words)
    points = len(text.translate(None, CONTINUATION))
    upper = len(text) - len(text.translate(None, UPPER))
    return ((n < 200) + 2 * (100 * len(set(words)) < 50 * n) + 4 * (100 * upper > 3 * points)
            + 8 * (len(text) != len(text.translate(None, SYMBOLS))))


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", part_col: str = "lang",
                  limit: int = RANGE_BYTES) -> DataFrame:
    """``part``, ``mask`` (a bit for each filter failed, A lowest), ``good`` and
    ``toxic`` with ``n``, the number of rows of ``docs`` alike in these.

    A null text is empty, a null part the empty string.  A row without an id
    counts as one of the greatest id and has no labels; a repeated row is no
    duplicate of itself (no *smaller* id has its text)."""
    def start():
        def step(texts: list, *rest: list) -> list:
            known = [t or b"" for t in texts]
            return [*rest, [text_mask(t) for t in known], [_digest(t) for t in known]]
        return step

    source = docs.select(
        F.col(text_col).cast("string").cast("binary").alias("text"),
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    # alike rows shrink before they are dealt by id, so that a repeated id is one row
    rows = (map_batches(source, "id long, part string, mask int, digest binary", start)
            .groupBy("id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n")))
    first = first_rows(docs, id_col, text_col, limit).select(
        F.col("id").alias("f_id"), F.col("digest").alias("f_digest"), F.lit(0).alias("again"))
    rows = rows.join(first, F.col("id").eqNullSafe(F.col("f_id"))
                     & (F.col("digest") == F.col("f_digest")), "left").select(
        "id", "part", "n", (F.col("mask") + F.coalesce("again", F.lit(16))).alias("mask"),
        # rows without an id have no labels; they are spread over the tasks
        F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(0).alias("spread"))
    marked = labels.where(F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("l_id"), F.lit(0).cast("long").alias("l_spread")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return rows.join(marked, (F.col("id") == F.col("l_id"))
                     & (F.col("spread") == F.col("l_spread")), "left").groupBy(
        "part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(F.sum("n").alias("n"))


def audit(masks: DataFrame) -> DataFrame:
    """Every order of the filters, step by step, for each part of ``failure_masks``:
    what stays, what the step's filter removes, what of its failures went before,
    what it alone fails, the good and toxic rows it removes, and the rows it
    removes summed over all orders.  No part, no rows."""
    per_part = masks.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic")).groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("found"))  # 32 at most

    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, 1):
            steps.append(("".join(FILTERS[i] for i in order), step, before, 1 << k))
            before |= 1 << k
    plan = F.explode(F.array(*(F.struct(
        F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("before"),
        F.lit(own).alias("own")) for o, s, b, own in steps))).alias("p")

    def total(wanted, value):
        return F.aggregate(F.filter("found", wanted), F.lit(0).cast("long"),
                           lambda sum_, m: sum_ + value(m))

    def number(m):
        return m["n"]

    def fails(m):
        return m["mask"].bitwiseAND(F.col("p.own")) != 0

    def still(m):
        return m["mask"].bitwiseAND(F.col("p.before")) == 0

    def removed(m):
        return fails(m) & still(m)

    # in an equal share of the 120 orders each failed filter comes first
    orders = len(steps) // len(FILTERS)
    return per_part.select("part", "found", plan).select(
        "part", "p.filter_order", "p.step",
        total(lambda m: m["mask"].bitwiseAND(F.col("p.before").bitwiseOR(F.col("p.own"))) == 0,
              number).alias("kept"),
        total(removed, number).alias("removed"),
        total(lambda m: fails(m) & ~still(m), number).alias("redundant"),
        total(lambda m: m["mask"] == F.col("p.own"), number).alias("unique_fails"),
        total(removed, lambda m: m["good"]).alias("good_lost"),
        total(removed, lambda m: m["toxic"]).alias("toxic_lost"),
        total(fails, lambda m: (m["n"] * orders / F.bit_count(m["mask"])).cast("long"))
        .alias("shapley"))
