"""Exact Jaccard self-join of documents over word shingles by vertical
partitioning.

A document's set holds the 64-bit hashes of its distinct shingles.  Documents
with one set are one class, which the join sees once.  All shingles have one
global order: first by whether they are among the most frequent ones, then by
hash.  Two sets that reach the threshold share a shingle within the prefixes
(the first n - ceil(t * n) + 1 shingles) of both.

The global order is cut into fragments.  Each fragment gathers the prefix rows
(shingle, class, n) of its shingles, and counts for each pair of classes that
meet in it how many shingles they share there: shingles with the same classes
are one bucket with their number as its weight.  Sums per pair over the fragments
and buckets give the prefix overlap, which bounds the whole overlap from above and rules most pairs
out.  The pairs left are verified the same way: their sets are cut into
fragments, each fragment's overlap is counted by itself, and summed per pair.

The result is the components, so pairs need not be listed where a group is
already one component.  In hub rounds every bucket's classes meet only one of
them (linear work, in joins that split hot buckets), at first the one most of whose prefix is shared, such as
the original of a group of copies; afterwards all pairs of classes that share a
prefix shingle and are still in different components meet.  So no link between
components is ever missed, and a group of thousands of near copies that hubs
hold together stays linear.

Each class has a bitmap of the parities of its shingles' counts by their low bits.
Two bitmaps differ in at most as many bits as the sets have shingles apart, which
bounds the overlap from above: the last round hands on the pairs that this leaves.

Buckets with one component left need no further meeting and go after each round.
Shingles, classes and pairs are 64-bit hashes: two different ones among N
coincide with probability below N squared / 2 ** 65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.llm.common import map_batches, written

SHINGLE = 5
PERCENT = 75
#: The frequent shingles that go last: the HOT most frequent of those in
#: HOT_FROM documents or more (a bounded list on the driver and in the tasks).
HOT = 1_000_000
HOT_FROM = 8
#: A frequent shingle with more documents has its rows spread over the fragments.
HUGE_FROM = 100_000
#: Prefix rows of a fragment, on average; rows a task holds before it sends them.
FRAGMENT_ROWS = 250_000
FLUSH_ROWS = 500_000
#: Partial overlaps a task holds before it sums and sends them.
PAIR_ROWS = 200_000
#: Pairs of a part of the last round, on average.
CROSS_PAIRS = 500_000
#: Hub rounds go on while the pairs left are more than so many for each row and
#: a round leaves less than this share of them.
PAIRS_LEFT, SHARE_LEFT = 2, 0.9
VERIFY_FRAGMENTS = 4
FILTER_BITS = 23
#: Bits of a class' bitmap; it rules out little where sets have more than so many shingles.
PARITY_BITS = 1024
#: Bytes of text hashed at a time.
STRIDE = 1 << 18

ROW = np.dtype([("token", "<u8"), ("key", "<i8"), ("n", "<i4")])

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RANDOM = np.random.Generator(np.random.PCG64(20240517))
_BYTE = _RANDOM.integers(0, 1 << 64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _RANDOM.integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """The powers of the base and of its inverse modulo 2 ** 64, up to ``n``."""
    if len(_POWERS[0]) <= n:
        size = 1 << int(n).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(data: np.ndarray) -> np.ndarray:
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return _mix(h + (ends - starts).astype(np.uint64))


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles of ``size`` words, A-Z
    lower-cased; a shorter text is one shingle, one without words has none."""
    raw = text.encode().lower()
    parts, at = [], 0
    while at < len(raw):
        end = at + STRIDE
        if end < len(raw):  # on to the end of the word
            while end < len(raw) and not _SPACE[raw[end]]:
                end += 1
        parts.append(_word_hashes(np.frombuffer(raw[at:end], np.uint8)))
        at = end
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(words):
        return words
    k = min(size, len(words))
    h = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        h += words[i:len(words) - k + 1 + i] * _PLACE[i]
    return np.unique(_mix(h + np.uint64(k)))


def set_key(tokens: np.ndarray) -> int:
    """One hash of a whole set."""
    with np.errstate(over="ignore"):
        total = _mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        h = _mix(np.array([total + np.uint64(len(tokens))], np.uint64))
    return int(h.view(np.int64)[0])


def parities(tokens: np.ndarray) -> bytes:
    """A bit for each value of a shingle's low bits: whether the set holds an odd
    number of such shingles."""
    low = (tokens & np.uint64(PARITY_BITS - 1)).astype(np.int64)
    return np.packbits(np.bincount(low, minlength=PARITY_BITS) & 1).tobytes()


def need(n: np.ndarray | int, percent: int):
    """The least overlap with any set that reaches the threshold."""
    return -(-percent * n // 100)


def overlap(nx, ny, percent: int):
    """The least overlap of sets of these sizes: 100 i >= percent (nx + ny - i)."""
    return -(-percent * (nx + ny) // (100 + percent))


def prefix(tokens: np.ndarray, hot: np.ndarray, percent: int) -> np.ndarray:
    length = len(tokens) - int(need(len(tokens), percent)) + 1
    if not len(hot):
        return tokens[:length]
    for some in (tokens[:length * 3 // 2 + 8], tokens):  # mostly the first ones do
        short = some >> np.uint64(24)
        last = hot[np.minimum(np.searchsorted(hot, short), len(hot) - 1)] == short
        if len(some) - last.sum() >= length or len(some) == len(tokens):
            break
    return np.concatenate([some[~last], some[last]])[:length]


def _fragment(tokens: np.ndarray, fragments: int) -> np.ndarray:
    return ((tokens >> np.uint64(40)) * np.uint64(fragments) >> np.uint64(24)).astype(np.int64)


def _blobs(rows: np.ndarray, fragment: np.ndarray) -> pa.RecordBatch:
    """``rows`` by fragment, each fragment's bytes in one row."""
    order = np.argsort(fragment, kind="stable")
    rows, fragment = rows[order], fragment[order]
    firsts = np.flatnonzero(np.diff(fragment, prepend=~fragment[:1]))
    blobs = [part.tobytes() for part in np.split(rows, firsts[1:])] if len(rows) else []
    return pa.RecordBatch.from_pydict({"fragment": pa.array(fragment[firsts], pa.int64()),
                                       "blob": pa.array(blobs, pa.binary())})


def _sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, n, key, parities, mark of the row) for each row of ``docs``, written."""
    def start():
        def step(ids: list, texts: list, marks: list) -> list:
            found = [shingles(t or "", size) for t in texts]
            return [ids, [len(s) for s in found], [set_key(s) if len(s) else None for s in found],
                    [parities(s) if len(s) else None for s in found], marks]
        return step

    source = docs.select(F.col(id_col), F.col(text_col).cast("string"),
                         _mark(id_col, text_col).alias("__mark"))
    kind = source.schema[0].dataType.simpleString()
    return written(map_batches(
        source, f"`{id_col}` {kind}, n_shingles long, key long, parities binary, __mark long",
        start),
        "jaccard-sets")


def _mark(id_col: str, text_col: str) -> F.Column:
    """A hash of id and text by which a row is found again, a null id's too."""
    return F.xxhash64(F.col(id_col), F.col(text_col).cast("string"))


def _hot_shingles(docs: DataFrame, text_col: str, size: int, percent: int, fragments: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """The first 40 bits of the most frequent shingles of the prefixes and half as
    much behind them, and of those among them with more than HUGE_FROM.  Any
    choice gives right results; this one keeps shingles that many documents
    share out of the prefixes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def sent() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            short = (tokens >> np.uint64(24)).astype("<u8").view("u1").reshape(-1, 8)[:, :5]
            held.clear()
            return _blobs(np.ascontiguousarray(short).view("V5").ravel(),
                          _fragment(tokens, fragments))

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = shingles(text or "", size)
                held.append(found[:(len(found) - int(need(len(found), percent)) + 1) * 3 // 2])
            if sum(map(len, held)) >= FLUSH_ROWS:
                yield sent()
        if held:
            yield sent()

    def most(blobs: pd.DataFrame) -> pd.DataFrame:
        short = np.frombuffer(b"".join(blobs["blob"]), "u1").reshape(-1, 5)
        wide = np.zeros((len(short), 8), "u1")
        wide[:, :5] = short
        values, counts = np.unique(wide.view("<u8").ravel(), return_counts=True)
        often = counts >= HOT_FROM
        return pd.DataFrame({"short": values[often].astype("i8"), "n": counts[often]})

    rows = (docs.select(F.col(text_col).cast("string")).mapInArrow(
        count, "fragment long, blob binary").groupBy("fragment")
        .applyInPandas(most, "short long, n long")
        .orderBy(F.desc("n"), "short").limit(HOT).toArrow())
    hot, n = rows.column(0).to_numpy().astype(np.uint64), rows.column(1).to_numpy()
    return np.sort(hot), np.sort(hot[n > HUGE_FROM])


def _shared_prefixes(docs: DataFrame, text_col: str, size: int, percent: int, fragments: int,
                     hot: np.ndarray, huge: np.ndarray) -> DataFrame:
    """(bucket, key, n, w): the classes that meet on a shingle of their prefixes,
    written.  Shingles with the same classes are one bucket, of weight ``w``.
    The rows of ``huge`` shingles are spread over the fragments by class, and each
    such shingle is a bucket.  Copies within a task are sent once."""
    shared = docs.sparkSession.sparkContext.broadcast((hot, huge))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        hot, huge = shared.value

        def sent() -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            held.clear()
            seen.clear()
            wide = np.isin(rows["token"] >> np.uint64(24), huge)
            yield _blobs(rows[~wide], _fragment(rows["token"][~wide], fragments))
            if wide.any():
                spread = _fragment(_mix(rows["key"][wide].view("u8")), fragments)
                yield _blobs(rows[wide], ~spread)

        rows = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens = shingles(text or "", size)
                if not len(tokens) or (key := set_key(tokens)) in seen:
                    continue
                seen.add(key)
                front = prefix(tokens, hot, percent)
                part = np.empty(len(front), ROW)
                part["token"], part["key"], part["n"] = front, key, len(tokens)
                held.append(part)
                rows += len(part)
                if rows >= FLUSH_ROWS:
                    yield from sent()
                    rows = 0
        if held:
            yield from sent()

    def meet(blobs: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(blobs["blob"]), ROW)
        rows = rows[np.lexsort((rows["key"], rows["token"]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows["token"][1:] != rows["token"][:-1]) | (rows["key"][1:] != rows["key"][:-1])
        rows = rows[new]
        if blobs["fragment"].iloc[0] < 0:
            bucket, w = rows["token"], np.ones(len(rows), "i8")
        else:
            starts = np.flatnonzero(np.diff(rows["token"], prepend=~rows["token"][:1]))
            sizes = np.diff(starts, append=len(rows))
            sums = np.add.reduceat(_mix(rows["key"].view("u8") ^ _PLACE[size]), starts)
            same, first, times = np.unique(_mix(sums + sizes.astype("u8")), return_index=True,
                                           return_counts=True)
            some = np.zeros(len(starts), bool)
            some[first[sizes[first] > 1]] = True
            bucket, w = np.zeros(len(starts), "u8"), np.zeros(len(starts), "i8")
            bucket[first], w[first] = same, times
            rows = rows[np.repeat(some, sizes)]
            bucket, w = np.repeat(bucket[some], sizes[some]), np.repeat(w[some], sizes[some])
        return pd.DataFrame({"bucket": bucket.view("i8"), "key": rows["key"],
                             "n": rows["n"].astype("i8"), "w": w})

    blobs = docs.select(F.col(text_col).cast("string")).mapInArrow(
        send, "fragment long, blob binary")
    met = blobs.groupBy("fragment").applyInPandas(meet, "bucket long, key long, n long, w long")
    return written(met.groupBy("bucket", "key").agg(F.first("n").alias("n"), F.sum("w").alias("w")),
                   "jaccard-prefixes")


_PAIRS = "x long, y long, nx long, ny long, partial long"


def _similar_sizes(nx: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)


def _summed(parts: list[np.ndarray]) -> np.ndarray:
    """Partial overlaps of pairs (x, y, nx, ny, count), summed per pair."""
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    new = np.flatnonzero(np.any(np.diff(rows[:, :2], axis=0, prepend=rows[:1, :2] ^ 1), axis=1))
    out = rows[new]
    out[:, 4] = np.add.reduceat(rows[:, 4], new)
    return out


def _pairs(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, w: np.ndarray
           ) -> np.ndarray:
    low = x < y
    return np.stack([np.where(low, x, y), np.where(low, y, x), np.where(low, nx, ny),
                     np.where(low, ny, nx), w], axis=1)


def _frame(parts: list[np.ndarray]) -> pd.DataFrame:
    rows = _summed(parts) if parts else np.zeros((0, 5), np.int64)
    return pd.DataFrame(rows, columns=["x", "y", "nx", "ny", "partial"])


def _hub_pairs(labelled: DataFrame, percent: int, seed: int) -> DataFrame:
    """Each bucket's classes against one of them, the hub, if they are in other
    components.  At first (``seed`` 0) the hub is the class with the most shared
    prefix, later another one by hash."""
    order = F.xxhash64(F.lit(seed), "key") if seed else -F.col("central")
    hubs = labelled.groupBy("bucket").agg(
        F.min(F.struct(order.alias("order"), "key", "n", "root", "w")).alias("hub"))
    met = labelled.join(hubs, "bucket").where(
        (F.col("root") != F.col("hub.root"))
        & (100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n")))
    low = F.col("key") < F.col("hub.key")
    either = lambda a, b: F.when(low, F.col(a)).otherwise(F.col(b))
    return met.select(
        F.least("key", "hub.key").alias("x"), F.greatest("key", "hub.key").alias("y"),
        either("n", "hub.n").alias("nx"), either("hub.n", "n").alias("ny"),
        F.greatest("w", "hub.w").alias("partial"))


def _cross_pairs(labelled: DataFrame, classes: DataFrame, percent: int, parts: int) -> DataFrame:
    """All pairs of classes of different components that share a bucket and whose
    bitmaps (``parities`` of ``classes``) leave room for the threshold."""
    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches)
        own = rows["parities"].notna()
        known = rows[own].sort_values("key")
        bits = np.frombuffer(b"".join(known["parities"]), "u8").reshape(len(known), -1)
        rows = rows[~own].sort_values(["bucket", "root"], kind="stable")
        bucket, key, n, root, w = (rows[c].to_numpy() for c in ("bucket", "key", "n", "root", "w"))
        at = np.searchsorted(known["key"].to_numpy(), key)
        starts = np.flatnonzero(np.diff(bucket, prepend=~bucket[:1]))
        made, held = [], 0
        for start, end in zip(starts, np.append(starts[1:], len(rows)), strict=True):
            firsts = start + np.flatnonzero(np.diff(root[start:end], prepend=~root[start]))
            for a, b in zip(firsts, np.append(firsts[1:], end), strict=True):
                for i in range(a, b) if b < end else ():
                    for c in range(b, end, PAIR_ROWS):
                        use = np.arange(c, min(c + PAIR_ROWS, end))
                        use = use[_similar_sizes(n[i], n[use], percent)]
                        apart = np.bitwise_count(bits[at[use]] ^ bits[at[i]]).sum(
                            axis=1, dtype=np.int64)
                        use = use[(n[i] + n[use] - apart) // 2 >= overlap(n[i], n[use], percent)]
                        if len(use):
                            made.append(_pairs(np.full(len(use), key[i]), key[use],
                                               np.full(len(use), n[i]), n[use],
                                               np.maximum(w[i], w[use])))
                            held += len(use)
                        if held >= PAIR_ROWS:
                            yield _frame(made)
                            made, held = [], 0
        yield _frame(made)

    dealt = labelled.select(F.pmod(F.xxhash64("bucket"), F.lit(parts)).alias("part"),
                            "bucket", "key", "n", "root", "w", F.lit(None).cast("binary")
                            .alias("parities"))
    none = F.lit(0).cast("long")
    own = (dealt.select("part", "key").distinct().join(classes.select("key", "parities"), "key")
           .select("part", none.alias("bucket"), "key", none.alias("n"), none.alias("root"),
                   none.alias("w"), "parities"))
    return dealt.unionByName(own).groupBy("part").applyInPandas(meet, _PAIRS)


def _unsettled(shared: DataFrame, roots: DataFrame) -> tuple[DataFrame, int]:
    """The rows of buckets that hold several components, with each row's ``root``,
    written, and the number of pairs of such rows."""
    labelled = (shared.drop("root").join(roots, "key", "left")
                .withColumn("root", F.coalesce("root", "key")))
    each = labelled.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    left = each.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("roots"),
        ((F.pow(F.sum("n"), 2) - F.sum(F.pow(F.col("n"), 2))) / 2).alias("left"))
    left = written(left.where("roots > 1").select("bucket", "left"), "jaccard-buckets")
    rows = written(labelled.join(left.select("bucket"), "bucket"), "jaccard-left")
    return rows, int(left.agg(F.sum("left").alias("left")).first()["left"] or 0)


def _candidates(partial: DataFrame, percent: int) -> DataFrame:
    """Pairs whose prefix overlap, summed over the fragments, leaves room for the
    threshold: what else they share lies behind one of the prefixes."""
    summed = partial.groupBy("x", "y", "nx", "ny").agg(F.sum("partial").alias("shared"))
    behind = lambda n: F.ceil(F.col(n) * percent / 100).cast("long") - 1
    least = F.ceil((F.col("nx") + F.col("ny")) * percent / (100 + percent)).cast("long")
    return summed.where(F.col("shared") + F.greatest(behind("nx"), behind("ny")) >= least)


def _among(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` with one of the ``ids``.  A filter of fixed size drops
    most others before the join, so their texts aren't shuffled."""
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << FILTER_BITS - 3, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            np.bitwise_or.at(table, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        yield pa.RecordBatch.from_pydict({"bits": pa.array([table.tobytes()], pa.binary())})

    place = F.pmod(F.xxhash64("__id"), F.lit(1 << FILTER_BITS))
    ids = ids.select(F.col(id_col).alias("__id"))
    table = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for row in ids.select(place).repartition(8).mapInArrow(bits, "bits binary").collect():
        table |= np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            mask = shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1
            yield batch.filter(pa.array(mask.astype(bool)))

    placed = docs.withColumn("__id", F.col(id_col)).withColumn("__place", place)
    some = placed.mapInArrow(keep, placed.schema).drop("__place")
    return some.join(ids, "__id", "left_semi").drop("__id")


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str,
           size: int, percent: int) -> DataFrame:
    """The pairs (x, y) that reach the threshold.  Each class' set is cut into
    fragments of the global order; a pair's overlap is counted fragment by
    fragment and summed."""
    pairs = written(pairs, "jaccard-pairs")
    wanted = pairs.select(F.col("x").alias("key")).union(pairs.select("y")).distinct()
    # a row of each class; one that only shares its mark is cut as well and not asked for
    marks = classes.join(wanted, "key").select("__mark")

    def cut(texts: list) -> Iterator[list]:
        for text in texts:
            tokens = shingles(text or "", size)
            if len(tokens):
                fragment = _fragment(tokens, VERIFY_FRAGMENTS)
                ends = np.searchsorted(fragment, np.arange(VERIFY_FRAGMENTS + 1))
                blobs = [tokens[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
                some = [f for f, b in enumerate(blobs) if b]
                yield [[set_key(tokens)] * len(some), some, [blobs[f] for f in some]]

    texts = _among(docs.select(_mark(id_col, text_col).alias("__mark"),
                               F.col(text_col).cast("string").alias("__text")), marks, "__mark")
    parts = map_batches(texts.select("__text"), "key long, fragment long, tokens binary",
                        lambda: cut).dropDuplicates(["key", "fragment"])
    parts = written(parts, "jaccard-parts")

    def count(x: list, y: list, nx: list, ny: list, a: list, b: list) -> list:
        partial = [len(np.intersect1d(np.frombuffer(p, "<u8"), np.frombuffer(q, "<u8"),
                                      assume_unique=True)) for p, q in zip(a, b, strict=True)]
        return [x, y, nx, ny, partial]

    met = (pairs.select("x", "y", "nx", "ny")
           .join(parts.select(F.col("key").alias("x"), "fragment", F.col("tokens").alias("a")), "x")
           .join(parts.select(F.col("key").alias("y"), "fragment", F.col("tokens").alias("b")),
                 ["y", "fragment"]))
    counted = map_batches(met.select("x", "y", "nx", "ny", "a", "b"), _PAIRS, lambda: count)
    total = counted.groupBy("x", "y", "nx", "ny").agg(F.sum("partial").alias("i"))
    return total.where(100 * F.col("i") >= percent * (F.col("nx") + F.col("ny") - F.col("i"))
                       ).select("x", "y")


def components(links: DataFrame) -> DataFrame:
    """(key, root) for every node of the links: the smallest node its links reach.
    Each round takes the least root among a node and its neighbours, then the
    root's root, until nothing changes; each round's labels are written."""
    both = written(links.union(links.select("y", "x")).toDF("key", "other").distinct(),
                   "jaccard-links")
    labels = both.groupBy("key").agg(F.least("key", F.min("other")).alias("root"))
    labels = written(labels, "jaccard-roots")
    while True:
        near = (both.join(labels.withColumnRenamed("key", "other"), "other")
                .groupBy("key").agg(F.min("root").alias("near")))
        hop = labels.join(near, "key").select("key", F.col("root").alias("old"),
                                              F.least("root", "near").alias("root"))
        roots = labels.select(F.col("key").alias("root"), F.col("root").alias("up"))
        new = written(hop.join(roots, "root", "left").select(
            "key", "old", F.least("root", F.coalesce("up", "root")).alias("root")),
            "jaccard-roots")
        labels = new.select("key", "root")
        if new.where("root <> old").isEmpty():
            return labels


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """For each row of ``docs``: ``id_col``, ``n_shingles`` and ``component_id``,
    the smallest id that links reach from it, its own included.

    Rows link when 100 * intersection >= ``percent`` * union of their sets of
    ``size``-word shingles.  A null or empty text and one without words has no
    shingles and no links: its component is its own id.  Repeated rows and ids
    are rows of their own; a null id never names a component, so one that links
    to nothing has a null component.  An empty table has no rows."""
    sets = _sets(docs, id_col, text_col, size)
    classes = sets.where("n_shingles > 0").groupBy("key").agg(
        F.min(id_col).alias("first"), F.min("__mark").alias("__mark"),
        F.min("parities").alias("parities"))
    total = sets.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0
    fragments = max(1, total * (100 - percent) // 100 // FRAGMENT_ROWS)
    hot, huge = _hot_shingles(docs, text_col, size, percent, fragments)
    shared = _shared_prefixes(docs, text_col, size, percent, fragments, hot, huge)
    length = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("long") + 1
    central = shared.groupBy("key").agg(
        (F.sum("w") * 1000 / F.first(length)).cast("long").alias("central"))
    rows = shared.count()
    links = met = None
    roots = classes.select("key", F.col("key").alias("root"))
    shared = written(shared.join(central, "key").withColumn("root", F.col("key")),
                     "jaccard-central")
    step, left, last = 0, float("inf"), False
    while True:
        if step:
            before = left
            shared, left = _unsettled(shared, roots)
            last = left <= PAIRS_LEFT * rows or left > SHARE_LEFT * before
        if last:
            partial = _cross_pairs(shared, classes, percent, 1 + int(left) // CROSS_PAIRS)
        else:
            partial = _hub_pairs(shared, percent, step)
        pairs = _candidates(partial, percent)
        if met is not None:
            pairs = pairs.join(met, ["x", "y"], "left_anti")
        pairs = written(pairs, "jaccard-candidates")
        met = pairs.select("x", "y") if met is None else met.union(pairs.select("x", "y"))
        if not pairs.isEmpty():
            new = written(_links(pairs, docs, classes, id_col, text_col, size, percent),
                          "jaccard-found")
            links = new if links is None else links.union(new)
            roots = roots if new.isEmpty() else components(links)
        if last:
            break
        step += 1
    grouped = classes.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = grouped.join(least, "root").select("key", "component_id")
    return sets.join(named, "key", "left").select(
        id_col, "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col(id_col))
        .alias("component_id"))
