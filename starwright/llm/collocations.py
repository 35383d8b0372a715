"""Collocations by best-first branch-and-bound growth of phrases.

A candidate is a phrase of 2 to 5 words that occurs ``LEAST`` times or more in
its language; its score is the least, over its cuts in two, of
1000 * a * n / (l * r), with the counts a of the phrase, l and r of its two
parts and n of all words.  A part's count is never below a, so no phrase scores
more than 1000 * n / f for the count f of any of its prefixes: that bounds all
that grows from a prefix.

The frontier holds the prefixes that occur often enough and are not yet
expanded.  A round expands those of the highest bounds (bounds sink by
``WIDER`` from round to round) in one pass over the corpus, which counts their
one-word extensions, and counts in the same pass the right parts that the
candidates found before still lack.  Once a language has ``KEEP`` surviving
scores, prefixes whose bound lies under the last of them are never expanded and
candidates under it need no more counts; the search ends when no prefix is left
whose bound reaches it, so ties with it are settled too.

A pass learns what to count from one bitmap of hashed phrases, whose size is
bounded; a false positive only costs a count that is not used.  All counts are
exact: Spark sums them by the phrases themselves.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starwright.llm.common import scratch, written

LEAST = 100
KEEP = 2000
LONGEST = 5
#: How much wider the counts of the first words grow from round to round.
WIDER = 16
#: Bits of the bitmap: four for each slot, 16 slots a phrase, within these limits.
MIN_SLOTS, MAX_SLOTS = 1 << 18, 1 << 26
#: Words that a task counts before it hands them on.
COUNTED = 200_000
#: Bytes of texts of a language that a task counts at a time.
TOGETHER = 4 << 20

#: Shares of a language that are ranked apart.
SPREAD = 64

LOWER = bytes(range(65, 91)), bytes(range(97, 123))
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Every break as a full stop, which no word holds.
PIECES = bytes.maketrans(LOWER[0] + BREAKS, LOWER[1] + b"." * len(BREAKS))

#: A phrase of so many words is expanded by all that can follow at once: so few are left
#: that another pass would cost more than the few longer phrases too rare to matter.
WHOLE = 3

# The bits of a phrase: a word frequent enough, the beginning of a longer marked phrase, one to
# expand, one to count.
FREQUENT, OPEN, EXPAND, COUNT = 0, 1, 2, 3
USABLE, FOLLOWED, GROWING, COUNTING = (1 << bit for bit in (FREQUENT, OPEN, EXPAND, COUNT))


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def _words_of(batches) -> Iterator[tuple[str, list[bytes]]]:
    """The words of the texts of one language, some ``TOGETHER`` bytes at a time, with a
    full stop before and after each piece."""
    for batch in batches:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            waiting.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] >= TOGETHER:
                yield lang, _split(waiting.pop(lang))
                sizes[lang] = 0
        for lang, some in waiting.items():
            yield lang, _split(some)


def _split(texts: list[bytes]) -> list[bytes]:
    return b".".join([b"", *texts, b""]).translate(PIECES).replace(b".", b" . ").split()


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``word`` and ``f``: how often each word occurs in each language."""
    def run(batches):
        held: dict[str, Counter] = {}
        for lang, ws in _words_of(batches):
            held.setdefault(lang, Counter()).update(ws)
            if sum(map(len, held.values())) >= COUNTED:
                yield from map(_counted, held.items())
                held = {}
        yield from map(_counted, held.items())

    def _counted(held: tuple[str, Counter]) -> pa.RecordBatch:
        lang, counts = held
        counts.pop(b".", None)
        return pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(counts), pa.string()),
            "word": pa.array(list(counts), pa.binary()).cast(pa.string()),
            "f": pa.array(list(counts.values()), pa.int64())})

    return _texts(docs, text_col, lang_col).mapInArrow(
        run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _slot(slots: int, phrase: str = "phrase") -> F.Column:
    """The slot of a phrase; ``_Bits`` finds the same one in a task."""
    return F.crc32(F.concat("lang", F.lit("\n"), phrase).cast("binary")) % slots


class _Bits:
    """The four bits of the phrases of a language, from the shared bitmap."""

    def __init__(self, lang: str, bitmap: bytes, slots: int):
        self.bitmap, self.slots = np.frombuffer(bitmap, np.uint8), slots
        self.seed = zlib.crc32(f"{lang}\n".encode())

    def of(self, phrases: pa.Array) -> np.ndarray:
        hashes = map(zlib.crc32, phrases.to_numpy(zero_copy_only=False), repeat(self.seed))
        slot = np.fromiter(hashes, np.uint32, len(phrases)) % np.uint32(self.slots)
        return self.bitmap[slot >> 1] >> (4 * (slot & 1)).astype(np.uint8) & 15


def bitmap_of(marks: DataFrame, slots: int) -> bytes:
    """Four bits for each slot from rows of (lang, phrase, bit).  What reaches the
    driver is the bitmap: at most ``MAX_SLOTS`` / 2 bytes."""
    position = _slot(slots) * 4 + F.col("bit") + 1          # positions count from 1
    found = (marks.select(position.alias("at"))
             .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))
    made = bytearray(slots // 2)
    for r in found.toLocalIterator():
        at = (int(r["bucket"]) - 1) * 4096                  # 2^15 positions a bucket, from 1
        part = np.frombuffer(bytes(r["bits"])[:len(made) - at], np.uint8)
        made[at:at + len(part)] = part.tobytes()
    return bytes(made)


def count_phrases(docs: DataFrame, bitmap: bytes, slots: int, text_col: str = "text",
                  lang_col: str = "lang", least: int = LEAST) -> DataFrame:
    """One pass: the exact counts ``f`` of all one-word extensions of the phrases
    marked EXPAND (from ``WHOLE`` words on, of all longer phrases that begin so) and
    of the phrases marked COUNT, where they reach ``least``;
    ``closed`` tells that all occurrences have the same word before them, or all
    the same word after them (compared by 64-bit hashes), within their piece."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        for lang, ws in _words_of(batches):
            for phrases, f, before, after in _phrases(ws, _Bits(lang, shared.value, slots)):
                texts = [c.cast(pa.string()) for c in (phrases, before, after)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(f), pa.string()), texts[0],
                     pa.array(f, pa.int64()), *texts[1:]],
                    names=["lang", "phrase", "f", "before", "after"])

    counted = _texts(docs, text_col, lang_col).mapInArrow(
        run, "lang string, phrase string, f long, before string, after string").select(
        "lang", "phrase", "f", *(F.when(F.col(c) != ".", F.xxhash64(c)).alias(c)
                                 for c in ("before", "after")))
    sums = counted.groupBy("lang", "phrase").agg(
        F.sum("f").alias("f"),
        *(same(c).alias(f"{c}_{same.__name__}") for c in ("before", "after")
          for same in (F.min, F.max)),
        F.count(F.lit(1)).alias("parts"), F.count("before").alias("before_parts"),
        F.count("after").alias("after_parts"))

    def alike(c: str) -> F.Column:
        return (F.col(f"{c}_parts") == F.col("parts")) & (F.col(f"{c}_min") == F.col(f"{c}_max"))

    return sums.where(F.col("f") >= least).select(
        "lang", "phrase", "f", F.coalesce(alike("before") | alike("after"),
                                          F.lit(False)).alias("closed"))


def _phrases(ws: list[bytes], bits: _Bits) -> Iterator[tuple]:
    """The counted phrases among words with a full stop before and after each piece, those of
    each length at once: phrases, counts, the words before and after them (binary, null
    where they differ or where a piece begins or ends).

    A phrase is numbered by its beginning's number and its last word's, so a sort of
    numbers brings its occurrences together; only distinct ones become texts."""
    held = pa.array(ws, pa.binary()).dictionary_encode()
    code, names = held.indices.to_numpy().astype(np.int64), held.dictionary
    stop, begins = code[0], FOLLOWED | GROWING
    flags = bits.of(names)
    flags[stop] = 0
    flags = flags[code]
    at = np.flatnonzero((flags[:-1] & begins != 0) & (flags[1:] & USABLE != 0))
    phrases, number, flag = names, code[at], flags[at]
    for length in range(2, LONGEST + 1):
        going = (flag & begins != 0) & (flags[at + length - 1] & USABLE != 0)
        at, number, flag = at[going], number[going], flag[going]
        if not len(at):
            return
        last = code[at + length - 1]
        key = number * len(names) + last
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        one = order[first]                       # an occurrence of each phrase
        phrases = pc.binary_join_element_wise(
            phrases.take(pa.array(number[one])), names.take(pa.array(last[one])), b" ")
        grown, marked = flag[one] & GROWING != 0, np.zeros(len(one), np.uint8)
        followed = np.flatnonzero(flag[one] & FOLLOWED)
        marked[followed] = bits.of(phrases.take(pa.array(followed)))
        if length > WHOLE:
            marked[grown] |= GROWING
        counted = np.flatnonzero(grown | (marked & COUNTING != 0))
        if len(counted):
            beside = []
            for words in (code[at[order] - 1], code[at[order] + length]):
                least, most = (same.reduceat(words, first)[counted]
                               for same in (np.minimum, np.maximum))
                beside.append(names.take(pa.array(
                    least, mask=(least != most) | (least == stop))))
            yield (phrases.take(pa.array(counted)),
                   np.diff(first, append=len(order))[counted], *beside)
        number = np.empty(len(order), np.int64)
        number[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
        flag = marked[number]


def _length(phrase: str = "phrase") -> F.Column:
    return F.size(F.split(phrase, " "))


def _grown_from(phrase: str = "phrase") -> F.Column:
    """The phrase whose expansion counted this one."""
    return F.array_join(F.slice(F.split(phrase, " "), F.lit(1),
                                F.least(_length(phrase) - 1, F.lit(WHOLE))), " ")


def _first_word(phrase: str = "phrase") -> F.Column:
    return F.substring_index(phrase, " ", 1)


def _score(a, left, right) -> F.Column:
    """floor(1000 * a * n / (l * r)) in decimals of 37 digits, exact up to 10^15
    occurrences of a phrase and 10^18 words."""
    wide = "decimal(18,0)"
    return F.expr(f"(cast(1000 * {a} as {wide}) * cast(n as {wide})) "
                  f"div (cast({left} as {wide}) * cast({right} as {wide}))")


def _cuts(phrases: DataFrame) -> DataFrame:
    """A row for each cut of a phrase: ``k``, ``first`` (k words) and ``rest``."""
    ws = F.split("phrase", " ")
    return (phrases.withColumn("k", F.explode(F.sequence(F.lit(1), _length() - 1)))
            .withColumn("first", F.array_join(F.slice(ws, F.lit(1), F.col("k")), " "))
            .withColumn("rest", F.array_join(F.slice(ws, F.col("k") + 1, F.lit(LONGEST)), " ")))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
         keep: int = KEEP) -> DataFrame:
    """The ``keep`` best collocations of each language: ``lang``, ``rank``,
    ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of the lowest-scoring cut.

    Texts are lower-cased (A-Z) and split at punctuation and line ends, a null
    language is ``und``, a null text empty.  A candidate inside a longer one of
    the same count goes.  Ties rank by count, then by phrase; no candidates give
    no rows."""
    spark = docs.sparkSession
    words = written(word_counts(docs, text_col, lang_col), "collocation-words")
    n = written(words.groupBy("lang").agg(F.sum("f").alias("n")), "collocation-sizes")
    tables: dict[str, list[str]] = {"nodes": [], "expanded": []}

    def add(kind: str, rows: DataFrame) -> DataFrame:
        """All rows of a kind, one scan over the folders of its rounds."""
        path = scratch(spark, f"collocation-{kind}")
        rows.write.parquet(path)
        tables[kind].append(path)
        return spark.read.schema(rows.schema).parquet(*tables[kind])

    nodes = add("nodes", words.where(F.col("f") >= least).select(
        "lang", F.col("word").alias("phrase"), "f", F.lit(False).alias("closed")))
    words = nodes.select("lang", F.col("phrase").alias("word"), F.col("f").alias("word_f"))
    expanded = wanted = nodes.select("lang", "phrase").where(F.lit(False))
    scored: DataFrame | None = None
    reach = least * WIDER
    while True:
        bar = written(_bar(scored, n, keep), "collocation-bar")
        frontier = written(_frontier(nodes, expanded, words, n, bar), "collocation-frontier")
        nearest = frontier.agg(F.min("word_f")).first()[0]
        lacking = not wanted.isEmpty()
        if nearest is None and not lacking:
            break
        if nearest is not None and not lacking:
            while reach < nearest:
                reach *= WIDER
        now = frontier.where(F.col("word_f") <= reach).select("lang", "phrase")
        reach *= WIDER
        marks, slots = _marks(words, now, wanted)
        found = written(count_phrases(docs, bitmap_of(marks, slots), slots, text_col, lang_col,
                                      least), "collocation-found")
        nodes = add("nodes", found.join(nodes, ["lang", "phrase"], "left_anti"))
        expanded = add("expanded", now)
        known = written(_known_cuts(nodes, expanded, n, bar), "collocation-cuts")
        scored = written(_scores(known), "collocation-scores")
        wanted = written(known.where("r is null").select("lang", F.col("rest").alias("phrase"))
                         .distinct(), "collocation-wanted")
    if scored is None:
        return n.where(F.lit(False)).select(
            "lang", F.lit(0).cast("long").alias("rank"), F.lit("").alias("phrase"),
            *(F.lit(0).cast("long").alias(c) for c in ("a", "l", "r")), "n",
            F.lit(0).cast("long").alias("score"))
    return _ranked(scored, keep).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _ranked(scored: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` first of each language; first of each of SPREAD shares of it, so
    that no task sorts all of a language."""
    order = F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    share = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    shares = Window.partitionBy("lang", share).orderBy(*order)
    few = scored.withColumn("rank", F.row_number().over(shares)).where(F.col("rank") <= keep)
    all_ = Window.partitionBy("lang").orderBy(*order)
    return few.withColumn("rank", F.row_number().over(all_)).where(F.col("rank") <= keep)


def _bar(scored: DataFrame | None, n: DataFrame, keep: int) -> DataFrame:
    """The ``keep``-th surviving score of each language, 0 without so many."""
    if scored is None:
        return n.select("lang", F.lit(0).cast("long").alias("bar"))
    last = _ranked(scored, keep).where(F.col("rank") == keep).select("lang", "score")
    return n.join(last, "lang", "left").select(
        "lang", F.coalesce("score", F.lit(0).cast("long")).alias("bar"))


def _frontier(nodes: DataFrame, expanded: DataFrame, words: DataFrame, n: DataFrame,
              bar: DataFrame) -> DataFrame:
    """Prefixes that can still grow: not expanded, grown from an expanded one, of a
    bound that reaches the bar."""
    grown = nodes.where(_length() <= WHOLE).join(expanded, ["lang", "phrase"], "left_anti")
    firsts = grown.where(_length() == 1)
    others = grown.where(_length() > 1).withColumn("parent", _grown_from()).join(
        expanded.withColumnRenamed("phrase", "parent"), ["lang", "parent"], "left_semi")
    return (firsts.unionByName(others.drop("parent")).withColumn("word", _first_word())
            .join(words, ["lang", "word"]).join(n, "lang").join(bar, "lang")
            .where(F.expr("cast(1000 as decimal(18,0)) * cast(n as decimal(18,0)) "
                          "div cast(word_f as decimal(18,0))") >= F.col("bar")))


def _marks(words: DataFrame, now: DataFrame, wanted: DataFrame) -> tuple[DataFrame, int]:
    """The (lang, phrase, bit) rows of a pass and the slots of its bitmap."""
    def proper_prefixes(phrases: DataFrame) -> DataFrame:
        return _cuts(phrases.where(_length() > 1)).select("lang", F.col("first").alias("phrase"))

    marks = (words.select("lang", F.col("word").alias("phrase"), F.lit(FREQUENT).alias("bit"))
             .unionAll(now.withColumn("bit", F.lit(EXPAND)))
             .unionAll(wanted.withColumn("bit", F.lit(COUNT)))
             .unionAll(proper_prefixes(now).unionAll(proper_prefixes(wanted))
                       .withColumn("bit", F.lit(OPEN))))
    slots = MIN_SLOTS
    number = marks.count()
    while slots < 16 * number and slots < MAX_SLOTS:
        slots *= 2
    return marks, slots


def _known_cuts(nodes: DataFrame, expanded: DataFrame, n: DataFrame, bar: DataFrame) -> DataFrame:
    """The cuts of the candidates that survive and may still reach the bar, with
    l and, where it is known, r."""
    counts = nodes.select("lang", "phrase", F.col("f"))
    grown = nodes.where(_length() > 1).where(~F.col("closed") | (_length() == LONGEST)).withColumn(
        "parent", _grown_from()).join(
        expanded.withColumnRenamed("phrase", "parent"), ["lang", "parent"], "left_semi").select(
        "lang", "phrase", F.col("f").alias("a"))
    cuts = (_cuts(grown)
            .join(counts.toDF("lang", "first", "l"), ["lang", "first"])
            .join(counts.toDF("lang", "rest", "r"), ["lang", "rest"], "left")
            .join(n, "lang").join(bar, "lang"))
    # without r, a takes its place: what no cut can exceed
    most = cuts.withColumn("most", _score("a", "l", "coalesce(r, a)"))
    least_most = most.groupBy("lang", "phrase").agg(F.min("most").alias("top"))
    return most.join(least_most, ["lang", "phrase"]).where(F.col("top") >= F.col("bar"))


def _scores(cuts: DataFrame) -> DataFrame:
    """The candidates all of whose cuts are known, by their lowest-scoring cut."""
    lowest = F.min(F.struct(F.col("most").alias("score"), "k", "l", "r")).alias("cut")
    return (cuts.groupBy("lang", "phrase", "a", "n")
            .agg(lowest, F.max(F.col("r").isNull()).alias("open"))
            .where(~F.col("open"))
            .select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r"))
