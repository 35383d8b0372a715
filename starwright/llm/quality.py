"""Quality rules on DataFrame functions alone.

Base rules count words, symbols, repeated lines and repeated 8-word windows of
each whole text.  The verdict on the rest compares two multinomials over hashed
word unigrams and bigrams: one of a trusted target, one of the whole corpus.  A
document's score is the sum of its n-grams' log ratios divided by their number;
it is kept from ``THRESHOLD`` on.  The corpus counts cover every document, the
target's every trusted one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.llm.common import SPACE_CLASS, words

BUCKETS = 8192
THRESHOLD = -0.35
WINDOW = 8
MIN_WORDS = 20
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def bind(value: F.Column, use) -> F.Column:
    """``use(value)`` with ``value`` computed once, also inside further lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _hashes(array: F.Column) -> F.Column:
    return F.transform(array, lambda w: F.xxhash64(w))


def ngram_buckets(hashes: F.Column, buckets: int = BUCKETS) -> F.Column:
    """The buckets of a document's unigrams and bigrams, given its words' hashes."""
    pairs = F.when(F.size(hashes) > 1, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 2),
        lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1)))).otherwise(
        F.expr("array()").cast("array<bigint>"))
    return F.transform(F.concat(hashes, pairs), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def _buckets(docs: DataFrame, text_col: str, buckets: int) -> DataFrame:
    hashed = _hashes(words(F.col(text_col)))
    return docs.select(
        F.explode(bind(hashed, lambda h: ngram_buckets(h, buckets))).alias("bucket"))


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", buckets: int = BUCKETS) -> list[float]:
    """The log ratio of the target's to the corpus' smoothed share of each bucket.

    ``trusted`` names the target by id (nulls and repeats don't count).  Without
    any text every ratio is 0.  The result has ``buckets`` numbers, so it goes
    through the driver."""
    ids = trusted.select(F.col(id_col).alias("__id")).where("__id is not null").distinct()
    marked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    target = marked.join(ids, "__id", "left_semi")
    counted = [
        {r["bucket"]: r["count"] for r in
         _buckets(some, "__text", buckets).groupBy("bucket").count().collect()}
        for some in (target, marked)]
    sums = [sum(c.values()) + 0.5 * buckets for c in counted]
    if not counted[0]:
        return [0.0] * buckets
    return [math.log((counted[0].get(b, 0) + 0.5) / sums[0])
            - math.log((counted[1].get(b, 0) + 0.5) / sums[1]) for b in range(buckets)]


def repeated_words(hashes: F.Column, window: int = WINDOW) -> F.Column:
    """How many words lie in a window that the text holds twice or more."""
    windows = F.when(F.size(hashes) > window, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - window),
        lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(window))))).otherwise(
        F.expr("array()").cast("array<bigint>"))

    def covered(all_windows: F.Column) -> F.Column:
        placed = F.array_sort(F.transform(
            all_windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: F.Column) -> F.Column:
            same = lambda k, j: F.coalesce(F.get(s, k)["h"] == F.get(s, j)["h"], F.lit(False))
            twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                             lambda k: same(k, k - 1) | same(k, k + 1))
            return F.sort_array(F.transform(twice, lambda k: F.get(s, k)["i"]))

        def length(p: F.Column) -> F.Column:
            steps = F.transform(p, lambda x, k: F.least(
                F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

        return bind(placed, lambda s: bind(starts(s), length))

    return bind(windows, lambda w: F.when(
        F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0).cast("long")))


def judge(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """For each row of ``docs``: ``id_col``, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``score``
    (null without words) and ``kept``.

    A null text counts as empty: it has no words, fails the base rules and isn't
    kept.  Rows are judged one by one, so null and repeated ids don't matter."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    table = F.lit(ratios)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^" + SPACE_CLASS[1:]))

    def features(h: F.Column) -> F.Column:
        return F.struct(
            F.size(h).cast("long").alias("n_words"),
            repeated_words(h).alias("n_repeat_words"),
            bind(ngram_buckets(h, len(ratios)), lambda b: F.when(F.size(b) > 0, F.aggregate(
                b, F.lit(0.0), lambda total, x: total + F.get(table, x)) / F.size(b)))
            .alias("score"))

    found = docs.select(
        F.col(id_col),
        bind(_hashes(words(text)), features).alias("__f"),
        F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, "")))
        .cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
        .alias("n_dup_lines"))
    n, repeats = F.col("__f.n_words"), F.col("__f.n_repeat_words")
    failed = (n < MIN_WORDS) | (100 * repeats > 30 * n)
    return found.select(
        id_col, n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        repeats.alias("n_repeat_words"), failed.alias("base_failed"),
        F.col("__f.score").alias("score"),
        (~failed & (F.col("__f.score") >= threshold)).alias("kept"))
