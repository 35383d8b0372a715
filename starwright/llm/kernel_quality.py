"""Quality by kernel ridge regression on statistics of a document.

A text gives ``STATISTICS`` (shares of character classes, repetition, lines).
Random Fourier features turn the standardised statistics into ``FOURIER``
cosines whose inner products approximate a Gaussian kernel.  Partitions sum the
normal equations of the labelled rows, one sum for each of ``PARTS`` parts of
them; the sums over all parts give the weights, the sums without one part give
scores for that part that its own labels did not teach.  Isotonic regression of
the labels on those scores makes probabilities of them.

The fit takes at most ``SAMPLE`` labelled ids of each class, chosen by a hash of
the id, weighted back to the true share of the classes; every document is
scored.  Labels, language and source never enter a score: only the text does.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.llm.common import fold_of, written

SAMPLE = 20_000
FOURIER = 256
PARTS = 4
FIT_TASKS = 8
#: Steps of the raw score between -1 and 2 that the isotonic fit tells apart.
STEPS = 3000
#: Penalties tried, as shares of the rows' total weight.
PENALTIES = (1e-6, 1e-5, 1e-4, 1e-3, 1e-2)

STATISTICS = (
    "log_words", "word_length", "distinct_words", "distinct_pairs", "top_word", "same_as_last",
    "short_words", "upper", "digits", "spaces", "sentence_ends", "commas", "exclamations",
    "symbols", "bars", "brackets_quotes", "other_ascii", "beyond_ascii", "log_lines",
    "line_words", "repeated_lines", "letter_entropy",
)


def _bytes(characters: str) -> np.ndarray:
    return np.frombuffer(characters.encode(), np.uint8)


UPPER = np.arange(65, 91)
LOWER = np.arange(97, 123)
DIGITS = np.arange(48, 58)
SPACES = _bytes(" \t\n\x0b\x0c\r")
CLASSES = (UPPER, DIGITS, SPACES, _bytes(".?"), _bytes(",;:"), _bytes("!"), _bytes("#$%&*"),
           _bytes("|"), _bytes("()[]{}<>\"'"), _bytes("+-/=@\\^_`~"), np.arange(128, 256))


def statistics(text: bytes) -> list[float]:
    """The statistics of a text in UTF-8; all 0 for an empty one."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    held = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    n_words = len(words)
    found = Counter(words)
    some = max(n_words, 1)
    follow = max(n_words - 1, 1)
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = held[LOWER] + held[UPPER]
    shares = letters[letters > 0] / max(letters.sum(), 1)
    upper, digits, spaces, *others = (held[c].sum() / n for c in CLASSES)
    return [
        float(np.log1p(n_words)),
        min((n - spaces * n) / some, 40.0),
        len(found) / some,
        len(set(zip(words, words[1:], strict=False))) / follow,
        max(found.values(), default=0) / some,
        sum(map(eq, words, words[1:])) / follow,
        sum(c for w, c in found.items() if len(w) <= 3) / some,
        upper, digits, spaces, *others,
        float(np.log1p(len(lines))),
        float(np.log1p(n_words / max(len(lines), 1))),
        (len(lines) - len(set(lines))) / max(len(lines), 1),
        float(-(shares * np.log(shares)).sum()),
    ]


def directions(seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and phases: the features' inner products approximate
    exp(-|x - y|^2 / (2 * d)) for vectors of d statistics."""
    random = np.random.default_rng(seed)
    d = len(STATISTICS)
    return (random.normal(size=(d, FOURIER)) / np.sqrt(d),
            random.uniform(0, 2 * np.pi, FOURIER))


def fourier(x: np.ndarray, frequencies: np.ndarray, phases: np.ndarray) -> np.ndarray:
    """The random Fourier features of the rows of ``x`` and a constant one."""
    z = np.sqrt(2 / FOURIER) * np.cos(x @ frequencies + phases)
    return np.hstack([z, np.ones((len(z), 1))])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing fit of ``y`` over ascending ``x`` by pooling adjacent
    violators: each pool's mean place and value."""
    pools: list[list[float]] = []                   # weight, sum of x, sum of y
    for a, b, w in zip(x, y, weight, strict=True):
        pools.append([w, w * a, w * b])
        while len(pools) > 1 and pools[-2][2] * pools[-1][0] >= pools[-1][2] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    w, sx, sy = np.array(pools).T
    return sx / w, sy / w


@dataclass
class Model:
    """Standardisation, Fourier directions, ridge weights and calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = fourier(_standard(x, self.mean, self.scale), *directions())
        return np.interp(z @ self.weights, self.places, self.values)


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -3, 3)


def _matrix(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    flat = np.frombuffer(b"".join(batch.column(column).to_pylist()), np.float64)
    return flat.reshape(-1, width)


def with_statistics(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with the statistics of ``text_col`` (null: empty) in its place, as
    the bytes of float64 in the column ``__statistics``."""
    kept = [c for c in rows.columns if c != text_col]
    source = rows.select(*kept, F.col(text_col).cast("string").cast("binary").alias("__statistics"))

    def run(batches):
        for batch in batches:
            made = [np.array(statistics(t or b"")).tobytes()
                    for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(made, pa.binary())], names=batch.schema.names)

    return source.mapInArrow(run, source.schema)


def normal_sums(batches, mean: np.ndarray, scale: np.ndarray):
    """One row for each part of the labelled rows of a task: the sums of z z', z y
    and y y by weight, as the bytes of one array."""
    width = FOURIER + 1
    sums = np.zeros((PARTS, width + 1, width + 1))
    for batch in batches:
        x = _standard(_matrix(batch, "__statistics", len(STATISTICS)), mean, scale)
        y = np.array(batch.column("label").to_pylist(), float)
        weight = np.array(batch.column("weight").to_pylist(), float)
        part = np.array(batch.column("part").to_pylist())
        z = np.hstack([fourier(x, *directions()), y[:, None]])
        for k in range(PARTS):
            own = z[part == k]
            sums[k] += own.T @ (own * weight[part == k][:, None])
    yield pa.RecordBatch.from_pydict({
        "part": pa.array(range(PARTS), pa.int32()),
        "sums": pa.array([s.tobytes() for s in sums], pa.binary())})


def solve(sums: np.ndarray, penalty: float) -> np.ndarray:
    """Ridge weights of summed normal equations; the constant is not penalised."""
    a, b = sums[:-1, :-1], sums[:-1, -1]
    ridge = np.eye(len(b)) * penalty * sums[-2, -2]
    ridge[-1, -1] = 1e-9
    return np.linalg.solve(a + ridge, b)


def _constant(value: float) -> Model:
    d = len(STATISTICS)
    return Model(np.zeros(d), np.ones(d), np.zeros(FOURIER + 1), np.zeros(1), np.array([value]))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", label_col: str = "quality",
                training: F.Column | None = None, sample: int = SAMPLE) -> Model:
    """The classifier of the rows of ``docs`` that ``labels`` marks 0 or 1 and for
    whose ``id`` the condition ``training`` holds.  Rows with a null id or label
    are left out; a repeated label row counts once; an id with both labels
    teaches both; each row of a repeated document id teaches.  With a class
    missing every score is 1/2, or the only class there is."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    if training is not None:
        marked = marked.where(training)
    marked = marked.where("id is not null and label in (0, 1)").distinct()
    totals = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(totals) < 2:
        return _constant(float(next(iter(totals), 0.5)))
    order = F.xxhash64("id")
    chosen = [marked.where(F.col("label") == c).orderBy(order, "id").limit(sample)
              .withColumn("weight", F.lit(max(1.0, totals[c] / sample))) for c in (0, 1)]
    # at most 2 * sample rows of three numbers: a bounded broadcast
    chosen = chosen[0].unionAll(chosen[1]).withColumn(
        "part", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(PARTS)).cast("int"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("__text")).join(
        F.broadcast(chosen), "id").select("label", "weight", "part", "__text")
    rows = written(with_statistics(texts, "__text"), "quality-statistics")
    mean, scale = _moments(rows)
    if mean is None:
        return _constant(0.5)
    parts = rows.coalesce(FIT_TASKS)
    sums = np.zeros((PARTS, FOURIER + 2, FOURIER + 2))
    for r in parts.mapInArrow(lambda b: normal_sums(b, mean, scale),
                              "part int, sums binary").collect():  # FIT_TASKS * PARTS rows
        sums[r["part"]] += np.frombuffer(r["sums"]).reshape(sums[0].shape)
    whole = sums.sum(0)

    def missed(penalty: float) -> float:
        """Squared error on each part of the weights that the others give."""
        total = 0.0
        for own in sums:
            w = np.append(-solve(whole - own, penalty), 1.0)
            total += w @ own @ w
        return total

    usable = all((whole - own)[-2, -2] > 0 for own in sums)
    penalty = min(PENALTIES, key=missed) if usable else PENALTIES[-1]
    others = np.array([solve(whole - own if usable else whole, penalty) for own in sums])
    places, values = _calibration(parts, mean, scale, others)
    return Model(mean, scale, solve(whole, penalty), places, values)


def _moments(rows: DataFrame):
    """Weighted mean and deviation of the statistics over the labelled rows."""
    width = len(STATISTICS)

    def run(batches):
        total = np.zeros((3, width))
        for batch in batches:
            x = _matrix(batch, "__statistics", width)
            w = np.array(batch.column("weight").to_pylist(), float)[:, None]
            total += [np.full(width, w.sum()), (w * x).sum(0), (w * x * x).sum(0)]
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})

    found = rows.select("weight", "__statistics").coalesce(FIT_TASKS).mapInArrow(
        run, "total binary").collect()                               # FIT_TASKS rows
    n, s, squares = np.sum([np.frombuffer(r["total"]).reshape(3, -1) for r in found], axis=0) \
        if found else np.zeros((3, width))
    if not n.any():
        return None, None
    mean = s / n
    deviation = np.sqrt(np.maximum(squares / n - mean ** 2, 0))
    return mean, np.where(deviation > 1e-9, deviation, 1.0)


def _calibration(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, others: np.ndarray):
    """The isotonic fit of the labels on scores by the weights without their part:
    rows are summed by step of the score, so ``STEPS`` sums reach the driver."""
    def run(batches):
        held = np.zeros((2, STEPS))
        for batch in batches:
            x = _standard(_matrix(batch, "__statistics", len(STATISTICS)), mean, scale)
            part = np.array(batch.column("part").to_pylist())
            y = np.array(batch.column("label").to_pylist(), float)
            weight = np.array(batch.column("weight").to_pylist(), float)
            raw = (fourier(x, *directions()) * others[part]).sum(1)
            step = np.clip((raw + 1) * STEPS / 3, 0, STEPS - 1).astype(int)
            held += [np.bincount(step, weight, STEPS), np.bincount(step, weight * y, STEPS)]
        yield pa.RecordBatch.from_pydict({"held": pa.array([held.tobytes()], pa.binary())})

    held = np.sum([np.frombuffer(r["held"]).reshape(2, -1)
                   for r in rows.mapInArrow(run, "held binary").collect()], axis=0)
    at = np.flatnonzero(held[0])
    return isotonic(-1 + (at + 0.5) * 3 / STEPS, held[1][at] / held[0][at], held[0][at])


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id",
                  text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the ``carry`` columns and ``score`` (0 to 1, higher: better) for
    each row of ``docs``; a null text is scored as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(id_col, *carry, F.col(text_col).cast("string").cast("binary").alias("__text"))

    def run(batches):
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array([statistics(t or b"")
                          for t in batch.column(batch.num_columns - 1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(model.score(x), pa.float64())],
                names=[*batch.schema.names[:-1], "__score"])

    out = kept.drop("__text").withColumn("__score", F.lit(0.0)).schema
    return kept.mapInArrow(run, out).withColumnRenamed("__score", "score")


def held_out(key: F.Column) -> F.Column:
    """Whether a row belongs to the fold that no model learns from."""
    return F.coalesce(fold_of(key, 5) == 0, F.lit(False))
