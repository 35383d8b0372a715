"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes
log-count ratios.

Labelled rows of the training folds give, for each hashed n-gram, the number of
toxic and of other documents that hold it; the log ratio of the two smoothed
shares scales the feature.  A logistic regression over the scaled presence of
the most telling n-grams is trained on the same rows, and every document is
scored by it.

The classifier is fitted on at most ``SAMPLE`` labelled rows of each class,
chosen by a hash of the id, so what the fit gathers is bounded however large
the tables are; every document is scored.  Labels, language and source never
enter a score: only the text does.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.llm.common import fold_of, let_go, map_batches

SAMPLE = 6000
ORDERS = (3, 4, 5)
BITS = 20
FEATURES = 2048
FIT_TASKS = 8
#: Characters hashed at a time, to bound the memory for a very long text.
STRIDE = 1 << 20


def ngrams(text: str) -> np.ndarray:
    """The hashed n-grams of a text, lower-cased and with a space at either end
    (with repeats)."""
    made = []
    text = f" {text.lower()} "
    for at in range(0, len(text), STRIDE):
        part = text[at:at + STRIDE + max(ORDERS) - 1]
        points = np.frombuffer(part.encode("utf-32-le"), "<u4")
        h = points
        for n in range(2, max(ORDERS) + 1):
            h = h[:-1] * np.uint32(0x01000193) + points[n - 1:]
            if n in ORDERS:
                last = len(h) if at + STRIDE >= len(text) else min(len(h), STRIDE)
                mixed = h[:last] ^ (h[:last] >> np.uint32(15))
                mixed = mixed * np.uint32(0x2C1B3C6D) + np.uint32(n)
                made.append((mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    return np.concatenate(made)


@dataclass
class Model:
    """``bins`` are the features, sorted; ``weights`` already hold the ratios."""

    bins: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        table = np.zeros(1 << BITS, np.float32)
        table[self.bins] = self.weights
        used = table != 0

        def score(text: str) -> float:
            grams = ngrams(text)
            z = self.bias + float(table[np.unique(grams[used[grams]])].sum(dtype=np.float64))
            return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))

        return score


def _counts(batches):
    """One row: how many toxic and other documents hold each hashed n-gram."""
    let_go()
    held = np.zeros((2, 1 << BITS), np.int32)
    n = [0, 0]
    for batch in batches:
        for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held[toxic][np.unique(ngrams(text or ""))] += 1
            n[toxic] += 1
    yield pa.RecordBatch.from_pydict(
        {"held": pa.array([zlib.compress(held.tobytes(), 1)], pa.binary()),
         "other": pa.array([n[0]], pa.int64()), "toxic": pa.array([n[1]], pa.int64())})


def _regress(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray,
             offset: float, steps: int = 300, penalty: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic regression over sparse rows of feature numbers, full batches with
    Nesterov's momentum; ``offset`` moves the bias to the true share of labels."""
    sizes = np.array([len(r) for r in rows])
    owner, feature = np.repeat(np.arange(len(rows)), sizes), np.concatenate(rows)
    value = ratio[feature]
    n, k = len(rows), len(ratio)
    lipschitz = 0.25 * max(1.0, float(np.bincount(owner, value ** 2, n).mean())) + penalty
    w, b, ahead_w, ahead_b = np.zeros(k), 0.0, np.zeros(k), 0.0
    for step in range(steps):
        z = np.bincount(owner, value * ahead_w[feature], n) + ahead_b
        error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels
        new_w = ahead_w - (np.bincount(feature, value * error[owner], k) / n
                           + penalty * ahead_w) / lipschitz
        new_b = ahead_b - error.mean() / lipschitz
        rate = step / (step + 3)
        ahead_w, ahead_b = new_w + rate * (new_w - w), new_b + rate * (new_b - b)
        w, b = new_w, new_b
    return w, b + offset


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", label_col: str = "toxic",
                 training: F.Column | None = None, sample: int = SAMPLE) -> Model:
    """The classifier of the rows of ``docs`` that ``labels`` marks 0 or 1 and
    for whose id ``training`` holds.  Rows with a null id or label are left out;
    a repeated label row counts once; an id with both labels teaches both.
    With a class missing the model has no features and scores below one half."""
    spark = docs.sparkSession
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    if training is not None:
        marked = marked.where(training)
    marked = marked.where("id is not null and toxic in (0, 1)").distinct()
    totals = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return Model(np.zeros(0, np.int64), np.zeros(0), -1.0)
    order = F.xxhash64("id")
    chosen = (marked.where("toxic = 1").orderBy(order, "id").limit(sample)
              .unionAll(marked.where("toxic = 0").orderBy(order, "id").limit(sample)))
    # at most 2 * sample short rows: a bounded broadcast
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
             .join(F.broadcast(chosen), "id").select("text", "toxic")
             .repartition(FIT_TASKS).persist())
    held, n = np.zeros((2, 1 << BITS)), np.zeros(2)
    schema = "held binary, other long, toxic long"
    for r in texts.mapInArrow(_counts, schema).collect():  # a row for each of FIT_TASKS
        held += np.frombuffer(zlib.decompress(r["held"]), np.int32).reshape(2, -1)
        n += [r["other"], r["toxic"]]
    share = (held + 1) / (n[:, None] + 2)
    ratio = np.log(share[1] / share[0])
    telling = np.abs(ratio) * np.abs(share[1] - share[0])
    telling[held.sum(0) < 3] = 0
    bins = np.sort(np.argsort(-telling, kind="stable")[:FEATURES])
    bins = bins[telling[bins] > 0]

    def start():
        number = np.full(1 << BITS, -1, np.int32)
        number[bins] = np.arange(len(bins))

        def step(some: list, toxic: list) -> list:
            found = (np.unique(number[ngrams(t or "")]) for t in some)
            return [[f[f >= 0].astype("<i4").tobytes() for f in found], toxic]

        return step

    rows = map_batches(texts, "features binary, toxic int", start).collect()  # 2 * sample at most
    texts.unpersist()
    rows.sort(key=lambda r: (r["toxic"], bytes(r["features"])))
    true = np.log(totals[1] / totals[0])
    y = np.array([r["toxic"] for r in rows], float)
    if not len(bins) or y.min() == y.max():
        return Model(np.zeros(0, np.int64), np.zeros(0), -1.0)
    w, bias = _regress([np.frombuffer(r["features"], "<i4") for r in rows], y, ratio[bins],
                       true - np.log(y.sum() / (1 - y).sum()))
    return Model(bins, w * ratio[bins], bias)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id",
                   text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the ``carry`` columns and ``toxicity`` (0 to 1) for each row of
    ``docs``; a null or empty text is scored as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        score = shared.value.scorer()
        return lambda texts, *rest: [*rest, [score(t or "") for t in texts]]

    source = docs.select(F.col(text_col).cast("string").alias("__text"), id_col, *carry)
    out = source.drop("__text").withColumn("toxicity", F.lit(0.0)).schema
    return map_batches(source, out, start)


def held_out(key: F.Column) -> F.Column:
    """Whether a row belongs to the fold that no model learns from."""
    return F.coalesce(fold_of(key, 5) == 0, F.lit(False))
