"""Document log-likelihood by a gated recurrent language model.

Words belong to classes: the ``HEAD`` most frequent training words form classes
of about equal mass by frequency, all others are the tail class, the end of a
document is a class of its own.  A gated recurrent unit reads the words' vectors
and classes and predicts the next word; the output is factored into the class'
softmax and the word's within its class, which is factored once more, by a Huffman
tree whose every node decides from the state.  A tree starts at the corpus shares.
The words of the tail share ``ENDINGS`` vectors and leaves by their last bytes, and
among those of a leaf the smoothed corpus count decides.

Counts cover every training document, and so do the recurrent weights: one pass
of truncated backpropagation, in numpy, streamed in tasks of about
``TASK_WORDS`` words, whose number grows with the input.  The pass has
``ROUNDS`` rounds over a hashed share of the documents each; after a round the
tasks' changes are averaged by their words, in pieces that are dealt out.  Scoring
carries the state through the whole document.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwright.llm.common import fold_of, map_batches, words, written

HEAD, CLASSES, HIDDEN = 50_000, 24, 16
#: A word's number, head, endings and end of a document, has two bytes.
ENDINGS, EMBED = 1_024, 16
ROUNDS, TASK_WORDS = 4, 1_000_000
WINDOW, RATE = 32, 0.05
#: What a row of the words' vectors and nodes is taken to have seen; weights of a piece.
SEEN, PIECE = 0.1, 1 << 16
#: Words whose paths are followed together, few enough for a cache.
FOLLOWED = 1 << 12
#: Streams of a block of words, few where there are few words; words of a block.
LANES, BLOCK_WORDS = (16, 256), 1 << 18
#: Documents whose words a task holds at a time.
SCORED = 512
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Words(NamedTuple):
    """The class of each word by number, and its path: the nodes from ``start`` on, of
    ``size``, and at each the side (1 or -1) it lies on."""

    group: np.ndarray
    start: np.ndarray
    size: np.ndarray
    node: np.ndarray
    side: np.ndarray


def trees(group: np.ndarray, mass: np.ndarray) -> tuple[Words, np.ndarray]:
    """A Huffman tree for each class, and the log-odds of its nodes by mass."""
    n = len(group)
    up, first, odds = np.full(2 * n, -1), np.zeros(2 * n, bool), []
    for g in np.unique(group):
        heap = [(float(mass[i]), int(i)) for i in np.flatnonzero(group == g)]
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            up[i] = up[j] = new = n + len(odds)
            first[i] = True
            odds.append(np.log(a / b))
            heapq.heappush(heap, (a + b, new))
    owner, at, steps = np.arange(n), np.arange(n), []
    while len(owner):
        above = up[at]
        there = above >= 0
        owner, at, above = owner[there], at[there], above[there]
        steps.append((owner, above - n, np.where(first[at], 1, -1)))
        at = above
    owner, node, side = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.argsort(owner, kind="stable")
    size = np.bincount(owner, minlength=n)
    return Words(group.astype(np.uint8), np.cumsum(size) - size, size,
                 node[order].astype(np.uint16), side[order].astype(np.float32)), \
        np.array(odds, np.float32)


def initial(classes: int, share: np.ndarray, words: int = 0, odds: np.ndarray | None = None
            ) -> dict[str, np.ndarray]:
    """The weights before training; without ``words`` those of the classes alone."""
    r = np.random.Generator(np.random.PCG64(7))
    normal = lambda *s: r.normal(0, 0.1, s).astype(np.float32)
    w = {"x": normal(classes, 3 * HIDDEN), "h": normal(HIDDEN, 3 * HIDDEN),
         "out": normal(HIDDEN, classes) * 0, "bias": np.log(share).astype(np.float32)}
    if words:
        w |= {"in": normal(words, EMBED), "p": normal(EMBED, 3 * HIDDEN),
              "node": np.column_stack([np.zeros((len(odds), HIDDEN)), odds]).astype(np.float32)}
    return w


def inputs(w: dict, words: Words | None, read: np.ndarray) -> np.ndarray:
    """The inputs' part of the gates for the words ``read``, of any shape."""
    if words is None:
        return np.take(w["x"].T, read, axis=1)
    a = np.take(w["x"].T, words.group[read], axis=1)
    return a + (w["p"].T @ w["in"][read.ravel()].T).reshape(a.shape)


def levels(words: Words, wanted: np.ndarray) -> tuple[np.ndarray, Iterator]:
    """The words' order by falling length of their paths, and for each step the nodes and
    the sides of the words, first ones in that order, whose path goes so far."""
    size = words.size[wanted]
    order = np.argsort((255 - size).astype(np.uint8), kind="stable")  # no path is so long
    start, far = words.start[wanted[order]], np.bincount(size, minlength=1)[::-1].cumsum()[::-1]

    def steps() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k, n in enumerate(far[1:].tolist()):
            at = start[:n] + k
            yield words.node[at].astype(np.intp), words.side[at]

    return order, steps()


def within(w: dict, words: Words, wanted: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The log-probability of each word within its class after the state ``h`` (a row each)."""
    out = np.zeros(len(wanted), np.float32)
    for k in range(0, len(wanted), FOLLOWED):
        order, steps = levels(words, wanted[k:k + FOLLOWED])
        state, own = _with_one(h[k + order]), np.zeros(len(order), np.float32)
        for node, side in steps:
            n = len(node)
            z = np.einsum("ij,ij->i", np.take(w["node"], node, axis=0), state[:n]) * side
            own[:n] += np.minimum(z, 0) - np.log(1 + np.exp(-np.abs(z)))
        out[k + order] = own
    return out


def within_gradient(w: dict, words: Words, wanted: np.ndarray, h: np.ndarray):
    """Of the negative of :func:`within`: for the states, and for the nodes met."""
    back = np.zeros((len(wanted), HIDDEN), np.float32)
    nodes, owners, slopes = [], [], []
    for k in range(0, len(wanted), FOLLOWED):
        order, steps = levels(words, wanted[k:k + FOLLOWED])
        state = _with_one(h[k + order])
        own = np.zeros_like(state)
        for node, side in steps:
            n = len(node)
            weights = np.take(w["node"], node, axis=0)
            z = np.einsum("ij,ij->i", weights, state[:n]) * side
            with np.errstate(over="ignore"):
                g = -side / (1 + np.exp(z))
            weights *= g[:, None]
            own[:n] += weights
            nodes.append(node)
            owners.append(k + order[:n])
            slopes.append(g)
        back[k + order] = own[:, :HIDDEN]
    if not nodes:
        return back, None
    owner, slope = np.concatenate(owners), np.concatenate(slopes)
    return back, by_row(np.concatenate(nodes), (slope * np.take(x, owner) for x in
                                                np.ascontiguousarray(_with_one(h).T)))


def _with_one(h: np.ndarray) -> np.ndarray:
    return np.column_stack([h, np.ones(len(h), h.dtype)])


def by_row(rows: np.ndarray, columns) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of ``rows`` (16 bits), and for each the sums of the columns."""
    there, place = np.zeros(1 << 16, bool), np.empty(1 << 16, np.intp)
    there[rows] = True
    found = np.flatnonzero(there)
    place[found] = np.arange(len(found))
    at = place[rows]
    return found, np.stack([np.bincount(at, x, len(found)) for x in columns], 1).astype(np.float32)


def forward(w: dict, a: np.ndarray, h: np.ndarray):
    """One step of (unit, lane) arrays from the inputs' part ``a`` of the gates:
    the new state and the gates (for the way back)."""
    b = w["h"].T @ h
    with np.errstate(over="ignore"):
        zr = 1 / (1 + np.exp(-(a[:2 * HIDDEN] + b[:2 * HIDDEN])))
    z, r, hc = zr[:HIDDEN], zr[HIDDEN:], b[2 * HIDDEN:]
    c = np.tanh(a[2 * HIDDEN:] + r * hc)
    return h + z * (c - h), (z, r, c, hc)


def placed(texts: list[str], head: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For each word of the texts the number of its text and its place in ``head``
    (-1: not there), and the words.  Arrow splits at ASCII white space."""
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)  # white space at an end leaves an empty part
    flat = flat.filter(real)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    place = pc.fill_null(pc.index_in(flat, value_set=head), -1)
    return owner[real.to_numpy(zero_copy_only=False)], place.to_numpy(), flat


def log_softmax(w: dict, h: np.ndarray) -> np.ndarray:
    s = w["out"].T @ h + w["bias"][:, None]
    s -= s.max(axis=0)
    return s - np.log(np.exp(s).sum(axis=0))


def blocks(docs: Iterator[np.ndarray], end: int) -> Iterator[np.ndarray]:
    """The documents joined to one stream, an end before each and after the last,
    in blocks that share one word, so that each word is predicted once."""
    held, n = [np.array([end])], 1
    for d in docs:
        for at in range(0, len(d) + 1, BLOCK_WORDS):
            some = d[at:at + BLOCK_WORDS]
            held.append(some if at + BLOCK_WORDS <= len(d) else np.append(some, end))
            n += len(held[-1])
            if n > BLOCK_WORDS:
                yield (whole := np.concatenate(held))
                held, n = [whole[-1:]], 1
    if n > 1:
        yield np.concatenate(held)


def train(w: dict, docs: Iterator[np.ndarray], end: int, words: Words | None = None
          ) -> tuple[dict, int]:
    """The weights after one pass and the number of words predicted in it, ends
    included.  Adagrad over windows of ``WINDOW`` steps; within a block the state
    goes on from window to window, the gradient doesn't."""
    w = {k: v.copy() for k, v in w.items()}
    seen = {k: np.full_like(v, SEEN if k in ("in", "node") else 1e-6) for k, v in w.items()}
    learned = 0
    for block in blocks(docs, end):
        n = len(block) - 1
        learned += n
        lanes = min(n, max(LANES[0], min(LANES[1], n // (4 * WINDOW))))
        steps = -(-n // lanes)
        padded = np.full((2, lanes * steps), end)
        padded[0, :n], padded[1, :n] = block[:-1], block[1:]
        read, wanted = padded.reshape(2, lanes, steps).transpose(0, 2, 1)
        real = (np.arange(lanes * steps) < n).reshape(lanes, steps).T
        h = np.zeros((HIDDEN, lanes), np.float32)
        for at in range(0, steps, WINDOW):
            cut = slice(at, at + WINDOW)
            h = _window(w, seen, read[cut], wanted[cut], real[cut], h, words)
    return w, learned


def _window(w: dict, seen: dict, read: np.ndarray, wanted: np.ndarray, real: np.ndarray,
            h: np.ndarray, words: Words | None) -> np.ndarray:
    """One step of Adagrad over (step, lane) arrays; the state at its end.  Words
    that aren't ``real`` fill the last lanes and count for nothing."""
    steps, lanes = read.shape
    a = inputs(w, words, read)
    states, gates = np.empty((HIDDEN, steps + 1, lanes), np.float32), []
    states[:, 0] = h
    for t in range(steps):
        h, g = forward(w, a[:, t], h)
        states[:, t + 1] = h
        gates.append(g)
    new = states[:, 1:].reshape(HIDDEN, -1)
    d = np.exp(log_softmax(w, new))
    each = np.arange(steps * lanes)
    kind = (lambda x: x) if words is None else words.group.__getitem__
    d[kind(wanted).ravel(), each] -= 1
    d *= real.ravel()
    grad = {"out": new @ d.T, "bias": d.sum(1)}
    from_out = w["out"] @ d
    rows = {}
    if words is not None:
        predicted = slice(None) if real.all() else np.flatnonzero(real)
        to_state, rows["node"] = within_gradient(w, words, wanted.ravel()[predicted],
                                                 np.ascontiguousarray(new.T[predicted]))
        from_out[:, predicted] += to_state.T
    from_out = from_out.reshape(HIDDEN, steps, lanes)
    to_x = np.empty((3 * HIDDEN, steps, lanes), np.float32)
    to_h = np.empty_like(to_x)
    back = np.zeros_like(h)
    for t in range(steps - 1, -1, -1):
        old, (z, r, c, hc) = states[:, t], gates[t]
        dh = from_out[:, t] + back
        dc = dh * z
        dz = dc * (c - old) * (1 - z)
        dc *= 1 - c * c
        inner = np.concatenate([dz, dc * hc * r * (1 - r), dc * r])
        to_h[:, t] = inner
        to_x[:2 * HIDDEN, t] = inner[:2 * HIDDEN]
        to_x[2 * HIDDEN:, t] = dc
        back = dh - dh * z + w["h"] @ inner
    marks = np.zeros(d.shape, np.float32)
    marks[kind(read).ravel(), each] = 1
    flat_x = to_x.reshape(3 * HIDDEN, -1)
    grad["x"] = marks @ flat_x.T
    grad["h"] = states[:, :-1].reshape(HIDDEN, -1) @ to_h.reshape(3 * HIDDEN, -1).T
    if words is not None:
        grad["p"] = w["in"][read.ravel()].T @ flat_x.T
        rows["in"] = by_row(read.ravel(), w["p"] @ flat_x)
    for k, g in grad.items():
        g = np.clip(g / lanes, -5, 5)
        seen[k] += g * g
        w[k] -= RATE * g / np.sqrt(seen[k])
    for k, (at, g) in ((k, x) for k, x in rows.items() if x is not None):
        now = np.take(seen[k], at, axis=0)
        now += g * g
        seen[k][at] = now
        w[k][at] = np.take(w[k], at, axis=0) - RATE * g / np.sqrt(now)
    return h


def fit(sequences: DataFrame, w: dict, end: int, n: int, words: Words | None = None
        ) -> tuple[dict, int]:
    """The weights after ``ROUNDS`` rounds over the rows of ``sequences`` (part, ids: two
    bytes for each word, without ``words`` one for each class), ``n`` words in all, and
    the words learned from."""
    spark, kind = sequences.sparkSession, np.uint8 if words is None else np.uint16
    learned, tasks = 0, max(1, round(n / ROUNDS / TASK_WORDS))
    table = spark.sparkContext.broadcast(words)
    flat = lambda w: np.concatenate([x.ravel() for x in w.values()])
    pieces = range(0, sum(x.size for x in w.values()), PIECE)
    for part in range(ROUNDS):
        given = spark.sparkContext.broadcast(w)

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            docs = (np.frombuffer(x.as_py(), kind) for b in batches for x in b.column(0))
            made, count = train(given.value, docs, end, table.value)
            change = (flat(made) - flat(given.value)).astype(np.float16)
            for at in pieces if count else ():
                yield _piece(at, change[at:at + PIECE], count)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts = {}, {}
            for b in batches:
                for at, w, count in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    sums[at] = sums.get(at, 0) + np.frombuffer(w, np.float16).astype(float) * count
                    counts[at] = counts.get(at, 0) + count
            for at, x in sums.items():
                yield _piece(at, (x / counts[at]).astype(np.float32), counts[at])

        shape = "at int, w binary, n long"
        rows = sorted(sequences.where(F.col("part") == part).select("ids").repartition(tasks)
                      .mapInArrow(run, shape).repartition(min(tasks, len(pieces)), "at")
                      .mapInArrow(add, shape).collect())  # the weights once, in pieces
        if rows:
            learned += rows[0]["n"]
            made = flat(w) + np.concatenate([np.frombuffer(r["w"], np.float32) for r in rows])
            ends = np.cumsum([x.size for x in w.values()])[:-1]
            w = {k: x.reshape(w[k].shape) for k, x in zip(w, np.split(made, ends), strict=True)}
    return w, learned


def likelihoods(w: dict, docs: list[np.ndarray], end: int, words: Words | None = None
                ) -> list[float]:
    """The natural log-probability of each document's words with its end.  All
    documents go on side by side, ``WINDOW`` steps at a time, until they end."""
    order = np.array(sorted(range(len(docs)), key=lambda i: -len(docs[i])), int)
    sizes = np.array([len(docs[i]) + 1 for i in order], int)
    stop = np.array([end], np.uint16)
    flat = np.concatenate([stop, *(x for i in order for x in (docs[i], stop))]).astype(np.uint16)
    starts = np.cumsum(sizes) - sizes + 1
    total, h = np.zeros(len(docs)), np.zeros((HIDDEN, len(docs)), np.float32)
    held, n_held = [], 0  # words, states and documents whose paths are still to follow
    for at in range(0, sizes.max(initial=0), WINDOW):
        n = int(np.searchsorted(-sizes, -at, side="left"))  # documents longer than at
        step = np.arange(at, min(at + WINDOW, sizes[0]))[:, None]
        place = np.minimum(starts[:n] + step, len(flat) - 1)
        a = inputs(w, words, flat[place - 1])
        h, states = h[:, :n], np.empty((HIDDEN, len(step), n), np.float32)
        for t in range(len(step)):
            h, _ = forward(w, a[:, t], h)
            states[:, t] = h
        s = w["out"].T @ states.reshape(HIDDEN, -1) + w["bias"][:, None]
        s -= s.max(axis=0)
        wanted = flat[place].ravel()
        own = s[wanted if words is None else words.group[wanted], np.arange(place.size)]
        own = own - np.log(np.exp(s, out=s).sum(axis=0))
        real = step < sizes[:n]
        if words is not None:
            some = np.flatnonzero(real)
            held.append((wanted[some], states.reshape(HIDDEN, -1).T[some], some % n))
            n_held += len(some)
            if n_held >= 4 * FOLLOWED or at + WINDOW >= sizes[0]:
                predicted, state, doc = map(np.concatenate, zip(*held, strict=True))
                total += np.bincount(doc, within(w, words, predicted, state), len(docs))
                held, n_held = [], 0
        total[:n] += np.where(real, own.reshape(place.shape), 0).sum(axis=0, dtype=float)
    out = np.empty(len(docs))
    out[order] = total
    return out.tolist()


def _each(values: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
    """The values of each of ``n`` texts."""
    ends = np.searchsorted(owner, np.arange(n + 1)).tolist()
    return [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _piece(at: int, w: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "at": pa.array([at], pa.int32()), "w": pa.array([w.tobytes()], pa.binary()),
        "n": pa.array([n], pa.int64())})


def endings(words: pa.Array) -> np.ndarray:
    """The leaf of each word of the tail, by its last three bytes."""
    words = words.cast(pa.large_binary())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:][:len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    key = np.zeros(len(words), np.uint32)
    for back in (1, 2, 3):
        place = at[1:] - back
        there = place >= at[:-1]
        key *= np.uint32(257)
        key[there] += data[place[there]] + np.uint32(1)
    return ((key * np.uint32(2654435761)) >> np.uint32(16)).astype(int) % ENDINGS


def numbered(place: np.ndarray, flat: pa.Array, head: int) -> np.ndarray:
    """Each word's number: its place among the ``head`` words or, behind them, its leaf."""
    other = place < 0
    number = place.astype(np.uint16)
    number[other] = head + endings(flat.filter(pa.array(other)))
    return number


def _leaves(counts: DataFrame, head: list) -> tuple[np.ndarray, np.ndarray]:
    """The occurrences and the number of the words behind the head at each leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, ENDINGS), np.int64)
        for b in batches:
            if b.num_rows:
                leaf = endings(b.column(0))
                np.add.at(sums[0], leaf, b.column(1).to_numpy())
                sums[1] += np.bincount(leaf, minlength=ENDINGS)
        yield pa.RecordBatch.from_pydict({"leaf": pa.array(range(ENDINGS), pa.int32()),
                                          "c": pa.array(sums[0]), "n": pa.array(sums[1])})

    found = np.zeros((2, ENDINGS), np.int64)
    for r in counts.select("word", "c").mapInArrow(run, "leaf int, c long, n long").groupBy(
            "leaf").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect():  # a row a leaf
        found[:, r["leaf"]] = r["c"], r["n"]
    leaf = endings(pa.array([r["word"] for r in head], pa.large_string()))
    np.subtract.at(found[0], leaf, [r["c"] for r in head])
    np.subtract.at(found[1], leaf, 1)
    return found[0], found[1]


def score_documents(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text"
                    ) -> DataFrame:
    """For each row: ``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (smoothed unigrams) and ``score``, both log10.

    A null text is empty: its only token is the end.  ``training`` is a condition
    on the rows to learn from; a null one counts as false.  Without training
    rows all words are unknown.  Rows alike in id and text score alike."""
    spark = docs.sparkSession
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, UPPER.lower())
    rows = docs.select(F.col(id_col), text.alias("__text"),
                       F.coalesce(training, F.lit(False)).alias("__train"))
    learn = rows.where("__train")
    counts = written(learn.select(F.explode(words(F.col("__text"))).alias("word")).groupBy("word")
                     .agg(F.count(F.lit(1)).alias("c")), "lm-counts")
    ends = learn.count()
    sums = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n, v = (sums[0] or 0) + ends, sums[1] + (ends > 0)
    head = counts.orderBy(F.desc("c"), "word").limit(HEAD).collect()  # at most HEAD words
    mass = np.cumsum([r["c"] for r in head]) if head else np.zeros(0)
    group = np.minimum((mass - 1) * CLASSES // max(1, mass[-1] if len(mass) else 1), CLASSES - 1)
    tail, end, classes = CLASSES, CLASSES + 1, CLASSES + 2
    weight = np.full(classes, 0.1)
    for r, g in zip(head, group, strict=True):
        weight[int(g)] += r["c"]
    rare = n - ends - sum(r["c"] for r in head)
    weight[tail] += rare
    weight[end] += ends
    # a leaf's mass: its words' smoothed counts and one unknown word
    occurrences, distinct = _leaves(counts, head)
    leaf_mass = occurrences + 0.1 * (distinct + 1)
    # numbers: the head, the leaves of the tail, the end
    c, first, stop = np.array([r["c"] for r in head], float), len(head), len(head) + ENDINGS
    table, odds = trees(np.concatenate([group, np.full(ENDINGS, tail), [end]]).astype(int),
                        np.concatenate([c, leaf_mass, [ends + 0.1]]))
    # of each word of the head, and last of any other: log10 of the smoothed count; of each
    # number what a word's share at its leaf is divided by
    shared = spark.sparkContext.broadcast((
        [r["word"] for r in head], np.append(np.log10(c + 0.1), 0),
        np.concatenate([np.zeros(first), -np.log10(leaf_mass), [0]])))

    def sequence():
        known, *_ = shared.value
        known = pa.array(known, pa.large_string())

        def step(parts: list, texts: list) -> Iterator[list]:
            for at in range(0, len(texts), SCORED):
                some = texts[at:at + SCORED]
                owner, place, flat = placed(some, known)
                yield [parts[at:at + SCORED],
                       [x.tobytes() for x in _each(numbered(place, flat, first), owner, len(some))]]

        return step

    w = initial(classes, weight / weight.sum(), stop + 1, odds)
    if ends:
        part = F.pmod(F.xxhash64(id_col, "__text"), F.lit(ROUNDS)).cast("int")
        sequences = written(map_batches(learn.select(part, "__text"), "part int, ids binary",
                                        sequence), "lm-sequences")
        w, _ = fit(sequences, w, stop, n, table)
    model = spark.sparkContext.broadcast((w, table))
    floor = float(np.log10(n + 0.1 * (v + 1))) if n else 0.0

    def score():
        known, logs, shares = shared.value
        known = pa.array(known, pa.large_string())

        def step(ids: list, texts: list) -> list:
            out, held = [ids, [], [], [], [], []], []
            for at in range(0, len(ids), SCORED):
                some = texts[at:at + SCORED]
                owner, place, flat = placed(some, known)
                number = numbered(place, flat, first)
                held += _each(number, owner, len(some))
                each = lambda x, owner=owner, n=len(some): np.bincount(owner, x, n)
                out[1] += (np.bincount(owner, minlength=len(some)) + 1).tolist()
                out[2] += (each(place >= 0) + (ends > 0)).astype(int).tolist()
                out[3] += (each(logs[place]) + np.log10(ends + 0.1)).tolist()
                out[4] += each(shares[number]).tolist()
                rest: list[dict[str, int]] = [{} for _ in some]
                other = place < 0
                for i, x in zip(owner[other].tolist(), flat.filter(pa.array(other)).to_pylist(),
                                strict=True):
                    rest[i][x] = rest[i].get(x, 0) + 1
                out[5] += [list(r.items()) for r in rest]
            likes = likelihoods(model.value[0], held, stop, model.value[1])
            out[4] = [like / np.log(10) + x for like, x in zip(likes, out[4], strict=True)]
            return out

        return step

    kind = rows.schema[0].dataType.simpleString()
    scored = written(map_batches(
        rows.select(id_col, "__text"),
        f"`{id_col}` {kind}, n long, known long, base double, model double, "
        "rest array<struct<word:string,tf:int>>", score)
        .withColumn("key", F.xxhash64("n", "base", "rest")), "lm-scored")
    each = scored.select(id_col, "key", F.explode("rest").alias("r")).select(
        F.col(id_col).alias("__id"), F.col("key").alias("__key"), "r.word", "r.tf")
    c = F.coalesce("c", F.lit(0))
    extra = (each.join(counts, "word", "left").groupBy("__id", "__key").agg(
        F.sum(F.col("tf") * F.log10(c + 0.1)).alias("logs"),
        F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("seen")))
    copies = scored.groupBy(F.col(id_col).alias("__i"), F.col("key").alias("__k")).agg(
        F.count(F.lit(1)).alias("copies"))
    extra = extra.join(copies, F.col("__id").eqNullSafe(F.col("__i"))
                       & (F.col("__key") == F.col("__k")))
    logs, seen = (F.coalesce(F.col(x) / F.col("copies"), F.lit(0.0)) for x in ("logs", "seen"))
    return scored.join(extra, F.col(id_col).eqNullSafe(F.col("__id"))
                       & (F.col("key") == F.col("__key")), "left").select(
        id_col, F.col("n").alias("n_tokens"), (F.col("known") + seen.cast("long")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n") * F.lit(floor)).alias("base_score"),
        (F.col("model") + logs).alias("score"))


def held_out(key):
    """Whether a row belongs to the fold that no model learns from."""
    return F.coalesce(fold_of(key, 10) == 0, F.lit(False))
