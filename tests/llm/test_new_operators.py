"""Filter audit, collocations and kernel quality against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from starwright.llm import collocations, filter_audit, kernel_quality

DOCS = "doc_id long, text string, lang string, label string, mask int, phrase string, id long"
LABELS = "doc_id long, quality int, toxic int, text string"


def make_docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "p", 9) for r in rows], DOCS)


def brute_audit(rows, labels):
    first = {}
    for key, text, _ in rows:
        if key is not None:
            first[text or ""] = min(first.get(text or "", key), key)
    good = {x[0] for x in labels if x[1] == 1 and x[0] is not None}
    toxic = {x[0] for x in labels if x[2] == 1 and x[0] is not None}
    made = []
    for key, text, lang in rows:
        text = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": text in first and (key is None or key > first[text])}
        made.append((lang or "", fails, key in good, key in toxic))
    out = {}
    for part in {m[0] for m in made}:
        own = [m for m in made if m[0] == part]
        removed = {}
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = order[:step - 1]
                still = [m for m in own if not any(m[1][x] for x in before)]
                gone = [m for m in still if m[1][f]]
                removed[order, f] = len(gone)
                out[part, "".join(order), step] = (
                    len(still) - len(gone), len(gone),
                    sum(m[1][f] for m in own) - len(gone),
                    sum(m[1][f] and sum(m[1].values()) == 1 for m in own),
                    sum(m[2] for m in gone), sum(m[3] for m in gone))
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step] += (
                    sum(n for (_, x), n in removed.items() if x == f),)
    return out


LONG = " ".join(f"word{i}" for i in range(300))
TEXTS = ["", " \n", "Ünïcode ÄÖ Å", "SHOUTING words # here", "a a a a b", LONG, LONG + " more",
         LONG[:-1], "a " * 400, LONG.upper(), None, "x" * 300_000]


def audit_rows(seed):
    r = random.Random(seed)
    return [(r.choice([None, *range(25)]), r.choice(TEXTS), r.choice(["en", "", None, "de"]))
            for _ in range(200)]


@pytest.mark.parametrize("limit", [filter_audit.RANGE_BYTES, 600])
def test_audit_equals_brute_force(spark, limit):
    """A small limit deepens the prefixes; ids repeat, texts tie, columns clash."""
    rows = audit_rows(3)
    labels = [(1, 1, 0, "t"), (1, 1, 0, "t"), (2, 0, 1, "t"), (3, None, 1, "t"), (None, 1, 1, "t"),
              (4, 1, 1, None), (4, 0, 0, None)]
    masks = filter_audit.failure_masks(make_docs(spark, rows),
                                       spark.createDataFrame(labels, LABELS), limit=limit)
    got = {(x.part, x.filter_order, x.step): tuple(x[3:])
           for x in filter_audit.audit(masks).collect()}
    assert got == brute_audit(rows, labels)


def test_audit_of_nothing(spark):
    masks = filter_audit.failure_masks(make_docs(spark, []), spark.createDataFrame([], LABELS))
    assert filter_audit.audit(masks).count() == 0


def test_heavy_prefixes_deepen(spark):
    shared = "same beginning " * 100
    texts = spark.createDataFrame([((shared + f"{i:03}").encode(),) for i in range(50)], "t binary")
    heavy = filter_audit.heavy_prefixes(texts, 20_000)
    assert [len(h) for h in heavy] == [1, 1, 1]     # 16, 128 and 1024 bytes; 8192 is all
    assert filter_audit.heavy_prefixes(texts.limit(0), 10) == []


def test_trie():
    r = random.Random(1)
    texts = ["".join(r.choice("ab") for _ in range(r.randint(0, 9))).encode() for _ in range(500)]
    trie, least = filter_audit.Trie(), {}
    for i, t in enumerate(texts):
        key = None if i % 7 == 0 else r.randint(0, 1000)
        trie.insert(t, key)
        old = least.get(t)
        least[t] = key if old is None else old if key is None else min(old, key)
    assert list(trie.terminals()) == sorted(least.items())


def brute_collocations(rows, least, keep):
    n, f = Counter(), defaultdict(Counter)
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, 6):
                for i in range(len(ws) - m + 1):
                    f[lang][tuple(ws[i:i + m])] += 1
    out = []
    for lang, counts in f.items():
        some = {p: a for p, a in counts.items() if a >= least}
        inside = set()
        for p, a in some.items():
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p) and counts[p[i:j]] == a:
                        inside.add(p[i:j])
        found = []
        for p, a in some.items():
            if len(p) > 1 and p not in inside:
                score, _, left, right = min(
                    (1000 * a * n[lang] // (some[p[:k]] * some[p[k:]]), k, some[p[:k]], some[p[k:]])
                    for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:keep], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows(seed, size=300):
    r = random.Random(seed)
    words = ["The", "of", "naïve", "漢字", "x y", "a", "b", "c", "d", "e\x85", *"fghij"]
    weights = [40, 30, *[5] * 13]
    rows = []
    for _ in range(size):
        text = []
        while len(text) < 40:
            if r.random() < 0.15:
                text += r.choice([["fixed", "phrase", "of", "five", "words", "here"],
                                  ["New", "York"], ["\t\xa0", "-"]])
            else:
                text += r.choices(words, weights)
            if r.random() < 0.2:
                text.append(r.choice([". ", "\n", "!", " ,"]))
        rows.append((" ".join(text), r.choice(["en", "en", "en", None, "und", "", "de"])))
    return rows + [(None, "en"), ("", None), (" . ", "fr"), ("solo", "fr"), ("k k " * 3000, "en")]


@pytest.mark.parametrize("least,keep", [(5, 2000), (5, 12), (20, 3)])
def test_collocations_equal_brute_force(spark, least, keep):
    """Small ``keep`` cuts branches off; runs of one word overlap, scores tie."""
    rows = phrase_rows(least)
    docs = make_docs(spark, [(i, *x) for i, x in enumerate(rows)])
    got = sorted(map(tuple, collocations.mine(docs, least=least, keep=keep).collect()))
    assert got == brute_collocations(rows, least, keep) and got


def test_collocations_do_not_expand_under_the_bar(spark, monkeypatch):
    passes = []
    real = collocations.bitmap_of

    def seen(marks, slots):
        passes.append({r.phrase for r in marks.where(f"bit = {collocations.EXPAND}").collect()})
        return real(marks, slots)

    monkeypatch.setattr(collocations, "bitmap_of", seen)
    rows = [("rare pair. " * 6 + "the " * 700 + "of of", "en")] * 4
    docs = make_docs(spark, [(i, *x) for i, x in enumerate(rows)])
    got = collocations.mine(docs, least=5, keep=1).collect()
    assert [r.phrase for r in got] == ["rare pair"]
    assert "the" not in set().union(*passes) and passes


def test_collocations_of_nothing(spark):
    assert collocations.mine(make_docs(spark, [])).count() == 0
    assert collocations.mine(make_docs(spark, [(1, "a b", "en")])).columns == [
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_score_is_exact_beyond_64_bits(spark):
    row = spark.createDataFrame([(10 ** 13 + 1, 10 ** 14 + 3, 10 ** 13 + 7, 10 ** 13 + 9)],
                                "a long, n long, l long, r long")
    got = row.select(collocations._score("a", "l", "r")).first()[0]
    assert got == 1000 * (10 ** 13 + 1) * (10 ** 14 + 3) // ((10 ** 13 + 7) * (10 ** 13 + 9))


def test_fourier_features_approximate_the_kernel():
    r = np.random.default_rng(0)
    d = len(kernel_quality.STATISTICS)
    x = r.normal(size=(40, d))
    z = kernel_quality.fourier(x, *kernel_quality.directions())[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * d))
    assert np.abs(z @ z.T - exact).mean() < 0.06


def test_isotonic_is_the_least_squares_fit():
    r = np.random.default_rng(1)
    x, y, w = np.arange(60.0), r.integers(0, 2, 60).astype(float), r.uniform(0.1, 3, 60)
    places, values = kernel_quality.isotonic(x, y, w)
    assert (np.diff(values) > 0).all() and (np.diff(places) > 0).all()
    # the fit at i is max over starts of min over ends of the mean between them
    mean = lambda a, b: np.average(y[a:b + 1], weights=w[a:b + 1])
    want = [max(min(mean(a, b) for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    assert set(np.round(values, 9)) == set(np.round(want, 9))


def test_normal_sums_equal_one_solution():
    import pyarrow as pa
    r = np.random.default_rng(2)
    d, n = len(kernel_quality.STATISTICS), 500
    x, y, w = r.uniform(-3, 3, (n, d)), r.integers(0, 2, n), r.uniform(0.5, 2, n)
    batch = pa.RecordBatch.from_pydict({
        "label": y, "weight": w, "part": r.integers(0, 4, n).astype(np.int32),
        "__statistics": pa.array([row.tobytes() for row in x], pa.binary())})
    sums = sum(np.frombuffer(s.as_py()).reshape(kernel_quality.FOURIER + 2, -1)
               for half in (batch.slice(0, 200), batch.slice(200))
               for out in kernel_quality.normal_sums([half], np.zeros(d), np.ones(d))
               for s in out.column("sums"))
    z = kernel_quality.fourier(x, *kernel_quality.directions())
    ridge = np.eye(z.shape[1]) * 1e-3 * w.sum()
    ridge[-1, -1] = 1e-9
    want = np.linalg.solve(z.T @ (z * w[:, None]) + ridge, z.T @ (w * y))
    assert np.allclose(kernel_quality.solve(sums, 1e-3), want, atol=1e-6)


def quality_rows(n=400):
    r = random.Random(4)
    words = [f"w{r.randint(0, 10 ** 6)}" for _ in range(800)]
    good = lambda: " ".join(r.choices(words, k=r.randint(20, 80))) + "."
    bad = lambda: " | ".join(r.choices(words, k=20)) if r.random() < .5 else "spam " * 40
    return [(i, bad() if i % 4 == 0 else good(), "en") for i in range(n)]


def test_quality_tells_junk_in_the_held_out_fold(spark):
    rows = quality_rows()
    docs = make_docs(spark, [*rows, (None, "spam " * 40, None), (900, None, "en"), (901, "", "en"),
                             rows[5], (902, "junk | " * 100_000, "en")])
    labels = spark.createDataFrame(
        [(i, int(i % 4 != 0), 0, "t") for i in range(400)]
        + [(None, 1, 0, "t"), (5, 1, 0, "t"), (7, None, 0, "t")], LABELS)
    held = kernel_quality.held_out
    model = kernel_quality.fit_quality(docs, labels, training=~held(kernel_quality.F.col("id")))
    out = kernel_quality.score_quality(docs, model, carry=("lang",)).withColumn(
        "h", held(kernel_quality.F.col("doc_id"))).collect()
    assert len(out) == 405 and all(0 <= x.score <= 1 for x in out)
    tested = [x for x in out if x.h and x.doc_id is not None and x.doc_id < 400]
    right = sum((x.score >= 0.3) == (x.doc_id % 4 != 0) for x in tested)
    assert len(tested) > 50 and right >= 0.97 * len(tested)
    alike = [x.score for x in out if x.doc_id in (900, 901)]
    assert alike[0] == alike[1]
    assert [x.score < 0.3 for x in out if x.doc_id in (None, 902)] == [True, True]


def test_quality_without_a_class(spark):
    docs = make_docs(spark, quality_rows(8))
    none = spark.createDataFrame([], LABELS)
    one = spark.createDataFrame([(1, 1, 0, "t")], LABELS)
    far = spark.createDataFrame([(10 ** 6, 1, 0, "t"), (10 ** 6 + 1, 0, 0, "t")], LABELS)
    for labels, want in ((none, 0.5), (one, 1.0), (far, 0.5)):
        model = kernel_quality.fit_quality(docs, labels)
        assert {x.score for x in kernel_quality.score_quality(docs, model).collect()} == {want}
    model = kernel_quality.fit_quality(make_docs(spark, []), none)
    assert kernel_quality.score_quality(make_docs(spark, []), model).count() == 0


def test_phrases_are_counted_together_not_one_by_one():
    slots = 1 << 12
    made = bytearray(slots // 2)
    for phrase, bit in ((b"a", 0), (b"b", 0), (b"c", 0), (b"a", 2), (b"b", 1), (b"b c", 3),
                        (b"a b c", 2)):
        slot = zlib.crc32(phrase, zlib.crc32(b"en\n")) % slots
        made[slot >> 1] |= 1 << (bit + 4 * (slot & 1))
    bits = collocations._Bits("en", bytes(made), slots)

    def counted(*texts):
        batch = pa.record_batch({"lang": ["en"] * len(texts),
                                 "text": pa.array(texts, pa.binary())})
        (_, ws), = collocations._words_of([batch])
        return {p: (f, b, a) for found in collocations._phrases(ws, bits)
                for p, f, b, a in zip(*(list(c) if isinstance(c, np.ndarray) else c.to_pylist()
                                        for c in found), strict=True)}

    # nothing stands beside a phrase where its piece begins or ends, or where words differ
    assert counted(b"A b C. a b x", b"", b"b c\na b", b"z a b c a") == {
        b"a b": (4, None, None), b"b c": (3, None, None)}
    assert counted(b"q b c d", b"x, q B C e") == {b"b c": (2, b"q", None)}
    assert counted(b"", b"...") == counted(b"x") == {}
