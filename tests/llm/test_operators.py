"""Edge cases and brute-force comparisons of the training-data operators."""

import math
import random
import re

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from starwright.llm import (
    bpe, gru_lm, jaccard, mixing, pii, quality, revisits, token_files, topk, toxicity,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string"
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1, "x"),
    (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1, "x"),
    (2, "THE quick  brown\tfox jumps over the lazy dog", "en", "b", 1, "x"),
    (3, None, "en", None, None, None),
    (4, "", None, "a", 1, "x"),
    (5, " \n ", None, "b", 1, "x"),
    (None, "one two", None, None, 1, "x"),
    (6, LONG, "en", "a", 1, "x"),
    (7, "mail a.b@example.com or +1 (555) 123-4567 at 10.0.0.1", "en", "c", 1, "x"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


def ranks():
    return bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


def test_codec_equals_tiktoken():
    table = ranks()
    codec = bpe.Codec(table, P.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})
    r = random.Random(5)
    texts = ["".join(r.choice(" \n\ta1'sé. \x1c漢Zz") for _ in range(r.randint(0, 40)))
             for _ in range(3000)] + ["ab" * 20000 + "a" * 999, "<|endoftext|>"]
    for text in texts:
        ids = codec.encode(text)
        assert ids == theirs.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_encode_documents(docs, empty):
    rows = bpe.encode_documents(docs, ranks(), P.PATTERN).collect()
    assert len(rows) == len(ROWS) and [r.ids for r in rows if r.doc_id in (3, 4)] == [[], []]
    decoded = bpe.decode_documents(bpe.encode_documents(docs, ranks(), P.PATTERN), ranks())
    assert sorted(bytes(r.decoded).decode() for r in decoded.collect()) == sorted(
        x[1] or "" for x in ROWS)
    assert bpe.encode_documents(empty, ranks(), P.PATTERN).count() == 0


def test_token_files(docs, empty, tmp_path):
    def encoder():
        return lambda text: np.array([ord(c) for c in text], "<u4").tobytes()

    made = token_files.write_token_files(docs, f"file://{tmp_path}/a", encoder, 2)
    read = lambda **k: token_files.read_token_files(
        made, "ids array<long>", lambda b: (np.frombuffer(b, "<u4").tolist(),), **k)
    rows = sorted(read().collect(), key=lambda r: r.start)
    want = sorted(ROWS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    assert [r.doc_id for r in rows] == [x[0] for x in want]
    assert [r.ids for r in rows] == [[*map(ord, x[1] or ""), 2] for x in want]
    assert [r.start for r in rows] == np.cumsum([0, *(len(r.ids) for r in rows)])[:-1].tolist()
    assert {r.doc_id for r in read(wanted=[6, 7]).collect()} == {6, 7}
    path = made.first()["path"].removeprefix("file://")
    with open(path, "r+b") as file:
        file.seek(6)
        file.write(b"\xff\xff\xff")
    with pytest.raises(Exception):  # noqa: B017
        read().collect()
    assert token_files.write_token_files(empty, f"file://{tmp_path}/b", encoder, 2).count() == 0


def test_apportion_is_sainte_lague():
    r = random.Random(3)
    for _ in range(200):
        votes = [r.choice([0, 1, 5, 7.5, 100]) for _ in range(r.randint(1, 6))]
        limits = [r.randint(0, 30) for _ in votes]
        seats, got = r.randint(0, 40), [0] * len(votes)
        for _ in range(seats):
            free = [i for i, v in enumerate(votes) if v > 0 and got[i] < limits[i]]
            if free:
                got[max(free, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
        assert mixing.apportion(votes, seats, limits) == got


def test_mix(docs, empty):
    sized = docs.select("doc_id", "source", F.length("text").cast("long").alias("size"))
    rows = mixing.mix(sized, mixing.cycled_weights(sized, (3, 1, 2)), 1.5).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= mixing.BLOCK_WORDS
    none = empty.select("doc_id", "source", F.lit(1).cast("long").alias("size"))
    assert mixing.mix(none, mixing.cycled_weights(none, (3, 1, 2)), 1.5).count() == 0


def brute_components(rows):
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    out = []
    for i, s in enumerate(sets):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((rows[i][0], len(s), min(ids) if s and ids else rows[i][0]))
    return sorted(out, key=str)


def test_jaccard(spark, docs, empty, monkeypatch):
    got = jaccard.jaccard_components(docs).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(ROWS)
    r = random.Random(2)
    base = [f"w{r.randint(0, 400)}" for _ in range(60)]
    rows = []
    for i in range(60):
        w = list(base if i % 3 else [f"v{i}x{k}" for k in range(40)] + base[:20])
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = f"z{i}"
        rows.append((i, " ".join(w), "", "", 1, ""))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)
    monkeypatch.setattr(jaccard, "HUGE_FROM", 8)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)
    assert jaccard.jaccard_components(empty).count() == 0


def test_top_k(spark):
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    rows += [(200, None), (201, [None] * 6), (202, [math.nan] * 6), (None, [1.0] * 6), rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    kept = {(i, tuple(v)) for i, v in df.limit(120).collect()}
    u = {i: [math.floor(64 * x) for x in v] for i, v in kept}
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), 5).collect()
    want = []
    for q in range(0, 120, 20):
        scores = sorted((-sum(a * b for a, b in zip(u[q], u[i], strict=True)), i)
                        for i in u if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, got)) == want
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0


def test_lm(docs, empty):
    rows = gru_lm.score_documents(docs, F.col("doc_id") != 7).collect()
    assert len(rows) == len(ROWS) and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    twice = [r for r in rows if r.doc_id == 1]
    assert twice[0] == twice[1]
    assert gru_lm.score_documents(empty, F.lit(True)).count() == 0
    assert gru_lm.score_documents(docs, F.lit(False)).count() == len(ROWS)


def test_lm_places_words_as_the_pattern_finds_them():
    """Words are looked up a batch at a time, only those outside the head one by one."""
    r = random.Random(9)
    texts = ["".join(r.choice("ab \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u2003\u6f22\x00")
                     for _ in range(r.randint(0, 30))) for _ in range(500)] + ["", " ", "a"]
    head = ["a", "ab", "\u6f22"]
    owner, place, flat = gru_lm.placed(texts, pa.array(head, pa.large_string()))
    found = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    words = [w for ws in found for w in ws]
    assert flat.to_pylist() == words
    assert place.tolist() == [head.index(w) if w in head else -1 for w in words]
    assert [x.tolist() for x in gru_lm._each(place, owner, len(texts))] == [
        [head.index(w) if w in head else -1 for w in ws] for ws in found]


def test_personal_data(docs, empty):
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.base]
             for r in pii.find_personal_data(docs).collect()}
    assert found[7] == [("email", 5, 20), ("phone", 24, 41), ("ip", 45, 53)]
    assert found[3] == found[4] == []
    masked = pii.mask_texts(docs, pii.fit_span_classifier(docs), ["doc_id"]).collect()
    assert [r.text for r in masked if r.doc_id == 7] == ["mail <email> or <phone> at <ip>"]
    assert [r.text for r in masked if r.doc_id == 3] == [None]
    assert pii.find_personal_data(empty).count() == 0


def test_toxicity(spark, docs, empty):
    rows = [(i, f"you stupid idiot number {i}" if i % 2 else f"a kind word number {i}", "", "", 1,
             "") for i in range(200)]
    train = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)],
                                   "doc_id long, toxic int")
    model = toxicity.fit_toxicity(train, labels, training=~toxicity.held_out(F.col("id")))
    got = {r.doc_id: r.toxicity for r in toxicity.score_toxicity(train, model).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(200))
    assert toxicity.score_toxicity(docs, model).count() == len(ROWS)
    assert toxicity.score_toxicity(empty, toxicity.fit_toxicity(empty, labels)).count() == 0


def test_quality(docs, empty, spark):
    ratios = quality.log_ratios(docs, spark.createDataFrame([(1,), (None,)], "doc_id long"))
    rows = quality.judge(docs, ratios).collect()
    assert len(rows) == len(ROWS)
    long = next(r for r in rows if r.doc_id == 6)
    assert (long.n_words, long.n_repeat_words, long.base_failed) == (30000, 30000, True)
    assert all(not r.kept for r in rows if r.doc_id in (3, 4, 5))
    assert quality.judge(empty, quality.log_ratios(empty, empty)).count() == 0


def test_revisits(spark):
    rows = [(1, "http://www.A.com/x/", 1, 200, "e1", None, {"etag": "e1", "x": "1"}, "one"),
            (2, "https://a.com/x#f", 2, 304, "e1", None, {"Date": "d", "x": "2"}, None),
            (3, "a.com/x?utm_source=f", 3, 200, "e2", None, None, "two"),
            (4, "a.com/x", 4, 304, "e1", None, None, None),
            (5, "a.com/y", 4, 304, "e1", None, None, None),
            (6, None, 4, 304, "e1", None, None, None)]
    schema = ("record_id long, url string, captured_at long, status int, etag string, "
              "last_modified string, headers map<string,string>, body string")
    got = {r.record_id: r for r in
           revisits.resolve_revisits(spark.createDataFrame(rows, schema)).collect()}
    assert (got[2].response_id, got[2].resolved, got[2].body) == (1, True, "one")
    assert got[2].headers == {"x": "1", "etag": "e1", "Date": "d"}
    assert (got[4].response_id, got[4].resolved) == (3, False)
    assert got[5].response_id is None and not got[6].resolved


def test_lm_learns_from_every_training_document(spark):
    """The order of words matters in documents beyond any fixed number."""
    words = [chr(97 + i) for i in range(12)]
    ids = spark.range(1200).orderBy(F.xxhash64("id"), "id")
    first = {r.id for r in ids.limit(400).collect()}
    ahead, back = " ".join(words * 3), " ".join(words[::-1] * 3)

    def scored(rest):
        rows = [(i, ahead if i in first else rest) for i in range(1200)] + [(-1, ahead)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return gru_lm.score_documents(df, F.col("doc_id") >= 0).where("doc_id = -1").first()

    same, other = scored(ahead), scored(back)
    assert same.base_score == other.base_score and same.train_tokens == other.train_tokens
    assert same.score > other.score + 0.5


def test_lm_fit_covers_all_words_in_tasks(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "TASK_WORDS", 500)
    r = random.Random(6)
    docs = [bytes(r.randrange(5) for _ in range(r.randint(0, 30))) for _ in range(900)]
    n = sum(map(len, docs)) + len(docs)
    rows = spark.createDataFrame([(i % gru_lm.ROUNDS, bytearray(x)) for i, x in enumerate(docs)],
                                 "part int, ids binary")
    w = gru_lm.initial(6, np.full(6, 1 / 6))
    assert gru_lm.fit(rows, w, 5, n)[1] == n
    monkeypatch.setattr(gru_lm, "BLOCK_WORDS", 64)
    arrays = [np.frombuffer(x, np.uint8) for x in docs]
    blocks = list(gru_lm.blocks(iter(arrays), 5))
    stream = np.concatenate([blocks[0], *(x[1:] for x in blocks[1:])])
    assert stream.tolist() == [5, *(y for x in docs for y in [*x, 5])]


def test_mix_meets_targets_over_many_shards(spark):
    r = random.Random(8)
    rows = [(i, *(("rare", r.randint(1, 3)) if i % 16 == 0 else ("short", r.randint(4, 11))
                  if i % 16 == 8 else (None, 0) if i % 16 == 4 else ("big", r.randint(50, 300))))
            for i in range(4000)] + [(None, "rare", 2)] * 3
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    for share in (0.7, 1.5):
        got = mixing.mix(sized, mixing.cycled_weights(sized, (3, 1, 2)), share,
                         shard_docs=16).collect()
        assert len(got) == len(rows) and all(0 <= x.taken <= 2 * x.size for x in got)
        for source in {x.source for x in got}:
            mine = [x for x in got if x.source == source]
            assert abs(sum(x.taken for x in mine) - mine[0].target) <= 1


def test_quality_counts_every_trusted_document(spark):
    docs = spark.range(20_400).select(F.col("id").alias("doc_id"),
                                      F.concat(F.lit("w"), F.col("id")).alias("text"))
    assert set(quality.log_ratios(docs, docs.select("doc_id"))) == {0.0}


def test_long_credentials_are_masked_whole(spark):
    value = "".join(random.Random(9).choices("abcdefXYZ0189._-", k=1000))
    docs = spark.createDataFrame([(1, f"see token={value} and go")], "doc_id long, text string")
    spans = pii.find_personal_data(docs).first().spans
    assert (4, 4 + len("token=") + 1000) in {(s.start, s.end) for s in spans
                                             if s.kind == "secret"}
    assert pii.mask_texts(docs, pii.fit_span_classifier(docs), ["doc_id"]).first().text == (
        "see <secret> and go")


def test_deal_gives_blocks_then_words():
    r = random.Random(5)
    for _ in range(300):
        sizes = [r.choice([0, 1, 3, 15, 16, 40, 1000]) for _ in range(r.randint(1, 8))]
        cap, block = r.randint(1, 3), r.choice([1, 4, 16])
        words = r.randint(0, cap * sum(sizes))
        got = mixing.deal(sizes, words, cap, block)
        assert sum(got) == words and all(0 <= g <= cap * s for g, s in zip(got, sizes, strict=True))
    assert mixing.deal([160, 320, 480], 30 * 16, 1, 16) == [80, 160, 240]
    # six blocks, then quotients 4, 3, 3, 4 / 3 of the words left
    assert mixing.deal([3, 3, 100], 100, 1, 16) == [1, 1, 98]


def test_mix_takes_numbered_blocks(spark, monkeypatch):
    """Each shard's row of words against a plain one: blocks are taken whole but for
    one, in a seeded choice, and the pieces are the words of those blocks."""
    monkeypatch.setattr(mixing, "REGION_SHARDS", 3)
    r = random.Random(6)
    rows = [(i, r.choice(["a", "b", "b", None]), r.choice([0, 1, 7, 20, 90])) for i in range(900)]
    rows += [(5, "a", 1000), (5, "a", 1000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    weights = mixing.cycled_weights(sized, (3, 1, 2))

    def mixed():
        return mixing.mix(sized, weights, 0.6, shard_docs=100, block_words=16)

    got = mixed().collect()
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, mixed().collect()))
    for x in got:
        spans = [(p.first, p.first + p.words) for p in x.pieces]
        assert all(0 <= a < b <= x.size for a, b in spans)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert x.taken == x.rounds * x.size + sum(p.words for p in x.pieces) <= 2 * x.size
    for source in ("a", "b", None):
        mine = [x for x in got if x.source == source]
        assert abs(sum(x.taken for x in mine) - mine[0].target) <= 1
    # scattered blocks, not one run: a long text gives several pieces
    assert max(len(x.pieces) for x in got if x.size == 1000) > 5


def test_links_through_null_ids(spark):
    words = [f"w{i}" for i in range(60)]
    tail, head = [f"x{i}" for i in range(5)], [f"y{i}" for i in range(5)]
    near = [" ".join(x) for x in (words, [*words[:-5], *tail], [*head, *words[5:-5], *tail])]
    far = [t.replace("w", "v") for t in near]
    rows = [(1, near[0]), (None, near[1]), (None, near[1]), (2, near[2]),
            (None, far[0]), (None, far[1]), (7, far[2]), (None, "alone among all the others here")]
    want = brute_components(rows)
    # the middle text links the others, which share too little without it
    assert [c for i, _, c in want if i == 2] == [1]
    assert [c for _, _, c in brute_components([rows[0], rows[3]])] == [1, 2]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_pairs_too_far_apart_are_not_verified(spark, monkeypatch):
    r = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):  # most pairs share much of their prefixes, few reach the threshold
        w = list(base)
        for at in r.sample(range(200), 6):
            w[at] = f"z{i}x{at}"
        rows.append((i, " ".join(w)))
    asked, links = [], jaccard._links

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return links(pairs, *rest)

    monkeypatch.setattr(jaccard, "_links", counted)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute_components(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert len({c for _, _, c in want}) > 30
    assert sum(asked) < 100  # of 780


def test_parities_bound_the_overlap():
    r = np.random.Generator(np.random.PCG64(3))
    for _ in range(200):
        a, b, c = (r.integers(0, 1 << 64, r.integers(0, 900), np.uint64) for _ in range(3))
        x, y = np.unique(np.concatenate([a, c])), np.unique(np.concatenate([b, c]))
        p, q = (np.frombuffer(jaccard.parities(s), "u8") for s in (x, y))
        apart = int(np.bitwise_count(p ^ q).sum())
        assert len(np.intersect1d(x, y)) <= (len(x) + len(y) - apart) // 2


def test_lm_chooses_within_a_class_by_the_state(spark, monkeypatch):
    """With one class for the whole head, the order of words still matters."""
    monkeypatch.setattr(gru_lm, "CLASSES", 1)
    words = [chr(97 + i) for i in range(12)]
    ahead, back = " ".join(words * 3), " ".join(words[::-1] * 3)

    def scored(rest):
        df = spark.createDataFrame([(i, rest if i else ahead) for i in range(1200)],
                                   "doc_id long, text string")
        return gru_lm.score_documents(df, F.col("doc_id") > 0).where("doc_id = 0").first()

    same, other = scored(ahead), scored(back)
    assert same.base_score == other.base_score and same.train_tokens == other.train_tokens
    assert same.score > other.score + 0.5


def test_lm_probabilities_of_all_words_sum_to_one():
    r = np.random.default_rng(4)
    group = np.array([0] * 5 + [1] * 300 + [2] * gru_lm.ENDINGS + [3])
    table, odds = gru_lm.trees(group, mass := r.random(len(group)) + 0.01)
    w = gru_lm.initial(4, np.full(4, 0.25), len(group), odds)
    every, h = np.arange(len(group)), r.normal(0, 1, gru_lm.HIDDEN).astype(np.float32)

    def chances():
        logs = gru_lm.within(w, table, every, np.tile(h, (len(every), 1)))
        logs += gru_lm.log_softmax(w, h[:, None])[group, 0]
        return np.exp(logs.astype(float))

    shares = mass / np.bincount(group, mass)[group] / 4  # at first those of the corpus
    assert np.allclose(chances(), shares, rtol=1e-3)
    for k in ("node", "out"):
        w[k] += r.normal(0, 1, w[k].shape).astype(np.float32)
    assert abs(chances().sum() - 1) < 1e-4 and not np.allclose(chances(), shares, rtol=0.1)
    # the gradient against differences, at words of every class
    some, states = np.array([0, 4, 7, 200, 700, 1328, 1329]), r.normal(0, 1, (7, gru_lm.HIDDEN))
    w = {k: v.astype(float) for k, v in w.items()}
    back, (at, to_node) = gru_lm.within_gradient(w, table, some, states)
    loss = lambda s=states: -gru_lm.within(w, table, some, s).astype(float).sum()
    shift = np.zeros_like(states)
    shift[3, 2] = 1e-2
    assert abs((loss(states + shift) - loss(states - shift)) / 2e-2 - back[3, 2]) < 1e-3
    for place in (0, len(at) // 2):
        w["node"][at[place], 5] += 1e-2
        up = loss()
        w["node"][at[place], 5] -= 2e-2
        assert abs((up - loss()) / 2e-2 - to_node[place, 5]) < 1e-3
        w["node"][at[place], 5] += 1e-2


def test_lm_tells_words_of_the_tail_apart_by_their_ends():
    words = ["", "a", "ba", "xyzing", "king", "漢", "漢漢", "née", "nee"]
    got = gru_lm.endings(pa.array(words)).tolist()
    assert got == gru_lm.endings(pa.array(["skip", *words], pa.large_string())[1:]).tolist()
    assert got[3] == got[4] and got[5] == got[6] and len(set(got)) == 7
    assert gru_lm.endings(pa.array([], pa.string())).tolist() == []


def test_lm_scores_side_by_side_what_each_document_scores_alone():
    r = np.random.default_rng(3)
    group = np.array([0] * 5 + [1] * 300 + [2] * gru_lm.ENDINGS + [3])
    table, odds = gru_lm.trees(group, r.random(len(group)) + 0.01)
    w = gru_lm.initial(4, np.full(4, 0.25), len(group), odds)
    for k in ("node", "out"):
        w[k] += r.normal(0, 1, w[k].shape).astype(np.float32)
    end = len(group) - 1
    docs = [r.integers(0, end, k).astype(np.uint16) for k in (0, 1, 31, 32, 33, 300, 5, 9000)]
    got = gru_lm.likelihoods(w, docs, end, table)
    assert np.allclose(got, [gru_lm.likelihoods(w, [d], end, table)[0] for d in docs], rtol=1e-5)
    for d, like in zip(docs[:7], got, strict=False):
        h, want, before = np.zeros((gru_lm.HIDDEN, 1), np.float32), 0.0, end
        for x in [*d, end]:
            h, _ = gru_lm.forward(w, gru_lm.inputs(w, table, np.array([before])), h)
            want += gru_lm.log_softmax(w, h)[group[x], 0]
            want += gru_lm.within(w, table, np.array([x]), np.ascontiguousarray(h.T))[0]
            before = x
        assert abs(like - want) < 1e-5 * abs(want) + 1e-3
