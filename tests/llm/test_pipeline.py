"""The pipeline's stages against brute force, with repeated and null ids."""

from collections import Counter

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from starwright.llm import bpe, mixing, toxicity
from tests.llm.test_operators import brute_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BASE = " ".join(f"w{i}" for i in range(60))
NEAR = BASE.replace("w59", "z")
OTHER = " ".join(f"v{i}" for i in range(40))
ROWS = [
    (5, BASE, "en", "a", 1), (5, BASE, "en", "a", 1), (5, OTHER, "en", "b", 1),
    (2, OTHER, "en", "b", 1), (7, NEAR, None, "a", 1), (None, NEAR, "en", "c", 1),
    (None, BASE, "en", None, 1), (None, "alone with no copy at all here", "en", "c", 1),
    (None, "twice without any id in it", "en", "c", 2),
    (None, "twice without any id in it", "en", "c", 2),
    (8, None, "en", "a", None), (9, "", "en", "a", 0), (9, " ", "en", "a", 1),
    (1, "mail a.b@example.com or +1 (555) 123-4567 at 10.0.0.1", "en", "c", 1),
]


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_near_duplicates_leave_one_row_of_each_component(spark):
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(ROWS, DOCS), None)
    numbered = [(i, x[1]) for i, x in enumerate(ROWS)]
    root = {i: c for i, _, c in brute_components(numbered)}
    order = lambda i: (ROWS[i][0] is None, ROWS[i][0] or 0, i)
    kept = [min((i for i in root if root[i] == c), key=order) for c in set(root.values())]
    assert _rows(got) == sorted((ROWS[i] for i in kept), key=str)


def test_masking_keeps_all_rows(spark):
    got = corpus_pipeline.mask_personal_data(spark, spark.createDataFrame(ROWS, DOCS), None)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = [x[1] for x in ROWS[:-1]] + ["mail <email> or <phone> at <ip>"]
    want = [(x[0], t, *x[2:4], None if t is None else len(t))
            for x, t in zip(ROWS, texts, strict=True)]
    assert _rows(got) == sorted(want, key=str)


def test_mixture_repeats_rows_as_taken(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    sized = docs.select("doc_id", "source", "text", F.array_size(F.array_remove(
        F.split(F.coalesce("text", F.lit("")), " "), "")).cast("long").alias("size"))
    mixed = mixing.mix(sized, mixing.cycled_weights(sized, (3, 1, 2)), 1.5, carry=("text",))
    want = Counter()
    for r in mixed.collect():
        want[r.doc_id, r.text, r.source] += int(r.taken / max(r.size, 1) + 0.5)
    got = Counter((r.doc_id, r.text, r.source)
                  for r in corpus_pipeline.mix_sources(spark, docs, None).collect())
    assert got == +want and got


def test_encoding_equals_tiktoken(spark):
    table = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})
    got = corpus_pipeline.encode(spark, spark.createDataFrame(ROWS, DOCS), None)
    want = sorted(((x[0], theirs.encode_ordinary(x[1] or "")) for x in ROWS), key=str)
    assert sorted(((r.doc_id, list(r.ids)) for r in got.collect()), key=str) == want


def test_toxic_rows_go(spark, tmp_path):
    rows = [(i, f"you stupid idiot number {i}" if i % 2 else f"a kind word number {i}", "en", "a",
             1) for i in range(200)]
    rows += [rows[0], rows[1], (None, "you stupid idiot", "en", "a", 1),
             (None, "a kind word", "en", "a", 1)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(200)],
                                   "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.drop_toxic(spark, spark.createDataFrame(rows, DOCS), str(tmp_path))
    assert _rows(got) == sorted((x for x in rows if "kind" in x[1]), key=str)


def test_a_worker_lets_go_of_what_another_stage_kept():
    table = {bytes([i]): i for i in range(256)}
    codec = bpe.held_codec(table, P.PATTERN, 4)
    assert codec.encode("a b, a") == list(b"a b, a")
    assert bpe.held_codec(table, P.PATTERN, 4) is codec
    list(toxicity._counts(iter([])))
    again = bpe.held_codec(table, P.PATTERN, 4)
    assert again is not codec and bpe.held_codec(table, P.PATTERN, 5) is not again
    # pre-tokens and chunks share one bound
    text = " ".join(f"word{i}, end" for i in range(50))
    assert again.encode(text) == list(text.encode())
    assert len(again.chunks.young) + len(again.chunks.old) <= 8
