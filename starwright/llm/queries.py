"""The numbered queries: each operator over its whole table."""

from __future__ import annotations

import hashlib
import os
import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.llm import (
    bpe, collocations, filter_audit, gru_lm, jaccard, kernel_quality, mixing, pii, quality,
    revisits, token_files, topk, toxicity,
)
from starwright.llm.common import n_words, scratch, written
from starwright.registry import register
from starwright.sources.tables import read_table

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


@register("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(BPE_RANKS)

    def digests(codec: bpe.Codec, ids: list[int]) -> tuple:
        joined = ",".join(map(codec.decimal.__getitem__, ids))
        return (len(ids), hashlib.sha256(joined.encode()).hexdigest(),
                hashlib.sha256(codec.decode(ids)).hexdigest())

    return bpe.encode_documents(
        read_table(spark, sf_dir, "documents", "doc_id", "text"), ranks,
        public_tokenizers.PATTERN,
        "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


@register("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(BPE_VOCABULARY, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())

    def encoder():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return token_files.cached_encoder(vocabulary.value).encode_all

    manifest = token_files.write_token_files(
        read_table(spark, sf_dir, "documents", "doc_id", "text"),
        scratch(spark, "token-files"), encoder, END_ID, together=True)
    return token_files.read_token_files(
        manifest, "n_tokens long, ids_crc32 long", lambda ids: (len(ids) // 4, zlib.crc32(ids)))


@register("op8_personal_data")
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> F.Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    def joined(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.KINDS[:4]),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"),
                                  training=~toxicity.held_out(F.col("id")))
    score = F.col("toxicity")
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"))


@register("op3_mixture")
def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = read_table(spark, sf_dir, "documents", "doc_id", "source", "text").select(
        "doc_id", "source", n_words(F.col("text")).alias("size"))
    return mixing.mix(sized, mixing.cycled_weights(sized, (3, 1, 2)), share=1.5).select(
        "doc_id", "size", "source_size", "target", "taken")


@register("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    trusted = read_table(spark, sf_dir, "labels", "doc_id", "quality").where("quality = 1")
    return quality.judge(docs, quality.log_ratios(docs, trusted)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score")


@register("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op6_top_k")
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


REVISIT_SQL = r"""
WITH k AS (
  SELECT page_id, html, md5(html) AS etag,
    regexp_replace(lower(regexp_extract(b, '^[^/?]*', 0)), '^(www|m)\.', '') ||
    regexp_replace(regexp_replace(regexp_extract(b, '^[^/?]*(.*)$', 1),
      '([?&])(utm_[^&]*|ref=[^&]*)', '', 'g'), '[/?&]+$', '') AS url_key
  FROM (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''),
          '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM pages))
SELECT page_id + 1 AS page_id, url_key, page_id AS response_id,
  page_id % 3 <> 0 AS resolved, CASE WHEN page_id % 3 <> 0 THEN length(html) END AS body_chars
FROM (SELECT 2 * page_id AS page_id, url_key, html FROM k WHERE url_key IS NOT NULL)
"""


@register("op2_revisits", REVISIT_SQL)
def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages table has full responses only: each page is one, and each is
    revisited under another form of its URL, every third time with a changed ETag,
    every third with its modification time alone.  Around the two lie captures that
    compete: an earlier and a later response of the URL, and one of another URL
    right before the revisit.  Any of them in the page's place shows in the rows.

    Every revisit is resolved and written whole, with merged headers and body; the
    rows come from what was written.  A body counts if the headers are the right
    ones: type and length of the stored response, date of the revisit."""
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    etag, time = F.md5(F.col("html").cast("binary")), 8 * F.col("page_id")
    key, page, changed = revisits.canonical_url(F.col("url")), F.col("page_id"), F.lit("changed")
    modified, none = page.cast("string"), F.lit(None).cast("string")
    # moment, id, url, status, ETag, modification time, body; ids below 0 compete
    made = [
        (0, -4 * page - 4, F.col("url"), 200, F.lit("earlier"), none, F.lit("earlier")),
        (1, 2 * page, F.col("url"), 200, etag, modified, F.col("html")),
        (2, -4 * page - 3, F.concat(F.lit("other."), key), 200, F.lit("other"), none,
         F.lit("other")),
        (3, 2 * page + 1, F.concat(F.lit("https://www."), key, F.lit("/#revisit")), 304,
         F.when(page % 3 == 0, changed).when(page % 3 != 1, etag),
         F.when(page % 3 == 0, changed).otherwise(modified), none),
        (4, -4 * page - 2, F.col("url"), 200, F.lit("later"), none, F.lit("later")),
    ]

    def headers(id_: F.Column, status: int, tag: F.Column, stamp: F.Column, body: F.Column):
        """Those of a 304 have names in lower case, and a type and a length of its own."""
        name = str.lower if status == 304 else str
        given = {"Date": id_.cast("string"), "ETag": tag, "Last-Modified": stamp,
                 "Content-Type": F.lit("none" if status == 304 else "text/html"),
                 "Content-Length": F.coalesce(F.octet_length(body), F.lit(0)).cast("string")}
        return F.map_filter(F.create_map(*(x for k, v in given.items()
                                           for x in (F.lit(name(k)), v))),
                            lambda _, v: v.isNotNull())

    records = pages.select(F.inline(F.array(*(
        F.struct(id_.alias("page_id"), url.alias("url"), (time + moment).alias("captured_at"),
                 F.lit(status).alias("status"), tag.alias("etag"), stamp.alias("last_modified"),
                 headers(id_, status, tag, stamp, body).alias("headers"), body.alias("body"))
        for moment, id_, url, status, tag, stamp, body in made))))
    found = written(revisits.resolve_revisits(records, "page_id"), "revisits")
    sent, body = F.col("headers"), F.col("body")
    right = ((sent["date"] == F.col("page_id").cast("string")) & sent["Date"].isNull()
             & (sent["Content-Type"] == "text/html") & sent["content-type"].isNull()
             & (sent["Content-Length"] == F.coalesce(F.octet_length(body), F.lit(0)).cast("string"))
             & sent["content-length"].isNull())
    return found.where("url_key is not null").select(
        "page_id", "url_key", "response_id", "resolved",
        F.when(right, F.char_length(body).cast("long")).alias("body_chars"))


@register("op7_gru_lm")
def op7_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    held = gru_lm.held_out(F.col("doc_id"))
    return gru_lm.score_documents(docs, ~held).withColumn("held_out", held)


FILTER_AUDIT_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS first_id FROM t GROUP BY text),
masks AS (
  SELECT t.doc_id, part,
    (len(ws) < 200)::INT AS a, (100 * len(list_distinct(ws)) < 50 * len(ws))::INT AS b,
    (100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text))::INT AS c,
    regexp_matches(text, '[#$%&*|]')::INT AS d,
    (first_id IS NOT NULL AND (t.doc_id IS NULL OR t.doc_id > first_id))::INT AS e
  FROM t JOIN firsts USING (text)),
marked AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
counts AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n,
    coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM masks LEFT JOIN marked USING (doc_id) GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT f1.x || f2.x || f3.x || f4.x || f5.x AS filter_order,
    [f1.bit, f2.bit, f3.bit, f4.bit, f5.bit] AS bits
  FROM f f1 JOIN f f2 ON f2.x <> f1.x JOIN f f3 ON f3.x NOT IN (f1.x, f2.x)
  JOIN f f4 ON f4.x NOT IN (f1.x, f2.x, f3.x) JOIN f f5 ON f5.x NOT IN (f1.x, f2.x, f3.x, f4.x)),
steps AS (
  SELECT filter_order, step, bits[step] AS own, list_sum(bits[1:step]) AS upto
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
found AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & upto::INT = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & upto::INT = own THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & own <> 0 AND mask & (upto::INT - own) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & upto::INT = own THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & upto::INT = own THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM found
"""


@register("op11_filter_audit", FILTER_AUDIT_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failure_masks(
        read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"),
        read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")))


COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, len, array_to_string(ws[i:i + len - 1], ' ') AS phrase
  FROM (SELECT lang, ws, len, unnest(range(1, len(ws) + 2 - len)) AS i
        FROM ws, (SELECT unnest([1, 2, 3, 4, 5]) AS len) WHERE len(ws) >= len)),
f AS (SELECT lang, phrase, len, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
sizes AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM ws GROUP BY lang),
split AS (SELECT lang, phrase, len, f, string_split(phrase, ' ') AS ws FROM f WHERE len > 1),
inside AS (
  SELECT lang, array_to_string(ws[i:j], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(i + 1, len + 1)) AS j
        FROM (SELECT *, unnest(range(1, len)) AS i FROM split))
  WHERE j - i + 1 < len GROUP BY ALL),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(ws[1:k], ' ') AS x,
    array_to_string(ws[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, len)) AS k FROM split)),
scores AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, n,
    ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = x
  JOIN f r ON r.lang = c.lang AND r.phrase = y JOIN sizes s ON s.lang = c.lang),
lowest AS (
  SELECT * FROM scores
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM lowest LEFT JOIN inside USING (lang, phrase)
WHERE longer IS NULL OR longer < a
QUALIFY rank <= 2000
"""


@register("op12_collocations", COLLOCATION_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents", "text", "lang"))


@register("op13_kernel_quality")
def op13_kernel_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    model = kernel_quality.fit_quality(
        docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"),
        training=~kernel_quality.held_out(F.col("id")))
    return kernel_quality.score_quality(docs, model).select(
        "doc_id", kernel_quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))
