"""A training corpus from the documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that its
predecessor kept and returns a DataFrame, which ``run`` writes to the shared
folder and reads again.  All but the last return the columns of ``docs``.
"""

import public_tokenizers
from pyspark.sql import functions as F

from starwright.llm import bpe, jaccard, mixing, pii, toxicity
from starwright.llm.common import n_words, written
from starwright.sources.tables import read_table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def drop_toxic(spark, docs, sf_dir):
    """Documents that score one half or more go; the classifier learns from the
    labelled rows among ``docs``."""
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = toxicity.score_toxicity(
        docs.withColumn("__row", F.struct(*docs.columns)), model, carry=("__row",))
    return scored.where("toxicity < 0.5").select("__row.*")


def drop_near_duplicates(spark, docs, sf_dir):
    """One row of each component stays, that of the smallest id (a null one comes
    last, rows alike in id by their number); one without words stays as well."""
    rows = written(docs.withColumn("__number", F.monotonically_increasing_id()),
                   "pipeline-numbered")
    found = jaccard.jaccard_components(rows, "__number").join(
        rows.select("__number", "doc_id"), "__number")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__number"))
    kept = found.groupBy("component_id").agg(least.alias("least")).select("least.__number")
    return rows.join(kept, "__number", "left_semi").select(docs.columns)


def mask_personal_data(spark, docs, sf_dir):
    """Personal data gives way to its kind; ``n_chars`` follows the text."""
    model = pii.fit_span_classifier(docs)
    rest = [c for c in docs.columns if c != "text"]
    masked = pii.mask_texts(docs, model, rest)
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix takes them, rounded to whole documents."""
    sized = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "source",
                        n_words(F.col("text")).alias("size"))
    mixed = mixing.mix(sized, mixing.cycled_weights(sized, (3, 1, 2)), 1.5, carry=("__row",))
    copies = F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    return (mixed.where(copies > 0).withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies)))
            .select("__row.*"))


def encode(spark, docs, sf_dir):
    """The ids of each row's text."""
    return bpe.encode_documents(docs, bpe.read_ranks(RANKS), public_tokenizers.PATTERN,
                                "ids array<int>, n_tokens long",
                                lambda codec, ids: (ids, len(ids)), entries=100_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("mixture", mix_sources),
    ("byte-level BPE", encode),
]

# The classifiers and hashes have no SQL equivalent; the tests compare stages by brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
