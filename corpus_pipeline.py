"""Corpus pipeline: raw documents to packed training sequences, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``. Its result is written to the shared folder and read again as the
next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from trailmill.llm import decontaminate, langid, neardup, packing, toxicity
from trailmill.llm.common import bounded_batches, id_remainder, read_table, stored

TOKENIZER = "word_bpe_49k.json"
TOXIC = 0.5
# The languages to keep; None keeps every language that the labelled rows teach.
WANTED: tuple[str, ...] | None = None
# The score is at least one half by its meaning. Below this the second language would need hardly more phrases: text of a word
# or two, or in none of the learned languages, which parses about as badly in all of them.
LEAST_SCORE = 0.501


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose predicted language is not among WANTED (every learned language, if None), or is predicted with
    a score below LEAST_SCORE; texts that are null or have no letter are in no language.

    The model learns from labelled rows of ``docs`` itself. Rows are judged one by one: null ids, other nulls and repeated
    rows change nothing, a very long text is parsed whole, an empty table stays empty, and all columns stay as they are, whatever their names.
    """
    bounded_batches(spark)
    model = langid.train(docs, F.coalesce(id_remainder(F.col("doc_id"), 3) != 1, F.lit(False)))
    found = langid.identify(docs, model, whole=True)
    wanted = F.col("lang_pred") != langid.UNKNOWN if WANTED is None else F.col("lang_pred").isin(*WANTED)
    return _rows(found.filter(wanted & (F.col("score") >= LEAST_SCORE)), docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose calibrated toxicity reaches one half.

    The model learns from the rows of ``labels`` that are not held out. Every row is scored by itself, null and empty texts too, and
    very long ones whole; null ids and repeated rows change nothing, an empty table stays empty, and all columns stay as they are.
    """
    labels = read_table(spark, sf_dir, "labels")
    labels = labels.filter(F.coalesce(id_remainder(F.col("doc_id"), 5) != 0, F.lit(False)))
    model = toxicity.train(docs, labels)
    return _rows(toxicity.score(docs, model, whole=True).filter(F.col("toxicity") < TOXIC), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the least doc_id.

    Texts without words all stay. A null id stays if nothing with an id has its words, once; of rows that repeat id and
    words one stays. Very long texts are compared whole, an empty table stays empty, and all columns stay as they are.
    """
    bounded_batches(spark)
    return neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents contaminated by benchmark items.

    Null texts and texts without words are not. Equal texts fare alike, also under null or repeated ids; very long ones are
    searched whole, an empty table stays empty, and all columns stay as they are.
    """
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"), whole=True)
    return _rows(found.filter(~F.col("contaminated")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every remaining document's tokens in sequences.

    A null text is its end id alone; null ids and repeated rows keep their pieces; very long texts are cut into many; other
    columns are ignored; an empty table has no pieces.
    """
    bounded_batches(spark)
    # The workers and executors have come through four stages by now: a little more time for less memory.
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), slice_bytes=1_000_000, remembered=150_000)


def _rows(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The documents that stay, with the columns they came with."""
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

# The first two stages are models, which SQL cannot express; tests/llm holds a brute-force version of each stage's rule.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
