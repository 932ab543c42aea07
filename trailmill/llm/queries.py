"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bestfit, crosstok, decontaminate, langid, licenses, neardup, packing, pfor, pivots, runs, tokencount, toxicity, warc
from .common import id_remainder, read_table


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 3) == 1, F.lit(True))
    model = langid.train(docs, ~held_out)
    found = langid.identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "phrase_rate")


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.top_k(read_table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.token_counts(
        read_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.new_folder(spark)
    warc.write(read_table(spark, folder, "pages"), archives)
    return warc.checked(warc.read(spark, archives))


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(read_table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"), keep=["doc_id"]
    )


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(True))
    model = toxicity.train(docs, read_table(spark, folder, "labels").filter(~held_out))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "lexicon_hits",
    )


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    manifest = pfor.write_tokens(
        read_table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        pfor.new_folder(spark),
    )
    return pfor.read_tokens(manifest, with_ids=False)


def op11_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return bestfit.pack_documents(
        read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return crosstok.align(
        read_table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    hashed = id_remainder(F.col("doc_id"), 2**32)
    seed = F.when(hashed % 10 == 0, F.call_function("div", hashed, F.lit(10)))
    return runs.digests(runs.periodic_runs(read_table(spark, folder, "documents"), seed=seed))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language,
        op2_top_k,
        op3_packing,
        op4_near_duplicates,
        op5_token_counts,
        op6_warc,
        op7_licenses,
        op8_decontamination,
        op9_toxicity,
        op10_token_files,
        op11_best_fit,
        op12_tokenizer_alignment,
        op13_periodic_runs,
    )
}
