"""License scans with DataFrame functions only: exact phrases, and an exact set-similarity join.

Every stretch of words is a block: BLOCK words from each place of a text, or twice the template's distinct words where
that is more. A block meets a template if it holds at least THRESHOLD of the template's distinct words. The join
orders the template words by how many documents have them, rarest first. A template of n words that must share m of
them is indexed by its first n - m + 1 words alone: a text with none of those has no block that meets it (prefix
filter). Texts with fewer than m words are left out (length filter), and so are those whose later words cannot make up
m any more (positional filter). In the texts that remain, the blocks from each template word with m template words
in reach are counted exactly. No other block holds more: moved on to its first template word, it still holds them all.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored, word_column

# Phrases whose words must stand together, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Templates for the similarity join: a label and the words of a notice. A parameter; any number of them.
TEMPLATES = (
    ("agpl", "licensed under the gnu affero general public license version 3"),
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license version 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("mpl", "subject to the terms of the mozilla public license version 2 0"),
    ("proprietary", "confidential and proprietary no part may be reproduced without written permission"),
)
THRESHOLD = 0.8
BLOCK, STEP = 32, 1


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    words: tuple[str, ...]
    least: int  # words that a block must share

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[: len(self.words) - self.least + 1]

    @property
    def span(self) -> int:
        """Words of a block."""
        return max(BLOCK, 2 * len(self.words))


def order_templates(templates, frequency: dict[str, int], threshold: float) -> list[Template]:
    """Templates with their distinct words in global order: rarest first, ties by the word."""
    out = []
    for number, (label, text) in enumerate(templates):
        words = sorted(set(text.split()), key=lambda w: (frequency.get(w, 0), w))
        out.append(Template(number, label, tuple(words), max(1, math.ceil(threshold * len(words) - 1e-9))))
    return out


def document_frequency(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows of ``words`` (column words) each word of the vocabulary stands; at most so many rows come back."""
    found = words.select(F.explode(F.array_intersect("words", _texts(vocabulary))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def _texts(values) -> Column:
    return F.lit(list(values)) if values else F.array().cast("array<string>")


def starts_of(words: Column, wanted: Column, least: Column, span: Column) -> Column:
    """Places (from 0) of ``wanted`` words that have ``least`` of them, repeats counted, within ``span`` words from there."""
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.array_contains(wanted, F.get(words, i)))
    # Each place beside the one that is `least` - 1 further on.
    return F.array_compact(F.zip_with(places, F.slice(places, least, F.size(words)), lambda p, q: F.when(q < p + span, p)))


def matching_blocks(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, at, template, label, share) for every template and block that meet; ``docs`` has key and words.

    at is the block's first word, which is one of the template's.
    """
    spark = docs.sparkSession
    vocabulary = sorted({w for _, text in templates for w in text.split()})
    frequency = document_frequency(docs, vocabulary)
    ordered = order_templates(templates, frequency, threshold)
    order = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    heads = sorted({w for t in ordered for w in t.prefix})
    index = spark.createDataFrame(
        [(w, i, t.number, t.label, list(t.words), t.least, t.span) for t in ordered for i, w in enumerate(t.prefix)],
        "word string, place int, template int, label string, template_words array<string>, least int, span int",
    )
    texts = docs.filter(F.arrays_overlap("words", _texts(heads))).select(
        "key", "words", F.array_intersect(_texts(order), "words").alias("held")
    )
    probes = texts.select("key", "words", "held", F.explode(F.array_intersect("held", _texts(heads))).alias("word"))
    # The index has as many rows as the templates have prefix words.
    pairs = probes.join(F.broadcast(index), "word").filter(F.size("words") >= F.col("least"))
    behind = F.size("held") - F.array_position("held", F.col("word")).cast("int")
    reach = 1 + F.least(behind, F.size("template_words") - F.col("place") - 1)
    # At the pair's first common word, no more than `reach` words are still to be shared.
    first = F.element_at(F.array_intersect("template_words", "held"), 1) == F.col("word")
    able = pairs.filter(first & (reach >= F.col("least"))).filter(F.size(F.array_intersect("template_words", "held")) >= F.col("least"))

    def block(at: Column) -> Column:
        held = F.array_intersect("template_words", F.slice("words", at + 1, F.col("span")))
        return F.struct(at.alias("at"), F.size(held).alias("shared"))

    blocks = F.transform(starts_of(F.col("words"), F.col("template_words"), F.col("least"), F.col("span")), block)
    met = able.select(
        "key", "template", "label", F.size("template_words").alias("n"),
        F.explode(F.filter(blocks, lambda b: b.shared >= F.col("least"))).alias("block"),
    )
    return met.select("key", "block.at", "template", "label", (F.col("block.shared") / F.col("n")).alias("share"))


def phrase_places(words: Column, phrase: str) -> Column:
    """Places (from 0) where the words of ``phrase`` stand one after the other."""
    parts = phrase.split()
    places = F.sequence(F.lit(0), F.size(words) - len(parts))

    def stands(i: Column) -> Column:
        found = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            found = found & (F.get(words, i + k) == part)
        return found

    empty = F.array().cast("array<int>")
    # Nearly all texts lack one of the words; a look for the rarest part spares them the walk.
    able = F.size(words) >= len(parts)
    for part in parts:
        able = able & F.array_contains(words, part)
    return F.when(able, F.filter(places, stands)).otherwise(empty)


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, n_base, first_word, last_word, base_labels, labels and score for every row.

    score is the largest share of a template that a block holds, 1.0 where a phrase stands, else 0.0. A null or empty
    text has no words and empty labels. Equal texts have equal results, so the join's rows are
    gathered by a digest of the text; null and repeated keys keep their rows.
    """
    words = word_column(F.col(text).cast("string"))
    rows = docs.select(F.col(key).alias("id"), F.sha2(F.col(text).cast("string"), 256).alias("key"), words.alias("words"))
    met = matching_blocks(rows.select("key", "words").filter("key IS NOT NULL"), templates, threshold)
    per_text = met.groupBy("key").agg(F.collect_set("label").alias("found"), F.max("share").alias("share"))
    per_text = stored(per_text, "license-texts")
    arrays = {label: f"p_{i}" for i, label in enumerate(PHRASES.values())}
    placed = rows.select(
        "id", "key", F.size("words").cast("bigint").alias("n_words"),
        *[phrase_places(F.col("words"), phrase).alias(arrays[label]) for phrase, label in PHRASES.items()],
    )
    every = F.concat(*arrays.values())
    base = F.sort_array(F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(label)) for label, c in arrays.items()])))
    short = placed.select(
        "id", "key", "n_words", F.size(every).cast("bigint").alias("n_base"), F.array_min(every).cast("bigint").alias("first_word"),
        F.array_max(every).cast("bigint").alias("last_word"), base.alias("base"),
    )
    joined = short.join(per_text, "key", "left")
    found = F.coalesce(F.col("found"), F.array().cast("array<string>"))
    return joined.select(
        F.col("id").alias(key), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", found)), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
