"""Benchmark decontamination by winnowing, with DataFrame functions only.

Of every 9 consecutive 5-grams of words, the least hash is kept as a fingerprint. Two texts that share
13 consecutive words share such a run of 5-grams, hence a fingerprint: joining fingerprints finds every
shared window. A hit is extended to the window around the gram, word by word, which leaves no false ones. Items of fewer than 13 words are one window; they are found by a hash of all their
words, looked up at every place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored, word_column

WINDOW = 13
GRAM = 5
# Window starts in one row: bounds the words that a fingerprint carries along.
STRETCH = 256
# Benchmark windows sent to every task (about 300 bytes each); more are joined by shuffle.
BROADCAST_WINDOWS = 100_000


def _slice(array: Column, start: Column, length) -> Column:
    return F.slice(array, start, length if isinstance(length, Column) else F.lit(length))


def _range(last: Column) -> Column:
    """1, 2, …, last; empty below 1."""
    return F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def fingerprints(words: Column, window: int = WINDOW, gram: int = GRAM) -> Column:
    """The distinct least hashes of the runs of grams that each ``window`` words hold; empty below ``window`` words."""
    span = window - gram + 1
    hashes = F.transform(_range(F.size(words) - (gram - 1)), lambda i: F.xxhash64(_slice(words, i, gram)))
    starts = _range(F.size(words) - (window - 1))
    # A one-element array binds the hashes, so that they are computed once.
    least = F.transform(F.array(hashes), lambda held: F.transform(starts, lambda i: F.array_min(_slice(held, i, span))))
    return F.array_distinct(F.flatten(least))


def gram_places(words: Column, hash_: Column, gram: int = GRAM) -> Column:
    """Where (from 1) the grams of ``words`` have the hash."""
    return F.filter(_range(F.size(words) - (gram - 1)), lambda i: F.xxhash64(_slice(words, i, gram)) == hash_)


def benchmark_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The distinct windows (window_words, n, hash, at) and which items have each (item, window_words).

    Null texts and texts without words have none; repeated items count once.
    """
    rows = items.select(F.col(key).cast("string").alias("item"), word_column(F.col(text).cast("string")).alias("words"))
    rows = rows.filter((F.size("words") > 0) & F.col("item").isNotNull())
    count = F.greatest(F.lit(1), F.size("words") - (WINDOW - 1))
    held = rows.select(
        "item", F.explode(F.transform(_range(count), lambda i: _slice(F.col("words"), i, WINDOW))).alias("window_words")
    ).distinct()
    held = stored(held, "benchmark-windows")
    n = F.size("window_words")
    least = F.get(fingerprints(F.col("window_words")), F.lit(0))
    windows = held.select("window_words").distinct().select(
        "window_words", n.alias("n"), F.when(n == WINDOW, least).otherwise(F.xxhash64("window_words")).alias("hash")
    )
    whole = F.get(gram_places(F.col("window_words"), F.col("hash")), F.lit(0))
    windows = windows.withColumn("at", F.when(F.col("n") == WINDOW, whole).otherwise(F.lit(1)))
    return stored(windows, "benchmark-fingerprints"), held


def _grams(words: Column, last: Column, n: int) -> Column:
    """Structs (at, n, hash) of the n-grams at 1, …, last."""
    return F.transform(
        _range(last), lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.xxhash64(_slice(words, i, n)).alias("hash"))
    )


def _marks(words: Column, starts: Column, short: list[int]) -> Column:
    """Structs (at, n, hash) to look up: fingerprints for whole windows (at unknown), all n-grams for short items.

    ``starts`` is the number of places in ``words`` that belong to this stretch.
    """
    unknown = F.lit(None).cast("int").alias("at")
    found = [F.transform(fingerprints(words), lambda f: F.struct(unknown, F.lit(WINDOW).alias("n"), f.alias("hash")))]
    found += [_grams(words, F.least(starts, F.size(words) - (n - 1)), n) for n in short]
    return F.concat(*found) if len(found) > 1 else found[0]


def _stretches(docs: DataFrame) -> DataFrame:
    """(key, offset, near): the words of each text in stretches, each with what a window at its last word needs."""
    split = docs.select("key", word_column(F.col("text")).alias("words"))
    # Texts without words give no stretch here: a filter would be moved below the split, and split every text once more.
    return split.select(
        "key",
        F.explode(
            F.transform(
                _range(F.ceil(F.size("words") / STRETCH).cast("int")),
                lambda k: F.struct(
                    ((k - 1) * STRETCH).alias("offset"), _slice(F.col("words"), (k - 1) * STRETCH + 1, STRETCH + WINDOW - 1).alias("near")
                ),
            )
        ).alias("stretch"),
    ).select("key", "stretch.offset", "stretch.near")


def hit_windows(docs: DataFrame, windows: DataFrame, sent: int = BROADCAST_WINDOWS) -> DataFrame:
    """(key, start, n, window_words) wherever a window stands in a text; ``docs`` has key and text.

    Up to ``sent`` windows are sent to every task, which looks its fingerprints up as it makes them. More are joined by a
    shuffle of hashes alone; the words of the stretches that meet a window are then fetched again.
    """
    sizes = [r["n"] for r in windows.filter(F.col("n") < WINDOW).select("n").distinct().collect()]  # 12 at most
    stretches = _stretches(docs)
    marked = stretches.select(
        "key", "offset", "near", F.explode(_marks(F.col("near"), F.lit(STRETCH), sorted(sizes))).alias("mark")
    ).select("key", "offset", "near", F.col("mark.at").alias("place"), F.col("mark.n").alias("n"), F.col("mark.hash").alias("hash"))
    if windows.count() <= sent:
        met = marked.join(F.broadcast(windows), ["hash", "n"])
    else:
        known = windows.select("hash", "n").distinct().hint("merge")
        met = stored(marked.drop("near").join(known, ["hash", "n"], "left_semi"), "benchmark-met")
        # Sorted by key, the merge join takes a text that holds many windows, and many texts that hold one, as they come.
        met = stretches.join(met.hint("merge"), ["key", "offset"]).join(windows.hint("merge"), ["hash", "n"])
    start = F.col("at_word") - F.col("at") + 1
    # Few fingerprints meet: only for those are the gram's places looked up.
    places = F.when(F.col("n") == WINDOW, gram_places(F.col("near"), F.col("hash"))).otherwise(F.array("place"))
    return (
        met.withColumn("at_word", F.explode(places))
        .filter((start >= 1) & (_slice(F.col("near"), F.greatest(start, F.lit(1)), F.col("n")) == F.col("window_words")))
        .select("key", (F.col("offset") + start - 1).alias("start"), "n", "window_words")
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
    whole: bool = False,
    sent: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """The columns ``keep`` of every row with n_words, n_hit, n_items, items_sha256 and contaminated.

    A word is hit if it stands inside an occurrence of any item's window. Contaminated: some word is hit, and
    at least a twentieth of the words are. Equal texts have equal results, so hits are gathered by a
    digest of the text, and rows with null or repeated keys keep their own rows. A null text has no
    words; without items nothing is hit. A kept column named like a result gives way to it; with ``whole`` the kept columns
    stay apart, in the struct ``row``.
    """
    kept = docs.columns if keep is None else keep
    plain = docs[text].cast("string")
    rows = docs.select(F.struct(*[docs[c].alias(c) for c in kept]).alias("row"), plain.alias("text"), F.sha2(plain, 256).alias("key"))
    windows, held = benchmark_windows(items)
    found = stored(hit_windows(rows.select("key", "text"), windows, sent).distinct(), "benchmark-hits")
    # Words hit: the union of the windows' places, counted for each text.
    places = found.select("key", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("place")).distinct()
    words_hit = places.groupBy("key").agg(F.count("*").alias("n_hit"))
    # As many items for each text as the benchmark has.
    of_text = found.select("key", "window_words").distinct().join(held, "window_words").groupBy("key")
    listed = of_text.agg(F.sort_array(F.collect_set("item")).alias("items"))
    hits = stored(words_hit.join(listed, "key"), "benchmark-hit-texts")
    counted = rows.select("row", "key", F.size(word_column(F.col("text"))).cast("bigint").alias("n_words"))
    joined = counted.join(hits, "key", "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("bigint")
    names = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    results = joined.select(
        "row",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
    added = results.columns[1:]
    return results if whole else results.select(*[F.col("row").getField(c).alias(c) for c in kept if c not in added], *added)
