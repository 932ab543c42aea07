"""Near-duplicate join: word 5-grams with Jaccard similarity of at least 0.8, by MinHash banding.

This is not a whole LSH forest: no signatures are sorted, and no prefix longer than the fixed depth is tried. Texts that share
the prefix of that depth in some tree are candidates; the depth is the longest at which the chance that a pair at the threshold
shares one reaches the target recall (``prefix_depth``). Texts that hang together by shared prefixes are laid out in
blocks; two blocks meet only if some prefix has texts of both, and of two blocks that meet only the pairs that share a
prefix are compared, exactly. Only counts and a spanning set of the links leave a block, never all pairs of a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import BETWEEN, LOWER, UPPER, byte_words, cached, lean, only, slices, stored

GRAM = 5
THRESHOLD = 0.8
TREES, DEPTH = 32, 12  # hashes of a signature: TREES * DEPTH
RECALL = 0.9999
# A block for exact comparison: so many texts, and so many distinct 5-grams in all, at most (one text may have more).
BLOCK_TEXTS, BLOCK_GRAMS = 128, 100_000
_SEED = 20_240_101


def prefix_depth(recall: float = RECALL, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix that still reaches the recall for pairs at the threshold: full length, shortened step by step."""
    for k in range(depth, 0, -1):
        if 1 - (1 - threshold**k) ** trees >= recall:
            return k
    return 1


# ---- 5-grams and signatures -----------------------------------------------------------------------
class GramHasher:
    """64-bit hashes of word 5-grams. ``kept`` bounds the remembered words."""

    def __init__(self, kept: int = 200_000):
        self.kept, self.words = kept, {}
        self.powers = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], "<u8")

    def _codes(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        known = self.words
        new = {w for w in words if w not in known}
        if new:
            if len(known) + len(new) > self.kept:
                known.clear()
                new = set(words)
            known.update((w, xxh3_64_intdigest(w)) for w in new)
        return np.fromiter(map(known.__getitem__, words), "<u8", len(words))

    def grams(self, words: list[bytes]) -> np.ndarray:
        """The distinct 5-grams, sorted; a text of one to four words has one gram, all its words."""
        if not words:
            return np.zeros(0, "<u8")
        codes = self._codes(words)
        n = max(1, len(codes) - GRAM + 1)
        total = np.zeros(n, "<u8")
        for k in range(min(GRAM, len(codes))):
            total += codes[k : k + n] * self.powers[k]
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(32)
        return np.unique(total)


def _hash_family(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(_SEED)
    return random.integers(1, 2**63, count, np.uint64) | np.uint64(1), random.integers(0, 2**63, count, np.uint64)


def signature(grams: np.ndarray, family, step: int = 2_048) -> np.ndarray:
    """The least of each hash function over the grams, 32 bits each."""
    a, b = family
    least = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(grams), step):
        part = grams[at : at + step]
        values = ((part[:, None] * a + b) >> np.uint64(32)).astype(np.uint32)
        np.minimum(least, values.min(axis=0), out=least)
    return least


_HASHER = GramHasher()
cached("neardup", _HASHER.words.clear)


def _hasher() -> GramHasher:
    """The worker process's hasher; other operators' memories are emptied."""
    only("neardup")
    return _HASHER


def sketches(docs: DataFrame, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL, threshold: float = THRESHOLD) -> DataFrame:
    """(id, mark, digest, prefixes) for every row of ``docs`` (id, mark, text): one pass over the texts, one short row for each.

    digest stands for the words in their order; prefixes has the text's place in each tree at the depth for the
    recall, equal prefixes as equal numbers. Both are null for a text without words.
    """
    level = prefix_depth(recall, threshold, trees, depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Hash functions of each tree beyond the depth in use need not be computed.
        pick = (np.arange(trees)[:, None] * depth + np.arange(level)).reshape(-1)
        family = tuple(x[pick] for x in _hash_family(trees * depth))
        mix = _hash_family(level)[0]
        hasher = _hasher()
        for batch in batches:
            for part in slices(batch, "text"):
                digests, rows = [], []
                for text in part.column("text").to_pylist():
                    words = byte_words(text)
                    digests.append(_digest(words))
                    rows.append(signature(hasher.grams(words), family))
                signatures = np.array(rows).reshape(len(rows), trees, level).astype("<u8")
                prefixes = np.zeros((len(rows), trees), "<u8")
                for k in range(level):
                    prefixes = (prefixes ^ signatures[:, :, k]) * mix[k]
                    prefixes ^= prefixes >> np.uint64(31)
                lists = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * trees, prefixes.reshape(-1).view("<i8"))
                found = pa.array(digests, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("mark"), found, pc.if_else(found.is_valid(), lists, None)],
                    names=["id", "mark", "digest", "prefixes"],
                )

    return docs.select("id", "mark", "text").mapInArrow(lean(run), "id bigint, mark bigint, digest string, prefixes array<bigint>")


def _digest(words: list[bytes]) -> str | None:
    return hashlib.sha256(b" ".join(words)).hexdigest() if words else None


def shared_places(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` (id, tree, prefix) whose prefix another text has, with the prefix's least id as ``least``."""
    # The least id comes from map-side aggregation; the join is the one that a prefix of a third of all rows would fill a task of.
    least = keys.groupBy("tree", "prefix").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # Laid out anew, for only then can adaptive execution split the prefix: it stays as an aggregate left it otherwise.
    return keys.join(least.hint("rebalance"), ["tree", "prefix"]).select("id", "tree", "prefix", F.col("a").alias("least"))


def candidate_links(shared: DataFrame) -> DataFrame:
    """(a, b): each text of a shared prefix with the prefix's least id. As many rows as texts, not pairs."""
    return shared.filter("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()


# ---- connected components -------------------------------------------------------------------------
def components(links: DataFrame, name: str, rounds: int = 50) -> DataFrame:
    """(id, root) for every id of ``links`` (a, b): root is the least id that it hangs together with.

    Alternates large-star and small-star steps, each a map-side combined minimum and a join; every round is
    written to the shared folder.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u <> v").distinct(), name)
    for _ in range(rounds):
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        # Large star: larger neighbours move to the least neighbour.
        large = both.join(least.hint("rebalance"), "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = stored(large.filter("u <> v"), name)
        # Small star: smaller neighbours and the node itself move to the least of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low.hint("rebalance"), "v").select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct(F.col("v"), F.col("m").alias("u")))).alias("e"))
        new = stored(small.select("e.v", "e.u").filter("u <> v").distinct(), name)
        # A star forest: nobody is both a leaf and a root, and every leaf has one root.
        check = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h")).collect()[0]
        before = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h")).collect()[0]
        edges = new
        if check == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("id"), F.col("u").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct())


# ---- exact comparison -----------------------------------------------------------------------------
def similar(left: list[np.ndarray], right: list[np.ndarray], threshold: float, met: np.ndarray, step: int = 8_192) -> np.ndarray:
    """Which of the pairs ``met`` of the two lists of sorted gram arrays reach the threshold (boolean matrices)."""
    sizes_l, sizes_r = (np.array([len(x) for x in side], np.float64) for side in (left, right))
    smaller, larger = np.minimum.outer(sizes_l, sizes_r), np.maximum.outer(sizes_l, sizes_r)
    able = met & (smaller >= threshold * larger - 1e-9)
    if not able.any():
        return able
    rows, columns = np.flatnonzero(able.any(axis=1)), np.flatnonzero(able.any(axis=0))
    if len(rows) < able.shape[0] or len(columns) < able.shape[1]:  # texts that meet nobody take no part
        inner = similar([left[i] for i in rows], [right[j] for j in columns], threshold, able[np.ix_(rows, columns)], step)
        able[np.ix_(rows, columns)] = inner
        return able
    shared = np.zeros(able.shape)
    if able.sum() <= max(8, able.size // 64):
        for i, j in zip(*np.nonzero(able)):
            shared[i, j] = len(np.intersect1d(left[i], right[j], assume_unique=True))
    else:
        values = np.concatenate([*left, *right])
        owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
        _, column, counts = np.unique(values, return_inverse=True, return_counts=True)
        many = counts[column] > 1
        column, owner = np.unique(column[many], return_inverse=True)[1], owner[many]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        width = int(column[-1]) + 1 if len(column) else 0
        for at in range(0, width, step):
            a, b = np.searchsorted(column, (at, at + step))
            grid = np.zeros((len(left) + len(right), step), np.float32)
            grid[owner[a:b], column[a:b] - at] = 1
            shared += grid[: len(left)] @ grid[len(left) :].T
    return able & (shared >= threshold * (sizes_l[:, None] + sizes_r[None, :] - shared) - 1e-9)


def _spanning(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of ids that hang together as all linked pairs do."""
    ids = np.unique(np.concatenate([left, right]))
    parent = {int(x): int(x) for x in ids}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(links)):
        a, b = int(left[i]), int(right[j])
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def compare_groups(texts: DataFrame, groups: DataFrame, places: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, links) of exact comparison of texts that share a prefix: rows with b null add ``links`` to a's number of
    links; rows with both are links enough to span what hangs together.

    a and b are nodes. ``texts`` has id, mark and text; ``groups`` node, id, mark, digest, root and prefixes: the node's text is
    one of that id and mark, and other rows of theirs are passed over. ``places`` (id, tree, prefix) has the node's prefixes. A
    group's texts are laid out in blocks of bounded size; each two blocks that meet are one row of work.
    """
    blocked = stored(_blocks(texts, groups), "neardup-blocks")
    # The blocks that have texts of a prefix meet each other. As many rows as a prefix has blocks, squared, not texts.
    in_block = blocked.select("block", F.explode("ids").alias("id"))
    touched = stored(places.join(in_block.hint("rebalance"), "id").select("tree", "prefix", "block").distinct(), "neardup-touched")
    other = touched.select("tree", "prefix", F.col("block").alias("j")).hint("rebalance")
    meeting = touched.withColumnRenamed("block", "i").join(other, ["tree", "prefix"]).filter("i <= j").select("i", "j").distinct()
    firsts = meeting.join(blocked.withColumnRenamed("block", "i").hint("rebalance"), "i")
    seconds = blocked.select(*[F.col(c).alias(f"{c}2") for c in ("ids", "sizes", "grams", "prefixes")], F.col("block").alias("j"))
    pairs = firsts.join(seconds.hint("rebalance"), "j")
    pairs = pairs.select("i", "j", "ids", "sizes", "grams", "prefixes", "ids2", "sizes2", "grams2", "prefixes2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_out, b_out, n_out = [], [], []
            for row in range(len(batch)):
                get = lambda name: batch.column(name)[row].as_py()  # noqa: B023, E731
                left, ids, places = _unpacked(get("ids"), get("sizes"), get("grams"), get("prefixes"))
                right, ids2, places2 = _unpacked(get("ids2"), get("sizes2"), get("grams2"), get("prefixes2"))
                met = np.zeros((len(ids), len(ids2)), bool)
                for tree in range(places.shape[1]):
                    met |= places[:, None, tree] == places2[None, :, tree]
                if get("i") == get("j"):
                    met = np.triu(met, 1)
                links = similar(left, right, threshold, met)
                for side, counted in ((ids, links.sum(axis=1)), (ids2, links.sum(axis=0))):
                    some = counted > 0
                    a_out.extend(side[some].tolist())
                    b_out.extend([None] * int(some.sum()))
                    n_out.extend(counted[some].tolist())
                for a, b in _spanning(links, ids, ids2):
                    a_out.append(a)
                    b_out.append(b)
                    n_out.append(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64()), pa.array(n_out, pa.int64())], names=["a", "b", "links"]
            )

    return pairs.mapInArrow(lean(run), "a bigint, b bigint, links bigint")


def _unpacked(ids: list[int], sizes: bytes, grams: bytes, prefixes: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    counts = np.frombuffer(sizes, "<i8")
    return np.split(np.frombuffer(grams, "<u8"), np.cumsum(counts)[:-1]), np.array(ids), np.frombuffer(prefixes, "<i8").reshape(len(ids), -1)


def _blocks(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """(block, ids, sizes, grams, prefixes): a group's texts, so many in each row; ids are nodes, blocks are numbered.

    Texts of a group are spread over slices by a hash of the node, each small by the group's own size; a slice is cut
    further where its grams are many. Groups of few texts share a block.
    """
    sizes = groups.groupBy("root").agg(F.count("*").alias("n"))
    many = F.ceil(F.col("n") / (BLOCK_TEXTS * 0.75))
    sliced = groups.join(sizes.hint("rebalance"), "root").select(
        "node", "id", "mark", "digest", "root", "prefixes", F.pmod(F.xxhash64("node"), many).cast("int").alias("slice")
    )
    # Always by shuffle: the members grow with the texts.
    members = texts.join(sliced.hint("merge"), ["id", "mark"]).select("root", "slice", "node", "digest", "prefixes", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        number, held, total, last = TaskContext.get().partitionId() << 40, [], 0, None

        def row():
            nonlocal number
            number += 1
            return {
                "block": number, "ids": [k for k, _, _ in held], "sizes": np.array([len(g) for _, g, _ in held], "<i8").tobytes(),
                "grams": b"".join(g.tobytes() for _, g, _ in held), "prefixes": np.array([p for _, _, p in held], "<i8").tobytes(),
            }

        for batch in batches:
            out = []
            for part in slices(batch, "text"):
                for key, digest, text, places in zip(*(part.column(c).to_pylist() for c in ("node", "digest", "text", "prefixes"))):
                    words = byte_words(text)
                    if _digest(words) != digest or key == last:
                        continue
                    last = key
                    grams = hasher.grams(words)
                    if held and (len(held) >= BLOCK_TEXTS or total + len(grams) > BLOCK_GRAMS):
                        out.append(row())
                        held, total = [], 0
                    held.append((key, grams, places))
                    total += len(grams)
            yield pa.RecordBatch.from_pylist(out, schema=shape)
        if held:
            yield pa.RecordBatch.from_pylist([row()], schema=shape)

    shape = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("grams", pa.binary()), ("prefixes", pa.binary())])
    ordered = members.repartition("root", "slice").sortWithinPartitions("root", "slice", "node")
    return ordered.mapInArrow(lean(pack), "block bigint, ids array<bigint>, sizes binary, grams binary, prefixes binary")


# ---- the operator ----------------------------------------------------------------------------------
def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL, threshold: float = THRESHOLD, with_digest: bool = False) -> DataFrame:
    """One row for each row of ``docs``: key, class_id, copy_id and n_links.

    copy_id is the least key with the same words in the same order; class_id the least key of all texts that hang together by
    links; n_links the number of other texts (sequences of words) whose 5-grams have Jaccard similarity ``threshold`` or more
    with this one's. Texts are compared, not keys: different texts under one key each have their own links and class.
    A text without words (null, empty) is no duplicate of another: its ids are its own key. A null key
    keeps its row; such a row takes part only if its words are also under a key. Repeated rows are copies.
    ``with_digest`` adds the words' digest, and first: whether the text stands for its class, the least digest under the least key.
    """
    rows = docs.select(docs[key].cast("bigint").alias("id"), docs[text].cast("string").alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    sketched = stored(sketches(rows, recall=recall, threshold=threshold), "neardup-sketches")
    # One key for each distinct sequence of words, by map-side combined minima.
    worded = sketched.filter("digest IS NOT NULL AND id IS NOT NULL").select("id", "digest")
    least = worded.groupBy("digest").agg(F.min("id").alias("copy_id"))
    # A node for each sequence of words, numbered in the order of key and digest: the least node of a class has its least key.
    nodes = least.orderBy("copy_id", "digest").select("digest", "copy_id", F.monotonically_increasing_id().alias("node"))
    nodes = stored(nodes, "neardup-nodes")
    keyed = nodes.withColumnRenamed("copy_id", "id")
    places = sketched.join(keyed, ["id", "digest"]).select(F.col("node").alias("id"), F.posexplode("prefixes").alias("tree", "prefix"))
    shared = stored(shared_places(places), "neardup-places")
    links = candidate_links(shared)
    texts = rows.filter("id IS NOT NULL")
    groups = components(links, "neardup-candidates").withColumnRenamed("id", "node").join(keyed, "node")
    # A key may have many texts: they are fetched by key and mark, the least mark of the texts with the node's words.
    groups = sketched.select("id", "digest", "mark", "prefixes").join(groups, ["id", "digest"])
    groups = groups.groupBy("node", "id", "digest", "root").agg(F.min("mark").alias("mark"), F.min("prefixes").alias("prefixes"))
    groups = stored(groups, "neardup-groups")
    compared = stored(compare_groups(texts, groups, shared, threshold), "neardup-compared")
    classes = components(compared.filter("b IS NOT NULL").select("a", "b"), "neardup-links").withColumnRenamed("id", "node")
    classes = classes.join(nodes.select(F.col("node").alias("root"), F.col("copy_id").alias("class_id")), "root")
    counts = compared.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links"))
    known = stored(nodes.join(classes, "node", "left").join(counts, "node", "left"), "neardup-classes")
    return sketched.select("id", "digest").join(known, "digest", "left").select(
        F.col("id").alias(key),
        F.coalesce("class_id", "copy_id", "id").alias("class_id"),
        F.coalesce("copy_id", "id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        *["digest", F.coalesce(F.col("root") == F.col("node"), F.lit(True)).alias("first")] * with_digest,
    )


def word_digest(text: Column) -> Column:
    """A digest of the words in their order; null for a text without words."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    joined = F.trim(F.regexp_replace(lowered, BETWEEN, " "))
    return F.when(joined != "", F.sha2(joined, 256))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one row of each class of near duplicates is kept: the one with the least key,
    and of several texts under that key the one with the least digest.

    Rows without words stay, all of them. Rows with a null key stay if nothing with a key has their words, one for
    each sequence of words; of rows that repeat key and words one stays.
    """
    classes = stored(near_duplicates(docs, key, text, with_digest=True), "neardup-rows")
    stands = F.col("digest").isNotNull() & F.col("first") & F.col(key).eqNullSafe(F.col("class_id"))
    stay = classes.filter(stands).groupBy(F.col(key).alias("k"), F.col("digest").alias("d")).count()
    stay = stored(stay, "neardup-stay")
    # The rows travel as a struct, so their columns may have any names.
    rows = docs.select(
        F.struct(*[docs[c].alias(c) for c in docs.columns]).alias("row"),
        docs[key].cast("bigint").alias("key"),
        word_digest(docs[text].cast("string")).alias("digest"),
    )
    matched = F.col("key").eqNullSafe(F.col("k")) & (F.col("digest") == F.col("d"))
    kept = rows.filter("digest IS NOT NULL").join(stay.select("k", "d"), matched, "left_semi")
    if stay.filter("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["key", "digest"])
    return kept.unionByName(rows.filter("digest IS NULL")).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
