"""Exact top-k by inner product with a pivot-distance index.

Vectors of whole numbers get one more coordinate that makes all their lengths equal, so that the largest inner product is
the least Euclidean distance. Each vector belongs to its nearest pivot and is keyed by its distance from it; a
pivot's vectors, sorted by distance, are cut into annuli. For a query, an annulus cannot hold a vector nearer than the
triangle inequality allows: queries visit the annulus with the best bound first, and then only those whose bound still
reaches their k-th best score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import stored

# Parameters: pivots are fitted on about PIVOT_SAMPLE vectors (chosen by a hash of the vector); all vectors are indexed.
PIVOTS, ANNULI, PIVOT_SAMPLE = 24, 32, 4_096  # annuli of a pivot at least, see annuli_for
BLOCK = 2_048  # vectors in a row of the index
QUERIES = 256  # queries in a row of work
SCALE = 1_024


def usable_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x, wide): rows whose components are all finite numbers, one at least.

    The operator's whole numbers are floor(scale * x). A vector is wide if one of them is so large that sums of products
    could leave what doubles hold exactly; the index has the others.
    """
    rows = table.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    good = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.filter(F.col("id").isNotNull() & (F.size("x") > 0)).filter(F.coalesce(good, F.lit(False)))
    largest = F.array_max(F.transform("x", F.abs)) * scale + 1
    return kept.select("id", "x", (largest > F.sqrt(F.lit(float(2**52)) / F.size("x"))).alias("wide")).dropDuplicates(["id", "x"])


def whole_vectors(narrow: DataFrame, scale: int = SCALE) -> DataFrame:
    """(id, v): the whole numbers of vectors that are not wide, a repeated row once."""
    return narrow.select("id", F.transform("x", lambda x: F.floor(x * scale).cast("bigint")).alias("v")).dropDuplicates(["id", "v"])


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """(v, ids): distinct vectors with their k + 1 least ids, all that a top-k can need of equal vectors.

    The row numbers are limited before the shuffle, so a vector that a third of all rows share sends few rows.
    """
    nth = F.row_number().over(W.partitionBy("v").orderBy("id"))
    first = vectors.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def fit_pivots(sample: np.ndarray, pivots: int = PIVOTS, rounds: int = 8) -> np.ndarray:
    """Centres of the sample, by a few rounds of nearest-centre averaging from spread-out starts."""
    sample = sample.astype(np.float64)
    chosen = [0]
    nearest = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(pivots, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    centres = sample[chosen]
    for _ in range(rounds):
        owner = _square_distances(sample, centres).argmin(axis=1)
        for p in range(len(centres)):
            if (owner == p).any():
                centres[p] = sample[owner == p].mean(axis=0)
    return centres


def _square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T, 0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, width)


def annuli_for(count: int, pivots: int = PIVOTS) -> int:
    """Annuli of a pivot: with the square root of the vectors, so that a query's bounds and its visits grow alike."""
    return max(ANNULI, math.isqrt(count // (8 * pivots)))


def build_index(vectors: DataFrame, width: int, longest: int, pivots: np.ndarray, annuli: int = ANNULI) -> tuple[DataFrame, dict]:
    """(blocks, rings): blocks (ring, n, mat, sizes, ids) hold all vectors; rings bounds each annulus.

    ``longest`` is the greatest squared length. Annuli are cut at quantiles of the distance from the pivot; there are
    pivots * annuli of them, and one has as many blocks as it needs.
    """
    sent = vectors.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                pivot, distance = nearest_pivot(_matrix(batch.column("v"), width), sent.value, longest)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(distance)], names=["v", "ids", "pivot", "distance"])

    keyed = stored(vectors.mapInArrow(assign, "v array<bigint>, ids array<bigint>, pivot int, distance double"), "pivot-keys")
    # The pivots times the annuli, at most, come back.
    cuts = keyed.groupBy("pivot").agg(F.percentile_approx("distance", [i / annuli for i in range(1, annuli)], 4 * max(250, annuli)).alias("cuts"))
    edges = {r["pivot"]: np.unique(r["cuts"]) for r in cuts.collect()}

    def ring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, distance = np.asarray(batch.column("pivot")), np.asarray(batch.column("distance"))
            number = np.zeros(len(batch), np.int32)
            for p in np.unique(pivot):
                number[pivot == p] = np.searchsorted(edges[int(p)], distance[pivot == p], side="left")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot * (annuli + 1) + number)], names=["v", "ids", "pivot", "distance", "ring"])

    ringed = keyed.mapInArrow(ring, "v array<bigint>, ids array<bigint>, pivot int, distance double, ring int")
    # Ranges of ring and distance: a ring may span several tasks.
    ordered = ringed.repartitionByRange("ring", "distance", F.col("ids")[0]).sortWithinPartitions("ring", "distance")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings = np.asarray(batch.column("ring"))
            starts = np.flatnonzero(np.concatenate([[True], rings[1:] != rings[:-1]])).tolist() if len(rings) else []
            out = []
            for a, b in zip(starts, [*starts[1:], len(rings)]):
                for at in range(a, b, BLOCK):
                    part = batch.slice(at, min(BLOCK, b - at))
                    distance = np.asarray(part.column("distance"))
                    ids = part.column("ids")
                    out.append(
                        {
                            "ring": int(rings[at]), "low": float(distance.min()), "high": float(distance.max()), "n": len(part),
                            "mat": _matrix(part.column("v"), width).astype("<i4").tobytes(),
                            "sizes": np.asarray(pa.compute.list_value_length(ids), "<i4").tobytes(),
                            "ids": np.asarray(ids.flatten(), "<i8").tobytes(),
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, schema=shape)

    shape = pa.schema(
        [("ring", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("n", pa.int32()), ("mat", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())]
    )
    packed = ordered.mapInArrow(pack, "ring int, low double, high double, n int, mat binary, sizes binary, ids binary")
    blocks = stored(packed, "pivot-blocks")
    bounds = blocks.groupBy("ring").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("ring").collect()
    rings = {
        "ring": np.array([r["ring"] for r in bounds], np.int32), "pivot": np.array([r["ring"] // (annuli + 1) for r in bounds], np.int64),
        "low": np.array([r["low"] for r in bounds]), "high": np.array([r["high"] for r in bounds]),
    }
    return blocks, rings


def nearest_pivot(v: np.ndarray, pivots: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each lengthened vector, and its distance. Pivots have 0 in the added coordinate."""
    added = np.maximum(longest - (v**2).sum(axis=1), 0).astype(np.float64)
    square = _square_distances(v.astype(np.float64), pivots) + added[:, None]
    pivot = square.argmin(axis=1).astype(np.int32)
    return pivot, np.sqrt(square[np.arange(len(v)), pivot])


def best_scores(queries: np.ndarray, pivots: np.ndarray, rings: dict, longest: int) -> np.ndarray:
    """(queries x rings) the most that a vector of the ring can score, rounded up a little for safety."""
    q = queries.astype(np.float64)
    squares = (q**2).sum(axis=1)
    to_pivot = np.sqrt(_square_distances(q, pivots))[:, rings["pivot"]]
    gap = np.maximum(0, np.maximum(to_pivot - rings["high"], rings["low"] - to_pivot))
    return (squares[:, None] + longest - gap**2) / 2 + 1 + 1e-9 * (squares[:, None] + longest)


def search(blocks: DataFrame, rings: dict, queries: DataFrame, pivots: np.ndarray, width: int, longest: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each query; ``queries`` has id and v.

    Two rounds: the most promising annulus gives each query a score to beat, the second visits every other
    annulus that may still hold a better one.
    """
    spark = queries.sparkSession
    held = spark.sparkContext.broadcast((pivots, rings))  # pivots * annuli rows

    def first(batches):
        yield from _visits(batches, held.value, width, longest, True)

    def rest(batches):
        yield from _visits(batches, held.value, width, longest, False)

    shape = "ring int, query_id bigint, v array<bigint>, floor bigint"
    opened = queries.withColumn("floor", F.lit(None).cast("bigint")).mapInArrow(first, shape)
    found = stored(_scores(opened, blocks, width, k), "pivot-first")
    floors = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor")).filter(F.col("n") >= k)
    again = queries.join(floors.select(F.col("query_id").alias("id"), "floor"), "id", "left").mapInArrow(rest, shape)
    more = _scores(again, blocks, width, k)
    return _best(found.unionByName(more), k)


def _visits(batches, held, width, longest, opening: bool) -> Iterator[pa.RecordBatch]:
    """A row for each query and annulus it visits; ``floor`` is the score to reach."""
    pivots, rings = held
    for batch in batches:
        for at in range(0, len(batch), QUERIES):
            part = batch.slice(at, QUERIES)
            bound = best_scores(_matrix(part.column("v"), width), pivots, rings, longest)
            best = bound.argmax(axis=1)
            visit = np.zeros(bound.shape, bool)
            visit[np.arange(len(part)), best] = True
            if not opening:
                floor = np.array([-np.inf if x is None else x for x in part.column("floor").to_pylist()])
                visit = ~visit & (bound >= floor[:, None])
            row, ring = np.nonzero(visit)
            take = part.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rings["ring"][ring]), take.column("id"), take.column("v"), take.column("floor")], names=["ring", "query_id", "v", "floor"]
            )


def _scores(visits: DataFrame, blocks: DataFrame, width: int, k: int) -> DataFrame:
    """The k best of each query in each block it visits that reach its floor."""
    # Queries of an annulus travel in groups, each group in one row for each block of the annulus.
    group = F.pmod(F.xxhash64("query_id"), F.greatest(F.lit(1), F.ceil(F.col("n") / QUERIES))).cast("int")
    visits = stored(visits, "pivot-visits")
    sized = visits.groupBy("ring").agg(F.count("*").alias("n"))
    grouped = (
        visits.join(F.broadcast(sized), "ring")  # pivots * annuli rows
        .groupBy("ring", group.alias("g"))
        .agg(F.collect_list(F.struct("query_id", "v", "floor")).alias("queries"))
        .select("ring", F.col("queries.query_id").alias("q"), F.flatten("queries.v").alias("qv"), F.transform("queries.floor", lambda x: F.coalesce(x, F.lit(-(2**62)))).alias("floors"))
    )
    work = grouped.join(blocks.select("ring", "mat", "sizes", "ids"), "ring")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                cell = lambda name: batch.column(name)[i]  # noqa: B023, E731
                mat = np.frombuffer(cell("mat").as_py(), "<i4").reshape(-1, width)
                sizes = np.frombuffer(cell("sizes").as_py(), "<i4")
                ids = np.frombuffer(cell("ids").as_py(), "<i8")
                q = np.asarray(cell("q").values, np.int64)
                qv = np.asarray(cell("qv").values, np.int64).reshape(-1, width)
                yield _block_best(q, qv, np.asarray(cell("floors").values, np.int64), mat, sizes, ids, k)

    return _best(work.select("q", "qv", "floors", "mat", "sizes", "ids").mapInArrow(run, "query_id bigint, vec_id bigint, score bigint"), k)


def _block_best(q, qv, floors, mat, sizes, ids, k: int) -> pa.RecordBatch:
    """Exact scores of a group of queries against a block; integers of up to 2^53 are exact in doubles."""
    scores = _exact_products(qv, mat)
    starts = np.cumsum(sizes) - sizes
    out_q, out_v, out_s = [], [], []
    m = min(k + 1, mat.shape[0])  # the query's own vector may be one
    for i in range(len(q)):
        row = scores[i]
        cut = max(int(floors[i]), int(np.partition(row, len(row) - m)[len(row) - m]))
        picked = np.flatnonzero(row >= cut)
        each = sizes[picked]
        vec = ids[np.repeat(starts[picked] - np.cumsum(each) + each, each) + np.arange(each.sum())]
        value = np.repeat(row[picked], each)
        other = vec != q[i]
        vec, value = vec[other], value[other]
        order = np.lexsort((vec, -value))[:k]
        out_q.append(np.full(len(order), q[i]))
        out_v.append(vec[order])
        out_s.append(value[order])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (out_q, out_v, out_s)], names=["query_id", "vec_id", "score"])


def _exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: in doubles where no sum can exceed 2^53, else in 64-bit integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _best(scores: DataFrame, k: int) -> DataFrame:
    nth = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scores.withColumn("nth", nth).filter(F.col("nth") <= k).drop("nth")


# ---- wide vectors ---------------------------------------------------------------------------------
def _whole(x: float, scale: int = SCALE) -> int:
    """floor(scale * x) of any finite double; beyond a double's range x is a whole number itself."""
    scaled = x * scale
    return int(x) * scale if math.isinf(scaled) else math.floor(scaled)


def _distinct(ids: list[int], rows: list[list[float]]) -> tuple[list[int], np.ndarray]:
    """The ids and their vectors of whole numbers, repeated rows once."""
    found = list(dict.fromkeys((key, tuple(map(_whole, x))) for key, x in zip(ids, rows)))
    return [key for key, _ in found], np.array([v for _, v in found], object)


_MOST = 10**38 - 1


def exact_scores(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score decimal): the k best by whole numbers of any size, of vectors (id, x) as long as the query.

    Groups of queries meet groups of candidates, each pair in a row of work. Scores of more than 38 digits count as the
    greatest, or least, that have 38.
    """
    sizes = [max(1, -(-side.count() // 256)) for side in (queries, candidates)]
    grouped = [
        side.groupBy(F.size("x").alias("width"), F.pmod(F.xxhash64("id"), F.lit(n)).alias(f"g{i}"))
        .agg(F.collect_list("id").alias(f"id{i}"), F.collect_list("x").alias(f"x{i}"))
        for i, (side, n) in enumerate(zip((queries, candidates), sizes))
    ]
    every = grouped[0].withColumn("g1", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(sizes[1] - 1).cast("bigint"))))
    work = every.join(grouped[1].hint("merge"), ["width", "g1"]).select("id0", "x0", "id1", "x1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids, xs, others, ys in zip(*(batch.column(c).to_pylist() for c in ("id0", "x0", "id1", "x1"))):
                (ids, a), (others, b) = _distinct(ids, xs), _distinct(others, ys)
                for query, row in zip(ids, a @ b.T):
                    best = sorted((-int(s), other) for s, other in zip(row, others) if other != query)[:k]
                    out += [(query, other, Decimal(max(-_MOST, min(_MOST, -s)))) for s, other in best]
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["query_id", "vec_id", "score"])

    types = (pa.int64(), pa.int64(), pa.decimal128(38, 0))
    return _best(work.mapInArrow(run, "query_id bigint, vec_id bigint, score decimal(38,0)"), k)


# ---- the operator ---------------------------------------------------------------------------------
def _indexed(vectors: DataFrame, is_query, k: int, width: int) -> DataFrame:
    """(query_id, vec_id, score) among the vectors (id, v) of one length."""
    square = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s + x * x)
    known = vectors.agg(F.max(square).alias("longest"), F.count("*").alias("n")).collect()[0]
    share = min(1.0, PIVOT_SAMPLE / known["n"])
    sample = vectors.select("v").distinct() if share == 1 else vectors.filter(F.pmod(F.xxhash64("v"), F.lit(1_000_000)) < int(share * 1_000_000)).select("v").distinct()
    rows = sample.orderBy(F.xxhash64("v"), "v").limit(2 * PIVOT_SAMPLE).collect()
    if not rows:  # the hash may choose none of a few distinct vectors
        rows = vectors.select("v").limit(1).collect()
    pivots = fit_pivots(np.array([r["v"] for r in rows], np.int64))
    blocks, rings = build_index(classes(vectors, k), width, known["longest"], pivots, annuli_for(known["n"]))
    return search(blocks, rings, vectors.filter(is_query), pivots, width, known["longest"], k)


def top_k(table: DataFrame, is_query, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for every row where ``is_query`` (a condition on ``id``) holds, against all other rows.

    Ties go to the smaller id. A vector is scored against those of its own length, each length in an index of its own. Vectors with
    components so large that 64 bits might not do are compared in whole numbers of any size; a score beyond
    64 bits is ranked by its value and given as the greatest, or least, that 64 bits hold. Rows without a key or with
    a null or non-finite component take no part; a repeated row is one candidate. Fewer than k candidates are all returned; an
    empty table has no rows.
    """
    spark = table.sparkSession
    usable = stored(usable_vectors(table, key, vector), "pivot-usable")
    vectors = stored(whole_vectors(usable.filter("NOT wide")), "pivot-vectors")
    found = spark.createDataFrame([], "query_id bigint, vec_id bigint, score decimal(38,0)")
    for row in vectors.groupBy(F.size("v").alias("width")).count().orderBy("width").collect():  # a row for each length
        one = _indexed(vectors.filter(F.size("v") == row["width"]), is_query, k, row["width"])
        found = found.unionByName(one.withColumn("score", F.col("score").cast("decimal(38,0)")))
    wide = usable.filter("wide")
    if not wide.isEmpty():
        asked = usable.filter(is_query)
        found = found.unionByName(exact_scores(asked.filter("NOT wide"), wide, k)).unionByName(exact_scores(asked.filter("wide"), usable, k))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)
    bounded = F.greatest(F.lit(-(2**63)).cast("decimal(38,0)"), F.least(F.lit(2**63 - 1).cast("decimal(38,0)"), F.col("score")))
    return best.select("query_id", "rank", "vec_id", bounded.cast("bigint").alias("score"))
