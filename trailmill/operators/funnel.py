"""Page flows: consecutive page pairs and step-to-step conversion."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..functions import numbers
from ..params import PageFlow
from ..sources.tables import with_event_time

_HELD_PAIRS = 100_000
_COUNTS = "from_page bigint, to_page bigint, visits bigint, pairs bigint"
_EDGE = "struct<part: int, first_session: string, first_page: bigint, last_session: string, last_page: bigint>"


def _count_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by page and next page in one range of the visits (session_id, page_id), sorted; then the range's edge.

    The last visit of the range is counted without a next page, which is the next range's business.
    """
    edge, tail, counted = None, None, []
    shape = pa.schema([("from_page", pa.int64()), ("to_page", pa.int64()), ("visits", pa.int64()), ("pairs", pa.int64())])
    edge_type = pa.struct(
        [("part", pa.int32()), ("first_session", pa.string()), ("first_page", pa.int64()), ("last_session", pa.string()), ("last_page", pa.int64())]
    )

    def summed(parts: list[pa.Table]) -> pa.Table:
        grouped = pa.concat_tables(parts).group_by(["from_page", "to_page"], use_threads=False)
        return grouped.aggregate([("visits", "sum"), ("pairs", "sum")]).rename_columns(shape.names)

    def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for batch in table.cast(shape).to_batches(max_chunksize=10_000):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(len(batch), edge_type)], names=[*shape.names, "edge"])

    for batch in batches:
        if not len(batch):
            continue
        session, page = batch.column("session_id"), batch.column("page_id")
        if tail is not None:
            session, page = pa.concat_arrays([tail[0], session]), pa.concat_arrays([tail[1], page])
        if edge is None:
            edge = {"part": TaskContext.get().partitionId(), "first_session": session[0].as_py(), "first_page": page[0].as_py()}
        # Every row but the last, which waits for the next batch.
        follows = pc.equal(session[1:], session[:-1])
        pairs = pa.table(
            {
                "from_page": page[:-1],
                "to_page": pc.if_else(follows, page[1:], pa.scalar(None, pa.int64())),
                "visits": pa.array(np.ones(len(page) - 1, np.int64)),
                "pairs": follows.cast(pa.int64()),
            }
        )
        counted.append(summed([pairs]))
        if sum(map(len, counted)) > _HELD_PAIRS:
            counted = [summed(counted)]
            if len(counted[0]) > _HELD_PAIRS // 2:
                yield from rows(counted.pop())
        tail = session[-1:], page[-1:]
    if edge is not None:
        edge |= {"last_session": tail[0][0].as_py(), "last_page": tail[1][0].as_py()}
        alone = pa.table({"from_page": tail[1], "to_page": pa.nulls(1, pa.int64()), "visits": [1], "pairs": [0]})
        yield from rows(summed([*counted, alone]))
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * 4 + [pa.array([edge], edge_type)], names=[*shape.names, "edge"])


def visit_ranges(actions: DataFrame) -> DataFrame:
    """``session_id, ts, [event_id,] page_id`` in ranges of that order, each sorted; rows without a session id are left out."""
    tie = ["event_id"] if "event_id" in actions.columns else []
    order = ["session_id", "ts", *tie, "page_id"]
    visits = with_event_time(actions).where(F.col("session_id").isNotNull()).select(*order)
    return visits.repartitionByRange(*order).sortWithinPartitions(*order)


def page_steps(actions: DataFrame) -> DataFrame:
    """``from_page, to_page, visits, pairs``, small counts by page.

    ``pairs`` counts how often ``to_page`` followed; the ``visits`` of a page sum up over its rows. Sessions are ordered by time, then by
    ``event_id`` where there is one, else by page. Rows without a session id belong to no session.

    A window by session would order a session holding a third of all rows in one task. The visits are dealt into ranges of
    (session, time, id) instead, which may cut a session anywhere, even within one moment. Each range counts its own pairs in
    Arrow arrays and hands on its first and last visit; the pairs across the cuts come from these, one row for each range.
    The actions are shuffled once, and a range holds no more than its share of them.
    """
    counted = visit_ranges(actions).select("session_id", "page_id").mapInArrow(_count_range, f"{_COUNTS}, edge {_EDGE}")
    # The edges, a row for each range, meet in the group without pages.
    summed = counted.groupBy("from_page", "to_page").agg(
        F.sum("visits").alias("visits"), F.sum("pairs").alias("pairs"), F.array_sort(F.collect_list("edge")).alias("edges")
    )
    edges = F.col("edges")
    across = F.transform(
        F.sequence(F.lit(2), F.greatest(F.size(edges), F.lit(2))),
        lambda i: F.struct(F.element_at(edges, i - 1).alias("a"), F.try_element_at(edges, i).alias("b")),
    )
    met = F.filter(across, lambda x: x["a"]["last_session"] == x["b"]["first_session"])
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    own = F.struct(F.col("from_page"), F.col("to_page"), F.col("visits"), F.col("pairs"))
    stitched = F.transform(
        F.when(F.size(edges) > 1, met),
        lambda x: F.struct(
            x["a"]["last_page"].alias("from_page"), x["b"]["first_page"].alias("to_page"), zero.alias("visits"), one.alias("pairs")
        ),
    )
    rows = summed.select(F.explode(F.concat(F.array(own), F.coalesce(stitched, F.array().cast(f"array<struct<{_COUNTS}>>")))).alias("x"))
    return (
        rows.select("x.*")
        .where(F.col("visits").isNotNull())
        .groupBy("from_page", "to_page")
        .agg(F.sum("visits").alias("visits"), F.sum("pairs").alias("pairs"))
    )


def page_pairs(actions: DataFrame) -> DataFrame:
    """``from_page, to_page, pv``: how often a page was followed by another within a session."""
    steps = page_steps(actions).where("pairs > 0")
    return steps.select("from_page", "to_page", F.col("pairs").alias("pv"))


def page_visits(actions: DataFrame) -> DataFrame:
    """``page_id, pv``."""
    return actions.groupBy("page_id").agg(F.count("*").alias("pv"))


def start_page_visits(actions: DataFrame, flow: PageFlow) -> DataFrame:
    """One row: visits of the first page of the flow."""
    return actions.agg(F.count_if(F.col("page_id") == flow.start).alias("start_pv"))


def flow_pairs(pairs: DataFrame, flow: PageFlow) -> DataFrame:
    """The pairs that are steps of the flow; a step nobody made is absent."""
    is_step = [
        (F.col("from_page") == a) & (F.col("to_page") == b) for a, b in sorted(set(flow.steps))
    ]
    return pairs.where(reduce(lambda x, y: x | y, is_step))


def conversion_rates(pairs: DataFrame, visits: DataFrame, flow: PageFlow) -> DataFrame:
    """``step, page_split, pv, base_pv, convert_rate``, one row per step of the flow.

    A step's base is the step before it; the first step's is the visits of the start page. Both
    inputs are small counts by page, so one global aggregate lines the whole flow up in a row.
    A page pair that occurs twice in the flow gets a row for each place it holds.
    """
    counts = pairs.select("from_page", "to_page", "pv").unionByName(
        visits.select(
            F.col("page_id").alias("from_page"),
            F.lit(None).cast("bigint").alias("to_page"),
            "pv",
            F.lit(True).alias("visit"),
        ),
        allowMissingColumns=True,
    )

    return _rates(counts, flow)


def rates_of_steps(steps: DataFrame, flow: PageFlow) -> DataFrame:
    """:func:`conversion_rates` of :func:`page_steps`, which reads the actions once."""
    no_page, yes = F.lit(None).cast("bigint"), F.lit(True)
    rows = F.array(
        F.struct(F.col("from_page"), F.col("to_page"), F.col("pairs").alias("pv"), F.lit(None).cast("boolean").alias("visit")),
        F.struct(F.col("from_page"), no_page.alias("to_page"), F.col("visits").alias("pv"), yes.alias("visit")),
    )
    return _rates(steps.select(F.inline(rows)), flow)


def _rates(counts: DataFrame, flow: PageFlow) -> DataFrame:
    def total(test):
        return F.coalesce(F.sum(F.when(test, F.col("pv"))), F.lit(0).cast("bigint"))

    start = total(F.col("visit") & (F.col("from_page") == flow.start)).alias("pv_0")
    steps = [
        total(
            F.col("visit").isNull() & (F.col("from_page") == a) & (F.col("to_page") == b)
        ).alias(f"pv_{number}")
        for number, (a, b) in enumerate(flow.steps, 1)
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(number).alias("step"),
                F.lit(f"{a}_{b}").alias("page_split"),
                F.col(f"pv_{number}").alias("pv"),
                F.col(f"pv_{number - 1}").alias("base_pv"),
            )
            for number, (a, b) in enumerate(flow.steps, 1)
        ]
    )
    rates = counts.agg(start, *steps).select(F.inline(rows))
    return rates.withColumn("convert_rate", numbers.ratio("pv", "base_pv"))


def encode_rates(rates: DataFrame) -> DataFrame:
    """One row ``convert_rate``: ``1_2=0.5|2_3=0.3``, in flow order."""
    steps = F.array_sort(F.collect_list(F.struct("step", "page_split", "convert_rate")))
    texts = F.transform(
        steps, lambda s: F.concat(s["page_split"], F.lit("="), s["convert_rate"].cast("string"))
    )
    return rates.agg(F.array_join(texts, "|").alias("convert_rate"))
