"""Session filters of many tasks at once: parameters are a table, and the sessions are rolled up and read once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import jsons


def _listed(name: str) -> Column:
    """A parameter's comma-joined list without empty parts; null if it is not given."""
    text = F.nullif(jsons.task_param("task_param", name), F.lit(""))
    return F.array_remove(F.split(text, ","), "")


def _number(name: str) -> Column:
    return F.nullif(jsons.task_param("task_param", name), F.lit("")).cast("int")


def task_filters(tasks: DataFrame) -> DataFrame:
    """The session predicates of tasks ``task_id, task_param`` (JSON), one row each; null where a task asks for none."""
    return tasks.select(
        F.col("task_id").cast("bigint").alias("task_id"),
        _number("startAge").alias("start_age"),
        _number("endAge").alias("end_age"),
        _listed("professionals").alias("professionals"),
        _listed("cities").alias("cities"),
        _listed("sex").alias("sex"),
        _listed("keywords").alias("keywords"),
        _listed("categoryIds").cast("array<bigint>").alias("category_ids"),
        jsons.task_param("task_param", "startDate").alias("start_date"),
        jsons.task_param("task_param", "endDate").alias("end_date"),
    )


def _passes(t: Column) -> Column:
    def within(value: Column, low: Column, high: Column) -> Column:
        return low.isNull() | high.isNull() | value.between(low, high)

    def one_of(value: Column, allowed: Column) -> Column:
        return allowed.isNull() | F.array_contains(allowed, value)

    def any_of(values: Column, allowed: Column) -> Column:
        return allowed.isNull() | F.arrays_overlap(values, allowed)

    return (
        within(F.col("age"), t["start_age"], t["end_age"])
        & one_of(F.col("professional"), t["professionals"])
        & one_of(F.col("city"), t["cities"])
        & one_of(F.col("sex"), t["sex"])
        & any_of(F.col("search_keywords"), t["keywords"])
        & any_of(F.col("click_category_ids"), t["category_ids"])
    )


def filter_by_task(sessions: DataFrame, tasks: DataFrame) -> DataFrame:
    """``task_id`` and the session's columns, for each task a session passes.

    The tasks' parameters are one small array; each session meets all of them in the pass that made it: no join, no shuffle, and the
    sessions are not read once for each task. Ages are inclusive and tested only if both are given; a missing value or an empty
    list passes no predicate that is given. The tasks share the sessions, hence their dates: a task's dates are the caller's matter.
    """
    filters = task_filters(tasks)
    wanted = filters.agg(F.collect_list(F.struct(*filters.columns)).alias("tasks")).scalar()
    met = sessions.withColumn("__tasks", wanted).withColumn("__task", F.explode("__tasks"))
    return met.where(_passes(F.col("__task"))).select(F.col("__task.task_id").alias("task_id"), *sessions.columns)
