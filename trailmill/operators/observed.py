"""Counts taken while rows pass, instead of by jobs of their own."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


class Watch:
    """Observes the rows of several stages of one plan. What it saw is known once the plan has run to its end.

    The counts come from the tasks whose results counted, so a task that ran twice is counted once. A watched stage
    sees every row the stages after it ask for: filters behind it are not moved before it.
    """

    def __init__(self) -> None:
        self._stages: dict[str, tuple[Observation, DataFrame, list[Column]]] = {}

    def see(self, name: str, rows: DataFrame, *metrics: Column) -> DataFrame:
        """``rows``, observed: aggregates with an alias each."""
        seen = Observation(name)
        self._stages[name] = (seen, rows, list(metrics))
        return rows.observe(seen, *metrics)

    def count(self, name: str, rows: DataFrame) -> DataFrame:
        return self.see(name, rows, F.count(F.lit(1)).alias("n"))

    def got(self, name: str) -> dict[str, object]:
        """The metrics of a stage. If Spark, finding some input empty, left the stage out of the plan, they are counted now."""
        seen, rows, metrics = self._stages[name]
        try:
            found = seen.get
        except Py4JJavaError:  # there is no row of metrics to read
            found = None
        return found or rows.agg(*metrics).first().asDict()

    def counts(self, spark: SparkSession) -> DataFrame:
        """``stage, n`` of the stages that :meth:`count` watches."""
        return spark.createDataFrame([(name, self.got(name)["n"]) for name in self._stages], "stage string, n bigint")


def run(rows: DataFrame) -> None:
    """Run a plan for what is observed on its way."""
    rows.write.format("noop").mode("overwrite").save()
