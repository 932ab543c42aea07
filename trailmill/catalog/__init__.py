"""Registered queries over a folder of generic tables, each with an SQL statement to check it by.

A query is ``(spark, folder) -> DataFrame`` and runs over the whole tables in the folder.
"""

from . import batch, scalar, streams
from .oracles import ORACLES

QUERIES = {**batch.QUERIES, **scalar.QUERIES, **streams.QUERIES}

__all__ = ["ORACLES", "QUERIES"]
