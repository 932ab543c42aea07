"""Operators: functions from DataFrames to DataFrames."""

from . import ads, bloom, categories, funnel, histograms, observed, products, ranking, sampling, sessions, tasks

__all__ = [
    "ads",
    "bloom",
    "categories",
    "funnel",
    "histograms",
    "observed",
    "products",
    "ranking",
    "sampling",
    "sessions",
    "tasks",
]
