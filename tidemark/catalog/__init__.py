"""Registered queries over the sample tables, each with its plain-SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.registry import ORACLES, QUERIES
from tidemark.catalog import (  # noqa: F401  (registration)
    expressions, series, joins, aggregates, selection, landing, marts, research, intraday, models)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
