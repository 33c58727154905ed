"""A query of the catalogue: the Spark job and, where SQL can say it, the equivalent oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def r6(column: Column | str, name: str) -> Column:
    """Rounded to six places: the last digits of ``ln`` and ``pow`` differ between engines."""
    return F.round(column, 6).alias(name)


def all_queries() -> dict[str, Query]:
    from clickfolk.catalog import cleaning, demographics, hosts, metrics, pooling, scorer, sequences, tables, texts, vectors

    merged: dict[str, Query] = {}
    for module in (demographics, tables, cleaning, hosts, texts, vectors, sequences, metrics, scorer, pooling):
        merged.update(module.QUERIES)
    return merged
