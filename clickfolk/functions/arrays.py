"""Helpers for array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once. Inside an array lambda a plain expression runs for every element."""
    return F.transform(F.array(value), body)[0]
