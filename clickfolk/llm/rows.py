"""Row keys and shuffle widths shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def parts(spark: SparkSession) -> int:
    """Width of a shuffle, as the session sets it to the size of its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prime_from(n: int) -> int:
    """Smallest prime that is at least ``n``: a modulus that ids in steps do not leave partly empty."""
    n = max(n, 2)
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def modulo(column: Column | str, n: int) -> Column:
    """Remainder of an integer id, null as 0."""
    return F.coalesce(F.pmod(F.col(column) if isinstance(column, str) else column, F.lit(n)), F.lit(0)).cast("int")


def _has_map(kind: DataType) -> bool:
    return "map<" in kind.simpleString()


def row_number_of(docs: DataFrame, id_col: str) -> Column | None:
    """A 64-bit hash of the whole row where an id repeats, to tell its rows apart; None where every id is unique.

    One narrow count over the ids finds out. No row meets the others of its id, so any number of rows may share one,
    or have none. Rows equal in every column share the number. Columns that hold maps do not count.
    """
    if docs.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return None
    return F.xxhash64(*[f"`{f.name}`" for f in docs.schema if not _has_map(f.dataType)])
