"""Exact positions inside groups of any size.

A window puts a whole group into one task. Groups here may be huge (one user with a third of the log, one
dictionary column with most of its values seen once), so a larger table is ranked by a sample sort: rows are dealt into
ranges of the whole order, whose bounds Spark takes from a sample, and sorted inside them. A position is the number of the
group's rows in the ranges before plus the place in the range; a range knows each group it holds by one count. No range
depends on the size of a group. The order is the same either way, so the limit changes the plan and never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfolk.session import materialise

HOT_ROWS = 4_000_000
_RANGE_BITS = 33  # of a running number, the place in its task


def tie_bucket(columns: Sequence[str]) -> Column:
    """Two hex digits spread evenly over rows that differ in ``columns``."""
    text = F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.substring(F.md5(text), 1, 2)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; keeps the left copy of the keys."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(lambda a, b: a & b, [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys])
    joined = left.join(renamed, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{key}" for key in keys])


def _ordering(coarse: Sequence[str], fine: Sequence[str]) -> list[Column]:
    leading = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in coarse]
    return [*leading, F.col("_tie").asc(), *[F.col(c).asc_nulls_first() for c in fine]]


def position(
    df: DataFrame,
    group: Sequence[str],
    coarse: Sequence[str],
    fine: Sequence[str],
    name: str = "position",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """0-based place of every row in its group, by ``coarse`` ('-' = descending), hash bucket, ``fine``.

    ``coarse`` columns must not be null. Pass a stored table (see ``session.materialise``): it is counted
    first, which for Parquet reads the footers only, and read again for the sample. ``hot_rows``: rows that one task may rank.
    """
    keys = list(group) or ["_all"]
    rows = df.withColumn("_tie", tie_bucket(fine))
    if not group:
        rows = rows.withColumn("_all", F.lit(0))
    ordering = _ordering(coarse, fine)
    whole = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)).cast("bigint") - 1
    n_rows = df.count()
    if n_rows <= hot_rows:  # then no group can be larger
        return rows.withColumn(name, whole).drop("_tie", "_all")

    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // hot_rows))
    order = [*[F.col(k).asc_nulls_first() for k in keys], *ordering]
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # the running number of a sorted range stays with the row, whatever is read again later
    placed = materialise(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked").withColumn(
        "_range", F.shiftright("_at", _RANGE_BITS))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per group and range: at most the groups and the ranges together
    held = placed.groupBy(*keys, "_range").agg(F.count("*").alias("_n"), F.min("_at").alias("_first")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    found = null_safe_join(placed, held, [*keys, "_range"])
    return found.withColumn(name, F.col("_before") + F.col("_at") - F.col("_first")).drop(
        "_tie", "_all", "_at", "_range", "_n", "_first", "_before")
