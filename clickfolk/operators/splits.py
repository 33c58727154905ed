"""Exact-size, seeded train/test splits.

Every row has a lot, fixed by its key and the seed, and the rows with the least lots of a stratum are drawn. Nothing is
ranked: the lot of the last row drawn is found per stratum by counting lots by their leading digits, first over all rows,
then only inside the cell that holds it; a comparison with it splits the table where it lies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickfolk.operators.ranking import null_safe_join, tie_bucket
from clickfolk.session import materialise

CELL_ROWS = 1_000_000  # a cell of at most so many rows is counted lot by lot
_STEP = 4  # digits by which a cell is refined: 65,536 counts
_DIGITS = 34


def _with_lot(df: DataFrame, key: str, seed: int) -> DataFrame:
    """``_lot``: 34 hexadecimal digits. A null key has the lot of an empty one."""
    drawn = df.withColumn("_md5", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))))
    return drawn.withColumn("_lot", F.concat(tie_bucket(["_md5", key]), F.col("_md5"))).drop("_md5")


def split_quotas(df: DataFrame, fraction: float, strata: Sequence[str]) -> DataFrame:
    """Test rows per stratum: proportional shares of ``ceil(fraction*n)``, largest remainders rounded up."""
    everything = Window.partitionBy(F.lit(0))  # over one row per stratum
    shares = (
        df.groupBy(*strata).agg(F.count("*").alias("n_rows"))
        .withColumn("_total", F.sum("n_rows").over(everything))
        .withColumn("_n_test", F.ceil(F.lit(float(fraction)) * F.col("_total")))
        .withColumn("_share", F.col("n_rows").cast("double") * F.col("_n_test") / F.col("_total"))
        .withColumn("_floor", F.floor("_share"))
    )
    by_remainder = everything.orderBy(F.desc(F.round(F.col("_share") - F.col("_floor"), 9)), *strata)
    extra = F.col("_n_test") - F.sum("_floor").over(everything)
    quota = F.col("_floor") + (F.row_number().over(by_remainder) <= extra).cast("bigint")
    return shares.select(*strata, "n_rows", quota.alias("n_test"))


def last_lots(lots: DataFrame, strata: Sequence[str], quotas: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``strata, _last, _need, _have``: the greatest lot drawn per stratum, how many rows with it are drawn, and how many have it.

    ``quotas``: ``strata, n_rows, n_test``; a stratum without a row to draw has none here. One narrow pass over the rows for the
    leading digits, a second one over the cells found; more only where a cell still holds more than ``cell_rows``.
    """
    cells = quotas.where("n_test > 0").select(
        *strata, F.lit("").alias("_last"), F.col("n_test").alias("_need"), F.col("n_rows").alias("_have"))
    digits = 0
    while digits < _DIGITS:
        most = cells.agg(F.max("_have")).first()[0] or 0
        digits = _DIGITS if most <= cell_rows else min(digits + _STEP, _DIGITS)
        inside = null_safe_join(lots.select(*strata, "_lot"), cells, strata).where(F.col("_lot").startswith(F.col("_last")))
        counts = inside.groupBy(*strata, F.substring("_lot", 1, digits).alias("_cell")).agg(
            F.count("*").alias("_n"), F.first("_need").alias("_need"))
        upto = F.sum("_n").over(Window.partitionBy(*strata).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
        found = counts.withColumn("_upto", upto).where((F.col("_upto") - F.col("_n") < F.col("_need")) & (F.col("_need") <= F.col("_upto")))
        cells = materialise(found.select(
            *strata, F.col("_cell").alias("_last"), (F.col("_need") - F.col("_upto") + F.col("_n")).alias("_need"),
            F.col("_n").alias("_have")), "lot-cells")
    return cells


def _split(df: DataFrame, strata: Sequence[str], quotas: DataFrame, key: str, seed: int, cell_rows: int) -> DataFrame:
    lots = _with_lot(df, key, seed)
    last = last_lots(lots, strata, quotas, cell_rows)
    marked = null_safe_join(lots, last, strata, "left")
    drawn = F.coalesce(F.col("_lot") <= F.col("_last"), F.lit(False))
    if last.where("_need < _have").isEmpty():
        return marked.select(*df.columns, drawn.alias("is_test"))
    # rows with one key share a lot: where it is the last one, only some of them are drawn, any by their other columns
    split_lot = F.coalesce((F.col("_lot") == F.col("_last")) & (F.col("_need") < F.col("_have")), F.lit(False))
    place = F.row_number().over(Window.partitionBy(*strata).orderBy(F.xxhash64(*sorted(df.columns))))
    rest = marked.where(~split_lot).select(*df.columns, drawn.alias("is_test"))
    shared = marked.where(split_lot).select(*df.columns, (place <= F.col("_need")).alias("is_test"))
    return rest.unionByName(shared)


def stratified_split(df: DataFrame, fraction: float, strata: Sequence[str], key: str, seed: int,
                     hot_rows: int = CELL_ROWS) -> DataFrame:
    """``df`` with ``is_test``: exactly ``ceil(fraction*n)`` rows, shared out over the strata. ``hot_rows`` changes the plan only."""
    # stored, so the planner knows the size and broadcasts only what is small
    quotas = materialise(split_quotas(df, fraction, strata), "quotas")
    return _split(df, strata, quotas, key, seed, hot_rows)


def random_split(df: DataFrame, fraction: float, key: str, seed: int, hot_rows: int = CELL_ROWS) -> DataFrame:
    """``df`` with ``is_test``: exactly ``ceil(fraction*n)`` rows drawn without strata."""
    total = df.agg(F.count("*").alias("n_rows"), F.ceil(F.lit(float(fraction)) * F.count("*")).alias("n_test"))
    whole = materialise(total.select(F.lit(0).alias("_all"), "n_rows", "n_test"), "quotas")
    return _split(df.withColumn("_all", F.lit(0)), ["_all"], whole, key, seed, hot_rows).drop("_all")


def train_part(split: DataFrame) -> DataFrame:
    return split.where(~F.col("is_test")).drop("is_test")


def test_part(split: DataFrame) -> DataFrame:
    return split.where(F.col("is_test")).drop("is_test")
