"""Aggregations, frequency dictionaries and host demographics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfolk import schemas
from clickfolk.operators.cleaning import age_group, only_whitelisted
from clickfolk.operators.ranking import HOT_ROWS, position
from clickfolk.session import materialise

# fixed value: host statistics hold seven age slots although the groups end at 5
AGE_SLOTS = 7


def merge_duplicates(df: DataFrame, measure: str = "request_cnt") -> DataFrame:
    """Sum ``measure`` over rows equal in all other columns (nulls equal nulls)."""
    keys = [c for c in df.columns if c != measure]
    return df.groupBy(*keys).agg(F.sum(measure).alias(measure))


def frequency_dictionary(df: DataFrame, columns: Sequence[str] = tuple(schemas.CODED_COLUMNS),
                         hot_rows: int = HOT_ROWS) -> DataFrame:
    """``column, value, n_rows, code``: per column a dense code from 0 by descending row count, nulls left out.

    Rows are first counted per combination of all columns, so the sevenfold unpivot runs over combinations,
    not over the log.
    """
    combos = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    counts = (
        combos.unpivot("_n", [F.col(c).cast("string").alias(c) for c in columns], "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.sum("_n").alias("n_rows"))
    )
    coded = position(materialise(counts, "value-counts"), ["column"], ["-n_rows"], ["value"], "code", hot_rows)
    return coded.select("column", "value", "n_rows", F.col("code").cast("int").alias("code"))


def labelled_clicks(clicks: DataFrame, users: DataFrame) -> DataFrame:
    """Clicks of labelled users with their age group and gender.

    No hint on the join: a small user table is broadcast by the planner, a large one is shuffled and a hot
    user's partition is split by the adaptive skew join.
    """
    labels = users.select("user_id", age_group(F.col("age")).alias("age_group"), "is_male")
    return clicks.join(labels, "user_id")


def _age_slot(slot: int) -> Column:
    hit = F.sum(F.when(F.col("age_group") == slot, F.col("request_cnt")))
    return F.coalesce(hit, F.lit(0)).cast("bigint").alias(f"age_{slot}")


def _gender_slot(male: bool) -> Column:
    hit = F.sum(F.when(F.col("is_male") == F.lit(male), F.col("request_cnt")))
    return F.coalesce(hit, F.lit(0)).cast("bigint").alias("male" if male else "female")


def _age_slots() -> list[Column]:
    return [_age_slot(i) for i in range(AGE_SLOTS)]


def host_age_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("url_host").agg(*_age_slots())


def host_gender_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("url_host").agg(_gender_slot(True), _gender_slot(False))


def host_statistics(labelled: DataFrame) -> DataFrame:
    """Both count tables in one aggregation; a hot host leaves each map task as a single row."""
    return labelled.groupBy("url_host").agg(*_age_slots(), _gender_slot(True), _gender_slot(False))


def support() -> Column:
    return F.col("male") + F.col("female")


def male_share() -> Column:
    return F.col("male").cast("double") / support()


def age_shares() -> list[Column]:
    slots = [F.col(f"age_{i}") for i in range(AGE_SLOTS)]
    total = sum(slots[1:], slots[0])
    return [(slot.cast("double") / total).alias(f"age_share_{i}") for i, slot in enumerate(slots)]


def support_weight(column: Column) -> Column:
    # fixed values: weight curve of a host by its support
    return F.least(0.6 * F.pow(column.cast("double"), F.lit(0.4)) - 0.55, F.lit(20.0))


def smooth(distribution: Column, a: float) -> Column:
    """Mix an array distribution with the uniform one: ``(1-a)*x + a/K``."""
    return F.transform(distribution, lambda x: (1 - a) * x + F.lit(float(a)) / F.size(distribution))


def profile_columns(stats: DataFrame) -> DataFrame:
    return stats.select(
        "url_host", support().alias("support"), male_share().alias("male_share"), *age_shares(),
        support_weight(support()).alias("weight"),
    )


def host_profile(clicks: DataFrame, users: DataFrame, whitelist: DataFrame | None = None) -> DataFrame:
    """Who visits each host: support, share of men, age shares and training weight."""
    stats = host_statistics(labelled_clicks(clicks, users))
    if whitelist is not None:
        stats = only_whitelisted(stats, whitelist)
    return profile_columns(stats)
