"""Weekly event sequences per user.

A user may hold a large part of the log, so nothing here gathers a user in one task or one row. Positions
come from counts per (user, day, part of day), whose number the calendar bounds; events are stored in chunks
of fixed size; a week is a range of positions, since events are in time order.

Chunks of ordinary users take one shuffle of the log: positions, codes and chunks of a user are all made where the
user's rows lie (``user_chunks``). Hot users, told by one count, go by counts and dictionaries as above.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickfolk import schemas
from clickfolk.operators.cleaning import age_group
from clickfolk.operators.ranking import HOT_ROWS, null_safe_join, position, tie_bucket
from clickfolk.operators.vectors import presence_flags, zero_fill_vectors
from clickfolk.session import materialise, unsent

# fixed values: parts of day in order, scaling of price and request count, chunk and week budget
PARTS_OF_DAY = ["night", "morning", "day", "evening"]
PRICE_CENTRE, PRICE_SCALE = 10.0, 0.865
REQUESTS_CENTRE, REQUESTS_SCALE = 0.6, 0.73
CHUNK_EVENTS = 256
WEEK_BUDGET = 4096

CELL = ["user_id", "date", "part_of_day"]
EVENT_ORDER = [
    "url_host", "cpe_manufacturer_name", "cpe_model_name", "cpe_type_cd", "cpe_model_os_type", "price",
    "region_name", "city_name",
]


# ---------------------------------------------------------------- columns


def week_start(date: Column) -> Column:
    return F.date_trunc("week", date).cast("date")


def slot_in_week(date: Column, part_of_day: Column) -> Column:
    """0..27: four parts for each day of the week; any other part of day is an error."""
    wrong = F.raise_error(F.concat(F.lit("unknown part of day: "), F.coalesce(part_of_day, F.lit("null")))).cast("int")
    part = None
    for index, name in enumerate(PARTS_OF_DAY):
        hit = part_of_day == name
        part = F.when(hit, F.lit(index)) if part is None else part.when(hit, F.lit(index))
    return F.datediff(date, week_start(date)) * 4 + part.otherwise(wrong)


def has_price(df: DataFrame) -> DataFrame:
    return df.withColumn("has_price", F.col("price").isNotNull())


def scale_price(price: Column) -> Column:
    return F.when(price.isNull(), F.lit(0.0)).otherwise((F.ln(price) - PRICE_CENTRE) / PRICE_SCALE)


def scale_requests(count: Column) -> Column:
    return (F.ln(count) - REQUESTS_CENTRE) / REQUESTS_SCALE


# ---------------------------------------------------------------- time line


def weeks_ago(df: DataFrame) -> DataFrame:
    """``week`` and ``week_n``, the weeks before the user's newest week.

    The newest week is a partial aggregate joined back, not a window, so a hot user stays spread out.
    """
    newest = df.groupBy("user_id").agg(week_start(F.max("date")).alias("_newest"))
    week = week_start(F.col("date"))
    return (
        df.join(unsent(newest), "user_id").withColumn("week", week)
        .withColumn("week_n", (F.datediff("_newest", F.col("week")) / 7).cast("int"))
        .select(*df.columns, "week", "week_n")
    )


def timeline(df: DataFrame) -> DataFrame:
    """One row per user, day and part of day: events in it and before it, week, slot.

    The window runs over these counts: at most four rows per calendar day of a user.
    """
    cells = (
        df.groupBy(*CELL).agg(F.count("*").alias("n_events"))
        .withColumn("week", week_start(F.col("date")))
        .withColumn("slot", slot_in_week(F.col("date"), F.col("part_of_day")))
    )
    user = Window.partitionBy("user_id")
    before = user.orderBy("date", "slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        cells.withColumn("week_n", (F.datediff(F.max("week").over(user), F.col("week")) / 7).cast("int"))
        .withColumn("first_idx", F.coalesce(F.sum("n_events").over(before), F.lit(0)))
    )


def event_index(df: DataFrame, cells: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Position of every event in its user's time order, with week, slot and week number.

    Order: date, part of day, then a hash bucket and the columns of ``EVENT_ORDER``. Rows join their cell's
    counts and are numbered inside the cell, both by the same partitioning. ``cells`` is a stored
    ``timeline`` (made here if not given): it tells beforehand whether any cell is above ``hot_rows``. Such
    cells are taken out before the shuffle and cut further, by the hash bucket.
    """
    cells = materialise(timeline(df), "timeline") if cells is None else cells
    hot = cells.where(F.col("n_events") > hot_rows)
    crowded = None
    if not hot.isEmpty():
        # at most rows / hot_rows cells, so small whatever the data
        crowded = df.join(F.broadcast(hot), CELL)
        df = df.join(F.broadcast(hot.select(*CELL)), CELL, "left_anti")
    rows = df.join(unsent(cells), CELL).withColumn("_tie", tie_bucket(EVENT_ORDER))
    fine = [F.col("_tie"), *[F.col(c).asc_nulls_first() for c in EVENT_ORDER]]
    inside = F.row_number().over(Window.partitionBy(*CELL).orderBy(*fine)).cast("bigint") - 1
    placed = rows.withColumn("_inside", inside).drop("_tie")
    if crowded is not None:
        placed = placed.unionByName(position(crowded, CELL, [], EVENT_ORDER, "_inside", hot_rows))
    return placed.withColumn("event_idx", F.col("first_idx") + F.col("_inside")).drop(
        "_inside", "first_idx", "n_events"
    )


def event_count(df: DataFrame) -> DataFrame:
    return df.groupBy("user_id").agg(F.count("*").alias("event_count"))


def week_groups(cells: DataFrame) -> DataFrame:
    """Per user and week the range of event positions, ranked by size (equal sizes: older week first).

    ``cells`` is a ``timeline``. The positions of a week are ``first_idx .. first_idx+size-1``.
    """
    weeks = cells.groupBy("user_id", "week_n").agg(
        F.sum("n_events").alias("size"), F.min("first_idx").alias("first_idx")
    )
    order = Window.partitionBy("user_id").orderBy("size", F.desc("week_n"))
    return weeks.withColumn("week_rank", F.row_number().over(order).cast("bigint") - 1)


def week_events(events: DataFrame, weeks: DataFrame) -> DataFrame:
    """Long form of ``week_groups``: one row per event with its place in the week."""
    joined = events.select("user_id", "week_n", "event_idx").join(unsent(weeks), ["user_id", "week_n"])
    return joined.withColumn("pos", F.col("event_idx") - F.col("first_idx")).drop("first_idx")


def pack_weeks(weeks: DataFrame, budget: int = WEEK_BUDGET) -> DataFrame:
    """Greedy batches of weeks in rank order: a week that would cost more than ``budget`` opens a new batch.

    Cost is ``size * (weeks already in the batch)^2``. The fold runs over a user's weeks, whose number the
    calendar bounds. Adds ``batch`` and ``width``, the longest week of the batch.
    """
    ordered = weeks.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("week_rank", "week_n", "size", "first_idx"))).alias("_weeks")
    )

    def step(state: Column, week: Column) -> Column:
        full = week["size"] * state["held"] * state["held"] > budget
        batch = state["batch"] + full.cast("int")
        return F.struct(
            batch.alias("batch"),
            F.when(full, F.lit(1).cast("bigint")).otherwise(state["held"] + 1).alias("held"),
            F.concat(state["batches"], F.array(batch)).alias("batches"),
        )

    start = F.struct(
        F.lit(0).alias("batch"), F.lit(0).cast("bigint").alias("held"),
        F.array().cast("array<int>").alias("batches"),
    )
    batches = F.aggregate("_weeks", start, step)["batches"]
    rows = ordered.select("user_id", F.explode(F.arrays_zip("_weeks", batches.alias("batch"))).alias("_w")).select(
        "user_id", F.col("_w.batch").alias("batch"), "_w._weeks.*"
    )
    return rows.withColumn("width", F.max("size").over(Window.partitionBy("user_id", "batch")))


def padded_batches(events: DataFrame, packed: DataFrame) -> DataFrame:
    """``user_id, batch, week_n, pos, event_idx, mask``: every week filled up to its batch's width with 0.

    Padding stays small by the budget: a week is only padded when it shares a batch.
    """
    real = events.select("user_id", "week_n", "event_idx").join(unsent(packed), ["user_id", "week_n"]).select(
        "user_id", "batch", "week_n", (F.col("event_idx") - F.col("first_idx")).alias("pos"), "event_idx",
        F.lit(1).alias("mask"),
    )
    gaps = packed.where(F.col("size") < F.col("width")).select(
        "user_id", "batch", "week_n", F.explode(F.sequence(F.col("size"), F.col("width") - 1)).alias("pos"),
        F.lit(0).cast("bigint").alias("event_idx"), F.lit(0).alias("mask"),
    )
    return real.unionByName(gaps)


# ---------------------------------------------------------------- per-user dictionaries


def tuple_dictionary(df: DataFrame, columns: Sequence[str], name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per user the distinct tuples of ``columns`` (nulls count as values) coded from 0 by descending rows."""
    counts = df.groupBy("user_id", *columns).agg(F.count("*").alias("n_rows"))
    return position(materialise(counts, name), ["user_id"], ["-n_rows"], list(columns), name, hot_rows)


def tuple_tokens(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Give every event the code of its tuple."""
    return null_safe_join(df, dictionary.select("user_id", *columns, name), ["user_id", *columns])


def all_tokens(events: DataFrame, entries: dict[str, DataFrame], groups: dict[str, Sequence[str]]) -> DataFrame:
    """Events with every token of ``groups``: the codes meet on the distinct tuples of a user, the log is joined once."""
    columns = list(dict.fromkeys(c for own in groups.values() for c in own))
    combined = events.select("user_id", *columns).distinct()
    for name, own in groups.items():
        combined = tuple_tokens(combined, entries[name], own, name)
    return null_safe_join(events, combined, ["user_id", *columns])


def encode_column(df: DataFrame, dictionary: DataFrame, column: str, strict: bool = True) -> DataFrame:
    """Add ``<column>_code`` from a frequency dictionary; an unknown value is an error, or null if not strict.

    Pass a stored dictionary: the planner then knows its size and can broadcast it.
    """
    code = f"{column}_code"
    entries = dictionary.where(F.col("column") == column).select(
        F.col("value").alias(column), F.col("code").alias(code)
    )
    joined = df.join(entries, column, "left")
    if strict:
        unknown = F.raise_error(
            F.concat(F.lit(f"unknown {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
        ).cast("int")
        joined = joined.withColumn(code, F.coalesce(F.col(code), unknown))
    return joined.select(*df.columns, code)


def decode_tuples(entries: DataFrame, columns: Sequence[str], dictionary: DataFrame, strict: bool = True) -> DataFrame:
    """Feature columns of dictionary entries: codes for coded columns, scaled price, price flag."""
    for column in columns:
        if column in schemas.CODED_COLUMNS:
            entries = encode_column(entries, dictionary, column, strict)
        elif column == "price":
            entries = entries.withColumn("price_scaled", scale_price(F.col("price")))
    return entries


def host_token_features(entries: DataFrame, features: DataFrame, vector_dims: dict[str, int]) -> DataFrame:
    """Feature record of each host token, with presence flags and zeros for missing vectors.

    Every token has a row: events refer to it. A host without features, and the null host, is not ``known``.
    """
    known = features.withColumnRenamed("host", "url_host").withColumn("known", F.lit(True))
    joined = entries.join(known, "url_host", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    flagged = presence_flags(joined, [c for c in features.columns if c != "host"])
    for column, dim in vector_dims.items():
        flagged = zero_fill_vectors(flagged, column, dim)
    return flagged


# ---------------------------------------------------------------- assembled record


def event_chunks(events: DataFrame, columns: Sequence[str], size: int = CHUNK_EVENTS) -> DataFrame:
    """Consecutive chunks of ``size`` events, each an ordered array; a row never holds more than that."""
    return (
        events.withColumn("chunk_no", F.floor(F.col("event_idx") / size))
        .groupBy("user_id", "chunk_no")
        .agg(F.sort_array(F.collect_list(F.struct("event_idx", *columns))).alias("events"))
    )


def own_index(events: DataFrame) -> DataFrame:
    """``event_index`` by windows over whole users, for logs without hot users."""
    timed = events.withColumn("week", week_start(F.col("date"))).withColumn("slot", slot_in_week(F.col("date"), F.col("part_of_day")))
    order = Window.partitionBy("user_id").orderBy(
        "date", "slot", tie_bucket(EVENT_ORDER), *[F.col(c).asc_nulls_first() for c in EVENT_ORDER])
    # the newest week takes the same order, so both share a sort
    newest = F.max("week").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return timed.withColumn("event_idx", F.row_number().over(order).cast("bigint") - 1).withColumn(
        "week_n", (F.datediff(newest, F.col("week")) / 7).cast("int"))


def own_tokens(events: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The codes of ``tuple_dictionary`` by windows over whole users, for logs without hot users."""
    counted = events.withColumn("_rows", F.count("*").over(Window.partitionBy("user_id", *columns)))
    order = Window.partitionBy("user_id").orderBy(
        F.desc("_rows"), tie_bucket(columns), *[F.col(c).asc_nulls_first() for c in columns])
    return counted.withColumn(name, F.dense_rank().over(order).cast("bigint") - 1).drop("_rows")


def own_dictionary(events: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``tuple_dictionary`` by windows over whole users, for logs without hot users: nothing is stored or counted first."""
    counts = events.groupBy("user_id", *columns).agg(F.count("*").alias("n_rows"))
    order = Window.partitionBy("user_id").orderBy(
        F.desc("n_rows"), tie_bucket(columns), *[F.col(c).asc_nulls_first() for c in columns])
    return counts.withColumn(name, F.row_number().over(order).cast("bigint") - 1)


def hot_users(cells: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Users of more than ``hot_rows`` events in a stored ``timeline``: at most rows / hot_rows. None if there is none."""
    hot = cells.groupBy("user_id").agg(F.sum("n_events").alias("n")).where(F.col("n") > hot_rows).select("user_id")
    return None if hot.isEmpty() else hot


def user_chunks(events: DataFrame, cells: DataFrame, hot: DataFrame | None, groups: dict[str, Sequence[str]],
                entries: dict[str, DataFrame], size: int = CHUNK_EVENTS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``event_chunks`` of all events with the tokens of ``groups``, scaled requests, slot and week.

    Users that are not ``hot`` are shuffled once, by user. The others, if any, take the way that never puts a user into one
    task. The limit changes the plan, never the result. ``cells`` is a stored ``timeline``, ``entries`` hold the dictionaries
    of ``groups``. Rows without a user are in no sequence.
    """
    columns = [*groups, "requests", "slot", "week_n"]
    scaled = events.where("user_id IS NOT NULL").withColumn("requests", scale_requests(F.col("request_cnt")))
    own = scaled if hot is None else scaled.join(F.broadcast(hot), "user_id", "left_anti")
    own = own_index(own)
    for name, wanted in groups.items():
        own = own_tokens(own, wanted, name)
    chunks = event_chunks(own, columns, size)
    if hot is None:
        return chunks
    placed = event_index(scaled.join(F.broadcast(hot), "user_id", "left_semi"),
                         materialise(cells.join(F.broadcast(hot), "user_id", "left_semi"), "hot-timeline"), hot_rows)
    return chunks.unionByName(event_chunks(all_tokens(placed, entries, groups), columns, size))


def attach_labels(df: DataFrame, users: DataFrame) -> DataFrame:
    """Gender as 0/1 and the age group of labelled users; others keep nulls."""
    labels = users.select(
        "user_id", F.col("is_male").cast("int").alias("is_male"), age_group(F.col("age")).alias("age_group")
    )
    return df.join(unsent(labels), "user_id", "left")


class UserSequences(NamedTuple):
    """The record of a user as tables keyed by ``user_id``, each with rows of bounded size."""

    header: DataFrame  # event count, optional label
    chunks: DataFrame  # events in order: tokens, scaled requests, slot, week
    weeks: DataFrame  # week ranges with batch and width
    device: DataFrame  # device tuples with feature columns
    location: DataFrame
    host: DataFrame


def user_sequences(events: DataFrame, dictionary: DataFrame, features: DataFrame, users: DataFrame | None,
                   vector_dims: dict[str, int], budget: int = WEEK_BUDGET, chunk: int = CHUNK_EVENTS,
                   strict: bool = True, hot_rows: int = HOT_ROWS) -> UserSequences:
    """Everything the scorer of a user reads, for all users at once."""
    events = has_price(events)
    cells = materialise(timeline(events), "timeline")
    groups = {
        "token_device": schemas.DEVICE_COLUMNS,
        "token_location": schemas.LOCATION_COLUMNS,
        "token_url_host": schemas.HOST_COLUMNS,
    }
    hot = hot_users(cells, hot_rows)
    entries = {name: own_dictionary(events, columns, name) if hot is None else tuple_dictionary(events, columns, name, hot_rows)
               for name, columns in groups.items()}
    header = cells.groupBy("user_id").agg(F.sum("n_events").alias("event_count"))
    return UserSequences(
        header=attach_labels(header, users) if users is not None else header,
        chunks=user_chunks(events, cells, hot, groups, entries, chunk, hot_rows),
        weeks=pack_weeks(week_groups(cells), budget),
        device=decode_tuples(entries["token_device"], schemas.DEVICE_COLUMNS, dictionary, strict),
        location=decode_tuples(entries["token_location"], schemas.LOCATION_COLUMNS, dictionary, strict),
        host=host_token_features(entries["token_url_host"], features, vector_dims),
    )
