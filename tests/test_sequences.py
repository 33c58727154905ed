import datetime
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from clickfolk.operators import aggregates as A
from clickfolk.operators import ranking
from clickfolk.operators import sequences as I
from clickfolk import schemas
from clickfolk.session import materialise


@pytest.fixture(scope="module")
def events(spark):
    """Random merged log in which user 0 holds more than a third of the rows."""
    rnd = random.Random(5)
    rows = []
    for _ in range(3000):
        user = 0 if rnd.random() < 0.4 else rnd.randint(1, 20)
        day = datetime.date(2024, 1, 1) + datetime.timedelta(days=rnd.randint(0, 40))
        rows.append((user, "R", rnd.choice(["C1", "C2", None]), "M", rnd.choice("XYZ"), "T", "O", rnd.choice([None, 10, 20]),
                     f"h{rnd.randint(0, 30)}", day, rnd.choice(I.PARTS_OF_DAY), rnd.randint(1, 9)))
    df = spark.createDataFrame(rows, schemas.CLICKS)
    merged = I.has_price(A.merge_duplicates(df)).cache()
    merged.count()
    return merged


def test_position_is_the_same_however_groups_are_cut(spark):
    rnd = random.Random(1)
    rows = [("big" if rnd.random() < 0.5 else rnd.choice("abc"), rnd.randint(0, 3), i) for i in range(2000)]
    rows.append((None, 1, -1))
    df = spark.createDataFrame(rows, "g string, n int, v int")
    whole = values(ranking.position(df, ["g"], ["-n"], ["v"]))
    assert whole == values(ranking.position(df, ["g"], ["-n"], ["v"], hot_rows=400))
    assert whole == values(ranking.position(df, ["g"], ["-n"], ["v"], hot_rows=1))
    for g in ("big", "a", None):
        places = sorted((p, n) for gg, n, _, p in whole if gg == g)
        assert [p for p, _ in places] == list(range(len(places)))
        assert [n for _, n in places] == sorted((n for _, n in places), reverse=True)
    everything = values(ranking.position(df, [], [], ["v", "n", "g"], hot_rows=100), "position")
    assert [p for (p,) in everything] == sorted(range(2001), key=lambda p: repr((p,)))


def test_event_index_is_dense_in_time_order_and_independent_of_cuts(events):
    got = I.event_index(events).select("user_id", "event_idx", "date", "slot", "url_host", "cpe_model_name", "city_name", "price")
    rows = values(got)
    for user in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == user), key=lambda r: r[1])
        assert [r[1] for r in own] == list(range(len(own)))
        assert [(r[2], r[3]) for r in own] == sorted((r[2], r[3]) for r in own)
    assert rows == values(I.event_index(events, hot_rows=3).select(*got.columns))


def test_dictionaries_are_independent_of_cuts(events):
    for columns, name in ((schemas.DEVICE_COLUMNS, "t"), (["url_host"], "h")):
        whole = values(I.tuple_dictionary(events, columns, name))
        assert whole == values(I.tuple_dictionary(events, columns, name, hot_rows=2))
    coded = values(A.frequency_dictionary(events))
    assert coded == values(A.frequency_dictionary(events, hot_rows=2))


def _pack(sizes, budget):
    batches, held, batch = [], 0, 0
    for size in sizes:
        if size * held * held > budget:
            batch, held = batch + 1, 0
        held += 1
        batches.append(batch)
    return batches


def test_pack_weeks_equals_a_loop(spark):
    rnd = random.Random(3)
    cases = [[10, 20, 300, 2000], [1024, 1024, 1024, 1024], [4096, 4096], [4096, 4097], [1024] * 3 + [1025]]
    cases += [sorted(rnd.choice([1, 5, 50, 500, 5000]) + rnd.randint(0, 50) for _ in range(rnd.randint(1, 30))) for _ in range(200)]
    rows = [(u, 100 - i, size, 0, i) for u, sizes in enumerate(cases) for i, size in enumerate(sizes)]
    weeks = spark.createDataFrame(rows, "user_id bigint, week_n int, size bigint, first_idx bigint, week_rank bigint")
    got = {}
    for r in I.pack_weeks(weeks).orderBy("user_id", "week_rank").collect():
        got.setdefault(r["user_id"], []).append((r["batch"], r["width"]))
    for u, sizes in enumerate(cases):
        batches = _pack(sizes, I.WEEK_BUDGET)
        widths = {b: max(s for s, bb in zip(sizes, batches) if bb == b) for b in batches}
        assert got[u] == [(b, widths[b]) for b in batches]
    assert [b for b, _ in got[0]] == [0, 0, 0, 1]


def test_padded_batches_hold_every_event_once(events):
    cells = I.timeline(events)
    packed = I.pack_weeks(I.week_groups(cells), 200)
    padded = I.padded_batches(I.event_index(events), packed)
    real = padded.where("mask = 1")
    assert real.count() == events.count() == real.select("user_id", "event_idx").distinct().count()
    shapes = padded.groupBy("user_id", "batch", "week_n").agg(F.count("*").alias("n"), F.countDistinct("pos").alias("p"))
    joined = shapes.join(packed, ["user_id", "batch", "week_n"])
    assert joined.where("n <> width or p <> width").count() == 0 and joined.count() == packed.count()


def test_event_chunks_are_bounded_and_ordered(events):
    chunks = I.event_chunks(I.event_index(events), ["slot"], 32)
    assert chunks.agg(F.max(F.size("events"))).first()[0] == 32
    flat = chunks.select("user_id", "chunk_no", F.posexplode("events").alias("p", "e")).select("chunk_no", "p", "e.event_idx")
    assert flat.where("event_idx <> chunk_no * 32 + p").count() == 0


def test_bad_values_are_errors(spark, events):
    odd = spark.createDataFrame([(datetime.date(2024, 1, 1), "noon")], "d date, p string")
    with pytest.raises(Exception, match="unknown part of day: noon"):
        odd.select(I.slot_in_week(F.col("d"), F.col("p"))).collect()
    dictionary = A.frequency_dictionary(events.where("city_name = 'C1'"))
    with pytest.raises(Exception, match="unknown city_name"):
        I.encode_column(events, dictionary, "city_name").collect()
    loose = I.encode_column(events, dictionary, "city_name", strict=False)
    assert loose.where("city_name_code is null").count() == events.where("city_name is null or city_name = 'C2'").count()


def test_merge_keeps_the_request_total(events):
    doubled = events.unionByName(events)
    merged = A.merge_duplicates(doubled)
    assert merged.count() == events.count()
    assert merged.agg(F.sum("request_cnt")).first()[0] == 2 * events.agg(F.sum("request_cnt")).first()[0]


@pytest.mark.parametrize("hot_rows", [I.HOT_ROWS, 200, 5])
def test_chunks_by_user_are_those_by_dictionaries(events, hot_rows):
    """User 0 alone is above 200 rows, all users are above 5."""
    groups = {"token_device": schemas.DEVICE_COLUMNS, "token_location": schemas.LOCATION_COLUMNS, "token_url_host": schemas.HOST_COLUMNS}
    entries = {name: I.tuple_dictionary(events, columns, name) for name, columns in groups.items()}
    whole = I.all_tokens(I.event_index(events), entries, groups).withColumn("requests", I.scale_requests(F.col("request_cnt")))
    want = values(I.event_chunks(whole, [*groups, "requests", "slot", "week_n"], 16))
    cells = materialise(I.timeline(events), "timeline")
    hot = I.hot_users(cells, hot_rows)
    assert (0 if hot is None else hot.count()) == {I.HOT_ROWS: 0, 200: 1, 5: 21}[hot_rows]
    assert values(I.user_chunks(events, cells, hot, groups, entries, 16, hot_rows)) == want
    if hot is None:
        for name, columns in groups.items():
            assert values(I.own_dictionary(events, columns, name), *entries[name].columns) == values(entries[name])
        nobody = events.limit(3).withColumn("user_id", F.lit(None).cast("bigint")).select(events.columns)
        assert values(I.user_chunks(events.unionByName(nobody), cells, hot, groups, entries, 16)) == want
    assert I.user_chunks(events.limit(0), cells.limit(0), hot, groups, entries, 16, hot_rows).count() == 0
