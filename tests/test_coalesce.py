import random

import pytest
from pyspark.sql import functions as F

from vecquery.operators import coalesce


def walk(events, closed):
    """Plain leader scan over (key, ts, id, span)."""
    out, current = {}, {}
    for key, ts, id_, span in sorted(events):
        lead = current.get(key)
        if lead is None or (ts > lead[1] + lead[2] if closed else ts >= lead[1] + lead[2]):
            current[key] = lead = (id_, ts, span)
        out[id_] = (lead[0], lead[1], lead[0] == id_)
    return out


def made_events(n, seed, spans, keys=("a", "b", "c")):
    rng = random.Random(seed)
    weights = [8] + [1] * (len(keys) - 1)
    return [
        (rng.choices(keys, weights)[0], rng.randrange(n * 3), i, rng.choice(spans)) for i in range(n)
    ]


def scanned(spark, events, closed, **sizes):
    df = spark.createDataFrame(events, "key string, ts_us bigint, id bigint, span_us bigint")
    rows = coalesce.leader_scan(df, closed, **sizes).collect()
    return {r.id: (r.leader_id, r.leader_ts_us, r.is_leader) for r in rows}


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("spans", [[7], [0], [0, 1, 20, 300], [10_000]])
def test_short_keys(spark, closed, spans):
    events = made_events(400, 1, spans)
    assert scanned(spark, events, closed) == walk(events, closed)


@pytest.mark.parametrize("closed,spans", [(True, [7]), (False, [0, 3, 40]), (False, [100_000])])
def test_long_key_is_split(spark, closed, spans):
    events = made_events(300, 2, spans)
    assert scanned(spark, events, closed, group_rows=50, bin_rows=20) == walk(events, closed)


def test_long_key_with_equal_times(spark):
    events = [("hot", i // 40, i, 0 if i % 3 else 2) for i in range(200)] + [("cold", 5, 1000, 1)]
    for closed in (True, False):
        assert scanned(spark, events, closed, group_rows=50, bin_rows=10) == walk(events, closed)


def test_no_events(spark):
    assert scanned(spark, [], True) == {}


def test_stats_add_up(spark):
    events = made_events(300, 3, [25])
    df = spark.createDataFrame(events, "key string, ts_us bigint, id bigint, span_us bigint")
    row = coalesce.merge_stats(coalesce.merge_in_flight(df)).first()
    assert row.saved + row.executions == row.total_requests == 300
    assert row.merge_ratio == round(row.saved / 300, 4)
    empty = coalesce.merge_stats(coalesce.merge_in_flight(df.limit(0))).first()
    assert (empty.total_requests, empty.merge_ratio) == (0, 0.0)


def test_run_once_gives_all_copies_the_result(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "a", "x")], "id int, key string, text string")
    worked_on = []

    def work(distinct):
        worked_on.append(distinct.count())
        return distinct.select("key", F.upper("text").alias("result"))

    rows = {r.id: r.result for r in coalesce.run_once(df, work, ["text"]).collect()}
    assert rows == {1: "X", 2: "Y", 3: "X"} and worked_on == [2]
