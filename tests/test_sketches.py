import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from vecquery.operators import sketches
from vecquery.streaming import runs

DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    return [
        (DAY + timedelta(seconds=rng.randrange(86_400)), rng.choice(["a", "a", "b"]), f"q{min(int(rng.paretovariate(0.6)), 9_000)}", rng.expovariate(0.01))
        for _ in range(30_000)
    ]


@pytest.fixture(scope="module")
def log(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp, run string, key string, latency_ms double").cache()


def near(values, found, share):
    below, upto = sum(v < found for v in values), sum(v <= found for v in values)
    slack = len(values) * sketches.RANK_ERROR + 1
    return below - slack <= len(values) * share <= upto + slack


def check(windows, rows):
    for run in sketches.percentiles(sketches.merged(windows, ["run"])).collect():
        own = [r[3] for r in rows if r[1] == run["run"]]
        assert run["n"] == len(own) and all(near(own, run[name], share) for name, share in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))
    exact = Counter(r[2] for r in rows)
    found = {r["query"]: r["requests"] for r in sketches.top_queries(sketches.merged(windows, []), [], sketches.TRACKED).collect()}
    error = -(-len(rows) * 3.5 // sketches.TRACKED)
    assert all(abs(found.get(q, 0) - n) <= error for q, n in exact.most_common(20))


def test_hours_merged_equal_the_day_within_the_error(spark, log, rows):
    hours = sketches.per_window(log, ["run"], "1 hour")
    assert hours.count() == len({(r[0].hour, r[1]) for r in rows})
    check(hours, rows)
    noon = hours.filter("hour(start) < 12")
    check(noon, [r for r in rows if r[0].hour < 12])


def test_windows_of_a_stream_equal_those_of_the_table(spark, log, rows):
    def work(batch, _):
        return sketches.per_window(batch, ["run"], "1 hour")

    portions = [log.filter(F.pmod(F.hash("latency_ms"), F.lit(3)) == i) for i in range(3)]
    made = runs.drain_portions(portions, "sketched", work, work(log, 0).schema)
    assert made.agg(F.sum("n")).first()[0] == len(rows) and made.count() > 48  # a window comes with every portion
    check(made, rows)


def test_few_counters_still_hold_their_error(spark, log, rows):
    found = sketches.top_queries(sketches.merged(sketches.per_window(log, [], "1 hour", tracked=50), [], 50), [], 50)
    exact = Counter(r[2] for r in rows)
    error = -(-len(rows) * 3.5 // 50)
    got = {r["query"]: r["requests"] for r in found.collect()}
    assert len(exact) > 500 and got
    assert all(abs(n - exact[q]) <= error for q, n in got.items()) and all(q in got for q, n in exact.items() if n > error)


def test_nulls_and_nothing(spark, log):
    odd = spark.createDataFrame([(DAY, "a", None, None), (DAY, "a", "q", None), (DAY, None, "q", 5.0)], log.schema)
    got = {r["run"]: (r["n"], r["p50"]) for r in sketches.percentiles(sketches.merged(sketches.per_window(odd, ["run"], "1 hour"), ["run"])).collect()}
    assert got == {"a": (2, None), None: (1, 5.0)}
    assert sketches.per_window(log.limit(0), ["run"], "1 hour").count() == 0
