import random

import pytest
from pyspark.sql import functions as F

from vecquery.operators import latency, ordered, throughput

LOG = "run string, request_id bigint, ts_us bigint, latency_ms double, ok boolean, cache_hit boolean"


def made_log(n, seed=1, run="a"):
    rng = random.Random(seed)
    return [
        (run, i, rng.randrange(n * 1000), round(rng.expovariate(1 / 40), 2), rng.random() > 0.1, rng.random() > 0.5)
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [1, 2, 3, 20, 100, 101])
def test_percentiles_are_order_statistics(spark, n):
    rows = made_log(n) + [("hot", i, i, 7.0 if i % 3 else 9.0, True, False) for i in range(n)]
    found = latency.percentiles(spark.createDataFrame(rows, LOG), ["run"]).collect()
    for r in found:
        values = sorted(x[3] for x in rows if x[0] == r.run)
        assert (r.n, r.min, r.max) == (n, values[0], values[-1])
        assert [r.p50, r.p95, r.p99] == [values[int(n * p)] for p in (0.5, 0.95, 0.99)]


def test_percentiles_of_negative_and_wide_values(spark):
    rows = [("a", i, i, v, True, False) for i, v in enumerate([-5.5, -0.1, 0.0, 1e9, 3.2, 3.1])]
    r = latency.percentiles(spark.createDataFrame(rows, LOG), ["run"], bins=4).first()
    assert (r.min, r.max, r.p50, r.p99) == (-5.5, 1e9, 3.1, 1e9)


def test_ewma_equals_the_loop(spark):
    rows = made_log(700)
    df = spark.createDataFrame(rows, LOG).withColumn("bin", ordered.time_bin(F.col("ts_us"), 50_000))
    got = latency.ewma(df, ["run"], "bin", ["ts_us", "request_id"], "latency_ms", "avg").first().avg
    avg = 0.0
    for row in sorted(rows, key=lambda r: (r[2], r[1])):
        avg = 0.9 * avg + 0.1 * row[3]
    assert abs(got - avg) < 1e-9


def test_positions_and_running_totals(spark):
    rows = made_log(300) + made_log(50, 2, "b")
    df = spark.createDataFrame(rows, LOG).withColumn("bin", ordered.time_bin(F.col("ts_us"), 20_000))
    order = ["ts_us", "request_id"]
    placed = ordered.positions(df, ["run"], "bin", order).collect()
    totals = ordered.running_total(df, ["run"], "bin", order, {"upto": "request_id"}).collect()
    for run in ("a", "b"):
        ranked = sorted((r for r in rows if r[0] == run), key=lambda r: (r[2], r[1]))
        assert {r.request_id: (r.position, r.total) for r in placed if r.run == run} == {
            r[1]: (i + 1, len(ranked)) for i, r in enumerate(ranked)
        }
        total, want = 0, {}
        for r in ranked:
            total += r[1]
            want[r[1]] = total
        assert {r.request_id: r.upto for r in totals if r.run == run} == want


@pytest.mark.parametrize("backwards", [False, True])
def test_carried_values(spark, backwards):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), i, rng.choice([None, None, None, i])) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, at int, v int").withColumn("bin", F.floor(F.col("at") / 7))
    got = {r["at"]: r.out for r in ordered.carried(df, ["key"], "bin", ["at"], "v", "out", backwards).collect()}
    last, want = {}, {}
    for key, at, v in sorted(rows, key=lambda r: -r[1] if backwards else r[1]):
        if v is not None:
            last[key] = v
        want[at] = last.get(key)
    assert got == want


def test_run_totals_are_zero_safe(spark):
    rows = [("a", 1, 0, 0.0, False, True)]
    r = throughput.run_totals(spark.createDataFrame(rows, LOG), ["run"]).first()
    assert (r.duration_sec, r.throughput_ops, r.error_rate, r.cache_hit_rate) == (0.0, 0.0, 1.0, 0.0)


def test_in_flight_counts_open_requests(spark):
    df = spark.createDataFrame([(0, 10), (5, 8), (8, 12), (10, 11)], "start_us bigint, end_us bigint")
    rows = sorted(tuple(r) for r in throughput.in_flight(df, rows=2).collect())
    assert rows == [(0, 1, 1), (5, 1, 2), (8, 1, 2), (10, 1, 2), (11, 0, 1), (12, 0, 0)]


def test_progress_shows_quiet_ticks(spark):
    rows = [("a", i, t * 1_000_000, 1.0, ok, False) for i, (t, ok) in enumerate([(5, True), (5, False), (8, True)])]
    got = throughput.progress(spark.createDataFrame(rows, LOG), 1).orderBy("elapsed_sec").collect()
    assert [(r.elapsed_sec, r.completed, r.errors, r.current_ops) for r in got] == [
        (1, 1, 1, 1.0), (2, 1, 1, 0.5), (3, 1, 1, 0.333333), (4, 2, 1, 0.5)
    ]


def test_warmup_is_trimmed(spark):
    rows = made_log(60) + made_log(1000, 4, "b")
    df = spark.createDataFrame(rows, LOG)
    counts = dict(throughput.trim_warmup(df, ["run"], rows=20).groupBy("run").count().collect())
    assert counts == {"a": 10, "b": 900}
    assert throughput.trim_warmup(df, ["run"], 60, 20).filter("run = 'a'").count() == 0


def test_summary_leaves_out_the_cache_line_without_hits(spark):
    rows = [("a", i, i * 1000, 12.5, True, False, "0.0", 5) for i in range(4)]
    df = spark.createDataFrame(rows, LOG + ", hot string, concurrency bigint")
    text = throughput.summary_text(throughput.sweep(df)).first().summary
    assert text.splitlines()[0] == "=== concurrency=5_hot=0.0 ===" and len(text.splitlines()) == 5


def test_target(spark):
    rows = [("a", i, i * 1000, 0.0, True, False) for i in range(1001)]
    r = throughput.against_target(spark.createDataFrame(rows, LOG), 1001).first()
    assert (r.verdict, r.percent, r.elapsed_sec) == ("PASS", 100.0, 1.0)
