"""Null keys, values and series are kept and counted."""

from pyspark.sql import functions as F

from vecquery.operators import coalesce, embed, latency, ordered, throughput

LOG = "run string, ts_us bigint, request_id bigint, latency_ms double, ok boolean, cache_hit boolean"


def test_null_texts_and_keys_stay(spark):
    texts = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "id int, t string")
    got = embed.embed_distinct(texts, "t", lambda d: embed.embed_hashed(d, "t", 8)).collect()
    assert sorted(r["id"] for r in got) == [1, 2, 3, 4] and all(sum(r["embedding"]) == 0 for r in got if r["id"] % 2 == 0)
    asked = spark.createDataFrame([("k", 1, "q"), (None, 2, None), (None, 3, None)], "key string, id int, q string")
    made = coalesce.run_once(asked, lambda d: d.select("key", F.lit("x").alias("answer")), ["q"])
    assert sorted(r["id"] for r in made.collect()) == [1, 2, 3]


def test_null_groups_and_values(spark):
    rows = [(r, i, i, v, True, False) for r in ("a", None) for i, v in enumerate([1.0, 2.0, None, 3.0])]
    got = {r["run"]: r for r in latency.percentiles(spark.createDataFrame(rows, LOG), ["run"]).collect()}
    assert set(got) == {"a", None} and all((r["n"], r["min"], r["p50"], r["max"]) == (3, 1.0, 2.0, 3.0) for r in got.values())
    assert {r["run"]: r["total_requests"] for r in throughput.benchmark(spark.createDataFrame(rows, LOG), ["run"]).collect()} == {"a": 4, None: 4}


def test_null_series_and_instants(spark):
    rows = [(r, t, i) for i, (r, t) in enumerate([("a", 1), (None, 5), (None, None), ("a", None), (None, 7)])]
    df = spark.createDataFrame(rows, "run string, ts_us bigint, id int")
    df = ordered.even_bins(df, ["ts_us", "id"], 2)
    got = {r["id"]: (r["position"], r["total"]) for r in ordered.positions(df, ["run"], "_bin", ["ts_us", "id"]).collect()}
    assert got == {0: (2, 2), 3: (1, 2), 2: (1, 3), 1: (2, 3), 4: (3, 3)}


def test_bins_follow_the_data(spark):
    """A burst inside one minute, and values inside one unit, are cut into even bins all the same."""
    burst = spark.range(10_000).select((F.col("id") + 1_700_000_000_000_000).alias("ts_us"))
    sizes = ordered.even_bins(burst, ["ts_us"], 500).groupBy("_bin").count().collect()
    assert len(sizes) >= 15 and max(r["count"] for r in sizes) <= 1_000
    log = spark.range(5_000).select(F.lit("a").alias("run"), (F.col("id") / 5_000).alias("latency_ms"))
    row = latency.percentiles(log, ["run"]).first()
    assert (row["n"], row["min"], row["p50"], row["p95"]) == (5_000, 0.0, 0.5, 0.95)


def test_one_instant_of_most_rows_is_cut_too(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(5).alias("ts_us"), F.col("id"))
    order = ["ts_us", "id"]
    binned = ordered.even_bins(rows, order, 1_000)
    sizes = [r["count"] for r in binned.groupBy("_bin").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 2_000
    placed = ordered.positions(binned, [], "_bin", order).select("ts_us", "id", "position").collect()
    want = {(r[0], r[1]): i for i, r in enumerate(sorted((p["ts_us"], p["id"]) for p in placed), 1)}
    assert {(p["ts_us"], p["id"]): p["position"] for p in placed} == want


def test_bins_between_bounds(spark):
    values = spark.createDataFrame([(float(x),) for x in (-5, 0, 0.5, 1, 2, 3, 9)], "x double")
    for bounds in ([], [0.0], [0.0, 1.0, 2.0, 3.0, 4.0]):
        got = [(r.x, r.b) for r in values.select("x", ordered.bin_between(F.col("x"), bounds).alias("b")).collect()]
        assert got == [(x, sum(b < x for b in bounds)) for x, _ in got]
