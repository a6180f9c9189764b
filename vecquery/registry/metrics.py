"""Request-log reports. The log is ``events``: value is the latency, 'error' rows are failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecquery.operators import latency, sketches, throughput
from vecquery.operators.joins import join_back
from vecquery.operators.ordered import even_bins, time_bin
from vecquery.sources.tables import read_table, write_stage

HOUR_US = 3_600_000_000
LEVELS = [1, 5, 10, 25, 50, 100, 200, 500]  # fixed values: default concurrency levels
TARGET_OPS = 50_000
ORDER = ["ts_us", "request_id"]
TICK_SEC = 60


def request_log(spark: SparkSession, folder: str, where: Column | None = None) -> DataFrame:
    """``where`` is a condition on the raw columns, so that it reaches the scan."""
    raw = read_table(spark, folder, "events")
    if where is not None:
        raw = raw.filter(where)
    k = F.get_json_object("props", "$.k").cast("int")
    level = F.element_at(F.array(*[F.lit(x) for x in LEVELS]), (k / 13).cast("int") + 1)
    ts_us = F.unix_micros(F.col("ts").cast("timestamp"))
    return raw.select(
        F.col("event_id").alias("request_id"), "user_id", "event_type",
        F.concat(F.lit("rag:"), "event_type", F.lit(":"), k.cast("string")).alias("key"),
        k.alias("k"), ts_us.alias("ts_us"), F.to_date("ts").cast("string").alias("run"),
        F.col("value").alias("latency_ms"),
        (F.col("event_type") != "error").alias("ok"), (F.col("event_type") == "view").alias("cache_hit"),
        level.cast("bigint").alias("concurrency"),
        F.when(F.col("event_type").isin("click", "view"), F.lit("0.5")).otherwise(F.lit("0.0")).alias("hot"),
    )


def _rounded(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def latency_percentiles(spark, folder):
    made = latency.percentiles(request_log(spark, folder), ["event_type"])
    return _rounded(made, ["min", "max", "p50", "p95", "p99"])


def latency_percentiles_approx(spark, folder):
    """For each sketched percentile, whether its rank among the values is as near the wanted one as promised."""
    log = request_log(spark, folder)
    found = latency.percentiles_approx(log, ["event_type"])
    names = list(latency.PERCENTILES)
    ranks = join_back(log.select("event_type", "latency_ms"), found, ["event_type"]).groupBy("event_type", "n").agg(*[
        F.struct(F.count_if(F.col("latency_ms") < F.col(p)).alias("below"), F.count_if(F.col("latency_ms") <= F.col(p)).alias("upto")).alias(p)
        for p in names
    ])
    slack = F.col("n") / 10_000 + 1

    def near(p: str, share: float):
        wanted = F.col("n") * share
        return ((F.col(p)["below"] <= wanted + slack) & (F.col(p)["upto"] >= wanted - slack)).alias(f"{p}_near")

    return ranks.select("event_type", "n", *[near(p, latency.PERCENTILES[p]) for p in names])


def _hourly(spark, folder):
    log = request_log(spark, folder).withColumn("ts", F.timestamp_micros("ts_us"))
    return write_stage(sketches.per_window(log, ["event_type"], "1 hour"), "sketches")


def latency_sketches(spark, folder):
    """Hourly sketches merged to the whole time: whether each percentile's rank is as near the wanted one as promised."""
    found = sketches.percentiles(sketches.merged(_hourly(spark, folder), ["event_type"])).select("event_type", "n", *latency.PERCENTILES)
    log = request_log(spark, folder).select("event_type", "latency_ms")
    ranks = join_back(log, found, ["event_type"]).groupBy("event_type", "n").agg(*[
        F.struct(F.count_if(F.col("latency_ms") < F.col(p)).alias("below"), F.count_if(F.col("latency_ms") <= F.col(p)).alias("upto")).alias(p)
        for p in latency.PERCENTILES
    ])
    slack = F.col("n") * sketches.RANK_ERROR + 1
    return ranks.select("event_type", "n", *[
        ((F.col(p)["below"] <= F.col("n") * share + slack) & (F.col(p)["upto"] >= F.col("n") * share - slack)).alias(f"{p}_near")
        for p, share in latency.PERCENTILES.items()
    ])


def hot_queries_sketched(spark, folder):
    """The exact top twenty, and whether the counters merged over all hours have each within their stated error."""
    exact = hot_queries(spark, folder).select("key", "requests")
    whole = sketches.merged(_hourly(spark, folder), [])
    counted = sketches.top_queries(whole, [], sketches.TRACKED).select(F.col("query").alias("key"), F.col("requests").alias("counted"), "error")
    near = F.abs(F.col("requests") - F.coalesce("counted", F.lit(0))) <= F.coalesce("error", F.lit(0))
    return exact.join(counted, "key", "left").select("key", "requests", near.alias("near"))


def benchmark_summary(spark, folder):
    return throughput.run_totals(request_log(spark, folder), ["run"])


def benchmark_sweep(spark, folder):
    return throughput.sweep(request_log(spark, folder), warmup=None).orderBy("hot", "concurrency")


def stage_latency(spark, folder):
    stages = F.create_map(F.lit("embedding"), F.col("latency_ms"), F.lit("vector_search"), F.col("k").cast("double"))
    return latency.per_stage(request_log(spark, folder).select(stages.alias("stages_latency")))


def ewma(spark, folder):
    log = request_log(spark, folder)
    made = latency.ewma(even_bins(log, ORDER), ["event_type"], "_bin", ORDER, "latency_ms", "avg_ms")
    return _rounded(made, ["avg_ms"], 6)


def search_log_latency(spark, folder):
    """Latency as shown on hits (three decimals) and its decayed average per user."""
    log = request_log(spark, folder).filter("ok").select(
        "user_id", "request_id", "ts_us", F.round("latency_ms", 3).alias("latency_ms")
    )
    made = latency.ewma(even_bins(log, ORDER), ["user_id"], "_bin", ORDER, "latency_ms", "avg_search_time_ms")
    return _rounded(made, ["avg_search_time_ms"], 3)


def throughput_progress(spark, folder):
    return throughput.progress(request_log(spark, folder), TICK_SEC)


def throughput_target(spark, folder):
    return throughput.against_target(request_log(spark, folder), TARGET_OPS)


def hot_queries(spark, folder):
    return throughput.hot_queries(request_log(spark, folder), "key", 20)


def in_flight(spark, folder):
    """Latencies read as minutes, so that requests overlap."""
    log = request_log(spark, folder).select(
        F.col("ts_us").alias("start_us"),
        (F.col("ts_us") + F.round(F.col("latency_ms") * 60_000_000).cast("bigint")).alias("end_us"),
    )
    return throughput.in_flight(log)


def embedding_stats(spark, folder):
    """Each hour's requests are one embedding batch."""
    batches = request_log(spark, folder).groupBy(time_bin(F.col("ts_us"), HOUR_US).alias("hour")).agg(
        F.count("*").alias("items"), F.round(F.sum("latency_ms"), 2).alias("batch_ms")
    ).withColumn("day", F.floor(F.col("hour") / 24))
    return latency.batch_stats(batches, "day", ["hour"])


def warmup_trim(spark, folder):
    kept = throughput.trim_warmup(request_log(spark, folder), ["event_type"])
    return kept.select("event_type", "request_id")


def summary_text(spark, folder):
    return throughput.summary_text(throughput.sweep(request_log(spark, folder)))


LOG = f"""
log AS (SELECT event_id AS request_id, user_id, event_type, (props->>'$.k')::INT AS k,
  'rag:' || event_type || ':' || (props->>'$.k') AS key, epoch_us(ts) AS ts_us, ts::DATE::VARCHAR AS run,
  value AS latency_ms, event_type <> 'error' AS ok, event_type = 'view' AS cache_hit,
  {LEVELS}[(props->>'$.k')::INT // 13 + 1]::BIGINT AS concurrency,
  CASE WHEN event_type IN ('click', 'view') THEN '0.5' ELSE '0.0' END AS hot FROM events)
"""


def _at(p: float) -> str:
    return f"round(list_sort(list(latency_ms))[floor(count(*) * {p}::DOUBLE)::BIGINT + 1], 2)"


_DURATION = "((max(ts_us + round(latency_ms * 1000)::BIGINT) - min(ts_us)) / 1000000)"
_TOTALS = f"""count(*) AS total_requests, round({_DURATION}, 6) AS duration_sec,
  round(count(*) / {_DURATION}, 6) AS throughput_ops, count(*) FILTER (NOT ok) AS error_count,
  round(count(*) FILTER (NOT ok) / count(*), 6) AS error_rate,
  round(count(*) FILTER (ok AND cache_hit) / count(*), 6) AS cache_hit_rate"""
_SWEEP = f"""SELECT hot, concurrency, {_TOTALS}, round(min(latency_ms), 2) AS latency_min_ms,
  round(max(latency_ms), 2) AS latency_max_ms, {_at(0.5)} AS latency_p50_ms, {_at(0.95)} AS latency_p95_ms,
  {_at(0.99)} AS latency_p99_ms, 'concurrency=' || concurrency || '_hot=' || hot AS name
FROM log GROUP BY hot, concurrency"""


def _ewma(key: str, value: str, source: str) -> str:
    return f"""SELECT {key}, sum(0.1::DOUBLE * pow(0.9::DOUBLE, n - i) * {value}) AS a, max(n) AS n FROM (
  SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY ts_us, request_id) AS i,
    count(*) OVER (PARTITION BY {key}) AS n FROM {source}) GROUP BY {key}"""


ENTRIES = {
    "latency_percentiles": (latency_percentiles, f"""
WITH {LOG} SELECT event_type, count(*) AS n, round(min(latency_ms), 2) AS min, round(max(latency_ms), 2) AS max,
  {_at(0.5)} AS p50, {_at(0.95)} AS p95, {_at(0.99)} AS p99 FROM log GROUP BY event_type"""),
    "latency_percentiles_approx": (latency_percentiles_approx, f"""
WITH {LOG} SELECT event_type, count(*) AS n, true AS p50_near, true AS p95_near, true AS p99_near FROM log GROUP BY 1"""),
    "benchmark_summary": (benchmark_summary, f"WITH {LOG} SELECT run, {_TOTALS} FROM log GROUP BY run"),
    "benchmark_sweep": (benchmark_sweep, f"""
WITH {LOG.replace("log AS", "whole AS", 1)}, log AS (SELECT * FROM whole QUALIFY
  row_number() OVER (PARTITION BY hot, concurrency ORDER BY ts_us, request_id)
  > greatest(50, count(*) OVER (PARTITION BY hot, concurrency) // 10)) {_SWEEP}"""),
    "stage_latency": (stage_latency, f"""
WITH {LOG} SELECT 'embedding' AS stage, count(*) AS processed, round(avg(latency_ms), 2) AS avg_ms FROM log
UNION ALL SELECT 'vector_search', count(*), round(avg(k), 2) FROM log"""),
    "ewma": (ewma, f"""
WITH {LOG} SELECT event_type, n, round(a, 6) AS avg_ms FROM ({_ewma('event_type', 'latency_ms', 'log')})"""),
    "search_log_latency": (search_log_latency, f"""
WITH {LOG}, s AS (SELECT * REPLACE (round(latency_ms, 3) AS latency_ms) FROM log WHERE ok)
SELECT user_id, n, round(a, 3) AS avg_search_time_ms FROM ({_ewma('user_id', 'latency_ms', 's')})"""),
    "throughput_progress": (throughput_progress, f"""
WITH {LOG}, b AS (SELECT min(ts_us) AS t0, max(ts_us) AS t1 FROM log),
c AS (SELECT (ts_us - t0) // {TICK_SEC * 1_000_000} AS slot, count(*) FILTER (ok) AS d,
  count(*) FILTER (NOT ok) AS e FROM log, b GROUP BY 1),
s AS (SELECT unnest(range((t1 - t0) // {TICK_SEC * 1_000_000} + 1)) AS slot FROM b),
r AS (SELECT (slot + 1) * {TICK_SEC} AS elapsed_sec, (sum(coalesce(d, 0)) OVER (ORDER BY slot))::BIGINT AS completed,
  (sum(coalesce(e, 0)) OVER (ORDER BY slot))::BIGINT AS errors FROM s LEFT JOIN c USING (slot))
SELECT *, round(completed / elapsed_sec, 6) AS current_ops FROM r"""),
    "throughput_target": (throughput_target, f"""
WITH {LOG}, t AS (SELECT count(*) FILTER (ok) AS completed, {_DURATION} AS el FROM log)
SELECT {TARGET_OPS}::DOUBLE AS target_ops, completed, round(el, 6) AS elapsed_sec, round(completed / el, 6) AS actual_ops,
  CASE WHEN completed / el >= {TARGET_OPS} THEN 'PASS' ELSE 'FAIL' END AS verdict,
  round(completed / el / {TARGET_OPS} * 100, 1) AS percent FROM t"""),
    "latency_sketches": (latency_sketches, f"""
WITH {LOG} SELECT event_type, count(*) AS n, true AS p50_near, true AS p95_near, true AS p99_near FROM log GROUP BY 1"""),
    "hot_queries_sketched": (hot_queries_sketched, f"""
WITH {LOG} SELECT key, count(*) AS requests, true AS near FROM log GROUP BY 1 ORDER BY requests DESC, key LIMIT 20"""),
    "hot_queries": (hot_queries, f"""
WITH {LOG} SELECT key, count(*) AS requests, round(count(*) / (SELECT count(*) FROM log), 6) AS share
FROM log GROUP BY key ORDER BY requests DESC, key LIMIT 20"""),
    "in_flight": (in_flight, f"""
WITH {LOG}, c AS (SELECT ts_us AS at_us, 1 AS change FROM log
  UNION ALL SELECT ts_us + round(latency_ms * 60000000)::BIGINT, -1 FROM log),
s AS (SELECT at_us, sum(change) AS change, count(*) FILTER (change = 1) AS started FROM c GROUP BY at_us)
SELECT at_us, started, (sum(change) OVER (ORDER BY at_us))::BIGINT AS open FROM s"""),
    "embedding_stats": (embedding_stats, f"""
WITH {LOG}, b AS (SELECT ts_us // {HOUR_US} AS hour, count(*) AS items, round(sum(latency_ms), 2) AS batch_ms
  FROM log GROUP BY 1),
p AS (SELECT *, row_number() OVER (ORDER BY hour) AS i, count(*) OVER () AS n FROM b)
SELECT count(*) AS total_batches, sum(items)::BIGINT AS total_items, round(avg(batch_ms), 2) AS avg_batch_ms,
  round(sum(0.1::DOUBLE * pow(0.9::DOUBLE, n - i) * batch_ms), 6) AS decayed_batch_ms FROM p"""),
    "warmup_trim": (warmup_trim, f"""
WITH {LOG}, p AS (SELECT event_type, request_id, row_number() OVER (PARTITION BY event_type ORDER BY ts_us, request_id) AS i,
  count(*) OVER (PARTITION BY event_type) AS n FROM log)
SELECT event_type, request_id FROM p WHERE i > greatest(50, n // 10)"""),
    "summary_text": (summary_text, f"""
WITH {LOG}, s AS ({_SWEEP})
SELECT name, '=== ' || name || ' ===' || chr(10) || '  请求数: ' || total_requests || '  |  并发: ' || concurrency || chr(10)
  || printf('  耗时: %.2fs  |  吞吐: %.0f ops', duration_sec, throughput_ops) || chr(10)
  || printf('  延迟: P50=%.1fms  P95=%.1fms  P99=%.1fms  Max=%.1fms',
       latency_p50_ms, latency_p95_ms, latency_p99_ms, latency_max_ms) || chr(10)
  || printf('  错误: %d (%.1f%%)', error_count, error_rate * 100)
  || CASE WHEN cache_hit_rate > 0 THEN chr(10) || printf('  缓存命中: %.1f%%', cache_hit_rate * 100) ELSE '' END AS summary
FROM s"""),
}
