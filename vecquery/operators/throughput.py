"""Throughput, error and load reports of a request log.

A log has request_id, ts_us (start, microseconds), latency_ms, ok, cache_hit and grouping columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecquery.operators.latency import PERCENTILES, fixed, percentiles
from vecquery.operators.joins import join_back
from vecquery.operators.ordered import BIN_ROWS, even_bins, positions, running_total

SECOND_US = 1_000_000


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def end_us(ts_us: Column, latency_ms: Column) -> Column:
    return ts_us + F.round(latency_ms * 1000).cast("bigint")


def run_totals(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per run: requests, duration, throughput, errors and cache hits. Failed requests count as work."""
    made = log.groupBy(*keys).agg(
        F.count("*").alias("total_requests"),
        (F.max(end_us(F.col("ts_us"), F.col("latency_ms"))) - F.min("ts_us")).alias("_us"),
        F.count_if(~F.col("ok")).alias("error_count"),
        F.count_if(F.col("ok") & F.col("cache_hit")).alias("_hits"),
    ).withColumn("duration_sec", F.coalesce(F.col("_us") / SECOND_US, F.lit(0.0)))
    n = F.col("total_requests")
    return made.select(
        *keys, n, F.round("duration_sec", 6).alias("duration_sec"),
        F.round(_ratio(n, F.col("duration_sec")), 6).alias("throughput_ops"),
        "error_count",
        F.round(_ratio(F.col("error_count"), n), 6).alias("error_rate"),
        F.round(_ratio(F.col("_hits"), n), 6).alias("cache_hit_rate"),
    )


def benchmark(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Run totals with latency percentiles, two decimals."""
    spread = percentiles(log, keys).drop("n")
    shown = [F.round(c, 2).alias(f"latency_{c}_ms") for c in ("min", "max", *PERCENTILES)]
    return join_back(run_totals(log, keys), spread.select(*keys, *shown), keys, "left")


def sweep(log: DataFrame, warmup: int | None = 0) -> DataFrame:
    """One named benchmark row per hot ratio (text) and concurrency.

    ``warmup`` requests of each run are dropped first; None drops max(50, a tenth of the run), as a load test does.
    """
    if warmup != 0:
        log = trim_warmup(log, ["hot", "concurrency"], warmup)
    name = F.concat(F.lit("concurrency="), F.col("concurrency").cast("string"), F.lit("_hot="), F.col("hot"))
    return benchmark(log, ["hot", "concurrency"]).withColumn("name", name)


def summary_text(results: DataFrame) -> DataFrame:
    """The report lines of each benchmark row; the cache line only where there were hits."""
    percent = F.lit(100)
    # The labels of the report.
    lines = [
        F.concat(F.lit("=== "), F.col("name"), F.lit(" ===")),
        F.concat(F.lit("  请求数: "), F.col("total_requests").cast("string"),
                 F.lit("  |  并发: "), F.col("concurrency").cast("string")),
        F.concat(F.lit("  耗时: "), fixed(F.col("duration_sec"), 2),
                 F.lit("s  |  吞吐: "), fixed(F.col("throughput_ops"), 0), F.lit(" ops")),
        F.concat(
            F.lit("  延迟: P50="), fixed(F.col("latency_p50_ms"), 1),
            F.lit("ms  P95="), fixed(F.col("latency_p95_ms"), 1),
            F.lit("ms  P99="), fixed(F.col("latency_p99_ms"), 1),
            F.lit("ms  Max="), fixed(F.col("latency_max_ms"), 1), F.lit("ms"),
        ),
        F.concat(F.lit("  错误: "), F.col("error_count").cast("string"),
                 F.lit(" ("), fixed(F.col("error_rate") * percent, 1), F.lit("%)")),
        F.when(
            F.col("cache_hit_rate") > 0,
            F.concat(F.lit("  缓存命中: "), fixed(F.col("cache_hit_rate") * percent, 1), F.lit("%")),
        ),
    ]
    return results.select("name", F.array_join(F.array(*lines), "\n").alias("summary"))


def progress(log: DataFrame, tick_sec: int) -> DataFrame:
    """State at the end of every tick since the first request, quiet ticks included.

    Requests are counted per tick first; what is ordered afterwards has one row per tick. Ticks come from a range, so
    no row holds them all.
    """
    width = tick_sec * SECOND_US
    start, last = log.agg(F.min("ts_us"), F.max("ts_us")).first()
    spark = log.sparkSession
    slots = 0 if start is None else (last - start) // width + 1
    counted = log.groupBy(F.floor((F.col("ts_us") - F.lit(start)) / width).alias("slot")).agg(
        F.count_if("ok").alias("_done"), F.count_if(~F.col("ok")).alias("_failed")
    )
    every = spark.range(slots).withColumnRenamed("id", "slot").join(counted, "slot", "left").select(
        "slot", F.coalesce("_done", F.lit(0)).alias("_done"), F.coalesce("_failed", F.lit(0)).alias("_failed"),
        F.floor(F.col("slot") / 3600).alias("_bin"),
    )
    both = running_total(every, [], "_bin", ["slot"], {"completed": "_done", "errors": "_failed"})
    elapsed = (F.col("slot") + 1) * tick_sec
    return both.select(
        elapsed.alias("elapsed_sec"), "completed", "errors",
        F.round(F.col("completed") / elapsed, 6).alias("current_ops"),
    )


def against_target(log: DataFrame, target_ops: float) -> DataFrame:
    """One row: actual throughput of the whole log against the target."""
    made = log.agg(
        F.count_if("ok").alias("completed"),
        ((F.max(end_us(F.col("ts_us"), F.col("latency_ms"))) - F.min("ts_us")) / SECOND_US).alias("elapsed_sec"),
    )
    actual = _ratio(F.col("completed"), F.col("elapsed_sec"))
    return made.select(
        F.lit(float(target_ops)).alias("target_ops"), "completed",
        F.round("elapsed_sec", 6).alias("elapsed_sec"), F.round(actual, 6).alias("actual_ops"),
        F.when(actual >= target_ops, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("verdict"),
        F.round(actual / F.lit(float(target_ops)) * 100, 1).alias("percent"),
    )


def hot_queries(log: DataFrame, query: str, top: int) -> DataFrame:
    """The ``top`` most repeated queries and their share of all requests."""
    counts = log.groupBy(query).agg(F.count("*").alias("requests"))
    best = counts.orderBy(F.desc("requests"), F.asc(query)).limit(top)
    share = F.col("requests") / log.agg(F.count("*")).scalar()
    return best.select(query, "requests", F.round(share, 6).alias("share"))


def in_flight(log: DataFrame, start: str = "start_us", end: str = "end_us", rows: int = BIN_ROWS) -> DataFrame:
    """Open requests right after each change of load; an ending request leaves before one starts."""
    opened = log.select(F.col(start).alias("at_us"), F.lit(1).alias("change"))
    closed = log.select(F.col(end).alias("at_us"), F.lit(-1).alias("change"))
    changes = opened.unionByName(closed).groupBy("at_us").agg(
        F.sum("change").alias("change"), F.count_if(F.col("change") == 1).alias("started")
    )
    return running_total(even_bins(changes, ["at_us"], rows), [], "_bin", ["at_us"], {"open": "change"}).select("at_us", "started", "open")


def trim_warmup(log: DataFrame, keys: Sequence[str], warmup: int | None = None, rows: int = BIN_ROWS) -> DataFrame:
    """Drop the first ``warmup`` requests of each run, by default max(50, a tenth of the run)."""
    order = ["ts_us", "request_id"]
    placed = positions(even_bins(log, order, rows), keys, "_bin", order, "_position", "_total")
    cut = F.lit(warmup) if warmup is not None else F.greatest(F.lit(50), F.floor(F.col("_total") / 10))
    return placed.filter(F.col("_position") > cut).drop("_bin", "_position", "_total")
