"""Latency statistics of a request log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecquery.operators.joins import join_back
from vecquery.operators.ordered import bin_between, positions

PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
DECAY = 0.9


def percentiles(
    log: DataFrame, keys: Sequence[str], value: str = "latency_ms", bins: int = 256,
    wanted: dict[str, float] = PERCENTILES,
) -> DataFrame:
    """Exact order statistics per group: the value at index ``int(n * p)``, with min, max and n. Null values don't count.

    Equal values collapse before the shuffle. ``bins`` ranges with equally many rows, from a quantile sketch of all values,
    locate each wanted rank, and only the ranges that hold one are ordered, so no task ever holds a group, however
    narrow the values lie.
    """
    known = log.filter(F.col(value).isNotNull())
    cuts = known.select(F.col(value).cast("double").alias("x")).approxQuantile("x", [i / bins for i in range(1, bins)], 0.2 / bins)
    counts = known.groupBy(*keys, value).agg(F.count("*").alias("_n")).withColumn("_bin", bin_between(F.col(value), sorted(set(cuts))))
    ranges = counts.groupBy(*keys, "_bin").agg(
        F.sum("_n").alias("_in_bin"), F.min(value).alias("_low"), F.max(value).alias("_high")
    )
    group = W.partitionBy(*keys)
    upto = group.orderBy("_bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranges = ranges.select(
        *keys, "_bin", "_in_bin",
        (F.sum("_in_bin").over(upto) - F.col("_in_bin")).alias("_before"),
        F.sum("_in_bin").over(group).alias("n"),
        F.min("_low").over(group).alias("min"), F.max("_high").over(group).alias("max"),
    )
    names = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(p).alias("p")) for name, p in wanted.items()
    ])
    ranks = ranges.select("*", F.explode(names).alias("_want")).select(
        *keys, "_bin", "_before", "n", "min", "max", F.col("_want.name").alias("_name"),
        F.floor(F.col("n") * F.col("_want.p")).alias("_rank"), "_in_bin",
    ).filter("_before <= _rank AND _rank < _before + _in_bin")
    inside = W.partitionBy(*keys, "_bin", "_name").orderBy(value).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    reached = join_back(counts, ranks, [*keys, "_bin"]).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(inside)
    ).filter("_upto > _rank")
    return reached.groupBy(*keys).agg(
        F.first("n").alias("n"), F.first("min").alias("min"), F.first("max").alias("max"),
        *[F.min(F.when(F.col("_name") == name, F.col(value))).alias(name) for name in wanted],
    )


def percentiles_approx(
    log: DataFrame, keys: Sequence[str], value: str = "latency_ms", accuracy: int = 10_000
) -> DataFrame:
    """One mergeable summary per group, rank error at most n / accuracy."""
    found = F.percentile_approx(value, list(PERCENTILES.values()), accuracy)
    made = log.groupBy(*keys).agg(F.count("*").alias("n"), found.alias("_p"))
    return made.select(*keys, "n", *[F.col("_p")[i].alias(name) for i, name in enumerate(PERCENTILES)])


def ewma(log: DataFrame, keys: Sequence[str], bin_col: str, order: Sequence[str], value: str, out: str) -> DataFrame:
    """``avg = 0.9 * avg + 0.1 * x`` from 0 in the given order, one final value per series.

    Closed form: the i-th of n values weighs 0.1 * 0.9^(n - i). Bins make partial sums, so no series
    is held by one task.
    """
    placed = positions(log, keys, bin_col, order)
    term = F.lit(1 - DECAY) * F.pow(F.lit(DECAY), F.col("total") - F.col("position")) * F.col(value)
    return placed.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(term).alias(out))


def per_stage(responses: DataFrame, stages: str = "stages_latency") -> DataFrame:
    """Processed count and mean latency per stage from a map<stage, ms> column."""
    return responses.select(F.explode(stages).alias("stage", "ms")).groupBy("stage").agg(
        F.count("*").alias("processed"), F.coalesce(F.round(F.avg("ms"), 2), F.lit(0.0)).alias("avg_ms")
    )


def batch_stats(batches: DataFrame, bin_col: str, order: Sequence[str]) -> DataFrame:
    """One row over a batch log (items, batch_ms): batches, items, mean and decayed batch time."""
    placed = positions(batches, [], bin_col, order)
    weight = F.lit(1 - DECAY) * F.pow(F.lit(DECAY), F.col("total") - F.col("position"))
    return placed.agg(
        F.count("*").alias("total_batches"),
        F.coalesce(F.sum("items"), F.lit(0)).alias("total_items"),
        F.coalesce(F.round(F.avg("batch_ms"), 2), F.lit(0.0)).alias("avg_batch_ms"),
        F.coalesce(F.round(F.sum(weight * F.col("batch_ms")), 6), F.lit(0.0)).alias("decayed_batch_ms"),
    )


def fixed(x: Column, digits: int) -> Column:
    """Plain decimal text without thousands separators."""
    return F.regexp_replace(F.format_number(x, digits), ",", "")
