"""Sketches of a request log per window, stored and merged for any period and grouping.

A window keeps a quantile sketch of its latencies and counters of its most frequent queries; both are a few kilobytes whatever
the traffic, and merging those of many windows gives the sketch of the whole within the same error. So a dashboard reads
windows, never the log. On a stream ``per_window`` runs on each micro-batch: a window then has a row per micro-batch that brought
some of it, late rows included, and ``merged`` puts them together like any others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecquery.operators.latency import PERCENTILES

#: Size of a quantile sketch.
QUANTILE_K = 800
#: Rank error of such a sketch as a share of the values, with 99 % confidence (fixed value: as the sketch library states).
RANK_ERROR = 2.296 / QUANTILE_K**0.9723
#: Queries counted per window.
TRACKED = 2_000


def count_error(n: Column, tracked: int = TRACKED) -> Column:
    """The most by which a query's count among ``n`` requests is off; a query not reported occurs no more often."""
    return F.ceil(n * 3.5 / tracked)


def per_window(log: DataFrame, keys: Sequence[str], width: str, query: str = "key", value: str = "latency_ms", tracked: int = TRACKED) -> DataFrame:
    """``keys, start, n, latencies, queries`` for a log with ``ts``: one row of sketches per window of ``width`` and group.

    Null values count as requests but not as latencies.
    """
    return log.groupBy(F.window("ts", width).alias("w"), *keys).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), QUANTILE_K).alias("latencies"),
        F.expr(f"approx_top_k_accumulate(`{query}`, {int(tracked)})").alias("queries"),
    ).select(*keys, F.col("w.start").alias("start"), "n", "latencies", "queries")


def merged(windows: DataFrame, keys: Sequence[str], tracked: int = TRACKED) -> DataFrame:
    """Sketches of windows put together by ``keys``, again with ``n, latencies, queries``."""
    return windows.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("latencies", QUANTILE_K).alias("latencies"),
        F.expr(f"approx_top_k_combine(queries, {int(tracked)})").alias("queries"),
    )


def percentiles(sketched: DataFrame, wanted: dict[str, float] = PERCENTILES) -> DataFrame:
    """Add a column per wanted percentile, its rank off by at most ``RANK_ERROR``; null where no latency is known."""
    known = F.kll_sketch_get_n_double("latencies") > 0
    return sketched.withColumns({
        name: F.when(known, F.kll_sketch_get_quantile_double("latencies", F.lit(p))) for name, p in wanted.items()
    })


def top_queries(sketched: DataFrame, keys: Sequence[str], top: int) -> DataFrame:
    """``keys, query, requests, error``: the most frequent queries by estimate, and how far each count may be off."""
    found = F.inline(F.expr(f"approx_top_k_estimate(queries, {int(top)})"))
    return sketched.select(*keys, count_error(F.col("n")).alias("error"), found.alias("query", "requests")).select(*keys, "query", "requests", "error")
