"""Positions, running totals and carried values over long ordered series.

A window over a whole series would put a hot series into one task. Each helper works on (series, bin)
windows instead, sums the bins up in a small table with one row per bin, and joins the bins' starting
values back. ``bin_col`` must not decrease along the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecquery.operators.joins import join_back
from vecquery.sources.tables import write_stage

#: Rows that one bin should get.
BIN_ROWS = 1_000_000


def even_bins(df: DataFrame, order: Sequence[Column | str], rows: int = BIN_ROWS, bin_col: str = "_bin") -> DataFrame:
    """Add a bin column that does not decrease along ``order`` and gives bins of about ``rows`` rows each.

    Rows are dealt by range of the whole order, so one value that most rows share is cut too where a later column tells
    its rows apart; a row costs the same however many bins there are. The result is kept as a table, which fixes the cut.
    """
    bins = -(-df.count() // rows)
    if bins <= 1:
        return df.withColumn(bin_col, F.lit(0).cast("bigint"))
    return write_stage(df.repartitionByRange(bins, *order).withColumn(bin_col, F.spark_partition_id().cast("bigint")), "bins")


def bin_between(value: Column, bounds: Sequence[float]) -> Column:
    """How many of the sorted ``bounds`` are less than the value: a tree of comparisons, as deep as the logarithm of their number."""
    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > F.lit(bounds[middle]), among(middle + 1, high)).otherwise(among(low, middle))

    return among(0, len(bounds))


def time_bin(ts_us: Column, width_us: int) -> Column:
    """Bins this wide: a task orders one series' rows of one bin, the bin table is ordered per series."""
    return F.floor(ts_us / F.lit(width_us)).cast("bigint")


def _bins_before(bins: DataFrame, keys: Sequence[str], bin_col: str, value: str) -> Column:
    before = W.partitionBy(*keys).orderBy(bin_col).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0))


def _series(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Without keys the frame is one series, named by a constant column."""
    return (df, list(keys)) if keys else (df.withColumn("_all", F.lit(0)), ["_all"])


def running_total(
    df: DataFrame, keys: Sequence[str], bin_col: str, order: Sequence[Column | str], totals: dict[str, str]
) -> DataFrame:
    """Add sums up to and including the row: ``totals`` maps each new column to the column it sums."""
    df, keys = _series(df, keys)
    bins = df.groupBy(*keys, bin_col).agg(*[F.sum(value).alias(f"_{out}") for out, value in totals.items()])
    bins = bins.select(*keys, bin_col, *[_bins_before(bins, keys, bin_col, f"_{out}").alias(f"_{out}") for out in totals])
    upto = W.partitionBy(*keys, bin_col).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = df.withColumns({out: F.sum(value).over(upto) for out, value in totals.items()})
    return join_back(inside, bins, [*keys, bin_col]).withColumns(
        {out: F.col(out) + F.col(f"_{out}") for out in totals}
    ).drop("_all", *[f"_{out}" for out in totals])


def positions(
    df: DataFrame, keys: Sequence[str], bin_col: str, order: Sequence[Column | str],
    out: str = "position", total: str = "total",
) -> DataFrame:
    """Add the 1-based position of every row in its series and the length of the series."""
    df, keys = _series(df, keys)
    bins = df.groupBy(*keys, bin_col).agg(F.count("*").alias("_rows"))
    bins = bins.select(
        *keys, bin_col, _bins_before(bins, keys, bin_col, "_rows").alias("_before"),
        F.sum("_rows").over(W.partitionBy(*keys)).alias(total),
    )
    ranked = df.withColumn("_place", F.row_number().over(W.partitionBy(*keys, bin_col).orderBy(*order)))
    return join_back(ranked, bins, [*keys, bin_col]).withColumn(out, F.col("_before") + F.col("_place")).drop(
        "_before", "_place", "_all"
    )


def carried(
    df: DataFrame, keys: Sequence[str], bin_col: str, order: Sequence[str], value: str, out: str,
    backwards: bool = False,
) -> DataFrame:
    """Add ``out``: the last non-null ``value`` at or before the row.

    ``order`` names ascending columns (nulls first). ``backwards`` walks the series from its end, so
    ``out`` is the first non-null value at or after the row.
    """
    place = F.struct(*order)
    if backwards:
        row_order, bin_order, extreme = place.desc(), F.desc(bin_col), F.min_by
    else:
        row_order, bin_order, extreme = place.asc(), F.asc(bin_col), F.max_by
    known = F.when(F.col(value).isNotNull(), place)
    bins = df.groupBy(*keys, bin_col).agg(extreme(F.col(value), known).alias("_edge"))
    earlier = W.partitionBy(*keys).orderBy(bin_order).rowsBetween(W.unboundedPreceding, -1)
    bins = bins.select(*keys, bin_col, F.last("_edge", ignorenulls=True).over(earlier).alias("_edge"))
    inside = W.partitionBy(*keys, bin_col).orderBy(row_order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = df.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    return join_back(local, bins, [*keys, bin_col]).withColumn(out, F.coalesce("_local", "_edge")).drop(
        "_local", "_edge"
    )
