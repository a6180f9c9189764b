"""Continuous throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def throughput_windows(log: DataFrame, width: str, delay: str = "10 minutes") -> DataFrame:
    """Stream of ts, ok -> completed and errors per closed window. Rows later than ``delay`` are dropped."""
    return (
        log.withWatermark("ts", delay).groupBy(F.window("ts", width))
        .agg(F.count_if("ok").alias("completed"), F.count_if(~F.col("ok")).alias("errors"))
        .select(
            F.unix_micros("window.start").alias("start_us"), F.unix_micros("window.end").alias("end_us"),
            "completed", "errors",
        )
    )
