"""Equi-joins that also match null with null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_back(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, null matching null, and keep the left side's keys.

    For results that were aggregated from ``left`` and go back to its rows, so that rows with a null key are not lost.
    """
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in keys]
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])
