"""Helpers that several operators share: bounded labelled samples and slices of Arrow batches."""

from __future__ import annotations

import ctypes
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecquery.sources.tables import write_stage

#: Texts are handed to NumPy in slices of about so many characters, which bounds a worker's memory.
SLICE_CHARS = 4_000_000


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``most`` characters each; a longer text stands alone."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        if chars and chars + len(text) > most:
            yield start, i
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield start, len(texts)


_kept: dict[str, dict] = {}


def worker_cache(model: str) -> dict:
    """What this worker keeps for a model. Workers are used again and again: what was kept for another model goes."""
    if model not in _kept:
        _kept.clear()
        _kept[model] = {}
        give_back()
    return _kept[model]


def give_back() -> None:
    """Freed memory goes back to the system, so that a worker's next task does not add to what the last one used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU only
    if trim:
        trim(0)


def thinned(rows: DataFrame, key: Column, wanted: int, count: int) -> DataFrame:
    """Rows that a hash of ``key`` picks, about four times ``wanted`` of ``count``, or all if there are fewer.

    A sample is then taken from these in a fixed order, so what reaches the driver doesn't grow with the table.
    """
    share = 4 * wanted / max(1, count)
    if share >= 1:
        return rows
    return rows.filter(F.pmod(F.xxhash64(key, F.lit("thin")), F.lit(1 << 40)) < int(share * (1 << 40)))


def hashed_sample(rows: DataFrame, text: str, wanted: int) -> list[str]:
    """At most ``wanted`` different values of a text column, chosen by their hash."""
    table = rows.select(text)
    few = thinned(table, F.xxhash64(text), wanted, table.count()).distinct()
    return [r[0] for r in few.orderBy(F.xxhash64(text), text).limit(wanted).collect()]


def id_crc(column: str = "doc_id") -> Column:
    """CRC-32 of the id written as text."""
    return F.crc32(F.col(column).cast("string"))


@dataclass(frozen=True)
class Sample:
    """Labelled texts on the driver, and how many labelled rows of each class there are in all."""

    texts: list[str]
    labels: np.ndarray
    totals: tuple[int, int]


def every_nth(labels: np.ndarray, n: int) -> np.ndarray:
    """Marks every n-th row of each class, so that parts of a sample hold all classes."""
    out = np.zeros(len(labels), dtype=bool)
    for y in np.unique(labels):
        out[np.flatnonzero(labels == y)[::n]] = True
    return out


def labelled_ids(labels: DataFrame, label: str, usable: Column) -> DataFrame:
    """``doc_id, y``: one row per usable labelled id; ids with contradictory or null labels are left out."""
    return (
        labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(usable)
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("_top"))
        .filter("y = _top")
        .select("doc_id", "y")
    )


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: tuple[int, int], most_chars: int
) -> Sample:
    """At most ``per_class`` texts of labels 0 and 1 and ``most_chars`` characters, chosen by a hash of the id.

    Ids and lengths are chosen first, so that only the chosen texts reach the driver. A text occurs once,
    however many ids carry it; null texts are left out.
    """
    known = labelled_ids(labels, label, usable)
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    texts = documents.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    lengths = texts.select("doc_id", F.length("text").alias("n"), F.xxhash64("text").alias("h"))
    rows = write_stage(
        lengths.join(known, "doc_id").withColumn("o", F.xxhash64(F.col("doc_id"), F.lit(label))), "labelled"
    )
    chosen: dict[int, int] = {}
    for y in (0, 1):
        left, seen = most_chars // 2, set()
        few = thinned(rows.filter(F.col("y") == y), F.col("o"), per_class[y], totals.get(y, 0))
        for r in few.orderBy("o", "doc_id").limit(per_class[y]).collect():
            if r["h"] in seen or r["n"] > left:
                continue
            seen.add(r["h"])
            left -= r["n"]
            chosen[r["doc_id"]] = y
    if not chosen:
        return Sample([], np.zeros(0, dtype=np.int64), (totals.get(0, 0), totals.get(1, 0)))
    got = texts.filter(F.col("doc_id").isin(list(chosen))).dropDuplicates(["doc_id"]).collect()
    got.sort(key=lambda r: r["doc_id"])
    return Sample(
        [r["text"] for r in got],
        np.array([chosen[r["doc_id"]] for r in got], dtype=np.int64),
        (totals.get(0, 0), totals.get(1, 0)),
    )


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights, intercept last, of a ridge-penalised logistic regression (Newton steps)."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty @ w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays as one byte string."""
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as stored:
        return {name: stored[name] for name in stored.files}
