"""Best-fit packing of token pieces by patterns.

Documents become pieces of at most ``size`` tokens; only longer documents are cut. What the plan needs of the
pieces is the histogram of their lengths, whose size does not depend on the data. Patterns of one to three length
classes of ``GRAIN`` tokens that fill a sequence are enumerated, and their repeat counts are fitted by non-negative
least squares and rounded. Everything else is planned on exact lengths: what is left over and all pieces of about
``SHORT`` tokens or fewer go by best fit, largest first, into the room the patterns leave and then into new sequences.
Of several ways to round, by larger and smaller shares of the fitted counts, the one that needs the fewest sequences is
taken. A plan row then says: pieces of this length with ranks from ... to ... go to sequences from ... on, so many to each.

Ranks within a length are numbered in two levels (length and hash chunk, then an offset per chunk), so a
length that a third of all pieces share is numbered by many tasks. Places within a sequence follow from the
lengths of at most ``size`` pieces.

Defined results: a null text counts as empty; an empty text is one piece holding id 0; repeated rows are packed
once each; an empty table gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from vecquery.llm.common import give_back, slices
from vecquery.llm.tokens import word_tokenizer
from vecquery.sources.tables import write_stage

SIZE = 2_048
#: Patterns are fitted to length classes of so many tokens.
GRAIN = 4
#: Pieces up to this length are put in by no pattern; they fill the room that is left.
SHORT = 64
#: Shares of the fitted counts that rounding down is tried with; what they leave gives best fit more to choose from.
SHARES = (1.0, 0.95, 0.9, 0.8, 0.65, 0.5)
#: Rows a numbering group should not exceed.
CHUNK_ROWS = 50_000
_RANK_BITS = 40


def pieces(documents: DataFrame, path: str, size: int = SIZE, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if kept, ``ids``: the tokens of every document, id 0 last."""
    schema = f"{documents.select('doc_id').schema.simpleString()[7:-1].replace(':', ' ')}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<bigint>" if keep_ids else ""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            for a, b in slices(texts):
                rows = []
                for i, data in enumerate(tokenizer.encoded(texts[a:b]), a):
                    data += b"\0\0\0\0"
                    for n, at in enumerate(range(0, len(data), 4 * size)):
                        part = data[at : at + 4 * size]
                        row = (i, n, at // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, np.frombuffer(part, dtype="<u4").astype(np.int64)) if keep_ids else row)
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)
                out["doc_id"] = batch["doc_id"].to_numpy()[out["doc_id"].to_numpy()]
                yield out
        give_back()

    return documents.select("doc_id", "text").mapInPandas(cut, schema)


def patterns(classes: int) -> np.ndarray:
    """All ways to fill a sequence with up to three classes; a row has the classes, 0 for none."""
    a, b = np.meshgrid(np.arange(classes + 1), np.arange(classes + 1), indexing="ij")
    c = classes - a - b
    keep = (a >= b) & (b >= c) & (c >= 0)
    return np.column_stack([a[keep], b[keep], c[keep]])


def fit_counts(pattern: np.ndarray, wanted: np.ndarray, rounds: int = 1_500) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared misfit of the histogram, each class weighted by its length.

    Active sets after Lawson and Hanson; ``wanted[c]`` is the number of pieces of class c, entry 0 is unused. A
    pattern has three entries, so the normal equations of the active patterns grow by cheap rows.
    """
    weight = np.arange(len(wanted), dtype=float)
    goal = wanted * weight
    x = np.zeros(len(pattern))
    active: list[int] = []
    columns = np.zeros((len(wanted), 0))
    normal = np.zeros((0, 0))
    misfit = goal.copy()
    limit = 1e-6 * max(1.0, np.abs(goal * weight).max())
    for _ in range(rounds):
        gain = (misfit * weight)[pattern].sum(axis=1)
        gain[active] = -np.inf
        j = int(gain.argmax())
        if gain[j] <= limit:
            break
        added = np.bincount(pattern[j], weights=weight[pattern[j]], minlength=len(wanted))
        rows = np.flatnonzero(added)
        cross = columns[rows].T @ added[rows]
        normal = np.block([[normal, cross[:, None]], [cross[None, :], np.array([[added @ added + 1e-6]])]])
        columns = np.column_stack([columns, added])
        active.append(j)
        while active:
            s = np.linalg.solve(normal, columns.T @ goal)
            if s.min() > 0:
                x[active] = s
                break
            now = x[active]
            falling = s <= 0
            step = (now[falling] / np.maximum(now[falling] - s[falling], 1e-300)).min()
            now = now + step * (s - now)
            stay = ~(falling & (now <= 1e-9))
            x[active] = np.where(stay, now, 0)
            active = [k for k, keep in zip(active, stay, strict=True) if keep]
            columns, normal = columns[:, stay], normal[np.ix_(stay, stay)]
        misfit = goal - columns @ x[active]
    return x


Run = tuple[dict[int, int], int]


def _classes(left: np.ndarray, grain: int) -> np.ndarray:
    """Histogram by length class."""
    return np.bincount(-(-np.arange(len(left)) // grain), weights=left, minlength=(len(left) - 1) // grain + 1)


def fitted_runs(left: np.ndarray, grain: int, pattern: np.ndarray, fitted: np.ndarray, share: float = 1.0) -> list[Run]:
    """Runs of patterns, each repeated by that share of its fitted count rounded down, in exact lengths; takes what they
    use from ``left``."""
    size = len(left) - 1
    wanted = _classes(left, grain)
    least = -(-min(SHORT, size // 4) // grain)
    runs: list[Run] = []
    for j in np.argsort(-fitted, kind="stable"):
        times = int(np.floor(share * fitted[j] + 1e-6))
        if not times:
            break
        made = Counter(c for c in pattern[j].tolist() if c > least)  # shorter pieces come by best fit
        if not made:
            continue
        times = min(times, *(int(wanted[c]) // m for c, m in made.items()))
        for c, m in made.items():
            wanted[c] -= m * times
        while times > 0:  # the longest piece of each class that is left; a run ends with the first length used up
            own: Counter = Counter()
            for c, m in made.items():
                for n in range(c * grain, (c - 1) * grain, -1):
                    own[n] = min(m - sum(own[k] for k in range(n + 1, c * grain + 1)), int(left[n]))
            own = +own
            often = min(times, *(int(left[n]) // m for n, m in own.items()))
            for n, m in own.items():
                left[n] -= m * often
            runs.append((dict(own), often))
            times -= often
    return runs


def best_fit(left: np.ndarray, runs: list[Run]) -> list[Run]:
    """``runs`` with all of ``left`` added, largest first, each piece where the least room is that holds it.

    Sequences that look alike are one run; a sequence that takes a piece has the least room for the next of its length.
    """
    size = len(left) - 1
    rooms: dict[int, list[Run]] = {}
    for made, times in runs:
        rooms.setdefault(size - sum(n * m for n, m in made.items()), []).append((made, times))
    order = sorted(rooms)
    for n in np.flatnonzero(left)[::-1].tolist():
        wanted = int(left[n])
        while wanted:
            at = bisect_left(order, n)
            made, times, room = {}, wanted, size
            if at < len(order):
                room = order[at]
                made, times = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[at]
            m = min(room // n, wanted)
            often = min(times, wanted // m)
            wanted -= m * often
            kept = [(room, (made, times - often))] if made and times > often else []
            for rest, run in [*kept, (room - m * n, (made | {n: m}, often))]:
                if rest not in rooms:
                    insort(order, rest)
                rooms.setdefault(rest, []).append(run)
    return [run for room in order for run in rooms[room]]


def plan_runs(counts: np.ndarray, grain: int = GRAIN) -> list[Run]:
    """Runs ({length: pieces of it in a sequence}, number of sequences) that use up ``counts`` (entry 0 unused)."""
    left = counts.astype(np.int64)
    left[0] = 0
    pattern = patterns((len(left) - 1) // grain)
    fitted = fit_counts(pattern, _classes(left, grain))
    plans = []
    for share in SHARES:
        rest = left.copy()
        plans.append(best_fit(rest, fitted_runs(rest, grain, pattern, fitted, share)) if rest.any() else [])
    return min(plans, key=lambda runs: sum(times for _, times in runs))  # of equal ones the one with most patterns


@dataclass(frozen=True)
class Plan:
    """Sorted by key: length and first rank, with the first sequence and the pieces for each sequence."""

    keys: np.ndarray
    sequences: np.ndarray
    each: np.ndarray

    def place(self, kind: np.ndarray, rank: np.ndarray) -> np.ndarray:
        key = (kind << _RANK_BITS) + rank
        at = np.searchsorted(self.keys, key, side="right") - 1
        return self.sequences[at] + (key - self.keys[at]) // self.each[at]


def make_plan(counts: np.ndarray, grain: int = GRAIN) -> Plan:
    used = np.zeros(len(counts), dtype=np.int64)
    rows, sequence = [], 0
    for made, times in plan_runs(counts, grain):
        for c, m in made.items():
            rows.append(((c << _RANK_BITS) + int(used[c]), sequence, m))
            used[c] += m * times
        sequence += times
    rows.sort()
    return Plan(*(np.array([r[i] for r in rows], dtype=np.int64) for i in range(3)))


def pack(cut: DataFrame, size: int = SIZE, grain: int = GRAIN) -> DataFrame:
    """The pieces (any columns besides ``doc_id, piece, length``) with ``sequence_id`` and ``offset``."""
    if size % grain:
        raise ValueError("grain must divide size")
    stored = write_stage(cut.withColumn("_kind", F.col("length").cast("bigint")), "pieces")
    counts = np.zeros(size + 1, dtype=np.int64)
    for r in stored.groupBy("_kind").count().collect():  # a row for each length at most
        counts[r["_kind"]] = r["count"]
    plan = make_plan(counts, grain)
    chunks = int(max(1, -(-counts.sum() // CHUNK_ROWS)))
    dealt = stored.withColumn("_chunk", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(chunks)))
    before = W.partitionBy("_kind").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = dealt.groupBy("_kind", "_chunk").agg(F.count("*").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))
    )
    within = W.partitionBy("_kind", "_chunk").orderBy(F.desc("length"), "doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("_row", F.row_number().over(within) - 1).join(
        offsets.select("_kind", "_chunk", "_before"), ["_kind", "_chunk"]
    )

    @F.pandas_udf("bigint")
    def placed(kinds: pd.Series, ranks: pd.Series) -> pd.Series:
        return pd.Series(plan.place(kinds.to_numpy(np.int64), ranks.to_numpy(np.int64)))

    sequenced = ranked.withColumn("sequence_id", placed(F.col("_kind"), F.col("_before") + F.col("_row")))
    earlier = W.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece", "ids_crc32").rowsBetween(
        W.unboundedPreceding, -1
    )
    return sequenced.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop(
        "_kind", "_chunk", "_row", "_before"
    )


def pack_documents(documents: DataFrame, path: str, size: int = SIZE, keep_ids: bool = False) -> DataFrame:
    return pack(pieces(documents, path, size, keep_ids), size)
