"""Hard negatives: for every anchor and positive, the best rows of other labels inside a window of scores.

Scores are integer inner products, computed tile by tile with ``strassen.product`` and exact.

1. Positives: anchors meet the rows of their own label only. Labels are dealt to cells, a cell's rows and anchors are cut
   into blocks by counted sizes, and every (row block, anchor block) pair is one bounded co-group. A tile leaves a heap
   of ``POSITIVES`` rows per anchor.
2. Negatives: all rows meet all anchors in blocks, the anchors carrying their positives' windows. A tile leaves a heap
   of ``NEGATIVES`` rows per (anchor, positive).

Heaps of tiles merge by rank over their few rows, with Spark's limit per group before the shuffle. Anchors are a stated
query set; their number times the number of rows is the work, and neither side is collected or broadcast.

Defined results: rows without an id, a label, a vector, or with a null or non-finite component take no part. One
``vec_id`` is one row; of rows that share an id the least (label, vector) counts. Of vectors of unequal length the
shorter ends in zeros. An anchor without positives, or a positive without rows in its window, returns no row. Scores
that fit a 64-bit integer are exact. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecquery.llm.common import packed, unpacked
from vecquery.llm.strassen import product
from vecquery.sources.tables import write_stage

SCALE = 256
ANCHOR_EVERY = 100
RELABEL_EVERY, LABELS = 7, 10
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these tenths of the positive's.
LOWEST, HIGHEST = 3, 9
#: Labels share so many cells; rows and anchors of one block at most; rows of a block at least, while cores are idle.
CELLS = 4_096
BLOCK_ROWS, ANCHOR_ROWS, LEAST_ROWS = 65_536, 1_024, 2_048
#: Sides of the tiles that are multiplied and searched at once.
TILE_ANCHORS, TILE_ROWS = 256, 8_192
_NONE = np.iinfo(np.int64).min
_FOUND = "anchor_id bigint, positive_id bigint, positive_score bigint, vec_id bigint, score bigint"


def usable_rows(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, v``: the rows that take part, relabelled, in whole numbers; one row per id."""
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return (
        embeddings.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "embedding")
        .filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(finite)
        .select("vec_id", F.struct(moved.alias("label"), scaled.alias("v")).alias("row"))
        .groupBy("vec_id").agg(F.min("row").alias("row"))
        .select("vec_id", "row.label", "row.v")
    )


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows of whole numbers, the short ones filled up with zeros."""
    array = vectors.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    lengths = array.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = array.flatten().to_numpy(zero_copy_only=False)
    return out


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest integer type that holds them."""
    low, high = (int(matrix.min()), int(matrix.max())) if matrix.size else (0, 0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return matrix.astype(kind)
    return matrix


def _pack(rows: DataFrame, block: str) -> DataFrame:
    """``cell, block, data``: one row per block, its rows in the order of their ids."""
    windows = "positives" in rows.columns

    def one(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        arrays = {name: table[name].to_numpy() for name in ("vec_id", "label")}
        arrays["v"] = _narrow(_matrix(table["v"]))
        if windows:
            lists = [[(p["positive_id"], p["score"]) for p in row] for row in table["positives"].to_pylist()]
            owner = np.repeat(np.arange(len(lists)), [len(ps) for ps in lists])
            flat = [p for ps in lists for p in ps]
            arrays |= {
                "owner": owner, "positive_id": np.array([p[0] for p in flat], dtype=np.int64),
                "score": np.array([p[1] for p in flat], dtype=np.int64),
            }
        return pa.table({
            "cell": pa.array([key[0].as_py()], pa.int64()), block: pa.array([key[1].as_py()], pa.int32()),
            "data": pa.array([packed(arrays)], pa.binary()),
        })

    return rows.groupBy("cell", block).applyInArrow(one, f"cell bigint, {block} int, data binary")


def best_of(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` best allowed scores of every row; of equal ones the first columns win."""
    n = scores.shape[1]
    k = min(k, n)
    if not k:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if max(-int(scores.min(initial=0)), int(scores.max(initial=0))) < (1 << 62) // n:
        # score and column in one number, so that no two are equal
        keys = np.where(allowed, scores * n + np.arange(n - 1, -1, -1), _NONE)
        top = -np.sort(-np.partition(keys, n - k, axis=1)[:, n - k :], axis=1)
        row, place = np.nonzero(top != _NONE)
        return row, n - 1 - top[row, place] % n
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, ~scores[row, column], row))
    row, column = row[order], column[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], column[keep]


class Heap:
    """The k best (id, score) of each owner; heaps of parts merge into the heap of the whole."""

    def __init__(self, k: int):
        self.k, self.owner = k, np.zeros(0, dtype=np.int64)
        self.id, self.score = self.owner, self.owner

    def merge(self, owner: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        owner, ids, score = (np.concatenate(pair) for pair in ((self.owner, owner), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, ~score, owner))
        owner, ids, score = owner[order], ids[order], score[order]
        keep = np.arange(len(owner)) - np.searchsorted(owner, owner) < self.k
        self.owner, self.id, self.score = owner[keep], ids[keep], score[keep]


def _tiles(anchors: dict, rows: dict):
    """(first anchor, rows' places, scores) for every tile of a pair of blocks."""
    width = max(anchors["v"].shape[1], rows["v"].shape[1])
    left, right = (np.pad(side["v"].astype(np.int64), ((0, 0), (0, width - side["v"].shape[1]))) for side in (anchors, rows))
    for r in range(0, len(right), TILE_ROWS):
        columns = np.ascontiguousarray(right[r : r + TILE_ROWS].T)
        for a in range(0, len(left), TILE_ANCHORS):
            yield a, slice(r, r + TILE_ROWS), product(left[a : a + TILE_ANCHORS], columns)


def tile_positives(anchors: dict, rows: dict, k: int) -> pa.Table:
    heap = Heap(k)
    for a, some, scores in _tiles(anchors, rows):
        mine = slice(a, a + len(scores))
        allowed = anchors["label"][mine, None] == rows["label"][None, some]
        allowed &= anchors["vec_id"][mine, None] != rows["vec_id"][None, some]
        row, column = best_of(scores, allowed, k)
        heap.merge(a + row, rows["vec_id"][some][column], scores[row, column])
    none = pa.nulls(len(heap.owner), pa.int64())
    return pa.table({
        "anchor_id": anchors["vec_id"][heap.owner], "positive_id": none, "positive_score": none, "vec_id": heap.id, "score": heap.score
    })


def tile_negatives(anchors: dict, rows: dict, k: int) -> pa.Table:
    """Windows are whole-number bounds, so that no product can leave 64 bits."""
    heap = Heap(k)
    low = np.array([-(-LOWEST * int(s) // 10) for s in anchors["score"]], dtype=np.int64)
    high = np.array([HIGHEST * int(s) // 10 for s in anchors["score"]], dtype=np.int64)
    owner = anchors["owner"]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    for a, some, scores in _tiles(anchors, rows):
        other = anchors["label"][a : a + len(scores), None] != rows["label"][None, some]
        for turn in range(int(place.max(initial=-1)) + 1):
            w = np.flatnonzero((place == turn) & (owner >= a) & (owner < a + len(scores)))
            own = scores[owner[w] - a]
            row, column = best_of(own, other[owner[w] - a] & (own >= low[w, None]) & (own <= high[w, None]), k)
            heap.merge(w[row], rows["vec_id"][some][column], own[row, column])
    return pa.table({
        "anchor_id": anchors["vec_id"][owner[heap.owner]], "positive_id": anchors["positive_id"][heap.owner],
        "positive_score": anchors["score"][heap.owner], "vec_id": heap.id, "score": heap.score,
    })


def _meet(rows: DataFrame, anchors: DataFrame, n_rows: int, tile, k: int) -> DataFrame:
    """The heaps of all tiles. Both sides have a ``cell``; blocks follow the counted rows of each cell."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    block_rows = min(BLOCK_ROWS, max(LEAST_ROWS, n_rows // (2 * cores)))
    sizes = write_stage(
        rows.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("row_blocks"))
        .join(anchors.groupBy("cell").agg(F.ceil(F.count("*") / ANCHOR_ROWS).cast("int").alias("anchor_blocks")), "cell"),
        "tile-sizes",
    )

    def dealt(side: DataFrame, name: str) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.col(f"{name}_blocks")).cast("int")
        return _pack(side.join(sizes, "cell").select(*side.columns, block.alias(name)), name)

    def copied(side: DataFrame, other: str) -> DataFrame:
        return side.join(sizes, "cell").select(
            "cell", *[c for c in ("row", "anchor") if c in side.columns],
            F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(other), "data",
        )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:  # no row was dealt to that block
            return pa.table({name: pa.array([], pa.int64()) for name in ("anchor_id", "positive_id", "positive_score", "vec_id", "score")})
        return tile(unpacked(left["data"][0].as_py()), unpacked(right["data"][0].as_py()), k)

    pair = ["cell", "row", "anchor"]
    return (
        copied(dealt(anchors, "anchor"), "row").groupBy(*pair)
        .cogroup(copied(dealt(rows, "row"), "anchor").groupBy(*pair)).applyInArrow(meet, _FOUND)
    )


def _ranked(heaps: DataFrame, owner: list[str], k: int) -> DataFrame:
    order = W.partitionBy(*owner).orderBy(F.desc("score"), "vec_id")
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(embeddings: DataFrame, is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; anchors are every 100th id by default."""
    rows = write_stage(usable_rows(embeddings), "vectors")
    n_rows = rows.count()
    is_anchor = F.col("vec_id") % ANCHOR_EVERY == 0 if is_anchor is None else is_anchor
    anchors = rows.filter(is_anchor)
    cell = F.pmod(F.xxhash64("label"), F.lit(CELLS)).alias("cell")
    heaps = _meet(rows.select("*", cell), anchors.select("*", cell), n_rows, tile_positives, positives)
    best = _ranked(heaps.select("anchor_id", "vec_id", "score"), ["anchor_id"], positives)
    best = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("vec_id").alias("positive_id"), "score"))).alias("positives"))
    windows = write_stage(
        anchors.join(best.withColumnRenamed("anchor_id", "vec_id"), "vec_id").select("vec_id", "label", "v", "positives"), "anchors"
    )
    one = F.lit(0).cast("bigint").alias("cell")
    heaps = _meet(rows.select("*", one), windows.select("*", one), n_rows, tile_negatives, negatives)
    return _ranked(heaps, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
