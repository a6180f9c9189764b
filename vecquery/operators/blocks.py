"""Top-k scoring of query blocks against vector blocks.

Both sides carry a ``cell``: a query is compared with the vectors of its cells only. A flat search has
one cell, an inverted-list search one per centroid, a hash search one per bucket.

Two physical ways, chosen by the checked size of the query side:

* few queries: they travel to every task, the vectors are scanned where they lie. No shuffle of
  vectors, each task emits at most k rows per query.
* many queries: each cell is cut into vector blocks and query blocks by hash, sized from the counted
  rows, and every (vector block, query block) pair meets in one bounded co-group. A cell holding a
  third of all rows becomes many blocks.

Neither emits pairs: a block keeps k rows per query. BLAS only preselects, in single precision less a bound on
its rounding; the kept rows are scored again term by term, so equal vectors get equal scores and ties fall to
the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecquery.sources.tables import write_stage

#: Cells whose sizes travel to every task; with more, sizes are joined by shuffle.
MAX_CELLS = 1_000_000
MAX_SENT_QUERIES = 20_000
#: Tasks per core that a scan for sent queries is cut into at most; each emits its k best rows per query.
SCANS_PER_CORE = 8
MAX_SENT_BYTES = 128 * 1024 * 1024
#: Blocks are cut by bytes of 8-byte numbers, so that their rows fall as the dimension grows.
VECTOR_BLOCK_BYTES = 32 * 1024 * 1024
QUERY_BLOCK_BYTES = 16 * 1024 * 1024
#: Candidates kept side by side before they are merged into the best ones.
MERGE_ROWS = 250_000
#: Cells that are asked for by value; more of them are asked for by a join.
NAMED_CELLS = 1_000

_HITS = "query_id bigint, vec_id bigint, dot double"
_SLACK = 1e-9  # far above the rounding error of a BLAS dot product of unit vectors
_ROWS_AT_ONCE = 4_096
_QUERIES_AT_ONCE = 256


def to_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """List column to a (rows, dim) double matrix."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], array.type)
    flat = np.asarray(array.flatten(), dtype=np.float64)
    return flat.reshape(len(array), -1) if len(array) else np.zeros((0, 0))


def _preselecting(queries: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Both sides as BLAS gets them, and by how much two of its dot products can be in the wrong order."""
    longest = [np.sqrt(np.einsum("ij,ij->i", rows, rows).max(initial=0)) for rows in (queries, vectors)]
    size = longest[0] * longest[1] if np.isfinite(longest).all() else 0.0
    if not max(longest) < 1e15:  # single precision might overflow
        return queries, vectors, _SLACK + (queries.shape[1] + 8) * 2.0**-52 * size
    return queries.astype(np.float32), vectors.astype(np.float32), _SLACK + (queries.shape[1] + 8) * 2.0**-23 * size


def first_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of equal vectors only the ``k`` with the smallest ids: ties go to them, so no other can be among the k best."""
    if len(ids) <= k:
        return ids, vectors
    # equal vectors have equal sums of weighted elements, which are cheap to compare
    mark = (vectors + 0.0) @ np.random.default_rng(0).random(vectors.shape[1])
    near = np.sort(mark)
    if k < len(near) and not (near[k:] - near[:-k] <= 1e-12 * (1 + np.abs(near[k:]))).any():
        return ids, vectors  # no vector has more than k copies
    rows = np.ascontiguousarray(vectors + 0.0)  # -0.0 and 0.0 are equal
    _, copy = np.unique(rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((ids, copy))
    sorted_copy = copy[order]
    place = np.arange(len(ids)) - np.searchsorted(sorted_copy, sorted_copy, side="left")
    keep = np.sort(order[place < k])
    return ids[keep], vectors[keep]


class BestHits:
    """Running k best (query, vector, dot) triples, queries given by position."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.floor = np.full(n_queries, -np.inf)
        self.query = np.zeros(0, dtype=np.int64)
        self.vec = np.zeros(0, dtype=np.int64)
        self.dot = np.zeros(0)

        self.offered: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, positions: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        for v in range(0, len(ids), _ROWS_AT_ONCE):
            self.offer(positions, queries, ids[v : v + _ROWS_AT_ONCE], vectors[v : v + _ROWS_AT_ONCE])
            self._settle()

    def offer(self, positions: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        """``add`` for few vectors: the candidates wait for those of the next calls, so that many small calls cost few merges."""
        ids, vectors = first_copies(ids, vectors, self.k)
        asked, near, slack = _preselecting(queries, vectors)
        for q in range(0, len(positions), _QUERIES_AT_ONCE):
            some = slice(q, q + _QUERIES_AT_ONCE)
            piece = self._better(positions[some], queries[some], ids, vectors, asked[some] @ near.T, slack)
            self.offered.append(piece)
            self.rows += len(piece[0])
            if self.rows > MERGE_ROWS:
                self._settle()

    def _settle(self):
        if self.rows:
            self._merge(*(np.concatenate(c) for c in zip(*self.offered, strict=True)))
        self.offered, self.rows = [], 0

    def _better(self, positions, queries, ids, vectors, rough, slack):
        """Pairs that may enter the k best by their ``rough`` dots, scored term by term."""
        least = self.floor[positions]
        if len(ids) > self.k and np.isneginf(least).any():
            cut = len(ids) - self.k
            least = np.maximum(least, np.partition(rough, cut, axis=1)[:, cut])
        row, col = np.divmod(np.flatnonzero(rough >= (least - slack).astype(rough.dtype)[:, None]), max(1, len(ids)))
        dot = np.zeros(len(row))
        for j in range(queries.shape[1]):
            dot += queries[row, j] * vectors[col, j]
        return positions[row], ids[col], dot

    def _merge(self, query, vec, dot):
        query = np.concatenate([self.query, query])
        vec = np.concatenate([self.vec, vec])
        dot = np.concatenate([self.dot, dot])
        order = np.lexsort((vec, -dot, query))
        query, vec, dot = query[order], vec[order], dot[order]
        # one vector can come from several cells, with the same dot: keep it once
        new = np.ones(len(query), dtype=bool)
        new[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
        query, vec, dot = query[new], vec[new], dot[new]
        first = np.searchsorted(query, query, side="left")
        rank = np.arange(len(query)) - first
        keep = rank < self.k
        self.query, self.vec, self.dot = query[keep], vec[keep], dot[keep]
        full = rank[keep] == self.k - 1
        self.floor[self.query[full]] = self.dot[full]

    def table(self, query_ids: np.ndarray) -> pa.RecordBatch:
        self._settle()
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[self.query]), pa.array(self.vec), pa.array(self.dot)],
            names=["query_id", "vec_id", "dot"],
        )


def _send_queries(vectors: DataFrame, sent: pa.Table, k: int) -> DataFrame:
    cells = sent["cell"].to_numpy()
    unique_ids, position = np.unique(sent["query_id"].to_numpy(), return_inverse=True)
    matrix = to_matrix(sent["vec"])
    by_cell = {c: np.flatnonzero(cells == c) for c in np.unique(cells).tolist()}
    shared = vectors.sparkSession.sparkContext.broadcast((unique_ids, position, matrix, by_cell))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, places, queries, rows_of = shared.value
        best = BestHits(len(query_ids), k)
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column("cell").to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            points = to_matrix(batch.column("vec"))
            for c in np.unique(cell).tolist():
                asked = rows_of.get(c)
                if asked is not None:
                    here = cell == c
                    best.add(places[asked], queries[asked], ids[here], points[here])
        yield best.table(query_ids)

    # only cells somebody asks for are read; on a table partitioned by cell either way prunes folders
    if len(by_cell) <= NAMED_CELLS:
        vectors = vectors.filter(F.col("cell").isin(list(by_cell)))
    else:  # at most as many cells as sent rows
        asked = vectors.sparkSession.createDataFrame([(c,) for c in by_cell], "cell bigint")
        vectors = vectors.join(F.broadcast(asked), "cell", "left_semi")
    # a task reads several splits where there are very many, so that what tasks emit does not follow the splits
    tasks = SCANS_PER_CORE * vectors.sparkSession.sparkContext.defaultParallelism
    return vectors.select("cell", "vec_id", "vec").coalesce(tasks).mapInArrow(scan, _HITS)


def _meet_in_blocks(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    width = 8 * max(1, queries.agg(F.max(F.size("vec"))).first()[0] or 1)
    # one row per cell both sides have
    sizes = write_stage(
        vectors.groupBy("cell").agg(F.count("*").alias("n_vectors"))
        .join(queries.groupBy("cell").agg(F.count("*").alias("n_queries")), "cell")
        .select(
            "cell",
            F.ceil(F.col("n_vectors") / max(1, VECTOR_BLOCK_BYTES // width)).cast("int").alias("v_blocks"),
            F.ceil(F.col("n_queries") / max(1, QUERY_BLOCK_BYTES // width)).cast("int").alias("q_blocks"),
        ),
        "cell-sizes",
    )
    if sizes.count() <= MAX_CELLS:
        sizes = F.broadcast(sizes)

    def every(blocks):
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    def one(key, blocks):
        return F.pmod(F.xxhash64(key), F.col(blocks)).cast("int")

    left = vectors.join(sizes, "cell").select(
        "cell", one("vec_id", "v_blocks").alias("v_block"), every("q_blocks").alias("q_block"),
        "vec_id", "vec",
    )
    right = queries.join(sizes, "cell").select(
        "cell", every("v_blocks").alias("v_block"), one("query_id", "q_blocks").alias("q_block"),
        "query_id", "vec",
    )

    def score(points: pa.Table, asked: pa.Table) -> pa.Table:
        query_ids = asked["query_id"].to_numpy()
        best = BestHits(len(query_ids), k)
        if len(query_ids) and points.num_rows:
            best.add(
                np.arange(len(query_ids)), to_matrix(asked["vec"]),
                points["vec_id"].to_numpy(), to_matrix(points["vec"]),
            )
        return pa.Table.from_batches([best.table(query_ids)])

    block = ["cell", "v_block", "q_block"]
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(score, _HITS)


def cell_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    max_sent_queries: int = MAX_SENT_QUERIES,
) -> DataFrame:
    """Candidates ``(query_id, vec_id, dot)`` that contain the k best of every query's cells.

    ``vectors``: cell, vec_id, vec. ``queries``: cell, query_id, vec. All ids and cells are bigint.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    queries = queries.select("cell", "query_id", "vec")
    rows, width = queries.agg(F.count("*"), F.max(F.size("vec"))).first()
    if rows <= max_sent_queries and rows * (16 + 8 * (width or 0)) <= MAX_SENT_BYTES:
        return _send_queries(vectors, queries.toArrow(), k)
    return _meet_in_blocks(vectors, queries, k)


def nearest_rows(df: DataFrame, vec: str, points: pa.Table, k: int, out: str) -> DataFrame:
    """Add ``out array<bigint>``: ids of the k best ``points(id, vec)`` per row, best first.

    ``points`` is a bounded table (centroids); it travels to every task.
    """
    shared = df.sparkSession.sparkContext.broadcast(
        (points["id"].to_numpy(), to_matrix(points["vec"]))
    )

    @F.arrow_udf("array<bigint>")
    def nearest(vectors: pa.Array) -> pa.Array:
        ids, centers = shared.value
        best = BestHits(len(vectors), k)
        best.add(np.arange(len(vectors)), to_matrix(vectors), ids, centers)
        ends = np.searchsorted(best.query, np.arange(len(vectors) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(best.vec))

    return df.withColumn(out, nearest(F.col(vec)))


def nearest_of_many(df: DataFrame, id_col: str, vec: str, centroids: DataFrame, k: int) -> DataFrame:
    """``id_col, cell``: the ids of the k best ``centroids`` (id, vec) for each row, however many there are.

    ``id_col`` must be unique.
    """
    one = F.lit(0).cast("bigint").alias("cell")
    found = cell_top_k(
        centroids.select(one, F.col("id").alias("vec_id"), "vec"), df.select(one, F.col(id_col).alias("query_id"), F.col(vec).alias("vec")), k
    )
    order = W.partitionBy("query_id").orderBy(F.desc("dot"), F.asc("vec_id"))
    best = found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
    return best.select(F.col("query_id").alias(id_col), F.col("vec_id").alias("cell"))
