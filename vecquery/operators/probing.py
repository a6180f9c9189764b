"""Approximate search that knows when it has read enough.

``search_lists_bounded`` reads inverted lists in rounds and stops a query when its k-th best hit beats what any list left
could hold, so its hits are those of the exact search. ``search_multiprobe`` reads the hash buckets that lie nearest to a
query, as many as a measured recall asks for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecquery.operators import blocks, search
from vecquery.operators.blocks import MAX_SENT_QUERIES
from vecquery.sources.tables import write_stage

_SLACK = 1e-9  # above the rounding error of a dot product of unit vectors
#: Queries that recall is measured with, and codes that are listed at once when it is.
SAMPLE_QUERIES = 128
#: Numbers of a slice that costs of buckets are worked out in.
_SLICE_NUMBERS = 1_000_000
#: Vectors a bucket should get; the bits of a bucket's code follow from it.
BUCKET_ROWS = 32


def _directions(vectors: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length == 0, 1, length)


# ---- inverted lists -----------------------------------------------------------------------------

def list_ranges(index: DataFrame, centroids: pa.Table) -> pa.Table:
    """``centroid_id, least, most, zero``: range of the cosine between a list's centroid and its vectors.

    ``zero`` tells whether the list holds a vector without a direction. One row per list in use.
    """
    shared = index.sparkSession.sparkContext.broadcast((centroids["id"].to_numpy(), _directions(blocks.to_matrix(centroids["vec"]))))

    @F.arrow_udf("double")
    def cosine(vectors: pa.Array, cell: pa.Array) -> pa.Array:
        ids, directions = shared.value
        order = np.argsort(ids)
        own = directions[order[np.searchsorted(ids[order], cell.to_numpy(zero_copy_only=False))]]
        rows = blocks.to_matrix(vectors)
        if not len(rows):
            return pa.array([], pa.float64())
        found = (_directions(rows) * own).sum(axis=1)
        return pa.array(found, mask=~rows.any(axis=1))

    rows = index.select("centroid_id", cosine(F.col("unit_vec"), F.col("centroid_id")).alias("c"))
    return rows.groupBy("centroid_id").agg(
        F.min("c").alias("least"), F.max("c").alias("most"), F.bool_or(F.col("c").isNull()).alias("zero")
    ).toArrow().sort_by("centroid_id")  # of equally near lists the smaller id comes first


def _probe_plan(queries: DataFrame, centroids: pa.Table, ranges: pa.Table, start: int, end: int) -> Column:
    """struct(cells, rest): the lists from place ``start`` to ``end`` by nearness, and the best dot that later ones allow."""
    ids = ranges["centroid_id"].to_numpy()
    every = centroids["id"].to_numpy()
    order = np.argsort(every)
    directions = _directions(blocks.to_matrix(centroids["vec"]))[order[np.searchsorted(every[order], ids)]]
    angles = [np.arccos(np.clip(ranges[c].fill_null(0.0).to_numpy(), -1, 1)) for c in ("most", "least")]
    known = queries.sparkSession.sparkContext.broadcast((
        ids, directions, *angles, ranges["most"].is_null().to_numpy(), ranges["zero"].to_numpy(zero_copy_only=False).astype(bool)
    ))

    @F.arrow_udf("struct<cells: array<bigint>, rest: double>")
    def plan(vectors: pa.Array) -> pa.Array:
        ids, directions, nearest, farthest, only_zero, zero = known.value
        rows = blocks.to_matrix(vectors).reshape(len(vectors), -1)
        cells, rest = np.zeros((len(rows), min(end, len(ids)) - start), dtype=np.int64), np.full(len(rows), -np.inf)
        for i in range(0, len(rows), 1_024) if len(rows) else ():
            some = rows[i : i + 1_024]
            near = np.clip(_directions(some) @ directions.T, -1, 1)
            angle = np.arccos(near)
            gap = np.maximum(0, np.maximum(angle - farthest, nearest - angle))
            best = np.linalg.norm(some, axis=1)[:, None] * np.cos(gap) + _SLACK
            best = np.where(only_zero, _SLACK, np.where(zero, np.maximum(best, _SLACK), best))
            by_nearness = np.argsort(-near, axis=1, kind="stable")
            cells[i : i + 1_024] = ids[by_nearness[:, start:end]]
            left = by_nearness[:, end:]
            if left.shape[1]:
                rest[i : i + 1_024] = np.take_along_axis(best, left, axis=1).max(axis=1)
        ends = np.arange(0, (len(rows) + 1) * cells.shape[1], max(1, cells.shape[1]), dtype=np.int32)[: len(rows) + 1]
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(cells.reshape(-1))), pa.array(rest)], ["cells", "rest"])

    return plan(F.col("vec"))


def search_lists_bounded(
    index: DataFrame, queries: DataFrame, centroids: pa.Table, k: int, first: int = 8, nprobe: int | None = None,
    max_sent_queries: int = MAX_SENT_QUERIES,
) -> tuple[DataFrame, DataFrame]:
    """(hits as of ``search_exact``, ``query_id, n_lists``: how many lists each query read).

    ``index``: centroid_id, vec_id, unit_vec. The ``first`` nearest lists are read, then as many again, and so on. A query
    leaves when its k-th best dot product is above the bound of every list it has not read: with a list's vectors between
    two angles of its centroid, none can be nearer to the query than the difference of angles. ``nprobe`` ends the search
    after so many lists, and then hits may be missed. Rounds are at most the logarithm of the number of lists.
    """
    ranges = list_ranges(index, centroids)
    lists = ranges.num_rows
    limit = min(lists, nprobe or lists)
    cells = index.select(F.col("centroid_id").alias("cell"), "vec_id", F.col("unit_vec").alias("vec"))
    waiting = queries.select("query_id", "vec")
    best = waiting.limit(0).select("query_id", F.col("query_id").alias("vec_id"), F.lit(0.0).alias("dot"))
    probed = waiting.select("query_id", F.lit(0).alias("n_lists"))
    start, end = 0, min(first, limit)
    while end > start:
        planned = write_stage(waiting.withColumn("p", _probe_plan(waiting, centroids, ranges, start, end)), "probe-plan")
        asked = planned.select(F.explode_outer("p.cells").alias("cell"), "query_id", "vec")
        found = blocks.cell_top_k(cells, asked, k, max_sent_queries)
        order = W.partitionBy("query_id").orderBy(F.desc("dot"), "vec_id")
        merged = best.unionByName(found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        best = write_stage(merged.drop("rank"), "best-hits")
        probed = probed.unionAll(planned.select("query_id", F.lit(end).alias("n_lists")))
        worst = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("dot").alias("worst"))
        settled = (F.col("n") == k) & (F.col("worst") > F.col("p.rest"))
        waiting = write_stage(
            planned.join(worst, "query_id", "left").filter(~F.coalesce(settled, F.lit(False))).select("query_id", "vec"), "waiting"
        )
        start, end = end, min(2 * end, limit)
        if waiting.isEmpty():
            break
    return search.rank_hits(best, k), probed.groupBy("query_id").agg(F.max("n_lists").alias("n_lists"))


# ---- hash buckets ---------------------------------------------------------------------------------

def code_bits(n_vectors: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Bits that give buckets of about ``bucket_rows`` vectors: they grow with the logarithm of the table."""
    return min(40, max(4, (max(1, n_vectors // bucket_rows)).bit_length() - 1))


def cheapest_codes(margins: np.ndarray, probes: int) -> np.ndarray:
    """(queries, probes) codes of the buckets nearest to each query, nearest first.

    ``margins`` (queries, bits): signed distance to each hyperplane. A bucket costs the sum of the squared margins of the
    hyperplanes between it and the query. Of sums over the first bits only the cheapest can become the cheapest of all, so
    the codes are put together bit by bit and cut to ``probes`` every time.
    """
    return _cheapest(margins, probes)[0]


def _cheapest(margins: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes and what they cost."""
    n, bits = margins.shape
    code = ((margins >= 0) @ (1 << np.arange(bits, dtype=np.int64))).astype(np.int64)[:, None]
    cost = np.zeros((n, 1))
    for bit in range(bits):
        code = np.concatenate([code, code ^ (1 << bit)], axis=1)
        cost = np.concatenate([cost, cost + margins[:, bit : bit + 1] ** 2], axis=1)
        order = np.lexsort((code, cost))[:, :probes]
        code, cost = np.take_along_axis(code, order, axis=1), np.take_along_axis(cost, order, axis=1)
    return code, cost


def _margins(vectors: np.ndarray, bands: int, bits: int) -> np.ndarray:
    """(rows, bands, bits): signed distances to the hyperplanes, added up term by term, so that they are the same in every task."""
    out = np.zeros((len(vectors), bands * bits))
    for j, signs in enumerate(search.plane_signs(bands * bits, vectors.shape[1]).T if len(vectors) else ()):
        out += vectors[:, j, None] * signs
    return out.reshape(-1, bands, bits)


def _near_cells(queries: DataFrame, bands: int, bits: int, probes: int) -> DataFrame:
    @F.arrow_udf("array<bigint>")
    def cells(vectors: pa.Array) -> pa.Array:
        margins = _margins(blocks.to_matrix(vectors), bands, bits)
        codes = [cheapest_codes(margins[:, b], probes) + (b << bits) for b in range(bands)]
        codes = np.concatenate(codes, axis=1)
        ends = np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.reshape(-1)))

    return queries.select("query_id", "vec", F.explode_outer(cells(F.col("vec"))).alias("cell"))


def _last_probed(queries: DataFrame, bands: int, bits: int, probes: int) -> DataFrame:
    """query_id, vec, ``cost`` and ``code`` per band of the last of the ``probes`` nearest buckets: it tells which buckets are asked."""
    slice_rows = max(1, _SLICE_NUMBERS // (2 * probes))

    @F.arrow_udf("struct<cost: array<double>, code: array<bigint>>")
    def last(vectors: pa.Array) -> pa.Array:
        margins = _margins(blocks.to_matrix(vectors), bands, bits)
        cost, code = np.zeros((len(margins), bands)), np.zeros((len(margins), bands), dtype=np.int64)
        for b in range(bands):
            for i in range(0, len(margins), slice_rows):
                codes, costs = _cheapest(margins[i : i + slice_rows, b], probes)
                code[i : i + slice_rows, b], cost[i : i + slice_rows, b] = codes[:, -1], costs[:, -1]
        ends = pa.array(np.arange(len(margins) + 1, dtype=np.int32) * bands)
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1))) for x in (cost, code)], ["cost", "code"])

    found = write_stage(queries.select("query_id", "vec", last(F.col("vec")).alias("last")), "last-probed")
    return found.select("query_id", "vec", "last.cost", "last.code")


def _asked(margins: np.ndarray, cost: np.ndarray, code: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(codes, queries): does a query of these margins in a band ask for a bucket, given the last one it asks for."""
    own, far = margins >= 0, margins**2
    costs = np.zeros((len(codes), len(margins)))
    for bit in range(margins.shape[1]):
        costs += np.where(((codes >> bit) & 1 == 1)[:, None] == own[:, bit], 0.0, far[:, bit])
    return (costs < cost) | ((costs == cost) & (codes[:, None] <= code))


def _meet_probed(index: DataFrame, queries: DataFrame, k: int, dim: int, bands: int, bits: int, probes: int, n_queries: int) -> DataFrame:
    """Candidates as of ``cell_top_k``, for many queries that ask for many buckets each.

    Blocks of whole buckets (a bucket larger than a block is cut) meet blocks of queries. A query travels to a block once, with the
    last bucket it asks for in each band instead of their list; the task finds the asked buckets from that and compares with no
    others. So what is shuffled does not grow with the number of probes, and a block gives k rows a query, not k a bucket.
    """
    celled = search.hash_cells(index.select("vec_id", F.col("unit_vec").alias("vec")), "vec", dim, bands, bits)
    width = 8 * max(1, dim)
    block_rows = max(1, blocks.VECTOR_BLOCK_BYTES // width)
    sizes = write_stage(celled.groupBy("cell").agg(F.count("*").alias("n")), "cell-sizes")
    v_blocks = max(1, -(-(sizes.agg(F.sum("n")).first()[0] or 0) // block_rows))
    cores = index.sparkSession.sparkContext.defaultParallelism
    q_blocks = max(1, -(-n_queries * width // blocks.QUERY_BLOCK_BYTES), min(-(-2 * cores // v_blocks), -(-n_queries // 512)))
    fat = sizes.filter(F.col("n") > block_rows).select("cell", F.ceil(F.col("n") / block_rows).alias("parts"))  # at most a row per block
    part = F.pmod(F.xxhash64("vec_id"), F.coalesce("parts", F.lit(1)))
    left = celled.join(F.broadcast(fat), "cell", "left").select(
        F.pmod(F.xxhash64("cell", part), F.lit(v_blocks)).cast("int").alias("v_block"),
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q_block"), "cell", "vec_id", "vec",
    )
    right = _last_probed(queries, bands, bits, probes).select(
        F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1))).alias("v_block"),
        F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int").alias("q_block"), "query_id", "vec", "cost", "code",
    )

    def score(points: pa.Table, asked: pa.Table) -> pa.Table:
        query_ids, ids, cell = asked["query_id"].to_numpy(), points["vec_id"].to_numpy(), points["cell"].to_numpy()
        best = blocks.BestHits(len(query_ids), k)
        if len(query_ids) and len(ids):
            vectors, rows = blocks.to_matrix(asked["vec"]), blocks.to_matrix(points["vec"])
            margins, cost, code = _margins(vectors, bands, bits), blocks.to_matrix(asked["cost"]), asked["code"].combine_chunks().flatten().to_numpy().reshape(-1, bands)
            order = np.argsort(cell, kind="stable")
            cells, start = np.unique(cell[order], return_index=True)
            members = np.split(order, start[1:])
            at_once = max(1, _SLICE_NUMBERS // len(query_ids))
            for b in range(bands):
                own = np.flatnonzero(cells >> bits == b)
                for i in range(0, len(own), at_once):
                    some = own[i : i + at_once]
                    for at, mask in zip(some, _asked(margins[:, b], cost[:, b], code[:, b], cells[some] & ((1 << bits) - 1)), strict=True):
                        places, inside = np.flatnonzero(mask), members[at]
                        for v in range(0, len(inside) if len(places) else 0, blocks._ROWS_AT_ONCE):
                            near = inside[v : v + blocks._ROWS_AT_ONCE]
                            best.offer(places, vectors[places], ids[near], rows[near])
        return pa.Table.from_batches([best.table(query_ids)])

    block = ["v_block", "q_block"]
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(score, "query_id bigint, vec_id bigint, dot double")


def search_multiprobe(
    index: DataFrame, queries: DataFrame, k: int, dim: int, bands: int, bits: int, probes: int, max_sent_queries: int = MAX_SENT_QUERIES
) -> DataFrame:
    """Exact ranking among the vectors of the ``probes`` buckets nearest to a query in every band.

    Nearness counts the squared distances to the hyperplanes in between. ``measured_probes`` finds how many it takes.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    probes = min(probes, 1 << bits)
    queries = queries.select("query_id", "vec")
    n = queries.count()
    if n * bands * probes <= max_sent_queries:
        found = blocks.cell_top_k(
            search.hash_cells(index.select("vec_id", F.col("unit_vec").alias("vec")), "vec", dim, bands, bits),
            _near_cells(queries, bands, bits, probes), k, max_sent_queries,
        )
    else:
        found = _meet_probed(index, queries, k, dim, bands, bits, probes, n)
    return search.rank_hits(found.groupBy("query_id", "vec_id").agg(F.max("dot").alias("dot")), k)


def measured_probes(
    index: DataFrame, queries: DataFrame, k: int, dim: int, bands: int, bits: int, recall: float = 0.9, sample: int = SAMPLE_QUERIES
) -> int:
    """How many buckets per band find ``recall`` of the true neighbours, growing by a quarter until they do.

    Measured against the exact search for at most ``sample`` queries, chosen by a hash of their ids.
    """
    few = queries.select("query_id", "vec").orderBy(F.xxhash64("query_id", F.lit("probes")), "query_id").limit(sample)
    few = write_stage(few, "sampled-queries")
    hits = search.search_exact(index, few, k).select("query_id", "vec_id")
    near = few.join(hits, "query_id").join(index.select("vec_id", "unit_vec"), "vec_id").select("vec", "unit_vec").toArrow()  # sample * k rows
    total = 1 << bits
    if not near.num_rows:
        return total
    signs = search.plane_signs(bands * bits, dim)
    asked = (blocks.to_matrix(near["vec"]) @ signs.T).reshape(-1, bands, bits)
    wanted = ((blocks.to_matrix(near["unit_vec"]) @ signs.T >= 0).reshape(-1, bands, bits)) @ (1 << np.arange(bits, dtype=np.int64))
    probes = 1
    while probes < total:
        found = np.zeros(len(asked), dtype=bool)
        for b in range(bands):
            found |= (cheapest_codes(asked[:, b], probes) == wanted[:, b, None]).any(axis=1)
        if found.mean() >= recall:
            return probes
        probes = min(total, probes + max(1, probes // 4))
    return total
