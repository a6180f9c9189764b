"""Top-k similarity search: exact, inverted lists and hash buckets."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecquery.functions.vectors import relevance
from vecquery.operators import blocks
from vecquery.operators.blocks import MAX_SENT_QUERIES
from vecquery.sources.tables import write_stage

MAX_SENT_HITS = 1_000_000  # rows of four numbers
ID_RANGES = 64  # ranges of ids that a scan of documents is asked for


def rank_hits(candidates: DataFrame, k: int) -> DataFrame:
    """The k best per query by raw dot, ties to the smaller id: query_id, rank, vec_id, score.

    Candidates are already k per query and block, and the filter on the rank lets Spark cut to k per
    query before the shuffle as well.
    """
    order = W.partitionBy("query_id").orderBy(F.desc("dot"), F.asc("vec_id"))
    return (
        candidates.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "dot", relevance(F.col("dot")).alias("score"))
    )


def search_exact(
    index: DataFrame, queries: DataFrame, k: int, max_sent_queries: int = MAX_SENT_QUERIES
) -> DataFrame:
    """Compare every query with every vector. ``index``: vec_id, unit_vec. ``queries``: query_id, vec."""
    everything = F.lit(0).cast("bigint").alias("cell")
    found = blocks.cell_top_k(
        index.select(everything, "vec_id", F.col("unit_vec").alias("vec")),
        queries.select(everything, "query_id", "vec"),
        k,
        max_sent_queries,
    )
    return rank_hits(found, k)


def probe_lists(queries: DataFrame, centroids: pa.Table | DataFrame, nprobe: int) -> DataFrame:
    """One row per query and each of its ``nprobe`` nearest lists; centroids too many to send are met in blocks."""
    if isinstance(centroids, DataFrame):
        near = blocks.nearest_of_many(queries.select("query_id", "vec"), "query_id", "vec", centroids, nprobe)
        return queries.select("query_id", "vec").join(near, "query_id").select("cell", "query_id", "vec")
    near = blocks.nearest_rows(queries, "vec", centroids, nprobe, "lists")
    # outer: an inner explode infers a filter on the list's size and runs the UDF once more
    return near.select(F.explode_outer("lists").alias("cell"), "query_id", "vec")


def search_lists(
    index: DataFrame,
    queries: DataFrame,
    centroids: pa.Table | DataFrame,
    k: int,
    nprobe: int = 16,
    max_sent_queries: int = MAX_SENT_QUERIES,
) -> DataFrame:
    """Exact ranking inside the ``nprobe`` nearest lists only; may give fewer than k hits.

    ``index``: centroid_id, vec_id, unit_vec.
    """
    found = blocks.cell_top_k(
        index.select(F.col("centroid_id").alias("cell"), "vec_id", F.col("unit_vec").alias("vec")),
        probe_lists(queries, centroids, nprobe),
        k,
        max_sent_queries,
    )
    return rank_hits(found, k)


def plane_signs(planes: int, dim: int) -> np.ndarray:
    """(planes, dim) of +1/-1: parity of the first hex digit of md5('plane:dim')."""
    return np.array(
        [
            [1.0 if int(hashlib.md5(f"{p}:{j}".encode()).hexdigest()[0], 16) % 2 else -1.0
             for j in range(dim)]
            for p in range(planes)
        ]
    )


def hash_cells(df: DataFrame, vec: str, dim: int, bands: int, bits: int) -> DataFrame:
    """Explode to one row per band, ``cell`` = band and the sign bits of its hyperplanes."""
    signs = plane_signs(bands * bits, dim)
    weights = 1 << np.arange(bits, dtype=np.int64)

    @F.arrow_udf("array<bigint>")
    def cells(vectors: pa.Array) -> pa.Array:
        side = blocks.to_matrix(vectors) @ signs.T >= 0 if len(vectors) else np.zeros((0, bands * bits))
        codes = side.reshape(len(vectors), bands, bits) @ weights
        codes = codes + (np.arange(bands, dtype=np.int64) << bits)
        ends = np.arange(0, (len(vectors) + 1) * bands, bands, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.reshape(-1).astype(np.int64)))

    return df.withColumn("cell", F.explode_outer(cells(F.col(vec))))


def search_hashed(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    dim: int,
    bands: int = 4,
    bits: int = 6,
    max_sent_queries: int = MAX_SENT_QUERIES,
) -> DataFrame:
    """Exact ranking among vectors that share a hash bucket with the query in at least one band.

    A probe reads about ``bands / 2**bits`` of all vectors, so ``bits`` should grow with the logarithm of their number,
    and ``bands`` with ``bits`` to keep the recall.
    """
    found = blocks.cell_top_k(
        hash_cells(index.select("vec_id", F.col("unit_vec").alias("vec")), "vec", dim, bands, bits),
        hash_cells(queries.select("query_id", "vec"), "vec", dim, bands, bits),
        k,
        max_sent_queries,
    )
    once = found.groupBy("query_id", "vec_id").agg(F.max("dot").alias("dot"))
    return rank_hits(once, k)


def id_ranges(column: Column, ids: np.ndarray, most: int = ID_RANGES) -> Column:
    """A filter that admits all ``ids`` and few others: at most ``most`` ranges, cut at the widest gaps between them.

    Ranges reach the Parquet scan, which skips the files and row groups whose least and greatest id lie outside.
    """
    ids = np.unique(ids)
    if not len(ids):
        return F.lit(False)
    gaps = np.diff(ids)
    cuts = np.sort(np.argsort(-gaps, kind="stable")[: most - 1]) + 1 if len(gaps) else np.zeros(0, dtype=np.int64)
    found = None
    for part in np.split(ids, cuts):
        one = column.between(int(part[0]), int(part[-1]))
        found = one if found is None else found | one
    return found


def store_documents(documents: DataFrame, files: int) -> DataFrame:
    """Documents in files by range of ``vec_id`` and sorted inside, so that a few hits are read from few row groups."""
    return write_stage(documents.repartitionByRange(files, "vec_id").sortWithinPartitions("vec_id"), "documents")


def attach_documents(hits: DataFrame, documents: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Fetch id, content and metadata for the hits only; hits without a document are skipped.

    ``documents``: vec_id, id, content. ``metadata``: vec_id, metadata (a map), joined after the documents
    so that only hits meet it. The hits are kept as a table and counted: few of them travel to the
    documents, whose texts are then filtered where they lie, by ranges of ids that the scan can skip files with
    (``store_documents`` lays them out for it); many are joined by shuffle.
    """
    kept = write_stage(hits.select("query_id", "rank", "vec_id", "score"), "hits")
    few = kept
    if kept.count() <= MAX_SENT_HITS:
        ids = kept.select("vec_id").distinct().toArrow()["vec_id"].to_numpy()
        few, documents = F.broadcast(kept), documents.filter(id_ranges(F.col("vec_id"), ids))
    found = few.join(documents.select("vec_id", "id", "content"), "vec_id")
    none = F.create_map().cast("map<string,string>")
    if metadata is None:
        found = found.withColumn("metadata", none)
    else:
        found = found.join(metadata.select("vec_id", "metadata"), "vec_id", "left")
    return found.select(
        "query_id", "rank", "id", "content", "score",
        F.coalesce("metadata", none).alias("metadata"), F.col("vec_id").alias("index"),
    )
