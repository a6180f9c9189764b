"""Building, training, extending and describing vector indexes kept as tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecquery.functions.vectors import unit_vector
from vecquery.operators.blocks import nearest_of_many, nearest_rows
from vecquery.operators.latency import ewma
from vecquery.operators.ordered import even_bins
from vecquery.sources.tables import write_stage

MAX_LISTS = 65_536  # centroids that travel to every task; more are met in blocks


def build_flat(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding -> vec_id, unit_vec. An empty input gives an empty index."""
    return embeddings.select("vec_id", unit_vector(F.col("embedding")).alias("unit_vec"))


def list_count(n_vectors: int, nlist: int) -> int:
    return min(nlist, max(1, n_vectors // 10))


def train_centroids(
    index: DataFrame, nlist: int = 512, seed: int = 42, iterations: int = 10
) -> DataFrame:
    """Cosine k-means on the whole index: centroid_id, centroid.

    Zero vectors have no direction to learn from; they count for the number of lists and are assigned to
    one like any other vector.
    """
    directed = index.filter(F.exists("unit_vec", lambda x: x != 0))
    points = directed.select(array_to_vector("unit_vec").alias("features"))
    lists = list_count(index.count(), nlist)
    model = KMeans(k=lists, seed=seed, maxIter=iterations, distanceMeasure="cosine").fit(points)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return index.sparkSession.createDataFrame(rows, "centroid_id bigint, centroid array<double>")


def group_centroids(index: DataFrame, label: str = "label") -> DataFrame:
    """Mean vector per label, an alternative to k-means that has one answer."""
    mean = vector_to_array(Summarizer.mean(array_to_vector("unit_vec")))
    return index.groupBy(F.col(label).cast("bigint").alias("centroid_id")).agg(mean.alias("centroid"))


def centroid_table(centroids: DataFrame) -> pa.Table | DataFrame:
    """The centroids (id, vec), brought to the driver up to ``MAX_LISTS`` and left as a table beyond."""
    named = centroids.select(F.col("centroid_id").alias("id"), F.col("centroid").alias("vec"))
    table = named.limit(MAX_LISTS + 1).toArrow()
    return table if table.num_rows <= MAX_LISTS else write_stage(named, "centroids")


def assign_lists(index: DataFrame, centroids: pa.Table | DataFrame) -> DataFrame:
    """Add ``centroid_id``, the list whose centroid has the greatest dot product."""
    if isinstance(centroids, DataFrame):
        near = nearest_of_many(index, "vec_id", "unit_vec", centroids, 1)
        return index.join(near.withColumnRenamed("cell", "centroid_id"), "vec_id").select(*index.columns, "centroid_id")
    near = nearest_rows(index, "unit_vec", centroids, 1, "lists")
    return near.withColumn("centroid_id", F.col("lists")[0]).drop("lists")


def store_lists(index: DataFrame) -> DataFrame:
    """Keep an index with one folder per list, so a search reads only the lists it probes.

    Rebalancing brings a list's rows together before the write; AQE splits a fat list over many tasks
    and files and joins small ones.
    """
    stored = write_stage(index.hint("rebalance", "centroid_id"), "lists", "centroid_id")
    return stored.select(*index.columns)


def add_vectors(index: DataFrame, embeddings: DataFrame, centroids: pa.Table | DataFrame | None = None) -> DataFrame:
    """Append new vectors; lists are assigned with the existing centroids, never retrained."""
    new = build_flat(embeddings)
    if centroids is not None:
        new = assign_lists(new, centroids)
    return index.unionByName(new)


def describe(index: DataFrame, search_log: DataFrame, index_type: str, nprobe: int) -> DataFrame:
    """One row: size, dimension, type, the searches made so far and their decayed mean time.

    ``search_log``: ts_us, request_id, latency_ms per search.
    """
    order = ["ts_us", "request_id"]
    searches = ewma(even_bins(search_log, order), [], "_bin", order, "latency_ms", "ms")
    searches = searches.agg(F.struct(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.round(F.sum("ms"), 3), F.lit(0.0)).alias("ms")
    )).scalar()
    return index.agg(
        F.count("*").alias("size"), F.coalesce(F.max(F.size("unit_vec")), F.lit(0)).alias("dimension")
    ).select(
        "size", F.lit(index_type).alias("index_type"), "dimension", F.lit(nprobe).alias("nprobe"),
        searches["n"].alias("total_searches"), searches["ms"].alias("avg_search_time_ms"),
    )


def list_sizes(index: DataFrame) -> DataFrame:
    """Rows per list, to see fat lists."""
    return index.groupBy("centroid_id").agg(F.count("*").alias("n_vectors"))
