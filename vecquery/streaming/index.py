"""Embedding and indexing of arriving rows."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecquery.functions.keys import embedding_key
from vecquery.operators import embed, index
from vecquery.sources.tables import remove


def embed_stream(texts: DataFrame, text: str, dim: int = embed.DEFAULT_DIM) -> DataFrame:
    """Arriving texts with their hashed embedding. Row-local, so any micro-batch size gives the same."""
    return embed.embed_hashed(texts, text, dim)


def add_stream(embeddings: DataFrame, centroids: pa.Table) -> DataFrame:
    """Arriving vectors, normalised and put into the lists of existing centroids."""
    return index.assign_lists(index.build_flat(embeddings), centroids)


class VectorLog:
    """Vectors of the texts met so far, by key: one folder per micro-batch, in buckets by a hash of the key.

    A batch adds its new vectors and rewrites none; a batch that is repeated replaces its own folder.
    """

    def __init__(self, spark: SparkSession, path: str, vector_type: str = "array<float>", buckets: int = 64):
        self.spark, self.path, self.buckets, self.vector_type = spark, path.rstrip("/"), buckets, vector_type
        self.schema = f"key string, vector {vector_type}, batch bigint, bucket int"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")

    def known(self, before: int, keys: DataFrame) -> DataFrame:
        """``key, vector`` of batches numbered less than ``before``, from the buckets that ``keys`` fall into only."""
        asked = [r[0] for r in keys.select(self.bucket().alias("b")).distinct().collect()]  # at most one per bucket
        try:
            held = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(f"{self.path}/batch=*")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            held = self.spark.createDataFrame([], self.schema)
        return held.filter((F.col("batch") < before) & F.col("bucket").isin(asked)).select("key", "vector")

    def add(self, number: int, vectors: DataFrame) -> DataFrame:
        path = f"{self.path}/batch={number}"
        vectors.select("key", F.col("vector").cast(self.vector_type).alias("vector"), self.bucket().alias("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)
        return self.spark.read.schema(self.schema).parquet(path).select("key", "vector")

    def forget(self, before: int) -> None:
        """Vectors of batches numbered less than ``before`` go; their texts are embedded again if they come back."""
        for r in self.spark.read.schema(self.schema).option("basePath", self.path).parquet(f"{self.path}/batch=*").select("batch").distinct().collect():
            if r["batch"] < before:
                remove(self.spark, f"{self.path}/batch={r['batch']}")


def embed_once(
    texts: DataFrame, number: int, log: VectorLog, text: str, make: Callable[[DataFrame], DataFrame], out: str = "embedding"
) -> DataFrame:
    """A micro-batch of texts with their vectors; only texts that no earlier batch had are embedded, each of them once.

    ``make`` adds ``out`` to rows with ``text``. Null texts share one vector too.
    """
    keyed = texts.withColumn("key", F.coalesce(embedding_key(F.col(text)), F.lit("null")))
    distinct = keyed.groupBy("key").agg(F.first(text).alias(text))
    known = log.known(number, distinct)
    new = make(distinct.join(known, "key", "left_anti"))
    made = log.add(number, new.select("key", F.col(out).alias("vector")))
    vectors = known.unionByName(made).withColumnRenamed("vector", out)
    return keyed.join(vectors, "key").drop("key")
