"""Corpus shaping and embedding of text columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecquery.functions.keys import embedding_key
from vecquery.functions.text import feature_counts
from vecquery.operators.joins import join_back

DEFAULT_DIM = 64


def document_id(row: Column) -> Column:
    """``doc_`` and at least six digits."""
    digits = row.cast("string")
    padded = F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits)
    return F.concat(F.lit("doc_"), padded)


def build_corpus(texts: DataFrame, row: str, text: str, topic: str, kind: str) -> DataFrame:
    """Raw texts to documents: id, content, metadata{topic, type, length}."""
    return texts.select(
        document_id(F.col(row)).alias("id"),
        F.col(text).alias("content"),
        F.struct(
            F.col(topic).alias("topic"), F.col(kind).alias("type"), F.length(text).alias("length")
        ).alias("metadata"),
    )


def embed_hashed(df: DataFrame, text: str, dim: int = DEFAULT_DIM, out: str = "embedding") -> DataFrame:
    """The built-in embedding: counts of hashed words."""
    return df.withColumn(out, feature_counts(F.col(text), dim))


def embed_batch(
    df: DataFrame,
    text: str,
    make_model: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int = 64,
    out: str = "embedding",
) -> DataFrame:
    """Embed with a caller's model: ``make_model`` runs once per task, the model once per batch.

    The model maps n texts to an (n, dim) array; another shape fails the job, so every row gets its vector.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                part = batch.slice(start, batch_size)
                made = np.asarray(model(part.column(at).to_pylist()), dtype=np.float32)
                if made.ndim != 2 or len(made) != part.num_rows:
                    raise ValueError(f"model gave shape {made.shape} for {part.num_rows} texts")
                ends = np.arange(0, made.size + 1, made.shape[1], dtype=np.int32)
                vectors = pa.ListArray.from_arrays(pa.array(ends), pa.array(made.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, vectors], names=[*batch.schema.names, out]
                )

    return df.mapInArrow(run, schema)


def embed_distinct(
    df: DataFrame, text: str, embed: Callable[[DataFrame], DataFrame], out: str = "embedding"
) -> DataFrame:
    """Embed each distinct text once and give the vector to all its copies.

    Copies collapse map-side before the shuffle; on the way back a key with very many copies is one
    AQE-splittable side of an equi-join whose other side has a single row per key.
    """
    keyed = df.withColumn("emb_key", embedding_key(F.col(text)))
    distinct = keyed.groupBy("emb_key").agg(F.first(text).alias(text))
    vectors = embed(distinct).select("emb_key", out)
    return join_back(keyed, vectors, ["emb_key"])
