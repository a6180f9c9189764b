"""Request, prompt and embedding keys.

``concat`` (not ``concat_ws``) keeps a null part visible: the key is then null and matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TOP_K = 10


def cache_key(query: Column, top_k: Column | int) -> Column:
    """The key answers are stored under, unhashed."""
    k = top_k if isinstance(top_k, Column) else F.lit(top_k)
    return F.concat(F.lit("rag:"), query, F.lit(":"), k.cast("string"))


def answer_key(query: Column, top_k: Column | int = DEFAULT_TOP_K) -> Column:
    return F.md5(cache_key(query, top_k).cast("binary"))


def generation_key(model: Column, temperature: Column, prompt: Column) -> Column:
    """``temperature`` is text: engines print small doubles differently."""
    return F.md5(
        F.concat(F.lit("llm:"), model, F.lit(":"), temperature, F.lit(":"), prompt).cast("binary")
    )


def embedding_key(text: Column) -> Column:
    return F.md5(F.concat(F.lit("emb:"), text).cast("binary"))


def request_id(created_at: Column, row_id: Column) -> Column:
    """``req_{microseconds}_{row}``; the row id stands in for an object address."""
    return F.concat(
        F.lit("req_"), F.unix_micros(created_at).cast("string"), F.lit("_"), row_id.cast("string")
    )
