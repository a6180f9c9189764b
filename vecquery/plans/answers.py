"""Answering a batch of requests: result tiers, embedding, search, context, answer, new entries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecquery.functions.keys import cache_key
from vecquery.functions.vectors import unit_query
from vecquery.operators import probing, context, results, search
from vecquery.operators.tier_store import TierStore, leveled
from vecquery.sources.tables import new_path, passing_tables, write_stage

VALUE_TYPE = (
    "struct<context:string,answer:string,"
    "docs:array<struct<rank:int,id:string,content:string,score:double>>>"
)

#: Finds hits ``query_id, rank, vec_id, score`` for queries ``query_id, vec`` and a greatest rank.
Search = Callable[[DataFrame, int], DataFrame]


def flat_search(index: DataFrame) -> Search:
    """Search that compares with every vector of ``index`` (vec_id, unit_vec)."""
    return lambda queries, k: search.search_exact(index, queries, k)


def list_search(index: DataFrame, centroids, nprobe: int) -> Search:
    """Search in the ``nprobe`` nearest lists of ``index`` (centroid_id, vec_id, unit_vec)."""
    return lambda queries, k: search.search_lists(index, queries, centroids, k, nprobe)


def bounded_search(index: DataFrame, centroids) -> Search:
    """Search in as many nearest lists as a bound on the others asks for: the hits of ``flat_search``."""
    return lambda queries, k: probing.search_lists_bounded(index, queries, centroids, k)[0]


def hash_search(index: DataFrame, dim: int, bands: int, bits: int) -> Search:
    """Search among vectors that share a hash bucket with the query."""
    return lambda queries, k: search.search_hashed(index, queries, k, dim, bands, bits)


def retrieve(
    queries: DataFrame, find: Search, documents: DataFrame, k: int, embed: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """query_id, query -> the same with context, docs. ``embed`` adds ``embedding`` to ``query``.

    A column ``top_k`` of the queries limits a query to fewer than ``k`` hits.
    """
    vectors = embed(queries.select("query_id", "query")).select("query_id", unit_query(F.col("embedding")).alias("vec"))
    hits = find(vectors, k)
    if "top_k" in queries.columns:
        limits = queries.select("query_id", "top_k")
        hits = hits.join(limits, "query_id").filter(F.col("rank") <= F.col("top_k")).drop("top_k")
    return context.with_contexts(queries, search.attach_documents(hits, documents))


def answer_batch(
    requests: DataFrame,
    tiers: Sequence[DataFrame],
    find: Search,
    documents: DataFrame,
    k: int,
    embed: Callable[[DataFrame], DataFrame],
    generate: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Responses for ``requests`` (query, now_us, and any columns that name a request), one row each.

    Optional columns of a request are ``top_k`` (default ``k``) and ``use_llm`` (default true). A valid tier entry answers
    at once. The other requests are reduced to one per key and ``use_llm``, and only those are embedded,
    searched and answered. ``generate`` gets rows with ``prompt`` and adds ``answer`` and ``error``, as
    ``generate_batch`` does; it sees only requests that want it and have a context. Without it the answer is the
    context. A null question is answered like one that finds nothing.

    Adds ``key``, ``context``, ``answer``, ``docs``, ``error``, ``cache_hit`` and ``cache_level``.
    """
    own = requests.columns
    top_k = F.coalesce("top_k", F.lit(k)) if "top_k" in own else F.lit(k)
    wants = F.coalesce("use_llm", F.lit(True)) if "use_llm" in own else F.lit(True)
    keyed = requests.withColumns({"_top_k": top_k.cast("int"), "_use_llm": wants}).withColumn(
        "key", cache_key(F.col("query"), F.col("_top_k"))
    )
    # read several times below: kept as a table, so that neither the lookup nor the reduction is repeated
    looked = write_stage(results.tiered_lookup(keyed, tiers), "looked")
    missed = write_stage(
        looked.filter("level = 'none' AND key IS NOT NULL").groupBy("key", "_use_llm").agg(
            F.first("query").alias("query"), F.first("_top_k").alias("top_k")
        ).withColumn("query_id", F.monotonically_increasing_id()),
        "missed",
    )
    widest = missed.agg(F.coalesce(F.max("top_k"), F.lit(1))).first()[0]
    found = retrieve(missed, find, documents, widest, embed)
    value = F.struct("context", "answer", "docs").cast(VALUE_TYPE).alias("_fresh")
    if generate is None:
        made = found.withColumns({"answer": context.answer_from_context(F.col("context")), "error": F.lit(None).cast("string")})
    else:
        found = write_stage(found, "found")
        asks = F.col("_use_llm") & (F.col("context") != "")
        plain = found.filter(~asks).withColumns(
            {"answer": context.answer_from_context(F.col("context")), "error": F.lit(None).cast("string")}
        )
        prompts = found.filter(asks).withColumn("prompt", context.build_prompt(F.col("context"), F.col("query")))
        made = generate(prompts).drop("prompt").unionByName(plain)
    fresh = made.select("key", "_use_llm", value, F.col("error").alias("error"))
    both = looked.join(fresh, ["key", "_use_llm"], "left")
    nothing = F.struct(
        F.lit("").alias("context"), context.answer_from_context(F.lit("")).alias("answer"), F.array().alias("docs")
    ).cast(VALUE_TYPE)
    value = F.coalesce(F.col("value").cast(VALUE_TYPE), F.col("_fresh"), nothing)
    return both.select(
        *own, "key", value.alias("value"), "error",
        (F.col("level") != "none").alias("cache_hit"), F.col("level").alias("cache_level"),
    ).select(*own, "key", "value.*", "error", "cache_hit", "cache_level")


def answer_and_store(
    requests: DataFrame, number: int, store: TierStore, default_ttls_ms: Sequence[int], label: str, **how
) -> DataFrame:
    """Responses of ``answer_batch``, kept as a table, whose new answers have gone into the store as commit ``number``.

    Requests are answered from the store's state before that commit, so a batch that is repeated gives the same responses
    and changes nothing. Only buckets that hold a request's key are read. New answers go into all tiers, and answers
    found in a lower tier into the ones above, each with the tier's default term. ``how``: as for ``answer_batch``.
    """
    levels = results.LEVELS[: len(default_ttls_ms)]
    top_k = F.coalesce("top_k", F.lit(how["k"])) if "top_k" in requests.columns else F.lit(how["k"])
    asked = store.buckets_of(requests.select(cache_key(F.col("query"), top_k.cast("int")).alias("key")))
    tiers = store.tiers(levels, store.manifest(before=number), asked)
    kept = new_path(store.spark, label)
    with passing_tables(store.spark):
        answers = answer_batch(requests, tiers, **how)
        answers.write.parquet(kept)
    made = store.spark.read.schema(answers.schema).parquet(kept)
    fresh = made.filter("NOT cache_hit AND error IS NULL")
    new = leveled(results.write_through(
        [tier.limit(0) for tier in tiers], results.answer_entries(fresh, F.col("now_us")), default_ttls_ms
    ))
    hits = made.filter("cache_hit").select("key", F.col("cache_level").alias("level"), "now_us", F.struct("context", "answer", "docs").alias("value"))
    copies = results.backfill(hits, default_ttls_ms).withColumnRenamed("tier", "level")
    store.put(number, new.unionByName(copies))
    return made


def assemble_responses(answers: DataFrame, timings: DataFrame, ids: Sequence[str], stages: Sequence[str]) -> DataFrame:
    """Response rows: answers with nested documents, the cache fields, and a latency map.

    ``timings`` has the ``ids`` columns and one ``{stage}_ms`` column per stage; an answer without timings, as one from a
    tier may be, keeps an empty map and no latency.
    """
    known = [F.col(f"{s}_ms") for s in stages]
    latency = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(s) for s in stages]), F.array(*[F.round(c, 2) for c in known])),
        lambda _, ms: ms.isNotNull(),
    )
    total = sum((F.coalesce(c, F.lit(0.0)) for c in known), F.lit(0.0))
    return answers.join(timings.select(*ids, *[f"{s}_ms" for s in stages]), list(ids), "left").select(
        *ids, "query", "context", "answer", "error", F.col("docs").alias("retrieved_docs"),
        latency.alias("stages_latency"), F.round(total, 2).alias("total_latency_ms"), "cache_hit", "cache_level",
    )
