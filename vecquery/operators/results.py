"""Result tables with expiry, in tiers.

A tier has one row per key: key, value, expires_us (0: never), created_us. Tables are never changed in
place: each function gives the next state, to be written to a new path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecquery.operators.ordered import BIN_ROWS, even_bins, positions

L1_TTL_MS = 5_000
L2_TTL_MS = 60_000

LEVELS = ("l1", "l2", "l3")


def is_valid(expires_us: Column, now_us: Column) -> Column:
    """Valid up to and including the expiry instant."""
    return (expires_us <= 0) | (now_us <= expires_us)


def lookup(requests: DataFrame, tier: DataFrame) -> DataFrame:
    """Add ``hit`` and ``value`` (null on a miss). ``requests``: key, now_us and more.

    The tier has one row per key, so a key with very many requests only makes one side of the join
    large, which AQE splits.
    """
    kept = tier.select("key", F.col("value").alias("_value"), F.col("expires_us").alias("_expires"))
    fresh = is_valid(F.col("_expires"), F.col("now_us"))
    return requests.join(kept, "key", "left").select(
        *[requests[c] for c in requests.columns],
        F.coalesce(fresh, F.lit(False)).alias("hit"),
        F.when(fresh, F.col("_value")).alias("value"),
    )


def tiered_lookup(requests: DataFrame, tiers: Sequence[DataFrame]) -> DataFrame:
    """First valid tier wins: adds ``level`` (l1, l2, l3 or none) and ``value``.

    The tiers become one row per key first, so the requests are joined once.
    """
    stacked = None
    for level, tier in zip(LEVELS, tiers):
        part = tier.select("key", F.lit(level).alias("_level"), F.struct("value", "expires_us").alias("_entry"))
        stacked = part if stacked is None else stacked.unionByName(part)
    levels = LEVELS[: len(tiers)]
    wide = stacked.groupBy("key").agg(*[
        F.max_by("_entry", F.when(F.col("_level") == level, F.lit(1))).alias(f"_{level}") for level in levels
    ])
    now = F.col("now_us")

    def fresh(level: str) -> Column:
        return is_valid(F.col(f"_{level}.expires_us"), now)

    label = F.coalesce(*[F.when(fresh(level), F.lit(level)) for level in levels], F.lit("none"))
    value = F.coalesce(*[F.when(fresh(level), F.col(f"_{level}.value")) for level in levels])
    return requests.join(wide, "key", "left").select(
        *[requests[c] for c in requests.columns], label.alias("level"), value.alias("value")
    )


def latest_by_key(rows: DataFrame, keys: Sequence[str] = ("key",)) -> DataFrame:
    """One row per key, the one created last. Aggregates map-side.

    Ties go to the later expiry, then to the value with the greater hash, so that a rerun agrees.
    """
    others = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct("created_us", "expires_us", F.xxhash64("value")))
    return rows.groupBy(*keys).agg(newest.alias("_row")).select(*keys, *[F.col(f"_row.{c}") for c in others])


def entries(writes: DataFrame, default_ttl_ms: int) -> DataFrame:
    """Writes (key, value, created_us, ttl_ms) as tier rows; a ttl of 0 or null means the default."""
    ttl_ms = F.coalesce(F.nullif(F.col("ttl_ms"), F.lit(0)), F.lit(default_ttl_ms)).cast("bigint")
    expires = F.when(ttl_ms > 0, F.col("created_us") + ttl_ms * 1000).otherwise(F.lit(0))
    return writes.select("key", "value", expires.cast("bigint").alias("expires_us"), "created_us")


def upsert(tier: DataFrame, writes: DataFrame, default_ttl_ms: int) -> DataFrame:
    return latest_by_key(tier.unionByName(entries(writes, default_ttl_ms)))


def write_through(tiers: Sequence[DataFrame], writes: DataFrame, default_ttls_ms: Sequence[int]) -> list[DataFrame]:
    return [upsert(tier, writes, ttl) for tier, ttl in zip(tiers, default_ttls_ms)]


def backfill(looked_up: DataFrame, default_ttls_ms: Sequence[int]) -> DataFrame:
    """Rows to copy upwards: a hit in l2 goes to l1, one in l3 to l1 and l2. Adds ``tier``."""
    depth = F.array_position(F.array(*[F.lit(x) for x in LEVELS]), F.col("level"))
    found = looked_up.filter(depth > 1).groupBy("key", "level").agg(
        F.max("now_us").alias("created_us"), F.max_by("value", "now_us").alias("value")
    )
    above = F.slice(F.array(*[
        F.struct(F.lit(level).alias("tier"), F.lit(ttl).cast("bigint").alias("ttl_ms"))
        for level, ttl in zip(LEVELS, default_ttls_ms)
    ]), F.lit(1), (depth - 1).cast("int"))
    copies = found.select("key", "value", "created_us", F.explode(above).alias("_to")).select(
        "key", "value", "created_us", F.col("_to.tier").alias("tier"),
        (F.col("created_us") + F.col("_to.ttl_ms") * 1000).alias("expires_us"),
    )
    newest = F.max_by(F.struct("value", "expires_us", "created_us"), "created_us")
    return copies.groupBy("key", "tier").agg(newest.alias("_row")).select("key", "tier", "_row.*")


def delete(tier: DataFrame, keys: DataFrame) -> DataFrame:
    return tier.join(keys.select("key"), "key", "left_anti")


def clean_expired(tier: DataFrame, now_us: int) -> DataFrame:
    return tier.filter(~((F.col("expires_us") > 0) & (F.col("expires_us") < now_us)))


def keep_recent(tier: DataFrame, accesses: DataFrame, capacity: int, rows: int = BIN_ROWS) -> DataFrame:
    """The ``capacity`` most recently used keys (ties: smaller key); unused keys count by creation.

    Keys are placed within bins of about ``rows`` keys, so a large capacity needs no global sort.
    """
    used = accesses.groupBy("key").agg(F.max("ts_us").alias("_used"))
    recency = F.greatest(F.coalesce("_used", F.col("created_us")), F.col("created_us"))
    dated = tier.join(used, "key", "left").withColumn("_used", recency)
    order = [F.desc("_used"), F.asc("key")]
    placed = positions(even_bins(dated, order, rows), [], "_bin", order, "_position", "_total")
    return placed.filter(F.col("_position") <= capacity).drop("_used", "_bin", "_position", "_total")


def tier_stats(looked_up: DataFrame, tiers: Sequence[DataFrame]) -> DataFrame:
    """Per tier: size, hits, misses (lookups that reached it in vain) and hit rate."""
    levels = LEVELS[: len(tiers)]
    served = looked_up.groupBy("level").agg(F.count("*").alias("_n"))
    totals = served.agg(
        *[F.coalesce(F.sum(F.when(F.col("level") == x, F.col("_n"))), F.lit(0)).alias(x) for x in (*levels, "none")]
    )
    reach = [sum((F.col(x) for x in levels[i + 1 :]), F.col("none")) for i in range(len(levels))]
    rows = F.array(*[
        F.struct(F.lit(x).alias("level"), F.col(x).alias("hits"), reach[i].alias("misses"))
        for i, x in enumerate(levels)
    ])
    sizes = None
    for level, tier in zip(levels, tiers):
        part = tier.agg(F.count("*").alias("size")).withColumn("level", F.lit(level))
        sizes = part if sizes is None else sizes.unionByName(part)
    rate = F.try_divide(F.col("hits").cast("double"), (F.col("hits") + F.col("misses")).cast("double"))
    return totals.select(F.inline(rows)).join(sizes, "level", "left").select(
        "level", F.coalesce("size", F.lit(0)).alias("size"), "hits", "misses",
        F.round(F.coalesce(rate, F.lit(0.0)), 4).alias("hit_rate"),
    )


def entry_size(value: Column) -> Column:
    """Characters of the value as JSON text."""
    return F.length(F.to_json(value))


def answer_entries(responses: DataFrame, created_us: Column, ttl_ms: int = 0) -> DataFrame:
    """Responses (key, context, answer, docs) as writes; of several answers to a key the last one is written.

    Answers of one instant, as with and without a model, are told apart by a hash, so that a rerun agrees.
    """
    value = F.struct("context", "answer", "docs")
    return responses.filter("key IS NOT NULL").groupBy("key").agg(
        F.max_by(value, F.struct(created_us.alias("c"), F.xxhash64(value).alias("h"))).alias("value"), F.max(created_us).alias("created_us")
    ).withColumn("ttl_ms", F.lit(ttl_ms))
