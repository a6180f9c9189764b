"""Coalescing and result tables, on ``events``.

History before SPLIT fills the tiers, events from SPLIT on are the requests. Spans are scaled to the
thirty days the events cover.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecquery.functions.keys import cache_key
from vecquery.operators import coalesce, results
from vecquery.operators.tier_store import TierStore, leveled
from vecquery.registry.metrics import LOG, request_log
from vecquery.sources.tables import new_path

DAY_US = 86_400_000_000
SPLIT = "2024-01-25 00:00:00"
SPLIT_US = 1_706_140_800_000_000  # the same in microseconds, UTC
TTLS_MS = (43_200_000, 345_600_000, 0)  # half a day, four days, for ever
CAPACITY = 1_000


# ---- inputs -----------------------------------------------------------------------------------

def since_split():
    return F.col("ts") >= F.expr(f"TIMESTAMP_NTZ'{SPLIT}'")


def accesses(spark, folder, where=None) -> DataFrame:
    """Requests for a (user, k) question."""
    query = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(" k"), F.col("k").cast("string"))
    return request_log(spark, folder, where).withColumn("key", cache_key(query, 5))


def requests(spark, folder) -> DataFrame:
    later = accesses(spark, folder, since_split())
    return later.select("request_id", "key", F.col("ts_us").alias("now_us"))


def writes(log: DataFrame) -> DataFrame:
    value = F.struct(F.col("event_type").alias("context"), F.col("request_id").cast("string").alias("answer"))
    return log.select("key", value.alias("value"), F.col("ts_us").alias("created_us"), F.lit(0).alias("ttl_ms"))


def tiers(spark, folder) -> list[DataFrame]:
    """l1 holds every question of the past, l2 views and clicks, l3 purchases."""
    past = accesses(spark, folder, ~since_split())
    sources = (past, past.filter(F.col("event_type").isin("view", "click")), past.filter("event_type = 'purchase'"))
    return [results.latest_by_key(results.entries(writes(log), ttl)) for log, ttl in zip(sources, TTLS_MS)]


def flat(tier: DataFrame) -> DataFrame:
    return tier.withColumns({"context": F.col("value.context"), "answer": F.col("value.answer")}).drop("value")


def in_flight_log(spark, folder) -> DataFrame:
    """Latencies read as minutes, so that requests of one type overlap."""
    return request_log(spark, folder).select(
        F.concat(F.lit("rag:"), "event_type").alias("key"), "ts_us", F.col("request_id").alias("id"),
        F.round(F.col("latency_ms") * 60_000_000).cast("bigint").alias("span_us"),
    )


def user_log(spark, folder) -> DataFrame:
    return request_log(spark, folder).select(
        F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("key"), "ts_us", F.col("request_id").alias("id")
    )


# ---- queries ----------------------------------------------------------------------------------

def coalesce_batch(spark, folder):
    """Each distinct request key is answered once and all its requests get the answer."""
    def work(distinct):
        words = ["answer to ", F.col("event_type"), " ", F.length("key").cast("string")]
        return distinct.select("key", F.concat(*[F.lit(w) if isinstance(w, str) else w for w in words]).alias("answer"))

    log = request_log(spark, folder).select("request_id", "key", "event_type")
    return coalesce.run_once(log, work, ["event_type"]).select("request_id", "key", "answer")


def coalesce_inflight(spark, folder):
    return coalesce.merge_in_flight(in_flight_log(spark, folder)).select("key", "id", "leader_id", "is_leader")


def coalesce_stats(spark, folder):
    return coalesce.merge_stats(coalesce.merge_in_flight(in_flight_log(spark, folder)))


def cache_lookup(spark, folder):
    made = results.lookup(requests(spark, folder), tiers(spark, folder)[1])
    return made.select("request_id", "hit", F.col("value.answer").alias("answer"))


def cache_tiered_lookup(spark, folder):
    made = results.tiered_lookup(requests(spark, folder), tiers(spark, folder))
    return made.select("request_id", "level", F.col("value.answer").alias("answer"))


def cache_backfill(spark, folder):
    made = results.tiered_lookup(requests(spark, folder), tiers(spark, folder))
    return flat(results.backfill(made, TTLS_MS))


def _stored(spark, folder) -> TierStore:
    """The past's tiers as commit 0 of a store."""
    store = TierStore(spark, new_path(spark, "tiers"), "struct<context: string, answer: string>", 16)
    store.put(0, leveled(tiers(spark, folder)))
    return store


def cache_upsert(spark, folder):
    """Write-through of all requests as new entries; those of errors ask for a ttl of one hour."""
    store = _stored(spark, folder)
    later = accesses(spark, folder, since_split())
    store.upsert(1, writes(later).withColumn("ttl_ms", F.when(F.col("value.context") == "error", 3_600_000).otherwise(0)), TTLS_MS)
    return flat(store.rows().withColumnRenamed("level", "tier"))


def cache_delete(spark, folder):
    """Every question a purchase was made for leaves all tiers."""
    store = _stored(spark, folder)
    store.delete(1, accesses(spark, folder, F.col("event_type") == "purchase").select("key").distinct())
    return store.rows().select("key", F.col("level").alias("tier"), "expires_us")


def cache_clean_expired(spark, folder):
    store = _stored(spark, folder)
    store.clean_expired(1, SPLIT_US)
    return flat(store.tiers()[1])


def cache_evict_lru(spark, folder):
    log = accesses(spark, folder).select("key", "ts_us")
    return flat(results.keep_recent(tiers(spark, folder)[0], log, CAPACITY))


def cache_ttl_replay(spark, folder):
    made = coalesce.replay_ttl(user_log(spark, folder), 3 * DAY_US)
    return made.select("key", "id", "leader_id", (~F.col("is_leader")).alias("hit"))


def cache_stats(spark, folder):
    every = tiers(spark, folder)
    return results.tier_stats(results.tiered_lookup(requests(spark, folder), every), every)


def cache_entry_size(spark, folder):
    return tiers(spark, folder)[0].select("key", results.entry_size(F.col("value")).cast("bigint").alias("size_bytes"))


# ---- the same in SQL --------------------------------------------------------------------------

def _tier(name: str, ttl: int, where: str) -> str:
    expires = f"created_us + {ttl * 1000}" if ttl else "0::BIGINT"
    return f"""{name} AS (SELECT key, {expires} AS expires_us, created_us, context, answer FROM (
  SELECT key, ts_us AS created_us, event_type AS context, request_id::VARCHAR AS answer,
    row_number() OVER (PARTITION BY key ORDER BY ts_us DESC) AS r FROM acc
  WHERE ts_us < {SPLIT_US} AND {where}) WHERE r = 1)"""


_ACCESSES = LOG + """, acc AS (SELECT * REPLACE ('rag:u' || user_id || ' k' || k || ':5' AS key) FROM log)"""
_TIERS = f"""{_ACCESSES}, {_tier('l1', TTLS_MS[0], 'true')},
{_tier('l2', TTLS_MS[1], "event_type IN ('view', 'click')")}, {_tier('l3', TTLS_MS[2], "event_type = 'purchase'")},
req AS (SELECT request_id, key, ts_us AS now_us FROM acc WHERE ts_us >= {SPLIT_US})"""
_LOOKED_UP = f"""{_TIERS}, found AS (SELECT request_id, key, now_us,
  CASE WHEN now_us <= l1.expires_us THEN 'l1' WHEN now_us <= l2.expires_us THEN 'l2'
       WHEN l3.key IS NOT NULL THEN 'l3' ELSE 'none' END AS level,
  CASE level WHEN 'l1' THEN l1.answer WHEN 'l2' THEN l2.answer WHEN 'l3' THEN l3.answer END AS answer,
  CASE level WHEN 'l1' THEN l1.context WHEN 'l2' THEN l2.context WHEN 'l3' THEN l3.context END AS context
  FROM req LEFT JOIN l1 USING (key) LEFT JOIN l2 USING (key) LEFT JOIN l3 USING (key))"""


def leaders(events: str, after: str) -> str:
    """Recursive leader scan over ``events(key, ts_us, id, span_us)``."""
    return f"""
lead AS (SELECT key, ts_us, id, span_us FROM (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts_us, id) AS r FROM {events}) WHERE r = 1
  UNION ALL
  SELECT key, ts_us, id, span_us FROM (
    SELECT e.*, row_number() OVER (PARTITION BY e.key ORDER BY e.ts_us, e.id) AS r
    FROM lead l JOIN {events} e ON e.key = l.key AND e.ts_us {after} l.ts_us + l.span_us) WHERE r = 1),
led AS (SELECT e.key, e.id, l.id AS leader_id, l.id = e.id AS is_leader
  FROM {events} e ASOF JOIN lead l ON e.key = l.key AND e.ts_us >= l.ts_us)"""


_FLIGHT = f"""{LOG}, ev AS (SELECT 'rag:' || event_type AS key, ts_us, request_id AS id,
  round(latency_ms * 60000000)::BIGINT AS span_us FROM log), {leaders('ev', '>=')}"""
_UPSERTED = f"""SELECT key, created_us, context, answer, CASE WHEN context = 'error' THEN created_us + 3600000000
  WHEN {{ttl}} > 0 THEN created_us + {{ttl}}::BIGINT * 1000 ELSE 0 END AS expires_us, '{{tier}}' AS tier
FROM (SELECT key, ts_us AS created_us, event_type AS context, request_id::VARCHAR AS answer,
    row_number() OVER (PARTITION BY key ORDER BY ts_us DESC) AS r FROM acc WHERE ts_us >= {SPLIT_US}) WHERE r = 1
UNION ALL SELECT key, created_us, context, answer, expires_us, '{{tier}}' FROM {{tier}} WHERE key NOT IN (SELECT key FROM req)"""

ENTRIES = {
    "coalesce_batch": (coalesce_batch, f"""
WITH {LOG} SELECT request_id, key, 'answer to ' || event_type || ' ' || length(key) AS answer FROM log"""),
    "coalesce_inflight": (coalesce_inflight, f"WITH RECURSIVE {_FLIGHT} SELECT * FROM led"),
    "coalesce_stats": (coalesce_stats, f"""
WITH RECURSIVE {_FLIGHT} SELECT count(*) AS total_requests, count(*) FILTER (is_leader) AS executions,
  count(*) FILTER (NOT is_leader) AS coalesced, count(*) FILTER (NOT is_leader) AS saved,
  round(count(*) FILTER (NOT is_leader) / count(*), 4) AS merge_ratio FROM led"""),
    "cache_lookup": (cache_lookup, f"""
WITH {_TIERS} SELECT request_id, coalesce(now_us <= expires_us, false) AS hit,
  CASE WHEN now_us <= expires_us THEN answer END AS answer FROM req LEFT JOIN l2 USING (key)"""),
    "cache_tiered_lookup": (cache_tiered_lookup, f"WITH {_LOOKED_UP} SELECT request_id, level, answer FROM found"),
    "cache_backfill": (cache_backfill, f"""
WITH {_LOOKED_UP}, up AS (
  SELECT key, 'l1' AS tier, now_us, now_us + {TTLS_MS[0] * 1000} AS expires_us, context, answer FROM found WHERE level IN ('l2', 'l3')
  UNION ALL SELECT key, 'l2', now_us, now_us + {TTLS_MS[1] * 1000}, context, answer FROM found WHERE level = 'l3')
SELECT key, tier, now_us AS created_us, expires_us, context, answer FROM (
  SELECT *, row_number() OVER (PARTITION BY key, tier ORDER BY now_us DESC) AS r FROM up) WHERE r = 1"""),
    "cache_upsert": (cache_upsert, f"""
WITH {_TIERS} {' UNION ALL '.join(_UPSERTED.format(tier=f'l{i + 1}', ttl=ttl) for i, ttl in enumerate(TTLS_MS))}"""),
    "cache_delete": (cache_delete, f"""
WITH {_TIERS}, gone AS (SELECT DISTINCT key FROM acc WHERE event_type = 'purchase')
{' UNION ALL '.join(f"SELECT key, '{t}' AS tier, expires_us FROM {t} WHERE key NOT IN (SELECT key FROM gone)" for t in ('l1', 'l2', 'l3'))}"""),
    "cache_clean_expired": (cache_clean_expired, f"""
WITH {_TIERS} SELECT * FROM l2 WHERE NOT (expires_us > 0 AND expires_us < {SPLIT_US})"""),
    "cache_evict_lru": (cache_evict_lru, f"""
WITH {_TIERS}, used AS (SELECT key, max(ts_us) AS last_us FROM acc GROUP BY key)
SELECT l1.* FROM l1 JOIN used USING (key) ORDER BY last_us DESC, key LIMIT {CAPACITY}"""),
    "cache_ttl_replay": (cache_ttl_replay, f"""
WITH RECURSIVE {LOG}, ev AS (SELECT 'user:' || user_id AS key, ts_us, request_id AS id, {3 * DAY_US} AS span_us FROM log),
{leaders('ev', '>')} SELECT key, id, leader_id, NOT is_leader AS hit FROM led"""),
    "cache_stats": (cache_stats, f"""
WITH {_LOOKED_UP}, c AS (SELECT count(*) FILTER (level = 'l1') AS a, count(*) FILTER (level = 'l2') AS b,
  count(*) FILTER (level = 'l3') AS c, count(*) FILTER (level = 'none') AS z FROM found)
SELECT *, round(hits / (hits + misses), 4) AS hit_rate FROM (
  SELECT 'l1' AS level, (SELECT count(*) FROM l1) AS size, a AS hits, b + c + z AS misses FROM c
  UNION ALL SELECT 'l2', (SELECT count(*) FROM l2), b, c + z FROM c
  UNION ALL SELECT 'l3', (SELECT count(*) FROM l3), c, z FROM c)"""),
    "cache_entry_size": (cache_entry_size, f"""
WITH {_TIERS} SELECT key, length('{{"context":"' || context || '","answer":"' || answer || '"}}') AS size_bytes FROM l1"""),
}
