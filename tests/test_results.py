import pytest
from pyspark.sql import functions as F

from vecquery.operators import results

TIER = "key string, value string, expires_us bigint, created_us bigint"


def tier(spark, *rows):
    return spark.createDataFrame(list(rows), TIER)


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), "request_id bigint, key string, now_us bigint")


def test_entry_is_valid_at_its_expiry(spark):
    held = tier(spark, ("a", "A", 100, 0), ("b", "B", 0, 0), ("c", "C", -1, 0))
    asked = requests(spark, (1, "a", 100), (2, "a", 101), (3, "b", 10**15), (4, "c", 5), (5, "x", 5))
    got = {r.request_id: (r.hit, r.value) for r in results.lookup(asked, held).collect()}
    assert got == {1: (True, "A"), 2: (False, None), 3: (True, "B"), 4: (True, "C"), 5: (False, None)}


def test_first_valid_tier_answers(spark):
    tiers = [tier(spark, ("a", "A1", 10, 0)), tier(spark, ("a", "A2", 20, 0)), tier(spark, ("a", "A3", 0, 0), ("b", "B3", 0, 0))]
    asked = requests(spark, (1, "a", 10), (2, "a", 15), (3, "a", 25), (4, "b", 1), (5, "x", 1))
    looked = results.tiered_lookup(asked, tiers)
    got = {r.request_id: (r.level, r.value) for r in looked.collect()}
    assert got == {1: ("l1", "A1"), 2: ("l2", "A2"), 3: ("l3", "A3"), 4: ("l3", "B3"), 5: ("none", None)}
    stats = {r.level: (r["size"], r.hits, r.misses, r.hit_rate) for r in results.tier_stats(looked, tiers).collect()}
    assert stats == {"l1": (1, 1, 4, 0.2), "l2": (1, 1, 3, 0.25), "l3": (2, 2, 1, 0.6667)}


def test_stats_without_requests(spark):
    tiers = [tier(spark), tier(spark, ("a", "A", 0, 0))]
    looked = results.tiered_lookup(requests(spark), tiers)
    assert {tuple(r) for r in results.tier_stats(looked, tiers).collect()} == {("l1", 0, 0, 0, 0.0), ("l2", 1, 0, 0, 0.0)}


def test_backfill_copies_upwards_with_the_tier_ttl(spark):
    tiers = [tier(spark), tier(spark, ("a", "A2", 0, 0)), tier(spark, ("b", "B3", 0, 0))]
    looked = results.tiered_lookup(requests(spark, (1, "a", 5), (2, "a", 9), (3, "b", 7)), tiers)
    got = {(r.key, r.tier): (r.value, r.created_us, r.expires_us) for r in results.backfill(looked, (1, 2, 3)).collect()}
    assert got == {("a", "l1"): ("A2", 9, 1009), ("b", "l1"): ("B3", 7, 1007), ("b", "l2"): ("B3", 7, 2007)}


def test_upsert_replaces_and_zero_ttl_is_the_default(spark):
    held = tier(spark, ("a", "old", 50, 1), ("b", "B", 50, 1))
    new = spark.createDataFrame(
        [("a", "new", 10, 0), ("c", "C", 10, 7), ("d", "D", 10, None)], "key string, value string, created_us bigint, ttl_ms bigint"
    )
    after = results.upsert(held, new, 5)
    rows = {r.key: (r.value, r.expires_us) for r in after.collect()}
    assert rows == {"a": ("new", 5010), "b": ("B", 50), "c": ("C", 7010), "d": ("D", 5010)}
    again = results.upsert(after, new, 5)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in after.collect()}


def test_delete_and_clean(spark):
    held = tier(spark, ("a", "A", 10, 0), ("b", "B", 0, 0), ("c", "C", 11, 0))
    assert {r.key for r in results.clean_expired(held, 11).collect()} == {"b", "c"}
    gone = spark.createDataFrame([("a",), ("zz",)], "key string")
    assert {r.key for r in results.delete(held, gone).collect()} == {"b", "c"}


@pytest.mark.parametrize("capacity", [0, 1, 3, 10])
def test_least_recently_used_keys_leave(spark, capacity):
    held = tier(spark, *[(k, k, 0, i) for i, k in enumerate("abcde")])
    used = spark.createDataFrame([("a", 100), ("b", 7), ("a", 3), ("c", 100)], "key string, ts_us bigint")
    kept = [r.key for r in results.keep_recent(held, used, capacity, rows=2).collect()]
    assert sorted(kept) == sorted(["a", "c", "b", "e", "d"][:capacity])


def test_entry_size_counts_characters(spark):
    df = spark.createDataFrame([("é文",)], "t string").select(results.entry_size(F.struct("t")).alias("n"))
    assert df.first().n == len('{"t":"é文"}')
