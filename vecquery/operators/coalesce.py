"""Running identical requests once, and the leader scan behind in-flight merging and TTL replay.

Leader scan: per key in (time, id) order the first event leads. A later event leads again when the
current leader's span is over, otherwise it follows; followers never extend the span.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecquery.operators.joins import join_back
from vecquery.operators.ordered import carried
from vecquery.sources.tables import checkpointed

GROUP_ROWS = 200_000

_SCANNED = "key string, ts_us bigint, id bigint, leader_id bigint, leader_ts_us bigint, is_leader boolean"


def run_once(requests: DataFrame, work: Callable[[DataFrame], DataFrame], carry: list[str]) -> DataFrame:
    """Give ``work`` one row per distinct ``key`` (with the ``carry`` columns), join its result to all.

    ``carry`` columns must depend on the key. Copies collapse map-side.
    """
    distinct = requests.groupBy("key").agg(*[F.first(c).alias(c) for c in carry])
    return join_back(requests.drop(*carry), work(distinct), ["key"])


def leader_scan(
    events: DataFrame, closed: bool, group_rows: int = GROUP_ROWS, bin_rows: int | None = None
) -> DataFrame:
    """key, ts_us, id, span_us -> key, ts_us, id, leader_id, leader_ts_us, is_leader.

    ``closed``: an event exactly at the end of the span still follows. ``id`` is unique over all keys,
    ``span_us`` is not negative.

    Keys of up to ``group_rows`` events share bounded groups and are walked there. Longer ones never
    meet in one task: their events are cut into even bins and get a pointer to the leader that would come
    next, bins shrink to their entries and exits, and the entries really reached are found by pointer
    doubling, in about log2(bins) joins on the event id.
    """
    events = events.select(
        F.col("key").cast("string").alias("key"), "ts_us", "id",
        (F.col("ts_us") + F.col("span_us") + (1 if closed else 0)).alias("free_us"),
    )
    counts = events.groupBy("key").agg(F.count("*").alias("n"))
    is_long = F.col("n") > group_rows
    total, in_long = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(is_long, F.col("n"))), F.lit(0))
    ).first()
    if not in_long:
        return _scan_groups(events, total, group_rows)
    long_keys = counts.filter(is_long).select("key")
    short = _scan_groups(events.join(long_keys, "key", "left_anti"), total - in_long, group_rows)
    bins = -(-2 * in_long // (bin_rows or group_rows))
    return short.unionByName(_scan_long(events.join(long_keys, "key", "left_semi"), bins))


def _scan_groups(events: DataFrame, total: int, group_rows: int) -> DataFrame:
    groups = -(-total // group_rows) or 1
    groups = max(groups, int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    group = F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group")
    return events.groupBy(group).applyInArrow(_walk, _SCANNED)


def _walk(events: pa.Table) -> pa.Table:
    """Leader scan of whole keys held in memory."""
    events = events.take(
        pc.sort_indices(events, sort_keys=[("key", "ascending"), ("ts_us", "ascending"), ("id", "ascending")])
    )
    n = events.num_rows
    ts = events["ts_us"].to_numpy()
    key = events["key"].combine_chunks().dictionary_encode()
    key = key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key
    code = np.asarray(key.indices, dtype=np.int64)
    times = np.unique(ts)
    span = len(times) + 1
    here = code * span + np.searchsorted(times, ts)
    free = code * span + np.searchsorted(times, events["free_us"].to_numpy())
    following = np.maximum(np.searchsorted(here, free), np.arange(n) + 1)
    leads = np.zeros(n, dtype=bool)
    step = np.flatnonzero(np.diff(code, prepend=-1)) if n else np.zeros(0, dtype=np.int64)
    while len(step):
        leads[step] = True
        ahead = following[step]
        inside = ahead < n
        inside[inside] = code[ahead[inside]] == code[step[inside]]
        step = ahead[inside]
    leader = np.maximum.accumulate(np.where(leads, np.arange(n), 0)) if n else step
    ids = events["id"].to_numpy()
    return pa.table({
        "key": events["key"], "ts_us": ts, "id": ids,
        "leader_id": ids[leader], "leader_ts_us": ts[leader], "is_leader": leads,
    })


def _scan_long(events: DataFrame, bins: int) -> DataFrame:
    # events of one instant act as one: if it may lead, its events lead up to the first with a span
    has_span = F.when(F.col("free_us") > F.col("ts_us"), F.col("id"))
    instants = events.groupBy("key", "ts_us").agg(
        F.min("id").alias("id"), F.min(has_span).alias("cover_id"),
        F.coalesce(F.min_by("free_us", has_span), F.col("ts_us") + 1).alias("free_us"),
    )
    # one line per key of instants and of the moments each of them would be over, cut by range into
    # even bins whatever the distribution; the checkpoint fixes the cut
    line = instants.select(
        "key", "id", "cover_id",
        F.inline(F.array(
            F.struct(F.col("ts_us").alias("at"), F.lit(1).alias("there")),
            F.struct(F.col("free_us").alias("at"), F.lit(0).alias("there")),
        )),
    )
    place = ["at", "there", "id"]
    line = checkpointed(
        line.repartitionByRange(bins, "key", *place).withColumn("bin", F.spark_partition_id())
    ).withColumn("event", F.when(F.col("there") == 1, F.struct("id", "bin")))
    timed = line.filter("there = 1").select("key", "bin", F.col("at").alias("ts_us"), "id", "cover_id")
    # walking backwards, a moment has just passed the first instant that may lead from then on
    found = carried(line, ["key"], "bin", place, "event", "next", backwards=True)
    pointers = checkpointed(timed.join(
        found.filter("there = 0").select("id", F.col("next.id").alias("next_id"), F.col("next.bin").alias("next_bin")), "id"
    ))
    # a bin is left once: keep for each instant only where the leaders after it enter another bin
    exits = checkpointed(pointers.groupBy("key", "bin").applyInArrow(_leave_bin, "id bigint, next bigint"))
    first = timed.groupBy("key").agg(F.min_by("id", "ts_us").alias("id")).select("id")
    onward = exits.filter("next IS NOT NULL")
    entries = first.unionByName(onward.select(F.col("next").alias("id"))).distinct()
    jump = checkpointed(onward.join(entries, "id", "left_semi"))
    reached = new = checkpointed(first)
    while not new.isEmpty():
        # reached: the first 2^r bin entries of each key; jump: 2^r entries ahead
        new = checkpointed(reached.join(jump, "id").select(F.col("next").alias("id")))
        reached = reached.unionByName(new)
        far = jump.select(F.col("id").alias("next"), F.col("next").alias("far"))
        jump = checkpointed(jump.join(far, "next").select("id", F.col("far").alias("next")))
    marked = pointers.join(reached.withColumn("entry", F.lit(True)), "id", "left").groupBy("key", "bin").applyInArrow(
        _walk_bin, "key string, bin int, ts_us bigint, cover_id bigint, leads boolean"
    ).withColumn("mark", F.when(F.col("leads"), F.struct(F.col("cover_id").alias("id"), "ts_us")))
    led = carried(marked, ["key"], "bin", ["ts_us"], "mark", "leader").select(
        "key", "ts_us", "leads", "cover_id", "leader"
    )
    leads = F.col("leads") & (F.col("cover_id").isNull() | (F.col("id") <= F.col("cover_id")))
    return events.join(led, ["key", "ts_us"]).select(
        "key", "ts_us", "id",
        F.when(leads, F.col("id")).otherwise(F.col("leader.id")).alias("leader_id"),
        F.when(leads, F.col("ts_us")).otherwise(F.col("leader.ts_us")).alias("leader_ts_us"),
        leads.alias("is_leader"),
    )


def _next_in_bin(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each instant of one key and bin: does its next leader lie in the bin, and in which row."""
    ids = rows["id"].to_numpy()
    order = np.argsort(ids)
    inside = pc.fill_null(pc.equal(rows["next_bin"], rows["bin"]), False).to_numpy()
    wanted = pc.fill_null(rows["next_id"], 0).to_numpy()[inside]
    row = np.arange(len(ids))
    row[inside] = order[np.searchsorted(ids[order], wanted)]
    return inside, row


def _leave_bin(rows: pa.Table) -> pa.Table:
    _, last = _next_in_bin(rows)
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    return pa.table({"id": rows["id"], "next": rows["next_id"].take(pa.array(last))})


def _walk_bin(rows: pa.Table) -> pa.Table:
    inside, following = _next_in_bin(rows)
    leads = pc.fill_null(rows["entry"], False).to_numpy().copy()
    for at in np.flatnonzero(leads).tolist():
        while inside[at]:
            at = following[at]
            leads[at] = True
    return rows.select(["key", "bin", "ts_us", "cover_id"]).append_column("leads", pa.array(leads))


def merge_in_flight(log: DataFrame, **sizes: int) -> DataFrame:
    """key, ts_us, id, span_us (how long the work takes): a request joins the one still running."""
    return leader_scan(log, closed=False, **sizes)


def replay_ttl(log: DataFrame, ttl_us: int, **sizes: int) -> DataFrame:
    """key, ts_us, id: which accesses hit when every miss writes and hits do not extend the entry."""
    return leader_scan(log.withColumn("span_us", F.lit(ttl_us).cast("bigint")), closed=True, **sizes)


def merge_stats(scanned: DataFrame) -> DataFrame:
    """One row: requests, executions, coalesced, saved and the merge ratio."""
    saved = F.count_if(~F.col("is_leader"))
    made = scanned.agg(
        F.count("*").alias("total_requests"), F.count_if("is_leader").alias("executions"),
        saved.alias("coalesced"), saved.alias("saved"),
    )
    ratio = F.try_divide(F.col("saved").cast("double"), F.col("total_requests").cast("double"))
    return made.withColumn("merge_ratio", F.round(F.coalesce(ratio, F.lit(0.0)), 4))
