import random
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vecquery.operators import coalesce, embed, generate, index, results
from vecquery.plans import answers
from vecquery.sources.tables import new_path
from vecquery.streaming import index as stream_index
from vecquery.streaming import leaders, runs, throughput

def mock(prompts):
    return prompts.withColumns({"answer": generate.mock_reply(F.col("prompt")), "error": F.lit(None).cast("string")})


DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


def files(spark, df, parts, order):
    """The rows of ``df`` in ``parts`` files, one after another in time order."""
    path = new_path(spark, "stream-input")
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // parts)
    for i in range(parts):
        piece = spark.createDataFrame(rows[i * size : (i + 1) * size], df.schema)
        piece.coalesce(1).write.mode("append").parquet(path)
    return runs.file_stream(spark, path, "*.parquet", df.schema, 1)


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(11)
    rows = [
        (rng.choice(["hot", "hot", "a", "b"]), DAY + timedelta(seconds=rng.randrange(40_000)), i, rng.choice([0, 1, 900]), rng.random() > 0.2)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "key string, ts timestamp, id bigint, span_s bigint, ok boolean")
    return df.select("key", "ts", "id", (F.col("span_s") * 1_000_000).alias("span_us"), "ok").cache()


def test_throughput_of_split_files(spark, events):
    got = runs.drain(throughput.throughput_windows(files(spark, events, 4, "ts"), "10 minutes"), "t").collect()
    last = events.agg(F.max(F.unix_micros("ts"))).first()[0] - 600_000_000
    want = {}
    for r in events.collect():
        slot = int(r.ts.timestamp()) // 600
        done, failed = want.get(slot, (0, 0))
        want[slot] = (done + r.ok, failed + (not r.ok))
    assert {r.start_us: (r.completed, r.errors) for r in got} == {
        s * 600_000_000: v for s, v in want.items() if (s + 1) * 600_000_000 <= last
    }


@pytest.mark.parametrize("closed", [True, False])
def test_leaders_of_split_files(spark, events, closed):
    log = events.select("key", "ts", "id", "span_us")
    before = spark.conf.get(runs.STATE_STORE_SETTING)
    with runs.keeping_state(spark):
        made = runs.replayed(log, "ts", 3, {"id": -1, "span_us": 0}, lambda rows: leaders.leader_stream(rows, closed), "leaders")
    assert spark.conf.get(runs.STATE_STORE_SETTING) == before  # the session's own store, whatever it is
    got = {r.id: (r.leader_id, r.is_leader) for r in made.filter("id >= 0").collect()}
    batch = coalesce.leader_scan(log.withColumn("ts_us", F.unix_micros("ts")), closed).collect()
    assert got == {r.id: (r.leader_id, r.is_leader) for r in batch}


def test_leader_stream_names_the_state_store_it_needs(spark, events):
    stream = files(spark, events.select("key", "ts", "id", "span_us"), 1, "ts")
    assert spark.conf.get(runs.STATE_STORE_SETTING) != runs.STATE_STORE
    with pytest.raises(ValueError, match="stateStore"):
        leaders.leader_stream(stream, True)


def test_replay_of_nothing(spark, events):
    log = events.select("key", "ts", "id", "span_us").limit(0)
    with runs.keeping_state(spark):
        made = runs.replayed(log, "ts", 2, {"id": -1, "span_us": 0}, lambda rows: leaders.leader_stream(rows, True), "leaders")
        assert made.count() == 0


def test_leaders_of_shuffled_files_and_what_state_is_left(spark, events):
    """Rows out of order within the watermark's delay: the same leaders as the batch scan, and state of the last row only."""
    log = events.select("key", "ts", "id", "span_us")
    ends = [spark.createDataFrame([("end", DAY + timedelta(days=400 + i), -1, 0)], log.schema) for i in range(2)]
    path = new_path(spark, "shuffled")
    for part in [*(log.filter(F.pmod(F.hash("id"), F.lit(3)) == i) for i in range(3)), *ends]:
        part.coalesce(1).write.mode("append").parquet(path)
    stream = runs.file_stream(spark, path, "*.parquet", log.schema, 1)
    with runs.keeping_state(spark):
        query = (
            leaders.leader_stream(stream, True, delay="2 days").writeStream.format("memory").queryName("led")
            .option("checkpointLocation", new_path(spark, "led-progress")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    batch = coalesce.leader_scan(log.withColumn("ts_us", F.unix_micros("ts")), True).collect()
    made = spark.table("led").filter("id >= 0").collect()
    assert {r.id: (r.leader_id, r.is_leader) for r in made} == {r.id: (r.leader_id, r.is_leader) for r in batch}
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(state) > 100 and state[-1] <= 8, state  # of three hundred rows' keys nothing but the last marker's


class Value:
    """The handle's value state, in memory."""

    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None


class Map:
    def __init__(self):
        self.held, self.read = {}, []

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        self.read.append(key)
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]

    def keys(self):
        return iter(list(self.held))


class Clock:
    def __init__(self):
        self.now_ms, self.timers = 0, set()

    def getCurrentWatermarkInMs(self):
        return self.now_ms

    def registerTimer(self, at):
        self.timers.add(at)


def test_a_timer_reads_and_clears_passed_slots_only(monkeypatch):
    monkeypatch.setattr(leaders, "CHUNK_ROWS", 10)
    rng, clock, state = random.Random(5), Clock(), leaders.LeaderState()
    state.leader, state.slots, state.chunks = Value(), Map(), Map()

    class Handle:
        registerTimer = staticmethod(clock.registerTimer)

    state.handle = Handle
    rows = [(rng.randrange(20 * leaders.SLOT_US), i, rng.choice([0, 1, 3 * leaders.SLOT_US])) for i in range(400)]
    table = pd.DataFrame([(t, i, t + s + 1) for t, i, s in rows], columns=["ts_us", "id", "free_us"])
    for start in range(0, 400, 37):
        assert list(state.handleInputRows(("k",), iter([table[start : start + 37]]), clock)) == []
    assert max(len(v[0]) for v in state.chunks.held.values()) <= 10 * 24
    got = []
    while clock.timers:
        clock.now_ms = max(clock.now_ms, min(clock.timers))
        clock.timers.discard(min(clock.timers))
        state.chunks.read.clear()
        for part in state.handleExpiredTimer(("k",), clock, None):
            got += part[["id", "leader_id"]].values.tolist()
        assert all((slot + 1) * leaders.SLOT_US <= clock.now_ms * 1000 for slot, _ in state.chunks.read)
    assert not state.slots.held and not state.chunks.held and state.leader.held is None
    want, leader = {}, (None, -1)
    for t, i, span in sorted(rows, key=lambda r: (r[0], r[1])):
        if t >= leader[1]:
            leader = (i, t + span + 1)
        want[i] = leader[0]
    assert dict(got) == want


def test_a_sparse_key_waits_in_pages_and_its_rows_leave_on_time(monkeypatch):
    """A row per minute and less: few pages, timers and tables, and no row is held back by the others of its page."""
    monkeypatch.setattr(leaders, "PAGE_ROWS", 16)
    clock, state = Clock(), leaders.LeaderState()
    state.leader, state.slots, state.chunks = Value(), Map(), Map()

    class Handle:
        registerTimer = staticmethod(clock.registerTimer)

    state.handle = Handle
    rows = [(i * 5 * leaders.SLOT_US + i, i, i * 5 * leaders.SLOT_US + i + 1) for i in range(320)]
    table = pd.DataFrame(rows, columns=["ts_us", "id", "free_us"])
    for half in (table[::2], table[1::2]):  # the second one's pages lie between those of the first
        assert list(state.handleInputRows(("k",), iter([half]), clock)) == []
    assert len(state.chunks.held) <= 20 and len(clock.timers) == 1
    clock.now_ms = 1_000 * leaders.SLOT_US // 1_000
    made = list(state.handleExpiredTimer(("k",), clock, None))
    assert len(made) == 1 and made[0]["id"].tolist() == list(range(200)) == made[0]["leader_id"].tolist()
    assert sum(len(v[0]) for v in state.chunks.held.values()) == 24 * 120  # the others wait
    clock.now_ms = 1_001 * leaders.SLOT_US // 1_000
    assert [d["id"].tolist() for d in state.handleExpiredTimer(("k",), clock, None)] == [[200]]
    clock.now_ms *= 10
    assert [i for d in state.handleExpiredTimer(("k",), clock, None) for i in d["id"].tolist()] == list(range(201, 320))
    assert not state.slots.held and not state.chunks.held


def test_vectors_added_by_stream(spark):
    rng = random.Random(2)
    df = spark.createDataFrame(
        [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(80)], "vec_id bigint, embedding array<float>"
    )
    centroids = index.centroid_table(spark.createDataFrame(
        [(c, [rng.gauss(0, 1) for _ in range(6)]) for c in range(5)], "centroid_id bigint, centroid array<double>"))
    made = runs.drain(stream_index.add_stream(files(spark, df, 3, "vec_id"), centroids), "index", "centroid_id")
    batch = index.assign_lists(index.build_flat(df), centroids)
    columns = ["vec_id", "centroid_id", "unit_vec"]
    assert sorted(made.select(columns).collect()) == sorted(batch.select(columns).collect())


def test_texts_embedded_by_stream(spark):
    df = spark.createDataFrame([(i, f"word{i} word{i % 3}") for i in range(30)], "id bigint, t string")
    made = runs.drain(stream_index.embed_stream(files(spark, df, 3, "id"), "t", 8), "embedded")
    batch = embed.embed_hashed(df, "t", 8)
    assert sorted(made.collect()) == sorted(batch.collect())


def test_a_text_is_embedded_once_over_all_batches(spark):
    log = stream_index.VectorLog(spark, new_path(spark, "vectors"), buckets=4)
    calls = spark.sparkContext.accumulator(0)

    def model():
        def run(texts):
            calls.add(len(texts))
            return [[float(len(t or "")), 1.0] for t in texts]

        return run

    def ask(number, *texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
        made = stream_index.embed_once(rows, number, log, "t", lambda new: embed.embed_batch(new, "t", model))
        return sorted((r.id, r.t, tuple(r.embedding)) for r in made.collect())

    first = ask(0, "a", "bb", "bb", None)
    assert first == [(0, "a", (1.0, 1.0)), (1, "bb", (2.0, 1.0)), (2, "bb", (2.0, 1.0)), (3, None, (0.0, 1.0))]
    assert calls.value == 3
    assert ask(1, "bb", "ccc", None, "ccc") == [(0, "bb", (2.0, 1.0)), (1, "ccc", (3.0, 1.0)), (2, None, (0.0, 1.0)), (3, "ccc", (3.0, 1.0))]
    assert calls.value == 4
    assert ask(0, "a", "bb", "bb", None) == first  # repeated: its own folder is written again
    assert ask(2, "ccc", "a") == [(0, "ccc", (3.0, 1.0)), (1, "a", (1.0, 1.0))] and calls.value == 7
    log.forget(1)
    assert ask(3, "a", "ccc") == [(0, "a", (1.0, 1.0)), (1, "ccc", (3.0, 1.0))] and calls.value == 8
    assert ask(4) == []


@pytest.fixture(scope="module")
def corpus(spark):
    texts = spark.createDataFrame([(i, f"topic{i} topic{i % 4} about") for i in range(12)], "vec_id bigint, content string")
    vectors = embed.embed_hashed(texts, "content", 16).select("vec_id", "embedding")
    documents = texts.select("vec_id", embed.document_id(F.col("vec_id")).alias("id"), "content")
    return index.build_flat(vectors), documents


def embed_query(df):
    return embed.embed_hashed(df, "query", 16)


def no_tiers(spark):
    schema = f"key string, value {answers.VALUE_TYPE}, expires_us bigint, created_us bigint"
    return [spark.createDataFrame([], schema)] * 2


def test_answers_by_stream_equal_the_batch(spark, corpus):
    asked = spark.createDataFrame([(i, f"topic{i % 5}", 10) for i in range(20)], "request_id bigint, query string, now_us bigint")
    tiers = no_tiers(spark)

    def work(batch):
        return answers.answer_batch(batch, tiers, answers.flat_search(corpus[0]), corpus[1], 3, embed_query, mock).select("request_id", "answer", "context")

    made = runs.drain_batches(files(spark, asked, 3, "request_id"), "a", work, "request_id bigint, answer string, context string")
    assert sorted(made.collect()) == sorted(work(asked).collect())


def test_answers_are_reused_from_the_table_they_were_stored_in(spark, corpus):
    asked = spark.createDataFrame([(i, f"topic{i % 5}", 10) for i in range(20)], "request_id bigint, query string, now_us bigint")
    first = answers.answer_batch(asked, no_tiers(spark), answers.flat_search(corpus[0]), corpus[1], 3, embed_query)
    stored = results.write_through(no_tiers(spark), results.answer_entries(first, F.col("now_us")), (1, 100))
    later = asked.withColumn("now_us", F.lit(5_000))
    again = {r.request_id: r for r in answers.answer_batch(later, stored, answers.flat_search(corpus[0]), corpus[1], 3, embed_query).collect()}
    once = {r.request_id: r for r in first.collect()}
    assert {r.cache_level for r in again.values()} == {"l2"} and not once[0].cache_hit
    assert all(again[i].answer == once[i].answer == once[i].context and again[i].docs == once[i].docs for i in range(20))


def test_question_without_corpus_gets_the_fallback(spark, corpus):
    asked = spark.createDataFrame([(1, "x", 10)], "request_id bigint, query string, now_us bigint")
    empty = answers.answer_batch(asked, no_tiers(spark), answers.flat_search(corpus[0].limit(0)), corpus[1], 3, embed_query, mock).first()
    assert (empty.context, empty.answer, empty.docs) == ("", "未找到相关信息", [])
