import os

import pytest
from pyspark.sql import functions as F

from vecquery.operators import embed, generate, index, results
from vecquery.operators.tier_store import TierStore, leveled
from vecquery.plans import answers
from vecquery.sources.tables import new_path, passing_tables, write_stage

ROW = "level string, key string, value string, expires_us bigint, created_us bigint"


@pytest.fixture
def store(spark):
    made = TierStore(spark, new_path(spark, "store"), "string", 8)
    made.put(0, spark.createDataFrame([("l1", f"k{i}", f"v{i}", 1_000 + i, 5) for i in range(40)] + [("l2", f"k{i}", f"v{i}", 0, 5) for i in range(40)], ROW))
    return made


def content(df):
    return {(r.level, r.key): (r.value, r.expires_us) for r in df.collect()}


def test_upsert_reads_and_writes_touched_buckets_only(spark, store):
    before = store.manifest()
    keys = spark.createDataFrame([("k3",)], "key string")
    (bucket,) = store.buckets_of(keys)
    every = set(store.rows().inputFiles())
    touched = set(store.rows(buckets=[bucket]).inputFiles())
    assert 0 < len(touched) < len(every) / 2
    new = spark.createDataFrame([("k3", "new", 50, 0), ("k3", "newer", 60, 7)], "key string, value string, created_us bigint, ttl_ms bigint")
    after = store.upsert(1, new, (1, 0))
    assert {b for b in range(8) if before.folders.get(b) != after.folders.get(b)} == {bucket}
    got = content(store.rows())
    assert got["l1", "k3"] == got["l2", "k3"] == ("newer", 60 + 7_000)
    assert len(got) == 80 and got["l1", "k4"] == ("v4", 1_004)
    assert content(store.rows(before))["l1", "k3"] == ("v3", 1_003)  # the older state is still there


def test_a_repeated_commit_changes_nothing(spark, store):
    new = spark.createDataFrame([("l1", "k1", "again", 9, 9)], ROW)
    first = store.put(1, new)
    assert store.put(1, spark.createDataFrame([("l1", "k1", "other", 9, 99)], ROW)) == first
    assert content(store.rows())["l1", "k1"] == ("again", 9)
    with pytest.raises(ValueError):
        store.put(-5, new)


def test_a_commit_that_dies_leaves_the_old_state(spark, store, monkeypatch):
    state = store.manifest()
    monkeypatch.setattr("vecquery.operators.tier_store.Manifest.text", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.put(1, spark.createDataFrame([("l1", "k1", "half", 9, 9)], ROW))
    monkeypatch.undo()
    assert store.manifest() == state and content(store.rows())["l1", "k1"] == ("v1", 1_001)
    again = TierStore(spark, store.path, "string", 8)  # opened anew, after a restart say
    assert content(again.rows()) == content(store.rows())


def test_delete_and_expiry(spark, store):
    store.delete(1, spark.createDataFrame([("k1",), ("k2",), ("unknown",), (None,)], "key string"))
    assert {k for _, k in content(store.rows())} == {f"k{i}" for i in range(40)} - {"k1", "k2"}
    state = store.manifest()
    assert store.clean_expired(2, 500).folders == state.folders  # nothing expires that early: no bucket is read
    late = store.clean_expired(3, 1_010)
    held = content(store.rows())
    assert {k for level, k in held if level == "l1"} == {f"k{i}" for i in range(10, 40)}
    assert sum(level == "l2" for level, _ in held) == 38
    assert late.folders != state.folders
    store.delete(4, spark.createDataFrame([(f"k{i}",) for i in range(40)], "key string"))
    assert store.rows().count() == 0 and store.manifest().folders == {}


def test_vacuum_keeps_what_the_last_states_name(spark, store):
    for i in range(1, 4):
        store.put(i, spark.createDataFrame([("l1", "k1", f"x{i}", 9, 9 + i)], ROW))
    want, older = content(store.rows()), content(store.rows(store.manifest(before=3)))
    store.vacuum(keep=2)
    assert content(store.rows()) == want and content(store.rows(store.manifest(before=3))) == older
    assert store.manifest(before=2).number == -1


def test_an_empty_store(spark):
    none = TierStore(spark, new_path(spark, "none"), "string")
    assert none.rows().count() == 0 and none.manifest().number == -1
    none.vacuum()
    assert none.put(0, none.rows()).folders == {}


def embed_query(df):
    return embed.embed_hashed(df, "query", 16)


def mock(prompts):
    return prompts.withColumns({"answer": generate.mock_reply(F.col("prompt")), "error": F.lit(None).cast("string")})


def test_later_batches_find_the_answers_of_earlier_ones(spark):
    texts = spark.createDataFrame([(i, f"topic{i} topic{i % 4} about") for i in range(12)], "vec_id bigint, content string")
    vectors = index.build_flat(embed.embed_hashed(texts, "content", 16).select("vec_id", "embedding"))
    documents = texts.select("vec_id", embed.document_id(F.col("vec_id")).alias("id"), "content")
    store = TierStore(spark, new_path(spark, "answers"), answers.VALUE_TYPE, 4)
    how = {"find": answers.flat_search(vectors), "documents": documents, "k": 3, "embed": embed_query, "generate": mock}

    def ask(number, now_us, *topics):
        rows = spark.createDataFrame([(i, t, now_us) for i, t in enumerate(topics)], "request_id bigint, query string, now_us bigint")
        made = answers.answer_and_store(rows, number, store, (1, 100), "answered", **how)
        return {r.query: (r.cache_hit, r.cache_level, r.answer) for r in made.collect()}

    first = ask(0, 10, "topic1", "topic2", None)
    assert not first["topic1"][0] and len(content(store.rows())) == 4
    assert ask(0, 10, "topic1", "topic2", None) == first  # retried: same answers, same store
    assert store.manifest().number == 0
    second = ask(1, 20, "topic1", "topic3")
    assert second["topic1"] == (True, "l1", first["topic1"][2]) and not second["topic3"][0]
    third = ask(2, 5_000, "topic1")  # l1 has expired, l2 has not: the answer goes up again
    assert third["topic1"][:2] == (True, "l2")
    assert content(store.rows())["l1", "rag:topic1:3"][1] == 5_000 + 1_000
    assert content(store.rows())["l2", "rag:topic1:3"][1] == 10 + 100_000


def test_passing_tables_are_removed(spark):
    rows = spark.createDataFrame([("l1", "k", "v", 0, 1)], ROW)
    stay = write_stage(rows, "stay")
    with passing_tables(spark):
        gone = write_stage(rows, "gone")
        copied = write_stage(gone, "gone")
        assert copied.count() == 1
        with passing_tables(spark):
            assert write_stage(rows, "inner").count() == 1
        assert copied.count() == 1
    paths = {df.inputFiles()[0].removeprefix("file://") for df in (stay, gone, copied)}
    assert [os.path.exists(p) for p in sorted(paths, key=lambda p: "/stay-" in p)] == [False, False, True]
    with pytest.raises(ZeroDivisionError), passing_tables(spark):
        gone = write_stage(rows, "gone")
        1 / 0
    assert not os.path.exists(gone.inputFiles()[0].removeprefix("file://"))


def test_answers_of_one_instant_are_told_apart(spark):
    doc = "array<struct<rank:int,id:string,content:string,score:double>>"
    rows = spark.createDataFrame([("k", "c", "with", []), ("k", "c", "without", [])], f"key string, context string, answer string, docs {doc}")
    picked = {results.answer_entries(rows.orderBy(F.desc("answer") if i else "answer"), F.lit(5)).first().value.answer for i in (0, 1)}
    assert len(picked) == 1
    assert leveled([rows.limit(0)]).count() == 0
