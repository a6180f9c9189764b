"""The answer plan: many turns, settings per request, failing models, any index; more lists than may be sent."""

import random

import pytest
from pyspark.sql import functions as F

from vecquery.operators import embed, generate, index, search
from vecquery.plans import answers


def embed_query(df):
    return embed.embed_hashed(df, "query", 32)


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.createDataFrame([(i, f"doc_{i:06d}", f"word{i} word{i % 5} common") for i in range(60)], "vec_id bigint, id string, content string")
    return index.build_flat(embed.embed_hashed(docs, "content", 32).select("vec_id", "embedding")), docs


@pytest.fixture(scope="module")
def tiers(spark):
    entry = spark.createDataFrame(
        [("rag:known:3", ("", "told before", []), 0, 5)], f"key string, value {answers.VALUE_TYPE}, expires_us bigint, created_us bigint"
    )
    return [entry.limit(0), entry]


def mock(prompts):
    return prompts.withColumns({"answer": generate.mock_reply(F.col("prompt")), "error": F.lit(None).cast("string")})


def test_turns_from_a_thousand_on_stay_apart(spark, corpus, tiers):
    asked = spark.createDataFrame([(1, 1_000, "word1"), (2, 0, "word2"), (1, 5, "word1")], "conv_id bigint, turn bigint, query string")
    made = answers.answer_batch(asked.withColumn("now_us", F.lit(9)), tiers, answers.flat_search(corpus[0]), corpus[1], 3, embed_query)
    got = {(r["conv_id"], r["turn"]): r["context"] for r in made.collect()}
    assert len(got) == 3 and got[1, 1_000] == got[1, 5] != got[2, 0]
    lines = spark.createDataFrame([(1, 1_000, 0, 'data: {"choices":[{"delta":{"content":"a"}}]}'), (2, 0, 0, 'data: {"choices":[{"delta":{"content":"b"}}]}')], "conv_id bigint, turn bigint, line_no int, line string")
    assert {tuple(r) for r in generate.assemble_streams(lines, ("conv_id", "turn")).collect()} == {(1, 1_000, "a"), (2, 0, "b")}


def test_settings_and_errors(spark, corpus, tiers):
    rows = [(1, "known", None, None), (2, "known", 2, False), (3, "word7 common", 1, True), (4, "word7 common", 1, False), (5, None, None, None), (6, "word9", None, True)]
    asked = spark.createDataFrame(rows, "id int, query string, top_k int, use_llm boolean").withColumn("now_us", F.lit(9))

    def failing(prompts):
        def model(batch):
            if any("word9" in p for p in batch):
                raise ValueError("no")
            return [f"said {len(p)}" for p in batch]

        return generate.generate_batch(prompts, "prompt", lambda: model, batch_size=1)

    made = answers.answer_batch(asked, tiers, answers.flat_search(corpus[0]), corpus[1], 3, embed_query, failing)
    got = {r["id"]: r for r in made.collect()}
    assert len(got) == 6
    assert (got[1]["answer"], got[1]["cache_hit"], got[1]["cache_level"]) == ("told before", True, "l2")
    assert not got[2]["cache_hit"] and len(got[2]["docs"]) == 2 and got[2]["answer"] == got[2]["context"]
    assert got[3]["answer"].startswith("said ") and len(got[3]["docs"]) == 1
    assert got[4]["answer"] == got[4]["context"] == got[3]["context"]
    assert (got[5]["answer"], got[5]["docs"]) == ("未找到相关信息", [])
    assert got[6]["answer"] is None and "no" in got[6]["error"]
    times = spark.createDataFrame([(1, 1.234, None), (3, 2.0, 3.0)], "id int, a_ms double, b_ms double")
    rows = {r["id"]: r for r in answers.assemble_responses(made, times, ["id"], ["a", "b"]).collect()}
    assert len(rows) == 6 and rows[1]["stages_latency"] == {"a": 1.23} and rows[3]["total_latency_ms"] == 5.0
    assert not rows[4]["stages_latency"] and rows[1]["cache_hit"] and rows[6]["error"]


@pytest.mark.parametrize("most", [65_536, 3])
def test_lists_beyond_the_sendable_number(spark, monkeypatch, corpus, most):
    monkeypatch.setattr(index, "MAX_LISTS", most)
    rng = random.Random(1)
    centroids = index.centroid_table(spark.createDataFrame([(c, [rng.gauss(0, 1) for _ in range(32)]) for c in range(8)], "centroid_id bigint, centroid array<double>"))
    lists = index.assign_lists(corpus[0], centroids)
    want = {}
    points = {r["id"]: list(r["vec"]) for r in (centroids.to_pylist() if most > 8 else [r.asDict() for r in centroids.collect()])}
    for r in lists.collect():
        dots = {c: sum(a * b for a, b in zip(r["unit_vec"], v)) for c, v in points.items()}
        want[r["vec_id"]] = r["centroid_id"]
        assert dots[r["centroid_id"]] >= max(dots.values()) - 1e-9
    asked = spark.createDataFrame([(1, "word3 common"), (2, "word4")], "query_id bigint, query string").withColumn("now_us", F.lit(9))
    exact = answers.retrieve(asked, answers.flat_search(corpus[0]), corpus[1], 4, embed_query)
    probed = answers.retrieve(asked, answers.list_search(lists, centroids, 8), corpus[1], 4, embed_query)
    assert sorted(r["context"] for r in exact.collect()) == sorted(r["context"] for r in probed.collect())


def test_reply_lines_with_real_line_ends(spark):
    def line(text):
        return 'data: {"choices":[{"delta":{"content":"%s"}}]}' % text

    rows = [(1, 0, f"\t{line('a')}\r\n"), (1, 1, "data: [DONE]\r\n"), (1, 2, line("LATE") + "\r\n"), (2, 0, " " + line("b ")), (3, 0, "noise")]
    got = generate.assemble_streams(spark.createDataFrame(rows, "stream_id int, line_no int, line string")).collect()
    assert {tuple(r) for r in got} == {(1, "a"), (2, "b "), (3, "")}
