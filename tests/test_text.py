import hashlib
import json
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecquery.functions import keys, text
from vecquery.operators import context, embed, generate


def md5(t):
    return hashlib.md5(t.encode()).hexdigest()


def test_keys(spark):
    df = spark.createDataFrame([("什么是 RAG?", 7)], "q string, k int")
    r = df.select(
        keys.answer_key(F.col("q")).alias("a"), keys.answer_key(F.col("q"), F.col("k")).alias("b"),
        keys.generation_key(F.lit("m"), F.lit("0.0"), F.col("q")).alias("c"), keys.embedding_key(F.col("q")).alias("d"),
        keys.cache_key(F.lit(None).cast("string"), 5).alias("e"),
    ).first()
    q = "什么是 RAG?"
    assert tuple(r) == (md5(f"rag:{q}:10"), md5(f"rag:{q}:7"), md5(f"llm:m:0.0:{q}"), md5(f"emb:{q}"), None)


SPACES = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


@pytest.mark.parametrize("t", ["", "   ", "a b  a", " x" + SPACES + "y\n", "文档 文档\tz"])
def test_words_and_counts_match_python(spark, t):
    df = spark.createDataFrame([(1, t)], "id int, t string")
    assert df.select(text.tokens(F.col("t")).alias("w")).first().w == t.split()
    want = np.zeros(16)
    for w in t.split():
        want[int(md5(w)[:8], 16) % 16] += 1
    assert embed.embed_hashed(df, "t", 16).first().embedding == want.tolist()


def test_missing_text_embeds_to_zeros(spark):
    df = spark.createDataFrame([(1, None)], "id int, t string")
    assert embed.embed_hashed(df, "t", 4).first().embedding == [0.0] * 4


def test_document_ids(spark):
    df = spark.createDataFrame([(0,), (42,), (123456,), (1234567,)], "i bigint")
    got = [r[0] for r in df.select(embed.document_id(F.col("i"))).collect()]
    assert got == [f"doc_{i:06d}" for i in (0, 42, 123456, 1234567)]


def test_model_embedding_keeps_every_row_and_checks_shape(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(23)], "id int, t string")
    made = embed.embed_batch(df, "t", lambda: lambda ts: np.array([[len(t), 1.0] for t in ts]), batch_size=5)
    assert {r.id: r.embedding for r in made.collect()} == {i: [float(i), 1.0] for i in range(23)}
    with pytest.raises(Exception, match="model gave shape"):
        embed.embed_batch(df, "t", lambda: lambda ts: np.zeros((1, 2)), batch_size=5).collect()


def test_copies_are_embedded_once(spark):
    df = spark.createDataFrame([(i, "same" if i % 3 else f"t{i}") for i in range(30)], "id int, t string")
    sizes = []

    def counted(distinct):
        sizes.append(distinct.count())
        return embed.embed_hashed(distinct, "t", 8)

    assert embed.embed_distinct(df, "t", counted).count() == 30
    assert sizes == [11]


def test_three_decimals_round_like_binary_format(spark):
    df = spark.createDataFrame([(i / 10_000,) for i in range(6, 10_001)], "s double")
    got = [r[0] for r in df.select(text.three_decimals(F.col("s"))).collect()]
    assert got == [f"{i / 10_000:.3f}" for i in range(6, 10_001)]


def test_contexts_prompts_and_fallback(spark):
    queries = spark.createDataFrame([(1, "q1"), (2, "q2")], "query_id bigint, query string")
    hits = spark.createDataFrame(
        [(1, 2, "d2", "second", 0.5), (1, 1, "d1", "first\nline", 0.8125)],
        "query_id bigint, rank int, id string, content string, score double",
    )
    made = context.with_contexts(queries, hits).select(
        "query_id", "context", "docs", context.answer_from_context(F.col("context")).alias("answer"),
        context.build_prompt(F.col("context"), F.col("query")).alias("prompt"),
    )
    rows = {r.query_id: r for r in made.collect()}
    body = "[文档 1] (相关度: 0.812)\nfirst\nline\n\n[文档 2] (相关度: 0.500)\nsecond"
    assert rows[1].context == rows[1].answer == body
    assert rows[1].prompt == (
        f"基于以下检索到的文档回答用户问题。\n\n检索到的文档：\n{body}\n\n用户问题：q1\n\n回答："
    )
    assert (rows[2].context, rows[2].docs, rows[2].answer) == ("", [], "未找到相关信息")


def line(content):
    return "data: " + json.dumps({"choices": [{"delta": {"content": content}}]}, ensure_ascii=False)


def test_streams_are_assembled(spark):
    streams = {
        1: [line("Hel"), ": ping", line(""), "data: {bad", 'data: {"choices":[{"delta":{"content":"cut"}}', line("lo 文\n"),
            "data: [DONE]", line("late")],
        2: [line("no "), line("end")],
        3: ["event: x", "data:" + line("x")[6:]],
        4: ['data: {"choices":[]}', 'data: {"choices":[{"delta":{}}]}', "  " + line("ok") + "  "],
        5: ["data: [DONE]", line("late")],
    }
    rows = [(s, i, t) for s, ls in streams.items() for i, t in enumerate(ls)]
    df = spark.createDataFrame(rows, "stream_id bigint, line_no int, line string").repartition(4)
    got = {r.stream_id: r.text for r in generate.assemble_streams(df).collect()}
    assert got == {1: "Hello 文\n", 2: "no end", 3: "", 4: "ok", 5: ""}


def test_chunks(spark):
    df = spark.createDataFrame([(1, " a  b\nc ")], "id int, t string")
    got = [(r.chunk_no, r.chunk) for r in generate.token_chunks(df, "t").collect()]
    assert got == [(0, "a "), (1, "b "), (2, "c ")]


def test_payload_and_reply(spark):
    df = spark.createDataFrame([("hi", None), ("yo", 9)], "p string, n int")
    made = [json.loads(r[0]) for r in df.select(generate.request_payload(F.col("p"), max_tokens=F.col("n"))).collect()]
    assert made[0] == {
        "model": "gpt-3.5-turbo", "messages": [{"role": "user", "content": "hi"}], "temperature": 0.0, "max_tokens": 512,
    }
    assert made[1]["max_tokens"] == 9
    replies = [
        (json.dumps({"choices": [{"message": {"content": "x"}}], "usage": {"total_tokens": 3}}),),
        (json.dumps({"choices": [{"message": {"content": "y"}}]}),), ("{broken",),
    ]
    got = spark.createDataFrame(replies, "r string").select(generate.parse_reply(F.col("r")).alias("r")).select("r.*")
    assert [tuple(r) for r in got.collect()] == [("x", 3), ("y", 0), (None, 0)]


def test_failed_generation_is_a_row_with_an_error(spark):
    def make_model():
        def model(prompts):
            if "bad" in prompts:
                raise RuntimeError("no answer")
            return [p.upper() for p in prompts]
        return model

    df = spark.createDataFrame([(i, "bad" if i == 3 else f"p{i}") for i in range(6)], "id int, p string").coalesce(1)
    got = {r.id: (r.answer, r.error) for r in generate.generate_batch(df, "p", make_model, batch_size=1).collect()}
    assert got[3] == (None, "RuntimeError: no answer") and got[5] == ("P5", None) and len(got) == 6


def test_words_are_counted_in_slices_of_bounded_bytes():
    """A batch of long texts needs memory for a slice of it, and gives the same counts in any slices."""
    made = pa.array(["a b a", "", " \u3000", "c" * 300, "a c", None, "x y z " * 100, "a"]).fill_null("")
    whole = text._counted(made, 16)
    for most in (1, 7, 400, 10**6):
        slices = text.byte_slices(made, most)
        assert [i for start, n in slices for i in range(start, start + n)] == list(range(8))
        assert np.concatenate([text._counted(made.slice(start, n), 16) for start, n in slices]).tolist() == whole.tolist()
    assert text.byte_slices(made.slice(0, 0), 10) == []
    long = pa.array([" ".join(f"w{(i + j) % 997}" for j in range(1_000)) for i in range(3_000)])
    slices = text.byte_slices(long, text.SLICE_BYTES)
    assert max(sum(map(len, long.slice(*s).to_pylist())) for s in slices) < text.SLICE_BYTES + 6_000
    tracemalloc.start()
    for s in slices:
        text._counted(long.slice(*s), 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6  # three million words at once take more


def test_counting_words_needs_few_megabytes_beside_the_batch():
    """Three million words in one batch: what is held at once follows a slice of about a megabyte of text."""
    long = pa.array([" ".join(f"w{(i + j) % 997}" for j in range(1_000)) for i in range(3_000)])
    tracemalloc.start()
    for s in text.byte_slices(long, text.SLICE_BYTES):
        text._counted(long.slice(*s), 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12e6
