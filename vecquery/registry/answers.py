"""Contexts, prompts, generation and whole answers.

Benchmark texts and user turns are the questions, ``documents`` with hashed embeddings the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecquery.functions import keys
from vecquery.functions.text import WHITESPACE, tokens
from vecquery.functions.vectors import unit_vector
from vecquery.operators import context, embed, generate, index, results
from vecquery.plans import answers
from vecquery.registry import search, sql
from vecquery.registry.metrics import LOG, request_log
from vecquery.sources.tables import read_table

DIM = search.DIM
K = 5
NOW_US = 1_706_140_800_000_000
#: What names a turn.
TURN = ("conv_id", "turn")


# ---- inputs -----------------------------------------------------------------------------------

def text_index(spark, folder) -> DataFrame:
    docs = read_table(spark, folder, "documents", "doc_id").select(F.col("doc_id").alias("vec_id"), "text")
    return embed.embed_hashed(docs, "text", DIM).select("vec_id", unit_vector(F.col("embedding")).alias("unit_vec"))


def embed_query(df: DataFrame) -> DataFrame:
    return embed.embed_hashed(df, "query", DIM)


def benchmark_queries(spark, folder) -> DataFrame:
    return read_table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def benchmark_contexts(spark, folder) -> DataFrame:
    return answers.retrieve(
        benchmark_queries(spark, folder), answers.flat_search(text_index(spark, folder)),
        search.documents_for_hits(spark, folder), K, embed_query,
    )


def turns(spark, folder, role: str, spread_by: str | None = None) -> DataFrame:
    talk = read_table(spark, folder, "conversations", spread_by).filter(F.col("role") == role)
    return talk.select(*TURN, "text")


def user_requests(spark, folder) -> DataFrame:
    return turns(spark, folder, "user").select(*TURN, F.col("text").alias("query"), F.lit(NOW_US).alias("now_us"))


def answered_turns(spark, folder) -> list[DataFrame]:
    """Questions with a reply right behind that says more than they do are known; l1 holds expired entries, l2 valid ones.

    Of several replies to one question the one that was given last counts.
    """
    asked = turns(spark, folder, "user")
    reply = turns(spark, folder, "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    value = F.struct(F.lit("").alias("context"), F.col("answer"), F.array().alias("docs")).cast(answers.VALUE_TYPE)
    pairs = asked.join(reply, list(TURN)).filter("length(answer) > length(text)")
    last = pairs.groupBy("text").agg(F.max_by("answer", F.struct(*TURN)).alias("answer"))
    known = last.select(
        keys.cache_key(F.col("text"), K).alias("key"), value.alias("value"),
        F.lit(NOW_US - 30_000_000).alias("created_us"), F.lit(0).alias("ttl_ms"),
    )
    return [results.entries(known, results.L1_TTL_MS), results.entries(known, results.L2_TTL_MS)]


def captured_lines(spark, folder) -> DataFrame:
    """Assistant turns as captured reply lines: noise, one delta per word, an end mark, a late line."""
    def delta(text):
        content = F.to_json(F.struct(F.array(F.struct(F.struct(text.alias("content")).alias("delta"))).alias("choices")))
        return F.concat(F.lit("data: "), content)

    words = F.transform(
        tokens(F.col("text")), lambda w: F.concat(F.lit("\t"), delta(F.concat(w, F.lit(" "))), F.lit("\r\n"))
    )
    lines = F.concat(
        F.array(F.lit(": keep-alive"), F.lit('data: {"choices":[{"delta":{"content":"cut'), delta(F.lit(""))),
        words, F.array(F.lit("\tdata: [DONE] \r\n"), delta(F.lit("late"))),
    )
    return turns(spark, folder, "assistant", "conv_id").select(*TURN, F.posexplode(lines).alias("line_no", "line"))


# ---- queries ----------------------------------------------------------------------------------

def context_format(spark, folder):
    return benchmark_contexts(spark, folder).select("query_id", "context")


def prompt_build(spark, folder):
    prompt = context.build_prompt(F.col("context"), F.col("query"))
    return benchmark_contexts(spark, folder).select("query_id", prompt.alias("prompt"))


def answer_retrieval_only(spark, folder):
    answer = context.answer_from_context(F.col("context"))
    return benchmark_contexts(spark, folder).select("query_id", "query", answer.alias("answer"))


def stand_in(prompts: DataFrame) -> DataFrame:
    """The stand-in model in Python batches, as a caller's model would run."""
    start, end, shown = generate.MOCK_REPLY
    return generate.generate_batch(prompts, "prompt", lambda: lambda batch: [f"{start}{p[:shown]}{end}" for p in batch])


def generate_batch(spark, folder):
    prompts = turns(spark, folder, "user").select(*TURN, F.col("text").alias("prompt"))
    return stand_in(prompts).select(*TURN, "answer", "error")


def llm_payload(spark, folder):
    payload = generate.request_payload(
        F.col("text"), temperature=F.when(F.col("turn") == 0, 0.7),
        max_tokens=F.when(F.length("text") > 500, 1024),
    )
    made = turns(spark, folder, "user").select(*TURN, payload.alias("payload"))
    return made.select(
        *TURN, *[F.get_json_object("payload", f"$.{path}").alias(name) for name, path in (
            ("model", "model"), ("role", "messages[0].role"), ("content", "messages[0].content"),
            ("temperature", "temperature"), ("max_tokens", "max_tokens"))],
    )


def llm_reply_parse(spark, folder):
    """Assistant turns as replies; replies to late turns come without usage."""
    choice = F.struct(F.struct(F.lit("assistant").alias("role"), F.col("text").alias("content")).alias("message"))
    used = F.when(F.col("turn") < 4, F.struct(F.length("text").cast("bigint").alias("total_tokens")))
    reply = F.to_json(F.struct(F.array(choice).alias("choices"), used.alias("usage")))
    made = turns(spark, folder, "assistant").select(*TURN, generate.parse_reply(reply).alias("r"))
    return made.select(*TURN, "r.content", "r.total_tokens")


def stream_assemble(spark, folder):
    return generate.assemble_streams(captured_lines(spark, folder), TURN)


def token_chunks(spark, folder):
    text = generate.mock_stream_text(F.col("text"))
    made = generate.token_chunks(turns(spark, folder, "user").select(*TURN, text.alias("t")), "t")
    return made.withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


def llm_usage(spark, folder):
    return generate.usage(request_log(spark, folder).select(
        F.col("event_type").alias("model"), F.col("k").cast("bigint").alias("tokens"), "latency_ms"))


def user_answers(spark, folder, find=None, use_llm=None) -> DataFrame:
    requests = user_requests(spark, folder)
    if use_llm is not None:
        requests = requests.withColumns({"use_llm": use_llm, "top_k": F.when(F.col("turn") % 4 == 2, 2)})
    return answers.answer_batch(
        requests, answered_turns(spark, folder), find or answers.flat_search(text_index(spark, folder)),
        search.documents_for_hits(spark, folder), K, embed_query, stand_in,
    )


def _shown_answers(made: DataFrame) -> DataFrame:
    return made.select(
        *TURN, "query", "context", "answer", "error", "cache_hit", "cache_level",
        F.array_join(F.transform("docs", lambda d: d["id"]), ",").alias("doc_ids"),
    )


def rag_batch(spark, folder):
    return _shown_answers(user_answers(spark, folder))


def rag_batch_lists(spark, folder):
    """The same over stored inverted lists, read until no other list can hold a better hit, so the answers are the exact ones."""
    docs = read_table(spark, folder, "documents", "doc_id").select(F.col("doc_id").alias("vec_id"), F.col("source").alias("label"), "text")
    flat = embed.embed_hashed(docs, "text", DIM).select("vec_id", "label", unit_vector(F.col("embedding")).alias("unit_vec"))
    numbered = flat.withColumn("label", F.crc32("label"))
    centroids = index.centroid_table(index.group_centroids(numbered))
    lists = index.store_lists(index.assign_lists(flat.drop("label"), centroids))
    return _shown_answers(user_answers(spark, folder, answers.bounded_search(lists, centroids)))


def rag_batch_settings(spark, folder):
    """Requests with settings of their own: every other turn wants no model, some want two documents."""
    return _shown_answers(user_answers(spark, folder, use_llm=F.col("turn") % 4 < 2))


def cache_store(spark, folder):
    """Answers of this run that were not cached, as l2 rows."""
    fresh = user_answers(spark, folder).filter(~F.col("cache_hit"))
    stored = results.upsert(
        answered_turns(spark, folder)[1], results.answer_entries(fresh, F.col("now_us")), results.L2_TTL_MS
    )
    return stored.select("key", "expires_us", "created_us", "value.context", "value.answer",
                         F.size("value.docs").cast("bigint").alias("n_docs"))


def request_ids(spark, folder):
    raw = read_table(spark, folder, "events")
    return raw.select("event_id", keys.request_id(F.col("ts").cast("timestamp"), F.col("event_id")).alias("request_id"))


def response_assemble(spark, folder):
    """User turns' answers, hits and misses; requests of the log with the turns' numbers give the stage times of some."""
    log = request_log(spark, folder).select(
        F.floor(F.col("request_id") / 8).alias("conv_id"), (F.col("request_id") % 8).alias("turn"),
        F.col("latency_ms").alias("embedding_ms"), F.col("k").cast("double").alias("vector_search_ms"),
    )
    made = answers.assemble_responses(user_answers(spark, folder), log, TURN, ["embedding", "vector_search"])
    return made.select(
        *TURN, "answer", F.size("retrieved_docs").cast("bigint").alias("n_docs"),
        F.array_join(F.transform("retrieved_docs", lambda d: d["id"]), ",").alias("doc_ids"),
        F.try_element_at("stages_latency", F.lit("embedding")).alias("embedding_ms"), "total_latency_ms", "cache_hit", "cache_level",
    )


# ---- the same in SQL --------------------------------------------------------------------------

_ID = "conv_id, turn"


def retrieval(queries: str) -> str:
    """CTEs up to ``con(query_id, context, doc_ids, n_docs)`` for ``queries`` (id, text)."""
    return f"""
{sql.hashed('dv', 'SELECT doc_id AS id, text FROM documents')}, {sql.hashed('qv', queries)},
dn AS (SELECT id, v, {sql.norm('v')} AS nn FROM dv), du AS (SELECT id AS vec_id, {sql.unit('v', 'nn')} AS u FROM dn),
qn AS (SELECT id, v, {sql.norm('v')} AS nn FROM qv), qu AS (SELECT id AS query_id, {sql.query_unit('v', 'nn')} AS v FROM qn),
hit AS ({sql.top_k(f"SELECT query_id, vec_id, {sql.dot('u', 'v')} AS d FROM qu CROSS JOIN du", K)}),
con AS (SELECT query_id, count(*) AS n_docs,
  string_agg('[文档 ' || rank || '] (相关度: ' || printf('%.3f', score) || ')' || chr(10) || text, chr(10) || chr(10) ORDER BY rank) AS context,
  string_agg({search._PAD}, ',' ORDER BY rank) AS doc_ids
  FROM hit JOIN documents ON doc_id = vec_id GROUP BY query_id)"""


_BENCH = retrieval("SELECT item_id AS id, text FROM benchmark")
_PROMPT = "'基于以下检索到的文档回答用户问题。' || chr(10) || chr(10) || '检索到的文档：' || chr(10) || context || chr(10) || chr(10) || '用户问题：' || {q} || chr(10) || chr(10) || '回答：'"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{WHITESPACE}'), lambda w: w <> '')"


_TURNS = f"""
u AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
known AS (SELECT u.text, arg_max(a.text, [u.conv_id, u.turn]) AS answer FROM u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' AND length(a.text) > length(u.text) GROUP BY u.text),
miss AS (SELECT DISTINCT text FROM u WHERE text NOT IN (SELECT text FROM known))"""
_ANSWERS = f"{_TURNS}, {retrieval('SELECT text AS id, text FROM miss')}"
_MOCK = f"'[Mock LLM Response for: ' || substr({_PROMPT.format(q='text')}, 1, 50) || '...]'"

_RAG = f"""
WITH {_ANSWERS}
SELECT u.conv_id, u.turn, u.text AS query, coalesce(context, '') AS context,
  CASE WHEN k.text IS NOT NULL THEN k.answer ELSE {_MOCK.replace("|| text ||", "|| u.text ||")} END AS answer,
  NULL::VARCHAR AS error, k.text IS NOT NULL AS cache_hit, CASE WHEN k.text IS NULL THEN 'none' ELSE 'l2' END AS cache_level,
  coalesce(doc_ids, '') AS doc_ids
FROM u LEFT JOIN known k ON k.text = u.text LEFT JOIN con ON query_id = u.text"""

ENTRIES = {
    "context_format": (context_format, f"WITH {_BENCH} SELECT query_id, context FROM con"),
    "prompt_build": (prompt_build, f"""
WITH {_BENCH} SELECT query_id, {_PROMPT.format(q='text')} AS prompt FROM con JOIN benchmark ON item_id = query_id"""),
    "answer_retrieval_only": (answer_retrieval_only, f"""
WITH {_BENCH} SELECT item_id AS query_id, text AS query, coalesce(context, '未找到相关信息') AS answer
FROM benchmark LEFT JOIN con ON item_id = query_id"""),
    "generate_batch": (generate_batch, f"""
SELECT {_ID}, '[Mock LLM Response for: ' || substr(text, 1, 50) || '...]' AS answer, NULL::VARCHAR AS error
FROM conversations WHERE role = 'user'"""),
    "llm_payload": (llm_payload, f"""
SELECT {_ID}, '{generate.DEFAULT_MODEL}' AS model, 'user' AS role, text AS content,
  CASE WHEN turn = 0 THEN '0.7' ELSE '0.0' END AS temperature,
  CASE WHEN length(text) > 500 THEN '1024' ELSE '512' END AS max_tokens
FROM conversations WHERE role = 'user'"""),
    "llm_reply_parse": (llm_reply_parse, f"""
SELECT {_ID}, text AS content, CASE WHEN turn < 4 THEN length(text) ELSE 0 END AS total_tokens
FROM conversations WHERE role = 'assistant'"""),
    "stream_assemble": (stream_assemble, f"""
SELECT {_ID}, array_to_string(list_transform({_words('text')}, lambda w: w || ' '), '') AS text
FROM conversations WHERE role = 'assistant'"""),
    "token_chunks": (token_chunks, f"""
SELECT {_ID}, unnest(range(len(w))) AS chunk_no, unnest(w) || ' ' AS chunk FROM (
  SELECT {_ID}, {_words("'[Mock response for: ' || substr(text, 1, 30) || '...]'")} AS w
  FROM conversations WHERE role = 'user')"""),
    "llm_usage": (llm_usage, f"""
WITH {LOG} SELECT event_type AS model, count(*) AS total_requests, sum(k)::BIGINT AS total_tokens,
  round(avg(latency_ms), 1) AS avg_latency_ms FROM log GROUP BY 1"""),
    "rag_batch": (rag_batch, _RAG),
    "rag_batch_lists": (rag_batch_lists, _RAG),
    "rag_batch_settings": (rag_batch_settings, f"""
WITH {_TURNS}, want AS (SELECT DISTINCT text, turn % 4 < 2 AS llm, CASE WHEN turn % 4 = 2 THEN 2 ELSE {K} END AS n FROM u
  WHERE text NOT IN (SELECT text FROM known) OR turn % 4 = 2),
miss2 AS (SELECT DISTINCT text FROM want), {retrieval('SELECT text AS id, text FROM miss2')},
few AS (SELECT query_id, string_agg('[文档 ' || rank || '] (相关度: ' || printf('%.3f', score) || ')' || chr(10) || text, chr(10) || chr(10) ORDER BY rank) AS context,
  string_agg({search._PAD}, ',' ORDER BY rank) AS doc_ids FROM hit JOIN documents ON doc_id = vec_id WHERE rank <= 2 GROUP BY query_id),
each AS (SELECT u.*, turn % 4 < 2 AS llm, turn % 4 <> 2 AND k.text IS NOT NULL AS cached, k.answer AS known_answer,
  CASE WHEN turn % 4 = 2 THEN f.context ELSE c.context END AS context, CASE WHEN turn % 4 = 2 THEN f.doc_ids ELSE c.doc_ids END AS doc_ids
  FROM u LEFT JOIN known k ON k.text = u.text LEFT JOIN con c ON c.query_id = u.text LEFT JOIN few f ON f.query_id = u.text)
SELECT {_ID}, text AS query, CASE WHEN cached THEN '' ELSE coalesce(context, '') END AS context,
  CASE WHEN cached THEN known_answer WHEN context IS NULL THEN '未找到相关信息' WHEN llm THEN {_MOCK} ELSE context END AS answer,
  NULL::VARCHAR AS error, cached AS cache_hit, CASE WHEN cached THEN 'l2' ELSE 'none' END AS cache_level,
  CASE WHEN cached THEN '' ELSE coalesce(doc_ids, '') END AS doc_ids FROM each"""),
    "cache_store": (cache_store, f"""
WITH {_ANSWERS}
SELECT 'rag:' || text || ':{K}' AS key, {NOW_US} + 60000000 AS expires_us, {NOW_US} AS created_us, context,
  {_MOCK} AS answer, n_docs FROM miss JOIN con ON query_id = text
UNION ALL SELECT 'rag:' || text || ':{K}', {NOW_US} + 30000000, {NOW_US} - 30000000, '', answer, 0 FROM known"""),
    "request_ids": (request_ids, "SELECT event_id, 'req_' || epoch_us(ts) || '_' || event_id AS request_id FROM events"),
    "response_assemble": (response_assemble, f"""
WITH {LOG}, {_ANSWERS}
SELECT u.conv_id, u.turn, CASE WHEN k.text IS NOT NULL THEN k.answer ELSE {_MOCK.replace("|| text ||", "|| u.text ||")} END AS answer,
  coalesce(n_docs, 0) AS n_docs, coalesce(doc_ids, '') AS doc_ids, round(latency_ms, 2) AS embedding_ms,
  coalesce(round(latency_ms + log.k, 2), 0.0) AS total_latency_ms,
  k.text IS NOT NULL AS cache_hit, CASE WHEN k.text IS NULL THEN 'none' ELSE 'l2' END AS cache_level
FROM u LEFT JOIN known k ON k.text = u.text LEFT JOIN con ON query_id = u.text
LEFT JOIN log ON log.request_id // 8 = u.conv_id AND log.request_id % 8 = u.turn"""),
}
