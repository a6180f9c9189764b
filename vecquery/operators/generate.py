"""Text generation over prompt tables: calling a model, request and reply JSON, streamed replies."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecquery.functions.text import WHITESPACE, tokens

# Service defaults and the stand-in reply texts.
DEFAULT_MODEL = "gpt-3.5-turbo"
DEFAULT_TEMPERATURE = 0.0
DEFAULT_MAX_TOKENS = 512
MOCK_REPLY = ("[Mock LLM Response for: ", "...]", 50)
MOCK_STREAM = ("[Mock response for: ", "...]", 30)

REPLY_SCHEMA = (
    "choices array<struct<message:struct<role:string,content:string>>>, usage struct<total_tokens:bigint>"
)
DELTA_SCHEMA = "choices array<struct<delta:struct<content:string>>>"


def mock_reply(prompt: Column) -> Column:
    start, end, shown = MOCK_REPLY
    return F.concat(F.lit(start), F.substring(prompt, 1, shown), F.lit(end))


def mock_stream_text(prompt: Column) -> Column:
    start, end, shown = MOCK_STREAM
    return F.concat(F.lit(start), F.substring(prompt, 1, shown), F.lit(end))


def generate_batch(
    df: DataFrame,
    prompt: str,
    make_model: Callable[[], Callable[[list[str]], list[str]]],
    batch_size: int = 8,
    out: str = "answer",
) -> DataFrame:
    """Call a model on batches of prompts; a failed batch gives rows with ``error`` set, none is lost."""
    schema = T.StructType(
        [*df.schema.fields, T.StructField(out, T.StringType()), T.StructField("error", T.StringType())]
    )
    at = df.columns.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make_model()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                part = batch.slice(start, batch_size)
                try:
                    texts = list(model(part.column(at).to_pylist()))
                    if len(texts) != part.num_rows:
                        raise ValueError(f"model gave {len(texts)} texts for {part.num_rows} prompts")
                    problem = None
                except Exception as error:  # becomes data: counted as a failed request
                    texts, problem = [None] * part.num_rows, f"{type(error).__name__}: {error}"
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string()), pa.array([problem] * part.num_rows, pa.string())],
                    names=[*batch.schema.names, out, "error"],
                )

    return df.mapInArrow(run, schema)


def request_payload(
    prompt: Column, model: Column | None = None, temperature: Column | None = None, max_tokens: Column | None = None
) -> Column:
    """Request JSON; a null override means the default."""
    def or_default(given: Column | None, default) -> Column:
        return F.lit(default) if given is None else F.coalesce(given, F.lit(default))

    message = F.struct(F.lit("user").alias("role"), prompt.alias("content"))
    return F.to_json(F.struct(
        or_default(model, DEFAULT_MODEL).alias("model"),
        F.array(message).alias("messages"),
        or_default(temperature, DEFAULT_TEMPERATURE).alias("temperature"),
        or_default(max_tokens, DEFAULT_MAX_TOKENS).alias("max_tokens"),
    ))


def parse_reply(reply: Column) -> Column:
    """struct<content, total_tokens>; a reply without usage counts 0 tokens."""
    parsed = F.from_json(reply, REPLY_SCHEMA)
    return F.struct(
        F.get(parsed["choices"], F.lit(0))["message"]["content"].alias("content"),
        F.coalesce(parsed["usage"]["total_tokens"], F.lit(0)).alias("total_tokens"),
    )


def assemble_streams(lines: DataFrame, ids: Sequence[str] = ("stream_id",)) -> DataFrame:
    """The id columns, line_no, line -> the id columns, text.

    Only ``data: `` lines count, up to the first ``[DONE]``, white space around a line aside; bad JSON and empty deltas are
    skipped. Bare deltas before the end are grouped, so a group is as large as the text it becomes.
    """
    clean = F.regexp_replace("line", f"^{WHITESPACE}|{WHITESPACE}$", "")
    body = F.substring(F.col("clean"), 7, 2**31 - 1)
    delta = F.get(F.from_json(body, DELTA_SCHEMA)["choices"], F.lit(0))["delta"]["content"]
    data = lines.select(*ids, "line_no", clean.alias("clean")).filter(F.col("clean").startswith("data: "))
    data = data.select(*ids, "line_no", (F.trim(body) == "[DONE]").alias("done"), delta.alias("delta"))
    ends = data.filter("done").groupBy(*ids).agg(F.min("line_no").alias("end"))
    told = data.filter("delta <> ''").join(ends, list(ids), "left").filter("end IS NULL OR line_no < end")
    grouped = told.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct("line_no", "delta"))).alias("deltas"))
    text = F.array_join(F.transform("deltas", lambda d: d["delta"]), "")
    return lines.select(*ids).distinct().join(grouped.select(*ids, text.alias("text")), list(ids), "left").select(
        *ids, F.coalesce("text", F.lit("")).alias("text")
    )


def token_chunks(df: DataFrame, text: str) -> DataFrame:
    """One row per word in order, each with a trailing blank."""
    others = [c for c in df.columns if c != text]
    words = F.transform(tokens(F.col(text)), lambda w: F.concat(w, F.lit(" ")))
    return df.select(*others, F.posexplode(words).alias("chunk_no", "chunk"))


def usage(log: DataFrame) -> DataFrame:
    """model, tokens, latency_ms -> requests, tokens and mean latency per model."""
    return log.groupBy("model").agg(
        F.count("*").alias("total_requests"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.round(F.avg("latency_ms"), 1), F.lit(0.0)).alias("avg_latency_ms"),
    )
