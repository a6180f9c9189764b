"""From ranked hits to contexts, prompts and answers without a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecquery.functions.text import three_decimals

# Context header, prompt template and the answer when nothing was found.
HIT_HEADER = ("[文档 ", "] (相关度: ", ")\n")
PROMPT_PARTS = ("基于以下检索到的文档回答用户问题。\n\n检索到的文档：\n", "\n\n用户问题：", "\n\n回答：")
NOTHING_FOUND = "未找到相关信息"


def format_contexts(hits: DataFrame) -> DataFrame:
    """query_id, rank, id, content, score -> query_id, context, docs; at most k rows per query meet."""
    header, middle, end = HIT_HEADER
    doc = F.struct("rank", "id", "content", "score")
    grouped = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(doc)).alias("docs"))

    def part(d: Column) -> Column:
        return F.concat(
            F.lit(header), d["rank"].cast("string"), F.lit(middle), three_decimals(d["score"]), F.lit(end), d["content"]
        )

    return grouped.select(
        "query_id", F.array_join(F.transform("docs", part), "\n\n").alias("context"), "docs"
    )


def build_prompt(context: Column, query: Column) -> Column:
    opening, question, cue = PROMPT_PARTS
    return F.concat(F.lit(opening), context, F.lit(question), query, F.lit(cue))


def answer_from_context(context: Column) -> Column:
    """The context itself, or a fixed text where it is missing or empty."""
    return F.coalesce(F.nullif(context, F.lit("")), F.lit(NOTHING_FOUND))


def with_contexts(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Keep queries without hits: their context is empty, their docs an empty list."""
    made = format_contexts(hits)
    docs_type = made.schema["docs"].dataType
    return queries.join(made, "query_id", "left").withColumns({
        "context": F.coalesce("context", F.lit("")),
        "docs": F.coalesce("docs", F.array().cast(docs_type)),
    })
