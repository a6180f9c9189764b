"""Queries of this subpackage and the SQL they are checked against, where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecquery.llm import (
    decontaminate,
    edit_embedding,
    hard_negatives,
    html_text,
    line_dedup,
    packing,
    pii,
    quality,
    rollups,
    simhash,
    token_links,
    toxicity,
    url_lists,
)
from vecquery.sources.tables import new_path, read_table, write_stage

WANTED = 0.3


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages", spread_by="page_id")
    text = html_text.text_column(html_text.learn_from(pages)).alias("text")
    return pages.select("page_id", "url", text).withColumn("n_chars", F.length("text").cast("bigint"))


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", spread_by="doc_id")
    model = quality.train(docs, read_table(spark, folder, "labels"), ~quality.held_out())
    scored = quality.score_documents(docs, model)
    return scored.select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= WANTED).cast("int").alias("predicted")
    )


def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents", spread_by="doc_id"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", spread_by="doc_id")
    return pii.find(docs, pii.train_network(docs))


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", spread_by="doc_id")
    found = decontaminate.contamination(docs, read_table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated",
    )


def op6_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edit_embedding.fingerprints(read_table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", spread_by="doc_id").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, folder, "labels"), ~toxicity.held_out())
    scored = docs.select("doc_id", toxicity.score_column(model).alias("score"))
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= WANTED).cast("int").alias("predicted")
    )


def _captures_and_entries(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every page as a capture with a fetch date, and as a dated entry for a key of its own URL on one of five lists.

    The pages carry no dates and no lists, so both come from checksums of the URL.
    """
    crc = F.crc32("url")
    day = lambda number: F.date_add(F.lit("2024-01-01").cast("date"), number.cast("int"))
    captures = pages.select("page_id", "url", day(F.crc32(F.concat(F.lit("fetch "), "url")) % 365).alias("day"))
    keys = url_lists.url_keys(F.col("url"))
    key = F.get(keys, (crc % F.size(keys)).cast("int"))
    entries = pages.filter("url IS NOT NULL").select(
        key.alias("k"),
        F.element_at(
            F.array(*map(F.lit, ("adult", "allow_partners", "malware", "phishing", "spam"))), (F.floor(crc / 7) % 5 + 1).cast("int")
        ).alias("list"),
        day(F.floor(crc / 11) % 365 - 60).alias("day"),
        F.when(F.floor(crc / 13) % 4 == 0, "remove").otherwise("add").alias("action"),
        F.when(F.floor(crc / 17) % 2 == 0, (F.floor(crc / 19) % 90 + 1).cast("int")).alias("days"),
    )
    return captures, entries.select("k.kind", "k.value", "list", "day", "action", "days")


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    captures, entries = _captures_and_entries(read_table(spark, folder, "pages").select("page_id", "url"))
    return url_lists.judge(captures, entries).withColumn("day", F.col("day").cast("string"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Batches over all documents: counts come in, counts with an end token replace them, exact copies leave."""
    docs = read_table(spark, folder, "documents", spread_by="doc_id").select("doc_id", "text", "source", "lang")
    path = public_tokenizers.path
    counted = write_stage(
        docs.select(
            "doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("copy"),
            F.array(
                F.struct(F.lit("word_bpe_49k").alias("tokenizer"), rollups.word_counts(path("word_bpe_49k.json")).alias("n_tokens")),
                F.struct(
                    F.lit("byte_bpe_50k").alias("tokenizer"),
                    rollups.byte_counts(path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).alias("n_tokens"),
                ),
            ).alias("t"),
        ),
        "counted",
    )
    counts = counted.select("doc_id", "source", "lang", "copy", F.explode("t").alias("t")).select(
        "doc_id", "source", "lang", "copy", "t.tokenizer", "t.n_tokens"
    )
    revised = counts.withColumn("new_tokens", F.col("n_tokens") + 1)
    first = counted.groupBy("copy").agg(F.min("doc_id").alias("first_id"))
    copies = revised.join(first, "copy").filter("doc_id > first_id").drop("n_tokens").withColumnRenamed("new_tokens", "n_tokens")
    totals = rollups.Rollup(spark, new_path(spark, "rollup"))
    totals.commit(1, rollups.inserts(counts))
    totals.commit(2, rollups.revisions(revised))
    totals.commit(2, rollups.revisions(revised))  # delivered twice, counted once
    totals.compact()
    totals.commit(3, rollups.deletes(copies))
    return totals.totals()


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents", spread_by="doc_id")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(read_table(spark, folder, "documents", spread_by="doc_id").select("doc_id", "text"))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path
    docs = read_table(spark, folder, "documents", spread_by="doc_id")
    return token_links.align(docs, path("byte_bpe_50k.json"), public_tokenizers.PATTERN, path("piece_bpe_32k.model"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(read_table(spark, folder, "embeddings"))


_SQL_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP5_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s, w
      FROM b WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, n, list_slice(w, s, s + n - 1) AS gram FROM g),
p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n),
m AS (SELECT p.doc_id, p.s, p.n, q.item_id FROM p JOIN q ON q.n = p.n AND q.gram = list_slice(p.w, p.s, p.s + p.n - 1)),
h AS (SELECT doc_id, count(DISTINCT place) AS n_hit
      FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM (SELECT DISTINCT doc_id, s, n FROM m)) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

def _sql_keys(url: str) -> str:
    """The keys of a URL as a list of structs, in the order of ``url_lists.url_keys``."""
    name = f"regexp_extract(lower({url}), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)"
    path = f"regexp_extract({url}, '^[a-z][a-z0-9+.-]*://[^/?#]*(/[^/?#]*)', 1)"
    labels = f"string_split({name}, '.')"
    return f"""list_concat(list_concat([{{'kind': 'url', 'value': {url}}}],
      CASE WHEN {name} <> '' THEN [{{'kind': 'host', 'value': {name}}}, {{'kind': 'prefix', 'value': {name} || {path}}}] ELSE [] END),
      CASE WHEN len({labels}) >= 2 THEN list_transform(range(2, len({labels}) + 1),
        lambda n: {{'kind': 'domain', 'value': array_to_string(list_slice({labels}, len({labels}) - n + 1, len({labels})), '.')}}) ELSE [] END)"""


OP8_SQL = f"""
WITH RECURSIVE bits AS (SELECT i, 0 AS step, i AS c FROM range(256) t(i)
  UNION ALL SELECT i, step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
crcs AS (SELECT u, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(u) + 1), lambda k:
    ('0x' || substr(hex(encode(u)), (2 * k - 1)::INT, 2))::BIGINT)),
    lambda a, b: xor(a // 256, t[(xor(a % 256, b) + 1)::INT])), 4294967295) AS crc
  FROM (SELECT DISTINCT url AS u FROM pages WHERE url IS NOT NULL UNION SELECT DISTINCT 'fetch ' || url FROM pages WHERE url IS NOT NULL), crc_table),
captures AS (SELECT page_id, url, DATE '2024-01-01' + (crc % 365)::INT AS day FROM pages LEFT JOIN crcs ON u = 'fetch ' || url),
keyed AS (SELECT url, crc, {_sql_keys('url')} AS k FROM pages JOIN crcs ON u = url),
entries AS (SELECT k[(crc % len(k) + 1)::INT].kind AS kind, k[(crc % len(k) + 1)::INT].value AS value,
    ['adult', 'allow_partners', 'malware', 'phishing', 'spam'][(crc // 7 % 5 + 1)::INT] AS list,
    DATE '2024-01-01' + (crc // 11 % 365 - 60)::INT AS day, crc // 13 % 4 = 0 AS off,
    CASE WHEN crc // 17 % 2 = 0 THEN (crc // 19 % 90 + 1)::INT END AS days FROM keyed),
daily AS (SELECT kind, value, list, day, bool_or(off) AS off, max(CASE WHEN NOT off THEN coalesce(days, 2000000) END) AS term
  FROM entries GROUP BY ALL),
spans AS (SELECT *, min(CASE WHEN off THEN day END) OVER (PARTITION BY kind, value, list ORDER BY day
  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS taken_off FROM daily),
valid AS (SELECT kind, value, list, day AS valid_from,
    least(CASE WHEN term < 2000000 THEN day + term::INT END, taken_off) AS valid_to FROM spans WHERE NOT off),
asked AS (SELECT DISTINCT c.url, c.day, unnest(k) AS k FROM captures c JOIN keyed USING (url)),
found AS (SELECT a.url, a.day, list_sort(list(DISTINCT v.list)) AS names FROM asked a
  JOIN valid v ON v.kind = a.k.kind AND v.value = a.k.value AND v.valid_from <= a.day AND (v.valid_to IS NULL OR a.day < v.valid_to)
  GROUP BY ALL)
SELECT page_id, url, c.day::DATE::VARCHAR AS day, coalesce(len(names), 0)::BIGINT AS n_lists, coalesce(array_to_string(names, ','), '') AS lists,
  coalesce(len(names) > 0 AND NOT list_contains(names, 'allow_partners'), false) AS blocked
FROM captures c LEFT JOIN found USING (url, day)
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT key, doc_id FROM k WHERE length(key) >= 40)
  GROUP BY key HAVING count(*) >= 5),
m AS (SELECT k.*, f.key IS NOT NULL AND doc_id IS DISTINCT FROM last AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP13_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS (SELECT * FROM r WHERE vec_id % 100 = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS alike,
    list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score FROM a, r WHERE a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER w <= 10
"""

ENTRIES = {
    "op1_html_extraction": (op1_html_extraction, None),
    "op2_quality_classifier": (op2_quality_classifier, None),
    "op3_simhash_near_dedup": (op3_simhash_near_dedup, None),
    "op4_pii": (op4_pii, None),
    "op5_benchmark_decontamination": (op5_benchmark_decontamination, OP5_SQL),
    "op6_document_fingerprints": (op6_document_fingerprints, None),
    "op7_toxicity": (op7_toxicity, None),
    "op8_url_filters": (op8_url_filters, OP8_SQL),
    "op9_token_counts": (op9_token_counts, None),
    "op10_best_fit_packing": (op10_best_fit_packing, None),
    "op11_line_dedup": (op11_line_dedup, OP11_SQL),
    "op12_cross_tokenizer_alignment": (op12_cross_tokenizer_alignment, None),
    "op13_hard_negatives": (op13_hard_negatives, OP13_SQL),
}
