"""Corpus, keys, embeddings, indexes and search."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecquery.functions import keys, vectors
from vecquery.operators import embed, graph, index, probing, search
from vecquery.registry import sql
from vecquery.sources.tables import read_table

DIM = 64
MODEL = "gpt-3.5-turbo"  # fixed value: default model name
#: Of ten label lists; recall@5 is 0.95 at both scales. Half of the trained lists give 0.93 and more.
NPROBE, TRAINED, TRAINED_PROBED = 8, 64, 0.5
#: Two bands of 32 buckets of which the nearest 18 are read: recall@5 is 0.94 and more.
BANDS, BITS, PROBES = 2, 5, 18
LEAST_RECALL = 0.9


# ---- inputs -----------------------------------------------------------------------------------

def user_turns(spark: SparkSession, folder: str) -> DataFrame:
    talk = read_table(spark, folder, "conversations")
    return talk.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("query"))


def stored(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "embeddings")
    return table.select("vec_id", "label", vectors.unit_vector(F.col("embedding")).alias("unit_vec"))


def vector_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector of the table asks for its neighbours."""
    table = read_table(spark, folder, "embeddings")
    return table.select(
        F.col("vec_id").alias("query_id"), vectors.unit_query(F.col("embedding")).alias("vec")
    )


def documents_for_hits(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").select(
        F.col("doc_id").alias("vec_id"), embed.document_id(F.col("doc_id")).alias("id"),
        F.col("text").alias("content"),
    )


def metadata_for_hits(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata from the labels; not every document has some."""
    return read_table(spark, folder, "labels").select(
        F.col("doc_id").alias("vec_id"),
        F.create_map(
            F.lit("quality"), F.col("quality").cast("string"), F.lit("toxic"), F.col("toxic").cast("string")
        ).alias("metadata"),
    )


def label_centroids(spark: SparkSession, folder: str):
    return index.centroid_table(index.group_centroids(stored(spark, folder)))


def elements(df: DataFrame, id_col: str, vec: str, digits: int = 6) -> DataFrame:
    """One row per vector element, rounded for comparing.

    The outer form: the inner one infers a filter on the vector's size, which would run a UDF behind
    ``vec`` once more.
    """
    return df.select(id_col, F.posexplode_outer(vec).alias("dim", "x")).select(
        id_col, F.col("dim").cast("bigint").alias("dim"), F.round(F.col("x").cast("double"), digits).alias("value")
    )


# ---- queries ----------------------------------------------------------------------------------

def corpus_build(spark, folder):
    made = embed.build_corpus(read_table(spark, folder, "documents"), "doc_id", "text", "source", "lang")
    return made.select("id", "content", "metadata.topic", "metadata.type",
                       F.col("metadata.length").cast("bigint").alias("length"))


def key_rag(spark, folder):
    return user_turns(spark, folder).select("conv_id", "turn", keys.answer_key(F.col("query")).alias("key"))


def key_llm(spark, folder):
    key = keys.generation_key(F.lit(MODEL), F.lit("0.0"), F.col("query"))
    return user_turns(spark, folder).select("conv_id", "turn", key.alias("key"))


def key_embedding(spark, folder):
    return read_table(spark, folder, "documents").select("doc_id", keys.embedding_key(F.col("text")).alias("key"))


def cache_key_raw(spark, folder):
    return user_turns(spark, folder).select("conv_id", "turn", keys.cache_key(F.col("query"), 5).alias("key"))


def embed_batch(spark, folder):
    docs = read_table(spark, folder, "documents", "doc_id").select("doc_id", "text")
    return elements(embed.embed_hashed(docs, "text", DIM), "doc_id", "embedding")


def embed_batch_model(spark, folder):
    """The same counts from a Python model called on batches of texts, as a caller's model would be."""
    def make_model():
        seen = {}

        def bucket(word):
            if word not in seen:
                seen[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % DIM
            return seen[word]

        return lambda texts: np.array(
            [np.bincount([bucket(w) for w in t.split()], minlength=DIM) for t in texts], dtype=np.float32
        )

    docs = read_table(spark, folder, "documents", "doc_id").select("doc_id", "text")
    return elements(embed.embed_batch(docs, "text", make_model), "doc_id", "embedding")


def embed_dedup(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    made = embed.embed_distinct(docs, "text", lambda d: embed.embed_hashed(d, "text", DIM))
    return elements(made, "doc_id", "embedding")


def l2_normalize(spark, folder):
    return elements(stored(spark, folder), "vec_id", "unit_vec")


def normalize_query(spark, folder):
    texts = read_table(spark, folder, "benchmark").select("item_id", "text")
    made = embed.embed_hashed(texts, "text", DIM)
    return elements(made.select("item_id", vectors.unit_query(F.col("embedding")).alias("v")), "item_id", "v")


def index_build_flat(spark, folder):
    flat = index.build_flat(read_table(spark, folder, "embeddings"))
    texts = documents_for_hits(spark, folder).select("vec_id", "id", F.length("content").cast("bigint").alias("length"))
    both = flat.join(texts, "vec_id")
    return both.select("vec_id", "id", "length", F.posexplode("unit_vec").alias("dim", "x")).select(
        "vec_id", "id", "length", F.col("dim").cast("bigint").alias("dim"),
        F.round(F.col("x").cast("double"), 6).alias("value"),
    )


def _shown(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", F.col("rank").cast("bigint").alias("rank"), "vec_id", "score")


def exact_hits(spark, folder, k):
    return search.search_exact(stored(spark, folder), vector_queries(spark, folder), k)


def knn_exact(spark, folder):
    return _shown(exact_hits(spark, folder, 10))


def score_map(spark, folder):
    table = read_table(spark, folder, "embeddings").select("vec_id", F.posexplode("embedding").alias("dim", "x"))
    return table.select("vec_id", F.col("dim").cast("bigint").alias("dim"),
                        vectors.relevance(F.col("x").cast("double")).alias("score"))


def knn_with_docs(spark, folder):
    hits = search.attach_documents(exact_hits(spark, folder, 5), documents_for_hits(spark, folder))
    return hits.select("query_id", F.col("rank").cast("bigint").alias("rank"), "id", "content", "score", "index")


def knn_metadata(spark, folder):
    hits = search.attach_documents(
        exact_hits(spark, folder, 5), documents_for_hits(spark, folder), metadata_for_hits(spark, folder)
    )
    return hits.select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "id",
        F.size("metadata").cast("bigint").alias("n_metadata"),
        F.try_element_at("metadata", F.lit("quality")).alias("quality"),
    )


def ivf_train(spark, folder):
    """What holds for any trained lists: their number and dimension, and that every vector is in one of them."""
    flat = stored(spark, folder).drop("label")
    trained = index.train_centroids(flat, nlist=512)
    sizes = index.list_sizes(index.assign_lists(flat, index.centroid_table(trained)))
    held = sizes.join(trained, "centroid_id").agg(F.coalesce(F.sum("n_vectors"), F.lit(0)))
    return trained.agg(
        F.count("*").alias("n_lists"), F.max(F.size("centroid")).cast("bigint").alias("dimension")
    ).withColumn("n_vectors", held.scalar())


def _trained(spark, folder):
    flat = stored(spark, folder).drop("label")
    centroids = index.centroid_table(index.train_centroids(flat, nlist=TRAINED))
    return centroids, index.store_lists(index.assign_lists(flat, centroids))


def _enough(hits: DataFrame, truth: DataFrame, share_read: float) -> DataFrame:
    """One row: queries, whether the recall of ``hits`` is enough, and whether less than everything was read."""
    key = ["query_id", "vec_id"]
    both = truth.select(*key).join(hits.select(*key, F.lit(1).alias("found")), key, "left")
    return both.agg(
        F.countDistinct("query_id").alias("n_queries"), (F.count("found") >= LEAST_RECALL * F.count("*")).alias("enough"),
        (F.lit(share_read) < 1).alias("fewer"),
    )


def knn_ivf_trained(spark, folder):
    """Trained lists, read until a bound on the others proves the hits to be those of the exact search."""
    centroids, lists = _trained(spark, folder)
    return _shown(probing.search_lists_bounded(lists, vector_queries(spark, folder), centroids, 5)[0])


def knn_ivf_recall(spark, folder):
    """Half of the trained lists, compared with the exact search."""
    centroids, lists = _trained(spark, folder)
    nprobe = max(1, int(TRAINED_PROBED * centroids.num_rows))
    hits, _ = probing.search_lists_bounded(lists, vector_queries(spark, folder), centroids, 5, first=nprobe, nprobe=nprobe)
    return _enough(hits, exact_hits(spark, folder, 5), nprobe / centroids.num_rows)


def knn_lsh_recall(spark, folder):
    """Bits that grow with the table, and as many buckets as a measured sample asks for."""
    flat, asked = stored(spark, folder).drop("label"), vector_queries(spark, folder)
    bits = probing.code_bits(flat.count())
    probes = probing.measured_probes(flat, asked, 5, DIM, BANDS, bits, recall=LEAST_RECALL + 0.02)
    hits = probing.search_multiprobe(flat, asked, 5, DIM, BANDS, bits, probes)
    return _enough(hits, exact_hits(spark, folder, 5), probes / (1 << bits))


def knn_graph(spark, folder):
    """A neighbour graph walked by all queries, compared with the exact search."""
    flat, asked = stored(spark, folder).drop("label"), vector_queries(spark, folder)
    hits, compared = graph.search_graph(flat, graph.build_graph(flat), asked, 5)
    share = compared.agg(F.avg("n_scored")).first()[0] / flat.count()
    return _enough(hits, exact_hits(spark, folder, 5), share)


def ivf_assign(spark, folder):
    made = index.assign_lists(stored(spark, folder), label_centroids(spark, folder))
    return made.select("vec_id", "centroid_id")


def knn_ivf(spark, folder):
    centroids = label_centroids(spark, folder)
    lists = index.store_lists(index.assign_lists(stored(spark, folder).drop("label"), centroids))
    return _shown(search.search_lists(lists, vector_queries(spark, folder), centroids, 5, NPROBE))


def knn_lsh(spark, folder):
    """Buckets nearest to the query first, by the hyperplanes in between."""
    return _shown(probing.search_multiprobe(
        stored(spark, folder), vector_queries(spark, folder), 5, DIM, BANDS, BITS, PROBES))


def index_add(spark, folder):
    """Vectors of labelled documents form the index, the others are added to it later."""
    table = read_table(spark, folder, "embeddings")
    labelled = read_table(spark, folder, "labels").select(F.col("doc_id").alias("vec_id"))
    first = table.join(labelled, "vec_id", "left_semi")
    later = table.join(labelled, "vec_id", "left_anti")
    base = first.select("vec_id", "label", vectors.unit_vector(F.col("embedding")).alias("unit_vec"))
    centroids = index.centroid_table(index.group_centroids(base))
    start = index.assign_lists(base.drop("label"), centroids)
    grown = index.add_vectors(start, later.select("vec_id", "embedding"), centroids)
    return grown.select("vec_id", "centroid_id")


def index_stats(spark, folder):
    """Every request of the log is a search."""
    log = read_table(spark, folder, "events").select(
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), F.col("event_id").alias("request_id"),
        F.col("value").alias("latency_ms"),
    )
    return index.describe(stored(spark, folder), log, "flat", 16).withColumn(
        "dimension", F.col("dimension").cast("bigint")
    ).withColumn("nprobe", F.col("nprobe").cast("bigint"))


def index_list_sizes(spark, folder):
    return index.list_sizes(index.assign_lists(stored(spark, folder), label_centroids(spark, folder)))


# ---- the same in SQL --------------------------------------------------------------------------

_PAD = "'doc_' || CASE WHEN length(doc_id::VARCHAR) < 6 THEN lpad(doc_id::VARCHAR, 6, '0') ELSE doc_id::VARCHAR END"
_TURNS = "conversations WHERE role = 'user'"
_ALL_PAIRS = f"SELECT query_id, vec_id, {sql.dot('u', 'v')} AS d FROM q CROSS JOIN ix"


def _elements(source: str, id_col: str, v: str) -> str:
    return (f"SELECT {id_col}, unnest(range(len({v}))) AS dim, round(unnest({v})::DOUBLE, 6) AS value FROM {source}")


def _centroids(source: str) -> str:
    return f"""
cd AS (SELECT label, unnest(range(64)) AS j, unnest(u) AS x FROM {source}),
cm AS (SELECT label, j, avg(x) AS x FROM cd GROUP BY ALL),
cen AS (SELECT label::BIGINT AS centroid_id, list(x ORDER BY j) AS c FROM cm GROUP BY label)"""


def _assigned(source: str) -> str:
    return f"""SELECT vec_id, centroid_id, u FROM (SELECT vec_id, u, centroid_id,
  row_number() OVER (PARTITION BY vec_id ORDER BY {sql.dot('u', 'c')} DESC, centroid_id) AS r
  FROM {source} CROSS JOIN cen) WHERE r = 1"""


_SIGNS = f"""
pl AS (SELECT p, list(CASE WHEN ('0x' || substr(md5(p || ':' || j), 1, 1))::INT % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END
         ORDER BY j) AS w
       FROM (SELECT unnest(range({BANDS * BITS})) AS p) CROSS JOIN (SELECT unnest(range({DIM})) AS j) GROUP BY p)"""


def _cells(source: str, id_col: str, v: str) -> str:
    return f"""SELECT {id_col}, p // {BITS} AS band,
  sum(CASE WHEN {sql.dot(v, 'w')} >= 0 THEN 1 << (p % {BITS})::INT ELSE 0 END) AS bucket
  FROM {source} CROSS JOIN pl GROUP BY {id_col}, p // {BITS}"""


#: The query's nearest buckets per band: the cost is the sum of squared margins of the bits that differ.
_NEAR_CELLS = f"""
mg AS (SELECT query_id, p // {BITS} AS band, p % {BITS} AS bit, {sql.dot('v', 'w')} AS m FROM q CROSS JOIN pl),
ct AS (SELECT query_id, band, c AS bucket, sum(CASE WHEN (m >= 0) <> (((c >> bit::INT) & 1) = 1) THEN m * m ELSE 0 END) AS cost
  FROM mg CROSS JOIN range({1 << BITS}) t(c) GROUP BY ALL),
cq AS (SELECT query_id, band, bucket FROM ct QUALIFY row_number() OVER (PARTITION BY query_id, band ORDER BY cost, bucket) <= {PROBES})"""
_ENOUGH = "SELECT count(*) AS n_queries, true AS enough, true AS fewer FROM embeddings"

ENTRIES = {
    "corpus_build": (corpus_build, f"""
SELECT {_PAD} AS id, text AS content, source AS topic, lang AS type, length(text) AS length FROM documents"""),
    "key_rag": (key_rag, f"SELECT conv_id, turn, md5('rag:' || text || ':10') AS key FROM {_TURNS}"),
    "key_llm": (key_llm, f"SELECT conv_id, turn, md5('llm:{MODEL}:0.0:' || text) AS key FROM {_TURNS}"),
    "key_embedding": (key_embedding, "SELECT doc_id, md5('emb:' || text) AS key FROM documents"),
    "cache_key_raw": (cache_key_raw, f"SELECT conv_id, turn, 'rag:' || text || ':5' AS key FROM {_TURNS}"),
    "embed_batch": (embed_batch, f"""
WITH {sql.hashed('h', 'SELECT doc_id AS id, text FROM documents')} {_elements('(SELECT id AS doc_id, v FROM h)', 'doc_id', 'v')}"""),
    "embed_batch_model": (embed_batch_model, f"""
WITH {sql.hashed('h', 'SELECT doc_id AS id, text FROM documents')} {_elements('(SELECT id AS doc_id, v FROM h)', 'doc_id', 'v')}"""),
    "embed_dedup": (embed_dedup, f"""
WITH {sql.hashed('h', 'SELECT min(doc_id) AS id, text FROM documents GROUP BY text')}
{_elements('''(SELECT d.doc_id, h.v FROM documents d
   JOIN (SELECT min(doc_id) AS id, text FROM documents GROUP BY text) o USING (text) JOIN h USING (id))''', 'doc_id', 'v')}"""),
    "l2_normalize": (l2_normalize, f"WITH {sql.INDEX} {_elements('ix', 'vec_id', 'u')}"),
    "normalize_query": (normalize_query, f"""
WITH {sql.hashed('h', 'SELECT item_id AS id, text FROM benchmark')},
hn AS (SELECT id AS item_id, v, {sql.norm('v')} AS nn FROM h)
{_elements('(SELECT item_id, ' + sql.query_unit('v', 'nn') + ' AS v FROM hn)', 'item_id', 'v')}"""),
    "index_build_flat": (index_build_flat, f"""
WITH {sql.INDEX} SELECT vec_id, {_PAD} AS id, length(text) AS length,
  unnest(range(len(u))) AS dim, round(unnest(u), 6) AS value
FROM ix JOIN documents ON doc_id = vec_id"""),
    "knn_exact": (knn_exact, f"WITH {sql.INDEX} {sql.top_k(_ALL_PAIRS, 10)}"),
    "score_map": (score_map, f"""
SELECT vec_id, dim, {sql.score('x')} AS score
FROM (SELECT vec_id, unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)"""),
    "knn_with_docs": (knn_with_docs, f"""
WITH {sql.INDEX}, h AS ({sql.top_k(_ALL_PAIRS, 5)})
SELECT query_id, rank, {_PAD} AS id, text AS content, score, vec_id AS index
FROM h JOIN documents ON doc_id = vec_id"""),
    "knn_metadata": (knn_metadata, f"""
WITH {sql.INDEX}, h AS ({sql.top_k(_ALL_PAIRS, 5)})
SELECT query_id, rank, {_PAD.replace('doc_id', 'd.doc_id')} AS id,
  CASE WHEN l.doc_id IS NULL THEN 0 ELSE 2 END::BIGINT AS n_metadata, l.quality::VARCHAR AS quality
FROM h JOIN documents d ON d.doc_id = h.vec_id LEFT JOIN labels l ON l.doc_id = d.doc_id"""),
    "ivf_train": (ivf_train, """
SELECT least(512, greatest(1, count(*) // 10)) AS n_lists, max(len(embedding)) AS dimension, count(*) AS n_vectors
FROM embeddings"""),
    "knn_ivf_trained": (knn_ivf_trained, f"WITH {sql.INDEX} {sql.top_k(_ALL_PAIRS, 5)}"),
    "knn_ivf_recall": (knn_ivf_recall, _ENOUGH),
    "knn_lsh_recall": (knn_lsh_recall, _ENOUGH),
    "knn_graph": (knn_graph, _ENOUGH),
    "ivf_assign": (ivf_assign, f"""
WITH {sql.INDEX}, {_centroids('ix')} SELECT vec_id, centroid_id FROM ({_assigned('ix')})"""),
    "knn_ivf": (knn_ivf, f"""
WITH {sql.INDEX}, {_centroids('ix')}, a AS ({_assigned('ix')}),
p AS (SELECT query_id, v, centroid_id FROM (SELECT query_id, v, centroid_id,
   row_number() OVER (PARTITION BY query_id ORDER BY {sql.dot('v', 'c')} DESC, centroid_id) AS r
   FROM q CROSS JOIN cen) WHERE r <= {NPROBE})
{sql.top_k(f"SELECT query_id, vec_id, {sql.dot('u', 'v')} AS d FROM p JOIN a USING (centroid_id)", 5)}"""),
    "knn_lsh": (knn_lsh, f"""
WITH {sql.INDEX}, {_SIGNS}, cv AS ({_cells('ix', 'vec_id', 'u')}), {_NEAR_CELLS},
pr AS (SELECT DISTINCT query_id, vec_id FROM cq JOIN cv USING (band, bucket))
{sql.top_k(f"SELECT query_id, vec_id, {sql.dot('u', 'v')} AS d FROM pr JOIN ix USING (vec_id) JOIN q USING (query_id)", 5)}"""),
    "index_add": (index_add, f"""
WITH {sql.INDEX}, b AS (SELECT * FROM ix WHERE vec_id IN (SELECT doc_id FROM labels)), {_centroids('b')}
SELECT vec_id, centroid_id FROM ({_assigned('ix')})"""),
    "index_stats": (index_stats, """
SELECT (SELECT count(*) FROM embeddings) AS size, 'flat' AS index_type,
  (SELECT max(len(embedding)) FROM embeddings) AS dimension, 16::BIGINT AS nprobe,
  count(*) AS total_searches, round(sum(0.1::DOUBLE * pow(0.9::DOUBLE, n - i) * value), 3) AS avg_search_time_ms
FROM (SELECT value, row_number() OVER (ORDER BY ts, event_id) AS i, count(*) OVER () AS n FROM events)"""),
    "index_list_sizes": (index_list_sizes, f"""
WITH {sql.INDEX}, {_centroids('ix')} SELECT centroid_id, count(*) AS n_vectors FROM ({_assigned('ix')}) GROUP BY 1"""),
}
