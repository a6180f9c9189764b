import numpy as np
import pytest
from pyspark.sql import functions as F

from vecquery.functions import vectors
from vecquery.operators import index, search


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    made = [(i, rng.normal(size=8).astype("float32").tolist(), int(i % 4)) for i in range(120)]
    made[5] = (5, [0.0] * 8, 1)
    return spark.createDataFrame(made, "vec_id bigint, embedding array<float>, label int").cache()


@pytest.fixture(scope="module")
def stored(points):
    return index.build_flat(points).join(points.select("vec_id", "label"), "vec_id").cache()


@pytest.fixture(scope="module")
def queries(points):
    return points.select(F.col("vec_id").alias("query_id"), vectors.unit_query(F.col("embedding")).alias("vec"))


def as_set(hits):
    return {(h.query_id, h.rank, h.vec_id, h.score) for h in hits.collect()}


def test_zero_vector_stays_zero_and_scores_half(spark, stored, queries):
    assert stored.filter("vec_id = 5").first().unit_vec == [0.0] * 8
    hits = search.search_exact(stored, queries.filter("query_id = 5"), 3).collect()
    assert [h.score for h in hits] == [0.5] * 3
    assert sorted(h.vec_id for h in hits) == [0, 1, 2]


def test_all_lists_probed_equals_exact(stored, queries):
    centroids = index.centroid_table(index.group_centroids(stored))
    lists = index.assign_lists(stored.drop("label"), centroids)
    every = search.search_lists(lists, queries, centroids, 5, nprobe=4)
    assert as_set(every) == as_set(search.search_exact(stored, queries, 5))


def test_few_lists_probed_is_a_subset_in_order(stored, queries):
    centroids = index.centroid_table(index.group_centroids(stored))
    lists = index.store_lists(index.assign_lists(stored.drop("label"), centroids))
    hits = search.search_lists(lists, queries, centroids, 5, nprobe=1).collect()
    by_query = {}
    for h in sorted(hits, key=lambda h: (h.query_id, h.rank)):
        by_query.setdefault(h.query_id, []).append(h.score)
    assert all(s == sorted(s, reverse=True) and 0 <= s[-1] and s[0] <= 1 for s in by_query.values())


def test_stored_lists_are_pruned(stored, queries, capsys):
    centroids = index.centroid_table(index.group_centroids(stored))
    lists = index.store_lists(index.assign_lists(stored.drop("label"), centroids))
    search.search_lists(lists, queries.filter("query_id = 3"), centroids, 5, nprobe=1).explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if "PartitionFilters" in line]
    assert any("centroid_id" in line for line in filters)


def test_hashed_search_with_many_bands_finds_itself(stored, queries):
    hits = search.search_hashed(stored, queries, 1, dim=8, bands=4, bits=3).collect()
    own = {h.query_id: h.vec_id for h in hits}
    assert all(own[i] == i for i in range(120) if i != 5)


def test_kmeans_lists(stored):
    trained = index.train_centroids(stored, nlist=512)
    assert trained.count() == index.list_count(120, 512) == 12
    assert index.list_count(5, 512) == 1 and index.list_count(100_000, 512) == 512
    assigned = index.assign_lists(stored, index.centroid_table(trained))
    assert assigned.filter("centroid_id IS NULL").count() == 0
    assert index.list_sizes(assigned).agg(F.sum("n_vectors")).first()[0] == 120


def test_add_to_empty_index_and_to_lists(points, stored):
    empty = index.build_flat(points.limit(0))
    grown = index.add_vectors(empty, points)
    assert grown.count() == 120
    centroids = index.centroid_table(index.group_centroids(stored))
    start = index.assign_lists(index.build_flat(points.filter("vec_id < 60")), centroids)
    later = index.add_vectors(start, points.filter("vec_id >= 60"), centroids)
    whole = index.assign_lists(index.build_flat(points), centroids)
    assert {tuple(r) for r in later.select("vec_id", "centroid_id").collect()} == {
        tuple(r) for r in whole.select("vec_id", "centroid_id").collect()
    }


def test_attached_documents_skip_missing_and_default_metadata(spark, stored, queries, monkeypatch):
    docs = spark.createDataFrame(
        [(0, "doc_000000", "zero"), (1, "doc_000001", "one")], "vec_id bigint, id string, content string"
    )
    known = spark.createDataFrame([(0, {"a": "1"}), (7, {"b": "2"})], "vec_id bigint, metadata map<string,string>")
    hits = search.search_exact(stored, queries.filter("query_id IN (0, 1)"), 120)
    rows = search.attach_documents(hits, docs, known).collect()
    monkeypatch.setattr(search, "MAX_SENT_HITS", 0)
    assert sorted(search.attach_documents(hits, docs, known).drop("metadata").collect()) == sorted(
        r for r in search.attach_documents(hits, docs).drop("metadata").collect()
    )
    assert {(r.query_id, r.id) for r in rows} == {(q, d) for q in (0, 1) for d in ("doc_000000", "doc_000001")}
    assert {r.id: r.metadata for r in rows} == {"doc_000000": {"a": "1"}, "doc_000001": {}}


def test_score_is_clamped(spark):
    df = spark.createDataFrame([(-1.5,), (-1.0,), (0.0,), (0.12345,), (1.0,), (1.5,)], "d double")
    assert [r[0] for r in df.select(vectors.relevance(F.col("d"))).collect()] == [0.0, 0.0, 0.5, 0.5617, 1.0, 1.0]


def test_description_of_an_index_never_searched(stored, spark):
    log = spark.createDataFrame([], "ts_us bigint, request_id bigint, latency_ms double")
    row = index.describe(stored, log, "flat", 16).first()
    assert (row["size"], row.dimension, row.total_searches, row.avg_search_time_ms) == (120, 8, 0, 0.0)


def test_id_ranges_admit_all_ids_and_few_others(spark):
    rng = np.random.default_rng(4)
    ids = np.concatenate([rng.integers(0, 40, 30), rng.integers(5_000, 5_040, 30), [10**12, -7]])
    table = spark.range(-100, 10_000).withColumnRenamed("id", "vec_id")
    for most in (1, 2, 4, 500):
        got = {r.vec_id for r in table.filter(search.id_ranges(F.col("vec_id"), ids, most)).collect()}
        assert {i for i in ids.tolist() if i < 10_000} <= got
        assert len(got) <= {1: 10_007, 2: 5_047, 4: 87, 500: 87}[most]
    assert got == {i for i in ids.tolist() if i < 10_000}
    assert table.filter(search.id_ranges(F.col("vec_id"), np.zeros(0, dtype=np.int64))).count() == 0


def test_few_hits_read_few_rows_of_stored_documents(spark):
    documents = spark.range(40_000).select(F.col("id").alias("vec_id"), F.concat(F.lit("d"), "id").alias("id"), F.repeat(F.lit("text "), 5).alias("content"))
    stored = search.store_documents(documents.orderBy(F.rand(1)), 16)

    def scanned(ids):
        found = stored.filter(search.id_ranges(F.col("vec_id"), np.array(ids)))
        assert found.count() >= len(ids)
        plan = found._jdf.queryExecution()
        found.collect()
        return plan.executedPlan().collectLeaves().head().metrics().get("numOutputRows").get().value()

    assert scanned([3, 5, 9]) <= 40_000 / 8 and scanned([3, 39_000]) <= 40_000 / 4 < scanned([3, 39_000] + list(range(0, 40_000, 400)))
    hits = spark.createDataFrame([(1, 1, 7, 0.9), (1, 2, 39_001, 0.8), (2, 1, 50_000, 0.7)], "query_id bigint, rank int, vec_id bigint, score double")
    assert {(h.query_id, h.id) for h in search.attach_documents(hits, stored).collect()} == {(1, "d7"), (1, "d39001")}
