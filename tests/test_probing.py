import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecquery.operators import blocks, graph, index, probing, search

DIM = 16


@pytest.fixture(scope="module")
def clustered(spark):
    """Thirty tight groups of vectors, a zero vector and one vector sixty times."""
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(30, DIM))
    rows = [(i, (centers[i % 30] + rng.normal(size=DIM) * 0.15).tolist()) for i in range(900)]
    rows += [(2_000, [0.0] * DIM)] + [(3_000 + i, centers[0].tolist()) for i in range(60)]
    return index.build_flat(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).cache()


@pytest.fixture(scope="module")
def queries(clustered):
    every = clustered.filter("vec_id % 20 = 0 OR vec_id = 2000")
    return every.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").cast("array<double>").alias("vec")).cache()


@pytest.fixture(scope="module")
def trained(clustered):
    centroids = index.centroid_table(index.train_centroids(clustered, 30))
    return centroids, index.store_lists(index.assign_lists(clustered, centroids))


def as_set(hits):
    return {(h.query_id, h.rank, h.vec_id, h.score) for h in hits.collect()}


def recall(hits, truth):
    found = {(q, v) for q, _, v, _ in as_set(hits)}
    wanted = {(q, v) for q, _, v, _ in as_set(truth)}
    return len(found & wanted) / len(wanted)


def test_bounds_stop_the_search_without_losing_a_hit(clustered, queries, trained):
    centroids, lists = trained
    hits, probed = probing.search_lists_bounded(lists, queries, centroids, 5, first=2)
    assert as_set(hits) == as_set(search.search_exact(clustered, queries, 5))
    read = {r.query_id: r.n_lists for r in probed.collect()}
    assert len(read) == queries.count()
    assert sorted(read.values())[len(read) // 2] <= 4 < centroids.num_rows  # most queries read a few lists
    assert read[2_000] == centroids.num_rows  # every dot of the zero vector is 0, which no bound beats


def test_nprobe_ends_the_search(clustered, queries, trained):
    centroids, lists = trained
    hits, probed = probing.search_lists_bounded(lists, queries, centroids, 5, first=2, nprobe=2)
    assert {r.n_lists for r in probed.collect()} == {2}
    assert as_set(hits) == as_set(search.search_lists(lists, queries, centroids, 5, nprobe=2))


def test_fewer_vectors_than_k_and_no_queries(spark, clustered, queries, trained):
    centroids, lists = trained
    few = lists.filter("vec_id IN (0, 30, 2000)")
    hits, _ = probing.search_lists_bounded(few, queries, centroids, 5)
    assert as_set(hits) == as_set(search.search_exact(clustered.filter("vec_id IN (0, 30, 2000)"), queries, 5))
    hits, probed = probing.search_lists_bounded(lists, queries.limit(0), centroids, 5)
    assert hits.count() == probed.count() == 0
    hits, _ = probing.search_lists_bounded(lists.limit(0), queries, centroids, 5)
    assert hits.count() == 0


def test_cheapest_codes_are_the_cheapest_of_all():
    margins = np.random.default_rng(1).normal(size=(20, 7))
    for probes in (1, 5, 128, 500):
        got = probing.cheapest_codes(margins, probes)
        for row, codes in zip(margins, got, strict=True):
            own = sum(1 << b for b in range(7) if row[b] >= 0)
            cost = {c: sum(row[b] ** 2 for b in range(7) if (c ^ own) >> b & 1) for c in range(128)}
            assert codes.tolist() == sorted(cost, key=lambda c: (cost[c], c))[:probes]


def test_all_buckets_probed_equals_exact(clustered, queries):
    every = probing.search_multiprobe(clustered, queries, 5, DIM, 1, 4, 16)
    assert as_set(every) == as_set(search.search_exact(clustered, queries, 5))


def test_measured_probes_reach_the_recall(clustered, queries):
    bits = probing.code_bits(961)
    probes = probing.measured_probes(clustered, queries, 5, DIM, 2, bits, recall=0.9)
    assert probes < 1 << bits
    assert recall(probing.search_multiprobe(clustered, queries, 5, DIM, 2, bits, probes), search.search_exact(clustered, queries, 5)) >= 0.9
    assert probing.measured_probes(clustered, queries.limit(0), 5, DIM, 2, bits) == 1 << bits


def test_bits_grow_with_the_table():
    assert [probing.code_bits(n) for n in (0, 100, 1_000, 32_000, 10**9, 10**15)] == [4, 4, 4, 9, 24, 40]


def test_pairs_inside_groups():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(11, 4))
    owner, ids = np.array([0] * 5 + [1] * 1 + [2] * 5), np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 6])
    vectors[10] = vectors[6]
    floor = np.where(np.arange(11) % 2, -np.inf, 0.3)
    got = {(a, b, round(d, 9)) for a, b, d in zip(*graph._pairs_inside(owner, ids, vectors, floor, 9).to_pydict().values(), strict=True)}
    want = {
        (ids[i], ids[j], round(float(vectors[i] @ vectors[j]), 9))
        for i, j in itertools.permutations(range(11), 2) if owner[i] == owner[j] and ids[i] != ids[j] and vectors[i] @ vectors[j] > floor[i]
    }
    assert got == want


def test_graph_finds_neighbours_and_compares_few(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(3_000)]
    flat = index.build_flat(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).cache()
    asked = flat.filter("vec_id % 60 = 0").select(F.col("vec_id").alias("query_id"), F.col("unit_vec").cast("array<double>").alias("vec"))
    made = graph.build_graph(flat, edges=16)
    assert made.groupBy("vec_id").count().agg(F.min("count"), F.max("count"), F.count("*")).first() == (16, 16, 3_000)
    true = search.search_exact(flat, flat.select(F.col("vec_id").alias("query_id"), F.col("unit_vec").cast("array<double>").alias("vec")), 11)
    found = true.filter("query_id <> vec_id").join(made, [F.col("query_id") == made.vec_id, true.vec_id == F.col("neighbor")], "left_semi").count()
    assert found / 30_000 >= 0.85  # of the ten nearest
    hits, compared = graph.search_graph(flat, made, asked, 5, beam=48)
    assert recall(hits, search.search_exact(flat, asked, 5)) >= 0.9
    assert compared.agg(F.avg("n_scored")).first()[0] < 3_000 / 2


def test_graph_of_copies_and_of_next_to_nothing(spark, clustered):
    copies = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(700)], "vec_id bigint, embedding array<float>")
    flat = index.build_flat(copies)
    made = graph.build_graph(flat, edges=4, rounds=2)
    assert made.groupBy("vec_id").count().agg(F.max("count")).first()[0] <= 4
    asked = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, vec array<double>")
    assert {h.score for h in graph.search_graph(flat, made, asked, 5)[0].collect()} == {1.0}
    none = graph.build_graph(flat.limit(0))
    assert none.count() == 0
    assert graph.search_graph(flat.limit(0), none, asked, 5)[0].count() == 0
    one = flat.filter("vec_id = 3")
    assert [h.vec_id for h in graph.search_graph(one, graph.build_graph(one), asked, 5)[0].collect()] == [3]


def test_graph_of_several_shards(spark, monkeypatch):
    monkeypatch.setattr(graph, "SHARD_ROWS", 500)
    monkeypatch.setattr(graph, "QUERY_ROWS", 400)
    monkeypatch.setattr(graph, "WALKERS", 50)
    rng = np.random.default_rng(5)
    rows = [(i * 7 - 300, rng.normal(size=12).tolist()) for i in range(1_900)]
    flat = index.build_flat(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).cache()
    made = graph.build_graph(flat, edges=16)
    shard = made.select("vec_id", "shard").distinct()
    assert shard.count() == 1_900 and shard.groupBy("shard").count().count() == 4
    inside = made.join(shard.withColumnRenamed("vec_id", "neighbor"), ["neighbor", "shard"], "left_semi")
    assert inside.count() == made.count() == 16 * 1_900  # no edge leaves its shard
    asked = flat.filter("vec_id % 2 = 0").select(F.col("vec_id").alias("query_id"), F.col("unit_vec").cast("array<double>").alias("vec"))
    hits, compared = graph.search_graph(flat, made, asked, 5, beam=24, step=8, entries=16)
    scored = compared.agg(F.sum("n_scored"), F.count("*")).first()
    assert scored[1] == asked.count() and 300 < scored[0] / scored[1] < 1_500
    assert recall(hits, search.search_exact(flat, asked, 5)) >= 0.9


def test_a_block_of_queries_walks_a_shelf_of_shards_in_one_task(spark, monkeypatch):
    """A query comes once to every four shards and leaves them with its best hits over all of them, whatever it would find in each."""
    monkeypatch.setattr(graph, "SHARD_ROWS", 100)
    written = {}

    def kept(df, label, *rest, write=graph.write_stage):
        written[label] = write(df, label, *rest)
        return written[label]

    monkeypatch.setattr(graph, "write_stage", kept)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(800)]
    flat = index.build_flat(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).cache()
    made = graph.build_graph(flat, edges=16)
    asked = flat.filter("vec_id < 90").select(F.col("vec_id").alias("query_id"), F.col("unit_vec").cast("array<double>").alias("vec"))
    hits, compared = graph.search_graph(flat, made, asked.unionAll(asked.filter("query_id = 7")), 5)
    exact = {(r.query_id, r.rank): (r.vec_id, round(r.dot, 12)) for r in search.search_exact(flat, asked, 5).collect()}
    assert {(r.query_id, r.rank): (r.vec_id, round(r.dot, 12)) for r in hits.collect()} == exact  # small shards are read almost whole
    scored = {r.query_id: r.n_scored for r in compared.collect()}
    assert scored.keys() == set(range(90)) and all(700 < n / (1 + (i == 7)) <= 800 for i, n in scored.items())
    assert written["walked"].count() == 91 * 2 * (5 + 1)  # eight shards are two shelves


def test_a_walk_of_huge_and_of_ordinary_vectors_takes_the_same_way():
    """Single precision chooses the way where it can hold the numbers; the kept dots are those of double precision."""
    vectors = np.random.default_rng(7).normal(size=(2_000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    made = graph._shard_edges(vectors, 16, 4)
    found = []
    for scale in (1.0, 2.0**100, 2.0**-100):
        table = pa.table({
            "vec_id": np.arange(2_000) * 3, "vec": (vectors * scale).tolist(), "neighbors": (made.neighbor * 3).tolist(),
        })
        shard = graph._Shard(table)
        assert shard.rough.dtype == np.float32 and 0.5 <= np.abs(shard.rough).max() <= 1
        place, dot, scored = graph._walk(shard, vectors[:40] * scale, 24, 24, 8, 16)
        assert np.allclose(dot / scale**2, np.take_along_axis(vectors[:40] @ vectors.T, place, axis=1), rtol=0, atol=1e-14)
        assert (np.diff(dot, axis=1) <= 0).all() and all(len(set(p)) == 24 for p in place.tolist()) and (scored < 1_500).all()
        found.append((place, scored))
    for place, scored in found:
        assert (place == found[0][0]).all() and (scored == found[0][1]).all()


def test_ranked_numbers_fall_with_the_dot_and_rise_with_the_place():
    dots = np.array([np.inf, 3e38, 1.0, 1.0, 1e-40, 0.0, -0.0, -1e-40, -2.0, -np.inf, np.nan], dtype=np.float32)
    place = np.array([5, 4, 1, 2**31 - 2, 3, 6, 7, 2, 1, 0, 9])
    ranked = graph._ranked(dots, place)
    assert (np.diff(ranked) > 0).all() or ranked.tolist() == sorted(set(ranked.tolist()))
    assert (graph._place_of(ranked) == place).all() and (graph._place_of(ranked | np.uint64(1)) == place).all()
    assert (ranked < graph._NONE).all() and graph._place_of(graph._NONE) == 2**31 - 1


@pytest.mark.parametrize("probes", [1, 3, 11, 16])
def test_many_queries_of_many_buckets_travel_once_a_block(clustered, queries, monkeypatch, probes):
    """Blocks of buckets, some cut, give the hits of queries that are sent with the list of their buckets."""
    few = as_set(probing.search_multiprobe(clustered, queries, 5, DIM, 2, 4, probes))
    monkeypatch.setattr(blocks, "VECTOR_BLOCK_BYTES", 8 * DIM * 50)
    monkeypatch.setattr(blocks, "QUERY_BLOCK_BYTES", 8 * DIM * 20)
    monkeypatch.setattr(probing, "_SLICE_NUMBERS", 60)
    monkeypatch.setattr(probing, "_near_cells", None)  # no row per query and bucket
    assert as_set(probing.search_multiprobe(clustered, queries, 5, DIM, 2, 4, probes, max_sent_queries=0)) == few
