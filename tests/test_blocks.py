import tracemalloc

import numpy as np
import pytest

from vecquery.operators import blocks, search

VECTORS = "cell bigint, vec_id bigint, vec array<double>"
QUERIES = "cell bigint, query_id bigint, vec array<double>"


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def brute(vectors, queries, k):
    best = {}
    for qc, qid, q in queries:
        for vc, vid, v in vectors:
            if qc == vc:
                best.setdefault(qid, {})[vid] = dot(q, v)
    out = set()
    for qid, scores in best.items():
        ranked = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]
        out |= {(qid, i + 1, vid, d) for i, (vid, d) in enumerate(ranked)}
    return out


def sample(seed, n_vectors, n_queries, cells=1, dim=8):
    """A third of the vectors are copies of one, half of them share a cell."""
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n_vectors, dim))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    points[: n_vectors // 3] = points[0]
    points = rng.permutation(points)
    cell = np.where(rng.random(n_vectors) < 0.5, 0, rng.integers(0, cells, n_vectors))
    asked = rng.normal(size=(n_queries, dim))
    asked /= np.linalg.norm(asked, axis=1, keepdims=True)
    asked[: n_queries // 2] = points[:1]
    asked[0] = 0.0
    vectors = [(int(cell[i]), i, points[i].tolist()) for i in range(n_vectors)]
    queries = [(c, i, asked[i].tolist()) for i in range(n_queries) for c in range(min(cells, 2))]
    return vectors, queries


def found(spark, vectors, queries, k, sent):
    v = spark.createDataFrame(vectors, VECTORS).repartition(3)
    q = spark.createDataFrame(queries, QUERIES)
    hits = search.rank_hits(blocks.cell_top_k(v, q, k, sent), k).collect()
    return {(h.query_id, h.rank, h.vec_id, h.dot) for h in hits}


@pytest.mark.parametrize("sent", [1_000, 0])
@pytest.mark.parametrize("cells,k", [(1, 5), (4, 5), (3, 1), (2, 500)])
def test_both_ways_equal_brute_force(spark, monkeypatch, sent, cells, k):
    monkeypatch.setattr(blocks, "VECTOR_BLOCK_BYTES", 40 * 8 * 6)
    monkeypatch.setattr(blocks, "QUERY_BLOCK_BYTES", 6 * 8 * 6)
    monkeypatch.setattr(blocks, "_ROWS_AT_ONCE", 16)
    monkeypatch.setattr(blocks, "_QUERIES_AT_ONCE", 4)
    vectors, queries = sample(7, 200, 15, cells)
    assert found(spark, vectors, queries, k, sent) == brute(vectors, queries, k)


@pytest.mark.parametrize("sent", [1_000, 0])
def test_same_pair_in_two_cells_counts_once(spark, sent):
    same = [1.0, 0.0]
    vectors = [(c, i, same if i < 3 else [0.6, 0.8]) for i in range(5) for c in (0, 1)]
    queries = [(0, 9, same), (1, 9, same)]
    v, q = spark.createDataFrame(vectors, VECTORS), spark.createDataFrame(queries, QUERIES)
    hits = blocks.cell_top_k(v, q, 4, sent).groupBy("query_id", "vec_id").agg({"dot": "max"})
    ranked = search.rank_hits(hits.withColumnRenamed("max(dot)", "dot"), 4).collect()
    assert [(h.rank, h.vec_id) for h in sorted(ranked, key=lambda h: h.rank)] == [(1, 0), (2, 1), (3, 2), (4, 3)]


@pytest.mark.parametrize("sent", [1_000, 0])
def test_empty_sides(spark, sent):
    vectors, queries = sample(1, 10, 3)
    assert found(spark, vectors, queries, 3, sent) != set()
    assert found(spark, [], queries, 3, sent) == set()
    assert found(spark, vectors, [], 3, sent) == set()


def test_k_must_be_positive(spark):
    with pytest.raises(ValueError):
        blocks.cell_top_k(spark.createDataFrame([], VECTORS), spark.createDataFrame([], QUERIES), 0)


@pytest.mark.parametrize("kind", ["equal", "zero", "some"])
def test_copies_stay_few(kind):
    """Equal vectors tie, so only the k smallest ids of each are scored."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(5_000, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if kind == "equal":
        vectors[:] = vectors[0]
    elif kind == "zero":
        vectors[:] = 0
        vectors[::2] = -0.0
    else:
        vectors[1_000:4_000] = vectors[7]
    ids = rng.permutation(5_000)
    queries = vectors[rng.integers(0, 5_000, 200)] + 0.0
    kept, rows = blocks.first_copies(ids, vectors, 5)
    assert len(kept) <= {"equal": 5, "zero": 5, "some": 2_005}[kind]
    best = blocks.BestHits(200, 5)
    best.add(np.arange(200), queries, ids, vectors)
    dots = np.zeros((200, 5_000))
    for j in range(16):
        dots += queries[:, j, None] * vectors[None, :, j]
    for q in range(0, 200, 17):
        order = np.lexsort((ids, -dots[q]))[:5]
        assert best.vec[best.query == q].tolist() == ids[order].tolist()


def test_a_block_is_scored_in_little_memory():
    rng = np.random.default_rng(8)
    vectors, queries = rng.normal(size=(9_000, 8)), rng.normal(size=(4_000, 8))
    best = blocks.BestHits(4_000, 5)
    tracemalloc.start()
    best.add(np.arange(4_000), queries, np.arange(9_000), vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
    want = np.argsort(-(queries[::500] @ vectors.T), axis=1)[:, :5]
    assert [best.vec[best.query == q].tolist() for q in range(0, 4_000, 500)] == want.tolist()
    assert len(best.table(np.arange(4_000))) == 20_000


def test_scores_of_a_step_need_few_megabytes():
    """Queries are compared in steps, so what a task holds beside its block does not follow the number of queries."""
    rng = np.random.default_rng(4)
    queries, vectors = rng.standard_normal((2_048, 64)), rng.standard_normal((8_192, 64))
    best = blocks.BestHits(2_048, 5)
    tracemalloc.start()
    best.add(np.arange(2_048), queries, np.arange(8_192), vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
    want = np.argsort(-(queries[::256] @ vectors.T), axis=1)[:, :5]
    assert [best.vec[best.query == q].tolist() for q in range(0, 2_048, 256)] == want.tolist()


@pytest.mark.parametrize("scale", [1.0, 1e-30, 1e12, 1e100])
def test_rounding_of_the_preselection_loses_no_hit(scale, monkeypatch):
    """Dots closer than single precision tells apart, of vectors of any length; unit vectors are preselected in single precision."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=32)
    vectors = base + 1e-9 * rng.normal(size=(9_000, 32))
    queries = np.concatenate([base + 1e-9 * rng.normal(size=(20, 32)), rng.normal(size=(20, 32))])
    vectors, queries = (x / np.linalg.norm(x, axis=1, keepdims=True) * scale for x in (vectors, queries))
    ids = rng.permutation(len(vectors))
    kinds = []
    monkeypatch.setattr(blocks, "_preselecting", lambda *a, f=blocks._preselecting: kinds.append((got := f(*a))[0].dtype) or got)
    best = blocks.BestHits(len(queries), 5)
    best.add(np.arange(len(queries)), queries, ids, vectors)
    best._settle()
    dots = np.zeros((len(queries), len(vectors)))
    for j in range(32):
        dots += queries[:, j, None] * vectors[None, :, j]
    want = [ids[np.lexsort((ids, -row))[:5]].tolist() for row in dots]
    assert best.vec.reshape(-1, 5).tolist() == want
    assert set(kinds) == {np.dtype(np.float64 if scale > 1e15 else np.float32)}
