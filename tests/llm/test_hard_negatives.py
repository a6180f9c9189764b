import math
import random

import numpy as np
import pytest

from vecquery.llm import hard_negatives, strassen

ROWS = "vec_id bigint, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(0, 3, 4), (1, 1, 1), (5, 7, 3), (33, 64, 70), (100, 130, 257), (256, 64, 1_000)])
def test_products_are_exact(shape):
    draw = np.random.default_rng(sum(shape))
    for top in (9, 2**20, 2**31):
        a = draw.integers(-top, top, shape[:2])
        b = draw.integers(-top, top, shape[1:])
        with np.errstate(over="ignore"):
            assert (strassen.product(a, b, leaf=8) == a @ b).all()
            assert (strassen.product(a, b) == a @ b).all()


def test_recursion_pads_and_halves():
    assert strassen.halvings(256, 64, 8_192) == 1
    assert strassen.halvings(256, 64, 8_192, leaf=8) == 3
    assert strassen.halvings(256, 3, 8_192) == 0
    assert strassen._padded(np.ones((5, 7), dtype=np.int64), 2).shape == (8, 8)


@pytest.mark.parametrize("top", [5, 2**55])
def test_best_of_rows(top):
    draw = np.random.default_rng(1)
    scores = draw.integers(-top, top, (20, 40))
    scores[:, 30:] = scores[:, :10]
    allowed = draw.random((20, 40)) < 0.3
    allowed[0] = False
    row, column = hard_negatives.best_of(scores, allowed, 7)
    want = [
        (r, c) for r in range(20)
        for c in sorted((c for c in range(40) if allowed[r, c]), key=lambda c: (-int(scores[r, c]), c))[:7]
    ]
    assert list(zip(row.tolist(), column.tolist(), strict=True)) == want


def test_heaps_of_parts_merge_to_the_heap_of_the_whole():
    draw = np.random.default_rng(2)
    owner, ids, score = draw.integers(0, 5, 300), np.arange(300), draw.integers(0, 9, 300)
    whole, parts = hard_negatives.Heap(4), hard_negatives.Heap(4)
    whole.merge(owner, ids, score)
    for i in draw.permutation(30):
        part = slice(10 * i, 10 * i + 10)
        parts.merge(owner[part], ids[part], score[part])
    assert (whole.id == parts.id).all() and (whole.owner == parts.owner).all()


def test_tiles_of_a_block_pair_merge(monkeypatch):
    draw = np.random.default_rng(5)
    rows = {"vec_id": np.arange(50), "label": draw.integers(0, 2, 50), "v": draw.integers(-3, 4, (50, 6)).astype(np.int8)}
    anchors = {name: values[::10] for name, values in rows.items()}
    anchors |= {"owner": np.array([0, 0, 2]), "positive_id": np.array([3, 4, 5]), "score": np.array([40, 30, 50])}
    whole = hard_negatives.tile_positives(anchors, rows, 4), hard_negatives.tile_negatives(anchors, rows, 4)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 7)
    assert whole == (hard_negatives.tile_positives(anchors, rows, 4), hard_negatives.tile_negatives(anchors, rows, 4))


def brute(rows):
    kept = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        row = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        kept[i] = min(kept.get(i, row), row)
    out = []
    for a, (label, vector) in kept.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(vector, v, strict=False)) for i, (_, v) in kept.items()}
        alike = sorted((i for i in kept if i != a and kept[i][0] == label), key=lambda i: (-score[i], i))[:5]
        for p in alike:
            fits = [i for i in kept if kept[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            for rank, n in enumerate(sorted(fits, key=lambda i: (-score[i], i))[:10], 1):
                out.append((a, p, rank, n, score[p], score[n]))
    return sorted(out)


def vectors(n, dim, seed):
    draw = random.Random(seed)
    return [
        (i * draw.choice([1, 1, 1, 25]), [draw.uniform(-1, 1) + 0.4 for _ in range(dim)], draw.choice([0, 0, 0, 1, 2, 9])) for i in range(n)
    ]


@pytest.mark.parametrize("limits", [{}, {"BLOCK_ROWS": 60, "LEAST_ROWS": 7, "ANCHOR_ROWS": 2}])
def test_against_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(400, 9, 3)
    rows += [(1_000 + i, [0.5] * 9, i % 2) for i in range(120)]  # one vector many times: ties by id
    found = hard_negatives.mine(spark.createDataFrame(rows, ROWS))
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(60, 4, 8)
    rows += [
        (None, [1.0, 1.0], 1), (100, None, 1), (200, [1.0, None], 0), (300, [nan, 1.0], 0), (400, [inf, 1.0], 0), (500, [1.0], None),
        (600, [], 0), (700, [3e30, 1.0], 5), (800, [1.0, 0.5], 0), (800, [1.0, 0.5], 0), (800, [0.1, 0.5], 1), (-100, [1.0, 0.5, 0.2, 0.1, 0.9], 0),
        (900, [0.0, 0.0], 0), (901, [0.0] * 4, 0), (902, [0.0], 3),
    ]
    big = [r for r in rows if r[0] != 700]
    extra = spark.createDataFrame([(*r, "x", "y", 1) for r in big], f"{ROWS}, v string, cell string, score int")
    assert sorted(map(tuple, hard_negatives.mine(extra).collect())) == brute(big)
    assert hard_negatives.mine(spark.createDataFrame(rows, ROWS)).count() > 0
    none = hard_negatives.mine(spark.createDataFrame([], ROWS))
    assert none.count() == 0
    assert none.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
