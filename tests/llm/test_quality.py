import random

import numpy as np
from pyspark.sql import functions as F

from vecquery.llm import quality
from vecquery.llm.common import Sample, labelled_ids, labelled_sample
from tests.llm.conftest import DOCS, rows


def prose(draw, n):
    return " ".join(draw.choice("the river ran under a stone bridge where boats came home in spring".split()) + draw.choice(["", "s", "ly", "ed"]) for _ in range(n))


def junk(draw, n):
    return " ".join(draw.choice("WIN BUY NOW FREE $$$ !!! ### CLICK".split()) + draw.choice(["!!", "%%%", "***"]) for _ in range(n))


def texts(seed, n):
    draw = random.Random(seed)
    labels = np.array([i % 2 for i in range(n)])
    return [prose(draw, 60) if y else junk(draw, 60) for y in labels], labels


def test_held_out_texts_are_told_apart():
    own, labels = texts(1, 240)
    model = quality.fit(Sample(own, labels, (120, 120)))
    new, y = texts(2, 100)
    assert ((quality.scores(model, new) >= 0.5) == (y == 1)).mean() > 0.97


def test_scores_are_shares_without_labels(edge_docs, no_docs, no_labels):
    model = quality.train(edge_docs, no_labels, F.lit(True))
    got = quality.score_documents(edge_docs, model).collect()
    assert len(got) == edge_docs.count() and {r["score"] for r in got} == {0.5}
    assert quality.score_documents(no_docs, model).count() == 0
    assert quality.train(no_docs, no_labels, F.lit(True)).prior == 0.5


def test_edges_with_a_model(edge_docs):
    own, labels = texts(1, 240)
    model = quality.fit(Sample(own, labels, (60, 180)))
    got = {(r["doc_id"]): r["score"] for r in quality.score_documents(edge_docs, model).collect()}
    assert got[1] == got[2] == 0.75 and all(0 <= s <= 1 for s in got.values())


def test_sample_is_bounded_and_leaves_out_the_rest(spark):
    docs = spark.createDataFrame(rows(*[(i, f"text number {i % 90}") for i in range(400)], (401, None), (None, "x")), DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)] + [(3, 0, 0), (5, None, 0), (401, 1, 0)], "doc_id bigint, quality int, toxic int")
    usable = F.col("doc_id") % 5 != 0
    known = {r["doc_id"] for r in labelled_ids(labels, "quality", usable).collect()}
    assert 3 not in known and all(i % 5 for i in known)  # 3 has two labels
    got = labelled_sample(docs, labels, "quality", usable, (20, 10), 10_000)
    n = np.bincount(got.labels)  # copies of a text count once
    assert 10 < n[0] <= 20 and 5 < n[1] <= 10 and len(set(got.texts)) == n.sum()
    small = labelled_sample(docs, labels, "quality", usable, (20, 10), 100)
    assert sum(map(len, small.texts)) <= 100


def test_held_out_rows(spark):
    import zlib

    got = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", quality.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
