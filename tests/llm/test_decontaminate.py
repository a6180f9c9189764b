import random
import re

import pytest
from pyspark.sql import functions as F

from vecquery.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            b = words(t)
            n = min(size, len(b))
            for s in range(len(b) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == b[s : s + n]:
                        hit |= set(range(p, p + n))
                        found |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(hit), tuple(sorted(found)), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, size=10):
    made = d.contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), size
    )
    return sorted(
        ((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"]) for r in made.collect()), key=str
    )


@pytest.mark.parametrize("seed,size", [(1, 10), (2, 4), (3, 3)])
def test_equals_brute_force(spark, seed, size):
    draw = random.Random(seed)
    vocabulary = ["the", "of", "and", "River", "É", "x1", "stone", "ba-nk", "boat,"]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.choice([0, 1, 2, 3, 7, 14, 25])))) for i in range(12)]
    docs = []
    for i in range(40):
        text = [draw.choice(vocabulary) for _ in range(draw.randint(0, 60))]
        if i % 3 == 0:
            text[5:5] = items[draw.randrange(len(items))][1].split()
        docs.append((i, " ".join(text)))
    assert run(spark, docs, items, size) == brute(docs, items, size)


def test_edges(spark, edge_docs, no_docs):
    items = [(1, None), (2, ""), (3, "stone bridge over the water stone bridge over the water"), (3, "same words"), (4, "NO id"), (None, "no id"), (5, "...")]
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    assert run(spark, docs, items) == brute(docs, items)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert d.contamination(no_docs, bench).count() == 0
    clean = d.contamination(edge_docs, bench.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r["contaminated"] or r["n_hit"] or r["item_ids"] for r in clean)
    left = d.without_contaminated(edge_docs, bench)
    assert left.columns == edge_docs.columns and {r["doc_id"] for r in left.collect()} == {1, 2, 6, 7, 8}
    assert {r["_doc_key"] for r in left.collect()} == {None}  # a column of the rows stays what it was


def test_words_are_cut_at_every_other_ascii_character(spark):
    texts = ["".join(map(chr, range(128))) * 2, "a" + "b".join(map(chr, range(128))), "É\x80\x85ß\xa0漢 x", " \x00A\x00", "", None, "Zz9", "[a]`b{c|"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", d.words(F.col("text")).alias("w")).collect()
    assert {r["i"]: r["w"] for r in rows} == {i: None if t is None else words(t) for i, t in enumerate(texts)}


def test_candidates_join_by_shuffle_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(d, "SENT_DOCUMENTS", 1)
    items = [(1, "a b c d e f g h i j k")]
    docs = [(i, "z a b c d e f g h i j k z") for i in range(5)]
    assert run(spark, docs, items) == brute(docs, items)


def test_main_path_has_no_python(spark, edge_docs):
    bench = spark.createDataFrame([(1, "stone bridge over the water")], "item_id bigint, text string")
    plan = d.contamination(edge_docs.select("doc_id", "text"), bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "b x x a c"), (2, "a x x x x x x x x b c"), (3, "a b"), (4, "c c b q a")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "a b c")], "item_id bigint, text string")
    windows = d.item_windows(items)
    found = d.find_near(d.build_index(docs, windows), windows, span=5)
    assert {(r["doc_id"], r["item_id"], r["pos"]) for r in found.collect()} == {(1, 7, 0), (4, 7, 0), (4, 7, 1)}
