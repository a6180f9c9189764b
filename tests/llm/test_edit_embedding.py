import hashlib
import random

import numpy as np

from vecquery.llm import edit_embedding as e


def by_definition(text):
    coded, i, shown = e.codes(text), 0, []
    while i < len(coded):
        shown.append(coded[i])
        i += int(e._move[coded[i], len(shown) - 1 & e._MASK])
    level = e.level_of(len(shown))
    at = e.sampled_steps(level, e.BITS + 1)
    at = at[at < len(shown)]
    return e.written((level, len(shown), np.array([e._BIT[shown[s], s & e._MASK] for s in at], np.uint8)))


def text(draw, n):
    return "".join(draw.choice("abcdefgh é漢\n") for _ in range(n))


def test_walk_and_sample_follow_the_definition():
    draw = random.Random(1)
    texts = [text(draw, n) for n in [0, 1, 2, 5, 255, 256, 257, 3_000, *[draw.randint(1, 900) for _ in range(100)]]]
    coded = [e.codes(t) for t in texts]
    for t, c, s in zip(texts, coded, e.walk(coded), strict=True):
        made = e.fingerprint(c, s)
        assert e.written(made) == by_definition(t)
        assert e.written(e.parsed(e.written(made))) == e.written(made)


def test_samples_nest():
    for level in range(1, 9):
        fine, coarse = e.sampled_steps(level - 1, 256), e.sampled_steps(level, 128)
        assert np.isin(coarse, fine).all() and (coarse >> level == np.arange(128)).all()


def test_rows_follow_the_ring(spark):
    draw = random.Random(2)
    docs = [(i * 7, text(draw, draw.choice([0, 1, 2, 3, 40, 700]))) for i in range(60)] + [(None, "no id"), (14, None), (21, "x"), (21, "x")]
    frame = spark.createDataFrame([(*d, 1, "p") for d in docs], "doc_id bigint, text string, part int, guest string")
    for buckets in (1, 3, 50):
        got = e.fingerprints(frame, buckets).collect()
        assert len(got) == len(docs)
        keys = {(r["doc_id"], r["n_chars"]) for r in got}
        assert keys == {(i, len(t or "")) for i, t in docs}
        # between documents with different ids the order is known
        order = sorted((d for d in docs if d[0] is not None and d[0] > 21), reverse=True)
        rows = {r["doc_id"]: r for r in got}
        for (i, t), (_, n) in zip(order, order[1:]):
            edited = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
            assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert rows[i]["fingerprint"] == by_definition(t) and rows[i]["edited_fingerprint"] == by_definition(edited)
            assert rows[i]["near_next"] == e.likeness(e.parsed(by_definition(t)), e.parsed(by_definition(n)))


def test_edges(spark, edge_docs, no_docs):
    got = e.fingerprints(edge_docs, 4).collect()
    assert len(got) == edge_docs.count() and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert {r["fingerprint"] for r in got if r["doc_id"] in (4, 5)}.__len__() == 1
    assert e.fingerprints(no_docs, 4).count() == 0
    one = spark.createDataFrame([(1, "alone here")], "doc_id bigint, text string")
    row = e.fingerprints(one, 4).first()
    assert row["edited_sha256"] == hashlib.sha256(b"alone healo").hexdigest() or row["near_next"] == 1.0


def test_likeness_falls_with_edits():
    draw = random.Random(3)
    means = []
    for edits in (0, 3, 30, 10_000):
        own = []
        for _ in range(20):
            a = text(draw, 1_500)
            b = list(a)
            for _ in range(edits):
                i = draw.randrange(len(b))
                b[i : i + draw.choice([0, 1])] = draw.choice(["", "z", "q"])
            if edits == 10_000:
                b = text(draw, 1_500)
            coded = [e.codes(a), e.codes("".join(b))]
            own.append(e.likeness(*(e.fingerprint(c, s) for c, s in zip(coded, e.walk(coded), strict=True))))
        means.append(np.mean(own))
    assert means[0] == 1.0 and means[0] > means[1] > 0.8 > means[2] > means[3] and means[3] < 0.2


def test_near_pairs(spark):
    draw = random.Random(4)
    base = text(draw, 2_000)
    docs = [(i, base[: 40 * i] + "zz" + base[40 * i :]) for i in range(1, 8)] + [(100 + i, text(draw, 2_000)) for i in range(20)] + [(50, base), (51, base)]
    got = e.near_pairs(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r["doc_id"] for r in got} >= {51} and all(r["doc_id"] < 100 for r in got)
