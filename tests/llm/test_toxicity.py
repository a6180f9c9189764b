import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from vecquery.llm import string_kernel, toxicity
from vecquery.llm.common import Sample
from tests.llm.conftest import DOCS, rows

BAD = ["blorgan", "fremzul", "quintash", "drabnok", "skelvit"]
STEM = "the river ran under stone bridge where boats came home spring water light morning".split()


def clean(draw, n=40):
    return [draw.choice(STEM) + draw.choice(["", "s", "ly", "er", "ing"]) for _ in range(n)]


def sample(seed, n=400):
    draw = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = clean(draw)
        if i % 4 == 0:
            for _ in range(draw.choice([1, 2, 3])):
                words.insert(draw.randrange(len(words)), draw.choice(BAD))
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    return texts, np.array(labels)


def test_kernel_by_definition():
    words = ["blorgan", "blxorgan", "organ", "ab", "", "aaaa", "éblorganú"]
    k = string_kernel.kernel(words, string_kernel.landmarks(words))

    def describe(w):
        out = {}
        for t in combinations(range(len(w)), 3):
            if t[-1] - t[0] < string_kernel.SPAN:
                key = "".join(w[i] for i in t)
                out.setdefault(key, []).append(string_kernel.DECAY ** (t[-1] - t[0] + 1))
        return out

    for i, a in enumerate(map(describe, words)):
        for j, b in enumerate(map(describe, words)):
            dot = sum(sum(a[s]) * sum(b[s]) for s in a if s in b)
            norm = np.prod([np.sqrt(sum(v * v for vs in d.values() for v in vs)) for d in (a, b)])
            want = (dot / norm) ** string_kernel.POWER if norm else 0
            assert abs(k[i, j] - want) < 1e-4


def test_held_out_texts_and_disguises():
    texts, labels = sample(1)
    model = toxicity.fit(Sample(texts, labels, (300, 100)))
    new, y = sample(2)
    assert (((toxicity.scores(model, new) >= 0.3) == (y == 1)).mean()) > 0.98
    quiet = " ".join(clean(random.Random(5)))
    told = toxicity.scores(model, [quiet, f"{quiet} blor-gan", f"{quiet} f r e m z u l", f"{quiet} QUINTASH!!", f"{quiet} drabx" + "nok"])
    assert told[0] < 0.3 and (told[1:4] >= 0.3).all() and told[4] > told[0]


def test_many_insults_plain_split_and_with_a_character_put_in():
    draw = random.Random(9)
    syllables = [a + b for a in "bcdfgklmnprstvz" for b in "aeiou"]
    insults = list({"".join(draw.choice(syllables) for _ in range(draw.choice([2, 3, 3, 4]))) + draw.choice("kxtn") for _ in range(300)})
    texts, labels = [], []
    for i in range(6_000):
        own = clean(draw, 25)
        if i % 3 == 0:
            own.insert(draw.randrange(len(own)), draw.choice(insults))
        texts.append(" ".join(own))
        labels.append(int(i % 3 == 0))
    model = toxicity.fit(Sample(texts, np.array(labels), (4_000, 2_000)))

    def recall(disguise):
        asked = [" ".join([*clean(draw, 12), disguise(w), *clean(draw, 12)]) for w in insults]
        return (toxicity.scores(model, asked) >= 0.3).mean()

    def put_in(word):
        at = draw.randint(2, len(word) - 2)
        return word[:at] + draw.choice("x1") + word[at:]

    def apart(word):
        at = draw.randint(2, len(word) - 2)
        return word[:at] + " " + word[at:]

    got = recall(lambda w: w), recall(put_in), recall(apart)
    quiet = (toxicity.scores(model, [" ".join(clean(draw, 25)) for _ in range(1_000)]) >= 0.3).mean()
    assert got[0] >= 0.95 and got[1] >= 0.9 and got[2] >= 0.9 and quiet <= 0.01, (got, quiet)


def test_landmarks_cover_every_toxic_word():
    draw = random.Random(4)
    bad = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 30))) for _ in range(600)]
    near = toxicity.covering(bad)
    pieces = [p for w in bad for p in toxicity._pieces(w)]
    assert (string_kernel.kernel(pieces, string_kernel.landmarks(near)).max(axis=1) >= toxicity.NEAR - 1e-3).all()
    assert len(near) < len(set(pieces)) and toxicity.covering([]) == []


def test_toxic_words_are_found():
    texts, labels = sample(3)
    copy = "once only said wrenkilt blorgan " + " ".join(clean(random.Random(1)))
    bad, good = toxicity.toxic_words([*texts, *[copy] * 30], np.array([*labels, *[1] * 30]))
    assert set(BAD) <= set(bad) and "wrenkilt" not in bad and not set(bad) & set(good)


def test_edges(spark, edge_docs, no_docs, no_labels):
    model = toxicity.train(edge_docs, no_labels, F.lit(True))
    assert {r["s"] for r in edge_docs.select(toxicity.score_column(model).alias("s")).collect()} == {0.0}
    texts, labels = sample(1)
    model = toxicity.fit(Sample(texts, labels, (300, 100)))
    got = edge_docs.select("doc_id", toxicity.score_column(model).alias("s")).collect()
    by_id = {r["doc_id"]: r["s"] for r in got}
    assert len(got) == edge_docs.count() and all(0 <= s <= 0.3 for s in by_id.values()) and by_id[1] == by_id[2]
    assert no_docs.select(toxicity.score_column(model)).count() == 0
    far = spark.createDataFrame(rows((1, "x" * 40_000 + "blorgan" + "y" * 40_000), (2, "word " * 50_000 + "blorgan skelvit fremzul")), DOCS)
    assert far.select(toxicity.score_column(model).alias("s")).filter("s >= 0.3").count() >= 1


def test_held_out_rows(spark):
    import zlib

    got = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
