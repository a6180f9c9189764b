import base64
import random
from collections import Counter

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from vecquery.llm import rollups
from vecquery.sources.tables import new_path

COUNTS = "source string, lang string, tokenizer string, n_tokens bigint, new_tokens bigint, sign string"


def totals(rollup):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect()}


def test_batches_in_any_number_give_the_same_totals(spark):
    draw = random.Random(1)
    rows = [(draw.choice(["a", "b", None]), draw.choice(["en", None]), draw.choice(["v1", "v2"]), draw.randint(0, 50), draw.randint(0, 50), "x") for _ in range(200)]
    counts = spark.createDataFrame(rows, COUNTS)
    gone = spark.createDataFrame([(*r[:3], r[4], 0, "x") for r in rows[:60]], COUNTS)
    want = {}
    for r in rows[60:]:
        n, t = want.get(r[:3], (0, 0))
        want[r[:3]] = (n + 1, t + r[4])
    for compact_after in (None, 1, 2, 3):
        made = rollups.Rollup(spark, new_path(spark, "test-rollup"))
        steps = [(1, rollups.inserts(counts)), (2, rollups.revisions(counts)), (3, rollups.deletes(gone))]
        for number, changes in steps:
            made.commit(number, changes)
            made.commit(number, changes)
            if compact_after == number:
                made.compact()
                made.commit(number, changes)
        made.commit(2, rollups.revisions(counts))
        assert totals(made) == want
        made.compact()
        assert totals(made) == want


def test_a_folder_opened_again_has_the_same_state(spark):
    path = new_path(spark, "test-rollup")
    rows = spark.createDataFrame([("a", "en", "v1", 7, 9, "x"), ("b", "en", "v1", 5, 5, "x")], COUNTS)
    made = rollups.Rollup(spark, path)
    made.commit(1, rollups.inserts(rows))
    made.compact()
    made.commit(2, rollups.inserts(rows.limit(1)))
    want = totals(made)
    again = rollups.Rollup(spark, path)
    assert totals(again) == want == {("a", "en", "v1"): (2, 14), ("b", "en", "v1"): (1, 5)}
    for batch in (1, 2):  # delivered again after the restart: one from the snapshot, one behind it
        again.commit(batch, rollups.inserts(rows))
    assert totals(again) == want
    again.commit(3, rollups.deletes(rows.limit(1)))
    assert totals(rollups.Rollup(spark, path)) == {("a", "en", "v1"): (1, 7), ("b", "en", "v1"): (1, 5)}


def test_a_commit_that_dies_changes_nothing(spark, monkeypatch):
    path = new_path(spark, "test-rollup")
    rows = spark.createDataFrame([("a", "en", "v1", 7, 9, "x")], COUNTS)
    made = rollups.Rollup(spark, path)
    made.commit(1, rollups.inserts(rows))
    monkeypatch.setattr(made, "_record", lambda *_: 1 / 0)
    for step in (lambda: made.commit(2, rollups.inserts(rows)), made.compact):
        try:
            step()
        except ZeroDivisionError:
            pass
    again = rollups.Rollup(spark, path)
    assert totals(again) == {("a", "en", "v1"): (1, 7)}
    again.commit(2, rollups.inserts(rows))
    assert totals(again) == {("a", "en", "v1"): (2, 14)}


def test_edges(spark):
    made = rollups.Rollup(spark, new_path(spark, "test-rollup"))
    assert totals(made) == {}
    none = spark.createDataFrame([], COUNTS)
    made.commit(1, rollups.inserts(none))
    made.compact()
    assert totals(made) == {}
    one = spark.createDataFrame([("a", "en", "v1", 7, 9, "x")] * 2, COUNTS)
    made.commit(2, rollups.inserts(one))
    assert totals(made) == {("a", "en", "v1"): (2, 14)}
    made.commit(3, rollups.deletes(one))
    assert totals(made) == {}


def test_counts_equal_the_tokenizers(spark, edge_docs, no_docs):
    path = public_tokenizers.path
    word = Tokenizer.from_file(path("word_bpe_49k.json"))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path("byte_bpe_50k.tiktoken"), "rb"))}
    byte = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    columns = [
        rollups.word_counts(path("word_bpe_49k.json")).alias("w"),
        rollups.byte_counts(path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).alias("b"),
    ]
    got = Counter((r["text"], r["w"], r["b"]) for r in edge_docs.select("text", *columns).collect())
    texts = [r["text"] for r in edge_docs.select("text").collect()]
    assert got == Counter((t, len(word.encode(t or "", add_special_tokens=False).ids), len(byte.encode_ordinary(t or ""))) for t in texts)
    assert no_docs.select(*columns).count() == 0
