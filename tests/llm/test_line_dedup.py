import random

import numpy as np
import pyarrow as pa
import pytest

from vecquery.llm import line_dedup
from vecquery.llm.common import packed, unpacked
from vecquery.llm.minimal_hash import PerfectHash

WHITE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows, min_chars=40, min_documents=5):
    """(id, text, lines, dropped) for (id, text) rows."""
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key_of(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = []
        for line in lines:
            ids = holders[key_of(line)]
            last = max((x for x in ids if x is not None), default=None)
            if len(key_of(line)) < min_chars or len(ids) < min_documents or i == last:
                stay.append(line)
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def result(found):
    return [tuple(r) for r in found.select("row.doc_id", "text", "n_lines", "n_dropped").collect()]


def same(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1_000, 50_000])
def test_perfect_hash_numbers_every_key_once(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
    made = PerfectHash.of_arrays(unpacked(packed(PerfectHash.build(keys).arrays())))
    assert sorted(made.index(keys).tolist()) == list(range(len(keys)))
    if n == 50_000:
        assert 8 * sum(words.nbytes for words in made.levels) < 6 * n  # bits
    others = keys + np.uint64(1)
    assert (made.index(others) < max(1, len(keys))).all()


def test_keys_left_after_the_last_level_are_numbered(monkeypatch):
    monkeypatch.setattr("vecquery.llm.minimal_hash.MOST_LEVELS", 1)
    keys = np.arange(1, 2_000, dtype=np.uint64)
    made = PerfectHash.build(keys)
    assert len(made.rest)
    assert sorted(made.index(keys).tolist()) == list(range(len(keys)))
    assert (made.index(np.array([5_000_000], dtype=np.uint64)) < len(keys)).all()


def test_colliding_hashes_and_strangers_are_told_apart():
    h = np.array([7, 7, -3, 7], dtype=np.int64)
    mark = np.array([1, 2, 1, 3], dtype=np.int32)
    shard = line_dedup.build_shard(h, mark, np.array([5, 6, 7, 8]), np.array([50, 60, 70, 80]))
    n, last = line_dedup.probe_shard(shard, np.array([7, 7, 7, -3, 7, 9]), np.array([3, 2, 1, 1, 9, 1], dtype=np.int32))
    assert n.tolist() == [8, 6, 5, 7, 0, 0]
    assert last[:4].tolist() == [80, 60, 50, 70]


def test_key_lengths_are_code_points():
    for line in ("é" * 39, "é" * 40, "x" * 39, "x" * 40, "漢" * 40, "😀" * 39, "😀" * 40, "  " + "x" * 39 + "\t ", "\xa0" + "x" * 39):
        assert (line_dedup._key_digest(line.encode(), 40) is not None) == (len(key_of(line)) >= 40)


@pytest.mark.parametrize("sizes", [{}, {"shard_keys": 8, "probe_rows": 4}])
def test_against_brute_force(spark, sizes):
    draw = random.Random(5)
    pool = [draw.choice("abÉ漢") * 20 + f" shared line number {i} of the pool " for i in range(30)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(draw.randint(0, 12)):
            line = draw.choice(pool[: draw.choice([3, 30])])
            lines.append(draw.choice([line, line.upper() if line.isascii() else line, "\t" + line + " \r", line.strip(), f"own {i} " * 8, "short", ""]))
        rows.append((draw.choice([i, i, i, 50, None]), "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, None), (503, pool[0]), (503, pool[0]), (2**40, "\n".join(pool[:3]) * 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert same(result(line_dedup.drop_shared_lines(docs, **sizes)), brute(rows))


def test_a_hot_line_and_other_limits(spark):
    line = "this very line stands in every single document of the table"
    rows = [(i, f"{line}\n{line}\nown {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert same(result(line_dedup.drop_shared_lines(docs, probe_rows=10)), brute(rows))
    assert same(result(line_dedup.drop_shared_lines(docs, min_documents=301)), brute(rows, min_documents=301))
    assert same(result(line_dedup.drop_shared_lines(docs, min_chars=3)), brute(rows, min_chars=3))


def test_edges_keep_the_row_as_it_was(spark, edge_docs, no_docs):
    more = edge_docs.withColumns({c: edge_docs["n_chars"].cast("string") for c in ("h", "mark", "dropped", "shard", "text_key", "row")})
    found = line_dedup.drop_shared_lines(more)
    assert found.select("row.*").columns == more.columns
    given = [(r["doc_id"], r["text"]) for r in more.collect()]
    assert same(result(found), brute(given))
    assert found.filter("NOT row.h <=> CAST(row.n_chars AS string)").count() == 0
    assert line_dedup.drop_shared_lines(no_docs).count() == 0
    assert isinstance(found.toArrow(), pa.Table)
