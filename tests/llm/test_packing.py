import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vecquery.llm import packing
from vecquery.llm.tokens import WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, size):
    """Every sequence is gapless from 0 and no longer than ``size``."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_ids_equal_the_tokenizer(tokenizer):
    draw = random.Random(1)
    words = WordTokenizer(PATH)
    for _ in range(3_000):
        text = "".join(draw.choice("ab'sS,.!%()<>|@#éÉßñ ÿŷΣσςİ1 2-\n\t\x1c\xa0 ́") for _ in range(draw.randint(0, 30)))
        assert np.frombuffer(words.encoded([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    for text in ("<|endoftext|> a<|startoftext|>b", "x" * 3_000, "don't we'll I'm"):
        assert np.frombuffer(words.encoded([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_plain_texts_are_cut_as_the_tokenizer_cuts_them(tokenizer):
    words, draw = WordTokenizer(PATH), random.Random(8)
    assert words.merger
    for _ in range(400):
        text = "".join(draw.choice("abcstvremld'' ''SéÉßÀ×÷12 .,!?-<|>#\n\t\x0b\x0c") for _ in range(draw.randint(0, 60)))
        assert np.frombuffer(words.encoded([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    for text in ("a<|endoftext|>b", "", " \n", "x" * 5_000, "they've we'll it's 's 'S !'s"):
        assert np.frombuffer(words.encoded([text, "plain", text])[2], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_are_forgotten_beyond_the_bound(monkeypatch, tokenizer):
    monkeypatch.setattr("vecquery.llm.tokens.KEPT_WORDS", 3)
    words = WordTokenizer(PATH)
    for text in ("one two, three four five", "six seven one two,", "three! four five six seven"):
        assert np.frombuffer(words.encoded([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_runs_use_every_piece_once():
    draw = np.random.default_rng(0)
    for counts in (np.zeros(33, int), np.r_[0, draw.integers(0, 400, 32)], np.r_[0, np.zeros(30, int), 5, 7], np.r_[0, 1000, np.zeros(31, int)], np.r_[0, np.zeros(15, int), 900, np.zeros(16, int)]):
        used, total = np.zeros(33, int), 0
        for made, times in packing.plan_runs(counts):
            assert times > 0 and sum(c * m for c, m in made.items()) <= 32
            for c, m in made.items():
                used[c] += m * times
            total += times
        assert (used[1:] == counts[1:]).all()
        least = -(-int((np.arange(33) * counts).sum()) // 32)
        assert total <= least * 1.1 + 3


def test_fitted_patterns_make_the_plan_and_few_sequences():
    draw = np.random.default_rng(4)
    lengths = np.clip(draw.lognormal(6, 1, 30_000), 1, 2_048).astype(int)
    for some in (lengths, np.concatenate([lengths, np.ones(200_000, int), draw.integers(2, 12, 50_000)])):
        counts = np.bincount(some, minlength=2_049)
        runs = packing.plan_runs(counts)
        assert sum(times for _, times in runs) <= -(-int(some.sum()) // 2_048) * 1.001 + 2
        left = counts.copy()
        pattern = packing.patterns(512)
        fitted = packing.fitted_runs(left, 4, pattern, packing.fit_counts(pattern, packing._classes(counts, 4)), packing.SHARES[-1])
        assert sum(times for _, times in fitted) > 0.3 * sum(times for _, times in runs)


def test_fit_is_a_non_negative_least_squares_minimum():
    draw = np.random.default_rng(1)
    pattern = packing.patterns(16)
    wanted = np.r_[0, draw.integers(0, 100, 16)].astype(float)
    x = packing.fit_counts(pattern, wanted)
    weight = np.arange(17.0)
    a = np.array([np.bincount(p, weights=weight[p], minlength=17) for p in pattern]).T
    slope = a.T @ (a @ x - wanted * weight)
    assert x.min() >= 0 and slope.min() > -1 and np.abs(slope[x > 1e-6]).max() < 1


def test_edges(spark, edge_docs, no_docs, tokenizer):
    got = packing.pack_documents(edge_docs, PATH, 64).collect()
    check(got, 64)
    assert packing.pack_documents(no_docs, PATH).count() == 0
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[1]] == [(0, 0, 1, zlib.crc32(b"\0" * 4))]
    assert len(by_doc[5]) == 2 and len(by_doc[None]) == 1  # a repeated row is packed twice
    text = edge_docs.filter("doc_id = 3").first()["text"]
    ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
    parts = sorted(by_doc[3], key=lambda r: r["piece"])
    assert [r["start"] for r in parts] == list(range(0, len(ids), 64)) and sum(r["length"] for r in parts) == len(ids)
    for r in parts:
        own = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4")
        assert r["ids_crc32"] == zlib.crc32(own.tobytes())


def test_kept_ids_and_many_equal_lengths(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_ROWS", 20)
    docs = spark.createDataFrame([(i, "river stone " * (5 if i % 3 else i % 40)) for i in range(300)], "doc_id bigint, text string")
    got = packing.pack_documents(docs, PATH, 32, keep_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in got)
    rooms = []  # first fit, largest first
    for n in sorted((r["length"] for r in got), reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[fits[0]] -= n
        else:
            rooms.append(32 - n)
    assert check(got, 32) <= len(rooms) * 1.1 + 2
    assert len({(r["doc_id"], r["piece"]) for r in got}) == len(got)


def test_short_pieces_fill_exactly(spark):
    """Plans use exact lengths: as few sequences as the tokens need, and no room lost to rounding."""
    draw = np.random.default_rng(2)
    for made in ({1: 40_000}, {5: 10_000}, {2_045: 7, 3: 7}, {1: 9_000, 1_300: 500, 700: 480, 9: 3_000}, {n: int(draw.integers(1, 90)) for n in range(1, 300)}):
        counts = np.zeros(packing.SIZE + 1, dtype=np.int64)
        for n, m in made.items():
            counts[n] = m
        used = np.zeros_like(counts)
        total = 0
        for run, times in packing.plan_runs(counts):
            assert times > 0 and sum(n * m for n, m in run.items()) <= packing.SIZE
            for n, m in run.items():
                used[n] += m * times
            total += times
        assert (used == counts).all()
        least = -(-int((np.arange(packing.SIZE + 1) * counts).sum()) // packing.SIZE)
        assert total <= least * 1.001 + 1
    docs = spark.createDataFrame([(i, ("", None, "stone", "stone bridge")[i % 4]) for i in range(4_000)], "doc_id bigint, text string")
    got = packing.pack_documents(docs, PATH).collect()
    assert check(got, packing.SIZE) == -(-sum(r["length"] for r in got) // packing.SIZE)
