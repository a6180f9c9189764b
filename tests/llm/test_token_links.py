import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vecquery.llm import pair_counts, token_links
from vecquery.llm.alignment import ByteTokens, PieceTokens

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def sides():
    return ByteTokens(A, public_tokenizers.PATTERN), PieceTokens(B)


def spans(tokens, ids):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(tokens.token_bytes[i]), i))
        at = out[-1][1]
    return out


def brute(sides, rows):
    a_side, b_side = sides
    links, parts = [], []
    for _, text in rows:
        a, b = a_side.encode([text or ""])[0], b_side.encode([text or ""])[0]
        whole = [b"".join(side.token_bytes[i] for i in ids) for side, ids in ((a_side, a), (b_side, b))]
        if not text or whole != [(" " + text).encode()] * 2:
            links.append([])
            parts.append((0, 0, 0, ""))
            continue
        a, b = spans(a_side, a), spans(b_side, b)
        links.append([(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]])
        cuts = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(t[2]) for t in side if low <= t[0] < cut) for side in (a, b)))
            low = cut
        parts.append((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = collections.Counter(pair for found in links for pair in set(found))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    return [
        (i, n_a, n_b, n_groups, len(found), sum(counts[p] == best[p[0]] for p in found), sum(counts[p] for p in found), digest)
        for (i, _), found, (n_a, n_b, n_groups, digest) in zip(rows, links, parts, strict=True)
    ]


def texts(seed, n):
    draw = random.Random(seed)
    words = ["river", "Stone", "über", "漢字", "😀", "don't", "12345", "\n", "\t", "  ", "éa", "unbelievably", "-", "...", "\x00", "<s>", "<|endoftext|>", "<0x41>", "ﬁ"]
    return [(draw.choice([i, i, None]), " ".join(draw.choice(words) for _ in range(draw.randint(1, 40)))) for i in range(n)]


def run(spark, rows, parts=3):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    return sorted(map(repr, map(tuple, token_links.align(docs, A, public_tokenizers.PATTERN, B).select(*COLUMNS).collect())))


def test_byte_tokens_are_those_of_the_file(sides):
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    draw = random.Random(4)
    for _ in range(300):
        text = "".join(chr(draw.choice([draw.randrange(1, 128), draw.randrange(128, 0xD800), draw.randrange(0xE000, 0x20000)])) for _ in range(60))
        assert sides[0].encode([text])[0] == tokenizer.encode(" " + text, add_special_tokens=False).ids
    assert sides[0].encode(["<|endoftext|>"])[0] == tokenizer.encode(" <|endoftext|>", add_special_tokens=False).ids


def test_numbers_survive_compression():
    for values in ([], [0], [255, 256], [2**40, 0, 7]):
        values = np.array(values, dtype=np.int64)
        assert (pair_counts.grown(pair_counts.shrunk(values)) == values).all()
        values = np.sort(values)
        assert (pair_counts.grown_sorted(pair_counts.shrunk_sorted(values)) == values).all()


def test_blocks_of_a_run_hold_all_links(monkeypatch):
    monkeypatch.setattr(pair_counts, "BLOCK_RECORDS", 5)
    draw = np.random.default_rng(3)
    a, b, doc = draw.integers(0, 40, 900), draw.integers(0, 3, 900), draw.integers(0, 30, 900)
    got = collections.Counter()
    for radix, _, first, *packed in pair_counts.run_blocks(pair_counts.record_keys(a, b, doc)):
        pairs = pair_counts.grown_sorted(packed[0])
        per_pair, docs, times = map(pair_counts.grown, packed[1:])
        assert first == pairs[0] and len(docs) <= 5 and (pair_counts.radix_of(pairs >> pair_counts.ID_BITS) == radix).all()
        for p, d, n in zip(np.repeat(pairs, per_pair).tolist(), docs.tolist(), times.tolist(), strict=True):
            got[p >> pair_counts.ID_BITS, p & (1 << pair_counts.ID_BITS) - 1, d] += n
    assert got == collections.Counter(zip(a.tolist(), b.tolist(), doc.tolist(), strict=True))


@pytest.mark.parametrize("emit", [1, 10, 10_000])
def test_heap_merge_adds_and_marks_highest(monkeypatch, emit):
    monkeypatch.setattr(pair_counts, "EMIT_PAIRS", emit)
    draw = np.random.default_rng(emit)
    blocks, want = [], collections.Counter()
    for _ in range(12):
        pairs = np.unique(draw.integers(0, 9, 60) << pair_counts.ID_BITS | draw.integers(0, 12, 60))
        counts = draw.integers(1, 5, len(pairs))
        for p, n in zip(pairs.tolist(), counts.tolist(), strict=True):
            want[p] += n
        for i in range(0, len(pairs), 7):
            blocks.append((int(pairs[i]), pair_counts.shrunk_sorted(pairs[i : i + 7]), pair_counts.shrunk(counts[i : i + 7])))
    rows = [r for chunk in pair_counts.with_highest(pair_counts.merged(blocks)) for r in zip(*map(np.ndarray.tolist, chunk), strict=True)]
    assert [(p, n) for p, n, _ in rows] == sorted(want.items())
    top = {}
    for p, n in want.items():
        top[p >> pair_counts.ID_BITS] = max(top.get(p >> pair_counts.ID_BITS, 0), n)
    assert all(best == (n == top[p >> pair_counts.ID_BITS]) for p, n, best in rows)


@pytest.mark.parametrize(
    "limits", [{}, {"SEGMENT_BYTES": 300, "RUN_LINKS": 200, "FAN": 2, "SLICE_CHARS": 300}, {"RUN_LINKS": 1}]
)
def test_against_brute_force(spark, sides, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(token_links, name, value)
    rows = texts(7, 90)
    rows += [(500, None), (501, ""), (502, " "), (503, "a▁b"), (504, rows[0][1]), (504, rows[0][1]), (505, "x" * 3_000), (506, " " * 500)]
    rows += [(600 + i, "the very same passage, many times over") for i in range(60)]
    assert run(spark, rows) == sorted(map(repr, brute(sides, rows)))


def test_edges(spark, sides, edge_docs, no_docs):
    given = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    found = token_links.align(edge_docs, A, public_tokenizers.PATTERN, B)
    assert sorted(map(repr, map(tuple, found.select(*COLUMNS).collect()))) == sorted(map(repr, brute(sides, given)))
    assert token_links.align(no_docs, A, public_tokenizers.PATTERN, B).count() == 0
