"""Counting (pair, document) records outside memory: sorted zstd runs, merged by a heap.

A record says that a document links id ``a`` with id ``b`` so many times. Records of a bounded number of links are
sorted by (radix of a, a, b, document) and cut into blocks, the rows of the run table; a block holds its pairs, the
documents of each pair, and a run's documents are numbered within the run. All blocks are compressed one by one.

Merging takes blocks by a heap of their first pairs: what lies before the first pair of every block not yet opened is
final. Pairs come out side-major, all of an ``a`` together, so its highest count is known when its last pair has come.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

#: Bits of an id and of a document's number in a run, below the radix in one 64-bit number.
ID_BITS, DOC_BITS = 20, 18
RADIX_BITS = 6
RADIXES = 1 << RADIX_BITS
#: Records of a block, and pairs that a merge collects before it emits.
BLOCK_RECORDS = 65_536
EMIT_PAIRS = 65_536
_LOW = np.uint64((1 << ID_BITS) - 1)
_KINDS = (np.uint8, np.uint16, np.uint32, np.uint64)


def shrunk(values: np.ndarray) -> bytes:
    """Compressed whole numbers, the first byte telling the width that holds them all."""
    top = int(values.max(initial=0))
    kind = next(i for i, k in enumerate(_KINDS) if top <= np.iinfo(k).max)
    return bytes([kind]) + zstandard.ZstdCompressor(level=1).compress(values.astype(_KINDS[kind]).tobytes())


def grown(data: bytes) -> np.ndarray:
    """The numbers that ``shrunk`` wrote."""
    raw = zstandard.ZstdDecompressor().decompress(data[1:])
    return np.frombuffer(raw, dtype=_KINDS[data[0]]).astype(np.int64)


def shrunk_sorted(values: np.ndarray) -> bytes:
    return shrunk(np.diff(values, prepend=0))


def grown_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(grown(data))


def radix_of(a: np.ndarray) -> np.ndarray:
    """Frequent ids lie next to each other in a vocabulary; multiplying spreads them."""
    return ((a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - RADIX_BITS)).astype(np.uint64)


def record_keys(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One sortable number per link: radix, a, b, document."""
    pair = radix_of(a) << np.uint64(2 * ID_BITS) | a.astype(np.uint64) << np.uint64(ID_BITS) | b.astype(np.uint64)
    return pair << np.uint64(DOC_BITS) | doc.astype(np.uint64)


def run_blocks(keys: np.ndarray) -> Iterator[tuple[int, int, int, bytes, bytes, bytes, bytes]]:
    """(radix, block, first pair, pairs, documents per pair, documents, links per record) of one run's links."""
    keys = np.sort(keys)
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    times = np.diff(start, append=len(keys))
    keys = keys[start]
    radix = (keys >> np.uint64(2 * ID_BITS + DOC_BITS)).astype(np.int64)
    pair = (keys >> np.uint64(DOC_BITS) & np.uint64((1 << 2 * ID_BITS) - 1)).astype(np.int64)
    doc = (keys & np.uint64((1 << DOC_BITS) - 1)).astype(np.int64)
    bounds = np.searchsorted(radix, np.arange(RADIXES + 1))
    for r in range(RADIXES):
        for block, i in enumerate(range(bounds[r], bounds[r + 1], BLOCK_RECORDS)):
            part = slice(i, min(i + BLOCK_RECORDS, bounds[r + 1]))
            pairs, per_pair = np.unique(pair[part], return_counts=True)
            yield r, block, int(pairs[0]), shrunk_sorted(pairs), shrunk(per_pair), shrunk(doc[part]), shrunk(times[part])


def merged(blocks: Iterable[tuple[int, bytes, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, counts) in order, equal pairs added up. ``blocks``: (first pair, pairs, counts)."""
    heap = [(first, i, pairs, counts) for i, (first, pairs, counts) in enumerate(blocks)]
    heapq.heapify(heap)
    open_pairs, open_counts, held = [], [], 0
    while heap:
        _, _, pairs, counts = heapq.heappop(heap)
        open_pairs.append(grown_sorted(pairs))
        open_counts.append(grown(counts))
        held += len(open_pairs[-1])
        if heap and held < EMIT_PAIRS:
            continue
        pair, count = np.concatenate(open_pairs), np.concatenate(open_counts)
        order = np.argsort(pair, kind="stable")
        pair, count = pair[order], count[order]
        start = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        pair, count = pair[start], np.add.reduceat(count, start)
        final = np.searchsorted(pair, heap[0][0]) if heap else len(pair)
        if final:
            yield pair[:final], count[:final]
        open_pairs, open_counts, held = [pair[final:]], [count[final:]], 0


def with_highest(chunks: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(pairs, counts, is highest of its a): a chunk's last ``a`` waits until another one follows."""
    pair, count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for more, more_count in chunks:
        pair, count = np.concatenate([pair, more]), np.concatenate([count, more_count])
        a = pair >> ID_BITS
        done = int(np.searchsorted(a, a[-1]))
        if done:
            yield pair[:done], count[:done], _highest(a[:done], count[:done])
        pair, count = pair[done:], count[done:]
    if len(pair):
        yield pair, count, _highest(pair >> ID_BITS, count)


def _highest(a: np.ndarray, count: np.ndarray) -> np.ndarray:
    start = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return count == np.repeat(np.maximum.reduceat(count, start), np.diff(start, append=len(a)))
