"""A nearest-neighbour graph as a table, and search along its edges.

The vectors are dealt by a hash of their id into shards of bounded size, and edges stay inside a shard. ``build_graph`` makes each
shard's edges in one task: it starts from vectors that share a hash bucket and improves by the neighbours of neighbours.
``search_graph`` brings blocks of queries to shelves of a few shards and walks each shard from a few entry vectors to ever nearer
ones; only the best hits of a query leave a shelf. Neither looks at all pairs, and what is shuffled are vectors and hits, never the
(query, vector) pairs that a walk compares.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecquery.operators import blocks, search
from vecquery.sources.tables import write_stage

#: Edges of a vector (fixed value: links per node of the reference's graph index is 32).
EDGES = 32
#: Vectors of a starting group; best forward and reverse neighbours that meet at a vector; rows given to one call.
GROUP_ROWS = 128
FAN_OUT = 12
CALL_ROWS = 50_000
#: Improving ends after so many rounds, or when fewer than this share of the edges changed.
ROUNDS = 6
LEAST_CHANGE = 0.01
#: A search starts from so many vectors, keeps so many best ones and follows so many of them at a time.
ENTRIES, BEAM, STEP = 32, 64, 16
#: Vectors of a shard (about; with this beam recall@5 fell under 0.9 in one shard of 51,282), queries that meet one in a task,
#: and queries that walk side by side, at most.
SHARD_ROWS = 16_384
QUERY_ROWS = 65_536
WALKERS = 64
#: Shards that a block of queries walks in one task, one after the other; only the best hits over all of them leave it.
SHELF_SHARDS = 4

_EDGE = "vec_id bigint, neighbor bigint, dot double, rank int, shard int"
_WALKED = "query_id bigint, vec_id bigint, dot double, n_scored bigint"


def _pairs_inside(owner: np.ndarray, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray, keep: int) -> pa.Table:
    """For rows of one owner each: the ``keep`` best others of every row that beat the row's worst edge."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, dtype=np.int64)
    size = np.diff(start, append=len(owner))
    for n in np.unique(size[size > 1]).tolist():
        groups = start[size == n][:, None] + np.arange(n)
        for i in range(0, len(groups), max(1, 2_000_000 // (n * n))):
            rows = groups[i : i + max(1, 2_000_000 // (n * n))]
            points = vectors[rows]
            dots = points @ points.transpose(0, 2, 1)
            dots[ids[rows][:, :, None] == ids[rows][:, None, :]] = -np.inf
            top = np.argpartition(-dots, min(keep, n - 1) - 1, axis=2)[:, :, :keep]
            best = np.take_along_axis(dots, top, axis=2)
            g, a, b = np.nonzero(best > floor[rows][:, :, None])
            out.append((ids[rows[g, a]], ids[rows[g, top[g, a, b]]], best[g, a, b]))
    a, b, dot = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.table({"vec_id": pa.array(a), "neighbor": pa.array(b), "dot": pa.array(dot)})


class _Edges:
    """The best edges of vectors 0 to n - 1 so far, best first; empty places have the neighbour -1."""

    def __init__(self, n: int, edges: int):
        self.neighbor = np.full((n, edges), -1, dtype=np.int64)
        self.dot = np.full((n, edges), -np.inf)

    def add(self, found: pa.Table) -> int:
        """Take in candidate edges; how many of them are among the best now."""
        n, edges = self.neighbor.shape
        a, b, dot = (found[c].to_numpy() for c in ("vec_id", "neighbor", "dot"))
        rows = np.unique(a)
        held = self.neighbor[rows] >= 0
        key = np.concatenate([np.repeat(rows, held.sum(axis=1)) * n + self.neighbor[rows][held], a * n + b])
        dot = np.concatenate([self.dot[rows][held], dot])
        key, first = np.unique(key, return_index=True)  # the first one of a pair, which is the held one
        a, b, dot, new = key // n, key % n, dot[first], first >= held.sum()
        order = np.lexsort((b, -dot, a))
        a, b, dot, new = a[order], b[order], dot[order], new[order]
        place = np.arange(len(a)) - np.searchsorted(a, a, side="left")
        best = place < edges
        self.neighbor[a[best], place[best]], self.dot[a[best], place[best]] = b[best], dot[best]
        return int(new[best].sum())

    def meet(self, owner: np.ndarray, member: np.ndarray, vectors: np.ndarray, keep: int) -> int:
        """Candidates among the members of an owner, some owners (in ascending order) at a time."""
        floor, changed, start = self.dot[:, -1].copy(), 0, 0
        while start < len(owner):
            end = min(len(owner), start + CALL_ROWS)
            end = int(np.searchsorted(owner, owner[end], side="left")) if end < len(owner) else end
            end = end if end > start else int(np.searchsorted(owner, owner[start], side="right"))
            some = member[start:end]
            changed += self.add(_pairs_inside(owner[start:end], some, vectors[some], floor[some], keep))
            start = end
        return changed


def _first_of_each(of: np.ndarray, values: np.ndarray, most: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Of the values of each ``of``, ``most`` taken at random."""
    mixed = rng.permutation(len(of))
    order = mixed[np.argsort(of[mixed], kind="stable")]
    of, values = of[order], values[order]
    kept = np.arange(len(of)) - np.searchsorted(of, of, side="left") < most
    return of[kept], values[kept]


def _shard_edges(vectors: np.ndarray, edges: int, rounds: int) -> _Edges:
    """Groups inside hash buckets of four bands first, a bucket of any size cut into groups of ``GROUP_ROWS``; then neighbours of neighbours."""
    n, dim = vectors.shape
    made, rng = _Edges(n, edges), np.random.default_rng(42)
    bits = max(1, (max(1, n // GROUP_ROWS)).bit_length() - 1)
    side = (vectors @ search.plane_signs(4 * bits, dim).T >= 0).reshape(n, 4, bits) @ (1 << np.arange(bits, dtype=np.int64))
    for band in range(4):
        mixed = rng.permutation(n)
        order = mixed[np.argsort(side[mixed, band], kind="stable")]
        code = side[order, band]
        place = np.arange(n) - np.searchsorted(code, code, side="left")
        owner = np.cumsum(np.diff(code * n + place // GROUP_ROWS, prepend=-1) != 0)
        made.meet(owner, order, vectors, edges)
    every = np.arange(n)
    for _ in range(rounds):
        owner, to = np.repeat(every, edges), made.neighbor.ravel()
        there = to >= 0
        back_of, back = _first_of_each(to[there], owner[there], FAN_OUT, rng)
        near = made.neighbor[:, :FAN_OUT]
        key = [every * n + every, (every[:, None] * n + near)[near >= 0], back_of * n + back]
        key = np.unique(np.concatenate(key))
        if made.meet(key // n, key % n, vectors, FAN_OUT) < LEAST_CHANGE * edges * n:
            break
    return made


def build_graph(index: DataFrame, edges: int = EDGES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, neighbor, dot, rank, shard``, stored: about the ``edges`` nearest vectors of every vector in its shard.

    ``index``: vec_id, unit_vec with distinct ids. An index of up to ``SHARD_ROWS`` vectors is one shard. In a round every vector
    brings together its ``FAN_OUT`` best neighbours and ``FAN_OUT`` vectors that have it as one, chosen at random from a fixed
    seed, so a vector that is everybody's neighbour gets no more work than others. A shard of one vector has no edges.
    """
    shards = max(1, -(-index.count() // SHARD_ROWS))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        ids, first = np.unique(table["vec_id"].to_numpy(), return_index=True)
        made = _shard_edges(blocks.to_matrix(table["vec"])[first], edges, rounds)
        a, place = np.nonzero(made.neighbor >= 0)
        return pa.table({
            "vec_id": ids[a], "neighbor": ids[made.neighbor[a, place]], "dot": made.dot[a, place],
            "rank": (place + 1).astype(np.int32), "shard": np.full(len(a), key[0].as_py(), dtype=np.int32),
        })

    # a task for each shard: shards are small in bytes, so that a plan by bytes would put several into one task
    dealt = index.select(_shard(shards), "vec_id", F.col("unit_vec").alias("vec")).repartitionById(shards, "shard")
    return write_stage(dealt.groupBy("shard").applyInArrow(build, _EDGE), "graph")


def _shard(shards: int):
    return F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")


def _both_ways(neighbor_of: np.ndarray, neighbor: np.ndarray, n: int) -> np.ndarray:
    """(n, up to 2 x EDGES) vectors at the other end of an edge of either direction, chosen at random where there are more; n where fewer."""
    key = np.unique(np.concatenate([neighbor_of * n + neighbor, neighbor * n + neighbor_of]))
    a, b = _first_of_each(key // n, key % n, 2 * EDGES, np.random.default_rng(42))
    place = np.arange(len(a)) - np.searchsorted(a, a, side="left")
    ends = np.full((n, int(place.max()) + 1 if len(a) else 1), n, dtype=np.int32)
    ends[a, place] = b
    return ends


def _rough(rows: np.ndarray) -> np.ndarray:
    """In single precision, and by a power of two so long that products of two such rows neither overflow nor vanish."""
    longest = np.abs(rows).max(initial=0.0, where=np.isfinite(rows))
    return np.ldexp(rows, -np.frexp(longest)[1]).astype(np.float32)


class _Shard:
    """A shard's vectors and edges, and what walks need besides: single precision chooses the way, the kept are scored in double precision."""

    def __init__(self, shard: pa.Table):
        self.ids, first, self.copies = np.unique(shard["vec_id"].to_numpy(), return_index=True, return_counts=True)
        self.vectors = blocks.to_matrix(shard["vec"])[first]
        self.copies = self.copies if (self.copies > 1).any() else None  # every row of an id counts as compared
        lists = shard["neighbors"].combine_chunks().take(pa.array(first))
        there = np.repeat(np.arange(len(self.ids)), lists.value_lengths().fill_null(0).to_numpy())
        self.ends = _both_ways(there, np.searchsorted(self.ids, lists.flatten().to_numpy()), len(self.ids))
        self.rough = _rough(self.vectors)
        self.met_at = np.empty(WALKERS * (len(self.ids) + 1), dtype=np.int32)


_NONE = np.uint64(2**64 - 1)


def _ranked(dot: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers whose order is that of falling dots and rising places: 32 bits of the dot, 31 of the place, and one for a followed vector."""
    bits = (np.fmax(dot, -np.inf) + np.float32(0)).view(np.uint32)  # not a number is last, -0.0 is 0.0
    falling = np.where(bits >> 31, bits, ~bits & np.uint32(2**31 - 1))
    return falling.astype(np.uint64) << np.uint64(32) | place.astype(np.uint64) << np.uint64(1)


def _place_of(ranked: np.ndarray) -> np.ndarray:
    return (ranked >> np.uint64(1) & np.uint64(2**31 - 1)).astype(np.int64)


def _walk(shard: _Shard, queries: np.ndarray, keep: int, beam: int, step: int, entries: int):
    """(places, dots, number of compared rows): the ``keep`` best vectors that each query's walk meets, best first; a place past the end is none.

    At most ``WALKERS`` queries walk side by side. A met vector is marked in one flat table, and a kept one is one number that
    holds its dot, its place and whether it was followed, so that the few new vectors that are better than the worst kept one cost one sort.
    """
    n, walkers = len(shard.vectors), len(queries)
    asked, every_walker = _rough(queries), np.arange(walkers + 1)
    start = np.sort(np.random.default_rng(42).permutation(n)[:entries])
    seen = np.zeros((walkers, n + 1), dtype=bool)
    seen[:, n] = True  # where an edge is missing
    seen[:, start] = True
    seen, scored = seen.ravel(), np.zeros(walkers, dtype=np.int64)
    kept = np.full((walkers, keep), _NONE)
    row, col = np.repeat(every_walker[:-1], len(start)), np.tile(start, walkers)
    while len(row):
        cut, far = np.searchsorted(row, every_walker).tolist(), np.empty(len(row), dtype=np.float32)
        for w in range(walkers):
            if cut[w] < cut[w + 1]:
                np.dot(shard.rough.take(col[cut[w] : cut[w + 1]], axis=0), asked[w], out=far[cut[w] : cut[w + 1]])
        scored += np.diff(cut) if shard.copies is None else np.bincount(row, shard.copies.take(col), walkers).astype(np.int64)
        new = _ranked(far, col)
        good = np.flatnonzero(new < kept[:, -1].take(row))
        row, new = row.take(good), new.take(good)
        cut = np.searchsorted(row, every_walker)
        wide = np.full((walkers, keep + int(np.diff(cut).max())), _NONE)
        wide[:, :keep] = kept
        wide.ravel()[row * wide.shape[1] + keep + np.arange(len(row)) - cut.take(row)] = new
        kept = np.sort(wide, axis=1)[:, :keep]
        row = row[:0]
        while not len(row):
            walker, at = np.nonzero(kept[:, :beam] & np.uint64(1) == 0)
            if not len(walker):
                break
            now = np.flatnonzero(np.arange(len(walker)) - np.searchsorted(walker, walker, side="left") < step)
            walker, at = walker.take(now), at.take(now)
            ahead = shard.ends.take(_place_of(kept[walker, at]), axis=0)
            kept[walker, at] |= np.uint64(1)
            key = (ahead + (walker * (n + 1))[:, None]).ravel()
            new = np.flatnonzero(~seen.take(key))
            key, number = key.take(new), np.arange(len(new), dtype=np.int32)
            shard.met_at[key] = number
            once = np.flatnonzero(shard.met_at.take(key) == number)  # one of the edges that lead to a vector
            key = key.take(once)
            seen[key] = True
            row = walker.take(new.take(once) // ahead.shape[1])
            col = key - row * (n + 1)
    place, dots = _place_of(kept), np.full(kept.shape, -np.inf)
    walker, at = np.nonzero(place < n)
    dots[walker, at] = np.einsum("ij,ij->i", queries[walker], shard.vectors[place[walker, at]])
    order = np.lexsort((place, -dots), axis=1)
    return np.take_along_axis(place, order, axis=1), np.take_along_axis(dots, order, axis=1), scored


def search_graph(
    index: DataFrame, graph: DataFrame, queries: DataFrame, k: int, beam: int = BEAM, step: int = STEP, entries: int = ENTRIES
) -> tuple[DataFrame, DataFrame]:
    """(hits, ``query_id, n_scored``: how many vectors each query was compared with, over all shards).

    In every shard a query keeps its ``beam`` best vectors; each round follows the edges, in both directions, of the ``step`` best
    not yet followed, and the walk ends when all of the beam have been. A wider beam finds more.
    """
    spark = index.sparkSession
    queries = queries.select("query_id", "vec")
    shards = (graph.agg(F.max("shard")).first()[0] or 0) + 1
    n_queries = queries.count()
    cores = spark.sparkContext.defaultParallelism
    shelves = -(-shards // SHELF_SHARDS)
    # no fewer blocks than there are cores
    parts = max(1, -(-n_queries // QUERY_ROWS), min(-(-2 * cores // shelves), -(-n_queries // WALKERS)))
    lists = graph.groupBy("vec_id").agg(F.collect_list("neighbor").alias("neighbors"))
    # a task for each block, which is a shelf and a part of the queries
    left = index.select(_shard(shards), "vec_id", F.col("unit_vec").alias("vec")).join(lists, "vec_id", "left").select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda part: part * shelves + F.col("shard") % shelves)).alias("block"),
        "shard", "vec_id", "vec", "neighbors",
    ).repartitionById(parts * shelves, "block")
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")
    right = queries.select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(shelves - 1)), lambda shelf: part * shelves + shelf)).alias("block"), "query_id", "vec"
    ).repartitionById(parts * shelves, "block")

    def walk(shelf: pa.Table, asked: pa.Table) -> pa.Table:
        query_ids, of = asked["query_id"].to_numpy(), shelf["shard"].to_numpy()
        points, scored = blocks.to_matrix(asked["vec"]), np.zeros(len(query_ids), dtype=np.int64)
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))  # position of the query, vec_id, dot: at most k each
        for number in np.unique(of).tolist() if len(query_ids) else ():
            shard, found = _Shard(shelf.filter(pa.array(of == number))), [held]
            for i in range(0, len(query_ids), WALKERS):
                place, dot, scored_here = _walk(shard, points[i : i + WALKERS], max(beam, k), beam, step, entries)
                row, at = np.nonzero(place[:, :k] < len(shard.ids))
                found.append((row + i, shard.ids[place[row, at]], dot[row, at]))
                scored[i : i + WALKERS] += scored_here
            query, vec, dot = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.lexsort((vec, -dot, query))
            query, vec, dot = query[order], vec[order], dot[order]
            best = np.arange(len(query)) - np.searchsorted(query, query, side="left") < k
            held = (query[best], vec[best], dot[best])
        query, vec, dot = held
        met = query_ids if len(of) else query_ids[:0]
        return pa.table({
            "query_id": np.concatenate([query_ids[query], met]),
            "vec_id": pa.concat_arrays([pa.array(vec), pa.nulls(len(met), pa.int64())]),
            "dot": pa.concat_arrays([pa.array(dot), pa.nulls(len(met), pa.float64())]),
            "n_scored": pa.concat_arrays([pa.nulls(len(query), pa.int64()), pa.array(scored[: len(met)])]),
        })

    walked = write_stage(left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(walk, _WALKED), "walked")
    hits = walked.filter("vec_id IS NOT NULL").groupBy("query_id", "vec_id").agg(F.max("dot").alias("dot"))
    return search.rank_hits(hits, k), walked.filter("vec_id IS NULL").groupBy("query_id").agg(F.sum("n_scored").alias("n_scored"))
