"""Cross-tokenizer alignment: tokens of two tokenizers that share bytes, and how common each linked id pair is.

1. Every text is tokenised twice and aligned (``alignment``). Its row is written with its counts and the hash of its
   groups; its links go into runs (``pair_counts``): sorted blocks of compressed (pair, document) records by radix of the
   first id, written beside the rows.
2. A task merges the blocks of one radix, or of one segment of its runs where the radix is large, by a heap, counting
   the documents of each pair; segments merge ``FAN`` at a time until one list per radix is left. Only pairs and counts
   are read for it, never documents. The last merge marks the pairs with the highest count of their first id.
3. Each segment meets its radix' list and streams contributions back: per run two arrays, one number per document. Runs
   add their arrays up and return the documents.

A hot id or pair is a few entries per run, and its records are cut into segments by bytes, so no task holds them all.

Defined results: every row is a document of its own, repeated rows too. A null or empty text, or one that a vocabulary
does not give back byte for byte behind a space, has zeros and the hash ''. Ties for the highest count are all highest.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecquery.llm import pair_counts
from vecquery.llm.alignment import aligner
from vecquery.llm.common import slices
from vecquery.sources.tables import write_stage

#: Characters aligned at once; links and documents of a run at most, but for the last slice.
SLICE_CHARS = 1_000_000
RUN_LINKS = 4_000_000
RUN_DOCUMENTS = 1 << pair_counts.DOC_BITS
#: Compressed bytes of a segment, and segments merged at once.
SEGMENT_BYTES = 16 * 1024 * 1024
FAN = 16

_DOCUMENT = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_BLOCK = [("radix", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary()), ("docs", pa.binary()), ("times", pa.binary())]
_WRITTEN = pa.schema([("run", pa.int64()), ("place", pa.int32()), *_DOCUMENT, *_BLOCK])
_DOCUMENT_DDL = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_WRITTEN_DDL = (
    f"run bigint, place int, {_DOCUMENT_DDL}, radix int, block int, first bigint, pairs binary, counts binary, docs binary, times binary"
)


def _batch(columns: dict) -> pa.RecordBatch:
    """A batch of the written table; columns not given are null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _WRITTEN], schema=_WRITTEN
    )


class _Run:
    """Links gathered until they fill a run."""

    def __init__(self, number: int):
        self.number, self.documents, self.links, self.keys = number, 0, 0, []

    def add(self, ids: pa.Array, found) -> pa.RecordBatch:
        n = len(found.n_a)
        self.keys.append(pair_counts.record_keys(found.a, found.b, found.text + self.documents))
        self.links += len(found.a)
        rows = {"run": [self.number] * n, "place": np.arange(n, dtype=np.int32) + self.documents, "doc_id": ids}
        self.documents += n
        return _batch(rows | {"n_a": found.n_a, "n_b": found.n_b, "n_groups": found.n_groups, "n_links": found.n_links, "groups_sha256": found.groups})

    def blocks(self) -> Iterator[pa.RecordBatch]:
        rows = list(pair_counts.run_blocks(np.concatenate(self.keys))) if self.links else []
        if rows:
            names = [name for name, _ in _BLOCK]
            yield _batch({"run": [self.number] * len(rows)} | {name: list(c) for name, c in zip(names, zip(*rows, strict=True), strict=True)})


def write_runs(documents: DataFrame, a_path: str, pattern: str, b_path: str) -> DataFrame:
    """The run table, stored: document rows (``place`` set) and blocks (``radix`` set) of numbered runs."""

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(a_path, pattern, b_path)
        first = TaskContext.get().partitionId() << 32
        run = _Run(first)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, j in slices([text or "" for text in texts], SLICE_CHARS):
                if run.links >= RUN_LINKS or run.documents + j - i > RUN_DOCUMENTS:
                    yield from run.blocks()
                    run = _Run(run.number + 1)
                yield run.add(batch.column("doc_id")[i:j], tool.align(texts[i:j]))
        yield from run.blocks()

    return write_stage(documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(spill, _WRITTEN_DDL), "link-runs")


def _listed(blocks: pa.Table) -> list[tuple[int, bytes, bytes]]:
    return list(zip(*(blocks[name].to_pylist() for name in ("first", "pairs", "counts")), strict=True))


def _merged_segments(blocks: DataFrame) -> DataFrame:
    """Blocks ``radix, segment, first, pairs, counts`` of every (radix, segment) as one sorted list of blocks."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        rows = [(int(p[0]), pair_counts.shrunk_sorted(p), pair_counts.shrunk(n)) for p, n in pair_counts.merged(_listed(table))]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        arrays = [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)]
        head = [pa.array([k.as_py()] * len(rows), pa.int32()) for k in key]
        return pa.table(head + arrays, names=["radix", "segment", "first", "pairs", "counts"])

    return blocks.groupBy("radix", "segment").applyInArrow(merge, "radix int, segment int, first bigint, pairs binary, counts binary")


def count_pairs(blocks: DataFrame, segments: int) -> DataFrame:
    """``radix, pairs, counts, best``, stored: all pairs of each radix in order, marked where highest of their first id.

    ``segments`` is the most that any radix has.
    """
    blocks = blocks.select("radix", "segment", "first", "pairs", "counts")
    while segments > 1:
        blocks = write_stage(_merged_segments(blocks), "pair-counts")
        segments = -(-segments // FAN)
        blocks = blocks.withColumn("segment", F.floor(F.col("segment") / FAN).cast("int"))

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        rows = [
            (key[0].as_py(), pair_counts.shrunk_sorted(p), pair_counts.shrunk(n), pair_counts.shrunk(best.astype(np.int64)))
            for p, n, best in pair_counts.with_highest(pair_counts.merged(_listed(table)))
        ]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["radix", "pairs", "counts", "best"])

    return write_stage(blocks.groupBy("radix").applyInArrow(finish, "radix int, pairs binary, counts binary, best binary"), "pair-totals")


def contributions(blocks: DataFrame, totals: DataFrame, sizes: DataFrame) -> DataFrame:
    """``run, best, total``: per run and segment, one number per document of the run in each array."""

    def add(asked: pa.Table, known: pa.Table) -> pa.Table:
        out: dict[int, list[np.ndarray]] = {}
        if asked.num_rows:
            lists = zip(*(known[name].to_pylist() for name in ("pairs", "counts", "best")), strict=True)
            lists = sorted(lists, key=lambda r: pair_counts.grown_sorted(r[0])[0])
            pairs = np.concatenate([pair_counts.grown_sorted(r[0]) for r in lists])
            count = np.concatenate([pair_counts.grown(r[1]) for r in lists])
            best = np.concatenate([pair_counts.grown(r[2]) for r in lists])
            for run, *packed in zip(*(asked[name].to_pylist() for name in ("run", "pairs", "counts", "docs", "times")), strict=True):
                at = np.searchsorted(pairs, pair_counts.grown_sorted(packed[0]))
                at = np.repeat(at, pair_counts.grown(packed[1]))
                docs, times = pair_counts.grown(packed[2]), pair_counts.grown(packed[3])
                sums = out.setdefault(run, [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)])
                top = int(docs.max()) + 1
                for i, value in enumerate((best, count)):
                    if len(sums[i]) < top:
                        sums[i] = np.pad(sums[i], (0, top - len(sums[i])))
                    np.add.at(sums[i], docs, times * value[at])
        return pa.table({
            "run": pa.array(list(out), pa.int64()),
            "best": pa.array([pair_counts.shrunk(s[0]) for s in out.values()], pa.binary()),
            "total": pa.array([pair_counts.shrunk(s[1]) for s in out.values()], pa.binary()),
        })

    group = ["radix", "segment"]
    copies = totals.join(sizes, "radix").select(
        "radix", F.explode(F.sequence(F.lit(0), F.col("segments") - 1)).alias("segment"), "pairs", "counts", "best"
    )
    return (
        blocks.select(*group, "run", "pairs", "counts", "docs", "times").groupBy(*group)
        .cogroup(copies.groupBy(*group)).applyInArrow(add, "run bigint, best binary, total binary")
    )


def align(documents: DataFrame, a_path: str, pattern: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``documents``."""
    written = write_runs(documents, a_path, pattern, b_path)
    blocks = written.filter("radix IS NOT NULL").select("run", *[name for name, _ in _BLOCK])
    size = F.sum(sum(F.octet_length(c) for c in ("pairs", "counts", "docs", "times")))
    sizes = write_stage(blocks.groupBy("radix").agg(F.ceil(size / SEGMENT_BYTES).cast("int").alias("segments")), "radix-sizes")
    most = sizes.agg(F.max("segments")).first()[0] or 1
    blocks = blocks.join(F.broadcast(sizes), "radix").withColumn(  # one row per radix
        "segment", F.pmod(F.xxhash64("run"), F.col("segments")).cast("int")
    )
    added = contributions(blocks, count_pairs(blocks, most), sizes)

    def finish(rows: pa.Table, parts: pa.Table) -> pa.Table:
        place = rows["place"].to_numpy()
        sums = [np.zeros(len(place), dtype=np.int64) for _ in range(2)]
        for values in zip(parts["best"].to_pylist(), parts["total"].to_pylist(), strict=True):
            for whole, data in zip(sums, values, strict=True):
                part = pair_counts.grown(data)
                whole[: len(part)] += part
        columns = [rows[name] for name, _ in _DOCUMENT]
        names = [name for name, _ in _DOCUMENT]
        return pa.table([*columns, pa.array(sums[0][place], pa.int64()), pa.array(sums[1][place], pa.int64())], names=[*names, "n_best", "count_sum"])

    rows = written.filter("place IS NOT NULL").select("run", "place", *[name for name, _ in _DOCUMENT])
    return (
        rows.groupBy("run").cogroup(added.groupBy("run"))
        .applyInArrow(finish, f"{_DOCUMENT_DDL}, n_best bigint, count_sum bigint")
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    )
