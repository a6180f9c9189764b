"""Dropping lines that many documents share, by probing sharded minimal perfect hash tables.

A line's key is the line without white space at its ends and with A-Z in lower case; keys of fewer than ``MIN_CHARS``
code points never drop. Keys are known by a 64-bit hash and a 32-bit fingerprint from the same 128-bit XXH3 value.

1. Every document row gives its distinct (hash, fingerprint) pairs, stored once.
2. Two aggregations count the documents of each key and find the largest id (copies within an id go first, so a line
   that a third of all documents hold is counted map-side).
3. Leading hash bits cut the distinct keys into shards of about ``SHARD_KEYS``. A shard becomes one row: a minimal
   perfect hash, and arrays of fingerprints, counts and largest ids in its order.
4. Documents probe these arrays: their pairs meet the shard's row in co-groups of at most about ``PROBE_ROWS`` pairs.
   A shard with more (a hot line) is copied to as many co-groups as it needs; the pairs are dealt by document. Only
   the dropped keys come back, and lines are never joined with lines.

Defined results: a document is an id; rows without an id count as one document that is smaller than every other. Rows
that share an id each lose their own lines by the same keys. A null or empty text is one empty line. A line is dropped
at all its occurrences. A document whose lines are all dropped has the empty text. Ties cannot occur, ids being distinct.
Two keys that share a 64-bit hash are told apart by the fingerprint. Extra columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecquery.llm.common import packed, unpacked
from vecquery.llm.minimal_hash import PerfectHash
from vecquery.sources.tables import write_stage

MIN_CHARS = 40
MIN_DOCUMENTS = 5
#: Distinct keys a shard should get, and pairs that one task should probe it with.
SHARD_KEYS = 16_384
PROBE_ROWS = 65_536
_ROWS_OUT = 65_536
_SPACE = b" \t\n\x0b\x0c\r"
_PAIRS = "doc_id bigint, text_key bigint, h bigint, mark int"


def _key_digest(line: bytes, min_chars: int) -> int | None:
    """128-bit hash of a line's key; none for a short one."""
    key = line.strip(_SPACE).lower()  # bytes.lower changes A-Z only
    if len(key) < min_chars or not (key.isascii() or len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
        return None
    return xxhash.xxh3_128_intdigest(key)


def _halves(digests: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and fingerprints as signed numbers."""
    raw = np.frombuffer(b"".join(d.to_bytes(16, "little") for d in digests), dtype="<i8").reshape(-1, 2)
    return raw[:, 0], (raw[:, 1] >> 32).astype(np.int32)


def line_pairs(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_key, h, mark``: distinct keys of every row; ``text_key`` tells rows with one id apart."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            rows, digests = [], []
            for i in range(batch.num_rows):
                if text[i].is_valid:
                    found = {_key_digest(line, min_chars) for line in text[i].as_buffer().to_pybytes().split(b"\n")}
                    found.discard(None)
                    digests += found
                    rows += [i] * len(found)
                if len(rows) >= _ROWS_OUT or (rows and i + 1 == batch.num_rows):
                    h, mark = _halves(digests)
                    at = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(h), pa.array(mark)],
                        names=["doc_id", "text_key", "h", "mark"],
                    )
                    rows, digests = [], []

    given = documents.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("text_key"), "text")
    return given.mapInArrow(hashed, _PAIRS)


def count_keys(pairs: DataFrame) -> DataFrame:
    """``h, mark, n, last``: documents of each key and the largest id among them."""
    return pairs.select("h", "mark", "doc_id").distinct().groupBy("h", "mark").agg(
        F.count("*").alias("n"), F.max("doc_id").alias("last")
    )


def build_shard(h: np.ndarray, mark: np.ndarray, n: np.ndarray, last: np.ndarray) -> bytes:
    """The arrays of one shard; of keys that share a hash, all but one stand in a list of their own."""
    order = np.lexsort((mark, h))
    h, mark, n, last = h[order], mark[order], n[order], last[order]
    again = np.zeros(len(h), dtype=bool)
    again[1:] = h[1:] == h[:-1]
    keys = h[~again].view(np.uint64)
    numbers = PerfectHash.build(keys)
    place = numbers.index(keys)
    arrays = {"marks": mark[~again], "counts": n[~again], "lasts": last[~again]}
    arrays = {name: values[np.argsort(place)] for name, values in arrays.items()}
    return packed(
        arrays | numbers.arrays()
        | {"more_h": h[again], "more_marks": mark[again], "more_counts": n[again], "more_lasts": last[again]}
    )


def probe_shard(shard: bytes, h: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and largest id of each (hash, fingerprint); a pair the shard does not hold counts 0."""
    arrays = unpacked(shard)
    place = PerfectHash.of_arrays(arrays).index(h.view(np.uint64))
    known = place >= 0
    known[known] = arrays["marks"][place[known]] == mark[known]
    n, last = np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=np.int64)
    n[known], last[known] = arrays["counts"][place[known]], arrays["lasts"][place[known]]
    for other, m, count, top in zip(
        *(arrays[f"more_{name}"] for name in ("h", "marks", "counts", "lasts")), strict=True
    ):
        same = (h == other) & (mark == m)
        n[same], last[same] = count, top
    return n, last


def _shard_of(shards: int) -> Column:
    """Shard by the leading bits of the hash; ``shards`` is a power of two."""
    bits = shards.bit_length() - 1
    return (F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0)).cast("bigint")


def build_shards(counts: DataFrame, shards: int) -> DataFrame:
    """``shard, arrays``: one row per shard, stored."""

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        h, mark, n = (rows[name].to_numpy() for name in ("h", "mark", "n"))
        last = rows["last"].fill_null(np.iinfo(np.int64).min).to_numpy()  # null only where all ids are: n is 1
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "arrays": pa.array([build_shard(h, mark, n, last)], pa.binary())})

    dealt = counts.select(_shard_of(shards).alias("shard"), "h", "mark", "n", "last")
    return write_stage(dealt.groupBy("shard").applyInArrow(build, "shard bigint, arrays binary"), "line-shards")


def dropped_keys(
    documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS,
    shard_keys: int = SHARD_KEYS, probe_rows: int = PROBE_ROWS,
) -> DataFrame:
    """``doc_id, text_key, dropped``: the (hash, fingerprint) pairs that a row loses, for rows that lose any."""
    pairs = write_stage(line_pairs(documents, min_chars), "line-pairs")
    counts = write_stage(count_keys(pairs), "line-counts")
    shards = 1 << max(0, (max(1, counts.count()) - 1) // shard_keys).bit_length()
    tables = build_shards(counts, shards)
    probes = pairs.withColumn("shard", _shard_of(shards))
    # one row per shard that needs several co-groups; a pair goes to one of them, the arrays to all
    parts = write_stage(
        probes.groupBy("shard").agg(F.ceil(F.count("*") / probe_rows).cast("int").alias("parts")).filter("parts > 1"), "line-parts"
    )
    probes = probes.join(parts, "shard", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("doc_id", "text_key"), F.col("parts")).cast("int"), F.lit(0))
    )
    tables = tables.join(parts, "shard", "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    )

    def probe(asked: pa.Table, shard: pa.Table) -> pa.Table:
        if not asked.num_rows or not shard.num_rows:
            return asked.select(["doc_id", "text_key", "h", "mark"]).slice(0, 0)
        n, last = probe_shard(shard["arrays"][0].as_py(), asked["h"].to_numpy(), asked["mark"].to_numpy())
        lost = n >= min_documents
        lost &= asked["doc_id"].is_null().to_numpy() | (asked["doc_id"].fill_null(0).to_numpy() != last)
        return asked.select(["doc_id", "text_key", "h", "mark"]).filter(pa.array(lost))

    group = ["shard", "part"]
    found = (
        probes.select(*group, "doc_id", "text_key", "h", "mark").groupBy(*group)
        .cogroup(tables.select(*group, "arrays").groupBy(*group)).applyInArrow(probe, _PAIRS)
    )
    return found.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("h", "mark")).alias("dropped"))


def _without(min_chars: int) -> Column:
    @F.arrow_udf("struct<text: string, n: bigint>")
    def kept(text: pa.Array, dropped: pa.Array) -> pa.Array:
        texts, counts = [], []
        for i in range(len(text)):
            if not dropped[i].is_valid:
                texts.append(None)
                counts.append(0)
                continue
            gone = {(p["h"] % (1 << 64), p["mark"] % (1 << 32)) for p in dropped[i].as_py()}
            stay, n = [], 0
            for line in text[i].as_buffer().to_pybytes().split(b"\n"):
                digest = _key_digest(line, min_chars)
                if digest is not None and (digest % (1 << 64), digest >> 96) in gone:
                    n += 1
                else:
                    stay.append(line)
            texts.append(b"\n".join(stay).decode())
            counts.append(n)
        return pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(counts, pa.int64())], ["text", "n"])

    return kept


def drop_shared_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, **sizes: int) -> DataFrame:
    """``row, text, n_lines, n_dropped`` for every row: the row as it was in a struct, its text without shared lines."""
    lost = dropped_keys(documents, min_chars, min_documents, **sizes).alias("k")
    rows = documents.select(F.struct("*").alias("row"), F.xxhash64("text").alias("text_key")).alias("d")
    same = F.col("d.row.doc_id").cast("bigint").eqNullSafe(F.col("k.doc_id")) & (F.col("d.text_key") == F.col("k.text_key"))
    met = rows.join(lost, same, "left").select("d.row", "k.dropped")
    text = F.coalesce("row.text", F.lit(""))
    # texts that lose nothing stay in the JVM
    met = met.withColumn("kept", _without(min_chars)(F.when(F.col("dropped").isNotNull(), F.col("row.text")), F.col("dropped")))
    return met.select(
        "row", F.coalesce("kept.text", text).alias("text"),
        (1 + F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))).cast("bigint").alias("n_lines"),
        F.coalesce("kept.n", F.lit(0)).cast("bigint").alias("n_dropped"),
    )
