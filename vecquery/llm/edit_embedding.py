"""Document fingerprints by a randomised edit embedding.

A text is read by a random walk that all texts share: at step s the walk shows the current character and moves on to the
next one if a random bit of (s, character) says so. The string of shown characters embeds edit distance into
Hamming distance: where two walks show the same characters again after an edit, they soon fall into step. The
fingerprint keeps a sample of the steps, one random bit of (step, character shown) each.

Steps are sampled one to a block of ``2**level`` steps, and the level grows with the text, so a fingerprint has
at most ``BITS`` bits. Blocks of a level halve into those of the level below and keep one of their two samples, so
fingerprints of different levels still have steps in common. Random bits repeat every ``PERIOD`` steps.

Likeness of two fingerprints is twice the share of equal bits less one, over the steps of the longer text; steps
past the end of the shorter one count as half equal. For search, ``bands`` takes groups of sampled bits as keys.

Defined results: a null text counts as empty; the empty text has no steps and is like itself only; equal texts have
equal fingerprints; repeated rows each get theirs. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecquery.llm.common import slices

BITS = 512
PERIOD = 4_096
_CLASSES = 64
#: Texts are walked side by side while so many are unfinished, the rest one by one.
_TOGETHER = 64
#: Bytes of text that a part should get.
PART_BYTES = 64 * 1024 * 1024
#: Bits to a band and bands to a fingerprint, for search.
BAND_BITS = 16
BANDS = 16

_draw = np.random.default_rng(20_240_229)
_move = _draw.integers(0, 2, (_CLASSES, PERIOD))
_move[:, -1] = 1  # no character is shown for longer than a period
_BIT = _draw.integers(0, 2, (_CLASSES, PERIOD)).astype(np.uint8)


def _until_move(move: np.ndarray) -> np.ndarray:
    """Steps a character is shown if it is reached at a step: up to the first moving one, that one included."""
    steps = np.arange(PERIOD)
    out = np.empty_like(move)
    for c in range(_CLASSES):
        next_ = np.minimum.accumulate(np.where(move[c] == 1, steps, PERIOD)[::-1])[::-1]
        out[c] = next_ - steps + 1
    return out


_SHOWN = _until_move(_move).astype(np.int64).ravel()
_SHOWN_ROWS = _SHOWN.reshape(_CLASSES, PERIOD).tolist()
_MASK = PERIOD - 1


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    return ((points * np.uint32(2_654_435_761)) >> np.uint32(26)).astype(np.uint8)


def walk(coded: list[np.ndarray], start: list[int] | None = None) -> list[np.ndarray]:
    """For every text the step at which each character is first shown, and the step after the last one."""
    n = np.array([len(c) for c in coded], dtype=np.int64)
    step = np.array(start if start is not None else np.zeros(len(coded)), dtype=np.int64)
    order = np.argsort(-n, kind="stable")
    n, step = n[order], step[order]
    whole = np.concatenate([*(coded[i] for i in order), np.zeros(0, np.uint8)]).astype(np.int64) * PERIOD
    first = np.cumsum(n) - n
    shown = np.zeros(len(whole), dtype=np.int64)
    active = len(n)
    t = 0
    while True:
        while active and n[active - 1] <= t:
            active -= 1
        if active < _TOGETHER:
            break
        at = first[:active] + t
        now = step[:active]
        shown[at] = now
        now += _SHOWN[whole[at] + (now & _MASK)]
        t += 1
    for i in range(active):
        j, steps = int(step[i]), []
        for c in (whole[first[i] + t : first[i] + n[i]] // PERIOD).tolist():
            steps.append(j)
            j += _SHOWN_ROWS[c][j & _MASK]
        shown[first[i] + t : first[i] + n[i]] = steps
        step[i] = j
    out: list = [None] * len(coded)
    for k, i in enumerate(order.tolist()):
        out[i] = np.append(shown[first[k] : first[k] + n[k]], step[k])
    return out


def sampled_steps(level: int, count: int) -> np.ndarray:
    """The sampled step of each of the first ``count`` blocks of a level."""
    at = np.arange(count, dtype=np.int64)
    for k in range(level, 0, -1):
        mixed = (at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93)
        at = 2 * at + (mixed >> np.uint64(63)).astype(np.int64)
    return at


def level_of(steps: int) -> int:
    return max(0, int(-(-steps // BITS) - 1).bit_length())


_sampled: dict[int, np.ndarray] = {}


def fingerprint(coded: np.ndarray, shown: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(level, steps, bits) of a walked text."""
    steps = int(shown[-1])
    level = level_of(steps)
    if level not in _sampled:
        _sampled[level] = sampled_steps(level, BITS + 1)
    at = _sampled[level]
    at = at[: np.searchsorted(at, steps)]
    which = np.searchsorted(shown, at, side="right") - 1
    return level, steps, _BIT[coded[which], at & _MASK]


def written(print_: tuple[int, int, np.ndarray]) -> str:
    """Level, steps and bits in hexadecimal digits."""
    level, steps, bits = print_
    return f"{level:02x}{steps:012x}{np.packbits(bits).tobytes().hex()}"


def likeness(a: tuple[int, int, np.ndarray], b: tuple[int, int, np.ndarray]) -> float:
    """0 to 1, from the sampled steps both levels have."""
    if a[1] == b[1] == 0:
        return 1.0
    level = max(a[0], b[0])
    longer = max(a[1], b[1])
    at = sampled_steps(level, BITS + 1)
    total = int(np.searchsorted(at, longer))
    bits = []
    for own, _, values in (a, b):
        if own < level:
            fine = sampled_steps(own, len(values))
            values = values[np.isin(fine, at, assume_unique=True)]
        bits.append(values)
    both = min(len(bits[0]), len(bits[1]))
    if not total:
        return float(a[1] == b[1] and len(bits[0]) == len(bits[1]))
    equal = int((bits[0][:both] == bits[1][:both]).sum())
    return float(min(1.0, max(0.0, (2 * equal - both) / total)))


def parsed(text: str) -> tuple[int, int, np.ndarray]:
    """A written fingerprint read back."""
    level, steps = int(text[:2], 16), int(text[2:14], 16)
    count = int(np.searchsorted(sampled_steps(level, BITS + 1), steps))
    return level, steps, np.unpackbits(np.frombuffer(bytes.fromhex(text[14:]), np.uint8))[:count]


def bands(print_: tuple[int, int, np.ndarray]) -> list[str]:
    """Keys of ``BAND_BITS`` sampled bits; the samples a band takes are drawn once for all fingerprints."""
    level, _, bits = print_
    if len(bits) < BAND_BITS:
        return [f"{level}:{bits.tobytes().hex()}"]
    draw = np.random.default_rng(level)
    return [f"{level}:{i}:{bits[draw.integers(0, len(bits), BAND_BITS)].tobytes().hex()}" for i in range(BANDS)]


def ring(documents: DataFrame, buckets: int) -> DataFrame:
    """``part, guest, doc_id, text`` such that within a part, sorted, each document is followed by its successor.

    The order is by descending id, then by a hash of the text; the first document follows the last. Parts are
    ranges of ids; the first document of a part is a guest at the end of the part before. Per part only its
    first document's id and hash go through the driver.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("doc_id").filter("doc_id IS NOT NULL")
    cuts = ids.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 0.1 / buckets) if buckets > 1 else []
    cuts = np.unique(np.array(cuts, dtype=np.float64).astype(np.int64))

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        known = ids.fillna(np.iinfo(np.int64).min).astype(np.int64).to_numpy()
        return pd.Series(np.searchsorted(cuts, known, side="left").astype(np.int32))

    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("key"), part_of("doc_id").alias("part"))
    order = F.struct(F.isnotnull("doc_id").alias("known"), "doc_id", "key")
    tops = keyed.groupBy("part").agg(F.max(order).alias("top")).orderBy("part").collect()
    if not tops:
        return keyed.select("part", F.lit(0).alias("guest"), "doc_id", "key", "text")
    hosts = [tops[(i + 1) % len(tops)]["part"] for i in range(len(tops))]
    table = documents.sparkSession.createDataFrame(
        [(t["part"], t["top"]["doc_id"], t["top"]["key"], h) for t, h in zip(tops, hosts, strict=True)],
        "part int, top_id bigint, top_key bigint, host int",
    )
    first = F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("key") == F.col("top_key"))
    places = F.array(F.struct("part", F.lit(0).alias("guest")), F.when(first, F.struct(F.col("host").alias("part"), F.lit(1).alias("guest"))))
    return (
        keyed.join(F.broadcast(table), "part")
        .select("doc_id", "key", "text", F.explode(F.array_compact(places)).alias("p"))
        .select("p.part", "p.guest", "doc_id", "key", "text")
    )


def fingerprints(documents: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text is the text with its last third replaced by the beginning of the next document's.
    """
    if buckets is None:  # as many parts as the texts' size asks for, and enough for all cores
        size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    dealt = (
        ring(documents, buckets)
        .repartition(buckets, "part")
        .sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), F.desc("key"))
    )
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            both = batch if held is None else pd.concat([held, batch], ignore_index=True)
            held = both.iloc[-1:]
            texts, parts, guests = both["text"].tolist(), both["part"].tolist(), both["guest"].tolist()
            ids = both["doc_id"].tolist()
            for a, b in slices(texts[:-1]):
                rows = _judged(texts[a : b + 1])
                keep = [i for i in range(a, b) if not guests[i] and parts[i] == parts[i + 1]]
                yield pd.DataFrame(
                    [(None if ids[i] != ids[i] else ids[i], *rows[i - a]) for i in keep],
                    columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    return dealt.mapInPandas(follow, schema)


def _judged(texts: list[str]) -> list[tuple]:
    """A row for each text but the last, each with the text behind it."""
    coded = [codes(t) for t in texts]
    shown = walk(coded)
    prints = [fingerprint(c, s) for c, s in zip(coded, shown, strict=True)]
    # the edited text shares its beginning, and with it its walk, with the text
    kept = [len(t) - len(t) // 3 for t in texts[:-1]]
    tails = [coded[i + 1][: len(texts[i]) // 3] for i in range(len(texts) - 1)]
    after = walk(tails, [int(shown[i][k]) for i, k in enumerate(kept)])
    out = []
    for i, k in enumerate(kept):
        edited = texts[i][:k] + texts[i + 1][: len(texts[i]) // 3]
        own = fingerprint(np.concatenate([coded[i][:k], tails[i]]), np.concatenate([shown[i][:k], after[i]]))
        out.append((
            len(texts[i]), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), written(prints[i]), written(own),
            likeness(prints[i], own), likeness(prints[i], prints[i + 1]),
        ))
    return out


def near_pairs(documents: DataFrame, least: float = 0.5) -> DataFrame:
    """``doc_id, first_id, likeness``: each document that shares a band with an earlier one, held against the band's first.

    A band of any size costs one row per document and is never expanded into pairs.
    """

    @F.pandas_udf("fingerprint string, bands array<string>")
    def marked(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, out = batch.fillna("").tolist(), []
            for a, b in slices(texts):
                coded = [codes(t) for t in texts[a:b]]
                out += [fingerprint(c, s) for c, s in zip(coded, walk(coded), strict=True)]
            yield pd.DataFrame({"fingerprint": [written(p) for p in out], "bands": [bands(p) for p in out]})

    @F.pandas_udf("double")
    def like(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(parsed(x), parsed(y)) for x, y in zip(a, b, strict=True)], dtype="float64")

    rows = documents.select("doc_id", "text").select("doc_id", marked("text").alias("m"))
    rows = rows.select("doc_id", "m.fingerprint", F.explode("m.bands").alias("band"))
    first = rows.groupBy("band").agg(F.min(F.struct("doc_id", "fingerprint")).alias("f"))
    met = rows.join(first, "band").filter(F.col("doc_id") > F.col("f.doc_id"))
    met = met.select("doc_id", "fingerprint", F.col("f.doc_id").alias("first_id"), F.col("f.fingerprint").alias("first")).distinct()
    return met.select("doc_id", "first_id", like("fingerprint", "first").alias("likeness")).filter(F.col("likeness") >= least)
