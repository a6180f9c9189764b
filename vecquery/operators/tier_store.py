"""Result tiers kept as a versioned table: rewritten by bucket, swapped by a manifest.

Rows are ``level, key, value, expires_us, created_us``, one per level and key, in buckets by a hash of the key. A commit reads
and writes only the buckets it changes, into a folder of its own, and then writes its manifest: which folder holds each
bucket. A reader goes by the latest manifest, so a commit that died halfway has changed nothing, and older states can still
be read. Commits carry a number (of a micro-batch, say); one that is repeated is not done again. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecquery.operators import results
from vecquery.sources.tables import remove

_MANIFEST = "number bigint, content string"


@dataclass(frozen=True)
class Manifest:
    """State after a commit: bucket -> folder, and the earliest expiry in each bucket (0: nothing there expires)."""

    number: int
    folders: dict[int, str]
    expiries: dict[int, int]

    def text(self) -> str:
        return json.dumps({"folders": self.folders, "expiries": self.expiries})

    @staticmethod
    def of_text(number: int, text: str) -> Manifest:
        content = json.loads(text)
        return Manifest(number, *({int(b): x for b, x in content[c].items()} for c in ("folders", "expiries")))


class TierStore:
    """``value_type`` is the type of a value; ``buckets`` should give buckets of some hundred megabytes and never changes."""

    def __init__(self, spark: SparkSession, path: str, value_type: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.schema = f"level string, key string, value {value_type}, expires_us bigint, created_us bigint"

    # ---- reading ----

    def _manifests(self) -> dict[int, Manifest]:
        try:
            rows = self.spark.read.schema(_MANIFEST).json(f"{self.path}/manifests/*").collect()  # one row per commit kept
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return {}
            raise
        return {r.number: Manifest.of_text(r.number, r.content) for r in rows}

    def manifest(self, before: int | None = None) -> Manifest:
        """The latest state, or the latest of a commit numbered less than ``before``."""
        known = [m for n, m in self._manifests().items() if before is None or n < before]
        return max(known, key=lambda m: m.number, default=Manifest(-1, {}, {}))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")

    def rows(self, state: Manifest | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """All rows of a state, or those of some buckets; no other file is read."""
        state = state or self.manifest()
        wanted = state.folders if buckets is None else {b: state.folders[b] for b in buckets if b in state.folders}
        paths = [f"{self.path}/{folder}/bucket={b}" for b, folder in sorted(wanted.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def buckets_of(self, keys: DataFrame) -> list[int]:
        return sorted(r[0] for r in keys.filter("key IS NOT NULL").select(self._bucket().alias("b")).distinct().collect())

    def tiers(self, levels: Sequence[str] = results.LEVELS, state: Manifest | None = None, buckets: Iterable[int] | None = None) -> list[DataFrame]:
        """One table (key, value, expires_us, created_us) per level, as lookups take them."""
        held = self.rows(state, buckets)
        return [held.filter(F.col("level") == level).drop("level") for level in levels]

    # ---- writing ----

    def commit(self, number: int, changed: Sequence[int], make: Callable[[DataFrame], DataFrame]) -> Manifest:
        """Replace the rows of the ``changed`` buckets by what ``make`` gives for them, unless ``number`` was committed before."""
        known = self._manifests()
        if number in known:
            return known[number]
        if known and number < max(known):
            raise ValueError(f"commit {number} comes after {max(known)}")
        state = self.manifest()
        folder = f"rows/{number}-{uuid.uuid4().hex}"
        folders, expiries = ({b: x for b, x in part.items() if b not in set(changed)} for part in (state.folders, state.expiries))
        if changed:
            made = make(self.rows(state, changed)).select("level", "key", "value", "expires_us", "created_us", self._bucket().alias("bucket"))
            # one bucket's rows come together before the write; a fat bucket is split over several files
            made.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
            written = self.spark.read.schema(f"{self.schema}, bucket int").parquet(f"{self.path}/{folder}")
            soonest = F.coalesce(F.min(F.when(F.col("expires_us") > 0, F.col("expires_us"))), F.lit(0))
            for r in written.groupBy("bucket").agg(soonest.alias("soonest")).collect():  # at most one row per bucket
                folders[r.bucket], expiries[r.bucket] = folder, r.soonest
        done = Manifest(number, folders, expiries)
        self.spark.createDataFrame([(number, done.text())], _MANIFEST).coalesce(1).write.json(f"{self.path}/manifests/{number}-{uuid.uuid4().hex}")
        return done

    def put(self, number: int, rows: DataFrame) -> Manifest:
        """Add rows (level, key, value, expires_us, created_us); of one level and key the one created last stays."""
        new = rows.select("level", "key", "value", "expires_us", "created_us")
        return self.commit(number, self.buckets_of(new), lambda old: results.latest_by_key(old.unionByName(new), ("level", "key")))

    def upsert(self, number: int, writes: DataFrame, default_ttls_ms: Sequence[int]) -> Manifest:
        """Writes (key, value, created_us, ttl_ms) into every level, each with its own default term."""
        return self.put(number, leveled(
            [results.latest_by_key(results.entries(writes, ttl)) for ttl in default_ttls_ms]
        ))

    def delete(self, number: int, keys: DataFrame) -> Manifest:
        """Keys leave all levels."""
        gone = keys.select("key")
        return self.commit(number, self.buckets_of(gone), lambda old: results.delete(old, gone))

    def clean_expired(self, number: int, now_us: int) -> Manifest:
        """Expired rows leave; buckets without any are not read."""
        late = [b for b, soonest in self.manifest().expiries.items() if 0 < soonest < now_us]
        return self.commit(number, late, lambda old: results.clean_expired(old, now_us))

    def vacuum(self, keep: int = 2) -> None:
        """Remove manifests but the last ``keep``, and the folders that none of those names."""
        known = sorted(self._manifests().values(), key=lambda m: m.number)
        old, live = known[:-keep], {folder for m in known[-keep:] for folder in m.folders.values()}
        for folder in {folder for m in old for folder in m.folders.values()} - live:
            remove(self.spark, f"{self.path}/{folder}")
        for m in old:
            remove(self.spark, f"{self.path}/manifests/{m.number}-*")


def leveled(tiers: Sequence[DataFrame]) -> DataFrame:
    """Tables of levels as one table with ``level``."""
    out = None
    for level, tier in zip(results.LEVELS, tiers):
        part = tier.withColumn("level", F.lit(level))
        out = part if out is None else out.unionByName(part)
    return out
