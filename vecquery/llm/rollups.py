"""Token counts in rollups that deltas maintain.

A change says that a document's count enters (+1) or leaves (-1) the totals of its source, language and tokenizer
version; a revised count leaves with its old value and enters with the new one. A batch of changes is summed up and written
to a folder of its own in the shared folder, and then named by a row that is the commit; a batch whose number has such a
row is not written again, so one that is retried or delivered twice counts once. Totals are sums over the folders, and ``compact`` folds
committed batches into one snapshot without changing them.

Changes are summed before anything is shuffled, so a source with a third of all rows is a few rows per task.

Defined results: a null text counts as empty (no tokens); null sources and languages are groups of their own; groups
whose documents have all left are dropped; repeated rows count each; no batch gives no totals. Extra columns are
ignored.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecquery.llm.common import slices, worker_cache
from vecquery.llm.tokens import word_tokenizer

GROUP = ("source", "lang", "tokenizer")
_COMMIT = "batch bigint, folder string, holds array<bigint>"
_DELTA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def word_counts(path: str, text: str = "text") -> Column:
    """Tokens of a text by the word tokenizer in a file."""

    @F.pandas_udf("bigint")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            yield pd.Series([len(ids) // 4 for ids in tokenizer.encoded(batch.fillna("").tolist())], dtype="int64")

    return counted(F.col(text))


def _byte_tokenizer(path: str, pattern: str):
    made = worker_cache("tokens")
    if (path, pattern) not in made:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        made[path, pattern] = tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return made[path, pattern]


def byte_counts(path: str, pattern: str, text: str = "text") -> Column:
    """Tokens of a text by the byte-level tokenizer in a rank file."""

    @F.pandas_udf("bigint")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = _byte_tokenizer(path, pattern)
        for batch in batches:
            texts = batch.fillna("").tolist()
            out = np.zeros(len(texts), dtype=np.int64)
            for a, b in slices(texts):
                out[a:b] = [len(tokenizer.encode_ordinary(t)) for t in texts[a:b]]
            yield pd.Series(out)

    return counted(F.col(text))


def inserts(counts: DataFrame) -> DataFrame:
    """Changes for new counts ``source, lang, tokenizer, n_tokens``."""
    return counts.select(*GROUP, F.lit(1).alias("sign"), "n_tokens")


def deletes(counts: DataFrame) -> DataFrame:
    """Changes for counts that leave."""
    return counts.select(*GROUP, F.lit(-1).alias("sign"), "n_tokens")


def revisions(counts: DataFrame, new: str = "new_tokens") -> DataFrame:
    """Changes for counts whose value becomes ``new``; one pass over the rows."""
    both = F.explode(F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("n_tokens").alias("n_tokens")),
        F.struct(F.lit(1).alias("sign"), F.col(new).alias("n_tokens")),
    )).alias("c")
    return counts.select(*GROUP, both).select(*GROUP, "c.sign", "c.n_tokens")


class Rollup:
    """Totals in a folder that all executors reach; opening the folder again, after a restart say, gives the same state.

    A commit writes its sums to a folder of its own, then one small row that names batch and folder; a snapshot does so with
    the batches it holds. What no row names does not count, so an attempt that died changed nothing. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.batches: dict[int, str] = {}
        self.snapshot: tuple[str, frozenset[int]] = ("", frozenset())
        try:
            rows = spark.read.schema(_COMMIT).json(f"{self.path}/commits/*").collect()  # one row per commit and snapshot
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            rows = []
        for r in sorted(rows, key=lambda r: (len(r["holds"] or ()), r["folder"])):
            if r["batch"] is None:
                self.snapshot = (r["folder"], frozenset(r["holds"] or ()))
            else:
                self.batches.setdefault(r["batch"], r["folder"])

    def _record(self, batch: int | None, folder: str, holds: list[int] | None) -> None:
        row = self.spark.createDataFrame([(batch, folder, holds)], _COMMIT)
        row.coalesce(1).write.json(f"{self.path}/commits/{uuid.uuid4().hex}")

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Commit a batch; a number that was committed before is left alone."""
        if batch in self.batches or batch in self.snapshot[1]:
            return
        sums = changes.groupBy(*GROUP).agg(
            F.sum("sign").cast("bigint").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("bigint").alias("n_tokens")
        )
        folder = f"delta-{batch}-{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.path}/{folder}")
        self._record(batch, folder, None)
        self.batches[batch] = folder

    def _parts(self) -> list[str]:
        own = [folder for batch, folder in sorted(self.batches.items()) if batch not in self.snapshot[1]]
        return [f"{self.path}/{folder}" for folder in ([self.snapshot[0]] if self.snapshot[0] else []) + own]

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` of the documents that are in."""
        parts = self._parts()
        rows = self.spark.read.schema(_DELTA).parquet(*parts) if parts else self.spark.createDataFrame([], _DELTA)
        sums = rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Fold all committed batches into a new snapshot."""
        folder, holds = f"snapshot-{uuid.uuid4().hex}", sorted(self.snapshot[1].union(self.batches))
        self.totals().write.parquet(f"{self.path}/{folder}")
        self._record(None, folder, holds)
        self.snapshot = (folder, frozenset(holds))
