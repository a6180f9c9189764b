"""Quality classifier by compression.

Two Zstandard dictionaries are built, one from text labelled good and one from text labelled bad. A text is
compressed with each; the difference of the two sizes, normalised by their sum, says which class it is
more alike. A logistic regression on labelled texts that went into neither dictionary turns the
normalised sizes into a probability.

Defined results: a null text counts as empty; an empty text gets the share of label 1 among all labelled
rows; repeated rows each get their score; without usable labels of both classes every score is that share
(0.5 if nothing is labelled). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecquery.llm.common import Sample, every_nth, fit_logistic, give_back, id_crc, labelled_sample, worker_cache

#: Bounds of the labelled sample that dictionaries and calibration are fitted on.
SAMPLE_PER_CLASS = 3_000
SAMPLE_CHARS = 24_000_000
DICTIONARY_BYTES = 65_536
#: Training pieces of a text: so many characters each.
PIECE = 1_500
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    raw: bool
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float


class _Sizes:
    """Compressors with the two dictionaries digested once."""

    def __init__(self, good: bytes, bad: bytes, raw: bool):
        kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT
        self.compressors = []
        for data in (good, bad):
            made = zstandard.ZstdCompressionDict(data, dict_type=kind)
            made.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=False, write_dict_id=False)
            )

    def features(self, texts: list[str]) -> np.ndarray:
        """Normalised difference, size per byte with each dictionary, log length, and their products."""
        out = np.empty((len(texts), 3))
        raw = np.empty(len(texts))
        for i, text in enumerate(texts):
            data = text.encode("utf-8", "replace")
            g, b = (len(c.compress(data)) for c in self.compressors)
            out[i] = (g - b) / (g + b), g / (len(data) + 16), b / (len(data) + 16)
            raw[i] = len(data)
        size = np.log1p(raw)
        d, rg, rb = out.T
        return np.column_stack([d, rg, rb, size, d * size, rg * size, d * d, rg * rg, d * rg, size * size])


def _dictionary(texts: list[str]) -> tuple[bytes, bool]:
    """A trained dictionary, or plain text as one where there is too little to train on."""
    pieces = [t[i : i + PIECE].encode("utf-8", "replace") for t in texts for i in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, k=200, d=8).as_bytes(), False
    except zstandard.ZstdError:
        return b"\n".join(pieces)[-DICTIONARY_BYTES:], True


def fit(sample: Sample) -> QualityModel:
    """Dictionaries from one half of the sample, calibration on the other half."""
    total = sum(sample.totals)
    prior = sample.totals[1] / total if total else 0.5
    half = every_nth(sample.labels, 2)
    use = [[sample.texts[i] for i in np.flatnonzero(half & (sample.labels == y))] for y in (1, 0)]
    y = sample.labels[~half].astype(float)
    if not all(use) or not 0 < y.sum() < len(y):
        return QualityModel(b"", b"", True, (), (), (), prior)
    (good, raw_good), (bad, raw_bad) = (_dictionary(texts) for texts in use)
    if raw_good != raw_bad:
        good, bad = (b"\n".join(t.encode("utf-8", "replace") for t in x)[-DICTIONARY_BYTES:] for x in use)
    raw = raw_good or raw_bad
    x = _Sizes(good, bad, raw).features([t for t, h in zip(sample.texts, half, strict=True) if not h])
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    share = np.array([(y == 0).sum(), (y == 1).sum()]) / len(y)
    weight = np.where(y == 1, prior / share[1], (1 - prior) / share[0])
    w = fit_logistic((x - centre) / scale, y, weight)
    return QualityModel(good, bad, raw, tuple(centre), tuple(scale), tuple(w), prior)


def train(documents: DataFrame, labels: DataFrame, usable: Column) -> QualityModel:
    """Fit on a bounded sample of the labelled documents that ``usable`` admits."""
    return fit(labelled_sample(documents, labels, "quality", usable, (SAMPLE_PER_CLASS, SAMPLE_PER_CLASS), SAMPLE_CHARS))


def scores(model: QualityModel, texts: list[str]) -> np.ndarray:
    """Probability of label 1 for each text."""
    if not model.weights:
        return np.full(len(texts), model.prior)
    x = (_sizes(model).features(texts) - np.array(model.centre)) / np.array(model.scale)
    z = x @ np.array(model.weights[:-1]) + model.weights[-1]
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return np.where([not t for t in texts], model.prior, p)


def _sizes(model: QualityModel) -> _Sizes:
    """The compressors of a model, made once per worker."""
    key = hash(model)
    made = worker_cache("quality")
    if made.get("key") != key:
        made.update(key=key, sizes=_Sizes(model.good, model.bad, model.raw))
    return made["sizes"]


def score_column(model: QualityModel, text: str = "text") -> Column:
    """Score of a text column; each row is scored by itself, so nothing is shuffled."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(scores(model, batch.fillna("").tolist()), dtype="float64")
        give_back()

    return scored(F.col(text))


def score_documents(documents: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` for every row."""
    return documents.select("doc_id", "text").select("doc_id", score_column(model).alias("score"))


def held_out() -> Column:
    """Rows that no label is learned from: the id's CRC-32 divides by five."""
    return F.coalesce(id_crc() % 5 == 0, F.lit(False))
