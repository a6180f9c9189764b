"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Labels are those of texts, the machine judges words: words found much oftener in toxic than in clean texts, in texts
that are no copies of each other, are the toxic examples, words of clean texts the others; the clean words
that a first machine finds most toxic are added before the second is trained. Landmarks are toxic words until every
toxic word is near one, however many that takes, and some clean words. A text's score comes from its most
toxic words by a logistic regression fitted on labelled texts that no word was taken from.

Words are judged in lower case without signs at their edges; single characters in a row (``i d i o t``) are judged
as one word, a word with signs inside is judged without them too, and so are two neighbours (``id iot``) as one word if
it begins and ends as some toxic word does that no clean neighbours look like. A long word is judged in overlapping pieces, so all of it counts, in
training as in scoring. Toxic words with a character put in are examples as well.

Defined results: a null text counts as empty; an empty text gets the score of a text without any toxic word;
repeated rows each get their score; without labels of both classes every score is the share of label 1 (0 if nothing
is labelled). Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecquery.llm.common import Sample, every_nth, fit_logistic, id_crc, labelled_sample, slices, worker_cache
from vecquery.llm.string_kernel import LENGTH, WIDTH, Machine, kernel, landmarks, train_machine

#: Bounds of the labelled sample (clean, toxic texts) and of what is learned from it.
SAMPLE = (4_000, 2_000)
SAMPLE_CHARS = 24_000_000
CLEAN_WORDS = 6_000
#: Every toxic word has a landmark at least so like it; clean words among the landmarks.
NEAR = 0.6
CLEAN_LANDMARKS = 320
#: How unlikely a toxic word's share of toxic texts must be by chance, as a power of ten; at least so much that of all
#: words of toxic texts a tenth of a word is expected to be taken by chance.
SURE = 4.7
#: The same for words that are like such a word, and how like they must be.
MAYBE = 2.2
ALIKE = 0.45
#: Judged words kept per worker.
KEPT_WORDS = 400_000

_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»„“”‘’¡¿…–—"


def words(text: str) -> list[str]:
    """Words to judge, in order."""
    out, run = [], []
    for raw in text.lower().split():
        word = raw.strip(_EDGES)
        if len(word) == 1:
            run.append(word)
            continue
        if run:
            if len(run) >= LENGTH:
                out.append("".join(run))
            run = []
        if len(word) >= LENGTH:
            out.append(word)
            if not word.isalnum() and len(bare := "".join(filter(str.isalnum, word))) >= LENGTH:
                out.append(bare)
    if len(run) >= LENGTH:
        out.append("".join(run))
    return out


def _pieces(word: str) -> list[str]:
    if len(word) <= WIDTH:
        return [word]
    half = WIDTH // 2
    return [word[i : i + WIDTH] for i in range(0, len(word) - half, half)]


def _edges(word: str) -> str:
    return word[:2] + word[-2:]


def joined(text: str, edges: frozenset[str]) -> list[str]:
    """Neighbouring words written as one, where that begins and ends like a toxic word (``edges``)."""
    parts = [part for raw in text.lower().split() if (part := raw.strip(_EDGES))]
    return [a + b for a, b in zip(parts, parts[1:], strict=False) if len(a) + len(b) <= WIDTH and (a + b)[:2] + (a + b)[-2:] in edges]


@dataclass(frozen=True)
class ToxicityModel:
    """``edges``: first and last two characters of the toxic words."""

    machine: Machine | None
    weights: tuple[float, ...]
    prior: float
    edges: frozenset[str] = frozenset()


def _unlikely(toxic: int, clean: int, share: float) -> float:
    """Minus the decimal logarithm of the chance that so many of the texts with a word are toxic ones."""
    n = toxic + clean
    rate = toxic / n
    if rate <= share:
        return 0.0
    far = toxic * math.log(rate / share) + (clean * math.log((1 - rate) / (1 - share)) if clean else 0.0)
    return far / math.log(10)


def toxic_words(texts: list[str], labels: np.ndarray) -> tuple[list[str], list[str]]:
    """(toxic words, words of clean texts).

    Copies of a text count once, known by the least hash of its word triples, and so do those of a passage, known by
    the words next to a word where it stands first.
    """
    seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
    copies: dict[str, set] = {}
    places: dict[str, set] = {}
    for text, y in zip(texts, labels, strict=True):
        order = words(text)
        own = set(order)
        seen[bool(y)].update(own)
        if y and own:
            print_ = min(xxhash.xxh32_intdigest(" ".join(order[i : i + 3])) for i in range(max(1, len(order) - 2)))
            for w in own:
                copies.setdefault(w, set()).add(print_)
            first = {w: i for i, w in reversed(list(enumerate(order)))}
            for w, i in first.items():
                places.setdefault(w, set()).add(tuple(order[max(0, i - 1) : i + 2]))
    share = float(np.mean(labels))
    sure = {}
    for w, prints in copies.items():
        if (s := _unlikely(min(len(prints), len(places[w])), seen[False][w], share)) >= MAYBE:
            sure[w] = s
    least = max(SURE, 1 + math.log10(max(1, len(copies))))
    bad = sorted((w for w in sure if sure[w] >= least), key=lambda w: (-sure[w], w))
    maybe = sorted((w for w in sure if sure[w] < least), key=lambda w: (-sure[w], w))
    while bad and maybe:  # less certain words that are like certain ones
        like = kernel(maybe, landmarks(covering(bad))).max(axis=1) >= ALIKE
        if not like.any():
            break
        bad += [w for w, k in zip(maybe, like, strict=True) if k]
        maybe = [w for w, k in zip(maybe, like, strict=True) if not k]
    known = set(bad)
    good = sorted((w for w in seen[False] if w not in known), key=lambda w: xxhash.xxh32_intdigest(w))
    return bad, good


def covering(bad: list[str]) -> list[str]:
    """Words, most certain first, such that every word of ``bad`` has a kernel of at least ``NEAR`` with one of them."""
    pieces = list(dict.fromkeys(p for w in bad for p in _pieces(w)))
    out: list[str] = []
    while pieces:
        # a batch may hold words that are near each other: the earlier one of them is taken
        own = kernel(pieces[:256], landmarks(pieces[:256])) >= NEAR
        taken: list[int] = []
        for i in range(len(own)):
            if not own[i, taken].any():
                taken.append(i)
        new = [pieces[i] for i in taken]
        out += new
        pieces = pieces[256:]
        if pieces:
            far = kernel(pieces, landmarks(new)).max(axis=1) < NEAR
            pieces = [p for p, f in zip(pieces, far, strict=True) if f]
    return out


def _disguised(bad: list[str]) -> list[str]:
    """Every toxic word with a digit, a letter or a repeated letter put in, each at some inner place."""
    out = []
    for w in bad:
        at = 1 + xxhash.xxh32_intdigest(w) % max(1, len(w) - 1)
        for i, c in enumerate(("1", "x", w[at - 1])):
            j = 1 + (at + i) % max(1, len(w) - 1)
            out.append(w[:j] + (w[j - 1] if i == 2 else c) + w[j:])
    return out


def fit(sample: Sample) -> ToxicityModel:
    total = sum(sample.totals)
    prior = sample.totals[1] / total if total else 0.0
    half = ~every_nth(sample.labels, 4)
    part = [[t for t, h in zip(sample.texts, half, strict=True) if h == side] for side in (True, False)]
    y = sample.labels
    bad, good = toxic_words(part[0], y[half]) if len(y) else ([], [])
    if not bad or not good or not 0 < y[~half].sum() < (~half).sum():
        return ToxicityModel(None, (), prior)
    near, edges = covering(bad), frozenset(map(_edges, bad))
    whole = [p for w in bad for p in _pieces(w)]
    good = list(dict.fromkeys(p for w in good[: 20 * CLEAN_WORDS] for p in _pieces(w)))
    first = train_machine(landmarks([*near, *good[:CLEAN_LANDMARKS]]), good[:CLEAN_WORDS], whole)
    hardest = [good[i] for i in np.argsort(-first.decide(good), kind="stable")[:CLEAN_WORDS]]
    marks = landmarks([*near, *hardest[:CLEAN_LANDMARKS]])
    machine = train_machine(marks, [*good[:CLEAN_WORDS], *hardest], [*whole, *(p for w in _disguised(bad) for p in _pieces(w))])
    # neighbours that clean texts have too, and that would be taken for a toxic word, are not joined
    met = {j for t, label in zip(part[0], y[half], strict=True) if not label for j in joined(t, edges)}
    met = sorted(met)
    edges -= {_edges(j) for j, v in zip(met, machine.decide(met), strict=True) if v > 0}
    judge = Judge(machine, edges)
    x = judge.features(part[1])
    own = y[~half].astype(float)
    share = own.mean()
    weight = np.where(own == 1, prior / share, (1 - prior) / (1 - share))
    return ToxicityModel(machine, tuple(fit_logistic(x, own, weight, ridge=0.05)), prior, edges)


class Judge:
    """Decision values of words, each worked out once per worker while it is kept."""

    def __init__(self, machine: Machine, edges: frozenset[str]):
        self.machine, self.edges = machine, edges
        self.known: dict[str, float] = {}

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        new = list({w for t in texts for w in t if w not in self.known})
        pieces = [_pieces(w) for w in new]
        value = self.machine.decide([p for ps in pieces for p in ps])
        first = np.cumsum([0, *map(len, pieces)])[:-1]
        if len(new):
            self.known.update(zip(new, np.maximum.reduceat(value, first).tolist(), strict=True))

    def features(self, texts: list[str]) -> np.ndarray:
        """Of each text: the squared decision values of its words on the toxic side, summed (logarithm), and the greatest."""
        split = [words(t) + joined(t, self.edges) for t in texts]
        self.learn(split)
        out = np.empty((len(texts), 2))
        for i, own in enumerate(split):
            values = [self.known[w] for w in own]
            top = max(values, default=-1.0)
            out[i] = math.log1p(sum(min(1.0, v) ** 2 for v in values if v > 0)), min(max(top, -1.0), 1.0)
        return out


def train(documents: DataFrame, labels: DataFrame, usable: Column) -> ToxicityModel:
    """Fit on a bounded sample of the labelled documents that ``usable`` admits."""
    return fit(labelled_sample(documents, labels, "toxic", usable, SAMPLE, SAMPLE_CHARS))


def _judge(model: ToxicityModel) -> Judge:
    """The judge of this worker for a model; a new model replaces it."""
    key = (model.machine.marks.words, model.weights)
    made = worker_cache("toxicity")
    if made.get("key") != key:
        made.update(key=key, judge=Judge(model.machine, model.edges))
    return made["judge"]


def scores(model: ToxicityModel, texts: list[str]) -> np.ndarray:
    """Probability of label 1 for each text."""
    if model.machine is None:
        return np.full(len(texts), model.prior)
    judge = _judge(model)
    x = np.concatenate([judge.features(texts[a:b]) for a, b in slices(texts)] or [np.zeros((0, 2))])
    z = x @ np.array(model.weights[:-1]) + model.weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score_column(model: ToxicityModel, text: str = "text") -> Column:
    """Score of a text column; each row is scored by itself, so nothing is shuffled."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(scores(model, batch.fillna("").tolist()), dtype="float64")

    return scored(F.col(text))


def held_out() -> Column:
    """Rows that no label is learned from: the id's CRC-32 leaves 2 when divided by four."""
    return F.coalesce(id_crc() % 4 == 2, F.lit(False))
