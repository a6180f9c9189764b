"""Personal data: base patterns and the spans a character-level BiLSTM-CRF adds.

The network learns from labelled spans: the base spans of a bounded sample of the texts, and spans of each kind
in common other spellings put into pieces of that text, among look-alikes that are no personal data. What it tags is
kept if it passes its kind's check (digits, Luhn, parts of an address) and touches no base span, so base spans
always stay as they are.

Defined results: a null or empty text has no spans; repeated rows each get their result; a table without texts still
has the base patterns and a network trained on the spellings alone. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecquery.llm.common import give_back, hashed_sample, slices, worker_cache
from vecquery.llm.pii_model import CORE, SIDE, Network, Tagger, codes, runs, train
from vecquery.llm.pii_patterns import KINDS, Span, base_spans, is_card, is_phone, listed, luhn, ordered

#: Bounds of the text sample the network learns from.
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 2_000_000
EXAMPLES = 6_000
EXAMPLE_CHARS = 72
#: Texts per pass through the network, in characters: as many windows as are computed side by side.
PASS_CHARS = CORE * SIDE

_EMAIL_LIKE = re.compile(
    r"[A-Za-z0-9._%+-]+ ?(?:@|\(at\)|\[at\]|\(@\)) ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]+)+", re.ASCII
)
_IP_LIKE = re.compile(r"([0-9]{1,3})(?:\[\.\]|\(\.\)|\[dot\])([0-9]{1,3})(?:\[\.\]|\(\.\)|\[dot\])([0-9]{1,3})(?:\[\.\]|\(\.\)|\[dot\])([0-9]{1,3})")
_CARD_LIKE = re.compile(r"[0-9](?:[ ./_-]{0,2}[0-9])+")
_PHONE_LIKE = re.compile(r"(?:\(?00|\+|\()[ ]?[0-9][ ()./0-9-]+[0-9]|[0-9]{2,4}[-./ ][0-9]{3}[-./ ][0-9]{3,4}")


def passes(text: str, kind: str) -> bool:
    """Whether a tagged string is what its kind needs, in any of the known spellings."""
    if kind == "email":
        return bool(_EMAIL_LIKE.fullmatch(text))
    if kind == "ip":
        return bool(m := _IP_LIKE.fullmatch(text)) and all(int(p) <= 255 for p in m.groups())
    if kind == "card":
        return bool(_CARD_LIKE.fullmatch(text)) and is_card(text)
    return bool(_PHONE_LIKE.fullmatch(text)) and is_phone(text)


def all_spans(text: str, tags: np.ndarray) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, given its tags."""
    base = base_spans(text)
    added = []
    for start, end, kind in runs(tags):
        while start < end and text[start] in " ,;:\n\t":
            start += 1
        while end > start and text[end - 1] in " ,;:.\n\t":
            end -= 1
        if all(end <= a or start >= z for a, z, _ in base) and passes(text[start:end], kind):
            added.append((start, end, kind))
    return base, ordered(base + added) if added else base


def _digits(draw: random.Random, n: int) -> str:
    return "".join(draw.choice("0123456789") for _ in range(n))


def _card_digits(draw: random.Random) -> str:
    body = draw.choice("3456") + _digits(draw, draw.choice([13, 14, 14, 14, 15, 17]))
    return next(body + d for d in "0123456789" if luhn(body + d))


def _span(draw: random.Random, kind: str) -> str:
    """A span of a kind in one of its usual spellings."""
    if kind == "email":
        name = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 9)))
        name += draw.choice(["", ".", "_", "-", "+"]) + draw.choice(["", _digits(draw, 2), name[::-1]])
        host = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(3, 9)))
        host += draw.choice(["", _digits(draw, 1)])
        at, dot = draw.choice([("@", "."), ("@", "."), (" @ ", "."), (" (at) ", "."), ("[at]", "."), (" [at] ", " [dot] "), ("(at)", "(dot)")])
        return (name or "a").strip(".") + at + host + draw.choice(["", dot + "mail"]) + dot + draw.choice(["com", "org", "net", "de", "fr"])
    if kind == "ip":
        parts = [str(draw.randint(0, 255)) for _ in range(4)]
        return draw.choice([".", ".", "[.]", "(.)", "[dot]"]).join(parts)
    if kind == "card":
        digits = _card_digits(draw)
        gap = draw.choice(["", "", " ", "-", ".", "/", " - ", "_"])
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    a, b, c = _digits(draw, 3), _digits(draw, 3), _digits(draw, 4)
    code = draw.choice(["1", "44", "33", "49", "34"])
    return draw.choice([
        f"+{code} ({a}) {b}-{c}", f"+{code} {a} {b} {c}", f"+{code}-{a}-{b}-{c}", f"({a}) {b}-{c}", f"00{code} {a} {b}{c}",
        f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}", f"+{code}{a}{b}{c}", f"+{code} {a}/{b}{c}",
    ])


def _look_alike(draw: random.Random) -> str:
    """Digits and signs that are no personal data."""
    return draw.choice([
        lambda: f"20{_digits(draw, 2)}-0{draw.randint(1, 9)}-{draw.randint(10, 28)}",
        lambda: f"{draw.randint(1, 12)}:{_digits(draw, 2)}", lambda: f"${_digits(draw, 2)}.{_digits(draw, 2)}",
        lambda: f"v{draw.randint(1, 9)}.{draw.randint(0, 20)}.{draw.randint(0, 9)}", lambda: _digits(draw, draw.randint(1, 8)),
        lambda: "".join(draw.choice("0123456789abcdef") for _ in range(draw.choice([8, 18, 40]))),
        lambda: f"(c) 20{_digits(draw, 2)}", lambda: f"@{_digits(draw, 2)}", lambda: "a @ b", lambda: f"{_digits(draw, 1)}.0",
        lambda: f"password={''.join(draw.choice('0123456789abcdef') for _ in range(18))}", lambda: "%%% *** &&& $$$ ###",
        lambda: f"ISBN {_digits(draw, 3)}-{_digits(draw, 1)}-{_digits(draw, 5)}", lambda: f"+{_digits(draw, 2)} %",
    ])()


def examples(texts: list[str], count: int = EXAMPLES, chars: int = EXAMPLE_CHARS, seed: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Labelled pieces of one length: (codes, tags)."""
    draw = random.Random(seed)
    texts = [t for t in texts if t] or ["the of and to in that it is was for"]
    out = []
    for _ in range(count):
        text = draw.choice(texts)
        at = draw.randrange(len(text))
        left, right = text[max(0, at - chars) : at], text[at : at + chars]
        kind = draw.choice((*KINDS, *KINDS, "", "", "look"))
        middle = _span(draw, kind) if kind in KINDS else _look_alike(draw) if kind else ""
        edge = draw.choice([(" ", " "), (" ", " "), (" ", ", "), (" ", ".\n"), (": ", " "), ("(", ")"), ("\n", "\n")]) if middle else ("", "")
        whole = f"{left}{edge[0]}{middle}{edge[1]}{right}"
        tags = np.zeros(len(whole), dtype=np.int64)
        for a, z, k in base_spans(whole):
            tags[a:z] = 1 + KINDS.index(k)
        if kind in KINDS:
            a = len(left) + len(edge[0])
            tags[a : a + len(middle)] = 1 + KINDS.index(kind)
        begin = max(0, min(len(whole) - chars, len(left) - draw.randint(0, chars // 2)))
        piece, tags = whole[begin : begin + chars], tags[begin : begin + chars]
        if len(piece) == chars:
            out.append((codes(piece), tags))
    return out


def train_network(documents: DataFrame, seed: int = 0) -> Network:
    """A network trained on labelled pieces of a bounded sample, chosen by a hash of the text."""
    rows = documents.filter(F.length("text").between(1, SAMPLE_CHARS // SAMPLE_TEXTS))
    texts = hashed_sample(rows, "text", SAMPLE_TEXTS)
    return train(examples(texts, seed=seed), seed=seed)


_SPANS = "struct<base:array<struct<start:int,end:int,kind:string>>,spans:array<struct<start:int,end:int,kind:string>>>"


def spans_column(net: Network, text: str = "text") -> Column:
    """Base and all spans of a text column; rows are worked on where they lie."""

    @F.pandas_udf(_SPANS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker_cache("pii")
        tagger = Tagger(net)
        for batch in batches:
            base, spans = [], []
            texts = batch.fillna("").tolist()
            for a, b in slices(texts, PASS_CHARS):
                for text_, tags in zip(texts[a:b], tagger.tags(texts[a:b]), strict=True):
                    own, every = all_spans(text_, tags)
                    base.append(own)
                    spans.append(every)
            yield pd.DataFrame({"base": base, "spans": spans})
        give_back()

    return found(F.col(text))


def find(documents: DataFrame, net: Network) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row; counts are of all spans."""

    @F.pandas_udf("n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker_cache("pii")
        tagger = Tagger(net)
        for batch in batches:
            rows = []
            texts = batch.fillna("").tolist()
            for a, b in slices(texts, PASS_CHARS):
                for text, tags in zip(texts[a:b], tagger.tags(texts[a:b]), strict=True):
                    base, every = all_spans(text, tags)
                    kinds = [s[2] for s in every]
                    rows.append((
                        *(kinds.count(k) for k in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(every)
                    ))
            yield pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
        give_back()

    return documents.select("doc_id", "text").select("doc_id", digest("text").alias("_f")).select("doc_id", "_f.*")


def redact_text(text: str, spans: list[Span]) -> str:
    """Every span replaced by its kind in capitals; spans that overlap are replaced as one, by the first one's kind."""
    out, end = [], 0
    for start, stop, kind in spans:
        if start >= end:
            out += [text[end:start], f"[{kind.upper()}]"]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def redacted_column(net: Network, text: str = "text") -> Column:
    """The text with all spans replaced; null stays null."""

    @F.pandas_udf("string")
    def redacted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_cache("pii")
        tagger = Tagger(net)
        for batch in batches:
            out = []
            texts = batch.tolist()
            for a, b in slices([t or "" for t in texts], PASS_CHARS):
                some = [t or "" for t in texts[a:b]]
                for text_, tags in zip(some, tagger.tags(some), strict=True):
                    out.append(redact_text(text_, all_spans(text_, tags)[1]))
            yield pd.Series([None if t is None else o for t, o in zip(texts, out, strict=True)], dtype="object")
        give_back()

    return redacted(F.col(text))
