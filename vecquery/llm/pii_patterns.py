"""Base spans of personal data, kind by kind: leftmost, non-overlapping matches of fixed patterns."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Fixed value: the kinds in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone")

# The patterns of the four kinds. A match of the local part of an address ends before its "@", so the
# search begins there. A number's match can't begin inside its digits, which the look-behind only states.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_card(text: str) -> bool:
    digits = _digits(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 10 <= len(_digits(text)) <= 15


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _emails(text: str) -> Iterator[Span]:
    end, sign = 0, text.find("@")
    while sign >= 0:
        start = end + len(text[end:sign].rstrip(_LOCAL))
        end = sign + 1
        if start < sign and (domain := _DOMAIN.match(text, sign + 1)):
            end = domain.end()
            yield start, end, "email"
        sign = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """(start, end, kind), sorted by start and then as the kinds are listed."""
    out = list(_emails(text))
    if _DIGIT.search(text):
        out += [(*m.span(), "ip") for m in _IP.finditer(text) if is_ip(m[0])]
        out += [(*m.span(), "card") for m in _CARD.finditer(text) if is_card(m[0])]
        if "+" in text:
            out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if is_phone(m[0])]
    return ordered(out)


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)
