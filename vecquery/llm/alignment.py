"""Texts under two tokenizers: which tokens share bytes, and where both end.

Tokens of one text cover the same bytes under both tokenizers, so their ends are places in one byte line. A slice of
many texts is one line; token pairs never cross texts because both sides end with each of them.
"""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import dataclass

import numpy as np

from vecquery.llm.common import worker_cache

_ID_BITS = 20


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as its own character, the others as those from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens:
    """Ids of a byte-level vocabulary file; ``pattern`` is how it cuts texts before merging.

    Merges of such files have rising ids, so ids are ranks and the faster library gives the same tokens.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        letter = byte_of_letter()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        entries = {bytes(map(letter.__getitem__, token)): i for token, i in model["vocab"].items() if all(c in letter for c in token)}
        ranks = {token: i for token, i in entries.items() if i < 256 + len(model["merges"])}
        self.encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = [b""] * (1 + max(entries.values()))
        for token, i in entries.items():
            self.token_bytes[i] = token

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + text) for text in texts]


class PieceTokens:
    """Ids of a piece model that puts a space in front of a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.token_bytes = [
            bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.model.id_to_piece, range(self.model.get_piece_size())))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class _Side:
    """Byte lengths, bytes and decimal strings of the tokens of one vocabulary."""

    def __init__(self, tokens):
        if len(tokens.token_bytes) >= 1 << _ID_BITS:
            raise ValueError("vocabulary too large")
        self.encode, self.bytes = tokens.encode, tokens.token_bytes
        self.lengths = np.array([len(b) for b in tokens.token_bytes], dtype=np.int64)
        # up to seven digits and what follows them, in eight bytes each; zero bytes are no text
        names = [str(i).encode() + after for i in range(len(self.bytes)) for after in (b",", b"|", b";", b"")]
        self.names = np.frombuffer(b"".join(name.ljust(8, b"\0") for name in names), dtype=np.uint64)
        self.name_lengths = np.array([len(name) for name in names], dtype=np.int64)


@dataclass
class Aligned:
    """Per text: counts and the hash of its groups. Per link: text, id under A, id under B."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    text: np.ndarray
    a: np.ndarray
    b: np.ndarray


class Aligner:
    def __init__(self, a_tokens, b_tokens):
        self.a, self.b = _Side(a_tokens), _Side(b_tokens)

    def _usable(self, text: str, a: list[int], b: list[int]) -> bool:
        want = b" " + text.encode()
        return bool(text) and b"".join(map(self.a.bytes.__getitem__, a)) == want and b"".join(map(self.b.bytes.__getitem__, b)) == want

    def align(self, texts: list[str | None]) -> Aligned:
        """Texts that are null or empty, or that a vocabulary does not give back byte for byte, have no tokens."""
        given = [text or "" for text in texts]
        a_ids, b_ids = self.a.encode(given), self.b.encode(given)
        for i, text in enumerate(given):
            if not self._usable(text, a_ids[i], b_ids[i]):
                a_ids[i], b_ids[i] = [], []
        n_a, n_b = (np.array([len(ids) for ids in side], dtype=np.int64) for side in (a_ids, b_ids))
        a, b = (
            np.fromiter((i for ids in side for i in ids), dtype=np.int64, count=int(n.sum())) for side, n in ((a_ids, n_a), (b_ids, n_b))
        )
        zero = np.zeros(len(texts), dtype=np.int64)
        if not len(a):
            return Aligned(n_a, n_b, zero, zero, [""] * len(texts), a, a, b)
        a_end, b_end = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        a_of = np.repeat(np.arange(len(a)), self.a.lengths[a])  # the token a byte belongs to
        b_of = np.repeat(np.arange(len(b)), self.b.lengths[b])
        first, last = b_of[a_end - self.a.lengths[a]], b_of[a_end - 1]
        wide = last - first + 1
        link_a = np.repeat(np.arange(len(a)), wide)
        link_b = np.arange(len(link_a)) - np.repeat(np.cumsum(wide) - wide, wide) + first[link_a]
        text_of_a = np.repeat(np.arange(len(texts)), n_a)
        ends_group = b_end[last] == a_end
        groups = np.bincount(text_of_a[ends_group], minlength=len(texts))
        links = np.bincount(text_of_a, weights=wide, minlength=len(texts)).astype(np.int64)
        group_end = a_end[ends_group]
        hashes = self._hashed_groups(a, b, n_a, n_b, a_end, b_end, group_end, a_of, b_of)
        return Aligned(n_a, n_b, groups, links, hashes, text_of_a[link_a], a[link_a], b[link_b])

    def _hashed_groups(self, a, b, n_a, n_b, a_end, b_end, group_end, a_of, b_of) -> list[str]:
        """SHA-256 of every text's groups, written as bytes for all texts at once."""
        a_upto, b_upto = a_of[group_end - 1] + 1, b_of[group_end - 1] + 1  # tokens up to each group's end
        group_of_a = np.searchsorted(group_end, a_end)
        group_of_b = np.searchsorted(group_end, b_end)
        place_a = np.arange(len(a)) + np.concatenate([[0], b_upto])[group_of_a]
        place_b = np.arange(len(b)) + a_upto[group_of_b]
        after_a, after_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        after_a[a_upto - 1], after_b[b_upto - 1] = 1, 2
        text_last = np.cumsum(n_b)[n_b > 0] - 1
        after_b[text_last] = 3
        names, lengths = np.empty(len(a) + len(b), dtype=np.uint64), np.empty(len(a) + len(b), dtype=np.int64)
        for side, ids, after, place in ((self.a, a, after_a, place_a), (self.b, b, after_b, place_b)):
            names[place], lengths[place] = side.names[4 * ids + after], side.name_lengths[4 * ids + after]
        written = names.view(np.uint8)
        written = written[written != 0]
        tokens = np.concatenate([[0], np.cumsum(n_a + n_b)])
        ends = np.concatenate([[0], np.cumsum(lengths)])[tokens]
        return [hashlib.sha256(written[i:j]).hexdigest() if j > i else "" for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def aligner(a_path: str, pattern: str, b_path: str) -> Aligner:
    """The aligner of this worker for two vocabulary files."""
    key, made = (a_path, pattern, b_path), worker_cache("alignment")
    if key not in made:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        made[key] = Aligner(ByteTokens(a_path, pattern), PieceTokens(b_path))
    return made[key]
