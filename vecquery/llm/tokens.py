"""Token ids of whole texts with public tokenizers.

A plain text (ASCII and the letters of the next block) is cut into the pieces that the tokenizer would cut it into, a zero
character behind each, and merged by the faster library, which knows the vocabulary with a zero byte for the end of a word.
Other texts go word by word.

The word tokenizer drops white space and never merges across it, so a text's ids are those of its
white-space separated words in order. Words repeat; each worker keeps the ids of those it has met, and only new
ones go through the tokenizer. A word of letters with symbols behind it is two tokenizer words, so its ids are put
together from theirs.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import numpy as np

from vecquery.llm.alignment import byte_of_letter
from vecquery.llm.common import slices, worker_cache

#: Characters whose words are looked up together.
SLICE_CHARS = 1_000_000
#: Words kept per worker and generation, and the longest word kept, which together bound the memory.
KEPT_WORDS = 250_000
KEPT_CHARS = 48
#: Python counts these as white space, the tokenizer does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[ \t\n\r]+")
#: Letters of the first two Unicode blocks, whose lower case is one letter, then ASCII symbols but the apostrophe and
#: the signs that special tokens are written with.
_PARTS = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:;=?@\\[-`{}~]*)")
#: One lower-case run of such letters, or of such symbols.
_PIECE = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[!-&(-/:;=?@\\[-`{}~]+")
#: Texts of ASCII and letters of the next block, whose lower case and normal form are plain.
_PLAIN = re.compile("[\t\n\x0b\x0c\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
#: How such a text in lower case falls into the pieces that are merged: runs of letters, digits, endings, runs of other signs.
_PIECES = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\\sa-z0-9\xdf-\xf6\xf8-\xff]+")


class _Known:
    """Ids of words met so far, in two generations: when the younger is full it becomes the older one, whose words move back
    when they are met again, so that only words not met for long are forgotten."""

    def __init__(self, make):
        self.make, self.young, self.old = make, {}, {}

    def fill(self, words: set[str]) -> dict[str, bytes]:
        """A dictionary that holds at least ``words``; what it lacks is made in one call."""
        if len(self.young) > KEPT_WORDS:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = words.difference(young)
        again = missing.intersection(old)
        for word in again:
            young[word] = old[word]
        missing = list(missing.difference(again))
        made = dict(zip(missing, self.make(missing), strict=True))
        long = [word for word in missing if len(word) > KEPT_CHARS]
        if long:
            both = {word: young[word] for word in words.difference(made)} | made
            young.update((word, ids) for word, ids in made.items() if len(word) <= KEPT_CHARS)
            return both
        young.update(made)
        return young


def _end_marked_ranks(model: dict) -> dict[bytes, int] | None:
    """Tokens of a word-end vocabulary as bytes, the end of a word as a zero byte; ids rise in the order of the merges.

    None for a file whose ids are not the single letters, the letters that end a word, and the merges in order.
    """
    letter = byte_of_letter()
    vocab, end = model["vocab"], "</w>"
    pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
    if any(vocab.get(a + b) != 2 * len(letter) + i for i, (a, b) in enumerate(pairs)):
        return None
    if sorted(vocab[x] for x in letter) != list(range(256)) or sorted(vocab[x + end] for x in letter) != list(range(256, 512)):
        return None
    return {bytes(map(letter.__getitem__, t.removesuffix(end))) + b"\0" * t.endswith(end): i for t, i in vocab.items()}


class WordTokenizer:
    """Ids of a text as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts, self.words = _Known(self._encode), _Known(self._put_together)
        self.merger = None
        with open(path, encoding="utf-8") as file:
            ranks = _end_marked_ranks(json.load(file)["model"])
        if ranks:
            import tiktoken

            self.merger = tiktoken.Encoding("file", pat_str="[^\0]+\0", mergeable_ranks=ranks, special_tokens={})
            self.ends_word = np.zeros(1 + max(ranks.values()), dtype=bool)
            self.ends_word[[i for token, i in ranks.items() if len(token) > 1 and token.endswith(b"\0")]] = True

    def _encode(self, parts: list[str]) -> list[bytes]:
        """Ids of words and parts of words. What ``_PARTS`` takes is one piece to merge, which the faster library does too."""
        whole = [part for part in parts if self.merger and _PIECE.fullmatch(part)]
        done = {}
        if whole:
            ids = np.asarray(self.merger.encode_ordinary("\0".join(whole) + "\0"), dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            data = ids.tobytes()
            done = {part: data[4 * i : 4 * j] for part, i, j in zip(whole, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)}
        rest = [part for part in parts if part not in done]
        found = self.tokenizer.encode_batch(rest, add_special_tokens=False)
        done.update((part, np.asarray(e.ids, dtype="<u4").tobytes()) for part, e in zip(rest, found, strict=True))
        return [done[part] for part in parts]

    def _put_together(self, words: list[str]) -> list[bytes]:
        split = [_PARTS.fullmatch(word) for word in words]
        cut = [
            (word,) if m is None else (m[1].lower(), m[2]) if m[2] else (word.lower(),) for word, m in zip(words, split, strict=True)
        ]
        ids = self.parts.fill({part for parts in cut for part in parts})
        return [b"".join([ids[part] for part in parts]) for parts in cut]

    def encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of each text: plain texts piece by piece, others word by word."""
        plain = [bool(self.merger and _PLAIN.fullmatch(text)) and "<|" not in text for text in texts]
        rest = iter(self._by_words([text for text, p in zip(texts, plain, strict=True) if not p]))
        return [self._by_pieces(text) if p else next(rest) for text, p in zip(texts, plain, strict=True)]

    def _by_pieces(self, text: str) -> bytes:
        pieces = _PIECES.findall(text.lower())
        pieces.append("")
        ids = array("I", self.merger.encode_ordinary("\0".join(pieces)))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Texts are taken in slices, whose new words go through the tokenizer together."""
        out: list[bytes] = []
        for i, j in slices(texts, SLICE_CHARS):
            words = [_SPACE.split(text) if _NOT_SPACE.search(text) else text.split() for text in texts[i:j]]
            ids = self.words.fill(set().union(*words))
            out += [b"".join(map(ids.__getitem__, some)) for some in words]
        return out


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this worker for a file."""
    made = worker_cache("tokens")
    if path not in made:
        made[path] = WordTokenizer(path)
    return made[path]
