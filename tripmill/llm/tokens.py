"""Whole texts to token ids with the ``tokenizers`` library, remembering the ids of words already met.

A tokenizer splits a text into words before it merges, and no word of the two kinds below reaches over a
space that stands between two other characters. So a text's ids are those of its parts between such spaces
one after the other, and repeated parts and words need not be merged again. Parts with characters for which
cutting a part into words is not that simple are given to the library as they are.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

import regex
from pyspark import SparkContext
from tokenizers import Tokenizer

# The patterns with which the two kinds of tokenizers split a text into words.
WORD_END_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACE_FIRST_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Below this character there are no marks to compose and no letters on which Unicode versions differ.
PLAIN_BELOW = "ɐ"
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_LIMIT = 320_000


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


def split_parts(text: str) -> list[str]:
    """``text`` cut at each space that stands between two characters that are not white space; these spaces go."""
    if not text:
        return []
    touches = text[0] == " " or text[-1] == " " or "  " in text or "\n " in text or " \n" in text
    return _INNER_SPACE.split(text) if touches or _OTHER_SPACE.search(text) else text.split(" ")


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Filled(dict):
    """A dictionary that computes what it lacks and holds at most ``limit`` entries, and as many set aside.

    When it is full, all entries are set aside and those asked for again come back, so frequent ones stay.
    """

    def __init__(self, compute: Callable, limit: int) -> None:
        self.compute, self.limit, self.aside = compute, limit, {}

    def __missing__(self, key):  # noqa: ANN001, ANN204
        value = self.aside.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) >= 200:
                return value
        if len(self) >= self.limit:
            self.aside = dict(self)
            self.clear()
        self[key] = value
        return value


class TextEncoder:
    """Ids of a text as little-endian unsigned 32-bit integers, with no special tokens added.

    ``kind`` is "word_end" (lower case, white space dropped), "space_first" (byte-level, a word carries the
    space before it) or None for any other tokenizer, whose texts are encoded whole.
    """

    def __init__(self, definition: str, kind: str | None) -> None:
        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = kind
        self.find = regex.compile(WORD_END_PATTERN if kind == "word_end" else SPACE_FIRST_PATTERN).findall
        self.letters = byte_letters()
        # A special token's string in a text is that token: parts that may hold one go to the library.
        added = self.library.get_added_tokens_decoder().values()
        self.marked = re.compile("|".join(sorted({re.escape(token.content[:2]) for token in added})) or r"(?!)").search
        self.model, self.lower = self.library.model, kind == "word_end"
        self.packed = [struct.pack("<I", i) for i in range(self.library.get_vocab_size())]
        self.words = Filled(self._word, _LIMIT)
        self.parts = Filled(self._part, _LIMIT)
        self.spaced = Filled(self._spaced, _LIMIT)

    def whole(self, text: str) -> bytes:
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        bare = word.removeprefix(" ")
        if bare.isascii() and bare.isalpha():  # such letters stand for themselves
            mapped = self.letters[0x20] + bare if bare is not word else word
        else:
            mapped = "".join([self.letters[b] for b in word.encode("utf-8")])
        of = self.packed
        return b"".join([of[token.id] for token in self.model.tokenize(mapped)])

    def _part(self, part: str) -> bytes:
        if not part:
            return b""
        if not part.isascii() and max(part) >= PLAIN_BELOW:
            return self.whole(part)
        given, part = part, part.lower() if self.lower else part
        spaced = part[0] == " "
        letters = part[1:] if spaced else part
        if letters.isalpha():
            return self._word(part) if part == given else self.parts[part]
        if letters[-1:] in (".", ",") and letters[:-1].isalpha():
            bare = self.spaced[letters[:-1]] if spaced else self.parts[part[:-1]]
            return bare + self.words[letters[-1]]
        if self.marked(part):
            return self.whole(part)
        return b"".join(map(self.words.__getitem__, self.find(part)))

    def _spaced(self, part: str) -> bytes:
        """A part that a space comes before."""
        if not part or part[0].isspace() or part[-1].isspace():
            raise ValueError("white space at a part's end")
        return self._part(" " + part)

    def __call__(self, text: str) -> bytes:
        if self.kind is None:
            return self.whole(text)
        if self.kind == "word_end":
            return b"".join(map(self.parts.__getitem__, text.split(" ")))
        first, *later = text.split(" ")
        try:
            found = list(map(self.spaced.__getitem__, later))
        except ValueError:  # a space touches other white space: look for the spaces that do not
            first, *later = _INNER_SPACE.split(text)
            return self._part(first) + b"".join([self._part(" " + part) for part in later])
        if later and (not first or first[-1].isspace()):
            return self._part(first + " " + later[0]) + b"".join(found[1:])
        return self._part(first) + b"".join(found)


_LOADED: dict[tuple, TextEncoder] = {}


def encoder_maker(context: SparkContext, path: str, kind: str | None) -> Callable[[], TextEncoder]:
    """For use in tasks: the encoder of the tokenizer at the driver's ``path``, one per worker process.

    The definition is broadcast: a tokenizer's file has a few megabytes, whatever the input.
    """
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    if len(definition) > 64 << 20:
        raise ValueError(f"{path} is too large to broadcast")
    sent = context.broadcast(definition)

    def make() -> TextEncoder:
        key = (path, kind)
        if key not in _LOADED:
            _LOADED[key] = TextEncoder(sent.value, kind)
        return _LOADED[key]

    return make
