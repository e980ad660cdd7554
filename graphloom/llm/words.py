"""Pre-tokens of the public tokenizers and a bounded worker cache of what they encode to.

The standard ``re`` module is several times faster than a tokenizer, and agrees with it on ASCII and Latin-1 letters, where
both tokenizers' patterns are known (:func:`is_word_level`, :func:`is_byte_level`). Any other text is cut by the library's own
normalizer and pre-tokenizer. Either way each distinct pre-token is encoded once and then looked up, so every script takes
the same path; only a text that holds an added token's string goes whole to the library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import cache
from itertools import chain

import numpy as np

#: Texts of these characters alone are cut here.
PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
#: The byte-level pattern of the tokenizers package's ByteLevel pre-tokenizer, for PLAIN texts. Letters come first, as
#: nothing else can start with one.
BYTE_LEVEL = re.compile(rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+")
#: The word pattern of word_bpe_49k.json, for PLAIN texts in lower case.
WORD_LEVEL = re.compile(r"[a-zß-öø-ÿ]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
#: A text is cut into parts of about so many characters before it is made a list of pre-tokens.
PART = 500_000

# The settings of a vocabulary file that the two patterns stand for.
_WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def plain(text: str) -> bool:
    m = PLAIN.match(text)
    return m.end() == len(text)


@cache
def _settings(vocab: str) -> dict:
    with open(vocab, encoding="utf-8") as f:
        return {k: v for k, v in json.load(f).items() if k != "model"}


def added_tokens(vocab: str) -> list[str]:
    return [t["content"] for t in _settings(vocab).get("added_tokens") or []]


def is_byte_level(vocab: str) -> bool:
    """Whether ``BYTE_LEVEL`` is this file's pre-tokenizer."""
    s = _settings(vocab)
    p = s.get("pre_tokenizer") or {}
    return s.get("normalizer") is None and p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and p.get("use_regex", True)


def is_word_level(vocab: str) -> bool:
    """Whether ``WORD_LEVEL`` on lower case is this file's normalizer and pre-tokenizer."""
    s = _settings(vocab)
    n, p = s.get("normalizer") or {}, (s.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    split = p[0].get("pattern") == {"Regex": _WORD_SPLIT} and p[0].get("behavior") == "Removed" and p[0].get("invert")
    return bool(n.get("normalizers") == _WORD_NORMALIZERS and split and p[1].get("type") == "ByteLevel" and not p[1].get("use_regex") and not p[1].get("add_prefix_space"))


@cache
def _byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def byte_chars(word: str) -> str:
    """A pre-token as a byte-level vocabulary spells it."""
    table = _byte_chars()
    return "".join([table[b] for b in word.encode()])


def parts(text: str, size: int = PART) -> list[str]:
    """``text`` in parts of about ``size`` characters, cut before a space or line feed that follows a visible ASCII character
    and precedes one: no pre-token of either pattern runs across, and no normalization does."""
    if len(text) <= size:
        return [text]
    out, at = [], 0
    while len(text) - at > size and (m := _SEAM.search(text, at + size)):
        out.append(text[at : m.start() + 1])
        at = m.start() + 1
    return [*out, text[at:]]


_SEAM = re.compile(r"[!-~](?=[ \n][!-~])")


class Encoded:
    """A bounded cache from pre-tokens to ids. Between two calls of ``room`` every pre-token keeps its number, so a slice of
    texts becomes arrays of numbers, and those become ids by numpy alone."""

    def __init__(self, size: int, learn: Callable[[list[str]], list]):
        """``learn`` gives a sequence of ids for each of some new pre-tokens."""
        self.size, self.learn = size, learn
        self._clear()

    def _clear(self) -> None:
        fresh: list[str] = []

        class Numbers(dict):
            def __missing__(self, word: str) -> int:
                n = self[word] = len(self)
                fresh.append(word)
                return n

        self.fresh, self.of = fresh, Numbers()
        self.count, self.pool = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.first = np.zeros(0, np.int64)

    def room(self) -> None:
        """Before a slice: a cache that is full starts anew."""
        if len(self.of) > self.size:
            self._clear()

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.of.__getitem__, words), np.int32, len(words))

    def settle(self) -> None:
        """Encodes what ``numbers`` has met for the first time."""
        if not self.fresh:
            return
        new = self.learn(self.fresh)
        size = np.fromiter(map(len, new), np.int64, len(new))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(size) - size])
        self.count = np.concatenate([self.count, size])
        self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(new), np.uint32, int(size.sum()))])
        self.fresh.clear()

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of settled pre-tokens, one behind the other."""
        size = self.count[numbers]
        if len(numbers) and size.min() == size.max() == 1:
            return self.pool[self.first[numbers]]
        at = np.repeat(self.first[numbers] - (np.cumsum(size) - size), size)
        at += np.arange(len(at))
        return self.pool[at]


class PreTokens:
    """Cuts texts into keys of pre-tokens for :class:`Encoded`, and encodes keys, for one vocabulary file."""

    def __init__(self, vocab: str, tok):
        self.tok, self.added = tok, added_tokens(vocab)
        self.words, self.bytes = is_word_level(vocab), is_byte_level(vocab)
        self.known = self.words or self.bytes

    def whole(self, text: str) -> bool:
        """Whether the text must go whole to the library."""
        return not self.known or any(a in text for a in self.added)

    def cut(self, text: str) -> list[str]:
        if plain(text):
            return WORD_LEVEL.findall(text.lower()) if self.words else BYTE_LEVEL.findall(text)
        if self.words:
            text = self.tok.normalizer.normalize_str(text)
        return ["\0" + p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(text)]  # in the vocabulary's spelling

    def learn(self, keys: list[str]) -> list[list[int]]:
        run = self.tok.model.tokenize
        return [[t.id for t in run(k if k.isascii() and k.isalpha() else k[1:] if k[0] == "\0" else byte_chars(k))] for k in keys]
