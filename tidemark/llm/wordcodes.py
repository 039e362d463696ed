"""Token ids word by word, exactly as the tokenizer gives them for the whole text.

White space separates tokens of this kind of tokenizer, so the ids of a text are those of its
words one after another. Words repeat a lot; the ids of a bounded number of those met lately are remembered.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import lru_cache

import regex
from tokenizers import Tokenizer

from tidemark.llm.common import emptied_by


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


#: Signs that follow a word and are a part of their own.
_MARKS = frozenset(b".,;:!?")


class Recent(dict):
    """What ``make`` makes of a key, kept for some ``limit`` keys: those met lately.

    When half of them are new, the older half goes, but for what was met since.
    """

    def __init__(self, make, limit: int) -> None:
        super().__init__()
        self.make, self.half, self.old = make, max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordCodes(Recent):
    """word (bytes without ASCII white space) -> what ``keep`` makes of its token ids."""

    def __init__(self, path: str, keep, limit: int) -> None:
        super().__init__(lambda word: keep(ids(word)), limit)
        ids = self.ids
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.parts = Recent(self._part, limit // 2)
        self.same: dict[int, int] = {}  # an id is one object, in however many words
        self.split = self._splitter(path)

    @staticmethod
    def _splitter(path: str) -> regex.Pattern | None:
        """The pattern that splits lower-cased words, if there is no other step before the model."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = [p.get("pattern", {}).get("Regex", "") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        return regex.compile(split[0]) if kinds == ["NFC", "Replace", "Lowercase"] and split and split[0] else None

    def mapped(self, part: bytes) -> str:
        """A part as the model takes it."""
        return part.decode() if part.isascii() else part.decode("latin-1").translate(self.letters)

    def _part(self, part: bytes) -> tuple[int, ...]:
        return tuple([self.same.setdefault(k, k) for k in [t.id for t in self.model.tokenize(self.mapped(part))]])

    def parts_of(self, word: bytes) -> Sequence[bytes] | None:
        """Printable Latin words are their own normal forms; their parts go to the model directly.
        All else, and what may hold a special token, goes through the whole tokenizer: None."""
        if self.split:
            low = word.lower()
            if low.isalpha():  # of bytes: ASCII letters only
                return (low,)
            if low[-1] in _MARKS and low[:-1].isalpha():
                return low[:-1], low[-1:]
            text = word.decode()
            if (word.isascii() or max(text) < "Ā") and text.isprintable() and b"<|" not in word:
                low = text.lower()
                return (low.encode(),) if low.isalpha() else [part.encode() for part in self.split.findall(low)]
        return None

    def ids(self, word: bytes) -> tuple[int, ...]:
        parts = self.parts_of(word)
        if parts is None:
            return self.whole(word)
        if len(parts) == 1:
            return self.parts[parts[0]]
        return tuple([k for part in parts for k in self.parts[part]])

    def whole(self, word: bytes) -> tuple[int, ...]:
        """What the whole tokenizer makes of a word."""
        return tuple(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)


class PackedCodes(WordCodes):
    """The same where ``keep`` makes bytes of ids, so that a word's are those of its parts, one after another.

    A part is packed once, and shared by the words that are nothing else.
    """

    def __init__(self, path: str, keep, limit: int) -> None:
        super().__init__(path, keep, limit)
        self.keep, self.make, self.parts.make = keep, self._word, self._packed

    def _packed(self, part: bytes) -> bytes:
        return self.keep([t.id for t in self.model.tokenize(self.mapped(part))])

    def _word(self, word: bytes) -> bytes:
        parts = self.parts_of(word)
        if parts is None:
            return self.keep(self.whole(word))
        return self.parts[parts[0]] if len(parts) == 1 else b"".join([self.parts[part] for part in parts])


@lru_cache(4)
def kept_codes(path: str, keep, limit: int) -> PackedCodes:
    """One table for each worker process, tokenizer and use."""
    return PackedCodes(path, keep, limit)


emptied_by(kept_codes.cache_clear)
