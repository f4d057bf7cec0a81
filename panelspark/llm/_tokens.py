"""Token ids of whole texts by the tokenizers library, with a memory of words.

Neither of the two kinds of vocabulary merges across a blank that stands between
words, so a text's ids are those of its words in turn. Words are looked up in a
dictionary that holds a bounded number of them and lives in the Python worker until a
task of an operator without tokens starts there; what is missing is encoded in one batch by the library. A text in which the
cut would not be safe (one with odd control characters, or with an added token of the
vocabulary written out in it) is encoded as a whole.
"""

from __future__ import annotations

import gc
import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from panelspark.llm._shared import keep

#: Words that a worker remembers for good, and for a while (together about 200 MB), and
#: the length from which a word is forgotten with its batch.
REMEMBERED, RECENT, LONG = 800_000, 200_000, 64

# A boundary before a single blank between two words: no piece reaches across it.
_SINGLE_BLANK = re.compile(r"(?<=\S)(?= \S)")
# Control characters that Python takes for blanks and the library does not.
_ODD_BLANKS = "\x1c\x1d\x1e\x1f"
_ONE_WORD = re.compile(rf"\S{{1,{LONG}}}").fullmatch
# Beyond these letters lower-casing before normalising might differ from after.
_BEYOND = re.compile("[^\x00-įı-ſ]")


class _Memory:
    """Ids of words, each with ``blank`` before it. Words met first stay; of later ones the
    newest go when there are too many. ``between`` is what may stand between two words and
    leave both their ids as they are here."""

    def __init__(self, library: Tokenizer, blank: str, between: str):
        self.library, self.blank, self.between = library, blank, between
        self.ids: dict[str, bytes] = {}
        self.passing: list[str] = []

    def learn(self, words: set[str]) -> None:
        """Make sure that the words of a batch are known."""
        for word in self.passing:
            del self.ids[word]
        while len(self.ids) > REMEMBERED + RECENT:
            for _ in range(RECENT):
                self.ids.popitem()
        missing = words.difference(self.ids)
        # Words go to the library many at a time, as one text; what is not one word goes alone.
        together = list(filter(_ONE_WORD, missing))
        alone = list(missing.difference(together))
        self.passing = [w for w in alone if len(w) > LONG]
        for at in range(0, len(together), 512):
            self._together(together[at : at + 512])
        for at in range(0, len(alone), 512):
            part = alone[at : at + 512]
            for word, found in zip(part, self.library.encode_batch_fast([self.blank + w for w in part], add_special_tokens=False), strict=True):
                self.ids[word] = np.array(found.ids, "<u4").tobytes()

    def _together(self, words: list[str]) -> None:
        """Ids of words from those of a text of them, by where in it each id ends."""
        found = self.library.encode(self.blank + self.between.join(words), add_special_tokens=False)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1 + len(self.blank)
        begins = ends - [len(w) + len(self.blank) for w in words]
        reach = np.array([end for _, end in found.offsets], np.int64)
        first, last = (4 * np.searchsorted(reach, at, "right") for at in (begins, ends))
        ids = np.array(found.ids, "<u4").tobytes()
        for word, a, b in zip(words, first.tolist(), last.tolist(), strict=True):
            self.ids[word] = ids[a:b]


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, as the library gives them for whole texts."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.added = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        blanks_vanish = self.library.normalizer is not None and not self.library.encode(" ", add_special_tokens=False).ids
        self.cut = self._words if blanks_vanish else self._spaced
        self.plain, self.spaced = _Memory(self.library, "", " " if blanks_vanish else "\n"), _Memory(self.library, " ", " ")
        self.line = np.array(self.library.encode("\n", add_special_tokens=False).ids, "<u4").tobytes()

    def _whole(self, text: str, low: str) -> bool:
        return any(a in low for a in self.added) or any(c in text for c in _ODD_BLANKS)

    def _words(self, text: str) -> list[tuple[list[str], list[str]]]:
        """For vocabularies that drop blanks and case."""
        low = text.lower()
        if self._whole(text, low):
            return [([text], [])]
        return [((text if _BEYOND.search(text) else low).split(), [])]

    def _spaced(self, text: str) -> list[tuple[list[str], list[str]]]:
        """For byte-level vocabularies: of each line the first word, and those with a blank
        before them. A line break between two words is an id of its own."""
        if self._whole(text, text.lower()):
            return [([text], [])]
        if len(text.split()) != text.count(" ") + text.count("\n") + 1:  # blanks side by side, or others
            first, *rest = _SINGLE_BLANK.split(text)
            return [([first], [w[1:] for w in rest])]
        lines = [line.split(" ") for line in text.split("\n")]
        return [(words[:1], words[1:]) for words in lines]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut(t) for t in texts]
        for memory, at in ((self.plain, 0), (self.spaced, 1)):
            memory.learn(set().union(*[line[at] for lines in cut for line in lines]))
        plain, spaced = self.plain.ids.__getitem__, self.spaced.ids.__getitem__
        return [self.line.join([b"".join([*map(plain, first), *map(spaced, rest)]) for first, rest in lines]) for lines in cut]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per worker and vocabulary file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Encoder(path)


@keep
def _forget() -> None:
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        gc.collect()  # an encoder holds a method of its own


def batches_of(rows: list, size: int = 2 << 20):
    """Slices of ``(key, text)`` rows with about ``size`` characters each."""
    part, many = [], 0
    for row in rows:
        part.append(row)
        many += len(row[1])
        if many >= size:
            yield part
            part, many = [], 0
    if part:
        yield part
