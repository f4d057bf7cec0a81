"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search goes through the text once. For every boundary it keeps the best path
that ends there, as the last piece and a pointer back; a piece reaches back at most
as far as the longest one, so only that window of boundaries is alive. Whenever all
paths from the window meet at one boundary, the ids up to it are final, leave, and
the text before it is forgotten.

Which path is best depends on the kind of model. In a unigram model it has the
greatest sum of scores. In a merge (BPE) model it is the one whose neighbouring
pieces all stay apart when they are merged alone, pair by pair; every boundary has
exactly one such path, and it is what merging the whole text yields.

Words that come again are looked up: where no piece can reach across a boundary, the
paths meet there, so what stands between two such boundaries has ids of its own. New
words are searched in their order, so that those with the same beginning share its
boundaries and their best paths.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

BLANK = "▁"
#: Words that a worker remembers (the first it meets), and pairs of pieces before it starts anew.
REMEMBERED = 1_000_000
#: Characters of texts whose words are looked up together.
TOGETHER = 4_000_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protobuf message: numbers and their values."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at : at + size]
            at += size


class Model:
    """Pieces, scores and rules of a model file."""

    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            spec = dict(_fields(f.read()))  # the last of the repeated pieces is not used
        trainer, normaliser = dict(_fields(spec[2])), dict(_fields(spec.get(3, b"")))
        if normaliser.get(2):
            raise ValueError("only models that leave characters as they are can be streamed")
        self.merges = trainer.get(3, 1) == 2
        self.prefix, self.trim = bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
        self.unknown = library.unk_id()
        n = library.get_piece_size()
        self.names = [library.id_to_piece(i) for i in range(n)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_unused(i) for i in range(n)]
        byte = [i for i in range(n) if library.is_byte(i)]
        self.byte_ids = {int(self.names[i][1:-1], 16): i for i in byte}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i in range(n) if library.is_control(i)}
        self.ids = {p: i for i, p in enumerate(self.names) if not special[i] and i not in self.byte_of}
        self.scores = {i: library.get_score(i) for i in self.ids.values()}
        self.longest = max(map(len, self.ids))
        # every beginning of a piece: its id if it is one itself, else -1
        self.starts = {p[:n]: -1 for p in self.ids for n in range(1, len(p))} | self.ids
        self.unknown_score = min(self.scores.values()) - 10.0
        # no piece holds a blank after another character: paths meet before every word
        self.words_meet = not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        self.pairs: dict[int, dict[int, bool]] = {}  # right piece, left piece
        self.paired = 0
        self.ends: dict[int, tuple] = {}
        self.grown: dict[str, dict] = {}  # beginnings of pieces, by character: what they grow to
        self.steps = 0
        self.memory: dict[str, bytes] = {}

    def normal(self, text: str) -> str:
        """Blanks as the vocabulary has them, one before the text if the model wants it."""
        if self.trim:
            text = " ".join(text.split(" ")) if "  " not in text and text[:1] != " " != text[-1:] else " ".join(w for w in text.split(" ") if w)
        return (BLANK if self.prefix and text else "") + text.replace(" ", BLANK)

    def _fallback(self, char: str) -> tuple[int, ...]:
        if self.byte_ids:
            return tuple(self.byte_ids[b] for b in char.encode())
        return (self.unknown,)

    def _ends(self, piece: int) -> tuple[list[tuple], list[tuple], bool]:
        """How a piece grows from its characters when merged alone, best score first
        and then leftmost: per merge its score and the piece then standing at the
        right end, the same for the left end (characters first), and whether it is reached."""
        known = self.ends.get(piece)
        if known is None:
            parts = list(self.names[piece])
            right, left = [(None, parts[-1])], [(None, parts[0])]
            while len(parts) > 1:
                best = None
                for i in range(len(parts) - 1):
                    found = self.ids.get(parts[i] + parts[i + 1])
                    if found is not None and (best is None or self.scores[found] > best[0]):
                        best = self.scores[found], i
                if best is None:
                    break
                i = best[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                right.append((best[0], parts[-1]))
                left.append((best[0], parts[0]))
            known = self.ends[piece] = (right, left, len(parts) == 1)
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Whether two neighbouring pieces stay as they are when merged together.

        Their merges go on side by side, the better score first and the left piece's
        on a tie, until a merge across the boundary would come before both or none is left."""
        beside = self.pairs.setdefault(right, {})
        known = beside.get(left)
        if known is not None:
            return known
        (ours, _, one), (_, theirs, other) = self._ends(left), self._ends(right)
        i, j, known = 0, 0, one and other
        while known:
            next_left = ours[i + 1][0] if i + 1 < len(ours) else None
            next_right = theirs[j + 1][0] if j + 1 < len(theirs) else None
            across = self.ids.get(ours[i][1] + theirs[j][1])
            if across is not None:
                score = self.scores[across]
                # left merges stand before the boundary, right ones behind it
                if (next_left is None or score > next_left) and (next_right is None or score >= next_right):
                    known = False
                    break
            if next_left is None and next_right is None:
                break
            if next_right is None or (next_left is not None and next_left >= next_right):
                i += 1
            else:
                j += 1
        if self.paired > REMEMBERED:
            for held in self.pairs.values():
                held.clear()
            self.paired = 0
        beside[left] = known
        self.paired += 1
        return known

    def stream(self, chars: Iterator[str]) -> Iterator[tuple[int, ...]]:
        """Ids of a stream of characters (or of strings), in committed runs. Holds the
        window, and what came with the string that reached beyond it."""
        text = ""  # from the last committed boundary on
        best: list[tuple[float, int, tuple[int, ...]] | None] = [(0.0, -1, ())]  # score, boundary before, ids of the last piece
        done, more = 0, True
        reach, starts, merges = self.longest, self.starts, self.merges
        chars = iter(chars)
        while more or done < len(text):
            while more and len(text) < done + reach:
                piece = next(chars, None)
                more = piece is not None
                text += piece or ""
            if done == len(text):
                break
            upto = min(len(text), done + reach)
            if len(best) <= upto:
                best += [None] * (upto + 1 - len(best))
            here = best[done]
            if here is not None:
                score, _, last = here
                after = last[-1] if last and last[-1] in self.scores else None
                for end in range(done + 1, upto + 1):
                    found = starts.get(text[done:end])
                    if found is None:
                        break  # no piece begins like this
                    if found < 0:
                        continue
                    if merges:
                        # a boundary has one path, so the first one found is it
                        if best[end] is None and (after is None or self._apart(after, found)):
                            best[end] = (0.0, done, (found,))
                    elif best[end] is None or best[end][0] < score + self.scores[found]:
                        best[end] = (score + self.scores[found], done, (found,))
                if text[done] not in self.ids:
                    ids = self._fallback(text[done])
                    if best[done + 1] is None or (not self.merges and best[done + 1][0] < score + self.unknown_score):
                        best[done + 1] = (score + self.unknown_score, done, ids)
            done += 1
            if done >= 4 * reach:
                at = self._meeting(best, done)
                if at:
                    yield self._path(best, at)
                    text, best, done = text[at:], [(best[at][0], -1, best[at][2]), *best[at + 1 :]], done - at
                    best = [best[0], *[b and (b[0], b[1] - at, b[2]) for b in best[1:]]]
        if done:
            yield self._path(best, done)

    def _meeting(self, best, done: int) -> int:
        """The boundary at which the paths of all alive boundaries meet; 0 if none has yet."""
        alive = {i for i in range(max(0, done + 1 - self.longest), len(best)) if best[i] is not None}
        while len(alive) > 1:
            top = max(alive)
            alive.discard(top)
            alive.add(best[top][1])
        return max(0, alive.pop())

    @staticmethod
    def _path(best, at: int) -> tuple[int, ...]:
        parts = []
        while best[at][1] >= 0:
            parts.append(best[at][2])
            at = best[at][1]
        return tuple(i for p in reversed(parts) for i in p)

    def _grow(self, node: str, char: str) -> tuple[str, dict, list]:
        """The longest end of ``node + char`` that a piece begins with, what is known of how
        that grows, and the pieces that end there, longest first: piece, length, ids and its
        known neighbours to the left; -1 for a character without a piece."""
        if self.steps > REMEMBERED:
            for held in self.grown.values():
                held.clear()
            self.steps = 0
        self.steps += 1
        text = node + char
        while text and text not in self.starts:
            text = text[1:]
        ends = [(self.ids[text[k:]], len(text) - k) for k in range(len(text)) if text[k:] in self.ids]
        found = [(i, n, i.to_bytes(4, "little"), self.pairs.setdefault(i, {})) for i, n in ends]
        if char not in self.ids:
            found.append((-1, 1, np.array(self._fallback(char), "<u4").tobytes(), {}))
        return text, self.grown.setdefault(text, {}), found

    def search(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of a merge model, each by itself. The best path to a boundary hangs
        on what stands before it only, so boundaries are kept as far as a word begins like
        the last one. No word is longer than 64 characters."""
        apart = self._apart
        # per boundary: how the longest beginning of a piece that ends there grows, the best path's last piece and ids
        grows: list = [("", self.grown.setdefault("", {}))] * 65
        last, path = [-1] * 65, [b""] * 65
        out, before = {}, ""
        for word in sorted(words):
            same = 0
            for x, y in zip(before, word, strict=False):
                if x != y:
                    break
                same += 1
            node = grows[same]
            for end, char in enumerate(word[same:], same + 1):
                hit = node[1].get(char)
                if hit is None:
                    text, onwards, found = self._grow(node[0], char)
                    hit = node[1][char] = (text, onwards), found
                node, found = hit
                grows[end] = node
                last[end] = -2  # no path
                for piece, n, ids, beside in found:
                    prior = last[end - n]
                    # a boundary has one path, so the first one found is it
                    if prior < 0 or piece < 0:
                        fits = prior != -2
                    else:
                        fits = beside.get(prior)
                        if fits is None:
                            fits = apart(prior, piece)
                    if fits:
                        last[end] = piece
                        path[end] = path[end - n] + ids
                        break
            out[word] = path[len(word)]
            before = word
        return out

    def _keys(self, text: str) -> list[str]:
        """The words of a text; one after a single blank stands without it, where a text begins with a blank."""
        if self.prefix and text and "  " not in text and BLANK not in text and text[0] != " " != text[-1]:
            return text.split(" ")
        return _words(self.normal(text))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, packed as little-endian unsigned 32-bit integers."""
        if not self.words_meet:
            return [np.fromiter((i for run in self.stream(self.normal(t)) for i in run), dtype="<u4").tobytes() for t in texts]
        out, held, size = [], [], 0
        for text in texts:
            held.append(self._keys(text))
            size += len(text)
            if size >= TOGETHER:
                out += self._looked_up(held)
                held, size = [], 0
        return out + self._looked_up(held)

    def _looked_up(self, texts: list[list[str]]) -> list[bytes]:
        memory = self.memory
        keys = set().union(*texts)
        new = {k: k if BLANK in k or not self.prefix else BLANK + k for k in keys.difference(memory)}
        short = {k: w for k, w in new.items() if len(w) <= 64 and self.merges}
        ids = self.search(list(set(short.values())))
        found = {k: ids[w] for k, w in short.items()}
        for key, word in new.items():
            if key not in short:
                found[key] = b"".join(np.array(run, "<u4").tobytes() for run in self.stream(word))
        room = REMEMBERED - len(memory)
        if room > 0:
            memory.update(islice(((k, i) for k, i in found.items() if len(k) <= 64), room))
        known = memory
        if not found.keys() <= memory.keys():
            known = found | {k: memory[k] for k in keys if k in memory}
        return [b"".join(map(known.__getitem__, t)) for t in texts]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        return np.frombuffer(self.encode_all([text])[0], "<u4")

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        names, bytes_ = self.names, self.byte_of
        if bytes_.keys().isdisjoint(ids) and self.silent.isdisjoint(ids):
            text = "".join(map(names.__getitem__, ids))
        else:
            parts, held = [], bytearray()
            for i in ids:
                if i in bytes_:
                    held.append(bytes_[i])
                    continue
                if held:
                    parts.append(held.decode(errors="replace"))
                    held.clear()
                if i not in self.silent:
                    parts.append(names[i])
            text = "".join([*parts, held.decode(errors="replace")])
        text = text.replace(BLANK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _words(normal: str) -> list[str]:
    """Runs of blanks with the word after them."""
    if BLANK + BLANK not in normal:
        first, *rest = normal.split(BLANK)
        return ([first] if first else []) + [BLANK + w for w in rest]
    out, at, n = [], 0, len(normal)
    while at < n:
        end = at
        while end < n and normal[end] == BLANK:
            end += 1
        end = normal.find(BLANK, end) if normal.find(BLANK, end) >= 0 else n
        out.append(normal[at:end])
        at = end
    return out


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    """One per worker and model file."""
    return Model(path)


def encode(docs: DataFrame, path: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``docs`` with a binary column ``to``: ids as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Row by row: keys are not read, repeated rows
    give repeated results, other columns stay (one called ``to`` is replaced). No
    rows: no rows.
    """

    @F.pandas_udf(BinaryType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model(path).encode_all([t or "" for t in texts]))

    return docs.withColumn(to, run(F.col(text).cast("string")))


def decode(rows: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with a string column ``to``: the text of ``ids``; null for null ids."""

    @F.pandas_udf(StringType())
    def run(found: pd.Series) -> pd.Series:
        own = model(path)
        return pd.Series([None if i is None else own.decode(np.frombuffer(i, "<u4").tolist()) for i in found])

    return rows.withColumn(to, run(F.col(ids)))
