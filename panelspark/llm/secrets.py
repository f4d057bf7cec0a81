"""Secrets: strict rules, and strings that a primed compressor cannot shorten.

Base spans come from rules for assignments, access keys and long hex strings. Beside
them, a string in a sensitive context (a cue stands shortly before it) is measured
by the bytes it adds to what zstandard makes of the code around it, when primed with
a dictionary of identifiers: names, words and repeats of what stands nearby cost
little, keys cost nearly a byte a character. Those above a threshold are reported.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")

# The base rules, cues of a sensitive context, identifiers.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_HINT = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_CUE = re.compile(
    r"pass(?:word|wd|phrase)|secret|token|api[_-]?key|private[_ -]?key|credential|bearer|authorization|auth[_-]|signature|client[_-]id|session[_-]?id|access[_-]?key|connection[_-]?string",
    re.IGNORECASE | re.ASCII,
)
_STRING = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key private_key public_key client_id client_secret session_id authorization bearer signature "
    "credential connection_string username user_id account_id request response header content_type application_json environment variable config settings "
    "default example placeholder changeme your_api_key_here your_secret_here xxxxxxxxxxxxxxxx 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ "
    "function return import export const static public private protected class interface string number boolean undefined null true false self this "
    "http https www com org net index html json yaml xml utf-8 base64 sha256 md5 uuid timestamp created_at updated_at localhost production development test"
)


@lru_cache(maxsize=4)
def _compressor(identifiers: str, level: int = 9) -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_dict_id=False)


def novelty(candidate: str, before: str, after: str, identifiers: str = IDENTIFIERS) -> float:
    """Bytes a character that ``candidate`` adds to the compressed text around it."""
    compress = _compressor(identifiers).compress
    around = (before + "\n" + after + "\n").encode()
    return (len(compress(around + candidate.encode())) - len(compress(around))) / len(candidate)


def base(text: str) -> list[tuple[int, int, int]]:
    """Base spans ``(start, kind, end)``: leftmost, not overlapping within a kind."""
    out = []
    if _HINT.search(text):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _mixed(word: str) -> bool:
    return any(c.isdigit() for c in word) and any(c.isalpha() for c in word)


def _blanked(text: str, lo: int, hi: int, word: str, strings: list[tuple[int, int]]) -> str:
    """``text[lo:hi]`` with a blank for each of ``strings`` that equals, holds or is part of ``word``."""
    out, at = [], lo
    for start, end in strings[bisect_right(strings, lo, key=lambda s: s[1]) :]:
        if start >= hi:
            break
        other = text[start:end]
        if word in other or (other in word and _mixed(other)):
            out += [text[at : max(at, start)], " "]
            at = max(at, min(hi, end))
    return "".join([*out, text[at:hi]])


def novel(text: str, known: list[tuple[int, int, int]], least: float = 0.6, reach: int = 64, around: int = 256) -> list[tuple[int, int, int]]:
    """Spans of strings within ``reach`` characters after a cue that mix letters and
    digits, overlap no known span and add at least ``least`` bytes a character to what
    stands ``around`` them, their own copies left out."""
    out, last, strings = [], 0, None
    for cue in _CUE.finditer(text):
        for m in _STRING.finditer(text, max(last, cue.end())):
            if m.start() > cue.end() + reach:
                break
            last = m.end()
            word = m.group()
            if any(s < m.end() and m.start() < e for s, _, e in known):
                continue
            if not _mixed(word):
                continue
            if strings is None:
                strings = [x.span() for x in _STRING.finditer(text)]
            before = _blanked(text, max(0, m.start() - around), m.start(), word, strings)
            after = _blanked(text, m.end(), min(len(text), m.end() + around), word, strings)
            if novelty(word, before, after) >= least:
                out.append((m.start(), 3, m.end()))
    return out


def scanner(least: float = 0.6):
    """A function of a text column that gives the base and all spans."""

    @F.pandas_udf("struct<base:array<struct<start:int,kind:int,end:int>>,spans:array<struct<start:int,kind:int,end:int>>>")
    def scan(texts: pd.Series) -> pd.DataFrame:
        found = [base(t or "") for t in texts]
        every = [sorted(b + novel(t, b, least)) if t else [] for t, b in zip(texts, found, strict=True)]
        rows = lambda spans: [{"start": s, "kind": k, "end": e} for s, k, e in spans]
        return pd.DataFrame({"base": [rows(x) for x in found], "spans": [rows(x) for x in every]})

    return scan


def find(docs: DataFrame, text: str = "text", to: str = "secrets", least: float = 0.6) -> DataFrame:
    """``docs`` with a struct column ``to``: ``base`` and ``spans``, arrays of
    ``(start, kind, end)`` by start and kind; places are code points, ends exclusive.

    ``least`` is the threshold of novelty in bytes a character. Whole texts are
    scanned; null and empty ones have no spans. Row by row: repeated rows give
    repeated results, keys are not read, other columns stay (one called ``to`` is
    replaced). No rows: no rows.
    """
    return docs.withColumn(to, scanner(least)(F.col(text).cast("string")))
