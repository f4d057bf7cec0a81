"""Fill-in-middle: texts cut into prefix, middle and suffix and put in another order.

A batch of texts is one array of bytes. The cuts are scanned for in that array; a
difference array holds at each cut how far the bytes from there on move, so that its
running sum is every byte's displacement, and one scatter writes all outputs. Reading
the same displacements backwards, by a gather, restores the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
FORMS = ("plain", "psm", "spm")
BLOCK = 1 << 21  # bytes of text handled at a time; longer texts are a block of their own
WINDOW = 1 << 20  # bytes whose displacements are summed at a time
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CUT = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"


def _check_marks(marks: tuple[str, str, str]) -> list[np.ndarray]:
    """Marks as bytes; refuses marks that could arise where a text meets a mark."""
    for a in marks:
        for b in marks:
            if not a or (a is not b and a in b) or any(b.startswith(a[i:]) for i in range(1, len(a))):
                raise ValueError(f"marks {a!r} and {b!r} overlap")
    return [np.frombuffer(m.encode(), np.uint8) for m in marks]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array without nulls, and where each text begins and ends."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def _texts_of(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds)), pa.py_buffer(data)]).cast(pa.string())


def _blocks(bounds: np.ndarray):
    """Ranges of texts of at most ``BLOCK`` bytes together, one at least."""
    at = 0
    while at < len(bounds) - 1:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK, "right")) - 1)
        yield at, to
        at = to


def unit_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where units end: words with the blanks before them, and blanks at a text's end."""
    space = _SPACE[data]
    ends = np.zeros(len(data), bool)
    np.logical_and(~space[:-1], space[1:], out=ends[:-1])
    ends[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
    return np.flatnonzero(ends) + 1


def _places(data: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Where ``mark`` begins in ``data``."""
    at = np.flatnonzero(data[: max(0, len(data) - len(mark) + 1)] == mark[0])
    for i in range(1, len(mark)):
        at = at[data[at + i] == mark[i]]
    return at


def _inside(at: np.ndarray, width: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``at`` whose ``width`` bytes lie in one text, and that text."""
    of = np.searchsorted(bounds, at, "right") - 1
    whole = at + width <= bounds[of + 1]
    return at[whole], of[whole]


def _displaced(size: int, places: np.ndarray, steps: np.ndarray):
    """Windows ``(lo, hi, places of lo to hi after displacement)``: the running sum of
    ``steps`` at ``places``, added to each byte's own place."""
    order = np.argsort(places, kind="stable")
    places, steps, moved = places[order], steps[order], 0
    for lo in range(0, size, WINDOW):
        hi = min(size, lo + WINDOW)
        first, last = np.searchsorted(places, [lo, hi], "left")
        change = np.zeros(hi - lo, np.int64)
        np.add.at(change, places[first:last] - lo, steps[first:last])
        change[0] += moved
        np.cumsum(change, out=change)
        moved = int(change[-1])
        change += np.arange(lo, hi)
        yield lo, hi, change


def _steps(begins: list[np.ndarray], shifts: list[np.ndarray], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The difference array of adjoining parts: each part's shift begins where the part
    begins and the last one's stops at ``ends``."""
    steps = [shifts[0], *[b - a for a, b in zip(shifts, shifts[1:], strict=False)], -shifts[-1]]
    return np.concatenate([*begins, ends]), np.concatenate(steps)


def cut_block(data, bounds, h, marks, percent, spm_percent):
    """Outputs of a block: their bytes and bounds, units, forms, characters of prefix and middle."""
    p, s, m = marks
    starts, ends = bounds[:-1], bounds[1:]
    at = unit_ends(data, bounds)
    first = np.searchsorted(at, starts, "right")
    n = np.searchsorted(at, ends, "right") - first
    cuts = [h[0] % (n + 1), h[1] % (n + 1)]
    at = np.append(at, 0)
    lo, hi = (np.where(k == 0, starts, at[first + k - 1]) for k in (np.minimum(*cuts), np.maximum(*cuts)))
    plain = (n == 0) | (h[2] % 100 >= percent)
    for mark in marks:
        plain[_inside(_places(data, mark), len(mark), bounds)[1]] = True
    spm = ~plain & (h[3] % 100 < spm_percent)
    form = np.where(plain, 0, np.where(spm, 2, 1))
    # The place of each part in the output, the marks before them counted in.
    size = ends - starts + np.where(plain, 0, len(p) + len(s) + len(m))
    out_bounds = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(out_bounds[-1], np.uint8)
    begin = out_bounds[:-1]
    prefix = begin + np.where(plain, 0, np.where(spm, len(s) + ends - hi + len(p), len(p)))
    suffix = begin + np.where(plain, hi - starts, np.where(spm, len(s), len(p) + lo - starts + len(s)))
    middle = np.where(plain, begin + lo - starts, out_bounds[1:] - (hi - lo))
    places, steps = _steps([starts, lo, hi], [prefix - starts, middle - lo, suffix - hi], ends)
    for a, b, to in _displaced(len(data), places, steps):
        out[to] = data[a:b]
    for part, mark in ((prefix, p), (suffix, s), (middle, m)):
        out[(part[~plain] - len(mark))[:, None] + np.arange(len(mark))] = mark
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return out, out_bounds, n, form, chars[lo] - chars[starts], chars[hi] - chars[lo]


def restore_block(data, bounds, form, marks):
    """Texts of a block of outputs: their bytes and bounds."""
    moved = np.flatnonzero(form != 0)
    at = []
    for mark in marks:
        place, of = _inside(_places(data, mark), len(mark), bounds)
        mine = form[of] != 0
        place, of = place[mine], of[mine]
        if not np.array_equal(of, moved):
            raise ValueError("an output must hold each mark once")
        full = np.zeros(len(form), np.int64)
        full[of] = place
        at.append(full)
    widths = [len(m) for m in marks]
    starts, ends = bounds[:-1], bounds[1:]
    plain, spm = form == 0, form == 2
    size = ends - starts - np.where(plain, 0, sum(widths))
    back = np.concatenate([[0], np.cumsum(size)])
    prefix = np.where(plain, starts, at[0] + widths[0])
    suffix = np.where(plain, ends, at[1] + widths[1])
    middle = np.where(plain, ends, at[2] + widths[2])
    n_prefix = np.where(plain, size, np.where(spm, at[2], at[1]) - prefix)
    n_middle = np.where(plain, 0, ends - middle)
    begins = [back[:-1], back[:-1] + n_prefix, back[:-1] + n_prefix + n_middle]
    places, steps = _steps(begins, [prefix - begins[0], middle - begins[1], suffix - begins[2]], back[1:])
    out = np.empty(back[-1], np.uint8)
    for a, b, source in _displaced(len(out), places, steps):
        out[a:b] = data[source]
    return out, back


def _cutter(marks, percent: int, spm_percent: int):
    coded = _check_marks(marks)

    @F.arrow_udf(_CUT)
    def cut(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        data, bounds = _bytes_of(texts)
        h = [x.to_numpy(zero_copy_only=False) for x in (h1, h2, h3, h4)]
        parts = []
        for a, b in _blocks(bounds):
            out, ends, n, form, before, within = cut_block(
                data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], [x[a:b] for x in h], coded, percent, spm_percent
            )
            columns = [
                pa.array(n),
                pa.array(FORMS).take(pa.array(form)),
                pa.array(before, mask=form == 0),
                pa.array(within, mask=form == 0),
                _texts_of(out, ends),
            ]
            parts.append(pa.StructArray.from_arrays(columns, ["n", "form", "prefix_chars", "middle_chars", "output"]))
        return pa.concat_arrays(parts) if parts else pa.array([], _struct())

    return cut


def _struct() -> pa.DataType:
    return pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


def _restorer(marks):
    coded = _check_marks(marks)

    @F.arrow_udf("string")
    def back(texts: pa.Array, forms: pa.Array) -> pa.Array:
        data, bounds = _bytes_of(texts)
        form = np.array([FORMS.index(f) for f in forms.to_pylist()], np.int64)
        parts = [_texts_of(*restore_block(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], form[a:b], coded)) for a, b in _blocks(bounds)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return back


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 of a key: the first digits of sha256 of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(
    docs: DataFrame, text: str = "text", key: str = "doc_id", to: str = "infill", percent: int = 50, spm_percent: int = 80, seed: int = 42, marks: tuple[str, str, str] = MARKS
) -> DataFrame:
    """``docs`` with a struct column ``to``: ``n`` units, ``form``, ``prefix_chars``,
    ``middle_chars`` (code points; null for plain texts) and ``output``.

    ``percent`` of the texts are cut, ``spm_percent`` of these get the suffix first
    (``spm``), the others the prefix first (``psm``); all draws follow from the key and
    ``seed``, so repeated rows give repeated results under any partitioning. Texts that
    hold a mark, and empty ones, stay plain. A null text counts as empty, a null key as
    the empty string. Cuts lie between units, a word with the blanks before it, and are
    made in whole texts however long. Other columns stay (one called ``to`` is
    replaced). No rows: no rows.
    """
    cut = _cutter(marks, percent, spm_percent)
    return docs.withColumn(to, cut(F.coalesce(F.col(text).cast("string"), F.lit("")), *draws(F.col(key), seed)))


def restore(cut: DataFrame, column: str = "infill", to: str = "restored", marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``cut`` with the text that each output was made of in a column ``to``, from
    ``column.output`` and ``column.form`` alone. A null output counts as an empty plain
    text; an output that lacks a mark, or holds one twice, raises. Row by row: repeats
    stay repeats, other columns stay (one called ``to`` is replaced)."""
    output, form = F.col(f"{column}.output"), F.col(f"{column}.form")
    return cut.withColumn(to, _restorer(marks)(F.coalesce(output, F.lit("")), F.when(output.isNull(), FORMS[0]).otherwise(form)))
