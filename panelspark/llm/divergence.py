"""How the sources of a language differ in their words.

Identical texts of a language are collapsed to one, with the number of its documents in
each source; each is cut into terms once, and its counts go into every source with that
weight. Only terms that occur are kept per source. The values of a pair of sources over
all terms are put together from the terms that both have, those that one has (by how
often each count occurs) and the number of those that neither has.

Shares are whole numbers of 10^-9, and every division is a whole one, so results are exact.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelspark.llm._shared import written

# The unit of shares, as factors whose products with a remainder fit.
_SCALE = (1000, 1000, 1000)
_TERM = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
BLOCK = 1 << 21  # bytes of text cut at a time
TERMS = 400_000  # different terms that a task holds before it hands on what it has
ENTRIES = 3_000_000  # counts that a task holds before it adds them up
_COUNTS = "lang string, term string, source string, n bigint, docs bigint"


def collapsed(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, text, copies)``: each different text of a language once, with
    ``copies``, an array of ``(source, n)``.

    Texts are told apart by sha256. Each task of the reading stage hands on a text once,
    however many copies it has read; copies are counted apart from the texts. Nulls count
    as the empty string. Keys are not read: repeated rows count as often as they stand."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    keyed = plain.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = keyed.groupBy("digest", "lang", "source").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.groupBy("digest", "lang").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = keyed.where("text != ''").groupBy("digest", "lang").agg(F.first("text").alias("text"))
    return texts.join(copies, ["digest", "lang"]).select("lang", "text", "copies")


class _Tally:
    """Counts per (term, slot) of one task, slots being sources of a language or, with
    source None, the documents of a language."""

    def __init__(self):
        self.slots: dict = {}
        self.restart()

    def restart(self) -> None:
        self.terms: dict = defaultdict()
        self.terms.default_factory = self.terms.__len__
        self.keys, self.values, self.held = [], [], 0

    def slot(self, lang: str, source: str | None) -> int:
        return self.slots.setdefault((lang, source), len(self.slots))

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys.append(keys)
        self.values.append(values)
        self.held += len(keys)

    def add_up(self) -> None:
        keys = np.concatenate([np.zeros(0, np.int64), *self.keys])
        values = np.concatenate([np.zeros(0, np.int64), *self.values])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        values = np.add.reduceat(values[order], first) if len(first) else values
        self.keys, self.values, self.held = [keys[first]], [values], len(first)

    def rows(self):
        """All counts, added up, as Arrow batches; then starts anew. A term's documents in a
        language stand beside its count in one of the sources, and are 0 beside the others."""
        self.add_up()
        term, slot, value = self.keys[0] >> 32, self.keys[0] & 0xFFFFFFFF, self.values[0]
        names: dict = {}
        lang = np.array([names.setdefault(s[0], len(names)) for s in self.slots], np.int64)
        whole = np.array([s[1] is None for s in self.slots], bool)
        # The documents of a term in a language come right before its sources.
        order = np.lexsort((~whole[slot], lang[slot], term))
        term, slot, value = term[order], slot[order], value[order]
        first = np.flatnonzero(whole[slot])
        docs = np.zeros(len(term), np.int64)
        docs[first + 1] = value[first]
        # Rows of a source side by side: the shuffle files compress these best.
        own = np.delete(np.arange(len(term)), first)
        own = own[np.lexsort((term[own], slot[own]))]
        terms = pa.array(self.terms, pa.binary()).cast(pa.string())
        langs, sources = (pa.array([s[i] for s in self.slots], pa.string()) for i in (0, 1))
        for at in range(0, len(own), 100_000):
            part = own[at : at + 100_000]
            of = pa.array(slot[part])
            columns = [langs.take(of), terms.take(pa.array(term[part])), sources.take(of), pa.array(value[part]), pa.array(docs[part])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "source", "n", "docs"])
        self.restart()


def _words(text: str):
    """Terms of a text, in parts of bounded size."""
    data = text.encode()
    at = 0
    while at < len(data):
        to = at + BLOCK
        part = data[at:to].translate(_TERM)
        while to < len(data) and (cut := part.rfind(b" ") + 1) == 0:  # a term longer than a part
            to += BLOCK
            part = data[at:to].translate(_TERM)
        if to < len(data):
            part = part[:cut]
        at += len(part)
        yield part.split()


def _tally_block(tally: _Tally, rows: list[tuple]) -> None:
    """Add the rows ``(lang, parts of term numbers, copies)`` of a block."""
    ids = np.concatenate([p for _, parts, _ in rows for p in parts] or [np.zeros(0, np.int64)])
    doc = np.repeat(np.arange(len(rows)), [sum(map(len, parts)) for _, parts, _ in rows])
    keys, n = np.unique(doc << 32 | ids, return_counts=True)
    doc, term = keys >> 32, keys & 0xFFFFFFFF
    slots = [tally.slot(lang, None) for lang, _, _ in rows]
    weight = [sum(c["n"] for c in copies) for _, _, copies in rows]
    tally.add(term << 32 | np.array(slots, np.int64)[doc], np.array(weight, np.int64)[doc])
    own = [(tally.slot(lang, c["source"]), c["n"]) for lang, _, copies in rows for c in copies]
    slot, weight = np.array([s for s, _ in own], np.int64), np.array([w for _, w in own], np.int64)
    many = np.array([len(copies) for _, _, copies in rows])
    first = np.cumsum(many) - many
    # Entry e of a document with k sources becomes k counts.
    times = many[doc]
    entry = np.repeat(np.arange(len(doc)), times)
    which = first[doc][entry] + np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times)
    tally.add(term[entry] << 32 | slot[which], n[entry] * weight[which])


def _count(batches):
    tally, block, size = _Tally(), [], 0
    for batch in batches:
        for lang, text, copies in zip(*(batch.column(i) for i in range(3)), strict=True):
            parts = []
            for words in _words(text.as_py()):
                parts.append(np.fromiter(map(tally.terms.__getitem__, words), np.int64, len(words)))
                size += sum(map(len, words))
            block.append((lang.as_py(), parts, copies.as_py()))
            if size < BLOCK:
                continue
            _tally_block(tally, block)
            block, size = [], 0
            if tally.held > ENTRIES:
                tally.add_up()
            if len(tally.terms) > TERMS or tally.held > ENTRIES // 2:
                yield from tally.rows()
    if block:
        _tally_block(tally, block)
    yield from tally.rows()


def term_counts(docs: DataFrame, least_docs: int = 3, **columns: str) -> DataFrame:
    """``(lang, term, n, by_source)`` of every term in at least ``least_docs`` documents
    of a language: ``n`` occurrences there, ``by_source`` an array of ``(source, n)`` of the
    sources that have the term.

    Terms are runs of letters and of whatever is not ASCII, A-Z lower-cased. Whole texts
    are read, long ones in parts. Texts are tokenized once per language; tasks add up what
    they count before the shuffle by term."""
    counted = collapsed(docs, **columns).mapInArrow(_count, _COUNTS).repartition("lang", "term")
    counted = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("by_source"))
    return by_term.where(F.col("docs") >= least_docs).select("lang", "term", "n", "by_source")


def share(count: Column, total: Column) -> Column:
    """``1 + floor(10^9 * (count + 1) / total)`` by long division, so that no product
    exceeds a thousand times ``total``."""
    rest, whole = count + 1, F.lit(0).cast("bigint")
    for factor in (1, *_SCALE):
        whole = whole * factor + F.call_function("div", rest * factor, total)
        rest = (rest * factor) % total
    return whole + 1


def excess(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``."""
    return F.call_function("div", (p - q) * (p - q), q)


def _groups(docs: DataFrame, counts: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``(lang, source, total, zero, kept)`` of every group that occurs: the divisor
    ``N + V`` of its shares, the share of a term that it lacks (null if V is 0), V."""
    del text
    every = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]).distinct()
    sums = counts.select("lang", F.inline("by_source")).groupBy("lang", "source").agg(F.sum("n").alias("sum"))
    kept = counts.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_sum"))
    groups = every.join(kept, "lang", "left").join(sums, ["lang", "source"], "left")
    kept, total = F.coalesce("kept", F.lit(0)), F.coalesce("sum", F.lit(0)) + F.coalesce("kept", F.lit(0))
    return groups.select(
        "lang", "source", kept.alias("kept"), total.alias("total"), F.when(kept > 0, share(F.lit(0).cast("bigint"), total)).alias("zero"), (F.col("lang_sum") + kept).alias("lang_total")
    )


def _of(groups: DataFrame, end: str) -> DataFrame:
    return groups.select("lang", *[F.col(c).alias(f"{c}_{end}") for c in ("source", "total", "zero", "kept")])


def pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for all ordered pairs of sources of a language."""
    a, b = _of(groups, "a"), _of(groups, "b")
    # Terms that both have, beyond what the sums below take for them.
    one = counts.select(F.col("lang"), "by_source", F.inline("by_source")).select("lang", "by_source", F.col("source").alias("source_a"), F.col("n").alias("n_a"))
    later = F.filter("by_source", lambda x: x["source"] > F.col("source_a"))
    both = one.select("lang", "source_a", "n_a", F.inline(later)).select("lang", "source_a", "n_a", F.col("source").alias("source_b"), F.col("n").alias("n_b"))
    both = both.join(a, ["lang", "source_a"]).join(b, ["lang", "source_b"])
    both = both.select("lang", "source_a", "source_b", "zero_a", "zero_b", share(F.col("n_a"), F.col("total_a")).alias("p"), share(F.col("n_b"), F.col("total_b")).alias("q"))
    p, q, zero_a, zero_b = (F.col(c) for c in ("p", "q", "zero_a", "zero_b"))
    both = both.groupBy("lang", "source_a", "source_b").agg(
        F.sum(excess(p, q) - excess(p, zero_b) - excess(zero_a, q) + excess(zero_a, zero_b)).alias("a_b"),
        F.sum(excess(q, p) - excess(q, zero_a) - excess(zero_b, p) + excess(zero_b, zero_a)).alias("b_a"),
    )
    # Terms that one has, against the share of a term that the other lacks.
    spread = counts.select("lang", F.inline("by_source")).groupBy("lang", F.col("source").alias("source_a"), "n").agg(F.count(F.lit(1)).alias("times"))
    spread = spread.join(a, ["lang", "source_a"]).select("lang", "source_a", "times", "zero_a", share(F.col("n"), F.col("total_a")).alias("p"))
    one_has = spread.join(b, "lang").where("source_a != source_b").select(
        "lang",
        "source_a",
        "source_b",
        (F.col("times") * (excess(p, zero_b) - excess(zero_a, zero_b))).alias("a_b"),
        (F.col("times") * (excess(zero_b, p) - excess(zero_b, zero_a))).alias("b_a"),
    )
    # All terms, as if neither had them: also what a pair without any term gets.
    none = a.join(b, "lang").where("source_a != source_b").select(
        "lang", "source_a", "source_b", F.when(F.col("kept_a") > 0, F.col("kept_a") * excess(zero_a, zero_b)).otherwise(F.lit(0)).alias("a_b"), F.lit(None).cast("bigint").alias("b_a")
    )
    parts = both.unionByName(one_has.groupBy("lang", "source_a", "source_b").agg(F.sum("a_b").alias("a_b"), F.sum("b_a").alias("b_a"))).unionByName(none)
    ends = F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item"), F.col("a_b").alias("value")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"), F.col("b_a").alias("value")),
    )
    return parts.select("lang", F.inline(ends)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for the terms that a source has more of than its language."""
    own = counts.select("lang", "term", F.col("n").alias("lang_n"), F.inline("by_source")).join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
    own = own.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total")).alias("p"), share(F.col("lang_n"), F.col("lang_total")).alias("q"))
    return own.where("p > q").select("lang", "source", "item", excess(F.col("p"), F.col("q")).alias("value"))


def audit(docs: DataFrame, least_docs: int = 3, top_terms: int = 200, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source is from each
    other source of its language (part ``pair``, all ranks) and by which terms it stands
    out in the language (part ``term``, ranks to ``top_terms``).

    A term's share ``p`` in a group is ``1 + floor(10^9 (count + 1) / (N + V))`` with
    ``V`` kept terms in the language and ``N`` their occurrences in the group; ``value`` is
    ``floor((p - q)^2 / q)``, for pairs summed over all kept terms. Ranks go by value
    descending, then item by its UTF-8 bytes. Values that exceed a long raise.

    Nulls in the three columns count as the empty string; keys and other columns are not
    read. Groups whose texts are all empty take part in pairs. Repeated rows are documents
    like any other. No rows: no rows.
    """
    columns = {"text": text, "lang": lang, "source": source}
    counts = written(term_counts(docs, least_docs, **columns), "terms")
    groups = written(_groups(docs, counts, **columns), "groups")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pair_values(counts, groups).withColumn("rank", F.row_number().over(order))
    terms = term_values(counts, groups).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    rows = [t.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, t in (("pair", pairs), ("term", terms))]
    return rows[0].unionByName(rows[1])
