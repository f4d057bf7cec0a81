"""Merkle fingerprints of documents, in DataFrame functions.

A text is cut into sections (after blank lines), those into paragraphs (lines) and
those into leaves (sentences, or pieces of at most ``LEAF`` code points), so that the
leaves put together are the text. A leaf's hash is 64 bits whose last ten hold its
length; a paragraph hashes its leaves, a section its paragraphs, and the root, a
SHA-256, the sections. Equal texts have equal roots. Two trees are compared from the
top: a section or paragraph with the same hash is the same, the differing branches
lead to the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Code points of the longest leaf; the low bits of a leaf's hash hold up to this.
LEAF = 1000
_LOW = 1023

_SECTION = r"(?<=\n\n)(?=[^\n])"
_PARAGRAPH = r"(?<=\n)(?=[^\n])"
_SENTENCE = rf"(?s)[^.!?]{{0,{LEAF - 24}}}+(?:[.!?]{{1,12}}+[\x20\n]{{0,12}}+)?+"


def _leaves(paragraph: Column) -> Column:
    """Hashes of a paragraph's sentences; the empty match at its end is dropped."""
    parts = F.filter(F.regexp_extract_all(paragraph, F.lit(_SENTENCE), F.lit(0)), lambda p: p != "")
    return F.transform(parts, lambda p: F.xxhash64(p).bitwiseAND(F.lit(~_LOW)).bitwiseOR(F.length(p).cast("long")))


def _node(children: Column) -> Column:
    """The hash of a list of hashes, in their order."""
    return F.xxhash64(children)


def _parts(text: Column, pattern: str) -> Column:
    return F.filter(F.split(text, pattern, -1), lambda p: p != "")


def sections(text: Column) -> Column:
    """The tree: per section its hash and per paragraph its hash and leaves."""

    def paragraph(p):
        leaves = _leaves(p)
        return F.struct(_node(leaves).alias("hash"), leaves.alias("leaves"))

    cut = F.transform(_parts(F.coalesce(text, F.lit("")), _SECTION), lambda s: F.transform(_parts(s, _PARAGRAPH), paragraph))
    return F.transform(cut, lambda s: F.struct(_node(F.transform(s, lambda p: p["hash"])).alias("hash"), s.alias("paragraphs")))


def root(text: Column) -> Column:
    """The root: SHA-256 of the sections' SHA-256 (hex)."""
    parts = F.transform(_parts(F.coalesce(text, F.lit("")), _SECTION), lambda s: F.sha2(s, 256))
    return F.sha2(F.array_join(parts, ""), 256)


def leaves(tree: Column) -> Column:
    """The different leaves of a tree."""
    return F.array_distinct(F.flatten(F.transform(tree, lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["leaves"])))))


def _weight(found: Column) -> Column:
    return F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a + x.bitwiseAND(F.lit(_LOW)))


def likeness(left: Column, right: Column) -> Column:
    """0 to 1 from the leaves of two trees: the code points of the leaves that both
    have over those of the leaves that either has; 1 for two empty texts."""
    both, one, other = _weight(F.array_intersect(left, right)), _weight(left), _weight(right)
    return F.when(one + other == 0, F.lit(1.0)).otherwise(both / (one + other - both))


def edits(left: Column, right: Column) -> Column:
    """Where two trees differ: ``(section, paragraph)`` of ``left``, from 0, whose
    hash is nowhere in ``right``. Sections with a hash of ``right`` are not opened."""
    known_sections = F.transform(right, lambda s: s["hash"])
    known = F.flatten(F.transform(right, lambda s: F.transform(s["paragraphs"], lambda p: p["hash"])))

    def open_section(s, i):
        marked = F.transform(s["paragraphs"], lambda p, j: F.struct(i.alias("section"), j.alias("paragraph"), F.array_contains(known, p["hash"]).alias("same")))
        return F.when(F.array_contains(known_sections, s["hash"]), F.slice(marked, 1, 0)).otherwise(F.filter(marked, lambda m: ~m["same"]))

    return F.flatten(F.transform(left, open_section))


def fingerprint(text: Column, tree: Column) -> Column:
    """The root and then the sections' hashes, as one string in hex."""
    hashes = F.transform(tree, lambda s: F.lpad(F.lower(F.hex(s["hash"])), 16, "0"))
    return F.concat_ws(":", root(text), F.array_join(hashes, ""))


def fingerprints(docs: DataFrame, text: str = "text", to: str = "merkle") -> DataFrame:
    """``docs`` with a struct column ``to``: ``root``, ``tree`` and ``leaves``.

    Null and empty texts have no sections and the root of the empty string. Row by
    row: repeated rows give repeated results, keys are not read, other columns stay
    (one called ``to`` is replaced). No rows: no rows.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = docs.withColumn(to, F.struct(root(whole).alias("root"), sections(whole).alias("tree")))
    return out.withColumn(to, F.struct(F.col(to)["root"].alias("root"), F.col(to)["tree"].alias("tree"), leaves(F.col(to)["tree"]).alias("leaves")))


def with_next(rows: DataFrame, key: str, columns: list[str], ranges: int | None = None) -> DataFrame:
    """``rows`` with a struct ``following``: ``columns`` of the row with the next
    smaller key; for the least key, of the row with the greatest.

    The keys are cut at approximate quantiles into ``ranges`` (four for each shuffle
    partition of the session unless given). The first row of a range is also sent to
    the range before it, so every range finds its rows' neighbours alone: one shuffle
    of the rows, and only the ranges' bounds reach the driver. Equal keys follow each
    other in the order of their rows' digests; a null key is less than all others.
    A single row follows itself.
    """
    n = ranges or 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else None
    # ranges run downwards: range 0 has the keys above the first cut, the last one has the null keys too
    cuts = sorted(set(cuts or ()), reverse=True)
    table = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    place = F.when(F.col(key).isNull(), len(cuts)).otherwise(F.size(F.filter(table, lambda c: c >= F.col(key))))
    placed = rows.withColumn("_range", place)
    tops = {r["_range"]: r["_top"] for r in placed.groupBy("_range").agg(F.max(key).alias("_top")).collect()}
    filled = sorted(tops)
    before = dict(zip(filled, filled[-1:] + filled[:-1], strict=True))
    every = range(len(cuts) + 1)
    top = F.array(*[F.lit(tops.get(i)) for i in every]).cast("array<bigint>")[F.col("_range")]
    guest = F.array(*[F.lit(before.get(i, 0)) for i in every])[F.col("_range")]
    copies = F.when(F.col(key).eqNullSafe(top), F.array(F.struct(F.col("_range").alias("at"), F.lit(0).alias("guest")), F.struct(guest.alias("at"), F.lit(1).alias("guest"))))
    copies = copies.otherwise(F.array(F.struct(F.col("_range").alias("at"), F.lit(0).alias("guest"))))
    dealt = placed.withColumn("_copy", F.explode(copies)).withColumns({"_at": F.col("_copy.at"), "_guest": F.col("_copy.guest"), "_tie": F.xxhash64(*rows.columns)})
    order = Window.partitionBy("_at").orderBy("_guest", F.col(key).desc_nulls_last(), "_tie")
    found = dealt.drop("_range", "_copy").withColumn("following", F.lead(F.struct(*columns)).over(order))
    return found.where("_guest = 0").drop("_at", "_guest", "_tie")


def compare_edited(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints of every text, of its edited text and of the document after it.

    The edited text has its last third (rounded down, in code points) replaced by as
    many of the first code points of the next document, or all if that is shorter;
    documents follow each other by descending key, the first one the last. Columns
    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, edits`` (the differing paragraphs). Null texts are empty ones; null
    and repeated keys as in ``with_next``; no rows: no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tree", sections(F.col("text")))
    rows = rows.select("doc_id", "text", fingerprint(F.col("text"), F.col("tree")).alias("fingerprint"), "tree", leaves(F.col("tree")).alias("leaves"))
    rows = with_next(rows, "doc_id", ["text", "leaves"])
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), size - cut), F.substring("following.text", F.lit(1), cut)))
    rows = rows.select("*", sections(F.col("edited")).alias("edited_tree"))
    return rows.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint(F.col("edited"), F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("leaves"), leaves(F.col("edited_tree"))).alias("near_edited"),
        likeness(F.col("leaves"), F.col("following.leaves")).alias("near_next"),
        edits(F.col("tree"), F.col("edited_tree")).alias("edits"),
    )
