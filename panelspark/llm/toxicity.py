"""Toxicity by a weighted lexicon: Aho-Corasick over folded text.

Folding lower-cases, strips accents, maps look-alike letters of other scripts and
undoes digit substitutions, so that ``1d10t`` and ``idiot`` are one term (``i``,
``l`` and ``1`` share a class, since the digit stands for either). Terms count as
whole words, and not inside an exception phrase. Weights are those of a penalised logistic
fit to labelled rows; a document's score is a logistic function of the summed weights of
its terms and of their density per hundred words.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from functools import cache, partial

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import DenseMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm._shared import drop_kept, written

# Letters of other scripts that look like Latin ones, and substitutes.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "ո": "n", "ց": "g",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ɑ": "a",
    "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "l": "i"}


@cache
def _table() -> dict[int, str | None]:
    """Code point to folded text, by rule: NFKD without marks, lower case, then the fixed values."""
    table: dict[int, str | None] = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)])
    spans = (range(0x20, 0x250), range(0x370, 0x530), range(0x530, 0x590), range(0x1E00, 0x2000), range(0xFF01, 0xFF5F))
    for code in (c for span in spans for c in span):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code).lower()) if not unicodedata.combining(c))
        base = "".join(HOMOGLYPHS.get(c, c) for c in base)
        base = "".join(SUBSTITUTES.get(c, c) for c in base)
        if base != chr(code):
            table[code] = base
    return table


def fold(text: str | None) -> str:
    """Folded text with single blanks between its words."""
    return " ".join((text or "").translate(_table()).split())


@dataclass(frozen=True)
class Lexicon:
    """Weighted terms, exception phrases and the logistic function above them."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    intercept: float = -5.0
    slopes: tuple[float, float] = (0.0, 0.0)

    def automaton(self):
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term, (len(term), term, weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), phrase, None))
        if len(found):
            found.make_automaton()
        return found


def hits(folded: str, automaton) -> list[tuple[str, float]]:
    """Terms in ``folded`` as whole words outside exception phrases."""
    if not len(automaton):
        return []
    terms, spared = [], []
    last = len(folded) - 1
    for end, (size, term, weight) in automaton.iter(folded):
        start = end - size + 1
        if (start and folded[start - 1].isalnum()) or (end < last and folded[end + 1].isalnum()):
            continue
        (spared if weight is None else terms).append((start, end, term, weight))
    if spared:
        terms = [t for t in terms if not any(s <= t[0] and t[1] <= e for s, e, _, _ in spared)]
    return [(t, w) for _, _, t, w in terms]


def _features(folded: str, automaton) -> tuple[float, float]:
    found = hits(folded, automaton)
    words = folded.count(" ") + 1
    return np.log1p(sum(dict(found).values())), np.log1p(100 * sum(w for _, w in found) / words)


def scorer(lexicon: Lexicon):
    """A function of a text column that gives the score, 0 to 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        drop_kept()
        automaton = lexicon.automaton()
        x = np.array([_features(fold(t), automaton) for t in texts]).reshape(-1, 2)
        return pd.Series(1 / (1 + np.exp(-(lexicon.intercept + x @ np.array(lexicon.slopes)))))

    return score


_WORD = re.compile(r"[^\W_]+")


def _count(batches, terms):
    """Per task, in how many toxic and clean texts a word occurs; given terms, a
    word of theirs with its neighbour."""
    drop_kept()
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if terms is None:
                words = set(_WORD.findall(fold(text)))
            else:
                all_words = fold(text).split()
                words = {f"{a} {b}" for a, b in zip(all_words, all_words[1:], strict=False) if a in terms or b in terms}
            for word in words:
                counts.setdefault(word, [0, 0])[1 - toxic] += 1
    yield pa.RecordBatch.from_pydict(
        {"word": pa.array(counts, pa.string()), "toxic": pa.array((c[0] for c in counts.values()), pa.int64()), "clean": pa.array((c[1] for c in counts.values()), pa.int64())}
    )


def _counts(rows: DataFrame, terms: frozenset[str] | None = None) -> DataFrame:
    counted = rows.select("text", "toxic").mapInArrow(partial(_count, terms=terms), "word string, toxic long, clean long")
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _found(batches, lexicon):
    automaton = lexicon.automaton()
    for batch in batches:
        folded = [fold(t) for t in batch.column(0).to_pylist()]
        x = [_features(f, automaton) for f in folded]
        yield pa.RecordBatch.from_pydict(
            {
                "toxic": batch.column(1),
                "terms": pa.array([sorted({t for t, _ in hits(f, automaton)}) for f in folded], pa.list_(pa.string())),
                "total": pa.array([a for a, _ in x], pa.float64()),
                "density": pa.array([b for _, b in x], pa.float64()),
            }
        )


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Penalised logistic fit to rows that stand for ``n`` equal ones; strictly convex,
    so damped Newton steps reach the one optimum."""
    x = np.c_[np.ones(len(x)), x]
    penalty = ridge * np.array([0.02, *[1.0] * (x.shape[1] - 1)])
    loss = lambda b: n @ np.logaddexp(0, x @ b) - (n * y) @ (x @ b) + 0.5 * penalty @ b**2
    beta = np.zeros(x.shape[1])
    while True:
        p = 1 / (1 + np.exp(-(x @ beta)))
        gradient = x.T @ (n * (p - y)) + penalty * beta
        if np.abs(gradient).max() < 1e-8 * (1 + n.sum()):
            return beta
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty), gradient)
        size = 1.0
        while loss(beta - size * step) > loss(beta) - 1e-4 * size * gradient @ step and size > 1e-9:
            size /= 2
        if size <= 1e-9:
            return beta
        beta = beta - size * step


def _weights(found: DataFrame, words: list[str], rows: int, ridge: float = 1.0) -> dict[str, float]:
    """Weights of 0 and more for all ``words`` at once: a logistic fit with penalty, so
    that words that stand together share what they say; words of weight 0 are left out."""
    vectors = CountVectorizerModel.from_vocabulary(words, "terms", "features", binary=True).transform(found)
    fit = LogisticRegression(
        labelCol="toxic", regParam=ridge / rows, standardization=False, maxIter=1000, tol=1e-7,
        lowerBoundsOnCoefficients=DenseMatrix(1, len(words), [0.0] * len(words)),
    )
    found = fit.fit(vectors.select("toxic", "features")).coefficients.toArray()
    return {w: float(x) for w, x in zip(words, found, strict=True) if x > 1e-6}


def learn(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    least_docs: int = 5,
) -> Lexicon:
    """A lexicon from labelled rows.

    All labelled documents are read. Terms are all words that occur in at least
    ``least_docs`` toxic texts and whose log-odds have a z-value above 3; their weights
    come from one penalised fit of all of them. A pair of neighbouring words with a
    term that clean texts use more often than toxic ones becomes an exception phrase.
    The logistic function is fitted on counts of rows in cells of 1/64 of its two
    features. Rows with a null key or label are not used, a repeated key counts as
    toxic if one of its labels does. Without both kinds of label there are no terms
    and the score is the share of toxic rows.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    # labels grow with the documents, so the join is the same at any size
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(known.hint("merge"), "id")
    rows = written(rows.select("text", "toxic"), "labelled")
    size = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    share = (toxic + 0.01) / (toxic + clean + 0.02) if toxic + clean else 0.01
    none = Lexicon(intercept=float(np.log(share / (1 - share))))
    if not toxic or not clean:
        return none

    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    ranked = _counts(rows).where(F.col("toxic") >= least_docs).withColumns({"odds": odds, "z": odds / spread}).where("z > 3")
    words = [r.word for r in ranked.select("word").orderBy("word").collect()]
    if not words:
        return none
    seen = "toxic int, terms array<string>, total double, density double"
    found = rows.mapInArrow(partial(_found, lexicon=Lexicon(dict.fromkeys(words, 1.0))), seen)
    kept = _weights(written(found.select("toxic", "terms"), "terms"), words, toxic + clean)

    pairs = _counts(rows, frozenset(kept)).where(F.col("clean") >= 3)
    pairs = pairs.where((F.col("toxic") + 0.5) / (toxic + 1) < (F.col("clean") + 0.5) / (clean + 1)).select("word").orderBy("word")
    lexicon = Lexicon(terms=kept, exceptions=tuple(r.word for r in pairs.collect()))
    cells = [F.round(F.col(c) * 64).alias(c) for c in ("total", "density")]
    counts = rows.mapInArrow(partial(_found, lexicon=lexicon), seen).groupBy("toxic", *cells).agg(F.count(F.lit(1)).alias("n")).toPandas()
    beta = _logistic(counts[["total", "density"]].to_numpy() / 64, counts["toxic"].to_numpy(dtype=float), counts["n"].to_numpy(dtype=float))
    return Lexicon(kept, lexicon.exceptions, float(beta[0]), (float(beta[1]), float(beta[2])))


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with a column ``to``: 0 to 1, higher for likelier toxic rows.

    Row by row: repeated rows score alike, other columns stay as they are (one
    called ``to`` is replaced). Null and empty texts score as texts without a term.
    Whole texts are matched, however long. No rows: no rows.
    """
    return docs.withColumn(to, scorer(lexicon)(F.col(text).cast("string")))


def held_out(key: Column) -> Column:
    """True for the fifth of keys on which labels are not learned."""
    return F.crc32(key.cast("string")) % 5 == 0
