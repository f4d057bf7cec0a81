"""Source audit against plain Python, in parts of every size, and edge rows."""

import random
import re
from collections import Counter

import pytest
from compare import connect, difference

from panelspark.llm import divergence, queries


def plain(rows, least_docs=3, top=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    out = []
    for lang in {r[1] for r in rows}:
        docs, counts = Counter(), {}
        for text, _, source in [r for r in rows if r[1] == lang]:
            terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low(text))
            docs.update(set(terms))
            counts.setdefault(source, Counter()).update(terms)
        kept = [t for t in docs if docs[t] >= least_docs]
        whole = sum(counts.values(), Counter())
        shares = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}  # noqa: E731, B023
        p = {s: shares(c) for s, c in counts.items()}
        q = shares(whole)
        f = lambda a, b: (a - b) * (a - b) // b
        for s in counts:
            parts = {"pair": [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s]}
            parts["term"] = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items in parts.items():
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(sorted(items)) if part == "pair" or i < top]
    return sorted(out)


def corpus(seed, count=160):
    rng = random.Random(seed)
    terms = ["alpha", "Beta", "beta", "é", "naïve", "x1y", "the", "of", "日本", "Σ", "it's"] + [f"t{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = []
    for _ in range(count):
        weight = rng.randint(1, len(terms))
        rows.append((" ".join(rng.choice(terms[:weight]) for _ in range(rng.randint(0, 30))), rng.choice(["en", "de", None, ""]), rng.choice(["s0", "s0", "s1", "é", None, "S"])))
    rows += [rows[3]] * 40 + [(rows[3][0], rows[3][1], "s1")] * 5  # copies, also in another source
    rows += [(None, "fr", "only"), ("", "fr", "other"), ("!!! 123", "fr", None), ("alone", "xx", "one")]
    return rows


def frame(spark, rows, parts):
    docs = spark.createDataFrame([(i % 7, *r, "clash") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term string")
    return docs.repartition(parts)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("parts", [1, 9])
def test_plain_python_agrees(spark, parts):
    rows = corpus(1)
    assert found(divergence.audit(frame(spark, rows, parts))) == plain(rows)
    assert found(divergence.audit(frame(spark, rows, parts), least_docs=1, top_terms=5)) == plain(rows, 1, 5)


def batches(rows, size):
    import pyarrow as pa

    kind = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
    for at in range(0, len(rows), size):
        part = rows[at : at + size]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part]), pa.array([r[1] for r in part]), pa.array([[{"source": s, "n": n} for s, n in r[2]] for r in part], kind)], ["lang", "text", "copies"])


@pytest.mark.parametrize(("block", "terms", "entries"), [(1 << 21, 400_000, 3_000_000), (40, 12, 30), (1, 1, 2)])
def test_task_sums_whatever_it_holds(monkeypatch, block, terms, entries):
    """Small limits make a task add up and hand on more often, with the same sums."""
    rng = random.Random(5)
    rows = [(rng.choice(["en", "de"]), " ".join(rng.choice(["aa", "Bb", "é", "cc", "x"]) for _ in range(rng.randint(1, 40))), [(s, rng.randint(1, 9)) for s in rng.sample(["s0", "s1", "s2"], rng.randint(1, 3))]) for _ in range(50)]
    for name, value in (("BLOCK", block), ("TERMS", terms), ("ENTRIES", entries)):
        monkeypatch.setattr(divergence, name, value)
    counts, docs = Counter(), Counter()
    for batch in divergence._count(batches(rows, 7)):
        for r in batch.to_pylist():
            counts[r["lang"], r["term"], r["source"]] += r["n"]
            docs[r["lang"], r["term"]] += r["docs"]
    want, want_docs = Counter(), Counter()
    for lang, text, copies in rows:
        tf = Counter(text.replace("B", "b").split())
        for term, n in tf.items():
            want_docs[lang, term] += sum(m for _, m in copies)
            for source, m in copies:
                want[lang, term, source] += n * m
    assert counts == want and docs == want_docs


def test_long_text_and_shares(spark):
    rows = [("wort " * 1_500_000, "de", "a"), ("wort x" + "y" * 3_000_000, "de", "b"), ("wort", "de", "b")]
    assert found(divergence.audit(frame(spark, rows, 2))) == plain(rows)
    big = spark.createDataFrame([(10**13 + 7, 9 * 10**13 + 1), (0, 1), (4, 7), (10**9 - 1, 10**9)], "c long, t long")
    got = [r[0] for r in big.select(divergence.share(big.c, big.t)).collect()]
    assert got == [1 + 10**9 * (c + 1) // t for c, t in ((10**13 + 7, 9 * 10**13 + 1), (0, 1), (4, 7), (10**9 - 1, 10**9))]


def test_empty(spark):
    rows = corpus(2, 5)
    assert divergence.audit(frame(spark, rows, 1).limit(0)).count() == 0
    alone = [("a b c", "en", "s")] * 2
    assert found(divergence.audit(frame(spark, alone, 1))) == plain(alone) == []


@pytest.mark.parametrize("name", ["op11_divergence", "op12_infill"])
def test_twins(spark, name):
    folder = "/root/testdata/sf0.001"
    assert difference(queries.QUERIES[name](spark, folder), connect(folder), queries.SQL[name]) is None
