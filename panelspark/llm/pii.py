"""Personal data: candidate spans, boosted trees and calibrated thresholds, in DataFrame functions.

Strict rules find the base spans. High-recall generators propose overlapping spans
beside them; gradient-boosted trees, fitted on a bounded sample of documents to tell
base spans from clear negatives, score format and context; a threshold per kind, set
for a precision on all rows that the fit has not seen, decides what is added. The trees are
compiled to column expressions, so a document is scored where it is read: no
shuffle, no Python, and repeated or null keys do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm._shared import written

KINDS = ("email", "ip", "card", "phone")

# The base rules. Possessive repeats keep the matches the same (what
# follows a repeat cannot begin inside it) and stop Java's matcher from recursing;
# a match starts where the last one ended or where a run begins, which is where the
# leftmost match of a run starts.
RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CUES = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": "\\+[0-9]"}
GENERATORS = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)*+",
    "number": r"(?<![0-9])[+(]?[0-9](?:[ ().:/_-]{0,3}+[0-9])++",
}
GENERATOR_CUES = {"mail": r"@|\(at\)|\[at\]", "number": "[0-9](?:[ ().:/_-]{0,3}+[0-9]){6}"}
CONTEXT = {
    "email": "mail|contact|write to|kontakt|courriel|correo",
    "ip": "\\bip|host|server|address",
    "card": "card|visa|credit|account|iban|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobil|anruf|llam",
}
_SPANS = "array<struct<start:int,end:int,value:string>>"


def _matches(text: Column, pattern: str, cue: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points.

    The text between matches comes from a split by the same pattern, and running
    lengths of gaps and matches give the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found, lambda g, f: F.struct(F.length(g).alias("gap"), f.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["value"])
        return F.struct(end.alias("at"), F.array_append(acc["spans"], F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"))).alias("spans"))

    placed = F.aggregate(pairs, start, step, lambda acc: acc["spans"])
    return F.when(text.rlike(cue), placed).otherwise(F.array().cast(_SPANS))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's sum over a string of 1 to 19 digits is a multiple of ten."""
    places = F.split(F.reverse(digits), "")
    doubled = F.transform(places, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= F.lit("255"))))
    size = F.length(_digits(value))
    if kind == "card":
        return F.when(size.between(14, 19), _luhn(_digits(value))).otherwise(False)
    return size.between(10, 15)


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _base(text: Column) -> Column:
    """All base spans, by start and then kind."""

    def kept(i):
        valid = F.filter(_matches(text, RULES[KINDS[i]], CUES[KINDS[i]]), lambda s: _valid(KINDS[i], s["value"]))
        return F.transform(valid, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end")))

    return F.array_sort(F.concat(*[kept(i) for i in range(len(KINDS))]))


FEATURES = (
    *(f"is_{k}" for k in KINDS),
    "length", "digits", "digit_share", "dots", "dashes", "blanks", "brackets", "plus", "at", "luhn", "letter_before", "letter_after",
    *(f"near_{k}" for k in KINDS),
)


def _features(text: Column, span: Column, kind: int) -> Column:
    """Format and context of a proposed span, in the order of ``FEATURES``."""
    value = span["value"]
    digits = _digits(value)
    many = F.length(digits)
    count = lambda pattern: F.length(value) - F.length(F.regexp_replace(value, pattern, ""))
    # 32 code points before, and one on either side
    before = F.lower(F.substring(text, F.greatest(span["start"] - 31, F.lit(1)), F.least(span["start"], F.lit(32))))
    here = [F.lit(float(i == kind)) for i in range(len(KINDS))]
    shape = [F.length(value), many, many / F.length(value), count("\\."), count("-"), count(" "), count("[()]"), count("\\+"), count("@")]
    shape += [F.when(many.between(12, 19), _luhn(digits)).otherwise(False), before.rlike("[a-z0-9]$"), F.substring(text, span["end"] + 1, 1).rlike("[A-Za-z0-9]")]
    return F.array(*[x.cast("double") for x in [*here, *shape, *(before.rlike(CONTEXT[k]) for k in KINDS)]])


def _candidates(text: Column, base: Column) -> Column:
    """Proposed spans per kind, with features and whether a base span of the kind overlaps."""
    mail = F.filter(_matches(text, GENERATORS["mail"], GENERATOR_CUES["mail"]), lambda s: F.length(s["value"]) < 320)
    number = F.filter(_matches(text, GENERATORS["number"], GENERATOR_CUES["number"]), lambda s: F.length(_digits(s["value"])).between(7, 24))
    dotted = F.filter(number, lambda s: F.length(s["value"]) - F.length(F.replace(s["value"], F.lit("."))) == 3)
    sources = (mail, dotted, number, number)

    def propose(i):
        return F.transform(
            sources[i],
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end"), _features(text, s, i).alias("x"),
                F.exists(base, lambda b: (b["kind"] == i) & _overlap(b, s)).alias("agrees"),
            ),
        )

    return F.concat(*[propose(i) for i in range(len(KINDS))])


def _labelled(body: Column, base: Column) -> Column:
    """Features and labels to learn from. What overlaps a base span of its kind is 1,
    also with the rule's own cue hidden: a phone number near a cue of its context
    without its plus, a mail address with its signs written out. A clear negative is 0:
    it overlaps a base span of another kind, or its kind could not be written so, or
    nothing near it speaks for its kind. The rest look alike and have no label."""
    at = {name: i for i, name in enumerate(FEATURES)}
    get = lambda c, name: c["x"][at[name]]

    def changed(c, values):
        return F.transform(c["x"], lambda v, i: reduce(lambda a, kv: F.when(i == at[kv[0]], kv[1]).otherwise(a), values.items(), v))

    def label(c):
        alike = {
            "email": (get(c, "brackets") > 0) | (get(c, "dots") > 0) | (get(c, "near_email") > 0),
            "ip": get(c, "near_ip") > 0,
            "card": (get(c, "near_card") > 0) & (get(c, "luhn") > 0),
            "phone": (get(c, "near_phone") > 0) & get(c, "digits").between(7, 15),
        }
        other = F.exists(base, lambda b: (b["kind"] != c["kind"]) & _overlap(b, c))
        open_ = reduce(lambda a, i: F.when(c["kind"] == i, alike[KINDS[i]]).otherwise(a), range(len(KINDS)), F.lit(False))
        return F.when(c["agrees"], 1.0).when(other | ~open_, 0.0)

    def row(c, x, y):
        return F.struct(c["kind"].alias("kind"), x.alias("x"), y.alias("label"))

    def hidden(c):
        signs = get(c, "dots") + 1
        mail = changed(c, {"length": get(c, "length") + 6 * signs - 1, "digit_share": get(c, "digits") / (get(c, "length") + 6 * signs - 1),
                           "dots": F.lit(0.0), "blanks": get(c, "blanks") + 2 * signs, "brackets": get(c, "brackets") + 2 * signs, "at": F.lit(0.0)})
        bare = changed(c, {"length": get(c, "length") - 1, "digit_share": get(c, "digits") / (get(c, "length") - 1), "plus": F.lit(0.0)})
        return row(c, F.when(c["kind"] == KINDS.index("email"), mail).otherwise(bare), F.lit(1.0))

    found = _candidates(body, base)
    mail = lambda c: (c["kind"] == KINDS.index("email")) & (get(c, "at") > 0)
    phone = lambda c: (c["kind"] == KINDS.index("phone")) & (get(c, "plus") > 0) & (get(c, "near_phone") > 0)
    plain = F.filter(F.transform(found, lambda c: row(c, c["x"], label(c))), lambda r: r["label"].isNotNull())
    return F.concat(plain, F.transform(F.filter(found, lambda c: c["agrees"] & (mail(c) | phone(c))), hidden))


@dataclass(frozen=True)
class Model:
    """Weighted trees as nested tuples ``(feature, threshold, left, right)`` with
    numbers as leaves, and the least score of a redaction per kind (above 1: none)."""

    trees: tuple = ()
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, x: Column) -> Column:
        def grow(node):
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(x[feature] <= threshold, grow(left)).otherwise(grow(right))

        margin = reduce(lambda a, b: a + b, [F.lit(w) * grow(t) for w, t in self.trees], F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))


def _tree(node):
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def learn(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = 4000, precision: float = 0.99, trees: int = 10, seed: int = 7) -> Model:
    """Trees from a bounded sample, thresholds from all documents.

    ``sample`` bounds the documents of the fit: those of least key digest among the
    ones with anything that a generator may propose. Base spans, also with their rule's
    cue hidden, are fitted against clear negatives; look-alikes without a label count
    neither in the fit nor in the precision. A kind's threshold is the least score with
    at least ``precision`` on three in ten candidates of the sample, held back, and all
    of the other documents. Where one kind of label is missing, no trees are fitted and
    nothing is added.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    cue = "|".join(f"(?:{c})" for c in GENERATOR_CUES.values())
    rows = rows.where(F.col("text").rlike(cue))
    ids = rows.where("id is not null").select("id").orderBy(F.xxhash64("id"), "id").limit(sample).distinct()
    ids = written(ids.withColumn("sampled", F.lit(True)), "sampled")
    # the base spans as a column before they are used, so that they are found once a row
    seen = rows.join(F.broadcast(ids), "id", "left").withColumn("base", _base(F.col("text")))
    seen = seen.select("id", "sampled", F.posexplode(_labelled(F.col("text"), F.col("base"))).alias("n", "c"))
    seen = seen.select((F.col("sampled").isNull() | (F.pmod(F.xxhash64("id", "n"), F.lit(10)) < 3)).alias("held"), "sampled", "c.kind", "c.x", "c.label")
    fit = written(seen.where("sampled and not held").select("label", "x"), "candidates").select("label", array_to_vector("x").alias("features"))
    if fit.select("label").distinct().count() < 2:
        return Model()
    model = GBTClassifier(maxIter=trees, maxDepth=3, seed=seed).fit(fit)
    found = tuple((float(w), _tree(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees, strict=True))
    score = Model(found).score(F.col("x"))
    held = seen.where("held").groupBy("kind", F.floor(score * 1000).alias("bin")).agg(F.sum("label").alias("right"), F.count(F.lit(1)).alias("all"))
    bins: dict[int, list] = {}
    for r in held.orderBy(F.desc("bin")).collect():
        bins.setdefault(r.kind, []).append((r.bin / 1000, r.right, r["all"]))
    thresholds = {}
    for kind, rows_ in bins.items():
        right = total = 0
        for low, good, many in rows_:
            right, total = right + good, total + many
            if right >= precision * total:
                thresholds[KINDS[kind]] = low
    return Model(found, thresholds)


def find(docs: DataFrame, model: Model, text: str = "text", to: str = "pii") -> DataFrame:
    """``docs`` with a column ``to``: a struct of ``base`` and ``spans``, arrays of
    ``(start, kind, end)`` in order; places are code points, ends exclusive, kinds
    numbers in ``KINDS``; ``spans`` holds the base ones and what the trees add.

    A candidate is added if its score reaches its kind's threshold, it overlaps no
    base span and no better candidate. Null and empty texts have no spans. Row by
    row: keys are not read, repeated rows give repeated results, other columns stay
    (one called ``to`` is replaced). No rows: no rows.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = docs.withColumn(to, F.struct(whole.alias("text"), _base(whole).alias("base")))
    body, base = F.col(to)["text"], F.col(to)["base"]
    if not model.thresholds:
        return out.withColumn(to, F.struct(base.alias("base"), base.alias("spans")))
    cue = "|".join(f"(?:{c})" for c in GENERATOR_CUES.values())
    least = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (i, float(model.thresholds.get(k, 2.0)))])
    proposed = F.filter(_candidates(body, base), lambda c: ~F.exists(base, lambda b: _overlap(b, c)))
    scored = F.transform(
        proposed,
        lambda c: F.struct((-model.score(c["x"])).alias("rank"), c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")),
    )
    good = F.array_sort(F.filter(scored, lambda c: -c["rank"] >= least[c["kind"]]))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    bare = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))
    chosen = F.aggregate(good, none, lambda a, c: F.when(F.exists(a, lambda x: _overlap(x, c)), a).otherwise(F.array_append(a, bare(c))))
    added = F.when(body.rlike(cue), chosen).otherwise(none)
    return out.withColumn(to, F.struct(base.alias("base"), F.array_sort(F.concat(base, added)).alias("spans")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of overlapping
    spans the first is named and all of them go. A null text stays null."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, names[s["kind"]])).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, begin, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
