"""Registered queries of the corpus operators: production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import divergence, infill, licences, merkle, neighbours, packing, passages, pieces, pii, secrets, simhash, tokenfile, toxicity
from panelspark.llm._spans import count_kind, listed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and its near-duplicate component."""
    found = simhash.near_duplicates(_table(spark, folder, "documents"), shingle=3, seed=42, bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@_query
def op9_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Merkle fingerprint of every document, of its edited text, and their likeness."""
    found = merkle.compare_edited(_table(spark, folder, "documents"))
    return found.drop("edits")


@_query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    packed = packing.pack_documents(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1, capacity=packing.Capacity(4096))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@_query
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    docs = _table(spark, folder, "documents")
    found = pii.find(docs, pii.learn(docs))
    counts = [pii.count_kind(F.col("pii.base"), k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("pii.base")), 256).alias("base_sha256"), pii.listed(F.col("pii.spans")).alias("spans"))


@_query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; labels of a fifth of the keys are not learned."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    held_out = toxicity.held_out(F.col("doc_id"))
    scored = toxicity.score(docs, toxicity.learn(docs, labels.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op10_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by the passages of 50 words and more that they share."""
    docs = _table(spark, folder, "documents")
    return passages.classes(docs, passages.near_passages(docs))


@_query
def op5_tokenfile(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents, written to files of byte planes and read back."""
    manifest = tokenfile.write_tokens(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=2)
    found = tokenfile.read_tokens(manifest)
    return found.select("doc_id", "start", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@_query
def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 vectors nearest to every twentieth, by inner product."""
    vectors = _table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@_query
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    found = secrets.find(_table(spark, folder, "documents"))
    counts = [count_kind(F.col("secrets.base"), i).alias(f"n_{k}") for i, k in enumerate(secrets.KINDS[:3])]
    base, spans = (listed(F.col(f"secrets.{c}"), secrets.KINDS) for c in ("base", "spans"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


@_query
def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents and the text they decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = pieces.decode(pieces.encode(docs, path), path)
    return found.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


@_query
def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Sources of each language by how their terms differ."""
    return divergence.audit(_table(spark, folder, "documents"), least_docs=3, top_terms=200)


SQL["op11_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 3
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang)
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL) c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
  SELECT c.lang, source, term, n,
    1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY c.lang, source) + v)::HUGEINT AS p,
    1 + 1000000000::HUGEINT * (lang_n + 1) // (total + v) AS q
  FROM counts c JOIN langs l ON l.lang = c.lang
), vals AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM vals
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@_query
def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut for fill-in-middle, and restored from that."""
    found = infill.restore(infill.transform(_table(spark, folder, "documents")))
    parts = [F.col(f"infill.{c}") for c in ("n", "form", "prefix_chars", "middle_chars")]
    return found.select("doc_id", *parts, F.sha2("infill.output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


SQL["op12_infill"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), draws AS (
  SELECT doc_id, text, units, len(units) AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS c2,
    text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 AS plain,
    ('0x' || h[25:32])::BIGINT % 100 < 80 AS spm
  FROM docs
), parts AS (
  SELECT doc_id, text, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1:least(c1, c2)], '') AS pre, array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
    array_to_string(units[greatest(c1, c2) + 1:], '') AS suf
  FROM draws
)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form != 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


@_query
def op13_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence phrases and licence texts in every document."""
    found = licences.find(_table(spark, folder, "documents"))
    places, spans = F.col("licences.places"), F.col("licences.spans")
    base = F.array_distinct(places["label"])
    return found.select(
        "doc_id",
        "licences.n_words",
        F.size(places).cast("bigint").alias("n_base"),
        F.array_min(places["word"]).alias("first_word"),
        F.array_max(places["word"]).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, spans["label"])), ",").alias("labels"),
        "licences.score",
    )
