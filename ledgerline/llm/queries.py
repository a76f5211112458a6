"""The queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (bpe, language_crf, line_dedup, mixing, near_dedup, order_minhash, permutation_index,
                            pii_bootstrap, quality_nbsvm, sharding, source_audit, token_alignment,
                            toxicity)
from ledgerline.llm.common import crc_mod, labelled


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 24, slot, and shard of 25."""
    return sharding.shard_manifest(_table(spark, sf_dir, "documents"), 24)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    plan = mixing.mix(_table(spark, sf_dir, "documents"), [3, 1, 2], share=1.5, most=2.0)
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from three of four labelled ones."""
    docs = _table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    model = toxicity.fit(labelled(docs.where(~held), _table(spark, sf_dir, "labels"), "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.3).cast("int").alias("predicted"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under a likeness of 0.85 on three-word shingles."""
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, likeness=0.85)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before dropping, dropped, and the kept text's digest."""
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), least=10)
    return kept.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return order_minhash.fingerprints(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth vector."""
    return permutation_index.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four of five."""
    docs = _table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 5) == 0
    model = language_crf.fit(docs.where(~held))
    return language_crf.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count and the digests of its ids and of the decoded bytes."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe.decode(ids, vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from two of three labelled ones."""
    docs = _table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 3) == 1
    model = quality_nbsvm.fit(labelled(docs.where(~held), _table(spark, sf_dir, "labels"), "quality"))
    return quality_nbsvm.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain identifiers of every document, counted and digested, and all spans found."""
    found = pii_bootstrap.find(_table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in pii_bootstrap.KINDS])
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.transform("base", lambda s: s["kind"])
    return found.select("doc_id", *[(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}")
                                    for i, k in enumerate(pii_bootstrap.KINDS)],
                        "base_sha256", listed.alias("spans"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and its most telling terms."""
    return source_audit.audit(_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens under two tokenizers, their groups and links, and the links' corpus counts."""
    found = token_alignment.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sharding, op2_mixing, op3_toxicity, op4_near_dedup, op5_line_dedup, op6_order_minhash,
                                     op7_permutation_index, op8_language_crf, op9_bpe, op10_quality, op11_pii,
                                     op12_source_audit, op13_token_alignment)}


# A text's words as the contracts cut them, A-Z in lower case.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP4 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w
), x AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS s FROM s
), e AS (
  SELECT a.doc_id AS p, b.doc_id AS q FROM x a JOIN x b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id AS p, doc_id AS q FROM documents
  UNION
  SELECT r.p, e.q FROM r JOIN e ON r.q = e.p
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT p, min(q) AS component_id FROM r GROUP BY p) c ON c.p = s.doc_id"""

_OP5 = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), k AS (
  SELECT *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') AS key FROM l
), h AS (
  SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), j AS (
  SELECT k.*, coalesce(h.keeper <> k.doc_id, false) AS gone FROM k LEFT JOIN h ON h.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""


_OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents
), o AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), l AS (
  SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS nl FROM k GROUP BY lang
), c AS (
  SELECT o.lang, o.source, o.term, CAST(count(*) AS HUGEINT) AS n FROM o JOIN k USING (lang, term) GROUP BY o.lang, o.source, o.term
), g AS (
  SELECT x.lang, x.source, coalesce(l.v, 0) AS v, l.nl, CAST(coalesce(s.ng, 0) AS HUGEINT) AS ng FROM (SELECT DISTINCT lang, source FROM d) x
  LEFT JOIN l USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS ng FROM c GROUP BY lang, source) s USING (lang, source)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.ng + g.v) AS p,
    1 + (1000000000 * (k.n + 1)) // (g.nl + g.v) AS q
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(max(f.value), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS other, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source) f
  ON f.lang = a.lang AND f.source = a.source AND f.other = b.source
  GROUP BY a.lang, a.source, b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200"""


def oracle_sql() -> dict[str, str]:
    """DuckDB statements of the queries that SQL can express."""
    return {"op4_near_dedup": _OP4, "op5_line_dedup": _OP5, "op12_source_audit": _OP12}
