"""Registered queries of the operators and of the pipeline, over their whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm import align, ann, bpe, chat, html, jaccard, lines, lm, minhash, mixing, resample, rules, subword

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    """Where the public tokenizer file lies on this machine; MEDLOOM_VOCABULARY overrides it."""
    return os.environ.get("MEDLOOM_VOCABULARY") or public_file(VOCABULARY)


def public_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def register(name: str, sql: str | None = None):
    def keep(build):
        Q[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 15) AS hash
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, source_size * 3 AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight FROM totals),
filled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT max(level) AS level FROM filled WHERE level * weight <= cap),
planned AS (
  SELECT f.source, f.source_size, least(f.cap::DOUBLE, coalesce(l.level * f.weight, f.cap::DOUBLE)) AS target
  FROM filled f CROSS JOIN levels l),
cells AS (SELECT source, hash, sum(size) AS mass FROM sized GROUP BY source, hash),
upto AS (
  SELECT *, sum(mass) OVER (PARTITION BY source ORDER BY hash) - mass AS before FROM cells),
rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM planned),
chosen AS (
  SELECT u.source, u.hash, r.source_size, r.target,
         least(3, r.whole + CASE WHEN 2 * u.before + u.mass <= 2 * (r.target - r.whole * r.source_size) THEN 1 ELSE 0 END) AS copies
  FROM upto u JOIN rests r ON u.source IS NOT DISTINCT FROM r.source)
SELECT s.doc_id, s.size, c.source_size, c.target, (s.size * c.copies)::BIGINT AS taken
FROM sized s JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source AND s.hash = c.hash"""


@register("op1_mix_sources", MIX_SQL)
def _mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op2_bpe_round_trip")
def _bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary_path())


@register("op3_jaccard_join")
def _jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@register("op4_quality_rules")
def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = rules.fit(docs, table(spark, sf_dir, "labels"))
    return rules.apply(docs, learned).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@register("op5_chat_format")
def _chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hard).alias("text"),
    )
    return chat.read_back(chat.render(rows.unionByName(extra)))


@register("op6_main_text")
def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


@register("op7_fuzzy_lines")
def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@register("op8_nearest_neighbours")
def _ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


@register("op9_pseudo_likelihood")
def _lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


@register("op10_subword_classifier")
def _subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# crc32 by its definition: a byte's remainder after eight halvings with the reversed polynomial, then byte by byte over a word
RESAMPLE_SQL = r"""
WITH RECURSIVE bytes AS (
  SELECT b::BIGINT AS b, b::BIGINT AS r, 0 AS step FROM range(256) t(b)
  UNION ALL
  SELECT b, xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END), step + 1 FROM bytes WHERE step < 8),
remainders AS (SELECT list(r ORDER BY b) AS rs FROM bytes WHERE step = 8),
found AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
asked AS (
  SELECT regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
of_doc AS (SELECT rid, unnest(ws) AS w FROM found),
of_ask AS (SELECT unnest(ws) AS w FROM asked),
spelled AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM of_doc UNION SELECT w FROM of_ask)),
hashed AS (
  SELECT w, xor(list_reduce(
    list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, rs[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM spelled, remainders),
s AS (SELECT bucket, count(*) AS n FROM of_doc JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM of_ask JOIN hashed USING (w) GROUP BY bucket),
gains AS (
  SELECT b AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM range(10000) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
weights AS (SELECT rid, sum(gain)::BIGINT AS weight FROM of_doc JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY rid),
scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE
      / 4294967296.0::DOUBLE))))::BIGINT AS score
  FROM found LEFT JOIN weights USING (rid)),
ranked AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (
      PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS place,
    10 * (SELECT count(*) FROM scored WHERE n_features >= 20) // 100 AS drawn
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END::BIGINT AS rank FROM ranked"""


@register("op11_importance_resampling", RESAMPLE_SQL)
def _resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op12_tokenizer_alignment")
def _align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.measure(table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"), public_file("piece_bpe_32k.model"))


@register("op13_minhash_near_dedup")
def _minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))
