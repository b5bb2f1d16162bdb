"""One registered query per operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecospark.llm import (bit_sliced_search, conversation_repair, golay_simhash, heap_clustering, near_duplicates, quality_embeddings,
                          quality_rules, secrets, sentencepiece_codec, sharding, soft_mixing, token_orc, toxicity_ftrl)
from ecospark.llm.common import table
from ecospark.llm.hashed_words import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document, judged by an isolation forest."""
    out = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "anomaly", "threshold")


@register("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with byte offsets and decoded again."""
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"), PIECE_MODEL)


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of every document, learned from the labels that are not held out."""
    held = remainder("doc_id", 4) == 2
    out = toxicity_ftrl.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=~held)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5"""


@register("op4_bit_sliced_search", OP4_SQL)
def op4_bit_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows by integer inner product of every 50th vector."""
    return bit_sliced_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@register("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of nearly equal bytes; equal texts share a shard."""
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), 16)
    return out.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


@register("op6_near_duplicates")
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingle sets have a similarity of 0.75 or more."""
    return near_duplicates.components_of(table(spark, sf_dir, "documents"))


@register("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, encoded layers included."""
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


@register("op8_quality_embeddings")
def op8_quality_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document, learned from the labels that are not held out."""
    held = remainder("doc_id", 5) == 0
    out = quality_embeddings.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=~held)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: Wanted shares of the tokens by (quality, toxic) domain.
MIX_WEIGHTS = {"quality1_toxic0": 0.85, "quality1_toxic1": 0.05, "quality0_toxic0": 0.08, "quality0_toxic1": 0.02}


@register("op9_soft_mixing")
def op9_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of every document whose expected tokens meet the wanted share of each label domain; the targets and what
    the fit reached stand in every row."""
    out, fit = soft_mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["quality", "toxic"],
                             weights=MIX_WEIGHTS)
    names = soft_mixing.domains_of(["quality", "toxic"])
    return out.select("doc_id", "n_tokens", *(F.col("p")[k].alias(f"p_{n}") for k, n in enumerate(names)), "rate", "copies",
                      *(F.lit(float(fit.target[k])).alias(f"target_{n}") for k, n in enumerate(names)),
                      *(F.lit(float(fit.reached[k])).alias(f"reached_{n}") for k, n in enumerate(names)))


@register("op10_token_orc")
def op10_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document written as ORC and indexed from the files."""
    return token_orc.encode_and_index(table(spark, sf_dir, "documents"), WORD_TOKENIZER, end_id=2)


@register("op11_golay_simhash")
def op11_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 64-bit fingerprints differ in two bits or fewer."""
    return golay_simhash.components_of(table(spark, sf_dir, "documents"))


@register("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    rows, present, copies = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.audit(rows, present, copies)


def _clustering_sql(k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, scale: int = 1024) -> str:
    """The rounds one after the other; ``n`` numbers rows, since ids may repeat."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT n, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.n, m.c, list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(v.v, m.m)])::BIGINT AS d
    FROM v CROSS JOIN m{r} m) GROUP BY n)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (
  SELECT c, p, sum(x)::BIGINT AS s, count(*)::BIGINT AS k
  FROM (SELECT a.c, unnest(v.v) AS x, unnest(range(1, {dim + 1})) AS p FROM a{r} a JOIN v USING (n)) GROUP BY c, p),
m{r + 1} AS MATERIALIZED (
  SELECT m.c, coalesce(w.m, m.m) AS m FROM m{r} m
  LEFT JOIN (SELECT c, list((s - ((s % k) + k) % k) // k ORDER BY p) AS m FROM s{r} GROUP BY c) w USING (c))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, vec_id, v) - 1 AS c, v AS m FROM (
    SELECT sha256('{seed}:' || vec_id) AS h, vec_id, v FROM v WHERE vec_id IS NOT NULL ORDER BY h, vec_id, v LIMIT {k})),
{",".join(s.strip() for s in steps)}
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (n) JOIN m{rounds} m USING (c)"""


@register("op13_heap_clustering", _clustering_sql())
def op13_heap_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight exact integer centroids after ten rounds, and the cluster of every vector."""
    return heap_clustering.cluster(table(spark, sf_dir, "embeddings"))
