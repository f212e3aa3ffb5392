"""One query per text operator over its whole table, and the SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geocadence.llm import quality, toxicity
from geocadence.llm.binary_pieces import bucketed
from geocadence.llm.cuckoo import duplicates
from geocadence.llm.forest import nearest
from geocadence.llm.jaccard import similar_classes
from geocadence.llm.kneser_ney import scored, trained
from geocadence.llm.mixing import mix_counts
from geocadence.llm.multi_index import hard_negatives
from geocadence.llm.packing import packed
from geocadence.llm.permuterm import spelling_groups
from geocadence.llm.quotes import conversations
from geocadence.llm.tables import text_hash_key
from geocadence.llm.token_files import written

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, table: str = "documents", sql: str | None = None):
    """Registers ``fn(spark, sf_dir, df)``; ``df`` is the whole table."""
    def wrap(fn):
        LLM_QUERIES[name] = lambda spark, sf_dir: fn(spark, sf_dir, spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql is not None:
            LLM_ORACLES[name] = sql.strip()
        return fn
    return wrap


def held_out(parts: int, which: int):
    """Whether a doc_id is held out; a null one is not."""
    return F.coalesce(F.pmod(text_hash_key(), F.lit(parts)) == which, F.lit(False))


def classified(spark, sf_dir, docs, module, parts: int, which: int):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(parts, which))
    return module.scored(docs, module.trained(docs, labels)).select("doc_id", held_out(parts, which).alias("held_out"), "score", "predicted")


@query("op1_quality_rules")
def op1(spark, sf_dir, docs):
    return classified(spark, sf_dir, docs, quality, 5, 0)


def mailbox(turns: DataFrame) -> DataFrame:
    """(message_id, text): the conversations as mail, every turn quoting the one before it, and that one the one before."""
    own = turns.select("conv_id", "turn", "text")
    before = lambda n: own.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("text").alias(f"text_{n}"))
    quoted = lambda c: F.regexp_replace(c, "(?m)^", "> ")
    rows = own.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    whole = quoted(F.concat_ws("\n", "text_1", quoted(F.col("text_2"))))
    text = F.when(F.col("text_1").isNull(), F.col("text")).otherwise(F.concat_ws("\n", "text", F.lit("\nOn that day they wrote:"), whole))
    return rows.select((F.col("conv_id") * (1 << 20) + F.col("turn")).alias("message_id"), text.alias("text"))


@query("op2_quotation_links", "conversations", sql=r"""
WITH RECURSIVE m AS (
  SELECT conv_id * 1048576 + turn AS id, conv_id, turn, trim(text, chr(10)) AS text, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS body
  FROM conversations),
units AS (
  SELECT id, body AS u FROM m UNION
  SELECT id, lower(trim(regexp_replace(x, '\s+', ' ', 'g'))) FROM (SELECT id, unnest(string_split(text, chr(10))) AS x FROM m)),
owners AS (SELECT u, min(id) AS owner FROM units GROUP BY u),
r AS (
  SELECT m.id, m.text, o.owner AS reply_to FROM m
  LEFT JOIN m p ON p.conv_id = m.conv_id AND p.turn = m.turn - 1 LEFT JOIN owners o ON o.u = p.body),
t(id, conversation, depth) AS (
  SELECT id, id, 0 FROM r WHERE reply_to IS NULL UNION ALL
  SELECT r.id, t.conversation, t.depth + 1 FROM r JOIN t ON r.reply_to = t.id)
SELECT conversation, CAST(depth AS BIGINT) AS depth, id AS message_id, reply_to, text FROM t JOIN r USING (id)""")
def op2(spark, sf_dir, turns):
    return conversations(mailbox(turns), latest=True)


@query("op3_source_mixing")
def op3(spark, sf_dir, docs):
    return mix_counts(docs)


@query("op4_exact_dedup", sql=r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)""")
def op4(spark, sf_dir, docs):
    return duplicates(docs).withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


@query("op5_kneser_ney")
def op5(spark, sf_dir, docs):
    rows = scored(docs, trained(docs.where(~held_out(5, 1))))
    return rows.select("doc_id", held_out(5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op6_best_fit_packing")
def op6(spark, sf_dir, docs):
    return packed(docs)


@query("op7_ngram_jaccard")
def op7(spark, sf_dir, docs):
    return similar_classes(docs)


@query("op8_projection_forest", "embeddings")
def op8(spark, sf_dir, vectors):
    return nearest(vectors, vectors.where("vec_id % 20 = 0").select("vec_id"))


@query("op9_token_files")
def op9(spark, sf_dir, docs):
    return written(docs)


@query("op10_toxicity")
def op10(spark, sf_dir, docs):
    return classified(spark, sf_dir, docs, toxicity, 3, 1)


@query("op11_multi_index", "embeddings", sql=r"""
WITH a AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS anchor_id, r.vec_id, q.label = r.label AS same, list_sum(list_transform(list_zip(q.v, r.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM a q JOIN a r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) QUALIFY rank <= 3""")
def op11(spark, sf_dir, vectors):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), vectors.where("vec_id % 50 = 0").select("vec_id"))


@query("op12_binary_pieces")
def op12(spark, sf_dir, docs):
    return bucketed(docs)


@query("op13_permuterm")
def op13(spark, sf_dir, docs):
    return spelling_groups(docs)
