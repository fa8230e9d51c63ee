"""One registered query per text operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.llm import ann, bpe, decontam, langid, licenses, lm, negatives, quality, secrets, simhash, toxicity, trie, warc
from snapflow.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op8_secrets")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find(docs.select("doc_id", "text"), secrets.train(docs)).select("doc_id", "secrets")
    of = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
                        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
                        secrets.listed(F.col("secrets")).alias("spans"), of(3).alias("n_markov"))


@query("op1_simhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query("op4_warc", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
    w AS (SELECT d, max(page_id) AS winner FROM p WHERE n >= 1000 GROUP BY d)
    SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
           CASE WHEN n >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND page_id <> winner THEN winner END AS refers_to
    FROM p LEFT JOIN w ON p.d = w.d""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    manifest = warc.write(warc.decide(pages), warc.fresh_folder(spark))
    return warc.read(manifest, pages.schema["page_id"].dataType).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_langid")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(fold("doc_id", 5) != 0))
    return langid.identify(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(fold("doc_id", 4) != 2))
    return toxicity.score(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query("op9_decontaminate")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "stretch", "agreeing", "covered")


@query("op7_ann")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op6_lm")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), fold("doc_id", 5) == 1)


@query("op5_licenses", licenses.sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find(table(spark, sf_dir, "documents"), licenses.known(spark))


@query("op11_hard_negatives", """
    WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
               FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, list_inner_product(a.v, r.v)::BIGINT AS score
          FROM e AS a JOIN e AS r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
    QUALIFY rank <= 10""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, turned = table(spark, sf_dir, "embeddings"), F.col("vec_id") % 7 == 0
    rows = rows.withColumn("label", F.when(turned, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query("op12_prefix_trie", """
    WITH t AS (SELECT conv_id, row(coalesce(role, ''), coalesce(text, '')) AS said,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
               FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, list(said ORDER BY place) AS own,
                 xor(list_reduce(list_concat([4294967295::UBIGINT], flatten([[ascii(x)::UBIGINT, 0, 0, 0, 0, 0, 0, 0] FOR x IN string_split(conv_id::VARCHAR, '')])),
                                 lambda a, x: CASE WHEN xor(a, x) % 2 = 1 THEN xor(xor(a, x) >> 1, 3988292384::UBIGINT) ELSE xor(a, x) >> 1 END),
                     4294967295::UBIGINT) % 6 AS h
          FROM t GROUP BY conv_id),
    b AS (SELECT c.conv_id, list_concat(coalesce(p.own, [])[1:c.h::INT], c.own[c.h::INT + 1:]) AS turns
          FROM c LEFT JOIN c AS p ON p.conv_id = c.conv_id - c.conv_id % 100),
    m AS (SELECT conv_id, len(turns) AS n, turns[1:d] AS path, d FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM b)),
    n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
          FROM m GROUP BY path, d),
    k AS (SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
    f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.d > 0 THEN (n_convs - 1) * length(n.path[n.d][2]) ELSE 0 END AS own_saved
          FROM n LEFT JOIN k ON k.path = n.path AND k.d = n.d),
    s AS (SELECT path[1:up] AS path, up AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum(own_saved)::BIGINT AS saved_tokens
          FROM (SELECT path, n_children, own_saved, unnest(range(d + 1)) AS up FROM f) GROUP BY ALL)
    SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
    FROM f JOIN s ON s.path = f.path AND s.d = f.d LEFT JOIN n AS p ON p.path = f.path[1:f.d - 1] AND p.d = f.d - 1""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.build(table(spark, sf_dir, "conversations"))


@query("op13_quality")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("quality").alias("posterior"))
