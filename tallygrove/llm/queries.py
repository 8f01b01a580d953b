"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, quality, toxicity
from ._common import crc_mod, read_table
from .clustering import cluster_vectors
from .exact_dedup import exact_dedup
from .hmm_lm import score_documents
from .html_extract import extract
from .lexical import search
from .line_dedup import MAX_RATIO, MIN_PAGES, drop_boilerplate
from .packing import pack_documents
from .pieces import decode_documents, encode_documents
from .simhash import near_dedup
from .topk import top_k


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read_table(spark, sf_dir, "documents"))


def train_langid(docs: DataFrame) -> langid.Model | None:
    """Learn from documents whose crc32 of the id is not 2 modulo 4 (a null id counts as training)."""
    return langid.train(docs.where(F.coalesce(crc_mod(F.col("doc_id"), 4) != 2, F.lit(True))).select("text", "lang"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    told = langid.identify(docs, train_langid(docs))
    held = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    return told.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rules = quality.learn(quality.labelled_rows(docs, read_table(spark, sf_dir, "labels")))
    return quality.assess(docs, rules)


def train_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Grammar:
    """Learn from labels of documents whose crc32 of the id is not 0 modulo 5."""
    return toxicity.train(docs, read_table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 5) != 0))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    told = toxicity.toxicity(docs, train_toxicity(spark, docs, sf_dir))
    held = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    return told.select("doc_id", held.alias("held_out"), "score", "predicted")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode with the N best segmentations, then decode the best one's ids again."""
    coded = encode_documents(read_table(spark, sf_dir, "documents"))
    told = coded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_pieces"),
        F.element_at("crcs", 1).alias("ids_crc32"),
        F.element_at("scores", 1).alias("score"),
        F.get("scores", 1).alias("second_score"),
        F.size("scores").cast("long").alias("n_best"),
    )
    back = decode_documents(told, keep=("n_pieces", "ids_crc32", "score", "second_score", "n_best"))
    return back.withColumn("decoded_sha256", F.sha2(F.col("text").cast("binary"), 256)).drop("text")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of a document is its host."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    told = drop_boilerplate(docs)
    return told.select("doc_id", "n_lines", "n_dropped", F.coalesce("text", F.lit("")).alias("text"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op10_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) == 2)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_simhash": op2_simhash,
    "op3_langid": op3_langid,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_line_dedup": op8_line_dedup,
    "op9_html_extract": op9_html_extract,
    "op10_hmm_lm": op10_hmm_lm,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_ranked_search": op12_ranked_search,
    "op13_exact_top_k": op13_exact_top_k,
}


def _lloyd_sql(k: int = 8, rounds: int = 10) -> str:
    """Rounds of assignment and floored means, one after the other."""
    steps = [
        """w AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
               FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS k, v AS c FROM w QUALIFY k < {k})",
    ]
    for i in range(rounds + 1):
        distance = "list_sum(list_transform(list_zip(v, c), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::BIGINT"
        steps.append(f"d{i} AS MATERIALIZED (SELECT r, vec_id, v, k, {distance} AS d FROM w CROSS JOIN c{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)")
        if i < rounds:
            parts = f"SELECT k, j, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM d{i}) GROUP BY k, j"
            mean = "(s - (((s % n) + n) % n)) // n"
            means = f"SELECT k, list({mean} ORDER BY j) AS c FROM ({parts}) GROUP BY k"
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN ({means}) m USING (k))")
    last = f"d{rounds}"
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM {last} JOIN c{rounds} USING (k)
    """

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
        SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, false) AS kept, sha256(text) AS text_sha256
        FROM d JOIN g USING (text)
    """,
    "op8_line_dedup": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS page,
                          string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        e AS (SELECT r, host, page, unnest(lines) AS line, generate_subscripts(lines, 1) AS k FROM d),
        c AS (SELECT host, trim(line, ' ') AS line, count(DISTINCT page) AS pages FROM e WHERE trim(line, ' ') <> '' GROUP BY ALL),
        t AS (SELECT host, count(DISTINCT page) AS total FROM d GROUP BY host),
        b AS (SELECT host, line FROM c JOIN t USING (host) WHERE pages >= {MIN_PAGES} AND pages > {MAX_RATIO} * total),
        k AS (SELECT r, list(e.line ORDER BY k) AS kept FROM e LEFT JOIN b ON e.host = b.host AND trim(e.line, ' ') = b.line
              WHERE b.line IS NULL GROUP BY r)
        SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(len(kept), 0))::BIGINT AS n_dropped,
               coalesce(array_to_string(kept, chr(10)), '') AS text
        FROM d LEFT JOIN k USING (r)
    """,
    "op11_centroid_clustering": _lloyd_sql(),
    "op12_ranked_search": r"""
        WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS own FROM documents),
        d AS (SELECT r, doc_id, len(own) AS n, own FROM t WHERE len(own) > 0),
        s AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM d),
        p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(own) AS term FROM d) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
        q AS (SELECT DISTINCT i, item_id, term FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
        f AS (SELECT i, item_id, d.r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))))::BIGINT AS score
              FROM q JOIN p USING (term) JOIN w USING (term) JOIN d ON d.r = p.r CROSS JOIN s GROUP BY ALL)
        SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM f WHERE score > 0 QUALIFY rank <= 10
    """,
    "op13_exact_top_k": """
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
                   FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, q.r, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda t: t[1] * t[2])), 0)::BIGINT AS score
              FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
        SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM s QUALIFY rank <= 5
    """,
}
