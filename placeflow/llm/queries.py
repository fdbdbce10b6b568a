"""The queries opN_<name> over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeflow.llm._common import crc_mod, table
from placeflow.llm.bpe import digests, encode
from placeflow.llm.decontaminate import contamination_report, find_contamination
from placeflow.llm.line_dedup import drop_repeated_lines
from placeflow.llm.lexical import lexical_search
from placeflow.llm.negatives import hard_negatives, labelled
from placeflow.llm.ngram_join import near_duplicates
from placeflow.llm.pii import pii_report
from placeflow.llm.ppm import lm_scores
from placeflow.llm.records import records_report
from placeflow.llm.secrets import find_secrets, secrets_report
from placeflow.llm.token_counts import count_tokens, fresh_cache
from placeflow.llm.topk import quantised, top_k
from placeflow.llm.toxicity import THRESHOLD, fit, score


def toxicity_model(docs: DataFrame, labels: DataFrame):
    """Learnt from labels whose id isn't held out."""
    return fit(docs, labels.where(crc_mod(F.col("doc_id"), 4) != 2))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 1)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), fresh_cache(spark))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_report(find_secrets(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents"), 40, 5)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.where(F.col("id") % 50 == 0), vectors, 5)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 4, 85)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 13))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op11_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(labelled(table(spark, sf_dir, "embeddings"), label=label), F.col("id") % 100 == 0)


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_ppm": op2_ppm,
    "op3_token_counts": op3_token_counts,
    "op4_secrets": op4_secrets,
    "op5_pii": op5_pii,
    "op6_line_dedup": op6_line_dedup,
    "op7_topk": op7_topk,
    "op8_ngram_join": op8_ngram_join,
    "op9_decontamination": op9_decontamination,
    "op10_bpe": op10_bpe,
    "op11_records": op11_records,
    "op12_negatives": op12_negatives,
    "op13_lexical": op13_lexical,
}

ORACLE_SQL: dict[str, str] = {
    "op9_decontamination": r"""
WITH dw AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
iw AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
ig AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM ig),
dg AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
m AS (SELECT dg.doc_id, dg.i, dg.n, ig.item_id FROM dg JOIN ig ON dg.n = ig.n AND dg.g = ig.g),
hit AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM m) GROUP BY doc_id)
SELECT dw.doc_id, len(dw.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(dw.w), false) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
""",
    "op6_line_dedup": """
WITH l AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
f AS (SELECT key, max(doc_id) AS keep FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE l.doc_id <> f.keep) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.keep IS NULL OR l.doc_id = f.keep), '')) AS kept_sha256
FROM l LEFT JOIN f ON l.key = f.key GROUP BY l.doc_id
""",
    "op7_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op12_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, list_sum(list_transform(list_zip(a.w, c.w), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v a JOIN v c ON c.vec_id <> a.vec_id OR c.label <> a.label WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 100 * score BETWEEN 80 * positive_score AND 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""",
    "op13_lexical": r"""
WITH d AS (SELECT doc_id, w, len(w) AS n FROM (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents) WHERE len(w) > 0),
st AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM d),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM d) GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, st GROUP BY term, nd),
s AS (SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nd) // nt))))::BIGINT AS score FROM q JOIN w USING (term) JOIN p USING (term), st GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0) WHERE rank <= 20
""",
}
