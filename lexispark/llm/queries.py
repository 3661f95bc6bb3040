"""The registered queries of this subpackage, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, contamination, licenses, linededup, lm, neardup, pii, token_counts, topk, toxicity


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op1_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op5_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), contamination.items_sha256().alias("items_sha256"), "contaminated")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.toxicity(docs, model).select("doc_id", "severity", "grade", "toxic")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary)


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", F.col("_n_lines").cast("bigint").alias("n_lines"), F.col("_n_gone").cast("bigint").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"), pii.train())
    counts = [pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.concat("base", "added")).alias("spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_lm, op2_byte_bpe, op3_licenses, op4_topk, op5_contamination, op6_toxicity, op7_token_counts, op8_neardup, op9_line_dedup, op10_pii)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP4 = """WITH v AS (SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s) SELECT * FROM r WHERE rank <= 5"""

_OP5 = f"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
t AS (SELECT DISTINCT item, w[k:k + 12] AS win FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
l AS (SELECT DISTINCT len(win) AS n FROM t),
o AS (SELECT doc_id, k, n, item FROM (SELECT doc_id, k, n, w[k:k + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, l WHERE len(w) >= n)) JOIN t USING (win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM o)) GROUP BY 1),
i AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM o GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)"""

_OP8 = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[k:k + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c(doc_id, low) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, c.low FROM c JOIN e ON e.a = c.doc_id AND c.low < e.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.low AS component_id, d.doc_id = m.low AS kept FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(low) AS low FROM c GROUP BY 1) m ON m.doc_id = d.doc_id"""


def oracle_sql() -> dict[str, str]:
    """Models, tokenizers, span offsets and SimHashes can't be written as SQL; the tests hold those against plain Python."""
    return {"op4_topk": _OP4, "op5_contamination": _OP5, "op8_neardup": _OP8}
