"""Audit queries, hosted on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audits
from .registry import query


@query("SELECT l_orderkey, l_linenumber, l_linenumber > 1 AND CAST(l_quantity AS DOUBLE) >= 10 * (l_linenumber - 1) - 0.5 AS truncated FROM lineitem")
def truncated_clips(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", audits.is_truncated(F.col("l_quantity").cast("double"), 10 * (F.col("l_linenumber") - 1)).alias("truncated"))


@query("SELECT source, count(*) AS texts, count(*) FILTER (contains(text, '@')) AS leaks FROM documents GROUP BY source HAVING count(*) FILTER (contains(text, '@')) > 0")
def leak_counts(t):
    return audits.leak_counts(t.documents.select("source", "text"), "source", F.contains("text", F.lit("@")))


@query("""SELECT count(*) AS rows, count(*) FILTER (text IS DISTINCT FROM replace(text, '. ', '.')) AS changed, count(*) FILTER (contains(replace(text, '. ', '.'), ' .')) AS leftover,
count(*) FILTER (regexp_matches(text, '[^\\x00-\\x7F]')) AS uncovered FROM documents""")
def change_counters(t):
    new = F.replace("text", F.lit(". "), F.lit("."))
    return audits.change_counters(t.documents, F.col("text"), new, F.contains(new, F.lit(" .")), F.col("text").rlike(r"[^\x00-\x7F]"))


@query("""SELECT c_nationkey, CAST(row_number() OVER (ORDER BY CASE WHEN p > 0 THEN p END NULLS LAST, c_nationkey) AS INTEGER) AS place
FROM (SELECT c_nationkey, max(c_acctbal) AS p FROM customer GROUP BY c_nationkey)""")
def cheapest_first(t):
    offers = t.customer.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("p"))  # a row a nation
    return audits.cheapest_first(offers, F.when(F.col("p") > 0, F.col("p")), F.col("c_nationkey")).select("c_nationkey", "place")
