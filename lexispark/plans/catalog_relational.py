"""Relational queries of the corpus pipeline, hosted on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import relational as R
from .registry import Tables, query

DURATION = "(CAST((n_chars * 603 + 5) // 10 AS DOUBLE) / 1000)"  # 0.0603 seconds a character, to the millisecond


def manifest(t: Tables) -> DataFrame:
    """documents as a manifest: a duration by the usual pace."""
    return t.documents.withColumn("duration", F.expr("(n_chars * 603 + 5) div 10") / 1000.0)


@query("SELECT doc_id, lang, n_chars FROM documents")
def scan_prune(t):
    return t.documents.select("doc_id", "lang", "n_chars")


@query("SELECT event_type, CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS INTEGER) AS k, count(*) AS n FROM events GROUP BY ALL")
def scan_json_extract(t):
    return t.events.groupBy("event_type", F.get_json_object("props", "$.k").try_cast("int").alias("k")).agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_size FROM part WHERE p_size >= 10 AND p_size < 40")
def score_filter(t):
    score = F.col("p_size").try_cast("int")
    return t.part.where((score >= 10) & (score < 40)).select("p_partkey", "p_size")


@query("SELECT p_size AS score, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM part GROUP BY p_size")
def score_distribution(t):
    counts = t.part.groupBy(F.col("p_size").alias("score")).agg(F.count("*").alias("n"))
    return counts.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p.p_name, '') AS p_name, coalesce(p.p_type, '') AS p_type FROM lineitem
LEFT JOIN (SELECT * FROM part WHERE p_size < 25) p ON p.p_partkey = l_partkey""")
def enrich_left_join(t):
    index = t.part.where("p_size < 25").select(F.lpad(F.col("p_partkey").cast("string"), 13, "0").alias("code"), "p_name", "p_type", "p_size")
    sales = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.lpad(F.col("l_partkey").cast("string"), 13, "0").alias("code"))
    return R.enrich(sales, index, "code", [F.desc("p_size"), F.desc("p_name")]).select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_type")


def _volumes(t):
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    a = sold.where("l_returnflag <> 'R' and p_size < 45").groupBy("p_brand", "p_type").agg(F.sum("l_quantity").alias("boxes"))
    b = sold.where("l_returnflag = 'R' and p_size > 5").groupBy("p_brand", "p_type").agg(F.sum("l_quantity").alias("units"))
    return a, b


_VOLUMES = """WITH sold AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey),
a AS (SELECT p_brand, p_type, sum(l_quantity) AS boxes FROM sold WHERE l_returnflag <> 'R' AND p_size < 45 GROUP BY ALL),
b AS (SELECT p_brand, p_type, sum(l_quantity) AS units FROM sold WHERE l_returnflag = 'R' AND p_size > 5 GROUP BY ALL) """


@query(_VOLUMES + """SELECT coalesce(a.p_brand, b.p_brand) AS p_brand, coalesce(a.p_type, b.p_type) AS p_type, coalesce(boxes, 0) AS boxes,
coalesce(units, 0) AS units, coalesce(boxes, 0) + coalesce(units, 0) AS total, coalesce(boxes, 0) = 0 AS right_only
FROM a FULL JOIN b ON a.p_brand = b.p_brand AND a.p_type = b.p_type""")
def full_outer_volumes(t):
    return R.full_volumes(*_volumes(t), ["p_brand", "p_type"], "boxes", "units")


@query("""WITH a AS (SELECT p_brand, list(DISTINCT p_type) AS s FROM part WHERE p_size < 4 GROUP BY 1), b AS (SELECT p_brand, list(DISTINCT p_type) AS s FROM part WHERE p_size > 47 GROUP BY 1)
SELECT coalesce(a.p_brand, b.p_brand) AS p_brand, array_to_string(list_sort(list_distinct(list_concat(coalesce(a.s, []), coalesce(b.s, [])))), ';') AS substances
FROM a FULL JOIN b ON a.p_brand = b.p_brand""")
def brand_union_substances(t):
    a = t.part.where("p_size < 4").groupBy("p_brand").agg(F.collect_set("p_type").alias("x"))
    b = t.part.where("p_size > 47").groupBy("p_brand").agg(F.collect_set("p_type").alias("y"))
    return a.join(b, "p_brand", "full").select("p_brand", F.array_join(R.union_sets(F.col("x"), F.col("y")), ";").alias("substances"))


_VOCABULARY = "SELECT DISTINCT split_part(p_name, ' ', 1) AS word FROM part WHERE p_size = 50 AND length(split_part(p_name, ' ', 1)) > 3"


@query(f"""SELECT p_partkey, p_name, (SELECT min(word) FROM ({_VOCABULARY}) v WHERE contains(p_name, word)) AS witness FROM part""")
def containment_witness(t):
    words = t.part.where("p_size = 50").select(F.split("p_name", " ")[0].alias("word")).where("length(word) > 3").distinct()
    return R.containment(t.part.select("p_partkey", "p_name"), "p_name", words, "word")


@query(f"""SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM ({_VOCABULARY}) v WHERE contains(p_name, word))""")
def containment_anti_join(t):
    return containment_witness(t).where("witness is null").select("p_partkey", "p_name")


@query("""WITH d AS (SELECT p_type AS word, max(p_size) AS dose FROM part GROUP BY 1), e AS (SELECT p_partkey, unnest([p_type, split_part(p_name, ' ', 1)]) AS word FROM part)
SELECT p_partkey, string_agg(word || '=' || dose, ';' ORDER BY word) AS doses FROM e LEFT JOIN d USING (word) GROUP BY 1""")
def explode_lookup_renest(t):
    doses = t.part.groupBy(F.col("p_type").alias("word")).agg(F.max("p_size").alias("dose"))
    words = t.part.select("p_partkey", F.explode_outer(F.array("p_type", F.split("p_name", " ")[0])).alias("word"))
    found = words.join(doses, "word", "left")
    entry = F.when(F.col("dose").isNotNull(), F.concat_ws("=", "word", F.col("dose").cast("string")))
    joined = found.groupBy("p_partkey").agg(F.array_sort(F.collect_list(F.struct("word", entry.alias("e")))).alias("l"))
    text = F.array_join(F.filter(F.transform("l", lambda x: x["e"]), lambda e: e.isNotNull()), ";")
    return joined.select("p_partkey", F.when(text != "", text).alias("doses"))


@query("""WITH v AS (SELECT p_brand || ' ' || p_type AS brand, sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) AS boxes, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS units
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1), w AS (SELECT *, boxes + units AS total, boxes = 0 AS hospital_only FROM v WHERE boxes + units > 0),
x AS (SELECT *, min(ln(total)) OVER () AS lo, max(ln(total)) OVER () AS hi FROM w)
SELECT brand, boxes, units, total, hospital_only, CASE WHEN hi = lo THEN 10 ELSE CAST(round_even(10 * (ln(total) - lo) / (hi - lo), 0) AS INTEGER) END AS score FROM x""")
def ranked_vocabulary(t):
    returned = F.col("l_returnflag") == "R"
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.concat_ws(" ", "p_brand", "p_type").alias("brand")).agg(
        F.sum(F.when(returned, 0.0).otherwise(F.col("l_quantity"))).alias("boxes"), F.sum(F.when(returned, F.col("l_quantity")).otherwise(0.0)).alias("units"))
    both = sold.withColumn("total", F.col("boxes") + F.col("units")).withColumn("hospital_only", F.col("boxes") == 0).where("total > 0")
    return R.min_max_score(both, "total").orderBy(F.desc("score"), F.desc("total"), "brand")


@query("SELECT CAST(i AS INTEGER) AS bucket, coalesce(n, 0) AS n FROM generate_series(0, 60) g(i) LEFT JOIN (SELECT p_size, count(*) AS n FROM part GROUP BY 1) ON p_size = i")
def histogram_zero_buckets(t):
    return R.fixed_histogram(t.part, "p_size", 0, 60)


@query(f"""SELECT CASE WHEN d >= 300 THEN 4 WHEN d >= 120 THEN 3 WHEN d >= 60 THEN 2 WHEN d >= 10 THEN 1 WHEN d >= 0 THEN 0 END AS bucket, count(*) AS n, sum(n_chars) AS chars, round(sum(d), 3) AS seconds
FROM (SELECT n_chars, {DURATION} AS d FROM documents) GROUP BY 1""")
def duration_edges_histogram(t):
    rows = manifest(t).withColumn("bucket", R.edge_bucket(F.col("duration"), [0, 10, 60, 120, 300]))
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.round(F.sum("duration"), 3).alias("seconds"))


@query("""SELECT DISTINCT p_name FROM part WHERE p_size > 25 AND lower(trim(p_name)) NOT IN (SELECT lower(trim(p_name)) FROM part WHERE p_size < 3)""")
def anti_join_terms(t):
    key = F.lower(F.trim(F.regexp_replace("p_name", r"(?U)\s+", " ")))
    known = t.part.where("p_size < 3").select(key.alias("k")).distinct()
    return t.part.where("p_size > 25").select("p_name", key.alias("k")).join(known, "k", "left_anti").select("p_name").distinct()


@query("SELECT doc_id FROM documents WHERE source = 'src0' AND lower(text) IN (SELECT lower(text) FROM documents WHERE source <> 'src0')")
def semi_join_eval_dupes(t):
    key = F.lower("text").alias("k")
    train = t.documents.where("source <> 'src0'").select(key).distinct()
    return t.documents.where("source = 'src0'").select("doc_id", key).join(train, "k", "left_semi").select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)")
def flagged_anti(t):
    return t.documents.select("doc_id").join(t.labels.where("quality = 0").select("doc_id"), "doc_id", "left_anti")


@query("SELECT p_partkey, CASE WHEN p_size BETWEEN 0 AND 9 THEN 12 WHEN p_size BETWEEN 10 AND 29 THEN 6 WHEN p_size BETWEEN 30 AND 44 THEN 3 ELSE 0 END AS n_variants FROM part")
def range_policy_variants(t):
    return R.range_policy(t.part, "p_size", [(0, 9, 12), (10, 29, 6), (30, 44, 3)]).select("p_partkey", "n_variants")


@query("""WITH s AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN lang || 'x' ELSE lang END AS lang, n_chars % 10 AS readings FROM documents WHERE doc_id % 3 <> 0)
SELECT d.doc_id, d.lang, CASE WHEN s.lang = d.lang THEN readings END AS readings, s.doc_id IS NOT NULL AND s.lang IS DISTINCT FROM d.lang AS stale FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id""")
def state_merge_stale(t):
    prior = t.documents.where("doc_id % 3 <> 0").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.concat("lang", F.lit("x"))).otherwise(F.col("lang")).alias("lang"), (F.col("n_chars") % 10).alias("readings"))
    return R.merge_state(t.documents.select("doc_id", "lang"), prior, "doc_id", "lang", ["readings"])


@query(f"""SELECT doc_id, changed, CASE WHEN changed THEN nd ELSE duration END AS duration FROM (SELECT d.doc_id, {DURATION} AS duration, CASE WHEN d.doc_id % 2 = 0 THEN {DURATION} + 0.0004 ELSE {DURATION} + 0.5 END AS nd,
coalesce(abs((CASE WHEN d.doc_id % 2 = 0 THEN {DURATION} + 0.0004 ELSE {DURATION} + 0.5 END) - {DURATION}) > 0.0005 AND d.doc_id % 5 <> 0, false) AS changed FROM documents d)""")
def conditional_update(t):
    rows = manifest(t).select("doc_id", "duration")
    news = rows.where("doc_id % 5 <> 0").withColumn("duration", F.when(F.col("doc_id") % 2 == 0, F.col("duration") + 0.0004).otherwise(F.col("duration") + 0.5))
    return R.update_if_moved(rows, news, "doc_id", "duration", 0.0005)


@query("SELECT doc_id, CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'val' ELSE 'test' END AS split FROM documents")
def split_sync(t):
    tens = F.col("doc_id") % 10
    labels = t.documents.select("doc_id", F.when(tens < 8, "train").when(tens == 8, "val").otherwise("test").alias("split"))
    return R.sync_labels(t.documents.select("doc_id"), labels, "doc_id", "split")


_SUMMARY = """count(x) AS n, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5), 6) AS median, CASE WHEN count(x) > 0 THEN round(coalesce(stddev_samp(x), 0), 6) END AS std, min(x) AS least, max(x) AS most,
round(quantile_cont(x, 0.1), 6) AS p10, round(quantile_cont(x, 0.9), 6) AS p90"""
_ROUNDED = ("mean", "median", "std", "p10", "p90")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query(f"SELECT source, {_SUMMARY} FROM (SELECT source, CAST(n_chars AS DOUBLE) AS x FROM documents) GROUP BY source")
def group_quantiles(t):
    return _rounded(t.documents.withColumn("x", F.col("n_chars").cast("double")).groupBy("source").agg(*R.summary("x")))


@query(f"SELECT coalesce(lang, 'overall') AS lang, {_SUMMARY} FROM (SELECT lang, CAST(n_chars AS DOUBLE) AS x FROM documents) GROUP BY ROLLUP (lang)")
def rollup_stats(t):
    return _rounded(t.documents.withColumn("x", F.col("n_chars").cast("double")).rollup("lang").agg(*R.summary("x"))).withColumn("lang", F.coalesce("lang", F.lit("overall")))


@query(f"""SELECT coalesce(source, '*') AS source, coalesce(lang, '*') AS lang, count(*) AS n, round(sum({DURATION}), 3) AS seconds, sum(n_chars) AS chars, round(100.0 * count(*) / (SELECT count(*) FROM documents), 6) AS percent
FROM documents GROUP BY GROUPING SETS ((source), (lang), (source, lang), ())""")
def grouping_sets_stats(t):
    rows = manifest(t)
    cube = rows.cube("source", "lang").agg(F.count("*").alias("n"), F.round(F.sum("duration"), 3).alias("seconds"), F.sum("n_chars").alias("chars"), F.grouping_id().alias("g"))
    total = F.max(F.when(F.col("g") == 3, F.col("n"))).over(Window.partitionBy())
    return cube.select(F.coalesce("source", F.lit("*")).alias("source"), F.coalesce("lang", F.lit("*")).alias("lang"), "n", "seconds", "chars", F.round(100.0 * F.col("n") / total, 6).alias("percent"))


@query(f"""WITH d AS (SELECT lang, {DURATION} AS x FROM documents), m AS (SELECT lang, max(x) AS most, count(*) AS rows FROM d GROUP BY 1)
SELECT lang, most, rows, count(*) FILTER (x >= most - 0.08) AS at_most, round(count(*) FILTER (x >= most - 0.08) / rows, 9) AS share, count(*) FILTER (x >= most - 0.08) > 1 AND count(*) FILTER (x >= most - 0.08) / rows >= 0.002 AS capped
FROM d JOIN m USING (lang) GROUP BY lang, most, rows""")
def ceiling_audit(t):
    return R.ceiling(manifest(t), "lang", "duration").withColumn("share", F.round("share", 9))


@query(f"SELECT source, count(*) AS n, round(avg({DURATION} / n_chars), 6) AS pace FROM documents WHERE n_chars > 0 AND {DURATION} > 0 GROUP BY 1")
def pace_stats(t):
    fine = manifest(t).where("n_chars > 0 and duration > 0")
    return fine.groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg(F.col("duration") / F.col("n_chars")), 6).alias("pace"))


@query("SELECT lang, source FROM (SELECT lang, source, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, source) AS k FROM documents GROUP BY 1, 2) WHERE k = 1")
def mode_source(t):
    counts = t.documents.groupBy("lang", "source").agg(F.count("*").alias("n"))
    return R.keep_one(counts, ["lang"], [F.desc("n"), F.col("source")]).select("lang", "source")


@query("""SELECT lang, count(*) AS n, count(l.doc_id) AS scored, count(*) FILTER (toxic = 1) AS bad, count(*) FILTER (toxic = 1 AND quality = 1) AS bad_checked, round(count(l.doc_id) / count(*), 9) AS coverage
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1""")
def coverage_counts(t):
    rows = t.documents.join(t.labels, "doc_id", "left")
    return rows.groupBy("lang").agg(
        F.count("*").alias("n"), F.count_if(F.col("quality").isNotNull()).alias("scored"), F.count_if(F.col("toxic") == 1).alias("bad"),
        F.count_if((F.col("toxic") == 1) & (F.col("quality") == 1)).alias("bad_checked"), F.round(F.count_if(F.col("quality").isNotNull()) / F.count("*"), 9).alias("coverage"))


@query("""SELECT p_brand, string_agg(inner_, '|' ORDER BY p_type) AS nested FROM (SELECT p_brand, p_type, p_type || ':' || string_agg(s, ',' ORDER BY s) AS inner_ FROM (SELECT DISTINCT p_brand, p_type, lpad(p_size::VARCHAR, 2, '0') AS s FROM part) GROUP BY 1, 2) GROUP BY 1""")
def nested_distinct(t):
    sizes = t.part.groupBy("p_brand", "p_type").agg(F.array_join(F.array_sort(F.collect_set(F.lpad(F.col("p_size").cast("string"), 2, "0"))), ",").alias("s"))
    return sizes.groupBy("p_brand").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_type", "s"))), lambda x: F.concat_ws(":", x["p_type"], x["s"])), "|").alias("nested"))


@query("""SELECT base, form FROM (SELECT split_part(p_name, ' ', 2) AS base, p_name AS form, row_number() OVER (PARTITION BY split_part(p_name, ' ', 2) ORDER BY p_name <> split_part(p_name, ' ', 2), length(p_name), p_name) AS k FROM part) WHERE k = 1""")
def representative_form(t):
    base = F.element_at(F.split("p_name", " "), 2)
    rows = t.part.select(base.alias("base"), F.col("p_name").alias("form"))
    return rows.groupBy("base").agg(F.min_by("form", F.struct(F.col("form") != F.col("base"), F.length("form"), F.col("form"))).alias("form"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def first_wins(t):
    return R.keep_one(t.events, ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "event_type")


@query("SELECT event_type, event_id, value, k FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS k FROM events) WHERE k <= 5")
def topk_per_group(t):
    w = Window.partitionBy("event_type").orderBy(F.desc("value"), "event_id")
    return t.events.withColumn("k", F.row_number().over(w)).where("k <= 5").select("event_type", "event_id", "value", "k")


@query("""SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'error', coalesce(value, 'inf'::DOUBLE), ts, event_id) AS k FROM events) WHERE k = 1""")
def best_reading(t):
    rank = F.struct(F.col("event_type") == "error", F.coalesce("value", F.lit(float("inf"))), "ts", "event_id")
    return t.events.groupBy("user_id").agg(F.min_by(F.struct("event_id", "value"), rank).alias("best")).select("user_id", "best.*")


@query("""SELECT lang, source, n, round(100.0 * n / sum(n) OVER (PARTITION BY lang), 6) AS of_lang, round(100.0 * n / sum(n) OVER (), 6) AS of_all FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2)""")
def percent_of_totals(t):
    counts = t.documents.groupBy("lang", "source").agg(F.count("*").alias("n"))
    part = lambda w: F.round(100.0 * F.col("n") / F.sum("n").over(w), 6)
    return counts.withColumn("of_lang", part(Window.partitionBy("lang"))).withColumn("of_all", part(Window.partitionBy()))


@query("SELECT sha256(trim(text)) AS text_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1")
def text_hash_dedupe(t):
    return t.documents.groupBy(F.sha2(F.trim("text"), 256).alias("text_hash")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).where("copies > 1")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 50")
def heavy_hitters(t):
    return t.events.groupBy("user_id").agg(F.count("*").alias("n")).where("n > 50")


@query("SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id) <= 25 AS in_scope FROM documents WHERE lang = 'fr'")
def limit_pending(t):
    return R.limit_flag(t.documents.where("lang = 'fr'").select("doc_id", "n_chars"), [F.desc("n_chars"), F.col("doc_id")], 25)


@query()
def sample_per_lang(t):
    return R.sample(t.documents.select("doc_id", "lang"), ["lang"], "doc_id", 10, 7)


@query("SELECT CAST(floor((k - 1) / per) AS INTEGER) AS shard, min(doc_id) AS first, max(doc_id) AS last, count(*) AS n FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS k, ceil(count(*) OVER () / ceil(count(*) OVER () / 300.0)) AS per FROM documents) GROUP BY 1")
def shard_plan(t):
    return R.shard_plan(t.documents, "doc_id", 300)


@query("""SELECT 'en/' || doc_id AS path, lang, NULL AS note FROM documents WHERE lang = 'en' UNION ALL SELECT 'rest/' || doc_id, lang, source FROM documents WHERE lang <> 'en'""")
def union_rebase(t):
    a = t.documents.where("lang = 'en'").select(F.concat(F.lit("en/"), F.col("doc_id").cast("string")).alias("path"), "lang")
    b = t.documents.where("lang <> 'en'").select(F.concat(F.lit("rest/"), F.col("doc_id").cast("string")).alias("path"), "lang", F.col("source").alias("note"))
    return a.unionByName(b, allowMissingColumns=True)


@query("""(SELECT doc_id, quality, 'left' AS side FROM labels EXCEPT ALL SELECT doc_id, quality, 'left' FROM labels WHERE doc_id % 4 <> 0) UNION ALL SELECT doc_id, 9, 'right' FROM labels WHERE doc_id % 9 = 0""")
def drift_check(t):
    a = t.labels.select("doc_id", "quality")
    b = a.where("doc_id % 4 <> 0").unionByName(a.where("doc_id % 9 = 0").withColumn("quality", F.lit(9)))
    return R.drift(a, b)


@query("""WITH h AS (SELECT DISTINCT CAST(p_size AS BIGINT) AS v FROM part WHERE p_size % 7 <> 0 OR p_size > 30) SELECT i AS value, 'missing' AS problem FROM generate_series(5, 40) g(i) WHERE i NOT IN (SELECT v FROM h)
UNION ALL SELECT v, 'extra' FROM h WHERE v NOT BETWEEN 5 AND 40""")
def range_coverage(t):
    return R.missing_and_extra(t.part.where("p_size % 7 <> 0 or p_size > 30"), "p_size", 5, 40)


@query("""SELECT a.p_partkey, len(list_intersect(string_split(p_name, ' '), string_split(lower(p_type), ' '))) > 0 AS shares, array_to_string(list_sort(list_filter(list_distinct(string_split(p_name, ' ')), lambda x: x NOT IN ('small', 'large'))), ' ') AS rest FROM part a""")
def word_set_tests(t):
    words = F.split("p_name", " ")
    rest = F.array_sort(F.array_except(words, F.array(F.lit("small"), F.lit("large"))))
    return t.part.select("p_partkey", F.arrays_overlap(words, F.split(F.lower("p_type"), " ")).alias("shares"), F.array_join(rest, " ").alias("rest"))


@query("""SELECT user_id, coalesce(max(CASE WHEN event_type = 'click' THEN v END), CASE WHEN count(*) = 1 THEN max(v) END, max(CASE WHEN event_type = 'view' THEN v END)) AS entry
FROM (SELECT user_id, event_type, max(value) AS v FROM events GROUP BY 1, 2) GROUP BY 1""")
def choose_entry(t):
    latest = t.events.groupBy("user_id", "event_type").agg(F.max("value").alias("v"))
    maps = latest.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("m"))
    only = F.when(F.size("m") == 1, F.map_values("m")[0])
    return maps.select("user_id", F.coalesce(F.col("m")["click"], only, F.col("m")["view"]).alias("entry"))


@query("SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_acctbal < 0 THEN 'in_debt' END, CASE WHEN c_mktsegment = 'BUILDING' THEN 'building' END, CASE WHEN c_nationkey IN (1, 2) THEN 'near' END], lambda x: x IS NOT NULL), ',') AS reasons FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING' OR c_nationkey IN (1, 2)")
def suspicion_labels(t):
    reasons = F.array_compact(F.array(F.when(F.col("c_acctbal") < 0, "in_debt"), F.when(F.col("c_mktsegment") == "BUILDING", "building"), F.when(F.col("c_nationkey").isin(1, 2), "near")))
    return t.customer.select("c_custkey", reasons.alias("r")).where(F.size("r") > 0).select("c_custkey", F.array_join("r", ",").alias("reasons"))


@query("SELECT p_partkey, w AS pron, CAST(i - 1 AS INTEGER) AS pron_index, len(l) AS n_prons FROM (SELECT p_partkey, l, unnest(l) AS w, unnest(range(1, len(l) + 1)) AS i FROM (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN [p_type] ELSE [split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] END AS l FROM part WHERE split_part(p_name, ' ', 1) <> split_part(p_name, ' ', 2)))")
def expand_pronunciations(t):
    given = F.when(F.col("p_size") % 5 == 0, F.lit(" ; ;")).otherwise(F.concat(F.regexp_replace("p_name", " ", " ; "), F.lit(";"), F.split("p_name", " ")[0]))
    parts = F.array_distinct(F.filter(F.transform(F.split(given, ";"), lambda x: F.trim(x)), lambda x: x != ""))
    listed = F.when(F.size(parts) > 0, parts).otherwise(F.array("p_type"))
    rows = t.part.where(F.split("p_name", " ")[0] != F.split("p_name", " ")[1]).select("p_partkey", listed.alias("l"))
    return rows.select("p_partkey", F.posexplode("l").alias("pron_index", "pron"), F.size("l").cast("bigint").alias("n_prons"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]+/[^/]+)$', 1) AS clip_key FROM pages")
def path_keys(t):
    return t.pages.select("page_id", F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("host"), F.regexp_extract(F.regexp_replace("url", r"[?#].*$", ""), r"([^/]+/[^/]+)$", 1).alias("clip_key"))


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def windowed_events(t):
    grouped = t.events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return grouped.select(F.col("w.start").alias("start"), "event_type", "n", "total")


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, session""")
def sessions(t):
    grouped = t.events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return grouped.select("user_id", F.col("w.start").alias("start"), "n")


@query("""WITH d AS (SELECT user_id, count(*) AS have FROM events WHERE event_type = 'purchase' GROUP BY 1), u AS (SELECT DISTINCT user_id, 14 AS wanted FROM events)
SELECT u.user_id, wanted, wanted - coalesce(have, 0) AS left_to_do FROM u LEFT JOIN d USING (user_id) WHERE wanted - coalesce(have, 0) > 0""")
def resume_pending(t):
    users = t.events.select("user_id").distinct().withColumn("wanted", F.lit(14))
    return R.pending(users, t.events.where("event_type = 'purchase'"), "user_id", "wanted")


@query("SELECT c_nationkey, sum(c_acctbal) FILTER (c_acctbal > 0) / count(*) AS rate, round(sum(c_acctbal * c_custkey) / sum(c_custkey), 6) AS weighted FROM customer GROUP BY 1 HAVING sum(c_custkey) > 0")
def weighted_rates(t):
    kept = F.sum(F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))) / F.count("*")
    return t.customer.groupBy("c_nationkey").agg(kept.alias("rate"), F.round(F.sum(F.col("c_acctbal") * F.col("c_custkey")) / F.sum("c_custkey"), 6).alias("weighted"), F.sum("c_custkey").alias("w")).where("w > 0").drop("w")
