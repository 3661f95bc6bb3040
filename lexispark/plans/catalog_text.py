"""Text, release, splitting and rule queries, hosted on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import cleaning, rules, splitting
from .catalog_relational import DURATION, manifest
from .registry import query

ALPHABET = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .,;:!?'\n-éèêàâùûîïôçœñäöüß")
RATIOS = {"train": 0.8, "val": 0.1, "test": 0.1}
RULES = [("anonhath", "Anonath"), ("the than", "the-than"), ("erble", "herble"), ("stuff", "stoff"), ("thanth", "Anonath"), ("ciónes", "sesión"), ("l'auxen", "l'auxène")]


@query(f"SELECT page_id, translate(lower(url), '{C.ACCENTED}', '{C.PLAIN}') AS folded FROM pages")
def fold_accents(t):
    return t.pages.select("page_id", C.unaccented(F.lower("url")).alias("folded"))


@query()
def fold_accents_exact(t):
    return t.documents.select("doc_id", F.sha2(C.fold_accents(F.col("text")), 256).alias("folded"))


@query("SELECT ch AS char, count(DISTINCT doc_id) AS texts, min(doc_id) AS example FROM (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents) WHERE NOT contains('" + "".join(ALPHABET).replace("'", "''").replace("\n", "") + "', ch) AND ch <> chr(10) GROUP BY 1")
def alphabet_audit(t):
    return cleaning.character_audit(t.documents, "doc_id", "text", ALPHABET)


@query()
def respace_stops(t):
    return t.documents.select("doc_id", F.sha2(C.respace(F.col("text")), 256).alias("text_hash"))


@query("""SELECT doc_id, i AS at, CASE WHEN length(l) < 10 THEN 'too_short' WHEN regexp_matches(l, '[\\[\\]{}|\\\\^~<>]') THEN 'ignore_char' WHEN contains(l, ':') THEN 'colon' WHEN NOT regexp_matches(l, '[.?]$') THEN 'no_end_punct'
WHEN regexp_matches(l, '\\p{Lu}') AND NOT regexp_matches(l, '\\p{Ll}') THEN 'all_caps' WHEN NOT regexp_matches(l, '(?s)^\\p{Lu}\\P{Lu}') THEN 'not_cap_start' END AS reason
FROM (SELECT doc_id, i - 1 AS i, trim(regexp_replace(l, '\\s+', ' ', 'g')) AS l FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)) WHERE l <> ''""")
def line_reject_reason(t):
    return cleaning.lines(t.documents, "doc_id", "text").where("line <> ''").select(F.col("doc").alias("doc_id"), F.col("i").cast("bigint").alias("at"), "reason")


@query()
def islands_blocks(t):
    return cleaning.blocks(cleaning.lines(t.documents, "doc_id", "text"))


@query()
def loss_ledger(t):
    lines = cleaning.lines(t.documents, "doc_id", "text")
    return cleaning.ledger(lines, cleaning.blocks(lines))


@query()
def loss_positions(t):
    return cleaning.deciles(cleaning.lines(t.documents, "doc_id", "text"))


@query(f"""WITH k AS (SELECT DISTINCT lower(text) AS k FROM documents WHERE doc_id % 2 = 0), d AS (SELECT d.*, {DURATION} AS duration, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT doc_id, CASE WHEN toxic = 1 THEN 'exhausted' WHEN doc_id % 2 = 1 AND lower(text) IN (SELECT k FROM k) THEN 'duplicate-of-train' WHEN regexp_matches(text, '\\.\\.\\.|…') THEN 'ellipsis'
WHEN regexp_matches(text, '(?i:\\blet me\\b|\\bI''ll\\b|\\bI will\\b|\\bhere (?:is|are)\\b|\\bas requested\\b)|\\bSentence \\d+\\s*:|</?t>') THEN 'llm-leak' WHEN duration > 0 AND len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) / duration > 4 THEN 'too-fast' WHEN source = 'src1' THEN 'asr-flagged' END AS reason FROM d""")
def drop_reason(t):
    key = F.lower("text")
    train = t.documents.where("doc_id % 2 = 0").select(key.alias("k")).distinct().withColumn("twin", F.lit(True))
    rows = manifest(t).join(t.labels, "doc_id", "left").withColumn("k", key).join(train, "k", "left")
    twin = F.coalesce(F.col("twin") & (F.col("doc_id") % 2 == 1), F.lit(False))
    status = F.when(F.col("toxic") == 1, "exhausted").otherwise("original")
    return rows.select("doc_id", C.release_reason(status, twin, F.col("text"), F.col("duration"), F.col("source") == "src1", fastest=4.0).alias("reason"))


@query()
def percent_canonical(t):
    spelled = F.concat(F.lit("Taux de "), F.col("n_chars").cast("string"), F.lit(" pour cent, quatre-vingts pourcent, cinq pour cent grammes"))
    return t.documents.select("doc_id", C.percent_symbol(spelled).alias("label"))


@query()
def spoken_units(t):
    label = F.concat(F.lit("Dose "), F.col("p_size").cast("string"), F.lit("mg/L puis 3,5 µg/kg/min au stade IV, 12 %, 4 mg/dose"))
    spoken = C.spoken_form(label)
    return t.part.select("p_partkey", spoken.alias("source"), F.array_join(C.residual_units(spoken), "|").alias("residuals"))


@query()
def label_conventions(t):
    label = F.concat(F.lit("M. Dupont vient le quinze mars deux mille vingt à 14h30 pour "), F.col("p_size").cast("string"), F.lit(" milligrammes; stade IIIb, œdème. "), F.col("p_name"))
    return t.part.select("p_partkey", C.label_conventions(label).alias("label"))


@query()
def scoring_fold(t):
    return t.conversations.select("conv_id", "turn", F.sha2(C.scoring_fold(F.col("text")), 256).alias("folded"))


@query()
def chunk_documents(t):
    return t.documents.select("doc_id", F.posexplode(C.chunks(F.col("text"))).alias("chunk_index", "text")).select("doc_id", "chunk_index", F.char_length("text").alias("n_chars"), F.sha2("text", 256).alias("text_hash"))


_ASCII = "regexp_replace(lower({}), '[^a-z ]', '', 'g')"


@query("""WITH p AS (SELECT a.conv_id, a.turn, regexp_replace(lower(a.text), '[^a-z ]', '', 'g')[1:300] AS x, regexp_replace(lower(b.text), '[^a-z ]', '', 'g')[1:300] AS y FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn, round(levenshtein(x, y) / nullif(length(x), 0), 9) AS cer, CASE WHEN length(x) > 250 THEN round(levenshtein(right(x, 100), right(y, 100)) / 100.0, 9) END AS tail FROM p""")
def cer_pairs(t):
    plain = F.substring(F.regexp_replace(F.lower("text"), "[^a-z ]", ""), 1, 300)
    a = t.conversations.select("conv_id", "turn", plain.alias("x"))
    b = t.conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), plain.alias("y"))
    n = F.char_length("x")
    return a.join(b, ["conv_id", "turn"]).select("conv_id", "turn", F.round(C.cer(F.col("x"), F.col("y")), 9).alias("cer"), F.round(C.tail_cer(F.col("x"), F.col("y"), n, 100, 250), 9).alias("tail"))


def _pairs(t) -> DataFrame:
    a = t.conversations.select("conv_id", F.col("turn").alias("i"), F.col("text").alias("x"))
    b = t.conversations.select("conv_id", F.col("turn").alias("j"), F.col("text").alias("y"))
    return a.join(b, "conv_id").where("i < j")  # within a conversation alone


@query()
def near_clones(t):
    head = lambda c: F.lower(F.substring(c, 1, 80))
    return _pairs(t).select("conv_id", "i", "j", F.round(C.indel_ratio(head("x"), head("y")), 6).alias("heads"), (F.char_length("x") == F.char_length("y")).alias("same_length"))


@query()
def word_errors(t):
    return _pairs(t).where("j = i + 1").select("conv_id", "i", F.round(C.wer(F.col("x"), F.col("y")), 9).alias("wer"))


@query()
def term_presence(t):
    term = F.regexp_extract("text", r"(\p{L}{5,})", 1)
    twisted = F.concat(F.substring(term, 1, 4), F.lit("x"), F.substring(term, 6, 20))
    return t.conversations.where(term != "").select("conv_id", "turn", C.presence(term, F.col("text")).alias("own"), C.presence(twisted, F.col("text")).alias("twisted"))


@query()
def validate_texts(t):
    return t.conversations.select("conv_id", "turn", C.text_reason(F.col("text"), ALPHABET).alias("reason"))


@query("""SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id, text) > 1 AS repeated, sha256(trim(text)) IN (SELECT sha256(trim(text)) FROM documents) AS on_disk FROM conversations""")
def duplicate_texts(t):
    w = Window.partitionBy("conv_id", "text")
    seen = t.documents.select(C.text_hash(F.col("text")).alias("h"), F.lit(True).alias("seen")).distinct()
    rows = t.conversations.select("conv_id", "turn", (F.count("*").over(w) > 1).alias("repeated"), C.text_hash(F.col("text")).alias("h"))
    return rows.join(seen, "h", "left").select("conv_id", "turn", "repeated", F.coalesce("seen", F.lit(False)).alias("on_disk"))


@query("""WITH w AS (SELECT unnest(regexp_extract_all(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), '[a-z0-9]+')) AS w FROM benchmark) SELECT w, count(*) AS n FROM w GROUP BY 1""")
def token_counts(t):
    words = F.regexp_extract_all(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "), F.lit("[a-z0-9]+"), 0)
    return t.benchmark.select(F.explode(words).alias("w")).groupBy("w").agg(F.count("*").alias("n"))


@query()
def ngram_counts(t):
    words = rules.key_words(F.col("text"))
    keys = t.benchmark.select(F.array_join(F.slice(words, 1, 2), " ").alias("key")).union(t.benchmark.select(F.array_join(F.slice(words, 3, 3), " ").alias("key"))).where("key <> ''").distinct()
    return rules.ngram_counts(t.documents, "text", keys)


@query()
def mine_rules(t):
    words = F.filter(rules.key_words(F.col("text")), lambda w: F.char_length(w) > 5)
    target = t.documents.select(F.explode(F.slice(words, 1, 1)).alias("target"))  # cut once; a test for null would cut again
    evidence = target.select(F.regexp_replace("target", "^(...)", "$1y").alias("variant"), "target").groupBy("variant", "target").agg(F.count("*").alias("count")).withColumn("clips", F.col("count"))
    empty = t.spark.createDataFrame([], "word string, zipf double")
    return rules.mine(evidence, t.documents.select("text"), t.documents.select("text"), empty.select("word"), empty)


@query()
def apply_rules(t):
    return t.documents.select("doc_id", F.sha2(rules.fixed(F.col("text"), rules.build(RULES)), 256).alias("fixed"))


@query()
def merge_rules(t):
    merged = rules.merge_verified(rules.build(RULES), t.documents.select("text"), "text")
    return t.spark.createDataFrame([(k, r["replacement"], "|".join(r["variants"])) for k, r in enumerate(merged)], "rule_ord int, replacement string, variants string")


def _groups(t) -> DataFrame:
    return t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("row"), F.col("conv_id").alias("group_id"), F.when(F.col("conv_id") % 2 == 0, "atomic").otherwise("distribute").alias("group_mode"), (F.expr("(char_length(text) * 603 + 5) div 10") / 1000.0).alias("duration"))


@query()
def split_strict(t):
    return splitting.assign(_groups(t), RATIOS, "row")


@query()
def split_best_effort(t):
    return splitting.assign(_groups(t), RATIOS, "row", strict=False)


@query()
def split_summary(t):
    rows = _groups(t)
    return splitting.summary(rows.join(splitting.assign(rows, RATIOS, "row", stratify=False), "row")).select("split", "n", F.round("total", 3).alias("total"), F.round("n_percent", 6).alias("n_percent"), F.round("total_percent", 6).alias("total_percent"))


@query("SELECT p_partkey, split_part(p_name, ' ', 1) AS base, string_agg(x, ' ' ORDER BY i) AS spoken FROM (SELECT p_partkey, p_name, unnest(range(1, length(p_brand) + 1)) AS i, unnest(string_split(p_brand, '')) AS x FROM part) GROUP BY 1, 2")
def pronunciations(t):
    return t.part.select("p_partkey", F.split("p_name", " ")[0].alias("base"), F.regexp_replace(C.default_pronunciation(F.col("p_brand")), r"(\d)(?=\d)", "$1 ").alias("spoken"))


@query("SELECT p_partkey, CAST(p_size AS DOUBLE) AS value, 'mg' AS unit FROM part")
def dosage_keys(t):
    text = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.col("p_size").cast("string"), F.lit(",00 MG"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".0 mg "))).otherwise(F.concat(F.col("p_size").cast("string"), F.lit("mg")))
    return t.part.select("p_partkey", C.dosage(text).alias("d")).select("p_partkey", F.col("d.value").cast("double").alias("value"), "d.unit")


@query()
def slugs(t):
    return t.pages.select("page_id", C.slug(F.col("url")).alias("slug"))


@query()
def align_defects(t):
    heard = F.concat(F.lit("voici donc "), F.regexp_replace("text", r"^(\S+ \S+ )\S+ \S+ \S+ \S+ \S+ \S+ ", "$1"))
    return t.conversations.select("conv_id", "turn", F.array_join(C.defects(F.col("text"), heard, F.lit("")), ";").alias("defects"))
