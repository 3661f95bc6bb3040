"""Drug, validation, state, source and sink queries, hosted on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import terms
from ..operators import drugs, generation, outcomes, validators
from ..streaming import state
from .registry import query


def records(t) -> DataFrame:
    """part as medicine records: a composition of its type and name, presentations of its key."""
    words = F.split("p_name", " ")
    component = F.struct(F.when(F.col("p_size") % 11 == 0, "solution").otherwise("comprimé").alias("elementPharmaceutique"), F.when(F.col("p_size") % 7 == 0, F.concat(F.lit("SULFATE DE "), "p_type")).otherwise(words[0]).alias("denominationSubstance"), F.concat(F.col("p_size").cast("string"), F.lit(" mg")).alias("dosage"))
    return t.part.select(
        F.col("p_partkey").alias("cis"), F.upper("p_name").alias("elementPharmaceutique"), F.when(F.col("p_size") % 2 == 0, "comprimé pelliculé (sécable)").when(F.col("p_size") % 3 == 0, "gélule").otherwise("poudre").alias("formePharmaceutique"),
        F.when(F.col("p_size") % 5 == 0, "Archivée").otherwise("Autorisation active").alias("statusAutorisation"), F.lit("Commercialisée").alias("etatComercialisation"), F.array(component).alias("composition"),
        F.array(F.struct(F.col("p_partkey").alias("cip13"), F.col("p_retailprice").alias("prix"))).alias("presentation"))


@query("""WITH r AS (SELECT p_partkey AS cis, CASE WHEN p_size % 2 = 0 THEN 'comprimé pelliculé' WHEN p_size % 3 = 0 THEN 'gélule' ELSE 'poudre' END AS form, CASE WHEN p_size % 7 = 0 THEN 'SULFATE DE ' || p_type ELSE upper(split_part(p_name, ' ', 1)) END AS s, p_size FROM part)
SELECT cis, form FROM r WHERE p_size % 5 <> 0 AND form <> 'poudre' AND p_size % 11 <> 0 AND p_size % 7 <> 0""")
def active_records(t):
    return drugs.active_records(records(t)).select("cis", F.col("formePharmaceutique").alias("form"))


@query("SELECT lpad(p_partkey::VARCHAR, 13, '0') AS cip13, upper(p_name) AS drug_name FROM part")
def presentation_index(t):
    return drugs.index_presentations(records(t)).select("cip13", "drug_name")


@query("""WITH v AS (SELECT DISTINCT upper(split_part(p_name, ' ', 1)) AS word FROM part WHERE p_size = 50 AND length(split_part(p_name, ' ', 1)) > 3), b AS (SELECT upper(p_name) AS brand, p_type, p_retailprice AS v FROM part)
SELECT brand, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS substances, round(sum(v), 4) AS volume FROM b WHERE NOT EXISTS (SELECT 1 FROM v WHERE contains(brand, word)) GROUP BY 1""")
def brand_volumes(t):
    vocabulary = drugs.molecule_words(t.part.where("p_size = 50").select(F.split("p_name", " ")[0].alias("n")), "n")
    sales = t.part.select(F.upper("p_name").alias("name"), "p_type", "p_retailprice")
    return drugs.by_brand(sales, "name", "p_type", "p_retailprice", vocabulary).select("brand", F.array_join("substances", "|").alias("substances"), F.round("p_retailprice", 4).alias("volume"))


@query()
def dosage_dedupe(t):
    n = F.col("p_size").cast("string")
    doses = F.array(F.lit("comprimé"), F.concat(n, F.lit(" mg")), F.concat(n, F.lit(",00 mg")), F.lit(" "), F.concat(n, F.lit(" g")), F.lit("1 000 mg"), F.lit("1000,0 mg"), F.lit("à volonté"))
    return t.part.select("p_partkey", F.array_join(drugs.distinct_dosages(doses), "|").alias("dosages"))


@query("""SELECT substance, string_agg(form || ':' || x, ';' ORDER BY form) AS forms FROM (SELECT p_brand AS substance, p_type AS form, string_agg(r || '=' || d, ',' ORDER BY r) AS x FROM (SELECT p_brand, p_type, r, string_agg(d, '+' ORDER BY d) AS d FROM (SELECT DISTINCT p_brand, p_type, split_part(p_name, ' ', 1) AS r, p_size::VARCHAR AS d FROM part) GROUP BY 1, 2, 3) GROUP BY 1, 2) GROUP BY 1""")
def nested_dosages(t):
    rows = t.part.select(F.col("p_brand").alias("substance"), F.col("p_type").alias("form"), F.split("p_name", " ")[0].alias("reference"), F.col("p_size").cast("string").alias("dosage"))
    flat = lambda m, sep, f: F.array_join(F.array_sort(F.transform(F.map_entries(m), f)), sep)
    inner = lambda r: flat(r, ",", lambda e: F.concat_ws("=", e["key"], F.array_join(e["value"], "+")))
    return drugs.nested_dosages(rows).select("substance", flat("forms", ";", lambda e: F.concat_ws(":", e["key"], inner(e["value"]))).alias("forms"))


@query()
def terms_with_dosages(t):
    doses = drugs.nested_dosages(t.part.where("p_size > 40").select(F.col("p_type").alias("substance"), F.lit("comprimé").alias("form"), F.col("p_brand").alias("reference"), F.col("p_size").cast("string").alias("dosage")))
    terms = t.part.select(F.col("p_name").alias("term"), F.array("p_type").alias("s")).groupBy("term").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("s")))).alias("substances"))
    return drugs.with_dosages(terms, doses).select("term", F.coalesce(F.size("dosages"), F.lit(0)).alias("n"))


@query()
def casing_lexicon(t):
    names = t.documents.select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}{5,}"), 0)).alias("word")).distinct()
    return drugs.casing_lexicon(t.documents, "text", names)


@query()
def validate_batches(t):
    return validators.validate(t.conversations.select("conv_id", "text"), "conv_id", "text")


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'c_mktsegment' ELSE '' END AS missing FROM customer")
def required_fields(t):
    rows = t.customer.withColumn("c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).otherwise(" "))
    return validators.problems(rows, ["c_name", "c_mktsegment"]).select("c_custkey", F.array_join("missing", ",").alias("missing"))


_STATE = """SELECT event_id, CASE event_type WHEN 'click' THEN 'none' WHEN 'view' THEN 'pending_tts' WHEN 'purchase' THEN 'pending_stt' WHEN 'error' THEN 'exhausted' ELSE 'improved' END AS status,
value > 20 AS bad, user_id % 2 = 0 AS accepted, CAST(user_id % 3 AS INTEGER) AS drafts, CAST(user_id % 4 AS INTEGER) AS tried, 2 AS wanted, user_id % 5 = 0 AS rescore, user_id % 7 = 0 AS retry FROM events"""


def _next(step: str) -> str:
    cases = " ".join(f"WHEN status = '{a}' AND ({c}) THEN '{b}'" for a, at, c, b in state.TRANSITIONS if at in ("*", step))
    return f"SELECT event_id, CASE {cases} ELSE status END AS status FROM ({_STATE})"


def _state(t) -> DataFrame:
    kinds = F.create_map(*[F.lit(x) for p in (("click", "none"), ("view", "pending_tts"), ("purchase", "pending_stt"), ("error", "exhausted")) for x in p])
    u = F.col("user_id")
    return t.events.select("event_id", F.coalesce(F.element_at(kinds, F.col("event_type")), F.lit("improved")).alias("status"), (F.col("value") > 20).alias("bad"), (u % 2 == 0).alias("accepted"), (u % 3).cast("int").alias("drafts"), (u % 4).cast("int").alias("tried"), F.lit(2).alias("wanted"), (u % 5 == 0).alias("rescore"), (u % 7 == 0).alias("retry"))


@query(_next("stt"))
def state_after_stt(t):
    return _state(t).select("event_id", state.next_status("stt").alias("status"))


@query(_next("tts"))
def state_after_tts(t):
    return _state(t).select("event_id", state.next_status("tts").alias("status"))


@query(f"SELECT status, count(*) AS n FROM ({_STATE}) GROUP BY 1")
def pending_counts(t):
    return _state(t).groupBy("status").agg(F.count("*").alias("n"))


@query("""WITH b AS (SELECT user_id, event_id AS nth, value AS cer, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(value >= 5, false), coalesce(value, 'inf'::DOUBLE), event_id) AS k FROM events)
SELECT user_id, nth, cer, cer < 5 OR cer <= 8 - 0.02 AS accepted FROM b WHERE k = 1""")
def accepted_draws(t):
    draws = t.events.select("user_id", F.col("event_id").alias("nth"), F.col("value").alias("cer"), F.lit(None).cast("double").alias("tail"))
    originals = t.events.select("user_id").distinct().withColumn("cer", F.lit(8.0))
    return state.accepted(draws, "user_id", originals, 5.0, -1.0).select("user_id", "nth", "cer", "accepted")


@query("SELECT time_bucket(INTERVAL '30 minutes', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_windows(t):
    return state.tumbling(t.events, "30 minutes").withColumn("total", F.round("total", 4))


@query("""SELECT w AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT *, unnest([time_bucket(INTERVAL '30 minutes', ts), time_bucket(INTERVAL '30 minutes', ts) - INTERVAL '30 minutes']) AS w FROM events) GROUP BY 1, 2""")
def sliding_windows(t):
    return state.tumbling(t.events, "1 hour", slide="30 minutes").withColumn("total", F.round("total", 4))


@query()
def sanitised_definitions(t):
    text = F.concat(F.lit("Lésion (« "), F.col("p_name"), F.lit(" »); dose 3 µg/L — 37° , , fin ."))
    return t.part.select("p_partkey", C.sanitised(text).alias("definition"))


@query()
def parsed_blocks(t):
    raw = F.concat(F.lit("<think>plan\n<t>no</t></think><t> "), F.col("p_name"), F.lit("\n x</t> <t>"), F.col("p_type"), F.lit("</t><score>grade: "), F.col("p_size").cast("string"), F.lit("</score>"))
    text = C.without_reasoning(raw)
    return t.part.select("p_partkey", F.array_join(C.blocks(text), "|").alias("blocks"), C.tagged_score(text).alias("score"))


@query()
def term_outcomes(t):
    heard = F.regexp_replace("p_name", "r", "l")
    pairs = t.part.select("p_name", heard.alias("hyp"))
    found = outcomes.report(pairs, "p_name", "hyp", frozenset({"ring", "rod", "small", "large", "spring", "gear", "red"}))
    return found.select("key", "n_seen", "n_correct", "n_deleted", "n_errors")


@query()
def normalised_terms(t):
    raw = F.concat(F.split("p_name", " ")[1], F.lit(" (maladie de) "), F.split("p_name", " ")[0], F.lit("+"))
    return t.part.select("p_partkey", terms.normalised_term(raw).alias("term"), terms.is_sayable(raw).alias("sayable"))


@query("SELECT p_partkey, 'Masse de ' || p_size || ' fois 4 cm, 37 degrés, 3 plus 3. Suite inférieur à ' || p_size AS line FROM part")
def raw_lines(t):
    n = F.col("p_size").cast("string")
    return t.part.select("p_partkey", terms.raw_line(F.concat(F.lit("Masse (vue (ici)) de "), n, F.lit("x4 cm, 37° , 3+3.Suite < "), n)).alias("line"))


@query("SELECT p_partkey, 'anémie ' || p_type AS term FROM part")
def terms_without_tails(t):
    return t.part.select("p_partkey", terms.without_tail(F.concat(F.lit("anémie "), "p_type", F.lit(" n. f."))).alias("term"))


@query("""WITH w AS (SELECT p_partkey AS index, p_size // 5 AS score, CASE WHEN p_size // 5 BETWEEN 8 AND 10 THEN 3 WHEN p_size // 5 BETWEEN 3 AND 7 THEN 1 ELSE 0 END AS wanted FROM part), d AS (SELECT l_partkey AS index, count(*) AS have FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT index, wanted - coalesce(have, 0) AS left_to_do FROM w LEFT JOIN d USING (index) WHERE wanted > 0 AND wanted - coalesce(have, 0) > 0""")
def planned_variants(t):
    rows = t.part.select(F.col("p_partkey").alias("index"), F.expr("p_size div 5").cast("string").alias("score"))
    done = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("index"))
    return generation.plan(rows, [(8, 10, 3), (3, 7, 1)], done).select("index", "left_to_do")


@query("""WITH r AS (SELECT p_partkey AS term_index, CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 4 = 1 THEN p_name ELSE p_name || '!' END AS proposed FROM part WHERE p_partkey % 3 = 0)
SELECT term_index, CASE WHEN proposed = '' THEN 'drop' WHEN proposed = p_name THEN 'keep' ELSE 'rename' END AS action FROM r JOIN part ON p_partkey = term_index""")
def review_actions(t):
    kind = F.col("p_size") % 4
    review = t.part.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("term_index"), F.when(kind == 0, "").when(kind == 1, F.col("p_name")).otherwise(F.concat("p_name", F.lit("!"))).alias("proposed"))
    return generation.classify_review(review, t.part.select(F.col("p_partkey").alias("term_index"), F.col("p_name").alias("term"))).select("term_index", "action")


@query("""SELECT count(*) AS calls, sum(l_quantity)::DOUBLE AS prompt_tokens, sum(l_linenumber)::DOUBLE AS answer_tokens, round(sum(l_extendedprice), 2) AS cost FROM lineitem""")
def call_ledger(t):
    calls = t.lineitem.select(F.col("l_quantity").alias("prompt_tokens"), F.col("l_linenumber").alias("answer_tokens"), F.col("l_extendedprice").alias("cost"))
    out = generation.ledger(calls, t.part.select(F.col("p_size").alias("prompt_tokens")))
    return out.select("calls", F.col("prompt_tokens").cast("double").alias("prompt_tokens"), F.col("answer_tokens").cast("double").alias("answer_tokens"), F.round("cost", 2).alias("cost"))
