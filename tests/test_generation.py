"""Planning, providers, the ledger and review decisions."""

from pyspark.sql import functions as F

from lexispark.operators import generation as G


def test_plan_and_run(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    terms = spark.createDataFrame([(1, "9"), (2, "3"), (3, "x"), (4, "9"), (5, "0")], "index long, score string")
    done = spark.createDataFrame([(4,), (4,)], "index long")
    left = G.plan(terms, [(8, 10, 2), (1, 7, 1)], done)
    assert {(r["index"], r.left_to_do) for r in left.collect()} == {(1, 2), (2, 1)}
    assert [r["index"] for r in G.bad_scores(terms).collect()] == [3]
    answers = spark.createDataFrame([(1, 1, "<t>bad</t>"), (1, 2, "<think>x</think><t> deux  mots</t><t>5 mg/L</t>"), (2, 1, "<t>bien dit</t>")], "key long, attempt int, answer string")
    pending = left.select(F.col("index").alias("key"))
    kept, failed = G.run(pending, G.Replay(answers), lambda attempt, last: F.concat_ws(" ", attempt.cast("string"), last), lambda a: F.when(F.contains("answer", F.lit("bad")), "bad"))
    assert {(r.key, r.attempt) for r in kept.collect()} == {(1, 2), (2, 1)} and failed.count() == 0
    assert {(r.key, r.variant_index, r.target, r.source) for r in G.rows(kept).collect()} == {(1, 0, "deux mots", "deux mots"), (1, 1, "5 mg/L", "5 milligrammes par litre"), (2, 0, "bien dit", "bien dit")}


def test_unanswered_keys_fail(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    kept, failed = G.run(spark.createDataFrame([(1,)], "key long"), G.Replay(spark.createDataFrame([], "key long, attempt int, answer string")), lambda a, b: F.lit("p"), lambda a: F.lit(None).cast("string"))
    assert kept.count() == 0 and [tuple(r) for r in failed.collect()] == [(1, G.ATTEMPTS, "not recorded")]


def test_ledger(spark):
    calls = spark.createDataFrame([(100, 50, 0.3)] * 4, "prompt_tokens long, answer_tokens long, cost double")
    planned = spark.createDataFrame([(100,), (200,)], "prompt_tokens long")
    r = G.ledger(calls, planned).first()
    assert (r.calls, r.left_tokens, round(r.left_cost, 6)) == (4, 400.0, round(400 * 1.2 / 600, 6))
    assert G.ledger(calls.limit(1), planned).first().left_tokens == 300 * 1.15 + 2 * 1500


def test_reviews(spark):
    terms = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "term_index long, term string")
    review = spark.createDataFrame([(1, "b"), (2, "b"), (3, ""), (9, "z"), (3, "d")], "term_index long, proposed string")
    got = {(r.term_index, r.proposed): r.action for r in G.classify_review(review, terms).collect()}
    assert got == {(1, "b"): "drop", (2, "b"): "keep", (3, ""): "drop", (9, "z"): "skip", (3, "d"): "rename"}
    left = G.fix_terms({"terms": terms}, G.classify_review(review, terms))["terms"]
    assert [r.term_index for r in left.collect()] == [2]


def test_reviews_of_a_common_name_make_as_many_rows_as_reviews(spark):
    """A name of many terms is met once by each review, and its first other owner is told."""
    terms = spark.range(3000).select(F.col("id").alias("term_index"), F.lit("a").alias("term"))
    review = terms.withColumnRenamed("term", "proposed").union(spark.createDataFrame([(7, "b")], "term_index long, proposed string"))
    out = G.classify_review(review, terms.union(spark.createDataFrame([(3000, "b"), (3000, "b"), (None, "b")], "term_index long, term string")))
    got = {(r.term_index, r.proposed): (r.action, r.owner) for r in out.collect()}
    assert len(got) == 3001 and got[0, "a"] == ("keep", 1) and got[1, "a"] == ("keep", 0) and got[7, "b"] == ("drop", 3000)
    joins, todo = [], [out._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        name, children = node.nodeName(), node.children()
        if "Join" in name:
            joins.append(node.metrics().apply("numOutputRows").value())
        todo += [node.plan()] if name.endswith("QueryStage") else [children.apply(k) for k in range(children.length())]
    assert joins and max(joins) <= 3001, joins


def test_prompt_and_responses(spark):
    r = spark.range(1).select(G.prompt([("a", F.lit("x")), ("b", F.lit(None).cast("string")), ("c", F.lit("y"))]).alias("p"), G.response_reason(F.lit("length"), F.lit("x")).alias("l"), G.response_reason(F.lit("stop"), F.lit(" ")).alias("e"), G.response_reason(F.lit("stop"), F.lit("x")).alias("f")).first()
    assert (r.p, r.l, r.e, r.f) == ("<a>x</a>\n<c>y</c>", "truncated", "empty", None)
