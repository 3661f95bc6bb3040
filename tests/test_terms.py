"""Terms, lines and recogniser outcomes on hand-made cases."""

import pytest
from pyspark.sql import functions as F

from lexispark.functions import terms
from lexispark.operators import outcomes as O


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Bowen (maladie de) multicentrique", "maladie de Bowen multicentrique"), ("apnée (seuil d'", "seuil d'apnée"), ("coeur (le)", "le coeur"), ("débit de repos (", "débit de repos"), ("CD4+", "CD4 plus"), ("T2*", "T2 étoile"), ("« mot » Doliprane®", "mot Doliprane"), ("os", "os")],
)
def test_normalised_terms(spark, raw, want):
    assert spark.range(1).select(terms.normalised_term(F.lit(raw))).first()[0] == want


def test_sayable_and_tails(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert not one(terms.is_sayable(F.lit("a → b"))) and not one(terms.is_sayable(F.lit("a (b)"))) and one(terms.is_sayable(F.lit("foie")))
    assert one(terms.without_tail(F.lit("anémie n. f."))) == "anémie"
    assert one(terms.without_tail(F.lit("scanner sigle angl. pour x"))) == "scanner"


def test_lines(spark):
    one = lambda x: spark.range(1).select(terms.raw_line(F.lit(x))).first()[0]
    assert one("Masse (a (b)) de 3x4 cm, 37° , 3+3.Suite < 5 > à 2") == "Masse de 3 fois 4 cm, 37 degrés, 3 plus 3. Suite inférieur à 5 supérieur à 2"
    assert one("1g*3/j et 20*16 x") == "1g fois 3/j et 20 fois 16 x"


def test_needles(spark):
    assert terms.needle("CODÉINE EN ASSOCIATION") == "codeine" and terms.needle("ASSOCIATIONS") == ""
    assert terms.needle("Codéine et paracétamol") == "codeine + paracetamol"
    df = spark.createDataFrame([("ASSOCIATIONS", ["TENOFOVIR", "tenofovir", None]), ("X", None)], "t string, s array<string>")
    assert [r[0] for r in df.select(terms.needles(F.col("t"), F.col("s"))).collect()] == [["tenofovir"], []]


def test_outcomes():
    lex = frozenset({"mirtazapine", "venlafaxine", "fluoxetine"})
    got = lambda a, b: [(o["variant"], o["target"]) for o in O.outcomes(a, b, lex)]
    assert got("prend mirtazapine le soir", "prend myrtazapine le soir") == [("myrtazapine", "mirtazapine")]
    assert got("prend mirtazapine le soir", "prend le soir") == [("", "mirtazapine")]
    assert got("prend Mirtazapine", "prend mirtazapine") == [(None, "mirtazapine")]
    assert got("sous fluoxétine ce soir", "soufflue oxétine ce soir") == [("soufflue oxétine", "sous fluoxétine")]
    assert got("prend mirtazapine", "prend unk zapine") == [] and got("rien", "rien") == []


def test_report(spark):
    pairs = spark.createDataFrame([("la mirtazapine", "la myrtazapine"), ("la mirtazapine", "la mirtazapine"), ("la mirtazapine", "la"), (None, None)], "text string, hyp string")
    r = O.report(pairs, "text", "hyp", frozenset({"mirtazapine"}))
    row = r.first()
    assert (row.n_seen, row.n_correct, row.n_deleted, row.errors, row.targets) == (3, 1, 1, {"myrtazapine": 1}, {"myrtazapine": "mirtazapine"})
    m = O.merged([r, r]).first()
    assert (m["count"], m.clips) == (2, 1)
    h = spark.createDataFrame([("x/a/1.flac", "old", 1), ("y/a/1.flac", "new", 2)], "audio string, hyp string, line int")
    f = spark.createDataFrame([("z/a/1.flac", "first", 1), ("a/1.flac", "second", 2)], "audio_filepath string, text string, line int")
    assert [tuple(x) for x in O.pair_up(h, f).collect()] == [("a/1.flac", "new", "first")]
