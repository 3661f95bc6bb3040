"""Every registered query against its SQL in DuckDB, on small tables made here."""

import datetime
import decimal
import json
import math
import random

import duckdb
import pytest

import __spark_entry__
from lexispark.plans import ORACLES, QUERIES

WORDS = "small large thin ring rod bolt plate gear wheel spring".split()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base, rng = str(tmp_path_factory.mktemp("tables")), random.Random(11)
    say = lambda n: " ".join(rng.choice("le la the of kan loto élan Mira zura trente; fin: bloc.".split()) for _ in range(n))
    text = lambda: "\n".join(say(rng.randint(1, 14)).capitalize() + rng.choice([".", "?", "", "..."]) for _ in range(rng.randint(1, 6)))
    docs = [(k, t := text(), rng.choice(["en", "fr", "de", "es"]), f"src{k % 5}", len(t)) for k in range(150)]
    docs += [(150 + k, docs[k][1], docs[k][2], f"src{(k + 1) % 5}", docs[k][4]) for k in range(0, 40, 3)]
    start = datetime.datetime(2024, 1, 1)
    rows = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(k, k % 2, int(k % 9 == 0)) for k in range(0, 150, 2)], "doc_id long, quality int, toxic int"),
        "benchmark": ([(k, docs[k * 3][1][:80]) for k in range(10)], "item_id long, text string"),
        "conversations": ([(c, t, rng.choice(["user", "assistant"]), text()) for c in range(15) for t in range(rng.randint(1, 5))], "conv_id long, turn long, role string, text string"),
        "pages": ([(k, f"http://host{k % 4}.example.com/fr/{k}/Pàge-{k}?q=x", "<p>x</p>") for k in range(20)], "page_id long, url string, html string"),
        "events": ([(k, start + datetime.timedelta(seconds=rng.randint(0, 90_000)), rng.randint(0, 30), rng.choice(["click", "view", "purchase", "error", "signup"]), float(rng.randint(0, 4000)) / 100, json.dumps({"k": rng.randint(0, 9)})) for k in range(900)], "event_id long, ts timestamp, user_id long, event_type string, value double, props string"),
        "part": ([(k, f"{rng.choice(WORDS)} {rng.choice(WORDS)}", f"Brand#{k % 6}", rng.choice(["ECONOMY", "STANDARD", "LARGE"]), rng.randint(1, 50), 900.0 + k) for k in range(200)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "lineitem": ([(k // 3, rng.randrange(210), 1, k % 3, float(rng.randint(1, 50)), 10.0, 0.0, 0.0, rng.choice("ANR"), "F", start) for k in range(900)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "customer": ([(k, f"C{k}", k % 5, float(rng.randint(-500, 900)), rng.choice(["BUILDING", "HOUSEHOLD"])) for k in range(1, 80)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{base}/{name}.parquet")
    return base


def same(v):
    if isinstance(v, (float, decimal.Decimal)):
        return None if math.isnan(v) else float(f"{float(v):.8g}")
    if isinstance(v, (bool, int)):
        return float(v)
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v


def sorted_rows(columns, rows):
    at = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(same(r[k]) for k in at) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, tables)
    got = sorted_rows(df.columns, df.collect())
    if name not in ORACLES:
        return
    db = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations", "pages", "events", "part", "lineitem", "customer"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    db.execute("SET TimeZone = 'UTC'")
    want = db.sql(ORACLES[name])
    assert sorted(want.columns) == sorted(df.columns)
    assert got == sorted_rows(want.columns, want.fetchall())


def test_queries_read_whole_texts_and_all_ids(spark, tmp_path):
    long = "alpha beta gamma " * 40
    spark.createDataFrame([(1, 1, "user", long + "delta."), (1, 2, "user", long + "omega.")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(k, f"xx zyxwvu{'abcde'[k % 5]} here") for k in range(100, 105)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: QUERIES[name](spark, str(tmp_path)).collect()
    assert run("word_errors")[0].wer > 0
    assert len(run("casing_lexicon")) == 5
    assert len(run("mine_rules")) == 5


def test_entry_registers_everything():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
