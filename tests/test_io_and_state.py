"""Sources and sinks round trips, streams, and the state machine row by row."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from lexispark.functions import columns as C
from lexispark.operators import cleaning, relational, rules, splitting
from lexispark.sources import readers, writers
from lexispark.streaming import state


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": "a", "v": 1}\n{"k": "b", "v": 2}\n{"k": "a", "v": 3}\n{"k": "b", "v"')
    path = str(tmp_path / "a.jsonl")
    assert readers.json_lines(spark, path, "k string, v int", strict=False).count() == 3
    assert {(r.k, r.v) for r in readers.json_lines_keyed(spark, path, "k string, v int", ["k"]).collect()} == {("a", 3), ("b", 2)}
    with pytest.raises(Exception):
        readers.json_lines(spark, path, "k string, v int").collect()
    df = spark.createDataFrame([('{"a": null}',), ("{}",)], "raw string")
    assert [r.has_a for r in readers.with_presence(df, "raw", ["a"]).collect()] == [True, False]
    assert [r["index"] for r in readers.positional_index(spark.createDataFrame([(None, "x"), (7, "y")], "index long, t string")).collect()] == [0, 7]


def test_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n")
    path = str(tmp_path / "a.csv")
    assert readers.delimited(spark, path, ["x", "y"]).first().y == "2"
    with pytest.raises(ValueError):
        readers.delimited(spark, path, ["x", "z"])
    writers.delimited(readers.delimited(spark, path), str(tmp_path / "out"))
    assert readers.delimited(spark, str(tmp_path / "out")).count() == 1
    assert spark.range(1).select(readers.decimal_comma(F.lit("1 234,5"))).first()[0] == 1234.5


def test_workbook(spark, tmp_path):
    raw = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>cod_ucd</t></si><si><t>nom</t></si></sst>")
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {ns}><sheetData><row><c r="A1"><v>9</v></c></row><row><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c></row><row><c r="A3"><v>5</v></c></row><row><c r="C4" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>')
    (tmp_path / "a.xlsx").write_bytes(raw.getvalue())
    df = readers.workbook(spark, str(tmp_path / "a.xlsx"), "cod_ucd", 2)
    assert df.columns == ["cod_ucd", "c1", "nom"] and [tuple(r) for r in df.collect()] == [("5", None, None), (None, None, "x")]


def test_clips(spark, tmp_path):
    head = b"fLaC" + b"\0" * 14 + ((16000 << 44) | (1 << 41) | (15 << 36) | 32000).to_bytes(8, "big")
    for name in ("000012_0003_word.flac", "000012_0003_again.flac", "noise.flac"):
        (tmp_path / name).write_bytes(head)
    got = readers.clips(spark, str(tmp_path)).collect()
    assert [(r.term_index, r.variant_index, r.slug) for r in got] == [(12, 3, "again")]
    seconds = spark.createDataFrame([(bytearray(head),), (bytearray(b"x"),)], "c binary").select(readers.flac_seconds(F.col("c")).alias("s"))
    assert [r.s for r in seconds.collect()] == [2.0, None]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(f"c/{k}.flac", 1.23456, f"t {k}", "train" if k % 3 else "val", "a" if k < 7 else "b") for k in range(10)], "audio_filepath string, duration double, text string, split string, category string")
    writers.splits(rows, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m/full")).agg(F.max("duration")).first()[0] == 1.235
    assert spark.read.json(str(tmp_path / "m/splits/split=val")).count() == 4
    writers.parquet_shards(rows, str(tmp_path / "p"), "category", per=3)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 10
    out, dropped, changed = writers.rewrite(rows, F.col("split") == "val", {"text": F.upper("text")}, str(tmp_path / "r"), apply=True)
    assert (out.count(), dropped, changed) == (6, 4, 6) and spark.read.json(str(tmp_path / "r")).count() == 6
    kept = writers.side_outputs(rows, F.when(F.col("split") == "val", "held"), str(tmp_path / "s"))
    assert kept.count() == 6 and spark.read.json(str(tmp_path / "s")).count() == 4
    assert writers.markdown(rows.limit(1), "One").count("|") > 10


def test_state_machine(spark):
    columns = "status string, bad boolean, accepted boolean, drafts int, tried int, wanted int, rescore boolean, retry boolean"
    cases = {
        "both": [(("none", True, True, 0, 0, 2, False, False), "improved"), (("none", True, False, 0, 0, 2, False, False), "exhausted"), (("none", False, False, 0, 0, 2, False, False), "none")],
        "stt": [(("none", True, False, 0, 0, 2, False, False), "pending_tts"), (("pending_stt", True, True, 1, 1, 2, False, False), "pending_tts"), (("pending_stt", True, True, 2, 2, 2, False, False), "improved"), (("pending_stt", True, False, 2, 2, 2, False, False), "exhausted"),
                (("pending_tts", False, False, 0, 0, 2, True, False), "none"), (("pending_tts", True, False, 0, 0, 2, True, False), "pending_tts"), (("exhausted", False, False, 0, 0, 2, False, True), "none"), (("exhausted", True, False, 0, 0, 2, True, True), "pending_tts"),
                (("exhausted", True, False, 0, 0, 2, False, False), "exhausted"), (("improved", True, False, 0, 0, 2, True, True), "improved")],
        "tts": [(("pending_tts", True, False, 1, 0, 2, False, False), "pending_stt"), (("pending_tts", True, False, 0, 0, 2, False, False), "exhausted"), (("pending_stt", True, False, 0, 0, 2, False, False), "pending_stt")],
    }
    for step, rows in cases.items():
        got = spark.createDataFrame([r for r, _ in rows], columns).coalesce(1).select(state.next_status(step)).collect()
        assert [r[0] for r in got] == [to for _, to in rows], step


def test_resumed_stream(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    for batch in ([(1, 5, "a"), (2, 5, "b")], [(1, 6, "c"), (1, 4, "old")]):
        spark.createDataFrame(batch, "k long, at long, v string").write.mode("append").parquet(source)
        stream = spark.readStream.schema("k long, at long, v string").parquet(source)
        state.resume(stream, state.upsert(table, "k", "at"), str(tmp_path / "ck")).awaitTermination()
    last = spark.read.parquet(f"{table}/v=1")
    assert {(r.k, r.v) for r in last.collect()} == {(1, "c"), (2, "b")}


def test_windows_in_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:00:10", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 02:00:00", "a", 4.0)], "t string, event_type string, value double").select(F.to_timestamp("t").alias("ts"), "event_type", "value")
    rows.write.parquet(str(tmp_path / "e"))
    stream = state.tumbling(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e")))
    q = stream.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.n for r in spark.table("windows").collect()) == [1, 2]


def test_converge(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    start = spark.createDataFrame([("a", "open", 3), ("b", "open", 1)], "k string, status string, left int")
    step = lambda s: s.withColumn("left", F.col("left") - 1).withColumn("status", F.when(F.col("left") - 1 > 0, "open").otherwise("closed"))
    assert state.converge(start, step, ["open"], 10)[1] == "done"
    assert state.converge(start, lambda s: s, ["open"], 10)[1] == "dry"


def test_ledger_adds_up(spark):
    docs = spark.createDataFrame([(1, "Une phrase complète et bien assez longue pour rester.\n\nEncore une phrase qui suit directement.\nsans fin\nSeule."), (2, None), (3, "")], "doc_id long, text string")
    lines = cleaning.lines(docs, "doc_id", "text")
    blocks = cleaning.blocks(lines)
    assert {r.bucket for r in cleaning.ledger(lines, blocks).collect()} >= {"raw", "kept", "line_too_short"}
    assert blocks.where("reason is null").first().text.endswith("directement.")
    assert spark.range(1).select(C.respace(F.lit("fin.Le mot,5 .FLAIR"))).first()[0] == "fin. Le mot,5 .FLAIR"


def test_split_keeps_groups(spark):
    rows = spark.createDataFrame([(k, f"g{k // 3}", "atomic" if k % 2 else "atomic", float(1 + k % 7)) for k in range(180)], "row long, group_id string, group_mode string, duration double")
    out = rows.join(splitting.assign(rows, splitting.parse_ratios("80/10/10"), "row"), "row")
    assert out.groupBy("group_id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert out.select("split").distinct().count() == 3 and out.count() == 180


def test_range_policy_refuses_overlaps(spark):
    with pytest.raises(ValueError):
        relational.range_policy(spark.range(3), "id", [(0, 5, 1), (5, 9, 2)])


def test_mining_reads_evidence_and_texts_once(spark, tmp_path):
    """What mining gives reads no table any more, and labels that are the hypotheses too are counted once."""
    texts = ["alphab is real text", "gammaz et gammax", "deltay deltay deltay", "epsilo a le soir"]
    spark.createDataFrame([(x,) for x in texts], "text string").write.parquet(f"{tmp_path}/texts")
    spark.createDataFrame([("alphab", "alphax", 2, 2), ("gammaq", "gammax", 3, 2), ("deltay", "deltax", 1, 1)], "variant string, target string, count long, clips long").write.parquet(f"{tmp_path}/evidence")
    words = spark.createDataFrame([], "word string, zipf double")
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    out = rules.mine(read("evidence"), read("texts"), read("texts"), words.select("word"), words)
    assert {r.key: (r["count"], r.precision, r.reason) for r in out.collect()} == {"alphab": (2, 2.0, "real_text"), "gammaq": (3, 1.0, None), "deltay": (1, 0.333, "real_text")}
    assert "FileScan" not in out._jdf.queryExecution().toString()
    other = rules.mine(read("evidence"), read("texts"), read("texts").where("text <> ''"), words.select("word"), words)
    assert sorted(map(tuple, other.collect())) == sorted(map(tuple, out.collect()))
