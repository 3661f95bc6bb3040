"""The pipeline's stages, each held against what it must do on its own input."""

import random

import corpus_pipeline as C
from lexispark.llm import contamination, neardup

from .test_operators import brute_components, brute_windows, prose

BAD = ["vexor", "grunfeld", "trazzik"]


def test_stages(spark, tmp_path):
    rng = random.Random(6)
    texts = [prose(rng, 60) for _ in range(60)]
    texts += [f"{texts[k]} {' '.join(rng.choice(BAD) for _ in range(4))}" for k in range(20)] + [texts[0], None, ""]
    texts += [" ".join(prose(rng, 80).split()) + " " + x for x in ("alpha", "beta")]
    near = prose(rng, 90)
    texts += [near, near + " tail"]
    item = " ".join(prose(rng, 30).split())
    texts.append(item + " " + prose(rng, 20))
    texts.append(" ".join(item.split()[2:18]) + " " + " ".join(f"own{k}" for k in range(900)))  # a small share of a long text
    docs = [(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    toxic = {k for k, t in enumerate(texts) if any(b in (t or "") for b in BAD)}
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    at, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in C.STAGES:
        before = {r.doc_id: r.text for r in at.collect()}
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/out/{name}")
        at = spark.read.parquet(f"{tmp_path}/out/{name}")
        seen[name] = before, at.collect()
        if name != "encode":
            assert at.columns == C.COLUMNS
    before, after = seen["toxicity"]
    assert {r.doc_id for r in after} == set(before) - toxic
    before, after = seen["line_dedup"]
    assert {r.doc_id for r in after} == set(before)
    lines = [x for r in after for x in (r.text or "").split("\n") if len(x.split()) > 1]
    assert len(lines) == len(set(lines)) and all(r.n_chars == (None if r.text is None else len(r.text)) for r in after)
    before, after = seen["near_dedup"]
    label = brute_components(list(before.items()))
    assert {r.doc_id for r in after} == {i for i, (_, c) in label.items() if c == i}
    before, after = seen["decontamination"]
    hit = {x[0] for x in brute_windows(list(before.items()), [(1, item)]) if x[2]}
    assert hit and {r.doc_id for r in after} == set(before) - hit
    before, after = seen["encode"]
    assert {r.doc_id for r in after} == set(before) and all(r.n_tokens == len(r.ids) for r in after)
    assert C.run(spark, str(tmp_path)).count() == len(after)


def test_constants():
    assert (neardup.SHINGLE, neardup.PERCENT, contamination.WINDOW) == (5, 75, 13)
