"""Toxicity by cumulative-link ordinal regression on sparse word and stem features."""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._tables import lean, materialise, short_batches

WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
#: Besides itself a word has its beginnings of so many characters as features, as insults are inflected.
BEGINNINGS = (4, 5, 6, 7)
#: Labelled rows that the model is fitted on at most (those with the smallest hashes of doc_id), the features it keeps,
#: documents of the sample that one must be in, and standard errors by which it must be commoner in toxic ones.
ROWS, VOCABULARY, LEAST, APART = 12_000, 3_000, 5, 4.0
#: Words whose features a worker remembers.
REMEMBERED = 100_000
#: Severity grades 0 to GRADES - 1; a text whose expected severity reaches REJECT is toxic.
GRADES, REJECT = 4, 0.5
PASSES, RATE, LASSO = 600, 0.1, 1e-3


def features(word: bytes) -> list[str]:
    text = word.decode()
    return [text, *(f"{text[:k]}-" for k in BEGINNINGS if len(text) >= k)]


def _bag(raw: bytes | None) -> Counter:
    bag: Counter = Counter()
    for w, n in Counter(m.group() for m in WORD.finditer((raw or b"").lower())).items():
        for f in features(w):
            bag[f] += n
    return bag


@lean
def _held(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and clean rows of a batch hold each feature."""
    for batch in batches:
        both = (Counter(), Counter())
        for y, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            both[y > 0].update(_bag(t.as_py()).keys())
        for y, counts in enumerate(both):
            yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array([n * (y == 1) for n in counts.values()], pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["feature", "hot", "held"])


@lean
def _vectors(batches: Iterable[pa.RecordBatch], place: dict[str, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags = [[(place[f], n) for f, n in _bag(t.as_py()).items() if f in place] for t in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array([[k for k, _ in b] for b in bags], pa.list_(pa.int32())), pa.array([[n for _, n in b] for b in bags], pa.list_(pa.int32()))], names=["toxic", "at", "counts"])


class OrdinalModel:
    """P(grade >= k) = 1 / (1 + exp(cut[k] - w.x)): one weight vector for all ordered thresholds."""

    def __init__(self, words: list[str], weights: np.ndarray, cuts: np.ndarray):
        self.weights, self.cuts = dict(zip(words, weights.tolist(), strict=True)), cuts

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - scores[:, None], -40, 40)))

    def score(self, raw: bytes | None, known: dict[bytes, tuple[str, ...]]) -> float:
        """w.x, with x the logarithm of 1 + a feature's count in the whole text; known remembers words' features."""
        seen: Counter = Counter()
        for w in WORD.findall((raw or b"").lower()):
            if (mine := known.get(w)) is None:
                mine = known[w] = tuple(f for f in features(w) if f in self.weights)
            if mine:
                seen.update(mine)
        if len(known) > REMEMBERED:
            known.clear()
        return sum(self.weights[f] * np.log1p(n) for f, n in seen.items())


def _grades(rows: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Grades from 0/1 labels: 0 for clean rows; toxic ones by how often they hold features that are 20 times likelier
    in toxic than in clean rows: up to 5 times, up to 15, more (a word counts with each of its beginnings)."""
    toxic, clean = Counter(), Counter()
    n = [max(1, sum(not y for y, _ in rows)), max(1, sum(bool(y) for y, _ in rows))]
    for y, bag in rows:
        (toxic if y else clean).update(bag.keys())
    cues = {f for f, k in toxic.items() if k >= 0.02 * n[1] and k / n[1] >= 20 * (clean[f] + 0.5) / n[0]}
    held = np.array([sum(c for f, c in bag.items() if f in cues) for _, bag in rows])
    return np.where([bool(y) for y, _ in rows], 1 + np.digitize(held, [6, 16]), 0)


def likelihood_slopes(up: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of -log P(grade = y) by (score - cut) of each threshold, with up = P(grade >= k): P(grade = y) is the difference of
    two neighbouring ones, so only the thresholds on either side of the grade have a slope."""
    every = np.hstack([np.ones((len(y), 1)), up, np.zeros((len(y), 1))])
    at = np.arange(len(y))
    own = np.maximum(every[at, y] - every[at, y + 1], 1e-9)
    slope = every * (1 - every)
    out = np.zeros_like(every)
    out[at, y] -= slope[at, y] / own
    out[at, y + 1] += slope[at, y + 1] / own
    return out[:, 1:-1]


def fit(rows: list[tuple[int, dict[int, int]]], words: list[str]) -> OrdinalModel:
    """Adam over all rows on the ordinal likelihood; without both kinds of labels every text is clean."""
    y = _grades(rows)
    if not rows or len(set(y > 0)) < 2:
        return OrdinalModel([], np.zeros(0), np.full(GRADES - 1, 20.0))
    share = sum(y > 0) / len(y)
    entries = [(k, f, np.log1p(c)) for k, (_, bag) in enumerate(rows) for f, c in bag.items()]
    row, col, x = (np.array(c) for c in zip(*entries, strict=True)) if entries else (np.zeros(0, int),) * 3
    w, cuts = np.zeros(len(words)), np.array([0.5, 1.5, 2.5][: GRADES - 1]) - np.log(max(share, 1e-3))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(cuts), np.zeros_like(cuts)]
    for t in range(1, PASSES + 1):
        s = np.bincount(row, x * w[col], len(y))
        up = 1 / (1 + np.exp(np.clip(cuts[None, :] - s[:, None], -40, 40)))
        g = likelihood_slopes(up, y) / len(y)
        gw, gc = np.bincount(col, x * g.sum(1)[row], len(w)) + LASSO, -g.sum(0)
        for k, (p, d) in enumerate(((w, gw), (cuts, gc))):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * d
            state[2 * k + 1] = 0.99 * state[2 * k + 1] + 0.01 * d * d
            p -= RATE * (state[2 * k] / (1 - 0.9**t)) / (np.sqrt(state[2 * k + 1] / (1 - 0.99**t)) + 1e-8)
        np.maximum(w, 0, out=w)  # words only add to the severity, so that it doesn't fall with a text's length
        cuts.sort()
        cuts[1:] = np.maximum(cuts[1:], cuts[:-1] + 0.05)  # a grade between two equal cuts would have no probability
    return OrdinalModel(words, w, cuts)


@lean
def _score(batches: Iterable[pa.RecordBatch], model: OrdinalModel, column: int) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, tuple[str, ...]] = {}
    for batch in batches:
        up = model.at_least(np.array([model.score(t.as_py(), known) for t in batch.column(column)], float).reshape(-1))
        yield pa.record_batch([*batch.columns, pa.array(up.sum(1)), pa.array((up > 0.5).sum(1).astype(np.int32))], names=[*batch.schema.names, "severity", "grade"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> OrdinalModel:
    """Fits on at most ROWS labelled rows, chosen by a hash of the id; rows without a label or id are left out."""
    mine = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic")).where("_id is not null and toxic is not null")
    mine = mine.groupBy("_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")).orderBy(F.xxhash64("_id"), "_id").limit(ROWS)
    text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    some = materialise(text.join(mine, "_id").select("toxic", "text").distinct(), "toxic-sample")  # copies count once
    n, hot = some.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = hot / n if n else 0
    held = some.mapInArrow(_held, "feature string, hot bigint, held bigint").groupBy("feature").agg(F.sum("hot").alias("hot"), F.sum("held").alias("held"))
    apart = (F.col("hot") - share * F.col("held")) / F.sqrt(F.col("held") * max(share * (1 - share), 1e-9))
    words = [r["feature"] for r in held.where((F.col("held") >= LEAST) & (apart >= APART)).orderBy(apart.desc(), "feature").limit(VOCABULARY).collect()]
    vectors = some.mapInArrow(functools.partial(_vectors, place={w: k for k, w in enumerate(words)}), "toxic int, at array<int>, counts array<int>")
    # at most ROWS rows of at most VOCABULARY numbers, in an order of their own
    rows = sorted(vectors.collect(), key=lambda r: (r["toxic"], r["at"], r["counts"]))
    return fit([(r["toxic"], dict(zip(r["at"], r["counts"], strict=True))) for r in rows], words)


def toxicity(docs: DataFrame, model: OrdinalModel, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """docs with severity (the expected grade, from the whole text), grade and toxic.

    Null and empty texts are clean; repeated rows are scored alike, one by one; an empty table gives no rows. Columns
    of docs stay, except those named severity, grade, toxic and _text, which are replaced.
    """
    short_batches(docs.sparkSession)
    keep = docs.drop("severity", "grade", "toxic", "_text").withColumn("_text", F.col(text_col).cast("string").cast("binary"))
    schema = T.StructType([*keep.schema.fields, T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType())])
    return keep.mapInArrow(functools.partial(_score, model=model, column=len(keep.columns) - 1), schema).drop("_text").withColumn("toxic", F.col("severity") >= reject)
