"""Log-bilinear language model: class counts of the whole corpus, noise-contrastive estimation in numpy, exact scores.

A token's probability is P(class | two classes before) * P(word | class). The most frequent TOP words are a class each;
the others share BANDS classes by frequency. The first factor is a log-bilinear neural model over classes, the second
the smoothed share of the word in its class. What the model learns from, the counts of all class triples, is summed
over every training document; it has at most (TOP + BANDS) ** 3 cells, so the driver gets a table of bounded size.
"""

from __future__ import annotations

import functools
import heapq
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._chunks import DDL, DOCUMENTS, WORDS, by_chunk, cut, pack_entries, pieces, replaced, unpack_entries, words_in
from ._tables import lean, materialise

TOP, BANDS = 112, 16
K = TOP + BANDS
#: Width of the embeddings, noise samples a token, full passes of Adam over the triple counts.
WIDTH, NOISE, PASSES, RATE = 24, 8, 160, 0.04
ALPHA = 0.1
#: The token behind each text; no word can hold white space.
END = b"\n"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def each_word(raw: bytes) -> Iterator[bytes]:
    return (m.group() for m in WORD.finditer(raw.lower()))


def trains(doc: int | None) -> bool:
    """Nine in ten documents train; a null doc_id is held out."""
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 != 0


@lean
def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by bucket. Of each bucket: how many words have a count, and the TOP words."""
    for _, counts in _buckets(batches):
        n, words = np.unique(np.fromiter(counts.values(), np.int64, len(counts)), return_counts=True)
        best = heapq.nsmallest(TOP, counts.items(), key=lambda x: (-x[1], x[0]))
        yield pa.record_batch([pa.array([None] * len(n) + [w for w, _ in best], pa.binary()), pa.array([*n.tolist(), *(c for _, c in best)], pa.int64()), pa.array([*words.tolist(), *[1] * len(best)], pa.int64())], names=["word", "c", "n"])


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, dict[bytes, int]]]:
    """Rows come by (key, pass): each row of words once to be added up, and once more, if wanted, to be answered."""
    key, counts, answered = None, {}, False
    for batch in batches:
        keys, second = batch.column(0).to_numpy(), batch.column(batch.schema.get_field_index("pass")).to_numpy()
        for k in range(batch.num_rows):
            if keys[k] != key:
                if counts and not answered:
                    yield [], counts
                key, counts, answered = keys[k], {}, False
            if second[k]:
                answered = True
                yield [batch, k], counts
                continue
            _, (lens, n), data = unpack_entries(batch.column(3)[k].as_py(), 2)
            for w, c in zip(words_in(lens, data), n.tolist(), strict=True):
                counts[w] = counts.get(w, 0) + c
    if counts and not answered:
        yield [], counts


@lean
def _answers(batches: Iterable[pa.RecordBatch], top: dict[bytes, int], least: float) -> Iterator[pa.RecordBatch]:
    """Each row of words with the words' counts in the whole corpus and their classes."""
    for (batch, k), counts in _buckets(batches):
        codes, (lens, _), data = unpack_entries(batch.column(3)[k].as_py(), 2)
        words = words_in(lens, data)
        c = np.fromiter(map(counts.__getitem__, words), np.int64, len(words))
        cls = band(c, least)
        for at in [i for i, w in enumerate(words) if w in top]:
            cls[at] = top[words[at]]
        yield replaced(batch, k, pack_entries(codes, [c & 0xFFFFFFFF, c >> 32, cls], b""))


def band(c: np.ndarray, least: float) -> np.ndarray:
    """The class of words with count c that are no class of their own; unknown words join those seen once."""
    return TOP + np.clip(np.floor(np.log2(least / np.maximum(c, 1)) + 1e-9), 0, BANDS - 1).astype(np.int64)


@lean
def _classes(batches: Iterable[pa.RecordBatch], total: int, distinct: int, rare: int, mass: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each row of documents: the tokens' classes, and what does not depend on the model."""
    new = ALPHA  # of one unknown word, in the class of those seen once, so that the known words and it sum to 1
    share = mass + new * (np.arange(K) == rare)
    for memo, code, columns, _, positions, docs, lens in pieces(batches, 3):
        if not memo:
            count, cls = np.zeros(len(code)), np.zeros(len(code), np.int64)
            count[code], cls[code] = columns[0] + (columns[1] << 32), columns[2]
            base = np.log10((count + ALPHA) / (total + ALPHA * (distinct + 1)))
            memo["table"] = count, cls.astype(np.uint8), base, np.log10(np.where(count > 0, count + ALPHA, new) / share[cls])
        count, cls, base, inside = memo["table"]
        at = np.cumsum(lens) - lens
        fold = lambda x: np.add.reduceat(x[positions], at)
        blob = zstandard.compress(cls[positions].tobytes(), 1)
        yield pa.record_batch([pa.array([x]) for x in (blob, docs, lens.tolist(), fold(base).tolist(), fold(inside).tolist(), fold((count > 0).astype(np.int64)).tolist())], names=["blob", "ids", "lens", "base", "inside", "known"])


def _context(blob: bytes, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's context (the two classes before, END before a text) and class."""
    cls = np.frombuffer(zstandard.decompress(blob), np.uint8).astype(np.int32)
    one, two = np.roll(cls, 1), np.roll(cls, 2)
    first = np.cumsum(lens) - lens
    one[first] = two[first] = 0
    two[(first + 1)[lens > 1]] = 0
    return two * K + one, cls


@lean
def _triples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            lens = np.array(row["lens"], np.int64)
            context, cls = _context(row["blob"], lens)
            mine = np.repeat([trains(d) for d in row["ids"]], lens)
            cell, n = np.unique((context * K + cls)[mine], return_counts=True)
            yield pa.record_batch([pa.array(cell.astype(np.int32)), pa.array(n.astype(np.int64))], names=["cell", "n"])


def train(cell: np.ndarray, n: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Noise-contrastive estimation on counts: each cell (context * K + class) is a true token n times against NOISE
    draws from the class distribution; the expectation over the draws is taken whole instead of by sampling."""
    seen, row = np.unique(cell // K, return_inverse=True)
    real = np.zeros((len(seen), K), np.float32)
    real[row, cell % K] = n
    noise = (real.sum(0) + 1) / (real.sum() + K)
    real /= max(real.sum(), 1)
    fake = NOISE * real.sum(1, keepdims=True) * noise
    rng = np.random.default_rng(seed)
    p = {"r": rng.normal(0, 0.1, (K, WIDTH)), "q": rng.normal(0, 0.1, (K, WIDTH)), "c1": np.eye(WIDTH), "c2": np.eye(WIDTH) * 0.5, "b": np.log(noise)}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    two, one = seen // K, seen % K
    by_one, by_two = (np.zeros((K, len(seen)), np.float32) for _ in range(2))
    by_one[one, np.arange(len(seen))] = by_two[two, np.arange(len(seen))] = 1
    for t in range(1, (PASSES if len(seen) else 0) + 1):
        h = p["r"][one] @ p["c1"] + p["r"][two] @ p["c2"]
        odds = h @ p["q"].T + (p["b"] - np.log(NOISE * noise)).astype(np.float32)
        yes = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        g = fake * yes - real * (1 - yes)
        dh = g @ p["q"]
        grads = {"q": g.T @ h, "b": g.sum(0), "c1": p["r"][one].T @ dh, "c2": p["r"][two].T @ dh, "r": by_one @ (dh @ p["c1"].T) + by_two @ (dh @ p["c2"].T)}
        rate = RATE * min(1, 2 * (1 - t / (PASSES + 1)))
        for k, x in grads.items():
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.99 * v[k] + 0.01 * x * x
            p[k] = (p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-9)).astype(np.float32)
    return p


def log_probs(p: dict[str, np.ndarray], contexts: np.ndarray) -> np.ndarray:
    """Normalised log10 probabilities of all classes behind each context, by batched matrix products."""
    s = (p["r"][contexts % K] @ p["c1"] + p["r"][contexts // K] @ p["c2"]) @ p["q"].T + p["b"]
    s = s.astype(np.float64)
    s -= s.max(1, keepdims=True)
    return (s - np.log(np.exp(s).sum(1, keepdims=True))) / np.log(10)


@lean
def _score(batches: Iterable[pa.RecordBatch], params) -> Iterator[pa.RecordBatch]:
    table = None
    for batch in batches:
        for row in batch.to_pylist():
            if table is None:
                table = np.concatenate([log_probs(params.value, np.arange(a, min(a + 2048, K * K))) for a in range(0, K * K, 2048)])
            lens = np.array(row["lens"], np.int64)
            context, cls = _context(row["blob"], lens)
            own = np.add.reduceat(table[context, cls], np.cumsum(lens) - lens)
            yield pa.record_batch([pa.array(row["ids"], pa.int64()), pa.array([not trains(d) for d in row["ids"]]), pa.array(lens), pa.array(row["known"], pa.int64()), pa.array(row["base"]), pa.array(own + np.array(row["inside"]))], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores every text by a model of those in training (trains()).

    Returns SCORED and train_tokens. A null or empty text is the end token alone. Repeated rows train and are scored
    once for each row; an empty table gives no rows, a corpus without training rows a uniform model; columns other
    than the two named are not read.
    """
    spark = docs.sparkSession
    table = materialise(cut(docs, words_of, each_word, id_col, text_col, trains, END), "lm-words")
    words = table.where(F.col("kind") == WORDS)
    once_each = words.withColumn("pass", F.lit(0)).repartition("key").sortWithinPartitions("key")
    sums = once_each.mapInArrow(_totals, "word binary, c bigint, n bigint").where("c > 0")
    sums = materialise(sums.groupBy("word", "c").agg(F.sum("n").alias("n")), "lm-counts")
    counts = sums.where("word is null").agg(F.sum(F.col("c") * F.col("n")), F.sum("n")).first()
    total, distinct = (x or 0 for x in counts)
    best = sums.where(F.col("word").isNotNull() & (F.col("word") != END)).orderBy(F.desc("c"), "word").limit(TOP - 1).collect()
    end = sum(r["c"] for r in sums.where(F.col("word") == END).collect())
    own = [(END, end), *((bytes(r["word"]), r["c"]) for r in best)]
    top, least = {w: k for k, (w, _) in enumerate(own)}, float(min((c for _, c in own[1:]), default=1))
    # how many words have a count: the classes' weights follow, those of the TOP words taken out of the bands
    by_size = sums.where("word is null").groupBy((F.when(F.col("c") >= least, F.lit(least)).otherwise(F.col("c"))).alias("c0")).agg(F.sum("n").alias("n"), F.sum(F.col("c") * F.col("n")).alias("s")).toPandas()
    mass = np.zeros(K)
    np.add.at(mass, band(by_size["c0"].to_numpy(float), least), by_size["s"].to_numpy(float) + ALPHA * by_size["n"].to_numpy(float))
    for k, (_, c) in enumerate(own):
        if c:
            mass[k] = c + ALPHA
            mass[band(np.array([c]), least)] -= c + ALPHA
    rare = int(band(np.array([1]), least)[0])
    twice = words.withColumn("pass", F.explode(F.array(F.lit(0), F.lit(1)))).repartition("key").sortWithinPartitions("key", "pass")
    known = twice.mapInArrow(functools.partial(_answers, top=top, least=least), DDL)
    chunks = by_chunk(known.unionByName(table.where(F.col("kind") == DOCUMENTS)))
    chunks = materialise(chunks.mapInArrow(functools.partial(_classes, total=total, distinct=distinct, rare=rare, mass=mass), "blob binary, ids array<bigint>, lens array<bigint>, base array<double>, inside array<double>, known array<bigint>"), "lm-classes")
    cells = chunks.select("blob", "ids", "lens").mapInArrow(_triples, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    params = spark.sparkContext.broadcast(train(cells["cell"].to_numpy(), cells["n"].to_numpy()))
    return chunks.mapInArrow(functools.partial(_score, params=params), SCORED).withColumn("train_tokens", F.lit(total).cast("bigint"))
