"""Benchmark decontamination with a distributed positional inverted index.

The corpus is indexed shard by shard: each term's positions in the shard, for the terms of the benchmark. Terms are
ranked by how many postings the whole index has of them. A test window is looked up by its rarest term; the lists of
its other terms, adjusted by their offsets, are intersected in the order of rarity until all have agreed (exact
phrase); the three rarest terms within SLOP words of each other are a proximity match.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._chunks import pack, unpack
from ._tables import lean, materialise, short_batches

WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
#: Words of a window; words within which rare terms are near each other; one word in PARTS of a
#: contaminated text is hit at least.
WINDOW, SLOP, PARTS = 13, 26, 20
#: UTF-8 bytes of text in a shard; benchmark text that is searched at once (its vocabulary and windows go to all tasks).
SHARD_BYTES, BLOCK_BYTES = 8 << 20, 8 << 20

INDEX = "ids array<bigint>, texts array<bigint>, n_words array<bigint>, terms array<int>, sizes array<int>, postings binary"
HITS = "doc_id bigint, text_id bigint, n_words bigint, begins array<bigint>, ends array<bigint>, items array<string>, near array<string>"


def words_of(raw: bytes | None) -> list[bytes]:
    return WORD.findall((raw or b"").lower())


class Windows:
    """All distinct windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[object, bytes | None]]):
        self.terms: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, raw in items:
            ids = tuple(self.terms.setdefault(w, len(self.terms)) for w in words_of(raw))
            for k in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                found.setdefault(ids[k : k + WINDOW], set()).add(str(item))
        self.windows = list(found.items())


@lean
def _index(batches: Iterable[pa.RecordBatch], terms: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Shards: postings are positions in the shard's documents, one behind the other with a gap of one between two."""
    ids, texts, counts, parts, size = [], [], [], [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal ids, texts, counts, parts, size
        if ids:
            every = np.concatenate(parts)
            pos = np.flatnonzero(every >= 0)
            term = every[pos]
            order = np.argsort(term, kind="stable")
            pos, (kinds, first, n) = pos[order], np.unique(term[order], return_index=True, return_counts=True)
            gaps = np.diff(pos, prepend=0)
            gaps[first] = pos[first]
            yield pa.record_batch([pa.array([ids], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([kinds], pa.list_(pa.int32())), pa.array([n], pa.list_(pa.int32())), pa.array([pack(gaps)], pa.binary())], names=["ids", "texts", "n_words", "terms", "sizes", "postings"])
        ids, texts, counts, parts, size = [], [], [], [], 0

    gap = np.full(1, -1, np.int32)
    for batch in batches:
        for doc, raw, text_id in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            raw = raw.as_py()
            words = words_of(raw)
            if size and size + len(raw or b"") > SHARD_BYTES:
                yield from flush()
            ids.append(doc)
            texts.append(text_id)
            counts.append(len(words))
            parts += [np.fromiter((terms.get(w, -1) for w in words), np.int32, len(words)), gap]
            size += len(raw or b"") + 64
    yield from flush()


class Shard:
    """An opened shard of the index."""

    def __init__(self, terms: list[int], sizes: list[int], postings: bytes):
        gaps = unpack(postings).astype(np.int64)
        at = 0
        self.lists: dict[int, np.ndarray] = {}
        for t, n in zip(terms, sizes, strict=True):
            self.lists[t] = np.cumsum(gaps[at : at + n])
            at += n
        self.none = np.zeros(0, np.int64)

    def _among(self, wanted: np.ndarray, term: int) -> np.ndarray:
        have = self.lists.get(term, self.none)
        k = np.searchsorted(have, wanted)
        return (k < len(have)) & (have[np.minimum(k, len(have) - 1)] == wanted) if len(have) else np.zeros(len(wanted), bool)

    def phrase(self, window: tuple[int, ...], order: list[int]) -> np.ndarray:
        """Where the window begins; order: its offsets, rarest term first."""
        begins = self.lists.get(window[order[0]], self.none) - order[0]
        for k in order[1:]:
            if not len(begins):
                break
            begins = begins[self._among(begins + k, window[k])]
        return begins

    def near(self, rare: list[int], slop: int) -> np.ndarray:
        """Positions of the first term with each other one within slop words on either side."""
        at = self.lists.get(rare[0], self.none)
        for term in rare[1:]:
            have = self.lists.get(term, self.none)
            at = at[np.searchsorted(have, at - slop, "left") < np.searchsorted(have, at + slop, "right")]
        return at


@lean
def _search(batches: Iterable[pa.RecordBatch], by_rarest: dict[int, list[tuple[tuple[int, ...], list[str], list[int]]]]) -> Iterator[pa.RecordBatch]:
    """A shard is searched for the windows whose rarest term it holds."""
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row["terms"], row["sizes"], row["postings"])
            lens = np.array(row["n_words"], np.int64)
            first = np.concatenate([[0], np.cumsum(lens + 1)])[:-1]
            hits: dict[int, list] = {}
            for window, items, order in (w for term in by_rarest.keys() & shard.lists.keys() for w in by_rarest[term]):
                rare = list(dict.fromkeys(window[k] for k in order))[:3]
                begins = shard.phrase(window, order)
                for what, found in ((0, begins), (1, shard.near(rare, SLOP))):
                    docs = np.searchsorted(first, found, "right") - 1
                    for d, p in zip(docs.tolist(), (found - first[docs]).tolist(), strict=True):
                        mine = hits.setdefault(d, [[], set(), set()])
                        mine[1 + what].update(items)
                        if not what:
                            mine[0].append((p, p + len(window)))
            spans, empty = [], [[], set(), set()]
            for d in range(len(lens)):
                begin, end, out = None, -1, []
                for a, b in sorted(hits.get(d, empty)[0]):
                    if a > end:
                        if begin is not None:
                            out.append((begin, end))
                        begin = a
                    end = max(end, b)
                spans.append([*out, (begin, end)] if begin is not None else out)
            sets = [[sorted(hits.get(d, empty)[k]) for d in range(len(lens))] for k in (1, 2)]
            yield pa.record_batch([pa.array(row["ids"], pa.int64()), pa.array(row["texts"], pa.int64()), pa.array(lens), *(pa.array([[s[k] for s in x] for x in spans], pa.list_(pa.int64())) for k in (0, 1)), *(pa.array(s, pa.list_(pa.string())) for s in sets)], names=["doc_id", "text_id", "n_words", "begins", "ends", "items", "near"])


@lean
def _ranked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.record_batch([pa.array(row["terms"], pa.int32()), pa.array(row["sizes"], pa.int64())], names=["term", "n"])


def _block_hits(docs: DataFrame, block: Windows) -> DataFrame:
    index = materialise(docs.mapInArrow(functools.partial(_index, terms=block.terms), INDEX), "postings")
    ranks = index.select("terms", "sizes").mapInArrow(_ranked, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    count = {r["term"]: r["n"] for r in ranks.collect()}  # at most the terms of the block
    windows = [(w, sorted(items), sorted(range(len(w)), key=lambda k: (count.get(w[k], 0), k))) for w, items in block.windows if all(t in count for t in w)]
    by_rarest: dict[int, list] = {}
    for window in windows:
        by_rarest.setdefault(window[0][window[2][0]], []).append(window)
    shared = docs.sparkSession.sparkContext.broadcast(by_rarest)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(batches, shared.value)

    return index.mapInArrow(search, HITS)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, bytes | None]]]:
    held, size = [], 0
    for r in benchmark.toLocalIterator():
        raw = bytes(r["text"]) if r["text"] is not None else b""
        if held and size + len(raw) > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append((r["item"], raw))
        size += len(raw)
    yield held


@lean
def _merge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        n_hit = [sum(b - a for a, b in _union(x)) for x in batch.column(batch.schema.get_field_index("spans")).to_pylist()]
        yield pa.record_batch([*batch.columns[:-1], pa.array(n_hit, pa.int64())], names=[*batch.schema.names[:-1], "n_hit"])


def _union(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["b"], s["e"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, items, near, contaminated) for each row of docs.

    items are the benchmark items with a window that occurs, near those with a proximity match. The benchmark is read
    in blocks of BLOCK_BYTES; each block has an index of its own terms, so what goes to a task has a fixed size, and
    with several blocks the spans of a document are joined at the end, by its id and a hash of its text. Null and empty texts have no words; null items
    have no windows; repeated rows give a row each; an empty table gives no rows; columns other than those named are not read.
    """
    short_batches(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"), F.xxhash64(F.col(text_col).cast("string")).alias("text_id"))
    tests = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).cast("string").cast("binary").alias("text")).where("item is not null").orderBy("item", "text")
    hits = [_block_hits(two, Windows(block)) for block in _blocks(tests)]
    spans = F.arrays_zip(F.col("begins").alias("b"), F.col("ends").alias("e")).alias("spans")
    if len(hits) == 1:
        one = hits[0].select("doc_id", "n_words", F.array_sort("items").alias("items"), F.array_sort("near").alias("near"), spans)
    else:
        every = functools.reduce(DataFrame.unionAll, [h.withColumn("block", F.lit(k)) for k, h in enumerate(hits)])
        flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        rows = hits[0].groupBy("doc_id", "text_id").agg(F.count("*").alias("_n"))
        one = every.select("*", spans).groupBy("doc_id", "text_id").agg(F.max("n_words").alias("n_words"), flat("items"), flat("near"), F.flatten(F.collect_list("spans")).alias("spans"))
        one = one.join(rows.withColumnsRenamed({"doc_id": "_d", "text_id": "_t"}), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_id") == F.col("_t"))).select("doc_id", "n_words", "items", "near", "spans", F.explode(F.sequence(F.lit(1), "_n")).alias("_k")).drop("_k")
    out = one.select("doc_id", "n_words", "items", "near", "spans").mapInArrow(_merge, "doc_id bigint, n_words bigint, items array<string>, near array<string>, n_hit bigint")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (PARTS * F.col("n_hit") >= F.col("n_words")))


def items_sha256(column: str = "items") -> Column:
    return F.sha2(F.array_join(column, ","), 256)
