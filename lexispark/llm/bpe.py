"""Byte-level BPE encoding and decoding by a global shuffle of distinct words."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from ._chunks import DDL, DOCUMENTS, WORDS, by_chunk, cut, pack_entries, pieces, planes, ragged, replaced, unpack_entries, unplanes, words_in
from ._tables import lean

#: Words whose ids a worker remembers.
REMEMBERED = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of lines "base64 rank"; the file has a fixed size (50,256 tokens here)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(4)
def _pattern(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


class Pretokens:
    """Matches of a pattern in UTF-8 bytes."""

    def __init__(self, pattern: str):
        self.pattern = pattern

    def all(self, raw: bytes) -> list[str]:
        return _pattern(self.pattern).findall(raw.decode())

    def each(self, raw: bytes) -> Iterator[str]:
        return (m.group() for m in _pattern(self.pattern).finditer(raw.decode()))


@functools.lru_cache(2)
def _encoder(pattern: str, items: tuple) -> object:
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=dict(items), special_tokens={})._core_bpe.encode_single_piece


@lean
def _encode_words(batches: Iterable[pa.RecordBatch], shared, pattern: str) -> Iterator[pa.RecordBatch]:
    """Each distinct word of a bucket is encoded once."""
    encode, known = _encoder(pattern, tuple(shared.value.items())), {}
    for batch in batches:
        for k in range(batch.num_rows):
            codes, (lens,), data = unpack_entries(batch.column(3)[k].as_py(), 1)
            out = []
            for w in words_in(lens, data):
                if (ids := known.get(w)) is None:
                    ids = known[w] = np.array(encode(w), "<u4").tobytes()
                out.append(ids)
            if len(known) > REMEMBERED:
                known.clear()
            yield replaced(batch, k, pack_entries(codes, [np.array([len(x) // 4 for x in out])], planes(np.frombuffer(b"".join(out), "<u4"))))


@lean
def _assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word ids by code, put together position by position."""
    for memo, code, columns, data, positions, docs, lens in pieces(batches, 1):
        if not memo:
            size, sizes, starts = (columns[0], *np.zeros((2, len(code)), np.int64))
            sizes[code], starts[code] = size, np.cumsum(size) - size
            memo["table"] = np.concatenate([unplanes(x) for x in data]) if data else np.zeros(0, np.uint32), starts, sizes
        values, starts, sizes = memo["table"]
        at, out = 0, []
        for k in lens.tolist():
            mine = positions[at : at + k]
            out.append(values[ragged(starts[mine], sizes[mine])])
            at += k
        yield _ids_batch(docs, out)


def _ids_batch(docs: list, out: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
    return pa.record_batch([pa.array(docs, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out).astype(np.int32)))], names=["doc_id", "ids"])


def _known_chunks(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str, text_col: str) -> DataFrame:
    """Chunk rows with the ids of each word, by chunk."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # of fixed size: the vocabulary
    words = Pretokens(pattern)
    rows = {kind: cut(docs, words.all, words.each, id_col, text_col, kinds=(kind,)) for kind in (WORDS, DOCUMENTS)}
    known = rows[WORDS].repartition("key").mapInArrow(functools.partial(_encode_words, shared=shared, pattern=pattern), DDL)
    return by_chunk(known.unionByName(rows[DOCUMENTS]))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) for each row: each match of pattern encoded by itself, no special tokens.

    Pre-tokens stay with their positions as codes of their chunk; the distinct ones of each chunk are shuffled by their
    hash to one bucket, encoded once there, joined back to their chunks by code, and the documents are put together by
    position. A bucket streams; a worker remembers up to REMEMBERED words. Texts
    are cut twice, for the words and for the positions, rather than kept on disk in between: docs must be a table that
    reads the same each time, as files do; if it doesn't, chunks have other names and the query fails. Null and empty texts have no ids;
    repeated rows and repeated or null doc_ids give a row each; an empty table gives no rows; columns other than the
    two named are not read. Invalid Unicode can't occur in a Spark string.
    """
    return _known_chunks(docs, ranks, pattern, id_col, text_col).mapInArrow(_assemble, "doc_id bigint, ids array<int>")


def token_bytes(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """The token-byte table (id, bytes)."""
    return spark.createDataFrame([(i, bytearray(b)) for b, i in ranks.items()], "id int, bytes binary")


@lean
def _decode(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    table = shared.value
    for batch in batches:
        column = batch.column(1)
        for begin in range(0, len(column), 256):
            rows = column.slice(begin, 256)
            ids = [r.values.to_numpy(zero_copy_only=False) if r.is_valid else np.zeros(0, np.int32) for r in rows]
            texts = [b"".join(map(table.__getitem__, x.tolist())) for x in ids]
            yield pa.record_batch([batch.column(0).slice(begin, 256), rows, pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array(texts, pa.binary())], names=["doc_id", "ids", "ids_le", "bytes"])


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """encoded (doc_id, ids) with ids_le (the ids as little-endian uint32) and bytes (the decoded text).

    The token-byte table has a fixed size, so the join with it is a broadcast lookup in the order of the positions.
    Null or empty ids decode to no bytes; an id outside the vocabulary is an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast({i: b for b, i in ranks.items()})
    return encoded.select("doc_id", "ids").mapInArrow(functools.partial(_decode, shared=shared), "doc_id bigint, ids array<int>, ids_le binary, bytes binary")


@lean
def _both(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    return _decode(_assemble(batches), shared)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """decode(encode(docs)), with both in one pass of a worker over the chunks."""
    shared = docs.sparkSession.sparkContext.broadcast({i: b for b, i in ranks.items()})
    return _known_chunks(docs, ranks, pattern, id_col, text_col).mapInArrow(functools.partial(_both, shared=shared), "doc_id bigint, ids array<int>, ids_le binary, bytes binary")
