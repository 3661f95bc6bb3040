"""Dictionary-coded chunks of documents.

A table of documents becomes chunks of about CHUNK_BYTES of text. A chunk is its distinct words, dealt to buckets by
their hash (one row a bucket), and its documents as word codes, position by position (rows of about PIECE positions).
Only distinct words are shuffled to the global step (counting, encoding), bucket by bucket; what it finds comes back by
chunk and code, and the documents are put together again by position. Neither a chunk nor a row grows with the corpus,
and a word of a third of all positions has one entry for each chunk that it is in.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._tables import lean, short_batches

#: UTF-8 bytes of text in a chunk (a longer document is a chunk of its own); positions in a row of documents.
CHUNK_BYTES, PIECE = 20 << 20, 50_000
#: A text of more bytes than this is cut into words piece by piece.
LONG = 1 << 22
#: Buckets for distinct words: as many as shuffle partitions, within these bounds.
FEWEST, MOST = 64, 4096

WORDS, DOCUMENTS = 0, 1
ROWS = pa.schema([("key", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary()), ("n", pa.int64()), ("ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64()))])
DDL = "key int, chunk bigint, kind int, blob binary, n bigint, ids array<bigint>, lens array<bigint>"


class Codes(dict):
    """Numbers keys in the order of their first use."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def pack(codes: np.ndarray) -> bytes:
    """Codes below 2 ** 28, compressed: seven bits a byte, low ones first; the high bit says that more follow."""
    v = codes.astype(np.uint32)
    size = np.digitize(v, [1 << 7, 1 << 14, 1 << 21]) + 1
    out = np.empty((len(v), 4), np.uint8)
    for k in range(4):
        out[:, k] = ((v >> np.uint32(7 * k)) & 127) | ((size > k + 1) << 7)
    return zstandard.compress(out[np.arange(4)[None, :] < size[:, None]].tobytes(), 3)


def unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.append(0, ends[:-1] + 1) if len(ends) else ends
    size, out = ends - starts + 1, np.zeros(len(ends), np.uint32)
    for k in range(4):
        more = size > k
        out[more] |= (raw[starts[more] + k] & np.uint32(127)).astype(np.uint32) << np.uint32(7 * k)
    return out


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the slices [start, start + len), one behind the other."""
    ends = np.cumsum(lens)
    return np.repeat(starts - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)


def planes(numbers: np.ndarray) -> bytes:
    """uint32 numbers, byte plane by byte plane."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def pack_entries(codes: np.ndarray, columns: list[np.ndarray], data: bytes) -> bytes:
    """Ascending codes, columns of whole numbers below 2 ** 32 beside them, and bytes."""
    return zstandard.compress(len(codes).to_bytes(4, "little") + planes(np.diff(codes, prepend=0)) + b"".join(map(planes, columns)) + data, 3)


def unpack_entries(blob: bytes, columns: int) -> tuple[np.ndarray, list[np.ndarray], bytes]:
    raw = zstandard.decompress(blob)
    n = 4 * int.from_bytes(raw[:4], "little")
    cut = [raw[4 + k * n : 4 + (k + 1) * n] for k in range(columns + 1)]
    return np.cumsum(unplanes(cut[0]).astype(np.int64)), [unplanes(c).astype(np.int64) for c in cut[1:]], raw[4 + (columns + 1) * n :]


def words_in(lens: np.ndarray, data: bytes) -> list[bytes]:
    ends = np.cumsum(lens)
    return [data[a:b] for a, b in zip((ends - lens).tolist(), ends.tolist(), strict=True)]


@lean
def _cut(batches: Iterable[pa.RecordBatch], words_of: Callable, piece: Callable, counted: Callable | None, last: bytes | None, buckets: int, kinds: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    codes, docs, parts, size = Codes(), [], [], 0

    def row(key: int, chunk: int, kind: int, blob: bytes, n: int, ids: list | None, lens: list | None) -> pa.RecordBatch:
        return pa.record_batch([pa.array([x], t) for x, t in zip((key, chunk, kind, blob, n, ids, lens), ROWS.types, strict=True)], schema=ROWS)

    def flush() -> Iterator[pa.RecordBatch]:
        words = [w.encode() if isinstance(w, str) else w for w in codes]
        name = hashlib.blake2b(b"\n".join([*words, repr(docs).encode()]), digest_size=8)
        for x in parts:
            name.update(x.data)
        chunk = int.from_bytes(name.digest(), "little", signed=True)  # equal contents, equal names
        columns = [np.array([len(w) for w in words], np.int64)]
        if counted:
            mine = [x for d, x in zip(docs, parts, strict=True) if counted(d)]
            columns.append(np.bincount(np.concatenate(mine) if mine else np.zeros(0, np.int64), minlength=len(words)))
        at = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % buckets
        order = np.argsort(at, kind="stable")
        edges = np.searchsorted(at[order], np.arange(buckets + 1))
        for k in range(buckets) if WORDS in kinds else ():
            if len(own := order[edges[k] : edges[k + 1]]):
                yield row(k, chunk, WORDS, pack_entries(own, [c[own] for c in columns], b"".join([words[i] for i in own.tolist()])), len(own), None, None)
        begin, held = 0, 0
        for k, x in enumerate(parts if DOCUMENTS in kinds else ()):
            held += len(x)
            if held >= PIECE or k + 1 == len(parts):
                some = parts[begin : k + 1]
                key = buckets + zlib.crc32(f"{chunk} {begin}".encode()) % (1 << 20)
                yield row(key, chunk, DOCUMENTS, pack(np.concatenate(some)), len(words), docs[begin : k + 1], [len(y) for y in some])
                begin, held = k + 1, 0

    for batch in batches:
        for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = raw.as_py() or b""
            if size and size + len(raw) > CHUNK_BYTES:
                yield from flush()
                codes, docs, parts, size = Codes(), [], [], 0
            if len(raw) <= LONG:
                words = words_of(raw)
                got = np.fromiter(map(codes.__getitem__, words), np.uint32, len(words))
            else:
                it, some = piece(raw), [np.zeros(0, np.uint32)]
                while block := list(islice(it, 1 << 19)):
                    some.append(np.fromiter(map(codes.__getitem__, block), np.uint32, len(block)))
                got = np.concatenate(some)
            parts.append(got if last is None else np.append(got, np.uint32(codes[last])))
            docs.append(doc)
            size += len(raw) + 64
    if docs:
        yield from flush()


def bucket_count(spark: SparkSession) -> int:
    return min(MOST, max(FEWEST, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def cut(docs: DataFrame, words_of: Callable, piece: Callable, id_col: str, text_col: str, counted: Callable | None = None, last: bytes | None = None, kinds: tuple[int, ...] = (WORDS, DOCUMENTS)) -> DataFrame:
    """Chunk rows of docs, of both kinds or one. words_of(bytes) -> list of words; piece(bytes) -> an iterator over the same words, for long
    texts; counted(doc_id) -> whether a document's words are counted (a second column of the word rows); last is a
    word put behind each text."""
    short_batches(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return two.mapInArrow(functools.partial(_cut, words_of=words_of, piece=piece, counted=counted, last=last, buckets=bucket_count(docs.sparkSession), kinds=kinds), DDL)


def replaced(batch: pa.RecordBatch, k: int, blob: bytes) -> pa.RecordBatch:
    """Row k of a batch of chunk rows, with another blob."""
    return pa.record_batch([pa.array([blob], pa.binary()) if n == 3 else batch.column(n).slice(k, 1) for n in range(len(ROWS))], schema=ROWS)


def by_chunk(rows: DataFrame) -> DataFrame:
    """Chunks whole, words first."""
    return rows.select(*ROWS.names).repartition("chunk").sortWithinPartitions("chunk", "kind")


def pieces(batches: Iterable[pa.RecordBatch], columns: int) -> Iterator[tuple[dict, np.ndarray, list[np.ndarray], list[np.ndarray], bytes, np.ndarray, list, np.ndarray]]:
    """Of by_chunk() rows, for each row of documents: a dict that lasts as long as the chunk, what its word rows hold
    (word codes, columns, bytes, all joined), and the row's position codes, ids and lengths."""
    chunk, words, held, memo = None, {}, None, {}
    for batch in batches:
        for row in range(batch.num_rows):
            bucket, now, kind, blob, n, docs, lens = (batch.column(k)[row].as_py() for k in range(len(ROWS)))
            if now != chunk:
                chunk, words, held, memo = now, {}, None, {}
            if kind == WORDS:  # chunks of equal contents share their words
                words[bucket] = words.get(bucket) or unpack_entries(blob, columns)
                continue
            if held is None:
                none = np.zeros(0, np.int64)
                some = list(words.values())
                code = np.concatenate([w[0] for w in some]) if some else none
                if len(code) != n:
                    raise RuntimeError("a chunk has lost words: the input gave other rows when it was read again")
                held = code, [np.concatenate([w[1][c] for w in some]) if some else none for c in range(columns)], [w[2] for w in some]
                words = {}
            yield memo, *held, unpack(blob), docs, np.array(lens, np.int64)
