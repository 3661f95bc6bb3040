"""Token counts by compiled finite-state transducers.

Two deterministic machines are compiled from a byte-level BPE vocabulary. BOUNDARY reads character classes and
annotates transitions with the pre-token boundaries that they reveal. Texts are cut into blocks that run in lockstep;
for a block inside a text its map of all start states to end states is computed first, the maps of a text's blocks
compose by a parallel prefix scan, and then each block runs once more from its true start state. CountTransducer reads
the bytes of a pre-token; its transitions carry the change of the number of BPE tokens and are compiled when first used.
"""

from __future__ import annotations

import functools
import itertools
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import lean, short_batches

#: Characters a block, characters a run in lockstep, pre-tokens whose counts a worker remembers.
BLOCK, RUN, REMEMBERED = 2048, 1 << 23, 400_000

# Character classes; states; the contractions are 's 't 'm 'd, 're, 've and 'll.
LETTER, NUMBER, SPACE, WHITE, QUOTE, OTHER, SHORT, R, V, LL, E = range(11)
NONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AT_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, ONE_SPACE, ONE_WHITE, LAST_SPACE, LAST_WHITE = range(12)
#: Outputs, added up: a pre-token begins at this character; one begins at the character before.
HERE, BEFORE = 1, 2


@functools.lru_cache(1)
def char_classes() -> np.ndarray:
    """The class of each code point."""
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    codes = np.frombuffer(every.encode("utf-32-le"), np.uint32)
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        out[codes[[m.start() for m in regex.finditer(pattern, every)]]] = kind
    for chars, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", SHORT), ("r", R), ("v", V), ("l", LL), ("e", E)):
        out[[ord(c) for c in chars]] = kind
    return out


@functools.lru_cache(1)
def boundary_machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, output) by state * 11 + class, for the pre-token pattern of byte-level BPE."""
    letters = (LETTER, SHORT, R, V, LL, E)
    whites = {SPACE: ONE_SPACE, WHITE: ONE_WHITE}

    def begin(c: int) -> int:
        """The state behind the first character of a pre-token."""
        return IN_LETTERS if c in letters else whites[c] if c in whites else {NUMBER: IN_NUMBERS, QUOTE: AT_QUOTE}.get(c, IN_OTHERS)

    def step(s: int, c: int) -> tuple[int, int]:
        inside = {IN_LETTERS: letters, IN_NUMBERS: (NUMBER,), IN_OTHERS: (OTHER, QUOTE)}
        if s in (ONE_SPACE, LAST_SPACE, ONE_WHITE, LAST_WHITE):
            if c in whites:
                return (LAST_SPACE if c == SPACE else LAST_WHITE), 0
            split = BEFORE * (s in (LAST_SPACE, LAST_WHITE))
            if s in (ONE_SPACE, LAST_SPACE):  # the space joins what follows; no contraction begins with a space
                return (IN_OTHERS if c == QUOTE else begin(c)), split
            return begin(c), split | HERE
        if s == AT_QUOTE:
            if c == SHORT:
                return NONE, 0
            if c in (R, V, LL):
                return {R: QUOTE_R, V: QUOTE_V, LL: QUOTE_L}[c], 0
            return (IN_OTHERS, 0) if c in (OTHER, QUOTE) else (begin(c), HERE)
        if s in (QUOTE_R, QUOTE_V, QUOTE_L):
            if c == (LL if s == QUOTE_L else E):
                return NONE, 0
            to, out = step(IN_LETTERS, c)  # no contraction: the letters began one character before
            return to, out | BEFORE
        return (s, 0) if c in inside.get(s, ()) else (begin(c), HERE)

    pairs = [step(s, c) for s in range(12) for c in range(11)]
    return np.array([p[0] for p in pairs], np.uint8), np.array([p[1] for p in pairs], np.uint8)


def compose(maps: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan: row k becomes the composition of the maps from the last head up to k, in log2 steps."""
    maps, head, step = maps.copy(), head.copy(), 1
    while step < len(maps) and not head.all():
        open_ = np.flatnonzero(~head[step:]) + step
        new = np.take_along_axis(maps[open_], maps[open_ - step].astype(np.int64), 1)
        reached = head[open_ - step]
        maps[open_] = new
        head = head.copy()
        head[open_] = reached
        step *= 2
    return maps


def boundaries(cls: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, for texts of the given lengths, one behind the other in cls."""
    go, say = boundary_machine()
    first = np.cumsum(lens) - lens
    blocks = -(-lens // BLOCK)
    text = np.repeat(np.arange(len(lens)), blocks)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = first[text] + nth * BLOCK
    size = np.minimum(BLOCK, lens[text] - nth * BLOCK)

    def run(which: np.ndarray, state: np.ndarray, out: np.ndarray | None) -> np.ndarray:
        order = which[np.argsort(-size[which], kind="stable")]
        rank = np.argsort(-size[which], kind="stable")
        state, at = state[rank].copy(), begin[order]
        active = len(order) - np.searchsorted(np.sort(size[order]), np.arange(1, (size[order].max() if len(order) else 0) + 1))
        for j, n in enumerate(active.tolist()):
            pos = at[:n] + j
            key = cls[pos][:, None] + state[:n].astype(np.uint8) * 11 if state.ndim == 2 else cls[pos] + state[:n] * 11
            if out is not None:
                out[pos] = say[key]
            state[:n] = go[key]
        back = np.empty_like(state)
        back[rank] = state
        return back

    start = np.zeros(len(text), np.uint8)
    inner = np.flatnonzero((np.append(text[1:], -1) == text))  # blocks with another behind them
    if len(inner):
        maps = run(inner, np.tile(np.arange(12, dtype=np.uint8), (len(inner), 1)), None)
        start[inner + 1] = compose(maps, nth[inner] == 0)[:, NONE]
    out = np.zeros(len(cls), np.uint8)
    last = run(np.arange(len(text)), start, out)
    at = (out & HERE).astype(bool)
    at[:-1] |= (out[1:] & BEFORE).astype(bool)
    ended = np.append(text[1:], -1) != text
    open_ = ended & np.isin(last, (QUOTE_R, QUOTE_V, QUOTE_L))
    at[(begin + size - 1)[open_]] = True  # the text ends within what might have been a contraction
    at[first[lens > 0]] = True
    return at


@functools.lru_cache(1)
def _byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary file: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict:
    """Merges (as pairs of byte strings, best first) and added tokens of a tokenizers file with a byte-level BPE model."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    table = _byte_chars()
    raw = lambda s: bytes(table[c] for c in s)
    pairs = [p if isinstance(p, list) else p.split(" ") for p in spec["model"]["merges"]]
    return {"merges": [(raw(a), raw(b)) for a, b in pairs], "added": [t["content"] for t in spec["added_tokens"]]}


class CountTransducer:
    """Bytes of a pre-token to its number of BPE tokens.

    A prefix's tokenization ends in the one token that is compatible with the tokenization of what stands before it. A
    state is the longest suffix that may still grow into a token, with the last token and the relative count at each
    of its positions; this is all that later bytes depend on, so the states are finite and equal for equal futures.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        self.rank = {pair: k for k, pair in enumerate(merges)}
        self.tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in merges}
        self.prefixes = {t[:k] for t in self.tokens for k in range(len(t) + 1)}
        self.fits: dict[tuple[bytes | None, bytes], bool] = {}
        self.states: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.moves: list[dict[int, tuple[int, int]]] = []
        self.start = self._state((b"", ((None, 0),)))

    def merge(self, text: bytes) -> list[bytes]:
        """The best merge first, the leftmost of equals; a merge's result only takes part in later ones."""
        parts, rank = [text[k : k + 1] for k in range(len(text))], self.rank.get
        while True:
            best, at = 1 << 30, -1
            for k in range(len(parts) - 1):
                r = rank((parts[k], parts[k + 1]), best)
                if r < best:
                    best, at = r, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _fit(self, before: bytes | None, token: bytes) -> bool:
        key = (before, token)
        if key not in self.fits:
            self.fits[key] = self.merge((before or b"") + token) == ([token] if before is None else [before, token])
        return self.fits[key]

    def _state(self, key: tuple) -> int:
        if key not in self.states:
            self.states[key] = len(self.keys)
            self.keys.append(key)
            self.moves.append({})
        return self.states[key]

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        tail, marks = self.keys[state]
        tail += bytes([byte])
        at = next(k for k in range(len(tail)) if tail[k:] in self.tokens and self._fit(marks[k][0], tail[k:]))
        last, change = tail[at:], marks[at][1] + 1
        keep = next(k for k in range(len(tail) + 1) if tail[k:] in self.prefixes)
        marks = (*((t, n - change) for t, n in marks[keep:]), (last, 0))
        self.moves[state][byte] = found = (self._state((tail[keep:], marks)), change)
        return found

    def count(self, word: bytes) -> int:
        state, n, moves = self.start, 0, self.moves
        for b in word:
            state, d = moves[state].get(b) or self.compile(state, b)
            n += d
        return n


class _Counts(dict):
    def __init__(self, machine: CountTransducer):
        super().__init__()
        self.machine = machine

    def __missing__(self, word: str) -> int:
        self[word] = n = self.machine.count(word.encode())
        return n


def count_texts(texts: list[str], counts: _Counts, added: list[str]) -> list[int]:
    """Tokens of each text; strings of added tokens stand for themselves, as the library has it by default."""
    special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
    out, parts, owner = [0] * len(texts), [], []
    for k, t in enumerate(texts):
        pieces = special.split(t) if special and any(a in t for a in added) else [t]
        out[k] = len(pieces) - 1
        parts += pieces
        owner += [k] * len(pieces)
    whole = "".join(parts)
    if not whole:
        return out
    lens = np.array([len(p) for p in parts])
    at = np.flatnonzero(boundaries(char_classes()[np.frombuffer(whole.encode("utf-32-le"), np.uint32)], lens))
    ends = [*at[1:].tolist(), len(whole)]
    each = np.fromiter(map(counts.__getitem__, [whole[a:b] for a, b in zip(at.tolist(), ends, strict=True)]), np.int64, len(at))
    total = np.concatenate([[0], np.cumsum(each)])
    edge = np.searchsorted(at, np.cumsum(lens))
    for k, n in zip(owner, np.diff(total[edge], prepend=0).tolist(), strict=True):
        out[k] += n
    if len(counts) > REMEMBERED:
        counts.clear()
    return out


@lean
def _count(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    counts = _Counts(CountTransducer(shared.value["merges"]))
    ids, texts, size = [], [], 0

    def flush() -> pa.RecordBatch:
        n = count_texts(texts, counts, shared.value["added"])
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    for batch in batches:  # texts of several batches run in lockstep
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            t = t.as_py() or ""
            if size and size + len(t) > RUN:
                yield flush()
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
    if ids:
        yield flush()


def token_counts(docs: DataFrame, vocabulary: dict, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row, without any shuffle.

    Null and empty texts have 0 bytes and tokens; texts of any length are counted whole; repeated rows and null
    doc_ids give a row each; an empty table gives no rows; columns other than the two named are not read.
    """
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of fixed size
    two = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(functools.partial(_count, shared=shared), "doc_id bigint, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
