"""MinHash near-duplicates: banded candidates, sequential Bayesian pruning, exact verification, components.

Groups are wanted, not pairs. So each member of a bucket is first compared with a few members of the bucket only, as many
pairs as members; the groups that these links make are contracted, and all members of a bucket that are still in
different groups meet in cells of bounded size. There they are pruned by signatures, the texts of those that are left
travel to the cell, and they are verified where they meet, so that links between groups are told, and no pairs.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import components
from ._tables import lean, materialise, release, short_batches

#: Words of a shingle; hundredths of Jaccard similarity from which documents are linked.
SHINGLE, PERCENT = 5, 75
#: Bands of ROWS hashes: a pair at the threshold shares none with probability (1 - 0.75 ** 4) ** 32, 5e-6.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Hashes compared at a time; a pair is given up when the posterior probability of its being linked falls below MISS.
BATCH, MISS = 32, 1e-5
#: Members of a part of a bucket, and shingles of them; in a larger bucket each two parts are compared in a cell of their own.
PART, WEIGHT = 256, 1 << 20
#: Members of a bucket that each of its members is compared with before groups are contracted, besides the first.
PIVOTS = 2
#: Pairs of one document that one task verifies.
STAR = 64
REMEMBERED = 100_000

#: Rows a batch that cells send on.
SENT = 1000

SETS = "doc_id bigint, raw bigint, n bigint, h1 bigint, h2 bigint, sig binary, keys array<bigint>"
#: A member of a cell. Of two members of side 0, and of two of different sides, the pair is the cell's to compare.
MEMBER = "key bigint, cell bigint, side int, group bigint, rep bigint, raw bigint, n bigint, sig binary"
_RNG = np.random.default_rng(20240607)
_A, _B, _C = (_RNG.integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1) for _ in range(3))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = x = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return x


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(raw: bytes | None, known: _Hashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; of a shorter text, one of all its words."""
    words = (raw or b"").lower().split()
    x = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(known) > REMEMBERED:
        known.clear()
    n = min(size, len(x))
    if not n:
        return x
    out = np.full(len(x) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + x[k : len(x) - n + 1 + k])
    return np.unique(out)


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of HASHES hash functions over the set."""
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(found), 2048):
        part = found[at : at + 2048]
        low, high = part.astype(np.uint32), (part >> np.uint64(32)).astype(np.uint32)
        for k in range(0, HASHES, 32):
            s = slice(k, k + 32)
            h = low[None, :] * _A[s, None]
            h += high[None, :] * _B[s, None]
            h += _C[s, None]
            out[s] = np.minimum(out[s], h.min(1))
    return out


@lean
def _sets(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    known = _Hashes()
    turn = np.arange(BANDS, dtype=np.int64) << 32
    for batch in batches:
        rows: list[tuple] = []
        for text in batch.column(2):
            found = shingles(text.as_py(), known, size)
            if not len(found):
                rows.append((0, None, None, None, None))
                continue
            digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
            sig = (signature(found) & 255).astype(np.uint8)
            # a key says its band and holds the band's hashes as they are in sig, so that sigs tell which keys two texts share
            rows.append((len(found), *(int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8)), sig.tobytes(), sig.view("<u4") + turn))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        yield pa.record_batch([batch.column(0), batch.column(1), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(types))], names=["doc_id", "raw", "n", "h1", "h2", "sig", "keys"])


@functools.lru_cache(8)
def posterior_bounds(n: int, share: float, miss: float) -> tuple[int, int]:
    """The fewest of n equal hashes with which a pair may still be linked, and the fewest with which it is sure to be.

    With a uniform prior, P(similarity >= share | k of n equal) is P(Binomial(n + 1, share) <= k).
    """
    below, total = [], 0.0
    for k in range(n + 1):
        total += math.comb(n + 1, k) * share**k * (1 - share) ** (n + 1 - k)
        below.append(total)
    return next(k for k, p in enumerate(below) if p >= miss), next((k for k, p in enumerate(below) if p > 1 - miss), n)


def _least(share: float) -> list[int]:
    return [posterior_bounds(at, share, MISS)[0] for at in range(BATCH, HASHES + 1, BATCH)]


def candidates(sigs: np.ndarray, share: float, among: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of members (rows of 8-bit hashes) to verify, of those among which (an upper triangle) it is asked.

    Signatures are compared batch by batch, and pairs pruned after each.
    """
    i, j = np.nonzero(np.triu(np.ones((len(sigs), len(sigs)), bool), 1) if among is None else among)
    out = []
    for s in range(0, len(i), 1 << 17):
        a, b = i[s : s + (1 << 17)], j[s : s + (1 << 17)]
        same = np.zeros(len(a), np.int16)
        for at, least in zip(range(0, HASHES, BATCH), _least(share), strict=True):
            same += (sigs[a, at : at + BATCH] == sigs[b, at : at + BATCH]).sum(1, dtype=np.int16)
            left = same >= least
            a, b, same = a[left], b[left], same[left]
        out += zip(a.tolist(), b.tolist(), strict=True)
    return out


@lean
def _possible(batches: Iterable[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, sig of a, sig of b), those that pruning leaves."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, HASHES) for k in (2, 3))
        same = (x == y).reshape(len(x), -1, BATCH).sum(2).cumsum(1)
        yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array((same >= _least(share)).all(1)))


def _cells(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each cell, of rows by (key, cell); a cell may go on in the next batch."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and row[:2] != rows[0][:2]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _undecided(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Pairs of a cell's members to verify: in different groups, not pruned, and not met in an earlier band."""
    side, group, n = (np.array([r[k] for r in rows], np.int64) for k in (2, 3, 6))
    among = np.triu(group[:, None] != group, 1) & ((side[:, None] != side) | (side == 0))
    among &= 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
    sigs = np.frombuffer(b"".join(r[7] for r in rows), np.uint8).reshape(-1, HASHES)
    bands = sigs.view("<u4")
    for k in range(rows[0][0] >> 32):
        among &= bands[:, k, None] != bands[:, k]
    return candidates(sigs, percent / 100, among)


@lean
def _compare(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows MEMBER by (key, cell), the members with a pair to verify in their cell."""
    types = (pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary())
    send = lambda out: pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=[c.split(" ")[0] for c in MEMBER.split(", ")])
    out: list[tuple] = []
    for rows in _cells(batches):
        out += [rows[k] for k in sorted({k for pair in _undecided(rows, percent) for k in pair})]
        if len(out) >= SENT:
            yield send(out)
            out = []
    if out:
        yield send(out)


def links_between(sets: list[np.ndarray], pairs: list[tuple[int, int]], groups: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A forest of the groups that are joined by those of the pairs that are linked, by intersections of whole sets.

    The member with most pairs is next, and is compared with all its partners at once, by the places of its shingles in all
    sets. Pairs within a tree need not be verified.
    """
    m, n = len(sets), np.array([len(x) for x in sets])
    tree, out = np.unique(groups, return_inverse=True)[1], []
    open_ = np.zeros((m, m), bool)
    i, j = np.array(pairs, np.int64).reshape(-1, 2).T
    open_[i, j] = open_[j, i] = True
    flat, ends = np.concatenate(sets), np.cumsum(n)
    order = np.argsort(flat, kind="stable")
    ordered, holder = flat[order], np.repeat(np.arange(m), n)[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    first = np.flatnonzero(new)
    times, number = np.diff(np.append(first, len(flat))), np.empty(len(flat), np.int64)
    number[order] = np.cumsum(new) - 1
    while (left := open_.sum(1)).any():
        k = int(left.argmax())
        own = number[ends[k] - n[k] : ends[k]]
        held = times[own]
        both = np.bincount(holder[np.arange(held.sum()) + np.repeat(first[own] - np.cumsum(held) + held, held)], minlength=m)
        near = np.flatnonzero(open_[k] & (both > 0) & (100 * both >= percent * (n[k] + n - both)))
        for x in near.tolist():
            if tree[x] != tree[k]:
                out.append((int(groups[k]), int(groups[x])))
                tree[tree == tree[x]] = tree[k]
        open_[k] = open_[:, k] = False
        if len(near):
            open_ &= tree[:, None] != tree
    return out


@lean
def _meet(batches: Iterable[pa.RecordBatch], percent: int, size: int) -> Iterator[pa.RecordBatch]:
    """Of rows MEMBER and a text by (key, cell, rep, raw), the links between groups."""
    known, out = _Hashes(), []
    for rows in _cells(batches):
        rows = list({r[4:6]: r for r in rows}.values())  # rows of one id and text are one member
        if pairs := _undecided(rows, percent):
            out += links_between([shingles(r[8], known, size) for r in rows], pairs, np.array([r[3] for r in rows]), percent)
        if len(out) >= SENT:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])
            out = []
    if out:
        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])


@lean
def _verify(batches: Iterable[pa.RecordBatch], percent: int, size: int) -> Iterator[pa.RecordBatch]:
    """Rows by (a, salt, b): texts of a first (b null), then those of its partners."""
    key, own, known = None, [], _Hashes()
    for batch in batches:
        out = []
        for a, salt, b, raw in zip(*(batch.column(k) for k in range(4)), strict=True):
            a, salt, b = a.as_py(), salt.as_py(), b.as_py()
            if (a, salt) != key:
                key, own = (a, salt), []
            found = shingles(raw.as_py(), known, size)
            if b is None:
                own.append(found)
                continue
            for x in own:
                both = len(np.intersect1d(x, found, assume_unique=True))
                if both and 100 * both >= percent * (len(x) + len(found) - both):
                    out.append((a, b))
                    break
        yield pa.record_batch([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def linked(pairs: DataFrame, text: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (a, b) whose texts (doc_id, text) are similar."""
    stars = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).alias("stars"))
    # texts are shuffled whatever the number of pairs, so that a plan that works on a small table is the one at scale
    partner = pairs.join(stars, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("stars"))).select("a", "salt", "b").join(text.withColumnRenamed("doc_id", "b").hint("merge"), "b").select("a", "salt", "b", "text")
    own = stars.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("stars") - 1))).join(text.withColumnRenamed("doc_id", "a").hint("merge"), "a").select("a", "salt", F.lit(None).cast("bigint").alias("b"), "text")
    rows = own.unionByName(partner).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
    return rows.mapInArrow(functools.partial(_verify, percent=percent, size=size), "a bigint, b bigint")


def crowded(reps: DataFrame) -> DataFrame:
    """(key, rep, raw, n, pivots): the members of buckets of several documents."""
    dealt = reps.select(F.explode("keys").alias("key"), "rep", "raw", "n").repartition("key")
    pivots = [F.min("rep"), *[F.max_by("rep", F.xxhash64("rep", F.lit(k))) for k in range(PIVOTS)]]
    several = dealt.groupBy("key").agg(F.array_distinct(F.array(*pivots)).alias("pivots"), F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("key", "pivots")
    return dealt.join(several.hint("shuffle_hash"), "key").select("key", "rep", "raw", "n", "pivots")


def group_links(members: DataFrame, reps: DataFrame, label: DataFrame, text: DataFrame, percent: int, size: int) -> DataFrame:
    """(a, b): the groups of label (node, component), a document without one being its own, that have similar members
    in a bucket. Members but pivots, which all have met, are compared with all of their bucket in other groups.

    Members of a bucket's largest group meet its other members, and these each other, in cells of two parts. A bucket is
    dealt to as many rows as it has members, times the parts of those that aren't in its largest group.
    """
    others = members.where(~F.array_contains("pivots", F.col("rep"))).join(label.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("component", "rep").alias("group"), "rep", "raw", "n")
    held = others.groupBy("key", "group").agg(F.count("*").alias("m"), F.sum("n").alias("w"))
    most = held.groupBy("key").agg(F.max(F.struct("m", "group", "w")).alias("top"), F.sum("m").alias("m"), F.sum("w").alias("w")).where("m > top.m")
    parts = lambda m, w: F.ceil(F.greatest(m / PART, w / WEIGHT))
    buckets = most.select("key", F.col("top.group").alias("largest"), parts(F.col("m") - F.col("top.m"), F.col("w") - F.col("top.w")).alias("rest"), parts(F.col("top.m"), F.col("top.w")).alias("tops"))
    inside, deal = F.col("group") == F.col("largest"), lambda k: F.pmod(F.xxhash64("rep", "raw"), k)
    dealt = others.join(buckets, "key").withColumn("part", F.when(inside, F.col("rest") + deal(F.col("tops"))).otherwise(deal(F.col("rest")))).withColumn("parts", F.col("rest") + F.col("tops"))
    side = lambda k: F.when(k == F.col("part"), 0).when(F.col("part") < k, 1).otherwise(2)
    cell = lambda k: F.struct((F.least(k, F.col("part")) * F.col("parts") + F.greatest(k, F.col("part"))).alias("cell"), side(k).alias("side"))
    met = F.transform(F.sequence(F.lit(0).cast("bigint"), F.when(inside, F.col("rest")).otherwise(F.col("parts")) - 1), cell)
    cells = dealt.select("key", F.inline(met), "group", "rep", "raw", "n").join(reps.select("rep", "raw", "sig"), ["rep", "raw"])
    names = [c.split(" ")[0] for c in MEMBER.split(", ")]
    left = cells.select(*names).repartition("key", "cell").sortWithinPartitions("key", "cell").mapInArrow(functools.partial(_compare, percent=percent), MEMBER)
    whole = left.join(text.withColumnRenamed("doc_id", "rep").hint("merge"), ["rep", "raw"]).select(*names, "text")
    return whole.repartition("key", "cell").sortWithinPartitions("key", "cell", "rep", "raw").mapInArrow(functools.partial(_meet, percent=percent, size=size), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row.

    Texts with equal sets count as one; one of them, the smallest id, is hashed to bands. Members of a band's bucket
    are compared with a few of them, and then all that are still in different groups; pairs that signatures leave are
    verified on full sets, and links are joined to components.

    Null and empty texts, and those without words, have no shingles and are linked with nothing, as are null ids
    (component null). Rows with equal doc_id are one document, linked if any of their texts is; each gets a row. An
    empty table gives no rows; columns other than the two named are not read. A link at the threshold is missed with a
    probability of about 1e-5 (one above it with less); no two texts are linked that should not be. Pairs of a bucket
    that are in different groups and neither linked nor apart for sure are all verified, once each, and not told.
    """
    short_batches(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select("doc_id", F.xxhash64("text").alias("raw"), F.col("text").cast("binary").alias("text"))
    sets = materialise(two.mapInArrow(functools.partial(_sets, size=size), SETS), "sets")
    full = sets.where("n > 0 and doc_id is not null")
    first = F.min(F.struct("doc_id", "raw"))
    reps = materialise(full.groupBy("h1", "h2").agg(first.alias("first"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("keys").alias("keys")).select("h1", "h2", F.col("first.doc_id").alias("rep"), F.col("first.raw").alias("raw"), "n", "sig", "keys"), "representatives")
    members = materialise(crowded(reps), "members")
    tried = members.select("rep", F.explode("pivots").alias("pivot")).where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    x, y = (reps.select(F.col("rep").alias(c), F.col("sig").alias(f"sig_{c}")) for c in ("a", "b"))
    pairs = materialise(tried.join(x, "a").join(y, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(functools.partial(_possible, share=percent / 100), "a bigint, b bigint").distinct(), "pairs")
    links = linked(pairs, two.select("doc_id", "text"), percent, size)
    # rows of one doc_id with other texts are one document
    same = full.join(reps.select("h1", "h2", "rep"), ["h1", "h2"]).select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    twice = same.groupBy("b").agg(F.min("a").alias("a"), F.max("a").alias("z")).where("a <> z").select("a", "b")
    near = components(links.unionByName(twice.union(same.join(twice.select("b"), "b", "left_semi").select("a", "b"))))
    more = materialise(group_links(members, reps, near, two, percent, size), "links")
    release(docs.sparkSession, members, pairs)
    far = components(more).select(F.col("node").alias("component"), F.col("component").alias("further"))
    # groups that later links join take the name of their joint group
    label = near.join(far, "component", "full").select(F.coalesce("node", "component").alias("rep"), F.coalesce("further", "component").alias("component"))
    named = sets.join(reps.select("h1", "h2", "rep"), ["h1", "h2"], "left").join(label, "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
