"""Fuzzy line dedup: SimHash blocks, pigeonhole join, edit similarity, components.

A SimHash adds up random vectors of a line's words. Here each word's vector lies in one of a line's blocks of coordinates
(a sparse projection), so that an edit of one word moves at most two blocks, and of 2 k + 1 blocks k edits leave one as it
was: lines within k edits meet by joining on (block, value). Blocks are only tested for equality, so their totals are
compared and not the totals' signs, which would only merge values, more and more of them as the table grows. A block of
no word or one is no key, as lines that share it grow with the table and their pairs with its square. Of few blocks the
one left as it was may be such a block, but then both lines have one: lines with such a block are dealt to blocks once
more by other hashes, in up to ROUNDS rounds, and those with one in every round have their first k + 1 distinct words as
keys too, so that every pair at the limit is a candidate. Lines of many blocks and few different words have these words as
keys at once. Lines with many blocks leave out blocks of a word or two, which a common word would crowd: about 16 words
thrown at 17 blocks leave 6 as they were, and all of these are that small once in 100,000 pairs at the limit (of 9 blocks,
once in 10,000; in pairs below the limit, less).

Groups are wanted, not pairs. So each line of a key is first compared with a few lines of the key only, as many pairs as
lines; the groups that these links make are contracted, and all pairs of a key's lines that are still in different groups
follow. These are verified where they meet, so that not pairs but links are told, once for two groups. Candidates whose
parities of words in 256 cells differ in more than two cells an edit are further apart than the limit and go at once; the
others are verified by edit similarity.

All of it is DataFrame functions. Blocks are totals over exploded words, where a shuffle by line has already put a line's
words, so that these are never shuffled as rows. Shuffles of all lines and of all keys go in slices by hash and key, one
after the other, so that a slice of them is on disk at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._graph import components
from ._tables import materialise, release

#: Edit similarity (1 - distance / longer length, both in words) from which lines are linked; one edit is always allowed.
SIMILAR = 0.9
#: Words of a line that can be removed, and of one that is compared with others that aren't equal to it.
LEAST, FUZZY = 2, 9
#: Lines are blocked for each number of edits up to STEPS, then for numbers that grow by GROWTH.
STEPS, GROWTH = 8, 1.25
#: Words of a block that is a key: edits that a line is blocked for, from which so many are asked for.
FULL = ((8, 3), (0, 2))
#: Levels below this have pairs at the limit share a key for sure; of so many rounds of blocks at most.
SURE, ROUNDS = 4, 6
#: Lines of a key that each of its lines is compared with before groups are contracted, besides the one with most company.
PIVOTS = 2
#: Longs of a line's parities, of 64 cells each.
PARITIES = 4
#: Bytes of removed lines' places up to which they are broadcast; beyond, texts are shuffled to them.
BROADCAST = 32 << 20
#: Lines of a part of a key; of a larger key each two parts are compared in a cell of their own.
PART = 1024
#: Slices of a shuffle of all lines or keys, of which one at a time is on disk.
SLICES = 2
#: Slices of the cells where lines of different groups meet, as lines travel there with their letters, once a key.
CELL_SLICES = 4
#: Lines that have more than one in HEAVY of all places (fewer than HEAVY lines, so) are joined by broadcast.
HEAVY = 4096


#: What parts words once a text is in lower case, but line feeds.
BETWEEN = r"[\x00-\x09\x0B-/:-`{-\x7F]+"


def edits(words: Column, similar: float) -> Column:
    """Edits that a line of so many words may be away from one that isn't longer."""
    return F.greatest(F.lit(1), F.floor((1 - similar) * words + 1e-9).cast("int"))


def level(k: Column) -> Column:
    """The number of edits that pairs at k edits are blocked for. A line's own level and those of all longer lines that
    are similar to it are at most two, as these lines' edits are fewer than GROWTH times its own."""
    up = F.ceil(F.log(k / STEPS) / math.log(GROWTH) - 1e-9)
    return F.when(k <= STEPS, k).otherwise(F.ceil(STEPS * F.pow(F.lit(GROWTH), up) - 1e-6).cast("int"))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Row keys and texts: rows equal in id and text are one document."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("string").alias("doc"), F.xxhash64(F.col(id_col), text).alias("row"), text.alias("text"))


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, row, at, hash, words, norm): each line, the hash of its words, how many they are, and for lines of FUZZY
    words the words themselves, with a space between two. One pass without a shuffle."""
    plain = F.regexp_replace(F.lower("text"), BETWEEN, " ")
    lines = _rows(docs, id_col, text_col).select("doc", "row", F.posexplode(F.split(plain, "\n")).alias("at", "line")).withColumn("norm", F.trim("line"))
    words = F.when(F.col("norm") == "", 0).otherwise(F.octet_length("norm") - F.octet_length(F.replace("norm", F.lit(" "), F.lit(""))) + 1)
    named = lines.select("doc", "row", "at", F.xxhash64("norm").alias("hash"), words.alias("words"), "norm")
    return named.select("doc", "row", "at", "hash", "words", F.when(F.col("words") >= FUZZY, F.col("norm")).alias("norm"))


def _hashes(norm: str) -> Column:
    return F.transform(F.split(norm, " "), lambda w: F.xxhash64(w))


def _block(h: Column, k: Column, turn: Column) -> Column:
    """A word's block of 2 k + 1 in a round."""
    dealt = F.when(turn == 0, h).otherwise(F.xxhash64(h, turn))
    return F.shiftright(F.shiftrightunsigned(dealt, 33) * (2 * k + 1), 31).cast("int")


def _thin_rounds(h: Column, k: Column) -> Column:
    """How many rounds, from the first, have a block of fewer than two words, for fewer than 8 blocks; later rounds are
    not looked at."""
    bit = lambda x, r: F.call_function("shiftleft", F.lit(1), _block(x, k, r))
    # a byte of the blocks met and one of those met twice
    met = lambda r: F.aggregate(h, F.lit(0), lambda m, x: m.bitwiseOR(bit(x, r)).bitwiseOR(F.shiftleft(m.bitwiseAND(bit(x, r)), 8)))
    whole = F.call_function("shiftleft", F.lit(1), 2 * k + 1) - 1
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.lit(0), lambda n, r: F.when(n < r, n).when(F.shiftright(met(r), 8) == whole, n).otherwise(n + 1))


def block_keys(lines: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(hash, key): of each different line (hash, words, norm) a key for each of 2 k + 1 blocks that holds as many words
    as FULL says, by the level k, the block's number and the total of its words' hashes; k is the level of the line's own
    edits and that of the longest line that is similar to it. Lines of levels below SURE with a block of fewer than two
    words have a further round of blocks, up to ROUNDS, and words as keys after the last; so have lines of higher levels
    with fewer different words than twice their blocks: the other blocks may be all that two lines don't share. Lines are
    shuffled once, by hash, and their words not at all."""
    own, most = level(edits(F.col("words"), similar)), level(edits(F.floor(F.col("words") / similar + 1e-9), similar))
    once = lines.select("hash", "words", "norm").repartition("hash").dropDuplicates(["hash"])
    listed = once.select("hash", _hashes("norm").alias("h"), F.explode(F.array_distinct(F.array(own, most))).alias("k"))
    few = F.size(F.array_distinct("h")) < 2 * (2 * F.col("k") + 1)
    thin = F.when(F.col("k") < SURE, _thin_rounds(F.col("h"), F.col("k"))).when(few, ROUNDS).otherwise(0)
    last = F.when(F.col("k") < SURE, F.least("thin", F.lit(ROUNDS - 1))).otherwise(0)
    # the words that are keys are a round of their own, -1
    turns = F.sequence(F.when(F.col("thin") == ROUNDS, -1).otherwise(0), last)
    dealt = listed.withColumn("thin", thin).select("hash", "k", "h", F.explode(turns).alias("turn"))
    first = F.slice(F.array_sort(F.array_distinct("h")), 1, F.col("k") + 1)
    words = dealt.select("hash", "k", "turn", F.explode(F.when(F.col("turn") < 0, first).otherwise(F.col("h"))).alias("h"))
    # they are blocks of their own, with negative numbers; later rounds have at most 8 blocks
    number = F.when(F.col("turn") < 0, -1 - F.shiftrightunsigned("h", 1)).otherwise(8 * F.col("turn") + _block(F.col("h"), F.col("k"), F.col("turn")))
    full = F.lit(FULL[-1][1])
    for least, held in reversed(FULL[:-1]):
        full = F.when(F.col("k") >= least, held).otherwise(full)
    # a sum of whole hashes could overflow, and words met twice are lost from an exclusive or
    sums = [F.bit_xor("h").alias("odd"), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("total"), F.count("*").alias("held")]
    totals = words.select("hash", "k", number.alias("block"), "h").groupBy("hash", "k", "block").agg(*sums)
    return totals.where((F.col("block") < 0) | (F.col("held") >= full)).select("hash", F.xxhash64("k", F.greatest("block", F.lit(-1).cast("bigint")), "odd", "total").alias("key"))


def crowded(keys: DataFrame) -> DataFrame:
    """(key, hash, lines): the rows of keys that several lines have, and how many these are."""
    dealt = keys.repartition("key")
    # by hash, so that both sides of the join read the same columns, and so one shuffle
    several = dealt.groupBy("key").agg(F.count("hash").alias("lines"), F.min("hash").alias("low"), F.max("hash").alias("high")).where("low < high").select("key", "lines")
    return dealt.join(several.hint("shuffle_hash"), "key").select("key", "hash", "lines")


def line_words(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(hash, words, parity0.., letters) of the wanted hashes' lines: the parity of words in cells, and the line as a
    string of one character for each word (its hash, out of a million), so that an edit distance of such strings counts
    words."""
    found = lines.select("hash", "words", "norm").join(wanted, "hash", "left_semi").dropDuplicates(["hash"]).select("hash", "words", _hashes("norm").alias("h"))
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(x, 2).bitwiseAND(F.lit(63)).cast("int"))
    parity = lambda j: F.aggregate("h", F.lit(0).cast("bigint"), lambda p, x: F.when(F.pmod(x, F.lit(PARITIES)) == j, p.bitwiseXOR(bit(x))).otherwise(p))
    cells = [parity(j).alias(f"parity{j}") for j in range(PARITIES)]
    code = F.array_join(F.transform("h", lambda x: F.lpad(F.hex(F.shiftrightunsigned(x, 8).bitwiseAND(F.lit(0xFFFFF)) + 0x10000), 8, "0")), "")
    return found.select("hash", "words", *cells, F.decode(F.unhex(code), "UTF-32").alias("letters"))


FACTS = ["words", *[f"parity{j}" for j in range(PARITIES)]]


def _may_link(similar: float, a: str = "_a", b: str = "_b") -> Column:
    """Whether two lines' numbers of words and parities let them be similar."""
    words = [F.col(f"words{x}") for x in (a, b)]
    most = edits(F.greatest(*words), similar)
    odd = sum((F.bit_count(F.col(f"parity{j}{a}").bitwiseXOR(F.col(f"parity{j}{b}"))) for j in range(PARITIES)), F.lit(0))
    apart = F.abs(words[0] - words[1])  # so many edits at least add or take a word, and change one cell, not two
    return (apart <= most) & (odd + apart <= 2 * most)


def _sided(df: DataFrame, side: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keep, *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c not in keep])


def star_pairs(keys: DataFrame) -> DataFrame:
    """(a, b): each line of a key with the line of it that has most company in all its keys, and with PIVOTS more."""
    company = keys.groupBy("hash").agg(F.sum("lines").alias("company"))
    pivots = [F.max_by("hash", "company"), *[F.max_by("hash", F.xxhash64("hash", F.lit(k))) for k in range(PIVOTS)]]
    stars = keys.join(company, "hash").groupBy("key").agg(F.array_distinct(F.array(*pivots)).alias("pivots"))
    met = keys.join(stars, "key").select("hash", F.explode("pivots").alias("pivot")).where("hash <> pivot")
    return met.select(F.least("hash", "pivot").alias("a"), F.greatest("hash", "pivot").alias("b")).distinct()


def within_edits(x: Column, y: Column, similar: float) -> Column:
    """Whether the edit similarity reaches the limit; the distance is only followed up to it."""
    nx, ny = F.char_length(x), F.char_length(y)
    most = edits(F.greatest(nx, ny), similar)
    return (F.abs(nx - ny) <= most) & (F.call_function("levenshtein", x, y, most) >= 0)


def group_links(keys: DataFrame, norms: DataFrame, label: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(a, b): the groups of label (node, component), a line without one being its own, that have similar lines sharing
    a key. All pairs of a key's lines in different groups are compared, where they meet.

    The lines of a key meet in cells of two parts of at most PART lines, so a key of many lines is spread over tasks.
    """
    named = keys.join(label.withColumnRenamed("node", "hash"), "hash", "left").select("key", "hash", F.coalesce("component", "hash").alias("group"))
    several = named.groupBy("key").agg(F.count("*").alias("lines"), F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("key", F.ceil(F.col("lines") / PART).alias("parts"))
    dealt = named.join(several, "key").join(norms.select("hash", *FACTS, "letters"), "hash").withColumn("part", F.pmod(F.xxhash64("hash"), "parts"))
    cell = lambda k: F.least(k, F.col("part")) * F.col("parts") + F.greatest(k, F.col("part"))
    cells = dealt.select("key", "hash", *FACTS, "letters", "group", "part", F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1), cell)).alias("cell"), (F.col("part") * F.col("parts") + F.col("part")).alias("own"))
    both = _sided(cells, "a", ("key", "cell")).join(_sided(cells, "b", ("key", "cell")), ["key", "cell"])
    # lines of one part meet in its own cell; both sides are asked for the same columns, and so read one shuffle
    once = (F.col("part_a") != F.col("part_b")) | (F.col("cell") == F.greatest("own_a", "own_b"))
    met = both.where((F.col("hash_a") < F.col("hash_b")) & (F.col("group_a") != F.col("group_b")) & once & _may_link(similar) & within_edits(F.col("letters_a"), F.col("letters_b"), similar))
    return met.select(F.least("group_a", "group_b").alias("a"), F.greatest("group_a", "group_b").alias("b")).distinct()


def possible(pairs: DataFrame, norms: DataFrame, similar: float) -> DataFrame:
    """The pairs whose lines may be similar, by numbers of words and parities; no line travels for them."""
    x, y = (_sided(norms.select(F.col("hash").alias(s), *FACTS), s, (s,)) for s in ("a", "b"))
    return pairs.join(x, "a").join(y, "b").where(_may_link(similar)).select("a", "b")


def linked(pairs: DataFrame, norms: DataFrame, similar: float) -> DataFrame:
    """The pairs whose lines are similar."""
    x, y = (norms.select(F.col("hash").alias(s), F.col("letters").alias(f"letters_{s}")) for s in ("a", "b"))
    return pairs.join(x, "a").join(y, "b").where(within_edits(F.col("letters_a"), F.col("letters_b"), similar)).select(*pairs.columns)


def _sliced(df: DataFrame, column: str, make: Callable[[DataFrame], DataFrame], name: str, slices: int = SLICES) -> DataFrame:
    """make of df, for which rows of equal values of the column are enough, as written tables of slices of the values."""
    out = []
    for k in range(slices):
        out.append(materialise(make(df.where(F.pmod(F.xxhash64(column), F.lit(slices)) == k)), name))
        release(df.sparkSession)
    folders = sorted({f.rsplit("/", 1)[0] for part in out for f in part.inputFiles()})
    return df.sparkSession.read.schema(out[0].schema).parquet(*folders) if folders else out[0]


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(doc, row, gone): the positions of each document's lines that go, because their group's first line stays. A written
    table; those on the way to it are deleted."""
    spark = docs.sparkSession
    table = materialise(line_table(docs, id_col, text_col).where(F.col("words") >= LEAST), "line-places")
    fuzzy = table.where("norm is not null")
    told = _sliced(fuzzy, "hash", lambda some: block_keys(some, similar), "line-blocks")
    keys = _sliced(told, "key", crowded, "line-keys")
    release(spark, told)
    wanted = materialise(keys.select("hash").distinct(), "line-wanted")
    norms = _sliced(fuzzy, "hash", lambda some: line_words(some, wanted), "line-words")
    release(spark, wanted)
    # the words are most of the table and have served
    places = materialise(table.select("doc", "row", "at", "hash"), "line-places")
    release(spark, table)
    # in two steps, so that the shuffles of keys are gone when those of pairs begin
    starred = materialise(star_pairs(keys), "line-stars")
    release(spark)
    tried = materialise(possible(starred, norms, similar), "line-pairs")
    release(spark, starred)
    stars = materialise(linked(tried, norms, similar), "line-links")
    release(spark, tried)
    near = components(stars)
    more = _sliced(keys, "key", lambda some: group_links(some, norms, near, similar), "line-links", CELL_SLICES)
    release(spark, keys, norms, stars)
    far = components(more).select(F.col("node").alias("component"), F.col("component").alias("further"))
    # groups that later links join take the name of their joint group
    label = materialise(near.join(far, "component", "full").select(F.coalesce("node", "component").alias("hash"), F.coalesce("further", "component").alias("component")), "labels")
    place = F.struct("doc", "row", "at")
    kinds = materialise(places.groupBy("hash").agg(F.min(place).alias("first"), F.count("*").alias("times")), "line-kinds")
    grouped = kinds.join(label, "hash", "left").where("times > 1 or component is not null").withColumn("group", F.coalesce("component", "hash"))
    owner = grouped.groupBy("group").agg(F.min("first").alias("owner"))
    owned = materialise(grouped.select("hash", "times", "group").join(owner, "group").select("hash", "times", "owner"), "line-owners")
    total = kinds.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    often = F.col("times") * HEAVY > total
    heavy = F.broadcast(owned.where(often).select("hash", "owner"))
    rest = places.join(heavy.select("hash"), "hash", "left_anti").join(owned.where(~often).select("hash", "owner"), "hash")
    gone = places.join(heavy, "hash").unionByName(rest).where(~place.eqNullSafe(F.col("owner")))
    out = materialise(gone.groupBy("doc", "row").agg(F.collect_set("at").alias("gone")), "line-gone")
    release(spark, places, kinds, more, near, label, owned)
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """docs with repeated lines taken out of their texts, and _n_lines and _n_gone beside.

    Lines are equal when their words are, and linked when these differ by few edits; of each connected group over the
    whole table the first line stays, by id (as a string), row and position. Lines of fewer than LEAST words stay, and
    lines of fewer than FUZZY words are in a group with equal ones only. Words are runs of ASCII letters
    and digits and of other characters, lower-cased; they are compared by hashes, of 20 bits when edits are counted and of
    64 bits otherwise. Null and empty texts stay as they are; a text may become empty, but no row
    goes. Rows equal in id and text are one document and come out alike; null ids sort first; an empty table gives no
    rows. Columns of docs stay, except those beginning with _n_ or named _doc, _row and _gone.
    """
    own = docs.drop("_n_lines", "_n_gone", "_doc", "_row", "_gone")
    gone = removed_lines(docs, id_col, text_col, similar).select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), F.col("gone").alias("_gone"))
    text = F.col(text_col).cast("string")
    keyed = own.withColumn("_k", F.xxhash64(F.col(id_col), text))
    size = gone.agg(F.coalesce(F.sum(F.length("_doc") + 8 * F.size("_gone") + 64), F.lit(0))).first()[0]
    joined = keyed.join(F.broadcast(gone) if size <= BROADCAST else gone.hint("merge"), (keyed["_k"] == gone["_row"]) & F.col(id_col).cast("string").eqNullSafe(gone["_doc"]), "left")
    lines = F.split(text, "\n")
    kept = F.array_join(F.filter(lines, lambda _, k: ~F.array_contains("_gone", k)), "\n")
    return joined.select(*[F.when(F.col("_gone").isNull(), text).otherwise(kept).alias(c) if c == text_col else F.col(c) for c in own.columns], F.coalesce(F.when(text.isNotNull(), F.size(lines)), F.lit(0)).alias("_n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).alias("_n_gone"))
