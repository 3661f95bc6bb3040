"""Joins, aggregates, windows and sorts with the corpus rules for duplicates, misses and ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in order (first wins; order descending for last wins)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def enrich(left: DataFrame, index: DataFrame, key: str, order: list[Column], fill: str = "") -> DataFrame:
    """Left join with an index of which the last row of a key counts; missing text becomes fill."""
    last = keep_one(index, [key], order)
    added = [c for c in index.columns if c != key]
    return left.join(last, key, "left").na.fill(fill, added)


def full_volumes(a: DataFrame, b: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """Full outer join of two volumes: a missing side is 0; total and whether only the right side has the key."""
    both = a.join(b, keys, "full").na.fill(0, [left, right])
    return both.withColumn("total", F.col(left) + F.col(right)).withColumn("right_only", F.col(left) == 0)


def union_sets(a: Column, b: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(a, none), F.coalesce(b, none)))


def containment(df: DataFrame, text: str, vocabulary: DataFrame, word: str) -> DataFrame:
    """df with the smallest vocabulary word inside the text as witness, or null.

    The words of a text's own substrings can't be enumerated, so the vocabulary is collected into one array
    literal row by a one-row aggregate; it is a curated list (a few thousand words) and its size is checked.
    """
    if vocabulary.select(word).distinct().count() > 100_000:
        raise ValueError("the vocabulary is too large for a containment join")
    words = vocabulary.agg(F.array_sort(F.collect_set(word)).alias("_words"))
    inside = F.get(F.filter("_words", lambda w: F.contains(F.col(text), w)), F.lit(0))
    return df.crossJoin(F.broadcast(words)).withColumn("witness", inside).drop("_words")


def min_max_score(df: DataFrame, value: str, top: int = 10) -> DataFrame:
    """score = round half even of top * (ln value - least) / span over the whole table; top where the span is 0."""
    edges = df.agg(F.min(F.log(value)).alias("_lo"), F.max(F.log(value)).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    score = F.when(span == 0, F.lit(top)).otherwise(F.bround(top * (F.log(value) - F.col("_lo")) / span).cast("int"))
    return df.crossJoin(F.broadcast(edges)).withColumn("score", score.cast("int")).drop("_lo", "_hi")


def fixed_histogram(df: DataFrame, value: str, low: int, high: int) -> DataFrame:
    """(bucket, n) for every whole number from low to high, empty ones too."""
    every = df.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("bucket"))
    counts = df.groupBy(F.col(value).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    return every.join(counts, "bucket", "left").na.fill(0, ["n"])


def edge_bucket(value: Column, edges: list[float]) -> Column:
    """The number of the half-open bucket [edge, next edge); the last one is open."""
    out = F.lit(None).cast("int")
    for k, e in enumerate(edges):
        out = F.when(value >= e, k).otherwise(out)
    return out


def summary(value: str) -> list[Column]:
    """Count, mean, median, sample deviation (0 for one row), extremes and exact interpolated deciles."""
    return [
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.percentile(value, F.lit(0.5)).alias("median"),
        F.when(F.count(value) > 0, F.coalesce(F.stddev_samp(value), F.lit(0.0))).alias("std"), F.min(value).alias("least"), F.max(value).alias("most"),
        F.percentile(value, F.lit(0.1)).alias("p10"), F.percentile(value, F.lit(0.9)).alias("p90"),
    ]


def ceiling(df: DataFrame, group: str, value: str, within: float = 0.08, share: float = 0.002) -> DataFrame:
    """The largest value of a group, how many rows lie within a step of it, and whether that looks like a cap."""
    top = df.groupBy(group).agg(F.max(value).alias("most"), F.count("*").alias("rows"))
    near = df.join(top, group).groupBy(group, "most", "rows").agg(F.count_if(F.col(value) >= F.col("most") - within).alias("at_most"))
    part = F.col("at_most") / F.col("rows")
    return near.withColumn("share", part).withColumn("capped", (F.col("at_most") > 1) & (part >= share))


def range_policy(df: DataFrame, value: str, policy: list[tuple[int, int, int]]) -> DataFrame:
    """n by the range that holds the value; 0 where none does. Ranges may not overlap."""
    seen: set[int] = set()
    for low, high, n in policy:
        span = set(range(low, high + 1))
        if n <= 0 or not span or span & seen:
            raise ValueError("ranges must not be empty or overlap, and their numbers must be positive")
        seen |= span
    out = F.lit(0)
    for low, high, n in policy:
        out = F.when(F.col(value).between(low, high), n).otherwise(out)
    return df.withColumn("n_variants", out)


def missing_and_extra(covered: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Whole numbers of a range that are not covered, and covered ones outside it."""
    want = covered.sparkSession.range(low, high + 1).select(F.col("id").cast("bigint").alias("value"))
    have = covered.select(F.col(column).cast("bigint").alias("value")).distinct()
    return want.exceptAll(have).withColumn("problem", F.lit("missing")).unionByName(have.exceptAll(want).withColumn("problem", F.lit("extra")))


def merge_state(rows: DataFrame, state: DataFrame, key: str, label: str, carried: list[str]) -> DataFrame:
    """rows with the carried columns of a prior state of the same key and label; another label makes the prior stale."""
    prior = state.select(key, F.col(label).alias("_label"), F.lit(True).alias("_had"), *carried)
    same = F.col("_label").eqNullSafe(F.col(label))
    out = rows.drop(*carried).join(prior, key, "left")
    kept = [F.when(same & F.col("_had"), F.col(c)).alias(c) for c in carried]
    return out.select(*[c for c in rows.columns if c not in carried], *kept, (F.coalesce(F.col("_had"), F.lit(False)) & ~same).alias("stale"))


def update_if_moved(rows: DataFrame, news: DataFrame, key: str, value: str, tolerance: float) -> DataFrame:
    """value replaced by news' value where it differs by more than the tolerance."""
    new = news.select(key, F.col(value).alias("_new"))
    moved = F.coalesce(F.abs(F.col("_new") - F.col(value)) > tolerance, F.lit(False))
    return rows.join(new, key, "left").withColumn("changed", moved).withColumn(value, F.when(moved, F.col("_new")).otherwise(F.col(value))).drop("_new")


def sync_labels(rows: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Left join that fails on a row without a label."""
    return rows.join(labels, key, "left").withColumn(label, F.when(F.col(label).isNull(), F.raise_error(F.concat(F.lit("no label for "), F.col(key).cast("string"))).cast("string")).otherwise(F.col(label)))


def drift(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of the tables has, as often as it has them more."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def pending(rows: DataFrame, done: DataFrame, key: str, wanted: str) -> DataFrame:
    """Rows of which fewer results than wanted exist, with how many are left."""
    have = done.groupBy(key).agg(F.count("*").alias("_have"))
    left = F.col(wanted) - F.coalesce("_have", F.lit(0))
    return rows.join(have, key, "left").withColumn("left_to_do", left).where("left_to_do > 0").drop("_have")


def limit_flag(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """in_scope for the first rows by order; the others stay, so that their cost is still counted.

    The first limit rows come from a top-k (no full sort); limit is a setting of a run, so they are few.
    """
    first = rows.orderBy(*order).limit(limit).select(*rows.columns, F.lit(True).alias("in_scope"))
    return rows.join(first, rows.columns, "left").na.fill(False, ["in_scope"])


def sample(df: DataFrame, by: list[str], key: str, k: int, seed: int) -> DataFrame:
    """k rows of each group in the order of a seeded hash: a sample that reads once and repeats exactly."""
    w = Window.partitionBy(*by).orderBy(F.xxhash64(F.lit(seed), key), key)
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= k).drop("_nth")


def shard_plan(df: DataFrame, key: str, per: int) -> DataFrame:
    """(shard, first, last, n): ceil(rows / per) shards of nearly equal size in the order of the key.

    No task orders the whole table.
    """
    per_shard = F.ceil(F.col("total") / F.ceil(F.col("total") / per))
    placed = number_rows(df.select(key), key).withColumn("shard", F.floor((F.col("position") - 1) / per_shard).cast("int"))
    return placed.groupBy("shard").agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("n"))


def number_rows(df: DataFrame, key: str, ranges: int = 256) -> DataFrame:
    """position (from 1) and total in the order of a unique numeric key, by two levels: the sizes of key ranges between
    approximate quantiles, and places within a range. Range numbers are plain expressions, so every reading agrees."""
    cuts = sorted(set(df.approxQuantile(key, [k / ranges for k in range(1, ranges)], 0.002)))
    part = F.lit(0)
    if cuts:
        part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(key)))
    parted = df.withColumn("_part", part)
    sizes = parted.groupBy("_part").agg(F.count("*").alias("_n"))
    whole = Window.orderBy("_part")  # over at most as many rows as there are ranges
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum("_n").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    return parted.join(F.broadcast(before.drop("_n")), "_part").withColumn("position", F.col("_before") + place).drop("_part", "_before")
