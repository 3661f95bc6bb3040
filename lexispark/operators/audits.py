"""Audits of generated and rewritten rows: truncated audio, leaks of terms, what a rewrite changed, endpoints by price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds below the cap from which a clip counts as cut off.
MARGIN = 0.5


def is_truncated(duration: Column, cap: Column, margin: float = MARGIN) -> Column:
    """Whether a clip reaches the cap, but for the margin; a cap that is null, 0 or less cuts nothing off, and neither is
    a clip of unknown length cut off."""
    return F.coalesce((cap > 0) & (duration >= cap - margin), F.lit(False))


def leak_counts(rows: DataFrame, term: str, leaks: Column) -> DataFrame:
    """(term, texts, leaks) of the terms that leak; pre-aggregated on the map side."""
    return rows.groupBy(term).agg(F.count("*").alias("texts"), F.count_if(leaks).alias("leaks")).where("leaks > 0")


def change_counters(rows: DataFrame, old: Column, new: Column, leftover: Column, uncovered: Column) -> DataFrame:
    """One row: how many rows there are, how many a rewrite changed (nulls equal nulls), in how many something is left
    that it should have changed, and in how many a character isn't covered."""
    return rows.agg(F.count("*").alias("rows"), F.count_if(~old.eqNullSafe(new)).alias("changed"), F.count_if(leftover).alias("leftover"), F.count_if(uncovered).alias("uncovered"))


def cheapest_first(endpoints: DataFrame, price: Column, name: Column) -> DataFrame:
    """A table of endpoints (a few dozen) with the place of each by price, unknown prices last, ties by name."""
    return endpoints.withColumn("place", F.row_number().over(Window.orderBy(price.asc_nulls_last(), name)))
