"""Connected components of a table of links, by DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import materialise, release


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of the links (a, b).

    In each round, nodes join their neighbour that comes first in an order of that round, or the one that this one
    joins, and the links are told anew between the nodes that are left: links grow fewer by a factor each round, whatever
    their shape and names, so that all rounds together read a few times the links. Each round is a written table; a
    node of many links sends few rows on, as minima are taken on the map side. Nothing is collected but whether links
    are left.
    """
    spark = links.sparkSession
    pairs = links.select("a", "b").union(links.select("b", "a")).where("a <> b")
    edges = materialise(pairs.distinct(), "links")
    label, turn = materialise(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct(), "labels"), 0
    while edges.limit(1).count():
        place = lambda c: F.xxhash64(c, F.lit(turn))  # noqa: B023, E731
        first = edges.groupBy("a").agg(F.min_by("b", place("b")).alias("b")).select("a", F.when(place("b") < place("a"), F.col("b")).otherwise(F.col("a")).alias("to"))
        step = materialise(first, "steps")
        ahead = step.select(F.col("a").alias("to"), F.col("to").alias("further"))
        goes = materialise(step.join(ahead, "to").select("a", F.col("further").alias("to")), "steps")
        ends = [goes.select(F.col("a").alias(c), F.col("to").alias(f"to_{c}")) for c in ("a", "b")]
        left = edges.join(ends[0], "a").join(ends[1], "b").where("to_a <> to_b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        fewer = materialise(left.distinct(), "links")
        moved = materialise(label.join(goes.select(F.col("a").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")
        release(spark, edges, label, step, goes)
        edges, label, turn = fewer, moved, turn + 1
    low = label.groupBy("root").agg(F.min("node").alias("component"))
    out = materialise(label.join(low, "root").select("node", "component"), "labels")
    release(spark, edges, label)
    return out
