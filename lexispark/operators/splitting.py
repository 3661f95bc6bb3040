"""Train, validation and test splits that keep groups together and balance durations."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("train", "val", "test")


def parse_ratios(text: str) -> dict[str, float]:
    """ "80/10/10" as shares; three non-negative numbers with a positive sum."""
    parts = [float(x) for x in text.replace(":", "/").replace(",", "/").split("/")]
    if len(parts) != 3 or min(parts) < 0 or sum(parts) <= 0:
        raise ValueError("a split is three non-negative numbers with a positive sum")
    return {s: p / sum(parts) for s, p in zip(SPLITS, parts, strict=True)}


class Filler:
    """Gives each piece to the split that is furthest below its share."""

    def __init__(self, ratios: dict[str, float]):
        self.ratios, self.held = ratios, dict.fromkeys(SPLITS, 0.0)
        self.enabled = [s for s in SPLITS if ratios[s] > 0]

    def give(self, weight: float, among: list[str] | None = None) -> str:
        split = min(among or self.enabled, key=lambda s: (self.held[s] / self.ratios[s], SPLITS.index(s)))
        self.held[split] += weight
        return split

    def group(self, mode: str, weights: list[float], strict: bool) -> list[str]:
        """Splits of a group's rows, heaviest first: one for an atomic group; else the required splits first."""
        if len(weights) == 1:
            return [self.give(weights[0])]
        if mode == "atomic":
            split = self.give(0.0)
            self.held[split] += sum(weights)
            return [split] * len(weights)
        need = list(self.enabled) if strict and len(weights) >= 3 else [s for s in ("train", self.enabled[0]) if s in self.enabled][:1]
        out = []
        for w in weights:
            out.append(self.give(w, need or None))
            if need:
                need.remove(out[-1])
        return out


def assign(rows: DataFrame, ratios: dict[str, float], key: str, group: str = "group_id", mode: str = "group_mode", weight: str = "duration", strict: bool = True, stratify: bool = True) -> DataFrame:
    """(key, split): groups by their weights, largest first, ties by their names; rows in a group likewise, by the key.

    The choice is sequential over groups, so each group is reduced to one row (its rows' weights) and only those go to
    one task, as a stream in order: a corpus of N clips sends its groups' sizes, not its clips. Where even that is too
    much, salt: split the groups by a hash and run this in each part, which balances as well.
    """
    own = F.col(group) if stratify else F.col(key).cast("string")
    w = F.col(weight).cast("double")
    rank = F.array_sort(F.collect_list(F.struct((-w).alias("w"), F.col(key).alias("key"))))
    groups = rows.groupBy(own.alias("g")).agg(F.max(F.col(mode) if stratify else F.lit("distribute")).alias("mode"), rank.alias("rows"), F.sum(w).alias("total"))
    order = groups.orderBy(F.desc("total"), F.col("g").cast("string")).select("g", "mode", F.transform("rows", lambda r: -r["w"]).alias("weights")).coalesce(1)

    def fill(batches):
        filler = Filler(ratios)
        for pdf in batches:
            yield pd.DataFrame({"g": pdf["g"], "splits": [filler.group(m, list(ws), strict) for m, ws in zip(pdf["mode"], pdf["weights"], strict=True)]})

    kind = dict(groups.dtypes)["g"]
    splits = order.mapInPandas(fill, f"g {kind}, splits array<string>")
    placed = groups.select("g", F.transform("rows", lambda r: r["key"]).alias("keys")).join(splits, "g")
    return placed.select(F.explode(F.arrays_zip("keys", "splits")).alias("x")).select(F.col("x.keys").alias(key), F.col("x.splits").alias("split"))


def hashed(rows: DataFrame, ratios: dict[str, float], group: str, seed: int = 0) -> DataFrame:
    """The approximate, fully parallel way: a group's split by its hash."""
    u = F.pmod(F.xxhash64(F.lit(seed), group), F.lit(1 << 20)) / float(1 << 20)
    return rows.withColumn("split", F.when(u < ratios["train"], "train").when(u < ratios["train"] + ratios["val"], "val").otherwise("test"))


def summary(labelled: DataFrame, weight: str = "duration") -> DataFrame:
    """(split, n, total, percents) with a row for every split, empty ones too."""
    every = labelled.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    counts = labelled.groupBy("split").agg(F.count("*").alias("n"), F.sum(weight).alias("total"))
    out = every.join(counts, "split", "left").na.fill(0)
    whole = Window.partitionBy()
    part = lambda c: F.coalesce(100.0 * F.col(c) / F.nullif(F.sum(c).over(whole), F.lit(0)), F.lit(0.0))
    return out.withColumn("n_percent", part("n")).withColumn("total_percent", part("total"))
