"""Batch rules of generated texts: each batch gets the first reason that any of its texts gives."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import similarity

CLONE, OPENING, LEAKED, HEAD = 90, 85, 85, 80
ORDER = ("length", "incomplete", "duplicate", "near_clone", "refusal", "english", "example_leak", "forbidden_char", "uncovered_char", "unit_symbol", "white_space", "shared_opening")


def batch_reasons(texts: list[str], examples: list[str]) -> list[str]:
    """What compares the texts of one batch (a handful) with each other and with the examples."""
    low = [t.lower() for t in texts]
    pairs = [(i, j) for j in range(len(low)) for i in range(j)]
    leak = lambda e, t: (similarity.partial_ratio(e, t) + similarity.ratio(e, t)) / 2 >= LEAKED
    found = {
        "duplicate": len(set(texts)) < len(texts), "near_clone": any(similarity.ratio(low[i], low[j]) >= CLONE for i, j in pairs),
        "example_leak": any(leak(e.lower(), t) for t in low for e in examples), "shared_opening": any(similarity.ratio(low[i][:HEAD], low[j][:HEAD]) >= OPENING for i, j in pairs),
    }
    return [r for r, holds in found.items() if holds]


def validate(rows: DataFrame, batch: str, text: str, examples: str | None = None, alphabet: list[str] | None = None) -> DataFrame:
    """(batch, reason): the first failing rule in ORDER, null for a batch that passes."""
    single = rows.select(batch, F.col(text).alias("t"), C.text_reason(F.col(text), alphabet).alias("r"), F.col(examples).alias("e") if examples else F.array().cast("array<string>").alias("e"))
    grouped = single.groupBy(batch).agg(F.sort_array(F.collect_list("t")).alias("texts"), F.collect_set("r").alias("reasons"), F.array_distinct(F.flatten(F.collect_set("e"))).alias("examples"))

    def run(texts, examples):
        return pd.Series([batch_reasons(list(a), list(b)) for a, b in zip(texts, examples, strict=True)])

    run.__annotations__ = {"texts": pd.Series, "examples": pd.Series, "return": pd.Series}
    every = F.concat("reasons", F.pandas_udf(run, "array<string>")("texts", "examples"))
    ordered = F.filter(F.array(*map(F.lit, ORDER)), lambda o: F.array_contains(F.col("every"), o))
    return grouped.withColumn("every", every).select(batch, F.get(ordered, F.lit(0)).alias("reason"))


def problems(rows: DataFrame, required: list[str]) -> DataFrame:
    """rows with the names of their required columns that are null or blank."""
    missing = F.array_compact(F.array(*[F.when(F.coalesce(C.strip(F.col(c).cast("string")), F.lit("")) == "", c) for c in required]))
    return rows.withColumn("missing", missing)


def write_if_valid(rows: DataFrame, bad: DataFrame, write) -> bool:
    """Calls write(rows) unless there is a bad row."""
    if bad.isEmpty():
        write(rows)
        return True
    return False
