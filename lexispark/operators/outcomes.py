"""What a recogniser made of the terms of a lexicon: outcomes by occurrence, reports by term, reports merged."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.french import fold
from ..functions.similarity import alignment
from . import relational as R

TOKEN = re.compile(r"[^\W\d_]+'|[^\W_]+(?:-[^\W_]+)*")
KIND = "array<struct<key:string,spelling:string,variant:string,target:string>>"


def tokens(text: str) -> list[str]:
    """Lower-case words; an elided article is a word of its own."""
    return TOKEN.findall(text.lower().replace("’", "'"))


def joined(words: list[str]) -> str:
    return " ".join(words).replace("' ", "'")


def heard_as(label: list[str], heard: list[str], at: int) -> tuple[list[str], int, int]:
    """The heard words that stand for label[at] in a replaced stretch, and the range of label words they cover: a
    neighbour of which half of the letters are inside them is covered as well."""
    if len(label) == 1:
        return heard, 0, 1
    place = lambda ws: [sum(len(w) + 1 for w in ws[:k]) for k in range(len(ws))]
    mine, theirs = place(label), place(heard)
    blocks = difflib.SequenceMatcher(a=" ".join(label), b=" ".join(heard), autojunk=False).get_matching_blocks()
    to = {b.a + k: b.b + k for b in blocks for k in range(b.size)}
    hit = [to[k] for k in range(mine[at], mine[at] + len(label[at])) if k in to]
    if not hit:
        return heard, at, at + 1
    some = [k for k, w in enumerate(heard) if theirs[k] <= max(hit) and theirs[k] + len(w) > min(hit)]
    low, high = theirs[some[0]], theirs[some[-1]] + len(heard[some[-1]]) - 1

    def swallowed(k: int) -> bool:
        letters = [mine[k] + c for c, x in enumerate(label[k]) if x not in "'-"]
        return 2 * sum(low <= to.get(c, -1) <= high for c in letters) >= len(letters)

    first, last = at, at + 1
    while first > 0 and swallowed(first - 1):
        first -= 1
    while last < len(label) and swallowed(last):
        last += 1
    return [heard[k] for k in some], first, last


def outcomes(label: str, heard: str, lexicon: frozenset[str]) -> list[dict]:
    """One row a lexicon word of the label: variant null if it was heard (up to accents, case or a hyphen), "" if it is
    missing, else what was heard; occurrences that hold the unknown word give none."""
    a, b, out = tokens(label), tokens(heard), []
    for kind, i, j, k, m in alignment(a, b) if any(fold(w) in lexicon for w in a) else []:
        for at in (x for x in range(i, j) if fold(a[x]) in lexicon):
            variant, target = None, a[at]
            if kind == "delete":
                variant = ""
            elif kind == "replace":
                span, low, high = heard_as(a[i:j], b[k:m], at - i)
                if "unk" in span:
                    continue
                variant, target = joined(span), joined(a[i + low : i + high])
                if re.sub("[- ]", " ", fold(variant)) == re.sub("[- ]", " ", fold(target)):
                    variant = None
            out.append({"key": fold(a[at]), "spelling": a[at], "variant": variant, "target": target})
    return out


def outcome_column(label: Column, heard: Column, lexicon: frozenset[str]) -> Column:
    """lexicon: a curated list that goes with the plan."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([outcomes(x or "", y or "", lexicon) for x, y in zip(a, b, strict=True)])

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, KIND)(label, heard)


def pair_up(hypotheses: DataFrame, manifest: DataFrame, order: str = "line") -> DataFrame:
    """Hypotheses with their labels by "folder/file": the first manifest row and the last hypothesis of a clip."""
    key = F.regexp_extract("audio", r"([^/]+/[^/]+)$", 1)
    h = R.keep_one(hypotheses.withColumn("clip", key), ["clip"], [F.desc(order)])
    m = R.keep_one(manifest.withColumn("clip", F.regexp_extract("audio_filepath", r"([^/]+/[^/]+)$", 1)), ["clip"], [F.col(order)])
    return h.select("clip", "hyp").join(m.select("clip", "text"), "clip")


def report(pairs: DataFrame, label: str, heard: str, lexicon: frozenset[str]) -> DataFrame:
    """(key, n_seen, n_correct, n_deleted, errors, targets, spelling), most errors first: maps from variants to counts and
    to their commonest targets."""
    rows = pairs.select(F.explode(outcome_column(F.col(label), F.col(heard), lexicon)).alias("o")).select("o.*")
    sums = rows.groupBy("key").agg(F.count("*").alias("n_seen"), F.count_if(F.col("variant").isNull()).alias("n_correct"), F.count_if(F.col("variant") == "").alias("n_deleted"), F.mode("spelling", True).alias("spelling"))
    wrong = rows.where("variant <> ''").groupBy("key", "variant", "target").agg(F.count("*").alias("n"))
    per = wrong.groupBy("key", "variant").agg(F.sum("n").alias("n"), F.max_by("target", F.struct("n", "target")).alias("target"))
    maps = per.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("variant", "n"))).alias("errors"), F.map_from_entries(F.collect_list(F.struct("variant", "target"))).alias("targets"), F.sum("n").alias("n_errors"))
    return sums.join(maps, "key", "left").na.fill(0, ["n_errors"]).orderBy(F.desc("n_errors"), "key")


def merged(reports: list[DataFrame]) -> DataFrame:
    """(key, variant, target, count, clips) over the reports of several recognisers: counts add up, clips are the most
    that one of them had."""
    each = [r.select("key", F.explode("errors").alias("variant", "n"), F.col("targets").alias("t")).select("key", "variant", F.element_at("t", F.col("variant")).alias("target"), "n") for r in reports]
    both = each[0]
    for e in each[1:]:
        both = both.unionByName(e)
    return both.groupBy("key", "variant", "target").agg(F.sum("n").alias("count"), F.max("n").alias("clips"))
