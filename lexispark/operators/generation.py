"""Generated variants: policies, planning, resuming, providers and the call ledger. Nothing here reaches a network."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from . import relational as R

#: Attempts of one call at most; from this attempt on the last failure is pointed out.
ATTEMPTS, FOCUS = 5, 4
#: Calls before the ratio of answer to prompt is taken from the ledger; until then these are used.
WARM_UP, RATIO, TOKENS = 3, 1.15, 1500.0


class Provider(Protocol):
    """Answers requests (key, attempt, prompt) with (key, attempt, answer, error). A pure function of a table."""

    def __call__(self, requests: DataFrame) -> DataFrame: ...


class Replay:
    """Answers from a recorded table (key, attempt, answer); what was not recorded is an error."""

    def __init__(self, recorded: DataFrame):
        self.recorded = recorded

    def __call__(self, requests: DataFrame) -> DataFrame:
        out = requests.join(self.recorded.select("key", "attempt", "answer"), ["key", "attempt"], "left")
        return out.select("key", "attempt", "answer", F.when(F.col("answer").isNull(), "not recorded").alias("error"))


def plan(terms: DataFrame, policy: list[tuple[int, int, int]], done: DataFrame, key: str = "index", score: str = "score", skip: Column | None = None) -> DataFrame:
    """Terms with how many variants are still wanted: valid scores, a range of the policy, not skipped, not done."""
    number = F.col(score).try_cast("int")
    wanted = R.range_policy(terms.where(number.between(0, 10)).withColumn(score, number), score, policy).where("n_variants > 0")
    wanted = wanted.where(~F.coalesce(skip, F.lit(False))) if skip is not None else wanted
    return R.pending(wanted, done, key, "n_variants")


def bad_scores(terms: DataFrame, score: str = "score") -> DataFrame:
    """Terms whose score is missing, no whole number, or outside 0 to 10."""
    number = F.col(score).try_cast("double")
    return terms.where(number.isNull() | (number != F.floor(number)) | ~number.between(0, 10))


def prompt(parts: list[tuple[str, Column]]) -> Column:
    """Tagged parts, one a line, those that are null or empty left out; what is common to all comes first, so that a
    provider can keep the prefix."""
    tagged = [F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"<{t}>"), c, F.lit(f"</{t}>"))) for t, c in parts]
    return F.array_join(F.array_compact(F.array(*tagged)), "\n")


def rows(answers: DataFrame, key: str = "key", tag: str = "t") -> DataFrame:
    """(key, variant_index, target, source): the blocks of each answer, and how each is read aloud."""
    out = answers.select(key, F.posexplode(C.blocks(C.without_reasoning(F.col("answer")), tag)).alias("variant_index", "target"))
    return out.withColumn("source", C.spoken_form(F.col("target")))


def run(pending: DataFrame, provider: Provider, build: Callable[[Column, Column], Column], reason: Callable[[DataFrame], Column], key: str = "key") -> tuple[DataFrame, DataFrame]:
    """(accepted, failed): each key is asked until an answer has no reason against it, ATTEMPTS times at most.

    build(attempt, last reason) is the prompt, reason(answers) the column of the first failing rule. Every attempt is a
    join over the keys still open; what an attempt gave is checkpointed, as a provider must not be asked twice.
    """
    open_ = pending.withColumn("last", F.lit(None).cast("string"))
    kept, failed = None, None
    for attempt in range(1, ATTEMPTS + 1):
        asked = open_.select(F.col(key).alias("key"), F.lit(attempt).alias("attempt"), build(F.lit(attempt), F.col("last")).alias("prompt"))
        told = provider(asked)
        told = told.withColumn("reason", F.coalesce("error", reason(told))).checkpoint()
        fine = told.where("reason is null").select("key", "attempt", "answer")
        kept = fine if kept is None else kept.unionByName(fine)
        failed = told.where("reason is not null").select("key", "attempt", "reason")
        open_ = pending.join(failed.select(F.col("key").alias(key), F.col("reason").alias("last")), key)
        if failed.isEmpty():
            break
    return kept, failed


def response_reason(finish: Column, content: Column) -> Column:
    """Why a response can't be used: cut off, refused, another ending, or empty."""
    return F.when(finish == "length", "truncated").when(~finish.isin("stop", "end_turn") & finish.isNotNull(), F.concat(F.lit("finish_"), finish)).when(F.coalesce(C.strip(content), F.lit("")) == "", "empty")


def ledger(calls: DataFrame, planned: DataFrame) -> DataFrame:
    """One row: tokens and cost so far, and the projection over what is planned (prompt_tokens)."""
    sums = calls.agg(F.count("*").alias("calls"), F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"), F.coalesce(F.sum("answer_tokens"), F.lit(0)).alias("answer_tokens"), F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost"))
    left = planned.agg(F.count("*").alias("left"), F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("left_prompt"))
    warm = F.col("calls") >= WARM_UP
    each = F.when(warm, F.col("answer_tokens") / F.col("calls")).otherwise(F.lit(TOKENS))
    price = F.when(warm & (F.col("prompt_tokens") > 0), F.col("cost") / (F.col("prompt_tokens") + F.col("answer_tokens")))
    both = sums.crossJoin(F.broadcast(left))  # one row each
    expected = F.col("left_prompt") * F.when(warm, F.lit(1.0)).otherwise(F.lit(RATIO)) + F.col("left") * each
    return both.withColumn("left_tokens", expected).withColumn("left_cost", expected * price)


def fix_terms(tables: dict[str, DataFrame], review: DataFrame, key: str = "term_index") -> dict[str, DataFrame]:
    """The tables less every row of a reviewed term that is dropped or renamed, so that it is generated anew."""
    gone = review.where("action in ('drop', 'rename')").select(key).distinct()
    return {name: df.join(gone, key, "left_anti") for name, df in tables.items()}


def classify_review(review: DataFrame, terms: DataFrame, key: str = "term_index") -> DataFrame:
    """review (key, proposed) with an action: drop (nothing proposed, or another term has the name), keep (already so),
    skip (no such term) or rename; and the first other owner of the name."""
    now = terms.select(key, F.col("term").alias("current")).distinct()
    rows_ = review.select(key, "proposed").distinct().join(now, key, "left")
    # of a name's owners the first two are enough, as a term is one of them at most
    nth = F.dense_rank().over(Window.partitionBy("proposed").orderBy("_o"))
    named = terms.select(F.col("term").alias("proposed"), F.col(key).alias("_o")).dropna()
    owners = named.withColumn("_n", nth).where("_n <= 2").groupBy("proposed").agg(F.min("_o").alias("_o"), F.max("_o").alias("_p"))
    other = F.when(F.col("_o") != F.col(key), F.col("_o")).when(F.col("_p") != F.col(key), F.col("_p"))
    one = rows_.join(owners, "proposed", "left").select(key, "proposed", "current", other.alias("owner"))
    action = F.when(F.col("current").isNull(), "skip").when(F.coalesce("proposed", F.lit("")) == "", "drop").when(F.col("proposed") == F.col("current"), "keep").when(F.col("owner").isNotNull(), "drop").otherwise("rename")
    return one.withColumn("action", action)
