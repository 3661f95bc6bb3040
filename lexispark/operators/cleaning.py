"""Raw texts to blocks of joined lines, with a ledger of where every letter went. Windows and built-ins alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C

IGNORED = "[]{}|\\^~<>"


def lines(docs: DataFrame, doc: str, text: str, clean=C.squeeze, ignored: str = IGNORED, shortest: int = 10) -> DataFrame:
    """(doc, i, raw_alnum, line, alnum, position, next_capital, reason): the lines with a character, cleaned.

    position is the share of the text's letters before the line; reason the first rule that rejects it (null: kept,
    or empty once cleaned). A document's lines are one window partition: as long as the document, not as the table.
    """
    w = Window.partitionBy("doc").orderBy("i")
    raw = docs.select(F.col(doc).alias("doc"), F.posexplode(F.split(text, "\n")).alias("i", "raw")).where(C.strip(F.col("raw")) != "")
    raw = raw.withColumn("raw_alnum", C.alnum_length(F.col("raw")))
    before = F.coalesce(F.sum("raw_alnum").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("raw_alnum").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    placed = raw.withColumn("position", before / F.greatest(total, F.lit(1))).withColumn("next_capital", F.coalesce(C.starts_capital(F.lead("raw").over(w)), F.lit(False)))
    cleaned = placed.withColumn("line", clean(F.col("raw"))).withColumn("alnum", C.alnum_length(F.col("line")))
    return cleaned.withColumn("reason", F.when(F.col("line") != "", C.line_reason(F.col("line"), ignored, shortest))).drop("raw")


def blocks(of_lines: DataFrame, shortest: int = 40, drop: Column | None = None) -> DataFrame:
    """(doc, block, text, alnum, reason): runs of kept lines; a rejected line ends a run, an empty one doesn't."""
    w = Window.partitionBy("doc").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    island = of_lines.where("line <> ''").withColumn("block", F.sum(F.col("reason").isNotNull().cast("int")).over(w)).where("reason is null")
    joined = island.groupBy("doc", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]), " ").alias("text"))
    why = F.when(F.char_length("text") < shortest, "block_too_short").when(F.contains("text", F.lit("..")), "double_dot")
    if drop is not None:
        why = why.when(drop, "untokenizable")
    return joined.withColumn("alnum", C.alnum_length(F.col("text"))).withColumn("reason", why)


def ledger(of_lines: DataFrame, of_blocks: DataFrame) -> DataFrame:
    """(bucket, letters, n): all letters by what became of them; raw is the sum of the other buckets, or it is an error."""
    raw = of_lines.agg(F.lit("raw").alias("bucket"), F.coalesce(F.sum("raw_alnum"), F.lit(0)).alias("letters"), F.count("*").alias("n"))
    norm = of_lines.agg(F.lit("normalised").alias("bucket"), F.coalesce(F.sum(F.col("raw_alnum") - F.col("alnum")), F.lit(0)).alias("letters"), F.count("*").alias("n"))
    cut = of_lines.where("reason is not null").groupBy(F.concat(F.lit("line_"), "reason").alias("bucket")).agg(F.sum("alnum").alias("letters"), F.count("*").alias("n"))
    kept = of_blocks.groupBy(F.coalesce("reason", F.lit("kept")).alias("bucket")).agg(F.sum("alnum").alias("letters"), F.count("*").alias("n"))
    every = raw.unionByName(norm).unionByName(cut).unionByName(kept)
    all_rows = Window.partitionBy()
    rest = F.sum(F.when(F.col("bucket") == "raw", F.col("letters")).otherwise(-F.col("letters"))).over(all_rows)
    return every.withColumn("letters", F.when(rest == 0, F.col("letters")).otherwise(F.raise_error(F.lit("the ledger does not add up")).cast("bigint")))


def deciles(of_lines: DataFrame, reason: str = "no_end_punct") -> DataFrame:
    """(decile, next_capital, n, letters) of the lines that a rule rejected."""
    tenth = F.least(F.lit(9), F.floor(F.col("position") * 10)).cast("int").alias("decile")
    return of_lines.where(F.col("reason") == reason).groupBy(tenth, "next_capital").agg(F.count("*").alias("n"), F.sum("alnum").alias("letters"))


def character_audit(docs: DataFrame, doc: str, text: str, alphabet: list[str]) -> DataFrame:
    """(char, texts, example): characters outside the alphabet, how many texts have them, and the first such text."""
    rows = docs.select(F.col(doc).alias("doc"), F.explode(C.uncovered(F.col(text), alphabet)).alias("char"))
    return rows.groupBy("char").agg(F.count("*").alias("texts"), F.min("doc").alias("example"))
