"""Sinks: JSON lines, split manifests, Parquet shards, clips, side outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MANIFEST = ["audio_filepath", "duration", "text", "asr_training_source", "category", "group_id", "group_mode", "item_index"]


def json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """Committed as a whole: a failed job leaves no half-written table behind."""
    df.write.mode("append" if append else "overwrite").json(path)


def delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def splits(rows: DataFrame, path: str, label: str = "split") -> None:
    """full, and one folder a split; durations to the millisecond, only a manifest's columns."""
    own = [c for c in MANIFEST if c in rows.columns]
    out = rows.withColumn("duration", F.round("duration", 3)).select(*own, label)
    out.drop(label).write.mode("overwrite").json(f"{path}/full")
    out.write.mode("overwrite").partitionBy(label).json(f"{path}/splits")


def parquet_shards(rows: DataFrame, path: str, by: str, order: str = "audio_filepath", per: int = 2500) -> None:
    """Shards of at most per rows within each partition of by, in order; stale shards of the same partitions go."""
    spread = rows.repartitionByRange(by, order).sortWithinPartitions(by, order)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", per).partitionBy(by).parquet(path)


def rewrite(rows: DataFrame, drop: Column, changes: dict[str, Column], path: str, apply: bool = False) -> tuple[DataFrame, int, int]:
    """(result, dropped, changed): rows less those dropped, with columns replaced; written only if apply is set.

    The result goes to another path than the input's, as a job can't read what it overwrites.
    """
    kept = rows.where(~F.coalesce(drop, F.lit(False)))
    differs = F.lit(False)
    for c, new in changes.items():
        differs = differs | ~F.col(c).eqNullSafe(new)
    counts = rows.agg(F.count_if(F.coalesce(drop, F.lit(False))), F.count_if(~F.coalesce(drop, F.lit(False)) & differs)).first()
    out = kept.withColumns(changes)
    if apply:
        out.write.mode("overwrite").json(path)
    return out, counts[0], counts[1]


def side_outputs(rows: DataFrame, reason: Column, path: str) -> DataFrame:
    """Rows without a reason are returned, those with one are appended by reason below path."""
    told = rows.withColumn("reason", reason)
    told.where("reason is not null").write.mode("append").partitionBy("reason").json(path)
    return told.where("reason is null").drop("reason")


def loose_clips(rows: DataFrame, put: Callable[[str, bytes], None], content: str = "audio.bytes", name: str = "filename") -> None:
    """Calls put(name, bytes) on the executors for each row; put writes to a store that all of them share."""
    rows.select(F.col(name).alias("n"), F.col(content).alias("b")).foreachPartition(lambda part: [put(r["n"], bytes(r["b"])) for r in part])


def markdown(df: DataFrame, title: str, most: int = 500) -> str:
    """A small table as Markdown; a report has at most most rows."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("a report is for aggregated rows")
    cell = lambda x: "" if x is None else f"{x:.4f}" if isinstance(x, float) else str(x)
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(map(cell, r)) + " |" for r in rows)]
    return f"## {title}\n\n" + "\n".join(lines) + "\n"
