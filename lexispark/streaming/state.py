"""Resumable passes: the clip state machine, upserts from streams, event windows with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: (from, pass, condition, to): the first row that fits applies; "*" fits everything.
TRANSITIONS = [
    ("exhausted", "*", "retry and not bad", "none"),
    ("exhausted", "stt", "retry and rescore and bad", "pending_tts"),
    ("improved", "*", "true", "improved"),
    ("exhausted", "*", "true", "exhausted"),
    ("none", "*", "not bad", "none"),
    ("none", "both", "accepted", "improved"),
    ("none", "both", "true", "exhausted"),
    ("none", "stt", "true", "pending_tts"),
    ("pending_tts", "tts", "drafts > 0", "pending_stt"),
    ("pending_tts", "tts", "true", "exhausted"),
    ("pending_tts", "stt", "rescore and not bad", "none"),
    ("pending_stt", "stt", "tried < wanted or drafts < tried", "pending_tts"),
    ("pending_stt", "stt", "accepted", "improved"),
    ("pending_stt", "stt", "true", "exhausted"),
]


def is_bad(cer: Column, tail: Column, most: float, tail_most: float) -> Column:
    """Scores at or over their limits; nulls don't count, a negative tail limit is none."""
    over = F.coalesce(cer >= most, F.lit(False))
    return over if tail_most < 0 else over | F.coalesce(tail >= tail_most, F.lit(False))


def best_of(readings: DataFrame, key: str, most: float, tail_most: float) -> DataFrame:
    """One reading a key: those within the limits first, then the lowest score, then the first."""
    rank = F.struct(is_bad(F.col("cer"), F.col("tail"), most, tail_most), F.coalesce("cer", F.lit(float("inf"))), F.col("nth"))
    return readings.groupBy(key).agg(F.min_by(F.struct("nth", "cer", "tail"), rank).alias("best")).select(key, "best.*")


def accepted(draws: DataFrame, key: str, originals: DataFrame, most: float, tail_most: float, gain: float = 0.02) -> DataFrame:
    """The best draw of each key, taken if it is within the limits or beats the original by the gain."""
    best = best_of(draws, key, most, tail_most).join(originals.select(key, F.col("cer").alias("original")), key)
    fine = ~is_bad(F.col("cer"), F.col("tail"), most, tail_most) | F.coalesce(F.col("cer") <= F.col("original") - gain, F.lit(False))
    return best.withColumn("accepted", fine)


def next_status(step: str) -> Column:
    """The status after a pass, from the columns status, bad, accepted, drafts, tried, wanted, rescore and retry."""
    out = None
    for before, at, condition, after in TRANSITIONS:
        if at in ("*", step):
            fits = (F.col("status") == before) & F.expr(condition)
            out = F.when(fits, after) if out is None else out.when(fits, after)
    return out.otherwise(F.col("status"))


def converge(state: DataFrame, step: Callable[[DataFrame], DataFrame], open_statuses: list[str], rounds: int) -> tuple[DataFrame, str]:
    """Repeats a pass until nothing is open ("done") or two rounds change no count of open rows ("dry")."""
    count = lambda s: s.where(F.col("status").isin(*open_statuses)).count()
    left, dry = count(state), 0
    for _ in range(rounds):
        if not left or dry == 2:
            break
        state = step(state).checkpoint()
        now = count(state)
        dry = dry + 1 if now == left else 0
        left = now
    return state, "dry" if left else "done"


def upsert(path: str, key: str, order: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: the last row of each key by order, merged into a Parquet table by version folders.

    A batch that is run again writes the same version, so a restart neither loses nor doubles rows.
    """

    def write(batch: DataFrame, version: int) -> None:
        spark = batch.sparkSession
        # the versions before this one: what an interrupted run of this batch left behind is not read
        earlier = [f"{path}/v={v}" for v in range(version) if _exists(spark, f"{path}/v={v}")]
        rows = batch if not earlier else spark.read.parquet(earlier[-1]).unionByName(batch)
        last = Window.partitionBy(key).orderBy(F.desc(order))
        rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n").write.mode("overwrite").parquet(f"{path}/v={version}")

    return write


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def resume(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs all that has come since the last run, then stops."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Counts and sums a window and type; events later than the watermark are dropped in a stream."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def once(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)
