"""Streaming transformations that Structured Streaming has operators for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType


def current_state(transitions: DataFrame) -> DataFrame:
    """Last state per unit by sequence, for update mode."""
    return transitions.groupBy("unit_key").agg(F.max_by("to_state", "seq").alias("state"), F.max("seq").alias("seq"), F.count(F.lit(1)).alias("transitions"))


def attempt_rates(attempts: DataFrame, size: str = "1 hour", slide: str = "15 minutes", late: str = "10 minutes") -> DataFrame:
    """Outcome counts per step in windows; rows later than the watermark are dropped."""
    return attempts.withWatermark("started_at", late).groupBy(F.window("started_at", size, slide).alias("w"), "step", "outcome").agg(F.count(F.lit(1)).alias("n")).select(
        F.unix_micros("w.start").alias("window_us"), "step", "outcome", "n")


def work_sessions(attempts: DataFrame, gap: str = "12 hours", late: str = "10 minutes") -> DataFrame:
    """Sessions of a unit's attempts, closed once the watermark passes them."""
    return attempts.withWatermark("started_at", late).groupBy(F.session_window("started_at", gap).alias("w"), "unit_key").agg(F.count(F.lit(1)).alias("attempts")).select(
        "unit_key", F.unix_micros("w.start").alias("start_us"), "attempts")


def event_once(events: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """The same event recorded once within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def disk_state(readings: DataFrame, floor: int, resume: int) -> DataFrame:
    """Latest free space per volume and whether it is paused: the last reading below the floor against the last one at
    the resume level. Both are maxima, so partial results combine."""
    down, up = F.max(F.when(F.col("free") < floor, F.col("seq"))), F.max(F.when(F.col("free") >= resume, F.col("seq")))
    return readings.groupBy("volume").agg(F.max_by("free", "seq").alias("free"), (F.coalesce(down, F.lit(-1)) > F.coalesce(up, F.lit(-1))).alias("paused"))


def approval_join(crossings: DataFrame, approvals: DataFrame) -> DataFrame:
    """Stream-static join of crossings with the approvals they name."""
    both = crossings.join(approvals, "approval_id", "left")
    return both.select("seq", "boundary", "approval_id", (
        F.when(F.col("covers").isNull(), "missing").when(~F.array_contains("covers", F.col("boundary")), "not_covered")
        .when(F.col("revoked_us") <= F.col("at_us"), "revoked").otherwise("ok")).alias("result"))


def to_parquet(stream: DataFrame, root: str, **trigger) -> StreamingQuery:
    """Append-mode sink with its checkpoint beside it."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()


def to_keyed(stream: DataFrame, root: str, **trigger) -> StreamingQuery:
    """Update-mode sink: a batch writes the keys it changed, under its number. A batch that is run again overwrites its own
    rows, and what a batch writes follows the batch and not the table."""
    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    return stream.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", f"{root}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()


def keyed(spark: SparkSession, root: str, schema: StructType, keys: list[str], base: DataFrame | None = None) -> DataFrame:
    """The table that ``to_keyed`` has written: for each key the row of its newest batch. ``base`` is an earlier result with
    a column ``batch``, of which only newer batches are read anew; see ``merged``."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(f"{root}/out")
    if base is not None:
        upto = base.agg(F.max("batch")).first()[0]
        rows = rows.where(F.col("batch") > (-1 if upto is None else upto)).unionByName(base)
    own = [c for c in schema.names if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*own, "batch"), "batch").alias("_r"))
    return newest.select(*keys, "_r.*")


def merged(spark: SparkSession, root: str, schema: StructType, keys: list[str], path: str, base: DataFrame | None = None) -> DataFrame:
    """Merge all batches so far (over ``base``) into a table at ``path``; batches it holds need not be read again."""
    keyed(spark, root, schema, keys, base).write.parquet(path)
    return spark.read.parquet(path)
