"""Streams over several micro-batches equal their batch twins."""

import random

import pytest
from pyspark.sql import functions as F

from cairnsift.operators import ledger
from cairnsift.session import scratch
from cairnsift.streaming import jobs, stateful
from tests.util import rows

SCHEMA = ("attempt_id bigint, unit_key string, repository string, group_id string, step string, outcome string, network int, started_us bigint, ended_us bigint, "
          "seq bigint, at_us bigint, bytes bigint, fetching boolean, to_state string")


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """Five files in log order, one unit holding most rows."""
    r = random.Random(5)
    folder = tmp_path_factory.mktemp("log")
    data = []
    for i in range(300):
        u = 0 if r.random() < 0.6 else r.randrange(1, 8)
        late = i > 280
        at = 1_000_000 + i * 400_000_000  # the engine takes the epoch itself for late
        data.append((i, f"u{u}", f"r{u % 2}", f"g{u}", r.choice(["download", "download_start"]), "failed" if late else r.choice(["ok", "failed", "fault", "busy", "interrupted"]),
                     1 if late else r.randrange(2), at, at + 1_000_000, i, at, r.randrange(3), r.random() < 0.8, r.choice(["a", "b"])))
    for n in range(5):
        spark.createDataFrame(data[n * 60:(n + 1) * 60], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    files = sorted(folder.glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    for n, p in enumerate(files):
        import os
        os.utime(p, (1_700_000_000 + n, 1_700_000_000 + n))
    return str(folder)


def stream(spark, log):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(log)


def told(spark, out):
    root = scratch(spark)
    jobs.to_parquet(out, root).awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{root}/out")


def latest(spark, out, *keys):
    root = scratch(spark)
    jobs.to_keyed(out, root).awaitTermination()
    return root, jobs.keyed(spark, root, out.schema, list(keys))


def test_stalled(spark, log):
    out = told(spark, stateful.stalled(stream(spark, log), 900_000_000))
    assert rows(out) == rows(ledger.stalled(spark.read.parquet(log), 900_000_000))
    assert out.count() > 0


def test_silence(spark, log):
    """Closed silences and holders that are gone for good, each told once."""
    out = told(spark, stateful.silent(stream(spark, log), 2_000_000_000))
    table = spark.read.parquet(log)
    clock = table.agg(F.max("at_us")).first()[0]
    want = ledger.silent_gaps(table, 2_000_000_000).join(table.select("unit_key", "seq", "at_us"), ["unit_key", "seq"]).where(
        F.col("silence_us").isNotNull() | (F.lit(clock) - F.col("at_us") > 2_000_000_000))
    assert rows(out, "unit_key", "seq") == rows(want, "unit_key", "seq") and out.count() > 0


def test_outages(spark, log):
    _, groups = latest(spark, stateful.group_failures(stream(spark, log)), "repository", "group_id")
    _, ends = latest(spark, stateful.repository_ends(stream(spark, log)), "repository")
    want = rows(ledger.outage_streaks(spark.read.parquet(log)), "repository", "group_id")
    assert rows(stateful.open_streaks(groups, ends)) == want and want


def test_retries(spark, log):
    """Over five batches each retry is told once, with the times of the batch twin."""
    short = stream(spark, log).withColumn("unit_key", F.concat("unit_key", F.lit("/"), F.floor(F.col("attempt_id") / 70).cast("string")))
    out = told(spark, stateful.retries_due(short))
    table = spark.read.parquet(log).withColumn("unit_key", F.concat("unit_key", F.lit("/"), F.floor(F.col("attempt_id") / 70).cast("string")))
    clock = table.agg(F.max("started_us")).first()[0]
    due = ledger.retry_schedule(table).where("NOT terminal")
    assert rows(out, "unit_key", "failures", "due_us") == rows(due.where(F.col("due_us") <= clock), "unit_key", "failures", "due_us") and out.count() > 10


def test_retries_by_buckets(spark, log):
    """Units that share a bucket keep their own counts; attempts that do not count still move the clock."""
    table = spark.read.parquet(log)
    due = ledger.retry_schedule(table).where("NOT terminal").where(F.col("due_us") <= table.agg(F.max("started_us")).first()[0])
    want = rows(due, "unit_key", "failures", "due_us")
    for buckets in (1, 3):
        assert rows(told(spark, stateful.retries_due(stream(spark, log), buckets=buckets)), "unit_key", "failures", "due_us") == want


def test_barrier(spark, log):
    """A group waits for members that the log has not shown yet, and is told once."""
    table = spark.read.parquet(log)
    members = table.select("unit_key", F.col("repository").alias("group_id")).distinct().union(spark.createDataFrame([("never", "r9"), ("u1", "r9")], "a string, b string"))
    assert rows(told(spark, stateful.group_barrier(stream(spark, log), ["a"], members))) == [("r0", 4), ("r1", 4)]


def test_keyed_sink_writes_what_changed(spark, log):
    """Each batch leaves its changed keys only; a merged table and later batches give the same result."""
    out = jobs.current_state(stream(spark, log))
    root, got = latest(spark, out, "unit_key")
    want = rows(ledger.current_state(spark.read.parquet(log)))
    assert rows(got.drop("batch")) == want
    sizes = {r.batch: r["count"] for r in spark.read.parquet(f"{root}/out").groupBy("batch").count().collect()}
    assert len(sizes) == 5 and max(sizes.values()) <= 8
    base = jobs.merged(spark, root, out.schema, ["unit_key"], scratch(spark))
    assert rows(jobs.keyed(spark, root, out.schema, ["unit_key"], base).drop("batch")) == want
    old = base.withColumn("batch", F.lit(1).cast("bigint")).withColumn("state", F.lit("old"))
    assert "old" not in {r.state for r in jobs.keyed(spark, root, out.schema, ["unit_key"], old.where("unit_key = 'u0'")).collect()}


def test_rates(spark, log):
    root = scratch(spark)
    s = jobs.attempt_rates(stream(spark, log).withColumn("started_at", F.timestamp_micros("started_us")))
    jobs.to_parquet(s, root).awaitTermination()
    got = set(rows(spark.read.parquet(f"{root}/out"), "window_us", "step", "outcome", "n"))
    want = set(rows(ledger.attempt_rates(spark.read.parquet(log), 3_600_000_000, 900_000_000), "window_us", "step", "outcome", "n"))
    # Only windows the watermark has passed are out; none of them differs.
    assert got and got <= want
