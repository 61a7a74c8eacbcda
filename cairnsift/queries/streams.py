"""Streaming jobs over the driver's events, compared with their batch twins' SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cairnsift.queries.registry import SHAPES, Dialect, Tables, query
from cairnsift.queries.ledger import STREAK, shaped_log
from cairnsift.session import scratch
from cairnsift.streaming import jobs, stateful

MAX_US = "(SELECT max(epoch_us(ts)) FROM events)"


@dataclass(frozen=True)
class StreamDialect(Dialect):
    view: str = ""

    def table(self, name: str) -> str:
        return self.view


def stream_of(t: Tables, shape: str) -> DataFrame:
    """A shape over the events as a file stream."""
    schema = t["events"].schema
    raw = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.root)
    view = f"event_stream_{shape}"
    raw.createOrReplaceTempView(view)
    return t.spark.sql(SHAPES[shape](StreamDialect(True, t.root, view)))


def appended(t: Tables, stream: DataFrame) -> DataFrame:
    root = scratch(t.spark)
    jobs.to_parquet(stream, root).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(f"{root}/out")


def latest(t: Tables, stream: DataFrame, *keys: str) -> DataFrame:
    root = scratch(t.spark)
    jobs.to_keyed(stream, root).awaitTermination()
    return jobs.keyed(t.spark, root, stream.schema, list(keys)).drop("batch")


def timed(stream: DataFrame) -> DataFrame:
    return stream.withColumn("started_at", F.timestamp_micros("started_us"))


@query("g1_current_state_stream", "transition", sql="SELECT unit_key, max_by(to_state, seq) AS state, max(seq) AS seq, count(*) AS transitions FROM transition GROUP BY 1")
def g1(t: Tables):
    return latest(t, jobs.current_state(stream_of(t, "transition")), "unit_key")


@query("g2_stalled_stream", "transition", sql="""
SELECT * FROM (WITH a AS (SELECT *, k < 50 AS bytes, lag(k < 50) OVER w AS b0, row_number() OVER w AS rn FROM transition WINDOW w AS (PARTITION BY unit_key ORDER BY seq)),
  b AS (SELECT *, max(CASE WHEN rn = 1 OR b0 <> bytes THEN at_us END) OVER (PARTITION BY unit_key ORDER BY seq) AS since FROM a)
SELECT unit_key, seq, at_us - since AS idle_us FROM b WHERE at_us - since > 1800000000 AND to_state <> 'purchase')""")
def g2(t: Tables):
    s = stream_of(t, "transition").select("unit_key", "seq", "at_us", (F.col("k") < 50).cast("int").alias("bytes"), (F.col("to_state") != "purchase").alias("fetching"))
    return appended(t, stateful.stalled(s, 1_800_000_000))


@query("g3_stale_holder_stream", "transition", sql="""
SELECT unit_key, seq, at_us FROM (SELECT *, lead(at_us) OVER (PARTITION BY unit_key ORDER BY seq) AS nx FROM transition)
WHERE coalesce(nx, (SELECT max(at_us) FROM transition)) - at_us > 36000000000""")
def g3(t: Tables):
    return appended(t, stateful.silent(stream_of(t, "transition"), 36_000_000_000))


@query("g4_outage_breaker_stream", "attempt", ctes=STREAK, sql="SELECT * FROM res")
def g4(t: Tables):
    """The log as in the batch twin; an open attempt is not in the stream before it is closed."""
    closed = shaped_log(stream_of(t, "attempt")).where("ended_us IS NOT NULL")
    finished = closed.withColumn("outcome", F.when((F.col("outcome") == "blocked") & F.col("excluded"), "ok").otherwise(F.col("outcome")))
    groups = latest(t, stateful.group_failures(finished), "repository", "group_id")
    return stateful.open_streaks(groups, latest(t, stateful.repository_ends(finished), "repository"))


@query("g5_retry_due_stream", "attempt", sql="""
SELECT * FROM (WITH a AS (SELECT concat(unit_key, '/', started_us // 86400000000) AS unit_key, attempt_id, outcome, started_us, ended_us FROM attempt),
  c AS (SELECT *, count(*) FILTER (outcome = 'failed') OVER w AS f, count(*) FILTER (outcome = 'interrupted') OVER w AS i FROM a WINDOW w AS (PARTITION BY unit_key ORDER BY attempt_id)),
  d AS (SELECT *, f + greatest(0, i - 5) AS failures FROM c WHERE outcome = 'failed' OR (outcome = 'interrupted' AND i > 5)),
  e AS (SELECT unit_key, failures, ended_us + CASE WHEN failures = 1 THEN 600000000 ELSE 3600000000 END AS due_us FROM d WHERE failures < 3)
SELECT * FROM e WHERE due_us <= (SELECT max(started_us) FROM attempt))""")
def g5(t: Tables):
    """A unit is a user's day."""
    s = stream_of(t, "attempt").withColumn("unit_key", F.concat_ws("/", "unit_key", F.floor(F.col("started_us") / 86_400_000_000).cast("string")))
    return appended(t, stateful.retries_due(s))


@query("g6_attempt_rates_stream", "attempt", sql=f"""
SELECT CAST((started_us // 900000000) * 900000000 - o.i * 900000000 AS BIGINT) AS window_us, step, outcome, count(*) AS n FROM attempt, range(4) o(i)
GROUP BY 1, 2, 3 HAVING (any_value((started_us // 900000000) * 900000000 - o.i * 900000000)) + 3600000000 <= ({MAX_US} // 1000 - 600000) * 1000""")
def g6(t: Tables):
    return appended(t, jobs.attempt_rates(timed(stream_of(t, "attempt"))))


@query("g7_work_sessions_stream", "attempt", sql=f"""
SELECT * FROM (WITH a AS (SELECT *, CASE WHEN started_us - lag(started_us) OVER w < 43200000000 THEN 0 ELSE 1 END AS nw FROM attempt WINDOW w AS (PARTITION BY unit_key ORDER BY started_us, attempt_id)),
  b AS (SELECT *, sum(nw) OVER (PARTITION BY unit_key ORDER BY started_us, attempt_id) AS session FROM a)
SELECT unit_key, min(started_us) AS start_us, count(*) AS attempts FROM b GROUP BY unit_key, session HAVING max(started_us) + 43200000000 <= ({MAX_US} // 1000 - 600000) * 1000)""")
def g7(t: Tables):
    return appended(t, jobs.work_sessions(timed(stream_of(t, "attempt"))))


@query("g8_event_once_stream", "transition", sql="SELECT to_state, unit_key, count(*) > 0 AS seen FROM transition GROUP BY 1, 2")
def g8(t: Tables):
    s = stream_of(t, "transition").select("to_state", "unit_key", F.timestamp_micros("at_us").alias("at"))
    return appended(t, jobs.event_once(s, ["to_state", "unit_key"], "at", "60 days").select("to_state", "unit_key", F.lit(True).alias("seen")))


@query("g9_disk_state_stream", "attempt", sql="""
SELECT repository AS volume, max_by(k, attempt_id) AS free, coalesce(max(attempt_id) FILTER (k < 20), -1) > coalesce(max(attempt_id) FILTER (k >= 60), -1) AS paused FROM attempt GROUP BY 1""")
def g9(t: Tables):
    s = stream_of(t, "attempt").select(F.col("repository").alias("volume"), F.col("attempt_id").alias("seq"), F.col("k").alias("free"))
    return latest(t, jobs.disk_state(s, 20, 60), "volume")


@query("g10_group_barrier_stream", "transition", sql="""
SELECT concat('g', user_id // 2) AS group_id, count(*) AS members FROM (SELECT user_id, bool_or(to_state = 'purchase') AS past FROM transition GROUP BY 1) GROUP BY 1 HAVING bool_and(past)""")
def g10(t: Tables):
    """Membership is known beforehand: a static side."""
    members = t["transition"].select("unit_key", F.concat(F.lit("g"), F.floor(F.col("user_id") / 2).cast("string")).alias("group_id")).distinct()
    return appended(t, stateful.group_barrier(stream_of(t, "transition"), ["purchase"], members))


@query("g11_approval_join_stream", "transition", sql="""
SELECT seq, boundary, approval_id, CASE WHEN p.c_custkey IS NULL THEN 'missing' WHEN NOT list_contains(['click', 'error'], boundary) THEN 'not_covered' WHEN p.c_acctbal < 1000 AND at_us >= 1705000000000000 THEN 'revoked' ELSE 'ok' END AS result
FROM (SELECT seq, to_state AS boundary, user_id AS approval_id, at_us FROM transition) x LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') p ON approval_id = c_custkey""")
def g11(t: Tables):
    s = stream_of(t, "transition").select("seq", F.col("to_state").alias("boundary"), F.col("user_id").alias("approval_id"), "at_us")
    approvals = t["customer"].where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("approval_id"), F.array(F.lit("click"), F.lit("error")).alias("covers"),
                                                                      F.when(F.col("c_acctbal") < 1000, F.lit(1705000000000000)).alias("revoked_us"))
    return appended(t, jobs.approval_join(s, approvals))
