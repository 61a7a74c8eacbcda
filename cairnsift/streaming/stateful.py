"""Streams with a state of their own per key, kept in the engine's state store.

The engine holds, versions, compacts and restores the state; a job only says what a key remembers (a few numbers) and what
it tells. What falls due by time is an event-time timer: a key is woken when the newest time seen in the stream, the
watermark, has passed it, whether it has new rows or not. A key's rows of one micro-batch come to its task in Arrow
batches and are sorted there, so what a task holds is bounded by the batch (``maxFilesPerTrigger`` and its like), never
by the key's history. As in every job with a watermark, rows that come more than ``late`` behind the newest time seen are
dropped by the engine, and timers wait as long; a log whose sources run apart needs a ``late`` that covers it. The functions
below are closures over plain values, so that workers need nothing but pandas.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from cairnsift import vocab


def _by_key(stream: DataFrame, keys: list[str], run: Callable[..., Iterator[pd.DataFrame]], output: str, state: str, timed: str | None = None, mode: str = "append",
            late: str = "0 seconds") -> DataFrame:
    """``run`` over each key's rows; ``timed`` names the column of microseconds that drives its timers."""
    if timed is not None:
        stream = stream.withColumn("_at", F.timestamp_micros(timed)).withWatermark("_at", late)
    return stream.groupBy(*keys).applyInPandasWithState(run, output, state, mode, GroupStateTimeout.EventTimeTimeout if timed else GroupStateTimeout.NoTimeout)


def stalled(readings: DataFrame, window_us: int) -> DataFrame:
    """Readings whose bytes have not changed for longer than the window. A unit remembers its bytes and their last change.

    ``readings(unit_key, seq, at_us, bytes, fetching)``, in order within a unit."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("seq")
        held, since = state.get if state.exists else (None, None)
        started, out = state.exists, []
        for seq, at, got, fetching in zip(rows.seq, rows.at_us, rows.bytes, rows.fetching):
            got = None if pd.isna(got) else int(got)
            if not started or (got is not None and held is not None and got != held):
                since = int(at)
            held, started = got, True
            if fetching and window_us > 0 and at - since > window_us:
                out.append((key[0], int(seq), int(at - since)))
        state.update((held, since))
        yield pd.DataFrame(out, columns=["unit_key", "seq", "idle_us"])

    return _by_key(readings.select("unit_key", "seq", "at_us", "bytes", "fetching"), ["unit_key"], run, "unit_key string, seq bigint, idle_us bigint", "bytes bigint, since_us bigint")


def silent(beats: DataFrame, window_us: int, late: str = "0 seconds") -> DataFrame:
    """Heartbeats that no other followed within the window, each told once: by the next one, or by the timer if none comes.

    ``beats(unit_key, seq, at_us)``. A holder remembers its last beat and whether its silence was told."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        columns = ["unit_key", "seq", "at_us"]
        if state.hasTimedOut:
            seq, at, _ = state.get
            state.update((seq, at, True))
            yield pd.DataFrame([(key[0], seq, at)], columns=columns)
            return
        rows = pd.concat(list(batches)).sort_values("seq")
        out, last = [], state.get if state.exists else None
        for seq, at in zip(rows.seq, rows.at_us):
            if last is not None and at - last[1] > window_us and not last[2]:
                out.append((key[0], last[0], last[1]))
            last = (int(seq), int(at), False)
        state.update(last)
        state.setTimeoutTimestamp(max((last[1] + window_us) // 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=columns)

    return _by_key(beats.select("unit_key", "seq", "at_us"), ["unit_key"], run, "unit_key string, seq bigint, at_us bigint", "seq bigint, at_us bigint, told boolean", "at_us", late=late)


BUCKETS = 1 << 13


def retries_due(attempts: DataFrame, late: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """Retries as they fall due: each counted failure but the last one allowed is told once, when the newest start seen has
    passed its time. A unit remembers its counts and the retries still to fall due, which the allowed attempts bound.

    Units are many and most have a row or two, so a call into Python serves a bucket of units; only attempts that count
    reach it. ``attempts(unit_key, attempt_id, outcome, started_us, ended_us)``."""
    delays, allowed, spare = tuple(vocab.RETRY_DELAYS), vocab.MAX_ATTEMPTS, vocab.MAX_INTERRUPTIONS

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        known, waiting = json.loads(state.get[0]) if state.exists else ([], [])
        counts = {unit: (failed, cut) for unit, failed, cut in known}
        if not state.hasTimedOut:
            rows = pd.concat(list(batches)).sort_values("attempt_id")
            for unit, outcome, ended in zip(rows.unit_key, rows.outcome, rows.ended_us):
                failed, cut = counts.get(unit, (0, 0))
                failed += outcome == "failed"
                cut += outcome == "interrupted"
                counts[unit] = (failed, cut)
                n = failed + max(0, cut - spare)
                if (outcome == "failed" or cut > spare) and n < allowed:
                    waiting.append((unit, n, int(ended) + delays[min(n, len(delays)) - 1] * 1_000_000))
        clock = state.getCurrentWatermarkMs() * 1000
        due = [w for w in waiting if w[2] <= clock]
        waiting = [w for w in waiting if w[2] > clock]
        state.update((json.dumps([[(unit, int(f), int(c)) for unit, (f, c) in counts.items()], waiting]),))
        if waiting:
            state.setTimeoutTimestamp(max(min(at for _, _, at in waiting) // 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(due, columns=["unit_key", "failures", "due_us"])

    # The rule on the watermark's own column keeps the filter above the watermark: every attempt moves the clock.
    counted = F.col("outcome").isin("failed", "interrupted") | (F.col("_at") >= F.lit("9999-12-31").cast("timestamp"))
    rows = attempts.withColumn("_at", F.timestamp_micros("started_us")).withWatermark("_at", late).where(counted)
    return rows.select(F.pmod(F.xxhash64("unit_key"), F.lit(buckets)).alias("_bucket"), "unit_key", "attempt_id", "outcome", "ended_us", "_at").groupBy("_bucket").applyInPandasWithState(
        run, "unit_key string, failures bigint, due_us bigint", "known string", "append", GroupStateTimeout.EventTimeTimeout)


def group_barrier(transitions: DataFrame, passed: list[str], members: DataFrame) -> DataFrame:
    """Groups all of whose ``members(unit_key, group_id)`` have been in a passed state at some time, each told once. A group
    remembers which of its members have passed; members are a static table and bound it."""
    whole = members.distinct().join(members.groupBy("group_id").agg(F.count_distinct("unit_key").alias("members")), "group_id")
    rows = transitions.where(F.col("to_state").isin(*passed)).select("unit_key").join(whole, "unit_key")

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        seen, told = state.get if state.exists else ("", False)
        past = set(seen.split("\0")) if seen else set()
        size = 0
        for rows in batches:
            past.update(rows.unit_key)
            size = int(rows.members.iloc[0]) if len(rows) else size
        full = len(past) == size and not told
        state.update(("\0".join(sorted(past)), told or full))
        yield pd.DataFrame([(key[0], size)] if full else [], columns=["group_id", "members"])

    return _by_key(rows, ["group_id"], run, "group_id string, members bigint", "seen string, told boolean")


def group_failures(attempts: DataFrame) -> DataFrame:
    """Per repository and group, in update mode: the last download that finished, and the first and last network failure
    since. With ``repository_ends`` these decide outages (``open_streaks``); rows of a group come in log order."""
    failed = F.col("outcome").isin("failed", "stalled", "fault")
    net, fine = failed & (F.col("network") == 1), (F.col("outcome") == "ok") & (F.col("step") == "download")
    a = attempts.where(F.col("step").isin("download", "download_start")).select("repository", "group_id", "attempt_id", net.alias("net"), fine.alias("fine")).where("net OR fine")

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        ok, first, last = state.get if state.exists else (-1, -1, -1)
        rows = pd.concat(list(batches)).sort_values("attempt_id")
        for at, net, fine in zip(rows.attempt_id, rows.net, rows.fine):
            if fine:
                ok, first = int(at), -1
            if net:
                first, last = (int(at) if first < 0 else first), int(at)
        state.update((ok, first, last))
        yield pd.DataFrame([(key[0], key[1], ok, first, last)], columns=["repository", "group_id", "last_ok", "first_net", "last_net"])

    return _by_key(a, ["repository", "group_id"], run, "repository string, group_id string, last_ok bigint, first_net bigint, last_net bigint", "last_ok bigint, first_net bigint, last_net bigint", mode="update")


def repository_ends(attempts: DataFrame) -> DataFrame:
    """Per repository, for update mode: where its last run of network failures ended. A maximum, combined before the shuffle."""
    failed = F.col("outcome").isin("failed", "stalled", "fault")
    ended = ((F.col("outcome") == "ok") & (F.col("step") == "download")) | (failed & (F.col("network") != 1))
    a = attempts.where(F.col("step").isin("download", "download_start"))
    return a.groupBy("repository").agg(F.max(F.when(ended, F.col("attempt_id"))).alias("end_pos"))


def open_streaks(groups: DataFrame, ends: DataFrame) -> DataFrame:
    """Groups that failed on the network since their repository's last end, but for those that failed before it, too,
    without a download since."""
    end: Column = F.coalesce("end_pos", F.lit(-1))
    both = groups.join(ends, "repository", "left")
    return both.where((F.col("last_net") > end) & ~((F.col("first_net") >= 0) & (F.col("first_net") < end))).select("repository", "group_id")
