"""Folds of append-only event logs: states, attempts, outages, retries, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift import vocab
from cairnsift.functions import policy
from cairnsift.operators.checks import by_rules, findings, run_checks
from cairnsift.scale import blocks, ordered

WIDTH = 1 << 16
HOUR_US = 3_600_000_000
TERMINAL = ("done", "excluded", "failed", "invalidated_after_done", "kept", "skipped", "split_done")
HELD = ("contract_held", "disposition_held", "gate_held")


def current_state(transitions: DataFrame) -> DataFrame:
    """The last state per unit by sequence, not by time."""
    return transitions.groupBy("unit_key").agg(
        F.max_by("to_state", "seq").alias("state"), F.max("seq").alias("seq"), F.count(F.lit(1)).alias("transitions"))


def last_event(events: DataFrame, kinds: list[str], key: str, kind: str, seq: str, detail: str) -> DataFrame:
    """The newest event of the given kinds per key."""
    return events.where(F.col(kind).isin(*kinds)).groupBy(key).agg(
        F.max(seq).alias("seq"), F.max_by(kind, seq).alias("kind"), F.max_by(detail, seq).alias("detail"))


def hold_reasons(transitions: DataFrame, held: list[str]) -> DataFrame:
    """Why each held unit is held: the newest transition into its current state that carries a detail."""
    per_state = transitions.groupBy("unit_key", "to_state").agg(
        F.max("seq").alias("seq"), F.max_by("detail", F.when(F.col("detail").isNotNull(), F.col("seq"))).alias("detail"))
    now = per_state.groupBy("unit_key").agg(F.max_by(F.struct("to_state", "detail"), "seq").alias("s"))
    return now.where(F.col("s.to_state").isin(*held)).select("unit_key", F.col("s.to_state").alias("state"), F.col("s.detail").alias("reason"))


def recent_attempts(attempts: DataFrame, steps: list[str], n: int) -> DataFrame:
    """The newest n closed attempts of the steps (each task keeps n)."""
    return attempts.where(F.col("step").isin(*steps) & F.col("ended_us").isNotNull()).orderBy(F.desc("attempt_id")).limit(n)


def outage_streaks(attempts: DataFrame) -> DataFrame:
    """Groups whose downloads failed on the network since their repository's last download that finished.

    Only closed attempts count (a log without ``ended_us`` has no others). A download that was blocked because its unit was excluded after fetch and extraction
    (``excluded``) delivered every byte and has finished, too. A failure of another kind ends a repository's run; a group
    that failed before it and has not downloaded since is left out. All of it is conditional maxima: no repository's
    attempts are ever sorted in one place, and the ends, one row per repository, are joined to sums per group."""
    closed = F.col("ended_us").isNotNull() if "ended_us" in attempts.columns else F.lit(True)
    a = attempts.where(F.col("step").isin("download", "download_start") & closed)
    failed = F.col("outcome").isin("failed", "stalled", "fault")
    net = failed & (F.col("network") == 1)
    excluded = F.col("excluded") if "excluded" in attempts.columns else F.lit(False)
    fine = (F.col("step") == "download") & ((F.col("outcome") == "ok") | ((F.col("outcome") == "blocked") & F.coalesce(excluded, F.lit(False))))
    pos = F.col("attempt_id")
    # Failures of a group are its last one (a streak if it comes after the end) and its last one before the end.
    ends = a.groupBy("repository").agg(F.max(F.when(fine | (failed & ~net), pos)).alias("end_pos"))
    per = a.groupBy("repository", "group_id").agg(F.max(F.when(net, pos)).alias("last_net"), F.max(F.when(fine, pos)).alias("last_ok"))
    streak = per.join(ends, "repository").where(F.col("last_net") > F.coalesce("end_pos", F.lit(-1)))
    # Only groups in a streak can have failed before it; their older failures are looked up by group.
    key = streak.select("repository", "group_id", F.coalesce("end_pos", F.lit(-1)).alias("end_pos"), F.coalesce("last_ok", F.lit(-1)).alias("last_ok"))
    old = a.where(net).join(key, ["repository", "group_id"]).where((pos < F.col("end_pos")) & (pos > F.col("last_ok"))).select("repository", "group_id").distinct()
    return key.join(old, ["repository", "group_id"], "left_anti").select("repository", "group_id")


def outages(streaks: DataFrame, threshold: int = vocab.OUTAGE_GROUPS) -> DataFrame:
    return streaks.groupBy("repository").agg(F.count_distinct("group_id").alias("groups")).withColumn(
        "outage", (F.lit(threshold) > 0) & (F.col("groups") >= threshold))


def retry_schedule(attempts: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nth counted failure of each unit, its delay, and whether it is terminal. Interruptions count past a budget."""
    failed = (F.col("outcome") == "failed").cast("int")
    cut = (F.col("outcome") == "interrupted").cast("int")
    run = ordered(attempts, ["unit_key"], ["attempt_id"], blocks("attempt_id", width),
                  prior_sum={"_f": failed, "_i": cut})
    f, i = F.col("_f") + failed, F.col("_i") + cut
    n = f + F.greatest(F.lit(0), i - F.lit(vocab.MAX_INTERRUPTIONS))
    counts = (failed == 1) | ((cut == 1) & (i > vocab.MAX_INTERRUPTIONS))
    delays = F.array(*[F.lit(d) for d in vocab.RETRY_DELAYS])
    out = run.where(counts).withColumn("failures", n.cast("bigint"))
    terminal = F.col("failures") >= vocab.MAX_ATTEMPTS
    delay = F.element_at(delays, F.least(F.col("failures"), F.lit(len(vocab.RETRY_DELAYS))).cast("int"))
    return out.select("unit_key", "attempt_id", "failures", terminal.alias("terminal"), F.when(~terminal, delay).alias("delay_seconds"),
                      F.when(~terminal, F.col("ended_us") + delay.cast("bigint") * 1_000_000).alias("due_us"))


def state_intervals(transitions: DataFrame, width: int = WIDTH) -> DataFrame:
    """Each state's dwell time, the state before it, and whether it is still open."""
    run = ordered(transitions, ["unit_key"], ["seq"], blocks("seq", width),
                  lag={"from_state": "to_state"}, lead={"next_us": "at_us", "next_state": "to_state"})
    return run.select("unit_key", "seq", "from_state", "to_state", "next_state", "at_us",
                      (F.col("next_us") - F.col("at_us")).alias("dwell_us"), F.col("next_us").isNull().alias("open"))


def one_at_a_time(runs: DataFrame, slot: str = "slot") -> DataFrame:
    """Runs of a singleton slot that start before an earlier one has ended; a run without an end is open."""
    ended = F.coalesce("ended_us", F.lit(2**62))
    run = ordered(runs, [slot], ["started_us", "run_id"], blocks("started_us", HOUR_US), prior_max={"busy_until": ended})
    return run.where(F.col("busy_until") > F.col("started_us"))


def ledger_slot(slot: DataFrame, runs: DataFrame) -> DataFrame:
    """The run that holds the slot now (none when it is free)."""
    return slot.where("console_run_id IS NOT NULL").join(runs, "console_run_id")


def admission_order(units: DataFrame, width: int = WIDTH) -> DataFrame:
    """Which waiting units may start: a deferred unit that does not fit holds back the pending ones behind it, never
    a retry; one that can never fit holds nothing back. ``units(order_index, unit_key, state, admit, never_fits)``."""
    blocks_others = (F.col("state") == "deferred_disk") & ~F.col("never_fits") & ~F.col("admit")
    run = ordered(units.withColumn("_all", F.lit(0)), ["_all"], ["order_index"], blocks("order_index", width),
                  prior_max={"_held": blocks_others.cast("int")})
    held = F.coalesce("_held", F.lit(0)) == 1
    may = (F.when(F.col("state") == "pending", ~held).when(F.col("state") == "deferred_disk", F.col("admit") & ~F.col("never_fits"))
           .otherwise(F.col("state").isin("queued", "waiting_retry")))
    return run.withColumn("candidate", may).drop("_all", "_held")


def campaign_summary(units: DataFrame) -> DataFrame:
    """Counts the operator reads as (measure, value, n), in one pass.

    ``units(state, raw_disposition, outputs_produced, gate_exit_final, terminal_reason, reasons)``."""
    m = lambda name, value, when=None: (F.struct(F.lit(name).alias("measure"), value.cast("string").alias("value")) if when is None
                                        else F.when(when, F.struct(F.lit(name).alias("measure"), value.cast("string").alias("value"))))
    none, s = F.lit(None).cast("string"), F.col("state")
    fixed = F.array_compact(F.array(
        m("units", none), m("states", s), m("raw_disposition", F.col("raw_disposition")), m("outputs_produced", none, F.col("outputs_produced")),
        m("completed", none, F.col("outputs_produced") & (F.coalesce("gate_exit_final", F.lit(-1)) == 0) & (s != "invalidated_after_done")),
        m("excluded_by_reason", F.col("terminal_reason"), s == "excluded")))
    none_said = F.when(F.size("reasons") > 0, F.col("reasons")).otherwise(F.array(F.lit("unrecorded")))
    why = F.when(s.isin("disposition_held", "kept"), F.transform(none_said, lambda r: F.struct(F.concat(s, F.lit("_reasons")).alias("measure"), r.alias("value"))))
    return units.select(F.explode(F.concat(fixed, F.coalesce(why, F.slice(fixed, 1, 0)))).alias("m")).groupBy(
        "m.measure", "m.value").agg(F.count(F.lit(1)).alias("n"))


def unit_status(units: DataFrame, holds: DataFrame) -> DataFrame:
    """One status row per unit with terms and warnings. ``holds(unit_key, reason)``."""
    both = units.join(holds.select("unit_key", F.col("reason").alias("hold")), "unit_key", "left")
    invalid = F.col("state") == "invalidated_after_done"
    terms = policy.report_terms(F.col("outputs_produced"), F.col("gate_exit_final"))
    terms = F.when(invalid, F.concat(F.array_remove(terms, "completed"), F.array(F.lit("invalidated_after_done")))).otherwise(terms)
    warn = F.array_compact(F.array(
        F.when(invalid, F.lit("invalidated after done")), F.when(F.col("state") == "kept", F.lit("kept for review")),
        F.when(F.col("state").isin(*HELD), F.concat(F.col("state"), F.when(F.col("hold").isNotNull(), F.concat(F.lit(": "), "hold")).otherwise("")))))
    return both.select("unit_key", "state", terms.alias("report_terms"), F.array_contains(terms, "completed").alias("completed"),
                       (F.col("outputs_produced") & ~invalid).alias("outputs_valid"), warn.alias("warnings"))


def remaining_work(units: DataFrame, requests: DataFrame) -> DataFrame:
    """What a runner could still do: open units not waiting for an operator, pending requests, held raw data.

    A parent waits when all its open parts wait. ``units(unit_key, parent_unit_key, state, next_attempt_at, raw_disposition)``."""
    waits = (F.col("state") == "disposition_held") & F.col("next_attempt_at").isNull()
    open_ = ~F.col("state").isin(*TERMINAL)
    parts = units.where(F.col("parent_unit_key").isNotNull() & open_).groupBy(F.col("parent_unit_key").alias("_p")).agg(F.bool_and(waits).alias("_all_wait"))
    both = units.join(parts, F.col("unit_key") == F.col("_p"), "left")
    waiting = waits | ((F.col("state") == "split_parent") & F.coalesce("_all_wait", F.lit(False)))
    u = both.agg(F.count_if(open_ & ~waiting).alias("open_units"), F.count_if(~open_ & (F.col("raw_disposition") == "held")).alias("held_raw"))
    r = requests.agg(F.count_if(F.col("handled_at").isNull()).alias("pending_requests"))
    return u.crossJoin(F.broadcast(r)).select("open_units", "pending_requests", "held_raw")


def gate_rollup(checks: DataFrame) -> DataFrame:
    """Per unit: failures that stop a run, required checks left unevaluated, and policy mismatches.

    ``checks(unit_id, check_id, status, required, run_policy)``; a stated rule can add to the fixed list, never take from it.
    Check ids are a closed list, so the sets stay small."""
    fixed = F.col("check_id").isin(*vocab.BLOCKING_CHECKS)
    rule = fixed | F.coalesce(F.col("run_policy") != "record_only", F.lit(False))
    odd = F.coalesce(~F.col("run_policy").isin("blocks_run", "record_only"), F.lit(False)) | (fixed & F.coalesce(F.col("run_policy") == "record_only", F.lit(False)))
    pick = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("check_id")))), ",")
    return checks.groupBy("unit_id").agg(
        pick(rule & (F.lower("status") == "fail")).alias("blocking"),
        pick(rule & (F.lower("status") == "not_evaluable") & F.coalesce("required", F.lit(False))).alias("unevaluated"), pick(odd).alias("mismatches"))


def unit_record(units: DataFrame, attempts: DataFrame, transitions: DataFrame, verdicts: DataFrame) -> DataFrame:
    """A unit's record as ordered lines: its own row, then its transitions, attempts and verdicts.

    The histories stay rows (unit, section, seq, entry), so a unit of any length is written in parallel."""
    def section(frame: DataFrame, name: str, seq: str, *columns: str) -> DataFrame:
        return frame.select("unit_key", F.lit(name).alias("section"), F.col(seq).cast("bigint").alias("seq"),
                            F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("entry"))

    head = units.select("unit_key", F.lit("unit").alias("section"), F.lit(0).cast("bigint").alias("seq"),
                        F.to_json(F.struct("state", "transitions"), {"ignoreNullFields": "false"}).alias("entry"))
    return (head.unionByName(section(transitions, "transition", "seq", "seq", "to_state"))
            .unionByName(section(attempts, "attempt", "attempt_id", "outcome", "step"))
            .unionByName(section(verdicts, "verdict", "verdict_id", "exit_code", "point")))


def run_rows(units: DataFrame, attempts: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row per production attempt, the final gate's token on the unit's last run only."""
    runs = attempts.where("step = 'run'")
    last = runs.groupBy("unit_key").agg(F.max("attempt_id").alias("last_id"))
    final = verdicts.groupBy("unit_key").agg(F.max_by("exit_code", "verdict_id").alias("exit_code"))
    out = runs.join(last, "unit_key").join(final, "unit_key", "left").join(units.select("unit_key", "catalog_unit_id"), "unit_key")
    ends = F.col("attempt_id") == F.col("last_id")
    return out.select(F.concat_ws(":", "unit_key", F.col("attempt_id").cast("string")).alias("run_id"), "catalog_unit_id", "outcome",
                      F.when(ends, policy.gate_token(F.col("exit_code"))).alias("gate_verdict"))


# ---- integrity ----------------------------------------------------------------

def constraint_violations(units: DataFrame, transitions: DataFrame, attempts: DataFrame, states: tuple[str, ...], outcomes: tuple[str, ...]) -> DataFrame:
    """Rows that break a domain, a row rule or a reference."""
    u = by_rules(units, "Q-UNIT", F.col("unit_id"), {
        "state_domain": ~F.col("state").isin(*states), "terminal_needs_reason": F.col("state").isin(*TERMINAL) != F.col("terminal_reason").isNotNull(),
        "retry_needs_time": (F.col("state") == "waiting_retry") & F.col("next_attempt_at").isNull(), "negative_failures": F.col("failures") < 0})
    a = by_rules(attempts, "Q-ATTEMPT", F.col("attempt_id"), {
        "outcome_domain": ~F.col("outcome").isin(*outcomes), "end_and_outcome": F.col("ended_us").isNull() != F.col("outcome").isNull(),
        "counted_outcome": F.col("counted") & F.col("outcome").isin("ok", "busy", "fault")})
    lost = transitions.join(units.select("unit_id"), "unit_id", "left_anti")
    return run_checks([u, a, findings(lost, "Q-REF", "error", F.col("seq"), "unit_missing")])


def append_only(earlier: DataFrame, later: DataFrame, key: str, value: str) -> DataFrame:
    """History rows that vanished or changed since an earlier snapshot."""
    old = earlier.select(key, F.col(value).alias("old"))
    new = later.select(key, F.col(value).alias("new"), F.lit(True).alias("there"))
    both = old.join(new, key, "left")
    return both.where(F.col("there").isNull() | ~F.col("old").eqNullSafe(F.col("new"))).select(
        key, F.when(F.col("there").isNull(), "deleted").otherwise("updated").alias("change"))


# ---- batch twins of the streams -----------------------------------------------

def stalled(progress: DataFrame, window_us: int, width: int = WIDTH) -> DataFrame:
    """Readings taken longer than the window after the bytes last changed, while fetching; a window of 0 disables it."""
    seen = ordered(progress, ["unit_key"], ["seq"], blocks("seq", width), lag={"_before": "bytes"})
    changed = F.when(F.col("_before").isNull() | (F.col("_before") != F.col("bytes")), F.col("at_us"))
    run = ordered(seen.withColumn("_moved", changed), ["unit_key"], ["seq"], blocks("seq", width), prior_max={"_last": "_moved"})
    since = F.greatest("_last", "_moved")
    return run.where(F.lit(window_us > 0) & (F.col("at_us") - since > window_us) & F.col("fetching")).select(
        "unit_key", "seq", (F.col("at_us") - since).alias("idle_us"))


def silent_gaps(beats: DataFrame, window_us: int, width: int = WIDTH) -> DataFrame:
    """Heartbeats followed by a silence longer than the window (or by none at all)."""
    run = ordered(beats, ["unit_key"], ["seq"], blocks("seq", width), lead={"next_us": "at_us"})
    return run.where(F.col("next_us").isNull() | (F.col("next_us") - F.col("at_us") > window_us)).select(
        "unit_key", "seq", (F.col("next_us") - F.col("at_us")).alias("silence_us"))


def work_sessions(attempts: DataFrame, gap_us: int) -> DataFrame:
    """Sessions of a unit's attempts: a gap of at least ``gap_us`` starts a new one."""
    hours = blocks("started_us", HOUR_US * 24)
    seen = ordered(attempts, ["unit_key"], ["started_us", "attempt_id"], hours, lag={"_before": "started_us"})
    fresh = F.when(F.col("_before").isNull() | (F.col("started_us") - F.col("_before") >= gap_us), 1).otherwise(0)
    run = ordered(seen.withColumn("_new", fresh), ["unit_key"], ["started_us", "attempt_id"], hours, prior_sum={"_n": "_new"})
    return run.groupBy("unit_key", (F.col("_n") + F.col("_new")).alias("session")).agg(
        F.min("started_us").alias("start_us"), F.max("started_us").alias("last_us"), F.count(F.lit(1)).alias("attempts"))


def event_once(events: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The first of events that say the same."""
    return events.groupBy(*keys).agg(F.min(seq).alias(seq), F.count(F.lit(1)).alias("times"))


def disk_watch(readings: DataFrame, floor: Column, resume: Column, width: int = WIDTH) -> DataFrame:
    """Pause state after each reading: below the floor pauses, at or above the resume level lifts, between keeps."""
    down, up = F.when(F.col("free") < floor, F.col("seq")), F.when(F.col("free") >= resume, F.col("seq"))
    run = ordered(readings, ["volume"], ["seq"], blocks("seq", width), prior_max={"_down": down, "_up": up})
    last_down, last_up = F.greatest("_down", down), F.greatest("_up", up)
    return run.select("volume", "seq", "free", (F.coalesce(last_down, F.lit(-1)) > F.coalesce(last_up, F.lit(-1))).alias("paused"))


def group_barrier(units: DataFrame, passed: list[str]) -> DataFrame:
    """Groups whose every member is past the barrier or ended. ``units(group_id, unit_key, state)``."""
    past = F.col("state").isin(*passed)
    return units.groupBy("group_id").agg(F.bool_and(past).alias("open"), F.count_if(~past).alias("waiting"), F.count(F.lit(1)).alias("members"))


def approval_check(crossings: DataFrame, approvals: DataFrame) -> DataFrame:
    """Boundary crossings against the approval each names: missing, not_covered, revoked or ok.

    ``crossings(seq, boundary, approval_id, at_us)``, ``approvals(approval_id, covers, revoked_us)``."""
    both = crossings.join(approvals, "approval_id", "left")
    return both.select("seq", "boundary", "approval_id", (
        F.when(F.col("covers").isNull(), "missing").when(~F.array_contains("covers", F.col("boundary")), "not_covered")
        .when(F.col("revoked_us") <= F.col("at_us"), "revoked").otherwise("ok")).alias("result"))


def attempt_rates(attempts: DataFrame, size_us: int, slide_us: int) -> DataFrame:
    """Outcome counts per step in tumbling or sliding windows (epoch-aligned)."""
    first = F.floor(F.col("started_us") / slide_us) * slide_us - size_us + slide_us
    starts = F.sequence(first, F.floor(F.col("started_us") / slide_us) * slide_us, F.lit(slide_us).cast("bigint"))
    return attempts.select("step", "outcome", F.explode(starts).alias("window_us")).groupBy("window_us", "step", "outcome").agg(
        F.count(F.lit(1)).alias("n"))


def transfer_stats(downloads: DataFrame) -> DataFrame:
    """Per repository: finished downloads, their bytes, what was transferred, fetched anew and served from the store.

    ``downloads(repository, group_id, bytes, fetched, refetched)`` of finished downloads."""
    return downloads.groupBy("repository").agg(
        F.count(F.lit(1)).alias("finished"), F.sum("bytes").alias("bytes"), F.sum(F.when(F.col("fetched"), F.col("bytes"))).alias("transferred_bytes"),
        F.count_if("fetched").alias("objects_fetched"), F.count_if("refetched").alias("objects_refetched"), F.count_if(~F.col("fetched")).alias("cache_hits"),
        F.count_distinct("group_id").alias("distinct_objects"))
