"""Ledger folds over the driver's events."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.operators import ledger
from cairnsift.queries.registry import Tables, query


@query("g1_current_state", "transition", sql="SELECT unit_key, max_by(to_state, seq) AS state, max(seq) AS seq, count(*) AS transitions FROM transition GROUP BY 1")
def g1(t: Tables):
    return ledger.current_state(t["transition"])


@query("w3_last_event", "transition", sql="""
SELECT unit_key, max(seq) AS seq, max_by(to_state, seq) AS kind, max_by(k, seq) AS detail FROM transition WHERE to_state IN ('error', 'signup') GROUP BY 1""")
def w3(t: Tables):
    return ledger.last_event(t["transition"], ["error", "signup"], "unit_key", "to_state", "seq", "k")


@query("w3_hold_reasons", "transition", sql="""
SELECT * FROM (WITH s AS (SELECT unit_key, to_state, max(seq) AS seq, max_by(k, seq) FILTER (k >= 50) AS reason FROM transition GROUP BY 1, 2)
SELECT unit_key, max_by(to_state, seq) AS state, arg_max_null(reason, seq) AS reason FROM s GROUP BY 1 HAVING max_by(to_state, seq) IN ('error', 'view'))""")
def w3_hold(t: Tables):
    tr = t["transition"].withColumn("detail", F.when(F.col("k") >= 50, F.col("k")))
    return ledger.hold_reasons(tr, ["error", "view"])


@query("w4_recent_attempts", "attempt", sql="SELECT attempt_id, unit_key, outcome FROM attempt WHERE step = 'download' ORDER BY attempt_id DESC LIMIT 25")
def w4(t: Tables):
    return ledger.recent_attempts(t["attempt"], ["download"], 25).select("attempt_id", "unit_key", "outcome")


STREAK = """att AS (SELECT attempt_id, substr(unit_key, length(unit_key) - 1) AS repository, group_id, step, network, CASE WHEN outcome = 'busy' AND k >= 80 THEN 'blocked' ELSE outcome END AS outcome, k >= 90 AS excluded FROM attempt WHERE k % 10 <> 9),
a AS (SELECT *, outcome IN ('failed', 'stalled', 'fault') AND network = 1 AS net, step = 'download' AND (outcome = 'ok' OR (outcome = 'blocked' AND excluded)) AS fine, outcome IN ('failed', 'stalled', 'fault') AND network = 0 AS other FROM att),
e AS (SELECT repository, coalesce(max(attempt_id) FILTER (fine OR other), -1) AS end_pos FROM a GROUP BY 1),
st AS (SELECT DISTINCT repository, group_id FROM a JOIN e USING (repository) WHERE net AND attempt_id > end_pos),
pe AS (SELECT DISTINCT f.repository, f.group_id FROM a f JOIN e USING (repository) WHERE f.net AND f.attempt_id < end_pos
  AND NOT EXISTS (SELECT 1 FROM a o WHERE o.fine AND o.repository = f.repository AND o.group_id = f.group_id AND o.attempt_id > f.attempt_id)),
res AS (SELECT repository, group_id FROM st EXCEPT SELECT repository, group_id FROM pe)"""


def shaped_log(attempts):
    """The whole log; units whose names end alike share a repository, some attempts are open, some blocked."""
    return attempts.withColumn("repository", F.substring("unit_key", -2, 2)).withColumn("excluded", F.col("k") >= 90).withColumn(
        "outcome", F.when((F.col("outcome") == "busy") & (F.col("k") >= 80), "blocked").otherwise(F.col("outcome"))).withColumn(
        "ended_us", F.when(F.col("k") % 10 != 9, F.col("ended_us")))


def streaks(t: Tables):
    return ledger.outage_streaks(shaped_log(t["attempt"]))


@query("w5_outage_streaks", "attempt", ctes=STREAK, sql="SELECT * FROM res")
def w5(t: Tables):
    return streaks(t)


@query("w5_outages", "attempt", ctes=STREAK, sql="SELECT repository, count(*) AS groups, count(*) >= 3 AS outage FROM res GROUP BY 1")
def w5_outages(t: Tables):
    return ledger.outages(streaks(t))


@query("w6_retry_schedule", "attempt", sql="""
SELECT * FROM (WITH c AS (SELECT *, count(*) FILTER (outcome = 'failed') OVER w AS f, count(*) FILTER (outcome = 'interrupted') OVER w AS i FROM attempt WINDOW w AS (PARTITION BY unit_key ORDER BY attempt_id)),
  d AS (SELECT *, f + greatest(0, i - 5) AS failures FROM c WHERE outcome = 'failed' OR (outcome = 'interrupted' AND i > 5))
SELECT unit_key, attempt_id, failures, failures >= 3 AS terminal, CASE WHEN failures >= 3 THEN NULL WHEN failures = 1 THEN 600 ELSE 3600 END AS delay_seconds,
  CASE WHEN failures >= 3 THEN NULL ELSE ended_us + CASE WHEN failures = 1 THEN 600000000 ELSE 3600000000 END END AS due_us FROM d)""")
def w6(t: Tables):
    return ledger.retry_schedule(t["attempt"])


@query("w7_state_intervals", "transition", sql="""
SELECT unit_key, seq, lag(to_state) OVER w AS from_state, to_state, lead(to_state) OVER w AS next_state, at_us, lead(at_us) OVER w - at_us AS dwell_us, lead(at_us) OVER w IS NULL AS open
FROM transition WINDOW w AS (PARTITION BY unit_key ORDER BY seq)""")
def w7(t: Tables):
    return ledger.state_intervals(t["transition"])


@query("w8_one_at_a_time", "attempt", sql="""
SELECT slot, run_id, busy_until FROM (SELECT repository AS slot, attempt_id AS run_id, started_us,
  max(ended_us) OVER (PARTITION BY repository ORDER BY started_us, attempt_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy_until FROM attempt) WHERE busy_until > started_us""")
def w8(t: Tables):
    runs = t["attempt"].select(F.col("repository").alias("slot"), F.col("attempt_id").alias("run_id"), "started_us", "ended_us")
    return ledger.one_at_a_time(runs).select("slot", "run_id", "busy_until")


@query("j19_ledger_slot", "attempt", sql="""
SELECT repository, max(attempt_id) AS console_run_id, max_by(unit_key, attempt_id) AS unit_key FROM attempt GROUP BY 1 HAVING max_by(outcome, attempt_id) <> 'busy'""")
def j19(t: Tables):
    a = t["attempt"]
    slot = a.groupBy("repository").agg(F.max("attempt_id").alias("m"), F.max_by("outcome", "attempt_id").alias("o")).select(
        "repository", F.when(F.col("o") != "busy", F.col("m")).alias("console_run_id"))
    return ledger.ledger_slot(slot, a.select(F.col("attempt_id").alias("console_run_id"), "unit_key"))


@query("w15_admission_order", "unit", sql="""
SELECT * FROM (WITH u AS (SELECT o_orderkey AS order_index, unit_id AS unit_key, CASE WHEN o_orderstatus = 'O' THEN 'pending' WHEN price_cents < 2000000 THEN 'deferred_disk' ELSE 'queued' END AS state,
    price_cents % 2 = 0 AS admit, price_cents < 400000 AS never_fits FROM unit)
SELECT order_index, unit_key, CASE state WHEN 'pending' THEN NOT coalesce(bool_or(state = 'deferred_disk' AND NOT never_fits AND NOT admit) OVER (ORDER BY order_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)
  WHEN 'deferred_disk' THEN admit AND NOT never_fits ELSE true END AS candidate FROM u)""")
def w15(t: Tables):
    u = t["unit"].select(F.col("o_orderkey").alias("order_index"), F.col("unit_id").alias("unit_key"),
                         F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("price_cents") < 2000000, "deferred_disk").otherwise("queued").alias("state"),
                         (F.col("price_cents") % 2 == 0).alias("admit"), (F.col("price_cents") < 400000).alias("never_fits"))
    return ledger.admission_order(u, 1024).select("order_index", "unit_key", "candidate")


CAMPAIGN = """cu AS (SELECT unit_id AS unit_key, CASE WHEN status = 'ready' THEN CASE WHEN ion_mode = 'both' THEN 'invalidated_after_done' ELSE 'done' END WHEN status = 'excluded' THEN 'excluded'
   WHEN status = 'abstained' THEN 'kept' ELSE 'disposition_held' END AS state, CASE WHEN chromatography = 'RP' THEN 'released' WHEN chromatography = 'HILIC' THEN 'held' ELSE 'none' END AS raw_disposition,
   status = 'ready' AS outputs_produced, CAST(CASE WHEN ion_mode = 'positive' THEN 0 WHEN ion_mode = 'negative' THEN 2 END AS INTEGER) AS gate_exit_final, exclusion_reason AS terminal_reason,
   CASE WHEN ion_mode = 'switching' THEN ['aif', ion_mode] WHEN ion_mode = 'both' THEN ['aif'] ELSE [] END AS reasons,
   CASE WHEN ion_mode = 'unknown' THEN NULL ELSE 'later' END AS next_attempt_at, CASE WHEN o_orderkey % 10 <> 0 AND chromatography = 'RP' THEN concat('U', o_orderkey - o_orderkey % 10) END AS parent_unit_key FROM payload)"""


def campaign(t: Tables):
    p = t["payload"]
    ion, st, ch = F.col("ion_mode"), F.col("status"), F.col("chromatography")
    return p.select(
        F.col("unit_id").alias("unit_key"), "o_orderkey",
        F.when(st == "ready", F.when(ion == "both", "invalidated_after_done").otherwise("done")).when(st == "excluded", "excluded").when(st == "abstained", "kept").otherwise("disposition_held").alias("state"),
        F.when(ch == "RP", "released").when(ch == "HILIC", "held").otherwise("none").alias("raw_disposition"), (st == "ready").alias("outputs_produced"),
        F.when(ion == "positive", 0).when(ion == "negative", 2).alias("gate_exit_final"), F.col("exclusion_reason").alias("terminal_reason"),
        F.when(ion == "switching", F.array(F.lit("aif"), ion)).when(ion == "both", F.array(F.lit("aif"))).otherwise(F.array().cast("array<string>")).alias("reasons"),
        F.when(ion != "unknown", "later").alias("next_attempt_at"),
        F.when((F.col("o_orderkey") % 10 != 0) & (ch == "RP"), F.concat(F.lit("U"), F.col("o_orderkey") - F.col("o_orderkey") % 10)).alias("parent_unit_key"))


@query("a3_campaign_summary", "payload", ctes=CAMPAIGN, sql="""
SELECT measure, value, count(*) AS n FROM (
  SELECT 'units' AS measure, CAST(NULL AS VARCHAR) AS value FROM cu UNION ALL SELECT 'states', state FROM cu UNION ALL SELECT 'raw_disposition', raw_disposition FROM cu
  UNION ALL SELECT 'outputs_produced', NULL FROM cu WHERE outputs_produced UNION ALL SELECT 'completed', NULL FROM cu WHERE outputs_produced AND gate_exit_final = 0 AND state <> 'invalidated_after_done'
  UNION ALL SELECT 'excluded_by_reason', terminal_reason FROM cu WHERE state = 'excluded'
  UNION ALL SELECT state || '_reasons', unnest(CASE WHEN len(reasons) > 0 THEN reasons ELSE ['unrecorded'] END) FROM cu WHERE state IN ('kept', 'disposition_held')) GROUP BY 1, 2""")
def a3(t: Tables):
    return ledger.campaign_summary(campaign(t))


@query("a4_unit_status", "payload", ctes=CAMPAIGN, sql="""
SELECT unit_key, array_to_string(list_concat(list_concat(CASE WHEN outputs_produced THEN ['outputs produced'] ELSE [] END, CASE WHEN outputs_produced AND gate_exit_final = 0 AND state <> 'invalidated_after_done' THEN ['completed'] ELSE [] END),
    CASE WHEN state = 'invalidated_after_done' THEN ['invalidated_after_done'] ELSE [] END), ';') AS terms, coalesce(outputs_produced AND gate_exit_final = 0 AND state <> 'invalidated_after_done', false) AS completed,
  outputs_produced AND state <> 'invalidated_after_done' AS outputs_valid, CASE state WHEN 'invalidated_after_done' THEN 'invalidated after done' WHEN 'kept' THEN 'kept for review'
    WHEN 'disposition_held' THEN CASE WHEN terminal_reason IS NULL AND raw_disposition = 'held' THEN 'disposition_held: disk' ELSE 'disposition_held' END ELSE '' END AS warnings FROM cu""")
def a4(t: Tables):
    c = campaign(t)
    holds = c.where("raw_disposition = 'held'").select("unit_key", F.lit("disk").alias("reason"))
    return ledger.unit_status(c, holds).select("unit_key", F.array_join("report_terms", ";").alias("terms"), "completed", "outputs_valid", F.array_join("warnings", ";").alias("warnings"))


@query("a5_remaining_work", "payload", "transition", ctes=CAMPAIGN + """,
cs AS (SELECT *, CASE WHEN substr(unit_key, -1) = '0' THEN 'split_parent' ELSE state END AS st FROM cu),
pt AS (SELECT parent_unit_key AS p, bool_and(st = 'disposition_held' AND next_attempt_at IS NULL) AS w FROM cs WHERE parent_unit_key IS NOT NULL AND st IN ('disposition_held', 'split_parent') GROUP BY 1)""", sql="""
SELECT count(*) FILTER (st IN ('disposition_held', 'split_parent') AND NOT ((st = 'disposition_held' AND next_attempt_at IS NULL) OR (st = 'split_parent' AND coalesce(w, false)))) AS open_units,
  (SELECT count(*) FROM transition WHERE to_state = 'click') AS pending_requests, count(*) FILTER (st NOT IN ('disposition_held', 'split_parent') AND raw_disposition = 'held') AS held_raw
FROM cs LEFT JOIN pt ON unit_key = p""")
def a5(t: Tables):
    c = campaign(t).withColumn("state", F.when(F.col("unit_key").endswith("0"), "split_parent").otherwise(F.col("state")))
    requests = t["transition"].select(F.when(F.col("to_state") != "click", F.col("at_us")).alias("handled_at"))
    return ledger.remaining_work(c, requests)


@query("a24_gate_rollup", "item", sql="""
SELECT * FROM (WITH c AS (SELECT unit_id, CASE role WHEN 'sample' THEN 'SUM-1' WHEN 'qc' THEN 'CLS-1' ELSE 'ORD-1' END AS check_id, CASE chromatography WHEN 'HILIC' THEN 'FAIL' WHEN 'RP' THEN 'pass' ELSE 'not_evaluable' END AS status,
    basis = 'declared' AS required, CASE ion_mode WHEN 'switching' THEN 'record_only' WHEN 'unknown' THEN 'odd' WHEN 'negative' THEN 'blocks_run' END AS rp FROM item),
  d AS (SELECT *, check_id = 'SUM-1' OR coalesce(rp <> 'record_only', false) AS rule FROM c)
SELECT unit_id, coalesce(string_agg(DISTINCT check_id, ',' ORDER BY check_id) FILTER (rule AND status = 'FAIL'), '') AS blocking,
  coalesce(string_agg(DISTINCT check_id, ',' ORDER BY check_id) FILTER (rule AND status = 'not_evaluable' AND required), '') AS unevaluated,
  coalesce(string_agg(DISTINCT check_id, ',' ORDER BY check_id) FILTER (coalesce(rp = 'odd', false) OR (check_id = 'SUM-1' AND coalesce(rp = 'record_only', false))), '') AS mismatches FROM d GROUP BY 1)""")
def a24(t: Tables):
    i = t["item"]
    c = i.select("unit_id", F.when(F.col("role") == "sample", "SUM-1").when(F.col("role") == "qc", "CLS-1").otherwise("ORD-1").alias("check_id"),
                 F.when(F.col("chromatography") == "HILIC", "FAIL").when(F.col("chromatography") == "RP", "pass").otherwise("not_evaluable").alias("status"),
                 (F.col("basis") == "declared").alias("required"), F.when(F.col("ion_mode") == "switching", "record_only").when(F.col("ion_mode") == "unknown", "odd").when(F.col("ion_mode") == "negative", "blocks_run").alias("run_policy"))
    return ledger.gate_rollup(c)


@query("a30_unit_record", "transition", "attempt", sql="""
SELECT unit_key, 'unit' AS section, CAST(0 AS BIGINT) AS seq, concat('{"state":"', max_by(to_state, seq), '","transitions":', count(*), '}') AS entry FROM transition GROUP BY unit_key
UNION ALL SELECT unit_key, 'transition', seq, concat('{"seq":', seq, ',"to_state":"', to_state, '"}') FROM transition
UNION ALL SELECT unit_key, 'attempt', attempt_id, concat('{"outcome":"', outcome, '","step":"', step, '"}') FROM attempt
UNION ALL SELECT unit_key, 'verdict', attempt_id, concat('{"exit_code":', k, ',"point":"final"}') FROM attempt WHERE outcome = 'ok'""")
def a30(t: Tables):
    tr, at = t["transition"], t["attempt"]
    verdicts = at.where("outcome = 'ok'").select("unit_key", F.col("attempt_id").alias("verdict_id"), F.col("k").alias("exit_code"), F.lit("final").alias("point"))
    return ledger.unit_record(ledger.current_state(tr), at, tr, verdicts)


@query("a33_run_rows", "attempt", sql="""
SELECT concat(unit_key, ':', attempt_id) AS run_id, concat('c', unit_key) AS catalog_unit_id, outcome,
  CASE WHEN attempt_id = max(attempt_id) OVER (PARTITION BY unit_key) THEN CASE v.x WHEN 0 THEN 'pass' WHEN 2 THEN 'fail' WHEN 3 THEN 'unusable' WHEN 4 THEN 'held' ELSE CASE WHEN v.x IS NULL THEN 'not_run' ELSE 'other' END END END AS gate_verdict
FROM attempt LEFT JOIN (SELECT unit_key, max_by(k % 5, attempt_id) AS x FROM attempt WHERE outcome = 'ok' GROUP BY 1) v USING (unit_key) WHERE step = 'download_start'""")
def a33(t: Tables):
    a = t["attempt"]
    runs = a.withColumn("step", F.when(F.col("step") == "download_start", "run").otherwise(F.col("step")))
    verdicts = a.where("outcome = 'ok'").select("unit_key", F.col("attempt_id").alias("verdict_id"), (F.col("k") % 5).alias("exit_code"))
    units = a.select("unit_key", F.concat(F.lit("c"), "unit_key").alias("catalog_unit_id")).distinct()
    return ledger.run_rows(units, runs, verdicts)


@query("q1_constraint_violations", "payload", "attempt", "transition", ctes=CAMPAIGN, sql="""
SELECT 'Q-UNIT' AS check_id, unit_key AS unit_id, 'state_domain' AS message FROM cu WHERE state = 'kept'
UNION ALL SELECT 'Q-UNIT', unit_key, 'terminal_needs_reason' FROM cu WHERE (state <> 'disposition_held') <> (terminal_reason IS NOT NULL)
UNION ALL SELECT 'Q-ATTEMPT', unit_key, 'outcome_domain' FROM attempt WHERE outcome = 'interrupted' UNION ALL SELECT 'Q-ATTEMPT', unit_key, 'counted_outcome' FROM attempt WHERE k < 10 AND outcome IN ('ok', 'busy', 'fault')
UNION ALL SELECT 'Q-REF', concat('U', user_id), 'unit_missing' FROM transition WHERE concat('U', user_id) NOT IN (SELECT unit_key FROM cu WHERE state <> 'excluded')
  AND concat('U', user_id) NOT IN (SELECT unit_key FROM cu WHERE state = 'excluded')""")
def q1(t: Tables):
    units = campaign(t).withColumnRenamed("unit_key", "unit_id").withColumn("failures", F.lit(0))
    attempts = t["attempt"].withColumnRenamed("unit_key", "unit_id").withColumn("counted", F.col("k") < 10)
    tr = t["transition"].withColumn("unit_id", F.concat(F.lit("U"), "user_id"))
    states = ("done", "invalidated_after_done", "excluded", "disposition_held")
    return ledger.constraint_violations(units, tr, attempts, states, ("ok", "failed", "fault", "busy")).select("check_id", "unit_id", "message")


@query("q1_append_only", "transition", sql="""
SELECT seq, CASE WHEN k = 1 THEN 'deleted' ELSE 'updated' END AS change FROM transition WHERE k = 1 OR (k = 2 AND to_state <> 'x')""")
def q1_history(t: Tables):
    tr = t["transition"]
    return ledger.append_only(tr, tr.where("k <> 1").withColumn("to_state", F.when(F.col("k") == 2, "x").otherwise(F.col("to_state"))), "seq", "to_state")


@query("g2_stalled", "transition", sql="""
SELECT * FROM (WITH a AS (SELECT *, k < 50 AS bytes, lag(k < 50) OVER w AS b0, row_number() OVER w AS rn FROM transition WINDOW w AS (PARTITION BY unit_key ORDER BY seq)),
  b AS (SELECT *, max(CASE WHEN rn = 1 OR b0 <> bytes THEN at_us END) OVER (PARTITION BY unit_key ORDER BY seq) AS since FROM a)
SELECT unit_key, seq, at_us - since AS idle_us FROM b WHERE at_us - since > 1800000000 AND to_state <> 'purchase')""")
def g2(t: Tables):
    p = t["transition"].select("unit_key", "seq", "at_us", (F.col("k") < 50).cast("int").alias("bytes"), (F.col("to_state") != "purchase").alias("fetching"))
    return ledger.stalled(p, 1_800_000_000)


@query("g3_stale_holder", "transition", sql="""
SELECT unit_key, seq, nx - at_us AS silence_us FROM (SELECT *, lead(at_us) OVER (PARTITION BY unit_key ORDER BY seq) AS nx FROM transition) WHERE nx IS NULL OR nx - at_us > 36000000000""")
def g3(t: Tables):
    return ledger.silent_gaps(t["transition"], 36_000_000_000)


@query("g6_attempt_rates", "attempt", sql="""
SELECT CAST((started_us // 900000000) * 900000000 - o.i * 900000000 AS BIGINT) AS window_us, step, outcome, count(*) AS n FROM attempt, range(4) o(i) GROUP BY 1, 2, 3""")
def g6(t: Tables):
    return ledger.attempt_rates(t["attempt"], 3_600_000_000, 900_000_000)


@query("g7_work_sessions", "attempt", sql="""
SELECT * FROM (WITH a AS (SELECT *, CASE WHEN started_us - lag(started_us) OVER w < 43200000000 THEN 0 ELSE 1 END AS nw FROM attempt WINDOW w AS (PARTITION BY unit_key ORDER BY started_us, attempt_id)),
  b AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY unit_key ORDER BY started_us, attempt_id) AS BIGINT) AS session FROM a)
SELECT unit_key, session, min(started_us) AS start_us, max(started_us) AS last_us, count(*) AS attempts FROM b GROUP BY 1, 2)""")
def g7(t: Tables):
    return ledger.work_sessions(t["attempt"], 43_200_000_000)


@query("g8_event_once", "transition", sql="SELECT to_state, unit_key, min(seq) AS seq, count(*) AS times FROM transition GROUP BY 1, 2")
def g8(t: Tables):
    return ledger.event_once(t["transition"], ["to_state", "unit_key"], "seq")


@query("g9_disk_watch", "attempt", sql="""
SELECT * FROM (WITH a AS (SELECT repository AS volume, attempt_id AS seq, k AS free, max(CASE WHEN k < 20 THEN attempt_id END) OVER w AS d, max(CASE WHEN k >= 60 THEN attempt_id END) OVER w AS u
  FROM attempt WINDOW w AS (PARTITION BY repository ORDER BY attempt_id)) SELECT volume, seq, free, coalesce(d, -1) > coalesce(u, -1) AS paused FROM a)""")
def g9(t: Tables):
    readings = t["attempt"].select(F.col("repository").alias("volume"), F.col("attempt_id").alias("seq"), F.col("k").alias("free"))
    return ledger.disk_watch(readings, F.lit(20), F.lit(60))


@query("g10_group_barrier", "transition", sql="""
SELECT concat('g', CAST(user_id AS VARCHAR)[1]) AS group_id, bool_and(s IN ('purchase', 'view', 'click')) AS open, count(*) FILTER (s NOT IN ('purchase', 'view', 'click')) AS waiting, count(*) AS members
FROM (SELECT user_id, max_by(to_state, seq) AS s FROM transition GROUP BY 1) GROUP BY 1""")
def g10(t: Tables):
    now = ledger.current_state(t["transition"]).select(F.concat(F.lit("g"), F.substring("unit_key", 2, 1)).alias("group_id"), "unit_key", "state")
    return ledger.group_barrier(now, ["purchase", "view", "click"])


@query("g11_approval_check", "transition", sql="""
SELECT seq, boundary, approval_id, CASE WHEN p.c_custkey IS NULL THEN 'missing' WHEN NOT list_contains(CASE WHEN p.c_acctbal > 5000 THEN ['click', 'error'] ELSE ['click', 'view', 'signup'] END, boundary) THEN 'not_covered'
  WHEN p.c_acctbal < 1000 AND at_us >= 1705000000000000 THEN 'revoked' ELSE 'ok' END AS result
FROM (SELECT seq, to_state AS boundary, user_id AS approval_id, at_us FROM transition) x LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') p ON approval_id = c_custkey""")
def g11(t: Tables):
    crossings = t["transition"].select("seq", F.col("to_state").alias("boundary"), F.col("user_id").alias("approval_id"), "at_us")
    approvals = t["customer"].where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("approval_id"), F.when(F.col("c_acctbal") > 5000, F.array(F.lit("click"), F.lit("error"))).otherwise(F.array(F.lit("click"), F.lit("view"), F.lit("signup"))).alias("covers"),
        F.when(F.col("c_acctbal") < 1000, F.lit(1705000000000000)).alias("revoked_us"))
    return ledger.approval_check(crossings, approvals)
