"""Log checks over chains that Spark builds from the driver's events."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift import vocab
from cairnsift.functions import text
from cairnsift.operators import logs
from cairnsift.queries.registry import Dialect, Tables, query, shape
from cairnsift.scale import blocks, ordered

# Each user's events are one log; a line's digest is broken where k is 7, its number where k is 9.
CHAIN = """ln AS (SELECT unit_key AS file, seq AS event, to_state AS kind, k, row_number() OVER (PARTITION BY unit_key ORDER BY seq) AS line_no, concat(to_state, ' ', seq, ' ', k) AS raw_line, user_id FROM transition),
lc AS (SELECT *, CASE WHEN k = 7 THEN 'broken' ELSE lag(sha256(raw_line)) OVER (PARTITION BY file ORDER BY line_no) END AS prev_sha256, CASE WHEN k = 9 THEN line_no + 1 ELSE line_no END AS seq FROM ln)"""


def chain(t: Tables):
    tr = t["transition"].withColumnRenamed("unit_key", "file").withColumn("raw_line", F.concat_ws(" ", "to_state", F.col("seq").cast("string"), F.col("k").cast("string")))
    run = ordered(tr, ["file"], ["seq"], blocks("seq", 1 << 16), lag={"prev": text.sha256("raw_line")}, row_number="line_no")
    return run.select("file", F.col("seq").alias("event"), F.col("to_state").alias("kind"), "k", "line_no", "raw_line",
                      F.when(F.col("k") == 7, "broken").otherwise(F.col("prev")).alias("prev_sha256"),
                      F.when(F.col("k") == 9, F.col("line_no") + 1).otherwise(F.col("line_no")).alias("seq"))


@query("w2_chain_check", "transition", ctes=CHAIN, sql="""
SELECT file, line_no, k = 9 AS bad_seq, k = 7 AS bad_prev FROM lc WHERE k IN (7, 9)""")
def w2(t: Tables):
    return logs.chain_check(chain(t))


@query("d_head", "transition", ctes=CHAIN, sql="SELECT file, sha256(max_by(raw_line, line_no)) AS head_sha256, count(*) AS lines FROM ln GROUP BY 1")
def d_head(t: Tables):
    return logs.log_heads(chain(t))


@query("d_lines", "transition", ctes=CHAIN, sql="""
SELECT 'D-ENTRY' AS check_id, file AS unit_id, CAST(line_no AS VARCHAR) AS subject FROM ln WHERE kind = 'view' UNION ALL SELECT 'D-CHAIN', file, CAST(line_no AS VARCHAR) FROM ln WHERE k < 3
UNION ALL SELECT 'D-PATH', file, CAST(line_no AS VARCHAR) FROM ln WHERE k = 5""")
def d_lines(t: Tables):
    lines = chain(t).select("file", "line_no", "kind", F.when(F.col("k") < 3, "guess").otherwise("source_fact").alias("standing"),
                            F.when(F.col("k") == 5, F.concat("raw_line", F.lit(" D:\\work\\x"))).otherwise(F.col("raw_line")).alias("raw_line"))
    return logs.ledger_line_checks(lines, ("click", "error", "purchase", "signup"), ("source_fact", "model_inference"), list(vocab.PATH_RULES)).select("check_id", "unit_id", "subject")


# A decision supersedes the user's event before it unless k >= 70, which starts anew.
TREE = """dv AS (SELECT seq AS id, unit_key, k, to_state, CASE WHEN k < 70 THEN lag(seq) OVER (PARTITION BY unit_key ORDER BY seq) END AS supersedes FROM transition),
dn AS (SELECT *, sum(CASE WHEN supersedes IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY unit_key ORDER BY id) AS run FROM dv),
tree AS (SELECT *, min(id) OVER (PARTITION BY unit_key, run) AS root, row_number() OVER (PARTITION BY unit_key, run ORDER BY id) - 1 AS depth, max(id) OVER (PARTITION BY unit_key, run) AS leaf FROM dn)"""


def decisions(t: Tables):
    run = ordered(t["transition"], ["unit_key"], ["seq"], blocks("seq", 1 << 16), lag={"before": "seq"})
    return run.select(F.col("seq").alias("id"), "unit_key", "k", "to_state", F.when(F.col("k") < 70, F.col("before")).alias("supersedes"))


@query("j18_lineage", "transition", ctes=TREE, sql="SELECT id, root, depth, false AS cyclic FROM tree")
def j18(t: Tables):
    return logs.Lineage(decisions(t)).nodes


@query("l_cause", "transition", ctes=TREE, sql="""
SELECT b.unit_key AS file, b.id AS line_no, CASE WHEN c.id IS NULL OR c.to_state <> 'click' THEN 'absent' WHEN c.id >= b.id THEN 'later' ELSE 'other_lineage' END AS problem
FROM tree b LEFT JOIN tree c ON c.unit_key = b.unit_key AND c.id = b.id - b.k * 3 + 20
WHERE NOT coalesce(c.to_state = 'click' AND c.id < b.id AND c.root = b.root, false)""")
def l_cause(t: Tables):
    d = decisions(t)
    revisions = d.select(F.col("unit_key").alias("file"), F.col("id").alias("line_no"), F.col("id").alias("new_decision_id"), F.lit("click").alias("cause_kind"),
                         (F.col("id") - F.col("k") * 3 + 20).alias("cause_seq"))
    log = d.select(F.col("unit_key").alias("file"), F.col("id").alias("seq"), F.col("to_state").alias("kind"), F.col("id").alias("decision_id"))
    return logs.cause_checks(revisions, log, logs.Lineage(d))


@query("l_entry", "transition", ctes=CHAIN, sql="""
SELECT 'L-ENTRY' AS check_id, file AS unit_id, CAST(line_no AS VARCHAR) AS subject, 'unknown_kind' AS message FROM ln WHERE kind = 'view'
UNION ALL SELECT 'L-ENTRY', file, CAST(line_no AS VARCHAR), 'extra_fields' FROM ln WHERE kind = 'error' AND k < 20
UNION ALL SELECT 'L-PAYLOAD', file, CAST(line_no AS VARCHAR), 'no_payload' FROM ln WHERE event NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')""")
def l_entry(t: Tables):
    base = F.array(F.lit("seq"), F.lit("at"), F.lit("kind"), F.lit("decision_id"), F.lit("prev_sha256"), F.lit("by"))
    entries = chain(t).select("file", "line_no", "kind", F.when(F.col("k") < 20, F.array_append(base, "note")).otherwise(base).alias("fields"), F.col("event").alias("decision_id"))
    payloads = t["orders"].where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"))
    kinds = {"click": ("by", "note"), "error": ("by",), "purchase": ("by", "note"), "signup": ("by", "note")}
    return logs.entry_checks(entries, kinds, payloads).drop("severity")


@query("u3_dropped_flags", "transition", ctes=TREE, sql="""
SELECT supersedes AS old_id, id AS new_id, f.code FROM tree t, (VALUES ('shared_content'), ('ms1_only'), ('polarity_switching')) f(code) WHERE supersedes IS NOT NULL
  AND (SELECT k FROM tree p WHERE p.id = t.supersedes) % 2 = 0 AND NOT (k % 3 = 0 AND f.code = 'ms1_only') AND NOT (k % 5 = 0 AND f.code = 'shared_content')""")
def u3(t: Tables):
    d = decisions(t)
    codes = lambda *c: F.explode(F.array(*[F.lit(x) for x in c])).alias("code")
    old = d.where("k % 2 = 0").select("id", codes("shared_content", "ms1_only", "polarity_switching"))
    new = d.where("k % 3 = 0").select("id", codes("ms1_only"))
    answers = d.where("k % 5 = 0").select(F.col("id").alias("new_id"), codes("shared_content"))
    revisions = d.where("supersedes IS NOT NULL").select(F.col("supersedes").alias("old_id"), F.col("id").alias("new_id"))
    return logs.dropped_flags(old, new, revisions, answers)


@query("u6_open_questions", "transition", ctes=TREE, sql="""
SELECT l.id, c.code FROM tree l, (VALUES ('click'), ('error')) c(code) WHERE l.id = l.leaf
  AND NOT EXISTS (SELECT 1 FROM tree a WHERE a.root = l.root AND a.to_state = c.code AND a.id <= l.id)""")
def u6(t: Tables):
    d = decisions(t)
    current = d.join(d.select(F.col("supersedes").alias("id")).where("id IS NOT NULL").distinct(), "id", "left_anti").select("id")
    asked = current.select("id", F.explode(F.array(F.lit("click"), F.lit("error"))).alias("code"))
    answers = d.where("to_state IN ('click', 'error')").select(F.col("id").alias("decision_id"), F.col("to_state").alias("code"))
    return logs.open_questions(current, asked, answers, logs.Lineage(d))


@query("i20_latest_readings", "doc", "transition", sql="""
SELECT doc_id AS id, coalesce(v.verdict, 'open') AS verdict, coalesce(v.readings, 0) AS readings FROM doc LEFT JOIN (
  SELECT tr.digest, max_by(tr.to_state, tr.seq) AS verdict, count(*) AS readings FROM (SELECT CASE WHEN x.k < 90 THEN y.digest ELSE 'none' END AS digest, x.to_state, x.seq FROM transition x JOIN doc y ON y.doc_id = x.user_id) tr GROUP BY 1) v ON v.digest = doc.digest""")
def i20(t: Tables):
    d = t["doc"].select(F.col("doc_id").alias("id"), "digest")
    readings = t["transition"].join(d, F.col("user_id") == F.col("id")).select(F.when(F.col("k") < 90, F.col("digest")).otherwise("none").alias("digest"), "seq", F.col("to_state").alias("verdict"))
    return logs.latest_readings(readings, d)


# Events as lines of five decision ledgers: clicks record a triage, purchases validate one.
@shape("ledger_line", "transition")
def ledger_line(d: Dialect) -> str:
    sha = "sha2(concat(unit_key, '-', cast(k AS string)), 256)" if d.spark else "sha256(concat(unit_key, '-', k))"
    head = f"sha2(concat('A', {d.text('seq % 10')}, ':', {d.text('k')}), 256)" if d.spark else f"sha256(concat('A', {d.text('seq % 10')}, ':', {d.text('k')}))"
    path = f"concat('A', {d.text('k % 10')}, '/', unit_key, '_', {d.text('k')}, '.json')"
    return f"""
SELECT concat('l', {d.text('user_id % 5')}) AS file, seq AS line_no, unit_key, k,
       CASE to_state WHEN 'click' THEN 'triage_recorded' WHEN 'purchase' THEN 'triage_validated' ELSE 'note' END AS kind,
       CASE WHEN k BETWEEN 50 AND 59 THEN concat('c', {d.text('k')}) ELSE {sha} END AS triage_sha256,
       CASE WHEN k BETWEEN 50 AND 59 THEN concat('handoffs/', unit_key, '_', {d.text('k')}, '.json') WHEN k >= 10 THEN {path} END AS triage_path,
       CASE WHEN k BETWEEN 50 AND 59 THEN {sha} END AS derived_sha256, CASE WHEN k BETWEEN 50 AND 59 THEN {path} END AS derived_path,
       CASE WHEN to_state = 'purchase' AND k < 90 THEN {head} END AS head_sha256, concat('A', {d.text('seq % 10')}) AS accession, {sha} AS sha, {path} AS path
FROM transition"""


@query("d_triage", "ledger_line", sql="""
SELECT * FROM (WITH p AS (SELECT DISTINCT sha FROM ledger_line WHERE k % 3 <> 0),
  f AS (SELECT DISTINCT path, CASE WHEN k % 5 = 0 THEN 'x' ELSE sha END AS actual FROM ledger_line WHERE k % 4 <> 0
    UNION SELECT DISTINCT triage_path, CASE WHEN k % 4 = 0 THEN triage_sha256 ELSE 'z' END FROM ledger_line WHERE k BETWEEN 50 AND 59 AND k % 2 = 0),
  g AS (SELECT concat('A', j) AS accession, sha256(concat('A', j, ':', i)) AS h FROM range(10) a(j), range(50) b(i)),
  r AS (SELECT *, coalesce(derived_path, triage_path) AS pth, coalesce(derived_sha256, triage_sha256) AS s FROM ledger_line),
  a AS (SELECT *, last_value(CASE WHEN kind = 'triage_recorded' THEN regexp_extract(pth, '^(.*)/', 1) END IGNORE NULLS) OVER (PARTITION BY file, unit_key ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM r),
  t AS (SELECT r.*, p.sha IS NOT NULL AS known, f.actual, c.actual AS child FROM r LEFT JOIN p ON r.s = p.sha LEFT JOIN f ON r.pth = f.path LEFT JOIN f c ON r.derived_path IS NOT NULL AND r.triage_path = c.path WHERE kind = 'triage_recorded')
SELECT 'D-TRIAGE' AS check_id, file AS unit_id, CAST(line_no AS VARCHAR) AS subject, 'child_differs' AS message FROM t WHERE child <> triage_sha256
UNION ALL SELECT 'D-TRIAGE', file, CAST(line_no AS VARCHAR), 'no_payload' FROM t WHERE NOT known
UNION ALL SELECT 'D-TRIAGE', file, CAST(line_no AS VARCHAR), CASE WHEN actual IS NULL THEN 'not_there' ELSE 'other_digest' END FROM t WHERE known AND pth IS NOT NULL AND actual IS DISTINCT FROM s
UNION ALL SELECT 'D-HEAD', file, CAST(line_no AS VARCHAR), 'no_such_line' FROM a WHERE kind = 'triage_validated' AND head_sha256 IS NOT NULL AND (coalesce(latest, accession), head_sha256) NOT IN (SELECT (accession, h) FROM g))""")
def d_triage(t: Tables):
    e = t.stored("ledger_line")
    payloads = e.where("k % 3 <> 0").select(F.col("sha").alias("sha256"))
    own = e.where("k % 4 <> 0").select("path", F.when(F.col("k") % 5 == 0, "x").otherwise(F.col("sha")).alias("sha256"))
    children = e.where("k BETWEEN 50 AND 59 AND k % 2 = 0").select(F.col("triage_path").alias("path"), F.when(F.col("k") % 4 == 0, F.col("triage_sha256")).otherwise("z").alias("sha256"))
    lines = t.spark.range(500).select(F.concat(F.lit("A"), (F.col("id") / 50).cast("int")).alias("accession"), F.sha2(F.concat(F.lit("A"), (F.col("id") / 50).cast("int"), F.lit(":"), F.col("id") % 50), 256).alias("sha256"))
    return logs.triage_checks(e, payloads, own.union(children).distinct(), lines).drop("severity")
