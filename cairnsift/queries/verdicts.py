"""The whole check catalogue over the driver's tables, and the session logs beside it."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.operators import catalogue, checks, transcripts
from cairnsift.queries.duplicates import TDUP
from cairnsift.queries.registry import QUERIES, Dialect, Tables, query, shape, with_shapes
from cairnsift.session import stored

DUCK = Dialect(False)
DOMAINS = {"role": ("sample", "qc"), "ion_mode": ("positive", "negative", "switching")}


def given(t: Tables) -> dict:
    """Every input of the catalogue."""
    none = lambda kind: F.array().cast(f"array<{kind}>")
    p = stored(t["payload"])
    unnamed = [none("bigint").alias("row_indices"), none("string").alias("member_paths")]
    calls = p.select("unit_id", F.explode(F.array(F.struct(F.lit(1).cast("bigint").alias("seq"), F.lit("read").alias("tool")), F.struct(F.lit(2).cast("bigint").alias("seq"), F.lit("write").alias("tool")))).alias("c"), F.col("status").alias("arguments"),
                     F.lit("r").alias("result"), F.lit(False).alias("is_error"), "ion_mode").select("unit_id", "c.*", "arguments", "result", "is_error", "ion_mode")
    path = F.concat("unit_id", F.lit(".jsonl"))
    words = lambda *w: F.array(*[F.lit(x) for x in w]).cast("array<string>")
    return {
        "documents": p, "items": t.stored("item"),
        "flags": stored(t["flag"].select("unit_id", F.when(F.col("certainty") == "confirmed", 1).otherwise(2).cast("bigint").alias("flag_no"), "code", *unnamed)),
        "questions": stored(t["question"].select("unit_id", F.lit(1).cast("bigint").alias("flag_no"), "code", *unnamed)), "children": stored(t["child"]),
        "answered": t["orders"].where("o_orderpriority = '1-URGENT'").select(F.concat(F.lit("U"), "o_orderkey").alias("unit_id"), F.explode(words("inferred_low_confidence", "shared_content")).alias("code")),
        "declared": t["unit"].select("unit_id", "ion_mode", F.lit("C18").alias("chromatography")), "domains": DOMAINS,
        "catalog": p.select("unit_id", F.lit(5).alias("catalog_row_count")).union(t["customer"].select(F.concat(F.lit("X"), "c_custkey"), F.lit(5))),
        "listing": t.stored("item_listing"), "shares": t["share"],
        "recorded_calls": calls.drop("ion_mode"), "shown_calls": calls.withColumn("tool", F.when((F.col("ion_mode") == "unknown") & (F.col("seq") == 2), "edit").otherwise(F.col("tool"))).drop("ion_mode"),
        "records": p.select("unit_id", path.alias("transcript_path"), F.lit("a").alias("transcript_sha256"), F.lit("m").alias("model_id"), F.lit("s").alias("session_id")),
        "transcripts": p.where("skill_version <> '1.2.9'").select(path.alias("path"), F.lit("a").alias("sha256")),
        "transcript_models": p.select(path.alias("path"), F.lit("m").alias("model"), F.lit("s").alias("session_id")),
        "contexts": p.select("unit_id", F.when(F.col("skill_version") == "dev", "local").otherwise("clean").alias("configuration"), words().alias("context_files"), F.lit("disabled").alias("memory"), words().alias("hooks"),
                             words("files").alias("mcp_servers"), words("files").alias("called_servers"), words("--clean").alias("harness_flags")),
        "answers": p.where("status = 'abstained'").select("unit_id", F.lit("x").alias("code"), F.when(F.col("ion_mode") == "both", " ").otherwise("ann").alias("by")),
    }


def whole(name: str) -> str:
    return f"SELECT check_id, severity, unit_id, subject, message FROM ({QUERIES[name].sql})"


def over(shapes: tuple[str, ...], body: str) -> str:
    return f"SELECT * FROM ({with_shapes(DUCK, shapes, body)})"


# The catalogue's counterpart is the union of the checks' own ones; only inputs that differ are spelled out.
DUP_SQL = over(("item", "item_listing", "payload", "flag", "question"), ", dup_flag AS (SELECT unit_id, CASE WHEN certainty = 'confirmed' THEN 1 ELSE 2 END AS flag_no, code, CAST(NULL AS VARCHAR) AS named_path, CAST(NULL AS BIGINT) AS named_row FROM flag), "
               "dup_question AS (SELECT concat('U', o_orderkey) AS unit_id, 1 AS flag_no, 'shared_content' AS code, CAST(9 AS BIGINT) AS named_row FROM orders WHERE o_orderpriority = '1-URGENT'),\n"
               + TDUP.replace("FROM dup_question q JOIN firmk k ON q.unit_id = k.unit_id AND q.named_row = k.row_index", "FROM dup_question q JOIN firmk k ON false") + " SELECT * FROM tdup")
LOG_SQL = over(("payload",), """ SELECT 'T-TOOLS' AS check_id, 'error' AS severity, unit_id, '2' AS subject, 'calls_part_here' AS message FROM payload WHERE ion_mode = 'unknown'
UNION ALL SELECT 'T-TRANSCRIPT', 'hold', unit_id, concat(unit_id, '.jsonl'), 'not_here' FROM payload WHERE skill_version = '1.2.9'
UNION ALL SELECT 'T-CONTEXT', 'hold', unit_id, unit_id, 'not_clean' FROM payload WHERE skill_version = 'dev'
UNION ALL SELECT 'T-PERSON', 'error', unit_id, 'x', 'no_name' FROM payload WHERE status = 'abstained' AND ion_mode = 'both'""")
ITEM_CHECKS = ("t_status", "t_queue", "t_pol_chrom_units", "t_confidence", "t_schema", "t_decl", "t_excl", "t_files", "t_acq")
FILE_CHECKS = ("t_excl_listing", "t_kept_and_excluded", "t_member", "t_excl_own_arm")
SHARED_SQL = f"SELECT 'T-SHARED' AS check_id, 'error' AS severity, unit_id, key AS subject, concat('not_returned_by_', other_unit_id) AS message FROM ({QUERIES['j6_shared_reciprocity'].sql})"
CHILD_SQL = f"SELECT 'T-CHILD' AS check_id, 'error' AS severity, unit_id, key AS subject, problem AS message FROM ({QUERIES['j9_child_members'].sql})"
SET_SQL = "SELECT 'T-SET' AS check_id, 'hold' AS severity, concat('X', c_custkey) AS unit_id, concat('X', c_custkey) AS subject, 'no_document' AS message FROM customer"
BARE = "\nUNION ALL ".join([whole(n) for n in ITEM_CHECKS] + [CHILD_SQL, LOG_SQL])
CATALOGUE_SQL = "\nUNION ALL ".join([BARE, *[whole(n) for n in ("t_cover", "t_uniq", *FILE_CHECKS)], SHARED_SQL, SET_SQL, DUP_SQL])


def findings(t: Tables):
    return catalogue.evaluate(given(t))


@query("a23_catalogue_verdict", "payload", sql=f"""
SELECT * FROM (WITH a AS MATERIALIZED ({CATALOGUE_SQL}), l AS (SELECT p.accession, p.unit_id, a.severity FROM payload p LEFT JOIN a USING (unit_id))
SELECT accession, unit_id, CASE WHEN bool_or(severity = 'error') THEN 'error' WHEN bool_or(severity = 'hold') THEN 'hold' ELSE 'pass' END AS verdict,
  count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'hold') AS holds FROM l GROUP BY GROUPING SETS ((accession, unit_id), (accession)))""")
def a23_all(t: Tables):
    return checks.verdict(findings(t), t["payload"])


@query("k1_catalogue_findings", sql=f"""
SELECT check_id, severity, unit_id, subject, message, CAST(position AS INTEGER) AS position, total FROM (
  SELECT *, row_number() OVER (PARTITION BY unit_id, check_id ORDER BY subject NULLS FIRST, message) AS position, count(*) OVER (PARTITION BY unit_id, check_id) AS total FROM ({CATALOGUE_SQL})) WHERE position <= 2""")
def k1_all(t: Tables):
    return checks.top_findings(findings(t), 2, kept=True)


def without(t: Tables, *names: str) -> dict:
    return {k: v for k, v in given(t).items() if k not in names}


LACKING = {"T-COVER": "catalog", "T-SET": "catalog", "T-MEMBER": "listing", "T-UNIQ": "listing, shares", "T-SHARED": "shares", "T-DUP": "listing"}
GONE = ", ".join(f"('{c}', 'not_evaluable: {n}')" for c, n in LACKING.items())


@query("c0_check_grid", "payload", sql=f"""
SELECT * FROM (WITH lack(check_id, message) AS (VALUES {GONE}), grid(check_id, grain) AS (VALUES {", ".join(f"('{c.id}', '{c.grain}')" for c in catalogue.CATALOGUE)}),
  f AS ({BARE} UNION ALL SELECT l.check_id, 'hold', unit_id, unit_id, l.message FROM payload, lack l)
SELECT g.check_id, g.grain, g.check_id NOT IN (SELECT check_id FROM lack) AS evaluable, (SELECT count(*) FROM payload) AS units, count(*) FILTER (severity = 'error') AS errors,
  count(*) FILTER (severity = 'hold') AS holds, count(DISTINCT unit_id) AS units_told FROM grid g LEFT JOIN f ON g.check_id = f.check_id GROUP BY 1, 2, 3)""")
def c0_grid(t: Tables):
    """Without catalogue rows, listing and shares: six checks hold every unit."""
    inputs = without(t, "catalog", "listing", "shares")
    return catalogue.coverage(catalogue.evaluate(inputs), inputs["documents"], inputs)


# Conversations as call logs: the transcript leaves out the last call of one in five, names another tool in the second
# call of one in five, and differs in arguments or results elsewhere.
@shape("call_log")
def call_log(d: Dialect) -> str:
    return f"""
SELECT concat('c', {d.text('conv_id')}) AS unit_id, conv_id, turn + 1 AS seq, role AS tool, md5(text) AS arguments, CASE WHEN turn % 3 = 2 THEN NULL ELSE {d.text('length(text)')} END AS result,
       length(text) % 7 = 0 AS is_error, count(*) OVER (PARTITION BY conv_id) AS calls FROM {d.table('conversations')}"""


@query("t_tools_transcript", "call_log", sql="""
SELECT * FROM (WITH d AS (SELECT *, CASE WHEN conv_id % 5 = 1 AND seq = calls THEN seq WHEN conv_id % 5 = 2 AND seq = 2 THEN seq END AS other,
    conv_id % 5 = 3 AND seq % 2 = 0 AS arg, conv_id % 5 = 4 AND result IS NOT NULL AND seq % 2 = 1 AS gone, conv_id % 5 = 4 AND result IS NOT NULL AND seq % 2 = 0 AS res FROM call_log)
SELECT 'T-TOOLS' AS check_id, 'error' AS severity, unit_id, CAST(min(other) AS VARCHAR) AS subject, 'calls_part_here' AS message FROM d WHERE other IS NOT NULL GROUP BY unit_id
UNION ALL SELECT 'T-TOOLS', 'error', unit_id, CAST(seq AS VARCHAR), 'arguments_differ' FROM d WHERE arg
UNION ALL SELECT 'T-TOOLS', 'error', unit_id, CAST(seq AS VARCHAR), 'result_not_shown' FROM d WHERE gone
UNION ALL SELECT 'T-TOOLS', 'error', unit_id, CAST(seq AS VARCHAR), 'result_differs' FROM d WHERE res
UNION ALL SELECT 'T-TOOLS', 'error', unit_id, 'shell', 'not_allowed' FROM d WHERE conv_id % 5 = 2 AND seq = 2)""")
def t_tools_logs(t: Tables):
    log = t["call_log"]
    kind = F.col("conv_id") % 5
    shown = log.where(~((kind == 1) & (F.col("seq") == F.col("calls")))).select(
        "unit_id", "seq", F.when((kind == 2) & (F.col("seq") == 2), "shell").otherwise(F.col("tool")).alias("tool"),
        F.when((kind == 3) & (F.col("seq") % 2 == 0), "x").otherwise(F.col("arguments")).alias("arguments"),
        F.when((kind == 4) & (F.col("seq") % 2 == 1), F.lit(None)).when((kind == 4) & F.col("result").isNotNull(), "y").otherwise(F.col("result")).alias("result"), "is_error")
    return transcripts.t_tools_transcript(log, shown, ("user", "assistant", "system", "tool"), width=3)


@query("t_transcript", "payload", sql="""
SELECT * FROM (WITH r AS (SELECT unit_id, CASE WHEN status = 'excluded' THEN NULL ELSE concat(unit_id, '.jsonl') END AS path, ion_mode, chromatography, skill_version FROM payload)
SELECT 'T-TRANSCRIPT' AS check_id, 'hold' AS severity, unit_id, path AS subject, 'not_named' AS message FROM r WHERE path IS NULL
UNION ALL SELECT 'T-TRANSCRIPT', 'hold', unit_id, path, 'not_here' FROM r WHERE path IS NOT NULL AND skill_version = '1.2.9'
UNION ALL SELECT 'T-RECORD', 'error', unit_id, path, 'other_bytes' FROM r WHERE path IS NOT NULL AND skill_version <> '1.2.9' AND ion_mode = 'both'
UNION ALL SELECT 'T-RECORD', 'error', unit_id, path, 'other_model' FROM r WHERE path IS NOT NULL AND skill_version <> '1.2.9' AND ion_mode IN ('negative', 'switching') AND chromatography = 'RP'
UNION ALL SELECT 'T-RECORD', 'error', unit_id, path, 'other_session' FROM r WHERE path IS NOT NULL AND skill_version <> '1.2.9' AND ion_mode = 'switching'
UNION ALL SELECT 'T-RECORD', 'hold', unit_id, 'unknown', 'model_unknown' FROM r WHERE path IS NOT NULL AND skill_version <> '1.2.9' AND ion_mode = 'unknown')""")
def t_transcript(t: Tables):
    p = t["payload"]
    path = F.concat("unit_id", F.lit(".jsonl"))
    records = p.select("unit_id", F.when(F.col("status") != "excluded", path).alias("transcript_path"), F.lit("a").alias("transcript_sha256"),
                       F.when(F.col("ion_mode") == "unknown", "unknown").otherwise("m").alias("model_id"), F.lit("s").alias("session_id"))
    there = p.where("skill_version <> '1.2.9'").select(path.alias("path"), F.when(F.col("ion_mode") == "both", "b").otherwise("a").alias("sha256"))
    seen = p.select(path.alias("path"), F.when(F.col("ion_mode").isin("negative", "switching") & (F.col("chromatography") == "RP"), "n").otherwise("m").alias("model"),
                    F.when(F.col("ion_mode") == "switching", "other").otherwise("s").alias("session_id"))
    return transcripts.t_transcript(records, there, seen)


@query("t_context", "payload", sql="""
SELECT 'T-CONTEXT' AS check_id, 'hold' AS severity, unit_id, unit_id AS subject, m.message FROM payload, (VALUES ('not_clean', 0), ('context_files', 1), ('memory', 2), ('hooks', 3), ('unlisted_server', 4), ('flags_not_stated', 5), ('server_not_allowed', 6), ('flag_missing', 7)) m(message, k)
WHERE o_orderkey % 8 = m.k""")
def t_context(t: Tables):
    k = F.col("o_orderkey") % 8
    words = lambda *w: F.array(*[F.lit(x) for x in w]).cast("array<string>")
    c = t["payload"].select("unit_id", F.when(k == 0, "local").otherwise("clean").alias("configuration"), F.when(k == 1, words("notes.md")).otherwise(words()).alias("context_files"), F.when(k == 2, "on").otherwise("disabled").alias("memory"),
                            F.when(k == 3, words("h")).otherwise(words()).alias("hooks"), F.when(k == 6, words("files", "web")).otherwise(words("files")).alias("mcp_servers"), F.when(k == 4, words("db")).otherwise(words("files")).alias("called_servers"),
                            F.when(k == 5, words()).when(k == 7, words("--quiet")).otherwise(words("--clean", "--quiet")).alias("harness_flags"))
    return transcripts.t_context(c, ("files",), ("--clean",))


@query("t_person", "payload", sql="SELECT 'T-PERSON' AS check_id, 'error' AS severity, unit_id, 'polarity' AS subject, 'no_name' AS message FROM payload WHERE ion_mode IN ('both', 'unknown')")
def t_person(t: Tables):
    by = F.when(F.col("ion_mode") == "both", "  ").when(F.col("ion_mode") != "unknown", "ann")
    return transcripts.t_person(t["payload"].select("unit_id", F.lit("polarity").alias("code"), by.alias("by")))


@query("t_class", "item", sql="""
SELECT 'T-CLASS' AS check_id, 'error' AS severity, unit_id, source AS subject, CASE WHEN field = 'path' THEN 'cited_in_field' WHEN value = 'negative' THEN 'cited_in_value' ELSE 'cited_in_detail' END AS message
FROM item WHERE field = 'path' OR value = 'negative' OR role = 'blank'""")
def t_class(t: Tables):
    c = t["item"].select("unit_id", "source", F.when(F.col("field") == "path", "Class_Proposal.groups").otherwise(F.col("field")).alias("field"),
                         F.when(F.col("value") == "negative", "see class-proposal").otherwise(F.col("value")).alias("value"), F.when(F.col("role") == "blank", "from the class proposal").alias("detail"))
    return transcripts.t_class(c, r"(?i)\bclass[ _-]?proposal")
