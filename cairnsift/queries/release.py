"""Release checks over the driver's texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.operators import planning, release
from cairnsift.queries.checks import ALL_SQL, FACTS, FACT_SHAPES, all_findings
from cairnsift.queries.registry import Tables, query
from cairnsift.operators import checks
from cairnsift.session import scratch
from cairnsift.sources import blocks

MAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
TOKEN = 'token = "[0-9a-f]{40}"'
BODY = "CASE WHEN lang = 'de' THEN concat(text, chr(10), 'see C:', chr(92), 'work', chr(92), 'x') ELSE text END"


def bundle(t: Tables):
    d = t["doc"]
    body = F.when(F.col("lang") == "de", F.concat("text", F.lit("\nsee C:\\work\\x"))).otherwise(F.col("text"))
    return d.select(F.concat(F.lit("triage/"), "path").alias("relative_path"), body.alias("text"), "lang")


def _hit(rule: str, pattern: str, text: str = "body") -> str:
    pos = f"strpos({text}, regexp_extract({text}, '{pattern}'))"
    before = f"substr({text}, 1, {pos} - 1)"
    return (f"SELECT concat('triage/', path) AS file, '{rule}' AS rule, CAST(strlen({before}) AS BIGINT) AS at, CAST(length({before}) - length(replace({before}, chr(10), '')) + 1 AS BIGINT) AS line "
            f"FROM b WHERE regexp_matches({text}, '{pattern}')")


FOUND = f"""b AS (SELECT path, lang, {BODY} AS body FROM doc),
fd AS ({_hit('email_address', MAIL)} UNION ALL {_hit('secret_token', TOKEN)}
  UNION ALL SELECT concat('triage/', path), 'drive_letter_path', CAST(strlen(body) - 9 AS BIGINT), CAST(length(body) - length(replace(body, chr(10), '')) + 1 AS BIGINT) FROM b WHERE lang = 'de')"""


def found(t: Tables):
    return release.redaction_findings(bundle(t), release.redaction_rules(secrets=[TOKEN]))


@query("d1_redaction_findings", "doc", ctes=FOUND, sql="SELECT * FROM fd")
def d1(t: Tables):
    return found(t)


@query("d1_redaction_verdict", "doc", ctes=FOUND, sql="SELECT (SELECT count(*) FROM b) AS files, count(*) AS findings, CASE WHEN count(*) > 0 THEN 'refused' ELSE 'pass' END AS verdict FROM fd")
def d1_verdict(t: Tables):
    return release.redaction_verdict(bundle(t), found(t))


# Documents as files: one file per kind and source, each holding its documents in order of their ids.
PLANTED = {1: "see C:\\work\\x", 3: "\\\\host\\share\\x", 5: "see https://h/lib.msp and /ref/lib.msp", 7: "Contents of /x/MEMORY.md", 9: "by Ann_1"}
CONTEXT = r"Contents of [^\r\n]{0,400}?MEMORY\.md"


def written(t: Tables) -> str:
    """The documents, each with its planted line, written as text files."""
    root = scratch(t.spark)
    line = F.lit("")
    for k, planted in PLANTED.items():
        line = F.when(F.col("doc_id") % 11 == k, "\n" + planted).otherwise(line)
    docs = t["doc"].select("doc_id", "lang", "source", F.concat("text", line).alias("value"))
    for kind, part in (("transcripts", docs.where("lang = 'de'")), ("triage", docs.where("lang <> 'de'"))):
        part.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "value").write.partitionBy("source").text(f"{root}/{kind}")
    return root


def short(path: str = "relative_path"):
    return F.regexp_replace(path, "source=([^/]*)/.*$", "$1")


WRITTEN = "w AS (SELECT doc_id, concat(CASE WHEN lang = 'de' THEN 'transcripts/' ELSE 'triage/' END, source) AS file, concat(text, CASE doc_id % 11 " + " ".join(
    f"WHEN {k} THEN concat(chr(10), '{v}')" for k, v in PLANTED.items()) + """ ELSE '' END) AS body FROM doc),
fl AS (SELECT file, doc_id, i, l[i] AS line FROM (SELECT file, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT file, doc_id, string_split(body, chr(10)) AS l FROM w))),
pl AS (SELECT file, line, CAST(sum(strlen(line) + 1) OVER o - strlen(line) - 1 AS BIGINT) AS off, row_number() OVER o AS line_no FROM fl WINDOW o AS (PARTITION BY file ORDER BY doc_id, i))"""
# (rule, pattern with what stands before the match as its first group, files)
SEEN = (("drive_letter_path", r"(^|[^A-Za-z0-9])[A-Za-z]:[\\/]", ""), ("unc_path", r"()^\\\\host", ""), ("library_path", "(/ref)/lib[.]msp", ""), ("context_block", "()Contents of .{0,400}MEMORY[.]md", "transcripts"),
        ("email_address", f"(){MAIL}", ""), ("secret_token", f"(){TOKEN}", ""), ("operator_name", "(?i)(^|[^A-Za-z])ann([^A-Za-z]|$)", ""))


def _seen(rule: str, pattern: str, where: str) -> str:
    match, g = f"regexp_extract(line, '{pattern}')", f"regexp_extract(line, '{pattern}', 1)"
    at = f"off + strlen(substr(line, 1, strpos(line, {match}) - 1)) + strlen({g})"
    back = "CASE WHEN off > 0 THEN 1 ELSE 0 END" if rule == "unc_path" else "0"
    return f"SELECT file, '{rule}' AS rule, CAST({at} - {back} AS BIGINT) AS at, line_no - {back} AS line FROM pl WHERE regexp_matches(line, '{pattern}') AND starts_with(file, '{where}')"


@query("d1_file_scan", "doc", ctes=WRITTEN + ", hits AS (" + " UNION ALL ".join(_seen(*x) for x in SEEN) + ")", sql="SELECT file, rule, min(h.at) AS at, min_by(line, h.at) AS line FROM hits h GROUP BY file, rule")
def d1_files(t: Tables):
    rules = release.redaction_rules(terms=["ann"], context=[CONTEXT], secrets=[TOKEN])
    return release.redaction_scan(blocks.raw_lines(t.spark, written(t)), rules).withColumn("file", short("file"))


@query("s10_file_lines", "doc", ctes=WRITTEN, sql="SELECT file, off AS \"offset\", line_no, md5(line) AS digest FROM pl")
def s10_lines(t: Tables):
    lines = blocks.file_lines(t.spark, written(t))
    return lines.select(short().alias("file"), "offset", "line_no", F.md5(F.encode("text", blocks.LATIN)).alias("digest"))


@query("s7_jsonl_files", "doc", ctes=WRITTEN, sql="""
SELECT file, row_number() OVER (PARTITION BY file ORDER BY line_no) AS line_no, md5(line) AS digest, starts_with(line, '{') AS readable FROM pl WHERE trim(line, chr(32) || chr(9) || chr(13)) <> ''""")
def s7_files(t: Tables):
    found = blocks.json_lines(blocks.file_lines(t.spark, written(t)))
    return found.select(short().alias("file"), "line_no", F.md5("raw_line").alias("digest"), F.col("entry").isNotNull().alias("readable"))


@query("d2_library_names", "doc", sql="SELECT DISTINCT concat('lib_', source, '.msp') AS name FROM doc")
def d2(t: Tables):
    d = t["doc"].select(F.concat("text", F.lit(" <library:lib_"), "source", F.lit(".msp sha256="), F.repeat(F.lit("aB"), 32), F.lit(">")).alias("text"))
    return release.library_names(d)


@query("i22_shared_artefacts", sql="""
WITH b AS (SELECT page_id, concat(html, CASE WHEN page_id % 2 = 0 THEN concat(' /home/', page_id, '/out ') ELSE '' END) AS body FROM pages)
SELECT concat('p', page_id) AS file, 'user_profile_path' AS rule FROM b WHERE page_id % 2 = 0
UNION ALL SELECT concat('p', page_id), 'operator_name' FROM b WHERE regexp_matches(body, '(?i)(^|[^a-z])ththre([^a-z]|$)')""")
def i22(t: Tables):
    p = t["pages"]
    body = F.concat("html", F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" /home/"), "page_id", F.lit("/out "))).otherwise(""))
    files = p.select(F.concat(F.lit("p"), "page_id").alias("relative_path"), body.alias("text"))
    rules = [r for r in release.redaction_rules(terms=["ththre"]) if r[0] in ("user_profile_path", "operator_name")]
    return release.redaction_findings(files, rules).select("file", "rule")


@query("s18_release_index", "doc", sql="""
SELECT concat('triage/', path) AS path, sha256(b) AS original_sha256, sha256(CASE WHEN lang = 'de' AND source <> 'src1' THEN concat(text, chr(10), 'x.raw,a') ELSE b END) AS release_sha256, lang = 'de' AND source <> 'src1' AS projected
FROM (SELECT *, CASE WHEN lang = 'de' THEN concat(text, chr(10), 'D:', chr(92), 'w', chr(92), 'raw', chr(92), 'x.raw,a') ELSE text END AS b FROM doc)""")
def s18(t: Tables):
    d = t["doc"]
    body = F.when(F.col("lang") == "de", F.concat("text", F.lit("\nD:\\w\\raw\\x.raw,a"))).otherwise(F.col("text"))
    files = d.select(F.concat(F.lit("triage/"), "path").alias("relative_path"), body.alias("text"), "source")
    return release.release_index(files, "D:\\w\\raw", F.col("source") == "src1")


@query("s16_canonical_rows", "payload", "item", sql="""
SELECT unit_id, sha256(sha256(string_agg(e, chr(10) ORDER BY row_index, e))) AS digest, count(*) AS entries FROM (
  SELECT unit_id, row_index, concat('{"member_path":', CASE WHEN member_path IS NULL THEN 'null' ELSE concat('"', member_path, '"') END, ',"sample_id":"', sample_id, '"}') AS e FROM item WHERE row_index IS NOT NULL) GROUP BY 1""")
def s16(t: Tables):
    from cairnsift.functions.text import canonical_json
    i = t["item"].where("row_index IS NOT NULL")
    return planning.entries_digest(i, "unit_id", F.col("row_index"), canonical_json({"member_path": F.col("member_path"), "sample_id": F.col("sample_id")}))


@query("s17_export_decisions", *FACT_SHAPES, ctes=FACTS, sql=f"""
SELECT p.unit_id, p.accession, p.status, p.skill_version, c.n_rows_kept, c.n_rows_excluded, c.n_members_added, c.n_declared, c.n_inferred, c.n_low_confidence, sha256(sha256(p.unit_id)) AS inputs_sha256,
  CASE WHEN list_contains(sv, 'error') THEN 'error' WHEN list_contains(sv, 'hold') THEN 'hold' ELSE 'pass' END AS validator_verdict, CASE WHEN p.ion_mode = 'both' THEN 'ann' END AS reviewer,
  CASE WHEN p.ion_mode <> 'both' THEN 'none' WHEN p.chromatography = 'RP' THEN 'revised' ELSE 'answered' END AS person_review, CASE WHEN p.status = 'excluded' THEN 'excluded' WHEN p.chromatography = 'RP' THEN 'revised' ELSE 'accepted' END AS final_state,
  p.status <> 'ready' AS replay_inputs_equal
FROM payload p LEFT JOIN (SELECT unit_id, count(*) FILTER (kind = 'row') AS n_rows_kept, count(*) FILTER (kind = 'excluded_row') AS n_rows_excluded, count(*) FILTER (kind = 'added_member') AS n_members_added,
    count(*) FILTER (reason IS NULL AND basis = 'declared') AS n_declared, count(*) FILTER (reason IS NULL AND basis = 'inferred') AS n_inferred, count(*) FILTER (reason IS NULL AND confidence = 'low') AS n_low_confidence FROM item GROUP BY 1) c USING (unit_id)
  LEFT JOIN (SELECT unit_id, list(DISTINCT severity) AS sv FROM ({ALL_SQL}) GROUP BY 1) f USING (unit_id)""")
def s17(t: Tables):
    p = t["payload"]
    decisions = p.select("unit_id", "accession", "status", "skill_version", F.when(F.col("chromatography") == "RP", "older").alias("supersedes"))
    inputs = p.select("unit_id", F.sha2("unit_id", 256).alias("sha256"))
    verdicts = checks.verdict(all_findings(t), p).where("unit_id IS NOT NULL").select("unit_id", "verdict")
    answers = p.where("ion_mode = 'both'").select("unit_id", F.lit("ann").alias("by"))
    replays = p.select("unit_id", F.lit("inputs").alias("check_id"), F.when(F.col("status") == "ready", "different").otherwise("equal").alias("result"))
    out = release.export_decisions(decisions, t["item"], inputs, verdicts, answers, replays)
    return out.select("unit_id", "accession", "status", "skill_version", "n_rows_kept", "n_rows_excluded", "n_members_added", "n_declared", "n_inferred", "n_low_confidence", "inputs_sha256",
                      "validator_verdict", "reviewer", "person_review", "final_state", "replay_inputs_equal")
