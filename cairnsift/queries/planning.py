"""Planning operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.functions import names, policy, text
from cairnsift.operators import checks, ledger, planning
from cairnsift.queries import duck
from cairnsift.queries.checks import FACTS, FACT_SHAPES, facts
from cairnsift.queries.registry import Tables, query
from cairnsift.session import scratch, stored
from cairnsift.sources import canonical, files

DECLARED = "separation = 'LC-MS' AND acquisition_mode IN ('DDA', 'DIA', 'AIF', 'SWATH') AND (untargeted IS NULL OR untargeted <> 0) AND ion_mode IN ('Positive', 'Negative', 'Both')"
UNKNOWN = DECLARED.replace("acquisition_mode IN ('DDA', 'DIA', 'AIF', 'SWATH')", "acquisition_mode = 'Unknown'")
FILES = """ff AS (SELECT unit_id, count(*) AS file_count, count(*) FILTER (role IN ('raw', 'converted')) AS analysis_files,
  count(*) FILTER (role IN ('raw', 'converted') AND regexp_matches(path, '(?i)\\.mzdata(\\.xml)?$')) AS mzdata_files FROM raw_file GROUP BY 1)"""
POOLED = FILES + f""",
pooled AS (SELECT u.*, CASE WHEN {DECLARED} THEN 'declared' ELSE 'acquisition_unknown' END AS pool, coalesce(file_count, 0) AS file_count,
  coalesce(analysis_files, 0) AS analysis_files, coalesce(mzdata_files, 0) AS mzdata_files FROM unit u LEFT JOIN ff USING (unit_id) WHERE ({DECLARED}) OR ({UNKNOWN}))"""


@query("p1_select_pool", "unit", "raw_file", ctes=FILES, sql=f"""
SELECT unit_id, repository, accession, coalesce(file_count, 0) AS file_count, coalesce(analysis_files, 0) AS analysis_files, coalesce(mzdata_files, 0) AS mzdata_files
FROM unit LEFT JOIN ff USING (unit_id) WHERE {DECLARED}""")
def p1(t: Tables):
    return planning.select_pool(t["unit"], t["raw_file"], "declared").select(
        "unit_id", "repository", "accession", "file_count", "analysis_files", "mzdata_files")


@query("u1_union_pools", "unit", "raw_file", ctes=POOLED, sql="SELECT pool, count(*) AS units, CAST(sum(file_count) AS BIGINT) AS files FROM pooled GROUP BY 1")
def u1(t: Tables):
    return planning.union_pools(t["unit"], t["raw_file"], ["declared", "acquisition_unknown"]).groupBy("pool").agg(
        F.count("*").alias("units"), F.sum("file_count").alias("files"))


@query("p2_select_named", "unit", sql=f"""
SELECT w.unit_id, CASE WHEN u.unit_id IS NULL THEN 'unknown' WHEN {DECLARED} THEN 'declared' WHEN {UNKNOWN} THEN 'acquisition_unknown' ELSE 'outside' END AS found
FROM (SELECT DISTINCT concat('U', l_orderkey + l_suppkey) AS unit_id FROM lineitem) w LEFT JOIN unit u USING (unit_id)""")
def p2(t: Tables):
    wanted = t["lineitem"].select(F.concat(F.lit("U"), F.col("l_orderkey") + F.col("l_suppkey")).alias("unit_id"))
    return planning.select_named(t["unit"], wanted)


PRIOR_SQL = """prior AS (SELECT concat('U', l_orderkey) AS unit_id, CASE WHEN l_quantity > 3 THEN 'c1' WHEN l_tax < 0.02 THEN NULL WHEN l_tax < 0.06 THEN 'c1' ELSE 'c2' END AS campaign_id,
  CASE WHEN l_quantity <= 3 AND l_linestatus = 'O' THEN 'done' ELSE 'failed' END AS state FROM lineitem),
reop AS (SELECT concat('U', o_orderkey) AS unit_id FROM orders WHERE o_orderpriority = '1-URGENT'),
wsr AS (SELECT unit_id, CASE WHEN bool_or(campaign_id IS NULL) THEN 'preexisting_workspace' WHEN bool_or(campaign_id IS NOT NULL AND NOT
  coalesce(campaign_id = 'c1' AND (state = 'failed' OR (state = 'done' AND unit_id IN (SELECT unit_id FROM reop))), false)) THEN 'campaign_workspace' END AS workspace_reason FROM prior GROUP BY 1)"""


def prior(t: Tables):
    li, old = t["lineitem"], F.col("l_quantity") <= 3
    p = li.select(F.concat(F.lit("U"), "l_orderkey").alias("unit_id"),
                  F.when(~old, "c1").when(F.col("l_tax") < 0.02, F.lit(None)).when(F.col("l_tax") < 0.06, "c1").otherwise("c2").alias("campaign_id"),
                  F.when(old & (F.col("l_linestatus") == "O"), "done").otherwise("failed").alias("state"))
    reopen = t["orders"].where("o_orderpriority = '1-URGENT'").select(F.concat(F.lit("U"), "o_orderkey").alias("unit_id"))
    return p, reopen


@query("p7_prior_work", "unit", ctes=PRIOR_SQL, sql="SELECT unit_id, workspace_reason FROM unit LEFT JOIN wsr USING (unit_id)")
def p7(t: Tables):
    p, reopen = prior(t)
    return planning.prior_work(t["unit"], p, ["c1"], reopen).select("unit_id", "workspace_reason")


MOBILITY_SQL = """mob AS (SELECT u.unit_id, u.instrument LIKE '%tims%' OR s.n IS NOT NULL AS signal, coalesce(b.b, false) AS beside FROM unit u
  LEFT JOIN (SELECT unit_id, count(*) AS n FROM raw_file WHERE l_quantity = 50 GROUP BY 1) s USING (unit_id)
  LEFT JOIN (SELECT unit_id, bool_or(l_quantity < 4) AS b FROM raw_file GROUP BY 1) b USING (unit_id))"""


def mobility(t: Tables):
    rf = t["raw_file"]
    samples = rf.select("unit_id", F.lit("Instrument name").alias("field"), F.when(F.col("l_quantity") == 50, "Waters SYNAPT").otherwise("QTOF").alias("value"))
    formats = rf.select("unit_id", F.when(F.col("l_quantity") < 4, "bruker_baf").otherwise("mzml").alias("format"))
    return planning.ion_mobility_reading(t["unit"], samples, formats)


@query("p4_ion_mobility", "unit", "raw_file", ctes=MOBILITY_SQL, sql="""
SELECT unit_id, signal AND NOT beside AS excluded, signal, CASE WHEN signal AND beside THEN 'mixed' WHEN signal THEN 'enabled' ELSE 'unknown' END AS state FROM mob""")
def p4(t: Tables):
    return mobility(t)


# A row states a method where its flag and status agree with the file name's; see the shape.
FRAG_SQL = """smp AS (SELECT unit_id, concat('S', l_linenumber) AS sample_id, l_quantity, l_returnflag FROM raw_file),
shared_methods AS (SELECT 1),
able AS (SELECT unit_id, accession, instrument, o_orderkey, instrument = 'unknown' OR instrument = 'SCIEX ZenoTOF 7600' AS ead, instrument IN ('unknown', 'Thermo', 'Thermo Orbitrap Fusion') AS etd FROM unit),
hit AS (SELECT DISTINCT s.unit_id, s.sample_id, s.l_quantity = 30 AS states FROM smp s JOIN able a USING (unit_id) WHERE s.l_quantity = 30 OR (s.l_quantity = 31 AND a.ead)),
st AS (SELECT DISTINCT unit_id, sample_id FROM hit WHERE states),
nm AS (SELECT unit_id, count(DISTINCT sample_id) AS named_samples FROM hit GROUP BY 1), al AS (SELECT unit_id, count(DISTINCT sample_id) AS samples FROM smp GROUP BY 1),
fl AS (SELECT r.unit_id, r.path, bool_or((contains(r.path, '_EAD') AND a.ead) OR (contains(r.path, '_ETD2') AND a.etd)) AS by_name,
    bool_or((contains(r.path, '_EAD') AND NOT a.ead) OR (contains(r.path, '_ETD2') AND NOT a.etd)) AS nc, count(*) AS n,
    bool_or(st.sample_id IS NOT NULL) AS by_row
  FROM raw_file r JOIN able a USING (unit_id) LEFT JOIN st ON st.unit_id = r.unit_id AND st.sample_id = concat('S', r.l_linenumber) WHERE r.role IN ('raw', 'converted') GROUP BY 1, 2),
pf AS (SELECT unit_id, CAST(sum(n) AS BIGINT) AS analysis_files, CAST(sum(n) FILTER (by_name OR by_row) AS BIGINT) AS named_files, CAST(sum(n) FILTER (nc) AS BIGINT) AS not_credible_files FROM fl GROUP BY 1),
fr AS (SELECT u.unit_id, u.o_orderstatus = 'F' AND u.price_cents < 500000 OR (coalesce(samples, 0) > 0 AND coalesce(named_samples, 0) = samples) OR (coalesce(analysis_files, 0) > 0 AND coalesce(named_files, 0) = analysis_files) AS excluded,
   coalesce(named_samples, 0) AS named_samples, coalesce(samples, 0) AS samples, coalesce(named_files, 0) AS nf, coalesce(analysis_files, 0) AS analysis_files, coalesce(not_credible_files, 0) AS not_credible_files
  FROM unit u LEFT JOIN nm USING (unit_id) LEFT JOIN al USING (unit_id) LEFT JOIN pf USING (unit_id))"""


def fragmentation(t: Tables):
    u = t["unit"].select("unit_id", F.col("accession").alias("study_id"), "instrument",
                         F.when((F.col("o_orderstatus") == "F") & (F.col("price_cents") < 500000), "EAD run").otherwise("HCD").alias("label"))
    rf = t["raw_file"]
    evidence = rf.select("unit_id", F.lit("study title").alias("field"), F.when(F.col("l_quantity") == 1, "EAD of lipids").otherwise("lipids").alias("value"))
    attributes = F.create_map(
        F.when(F.col("l_quantity") == 30, "Fragmentation method").otherwise("Extract name"),
        F.when(F.col("l_quantity").isin(30, 31), F.lit("B7_EAD_2")).otherwise(F.lit("plain")), F.lit("Instrument"), F.lit("EAD box"))
    sample = F.concat(F.lit("S"), "l_linenumber")
    samples = rf.select("unit_id", sample.alias("sample_id"), F.lit("").alias("raw_file"), attributes.alias("attributes"))
    inputs = rf.select("unit_id", "path", "role", sample.alias("sample_id"))
    shared = u.select("study_id", F.lit("keywords").alias("field"), F.lit("CID, OAD").alias("value")).distinct()
    return planning.fragmentation_reading(u, evidence, samples, inputs, shared)


@query("p5_fragmentation", "unit", "raw_file", ctes=FRAG_SQL, sql="""
SELECT unit_id, excluded, named_samples, samples, CASE WHEN excluded THEN 0 ELSE nf END AS named_files, analysis_files, not_credible_files FROM fr""")
def p5(t: Tables):
    return fragmentation(t)


@query("j8_files_of_stated_rows", "raw_file", sql="""
SELECT DISTINCT r.unit_id, r.path FROM raw_file r JOIN (SELECT DISTINCT unit_id, CASE WHEN l_quantity > 45 THEN concat('S', l_linenumber) ELSE 'none' END AS sample_id, CASE WHEN l_quantity > 45 THEN path ELSE 'none' END AS path FROM raw_file) s
  ON r.unit_id = s.unit_id AND (s.sample_id = concat('S', r.l_linenumber) OR lower(s.path) = lower(r.path) OR regexp_replace(lower(s.path), '\\.[^.]*$', '') = regexp_replace(lower(r.path), '\\.[^.]*$', '')
   OR lower(r.path) = regexp_replace(lower(s.path), '\\.[^.]*$', '') OR regexp_replace(lower(r.path), '\\.[^.]*$', '') = lower(s.path))""")
def j8(t: Tables):
    rf = t["raw_file"].withColumn("sample_id", F.concat(F.lit("S"), "l_linenumber"))
    return planning.stated_file_matches(rf.select("unit_id", "path", "sample_id"), rf.select("unit_id", F.when(F.col("l_quantity") > 45, F.col("sample_id")).otherwise("none").alias("sample_id"), F.when(F.col("l_quantity") > 45, F.col("path")).otherwise("none").alias("raw_file")))


def planned(t: Tables):
    pooled = planning.union_pools(t["unit"], t["raw_file"], ["declared", "acquisition_unknown"])
    p, reopen = prior(t)
    with_work = planning.prior_work(pooled, p, ["c1"], reopen)
    mob = mobility(t).select("unit_id", F.col("excluded").alias("ion_mobility"))
    frag = fragmentation(t).select("unit_id", F.col("excluded").alias("fragmentation"))
    return planning.exclusion_reasons(with_work.join(mob, "unit_id").join(frag, "unit_id"))


REASONS = ", ".join([PRIOR_SQL, MOBILITY_SQL, FRAG_SQL, POOLED]) + """,
why AS (SELECT p.unit_id, p.pool, p.repository, p.accession, list_filter([CASE WHEN file_count = 0 THEN 'no_files' END, CASE WHEN m.signal AND NOT m.beside THEN 'ion_mobility' END,
  CASE WHEN f.excluded THEN 'fragmentation_not_cid_hcd' END, workspace_reason, CASE WHEN p.analysis_files > 0 AND mzdata_files = p.analysis_files THEN 'mzdata_only' END], lambda x: x IS NOT NULL) AS reasons
  FROM pooled p JOIN mob m USING (unit_id) JOIN fr f USING (unit_id) LEFT JOIN wsr USING (unit_id))"""


@query("p3_exclusion_reasons", "unit", "raw_file", ctes=REASONS, sql="""
SELECT unit_id, pool, array_to_string(reasons, ',') AS reasons, reasons[1] AS reason FROM why""")
def p3(t: Tables):
    return planned(t).select("unit_id", "pool", F.array_join("reasons", ",").alias("reasons"), "reason")


@query("a2_plan_totals", "unit", "raw_file", ctes=REASONS, sql="""
SELECT 'selected_units' AS measure, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM why UNION ALL SELECT 'excluded_units', NULL, count(*) FROM why WHERE len(reasons) > 0
UNION ALL SELECT 'planned_units', NULL, count(*) FROM why WHERE len(reasons) = 0 UNION ALL SELECT 'excluded_by_reason', reasons[1], count(*) FROM why WHERE len(reasons) > 0 GROUP BY 2
UNION ALL SELECT 'planned_by_pool', pool, count(*) FROM why WHERE len(reasons) = 0 GROUP BY 2""")
def a2(t: Tables):
    return planning.plan_totals(planned(t))


USES = """uses AS (SELECT object_id, unit_id, max(kind) AS kind, max(size_bytes) AS size FROM raw_file WHERE download_url IS NOT NULL GROUP BY 1, 2),
sizes AS (SELECT object_id, max(kind) AS kind, coalesce(max(size), 0) AS known_bytes, max(size) IS NOT NULL AS size_known, count(*) AS consumers FROM uses GROUP BY 1),
uo AS (SELECT u.unit_id, count(*) AS object_count, CAST(sum(s.known_bytes) AS BIGINT) AS known_bytes, count(*) FILTER (NOT s.size_known) AS unknown_size_objects,
  bool_and(s.kind IN ('archive', 'bundle')) AS only_archives, bool_or(s.kind IN ('archive', 'bundle')) AS has_archive FROM uses u JOIN sizes s USING (object_id) GROUP BY 1)"""


def uses(t: Tables):
    return planning.objects(t["raw_file"])


@query("a2_object_totals", "raw_file", ctes=USES, sql="""
SELECT count(*) AS distinct_objects, CAST(sum(known_bytes) FILTER (size_known) AS BIGINT) AS distinct_bytes_known, CAST(sum(known_bytes) AS BIGINT) AS distinct_bytes_lower_bound,
  count(*) FILTER (NOT size_known) AS unknown_size_objects FROM sizes""")
def a2_objects(t: Tables):
    return planning.object_totals(uses(t))


@query("a2_partner_bytes", "payload", sql="""
SELECT CAST(sum(b) AS BIGINT) AS all_bytes, CAST(sum(b) FILTER (NOT tw) AS BIGINT) AS bytes_once, count(*) FILTER (tw) AS partners FROM (
  SELECT CAST(o_orderkey AS BIGINT) * 10 AS b, ion_mode = 'negative' AND (o_orderkey - 1) IN (SELECT o_orderkey FROM payload WHERE ion_mode = 'positive') AS tw FROM payload WHERE ion_mode IN ('positive', 'negative'))""")
def a2_partner(t: Tables):
    p = t["payload"].where("ion_mode IN ('positive', 'negative')")
    key = lambda c: F.concat_ws("-", c.cast("string"), F.when(F.col("ion_mode") == "positive", "pos").otherwise("neg"))
    sibling = F.when(F.col("ion_mode") == "negative", F.concat_ws("-", (F.col("o_orderkey") - 1).cast("string"), F.lit("pos"))).otherwise(
        F.concat_ws("-", (F.col("o_orderkey") + 1).cast("string"), F.lit("neg")))
    return planning.partner_bytes_once(p.select(key(F.col("o_orderkey")).alias("unit_key"), sibling.alias("sibling_key"), "ion_mode", (F.col("o_orderkey") * 10).alias("known_bytes")))


@query("a21_unit_objects", "raw_file", ctes=USES, sql="SELECT * FROM uo")
def a21(t: Tables):
    return planning.unit_objects(uses(t))


@query("p6_archive_too_small", "raw_file", ctes=USES, sql="""
SELECT unit_id, only_archives AND unknown_size_objects = 0 AND known_bytes < object_count * 50000 AS too_small FROM uo""")
def p6(t: Tables):
    u = planning.unit_objects(uses(t)).withColumn("samples", F.col("object_count"))
    return u.select("unit_id", planning.archive_too_small(u).alias("too_small"))


GROUPS = USES + """,
multi AS (SELECT u.* FROM uses u JOIN sizes s USING (object_id) WHERE consumers > 1),
edge AS (SELECT DISTINCT a.unit_id AS a, b.unit_id AS b FROM multi a JOIN multi b USING (object_id) WHERE a.unit_id <> b.unit_id),
cc AS (SELECT DISTINCT a AS unit_id, a AS root FROM edge UNION SELECT e.b, cc.root FROM cc JOIN edge e ON cc.unit_id = e.a),
roots AS (SELECT unit_id, min(root) AS group_id FROM cc GROUP BY 1),
ug AS (SELECT u.unit_id, coalesce(r.group_id, u.unit_id) AS group_id FROM (SELECT DISTINCT unit_id FROM uses) u LEFT JOIN roots r USING (unit_id)),
og AS (SELECT DISTINCT group_id, object_id FROM uses JOIN ug USING (unit_id)),
gr AS (SELECT group_id, count(*) AS object_count, CAST(sum(known_bytes) AS BIGINT) AS known_bytes, count(*) FILTER (NOT size_known) AS unknown_size_objects,
  count(*) FILTER (consumers > 1) AS shared_object_count FROM og JOIN sizes USING (object_id) GROUP BY 1),
gs AS (SELECT gr.*, n AS unit_count FROM gr JOIN (SELECT group_id, count(*) AS n FROM ug GROUP BY 1) USING (group_id))"""


@query("a22_download_groups", "raw_file", ctes=GROUPS, recursive=True, sql="SELECT * FROM gs")
def a22(t: Tables):
    return planning.download_groups(stored(uses(t)))[1]


@query("w9_plan_order", "raw_file", "unit", ctes=GROUPS, recursive=True, sql="""
SELECT unit_id, ug.group_id, row_number() OVER (ORDER BY unknown_size_objects > 0, CASE WHEN unknown_size_objects > 0 THEN object_count ELSE known_bytes END, known_bytes, object_count, ug.group_id, repository, accession, unit_id) - 1 AS order_index
FROM ug JOIN gs USING (group_id) JOIN unit USING (unit_id)""")
def w9(t: Tables):
    units, groups = planning.download_groups(stored(uses(t)))
    placed = units.join(t["unit"].select("unit_id", "repository", "accession"), "unit_id")
    return planning.plan_order(placed, groups).select("unit_id", "group_id", "order_index")


@query("j17_group_siblings", "raw_file", ctes=GROUPS, recursive=True, sql="""
SELECT unit_id, group_id, count(*) OVER (PARTITION BY group_id) - count(*) OVER (PARTITION BY group_id, substr(unit_id, 1, 3)) AS siblings FROM ug""")
def j17(t: Tables):
    units, _ = planning.download_groups(stored(uses(t)))
    return planning.group_siblings(units.withColumn("parent", F.substring("unit_id", 1, 3)))


@query("m4_claims_to_make", "raw_file", "payload", ctes=GROUPS, recursive=True, sql="""
SELECT u.unit_id, u.object_id FROM uses u JOIN ug USING (unit_id) JOIN payload p USING (unit_id) WHERE p.status <> 'excluded'
AND EXISTS (SELECT 1 FROM ug g JOIN payload q USING (unit_id) WHERE g.group_id = ug.group_id AND g.unit_id <> u.unit_id AND q.status = 'ready')""")
def m4(t: Tables):
    units, _ = planning.download_groups(stored(uses(t)))
    p = t["payload"].select("unit_id", "status")
    state = units.join(p, "unit_id").withColumn("downloads", F.col("status") != "excluded")
    return planning.claims_to_make(p.where("status = 'ready'"), state, uses(t))


PLAN_SRC = """pr AS (SELECT unit_id, CASE WHEN ion_mode = 'unknown' THEN 'triage_missing' WHEN chromatography = 'HILIC' AND status = 'ready' THEN 'triage_unreadable'
  WHEN status IN ('needs_person', 'abstained') THEN 'triage_not_pass' WHEN status = 'excluded' THEN 'triage_unit_excluded' WHEN low > 1 THEN 'triage_member_unresolved' WHEN ion_mode = 'both' THEN 'triage_record_mismatch'
  WHEN children > 1 THEN 'class_contrast_lost_after_triage' END AS plan_reason, status, questions, block FROM fx)"""


def decided(t: Tables):
    f = facts(t)
    return planning.plan_reason(f.select(
        "unit_id", (F.col("ion_mode") != "unknown").alias("document"), (~((F.col("chromatography") == "HILIC") & (F.col("status") == "ready"))).alias("readable"),
        F.when(F.col("status").isin("needs_person", "abstained"), "hold").otherwise("pass").alias("verdict"), "status", F.col("low").alias("unresolved_rows"),
        (F.col("ion_mode") != "both").alias("record_ok"), (F.col("children") <= 1).alias("contrast_intact"), "questions", "flags", "skill_version").withColumn(
        "unresolved_rows", F.when(F.col("unresolved_rows") > 1, F.col("unresolved_rows")).otherwise(0)))


@query("p11_plan_reason", *FACT_SHAPES, ctes=FACTS + ",\n" + PLAN_SRC, sql="SELECT unit_id, plan_reason FROM pr")
def p11(t: Tables):
    return decided(t).select("unit_id", "plan_reason")


@query("p12_download_only", *FACT_SHAPES, ctes=FACTS + ",\n" + PLAN_SRC, sql="""
SELECT unit_id, array_to_string(list_concat(list_concat(CASE WHEN status IN ('needs_person', 'abstained') THEN ['validator:hold'] ELSE [] END, CASE WHEN status <> 'ready' THEN ['status:' || status] ELSE [] END),
  list_concat(list_transform(list_sort(questions), lambda x: 'question:' || x), list_transform(list_sort(block), lambda x: 'blocking_flag:' || x))), ';') AS codes
FROM pr WHERE plan_reason IN ('triage_missing', 'triage_not_pass') AND status <> 'excluded'""")
def p12(t: Tables):
    d = decided(t).withColumn("blocking", checks.blocking(F.col("flags"), "skill_version")).withColumn("dropped_reasons", F.array().cast("array<string>"))
    return planning.download_only(d).select("unit_id", F.array_join("reason_codes", ";").alias("codes"))


@query("r7_explode_children", "payload", "child", sql="""
SELECT p.unit_id, c.child_key, CASE WHEN c.child_key IS NULL THEN p.unit_id ELSE concat(p.unit_id, '-', c.child_key) END AS unit_key,
  coalesce(c.ion_mode, p.ion_mode) AS ion_mode, coalesce(c.acquisition_mode, p.acquisition_mode) AS acquisition_mode
FROM payload p LEFT JOIN (SELECT DISTINCT unit_id, child_key, ion_mode, acquisition_mode FROM child) c USING (unit_id)""")
def r7(t: Tables):
    return planning.explode_children(t["payload"].select("unit_id", "ion_mode", "acquisition_mode"), t["child"])


@query("r6_polarity_children", "payload", "item", sql="""
SELECT concat(unit_id, '-', substr(m.mode, 1, 3)) AS unit_key, kind, reason = 'polarity_switching' AND reason IS NOT NULL AS moved, count(*) AS n,
  count(*) FILTER (CASE WHEN reason = 'polarity_switching' THEN true ELSE ion_mode = 'switching' END) AS switching
FROM item JOIN payload p USING (unit_id), (VALUES ('positive'), ('negative')) m(mode) WHERE p.ion_mode = 'switching' GROUP BY 1, 2, 3""".replace("ELSE ion_mode =", "ELSE item.ion_mode ="))
def r6(t: Tables):
    _, rows = planning.derive_polarity_children(t["payload"].where("ion_mode = 'switching'"), t["item"])
    return rows.groupBy("unit_key", "kind", "moved").agg(F.count("*").alias("n"), F.count_if(F.col("ion_mode") == "switching").alias("switching"))


@query("r8_decision_events", "payload", sql="""
SELECT unit_id AS unit_key, CAST(v.step AS INTEGER) AS step, v.kind, v.standing FROM payload, (VALUES (0, 'triage_recorded', 'model_inference'), (1, 'triage_validated', 'deterministic_check'),
  (2, 'unit_reopened', 'accepted_decision'), (3, 'download_only_planned', 'accepted_decision')) v(step, kind, standing)
WHERE (step = 0 AND status <> 'abstained') OR (step = 1 AND status = 'ready') OR (step = 2 AND ion_mode = 'both') OR (step = 3 AND status = 'needs_person')""")
def r8(t: Tables):
    return planning.decision_events(t["payload"].select(
        F.col("unit_id").alias("unit_key"), (F.col("status") != "abstained").alias("document"), F.when(F.col("status") == "ready", "pass").alias("verdict"),
        (F.col("ion_mode") == "both").alias("reopened"), (F.col("status") == "needs_person").alias("download_only")))


@query("r9_ledger_seed", "raw_file", "unit", ctes=GROUPS, recursive=True, sql="""
SELECT unit_id AS unit_key, ug.group_id AS download_group_id, uo.known_bytes, uo.unknown_size_objects = 0 AS size_known, has_archive, 'pending' AS state FROM ug JOIN uo USING (unit_id)""")
def r9(t: Tables):
    u = stored(uses(t))
    units, groups = planning.download_groups(u)
    plan = units.join(planning.unit_objects(u), "unit_id").join(t["unit"].select("unit_id", "repository", "accession"), "unit_id")
    ordered = planning.plan_order(plan.withColumn("size_known", F.col("unknown_size_objects") == 0), groups)
    return planning.ledger_seed(ordered).select("unit_key", "download_group_id", "known_bytes", "size_known", "has_archive", "state")


@query("a26_selection_digest", "item", "item_listing", sql=f"""
SELECT * FROM (WITH ix AS (SELECT lower(path) AS path_key, min_by(crc32, (path, size, crc32)) AS crc32, min_by(size, (path, size, crc32)) AS size FROM item_listing GROUP BY 1),
  e AS (SELECT unit_id, member_path AS path, coalesce(row_index, -1) AS row, concat('{{"archive_name":"a.zip","child_key":null,"crc32":', CASE WHEN crc32 IS NULL THEN 'null' ELSE concat('"', lpad(upper(crc32), 8, '0'), '"') END,
    ',"member_path":"', member_path, '","sample_row_index":', coalesce(CAST(row_index AS VARCHAR), 'null'), ',"size":', coalesce(CAST(size AS VARCHAR), 'null'), ',"unit_id":"', unit_id, '"}}') AS entry
    FROM item LEFT JOIN ix ON lower(member_path) = path_key WHERE reason IS NULL AND member_path IS NOT NULL)
SELECT unit_id, sha256(sha256(string_agg(entry, chr(10) ORDER BY path, row, entry))) AS digest, count(*) AS entries FROM e GROUP BY 1)""")
def a26(t: Tables):
    """Entries by path, row (a member without one first) and text; every entry has its own position."""
    ix = files.listing_index(t["item_listing"].withColumn("archive", F.lit("a.zip")), ["path", "size", "crc32"])
    kept = t["item"].where("reason IS NULL AND member_path IS NOT NULL").select("unit_id", "member_path", F.lit("a.zip").alias("archive"), "row_index")
    entries = planning.selection_entries(kept, ix)
    placed = canonical.positions(entries, "unit_id", [F.col("path"), F.coalesce(F.col("row_index"), F.lit(-1))], F.col("entry"))
    return canonical.digest(canonical.block_digests(placed, "unit_id"), "unit_id").drop("bytes")


@query("a20_observed_factor", "unit", sql="SELECT quantile_disc(price_cents, 0.9) AS factor, count(*) AS n FROM unit WHERE price_cents > 0")
def a20(t: Tables):
    return planning.observed_factor(t["unit"], "price_cents")


NEED = """nd AS (SELECT unit_id, price_cents * 40000 AS known, untargeted IS NOT NULL AS size_known, o_orderstatus = 'F' AS has_archive, CASE WHEN o_orderstatus = 'O' THEN price_cents * 50000 END AS held FROM unit),
fc AS (SELECT greatest(CASE WHEN has_archive THEN 2.66 ELSE 1.66 END::DOUBLE, 2.0::DOUBLE) AS factor, * FROM nd),
need AS (SELECT unit_id, held, factor, CAST(ceil(CASE WHEN size_known THEN known ELSE greatest(known, coalesce(held, 0)) END * factor) AS BIGINT) + CASE WHEN size_known THEN 0 ELSE 200000000000 END AS need FROM fc)"""


def needs(t: Tables):
    u = t["unit"].select("unit_id", (F.col("price_cents") * 40000).alias("known_bytes"), F.col("untargeted").isNotNull().alias("size_known"),
                         (F.col("o_orderstatus") == "F").alias("has_archive"), F.when(F.col("o_orderstatus") == "O", F.col("price_cents") * 50000).alias("held_bytes"))
    observed = t["orders"].agg(F.when(F.count("*") >= 5, F.lit(2.0)).alias("factor"))
    return planning.disk_needs(u, observed)


@query("m1_disk_need", "unit", ctes=NEED, sql="SELECT unit_id, factor, need FROM need")
def m1(t: Tables):
    return needs(t).select("unit_id", "factor", "need")


@query("m2_disk_verdict", "unit", ctes=NEED, sql="""
SELECT unit_id, 3000000000000 - 500000000000 >= greatest(0, need - coalesce(held, 0)) AS admit, need > 4000000000000 - 500000000000 AS never_fits FROM need""")
def m2(t: Tables):
    return planning.disk_verdicts(needs(t), F.lit(3_000_000_000_000), F.lit(4_000_000_000_000)).select("unit_id", "admit", "never_fits")


@query("m3_need_inverse", "unit", ctes=NEED, sql="""
SELECT unit_id, CAST(ceil(need / factor) AS BIGINT) AS known_bytes, greatest(1.0::DOUBLE, (need * 10 - greatest(500000000000, CAST(floor(0.05::DOUBLE * (need * 10)) AS BIGINT))) / 1e9::DOUBLE) AS bound_gb FROM need""")
def m3(t: Tables):
    n = needs(t)
    return n.select("unit_id", policy.known_bytes_for_need(F.col("need"), F.col("factor")).alias("known_bytes"), policy.download_bound_gb(F.col("need") * 10).alias("bound_gb"))


@query("m5_transfer_stats", "attempt", sql="""
SELECT * FROM (WITH d AS (SELECT unit_key, repository, group_id, bytes, k FROM attempt WHERE step = 'download' AND outcome = 'ok')
SELECT repository, count(*) AS finished, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(bytes) FILTER (k < 60) AS BIGINT) AS transferred_bytes, count(*) FILTER (k < 60) AS objects_fetched,
  count(*) FILTER (k < 10) AS objects_refetched, count(*) FILTER (k >= 60) AS cache_hits, count(DISTINCT group_id) AS distinct_objects FROM d GROUP BY 1)""")
def m5(t: Tables):
    d = t["attempt"].where("step = 'download' AND outcome = 'ok'")
    return ledger.transfer_stats(d.select("repository", "group_id", "bytes", (F.col("k") < 60).alias("fetched"), (F.col("k") < 10).alias("refetched")))


@query("s16_canonical_writer", "item", sql="""
SELECT row_number() OVER (ORDER BY unit_id, member_path NULLS FIRST, row_index NULLS FIRST, entry) - 1 AS position, md5(entry) AS digest
FROM (SELECT unit_id, member_path, row_index, concat('{"kind":"', kind, '","unit_id":"', unit_id, '"}') AS entry FROM item)""")
def s16_writer(t: Tables):
    """The entries written in parts and read back from them."""
    path = scratch(t.spark)
    entry = text.canonical_json({"kind": F.col("kind"), "unit_id": F.col("unit_id")})
    canonical.write(t["item"], [F.col("unit_id"), F.col("member_path"), F.col("row_index")], entry, path)
    return canonical.read_back(t.spark, path).select("position", F.md5("entry").alias("digest"))
