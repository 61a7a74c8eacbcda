"""Decision-document checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.functions import names
from cairnsift.operators import checks, duplicates, matching
from cairnsift.queries import duck
from cairnsift.queries.duplicates import groups_cte
from cairnsift.queries.matching import ITEM_KEYS, item_keys, mem_cte
from cairnsift.queries.registry import Tables, query

BLOCK = "['folder_header_disagreement', 'mixed_acquisition', 'ms1_only', 'name_token_disputed', 'polarity_switching', 'shared_content']"
FACTS = f"""per AS (SELECT unit_id, count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason = 'needs_person') AS held,
    count(*) FILTER (kind = 'excluded_row' AND reason IN ('no_signal_abstained', 'needs_person')) AS abstained_rows, count(*) FILTER (reason = 'ms1_only_no_msms') AS ms1_dropped,
    count(*) FILTER (reason = 'shared_content_unassigned') AS unassigned,
    count(*) FILTER (kind = 'excluded_row' AND reason NOT IN ('belongs_to_other_unit', 'duplicate_content', 'ms1_only_no_msms', 'not_in_archive')) AS other_row_reasons,
    count(*) FILTER (kind = 'excluded_row' AND reason NOT IN ('not_in_archive', 'belongs_to_other_unit')) AS own_rows_dropped,
    count(*) FILTER (reason IS NULL AND basis = 'inferred' AND confidence = 'low') AS low FROM item GROUP BY 1),
facts AS (SELECT p.*, coalesce(kept, 0) AS kept, coalesce(held, 0) AS held, coalesce(abstained_rows, 0) AS abstained_rows, coalesce(ms1_dropped, 0) AS ms1_dropped,
    coalesce(unassigned, 0) AS unassigned, coalesce(other_row_reasons, 0) AS other_row_reasons, coalesce(own_rows_dropped, 0) AS own_rows_dropped, coalesce(low, 0) AS low,
    coalesce(f.flags, []) AS flags, coalesce(q.questions, []) AS questions, coalesce(c.children, 0) AS children
  FROM payload p LEFT JOIN per USING (unit_id) LEFT JOIN (SELECT unit_id, list(DISTINCT code) AS flags FROM flag GROUP BY 1) f USING (unit_id)
  LEFT JOIN (SELECT unit_id, list(DISTINCT code) FILTER (code IS NOT NULL) AS questions FROM question GROUP BY 1) q USING (unit_id)
  LEFT JOIN (SELECT unit_id, count(DISTINCT child_key) AS children FROM child GROUP BY 1) c USING (unit_id)),
fx AS (SELECT *, list_intersect(flags, {BLOCK} || CASE WHEN skill_version = '1.2.9' THEN ['declared_technical_disputed'] ELSE [] END) AS block FROM facts)"""
FACT_SHAPES = ("payload", "item", "flag", "question", "child")


def facts(t: Tables):
    return checks.unit_facts(t["payload"], t.stored("item"), t["flag"], t["question"], t["child"])


def rules_sql(source: str, check: str, subject: str, rules: dict[str, str], severity: str = "'error'") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{check}' AS check_id, {severity} AS severity, unit_id, CAST({subject} AS VARCHAR) AS subject, '{m}' AS message FROM {source} WHERE {r}" for m, r in rules.items())


STATUS_RULES = {
    "excluded_without_reason": "status = 'excluded' AND exclusion_reason IS NULL",
    "excluded_keeps_files": "status = 'excluded' AND kept > 0", "excluded_asks": "status = 'excluded' AND len(questions) > 0",
    "excluded_has_children": "status = 'excluded' AND children > 0", "excluded_holds_for_person": "status = 'excluded' AND held > 0",
    "excluded_with_blocking_flag": "status = 'excluded' AND len(list_filter(block, lambda x: NOT (x = 'shared_content' AND coalesce(exclusion_reason, '') = 'shared_content_unassigned'))) > 0",
    "no_product_ion_without_ms1_rows": "exclusion_reason = 'no_product_ion_files' AND ms1_dropped = 0",
    "no_product_ion_other_rows": "exclusion_reason = 'no_product_ion_files' AND other_row_reasons > 0",
    "no_files_with_own_rows": "exclusion_reason = 'no_files' AND own_rows_dropped > 0",
    "unassigned_without_flag": "exclusion_reason = 'shared_content_unassigned' AND NOT list_contains(flags, 'shared_content')",
    "unassigned_without_rows": "exclusion_reason = 'shared_content_unassigned' AND unassigned = 0",
    "exclusion_on_other_status": "status <> 'excluded' AND exclusion_reason IS NOT NULL",
    "needs_person_without_question": "status = 'needs_person' AND len(questions) = 0", "ready_with_question": "status = 'ready' AND len(questions) > 0",
    "abstained_keeps": "status = 'abstained' AND kept > 0", "abstained_without_abstained_rows": "status = 'abstained' AND abstained_rows = 0",
    "ready_keeps_nothing": "status = 'ready' AND kept = 0", "ready_with_blocking_flag": "status = 'ready' AND len(block) > 0",
}
STATUS_SQL = rules_sql("fx", "T-STATUS", "status", STATUS_RULES)


@query("t_status", *FACT_SHAPES, ctes=FACTS, sql=STATUS_SQL)
def t_status(t: Tables):
    return checks.t_status(facts(t))


QUEUE_SQL = "SELECT 'T-QUEUE' AS check_id, 'hold' AS severity, unit_id, status AS subject, array_to_string(list_sort(questions), ';') AS message FROM facts WHERE status NOT IN ('ready', 'excluded')"


@query("t_queue", *FACT_SHAPES, ctes=FACTS, sql=QUEUE_SQL)
def t_queue(t: Tables):
    return checks.t_queue(facts(t))


@query("t_pol_chrom_units", *FACT_SHAPES, ctes=FACTS, sql=rules_sql("fx", "T-POL", "ion_mode", {
    "ready_ion_mode": "status = 'ready' AND ion_mode IN ('switching', 'unknown')", "ready_both_without_children": "status = 'ready' AND ion_mode = 'both' AND children = 0"})
    + " UNION ALL " + rules_sql("fx", "T-CHROM", "chromatography", {"ready_unknown": "status = 'ready' AND chromatography = 'unknown'"}))
def t_units(t: Tables):
    return checks.t_unit_technical(facts(t))


@query("t_confidence", *FACT_SHAPES, ctes=FACTS, sql="""
SELECT 'T-CONFIDENCE' AS check_id, 'hold' AS severity, unit_id, CAST(low AS VARCHAR) AS subject, 'inferred_low_confidence' AS message FROM facts
WHERE status = 'ready' AND low > 0 AND unit_id NOT IN (SELECT concat('U', o_orderkey) FROM orders WHERE o_orderpriority = '1-URGENT')""")
def t_confidence(t: Tables):
    answered = t["orders"].where("o_orderpriority = '1-URGENT'").select(F.concat(F.lit("U"), "o_orderkey").alias("unit_id"), F.lit("inferred_low_confidence").alias("code"))
    return checks.t_confidence(facts(t), answered)


@query("t_set", "payload", sql="""
SELECT 'T-SET' AS check_id, 'hold' AS severity, concat('U', o_orderkey) AS unit_id, concat('U', o_orderkey) AS subject, 'no_document' AS message FROM orders WHERE o_totalprice > 490000
UNION ALL SELECT 'T-SET', 'error', unit_id, '2', 'triaged_twice' FROM payload JOIN orders USING (o_orderkey) WHERE o_totalprice < 10000""")
def t_set(t: Tables):
    o = t["orders"].select("o_orderkey", "o_totalprice")
    docs = t["payload"].join(o, "o_orderkey")
    shown = docs.where("o_totalprice <= 490000").unionByName(docs.where("o_totalprice < 10000"))
    return checks.t_set(shown, t["payload"].select("unit_id"))


@query("t_schema", "item", sql=rules_sql("item", "T-SCHEMA", "row_index", {
    "bad_role": "role NOT IN ('sample', 'qc')", "bad_ion_mode": "ion_mode NOT IN ('positive', 'negative', 'switching')"}))
def t_schema(t: Tables):
    return checks.t_schema(t["item"], {"role": ("sample", "qc"), "ion_mode": ("positive", "negative", "switching")})


COVER_CTES = """rws AS (SELECT unit_id, row_index, count(*) AS n FROM item WHERE row_index IS NOT NULL GROUP BY 1, 2),
pl AS (SELECT r.*, least(p.catalog_row_count, 6) - 1 AS cnt FROM rws r JOIN payload p USING (unit_id))"""


@query("t_cover", "payload", "item", ctes=COVER_CTES, sql="""
SELECT 'T-COVER' AS check_id, 'error' AS severity, unit_id, CAST(row_index AS VARCHAR) AS subject, 'row_out_of_range' AS message FROM pl WHERE row_index >= cnt
UNION ALL SELECT 'T-COVER', 'error', unit_id, CAST(row_index AS VARCHAR), 'row_twice' FROM pl WHERE n > 1 AND row_index < cnt
UNION ALL SELECT 'T-COVER', 'error', p.unit_id, CAST(5 - coalesce(s.seen, 0) AS VARCHAR), 'rows_missing' FROM payload p
  LEFT JOIN (SELECT unit_id, count(*) AS seen FROM pl WHERE row_index < cnt GROUP BY 1) s USING (unit_id) WHERE coalesce(s.seen, 0) < 5""")
def t_cover(t: Tables):
    return checks.t_cover(t["payload"].withColumn("catalog_row_count", F.lit(5)), t["item"])


@query("t_handoff", sql="""
SELECT concat('U', o_orderkey) AS unit_id, CASE WHEN o_orderstatus = 'F' THEN 'missing_right' WHEN o_orderpriority = '5-LOW' THEN 'changed' ELSE 'equal' END AS result FROM orders""")
def t_handoff(t: Tables):
    o = t["orders"]
    unit, price = F.concat(F.lit("U"), "o_orderkey").alias("unit_id"), F.col("o_totalprice").cast("string")
    bound = o.select(unit, F.sha2(price, 256).alias("digest"))
    current = o.where("o_orderstatus <> 'F'").select(unit, F.sha2(F.when(F.col("o_orderpriority") == "5-LOW", F.concat(price, F.lit("x"))).otherwise(price), 256).alias("digest"))
    return matching.reconcile(bound, current, ["unit_id"], ["digest"]).select("unit_id", "result")


@query("t_decl", "payload", "flag", "unit", sql="""
SELECT * FROM (WITH b AS (SELECT p.unit_id, p.ion_mode, p.chromatography, lower(u.ion_mode) AS d FROM payload p JOIN unit u USING (unit_id)
  WHERE p.unit_id NOT IN (SELECT unit_id FROM flag WHERE code = 'declared_technical_disputed'))
SELECT 'T-DECL' AS check_id, 'error' AS severity, unit_id, unit_id AS subject, 'chromatography_differs' AS message FROM b WHERE chromatography <> 'RP'
UNION ALL SELECT 'T-DECL', 'error', unit_id, unit_id, 'ion_mode_differs' FROM b WHERE d IN ('positive', 'negative') AND ion_mode <> d)""")
def t_decl(t: Tables):
    return checks.t_declared(t["payload"], t["unit"].select("unit_id", "ion_mode", F.lit("C18").alias("chromatography")), t["flag"])


EXCL_PATH = "coalesce(member_path, raw_file)"
EXCL_SRC = ("(SELECT i.*, f.status, f.exclusion_reason, f.flags, f.questions, coalesce(regexp_matches(member_path, 'DIA'), false) AS said FROM item i JOIN facts f USING (unit_id) WHERE i.reason IS NOT NULL)")
EXCL_RULES = {
    "needs_person_unasked": "reason = 'needs_person' AND (status = 'ready' OR len(questions) = 0)",
    "no_signal_unasked": "reason = 'no_signal_abstained' AND (status = 'ready' OR (status <> 'abstained' AND NOT list_contains(questions, 'no_signal')))",
    "polarity_switching_unflagged": "reason = 'polarity_switching' AND NOT list_contains(flags, 'polarity_switching')",
    "ms1_name_says_product_ions": "reason = 'ms1_only_no_msms' AND said",
    "ms1_unflagged": "reason = 'ms1_only_no_msms' AND NOT said AND NOT list_contains(flags, 'ms1_only_excluded')",
    "ms1_low_confidence": "reason = 'ms1_only_no_msms' AND NOT said AND list_contains(flags, 'ms1_only_excluded') AND confidence = 'low'",
    "unassigned_in_other_unit": "reason = 'shared_content_unassigned' AND NOT coalesce(status = 'excluded' AND exclusion_reason = 'shared_content_unassigned', false)",
    "conversion_not_needed": f"reason = 'requires_conversion' AND NOT {duck.convert(EXCL_PATH)}",
}


@query("t_excl", *FACT_SHAPES, ctes=FACTS, sql=rules_sql(EXCL_SRC, "T-EXCL", EXCL_PATH, EXCL_RULES))
def t_excl(t: Tables):
    return checks.t_exclusion(t["item"], facts(t))


LISTED = mem_cte("item_listing") + ",\n" + ITEM_KEYS + ",\n" + groups_cte("item_listing")


@query("t_excl_listing", "item", "item_listing", ctes=LISTED, sql=f"""
SELECT 'T-EXCL' AS check_id, 'error' AS severity, unit_id, key AS subject, 'listed_after_all' AS message FROM keyst WHERE reason = 'not_in_archive' AND (key IN (SELECT member_key FROM mem) OR (member_path IS NULL AND (lower({duck.base('raw_file')}) IN (SELECT name FROM mem) OR lower({duck.stem('raw_file')}) IN (SELECT stem FROM mem))))
UNION ALL SELECT 'T-EXCL', 'error', unit_id, key, 'no_twin' FROM keyst WHERE reason IN ('duplicate_content', 'shared_content_unassigned') AND key NOT IN (SELECT member_key FROM grp)""")
def t_excl_listing(t: Tables):
    return checks.t_exclusion_listing(item_keys(t), matching.index_members(t.stored("item_listing")), duplicates.content_groups(t.stored("item_listing")))


@query("t_kept_and_excluded", "item", "item_listing", ctes=mem_cte("item_listing") + ",\n" + ITEM_KEYS, sql="""
SELECT DISTINCT 'T-EXCL' AS check_id, 'error' AS severity, e.unit_id, e.key AS subject, 'kept_and_excluded' AS message FROM keyst e JOIN keyst k ON e.unit_id = k.unit_id
WHERE e.kind = 'excluded_member' AND k.reason IS NULL AND (e.key = k.key OR ((NOT e.resolved OR NOT k.resolved) AND e.key_stem = k.key_stem))""")
def t_both(t: Tables):
    return checks.kept_and_excluded(item_keys(t))


@query("t_uniq", "item", "item_listing", "share", ctes=mem_cte("item_listing") + ",\n" + ITEM_KEYS + """,
kept AS (SELECT unit_id, key, key_stem FROM keyst WHERE reason IS NULL AND resolved), own AS (SELECT DISTINCT unit_id, key FROM kept)""", sql="""
SELECT 'T-UNIQ' AS check_id, 'error' AS severity, unit_id, key AS subject, 'kept_twice' AS message FROM kept GROUP BY unit_id, key HAVING count(*) > 1
UNION ALL SELECT 'T-UNIQ', 'error', min(unit_id), key, concat('shared_by_', count(*)) FROM own GROUP BY key HAVING count(*) > 1
UNION ALL SELECT 'T-UNIQ', 'error', unit_id, key_stem, 'two_encodings' FROM kept GROUP BY unit_id, key_stem
  HAVING count(DISTINCT lower(regexp_extract(key, '(?i)\\.(raw|mzml|mzxml|mzdata|wiff2?|d|lcd|cdf)$', 1))) > 1""")
def t_uniq(t: Tables):
    """The shares name other paths than the kept files, so every shared file is open."""
    return checks.t_unique(item_keys(t), t["share"])


FILE_SRC = ("(SELECT i.*, f.status, f.ion_mode AS u_ion, f.chromatography AS u_chrom, f.flags, coalesce(member_path, raw_file) AS pth FROM item i JOIN facts f USING (unit_id) WHERE i.reason IS NULL)")
FILES_SQL = "\nUNION ALL ".join([
    rules_sql(FILE_SRC, "T-FORMAT", "pth", {"needs_conversion": duck.convert("pth")}),
    rules_sql(FILE_SRC, "T-POL", "pth", {
        "switching_unflagged": "ion_mode = 'switching' AND NOT list_contains(flags, 'polarity_switching')",
        "other_polarity": "u_ion IN ('positive', 'negative') AND ion_mode IN ('positive', 'negative') AND ion_mode <> u_ion",
        "mixed_in_single": "u_ion IN ('positive', 'negative') AND ion_mode IN ('switching', 'both')", "unknown_in_ready": "ion_mode = 'unknown' AND status = 'ready'"}),
    rules_sql(FILE_SRC, "T-CHROM", "pth", {
        "other_chromatography": "chromatography <> 'unknown' AND u_chrom <> 'unknown' AND chromatography <> u_chrom", "unknown_in_ready": "chromatography = 'unknown' AND status = 'ready'"}),
    rules_sql(FILE_SRC, "T-EVID", "pth", {
        "declared_without_declaration": "basis = 'declared' AND source <> 'catalog_row'", "weak_evidence_only": "status = 'ready' AND source = 'archive_listing' AND field = 'size'"}),
    rules_sql(FILE_SRC, "T-TOKEN", "pth", {
        "polarity_token": f"NOT list_contains(flags, 'name_token_disputed') AND ion_mode IN ('positive', 'negative') AND {duck.polarity('pth')} <> ion_mode",
        "chromatography_token": f"NOT list_contains(flags, 'name_token_disputed') AND chromatography IN ('HILIC', 'RP') AND {duck.chromatography('pth')} <> chromatography",
        "acquisition_token": "NOT list_contains(flags, 'name_token_disputed') AND contains(pth, 'DIA') AND acquisition_mode NOT IN ('DIA', 'unknown')"}),
    rules_sql(FILE_SRC, "T-HEADER", "pth", {
        "header_polarity": "source = 'raw_header' AND field = 'polarity' AND ((value = 'POS' AND ion_mode <> 'positive') OR (value = 'negative' AND ion_mode <> 'negative'))"}),
])


@query("t_files", *FACT_SHAPES, ctes=FACTS, sql=FILES_SQL)
def t_files(t: Tables):
    return checks.t_files(t.stored("item"), facts(t))


@query("t_acq", *FACT_SHAPES, ctes=FACTS, sql=rules_sql("""(SELECT f.unit_id, f.status, f.flags, f.acquisition_mode AS u_acq, m.modes,
    list_distinct(list_transform(list_filter(m.modes, lambda x: x <> 'unknown'), lambda x: CASE WHEN x = 'targeted_DDA' THEN 'DDA' ELSE x END)) AS base
  FROM facts f JOIN (SELECT unit_id, list(DISTINCT acquisition_mode) AS modes FROM item WHERE reason IS NULL GROUP BY 1) m USING (unit_id))""",
    "T-ACQ", "array_to_string(list_sort(modes), '+')", {
        "ms1_unflagged": "list_contains(modes, 'MS1') AND NOT list_contains(flags, 'ms1_only')",
        "targeted_unflagged": "list_contains(modes, 'targeted_DDA') AND NOT list_contains(flags, 'targeted_dda')",
        "mixed_unflagged": "len(base) > 1 AND NOT list_contains(flags, 'mixed_acquisition')",
        "unknown_in_ready": "list_contains(modes, 'unknown') AND status = 'ready' AND u_acq = 'unknown'"}))
def t_acq(t: Tables):
    return checks.t_acquisition(t["item"], facts(t))


@query("t_member", *FACT_SHAPES, "item_listing", ctes=mem_cte("item_listing") + ",\n" + ITEM_KEYS + ",\n" + FACTS, sql="""
SELECT 'T-MEMBER' AS check_id, 'error' AS severity, unit_id, key AS subject, 'not_listed' AS message FROM keyst WHERE reason IS NULL AND member_path IS NOT NULL AND key NOT IN (SELECT member_key FROM mem)
UNION ALL SELECT 'T-MEMBER', CASE WHEN f.status = 'ready' THEN 'error' ELSE 'hold' END, k.unit_id, key, 'unresolved' FROM keyst k JOIN facts f USING (unit_id) WHERE reason IS NULL AND NOT resolved""")
def t_member(t: Tables):
    return checks.t_member(item_keys(t), matching.index_members(t.stored("item_listing")), facts(t))


@query("a18_modes_per_run", "item", "child", sql="""
SELECT * FROM (WITH c AS (SELECT unit_id, lower(member_path) AS key, min(child_key) AS child_key FROM child GROUP BY 1, 2),
  k AS (SELECT i.unit_id, coalesce(c.child_key, '') AS child_key, CASE WHEN acquisition_mode = 'targeted_DDA' THEN 'DDA' ELSE acquisition_mode END AS m
    FROM item i LEFT JOIN c ON i.unit_id = c.unit_id AND lower(i.member_path) = c.key WHERE reason IS NULL AND acquisition_mode <> 'unknown')
SELECT unit_id, child_key, string_agg(DISTINCT m, '+' ORDER BY m) AS modes, count(DISTINCT m) > 1 AS mixed FROM k GROUP BY 1, 2)""")
def a18(t: Tables):
    c = t["child"].groupBy("unit_id", F.lower("member_path").alias("key")).agg(F.min("child_key").alias("child_key"))
    kept = t["item"].where("reason IS NULL").withColumn("key", F.lower("member_path")).join(c, ["unit_id", "key"], "left")
    return checks.modes_per_run(kept.select("unit_id", F.coalesce("child_key", F.lit("")).alias("child_key"), "acquisition_mode"))


@query("a29_flag_union", *FACT_SHAPES, ctes=FACTS, sql="""
SELECT unit_id, array_to_string(list_sort(flags), ',') AS flags, array_to_string(list_sort(questions), ',') AS questions, array_to_string(list_sort(block), ',') AS blocking FROM fx""")
def a29(t: Tables):
    return checks.flag_union(t["flag"], t["question"], t["payload"])


@query("a27_decision_stats", "item", sql="""
SELECT unit_id, measure, value, count(*) AS n FROM (
  SELECT unit_id, 'kept_by_basis' AS measure, basis AS value FROM item WHERE reason IS NULL UNION ALL SELECT unit_id, 'kept_by_confidence', confidence FROM item WHERE reason IS NULL
  UNION ALL SELECT unit_id, 'kept_by_role', role FROM item WHERE reason IS NULL UNION ALL SELECT unit_id, 'dropped_by_reason', reason FROM item WHERE reason IS NOT NULL) GROUP BY 1, 2, 3""")
def a27(t: Tables):
    return checks.decision_stats(t["item"])


@query("a1_counts", "item", sql="SELECT reason AS value, count(*) AS n FROM item WHERE reason IS NOT NULL GROUP BY 1")
def a1(t: Tables):
    return checks.counts(t["item"], "reason")


@query("p13_polarity_refusals", *FACT_SHAPES, ctes=FACTS + """,
tk AS (SELECT unit_id, count(*) AS taken, count(*) FILTER (member_path IS NULL) AS unresolved, count(*) FILTER (kind = 'excluded_member') AS members FROM item WHERE reason = 'polarity_switching' GROUP BY 1),
wy AS (SELECT unit_id, ion_mode, CASE WHEN status <> 'needs_person' THEN 'status' WHEN NOT (len(questions) = 1 AND questions[1] = 'polarity_switching') THEN 'questions' WHEN children > 0 THEN 'children'
  WHEN NOT list_contains(flags, 'polarity_switching') THEN 'no_flag' WHEN len(list_filter(block, lambda x: x <> 'polarity_switching')) > 0 THEN 'other_flags'
  WHEN taken IS NULL THEN 'no_row' WHEN unresolved > 0 THEN 'unresolved_rows' WHEN held > 0 THEN 'held_rows' WHEN members > 0 THEN 'members' ELSE '' END AS why FROM fx LEFT JOIN tk USING (unit_id))""", sql="""
SELECT unit_id, CASE WHEN why <> '' THEN why WHEN ion_mode <> 'switching' THEN 'ion_mode' ELSE '' END AS split_refusal,
  CASE WHEN why <> '' THEN why WHEN ion_mode NOT IN ('positive', 'negative') THEN 'ion_mode' ELSE '' END AS own_refusal FROM wy""")
def p13(t: Tables):
    return checks.polarity_hold(facts(t), t["item"])


ALL_SQL = f"({STATUS_SQL}) UNION ALL ({QUEUE_SQL}) UNION ALL ({FILES_SQL})"


def all_findings(t: Tables):
    f = facts(t)
    return checks.run_checks([checks.t_status(f), checks.t_queue(f), checks.t_files(t.stored("item"), f)])


@query("a23_verdict", *FACT_SHAPES, ctes=FACTS, sql=f"""
SELECT * FROM (WITH a AS ({ALL_SQL}), l AS (SELECT p.accession, p.unit_id, a.severity FROM payload p LEFT JOIN a USING (unit_id))
SELECT accession, unit_id, CASE WHEN bool_or(severity = 'error') THEN 'error' WHEN bool_or(severity = 'hold') THEN 'hold' ELSE 'pass' END AS verdict,
  count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'hold') AS holds FROM l GROUP BY GROUPING SETS ((accession, unit_id), (accession)))""")
def a23(t: Tables):
    return checks.verdict(all_findings(t), t["payload"])


@query("k1_top_findings", *FACT_SHAPES, ctes=FACTS, sql=f"""
SELECT check_id, severity, unit_id, subject, message, CAST(position AS INTEGER) AS position, total FROM (
  SELECT *, row_number() OVER (PARTITION BY unit_id, check_id ORDER BY subject, message) AS position, count(*) OVER (PARTITION BY unit_id, check_id) AS total FROM ({ALL_SQL})) WHERE position <= 2""")
def k1(t: Tables):
    return checks.top_findings(all_findings(t), 2)


@query("c0_not_evaluable", "payload", sql="SELECT 'T-DUP' AS check_id, 'hold' AS severity, unit_id, unit_id AS subject, 'no archive listing' AS message FROM payload")
def c0(t: Tables):
    return checks.not_evaluable(t["payload"], "T-DUP", "no archive listing")
