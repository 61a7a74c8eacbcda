"""Rule-based labelling over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.operators import duplicates, labelling, matching, spec
from cairnsift.queries import duck
from cairnsift.queries.duplicates import DUP_SHAPES, TDUP, dup_inputs, dup_keys, groups_cte
from cairnsift.queries.matching import item_keys, mem_cte, resolve_sql
from cairnsift.queries.registry import Tables, query
from cairnsift.session import stored

MEMBER_RULES = {
    "positive": {"glob": "run*/f*_pos.*"},
    "negative": {"token": {"polarity": "negative", "acquisition": ["dia"]}, "ext": [".raw", "mzxml"]},
    "early": {"folder": ["run1", "RUN2/"]},
    "copies": {"twin": True, "regex": r"f1\d\d\d"},
    "single": {"paths": ["run7/f7.raw"]},
}
GROUPS = list(MEMBER_RULES)
LAB = """mm AS (SELECT DISTINCT path FROM item_listing), lt AS (SELECT path, lower(path) IN (SELECT member_key FROM grp) AS twin FROM mm),
lab AS (SELECT path, list_filter([CASE WHEN regexp_matches(lower(path), '^run.*/f.*_pos\\..*$') THEN 'positive' END, CASE WHEN contains(path, '_neg_C18_DIA') AND regexp_matches(lower(path), '\\.(raw|mzxml)$') THEN 'negative' END,
  CASE WHEN starts_with(path, 'run1/') OR starts_with(path, 'run2/') THEN 'early' END, CASE WHEN twin AND regexp_matches(path, 'f1\\d\\d\\d') THEN 'copies' END], lambda x: x IS NOT NULL) AS m0 FROM lt),
lb AS (SELECT path, CASE WHEN path LIKE 'run3/%' THEN ['forced'] ELSE m0 END AS m FROM lab)"""
LAB_CTES = groups_cte("item_listing") + ",\n" + LAB


def labelled(t: Tables):
    listing = t.stored("item_listing")
    twins = duplicates.content_groups(listing).select(F.col("member_key").alias("_m")).distinct().withColumn("_t", F.lit(True))
    paths = listing.select("path").distinct()
    items = paths.join(twins, F.lower("path") == F.col("_m"), "left").select("path", F.coalesce("_t", F.lit(False)).alias("twin"), F.col("path").alias("item_id"))
    exceptions = paths.where("path LIKE 'run3/%'").select(F.col("path").alias("item_id"), F.lit("forced").alias("group_id"))
    rules = [(g, labelling.member_matches(spec)) for g, spec in MEMBER_RULES.items()]
    return labelling.apply_groups(items, rules, exceptions)


@query("r1_apply_groups", "item_listing", ctes=LAB_CTES, sql="SELECT path, array_to_string(m, ',') AS matched, m[1] AS group_id FROM lb")
def r1(t: Tables):
    return labelled(t).select("path", F.array_join("matched", ",").alias("matched"), "group_id")


@query("r2_coverage_findings", "item_listing", ctes=LAB_CTES, sql="""
SELECT CASE WHEN len(m) = 0 THEN 'X-UNCOVERED-MEMBER' ELSE 'X-OVERLAP-MEMBER' END AS check_id, path AS subject, array_to_string(m, ',') AS message FROM lb WHERE len(m) <> 1
UNION ALL SELECT 'X-EMPTY-GROUP', g, '' FROM (VALUES ('positive'), ('negative'), ('early'), ('copies'), ('single')) v(g) WHERE g NOT IN (SELECT m[1] FROM lb WHERE len(m) > 0)""")
def r2(t: Tables):
    return labelling.coverage_findings(labelled(t), GROUPS, "MEMBER")


@query("r3_disposition", "item_listing", ctes=LAB_CTES, sql="""
SELECT m[1] AS group_id, CASE m[1] WHEN 'positive' THEN 'U1,U2' WHEN 'negative' THEN 'U3' END AS kept_units, CASE m[1] WHEN 'early' THEN 'archive_metadata' WHEN 'copies' THEN 'duplicate_content' WHEN 'forced' THEN 'other' END AS reason, count(*) AS n FROM lb GROUP BY 1, 2, 3""")
def r3(t: Tables):
    out = labelling.disposition(labelled(t), {"positive": ["U1", "U2"], "negative": ["U3"]},
                                {"early": "archive_metadata", "copies": "duplicate_content", "forced": "not_in_archive"}, F.lit(False))
    return out.groupBy("group_id", F.array_join("kept_units", ",").alias("kept_units"), "reason").agg(F.count("*").alias("n"))


@query("a19_heterogeneity", "item_listing", ctes=LAB_CTES, sql=f"""
SELECT group_id, array_to_string(list_filter([CASE WHEN p > 1 THEN 'polarity' END, CASE WHEN c > 1 THEN 'chromatography' END, CASE WHEN a > 1 THEN 'acquisition' END, CASE WHEN e > 1 THEN 'ext' END, CASE WHEN f > 1 THEN 'folder' END], lambda x: x IS NOT NULL), ',') AS differs
FROM (SELECT m[1] AS group_id, count(DISTINCT {duck.polarity('path')}) AS p, count(DISTINCT {duck.chromatography('path')}) AS c, count(DISTINCT contains(path, 'DIA')) AS a,
  count(DISTINCT lower(regexp_extract(path, '(\\.[^.]*)$', 1))) AS e, count(DISTINCT regexp_extract(path, '^[^/]*')) AS f FROM lb WHERE len(m) > 0 GROUP BY 1)""")
def a19(t: Tables):
    return labelling.heterogeneity(labelled(t))


@query("p8_member_matches", "item_listing", ctes=LAB_CTES, sql="""
SELECT g, count(*) AS n FROM lab, unnest(m0) u(g) GROUP BY 1""")
def p8(t: Tables):
    items = labelled(t).drop("matched", "group_id")
    tests = F.array_compact(F.array(*[F.when(labelling.member_matches(s), F.lit(g)) for g, s in MEMBER_RULES.items()]))
    return items.select(F.explode(tests).alias("g")).groupBy("g").agg(F.count("*").alias("n"))


ROW_RULES = {
    "by_unit": {"unit": ["U1", "U10", "U100"]}, "by_rows": {"rows": {"unit": "U0", "indices": [1, "100-9000"]}}, "by_sample": {"sample_id": {"regex": "^S1[0-9]*7$"}},
    "by_file": {"raw_file": {"regex": "_2_neg$"}, "attribute": {"priority": ["1-URGENT", "5-LOW"]}}, "by_list": {"sample_lists": "first"},
    "by_kind": {"resolution": ["ambiguous"]}, "by_member": {"resolved_member": {"folder": "batch7", "ext": "raw"}}, "by_token": {"token": {"polarity": "positive"}, "resolution": "none"},
}


@query("p9_row_matches", "member", "catalog_row", ctes=mem_cte() + f",\nrs AS ({resolve_sql('catalog_row')})", sql=f"""
SELECT g, count(*) AS n FROM rs, unnest([CASE WHEN unit_id IN ('U1', 'U10', 'U100') THEN 'by_unit' END, CASE WHEN unit_id = 'U0' AND (row_index = 1 OR row_index BETWEEN 100 AND 9000) THEN 'by_rows' END,
  CASE WHEN regexp_matches(sample_id, '^S1[0-9]*7$') THEN 'by_sample' END, CASE WHEN regexp_matches(raw_file, '_2_neg$') AND o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'by_file' END,
  CASE WHEN sample_id IN ('S5', 'S6') THEN 'by_list' END, CASE WHEN kind = 'ambiguous' THEN 'by_kind' END, CASE WHEN starts_with(found_key, 'batch7/') AND regexp_matches(found_key, '\\.raw$') THEN 'by_member' END,
  CASE WHEN kind = 'none' AND {duck.polarity('raw_file')} = 'positive' THEN 'by_token' END]) u(g) WHERE g IS NOT NULL GROUP BY 1""")
def p9(t: Tables):
    rows = matching.resolve(t["catalog_row"], matching.index_members(t.stored("member"))).withColumn("attributes", F.create_map(F.lit("priority"), "o_orderpriority"))
    tests = F.array_compact(F.array(*[F.when(labelling.row_matches(s, {"first": ["S5", "S6"]}), F.lit(g)) for g, s in ROW_RULES.items()]))
    return rows.select(F.explode(tests).alias("g")).groupBy("g").agg(F.count("*").alias("n"))


@query("r2_resolution_findings", "member", "catalog_row", ctes=mem_cte() + f",\nrs AS ({resolve_sql('catalog_row')})", sql="""
SELECT CASE WHEN kind = 'none' THEN 'X-UNRESOLVED' ELSE 'X-AMBIGUOUS' END AS check_id, unit_id, row_index, candidates FROM rs WHERE kind IN ('none', 'ambiguous')""")
def r2_resolution(t: Tables):
    return labelling.resolution_findings(matching.resolve(t["catalog_row"], matching.index_members(t.stored("member"))))


@query("r4_expanded_payload", "item", sql="""
SELECT unit_id, kind, row_index, member_path, row_number() OVER (PARTITION BY unit_id, kind, row_index IS NULL ORDER BY row_index, member_path, sample_id) AS position
FROM (SELECT DISTINCT unit_id, kind, row_index, coalesce(member_path, '') AS member_path, '' AS sample_id FROM item)""")
def r4(t: Tables):
    items = t["item"].select("unit_id", "kind", "row_index", F.coalesce("member_path", F.lit("")).alias("path")).distinct()
    return labelling.expanded_payload(items).select("unit_id", "kind", "row_index", F.col("path").alias("member_path"), F.col("position").cast("bigint").alias("position"))


@query("r5_revision_scope", "item", sql="""
SELECT * FROM (WITH a AS (SELECT unit_id, string_agg(concat(sample_id, '|', kind), ',' ORDER BY sample_id, kind) AS s FROM item GROUP BY 1),
  b AS (SELECT unit_id, string_agg(concat(sample_id, '|', kind), ',' ORDER BY sample_id, kind) AS s FROM item WHERE confidence <> 'high' GROUP BY 1)
SELECT coalesce(a.unit_id, b.unit_id) AS unit_id FROM a FULL JOIN b ON a.unit_id = b.unit_id WHERE a.s IS DISTINCT FROM b.s AND coalesce(a.unit_id, b.unit_id) NOT IN (SELECT concat('U', o_orderkey) FROM orders WHERE o_orderstatus = 'O'))""")
def r5(t: Tables):
    i = t["item"].select("unit_id", "sample_id", "kind", "confidence")
    named = t["orders"].where("o_orderstatus = 'O'").select(F.concat(F.lit("U"), "o_orderkey").alias("unit_id"))
    return labelling.revision_scope(i, i.where("confidence <> 'high'"), named, ["sample_id", "kind"])


@query("p9_sample_lists", "catalog_row", sql="""
SELECT unit_id, row_index FROM catalog_row WHERE sample_id IN (SELECT concat('S', l_orderkey) FROM lineitem WHERE l_quantity > 45 UNION SELECT concat('S', l_orderkey) FROM lineitem WHERE l_returnflag = 'A')""")
def p9_lists(t: Tables):
    """Two lists of any length, met by a join."""
    li = t["lineitem"]
    named = lambda rows, name: rows.select(F.lit(name).alias("name"), F.concat(F.lit("S"), "l_orderkey").alias("sample_id"))
    lists = named(li.where("l_quantity > 45"), "large").union(named(li.where("l_returnflag = 'A'"), "returned")).union(named(li, "all"))
    rows = spec.with_sample_lists(t["catalog_row"], lists)
    return rows.where(labelling.row_matches({"sample_lists": ["large", "returned"]})).select("unit_id", "row_index")


# The spec's tables: a unit entry per order (some missing, some strange), a rule per part, references from line items.
SPEC = """se AS (SELECT concat('U', o_orderkey) AS unit_id, CASE o_orderstatus WHEN 'P' THEN 'excluded' ELSE 'ready' END AS status, CASE WHEN o_orderpriority = '1-URGENT' THEN 'no_files' END AS exclusion FROM orders WHERE o_orderkey % 10 <> 3
  UNION ALL SELECT concat('Z', c_custkey), 'ready', NULL FROM customer WHERE c_custkey % 7 = 0),
su AS (SELECT concat('U', o_orderkey) AS unit_id FROM orders),
sr AS (SELECT concat('g', p_partkey) AS rule_id, CASE WHEN p_size % 2 = 0 THEN 'members' ELSE 'rows' END AS applies_to, CASE WHEN p_size > 40 THEN 'exception' ELSE 'group' END AS kind FROM part WHERE p_partkey % 50 <> 0)"""


def spec_tables(t: Tables):
    o, c, p = t["orders"], t["customer"], t["part"]
    entries = o.where("o_orderkey % 10 <> 3").select(F.concat(F.lit("U"), "o_orderkey").alias("unit_id"), F.when(F.col("o_orderstatus") == "P", "excluded").otherwise("ready").alias("status"),
                                                     F.when(F.col("o_orderpriority") == "1-URGENT", "no_files").alias("exclusion"))
    entries = entries.union(c.where("c_custkey % 7 = 0").select(F.concat(F.lit("Z"), "c_custkey"), F.lit("ready"), F.lit(None).cast("string")))
    units = o.select(F.concat(F.lit("U"), "o_orderkey").alias("unit_id"))
    rules = p.where("p_partkey % 50 <> 0").select(F.concat(F.lit("g"), "p_partkey").alias("rule_id"), F.when(F.col("p_size") % 2 == 0, "members").otherwise("rows").alias("applies_to"),
                                                  F.when(F.col("p_size") > 40, "exception").otherwise("group").alias("kind"))
    return entries, units, rules


@query("x_units", ctes=SPEC, sql="""
SELECT 'X-UNITS' AS check_id, unit_id, unit_id AS subject, 'not_in_spec' AS message FROM su WHERE unit_id NOT IN (SELECT unit_id FROM se) UNION ALL SELECT 'X-UNITS', unit_id, unit_id, 'no_unit' FROM se WHERE unit_id NOT IN (SELECT unit_id FROM su)""")
def x_units(t: Tables):
    entries, units, _ = spec_tables(t)
    return spec.unit_set(entries, units)


@query("x_references", "item_listing", ctes=SPEC + ",\n" + mem_cte("item_listing") + f""",
me AS (SELECT concat('g', l_partkey) AS rule_id, {duck.key("concat('run', l_suppkey, '/f', l_partkey, '_pos.raw')")} AS key FROM lineitem WHERE l_quantity = 1)""", sql="""
SELECT 'X-UNKNOWN-REF' AS check_id, unit_id, concat('flag:', rule_id) AS subject, 'no_group' AS message FROM (SELECT DISTINCT concat('U', l_orderkey) AS unit_id, concat('g', l_partkey) AS rule_id FROM lineitem) WHERE rule_id NOT IN (SELECT rule_id FROM sr)
UNION ALL SELECT 'X-UNKNOWN-REF', unit_id, concat('shared_with:', named), 'no_unit' FROM (SELECT DISTINCT concat('U', l_orderkey) AS unit_id, concat('U', l_orderkey + l_suppkey * 100) AS named FROM lineitem) WHERE named NOT IN (SELECT unit_id FROM su)
UNION ALL SELECT 'X-UNKNOWN-REF', NULL, rule_id, CASE WHEN key NOT IN (SELECT member_key FROM mem) THEN 'no_member' ELSE 'a_row_resolves_to_it' END FROM me WHERE key NOT IN (SELECT member_key FROM mem) OR key LIKE 'run1%'
UNION ALL SELECT 'X-UNKNOWN-REF', NULL, rule_id, 'matches_nothing' FROM sr WHERE kind = 'exception' AND rule_id NOT IN (SELECT concat('g', l_partkey) FROM lineitem WHERE l_returnflag = 'A')""")
def x_references(t: Tables):
    _, units, rules = spec_tables(t)
    li = t["lineitem"]
    unit, rule = F.concat(F.lit("U"), "l_orderkey").alias("unit_id"), F.concat(F.lit("g"), "l_partkey").alias("rule_id")
    members = matching.index_members(t.stored("item_listing"))
    named = li.where("l_quantity = 1").select(rule, F.concat(F.lit("run"), "l_suppkey", F.lit("/f"), "l_partkey", F.lit("_pos.raw")).alias("member_path"))
    return spec.references(rules, li.select(unit, F.lit("flag").alias("place"), rule), li.select(unit, F.lit("shared_with").alias("place"), F.concat(F.lit("U"), F.col("l_orderkey") + F.col("l_suppkey") * 100).alias("named")),
                           units, named, members, members.where("member_key LIKE 'run1%'").select(F.col("member_key").alias("key")), li.where("l_returnflag = 'A'").select(rule))


@query("x_exceptions", "item", sql="""
SELECT * FROM (WITH r AS (SELECT unit_id, row_index, sample_id, raw_file FROM item WHERE row_index IS NOT NULL),
  e AS (SELECT concat('e', p_partkey) AS rule_id, concat('S', p_partkey) AS s FROM part WHERE p_size <= 25),
  f AS (SELECT concat('i', o_orderkey) AS rule_id, concat('U', o_orderkey) AS u, CAST(o_custkey % 6 AS BIGINT) AS i, o_orderstatus = 'P' AS bare FROM orders),
  c AS (SELECT rule_id, unit_id FROM r JOIN e ON r.sample_id = e.s UNION ALL SELECT rule_id, unit_id FROM r JOIN f ON r.unit_id = f.u AND r.row_index = f.i WHERE NOT bare)
SELECT 'X-EXCEPTION' AS check_id, unit_id, rule_id AS subject, concat('covers_', count(*)) AS message FROM c GROUP BY unit_id, rule_id HAVING count(*) > 1
UNION ALL SELECT 'X-EXCEPTION', NULL, rule_id, 'index_without_one_unit' FROM f WHERE bare)""")
def x_exceptions(t: Tables):
    none = F.lit(None)
    by_sample = t["part"].where("p_size <= 25").select(F.concat(F.lit("e"), "p_partkey").alias("rule_id"), F.array().cast("array<string>").alias("units"), none.cast("bigint").alias("row_index"),
                                                       F.concat(F.lit("S"), "p_partkey").alias("sample_id"), none.cast("string").alias("raw_file"))
    unit = F.array(F.concat(F.lit("U"), "o_orderkey"))
    by_index = t["orders"].select(F.concat(F.lit("i"), "o_orderkey"), F.when(F.col("o_orderstatus") == "P", F.array().cast("array<string>")).otherwise(unit), F.col("o_custkey") % 6, none.cast("string"), none.cast("string"))
    return spec.row_exceptions(by_sample.union(by_index), t["item"].where("row_index IS NOT NULL").select("unit_id", "row_index", "sample_id", "raw_file"))


@query("x_schema", ctes=SPEC, sql="""
SELECT 'X-SCHEMA' AS check_id, unit_id, status AS subject, 'exclusion_exactly_when_excluded' AS message FROM se WHERE (status = 'excluded') <> (exclusion IS NOT NULL)
UNION ALL SELECT DISTINCT 'X-SCHEMA', concat('U', l_orderkey), 'belongs_to_other_unit', 'exclude_gives_its_own_reason' FROM lineitem WHERE l_quantity = 2
UNION ALL SELECT DISTINCT 'X-SCHEMA', concat('U', l_orderkey), 'not_in_archive', 'a_member_is_in_the_archive' FROM lineitem JOIN sr ON sr.rule_id = concat('g', l_partkey) WHERE l_quantity = 3 AND applies_to = 'members'""")
def x_schema(t: Tables):
    entries, _, rules = spec_tables(t)
    reason = F.when(F.col("l_quantity") == 2, "belongs_to_other_unit").when(F.col("l_quantity") == 3, "not_in_archive").otherwise("other")
    excludes = t["lineitem"].select(F.concat(F.lit("U"), "l_orderkey").alias("unit_id"), reason.alias("reason"), F.concat(F.lit("g"), "l_partkey").alias("rule_id"))
    return spec.entry_rules(entries, excludes, rules)


@query("x_placeholder", "item", sql="""
SELECT 'X-PLACEHOLDER' AS check_id, unit_id, concat(rule_id, ':', name) AS subject, concat('no_value_in_', count(*)) AS message FROM (
  SELECT unit_id, concat('r_', basis) AS rule_id, 'member' AS name FROM item WHERE member_path IS NULL UNION ALL SELECT unit_id, concat('r_', basis), 'belongs' FROM item WHERE basis = 'inferred' AND belongs_to_unit IS NULL) GROUP BY unit_id, rule_id, name""")
def x_placeholder(t: Tables):
    values = F.create_map(F.lit("member"), "member_path", F.lit("sample"), "sample_id", F.lit("belongs"), "belongs_to_unit")
    template = F.when(F.col("basis") == "inferred", "{sample} in {member}, see {member} and {belongs}").otherwise("{sample} in {member}")
    return spec.placeholders(t["item"].select("unit_id", F.concat(F.lit("r_"), "basis").alias("rule_id"), template.alias("template"), values.alias("values")))


@query("x_child", "item", "child", sql="""
SELECT * FROM (WITH i AS (SELECT unit_id, sample_id AS item_id, CASE WHEN role = 'blank' THEN NULL WHEN ion_mode = 'positive' THEN 'pos' WHEN ion_mode = 'negative' THEN 'neg' ELSE 'both' END AS child_key FROM item WHERE reason IS NULL)
SELECT 'X-CHILD' AS check_id, unit_id, item_id AS subject, 'in_no_child' AS message FROM i WHERE child_key IS NULL AND unit_id IN (SELECT unit_id FROM child)
UNION ALL SELECT DISTINCT 'X-CHILD', unit_id, child_key, 'no_such_child' FROM i WHERE child_key IS NOT NULL AND (unit_id, child_key) NOT IN (SELECT (unit_id, child_key) FROM child WHERE child_key IS NOT NULL))""")
def x_child(t: Tables):
    key = F.when(F.col("role") != "blank", F.when(F.col("ion_mode") == "positive", "pos").when(F.col("ion_mode") == "negative", "neg").otherwise("both"))
    return spec.child_keys(t["item"].where("reason IS NULL").select("unit_id", F.col("sample_id").alias("item_id"), key.alias("child_key")), t["child"])


@query("x_dup_nokept", *DUP_SHAPES, ctes=TDUP, sql="""
SELECT 'X-DUP-NOKEPT' AS check_id, unit_id, CAST(flag_no AS VARCHAR) AS subject, CASE WHEN ok IS NULL THEN 'no_copy_at_all' ELSE 'nobody_keeps_a_copy' END AS message
FROM (SELECT DISTINCT unit_id, flag_no FROM sf) LEFT JOIN okg USING (unit_id, flag_no) WHERE NOT coalesce(ok, false)""")
def x_dup_nokept(t: Tables):
    flags, questions, _ = dup_inputs(t)
    return spec.dup_nokept(flags, questions, dup_keys(t), stored(duplicates.content_groups(t.stored("item_listing"))))
