"""Duplicate content and set profiles over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.functions import names
from cairnsift.operators import duplicates, matching
from cairnsift.queries import duck
from cairnsift.queries.matching import ITEM_KEYS, item_keys, mem_cte
from cairnsift.queries.registry import Dialect, Tables, query, shape
from cairnsift.session import stored


def groups_cte(source: str) -> str:
    k = duck.key("path")
    return f"""parts AS (SELECT {k} AS member_key, substr(lower({duck.norm('path')}), length({k}) + 1) AS inner_path, crc32, size FROM {source} WHERE {duck.in_folder('path')}),
placed AS (SELECT DISTINCT {k} AS member_key, concat('file:', crc32, ':', size) AS gid FROM {source}
    WHERE NOT {duck.in_folder('path')} AND {duck.rawlike('path')} AND size >= 1024 AND crc32 <> ''
  UNION ALL SELECT member_key, concat('folder:', string_agg(concat(inner_path, '|', crc32, '|', size), ';' ORDER BY inner_path, crc32, size)) FROM parts GROUP BY 1),
grp AS (SELECT member_key, gid, count(*) OVER (PARTITION BY gid) AS members, min(member_key) OVER (PARTITION BY gid) AS first_key FROM placed QUALIFY members > 1)"""


@query("a15_content_groups", "member", ctes=groups_cte("member"), sql="""
SELECT member_key, first_key, members FROM grp""")
def a15(t: Tables):
    g = duplicates.content_groups(t.stored("member"))
    first = g.groupBy("group_id").agg(F.min("member_key").alias("first_key"))
    return g.join(first, "group_id").select("member_key", "first_key", "members")


@query("a15_text_copies", "doc", sql="""
SELECT source, count(*) AS copies, count(DISTINCT digest) AS contents FROM (SELECT *, count(*) OVER (PARTITION BY digest, n_chars) AS n FROM doc) WHERE n > 1 AND n_chars >= 1024 GROUP BY 1""")
def a15_text(t: Tables):
    d = t["doc"].select("path", F.col("digest").alias("crc32"), F.col("n_chars").alias("size"), "source")
    g = duplicates.content_groups(d)
    return g.groupBy(F.substring_index("member_key", "/", 1).alias("source")).agg(
        F.count("*").alias("copies"), F.count_distinct("group_id").alias("contents"))


@query("w14_twin_ids", "item_listing", ctes=groups_cte("item_listing"), sql="""
SELECT first_key, max(members) AS members, concat('T', row_number() OVER (ORDER BY first_key, min(gid))) AS twin_id FROM grp GROUP BY first_key, gid""")
def w14(t: Tables):
    return duplicates.twin_ids(duplicates.content_groups(t.stored("item_listing"))).select("first_key", "members", "twin_id")


@query("a13_identical_row_tables", sql="""
WITH p AS (SELECT l_orderkey, l_linenumber AS i, l_returnflag AS v, CASE WHEN l_quantity > 25 THEN 'b' ELSE 's' END AS q FROM lineitem),
s AS (SELECT l_orderkey, string_agg(concat(i, v, q), ',' ORDER BY i, v, q) AS sig, count(*) AS n FROM p GROUP BY 1),
g AS (SELECT *, count(*) OVER (PARTITION BY sig) AS units, min(l_orderkey) OVER (PARTITION BY sig) AS first_unit FROM s)
SELECT l_orderkey, n, units, first_unit FROM g WHERE units > 1""")
def a13(t: Tables):
    rows = t["lineitem"].select("l_orderkey", F.col("l_linenumber").alias("i"), "l_returnflag", F.when(F.col("l_quantity") > 25, "b").otherwise("s").alias("q"))
    return duplicates.identical_row_tables(rows, "l_orderkey", "i", ["l_returnflag", "q"])


@query("a14_identical_kept_sets", "item", "item_listing", ctes=mem_cte("item_listing") + ",\n" + ITEM_KEYS + """,
firm AS (SELECT key_stem, count(DISTINCT key) AS n, min(key) AS only FROM keyst WHERE reason IS NULL AND resolved GROUP BY 1),
kept AS (SELECT DISTINCT unit_id, CASE WHEN NOT resolved AND f.n = 1 THEN f.only ELSE key END AS key FROM keyst k LEFT JOIN firm f USING (key_stem) WHERE reason IS NULL),
sets AS (SELECT unit_id, count(*) AS n, string_agg(key, '|' ORDER BY key) AS sig FROM kept GROUP BY 1),
eq AS (SELECT unit_id, n, count(*) OVER (PARTITION BY sig) AS units, min(unit_id) OVER (PARTITION BY sig) AS first_unit FROM sets)""",
       sql="SELECT * FROM eq WHERE units > 1")
def a14(t: Tables):
    kept = item_keys(t).where("reason IS NULL").select("unit_id", "key", matching.key_stem("key").alias("key_stem"), "resolved")
    canonical = duplicates.canonical_keys(kept).select("unit_id", F.col("canonical").alias("key"))
    return duplicates.identical_kept_sets(canonical)


@query("a12_folder_stats", "member", sql=f"""
SELECT * FROM (WITH u AS (SELECT {duck.root('path')} AS shown, CAST(sum(size) AS BIGINT) AS size FROM member WHERE NOT {duck.metadata('path')} GROUP BY 1),
  f AS (SELECT *, CASE WHEN contains(shown, '/') THEN {duck.folder('shown')} ELSE '(root)' END AS folder, {duck.rawlike('shown')} AS raw,
        coalesce(nullif(regexp_extract({duck.base('shown')}, '(\\.[^.]*)$', 1), ''), '(none)') AS ext FROM u),
  r AS (SELECT folder, list_sort(list(size)) AS s FROM f WHERE raw GROUP BY 1)
SELECT f.folder, count(*) AS members, min(size) AS min_size, max(size) AS max_size, string_agg(DISTINCT ext, ',' ORDER BY ext) AS extensions,
  CASE WHEN len(any_value(s)) >= 3 THEN any_value(s)[len(any_value(s)) // 2 + 1] END AS median FROM f LEFT JOIN r USING (folder) GROUP BY 1)""")
def a12(t: Tables):
    return duplicates.folder_stats(t.stored("member")).select("folder", "members", "min_size", "max_size", "extensions", "median")


@query("a12_small_members", "member", sql=f"""
SELECT * FROM (WITH u AS (SELECT {duck.root('path')} AS shown, CAST(sum(size) AS BIGINT) AS size FROM member WHERE NOT {duck.metadata('path')} GROUP BY 1),
  f AS (SELECT *, {duck.folder('shown')} AS folder FROM u WHERE {duck.rawlike('shown')}), r AS (SELECT folder, list_sort(list(size)) AS s FROM f GROUP BY 1)
SELECT shown, size FROM f JOIN r USING (folder) WHERE len(s) >= 3 AND size * 10 < s[len(s) // 2 + 1])""")
def a12_small(t: Tables):
    return duplicates.small_members(t.stored("member"), duplicates.folder_stats(t.stored("member"))).select("shown", "size")


@query("a16_folder_pairs", "member", ctes=groups_cte("member"), sql=f"""
SELECT least(fa, fb) AS folder_a, greatest(fa, fb) AS folder_b, count(*) AS pairs, count(*) FILTER (same) AS same_name FROM (
  SELECT {duck.folder('min(member_key)')} AS fa, {duck.folder('max(member_key)')} AS fb, {duck.base('min(member_key)')} = {duck.base('max(member_key)')} AS same
  FROM grp WHERE members = 2 GROUP BY gid) WHERE fa <> fb GROUP BY 1, 2""")
def a16(t: Tables):
    return duplicates.folder_pair_overlap(duplicates.content_groups(t["member"]))


@query("a17_level_word_counts", "worded", sql="""
SELECT * FROM (WITH w AS (SELECT DISTINCT name, unnest(string_split(lev, '+')) AS word FROM worded WHERE lev <> ''),
  r AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY lower(name), name) AS i, count(*) OVER (PARTITION BY word) AS n FROM w)
SELECT regexp_extract(word, '^[^:]*') AS kind, regexp_extract(word, '[^:]*$') AS label, n, string_agg(name, ', ' ORDER BY i) AS examples FROM r WHERE i <= 3 GROUP BY word, n)""")
def a17(t: Tables):
    return duplicates.level_word_counts(t["worded"])


@query("a11_attribute_profile", sql="""
WITH p AS (SELECT o_orderkey AS k, v.name, CASE v.name WHEN 'status' THEN o_orderstatus WHEN 'kind' THEN 'order' WHEN 'serial' THEN concat('n', o_orderkey)
    WHEN 'echo' THEN CAST(o_orderkey AS VARCHAR) ELSE CASE WHEN o_totalprice > 200000 THEN 'big' END END AS value
  FROM orders, (VALUES ('status'), ('kind'), ('serial'), ('echo'), ('big')) v(name)),
t AS (SELECT count(*) AS total FROM orders)
SELECT name, count(*) AS n, count(DISTINCT value) AS "values", CASE WHEN count(*) = any_value(total) AND count(DISTINCT value) = 1 THEN 'constant'
  WHEN count(*) = any_value(total) AND count(DISTINCT value) = count(*) AND NOT bool_and(value = CAST(k AS VARCHAR)) THEN 'identifier' ELSE 'varying' END AS kind
FROM p, t WHERE value IS NOT NULL GROUP BY 1""")
def a11(t: Tables):
    k = F.col("o_orderkey").cast("string")
    m = F.create_map(F.lit("status"), "o_orderstatus", F.lit("kind"), F.lit("order"), F.lit("serial"), F.concat(F.lit("n"), k), F.lit("echo"), k,
                     F.lit("big"), F.when(F.col("o_totalprice") > 200000, "big"))
    return duplicates.attribute_profile(t["orders"].select(k.alias("sample_id"), m.alias("attributes")), ["sample_id"])


@query("a28_study_shared_attributes", "unit", sql="""
SELECT * FROM (WITH u AS (SELECT o_custkey AS study_id, concat('U', o_orderkey) AS unit_id, o_orderstatus, o_orderpriority FROM orders),
  n AS (SELECT study_id, count(*) AS n_units FROM u GROUP BY 1 HAVING count(*) >= 2),
  a AS (SELECT study_id, unit_id, 'status' AS field, o_orderstatus AS value FROM u UNION ALL SELECT study_id, unit_id, 'priority', o_orderpriority FROM u UNION ALL SELECT study_id, unit_id, 'note', 'same' FROM u)
SELECT study_id, field, value, n_units FROM a JOIN n USING (study_id) GROUP BY ALL HAVING count(DISTINCT unit_id) = n_units)""")
def a28(t: Tables):
    u = t["orders"].select(F.col("o_custkey").alias("study_id"), F.concat(F.lit("U"), "o_orderkey").alias("unit_id"), "o_orderstatus", "o_orderpriority")
    a = u.select("unit_id", F.explode(F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority", F.lit("note"), F.lit("same"))).alias("field", "value"))
    return duplicates.study_shared_attributes(u.select("study_id", "unit_id"), a)


DUP_CTES = (mem_cte("item_listing") + ",\n" + ITEM_KEYS + ",\n" + groups_cte("item_listing") + """,
kept AS (SELECT DISTINCT unit_id, key, ion_mode, chromatography FROM keyst WHERE reason IS NULL AND resolved),
held AS (SELECT DISTINCT unit_id, key, reason FROM keyst WHERE reason IN ('needs_person', 'shared_content_unassigned') AND resolved)""")


def kept_and_held(t: Tables):
    keyed = item_keys(t).where("resolved")
    kept = keyed.where("reason IS NULL").select("unit_id", "key", "ion_mode", "chromatography").distinct()
    held = keyed.where("reason IN ('needs_person', 'shared_content_unassigned')").select("unit_id", "key", "reason").distinct()
    return kept, held


@query("a32_shared_content_without_keepers", "item", "item_listing", "flag", ctes=DUP_CTES, sql="""
SELECT * FROM (WITH about AS (SELECT DISTINCT s.unit_id, g.gid FROM held s JOIN grp g ON s.key = g.member_key WHERE s.unit_id IN (SELECT unit_id FROM flag WHERE code = 'shared_content')),
  ok AS (SELECT a.unit_id, bool_or(EXISTS (SELECT 1 FROM grp g JOIN kept k ON k.key = g.member_key WHERE g.gid = a.gid)
      OR EXISTS (SELECT 1 FROM grp g JOIN held h ON h.key = g.member_key WHERE g.gid = a.gid AND (h.reason = 'needs_person' OR h.unit_id <> a.unit_id))) AS kept FROM about a GROUP BY 1)
SELECT f.unit_id, ok.unit_id IS NOT NULL AS has_twins FROM (SELECT DISTINCT unit_id FROM flag WHERE code = 'shared_content') f LEFT JOIN ok USING (unit_id) WHERE NOT coalesce(ok.kept, false))""")
def a32(t: Tables):
    kept, held = kept_and_held(t)
    flags = t["flag"].where("code = 'shared_content'")
    groups = duplicates.content_groups(t.stored("item_listing"))
    return duplicates.shared_content_without_keepers(flags, held, groups, kept, held)


@query("j25_other_arm", "item", "item_listing", ctes=DUP_CTES, sql=f"""
SELECT * FROM (WITH pl AS (SELECT unit_id, {duck.folder('key')} AS folder FROM kept UNION SELECT unit_id, {duck.folder('key')} FROM held),
  tw AS (SELECT a.member_key, b.member_key AS twin, {duck.folder('b.member_key')} AS folder, {duck.polarity('b.member_key')} AS pol, {duck.chromatography('b.member_key')} AS chrom
    FROM grp a JOIN grp b ON a.gid = b.gid AND a.member_key <> b.member_key),
  fold AS (SELECT folder, min(unit_id) AS lo, max(unit_id) AS hi FROM pl GROUP BY 1)
SELECT k.unit_id, k.key, k.ion_mode, k.chromatography, coalesce(bool_or(f.lo <> k.unit_id OR f.hi <> k.unit_id), false) AS by_folder,
  coalesce(bool_or((k.ion_mode IN ('positive', 'negative') AND tw.pol IS NOT NULL AND tw.pol <> k.ion_mode) OR (k.chromatography IN ('HILIC', 'RP') AND tw.chrom IS NOT NULL AND tw.chrom <> k.chromatography)), false) AS by_token
FROM kept k JOIN tw ON k.key = tw.member_key LEFT JOIN fold f ON f.folder = tw.folder GROUP BY 1, 2, 3, 4)""")
def j25(t: Tables):
    kept, held = kept_and_held(t)
    placed = kept.select("unit_id", "key").unionByName(held.select("unit_id", "key")).distinct()
    groups = duplicates.content_groups(t.stored("item_listing"))
    out = duplicates.other_arm(kept, groups, placed)
    return out.groupBy("unit_id", "key", "ion_mode", "chromatography").agg(
        F.bool_or("by_folder").alias("by_folder"), F.bool_or("by_token").alias("by_token"))


@shape("dup_flag")
def dup_flag(d: Dialect) -> str:
    """Shared-content flags (some units have several): one in three names a member, one a row, one nothing."""
    return f"""
SELECT concat('U', {d.text('l_orderkey')}) AS unit_id, cast(l_linenumber AS bigint) AS flag_no,
       CASE WHEN l_tax = 0.05 THEN 'duplicate_copies_excluded' ELSE 'shared_content' END AS code,
       CASE WHEN l_returnflag = 'A' THEN concat('run', {d.text('l_suppkey')}, '/f', {d.text('l_partkey')}, CASE WHEN l_quantity > 25 THEN '_pos' WHEN l_quantity > 10 THEN '_neg_C18_DIA' ELSE '' END,
            CASE WHEN l_linestatus = 'O' THEN '.mzXML' ELSE '.raw' END) END AS named_path,
       CASE WHEN l_returnflag = 'N' THEN cast(l_linenumber AS bigint) - 1 END AS named_row
FROM {d.table('lineitem')} WHERE l_tax IN (0, 0.05)"""


@shape("dup_question")
def dup_question(d: Dialect) -> str:
    """Shared-content questions, each about one row."""
    return f"""
SELECT concat('U', {d.text('l_orderkey')}) AS unit_id, cast(l_linenumber AS bigint) AS flag_no, 'shared_content' AS code, cast(l_linenumber AS bigint) - 1 AS named_row
FROM {d.table('lineitem')} WHERE l_tax = 0.01"""


TDUP = DUP_CTES + f""",
firmk AS (SELECT * FROM keyst WHERE resolved),
sf AS (SELECT * FROM dup_flag WHERE code = 'shared_content'),
nm AS (SELECT unit_id, flag_no, {duck.key('named_path')} AS key FROM sf WHERE named_path IS NOT NULL
  UNION SELECT s.unit_id, s.flag_no, k.key FROM sf s JOIN firmk k ON s.unit_id = k.unit_id AND s.named_row = k.row_index AND k.kind IN ('row', 'excluded_row')),
qn AS (SELECT q.unit_id, k.key FROM dup_question q JOIN firmk k ON q.unit_id = k.unit_id AND q.named_row = k.row_index AND k.kind IN ('row', 'excluded_row')),
subj AS (SELECT unit_id, flag_no, key FROM nm
  UNION SELECT s.unit_id, s.flag_no, q.key FROM sf s JOIN qn q USING (unit_id) WHERE (s.unit_id, s.flag_no) NOT IN (SELECT (unit_id, flag_no) FROM nm)
  UNION SELECT s.unit_id, s.flag_no, k.key FROM sf s JOIN firmk k USING (unit_id) WHERE (s.unit_id, s.flag_no) NOT IN (SELECT (unit_id, flag_no) FROM nm) AND s.unit_id NOT IN (SELECT unit_id FROM qn)
    AND (k.reason IS NULL OR k.reason IN ('needs_person', 'shared_content_unassigned') OR (k.kind = 'excluded_row' AND k.reason = 'duplicate_content'))),
abt AS (SELECT DISTINCT s.unit_id, s.flag_no, g.gid FROM subj s JOIN grp g ON s.key = g.member_key),
okg AS (SELECT a.unit_id, a.flag_no, bool_or(EXISTS (SELECT 1 FROM grp g JOIN kept k ON k.key = g.member_key WHERE g.gid = a.gid)
      OR EXISTS (SELECT 1 FROM grp g JOIN held h ON h.key = g.member_key WHERE g.gid = a.gid AND (h.reason = 'needs_person' OR h.unit_id <> a.unit_id))) AS ok FROM abt a GROUP BY 1, 2),
kp AS (SELECT unit_id, key, min({{'i': ion_mode, 'c': chromatography}}) AS m FROM kept GROUP BY 1, 2),
tw AS (SELECT a.member_key, b.member_key AS twin, a.gid FROM grp a JOIN grp b ON a.gid = b.gid AND a.member_key <> b.member_key),
pl AS (SELECT unit_id, {duck.folder('key')} AS folder FROM kept UNION SELECT unit_id, {duck.folder('key')} FROM held),
tk AS (SELECT unit_id, key, string_agg(other, ',' ORDER BY other) FILTER (other <> unit_id) AS others, coalesce(bool_or(other = unit_id), false) AS inside
  FROM (SELECT DISTINCT k.unit_id, k.key, tw.gid, o.unit_id AS other FROM kp k JOIN tw ON k.key = tw.member_key LEFT JOIN kp o ON o.key = tw.twin) GROUP BY 1, 2),
fold AS (SELECT folder, min(unit_id) AS lo, max(unit_id) AS hi FROM pl GROUP BY 1),
am AS (SELECT k.unit_id, k.key, coalesce(bool_or(f.lo <> k.unit_id OR f.hi <> k.unit_id), false)
    OR coalesce(bool_or((k.m.i IN ('positive', 'negative') AND {duck.polarity('tw.twin')} <> k.m.i) OR (k.m.c IN ('HILIC', 'RP') AND {duck.chromatography('tw.twin')} <> k.m.c)), false) AS arm
  FROM kp k JOIN tw ON k.key = tw.member_key LEFT JOIN fold f ON f.folder = {duck.folder('tw.twin')} GROUP BY 1, 2),
st AS (SELECT p.unit_id, p.status, coalesce(bool_or(f.code = 'shared_content'), false) AND (p.status <> 'ready' OR p.unit_id IN (SELECT unit_id FROM dup_question WHERE named_row > 3)) AS settled,
    coalesce(bool_or(f.code = 'duplicate_copies_excluded'), false) AS noted FROM payload p LEFT JOIN dup_flag f USING (unit_id) GROUP BY 1, 2),
hh AS (SELECT t.*, st.settled, st.noted, CASE WHEN others IS NULL AND NOT inside AND NOT arm THEN 'copy' ELSE 'shared' END AS kind FROM tk t JOIN am USING (unit_id, key) JOIN st USING (unit_id)),
tdup AS (SELECT 'T-DUP' AS check_id, 'error' AS severity, unit_id, key AS subject, 'twin_in_unit' AS message FROM hh WHERE inside AND NOT settled
  UNION ALL SELECT * FROM (SELECT 'T-DUP', CASE WHEN settled THEN 'hold' ELSE 'error' END, unit_id, min(key), CASE WHEN settled THEN 'waits_for_person' WHEN kind = 'shared' THEN 'shared_unflagged' WHEN NOT noted THEN 'copy_unflagged' END AS m
    FROM hh GROUP BY unit_id, others, kind, settled, noted) WHERE m IS NOT NULL
  UNION ALL SELECT 'T-DUP', 'error', s.unit_id, CAST(s.flag_no AS VARCHAR), CASE WHEN o.ok IS NOT NULL THEN 'flag_without_keeper' ELSE 'flag_without_twin' END FROM (SELECT DISTINCT unit_id, flag_no FROM sf) s LEFT JOIN okg o USING (unit_id, flag_no) WHERE NOT coalesce(o.ok, false))"""
DUP_SHAPES = ("item", "item_listing", "payload", "dup_flag", "dup_question")


def dup_inputs(t: Tables):
    none = lambda kind: F.array().cast(f"array<{kind}>")
    flags = t["dup_flag"].select("unit_id", "flag_no", "code", F.when(F.col("named_row").isNotNull(), F.array("named_row")).otherwise(none("bigint")).alias("row_indices"),
                                 F.when(F.col("named_path").isNotNull(), F.array("named_path")).otherwise(none("string")).alias("member_paths"))
    questions = t["dup_question"].select("unit_id", "flag_no", "code", F.array("named_row").alias("row_indices"), none("string").alias("member_paths"))
    answered = t["dup_question"].where("named_row > 3").select("unit_id", "code")
    return flags, questions, answered


def dup_keys(t: Tables):
    """The items with their keys, as far as findings on copies read them, stored."""
    members = matching.index_members(t.stored("item_listing"))
    keyed = matching.item_keys(t["item"].select("unit_id", "kind", "row_index", "raw_file", "member_path", "reason", "ion_mode", "chromatography"), members)
    return stored(keyed.drop("raw_file", "member_path"))


@query("t_dup", *DUP_SHAPES, ctes=TDUP, sql="SELECT * FROM tdup")
def t_dup(t: Tables):
    flags, questions, answered = dup_inputs(t)
    codes = flags.groupBy("unit_id").agg(F.collect_set("code").alias("flags"))
    facts = t["payload"].join(codes, "unit_id", "left").select("unit_id", "status", F.coalesce("flags", F.array().cast("array<string>")).alias("flags"))
    return duplicates.t_dup(facts, dup_keys(t), stored(duplicates.content_groups(t.stored("item_listing"))), flags, questions, answered)


@query("t_excl_own_arm", "item", "item_listing", "payload", ctes=DUP_CTES + f""",
tw AS (SELECT a.member_key, b.member_key AS twin FROM grp a JOIN grp b ON a.gid = b.gid AND a.member_key <> b.member_key),
pl AS (SELECT unit_id, {duck.folder('key')} AS folder FROM kept UNION SELECT unit_id, {duck.folder('key')} FROM held), fold AS (SELECT folder, min(unit_id) AS lo, max(unit_id) AS hi FROM pl GROUP BY 1)""", sql=f"""
SELECT 'T-EXCL' AS check_id, 'error' AS severity, h.unit_id, h.key AS subject, 'unassigned_in_own_arm' AS message
FROM held h JOIN payload p USING (unit_id) JOIN tw ON h.key = tw.member_key LEFT JOIN fold f ON f.folder = {duck.folder('tw.twin')} WHERE h.reason = 'shared_content_unassigned' GROUP BY h.unit_id, h.key
HAVING NOT coalesce(bool_or(f.lo <> h.unit_id OR f.hi <> h.unit_id), false) AND NOT coalesce(bool_or((p.ion_mode IN ('positive', 'negative') AND {duck.polarity('tw.twin')} <> p.ion_mode)
  OR (p.chromatography IN ('HILIC', 'RP') AND {duck.chromatography('tw.twin')} <> p.chromatography)), false)""")
def t_own_arm(t: Tables):
    return duplicates.unassigned_in_own_arm(dup_keys(t), t["payload"], stored(duplicates.content_groups(t.stored("item_listing"))))
