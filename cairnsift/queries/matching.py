"""Matching operators over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.functions import names
from cairnsift.operators import matching
from cairnsift.queries import duck
from cairnsift.queries.registry import Dialect, Tables, query, shape

KEY, STEM, BASE = duck.key("path"), duck.stem, duck.base


def mem_cte(source: str = "member", where: str = "true") -> str:
    k = duck.key("path")
    return f"""mem AS (SELECT member_key, min(shown) AS member_path, regexp_extract(member_key, '([^/]*)$', 1) AS name,
       lower({duck.stem('member_key')}) AS stem, {duck.convert('member_key')} AS converts
  FROM (SELECT {k} AS member_key, {duck.root('path')} AS shown FROM {source} WHERE {duck.rawlike('path')}) WHERE {where} GROUP BY 1),
names AS (SELECT name, count(*) AS name_n, min(member_key) AS name_key, bool_and(NOT converts) AS name_ok, min(member_path) AS name_path FROM mem GROUP BY 1),
stems AS (SELECT stem, count(*) AS stem_n, min(member_key) AS stem_key, count(*) FILTER (NOT converts) AS direct_n,
       min(member_key) FILTER (NOT converts) AS direct_key, bool_and(NOT converts) AS stem_ok, min(member_path) AS stem_path FROM mem GROUP BY 1)"""


def resolve_sql(rows: str, name: str = "raw_file", extra: str = "r.*") -> str:
    return f"""SELECT {extra},
  CASE WHEN n.name_n = 1 THEN 'exact' WHEN s.stem_n = 1 OR (s.stem_n > 1 AND s.direct_n = 1) THEN 'stem'
       WHEN n.name_n IS NOT NULL OR s.stem_n IS NOT NULL THEN 'ambiguous' ELSE 'none' END AS kind,
  CASE WHEN n.name_n = 1 THEN name_key WHEN s.stem_n = 1 THEN stem_key WHEN s.stem_n > 1 AND direct_n = 1 THEN direct_key END AS found_key,
  CAST(CASE WHEN n.name_n = 1 OR s.stem_n = 1 OR (s.stem_n > 1 AND direct_n = 1) THEN 1 ELSE coalesce(n.name_n, s.stem_n, 0) END AS BIGINT) AS candidates,
  n.name_ok, n.name_path, s.stem_ok, s.stem_path
FROM {rows} r LEFT JOIN names n ON lower({duck.base('r.' + name)}) = n.name LEFT JOIN stems s ON lower({duck.stem('r.' + name)}) = s.stem"""


@shape("item_listing")
def item_listing(d: Dialect) -> str:
    """The listing the decision documents rest on: part files in supplier folders, some in two encodings."""
    return f"""
SELECT CASE WHEN l_discount >= 0.08 THEN concat('notes/n', {d.text('l_orderkey')}, '.txt') ELSE concat('run', {d.text('l_suppkey')}, '/f', {d.text('l_partkey')},
              CASE WHEN l_quantity > 25 THEN '_pos' WHEN l_quantity > 10 THEN '_neg_C18_DIA' ELSE '' END,
              CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN '.mzXML' WHEN l_linestatus = 'O' THEN '.raw'
                   WHEN l_returnflag = 'N' THEN '.zip' ELSE '.mzXML' END) END AS path,
       cast(l_quantity AS bigint) * 1000 AS size, upper(lpad(hex(l_partkey * 64 + cast(l_quantity AS bigint)), 8, '0')) AS crc32
FROM {d.table('lineitem')}"""


ITEM_KEYS = f"""keyed AS (
  SELECT r.*, CASE WHEN member_path IS NOT NULL THEN {duck.key('member_path')} WHEN own_key THEN {duck.key('raw_file')} WHEN found_key IS NOT NULL THEN found_key
              ELSE concat('raw:', lower({duck.stem('raw_file')})) END AS key,
         member_path IS NOT NULL OR own_key OR found_key IS NOT NULL AS resolved
  FROM (SELECT *, coalesce(contains({duck.norm('raw_file')}, '/'), false) OR coalesce({duck.key('raw_file')} IN (SELECT member_key FROM mem), false) AS own_key FROM ({resolve_sql('item')})) r),
keyst AS (SELECT *, CASE WHEN starts_with(key, 'raw:') THEN substr(key, 5) ELSE lower({duck.stem('key')}) END AS key_stem FROM keyed)"""


def item_keys(t: Tables):
    return matching.item_keys(t.stored("item"), matching.index_members(t.stored("item_listing")))


@query("j1_resolve", "member", "catalog_row", ctes=mem_cte(), sql=f"""
SELECT unit_id, row_index, kind, found_key AS member_key, candidates FROM ({resolve_sql('catalog_row')})""")
def j1(t: Tables):
    members = matching.index_members(t.stored("member"))
    return matching.resolve(t["catalog_row"], members).select("unit_id", "row_index", "kind", "member_key", "candidates")


@query("j1_candidates", "member", "catalog_row", ctes=mem_cte(), sql=f"""
SELECT DISTINCT lower(a.raw_file) AS asked, m.member_key FROM ({resolve_sql('catalog_row')}) a
JOIN mem m ON CASE WHEN lower(a.raw_file) IN (SELECT name FROM names) THEN m.name = lower(a.raw_file) ELSE m.stem = lower({duck.stem('a.raw_file')}) END
WHERE a.kind = 'ambiguous'""")
def j1_candidates(t: Tables):
    members = matching.index_members(t.stored("member"))
    return matching.candidates(matching.resolve(t["catalog_row"], members), members)


@query("j2_resolve_within", "member", "catalog_row",
       ctes=mem_cte(where="starts_with(lower(shown), 'batch7/') OR starts_with(lower(shown), 'batch12/')"), sql=f"""
SELECT unit_id, row_index, kind, found_key AS member_key, candidates FROM ({resolve_sql('catalog_row')})""")
def j2(t: Tables):
    members = matching.index_members(t.stored("member"))
    return matching.resolve_within(t["catalog_row"], members, ["Batch7", "batch12/"]).select("unit_id", "row_index", "kind", "member_key", "candidates")


@query("j3_same_file", "item", "item_listing", ctes=mem_cte("item_listing") + ",\n" + ITEM_KEYS, sql="""
SELECT DISTINCT e.l_orderkey, e.key FROM keyst e JOIN keyst k ON e.unit_id = k.unit_id AND k.kind_of = 'kept' AND e.kind_of = 'gone'
  AND (e.key = k.key OR ((NOT e.resolved OR NOT k.resolved) AND e.key_stem = k.key_stem))""".replace(
    "keyst e JOIN keyst k", "(SELECT *, CASE WHEN reason IS NULL THEN 'kept' ELSE 'gone' END AS kind_of FROM keyst) e JOIN (SELECT *, CASE WHEN reason IS NULL THEN 'kept' ELSE 'gone' END AS kind_of FROM keyst) k"))
def j3(t: Tables):
    keyed = item_keys(t)
    gone = keyed.where("reason IS NOT NULL").select("unit_id", "l_orderkey", "key", "resolved").distinct().withColumn(
        "id", F.struct("l_orderkey", "key"))
    hit = matching.same_file(gone, keyed.where("reason IS NULL"), ["unit_id"], "id")
    return hit.select("id.l_orderkey", "id.key")


@query("j4_reconcile_rows", sql="""
WITH l AS (SELECT o_orderkey AS k, o_orderstatus AS s, 'v' || o_custkey AS v FROM orders WHERE o_orderpriority <> '1-URGENT' UNION ALL
           SELECT o_orderkey, o_orderstatus, 'v' || o_custkey FROM orders WHERE o_totalprice > 480000),
     r AS (SELECT o_orderkey AS k, CASE WHEN o_totalprice < 20000 THEN 'X' ELSE o_orderstatus END AS s, 'v' || o_custkey AS v FROM orders WHERE o_orderpriority <> '2-HIGH'),
     lf AS (SELECT k, count(*) AS n, min(s) AS s FROM l GROUP BY 1), rf AS (SELECT k, count(*) AS n, min(s) AS s FROM r GROUP BY 1)
SELECT coalesce(lf.k, rf.k) AS row_index, CASE WHEN rf.k IS NULL THEN 'missing_right' WHEN lf.k IS NULL THEN 'missing_left' WHEN lf.n > 1 OR rf.n > 1 THEN 'duplicate'
       WHEN lf.s <> rf.s THEN 'changed' ELSE 'equal' END AS result FROM lf FULL JOIN rf ON lf.k = rf.k""")
def j4(t: Tables):
    o = t["orders"].select(F.col("o_orderkey").alias("row_index"), F.col("o_orderstatus").alias("status"),
                           F.concat(F.lit("v"), "o_custkey").alias("v"), "o_orderpriority", "o_totalprice")
    left = o.where("o_orderpriority <> '1-URGENT'").unionByName(o.where("o_totalprice > 480000"))
    right = o.where("o_orderpriority <> '2-HIGH'").withColumn("status", F.when(F.col("o_totalprice") < 20000, "X").otherwise(F.col("status")))
    return matching.reconcile(left, right, ["row_index"], ["status", "v"]).select("row_index", "result")


@query("j5_belongs_to_other", "item", "item_listing", ctes=mem_cte("item_listing") + ",\n" + ITEM_KEYS, sql="""
, asked AS (SELECT DISTINCT unit_id, key, resolved, key_stem, belongs_to_unit AS target FROM keyst WHERE reason = 'belongs_to_other_unit'),
kept AS (SELECT DISTINCT unit_id, key, resolved, key_stem FROM keyst WHERE reason IS NULL)
SELECT a.unit_id, a.key, a.target, CASE WHEN target IS NULL THEN 'unnamed' WHEN target = a.unit_id THEN 'self' WHEN target NOT IN (SELECT unit_id FROM keyst) THEN 'unknown_unit'
  WHEN EXISTS (SELECT 1 FROM kept k WHERE k.unit_id = a.target AND (k.key = a.key OR ((NOT k.resolved OR NOT a.resolved) AND k.key_stem = a.key_stem))) THEN 'ok' ELSE 'not_kept' END AS result
FROM asked a""".lstrip().replace(", asked", "SELECT * FROM (WITH asked", 1) + ")")
def j5(t: Tables):
    keyed = item_keys(t)
    gone = keyed.where("reason = 'belongs_to_other_unit'").select("unit_id", "key", "resolved", "belongs_to_unit").distinct().withColumn(
        "id", F.struct("unit_id", "key", "belongs_to_unit"))
    out = matching.belongs_to_other(gone, keyed.where("reason IS NULL"), keyed.select("unit_id"))
    return out.select("id.unit_id", "id.key", "target", "result")


@query("j6_shared_reciprocity", "share", sql="""
SELECT s.unit_id, s.other_unit_id, lower(s.member_path) AS key FROM share s
WHERE NOT EXISTS (SELECT 1 FROM share b WHERE b.unit_id = s.other_unit_id AND b.other_unit_id = s.unit_id AND b.member_path = s.member_path)""")
def j6(t: Tables):
    return matching.shared_reciprocity(t["share"])


@query("j7_loose_members", "item_listing", "item", sql=f"""
SELECT DISTINCT {KEY} AS member_key FROM item_listing l WHERE {duck.rawlike('path')}
  AND {KEY} NOT IN (SELECT {duck.key('member_path')} FROM item WHERE member_path IS NOT NULL)
  AND lower({BASE('path')}) NOT IN (SELECT lower(raw_file) FROM item WHERE member_path IS NULL)""")
def j7(t: Tables):
    return matching.loose_members(t.stored("item_listing"), t["item"])


@query("j9_child_members", "item", "child", sql=f"""
SELECT * FROM (WITH c AS (SELECT unit_id, {duck.key('member_path')} AS key, count(DISTINCT child_key) AS n FROM child GROUP BY 1, 2),
  k AS (SELECT DISTINCT unit_id, {duck.key('member_path')} AS key FROM item WHERE reason IS NULL AND member_path IS NOT NULL AND unit_id IN (SELECT unit_id FROM child))
SELECT unit_id, key, 'in_two_children' AS problem FROM c WHERE n > 1
UNION ALL SELECT unit_id, key, 'child_member_not_kept' FROM c ANTI JOIN k USING (unit_id, key)
UNION ALL SELECT unit_id, key, 'kept_in_no_child' FROM k ANTI JOIN c USING (unit_id, key))""")
def j9(t: Tables):
    kept = t["item"].where("reason IS NULL AND member_path IS NOT NULL").select("unit_id", names.member_key("member_path").alias("key"))
    children = t["child"].select("unit_id", "child_key", names.member_key("member_path").alias("key"))
    return matching.child_members(kept, children)


@shape("arm")
def arm(d: Dialect) -> str:
    """Member sets of arms: per customer segment and nation pair, the size classes of the parts ordered."""
    return f"""
SELECT DISTINCT l_returnflag AS scope, concat('U', {d.text('l_suppkey')}) AS unit_id, CASE WHEN l_extendedprice < 1500 THEN concat('m', {d.text('cast(l_quantity AS int)')}) ELSE 'rest' END AS key,
       CASE WHEN l_suppkey < 40 THEN 'positive' WHEN l_suppkey < 95 THEN 'negative' ELSE 'unknown' END AS ion
FROM {d.table('lineitem')}"""


@query("j10_polarity_partner", "arm", sql="""
SELECT * FROM (WITH s AS (SELECT scope, unit_id, ion, string_agg(DISTINCT key, ',' ORDER BY key) AS sig FROM arm GROUP BY 1, 2, 3),
  g AS (SELECT scope, sig, count(*) AS units, count(*) FILTER (ion = 'positive') AS pos, count(*) FILTER (ion = 'negative') AS neg,
        min(unit_id) FILTER (ion = 'positive') AS pu, min(unit_id) FILTER (ion = 'negative') AS nu FROM s GROUP BY 1, 2)
SELECT scope, unit_id, ion, CASE WHEN ion = 'unknown' THEN 'no_polarity' WHEN units = 1 THEN 'none'
    WHEN units - 1 <> CASE WHEN ion = 'positive' THEN neg ELSE pos END THEN 'other_polarity'
    WHEN CASE WHEN ion = 'positive' THEN neg ELSE pos END > 1 THEN 'several' ELSE 'partner' END AS why,
  CASE WHEN ion <> 'unknown' AND units = 2 AND CASE WHEN ion = 'positive' THEN neg ELSE pos END = 1 THEN CASE WHEN ion = 'positive' THEN nu ELSE pu END END AS partner_unit_id
FROM s JOIN g USING (scope, sig))""")
def j10(t: Tables):
    a = t["arm"]
    return matching.polarity_partner(a, a.select("unit_id", "ion").distinct())


@query("j11_document_diff", sql="""
SELECT o_orderkey, f.field FROM orders, (VALUES ('status'), ('price'), ('ready'), ('blocking')) f(field)
WHERE (f.field = 'status' AND o_orderstatus = 'F') OR (f.field = 'price' AND o_orderpriority = '1-URGENT')
   OR (f.field = 'blocking' AND o_totalprice > 300000) OR (f.field = 'ready' AND o_totalprice > 300000 AND o_orderstatus = 'O')""")
def j11(t: Tables):
    o = t["orders"]
    doc = lambda **f: F.to_json(F.struct(*[v.alias(k) for k, v in f.items()]), {"ignoreNullFields": "false"})
    a = o.select("o_orderkey", doc(status=F.col("o_orderstatus"), price=F.lit("1"), ready=F.lit("yes"), blocking=F.lit("none"), path=F.lit("a")).alias("doc"))
    b = o.select("o_orderkey", doc(status=F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")),
                                   price=F.when(F.col("o_orderpriority") == "1-URGENT", "2").otherwise("1"),
                                   ready=F.when(F.col("o_orderstatus") == "O", "no").otherwise("yes"),
                                   blocking=F.when(F.col("o_totalprice") > 300000, "one").otherwise("none"), path=F.lit("b")).alias("doc"))
    return matching.document_diff(a, b, "o_orderkey", ["path"], ["ready"], "blocking")


@query("j12_class_on_rows", "item", sql="""
SELECT * FROM (WITH a AS (SELECT concat('U', l_orderkey) AS unit_id, concat('S', l_partkey) AS sample_id,
    min(CASE WHEN l_quantity > 40 THEN 'blank' WHEN l_quantity > 20 THEN 'case' ELSE 'control' END) AS label FROM lineitem GROUP BY 1, 2),
  k AS (SELECT unit_id, sample_id, count(*) AS n FROM item WHERE reason IS NULL GROUP BY 1, 2),
  p AS (SELECT unit_id, label, count(*) AS before, CAST(sum(coalesce(n, 0)) AS BIGINT) AS after FROM a LEFT JOIN k USING (unit_id, sample_id) GROUP BY 1, 2)
SELECT unit_id, CAST(sum(before) AS BIGINT) AS assigned, CAST(sum(after) AS BIGINT) AS kept_assigned, count(*) FILTER (label <> 'blank') AS sides_before,
  count(*) FILTER (label <> 'blank' AND after > 0) AS sides_after, count(*) FILTER (label <> 'blank' AND after = 0) AS lost,
  min(label) FILTER (label <> 'blank' AND after = 0) AS first_lost,
  count(*) FILTER (label <> 'blank') < 2 OR count(*) FILTER (label <> 'blank' AND after > 0) >= 2 AS contrast_intact FROM p GROUP BY 1)""")
def j12(t: Tables):
    li = t["lineitem"].select(F.concat(F.lit("U"), "l_orderkey").alias("unit_id"), F.concat(F.lit("S"), "l_partkey").alias("sample_id"),
                              F.when(F.col("l_quantity") > 40, "blank").when(F.col("l_quantity") > 20, "case").otherwise("control").alias("label"))
    a = li.groupBy("unit_id", "sample_id").agg(F.min("label").alias("label"))
    return matching.class_on_rows(a, t["item"].where("reason IS NULL"))


@query("j14_member_lookup", "item_listing", sql=f"""
SELECT * FROM (WITH s AS (SELECT p_partkey, concat('f', p_partkey, '_pos.raw') AS member_path, CAST(p_size AS BIGINT) * 1000 AS size FROM part),
  f AS (SELECT DISTINCT path, size, regexp_extract(path, '([^/]*)$', 1) AS tail FROM item_listing)
SELECT s.p_partkey, CASE WHEN count(DISTINCT path) <> 1 THEN 'not_evaluable' WHEN s.size <> min(f.size) THEN 'size_differs' ELSE 'equal' END AS result
FROM s LEFT JOIN f ON f.tail = s.member_path GROUP BY s.p_partkey, s.size)""")
def j14(t: Tables):
    s = t["part"].select("p_partkey", F.concat(F.lit("f"), "p_partkey", F.lit("_pos.raw")).alias("member_path"),
                         (F.col("p_size").cast("bigint") * 1000).alias("size"), F.lit(None).cast("string").alias("crc32"))
    return matching.member_lookup(s, t["item_listing"]).select("p_partkey", "result")


@query("j23_runnable_form", "item", "item_listing", ctes=mem_cte("item_listing"), sql=f"""
SELECT unit_id, raw_file, member_path, CASE WHEN member_path IS NOT NULL THEN CASE WHEN NOT {duck.convert('member_path')} THEN member_path END
    WHEN found_key IS NOT NULL THEN CASE WHEN NOT {duck.convert('found_key')} THEN found_key END
    WHEN name_ok IS NOT NULL THEN CASE WHEN name_ok THEN name_path END WHEN stem_ok IS NOT NULL THEN CASE WHEN stem_ok THEN stem_path END
    WHEN NOT {duck.convert('raw_file')} THEN raw_file END AS runnable
FROM ({resolve_sql('item')}) WHERE reason = 'requires_conversion'""")
def j23(t: Tables):
    gone = t["item"].where("reason = 'requires_conversion'").select("unit_id", "raw_file", "member_path")
    return matching.runnable_form(gone, matching.index_members(t.stored("item_listing")))


@query("j24_dropped_for_good", "item", sql=f"""
SELECT * FROM (WITH g AS (SELECT {duck.key('member_path')} AS key, member_path, reason FROM item
    WHERE reason IN ('other', 'requires_conversion', 'no_signal_abstained') AND member_path IS NOT NULL),
  d AS (SELECT key, min((member_path, reason)) AS x FROM g WHERE key NOT IN (SELECT {duck.key('member_path')} FROM item WHERE reason IS NULL AND member_path IS NOT NULL) GROUP BY 1)
SELECT key, x[1] AS member_path, x[2] AS reason FROM d)""")
def j24(t: Tables):
    i = t["item"]
    kept = i.where("reason IS NULL AND member_path IS NOT NULL").select(names.member_key("member_path").alias("key"))
    return matching.dropped_for_good(i.where("reason IS NOT NULL AND member_path IS NOT NULL"), kept)


@query("j24_may_be_own", "item", sql=f"""
SELECT * FROM (WITH g AS (SELECT {duck.key('member_path')} AS key, min(member_path) AS member_path FROM item
    WHERE reason IN ('other', 'requires_conversion', 'no_signal_abstained') AND member_path IS NOT NULL
      AND {duck.key('member_path')} NOT IN (SELECT {duck.key('member_path')} FROM item WHERE reason IS NULL AND member_path IS NOT NULL) GROUP BY 1),
  p AS (SELECT lower(regexp_replace({duck.stem('member_path')}, '(?i)pos(?:itive)?|neg(?:ative)?|[^a-z0-9]', '', 'g')) AS loose, count(*) AS n, min(member_path) AS fp FROM g GROUP BY 1),
  w AS (SELECT DISTINCT unit_id, lower(regexp_replace({duck.stem('raw_file')}, '(?i)pos(?:itive)?|neg(?:ative)?|[^a-z0-9]', '', 'g')) AS loose FROM item WHERE reason = 'not_in_archive')
SELECT unit_id, CAST(sum(n) AS BIGINT) AS n, min(fp) AS first_path FROM w JOIN p USING (loose) GROUP BY 1)""")
def j24_own(t: Tables):
    i = t["item"]
    kept = i.where("reason IS NULL AND member_path IS NOT NULL").select(names.member_key("member_path").alias("key"))
    dropped = matching.dropped_for_good(i.where("reason IS NOT NULL AND member_path IS NOT NULL"), kept)
    return matching.may_be_own(dropped, i.where("reason = 'not_in_archive'").select("unit_id", "raw_file"))


@query("p10_not_its_arm", "item", sql=f"""
SELECT unit_id, member_path, ion_mode, chromatography, coalesce({duck.polarity('member_path')} <> ion_mode AND ion_mode IN ('positive', 'negative'), false)
    OR coalesce({duck.chromatography('member_path')} <> chromatography AND chromatography IN ('HILIC', 'RP'), false) AS other_arm
FROM item WHERE member_path IS NOT NULL""")
def p10(t: Tables):
    return t["item"].where("member_path IS NOT NULL").select("unit_id", "member_path", "ion_mode", "chromatography", matching.not_its_arm(
        "member_path", "ion_mode", "chromatography").alias("other_arm"))
