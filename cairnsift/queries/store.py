"""Object-store checks: parts as objects, suppliers' lines as claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.operators import store
from cairnsift.queries.registry import Dialect, Tables, query, shape
from cairnsift.sources import records


@shape("s_object")
def s_object(d: Dialect) -> str:
    return f"""
SELECT concat('o', {d.text('p_partkey')}) AS object_id, p_size <> 1 AS has_record, p_size <> 2 AS record_ok,
       CASE WHEN p_type = 'PROMO' THEN 'collected' WHEN p_type = 'SMALL' THEN 'collection_incomplete' ELSE 'ready' END AS state, p_size <> 5 AS has_bytes, p_size <> 7 AS file_present,
       CASE WHEN p_size = 8 THEN NULL WHEN p_size = 9 THEN 3 ELSE 0 END AS changed_members, CASE WHEN p_size < 10 THEN NULL ELSE 'a1' END AS approval_id, CASE WHEN p_size < 20 THEN '4' ELSE '5' END AS boundary, p_partkey, p_size
FROM {d.table('part')}"""


@shape("s_claim")
def s_claim(d: Dialect) -> str:
    return f"""
SELECT concat('k', {d.text('l_partkey')}) AS url_key, concat('U', {d.text('l_orderkey + CASE WHEN l_tax = 0 THEN 1000000 ELSE 0 END')}) AS unit_id,
       CASE WHEN l_quantity > 12 THEN 'released' WHEN l_returnflag = 'A' THEN 'materialized' WHEN l_returnflag = 'N' THEN 'pending' ELSE 'released' END AS state,
       CASE WHEN l_linestatus = 'O' THEN NULL WHEN l_discount >= 0.1 THEN 'gone' ELSE concat('o', {d.text('l_partkey')}) END AS object_id, {d.us('l_shipdate')} AS opened_us
FROM {d.table('lineitem')}"""


@shape("s_index")
def s_index(d: Dialect) -> str:
    return f"""
SELECT concat('k', {d.text('p_partkey')}) AS url_key, CASE WHEN p_size > 48 THEN concat('x', {d.text('p_partkey')}) ELSE concat('o', {d.text('p_partkey')}) END AS object_id FROM {d.table('part')} WHERE p_size > 3"""


@shape("s_unit")
def s_unit(d: Dialect) -> str:
    return f"""
SELECT concat('U', {d.text('o_orderkey')}) AS unit_id, CASE WHEN o_orderstatus = 'F' THEN {d.us('o_orderdate')} END AS released_us FROM {d.table('orders')}"""


OBJ = """oc AS (SELECT o.object_id, count(*) FILTER (c.state IN ('materialized', 'pending') AND (c.object_id = o.object_id OR (c.object_id IS NULL AND i.object_id = o.object_id))) AS live,
    count(*) FILTER (c.object_id IS NULL OR c.object_id = o.object_id) AS releasing FROM s_object o JOIN s_claim c ON c.url_key = concat('k', o.p_partkey) LEFT JOIN s_index i ON i.url_key = c.url_key GROUP BY 1),
ox AS (SELECT o.*, coalesce(live, 0) AS live, coalesce(releasing, 0) AS releasing, o.object_id IN (SELECT object_id FROM s_index) OR o.object_id IN (SELECT object_id FROM s_claim WHERE object_id IS NOT NULL) AS reached FROM s_object o LEFT JOIN oc USING (object_id)),
oy AS (SELECT *, has_record AND record_ok AND state <> 'collected' AS open_, has_record AND record_ok AND state <> 'collected' AND NOT (has_bytes AND NOT reached) AS settled FROM ox)"""
OBJECT_SQL = " UNION ALL ".join(f"SELECT '{k}' AS kind, '{s}' AS severity, object_id AS subject FROM oy WHERE {r}" for k, s, r in (
    ("orphan_object", "fail", "(NOT has_record AND has_bytes) OR (has_record AND NOT record_ok) OR (open_ AND has_bytes AND NOT reached)"), ("incomplete_object", "warn", "NOT has_record AND NOT has_bytes"),
    ("tombstone_with_bytes", "fail", "has_record AND record_ok AND state = 'collected' AND has_bytes"), ("tombstone_without_approval", "fail", "has_record AND record_ok AND state = 'collected' AND (approval_id IS NULL OR boundary <> '5')"),
    ("collection_incomplete", "warn", "open_ AND state = 'collection_incomplete'"), ("no_releasing_unit", "fail", "settled AND has_bytes AND live = 0 AND releasing = 0"),
    ("object_file_missing", "warn", "settled AND state = 'ready' AND NOT file_present"), ("unreadable_members", "warn", "settled AND state = 'ready' AND changed_members IS NULL"), ("modified_in_place", "warn", "settled AND state = 'ready' AND changed_members > 0")))


def object_found(t: Tables):
    o = t["s_object"]
    urls = o.select("object_id", F.concat(F.lit("k"), "p_partkey").alias("url_key"))
    return store.object_findings(o, urls, t["s_index"], t["s_claim"])


@query("j16_claim_liveness", "s_object", "s_claim", "s_index", ctes=OBJ, sql="SELECT * FROM oc")
def j16(t: Tables):
    urls = t["s_object"].select("object_id", F.concat(F.lit("k"), "p_partkey").alias("url_key"))
    return store.object_claims(urls, t["s_index"], t["s_claim"])


@query("store_objects", "s_object", "s_claim", "s_index", ctes=OBJ, sql=OBJECT_SQL)
def store_objects(t: Tables):
    return object_found(t)


CLAIMS_SQL = """SELECT CASE WHEN u.unit_id IS NULL THEN CASE WHEN state = 'materialized' THEN 'live_claim_without_unit' ELSE 'pre_claimed' END WHEN opened_us > released_us THEN 'claimed_after_release' ELSE 'live_claim_on_terminal_unit' END AS kind,
  CASE WHEN u.unit_id IS NULL THEN CASE WHEN state = 'materialized' THEN 'warn' ELSE 'info' END WHEN opened_us > released_us THEN 'info' ELSE 'fail' END AS severity, concat(url_key, '/', c.unit_id) AS subject
FROM s_claim c LEFT JOIN s_unit u USING (unit_id) WHERE state <> 'released' AND (u.unit_id IS NULL OR released_us IS NOT NULL)
UNION ALL SELECT 'dangling_claim', 'warn', concat(url_key, '/', unit_id) FROM s_claim WHERE state <> 'released' AND object_id = 'gone'
UNION ALL SELECT 'dangling_index', 'warn', url_key FROM s_index WHERE object_id LIKE 'x%'"""


@query("store_claims", "s_claim", "s_index", "s_unit", sql=CLAIMS_SQL)
def store_claims(t: Tables):
    return store.claim_findings(t["s_claim"], t["s_object"], t["s_index"], t["s_unit"])


@query("store_leftovers", "s_claim", "s_object", sql="""
SELECT 'abandoned_partial' AS kind, 'warn' AS severity, concat('k', p_partkey) AS subject FROM s_object WHERE concat('k', p_partkey) NOT IN (SELECT url_key FROM s_claim WHERE state <> 'released')
UNION ALL SELECT 'stale_lock', 'warn', concat('o-', object_id) FROM s_object WHERE p_size * 20 > 600""")
def store_leftovers(t: Tables):
    o = t["s_object"]
    locks = o.select(F.concat(F.lit("o-"), "object_id").alias("name"), (F.col("p_size") * 20).alias("age_s"))
    return store.leftovers(o.select(F.concat(F.lit("k"), "p_partkey").alias("url_key")), t["s_claim"], locks)


@query("store_busy", "s_object", "s_claim", "s_index", ctes=OBJ, sql=f"""
SELECT severity, kind, count(*) AS n FROM (SELECT CASE WHEN p_size * 20 <= 600 THEN 'object_busy' ELSE kind END AS kind, CASE WHEN p_size * 20 <= 600 THEN 'info' ELSE severity END AS severity FROM ({OBJECT_SQL}) f JOIN s_object o ON f.subject = o.object_id) GROUP BY 1, 2""")
def store_busy(t: Tables):
    locks = t["s_object"].select(F.concat(F.lit("o-"), "object_id").alias("name"), (F.col("p_size") * 20).alias("age_s"))
    return store.store_verdict(store.hold_while_busy(object_found(t), locks))


@query("s13_read_store", sql="SELECT concat('o', p_partkey) AS object_id, p_type AS state, concat('k', p_partkey) AS url_key, 'a1' AS approval_id FROM part")
def s13(t: Tables):
    """Object records as the JSON texts the store keeps, read with the store's schema."""
    p = t["part"]
    doc = F.to_json(F.struct(F.concat(F.lit("o"), "p_partkey").alias("object_id"), F.col("p_type").alias("state"), F.array(F.struct(F.concat(F.lit("k"), "p_partkey").alias("url_key"))).alias("urls"),
                             F.struct(F.lit("a1").alias("approval_id"), F.lit("5").alias("boundary")).alias("collected_under")))
    return p.select(F.from_json(doc, records.STORE["objects"]).alias("r")).select("r.object_id", "r.state", F.col("r.urls")[0]["url_key"].alias("url_key"), F.col("r.collected_under.approval_id").alias("approval_id"))


# Manifests of the objects: a line per line item of the part; some lines are broken, some files gone or changed.
@shape("s_member")
def s_member(d: Dialect) -> str:
    return f"""
SELECT concat('o', {d.text('l_partkey')}) AS object_id, concat('d', {d.text('l_orderkey')}, '/m', {d.text('l_suppkey')}, '_', {d.text('cast(floor(l_extendedprice * 100 + 0.5) AS bigint)')}) AS path, l_partkey,
       cast(max(l_quantity) AS bigint) * 10 AS size, max({d.us('l_shipdate')}) * 1000 AS mtime_ns, cast(floor(max(l_tax) * 100 + 0.5) AS int) AS tax, cast(floor(max(l_discount) * 100 + 0.5) AS int) AS discount
FROM {d.table('lineitem')} GROUP BY l_partkey, l_orderkey, l_suppkey, l_extendedprice"""


MEMBER_CTES = """mp AS (SELECT *, CASE WHEN tax = 8 AND discount = 0 THEN 'missing' WHEN tax = 7 AND discount = 1 THEN 'size' WHEN tax = 6 AND discount = 2 THEN 'time' END AS problem FROM s_member),
mb AS (SELECT DISTINCT object_id FROM s_member WHERE l_partkey % 10 = 0 AND tax = 0 AND discount = 10)"""


def member_tables(t: Tables):
    from cairnsift.sources import records
    m = t.stored("s_member")
    odd = (F.col("l_partkey") % 10 == 0) & (F.col("tax") == 0) & (F.col("discount") == 10)
    line = F.concat_ws("\t", "path", F.when(odd, "?").otherwise(F.col("size").cast("string")), F.lit("0A"), F.col("mtime_ns").cast("string"))
    heads = m.select("object_id", F.lit(1).alias("line_no"), F.lit(records.MEMBERS_HEADER).alias("text")).distinct()
    manifest = records.manifest_rows(heads.union(m.select("object_id", F.lit(2), line)))
    is_ = lambda tax, discount: (F.col("tax") == tax) & (F.col("discount") == discount)
    found = m.where(~is_(8, 0)).select("object_id", "path", F.when(is_(7, 1), F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(is_(6, 2), F.col("mtime_ns") + 5_000_000).otherwise(F.col("mtime_ns") + 5).alias("mtime_ns"))
    extra = m.where("l_partkey % 7 = 0").select("object_id", F.lit("extra/file").alias("path"), F.lit(1).cast("bigint").alias("size"), F.lit(0).cast("bigint").alias("mtime_ns")).distinct()
    return manifest, found.union(extra)


@query("store_member_changes", "s_member", ctes=MEMBER_CTES, sql="SELECT object_id, path, problem FROM mp WHERE problem IS NOT NULL AND NOT (l_partkey % 10 = 0 AND tax = 0 AND discount = 10)")
def store_member_changes(t: Tables):
    manifest, found = member_tables(t)
    return store.member_changes(manifest.where("NOT bad"), found)


@query("store_changed_members", "s_object", "s_member", ctes=MEMBER_CTES, sql="""
SELECT object_id, CASE WHEN object_id NOT IN (SELECT object_id FROM mb) THEN coalesce(n, 0) END AS changed_members FROM s_object LEFT JOIN (SELECT object_id, count(*) AS n FROM mp WHERE problem IS NOT NULL GROUP BY 1) USING (object_id)""")
def store_changed_members(t: Tables):
    manifest, found = member_tables(t)
    return store.changed_members(t["s_object"].select("object_id"), manifest, found)
