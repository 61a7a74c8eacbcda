"""End-to-end plans over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.operators import checks, matching
from cairnsift.plans import accession, campaign
from cairnsift.queries import duck
from cairnsift.queries.ledger import STREAK
from cairnsift.queries.planning import GROUPS, POOLED, mobility
from cairnsift.queries.registry import Dialect, Tables, query, shape


@shape("own_listing")
def own_listing(d: Dialect) -> str:
    """Each accession's own archive: what its orders' items were read from, some in another encoding."""
    return f"""
SELECT concat('A', {d.text('o_custkey')}) AS accession, concat('A', {d.text('o_custkey')}, '.zip') AS archive,
       concat('run', {d.text('l_suppkey')}, '/f', {d.text('l_partkey')}, CASE WHEN l_quantity > 25 THEN '_pos' WHEN l_quantity > 10 THEN '_neg_C18_DIA' ELSE '' END,
              CASE WHEN l_tax = 0.03 AND l_returnflag = 'N' THEN '.zip' WHEN l_discount = 0.05 THEN '.mzML' WHEN l_linestatus = 'O' THEN '.raw' ELSE '.mzXML' END) AS path,
       cast(l_quantity AS bigint) * 1000 AS size, upper(lpad(hex(cast(l_quantity AS bigint)), 8, '0')) AS crc32
FROM {d.table('lineitem')} JOIN {d.table('orders')} ON l_orderkey = o_orderkey WHERE l_quantity < 50 OR l_discount > 0.01"""


# The operator's joins with the accession in every key.
ARCHIVE = f"""om AS (SELECT accession, {duck.key('path')} AS member_key, regexp_extract({duck.key('path')}, '([^/]*)$', 1) AS name, lower({duck.stem(duck.key('path'))}) AS stem, bool_and({duck.convert('path')}) AS converts
  FROM own_listing WHERE {duck.rawlike('path')} GROUP BY ALL),
onm AS (SELECT accession, name, count(*) AS n, min(member_key) AS k FROM om GROUP BY ALL),
ost AS (SELECT accession, stem, count(*) AS n, min(member_key) AS k, count(*) FILTER (NOT converts) AS dn, min(member_key) FILTER (NOT converts) AS dk FROM om GROUP BY ALL),
oi AS (SELECT i.*, p.accession, {duck.key('i.raw_file')} AS own FROM item i JOIN payload p USING (unit_id)),
ok AS (SELECT i.accession, i.unit_id, i.reason, CASE WHEN member_path IS NOT NULL THEN {duck.key('member_path')} WHEN (i.accession, own) IN (SELECT (accession, member_key) FROM om) THEN own
    WHEN onm.n = 1 THEN onm.k WHEN ost.n = 1 THEN ost.k WHEN ost.n > 1 AND ost.dn = 1 THEN ost.dk END AS key, concat('raw:', lower({duck.stem('raw_file')})) AS loose
  FROM oi i LEFT JOIN onm ON i.accession = onm.accession AND lower({duck.base('raw_file')}) = onm.name LEFT JOIN ost ON i.accession = ost.accession AND lower({duck.stem('raw_file')}) = ost.stem),
og AS (SELECT accession, {duck.key('path')} AS member_key, concat(crc32, ':', size) AS gid FROM own_listing WHERE {duck.rawlike('path')} AND size >= 1024 GROUP BY ALL),
od AS (SELECT DISTINCT accession, member_key FROM (SELECT *, count(*) OVER (PARTITION BY accession, gid) AS n FROM og) WHERE n > 1),
af AS (SELECT om.accession, 'T-MEMBER' AS check_id, 'hold' AS severity, CAST(NULL AS VARCHAR) AS unit_id, member_key AS subject, 'loose_member' AS message FROM om
    WHERE (om.accession, member_key) NOT IN (SELECT (accession, {duck.key('member_path')}) FROM oi WHERE member_path IS NOT NULL) AND (om.accession, name) NOT IN (SELECT (accession, lower(raw_file)) FROM oi WHERE member_path IS NULL)
  UNION ALL SELECT DISTINCT accession, 'T-DUP', 'error', unit_id, key, 'byte_identical' FROM ok WHERE reason IS NULL AND (accession, key) IN (SELECT (accession, member_key) FROM od)
  UNION ALL SELECT DISTINCT accession, 'T-MEMBER', 'hold', unit_id, loose, 'unresolved' FROM ok WHERE reason IS NULL AND key IS NULL)"""


@query("e1_archive_findings", "item", "own_listing", "payload", ctes=ARCHIVE, sql="SELECT * FROM af")
def e1_findings(t: Tables):
    return accession.archive_findings(t.stored("own_listing"), t["item"].join(t["payload"].select("unit_id", "accession"), "unit_id"))


@query("e1_accession_verdict", "item", "own_listing", "payload", ctes=ARCHIVE, sql="""
SELECT accession, unit_id, CASE WHEN errors > 0 THEN 'error' WHEN holds > 0 THEN 'hold' ELSE 'pass' END AS verdict, errors, holds FROM (
  SELECT p.accession, p.unit_id, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'hold') AS holds FROM payload p LEFT JOIN af a USING (unit_id) GROUP BY ALL
  UNION ALL SELECT p.accession, NULL, count(*) FILTER (severity = 'error'), count(*) FILTER (severity = 'hold') FROM (SELECT DISTINCT accession FROM payload) p LEFT JOIN af a USING (accession) GROUP BY ALL)""")
def e1(t: Tables):
    return accession.accession_verdict(t.stored("own_listing"), t["item"], t["payload"])


@query("t_excl_unopened", "item", "own_listing", "payload", ctes=ARCHIVE + f""",
na AS (SELECT DISTINCT accession, {duck.norm('path')} AS path FROM own_listing WHERE path LIKE '%.zip'),
nn AS (SELECT accession, count(*) AS n, array_to_string(list_sort(list(path))[1:3], ', ') AS first FROM na GROUP BY 1),
gn AS (SELECT i.accession, i.unit_id, count(*) AS rows FROM oi i LEFT JOIN onm ON i.accession = onm.accession AND lower({duck.base('raw_file')}) = onm.name
  LEFT JOIN ost ON i.accession = ost.accession AND lower({duck.stem('raw_file')}) = ost.stem WHERE reason = 'not_in_archive' AND CASE WHEN member_path IS NOT NULL
    THEN (i.accession, {duck.key('member_path')}) NOT IN (SELECT (accession, member_key) FROM om) ELSE (i.accession, own) NOT IN (SELECT (accession, member_key) FROM om) AND onm.n IS NULL AND ost.n IS NULL END GROUP BY ALL)""", sql="""
SELECT 'T-EXCL' AS check_id, 'hold' AS severity, unit_id, CAST(rows AS VARCHAR) AS subject, concat('unopened_archives: ', n, ' (', first, ')') AS message FROM gn JOIN nn USING (accession)""")
def t_unopened(t: Tables):
    listing = t.stored("own_listing")
    members = matching.index_members(listing, scope=accession.SCOPE)
    keyed = matching.item_keys(t.stored("item").join(t["payload"].select("unit_id", "accession"), "unit_id"), members, accession.SCOPE)
    return checks.t_unopened(keyed, members, listing)


@query("e1_listing_summary", "member", sql=f"SELECT archive, count(*) AS members, CAST(sum(size) AS BIGINT) AS bytes, count(*) FILTER ({duck.rawlike('path')}) AS raw_like FROM member GROUP BY 1")
def e1_summary(t: Tables):
    return accession.listing_summary(t["member"])


E2 = POOLED + """,
mb AS (SELECT u.unit_id, u.instrument LIKE '%tims%' OR s.n IS NOT NULL AS sg, coalesce(b.b, false) AS bs FROM unit u LEFT JOIN (SELECT unit_id, count(*) AS n FROM raw_file WHERE l_quantity = 50 GROUP BY 1) s USING (unit_id)
  LEFT JOIN (SELECT unit_id, bool_or(l_quantity < 4) AS b FROM raw_file GROUP BY 1) b USING (unit_id)),
jd AS (SELECT p.*, CASE WHEN file_count = 0 THEN 'no_files' WHEN sg AND NOT bs THEN 'ion_mobility' WHEN analysis_files > 0 AND mzdata_files = analysis_files THEN 'mzdata_only' END AS reason FROM pooled p JOIN mb USING (unit_id)),
kept_file AS (SELECT * FROM raw_file WHERE unit_id IN (SELECT unit_id FROM jd WHERE reason IS NULL)),
""" + GROUPS.split("multi AS")[0].replace("FROM raw_file WHERE download_url", "FROM kept_file WHERE download_url").rstrip().rstrip(",") + """,
dc AS (SELECT jd.unit_id, jd.pool, CASE WHEN uo.unit_id IS NULL THEN 'no_download_object' WHEN analysis_files > 0 AND only_archives AND unknown_size_objects = 0 AND known_bytes < analysis_files * 50000 THEN 'archive_too_small_for_raw_data' END AS late
  FROM jd LEFT JOIN uo USING (unit_id) WHERE reason IS NULL)"""


def campaign_plan(t: Tables):
    readings = mobility(t).select("unit_id", F.col("excluded").alias("ion_mobility"), F.lit(False).alias("fragmentation"), F.lit(None).cast("string").alias("workspace_reason"))
    return campaign.plan(t["unit"], t["raw_file"], readings, ["declared", "acquisition_unknown"])


@query("e2_plan_excluded", "unit", "raw_file", ctes=E2, sql="SELECT unit_id, pool, reason FROM jd WHERE reason IS NOT NULL UNION ALL SELECT unit_id, pool, late FROM dc WHERE late IS NOT NULL")
def e2_excluded(t: Tables):
    return campaign_plan(t)[1]


@query("e2_plan_units", "unit", "raw_file", ctes=E2, sql="SELECT unit_id, pool, row_number() OVER (ORDER BY unit_id) - 1 AS by_id FROM dc WHERE late IS NULL")
def e2_units(t: Tables):
    """The planned units; their order is checked against the ledger's in ``w9_plan_order``."""
    from cairnsift.scale import global_rank
    ordered = campaign_plan(t)[0].select("unit_id", "pool")
    return global_rank(ordered, ["unit_id"], "by_id")


@query("e3_report", "transition", "attempt", ctes=STREAK, sql="""
SELECT * FROM (WITH c AS (SELECT *, count(*) FILTER (outcome = 'failed') OVER w AS f, count(*) FILTER (outcome = 'interrupted') OVER w AS i FROM attempt WINDOW w AS (PARTITION BY unit_key ORDER BY attempt_id)),
  d AS (SELECT unit_key, max(f + greatest(0, i - 5)) AS failures, bool_or(f + greatest(0, i - 5) >= 3) AS terminal FROM c WHERE outcome = 'failed' OR (outcome = 'interrupted' AND i > 5) GROUP BY 1),
  s AS (SELECT unit_key, max_by(to_state, seq) AS state, count(*) AS transitions FROM transition GROUP BY 1)
SELECT s.unit_key, state, transitions, coalesce(failures, 0) AS failures, coalesce(terminal, false) AS terminal FROM s LEFT JOIN d USING (unit_key))""")
def e3(t: Tables):
    return campaign.report(t["transition"], t["attempt"]).select("unit_key", "state", "transitions", "failures", "terminal")
