"""Invariants over the driver's tables: one side is the table, the other a copy with known differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.operators import invariants, matching
from cairnsift.queries.registry import Tables, query


def unit(column: str = "l_orderkey"):
    return F.concat(F.lit("U"), column).alias("unit_id")


@query("i1_count_agreement", sql="""
WITH c AS (SELECT l_orderkey AS k, l_returnflag AS source, count(*) AS n, false AS run_level FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2 UNION ALL SELECT o_orderkey, 'export', 1, o_orderstatus = 'O' FROM orders)
SELECT concat('U', k) AS unit_id, CASE WHEN count(*) FILTER (NOT run_level) < 2 THEN 'not_evaluable' WHEN min(n) FILTER (NOT run_level) = max(n) FILTER (NOT run_level) THEN 'pass' ELSE 'fail' END AS status, count(*) FILTER (NOT run_level) AS sources FROM c GROUP BY 1""")
def i1(t: Tables):
    lines = t["lineitem"].where("l_returnflag <> 'R'").groupBy(unit(), F.col("l_returnflag").alias("source")).agg(F.count("*").alias("n")).withColumn("run_level", F.lit(False))
    export = t["orders"].select(unit("o_orderkey"), F.lit("export").alias("source"), F.lit(1).cast("bigint").alias("n"), (F.col("o_orderstatus") == "O").alias("run_level"))
    return invariants.count_agreement(lines.unionByName(export))


@query("i2_missing_outputs", sql="SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 20)")
def i2(t: Tables):
    return invariants.missing_outputs(t["orders"], t["lineitem"].where("l_quantity > 20").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("i3_identity_agreement", sql="""
SELECT l_orderkey, count(*) AS artefacts, count(DISTINCT l_linestatus) AS "values", CASE WHEN count(*) < 2 THEN 'not_evaluable' WHEN count(DISTINCT l_linestatus) = 1 THEN 'pass' ELSE 'fail' END AS status FROM lineitem GROUP BY 1""")
def i3(t: Tables):
    return invariants.identity_agreement(t["lineitem"], "l_orderkey", "l_linestatus")


@query("i4_input_balance", sql="""
SELECT * FROM (WITH k AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem), f AS (SELECT o, p,
  EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o AND l.l_partkey = p AND l_quantity > 2) AS d, EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o AND l.l_partkey = p AND l_quantity < 48) AS f,
  EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o AND l.l_partkey = p AND l_tax > 0) AS r, EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o AND l.l_partkey = p AND l_discount = 0.1) AS x FROM k)
SELECT concat('U', o) AS unit_id, p AS key, CASE WHEN x AND r THEN 'excluded_but_runs' WHEN x THEN NULL WHEN NOT d THEN 'undeclared' WHEN NOT f THEN 'not_found' WHEN NOT r THEN 'no_row' END AS problem FROM f) WHERE problem IS NOT NULL""")
def i4(t: Tables):
    li = t["lineitem"].withColumn("unit_id", unit()).withColumn("key", F.col("l_partkey"))
    return invariants.input_balance(li.where("l_quantity > 2"), li.where("l_quantity < 48"), li.where("l_tax > 0"), li.where("l_discount = 0.1"))


@query("i5_checksum_coverage", sql="""
SELECT concat('U', l_orderkey) AS unit_id, count(*) AS inputs, count(*) FILTER (l_tax >= 0.02 AND l_quantity > 3) AS verified, count(*) FILTER (l_tax >= 0.02) AS published,
  CASE WHEN count(*) FILTER (l_tax >= 0.02) = 0 THEN 'warn' WHEN count(*) FILTER (l_tax >= 0.02 AND l_quantity > 3) = count(*) THEN 'pass' ELSE 'fail' END AS status FROM lineitem GROUP BY 1""")
def i5(t: Tables):
    ok = F.col("l_quantity") > 3
    at = lambda low, high: F.when((F.col("l_tax") >= low) & (F.col("l_tax") < high), ok)
    return invariants.checksum_coverage(t["lineitem"].select(unit(), "l_partkey", at(0.02, 0.04).alias("direct"), at(0.04, 0.06).alias("container"), at(0.06, 1.0).alias("source")))


@query("i6_w12_order_agreement", "transition", sql="""
SELECT * FROM (WITH r AS (SELECT unit_key AS unit_id, at_us // 3600000000 * 3600000000 AS t, CASE WHEN k = 3 THEN rn + 1 ELSE rn END AS o FROM (SELECT *, row_number() OVER (PARTITION BY unit_key ORDER BY seq) AS rn FROM transition)),
  p AS (SELECT *, rank() OVER (PARTITION BY unit_id ORDER BY t) AS lo, count(*) OVER (PARTITION BY unit_id ORDER BY t RANGE UNBOUNDED PRECEDING) AS hi FROM r)
SELECT unit_id, count(*) AS rows, count(*) FILTER (o < lo OR o > hi) AS out_of_place, count(*) - count(DISTINCT o) AS duplicates, max(o) - min(o) + 1 - count(DISTINCT o) AS gaps FROM p GROUP BY 1)""")
def i6(t: Tables):
    from cairnsift.scale import blocks, ordered
    run = ordered(t["transition"], ["unit_key"], ["seq"], blocks("seq", 1 << 16), row_number="rn")
    runs = run.select(F.col("unit_key").alias("unit_id"), F.col("seq").alias("id"), F.when(F.col("k") == 3, F.col("rn") + 1).otherwise(F.col("rn")).alias("order"),
                      (F.floor(F.col("at_us") / 3_600_000_000) * 3_600_000_000).alias("time"))
    return invariants.order_agreement(runs)


@query("i7_w13_synthesised_order", sql="""
SELECT * FROM (WITH b AS (SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER w AS rn, lag(o_orderstatus) OVER w AS p FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT concat('C', o_custkey) AS unit_id, count(*) AS rows, count(*) FILTER (p IS NULL OR p <> o_orderstatus) AS blocks, count(DISTINCT o_orderstatus) AS classes,
  count(*) FILTER (p IS NULL OR p <> o_orderstatus) = count(DISTINCT o_orderstatus) AS synthesised FROM b GROUP BY 1)""")
def i7(t: Tables):
    from cairnsift.scale import blocks, ordered
    run = ordered(t["orders"], ["o_custkey"], ["o_orderkey"], blocks("o_orderkey", 1 << 16), row_number="rn")
    return invariants.synthesised_order(run.select(F.concat(F.lit("C"), "o_custkey").alias("unit_id"), F.col("o_orderkey").alias("row"), F.col("rn").alias("order"), F.col("o_orderstatus").alias("class_id")))


@query("i8_class_labels", sql="""
SELECT concat('C', o_custkey) AS unit_id, concat(CASE WHEN o_orderpriority = '5-LOW' THEN 'x' ELSE 'n' END, o_orderkey) AS sample,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'uncovered' WHEN o_orderpriority = '2-HIGH' AND o_orderstatus <> 'O' THEN 'relabelled' ELSE 'equal' END AS result FROM orders
UNION ALL SELECT concat('C', o_custkey), concat('gone', o_orderkey), 'absent' FROM orders WHERE o_orderpriority = '1-URGENT'""")
def i8(t: Tables):
    o = t["orders"].withColumn("unit_id", F.concat(F.lit("C"), "o_custkey"))
    urgent, low = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "5-LOW"
    assigned = o.select("unit_id", F.concat(F.when(urgent, "gone").otherwise("n"), "o_orderkey").alias("sample_name"), F.col("o_orderstatus").alias("label"))
    executed = o.select("unit_id", F.concat(F.when(low, "x").otherwise("n"), "o_orderkey").alias("file_name"), F.concat(F.lit("d/N"), "o_orderkey", F.lit(".raw")).alias("file_path"),
                        F.when(F.col("o_orderpriority") == "2-HIGH", "O").otherwise(F.col("o_orderstatus")).alias("class_id"))
    return invariants.class_labels(assigned, executed)


@query("i9_acquisition_modes", "item", sql="""
SELECT unit_id, acquisition_mode AS key, CASE acquisition_mode WHEN 'unknown' THEN 'warn' WHEN 'DDA' THEN 'pass' WHEN 'targeted_DDA' THEN 'pass' ELSE 'fail' END AS status, count(*) AS n FROM item GROUP BY 1, 2, 3""")
def i9(t: Tables):
    i = t["item"].select("unit_id", F.col("acquisition_mode").alias("key"), F.lit("dda").alias("executed"), F.col("acquisition_mode").alias("header"))
    return invariants.acquisition_modes(i, {"TARGETED_DDA": "DDA", "FULLSCAN": "MS1"}).groupBy("unit_id", "key", "status").agg(F.count("*").alias("n"))


@query("i10_energy_sets", sql="""
SELECT * FROM (WITH d AS (SELECT DISTINCT l_orderkey, l_returnflag, CAST(l_tax * 100 AS INTEGER) AS e FROM lineitem WHERE l_quantity > 10), x AS (SELECT DISTINCT l_orderkey, l_returnflag, CAST(l_tax * 100 AS INTEGER) AS e FROM lineitem WHERE l_quantity < 40),
  b AS (SELECT coalesce(d.l_orderkey, x.l_orderkey) AS o, coalesce(d.l_returnflag, x.l_returnflag) AS k, coalesce(d.e, x.e) AS e, d.e AS de, x.e AS xe FROM d FULL JOIN x ON d.l_orderkey = x.l_orderkey AND d.l_returnflag = x.l_returnflag AND d.e = x.e)
SELECT concat('U', o) AS unit_id, k AS key, count(*) FILTER (xe IS NULL) AS missing, count(*) FILTER (de IS NULL) AS extra, count(*) FILTER (e <= 0) AS zero FROM b GROUP BY 1, 2)""")
def i10(t: Tables):
    li = t["lineitem"].select(unit(), F.col("l_returnflag").alias("key"), F.round(F.col("l_tax") * 100).cast("int").alias("energy"), "l_quantity")
    return invariants.energy_sets(li.where("l_quantity > 10"), li.where("l_quantity < 40"))


@query("w10_encoding_choice", "listing", sql="""
SELECT * FROM (WITH f AS (SELECT DISTINCT l_orderkey, replace(path, chr(92), '/') AS path, CASE WHEN l_linenumber = 3 THEN 'raw_header_unreadable' END AS un FROM listing),
  r AS (SELECT *, CASE WHEN regexp_matches(path, '(?i)\\.(raw|wiff)$') THEN 0 WHEN regexp_matches(path, '(?i)\\.cdf$') THEN 1 WHEN regexp_matches(path, '(?i)\\.mzml$') THEN 2 WHEN regexp_matches(path, '(?i)\\.mzxml$') THEN 3 END AS rk FROM f),
  g AS (SELECT *, min((rk, lower(path), path)) FILTER (un IS NULL) OVER (PARTITION BY l_orderkey) AS best FROM r WHERE rk IS NOT NULL)
SELECT l_orderkey, path, CAST(rk AS INTEGER) AS encoding_rank, CASE WHEN path = best[3] THEN 'used' WHEN un IS NOT NULL THEN un WHEN rk = best[1] THEN 'tie_lexicographic' ELSE 'lower_in_encoding_order' END AS choice FROM g)""")
def w10(t: Tables):
    f = t.stored("listing").select("l_orderkey", F.translate("path", "\\", "/").alias("path"), F.when(F.col("l_linenumber") == 3, "raw_header_unreadable").alias("unreadable")).distinct()
    return invariants.encoding_choice(f, ["l_orderkey"])


@query("i11_pairing_choices", "listing", sql="""
SELECT l_orderkey, count(*) AS files, count(DISTINCT regexp_extract(path, '([^.]*)$', 1)) AS encodings FROM listing WHERE regexp_matches(path, '(?i)\\.(raw|wiff|cdf|mzml|mzxml)$') GROUP BY 1 HAVING count(*) > 1""")
def i11(t: Tables):
    from cairnsift.functions import names
    f = t["listing"].where(names.encoding_rank("path").isNotNull())
    return f.groupBy("l_orderkey").agg(F.count("*").alias("files"), F.count_distinct(F.regexp_extract("path", "([^.]*)$", 1)).alias("encodings")).where("files > 1")


@query("i12_conversion_sources", sql="""
SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN 'no_record' WHEN o_orderpriority = '1-URGENT' THEN 'incomplete' WHEN o_totalprice > 300000 THEN 'digest_differs' ELSE 'pass' END AS result FROM orders""")
def i12(t: Tables):
    o = t["orders"]
    outputs = o.select(F.col("o_orderkey").alias("key"), F.lit("d1").alias("digest"))
    sources = o.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("key"), F.when(F.col("o_totalprice") > 300000, "d2").otherwise("d1").alias("digest"),
                                                   F.when(F.col("o_orderpriority") != "1-URGENT", "a.raw").alias("source_path"), F.lit("tool").alias("tool"))
    return invariants.conversion_sources(outputs, sources)


@query("u5_i13_partition_check", sql="""
SELECT * FROM (WITH p AS (SELECT l_orderkey AS o, l_partkey AS k, count(*) AS np FROM lineitem GROUP BY 1, 2), q AS (SELECT l_orderkey AS o, CASE WHEN l_tax = 0.03 THEN -1 ELSE l_partkey END AS k, count(*) AS nq FROM lineitem WHERE l_discount < 0.09 GROUP BY 1, 2),
  b AS (SELECT coalesce(p.o, q.o) AS o, coalesce(np, 0) AS np, coalesce(nq, 0) AS nq FROM p FULL JOIN q ON p.o = q.o AND p.k = q.k)
SELECT concat('U', o) AS unit_id, CAST(sum(greatest(np - nq, 0)) AS BIGINT) AS missing, CAST(sum(greatest(nq - np, 0)) AS BIGINT) AS extra, count(*) FILTER (nq > 1) AS repeated FROM b GROUP BY 1)""")
def u5(t: Tables):
    li = t["lineitem"]
    path = lambda c: F.concat(F.lit("A\\"), c.cast("string"), F.lit(".raw"))
    parent = li.select(unit(), path(F.col("l_partkey")).alias("path"))
    parts = li.where("l_discount < 0.09").select(unit(), F.lower(F.translate(path(F.when(F.col("l_tax") == 0.03, -1).otherwise(F.col("l_partkey"))), "\\", "/")).alias("path"))
    return invariants.partition_check(parent, parts, "unit_id", "path")


@query("i14_parameters", sql="""
SELECT concat('U', o_orderkey) AS unit_id, 'height' AS name, CASE WHEN o_orderpriority = '1-URGENT' THEN 'not_evaluable' WHEN o_orderpriority = '2-HIGH' THEN 'fail' WHEN o_orderpriority = '3-MEDIUM' THEN 'fail' ELSE 'pass' END AS status FROM orders
UNION ALL SELECT concat('U', o_orderkey), 'odd', 'warn' FROM orders WHERE o_orderstatus = 'F'""")
def i14(t: Tables):
    o, p = t["orders"], F.col("o_orderpriority")
    used = o.select(unit("o_orderkey"), F.lit("height").alias("name"), F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("value"))
    odd = o.where("o_orderstatus = 'F'").select(unit("o_orderkey"), F.lit("odd").alias("name"), F.lit("1").alias("value"))
    measured = o.where(p != "1-URGENT").select(unit("o_orderkey"), F.lit("height").alias("name"), F.when(p == "2-HIGH", "high").when(p == "3-MEDIUM", "-1").otherwise(F.col("o_custkey").cast("string")).alias("value"))
    return invariants.parameter_check(used.unionByName(odd), measured, ["height"])


@query("i15_sectioned_table", sql="""
SELECT o_orderkey, CAST(3 AS BIGINT) AS line_no, 'SME' AS prefix, CASE WHEN o_orderstatus = 'F' THEN 'no_header' ELSE 'column_count' END AS problem FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority = '5-LOW'""")
def i15(t: Tables):
    from cairnsift.sources import files
    body = F.concat(F.lit("MTD\tx\n"), F.when(F.col("o_orderstatus") == "F", "MTD\ty").otherwise("SEH\ta\tb"), F.lit("\nSME\t1\t2"), F.when(F.col("o_orderpriority") == "5-LOW", "\t3").otherwise(""))
    return invariants.sectioned_table(files.lines(t["orders"].select("o_orderkey", body.alias("text")), "o_orderkey"), "o_orderkey", {"SME": "SEH"})


@query("i16_libraries", sql="""
SELECT concat('U', o_orderkey) AS unit_id, l.name, CASE WHEN l.name = 'b' AND o_orderstatus = 'F' THEN 'missing_right' WHEN l.name = 'c' AND o_orderstatus = 'F' THEN 'missing_left' WHEN o_totalprice > 400000 AND l.name <> 'c' THEN 'changed' ELSE 'equal' END AS result
FROM orders, (VALUES ('a'), ('b'), ('c')) l(name) WHERE l.name <> 'c' OR o_orderstatus = 'F'""")
def i16(t: Tables):
    o = t["orders"]
    libs = lambda frame, ns, digest: frame.select(unit("o_orderkey"), F.explode(F.array(*[F.lit(n) for n in ns])).alias("name"), digest.alias("digest"), F.lit("acquired").alias("role"))
    approved = libs(o.where("o_orderstatus <> 'F'"), ("a", "b"), F.lit("1")).unionByName(libs(o.where("o_orderstatus = 'F'"), ("a", "c"), F.lit("1")))
    loaded = libs(o, ("a", "b"), F.when(F.col("o_totalprice") > 400000, "2").otherwise("1"))
    return invariants.library_check(loaded, approved).select("unit_id", "name", "result")


@query("i17_tier_rules", "candidate", sql="""
SELECT * FROM (WITH p AS (SELECT feature, count(*) FILTER (annotator_id = 'R' AND is_reference_matched = 1) AS a, count(*) FILTER (is_representative = 1) AS b, bool_or(annotator_id <> 'R' AND is_reference_matched = 1) AND bool_or(annotator_id = 'R' AND is_representative = 1) AS c FROM candidate GROUP BY 1)
SELECT feature, 'predicted_reference_match' AS problem FROM p WHERE a > 0 UNION ALL SELECT feature, 'several_representatives' FROM p WHERE b > 1 UNION ALL SELECT feature, 'predicted_over_acquired' FROM p WHERE c)""")
def i17(t: Tables):
    c = t["candidate"].withColumn("is_reference_matched", F.col("is_reference_matched") == 1).withColumn("is_representative", F.col("is_representative") == 1)
    return invariants.tier_rules(c, ["R"])


@query("i18_single_identity", sql="""
SELECT o_custkey, count(DISTINCT o_orderstatus) AS identities, min(o_orderstatus) AS identity, count(*) AS runs, CASE WHEN count(DISTINCT o_orderstatus) <> 1 OR min(o_orderstatus) <> 'O' THEN 'fail' ELSE 'pass' END AS status FROM orders GROUP BY 1""")
def i18(t: Tables):
    return invariants.single_identity(t["orders"], "o_custkey", "o_orderstatus", F.lit("O"))


@query("i19_terminal", "payload", sql="""
SELECT unit_id, 'RET-1' AS check_id, 'not_terminal' AS problem FROM payload WHERE status NOT IN ('ready', 'excluded') UNION ALL SELECT unit_id, 'FIN-1', CASE WHEN ion_mode = 'both' THEN 'no_authority' ELSE 'no_reason' END FROM payload WHERE ion_mode IN ('both', 'unknown')""")
def i19(t: Tables):
    p = t["payload"]
    deletions = p.select("unit_id", F.when(F.col("ion_mode") == "both", " ").otherwise("a1").alias("approval_id"), F.when(F.col("ion_mode") != "unknown", "done").alias("reason"))
    return invariants.terminal_and_deletion(p.select("unit_id", F.col("status").alias("state")), deletions, ["ready", "excluded"])


@query("i21_stated_counts", sql="""
SELECT o_custkey, CASE WHEN count(*) % 2 = 0 THEN count(*) + 1 ELSE count(*) + 2 END AS stated, count(*) AS counted FROM orders GROUP BY 1 HAVING min(o_orderstatus) = 'F'""")
def i21(t: Tables):
    o = t["orders"]
    n = F.count("*")
    stated = o.groupBy("o_custkey").agg(F.when(F.min("o_orderstatus") != "F", n).when(n % 2 == 0, n + 1).otherwise(n + 2).alias("n"))
    return invariants.stated_counts(stated, o, "o_custkey")


@query("i23_disk_once", sql="""
SELECT l_returnflag AS store, CAST(sum(s) AS BIGINT) AS occupied, CAST(sum(s * n) AS BIGINT) AS linked, count(*) AS objects FROM (SELECT l_returnflag, l_partkey, max(CAST(l_quantity AS BIGINT)) AS s, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def i23(t: Tables):
    return invariants.disk_once(t["lineitem"].select(F.col("l_returnflag").alias("store"), F.col("l_orderkey").alias("unit_id"), F.col("l_partkey").alias("object_id"), F.col("l_quantity").cast("bigint").alias("size")))


@query("i24_progress", sql="""
SELECT * FROM (WITH k AS (SELECT l_orderkey, bool_or(l_linenumber = 1) AS a, bool_or(l_linenumber = 2) AS b, bool_or(l_linenumber = 3) AS c, bool_or(l_linenumber = 4) AS d FROM lineitem GROUP BY 1)
SELECT concat('U', l_orderkey) AS unit_id, CASE WHEN d THEN 'run' WHEN b AND c THEN 'preflight' WHEN a THEN 'download' ELSE 'none' END AS stage,
  array_to_string(list_filter([CASE WHEN NOT a AND (d OR (b AND c)) THEN 'download' END, CASE WHEN NOT (b AND c) AND d THEN 'preflight' END], lambda x: x IS NOT NULL), ',') AS gaps FROM k)""")
def i24(t: Tables):
    kinds = t["lineitem"].select(unit(), F.concat(F.lit("k"), "l_linenumber").alias("kind"))
    return invariants.progress(kinds, [("download", ["k1"]), ("preflight", ["k2", "k3"]), ("run", ["k4"])])


def replays(t: Tables):
    o = t["orders"]
    rec = o.where("o_orderstatus <> 'F'").select(unit("o_orderkey"), F.explode(F.array(F.lit("members"), F.lit("inputs"))).alias("check_id"), F.col("o_orderpriority").alias("value"))
    rep = o.where("o_orderpriority <> '1-URGENT'").select(unit("o_orderkey"), F.lit("members").alias("check_id"), F.when(F.col("o_totalprice") > 250000, "x").otherwise(F.col("o_orderpriority")).alias("value"))
    return invariants.replay_compare(rec, rep)


REPLAY = """rp AS (SELECT concat('U', o_orderkey) AS unit_id, c.check_id, CASE WHEN c.check_id = 'inputs' OR o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' THEN 'not_evaluable' WHEN o_totalprice > 250000 THEN 'different' ELSE 'equal' END AS result,
  CASE WHEN o_orderstatus = 'F' THEN 'nothing recorded' WHEN c.check_id = 'inputs' OR o_orderpriority = '1-URGENT' THEN 'not recomputed' END AS why
  FROM orders, (VALUES ('members'), ('inputs')) c(check_id) WHERE (o_orderstatus <> 'F') OR (c.check_id = 'members' AND o_orderpriority <> '1-URGENT'))"""


@query("j13_replay_compare", ctes=REPLAY, sql="SELECT * FROM rp")
def j13(t: Tables):
    return replays(t)


@query("j13_replay_result", ctes=REPLAY, sql="SELECT unit_id, CASE WHEN bool_or(result = 'different') THEN 'different' WHEN bool_or(result = 'not_evaluable') THEN 'not_evaluable' ELSE 'equal' END AS result FROM rp GROUP BY 1")
def j13_result(t: Tables):
    return invariants.replay_result(replays(t))


@query("j15_pin_differences", sql="""
SELECT CAST(p_partkey AS VARCHAR) AS pin, 'version' AS field, CASE WHEN p_size > 45 THEN 'missing' ELSE 'changed' END AS change FROM part WHERE p_type <> 'PROMO' AND (p_size > 45 OR p_size < 3)""")
def j15(t: Tables):
    p = t["part"].withColumn("pin", F.col("p_partkey").cast("string")).withColumn("field", F.lit("version"))
    recorded = p.select("pin", "field", F.when(F.col("p_type") != "PROMO", F.col("p_name")).alias("value"))
    return invariants.pin_differences(recorded, p.where("p_size <= 45").select("pin", "field", F.when(F.col("p_size") < 3, "x").otherwise(F.col("p_name")).alias("value")))


@query("j20_release_digests", "doc", sql="""
SELECT path, CASE WHEN lang = 'de' THEN 'missing' WHEN n_chars % 2 = 0 THEN 'digest_differs' ELSE 'ok' END AS result, CASE WHEN lang <> 'de' AND n_chars % 2 <> 0 THEN digest END AS stands_for FROM doc""")
def j20(t: Tables):
    d = t["doc"]
    index = d.select("path", F.col("digest").alias("original_sha256"), F.sha2(F.concat("text", F.lit("!")), 256).alias("release_sha256"))
    return invariants.release_digests(index, d.where("lang <> 'de'").select("path", F.sha2(F.when(F.col("n_chars") % 2 == 0, F.col("text")).otherwise(F.concat("text", F.lit("!"))), 256).alias("sha256")))


@query("j21_bound_inputs", "item", sql="""
SELECT unit_id AS record_id, CASE WHEN bool_or(role = 'blank' AND basis = 'declared') THEN 'other_payload' ELSE min_by(CASE WHEN confidence = 'low' THEN 'input_missing' ELSE 'input_differs' END, row_index) FILTER (confidence = 'low' OR chromatography = 'unknown') END AS problem
FROM (SELECT unit_id, row_index, min(confidence) AS confidence, min(chromatography) AS chromatography, min(role) AS role, min(basis) AS basis FROM item WHERE row_index IS NOT NULL GROUP BY 1, 2) GROUP BY 1""")
def j21(t: Tables):
    """Records and files share the index of an item; the low-confidence ones have no file, the unknown ones another digest."""
    i = t["item"].where("row_index IS NOT NULL").groupBy("unit_id", "row_index").agg(*[F.min(c).alias(c) for c in ("confidence", "chromatography", "role", "basis")])
    path = F.concat_ws("/", "unit_id", F.col("row_index").cast("string"))
    records = i.select(F.col("unit_id").alias("record_id"), (~((F.col("role") == "blank") & (F.col("basis") == "declared"))).alias("payload_ok"), F.col("row_index").alias("position"), path.alias("path"), F.lit("1").alias("sha256"))
    files = i.where("confidence <> 'low'").select(path.alias("path"), F.when(F.col("chromatography") == "unknown", "2").otherwise("1").alias("sha256"))
    return invariants.bound_inputs(records, files)


@query("j22_class_binding", sql="""
SELECT concat('U', o_orderkey) AS unit_id, array_to_string(list_filter([CASE WHEN o_orderstatus = 'F' THEN 'not_accepted' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'not_ratified' END, CASE WHEN o_totalprice > 400000 THEN 'other_unit' END,
  CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN 'not_the_approved' END], lambda x: x IS NOT NULL), ',') AS problems FROM orders""")
def j22(t: Tables):
    o = t["orders"]
    handoffs = o.select(unit("o_orderkey"), F.col("o_custkey").cast("string").alias("proposal_id"), (F.col("o_orderstatus") != "F").alias("accepted"), (F.col("o_orderpriority") != "1-URGENT").alias("ratified"),
                        F.when(F.col("o_totalprice") > 400000, "other").otherwise(F.concat(F.lit("U"), "o_orderkey")).alias("proposal_unit"))
    approvals = o.where("o_orderstatus <> 'P'").select(unit("o_orderkey"), F.when(F.col("o_orderpriority") == "5-LOW", "x").otherwise(F.col("o_custkey").cast("string")).alias("approved_id"))
    return invariants.class_binding(handoffs, approvals)


@query("j26_companion_check", sql="""
SELECT * FROM (WITH s AS (SELECT l_orderkey, l_suppkey, bool_or(l_returnflag = 'A') AS c, bool_or(l_returnflag = 'N') AS s, bool_or(l_returnflag = 'R' OR l_linestatus = 'O') AS m FROM lineitem GROUP BY 1, 2)
SELECT concat('U', l_orderkey) AS unit_id, count(*) AS containers, count(*) FILTER (s AND m) AS complete, bool_and(s AND m) AS switchable FROM s WHERE c GROUP BY 1)""")
def j26(t: Tables):
    li = t["lineitem"]
    ends = F.explode(F.array_compact(F.array(F.when(F.col("l_returnflag") == "A", F.lit(".wiff2")), F.when(F.col("l_returnflag") == "N", F.lit(".wiff")),
                                             F.when((F.col("l_returnflag") == "R") | (F.col("l_linestatus") == "O"), F.lit(".wiff.scan")))))
    files = li.select(unit(), "l_suppkey", ends.alias("e")).select("unit_id", F.concat(F.lit("r/S"), "l_suppkey", "e").alias("path"))
    return invariants.companion_check(files, ".wiff2", ".wiff", ".wiff.scan")


@query("u4_units_both_ways", sql="""
SELECT 'untriaged' AS side, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30) UNION ALL SELECT 'unknown', count(DISTINCT l_orderkey + 100) FROM lineitem WHERE l_quantity > 30 AND l_orderkey + 100 NOT IN (SELECT o_orderkey FROM orders)""")
def u4(t: Tables):
    """Catalog units without a document, and documents without a catalog unit."""
    units = t["orders"].select(F.col("o_orderkey").alias("k"))
    docs = t["lineitem"].where("l_quantity > 30").select(F.col("l_orderkey").alias("k"))
    a = invariants.missing_outputs(units, docs, ["k"]).agg(F.count("*").alias("n")).select(F.lit("untriaged").alias("side"), "n")
    b = invariants.missing_outputs(docs.select((F.col("k") + 100).alias("k")), units, ["k"]).agg(F.count("*").alias("n")).select(F.lit("unknown").alias("side"), "n")
    return a.unionByName(b)


@query("u2_common_attributes", sql="SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'O' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'")
def u2(t: Tables):
    """What two units of a study have in common."""
    li = t["lineitem"]
    return li.where("l_returnflag = 'A' AND l_linestatus = 'O'").select("l_partkey").intersect(li.where("l_returnflag = 'R' AND l_linestatus = 'F'").select("l_partkey"))


@query("t_split", "payload", "item", sql="""
SELECT p.unit_id, i.row_index, CASE WHEN p.chromatography = 'HILIC' THEN 'changed' ELSE 'equal' END AS result FROM (SELECT DISTINCT unit_id, row_index FROM item WHERE reason = 'polarity_switching' AND row_index IS NOT NULL) i JOIN payload p USING (unit_id)""")
def t_split(t: Tables):
    """A child's moved rows against what the parent derives."""
    moved = t["item"].where("reason = 'polarity_switching' AND row_index IS NOT NULL").select("unit_id", "row_index").distinct().join(t["payload"].select("unit_id", "chromatography"), "unit_id")
    derived = moved.select("unit_id", "row_index", F.lit("switching").alias("ion_mode"))
    child = moved.select("unit_id", "row_index", F.when(F.col("chromatography") == "HILIC", "positive").otherwise("switching").alias("ion_mode"))
    return matching.reconcile(derived, child, ["unit_id", "row_index"], ["ion_mode"]).select("unit_id", "row_index", "result")
