"""Sources and sinks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.functions import text
from cairnsift.queries import duck
from cairnsift.queries.registry import Tables, query
from cairnsift.sources import files, records


@query("s1_read_listing", "listing", sql=f"""
SELECT archive, {duck.norm('path')} AS path, size, upper(crc32) AS crc32 FROM listing WHERE type IN ('file', '')""")
def s1(t: Tables):
    return files.clean_listing(t["listing"].select("archive", F.col("path").alias("Path"), "size", F.col("crc32").alias("CRC32"), "type"))


@query("s2_listing_index", "listing", sql=f"""
SELECT lower({duck.norm('path')}) AS path_key, min_by(archive, (l_orderkey, l_linenumber, archive, size, crc32)) AS archive,
       lpad(upper(min_by(crc32, (l_orderkey, l_linenumber, archive, size, crc32))), 8, '0') AS crc32,
       min_by(size, (l_orderkey, l_linenumber, archive, size, crc32)) AS size, false AS bad_size
FROM listing GROUP BY 1""")
def s2(t: Tables):
    return files.listing_index(t["listing"], ["l_orderkey", "l_linenumber", "archive", "size", "crc32"])


def _catalog_documents(t: Tables):
    """Catalog documents in JSON text, one per order, and sidecars for the partly shipped ones."""
    o = t["orders"]
    row = lambda n: F.struct(F.concat(F.lit("S"), F.col("o_orderkey"), F.lit(f"_{n}")).alias("sample_id"),
                             F.concat(F.col("o_orderpriority"), F.lit(f"_{n}.raw")).alias("raw_file"))
    docs = o.select(F.concat(F.lit("U"), "o_orderkey").alias("unit_id"), F.to_json(F.array(row(0), row(1))).alias("doc"))
    side = o.where("o_orderstatus = 'P'").select(F.concat(F.lit("U"), "o_orderkey").alias("unit_id"), F.to_json(F.array(row(9))).alias("doc"))
    parse = lambda d: d.select("unit_id", F.from_json("doc", files.T.ArrayType(files.ROW)).alias("rows"))
    return parse(docs), parse(side)


@query("s3_read_catalog", sql="""
SELECT concat('U', o_orderkey) AS unit_id, CAST(i AS INTEGER) AS row_index,
       concat('S', o_orderkey, '_', CASE WHEN o_orderstatus = 'P' THEN 9 ELSE i END) AS sample_id,
       concat(o_orderpriority, '_', CASE WHEN o_orderstatus = 'P' THEN 9 ELSE i END, '.raw') AS raw_file
FROM orders, range(2) r(i) WHERE i = 0 OR o_orderstatus <> 'P'""")
def s3(t: Tables):
    return files.catalog_rows(*_catalog_documents(t)).drop("attributes")


@query("s4_read_payloads", "transition", sql="""
SELECT unit_key AS unit_file, CAST(max(k) AS INTEGER) AS revision, max_by(seq, (k, seq)) AS seq, count(*) AS revisions
FROM transition GROUP BY 1""")
def s4(t: Tables):
    docs = t["transition"].select(
        F.when(F.col("k") == 0, F.concat("unit_key", F.lit(".json"))).otherwise(
            F.concat("unit_key", F.lit(".r"), F.col("k"), F.lit(".json"))).alias("file_name"), "seq")
    return files.current_documents(docs, tie="seq").select("unit_file", "revision", "seq", "revisions")


def item_documents(t: Tables):
    o = t["orders"]
    key = F.col("o_orderkey").cast("string")
    row = F.array(F.struct(F.lit(0).alias("row_index"), key.alias("sample_id"), F.col("o_orderpriority").alias("raw_file")))
    member = F.array(F.struct(F.concat(F.lit("m/"), key).alias("member_path"), F.lit("a.zip").alias("archive")))
    gone = F.array(F.struct(F.lit(1).alias("row_index"), key.alias("sample_id"), F.lit("other").alias("reason")))
    left = F.array(F.struct(F.concat(F.lit("x/"), key).alias("member_path"), F.lit("not_raw_data").alias("reason")))
    status = F.col("o_orderstatus")
    return o.select(F.concat(F.lit("U"), key).alias("unit_id"), row.alias("rows"),
                    F.when(status == "O", member).alias("added_members"),
                    F.when(status != "F", gone).alias("excluded_rows"), F.when(status == "P", left).alias("excluded_members"))


@query("s5_payload_items", sql="""
SELECT concat('U', o_orderkey) AS unit_id, 'row' AS kind, CAST(0 AS BIGINT) AS row_index, CAST(o_orderkey AS VARCHAR) AS sample_id,
       CAST(NULL AS VARCHAR) AS member_path, CAST(NULL AS VARCHAR) AS reason FROM orders
UNION ALL SELECT concat('U', o_orderkey), 'added_member', NULL, NULL, concat('m/', o_orderkey), NULL FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT concat('U', o_orderkey), 'excluded_row', 1, CAST(o_orderkey AS VARCHAR), NULL, 'other' FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT concat('U', o_orderkey), 'excluded_member', NULL, NULL, concat('x/', o_orderkey), 'not_raw_data' FROM orders WHERE o_orderstatus = 'P'
""")
def s5(t: Tables):
    return files.payload_items(item_documents(t), ["unit_id"]).select("unit_id", "kind", "row_index", "sample_id", "member_path", "reason")


def key_value_texts(t: Tables):
    """A key-value text per order, with repeated keys, factor lines and a sample list."""
    k, st = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    body = F.concat(
        F.lit("#HEAD\nMS:INSTRUMENT\t"), st, F.lit("-one\nXX:IGNORED\tnothing\nMS:INSTRUMENT\t "), F.col("o_orderpriority"),
        F.lit(" \nSUBJECT_SAMPLE_FACTORS\t-\tS"), k, F.lit("\tdose:"), st, F.lit(" | time:a:b\tRAW="), k, F.lit(".raw; B = c"),
        F.lit("\nSUBJECT_SAMPLE_FACTORS\t-\tS"), k, F.lit("\tdose:late"),
        F.lit("\r\nCH:COLUMN\t"), F.repeat(st, 700), F.lit("\nSamples\tS"), k, F.lit("\t \tT"), st)
    return t["orders"].select("o_orderkey", body.alias("text"))


@query("s6_key_values", sql="""
SELECT o_orderkey, 'MS:INSTRUMENT' AS k, CAST(2 AS BIGINT) AS first_line, concat(o_orderstatus, '-one ', o_orderpriority) AS value FROM orders
UNION ALL SELECT o_orderkey, 'CH:COLUMN', 7, concat(repeat(o_orderstatus, 600), ' [cut; line 7]') FROM orders""")
def s6(t: Tables):
    return files.key_values(files.lines(key_value_texts(t), "o_orderkey"), "o_orderkey")


@query("s6_sample_factors", sql="""
SELECT o_orderkey, concat('S', o_orderkey) AS sample, n.name, CASE n.name WHEN 'dose' THEN o_orderstatus WHEN 'time' THEN 'a:b'
       WHEN 'RAW' THEN concat(o_orderkey, '.raw') ELSE 'c' END AS value
FROM orders, (VALUES ('dose'), ('time'), ('RAW'), ('B')) n(name)""")
def s6_factors(t: Tables):
    return files.sample_factors(files.lines(key_value_texts(t), "o_orderkey"), "o_orderkey")


@query("s6_sample_names", sql="""
SELECT o_orderkey, concat('S', o_orderkey) AS sample FROM orders UNION ALL SELECT o_orderkey, concat('T', o_orderstatus) FROM orders""")
def s6_names(t: Tables):
    return files.sample_names(files.lines(key_value_texts(t), "o_orderkey"), "o_orderkey")


@query("s7_read_jsonl", sql="""
SELECT o_orderkey, CAST(i AS BIGINT) AS line_no,
       CASE i WHEN 1 THEN concat('{"seq": ', o_orderkey, '}') WHEN 2 THEN concat('broken ', o_orderpriority) ELSE '{"kind": "x"}' END AS raw_line,
       CASE WHEN i = 1 THEN CAST(o_orderkey AS VARCHAR) END AS seq, i <> 2 AS readable
FROM orders, range(1, 4) r(i)""")
def s7(t: Tables):
    body = F.concat(F.lit('{"seq": '), F.col("o_orderkey").cast("string"), F.lit("}\n\nbroken "), "o_orderpriority", F.lit('\n  \n{"kind": "x"}\n'))
    texts = t["orders"].select("o_orderkey", body.alias("text"))
    return files.json_lines(files.lines(texts, "o_orderkey"), "o_orderkey").select(
        "o_orderkey", "line_no", "raw_line", F.col("entry")["seq"].alias("seq"), F.col("entry").isNotNull().alias("readable"))


@query("s9_read_candidates", "candidate", sql="""
SELECT CAST(feature AS VARCHAR) AS feature, annotator_id, CAST(candidate_rank AS DOUBLE) AS candidate_rank, structure_key,
       is_reference_matched = 1 AS is_reference_matched, is_representative = 1 AS is_representative FROM candidate""")
def s9(t: Tables):
    c = t["candidate"]
    raw = c.select(F.concat(F.lit(" "), F.col("feature").cast("string")).alias("alignment_master_id"), "annotator_id",
                   F.col("candidate_rank").cast("string").alias("candidate_rank"), F.col("structure_key").alias("inchikey"),
                   F.when(F.col("is_reference_matched") == 1, "True").otherwise("false").alias("is_reference_matched"),
                   F.col("is_representative").cast("string").alias("is_representative"))
    return files.clean_candidates(raw)


@query("s10_scan_files", "doc", sql="""
SELECT path AS relative_path, md5(text) AS digest, CAST(length(text) AS BIGINT) AS n_chars FROM doc""")
def s10(t: Tables):
    """Texts of one source are stored as UTF-16 with a mark, the rest as UTF-8; both come back whole."""
    stored = t["doc"].select("path", F.when(F.col("source") < "src5", F.encode("text", "UTF-16")).otherwise(F.encode("text", "UTF-8")).alias("content"))
    found = stored.select(F.col("path").alias("relative_path"), files.decode_content("content").alias("text"))
    return found.select("relative_path", F.md5("text").alias("digest"), F.length("text").cast("bigint").alias("n_chars"))


@query("s11_read_id_list", sql="""
SELECT o_orderkey, v.id, CAST(v.p AS INTEGER) AS position FROM orders, (VALUES
  ('O', concat('U', 1), 0), ('O', 'U2', 1), ('F', 'U7', 0), ('F', 'U8', 2), ('P', 'U5', 0), ('P', 'U6', 1)) v(st, id, p)
WHERE v.st = o_orderstatus""")
def s11(t: Tables):
    body = (F.when(F.col("o_orderstatus") == "O", '["U1", "U2", "U1"]')
            .when(F.col("o_orderstatus") == "F", "U7, U7\n# U9 is out\nU8,U7").otherwise('{"unit_ids": ["U5", " U6 "]}'))
    return files.id_list(t["orders"].select("o_orderkey", body.alias("text")), "o_orderkey")


@query("s12_read_analysis_csv", sql="""
SELECT concat('/d/', o_orderkey, '.raw') AS file_path, concat('n', o_orderkey) AS file_name, 'Sample' AS file_type,
       o_orderstatus AS class_id, 'DDA' AS acquisition_type, '1' AS batch_order, CAST(o_orderkey AS VARCHAR) AS analytical_order,
       CAST(NULL AS VARCHAR) AS factor FROM orders""")
def s12(t: Tables):
    k = F.col("o_orderkey").cast("string")
    line = F.concat(F.lit("/d/"), k, F.lit(".raw,n"), k, F.lit(",Sample,"), "o_orderstatus", F.lit(",DDA,1,"), k, F.lit(","))
    return t["orders"].select(F.from_csv(line, files.ANALYSIS.toDDL()).alias("r")).select("r.*")


@query("s14_write_status", "payload", sql="""
SELECT unit_id AS unit_key, CASE WHEN status = 'ready' THEN 'outputs produced;completed' ELSE '' END AS report_terms,
       CASE WHEN status = 'ready' THEN '1' ELSE '0' END AS outputs_produced, coalesce(exclusion_reason, '') AS terminal_reason,
       concat('a b', ' c ', status) AS warnings, '' AS workspace FROM payload""")
def s14(t: Tables):
    p = t["payload"].select(
        F.col("unit_id").alias("unit_key"),
        F.when(F.col("status") == "ready", F.array(F.lit("outputs produced"), F.lit("completed"))).otherwise(F.array().cast("array<string>")).alias("report_terms"),
        (F.col("status") == "ready").alias("outputs_produced"), F.col("exclusion_reason").alias("terminal_reason"),
        F.concat(F.lit("a\tb\nc "), "status").alias("warnings"))
    return records.status_lines(p, ("unit_key", "report_terms", "outputs_produced", "terminal_reason", "warnings", "workspace"))


@query("s15_append_log", "transition", sql="""
SELECT seq, CASE WHEN to_state <> 'view' THEN to_state END AS old_line,
       CASE WHEN value > 90 THEN 'changed' WHEN value < 1 THEN NULL ELSE to_state END AS new_line,
       CASE WHEN to_state = 'view' THEN 'append' WHEN value > 90 OR value < 1 THEN 'refuse' ELSE 'keep' END AS action
FROM transition WHERE NOT (to_state = 'view' AND value < 1)""")
def s15(t: Tables):
    tr = t["transition"]
    existing = tr.where("to_state <> 'view'").select("seq", F.col("to_state").alias("raw_line"))
    rendered = tr.where("NOT value < 1").select("seq", F.when(F.col("value") > 90, "changed").otherwise(F.col("to_state")).alias("raw_line"))
    return records.append_plan(existing, rendered)


@query("a31_table_counts", sql=" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in ("orders", "lineitem", "events", "customer", "part", "nation")))
def a31(t: Tables):
    return records.table_counts({n: t[n] for n in ("orders", "lineitem", "events", "customer", "part", "nation")})


@query("s8_ledger_tables", "attempt", sql="""
SELECT attempt_id, unit_key, step, started_us, outcome, network = 1 AS counted, tool FROM (SELECT *, CAST(NULL AS VARCHAR) AS tool FROM attempt)""")
def s8(t: Tables):
    a = t["attempt"].withColumn("started_at", F.timestamp_micros("started_us")).withColumn("ended_at", F.timestamp_micros("ended_us")).withColumn("counted", F.col("network") == 1)
    table = records.as_table(a, "attempt")
    return table.select("attempt_id", "unit_key", "step", F.unix_micros("started_at").alias("started_us"), "outcome", "counted", "tool")


@query("w1_latest_revision", "doc", sql="""
SELECT source AS unit_file, CAST(max(doc_id) AS INTEGER) AS revision, max_by(digest, doc_id) AS digest, count(*) AS revisions FROM doc GROUP BY 1""")
def w1(t: Tables):
    named = t["doc"].select(F.concat("source", F.lit(".r"), "doc_id", F.lit(".json")).alias("file_name"), "digest")
    return files.current_documents(named).select("unit_file", "revision", "digest", "revisions")
