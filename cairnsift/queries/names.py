"""Name, text and policy functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift import vocab
from cairnsift.functions import names, policy, text, tokens
from cairnsift.queries import duck
from cairnsift.queries.registry import Dialect, Tables, query, shape

# (quantity, text after the run name, acquisition tokens, level words, product-ion words, problem against DDA)
WORDS = (
    (1, "_DDA", "DDA", "", "DDA", ""), (2, "posDDA_1", "DDA", "", "DDA", ""), (3, "_media1", "", "", "", ""),
    (4, "-dda-ms2", "DDA", "MS/MS:MS2", "DDA+MS2", ""), (5, "_tDDA", "tDDA", "", "DDA", ""),
    (6, "_HERMES_x", "tDDA", "", "DDA", ""), (7, "_DIA1", "DIA1", "", "DIA", "mode:DIA"),
    (8, "_dia", "DIA", "", "DIA", "mode:DIA"), (9, "_SWATH_AIF", "AIF+SWATH", "", "AIF+SWATH", "mode:AIF+SWATH"),
    (10, "_HDMSe", "MSe", "MS/MS:MSe", "DIA+MSe", "mode:DIA"), (11, "_Scan03", "SCAN03", "", "", ""),
    (12, "_full-scan", "MS1", "MS-only:FullScan", "", "mode:MS1"), (13, "_MRM", "MRM", "", "", "targeted:MRM"),
    (14, "_tMS2_SIM", "SIM+tMS2", "MS/MS:MS2", "MS2", "targeted:SIM+tMS2"), (15, "_AutoMSMS", "", "MS/MS:MSMS", "MSMS", ""),
    (16, "negMSMS", "", "MS/MS:MSMS", "MSMS", ""), (17, "_MS1_", "MS1", "MS-only:MS1", "", "mode:MS1"),
    (18, "_MS-Profile", "", "MS-only:MSProfile", "", ""), (19, "_sonar", "", "MS/MS:SONAR", "SONAR", ""),
    (20, "_IDA", "", "MS/MS:IDA", "IDA", ""), (21, "posMS_2", "", "MS-only:MS", "", ""), (22, "_MSn", "", "MS/MS:MSn", "MSn", ""),
    (23, "Lydia", "", "", "", ""), (24, "_MSLIB", "", "", "", ""), (25, "_DDA_DIA2", "DDA+DIA2", "", "DDA+DIA", ""),
)
# (quantity, free text, methods named by token, methods with spelled-out names)
METHODS = (
    (26, "B7_EAD_r2", "EAD", "EAD"), (27, "x 7ead9f3c y", "", ""), (28, "id 0a1b2c3d-ead2-4f5e-8a9b-c0d1e2f3a4b5", "", ""),
    (29, "ETD and EThcD, etd", "ETD+EThcD", "ETD+EThcD"), (30, "Electron-capture dissociation", "", "ECD"),
    (31, "UVPD; infrared multiphoton dissociation", "UVPD", "UVPD+IRMPD"), (32, "HCD only", "", ""),
    (33, "lead oxygen attachment dissociation OAD2", "OAD", "OAD"), (34, "ead1", "", ""), (35, "EADx", "", ""),
    (36, "NETD/EDD", "NETD+EDD", "NETD+EDD"), (37, "ead", "EAD", "EAD"),
)


def _values(rows) -> str:
    lit = lambda v: str(v) if isinstance(v, int) else "'" + v + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + ")"


@shape("worded")
def worded(d: Dialect) -> str:
    return f"""
SELECT concat('run', {d.text('l_suppkey')}, w.txt) AS name, w.acq, w.lev, w.prod, w.problem, l_orderkey, l_linenumber
FROM {d.table('lineitem')} JOIN {_values(WORDS)} AS w(q, txt, acq, lev, prod, problem) ON (cast(l_quantity AS int) - 1) % {len(WORDS)} + 1 = w.q"""


@shape("method_text")
def method_text(d: Dialect) -> str:
    return f"""
SELECT w.txt, w.tok, w.spelled, l_suppkey, l_orderkey, l_linenumber, l_returnflag
FROM {d.table('lineitem')} JOIN {_values(METHODS)} AS w(q, txt, tok, spelled) ON (cast(l_quantity AS int) - 1) % {len(METHODS)} + {METHODS[0][0]} = w.q"""


@query("f1_norm_path", "listing", sql=f"SELECT DISTINCT path, {duck.norm('path')} AS norm FROM listing")
def f1(t: Tables):
    return t["listing"].select("path", names.norm_path("path").alias("norm")).distinct()


@query("f2_member_key", "listing", sql=f"SELECT {duck.key('path')} AS member_key, count(*) AS n FROM listing GROUP BY 1")
def f2(t: Tables):
    return t["listing"].groupBy(names.member_key("path").alias("member_key")).agg(F.count("*").alias("n"))


@query("f3_path_parts", "listing", sql=f"""
SELECT DISTINCT {duck.base('path')} AS base, {duck.folder(duck.key('path'))} AS folder,
       concat(lower({duck.norm('path')}), '/') AS prefix FROM listing""")
def f3(t: Tables):
    return t["listing"].select(names.basename("path").alias("base"), names.folder_key(names.member_key("path")).alias("folder"),
                               names.folder_prefix("path").alias("prefix")).distinct()


@query("f4_stem_ext", "listing", sql=f"""
SELECT DISTINCT {duck.stem('path')} AS stem,
       lower(regexp_extract({duck.key('path')}, '(?i)\\.(raw|mzml|mzxml|mzdata|wiff2?|d|lcd|cdf)$', 1)) AS known,
       lower(regexp_extract({duck.base('path')}, '(\\.[^.]*)$', 1)) AS last_ext,
       coalesce(nullif(regexp_extract({duck.base('path')}, '(\\.[^.]*)$', 1), ''), '(none)') AS shown FROM listing""")
def f4(t: Tables):
    return t["listing"].select(names.stem("path").alias("stem"), names.ext_known(names.member_key("path")).alias("known"),
                               names.ext_any("path").alias("last_ext"), names.ext_shown("path").alias("shown")).distinct()


@query("f5_name_key", "catalog_row", sql=f"""
SELECT raw_file, CASE WHEN o_orderstatus = 'F' THEN concat('stem:', lower(raw_file)) ELSE concat('name:', lower(raw_file)) END AS name_key
FROM catalog_row""")
def f5(t: Tables):
    return t["catalog_row"].select("raw_file", names.name_key("raw_file").alias("name_key"))


@query("f6_file_kinds", "listing", sql=f"""
SELECT {duck.rawlike('path')} AS raw_like, {duck.metadata('path')} AS metadata, {duck.in_folder('path')} AS in_folder,
       regexp_matches(path, '(?i)\\.(zip|7z|rar|tar|tgz|gz|bz2|xz)$') AND NOT {duck.rawlike('path')} AND NOT starts_with({duck.base('path')}, '._') AS nested, count(*) AS n
FROM (SELECT CASE WHEN l_linenumber = 1 THEN concat('__MACOSX/', path) WHEN l_linenumber = 2 THEN concat('x/._', replace(replace(path, '/', '_'), chr(92), '_')) ELSE path END AS path
      FROM listing) GROUP BY 1, 2, 3, 4""")
def f6(t: Tables):
    path = (F.when(F.col("l_linenumber") == 1, F.concat(F.lit("__MACOSX/"), "path"))
            .when(F.col("l_linenumber") == 2, F.concat(F.lit("x/._"), F.translate("path", "/\\", "__"))).otherwise(F.col("path")))
    return t["listing"].select(path.alias("path")).groupBy(
        names.is_raw_like("path").alias("raw_like"), names.is_archive_metadata("path").alias("metadata"),
        names.in_vendor_folder("path").alias("in_folder"), names.is_nested_archive("path").alias("nested")).agg(F.count("*").alias("n"))


@query("f7_loose_stem", "listing", sql=f"""
SELECT DISTINCT lower(regexp_replace({duck.stem('path')}, '(?i)pos(?:itive)?|neg(?:ative)?|[^a-z0-9]', '', 'g')) AS loose FROM listing""")
def f7(t: Tables):
    return t["listing"].select(names.loose_stem("path").alias("loose")).distinct()


@query("f8_normalise_ion", sql="""
WITH v AS (SELECT CASE CAST(l_quantity AS INTEGER) % 9 WHEN 0 THEN ' Positive ' WHEN 1 THEN 'NEG' WHEN 2 THEN 'both' WHEN 3 THEN 'Positive and Negative'
  WHEN 4 THEN 'mixed' WHEN 5 THEN 'Polarity Switching' WHEN 6 THEN 'polarity_switching' WHEN 7 THEN NULL ELSE 'ESI' END AS value, CAST(l_quantity AS INTEGER) % 9 AS i FROM lineitem)
SELECT value, CASE i WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'both' WHEN 3 THEN 'positive' WHEN 4 THEN 'both' WHEN 5 THEN 'switching'
  WHEN 6 THEN 'switching' ELSE 'unknown' END AS ion, count(*) AS n FROM v GROUP BY 1, 2""")
def f8(t: Tables):
    options = F.array(F.lit(" Positive "), F.lit("NEG"), F.lit("both"), F.lit("Positive and Negative"), F.lit("mixed"),
                      F.lit("Polarity Switching"), F.lit("polarity_switching"), F.lit(None), F.lit("ESI"))
    v = t["lineitem"].select(F.get(options, F.col("l_quantity").cast("int") % 9).alias("value"))
    return v.groupBy("value", tokens.normalise_ion("value").alias("ion")).agg(F.count("*").alias("n"))


@query("f9_normalise_chromatography", sql="""
WITH v AS (SELECT CASE CAST(l_quantity AS INTEGER) % 9 WHEN 0 THEN 'amide HILIC' WHEN 1 THEN 'RP' WHEN 2 THEN 'Reversed phase' WHEN 3 THEN 'C18 column'
  WHEN 4 THEN 'Normal phase' WHEN 5 THEN 'unknown' WHEN 6 THEN '' WHEN 7 THEN NULL ELSE 'GC' END AS value, CAST(l_quantity AS INTEGER) % 9 AS i FROM lineitem)
SELECT value, CASE i WHEN 0 THEN 'HILIC' WHEN 1 THEN 'RP' WHEN 2 THEN 'RP' WHEN 3 THEN 'RP' WHEN 4 THEN 'normal_phase' WHEN 8 THEN 'other'
  ELSE 'unknown' END AS chromatography, count(*) AS n FROM v GROUP BY 1, 2""")
def f9(t: Tables):
    options = F.array(F.lit("amide HILIC"), F.lit("RP"), F.lit("Reversed phase"), F.lit("C18 column"), F.lit("Normal phase"),
                      F.lit("unknown"), F.lit(""), F.lit(None), F.lit("GC"))
    v = t["lineitem"].select(F.get(options, F.col("l_quantity").cast("int") % 9).alias("value"))
    return v.groupBy("value", tokens.normalise_chromatography("value").alias("chromatography")).agg(F.count("*").alias("n"))


@query("f10_polarity_tokens", "listing", sql=f"""
SELECT path, array_to_string([x FOR x IN [CASE WHEN regexp_matches(path, '(?i)(negative|neg)([^a-z]|$)') THEN 'negative' END,
       CASE WHEN regexp_matches(path, '(?i)(positive|pos)([^a-z]|$)') THEN 'positive' END] IF x IS NOT NULL], ',') AS tokens,
       {duck.polarity('path')} AS polarity FROM listing GROUP BY ALL""")
def f10(t: Tables):
    return t["listing"].select("path", F.array_join(tokens.polarity_tokens("path"), ",").alias("tokens"),
                               tokens.token_polarity("path").alias("polarity")).distinct()


@query("f11_chromatography_tokens", "listing", sql=f"""
SELECT {duck.chromatography("concat(path, CASE WHEN l_linenumber = 1 THEN '_hilic' WHEN l_linenumber = 2 THEN '/RPpos' WHEN l_linenumber = 3 THEN 'c180' ELSE '' END)")} AS chromatography,
       l_linenumber, count(*) AS n FROM listing GROUP BY 1, 2""")
def f11(t: Tables):
    more = (F.when(F.col("l_linenumber") == 1, "_hilic").when(F.col("l_linenumber") == 2, "/RPpos")
            .when(F.col("l_linenumber") == 3, "c180").otherwise(""))
    return t["listing"].groupBy(tokens.token_chromatography(F.concat("path", more)).alias("chromatography"), "l_linenumber").agg(F.count("*").alias("n"))


@query("f12_token_acquisition", "worded", sql="SELECT name, acq AS tokens, count(*) AS n FROM worded GROUP BY 1, 2")
def f12(t: Tables):
    return t["worded"].groupBy("name", F.array_join(tokens.token_acquisition("name"), "+").alias("tokens")).agg(F.count("*").alias("n"))


@query("f13_ms_level_words", "worded", sql="SELECT name, lev AS words, count(*) AS n FROM worded GROUP BY 1, 2")
def f13(t: Tables):
    return t["worded"].groupBy("name", F.array_join(tokens.ms_level_words("name"), "+").alias("words")).agg(F.count("*").alias("n"))


@query("f14_product_ion_words", "worded", sql="SELECT name, prod AS words, count(*) AS n FROM worded GROUP BY 1, 2")
def f14(t: Tables):
    return t["worded"].groupBy("name", F.array_join(tokens.product_ion_words("name"), "+").alias("words")).agg(F.count("*").alias("n"))


@query("f15_acquisition_problem", "worded", sql="""
SELECT name, nullif(problem, '') AS problem, count(*) AS n FROM worded GROUP BY 1, 2""")
def f15(t: Tables):
    return t["worded"].groupBy("name", tokens.acquisition_problem("name", F.lit("DDA")).alias("problem")).agg(F.count("*").alias("n"))


@query("f16_methods_named", "method_text", sql="""
SELECT txt, tok AS named, spelled AS named_in_words, count(*) AS n FROM method_text GROUP BY 1, 2, 3""")
def f16(t: Tables):
    return t["method_text"].groupBy("txt", F.array_join(tokens.methods_named("txt"), "+").alias("named"),
                                    F.array_join(tokens.methods_named("txt", words=True), "+").alias("named_in_words")).agg(F.count("*").alias("n"))


@query("f17_stated_methods", "method_text", sql="""
SELECT txt, l_returnflag, CASE WHEN l_returnflag = 'A' THEN spelled ELSE '' END AS stated, tok AS in_file, count(*) AS n
FROM method_text GROUP BY ALL""")
def f17(t: Tables):
    m = t["method_text"]
    field = F.when(F.col("l_returnflag") == "A", "Fragmentation method").when(F.col("l_returnflag") == "N", "Instrument fragmentation").otherwise("Sample name")
    attributes = F.create_map(field, F.col("txt"), F.lit("note"), F.col("txt"))
    path = F.concat(F.lit("EAD/"), F.translate("txt", "/", "-"))
    return m.groupBy("txt", "l_returnflag", F.array_join(tokens.stated_methods(attributes), "+").alias("stated"),
                     F.array_join(tokens.methods_in_file_name(path), "+").alias("in_file")).agg(F.count("*").alias("n"))


@query("f18_instrument_can", "unit", sql="""
SELECT u.instrument, m.method, CASE WHEN u.instrument IN ('unknown', 'Thermo') THEN (u.instrument = 'unknown' OR m.vendor LIKE '%thermo%')
       WHEN u.instrument = 'SCIEX ZenoTOF 7600' THEN m.method = 'EAD' WHEN u.instrument = 'Thermo Orbitrap Fusion' THEN m.fusion ELSE false END AS able, count(*) AS n
FROM unit u, (VALUES ('EAD', 'sciex', false), ('ETD', 'thermo|bruker|agilent', true), ('UVPD', 'thermo', true), ('EDD', 'bruker', false)) m(method, vendor, fusion)
GROUP BY 1, 2, 3""")
def f18(t: Tables):
    u = t["unit"].select("instrument", F.explode(F.array(*[F.lit(m) for m in ("EAD", "ETD", "UVPD", "EDD")])).alias("method"))
    return u.groupBy("instrument", "method", tokens.instrument_can("method", "instrument").alias("able")).agg(F.count("*").alias("n"))


@query("f19_label_tests", sql="""
SELECT o_orderpriority AS label, o_orderpriority IN ('1-URGENT', '5-LOW') AS non_sample,
       CASE o_orderstatus WHEN 'O' THEN 'positive' WHEN 'F' THEN 'negative' END AS polarity, count(*) AS n FROM orders GROUP BY 1, 2, 3""")
def f19(t: Tables):
    o = t["orders"]
    label = (F.when(F.col("o_orderpriority") == "1-URGENT", "Pooled QC").when(F.col("o_orderpriority") == "5-LOW", "blanks")
             .when(F.col("o_orderpriority") == "2-HIGH", "QC1").otherwise("treated"))
    name = F.when(F.col("o_orderstatus") == "O", "lib_Pos.msp").when(F.col("o_orderstatus") == "F", "lib-NEG-2.msp").otherwise("lib_pos_neg.msp")
    return o.groupBy(F.col("o_orderpriority").alias("label"), tokens.non_sample_class(label).alias("non_sample"),
                     tokens.name_polarity(name).alias("polarity")).agg(F.count("*").alias("n"))


@query("f20_canonical_digest", "payload", sql="""
SELECT unit_id, concat('{"accession":"', accession, '","exclusion":', CASE WHEN exclusion_reason IS NULL THEN 'null' ELSE concat('"', exclusion_reason, '"') END,
       ',"rows":', catalog_row_count, ',"unit_id":"', unit_id, '"}') AS canonical,
       sha256(concat('{"accession":"', accession, '","exclusion":', CASE WHEN exclusion_reason IS NULL THEN 'null' ELSE concat('"', exclusion_reason, '"') END,
       ',"rows":', catalog_row_count, ',"unit_id":"', unit_id, '"}')) AS digest FROM payload""")
def f20(t: Tables):
    form = text.canonical_json({"unit_id": F.col("unit_id"), "rows": F.col("catalog_row_count"), "accession": F.col("accession"),
                                "exclusion": F.col("exclusion_reason")})
    return t["payload"].select("unit_id", form.alias("canonical")).withColumn("digest", text.sha256("canonical"))


@query("f21_portable_path", sql="""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '.' WHEN '2-HIGH' THEN concat('S', o_orderkey, '.raw')
       WHEN '3-MEDIUM' THEN concat('../out/', o_orderkey) WHEN '4-NOT SPECIFIED' THEN concat('<external>/', o_orderkey, '.lib') ELSE 'plain/x' END AS cell
FROM orders""")
def f21(t: Tables):
    k, p = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    value = (F.when(p == "1-URGENT", "D:\\Work\\U1\\raw").when(p == "2-HIGH", F.concat(F.lit("d:/work/u1/RAW/S"), k, F.lit(".raw")))
             .when(p == "3-MEDIUM", F.concat(F.lit("D:\\work\\U1\\out\\"), k)).when(p == "4-NOT SPECIFIED", F.concat(F.lit("\\\\server\\lib\\"), k, F.lit(".lib")))
             .otherwise("plain/x"))
    return t["orders"].select("o_orderkey", text.portable_path(value, F.lit("D:\\Work\\U1\\raw\\")).alias("cell"))


@query("f22_redact", "doc", sql="""
SELECT doc_id, md5(replace(replace(concat('a C:', chr(92), 'lib', chr(92), 'main.msp b c:/LIB/other ', text), concat('C:', chr(92), 'lib', chr(92), 'main.msp'), '<library:main>'),
       'c:/LIB', '<library-directory>')) AS digest FROM doc""")
def f22(t: Tables):
    body = F.concat(F.lit("a C:\\lib\\main.msp b c:/LIB/other "), "text")
    return t["doc"].select("doc_id", F.md5(text.redact(body, {"main": "C:\\lib\\main.msp"})).alias("digest"))


@query("f23_identity_block", "candidate", sql="""
SELECT feature, substr(structure_key, 1, 14) AS block, CASE WHEN sum(is_representative) > 0 THEN round(sum(is_reference_matched) / sum(is_representative), 4) END AS ratio
FROM candidate GROUP BY 1, 2""")
def f23(t: Tables):
    g = t["candidate"].groupBy("feature", text.identity_block("structure_key").alias("block")).agg(
        F.sum("is_reference_matched").alias("a"), F.sum("is_representative").alias("b"))
    return g.select("feature", "block", text.rate(F.col("a"), F.col("b")).alias("ratio"))


@query("f24_versions", "payload", sql="""
SELECT skill_version, CASE skill_version WHEN '1.2.9' THEN '1,2,9' WHEN '1.3.0' THEN '1,3,0' ELSE '' END AS parts,
       skill_version = '1.2.9' AS legacy, count(*) AS n, count(*) AS readable_times FROM payload GROUP BY 1""")
def f24(t: Tables):
    p = t["payload"].withColumn("at", text.parse_iso(F.when(F.col("skill_version") == "dev", "2026-01-01T00:00:00Z").otherwise("2026-01-01T00:00:00+00:00")))
    return p.groupBy("skill_version", F.array_join(F.transform(text.version_tuple("skill_version"), lambda x: x.cast("string")), ",").alias("parts"),
                     text.legacy_policy("skill_version").alias("legacy")).agg(F.count("*").alias("n"), F.count("at").alias("readable_times"))


@query("f25_threshold_steps", "unit", sql="""
SELECT instrument, CASE WHEN instrument = 'Thermo Orbitrap Fusion' THEN 1000 ELSE 100 END AS step,
       CASE WHEN instrument = 'Thermo' THEN 1000 ELSE 100 END AS family,
       CASE WHEN instrument = 'unknown' THEN 'no_step' WHEN instrument = 'Thermo' THEN 'ok' WHEN instrument = 'Agilent 6545' THEN 'used_step_differs'
            WHEN instrument LIKE 'Bruker%' THEN 'coarse_step_differs' ELSE 'ok' END AS estimate, count(*) AS n
FROM unit GROUP BY 1, 2, 3, 4""")
def f25(t: Tables):
    i = F.col("instrument")
    fam = F.when(i == "Thermo", "Fourier-transform MS").otherwise("QTOF")
    used = F.when(i == "unknown", F.lit(None).cast("int")).when(i == "Thermo", 100).when(i == "Agilent 6545", 10).otherwise(100)
    coarse = F.when(i == "Thermo", 1000).when(i.startswith("Bruker"), 1000).otherwise(F.when(i != "unknown", 100))
    u = t["unit"].select(i, policy.threshold_step(i, F.lit("QTOF"), F.lit(0)).alias("step"), policy.family_step(fam).alias("family"),
                         policy.estimate_step(used, coarse, i == "Thermo", policy.family_step(fam)).alias("estimate"))
    return u.groupBy("instrument", "step", "family", "estimate").agg(F.count("*").alias("n"))


@query("f26_classify_result", "attempt", sql="""
SELECT outcome, CASE outcome WHEN 'ok' THEN 'ok' WHEN 'failed' THEN CASE WHEN network = 1 THEN 'fault' ELSE 'failed' END WHEN 'busy' THEN 'busy'
       WHEN 'fault' THEN CASE WHEN network = 1 THEN 'contract' ELSE 'fault' END ELSE 'refused' END AS class, count(*) AS n FROM attempt GROUP BY 1, 2""")
def f26(t: Tables):
    o, net = F.col("outcome"), F.col("network") == 1
    reason = (F.when(o == "failed", F.when(net, "os_error").otherwise("download_failed")).when(o == "busy", "unit_busy")
              .when(o == "fault", F.when(net, "validation_error").otherwise("backend_unavailable")).otherwise("campaign_authorization_refused"))
    error = F.when(o == "failed", "TimeoutError").when(o == "fault", "JSONDecodeError")
    return t["attempt"].groupBy("outcome", policy.classify_result(o == "ok", reason, error).alias("class")).agg(F.count("*").alias("n"))


@query("f27_failure_texts", "attempt", sql="""
SELECT outcome, step, outcome IN ('failed', 'interrupted') OR (outcome = 'busy') AS network, CAST(sum(CASE WHEN outcome = 'fault' THEN bytes + 1 END) AS BIGINT) AS lease_bytes,
       CAST(sum(CASE WHEN outcome = 'ok' THEN bytes END) AS BIGINT) AS short_bytes, count(*) AS n FROM attempt GROUP BY 1, 2, 3""")
def f27(t: Tables):
    o, b = F.col("outcome"), F.col("bytes").cast("string")
    said = (F.when(o == "failed", "urlopen error [Errno 11001] getaddrinfo failed").when(o == "busy", "HTTP Error 503: x")
            .when(o == "fault", F.concat(F.lit("Download exceeded the "), b, F.lit("-byte safety limit")))
            .when(o == "ok", F.concat(F.lit("archive expands to "), b, F.lit(" bytes; 5 are free and 9 are held in reserve"))).otherwise("checksum"))
    a = t["attempt"].select("outcome", "step", policy.network_failure(
        F.lit("failed"), said, F.when(o == "interrupted", "ConnectionResetError"), F.lit(None).cast("boolean")).alias("network"),
        policy.lease_size_limit(said).alias("lease"), policy.extraction_disk_short(said).alias("short"))
    return a.groupBy("outcome", "step", "network").agg(F.sum("lease").alias("lease_bytes"), F.sum("short").alias("short_bytes"), F.count("*").alias("n"))


@query("f28_gate_terms", "payload", sql="""
SELECT ion_mode, CASE ion_mode WHEN 'positive' THEN 'pass' WHEN 'negative' THEN 'fail' WHEN 'both' THEN 'unusable' WHEN 'switching' THEN 'held' ELSE 'not_run' END AS token,
       CASE WHEN status <> 'ready' THEN '' WHEN ion_mode = 'positive' THEN 'outputs produced;completed' ELSE 'outputs produced' END AS terms, count(*) AS n
FROM payload GROUP BY 1, 2, 3""")
def f28(t: Tables):
    i = F.col("ion_mode")
    code = F.when(i == "positive", 0).when(i == "negative", 2).when(i == "both", 3).when(i == "switching", 4)
    return t["payload"].groupBy("ion_mode", policy.gate_token(code).alias("token"),
                                F.array_join(policy.report_terms(F.col("status") == "ready", code), ";").alias("terms")).agg(F.count("*").alias("n"))


@query("f29_attribute_map", sql="""
SELECT o_orderkey, v.name, CASE v.name WHEN 'class' THEN concat('a/', o_orderstatus) WHEN 'priority' THEN o_orderpriority ELSE 'own' END AS value
FROM orders, (VALUES ('class'), ('priority'), ('label')) v(name)""")
def f29(t: Tables):
    attributes = F.create_map(F.lit("class"), F.concat(F.lit(" a|"), "o_orderstatus"), F.lit("empty"), F.lit(""), F.lit("label"), F.lit("own"))
    merged = text.attribute_map(attributes, {"priority": F.col("o_orderpriority"), "label": F.lit("top"), "none": F.lit(None).cast("string")})
    return t["orders"].select("o_orderkey", F.explode(merged).alias("name", "value"))


@query("f30_fill_placeholders", "item", sql=f"""
SELECT unit_id, coalesce(replace(replace(concat('in {{folder}} of {{sample_id}} {{token:polarity}}'), '{{sample_id}}', sample_id), '{{folder}}',
         coalesce({duck.folder('member_path')}, '{{folder}}')), '') AS half,
       CASE WHEN member_path IS NULL THEN '{{folder}}' ELSE '' END AS missing_folder, count(*) AS n
FROM item GROUP BY 1, 2, 3""")
def f30(t: Tables):
    filled, missing = text.fill(F.lit("in {folder} of {sample_id} {token:polarity}"), {
        "folder": names.folder_key("member_path"), "sample_id": F.col("sample_id")})
    _, lacking = text.fill(F.lit("{folder}"), {"folder": names.folder_key("member_path")})
    return t["item"].groupBy("unit_id", filled.alias("half"), F.array_join(lacking, ",").alias("missing_folder")).agg(F.count("*").alias("n"))


@query("f31_labels", "doc", sql="""
SELECT doc_id, CASE WHEN n_chars >= 1024 THEN printf('%.1f kB', n_chars / 1024.0) ELSE concat(n_chars, ' B') END AS size_label,
       CASE WHEN length(trim(regexp_replace(source, '\\s+', ' ', 'g'))) <= 4 THEN source ELSE concat(substr(source, 1, 1), '...') END AS clipped FROM doc""")
def f31(t: Tables):
    return t["doc"].select("doc_id", text.size_label("n_chars").alias("size_label"), text.clip("source", 4).alias("clipped"))


@query("f32_encoding_rank", "listing", sql=f"""
SELECT CAST(CASE WHEN regexp_matches({duck.base('path')}, '(?i)\\.(raw|wiff)$') THEN 0 WHEN regexp_matches(path, '(?i)\\.cdf$') THEN 1
            WHEN regexp_matches(path, '(?i)\\.mzML$') THEN 2 WHEN regexp_matches(path, '(?i)\\.mzXML$') THEN 3 END AS INTEGER) AS encoding_rank,
       array_to_string([x FOR x IN [CASE WHEN regexp_matches(path, '(?i)neg_C18/') THEN 'negative' END, CASE WHEN regexp_matches(path, 'POS/') THEN 'positive' END] IF x IS NOT NULL], ',') AS folders,
       count(*) AS n, count(DISTINCT lower(regexp_replace({duck.base('path')}, '(?i)\\.(zip|raw|wiff|cdf|mzml|mzxml)$', ''))) AS stems
FROM listing GROUP BY 1, 2""")
def f32(t: Tables):
    return t["listing"].groupBy(names.encoding_rank("path").alias("encoding_rank"), F.array_join(names.path_polarities("path"), ",").alias("folders")).agg(
        F.count("*").alias("n"), F.countDistinct(names.encoding_stem("path")).alias("stems"))


@query("f33_terminal_class", "attempt", sql="""
SELECT outcome, CASE outcome WHEN 'failed' THEN 'excluded:bad_format' WHEN 'fault' THEN 'excluded:download_exclude' WHEN 'busy' THEN
       CASE WHEN network = 1 THEN 'refused:cross_unit_x' ELSE 'retryable' END ELSE 'retryable' END AS class, count(*) AS n FROM attempt GROUP BY 1, 2""")
def f33(t: Tables):
    o = F.col("outcome")
    return t["attempt"].groupBy("outcome", policy.terminal_class(
        F.when(o.isin("failed", "fault"), "exclude"), F.when(o == "failed", "bad_format"), F.col("network") != 1,
        F.when(o == "busy", "cross_unit_x")).alias("class")).agg(F.count("*").alias("n"))


@query("f22_redact_json", "doc", sql="""
SELECT doc_id, concat('{"a":["<library:main>",{"in <library-directory>/other":"', source, '"}],"lang":"', lang, '"}') AS redacted FROM doc""")
def f22_json(t: Tables):
    """Locations in values and keys of a nested record, in several spellings."""
    body = F.concat(F.lit('{"a": ["C:\\\\lib\\\\main.msp", {"in c:/LIB/other": "'), "source", F.lit('"}], "lang": "'), "lang", F.lit('"}'))
    return t["doc"].select("doc_id", text.redact_json(body, {"main": "C:\\lib\\main.msp"}).alias("redacted"))


# Failure details as JSON: what differs by outcome sits at several depths.
def failure_details(t: Tables):
    o = F.col("outcome")
    b = F.col("bytes").cast("string")
    detail = (F.when(o == "failed", F.concat(F.lit('{"error": "checksum", "failure": {"retryable": '), F.when(F.col("network") == 1, "true").otherwise("false"),
                                             F.lit(', "disposition": {"decision": "exclude", "reason": " bad_format ", "inputs": [{"n": '), b, F.lit("}]}}}")))
              .when(o == "fault", F.concat(F.lit('{"failure": {"archive_failure": {"reason": "insufficient_disk_space", "detail": {"declared_bytes": '), b, F.lit("}}, "),
                                           F.lit('"disposition": {"decision": "exclude", "inputs": "x"}}}')))
              .when(o == "busy", F.concat(F.lit('{"reason": "", "failure": {"error_type": "DownloadStalled", "archive_failure": {"reason": "insufficient_disk_space", "detail": {"declared_bytes": true}}, "detail": "archive expands to '), b,
                                          F.lit(' bytes; 5 are free and 9 are held in reserve"}}')))
              .when(o == "ok", F.lit('{"error": "HTTP Error 503: x", "failure": {"error": "y"}}')).otherwise("no json"))
    return t["attempt"].select("attempt_id", policy.failure_record(detail).alias("r"))


@query("f27_failure_records", "attempt", sql="""
SELECT attempt_id, CASE outcome WHEN 'failed' THEN 'checksum' WHEN 'busy' THEN concat('archive expands to ', bytes, ' bytes; 5 are free and 9 are held in reserve') WHEN 'ok' THEN 'HTTP Error 503: x | y' ELSE '' END AS said,
  coalesce(outcome = 'failed' AND network = 1, false) OR outcome IN ('busy', 'ok') AS network, CASE WHEN outcome = 'fault' AND bytes > 0 THEN bytes WHEN outcome = 'fault' THEN 0 WHEN outcome = 'busy' THEN bytes END AS short_bytes FROM attempt""")
def f27_records(t: Tables):
    r = F.col("r")
    return failure_details(t).select("attempt_id", F.coalesce(r["text"], F.lit("")).alias("said"), policy.record_network_failure(F.lit("failed"), r).alias("network"), policy.record_disk_short(r).alias("short_bytes"))


@query("f33_download_exclusion", "attempt", sql="""
SELECT attempt_id, CASE outcome WHEN 'failed' THEN 'bad_format' WHEN 'fault' THEN 'download_exclude' END AS reason, CASE outcome WHEN 'failed' THEN concat('[{"n":', bytes, '}]') WHEN 'fault' THEN '[]' END AS inputs FROM attempt""")
def f33_exclusion(t: Tables):
    x = policy.download_exclusion(F.col("r"))
    return failure_details(t).select("attempt_id", x["reason"].alias("reason"), x["inputs"].alias("inputs"))
