"""Agreement metrics over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairnsift.functions import names
from cairnsift.operators import metrics
from cairnsift.queries import duck
from cairnsift.queries.checks import ALL_SQL, FACTS, FACT_SHAPES, all_findings
from cairnsift.queries.registry import Tables, query


def _scope(s: str, inside: str) -> str:
    return f"""count(*) FILTER (m_{s}) AS {s}_matched, count(*) FILTER (m_{s} AND p) AS {s}_with_predicted, count(*) FILTER (c_{s}) AS {s}_comparable,
  count(*) FILTER (c_{s} AND list_contains(k_{s}, top)) AS {s}_top, count(*) FILTER (c_{s} AND len(list_intersect(k_{s}, pk)) > 0) AS {s}_any,
  round(count(*) FILTER (c_{s} AND list_contains(k_{s}, top)) / nullif(count(*) FILTER (c_{s}), 0), 4) AS {s}_top_rate,
  round(count(*) FILTER (c_{s} AND len(list_intersect(k_{s}, pk)) > 0) / nullif(count(*) FILTER (c_{s}), 0), 4) AS {s}_any_rate"""


@query("a6_concordance", "candidate", ctes="""fe AS (SELECT feature, bool_or(annotator_id = 'R' AND is_representative = 1) AS rep, bool_or(annotator_id = 'R') AS p,
    min_by(substr(structure_key, 1, 14), (candidate_rank, position)) FILTER (annotator_id = 'R') AS top, list(DISTINCT substr(structure_key, 1, 14)) FILTER (annotator_id = 'R') AS pk,
    bool_or(annotator_id = 'A' AND is_reference_matched = 1) AS m_strict, bool_or(annotator_id IN ('A', 'N') AND is_reference_matched = 1) AS m_acquired,
    list(DISTINCT substr(structure_key, 1, 14)) FILTER (annotator_id = 'A' AND is_reference_matched = 1) AS k_strict,
    list(DISTINCT substr(structure_key, 1, 14)) FILTER (annotator_id IN ('A', 'N') AND is_reference_matched = 1) AS k_acquired FROM candidate GROUP BY 1),
fx AS (SELECT *, m_strict AND p AS c_strict, m_acquired AND p AS c_acquired FROM fe)""", sql=f"""
SELECT count(*) AS features, count(*) FILTER (rep) AS representatives, {_scope('strict', '')}, {_scope('acquired', '')} FROM fx""")
def a6(t: Tables):
    c = t["candidate"].withColumn("is_reference_matched", F.col("is_reference_matched") == 1).withColumn("is_representative", F.col("is_representative") == 1)
    return metrics.concordance(c, ["A", "N"], ["R"])


@query("w11_representative_candidate", "candidate", sql="""
SELECT feature, annotator_id, min_by(structure_key, (candidate_rank, position, structure_key)) AS structure_key, min_by(candidate_rank, (candidate_rank, position)) AS candidate_rank, min_by(position, (candidate_rank, position)) AS position
FROM candidate GROUP BY 1, 2""")
def w11(t: Tables):
    return metrics.representative_candidate(t["candidate"])


@query("a7_score_keys", "item", sql=f"""
SELECT * FROM (WITH tr AS (SELECT unit_id, {duck.key('member_path')} AS k, lower({duck.base('member_path')}) AS n, lower({duck.stem('member_path')}) AS s FROM item WHERE member_path IS NOT NULL AND confidence <> 'low'),
  nm AS (SELECT unit_id, x, min(k) AS k FROM (SELECT unit_id, n AS x, k FROM tr UNION ALL SELECT unit_id, s, k FROM tr) GROUP BY 1, 2)
SELECT i.unit_id, coalesce({duck.key('i.member_path')}, CASE WHEN i.raw_file IN ('f1.raw', 'f2.raw') THEN 'fixed/one.raw' END, a.k, b.k, concat('raw:', lower({duck.base('i.raw_file')}))) AS key, count(*) AS n
FROM item i LEFT JOIN nm a ON a.unit_id = i.unit_id AND a.x = lower({duck.base('i.raw_file')}) LEFT JOIN nm b ON b.unit_id = i.unit_id AND b.x = lower({duck.stem('i.raw_file')}) WHERE reason IS NULL GROUP BY 1, 2)""")
def a7_keys(t: Tables):
    i = t["item"]
    overrides = t["part"].where("p_partkey IN (1, 2)").select(F.concat(F.lit("f"), "p_partkey", F.lit(".raw")).alias("raw_file"), F.lit("fixed\\One.raw").alias("path"))
    truth = i.where("member_path IS NOT NULL AND confidence <> 'low'").select("unit_id", F.col("member_path").alias("path"))
    return metrics.score_keys(i.where("reason IS NULL"), overrides, truth).groupBy("unit_id", "key").agg(F.count("*").alias("n"))


@query("a7_score", "item", sql="""
SELECT * FROM (WITH k AS (SELECT DISTINCT unit_id, member_path AS key FROM item WHERE reason IS NULL AND member_path IS NOT NULL AND member_path NOT LIKE 'run50/%'),
  t AS (SELECT DISTINCT unit_id, member_path AS key FROM item WHERE confidence <> 'low' AND member_path IS NOT NULL), h AS (SELECT DISTINCT unit_id, member_path AS key FROM item WHERE reason IN ('needs_person', 'shared_content_unassigned') AND member_path IS NOT NULL),
  a AS (SELECT coalesce(k.unit_id, t.unit_id) AS unit_id, coalesce(k.key, t.key) AS key, k.key IS NOT NULL AS ik, t.key IS NOT NULL AS it FROM k FULL JOIN t ON k.unit_id = t.unit_id AND k.key = t.key)
SELECT unit_id, count(*) FILTER (ik AND it) AS correct, count(*) FILTER (ik AND NOT it) AS wrong_included, count(*) FILTER (it AND NOT ik AND h.key IS NULL) AS wrongly_left_out,
  count(*) FILTER (it AND NOT ik AND h.key IS NOT NULL) AS held_for_person FROM a LEFT JOIN h USING (unit_id, key) GROUP BY 1)""")
def a7(t: Tables):
    i = t["item"].where("member_path IS NOT NULL").withColumn("key", F.col("member_path"))
    return metrics.score(i.where("reason IS NULL"), i.where("confidence <> 'low'"), i.where("reason IN ('needs_person', 'shared_content_unassigned')"),
                         i.where("member_path LIKE 'run50/%'"))


LABELS = "lb AS (SELECT source, lang, CAST(quality AS VARCHAR) AS a, CASE WHEN n_chars > 800 AND lang <> 'de' THEN '1' ELSE '0' END AS b FROM doc JOIN labels USING (doc_id))"


def label_pairs(t: Tables):
    d = t["doc"].join(t["labels"], "doc_id")
    return d.select("source", "lang", F.col("quality").cast("string").alias("a"), F.when((F.col("n_chars") > 800) & (F.col("lang") != "de"), "1").otherwise("0").alias("b"))


def _kappa(group: str) -> str:
    g = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""SELECT {g}n, round(same / n, 4) AS agreement, CASE WHEN labels > 1 AND pp / (n * n) < 1 THEN round((same / n - pp / (n * n)) / (1 - pp / (n * n)), 4) END AS kappa FROM (
  SELECT {g}count(*)::DOUBLE AS n, count(*) FILTER (a = b) AS same, count(*) FILTER (a = '1')::DOUBLE * count(*) FILTER (b = '1') + count(*) FILTER (a = '0')::DOUBLE * count(*) FILTER (b = '0') AS pp,
    CASE WHEN count(*) FILTER (a = '1' OR b = '1') > 0 THEN 1 ELSE 0 END + CASE WHEN count(*) FILTER (a = '0' OR b = '0') > 0 THEN 1 ELSE 0 END AS labels FROM lb {by})"""


@query("a8_agreement", "doc", ctes=LABELS, sql="SELECT source, CAST(n AS BIGINT) AS n, agreement, kappa FROM (" + _kappa("source") + ")")
def a8(t: Tables):
    return metrics.agreement(label_pairs(t), "source")


@query("a8_agreement_pooled", "doc", ctes=LABELS, sql="SELECT CAST(n AS BIGINT) AS n, agreement, kappa FROM (" + _kappa("") + ")")
def a8_pooled(t: Tables):
    return metrics.agreement(label_pairs(t))


@query("a8_agreement_spread", "doc", ctes=LABELS, sql="SELECT round(median(kappa), 6) AS median, min(kappa) AS lowest, max(kappa) AS highest, count(kappa) AS counted, count(*) - count(kappa) AS undefined FROM (" + _kappa("source") + ")")
def a8_spread(t: Tables):
    return metrics.spread(metrics.agreement(label_pairs(t), "source"), "kappa")


@query("a9_set_agreement", "item", sql="""
SELECT * FROM (WITH a AS (SELECT DISTINCT unit_id, sample_id AS key FROM item WHERE reason IS NULL), b AS (SELECT DISTINCT unit_id, sample_id AS key FROM item WHERE confidence <> 'low'),
  u AS (SELECT coalesce(a.unit_id, b.unit_id) AS unit_id, a.key IS NOT NULL AND b.key IS NOT NULL AS both_ FROM a FULL JOIN b ON a.unit_id = b.unit_id AND a.key = b.key)
SELECT unit_id, round(count(*) FILTER (both_) / count(*), 4) AS jaccard, count(*) FILTER (both_) = count(*) AS identical FROM u GROUP BY 1)""")
def a9(t: Tables):
    i = t["item"].withColumn("key", F.col("sample_id"))
    return metrics.set_agreement(i.where("reason IS NULL"), i.where("confidence <> 'low'"))


@query("a10_catch_rate", *FACT_SHAPES, ctes=FACTS, sql=f"""
SELECT count(*) AS wrong, count(*) FILTER (unit_id IN (SELECT unit_id FROM ({ALL_SQL}) WHERE severity IN ('error', 'hold'))) AS caught,
  round(count(*) FILTER (unit_id IN (SELECT unit_id FROM ({ALL_SQL}) WHERE severity IN ('error', 'hold'))) / count(*), 4) AS rate FROM item WHERE reason IS NULL AND confidence = 'low'""")
def a10(t: Tables):
    wrong = t["item"].where("reason IS NULL AND confidence = 'low'").select("unit_id", F.col("sample_id").alias("key"))
    return metrics.catch_rate(wrong, all_findings(t))


@query("k2_stratified_sample", sql="""
WITH h AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, sha256(concat('seed-1:', o_orderkey)) AS h FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY h) AS r, count(*) OVER (PARTITION BY o_orderstatus, o_orderpriority) AS n, count(*) OVER () AS t FROM h)
SELECT o_orderkey, o_orderstatus, o_orderpriority, r AS rank FROM r WHERE r <= greatest(CAST(ceil(n * greatest(0.1::DOUBLE, least(1.0, 30.0::DOUBLE / t))) AS BIGINT), 3)""")
def k2(t: Tables):
    return metrics.stratified_sample(t["orders"].select("o_orderkey", "o_orderstatus", "o_orderpriority"), "o_orderkey", ["o_orderstatus", "o_orderpriority"], 0.1, 30, 3, "seed-1")


TALLY = """tl AS (SELECT conv_id AS session, count(*) AS turns, count(*) FILTER (role = 'user') AS user_turns, count(*) FILTER (role = 'assistant') AS assistant_turns, count(*) FILTER (role = 'system') AS system_turns,
  count(*) FILTER (length(text) > 400) AS long_turns, count(*) FILTER (regexp_matches(text, '[0-9]')) AS digit_turns FROM conversations GROUP BY 1)"""


def tally(t: Tables):
    c = t["conversations"].withColumnRenamed("conv_id", "session")
    return metrics.tool_tally(c, {"long_turns": F.length("text") > 400, "digit_turns": F.col("text").rlike("[0-9]")})


@query("a25_tool_tally", ctes=TALLY, sql="SELECT * FROM tl")
def a25(t: Tables):
    return tally(t)


@query("t_tools", ctes=TALLY, sql="""
SELECT session, m.measure, CASE m.measure WHEN 'turns' THEN CASE WHEN user_turns > 2 THEN turns + 1 ELSE turns END ELSE 0 END AS stated, CASE m.measure WHEN 'turns' THEN turns ELSE system_turns END AS counted
FROM tl, (VALUES ('turns'), ('system_turns')) m(measure) WHERE (measure = 'turns' AND user_turns > 2) OR (measure = 'system_turns' AND system_turns > 0)""")
def t_tools(t: Tables):
    counted = tally(t)
    stated = counted.select("session", F.when(F.col("user_turns") > 2, F.col("turns") + 1).otherwise(F.col("turns")).alias("turns"), F.lit(0).alias("system_turns"))
    return metrics.tally_check(stated, counted, "session", ["turns", "system_turns"])
