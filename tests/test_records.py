"""Nested failure records, redaction at any depth, and codes gathered along a lineage."""

import json

from pyspark.sql import functions as F

from cairnsift.functions import policy, text, tokens
from cairnsift.operators import logs
from tests.util import one, rows


def record(spark, detail):
    r = spark.createDataFrame([(detail,)], "d string").select(policy.failure_record(F.col("d")).alias("r"))
    return r.select("r.*", policy.record_network_failure(F.lit("failed"), F.col("r")).alias("network"), policy.record_disk_short(F.col("r")).alias("short"),
                    policy.download_exclusion(F.col("r")).alias("exclusion")).first()


def test_failure_records(spark):
    r = record(spark, json.dumps({"error": "a", "reason": "", "failure": {"detail": "b", "error_type": "TimeoutError"}}))
    assert (r["text"], r["types"], r["network"], r["short"]) == ("a | b", ["TimeoutError"], True, None)
    short = {"archive_failure": {"reason": "insufficient_disk_space", "detail": {"declared_bytes": 7}}}
    assert record(spark, json.dumps({"failure": short}))["short"] == 7
    short["archive_failure"]["detail"]["declared_bytes"] = True
    assert record(spark, json.dumps({"failure": short}))["short"] == 0
    assert record(spark, json.dumps({"failure": {"retryable": "true"}}))["network"] is False
    assert record(spark, json.dumps({"failure": {"retryable": True}}))["network"] is True
    x = record(spark, json.dumps({"failure": {"disposition": {"decision": "exclude", "reason": " ", "inputs": [{"a": [1]}]}}}))["exclusion"]
    assert (x["reason"], x["inputs"]) == ("download_exclude", '[{"a":[1]}]')
    assert record(spark, json.dumps({"failure": {"disposition": {"decision": "keep"}}}))["exclusion"] is None
    for nothing in (None, "no json", "[1]", "3"):
        r = record(spark, nothing)
        assert r["network"] is False and r["short"] is None and r["exclusion"] is None


def test_redaction_at_any_depth(spark):
    value = {"a": ["C:\\lib\\main.msp", {"k c:/LIB/x": ["C:\\\\lib\\\\main.msp", None, 3.5, {"b": "c:/lib"}]}], "é": "D:\\other"}
    got = one(spark, text.redact_json("v", {"main": "C:\\lib\\main.msp"}), v=json.dumps(value))
    assert json.loads(got) == {"a": ["<library:main>", {"k <library-directory>/x": ["<library:main>", None, 3.5, {"b": "<library-directory>"}]}], "é": "D:\\other"}
    assert one(spark, text.redact_json("v", {"main": "/x/y"}), v="no json") is None


def test_codes_gather_along_a_lineage(spark):
    tree = spark.createDataFrame([(i, i - 1 if i % 10 else None) for i in range(40)] + [(100, 101), (101, 100)], "id bigint, supersedes bigint")
    marks = spark.createDataFrame([(3, "a"), (7, "b"), (3, "b"), (15, "a"), (100, "a")], "id bigint, code string")
    got = {r.id: sorted(r.codes) for r in logs.Lineage(tree).gathered(marks).collect()}
    want = {i: sorted(({"a", "b"} if 3 <= i % 10 or i % 10 >= 3 else set()) if i < 10 else ({"a"} if 15 <= i < 20 else set())) for i in range(40)}
    assert got == want


def test_a_problem_of_a_name_is_read_once_and_right(spark):
    f = lambda n, m: one(spark, tokens.acquisition_problem("n", "m"), n=n, m=m)
    assert f("x_MRM_DDA.raw", "DDA") == "targeted:MRM" and f("x_DIA.raw", "DDA") == "mode:DIA" and f("x_SWATH.raw", "DIA") is None
    assert f("x_MSMS.raw", "MS1") == "product_ions:MSMS" and f("x.raw", "DDA") is None and f("x_DDA.raw", "targeted_DDA") is None and f("fileDDA.raw", "DIA") == "mode:DDA"
