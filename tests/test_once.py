"""Expensive rules run once, however often their result is read, and leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from cairnsift.operators import catalogue, checks, duplicates, labelling, matching, spec
from cairnsift.plans import accession
from cairnsift.session import RELEASE, stored
from tests.util import rows


def plan(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def items(spark):
    frame = spark.createDataFrame([("run1/a_pos.raw",), ("run2/a_neg.raw",), ("run3/c.raw",)], "path string").withColumn("item_id", F.col("path"))
    return labelling.apply_groups(frame, [("p", F.col("path").rlike("_pos")), ("r", F.col("path").rlike("^run[12]")), ("none", F.col("path").rlike("zzz"))])


def test_coverage_reads_stored_labels(spark):
    got = labelling.coverage_findings(items(spark), ["p", "r", "none"], "MEMBER")
    assert "RLIKE" not in plan(got).upper()
    assert sorted(map(tuple, got.collect())) == [("X-EMPTY-GROUP", "none", ""), ("X-OVERLAP-MEMBER", "run1/a_pos.raw", "p,r"), ("X-UNCOVERED-MEMBER", "run3/c.raw", "")]


def test_twin_keys_are_never_null(spark):
    """A key that may be null gets a test for null in one of its two readings, and both are worked out."""
    members = spark.createDataFrame([("a/x.raw", "AA", 4096), ("b/y.raw", "AA", 4096), (None, "AA", 4096)], "path string, crc32 string, size long")
    groups = duplicates.content_groups(members)
    assert not groups.schema["member_key"].nullable
    assert sorted((r.member_key, r.members) for r in groups.collect()) == [("a/x.raw", 2), ("b/y.raw", 2)]


def test_top_findings_reads_stored_findings(spark):
    found = spark.range(9).select(F.lit("T").alias("check_id"), F.lit("error").alias("severity"), F.lit("U").alias("unit_id"), F.col("id").cast("string").alias("subject"), F.lit("m").alias("message"))
    got = checks.top_findings(found.where(F.col("subject").rlike("[0-7]")), 2)
    assert "RLIKE" not in plan(got).upper()
    assert [(r.subject, r.position, r.total) for r in got.orderBy("position").collect()] == [("0", 1, 8), ("1", 2, 8)]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def test_a_stored_step_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(RELEASE)
    got = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and got.count() == 7 and spark.conf.get(RELEASE) == setting


def test_catalogue_findings_are_stored_by_part(spark):
    document = spark.createDataFrame([("u", "ready", "positive", "RP", "DDA", None, "1.3.0", 1)], "unit_id string, status string, ion_mode string, chromatography string, acquisition_mode string, exclusion_reason string, skill_version string, catalog_row_count int")
    item = spark.createDataFrame([("u", "row", 0, "a.raw", "r/a.raw", "negative", "RP", "DDA", "declared", "high", None, "sample", "catalog_row", "size", "x")],
                                 "unit_id string, kind string, row_index bigint, raw_file string, member_path string, ion_mode string, chromatography string, acquisition_mode string, basis string, confidence string, reason string, role string, source string, field string, value string")
    none = spark.createDataFrame([], "unit_id string, flag_no bigint, code string, row_indices array<bigint>, member_paths array<string>")
    got = catalogue.evaluate({"documents": document, "items": item.where(F.col("raw_file").rlike("a")), "flags": none, "questions": none, "children": spark.createDataFrame([], "unit_id string, child_key string"),
                              "listing": spark.createDataFrame([("r/b.raw", "AA", 4096)], "path string, crc32 string, size bigint")})
    text = plan(got)
    assert "Join" not in text and "Aggregate" not in text and "RLIKE" not in text.upper()
    assert {("T-POL", "other_polarity"), ("T-MEMBER", "not_listed")} <= set(rows(got, "check_id", "message"))


def test_verdict_moves_counts_not_findings(spark):
    found = spark.range(50).select(F.lit("u").alias("unit_id"), F.when(F.col("id") < 3, "error").when(F.col("id") < 9, "note").otherwise("hold").alias("severity"))
    units = spark.createDataFrame([("u", "a"), ("v", "a"), ("w", None)], "unit_id string, accession string")
    got = checks.verdict(found, units)
    assert "Aggregate [unit_id" in plan(got).split("Join LeftOuter")[1]
    assert rows(got) == [("a", "u", "error", 3, 41), ("a", "v", "pass", 0, 0), ("a", None, "error", 3, 41), (None, "w", "pass", 0, 0), (None, None, "pass", 0, 0)]


def test_top_findings_does_not_store_twice(spark, monkeypatch):
    found = stored(spark.range(9).select(F.lit("T").alias("check_id"), F.lit("U").alias("unit_id"), F.col("id").cast("string").alias("subject"), F.lit("m").alias("message")))
    monkeypatch.setattr(checks, "stored", None)
    assert rows(checks.top_findings(found, 1, kept=True), "subject", "position", "total") == [("0", 1, 9)]


def test_two_children_need_no_second_shuffle(spark):
    children = spark.createDataFrame([("u", "a", "k"), ("u", "b", "k"), ("u", "a", "l"), ("u", "a", "l"), ("u", None, "m")], "unit_id string, child_key string, key string")
    got = matching.child_members(spark.createDataFrame([("u", "k"), ("u", "l"), ("u", "m"), ("u", "n"), ("v", "n")], "unit_id string, key string"), children)
    assert "distinct" not in plan(got)
    assert rows(got) == [("u", "k", "in_two_children"), ("u", "n", "kept_in_no_child")]


def test_archive_findings_are_stored_by_kind(spark):
    listing = spark.createDataFrame([("A", "x.raw", "AA", 4096), ("A", "b/x.raw", "AA", 4096), ("A", "c/y.raw", "BB", 4096)], "accession string, path string, crc32 string, size bigint")
    items = spark.createDataFrame([("A", "u", None, "x.raw", None), ("A", "u", "b/x.raw", "other.raw", None), ("A", "u", None, "gone.raw", None)],
                                  "accession string, unit_id string, member_path string, raw_file string, reason string")
    got = accession.archive_findings(listing.where(F.col("path").rlike("raw")), items)
    text = plan(got)
    assert "Join" not in text and "Aggregate" not in text and "RLIKE" not in text.upper()
    assert rows(got, "unit_id", "subject", "message") == [("u", "b/x.raw", "byte_identical"), ("u", "raw:gone", "unresolved"), ("u", "x.raw", "byte_identical"), (None, "c/y.raw", "loose_member")]


def test_accession_verdict_stores_no_finding_twice(spark, monkeypatch):
    found = spark.createDataFrame([("A", "T", "error", "u", "k", "m"), ("A", "T", "hold", None, "l", "m")], "accession string, check_id string, severity string, unit_id string, subject string, message string")
    monkeypatch.setattr(accession, "archive_findings", lambda *_: found)
    monkeypatch.setattr(accession, "stored", None)
    units = spark.createDataFrame([("u", "A")], "unit_id string, accession string")
    got = accession.accession_verdict(found.select("accession"), found.select("unit_id"), units)
    assert rows(got, "unit_id", "verdict", "errors", "holds") == [("u", "error", 1, 0), (None, "error", 1, 1)]


KEYED = "unit_id string, kind string, row_index bigint, key string, resolved boolean, reason string, ion_mode string, chromatography string"
NAMED = "unit_id string, flag_no bigint, code string, row_indices array<bigint>, member_paths array<string>"


def copies(spark):
    keyed = spark.createDataFrame([("u", "row", 0, "a/x.raw", True, None, "positive", "RP"), ("u", "row", 1, "a/lone.raw", True, None, "positive", "RP"), ("v", "row", 0, "b/x.raw", True, None, "positive", "RP")], KEYED)
    groups = spark.createDataFrame([("a/x.raw", "g", 2), ("b/x.raw", "g", 2)], "member_key string, group_id string, members bigint")
    return keyed.where(F.col("key").rlike("raw")), groups


def test_copies_read_only_items_with_twins(spark):
    keyed, groups = copies(spark)
    assert rows(duplicates.twin_items(keyed, groups), "unit_id", "key") == [("u", "a/x.raw"), ("v", "b/x.raw")]
    facts = spark.createDataFrame([("u", "ready", []), ("v", "ready", [])], "unit_id string, status string, flags array<string>")
    none = spark.createDataFrame([], NAMED)
    got = duplicates.t_dup(facts, keyed, groups, none, none, none.select("unit_id", "code"))
    assert "RLIKE" not in plan(got).upper() and "Join" not in plan(got)
    assert rows(got, "unit_id", "subject", "message") == [("u", "a/x.raw", "shared_unflagged"), ("v", "b/x.raw", "shared_unflagged")]


def test_flags_read_only_items_with_twins(spark):
    """A flag that names a row without a twin still names something, so the unit's own files are not its subject."""
    keyed, groups = copies(spark)
    flags = spark.createDataFrame([("u", 1, "shared_content", [1], []), ("u", 2, "shared_content", [0], []), ("v", 1, "shared_content", [], [])], NAMED)
    got = spec.dup_nokept(flags, spark.createDataFrame([], NAMED), keyed, groups)
    assert "RLIKE" not in plan(got).upper()
    assert rows(got, "unit_id", "subject", "message") == [("u", "1", "no_copy_at_all")]
