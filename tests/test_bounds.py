"""No length, count or depth at which an operator changes its answer."""

from pyspark.sql import functions as F

from cairnsift.operators import checks, logs, matching, planning, release
from cairnsift.plans import accession
from cairnsift.sources import files
from tests.util import rows

LONG = "x" * 100_050


def test_keys_that_differ_late_stay_apart(spark):
    frame = spark.createDataFrame([("raw:" + LONG + "a",), ("raw:" + LONG + "b",)], "key string")
    assert frame.select(matching.key_stem("key").alias("k")).distinct().count() == 2
    uses = spark.createDataFrame([(LONG + "a", "o1", 5), (LONG + "b", "o1", 5), (LONG + "c", "o2", 7)], "unit_id string, object_id string, size bigint")
    units, _ = planning.download_groups(uses.withColumn("kind", F.lit("file")))
    assert {r.unit_id[-1]: r.group_id[-1] for r in units.collect()} == {"a": "a", "b": "a", "c": "c"}


def test_samples_past_the_first_are_all_read(spark):
    line = "Samples\t" + "\t".join(f"s{i}" for i in range(3000))
    frame = spark.createDataFrame([(1, 1, line)], "doc int, line_no bigint, line string")
    assert files.sample_names(frame, "doc").count() == 3000


def test_library_file_in_a_long_url_is_no_leak(spark):
    url = "https://host.example/" + "a/" * 1500 + "lib.msp"
    texts = [("u.txt", f"see {url} there"), ("p.txt", "see /data/" + "b" * 600 + "/lib.msp there"), ("e.txt", "<external>/lib.msp"), ("n.txt", "a,/lib.msp")]
    got = release.redaction_findings(spark.createDataFrame(texts, "relative_path string, text string"), release.redaction_rules())
    assert rows(got.where("rule = 'library_path'"), "file", "at") == [("n.txt", 2), ("p.txt", 610)]


MEMBERS = "archive string, path string, size bigint, crc32 string"


def listing(spark, *paths):
    return spark.createDataFrame([("z.zip", p, 10 + i, f"{i:08X}") for i, p in enumerate(paths)], MEMBERS)


ITEMS = "unit_id string, kind string, member_path string, raw_file string, reason string"


def test_listed_name_and_folder_come_before_resolution(spark):
    members = matching.index_members(listing(spark, "s1.raw", "other/s1.raw", "b/x9.raw"))
    items = spark.createDataFrame([("u", "row", None, "s1.raw", None), ("u", "row", None, "b\\x9.raw", None), ("u", "row", None, "none.raw", None)], ITEMS)
    got = rows(matching.item_keys(items, members), "raw_file", "key", "resolved")
    assert got == [("b\\x9.raw", "b/x9.raw", True), ("none.raw", "raw:none", False), ("s1.raw", "s1.raw", True)]


def test_absent_but_ambiguous_is_found(spark):
    members = matching.index_members(listing(spark, "a/s1.raw", "b/s1.raw"))
    items = spark.createDataFrame([("u", "excluded_row", None, "s1.raw", "not_in_archive"), ("u", "excluded_row", None, "s2.raw", "not_in_archive")], ITEMS)
    none = members.limit(0).select("member_key")
    got = checks.t_exclusion_listing(matching.item_keys(items, members), members, none)
    assert rows(got, "subject", "message") == [("raw:s1", "listed_after_all")]


def test_loose_member_holds_its_accession(spark):
    items = spark.createDataFrame([("u1", "row", "a/s1.raw", "s1.raw", None)], ITEMS)
    units = spark.createDataFrame([("u1", "A1")], "unit_id string, accession string")
    got = accession.accession_verdict(listing(spark, "a/s1.raw", "a/lost.raw"), items, units)
    assert rows(got, "accession", "unit_id", "verdict", "holds") == [("A1", "u1", "pass", 0), ("A1", None, "hold", 1)]


def test_cycles_end_the_climb(spark):
    chain = [(str(i), str(i - 1) if i else None) for i in range(70)] + [("x", "y"), ("y", "z"), ("z", "x"), ("w", "x")]
    tree = logs.Lineage(spark.createDataFrame(chain, "id string, supersedes string"))
    got = {r.id: (r.root, r.depth, r.cyclic) for r in tree.nodes.collect()}
    assert got["69"] == ("0", 69, False) and got["x"] == got["w"] == (None, None, True)


def test_a_size_that_is_no_number_is_unknown(spark):
    raw = spark.createDataFrame([("a", "12kB", "1"), ("b", "", "2"), ("c", "7", "3")], "path string, size string, crc32 string")
    assert rows(files.clean_listing(raw), "path", "size") == [("a", None), ("b", 0), ("c", 7)]


def test_items_with_a_member_path_are_not_joined(spark):
    """They are their own answer; members that are accounted for are taken out before the rest is moved."""
    items = spark.createDataFrame([("A/x.raw", "x"), (None, "y.raw"), ("", "z")], "member_path string, raw_file string")
    listing = spark.createDataFrame([("a/x.raw",), ("b/y.raw",), ("b/w.raw",), ("c/z.raw",)], "path string")
    members = matching.index_members(listing)
    keyed = matching.item_keys(items, members)
    assert rows(keyed, "key", "resolved") == [("a/x.raw", True), ("b/y.raw", True), ("c/z.raw", True)]
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "Join" not in plan.split("+- Project")[0]
    loose = matching.loose_members(listing, items)
    assert rows(loose) == [("b/w.raw",)]
    assert "Generate" not in loose._jdf.queryExecution().optimizedPlan().toString()


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_two_sides_are_one_aggregate(spark):
    """no join holds both sides in a task; a null key still equals nothing."""
    from cairnsift.operators import invariants
    d = spark.createDataFrame([("u", "k", 1), ("u", "k", 1), ("u", "k", 0), ("u", None, 5), ("u", "n", None)], "unit_id string, key string, energy int")
    e = spark.createDataFrame([("u", "k", 1), ("u", "k", 3), ("u", None, 5), ("u", "n", None)], "unit_id string, key string, energy int")
    got = invariants.energy_sets(d, e)
    assert "Join" not in plan_of(got)
    assert sorted((r.key or "", r.missing, r.extra, r.zero) for r in got.collect()) == [("", 1, 1, 0), ("k", 1, 1, 1), ("n", 1, 1, 0)]
    p = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", None), (None, "a")], "scope string, path string")
    q = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", None), ("s", None), (None, "a")], "scope string, path string")
    got = invariants.partition_check(p, q, "scope", "path")
    assert "Join" not in plan_of(got)
    assert sorted((r.scope or "", r.missing, r.extra, r.repeated) for r in got.collect()) == [("", 1, 1, 0), ("s", 2, 3, 2)]


def test_groups_shuffle_objects_and_not_uses(spark):
    """units are stored, and an object is placed by one of its units."""
    from cairnsift.operators import planning
    uses = spark.createDataFrame([("o1", "u1"), ("o1", "u2"), ("o2", "u2"), ("o3", "u3"), (None, "u3"), ("o4", None), ("o4", "u4")], "object_id string, unit_id string").withColumn(
        "kind", F.lit("file")).withColumn("size", F.lit(7).cast("bigint"))
    units, groups = planning.download_groups(uses)
    assert "Exchange" not in plan_of(units)
    assert plan_of(groups).count("Join") <= 2
    assert sorted((r.group_id, r.object_count, r.known_bytes, r.shared_object_count, r.unit_count) for r in groups.collect()) == [
        ("u1", 2, 14, 1, 2), ("u3", 1, 7, 0, 1), ("u4", 1, 7, 1, 1)]
