"""The check catalogue, findings on copies with all outcomes, session logs, and the labelling spec."""

from pyspark.sql import functions as F

from cairnsift.operators import catalogue, checks, duplicates, ledger, logs, matching, spec, transcripts
from tests.util import rows

KEYED = "unit_id string, kind string, row_index bigint, key string, resolved boolean, reason string, ion_mode string, chromatography string"
FLAG = "unit_id string, flag_no bigint, code string, row_indices array<bigint>, member_paths array<string>"


def kept(unit, key, ion="positive"):
    return (unit, "row", 0, key, True, None, ion, "RP")


def dup(spark, keyed, groups, flags=(), questions=(), status="ready", answered=()):
    k = spark.createDataFrame(keyed, KEYED)
    g = spark.createDataFrame(groups, "member_key string, group_id string, members bigint")
    codes = {}
    for u, _, code, *_ in flags:
        codes.setdefault(u, set()).add(code)
    facts = spark.createDataFrame([(u, status, sorted(codes.get(u, ()))) for u in sorted({x[0] for x in keyed})], "unit_id string, status string, flags array<string>")
    found = duplicates.t_dup(facts, k, g, spark.createDataFrame(list(flags), FLAG), spark.createDataFrame(list(questions), FLAG), spark.createDataFrame(list(answered), "unit_id string, code string"))
    return rows(found, "unit_id", "subject", "severity", "message")


def test_copies_and_their_outcomes(spark):
    groups = [("a/x.raw", "g1", 2), ("b/x.raw", "g1", 2), ("a/y.raw", "g2", 2), ("old/y.raw", "g2", 2), ("a/z.raw", "g3", 2), ("a/z2.raw", "g3", 2)]
    # Another unit keeps the twin; a copy in nobody's place; two copies in one unit.
    keyed = [kept("u", "a/x.raw"), kept("v", "b/x.raw"), kept("u", "a/y.raw"), kept("w", "c/z.raw"), kept("t", "a/z.raw"), kept("t", "a/z2.raw")]
    assert dup(spark, keyed, groups) == [
        ("t", "a/z.raw", "error", "shared_unflagged"), ("t", "a/z.raw", "error", "twin_in_unit"), ("t", "a/z2.raw", "error", "twin_in_unit"),
        ("u", "a/x.raw", "error", "shared_unflagged"), ("u", "a/y.raw", "error", "copy_unflagged"), ("v", "b/x.raw", "error", "shared_unflagged")]
    # Flagged: held for a person where the unit is not ready or the question is answered; a noted copy is no finding.
    flags = [("u", 1, "shared_content", [], ["a/x.raw"]), ("u", 2, "duplicate_copies_excluded", [], []), ("v", 1, "shared_content", [], [])]
    got = dup(spark, keyed[:3], groups, flags, status="needs_person")
    assert got == [("u", "a/x.raw", "hold", "waits_for_person"), ("u", "a/y.raw", "hold", "waits_for_person"), ("v", "b/x.raw", "hold", "waits_for_person")]
    assert ("v", "b/x.raw", "hold", "waits_for_person") in dup(spark, keyed[:3], groups, flags, answered=[("v", "shared_content")])
    assert dup(spark, [kept("u", "a/y.raw")], groups, [("u", 2, "duplicate_copies_excluded", [], [])]) == []


def test_a_token_makes_a_copy_another_arms(spark):
    groups = [("a/x_pos.raw", "g", 2), ("old/x_neg.raw", "g", 2)]
    assert dup(spark, [kept("u", "a/x_pos.raw")], groups) == [("u", "a/x_pos.raw", "error", "shared_unflagged")]


def test_subject_of_a_flag(spark):
    """Named files come first, then what the questions name, then the unit's own; own unassigned copies do not count."""
    groups = [("a/x.raw", "g1", 2), ("b/x.raw", "g1", 2), ("a/y.raw", "g2", 2), ("b/y.raw", "g2", 2)]
    keyed = [("u", "excluded_row", 3, "a/x.raw", True, "duplicate_content", "positive", "RP"), ("u", "excluded_row", 4, "a/y.raw", True, "needs_person", "positive", "RP"),
             ("u", "excluded_row", 5, "a/w.raw", True, "shared_content_unassigned", "positive", "RP")]
    named = [("u", 1, "shared_content", [3], [])]
    assert dup(spark, keyed, groups, named) == [("u", "1", "error", "flag_without_keeper")]
    assert dup(spark, keyed, groups, [("u", 1, "shared_content", [], [])]) == []  # y is held for a person
    asked = [("u", 1, "shared_content", [3], [])]
    assert dup(spark, keyed, groups, [("u", 1, "shared_content", [], [])], asked) == [("u", "1", "error", "flag_without_keeper")]
    assert dup(spark, keyed, groups, [("u", 1, "shared_content", [], ["nobody.raw"])]) == [("u", "1", "error", "flag_without_twin")]
    loose = [("a/w.raw", "g3", 2), ("b/w.raw", "g3", 2)]
    assert dup(spark, keyed[2:], loose, [("u", 1, "shared_content", [], [])]) == [("u", "1", "error", "flag_without_keeper")]
    other = [*keyed[2:], ("v", "excluded_row", 0, "b/w.raw", True, "shared_content_unassigned", "positive", "RP")]
    assert ("u", "1", "error", "flag_without_keeper") not in dup(spark, other, loose, [("u", 1, "shared_content", [], [])])
    own = duplicates.unassigned_in_own_arm(spark.createDataFrame(keyed[2:], KEYED), spark.createDataFrame([("u", "positive", "RP")], "unit_id string, ion_mode string, chromatography string"),
                                           spark.createDataFrame([("a/w.raw", "g3", 2), ("old/w.raw", "g3", 2)], "member_key string, group_id string, members bigint"))
    assert rows(own, "unit_id", "message") == [("u", "unassigned_in_own_arm")]


def test_missing_inputs_hold_every_unit(spark):
    documents = spark.createDataFrame([("u",), ("v",)], "unit_id string")
    everything = {n: documents for c in catalogue.CATALOGUE for n in c.needs}
    assert catalogue.not_evaluable(documents, everything).count() == 0
    held = catalogue.not_evaluable(documents, {**everything, "listing": None})
    assert set(rows(held, "check_id", "severity", "unit_id")) == {(c, "hold", u) for c in ("T-MEMBER", "T-UNIQ", "T-DUP") for u in "uv"}
    grid = catalogue.coverage(held, documents, {**everything, "listing": None})
    assert {r.check_id for r in grid.collect()} == {c.id for c in catalogue.CATALOGUE}
    assert {r.check_id for r in grid.where("NOT evaluable").collect()} == {"T-MEMBER", "T-UNIQ", "T-DUP"}
    level = checks.verdict(held, documents.withColumn("accession", F.lit("a")))
    assert {r.verdict for r in level.collect()} == {"hold"}


CALLS = "unit_id string, seq bigint, tool string, arguments string, result string, is_error boolean"


def test_first_call_that_parts(spark):
    log = [("u", i, f"t{i % 3}", str(i), "r", False) for i in range(1, 5001)]
    other = list(log)
    other[3000] = ("u", 3001, "x", "3001", "r", False)
    other[4000] = ("u", 4001, "y", "4001", "r", False)
    a, b = spark.createDataFrame(log, CALLS), spark.createDataFrame(other, CALLS)
    assert rows(transcripts.t_tools_transcript(a, b), "subject", "message") == [("3001", "calls_part_here")]
    swapped = [("u", 1, "t2", "2", "r", False), ("u", 2, "t1", "1", "r", False), *log[2:]]
    assert rows(transcripts.t_tools_transcript(a, spark.createDataFrame(swapped, CALLS)), "subject") == [("1",)]
    assert transcripts.t_tools_transcript(a, a).count() == 0
    assert rows(transcripts.t_tools_transcript(a, b.where("seq <= 10")), "subject") == [("11",)]


def test_unopened_archives_are_the_accessions_own(spark):
    listing = spark.createDataFrame([("A", "x/one.zip"), ("A", "a.raw"), ("B", "b.raw")], "accession string, path string")
    items = spark.createDataFrame([("A", "u", None, "gone.raw", "not_in_archive"), ("A", "u", None, "a.raw", "not_in_archive"), ("B", "v", None, "gone.raw", "not_in_archive")],
                                  "accession string, unit_id string, member_path string, raw_file string, reason string")
    members = matching.index_members(listing, scope=("accession",))
    keyed = matching.item_keys(items, members, ("accession",))
    assert rows(checks.t_unopened(keyed, members, listing), "unit_id", "subject", "message") == [("u", "1", "unopened_archives: 1 (x/one.zip)")]


def test_log_head_follows_the_latest_triage(spark):
    ddl = "file string, line_no bigint, kind string, unit_key string, triage_sha256 string, triage_path string, derived_sha256 string, derived_path string, head_sha256 string, accession string"
    e = spark.createDataFrame([
        ("l", 1, "triage_recorded", "u", "s1", "A\\u.json", None, None, None, None), ("l", 2, "triage_validated", "u", None, None, None, None, "hA", "B"), ("l", 3, "triage_recorded", "u", "s2", "B/u.json", None, None, None, None),
        ("l", 4, "triage_validated", "u", None, None, None, None, "hA", "A"), ("l", 5, "triage_validated", "v", None, None, None, None, "hB", "B"), ("l", 6, "triage_recorded", "w", "c", "h/w.json", "s1", "A/u.json", None, None)], ddl)
    files = spark.createDataFrame([("A/u.json", "s1"), ("B/u.json", "zz"), ("h/w.json", "other")], "path string, sha256 string")
    payloads = spark.createDataFrame([("s1",), ("s2",)], "sha256 string")
    lines = spark.createDataFrame([("A", "hA"), ("B", "hB")], "accession string, sha256 string")
    got = rows(logs.triage_checks(e, payloads, files, lines, width=2), "check_id", "subject", "message")
    assert got == [("D-HEAD", "4", "no_such_line"), ("D-TRIAGE", "3", "other_digest"), ("D-TRIAGE", "6", "child_differs")]


def test_an_excluded_units_fetch_ends_a_streak(spark):
    ddl = "attempt_id bigint, repository string, group_id string, step string, outcome string, network int, ended_us bigint, excluded boolean"
    log = [(1, "r", "a", "download", "failed", 1, 9, None), (2, "r", "b", "download", "blocked", 0, 9, True), (3, "r", "c", "download", "failed", 1, 9, None), (4, "r", "d", "download", "failed", 1, None, None)]
    assert rows(ledger.outage_streaks(spark.createDataFrame(log, ddl))) == [("r", "c")]
    log[1] = (2, "r", "b", "download", "blocked", 0, 9, False)
    assert rows(ledger.outage_streaks(spark.createDataFrame(log, ddl))) == [("r", "a"), ("r", "c")]


def test_exceptions_are_single_items(spark):
    e = spark.createDataFrame([("e1", ["u"], 1, None, None), ("e2", [], 1, None, None), ("e3", [], None, "S", None), ("e4", ["v"], None, "S", "f2")],
                              "rule_id string, units array<string>, row_index bigint, sample_id string, raw_file string")
    r = spark.createDataFrame([("u", 1, "S", "f1"), ("u", 2, "S", "f2"), ("v", 1, "S", "f1"), ("v", 2, "S", "f2")], "unit_id string, row_index bigint, sample_id string, raw_file string")
    assert rows(spec.row_exceptions(e, r), "unit_id", "subject", "message") == [("u", "e3", "covers_2"), ("v", "e3", "covers_2"), (None, "e2", "index_without_one_unit")]
    assert rows(spec.covered(e, r).where("rule_id = 'e4'")) == [("e4", "v", 2)]
