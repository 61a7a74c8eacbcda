from pyspark.sql import functions as F

from cairnsift.operators import checks, duplicates, invariants, labelling, ledger, logs, matching, metrics, planning, release, store
from tests.util import rows


def listing(spark, *members):
    return spark.createDataFrame([(p, s, c) for p, s, c in members], "path string, size bigint, crc32 string")


def test_resolution_tiers(spark):
    members = matching.index_members(listing(spark, ("a/S1.raw", 1, ""), ("b/S2.mzML", 1, ""), ("b/S2.mzXML", 1, ""), ("c/S3.raw", 1, ""), ("d/S3.raw", 1, ""),
                                            ("e/S4.d/x", 1, ""), ("notes.txt", 1, "")))
    names = spark.createDataFrame([(n,) for n in ("S1.raw", "s2", "S3.raw", "S4", "S9.raw", "", "S2.mzXML")], "raw_file string")
    got = {r["raw_file"]: (r["kind"], r["member_key"], r["candidates"]) for r in matching.resolve(names, members).collect()}
    assert got == {"S1.raw": ("exact", "a/s1.raw", 1), "s2": ("stem", "b/s2.mzml", 1), "S3.raw": ("ambiguous", None, 2), "S4": ("stem", "e/s4.d", 1),
                   "S9.raw": ("none", None, 0), "": ("none", None, 0), "S2.mzXML": ("exact", "b/s2.mzxml", 1)}
    found = matching.candidates(matching.resolve(names, members), members)
    assert rows(found) == [("s3.raw", "c/s3.raw"), ("s3.raw", "d/s3.raw")]


def test_content_groups_files_and_folders(spark):
    m = listing(spark, ("a/x.raw", 2000, "AA"), ("b/y.raw", 2000, "AA"), ("b/z.raw", 500, "BB"), ("c/w.raw", 500, "BB"), ("t/n.txt", 2000, "AA"),
                ("p/one.d/m/1", 5, "C1"), ("p/one.d/m/2", 6, "C2"), ("q/two.d/m/2", 6, "C2"), ("q/two.d/m/1", 5, "C1"), ("r/three.d/m/1", 5, "C1"))
    got = rows(duplicates.content_groups(m), "member_key", "members")
    assert got == [("a/x.raw", 2), ("b/y.raw", 2), ("p/one.d", 2), ("q/two.d", 2)]


def test_a_content_held_by_many_members_stays_one_group(spark):
    m = spark.range(3000).select(F.concat(F.lit("f"), "id", F.lit(".raw")).alias("path"), F.lit(5000).cast("bigint").alias("size"), F.lit("DD").alias("crc32"))
    g = duplicates.content_groups(m)
    assert g.count() == 3000 and g.select("group_id").distinct().count() == 1


def test_other_arm_ignores_the_holder_itself(spark):
    groups = spark.createDataFrame([("a/x_pos.raw", "g"), ("b/x_neg.raw", "g"), ("a/y.raw", "h"), ("bak/y.raw", "h")], "member_key string, group_id string")
    holders = spark.createDataFrame([("U1", "a/x_pos.raw", "positive", "RP"), ("U1", "a/y.raw", "positive", "RP")], "unit_id string, key string, ion_mode string, chromatography string")
    placed = spark.createDataFrame([("U1", "a/x_pos.raw"), ("U1", "a/y.raw"), ("U2", "b/other.raw")], "unit_id string, key string")
    assert rows(duplicates.other_arm(holders, groups, placed), "key", "by_folder", "by_token") == [("a/x_pos.raw", True, True), ("a/y.raw", False, False)]


def test_same_file_uses_stems_only_for_unresolved(spark):
    schema = "unit_id string, id string, key string, resolved boolean"
    left = spark.createDataFrame([("U", "1", "a/s1.raw", True), ("U", "2", "a/s2.raw", True), ("V", "3", "raw:s2", False)], schema)
    right = spark.createDataFrame([("U", "x", "b/s1.raw", True), ("U", "y", "raw:s2", False), ("V", "z", "c/s2.raw", True)], schema)
    assert rows(matching.same_file(left, right, ["unit_id"], "id")) == [("2",), ("3",)]


def test_reconcile_folds_repeated_keys(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (3, "x"), (4, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (5, "x"), (4, None)], "k int, v string")
    assert rows(matching.reconcile(a, b, ["k"], ["v"]), "k", "result") == [(1, "equal"), (2, "changed"), (3, "duplicate"), (4, "equal"), (5, "missing_left")]


def test_verdict_orders_levels_and_ignores_notes(spark):
    f = spark.createDataFrame([("C", "note", "U1", "s", "m"), ("C", "hold", "U2", "s", "m"), ("C", "error", "U3", "s", "m"), ("C", "hold", "U3", "s", "m")],
                              "check_id string, severity string, unit_id string, subject string, message string")
    u = spark.createDataFrame([("U1", "A"), ("U2", "A"), ("U3", "B"), ("U4", "C")], "unit_id string, accession string")
    got = {(r["accession"], r["unit_id"]): r["verdict"] for r in checks.verdict(f, u).collect()}
    assert got == {("A", "U1"): "pass", ("A", "U2"): "hold", ("A", None): "hold", ("B", "U3"): "error", ("B", None): "error", ("C", "U4"): "pass", ("C", None): "pass"}


def test_absence_never_passes(spark):
    u = spark.createDataFrame([("U1",)], "unit_id string")
    assert [r["severity"] for r in checks.not_evaluable(u, "T-DUP", "no listing").collect()] == ["hold"]
    counts = spark.createDataFrame([("U1", "a", 3, False)], "unit_id string, source string, n int, run_level boolean")
    assert [r["status"] for r in invariants.count_agreement(counts).collect()] == ["not_evaluable"]
    nothing = counts.where("false")
    assert invariants.count_agreement(nothing).count() == 0


def attempts(spark, *log):
    return spark.createDataFrame([(i, "R", g, s, o, n) for i, (g, s, o, n) in enumerate(log)], "attempt_id bigint, repository string, group_id string, step string, outcome string, network int")


def test_outage_streaks(spark):
    # g1 failed before the last finished download and never recovered; g2 and g3 are new failures; g4 recovered in between.
    a = attempts(spark, ("g1", "download", "failed", 1), ("g4", "download", "failed", 1), ("g4", "download", "ok", 0), ("g1", "download", "failed", 1), ("g2", "download", "failed", 1),
                 ("g3", "download_start", "failed", 1), ("g4", "download", "failed", 1), ("g5", "download", "interrupted", 0), ("g2", "download_start", "ok", 0))
    assert rows(ledger.outage_streaks(a), "group_id") == [("g2",), ("g3",), ("g4",)]
    other = attempts(spark, ("g1", "download", "failed", 1), ("g2", "download", "failed", 0))
    assert ledger.outage_streaks(other).count() == 0


def test_retry_schedule_counts_interruptions_past_the_budget(spark):
    log = ["failed"] + ["interrupted"] * 6 + ["failed"]
    a = spark.createDataFrame([("u", i, o, i * 10) for i, o in enumerate(log)], "unit_key string, attempt_id bigint, outcome string, ended_us bigint")
    got = rows(ledger.retry_schedule(a, width=2), "attempt_id", "failures", "terminal", "delay_seconds")
    assert got == [(0, 1, False, 600), (6, 2, False, 3600), (7, 3, True, None)]


def test_admission_holds_back_pending_only(spark):
    u = spark.createDataFrame([(0, "a", "pending", True, False), (1, "b", "deferred_disk", False, True), (2, "c", "pending", True, False), (3, "d", "deferred_disk", False, False),
                               (4, "e", "pending", True, False), (5, "f", "waiting_retry", True, False), (6, "g", "deferred_disk", True, False)],
                              "order_index bigint, unit_key string, state string, admit boolean, never_fits boolean")
    got = {r["unit_key"]: r["candidate"] for r in ledger.admission_order(u, width=2).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False, "e": False, "f": True, "g": True}


def test_one_mutated_line_breaks_its_own_and_the_next_link(spark):
    from hashlib import sha256
    text = [f"line {i}" for i in range(40)]
    prev = [None] + [sha256(x.encode()).hexdigest() for x in text[:-1]]
    lines = [("f", i + 1, t, i + 1, p) for i, (t, p) in enumerate(zip(text, prev))]
    schema = "file string, line_no bigint, raw_line string, seq bigint, prev_sha256 string"
    assert logs.chain_check(spark.createDataFrame(lines, schema), width=7).count() == 0
    lines[20] = ("f", 21, "changed", 21, prev[20])
    assert rows(logs.chain_check(spark.createDataFrame(lines, schema), width=7), "line_no", "bad_prev") == [(22, True)]


def test_lineage_branches_and_cycles(spark):
    d = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "b"), ("e", "d"), ("x", "y"), ("y", "x")], "id string, supersedes string")
    tree = logs.Lineage(d)
    got = {r["id"]: (r["root"], r["depth"]) for r in tree.nodes.collect()}
    assert got["e"] == ("a", 3) and got["c"] == ("a", 2) and got["x"] == (None, None)
    pairs = spark.createDataFrame([("e", "a"), ("e", "c"), ("e", "d"), ("c", "c"), ("b", "e"), ("x", "y")], "n string, o string")
    assert rows(tree.ancestors(pairs, "n", "o")) == [("c", "c"), ("e", "a"), ("e", "d")]


def test_concordance_ties_and_missing_keys(spark):
    c = spark.createDataFrame([
        (1, "acq", 1, 0, "ABCDEFGHIJKLMN-1", True, True), (1, "pred", 2, 1, "ABCDEFGHIJKLMN-2", False, False), (1, "pred", 1, 2, "ZZZZZZZZZZZZZZ-2", False, False),
        (2, "acq", 1, 3, "short", True, False), (2, "pred", 1, 4, "ABCDEFGHIJKLMN-2", False, True), (3, "pred", 1, 5, "ABCDEFGHIJKLMN-2", False, False)],
        "feature int, annotator_id string, candidate_rank int, position int, structure_key string, is_reference_matched boolean, is_representative boolean")
    r = metrics.concordance(c, ["acq"], ["pred"]).first()
    assert (r["features"], r["representatives"], r["strict_matched"], r["strict_with_predicted"], r["strict_comparable"], r["strict_top"], r["strict_any"]) == (3, 1, 2, 2, 1, 0, 1)


def test_kappa_is_null_for_one_label(spark):
    df = spark.createDataFrame([("g", "x", "x"), ("g", "x", "x"), ("h", "x", "x"), ("h", "y", "y"), ("h", "x", "y"), ("h", "y", "y")], "grp string, a string, b string")
    got = {r["grp"]: (r["agreement"], r["kappa"]) for r in metrics.agreement(df, "grp").collect()}
    assert got == {"g": (1.0, None), "h": (0.75, 0.5)}


def test_encoding_choice(spark):
    f = spark.createDataFrame([("s", "RAW/S1.raw", None), ("s", "S1.raw", None), ("s", "S1.mzML", None), ("t", "T.raw", "raw_header_unreadable"), ("t", "T.mzXML", None), ("u", "U.mzML", "undecodable")],
                              "sample string, path string, unreadable string")
    got = {r["path"]: r["choice"] for r in invariants.encoding_choice(f, ["sample"]).collect()}
    assert got == {"RAW/S1.raw": "used", "S1.raw": "tie_lexicographic", "S1.mzML": "lower_in_encoding_order", "T.raw": "raw_header_unreadable", "T.mzXML": "used", "U.mzML": "undecodable"}


def test_order_agreement_allows_ties(spark):
    runs = spark.createDataFrame([("u", 1, 2, 10), ("u", 2, 1, 10), ("u", 3, 3, 20), ("v", 1, 2, 10), ("v", 2, 1, 20), ("v", 3, 5, 30)], "unit_id string, id int, order int, time bigint")
    got = {r["unit_id"]: (r["out_of_place"], r["duplicates"], r["gaps"]) for r in invariants.order_agreement(runs).collect()}
    assert got == {"u": (0, 0, 0), "v": (3, 0, 2)}


def test_partition_check_normalises_paths(spark):
    parent = spark.createDataFrame([("p", "a\\S1.raw"), ("p", "a/S2.raw")], "scope string, path string")
    parts = spark.createDataFrame([("p", "A/s1.RAW"), ("p", "a/S2.raw"), ("p", "a/s2.raw")], "scope string, path string")
    assert rows(invariants.partition_check(parent, parts, "scope", "path")) == [("p", 0, 1, 1)]


def test_rules_and_exceptions(spark):
    items = spark.createDataFrame([("a/x_pos.raw", False), ("a/y_neg.raw", True), ("b/z.txt", False)], "path string, twin boolean").withColumn("item_id", F.col("path"))
    rules = [("p", labelling.member_matches({"token": {"polarity": "positive"}})), ("a", labelling.member_matches({"folder": "A"})), ("t", labelling.member_matches({"twin": True}))]
    forced = spark.createDataFrame([("a/y_neg.raw", "q")], "item_id string, group_id string")
    got = rows(labelling.apply_groups(items, rules, forced), "path", "matched", "group_id")
    assert got == [("a/x_pos.raw", ["p", "a"], "p"), ("a/y_neg.raw", ["q"], "q"), ("b/z.txt", [], None)]
    found = labelling.coverage_findings(labelling.apply_groups(items, rules, forced), ["p", "a", "t"], "MEMBER")
    assert rows(found, "check_id", "subject") == [("X-EMPTY-GROUP", "a"), ("X-EMPTY-GROUP", "t"), ("X-OVERLAP-MEMBER", "a/x_pos.raw"), ("X-UNCOVERED-MEMBER", "b/z.txt")]


def test_exclusion_order_and_unknown_sizes(spark):
    files = spark.createDataFrame([("U1", "o1", "archive", 10, "u"), ("U1", "o2", "archive", None, "u"), ("U2", "o1", "archive", 10, "u"), ("U3", "o3", "file", 5, None)],
                                  "unit_id string, object_id string, kind string, size_bytes bigint, download_url string")
    uses = planning.objects(files)
    got = {r["unit_id"]: (r["known_bytes"], r["unknown_size_objects"]) for r in planning.unit_objects(uses).collect()}
    assert got == {"U1": (10, 1), "U2": (10, 0)}
    units, groups = planning.download_groups(uses)
    assert rows(units) == [("U1", "U1"), ("U2", "U1")]
    assert rows(groups, "group_id", "object_count", "known_bytes", "unknown_size_objects", "shared_object_count", "unit_count") == [("U1", 2, 10, 1, 1, 2)]
    ordered_ = planning.plan_order(units.withColumn("repository", F.lit("r")).withColumn("accession", F.lit("a")), groups)
    assert rows(ordered_, "unit_id", "order_index") == [("U1", 0), ("U2", 1)]


def test_disk_need_of_an_unknown_size(spark):
    u = spark.createDataFrame([("a", 100, True, False, 500), ("b", 100, False, False, 500), ("c", 100, True, True, None)], "unit_id string, known_bytes bigint, size_known boolean, has_archive boolean, held_bytes bigint")
    none = spark.createDataFrame([], "factor double, n bigint")
    got = {r["unit_id"]: r["need"] for r in planning.disk_needs(u, none).collect()}
    assert got == {"a": 166, "b": 830 + 200_000_000_000, "c": 266}
    few = planning.observed_factor(spark.createDataFrame([(2.0,)] * 4, "r double"), "r")
    assert few.count() == 0


def test_digest_depends_on_order_not_on_partitions(spark):
    df = spark.createDataFrame([("u", i, f"e{i}") for i in range(50)], "unit string, i bigint, e string")
    d = lambda f: planning.entries_digest(f, "unit", F.col("i"), F.col("e"), width=8).first()["digest"]
    assert d(df) == d(df.repartition(6)) and d(df) != d(df.withColumn("i", 49 - F.col("i")))


def test_redaction(spark):
    files = spark.createDataFrame([
        ("a/plain.txt", "nothing here"), ("triage/note.json", "x\nmail me@example.com or C:\\work\\y"), ("inputs/readme", "me@example.com"),
        ("lib.txt", "see /data/ref.msp and <external>/ok.msp http://h/x.msp"), ("ok.txt", "<external>/ok.msp https://h/p/x.lbm2"), ("who.txt", "by Ann_1, not Annex")],
        "relative_path string, text string")
    found = release.redaction_findings(files, release.redaction_rules(terms=["ann"]))
    assert rows(found, "file", "rule", "at", "line") == [("lib.txt", "library_path", 9, 1), ("triage/note.json", "drive_letter_path", 25, 2), ("triage/note.json", "email_address", 7, 2), ("who.txt", "operator_name", 3, 1)]
    assert release.redaction_verdict(files, found).first()["verdict"] == "refused"
    assert release.redaction_verdict(files, found.where("false")).first()["verdict"] == "pass"


def test_store_findings(spark):
    objects = spark.createDataFrame([("o1", True, True, "ready", True, True, 0, None, None), ("o2", True, True, "collected", True, False, 0, "a", "5"), ("o3", False, False, None, True, False, None, None, None)],
                                    "object_id string, has_record boolean, record_ok boolean, state string, has_bytes boolean, file_present boolean, changed_members int, approval_id string, boundary string")
    urls = spark.createDataFrame([("o1", "k1")], "object_id string, url_key string")
    index = spark.createDataFrame([("k1", "o1")], "url_key string, object_id string")
    claims = spark.createDataFrame([("k1", "u", "pending", None)], "url_key string, unit_id string, state string, object_id string")
    assert rows(store.object_findings(objects, urls, index, claims), "kind", "subject") == [("orphan_object", "o3"), ("tombstone_with_bytes", "o2")]
    assert rows(store.object_findings(objects.where("object_id = 'o1'"), urls, index, claims.where("false")), "kind") == [("no_releasing_unit",)]


def test_member_lookup_leaves_other_files_out(spark):
    """Exact paths, tails and several holders; files whose last part nobody asks for are not cut into tails."""
    files = listing(spark, ("a/b/f1.raw", 5, "X"), ("c/f2.raw", 6, "Y"), ("d/f2.raw", 6, "Y"), ("f3.raw", 7, "Z"), ("e/f3.raw", 8, "Z"), ("a//", 1, ""), *[(f"n/{k}/o{k}.raw", 1, "") for k in range(50)])
    wanted = spark.createDataFrame([(1, "f1.raw", 5, "X"), (2, "b/f1.raw", 4, "X"), (3, "f2.raw", 6, "Y"), (4, "c/f2.raw", 6, "Q"), (5, "f3.raw", 7, None), (6, "none", 1, None), (7, None, 1, None), (8, "", 1, None)],
                                   "id int, member_path string, size bigint, crc32 string")
    found = matching.member_lookup(wanted, files)
    assert rows(found, "id", "result") == [(1, "equal"), (2, "size_differs"), (3, "not_evaluable"), (4, "crc_differs"), (5, "equal"), (6, "not_evaluable"), (7, "not_evaluable"), (8, "equal")]
    assert "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString().split("Generate")[-1]
