"""Invariants between artefact tables. A check without its inputs is ``not_evaluable``, never ``pass``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.functions import names
from cairnsift.operators.matching import reconcile
from cairnsift.scale import blocks, ordered

STATUS = ("pass", "warn", "fail", "not_evaluable")


def count_agreement(counts: DataFrame) -> DataFrame:
    """Counts of one thing from several sources agree; one source alone is not evaluable, run-level exports do not count.

    ``counts(unit_id, source, n, run_level)``."""
    per = counts.where("NOT run_level").groupBy("unit_id").agg(
        F.count_distinct("source").alias("sources"), F.min("n").alias("lowest"), F.max("n").alias("highest"))
    units = counts.select("unit_id").distinct()
    out = units.join(per, "unit_id", "left")
    return out.select("unit_id", F.when(F.coalesce("sources", F.lit(0)) < 2, "not_evaluable").when(F.col("lowest") == F.col("highest"), "pass").otherwise("fail").alias("status"),
                      F.coalesce("sources", F.lit(0)).alias("sources"))


def missing_outputs(expected: DataFrame, produced: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(produced.select(*keys).distinct(), list(keys), "left_anti")


def identity_agreement(artefacts: DataFrame, key: str, value: str) -> DataFrame:
    """Key columns that differ between artefacts of one unit. ``artefacts(key, value)``: one row per artefact."""
    return artefacts.groupBy(key).agg(F.count(F.lit(1)).alias("artefacts"), F.count_distinct(value).alias("values")).withColumn(
        "status", F.when(F.col("artefacts") < 2, "not_evaluable").when(F.col("values") == 1, "pass").otherwise("fail"))


def input_balance(declared: DataFrame, found: DataFrame, rows: DataFrame, excluded: DataFrame) -> DataFrame:
    """Declared inputs = found = analysis rows, less recorded exclusions; no excluded item runs. All ``(unit_id, key)``."""
    tag = lambda f, c: f.select("unit_id", "key").distinct().withColumn(c, F.lit(True))
    all_ = tag(declared, "d").join(tag(found, "f"), ["unit_id", "key"], "full_outer").join(tag(rows, "r"), ["unit_id", "key"], "full_outer").join(
        tag(excluded, "x"), ["unit_id", "key"], "left")
    has = lambda c: F.col(c).isNotNull()
    why = (F.when(has("x") & has("r"), "excluded_but_runs").when(has("x"), None).when(~has("d"), "undeclared").when(~has("f"), "not_found")
           .when(~has("r"), "no_row"))
    return all_.select("unit_id", "key", why.alias("problem")).where("problem IS NOT NULL")


def checksum_coverage(inputs: DataFrame) -> DataFrame:
    """Each input is verified itself, through its container or through its conversion source; partial coverage fails,
    and a unit for which nothing is published warns. ``inputs(unit_id, key, direct, container, source)`` booleans, null unpublished."""
    ok = F.coalesce(F.col("direct") | F.col("container") | F.col("source"), F.greatest("direct", "container", "source"), F.lit(False))
    published = F.col("direct").isNotNull() | F.col("container").isNotNull() | F.col("source").isNotNull()
    per = inputs.groupBy("unit_id").agg(F.count(F.lit(1)).alias("inputs"), F.count_if(ok).alias("verified"), F.count_if(published).alias("published"))
    return per.withColumn("status", F.when(F.col("published") == 0, "warn").when(F.col("verified") == F.col("inputs"), "pass").otherwise("fail"))


def order_agreement(runs: DataFrame) -> DataFrame:
    """Recorded order against time order; equal times may come either way. Rows out of place per unit, duplicates and gaps.

    ``runs(unit_id, id, order, time)``. Positions come from a histogram of times, bucketed by day."""
    hist = runs.groupBy("unit_id", "time").agg(F.count(F.lit(1)).alias("n"))
    placed = ordered(hist, ["unit_id"], ["time"], blocks("time", 86_400_000_000), prior_sum={"below": "n"})
    spots = placed.select(F.col("unit_id").alias("_u"), F.col("time").alias("_t"), (F.col("below") + 1).alias("lo"), (F.col("below") + F.col("n")).alias("hi"))
    judged = runs.join(spots, (F.col("unit_id") == F.col("_u")) & (F.col("time") == F.col("_t")))
    out = judged.groupBy("unit_id").agg(F.count_if(~F.col("order").between(F.col("lo"), F.col("hi"))).alias("out_of_place"), F.count(F.lit(1)).alias("rows"),
                                        F.count_distinct("order").alias("orders"), F.min("order").alias("first"), F.max("order").alias("last"))
    return out.select("unit_id", "rows", "out_of_place", (F.col("rows") - F.col("orders")).alias("duplicates"), (F.col("last") - F.col("first") + 1 - F.col("orders")).alias("gaps"))


def synthesised_order(runs: DataFrame, width: int = 1 << 16) -> DataFrame:
    """Units whose order equals the row number while classes lie in contiguous blocks. ``runs(unit_id, row, order, class_id)``."""
    seen = ordered(runs, ["unit_id"], ["row"], blocks("row", width), lag={"_before": "class_id"}, row_number="_rn")
    turn = F.col("_before").isNull() | (F.col("_before") != F.col("class_id"))
    per = seen.groupBy("unit_id").agg(F.bool_and(F.col("order") == F.col("_rn")).alias("numbered"), F.count_if(turn).alias("blocks"),
                                      F.count_distinct("class_id").alias("classes"), F.count(F.lit(1)).alias("rows"))
    return per.select("unit_id", "rows", "blocks", "classes", (F.col("numbered") & (F.col("blocks") == F.col("classes"))).alias("synthesised"))


def class_labels(assigned: DataFrame, executed: DataFrame) -> DataFrame:
    """Assigned against executed labels per sample, joined by name, else by file: relabelled, uncovered, absent or equal.

    ``assigned(unit_id, sample_name, label)``, ``executed(unit_id, file_name, file_path, class_id)``."""
    a = assigned.select("unit_id", F.lower("sample_name").alias("name"), "label").groupBy("unit_id", "name").agg(F.min("label").alias("label"))
    e = executed.withColumn("_n", F.lower("file_name")).withColumn("_f", F.lower(names.stem("file_path")))
    by_name = a.select(F.col("unit_id").alias("_u1"), F.col("name").alias("_a1"), F.col("label").alias("l1"))
    by_file = a.select(F.col("unit_id").alias("_u2"), F.col("name").alias("_a2"), F.col("label").alias("l2"))
    hit = e.join(by_name, (F.col("unit_id") == F.col("_u1")) & (F.col("_n") == F.col("_a1")), "left").join(
        by_file, (F.col("unit_id") == F.col("_u2")) & (F.col("_f") == F.col("_a2")), "left").withColumn("label", F.coalesce("l1", "l2")).withColumn(
        "used", F.when(F.col("l1").isNotNull(), F.col("_n")).when(F.col("l2").isNotNull(), F.col("_f")))
    runs = hit.select("unit_id", F.col("file_name").alias("sample"), F.when(F.col("label").isNull(), "uncovered").when(
        F.col("label") != F.col("class_id"), "relabelled").otherwise("equal").alias("result"))
    used = hit.where("used IS NOT NULL").select("unit_id", F.col("used").alias("name")).distinct()
    absent = a.join(used, ["unit_id", "name"], "left_anti").select("unit_id", F.col("name").alias("sample"), F.lit("absent").alias("result"))
    return runs.unionByName(absent)


def acquisition_modes(inputs: DataFrame, sanctioned: dict[str, str]) -> DataFrame:
    """Executed mode against the header's through the sanctioned table; an unknown header warns.

    ``inputs(unit_id, key, executed, header)``."""
    table = F.create_map(*[F.lit(x) for kv in sanctioned.items() for x in kv])
    want = F.coalesce(table[F.upper("header")], F.upper("header"))
    status = F.when(F.col("header").isNull() | (F.upper("header") == "UNKNOWN"), "warn").when(want == F.upper("executed"), "pass").otherwise("fail")
    return inputs.select("unit_id", "key", status.alias("status"))


def side(tag: str, *keys: str) -> Column:
    """Keeps the rows of two frames apart where a key is null, as a join would: null equals nothing."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return F.when(null, tag)


def energy_sets(declared: DataFrame, executed: DataFrame) -> DataFrame:
    """Energies per input, declared against executed: missing, extra, and zero targets. All ``(unit_id, key, energy)``."""
    keys = ["unit_id", "key", "energy"]
    d = declared.select(*keys, side("d", *keys).alias("_side"), F.lit(1).alias("_m"))
    e = executed.select(*keys, side("e", *keys).alias("_side"), F.lit(2).alias("_m"))
    # One aggregate in place of a join, so a task sorts and holds neither side.
    both = d.unionByName(e).groupBy(*keys, "_side").agg(F.bit_or("_m").alias("_m"))
    return both.groupBy("unit_id", "key").agg(
        F.count_if(F.col("_m") == 1).alias("missing"), F.count_if(F.col("_m") == 2).alias("extra"), F.count_if(F.col("energy") <= 0).alias("zero"))


def encoding_choice(files: DataFrame, key: list[str]) -> DataFrame:
    """One file per sample: the lowest encoding rank, then the path without case; an unreadable file is passed over.

    Each other file gets its reason: its own when it cannot be read, lower_in_encoding_order, or tie_lexicographic.
    ``files(*key, path, unreadable)``, ``unreadable`` null where the file can be read."""
    ranked = files.withColumn("encoding_rank", names.encoding_rank("path")).where("encoding_rank IS NOT NULL")
    order = F.struct("encoding_rank", F.lower("path").alias("folded"), F.col("path").alias("chosen"))
    used = ranked.groupBy(*key).agg(F.min(F.when(F.col("unreadable").isNull(), order)).alias("best"))
    out = ranked.join(used, key)
    why = (F.when(F.col("path") == F.col("best.chosen"), "used").when(F.col("unreadable").isNotNull(), F.col("unreadable"))
           .when(F.col("encoding_rank") == F.col("best.encoding_rank"), "tie_lexicographic").otherwise("lower_in_encoding_order"))
    return out.select(*key, "path", "encoding_rank", why.alias("choice"))


def conversion_sources(outputs: DataFrame, sources: DataFrame) -> DataFrame:
    """Converted outputs against their source records: no_record, incomplete, digest_differs or pass.

    ``outputs(key, digest)``, ``sources(key, digest, source_path, tool)``."""
    s = sources.groupBy("key").agg(F.min("digest").alias("s_digest"), F.min("source_path").alias("source_path"), F.min("tool").alias("tool"))
    both = outputs.join(s, "key", "left")
    return both.select("key", F.when(F.col("s_digest").isNull(), "no_record").when(F.col("source_path").isNull() | F.col("tool").isNull(), "incomplete")
                       .when(F.col("digest") != F.col("s_digest"), "digest_differs").otherwise("pass").alias("result"))


def partition_check(parent: DataFrame, parts: DataFrame, scope: str, path: str) -> DataFrame:
    """Parts cover the parent exactly once, paths compared in one form: missing, extra and repeated per scope."""
    n = names.member_key(path)
    one, none, p, q = F.lit(1).cast("bigint"), F.lit(0).cast("bigint"), F.col("np"), F.col("nq")
    told = lambda rows, tag, np, nq: rows.select(scope, n.alias("k")).select(scope, "k", side(tag, scope, "k").alias("_side"), np.alias("np"), nq.alias("nq"))
    # One aggregate in place of a join, so a task sorts and holds neither side.
    both = told(parent, "p", one, none).unionByName(told(parts, "q", none, one)).groupBy(scope, "k", "_side").agg(F.sum("np").alias("np"), F.sum("nq").alias("nq"))
    return both.groupBy(scope).agg(F.sum(F.greatest(p - q, F.lit(0))).alias("missing"), F.sum(F.greatest(q - p, F.lit(0))).alias("extra"),
                                   F.count_if(q > 1).alias("repeated"))


def parameter_check(used: DataFrame, measured: DataFrame, known: Sequence[str]) -> DataFrame:
    """Used parameters equal the measured ones as numbers; an unreadable value fails, an unknown key warns.

    ``used/measured(unit_id, name, value)``."""
    m = measured.groupBy("unit_id", "name").agg(F.min("value").alias("m_value"))
    both = used.join(m, ["unit_id", "name"], "left")
    u, v = F.trim("value").try_cast("double"), F.trim("m_value").try_cast("double")
    status = (F.when(~F.col("name").isin(*known), "warn").when(F.col("m_value").isNull(), "not_evaluable").when(u.isNull() | v.isNull(), "fail")
              .when(u == v, "pass").otherwise("fail"))
    return both.select("unit_id", "name", status.alias("status"))


def sectioned_table(lines: DataFrame, file: str, headers: dict[str, str]) -> DataFrame:
    """Data rows with another number of columns than their section's header, and data before any header.

    ``lines(file, line_no, line)``, tab-separated, the first cell naming the section; ``headers`` maps a data prefix to its header's."""
    cells = F.split("line", "\t")
    shaped = lines.select(file, "line_no", cells[0].alias("prefix"), F.size(cells).alias("columns"))
    table = F.create_map(*[F.lit(x) for kv in headers.items() for x in kv])
    heads = shaped.where(F.col("prefix").isin(*headers.values())).groupBy(file, F.col("prefix").alias("_h")).agg(F.min_by("columns", "line_no").alias("expected"))
    data = shaped.where(F.col("prefix").isin(*headers)).withColumn("_want", table[F.col("prefix")])
    heads = heads.withColumnRenamed(file, "_file")
    out = data.join(heads, (data[file] == F.col("_file")) & (F.col("_want") == F.col("_h")), "left")
    return out.where(~F.col("columns").eqNullSafe(F.col("expected"))).select(file, "line_no", "prefix", F.when(F.col("expected").isNull(), "no_header").otherwise("column_count").alias("problem"))


def library_check(loaded: DataFrame, approved: DataFrame) -> DataFrame:
    """Loaded library identities against the approved ones by name, digest and role, with counts. ``(unit_id, name, digest, role)``."""
    return reconcile(loaded, approved, ["unit_id", "name"], ["digest", "role"])


def tier_rules(candidates: DataFrame, predicted: Sequence[str]) -> DataFrame:
    """Tier rules per feature: a predicted candidate is never reference-matched, at most one is representative, and an
    acquired reference match is not represented by a predicted candidate."""
    pred = F.col("annotator_id").isin(*predicted)
    per = candidates.groupBy("feature").agg(
        F.count_if(pred & F.col("is_reference_matched")).alias("matched_predicted"), F.count_if(F.col("is_representative")).alias("representatives"),
        F.bool_or(~pred & F.col("is_reference_matched")).alias("acquired"), F.bool_or(pred & F.col("is_representative")).alias("pred_rep"), F.count_if(pred).alias("suggestions"))
    why = F.array_compact(F.array(F.when(F.col("matched_predicted") > 0, F.lit("predicted_reference_match")), F.when(F.col("representatives") > 1, F.lit("several_representatives")),
                                  F.when(F.col("acquired") & F.col("pred_rep"), F.lit("predicted_over_acquired"))))
    return per.select("feature", F.explode(why).alias("problem"))


def single_identity(uses: DataFrame, scope: str, identity: str, pinned: Column | None = None) -> DataFrame:
    """One distinct binary identity per batch, and the pinned one where a pin is given."""
    per = uses.groupBy(scope).agg(F.count_distinct(identity).alias("identities"), F.min(identity).alias("identity"), F.count(F.lit(1)).alias("runs"))
    status = F.when(F.col("identities") != 1, "fail")
    if pinned is not None:
        status = status.when(F.col("identity") != pinned, "fail")
    return per.withColumn("status", status.otherwise("pass"))


def terminal_and_deletion(units: DataFrame, deletions: DataFrame, states: Sequence[str]) -> DataFrame:
    """Every unit has ended, and each deletion names its authority and its reason."""
    open_ = units.where(~F.col("state").isin(*states)).select("unit_id", F.lit("RET-1").alias("check_id"), F.lit("not_terminal").alias("problem"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    bad = deletions.where(blank("approval_id") | blank("reason")).select("unit_id", F.lit("FIN-1").alias("check_id"), F.when(blank("approval_id"), "no_authority").otherwise("no_reason").alias("problem"))
    return open_.unionByName(bad)


def disk_once(links: DataFrame) -> DataFrame:
    """Bytes on disk per store: what units link, and each object once. ``links(store, unit_id, object_id, size)``."""
    per = links.groupBy("store", "object_id").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("links"))
    return per.groupBy("store").agg(F.sum("size").alias("occupied"), F.sum(F.col("size") * F.col("links")).alias("linked"), F.count(F.lit(1)).alias("objects"))


def progress(artefacts: DataFrame, stages: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """The furthest stage whose artefacts all exist, and the earlier ones that miss some. ``artefacts(unit_id, kind)``."""
    kinds = artefacts.groupBy("unit_id").agg(F.collect_set(F.when(F.col("kind").isin(*[k for _, ks in stages for k in ks]), F.col("kind"))).alias("kinds"))
    done = [F.size(F.array_except(F.array(*[F.lit(k) for k in ks]), F.col("kinds"))) == 0 for _, ks in stages]
    furthest = F.lit(-1)
    for i, d in enumerate(done):
        furthest = F.when(d, i).otherwise(furthest)
    gaps = F.array_compact(F.array(*[F.when(~d & (F.lit(i) < F.col("furthest")), F.lit(stages[i][0])) for i, d in enumerate(done)]))
    named = F.coalesce(F.get(F.array(*[F.lit(s) for s, _ in stages]), F.when(F.col("furthest") >= 0, F.col("furthest"))), F.lit("none"))
    return kinds.withColumn("furthest", furthest).select("unit_id", named.alias("stage"), F.array_join(gaps, ",").alias("gaps"))


def replay_compare(recorded: DataFrame, replayed: DataFrame) -> DataFrame:
    """Per unit and check: equal, different, or not evaluable with its reason. ``(unit_id, check_id, value)``."""
    a = recorded.select("unit_id", "check_id", F.col("value").alias("expected"))
    b = replayed.select("unit_id", "check_id", F.col("value").alias("replayed"))
    both = a.join(b, ["unit_id", "check_id"], "full_outer")
    result = F.when(F.col("expected").isNull() | F.col("replayed").isNull(), "not_evaluable").when(F.col("expected") == F.col("replayed"), "equal").otherwise("different")
    why = F.when(F.col("expected").isNull(), "nothing recorded").when(F.col("replayed").isNull(), "not recomputed")
    return both.select("unit_id", "check_id", result.alias("result"), why.alias("why"))


def replay_result(compared: DataFrame) -> DataFrame:
    """A unit's result: different over not evaluable over equal."""
    return compared.groupBy("unit_id").agg(F.when(F.bool_or(F.col("result") == "different"), "different").when(
        F.bool_or(F.col("result") == "not_evaluable"), "not_evaluable").otherwise("equal").alias("result"))


def pin_differences(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Pinned identities that differ; what the plan recorded as absent is not compared. ``(pin, field, value)``."""
    r = recorded.where(F.coalesce("value", F.lit("")) != "")
    both = r.select("pin", "field", F.col("value").alias("before")).join(current.select("pin", "field", F.col("value").alias("after")), ["pin", "field"], "left")
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).select("pin", "field", F.when(F.col("after").isNull(), "missing").otherwise("changed").alias("change"))


def release_digests(index: DataFrame, files: DataFrame) -> DataFrame:
    """Released files against their index: the bytes must be the indexed release digest; the original digest then stands.

    ``index(path, original_sha256, release_sha256)``, ``files(path, sha256)``."""
    both = index.join(files, "path", "left")
    ok = F.col("sha256") == F.col("release_sha256")
    return both.select("path", F.when(F.col("sha256").isNull(), "missing").when(ok, "ok").otherwise("digest_differs").alias("result"), F.when(ok, F.col("original_sha256")).alias("stands_for"))


def bound_inputs(records: DataFrame, files: DataFrame) -> DataFrame:
    """The first problem per decision record: another payload, a missing input, or an input of another digest.

    ``records(record_id, payload_ok, position, path, sha256)``, ``files(path, sha256)``."""
    f = files.select(F.col("path").alias("_p"), F.col("sha256").alias("_d"))
    both = records.join(f, F.col("path") == F.col("_p"), "left")
    why = F.when(~F.col("payload_ok"), "other_payload").when(F.col("_d").isNull(), "input_missing").when(F.col("_d") != F.col("sha256"), "input_differs")
    rank = F.when(~F.col("payload_ok"), -1).otherwise(F.col("position"))
    return both.groupBy("record_id").agg(F.min_by(why, F.when(why.isNotNull(), rank)).alias("problem"))


def class_binding(handoffs: DataFrame, approvals: DataFrame) -> DataFrame:
    """Problems of a class proposal bound in a handoff: unaccepted, unratified, of another unit, or not the approved one.

    ``handoffs(unit_id, proposal_id, accepted, ratified, proposal_unit)``, ``approvals(unit_id, approved_id)``."""
    both = handoffs.join(approvals, "unit_id", "left")
    why = F.array_compact(F.array(F.when(~F.col("accepted"), F.lit("not_accepted")), F.when(~F.col("ratified"), F.lit("not_ratified")),
                                  F.when(F.col("proposal_unit") != F.col("unit_id"), F.lit("other_unit")), F.when(~F.col("proposal_id").eqNullSafe(F.col("approved_id")), F.lit("not_the_approved"))))
    return both.select("unit_id", F.array_join(why, ",").alias("problems"))


def companion_check(files: DataFrame, container: str, sibling: str, companion: str) -> DataFrame:
    """Each container's stem has its sibling encoding and its companion file. ``files(unit_id, path)``."""
    name = F.lower(names.basename("path"))
    tag = F.when(name.endswith(companion), "companion").when(name.endswith(container), "container").when(name.endswith(sibling), "sibling")
    bare = F.regexp_replace(name, r"\Q" + companion + r"\E$|\Q" + container + r"\E$|\Q" + sibling + r"\E$", "")
    per = files.select("unit_id", bare.alias("stem"), tag.alias("tag")).where("tag IS NOT NULL").groupBy("unit_id", "stem").agg(
        *[F.bool_or(F.col("tag") == k).alias(k) for k in ("container", "sibling", "companion")])
    ok = F.col("sibling") & F.col("companion")
    return per.where("container").groupBy("unit_id").agg(F.count(F.lit(1)).alias("containers"), F.count_if(ok).alias("complete"), F.bool_and(ok).alias("switchable"))


def stated_counts(stated: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """Stated counts that differ from recounted ones. ``stated(key, n)``."""
    real = items.groupBy(key).agg(F.count(F.lit(1)).alias("counted"))
    both = stated.withColumnRenamed("n", "stated").join(real, key, "full_outer")
    return both.where(F.coalesce("stated", F.lit(0)) != F.coalesce("counted", F.lit(0)))
