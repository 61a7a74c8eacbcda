"""Campaign planning: pools, exclusions, evidence, shared objects, order, totals and disk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift import vocab
from cairnsift.functions import names, policy, text, tokens
from cairnsift.scale import components, global_rank, rank_value
from cairnsift.session import stored


def in_pool(pool: str) -> Column:
    return ((F.col("separation") == "LC-MS") & F.col("acquisition_mode").isin(*vocab.POOL_MODES[pool])
            & (F.col("untargeted").isNull() | (F.col("untargeted") != 0)) & F.col("ion_mode").isin(*vocab.POOL_ION_MODES))


def file_facts(files: DataFrame) -> DataFrame:
    """Per unit: listed files, analysis files, and those that are mzData."""
    analysis = F.col("role").isin(*vocab.ANALYSIS_ROLES)
    return files.groupBy("unit_id").agg(
        F.count(F.lit(1)).alias("file_count"), F.count_if(analysis).alias("analysis_files"),
        F.count_if(analysis & F.rtrim("path", F.lit("/\\")).rlike(vocab.MZDATA_SUFFIX)).alias("mzdata_files"))


def select_pool(units: DataFrame, files: DataFrame, pool: str) -> DataFrame:
    """Units a pool's rules select, with what the exclusions read."""
    facts = file_facts(files)
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return units.where(in_pool(pool)).join(facts, "unit_id", "left").select(
        *units.columns, F.lit(pool).alias("pool"), zero("file_count"), zero("analysis_files"), zero("mzdata_files"))


def union_pools(units: DataFrame, files: DataFrame, pools: list[str]) -> DataFrame:
    """Units of several pools, each under the first that selects it, in one pass over the units."""
    chain = F.lit(None).cast("string")
    for p in reversed(pools):
        chain = F.when(in_pool(p), F.lit(p)).otherwise(chain)
    facts = file_facts(files)
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return units.withColumn("pool", chain).where("pool IS NOT NULL").join(facts, "unit_id", "left").select(
        *units.columns, "pool", zero("file_count"), zero("analysis_files"), zero("mzdata_files"))


def select_named(units: DataFrame, wanted: DataFrame) -> DataFrame:
    """Each wanted id: its pool, outside, or unknown (which refuses the plan)."""
    pool = F.when(in_pool("declared"), "declared").when(in_pool("acquisition_unknown"), "acquisition_unknown").otherwise("outside")
    known = units.select("unit_id", pool.alias("found"))
    return wanted.select("unit_id").distinct().join(known, "unit_id", "left").select(
        "unit_id", F.coalesce("found", F.lit("unknown")).alias("found"))


def prior_work(units: DataFrame, prior: DataFrame, replan: list[str], reopen: DataFrame) -> DataFrame:
    """Workspace reason per unit: preexisting, campaign, or none.

    ``prior(unit_id, campaign_id, state)``: one row per earlier workspace, campaign null when none made it."""
    open_ = reopen.select(F.col("unit_id").alias("_o")).distinct()
    per = prior.join(open_, F.col("unit_id") == F.col("_o"), "left")
    again = F.col("campaign_id").isin(*replan) if replan else F.lit(False)
    free = (F.coalesce(again & ~F.col("state").isin(*vocab.NOT_REPLANNED), F.lit(False))
            | F.coalesce(again & F.col("state").isin(*vocab.REOPENABLE) & F.col("_o").isNotNull(), F.lit(False)))
    fold = per.groupBy("unit_id").agg(F.bool_or(F.col("campaign_id").isNull()).alias("foreign"),
                                      F.bool_or(F.col("campaign_id").isNotNull() & ~free).alias("bound"))
    why = F.when(F.coalesce("foreign", F.lit(False)), "preexisting_workspace").when(F.coalesce("bound", F.lit(False)), "campaign_workspace")
    return units.join(fold, "unit_id", "left").select(*units.columns, why.alias("workspace_reason"))


def ion_mobility_reading(units: DataFrame, samples: DataFrame, files: DataFrame) -> DataFrame:
    """Whether a unit's own fields name ion mobility and no container rules it out.

    ``samples(unit_id, field, value)``, ``files(unit_id, format)``; the study's text is never read."""
    named = samples.where(F.lower("field").contains("instrument") & F.col("value").rlike(vocab.ION_MOBILITY_INSTRUMENT)).groupBy(
        "unit_id").agg(F.count(F.lit(1)).alias("rows_named"))
    beside = files.groupBy("unit_id").agg(F.bool_or(F.col("format").isin(*vocab.NON_ION_MOBILITY_FORMATS)).alias("beside"))
    out = units.join(named, "unit_id", "left").join(beside, "unit_id", "left")
    says = F.col("instrument").rlike(vocab.ION_MOBILITY_INSTRUMENT) | F.col("rows_named").isNotNull()
    mixed = F.coalesce("beside", F.lit(False))
    return out.select("unit_id", (says & ~mixed).alias("excluded"), says.alias("signal"),
                      F.when(says & mixed, "mixed").when(says, "enabled").otherwise("unknown").alias("state"))


def stated_file_matches(files: DataFrame, samples: DataFrame) -> DataFrame:
    """Files of sample rows that state a method: by sample id, else by file name or stem (a union of equi semi-joins).

    ``files(unit_id, path, sample_id)``, ``samples(unit_id, sample_id, raw_file)`` of the stating rows."""
    f = files.withColumn("_name", F.lower(names.basename("path"))).withColumn("_bare", F.regexp_replace("_name", r"\.[^.]*$", ""))
    s = samples.select("unit_id", "sample_id", F.lower(names.basename("raw_file")).alias("_sn"))
    ids = s.select("unit_id", "sample_id").where("sample_id <> ''").distinct()
    known = s.where("_sn <> ''").select("unit_id", F.explode(F.array("_sn", F.regexp_replace("_sn", r"\.[^.]*$", ""))).alias("_k")).distinct()
    by_id = f.join(ids, ["unit_id", "sample_id"], "left_semi")
    by_name = f.join(known.withColumnRenamed("_k", "_name"), ["unit_id", "_name"], "left_semi")
    by_bare = f.join(known.withColumnRenamed("_k", "_bare"), ["unit_id", "_bare"], "left_semi")
    cols = ["unit_id", "path"]
    return by_id.select(*cols).union(by_name.select(*cols)).union(by_bare.select(*cols)).distinct()


def fragmentation_reading(units: DataFrame, evidence: DataFrame, samples: DataFrame, files: DataFrame, shared: DataFrame) -> DataFrame:
    """Whether a unit is excluded for its fragmentation method, read from its own evidence.

    ``evidence(unit_id, field, value)``, ``samples(unit_id, sample_id, raw_file, attributes)``, ``files(unit_id, path,
    sample_id, role)``, ``shared(study_id, field, value)``; ``units(unit_id, study_id, label, instrument)``."""
    label = units.where(F.size(tokens.methods_named("label", words=True)) > 0).select("unit_id")
    said = evidence.where(~F.col("field").rlike(vocab.STUDY_TEXT_FIELD) & ~F.col("field").rlike(vocab.INSTRUMENT_FIELD)
                          & (F.size(tokens.methods_named("value", words=True)) > 0)).select("unit_id")
    whole = label.union(said).distinct().withColumn("own", F.lit(True))

    facts = units.select("unit_id", "study_id", "instrument")
    entries = samples.select("unit_id", "sample_id", "raw_file", F.explode("attributes").alias("field", "value")).where(
        ~F.col("field").rlike(vocab.INSTRUMENT_FIELD)).withColumn("methods", tokens.methods_named("value", words=True)).where(F.size("methods") > 0)
    states = F.col("field").rlike(vocab.STATEMENT_FIELD)
    loud = entries.withColumn("states", states).where(states | ~F.col("field").rlike(vocab.STUDY_TEXT_FIELD)).join(facts, "unit_id")
    loud = loud.join(shared.select("study_id", "field", "value", F.lit(True).alias("copied")), ["study_id", "field", "value"], "left")
    able = F.exists("methods", lambda m: tokens.instrument_can(m, "instrument"))
    hits = loud.where(F.col("states") | (able & F.col("copied").isNull()))
    named_rows = hits.select("unit_id", "sample_id").distinct().groupBy("unit_id").agg(F.count(F.lit(1)).alias("named_samples"))
    stating = hits.where("states").select("unit_id", "sample_id", "raw_file").distinct()
    all_rows = samples.groupBy("unit_id").agg(F.count_distinct("sample_id").alias("samples"))

    inputs = files.where(F.col("role").isin(*vocab.ANALYSIS_ROLES)).join(facts, "unit_id")
    words = tokens.methods_in_file_name("path")
    credible = F.filter(words, lambda m: tokens.instrument_can(m, "instrument"))
    judged = inputs.select("unit_id", "path", (F.size(credible) > 0).alias("by_name"), (F.size(credible) < F.size(words)).alias("not_credible"))
    stated = stated_file_matches(inputs, stating).withColumn("by_row", F.lit(True))
    per_file = judged.join(stated, ["unit_id", "path"], "left").groupBy("unit_id").agg(
        F.count(F.lit(1)).alias("analysis_files"), F.count_if(F.col("by_name") | F.coalesce("by_row", F.lit(False))).alias("named_files"),
        F.count_if("not_credible").alias("not_credible_files"))
    out = units.select("unit_id")
    for part in (whole, named_rows, all_rows, per_file):
        out = out.join(part, "unit_id", "left")
    z = lambda c: F.coalesce(c, F.lit(0))
    every_row = (z("samples") > 0) & (z("named_samples") == z("samples"))
    every_file = (z("analysis_files") > 0) & (z("named_files") == z("analysis_files"))
    excluded = F.coalesce("own", F.lit(False)) | every_row | every_file
    return out.select("unit_id", excluded.alias("excluded"), z("named_samples").alias("named_samples"), z("samples").alias("samples"),
                      F.when(excluded, 0).otherwise(z("named_files")).cast("bigint").alias("named_files"), z("analysis_files").alias("analysis_files"),
                      z("not_credible_files").alias("not_credible_files"))


def exclusion_reasons(units: DataFrame) -> DataFrame:
    """Every static reason a unit will not run, in order; the first is its primary one.

    Reads ``file_count, mzdata_files, analysis_files, ion_mobility, fragmentation, workspace_reason``."""
    w = F.col("workspace_reason")
    reasons = F.array_compact(F.array(
        F.when(F.col("file_count") == 0, F.lit("no_files")), F.when(F.col("ion_mobility"), F.lit("ion_mobility")),
        F.when(F.col("fragmentation"), F.lit("fragmentation_not_cid_hcd")), F.when(w == "preexisting_workspace", w), F.when(w == "campaign_workspace", w),
        F.when((F.col("analysis_files") > 0) & (F.col("mzdata_files") == F.col("analysis_files")), F.lit("mzdata_only"))))
    return units.withColumn("reasons", reasons).withColumn("reason", F.get("reasons", F.lit(0)))


# ---- objects ------------------------------------------------------------------

def objects(files: DataFrame) -> DataFrame:
    """Download objects and the units that use them, one row per (object, unit); a size known only in part is a
    lower bound. ``files(unit_id, object_id, kind, size_bytes, download_url)``."""
    with_url = files.where("download_url IS NOT NULL")
    return with_url.groupBy("object_id", "unit_id").agg(F.max("kind").alias("kind"), F.max("size_bytes").alias("size"))


def object_sizes(uses: DataFrame, *more: Column) -> DataFrame:
    return uses.groupBy("object_id").agg(F.max("kind").alias("kind"), F.coalesce(F.max("size"), F.lit(0)).alias("known_bytes"),
                                         F.max("size").isNotNull().alias("size_known"), F.count(F.lit(1)).alias("consumers"), *more)


def unit_objects(uses: DataFrame) -> DataFrame:
    """Per unit: objects, known bytes, objects of unknown size, and whether all or any are archives."""
    sized = uses.join(object_sizes(uses).select("object_id", "known_bytes", "size_known", F.col("kind").alias("object_kind")), "object_id")
    archive = F.col("object_kind").isin(*vocab.ARCHIVE_KINDS)
    return sized.groupBy("unit_id").agg(
        F.count(F.lit(1)).alias("object_count"), F.sum("known_bytes").alias("known_bytes"), F.count_if(~F.col("size_known")).alias("unknown_size_objects"),
        F.bool_and(archive).alias("only_archives"), F.bool_or(archive).alias("has_archive"))


def archive_too_small(planned: DataFrame) -> Column:
    """Only archives, every size known, and fewer bytes than the floor for each sample."""
    return ((F.col("samples") > 0) & F.col("only_archives") & (F.col("unknown_size_objects") == 0)
            & (F.col("known_bytes") < F.col("samples") * F.lit(vocab.ARCHIVE_FLOOR_BYTES_PER_SAMPLE)))


def download_groups(uses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Units connected by shared objects: ``(unit_id, group_id)`` and one row per group.

    Only edges of objects with several consumers can join units; the rest are groups of one. ``uses`` is read several
    times, so a caller stores it."""
    sizes = stored(object_sizes(uses, F.min("unit_id").alias("first_unit")))
    multi = sizes.where("consumers > 1").select("object_id")
    edges = uses.join(multi, "object_id", "left_semi").select(F.concat(F.lit("u:"), "unit_id").alias("a"), F.concat(F.lit("v:"), "object_id").alias("b"))
    found = components(edges, "a", "b").where(F.col("node").startswith("u:")).select(
        F.substr(F.col("node"), F.lit(3)).alias("unit_id"), F.substr(F.col("component"), F.lit(3)).alias("group_id"))
    units = stored(uses.select("unit_id").distinct().join(found, "unit_id", "left").select("unit_id", F.coalesce("group_id", "unit_id").alias("group_id")))
    # All units of an object are of one group, so any of them places it.
    placed = sizes.where("object_id IS NOT NULL").join(units, F.col("first_unit") == F.col("unit_id"))
    by_object = placed.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("object_count"), F.sum("known_bytes").alias("known_bytes"), F.count_if(~F.col("size_known")).alias("unknown_size_objects"),
        F.count_if(F.col("consumers") > 1).alias("shared_object_count"))
    by_unit = units.groupBy("group_id").agg(F.count(F.lit(1)).alias("unit_count"))
    return units, by_object.join(by_unit, "group_id")


def plan_order(units: DataFrame, groups: DataFrame) -> DataFrame:
    """Dense order of planned units: groups of unknown size last, then by bytes (by objects where unknown), units by
    repository, accession and id inside a group. The numbers come from a range-partitioned sort."""
    unknown = F.col("g.unknown_size_objects") > 0
    joined = units.alias("u").join(groups.alias("g"), "group_id").select(
        "u.*", unknown.alias("_u"), F.when(unknown, F.col("g.object_count")).otherwise(F.col("g.known_bytes")).alias("_r"),
        F.col("g.known_bytes").alias("_b"), F.col("g.object_count").alias("_o"))
    ranked = global_rank(joined, ["_u", "_r", "_b", "_o", "group_id", "repository", "accession", "unit_id"], "order_index")
    return ranked.drop("_u", "_r", "_b", "_o")


def plan_totals(selected: DataFrame) -> DataFrame:
    """Counts of the plan as (measure, value, n): selected, planned, excluded, and both by reason and pool, in one pass.

    ``selected(unit_id, pool, reason)``."""
    out = F.col("reason").isNotNull()
    m = lambda name, value: F.struct(F.lit(name).alias("measure"), value.alias("value"))
    none = F.lit(None).cast("string")
    measures = F.array_compact(F.array(
        m("selected_units", none), F.when(out, m("excluded_units", none)), F.when(~out, m("planned_units", none)),
        F.when(out, m("excluded_by_reason", F.col("reason"))), F.when(~out, m("planned_by_pool", F.col("pool")))))
    return selected.select(F.explode(measures).alias("m")).groupBy("m.measure", "m.value").agg(F.count(F.lit(1)).alias("n"))


def object_totals(uses: DataFrame) -> DataFrame:
    """Distinct objects and bytes of the planned units, each object once."""
    return object_sizes(uses).agg(
        F.count(F.lit(1)).alias("distinct_objects"), F.coalesce(F.sum(F.when(F.col("size_known"), F.col("known_bytes"))), F.lit(0)).alias("distinct_bytes_known"),
        F.coalesce(F.sum("known_bytes"), F.lit(0)).alias("distinct_bytes_lower_bound"), F.count_if(~F.col("size_known")).alias("unknown_size_objects"))


def partner_bytes_once(units: DataFrame) -> DataFrame:
    """Bytes of the planned units, partners that read one set of files counted once (with the positive one).

    ``units(unit_key, sibling_key, ion_mode, known_bytes)``."""
    keys = units.select(F.col("unit_key").alias("_k")).distinct()
    both = units.join(keys, F.col("sibling_key") == F.col("_k"), "left")
    twice = (F.col("ion_mode") == "negative") & F.col("_k").isNotNull()
    return both.agg(F.sum("known_bytes").alias("all_bytes"), F.sum(F.when(~twice, F.col("known_bytes"))).alias("bytes_once"),
                    F.count_if(twice).alias("partners"))


def plan_reason(units: DataFrame) -> DataFrame:
    """The first reason a decided unit is left out of the plan.

    Reads ``document, readable, verdict, status, unresolved_rows, record_ok, contrast_intact``."""
    why = F.coalesce(
        F.when(~F.col("document"), "triage_missing"), F.when(~F.col("readable"), "triage_unreadable"),
        F.when(F.col("verdict") != "pass", "triage_not_pass"), F.when(F.col("status") == "excluded", "triage_unit_excluded"),
        F.when(F.col("unresolved_rows") > 0, "triage_member_unresolved"), F.when(~F.col("record_ok"), "triage_record_mismatch"),
        F.when(~F.col("contrast_intact"), "class_contrast_lost_after_triage"))
    return units.withColumn("plan_reason", why)


def download_only(units: DataFrame) -> DataFrame:
    """Held units that are downloaded and kept, with every reason code.

    Reads ``plan_reason, verdict, status, questions, blocking, dropped_reasons`` (arrays of codes)."""
    held = units.where(F.col("plan_reason").isin("triage_missing", "triage_not_pass") & (F.coalesce(F.col("status"), F.lit("")) != "excluded"))
    tag = lambda p, c: F.transform(F.coalesce(F.array_sort(c), F.array().cast("array<string>")), lambda x: F.concat(F.lit(p), x))
    codes = F.array_distinct(F.concat(
        F.array_compact(F.array(F.when(F.col("verdict") != "pass", F.concat(F.lit("validator:"), "verdict")),
                                F.when(F.col("status") != "ready", F.concat(F.lit("status:"), "status")))),
        tag("question:", "questions"), tag("blocking_flag:", "blocking"), tag("excluded_rows:", "dropped_reasons")))
    return held.withColumn("reason_codes", codes)


def explode_children(units: DataFrame, children: DataFrame) -> DataFrame:
    """One plan entry per child, keyed ``<unit>-<child>``; a unit without children is one entry."""
    c = children.select("unit_id", "child_key", F.col("ion_mode").alias("c_ion"), F.col("acquisition_mode").alias("c_acq")).distinct()
    return units.join(c, "unit_id", "left").select(
        *[x for x in units.columns if x not in ("ion_mode", "acquisition_mode")], "child_key",
        F.when(F.col("child_key").isNull(), F.col("unit_id")).otherwise(F.concat_ws("-", "unit_id", "child_key")).alias("unit_key"),
        F.coalesce("c_ion", "ion_mode").alias("ion_mode"), F.coalesce("c_acq", "acquisition_mode").alias("acquisition_mode"))


def derive_polarity_children(units: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two children of each unit: its switching rows kept, polarity set, the sibling linked."""
    split = units.select("unit_id", F.explode(F.array(F.lit("positive"), F.lit("negative"))).alias("child_ion_mode")).withColumn(
        "sibling_ion_mode", F.when(F.col("child_ion_mode") == "positive", "negative").otherwise("positive"))
    heads = split.select(F.concat_ws("-", "unit_id", F.substring("child_ion_mode", 1, 3)).alias("unit_key"), "unit_id", F.lit("ready").alias("status"),
                         "child_ion_mode", F.concat_ws("-", "unit_id", F.substring("sibling_ion_mode", 1, 3)).alias("sibling_unit_key"))
    moved = items.withColumn("moved", F.coalesce(F.col("reason") == "polarity_switching", F.lit(False)))
    rows = moved.join(split, "unit_id").select(
        F.concat_ws("-", "unit_id", F.substring("child_ion_mode", 1, 3)).alias("unit_key"), "row_index", "kind", "moved",
        F.when(F.col("moved"), F.lit(None)).otherwise(F.col("reason")).alias("reason"),
        F.when(F.col("moved"), "switching").otherwise(F.col("ion_mode")).alias("ion_mode"))
    return heads, rows


def decision_events(plan: DataFrame) -> DataFrame:
    """One event row per unit and decision kind, with its standing, in a fixed order per unit.

    ``plan(unit_key, document, verdict, reopened, download_only)``."""
    e = lambda i, kind, standing, when: F.when(when, F.struct(F.lit(i).alias("step"), F.lit(kind).alias("kind"), F.lit(standing).alias("standing")))
    events = F.array_compact(F.array(
        e(0, "triage_recorded", "model_inference", F.col("document")), e(1, "triage_validated", "deterministic_check", F.col("verdict").isNotNull()),
        e(2, "unit_reopened", "accepted_decision", F.col("reopened")), e(3, "download_only_planned", "accepted_decision", F.col("download_only"))))
    return plan.select("unit_key", F.explode(events).alias("e")).select("unit_key", "e.step", "e.kind", "e.standing")


def ledger_seed(plan: DataFrame) -> DataFrame:
    """Unit rows for a new ledger: pending, in plan order."""
    return plan.select(F.col("unit_id").alias("unit_key"), F.col("unit_id").alias("catalog_unit_id"), "repository", "accession", "order_index",
                       F.lit("run").alias("role"), F.col("group_id").alias("download_group_id"), "known_bytes", "size_known", "has_archive",
                       F.lit("pending").alias("state"), F.lit("none").alias("raw_disposition"))


def entries_digest(rows: DataFrame, unit: str, order: Column, entry: Column, width: int = 65536) -> DataFrame:
    """Order-sensitive digest of a unit's entries: digests of blocks of ``width`` positions, then of the block digests
    in order. A unit of any size is never one text. ``order`` is a whole number from 0."""
    cells = rows.select(unit, order.alias("_o"), entry.alias("_e")).withColumn("_block", F.floor(F.col("_o") / F.lit(width)))
    join = lambda column: F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct(*column))), lambda x: x[column[-1]]))
    blocks = cells.groupBy(unit, "_block").agg(F.sha2(join(["_o", "_e"]), 256).alias("_d"), F.count(F.lit(1)).alias("_n"))
    return blocks.groupBy(unit).agg(F.sha2(join(["_block", "_d"]), 256).alias("digest"), F.sum("_n").alias("entries"))


def selection_entries(kept: DataFrame, listing: DataFrame) -> DataFrame:
    """Canonical entries of kept items with checksum and size from the listing.

    ``kept(unit_id, member_path, archive, row_index)``, ``listing(path_key, archive, crc32, size)``."""
    listed = listing.select("path_key", F.col("archive").alias("l_archive"), "crc32", "size")
    both = kept.withColumn("path_key", F.lower(names.norm_path("member_path"))).join(listed, "path_key", "left")
    form = text.canonical_json({
        "unit_id": F.col("unit_id"), "child_key": F.lit(None).cast("string"), "member_path": names.norm_path("member_path"),
        "archive_name": F.coalesce("archive", "l_archive"), "crc32": F.lpad(F.upper("crc32"), 8, "0"), "size": F.col("size"), "sample_row_index": F.col("row_index")})
    return both.select("unit_id", "row_index", names.norm_path("member_path").alias("path"), form.alias("entry"))


# ---- disk ---------------------------------------------------------------------

def observed_factor(observations: DataFrame, value: str) -> DataFrame:
    """The discrete 0.9 quantile of what units used, where at least five were measured (one row or none)."""
    seen = observations.where(F.col(value) > 0)
    at = F.greatest(F.lit(0), F.ceil(F.lit(vocab.OBSERVED_QUANTILE) * F.col("_total")) - 1)
    return rank_value(seen, [], value, at, "factor").where(F.col("n") >= vocab.OBSERVED_MINIMUM).select("factor", "n")


def disk_needs(units: DataFrame, observed: DataFrame) -> DataFrame:
    """Bytes each unit takes on a volume. ``observed`` is at most one row."""
    one = observed.select("factor").agg(F.max("factor").alias("_f"))
    with_factor = units.crossJoin(F.broadcast(one))
    factor = policy.disk_factor(F.col("has_archive"), F.col("_f"))
    return with_factor.withColumn("factor", factor).withColumn(
        "need", policy.disk_need(F.col("known_bytes"), F.col("size_known"), F.col("factor"), F.col("held_bytes"))).drop("_f")


def disk_verdicts(needs: DataFrame, free: Column, total: Column) -> DataFrame:
    reserve = policy.disk_reserve(total)
    held = F.greatest(F.coalesce("held_bytes", F.lit(0)), F.lit(0))
    return needs.withColumn("admit", free - reserve >= F.greatest(F.lit(0), F.col("need") - held)).withColumn(
        "never_fits", F.col("need") > F.greatest(F.lit(0), total - reserve))


def claims_to_make(starting: DataFrame, units: DataFrame, uses: DataFrame) -> DataFrame:
    """Claims for the other members of starting units' groups that still download: objects of each such member.

    ``starting(unit_id)``, ``units(unit_id, group_id, downloads)``."""
    s = starting.select("unit_id").distinct()
    groups = units.join(s, "unit_id", "left_semi").groupBy("group_id").agg(F.count(F.lit(1)).alias("starters"), F.min("unit_id").alias("only"))
    # A member claims for itself only through another starter of its group.
    members = units.where("downloads").join(groups, "group_id").where("starters > 1 OR unit_id <> only")
    return uses.select("unit_id", "object_id").join(members.select("unit_id"), "unit_id", "left_semi")


def group_siblings(units: DataFrame) -> DataFrame:
    """Per unit how many other units its group holds, without its polarity siblings."""
    per_group = units.groupBy("group_id").agg(F.count(F.lit(1)).alias("g"))
    per_parent = units.groupBy("group_id", "parent").agg(F.count(F.lit(1)).alias("p"))
    return units.join(per_group, "group_id").join(per_parent, ["group_id", "parent"]).select(
        "unit_id", "group_id", (F.col("g") - F.col("p")).alias("siblings"))
