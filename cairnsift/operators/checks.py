"""Checks over decision documents. A check takes tables and returns findings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnsift import vocab
from cairnsift.functions import names, text, tokens
from cairnsift.operators import matching
from cairnsift.session import stored

# A check's share of a scan: its id, severity, subject, and its rules as (message, condition).
Part = tuple[str, Column | str, Column, list[tuple[str | Column, Column]]]

FINDING = ("check_id", "severity", "unit_id", "subject", "message")


def _c(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def findings(rows: DataFrame, check: str, severity: Column | str, subject: Column, message: Column | str, unit: str = "unit_id") -> DataFrame:
    return rows.select(F.lit(check).alias("check_id"), _c(severity).alias("severity"), F.col(unit).alias("unit_id"),
                       subject.cast("string").alias("subject"), _c(message).alias("message"))


def by_rules(rows: DataFrame, check: str, subject: Column, rules: dict[str, Column], severity: Column | str = "error") -> DataFrame:
    """Several rules over one scan: each row gives the messages whose rule holds."""
    said = F.array_compact(F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(message)) for message, rule in rules.items()]))
    return findings(rows.withColumn("_said", said).withColumn("_m", F.explode("_said")), check, severity, subject, F.col("_m"))


def by_all(rows: DataFrame, parts: list[Part]) -> DataFrame:
    """The rules of several checks over one scan: each row gives one finding per rule that holds."""
    said = [F.when(F.coalesce(rule, F.lit(False)), F.struct(
        F.lit(check).alias("check_id"), _c(severity).alias("severity"), subject.cast("string").alias("subject"), (F.lit(m) if isinstance(m, str) else m).alias("message")))
        for check, severity, subject, rules in parts for m, rule in rules]
    return rows.select("unit_id", F.explode(F.array_compact(F.array(*said))).alias("_s")).select("_s.check_id", "_s.severity", "unit_id", "_s.subject", "_s.message")


def run_checks(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def not_evaluable(units: DataFrame, check: str, message: str) -> DataFrame:
    """A check without its inputs holds every unit: what was not checked is not passed."""
    return findings(units.select("unit_id").distinct(), check, "hold", F.col("unit_id"), message)


def verdict(found: DataFrame, units: DataFrame, scope: str = "accession") -> DataFrame:
    """Verdicts per unit and per scope (unit null): error over hold over pass; notes are neutral. Findings are counted per
    unit before they meet the units, so that counts move and not findings."""
    told = found.where("severity <> 'note'").groupBy("unit_id").agg(
        F.count_if(F.col("severity") == "error").alias("_errors"), F.count_if(F.col("severity") == "hold").alias("_holds"))
    per = units.select("unit_id", scope).distinct().join(told, "unit_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c[1:])
    return per.rollup(scope, "unit_id").agg(
        total("_errors"), total("_holds"), F.grouping("unit_id").alias("_gu"), F.grouping(scope).alias("_ga")).where("_ga = 0").select(
        scope, F.when(F.col("_gu") == 0, F.col("unit_id")).alias("unit_id"),
        F.when(F.col("errors") > 0, "error").when(F.col("holds") > 0, "hold").otherwise("pass").alias("verdict"), "errors", "holds")


def top_findings(found: DataFrame, k: int = 20, kept: bool = False) -> DataFrame:
    """The first k findings per unit and check, with the total each row belongs to. The ranking keeps k rows per
    group before the shuffle; the totals are their own aggregate. Findings are stored first, so that checks run once,
    unless they are ``kept`` already."""
    found = found if kept else stored(found)
    order = Window.partitionBy("unit_id", "check_id").orderBy("subject", "message")
    first = found.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k)
    total = found.groupBy("unit_id", "check_id").agg(F.count(F.lit(1)).alias("total"))
    return first.join(total, ["unit_id", "check_id"])


# ---- the set and its rows -----------------------------------------------------

def t_set(documents: DataFrame, catalog_units: DataFrame) -> DataFrame:
    """One document per unit, and one for every catalog unit."""
    twice = documents.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    missing = catalog_units.select("unit_id").distinct().join(documents.select("unit_id"), "unit_id", "left_anti")
    return findings(twice, "T-SET", "error", F.col("n"), "triaged_twice").unionByName(
        findings(missing, "T-SET", "hold", F.col("unit_id"), "no_document"))


def schema_rules(domains: dict[str, tuple[str, ...]]) -> dict[str, Column]:
    return {f"bad_{c}": ~F.col(c).isin(*values) for c, values in domains.items()}


def t_schema(items: DataFrame, domains: dict[str, tuple[str, ...]]) -> DataFrame:
    """Values outside their closed domains."""
    return by_rules(items, "T-SCHEMA", F.col("row_index"), schema_rules(domains))


def t_cover(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Rows out of range, listed more than once, or neither kept nor excluded."""
    rows = items.where("row_index IS NOT NULL").groupBy("unit_id", "row_index").agg(F.count(F.lit(1)).alias("n"))
    placed = rows.join(documents.select("unit_id", "catalog_row_count"), "unit_id")
    out_of_range = placed.where("row_index >= catalog_row_count")
    twice = placed.where("n > 1 AND row_index < catalog_row_count")
    inside = placed.where("row_index < catalog_row_count").groupBy("unit_id").agg(F.count(F.lit(1)).alias("seen"))
    short = documents.join(inside, "unit_id", "left").withColumn("missing", F.col("catalog_row_count") - F.coalesce("seen", F.lit(0))).where("missing > 0")
    return run_checks([
        findings(out_of_range, "T-COVER", "error", F.col("row_index"), "row_out_of_range"),
        findings(twice, "T-COVER", "error", F.col("row_index"), "row_twice"),
        findings(short, "T-COVER", "error", F.col("missing"), "rows_missing")])


def t_declared(documents: DataFrame, declared: DataFrame, flags: DataFrame) -> DataFrame:
    """Declared technical fields that differ without a disputed flag. ``declared(unit_id, ion_mode, chromatography)``."""
    disputed = flags.where("code = 'declared_technical_disputed'").select("unit_id").distinct()
    d = declared.select("unit_id", tokens.normalise_ion("ion_mode").alias("d_ion"), tokens.normalise_chromatography("chromatography").alias("d_chrom"))
    both = documents.join(d, "unit_id").join(disputed, "unit_id", "left_anti")
    return by_rules(both, "T-DECL", F.col("unit_id"), declared_rules())


def declared_rules() -> dict[str, Column]:
    return {"chromatography_differs": (F.col("d_chrom") != "unknown") & (F.col("chromatography") != F.col("d_chrom")),
            "ion_mode_differs": F.col("d_ion").isin("positive", "negative") & (F.col("ion_mode") != F.col("d_ion"))}


def unit_facts(documents: DataFrame, items: DataFrame, flags: DataFrame, questions: DataFrame, children: DataFrame) -> DataFrame:
    """One row per unit with what the status rules read: counts by conditional aggregates and bounded code sets."""
    reason = F.col("reason")
    kept = reason.isNull()
    row = F.col("kind") == "excluded_row"
    per = items.groupBy("unit_id").agg(
        F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"), F.count_if(row).alias("dropped_rows"),
        F.count_if(reason == "needs_person").alias("held"),
        F.count_if(row & reason.isin("no_signal_abstained", "needs_person")).alias("abstained_rows"),
        F.count_if(reason == "ms1_only_no_msms").alias("ms1_dropped"),
        F.count_if(reason == "shared_content_unassigned").alias("unassigned"),
        F.count_if(row & ~reason.isin(*vocab.NO_PRODUCT_ION_ROW_REASONS)).alias("other_row_reasons"),
        F.count_if(row & ~reason.isin("not_in_archive", "belongs_to_other_unit")).alias("own_rows_dropped"),
        F.count_if(kept & (F.col("basis") == "inferred") & (F.col("confidence") == "low")).alias("low"),
        F.collect_set(F.when(kept, F.col("acquisition_mode"))).alias("modes"))
    # Codes come from closed lists, so the sets are small whatever the number of rows.
    codes = flags.groupBy("unit_id").agg(F.collect_set("code").alias("flags"))
    asks = questions.groupBy("unit_id").agg(F.collect_set("code").alias("questions"))
    kids = children.groupBy("unit_id").agg(F.count_distinct("child_key").alias("children"))
    none = F.array().cast("array<string>")
    out = documents.join(per, "unit_id", "left").join(codes, "unit_id", "left").join(asks, "unit_id", "left").join(kids, "unit_id", "left")
    counts = ("kept", "dropped", "dropped_rows", "held", "abstained_rows", "ms1_dropped", "unassigned", "other_row_reasons", "own_rows_dropped", "low", "children")
    return out.select(*documents.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
                      F.coalesce("flags", none).alias("flags"), F.coalesce("questions", none).alias("questions"), F.coalesce("modes", none).alias("modes"))


def blocking(flags: Column, version: Column | str | None = None) -> Column:
    """The blocking ones among a unit's flags; an earlier policy version knows one more."""
    base = F.array(*[F.lit(f) for f in vocab.BLOCKING_FLAGS])
    if version is None:
        return F.array_sort(F.array_intersect(flags, base))
    more = F.array(*[F.lit(f) for f in vocab.BLOCKING_FLAGS + vocab.LEGACY_BLOCKING_FLAGS])
    return F.array_sort(F.array_intersect(flags, F.when(text.legacy_policy(version), more).otherwise(base)))


def t_status(facts: DataFrame) -> DataFrame:
    """The status lattice: what each status may carry."""
    return by_rules(facts, "T-STATUS", F.col("status"), status_rules())


def status_rules() -> dict[str, Column]:
    st, why, asked = F.col("status"), F.col("exclusion_reason"), F.size("questions") > 0
    out, ready = st == "excluded", st == "ready"
    held = blocking(F.col("flags"), "skill_version")
    shared = F.array_contains("flags", "shared_content")
    extra = F.when(why == "shared_content_unassigned", F.array_except(held, F.array(F.lit("shared_content")))).otherwise(held)
    return {
        "excluded_without_reason": out & ~F.coalesce(why.isin(*vocab.UNIT_EXCLUSION_REASONS), F.lit(False)),
        "excluded_keeps_files": out & (F.col("kept") > 0),
        "excluded_asks": out & asked,
        "excluded_has_children": out & (F.col("children") > 0),
        "excluded_holds_for_person": out & (F.col("held") > 0),
        "excluded_with_blocking_flag": out & (F.size(extra) > 0),
        "no_product_ion_without_ms1_rows": out & (why == "no_product_ion_files") & (F.col("ms1_dropped") == 0),
        "no_product_ion_other_rows": out & (why == "no_product_ion_files") & (F.col("other_row_reasons") > 0),
        "no_files_with_own_rows": out & (why == "no_files") & (F.col("own_rows_dropped") > 0),
        "unassigned_without_flag": out & (why == "shared_content_unassigned") & ~shared,
        "unassigned_without_rows": out & (why == "shared_content_unassigned") & (F.col("unassigned") == 0),
        "exclusion_on_other_status": ~out & why.isNotNull(),
        "needs_person_without_question": (st == "needs_person") & ~asked,
        "ready_with_question": ready & asked,
        "abstained_keeps": (st == "abstained") & (F.col("kept") > 0),
        "abstained_without_abstained_rows": (st == "abstained") & (F.col("abstained_rows") == 0) & (F.col("catalog_row_count") > 0),
        "ready_keeps_nothing": ready & (F.col("kept") == 0),
        "ready_with_blocking_flag": ready & (F.size(held) > 0)}


def t_queue(facts: DataFrame) -> DataFrame:
    waiting = facts.where("status NOT IN ('ready', 'excluded')")
    return findings(waiting, "T-QUEUE", "hold", F.col("status"), F.array_join(F.array_sort("questions"), ";"))


def t_unit_technical(facts: DataFrame) -> DataFrame:
    return by_all(facts, technical_parts())


def technical_parts() -> list[Part]:
    ready = F.col("status") == "ready"
    return [("T-POL", "error", F.col("ion_mode"), [
        ("ready_ion_mode", ready & F.col("ion_mode").isin("switching", "unknown")),
        ("ready_both_without_children", ready & (F.col("ion_mode") == "both") & (F.col("children") == 0))]),
        ("T-CHROM", "error", F.col("chromatography"), [("ready_unknown", ready & (F.col("chromatography") == "unknown"))])]


def t_confidence(facts: DataFrame, answered: DataFrame) -> DataFrame:
    """A ready unit resting on an inferred low-confidence file needs a person's answer."""
    low = facts.where("status = 'ready' AND low > 0").join(
        answered.where("code = 'inferred_low_confidence'").select("unit_id").distinct(), "unit_id", "left_anti")
    return findings(low, "T-CONFIDENCE", "hold", F.col("low"), "inferred_low_confidence")


# ---- exclusions ---------------------------------------------------------------

def t_exclusion(items: DataFrame, facts: DataFrame) -> DataFrame:
    """Exclusion reasons that contradict the unit's own state."""
    out = items.where("reason IS NOT NULL").join(facts.select("unit_id", "status", "exclusion_reason", "flags", "questions"), "unit_id")
    return by_rules(out, "T-EXCL", F.coalesce("member_path", "raw_file"), exclusion_rules())


def exclusion_rules() -> dict[str, Column]:
    r, st = F.col("reason"), F.col("status")
    said = F.size(F.array_union(tokens.product_ion_words(F.coalesce("member_path", F.lit(""))), tokens.product_ion_words(F.coalesce("raw_file", F.lit(""))))) > 0
    has = lambda code: F.array_contains("flags", code)
    return {
        "needs_person_unasked": (r == "needs_person") & ((st == "ready") | (F.size("questions") == 0)),
        "no_signal_unasked": (r == "no_signal_abstained") & ((st == "ready") | ((st != "abstained") & ~F.array_contains("questions", "no_signal"))),
        "polarity_switching_unflagged": (r == "polarity_switching") & ~has("polarity_switching"),
        "ms1_name_says_product_ions": (r == "ms1_only_no_msms") & said,
        "ms1_unflagged": (r == "ms1_only_no_msms") & ~said & ~has("ms1_only_excluded"),
        "ms1_low_confidence": (r == "ms1_only_no_msms") & ~said & has("ms1_only_excluded") & (F.col("confidence") == "low"),
        "unassigned_in_other_unit": (r == "shared_content_unassigned") & ~F.coalesce((st == "excluded") & (F.col("exclusion_reason") == "shared_content_unassigned"), F.lit(False)),
        "conversion_not_needed": (r == "requires_conversion") & F.coalesce(names.is_runnable(F.coalesce("member_path", "raw_file")), F.lit(False))}


def absent_items(keyed: DataFrame, members: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Items said to be absent, with ``there``: the listing (of their scope) has the path, or for a bare name any member
    of that name or stem, also where several carry it."""
    (own_m, same_m), (own_n, same_n), (own_s, same_s) = (matching.within(scope, tag) for tag in ("_m_", "_n_", "_s_"))
    listed = members.select(*own_m, F.col("member_key").alias("_m")).distinct()
    by_name = matching.index_names(members, scope).select(*own_n, F.col("name").alias("_name"), "name_n")
    by_stem = matching.index_stems(members, scope).select(*own_s, F.col("stem").alias("_stem"), "stem_n")
    absent = keyed.where("reason = 'not_in_archive'").join(listed, same_m & (F.col("key") == F.col("_m")), "left")
    absent = absent.join(by_name, same_n & (F.lower(names.basename("raw_file")) == F.col("_name")), "left").join(
        by_stem, same_s & (F.lower(names.stem("raw_file")) == F.col("_stem")), "left")
    bare = F.coalesce(F.col("member_path"), F.lit("")) == ""
    return absent.select(*keyed.columns, (F.col("_m").isNotNull() | (bare & (F.col("name_n").isNotNull() | F.col("stem_n").isNotNull()))).alias("there"))


def t_exclusion_listing(keyed: DataFrame, members: DataFrame, groups: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Exclusion reasons the listing contradicts: a file said to be absent is listed, a copy has no twin.

    ``keyed``: items with ``key`` and ``resolved``."""
    there = absent_items(keyed, members, scope).where("there")
    own, same = matching.within(scope, "_g_")
    alone = keyed.where("reason IN ('duplicate_content', 'shared_content_unassigned')").join(
        groups.select(*own, F.col("member_key").alias("_m")), same & (F.col("key") == F.col("_m")), "left_anti")
    return findings(there, "T-EXCL", "error", F.col("key"), "listed_after_all").unionByName(
        findings(alone, "T-EXCL", "error", F.col("key"), "no_twin"))


def t_unopened(keyed: DataFrame, members: DataFrame, listing: DataFrame, scope: Sequence[str] = ("accession",), shown: int = 3) -> DataFrame:
    """Units with files said to be absent while their listing holds archives nobody opened: the files may be inside.

    ``listing(path)`` with the scope's columns; the message names the number of archives and the first ``shown``."""
    nested = listing.where(names.is_nested_archive("path")).select(*scope, names.norm_path("path").alias("path")).distinct()
    # The ranking keeps a few rows per scope before the shuffle.
    first = nested.withColumn("_r", F.row_number().over(Window.partitionBy(*scope).orderBy("path"))).where(F.col("_r") <= shown)
    named = first.groupBy(*scope).agg(F.array_join(F.array_sort(F.collect_list("path")), ", ").alias("first"))
    total = nested.groupBy(*scope).agg(F.count(F.lit(1)).alias("archives")).join(named, list(scope))
    gone = absent_items(keyed, members, scope).where("NOT there").groupBy(*scope, "unit_id").agg(F.count(F.lit(1)).alias("rows"))
    held = gone.join(total, list(scope))
    return findings(held, "T-EXCL", "hold", F.col("rows"), F.concat(F.lit("unopened_archives: "), F.col("archives").cast("string"), F.lit(" ("), "first", F.lit(")")))


def kept_and_excluded(keyed: DataFrame) -> DataFrame:
    """Excluded members that the unit also keeps (key equality, or stems where one is unresolved)."""
    gone = keyed.where("kind = 'excluded_member'").select("unit_id", "key", "resolved").distinct().withColumn("id", F.struct("unit_id", "key"))
    both = matching.same_file(gone, keyed.where("reason IS NULL"), ["unit_id"], "id")
    return findings(both.select("id.unit_id", "id.key"), "T-EXCL", "error", F.col("key"), "kept_and_excluded")


# ---- files across units -------------------------------------------------------

def t_unique(keyed: DataFrame, shares: DataFrame) -> DataFrame:
    """Files one unit keeps twice, files several units keep without all declaring it, and one acquisition kept in
    several encodings. A shared file is one group: units are counted, never paired."""
    kept = keyed.where("reason IS NULL AND resolved")
    twice = kept.groupBy("unit_id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    owners = kept.select("unit_id", "key").distinct()
    groups = owners.groupBy("key").agg(F.count(F.lit(1)).alias("units"), F.min("unit_id").alias("unit_id")).where("units > 1")
    # A file is settled when every one of its owners declares sharing it with each of the others.
    declared = shares.select("unit_id", "other_unit_id", names.member_key("member_path").alias("key")).distinct()
    mutual = declared.join(owners, ["unit_id", "key"], "left_semi").join(
        owners.withColumnRenamed("unit_id", "other_unit_id"), ["other_unit_id", "key"], "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("declared"))
    open_ = groups.join(mutual, "key", "left").where(F.coalesce("declared", F.lit(0)) < F.col("units") * (F.col("units") - 1))
    formats = kept.groupBy("unit_id", matching.key_stem("key").alias("stem")).agg(
        F.count_distinct(names.ext_known("key")).alias("n")).where("n > 1")
    return run_checks([
        findings(twice, "T-UNIQ", "error", F.col("key"), "kept_twice"),
        findings(open_, "T-UNIQ", "error", F.col("key"), F.concat(F.lit("shared_by_"), F.col("units").cast("string"))),
        findings(formats, "T-UNIQ", "error", F.col("stem"), "two_encodings")])


# ---- kept files ---------------------------------------------------------------

def t_files(items: DataFrame, facts: DataFrame) -> DataFrame:
    """Per kept file: polarity, chromatography, format, evidence, name tokens and header values, in one scan."""
    kept = items.where("reason IS NULL").join(facts.select(
        "unit_id", "status", F.col("ion_mode").alias("u_ion"), F.col("chromatography").alias("u_chrom"), "flags"), "unit_id")
    return by_all(kept, file_parts())


def file_parts() -> list[Part]:
    """``u_ion`` and ``u_chrom`` are the unit's own values."""
    path = F.coalesce("member_path", "raw_file")
    ion, chrom, ready = F.col("ion_mode"), F.col("chromatography"), F.col("status") == "ready"
    single = F.col("u_ion").isin("positive", "negative")
    calm = ~F.array_contains("flags", "name_token_disputed")
    header = (F.col("source") == "raw_header") & F.col("field").isin("polarity", "ion_mode")
    read = tokens.normalise_ion("value")
    rules = {
        "T-FORMAT": {"needs_conversion": (F.col("status") != "out_of_scope") & names.needs_conversion(path)},
        "T-POL": {"switching_unflagged": (ion == "switching") & ~F.array_contains("flags", "polarity_switching"),
                  "other_polarity": single & ion.isin("positive", "negative") & (ion != F.col("u_ion")),
                  "mixed_in_single": single & ion.isin("switching", "both"), "unknown_in_ready": (ion == "unknown") & ready},
        "T-CHROM": {"other_chromatography": (chrom != "unknown") & (F.col("u_chrom") != "unknown") & (chrom != F.col("u_chrom")),
                    "unknown_in_ready": (chrom == "unknown") & ready},
        "T-EVID": {"declared_without_declaration": (F.col("basis") == "declared") & ~F.col("source").isin(*vocab.DECLARED_SOURCES),
                   "weak_evidence_only": ready & (F.col("source") == "archive_listing") & F.lower("field").isin(*vocab.WEAK_FIELDS)},
        "T-TOKEN": {"polarity_token": calm & ion.isin("positive", "negative") & (tokens.token_polarity(path) != ion),
                    "chromatography_token": calm & chrom.isin("HILIC", "RP") & (tokens.token_chromatography(path) != chrom),
                    "acquisition_token": calm & tokens.acquisition_problem(path, "acquisition_mode").isNotNull()},
        "T-HEADER": {"header_polarity": header & read.isin("positive", "negative", "switching") & (read != ion)},
    }
    return [(check, "error", path, list(more.items())) for check, more in rules.items()]


def t_acquisition(items: DataFrame, facts: DataFrame) -> DataFrame:
    """Acquisition modes of a unit's kept files against its flags; targeted DDA counts as DDA."""
    modes = items.where("reason IS NULL").groupBy("unit_id").agg(F.collect_set("acquisition_mode").alias("modes"))
    both = facts.select("unit_id", "status", "flags", F.col("acquisition_mode").alias("u_acq")).join(modes, "unit_id")
    return by_rules(both, "T-ACQ", F.array_join(F.array_sort("modes"), "+"), acquisition_rules("u_acq"))


def acquisition_rules(unit_mode: str) -> dict[str, Column]:
    base = F.array_distinct(F.transform(F.filter("modes", lambda m: m != "unknown"), lambda m: F.when(m == "targeted_DDA", "DDA").otherwise(m)))
    has = lambda code: F.array_contains("flags", code)
    return {"ms1_unflagged": F.array_contains("modes", "MS1") & ~has("ms1_only"),
            "targeted_unflagged": F.array_contains("modes", "targeted_DDA") & ~has("targeted_dda"),
            "mixed_unflagged": (F.size(base) > 1) & ~has("mixed_acquisition"),
            "unknown_in_ready": F.array_contains("modes", "unknown") & (F.col("status") == "ready") & (F.col(unit_mode) == "unknown")}


def t_member(keyed: DataFrame, members: DataFrame, facts: DataFrame) -> DataFrame:
    """Kept files that are not listed, or whose name resolves to no single member."""
    kept = keyed.where("reason IS NULL")
    absent = kept.where("member_path IS NOT NULL").join(members.select(F.col("member_key").alias("_m")), F.col("key") == F.col("_m"), "left_anti")
    loose = kept.where("NOT resolved").join(facts.select("unit_id", "status"), "unit_id")
    return findings(absent, "T-MEMBER", "error", F.col("key"), "not_listed").unionByName(
        findings(loose, "T-MEMBER", F.when(F.col("status") == "ready", "error").otherwise("hold"), F.col("key"), "unresolved"))


def modes_per_run(kept: DataFrame) -> DataFrame:
    """Distinct modes per unit and child with targeted DDA folded into DDA, and whether they mix.

    ``kept(unit_id, child_key, acquisition_mode)``; modes come from a closed list."""
    mode = F.when(F.col("acquisition_mode") == "targeted_DDA", "DDA").otherwise(F.col("acquisition_mode"))
    per = kept.where("acquisition_mode <> 'unknown'").groupBy("unit_id", "child_key").agg(F.array_sort(F.collect_set(mode)).alias("m"))
    return per.select("unit_id", "child_key", F.array_join("m", "+").alias("modes"), (F.size("m") > 1).alias("mixed"))


def flag_union(flags: DataFrame, questions: DataFrame, documents: DataFrame) -> DataFrame:
    """Per unit the sorted flag and question codes, and the blocking ones under the unit's policy version."""
    none = F.array().cast("array<string>")
    f = flags.groupBy("unit_id").agg(F.collect_set("code").alias("f"))
    q = questions.groupBy("unit_id").agg(F.collect_set("code").alias("q"))
    out = documents.select("unit_id", "skill_version").join(f, "unit_id", "left").join(q, "unit_id", "left")
    fl = F.coalesce("f", none)
    return out.select("unit_id", F.array_join(F.array_sort(fl), ",").alias("flags"), F.array_join(F.array_sort(F.coalesce("q", none)), ",").alias("questions"),
                      F.array_join(blocking(fl, "skill_version"), ",").alias("blocking"))


def decision_stats(items: DataFrame) -> DataFrame:
    """Per unit: kept by basis, confidence and role, dropped by reason, as (unit, measure, value, n)."""
    kept = F.col("reason").isNull()
    measures = F.array_compact(F.array(
        *[F.when(kept, F.struct(F.lit(f"kept_by_{c}").alias("measure"), F.col(c).alias("value"))) for c in ("basis", "confidence", "role")],
        F.when(~kept, F.struct(F.lit("dropped_by_reason").alias("measure"), F.col("reason").alias("value")))))
    return items.select("unit_id", F.explode(measures).alias("m")).groupBy("unit_id", "m.measure", "m.value").agg(F.count(F.lit(1)).alias("n"))


def counts(items: DataFrame, key: str) -> DataFrame:
    return items.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def polarity_hold(facts: DataFrame, items: DataFrame) -> DataFrame:
    """Why a unit is not held on polarity switching alone, or empty where it is; with its own polarity rule."""
    taken = items.where("reason = 'polarity_switching'").groupBy("unit_id").agg(
        F.count(F.lit(1)).alias("taken"), F.count_if(F.col("member_path").isNull()).alias("unresolved"),
        F.count_if(F.col("kind") == "excluded_member").alias("members"))
    f = facts.join(taken, "unit_id", "left")
    others = F.array_except(blocking(F.col("flags"), "skill_version"), F.array(F.lit("polarity_switching")))
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    why = (F.when(F.col("status") != "needs_person", "status")
           .when(~((F.size("questions") == 1) & F.array_contains("questions", "polarity_switching")), "questions")
           .when(F.col("children") > 0, "children").when(~F.array_contains("flags", "polarity_switching"), "no_flag")
           .when(F.size(others) > 0, "other_flags").when(n("taken") == 0, "no_row").when(n("unresolved") > 0, "unresolved_rows")
           .when(F.col("held") > 0, "held_rows").when(n("members") > 0, "members").otherwise(""))
    split = F.when(why != "", why).when(F.col("ion_mode") != "switching", "ion_mode").otherwise("")
    own = F.when(why != "", why).when(~F.col("ion_mode").isin("positive", "negative"), "ion_mode").otherwise("")
    return f.select("unit_id", split.alias("split_refusal"), own.alias("own_refusal"))
