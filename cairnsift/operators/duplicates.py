"""Byte-identical content, set fingerprints and folder profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from cairnsift import vocab
from cairnsift.functions import names, tokens
from cairnsift.scale import PRINT, global_rank, rank_value, set_print
from cairnsift.session import stored


def content_groups(members: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Members with a byte-identical twin (in their scope): ``(member_key, group_id)``.

    A raw-like file counts by checksum and size (at least 1,024 bytes), a vendor folder by the set of its
    parts. Groups are keys, so a content held by many members is one group and never a list of pairs."""
    # Rows without a path are in neither part below. A key that can't be null gets no test for null from the joins of the
    # result, so that both readings of what is placed stay the same plan and run once.
    keyed = members.select(
        *scope, F.coalesce(names.member_key("path"), F.lit("")).alias("member_key"), names.in_vendor_folder("path").alias("in_folder"),
        names.is_raw_like("path").alias("raw_like"), "crc32", "size",
        F.lower(names.norm_path("path")).alias("full"))
    single = keyed.where(~F.col("in_folder") & F.col("raw_like") & (F.col("size") >= vocab.MIN_DUPLICATE_BYTES) & (F.col("crc32") != "")).select(
        *scope, "member_key", F.concat_ws(":", F.lit("file"), "crc32", F.col("size").cast("string")).alias("group_id"))
    parts = keyed.where("in_folder").select(*scope, "member_key", F.expr("substr(full, length(member_key) + 1)").alias("inner_path"), "crc32", "size")
    folder = parts.groupBy(*scope, "member_key").agg(F.count(F.lit(1)).alias("n"), *set_print("inner_path", "crc32", "size")).select(
        *scope, "member_key", F.concat_ws(":", F.lit("folder"), *[F.col(c).cast("string") for c in ("n", *PRINT)]).alias("group_id"))
    placed = single.unionByName(folder).distinct()
    shared = placed.groupBy(*scope, "group_id").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return placed.join(shared, [*scope, "group_id"]).select(*scope, "member_key", "group_id", "members")


def twin_ids(groups: DataFrame) -> DataFrame:
    """Stable ids T1, T2, ... per content group, in the order of the groups' smallest members."""
    first = groups.groupBy("group_id").agg(F.min("member_key").alias("first_key"), F.max("members").alias("members"))
    ranked = global_rank(first, ["first_key", "group_id"], start=1)
    return ranked.select("group_id", "first_key", "members", F.concat(F.lit("T"), F.col("rank").cast("string")).alias("twin_id"))


def identical_row_tables(rows: DataFrame, unit: str, position: str, values: list[str]) -> DataFrame:
    """Units whose rows agree in order: one print per unit over (position, values)."""
    prints = rows.groupBy(unit).agg(F.count(F.lit(1)).alias("n"), *set_print(position, *values))
    return _equal(prints, unit)


def identical_kept_sets(kept: DataFrame, unit: str = "unit_id", key: str = "key") -> DataFrame:
    """Units that keep the same non-empty set of files."""
    prints = kept.select(unit, key).distinct().groupBy(unit).agg(F.count(F.lit(1)).alias("n"), *set_print(key))
    return _equal(prints, unit)


def _equal(prints: DataFrame, unit: str) -> DataFrame:
    group = prints.groupBy("n", *PRINT).agg(F.count(F.lit(1)).alias("units"), F.min(unit).alias("first_unit")).where("units > 1")
    return prints.join(group, ["n", *PRINT]).select(unit, "n", "units", "first_unit")


def canonical_keys(kept: DataFrame) -> DataFrame:
    """Unresolved keys replaced by the one kept member of their stem, where there is exactly one.

    ``kept(unit_id, key, key_stem, resolved)``."""
    firm = kept.where("resolved").select("key", "key_stem").distinct().groupBy("key_stem").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("only"))
    out = kept.join(firm.withColumnRenamed("key_stem", "_s"), (F.col("key_stem") == F.col("_s")) & ~F.col("resolved"), "left")
    return out.select(*kept.columns, F.when(~F.col("resolved") & (F.col("n") == 1), F.col("only")).otherwise(F.col("key")).alias("canonical"))


def folder_stats(members: DataFrame) -> DataFrame:
    """Per folder: members, extensions, smallest and largest size, and the upper median of raw-like sizes
    where at least three are held."""
    unique = members.where(~names.is_archive_metadata("path")).select(
        names.vendor_root("path").alias("shown"), "size").groupBy("shown").agg(F.sum("size").alias("size"))
    shaped = unique.withColumn("folder", F.when(F.col("shown").contains("/"), names.folder_key("shown")).otherwise("(root)"))
    # A folder has few extensions, however many members.
    per = shaped.groupBy("folder").agg(F.count(F.lit(1)).alias("members"), F.min("size").alias("min_size"), F.max("size").alias("max_size"),
                                       F.array_join(F.array_sort(F.collect_set(names.ext_shown("shown"))), ",").alias("extensions"))
    raw = shaped.where(names.is_raw_like("shown"))
    median = rank_value(raw, ["folder"], "size", F.floor(F.col("_total") / 2), "median").where("n >= 3").select(
        F.col("folder").alias("_f"), "median")
    return per.join(median, F.col("folder") == F.col("_f"), "left").drop("_f")


def small_members(members: DataFrame, stats: DataFrame) -> DataFrame:
    """Raw-like members under a tenth of their folder's median."""
    unique = members.where(~names.is_archive_metadata("path")).select(
        names.vendor_root("path").alias("shown"), "size").groupBy("shown").agg(F.sum("size").alias("size"))
    shaped = unique.where(names.is_raw_like("shown")).withColumn(
        "folder", F.when(F.col("shown").contains("/"), names.folder_key("shown")).otherwise("(root)"))
    return shaped.join(stats.select("folder", "median").where("median IS NOT NULL"), "folder").where(F.col("size") * 10 < F.col("median"))


def folder_pair_overlap(groups: DataFrame) -> DataFrame:
    """Two-member groups across two folders: how many pairs, and how many with the same file name.

    Both members are the group's minimum and maximum, so no pair is ever built in a bigger group."""
    two = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"), F.min("member_key").alias("a"), F.max("member_key").alias("b")).where("n = 2")
    root = lambda c: F.when(F.col(c).contains("/"), names.folder_key(c)).otherwise("(root)")
    pair = two.select(root("a").alias("fa"), root("b").alias("fb"), (names.basename("a") == names.basename("b")).alias("same")).where("fa <> fb")
    return pair.groupBy(F.least("fa", "fb").alias("folder_a"), F.greatest("fa", "fb").alias("folder_b")).agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if("same").alias("same_name"))


def level_word_counts(shown: DataFrame, name: str = "name") -> DataFrame:
    """Per kind and word: how many names carry it, and the first three of them."""
    words = shown.select(F.col(name).alias("name")).distinct().select(
        "name", F.explode(F.array_distinct(tokens.ms_level_words(names.stem("name")))).alias("word"))
    total = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("word").orderBy(F.lower("name"), "name")
    # Only three rows per word pass the window, before and after the shuffle.
    first = words.withColumn("_r", F.row_number().over(order)).where("_r <= 3").groupBy("word").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "name"))), lambda x: x["name"]), ", ").alias("examples"))
    return total.join(first, "word").select(F.substring_index("word", ":", 1).alias("kind"), F.substring_index("word", ":", -1).alias("label"), "n", "examples")


def attribute_profile(rows: DataFrame, ids: list[str], attributes: str = "attributes") -> DataFrame:
    """Each attribute: constant, identifier (all distinct over more than three rows and not echoed by the ids) or varying."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    pairs = rows.select(*ids, F.explode(attributes).alias("name", "value")).where("value IS NOT NULL")
    echoed = F.lit(False)
    for c in ids:
        echoed = echoed | (F.col("value") == F.col(c))
    per = pairs.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("values"), F.bool_and(echoed).alias("echoed"))
    kind = (F.when((F.col("n") == F.col("total")) & (F.col("values") == 1), "constant")
            .when((F.col("total") > 3) & (F.col("n") == F.col("total")) & (F.col("values") == F.col("n")) & ~F.col("echoed"), "identifier")
            .otherwise("varying"))
    # The total is one row.
    return per.crossJoin(F.broadcast(total)).select("name", "n", "values", kind.alias("kind"))


def study_shared_attributes(units: DataFrame, attributes: DataFrame) -> DataFrame:
    """(study, field, value) present in every unit of a study of several units.

    ``units(study_id, unit_id)``, ``attributes(unit_id, field, value)``."""
    size = units.groupBy("study_id").agg(F.count_distinct("unit_id").alias("n_units")).where("n_units >= 2")
    seen = attributes.select("unit_id", "field", "value").distinct().join(units, "unit_id").groupBy("study_id", "field", "value").agg(
        F.count(F.lit(1)).alias("n"))
    return seen.join(size, "study_id").where("n = n_units").select("study_id", "field", "value", "n_units")


def taken_keys(kept: DataFrame, held: DataFrame) -> DataFrame:
    return kept.select("key", "unit_id").unionByName(held.select("key", "unit_id")).distinct()


def shared_content_without_keepers(flags: DataFrame, subjects: DataFrame, groups: DataFrame, kept: DataFrame, held: DataFrame) -> DataFrame:
    """Units whose shared-content flag has no twin group with a file some unit keeps or holds for a person.

    ``subjects(unit_id, key)``: what each flag is about. ``held(unit_id, key, reason)``: a unit's own copies held as
    unassigned do not count for it, so a group needs a second holder or another unit's."""
    g = groups.select("member_key", "group_id")
    firm = kept.select("key").union(held.where("reason <> 'shared_content_unassigned'").select("key")).distinct()
    firm_groups = firm.join(g, firm["key"] == g["member_key"]).select("group_id").distinct().withColumn("firm", F.lit(True))
    loose = held.where("reason = 'shared_content_unassigned'").join(g, F.col("key") == F.col("member_key")).groupBy("group_id").agg(
        F.min("unit_id").alias("lo"), F.max("unit_id").alias("hi"))
    about = subjects.join(flags.select("unit_id").distinct(), "unit_id", "left_semi").join(g, F.col("key") == F.col("member_key")).select("unit_id", "group_id").distinct()
    judged = about.join(firm_groups, "group_id", "left").join(loose, "group_id", "left")
    ok = F.col("firm").isNotNull() | (F.coalesce((F.col("lo") != F.col("unit_id")) | (F.col("hi") != F.col("unit_id")), F.lit(False)))
    per = judged.groupBy("unit_id").agg(F.bool_or(ok).alias("kept"), F.count(F.lit(1)).alias("groups"))
    out = flags.select("unit_id").distinct().join(per, "unit_id", "left")
    return out.where(~F.coalesce("kept", F.lit(False))).select("unit_id", (F.coalesce("groups", F.lit(0)) > 0).alias("has_twins"))


def other_arm(holders: DataFrame, groups: DataFrame, placed: DataFrame) -> DataFrame:
    """Holders with a twin in another arm's place: in a folder where another unit keeps or holds a file, or under a
    name whose token contradicts the holder.

    ``holders(unit_id, key, ion_mode, chromatography)``, ``placed(unit_id, key)``. Both tests are counts per group
    less what is the holder's own, so a group's members never meet each other."""
    folders = placed.where(~F.col("key").startswith("raw:")).groupBy(names.folder_key("key").alias("folder")).agg(
        F.min("unit_id").alias("lo"), F.max("unit_id").alias("hi"))
    spots = groups.select("group_id", "member_key", names.folder_key("member_key").alias("folder"),
                          tokens.token_polarity("member_key").alias("pol"),
                          tokens.token_chromatography("member_key").alias("chrom")).join(folders, "folder", "left")
    per_group = spots.groupBy("group_id").agg(
        F.count("lo").alias("used"),
        *[F.count_if(F.col("pol") == v).alias(f"n_{v}") for v in ("positive", "negative")],
        *[F.count_if(F.col("chrom") == v).alias(f"n_{v}") for v in ("HILIC", "RP")])
    own = spots.where("lo = hi").groupBy("group_id", F.col("lo").alias("unit_id")).agg(F.count(F.lit(1)).alias("own"))
    h = holders.join(spots, F.col("key") == F.col("member_key")).join(per_group, "group_id").join(own, ["group_id", "unit_id"], "left")
    here = F.coalesce((F.col("lo") != F.col("unit_id")) | (F.col("hi") != F.col("unit_id")), F.lit(False))
    by_folder = F.col("used") - F.coalesce("own", F.lit(0)) - F.when(here, 1).otherwise(0) > 0

    def against(stated: str, value: str, opposite: str, token: str):
        rest = F.col(f"n_{opposite}") - F.when(F.col(token) == opposite, 1).otherwise(0)
        return (F.col(stated) == value) & (rest > 0)

    by_token = (against("ion_mode", "positive", "negative", "pol") | against("ion_mode", "negative", "positive", "pol")
                | against("chromatography", "HILIC", "RP", "chrom") | against("chromatography", "RP", "HILIC", "chrom"))
    return h.select(*holders.columns, "group_id", F.coalesce(by_folder, F.lit(False)).alias("by_folder"),
                    F.coalesce(by_token, F.lit(False)).alias("by_token"))


# ---- findings on byte-identical content ---------------------------------------

def twin_items(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """Resolved items whose file has a byte-identical twin, stored. A file without one is in no group, so that all that
    compares copies reads these only."""
    return stored(keyed.where("resolved").join(groups.select(F.col("member_key").alias("key")), "key", "left_semi"))


def shared_subjects(flags: DataFrame, questions: DataFrame, keyed: DataFrame, twins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each shared-content flag is about: the files it names; else those the unit's shared-content questions name;
    else the unit's own that have a twin (kept, held, and rows excluded as copies).

    ``flags`` and ``questions(unit_id, flag_no, code, row_indices, member_paths)``, ``keyed``: items with ``key`` and
    ``resolved``, ``twins``: those of ``twin_items``. Returns ``(unit_id, flag_no, subject)`` per flag and ``(unit_id,
    subject, key)``. Flags of one unit that name nothing share one subject, so a unit's files are listed once, whatever the
    number of its flags."""
    shared, asks = flags.where("code = 'shared_content'"), questions.where("code = 'shared_content'")
    at = lambda entries, *ids: entries.select("unit_id", *ids, F.explode("row_indices").alias("row_index"))
    # The rows that are asked for are looked up once, for flags and questions.
    firm = keyed.where(F.col("resolved") & F.col("kind").isin("row", "excluded_row")).select("unit_id", "row_index", "key")
    rows = stored(firm.join(at(shared).unionByName(at(asks)), ["unit_id", "row_index"], "left_semi").distinct())

    def named(entries: DataFrame, *ids: str) -> DataFrame:
        paths = entries.select("unit_id", *ids, F.explode("member_paths").alias("path")).select("unit_id", *ids, names.member_key("path").alias("key"))
        return paths.unionByName(at(entries, *ids).join(rows, ["unit_id", "row_index"]).select("unit_id", *ids, "key")).distinct()

    by_flag = named(shared, "flag_no")
    by_question = named(asks)
    own = twins.where(F.col("reason").isNull() | F.col("reason").isin(*vocab.HELD_REASONS) | ((F.col("kind") == "excluded_row") & (F.col("reason") == "duplicate_content")))
    has = by_flag.select("unit_id", "flag_no").distinct().withColumn("_named", F.lit(True))
    subjects = shared.select("unit_id", "flag_no").distinct().join(has, ["unit_id", "flag_no"], "left").select(
        "unit_id", "flag_no", F.when(F.col("_named"), F.col("flag_no")).otherwise(F.lit(-1)).cast("bigint").alias("subject"))
    loose = subjects.where("subject = -1").select("unit_id").distinct()
    asked = by_question.join(loose, "unit_id", "left_semi").select("unit_id", "key")
    rest = own.select("unit_id", "key").distinct().join(loose, "unit_id", "left_semi").join(by_question.select("unit_id"), "unit_id", "left_anti")
    keys = by_flag.select("unit_id", F.col("flag_no").cast("bigint").alias("subject"), "key").unionByName(
        asked.unionByName(rest).select("unit_id", F.lit(-1).cast("bigint").alias("subject"), "key"))
    return subjects, keys


def unkept_flags(subjects: DataFrame, keys: DataFrame, groups: DataFrame, kept: DataFrame, held: DataFrame) -> DataFrame:
    """Flags none of whose twin groups has a file that a unit keeps or holds: ``unit_id``, ``flag_no``, ``has_twins``.

    A unit's own unassigned copies do not count for it, so a group needs another unit's. Groups are judged once, by
    counts and the least and largest holder, and no two members of a group ever meet."""
    g = groups.select("member_key", "group_id")
    firm = kept.select("key").union(held.where("reason <> 'shared_content_unassigned'").select("key")).distinct()
    firm = firm.join(g, F.col("key") == F.col("member_key")).select("group_id").distinct().withColumn("_firm", F.lit(True))
    loose = held.where("reason = 'shared_content_unassigned'").join(g, F.col("key") == F.col("member_key")).groupBy("group_id").agg(
        F.min("unit_id").alias("lo"), F.max("unit_id").alias("hi"))
    about = keys.join(g, F.col("key") == F.col("member_key")).select("unit_id", "subject", "group_id").distinct()
    judged = about.join(firm, "group_id", "left").join(loose, "group_id", "left")
    other = F.coalesce((F.col("lo") != F.col("unit_id")) | (F.col("hi") != F.col("unit_id")), F.lit(False))
    per = judged.groupBy("unit_id", "subject").agg(F.bool_or(F.col("_firm").isNotNull() | other).alias("ok"))
    out = subjects.join(per, ["unit_id", "subject"], "left")
    return out.where(~F.coalesce("ok", F.lit(False))).select("unit_id", "flag_no", F.col("ok").isNotNull().alias("has_twins"))


def twin_holders(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Per kept file of a content group: whether its unit keeps another copy, and how many other units keep one.

    ``kept(unit_id, key)``. ``twin_units`` counts the units that keep another copy of the content, and ``twin_print``
    identifies that set: the group's units less the holder's own share and less those that keep this very file only."""
    h = F.xxhash64("unit_id").cast("decimal(20,0)")
    own = kept.select("unit_id", "key").distinct().join(groups.select(F.col("member_key").alias("key"), "group_id"), "key")
    per_unit = own.groupBy("group_id", "unit_id").agg(F.count(F.lit(1)).alias("copies"))
    total = per_unit.groupBy("group_id").agg(F.count(F.lit(1)).alias("units"), F.sum(h).alias("all"))
    both = own.join(per_unit, ["group_id", "unit_id"])
    single = F.col("copies") == 1
    only = both.groupBy("group_id", "key").agg(F.count_if(single).alias("only"), F.sum(F.when(single, h)).alias("only_print"))
    out = both.join(total, "group_id").join(only, ["group_id", "key"])
    mine = F.when(single, 0).otherwise(1)
    count = F.col("units") - F.col("only") - mine
    print_ = F.col("all") - F.coalesce("only_print", F.lit(0)) - mine * h
    # A path that is listed with several contents is in several groups; each group's keepers count.
    return out.groupBy("unit_id", "key").agg(F.bool_or(F.col("copies") > 1).alias("twin_inside"), F.sum(count).cast("bigint").alias("twin_units"), F.sum(print_).alias("twin_print"))


def placed_files(keyed: DataFrame) -> DataFrame:
    """The files that units keep or hold, wherever they lie. Folders take their least and largest unit, so repeats stay."""
    return keyed.where(F.col("resolved") & (F.col("reason").isNull() | F.col("reason").isin(*vocab.HELD_REASONS))).select("unit_id", "key")


def t_dup(facts: DataFrame, keyed: DataFrame, groups: DataFrame, flags: DataFrame, questions: DataFrame, answered: DataFrame) -> DataFrame:
    """Byte-identical content a unit keeps: shared with other units or arms, copied inside the unit, a copy that is not
    flagged, and flags about content nobody keeps. One finding per unit, set of other keepers and kind.

    ``facts(unit_id, status, flags)``, ``answered(unit_id, code)``; ``flags`` and ``questions`` as in ``shared_subjects``."""
    twins = twin_items(keyed.select("unit_id", "kind", "key", "resolved", "reason", "ion_mode", "chromatography"), groups)
    kept = twins.where("reason IS NULL").groupBy("unit_id", "key").agg(F.min(F.struct("ion_mode", "chromatography")).alias("m")).select("unit_id", "key", "m.*")
    held = twins.where(F.col("reason").isin(*vocab.HELD_REASONS)).select("unit_id", "key", "reason").distinct()
    subjects, keys = shared_subjects(flags, questions, keyed, twins)
    empty = stored(unkept_flags(subjects, keys, groups, kept, held))

    arms = other_arm(kept, groups, placed_files(keyed)).groupBy("unit_id", "key").agg(F.bool_or(F.col("by_folder") | F.col("by_token")).alias("arm"))
    told = answered.where("code = 'shared_content'").select("unit_id").distinct().withColumn("_told", F.lit(True))
    state = facts.select("unit_id", "status", F.col("flags").alias("_codes")).join(told, "unit_id", "left").select("unit_id", (
        F.array_contains("_codes", "shared_content") & ((F.col("status") != "ready") | F.coalesce("_told", F.lit(False)))).alias("settled"),
        F.array_contains("_codes", "duplicate_copies_excluded").alias("noted"))
    h = twin_holders(kept, groups).join(arms, ["unit_id", "key"], "left").join(state, "unit_id")
    alone = (F.col("twin_units") == 0) & ~F.col("twin_inside") & ~F.coalesce("arm", F.lit(False))
    h = stored(h.withColumn("kind", F.when(alone, "copy").otherwise("shared")))
    inside = h.where("twin_inside AND NOT settled").select("unit_id", F.col("key").alias("subject"), F.lit("error").alias("severity"), F.lit("twin_in_unit").alias("message"))
    once = h.groupBy("unit_id", "twin_units", "twin_print", "kind", "settled", "noted").agg(F.min("key").alias("subject"))
    message = (F.when(F.col("settled"), "waits_for_person").when(F.col("kind") == "shared", "shared_unflagged").when(~F.col("noted"), "copy_unflagged"))
    shared = once.select("unit_id", "subject", F.when(F.col("settled"), "hold").otherwise("error").alias("severity"), message.alias("message")).where("message IS NOT NULL")
    nobody = empty.select("unit_id", F.col("flag_no").cast("string").alias("subject"), F.lit("error").alias("severity"),
                          F.when(F.col("has_twins"), "flag_without_keeper").otherwise("flag_without_twin").alias("message"))
    found = inside.unionByName(shared).unionByName(nobody)
    return found.select(F.lit("T-DUP").alias("check_id"), "severity", "unit_id", F.col("subject").cast("string").alias("subject"), "message")


def unassigned_in_own_arm(keyed: DataFrame, facts: DataFrame, groups: DataFrame) -> DataFrame:
    """Items left out as unassigned shared content though no twin is in another arm's place."""
    own = keyed.where("resolved AND reason = 'shared_content_unassigned'").select("unit_id", "key").distinct().join(
        facts.select("unit_id", "ion_mode", "chromatography"), "unit_id")
    judged = other_arm(own, groups, placed_files(keyed)).groupBy("unit_id", "key").agg(F.bool_or(F.col("by_folder") | F.col("by_token")).alias("arm"))
    return judged.where("NOT arm").select(F.lit("T-EXCL").alias("check_id"), F.lit("error").alias("severity"), "unit_id", F.col("key").alias("subject"),
                                          F.lit("unassigned_in_own_arm").alias("message"))
