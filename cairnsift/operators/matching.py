"""Resolving names to archive members, and joins between items, rows and units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift import vocab
from cairnsift.functions import names, tokens
from cairnsift.scale import PRINT, set_print


def index_members(paths: DataFrame, path: str = "path", scope: Sequence[str] = ()) -> DataFrame:
    """Raw-like members, one row per key (and scope): the shown path, the file name and the stem they answer to."""
    raw = paths.where(names.is_raw_like(path)).select(*scope, names.vendor_root(path).alias("shown"))
    # Keys that cannot be null keep the planner from adding not-null filters under each join, so that the joins
    # by name and by stem read one shared exchange.
    some = lambda c: F.coalesce(c, F.lit(""))
    return raw.groupBy(*scope, some(F.lower("shown")).alias("member_key")).agg(F.min("shown").alias("member_path")).select(
        *scope, "member_key", "member_path", some(names.basename("member_key")).alias("name"),
        some(F.lower(names.stem("member_key"))).alias("stem"), some_flag(names.needs_conversion("member_key")).alias("converts"))


def some_flag(value: Column) -> Column:
    return F.coalesce(value, F.lit(False))


def index_names(members: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Per file name: how many members carry it, and which when it is one."""
    return members.groupBy(*scope, "name").agg(F.count(F.lit(1)).alias("name_n"), F.min("member_key").alias("name_key"))


def index_stems(members: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Per stem: how many members carry it, and how many of them need no conversion."""
    direct = F.when(~F.col("converts"), F.col("member_key"))
    return members.groupBy(*scope, "stem").agg(F.count(F.lit(1)).alias("stem_n"), F.min("member_key").alias("stem_key"),
                                       F.count(direct).alias("direct_n"), F.min(direct).alias("direct_key"))


def within(scope: Sequence[str], tag: str) -> tuple[list[Column], Column]:
    """A scope's columns under other names, and the condition that both sides share it."""
    match = F.lit(True)
    for c in scope:
        match = match & (F.col(c) == F.col(f"{tag}{c}"))
    return [F.col(c).alias(f"{tag}{c}") for c in scope], match


def resolve(rows: DataFrame, members: DataFrame, name: str = "raw_file", scope: Sequence[str] = ()) -> DataFrame:
    """Each row's member by exact name, then by stem, then by its stem among forms read as they are.

    Adds ``kind`` (exact, stem, ambiguous, none), ``member_key`` and the number of candidates. Both
    indexes hold one row per name, so a name shared by many rows never multiplies; what an ambiguous
    name could mean is ``candidates``. With ``scope``, rows see the members of their own scope only.
    """
    base, folded = F.lower(names.basename(name)), F.lower(names.stem(name))
    (own_n, same_n), (own_s, same_s) = within(scope, "_n_"), within(scope, "_s_")
    by_name = index_names(members, scope).select(*own_n, F.col("name").alias("_name"), "name_n", "name_key")
    by_stem = index_stems(members, scope).select(*own_s, F.col("stem").alias("_stem"), "stem_n", "stem_key", "direct_n", "direct_key")
    keyed = rows.withColumn("_n", base).withColumn("_s", folded)
    hit = keyed.join(by_name, same_n & (F.col("_n") == F.col("_name")), "left").join(by_stem, same_s & (F.col("_s") == F.col("_stem")), "left")
    exact = F.coalesce(F.col("name_n"), F.lit(0)) == 1
    stem_one = F.coalesce(F.col("stem_n"), F.lit(0)) == 1
    direct_one = (F.coalesce(F.col("stem_n"), F.lit(0)) > 1) & (F.col("direct_n") == 1)
    empty = F.coalesce(F.col(name), F.lit("")) == ""
    kind = (F.when(empty, "none").when(exact, "exact").when(stem_one | direct_one, "stem")
            .when(F.col("name_n").isNotNull() | F.col("stem_n").isNotNull(), "ambiguous").otherwise("none"))
    key = F.when(exact, F.col("name_key")).when(stem_one, F.col("stem_key")).when(direct_one, F.col("direct_key"))
    n = F.when(kind.isin("exact", "stem"), F.lit(1)).when(kind == "none", F.lit(0)).otherwise(F.coalesce("name_n", "stem_n"))
    return hit.withColumn("kind", kind).withColumn("member_key", F.when(~empty, key)).withColumn(
        "candidates", n.cast("bigint")).select(*rows.columns, "kind", "member_key", "candidates")


def candidates(resolved: DataFrame, members: DataFrame, name: str = "raw_file") -> DataFrame:
    """What ambiguous names could mean: one row per distinct name and member, never per row."""
    asked = resolved.where("kind = 'ambiguous'").select(
        F.lower(names.basename(name)).alias("asked"), F.lower(names.stem(name)).alias("asked_stem")).distinct()
    known = members.select(F.col("name").alias("_name")).distinct()
    asked = asked.join(known, F.col("asked") == F.col("_name"), "left")
    by_name = asked.where("_name IS NOT NULL").join(members, F.col("asked") == F.col("name")).select("asked", "member_key")
    by_stem = asked.where("_name IS NULL").join(members, F.col("asked_stem") == F.col("stem")).select("asked", "member_key")
    return by_name.unionByName(by_stem)


def resolve_within(rows: DataFrame, members: DataFrame, prefixes: list[str], name: str = "raw_file") -> DataFrame:
    """``resolve`` among the members under the given folders."""
    inside = F.lit(False)
    for p in prefixes:
        inside = inside | F.lower("member_path").startswith(p.replace("\\", "/").strip("/").lower() + "/")
    return resolve(rows, members.where(inside) if prefixes else members, name)


def item_keys(items: DataFrame, members: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Adds ``key`` and ``resolved``: the member path's key, the name's own key where the listing has it or it has a
    folder, the row's resolved member, or ``raw:<stem>``."""
    own_l, same_l = within(scope, "_l_")
    has = F.coalesce(F.col("member_path"), F.lit("")) != ""
    # An item with a member path is its own answer: only the others are joined with the listing.
    firm = items.where(has).select(*items.columns, names.member_key("member_path").alias("key"), F.lit(True).alias("resolved"))
    # A name with a folder is its own key, listed or not: only members outside of any folder are looked up.
    listed = members.where(~F.col("member_key").contains("/")).select(*own_l, F.col("member_key").alias("_listed")).distinct()
    asked = items.where(~has).withColumnRenamed("kind", "_item_kind").withColumn("_own", names.member_key("raw_file"))
    found = resolve(asked.join(listed, same_l & (F.col("_own") == F.col("_listed")), "left"), members, scope=scope)
    known = F.col("_listed").isNotNull() | F.coalesce(names.norm_path("raw_file").contains("/"), F.lit(False))
    return firm.unionByName(found.select(
        *[F.col("_item_kind").alias("kind") if c == "kind" else F.col(c) for c in items.columns],
        F.when(known, names.member_key("raw_file")).when(F.col("member_key").isNotNull(), F.col("member_key"))
        .otherwise(F.concat(F.lit("raw:"), F.lower(names.stem("raw_file")))).alias("key"),
        (known | F.col("member_key").isNotNull()).alias("resolved")))


def key_stem(key: Column | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.when(k.startswith("raw:"), F.substr(k, F.lit(5))).otherwise(F.lower(names.stem(k)))


def same_file(left: DataFrame, right: DataFrame, on: list[str], left_id: str) -> DataFrame:
    """Which left items name a file the right side holds: key equality, or stem equality when either is unresolved.

    The OR becomes tokens: each side lists the keys and stems it answers to, so one equi semi-join decides and no
    pair list is kept. One row per matching left item."""
    ls, rs = F.concat(F.lit("loose:"), key_stem("key")), F.concat(F.lit("stem:"), key_stem("key"))
    key = F.concat(F.lit("key:"), F.col("key"))
    asks = F.array_compact(F.array(key, ls, F.when(~F.col("resolved"), rs)))
    gives = F.array_compact(F.array(key, rs, F.when(~F.col("resolved"), ls)))
    held = right.select(*on, F.explode(gives).alias("_token")).distinct()
    asked = left.select(*on, F.col(left_id), F.explode(asks).alias("_token"))
    return asked.join(held, [*on, "_token"], "left_semi").select(left_id).distinct()


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Key-wise comparison of two tables: missing_right, missing_left, duplicate, changed or equal.

    Each side is first folded to one row per key (count and the value when it is one), so repeated keys
    never multiply."""
    def fold(frame: DataFrame, tag: str) -> DataFrame:
        seen = F.struct(*[F.col(v) for v in values])
        return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{tag}_n"), F.min(seen).alias(f"{tag}_v"))

    both = fold(left, "left").join(fold(right, "right"), keys, "full_outer")
    verdict = (F.when(F.col("right_n").isNull(), "missing_right").when(F.col("left_n").isNull(), "missing_left")
               .when((F.col("left_n") > 1) | (F.col("right_n") > 1), "duplicate")
               .when(~F.col("left_v").eqNullSafe(F.col("right_v")), "changed").otherwise("equal"))
    return both.select(*keys, verdict.alias("result"), F.coalesce("left_n", F.lit(0)).alias("left_n"), F.coalesce("right_n", F.lit(0)).alias("right_n"),
                       *[F.col("left_v")[v].alias(f"left_{v}") for v in values], *[F.col("right_v")[v].alias(f"right_{v}") for v in values])


def belongs_to_other(excluded: DataFrame, kept: DataFrame, units: DataFrame) -> DataFrame:
    """Exclusions that point at another unit: unnamed, self, unknown_unit, not_kept or ok.

    ``excluded(id, unit_id, key, resolved, belongs_to_unit)``, ``kept(unit_id, key, resolved)``."""
    asked = excluded.withColumn("target", F.col("belongs_to_unit"))
    known = asked.join(units.select(F.col("unit_id").alias("_u"), F.lit(True).alias("_known")).distinct(), F.col("target") == F.col("_u"), "left")
    left = asked.select("id", F.col("target").alias("unit_id"), "key", "resolved").where("unit_id IS NOT NULL")
    held = same_file(left, kept, ["unit_id"], "id").select(F.col("id").alias("_id"), F.lit(True).alias("_held"))
    out = known.join(held, F.col("id") == F.col("_id"), "left")
    result = (F.when(F.coalesce(F.col("target"), F.lit("")) == "", "unnamed").when(F.col("target") == F.col("unit_id"), "self")
              .when(F.col("_known").isNull(), "unknown_unit").when(F.col("_held").isNull(), "not_kept").otherwise("ok"))
    return out.select("id", "unit_id", "target", result.alias("result"))


def shared_reciprocity(shares: DataFrame) -> DataFrame:
    """Paths one unit declares to share with another that does not declare them back."""
    s = shares.select("unit_id", "other_unit_id", names.member_key("member_path").alias("key")).distinct()
    back = s.select(F.col("other_unit_id").alias("unit_id"), F.col("unit_id").alias("other_unit_id"), "key")
    return s.join(back, ["unit_id", "other_unit_id", "key"], "left_anti")


def loose_members(listing: DataFrame, items: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Raw-like members nobody kept or excluded, by key, by file name or by stem.

    ``items(member_path, raw_file)``: every kept and excluded item of the set (and scope). Each test takes out what it
    knows, so the next one moves only the members still open."""
    members = listing.where(names.is_raw_like("path")).select(
        *scope, names.member_key("path").alias("member_key"), F.lower(names.basename("path")).alias("name"),
        F.lower(names.stem("path")).alias("stem"))
    has = F.coalesce(F.col("member_path"), F.lit("")) != ""
    own, same = within(scope, "_a_")
    keys = items.where(has).select(*own, names.member_key("member_path").alias("_taken")).where("_taken IS NOT NULL").distinct()
    named = items.where(~has).select(*own, names.name_key("raw_file").alias("_taken")).where("_taken IS NOT NULL").distinct()
    # A part of a vendor folder that nobody names leaves the folder open.
    open_ = members.join(keys, same & (F.col("member_key") == F.col("_taken")), "left_anti")
    for kind in ("name", "stem"):
        open_ = open_.join(named, same & (F.concat(F.lit(f"{kind}:"), F.col(kind)) == F.col("_taken")), "left_anti")
    return open_.select(*scope, "member_key").distinct()


def child_members(kept: DataFrame, children: DataFrame) -> DataFrame:
    """Problems of children as a partition: in_two_children, child_member_not_kept, kept_in_no_child.

    ``kept(unit_id, key)`` of units with children, ``children(unit_id, child_key, key)``."""
    # Two children are told by the least and the largest of them, which are combined before the shuffle.
    per = children.groupBy("unit_id", "key").agg(F.min("child_key").alias("lo"), F.max("child_key").alias("hi")).withColumn("_in", F.lit(True))
    mine = kept.select("unit_id", "key").distinct()
    with_children = children.select("unit_id").distinct()
    both = per.join(mine.withColumn("_kept", F.lit(True)), ["unit_id", "key"], "full_outer").join(with_children, "unit_id", "left_semi")
    problem = F.array_compact(F.array(
        F.when(F.col("lo") != F.col("hi"), F.lit("in_two_children")), F.when(F.col("_kept").isNull(), F.lit("child_member_not_kept")),
        F.when(F.col("_in").isNull(), F.lit("kept_in_no_child"))))
    return both.select("unit_id", "key", F.explode(problem).alias("problem"))


def polarity_partner(members: DataFrame, polarity: DataFrame) -> DataFrame:
    """The one other unit of the same scope with the identical member set and the opposite polarity.

    ``members(scope, unit_id, key)``, ``polarity(unit_id, ion)``. Sets are compared by fingerprint, so a
    group of equal sets is a group by, not a self join."""
    sets = members.select("scope", "unit_id", "key").distinct().groupBy("scope", "unit_id").agg(
        F.count(F.lit(1)).alias("n"), *set_print("key")).join(polarity, "unit_id")
    group = sets.groupBy("scope", "n", *PRINT).agg(
        F.count_if(F.col("ion") == "positive").alias("pos"), F.count_if(F.col("ion") == "negative").alias("neg"),
        F.count(F.lit(1)).alias("units"),
        F.min(F.when(F.col("ion") == "positive", F.col("unit_id"))).alias("pos_unit"),
        F.min(F.when(F.col("ion") == "negative", F.col("unit_id"))).alias("neg_unit"))
    out = sets.join(group, ["scope", "n", *PRINT])
    own = F.col("ion").isin("positive", "negative")
    opposite = F.when(F.col("ion") == "positive", F.col("neg")).otherwise(F.col("pos"))
    partner = F.when(F.col("ion") == "positive", F.col("neg_unit")).otherwise(F.col("pos_unit"))
    why = (F.when(~own, "no_polarity").when(F.col("units") == 1, "none").when(F.col("units") - 1 != opposite, "other_polarity")
           .when(opposite > 1, "several").otherwise("partner"))
    return out.select("scope", "unit_id", "ion", why.alias("why"), F.when(why == "partner", partner).alias("partner_unit_id"))


def document_diff(original: DataFrame, copy: DataFrame, key: str, ignored: list[str], readiness: list[str], gate: str) -> DataFrame:
    """Top-level keys in which two JSON documents differ; readiness keys count only when the gate key differs."""
    shape = "map<string,string>"

    def flat(frame: DataFrame, side: str) -> DataFrame:
        return frame.select(key, F.explode(F.from_json("doc", shape)).alias("field", side)).where(~F.col("field").isin(*ignored))

    both = flat(original, "a").join(flat(copy, "b"), [key, "field"], "full_outer")
    differs = both.where(~F.col("a").eqNullSafe(F.col("b"))).select(key, "field")
    gates = differs.where(F.col("field") == gate).select(key)
    counted = differs.where(~F.col("field").isin(*readiness))
    conditional = differs.where(F.col("field").isin(*readiness)).join(gates, key, "left_semi")
    return counted.unionByName(conditional)


def class_on_rows(assignments: DataFrame, kept: DataFrame) -> DataFrame:
    """Labels before and after cutting to the kept rows; a contrast is intact when two sides remain.

    ``assignments(unit_id, sample_id, label)``, ``kept(unit_id, sample_id)``."""
    k = kept.select("unit_id", "sample_id").groupBy("unit_id", "sample_id").agg(F.count(F.lit(1)).alias("rows"))
    both = assignments.join(k, ["unit_id", "sample_id"], "left")
    per = both.groupBy("unit_id", "label").agg(F.count(F.lit(1)).alias("before"), F.sum(F.coalesce("rows", F.lit(0))).alias("after"))
    side = ~tokens.non_sample_class("label")
    gone = F.when(side & (F.col("after") == 0), F.col("label"))
    out = per.groupBy("unit_id").agg(
        F.sum("before").alias("assigned"), F.sum("after").alias("kept_assigned"),
        F.count_if(side).alias("sides_before"), F.count_if(side & (F.col("after") > 0)).alias("sides_after"),
        F.count(gone).alias("lost"), F.min(gone).alias("first_lost"))
    return out.withColumn("contrast_intact", (F.col("sides_before") < 2) | (F.col("sides_after") >= 2))


def runnable_form(items: DataFrame, members: DataFrame) -> DataFrame:
    """For an exclusion as needing conversion: the form that needs none, or null.

    The member path, else the resolved member, else all members of the name or stem, else the name's extension."""
    found = resolve(items, members)
    by_name = members.groupBy("name").agg(F.bool_and(~F.col("converts")).alias("name_ok"), F.min("member_path").alias("name_path"))
    by_stem = members.groupBy("stem").agg(F.bool_and(~F.col("converts")).alias("stem_ok"), F.min("member_path").alias("stem_path"))
    hit = (found.withColumn("_n", F.lower(names.basename("raw_file"))).withColumn("_s", F.lower(names.stem("raw_file")))
           .join(by_name.withColumnRenamed("name", "_nn"), F.col("_n") == F.col("_nn"), "left")
           .join(by_stem.withColumnRenamed("stem", "_ss"), F.col("_s") == F.col("_ss"), "left"))
    has = F.coalesce(F.col("member_path"), F.lit("")) != ""
    pick = (F.when(has, F.when(names.is_runnable("member_path"), F.col("member_path")))
            .when(F.col("member_key").isNotNull(), F.when(~names.needs_conversion("member_key"), F.col("member_key")))
            .when(F.col("name_ok").isNotNull(), F.when(F.col("name_ok"), F.col("name_path")))
            .when(F.col("stem_ok").isNotNull(), F.when(F.col("stem_ok"), F.col("stem_path")))
            .when(names.is_runnable("raw_file"), F.col("raw_file")))
    return hit.select(*items.columns, pick.alias("runnable"))


def dropped_for_good(excluded: DataFrame, kept: DataFrame) -> DataFrame:
    """Raw-like members excluded for good that no unit keeps, one row per key with its first path and reason."""
    gone = excluded.where(F.col("reason").isin(*vocab.DROPPED_FOR_GOOD_REASONS) & names.is_raw_like("member_path")).select(
        names.member_key("member_path").alias("key"), "member_path", "reason")
    left = gone.join(kept.select("key").distinct(), "key", "left_anti")
    return left.groupBy("key").agg(F.min(F.struct("member_path", "reason")).alias("x")).select("key", "x.*")


def not_its_arm(path: Column | str, ion: Column | str, chromatography: Column | str) -> Column:
    """Whether a name's polarity or chromatography token puts a file in another arm than the unit's."""
    i, c = (F.col(x) if isinstance(x, str) else x for x in (ion, chromatography))
    p, k = tokens.token_polarity(path), tokens.token_chromatography(path)
    return F.coalesce(p.isNotNull() & i.isin("positive", "negative") & (p != i), F.lit(False)) | F.coalesce(
        k.isNotNull() & c.isin("HILIC", "RP") & (k != c), F.lit(False))


def may_be_own(dropped: DataFrame, absent: DataFrame) -> DataFrame:
    """Per unit, how many members dropped for good may be files it says the archive lacks (equal loose stems), and
    the first of them. ``absent(unit_id, raw_file)``. Members are counted per stem before the join."""
    per = dropped.groupBy(names.loose_stem("member_path").alias("loose")).agg(
        F.count(F.lit(1)).alias("n"), F.min("member_path").alias("first_path"))
    wanted = absent.select("unit_id", names.loose_stem("raw_file").alias("loose")).distinct()
    return wanted.join(per, "loose").groupBy("unit_id").agg(F.sum("n").alias("n"), F.min("first_path").alias("first_path"))


def member_lookup(selection: DataFrame, files: DataFrame) -> DataFrame:
    """The file of a selected member: its exact path, else the one path that ends with it.

    A file answers to each of its path's tails, so the suffix test is an equi-join on one tail and a count. All tails of a
    path have its last part, so files without a wanted one are left out before their tails are taken; the whole path is
    the longest tail."""
    last = lambda path: F.xxhash64(F.substring_index(path, "/", -1))
    names_ = selection.select(last("member_path").alias("last")).distinct()
    f = files.select("path", "size", "crc32", last("path").alias("last")).join(names_, "last", "left_semi").drop("last")
    parts = F.split("path", "/")
    tails = f.select("path", "size", "crc32", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))).alias("tail"))
    wanted = selection.select(F.col("member_path").alias("tail")).distinct()
    by_tail = tails.join(wanted, "tail", "left_semi").groupBy("tail").agg(
        F.when(F.min("path") == F.max("path"), 1).otherwise(2).alias("n"), F.min(F.struct("path", "size", "crc32")).alias("t"),
        F.min(F.when(F.col("path") == F.col("tail"), F.struct("size", "crc32"))).alias("e"))
    out = selection.join(by_tail, F.col("member_path") == F.col("tail"), "left")
    size = F.coalesce(F.col("e.size"), F.when(F.col("n") == 1, F.col("t.size")))
    crc = F.coalesce(F.col("e.crc32"), F.when(F.col("n") == 1, F.col("t.crc32")))
    found = F.col("e").isNotNull() | F.coalesce(F.col("n") == 1, F.lit(False))
    result = (F.when(~found, "not_evaluable").when(F.col("size").isNotNull() & (F.col("size") != size), "size_differs")
              .when(F.col("crc32").isNotNull() & (F.col("crc32") != crc), "crc_differs").otherwise("equal"))
    return out.select(*selection.columns, result.alias("result"))
