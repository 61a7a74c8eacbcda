"""A labelling spec as tables: what its rules refer to, and what they may not say.

Groups, exceptions, unit entries and their references are rows, so a reference is resolved by a join and a spec of any
number of rules and units is checked like any other table. Findings have ``check_id``, ``unit_id`` (null for the spec as a
whole), ``subject`` and ``message``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.operators import duplicates, matching

PLACEHOLDER = r"\{([A-Za-z_][A-Za-z0-9_.]*)\}"


def _found(rows: DataFrame, check: str, subject: Column, message: Column | str, unit: Column | None = None) -> DataFrame:
    return rows.select(F.lit(check).alias("check_id"), (F.col("unit_id") if unit is None else unit).cast("string").alias("unit_id"),
                       subject.cast("string").alias("subject"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def unit_set(entries: DataFrame, units: DataFrame) -> DataFrame:
    """X-UNITS: the spec's units against the inputs' units."""
    a = entries.select("unit_id").distinct().withColumn("_in_spec", F.lit(True))
    b = units.select("unit_id").distinct().withColumn("_is_unit", F.lit(True))
    odd = a.join(b, "unit_id", "full_outer").where("_in_spec IS NULL OR _is_unit IS NULL")
    return _found(odd, "X-UNITS", F.col("unit_id"), F.when(F.col("_in_spec").isNull(), "not_in_spec").otherwise("no_unit"))


def references(rules: DataFrame, group_refs: DataFrame, unit_refs: DataFrame, units: DataFrame, member_exceptions: DataFrame, members: DataFrame,
               referenced: DataFrame, used: DataFrame) -> DataFrame:
    """X-UNKNOWN-REF: groups, units and members that rules name and nobody has, members that a row resolves to, and
    exceptions that nothing matched.

    ``rules(rule_id, kind)`` (group or exception), ``group_refs(unit_id, place, rule_id)``, ``unit_refs(unit_id, place,
    named)``, ``member_exceptions(rule_id, member_path)``, ``members(member_key)``, ``referenced(key)``, ``used(rule_id)``."""
    known = rules.select("rule_id").distinct()
    no_group = group_refs.distinct().join(known, "rule_id", "left_anti")
    there = units.select(F.col("unit_id").alias("named")).distinct()
    no_unit = unit_refs.distinct().join(there, "named", "left_anti")
    asked = member_exceptions.select("rule_id", matching.names.member_key("member_path").alias("key"))
    listed = members.select(F.col("member_key").alias("key")).distinct().withColumn("_listed", F.lit(True))
    rows = referenced.select("key").distinct().withColumn("_row", F.lit(True))
    judged = asked.join(listed, "key", "left").join(rows, "key", "left")
    said = F.when(F.col("_listed").isNull(), "no_member").when(F.col("_row").isNotNull(), "a_row_resolves_to_it")
    idle = rules.where("kind = 'exception'").join(used.select("rule_id").distinct(), "rule_id", "left_anti")
    nobody = F.lit(None).cast("string")
    return (_found(no_group, "X-UNKNOWN-REF", F.concat("place", F.lit(":"), "rule_id"), "no_group")
            .unionByName(_found(no_unit, "X-UNKNOWN-REF", F.concat("place", F.lit(":"), "named"), "no_unit"))
            .unionByName(_found(judged.where(said.isNotNull()), "X-UNKNOWN-REF", F.col("rule_id"), said, nobody))
            .unionByName(_found(idle, "X-UNKNOWN-REF", F.col("rule_id"), "matches_nothing", nobody)))


def row_exceptions(exceptions: DataFrame, rows: DataFrame) -> DataFrame:
    """X-EXCEPTION: exceptions that are not one item. Returns what is wrong; the rows each covers are ``covered``.

    ``exceptions(rule_id, units array, row_index, sample_id, raw_file)``: the tests that are given must all hold."""
    by_index = exceptions.where(F.col("row_index").isNotNull() & (F.coalesce(F.size("units"), F.lit(0)) != 1))
    per = covered(exceptions, rows).groupBy("rule_id", "unit_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _found(by_index, "X-EXCEPTION", F.col("rule_id"), "index_without_one_unit", F.lit(None).cast("string")).unionByName(
        _found(per, "X-EXCEPTION", F.col("rule_id"), F.concat(F.lit("covers_"), F.col("n").cast("string"))))


def covered(exceptions: DataFrame, rows: DataFrame) -> DataFrame:
    """``(rule_id, unit_id, row_index)`` of the rows that exceptions name. Each exception is looked up by the narrowest
    test it has (index and unit, sample, file), so no exception meets every row."""
    e = exceptions.select("rule_id", "units", F.col("row_index").alias("_i"), F.col("sample_id").alias("_s"), F.col("raw_file").alias("_f"))
    here = (F.col("units").isNull() | (F.size("units") == 0) | F.array_contains("units", F.col("unit_id"))) & (F.col("_i").isNull() | (F.col("_i") == F.col("row_index")))
    here = here & (F.col("_s").isNull() | (F.col("_s") == F.col("sample_id"))) & (F.col("_f").isNull() | (F.col("_f") == F.col("raw_file")))
    by_sample = rows.join(e.where("_s IS NOT NULL"), F.col("sample_id") == F.col("_s"))
    by_file = rows.join(e.where("_s IS NULL AND _f IS NOT NULL"), F.col("raw_file") == F.col("_f"))
    placed = e.where("_s IS NULL AND _f IS NULL AND _i IS NOT NULL").select("*", F.explode("units").alias("_u"))
    by_place = rows.join(placed, (F.col("unit_id") == F.col("_u")) & (F.col("row_index") == F.col("_i"))).drop("_u")
    out = [f.where(here).select("rule_id", "unit_id", "row_index") for f in (by_sample, by_file, by_place)]
    return out[0].unionByName(out[1]).unionByName(out[2])


def entry_rules(entries: DataFrame, excludes: DataFrame, rules: DataFrame) -> DataFrame:
    """X-SCHEMA: what a unit entry may not say. ``entries(unit_id, status, exclusion)``, ``excludes(unit_id, reason,
    rule_id)``, ``rules(rule_id, applies_to)``."""
    odd = entries.where((F.col("status") == "excluded") != F.col("exclusion").isNotNull())
    other = excludes.where("reason = 'belongs_to_other_unit'").select("unit_id", "reason").distinct()
    inside = excludes.where("reason = 'not_in_archive'").join(rules.where("applies_to = 'members'").select("rule_id").distinct(), "rule_id", "left_semi").select("unit_id").distinct()
    return (_found(odd, "X-SCHEMA", F.col("status"), "exclusion_exactly_when_excluded")
            .unionByName(_found(other, "X-SCHEMA", F.col("reason"), "exclude_gives_its_own_reason"))
            .unionByName(_found(inside, "X-SCHEMA", F.lit("not_in_archive"), "a_member_is_in_the_archive")))


def placeholders(items: DataFrame, template: str = "template", values: str = "values") -> DataFrame:
    """X-PLACEHOLDER: names in an item's evidence template that the item has no value for; each name of a rule is told once
    with the number of items. ``items(unit_id, rule_id, template, values map)``."""
    asked = F.array_distinct(F.regexp_extract_all(template, F.lit(PLACEHOLDER), F.lit(1)))
    empty = F.filter(asked, lambda n: F.coalesce(F.col(values)[n], F.lit("")) == "")
    per = items.select("unit_id", "rule_id", F.explode(empty).alias("name")).groupBy("unit_id", "rule_id", "name").agg(F.count(F.lit(1)).alias("n"))
    return _found(per, "X-PLACEHOLDER", F.concat("rule_id", F.lit(":"), "name"), F.concat(F.lit("no_value_in_"), F.col("n").cast("string")))


def child_keys(items: DataFrame, children: DataFrame) -> DataFrame:
    """X-CHILD: kept items of a unit with children that are in no child, and child keys that the unit lacks.

    ``items(unit_id, item_id, child_key)`` of kept items, ``children(unit_id, child_key)``."""
    have = children.select("unit_id", "child_key").distinct()
    split = have.select("unit_id").distinct()
    none = items.where("child_key IS NULL").join(split, "unit_id", "left_semi")
    strange = items.where("child_key IS NOT NULL").join(have, ["unit_id", "child_key"], "left_anti").select("unit_id", "child_key").distinct()
    return _found(none, "X-CHILD", F.col("item_id"), "in_no_child").unionByName(_found(strange, "X-CHILD", F.col("child_key"), "no_such_child"))


def dup_nokept(flags: DataFrame, questions: DataFrame, keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """X-DUP-NOKEPT: shared-content flags about content that no unit keeps or holds, judged as T-DUP judges them."""
    twins = duplicates.twin_items(keyed.select("unit_id", "kind", "key", "resolved", "reason"), groups)
    kept = twins.where("reason IS NULL").select("unit_id", "key").distinct()
    held = twins.where(F.col("reason").isin("needs_person", "shared_content_unassigned")).select("unit_id", "key", "reason").distinct()
    subjects, keys = duplicates.shared_subjects(flags, questions, keyed, twins)
    empty = duplicates.unkept_flags(subjects, keys, groups, kept, held)
    return _found(empty, "X-DUP-NOKEPT", F.col("flag_no"), F.when(F.col("has_twins"), "nobody_keeps_a_copy").otherwise("no_copy_at_all"))


def with_sample_lists(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """Rows with the names of the sample lists they are on (``sample_lists``), for ``row_matches``. ``lists(name,
    sample_id)`` are tables of any length; a spec names a bounded number of lists."""
    per = lists.groupBy(F.col("sample_id").alias("_s")).agg(F.array_sort(F.collect_set("name")).alias("sample_lists"))
    return rows.join(per, F.col("sample_id") == F.col("_s"), "left").drop("_s").withColumn("sample_lists", F.coalesce("sample_lists", F.array().cast("array<string>")))
