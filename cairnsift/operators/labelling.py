"""Rule-based labelling: declarative match groups compiled to Column predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift import vocab
from cairnsift.functions import names, tokens
from cairnsift.scale import PRINT, global_rank, set_print
from cairnsift.session import stored


def _list(value: Any) -> list:
    return list(value) if isinstance(value, (list, tuple)) else [value]


def _any(tests: Sequence[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def token_test(spec: Mapping[str, Any], path: Column) -> Column:
    out = F.lit(True)
    if "polarity" in spec:
        out = out & tokens.token_polarity(path).eqNullSafe(F.lit(spec["polarity"]))
    if "chromatography" in spec:
        out = out & tokens.token_chromatography(path).eqNullSafe(F.lit(spec["chromatography"]))
    if "acquisition" in spec:
        wanted = F.array(*[F.lit(a.lower()) for a in _list(spec["acquisition"])])
        out = out & F.arrays_overlap(F.transform(tokens.token_acquisition(path), F.lower), wanted)
    return out


def member_matches(spec: Mapping[str, Any], path: str = "path", twin: str = "twin") -> Column:
    """AND of glob, regex, folder, ext, token, path list and twin tests."""
    p = F.col(path)
    folded = F.lower(p)
    out = F.lit(True)
    if "glob" in spec:
        out = out & _any([folded.rlike(names.glob_to_regex(g.lower())) for g in _list(spec["glob"])])
    if "regex" in spec:
        out = out & _any([p.rlike(r) for r in _list(spec["regex"])])
    if "folder" in spec:
        out = out & _any([folded.startswith(f.replace("\\", "/").strip("/").lower() + "/") for f in _list(spec["folder"])])
    if "ext" in spec:
        out = out & names.ext_any(p).isin(*["." + e.lower().lstrip(".") for e in _list(spec["ext"])])
    if "token" in spec:
        out = out & token_test(spec["token"], p)
    if "paths" in spec:
        out = out & names.member_key(p).isin(*[x.replace("\\", "/").strip("/").lower() for x in _list(spec["paths"])])
    if "twin" in spec:
        out = out & (F.col(twin) == F.lit(bool(spec["twin"])))
    return F.coalesce(out, F.lit(False))


def text_test(spec: Any, value: Column) -> Column:
    if isinstance(spec, Mapping):
        return F.coalesce(value.rlike(spec["regex"]), F.lit(False))
    return F.coalesce(value.isin(*_list(spec)), F.lit(False))


def _indices(items: Sequence[Any]) -> Column:
    tests = []
    for item in items:
        if isinstance(item, int):
            tests.append(F.col("row_index") == item)
        else:
            low, high = (int(x) for x in str(item).split("-", 1))
            tests.append(F.col("row_index").between(low, high))
    return _any(tests)


def row_matches(spec: Mapping[str, Any], sample_lists: Mapping[str, Sequence[str]] | None = None) -> Column:
    """AND of unit, index ranges, sample id, file, attribute, sample list, resolution kind, resolved member and token tests."""
    out = F.lit(True)
    if "unit" in spec:
        out = out & F.col("unit_id").isin(*_list(spec["unit"]))
    if "rows" in spec:
        out = out & (F.col("unit_id") == spec["rows"]["unit"]) & _indices(spec["rows"]["indices"])
    for key in ("sample_id", "raw_file"):
        if key in spec:
            out = out & text_test(spec[key], F.col(key))
    for name, wanted in (spec.get("attribute") or {}).items():
        out = out & text_test(wanted, F.col("attributes")[name])
    if "sample_lists" in spec and sample_lists is None:
        # The rows carry the lists they are on (``spec.with_sample_lists``).
        out = out & F.arrays_overlap(F.col("sample_lists"), F.array(*[F.lit(a) for a in _list(spec["sample_lists"])]))
    elif "sample_lists" in spec:
        listed = [s for a in _list(spec["sample_lists"]) for s in (sample_lists or {}).get(a, ())]
        out = out & (F.col("sample_id").isin(*listed) if listed else F.lit(False))
    if "resolution" in spec:
        out = out & F.col("kind").isin(*_list(spec["resolution"]))
    if "resolved_member" in spec:
        out = out & F.col("member_key").isNotNull() & member_matches(spec["resolved_member"], "member_key")
    if "token" in spec:
        out = out & token_test(spec["token"], F.coalesce("member_key", "raw_file"))
    return F.coalesce(out, F.lit(False))


def apply_groups(items: DataFrame, rules: Sequence[tuple[str, Column]], exceptions: DataFrame | None = None, item: str = "item_id") -> DataFrame:
    """All matching groups per item in one pass (``matched``), and the group it takes; an exception overrides.

    ``exceptions(item_id, group_id)`` names single items."""
    matched = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules]))
    out = items.withColumn("matched", matched)
    if exceptions is None:
        return out.withColumn("group_id", F.get("matched", F.lit(0)))
    e = exceptions.groupBy(F.col(item).alias("_x")).agg(F.min("group_id").alias("_forced"))
    return out.join(e, F.col(item) == F.col("_x"), "left").withColumn("group_id", F.coalesce("_forced", F.get("matched", F.lit(0)))).withColumn(
        "matched", F.when(F.col("_forced").isNotNull(), F.array("_forced")).otherwise(F.col("matched"))).drop("_x", "_forced")


def coverage_findings(labelled: DataFrame, groups: Sequence[str], noun: str, item: str = "item_id") -> DataFrame:
    """Items no group covers, items several cover, and groups that hold nothing.

    The rules run once: of an item that one group covers, only its group is stored."""
    size = F.size("matched")
    told = [F.when(size != 1, F.col(c)).alias(c) for c in (item, "matched")]
    labelled = stored(labelled.select(*told, "group_id"))
    rows = labelled.where("matched IS NOT NULL").select(
        F.when(size == 0, f"X-UNCOVERED-{noun}").otherwise(f"X-OVERLAP-{noun}").alias("check_id"), F.col(item).cast("string").alias("subject"),
        F.array_join("matched", ",").alias("message"))
    used = labelled.where("group_id IS NOT NULL").select("group_id").distinct()
    declared = labelled.sparkSession.createDataFrame([(g,) for g in groups], "group_id string")
    empty = declared.join(used, "group_id", "left_anti").select(F.lit("X-EMPTY-GROUP").alias("check_id"), F.col("group_id").alias("subject"), F.lit("").alias("message"))
    return rows.unionByName(empty)


def resolution_findings(kept: DataFrame) -> DataFrame:
    """Kept rows whose file resolves to no listed member, or to several."""
    bad = kept.where("kind IN ('none', 'ambiguous')")
    return bad.select(F.when(F.col("kind") == "none", "X-UNRESOLVED").otherwise("X-AMBIGUOUS").alias("check_id"), "unit_id", "row_index", "candidates")


def disposition(labelled: DataFrame, keep: Mapping[str, Sequence[str]], exclude: Mapping[str, str], is_row: Column) -> DataFrame:
    """Keep an item for its group's units, or exclude it with a reason mapped to what rows or members may carry.

    ``keep`` and ``exclude`` are the spec's own small tables and become literals."""
    table = F.create_map(*[x for g, r in exclude.items() for x in (F.lit(g), F.lit(r))]) if exclude else F.create_map()
    units = F.create_map(*[x for g, u in keep.items() for x in (F.lit(g), F.array(*[F.lit(v) for v in u]))]) if keep else F.create_map()
    said = table[F.col("group_id")] if exclude else F.lit(None).cast("string")
    reason = F.when(is_row, F.when(said.isin(*vocab.ROW_REASONS), said).otherwise("other")).otherwise(
        F.when(said.isin(*vocab.MEMBER_REASONS), said).otherwise("other"))
    kept = units[F.col("group_id")] if keep else F.lit(None).cast("array<string>")
    return labelled.withColumn("kept_units", kept).withColumn("reason", F.when(said.isNotNull(), reason))


def heterogeneity(labelled: DataFrame, path: str = "path") -> DataFrame:
    """Kept groups whose items differ in name tokens, extension or top folder (an absent acquisition token differs too)."""
    p = F.col(path)
    acq = F.array_join(tokens.token_acquisition(p), "+")
    read = {"polarity": tokens.token_polarity(p), "chromatography": tokens.token_chromatography(p), "acquisition": acq, "ext": names.ext_any(p),
            "folder": F.substring_index(names.norm_path(p), "/", 1)}
    # Each path is read once; what is counted are the few sets of values.
    seen = labelled.where("group_id IS NOT NULL").select("group_id", *[v.alias(c) for c, v in read.items()]).distinct()
    per = seen.groupBy("group_id").agg(*[F.count_distinct(c).alias(c) for c in read])
    differs = F.array_compact(F.array(*[F.when(F.col(c) > 1, F.lit(c)) for c in read]))
    return per.select("group_id", F.array_join(differs, ",").alias("differs")).where("differs <> ''")


def expanded_payload(items: DataFrame) -> DataFrame:
    """Items in canonical order per unit and array: rows by index, members by path. The arrays stay long
    (unit, kind, position), and positions come from one range-partitioned sort, so a unit of any size is written in parallel."""
    ranked = global_rank(items, ["unit_id", "kind", "row_index", "path"], "_rank")
    first = ranked.groupBy("unit_id", "kind").agg(F.min("_rank").alias("_first"))
    return ranked.join(first, ["unit_id", "kind"]).withColumn("position", F.col("_rank") - F.col("_first") + 1).drop("_rank", "_first")


def revision_scope(before: DataFrame, after: DataFrame, named: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Units a revision changes without naming them: set prints of each unit's items compared."""
    def prints(frame: DataFrame, tag: str) -> DataFrame:
        p = frame.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n"), *set_print(*columns))
        return p.select("unit_id", F.struct("n", *PRINT).alias(tag))

    both = prints(before, "a").join(prints(after, "b"), "unit_id", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    return both.select("unit_id").join(named.select("unit_id").distinct(), "unit_id", "left_anti")
