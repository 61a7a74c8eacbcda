"""Agreement, accuracy, concordance and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.functions import names, text
from cairnsift.scale import ordered


def concordance(candidates: DataFrame, acquired: list[str], predicted: list[str]) -> DataFrame:
    """Agreement of predicted with acquired candidates over features, strict and any scope (one row).

    Works on (feature, identity block) aggregates, so no feature's candidates are collected."""
    block = text.identity_block("structure_key")
    pred = F.col("annotator_id").isin(*predicted)
    matched = F.col("is_reference_matched")
    scopes = {"strict": F.col("annotator_id") == acquired[0] if acquired else F.lit(False), "acquired": F.col("annotator_id").isin(*acquired)}
    order = F.struct(F.coalesce(F.col("candidate_rank").cast("double"), F.lit(float("inf"))), "position")
    per_block = candidates.groupBy("feature", block.alias("block")).agg(
        F.bool_or(pred).alias("pred"), F.bool_or(pred & F.col("is_representative")).alias("rep"), F.min(F.when(pred, order)).alias("best"),
        *[F.bool_or(inside & matched).alias(f"acc_{s}") for s, inside in scopes.items()])
    some = F.col("block") != ""
    aggregates = [F.bool_or("rep").alias("rep"), F.bool_or("pred").alias("pred")]
    for s in scopes:
        acc = F.col(f"acc_{s}")
        aggregates += [F.bool_or(acc).alias(f"matched_{s}"), F.bool_or(acc & some).alias(f"key_{s}"), F.bool_or(acc & some & F.col("pred")).alias(f"any_{s}"),
                       F.min_by(acc & some, F.when(F.col("pred"), F.col("best"))).alias(f"top_{s}")]
    aggregates.append(F.min_by("block", F.when(F.col("pred"), F.col("best"))).alias("top_block"))
    per = per_block.groupBy("feature").agg(*aggregates)
    out = [F.count(F.lit(1)).alias("features"), F.count_if("rep").alias("representatives")]
    for s in scopes:
        comparable = F.col(f"matched_{s}") & F.col("pred") & F.col(f"key_{s}") & (F.col("top_block") != "")
        n, top, any_ = F.count_if(comparable), F.count_if(comparable & F.col(f"top_{s}")), F.count_if(comparable & F.col(f"any_{s}"))
        out += [F.count_if(F.col(f"matched_{s}")).alias(f"{s}_matched"), F.count_if(F.col(f"matched_{s}") & F.col("pred")).alias(f"{s}_with_predicted"),
                n.alias(f"{s}_comparable"), top.alias(f"{s}_top"), any_.alias(f"{s}_any"), text.rate(top, n).alias(f"{s}_top_rate"), text.rate(any_, n).alias(f"{s}_any_rate")]
    return per.agg(*out)


def representative_candidate(candidates: DataFrame) -> DataFrame:
    """The best candidate per feature and annotator: lowest rank, then position."""
    return candidates.groupBy("feature", "annotator_id").agg(
        F.min_by("structure_key", F.struct("candidate_rank", "position")).alias("structure_key"), F.min(F.struct("candidate_rank", "position")).alias("m")).select(
        "feature", "annotator_id", "structure_key", F.col("m.candidate_rank").alias("candidate_rank"), F.col("m.position").alias("position"))


def score_keys(rows: DataFrame, overrides: DataFrame, truth: DataFrame) -> DataFrame:
    """The truth key of a kept row: its member path, an override of its raw file, else a truth member of its name or stem.

    ``rows(unit_id, member_path, raw_file)``, ``overrides(raw_file, path)``, ``truth(unit_id, path)``."""
    named = truth.select("unit_id", names.member_key("path").alias("t_key"), F.explode(F.array(
        F.lower(names.basename("path")), F.lower(names.stem("path")))).alias("t_name")).groupBy("unit_id", "t_name").agg(F.min("t_key").alias("t_key"))
    o = overrides.select("raw_file", names.member_key("path").alias("o_key"))
    r = rows.withColumn("_n", F.lower(names.basename("raw_file"))).withColumn("_s", F.lower(names.stem("raw_file"))).join(o, "raw_file", "left")
    a = named.select(F.col("unit_id").alias("_u1"), F.col("t_name").alias("_t1"), F.col("t_key").alias("k1"))
    b = named.select(F.col("unit_id").alias("_u2"), F.col("t_name").alias("_t2"), F.col("t_key").alias("k2"))
    hit = r.join(a, (F.col("unit_id") == F.col("_u1")) & (F.col("_n") == F.col("_t1")), "left").join(
        b, (F.col("unit_id") == F.col("_u2")) & (F.col("_s") == F.col("_t2")), "left")
    return hit.select("unit_id", F.coalesce(names.member_key("member_path"), "o_key", "k1", "k2", F.concat(F.lit("raw:"), "_n")).alias("key"))


def score(kept: DataFrame, truth: DataFrame, held: DataFrame, unchecked: DataFrame) -> DataFrame:
    """Per unit: correct, wrongly included, wrongly left out, held for a person. All ``(unit_id, key)``; ``unchecked(key)``."""
    k = kept.select("unit_id", "key").distinct().join(unchecked.select("key").distinct(), "key", "left_anti").withColumn("_k", F.lit(True))
    t = truth.select("unit_id", "key").distinct().withColumn("_t", F.lit(True))
    h = held.select("unit_id", "key").distinct().withColumn("_h", F.lit(True))
    all_ = k.join(t, ["unit_id", "key"], "full_outer").join(h, ["unit_id", "key"], "left")
    has = lambda c: F.col(c).isNotNull()
    return all_.groupBy("unit_id").agg(
        F.count_if(has("_k") & has("_t")).alias("correct"), F.count_if(has("_k") & ~has("_t")).alias("wrong_included"),
        F.count_if(has("_t") & ~has("_k") & ~has("_h")).alias("wrongly_left_out"), F.count_if(has("_t") & ~has("_k") & has("_h")).alias("held_for_person"))


def agreement(labels: DataFrame, group: str | None = None) -> DataFrame:
    """Raw agreement and Cohen's kappa per group (null when both sides use one label only), or pooled without a group.

    ``labels(group, a, b)``."""
    keys = [group] if group else []
    base = labels if group else labels.withColumn("_g", F.lit(0))
    keys = keys or ["_g"]
    confusion = base.groupBy(*keys, "a", "b").agg(F.count(F.lit(1)).alias("n"))
    total = confusion.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    sides = confusion.select(*keys, F.explode(F.array(F.struct(F.col("a").alias("label"), F.col("n").alias("na"), F.lit(0).cast("bigint").alias("nb")),
                                                      F.struct(F.col("b").alias("label"), F.lit(0).cast("bigint").alias("na"), F.col("n").alias("nb")))).alias("s")).select(*keys, "s.*")
    marginal = sides.groupBy(*keys, "label").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    chance = marginal.groupBy(*keys).agg(F.sum(F.col("na").cast("double") * F.col("nb")).alias("pp"), F.count(F.lit(1)).alias("labels"))
    out = total.join(chance, keys)
    n = F.col("n").cast("double")
    po, pe = F.col("same") / n, F.col("pp") / (n * n)
    kappa = F.when((F.col("labels") > 1) & (pe < 1), (po - pe) / (F.lit(1.0) - pe))
    return out.select(*([group] if group else []), "n", F.round(po, 4).alias("agreement"), F.round(kappa, 4).alias("kappa"))


def spread(groups: DataFrame, value: str) -> DataFrame:
    """Median and range of a rate rounded to four digits, over its histogram; groups without a value are counted apart."""
    hist = groups.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    v = F.col(value)
    return hist.agg(F.round(F.expr(f"percentile({value}, 0.5, n)"), 6).alias("median"), F.min(v).alias("lowest"), F.max(v).alias("highest"),
                    F.coalesce(F.sum(F.when(v.isNotNull(), F.col("n"))), F.lit(0)).alias("counted"), F.coalesce(F.sum(F.when(v.isNull(), F.col("n"))), F.lit(0)).alias("undefined"))


def set_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per unit the Jaccard index of two kept sets and whether they are identical, from one full outer join."""
    x = a.select("unit_id", "key").distinct().withColumn("_a", F.lit(1))
    y = b.select("unit_id", "key").distinct().withColumn("_b", F.lit(1))
    both = x.join(y, ["unit_id", "key"], "full_outer").groupBy("unit_id").agg(
        F.count(F.lit(1)).alias("u"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("i"))
    return both.select("unit_id", F.round(F.col("i") / F.col("u"), 4).alias("jaccard"), (F.col("i") == F.col("u")).alias("identical"))


def catch_rate(wrong: DataFrame, found: DataFrame) -> DataFrame:
    """Share of wrong assignments whose unit some finding raises as error or hold. ``wrong(unit_id, key)``."""
    raised = found.where("severity IN ('error', 'hold')").select("unit_id").distinct().withColumn("_r", F.lit(True))
    return wrong.join(raised, "unit_id", "left").agg(
        F.count(F.lit(1)).alias("wrong"), F.count("_r").alias("caught"), text.rate(F.count("_r"), F.count(F.lit(1))).alias("rate"))


def stratified_sample(frame: DataFrame, key: str, strata: list[str], fraction: float, minimum: int, per_stratum: int, seed: str) -> DataFrame:
    """A repeatable sample: rows in the order of a seeded digest, a share of each stratum and at least ``per_stratum``,
    and never fewer than ``minimum`` in all where they exist.

    The digest spreads rows evenly, so its leading digits are the buckets and a stratum of any size is ranked in parallel."""
    h = F.sha2(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")), 256)
    base = frame.withColumn("_h", h).withColumn("_s", F.concat_ws("|", *[F.col(s).cast("string") for s in strata]))
    bucket = F.conv(F.substring("_h", 1, 3), 16, 10).cast("bigint")
    ranked = ordered(base, ["_s"], ["_h"], bucket, row_number="_r")
    sizes = base.groupBy("_s").agg(F.count(F.lit(1)).alias("_n"))
    # The whole sample grows to the minimum by the same share of every stratum.
    total = base.agg(F.count(F.lit(1)).alias("_t"))
    share = F.greatest(F.lit(fraction), F.least(F.lit(1.0), F.lit(float(minimum)) / F.greatest(F.col("_t"), F.lit(1))))
    sized = sizes.crossJoin(F.broadcast(total)).select(
        F.col("_s").alias("_ss"), F.greatest(F.ceil(F.col("_n") * share), F.lit(per_stratum)).alias("_take"))
    return ranked.join(sized, F.col("_s") == F.col("_ss")).where("_r <= _take").select(*frame.columns, F.col("_r").alias("rank"))


def tool_tally(turns: DataFrame, rules: dict[str, Column], session: str = "session") -> DataFrame:
    """Event counts per session: one per rule, and turns by role."""
    return turns.groupBy(session).agg(
        F.count(F.lit(1)).alias("turns"), *[F.count_if(F.col("role") == r).alias(f"{r}_turns") for r in ("user", "assistant", "system")],
        *[F.count_if(rule).alias(name) for name, rule in rules.items()])


def tally_check(stated: DataFrame, counted: DataFrame, session: str, measures: list[str]) -> DataFrame:
    """Stated counts that differ from recounted ones."""
    s = stated.select(session, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias("stated")) for m in measures])).alias("x")).select(session, "x.*")
    c = counted.select(session, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias("counted")) for m in measures])).alias("x")).select(session, "x.*")
    return s.join(c, [session, "measure"], "full_outer").where(~F.col("stated").eqNullSafe(F.col("counted")))
