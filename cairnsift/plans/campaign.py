"""Plan a campaign and report on one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnsift.operators import ledger, planning
from cairnsift.session import cut_lineage, stored


def plan(units: DataFrame, files: DataFrame, readings: DataFrame, pools: list[str]) -> tuple[DataFrame, DataFrame]:
    """(planned units in order, excluded units with their reasons).

    ``readings(unit_id, ion_mobility, fragmentation, workspace_reason)``; a unit without a reading is not excluded for it."""
    pooled = planning.union_pools(units, files, pools)
    read = pooled.join(readings, "unit_id", "left").withColumn("ion_mobility", F.coalesce("ion_mobility", F.lit(False))).withColumn(
        "fragmentation", F.coalesce("fragmentation", F.lit(False)))
    # The judged units and their object uses feed several branches; each is written once.
    judged = cut_lineage(planning.exclusion_reasons(read))
    remaining = judged.where("reason IS NULL")
    uses = cut_lineage(planning.objects(files).join(remaining.select("unit_id"), "unit_id", "left_semi"))
    sized = remaining.join(planning.unit_objects(uses), "unit_id", "left").withColumn("samples", F.col("analysis_files"))
    late = F.when(F.coalesce("object_count", F.lit(0)) == 0, "no_download_object").when(F.coalesce(planning.archive_too_small(sized), F.lit(False)), "archive_too_small_for_raw_data")
    decided = cut_lineage(sized.withColumn("late", late))
    excluded = judged.where("reason IS NOT NULL").select("unit_id", "pool", "reason").unionByName(
        decided.where("late IS NOT NULL").select("unit_id", "pool", F.col("late").alias("reason")))
    included = decided.where("late IS NULL")
    placed, groups = planning.download_groups(stored(uses.join(included.select("unit_id"), "unit_id", "left_semi")))
    return planning.plan_order(included.join(placed, "unit_id"), groups), excluded


def report(transitions: DataFrame, attempts: DataFrame) -> DataFrame:
    """The present state of each unit with its failures, its open outage and its next attempt."""
    now = ledger.current_state(transitions)
    retry = ledger.retry_schedule(attempts).groupBy("unit_key").agg(
        F.max("failures").alias("failures"), F.max_by("due_us", "attempt_id").alias("due_us"), F.bool_or("terminal").alias("terminal"))
    groups = attempts.select("unit_key", "repository", "group_id").distinct()
    out = ledger.outages(ledger.outage_streaks(attempts)).select("repository", "outage")
    return now.join(retry, "unit_key", "left").join(groups, "unit_key", "left").join(out, "repository", "left").select(
        "unit_key", "state", "transitions", F.coalesce("failures", F.lit(0)).alias("failures"), F.coalesce("terminal", F.lit(False)).alias("terminal"), "due_us",
        F.coalesce("outage", F.lit(False)).alias("outage"))
