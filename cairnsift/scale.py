"""Building blocks that stay whole and parallel when one key holds much of the data.

A Spark window sorts a whole key in one task. The ordered operators here first cut
each key into buckets that follow the order (hours, blocks of sequence numbers),
run the window inside ``(key, bucket)``, and carry what crosses a bucket border
through one summary row per bucket. The result equals the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cairnsift.session import cut_lineage


def ordered(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    *,
    lag: Mapping[str, Column | str] | None = None,
    lead: Mapping[str, Column | str] | None = None,
    prior_max: Mapping[str, Column | str] | None = None,
    prior_sum: Mapping[str, Column | str] | None = None,
    later_max: Mapping[str, Column | str] | None = None,
    row_number: str | None = None,
) -> DataFrame:
    """Window functions over ``keys`` in ``order`` without one task per key.

    ``bucket`` must never fall as ``order`` rises, and ``order`` must be unique within
    a key for a determined result. ``prior_*`` cover the rows before the current one,
    ``later_max`` the rows after it; each mapping is ``{output: input}``. Keys and order
    must not be null.
    """
    lag, lead = dict(lag or {}), dict(lead or {})
    prior_max, prior_sum, later_max = dict(prior_max or {}), dict(prior_sum or {}), dict(later_max or {})

    def col(value: Column | str) -> Column:
        return F.col(value) if isinstance(value, str) else value

    base = frame.withColumn("_b", bucket)
    keep = list(frame.columns)
    cell = Window.partitionBy(*keys, "_b").orderBy(*order)
    before = cell.rowsBetween(Window.unboundedPreceding, -1)
    after = cell.rowsBetween(1, Window.unboundedFollowing)
    spine = F.struct(*[F.col(o) for o in order])

    local, summary, carry = [], [], []
    across = Window.partitionBy(*keys).orderBy("_b")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    further = across.rowsBetween(1, Window.unboundedFollowing)
    final: dict[str, Column] = {}

    if lag:
        seen = F.struct(*[col(v).alias(k) for k, v in lag.items()])
        local.append(F.lag(seen).over(cell).alias("_lag"))
        summary.append(F.max_by(seen, spine).alias("_last"))
        carry.append(F.lag("_last").over(across).alias("_lag_in"))
        for k in lag:
            final[k] = F.when(F.col("_lag").isNotNull(), F.col("_lag")[k]).otherwise(F.col("_lag_in")[k])
    if lead:
        seen = F.struct(*[col(v).alias(k) for k, v in lead.items()])
        local.append(F.lead(seen).over(cell).alias("_lead"))
        summary.append(F.min_by(seen, spine).alias("_first"))
        carry.append(F.lead("_first").over(across).alias("_lead_in"))
        for k in lead:
            final[k] = F.when(F.col("_lead").isNotNull(), F.col("_lead")[k]).otherwise(F.col("_lead_in")[k])
    for i, (k, v) in enumerate(prior_max.items()):
        local.append(F.max(col(v)).over(before).alias(f"_pm{i}"))
        summary.append(F.max(col(v)).alias(f"_pms{i}"))
        carry.append(F.max(f"_pms{i}").over(earlier).alias(f"_pmi{i}"))
        final[k] = F.greatest(F.col(f"_pm{i}"), F.col(f"_pmi{i}"))
    for i, (k, v) in enumerate(later_max.items()):
        local.append(F.max(col(v)).over(after).alias(f"_lm{i}"))
        summary.append(F.max(col(v)).alias(f"_lms{i}"))
        carry.append(F.max(f"_lms{i}").over(further).alias(f"_lmi{i}"))
        final[k] = F.greatest(F.col(f"_lm{i}"), F.col(f"_lmi{i}"))
    for i, (k, v) in enumerate(prior_sum.items()):
        local.append(F.sum(col(v)).over(before).alias(f"_ps{i}"))
        summary.append(F.sum(col(v)).alias(f"_pss{i}"))
        carry.append(F.sum(f"_pss{i}").over(earlier).alias(f"_psi{i}"))
        final[k] = F.coalesce(F.col(f"_ps{i}"), F.lit(0)) + F.coalesce(F.col(f"_psi{i}"), F.lit(0))
    if row_number:
        local.append(F.row_number().over(cell).alias("_rn"))
        summary.append(F.count(F.lit(1)).alias("_n"))
        carry.append(F.sum("_n").over(earlier).alias("_n_in"))
        final[row_number] = F.col("_rn") + F.coalesce(F.col("_n_in"), F.lit(0))

    inner = base.select("*", *local)
    borders = base.groupBy(*keys, "_b").agg(*summary).select(*keys, "_b", *carry)
    renamed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    borders = borders.select(*renamed, F.col("_b").alias("_kb"),
                             *[c for c in borders.columns if c not in (*keys, "_b")])
    match = F.col("_b") == F.col("_kb")
    for i, k in enumerate(keys):
        match = match & (F.col(k) == F.col(f"_k{i}"))
    return inner.join(borders, match, "left").select(*keep, *[v.alias(k) for k, v in final.items()])


def blocks(column: Column | str, width: int) -> Column:
    """A bucket for ``ordered``: consecutive values in blocks of ``width``."""
    c = F.col(column) if isinstance(column, str) else column
    return F.floor(c / F.lit(width))


def global_rank(frame: DataFrame, order: Sequence[Column | str], name: str = "rank", start: int = 0) -> DataFrame:
    """Consecutive numbers over the whole frame without one global task: a range-partitioned
    sort, local numbering, and one offset per partition."""
    spine = [F.col(o) if isinstance(o, str) else o for o in order]
    placed = cut_lineage(frame.orderBy(*spine).withColumn("_mid", F.monotonically_increasing_id()))
    sizes = placed.groupBy(F.shiftright("_mid", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition, so a single-task window and a broadcast are bounded by the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    joined = placed.withColumn("_part", F.shiftright("_mid", 33)).join(F.broadcast(offsets), "_part")
    number = F.col("_off") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(start)
    return joined.select(*frame.columns, number.cast("bigint").alias(name))


def set_print(*parts: Column | str) -> list[Column]:
    """Aggregates that identify a set of distinct rows without collecting it: partial sums of two
    independent 64-bit hashes, combined on the map side. Returns three columns."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    h = F.xxhash64(*cols)
    g = F.xxhash64(F.lit("second"), *cols)
    return [
        F.sum(F.shiftrightunsigned(h, 32)).alias("_fp_hi"),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("_fp_lo"),
        F.bit_xor(g).alias("_fp_x"),
    ]


PRINT = ["_fp_hi", "_fp_lo", "_fp_x"]


def rank_value(frame: DataFrame, keys: Sequence[str], value: str, position: Column, name: str,
               bucket: Column | None = None) -> DataFrame:
    """The value at a 0-based sorted position per key (``position`` may use ``_total``), read from a
    histogram: equal values are one row, and the cumulative count is bucketed."""
    hist = frame.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    totals = hist.groupBy(*keys).agg(F.sum("_c").alias("_total"))
    if bucket is None:
        bucket = F.floor(F.log2(F.abs(F.col(value)) + 1) * 64) * F.signum(F.col(value))
    run = ordered(hist, keys, [value], bucket, prior_sum={"_below": "_c"})
    # Without keys the total is one row, and the border summaries are as many as there are buckets.
    placed = (run.join(totals, list(keys)) if keys else run.crossJoin(F.broadcast(totals))).withColumn("_pos", position)
    hit = (F.col("_below") <= F.col("_pos")) & (F.col("_pos") < F.col("_below") + F.col("_c"))
    return placed.where(hit).select(*keys, F.col(value).alias(name), F.col("_total").alias("n"))


def components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """Connected components as ``(node, component)``; the component is its smallest node.

    Alternates large-star and small-star rounds, which need O(log n) of them and only
    minima per node, so a node touching a third of all edges is one aggregate row. It raises, rather than return
    unsettled labels, where ``max_rounds`` were not enough.
    """
    both = cut_lineage(edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a IS NOT NULL AND b IS NOT NULL").distinct())
    nodes = both.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = cut_lineage(both.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node points to the node's smallest neighbour.
        sym = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: smaller neighbours and the node itself point to the smallest one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        links = cut_lineage(small.where("u <> v").distinct())
        state = links.agg(F.count(F.lit(1)), F.sum(F.shiftrightunsigned(F.xxhash64("u", "v"), 32)),
                          F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == tuple(state):
            break
        mark = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    roots = links.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(roots, nodes.node == roots.u, "left").select(
        "node", F.coalesce("component", "node").alias("component"))
