"""Checks of an object store with claims: anti-joins and grouped comparisons of its record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnsift import vocab
from cairnsift.operators.checks import run_checks
from cairnsift.scale import PRINT, set_print

LIVE = ("materialized", "pending")


def _found(rows: DataFrame, kind: str, severity: str, subject) -> DataFrame:
    return rows.select(F.lit(kind).alias("kind"), F.lit(severity).alias("severity"), subject.cast("string").alias("subject"))


def object_claims(object_urls: DataFrame, index: DataFrame, claims: DataFrame) -> DataFrame:
    """Per object: claims on its URLs that keep it, and those that could release it.

    ``object_urls(object_id, url_key)``, ``index(url_key, object_id)``, ``claims(url_key, unit_id, state, object_id)``."""
    ix = index.select("url_key", F.col("object_id").alias("index_object"))
    on = object_urls.select(F.col("object_id").alias("oid"), "url_key").join(claims, "url_key").join(ix, "url_key", "left")
    unset = F.coalesce("object_id", F.lit("")) == ""
    own = F.coalesce(F.col("object_id") == F.col("oid"), F.lit(False))
    live = F.col("state").isin(*LIVE) & (own | (unset & F.coalesce(F.col("index_object") == F.col("oid"), F.lit(False))))
    return on.groupBy(F.col("oid").alias("object_id")).agg(F.count_if(live).alias("live"), F.count_if(unset | own).alias("releasing"))


def object_findings(objects: DataFrame, object_urls: DataFrame, index: DataFrame, claims: DataFrame) -> DataFrame:
    """``objects(object_id, has_record, record_ok, state, has_bytes, file_present, changed_members, approval_id, boundary)``."""
    reached = index.select("object_id").union(claims.select("object_id")).where("coalesce(object_id, '') <> ''").distinct().withColumn("reached", F.lit(True))
    o = objects.join(reached, "object_id", "left").join(object_claims(object_urls, index, claims), "object_id", "left")
    b, st = F.col("has_bytes"), F.col("state")
    known = F.col("has_record") & F.col("record_ok")
    open_ = known & (st != "collected")
    unreached = F.col("reached").isNull()
    none = (F.coalesce("live", F.lit(0)) == 0) & (F.coalesce("releasing", F.lit(0)) == 0)
    settled = open_ & ~(b & unreached)
    ready = settled & (st == "ready")
    rules = [
        ("orphan_object", "fail", (~F.col("has_record") & b) | (F.col("has_record") & ~F.col("record_ok")) | (open_ & b & unreached)),
        ("incomplete_object", "warn", ~F.col("has_record") & ~b),
        ("tombstone_with_bytes", "fail", known & (st == "collected") & b),
        ("tombstone_without_approval", "fail", known & (st == "collected") & (F.col("approval_id").isNull() | ~F.coalesce(F.col("boundary") == "5", F.lit(False)))),
        ("collection_incomplete", "warn", open_ & (st == "collection_incomplete")),
        ("no_releasing_unit", "fail", settled & b & none),
        ("object_file_missing", "warn", ready & ~F.col("file_present")),
        ("unreadable_members", "warn", ready & F.col("changed_members").isNull()),
        ("modified_in_place", "warn", ready & (F.col("changed_members") > 0)),
    ]
    hits = F.array_compact(F.array(*[F.when(F.coalesce(r, F.lit(False)), F.struct(F.lit(k).alias("kind"), F.lit(s).alias("severity"))) for k, s, r in rules]))
    return o.select("object_id", F.explode(hits).alias("h")).select("h.kind", "h.severity", F.col("object_id").cast("string").alias("subject"))


def claim_findings(claims: DataFrame, objects: DataFrame, index: DataFrame, units: DataFrame) -> DataFrame:
    """Live claims of released or unknown units, and records that name an object the store lacks. A claim opened after its
    unit's release is a new consumer's. ``units(unit_id, released_us)``, null while active; ``claims(..., opened_us)``."""
    ids = objects.select(F.col("object_id").alias("_o"))
    live = claims.where(F.col("state").isin(*LIVE)).join(units.select("unit_id", "released_us", F.lit(True).alias("known")), "unit_id", "left")
    released = F.col("known") & F.col("released_us").isNotNull()
    after = F.col("opened_us") > F.col("released_us")
    subject = F.concat_ws("/", F.col("url_key").cast("string"), F.col("unit_id").cast("string"))
    rules = [
        ("claimed_after_release", "info", released & after), ("live_claim_on_terminal_unit", "fail", released & ~after),
        ("live_claim_without_unit", "warn", F.col("known").isNull() & (F.col("state") == "materialized")), ("pre_claimed", "info", F.col("known").isNull() & (F.col("state") != "materialized"))]
    hits = F.array_compact(F.array(*[F.when(F.coalesce(r, F.lit(False)), F.struct(F.lit(k).alias("kind"), F.lit(s).alias("severity"))) for k, s, r in rules]))
    by_unit = live.select(subject.alias("subject"), F.explode(hits).alias("h")).select("h.kind", "h.severity", "subject")
    dangling = live.where("coalesce(object_id, '') <> ''").join(ids, F.col("object_id") == F.col("_o"), "left_anti")
    lost = index.where("coalesce(object_id, '') <> ''").join(ids, F.col("object_id") == F.col("_o"), "left_anti")
    return run_checks([by_unit, _found(dangling, "dangling_claim", "warn", subject), _found(lost, "dangling_index", "warn", F.col("url_key"))])


def leftovers(partials: DataFrame, claims: DataFrame, locks: DataFrame, stale_seconds: int = vocab.HOLDER_STALE_SECONDS) -> DataFrame:
    """Partial transfers without a live claim, and locks whose heartbeat has lapsed. ``partials(url_key)``, ``locks(name, age_s)``."""
    live = claims.where(F.col("state").isin(*LIVE)).select("url_key").distinct()
    gone = partials.select("url_key").distinct().join(live, "url_key", "left_anti")
    return _found(gone, "abandoned_partial", "warn", F.col("url_key")).unionByName(_found(locks.where(F.col("age_s") > stale_seconds), "stale_lock", "warn", F.col("name")))


def hold_while_busy(found: DataFrame, locks: DataFrame, stale_seconds: int = vocab.HOLDER_STALE_SECONDS) -> DataFrame:
    """Findings on objects under a fresh lock become a note that they were being worked on. ``locks(name, age_s)`` with
    names ``o-<object>``."""
    fresh = locks.where(F.col("age_s") <= stale_seconds).select(F.substr(F.col("name"), F.lit(3)).alias("_s")).distinct().withColumn("_busy", F.lit(True))
    j = found.join(fresh, F.col("subject") == F.col("_s"), "left")
    busy = F.col("_busy").isNotNull()
    return j.select(F.when(busy, "object_busy").otherwise(F.col("kind")).alias("kind"), F.when(busy, "info").otherwise(F.col("severity")).alias("severity"), "subject")


def store_verdict(found: DataFrame) -> DataFrame:
    return found.groupBy("severity", "kind").agg(F.count(F.lit(1)).alias("n"))


def member_changes(recorded: DataFrame, found: DataFrame, grain_ns: int = 1_000_000) -> DataFrame:
    """Members that differ from their manifest: ``object_id``, ``path``, ``problem`` (missing, size, time).

    ``recorded`` and ``found(object_id, path, size, mtime_ns)``; times are compared to ``grain_ns``, the finest that the
    file listing gives. Objects whose sets have equal prints are settled without a look at their members; a file that no
    manifest lists is no change."""
    grain = lambda f: f.select("object_id", "path", "size", (F.col("mtime_ns") - F.col("mtime_ns") % grain_ns).alias("at"))
    r, f = grain(recorded), grain(found)
    tag = lambda frame, s: frame.groupBy("object_id").agg(F.count(F.lit(1)).alias("n"), *set_print("path", "size", "at")).select("object_id", F.struct("n", *PRINT).alias(s))
    open_ = tag(r, "_r").join(tag(f, "_f"), "object_id", "left").where(~F.col("_r").eqNullSafe(F.col("_f"))).select("object_id")
    left = r.join(open_, "object_id", "left_semi")
    right = f.join(open_, "object_id", "left_semi").select("object_id", "path", F.col("size").alias("_size"), F.col("at").alias("_at"))
    both = left.join(right, ["object_id", "path"], "left")
    problem = F.when(F.col("_size").isNull(), "missing").when(F.col("_size") != F.col("size"), "size").when(F.col("_at") != F.col("at"), "time")
    return both.select("object_id", "path", problem.alias("problem")).where("problem IS NOT NULL")


def changed_members(objects: DataFrame, manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Objects with ``changed_members`` worked out: the number of members that differ, null where the manifest cannot be
    read. ``manifest`` as ``records.manifest_rows`` gives it; an object without a manifest has none that differ."""
    bad = manifest.where("bad").select(F.col("object_id").alias("_b")).distinct()
    per = member_changes(manifest.where("NOT bad").drop("bad"), found).groupBy(F.col("object_id").alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    out = objects.join(bad, F.col("object_id") == F.col("_b"), "left").join(per, F.col("object_id") == F.col("_c"), "left")
    n = F.when(F.col("_b").isNull(), F.coalesce("_n", F.lit(0)))
    return out.select(*[c for c in objects.columns if c != "changed_members"], n.alias("changed_members"))
