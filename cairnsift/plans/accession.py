"""Validate decisions against the archives they rest on, accession by accession."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnsift.functions import names
from cairnsift.operators import checks, duplicates, matching
from cairnsift.session import stored

SCOPE = ("accession",)


def archive_findings(listing: DataFrame, items: DataFrame) -> DataFrame:
    """Members nobody accounts for, kept files with a byte-identical twin, and names that mean no single member.

    ``listing(accession, archive, path, size, crc32)``, ``items(accession, unit_id, member_path, raw_file, reason, ...)``.
    Names, copies and loose members are those of one accession's own listing; a loose member has no unit."""
    members = stored(matching.index_members(listing, scope=SCOPE))
    # Read three times below, with the columns that are read only; an item with a member path is known by it.
    bare = F.when(F.coalesce(F.col("member_path"), F.lit("")) == "", F.col("raw_file"))
    items = stored(items.select(*SCOPE, "unit_id", "member_path", bare.alias("raw_file"), "reason"))
    # Each kind of finding is stored before the next one runs, so that the disk holds the shuffles of one only.
    loose = stored(matching.loose_members(listing, items, SCOPE).select(*SCOPE, F.lit(None).cast("string").alias("unit_id"), F.col("member_key").alias("subject")))
    keyed = stored(matching.item_keys(items, members, SCOPE).where("reason IS NULL").select(*SCOPE, "unit_id", "key", "resolved").distinct())
    groups = stored(duplicates.content_groups(listing, SCOPE).select(*SCOPE, F.col("member_key").alias("key")))
    twins = stored(keyed.where("resolved").join(groups, [*SCOPE, "key"], "left_semi"))
    say = lambda rows, check, level, message: rows.select(
        *SCOPE, F.lit(check).alias("check_id"), F.lit(level).alias("severity"), "unit_id", "subject", F.lit(message).alias("message"))
    return checks.run_checks([
        say(loose, "T-MEMBER", "hold", "loose_member"), say(twins.withColumnRenamed("key", "subject"), "T-DUP", "error", "byte_identical"),
        say(keyed.where("NOT resolved").withColumnRenamed("key", "subject"), "T-MEMBER", "hold", "unresolved")])


def accession_verdict(listing: DataFrame, items: DataFrame, units: DataFrame) -> DataFrame:
    """Verdict per unit and accession over the archive findings. ``units(unit_id, accession)``: the units that rest on
    their accession's listing; its loose members count in the accession's own row. A listing without the column is that of
    the one accession that the units name."""
    if not set(SCOPE) <= set(listing.columns):
        named = units.agg(F.min("accession").alias("least"), F.max("accession").alias("most")).first()
        if named.least != named.most:
            raise ValueError("a listing for several accessions must say whose each member is")
        listing = listing.withColumn("accession", F.lit(named.least))
    owned = items.join(units.select("unit_id", *SCOPE).distinct(), "unit_id")
    found = archive_findings(listing, owned)
    per = checks.verdict(found.where("unit_id IS NOT NULL").drop(*SCOPE), units)
    whole = found.where("unit_id IS NULL").groupBy(F.col("accession").alias("_accession")).agg(
        F.count_if(F.col("severity") == "error").alias("_errors"), F.count_if(F.col("severity") == "hold").alias("_holds"))
    both = per.join(whole, (F.col("accession") == F.col("_accession")) & F.col("unit_id").isNull(), "left")
    errors, holds = (F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in ("errors", "holds"))
    return both.select("accession", "unit_id", F.when(errors > 0, "error").when(holds > 0, "hold").otherwise("pass").alias("verdict"), errors.alias("errors"), holds.alias("holds"))


def listing_summary(listing: DataFrame) -> DataFrame:
    """Members and bytes per archive, and how many are raw-like."""
    return listing.groupBy("archive").agg(F.count(F.lit(1)).alias("members"), F.sum("size").alias("bytes"), F.count_if(names.is_raw_like("path")).alias("raw_like"))
