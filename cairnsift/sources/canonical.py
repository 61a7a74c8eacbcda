"""Canonical bytes of a table, written in parallel and checked block by block.

The canonical form of a table is its entries, one line each, in one order that leaves no two entries equal in place: the
given keys, then the entry's own text. The writer sorts by range, so the parts joined in the order of their names are the
same bytes for any number of partitions, and no entry list is ever one row or one task's. Digests are taken over blocks of
positions and over the blocks' digests; equal tables have equal digests however they were written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cairnsift import scale
from cairnsift.session import stored
from cairnsift.sources import blocks

BLOCK = 1 << 16


def positions(rows: DataFrame, unit: str, order: Sequence[Column], entry: Column) -> DataFrame:
    """``unit``, ``position`` (from 0, unique in the unit) and ``entry``; equal entries follow each other."""
    spine = [F.col(unit), *order, entry]
    named = rows.select(*[c.alias(f"_o{i}") for i, c in enumerate(spine)])
    ranked = scale.global_rank(named, [f"_o{i}" for i in range(len(spine))], "_rank")
    first = ranked.groupBy("_o0").agg(F.min("_rank").alias("_first"))
    last = f"_o{len(spine) - 1}"
    return ranked.join(first, "_o0").select(F.col("_o0").alias(unit), (F.col("_rank") - F.col("_first")).alias("position"), F.col(last).alias("entry"))


def block_digests(placed: DataFrame, unit: str, width: int = BLOCK) -> DataFrame:
    """Digest of each block of ``width`` positions: ``unit``, ``block``, ``entries``, ``bytes``, ``digest``. Positions are
    unique, so a block holds at most ``width`` entries."""
    cells = placed.select(unit, "position", "entry", F.floor(F.col("position") / width).alias("block"))
    lines = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("position", "entry"))), lambda x: x["entry"]))
    return cells.groupBy(unit, "block").agg(F.count(F.lit(1)).alias("entries"), F.sum(F.octet_length("entry") + 1).alias("bytes"), F.sha2(lines, 256).alias("digest"))


def digest(digests: DataFrame, unit: str, width: int = BLOCK) -> DataFrame:
    """One digest per unit over its blocks' digests, in levels: as many as leave each unit one, each over at most ``width``."""
    at = digests.select(unit, F.col("block").alias("position"), F.col("digest").alias("entry"), "entries", "bytes")
    levels, most = 1, (digests.agg(F.max("block")).first()[0] or 0) + 1
    while most > width:
        levels, most = levels + 1, -(-most // width)
    for _ in range(levels):
        lines = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("position", "entry"))), lambda x: x["entry"]))
        at = at.groupBy(unit, F.floor(F.col("position") / width).alias("position")).agg(F.sha2(lines, 256).alias("entry"), F.sum("entries").alias("entries"), F.sum("bytes").alias("bytes"))
    return at.select(unit, F.col("entry").alias("digest"), "entries", "bytes")


def write(rows: DataFrame, order: Sequence[Column], entry: Column, path: str) -> None:
    """The entries as text parts below ``path``; joined by their names they are the canonical bytes. Entries hold no break."""
    lines = rows.select(*[c.alias(f"_o{i}") for i, c in enumerate(order)], entry.alias("value"))
    lines.orderBy(*[f"_o{i}" for i in range(len(order))], "value").select("value").write.text(path)


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """``position`` (from 0) and ``entry`` of what ``write`` left, from the parts' names and line numbers."""
    lines = stored(blocks.file_lines(spark, path))
    part = F.regexp_extract("relative_path", r"part-([0-9]+)", 1).cast("bigint")
    sized = lines.select(part.alias("part"), "line_no", blocks.readable("text").alias("entry"))
    per = sized.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row per part: the running count is over as many rows as there are parts.
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = per.select(F.col("part").alias("_p"), before.alias("start"))
    return sized.join(starts, F.col("part") == F.col("_p")).select((F.col("start") + F.col("line_no") - 1).cast("bigint").alias("position"), "entry")
