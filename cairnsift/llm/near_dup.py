"""Near-duplicate documents: fast similarity sketches, banding, and confirmation on full sets.

A sketch of ``SIZE`` bins is filled in rounds. In each of the first ``SIZE`` rounds every shingle is thrown by hash into
a random bin; the next ``SIZE`` rounds throw every shingle into the round's own bin, so every bin fills. A bin keeps the
least (round, value) that it got, and rounds end once all bins are full: about ``SIZE * log(SIZE)`` throws, however large
the set. Two sketches agree in a bin with a probability equal to the sets' similarity, with the concentration of
independent samples.

Bands of ``ROWS`` bins give candidates: at similarity 0.8 a link misses all bands with a probability of about 3e-6. No
group's pairs are ever listed:

1. Documents with equal sets form one class, by a 128-bit print of the set; each class is one node from then on.
2. In each band's bucket every node is held against the bucket's least node, on full sets. Groups of copies become
   stars, and one component each.
3. What is left are nodes of different components in one bucket. Each is taken as its difference from what most nodes of
   the bucket's largest component have, and only nodes that share enough of a difference are held against each other
   (``likely``). The filter is exact, so no link between components is lost.

A group's least node may meet a third of all nodes: it is repeated once per ``SALT`` of them, so that no task holds a
group. Sets are compared by 64-bit prints of the shingles. ``doc_id`` names a document: rows that share an id are of one
component. Where their texts differ, rows are numbered in the order of their ids, the numbers are the nodes, and those of
one id are linked. Null and empty texts have no set and link with nothing; a null id has no component and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cairnsift.llm.text_arrays import mixed, prints, signed, slices, split, U64
from cairnsift.scale import components, global_rank
from cairnsift.session import stored

SIZE = 160
ROWS = 5
SALT = 256


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The distinct shingles of each text, as sorted 64-bit prints. A text of fewer words is one shingle."""
    w = split([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])
    p = prints(w)
    n = len(p) - width + 1
    rolled = np.zeros(max(0, n), U64)
    with np.errstate(over="ignore"):
        for k in range(width if n > 0 else 0):
            rolled = rolled * U64(0x2545F4914F6CDD1D) + p[k: k + n]
        rolled = mixed(rolled, width)
        out = []
        for a, b in zip(w.first[:-1], w.first[1:]):
            if b - a >= width:
                out.append(np.unique(rolled[a: b - width + 1]))
            elif b > a:
                whole = U64(b - a)
                for x in p[a:b]:
                    whole = whole * U64(0x2545F4914F6CDD1D) + x
                out.append(mixed(np.array([whole], U64), 99))
            else:
                out.append(np.zeros(0, U64))
    return out


def sketches(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """One row of ``size`` bins per set, all full where the set is not empty."""
    n = len(sets)
    table = np.full(n * size, np.iinfo(np.uint64).max, U64)
    items = np.concatenate(sets) if sets else np.zeros(0, U64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    for turn in range(2 * size):
        if not len(items):
            break
        thrown = mixed(items, turn)
        place = (((thrown >> U64(32)) * U64(size)) >> U64(32)).astype(np.int64) if turn < size else np.full(len(items), turn - size)
        np.minimum.at(table, owner * size + place, (U64(turn) << U64(32)) | (thrown & U64(0xFFFFFFFF)))
        missing = (table.reshape(n, size) == np.iinfo(np.uint64).max).any(axis=1)
        if not missing[owner].all():
            items, owner = items[missing[owner]], owner[missing[owner]]
    return table.reshape(n, size)


def bands(table: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, size = table.shape
    cells = table[:, : size // rows * rows].reshape(n, size // rows, rows)
    out = np.broadcast_to(np.arange(size // rows, dtype=U64), cells.shape[:2]).copy()
    for k in range(rows):
        out = mixed(out ^ cells[:, :, k], k)
    return out


def profile(documents: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """By document: ``n_shingles``, a 128-bit print of the set, and the band keys (null for an empty set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            keys = bands(sketches(sets))
            with np.errstate(over="ignore"):
                marks = [np.array([mixed(s, lane).sum() if len(s) else U64(0) for s in sets], U64) for lane in (5, 6)]
            full = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *[pa.array(signed(m), pa.int64()) for m in marks],
                pa.array([signed(k) if f else None for k, f in zip(keys, full)], pa.list_(pa.int64()))], ["doc_id", "n_shingles", "mark_a", "mark_b", "keys"])

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_shingles bigint, mark_a bigint, mark_b bigint, keys array<bigint>")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (``hub``, ``node``) whose full sets are similar. Each node's text goes to its hub's task; a hub's text
    goes once to every ``SALT`` of its nodes."""
    counts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / SALT).cast("int").alias("parts"))
    hubs = counts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("bigint").alias("node"))
    spread = pairs.join(counts, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node")
    wanted = spread.union(hubs).withColumn("who", F.coalesce("node", "hub"))
    told = wanted.join(texts, wanted.who == texts.doc_id).select("hub", "part", "node", "text")
    # Nulls sort first, so a hub comes before its nodes.
    placed = told.repartition("hub", "part").sortWithinPartitions("hub", "part", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = np.zeros(0, U64), None
        for batch in slices(batches):
            hub, node = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            sets = shingle_sets(batch.column(3).to_pylist(), width)
            out = []
            for h, n, s in zip(hub, node, sets):
                if n is None:
                    held, of = s, h
                elif h == of and min(len(s), len(held)) * 100 >= percent * max(len(s), len(held)):
                    both = len(np.intersect1d(s, held, assume_unique=True))
                    if 100 * both >= percent * (len(s) + len(held) - both):
                        out.append((h, n))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["hub", "node"])

    return placed.mapInArrow(run, "hub bigint, node bigint")


def shingled(texts: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """The sets (``node``, ``shingles``) of some documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            flat = pa.array(signed(np.concatenate(sets)) if sets else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(s) for s in sets]), pa.int32()), flat)], ["node", "shingles"])

    own = texts.join(nodes, F.col("doc_id") == F.col("node"), "left_semi").select("doc_id", "text")
    return own.mapInArrow(run, "node bigint, shingles array<bigint>")


def common(places: DataFrame, sets: DataFrame) -> DataFrame:
    """Per ``anchor`` the shingles (``base``) that more than half of its own nodes have."""
    own = places.where("part = anchor").select("anchor", "node")
    sizes = own.groupBy("anchor").agg(F.count(F.lit(1)).alias("own"))
    held = own.join(sizes, "anchor").join(sets, "node")
    several = held.where("own > 1").select("anchor", "own", F.explode("shingles").alias("shingle"))
    most = several.groupBy("anchor", "shingle").agg(F.count(F.lit(1)).alias("n"), F.first("own").alias("own")).where("2 * n > own")
    return held.where("own = 1").select("anchor", F.col("shingles").alias("base")).union(most.groupBy("anchor").agg(F.collect_list("shingle").alias("base")))


def likely(places: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) of nodes of different parts at one anchor that may be similar. Every link is among them or
    follows from some that are.

    A node is taken as its difference from the anchor's base: the shingles that only one of the two has. With d and e such
    shingles, of which c are the same ones, two sets of n and m differ in ``d + e - 2 * c``; a link needs that to be at most
    ``(n + m) * (100 - percent) / (100 + percent)``. In terms of ``weight = d * (100 + percent) - n * (100 - percent)``:

    * Weights of a sum of 0 or less are a link whatever c is. All of them are links of the anchor's lightest node, too.
    * Other links share ``least = ceil(sum / (2 * (100 + percent)))`` of the differing shingles, so they share one that has
      as many left, itself included, in each node's order from rare to frequent ones. Only such shingles are joined.

    Copies of one text share the text and hardly the changes, so few pairs of a group meet."""
    both = 100 + percent
    based = places.join(common(places, sets), "anchor", "left").join(sets, "node").withColumn("base", F.coalesce("base", F.array().cast("array<bigint>")))
    apart = based.select("anchor", "part", "node", F.size("shingles").cast("bigint").alias("n"),
                         F.concat(F.array_except("shingles", "base"), F.array_except("base", "shingles")).alias("apart"))
    weighed = stored(apart.withColumn("weight", F.size("apart") * both - F.col("n") * (100 - percent)))
    light = weighed.groupBy("anchor").agg(F.min(F.struct("weight", "node", "part")).alias("light"))
    sure = weighed.join(light, "anchor").where("light.part <> part AND weight + light.weight <= 0").select(F.col("light.node").alias("a"), F.col("node").alias("b"))

    changed = weighed.where("size(apart) > 0")
    partners = changed.groupBy("anchor").agg(F.min("weight").alias("lightest"), F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    least = lambda total: F.greatest(F.lit(1), F.ceil(total / (2 * both)))
    open_ = changed.join(partners.drop("low", "high"), "anchor").withColumn("need", least(F.col("weight") + F.col("lightest"))).where("need <= size(apart)")
    terms = open_.select("anchor", "part", "node", "weight", "need", F.explode("apart").alias("term"))
    known = terms.groupBy("anchor", "term").agg(F.count(F.lit(1)).alias("held"), F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    after = Window.partitionBy("anchor", "node").orderBy(F.desc("held"), F.desc("term"))
    asked = stored(terms.join(known.select("anchor", "term", "held"), ["anchor", "term"]).withColumn("left", F.row_number().over(after).cast("bigint")).where("left >= need"))
    asked = asked.select("anchor", "term", "part", "node", "weight", "left")
    told = asked.select("anchor", "term", *[F.col(c).alias(f"{c}_too") for c in ("part", "node", "weight", "left")])
    total = F.col("weight") + F.col("weight_too")
    met = asked.join(told, ["anchor", "term"]).where(
        (F.col("node") < F.col("node_too")) & (F.col("part") != F.col("part_too")) & (total > 0) & (F.least("left", "left_too") >= least(total)))
    return sure.union(met.select(F.col("node").alias("a"), F.col("node_too").alias("b")))


def groups(documents: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``documents``: ``doc_id``, ``n_shingles``, ``component_id`` (the least id reachable over links
    of at least ``percent`` similarity) and ``kept`` (whether the id is its component's). Ids are integers."""
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    known = stored(profile(rows, "doc_id", "text", width))
    torn = known.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        *[f(F.coalesce(m, F.lit(0))).alias(f"{f.__name__}_{m}") for f in (F.min, F.max) for m in ("mark_a", "mark_b")]).where("min_mark_a < max_mark_a OR min_mark_b < max_mark_b")
    if torn.isEmpty():
        return linked(rows, known, width, percent)
    numbered = stored(global_rank(rows, ["doc_id"], "number"))
    ids = numbered.where("doc_id IS NOT NULL").select("doc_id", "number")
    rows = numbered.select(F.when(F.col("doc_id").isNotNull(), F.col("number")).alias("doc_id"), "text")
    heads = ids.groupBy("doc_id").agg(F.min("number").alias("hub"), F.max("number").alias("last")).where("hub < last").select("doc_id", "hub")
    same = ids.join(heads, "doc_id").where("hub < number").select("hub", F.col("number").alias("node"))
    out = linked(rows, stored(profile(rows, "doc_id", "text", width)), width, percent, stored(same)).drop("kept")
    own = ids.select(F.col("number").alias("own_number"), F.col("doc_id").alias("own"))
    least = ids.select(F.col("number").alias("least_number"), F.col("doc_id").alias("least"))
    named = out.join(own, F.col("doc_id") == F.col("own_number"), "left").join(least, F.col("component_id") == F.col("least_number"), "left")
    return named.select(F.col("own").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"), F.coalesce(F.col("own") == F.col("least"), F.lit(True)).alias("kept"))


def linked(rows: DataFrame, known: DataFrame, width: int, percent: int, same: DataFrame | None = None) -> DataFrame:
    """``groups`` of rows with one text per id; ``same`` has links (``hub``, ``node``) that need no confirmation."""
    real = known.where("keys IS NOT NULL AND doc_id IS NOT NULL")
    classes = real.groupBy("mark_a", "mark_b").agg(F.min("doc_id").alias("node"))
    member = stored(real.select("doc_id", "mark_a", "mark_b").join(classes, ["mark_a", "mark_b"]).select("doc_id", "node").distinct())
    nodes = member.where("doc_id = node").select("node")

    keyed = real.select("doc_id", F.explode("keys").alias("key")).join(nodes, F.col("doc_id") == F.col("node"), "left_semi").select("key", F.col("doc_id").alias("node"))
    hubs = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last").select("key", "hub")
    shared = stored(keyed.join(hubs, "key").select("key", "hub", "node").distinct())
    texts = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")

    stars = shared.where("hub <> node").select("hub", "node").distinct()
    links = stored(confirmed(stars, texts, width, percent).distinct())
    settled = stored(components(links, "hub", "node"))

    placed = shared.join(settled, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part"))
    kinds = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"))
    # The largest component in a bucket is its anchor; where there is no other, nothing is left.
    anchors = kinds.groupBy("key").agg(F.max_by("part", F.struct("size", -F.col("part"))).alias("anchor"), F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key", "anchor")
    places = stored(placed.join(anchors, "key").select("anchor", "part", "node").distinct())
    sets = stored(shingled(texts, places.select("node").distinct(), width))
    fresh_pairs = likely(places, sets, percent).select(F.least("a", "b").alias("hub"), F.greatest("a", "b").alias("node")).distinct().join(stars, ["hub", "node"], "left_anti")
    more = stored(confirmed(fresh_pairs, texts, width, percent).distinct())
    if same is None:
        final = settled if more.isEmpty() else components(links.union(more), "hub", "node")
        named = member.join(final, "node", "left").select("doc_id", F.coalesce("component", "node").alias("component_id"))
    else:
        # Links of ids may be of any member, so members are linked with their nodes, too.
        tied = member.where("doc_id <> node").select(F.col("node").alias("hub"), F.col("doc_id").alias("node"))
        final = components(links.union(more).union(tied).union(same), "hub", "node")
        named = final.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
    out = known.select("doc_id", "n_shingles").join(named, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
