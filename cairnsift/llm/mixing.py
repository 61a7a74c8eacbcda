"""Mixing sources to target weights by Poisson replication.

Each source's size is its number of characters. A source of size ``n`` and weight ``w`` gets the mean repetition rate
``w / sum(w) * total / n``, so that the expected mix has the target weights and the input's size. Each document's count
comes from inverting the Poisson distribution of that mean at a uniform number hashed from the seed and its id, so a
rerun after a lost executor gives the same counts. Rates over ``STEP`` are a sum of equal parts, each with its own
uniform number.

Null texts count as empty. A null source is a source of its own. Sources without characters, and those with no weight
where weights are given, get rate 0. Rows that share an id get the same count each. A null id counts as the text
``null``. Other columns pass through. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.llm.shared import fresh

STEP = 16.0
# For a mean of at most STEP, less than 2^-52 lies beyond this count, the resolution of the uniform numbers.
COUNTS = 80


def uniform(seed: str, key: Column, part: Column) -> Column:
    """A number in [0, 1) with 52 bits, from a digest."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")), part.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def rates(documents: DataFrame, weights: Mapping[str, float] | None, source: str, text: str) -> DataFrame:
    """One row per source: its rate, in how many parts it is drawn, and the distribution of one part."""
    size = F.coalesce(F.length(F.col(text)), F.lit(0)).cast("long")
    sizes = documents.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.when(F.col("size") > 0, 1.0).otherwise(0.0))
    else:
        given = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.create_map().cast("map<string,double>")
        weighed = sizes.withColumn("weight", F.when(F.col("size") > 0, F.coalesce(given[F.col("source")].cast("double"), F.lit(0.0))).otherwise(0.0))
    whole = weighed.agg(F.sum("size").alias("total"), F.sum("weight").alias("sum_weight"))
    mean = F.when(F.col("weight") > 0, F.col("weight") / F.col("sum_weight") * F.col("total") / F.col("size")).otherwise(0.0)
    # One row, so the cross join only adds two columns.
    rated = weighed.crossJoin(F.broadcast(whole)).select("source", mean.alias("rate"))
    rated = rated.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / STEP)).cast("int"))
    each = F.col("rate") / F.col("parts")
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(COUNTS)),
        F.struct(F.exp(-each).alias("p"), F.array(F.exp(-each)).alias("cdf")),
        lambda a, k: F.struct((a["p"] * each / k).alias("p"), F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * each / k)).alias("cdf")),
    )
    return rated.withColumn("cdf", steps["cdf"])


def mix(documents: DataFrame, weights: Mapping[str, float] | None = None, seed: str = "mix", doc_id: str = "doc_id",
        source: str = "source", text: str = "text") -> DataFrame:
    """The documents, each repeated by its count and dealt out in hash order, with ``copy`` (from 0), ``rate`` and
    ``place``, the hash the order follows. ``weights``: by source; None: equal weights."""
    copy, rate, place, key, dist, parts = fresh(documents, "copy", "rate", "place", "_source", "_cdf", "_parts")
    by_source = rates(documents, weights, source, text).select(
        F.col("source").alias(key), F.col("rate").alias(rate), F.col("parts").alias(parts), F.col("cdf").alias(dist))
    joined = documents.join(by_source, F.col(source).eqNullSafe(F.col(key)))
    drawn = F.transform(F.sequence(F.lit(1), F.col(parts)), lambda k: F.size(F.filter(dist, lambda c: c <= uniform(seed, F.col(doc_id), k))))
    count = F.aggregate(drawn, F.lit(0), lambda a, n: a + n)
    copies = F.when(F.col(rate) > 0, count).otherwise(0)
    repeated = joined.withColumn(copy, F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies - 1))))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.lit("place"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.col(copy).cast("string")))
    placed = repeated.withColumn(place, order).drop(key, dist, parts)
    return placed.repartition(place).sortWithinPartitions(place)
