"""The bucketed operators equal the plain windows, with one key holding most rows and small buckets."""

import random

from pyspark.sql import Window, functions as F

from cairnsift.scale import blocks, components, global_rank, ordered, rank_value, set_print, PRINT
from tests.util import rows


def skewed(spark, n=600, seed=1):
    r = random.Random(seed)
    data = [("hot" if r.random() < 0.7 else f"k{r.randrange(5)}", i * r.choice([1, 1, 3]) + i, r.randrange(10) if r.random() > 0.1 else None) for i in range(n)]
    seen, out = set(), []
    for k, s, v in data:
        if (k, s) not in seen:
            seen.add((k, s))
            out.append((k, s, v))
    return spark.createDataFrame(out, "k string, s bigint, v bigint").repartition(3)


def test_ordered_equals_window(spark):
    df = skewed(spark)
    got = ordered(df, ["k"], ["s"], blocks("s", 17), lag={"lg": "v"}, lead={"ld": "v", "ls": "s"}, prior_max={"pm": "v"},
                  later_max={"lm": "v"}, prior_sum={"ps": F.coalesce("v", F.lit(0))}, row_number="rn")
    w = Window.partitionBy("k").orderBy("s")
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    want = df.select("k", "s", "v", F.lag("v").over(w), F.lead("v").over(w), F.lead("s").over(w), F.max("v").over(before), F.max("v").over(after),
                     F.coalesce(F.sum("v").over(before), F.lit(0)), F.row_number().over(w))
    assert rows(got, "k", "s", "v", "lg", "ld", "ls", "pm", "lm", "ps", "rn") == rows(want)


def test_global_rank_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x")).repartition(7)
    got = rows(global_rank(df, ["x"]), "x", "rank")
    assert [r[1] for r in sorted(got)] == list(range(1000))


def test_rank_value_selects_elements(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 1, 5, 9, 100)] + [("b", 7)], "k string, v bigint")
    got = rank_value(df, ["k"], "v", F.floor(F.col("_total") / 2), "m")
    assert rows(got, "k", "m", "n") == [("a", 5, 5), ("b", 7, 1)]


def test_set_print_ignores_order_and_partitioning(spark):
    a = spark.createDataFrame([("x", i) for i in range(50)], "k string, v int")
    p = lambda f: rows(f.groupBy("k").agg(*set_print("v")), *PRINT)
    assert p(a) == p(a.orderBy(F.desc("v")).repartition(5))
    assert p(a) != p(a.where("v <> 3"))


def test_components_with_a_hub_and_a_long_chain(spark):
    edges = [("hub", f"h{i:03d}") for i in range(100)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)] + [("z1", "z1")]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()}
    parent: dict[str, str] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    assert got == {n: find(n) for e in edges for n in e}
