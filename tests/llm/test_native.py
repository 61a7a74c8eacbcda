"""Quality rules, line dedup, mixing and the secret scan: results and odd inputs."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from cairnsift.llm import line_dedup, mixing, quality, secret_scan

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
GOOD = "The quick brown fox jumps over the lazy dog and runs away.\nThen it sleeps for a long while under the old tree."


def docs(spark, *texts, source="a"):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)], DOCS)


def test_quality_counts_and_verdict(spark):
    table = "\n".join("cell | other | third | fourth" for _ in range(6))
    texts = [GOOD, None, "", " \t\n", "one two", "a b c d e f " * 3, table, GOOD + "\n\nAll rights reserved.", "x" * 200_000 + " " + GOOD]
    got = {r.doc_id: r for r in quality.assess(docs(spark, *texts)).collect()}
    assert got[0].kept and not got[0].base_failed and got[0].n_repeat_words == 0
    assert [got[i].n_words for i in (1, 2, 3, 4)] == [0, 0, 0, 2] and all(got[i].base_failed and not got[i].kept for i in (1, 2, 3, 4))
    assert got[5].n_repeat_words == 18 and got[5].base_failed
    assert got[6].n_dup_lines == 5 and not got[6].kept
    assert got[7].kept and "reserved" not in got[7].clean_text and got[7].lost_chars == 18
    assert got[8].n_words == 24


def test_quality_filter_agrees_with_assessment(spark):
    frame = docs(spark, GOOD, None, "a b c d e f " * 3, "one | two | three | four | five | six | seven | eight | nine | ten | eleven")
    kept = {r.doc_id for r in quality.assess(frame).where("kept").collect()}
    assert {r.doc_id for r in frame.where(quality.accepted(F.col("text"))).collect()} == kept == {0}


def test_quality_against_labels(spark):
    root = "/root/testdata/sf0.01"
    judged = quality.assess(spark.read.parquet(f"{root}/documents.parquet")).join(spark.read.parquet(f"{root}/labels.parquet"), "doc_id")
    right = judged.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0]
    assert right > 0.95


def test_chunks_give_the_text_back(spark):
    texts = ["a\nb\nc\n\nd\ne", "", "one line", "\n\n\n", "tail\n"]
    rows = docs(spark, *texts).select("text", F.array_join(line_dedup.chunks(F.col("text")), "\n").alias("again")).collect()
    assert all(r.text == r.again for r in rows)


def test_line_dedup_removes_later_chunks_only(spark):
    passage = "\n".join(f"shared line {i}" for i in range(12))
    texts = [f"own start\n{passage}\nown end", f"other\nmore\n{passage}\nlast", "single", None, "", f"{passage}\n{passage}"]
    got = {r.doc_id: r for r in line_dedup.remove(docs(spark, *texts)).collect()}
    assert got[0].text == texts[0] and got[0].n_removed == 0
    assert got[1].n_removed > 0 and "other" in got[1].text and "last" in got[1].text and len(got[1].text) < len(texts[1])
    assert got[2].text == "single" and got[3].text is None and got[4].text == ""
    assert got[5].n_removed > 0 and len(got[5].text) < len(texts[5])


def test_line_dedup_takes_whole_runs(spark):
    runs = ["\n".join(f"shared line {k} of {n}" for k in range(n)) for n in range(2, 30)]
    texts = [*[f"first {n}\n{x}\nend {n}" for n, x in enumerate(runs)], *[f"later {n}\n{x}\nstop {n}" for n, x in enumerate(runs)]]
    got = {r.doc_id: r for r in line_dedup.remove(docs(spark, *texts), whole=True).collect()}
    for n, x in enumerate(runs):
        assert got[n].text == texts[n] and got[n].n_removed == 0
        assert got[n + len(runs)].text == f"later {n}\nstop {n}" and got[n + len(runs)].n_removed == n + 2
    odd = ["a\na\na", "b\nc\nb\nc", None, "", "one"]
    assert [r.text for r in line_dedup.remove(docs(spark, *odd), whole=True).orderBy("doc_id").collect()] == ["a\na\na", "b\nc", None, "", "one"]


def test_pipeline_cuts_chunks_by_rolling_hashes(spark, monkeypatch):
    """The stage takes the lines of the method's chunks, and the exact pass adds the rims of the same passages."""
    import corpus_pipeline
    body = [f"line {i} of a passage" for i in range(12)]
    texts = docs(spark, "\n".join(body + ["own"]), "\n".join(["other", *body, "end"]))
    chunked = line_dedup.repeated_chunks(texts, lines=True).collect()
    assert chunked and {(r.doc_id, r.ord) for r in chunked} <= {(r.doc_id, r.ord) for r in line_dedup.repeated_lines(texts).collect()}
    asked, plain = [], line_dedup.repeated_chunks
    monkeypatch.setattr(line_dedup, "repeated_chunks", lambda *a, **k: asked.append(k) or plain(*a, **k))
    got = corpus_pipeline.line_chunks(spark, texts.withColumn("n_chars", F.length("text")), "").orderBy("doc_id").collect()
    assert asked == [{"lines": True}] and got[1].text == "other\nend"


def test_line_dedup_odd_tables(spark):
    extra = docs(spark, "a\nb\nc", "a\nb\nc").withColumn("_gone", F.lit(1)).withColumn("n_removed", F.lit("x"))
    out = line_dedup.remove(extra)
    assert set(extra.columns) <= set(out.columns) and out.count() == 2
    assert line_dedup.remove(docs(spark, "a").limit(0)).count() == 0
    twice = docs(spark, "a\nb\nc\nd").union(docs(spark, "a\nb\nc\nd"))
    assert {r.text for r in line_dedup.remove(twice).collect()} == {"a\nb\nc\nd"}
    lost = docs(spark, "a\nb\nc\nd", "a\nb\nc\nd").withColumn("doc_id", F.when(F.col("doc_id") == 0, F.col("doc_id")))
    assert [r.n_removed for r in line_dedup.remove(lost).collect()] == [0, 0]


def test_counts_follow_the_poisson_distribution(spark):
    frame = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("x" * 10).alias("text"), F.lit("en").alias("lang"),
                                      F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("source"), F.lit(10).cast("bigint").alias("n_chars"))
    mixed = mixing.mix(frame, weights={"a": 1.0, "b": 3.0})
    sums = {r.source: (r.n, r.rate) for r in mixed.groupBy("source").agg(F.count("*").alias("n"), F.first("rate").alias("rate")).collect()}
    assert sums["a"][1] == pytest.approx(1 / 3) and sums["b"][1] == pytest.approx(3.0)
    assert sums["a"][0] == pytest.approx(5000, rel=0.06) and sums["b"][0] == pytest.approx(15000, rel=0.06)
    per_doc = mixed.where("source = 'b'").groupBy("doc_id").count().groupBy("count").agg(F.count("*").alias("n")).collect()
    share = {r["count"]: r.n / 5000 for r in per_doc}
    assert all(abs(share.get(k, 0) - math.exp(-3) * 3**k / math.factorial(k)) < 0.03 for k in range(1, 8))
    assert [r.place for r in mixed.collect()] != sorted(r.doc_id for r in mixed.collect())


def test_mix_large_rates_nulls_and_clashes(spark):
    frame = docs(spark, "ab", None, "", "abcd").withColumn("source", F.when(F.col("doc_id") < 2, F.lit(None)).otherwise(F.lit("s"))).withColumn("rate", F.lit("mine"))
    out = mixing.mix(frame)
    assert out.columns == [*frame.columns, "rate_", "copy", "place"]
    big = docs(spark, "a").union(docs(spark, *["b" * 200], source="z").withColumn("doc_id", F.lit(9).cast("bigint")))
    n = {r.source: r.n for r in mixing.mix(big).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert 60 < n["a"] < 150
    assert mixing.mix(frame.limit(0)).count() == 0
    none = mixing.mix(docs(spark, "a", "b"), weights={"other": 1.0})
    assert none.count() == 0


def test_native_queries_against_sql(spark):
    import __spark_entry__ as entry

    root = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{root}/documents.parquet'")
    key = lambda r: tuple((v is None, str(v)) for v in r)
    for name in ("op1_substring_dedup", "op2_quality_rules", "op4_mix_sources", "op7_line_dedup"):
        frame = entry.queries()[name](spark, root)
        rel = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in rel.description]
        assert sorted(names) == sorted(frame.columns)
        assert sorted((tuple(r) for r in frame.select(*names).collect()), key=key) == sorted(rel.fetchall(), key=key), name


def secret_docs(spark, n=120):
    import random

    rng = random.Random(3)
    texts = []
    for i in range(n):
        hexes = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        if i % 3 == 0:
            texts.append(f'plain words here token = "{hexes}" and more words follow.')
        elif i % 3 == 1:
            texts.append(f"call the number {rng.randrange(10**15, 10**16)} or write to {i}.mail7.example.com today.")
        else:
            texts.append(f"see https://www.site{i}.example.com/path/{i} and the word list below.")
    return docs(spark, *texts)


def test_secret_scan_keeps_keys_and_drops_numbers(spark):
    got = secret_scan.scan(secret_docs(spark)).collect()
    assert {r.doc_id for r in got if r.is_secret} == set(range(0, 120, 3))


def test_secret_scan_held_out_accuracy(spark):
    known = secret_scan.dictionary(secret_docs(spark), "text", 1)
    found = secret_scan.candidates(secret_docs(spark), "doc_id", "text", "source").withColumn("row", F.monotonically_increasing_id())
    features = secret_scan.weak_labels(secret_scan.featured(found, known))
    got = secret_scan.scan(secret_docs(spark), labelled=features.where("doc_id < 60"))
    judged = got.join(features.where("doc_id >= 60 AND label IS NOT NULL").select("doc_id", "pos", "candidate", "label"), ["doc_id", "pos", "candidate"])
    assert judged.agg(F.avg((F.col("is_secret") == (F.col("label") == 1)).cast("double"))).first()[0] > 0.95


def test_secret_scan_odd_inputs(spark):
    assert secret_scan.scan(docs(spark, "a").limit(0)).count() == 0
    odd = docs(spark, None, "", " ", "no key here", 'token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"').withColumn("row", F.lit(5)).withColumn("label", F.lit("x"))
    assert [(r.doc_id, r.is_secret) for r in secret_scan.scan(odd).collect()] == [(4, True)]
    assert secret_scan.scan(odd.union(odd)).count() == 2
