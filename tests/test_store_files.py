"""A store's folders as they lie on disk, and canonical bytes by any number of partitions."""

import os
import time

import pytest
from pyspark.sql import functions as F

from cairnsift.operators import store
from cairnsift.sources import canonical, records
from tests.util import rows


def test_manifests_against_files(spark, tmp_path):
    base = tmp_path / "st"
    for name, size in (("o/a/t/x.raw", 5), ("o/a/t/y\tz.raw", 7), ("o/b/t/x.raw", 5), ("o/c/obj/x", 1), ("partial/k1.part", 1), ("partial/k1.json", 1), ("partial/k2.part", 1), ("locks/o-a.lock", 1)):
        path = base / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * size)
    at = 1_700_000_000_123_456_789
    for name in ("o/a/t/x.raw", "o/a/t/y\tz.raw", "o/b/t/x.raw"):
        os.utime(base / name, ns=(at, at))
    line = lambda path, size, ns: f"{path}\t{size}\tAB\t{ns}\n"
    head = records.MEMBERS_HEADER + "\n"
    (base / "o/a/members.tsv").write_text(head + line("t/x.raw", 5, at) + line(r"t/y\tz.raw", 7, at) + line("t/gone", 1, at))
    (base / "o/b/members.tsv").write_text(head + line("t/x.raw", 6, at + 10**9))
    (base / "o/c/members.tsv").write_text("path\tsize\n")
    got = records.read_store_folders(spark, str(base), time.time_ns() // 1000)
    objects = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "object_id string")
    assert rows(store.changed_members(objects, got["members"], got["tree"])) == [("a", 1), ("b", 1), ("c", None), ("d", 0)]
    assert rows(store.member_changes(got["members"].where("NOT bad"), got["tree"]), "object_id", "path", "problem") == [("a", "t/gone", "missing"), ("b", "t/x.raw", "size")]
    assert rows(got["partials"]) == [("k1",), ("k2",)] and got["locks"].first().name == "o-a" and got["locks"].first().age_s < 600


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_canonical_bytes_do_not_depend_on_partitions(spark, tmp_path, parts):
    frame = spark.range(1000).select(F.when(F.col("id") < 900, "u").otherwise("v").alias("unit"), (F.col("id") * 7 % 100).alias("k"), F.concat(F.lit("e"), F.col("id") % 250).alias("e"))
    want = sorted((r.unit, r.k, r.e) for r in frame.collect())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        canonical.write(frame.repartition(parts), [F.col("unit"), F.col("k")], F.col("e"), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "out").glob("part-*")))
    assert data.decode().split("\n")[:-1] == [e for *_, e in want]
    assert [r.entry for r in canonical.read_back(spark, str(tmp_path / "out")).orderBy("position").collect()] == [e for *_, e in want]
    placed = canonical.positions(frame.repartition(parts), "unit", [F.col("k")], F.col("e"))
    assert sorted(r.position for r in placed.where("unit = 'u'").collect()) == list(range(900))
    digests = {r.unit: (r.digest, r.entries, r.bytes) for r in canonical.digest(canonical.block_digests(placed, "unit", 8), "unit", 8).collect()}
    again = {r.unit: (r.digest, r.entries, r.bytes) for r in canonical.digest(canonical.block_digests(canonical.positions(frame, "unit", [F.col("k")], F.col("e")), "unit", 8), "unit", 8).collect()}
    assert digests == again and digests["u"][1] == 900 and sum(d[2] for d in digests.values()) == len(data)
