import json

import pytest
from pyspark.sql import functions as F

from cairnsift.sources import files, records
from tests.util import rows


def test_listing_headers_and_types(spark, tmp_path):
    p = tmp_path / "l.tsv"
    p.write_text("Archive\tPATH\tSize\tCRC\ttype\nz.zip\t\\a\\b.raw\t12\tab\tfile\nz.zip\ta/\t\t\tdir\nz.zip\tc.raw\t\t\t\n", encoding="utf-8")
    assert rows(files.read_listing(spark, str(p))) == [("z.zip", "a/b.raw", 12, "AB"), ("z.zip", "c.raw", 0, "")]
    with pytest.raises(ValueError):
        files.clean_listing(spark.createDataFrame([("x", "1")], "path string, size string"))


def test_listing_index_first_wins_and_flags_sizes(spark):
    raw = spark.createDataFrame([(1, "z", "A.raw", "5", "ab"), (2, "z", "a.RAW", "6", "cd"), (3, "z", "b.raw", "x1", "")], "n int, archive string, path string, size string, crc32 string")
    got = rows(files.listing_index(raw, ["n"]), "path_key", "crc32", "size", "bad_size")
    assert got == [("a.raw", "000000AB", 5, False), ("b.raw", None, None, True)]


def test_catalog_and_current_documents(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"accession": "A", "units": [{"unit_id": "U", "declared": {"ion_mode": "pos"}, "rows": [{"sample_id": "s", "raw_file": "r", "attributes": {"k": "v"}}]}]}))
    units = files.read_catalog(spark, str(tmp_path / "c.json"))
    assert rows(files.catalog_rows(units), "unit_id", "row_index", "raw_file") == [("U", 0, "r")]
    docs = tmp_path / "docs"
    docs.mkdir()
    for name, n in (("U.json", 1), ("U.r2.json", 2), ("U.r10.json", 10), ("V.json", 5)):
        (docs / name).write_text(json.dumps({"n": n}))
    got = files.read_payloads(spark, str(docs), files.T.StructType([files.T.StructField("n", files.T.IntegerType())]))
    assert rows(got, "unit_file", "n", "revisions") == [("U", 10, 3), ("V", 5, 1)]


def test_key_value_text_is_cut_with_a_marker(spark):
    t = spark.createDataFrame([(1, "MS:A\tone\nMS:A\t two \nXX:B\tno\nSUBJECT_SAMPLE_FACTORS\t-\tS\tk:v | n:a:b\tR=x.raw\nSamples\tS\tT")], "id int, text string")
    lines = files.lines(t, "id")
    assert rows(files.key_values(lines, "id", cut=5), "k", "value") == [("MS:A", "one t [cut; line 1]")]
    assert rows(files.sample_factors(lines, "id"), "name", "value") == [("R", "x.raw"), ("k", "v"), ("n", "a:b")]
    assert rows(files.sample_names(lines, "id"), "sample") == [("S",), ("T",)]


def test_long_candidate_fields(spark, tmp_path):
    p = tmp_path / "c.tsv"
    p.write_text("\t".join([*files.CANDIDATES, "spectrum"]) + "\n" + "\t".join(["1", "a", "2", "K", "True", "0", "9" * 200_000]) + "\n")
    got = files.clean_candidates(files.read_candidates(spark, str(p)))
    assert rows(got) == [("1", "a", 2.0, "K", True, False)]


def test_scan_decodes_marks(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("é\n".encode("utf-16"))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.txt").write_bytes(b"\xef\xbb\xbfok")
    assert rows(files.scan_files(spark, str(tmp_path)), "relative_path", "text") == [("a.txt", "é\n"), ("sub/b.txt", "ok")]


def test_ledger_and_store(spark, tmp_path):
    for name, ddl in records.LEDGER.items():
        spark.createDataFrame([], ddl).write.parquet(str(tmp_path / "ledger" / name))
    counts = records.table_counts(records.read_ledger(spark, str(tmp_path / "ledger")))
    assert counts.count() == 14 and counts.agg(F.sum("n")).first()[0] == 0
    for part in records.STORE:
        (tmp_path / "st" / part / "x").mkdir(parents=True)
    (tmp_path / "st" / "objects" / "x" / "entry.json").write_text('{"object_id": "o1", "state": "ready"}')
    (tmp_path / "st" / "objects" / "x" / "bad.json").write_text('{"object_id": ')
    (tmp_path / "st" / "index" / "x" / "k.json").write_text('{"url_key": "k", "object_id": "o1"}')
    (tmp_path / "st" / "claims" / "x" / "u.json").write_text('{"url_key": "k", "unit_id": "u", "state": "pending"}')
    parts = records.read_store(spark, str(tmp_path / "st"))
    got = parts["objects"].select("object_id", F.col("unreadable").isNotNull().alias("bad")).collect()
    assert sorted((r["bad"], r["object_id"]) for r in got if not r["bad"]) == [(False, "o1")] and sum(r["bad"] for r in got) == 1


def test_append_log_refuses_changed_lines(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "seq bigint, raw_line string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "seq bigint, raw_line string")
    assert records.append_log(old, new, str(tmp_path / "log")) == 1
    assert rows(spark.read.parquet(str(tmp_path / "log"))) == [(3, "c")]
    with pytest.raises(ValueError):
        records.append_log(old, new.where("seq <> 2"), str(tmp_path / "log"))


def test_status_file(spark, tmp_path):
    u = spark.createDataFrame([("u", ["a", "b"], True, None, "x\ty")], "unit_key string, report_terms array<string>, outputs_produced boolean, terminal_reason string, warnings string")
    records.write_status(u, str(tmp_path / "s"), ("unit_key", "report_terms", "outputs_produced", "terminal_reason", "warnings"))
    lines = {line for p in (tmp_path / "s").glob("part-*") for line in p.read_text().splitlines()}
    assert lines == {"unit_key\treport_terms\toutputs_produced\tterminal_reason\twarnings", "u\ta;b\t1\t\tx y"}
