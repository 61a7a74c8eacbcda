"""A sample of the registered queries against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from cairnsift.queries.registry import TABLES

ROOT = "/root/testdata/sf0.001"
SAMPLE = ("s2_listing_index", "f12_token_acquisition", "j1_resolve", "j5_belongs_to_other", "a15_content_groups", "t_status", "p3_exclusion_reasons", "a22_download_groups",
          "w6_retry_schedule", "j18_lineage", "a6_concordance", "r1_apply_groups", "i6_w12_order_agreement", "store_objects", "e1_accession_verdict", "c0_check_grid", "t_dup", "d1_file_scan", "d_triage", "s16_canonical_writer", "x_references",
          "store_changed_members", "g3_stale_holder_stream", "t_tools_transcript")

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no driver tables here")


def value(x):
    return round(x, 6) if isinstance(x, float) else tuple(value(v) for v in x) if isinstance(x, list) else x


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{ROOT}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, ROOT)
    columns = sorted(frame.columns)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got = sorted((tuple(value(r[c]) for c in columns) for r in frame.collect()), key=key)
    rel = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    want = sorted((tuple(value(r[names.index(c)]) for c in columns) for r in rel.fetchall()), key=key)
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).columns == ["accession", "unit_id", "verdict", "errors", "holds"]


def test_every_query_names_are_unique_and_mostly_checked():
    assert set(entry.oracle_sql()) <= set(entry.queries())
