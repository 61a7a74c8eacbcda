"""Files of any size and encoding: offsets, line numbers and findings equal a plain scan."""

import gzip
import random

import pytest

from cairnsift.operators import release
from cairnsift.sources import blocks, files
from tests.util import rows


def noise(n, seed=1):
    rng = random.Random(seed)
    return b"".join(bytes(rng.choice(b"abcdefgh \n") for _ in range(997)) + b"\xff\xfe\x00" for _ in range(n // 1000))


FILES = {
    "big.txt": noise(300_000) + b" \\\\host\\share x C:/w\n" + noise(200_000, 2) + b"\n\\\\h2\\s2 /ref/lib.msp",
    "transcripts/a b+c/t.jsonl": b"\xef\xbb\xbfline one\nContents of /x/AGENTS.md\nme@example.com",
    "start.bin": b"\\\\host\\share",
    "bad16.txt": b"\xff\xfe\x00\xd8" + "é\nC:/x\n".encode("utf-16-le") + b"a",
    "big16.txt": "D:/y 😀\n".encode("utf-16"),
    "empty": b"",
    "breaks": b"\n\n\n",
    "one.txt": b"x" * 150_000 + b" D:\\y " + b"z" * 150_000,
    "url.txt": b"q" * 99_990 + b" https://h/" + b"a/" * 1500 + b"x.msp " + b"b" * 5000 + b" /y.msp",
    "packed.gz": gzip.compress(b"C:/inside\n" * 3),
    "latin.txt": "Käse <library:é.msp sha256=".encode("latin-1") + b"0" * 64 + b">",
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The files, read in small splits."""
    root = tmp_path_factory.mktemp("files")
    for name, data in FILES.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield str(root)
    for k, v in before.items():
        spark.conf.set(k, v)


def plain(data):
    """A file's bytes as the reader gives them: UTF-16 as UTF-8."""
    return data.decode("utf-16", "replace").encode() if data[:2] in (b"\xff\xfe", b"\xfe\xff") else data


def test_lines_have_their_offsets(spark, folder):
    got = {}
    for r in blocks.file_lines(spark, folder).collect():
        got.setdefault(r.relative_path, []).append((r.offset, r.line_no, r.text.encode("latin-1")))
    for name, data in FILES.items():
        data, want, at = plain(data), [], 3 if data[:3] == b"\xef\xbb\xbf" else 0
        body = data[at:-1] if data.endswith(b"\n") else data[at:]
        for i, line in enumerate(body.split(b"\n") if data else []):
            want.append((at, i + 1, line))
            at += len(line) + 1
        assert sorted(got.get(name, [])) == want, name


@pytest.mark.parametrize("piece", [20_000, 1 << 20])
def test_findings_are_told_once_at_their_byte(spark, folder, piece):
    rules = release.redaction_rules(context=[r"Contents of [^\r\n]{0,400}?AGENTS\.md"])
    found = {(r.file, r.rule): (r.at, r.line) for r in release.redaction_scan(blocks.raw_lines(spark, folder), rules, piece).collect()}
    starts = {("bad16.txt", "drive_letter_path"): b"C:/x", ("big16.txt", "drive_letter_path"): b"D:/y", ("big.txt", "drive_letter_path"): b"C:/w", ("big.txt", "library_path"): b"/lib.msp",
              ("big.txt", "unc_path"): b" \\\\host", ("one.txt", "drive_letter_path"): b"D:\\y", ("start.bin", "unc_path"): b"\\\\host", ("transcripts/a b+c/t.jsonl", "context_block"): b"Contents",
              ("transcripts/a b+c/t.jsonl", "email_address"): b"me@", ("url.txt", "library_path"): b"/y.msp"}
    want = {}
    for (name, rule), text in starts.items():
        data = plain(FILES[name])
        at = data.index(text)
        want[name, rule] = (at, data[:at].count(b"\n") + 1)
    assert found == want


def test_a_match_at_a_line_break_belongs_to_it(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"one\n\\\\host\\share")
    assert rows(release.redaction_scan(blocks.raw_lines(spark, str(tmp_path)), release.redaction_rules())) == [("a", "unc_path", 3, 1)]


def test_json_lines_across_blocks(spark, tmp_path):
    lines = [f'{{"seq": {i}}}' if i % 3 else ("" if i % 2 else "broken") for i in range(5000)]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    got = sorted((r.line_no, r.raw_line, (r.entry or {}).get("seq")) for r in blocks.json_lines(blocks.file_lines(spark, str(tmp_path))).collect())
    kept = [x for x in lines if x]
    assert got == [(i + 1, x, x[8:-1] if x.startswith("{") else None) for i, x in enumerate(kept)]


def test_whole_files_survive_any_byte(spark, folder):
    got = {r.relative_path: r.text for r in files.scan_files(spark, folder).collect()}
    assert got["bad16.txt"] == FILES["bad16.txt"].decode("utf-16", "replace") and got["big16.txt"] == "D:/y 😀\n"
    assert got["latin.txt"].startswith("K�se") and got["transcripts/a b+c/t.jsonl"].startswith("line one")
    assert rows(release.library_names_in(blocks.raw_lines(spark, folder))) == [("é.msp",)]


def test_plain_files_are_never_read_whole(spark, tmp_path):
    (tmp_path / "long.txt").write_text("line\n" * 1000)
    (tmp_path / "wide.txt").write_bytes("x\ny".encode("utf-16"))
    (tmp_path / "p.gz").write_bytes(gzip.compress(b"q\n"))
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "1000")
    try:
        found = blocks.file_lines(spark, str(tmp_path)).groupBy("relative_path").count()
        assert rows(found) == [("long.txt", 1000), ("p.gz", 1), ("wide.txt", 2)]
    finally:
        spark.conf.unset(limit)
