"""Files of any size and encoding as rows, with exact byte offsets and line numbers.

A file is read as the lines that its splits hold, so a file of any size is many tasks' work. Bytes become characters one
to one (ISO 8859-1): nothing fails to decode, and a position in ``text`` is a byte position. Rows carry the split they
come from and their order in it; offsets and line numbers are prefix sums over blocks of 1,024 rows, so that no window
ever spans more than one block's rows or one split's blocks.

UTF-16 files (by their byte-order mark) are decoded with replacement and stand here as their UTF-8 bytes; they, and files
whose name tells Spark to unpack them, are read whole, up to the 2 GB that one Spark value holds, as is a single line.
Names that begin with ``_`` or ``.`` are not listed by Spark's file index and therefore not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cairnsift import scale

ROWS = 10  # a block holds 2 ** ROWS rows
# Endings that Spark's text reader unpacks, and the two byte-order marks as characters.
PACKED = r"(?i)\.(gz|bz2|deflate|lz4|snappy|zst|zstd)$"
MARKS = ("\xff\xfe", "\xfe\xff")
LATIN = "ISO-8859-1"
LINE = ("relative_path", "offset", "line_no", "text")


def below(path: Column, root: str) -> Column:
    """A file's path below the root."""
    bare = F.regexp_replace(path, r"^[a-z]+:/*", "/")
    base = "/" + root.split(":", 1)[-1].strip("/") + "/"
    return F.when(F.startswith(bare, F.lit(base)), F.substr(bare, F.lit(len(base) + 1))).otherwise(F.ltrim(bare, F.lit("/")))


def utf16_text(content: Column) -> Column:
    """UTF-16 bytes with their mark as text; a lone surrogate and an odd last byte become U+FFFD."""
    pairs = F.hex(F.substr(content, F.lit(3)))
    units = F.regexp_extract_all(F.when(F.hex(F.substring(content, 1, 2)) == "FFFE", F.regexp_replace(pairs, "(..)(..)", "$2$1")).otherwise(pairs), F.lit("(....)"), F.lit(1))
    high = lambda u: u.rlike("^D[89AB]")
    low = lambda u: u.rlike("^D[C-F]")

    def repaired(u: Column) -> Column:
        lone = lambda x, i: (high(x) & ~F.coalesce(low(F.get(u, i + 1)), F.lit(False))) | (low(x) & ~F.coalesce(high(F.get(u, i - 1)), F.lit(False)))
        return F.array_join(F.transform(u, lambda x, i: F.when(lone(x, i), "FFFD").otherwise(x)), "")

    text = F.decode(F.unhex(F.transform(F.array(units), repaired)[0]), "UTF-16BE")
    return F.concat(text, F.when(F.length(content) % 2 == 1, F.lit("�")).otherwise(""))


def decoded(content: Column) -> Column:
    """Bytes as text whatever they are: UTF-16 by its mark, else UTF-8 without its mark, with U+FFFD for what is neither."""
    head = F.hex(F.substring(content, 1, 2))
    text = F.when(head.isin("FFFE", "FEFF"), utf16_text(content)).otherwise(F.make_valid_utf8(content.cast("string")))
    return F.regexp_replace(text, "^﻿", "")


def _relative(root: str) -> Column:
    return below(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), root)


def _whole(spark: SparkSession, root: str, which: Column) -> DataFrame:
    """Files as one row each; ``which`` reads ``_metadata.file_path`` alone, so other files are left out of the listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).where(which)
    return files.select(_relative(root).alias("relative_path"), "content")


def _rows(spark: SparkSession, root: str) -> DataFrame:
    """All lines of all files that are not unpacked, as bytes. The order number rises within a split."""
    raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(root)
    return raw.select(_relative(root).alias("relative_path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("split"),
                      F.monotonically_increasing_id().alias("seq"), F.decode(F.col("value").cast("binary"), LATIN).alias("text"))


def raw_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines of all files below ``root``: ``relative_path``, ``size``, ``split``, ``seq``, ``text``. An empty file has none."""
    rows = _rows(spark, root).where(~F.col("relative_path").rlike(PACKED))
    marked = rows.where((F.col("split") == 0) & F.substring("text", 1, 2).isin(*MARKS)).groupBy("relative_path").agg(F.min("seq").alias("seq"))
    # Only a file's first line can carry the mark; the least order number of split 0 is that line's.
    first = rows.where("split = 0").groupBy("relative_path").agg(F.min("seq").alias("seq"))
    # The driver lists all names anyway; those of marked files are some of them.
    wide_names = [r[0] for r in marked.join(first, ["relative_path", "seq"], "left_semi").select("relative_path").collect()]
    kept = rows.where(~F.col("relative_path").isin(wide_names))
    # Spark reads a whole file before a filter on its path: only the files that are needed whole may be listed here.
    packed = _whole(spark, root, F.col("_metadata.file_path").rlike(PACKED)).select("relative_path", "content")
    wide = _whole(spark, root, _relative(root).isin(wide_names)).select("relative_path", F.encode(utf16_text(F.col("content")), "UTF-8").alias("content"))
    texts = packed.union(wide).where(F.length("content") > 0)
    # A break at the end closes the last line and begins none.
    body = F.regexp_replace(F.decode("content", LATIN), r"\n\z", "")
    split = texts.select("relative_path", F.length("content").cast("bigint").alias("size"), F.posexplode(F.split(body, "\n", -1)).alias("seq", "text"))
    return kept.unionByName(split.select("relative_path", "size", F.lit(0).cast("bigint").alias("split"), F.col("seq").cast("bigint").alias("seq"), "text"))


def block(seq: Column | str = "seq") -> Column:
    return F.shiftright(F.col(seq) if isinstance(seq, str) else seq, ROWS)


def block_starts(raw: DataFrame) -> DataFrame:
    """Where each block of rows begins: ``relative_path``, ``split``, ``block``, ``start`` (bytes) and ``lines`` before it.

    The reader takes a UTF-8 mark away; it shows in the file's size, since every line takes its bytes and one break."""
    cells = raw.groupBy("relative_path", "split", block().alias("block")).agg(
        F.sum(F.length("text") + 1).alias("bytes"), F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
    run = scale.ordered(cells, ["relative_path"], ["split", "block"], F.col("split"), prior_sum={"before": "bytes", "lines": "rows"})
    total = cells.groupBy("relative_path").agg(F.sum("bytes").alias("total"), F.max("size").alias("size"))
    skipped = total.select(F.col("relative_path").alias("_file"), F.when(F.col("total") < F.col("size") - 1, 3).otherwise(0).alias("mark"))
    return run.join(skipped, F.col("relative_path") == F.col("_file")).select(
        "relative_path", "split", "block", (F.col("before") + F.col("mark")).cast("bigint").alias("start"), F.col("lines").cast("bigint").alias("lines"))


def placed(raw: DataFrame, starts: DataFrame) -> DataFrame:
    """Lines with their byte offset and number (from 1); ``raw`` may lack whole blocks, but no row of a block it has."""
    own = Window.partitionBy("relative_path", "split", "block").orderBy("seq")
    before = F.coalesce(F.sum(F.length("text") + 1).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = raw.withColumn("block", block()).select("relative_path", "split", "block", "seq", "text", before.alias("_before"), F.row_number().over(own).alias("_n"))
    return rows.join(starts, ["relative_path", "split", "block"]).select(
        "relative_path", (F.col("start") + F.col("_before")).cast("bigint").alias("offset"), (F.col("lines") + F.col("_n")).cast("bigint").alias("line_no"), "text", "split", "block", "seq")


def file_lines(spark: SparkSession, root: str) -> DataFrame:
    """All lines below ``root``: ``relative_path``, ``offset``, ``line_no``, ``text`` (one character per byte)."""
    raw = raw_lines(spark, root)
    return placed(raw, block_starts(raw)).select(*LINE)


def readable(text: Column | str) -> Column:
    """Characters that stand for bytes as UTF-8 text, with U+FFFD for what is none."""
    return F.make_valid_utf8(F.encode(F.col(text) if isinstance(text, str) else text, LATIN).cast("string"))


def pieces(text: Column, size: int, around: int) -> Column:
    """A line as pieces ``(at, text)`` of ``size`` characters and ``around`` more on both sides; ``at`` is where the
    piece's own text begins, 0 for the first, which has nothing before it."""
    whole = F.array(F.struct(F.lit(0).alias("at"), text.alias("text")))
    cut = F.transform(F.sequence(F.lit(0), F.length(text) - 1, F.lit(size)), lambda at: F.struct(
        at.alias("at"), F.substr(text, F.greatest(at - around, F.lit(0)) + 1, F.least(at, F.lit(around)) + size + around).alias("text")))
    return F.when(F.length(text) <= size, whole).otherwise(cut)


def json_lines(lines: DataFrame) -> DataFrame:
    """Entries of JSONL files: blank lines are skipped and the rest numbered anew, an unreadable line keeps a null entry.

    ``lines`` as ``file_lines`` gives them. Numbers are prefix sums over blocks of line numbers."""
    kept = lines.select("relative_path", F.col("line_no").alias("_no"), readable("text").alias("raw_line")).where(F.trim("raw_line", F.lit(" \t\r\n")) != "")
    entry = F.from_json("raw_line", "map<string,string>")
    ok = F.get_json_object("raw_line", "$").startswith("{")
    numbered = scale.ordered(kept, ["relative_path"], ["_no"], scale.blocks("_no", 1 << ROWS), row_number="line_no")
    return numbered.select("relative_path", F.col("line_no").cast("bigint").alias("line_no"), "raw_line", F.when(ok, entry).alias("entry"))
