"""Line dedup over content-defined chunks of lines.

A chunk ends after a line where the hash of that line and the one before it falls into one of ``divisor`` classes, so
an inserted or removed line moves only the borders beside it. A chunk of two or more lines that occurs in an earlier
place (a smaller id, or earlier in the same text) is removed; occurrences are found by 64-bit hash and confirmed on
the chunk's bytes. Repeated lines of one-line chunks and at the rims of a passage stay.

With ``whole`` the lines of those chunks go and, where a repeated passage reaches beyond its chunks, the rest of its lines,
too: every two lines that follow each other are compared, so all lines of each run of two or more that occurs in an
earlier place go. Two such chunks of one text that share a line are not an earlier place of each other. Occurrences
are found by 64-bit hash and confirmed by a second one with another seed (128 bits), so that no bytes are moved.

Null texts and rows with a null id pass through unchanged, empty texts have nothing to remove. Rows that repeat both id
and text count as one place and are treated alike. Other columns pass through under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.llm.shared import fresh, let
from cairnsift.session import stored

PLACES = 1 << 31  # chunks of one text are numbered below this, the limit of an array


def spans(text: Column, divisor: int = 2) -> Column:
    """A text as consecutive chunks of whole lines with the number of the line each begins with (from 0)."""
    def ends(lines: Column) -> Column:
        def last(prints: Column) -> Column:
            rolling = lambda i: F.md5(F.concat(F.coalesce(F.get(prints, i - 2), F.lit("")), F.get(prints, i - 1)))
            number = lambda i: F.conv(F.substring(rolling(i), 1, 8), 16, 10).cast("long")
            return F.filter(F.sequence(F.lit(1), F.size(prints)), lambda i: (i == F.size(prints)) | (number(i) % divisor == 0))
        return let(F.transform(lines, F.md5), last)

    def cut(lines: Column) -> Column:
        return let(ends(lines), lambda e: F.transform(e, lambda end, k: let(
            F.coalesce(F.get(e, k - 1), F.lit(0)), lambda start: F.struct(start.alias("start"), F.array_join(F.slice(lines, start + 1, end - start), "\n").alias("chunk")))))

    return let(F.split(text, "\n", -1), cut)


def chunks(text: Column, divisor: int = 2) -> Column:
    """The chunks alone; joined by line breaks they give the text back."""
    return F.transform(spans(text, divisor), lambda x: x["chunk"])


def repeated_chunks(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", divisor: int = 2, lines: bool = False) -> DataFrame:
    """The chunks to remove: ``doc_id``, ``print`` (a hash of the text) and ``ord`` (from 0); with ``lines``, ``ord`` are
    the lines of these chunks."""
    cut = documents.where(F.col(doc_id).isNotNull() & F.col(text).contains("\n")).select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("print"), F.posexplode(spans(F.col(text), divisor)).alias("ord", "x"))
    cut = cut.select("doc_id", "print", "ord", "x.start", "x.chunk").where(F.col("chunk").contains("\n"))
    place = F.col("doc_id").cast("decimal(38,0)") * F.lit(PLACES) + F.col("ord")
    found = cut.select("doc_id", "print", "ord", *(["start"] if lines else []), "chunk", F.xxhash64("chunk").alias("h"), place.cast("decimal(38,0)").alias("place"))
    # Two places or more by hash, counted before the chunks' bytes are moved.
    twice = found.groupBy("h").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last").select("h")
    # Read twice below; what is stored are the repeated chunks only.
    shared = stored(found.join(twice, "h"))
    origin = shared.groupBy("h", "chunk").agg(F.min("place").alias("first"))
    later = shared.join(origin, ["h", "chunk"]).where("place > first")
    if lines:
        last = F.col("start") + F.length("chunk") - F.length(F.replace("chunk", F.lit("\n"), F.lit("")))
        return later.select("doc_id", "print", F.explode(F.sequence("start", last)).alias("ord"))
    return later.select("doc_id", "print", "ord")


def repeated_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines of runs to remove: ``doc_id``, ``print`` (a hash of the text) and ``ord`` (from 0)."""
    def hashes(lines: Column) -> Column:
        pair = lambda x, i: F.concat(x, F.lit("\n"), F.get(lines, i + 1))
        return F.transform(F.slice(lines, 1, F.size(lines) - 1), lambda x, i: F.struct(
            F.xxhash64(pair(x, i)).alias("h"), F.xxhash64(F.lit("second"), pair(x, i)).alias("again")))

    pairs = documents.where(F.col(doc_id).isNotNull() & F.col(text).contains("\n")).select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("print"), F.posexplode(let(F.split(text, "\n", -1), hashes)).alias("ord", "x"))
    found = pairs.select("doc_id", "print", "ord", "x.h", "x.again")
    place = (F.col("doc_id").cast("decimal(38,0)") * F.lit(PLACES) + F.col("ord")).cast("decimal(38,0)")
    twice = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    shared = stored(found.join(twice, "h").withColumn("place", place))
    origin = shared.groupBy("h", "again").agg(F.min("place").alias("first"))
    later = shared.join(origin, ["h", "again"]).where("place > first + 1")
    return later.select("doc_id", "print", F.explode(F.array(F.col("ord"), F.col("ord") + 1)).alias("ord"))


def remove(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", divisor: int = 2, whole: bool = False) -> DataFrame:
    """The documents with repeated chunks taken out of ``text``, and two more columns: ``n_chunks`` and ``n_removed``
    (of lines, with ``whole``)."""
    parts = F.split(F.col(text), "\n", -1) if whole else chunks(F.col(text), divisor)
    gone, key, print_, n_chunks, n_removed = fresh(documents, "_gone", "_id", "_print", "n_chunks", "n_removed")
    found = repeated_chunks(documents, doc_id, text, divisor, lines=whole)
    if whole:
        found = found.select("doc_id", "print", F.col("ord").cast("int").alias("ord")).unionByName(repeated_lines(documents, doc_id, text))
    lists = found.groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("ord")).alias(gone))
    lists = lists.select(F.col("doc_id").alias(key), F.col("print").alias(print_), gone)
    joined = documents.join(lists, (F.col(doc_id) == F.col(key)) & (F.xxhash64(text) == F.col(print_)), "left")

    def rest(c: Column) -> Column:
        """What lies between the removed chunks, as slices."""
        def between(k: Column) -> Column:
            start = F.coalesce(F.get(gone, k - 1) + 1, F.lit(0))
            end = F.coalesce(F.get(gone, k), F.size(c))
            return F.slice(c, start + 1, end - start)
        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), between)), "\n")

    new = F.when(F.col(gone).isNull(), F.col(text)).otherwise(let(parts, rest))
    counted = joined.withColumn(n_chunks, F.coalesce(F.size(parts), F.lit(0))).withColumn(
        n_removed, F.coalesce(F.size(gone), F.lit(0))).withColumn(text, new)
    return counted.drop(gone, key, print_)
