"""Substring dedup by recompression: words that lie in a long passage which an earlier document has, too.

Rounds of recompression rewrite each text. In a round every adjacent pair of symbols whose coins (hash bits of their
names) fall left-right gets a name of its own, then every run of one symbol gets one. A name is a hash of what it
stands for, so it is the same in all documents without a dictionary to be shuffled. A symbol also carries its context,
the span of words that fixes how it was formed. A symbol whose context lies inside a passage is an interior symbol: it
appears wherever the passage does.

Each window of ``window`` words is named by that of its interior symbols, of all rounds, whose hash is the largest; the
hash covers the symbol and the words of its context, ``SPAN`` at least. A word is its own interior symbol, so each window
has one. Consecutive windows with one name, five on average, are a unit. Then:

1. Spark counts each name's documents. Names of one document are done, which is nearly all text that is not repeated.
2. For shared names the units are compared by a second hash over all their words. A unit that an earlier document has is
   repeated as a whole.
3. First occurrences of units whose name has other units are compared window by window.

All three steps are aggregates with partial sums and joins that can be split, so a passage that a third of all documents
have does no harm. Names of 48 bits and unit or window prints of 64 bits, from different letter values, must agree
together. Texts cross the network compressed. A unit's row is laid out so that what compresses lies together: the cleared
low bits of its name, and its first window and their number in one value.

``doc_id`` orders documents; rows that share an id are one document, never earlier than each other. Where their texts
differ, each keeps its own places: places go by the id and a hash of the text. Null and empty texts have no words; a row with a null id keeps all words. Words are what white space parts, unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from cairnsift.llm.text_arrays import BASES, mixed, powers, prints, signed, slices, split, U64, Words
from cairnsift.session import stored

ROUNDS = 2
SPAN = 5  # a name covers at least so many words, so that few names are shared by chance
NAME_BITS = U64(0xFFFFFFFFFFFF0000)  # what of a name is shuffled


def interior(words: np.ndarray, doc: np.ndarray, window: int, rounds: int = ROUNDS) -> np.ndarray:
    """The name of the window that begins at each word (its words may run into the next text; see ``units``)."""
    n = len(words)
    best = [np.zeros(n, U64) for _ in range(window + 1)]

    spans, least = Spans(words), min(SPAN, window)

    def offer(level: int, name: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        high = np.maximum(high, low + least)
        at = np.flatnonzero((low >= 0) & (high <= n) & (high - low <= window))
        low, size = low[at], (high - low)[at]
        rank = mixed(name[at] ^ U64(level) ^ spans.of(low, size), 77)
        for k in range(least, window + 1):
            at = np.flatnonzero(size == k)
            if len(at):
                np.maximum.at(best[k], low[at], rank[at])

    name, low, high, owner = words, np.arange(n), np.arange(1, n + 1), doc
    offer(1, name, low, high)
    for turn in range(rounds):
        # Pairs: a left coin before a right one, in one text.
        coin = (mixed(name, 200 + turn) >> U64(63)).astype(bool)
        pair = np.zeros(len(name), bool)
        pair[:-1] = ~coin[:-1] & coin[1:] & (owner[:-1] == owner[1:])
        second = np.zeros(len(name), bool)
        second[1:] = pair[:-1]
        # A symbol left alone shows that its partner has the same coin: a left one depends on the next symbol.
        alone = ~pair & ~second
        wide_low, wide_high = low.copy(), high.copy()
        left = np.flatnonzero(alone & ~coin)
        wide_high[left] = np.maximum(high[left], np.append(high, n + window)[left + 1])
        right = np.flatnonzero(alone & coin)
        wide_low[right] = np.minimum(low[right], np.append(low, -window)[right - 1])
        at = np.flatnonzero(pair)
        joined = name.copy()
        with np.errstate(over="ignore"):
            joined[at] = mixed(name[at] * U64(0x2545F4914F6CDD1D) + name[at + 1], 300 + turn)
        wide_low[at] = np.minimum(low[at], low[at + 1])
        wide_high[at] = np.maximum(high[at], high[at + 1])
        offer(2 * turn + 2, joined[at], wide_low[at], wide_high[at])
        keep = ~second
        name, low, high, owner = joined[keep], wide_low[keep], wide_high[keep], owner[keep]

        # Runs: every symbol depends on both neighbours, which end its run.
        head = np.ones(len(name), bool)
        head[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(head)
        last = np.append(first[1:], len(name)) - 1
        run_low = np.minimum.reduce([low[first], np.append(low, -window)[first - 1]])
        run_high = np.maximum.reduce([high[last], np.append(high, n + window)[last + 1]])
        length = (last - first + 1).astype(U64)
        named = np.where(length > 1, mixed(name[first] ^ mixed(length, 400), 400 + turn), name[first])
        name, low, high, owner = named, run_low, run_high, owner[first]
        at = np.flatnonzero(length > 1)
        offer(2 * turn + 3, name[at], low[at], high[at])
    # The best context inside each window, by growing spans.
    top = best[1]
    for k in range(2, window + 1):
        wider = np.maximum(top, np.append(top[1:], U64(0)))
        top = np.maximum(best[k], wider)
    return top


def passages(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The units of all texts: text number, first window (word index), number of windows, name."""
    n = len(w.starts)
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    begins = np.arange(n)
    valid = begins + window <= w.first[doc + 1] if n else np.zeros(0, bool)
    name = interior(prints(w), doc, window) if n else np.zeros(0, U64)
    head = valid.copy()
    head[1:] &= (name[1:] != name[:-1]) | (doc[1:] != doc[:-1]) | ~valid[:-1]
    first = np.flatnonzero(head)
    total = np.concatenate([[0], np.cumsum(valid)])
    stop = np.append(first[1:], n)
    return doc[first], first, total[stop] - total[first], name[first]


class Spans:
    """Prints of any span of words, by a second hash."""

    def __init__(self, p: np.ndarray):
        size = 1 << max(12, len(p).bit_length())
        with np.errstate(over="ignore"):
            self.total = np.concatenate([np.zeros(1, U64), np.cumsum(p * powers(BASES[0], size)[: len(p)], dtype=U64)])
        self.down = powers(pow(BASES[0], -1, 1 << 64), size * 2)

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.total[start + length] - self.total[start]) * self.down[start], 9)


def keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("copy"), F.col(text).alias("text"))


def packed(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``copy`` and ``text`` with each text compressed, to be shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=6)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([None if t is None else small.compress(t) for t in texts_of(batch.column(2))], pa.binary())], ["doc_id", "copy", "text"])
    return rows.mapInArrow(run, "doc_id bigint, copy bigint, text binary")


def texts_of(column: pa.Array) -> list[bytes | None]:
    """Texts as bytes, from a column of texts or of compressed ones."""
    if pa.types.is_binary(column.type):
        big = zstandard.ZstdDecompressor()
        return [None if x is None else big.decompress(x) for x in column.to_pylist()]
    return [None if x is None else x.encode("utf-8", "surrogatepass") for x in column.to_pylist()]


def encoded(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in texts_of(column)]


def named_units(rows: DataFrame, window: int) -> DataFrame:
    """The units of each text: ``name``, ``copy``, ``doc_id`` and ``place``, the first window's number plus 2^32 times the
    number of windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = split(encoded(batch.column(2)))
            doc, first, n, name = passages(w, window)
            ids, copies = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            place = (first - w.first[doc]).astype(np.int64) + (n.astype(np.int64) << 32)
            yield pa.RecordBatch.from_arrays([pa.array(signed(name & NAME_BITS)), pa.array(copies[doc]), pa.array(ids[doc]), pa.array(place)], ["name", "copy", "doc_id", "place"])

    return rows.mapInArrow(run, "name bigint, copy bigint, doc_id bigint, place bigint")


def repeated(documents: DataFrame, window: int, doc_id: str, text: str) -> DataFrame:
    """Where repeated windows begin: ``doc_id``, ``copy`` (a hash of the text), ``start`` (word number from 0) and ``n``
    (how many follow each other)."""
    rows = keyed(documents.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()), doc_id, text)
    found = named_units(rows, window)
    shared = found.groupBy("name").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("name")
    places = found.join(shared, "name").groupBy("doc_id", "copy").agg(F.collect_list(F.struct("name", "place")).alias("units"))

    def print_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = split(encoded(batch.column(2)))
            spans = Spans(prints(w, 1))
            lists = batch.column(3)
            owner = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
            unit = lists.flatten()
            name, place = (unit.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            start, n = (place & 0xFFFFFFFF).astype(np.int32), (place >> 32).astype(np.int32)
            at = w.first[owner] + start
            whole = spans.of(at, n + window - 1)
            inner = np.repeat(at - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else at, n) + np.arange(n.sum())
            ids, copies = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            each = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(signed(spans.of(inner, window))))
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(signed(whole)), pa.array(ids[owner]), pa.array(copies[owner]), pa.array(start), pa.array(n), each],
                                             ["name", "print", "doc_id", "copy", "start", "n", "windows"])

    told = packed(rows).join(places, ["doc_id", "copy"]).select("doc_id", "copy", "text", "units")
    units = stored(told.mapInArrow(print_units, "name bigint, print bigint, doc_id bigint, copy bigint, start int, n int, windows array<bigint>"))
    origin = stored(units.groupBy("name", "print").agg(F.min("doc_id").alias("first")))
    varied = origin.groupBy("name").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low < high").select("name")
    whole = units.select("name", "print", "doc_id", "copy", "start", "n").join(origin, ["name", "print"]).where("first < doc_id").select("doc_id", "copy", "start", "n")

    leading = units.join(origin, ["name", "print"]).where("first = doc_id").join(varied, "name", "left_semi")
    window_rows = stored(leading.select("name", "doc_id", "copy", "start", F.posexplode("windows").alias("k", "window")).select("name", "doc_id", "copy", (F.col("start") + F.col("k")).alias("start"), "window"))
    earliest = window_rows.groupBy("name", "window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("name", "window", "first")
    single = window_rows.join(earliest, ["name", "window"]).where("first < doc_id").select("doc_id", "copy", "start", F.lit(1).alias("n"))
    return whole.union(single)


def remove(documents: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """By row of ``documents``: ``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by one blank) and
    ``kept_sha256``."""
    spans = repeated(documents, window, doc_id, text).groupBy("doc_id", "copy").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    rows = keyed(documents, doc_id, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            total, gone, kept = [], [], []
            for t, lists in zip(encoded(batch.column(2)), batch.column(3)):
                words = t.split()
                if lists.is_valid:
                    start, n = (lists.values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, start, 1)
                    np.add.at(depth, start + n + window - 1, -1)
                    stay = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
                    rest = [words[i] for i in stay]
                else:
                    rest = words
                total.append(len(words))
                gone.append(len(words) - len(rest))
                kept.append(b" ".join(rest))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])

    return packed(rows).join(spans, ["doc_id", "copy"], "left").select("doc_id", "copy", "text", "spans").mapInArrow(
        cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string")
