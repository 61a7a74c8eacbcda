"""Benchmark decontamination: q-gram counts in diagonal bands, then banded alignment.

Texts are compared as lower-case letters and digits with single blanks between words. A benchmark item is read as
probes of at most ``PROBE`` characters, one every ``STRIDE``, so that each part of an item of ``PROBE + STRIDE - 1``
characters holds a whole probe, wherever it begins. A probe of ``m`` characters lies in a text if a region of it aligns
with at most ``m // EDITS`` edits. Such a region shares at least ``m - q + 1 - q * edits`` q-grams with the probe, on
neighbouring diagonals (text position less item position): an item's q-grams are listed once, hits are counted in
overlapping bands of diagonals and there by probe, probes below that bound are dropped without loss, and the rest is
verified by an alignment in the band.

The benchmark is the stated query set: it is read in blocks of a bounded number of characters, and each block is held
against all texts. A block's index is the only thing that is broadcast, and its size does not grow with either table.

Null texts and texts or items that are too short for a probe (``SHORTEST`` characters) have no leak. Rows are judged
one by one: repeated rows, repeated ids and ties need no care, and other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cairnsift.llm.text_arrays import mixed, slices, U64

Q = 10
PROBE = 120
STRIDE = 8
EDITS = 15
SHORTEST = 20  # from here on, the bound leaves a q-gram to find an item by
BAND = 16
BLOCK_CHARS = 2_000_000
SLICE_CHARS = 200_000
LETTERS = mixed(np.arange(4096, dtype=U64))
STEP = U64(0x2545F4914F6CDD1D)

_LETTER = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def plain(text: str) -> np.ndarray:
    """The characters that count, as code points."""
    kept = b" ".join(text.lower().encode("utf-8", "ignore").translate(_LETTER).split()).decode("utf-8")
    return np.frombuffer(kept.encode("utf-32-le"), np.uint32)


def grams(chars: np.ndarray) -> np.ndarray:
    """A 64-bit print of the Q = 8 + 2 characters from each place on, a polynomial built by doubling."""
    n = len(chars) - Q + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        one = mixed_letters(chars)
        two = one[:-1] * STEP + one[1:]
        four = two[:-2] * STEP**2 + two[2:]
        eight = four[:-4] * STEP**4 + four[4:]
        return (eight[:n] * STEP**2 + two[8: 8 + n]) * U64(0x9E3779B97F4A7C15)


def mixed_letters(chars: np.ndarray) -> np.ndarray:
    """A random value for each character; characters past the table, rare ones, are mixed one by one."""
    low = LETTERS[np.minimum(chars, len(LETTERS) - 1)]
    rare = np.flatnonzero(chars >= len(LETTERS) - 1)
    if len(rare):
        low[rare] = mixed(chars[rare].astype(U64))
    return low


@dataclass
class Index:
    items: list[tuple[int, np.ndarray]]  # item id, characters
    known: np.ndarray  # sorted distinct q-grams
    first: np.ndarray  # where each one's postings begin
    item: np.ndarray
    place: np.ndarray
    sieve: np.ndarray
    shift: int

    @property
    def probes(self) -> list[tuple[int, np.ndarray]]:
        return [(item, chars[s: s + PROBE]) for item, chars in self.items for s in probe_starts(len(chars))]


def probe_starts(n: int) -> np.ndarray:
    last = max(0, n - PROBE)
    return np.append(np.arange(0, last, STRIDE), last)


def least(m: int) -> int:
    """The q-grams that a region must share with a probe of ``m`` characters."""
    return m - Q + 1 - Q * (m // EDITS)


def build(rows: list[tuple[int, str]]) -> Index:
    items = [(item, chars) for item, text in rows if len(chars := plain(text)) >= SHORTEST]
    all_grams = [grams(chars) for _, chars in items]
    flat = np.concatenate(all_grams) if all_grams else np.zeros(0, U64)
    item = np.repeat(np.arange(len(items)), [len(g) for g in all_grams])
    place = np.concatenate([np.arange(len(g)) for g in all_grams]) if all_grams else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    known, first = np.unique(flat[order], return_index=True)
    shift = 64 - max(16, (16 * max(1, len(known))).bit_length())
    sieve = np.zeros(1 << (64 - shift), bool)
    sieve[known >> U64(shift)] = True
    return Index(items, known, np.append(first, len(flat)), item[order], place[order], sieve, shift)


def align(probe: np.ndarray, chars: np.ndarray, start: int, width: int) -> tuple[int, int]:
    """Fewest edits of the probe against a part of ``chars`` whose diagonals lie in ``start .. start + width``, and
    where that part ends."""
    far = len(probe) + 1
    column = np.arange(width)
    best = np.zeros(width, np.int64)
    padded = np.zeros(len(probe) + width, np.int64)
    low, high = max(0, start), min(len(chars), start + len(probe) + width)
    if high > low:
        padded[low - start: high - start] = chars[low:high]
    outside = (np.arange(len(padded)) + start < -1) | (np.arange(len(padded)) + start > len(chars))
    best[outside[:width]] = far
    for i, c in enumerate(probe):
        step = np.minimum(best + (padded[i: i + width] != c), np.append(best[1:], far) + 1)
        best = np.minimum.accumulate(step - column) + column
    at = int(np.argmin(best))
    return int(best[at]), start + at + len(probe)


def same(probe: np.ndarray, chars: np.ndarray, start: int, width: int) -> tuple[int, int] | None:
    """What ``align`` gives where the band holds the probe itself."""
    part, at = chars[max(0, start): start + len(probe) + width].tobytes(), -1
    while (at := part.find(probe.tobytes(), at + 1)) >= 0:
        if at % 4 == 0:
            return 0, max(0, start) + at // 4 + len(probe)
    return None


def search(texts: list[str | None], index: Index) -> list[dict[int, tuple[int, int, int]]]:
    """By text: item id -> (edits, first and last character of the best region)."""
    out: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
    if not len(index.known):
        return out
    held: list[tuple[int, np.ndarray]] = []
    size = 0
    for i, text in enumerate(texts):
        chars = plain(text) if text else np.zeros(0, np.uint32)
        if len(chars) >= Q:
            held.append((i, chars))
            size += len(chars) + Q
        if size >= SLICE_CHARS:
            search_slice(held, index, out)
            held, size = [], 0
    if held:
        search_slice(held, index, out)
    return out


def search_slice(held: list[tuple[int, np.ndarray]], index: Index, out: list[dict[int, tuple[int, int, int]]]) -> None:
    gap = np.zeros(Q, np.uint32)
    line = np.concatenate([x for _, c in held for x in (c, gap)])
    begin = np.cumsum([0] + [len(c) + Q for _, c in held])
    g = grams(line)
    at = np.flatnonzero(index.sieve[g >> U64(index.shift)])
    found = np.searchsorted(index.known, g[at])
    found[found == len(index.known)] = 0
    ok = index.known[found] == g[at]
    at, found = at[ok], found[ok]
    if not len(at):
        return
    count = index.first[found + 1] - index.first[found]
    post = np.repeat(index.first[found] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    item, place, at = index.item[post], index.place[post], np.repeat(at, count)
    longest = max(len(chars) for _, chars in index.items)
    # Diagonals from BAND on, so that the band before the first is still the item's own.
    band = (at - place + longest + BAND) // BAND
    # Each hit counts in the band that begins at its cell and in the one before, so bands overlap by half.
    cells = (len(line) + longest) // BAND + 2
    key = np.unique(np.concatenate([item * cells + band, item * cells + band - 1]) * longest + np.tile(place, 2))
    cell, head = np.unique(key // longest, return_index=True)
    tail = np.append(head[1:], len(key))
    bound = np.array([least(min(len(chars), PROBE)) for _, chars in index.items])
    for c in np.flatnonzero(tail - head >= bound[cell // cells]):
        name, whole = index.items[cell[c] // cells]
        m = min(len(whole), PROBE)
        edits, starts, places = m // EDITS, probe_starts(len(whole)), key[head[c]: tail[c]] % longest
        shared = np.searchsorted(places, starts + m - Q + 1) - np.searchsorted(places, starts)
        for s in starts[shared >= least(m)]:
            chars = whole[s: s + PROBE]
            start = int(cell[c] % cells) * BAND - longest - BAND + int(s)
            # A band may touch two texts; each is aligned for itself.
            first = max(0, int(np.searchsorted(begin, max(0, start), "right")) - 1)
            last = max(0, int(np.searchsorted(begin, start + 2 * BAND + m, "left")) - 1)
            for k in range(first, min(last, len(held) - 1) + 1):
                i, text = held[k]
                if out[i].get(name, (1,))[0] == 0:
                    continue
                low = start - int(begin[k]) - edits
                cost, end = same(chars, text, low, 2 * BAND + 2 * edits) or align(chars, text, low, 2 * BAND + 2 * edits)
                if cost <= edits and (name not in out[i] or cost < out[i][name][0]):
                    out[i][name] = (cost, max(0, end - m), min(len(text), end))


def blocks(benchmark: DataFrame, item_id: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of at most ``block_chars`` characters, or one item; items of any id."""
    held, size = [], 0
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    for row in rows.toLocalIterator():
        if held and size + len(row["text"]) > block_chars:
            yield held
            held, size = [], 0
        held.append((row["item"], row["text"]))
        size += len(row["text"])
    if held:
        yield held


def find(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and leaked item: ``doc_id``, ``item_id``, ``edits``, and the region ``start``..``stop`` of
    the best probe in the plain text."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema[item_id].dataType.simpleString()}, edits int, start int, stop int"
    names = ["doc_id", "item_id", "edits", "start", "stop"]
    arrow_item = pa.string() if benchmark.schema[item_id].dataType.simpleString() == "string" else pa.int64()

    def runner(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                hits = search(batch.column(1).to_pylist(), shared.value)
                flat = [(i, item, *hit) for i, by in enumerate(hits) for item, hit in sorted(by.items())]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array([x[0] for x in flat], pa.int64())), pa.array([x[1] for x in flat], arrow_item),
                    *[pa.array([x[k] for x in flat], pa.int32()) for k in (2, 3, 4)]], names)
        return run

    found = None
    for block in blocks(benchmark.where(F.col(item_id).isNotNull()), item_id, item_text, block_chars):
        part = rows.mapInArrow(runner(documents.sparkSession.sparkContext.broadcast(build(block))), schema)
        found = part if found is None else found.union(part)
    return found if found is not None else documents.sparkSession.createDataFrame([], schema)


def clean(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents without a leak, with all their columns."""
    def runner(shared, at):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                hits = search(batch.column(at).to_pylist(), shared.value)
                yield batch.filter(pa.array([not h for h in hits], pa.bool_()))
        return run

    for block in blocks(benchmark, item_id, item_text, block_chars):
        shared = documents.sparkSession.sparkContext.broadcast(build(block))
        documents = documents.mapInArrow(runner(shared, documents.columns.index(text)), documents.schema)
    return documents
