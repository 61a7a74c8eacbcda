"""Spelling variants of a corpus' words: near words, forms and roots.

Two words are near if they differ by one inserted, deleted or replaced character. Pairs are found from one side only:
each word generates its deletions and the replacements by a later letter, as 64-bit prints that follow from the word's
own print in constant time, and probes each in a broadcast blocked Bloom filter of the vocabulary (one 512-bit block per
print, six bits in two of its words). A print that the filter knows becomes a row with the edited word spelled out, and
an exact join with the vocabulary removes what the filter let through by chance. Prints only decide which rows reach that
join and the filter never misses a word, so the result is exact.

The filter has one shard per word length (and per part of a length that is too large), each of blocks for 16 bits a word.
What is broadcast at a time is bounded: shards are put into groups of at most ``FILTER_BYTES``, and each group is one pass
over the vocabulary with the edits that fall into it. 16 million words make one group.

Rows that a word can meet are bounded by its own edits, so no group of words is ever paired within itself. Counting words
combines on the map side. Forms are followed to the root by pointer doubling: an occurrence count at least doubles with
every step, so the rounds are few.

Words are runs of A-Z, a-z and U+00C0 to U+00FF in whole texts, with A-Z lower-cased. With ``spoil``, one run in ``spoil``
(by crc32 of id and run) first loses a character. Null and empty texts have no words, an empty table gives no rows; a
null id reads as an empty string; rows that repeat an id or a text count as often as they stand there. Among near words
of equal count the smallest in code-point order is the form. Words of any length take part: edits are made in slices of
``SLICE`` positions. Other columns are not read, so their names are free.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.llm.text_arrays import BASES, U64, letters, mixed, powers
from cairnsift.session import stored

RUN = "[A-Za-zÀ-ÿ]{%d,}"
BLOCK_BITS, WORD_BITS = 512, 16  # bits of a block, and filter bits for each word of the vocabulary
FILTER_BYTES = 32 << 20
SLICE = 1 << 13
STEPS = 64  # rounds of pointer doubling; each doubles the steps followed


def words(documents: DataFrame, doc_id: str, text: str, least: int, spoil: int | None) -> DataFrame:
    """All words of at least ``least`` characters, one row each."""
    runs = documents.select(F.col(doc_id).cast("string").alias("id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN % least), F.lit(0))).alias("run"))
    ascii_only = F.octet_length("run") == F.length("run")
    low = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    runs = runs.select("id", low.alias("run"))
    if spoil is None:
        return runs.select(F.col("run").alias("word"))
    marked = runs.select("run", F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run")).cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return marked.select(F.when(F.col("h") % spoil == 0, less).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least)


def vocabulary(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 5, at_least: int = 3, spoil: int | None = None) -> DataFrame:
    """Words of at least ``least`` characters that occur ``at_least`` times: ``word``, ``n``."""
    return words(documents, doc_id, text, least, spoil).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)


@dataclass
class Flat:
    """Words as one array of characters: every character is one byte of Latin-1."""
    data: np.ndarray
    owner: np.ndarray  # the word of each character
    place: np.ndarray  # its position in the word
    sizes: np.ndarray
    starts: np.ndarray
    before: np.ndarray  # print of what stands before each character
    whole: np.ndarray  # print of each word, not yet mixed


def flat(column: pa.Array) -> Flat:
    given = [w.encode("latin-1") for w in column.to_pylist()]
    sizes = np.array([len(w) for w in given], np.int64)
    data = np.frombuffer(b"".join(given), np.uint8)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(given)), sizes)
    place = np.arange(len(data)) - starts[owner]
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(letters(0)[data] * scales(sizes)[place], dtype=U64)])
        return Flat(data, owner, place, sizes, starts, total[:-1] - total[starts[owner]], total[starts + sizes] - total[starts])


def scales(sizes: np.ndarray) -> np.ndarray:
    return powers(BASES[0], 1 << max(10, int(sizes.max(initial=1)).bit_length()))


@dataclass
class Shards:
    """Where a word's print falls: shards by length, large lengths in equal parts by print."""
    first: np.ndarray  # first shard of each length
    parts: np.ndarray  # number of shards of each length, 0 where no word has it
    blocks: np.ndarray  # blocks of each length's shards

    @classmethod
    def of(cls, counts: dict[int, int], most: int) -> Shards:
        top = max(counts, default=0) + 2
        parts, blocks = np.zeros(top, np.int64), np.ones(top, np.int64)
        for size, n in counts.items():
            total = -(-n * WORD_BITS // BLOCK_BITS)
            parts[size] = -(-total * (BLOCK_BITS // 8) // most)
            blocks[size] = -(-total // parts[size])
        return cls(np.cumsum(parts) - parts, parts, blocks)

    def groups(self, most: int) -> list[list[int]]:
        """Shards put together so that no group's filters exceed ``most`` bytes."""
        out: list[list[int]] = []
        room = 0
        for size in np.flatnonzero(self.parts):
            for k in range(self.parts[size]):
                need = int(self.blocks[size]) * BLOCK_BITS // 8
                if not out or need > room:
                    out.append([])
                    room = most
                out[-1].append(int(self.first[size] + k))
                room -= need
        return out

    def sizes(self) -> np.ndarray:
        return np.repeat(self.blocks, self.parts)

    def locate(self, print_: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard and block of prints of words of ``size`` characters; every length must have a shard."""
        shard = self.first[size] + ((print_ & U64(0xFFFF)).astype(np.int64) * self.parts[size] >> 16)
        block = ((print_ >> U64(32)) * self.blocks[size].astype(U64) >> U64(32)).astype(np.int64)
        return shard, block


def bits(print_: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """The two words of a block that a print uses, and its three bits in each."""
    again = mixed(print_, 5)
    six = U64(63)
    one = U64(1)

    def mask(shift: int) -> np.ndarray:
        return one << (again >> U64(shift) & six) | one << (again >> U64(shift + 6) & six) | one << (again >> U64(shift + 12) & six)

    first = (again & U64(7)).astype(np.int64)
    second = (first + 1 + (again >> U64(3) & U64(7)).astype(np.int64) % 7) % 8
    return (first, mask(8)), (second, mask(32))


def filter_words(vocab: DataFrame, shards: Shards) -> DataFrame:
    """The Bloom filters as rows: shard, position of a 64-bit word, and its bits."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            f = flat(batch.column(0))
            print_ = mixed(f.whole)
            shard, block = shards.locate(print_, f.sizes)
            pieces = [(shard, block * 8 + w, mask) for w, mask in bits(print_)]
            shard, at, mask = (np.concatenate(x) for x in zip(*pieces))
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(at), pa.array(mask.view(np.int64))], ["shard", "at", "bits"])

    return vocab.select("word").mapInArrow(part, "shard long, at long, bits long").groupBy("shard", "at").agg(F.bit_or("bits").alias("bits"))


@dataclass
class Filter:
    """The filters of one group of shards, one after the other; ``begin`` is -1 for shards of other groups."""
    bits: np.ndarray
    begin: np.ndarray

    def knows(self, shards: Shards, print_: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Indices of the prints that this group's filters may hold."""
        mine = np.flatnonzero(shards.parts[size] > 0)
        shard, block = shards.locate(print_[mine], size[mine])
        begin = self.begin[shard]
        here = np.flatnonzero(begin >= 0)
        mine, at = mine[here], begin[here] + block[here] * 8
        (w1, m1), (w2, m2) = bits(print_[mine])
        yes = np.flatnonzero(self.bits[at + w1] & m1 == m1)
        yes = yes[self.bits[at[yes] + w2[yes]] & m2[yes] == m2[yes]]
        return mine[yes]


def edits(f: Flat, alphabet: np.ndarray, part: slice) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Prints of edited words from the characters in ``part``: position in the flat array, print, length, new character
    (-1 where it is deleted)."""
    at = np.arange(part.start, part.stop)
    ch, owner, place = f.data[part], f.owner[part], f.place[part]
    value, up = letters(0), scales(f.sizes)
    with np.errstate(over="ignore"):
        own = value[ch] * up[place]
        # A character equal to the one before it gives the same deletion and is left to that one.
        fresh = (place == 0) | (f.data[at - 1] != ch)
        behind = f.whole[owner] - f.before[part] - own
        shorter = f.before[part] + behind * U64(pow(BASES[0], -1, 1 << 64))
        yield at[fresh], mixed(shorter[fresh]), f.sizes[owner[fresh]] - 1, -1
        rest = f.whole[owner] - own
        for new in alphabet:
            lower = np.flatnonzero(ch < new)
            yield at[lower], mixed(rest[lower] + value[new] * up[place[lower]]), f.sizes[owner[lower]], int(new)


def candidates(vocab: DataFrame, shards: Shards, alphabet: bytes, group: Filter) -> DataFrame:
    """Edited words that the group's filters know: ``word``, ``n``, ``edited``."""
    sent = vocab.sparkSession.sparkContext.broadcast(group)
    letters_in = np.frombuffer(alphabet, np.uint8)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            f = flat(batch.column(0))
            for begin in range(0, len(f.data), SLICE):
                rows, made = [], []
                for at, print_, size, new in edits(f, letters_in, slice(begin, min(begin + SLICE, len(f.data)))):
                    for p in at[held.knows(shards, print_, size)]:
                        o = f.owner[p]
                        old = f.data[f.starts[o]: f.starts[o] + f.sizes[o]].tobytes()
                        k = int(f.place[p])
                        rows.append(o)
                        made.append((old[:k] + (bytes([new]) if new >= 0 else b"") + old[k + 1:]).decode("latin-1"))
                if rows:
                    chosen = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(chosen), batch.column(1).take(chosen), pa.array(made)], ["word", "n", "edited"])

    return vocab.select("word", "n").mapInArrow(probe, "word string, n long, edited string")


def near_pairs(vocab: DataFrame, most: int = FILTER_BYTES) -> DataFrame:
    """Pairs of near words of a vocabulary (``word``, ``n``), each once: ``word``, ``n``, ``other``, ``other_n``.

    The driver holds the words' number by length, the letters in use (90 at most) and one group of filters at a time."""
    counts = {r.size: r.n for r in vocab.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    used = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()
    alphabet = bytes(sorted(r.c.encode("latin-1")[0] for r in used))
    shards = Shards.of(counts, most)
    groups = shards.groups(most)
    tables = filter_words(vocab, shards)
    if len(groups) > 1:
        tables = stored(tables)
    sizes = shards.sizes() * (BLOCK_BITS // 64)
    found = None
    for group in groups:
        begin = np.full(len(sizes), -1, np.int64)
        begin[group] = np.cumsum(sizes[group]) - sizes[group]
        cells = tables.where(F.col("shard").between(group[0], group[-1])).toArrow()
        held = np.zeros(int(sizes[group].sum()), U64)
        held[begin[cells["shard"].to_numpy()] + cells["at"].to_numpy()] = cells["bits"].to_numpy().view(U64)
        part = candidates(vocab, shards, alphabet, Filter(held, begin))
        found = part if found is None else found.union(part)
    if found is None:
        return vocab.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    known = vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return found.join(known, F.col("edited") == F.col("other")).select("word", "n", "other", "other_n")


def roots(forms: DataFrame) -> DataFrame:
    """The last word that following ``form`` from ``word`` leads to, for a frame of words with a form."""
    at = stored(forms.select("word", F.col("form").alias("root")))
    for _ in range(STEPS):
        ahead = at.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        stepped = stored(at.join(ahead, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")))
        at = stepped.select("word", "root")
        if stepped.where("moved").limit(1).count() == 0:
            return at
    raise RuntimeError("forms did not come to an end")


def best(word: Column | str, n: Column | str) -> Column:
    """The word of largest count, of equal counts the smallest."""
    return F.min(F.struct((-F.col(n)).alias("n"), F.col(word).alias("word")))


def variants(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 5, at_least: int = 3, factor: int = 2,
             spoil: int | None = None, most: int = FILTER_BYTES) -> DataFrame:
    """One row per word of the vocabulary: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``. A word's form is
    its most frequent near word, if that one is at least ``factor`` (2 or more) times as frequent."""
    if factor < 2:
        raise ValueError("forms could run in circles")
    vocab = stored(vocabulary(documents, doc_id, text, least, at_least, spoil))
    pairs = near_pairs(vocab, most)
    both = pairs.select(F.explode(F.array(
        F.struct("word", F.col("other"), F.col("other_n")),
        F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))).alias("p")).select("p.*")
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best("other", "other_n").alias("top"))
    joined = vocab.join(near, "word", "left")
    led = F.col("top.n") * -1 >= F.col("n") * factor
    judged = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                  F.when(led, F.col("top.word")).alias("form"), F.when(led, -F.col("top.n")).alias("form_n")))
    last = roots(judged.where("form IS NOT NULL")).withColumnRenamed("word", "_word")
    return judged.join(last, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
