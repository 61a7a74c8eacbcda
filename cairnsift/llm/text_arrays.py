"""Words of many texts as numpy arrays, for code that runs inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
U64 = np.uint64


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (two multiply and shift rounds), so that every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x + U64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=8)
def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=U64)


@lru_cache(maxsize=4)
def letters(lane: int) -> np.ndarray:
    return mixed(np.arange(256, dtype=U64), 1000 + lane)


BASES = (0x2545F4914F6CDD1D, 0xD1342543DE82EF95)


@dataclass
class Words:
    data: bytes
    starts: np.ndarray  # byte offsets of the words in data
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words at the end


def split(texts: list[bytes]) -> Words:
    """All words of all texts, in order."""
    data = b"\n".join(texts) + b"\n"
    blank = SPACES[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(data, starts, ends, np.searchsorted(starts, begin))


def prints(w: Words, lane: int = 0) -> np.ndarray:
    """A 64-bit print of each word: a polynomial over random letter values, finished by ``mixed``."""
    data = np.frombuffer(w.data, np.uint8)
    base = BASES[lane]
    size = 1 << max(16, int(len(data)).bit_length())
    up, down = powers(base, size), powers(pow(base, -1, 1 << 64), size)
    with np.errstate(over="ignore"):
        total = np.cumsum(letters(lane)[data] * up[: len(data)], dtype=U64)
        total = np.concatenate([np.zeros(1, U64), total])
        value = (total[w.ends] - total[w.starts]) * down[w.starts]
        return mixed(value + (w.ends - w.starts).astype(U64), lane)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes, at least one row each. What a task holds then follows from this
    and not from the rows that Spark puts into a batch."""
    for batch in batches:
        step = max(1, batch.num_rows * size // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
