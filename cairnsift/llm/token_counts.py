"""Token counts of whole texts; huge texts are encoded as overlapping chunks and spliced.

A text over ``chunk`` characters is cut into chunks that overlap. Two neighbours are spliced at a boundary that both
encodings have: a position before a white-space character where one token ends and, in both, the next begins after it.
The tokenizer drops white space before it splits words, so no token and no word crosses such a place, and what follows
does not depend on what came before. Where the overlap holds no such place (one endless word), it is widened by
encoding a longer left chunk, up to the end of the text.

Null and empty texts have no bytes and no tokens. Rows are counted one by one: repeated rows, ties and other columns
make no difference. The vocabulary file's place is a parameter; each worker opens it once.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from cairnsift.llm.text_arrays import slices

CHUNK = 40_000
OVERLAP = 1_000
BATCH_PIECES = 20_000
KNOWN = 500_000  # a worker forgets the pieces it has seen beyond this; they are then encoded again


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def spans(coder, text: str, start: int, end: int) -> list[tuple[int, int]]:
    got = coder.encode(text[start:end], add_special_tokens=False)
    return [(start + a, start + b) for a, b in got.offsets]


def common_cut(text: str, left: list[tuple[int, int]], right: list[tuple[int, int]], low: int, high: int) -> tuple[int, int] | None:
    """How many tokens to take of the left chunk and to skip of the right one. The cut lies in ``low``..``high``, both
    chunks have two equal tokens before it and one after it, and white space stands at it."""
    at = {span: i for i, span in enumerate(right)}
    for i in range(len(left) - 1, 1, -1):
        (_, before), (after, _) = left[i - 1], left[i]
        if after <= low or before >= high or not text[before:after].isspace():
            continue
        j = at.get(left[i])
        if j is not None and j >= 2 and right[j - 2: j] == left[i - 2: i]:
            return i, j
    return None


def count_long(coder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    total, skip, start = 0, 0, 0
    end = min(len(text), chunk)
    left = spans(coder, text, start, end)
    while end < len(text):
        reach = max(1, min(overlap, (end - start) // 2))
        begin = end - reach
        right = spans(coder, text, begin, min(len(text), begin + chunk))
        # Tokens at a chunk's rim may depend on the cut itself.
        cut = common_cut(text, left, right, begin + 1, end - 1)
        if cut is None or cut[0] < skip:
            end = min(len(text), end + chunk)
            left = spans(coder, text, start, end)
            chunk *= 2
            continue
        total += cut[0] - skip
        skip, start, end, left = cut[1], begin, min(len(text), begin + chunk), right
    return total + len(left) - skip


def count_batch(coder, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP, known: dict[bytes, int] | None = None) -> list[int]:
    """Counts of whole texts. Texts of one chunk are encoded by their blank-separated pieces, each distinct piece once:
    by the argument above a text's tokens are those of its pieces."""
    known = {} if known is None else known
    pieces = [t.encode().split() if len(t) <= chunk else () for t in texts]
    new = list(set().union(*pieces).difference(known))
    for at in range(0, len(new), BATCH_PIECES):
        part = new[at: at + BATCH_PIECES]
        known.update(zip(part, (len(e.ids) for e in coder.encode_batch_fast([p.decode() for p in part], add_special_tokens=False))))
    out = [sum(map(known.__getitem__, p)) if len(t) <= chunk else count_long(coder, t, chunk, overlap) for p, t in zip(pieces, texts)]
    if len(known) > KNOWN:
        known.clear()
    return out


def count(documents: DataFrame, vocabulary: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text",
          chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, known = tokenizer(vocabulary), {}
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = count_batch(coder, texts, chunk, overlap, known)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = documents.select(documents[doc_id].alias("doc_id"), documents[text].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
