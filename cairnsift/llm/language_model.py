"""Scores texts with a gated recurrent language model next to an add-one unigram base.

Counts come from all training documents by a Spark aggregate and stay a table. The network knows by name every token of
the lexicon that training documents have ``NAMED_FROM`` times or more, so its vocabulary grows with the input; the rest
share one name. Gates and candidates of the hidden state follow from the token read, so that whole windows are worked out
at once and only the state itself goes step by step. The output is a mixture: the hidden state gives the shares of
``KINDS`` kinds of text, and each kind has a distribution over all named tokens and the rest; within the rest, add-one
counts decide, where an unseen token has one count's worth. So all probabilities sum to one. The kinds' distributions
start from the counts' shares, so that training starts from the unigram base.

Training is truncated back-propagation in numpy for the network and expected counts for the kinds: windows of ``WINDOW``
steps, the state carried from window to window of a document. Each Spark partition trains on its own training documents
from the same start, and the partitions' weights are averaged by tokens, in ``PASSES`` passes over disjoint shares of the
training documents that together cover them all; weights are sent as the upper half of their 32 bits, rounded. Scoring
runs every document from its first token to its end with the state carried throughout.

Counts of the ``KNOWN`` most frequent tokens, a bounded table, go to every task; all other tokens of a document are
counted by a join. A document is held out where crc32 of its id as text leaves 2 when divided by 7. Null texts count as
empty (one end token), a null id as the empty text. Repeated rows are scored one by one; other columns are ignored. With
no training token, all tokens are unseen and the network keeps its starting weights.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.llm.shared import words
from cairnsift.llm.text_arrays import slices
from cairnsift.session import stored

END = "\n"  # no word holds white space
NET = 512  # named tokens of a network that is given no counts
NAMED_FROM = 16
HIDDEN = 32
WINDOW = 16
KNOWN = 200_000
PASSES = 2
TRAIN_LANES = 512
SCORE_LANES = 512
CHUNK_TOKENS = 6_000_000
RATE = 0.2
BLOCK = 1 << 16  # weights are averaged in blocks of so many
KINDS = 32
PRIOR = 1000.0  # the mass, in tokens, that the kinds' distributions start from
SPREAD = 0.45
PACES = (-4.0, 0.0)
RUN = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def tokens(text: str | None) -> list[str]:
    """Words with A-Z lowered, then one end."""
    lowered = (text or "").encode("utf-8", "surrogatepass").lower()
    return b"\n".join(lowered.split()).decode("utf-8", "surrogatepass").split("\n") + [END] if lowered.strip() else [END]


def shapes(names: int) -> dict[str, tuple[int, ...]]:
    """Inputs are the named tokens, one for all others, and the start of a text; the kinds' rows are the named tokens
    and one for all others."""
    return {"inputs": (names + 2, 2 * HIDDEN), "class": (HIDDEN + 1, KINDS), "word": (names + 1, KINDS)}


def unpacked(flat: np.ndarray, names: int = NET) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for key, shape in shapes(names).items():
        size = int(np.prod(shape))
        out[key] = flat[at: at + size].reshape(shape).copy()
        at += size
    return out


def start(counts: np.ndarray | None = None, rest: float = 1.0) -> np.ndarray:
    """Starting weights; ``counts`` of the named tokens and the mass of the ``rest`` give the kinds' distributions, which
    differ by chance but together are the counts' shares."""
    names = NET if counts is None else len(counts)
    rng = np.random.default_rng(7)
    p = {k: rng.standard_normal(s, np.float32) / 10 for k, s in shapes(names).items() if k != "word"}
    share = np.append(np.ones(names) if counts is None else counts, rest)
    mass = 2 * rng.random((names + 1, KINDS), np.float32) - 1
    mass -= mass.mean(axis=1, keepdims=True)
    share *= PRIOR / share.sum() / KINDS if counts is not None else 1
    p["word"] = share.astype(np.float32)[:, None] * (1 + SPREAD * mass)
    # States forget at different paces at first, so that some hold a few tokens and some hundreds.
    p["inputs"][:, :HIDDEN] += np.linspace(*PACES, HIDDEN)
    p["class"][HIDDEN] = np.log(p["word"].sum(axis=0, dtype=np.float64))
    return np.concatenate([v.ravel() for v in p.values()]).astype(np.float32)


@dataclass
class Lanes:
    """Documents laid end to end in lanes; ``fresh`` marks a first token, padding has target -1."""

    inputs: np.ndarray
    targets: np.ndarray
    fresh: np.ndarray
    owner: np.ndarray


def laid(texts: list[np.ndarray], most: int, names: int = NET) -> Lanes:
    """Longest first into the emptiest lane, so lanes end together."""
    total = sum(map(len, texts))
    longest = max(map(len, texts))
    width = int(max(1, min(most, len(texts), total // longest + 1)))
    heap = [(0, k) for k in range(width)]
    lanes: list[list[int]] = [[] for _ in range(width)]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        filled, k = heapq.heappop(heap)
        lanes[k].append(i)
        heapq.heappush(heap, (filled + len(texts[i]), k))
    steps = max(filled for filled, _ in heap)
    steps = -(-steps // WINDOW) * WINDOW
    inputs = np.zeros((steps, width), np.int32)
    targets = np.full((steps, width), -1, np.int32)
    fresh = np.zeros((steps, width), bool)
    owner = np.zeros((steps, width), np.int32)
    for k, members in enumerate(lanes):
        at = 0
        for i in members:
            n = len(texts[i])
            targets[at: at + n, k] = texts[i]
            inputs[at, k] = names + 1
            inputs[at + 1: at + n, k] = texts[i][:-1]
            fresh[at, k] = True
            owner[at: at + n, k] = i
            at += n
    return Lanes(inputs, targets, fresh, owner)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def forward(p: dict[str, np.ndarray], inputs: np.ndarray, fresh: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states of one window, and what the backward pass needs. Gates and candidates follow from the token read, so
    only the states themselves are worked out step by step."""
    x = p["inputs"][inputs]
    z, c = sigmoid(x[:, :, :HIDDEN]), np.tanh(x[:, :, HIDDEN:])
    stay = 1 - z
    stay[fresh] = 0
    out = z * c
    h = state
    for t in range(len(inputs)):
        h = out[t] = out[t] + stay[t] * h
    return out, [state, z, c, stay, out]


def outputs(p: dict[str, np.ndarray], h: np.ndarray, target: np.ndarray, total: np.ndarray | None = None) -> tuple[np.ndarray, list]:
    """Natural log probability of each target under the mixture of kinds, and what the backward pass needs. ``total`` is
    the kinds' mass, where it is known."""
    one = np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1)
    mix = one @ p["class"]
    mix -= mix.max(axis=1, keepdims=True)
    np.exp(mix, out=mix)
    mix /= mix.sum(axis=1, keepdims=True)
    duty = p["word"][target]
    duty *= (1 / (p["word"].sum(axis=0) if total is None else total)).astype(duty.dtype)
    duty *= mix
    chance = duty.sum(axis=1)
    duty /= chance[:, None]
    return np.log(chance), [one, mix, duty]


def summed(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sums of their rows."""
    order = np.argsort(keys, kind="stable")
    keys, rows = keys[order], rows[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    n = np.diff(np.append(first, len(keys)))
    out = rows[first]
    # Long runs one by one; of short ones, all second rows, all third ones and so on.
    for i in np.flatnonzero(n > RUN).tolist():
        rows[first[i]: first[i] + n[i]].sum(axis=0, out=out[i])
    some = np.flatnonzero((n > 1) & (n <= RUN))
    for k in range(1, RUN):
        some = some[n[some] > k]
        out[some] += rows[first[some] + k]
    return keys[first], out


def climb(p: dict[str, np.ndarray], inputs, fresh, trace, target, kept, saved, step) -> None:
    """Gradients of the mean log probability over one window, part by part: ``step(key, rows, gradient)``. A part's
    weights are not read any more once it is told, so ``step`` may change them."""
    one, mix, duty = saved
    n = max(1, len(target))
    d = duty - mix
    d /= n
    dh_out = d @ p["class"][:HIDDEN].T
    step("class", slice(None), one.T @ d)
    if len(target):
        step("word", *summed(target, duty))
    dh_all = np.zeros((*inputs.shape, HIDDEN), dh_out.dtype)
    dh_all[kept] = dh_out
    state, z, c, stay, out = trace
    for t in range(len(inputs) - 2, -1, -1):
        dh_all[t] += dh_all[t + 1] * stay[t + 1]
    before = np.concatenate([state[None], out[:-1]])
    before[fresh] = 0
    dx = np.concatenate([dh_all * (c - before) * z * (1 - z), dh_all * z * (1 - c * c)], axis=2)
    flat = dx.reshape(-1, 2 * HIDDEN)
    # Padding carries no gradient, as nothing after it does.
    step("inputs", *summed(inputs.ravel(), flat))


def backward(p, inputs, fresh, trace, target, kept, saved) -> dict[str, np.ndarray]:
    """Gradients of the mean log probability over one window, all in whole arrays."""
    g = {k: np.zeros(v.shape, v.dtype) for k, v in p.items()}

    def told(key: str, rows, part: np.ndarray) -> None:
        if key == "word":
            g[key] -= part.sum(axis=0) / p[key].sum(axis=0) / len(target)
            g[key][rows] += part / p[key][rows] / len(target)
        else:
            g[key][rows] = part

    climb(p, inputs, fresh, trace, target, kept, saved, told)
    return g


def train(p: dict[str, np.ndarray], squares: dict[str, np.ndarray], texts: list[np.ndarray]) -> None:
    """One pass over some documents by adaptive gradient steps, in place."""
    lanes = laid(texts, TRAIN_LANES, len(p["inputs"]) - 2)
    state = np.zeros((lanes.inputs.shape[1], HIDDEN), np.float32)
    total = p["word"].sum(axis=0, dtype=np.float64)

    def step(key: str, rows, g: np.ndarray) -> None:
        nonlocal total
        if key == "word":
            # Expected counts: each kind's share of a token is added to its mass.
            p[key][rows] += g
            total += g.sum(axis=0, dtype=np.float64)
            return
        g *= n
        # Only the rows that have a gradient are read and written; one class at a time stays in the processor's cache.
        seen = squares[key][rows]
        seen += g * g
        g *= RATE
        g /= np.sqrt(seen + np.float32(1e-6))
        if isinstance(rows, np.ndarray):
            squares[key][rows] = seen
        p[key][rows] += g

    for at in range(0, len(lanes.inputs), WINDOW):
        cut = slice(at, at + WINDOW)
        inputs, targets, fresh = lanes.inputs[cut], lanes.targets[cut], lanes.fresh[cut]
        kept = targets >= 0
        if not kept.any():
            break
        hidden, trace = forward(p, inputs, fresh, state)
        state = hidden[-1]
        n = np.float32(kept.sum())
        _, saved = outputs(p, hidden[kept], targets[kept], total)
        climb(p, inputs, fresh, trace, targets[kept], kept, saved, step)


def score(p: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Natural log probability by document, the factor within the class of unnamed tokens left out."""
    lanes = laid(texts, SCORE_LANES, len(p["inputs"]) - 2)
    out = np.zeros(len(texts))
    total = p["word"].sum(axis=0, dtype=np.float64)
    state = np.zeros((lanes.inputs.shape[1], HIDDEN), np.float32)
    for at in range(0, len(lanes.inputs), WINDOW):
        cut = slice(at, at + WINDOW)
        hidden, _ = forward(p, lanes.inputs[cut], lanes.fresh[cut], state)
        state = hidden[-1]
        kept = lanes.targets[cut] >= 0
        logp, _ = outputs(p, hidden[kept], lanes.targets[cut][kept], total)
        out += np.bincount(lanes.owner[cut][kept], logp, len(texts))
    return out


@dataclass
class Lexicon:
    """The most frequent tokens in order, with their counts; the first ``names`` have names in the network."""

    rank: dict[str, int]
    counts: np.ndarray
    train_tokens: int
    distinct: int

    @property
    def names(self) -> int:
        return int((self.counts >= NAMED_FROM).sum())

    @property
    def rest(self) -> float:
        """The add-one mass of tokens without a name, and one unseen."""
        return float(self.train_tokens - self.counts[:self.names].sum() + self.distinct - self.names + 1)


def numbered(said: list[str], rank: dict[str, int]) -> np.ndarray:
    """Ranks of tokens, -1 for those outside the lexicon."""
    return np.fromiter(map(rank.get, said, repeat(-1)), np.int32, len(said))


def named(ranks: np.ndarray, names: int) -> np.ndarray:
    return np.where((ranks < 0) | (ranks >= names), names, ranks)


def count_words(rows: DataFrame) -> DataFrame:
    """Counts of all training tokens: ``word``, ``c``."""
    kept = rows.where(~held_out(F.col("doc_id")))
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    said = kept.select(F.explode(words(lowered)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("c"))
    ends = kept.agg(F.count(F.lit(1)).alias("c")).where("c > 0").select(F.lit(END).alias("word"), "c")
    return said.union(ends)


def most_frequent(counts: DataFrame, known: int) -> DataFrame:
    """All tokens above the lowest count at which they are no more than ``known``. The count comes from a histogram over
    64 steps per doubling, so what reaches the driver is bounded by ``known`` and by the histogram."""
    step = F.floor(F.log2("c") * 64)
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect()
    total, least = 0, None
    for row in sizes:
        total += row["n"]
        if total > known:
            break
        least = row["step"]
    return counts.where(step >= least) if least is not None else counts.limit(0)


def gathered(rows: DataFrame) -> DataFrame:
    """The training rows in as many partitions as train at a time, or an eighth of what there are where that is more.
    Each partition sends one network, so this and not the number of files decides how many are sent, and each network
    trains on more."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions() // 8))


def halved(values: np.ndarray) -> bytes:
    """Weights by the upper half of their bits, rounded."""
    return ((values.astype(np.float32).view(np.uint32) + np.uint32(0x8000)) >> np.uint32(16)).astype(np.uint16).tobytes()


def whole(half: bytes) -> np.ndarray:
    return (np.frombuffer(half, np.uint16).astype(np.uint32) << np.uint32(16)).view(np.float32)


def sent(k: int, values: np.ndarray, *n: float) -> pa.RecordBatch:
    more = [pa.array([x]) for x in n]
    return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([halved(values)], pa.binary()), *more], ["k", "weights", "n"][: 2 + len(more)])


def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Means by token of the weights' blocks, from rows in block order; one block is held at a time."""
    of, total, n = None, np.zeros(0), 0.0
    for batch in batches:
        for k, weights, m in zip(*(c.to_pylist() for c in batch.columns)):
            values = whole(weights).astype(np.float64)
            if k != of:
                if of is not None:
                    yield sent(of, total / n)
                of, total, n = k, np.zeros(len(values)), 0.0
            total += values * m
            n += m
    if of is not None:
        yield sent(of, total / n)


def trained(rows: DataFrame, lexicon: Broadcast, passes: int) -> np.ndarray:
    """Averaged weights after ``passes`` passes, each over its own share of the training documents."""
    names = lexicon.value.names
    flat: np.ndarray | None = None
    kept = rows.where(~held_out(F.col("doc_id")))
    for turn in range(passes):
        share = kept.where(F.pmod(F.xxhash64("doc_id"), F.lit(passes)) == turn).select("text")
        # The first weights follow from the lexicon, which every task has.
        begin = None if flat is None else rows.sparkSession.sparkContext.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p = unpacked(start(lexicon.value.counts[:names], lexicon.value.rest) if begin is None else begin.value, names)
            squares = {k: np.full_like(v, 1e-3) for k, v in p.items() if k != "word"}
            held: list[np.ndarray] = []
            seen = size = 0
            for batch in slices(batches):
                for text in batch.column(0).to_pylist():
                    held.append(named(numbered(tokens(text), lexicon.value.rank), names))
                    size += len(held[-1])
                if size >= CHUNK_TOKENS:
                    train(p, squares, held)
                    seen, size, held = seen + size, 0, []
            if held:
                train(p, squares, held)
                seen += size
            if seen:
                squares.clear()
                flat = np.concatenate([v.ravel() for v in p.values()])
                for k in range(0, len(flat), BLOCK):
                    yield sent(k // BLOCK, flat[k: k + BLOCK], float(seen))

        parts = gathered(share).mapInArrow(run, "k int, weights binary, n double")
        flat = start(lexicon.value.counts[:names], lexicon.value.rest) if flat is None else flat.copy()
        for row in parts.repartition("k").sortWithinPartitions("k").mapInArrow(averaged, "k int, weights binary").toLocalIterator():
            at = row["k"] * BLOCK
            flat[at: at + BLOCK] = whole(row["weights"])
        if begin is not None:
            begin.destroy()
    return start(lexicon.value.counts[:names], lexicon.value.rest) if flat is None else flat


def scored(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", known: int = KNOWN, passes: int = PASSES) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row."""
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counts = stored(count_words(rows))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = sorted(most_frequent(counts, known).collect(), key=lambda r: (-r["c"], r["word"]))
    lexicon = Lexicon({r["word"]: i for i, r in enumerate(top)}, np.array([r["c"] for r in top], np.int64), total["n"], total["v"])
    shared = spark.sparkContext.broadcast(lexicon)
    weights = spark.sparkContext.broadcast(trained(rows, shared, passes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        names = lex.names
        p = unpacked(weights.value, names)
        whole = lex.train_tokens + lex.distinct + 1
        base = np.append(np.log10((lex.counts + 1) / whole), 0.0)
        rest = np.append(np.log10((lex.counts + 1) / lex.rest), 0.0)
        rest[:names] = 0.0
        rest[-1] = 0.0
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids, tails = [x[1] for x in held], [x[2] for x in held]
            network = score(p, [named(x, names) for x in ids]) / np.log(10)
            offsets = np.cumsum([0] + [len(t) for t in tails]).astype(np.int32)
            tail = pa.StructArray.from_arrays([pa.array([w for t in tails for w in t], pa.string()), pa.array([c for t in tails for c in t.values()], pa.int64())], ["word", "tf"])
            return pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in held], id_kind), pa.array([len(i) for i in ids], pa.int64()), pa.array([int((i >= 0).sum()) for i in ids], pa.int64()),
                pa.array([float(base[i].sum()) for i in ids]), pa.array([float(n + rest[i].sum()) for n, i in zip(network, ids)]),
                pa.ListArray.from_arrays(pa.array(offsets), tail)], ["doc_id", "n_tokens", "n_top", "base_top", "score_top", "tail"])

        for batch in slices(batches):
            id_kind = batch.column(0).type
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                said = tokens(text)
                ranks = numbered(said, lex.rank)
                held.append((i, ranks, Counter(said[k] for k in np.flatnonzero(ranks < 0).tolist())))
                size += len(ranks)
            if size >= CHUNK_TOKENS:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    kind = rows.schema["doc_id"].dataType.simpleString()
    first = rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, n_top bigint, base_top double, score_top double, tail array<struct<word:string,tf:bigint>>")
    first = stored(first.withColumn("row", F.monotonically_increasing_id()))
    tail = first.select("row", F.explode("tail").alias("x")).select("row", "x.word", "x.tf").join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    more = tail.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("n_more"),
        F.sum(F.col("tf") * F.log10((c + 1) / F.lit(float(total["n"] + total["v"] + 1)))).alias("base_more"),
        F.sum(F.col("tf") * F.log10((c + 1) / F.lit(lexicon.rest))).alias("score_more"))
    zero = F.lit(0)
    return first.drop("tail").join(more, "row", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_top") + F.coalesce("n_more", zero)).alias("n_known"),
        F.lit(total["n"]).cast("bigint").alias("train_tokens"), (F.col("base_top") + F.coalesce("base_more", F.lit(0.0))).alias("base_score"),
        (F.col("score_top") + F.coalesce("score_more", F.lit(0.0))).alias("score"))
