"""License scan: templates with optional and replaceable regions, compiled into automata over words.

A template is wording with markup: ``<<beginOptional>>`` to ``<<endOptional>>`` encloses words that may be missing,
``<<var;name=...;words=LOW-HIGH>>`` stands for LOW to HIGH words of any kind (with ``match=digits`` for words of digits
only). All other words are mandatory and must stand there exactly. ``compiled`` turns the templates into one
nondeterministic automaton whose letters are words; ``Automaton.longest`` runs it as a deterministic one that is built
as far as texts need it. A label's place is the longest accepted run of words from a start.

One pass without a shuffle: a task reads its texts in slices of about 2 MB, cuts the words in numpy and looks up every
two neighbouring words by a 64-bit print among those that templates or phrases begin with. Only at these places does the
automaton run, on the words themselves, so a print shared by chance costs a look and changes no result. It stops where
the mandatory wording does, and a template has a bounded number of words, so a text's cost grows with its length,
however long it is.

Words are runs of ASCII digits and letters and of all characters beyond ASCII, after A-Z were lower-cased. Null texts
count as empty; empty and blank texts have no words, no places, empty labels and score 0. Every row gives one row, so
repeated rows and repeated or null ids stay as they are; an empty table gives none. Only the id and the text are read:
other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cairnsift.llm.license_texts import PHRASES, TEMPLATES
from cairnsift.llm.text_arrays import U64, Words, mixed, prints, slices

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BETWEEN = np.zeros(256, bool)
BETWEEN[:0x30] = BETWEEN[0x3A:0x61] = BETWEEN[0x7B:0x80] = True
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
MARK = re.compile(r"<<(.*?)>>")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ANY, DIGITS = "*", "#"  # edges that take more than one word; neither is a word itself
STATES = 20_000  # deterministic states kept per task; beyond, the automaton starts to build them anew


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(CAPITALS))


def regions(template: str) -> list[tuple]:
    """A template as a list of ``("word", w)``, ``("var", low, high, digits)``, ``("begin",)`` and ``("end",)``."""
    out: list[tuple] = []
    at = 0
    for mark in MARK.finditer(template):
        out += [("word", w) for w in words_of(template[at: mark.start()])]
        at = mark.end()
        name, *rest = mark[1].split(";")
        if name == "var":
            given = dict(x.split("=", 1) for x in rest)
            low, _, high = given.get("words", "1-1").partition("-")
            out.append(("var", int(low), int(high or low), given.get("match") == "digits"))
        elif name in ("beginOptional", "endOptional"):
            out.append(("begin",) if name == "beginOptional" else ("end",))
        else:
            raise ValueError(f"unknown markup {mark[0]}")
    return out + [("word", w) for w in words_of(template[at:])]


class Automaton:
    """The templates of all labels in one automaton; state 0 is the start."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.edges: list[list[tuple[str, int]]] = [[]]
        self.free: list[list[int]] = [[]]  # moves that take no word
        self.accepts: dict[int, str] = {}
        for label, template in templates:
            self._add(label, regions(template))
        self.start = self._closed({0})
        self.seen: dict[tuple[frozenset, str], frozenset] = {}
        self.beginnings = self._beginnings()

    def _state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def _add(self, label: str, parts: list[tuple]) -> None:
        at = self._state()
        self.free[0].append(at)
        opened: list[int] = []
        for part in parts:
            if part[0] == "begin":
                opened.append(at)
            elif part[0] == "end":
                new = self._state()
                self.free[opened.pop()].append(new)
                self.free[at].append(new)
                at = new
            elif part[0] == "word":
                new = self._state()
                self.edges[at].append((part[1], new))
                at = new
            else:
                _, low, high, digits = part
                end = self._state()
                for k in range(high):
                    if k >= low:
                        self.free[at].append(end)
                    new = self._state()
                    self.edges[at].append((DIGITS if digits else ANY, new))
                    at = new
                self.free[at].append(end)
                at = end
        if opened:
            raise ValueError(f"an optional region of {label} does not end")
        self.accepts[at] = label

    def _closed(self, states: set[int]) -> frozenset:
        todo, found = list(states), set(states)
        while todo:
            for new in self.free[todo.pop()]:
                if new not in found:
                    found.add(new)
                    todo.append(new)
        return frozenset(found)

    def _beginnings(self) -> set[tuple[str, str]]:
        """The first two words of everything accepted. Both must be fixed, since places are found by them."""
        pairs = set()
        for state in self.start:
            for first, after in self.edges[state]:
                for then in self._closed({after}):
                    if then in self.accepts:
                        raise ValueError("a template needs two words")
                    pairs |= {(first, second) for second, _ in self.edges[then]}
        if any(w in (ANY, DIGITS) for pair in pairs for w in pair):
            raise ValueError("a template must begin with two fixed words")
        return pairs

    def step(self, states: frozenset, word: str) -> frozenset:
        key = (states, word)
        found = self.seen.get(key)
        if found is None:
            if len(self.seen) >= STATES:
                self.seen.clear()
            digits = word.isascii() and word.isdigit()
            found = self._closed({new for s in states for w, new in self.edges[s] if w == word or w == ANY or (w == DIGITS and digits)})
            self.seen[key] = found
        return found

    def longest(self, words: Iterator[str]) -> dict[str, int]:
        """For each label that accepts a beginning of ``words``: the most words it takes."""
        states, out = self.start, {}
        for n, word in enumerate(words, 1):
            states = self.step(states, word)
            if not states:
                break
            for s in states:
                if s in self.accepts:
                    out[self.accepts[s]] = n
        return out


def split(texts: list[bytes]) -> Words:
    """The words of all texts, lower-cased, in order."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    data = LOWER[raw]
    edge = np.flatnonzero(np.diff(BETWEEN[data], prepend=True))
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    return Words(data.tobytes(), edge[0::2], edge[1::2], np.searchsorted(edge[0::2], begin))


def print_of(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    ends = np.cumsum([len(d) + 1 for d in data]) - 1
    return prints(Words(b"\n".join(data) + b"\n", ends - np.array([len(d) for d in data]), ends, np.array([0, len(data)])))


def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(first * U64(3) + second, 77)


class Scanner:
    """Finds the places of templates and phrases in slices of texts."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.automaton = Automaton(templates)
        self.phrases = [(words_of(p), label) for p, label in phrases.items()]
        pairs = sorted(self.automaton.beginnings | {tuple(w[:2]) for w, _ in self.phrases})
        self.known = np.sort(joined(print_of([a for a, _ in pairs]), print_of([b for _, b in pairs])))

    def places(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[tuple[int, int, str, bool]]]]:
        """The number of words of each text, and its places: first word, number of words, label, whether of a phrase."""
        w = split(texts)
        p = prints(w)
        both = joined(p[:-1], p[1:])
        at = np.searchsorted(self.known, both)
        hits = np.flatnonzero(self.known[np.minimum(at, len(self.known) - 1)] == both)
        found: list[list] = [[] for _ in texts]
        for text, hit in zip(np.searchsorted(w.first, hits, "right") - 1, hits):
            stop = int(w.first[text + 1])

            def word(k: int) -> str:
                return w.data[w.starts[k]: w.ends[k]].decode()

            start = int(hit - w.first[text])
            for phrase, label in self.phrases:
                if hit + len(phrase) <= stop and all(word(hit + k) == x for k, x in enumerate(phrase)):
                    found[text].append((start, len(phrase), label, True))
            for label, n in self.automaton.longest(word(k) for k in range(hit, stop)).items():
                found[text].append((start, n, label, False))
        return np.diff(w.first), found


@lru_cache(maxsize=2)
def scanner(templates: tuple[tuple[str, str], ...], phrases: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(list(templates), dict(phrases))


def covered(places: list[tuple[int, int, str, bool]]) -> int:
    """Words in at least one of the places."""
    total = reach = 0
    for start, n, *_ in sorted(places):
        total += max(0, start + n - max(start, reach))
        reach = max(reach, start + n)
    return total


PLACES = "array<struct<start: bigint, words: bigint, label: string, phrase: boolean>>"


def places(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
           phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``covered`` (words in any place) and its ``places``."""
    given = (tuple(templates), tuple(phrases.items()))
    kind = documents.schema[doc_id].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(*given)
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            counts, found = find.places(batch.column(1).cast(pa.binary()).to_pylist())
            rows = [[{"start": s, "words": n, "label": label, "phrase": phrase} for s, n, label, phrase in sorted(x)] for x in found]
            made = pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("label", pa.string()), ("phrase", pa.bool_())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts.astype(np.int64)), pa.array([covered(x) for x in found], pa.int64()), made],
                                             ["doc_id", "n_words", "covered", "places"])

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(scan, f"doc_id {kind}, n_words bigint, covered bigint, places {PLACES}")


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
         phrases: dict[str, str] = PHRASES) -> DataFrame:
    """One row per document: number of phrases' places (``n_base``) and their least and largest first word, the labels of
    phrases and of all, and ``score``, the share of the text's words that lie in any place."""
    found = places(documents, doc_id, text, templates, phrases)
    base = F.filter("places", lambda p: p["phrase"])
    starts = F.transform(base, lambda p: p["start"])

    def names(p):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(p, lambda x: x["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"), names(F.col("places")).alias("labels"),
        F.when(F.col("n_words") > 0, F.col("covered").cast("double") / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"))
