"""Line-first quality rules: lines are judged and removed first, then documents that lose too much.

Everything is an expression over one row: no shuffle, no Python on the executors. A null text counts as empty and an
empty text fails the base rules. Rows are judged one by one, so ties, repeated rows and repeated ids need no care, and
other columns are never looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.llm.shared import SPACE, let, words

# The characters counted as symbols, the ends of a sentence, separators of menus, and
# symbols and separators together, counted first because most lines have neither.
SYMBOLS = r"[#*$%&|<>]"
SENTENCE_END = r"""[.!?…:;][")'\]”’»]{0,2}$"""
SEPARATORS = r"[|»›·•→]"
MARKS = r"[#*$%&|<>»›·•→]"
BOILERPLATE = ("all rights reserved", "licensed under", "terms of service", "privacy policy", "cookie policy", "enable javascript",
               "lorem ipsum", "click here", "copyright", "©")


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    repeat_percent: int = 20  # words in repeated 5-word windows
    symbols_per_ten_words: int = 3
    separators_per_ten_words: int = 2
    lost_percent: int = 50


def solid_chars(text: Column) -> Column:
    """Code points that are not white space between words."""
    for space in SPACE:
        text = F.replace(text, F.lit(space), F.lit(""))
    return F.length(text)


def names_boilerplate(text: Column) -> Column:
    lower = F.lower(text)
    return let(lower, lambda x: reduce(or_, [F.contains(x, F.lit(phrase)) for phrase in BOILERPLATE]))


def line_fails(line: Column, suspect: Column, rules: Rules) -> Column:
    """Whether one line breaks the punctuation, symbol, navigation or boilerplate rule. Its words are what single
    blanks part. ``suspect``: whether the text has a boilerplate phrase at all."""
    least = min(rules.symbols_per_ten_words, rules.separators_per_ten_words)
    n = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    return (
        ~F.rlike(F.right(F.rtrim(line), F.lit(3)), F.lit(SENTENCE_END))
        | ((10 * F.regexp_count(line, F.lit(MARKS)) > least * n)
           & ((10 * F.regexp_count(line, F.lit(SYMBOLS)) > rules.symbols_per_ten_words * n)
              | (10 * F.regexp_count(line, F.lit(SEPARATORS)) > rules.separators_per_ten_words * n)))
        | (suspect & names_boilerplate(line))
    )


def repeated_words(w: Column) -> Column:
    """How many words lie in 5-word windows found twice or more in the text. Windows are compared by a 64-bit hash
    within one text. Texts without a repeat, most of them, end at the distinct count."""
    def counted(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            twin = lambda e, j: ((j > 0) & (F.get(p, j - 1)["h"] == e["h"])) | F.coalesce(F.get(p, j + 1)["h"] == e["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(p, twin), lambda e: e["i"]))

        def covered(s: Column) -> Column:
            gaps = F.transform(s, lambda v, k: F.least(F.coalesce(F.get(s, k + 1) - v, F.lit(5)), F.lit(5)))
            return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

        repeats = let(let(placed, starts), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(repeats)

    def windows(v: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(v) - 5)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(v, i + k) for k in range(5)]))

    return let(w, lambda v: F.when(F.size(v) >= 6, let(windows(v), counted)).otherwise(F.lit(0)))


def kept_lines(text: Column, rules: Rules = Rules()) -> Column:
    """The lines that pass; lines without a word pass."""
    has_word = lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0
    return let(names_boilerplate(text), lambda suspect: F.filter(F.split(text, "\n", -1), lambda x: ~has_word(x) | ~line_fails(x, suspect, rules)))


def assess(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per document with the base counts, the cleaned text and the verdict.

    ``base_failed``: under ``min_words`` words, or too many words in repeated windows. ``kept``: not base_failed, and
    the lines that fail hold no more than ``lost_percent`` of the characters in words.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = documents.select(F.col(doc_id).alias("doc_id"), whole.alias("whole"), words(whole).alias("w"))
    lines = F.filter(F.split("whole", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    counted = base.select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        solid_chars(F.col("whole")).cast("long").alias("word_chars"),
        F.regexp_count("whole", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).cast("long").alias("n_repeat_words"),
        F.array_join(kept_lines(F.col("whole"), rules), "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))
    left = solid_chars(F.col("clean_text"))
    judged = counted.withColumn("lost_chars", F.col("word_chars") - left).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= rules.lost_percent * F.col("word_chars")))


def accepted(text: Column, rules: Rules = Rules()) -> Column:
    """The verdict of ``assess`` as one expression, for filtering documents as they stand."""
    def judged(w: Column) -> Column:
        clean = F.array_join(kept_lines(whole, rules), "\n")
        total = solid_chars(whole)
        lost = total - solid_chars(clean)
        return (F.size(w) >= rules.min_words) & (100 * repeated_words(w) <= rules.repeat_percent * F.size(w)) & (100 * lost <= rules.lost_percent * total)
    whole = F.coalesce(text, F.lit(""))
    return let(words(whole), judged)
