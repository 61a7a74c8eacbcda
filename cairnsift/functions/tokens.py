"""Technical words that names and text fields carry."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from cairnsift import vocab
from cairnsift.functions.names import _c, basename, norm_path, stem


def normalise_ion(value: Column | str) -> Column:
    v = F.lower(F.trim(F.coalesce(_c(value).cast("string"), F.lit(""))))
    return (F.when(v.startswith("pos"), "positive").when(v.startswith("neg"), "negative")
            .when(v.isin("both", "positive and negative", "mixed"), "both")
            .when(v.isin("switching", "polarityswitching", "polarity switching", "polarity_switching"), "switching")
            .otherwise("unknown"))


def normalise_chromatography(value: Column | str) -> Column:
    v = F.lower(F.trim(F.coalesce(_c(value).cast("string"), F.lit(""))))
    return (F.when(v.contains("hilic"), "HILIC")
            .when(v.isin("rp", "rplc") | v.rlike("reverse|c18|c8|c30"), "RP")
            .when(v.contains("normal"), "normal_phase")
            .when((v == "") | (v == "unknown"), "unknown").otherwise("other"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def polarity_tokens(path: Column | str, pattern: str = vocab.POLARITY_TOKEN) -> Column:
    """Every polarity the path's tokens name, sorted."""
    hits = F.regexp_extract_all(norm_path(path), F.lit(pattern), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(
        hits, lambda t: F.when(F.lower(t).startswith("pos"), "positive").otherwise("negative"))))


# The token's two readings; separators are no letters, so the path is read as it is written.
POSITIVE, NEGATIVE = (re.sub(r"\(positive\|negative\|pos\|neg\)", f"(?:{both})", vocab.POLARITY_TOKEN) for both in ("positive|pos", "negative|neg"))


def token_polarity(path: Column | str) -> Column:
    """The polarity that all of a path's tokens name; null for none and for both."""
    return let(F.struct(_c(path).rlike(POSITIVE).alias("pos"), _c(path).rlike(NEGATIVE).alias("neg")), lambda t: F.when(
        t["pos"] & ~t["neg"], F.lit("positive")).when(t["neg"] & ~t["pos"], F.lit("negative")))


def chromatography_tokens(path: Column | str) -> Column:
    p = norm_path(path)
    return F.array_compact(F.array(F.when(p.rlike(vocab.HILIC_TOKEN), F.lit("HILIC")),
                                   F.when(p.rlike(vocab.RP_TOKEN), F.lit("RP"))))


def token_chromatography(path: Column | str) -> Column:
    """The chromatography that all of a path's tokens name; null for none and for both."""
    return let(F.struct(_c(path).rlike(vocab.HILIC_TOKEN).alias("hilic"), _c(path).rlike(vocab.RP_TOKEN).alias("rp")), lambda t: F.when(
        t["hilic"] & ~t["rp"], F.lit("HILIC")).when(t["rp"] & ~t["hilic"], F.lit("RP")))


def _capital_words() -> str:
    """The acquisition words as written in capitals, for a word that starts after a lower-case letter. What follows a
    backslash or opens a group is syntax and keeps its case."""
    return re.sub(r"\\.|\(\?[:!<=]*|[a-z]", lambda m: m[0].upper() if m[0].isalpha() else m[0], vocab.ACQUISITION_WORDS)


# No token begins with another letter, which is the cheapest thing to see.
ACQUISITION_PATTERN = (
    f"(?=[ADFHMPSTadfhmpst])((?<![A-Za-z])(?i:{vocab.ACQUISITION_WORDS})(?![A-Za-z])|(?<=[a-z])(?:{_capital_words()})(?![A-Za-z]))"
)


def acquisition_name(token: Column) -> Column:
    t = F.translate(F.lower(token), "-", "")
    return (F.when(t.rlike("^(tdd|targeted|hermes)"), "tDDA").when(t.rlike("^(ddms|dda)"), "DDA")
            .when(t.isin("ms1", "fullscan"), "MS1").when(t == "tms2", "tMS2")
            .when(t.isin("mse", "hdmse"), "MSe").otherwise(F.upper(t)))


def token_acquisition(path: Column | str) -> Column:
    """Every acquisition token that starts a word, canonical, distinct and sorted."""
    hits = F.regexp_extract_all(norm_path(path), F.lit(ACQUISITION_PATTERN), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(hits, acquisition_name)))


def _modes() -> Column:
    pairs = [F.lit(x) for kv in vocab.TOKEN_MODES.items() for x in kv]
    return F.create_map(*pairs)


def modes_of(said: Column) -> Column:
    """The modes that acquisition tokens stand for."""
    table = _modes()
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(said, lambda t: table[t]))))


def token_modes(path: Column | str) -> Column:
    return modes_of(token_acquisition(path))


def _level_pattern() -> str:
    parts = []
    for i, (_, _, pattern, folds) in enumerate(vocab.LEVEL_WORDS):
        body = f"(?i:{pattern})" if folds else f"(?:{pattern})"
        # A word starts after a non-letter, or with a capital after a lower-case letter.
        parts.append(f"(?:(?<![A-Za-z])|(?<=[a-z])(?=[A-Z])){body}")
    return "(" + "|".join(parts) + ")"


LEVEL_PATTERN = _level_pattern()


def ms_level_words(name: Column | str) -> Column:
    """Level words of a name as ``kind:label``, each span read once, in the order of the name."""
    hits = F.regexp_extract_all(_c(name), F.lit(LEVEL_PATTERN), F.lit(1))

    def label(word: Column) -> Column:
        chain = F.lit(None).cast("string")
        for kind, text, pattern, folds in reversed(vocab.LEVEL_WORDS):
            # The word alone decides; what may follow it was checked in the name.
            bare = re.sub(r"(\(\?!(?:[^()]|\([^()]*\))*\))+$", "", pattern)
            chain = F.when(word.rlike(("(?i)" if folds else "") + f"^(?:{bare})$"), F.lit(f"{kind}:{text}")).otherwise(chain)
        return chain

    return F.transform(hits, label)


def product_ion_words(path: Column | str) -> Column:
    """What a name says of product-ion spectra: MS/MS words, and modes of its acquisition tokens but MS1."""
    name = stem(path)
    words = F.transform(F.filter(ms_level_words(name), lambda w: w.startswith("MS/MS:")), lambda w: F.substr(w, F.lit(7)))
    modes = F.filter(token_modes(name), lambda m: m != "MS1")
    return F.array_sort(F.array_union(words, modes))


def acquisition_problem(name: Column | str, mode: Column | str) -> Column:
    """Why a name contradicts a stated acquisition mode: targeted, product_ions, mode; null when it does not.

    The name's tokens are read once; its MS/MS words only where MS1 is stated."""
    stated = F.when(_c(mode) == "targeted_DDA", "DDA").otherwise(_c(mode))
    family = F.array(*[F.lit(m) for m in vocab.DIA_FAMILY])

    def judge(said: Column) -> Column:
        targeted = F.array_intersect(said, F.array(*[F.lit(t) for t in vocab.TARGETED_TOKENS]))
        targets = F.when(F.size(targeted) > 0, F.concat(F.lit("targeted:"), F.array_join(targeted, "+")))
        products = let(F.when(stated == "MS1", product_ion_words(name)), lambda p: F.when(F.size(p) > 0, F.concat(F.lit("product_ions:"), F.array_join(p, "+"))))

        def against(modes: Column) -> Column:
            tolerated = (F.size(modes) == 0) | stated.isin("unknown", "mixed") | F.array_contains(modes, stated) | (
                stated.isin(*vocab.DIA_FAMILY) & F.arrays_overlap(modes, family))
            return F.when(~tolerated, F.concat(F.lit("mode:"), F.array_join(modes, "+")))

        return F.coalesce(targets, products, let(modes_of(said), against))

    return let(token_acquisition(name), judge)


def methods_named(text: Column | str, words: bool = False) -> Column:
    """Fragmentation methods a text names by a whole token outside identifiers, each once, in order."""
    value = F.coalesce(_c(text).cast("string"), F.lit(""))
    value_free = F.regexp_replace(value, vocab.GUID, " . ")
    # A run of letters and digits that is all hexadecimal, and long or with a digit, is an identifier.
    value_free = F.regexp_replace(
        value_free, r"(?<![A-Za-z0-9])(?=[0-9A-Fa-f]*[0-9]|[0-9A-Fa-f]{8})[0-9A-Fa-f]+(?![A-Za-z0-9])", " . ")
    token = "(?i)(?<![A-Za-z0-9])(" + "|".join(sorted(vocab.NON_CID_METHODS, key=len, reverse=True)) + ")(?![A-Za-z])"
    canonical = F.create_map(*[F.lit(x) for m in vocab.NON_CID_METHODS for x in (m.lower(), m)])
    found = F.transform(F.regexp_extract_all(value_free, F.lit(token), F.lit(1)), lambda t: canonical[F.lower(t)])
    if words:
        spelled = "(?i)(" + "|".join(p for _, p in vocab.SPELLED_METHODS) + ")"

        def code(hit: Column) -> Column:
            chain = F.lit(None).cast("string")
            for method, pattern in vocab.SPELLED_METHODS:
                chain = F.when(hit.rlike(f"(?i)^(?:{pattern})$"), F.lit(method)).otherwise(chain)
            return chain

        found = F.concat(found, F.transform(F.regexp_extract_all(value, F.lit(spelled), F.lit(1)), code))
    return F.array_distinct(found)


def methods_in_file_name(path: Column | str) -> Column:
    return methods_named(basename(path))


def stated_methods(attributes: Column | str) -> Column:
    """Methods stated in map entries whose key states a method and is no instrument field."""
    wanted = F.map_filter(_c(attributes), lambda k, v: k.rlike(vocab.STATEMENT_FIELD) & ~k.rlike(vocab.INSTRUMENT_FIELD))
    return F.array_distinct(F.flatten(F.transform(F.map_values(wanted), lambda v: methods_named(v, words=True))))


def instrument_can(method: Column | str, instrument: Column | str) -> Column:
    text = F.trim(F.regexp_replace(F.coalesce(_c(instrument), F.lit("")), r"\s+", " "))
    unrecorded = F.btrim(F.lower(text), F.lit(" .")).isin(*vocab.UNRECORDED_INSTRUMENTS)
    chain = F.lit(True)
    for name, capable, vendors in vocab.METHOD_INSTRUMENTS:
        able = text.rlike("(?i)" + capable) | (text.rlike("(?i)" + vendors) & ~text.rlike("(?i)" + vocab.MODEL_WORDS))
        chain = F.when(_c(method) == name, able).otherwise(chain)
    return unrecorded | chain


def name_polarity(name: Column | str) -> Column:
    """The polarity a library's name states, when it states exactly one."""
    return token_polarity(name)


def non_sample_class(label: Column | str) -> Column:
    return _c(label).rlike(vocab.NON_SAMPLE_CLASS)
