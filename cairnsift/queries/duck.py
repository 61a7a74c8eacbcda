"""Counterpart SQL expressions for DuckDB (RE2: no look-around)."""

from __future__ import annotations

RAW = "raw|mzml|mzxml|mzdata|wiff|wiff2|d|lcd|cdf|abf|ibf|baf|tdf"


def norm(p: str) -> str:
    return f"trim(replace({p}, chr(92), '/'), '/')"


def root(p: str) -> str:
    return f"regexp_replace({norm(p)}, '(?i)^(.*?\\.(?:d|raw))/.+$', '\\1')"


def key(p: str) -> str:
    return f"lower({root(p)})"


def base(p: str) -> str:
    return f"regexp_extract({norm(p)}, '([^/]*)$', 1)"


def folder(k: str) -> str:
    return f"regexp_extract({k}, '^(.*)/[^/]*$', 1)"


def stem(p: str) -> str:
    return f"regexp_replace({base(p)}, '(?i)\\.(raw|mzml|mzxml|mzdata|wiff2?|d|lcd|cdf)$', '')"


def in_folder(p: str) -> str:
    return f"regexp_matches({norm(p)}, '(?i)^(.*?\\.(?:d|raw))/.+')"


def metadata(p: str) -> str:
    return f"(starts_with({norm(p)}, '__MACOSX/') OR starts_with({base(p)}, '._'))"


def rawlike(p: str) -> str:
    return f"(NOT {metadata(p)} AND (regexp_matches({base(p)}, '(?i)\\.({RAW})$') OR {in_folder(p)}))"


def convert(p: str) -> str:
    return f"regexp_matches({norm(p)}, '(?i)\\.(mzxml|mzdata)$')"


def polarity(p: str) -> str:
    """The single polarity a path's tokens name; the look-ahead is a consumed non-letter or the end,
    on text with every hit's end doubled by a blank so that adjacent hits are all seen."""
    n = norm(p)
    pos = f"regexp_matches({n}, '(?i)(positive|pos)([^a-z]|$)')"
    neg = f"regexp_matches({n}, '(?i)(negative|neg)([^a-z]|$)')"
    return f"(CASE WHEN {pos} AND NOT {neg} THEN 'positive' WHEN {neg} AND NOT {pos} THEN 'negative' END)"


def chromatography(p: str) -> str:
    n = norm(p)
    hil = f"regexp_matches({n}, '(?i)hilic')"
    rp = (f"regexp_matches({n}, '(?i)((^|[^a-z])c(18|30|8)([^0-9]|$)|rplc|(^|[^a-z])rp([^a-z]|$)|rp(pos|neg))')")
    return f"(CASE WHEN {hil} AND NOT {rp} THEN 'HILIC' WHEN {rp} AND NOT {hil} THEN 'RP' END)"
