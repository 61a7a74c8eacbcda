"""Digests, canonical forms, cells, redaction and versions."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from cairnsift import vocab
from cairnsift.functions.names import _c


def canonical_json(fields: Mapping[str, Column]) -> Column:
    """JSON text with sorted keys, no blanks and nulls kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def sha256(value: Column | str) -> Column:
    return F.sha2(_c(value).cast("binary"), 256)


def portable_path(cell: Column | str, root: Column | str) -> Column:
    """An absolute path as ``.``, relative to the root, ``../`` beside it, or ``<external>/name``."""
    value = _c(cell)
    path = F.translate(F.trim(value), "\\", "/")
    base = F.rtrim(F.translate(_c(root), "\\", "/"), F.lit("/"))
    beside = F.when(base.contains("/"), F.regexp_replace(base, "/[^/]*$", "")).otherwise(base)
    low, lbase, lbeside = F.lower(path), F.lower(base), F.lower(beside)
    inside = F.substr(path, F.length(base) + 2)
    return (F.when(~F.trim(value).rlike(vocab.ABSOLUTE_CELL) | (base == ""), value)
            .when(low == lbase, F.lit("."))
            .when(low.startswith(F.concat(lbase, F.lit("/"))), inside)
            .when(low.startswith(F.concat(lbeside, F.lit("/"))), F.concat(F.lit("../"), F.substr(path, F.length(beside) + 2)))
            .otherwise(F.concat(F.lit("<external>/"), F.substring_index(path, "/", -1))))


def redact(value: Column | str, locations: Mapping[str, str]) -> Column:
    """Known locations and their folders replaced by names, in either separator and any case.

    ``locations`` is a small, caller-given table, so each entry becomes one JVM-side replacement."""
    def pattern(text: str) -> str:
        parts = [p for p in text.replace("\\", "/").split("/")]
        return "(?i)" + r"(?:/|\\\\|\\)".join(r"\Q" + p + r"\E" if p else "" for p in parts)

    out = _c(value)
    for name, location in sorted(locations.items(), key=lambda kv: -len(kv[1])):
        place = location.strip()
        if not place:
            continue
        out = F.regexp_replace(out, pattern(place), f"<library:{name}>")
        folder = place.replace("\\", "/").rsplit("/", 1)[0] if "/" in place.replace("\\", "/") else ""
        if len(folder) > 3:
            out = F.regexp_replace(out, pattern(folder), "<library-directory>")
    return out


def redact_json(value: Column | str, locations: Mapping[str, str]) -> Column:
    """``redact`` for every string and every key of a JSON text, at any depth; null where the text is no JSON.

    The text is read and written anew first, so that each character has one spelling: a separator is then a slash, a
    backslash (two characters in JSON) or a doubled backslash (four)."""
    def part(text: str) -> str:
        return r"\Q" + json.dumps(text, ensure_ascii=False)[1:-1] + r"\E" if text else ""

    def pattern(text: str) -> str:
        return "(?i)" + r"(?:/|\\\\\\\\|\\\\)".join(part(p) for p in text.replace("\\", "/").split("/"))

    out = F.to_json(F.try_parse_json(_c(value)))
    for name, location in sorted(locations.items(), key=lambda kv: -len(kv[1])):
        place = location.strip()
        if not place:
            continue
        label = json.dumps(f"<library:{name}>", ensure_ascii=False)[1:-1].replace("\\", r"\\").replace("$", r"\$")
        out = F.regexp_replace(out, pattern(place), label)
        folder = place.replace("\\", "/").rsplit("/", 1)[0] if "/" in place.replace("\\", "/") else ""
        if len(folder) > 3:
            out = F.regexp_replace(out, pattern(folder), "<library-directory>")
    return out


def identity_block(key: Column | str, length: int = 14) -> Column:
    text = F.trim(F.coalesce(_c(key), F.lit("")))
    return F.when(F.length(text) >= length, F.upper(F.substring(text, 1, length))).otherwise("")


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.when(whole != 0, F.round(part / whole, digits))


def parse_iso(value: Column | str) -> Column:
    return F.try_to_timestamp(_c(value))


def version_tuple(value: Column | str) -> Column:
    return F.slice(F.transform(F.regexp_extract_all(F.coalesce(_c(value), F.lit("")), F.lit(r"(\d+)"), F.lit(1)),
                               lambda p: p.try_cast("bigint")), 1, 3)


def legacy_policy(version: Column | str) -> Column:
    """Whether a version is a dotted number before the policy; a missing or odd one is not."""
    text = F.coalesce(_c(version), F.lit(""))
    parts = F.transform(F.split(text, r"\."), lambda p: p.try_cast("bigint"))
    return F.when(text.rlike(r"^\d+(\.\d+)*$"), parts < F.array(*[F.lit(v).cast("bigint") for v in vocab.POLICY_VERSION])).otherwise(F.lit(False))


def cell(value: Column | str) -> Column:
    return F.trim(F.translate(_c(value).cast("string"), "\n|", " /"))


def attribute_map(attributes: Column | str, scalars: Mapping[str, Column]) -> Column:
    """Attributes that hold something, completed by top-level scalars; an attribute wins over a scalar."""
    own = F.transform_values(F.map_filter(_c(attributes), lambda k, v: v.isNotNull() & (v != "")), lambda k, v: cell(v))
    extra = F.create_map(*[x for k, v in scalars.items() for x in (F.lit(k), cell(v))])
    extra = F.map_filter(extra, lambda k, v: v.isNotNull() & ~F.map_contains_key(own, k))
    return F.map_concat(own, extra)


def fill(template: Column | str, values: Mapping[str, Column]) -> tuple[Column, Column]:
    """(filled text, placeholders without a value). ``values`` maps ``{name}`` or ``{name:arg}`` bodies."""
    out, missing = _c(template), []
    for body, value in values.items():
        mark = "{" + body + "}"
        has = value.isNotNull() & (value != "")
        missing.append(F.when(_c(template).contains(mark) & ~has, F.lit(mark)))
        out = F.when(has, F.replace(out, F.lit(mark), value)).otherwise(out)
    return out, F.array_compact(F.array(*missing))


def size_label(n: Column | str) -> Column:
    size = _c(n)
    chain = F.concat(size.cast("string"), F.lit(" B"))
    for unit, scale in (("kB", 1 << 10), ("MB", 1 << 20), ("GB", 1 << 30)):
        chain = F.when(size >= scale, F.concat(F.format_string("%.1f", F.bround(size / F.lit(float(scale)), 1)), F.lit(f" {unit}"))).otherwise(chain)
    return chain


def clip(value: Column | str, limit: int = 100) -> Column:
    text = F.trim(F.regexp_replace(F.coalesce(_c(value), F.lit("")), r"\s+", " "))
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit - 3), F.lit("...")))
