"""Readings of file names and paths (all native Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cairnsift import vocab


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def norm_path(path: Column | str) -> Column:
    """One separator, none at either end."""
    return F.btrim(F.translate(_c(path), "\\", "/"), F.lit("/"))


def in_vendor_folder(path: Column | str) -> Column:
    return norm_path(path).rlike(vocab.VENDOR_FOLDER)


def vendor_root(path: Column | str) -> Column:
    """The vendor folder a path lies in, else the path itself."""
    return F.regexp_replace(norm_path(path), vocab.VENDOR_FOLDER + "$", "$1")


def member_key(path: Column | str) -> Column:
    return F.lower(vendor_root(path))


def basename(path: Column | str) -> Column:
    return F.substring_index(norm_path(path), "/", -1)


def folder_key(key: Column | str) -> Column:
    return F.regexp_extract(_c(key), "^(.*)/[^/]*$", 1)


def folder_prefix(path: Column | str) -> Column:
    return F.concat(F.lower(norm_path(path)), F.lit("/"))


def stem(path: Column | str) -> Column:
    return F.regexp_replace(basename(path), vocab.STEM_SUFFIX, "")


def ext_known(path: Column | str) -> Column:
    return F.lower(F.regexp_extract(_c(path), vocab.STEM_SUFFIX, 1))


def ext_any(path: Column | str) -> Column:
    """The last dotted part of the name, folded, with its dot; empty when there is none."""
    return F.lower(F.regexp_extract(basename(path), r"(\.[^.]*)$", 1))


def ext_shown(path: Column | str) -> Column:
    found = F.regexp_extract(basename(path), r"(\.[^.]*)$", 1)
    return F.when(found == "", F.lit("(none)")).otherwise(found)


def name_key(raw_file: Column | str) -> Column:
    name = basename(raw_file)
    return F.when(stem(raw_file) == name, F.concat(F.lit("stem:"), F.lower(name))).otherwise(
        F.concat(F.lit("name:"), F.lower(name)))


def _suffix(values: tuple[str, ...]) -> str:
    return "(?i)(" + "|".join(v.replace(".", r"\.") for v in values) + ")$"


# The same tests on the path as it is written, either separator, so that a filter reads it once per test.
_SEP = r"[\\/]"
METADATA_TEST = rf"^{_SEP}*__MACOSX{_SEP}.*[^\\/]|(^|{_SEP})\._[^\\/]*{_SEP}*$"
RAW_TEST = "(?i)(" + "|".join(e.replace(".", r"\.") for e in vocab.RAW_EXTENSIONS) + rf"){_SEP}*$|\.(?:d|raw){_SEP}.*[^\\/]"


def is_archive_metadata(path: Column | str) -> Column:
    return _c(path).rlike(METADATA_TEST)


def is_raw_like(path: Column | str) -> Column:
    return ~_c(path).rlike(METADATA_TEST) & _c(path).rlike(RAW_TEST)


def is_nested_archive(path: Column | str) -> Column:
    return norm_path(path).rlike(_suffix(vocab.NESTED_ARCHIVES)) & ~is_raw_like(path) & ~basename(path).startswith("._")


def needs_conversion(path: Column | str) -> Column:
    return _c(path).rlike(_suffix(vocab.CONVERSION_EXTENSIONS)[:-1] + _SEP + "*$")


def is_runnable(path: Column | str) -> Column:
    return is_raw_like(path) & ~needs_conversion(path)


def loose_stem(name: Column | str) -> Column:
    return F.lower(F.regexp_replace(stem(name), "(?i)pos(?:itive)?|neg(?:ative)?|[^a-z0-9]", ""))


def encoding_rank(path: Column | str) -> Column:
    """0 vendor, 1 re-encoding, 2 mzML, 3 mzXML; null for what is no analysis file."""
    name = norm_path(path)
    chain = F.lit(None).cast("int")
    for rank, pattern in reversed(vocab.ENCODING_RANKS):
        chain = F.when(name.rlike(pattern), F.lit(rank)).otherwise(chain)
    return chain


def encoding_stem(path: Column | str) -> Column:
    """The lower-case name without packing and encoding suffixes."""
    bare = F.regexp_replace(F.lower(basename(path)), r"\.(zip|gz|lzma)$", "")
    return F.regexp_replace(bare, r"\.(raw|d|wiff2?|lcd|baf|tdf|cdf|abf|ibf|i?mzml|mzxml|mzdata)$", "")


def path_polarities(path: Column | str) -> Column:
    """Polarities the folders name (a whole folder, or a part of it between separators)."""
    folders = folder_key(norm_path(path))
    hit = lambda word: folders.rlike(rf"(?i)(^|[/_\- ])({word})([/_\- ]|$)")
    return F.array_compact(F.array(
        F.when(hit("neg|negative"), F.lit("negative")), F.when(hit("pos|positive"), F.lit("positive"))))


def glob_to_regex(glob: str) -> str:
    """A shell pattern as an anchored regular expression over folded text."""
    out, i = ["(?s)^"], 0
    while i < len(glob):
        ch = glob[i]
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[" and "]" in glob[i + 2:]:
            end = glob.index("]", i + 2)
            body = glob[i + 1:end]
            out.append("[" + ("^" + body[1:] if body[0] == "!" else body).replace("\\", "\\\\") + "]")
            i = end
        else:
            out.append("".join(f"\\{ch}" if not ch.isalnum() and ch not in "_/ " else ch))
        i += 1
    return "".join(out) + "$"
