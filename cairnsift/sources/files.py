"""Listings, catalog documents, decision documents and text files.

Each reader is a thin file scan over a frame-level function, so that tables already in
Spark go through the same code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cairnsift.functions import names
from cairnsift.sources import blocks

ROW = T.StructType([
    T.StructField("sample_id", T.StringType()), T.StructField("raw_file", T.StringType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
])
DECLARED = T.StructType([T.StructField(n, T.StringType()) for n in ("chromatography", "ion_mode", "acquisition_mode")])
CATALOG = T.StructType([
    T.StructField("accession", T.StringType()), T.StructField("repository", T.StringType()),
    T.StructField("units", T.ArrayType(T.StructType([
        T.StructField("unit_id", T.StringType()), T.StructField("source_subrecord_id", T.StringType()),
        T.StructField("declared", DECLARED), T.StructField("rows", T.ArrayType(ROW))]))),
])
ANALYSIS = T.StructType([T.StructField(n, T.StringType()) for n in (
    "file_path", "file_name", "file_type", "class_id", "acquisition_type", "batch_order", "analytical_order", "factor")])
CANDIDATES = ("alignment_master_id", "annotator_id", "candidate_rank", "inchikey", "is_reference_matched", "is_representative")
ITEM_FIELDS = ("row_index", "sample_id", "raw_file", "member_path", "archive", "role", "ion_mode", "chromatography",
               "acquisition_mode", "basis", "confidence", "rationale", "reason", "belongs_to_unit", "detail", "rule_id")


# ---- archive listings ---------------------------------------------------------

def clean_listing(raw: DataFrame) -> DataFrame:
    """Members of a listing table: header names without case, files only, canonical path and checksum."""
    found = {c.lower(): c for c in raw.columns}
    crc = found.get("crc32") or found.get("crc")
    if "path" not in found or "size" not in found or crc is None:
        raise ValueError("an archive listing needs path, size and crc32 columns")
    kept = raw
    if "type" in found:
        kept = kept.where(F.coalesce(F.col(found["type"]), F.lit("")).isin("file", ""))
    archive = F.col(found["archive"]) if "archive" in found else F.lit(None).cast("string")
    return kept.select(
        archive.alias("archive"), names.norm_path(found["path"]).alias("path"),
        F.when(F.trim(F.coalesce(F.col(found["size"]).cast("string"), F.lit(""))) == "", F.lit(0)).otherwise(F.col(found["size"]).cast("string").try_cast("bigint")).alias("size"),
        F.upper(F.coalesce(F.col(crc), F.lit(""))).alias("crc32"))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, sep="\t", header=True, encoding="UTF-8")
    return clean_listing(raw)


def listing_index(raw: DataFrame, order: list[str]) -> DataFrame:
    """One row per case-folded path, the first by ``order``; a size that is no whole number is flagged."""
    entry = F.struct("archive", F.col("crc32"), F.col("size").cast("string").alias("size"))
    first = (raw.withColumn("path_key", F.lower(names.norm_path("path"))).where("path_key <> ''")
             .groupBy("path_key").agg(F.min_by(entry, F.struct(*order)).alias("e")))
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    size = blank(F.col("e.size"))
    return first.select(
        "path_key", blank(F.col("e.archive")).alias("archive"),
        F.lpad(F.upper(blank(F.col("e.crc32"))), 8, "0").alias("crc32"),
        size.try_cast("bigint").alias("size"),
        (size.isNotNull() & ~size.rlike("^[0-9]+$")).alias("bad_size"))


# ---- catalog documents --------------------------------------------------------

def catalog_rows(units: DataFrame, sidecar: DataFrame | None = None) -> DataFrame:
    """Rows of catalog units by position; a unit's sidecar rows stand in place of its own.

    ``units(unit_id, rows)``, ``sidecar(unit_id, rows)``: one document a unit."""
    docs = units.select("unit_id", "rows")
    if sidecar is not None:
        docs = docs.join(sidecar.select("unit_id", F.col("rows").alias("own")), "unit_id", "left").select(
            "unit_id", F.coalesce("own", "rows").alias("rows"))
    return docs.select("unit_id", F.posexplode("rows").alias("row_index", "r")).select(
        "unit_id", "row_index", "r.sample_id", "r.raw_file", "r.attributes")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.schema(CATALOG).json(path, multiLine=True)
    return docs.select("accession", "repository", F.explode("units").alias("u")).select("accession", "repository", "u.*")


# ---- decision documents -------------------------------------------------------

REVISED = r"^(.+?)(?:\.r([0-9]+))?\.json$"


def current_documents(files: DataFrame, name: str = "file_name", tie: str | None = None) -> DataFrame:
    """The current file per unit: the highest revision, the base file counting as revision 0."""
    parts = files.withColumn("unit_file", F.regexp_extract(name, REVISED, 1)).withColumn(
        "revision", F.coalesce(F.nullif(F.regexp_extract(name, REVISED, 2), F.lit("")).try_cast("bigint"), F.lit(0)))
    body = F.struct(*[c for c in parts.columns if c != "unit_file"])
    order = F.struct("revision", tie) if tie else F.col("revision")
    return parts.where("unit_file <> ''").groupBy("unit_file").agg(
        F.max_by(body, order).alias("d"), F.count(F.lit(1)).alias("revisions")).select("unit_file", "d.*", "revisions")


def read_payloads(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    docs = spark.read.schema(schema).json(folder, multiLine=True, pathGlobFilter="*.json").withColumn(
        "file_name", F.col("_metadata.file_name"))
    return current_documents(docs)


def payload_items(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Kept rows, added members, excluded rows and excluded members as one long table with ``kind``."""
    arrays = {"row": "rows", "added_member": "added_members", "excluded_row": "excluded_rows",
              "excluded_member": "excluded_members"}
    def tag(kind: str, column: str) -> Column:
        have = set(documents.schema[column].dataType.elementType.fieldNames())

        def long(x: Column) -> Column:
            fields = []
            for f in ITEM_FIELDS:
                kindred = "bigint" if f == "row_index" else "string"
                fields.append((x[f] if f in have else F.lit(None)).cast(kindred).alias(f))
            return F.struct(F.lit(kind).alias("kind"), *fields)

        return F.transform(column, long)

    tagged = [tag(kind, column) for kind, column in arrays.items()]
    # One pass over the documents: the four arrays are joined and exploded once.
    return documents.select(*keep, F.explode(F.flatten(F.array_compact(F.array(*tagged)))).alias("i")).select(*keep, "i.*")


# ---- text ---------------------------------------------------------------------

def lines(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Lines of whole texts with their number from 1."""
    parts = F.split(F.regexp_replace(text, "\r\n", "\n"), "\n")
    return texts.select(key, F.posexplode(parts).alias("_p", "line")).select(
        key, (F.col("_p") + 1).cast("bigint").alias("line_no"), "line")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


KEY_LINE = r"^([A-Z]{2}:[A-Z0-9_]+|SUBJECT_SAMPLE_FACTORS)\s*\t(.*)$"
EXTRACT_KEY = r"^(CH:|MS:|SP:SAMPLEPREP_SUMMARY$|AN:ANALYSIS_TYPE$)"


def key_values(numbered: DataFrame, key: str, cut: int = 600) -> DataFrame:
    """Repeated keys of key-value text joined in line order, cut at a limit with a marker of the first line.

    A text's own lines are one document, so a key's pieces are bounded by that document."""
    hits = numbered.select(key, "line_no", F.regexp_extract("line", KEY_LINE, 1).alias("k"),
                           F.trim(F.regexp_extract("line", KEY_LINE, 2)).alias("v")).where(F.col("k").rlike(EXTRACT_KEY))
    pieces = hits.groupBy(key, "k").agg(
        F.array_sort(F.collect_list(F.when(F.col("v") != "", F.struct("line_no", "v")))).alias("p"), F.min("line_no").alias("first_line"))
    joined = F.array_join(F.transform("p", lambda x: x["v"]), " ")
    return pieces.select(key, "k", "first_line", F.when(F.length(joined) <= cut, joined).otherwise(
        F.concat(F.rtrim(F.substring(joined, 1, cut)), F.lit(" [cut; line "), F.col("first_line").cast("string"), F.lit("]"))).alias("value"))


def sample_factors(numbered: DataFrame, key: str) -> DataFrame:
    """Factor maps of samples; the first factor line of a sample wins."""
    hits = numbered.where(F.regexp_extract("line", KEY_LINE, 1) == "SUBJECT_SAMPLE_FACTORS").select(
        key, "line_no", F.split(F.trim(F.regexp_extract("line", KEY_LINE, 2)), "\t").alias("p")).where(F.size("p") >= 2)

    def pairs(part: Column, between: str, sign: str) -> Column:
        cells = F.filter(F.split(F.coalesce(part, F.lit("")), between), lambda c: c.contains(sign))
        return F.transform(cells, lambda c: F.struct(
            F.trim(F.substring_index(c, sign, 1)).alias("name"),
            F.trim(F.substr(c, F.instr(c, sign) + 1)).alias("value")))

    found = hits.select(key, "line_no", F.trim(F.col("p")[1]).alias("sample"), F.concat(
        pairs(F.get("p", F.lit(2)), r" \| ", ":"), pairs(F.get("p", F.lit(3)), ";", "=")).alias("f"))
    first = found.groupBy(key, "sample").agg(F.min_by("f", "line_no").alias("f"))
    return first.select(key, "sample", F.explode("f").alias("f")).select(key, "sample", "f.name", "f.value")


def sample_names(numbered: DataFrame, key: str) -> DataFrame:
    """Names that the Samples lines list."""
    return numbered.where(F.col("line").startswith("Samples\t")).select(
        key, F.explode(F.filter(F.split("line", "\t"), lambda x, i: i > 0)).alias("sample")).select(
        key, F.trim("sample").alias("sample")).where("sample <> ''").distinct()


def json_lines(numbered: DataFrame, key: str) -> DataFrame:
    """Lines of JSONL texts that are values of a table; blank ones are skipped and renumbered, an unreadable one keeps a
    null entry. A value's lines are numbered inside it; ``blocks.json_lines`` reads files of any size."""
    kept = numbered.where(F.trim("line") != "")
    entry = F.from_json("line", T.MapType(T.StringType(), T.StringType()))
    ok = F.get_json_object("line", "$").startswith("{")
    own = Window.partitionBy(key).orderBy("line_no")
    return kept.select(key, F.row_number().over(own).cast("bigint").alias("line_no"), F.col("line").alias("raw_line"),
                       F.when(ok, entry).alias("entry"))


def decode_content(content: Column | str) -> Column:
    """Bytes as text: UTF-16 when a byte-order mark says so, else UTF-8 without its mark. What neither can read becomes
    U+FFFD."""
    return blocks.decoded(F.col(content) if isinstance(content, str) else content)


def scan_files(spark: SparkSession, root: str) -> DataFrame:
    """Whole files, one row each, with digests: for documents of up to 2 GB. ``blocks.file_lines`` reads files of any size."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    relative = F.regexp_replace("path", r"^[a-z]+:/*\Q" + root.strip("/") + r"\E/?", "")
    return files.select(F.regexp_replace(relative, "^/", "").alias("relative_path"), decode_content("content").alias("text"),
                        F.length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def id_list(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Ids of a list text, each once in order: a JSON list, an object with units or unit_ids, or ids parted by
    commas, blanks or lines with ``#`` comments."""
    ids = T.ArrayType(T.StringType())
    value = F.trim(F.col(text))
    member = F.coalesce(F.get_json_object(value, "$.units"), F.get_json_object(value, "$.unit_ids"))
    listed = (F.when(value.startswith("["), F.from_json(value, ids)).when(value.startswith("{"), F.from_json(member, ids))
              .otherwise(F.split(F.regexp_replace(value, "#[^\n]*", ""), r"[\s,]+")))
    flat = texts.select(key, F.posexplode(listed).alias("_p", "id")).select(key, "_p", F.trim("id").alias("id")).where("id <> ''")
    return flat.groupBy(key, "id").agg(F.min("_p").alias("position"))


def read_candidates(spark: SparkSession, paths: str | list[str], columns: tuple[str, ...] = CANDIDATES) -> DataFrame:
    """Candidate tables; a field may be of any length, and only the named columns are read."""
    raw = spark.read.csv(paths, sep="\t", header=True, maxCharsPerColumn=-1, quote="")
    return raw.select(*columns)


def read_analysis_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANALYSIS).csv(path, header=True)


def clean_candidates(raw: DataFrame) -> DataFrame:
    """Candidate rows in types: stripped ids, numeric rank, flags as booleans."""
    flag = lambda c: F.lower(F.trim(F.col(c))).isin("1", "true", "yes")
    return raw.select(
        F.trim("alignment_master_id").alias("feature"), F.col("annotator_id"),
        F.trim("candidate_rank").try_cast("double").alias("candidate_rank"), F.col("inchikey").alias("structure_key"),
        flag("is_reference_matched").alias("is_reference_matched"), flag("is_representative").alias("is_representative"))
