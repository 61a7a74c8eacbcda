"""Ledger tables, object-store records, status and log outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnsift.sources import blocks

# Column types of the campaign tables.
LEDGER = {
    "meta": "key string, value string",
    "campaign": "campaign_id string, created_at string, pool string, manifest_path string, manifest_digest string, "
                "analysis_purpose string, authorization_sha256 string, policy_json string, profile_json string, pins_json string",
    "approval": "approval_id string, campaign_id string, manifest_digest string, approved_by string, approved_at string, "
                "statement string, covers_json string, recorded_at string, revoked_at string, revoked_by string, revoke_reason string",
    "download_group": "group_id string, unit_count bigint, known_bytes bigint, size_known boolean",
    "unit": "unit_key string, catalog_unit_id string, repository string, accession string, order_index bigint, role string, "
            "parent_unit_key string, download_group_id string, known_bytes bigint, size_known boolean, has_archive boolean, "
            "instrument string, ion_mode string, state string, state_since string, resume_state string, pending_terminal string, "
            "failures bigint, interruptions bigint, next_attempt_at string, terminal_reason string, terminal_detail string, "
            "threshold_step int, minimum_peak_height double, outputs_produced boolean, gate_exit_pre int, gate_exit_final int, "
            "raw_disposition string, downloaded_bytes bigint, disposition_json string",
    "transition": "seq bigint, unit_key string, at timestamp, from_state string, to_state string, boundary string, "
                  "approval_id string, detail_json string",
    "attempt": "attempt_id bigint, unit_key string, step string, started_at timestamp, ended_at timestamp, outcome string, "
               "counted boolean, tool string, arguments_json string, job_id string, detail_json string",
    "console_run": "console_run_id bigint, unit_key string, kind string, requested_at timestamp, job_id string, "
                   "console_sha256 string, timeout_s double, idle_timeout_s double, ended_at timestamp, outcome string",
    "console_slot": "id int, console_run_id bigint, held_since string",
    "gate_verdict": "verdict_id bigint, unit_key string, at timestamp, point string, stage_arg string, strict boolean, "
                    "outcome string, exit_code int, fail_ids_json string, warn_ids_json string, strict_hold_ids_json string",
    "disk_event": "seq bigint, at timestamp, volume string, free_bytes bigint, total_bytes bigint, reserve_bytes bigint, "
                  "needed_bytes bigint, unit_key string, action string",
    "runner": "id int, pid bigint, host string, started_at timestamp, heartbeat_at timestamp, paused boolean, "
              "pause_kind string, pause_reason string, paused_at timestamp",
    "campaign_event": "seq bigint, at timestamp, kind string, unit_key string, detail_json string",
    "request": "request_id bigint, at timestamp, action string, unit_key string, reason string, requested_by string, "
               "handled_at timestamp, handled_detail string",
}
STORE = {
    "index": "url string, url_key string, object_id string, history array<struct<object_id:string>>",
    "claims": "url string, url_key string, unit_id string, state string, object_id string, opened_at string",
    "objects": "schema string, object_id string, state string, name string, urls array<struct<url_key:string>>, "
               "collected_at string, collected_under struct<approval_id:string,boundary:string>, collection_kept array<string>",
}
STATUS_COLUMNS = ("unit_key", "catalog_unit_id", "repository", "accession", "role", "parent_unit_key", "state",
                  "terminal_reason", "report_terms", "outputs_produced", "gate_exit_pre", "gate_exit_final",
                  "raw_disposition", "failures", "interruptions", "run_job_id", "minimum_peak_height", "threshold_step",
                  "workspace", "warnings")


def read_ledger(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The campaign tables with fixed schemas, one Parquet folder each."""
    return {name: spark.read.schema(ddl).parquet(f"{root}/{name}") for name, ddl in LEDGER.items()}


def as_table(frame: DataFrame, name: str) -> DataFrame:
    """A frame in the fixed schema of a campaign table: known columns in their types, the rest null."""
    out = []
    for part in LEDGER[name].split(", "):
        column, kind = part.split(" ", 1)
        out.append((F.col(column) if column in frame.columns else F.lit(None)).cast(kind).alias(column))
    return frame.select(*out)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts per table; a store is empty when all of them are 0."""
    parts = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_store(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Object-store records, one JSON document per file; hidden files are skipped, and a record that cannot be
    read keeps its text in ``unreadable``."""
    out = {}
    for name, ddl in STORE.items():
        raw = (spark.read.schema(ddl + ", unreadable string").option("columnNameOfCorruptRecord", "unreadable")
               .option("recursiveFileLookup", "true").option("pathGlobFilter", "[!.]*.json").json(f"{root}/{name}", multiLine=True))
        out[name] = raw.withColumn("file", F.col("_metadata.file_path"))
    return out


def status_lines(units: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Status rows as cells: lists joined by ``;``, booleans as 0/1, tabs and line ends as blanks, null empty."""
    cells = []
    types = dict(units.dtypes)
    for c in columns:
        kind = types.get(c)
        if kind is None:
            value = F.lit("")
        elif kind.startswith("array"):
            value = F.array_join(c, ";")
        elif kind == "boolean":
            value = F.col(c).cast("int").cast("string")
        else:
            value = F.col(c).cast("string")
        cells.append(F.coalesce(F.translate(value, "\t\n", "  "), F.lit("")).alias(c))
    return units.select(*cells)


def write_status(units: DataFrame, path: str, columns: tuple[str, ...] = STATUS_COLUMNS) -> None:
    status_lines(units, columns).write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="")


def append_plan(existing: DataFrame, rendered: DataFrame, key: str = "seq", line: str = "raw_line") -> DataFrame:
    """What an append-only export must do per line: keep, append, or refuse because an existing line differs."""
    old = existing.select(F.col(key), F.col(line).alias("old_line"))
    new = rendered.select(F.col(key), F.col(line).alias("new_line"))
    both = old.join(new, key, "full_outer")
    return both.select(key, "old_line", "new_line",
                       F.when(F.col("old_line").isNull(), "append")
                       .when(F.col("new_line").isNull() | (F.col("old_line") != F.col("new_line")), "refuse").otherwise("keep").alias("action"))


def append_log(existing: DataFrame, rendered: DataFrame, path: str, key: str = "seq", line: str = "raw_line") -> int:
    """Append the new lines, or refuse as a whole. Returns the number of lines appended."""
    plan = append_plan(existing, rendered, key, line)
    counts = {r["action"]: r["n"] for r in plan.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts.get("refuse"):
        raise ValueError(f"{counts['refuse']} existing line(s) differ from the rendered log")
    fresh = plan.where("action = 'append'").select(key, F.col("new_line").alias(line))
    fresh.write.mode("append").parquet(path)
    return counts.get("append", 0)


# ---- what a store's folders hold beside its records ----------------------------

# A member manifest's columns, and what stands for a tab, a break and a backslash in a path.
MEMBERS_HEADER = "path\tsize\tcrc\tmtime_ns"


def manifest_rows(lines: DataFrame) -> DataFrame:
    """Rows of member manifests, from lines with ``object_id``, ``line_no`` and ``text``: ``path``, ``size``, ``mtime_ns``,
    and ``bad`` for a first line that is no header and a line that is no row."""
    parts = F.split("text", "\t", -1)
    path = F.replace(F.get(parts, F.lit(0)), F.lit("\\\\"), F.lit("\0"))
    for mark, meant in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\0", "\\")):
        path = F.replace(path, F.lit(mark), F.lit(meant))
    size, mtime = F.get(parts, F.lit(1)).try_cast("bigint"), F.get(parts, F.lit(3)).try_cast("bigint")
    head = F.col("line_no") == 1
    bad = F.when(head, F.col("text") != MEMBERS_HEADER).otherwise((F.size(parts) != 4) | size.isNull() | mtime.isNull())
    return lines.where(head | (F.col("text") != "")).select("object_id", path.alias("path"), size.alias("size"), mtime.alias("mtime_ns"), bad.alias("bad"), head.alias("_head")).where("bad OR NOT _head").drop("_head")


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all ``o/<object>/members.tsv`` of a store, read as lines: a manifest of any length is many tasks' work."""
    lines = blocks.file_lines(spark, f"{root}/o").where(F.col("relative_path").rlike("^[^/]+/members[.]tsv$"))
    return manifest_rows(lines.select(F.substring_index("relative_path", "/", 1).alias("object_id"), "line_no", F.regexp_replace(blocks.readable("text"), "\r$", "").alias("text")))


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """Names, sizes and times of all files below a folder; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select(blocks.below(F.col("path"), root).alias("path"), F.col("length").alias("size"), (F.unix_millis("modificationTime") * 1_000_000).alias("mtime_ns"))


def read_store_folders(spark: SparkSession, root: str, now_us: int) -> dict[str, DataFrame]:
    """``members`` (what manifests record), ``tree`` (the objects' files as they are), ``partials`` (URL keys with a
    transfer begun) and ``locks`` (name and age of the last heartbeat)."""
    tree = read_files(spark, f"{root}/o").select(F.substring_index("path", "/", 1).alias("object_id"), F.regexp_replace("path", "^[^/]*/", "").alias("path"), "size", "mtime_ns")
    partials = read_files(spark, f"{root}/partial").select(F.regexp_replace(F.substring_index("path", "/", 1), "[.][^.]*$", "").alias("url_key")).distinct()
    locks = read_files(spark, f"{root}/locks").where(F.col("path").endswith(".lock")).select(
        F.regexp_replace("path", "[.]lock$", "").alias("name"), ((F.lit(now_us) - F.col("mtime_ns") / 1000) / 1_000_000).cast("bigint").alias("age_s"))
    return {"members": read_manifests(spark, root), "tree": tree, "partials": partials, "locks": locks}
