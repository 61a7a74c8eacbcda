"""Redaction findings, release projections and the decision export."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift import vocab
from cairnsift.functions import names, text
from cairnsift.session import stored
from cairnsift.sources import blocks

# A library file named with a path: not externalised, and not inside a URL. The file's name is looked for first; only
# where it stands is the token before it searched for "://", as far back as FAR characters.
STOP = r"\s\"'<>()\[\]{},="
FAR = 4000
NOT_IN_URL = rf"(?<!<external>)(?<!<external>\\)(?<!://[^{STOP}]{{0,{FAR}}})"
LIBRARY_PATH = vocab.LIBRARY_FILE.replace("(?i)", "", 1)
SECRET = "|".join(f"(?:{p})" for p in vocab.SECRET_TOKENS)


def is_transcript(path: Column | str) -> Column:
    p = F.lower(F.translate(F.col(path) if isinstance(path, str) else path, "\\", "/"))
    return p.rlike(r"(^|/)transcripts/") | p.endswith(".redacted.jsonl") | p.rlike(r"transcript[^/]*\.jsonl$")


def is_decision_file(path: Column | str) -> Column:
    """A file an agent wrote: a transcript, or under a triage folder but no repository text under inputs (calls aside)."""
    p = F.lower(F.translate(F.col(path) if isinstance(path, str) else path, "\\", "/"))
    return is_transcript(path) | (p.rlike(r"(^|/)triage/") & (~p.rlike(r"(^|/)inputs/") | p.rlike(r"(^|/)calls[^/]*/")))


def term_pattern(terms: Sequence[str]) -> str | None:
    """Names as words; a name in another script wherever it stands."""
    parts = []
    for term in sorted({t.strip() for t in terms if t.strip()}):
        body = re.escape(term)
        parts.append(body if not term.isascii() else rf"(?<![A-Za-z])(?i:{body})(?![A-Za-z])")
    return "|".join(parts) or None


def redaction_rules(terms: Sequence[str] = (), library_names: Sequence[str] = (), context: Sequence[str] = (), secrets: Sequence[str] = ()) -> list[tuple[str, str, str]]:
    """(rule, pattern, scope) in report order; scope is all, transcript or decision."""
    library = LIBRARY_PATH
    if library_names:
        named = "|".join(re.escape(n) for n in sorted(set(library_names)))
        library += rf"|(?:\\\\|\\|/)(?:{named})(?![A-Za-z0-9._-])"
    library = f"(?i)(?={library}){NOT_IN_URL}"
    rules = [(name, pattern, "all") for name, pattern in vocab.PATH_RULES] + [("library_path", library, "all")]
    if context:
        rules.append(("context_block", "|".join(f"(?:{c})" for c in context), "transcript"))
    rules.append(("secret_token", "|".join([SECRET, *[f"(?:{s})" for s in secrets]]), "all"))
    rules.append(("email_address", vocab.EMAIL, "decision"))
    words = term_pattern(terms)
    if words:
        rules.append(("operator_name", words, "all"))
    return rules


# Text without the one character a rule cannot match without is passed over by a plain search.
NEEDS = {"drive_letter_path": ":", "unc_path": "\\\\", "email_address": "@"}


def rule_hits(rules: Sequence[tuple[str, str, str]], path: str, body: Column, cut: Column | None = None) -> Column:
    """Array of ``(rule, pos)``: where each rule first matches in ``body``, from 1. Where ``cut`` holds, what stands
    before the body is not known, so a match must have FAR (a library path) or one character before it."""
    scope = {"all": F.lit(True), "transcript": is_transcript(path), "decision": is_decision_file(path)}

    def place(name: str, pattern: str) -> Column:
        whole = F.regexp_instr(body, F.lit(pattern))
        if cut is None:
            return whole
        inner = pattern.replace(NOT_IN_URL, rf"(?<=[\s\S]{{{FAR + 1}}})" + NOT_IN_URL) if name == "library_path" else rf"(?<=[\s\S])(?:{pattern})"
        return F.when(cut, F.regexp_instr(body, F.lit(inner))).otherwise(whole)

    hits = [F.when(scope[s] & body.contains(NEEDS.get(name, "")), F.struct(F.lit(name).alias("rule"), place(name, pattern).alias("pos"))) for name, pattern, s in rules]
    return F.filter(F.array(*hits), lambda h: h["pos"] > 0)


def redaction_findings(files: DataFrame, rules: Sequence[tuple[str, str, str]], path: str = "relative_path", body: str = "text") -> DataFrame:
    """The first match of each rule in each file, by byte offset and line, over whole texts in one scan."""
    found = files.select(F.col(path).alias("file"), F.col(body).alias("_t"), F.explode(rule_hits(rules, path, F.col(body))).alias("h"))
    before = F.expr("substr(_t, 1, h.pos - 1)")
    return found.select("file", "h.rule", F.octet_length(before).cast("bigint").alias("at"),
                        (F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("line"))


PIECE, AROUND = 1 << 20, 8192


def redaction_scan(raw: DataFrame, rules: Sequence[tuple[str, str, str]], piece: int = PIECE) -> DataFrame:
    """The first match of each rule in each file of any size, over the rows of ``blocks.raw_lines``.

    No text is shuffled: rules run on lines where they are read, each with the break before it, and long lines in
    overlapping pieces; a match that two pieces see is the same place. Offsets are worked out for the rows with a first
    match only, from prefix sums over blocks of rows."""
    line = F.concat(F.lit("\n"), F.col("text"))
    parts = raw.select("relative_path", "split", "seq", F.explode(blocks.pieces(line, piece, AROUND)).alias("p"))
    hits = parts.select("relative_path", "split", "seq", "p.at", F.explode(rule_hits(rules, "relative_path", F.col("p.text"), F.col("p.at") > 0)).alias("h"))
    # -1 is the break before the line.
    place = F.greatest(F.col("at") - AROUND, F.lit(0)) + F.col("h.pos") - 2
    first = stored(hits.select("relative_path", "h.rule", F.struct("split", "seq", place.cast("bigint").alias("pos")).alias("w")).groupBy("relative_path", "rule").agg(
        F.min("w").alias("w")).select("relative_path", "rule", "w.split", "w.seq", "w.pos", blocks.block(F.col("w.seq")).alias("block")))
    near = raw.withColumn("block", blocks.block()).join(first.select("relative_path", "split", "block").distinct(), ["relative_path", "split", "block"], "left_semi")
    lines = blocks.placed(near, blocks.block_starts(raw)).select("relative_path", "split", "seq", "offset", "line_no")
    at = F.col("offset") + F.col("pos")
    return first.join(lines, ["relative_path", "split", "seq"]).select(
        F.col("relative_path").alias("file"), "rule", F.greatest(at, F.lit(0)).cast("bigint").alias("at"),
        (F.col("line_no") - ((F.col("pos") < 0) & (at >= 0)).cast("bigint")).alias("line"))


def library_names_in(raw: DataFrame) -> DataFrame:
    """Names in ``<library:NAME sha256=...>`` tokens of files of any size."""
    return library_names(raw.select("text"))


def redaction_verdict(files: DataFrame, found: DataFrame) -> DataFrame:
    """refused when anything was found, else pass (one row)."""
    n = found.agg(F.count(F.lit(1)).alias("findings"))
    f = files.agg(F.count(F.lit(1)).alias("files"))
    return f.crossJoin(F.broadcast(n)).select("files", "findings", F.when(F.col("findings") > 0, "refused").otherwise("pass").alias("verdict"))


def library_names(files: DataFrame, body: str = "text") -> DataFrame:
    """Names in ``<library:NAME sha256=...>`` tokens."""
    token = r"<library:([^<>\s]+) sha256=[0-9A-Fa-f]{64}>"
    return files.select(F.explode(F.array_distinct(F.regexp_extract_all(body, F.lit(token), F.lit(1)))).alias("name")).distinct()


def release_index(files: DataFrame, root: str, protected: Column, path: str = "relative_path", body: str = "text") -> DataFrame:
    """One row per released file: digests of the original and of its projected copy. Absolute paths are made portable
    cell by cell; protected files are copied byte for byte."""
    absolute = F.lit(False)
    for _, pattern in vocab.PATH_RULES:
        absolute = absolute | F.col(body).rlike(pattern)
    rows = F.transform(F.split(body, "\n"), lambda line: F.array_join(F.transform(F.split(line, ","), lambda c: text.portable_path(c, F.lit(root))), ","))
    projected = ~protected & absolute
    copy = F.when(projected, F.array_join(rows, "\n")).otherwise(F.col(body))
    return files.select(F.col(path).alias("path"), text.sha256(body).alias("original_sha256"), text.sha256(copy).alias("release_sha256"), projected.alias("projected"))


EXPORT_COLUMNS = (
    "decision_id", "kind", "accession", "unit_id", "supersedes", "revision_cause", "model_id", "agent_context", "skill", "skill_version", "skill_sha256",
    "prompt_template_sha256", "inputs_sha256", "decided_at", "n_rows_kept", "n_rows_excluded", "n_members_added", "n_declared", "n_inferred", "n_low_confidence", "status",
    "validator_verdict", "validator_commit", "gate_verdicts", "n_header_disagreements", "person_review", "reviewer", "approved_manifest_digest", "final_state",
    "rederivation_sampled", "rederivation_agreement", "replay_selection_equal", "replay_inputs_equal", "replay_projection_equal", "replay_projection_schema")


def export_decisions(decisions: DataFrame, items: DataFrame, inputs: DataFrame, verdicts: DataFrame, answers: DataFrame, replays: DataFrame) -> DataFrame:
    """One wide row per decision: counts, verdicts, review state and replay flags; a column nobody gives is null.

    ``items(unit_id, ...)``, ``inputs(unit_id, sha256)``, ``verdicts(unit_id, verdict)``, ``answers(unit_id, by)``,
    ``replays(unit_id, check_id, result)``."""
    kept = F.col("reason").isNull()
    counts = items.groupBy("unit_id").agg(
        F.count_if(kept & (F.col("kind") == "row")).alias("n_rows_kept"), F.count_if(F.col("kind") == "excluded_row").alias("n_rows_excluded"),
        F.count_if(F.col("kind") == "added_member").alias("n_members_added"), F.count_if(kept & (F.col("basis") == "declared")).alias("n_declared"),
        F.count_if(kept & (F.col("basis") == "inferred")).alias("n_inferred"), F.count_if(kept & (F.col("confidence") == "low")).alias("n_low_confidence"))
    # A decision binds a bounded list of inputs (its record), hashed in sorted order.
    bound = inputs.groupBy("unit_id").agg(text.sha256(F.array_join(F.array_sort(F.collect_list("sha256")), "\n")).alias("inputs_sha256"))
    v = verdicts.groupBy("unit_id").agg(F.max_by("verdict", F.array_position(F.array(*[F.lit(x) for x in ("pass", "hold", "error")]), F.col("verdict"))).alias("validator_verdict"))
    a = answers.groupBy("unit_id").agg(F.min("by").alias("reviewer"))
    flag = lambda c: F.bool_and(F.when(F.col("check_id") == c, F.col("result") == "equal"))
    r = replays.groupBy("unit_id").agg(flag("selection").alias("replay_selection_equal"), flag("inputs").alias("replay_inputs_equal"), flag("projection").alias("replay_projection_equal"))
    out = decisions
    for part in (counts, bound, v, a, r):
        out = out.join(part, "unit_id", "left")
    reviewed = F.when(F.col("reviewer").isNull(), "none").when(F.col("supersedes").isNotNull(), "revised").otherwise("answered")
    final = F.when(F.col("status") == "excluded", "excluded").when(F.col("supersedes").isNotNull(), "revised").otherwise("accepted")
    out = out.withColumn("person_review", reviewed).withColumn("final_state", final)
    return out.select(*[F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in EXPORT_COLUMNS])
