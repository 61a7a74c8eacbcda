"""Hash-chained logs, revision lineage, answers and readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairnsift.functions import text
from cairnsift.operators.checks import by_rules, findings, run_checks
from cairnsift.scale import blocks, ordered
from cairnsift.session import cut_lineage


def chain_check(lines: DataFrame, file: str = "file", width: int = 1 << 16) -> DataFrame:
    """Lines whose sequence is not their number, or whose ``prev_sha256`` is not the digest of the raw line before.

    The raw line is hashed as it stands, never re-rendered. ``lines(file, line_no, raw_line, seq, prev_sha256)``."""
    run = ordered(lines, [file], ["line_no"], blocks("line_no", width), lag={"_expected": text.sha256("raw_line")})
    return run.select(file, "line_no", F.coalesce(F.col("seq") != F.col("line_no"), F.lit(True)).alias("bad_seq"),
                      (~F.col("prev_sha256").eqNullSafe(F.col("_expected"))).alias("bad_prev")).where("bad_seq OR bad_prev")


def log_heads(lines: DataFrame, file: str = "file") -> DataFrame:
    """The digest of each log's last line and its length."""
    return lines.groupBy(file).agg(F.max_by(text.sha256("raw_line"), "line_no").alias("head_sha256"), F.max("line_no").alias("lines"))


class Lineage:
    """The tree of ``supersedes``: roots, depths and ancestor tests by pointer doubling.

    Each round doubles how far a pointer reaches, so a chain of n revisions takes log2(n) rounds and the closure is
    never written out as pairs. A decision on a cycle, or above one, is ``cyclic`` and has no root."""

    def __init__(self, decisions: DataFrame, key: str = "id", parent: str = "supersedes"):
        base = decisions.select(F.col(key).alias("id"), F.col(parent).alias("up")).groupBy("id").agg(F.min("up").alias("up"))
        known = base.select(F.col("id").alias("_k"))
        step = base.join(known, F.col("up") == F.col("_k"), "left").select("id", F.col("_k").alias("up"))
        self.jumps = [cut_lineage(step)]
        # Reach: how many steps lead to the current pointer; settled when the pointer is null.
        reach = self.jumps[0].select("id", F.col("up").alias("p"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint").alias("depth"),
                                     F.coalesce("up", "id").alias("root"))
        reach = cut_lineage(reach)
        # A chain that is still open has a decision on every depth, so each round settles some of it; where a round
        # settles nothing, what is left is on or above a cycle.
        before = -1
        while (left_open := reach.where("p IS NOT NULL").count()) and left_open != before:
            before = left_open
            right = reach.select(F.col("id").alias("_i"), F.col("p").alias("_p"), F.col("depth").alias("_d"), F.col("root").alias("_r"))
            nxt = reach.join(right, F.col("p") == F.col("_i"), "left").select(
                "id", F.col("_p").alias("p"), (F.col("depth") + F.coalesce("_d", F.lit(0))).alias("depth"), F.coalesce("_r", "root").alias("root"))
            reach = cut_lineage(nxt)
            jump = self.jumps[-1]
            far = jump.select(F.col("id").alias("_i"), F.col("up").alias("_u"))
            self.jumps.append(cut_lineage(jump.join(far, F.col("up") == F.col("_i"), "left").select("id", F.col("_u").alias("up"))))
        settled = F.col("p").isNull()
        self.nodes = reach.select("id", F.when(settled, F.col("root")).alias("root"), F.when(settled, F.col("depth")).alias("depth"), (~settled).alias("cyclic"))

    def gathered(self, marks: DataFrame) -> DataFrame:
        """Per decision on no cycle, the codes that it or any decision it supersedes carries: ``id``, ``codes``.

        ``marks(id, code)``, codes from a closed list. Each round doubles how far up a decision has looked and adds what the
        decision there had gathered, so marks travel along the pointers and never meet askers in pairs."""
        own = marks.groupBy(F.col("id").alias("_m")).agg(F.collect_set("code").alias("_own"))
        free = self.nodes.where("NOT cyclic").select("id")
        none = F.array().cast("array<string>")
        at = cut_lineage(free.join(own, F.col("id") == F.col("_m"), "left").select("id", F.coalesce("_own", none).alias("codes")))
        for jump in self.jumps:
            up = jump.where("up IS NOT NULL").select(F.col("id").alias("_i"), F.col("up").alias("_u"))
            there = at.select(F.col("id").alias("_t"), F.col("codes").alias("_codes"))
            told = up.join(there, F.col("_u") == F.col("_t")).select("_i", "_codes")
            at = cut_lineage(at.join(told, F.col("id") == F.col("_i"), "left").select("id", F.array_union("codes", F.coalesce("_codes", none)).alias("codes")))
        return at

    def ancestors(self, pairs: DataFrame, node: str, other: str) -> DataFrame:
        """Pairs whose ``other`` is ``node`` itself or one it supersedes, at any distance."""
        n = self.nodes.select(F.col("id").alias("_n"), F.col("depth").alias("_dn"), F.col("root").alias("_rn"))
        o = self.nodes.select(F.col("id").alias("_o"), F.col("depth").alias("_do"), F.col("root").alias("_ro"))
        left = pairs.join(n, F.col(node) == F.col("_n")).join(o, F.col(other) == F.col("_o")).where("_rn = _ro AND _dn >= _do")
        left = left.withColumn("_at", F.col("_n")).withColumn("_gap", F.col("_dn") - F.col("_do"))
        for k, jump in enumerate(self.jumps):
            hop = jump.select(F.col("id").alias("_i"), F.col("up").alias("_u"))
            bit = F.shiftright("_gap", k).bitwiseAND(F.lit(1).cast("bigint")) == 1
            left = left.join(hop, bit & (F.col("_at") == F.col("_i")), "left").withColumn(
                "_at", F.when(bit, F.col("_u")).otherwise(F.col("_at"))).drop("_i", "_u")
        return left.where(F.col("_at") == F.col("_o")).select(*pairs.columns)


def entry_checks(entries: DataFrame, kinds: dict[str, tuple[str, ...]], payloads: DataFrame) -> DataFrame:
    """Entries of unknown kind, with fields beyond their kind's, or naming a decision that is no payload.

    ``entries(file, line_no, kind, fields array, decision_id)``."""
    common = ("seq", "at", "kind", "decision_id", "prev_sha256")
    extra = F.lit(None).cast("array<string>")
    for kind, fields in kinds.items():
        allowed = F.array(*[F.lit(f) for f in common + fields])
        extra = F.when(F.col("kind") == kind, F.array_except("fields", allowed)).otherwise(extra)
    e = entries.withColumn("_extra", extra).withColumnRenamed("file", "unit_id")
    rules = by_rules(e, "L-ENTRY", F.col("line_no"), {
        "unknown_kind": F.coalesce(~F.col("kind").isin(*kinds), F.lit(True)), "extra_fields": F.size("_extra") > 0})
    lost = e.where("decision_id IS NOT NULL").join(payloads.select(F.col("id").alias("_p")), F.col("decision_id") == F.col("_p"), "left_anti")
    return rules.unionByName(findings(lost, "L-PAYLOAD", "error", F.col("line_no"), "no_payload"))


def cause_checks(revisions: DataFrame, log: DataFrame, lineage: Lineage) -> DataFrame:
    """What is wrong with a revision's cited cause: absent, later, or about a decision it does not supersede.

    ``revisions(file, line_no, new_decision_id, cause_kind, cause_seq)``, ``log(file, seq, kind, decision_id)``."""
    cited = log.select(F.col("file").alias("_f"), F.col("seq").alias("_s"), F.col("kind").alias("_k"), F.col("decision_id").alias("cited_id"))
    both = revisions.join(cited, (F.col("file") == F.col("_f")) & (F.col("cause_seq") == F.col("_s")), "left")
    fine = lineage.ancestors(both.where("cited_id IS NOT NULL").select("file", "line_no", "new_decision_id", "cited_id"), "new_decision_id", "cited_id")
    held = fine.select(F.col("file").alias("_ff"), F.col("line_no").alias("_ll"), F.lit(True).alias("_in"))
    out = both.join(held, (F.col("file") == F.col("_ff")) & (F.col("line_no") == F.col("_ll")), "left")
    why = (F.when(F.col("_k").isNull() | (F.col("_k") != F.col("cause_kind")), "absent").when(F.col("cause_seq") >= F.col("line_no"), "later")
           .when(F.col("_in").isNull(), "other_lineage"))
    return out.where(why.isNotNull()).select("file", "line_no", why.alias("problem"))


def dropped_flags(old: DataFrame, new: DataFrame, revisions: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocking flags a revision drops without an answer: dropped minus answered.

    ``old/new(id, code)``, ``revisions(old_id, new_id)``, ``answers(new_id, code)``."""
    before = revisions.join(old, F.col("old_id") == old["id"]).select("old_id", "new_id", "code")
    after = new.select(F.col("id").alias("new_id"), "code")
    return before.join(after, ["new_id", "code"], "left_anti").join(answers, ["new_id", "code"], "left_anti").distinct()


def open_questions(current: DataFrame, asked: DataFrame, answers: DataFrame, lineage: Lineage) -> DataFrame:
    """Questions and blocking flags of current decisions that no answer in their lineage settles.

    ``current(id)``, ``asked(id, code)``, ``answers(decision_id, code)``."""
    open_ = asked.join(current, "id", "left_semi").distinct()
    settled = lineage.gathered(answers.select(F.col("decision_id").alias("id"), "code")).select("id", F.explode("codes").alias("code"))
    return open_.join(settled, ["id", "code"], "left_anti")


def latest_readings(readings: DataFrame, texts: DataFrame) -> DataFrame:
    """The latest reading per text digest decides; a text without a reading of its present digest is open.

    ``readings(digest, seq, verdict)``, ``texts(id, digest)``."""
    last = readings.groupBy("digest").agg(F.max_by("verdict", "seq").alias("verdict"), F.count(F.lit(1)).alias("readings"))
    return texts.join(last, "digest", "left").select("id", F.coalesce("verdict", F.lit("open")).alias("verdict"), F.coalesce("readings", F.lit(0)).alias("readings"))


def ledger_line_checks(lines: DataFrame, kinds: tuple[str, ...], standings: tuple[str, ...], path_rules: list[tuple[str, str]]) -> DataFrame:
    """Decision-ledger lines of unknown kind or standing, or holding an absolute path."""
    e = lines.withColumnRenamed("file", "unit_id")
    held: Column = F.lit(False)
    for _, pattern in path_rules:
        held = held | F.col("raw_line").rlike(pattern)
    return run_checks([
        by_rules(e, "D-ENTRY", F.col("line_no"), {"kind": ~F.col("kind").isin(*kinds)}),
        by_rules(e, "D-CHAIN", F.col("line_no"), {"standing": ~F.col("standing").isin(*standings)}),
        by_rules(e, "D-PATH", F.col("line_no"), {"absolute_path": held})])


def triage_checks(entries: DataFrame, payloads: DataFrame, files: DataFrame, log_lines: DataFrame, width: int = 1 << 16) -> DataFrame:
    """What decision-ledger lines say about other files: D-TRIAGE where a recorded triage is no payload, or its file is
    not there or another one; D-HEAD where a validated triage names a head that no line of its review log has.

    ``entries(file, line_no, kind, unit_key, triage_sha256, triage_path, derived_sha256, derived_path, head_sha256,
    accession)``, ``payloads(sha256)``, ``files(path, sha256)``, ``log_lines(accession, sha256)``. The review log of a
    validated line is the folder of the latest triage recorded before it for its unit: an as-of join inside the log,
    carried over blocks of lines, so that a unit with a third of all lines is no single task's."""
    slashed = lambda c: F.translate(F.coalesce(F.col(c), F.lit("")), "\\", "/")
    child = F.col("derived_sha256").isNotNull() | F.col("derived_path").isNotNull()
    recorded = F.col("kind") == "triage_recorded"
    e = entries.select("file", "line_no", "kind", "unit_key", "accession", "head_sha256", child.alias("_child"), F.col("triage_sha256").alias("_own_sha"), slashed("triage_path").alias("_own_path"),
                       F.when(child, F.col("derived_sha256")).otherwise(F.col("triage_sha256")).alias("sha"), F.when(child, slashed("derived_path")).otherwise(slashed("triage_path")).alias("path"))
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise("")
    e = e.withColumn("_folder", F.when(recorded & (F.col("path") != ""), F.struct("line_no", folder.alias("folder"))))
    run = ordered(e.withColumn("unit_key", F.coalesce("unit_key", F.lit(""))), ["file", "unit_key"], ["line_no"], blocks("line_no", width), prior_max={"_asof": "_folder"})

    known = payloads.select(F.col("sha256").alias("_known")).distinct()
    there = files.groupBy("path").agg(F.min("sha256").alias("sha256"))
    named = there.select(F.col("path").alias("_p"), F.col("sha256").alias("_actual"))
    children = there.select(F.col("path").alias("_c"), F.col("sha256").alias("_child_actual"))
    rec = run.where(recorded).join(known, F.col("sha") == F.col("_known"), "left").join(named, F.col("path") == F.col("_p"), "left").join(children, F.col("_child") & (F.col("_own_path") == F.col("_c")), "left")
    found = F.col("_known").isNotNull()
    triage = by_rules(rec.withColumnRenamed("file", "unit_id"), "D-TRIAGE", F.col("line_no"), {
        "child_differs": F.col("_c").isNotNull() & ~F.col("_child_actual").eqNullSafe(F.col("_own_sha")), "no_payload": ~found,
        "not_there": found & (F.col("path") != "") & F.col("_p").isNull(), "other_digest": found & F.col("_p").isNotNull() & (F.col("_actual") != F.col("sha"))})
    said = run.where((F.col("kind") == "triage_validated") & F.col("head_sha256").isNotNull()).withColumn(
        "_log", F.when(F.col("_asof").isNotNull(), F.col("_asof.folder")).otherwise(F.coalesce("accession", F.lit(""))))
    lines = log_lines.select(F.col("accession").alias("_a"), F.col("sha256").alias("_h")).distinct()
    lost = said.join(lines, (F.col("_log") == F.col("_a")) & (F.col("head_sha256") == F.col("_h")), "left_anti")
    return triage.unionByName(findings(lost, "D-HEAD", "error", F.col("line_no"), "no_such_line", unit="file"))
