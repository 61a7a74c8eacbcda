"""Operating values: retry, outcome classes, thresholds, disk."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cairnsift import vocab
from cairnsift.functions.names import _c

SILENT_BACKEND = ("TimeoutError", "ConnectionError", "ConnectionResetError", "BrokenPipeError")
UNREADABLE_REPLY = ("JSONDecodeError", "UnicodeDecodeError", "DispositionError")


def classify_result(ok: Column, reason: Column, error_type: Column) -> Column:
    """ok, failed, busy, fault, contract or refused from an outcome record's fields."""
    r, e = F.coalesce(reason, F.lit("")), F.coalesce(error_type, F.lit(""))
    return (F.when(ok.isNull() | ok, "ok")
            .when(r == "campaign_authorization_refused", "refused")
            .when(r.isin("unit_busy", "manifest_busy"), "busy")
            .when((r == "backend_unavailable") | (r.isin("os_error", "exception") & e.isin(*SILENT_BACKEND)), "fault")
            .when((r == "contract_mismatch") | (r.isin("validation_error", "exception") & e.isin(*UNREADABLE_REPLY)), "contract")
            .otherwise("failed"))


def network_failure(outcome: Column, text: Column, error_type: Column, retryable: Column) -> Column:
    return F.coalesce(
        (outcome == "stalled") | F.coalesce(retryable, F.lit(False))
        | F.coalesce(error_type.isin(*vocab.NETWORK_TYPES), F.lit(False))
        | F.coalesce(text.rlike(vocab.NETWORK_TEXT), F.lit(False)), F.lit(False))


def lease_size_limit(text: Column) -> Column:
    """Bytes a transfer needed when it ended at its size limit, else null."""
    chain = F.lit(None).cast("bigint")
    for pattern, more in reversed(vocab.LEASE_LIMITS):
        hit = F.regexp_extract(text, pattern, 1)
        chain = F.when(hit != "", hit.try_cast("bigint") + more).otherwise(chain)
    return chain


def extraction_disk_short(text: Column) -> Column:
    """Bytes an archive was to expand to when the volume ran short (0 when unsaid), else null."""
    expands = F.regexp_extract(text, vocab.EXTRACTION_EXPANDS, 1)
    return F.when(expands != "", expands.try_cast("bigint")).when(text.rlike(vocab.EXTRACTION_SHORT), F.lit(0).cast("bigint"))


def failure_record(detail: Column) -> Column:
    """What a download failure's JSON detail says, wherever it sits: ``text`` and ``types`` of the error the lease ended on
    (the job's own and its ``failure``'s), ``retryable``, the archive's ``archive_reason`` and ``declared_bytes``, and the
    disposition's ``decision``, ``reason`` and ``inputs`` (JSON). A detail that is no JSON object says nothing."""
    def read(record: Column) -> Column:
        at = lambda path, kind: F.try_variant_get(record, path, kind)
        said = [at(f"{base}.{key}", "string") for base in ("$", "$.failure") for key in ("error", "reason", "detail")]
        kinds = F.array_compact(F.array(*[F.nullif(at(f"{base}.error_type", "string"), F.lit("")) for base in ("$", "$.failure")]))
        number = at("$.failure.archive_failure.detail.declared_bytes", "variant")
        inputs = at("$.failure.disposition.inputs", "variant")
        whole = F.schema_of_variant(number) == "BIGINT"
        return F.struct(
            F.array_join(F.filter(F.array(*said), lambda x: x != ""), " | ").alias("text"), kinds.alias("types"),
            (F.schema_of_variant(at("$.failure.retryable", "variant")) == "BOOLEAN").alias("_told"), at("$.failure.retryable", "boolean").alias("retryable"),
            at("$.failure.archive_failure.reason", "string").alias("archive_reason"), F.when(whole, at("$.failure.archive_failure.detail.declared_bytes", "bigint")).alias("declared_bytes"),
            at("$.failure.disposition.decision", "string").alias("decision"), F.trim(at("$.failure.disposition.reason", "string")).alias("reason"),
            F.when(F.schema_of_variant(inputs).startswith("ARRAY"), F.to_json(inputs)).otherwise("[]").alias("inputs"))

    # The detail is parsed once for all of its fields.
    return F.transform(F.array(F.try_parse_json(detail)), read)[0]


def record_network_failure(outcome: Column, record: Column) -> Column:
    """``network_failure`` of a structured record: by outcome, a retryable failure, a type or the error's text."""
    types = F.array(*[F.lit(t) for t in sorted(vocab.NETWORK_TYPES)])
    return F.coalesce((outcome == "stalled") | F.coalesce(record["_told"] & record["retryable"], F.lit(False)) | F.coalesce(F.arrays_overlap(record["types"], types), F.lit(False))
                      | F.coalesce(record["text"].rlike(vocab.NETWORK_TEXT), F.lit(False)), F.lit(False))


def record_disk_short(record: Column) -> Column:
    """Bytes an archive was to expand to when the volume ran short: as the archive's failure declares them, else as the
    text says, 0 when neither does; null when it was no short disk."""
    named = F.coalesce(record["archive_reason"] == "insufficient_disk_space", F.lit(False))
    said = extraction_disk_short(record["text"])
    return F.when(named & (record["declared_bytes"] > 0), record["declared_bytes"]).when(named, F.coalesce(said, F.lit(0))).otherwise(said)


def download_exclusion(record: Column) -> Column:
    """The reason and inputs with which a failed lease excludes its unit; null for any other disposition."""
    reason = F.when(F.coalesce(record["reason"], F.lit("")) == "", "download_exclude").otherwise(record["reason"])
    return F.when(record["decision"] == "exclude", F.struct(reason.alias("reason"), record["inputs"].alias("inputs")))


def terminal_class(decision: Column, reason: Column, retryable: Column, reason_code: Column) -> Column:
    """excluded:<reason>, refused:<code> for a refusal no retry changes, else retryable."""
    refused = (retryable == F.lit(False)) & reason_code.rlike("^(" + "|".join(vocab.REFUSAL_PREFIXES) + ")")
    named = F.coalesce(F.nullif(F.trim(reason), F.lit("")), F.lit("download_exclude"))
    return (F.when(decision == "exclude", F.concat(F.lit("excluded:"), named))
            .when(refused, F.concat(F.lit("refused:"), reason_code)).otherwise("retryable"))


def gate_token(exit_code: Column) -> Column:
    return (F.when(exit_code.isNull(), "not_run").when(exit_code == 0, "pass").when(exit_code == 2, "fail")
            .when(exit_code == 3, "unusable").when(exit_code == 4, "held").otherwise("other"))


def report_terms(produced: Column, final_exit: Column) -> Column:
    return F.array_compact(F.array(
        F.when(produced, F.lit("outputs produced")),
        F.when(produced & (F.coalesce(final_exit, F.lit(-1)) == 0), F.lit("completed"))))


def is_fourier(family: Column) -> Column:
    return F.coalesce(family.rlike("(?i)fourier|ft-icr|fticr"), F.lit(False))


def family_step(family: Column) -> Column:
    return F.when(is_fourier(family), 1000).otherwise(100)


def threshold_step(instrument: Column, family: Column, vendor_raw: Column) -> Column:
    named = F.coalesce(instrument.rlike(r"(?i)orbitrap|exactive|exploris|fusion|lumos|eclipse|ltq|ft-?icr|fourier|astral"), F.lit(False))
    return F.when(is_fourier(family) | (vendor_raw > 0) | named, 1000).otherwise(100)


def estimate_step(used: Column, coarse: Column, fallback: Column, family: Column) -> Column:
    """``ok`` or what is wrong with a recorded step against its family step."""
    first = F.coalesce(coarse, used)
    back = F.coalesce(fallback, F.lit(False))
    expected = F.when(back, F.floor(family / 10)).otherwise(family)
    return (F.when(used.isNull() | first.isNull(), "no_step").when(first != family, "coarse_step_differs")
            .when(used != expected, "used_step_differs").otherwise("ok"))


def disk_factor(has_archive: Column, observed: Column) -> Column:
    base = F.when(has_archive, F.lit(vocab.ARCHIVE_FACTOR)).otherwise(F.lit(vocab.FILE_FACTOR))
    return F.greatest(base, observed)


def disk_need(known: Column, size_known: Column, factor: Column, held: Column) -> Column:
    """Bytes a unit takes in all; an unknown size is a lower bound raised by what is held, plus a reserve."""
    base = F.greatest(F.coalesce(known, F.lit(0)), F.lit(0))
    base = F.when(size_known, base).otherwise(F.greatest(base, F.coalesce(held, F.lit(0))))
    need = F.ceil(base * factor)
    return F.when(size_known, need).otherwise(need + F.lit(vocab.UNKNOWN_SIZE_RESERVE))


def disk_reserve(total: Column) -> Column:
    return F.greatest(F.lit(vocab.RESERVE_BYTES), F.floor(F.lit(vocab.RESERVE_FRACTION) * F.greatest(total, F.lit(0))))


def known_bytes_for_need(need: Column, factor: Column) -> Column:
    return F.ceil(F.greatest(need, F.lit(0)) / factor)


def download_bound_gb(total: Column) -> Column:
    return F.greatest(F.lit(1.0), (total - disk_reserve(total)) / F.lit(1e9))
