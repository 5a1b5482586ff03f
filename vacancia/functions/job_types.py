"""Job types: arrays of canonical names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.text import contains_any, let, rx, strip
from vacancia.lookups import SYNONYM_TO_JOB_TYPE, lookup

# Wording in running text. Two words may be written with one blank or none between.
TEXT_WORDS = {
    "fulltime": ("full", "time"),
    "parttime": ("part", "time"),
    "internship": ("internship",),
    "contract": ("contract",),
}
# Board vocabularies.
SEEK_WORK_TYPES = {
    "full time": "fulltime", "part time": "parttime", "contract": "contract", "casual": "parttime",
    "temporary": "temporary",
}
REED_JOB_TYPES = {"full time": "fulltime", "part time": "parttime"}
REED_CONTRACT_TYPES = {"permanent": "fulltime", "contract": "contract", "temporary": "temporary"}

NO_TYPES = "array<string>"


def _present(*items: Column) -> Column:
    return F.filter(F.array(*items), lambda t: t.isNotNull())


def or_null(types: Column) -> Column:
    """Null instead of an empty array."""
    return F.when(F.size(types) > 0, types)


def extract_job_type(text: Column) -> Column:
    """Types named in running text: ``[]`` for no text, null for text that names none."""

    def hits(low: Column) -> Column:
        def named(words: tuple[str, ...]) -> Column:
            # Plain searches settle nearly all texts without a regex.
            there = F.contains(low, F.lit(words[-1]))
            return there & low.rlike(rx(r"\s?".join(words))) if len(words) > 1 else there

        return or_null(_present(*[F.when(named(w), name) for name, w in TEXT_WORDS.items()]))

    none = F.array().cast(NO_TYPES)
    return F.when(F.length(text) > 0, let(F.lower(text), hits)).otherwise(none)


def job_type_of(spelling: Column) -> Column:
    """Canonical type of a cleaned spelling, null when unknown."""
    return lookup(SYNONYM_TO_JOB_TYPE, spelling)


def normalize_job_type(text: Column) -> Column:
    """Canonical type of a label, ignoring case, dashes, blanks and underscores."""
    return job_type_of(F.lower(F.regexp_replace(text, "[-_ ]", "")))


def types_of_labels(labels: Column) -> Column:
    """Canonical types of an array of labels, unknown ones skipped."""
    return F.filter(
        F.transform(labels, lambda a: job_type_of(F.lower(F.regexp_replace(a, "[- ]", "")))),
        lambda t: t.isNotNull(),
    )


def job_type_seek(work_types: Column) -> Column:
    mapped = F.transform(work_types, lambda w: lookup(SEEK_WORK_TYPES, strip(F.lower(w))))
    return or_null(F.filter(mapped, lambda t: t.isNotNull()))


def job_type_reed_details(job_type: Column, contract_type: Column) -> Column:
    return F.array_distinct(
        _present(
            lookup(REED_JOB_TYPES, strip(F.lower(job_type))),
            lookup(REED_CONTRACT_TYPES, strip(F.lower(contract_type))),
        )
    )


def job_type_reed_search(full: Column, part: Column, contract: Column, temp: Column) -> Column:
    return _present(
        F.when(full, "fulltime"),
        F.when(part, "parttime"),
        F.when(contract, "contract"),
        F.when(temp, "temporary"),
    )


def job_type_irish(text: Column) -> Column:
    """Substring rules; a permanent full-time job is named twice."""
    low = F.lower(text)
    timed = F.contains(low, F.lit("time"))
    hits = _present(
        F.when(F.contains(low, F.lit("full")) & timed, "fulltime"),
        F.when(F.contains(low, F.lit("part")) & timed, "parttime"),
        F.when(F.contains(low, F.lit("contract")), "contract"),
        F.when(F.contains(low, F.lit("temp")), "temporary"),
        F.when(F.contains(low, F.lit("intern")), "internship"),
        F.when(contains_any(low, ("permanent",)), "fulltime"),
    )
    return or_null(hits)
