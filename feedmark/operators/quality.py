"""Feed quality: status of a batch, field coverage, format drift.

All measures are per ``(source, run_id)`` and come from conditional aggregates, so a source that
holds most of the rows is combined map-side before anything is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from feedmark import model as m
from feedmark.functions import records, values
from feedmark.session import stage

RUN = ("source", "run_id")

# Outcome of looking at one feed envelope.
ENVELOPE_OK, ENVELOPE_BROKEN, ENVELOPE_UNVERIFIED, ENVELOPE_FAILED = "ok", "broken", "not_verified", "failed"


def batch_counts(normalized: DataFrame) -> DataFrame:
    """Valid, invalid and unsupported records of each run."""
    return normalized.groupBy(*RUN).agg(*_verdict_counts())


def _verdict_counts() -> list[Column]:
    verdict = F.col("verdict")
    return [
        F.count("*").alias("total"),
        F.count_if(verdict == "valid").alias("records"),
        F.count_if(verdict == "invalid").alias("invalid"),
        F.count_if(verdict == "unsupported").alias("unsupported"),
    ]


def status_of_counts(n_valid: Column, n_invalid: Column) -> Column:
    """Only invalid records degrade a batch; unsupported ones never do."""
    return (
        F.when((n_valid > 0) & (n_invalid == 0), F.lit(m.OK))
        .when(n_valid > 0, F.lit(m.PARTIAL))
        .when(n_invalid > 0, F.lit(m.FAILED))
        .otherwise(F.lit(m.OK))
    )


def excess_unsupported(n_unsupported: Column, total: Column) -> Column:
    return (total > 0) & (n_unsupported / F.nullif(total, F.lit(0)) > m.UNSUPPORTED_SHARE)


def batch_status(counts: DataFrame, shortfalls: DataFrame | None = None) -> DataFrame:
    """Status per run; a coverage shortfall demotes a correct run to partial."""
    status = status_of_counts(F.col("records"), F.col("invalid"))
    if shortfalls is None:
        return counts.withColumn("status", status)
    short = shortfalls.groupBy(*RUN).agg(F.count("*").alias("n_short"))
    demoted = F.when((status == m.OK) & (F.col("n_short") > 0), F.lit(m.PARTIAL)).otherwise(status)
    return counts.join(short, list(RUN), "left").withColumn("status", demoted).fillna(0, ["n_short"])


def unsupported_ratio(counts: DataFrame) -> DataFrame:
    flag = F.coalesce(excess_unsupported(F.col("unsupported"), F.col("total")), F.lit(False))
    return counts.select(*RUN, "total", "unsupported", flag.alias("excess"))


def coverage_counts(
    batch: DataFrame, fields: tuple[str, ...], present: dict[str, Column], is_object: Column
) -> DataFrame:
    """Records, objects and, per field, objects that give it: one pass over the batch.

    ``present`` must be false for what is no object; a key lookup is.
    """
    return batch.groupBy(*RUN).agg(
        F.count("*").alias("n_records"),
        F.count_if(is_object).alias("n_objects"),
        *(F.count_if(present[name]).alias(name) for name in fields),
    )


def coverage_table(counts: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """One row per run and field: share, own threshold, and whether it falls short.

    The share is over object records only, and is NULL ("not evaluated") when fewer than half of
    the batch are objects: that is a different statement from "no shortfall".
    """
    evaluated = (F.col("n_objects") > 0) & (
        F.col("n_objects") >= m.MIN_OBJECT_SHARE * F.col("n_records")
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("field"),
                F.col(name).alias("n_present"),
                F.lit(float(threshold)).alias("threshold"),
            )
            for name, threshold in thresholds.items()
        )
    )
    long = counts.select(
        *RUN, "n_records", "n_objects", evaluated.alias("evaluated"), F.inline(entries)
    )
    share = F.when(F.col("evaluated"), F.col("n_present") / F.col("n_objects"))
    return long.select(
        *RUN,
        "field",
        "n_objects",
        "n_present",
        "evaluated",
        F.round(share, 4).alias("coverage"),
        "threshold",
        F.coalesce(share < F.col("threshold"), F.lit(False)).alias("short"),
    )


def field_coverage(batch: DataFrame, spec: m.FeedSpec) -> DataFrame:
    """Coverage of a feed's expected fields over raw records."""
    present, is_object = _given_fields(F.col("record"), spec)
    counts = coverage_counts(batch, spec.expected_fields, present, is_object)
    return coverage_table(counts, _thresholds(spec))


def _given_fields(record: Column, spec: m.FeedSpec) -> tuple[dict[str, Column], Column]:
    field = records.children(record, spec.expected_fields)
    present = {name: records.holds_value(field[name]) for name in spec.expected_fields}
    has_first = field[spec.expected_fields[0]].isNotNull()
    return present, F.when(has_first, F.lit(True)).otherwise(records.is_object(record))


def _thresholds(spec: m.FeedSpec) -> dict[str, float]:
    return {name: spec.threshold(name) for name in spec.expected_fields}


def run_measures(normalized: DataFrame, spec: m.FeedSpec) -> tuple[DataFrame, DataFrame]:
    """What :func:`batch_counts` and :func:`field_coverage` say of a feed, from one pass over it.

    The records are parsed once, verdicts and given fields are counted in the same aggregate; the
    few rows it gives are written, as both results read them.
    """
    present, is_object = _given_fields(F.col("raw"), spec)
    counted = normalized.groupBy(*RUN).agg(
        *_verdict_counts(),
        F.count("*").alias("n_records"),
        F.count_if(is_object).alias("n_objects"),
        *(F.count_if(present[name]).alias(name) for name in spec.expected_fields),
    )
    counted = stage(counted, "run-measures")
    return counted.select(*RUN, "total", "records", "invalid", "unsupported"), coverage_table(counted, _thresholds(spec))


def shortfalls(coverage: DataFrame) -> DataFrame:
    return coverage.where("short").select(*RUN, "field", "coverage", "threshold")


def missing_fields(batch: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Required names that occur as a key in no record of a run, whatever their value.

    One conditional aggregate per name instead of exploding the keys of every record.
    """
    record = F.col("record")
    seen = batch.groupBy(*RUN).agg(
        *(F.bool_or(records.has_key(record, name)).alias(name) for name in required)
    )
    entries = F.array(
        *(F.struct(F.lit(name).alias("field"), F.col(name).alias("seen")) for name in required)
    )
    return (
        seen.select(*RUN, F.inline(entries))
        .where(~F.coalesce("seen", F.lit(False)))
        .select(*RUN, "field")
    )


def broken_time_formats(batch: DataFrame, time_fields: dict[str, str]) -> DataFrame:
    """Per run and time field: values given, values legible, and whether the format broke.

    Broken means values are there and none parses; a few bad ones are just invalid records.
    """
    field = records.children(F.col("record"), tuple(time_fields))
    # Kind and text of each field are columns, taken out of the record once.
    batch = batch.select(
        *RUN,
        *(F.schema_of_variant(field[name]).alias(f"k_{name}") for name in time_fields),
        *(F.try_variant_get(field[name], "$", "string").alias(f"f_{name}") for name in time_fields),
    )

    def legible(name: str, kind: str) -> Column:
        only_string = F.when(F.col(f"k_{name}") == "STRING", F.col(f"f_{name}"))
        return values.TIME_PARSERS[kind](only_string).isNotNull()

    given = {name: records.is_given(F.col(f"k_{name}"), F.col(f"f_{name}")) for name in time_fields}
    counts = batch.groupBy(*RUN).agg(
        *(F.count_if(given[name]).alias(f"given_{name}") for name in time_fields),
        *(
            F.count_if(given[name] & legible(name, kind)).alias(f"legible_{name}")
            for name, kind in time_fields.items()
        ),
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(name).alias("field"),
                F.col(f"given_{name}").alias("n_given"),
                F.col(f"legible_{name}").alias("n_legible"),
            )
            for name in time_fields
        )
    )
    return (
        counts.select(*RUN, F.inline(entries))
        .where("n_given > 0")
        .withColumn("broken", F.col("n_legible") == 0)
    )


def envelope_verdict(envelopes: DataFrame) -> DataFrame:
    """Contract verdict of each envelope, from the columns of :mod:`feedmark.sources.documents`.

    Broken: the list key is gone or is no list. Not verified: the document could not be read,
    the feed refused or had nothing, or the list is empty, which proves nothing either way. Failed: the
    document is there, but beyond what the reader takes.
    """
    fault, status = F.col("fault"), F.col("query_status")
    verdict = (
        F.when(fault == "too_large", F.lit(ENVELOPE_FAILED))
        .when(fault == "not_json", F.lit(ENVELOPE_UNVERIFIED))
        .when((F.col("kind") == "window") & ~F.coalesce(status == "ok", F.lit(False)), F.lit(ENVELOPE_UNVERIFIED))
        .when(fault.isin("list_missing", "list_not_a_list"), F.lit(ENVELOPE_BROKEN))
        .when(F.col("n_records") == 0, F.lit(ENVELOPE_UNVERIFIED))
        .otherwise(F.lit(ENVELOPE_OK))
    )
    return envelopes.withColumn("verdict", verdict)


def source_runs(
    counts: DataFrame, coverage: DataFrame, facts: DataFrame
) -> DataFrame:
    """One row per run with everything measured on it.

    ``facts`` brings what only the fetch knows: declared window, attempt time, HTTP code and
    failure reason.
    """
    short = coverage.groupBy(*RUN).agg(
        F.bool_or("evaluated").alias("evaluated"),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.when(F.col("short"), F.struct("field", "coverage"))))
        ).alias("short_fields"),
    )
    status = status_of_counts(F.col("records"), F.col("invalid"))
    joined = counts.join(short, list(RUN), "left").join(facts, list(RUN), "left")
    demoted = F.when(
        (status == m.OK) & (F.size(F.map_keys("short_fields")) > 0), F.lit(m.PARTIAL)
    ).otherwise(status)
    return joined.select(
        *RUN,
        demoted.alias("status"),
        "records",
        "invalid",
        "unsupported",
        excess_unsupported(F.col("unsupported"), F.col("total")).alias("unsupported_excess"),
        "declared_window",
        "attempt_time",
        "failure_reason",
        "http_code",
        "retries",
        "short_fields",
        (~F.coalesce("evaluated", F.lit(False))).alias("coverage_not_evaluated"),
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
