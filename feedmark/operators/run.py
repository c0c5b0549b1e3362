"""One run of the whole chain: raw records to normalised rows, quality, gate, state, enrichment, report tables.

The state is written before anything is enriched, so a fault of the catalogue can cost no observation. What
is new in a report is what the comparison with the state found, and what falls due is read from the state, as a
source that answers "unchanged" sends nothing again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from feedmark import model as m
from feedmark.operators import difference as d
from feedmark.operators import enrich as e
from feedmark.operators import normalize as n
from feedmark.operators import quality as q
from feedmark.operators import reports as r
from feedmark.session import stage
from feedmark.sources import state_log as log


@dataclass(frozen=True)
class Feed:
    """A feed's records of one run: (source, run_id, record), and how they become observations."""

    spec: m.FeedSpec
    normalize: Callable[[DataFrame], DataFrame]
    batch: DataFrame


@dataclass(frozen=True)
class Applied:
    """What a run did to the state. ``changes`` as ``state_log.changes``; NULL tables if every source failed."""

    mode: str
    baseline_reason: str | None
    gate: DataFrame
    changes: DataFrame | None
    version: log.Version

    def members(self) -> DataFrame:
        return self.changes.where(F.col("member").isNotNull())

    def new_keys(self) -> DataFrame:
        """Keys of the new set; none in a baseline, which has no period."""
        return self.members().where(F.col("member") == d.NEW).select("source", "canonical_key")


def state_entries(version: log.Version, source: str = m.VULN_FEED.name) -> DataFrame:
    """Entries of the vulnerability feed as the state holds them, fallen ones too."""
    kev = F.col("kev")
    rows = version.indicators.where((F.col("source") == source) & kev.isNotNull())
    return rows.select(
        "canonical_key", "value", kev["dueDate"].alias("due_date"), kev["knownRansomwareCampaignUse"].alias("ransomware"), "status"
    )


def _decision(version: log.Version, run_start: datetime, runs: DataFrame, regenerate: bool):
    """Mode and reason of this run: one row, from the state's facts and the sources that did not fail."""
    usable = runs.where(~F.col("status").eqNullSafe(m.FAILED)).count()
    marks = None if version.watermarks is None else version.watermarks.agg(F.max("watermark")).first()[0]
    facts = [(run_start, version.outcome, marks, regenerate, version.baseline_instant, usable)]
    schema = "run_start timestamp, load_outcome string, latest_watermark timestamp, regenerate boolean, baseline_instant timestamp, n_usable_sources long"
    return d.run_mode(runs.sparkSession.createDataFrame(facts, schema)).first()


def apply_run(
    store: log.StateLog, run_id: str, sequence: int, run_start: datetime, observations: DataFrame, runs: DataFrame, regenerate: bool = False
) -> Applied:
    """Compares a run's valid observations with the state and adds what it changes.

    ``runs`` has a row for each source (``difference`` says which columns). If every source failed, the state stays as it is.
    """
    spark = observations.sparkSession
    started = F.lit(run_start).cast("timestamp")
    version = store.load(before=sequence)
    decision = _decision(version, run_start, runs, regenerate)
    marks = version.watermarks
    if marks is None:
        marks = spark.createDataFrame([], "source string, watermark timestamp")
    observed = d.observed_rows(observations.withColumn("ingested_at", started))
    gate = stage(d.publication_gate(runs, marks, d.observed_counts(observed)), "gate")
    if decision["mode"] == m.MODE_TOTAL_FAILURE:
        return Applied(decision["mode"], decision["baseline_reason"], gate, None, version)
    if version.base is None:
        none = observed.select(*d.KEY, *d._ATTRIBUTES, F.lit("").alias("status"), F.lit(None).cast("timestamp").alias("fallen_since")).limit(0)
        compared = d.compare(observed, none)
    else:
        compared = log.compare(observed, version)
    changed = stage(log.changes(compared, gate, decision["mode"], started), "changes")
    reached = d.advance_watermarks(marks, gate)
    if version.base is None:
        store.begin(run_id, sequence, changed.where(~F.col("gone")), reached, decision["next_baseline_instant"])
    else:
        store.commit(run_id, sequence, changed, reached, decision["next_baseline_instant"])
    return Applied(decision["mode"], decision["baseline_reason"], gate, changed, store.load(before=sequence + 1))


def reports(applied: Applied, enriched: DataFrame, runs: DataFrame, today: Column, mapping: DataFrame | None = None) -> dict[str, DataFrame]:
    """The report tables of a run that was applied."""
    differential = applied.mode == m.MODE_DIFFERENTIAL
    members = applied.members()
    new = applied.new_keys().where(F.col("source") == m.VULN_FEED.name).select("canonical_key")
    entries = state_entries(applied.version)
    vulns = enriched.where(F.col("source") == m.VULN_FEED.name)
    kev = F.col("kev")
    seen = vulns.select("canonical_key", "value", kev["dueDate"].alias("due_date"), kev["knownRansomwareCampaignUse"].alias("ransomware"), "reason")
    open_ = seen.where(F.col("reason") == m.PRODUCT_UNCLASSIFIED)
    soon = r.due_soon(entries, today)
    section = r.vuln_section_differential(entries, new, applied.gate, today) if differential else r.vuln_section_baseline(entries, today)
    queue = r.work_queue(open_, today, new, applied.gate) if differential else r.work_queue_head(open_, today)
    per_source = d.diff_sources(members, applied.gate)
    return {
        "source_runs": runs,
        "diff_sources": per_source,
        "members": members,
        "due_soon": soon,
        "illegible_due": r.illegible_due(entries),
        "vuln_section": section,
        "work_queue": queue,
        "work_queue_total": r.work_queue_total(open_),
        "inferred_frequency": r.inferred_frequency(vulns, new, applied.mode),
        "census": r.census_by_source(enriched, runs),
        "families": r.census_families(enriched, runs),
        "by_type": r.count_by_type(enriched),
        "kev_coverage": r.kev_coverage(vulns, runs),
        "recommendations": r.recommendations(soon, runs),
        "judgements": r.judgement_counts(soon, mapping, per_source, runs),
    }


def full_run(
    store: log.StateLog,
    run_id: str,
    sequence: int,
    run_start: datetime,
    feeds: list[Feed],
    facts: DataFrame,
    rules: DataFrame,
    mapping: DataFrame | None = None,
    regenerate: bool = False,
) -> tuple[Applied, dict[str, DataFrame]]:
    """Everything from raw records to the report. ``facts`` has what only the fetch knows of each (source, run)."""
    normalized, measured = [], []
    for feed in feeds:
        rows = stage(feed.normalize(feed.batch), f"{feed.spec.name}-normalized")
        measured.append(q.source_runs(*q.run_measures(rows, feed.spec), facts))
        normalized.append(rows.where(F.col("verdict") == n.VALID).select(*n.OBSERVATION_COLUMNS))
    runs = stage(q.union_all(measured), "runs")
    observations = q.union_all(normalized)
    applied = apply_run(store, run_id, sequence, run_start, observations, runs, regenerate)
    if applied.changes is None:
        return applied, {"source_runs": runs}
    # The reports read no raw record; the normalised rows above keep it.
    told = observations.drop("verdict", "reason", "failed_checks", "raw")
    enriched = stage(e.enrich_observations(told, mapping, rules), "enriched")
    return applied, reports(applied, enriched, runs, F.lit(run_start).cast("date"), mapping)
