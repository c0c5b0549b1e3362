"""Aggregates, rankings and ledgers of the report.

Every proportion names its denominator; a figure without one is NULL. Totals are scalar
subqueries, top lists are sort-and-limit, nothing is windowed over a whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmark import model as m
from feedmark.functions import values
from feedmark.operators import difference as d


def floor_percent(part: Column, total: Column) -> Column:
    """Whole percent, rounded down; NULL without a denominator."""
    return F.floor(part * 100 / F.nullif(total, F.lit(0))).cast("bigint")


# --- techniques ----------------------------------------------------------------------------


def technique_frequency(techniques: DataFrame, mapping: DataFrame) -> DataFrame:
    """Families per technique; the denominator is all observed families, unmapped ones too."""
    total = mapping.agg(F.count("*")).scalar()
    counted = (
        techniques.select("family_id", "technique_id", "technique_name")
        .distinct()
        .groupBy("technique_id")
        .agg(F.count("*").alias("n_families"), F.min("technique_name").alias("technique_name"))
    )
    return counted.select(
        "technique_id", "technique_name", "n_families", total.alias("total_families")
    ).withColumn("share", F.round(F.col("n_families") / F.nullif("total_families", F.lit(0)), 4))


def technique_frequency_top(techniques: DataFrame, mapping: DataFrame) -> DataFrame:
    """The ten most frequent (id, name) pairs, ties by id and name."""
    total = mapping.agg(F.count("*")).scalar()
    return (
        techniques.select("family_id", "technique_id", "technique_name")
        .distinct()
        .groupBy("technique_id", "technique_name")
        .agg(F.count("*").alias("n_families"))
        .orderBy(F.desc("n_families"), "technique_id", "technique_name")
        .limit(m.TOP_TECHNIQUES)
        .withColumn("total_families", total)
        .withColumn("percent", floor_percent(F.col("n_families"), F.col("total_families")))
    )


def inferred_frequency(enriched: DataFrame, new_keys: DataFrame, mode: str = m.MODE_DIFFERENTIAL) -> DataFrame:
    """Entries per inferred technique over the new entries of the period, and only those.

    Instead of an empty table there is one row without a technique: a baseline has no period, a
    period without new entries has no denominator, and one without vectors says so.
    """
    entries = enriched.join(new_keys, "canonical_key", "left_semi")
    found = entries.agg(
        F.count("*").alias("total_entries"),
        F.count_if(F.col("mapping_method") == m.INFERRED).alias("inferred"),
    )
    reason = (
        F.when(F.lit(mode) != m.MODE_DIFFERENTIAL, F.lit("baseline_mode"))
        .when(F.col("total_entries") == 0, F.lit("no_denominator"))
        .when(F.col("inferred") == 0, F.lit("no_vectors"))
    )
    none = found.select(
        F.lit(None).cast("string").alias("technique_id"),
        F.lit(None).cast("bigint").alias("n_entries"),
        "total_entries",
        F.lit(None).cast("bigint").alias("percent"),
        reason.alias("reason"),
    ).where(F.col("reason").isNotNull())
    if mode != m.MODE_DIFFERENTIAL:
        return none.withColumn("total_entries", F.lit(None).cast("bigint"))
    total = entries.agg(F.count("*")).scalar()
    top = (
        entries.where(F.col("mapping_method") == m.INFERRED)
        .select(F.explode("technique_ids").alias("technique_id"))
        .groupBy("technique_id")
        .agg(F.count("*").alias("n_entries"))
        .withColumn("total_entries", total)
        .withColumn("percent", floor_percent(F.col("n_entries"), F.col("total_entries")))
        .orderBy(F.desc("n_entries"), "technique_id")
        .limit(m.TOP_TECHNIQUES)
        .withColumn("reason", F.lit(None).cast("string"))
    )
    return top.unionByName(none)


def reasons_by_family(mapping: DataFrame) -> DataFrame:
    return mapping.where(F.col("reason").isNotNull()).groupBy("reason").agg(
        F.count("*").alias("n_families")
    )


def reasons_by_record(enriched: DataFrame, feeds: dict[str, m.FeedSpec] = m.FEEDS) -> DataFrame:
    """Indicator-level and entry-level reasons, each over the rows of its own source.

    Family-level and run-level reasons are never counted by record: that would weigh a family by
    its infrastructure.
    """
    level, route = m.reason_level(F.col("reason")), m.source_route(F.col("source"), feeds)
    countable = ((level == m.LEVEL_INDICATOR) & (route == "family")) | (
        (level == m.LEVEL_ENTRY) & (route == "product")
    )
    per_reason = (
        enriched.withColumn("reason", F.when(countable, F.col("reason")))
        .groupBy("source", "reason")
        .agg(F.count("*").alias("n"))
    )
    totals = per_reason.groupBy("source").agg(F.sum("n").alias("denominator"))
    return (
        per_reason.where(F.col("reason").isNotNull())
        .join(totals, "source")
        .select("source", "reason", m.reason_level(F.col("reason")).alias("level"), "n", "denominator")
    )


def kev_coverage(enriched: DataFrame, runs: DataFrame) -> DataFrame:
    """Vector coverage per run of the vulnerability feed.

    The ratio is NULL after a 304, with nothing processed, when the run was not correct or its
    status is unknown, and when the enrichment stage did not run.
    """
    reason = F.col("reason")
    counted = enriched.groupBy("source", "run_id").agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("n_techniques") > 0).alias("with_vector"),
        F.count_if(reason == m.PRODUCT_UNCLASSIFIED).alias("unclassified"),
        F.count_if(reason == m.PRODUCT_UNSPECIFIC).alias("unspecific"),
        F.count_if(reason == m.STAGE_UNAVAILABLE).alias("not_run"),
    )
    joined = runs.select("source", "run_id", "status", "http_code").join(
        counted, ["source", "run_id"], "left"
    )
    unchanged = F.col("http_code").eqNullSafe(304)

    def measured(name: str) -> Column:
        return F.when(unchanged, F.lit(0)).otherwise(F.coalesce(name, F.lit(0))).cast("bigint")

    gate = (
        F.when(unchanged, F.lit("unchanged"))
        .when(F.coalesce("not_run", F.lit(0)) > 0, F.lit("stage_unavailable"))
        .when(~F.col("status").eqNullSafe(m.OK), F.lit("run_not_correct"))
        .when(F.coalesce("processed", F.lit(0)) == 0, F.lit("nothing_processed"))
    )
    return joined.select(
        "source",
        "run_id",
        *(measured(n).alias(n) for n in ("processed", "with_vector", "unclassified", "unspecific")),
        gate.alias("gate"),
        F.when(gate.isNull(), F.round(F.col("with_vector") / F.col("processed"), 4)).alias("coverage"),
    )


# --- censuses ------------------------------------------------------------------------------


def census_by_source(observations: DataFrame, runs: DataFrame) -> DataFrame:
    """Observations per source; a source that is not correct is listed but not counted."""
    counted = observations.groupBy("source").agg(F.count("*").alias("n"))
    included = F.col("status").eqNullSafe(m.OK)
    return runs.select("source", "status").join(counted, "source", "left").select(
        "source",
        included.alias("included"),
        F.when(included, F.coalesce("n", F.lit(0))).alias("n_observations"),
    )


def census_families(
    observations: DataFrame, runs: DataFrame, family_feed: str = m.IOC_FEED.name, family: str = "family_id"
) -> DataFrame:
    """One row: families that the family feed observed; NULL unless its panorama may be published."""
    named = observations.where((F.col("source") == family_feed) & values.has_text(F.col(family)))
    shown = panorama_publishable(runs, family_feed).scalar()
    return named.select(family).distinct().agg(F.count("*").alias("n")).select(F.when(shown, F.col("n")).alias("n_families"))


def count_by_type(observations: DataFrame) -> DataFrame:
    return observations.groupBy("type").agg(F.count("*").alias("n_observations"))


def family_variation_top(variation: DataFrame) -> DataFrame:
    return variation.orderBy(F.desc(F.abs("delta")), "family").limit(m.TOP_FAMILIES)


def diff_totals(per_source: DataFrame) -> DataFrame:
    """Totals of the three sets; fallen only over the sources where it is a statement."""
    return per_source.agg(
        F.sum("n_new").alias("n_new"),
        F.sum("n_reappeared").alias("n_reappeared"),
        F.sum("n_fallen").alias("n_fallen"),
        F.count("n_fallen").alias("n_sources_with_fallen"),
    )


def suppressed_sources(per_source: DataFrame) -> DataFrame:
    """The sources that the total of fallen leaves out, one row each."""
    return per_source.where(F.col("n_fallen").isNull()).select("source")


def source_status_table(runs: DataFrame, coverage: DataFrame) -> DataFrame:
    """Run table with the fields below their threshold, as ``field=share`` text."""
    detail = F.format_string("%s=%.4f", "field", "coverage")
    short = (
        coverage.where("short")
        .groupBy("source", "run_id")
        .agg(F.array_join(F.array_sort(F.collect_set(detail)), ",").alias("short_fields"))
    )
    return runs.join(short, ["source", "run_id"], "left").select(
        "source",
        "run_id",
        "status",
        "records",
        "invalid",
        "unsupported",
        "evaluated",
        F.coalesce("short_fields", F.lit("")).alias("short_fields"),
    )


def enrichment_summary(
    enriched: DataFrame, mapping: DataFrame, internal_errors: DataFrame, runs: DataFrame,
    family_feed: str = m.IOC_FEED.name,
) -> DataFrame:
    """One row on the whole stage; the family panorama is publishable only off a correct run."""
    rows = enriched.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("n_techniques") > 0).alias("n_with_technique"),
        F.count_if(F.col("n_techniques") == 0).alias("n_without"),
    )
    families = mapping.agg(F.count("*")).scalar()
    mapped = mapping.agg(F.count_if(F.col("n_techniques") > 0)).scalar()
    errors = internal_errors.agg(F.count("*")).scalar()
    publishable = panorama_publishable(runs, family_feed).scalar()
    return rows.select(
        "*",
        families.alias("n_families"),
        mapped.alias("n_families_mapped"),
        errors.alias("n_internal_errors"),
        publishable.alias("panorama_publishable"),
    )


# --- due dates -----------------------------------------------------------------------------


def due_soon(entries: DataFrame, today: Column, days: int = m.DUE_SOON_DAYS) -> DataFrame:
    """Entries due from today through ``days`` ahead, in order of due date and value."""
    due = values.parse_date(F.col("due_date"))
    return (
        entries.withColumn("due", due)
        .where(F.col("due").between(today, F.date_add(today, days)))
        .orderBy("due_date", "value")
    )


def illegible_due(entries: DataFrame) -> DataFrame:
    """Entries that state a due date nobody can read: declared, not dropped."""
    text = F.col("due_date")
    return entries.where((text != "") & values.parse_date(text).isNull())


def decision_columns(today: Column) -> dict[str, Column]:
    """What to attend to first, as sort columns: not yet due, overdue, no legible date."""
    ahead = F.date_diff(values.parse_date(F.col("due_date")), today)
    return {
        "decision_band": F.when(ahead.isNull(), F.lit(2)).when(ahead >= 0, F.lit(0)).otherwise(F.lit(1)),
        "decision_days": F.coalesce(F.abs(ahead), F.lit(0)),
        "no_ransomware": ~F.coalesce(F.lower(F.col("ransomware")) == "known", F.lit(False)),
    }


DECISION_ORDER = ("decision_band", "decision_days", "no_ransomware", "value")


def decision_order(entries: DataFrame, today: Column) -> DataFrame:
    return entries.withColumns(decision_columns(today)).orderBy(*DECISION_ORDER)


def _differential(gate: DataFrame, source: str) -> Column:
    """Whether the source ran and is past its baseline."""
    return gate.where((F.col("source") == source) & ~F.col("in_baseline")).agg(F.count("*") > 0).scalar()


def vuln_section_differential(
    entries: DataFrame, new_keys: DataFrame, gate: DataFrame, today: Column,
    source: str = m.VULN_FEED.name,
) -> DataFrame:
    """New and soon-due entries; empty if the source did not run or is in baseline."""
    open_gate = _differential(gate, source)
    marked = entries.join(
        new_keys.select("canonical_key", F.lit(True).alias("is_new")), "canonical_key", "left"
    ).withColumn("is_new", F.coalesce("is_new", F.lit(False)))
    soon = F.coalesce(
        values.parse_date(F.col("due_date")).between(today, F.date_add(today, m.DUE_SOON_DAYS)),
        F.lit(False),
    )
    return decision_order(
        marked.withColumn("is_due_soon", soon).where(
            (F.col("is_new") | F.col("is_due_soon")) & open_gate
        ),
        today,
    )


def vuln_section_baseline(entries: DataFrame, today: Column, head: int = m.BASELINE_HEAD) -> DataFrame:
    """The first ``head`` in decision order and every soon-due entry, with the uncut total."""
    total = entries.agg(F.count("*")).scalar()
    ranked = entries.withColumns(decision_columns(today))
    top = ranked.orderBy(*DECISION_ORDER).limit(head)
    soon = ranked.where(
        values.parse_date(F.col("due_date")).between(today, F.date_add(today, m.DUE_SOON_DAYS))
    )
    rest = soon.join(F.broadcast(top.select("canonical_key")), "canonical_key", "left_anti")
    return top.unionByName(rest).withColumn("total", total)


def work_queue(
    unclassified: DataFrame, today: Column, new_keys: DataFrame, gate: DataFrame,
    source: str = m.VULN_FEED.name,
) -> DataFrame:
    """Unclassified entries of the period in decision order, each with the total of all of them.

    Empty if the source did not run or is in baseline.
    """
    queue = unclassified.join(new_keys, "canonical_key", "left_semi")
    total = unclassified.agg(F.count("*")).scalar()
    shown = queue.where(_differential(gate, source))
    return decision_order(shown.withColumn("total", total), today)


def work_queue_total(unclassified: DataFrame) -> DataFrame:
    """How many entries are unclassified; stated whether or not the queue is shown."""
    return unclassified.agg(F.count("*").alias("total"))


def work_queue_head(unclassified: DataFrame, today: Column, head: int = m.BASELINE_HEAD) -> DataFrame:
    total = unclassified.agg(F.count("*")).scalar()
    return decision_order(unclassified, today).limit(head).withColumn("total", total)


def highlighted(enriched: DataFrame, top: int = m.TOP_HIGHLIGHTED) -> DataFrame:
    """Most confident reportable observations, defanged. Sources are not merged here."""
    reportable = enriched.where(
        (F.col("confidence") >= m.REPORT_MIN_CONFIDENCE)
        & (F.col("type") != m.VULNERABILITY)
        & ~values.is_trivial(F.col("value"))
    )
    return (
        reportable.orderBy(F.desc("confidence"), "canonical_key", "source", "family_label")
        .limit(top)
        .select(
            values.defang(F.col("type"), F.col("value")).alias("shown"),
            "type",
            "source",
            "confidence",
            "family_label",
            F.array_join("technique_ids", ",").alias("techniques"),
        )
    )


def recommendations(soon: DataFrame, runs: DataFrame) -> DataFrame:
    """What is due with its three earliest, and a row for each source whose collection needs a look."""
    earliest = (
        soon.orderBy("due_date", "value")
        .limit(m.TOP_RECOMMENDED)
        .agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "due_date", "value"))), ",").alias("t"))
        .scalar()
    )
    patch = soon.agg(F.count("*").alias("n")).where("n > 0").select(
        F.lit("patch").alias("action"), "n", earliest.alias("detail")
    )
    degraded = runs.where(~F.col("status").eqNullSafe(m.OK)).select("source").distinct()
    review = degraded.select(
        F.lit("review_collection").alias("action"),
        degraded.agg(F.count("*")).scalar().alias("n"),
        F.col("source").alias("detail"),
    )
    return patch.unionByName(review)


def panorama_publishable(runs: DataFrame, family_feed: str = m.IOC_FEED.name) -> DataFrame:
    """One row: whether the family feed ran and all its runs were correct."""
    ok = F.coalesce(F.bool_and(F.col("status").eqNullSafe(m.OK)), F.lit(False))
    return runs.where(F.col("source") == family_feed).agg(ok.alias("publishable"))


def judgement_counts(
    soon: DataFrame, mapping: DataFrame | None, per_source: DataFrame, runs: DataFrame
) -> DataFrame:
    """Counts behind the report's judgements; one without anything to say is left out.

    Families are judged only if the stage ran (``mapping`` is not None) and the panorama of their
    feed may be published.
    """
    ransomware = soon.agg(
        F.count_if(F.lower("ransomware") == "known").alias("part"), F.count("*").alias("total")
    ).select(F.lit("due_soon_with_ransomware").alias("judgement"), "part", "total").where("part > 0")
    judged = ransomware.limit(0)
    if mapping is not None:
        shown = panorama_publishable(runs).scalar()
        judged = mapping.agg(
            F.count_if(F.col("reason") == m.FAMILY_NO_ENTRY).alias("part"), F.count("*").alias("total")
        ).select(F.lit("families_without_entry").alias("judgement"), "part", "total")
        judged = judged.where((F.col("total") > 0) & shown)
    held = per_source.agg(
        F.count_if(F.col("n_fallen").isNull()).alias("part"), F.count("*").alias("total")
    ).select(F.lit("sources_with_fallen_suppressed").alias("judgement"), "part", "total").where("part > 0")
    return ransomware.unionByName(judged).unionByName(held)


# --- gates and ledgers ---------------------------------------------------------------------


def freshness_warnings(gate: DataFrame, hours: int = m.FRESHNESS_HOURS) -> DataFrame:
    """Sources whose interval is beyond the threshold, with the cause."""
    cause = F.when(F.col("status").eqNullSafe(m.OK), F.lit("watermark_did_not_advance")).otherwise(
        F.lit("source_not_correct")
    )
    return gate.where(F.col("interval_seconds") > hours * 3600).select(
        "source", "interval_seconds", cause.alias("cause")
    )


def unpublished_ledger(
    gate: DataFrame, mode: DataFrame, enrichment_available: bool = True,
    family_feed: str = m.IOC_FEED.name,
) -> DataFrame:
    """One row per calculation that is not published, with its reason.

    ``mode`` has one row with the run's mode. A missing calculation without a row here would read
    as a zero.
    """
    is_baseline = mode.agg(F.bool_or(F.col("mode") == m.MODE_BASELINE)).scalar()
    differential = gate.where(~is_baseline)

    def row(name: str, source: Column, reason: Column) -> Column:
        return F.struct(F.lit(name).alias("calculation"), source.alias("source"), reason.alias("reason"))

    nowhere = F.lit(None).cast("string")
    per_source = differential.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("in_baseline"), row("three_sets", F.col("source"), F.lit("source_first_seen"))),
                    F.when(
                        ~F.col("in_baseline") & ~F.col("fallen_published"),
                        row("fallen", F.col("source"), F.col("unpublished_reason")),
                    ),
                    F.when(
                        F.col("additions_lost_risk"),
                        row("additions", F.col("source"), F.lit("beyond_window_while_not_correct")),
                    ),
                )
            )
        ).alias("r")
    ).select("r.*")
    whole = (
        mode.where(F.col("mode") == m.MODE_BASELINE)
        .select(
            F.explode(
                F.array(
                    row("three_sets", nowhere, F.lit("baseline_mode")),
                    row("inferred_techniques", nowhere, F.lit("baseline_mode")),
                )
            ).alias("r")
        )
        .select("r.*")
    )
    variation = (
        d.variation_calculable(gate)
        .where(~F.col("calculable") & ~is_baseline)
        .select(row("family_variation", nowhere, F.lit("no_publishable_source")).alias("r"))
        .select("r.*")
    )
    panorama = (
        gate.agg(
            F.coalesce(
                F.bool_or((F.col("source") == family_feed) & F.col("status").eqNullSafe(m.OK)), F.lit(False)
            ).alias("ok")
        )
        .where("not ok")
        .select(row("family_panorama", F.lit(family_feed), F.lit("source_not_correct")).alias("r"))
        .select("r.*")
    )
    ledger = per_source.unionByName(whole).unionByName(variation).unionByName(panorama)
    if not enrichment_available:
        stage = mode.limit(1).select(row("techniques", nowhere, F.lit("stage_unavailable")).alias("r"))
        ledger = ledger.unionByName(stage.select("r.*"))
    return ledger
