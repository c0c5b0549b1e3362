"""Snapshot differencing per source against a retained state, and the next state.

Tables
------
observed    ``source, canonical_key, type, value, family, kev, last_seen, confidence, ingested_at``
state       ``source, canonical_key, type, value, family, kev, last_seen, ingested_at, status,
            fallen_since``: one row per (source, key)
runs        ``source, status, http_code, declared_window, attempt_time``: one row per source
watermarks  ``source, watermark``: the attempt time up to which the state reflects the source

A source's figures that could not be computed are NULL, never zero and never an empty set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmark import model as m
from feedmark.functions import values
from feedmark.operators.lookup import join_lookup

KEY = ("source", "canonical_key")
STATE_COLUMNS = (
    "source",
    "canonical_key",
    "type",
    "value",
    "family",
    "kev",
    "last_seen",
    "ingested_at",
    "status",
    "fallen_since",
)
_ATTRIBUTES = ("type", "value", "family", "kev", "last_seen", "ingested_at")
_LAST = 9_223_372_036_854_775_807

NEW, REAPPEARED, FALLEN_SET, KEPT = "new", "reappeared", "fallen", "kept"

# Rules of the publication gate, in order of precedence.
RULE_NOT_OK = "source_not_correct"
RULE_FIRST = "first_observation"
RULE_UNCHANGED = "unchanged"
RULE_EMPTY = "correct_but_empty"
RULE_BEYOND_WINDOW = "interval_beyond_window"
RULE_COMPARED = "compared"


def observed_rows(observations: DataFrame) -> DataFrame:
    """State columns of valid observations with ``ingested_at``; the family is its id, else its display name."""
    return observations.select(
        "source",
        "canonical_key",
        "type",
        "value",
        F.coalesce("family_id", "family_label").alias("family"),
        F.when(F.col("type") == m.VULNERABILITY, F.col("kev")).alias("kev"),
        "last_seen",
        "confidence",
        "ingested_at",
    )


def _preference() -> Column:
    """Smallest for the row that represents its key: seen last, most confident, then by family.

    The trailing attributes make the choice total, so it cannot depend on the order of arrival.
    """
    return F.struct(
        F.coalesce(-F.unix_micros("last_seen"), F.lit(_LAST)).alias("o_seen"),
        (-F.col("confidence")).alias("o_confidence"),
        F.col("family").isNull().alias("o_unnamed"),
        *_ATTRIBUTES,
    )


def dedupe_observed(observed: DataFrame) -> DataFrame:
    """One row per (source, key). An aggregate, so copies collapse before the shuffle."""
    return (
        observed.groupBy(*KEY)
        .agg(F.min(_preference()).alias("best"))
        .select(*KEY, *(F.col(f"best.{name}").alias(name) for name in _ATTRIBUTES))
    )


def compare(observed: DataFrame, state: DataFrame) -> DataFrame:
    """Today's observation and the prior state of every (source, key).

    ``now`` and ``before`` are NULL where a key is on one side only. Only today's rows are
    aggregated; the state has one row for each key already and goes into the join as it is.
    """
    today = observed.groupBy(*KEY).agg(F.min(_preference()).alias("now"))
    prior = state.select(*KEY, F.struct("status", "fallen_since", *_ATTRIBUTES).alias("before"))
    return today.join(prior, list(KEY), "full_outer")


def source_interval(runs: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Seconds from a source's watermark to its attempt; NULL without a watermark."""
    return runs.join(watermarks, "source", "left").withColumn(
        "interval_seconds", values.seconds_between(F.col("attempt_time"), F.col("watermark"))
    )


def observed_counts(observed: DataFrame) -> DataFrame:
    return observed.groupBy("source").agg(F.count("*").alias("n_observed"))


def publication_gate(runs: DataFrame, watermarks: DataFrame, counts: DataFrame) -> DataFrame:
    """What may be published per source: the first rule that applies decides.

    ``sets_computed``    new and reappeared come from the comparison (else they are empty)
    ``fallen_published`` the fallen set is a statement (possibly "none"), else it is NULL
    """
    interval, window = F.col("interval_seconds"), F.col("window_seconds")
    beyond = F.coalesce(interval > window, F.lit(False))
    rule = (
        F.when(~F.col("status").eqNullSafe(m.OK), F.lit(RULE_NOT_OK))
        .when(F.col("watermark").isNull(), F.lit(RULE_FIRST))
        .when(F.col("http_code").eqNullSafe(304), F.lit(RULE_UNCHANGED))
        .when(F.col("n_observed") == 0, F.lit(RULE_EMPTY))
        .when(beyond, F.lit(RULE_BEYOND_WINDOW))
        .otherwise(F.lit(RULE_COMPARED))
    )
    gated = (
        source_interval(runs, watermarks)
        .join(counts, "source", "left")
        .withColumn("n_observed", F.coalesce("n_observed", F.lit(0)))
        .withColumn("window_seconds", values.declared_window_seconds(F.col("declared_window")))
        .withColumn("rule", rule)
    )
    rule = F.col("rule")
    published = rule.isin(RULE_UNCHANGED, RULE_COMPARED)
    first = rule == RULE_FIRST
    return gated.select(
        "source",
        "status",
        "http_code",
        "attempt_time",
        "watermark",
        "n_observed",
        "rule",
        F.when(~first, interval).alias("interval_seconds"),
        "window_seconds",
        rule.isin(RULE_BEYOND_WINDOW, RULE_COMPARED).alias("sets_computed"),
        published.alias("fallen_published"),
        F.when(~published, rule).alias("unpublished_reason"),
        first.alias("in_baseline"),
        (rule == RULE_BEYOND_WINDOW).alias("new_reading_degraded"),
        (
            (rule == RULE_NOT_OK) & beyond & (window > 0) & (interval != 0)
        ).alias("additions_lost_risk"),
    )


def _member(sets_computed: Column, rule: Column) -> Column:
    """Which published set a compared row belongs to; NULL for none."""
    now, before, was = F.col("now"), F.col("before"), F.col("before.status")
    return F.when(
        sets_computed & now.isNotNull(),
        F.when(before.isNull(), F.lit(NEW)).when(was == m.FALLEN, F.lit(REAPPEARED)).otherwise(F.lit(KEPT)),
    ).when((rule == RULE_COMPARED) & now.isNull() & (was == m.PRESENT), F.lit(FALLEN_SET))


def diff_members(compared: DataFrame, gate: DataFrame) -> DataFrame:
    """Members of the published sets, and the kept ones, each with its attributes."""
    rules = gate.select("source", "sets_computed", F.col("rule").alias("_rule"))
    joined = join_lookup(compared, rules, ["source"], "inner")
    member = _member(F.col("sets_computed"), F.col("_rule"))
    return (
        joined.withColumn("member", member)
        .where(F.col("member").isNotNull())
        .select(
            *KEY,
            "member",
            *(
                F.when(F.col("now").isNotNull(), F.col(f"now.{name}"))
                .otherwise(F.col(f"before.{name}"))
                .alias(name)
                for name in _ATTRIBUTES
            ),
        )
    )


def only(members: DataFrame, member: str) -> DataFrame:
    return members.where(F.col("member") == member).drop("member")


def diff_sources(members: DataFrame, gate: DataFrame) -> DataFrame:
    """One row per source: set sizes next to the flags that qualify them."""
    sizes = members.groupBy("source").agg(
        *(
            F.count_if(F.col("member") == member).alias(f"n_{member}")
            for member in (NEW, REAPPEARED, FALLEN_SET)
        )
    )
    joined = gate.join(sizes, "source", "left")
    return joined.select(
        *gate.columns,
        F.coalesce("n_new", F.lit(0)).alias("n_new"),
        F.coalesce("n_reappeared", F.lit(0)).alias("n_reappeared"),
        F.when(F.col("fallen_published"), F.coalesce("n_fallen", F.lit(0))).alias("n_fallen"),
    )


def advance_watermarks(watermarks: DataFrame, gate: DataFrame) -> DataFrame:
    """A watermark moves iff the state now reflects the source: correct with rows, or a 304."""
    advances = F.col("status").eqNullSafe(m.OK) & (
        (F.col("n_observed") > 0) | F.col("http_code").eqNullSafe(304)
    )
    reached = gate.select(
        "source", F.when(advances, F.col("attempt_time")).alias("reached")
    )
    return (
        watermarks.join(reached, "source", "full_outer")
        .select("source", F.coalesce("reached", "watermark").alias("watermark"))
        .where(F.col("watermark").isNotNull())
    )


def next_rows(
    compared: DataFrame,
    gate: DataFrame,
    mode: str,
    run_start: Column,
    retention_days: int = m.RETENTION_DAYS,
) -> DataFrame:
    """``compared`` with ``next``, the row of the next state (NULL where none is kept), and ``member`` of the published sets.

    A source without rows today, not correct or not run at all is carried untouched, and what a
    partial source did observe is deferred. Elsewhere observed rows are present; unobserved
    fallen rows are kept until they are older than the retention; unobserved present rows fall
    only in a differential whose fallen set could be published.
    """
    rules = gate.select(
        "source",
        ((F.col("status") == m.OK) & (F.col("n_observed") > 0)).alias("_writes"),
        (F.lit(mode == m.MODE_DIFFERENTIAL) & F.col("fallen_published")).alias("_marks"),
        F.col("sets_computed").alias("_sets"),
        F.col("rule").alias("_rule"),
    )
    joined = join_lookup(compared, rules, ["source"])
    writes = F.coalesce("_writes", F.lit(False))
    marks = F.coalesce("_marks", F.lit(False))
    now, was, since = F.col("now"), F.col("before.status"), F.col("before.fallen_since")
    observed = writes & now.isNotNull()
    expired = F.coalesce(
        values.seconds_between(run_start, since) > retention_days * values.DAY_SECONDS, F.lit(False)
    )
    keep = F.when(writes, now.isNotNull() | (was == m.PRESENT) | ~expired).otherwise(was.isNotNull())
    falls = writes & marks & now.isNull() & (was == m.PRESENT)
    row = F.struct(
        F.when(observed, F.lit(m.PRESENT)).when(falls, F.lit(m.FALLEN)).otherwise(was).alias("status"),
        F.when(observed, F.lit(None)).when(falls, run_start).otherwise(since).alias("fallen_since"),
        *(
            F.when(observed, F.col(f"now.{name}")).otherwise(F.col(f"before.{name}")).alias(name)
            for name in _ATTRIBUTES
        ),
    )
    member = _member(F.coalesce("_sets", F.lit(False)), F.col("_rule")) if mode == m.MODE_DIFFERENTIAL else F.lit(None).cast("string")
    return joined.select(*KEY, "now", "before", F.when(keep, row).alias("next"), member.alias("member"))


def rebuild_state(
    compared: DataFrame,
    gate: DataFrame,
    mode: str,
    run_start: Column,
    retention_days: int = m.RETENTION_DAYS,
) -> DataFrame:
    """The next state, from the same comparison that gave the sets: the rows that ``next_rows`` keeps."""
    rows = next_rows(compared, gate, mode, run_start, retention_days).where(F.col("next").isNotNull())
    return rows.select(*KEY, "next.*").select(*STATE_COLUMNS)


def merge_state_sources(state: DataFrame) -> DataFrame:
    """One row per indicator: what its sources say, merged in source order.

    Family, vulnerability block and last sighting come from the last source that has them, the
    ingestion time from the first. The gathered list is bounded by the number of feeds.
    """

    def last(name: str) -> Column:
        return F.max(F.when(F.col(name).isNotNull(), F.struct("source", name)))[name].alias(name)

    first_ingested = F.min(
        F.when(F.col("ingested_at").isNotNull(), F.struct("source", "ingested_at"))
    )["ingested_at"]
    return state.groupBy("canonical_key").agg(
        F.min("type").alias("type"),
        F.min("value").alias("value"),
        last("family"),
        last("kev"),
        last("last_seen"),
        first_ingested.alias("ingested_at"),
        F.array_sort(F.collect_list(F.struct("source", "status", "fallen_since"))).alias("sources"),
    )


def run_mode(history: DataFrame, regeneration_days: int = m.REGENERATION_DAYS) -> DataFrame:
    """Mode and reason of every run of a history.

    Facts on the state come before the wish to regenerate. Total failure, known only after the
    feeds were read, overrides any candidate but keeps its reason.
    """
    late = (
        values.seconds_between(F.col("run_start"), F.col("baseline_instant"))
        > regeneration_days * values.DAY_SECONDS
    )
    reason = (
        F.when(F.col("load_outcome") == "absent", F.lit(m.STATE_ABSENT))
        .when(F.col("load_outcome") == "illegible", F.lit(m.STATE_ILLEGIBLE))
        .when(
            (F.col("load_outcome") == "no_watermark") | F.col("latest_watermark").isNull(),
            F.lit(m.STATE_NO_WATERMARK),
        )
        .when(F.col("latest_watermark") > F.col("run_start"), F.lit(m.WATERMARK_INCOHERENT))
        .when(F.col("regenerate"), F.lit(m.REGENERATION_REQUESTED))
        .when(late, F.lit(m.REGENERATION_DUE))
    )
    mode = (
        F.when(F.col("n_usable_sources") == 0, F.lit(m.MODE_TOTAL_FAILURE))
        .when(F.col("baseline_reason").isNotNull(), F.lit(m.MODE_BASELINE))
        .otherwise(F.lit(m.MODE_DIFFERENTIAL))
    )
    next_baseline = (
        F.when(F.col("mode") == m.MODE_BASELINE, F.col("run_start")).otherwise(F.col("baseline_instant"))
    )
    return (
        history.withColumn("baseline_reason", reason)
        .withColumn("mode", mode)
        .withColumn("next_baseline_instant", next_baseline)
    )


def publishable_sources(gate: DataFrame) -> DataFrame:
    """Sources that may enter the family variation."""
    return gate.where(~F.col("in_baseline") & F.col("fallen_published")).select("source", "rule")


def family_variation(observed: DataFrame, state: DataFrame, gate: DataFrame) -> DataFrame:
    """Present indicators per family today minus before, zero changes left out.

    Over publishable sources only; an indicator seen by several of them counts once. A source
    that answered "unchanged" counts with what the state holds for it.
    """
    sources = publishable_sources(gate)
    seen = join_lookup(dedupe_observed(observed), sources, ["source"], "inner").select(
        "canonical_key", "source", "family"
    )
    held = join_lookup(state.where(F.col("status") == m.PRESENT), sources, ["source"], "inner")
    unchanged = held.where(F.col("rule") == RULE_UNCHANGED).select("canonical_key", "source", "family")
    today = (
        seen.unionByName(unchanged)
        .groupBy("canonical_key")
        .agg(F.max(F.struct("source", "family")).alias("last"))
        .select(F.col("last.family").alias("family"), F.lit(1).alias("step"))
    )
    # The state has one family per indicator, whichever of its sources gave it.
    before = (
        join_lookup(state, sources.select("source", F.lit(True).alias("_open")), ["source"])
        .groupBy("canonical_key")
        .agg(
            F.max(F.when(F.col("family").isNotNull(), F.struct("source", "family")))["family"].alias(
                "family"
            ),
            F.bool_or(F.coalesce("_open", F.lit(False)) & (F.col("status") == m.PRESENT)).alias("open"),
        )
        .where("open")
        .select("family", F.lit(-1).alias("step"))
    )
    return (
        today.unionByName(before)
        .where(values.has_text(F.col("family")))
        .groupBy("family")
        .agg(F.sum("step").alias("delta"))
        .where("delta != 0")
    )


def variation_calculable(gate: DataFrame) -> DataFrame:
    """One row: whether any source is publishable. If not, the variation is NULL, not empty."""
    n = F.count_if(~F.col("in_baseline") & F.col("fallen_published"))
    return gate.agg(n.alias("n_publishable"), (n > 0).alias("calculable"))
