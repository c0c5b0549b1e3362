"""The registered queries: every job over the supplied tables.

Results carry plain types only (strings, whole numbers, doubles, booleans); times are text and
intervals are seconds.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmark import model as m
from feedmark.functions import values
from feedmark.operators import catalog_checks as cc
from feedmark.operators import difference as d
from feedmark.operators import enrich as e
from feedmark.operators import families as fam
from feedmark.operators import normalize as n
from feedmark.operators import quality as q
from feedmark.operators import reports as r
from feedmark.operators import run
from feedmark.operators.lookup import in_parts
from feedmark.plans import workloads as w
from feedmark.session import configure, new_folder, released_shuffles, scratch, stage
from feedmark.sources import catalog, documents, large_documents, rules, state_log, tables
from feedmark.streaming import snapshots as st

Query = Callable[[SparkSession, str], DataFrame]
_REGISTERED: dict[str, Query] = {}


def query(job: Query) -> Query:
    def registered_job(spark: SparkSession, sf_dir: str) -> DataFrame:
        return job(configure(spark), sf_dir)

    registered_job.__name__ = job.__name__
    registered_job.__doc__ = job.__doc__
    _REGISTERED[job.__name__] = registered_job
    return registered_job


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _long(column: str) -> Column:
    return F.col(column).cast("bigint").alias(column)


def _counts(**parts: DataFrame) -> DataFrame:
    """Row counts of several tables as one table ``(part, n)``."""
    return q.union_all(
        [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n") for name, df in parts.items()]
    )


# --- scans, sources, sinks -----------------------------------------------------------------


def _landed(df: DataFrame, name: str) -> str:
    path = new_folder(df.sparkSession, name)
    df.write.json(path)
    return path


def _scanned(spark: SparkSession, path: str, spec: m.FeedSpec, of_records: Column) -> DataFrame:
    """Documents by fault and, as ``records``, their records, per run; each document is parsed once."""
    opened = documents.open_envelopes(documents.read_document_lines(spark, path), spec)
    what = F.coalesce("fault", F.lit("sound")).alias("what")
    rows = opened.select("run_id", what, "n_records", F.posexplode_outer("records").alias("pos", "record"))
    first = F.coalesce("pos", F.lit(0)) == 0
    counted = rows.groupBy("run_id", "what").agg(
        F.count_if(first).alias("n_documents"),
        F.sum(F.when(first, F.col("n_records"))).alias("n_records"),
        F.count("record").alias("exploded"),
        of_records.alias("told"),
    )
    counted = stage(counted, "document-counts")
    exploded = counted.where("exploded > 0").select(
        "run_id", F.lit("records").alias("what"), F.col("exploded").alias("n_documents"), F.col("told").alias("n_records")
    )
    return counted.select("run_id", "what", "n_documents", "n_records").unionByName(exploded)


@query
def scan_snapshot_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(w.vuln_documents(spark, sf_dir), "snapshot-documents")
    return _scanned(spark, path, m.VULN_FEED, F.count(F.expr("variant_get(record, '$.cveID', 'string')")))


@query
def scan_window_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(w.window_documents(spark, sf_dir), "window-documents")
    return _scanned(spark, path, m.IOC_FEED, F.countDistinct(F.expr("variant_get(record, '$.ioc', 'string')")))


@query
def scan_large_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document file for each run, cut into byte ranges: its fault and its records."""
    envelopes, batch = large_documents.scan_files(spark, w.snapshot_files(spark, sf_dir), m.VULN_FEED)
    name = F.expr("variant_get(record, '$.cveID', 'string')")
    told = batch.groupBy("run_id").agg(
        F.count("*").alias("read"),
        F.countDistinct(name).alias("n_ids"),
        F.min(name).alias("first_id"),
        F.max(name).alias("last_id"),
        F.count_if(F.expr("variant_get(record, '$.dueDate', 'string')").isNotNull()).alias("n_due"),
    )
    opened = envelopes.select("run_id", F.coalesce("fault", F.lit("sound")).alias("what"), "n_records", "run_ok")
    return opened.join(told, "run_id", "left").na.fill(0, ["read", "n_ids", "n_due"])


@query
def scan_stix_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(w.catalog_objects(spark, sf_dir), "catalogue-objects")
    objects = stage(catalog.read_object_lines(spark, path), "catalogue")  # the JSON is read once
    return _counts(
        objects=objects,
        software=catalog.software(objects),
        retired=catalog.retired(objects),
        patterns=catalog.patterns(objects),
        patterns_with_id=catalog.patterns(objects).where("technique_id != ''"),
        uses=catalog.uses(objects),
    )


@query
def validate_rule_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = rules.check_rules(w.rules(spark, sf_dir))
    return rules.rule_dimension(checked)


@query
def rule_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = rules.check_rules(w.rules(spark, sf_dir))
    return checked.where(F.col("fault").isNotNull()).groupBy("fault").agg(F.count("*").alias("n_rules"))


def _today(spark: SparkSession, sf_dir: str):
    """Today's observed rows, prior state, gate and watermarks of the event feeds."""
    events = w.event_rows(spark, sf_dir)
    sources = stage(w.event_sources(events), "sources")
    observed, prior = w.observed_today(events), w.prior_state(events)
    marks = w.watermarks(sources)
    gate = stage(d.publication_gate(w.runs(sources), marks, d.observed_counts(observed)), "gate")
    return observed, prior, gate, marks


def _state_columns() -> list:
    return [
        "source",
        "canonical_key",
        "value",
        "family",
        "status",
        _time("fallen_since"),
        _time("last_seen"),
        _time("ingested_at"),
    ]


@query
def state_read_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes two versions, reads the latest one back, joined with its watermarks."""
    root = new_folder(spark, "state")
    store = tables.StateTables(spark, root)
    started = datetime(2024, 1, 31)
    observed, prior, gate, marks = _today(spark, sf_dir)
    compared = stage(d.compare(observed, prior), "compared")
    reached = stage(d.advance_watermarks(marks, gate), "watermarks")
    for number, mode in enumerate((m.MODE_BASELINE, m.MODE_DIFFERENTIAL), 1):
        state = d.rebuild_state(compared, gate, mode, w.run_start())
        store.commit(f"run-{number}", number, state, reached, started)
    loaded = store.load()
    per_source = loaded.indicators.groupBy("source", "status").agg(F.count("*").alias("n"))
    return per_source.join(loaded.watermarks, "source", "left").select(
        "source", "status", "n", _time("watermark")
    )


@query
def state_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run is added to the log as its changes, then folded into a new base; every version, read back."""
    log = state_log.StateLog(spark, new_folder(spark, "state-log"), buckets=16)
    observed, prior, gate, marks = _today(spark, sf_dir)
    log.begin("run-1", 1, prior, marks, datetime(2024, 1, 1))
    changed = stage(state_log.changes(state_log.compare(observed, log.load()), gate, m.MODE_DIFFERENTIAL, w.run_start()), "changes")
    log.commit("run-2", 2, changed, d.advance_watermarks(marks, gate), datetime(2024, 1, 1))
    merged = stage(log.load().indicators, "merged")
    log.compact()
    versions = {"before": log.load(before=2).indicators, "merged": merged, "compacted": log.load().indicators}
    counted = [
        rows.groupBy("source", "status").agg(F.count("*").alias("n"), F.count("fallen_since").alias("n_since"), F.max("last_seen").alias("last_seen"))
        .select(F.lit(name).alias("version"), "source", "status", "n", "n_since", _time("last_seen"))
        for name, rows in versions.items()
    ]
    written = changed.where("differs").groupBy("source", "status").agg(F.count("*").alias("n"), F.count("fallen_since").alias("n_since"), F.max("last_seen").alias("last_seen"))
    return q.union_all([*counted, written.select(F.lit("written").alias("version"), "source", "status", "n", "n_since", _time("last_seen"))])


@query
def write_full_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "enriched-dump")
    enriched, mapping, _ = _enriched(spark, sf_dir)
    tables.write_enriched(in_parts(enriched, mapping), path)
    dumped = spark.read.parquet(path)
    of_record = lambda *names: F.md5(F.concat(*(F.try_variant_get("raw", f"$.{x}", "string") for x in names)))
    whole = F.when(F.col("type") == m.VULNERABILITY, of_record("cveID", "vendorProject", "vulnerabilityName")).otherwise(
        of_record("malware_printable", "threat_type")
    )
    return dumped.withColumn("raw_digest", whole).groupBy("source", "type").agg(
        F.count("*").alias("n"),
        # The digests travel as bytes, which are half of their text.
        F.countDistinct(F.unhex("id")).alias("n_ids"),
        F.sum("n_techniques").alias("n_techniques"),
        F.countDistinct(F.unhex("raw_digest")).alias("n_raw"),
        F.min("raw_digest").alias("first_raw"),
        F.max("raw_digest").alias("last_raw"),
    )


@query
def append_source_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends the runs of both feeds, one of them twice, and reads the history."""
    path = new_folder(spark, "source-runs")
    ioc, vuln = _ioc_runs(spark, sf_dir), _vuln_runs(spark, sf_dir)
    for runs in (ioc, vuln, vuln):
        tables.append_source_runs(runs, path)
    history = spark.read.parquet(path)
    return history.select(
        "source",
        F.col("run_id").cast("string").alias("run_id"),
        "status",
        "records",
        "invalid",
        "unsupported",
        "unsupported_excess",
        "declared_window",
        _time("attempt_time"),
        "failure_reason",
        _long("http_code"),
        _long("retries"),
        F.array_join(F.array_sort(F.map_keys("short_fields")), ",").alias("short_fields"),
        "coverage_not_evaluated",
    )


def _run_facts(counts: DataFrame, window: str | None) -> DataFrame:
    return counts.select(
        "source",
        "run_id",
        F.lit(window).cast("string").alias("declared_window"),
        F.to_timestamp(F.concat("run_id", F.lit("-12-31 06:00:00"))).alias("attempt_time"),
        F.lit(None).cast("string").alias("failure_reason"),
        F.lit(200).alias("http_code"),
        F.lit(0).alias("retries"),
    )


def _ioc_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, coverage = q.run_measures(n.normalize_ioc_feed(w.ioc_batch(spark, sf_dir)), m.IOC_FEED)
    return q.source_runs(counts, coverage, _run_facts(counts, "P5D/now"))


def _vuln_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, coverage = q.run_measures(n.normalize_vuln_feed(w.vuln_batch(spark, sf_dir)), m.VULN_FEED)
    return q.source_runs(counts, coverage, _run_facts(counts, None))


@query
def publish_report_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishes two days, the second one twice, and reads the latest."""
    root = new_folder(spark, "marts")
    by_type = r.count_by_type(w.observations(spark, sf_dir))
    first = r.count_by_type(w.ioc_observations(spark, sf_dir))
    tables.publish_marts({"by_type": first}, root, "2024-01-30")
    tables.publish_marts({"by_type": first}, root, "2024-01-31")
    tables.publish_marts({"by_type": by_type}, root, "2024-01-31")
    return tables.latest_mart(spark, root, "by_type").select(
        F.date_format("report_date", "yyyy-MM-dd").alias("report_date"), "type", "n_observations"
    )


# --- bulk normalisation --------------------------------------------------------------------


def _normalized_columns() -> list:
    return [
        "run_id",
        "verdict",
        "reason",
        "type",
        "value",
        "id",
        "canonical_key",
        "source_reference",
        _time("first_seen"),
        _time("last_seen"),
        _long("confidence"),
        F.array_join("tags", ",").alias("tags"),
    ]


@query
def normalize_vuln_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = n.normalize_vuln_feed(w.vuln_batch(spark, sf_dir))
    return rows.select(
        *_normalized_columns(),
        F.col("kev.vendorProject").alias("vendor"),
        F.col("kev.product").alias("product"),
        F.col("kev.dueDate").alias("due_date"),
        F.col("kev.knownRansomwareCampaignUse").alias("ransomware"),
    )


@query
def normalize_ioc_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = n.normalize_ioc_feed(w.ioc_batch(spark, sf_dir))
    return rows.select(*_normalized_columns(), "family_label", "family_id", "threat_type")


@query
def key_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return n.key_observations(w.ioc_observations(spark, sf_dir).select("source", "type", "raw_value"))


@query
def reportable_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = n.reportable(w.observations(spark, sf_dir))
    return rows.select(
        "id", "type", _long("confidence"), values.confidence_band(F.col("confidence")).alias("band")
    )


@query
def trivial_value_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return n.trivial_counts(n.reportable(w.observations(spark, sf_dir)))


# --- feed quality --------------------------------------------------------------------------


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["source", "run_id", "verdict", "reason"]
    ioc = n.normalize_ioc_feed(w.ioc_batch(spark, sf_dir)).select(columns)
    return ioc.unionByName(n.normalize_vuln_feed(w.vuln_batch(spark, sf_dir)).select(columns))


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ioc = q.field_coverage(w.ioc_batch(spark, sf_dir), m.IOC_FEED)
    return ioc.unionByName(q.field_coverage(w.vuln_batch(spark, sf_dir), m.VULN_FEED))


@query
def split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(spark, sf_dir).groupBy("source", "run_id", "verdict", "reason").agg(
        F.count("*").alias("n_records")
    )


def _measures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Verdict counts and field coverage of both feeds' runs."""
    ioc = q.run_measures(n.normalize_ioc_feed(w.ioc_batch(spark, sf_dir)), m.IOC_FEED)
    vuln = q.run_measures(n.normalize_vuln_feed(w.vuln_batch(spark, sf_dir)), m.VULN_FEED)
    return tuple(a.unionByName(b) for a, b in zip(ioc, vuln))


@query
def batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, coverage = _measures(spark, sf_dir)
    status = q.batch_status(counts, q.shortfalls(coverage))
    return status.select(
        "source", "run_id", "total", "records", "invalid", "unsupported", "n_short", "status"
    )


@query
def field_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir)


@query
def unsupported_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.unsupported_ratio(q.batch_counts(_verdicts(spark, sf_dir)))


@query
def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    ioc = q.missing_fields(w.ioc_batch(spark, sf_dir), (*m.IOC_FEED.expected_fields, "id"))
    return ioc.unionByName(q.missing_fields(w.vuln_batch(spark, sf_dir), (*m.VULN_FEED.expected_fields, "cwes")))


@query
def broken_time_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ioc = q.broken_time_formats(w.ioc_batch(spark, sf_dir), m.IOC_FEED.time_fields)
    return ioc.unionByName(q.broken_time_formats(w.vuln_batch(spark, sf_dir), m.VULN_FEED.time_fields))


@query
def envelope_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        q.envelope_verdict(documents.open_envelopes(docs, spec)).select("source", "run_id", "verdict")
        for docs, spec in (
            (w.vuln_documents(spark, sf_dir), m.VULN_FEED),
            (w.window_documents(spark, sf_dir), m.IOC_FEED),
        )
    ]
    return q.union_all(parts).groupBy("source", "run_id", "verdict").agg(F.count("*").alias("n_documents"))


@query
def catalog_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cc.catalog_profile(w.catalog_objects(spark, sf_dir))


@query
def catalog_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = cc.catalog_profile(w.catalog_objects(spark, sf_dir, 2))
    baseline = cc.catalog_profile(w.catalog_objects(spark, sf_dir, 1))
    return cc.catalog_drift(now, baseline)


@query
def catalog_object_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects that make the drift of the magnitudes."""
    return cc.catalog_object_drift(w.catalog_objects(spark, sf_dir, 2), w.catalog_objects(spark, sf_dir, 1))


@query
def retired_by_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = catalog.retired(w.catalog_objects(spark, sf_dir, 1))
    return cc.retired_by_identity(declared, catalog.retired(w.catalog_objects(spark, sf_dir, 2)))


@query
def enrichment_invariant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched rows with some reasons damaged on purpose; violations by rule."""
    enriched = _enriched(spark, sf_dir)[0].select("source", "value", "reason", "n_techniques")
    pick = F.conv(F.substring(F.md5("value"), 1, 2), 16, 10).cast("int")
    damaged = enriched.withColumn(
        "reason",
        F.when(pick < 8, F.lit(None))
        .when(pick < 16, F.lit(m.NO_ATTRIBUTION))
        .when(pick < 24, F.lit(m.PRODUCT_UNSPECIFIC))
        .when(pick < 28, F.lit("sin_motivo"))
        .otherwise(F.col("reason")),
    )
    kept, broken = e.enrichment_invariant(damaged)
    parts = kept.withColumn("violation", F.lit("none")).unionByName(broken)
    return parts.groupBy("source", "violation").agg(F.count("*").alias("n_rows"))


# --- entity resolution and enrichment ------------------------------------------------------


@query
def canonicalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = w.ioc_families(spark, sf_dir).select(F.col("malware_printable").alias("name"))
    software = catalog.software(w.catalog_objects(spark, sf_dir))
    named = software.select(F.explode(F.concat(F.array("name"), F.coalesce("x_mitre_aliases", F.array()))).alias("name"))
    return fam.canonical_names(shown.where("name is not null"), named)


def _family_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fam.family_names(w.ioc_families(spark, sf_dir))


@query
def group_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fam.group_families(_family_names(spark, sf_dir))


@query
def family_name_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _family_names(spark, sf_dir)


@query
def family_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fam.family_candidates(_family_names(spark, sf_dir))
    return rows.select("family_id", "canon", _long("rank"), "name", "authority")


@query
def catalog_name_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    software = catalog.software(w.catalog_objects(spark, sf_dir))
    return fam.catalog_index(fam.catalog_names(software))


@query
def software_techniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edges(spark, sf_dir)


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    software = catalog.software(w.catalog_objects(spark, sf_dir))
    # Read several times below: written once instead of folding the names again for each.
    names = stage(_family_names(spark, sf_dir), "family-names")
    candidates = stage(fam.family_candidates(names), "candidates")
    return fam.resolve_families(names, candidates, fam.catalog_index(fam.catalog_names(software)))


@query
def resolve_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = w.catalog_objects(spark, sf_dir)
    return fam.software_techniques(
        catalog.software(objects), catalog.patterns(objects), catalog.uses(objects)
    )


def _mapped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The published tables of the resolution: mapping per family and technique rows."""
    resolved = lambda *_: w.landed(spark, sf_dir, "resolved", _resolved)
    techniques = w.landed(
        spark, sf_dir, "family-techniques", lambda *at: fam.family_techniques(resolved(), _edges(*at))
    )
    mapping = w.landed(
        spark, sf_dir, "family-mapping", lambda *_: fam.family_mapping(resolved(), techniques)
    )
    return mapping, techniques


def landings():
    """(name, function that writes it) of the published tables of the resolution and the rules."""
    yield "resolved", lambda spark, sf_dir: w.landed(spark, sf_dir, "resolved", _resolved)
    yield "family-techniques", _mapped  # and family-mapping
    yield "rules", _rules


@query
def family_techniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fam.family_techniques(stage(_resolved(spark, sf_dir), "resolved"), _edges(spark, sf_dir))


@query
def family_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = stage(_resolved(spark, sf_dir), "resolved")
    techniques = stage(fam.family_techniques(resolved, _edges(spark, sf_dir)), "family-techniques")
    return fam.family_mapping(resolved, techniques).select(
        "family_id",
        "reason",
        "software_id",
        "n_techniques",
        F.array_join("technique_ids", ",").alias("technique_ids"),
        _named_techniques(),
        "mapping_confidence",
        "rationale",
    )


def _named_techniques() -> Column:
    named = F.transform("techniques", lambda t: F.concat_ws("=", t["technique_id"], t["technique_name"]))
    return F.array_join(named, ",").alias("techniques")


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published rule dimension."""
    return w.landed(
        spark, sf_dir, "rules", lambda *at: rules.rule_dimension(rules.check_rules(w.rules(*at)))
    )


@query
def vector_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = w.vuln_observations(spark, sf_dir).select(
        F.col("kev.vendorProject").alias("vendor"), F.col("kev.product").alias("product")
    )
    return e.vector_lookup(entries, _rules(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    # Landed first: the families are then taken from the same observations.
    observed = w.observations(spark, sf_dir).drop("verdict", "reason", "failed_checks")
    mapping, techniques = _mapped(spark, sf_dir)
    return e.enrich_observations(observed, mapping, _rules(spark, sf_dir)), mapping, techniques


def _enriched_vulns(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = w.vuln_observations(spark, sf_dir).drop("verdict", "reason", "failed_checks")
    return e.enrich_by_product(observed, _rules(spark, sf_dir))


@query
def enrich_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)[0].select(
        "id",
        "source",
        "reason",
        F.array_join("technique_ids", ",").alias("technique_ids"),
        "n_techniques",
        _named_techniques(),
        "mapping_method",
        "mapping_confidence",
        "rationale",
    )


@query
def enrich_unavailable(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = w.observations(spark, sf_dir).drop("verdict", "reason", "failed_checks")
    rows = e.enrich_observations(observed, None, None)
    return rows.groupBy("source", "reason").agg(
        F.count("*").alias("n_rows"), F.sum("n_techniques").alias("n_techniques")
    )


@query
def consolidate_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = w.event_rows(spark, sf_dir).select(
        "canonical_key",
        "source",
        "confidence",
        F.concat_ws("/", F.lit("ref"), "source", "family").alias("source_reference"),
        F.col("last_seen").alias("first_seen"),
        "last_seen",
    )
    out = e.consolidate_sources(rows)
    return out.select(
        "canonical_key",
        _long("confidence"),
        F.array_join(F.transform("references", lambda x: x["reference"]), ",").alias("references"),
        "n_sources",
        _time("first_seen"),
        _time("last_seen"),
    )


# --- aggregates ----------------------------------------------------------------------------


@query
def technique_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping, techniques = _mapped(spark, sf_dir)
    return r.technique_frequency(techniques, mapping)


@query
def technique_frequency_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping, techniques = _mapped(spark, sf_dir)
    return r.technique_frequency_top(techniques, mapping)


_PERIODS: dict[tuple[str, str], run.Applied] = {}


def _period(spark: SparkSession, sf_dir: str) -> run.Applied:
    """The second of two runs of the vulnerability feed against the retained state; between them the entries of
    two weeks joined it. Applied once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PERIODS:
        store = state_log.StateLog(spark, new_folder(spark, "period-state"), buckets=16)
        valid = w.vuln_observations(spark, sf_dir)
        earlier = valid.where(~F.coalesce(w.in_period(F.col("_added")), F.lit(False)))
        for sequence, (started, rows) in enumerate(((_FIRST_RUN, earlier), (_SECOND_RUN, valid)), 1):
            runs = st.all_correct(rows, started)
            applied = run.apply_run(store, f"run-{sequence}", sequence, started, rows.select(*n.OBSERVATION_COLUMNS), runs)
        _PERIODS[key] = applied
    return _PERIODS[key]


_FIRST_RUN, _SECOND_RUN = datetime(1998, 6, 1), datetime(1998, 6, 15)


def _new_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that the second run found new."""
    return _period(spark, sf_dir).new_keys().select("canonical_key")


@query
def inferred_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.inferred_frequency(_enriched_vulns(spark, sf_dir), _new_entries(spark, sf_dir))


@query
def reasons_by_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.reasons_by_family(_mapped(spark, sf_dir)[0])


@query
def reasons_by_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.reasons_by_record(_enriched(spark, sf_dir)[0])


@query
def kev_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage per yearly run, with the stage down in one of them."""
    rows = _enriched_vulns(spark, sf_dir)
    down = F.col("run_id") == "1999"
    rows = rows.withColumns(
        {
            "reason": F.when(down, F.lit(m.STAGE_UNAVAILABLE)).otherwise(F.col("reason")),
            "n_techniques": F.when(down, F.lit(0)).otherwise(F.col("n_techniques")),
        }
    ).select("source", "run_id", "reason", "n_techniques")
    ran = rows.groupBy("source", "run_id").agg(F.count("*").alias("total"))
    return r.kev_coverage(rows, w.feed_runs(ran))


def _event_observations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = w.event_rows(spark, sf_dir)
    return events, w.runs(w.event_sources(events))


@query
def census_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.census_by_source(*_event_observations(spark, sf_dir))


@query
def census_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families by feed that names them: published for a correct one, NULL for a partial one."""
    events, runs = _event_observations(spark, sf_dir)
    return q.union_all(
        [
            r.census_families(events, runs, feed, "family").select(F.lit(feed).alias("family_feed"), "n_families")
            for feed in ("click-0", "error-0", "error-2")
        ]
    )


@query
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds from raw records to the report, twice: a baseline, then what two weeks changed."""
    store = state_log.StateLog(spark, new_folder(spark, "run-state"), buckets=16)
    ioc = w.ioc_batch(spark, sf_dir)
    parts = []
    for number, started in enumerate((_FIRST_RUN, _SECOND_RUN), 1):
        name = f"run-{number}"
        # What a run stages is read by its own report only; the state and the parts of the report stay.
        with scratch(spark), released_shuffles(spark):
            feeds = [
                run.Feed(m.VULN_FEED, n.normalize_vuln_feed, w.chain_records(spark, sf_dir, name, number == 2)),
                run.Feed(m.IOC_FEED, n.normalize_ioc_feed, ioc.withColumn("run_id", F.lit(name))),
            ]
            facts = spark.createDataFrame(
                [(feed.spec.name, name, "P20D/now", started, None, 200, 0) for feed in feeds],
                "source string, run_id string, declared_window string, attempt_time timestamp, failure_reason string, http_code int, retries int",
            )
            applied, marts = run.full_run(store, name, number, started, feeds, facts, _rules(spark, sf_dir), _mapped(spark, sf_dir)[0])
            told = lambda part, rows, detail, n: rows.select(F.lit(part).alias("part"), detail.cast("string").alias("detail"), n.cast("bigint").alias("n"))
            count = lambda part, rows: told(part, rows.agg(F.count("*").alias("n")), F.lit(None), F.col("n"))
            state = applied.version.indicators.groupBy("source", "status").agg(F.count("*").alias("n"))
            tables_ = [
                told("mode", marts["source_runs"].limit(1), F.lit(applied.mode), F.lit(number)),
                told("status", marts["source_runs"], F.concat_ws(":", "source", "status"), F.col("records")),
                told("new", marts["diff_sources"], F.col("source"), F.col("n_new")),
                told("fallen", marts["diff_sources"], F.col("source"), F.col("n_fallen")),
                told("state", state, F.concat_ws(":", "source", "status"), F.col("n")),
                told("inferred", marts["inferred_frequency"], F.coalesce("technique_id", "reason"), F.col("n_entries")),
                told("census", marts["census"], F.col("source"), F.col("n_observations")),
                told("families", marts["families"], F.lit(None), F.col("n_families")),
                *(count(part, marts[part]) for part in ("due_soon", "illegible_due", "vuln_section", "work_queue")),
                told("work_queue_total", marts["work_queue_total"], F.lit(None), F.col("total")),
            ]
            parts.append(stage(q.union_all(tables_).withColumn("run", F.lit(name)), "run-parts", keep=True))
    return q.union_all(parts)


@query
def count_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.count_by_type(w.observations(spark, sf_dir))


@query
def family_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed, prior, gate, _ = _today(spark, sf_dir)
    return d.family_variation(observed, prior, gate)


@query
def family_variation_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed, prior, gate, _ = _today(spark, sf_dir)
    return r.family_variation_top(d.family_variation(observed, prior, gate))


def _members(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    observed, prior, gate, _ = _today(spark, sf_dir)
    return d.diff_members(d.compare(observed, prior), gate), gate


def _diff_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.diff_sources(*_members(spark, sf_dir))


@query
def diff_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals, and below them a row for each source that the total of fallen leaves out."""
    per_source = stage(_diff_sources(spark, sf_dir), "diff-sources")
    totals = r.diff_totals(per_source).withColumn("suppressed_source", F.lit(None).cast("string"))
    left_out = r.suppressed_sources(per_source).withColumnRenamed("source", "suppressed_source")
    return totals.unionByName(left_out, allowMissingColumns=True)


@query
def source_status_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, coverage = _measures(spark, sf_dir)
    status = q.batch_status(counts, q.shortfalls(coverage))
    evaluated = coverage.groupBy("source", "run_id").agg(F.bool_or("evaluated").alias("evaluated"))
    return r.source_status_table(status.join(evaluated, ["source", "run_id"]), coverage)


def _state_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the state holds of the feed; a run that brought nothing would leave it as it is."""
    return run.state_entries(_period(spark, sf_dir).version)


def _due_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.entries(w.vuln_observations(spark, sf_dir))


@query
def judgement_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    soon = r.due_soon(_state_entries(spark, sf_dir), w.today())
    feed_status = q.batch_status(q.batch_counts(w.normalized_ioc(spark, sf_dir)))
    return r.judgement_counts(soon, _mapped(spark, sf_dir)[0], _diff_sources(spark, sf_dir), feed_status)


@query
def enrichment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched, mapping, _ = _enriched(spark, sf_dir)
    kept, broken = e.enrichment_invariant(enriched)
    feed_status = q.batch_status(q.batch_counts(w.normalized_ioc(spark, sf_dir)))
    return r.enrichment_summary(kept, mapping, broken, feed_status)


# --- differences and state -----------------------------------------------------------------


@query
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: set sizes per source, with the flags that qualify them."""
    return _diff_sources(spark, sf_dir).select(
        "source",
        "status",
        "rule",
        "n_observed",
        "n_new",
        "n_reappeared",
        "n_fallen",
        "in_baseline",
        "new_reading_degraded",
        "additions_lost_risk",
    )


@query
def dedupe_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.dedupe_observed(w.event_rows(spark, sf_dir))
    return rows.select("source", "canonical_key", "value", "family", _time("last_seen"), _time("ingested_at"))


def _one_set(spark: SparkSession, sf_dir: str, member: str) -> DataFrame:
    rows = d.only(_members(spark, sf_dir)[0], member)
    return rows.select("source", "canonical_key", "value", "family", _time("last_seen"))


@query
def new_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_set(spark, sf_dir, d.NEW)


@query
def reappeared_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_set(spark, sf_dir, d.REAPPEARED)


@query
def fallen_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_set(spark, sf_dir, d.FALLEN_SET)


@query
def source_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval of every daily run of every source to its run before."""
    days = w.event_rows(spark, sf_dir).select("source", F.col("ingested_at").alias("day")).distinct()
    runs = days.select(F.concat_ws("@", "source", _day_text("day")).alias("source"), F.col("day").alias("attempt_time"))
    marks = days.select(
        F.concat_ws("@", "source", _day_text(F.date_add("day", 1))).alias("source"),
        F.col("day").alias("watermark"),
    )
    return d.source_interval(runs, marks).select(
        "source", F.col("interval_seconds").cast("bigint").alias("interval_seconds")
    )


def _day_text(day) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


@query
def merge_state_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = w.prior_state(w.event_rows(spark, sf_dir))
    rows = d.merge_state_sources(state)
    listed = F.transform("sources", lambda s: F.concat_ws("=", s["source"], s["status"]))
    return rows.select(
        "canonical_key",
        "value",
        "family",
        _time("last_seen"),
        _time("ingested_at"),
        F.array_join(listed, ",").alias("sources"),
    )


@query
def publication_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = _today(spark, sf_dir)[2]
    return gate.select(
        "source",
        "status",
        "n_observed",
        "rule",
        F.col("interval_seconds").cast("bigint").alias("interval_seconds"),
        "window_seconds",
        "sets_computed",
        "fallen_published",
        "unpublished_reason",
        "in_baseline",
        "new_reading_degraded",
        "additions_lost_risk",
    )


@query
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, gate, marks = _today(spark, sf_dir)
    return d.advance_watermarks(marks, gate).select("source", _time("watermark"))


@query
def rebuild_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed, prior, gate, _ = _today(spark, sf_dir)
    state = d.rebuild_state(d.compare(observed, prior), gate, m.MODE_DIFFERENTIAL, w.run_start())
    return state.select(*_state_columns())


@query
def mark_and_prune_fallen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the prior rows that today's run did not see, in both modes."""
    observed, prior, gate, _ = _today(spark, sf_dir)
    compared = d.compare(observed, prior)
    parts = []
    for mode in (m.MODE_DIFFERENTIAL, m.MODE_BASELINE):
        kept = d.rebuild_state(compared.where(F.col("now").isNull()), gate, mode, w.run_start())
        parts.append(
            kept.groupBy("source", "status").agg(F.count("*").alias("n")).withColumn("mode", F.lit(mode))
        )
    return q.union_all(parts)


@query
def run_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.run_mode(w.run_history(spark, sf_dir)).select(
        "run_id", "mode", "baseline_reason", _time("next_baseline_instant")
    )


@query
def freshness_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.freshness_warnings(_today(spark, sf_dir)[2])
    return rows.select("source", F.col("interval_seconds").cast("bigint").alias("interval_seconds"), "cause")


@query
def unpublished_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of today's differential and of the same day as a baseline."""
    gate = _today(spark, sf_dir)[2]
    history = w.run_history(spark, sf_dir)
    modes = d.run_mode(history)
    parts = [
        r.unpublished_ledger(gate, modes.where(F.col("run_id") == day).select("mode"), available).withColumn(
            "run_id", F.lit(day)
        )
        for day, available in (("2024-01-04", True), ("2024-01-10", False))
    ]
    return q.union_all(parts)


# --- rankings ------------------------------------------------------------------------------


@query
def due_soon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.due_soon(_state_entries(spark, sf_dir), w.today()).select("value", "due_date", "ransomware")


@query
def illegible_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.illegible_due(_due_entries(spark, sf_dir)).select("value", "due_date")


@query
def decision_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.decision_order(_due_entries(spark, sf_dir), w.today())
    return rows.select("value", "due_date", _long("decision_band"), _long("decision_days"), "no_ransomware")


def _vuln_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _period(spark, sf_dir).gate


@query
def vuln_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The differential section and the baseline section, told apart by ``mode``."""
    entries = _state_entries(spark, sf_dir)
    gate = _vuln_gate(spark, sf_dir)
    diff = r.vuln_section_differential(entries, _new_entries(spark, sf_dir), gate, w.today())
    head = r.vuln_section_baseline(entries, w.today())
    return (
        diff.select(F.lit("diferencial").alias("mode"), "value", "due_date", F.lit(None).cast("bigint").alias("total"))
        .unionByName(head.select(F.lit("linea_base").alias("mode"), "value", "due_date", "total"))
    )


def _unclassified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _enriched_vulns(spark, sf_dir).where(F.col("reason") == m.PRODUCT_UNCLASSIFIED)
    return w.entries(rows)


@query
def work_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue of the period; its last row, without a value, states the total of all open entries."""
    open_ = _unclassified(spark, sf_dir)
    rows = r.work_queue(open_, w.today(), _new_entries(spark, sf_dir), _vuln_gate(spark, sf_dir))
    rows = rows.select("value", "due_date", "ransomware", "total")
    return rows.unionByName(r.work_queue_total(open_), allowMissingColumns=True)


@query
def work_queue_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.work_queue_head(_unclassified(spark, sf_dir), w.today()).select("value", "due_date", "total")


@query
def highlighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = r.highlighted(_enriched(spark, sf_dir)[0])
    return rows.withColumn("confidence", _long("confidence"))


@query
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    soon = r.due_soon(_due_entries(spark, sf_dir), w.today())
    events = w.event_rows(spark, sf_dir)
    return r.recommendations(soon, w.runs(w.event_sources(events)))


# --- streaming -----------------------------------------------------------------------------


@query
def stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three drops arrive one after the other; returns the state after the last."""
    root = new_folder(spark, "stream")
    engine = st.StreamSnapshots(spark, f"{root}/out")
    events = stage(w.event_rows(spark, sf_dir), "event-rows")
    for number, day in enumerate(w.SNAPSHOT_DAYS[1:]):
        started = datetime.fromisoformat(day)
        drop = events.where(F.col("snapshot") == number).drop("snapshot")
        drop = drop.withColumn("run_start", F.lit(started).cast("timestamp"))
        drop.write.mode("append").parquet(f"{root}/landing")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in drop.schema)
        engine.drain(f"{root}/landing", schema, f"{root}/checkpoint")
    return engine.state.load().indicators.select(*_state_columns())


@query
def stream_reappearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three drops followed key by key; the second one lands last."""
    root = new_folder(spark, "follow")
    events = w.event_rows(spark, sf_dir).select("source", "canonical_key", "snapshot")
    follower = st.KeySightings(spark, f"{root}/out", 10 * values.DAY_SECONDS)
    for number in (0, 2, 1):
        started = F.lit(w.SNAPSHOT_DAYS[number + 1]).cast("timestamp")
        drop = events.where(F.col("snapshot") == number).select("source", "canonical_key", started.alias("run_start"))
        drop.write.mode("append").parquet(f"{root}/landing")
        schema = "source string, canonical_key string, run_start timestamp"
        follower.drain(f"{root}/landing", schema, f"{root}/checkpoint")
    return follower.members().select("source", "canonical_key", "member", _time("run_start"))


@query
def sliding_family_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in three drops, each with days of the whole period; windows are closed two days after their end."""
    root = new_folder(spark, "census")
    k = F.get_json_object("props", "$.k").cast("int")
    rows = w.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("seen_at"), F.concat(F.lit("fam"), k).alias("family")
    )
    census = st.SlidingCensus(spark, f"{root}/out", delay="2 days")
    for number in (2, 0, 1):
        rows.where(F.dayofyear("seen_at") % 3 == number).write.mode("append").parquet(f"{root}/landing")
        census.drain(f"{root}/landing", "seen_at timestamp, family string", f"{root}/checkpoint")
    return census.census().select(
        F.date_format("start", "yyyy-MM-dd").alias("window_start"), "n_families", "n_observations", "closed"
    )
