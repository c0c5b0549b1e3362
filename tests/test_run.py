"""The chain over consecutive runs, from raw records: what a run leaves behind decides what the next one says."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedmark import model as m
from feedmark.functions import records
from feedmark.operators import normalize as n, run
from feedmark.sources.state_log import StateLog

FACTS = "source string, run_id string, declared_window string, attempt_time timestamp, failure_reason string, http_code int, retries int"


def entry(number, due="2024-01-20", **changes):
    return {"cveID": f"CVE-{number}", "vendorProject": "V", "product": "P", "vulnerabilityName": "N", "dateAdded": "2024-01-01",
            "dueDate": due, "knownRansomwareCampaignUse": "Known", **changes}


@pytest.fixture
def runner(spark, tmp_path):
    store = StateLog(spark, str(tmp_path / "state"), buckets=4)
    rules = spark.createDataFrame([], "vendor_canon string, product_canon string, technique string, unspecific boolean, rationale string")

    def go(number, day, items, http_code=200):
        started = datetime(2024, 1, day)
        schema = "source string, run_id string, body string"
        rows = spark.createDataFrame([(m.VULN_FEED.name, f"r{number}", json.dumps(i)) for i in items], schema)
        batch = rows.select("source", "run_id", records.parse(F.col("body")).alias("record"))
        facts = spark.createDataFrame([(m.VULN_FEED.name, f"r{number}", None, started, None, http_code, 0)], FACTS)
        feeds = [run.Feed(m.VULN_FEED, n.normalize_vuln_feed, batch)]
        return run.full_run(store, f"r{number}", number, started, feeds, facts, rules)

    return go


def values(df):
    return sorted(r["value"] for r in df.collect())


def test_a_baseline_then_a_differential(runner):
    applied, marts = runner(1, 10, [entry(1), entry(2), entry(3, due="2024-01-12")])
    assert (applied.mode, applied.baseline_reason) == (m.MODE_BASELINE, m.STATE_ABSENT)
    assert values(marts["vuln_section"]) == ["CVE-1", "CVE-2", "CVE-3"] and values(marts["due_soon"]) == ["CVE-3"]
    assert marts["diff_sources"].first()["n_new"] == 0 and marts["diff_sources"].first()["n_fallen"] is None
    applied, marts = runner(2, 15, [entry(1), entry(3, due="2024-01-12"), entry(4, due="n/a")])
    assert applied.mode == m.MODE_DIFFERENTIAL
    members = {(r["value"], r["member"]) for r in marts["members"].collect()}
    assert members == {("CVE-1", "kept"), ("CVE-3", "kept"), ("CVE-4", "new"), ("CVE-2", "fallen")}
    # due soon is read from the state: the fallen entry is still due
    assert values(marts["due_soon"]) == ["CVE-1", "CVE-2"] and values(marts["illegible_due"]) == ["CVE-4"]
    assert values(marts["vuln_section"]) == ["CVE-1", "CVE-2", "CVE-4"]
    assert marts["inferred_frequency"].first()["total_entries"] == 1  # the new one, not the whole catalogue


def test_a_partial_run_defers_and_a_later_one_catches_up(runner):
    runner(1, 10, [entry(1), entry(2)])
    damaged = [entry(1), entry(5), entry(6, dateAdded="soon")]
    applied, marts = runner(2, 11, damaged)
    assert [(r["status"], r["records"], r["invalid"]) for r in marts["source_runs"].collect()] == [(m.PARTIAL, 2, 1)]
    assert marts["diff_sources"].first()["n_new"] == 0 and marts["diff_sources"].first()["n_fallen"] is None
    assert marts["census"].first()["n_observations"] is None and values(applied.version.indicators) == ["CVE-1", "CVE-2"]
    applied, marts = runner(3, 12, [entry(1), entry(5), entry(6)])
    assert {(r["value"], r["member"]) for r in marts["members"].collect()} == {
        ("CVE-1", "kept"), ("CVE-5", "new"), ("CVE-6", "new"), ("CVE-2", "fallen")}


def test_total_failure_leaves_the_state_alone(runner):
    runner(1, 10, [entry(1), entry(2)])
    applied, marts = runner(2, 11, [entry(3, dateAdded="soon")])
    assert applied.mode == m.MODE_TOTAL_FAILURE and set(marts) == {"source_runs"}
    applied, marts = runner(3, 12, [entry(1), entry(2)])
    assert applied.mode == m.MODE_DIFFERENTIAL and marts["diff_sources"].first()["n_new"] == 0


def test_the_reports_rows_leave_the_raw_record_behind(runner, monkeypatch):
    written, stage = {}, run.stage
    monkeypatch.setattr(run, "stage", lambda df, name: written.setdefault(name, df.columns) and stage(df, name))
    runner(1, 10, [entry(1)])
    assert "raw" not in written["enriched"] and "raw" in written[f"{m.VULN_FEED.name}-normalized"]
