from datetime import date

from pyspark.sql import functions as F

from feedmark import model as m
from feedmark.operators import normalize as n, reports as r

def today():
    return F.lit(date(2024, 6, 15))
ENTRIES = "canonical_key string, value string, due_date string, ransomware string"


def entries(spark, *rows):
    return spark.createDataFrame([(v, v, d, x) for v, d, x in rows], ENTRIES)


DUE = [
    ("old", "2021-01-01", "Unknown"), ("recent", "2024-06-14", "Unknown"), ("today", "2024-06-15", "Unknown"),
    ("in7", "2024-06-22", "Unknown"), ("in8", "2024-06-23", "Unknown"), ("odd", "n/a", "Known"), ("none", None, "Unknown"),
    ("ransom", "2024-06-22", "known"),
]


def test_decision_order(spark):
    got = [x["value"] for x in r.decision_order(entries(spark, *DUE), today()).collect()]
    assert got == ["today", "ransom", "in7", "in8", "recent", "old", "odd", "none"]


def test_due_soon_and_illegible(spark):
    assert [x["value"] for x in r.due_soon(entries(spark, *DUE), today()).collect()] == ["today", "in7", "ransom"]
    assert [x["value"] for x in r.illegible_due(entries(spark, *DUE)).collect()] == ["odd"]


def test_sections(spark):
    table = entries(spark, *DUE)
    new = spark.createDataFrame([("old",), ("in8",)], "canonical_key string")
    gate = lambda first: spark.createDataFrame([("cisa-kev", first)], "source string, in_baseline boolean")
    got = r.vuln_section_differential(table, new, gate(False), today()).collect()
    assert [x["value"] for x in got] == ["today", "ransom", "in7", "in8", "old"]
    assert r.vuln_section_differential(table, new, gate(True), today()).count() == 0
    assert r.vuln_section_differential(table, new, gate(False).limit(0), today()).count() == 0
    head = r.vuln_section_baseline(table, today(), head=1)
    assert sorted(x["value"] for x in head.collect()) == ["in7", "ransom", "today"]
    assert {x["total"] for x in head.collect()} == {8}


def test_work_queue(spark):
    table = entries(spark, *DUE)
    new = spark.createDataFrame([("odd",), ("today",)], "canonical_key string")
    gate = lambda first: spark.createDataFrame([("cisa-kev", first)], "source string, in_baseline boolean")
    got = r.work_queue(table, today(), new, gate(False)).collect()
    assert [(x["value"], x["total"]) for x in got] == [("today", 8), ("odd", 8)]
    for shut in (gate(True), gate(False).limit(0)):
        assert r.work_queue(table, today(), new, shut).count() == 0
    assert r.work_queue_total(table).first()["total"] == 8
    head = r.work_queue_head(table, today(), head=2).collect()
    assert [(x["value"], x["total"]) for x in head] == [("today", 8), ("ransom", 8)]


def test_highlighted_and_trivial(spark):
    rows = [("k1", m.MD5, m.TRIVIAL_DIGESTS[0].upper(), 99), ("k2", m.URL, "http://a.b", 80), ("k0", m.URL, "http://c.d", 80),
            ("k3", m.DOMAIN, "low.example", 29), ("k4", m.VULNERABILITY, "CVE-1", 90), ("k5", m.DOMAIN, "edge.example", 30)]
    table = spark.createDataFrame([(k, t, v, c, "threatfox", None, ["T1001"]) for k, t, v, c in rows],
                                  "canonical_key string, type string, value string, confidence int, source string, family_label string, technique_ids array<string>")
    got = [(x["shown"], x["techniques"]) for x in r.highlighted(table).collect()]
    assert got == [("hxxp://c[.]d", "T1001"), ("hxxp://a[.]b", "T1001"), ("edge[.]example", "T1001")]
    counts = {x["type"]: (x["n_kept"], x["n_removed"]) for x in n.trivial_counts(n.reportable(table)).collect()}
    assert counts == {m.MD5: (0, 1), m.URL: (2, 0), m.DOMAIN: (1, 0)}


def test_kev_coverage_gates(spark):
    rows = [("ok", None, 1), ("ok", m.PRODUCT_UNCLASSIFIED, 0), ("ok", m.PRODUCT_UNSPECIFIC, 0), ("ok", None, 1),
            ("304", None, 1), ("part", None, 1), ("down", m.STAGE_UNAVAILABLE, 0), ("unknown", None, 1)]
    enriched = spark.createDataFrame([("cisa-kev", run, reason, t) for run, reason, t in rows],
                                     "source string, run_id string, reason string, n_techniques long")
    runs = spark.createDataFrame(
        [("cisa-kev", run, status, code) for run, status, code in (
            ("ok", m.OK, 200), ("304", m.OK, 304), ("part", m.PARTIAL, 200), ("down", m.OK, 200), ("unknown", None, None), ("empty", m.OK, 200))],
        "source string, run_id string, status string, http_code int")
    got = {x["run_id"]: (x["coverage"], x["gate"], x["processed"]) for x in r.kev_coverage(enriched, runs).collect()}
    assert got == {"ok": (0.5, None, 4), "304": (None, "unchanged", 0), "part": (None, "run_not_correct", 1),
                   "down": (None, "stage_unavailable", 1), "unknown": (None, "run_not_correct", 1), "empty": (None, "nothing_processed", 0)}


def test_inferred_frequency_without_denominator(spark):
    enriched = spark.createDataFrame([("k", "inferred", ["T1190"]), ("k2", None, [])], "canonical_key string, mapping_method string, technique_ids array<string>")
    new = spark.createDataFrame([("k",), ("k2",)], "canonical_key string")
    row = r.inferred_frequency(enriched, new).first()
    assert (row["n_entries"], row["total_entries"], row["percent"]) == (1, 2, 50)
    assert row["reason"] is None
    alone = lambda df: [(x["technique_id"], x["total_entries"], x["reason"]) for x in df.collect()]
    assert alone(r.inferred_frequency(enriched, new.limit(0))) == [(None, 0, "no_denominator")]
    assert alone(r.inferred_frequency(enriched, new.where("canonical_key = 'k2'"))) == [(None, 1, "no_vectors")]
    assert alone(r.inferred_frequency(enriched, new, m.MODE_BASELINE)) == [(None, None, "baseline_mode")]


def test_reasons_by_record_use_their_own_source(spark):
    rows = [("threatfox", m.NO_ATTRIBUTION), ("threatfox", m.FAMILY_NO_ENTRY), ("threatfox", None), ("cisa-kev", m.PRODUCT_UNCLASSIFIED), ("cisa-kev", m.STAGE_UNAVAILABLE)]
    got = {x["reason"]: (x["n"], x["denominator"]) for x in r.reasons_by_record(spark.createDataFrame(rows, "source string, reason string")).collect()}
    assert got == {m.NO_ATTRIBUTION: (1, 3), m.PRODUCT_UNCLASSIFIED: (1, 2)}


def test_census_excludes_incorrect_sources(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "source string")
    runs = spark.createDataFrame([("a", m.OK), ("b", m.PARTIAL), ("c", m.OK)], "source string, status string")
    got = {x["source"]: (x["included"], x["n_observations"]) for x in r.census_by_source(rows, runs).collect()}
    assert got == {"a": (True, 2), "b": (False, None), "c": (True, 0)}


def test_recommendations_and_judgements(spark):
    soon = entries(spark, ("v1", "2024-06-16", "Known"), ("v2", "2024-06-15", "x"), ("v3", "2024-06-17", None), ("v4", "2024-06-18", None))
    runs = spark.createDataFrame([("b", m.FAILED), ("a", m.PARTIAL), ("c", m.OK)], "source string, status string")
    got = sorted((x["action"], x["n"], x["detail"]) for x in r.recommendations(soon, runs).collect())
    assert got == [("patch", 4, "2024-06-15 v2,2024-06-16 v1,2024-06-17 v3"), ("review_collection", 2, "a"), ("review_collection", 2, "b")]
    assert r.recommendations(soon.limit(0), runs.where("status = 'correcta'")).count() == 0
    mapping = spark.createDataFrame([("f", m.FAMILY_NO_ENTRY), ("g", None)], "family_id string, reason string")
    sources = spark.createDataFrame([("a", None), ("b", 0)], "source string, n_fallen long")
    feed = lambda status: spark.createDataFrame([("threatfox", status)], "source string, status string")
    judged = lambda mapping, runs: {x["judgement"]: (x["part"], x["total"]) for x in r.judgement_counts(soon, mapping, sources, runs).collect()}
    always = {"due_soon_with_ransomware": (1, 4), "sources_with_fallen_suppressed": (1, 2)}
    assert judged(mapping, feed(m.OK)) == always | {"families_without_entry": (1, 2)}
    for shut in ((mapping, feed(m.FAILED)), (mapping, feed(m.OK).limit(0)), (None, feed(m.OK))):
        assert judged(*shut) == always


def test_diff_totals_keep_null(spark):
    rows = spark.createDataFrame([("a", 1, 0, 2), ("b", 3, 1, None)], "source string, n_new long, n_reappeared long, n_fallen long")
    row = r.diff_totals(rows).first()
    assert (row["n_new"], row["n_reappeared"], row["n_fallen"], row["n_sources_with_fallen"]) == (4, 1, 2, 1)
    assert [x["source"] for x in r.suppressed_sources(rows).collect()] == ["b"]
    assert r.diff_totals(rows.where("source = 'b'")).first()["n_fallen"] is None


def test_freshness_is_strict(spark):
    rows = spark.createDataFrame([("a", m.OK, 129600.0), ("b", m.OK, 129600.5), ("c", m.PARTIAL, 200000.0), ("d", m.OK, None)],
                                 "source string, status string, interval_seconds double")
    got = {x["source"]: x["cause"] for x in r.freshness_warnings(rows).collect()}
    assert got == {"b": "watermark_did_not_advance", "c": "source_not_correct"}
