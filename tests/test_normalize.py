import json

from pyspark.sql import functions as F

from feedmark import model as m
from feedmark.functions import records, values
from feedmark.operators import normalize as n, quality as q
from feedmark.sources import documents


def batch(spark, items, source="threatfox", run="r1"):
    rows = [(source, run, json.dumps(item)) for item in items]
    return spark.createDataFrame(rows, "source string, run_id string, body string").select(
        "source", "run_id", records.parse(F.col("body")).alias("record")
    )


GOOD = {
    "ioc": "Evil.example.com.",
    "ioc_type": "domain",
    "malware": "win.remcos",
    "malware_printable": "Remcos",
    "malware_alias": "RemcosRAT,Remvio",
    "confidence_level": 75,
    "first_seen": "2024-01-01 00:00:00 UTC",
    "last_seen": None,
    "threat_type": "botnet_cc",
    "reference": "",
    "tags": ["a", "b"],
}


def verdicts(spark, *changes):
    rows = n.normalize_ioc_feed(batch(spark, [{**GOOD, **c, "n": str(i)} for i, c in enumerate(changes)]))
    got = rows.select(F.expr("variant_get(raw, '$.n', 'int')").alias("n"), "verdict", "reason").collect()
    return [(r["verdict"], r["reason"]) for r in sorted(got)]


def test_a_good_record(spark):
    row = n.normalize_ioc_feed(batch(spark, [GOOD])).first()
    assert (row["verdict"], row["type"], row["value"]) == ("valid", m.DOMAIN, "evil.example.com")
    assert (row["confidence"], row["family_id"], row["family_label"]) == (75, "win.remcos", "Remcos")
    assert row["source_reference"] == m.IOC_REFERENCE and row["tags"] == ["a", "b"]


def test_what_counts_as_not_given(spark):
    """Zero of any number type and empty values are as good as missing; a list of a null is not."""
    empty = [None, "", 0, 0.0, -0.0, False, [], {}]
    told = [[None], [0], {"a": None}, 1, 0.5, True]
    for name, fault in (("first_seen", "first_seen_illegible"), ("last_seen", "last_seen_illegible"), ("reference", "reference_not_text")):
        assert verdicts(spark, *({name: value} for value in empty)) == [("valid", None)] * len(empty)
        assert verdicts(spark, *({name: value} for value in told)) == [("invalid", fault)] * len(told)


def test_zero_with_an_exponent_is_not_given(spark):
    body = json.dumps({**GOOD, "first_seen": "@"}).replace('"@"', "0e0")
    rows = spark.createDataFrame([("threatfox", "r1", body)], "source string, run_id string, body string")
    found = n.normalize_ioc_feed(rows.select("source", "run_id", records.parse(F.col("body")).alias("record"))).first()
    assert (found["verdict"], found["first_seen"]) == ("valid", None)


def test_text_behind_a_document_makes_it_no_json(spark):
    rows = spark.createDataFrame([("1 2",), ("{} x",), ("{},{}",), ("",), ("[1]",), (" {} ",), (None,)], "body string")
    assert [r[0] for r in rows.select(records.parse(F.col("body")).isNotNull()).collect()] == [False, False, False, False, True, True, False]


def test_verdict_of_each_defect(spark):
    assert verdicts(
        spark,
        {},
        {"confidence_level": 150},
        {"ioc_type": "sha3_384_hash"},
        {"ioc_type": "sha3_384_hash", "confidence_level": 150},
        {"ioc_type": "ip:port", "ioc": "[xx::1]:80"},
        {"first_seen": "01/02/2024"},
        {"tags": "loose"},
        {"ioc": None},
        {"ioc": 5},
        {"confidence_level": "50"},
        {"confidence_level": 50.9},
        {"confidence_level": "50.9"},
        {"confidence_level": None},
        {"malware": 7, "malware_printable": None},
    ) == [
        ("valid", None),
        ("invalid", "confidence_out_of_range"),
        ("unsupported", "unsupported_type"),
        ("unsupported", "unsupported_type"),
        ("invalid", "ipv6_malformed"),
        ("invalid", "first_seen_illegible"),
        ("invalid", "tags_not_a_list"),
        ("invalid", "ioc_not_text"),
        ("invalid", "ioc_not_text"),
        ("valid", None),
        ("valid", None),
        ("invalid", "confidence_out_of_range"),
        ("valid", None),
        ("invalid", "family_not_text"),
    ]


def test_records_that_are_no_objects_or_lack_keys(spark):
    items = ["text", [1], 5, None, {k: v for k, v in GOOD.items() if k != "ioc"}]
    rows = n.normalize_ioc_feed(batch(spark, items)).collect()
    assert [r["verdict"] for r in rows] == ["invalid"] * 5
    assert sorted(r["reason"] for r in rows) == ["ioc_missing"] + ["not_an_object"] * 4


def test_default_confidence_and_truncation(spark):
    rows = n.normalize_ioc_feed(
        batch(spark, [{**GOOD, "confidence_level": c} for c in (None, 50.9, "7")])
    ).collect()
    assert [r["confidence"] for r in rows] == [40, 50, 7]


def test_vulnerability_feed(spark):
    entry = {"cveID": "CVE-2024-1", "vendorProject": "V", "product": "P", "dateAdded": "2024-01-05",
             "dueDate": "2024-01-26", "knownRansomwareCampaignUse": "KNOWN"}
    items = [entry, {**entry, "cveID": None}, {**entry, "dateAdded": "soon"}, {**entry, "dateAdded": None},
             {k: v for k, v in entry.items() if k != "cveID"}]
    rows = n.normalize_vuln_feed(batch(spark, items, "cisa-kev")).collect()
    assert [(r["verdict"], r["reason"]) for r in rows] == [
        ("valid", None),
        ("invalid", "cveID_not_text"),
        ("invalid", "dateAdded_illegible"),
        ("valid", None),
        ("invalid", "cveID_missing"),
    ]
    assert rows[0]["tags"] == ["ransomware"] and rows[0]["confidence"] == 90
    assert rows[0]["kev"]["dueDate"] == "2024-01-26" and rows[3]["first_seen"] is None


def test_batch_status(spark):
    cases = {"ok": "vv", "part": "vi", "fail": "ii", "empty_unsupported": "u", "mixed": "vu"}
    kind = {"v": "valid", "i": "invalid", "u": "unsupported"}
    rows = [("s", run, kind[c]) for run, codes in cases.items() for c in codes]
    counts = q.batch_counts(spark.createDataFrame(rows, "source string, run_id string, verdict string"))
    got = {r["run_id"]: r["status"] for r in q.batch_status(counts).collect()}
    assert got == {"ok": m.OK, "part": m.PARTIAL, "fail": m.FAILED, "empty_unsupported": m.OK, "mixed": m.OK}
    short = spark.createDataFrame([("s", "ok", "f", 0.1, 0.8)], "source string, run_id string, field string, coverage double, threshold double")
    demoted = {r["run_id"]: r["status"] for r in q.batch_status(counts, short).collect()}
    assert demoted["ok"] == m.PARTIAL and demoted["mixed"] == m.OK


def test_unsupported_share_is_strict(spark):
    df = spark.createDataFrame([("s", "a", 100, 5), ("s", "b", 100, 6), ("s", "c", 0, 0)],
                               "source string, run_id string, total long, unsupported long")
    assert [r["excess"] for r in q.unsupported_ratio(df).collect()] == [False, True, False]


def test_coverage_floor_and_evaluation(spark):
    def share(n_with):
        return [{**GOOD, "reference": "x" if i < n_with else ""} for i in range(100)]

    rows = {r["field"]: r for r in q.field_coverage(batch(spark, share(9)), m.IOC_FEED).collect()}
    assert rows["reference"]["short"] and rows["reference"]["coverage"] == 0.09
    assert not rows["ioc"]["short"]
    assert rows["last_seen"]["short"] and rows["last_seen"]["coverage"] == 0.0
    at_floor = {r["field"]: r for r in q.field_coverage(batch(spark, share(10)), m.IOC_FEED).collect()}
    assert not at_floor["reference"]["short"]
    # An empty list counts as given.
    listed = q.field_coverage(batch(spark, [{**GOOD, "tags": []}]), m.IOC_FEED).where("field = 'tags'").first()
    assert listed["coverage"] == 1.0
    # Evaluated from half of the batch on; below it the share is NULL, not zero.
    half = q.field_coverage(batch(spark, [GOOD] * 5 + ["x"] * 5), m.IOC_FEED).first()
    fewer = q.field_coverage(batch(spark, [GOOD] * 49 + ["x"] * 51), m.IOC_FEED).first()
    assert half["evaluated"] and not fewer["evaluated"] and fewer["coverage"] is None


def test_no_number_ends_the_job_and_the_record_stays(spark):
    levels = [3000000000, -3000000000, 1e99, "NaN", "1e99", "9" * 30, True, -0.5, 100.9, 101, [], {}]
    rows = n.normalize_ioc_feed(batch(spark, [{**GOOD, "confidence_level": x, "n": i} for i, x in enumerate(levels)]))
    got = sorted(rows.select(F.expr("variant_get(raw, '$.n', 'int')").alias("n"), "verdict", "reason", "confidence").collect())
    bad = ("invalid", "confidence_out_of_range", None)
    assert [tuple(r[1:]) for r in got] == [bad] * 6 + [("valid", None, 1), ("valid", None, 0), ("valid", None, 100)] + [bad] * 3
    vuln = n.normalize_vuln_feed(batch(spark, [{"cveID": "CVE-1", "note": "kept"}], "cisa-kev")).select(*n.OBSERVATION_COLUMNS)
    assert vuln.select(F.expr("variant_get(raw, '$.note', 'string')")).first()[0] == "kept"


def test_times_that_are_given(spark):
    given = ["0", "false", 5, 0.5, True, [1], {"a": 1}, "x"]
    not_given = [None, "", 0, 0.0, False, [], {}]
    for values, n_given in ((given, len(given)), (not_given, 0)):
        rows = q.broken_time_formats(batch(spark, [{**GOOD, "last_seen": v} for v in values]), {"last_seen": "datetime"}).collect()
        assert sum(r["n_given"] for r in rows) == n_given and all(r["broken"] for r in rows)


def test_missing_fields_and_broken_times(spark):
    gone = [{k: v for k, v in GOOD.items() if k not in ("malware",)} | {"reference": None}]
    assert [r["field"] for r in q.missing_fields(batch(spark, gone), m.IOC_FEED.expected_fields).collect()] == ["malware"]
    mixed = batch(spark, [{**GOOD, "last_seen": "x"}, {**GOOD, "first_seen": "bad", "last_seen": "y"}])
    got = {r["field"]: r["broken"] for r in q.broken_time_formats(mixed, m.IOC_FEED.time_fields).collect()}
    assert got == {"first_seen": False, "last_seen": True}
    silent = q.broken_time_formats(batch(spark, [{**GOOD, "first_seen": None}]), m.IOC_FEED.time_fields)
    assert silent.collect() == []


def test_documents(spark, tmp_path):
    bodies = {
        "a.json": {"vulnerabilities": [{"cveID": "CVE-1"}, {"cveID": "CVE-2"}]},
        "b.json": {"vulnerabilites": []},
        "c.json": {"vulnerabilities": {"x": 1}},
        "d.json": {"vulnerabilities": []},
        "e.json": [1],
    }
    for name, body in bodies.items():
        # Spread over lines, as a feed sends it.
        (tmp_path / name).write_text(json.dumps(body, indent=1))
    (tmp_path / "f.json").write_text("<html>")
    docs = documents.read_documents(spark, str(tmp_path))
    envelopes, found = documents.scan_documents(docs, m.VULN_FEED)
    verdict = {r["doc_id"][-6:]: (r["fault"], r["n_records"], r["verdict"]) for r in q.envelope_verdict(envelopes).collect()}
    assert verdict == {
        "a.json": (None, 2, "ok"),
        "b.json": ("list_missing", 0, "broken"),
        "c.json": ("list_not_a_list", 0, "broken"),
        "d.json": (None, 0, "not_verified"),
        "e.json": ("list_missing", 0, "broken"),
        "f.json": ("not_json", 0, "not_verified"),
    }
    assert found.count() == 2


def test_window_documents(spark):
    bodies = [{"query_status": "ok", "data": [{}, {}]}, {"query_status": "no_result", "data": [{}]},
              {"query_status": "Throttled"}, {"query_status": "bad_key"}, {"data": []}, {"query_status": "ok"}]
    rows = [(str(i), json.dumps(b)) for i, b in enumerate(bodies)]
    opened = documents.open_envelopes(spark.createDataFrame(rows, "doc_id string, body string"), m.IOC_FEED)
    assert [(r["fault"], r["n_records"]) for r in opened.orderBy("doc_id").collect()] == [
        (None, 2), (None, 0), ("rate_limited", 0), ("not_ok", 0), ("not_ok", 0), ("list_missing", 0)]


def test_record_lines(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text(json.dumps(GOOD) + "\n{broken\n")
    rows = n.normalize_ioc_feed(documents.read_record_lines(spark, str(path), "threatfox", "r")).collect()
    assert sorted(r["verdict"] for r in rows) == ["invalid", "valid"]


def test_checks_are_compiled_and_the_record_is_walked_once(spark):
    rows = n.normalize_ioc_feed(batch(spark, [GOOD]))
    optimized = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in optimized  # a filter over the checks would be interpreted
    assert "$.confidence_level" not in optimized and "$.malware_alias" not in optimized
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_texts_and_kinds_of_odd_fields(spark):
    bodies = ['{"ioc":null,"malware":1.50,"malware_printable":"a\\"b","reference":[1,{"x":null}],"tags":["t",null]}', '[1]', '"x"', '{}']
    rows = spark.createDataFrame([("s", str(i), b) for i, b in enumerate(bodies)], "source string, run_id string, body string")
    opened = n.open_fields(rows.select("source", "run_id", records.parse(F.col("body")).alias("record")), n.IOC_READS)
    got = opened.orderBy("run_id").select("is_object", "f_ioc", "k_ioc", "f_malware", "f_malware_printable", "k_malware_printable", "f_reference", "f_tags").collect()
    assert tuple(got[0]) == (True, None, "VOID", "1.5", 'a"b', "STRING", '[1,{"x":null}]', ["t", None])
    assert [tuple(r) for r in got[1:]] == [(False, *[None] * 7), (False, *[None] * 7), (True, *[None] * 7)]


def test_suffix_of_a_time(spark):
    texts = ["2024-01-02 03:04:05 UTC", " 2024-1-2 3:4:5  UTC ", "2024-01-02 03:04:05UTC", "UTC", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(values.parse_datetime(F.col("t")).isNotNull())
    assert [r[0] for r in rows.collect()] == [True, True, False, False, False, False]


def test_refang_by_scheme(spark):
    texts = ["hxxp://a", "hXxps[://]a", "HXXP://a", "hXXphxxp", "plain[.]a"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(values.refang(F.col("t")))
    assert [r[0] for r in rows.collect()] == ["http://a", "https://a", "HXXP://a", "httphttp", "plain.a"]


def test_a_record_is_parsed_once_and_no_missing_path_is_asked_for(spark):
    rows = spark.createDataFrame([('{"ioc": 1}',)], "body string").select(records.parse(F.col("body")).alias("record"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "$[1]" not in plan and rows.select(F.col("record").cast("string")).first()[0] == '{"ioc":1}'


def test_broken_times_take_each_field_out_of_the_record_once(spark):
    counted = q.broken_time_formats(batch(spark, [GOOD, {**GOOD, "first_seen": ["x"]}, ["no object"]]), m.IOC_FEED.time_fields)
    assert "$.first_seen" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["field"], r["n_given"], r["n_legible"]) for r in counted.collect()} == {("first_seen", 2, 1)}
