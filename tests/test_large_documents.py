"""Documents cut into byte ranges give the records and faults that parsing them whole gives."""

import json
import random

import pytest
from pyspark.sql import functions as F

from feedmark import model as m
from feedmark.sources import large_documents as ld

IDS = "source string, run_id string"


def land(folder, texts):
    for n, text in enumerate(texts):
        at = folder / "source=kev" / f"run_id=r{n:04d}"
        at.mkdir(parents=True)
        (at / "feed.json").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(folder)


@pytest.fixture
def ranges(spark):
    """Files are cut every so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

    def put(size):
        for name in names:
            spark.conf.set(name, str(size))

    yield put
    for name in names:
        spark.conf.unset(name)


def expected(text, spec):
    """(fault, records) by parsing the document whole."""
    try:
        doc = json.loads(text)
    except ValueError:
        return "not_json", []
    if spec.kind == "window":
        status = doc.get("query_status") if isinstance(doc, dict) else None
        if status == "no_result":
            return None, []
        if status != "ok":
            return "not_ok", []
    if not isinstance(doc, dict) or spec.envelope_key not in doc:
        return "list_missing", []
    listed = doc[spec.envelope_key]
    return (None, listed) if isinstance(listed, list) else ("list_not_a_list", [])


def scanned(spark, path, spec=m.VULN_FEED, *bounds):
    envelopes, batch = ld.scan_files(spark, path, spec, IDS, *bounds)
    faults = {r["run_id"]: (r["fault"], r["n_records"]) for r in envelopes.collect()}
    found = {run: [] for run in faults}
    for r in batch.select("run_id", F.to_json("record").alias("text")).collect():
        found[r["run_id"]].append(json.loads(r["text"]))
    return faults, found


def same(spark, path, texts, spec=m.VULN_FEED):
    faults, found = scanned(spark, path, spec)
    canon = lambda rows: sorted(json.dumps(r, sort_keys=True) for r in rows)
    for n, text in enumerate(texts):
        run, (fault, listed) = f"r{n:04d}", expected(text, spec)
        assert faults[run] == (fault, len(listed)), (text[:300], faults[run])
        assert canon(found[run]) == canon(listed), text[:300]


HARD = [
    "", " ", "{", "}", "{}", "[]", "[[1,2],[3]]", "null", '"}"', "{]", '{"vulnerabilities": [}',
    '{"vulnerabilities": []}', '{"vulnerabilities": [ \n ]}', '{"vulnerabilities": [1,]}', '{"vulnerabilities": [,1]}',
    '{"vulnerabilities": [1 2]}', '{"vulnerabilities": [1,,2]}', '{"vulnerabilities": [{"cveID": 1}]', '{"vulnerabilities": [{"a": 1}]}}',
    '{"vulnerabilities": [{"a": 1}]} x', '{"vulnerabilities": [{"a": 1}]}\n', '{"vulnerabilities": {"a": [1, 2]}}',
    '{"vulnerabilities": "}{][,"}', '{"a": "\\\\\\"}", "vulnerabilities": [{"b": "x\\"},{\\\\"}, "}", [[{}],{}], null, true, -1.5]}',
    '{"other": [1, {"x": 2}], "vulnerabilities": [{"a": {"b": [1, {"c": "}"}]}}], "more": {"k": [1], "l": {"m": 2}}}',
    '{"x}y": [1], "vulnerabilities" : [ {"a":1} , {"a":2} ] , "n": 2}', '{"vulnerabilit\\u0069es": [{"a": 1}]}',
    '{"vulnerabilities": [{"é}": "ü}中"}], "t": "😀"}', '{"vulnerabilities": [[], [{}], {}]}',
]


def test_hard_documents(spark, tmp_path):
    same(spark, land(tmp_path / "in", HARD), HARD)


def reassembled(text, cuts):
    """Skeleton and (key, element) of a document cut behind some of its braces, without Spark."""
    begin, out, open_parts = ld.EMPTY, [], None
    skeleton = b""
    for a, b in zip([0, *cuts], [*cuts, len(text)]):
        reader = ld._Reader(begin)
        for kind, key, part in [*reader.read(text[a:b]), *reader.end()]:
            if kind == "skeleton":
                skeleton += part
            elif kind == "element":
                out.append((key, part))
            elif kind == "head":
                open_parts = (key, part)
            else:
                assert kind in ("middle", "tail")
                open_parts = (open_parts[0], open_parts[1] + part)
                if kind == "tail":
                    out.append(open_parts)
        begin = ld.chained(begin, ld.summary(text[a:b], begin[0]))
    return skeleton, out


def test_any_cut_gives_the_same_elements():
    rng = random.Random(2)
    texts = [t.encode() for t in HARD] + [json.dumps({f"k{i}": made(rng) for i in range(4)}).encode() for _ in range(300)]
    for text in texts:
        try:
            json.loads(text)
        except ValueError:
            continue
        braces = [n + 1 for n, c in enumerate(text) if c == ord("}")]
        whole = reassembled(text, [])
        for _ in range(8):
            cuts = [n for n in braces if n < len(text) and rng.random() < rng.choice([0.1, 0.5, 1])]
            skeleton, found = reassembled(text, cuts)
            assert skeleton == whole[0] and [e for _, e in found] == [e for _, e in whole[1]]
            assert [k for k, _ in found if k and "}" not in k] == [k for k, _ in whole[1] if k and "}" not in k]


def made(rng, deep=0):
    kind = rng.randrange(7 if deep < 3 else 4)
    if kind < 3:
        return rng.choice([None, True, 1, 2.5, "", "a,b", 'q"}', "\\", "{[", "é", "x" * rng.randrange(60)])
    if kind < 5:
        return {rng.choice(["a", "b}", 'c"', "vulnerabilities", "d,"]) + str(i): made(rng, deep + 1) for i in range(rng.randrange(4))}
    return [made(rng, deep + 1) for _ in range(rng.randrange(4))]


def test_random_documents(spark, tmp_path, ranges):
    rng = random.Random(3)
    texts = []
    for n in range(12):
        listed = [made(rng) for _ in range(rng.randrange(200))]
        doc = {"title": made(rng), "vulnerabilities": listed, "meta": made(rng), "others": [made(rng) for _ in range(rng.randrange(5))]}
        text = json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        if n % 4 == 3:  # damaged: a byte lost or doubled
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", text[at] * 2]) + text[at + 1 :]
        texts.append(text)
    ranges(4000)
    same(spark, land(tmp_path / "in", texts), texts)


def test_window_feed_documents(spark, tmp_path, ranges):
    record = {"ioc": "1.2.3.4:80", "ioc_type": "ip:port", "tags": ["}", "a"]}
    texts = [json.dumps(d) for d in ({"query_status": "ok", "data": [record] * 300}, {"query_status": "no_result", "data": [record]},
                                     {"query_status": "illegal", "data": []}, {"query_status": "ok"}, {"query_status": "ok", "data": "x"})]
    ranges(4000)
    same(spark, land(tmp_path / "in", texts), texts, m.IOC_FEED)


def test_one_document_is_read_by_many_tasks(spark, tmp_path, ranges):
    """Records keep their content and number, and no task reads more than its range."""
    listed = [{"cveID": f"CVE-{n}", "text": "x" * (n % 900), "odd": '"}],['} for n in range(30_000)]
    text = json.dumps({"title": "t", "vulnerabilities": listed, "count": len(listed)})
    ranges(1 << 20)
    envelopes, batch = ld.scan_files(spark, land(tmp_path / "in", [text]), m.VULN_FEED, IDS)
    assert [(r["fault"], r["n_records"], r["run_ok"]) for r in envelopes.collect()] == [(None, 30_000, True)]
    ids = batch.select(F.expr("variant_get(record, '$.cveID', 'string')").alias("id"), F.expr("length(variant_get(record, '$.text', 'string'))").alias("n"))
    assert sorted((int(r["id"][4:]), r["n"]) for r in ids.collect()) == [(n, n % 900) for n in range(30_000)]


def test_beyond_a_bound_is_a_failed_run(spark, tmp_path, ranges):
    """Never "not JSON", and never a run without records that counts as correct."""
    ranges(3000)
    texts = [json.dumps({"vulnerabilities": [{"a": "x" * 100}, {"b": ["y" * n, {}, {}]}]}) for n in (20, 2500, 9000)]
    faults, found = scanned(spark, land(tmp_path / "in", texts), m.VULN_FEED, 2000)
    assert [faults[f"r{n:04d}"][0] for n in range(3)] == [None, "too_large", "too_large"]
    assert [len(found[f"r{n:04d}"]) for n in range(3)] == [2, 0, 0]
    texts = [json.dumps({"note": "z" * n, "vulnerabilities": [{"a": 1}]}) for n in (10, 400)]
    faults, _ = scanned(spark, land(tmp_path / "more", texts), m.VULN_FEED, 2000, 100)
    assert [faults[f"r{n:04d}"][0] for n in range(2)] == [None, "too_large"]


def test_summaries_chain_to_the_summary_of_the_whole():
    rng = random.Random(1)
    for _ in range(300):
        text = json.dumps([made(rng) for _ in range(6)]).encode()
        cuts = sorted(n + 1 for n, c in enumerate(text) if c == ord("}") and rng.random() < 0.5)
        for begin in (False, True):
            now = (begin, 0, 0, [])
            for a, b in zip([0, *cuts], [*cuts, len(text)]):
                now = ld.chained(now, ld.summary(text[a:b], now[0]))
            whole = ld.summary(text, begin)
            assert now[:3] == whole[:3] and [x[0] for x in now[3]] == [x[0] for x in whole[3]]
