import hashlib
import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from feedmark import model as m
from feedmark.functions import names, values


def column(spark, rows, expr, schema="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.select(expr).collect()]


@pytest.mark.parametrize(
    "kind, raw, stored",
    [
        (m.DOMAIN, " Evil[.]Example(.)COM.. ", "evil.example.com"),
        (m.URL, "hxxps[://]EVIL{.}example/Path", "https://evil.example/path"),
        (m.URL, "hXxp[:]//a.b", "http://a.b"),
        # The scheme rule wants a lower-case h, and runs before lower-casing.
        (m.URL, "HXXP://a.b", "hxxp://a.b"),
        (m.MD5, "D41D8CD98F00B204E9800998ECF8427E", m.TRIVIAL_DIGESTS[0]),
        (m.VULNERABILITY, " CVE-2024-1 ", "CVE-2024-1"),
        (m.IPV4, "10[.]0[.]0[.]1", "10.0.0.1"),
    ],
)
def test_normalize_value(spark, kind, raw, stored):
    expr = values.normalize_value(F.col("k"), F.col("x"))
    assert column(spark, [(kind, raw)], expr, "k string, x string") == [stored]


def test_identity_has_no_separators(spark):
    row = spark.range(1).select(
        values.canonical_key(F.lit(m.DOMAIN), F.lit("a.b")),
        values.record_id(F.lit(m.DOMAIN), F.lit("a.b"), F.lit("threatfox")),
    ).first()
    assert row[0] == hashlib.sha256(b"domain-namea.b").hexdigest()
    assert row[1] == hashlib.sha256(b"domain-namea.bthreatfox").hexdigest()


def test_defang(spark):
    rows = [(m.URL, "HTTPS://a.b/c"), (m.IPV6, "2001:db8::1"), (m.IPV4, "1.2.3.4"), (m.MD5, "a.b")]
    got = column(spark, rows, values.defang(F.col("k"), F.col("x")), "k string, x string")
    assert got == ["hxxpS://a[.]b/c", "2001:db8::1", "1[.]2[.]3[.]4", "a.b"]


def test_declared_window(spark):
    rows = ["P5D/2024-01-01T00:00:00", None, "", "five days", "PT5H/x"]
    assert column(spark, rows, values.declared_window_seconds(F.col("x"))) == [432000, None, None, 0, 0]


def test_declared_window_too_long_to_hold(spark):
    expr = values.declared_window_seconds(F.col("x"))
    assert column(spark, ["P99999999999999999999D/now", "P9223372036854775807D/x"], expr) == [values.LONGEST] * 2


def test_times(spark):
    rows = ["2024-01-02 03:04:05 UTC", "2024-1-2 3:4:5", "2024/01/02 03:04:05", "2024-13-01 00:00:00", None]
    got = column(spark, rows, F.date_format(values.parse_datetime(F.col("x")), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2024-01-02 03:04:05", "2024-01-02 03:04:05", None, None, None]
    assert column(spark, ["2024-01-02", "n/a", "2024-02-30"], values.parse_date(F.col("x")).cast("string")) == [
        "2024-01-02",
        None,
        None,
    ]


def test_confidence_band(spark):
    got = column(spark, [85, 84, 60, 59, 30, 29, 0], values.confidence_band(F.col("x")), "x int")
    assert got == ["alta", "media", "media", "baja", "baja", "no_valorada", "no_valorada"]


def test_ip_port(spark):
    rows = ["1.2.3.4:80", "1.2.3.4", "[2001:DB8::1]:443", "2001:db8::0:1", "[zz]:1", "[::1", ":80"]
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    got = [tuple(r) for r in values.with_ip_port(df, "x", "k", "h").select("k", "h").collect()]
    assert got == [
        (m.IPV4, "1.2.3.4"),
        (m.IPV4, "1.2.3.4"),
        (m.IPV6, "2001:db8::1"),
        (m.IPV6, "2001:db8::1"),
        (m.IPV6, None),
        (m.IPV6, "::1"),
        (m.IPV4, ":80"),
    ]


def test_ipv6_text_against_the_standard_library(spark):
    rng = random.Random(7)
    hosts = {"::", "::1", "1::", ":", "", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "fe80::1%eth0", "::1%", "1::2::3"}
    for _ in range(1500):
        groups = [rng.choice(["0", "0", "00", "1", "ab", "FFFE", "0db8", "12345", "g"]) for _ in range(rng.randint(1, 9))]
        text = ":".join(groups)
        if rng.random() < 0.6:
            cut = rng.randint(0, len(groups))
            text = ":".join(groups[:cut]) + "::" + ":".join(groups[cut:])
        if rng.random() < 0.1:
            text += rng.choice([":", "::", ":1.2.3.4", ":1.2.3.256"])
        hosts.add(text)

    def expected(host):
        try:
            return str(ipaddress.IPv6Address(host))
        except ValueError:
            return None

    df = values.with_ipv6_text(spark.createDataFrame([(h,) for h in hosts], "h string"), "h", "t")
    wrong = {
        r["h"]: (r["t"], expected(r["h"]))
        for r in df.collect()
        if r["t"] != expected(r["h"]) and "." not in (expected(r["h"]) or "")
    }
    assert wrong == {}


def test_canon(spark):
    rows = ["Agent Tesla", "agent_tesla", "AgentTesla", "Ágent-Téslà", "", None, "Ⅷ①", "日本"]
    assert column(spark, rows, names.canon(F.col("x"))) == ["agenttesla"] * 4 + ["", "", "viii1", ""]


def test_aliases_and_family(spark):
    assert column(spark, ["A, b ,,c", "", None], names.split_aliases(F.col("x"))) == [["A", "b", "c"], [], []]
    rows = [" win.remcos ", "Unknown", "N/A", "", None, "Unknown malware", "none"]
    assert column(spark, rows, names.family_id(F.col("x"))) == ["win.remcos"] + [None] * 6
    assert column(spark, ["win.remcos", "remcos", "win.", "a.b.c"], names.malpedia_name(F.col("x"))) == [
        "remcos",
        "remcos",
        "win.",
        "b.c",
    ]
