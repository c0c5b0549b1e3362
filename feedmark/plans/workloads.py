"""The supplied tables seen as feeds, catalogue, rules, runs and state.

The supplied tables carry no threat data, so every job runs on an analogue of the same shape:

* indicator feed     <- ``lineitem``: one record per line, one run per ship year
* vulnerability feed <- ``orders``: one entry per order, one run per order year
* catalogue          <- ``part`` (software), ``supplier`` (patterns), ``lineitem`` (relations)
* rules              <- ``part``
* snapshots, state   <- ``events``: three ten-day windows, the last one is "today"

Feed tables and the observations normalised from them are written once per application to the
shared folder, as a deployment keeps them; jobs further down the line scan those tables.

Every row of a table takes part; the remainders below only decide which shape a row takes, so
that every branch of a job is met at every scale.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedmark import model as m
from feedmark.functions import records, values
from feedmark.operators import difference as d
from feedmark.operators import normalize as n
from feedmark.session import new_folder, released_shuffles, scratch, stage

AS_OF = "1998-06-15"
RUN_START = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LANDED_RECORDS = 50_000  # in a file

_LANDED: dict[tuple[str, str, str], str] = {}


def landed(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """A derived table, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = new_folder(spark, name)
        # A feed lands in many files; the supplied tables are one file of one row group each.
        rows = build(spark, sf_dir)
        with released_shuffles(spark):
            rows.write.option("maxRecordsPerFile", LANDED_RECORDS).parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def today() -> Column:
    return F.lit(AS_OF).cast("date")


def run_start() -> Column:
    return F.lit(RUN_START).cast("timestamp")


def _text(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _day(column: str, pattern: str = "yyyy-MM-dd", shift: int = 0) -> Column:
    moment = F.date_add(F.col(column).cast("date"), shift)
    return F.date_format(moment, pattern)


# --- indicator feed ------------------------------------------------------------------------


def ioc_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed records as string columns named like the fields of the feed."""
    o, k, s, line = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    shape = F.col("l_quantity").cast("int") % 10
    tax = F.round(F.col("l_tax") * 100).cast("int")
    discount = F.round(F.col("l_discount") * 100).cast("int")
    year = F.year("l_shipdate")
    seed = _text(o, "-", line)
    dot = F.when(line % 3 == 0, F.lit("[.]")).when(line % 3 == 1, F.lit("(.)")).otherwise(F.lit("."))
    label = (
        F.when(shape.isin(0, 9), F.lit("domain"))
        .when(shape == 1, F.lit("url"))
        .when(shape == 2, F.lit("md5_hash"))
        .when(shape == 3, F.lit("sha1_hash"))
        .when(shape == 4, F.lit("sha256_hash"))
        .when(shape == 8, F.lit("sha3_384_hash"))
        .otherwise(F.lit("ip:port"))
    )
    ioc = (
        F.when(shape == 0, _text(" Host", o, "[.]Example(.)COM. "))
        .when(shape == 1, _text("hxxps[://]CDN", o % 1000, ".example{.}org/P/", k))
        .when((shape == 2) & (o % 97 == 0), F.lit(m.TRIVIAL_DIGESTS[0].upper()))
        .when(shape == 2, F.upper(F.md5(seed)))
        .when(shape == 3, F.sha1(seed))
        .when(shape == 4, F.upper(F.sha2(seed, 256)))
        .when(shape == 5, _text("10.", o % 256, ".", k % 256, ".", line, ":", s + 1000))
        .when(shape == 6, _text("[2001:DB8:0:0:0:0:", F.hex(k % 65535 + 1), ":000", line, "]:8080"))
        .when((shape == 7) & (o % 5 == 0), _text("zz:", o, ":1"))
        .when(shape == 7, _text("2001:db8::", F.hex(o % 65535 + 1)))
        .when(shape == 8, _text("sha3-", o))
        .otherwise(_text("Bot", s, dot, "net"))
    )
    unwritten = k % 97 == 0  # names without a Latin letter or digit
    family = (
        F.when(tax == 8, F.lit("Unknown"))
        .when(tax == 7, F.lit(None))
        .when(unwritten, F.lit("win.漢字"))
        .when(k % 17 == 0, _text("win.zz", k))
        .when((k % 10 == 0) & (F.col("l_linestatus") == "F"), _text("elf.part_kit_", k))
        .otherwise(_text("win.part_kit_", k))
    )
    printable = (
        F.when(unwritten, F.lit("漢字"))
        .when(line == 1, _text("PART-KIT ", k))
        .when((line == 2) & (k % 19 == 0), _text("Pärt Kit ", k))
        .otherwise(_text("Part Kit ", k))
    )
    alias = (
        F.when(unwritten, F.lit(None))
        .when(k % 11 == 0, _text("Alt ", k + 1, ", kit ", k))
        .when(k % 13 == 0, _text("Kit-Group ", k % 100))
        .when(line == 3, _text("A", k, ",,B ", k))
    )
    level = (
        F.when(discount == 10, F.lit(None))
        .when((line == 7) & (tax == 0), F.lit("150"))
        .otherwise((discount * 11).cast("string"))
    )
    first_seen = F.when(o % 101 == 0, _day("l_shipdate", "yyyy/MM/dd")).otherwise(
        _text(_day("l_shipdate"), " 0", line, ":00:00 UTC")
    )
    last_seen = F.when(
        F.col("l_returnflag") == "R",
        F.when(year == 1997, _day("l_shipdate", "dd.MM.yyyy", 1)).otherwise(
            _text(_day("l_shipdate", shift=1), " 12:00:00 UTC")
        ),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.lit(m.IOC_FEED.name).alias("source"),
        year.cast("string").alias("run_id"),
        ioc.alias("ioc"),
        label.alias("ioc_type"),
        level.alias("confidence_level"),
        first_seen.alias("first_seen"),
        last_seen.alias("last_seen"),
        family.alias("malware"),
        printable.alias("malware_printable"),
        alias.alias("malware_alias"),
        F.when(F.col("l_returnflag") == "A", F.lit("botnet_cc")).otherwise(F.lit("payload")).alias("threat_type"),
        F.when(o % 25 == 0, _text("https://ref.example/", o)).otherwise(F.lit("")).alias("reference"),
        F.when(F.col("l_returnflag") != "N", F.array(_text("t", s))).alias("tags"),
        o.alias("_order"),
        line.alias("_line"),
    )


_IOC_JSON = (
    "ioc",
    "ioc_type",
    "confidence_level",
    "first_seen",
    "last_seen",
    "malware",
    "malware_printable",
    "malware_alias",
    "threat_type",
    "reference",
    "tags",
)
_KEEP_NULLS = {"ignoreNullFields": "false"}


def ioc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw batch: the same records as JSON, with the faults only raw records can have."""
    rows = ioc_fields(spark, sf_dir).withColumn("confidence_level", F.col("confidence_level").cast("int"))
    o, line = F.col("_order"), F.col("_line")

    def as_json(*names: str, **replaced: Column) -> Column:
        cols = [replaced.get(name, F.col(name)).alias(name) for name in names]
        return F.to_json(F.struct(*cols), _KEEP_NULLS)

    without = lambda field: [name for name in _IOC_JSON if name != field]
    body = (
        F.when((F.col("run_id") == "2001") & (line <= 5), F.lit("[1]"))
        .when(o % 211 == 0, F.lit('"broken"'))
        .when(o % 223 == 0, as_json(*without("ioc")))
        .when(o % 227 == 0, as_json(*_IOC_JSON, tags=F.lit("loose")))
        .when(F.col("run_id") == "1999", as_json(*without("malware_alias")))
        .otherwise(as_json(*_IOC_JSON))
    )
    # Confidences that no whole number, or no number, can hold.
    odd = F.when(o % 229 == 0, F.lit("3000000000")).when(o % 233 == 0, F.lit("1e99")).when(o % 239 == 0, F.lit('"NaN"'))
    told = F.concat(F.lit('"confidence_level":'), odd)
    body = F.when(odd.isNull(), body).otherwise(F.regexp_replace(body, r'"confidence_level":[^,}]*', told))
    return rows.select("source", "run_id", body.alias("body"))


def ioc_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(landed(spark, sf_dir, "ioc-lines", ioc_lines))


def _parsed(lines: DataFrame) -> DataFrame:
    return lines.select("source", "run_id", records.parse(F.col("body")).alias("record"))


# --- vulnerability feed --------------------------------------------------------------------


def vuln_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    year = F.year("o_orderdate")
    vendor = F.when(F.col("o_orderpriority") == "2-HIGH", _text("VENDOR-", c % 40)).otherwise(
        _text("Vendor ", c % 40)
    )
    due = (
        F.when(o % 89 == 0, F.lit("n/a"))
        .when(o % 83 == 0, F.lit(None))
        .otherwise(_day("o_orderdate", shift=21))
    )
    return table(spark, sf_dir, "orders").select(
        F.lit(m.VULN_FEED.name).alias("source"),
        year.cast("string").alias("run_id"),
        F.when(o % 71 != 0, _text("CVE-", year, "-", o)).alias("cveID"),
        vendor.alias("vendorProject"),
        _text("Suite ", o % 12).alias("product"),
        F.when(F.col("o_orderstatus") != "P", _text("Flaw ", c)).alias("vulnerabilityName"),
        F.when(o % 103 == 0, F.lit("soon")).otherwise(_day("o_orderdate")).alias("dateAdded"),
        due.alias("dueDate"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Known"))
        .otherwise(F.lit("Unknown"))
        .alias("knownRansomwareCampaignUse"),
        F.col("o_orderdate").cast("date").alias("_added"),
        o.alias("_order"),
    )


_VULN_JSON = m.VULN_FEED.expected_fields


def _vuln_json() -> Column:
    return F.struct(*_VULN_JSON)


def vuln_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("_order") % 71 == 0, F.to_json(F.struct(*_VULN_JSON[1:]), _KEEP_NULLS)).otherwise(
        F.to_json(_vuln_json(), _KEEP_NULLS)
    )
    return vuln_fields(spark, sf_dir).select("source", "run_id", body.alias("body"))


def vuln_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(landed(spark, sf_dir, "vuln-lines", vuln_lines))


def vuln_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One paged document per order, some with a damaged envelope."""
    o = F.col("_order")
    twin = F.struct(*(F.concat("cveID", F.lit("-b")).alias("cveID") if c == "cveID" else F.col(c) for c in _VULN_JSON))
    listed = F.array(_vuln_json(), twin)

    def envelope(key: str, content: Column) -> Column:
        return F.to_json(F.struct(F.lit("catalogue").alias("title"), content.alias(key)), _KEEP_NULLS)

    body = (
        F.when(o % 41 == 0, F.lit("{not json"))
        .when(o % 31 == 0, envelope("vulnerabilites", listed))
        .when(o % 37 == 0, envelope("vulnerabilities", F.lit("none")))
        .when(o % 43 == 0, envelope("vulnerabilities", F.array().cast("array<string>")))
        .otherwise(envelope("vulnerabilities", listed))
    )
    return vuln_fields(spark, sf_dir).select(
        "source", "run_id", o.cast("string").alias("doc_id"), body.alias("body"), F.lit(200).alias("http_code")
    )


def chain_records(spark: SparkSession, sf_dir: str, run: str, with_period: bool) -> DataFrame:
    """All entries as a feed without a damaged record; ``with_period`` adds those of the two weeks up to the as-of date."""
    rows = vuln_fields(spark, sf_dir)
    rows = rows.withColumns(
        {
            "cveID": F.coalesce("cveID", _text("CVE-", F.col("run_id"), "-", F.col("_order"))),
            "dateAdded": F.date_format("_added", "yyyy-MM-dd"),
            "vulnerabilityName": F.coalesce("vulnerabilityName", F.lit("Flaw")),
        }
    )
    if not with_period:
        rows = rows.where(~in_period(F.col("_added")))
    return _parsed(rows.select("source", F.lit(run).alias("run_id"), F.to_json(_vuln_json(), _KEEP_NULLS).alias("body")))


def in_period(added: Column) -> Column:
    """Added in the two weeks up to the as-of date, between the two runs of the chain."""
    return added.between(F.date_sub(today(), 13), today())


def snapshot_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of whole catalogue documents, one JSON file for each run: all its entries in one list.

    That of 1992 has a comma too many, that of 1993 misspells its list, those of other runs are sound.
    """
    key = (spark.sparkContext.applicationId, sf_dir, "snapshot-files")
    if key in _LANDED:
        return _LANDED[key]
    run = F.col("run_id")
    nth = F.row_number().over(Window.partitionBy("source", "run_id").orderBy("_order"))
    entries = vuln_fields(spark, sf_dir).select(
        "source", "run_id", nth.alias("n"), F.concat(F.when(nth > 1, F.lit(",")).otherwise(""), F.to_json(_vuln_json(), _KEEP_NULLS)).alias("line")
    )
    runs = entries.groupBy("source", "run_id").agg(F.count("*").alias("rows"))
    name = F.when(run == "1993", F.lit("vulnerabilites")).otherwise(F.lit("vulnerabilities"))
    head = F.concat(F.lit('{"title": "}{ of \\"'), run, F.lit('\\"", "count": '), F.col("rows"), F.lit(', "'), name, F.lit('": ['))
    foot = F.concat(F.when(run == "1992", F.lit(",")).otherwise(""), F.lit('], "notes": [{"a": "]"}]}'))
    ends = runs.select("source", "run_id", F.inline(F.array(F.struct(F.lit(0).alias("n"), head.alias("line")), F.struct((F.col("rows") + 1).cast("int").alias("n"), foot.alias("line")))))
    path = new_folder(spark, "snapshot-files")
    rows = entries.unionByName(ends).repartition("run_id").sortWithinPartitions("source", "run_id", "n").drop("n")
    rows.write.partitionBy("source", "run_id").text(path)
    _LANDED[key] = path
    return path


def window_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One answer document of a window feed per event, one run per day."""
    k = F.get_json_object("props", "$.k").cast("int")
    record = F.struct(F.col("user_id").alias("ioc"), F.col("event_type").alias("ioc_type"))

    def envelope(status: str, **more: Column) -> Column:
        cols = [F.lit(status).alias("query_status"), *(c.alias(name) for name, c in more.items())]
        return F.to_json(F.struct(*cols))

    body = (
        F.when(k == 0, envelope("no_result"))
        .when(k == 1, envelope("Rate_Limited"))
        .when(k == 2, envelope("illegal_auth"))
        .when(k == 3, envelope("ok"))
        .when(k == 4, envelope("ok", data=F.lit("none")))
        .when(k == 5, F.lit("<html>"))
        .when(k == 6, envelope("ok", data=F.array().cast("array<string>")))
        .otherwise(envelope("ok", data=F.array(record, record)))
    )
    return table(spark, sf_dir, "events").select(
        F.lit(m.IOC_FEED.name).alias("source"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.col("event_id").cast("string").alias("doc_id"),
        body.alias("body"),
        F.lit(200).alias("http_code"),
    )


# --- observations --------------------------------------------------------------------------


FAMILY_COLUMNS = ("family_id", "malware_printable", "malware_alias")


def _normalized_ioc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return n.normalize_ioc_feed(ioc_batch(spark, sf_dir))


def _normalized_vuln(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries joined on the day they state; an entry without a legible day is invalid."""
    rows = n.normalize_vuln_feed(vuln_batch(spark, sf_dir))
    return rows.withColumn("_added", F.col("first_seen").cast("date"))


def normalized_ioc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator records with their verdicts."""
    return landed(spark, sf_dir, "ioc-normalized", _normalized_ioc)


def normalized_vuln(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vulnerability entries with their verdicts; ``_added`` is the day they joined."""
    return landed(spark, sf_dir, "vuln-normalized", _normalized_vuln)


def ioc_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized_ioc(spark, sf_dir).where(F.col("verdict") == n.VALID)


def _ioc_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = stage(_normalized_ioc(spark, sf_dir), "ioc-whole")
    return whole.select("verdict", *FAMILY_COLUMNS).distinct()


def ioc_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the valid indicator observations that name families, a combination once or more often.

    Taken from the landed observations where they are; else all records are normalised whole and written, and only
    the distinct rows that name families are landed: the observations themselves go.
    """
    if (spark.sparkContext.applicationId, sf_dir, "ioc-normalized") in _LANDED:
        return ioc_observations(spark, sf_dir).select(*FAMILY_COLUMNS)
    with scratch(spark):
        rows = landed(spark, sf_dir, "ioc-families", _ioc_families)
    return rows.where(F.col("verdict") == n.VALID).select(*FAMILY_COLUMNS)


def vuln_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized_vuln(spark, sf_dir).where(F.col("verdict") == n.VALID)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid observations of both feeds."""
    columns = list(n.OBSERVATION_COLUMNS)
    return ioc_observations(spark, sf_dir).select(columns).unionByName(
        vuln_observations(spark, sf_dir).select(columns)
    )


def landings():
    """(name, function that writes it) of the feed tables and normalised observations that later jobs scan."""
    for name, build in (
        ("ioc-lines", ioc_lines),
        ("vuln-lines", vuln_lines),
        ("ioc-normalized", _normalized_ioc),
        ("vuln-normalized", _normalized_vuln),
    ):
        yield name, lambda spark, sf_dir, name=name, build=build: landed(spark, sf_dir, name, build)


def entries(observed: DataFrame) -> DataFrame:
    """Vulnerability entries with the columns the rankings read."""
    return observed.where(F.col("type") == m.VULNERABILITY).select(
        "canonical_key",
        "value",
        F.col("kev.dueDate").alias("due_date"),
        F.col("kev.knownRansomwareCampaignUse").alias("ransomware"),
    )


# --- catalogue and rules -------------------------------------------------------------------


def catalog_objects(spark: SparkSession, sf_dir: str, version: int = 2) -> DataFrame:
    """Objects of the catalogue; version 1 is the one the baseline was measured on."""
    p, size = F.col("p_partkey"), F.col("p_size")
    retired_sizes = {2: (50, 49), 1: (50, 48)}[version]
    nothing = F.lit(None).cast("string")
    no_refs = F.array().cast("array<struct<source_name:string,external_id:string>>")

    def shaped(rows: DataFrame, **columns: Column) -> DataFrame:
        defaults = {
            "id": nothing,
            "type": nothing,
            "name": nothing,
            "x_mitre_aliases": F.lit(None).cast("array<string>"),
            "revoked": F.lit(False),
            "x_mitre_deprecated": F.lit(False),
            "external_references": no_refs,
            "relationship_type": nothing,
            "source_ref": nothing,
            "target_ref": nothing,
        }
        return rows.select(*(c.alias(name) for name, c in (defaults | columns).items()))

    software = shaped(
        table(spark, sf_dir, "part"),
        id=_text("malware--", p),
        type=F.when(size % 2 == 0, F.lit("malware")).otherwise(F.lit("tool")),
        name=_text("Part Kit ", p),
        x_mitre_aliases=F.when(size % 7 != 0, F.array(_text("alt-", p), _text("kit group ", p % 100))),
        revoked=size == retired_sizes[0],
        x_mitre_deprecated=size == retired_sizes[1],
    )
    s = F.col("s_suppkey")
    technique = F.when(s % 5 == 0, _text("T", s % 9000 + 1000)).otherwise(
        _text("T", s % 9000 + 1000, ".001")
    )
    other = F.struct(F.lit("capec").alias("source_name"), _text("CAPEC-", s).alias("external_id"))
    own = F.struct(F.lit("mitre-attack").alias("source_name"), technique.alias("external_id"))
    patterns = shaped(
        table(spark, sf_dir, "supplier"),
        id=_text("attack-pattern--", s),
        type=F.lit("attack-pattern"),
        name=F.when(s % 35 == 0, F.lit("")).otherwise(F.col("s_name")),
        external_references=F.when(s % 15 == 5, F.array(other))
        .when(s % 2 == 0, F.array(other, own))
        .otherwise(F.array(own)),
        revoked=s % 40 == 0,
    )
    relations = shaped(
        table(spark, sf_dir, "lineitem"),
        id=_text("relationship--", F.col("l_orderkey"), "-", F.col("l_linenumber")),
        type=F.lit("relationship"),
        relationship_type=F.when(F.col("l_returnflag") == "A", F.lit("uses")).otherwise(F.lit("mitigates")),
        source_ref=_text("malware--", F.col("l_partkey")),
        target_ref=_text("attack-pattern--", F.col("l_suppkey")),
    )
    return software.unionByName(patterns).unionByName(relations)


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, brand = F.col("p_partkey"), F.col("p_brand")
    technique = (
        F.when(brand == "Brand#25", F.lit("T1059"))
        .when(brand == "Brand#24", F.lit(None))
        .when(F.col("p_type") == "ECONOMY", F.lit("T1190"))
        .when(F.col("p_type") == "LARGE", F.lit("T1203"))
        .when(F.col("p_type") == "PROMO", F.lit(None))
        .when(F.col("p_type") == "SMALL", F.lit("T1210"))
        .otherwise(F.lit("T1068"))
    )
    return table(spark, sf_dir, "part").select(
        p.alias("position"),
        _text("vendor_", p % 25).alias("vendor"),
        _text("SUITE ", F.col("p_size") % 8).alias("product"),
        technique.alias("technique"),
        F.when((F.col("p_type") == "PROMO") & (brand != "Brand#24"), F.lit(True)).alias("unspecific"),
        _text("curated from ", F.col("p_type")).alias("rationale"),
    )


# --- snapshots, runs and state -------------------------------------------------------------

# First day of each of the three snapshots and the end of the last.
SNAPSHOT_DAYS = ("2024-01-01", "2024-01-11", "2024-01-21", "2024-01-31")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observed rows, with ``snapshot`` 0, 1 or 2."""
    k = F.get_json_object("props", "$.k").cast("int")
    ts = F.col("ts").cast("timestamp")
    source = _text(F.col("event_type"), "-", F.col("user_id") % 3)
    # Feeds without a drop of their own in the last snapshot: their late events came in the one before.
    silent = source.startswith("view-") | (source == "click-1")
    value = _text("u", F.col("user_id"), "-k", k % 10, ".example.com")
    kind = F.lit(m.DOMAIN)
    snapshot = F.lit(0)
    for number, day in enumerate(SNAPSHOT_DAYS[1:-1], 1):
        reached = (ts >= F.lit(day).cast("timestamp")) & ~(silent & F.lit(number == 2))
        snapshot = F.when(reached, F.lit(number)).otherwise(snapshot)
    return table(spark, sf_dir, "events").select(
        source.alias("source"),
        values.canonical_key(kind, value).alias("canonical_key"),
        kind.alias("type"),
        value.alias("value"),
        F.when(k >= 10, _text("fam", F.floor(k / 10))).alias("family"),
        F.lit(None).cast(n.KEV_TYPE).alias("kev"),
        ts.alias("last_seen"),
        k.alias("confidence"),
        F.to_timestamp(F.date_trunc("day", ts)).alias("ingested_at"),
        snapshot.alias("snapshot"),
    )


def observed_today(events: DataFrame) -> DataFrame:
    """Rows of the last snapshot; the unchanged and the empty feeds have none."""
    return events.where(F.col("snapshot") == 2).drop("snapshot")


def prior_state(events: DataFrame) -> DataFrame:
    """The state after the second snapshot: its members present, the first one's others fallen."""
    earlier = events.where(F.col("snapshot") < 2)
    best = F.min(F.when(F.col("snapshot") == 1, d._preference())).alias("second")
    before = F.min(F.when(F.col("snapshot") == 0, d._preference())).alias("first")
    held = earlier.groupBy(*d.KEY).agg(best, before)
    row = F.coalesce("second", "first")
    present = F.col("second").isNotNull()
    return held.select(
        *d.KEY,
        *(row[name].alias(name) for name in d._ATTRIBUTES),
        F.when(present, F.lit(m.PRESENT)).otherwise(F.lit(m.FALLEN)).alias("status"),
        F.when(~present, F.col("first.last_seen") - F.expr("INTERVAL 5 DAYS")).alias("fallen_since"),
    ).select(*d.STATE_COLUMNS)


def event_sources(events: DataFrame) -> DataFrame:
    return events.select("source").distinct()


def runs(sources: DataFrame) -> DataFrame:
    """Today's run of every source: each rule of the publication gate is met."""
    source = F.col("source")
    status = (
        F.when(source == "error-2", F.lit(m.FAILED))
        .when(source.startswith("error-"), F.lit(m.PARTIAL))
        .otherwise(F.lit(m.OK))
    )
    window = F.when(source == "purchase-1", F.lit("cinco dias")).when(
        source != "purchase-2", F.lit("P10D/2024-01-31T00:00:00+00:00")
    )
    return sources.select(
        "source",
        status.alias("status"),
        F.when(source.startswith("view-"), F.lit(304)).otherwise(F.lit(200)).alias("http_code"),
        window.alias("declared_window"),
        run_start().alias("attempt_time"),
    )


def watermarks(sources: DataFrame) -> DataFrame:
    """Up to where the state reflects each source; some have none yet."""
    source = F.col("source")
    day = (
        F.when(source.isin("purchase-0", "purchase-2", "error-0"), F.lit("2024-01-20"))
        .when(source == "click-2", F.lit("2024-01-30"))
        .otherwise(F.lit("2024-01-21"))
    )
    return sources.where(~source.startswith("signup-")).select(
        "source", day.cast("timestamp").alias("watermark")
    )


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What decides the mode of every daily run, one row per day of events."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    number = F.dayofmonth("run_start")
    return (
        table(spark, sf_dir, "events")
        .groupBy(day.alias("run_start"))
        .agg(F.countDistinct("event_type").alias("n_sources"))
        .select(
            F.date_format("run_start", "yyyy-MM-dd").alias("run_id"),
            "run_start",
            F.when(number == 1, F.lit("absent"))
            .when(number == 2, F.lit("illegible"))
            .when(number == 3, F.lit("no_watermark"))
            .otherwise(F.lit("ok"))
            .alias("load_outcome"),
            F.when(number == 4, F.col("run_start") + F.expr("INTERVAL 1 HOUR"))
            .when(number != 9, F.col("run_start") - F.expr("INTERVAL 1 DAY"))
            .alias("latest_watermark"),
            (number % 7 == 5).alias("regenerate"),
            F.when(number % 7 == 6, F.col("run_start") - F.expr("INTERVAL 31 DAYS"))
            .when(number % 7 == 0, F.col("run_start") - F.expr("INTERVAL 30 DAYS"))
            .otherwise(F.col("run_start") - F.expr("INTERVAL 3 DAYS"))
            .alias("baseline_instant"),
            F.when(number % 8 == 0, F.lit(0)).otherwise(F.col("n_sources")).alias("n_usable_sources"),
        )
    )


def feed_runs(batch_counts: DataFrame) -> DataFrame:
    """Runs of the vulnerability feed per year with codes that close each coverage gate."""
    year = F.col("run_id")
    return batch_counts.select(
        "source",
        "run_id",
        F.when(year == "1996", F.lit(m.PARTIAL))
        .when(year == "2000", F.lit(None))
        .otherwise(F.lit(m.OK))
        .alias("status"),
        F.when(year == "1997", F.lit(304)).otherwise(F.lit(200)).alias("http_code"),
    )
