"""Bulk normalisation: raw records to observations, each with a verdict.

A batch is a DataFrame ``(source, run_id, record)`` with ``record`` a VARIANT. Nothing is dropped
here: every record keeps its row, and its ``verdict`` says whether it is an observation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmark import model as m
from feedmark.functions import names, records, values

VALID, INVALID, UNSUPPORTED = "valid", "invalid", "unsupported"

KEV_FIELDS = ("vendorProject", "product", "dueDate", "knownRansomwareCampaignUse")

VULN_READS = ("cveID", "dateAdded", *KEV_FIELDS)
IOC_READS = (
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
)

KEV_TYPE = "struct<" + ",".join(f"{name}:string" for name in KEV_FIELDS) + ">"

OBSERVATION_COLUMNS = (
    "source",
    "run_id",
    "verdict",
    "reason",
    "failed_checks",
    "type",
    "raw_value",
    "value",
    "id",
    "canonical_key",
    "source_reference",
    "first_seen",
    "last_seen",
    "confidence",
    "family_label",
    "family_id",
    "malware_printable",
    "malware_alias",
    "threat_type",
    "tags",
    "kev",
    "raw",
)


def open_fields(batch: DataFrame, reads: tuple[str, ...]) -> DataFrame:
    """Take the fields a feed needs out of the record, once each, as text and kind.

    ``f_x`` is the text of field x, ``k_x`` its kind: NULL for a missing key, ``VOID`` for null.
    """
    record = F.col("record")
    # A field is a common part of its text and its kind: it never leaves the projection, as each would carry the
    # names of the whole record.
    field = records.children(record, (*reads, "tags"))
    # A record that has the first field is an object; only others need a closer look.
    has_first = field[reads[0]].isNotNull()
    # The whole record stays with its row, for audits.
    return batch.select(
        *(F.col(c).alias("raw") if c == "record" else F.col(c) for c in batch.columns),
        F.when(has_first, F.lit(True)).otherwise(records.is_object(record)).alias("is_object"),
        *(F.try_variant_get(field[name], "$", "string").alias(f"f_{name}") for name in reads),
        *(F.schema_of_variant(field[name]).alias(f"k_{name}") for name in reads),
        F.try_variant_get(field["tags"], "$", "array<string>").alias("f_tags"),
        F.schema_of_variant(field["tags"]).alias("k_tags"),
    )


def _failed(**checks: Column) -> Column:
    """Names of the checks that do not hold, in the order given."""
    # Joined and split: a filter over an array would evaluate every check in the interpreter.
    failed = F.concat_ws(
        ",", *(F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in checks.items())
    )
    return F.when(failed == "", F.array().cast("array<string>")).otherwise(F.split(failed, ","))


def _optional_string(name: str) -> Column:
    """A field that may be missing, null or a string, and nothing else."""
    kind = F.col(f"k_{name}")
    return kind.isNull() | kind.isin("VOID", "STRING")


def _falsy(name: str) -> Column:
    """Missing, null, '', zero, false or empty: such a field counts as not given."""
    return ~records.is_given(F.col(f"k_{name}"), F.col(f"f_{name}"))


def _finish(rows: DataFrame, carried: list[str]) -> DataFrame:
    """Identity, verdict and the common column order."""
    keyed = rows.withColumn("value", values.normalize_value(F.col("type"), F.col("raw_value")))
    unsupported = F.col("unsupported")
    invalid = ~unsupported & (F.size("failed_checks") > 0)
    verdict = (
        F.when(unsupported, F.lit(UNSUPPORTED))
        .when(invalid, F.lit(INVALID))
        .otherwise(F.lit(VALID))
    )
    valid = ~unsupported & (F.size("failed_checks") == 0)
    return keyed.select(
        *carried,
        verdict.alias("verdict"),
        F.when(unsupported, F.lit("unsupported_type"))
        .when(invalid, F.get("failed_checks", F.lit(0)))
        .alias("reason"),
        F.when(invalid, F.col("failed_checks")).alias("failed_checks"),
        *(
            F.when(valid, expr).alias(name)
            for name, expr in {
                "type": F.col("type"),
                "raw_value": F.col("raw_value"),
                "value": F.col("value"),
                "id": values.record_id(F.col("type"), F.col("value"), F.col("source")),
                "canonical_key": values.canonical_key(F.col("type"), F.col("value")),
                "source_reference": F.col("source_reference"),
                "first_seen": F.col("first_seen"),
                "last_seen": F.col("last_seen"),
                "confidence": F.col("confidence"),
                "family_label": F.col("family_label"),
                "family_id": F.col("family_id"),
                "malware_printable": F.col("malware_printable"),
                "malware_alias": F.col("malware_alias"),
                "threat_type": F.col("threat_type"),
                "tags": F.col("tags"),
                "kev": F.col("kev"),
            }.items()
        ),
    )


def normalize_vuln_fields(fields: DataFrame) -> DataFrame:
    """Observations from opened fields of an exploited-vulnerability catalogue."""
    added = values.parse_day(F.col("f_dateAdded"))
    no_date = _falsy("dateAdded")
    ransomware = F.lower(F.coalesce("f_knownRansomwareCampaignUse", F.lit(""))) == "known"
    nothing = F.lit(None).cast("string")
    carried = [c for c in fields.columns if c[:2] not in ("f_", "k_") and c != "is_object"]
    rows = fields.select(
        *carried,
        F.lit(False).alias("unsupported"),
        _failed(
            not_an_object=F.col("is_object"),
            cveID_missing=F.col("k_cveID").isNotNull(),
            cveID_not_text=(F.col("k_cveID") == "STRING") & (F.col("f_cveID") != ""),
            dateAdded_illegible=no_date | ((F.col("k_dateAdded") == "STRING") & added.isNotNull()),
        ).alias("failed_checks"),
        F.lit(m.VULNERABILITY).alias("type"),
        F.col("f_cveID").alias("raw_value"),
        F.lit(m.VULN_REFERENCE).alias("source_reference"),
        F.when(~no_date, added).alias("first_seen"),
        F.lit(None).cast("timestamp").alias("last_seen"),
        F.lit(m.VULN_CONFIDENCE).alias("confidence"),
        nothing.alias("family_label"),
        nothing.alias("family_id"),
        nothing.alias("malware_printable"),
        nothing.alias("malware_alias"),
        nothing.alias("threat_type"),
        F.when(ransomware, F.array(F.lit("ransomware")))
        .otherwise(F.array().cast("array<string>"))
        .alias("tags"),
        F.struct(*(F.col(f"f_{name}").alias(name) for name in KEV_FIELDS)).alias("kev"),
    )
    return _finish(rows, carried)


def normalize_ioc_fields(fields: DataFrame) -> DataFrame:
    """Observations from opened fields of an indicator feed."""
    label, ioc = F.col("f_ioc_type"), F.col("f_ioc")
    is_port = F.coalesce(label == "ip:port", F.lit(False))
    carried = [c for c in fields.columns if c[:2] not in ("f_", "k_") and c != "is_object"]
    # The steps of the address take the other fields along as one column, so that each copies them whole.
    fields = fields.select(F.struct("*").alias("_row"), F.when(is_port, ioc).alias("p_text"))
    fields = values.with_ip_port(fields, "p_text", "p_kind", "p_host").select("_row.*", "p_kind", "p_host")
    fields = fields.select(
        "*",
        values.indicator_type(label).alias("p_mapped"),
        values.parse_datetime(F.col("f_first_seen")).alias("p_first_seen"),
        values.parse_datetime(F.col("f_last_seen")).alias("p_last_seen"),
    )
    host = F.col("p_host")
    mapped = F.when(is_port, F.col("p_kind")).otherwise(F.col("p_mapped"))
    keys_given = F.col("k_ioc_type").isNotNull() & F.col("k_ioc").isNotNull()
    level_text, level_kind = F.col("f_confidence_level"), F.col("k_confidence_level")
    no_level = level_kind.isNull() | (level_kind == "VOID")
    whole_text = (level_kind != "STRING") | level_text.rlike(r"^\s*[+-]?\d+\s*$")
    level = F.when(
        level_kind == "BOOLEAN", F.when(level_text == "true", F.lit(1)).otherwise(F.lit(0))
    ).otherwise(values.whole_number(level_text, 100))

    def timely(name: str) -> Column:
        parsed = F.col(f"p_{name}")
        return _falsy(name) | ((F.col(f"k_{name}") == "STRING") & parsed.isNotNull())

    def moment(name: str) -> Column:
        return F.when(~_falsy(name), F.col(f"p_{name}"))

    def given(name: str) -> Column:
        return F.when(~_falsy(name), F.col(f"f_{name}"))

    label_or_id = F.coalesce(given("malware_printable"), F.col("f_malware"))
    tags_kind = F.coalesce("k_tags", F.lit("VOID"))
    only_string = lambda name: F.when(F.col(f"k_{name}") == "STRING", F.col(f"f_{name}"))
    rows = fields.select(
        *carried,
        (F.col("is_object") & keys_given & ~is_port & F.col("p_mapped").isNull()).alias("unsupported"),
        _failed(
            not_an_object=F.col("is_object"),
            ioc_missing=keys_given,
            ioc_not_text=(F.col("k_ioc") == "STRING") & (ioc != ""),
            ipv6_malformed=~is_port | host.isNotNull(),
            confidence_out_of_range=no_level | (whole_text & level.between(0, 100)),
            first_seen_illegible=timely("first_seen"),
            last_seen_illegible=timely("last_seen"),
            family_not_text=_optional_string("malware_printable") & _optional_string("malware"),
            threat_type_not_text=_optional_string("threat_type"),
            reference_not_text=_falsy("reference") | _optional_string("reference"),
            tags_not_a_list=tags_kind.isin("VOID", "ARRAY<VOID>", "ARRAY<STRING>"),
        ).alias("failed_checks"),
        mapped.alias("type"),
        F.when(is_port, host).otherwise(ioc).alias("raw_value"),
        F.coalesce(given("reference"), F.lit(m.IOC_REFERENCE)).alias("source_reference"),
        moment("first_seen").alias("first_seen"),
        moment("last_seen").alias("last_seen"),
        F.when(no_level, F.lit(m.IOC_DEFAULT_CONFIDENCE)).otherwise(level).alias("confidence"),
        label_or_id.alias("family_label"),
        names.family_id(only_string("malware")).alias("family_id"),
        only_string("malware_printable").alias("malware_printable"),
        only_string("malware_alias").alias("malware_alias"),
        F.col("f_threat_type").alias("threat_type"),
        F.coalesce("f_tags", F.array().cast("array<string>")).alias("tags"),
        F.lit(None).cast(KEV_TYPE).alias("kev"),
    )
    return _finish(rows, carried)


def normalize_vuln_feed(batch: DataFrame) -> DataFrame:
    return normalize_vuln_fields(open_fields(batch, VULN_READS))


def normalize_ioc_feed(batch: DataFrame) -> DataFrame:
    return normalize_ioc_fields(open_fields(batch, IOC_READS))


def key_observations(raw: DataFrame) -> DataFrame:
    """``(source, type, raw_value)`` with normalised value, identities and collapse counts.

    One row per key: how many rows and how many raw spellings fall into it.
    """
    value = values.normalize_value(F.col("type"), F.col("raw_value"))
    keyed = raw.select("source", "type", "raw_value", value.alias("value"))
    return (
        keyed.groupBy("type", "value")
        .agg(
            F.count("*").alias("n_rows"),
            F.countDistinct("raw_value").alias("n_spellings"),
        )
        .select(
            values.canonical_key(F.col("type"), F.col("value")).alias("canonical_key"),
            "type",
            "value",
            "n_rows",
            "n_spellings",
        )
    )


def reportable(observations: DataFrame) -> DataFrame:
    """Rows confident enough for the report; vulnerabilities have a section of their own."""
    return observations.where(
        (F.col("confidence") >= m.REPORT_MIN_CONFIDENCE) & (F.col("type") != m.VULNERABILITY)
    )


def trivial_counts(observations: DataFrame) -> DataFrame:
    """Kept and removed rows per source and type, so that the removal is declared."""
    trivial = values.is_trivial(F.col("value"))
    return observations.groupBy("source", "type").agg(
        F.count_if(~trivial).alias("n_kept"), F.count_if(trivial).alias("n_removed")
    )
