"""Feed documents: envelope checks and explosion into records.

Two landing shapes are read. A *document* is one JSON text with an envelope around its list of
records. Feeds too large for one document land as *record lines*, one JSON record per line, so
that a single file never becomes a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmark import model as m
from feedmark.functions import records

RATE_LIMIT = "(?i)rate|limit|throttle"
TOO_LARGE = "too_large"
PARSED_BYTES = 8 << 20  # a text of more than this may exceed what a VARIANT holds


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as documents; the file path is the document id."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("body")
    )


def read_document_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(source, run_id, doc_id, body)`` documents landed as JSON lines of strings."""
    schema = "source string, run_id string, doc_id string, body string, http_code int"
    return spark.read.schema(schema).json(path)


def read_record_lines(spark: SparkSession, path: str, source: str, run_id: str) -> DataFrame:
    """A batch from record lines; a line that is not JSON gives a NULL record, not an error."""
    lines = spark.read.text(path)
    return lines.select(
        F.lit(source).alias("source"),
        F.lit(run_id).alias("run_id"),
        records.parse(F.col("value")).alias("record"),
    )


def open_envelopes(documents: DataFrame, spec: m.FeedSpec) -> DataFrame:
    """One row per document: envelope fault, run status and, if sound, its list of records.

    A missing list key is a failed run, not an empty feed. A document too large to be parsed as one row has
    a fault of its own (``large_documents.scan_files`` reads such files). In a window feed ``no_result`` is an
    answer with zero records; any status but ``ok`` is a failure.
    """
    opened = documents.withColumn("_doc", records.parse(F.col("body")))
    doc = F.col("_doc")
    listed = records.elements(doc, spec.envelope_key)
    large = F.coalesce(F.octet_length("body") > PARSED_BYTES, F.lit(False))
    fault = (
        F.when(doc.isNull(), F.when(large, F.lit(TOO_LARGE)).otherwise(F.lit("not_json")))
        .when(~records.is_object(doc) | ~records.has_key(doc, spec.envelope_key), F.lit("list_missing"))
        .when(listed.isNull(), F.lit("list_not_a_list"))
    )
    status = F.lit(None).cast("string")
    if spec.kind == "window":
        status = records.only_string(doc, "query_status")
        fault = (
            F.when(doc.isNull(), F.when(large, F.lit(TOO_LARGE)).otherwise(F.lit("not_json")))
            .when(status == "no_result", F.lit(None).cast("string"))
            .when(status.rlike(RATE_LIMIT) & (status != "ok"), F.lit("rate_limited"))
            .when(~F.coalesce(status == "ok", F.lit(False)), F.lit("not_ok"))
            .otherwise(fault)
        )
    # A document that failed or has nothing to report brings no records, whatever else is in it.
    usable = F.col("fault").isNull()
    if spec.kind == "window":
        usable = usable & (F.col("query_status") == "ok")
    return (
        opened.withColumn("kind", F.lit(spec.kind))
        .withColumn("query_status", status)
        .withColumn("fault", fault)
        .withColumn("records", F.when(usable, listed))
        .withColumn("n_records", F.coalesce(F.size("records"), F.lit(0)))
        .withColumn("run_ok", F.col("fault").isNull())
        .drop("_doc")
    )


def explode_records(envelopes: DataFrame) -> DataFrame:
    """The batch: one row per record of the sound envelopes."""
    keep: list[Column] = [F.col(c) for c in ("source", "run_id") if c in envelopes.columns]
    return envelopes.select(*keep, F.explode("records").alias("record"))


def scan_documents(documents: DataFrame, spec: m.FeedSpec) -> tuple[DataFrame, DataFrame]:
    """Envelopes (without their records) and the batch of records."""
    envelopes = open_envelopes(documents, spec)
    return envelopes.drop("records", "body"), explode_records(envelopes)
