"""Reference catalogue: one pass over its objects, four tables out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

SOFTWARE_TYPES = ("malware", "tool")
TECHNIQUE_SOURCE = "mitre-attack"

OBJECT_SCHEMA = """
    id string, type string, name string, x_mitre_aliases array<string>,
    revoked boolean, x_mitre_deprecated boolean,
    external_references array<struct<source_name: string, external_id: string>>,
    relationship_type string, source_ref string, target_ref string
"""


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    """Objects of a single-document bundle."""
    objects = T.ArrayType(T.StructType.fromDDL(OBJECT_SCHEMA))
    schema = T.StructType([T.StructField("objects", objects)])
    return spark.read.schema(schema).json(path, multiLine=True).select(F.inline("objects"))


def read_object_lines(spark: SparkSession, path: str) -> DataFrame:
    """Objects landed one per line, which is how a large bundle should land."""
    return spark.read.schema(OBJECT_SCHEMA).json(path)


def is_software() -> Column:
    return F.col("type").isin(*SOFTWARE_TYPES)


def marker() -> Column:
    """Why an object is retired; NULL for a live one."""
    return F.when(F.coalesce("revoked", F.lit(False)), F.lit("revoked")).when(
        F.coalesce("x_mitre_deprecated", F.lit(False)), F.lit("x_mitre_deprecated")
    )


def software(objects: DataFrame) -> DataFrame:
    """Live software; revoked and deprecated objects only manufacture ambiguity."""
    return objects.where(is_software() & marker().isNull()).select("id", "name", "x_mitre_aliases")


def retired(objects: DataFrame) -> DataFrame:
    return objects.where(is_software() & marker().isNotNull()).select(
        "id", marker().alias("marker")
    )


def patterns(objects: DataFrame) -> DataFrame:
    """Attack patterns with the first external id of the technique catalogue, '' if none."""
    reference = F.get(
        F.filter("external_references", lambda r: r["source_name"] == TECHNIQUE_SOURCE), F.lit(0)
    )
    return objects.where(F.col("type") == "attack-pattern").select(
        "id",
        F.coalesce("name", F.lit("")).alias("technique_name"),
        F.coalesce(reference["external_id"], F.lit("")).alias("technique_id"),
    )


def uses(objects: DataFrame) -> DataFrame:
    """``uses`` relations, whatever they connect."""
    return objects.where(
        (F.col("type") == "relationship") & (F.col("relationship_type") == "uses")
    ).select("source_ref", "target_ref")
