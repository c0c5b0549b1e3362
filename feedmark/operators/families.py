"""Exact resolution of malware families to catalogue software, abstaining when ambiguous.

A technique belongs to a family, not to an indicator: everything here works on name dimensions
that are made distinct before anything else, so a family that owns a third of all observations
costs one row per distinct name. Names stay in long tables; no family's names are collected.

Column order of a candidate: ``rank`` 0 is the name inside the family identifier, asserted by the
naming authority; rank 1 are the feed's own names in code-point order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedmark import model as m
from feedmark.functions.names import canon, malpedia_name, split_aliases
from feedmark.functions.values import strip


TECHNIQUES = "array<struct<technique_id:string,technique_name:string>>"


def family_names(observations: DataFrame) -> DataFrame:
    """Distinct ``(family_id, name)`` over all observations; ``name`` NULL where there is none.

    The union of all names a family was seen with, so the order of records cannot matter.
    """
    seen = (
        observations.where(F.col("family_id").isNotNull())
        .select("family_id", "malware_printable", "malware_alias")
        .distinct()
    )
    printable = F.when(strip(F.col("malware_printable")) != "", strip(F.col("malware_printable")))
    names = F.concat(F.array(printable), split_aliases(F.col("malware_alias")))
    return seen.select(
        "family_id", F.explode(F.array_distinct(names)).alias("name")
    ).distinct()


def group_families(names: DataFrame) -> DataFrame:
    """One row per family: how many names, and the first and last of them."""
    return names.groupBy("family_id").agg(
        F.count("name").alias("n_names"),
        F.min("name").alias("first_name"),
        F.max("name").alias("last_name"),
    )


def family_candidates(names: DataFrame) -> DataFrame:
    """Candidate names, one row per (family, canon), keeping the first that gives the canon."""
    own = names.select("family_id").distinct().select(
        "family_id", F.lit(0).alias("rank"), malpedia_name(F.col("family_id")).alias("name")
    )
    feed = names.where(F.col("name").isNotNull()).select("family_id", F.lit(1).alias("rank"), "name")
    first = F.min(F.struct("rank", "name")).alias("first")
    return (
        own.unionByName(feed)
        .withColumn("canon", canon(F.col("name")))
        .where("canon != ''")
        .groupBy("family_id", "canon")
        .agg(first)
        .select("family_id", "canon", "first.rank", "first.name", authority("first.rank"))
    )


def authority(rank: str):
    return (
        F.when(F.col(rank) == 0, F.lit(m.MALPEDIA)).otherwise(F.lit(m.FEED)).alias("authority")
    )


def canonical_names(*names: DataFrame) -> DataFrame:
    """Name dimension: distinct raw names with their canon and how many names share it.

    The count per canon is joined back rather than taken in a window, so that a canon with very
    many spellings is not sorted in one task.
    """
    distinct = names[0]
    for more in names[1:]:
        distinct = distinct.unionByName(more)
    named = distinct.distinct().withColumn("canon", canon(F.col("name")))
    shared = named.groupBy("canon").agg(F.count("*").alias("n_names"))
    return named.join(shared.hint("merge"), "canon")


def catalog_names(software: DataFrame) -> DataFrame:
    """Distinct ``(canon, software_id)`` over software names and aliases."""
    names = F.concat(F.array("name"), F.coalesce("x_mitre_aliases", F.array().cast("array<string>")))
    return (
        software.select(F.col("id").alias("software_id"), F.explode(names).alias("name"))
        .distinct()
        .select(canon(F.col("name")).alias("canon"), "software_id")
        .where("canon != ''")
        .distinct()
    )


def catalog_index(names: DataFrame) -> DataFrame:
    """Per canon how many software it names and, if one, which."""
    return names.groupBy("canon").agg(
        F.count("*").alias("n_software"), F.min("software_id").alias("software_id")
    )


def resolve_families(names: DataFrame, candidates: DataFrame, index: DataFrame) -> DataFrame:
    """One row per family of ``names``: its software, or the reason to abstain.

    A family none of whose names leaves a canon has no candidate, and so no entry; it stays a family.
    Candidates without a catalogue entry do not count. The first ambiguous one in candidate order
    decides: several software behind its canon come before several families behind it. If none is
    ambiguous, the family must lead to exactly one software.
    """
    shared = candidates.groupBy("canon").agg(F.count("*").alias("n_families"))
    # All of these grow with the names: the hints keep Spark from broadcasting what its files make look small.
    hits = candidates.join(index.hint("merge"), "canon").join(shared.hint("merge"), "canon")
    place = F.struct("rank", "name")
    ambiguous = (F.col("n_software") > 1) | (F.col("n_families") > 1)
    why = F.when(F.col("n_software") > 1, F.lit(m.AMBIGUOUS_CATALOG)).otherwise(
        F.lit(m.AMBIGUOUS_ORIGIN)
    )
    verdict = hits.groupBy("family_id").agg(
        F.min(F.when(ambiguous, F.struct("rank", "name", why.alias("why")))).alias("ambiguity"),
        F.min("software_id").alias("first_software"),
        F.max("software_id").alias("last_software"),
        F.min(place).alias("matched"),
    )
    families = names.select("family_id").distinct()
    reason = (
        F.when(F.col("matched").isNull(), F.lit(m.FAMILY_NO_ENTRY))
        .when(F.col("ambiguity").isNotNull(), F.col("ambiguity.why"))
        .when(F.col("first_software") != F.col("last_software"), F.lit(m.AMBIGUOUS_CANDIDATES))
    )
    return (
        families.join(verdict.hint("merge"), "family_id", "left")
        .withColumn("reason", reason)
        .select(
            "family_id",
            "reason",
            F.when(F.col("reason").isNull(), F.col("first_software")).alias("software_id"),
            F.when(F.col("reason").isNull(), F.col("matched.name")).alias("matched_name"),
            F.when(F.col("reason").isNull(), authority("matched.rank")).alias("authority"),
        )
    )


def software_techniques(software: DataFrame, patterns: DataFrame, uses: DataFrame) -> DataFrame:
    """Edges from live software to attack patterns, one row per pair with its multiplicity.

    Retired patterns and edges still count. The edges are counted before they are joined, so a
    software with very many repeated edges is one row per pattern.
    """
    edges = uses.groupBy("source_ref", "target_ref").agg(F.count("*").alias("n_edges"))
    live = software.select(F.col("id").alias("source_ref")).distinct()
    return (
        edges.join(live.hint("merge"), "source_ref", "left_semi")
        .join(patterns.withColumnRenamed("id", "target_ref"), "target_ref")
        .select(
            F.col("source_ref").alias("software_id"),
            F.col("target_ref").alias("pattern_id"),
            "technique_id",
            "technique_name",
            "n_edges",
        )
    )


def family_techniques(resolved: DataFrame, edges: DataFrame) -> DataFrame:
    """Techniques of the resolved families, one row per (family, technique id, name).

    Identifiers other than the four-digit form are left out, sub-techniques among them. The
    confidence follows who asserts the matched name, never how alike the names are.
    """
    admissible = edges.where(
        F.col("technique_id").rlike(m.TECHNIQUE_PATTERN) & (F.col("technique_name") != "")
    )
    confidence = F.when(F.col("authority") == m.MALPEDIA, F.lit(m.HIGH)).otherwise(F.lit(m.MEDIUM))
    return (
        resolved.where(F.col("software_id").isNotNull())
        .join(admissible.hint("merge"), "software_id")
        .groupBy("family_id", "technique_id", "technique_name", "authority", "matched_name")
        .agg(F.sum("n_edges").alias("n_edges"))
        .select(
            "family_id",
            "technique_id",
            "technique_name",
            F.lit(m.DERIVED).alias("mapping_method"),
            confidence.alias("mapping_confidence"),
            "matched_name",
            "authority",
            "n_edges",
        )
    )


def family_mapping(resolved: DataFrame, techniques: DataFrame) -> DataFrame:
    """One row per family: techniques found, or the reason there are none.

    ``technique_ids`` holds distinct four-digit identifiers, so it is bounded by their number;
    ``techniques`` has them with their names. The rationale is the name that matched and who asserts it.
    """
    found = techniques.groupBy("family_id").agg(
        F.sum("n_edges").alias("n_techniques"),
        F.array_sort(F.collect_set("technique_id")).alias("technique_ids"),
        F.array_sort(F.collect_set(F.struct("technique_id", "technique_name"))).alias("techniques"),
        F.min("mapping_confidence").alias("mapping_confidence"),
        F.min(F.concat_ws(": ", "authority", "matched_name")).alias("rationale"),
    )
    reason = F.when(
        F.col("reason").isNull() & F.col("n_techniques").isNull(), F.lit(m.FAMILY_NO_TECHNIQUES)
    ).otherwise(F.col("reason"))
    return resolved.join(found.hint("merge"), "family_id", "left").select(
        "family_id",
        reason.alias("reason"),
        "software_id",
        F.coalesce("n_techniques", F.lit(0)).cast("bigint").alias("n_techniques"),
        F.coalesce("technique_ids", F.array().cast("array<string>")).alias("technique_ids"),
        F.coalesce("techniques", F.array().cast(TECHNIQUES)).alias("techniques"),
        "mapping_confidence",
        "rationale",
    )


def map_families(
    observations: DataFrame, software: DataFrame, patterns: DataFrame, uses: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Mapping per family and its technique rows, from observations and a catalogue."""
    names = family_names(observations)
    candidates = family_candidates(names)
    resolved = resolve_families(names, candidates, catalog_index(catalog_names(software)))
    techniques = family_techniques(resolved, software_techniques(software, patterns, uses))
    return family_mapping(resolved, techniques), techniques
