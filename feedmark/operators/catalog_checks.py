"""Profile of a catalogue version, its drift against a baseline, its retired objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmark import model as m
from feedmark.operators.families import catalog_index, catalog_names
from feedmark.sources import catalog


def catalog_profile(objects: DataFrame) -> DataFrame:
    """``(magnitude, observed)``: the counts a catalogue version is known by."""
    live = catalog.is_software() & catalog.marker().isNull()
    counted = objects.agg(
        F.count("*").alias("objects"),
        F.count_if(catalog.is_software()).alias("software"),
        F.count_if(live).alias("software_live"),
        F.count_if(live & (F.size(F.coalesce("x_mitre_aliases", F.array())) > 0)).alias(
            "live_with_aliases"
        ),
        F.count_if(catalog.is_software() & catalog.marker().isNotNull()).alias("software_retired"),
    )
    software = catalog.software(objects)
    canons = catalog_index(catalog_names(software)).agg(
        F.count("*").alias("canons"), F.count_if(F.col("n_software") > 1).alias("canons_ambiguous")
    )
    edges = (
        catalog.uses(objects)
        .groupBy("source_ref", "target_ref")
        .agg(F.count("*").alias("n_edges"))
        .join(software.select(F.col("id").alias("source_ref")), "source_ref", "left_semi")
        .join(catalog.patterns(objects).select(F.col("id").alias("target_ref")), "target_ref", "left_semi")
        .agg(F.coalesce(F.sum("n_edges"), F.lit(0)).alias("uses_live"))
    )
    return _long(counted).unionByName(_long(canons)).unionByName(_long(edges))


def _long(one_row: DataFrame) -> DataFrame:
    return one_row.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(name).alias("magnitude"), F.col(name).cast("bigint").alias("observed"))
                    for name in one_row.columns
                )
            )
        )
    )


# Magnitudes whose fall to zero breaks the resolution outright, whatever the baseline says.
NEVER_ZERO = ("live_with_aliases", "uses_live")


def catalog_drift(profile: DataFrame, baseline: DataFrame) -> DataFrame:
    """Observed against expected, magnitude by magnitude; one side missing is drift too."""
    joined = profile.join(
        baseline.select("magnitude", F.col("observed").alias("expected")), "magnitude", "full_outer"
    )
    defect = (
        F.when(F.col("observed").isNull(), F.lit("not_observed"))
        .when(F.col("expected").isNull(), F.lit("no_baseline"))
        .when(F.col("magnitude").isin(*NEVER_ZERO) & (F.col("observed") == 0), F.lit("gone"))
        .when(F.col("observed") != F.col("expected"), F.lit("changed"))
    )
    return joined.select("magnitude", "observed", "expected", defect.alias("defect"))


def _by_identity(objects: DataFrame, side: str) -> DataFrame:
    """One row per id: what it shows, and how often the version holds it. Copies collapse before the shuffle.

    Of several rows of one id the greatest counts, taken as a whole, so that their order never decides.
    """
    aliases = F.array_join(F.array_sort(F.array_distinct(F.coalesce("x_mitre_aliases", F.array().cast("array<string>")))), "\n")
    shown = F.struct("type", "name", aliases.alias("aliases"), catalog.marker().alias("marker"), "source_ref", "target_ref")
    rows = objects.where(F.col("id").isNotNull()).select("id", shown.alias("shown"))
    return rows.groupBy("id").agg(F.max("shown").alias(side), F.count("*").alias(f"n_{side}"))


def catalog_object_drift(objects: DataFrame, baseline: DataFrame) -> DataFrame:
    """The objects behind a drift: one row for each id that is not the same in both versions.

    ``change`` is the first that applies: ``added``, ``gone``, ``retired`` (live before), ``revived`` (retired before),
    ``remarked`` (retired otherwise than before), ``retyped``, ``renamed`` (name or aliases), ``rewired`` (the ends of a
    relation), ``repeated`` (held more or fewer times). Objects without an id are not looked at.
    """
    now, was = F.col("now"), F.col("before")
    joined = _by_identity(objects, "now").join(_by_identity(baseline, "before"), "id", "full_outer")

    def differs(*names: str) -> Column:
        return F.array_contains(F.array(*(~now[name].eqNullSafe(was[name]) for name in names)), True)

    change = (
        F.when(was.isNull(), F.lit("added"))
        .when(now.isNull(), F.lit("gone"))
        .when(was["marker"].isNull() & now["marker"].isNotNull(), F.lit("retired"))
        .when(was["marker"].isNotNull() & now["marker"].isNull(), F.lit("revived"))
        .when(differs("marker"), F.lit("remarked"))
        .when(differs("type"), F.lit("retyped"))
        .when(differs("name", "aliases"), F.lit("renamed"))
        .when(differs("source_ref", "target_ref"), F.lit("rewired"))
        .when(F.col("n_now") != F.col("n_before"), F.lit("repeated"))
    )
    return joined.withColumn("change", change).where(F.col("change").isNotNull()).select(
        "id",
        F.coalesce(now["type"], was["type"]).alias("type"),
        "change",
        was["marker"].alias("marker"),
        now["marker"].alias("marker_now"),
        was["name"].alias("name"),
        now["name"].alias("name_now"),
    )


def check_declared(declared: DataFrame) -> DataFrame:
    """Whether a declared list can be checked at all: not empty, known markers, both covered."""
    return declared.agg(
        F.count("*").alias("n_declared"),
        F.count_if(
            F.col("id").isNull() | ~F.coalesce(F.col("marker").isin(*m.RETIREMENT_MARKERS), F.lit(False))
        ).alias("n_malformed"),
        F.countDistinct(F.when(F.col("marker").isin(*m.RETIREMENT_MARKERS), F.col("marker"))).alias(
            "n_markers"
        ),
    ).withColumn(
        "checkable",
        (F.col("n_declared") > 0)
        & (F.col("n_malformed") == 0)
        & (F.col("n_markers") == len(m.RETIREMENT_MARKERS)),
    )


def retired_by_identity(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Every declared retired object against the catalogue: still there, by the same marker?

    Further retired objects are normal evolution and are not looked at. A declared list that cannot
    be checked gives one row that says so, without an id, instead of verdicts.
    """
    check = check_declared(declared)
    checkable = check.select("checkable").scalar()
    nothing = F.lit(None).cast("string")
    refused = check.where("not checkable").select(
        nothing.alias("id"), nothing.alias("marker"), nothing.alias("marker_now"), F.lit("not_checkable").alias("verdict")
    )
    now = observed.select("id", F.col("marker").alias("marker_now"))
    verdict = (
        F.when(F.col("marker_now").isNull(), F.lit("absent"))
        .when(F.col("marker_now") != F.col("marker"), F.lit("marker_changed"))
        .otherwise(F.lit("kept"))
    )
    found = declared.where(checkable).join(now, "id", "left")
    return found.select("id", "marker", "marker_now", verdict.alias("verdict")).unionByName(refused)
