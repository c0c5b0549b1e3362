"""Names folded once, and families resolved again only where a run changed what decides them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedmark.functions.names import canon
from feedmark.operators.families import resolve_families
from feedmark.sources.state_log import exists


class NameDictionary:
    """Raw names with their canons, below ``path``; a run adds the names no other run has added.

    A run's names are written under its id, so that a run repeated with the same names replaces its own rows only.
    """

    SCHEMA = "name string, canon string, run string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        """(name, canon, run); empty before the first run."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def add(self, names: DataFrame, run: str) -> DataFrame:
        """Folds the names that are new and returns them with their canons. ``names`` has a column ``name``; NULLs are left out."""
        known = self.read().where(F.col("run") != run).select("name")
        unseen = names.select("name").where(F.col("name").isNotNull()).distinct().join(known, "name", "left_anti")
        folder = f"{self.path}/run={run}"
        unseen.withColumn("canon", canon(F.col("name"))).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema("name string, canon string").parquet(folder)

    def canonical(self) -> DataFrame:
        """(canon, name, n_names) of all names, as ``families.canonical_names`` gives it."""
        named = self.read().select("canon", "name")
        return named.join(named.groupBy("canon").agg(F.count("*").alias("n_names")), "canon")


def _changed(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Keys whose row is not the same on both sides; one row for each key on each side."""
    facts = [c for c in now.columns if c != key]
    new = now.select(key, F.struct(*facts).alias("_now"))
    old = before.select(key, F.struct(*facts).alias("_before"))
    return new.join(old, key, "full_outer").where(~F.col("_now").eqNullSafe(F.col("_before"))).select(key)


def resolve_again(
    resolved: DataFrame,
    names: DataFrame,
    candidates: DataFrame,
    index: DataFrame,
    candidates_before: DataFrame,
    index_before: DataFrame,
) -> DataFrame:
    """``resolve_families(names, candidates, index)``, from what it gave before (``resolved``).

    A family is decided anew when it is new, when one of its candidates came, went or is another name now, or when a
    canon it holds leads to other software or is held by other families. All others keep their row.
    """
    place = ["family_id", "canon", "rank", "name"]
    moved = candidates.select(place).exceptAll(candidates_before.select(place))
    moved = moved.unionByName(candidates_before.select(place).exceptAll(candidates.select(place)))
    canons = moved.select("canon").union(_changed(index, index_before, "canon")).distinct()
    both = candidates.select("family_id", "canon").union(candidates_before.select("family_id", "canon"))
    listed = names.select("family_id").distinct()
    unknown = listed.join(resolved.select("family_id"), "family_id", "left_anti")
    touched = both.join(canons, "canon", "left_semi").select("family_id").union(unknown).distinct()
    # The rivals of a touched family count, so all candidates of its canons are needed, and no others.
    held = candidates.join(touched, "family_id", "left_semi").select("canon").distinct()
    again = resolve_families(
        names.join(touched, "family_id", "left_semi"), candidates.join(held, "canon", "left_semi"), index.join(held, "canon", "left_semi")
    )
    kept = resolved.join(touched, "family_id", "left_anti").join(listed, "family_id", "left_semi")
    return kept.unionByName(again)
