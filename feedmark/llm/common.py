"""Helpers that several of the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmark.session import stage

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The whole text; a missing one counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def numbered(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Rows with a number each. Stage the result before it is read twice: only then do they hold."""
    return df.withColumn(name, F.monotonically_increasing_id())


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, component): the smallest node reachable, for nodes that have an edge to another.

    ``edges`` has two columns of longs. Alternates two steps until nothing changes: each node hands
    its smallest neighbour first to the larger ones, then to the smaller ones, so that a chain of n
    nodes shrinks to a star in about log n rounds. Minima are combined before the shuffle, joins on
    a hub are left to the skew join, and each round's edges are written to the shared folder.
    """
    left, right = edges.columns
    u, v, low = F.col("u"), F.col("v"), F.col("low")
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    current = stage(pairs.where(u != v).distinct(), name)
    before = None
    while (print_ := _fingerprint(current)) != before:
        before = print_
        both = current.union(current.select(v, u))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least(u, low).alias("low"))
        large = both.join(least, "u").where(v > u).select(v.alias("u"), low.alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(least, "u")
        moved = small.where(v != low).select(v.alias("u"), low.alias("v"))
        current = stage(moved.union(least.select("u", low.alias("v"))).distinct(), name)
    star = current.select(u.alias("node"), v.alias("component"))
    return star.union(star.select(F.col("component").alias("node"), "component").distinct())


def _fingerprint(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
