"""Joining a large table to a lookup table whose size is not known beforehand."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# What a lookup that is broadcast may hold: rows, and bytes of all its fields written out.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def is_small(lookup: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``lookup`` has at most so many rows and bytes; reads no more than one row beyond."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("bigint"))
    rows, held = lookup.limit(max_rows + 1).agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return rows <= max_rows and held <= max_bytes


def join_lookup(
    facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join ``facts`` (any size, any skew) to ``lookup`` (unique on ``on``).

    A lookup proven small is broadcast. Beyond that bound both sides are shuffled and each task hashes its part of the
    lookup, so the facts are neither sorted nor spilled for it; a key that holds a third of the facts, and the facts
    without a key, are split over tasks by the adaptive skew join. The hint also keeps Spark from broadcasting a lookup
    whose files are small and whose rows are not.
    """
    if is_small(lookup, max_rows):
        return facts.join(F.broadcast(lookup), on, how)
    return facts.join(lookup.hint("shuffle_hash"), on, how)


def in_parts(rows: DataFrame, lookup: DataFrame, parts: int = 2) -> list[DataFrame]:
    """``rows``, joined to ``lookup`` by ``join_lookup``, to be written one part after the other, by a hash of their ``id``.

    One part where the lookup is broadcast. Beyond its bound the joined rows are shuffled: each part reads the facts
    again, but no more than its own rows lie in shuffle files at a time.
    """
    if is_small(lookup):
        return [rows]
    return [rows.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part) for part in range(parts)]
