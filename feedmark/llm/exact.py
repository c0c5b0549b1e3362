"""Exact deduplication by recipes of content-defined chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmark.llm.common import numbered, table, whole_text
from feedmark.session import stage

SHORTEST, LONGEST = 512, 4096
# A chunk ends where a sentence or clause ends in one of these letters, wherever that stands in the text.
CUT = r"(?<=[a-m][.,;:!?\n])"
NO_ID = -(2**63)


def chunks(text: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """The text's chunks in order; joined they give the text. Cuts depend on what is near them only."""
    rule = rf"(?s).{{{shortest},{longest}}}?{CUT}|.{{1,{longest}}}"
    return F.regexp_extract_all(text, F.lit(rule), F.lit(0))


def digest(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def clashes(docs: DataFrame, identifier: Callable[[Column], Column] = digest) -> DataFrame:
    """Identifiers that stand for more than one chunk. Every distinct chunk's bytes travel once."""
    each = docs.select(F.explode(chunks(whole_text())).alias("chunk")).distinct()
    return each.groupBy(identifier(F.col("chunk")).alias("id")).count().where("count > 1")


def exact_groups(docs: DataFrame, identifier: Callable[[Column], Column] = digest) -> DataFrame:
    """Groups of documents with identical text.

    One row per row of ``docs`` (doc_id, text; other columns are ignored): doc_id, keep_id,
    group_size, kept, text_sha256, recipe. A text is cut into chunks, each distinct chunk gets an
    identifier, the identifiers are verified against the chunks' bytes, and texts are equal when
    their ordered identifier lists are. After the verification only the lists move.

    Of a group the row with the largest doc_id stays, null last; of repeated rows with that doc_id
    exactly one. A null text is an empty text, all empty texts are one group, and an empty table
    gives no rows. Identifiers that stand for two chunks stop the job.
    """
    if (bad := clashes(docs, identifier).first()) is not None:
        raise ValueError(f"chunk identifier {bad['id']!r} stands for {bad['count']} chunks")
    rows = stage(
        numbered(docs).select(
            "row_id",
            "doc_id",
            F.transform(chunks(whole_text()), identifier).alias("recipe"),
            F.sha2(whole_text(), 256).alias("text_sha256"),
        ),
        "recipes",
    )
    each = rows.groupBy("recipe", "doc_id").agg(F.count("*").alias("n"), F.min("row_id").alias("first"))
    groups = each.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.max_by("first", F.coalesce("doc_id", F.lit(NO_ID))).alias("keep_row"),
    )
    kept = (F.col("row_id") == F.col("keep_row")).alias("kept")
    return rows.join(groups, "recipe").select("doc_id", "keep_id", "group_size", kept, "text_sha256", "recipe")


def drop_copies(docs: DataFrame, identifier: Callable[[Column], Column] = digest) -> DataFrame:
    """``docs``, all columns, without the rows that ``exact_groups`` drops; of repeated rows one stays."""
    # the same columns for join and window, so that the texts move once
    same = ["id", "no_id", "sha"]
    key = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id")]
    groups = exact_groups(docs, identifier).where("kept").select(*key, F.col("text_sha256").alias("sha"))
    rows = docs.select(F.struct("*").alias("row"), *key, F.sha2(whole_text(), 256).alias("sha"))
    found = rows.join(groups, same, "left_semi")
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("sha"))
    return found.withColumn("nth", nth).where("nth = 1").select("row.*")


def query(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents")).drop("recipe")


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
