"""Mixing sources to target weights: packed blocks, multinomial draws per shard, permuted blocks."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmark.llm.common import WORD, numbered, table, whole_text
from feedmark.session import stage

WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating
SHARE = 1.5  # of all words
MOST = 2.0  # times a source's size
BLOCK = 128  # words in a block
SHARD = 4096  # blocks in an output shard
BUCKET = 4096  # documents whose words are packed together
LEAST_CELLS = 1024
TASK = 65_536  # output blocks that one task writes out
ROUNDS = 8


def sizes(docs: DataFrame) -> DataFrame:
    """Narrow rows (row_id, doc_id, src, size); src is a text that is never null and sorts null last."""
    src = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), "source"))
    size = F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint")
    return stage(numbered(docs).select("row_id", "doc_id", src.alias("src"), size.alias("size")), "sizes")


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(src, rank, source_size, target): one row for each source.

    Sharing the excess of capped sources again and again by weight ends where all others get the
    same number of words for each unit of weight. With the sources in the order in which they are
    capped that number is the largest of ``rate``: it rises until the first source that stays
    below its cap, and falls from there on.
    """
    total = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("src")) - 1
    weight = F.array(*map(F.lit, weights))[(F.col("rank") % len(weights)).cast("int")].cast("double")
    cap = most * F.col("source_size")
    sources = total.withColumn("rank", rank).withColumn("weight", weight).withColumn("cap", cap.cast("double"))
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing))
    wanted = F.sum("source_size").over(everything) * share
    sources = sources.withColumn("rate", (wanted - before) / left)
    rate = F.max("rate").over(everything)
    return sources.select("src", "rank", "source_size", F.least("cap", rate * F.col("weight")).alias("target"))


def pieces(rows: DataFrame, block: int = BLOCK, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """Words of a source packed into blocks: (row_id, src, block_no, words, first_word), and (src, blocks).

    Documents are dealt to buckets by doc_id, words are packed in doc_id order within a bucket, and
    blocks are numbered through a source. Only a bucket's last block may be short.
    """
    buckets = max(1, math.ceil(rows.count() / bucket))
    full = rows.where("size > 0").withColumn("bucket", F.expr(f"pmod(xxhash64(doc_id), {buckets}L)"))
    inside = Window.partitionBy("src", "bucket").orderBy("doc_id", "size", "row_id")
    start = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    count = F.ceil(F.sum("size") / block).cast("bigint")
    per_bucket = full.groupBy("src", "bucket").agg(count.alias("n"))
    through = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    offsets = per_bucket.select("src", "bucket", (F.sum("n").over(through) - F.col("n")).alias("offset"))
    placed = full.withColumn("start", start).join(offsets, ["src", "bucket"])
    placed = placed.withColumn("end", F.col("start") + F.col("size"))
    cut = F.explode(F.expr(f"sequence(start div {block}, (end - 1) div {block})"))
    each = placed.select("*", cut.alias("b"))
    low = F.greatest(F.col("b") * block, F.col("start"))
    high = F.least((F.col("b") + 1) * block, F.col("end"))
    packed = each.select(
        "row_id", "src", (F.col("offset") + F.col("b")).alias("block_no"), (high - low).alias("words"), (low - F.col("start")).alias("first_word")
    )
    return packed, per_bucket.groupBy("src").agg(F.sum("n").alias("blocks"))


def draws(sources: DataFrame, seed: int, shard: int = SHARD) -> DataFrame:
    """(shard, src, from_slot, slots): how many blocks of a source an output shard takes.

    A shard's counts are a multinomial draw: each of its slots draws a source with the chance of
    its target. Slots beyond a source's own number fall, and a last round settles what is missing,
    so that the totals are the targets to within a block.
    """
    total = sources.agg(F.sum("slots").alias("t"), F.count("*").alias("n")).first()
    slots, cells = total["t"] or 0, max(LEAST_CELLS, 4 * (total["n"] or 0))
    spark = sources.sparkSession
    shards = math.ceil(slots / shard)
    # chances as intervals, found by the cell a draw falls in
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    high = F.sum("slots").over(upto)
    bounds = sources.where("slots > 0").select("src", (high - F.col("slots")).alias("low"), high.alias("high"))
    cell = lambda x: f"cast(floor(({x}) * {float(cells)}D / {float(max(1, slots))}D) as bigint)"
    lookup = bounds.select("*", F.explode(F.expr(f"sequence({cell('low')}, {cell('high - 1')})")).alias("cell"))
    drawn = spark.range(shards).select(F.col("id").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(shard - 1))).alias("i"))
    drawn = drawn.withColumn("u", F.expr(f"pmod(xxhash64({seed}L, shard, i), {max(1, slots)}L)")).withColumn("cell", F.expr(cell("u")))
    hit = drawn.join(lookup, "cell").where("u >= low AND u < high")
    counts = hit.groupBy("shard", "src").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumn("from_slot", F.sum("n").over(so_far) - F.col("n"))
    own = sources.select("src", F.col("slots").alias("all_slots"))
    counts = counts.join(own, "src")
    kept = counts.select("shard", "src", "from_slot", F.least("n", F.col("all_slots") - F.col("from_slot")).alias("slots")).where("slots > 0")
    given = kept.groupBy("src").agg(F.sum("slots").alias("given"))
    rest = own.join(given, "src", "left").withColumn("given", F.coalesce("given", F.lit(0)))
    rest = rest.select(F.lit(shards).cast("bigint").alias("shard"), "src", F.col("given").alias("from_slot"), (F.col("all_slots") - F.col("given")).alias("slots"))
    return kept.union(rest.where("slots > 0"))


def permuted(x: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0 .. n-1, another for each key.

    Each round turns all numbers by a keyed amount and mixes those below the largest power of two
    in n by steps that can be undone, so no round maps two numbers to one.
    """
    bits = F.floor(F.log2(n.cast("double") + 0.5)).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
    left, right = (lambda v, s, f=f: F.call_function(f, v, s) for f in ("shiftleft", "shiftright"))
    steps = F.array(
        *(
            F.struct(
                F.pmod(F.xxhash64(key, F.lit(2 * r)), n).alias("turn"),
                F.xxhash64(key, F.lit(2 * r + 1)).bitwiseAND(mask).alias("salt"),
                F.lit(1 + 2 * (r % 4)).alias("up"),
                F.greatest(F.lit(1), (bits / (2 + r % 2)).cast("int")).alias("down"),
                n.alias("n"),
                mask.alias("mask"),
            )
            for r in range(rounds)
        )
    )

    def step(x: Column, at: Column) -> Column:
        turned = (x + at["turn"]) % at["n"]
        salted = turned.bitwiseXOR(at["salt"])
        added = (salted + left(salted, at["up"]).bitwiseAND(at["mask"])).bitwiseAND(at["mask"])
        return F.when(turned <= at["mask"], added.bitwiseXOR(right(added, at["down"]))).otherwise(turned)

    return F.aggregate(steps, x, step)


class Mix(NamedTuple):
    rows: DataFrame  # row_id, doc_id, src, size
    sources: DataFrame  # src, rank, source_size, target, blocks, slots
    plan: DataFrame  # shard, src, slot, pass, block_no: one row for each block of the output
    pieces: DataFrame  # row_id, src, block_no, words, first_word: what a block consists of


def mix(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 1, block: int = BLOCK, shard: int = SHARD
) -> Mix:
    """The mix as blocks. A source's slots go through its blocks in a pseudorandom order, another in each pass.

    A null text has size 0, a null source is a source of its own, last in order; a document
    without words is in no block; repeated rows count each; an empty table gives empty results.
    All randomness is hashed from the seed and doc_id, so reruns agree.
    """
    rows = sizes(docs)
    packed, blocks = pieces(rows, block)
    packed = stage(packed, "pieces")
    wanted = targets(rows, weights, share, most).join(stage(blocks, "blocks"), "src", "left")
    n = F.coalesce("blocks", F.lit(0))
    slots = F.when(n > 0, F.least(F.floor(n * most), F.round(F.col("target") * n / F.col("source_size")))).otherwise(0)
    sources = stage(wanted.withColumn("blocks", n).withColumn("slots", slots.cast("bigint")), "sources")
    counts = draws(sources, seed, shard)
    # a few rows become many: dealt out by the work they will make, not by their own bytes
    tasks = max(1, math.ceil((sources.agg(F.sum("slots")).first()[0] or 0) / TASK))
    each = counts.repartition(tasks, "src", "shard").select("shard", "src", F.explode(F.expr("sequence(from_slot, from_slot + slots - 1)")).alias("slot"))
    each = each.join(sources.select("src", "blocks"), "src")
    turn = F.expr("slot div blocks").alias("pass")
    key = F.xxhash64(F.lit(seed), "src", "pass")
    plan = each.select("*", turn).select("shard", "src", "slot", "pass", permuted(F.expr("slot % blocks"), F.col("blocks"), key).alias("block_no"))
    return Mix(rows, sources, plan, packed)


def taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per row of ``docs``."""
    rows, sources, plan, packed = mix(docs, **options)
    times = plan.groupBy("src", "block_no").agg(F.count("*").alias("times"))
    words = packed.join(times, ["src", "block_no"]).groupBy("row_id").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = rows.join(sources.select("src", "source_size", "target"), "src").join(words, "row_id", "left")
    source = F.when(F.col("src").startswith("0"), F.expr("substring(src, 2)")).alias("source")
    return out.select("row_id", "doc_id", source, "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs``, all columns, with each document as often as the mix takes its words.

    Blocks cut documents, so a document counts as its taken words over its size; the fraction is
    rounded up or down by a hash of doc_id, so that a source's words still come near its target.
    Repeated rows share what they take. Documents without words are not in the mix.
    """
    keys = ("doc_id", "source", "size")
    share = F.sum("taken") / (F.count("*") * F.col("size"))
    times = taken(docs, **options).where("size > 0").groupBy(*keys).agg(share.alias("times"))
    size = F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("source").alias("src"), size.alias("words"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("src").eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    part = F.pmod(F.xxhash64("id", F.lit("times")), F.lit(1 << 20)) / float(1 << 20)
    copies = F.floor(F.col("times") + part).cast("int")
    found = rows.join(times, same).withColumn("copies", copies).where("copies > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def query(spark, sf_dir):
    return taken(table(spark, sf_dir, "documents")).drop("row_id", "source")
