"""A Merkle manifest of a dataset: trees of digests, a proof for each row, and what proofs verify."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmark.llm.common import table
from feedmark.operators.lookup import is_small
from feedmark.session import stage

BLOCK = 8  # levels of a tree that one block spans, from 256 digests up
WIDTH = 64  # characters of a digest
PATH = "array<struct<right: boolean, sibling: string>>"
INDEX_BITS = 33  # of monotonically_increasing_id, below those of the partition


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """The value after its length in bytes, so that no two lists of fields read alike; a null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    return digest(*map(field, columns))


def folded(node: Column, path: Column) -> Column:
    """The root that a digest and the siblings on its path give."""

    def up(below: Column, step: Column) -> Column:
        return F.when(step["right"], digest(step["sibling"], below)).otherwise(digest(below, step["sibling"]))

    return F.aggregate(path, node, up)


def proof(path: Column) -> Column:
    """One digest over the siblings on a path, from the leaf upwards."""
    return F.sha2(F.array_join(F.transform(path, lambda step: step["sibling"]), ""), 256)


def _nodes(level: Column, at: Column, count: int = 1) -> Column:
    """``count`` digests of a level's string from place ``at``; fewer, or none, at its end."""
    return F.substring(level, (at * WIDTH + 1).cast("int"), F.lit(count * WIDTH))


def _parents(level: Column) -> Column:
    """The string of the level above: each two digests, or the last one alone, hashed as they stand."""
    pairs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / (2 * WIDTH)).cast("int"))
    return F.array_join(F.transform(pairs, lambda at: F.sha2(_nodes(level, at * 2, 2), 256)), "").cast("binary")


def _path(levels: Column, at: Column) -> Column:
    """From place ``at`` of a block's lowest level to its top: the side it stands on, and its sibling."""

    def step(below: Column) -> Column:
        node = F.call_function("shiftright", at, below)
        right = node % 2 == 1
        flank = _nodes(F.element_at(levels, below + 1), node + F.when(right, -1).otherwise(1))
        return F.struct(right.alias("right"), flank.cast("string").alias("sibling"))

    steps = F.when(F.size(levels) > 1, F.sequence(F.lit(0), F.size(levels) - 2))
    return F.coalesce(F.transform(steps, step), F.array().cast(PATH))


def _attached(facts: DataFrame, lookup: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``facts`` with the columns of ``lookup``, which has one row for each key; nulls are keys like others.
    A lookup within the bound is sent to all tasks; a larger one is left to a join that splits hot keys."""
    same = [facts[a].eqNullSafe(lookup[b]) for a, b in pairs]
    return facts.join(F.broadcast(lookup) if is_small(lookup) else lookup, same, "left").drop(*(b for _, b in pairs))


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with place (from 0) in their tree and count of its leaves.

    Rows are dealt by range of (tree, order), so a tree of any size spreads over tasks, and their place
    in the task is kept; what is added up is a number for each tree and task. Rows that ``order`` does
    not tell apart are dealt by an arbitrary number.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [tree, *order, "arbitrary"]
    dealt = rows.withColumn("arbitrary", F.monotonically_increasing_id()).repartitionByRange(partitions, *keys)
    dealt = dealt.sortWithinPartitions(*keys).drop("arbitrary").withColumn("at", F.monotonically_increasing_id())
    dealt = stage(dealt.withColumn("part", F.shiftright("at", INDEX_BITS)), "leaves")
    runs = dealt.groupBy("part", tree).agg(F.min("at").alias("first"), F.count("*").alias("run"))
    same = Window.partitionBy(tree)
    before = F.sum("run").over(same.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("run")
    runs = stage(runs.withColumn("before", before).withColumn("count", F.sum("run").over(same)), "runs")
    runs = runs.select(F.col("part").alias("its_part"), F.col(tree).alias("its_tree"), "first", "before", "count")
    joined = _attached(dealt, runs, [("part", "its_part"), (tree, "its_tree")])
    return joined.withColumn("place", F.col("before") + F.col("at") - F.col("first")).select(*rows.columns, "place", "count")


def _height(count: Column) -> Column:
    """Levels above the leaves."""
    return F.when(count > 1, F.length(F.bin(count - 1))).otherwise(0)


def _tier(nodes: DataFrame, tree: str, low: int) -> DataFrame:
    """The blocks of the tier from level ``low``: tree, block, count, entries in order, and levels, a string
    for each level up to the block's top or the root of the tree."""
    rest = [c for c in nodes.columns if c not in (tree, "count", "place")]
    grouped = nodes.groupBy(tree, F.shiftright("place", BLOCK).alias("block"), "count")
    blocks = grouped.agg(F.array_sort(F.collect_list(F.struct("place", *rest))).alias("entries"))
    blocks = blocks.withColumn("lowest", F.array_join(F.transform("entries", lambda x: x["node"]), "").cast("binary"))
    rise = F.least(F.lit(BLOCK), _height(F.col("count")) - low)
    above = F.when(rise > 0, F.sequence(F.lit(1), rise)).otherwise(F.array().cast("array<int>"))
    levels = F.aggregate(above, F.array("lowest"), lambda done, _: F.concat(done, F.array(_parents(F.element_at(done, -1)))))
    return stage(blocks.select(tree, "block", "count", "entries", levels.alias("levels")), f"tier-{low}")


def _entries(blocks: DataFrame, tree: str) -> DataFrame:
    """A row for each entry of each block, its path up to the block's top and on from there."""
    on = [c for c in blocks.columns if c not in ("entries", "levels", "above")]
    with_paths = F.transform("entries", lambda x, at: F.struct(x.alias("entry"), _path(F.col("levels"), at).alias("path")))
    each = blocks.select(*on, "above", F.explode(with_paths).alias("one"))
    return each.select(*(c for c in on if c not in ("block", "count")), "one.entry.*", F.concat("one.path", "above").alias("path"))


def forest(rows: DataFrame, tree: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Trees over the column ``node``, digests, one for each value of the column ``tree``, leaves in ``order``.

    Gives the blocks of the leaves, with the path from each block's top to the root (above), and
    (tree, node) of the roots. Blocks of 256 aligned leaves keep each level as one string of hexadecimal digits:
    substrings of fixed width hash the parents, and the flanking substring is a node's sibling. The tops of
    the blocks are the leaves of the next tier until each tree has one; a tier is one pass over a 256th of the
    digests below it. A block is bounded whatever the trees' sizes, and a node without a sibling is hashed alone.
    """
    leaves = placed(rows, tree, order).drop(*(c for c in order if c.startswith("order_")))
    tiers, low, most = [], 0, None
    while most is None or most > 1 << low:
        blocks = _tier(leaves if not tiers else tops, tree, low)
        tiers.append(blocks)
        most = most if most is not None else blocks.agg(F.max("count")).first()[0] or 0
        low += BLOCK
        top = F.element_at("levels", -1).cast("string")
        ended = _height(F.col("count")) <= low
        tops = blocks.where(~ended).select(tree, F.col("block").alias("place"), "count", top.alias("node"))
        done = blocks.where(ended & (F.col("block") == 0)).where(F.lit(low == BLOCK) | (_height(F.col("count")) > low - BLOCK))
        done = done.select(tree, top.alias("node"))
        roots = done if low == BLOCK else roots.unionByName(done)
    blocks = tiers.pop().withColumn("above", F.array().cast(PATH))
    while tiers:
        up = stage(_entries(blocks, tree).select(F.col(tree).alias("its_tree"), F.col("place").alias("its_block"), "path"), "paths")
        below = _attached(tiers.pop(), up, [(tree, "its_tree"), ("block", "its_block")])
        blocks = below.withColumn("above", F.coalesce("path", F.array().cast(PATH))).drop("path")
    return blocks, roots


def manifest(rows: DataFrame, tree: str, order: list[str], node: str = "leaf") -> DataFrame:
    """``rows`` (which hold the column ``node``, a digest in hexadecimal) with subroot, root and path.

    Rows with equal ``tree`` (null is a value like others) form a tree, in ``order`` (nulls first) and, among
    equals, by digest; identical rows share their places in any order. The trees' roots, in the
    order of ``tree``, form the tree whose root stands for the dataset. path: for each level up to
    root, whether the node is a right one, and its sibling ('' where it is hashed alone). Columns of the same
    names as these three are replaced, others pass through; an empty table gives no rows.
    """
    held = [c for c in rows.columns if c not in (node, "subroot", "root", "path")]
    keys = [F.col(c).alias(f"order_{n}") for n, c in enumerate(order)]
    inner = rows.select(F.col(tree).alias("tree"), *keys, F.col(node).alias("node"), F.struct(F.lit(0), *held).alias("held"))
    blocks, roots = forest(inner, "tree", [*(f"order_{n}" for n in range(len(order))), "node"])
    roots = stage(roots.select(F.lit(0).alias("dataset"), "tree", "node"), "subroots")
    upper, top = forest(roots, "dataset", ["tree", "node"])
    ends = _attached(_entries(upper, "dataset"), stage(top.select(F.col("dataset").alias("one"), F.col("node").alias("root")), "root"), [("dataset", "one")])
    ends = stage(ends.select(F.col("tree").alias("its_tree"), F.col("node").alias("subroot"), "root", F.col("path").alias("rest")), "subpaths")
    found = _attached(blocks, ends, [("tree", "its_tree")])
    each = _entries(found.withColumn("above", F.concat("above", "rest")).drop("rest"), "tree")
    return each.select(*(F.col("held")[c].alias(c) for c in held), F.col("node").alias(node), "subroot", "root", "path")


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, tampered: the digest of each row of documents, and where 7 divides the checksum
    of doc_id, of the row with 1 added to n_chars (null elsewhere). Texts are read once and stay where they are."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [columns[3] + 1 if n == 3 else c for n, c in enumerate(columns)]
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return docs.select("doc_id", "lang", leaf(*columns).alias("leaf"), F.when(hit, leaf(*changed)).alias("tampered"))


def audit(docs: DataFrame) -> DataFrame:
    """One row per row of documents: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A tree for each lang, leaves by doc_id. Each leaf, or what tampering made of it, is folded with the
    siblings of its path; where that is not the root, verified is false. Null fields are dashes in the leaf, a
    null n_chars stays null, rows with a null doc_id come first and are not tampered with, other columns are ignored.
    """
    found = manifest(leaves(docs), "lang", ["doc_id"])
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    found = found.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), root.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"))


_FIELDS = " || ".join(
    f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "{n_chars}", "text")
)
_BITS = "list_reduce(range(8), lambda c, j: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), {start})"
_CRC = "xor(list_reduce(list_transform(split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda a, b: {bits}, 4294967295::BIGINT), 4294967295)"

SQL = f"""
WITH RECURSIVE
leaves AS (
  SELECT doc_id, lang, sha256({_FIELDS.format(n_chars='n_chars')}) AS leaf,
         CASE WHEN {_CRC.format(bits=_BITS.format(start='xor(a, b)'))} % 7 = 0
              THEN sha256({_FIELDS.format(n_chars='(n_chars + 1)')}) END AS tampered
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
),
levels AS (
  SELECT lang, 0 AS level, place, n, leaf AS node FROM placed
  UNION ALL
  SELECT lang, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
  FROM levels WHERE n > 1 GROUP BY lang, level, n, place // 2
),
sub AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM levels WHERE n = 1
),
upper AS (
  SELECT 0 AS level, place, n, subroot AS node FROM sub
  UNION ALL
  SELECT level + 1, place // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
  FROM upper WHERE n > 1 GROUP BY level, n, place // 2
),
up1 AS (
  SELECT doc_id, lang, leaf, place AS at, coalesce(tampered, leaf) AS node, 0 AS level, place, n, '' AS siblings FROM placed
  UNION ALL
  SELECT u.doc_id, u.lang, u.leaf, u.at,
         sha256(CASE WHEN u.place % 2 = 1 THEN s.node || u.node ELSE u.node || coalesce(s.node, '') END),
         u.level + 1, u.place // 2, (u.n + 1) // 2, u.siblings || coalesce(s.node, '')
  FROM up1 u LEFT JOIN levels s ON s.lang IS NOT DISTINCT FROM u.lang AND s.level = u.level AND s.place = xor(u.place, 1)
  WHERE u.n > 1
),
up2 AS (
  SELECT u.doc_id, u.lang, u.leaf, u.at, sub.subroot, u.node, 0 AS level, sub.place, sub.n, u.siblings
  FROM up1 u JOIN sub ON sub.lang IS NOT DISTINCT FROM u.lang WHERE u.n = 1
  UNION ALL
  SELECT u.doc_id, u.lang, u.leaf, u.at, u.subroot,
         sha256(CASE WHEN u.place % 2 = 1 THEN s.node || u.node ELSE u.node || coalesce(s.node, '') END),
         u.level + 1, u.place // 2, (u.n + 1) // 2, u.siblings || coalesce(s.node, '')
  FROM up2 u LEFT JOIN upper s ON s.level = u.level AND s.place = xor(u.place, 1)
  WHERE u.n > 1
)
SELECT doc_id, leaf, subroot, upper.node AS root, sha256(siblings) AS proof_sha256, up2.node AS folded_root,
       up2.node = upper.node AS verified
FROM up2 JOIN upper ON upper.n = 1 WHERE up2.n = 1
"""
