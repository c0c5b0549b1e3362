"""Jaccard join of documents by word n-grams: a blocked sparse product of documents by n-grams."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from feedmark.llm.common import components, numbered, table, whole_text
from feedmark.llm.tokens import slices
from feedmark.session import stage

SHINGLE, PERCENT = 5, 80
KEYS = 64  # of a document with many n-grams: from so many to twice as many
SMALL_RUN, RUN = 2, 4  # neighbours in hash order that a key is made of
BLOCK = 256  # documents on either side of a product, at most
BLOCK_GRAMS = 1 << 20  # their n-grams, about
NO_ID = 2**63 - 1
COLUMNS = 1 << 14  # n-grams in one piece of a product
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits of each distinct word's BLAKE2b digest."""
    from hashlib import blake2b

    return np.frombuffer(b"".join(blake2b(w, digest_size=8).digest() for w in words.to_pylist()), dtype="<u8")


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each distinct n-gram of each text, rows ascending and hashes ascending within.

    A-Z become lower case, words are runs without ASCII white space. A text of fewer words than
    ``size`` has its whole sequence as its only n-gram, one without words has none.
    """
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    if not len(texts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    raw = np.where((raw >= 0x41) & (raw <= 0x5A), raw + 0x20, raw)
    blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    first = ~blank
    begins = np.zeros(len(raw) + 1, dtype=bool)
    begins[bounds] = True
    first[1:] &= blank[:-1] | begins[1:-1]
    last = ~blank
    last[:-1] &= blank[1:] | begins[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    places = np.stack([starts, ends], axis=1).ravel()
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), max(0, len(places) - 1), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(raw.tobytes())]) if len(places) else None
    if spans is None:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    coded = spans.take(pa.array(np.arange(0, len(places) - 1, 2))).dictionary_encode()
    words = _word_hashes(coded.dictionary)[coded.indices.to_numpy()]
    row = np.searchsorted(bounds, starts, side="right") - 1
    counts = np.bincount(row, minlength=len(texts))
    firsts = np.cumsum(counts) - counts
    total = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for i in range(size):
        total = _mixed(total * _ODD + words[i : i + len(total)] + np.uint64(1))
    inside = np.flatnonzero(row[: len(total)] == row[size - 1 : size - 1 + len(total)]) if len(total) else np.empty(0, np.int64)
    rows, grams = row[inside], total[inside]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        value = np.zeros(len(short), dtype=np.uint64)
        for i in range(size - 1):
            has = counts[short] > i
            value[has] = _mixed(value[has] * _ODD + words[firsts[short[has]] + i] + np.uint64(1))
        rows, grams = np.concatenate([rows, short]), np.concatenate([grams, _mixed(value + np.uint64(size))])
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    fresh = np.ones(len(rows), dtype=bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    return rows[fresh], grams[fresh]


def longest_run(union: int, percent: int) -> int:
    """So many neighbours of a sorted union, at least, are common to two sets at the threshold.

    Of u elements at least percent * u / 100 are common; the others cut them into runs.
    """
    others = union - -(-percent * union // 100)
    return -(-(union - others) // (others + 1))


def small_limit(percent: int) -> int:
    """The largest union, at which sets differ, that does not surely share a run of RUN."""
    differs = [u for u in range(2, 4096) if u > -(-percent * u // 100)]
    return max((u for u in differs if longest_run(u, percent) < RUN), default=0)


def _keys(grams: np.ndarray, small: int, percent: int) -> np.ndarray:
    """Keys of one sorted set, so that two sets at the threshold share one.

    A key is a run of neighbours in the order of the hashes. Two sets that differ by few elements
    share long runs, two that only share a passage hardly any. All runs are keys of sets of up to
    2 * KEYS n-grams; of larger ones those whose mixed hash has so many zero bits that KEYS or more
    are left, which a pair at the threshold shares by percent ** RUN of them.
    """
    n, out = len(grams), []
    if n <= small:
        runs = min(n, SMALL_RUN)
        out.append(_run(grams, runs))
    if n >= small * percent // 100 and n >= RUN:
        keys = _run(grams, RUN)
        bits = max(0, int(math.log2(n / KEYS))) if n > KEYS else 0
        out.append(keys[(keys & np.uint64((1 << bits) - 1)) == 0])
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _run(grams: np.ndarray, size: int) -> np.ndarray:
    total = np.full(max(0, len(grams) - size + 1), size, dtype=np.uint64)
    for i in range(size):
        total = _mixed(total * _ODD + grams[i : i + len(total)])
    return total


def signatures(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """row_id, doc_id, text_hash, n_shingles, high, low (a 128-bit digest of the set), keys."""
    small = small_limit(percent)

    def run(batches):
        for batch in batches:
            for start, stop in slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                rows, grams = shingle_sets(part.column("text"), size)
                at = np.searchsorted(rows, np.arange(part.num_rows + 1))
                counts = np.diff(at)
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(_mixed(grams ^ np.uint64(s)), dtype=np.uint64)]) for s in (1, 2)]
                digests = [(s[at[1:]] - s[at[:-1]]).astype(np.int64) for s in sums]
                keys = [_keys(grams[a:b], small, percent).astype(np.int64) for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names[:3]), pa.array(counts, pa.int64()), *(pa.array(d) for d in digests), pa.array(keys, pa.list_(pa.int64()))],
                    names=names,
                )

    schema = "row_id bigint, doc_id bigint, text_hash bigint, n_shingles bigint, high bigint, low bigint, keys array<bigint>"
    names = [part.split()[0] for part in schema.split(", ")]
    return numbered(_whole(docs)).select("row_id", "doc_id", "text_hash", "text").mapInArrow(run, schema)


def _whole(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64(whole_text()).alias("text_hash"), whole_text().alias("text"))


def _product(size: int, percent: int):
    """Links between two blocks of documents, as edges of a forest.

    The overlap counts of all pairs of the two blocks are summed over pieces of the n-grams that
    two or more documents hold. A pair stays while what it has and what either side still has in
    later pieces can meet the bound that the two sizes set; when no pair is left the rest is skipped.
    """

    def run(key, group):
        left, right = key[1], key[2]
        group = group.drop_duplicates("rep")  # repeated rows
        texts = pa.array(group.text, pa.large_string())
        rows, grams = shingle_sets(texts, size)
        sizes = np.bincount(rows, minlength=len(group)).astype(np.int64)
        nodes = group.rep.to_numpy()
        side = group.block.to_numpy()
        a, b = np.flatnonzero(side == left), np.flatnonzero(side == right)
        least = -(-percent * (sizes[a][:, None] + sizes[b][None]) // (100 + percent))  # overlap that meets the threshold
        open_ = (np.minimum(sizes[a][:, None], sizes[b][None]) >= least) & (nodes[a][:, None] != nodes[b][None])
        if left == right:
            open_ &= nodes[a][:, None] < nodes[b][None]
        names, place, held = np.unique(grams, return_inverse=True, return_counts=True)
        common = held > 1
        rows, place = rows[common[place]], (np.cumsum(common) - 1)[place[common[place]]]
        count = np.zeros(open_.shape, dtype=np.int64)
        spare = np.bincount(rows, minlength=len(group)).astype(np.int64)
        open_ &= np.minimum(spare[a][:, None], spare[b][None]) >= least
        order = np.argsort(place, kind="stable")
        rows, place = rows[order], place[order]
        for low in range(0, int(common.sum()), COLUMNS):
            if not open_.any():
                break
            i, j = np.searchsorted(place, [low, low + COLUMNS])
            matrix = np.zeros((len(group), min(COLUMNS, int(common.sum()) - low)), dtype=np.float32)
            matrix[rows[i:j], place[i:j] - low] = 1
            spare -= np.bincount(rows[i:j], minlength=len(group))
            count += (matrix[a] @ matrix[b].T).astype(np.int64)
            open_ &= count + np.minimum(spare[a][:, None], spare[b][None]) >= least
        i, j = np.nonzero(open_ & (count >= least))
        return _forest(nodes, a[i], b[j])

    return run


def _forest(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Each linked node with the smallest node that the links reach."""
    order = np.argsort(nodes, kind="stable")
    rank = np.empty(len(nodes), dtype=np.int64)
    rank[order] = np.arange(len(nodes))
    a, b, root = rank[a], rank[b], np.arange(len(nodes))
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return pd.DataFrame({"node": nodes[order][moved], "root": nodes[order][root[moved]]})


def _clusters(rows: DataFrame, member: DataFrame) -> DataFrame:
    """(rep, cluster) of sets that share keys with others; each set names the smallest of each of its keys."""
    reps = rows.join(member.where("row_id = rep").select("row_id"), "row_id", "left_semi")
    keyed = reps.select(F.col("row_id").alias("rep"), F.explode("keys").alias("key"))
    firsts = keyed.groupBy("key").agg(F.min("rep").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first")
    near = components(keyed.join(firsts, "key").where("rep != first").select("rep", "first"), "clusters")
    return near.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))


def _placed(clusters: DataFrame, member: DataFrame, percent: int) -> DataFrame:
    """(rep, cluster, left, right, block): which documents meet in which products.

    A cluster is cut by size into bands, as only equal or neighbouring bands can link, and bands
    into blocks of a bounded number of documents and n-grams.
    """
    sized = clusters.join(member.where("row_id = rep").select("rep", "n_shingles"), "rep")
    sized = sized.withColumn("band", F.floor(F.log("n_shingles") / math.log(100 / percent)).cast("int"))
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_GRAMS))
    bands = stage(sized.groupBy("cluster", "band").agg(blocks.alias("blocks")), "bands")
    name = lambda band, nth: F.concat_ws(".", F.col(band).cast("string"), F.col(nth).cast("string"))
    of = F.explode(F.expr("sequence(0L, blocks - 1)"))
    each = bands.select("cluster", "band", of.alias("nth"))
    own = each.select("cluster", F.col("band").alias("b"), F.col("nth").alias("i"), F.explode(F.array("band", F.col("band") - 1)).alias("band"))
    pairs = own.join(each, ["cluster", "band"]).where("band != b OR nth <= i")
    pairs = pairs.select("cluster", name("b", "i").alias("left"), name("band", "nth").alias("right"))
    sides = pairs.select("*", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))
    nth = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    at = sized.join(bands, ["cluster", "band"]).withColumn("nth", nth)
    placed = at.select("rep", "cluster", name("band", "nth").alias("block")).join(sides, ["cluster", "block"])
    met = placed.groupBy("cluster", "left", "right").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return placed.join(met, ["cluster", "left", "right"], "left_semi")


def similar(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """row_id, doc_id, text_hash, n_shingles, component_id, kept: one row per row of ``docs`` (doc_id, text; others are ignored).

    Two documents link when 100 * common n-grams >= percent * all n-grams of both. Equal sets are
    folded, sets that share a key come into a cluster, and products of blocks of a cluster's
    documents find the links. Neither clusters nor products give pairs, only edges of forests.

    A null or empty text has no n-grams and links with nothing, nor with another such. component_id
    is the smallest doc_id reached; a null doc_id gives its name to a component only if all are
    null. Of a component the row with that doc_id is kept, of repeated rows exactly one. An empty
    table gives no rows. N-grams are told apart by 64-bit hashes.
    """
    docs = docs.select("doc_id", "text")
    rows = stage(signatures(docs, size, percent), "signatures")
    identity = ["n_shingles", "high", "low"]
    full = rows.where("n_shingles > 0").select("row_id", "doc_id", "text_hash", *identity)
    sets = full.groupBy(*identity).agg(F.min("row_id").alias("rep"))
    member = stage(full.join(sets, identity).drop("high", "low"), "set-members")
    clusters = stage(_clusters(rows, member), "clusters")
    placed = _placed(clusters, member, percent)
    where = member.where("row_id = rep").select("rep", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    placed = placed.join(where, "rep")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    met = _whole(docs).join(placed, same).select("cluster", "left", "right", "block", "rep", "text")
    forest = met.groupBy("cluster", "left", "right").applyInPandas(_product(size, percent), "node bigint, root bigint")
    links = components(stage(forest, "forest"), "links")

    member = member.join(links.withColumnRenamed("node", "rep"), "rep", "left")
    member = member.withColumn("component", F.coalesce("component", "rep"))
    each = member.groupBy("component", "doc_id").agg(F.min("row_id").alias("first"))
    names = each.groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.min_by("first", F.coalesce("doc_id", F.lit(NO_ID))).alias("first")
    )
    kept = (F.col("row_id") == F.col("first")).alias("kept")
    columns = ["row_id", "doc_id", "text_hash", "n_shingles", "component_id", "kept"]
    found = member.join(names, "component").select(*columns[:-1], kept)
    empty = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id")).withColumn("kept", F.lit(True))
    return found.union(empty.select(*columns))


def drop_similar(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs``, all columns, with one document of each component; documents without words stay."""
    # the same columns for join and window, so that the texts move once
    same = ["id", "no_id", "hash"]
    key = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id")]
    kept = similar(docs, size, percent).where("kept").select(*key, F.col("text_hash").alias("hash"), "n_shingles")
    kept = kept.groupBy(*same).agg(F.max("n_shingles").alias("n"))
    rows = docs.select(F.struct("*").alias("row"), *key, F.xxhash64(whole_text()).alias("hash"))
    found = rows.join(kept, same)
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("hash"))
    return found.withColumn("nth", nth).where("nth = 1 OR n = 0").select("row.*")


def query(spark, sf_dir):
    return similar(table(spark, sf_dir, "documents"), 3, 90).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
g AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] END) AS s FROM d
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))
),
reach(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.a, r.seen FROM reach r JOIN links l ON l.b = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.low AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(seen) AS low FROM reach GROUP BY doc_id) r USING (doc_id)
"""
