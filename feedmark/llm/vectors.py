"""Near-duplicate vectors by product quantisation: inverted lists, table lookups, exact rerank."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from feedmark.llm.common import components, numbered, table
from feedmark.session import stage

COSINE = 0.9
SAMPLE = 16_384  # vectors that the codebooks are learned from at most
PER_LIST = 256  # vectors in a list, on average
MOST_LISTS = 1024
PARTS = 8  # subspaces
WORDS = 256  # code words of a subspace
RECALL = 0.998  # of the pairs of held-out vectors that one side's probes meet
HELD = 1024  # vectors compared exactly with all others to set the probes
ENOUGH, BINS = 500, 200
MEMBERS, QUERIES = 1024, 4096  # of a list in one task


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None] - 2 * x @ centres.T).argmin(axis=1)


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """k-means; a centre without vectors stays where it was."""
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(x, centres)
        sizes = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass
class Quantiser:
    """Coarse centres, code words of the residuals' parts, and how far beyond its own list a query probes.

    A vector lies on its own side of the plane half way between its list's centre and another one. Two vectors
    in different lists lie on the two sides of such a plane, so the nearer one to it is at most half
    their distance from it: with ``width`` half the distance at the threshold one of the two probes the other's list, surely.
    """

    dim: int
    centres: np.ndarray
    words: list[np.ndarray]
    width: float

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return np.array_split(x, len(self.words), axis=1)

    def beyond(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own list of each vector, and its distance from the plane towards each other list (0 for the own one)."""
        far = (self.centres**2).sum(axis=1)[None] - 2 * x @ self.centres.T
        own = far.argmin(axis=1)
        square = (self.centres**2).sum(axis=1)
        gaps = np.maximum(square[own][:, None] + square[None] - 2 * self.centres[own] @ self.centres.T, 1e-18)
        far -= far[np.arange(len(x)), own][:, None]
        return own, far / (2 * np.sqrt(gaps))

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Probed lists one after the other, each vector's own one first, and how many each has; codes of the
        residual; its distance from what the codes say."""
        lists, counts, codes, errors = [], [], [], []
        for low in range(0, len(x), 2048):
            part = x[low : low + 2048]
            own, beyond = self.beyond(part)
            beyond[np.arange(len(part)), own] = -1
            order = np.argsort(beyond, axis=1, kind="stable")
            many = (beyond <= self.width + 1e-9).sum(axis=1)
            lists.append(order[np.arange(order.shape[1])[None] < many[:, None]].astype(np.int32))
            counts.append(many)
            rest = part - self.centres[own]
            code = np.stack([_nearest(p, w) for p, w in zip(self.parts(rest), self.words)], axis=1).astype(np.uint8)
            told = np.concatenate([w[code[:, j]] for j, w in enumerate(self.words)], axis=1)
            codes.append(code)
            errors.append(np.linalg.norm(rest - told, axis=1))
        return tuple(np.concatenate(a) for a in (lists, counts, codes, errors))


def learn(x: np.ndarray, lists: int, cosine: float, seed: int = 1) -> Quantiser:
    """From unit vectors; probes as far as no pair can be missed."""
    rng = np.random.default_rng(seed)
    centres = _means(x, lists, rng)
    rest = x - centres[_nearest(x, centres)]
    words = [_means(p, WORDS, rng) for p in np.array_split(rest, min(PARTS, x.shape[1]), axis=1)]
    return Quantiser(x.shape[1], centres, words, math.sqrt(2 - 2 * cosine) / 2)


def _calibrated(reps: DataFrame, quantiser: Quantiser, held: np.ndarray, cosine: float, recall: float) -> float:
    """The width that finds ``recall`` of the pairs that the held-out vectors have with all vectors, compared exactly.

    One pass over all vectors; what comes back is a count for each of BINS widths. With fewer than
    ENOUGH pairs to go by, the width with which none is missed.
    """
    most = quantiser.width

    def run(batches):
        own, beyond = quantiser.beyond(held)
        for batch in batches:
            vectors = batch.column("embedding")
            some = np.flatnonzero(np.diff(vectors.offsets.to_numpy()) == quantiser.dim)
            if not len(some):
                continue
            x = unit(_matrix(batch.take(pa.array(some)).column("embedding"), quantiser.dim))
            for low in range(0, len(x), 1024):
                part = x[low : low + 1024]
                near = part @ held.T
                i, j = np.nonzero((near >= cosine) & (near < 1 - 1e-12))
                mine, others = quantiser.beyond(part)
                least = np.minimum(others[i, own[j]], beyond[j, mine[i]])
                bins = np.clip(np.ceil(least / most * BINS), 0, BINS).astype(np.int64)
                sizes = np.bincount(bins, minlength=BINS + 1)
                yield pa.RecordBatch.from_pydict({"bin": pa.array(np.flatnonzero(sizes)), "n": pa.array(sizes[sizes > 0].astype(np.int64))})

    counts = reps.select("embedding").mapInArrow(run, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).orderBy("bin").collect()
    total, seen = sum(r["n"] for r in counts), 0
    if total < ENOUGH:
        return most
    for r in counts:
        seen += r["n"]
        if seen >= recall * total:
            return most * min(r["bin"] + 1, BINS) / BINS
    return most


def usable(column: str = "embedding") -> Column:
    """Not null or empty, all components finite, not all zero."""
    v = F.col(column)
    fine = F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(arrays: pa.Array, dim: int) -> np.ndarray:
    return arrays.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _assigned(reps: DataFrame, quantiser: Quantiser) -> DataFrame:
    """Each distinct vector with its lists and codes; vectors of another length share a list by length, below 0."""
    schema = "rep bigint, copies bigint, embedding array<double>, probed array<int>, codes binary, error double"

    def run(batches):
        for batch in batches:
            vectors = batch.column("embedding")
            sizes = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(sizes):
                some = pa.array(np.flatnonzero(sizes == dim))
                rows = batch.take(some)
                raw = _matrix(rows.column("embedding"), dim)
                if dim == quantiser.dim:
                    probed, counts, codes, error = quantiser.assign(unit(raw))
                else:
                    probed, counts = np.full(len(raw), -dim, np.int32), np.ones(len(raw), np.int64)
                    codes, error = np.zeros((len(raw), 0), np.uint8), np.zeros(len(raw))
                yield pa.RecordBatch.from_pydict(
                    {
                        "rep": rows.column("rep"),
                        "copies": rows.column("copies"),
                        "embedding": rows.column("embedding"),
                        "probed": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(probed)),
                        "codes": pa.array([c.tobytes() for c in codes], pa.binary()),
                        "error": pa.array(error, pa.float64()),
                    }
                )

    return reps.select("rep", "copies", "embedding").mapInArrow(run, schema)


def _block(quantiser: Quantiser, cosine: float):
    """Links between a block of queries and a block of members of one list.

    A pair that both sides find is counted for each side where it queries, a pair that only one
    finds is counted for both here. Returns rep, links, and the smallest linked rep reached inside
    the block, so that a block gives rows by its vectors and not by its pairs.
    """
    reach = math.sqrt(2 - 2 * cosine)

    def run(key, group):
        here = key[0]
        q, m = group[group.role == 1], group[group.role == 0]
        if not len(q) or not len(m):
            return pd.DataFrame({"rep": [], "links": [], "root": []})
        x, y = unit(np.stack(q.embedding)), unit(np.stack(m.embedding))
        qrep, mrep = q.rep.to_numpy(), m.rep.to_numpy()
        qown = np.array([p[0] for p in q.probed])
        probes = np.zeros((len(m), max(len(quantiser.centres), 1)), dtype=bool)  # does a member probe a list
        for n, lists in enumerate(m.probed if here >= 0 else ()):
            probes[n, lists] = True
        qcopies, mcopies = q.copies.to_numpy(), m.copies.to_numpy()
        codes = np.stack([np.frombuffer(c, np.uint8) for c in m.codes])
        error = m.error.to_numpy() + reach + 1e-9
        found = []
        for low in range(0, len(x), 256):
            part = x[low : low + 256]
            if here >= 0:
                far = np.zeros((len(part), len(y)))
                for j, (p, w) in enumerate(zip(quantiser.parts(part - quantiser.centres[here]), quantiser.words)):
                    lookup = ((p[:, None, :] - w[None]) ** 2).sum(axis=2)
                    far += lookup[:, codes[:, j]]
                i, j = np.nonzero(np.sqrt(far) <= error[None])
            else:
                i, j = (a.ravel() for a in np.indices((len(part), len(y))))
            i += low
            near = qrep[i] != mrep[j]
            i, j = i[near], j[near]
            near = np.einsum("nd,nd->n", x[i], y[j]) >= cosine
            found.append((i[near], j[near]))
        i, j = (np.concatenate(a) for a in zip(*found))
        if not len(i):
            return pd.DataFrame({"rep": [], "links": [], "root": []})
        both = probes[j, qown[i]] if here >= 0 else np.ones(len(i), dtype=bool)
        nodes, place = np.unique(np.concatenate([qrep[i], mrep[j]]), return_inverse=True)
        a, b = place[: len(i)], place[len(i) :]
        links = np.bincount(a, mcopies[j], minlength=len(nodes)) + np.bincount(b, np.where(both, 0, qcopies[i]), minlength=len(nodes))
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pd.DataFrame({"rep": nodes, "links": links.astype(np.int64), "root": nodes[root]})

    return run


def near_vectors(
    embeddings: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, recall: float = RECALL, per_list: int = PER_LIST
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``embeddings`` (vec_id, embedding; other columns are ignored).

    Equal vectors are folded first; their copies count as linked to each other and to what one of
    them is linked to. Codebooks are learned from at most ``sample`` distinct vectors chosen by a
    hash; all vectors are indexed and all are queries. Lookups keep every vector within the
    threshold plus its own coding error, so only an unprobed list can hide a pair; found pairs are
    checked by the cosine in double precision. How far a query probes is set by the pairs that ``HELD`` vectors have
    with all others, so that ``recall`` of them are met; with ``recall`` above 1, or few pairs, so far that none can be missed. Vectors of another length than the most frequent one
    are compared among their own, all with all in blocks.

    Null, empty and zero vectors and those with null or non-finite components link with nothing. A
    null vec_id counts as a vector, but gives its name to a component only if all are null; repeated
    rows are copies. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    vector = F.transform("embedding", lambda x: x.cast("double")).alias("embedding")
    rows = stage(numbered(embeddings.select("vec_id", vector)).withColumn("usable", usable()), "vectors")
    groups = rows.where("usable").groupBy("embedding")
    reps = stage(groups.agg(F.min("row_id").alias("rep"), F.count("*").alias("copies"), F.min("vec_id").alias("least")), "distinct-vectors")
    n = reps.count()
    dims = reps.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    of_dim = reps.where(F.size("embedding") == dims["dim"]).orderBy(F.xxhash64("rep")).limit(sample)
    learned = unit(np.array([r[0] for r in of_dim.select("embedding").collect()]))  # ``sample`` rows at most
    quantiser = learn(learned, min(MOST_LISTS, math.ceil(n / per_list)), cosine)
    if recall <= 1:
        quantiser.width = _calibrated(reps, quantiser, learned[:HELD], cosine, recall)
    assigned = stage(_assigned(reps, quantiser), "assigned-vectors")

    own, probed = F.col("probed")[0], F.explode("probed").alias("list")
    members = assigned.groupBy(own.alias("list")).agg(F.ceil(F.count("*") / MEMBERS).alias("mblocks"))
    queries = assigned.select(probed).groupBy("list").agg(F.ceil(F.count("*") / QUERIES).alias("qblocks"))
    blocks = F.broadcast(members.join(queries, "list"))  # a row for each list, MOST_LISTS and one for each other length
    columns = ["rep", "copies", "embedding", "probed", "codes", "error"]
    nth = lambda count, salt: F.pmod(F.xxhash64("rep", F.lit(salt)), F.col(count)).cast("int")
    upto = lambda count: F.explode(F.sequence(F.lit(0), (F.col(count) - 1).cast("int")))
    as_member = assigned.select("*", own.alias("list")).join(blocks, "list").withColumn("mb", nth("mblocks", 0)).withColumn("qb", upto("qblocks"))
    as_query = assigned.select("*", probed).join(blocks, "list").withColumn("qb", nth("qblocks", 1)).withColumn("mb", upto("mblocks"))
    keys = ["list", "mb", "qb"]
    both = as_member.select(*keys, F.lit(0).alias("role"), *columns).union(as_query.select(*keys, F.lit(1).alias("role"), *columns))
    found = both.groupBy(*keys).applyInPandas(_block(quantiser, cosine), "rep bigint, links bigint, root bigint")
    found = stage(found, "vector-links")

    stars = components(found.where("rep != root").select("rep", "root"), "vector-stars")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = reps.select("embedding", "rep", "copies", "least").join(links, "rep", "left").join(stars.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(names, "component").select("embedding", "copies", "links", "component_id")
    fine = rows.where("usable").join(named, "embedding")
    fine = fine.select("vec_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = fine.union(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, [x / n for x in embedding] AS u
  FROM (SELECT vec_id, embedding::DOUBLE[] AS embedding, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings)
  WHERE n > 0 AND isfinite(n)
),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u) WHERE list_dot_product(a.u, b.u) >= 0.9),
reach(vec_id, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.a, r.seen FROM reach r JOIN links l ON l.b = r.vec_id)
SELECT e.vec_id, coalesce(n, 0) AS n_links, low AS component_id, e.vec_id = low AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = e.vec_id
JOIN (SELECT vec_id, min(seen) AS low FROM reach GROUP BY vec_id) r ON r.vec_id = e.vec_id
"""
