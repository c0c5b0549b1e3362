"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from feedmark.llm.common import table, whole_text
from feedmark.llm.tokens import slices, spread
from feedmark.session import stage

BUCKETS = 1 << 30  # of the term hash: so many that rare words do not fall on telling ones
TERMS = 4096  # telling alone that the machine may use
PAIRED = 2048  # terms, those that most sampled documents hold, whose pairs are looked at
SAMPLE = 20_000  # labelled documents it learns from at most
FACTORS = 8
STEM = 5  # letters; inflected words also count by their beginning
LEAST = 3  # sampled documents that hold a term, or it is not used: what fewer hold cannot be told from chance
STRENGTH = 2.0  # standard deviations between a term's toxic documents and chance, at least, to be telling alone
BEYOND = 8.0  # and between a pair's toxic documents and what its terms let expect; there are two million pairs, and copies among texts
APART = 0.2  # by so much the share of a pair's toxic documents differs from what is expected, at least
FOLDS = 5
SLICE = 4 << 20  # bytes of text looked at together
_WORDS = re.compile(r"\w+")


def term_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each distinct term of each text, rows ascending: words in lower case, and their stems."""
    lists = pc.utf8_split_whitespace(texts.cast(pa.large_string()))
    bounds = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    found = [_hashes(word) for word in coded.dictionary.to_pylist()]
    sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    pool = np.array([h for hashes in found for h in hashes], dtype=np.int64)
    index = coded.indices.to_numpy()
    rows = np.repeat(np.arange(len(texts)), np.diff(bounds))
    rows = np.repeat(rows, sizes[index])
    keys = rows * BUCKETS + pool[spread((np.cumsum(sizes) - sizes)[index], sizes[index])] if len(pool) else rows
    keys = np.sort(keys)
    keys = keys[np.diff(keys, prepend=-1) != 0]
    return keys // BUCKETS, keys % BUCKETS


def _hashes(word: str) -> list[int]:
    out = []
    for term in _WORDS.findall(word.lower()):
        out.append(zlib.crc32(term.encode()) % BUCKETS)
        if len(term) > STEM:
            out.append(zlib.crc32(b"^" + term[:STEM].encode()) % BUCKETS)
    return out


@dataclass
class Machine:
    """score = sigmoid(bias + sum of weights + sum over pairs of terms of the product of their factors)."""

    buckets: np.ndarray  # ascending
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, n: int, rows: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """For n rows, from (row, place of the term) pairs with rows ascending."""
        linear = np.bincount(rows, self.weights[terms], minlength=n)
        sums = np.zeros((n, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            sums[:, f] = np.bincount(rows, self.factors[terms, f], minlength=n)
        squares = np.bincount(rows, (self.factors**2).sum(axis=1)[terms], minlength=n)
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares)

    def gradients(self, rows: np.ndarray, terms: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Of the weighted log loss by weights, factors and bias, documents as for ``raw``."""
        raw = self.raw(len(labels), rows, terms)
        error = weight * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels)
        v = self.factors[terms]
        sums = np.zeros((len(labels), self.factors.shape[1]))
        np.add.at(sums, rows, v)
        by_factor = np.zeros_like(self.factors)
        np.add.at(by_factor, terms, error[rows][:, None] * (sums[rows] - v))
        return np.bincount(terms, error[rows], minlength=len(self.weights)), by_factor, error.sum()

    def known(self, rows: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.buckets, buckets), max(0, len(self.buckets) - 1))
        held = self.buckets[place] == buckets if len(self.buckets) else np.zeros(len(buckets), dtype=bool)
        return rows[held], place[held]

    def score(self, texts: pa.Array) -> np.ndarray:
        raw = self.raw(len(texts), *self.known(*term_sets(texts)))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def telling_pairs(labels: np.ndarray, starts: np.ndarray, terms: np.ndarray, width: int) -> np.ndarray:
    """Whether each of ``width`` terms belongs to a pair that is toxic more or less often than its terms let expect.

    Expected is anything between the two terms' shares, as of terms that always stand together, and their product over the
    share of all, as of independent ones. So a term that is neutral alone counts when it matters beside another one.
    """
    both, toxic = np.zeros((2, width, width), dtype=np.float32)
    for low in range(0, len(labels), 1024):
        some = np.arange(low, min(low + 1024, len(labels)))
        held = np.zeros((len(some), width), dtype=np.float32)
        held[members(starts, terms, some)] = 1
        both += held.T @ held
        bad = held[labels[some] == 1]
        toxic += bad.T @ bad
    share = labels.mean()
    of = np.diag(toxic) / np.maximum(np.diag(both), 1)
    found = np.zeros(width, dtype=bool)
    for i in range(width):
        product = np.clip(of[i] * of / share, share / 20, 1 - (1 - share) / 20)
        rate = toxic[i] / np.maximum(both[i], 1)
        expected = np.clip(rate, np.minimum(np.minimum(of[i], of), product), np.maximum(np.maximum(of[i], of), product))
        apart = (np.abs(rate - expected) >= APART) & (both[i] > 0)
        apart[i] = False
        gap = np.abs(rate - expected) * both[i] / np.sqrt(both[i] * expected * (1 - expected) + 1)
        found[i] = (gap[apart] >= BEYOND).any()
    return found


def fit(labels: np.ndarray, starts: np.ndarray, terms: np.ndarray, buckets: np.ndarray, strong: np.ndarray, common: np.ndarray) -> Machine:
    """The machine over the ``strong`` buckets and those of the ``common`` ones that tell in pairs.

    Document i holds the places ``terms[starts[i]:starts[i + 1]]`` of ``buckets``, which ascend.
    """
    chosen = np.isin(buckets, strong)
    if 0 < labels.sum() < len(labels):
        places = np.searchsorted(buckets, common)
        chosen[places[telling_pairs(labels, *_only(starts, terms, places, len(buckets)), len(places))]] = True
    places = np.flatnonzero(chosen)
    return learn(labels, *_only(starts, terms, places, len(buckets)), buckets[places])


def _only(starts: np.ndarray, terms: np.ndarray, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents with the terms at ``places`` alone, which get the numbers 0, 1, ..."""
    number = np.full(width, -1, dtype=np.int32)
    number[places] = np.arange(len(places))
    new = number[terms]
    before = np.concatenate([[0], np.cumsum(new >= 0)])
    return before[starts], new[new >= 0]


def learn(labels: np.ndarray, starts: np.ndarray, terms: np.ndarray, buckets: np.ndarray, epochs: int = 30, rate: float = 0.2, decay: float = 1e-5, seed: int = 1) -> Machine:
    """Weights and factors for ``buckets`` by steps that shrink with the gradients each has seen; documents as for ``fit``."""
    n, positive = len(labels), float(labels.sum())
    share = min(max(positive / max(n, 1), 1e-6), 1 - 1e-6)
    rng = np.random.default_rng(seed)
    machine = Machine(buckets, float(np.log(share / (1 - share))), np.zeros(len(buckets)), rng.normal(0, 0.01, (len(buckets), FACTORS)))
    if not 0 < positive < n:
        return Machine(buckets[:0], machine.bias, np.zeros(0), np.zeros((0, FACTORS)))
    balance = np.where(labels == 1, min(10.0, (n - positive) / positive) ** 0.5, 1.0)
    memory = [np.full_like(machine.weights, 1e-8), np.full_like(machine.factors, 1e-8), 1e-8]
    for _ in range(epochs):
        order = rng.permutation(n)
        for low in range(0, n, 256):
            some = order[low : low + 256]
            held, of = members(starts, terms, some)
            gw, gv, gb = machine.gradients(held, of, labels[some], balance[some] / len(some))
            gw, gv = gw + decay * machine.weights, gv + decay * machine.factors
            for i, g in enumerate((gw, gv, gb)):
                memory[i] = memory[i] + g * g
            machine.weights -= rate * gw / np.sqrt(memory[0])
            machine.factors -= rate / 5 * gv / np.sqrt(memory[1])
            machine.bias -= rate * gb / np.sqrt(memory[2])
    return machine


def members(starts: np.ndarray, terms: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) of each term that a few documents hold."""
    sizes = starts[some + 1] - starts[some]
    return np.repeat(np.arange(len(some)), sizes), terms[spread(starts[some], sizes)]


def held_out(doc_id: str = "doc_id") -> Column:
    rest = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(rest == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Learns from at most ``sample`` labelled documents outside the held-out fold, chosen by a hash of doc_id.

    Terms are counted in Spark; the driver gets the numbers of at most TERMS + PAIRED of them for each sampled document.
    Rows without a label or doc_id are not used, a document's several labels count as its largest, its rows one each;
    empty texts hold no term, further columns are not looked at. Long texts are gone through in whole, a slice at a time.
    """
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # so many narrow rows at most
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.select("doc_id", (F.col("label") > 0).alias("label"), "text")
    sets = stage(rows.mapInArrow(_sets, "doc_id bigint, label boolean, terms binary"), "terms")
    counts = sets.mapInArrow(_counts, "bucket bigint, held bigint, toxic bigint").groupBy("bucket")
    counts = stage(counts.agg(F.sum("held").alias("held"), F.sum("toxic").alias("toxic")).where(F.col("held") >= LEAST), "counts")
    n, positive = sets.agg(F.count("*"), F.count_if("label")).first()
    expected = F.col("held") * (positive / max(n, 1))
    strength = F.abs(F.col("toxic") - expected) / F.sqrt(expected * (1 - positive / max(n, 1)) + 1)
    strong = counts.where(strength >= STRENGTH).orderBy(strength.desc(), "bucket").limit(TERMS)
    common = counts.orderBy(F.desc("held"), "bucket").limit(PAIRED)
    strong, common = (np.sort([r.bucket for r in some.select("bucket").collect()]).astype(np.int64) for some in (strong, common))
    buckets = np.union1d(strong, common)

    def places(batches):
        for batch in batches:
            held = (np.frombuffer(terms, dtype="<i4") for terms in batch.column("terms").to_pylist())
            known = [np.searchsorted(buckets, b[np.isin(b, buckets)]).astype("<u2").tobytes() for b in held]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(known, pa.binary())], names=batch.schema.names)

    found = sets.mapInArrow(places, sets.schema).toPandas().sort_values(["doc_id", "terms"], kind="stable")
    starts = np.concatenate([[0], np.cumsum(found.terms.str.len().to_numpy(dtype=np.int64) // 2)])
    terms = np.frombuffer(b"".join(found.terms), dtype="<u2")
    return fit(found.label.to_numpy(dtype=float), starts, terms, buckets, strong, common)


def _sets(batches):
    """A document's distinct terms, ascending."""
    for batch in batches:
        for start, stop in slices(batch.column("text"), SLICE):
            part = batch.slice(start, stop - start)
            rows, buckets = term_sets(part.column("text"))
            at = np.searchsorted(rows, np.arange(part.num_rows + 1))
            sets = pa.array([buckets[a:b].astype("<i4").tobytes() for a, b in zip(at, at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), sets], names=["doc_id", "label", "terms"])


def _counts(batches):
    """Documents, and toxic ones, that hold each term, added up for a batch."""
    for batch in batches:
        sets = [np.frombuffer(terms, dtype="<i4") for terms in batch.column("terms").to_pylist()]
        toxic = np.repeat(batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64), [len(s) for s in sets])
        names, of, held = np.unique(np.concatenate(sets or [np.empty(0, dtype="<i4")]), return_inverse=True, return_counts=True)
        columns = [names.astype(np.int64), held.astype(np.int64), np.bincount(of, toxic, minlength=len(names)).astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "held", "toxic"])


def score(machine: Machine) -> Column:
    """The score of the whole text of a row; only texts go to the workers, and numbers come back."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        parts = [machine.score(texts.slice(start, stop - start)) for start, stop in slices(texts, SLICE)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    return run(whole_text())


def predictions(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``.

    A null text counts as empty; an empty one gets the score of a document without known terms. A
    null doc_id is not held out. Repeated rows are scored one by one, alike; further columns, also ones named like the
    result's, are not looked at; a long text is scored whole. Without labels of both kinds every score is the share of the toxic.
    """
    out = docs.select("doc_id", held_out().alias("held_out"), score(machine).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs``, all columns, without the documents predicted toxic."""
    return docs.where(score(machine) < 0.5)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return predictions(docs, train(docs, table(spark, sf_dir, "labels")))
