"""How the words of the sources of a language differ: pair by pair, and term by term against the language."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedmark.llm.common import table
from feedmark.llm.tokens import slices
from feedmark.operators.lookup import is_small
from feedmark.session import stage

LEAST_DOCUMENTS = 3  # of a language that hold a term, for it to be kept
SCALE = 1_000_000_000
RANKS = 200  # terms reported for each group
GROUP_BLOCK = 64  # groups, and terms, of a block on average: they bound a cell of the cube
TERM_BLOCK = 4096
SALTS = 32
COUNTS = "lang string, source string, term string, occurrences bigint, documents bigint"

LETTERS = np.ones(256, dtype=bool)
LETTERS[:0x41] = LETTERS[0x5B:0x61] = LETTERS[0x7B:0x80] = False


def _terms(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Each term of each text in order, A-Z lower-cased, and the row it stands in. Bytes beyond ASCII are
    letters, so terms are whole characters."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])  # offsets from 0
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[: len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[: bounds[-1]] if data is not None else np.empty(0, np.uint8)
    held = LETTERS[raw]
    begins = held.copy()
    begins[1:] &= ~held[:-1]
    firsts = bounds[:-1][bounds[:-1] < len(raw)]
    begins[firsts] = held[firsts]
    starts = np.flatnonzero(begins)
    before = np.cumsum(held, dtype=np.int64)
    offsets = np.append(before[starts] - 1, before[-1] if len(before) else 0)
    letters = raw[held]
    letters[(letters >= 0x41) & (letters <= 0x5A)] += 0x20
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters.tobytes()))
    return terms.dictionary_encode(), np.searchsorted(bounds, starts, side="right") - 1


def _count(batches):
    """lang, source, term: occurrences and documents, summed over a few megabytes of texts."""
    for batch in batches:
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        pairs = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        texts = batch.column("text")
        for start, stop in slices(texts):
            coded, row = _terms(texts.slice(start, stop - start))
            code, many = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            group = pairs[start:stop]
            keys, occurrences = np.unique(group[row] * many + code, return_counts=True)
            each = np.unique(row * many + code)  # a row holds it
            documents = np.unique(group[each // many] * many + each % many, return_counts=True)[1] if len(each) else each
            pair, code = (keys // many, keys % many) if many else (keys, keys)
            made = [
                lang.dictionary.take(pa.array(pair // max(len(source.dictionary), 1))),
                source.dictionary.take(pa.array(pair % max(len(source.dictionary), 1))),
                coded.dictionary.take(pa.array(code)).cast(pa.string()),
                pa.array(occurrences, pa.int64()),
                pa.array(documents, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(made, names=["lang", "source", "term", "occurrences", "documents"])


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), in whole numbers of any size."""
    above = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", above, (total + terms).cast("decimal(20,0)")) + 1


def _joined(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A lookup within the bound is sent to all tasks; a larger one is left to a join that splits hot keys."""
    return facts.join(F.broadcast(lookup) if is_small(lookup) else lookup, on, how)


def _block(of: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(of), F.col(blocks)).cast("int")


def _vocabulary(counts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, term, term_block, place in it, q) of the kept terms, and (lang, terms, term_blocks)."""
    kept = counts.groupBy("lang", "term").agg(F.sum("occurrences").alias("total"), F.sum("documents").alias("documents"))
    kept = stage(kept.where(F.col("documents") >= least).drop("documents"), "terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("words"))
    langs = stage(langs.withColumn("term_blocks", F.ceil(F.col("terms") / TERM_BLOCK).cast("int")), "langs")
    blocks = _joined(kept, langs, ["lang"]).withColumn("term_block", _block("term", "term_blocks"))
    place = F.row_number().over(Window.partitionBy("lang", "term_block").orderBy("term")) - 1
    q = _share(F.col("total"), F.col("words"), F.col("terms"))
    return stage(blocks.select("lang", "term", "term_block", place.alias("place"), q.alias("q")), "vocabulary"), langs


def _groups(docs: DataFrame, kept: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, words, terms, blocks, and the group's block and member in it); every group that occurs has a row."""
    words = kept.groupBy("lang", "source").agg(F.sum("occurrences").alias("words"))
    found = docs.select("lang", "source").distinct().join(words, ["lang", "source"], "left")
    found = _joined(found, langs.drop("words"), ["lang"], "left").na.fill(0, ["words", "terms"]).na.fill(1, ["term_blocks"])
    found = stage(found, "groups")
    many = found.groupBy("lang").agg(F.ceil(F.count("*") / GROUP_BLOCK).cast("int").alias("group_blocks"))
    found = _joined(found, many, ["lang"]).withColumn("group_block", _block("source", "group_blocks"))
    member = F.row_number().over(Window.partitionBy("lang", "group_block").orderBy("source")) - 1
    return stage(found.withColumn("member", member), "group-blocks")


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


class Slice:
    """The shares of a block of groups over a block of terms: ``least`` where a group lacks a term."""

    def __init__(self, row: pa.Table):
        members = sorted((m["member"], m["source"], m["least"]) for m in row.column("members")[0].as_py())
        self.sources = [m[1] for m in members]
        self.least = np.array([m[2] for m in members], dtype=np.int64)
        held = row.column("entries")[0].values
        member, place, p = (held.field(c).to_numpy().astype(np.int64) for c in ("member", "place", "p"))
        order = np.argsort(member, kind="stable")
        self.place, self.p = place[order], p[order]
        self.bounds = np.searchsorted(member[order], np.arange(len(members) + 1))
        self.width = row.column("width")[0].as_py()

    def summed(self, values: np.ndarray) -> np.ndarray:
        """Of entries, for each member. Sums past 64 bits come right again in the difference."""
        upto = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return upto[self.bounds[1:]] - upto[self.bounds[:-1]]


def partial(left: Slice, right: Slice) -> np.ndarray:
    """Divergence of each member of ``left`` from each of ``right`` over the terms of the block.

    Only what a group holds is gone through: terms that the right one holds, terms that only the
    left one holds (by distinct share), and as many times one value as neither holds.
    """
    out = np.zeros((len(left.sources), len(right.sources)), dtype=np.int64)
    base = np.repeat(right.least, np.diff(right.bounds))
    sizes = np.diff(right.bounds)
    for i, least in enumerate(left.least):
        own = slice(left.bounds[i], left.bounds[i + 1])
        row = np.full(left.width, least, dtype=np.int64)
        row[left.place[own]] = left.p[own]
        holds = np.zeros(left.width, dtype=bool)
        holds[left.place[own]] = True
        p, both = row[right.place], holds[right.place]
        shares, times = np.unique(left.p[own], return_counts=True)
        alone = times @ divergence(shares[:, None], right.least[None, :]) - right.summed(np.where(both, divergence(p, base), 0))
        neither = left.width - sizes - len(left.p[own]) + right.summed(both)
        out[i] = right.summed(divergence(p, right.p)) + alone + neither * divergence(least, right.least)
    return out


def _cell(left: pa.Table, right: pa.Table) -> pa.Table:
    """One cell of the cube: two blocks of groups over one block of terms, in both directions."""
    if not left.num_rows or not right.num_rows:  # a block that no group falls into
        return pa.table({c: pa.array([], k) for c, k in (("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64()))})
    lang = left.column("lang")[0].as_py()
    same = left.column("group_block")[0] == right.column("group_block")[0]
    a = Slice(left)
    b = a if same else Slice(right)
    made = []
    for x, y in ((a, b),) if same else ((a, b), (b, a)):
        value = partial(x, y).ravel()
        source = np.repeat(np.arange(len(x.sources)), len(y.sources))
        item = np.tile(np.arange(len(y.sources)), len(x.sources))
        other = source != item if same else np.ones(len(value), dtype=bool)
        names = [pa.array(s.sources, pa.string()).take(pa.array(n[other])) for s, n in ((x, source), (y, item))]
        made.append(pa.table([pa.array([lang] * int(other.sum()), pa.string()), *names, pa.array(value[other], pa.int64())], ["lang", "source", "item", "value"]))
    return pa.concat_tables(made)


def _pairs(groups: DataFrame, shares: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of sources of a language.

    A cube of (group block, group block, term block): each task of a cell gets the two slices of shares
    it needs, which are sent to every cell of their row or column, and the cells' parts are added along the terms.
    A slice holds some 64 groups over some 4096 terms, whatever a group's or a language's size.
    """
    block = ["lang", "group_block", "term_block"]
    entries = shares.groupBy(*block).agg(F.collect_list(F.struct("member", "place", "p")).alias("entries"))
    width = vocabulary.groupBy("lang", "term_block").agg(F.count("*").cast("int").alias("width"))
    least = _share(F.lit(0).cast("bigint"), F.col("words"), F.greatest("terms", F.lit(1)))
    members = groups.groupBy("lang", "group_block", "group_blocks", "term_blocks").agg(
        F.collect_list(F.struct("member", "source", least.alias("least"))).alias("members")
    )
    members = members.withColumn("term_block", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)))
    cut = members.join(entries, block, "left").join(width, ["lang", "term_block"], "left").na.fill(0, ["width"])
    none = F.array().cast("array<struct<member: int, place: int, p: bigint>>")
    cut = stage(cut.withColumn("entries", F.coalesce("entries", none)).drop("term_blocks"), "slices")
    columns = ["lang", "group_block", "term_block", "members", "entries", "width"]
    rows = cut.select(*columns, F.explode(F.sequence("group_block", F.col("group_blocks") - 1)).alias("other"))
    across = cut.select(*columns, F.explode(F.sequence(F.lit(0), F.col("group_block"))).alias("other"))
    cells = rows.groupBy("lang", "term_block", "group_block", "other").cogroup(across.groupBy("lang", "term_block", "other", "group_block"))
    parts = cells.applyInArrow(_cell, "lang string, source string, item string, value bigint")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, *more: str) -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source", *more).orderBy(F.desc("value"), "item"))


def divergences(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) of ``docs``.

    Part ``pair``: how far the group's term shares are from those of each other source of the language.
    Part ``term``: the ``ranks`` terms that the group uses most beyond the language's share. Shares are
    smoothed and scaled to whole numbers, all arithmetic is exact. Terms in fewer than ``least`` documents of
    a language don't count there; a language without terms has pairs of value 0. Null text, lang and source are
    empty texts; repeated rows count each; other columns are ignored, and an empty table gives no rows. Texts
    are counted where they lie; what moves is a row for each group and term.
    """
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = docs.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term")
    counts = stage(counts.agg(F.sum("occurrences").alias("occurrences"), F.sum("documents").alias("documents")), "counts")
    vocabulary, langs = _vocabulary(counts, least)
    kept = stage(_joined(counts.drop("documents"), vocabulary, ["lang", "term"]), "kept")
    groups = _groups(docs, kept, langs)
    p = _share(F.col("occurrences"), F.col("words"), F.col("terms"))
    shares = _joined(kept, groups, ["lang", "source"]).withColumn("p", p)

    surplus = F.col("p") - F.col("q")
    terms = shares.where(surplus > 0).select("lang", "source", F.col("term").alias("item"), F.call_function("div", surplus * surplus, F.col("q")).alias("value"))
    salted = terms.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALTS)))
    terms = salted.withColumn("rank", _ranked(salted, "salt")).where(F.col("rank") <= ranks).drop("salt", "rank")
    terms = terms.withColumn("rank", _ranked(terms)).where(F.col("rank") <= ranks).withColumn("part", F.lit("term"))
    pairs = _pairs(groups, shares, vocabulary)
    pairs = pairs.withColumn("rank", _ranked(pairs)).withColumn("part", F.lit("pair"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


def query(spark, sf_dir):
    return divergences(table(spark, sf_dir, "documents"))


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
tokens AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT t.lang, t.source, t.term, count(*)::HUGEINT AS n
  FROM tokens t JOIN kept k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL
),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(t.n, 0) + l.v) AS p,
         1 + 1000000000::HUGEINT * (k.n + 1) // (l.n + l.v) AS q
  FROM groups g JOIN langs l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
