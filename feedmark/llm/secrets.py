"""Secret scans over a trigram index: candidates from postings, then verification by pattern."""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from feedmark.llm.common import table, whole_text
from feedmark.session import stage

MOST_STRINGS = 64  # alternatives followed at once while a pattern is read


def any_case(pattern: str) -> str:
    """The pattern with each ASCII letter in both cases; for parts without classes or escapes."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isascii() and c.isalpha() else c for c in pattern)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` of a match has ``least`` characters or more, else the match falls."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# The base rules, then further ones that only add spans.
BASE = (
    Rule("assign", "(" + any_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24,}", 24),  # runs are maximal either way, and short ones need no match
)
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("hub_token", "gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """What a match must contain, in lower case: all of these clauses, of each one alternative, of that all trigrams.

    No clause: the pattern has no mandatory trigram.
    """
    clauses: list[list[frozenset[str]]] = []

    def close(strings: set[str]) -> None:
        if strings and all(len(s) >= 3 for s in strings):
            clauses.append(sorted({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}, key=sorted))

    def letters(items) -> set[str] | None:
        found: set[str] = set()
        for op, what in items:
            if op is sre.LITERAL:
                found.add(chr(what).lower())
            elif op is sre.RANGE and what[1] - what[0] < 8:
                found |= {chr(c).lower() for c in range(what[0], what[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None

    def strings_of(items) -> set[str] | None:
        """All strings the items match, if they are few."""
        whole = {""}
        for op, what in items:
            if op is sre.LITERAL:
                part = {chr(what).lower()}
            elif op is sre.IN:
                part = letters(what)
            elif op is sre.SUBPATTERN:
                part = strings_of(what[3])
            elif op is sre.BRANCH:
                each = [strings_of(x) for x in what[1]]
                part = None if None in each else set().union(*each)
            elif op is sre.MAX_REPEAT and what[:2] == (0, 1):
                inner = strings_of(what[2])
                part = None if inner is None else inner | {""}
            elif op is sre.MAX_REPEAT and what[0] == what[1] and what[0] <= 8:
                inner = strings_of(what[2])
                part = None if inner is None else {"".join(x) for x in product(inner, repeat=what[0])}
            else:
                part = None
            if part is None or len(whole) * len(part) > MOST_STRINGS:
                return None
            whole = {a + b for a, b in product(whole, part)}
        return whole

    current = {""}
    for item in parser.parse(pattern):
        part = strings_of([item])
        if part is None or len(current) * len(part) > MOST_STRINGS or "" in part:
            close(current)
            current = {""}
        if part is not None and "" not in part:
            current = {a + b for a, b in product(current, part)}
    close(current)
    return clauses


def postings(docs: DataFrame, rules=BASE + MORE) -> DataFrame:
    """(gram, key): which documents hold which of the rules' trigrams, letters in lower case."""
    grams = sorted({g for r in rules for clause in trigram_query(r.pattern) for alt in clause for g in alt})
    if not grams:
        return docs.sparkSession.createDataFrame([], "gram string, key bigint")
    # lower() may fold more than A-Z, which only adds candidates
    lowered = docs.select(_key().alias("key"), F.lower(whole_text()).alias("text"))
    held = F.array_compact(F.array(*(F.when(F.contains("text", F.lit(g)), F.lit(g)) for g in grams)))
    return lowered.select("key", F.explode(held).alias("gram")).select("gram", "key").distinct()


def candidates(index: DataFrame, rules=BASE + MORE) -> DataFrame:
    """(key, rules): a bit for each rule whose trigram query the document's postings satisfy."""
    terms = [
        (n, c, a, gram, len(alt), len(clauses))
        for n, rule in enumerate(rules)
        for clauses in [trigram_query(rule.pattern)]
        for c, clause in enumerate(clauses)
        for a, alt in enumerate(clause)
        for gram in sorted(alt)
    ]
    schema = "rule int, clause int, alt int, gram string, grams int, clauses int"
    asked = F.broadcast(index.sparkSession.createDataFrame(terms, schema))  # one row for each trigram of a rule
    alternatives = index.join(asked, "gram").groupBy("key", "rule", "clause", "alt", "grams", "clauses").count()
    met = alternatives.where("count = grams").groupBy("key", "rule", "clauses").agg(F.countDistinct("clause").alias("met"))
    return met.where("met = clauses").groupBy("key").agg(F.bit_or(F.expr("shiftleft(1, rule)")).alias("rules"))


def scan(docs: DataFrame, rules=BASE + MORE) -> DataFrame:
    """doc_id and spans, an array of (start, kind, end), kind by its place among ``rules``.

    One row per row of ``docs`` (doc_id, text; other columns are ignored). Offsets count code
    points, the end is exclusive. Per kind the matches are leftmost and do not overlap; those too
    short fall. A null or empty text has no spans; repeated and null doc_ids share candidates and
    are verified row by row; an empty table gives no rows. Rules without a mandatory trigram scan
    every text. The postings are written to the shared folder.
    """
    always = sum(1 << n for n, rule in enumerate(rules) if not trigram_query(rule.pattern))
    found = candidates(stage(postings(docs, rules), "postings"), rules)
    held = docs.select("doc_id", whole_text().alias("text"), _key().alias("key")).join(found, "key", "left")
    held = held.withColumn("rules", F.coalesce("rules", F.lit(0)).bitwiseOR(F.lit(always)))
    kinds = [f"kind{n}" for n in range(len(rules))]
    for n, rule in enumerate(rules):
        wanted = F.col("rules").bitwiseAND(F.lit(1 << n)) != 0
        found = F.when(wanted, F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)))
        held = held.withColumn(f"found{n}", found)
    for n, rule in enumerate(rules):
        held = held.withColumn(kinds[n], F.when(F.size(f"found{n}") > 0, _spans(n, rule)).otherwise(F.expr(f"cast(array() as {SPANS})")))
    return held.select("doc_id", F.array_sort(F.concat(*kinds)).alias("spans"))


SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(n: int, rule: Rule) -> Column:
    """From the pieces between matches and the matches themselves follow the places."""
    pattern = F.lit(rule.pattern)
    found = F.col(f"found{n}")
    judged = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else found
    parts = F.arrays_zip(F.split("text", rule.pattern, -1).alias("gap"), found.alias("hit"), judged.alias("judged"))
    none = F.expr(f"cast(array() as {SPANS})")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.array(F.struct(start.alias("start"), F.lit(n).alias("kind"), end.alias("end")))
        more = F.when(F.length(x["judged"]) >= rule.least, span).otherwise(none)
        return F.struct(end.alias("at"), F.concat(state["out"], more).alias("out"))

    hits = F.slice(parts, F.lit(1), F.size(found))
    return F.aggregate(hits, F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"]


def _key() -> Column:
    return F.coalesce("doc_id", F.lit(-1))


def report(docs: DataFrame, base=BASE, more=MORE) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    rules = base + more
    names = F.array(*(F.lit(r.kind) for r in rules))
    said = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    spans = scan(docs, rules)
    of_base = F.filter("spans", lambda s: s["kind"] < len(base))
    counts = [_count(n).alias(f"n_{rule.kind}") for n, rule in enumerate(base)]
    return spans.select("doc_id", *counts, F.sha2(said(of_base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")


def query(spark, sf_dir):
    return report(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """Every rule over every text; the places again from pieces and matches."""
    parts, columns = [], []
    for n, rule in enumerate(BASE + MORE):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            f"SELECT r, {n} AS k, '{rule.kind}' AS kind, unnest(string_split_regex(t, '{pattern}')) AS gap,"
            f" unnest(regexp_extract_all(t, '{pattern}')) AS hit, unnest(regexp_extract_all(t, '{pattern}', {rule.group})) AS judged,"
            f" unnest(range(len(regexp_extract_all(t, '{pattern}')) + 1)) AS i, {rule.least} AS least FROM d WHERE regexp_matches(t, '{pattern}')"
        )
    for n, rule in enumerate(BASE):
        columns.append(f"count(k) FILTER (k = {n}) AS n_{rule.kind}")
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({" UNION ALL ".join(parts)}),
placed AS (SELECT *, sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY r, k ORDER BY i) AS stop FROM hits),
spans AS (SELECT r, k, stop - length(hit) AS start, kind || ':' || cast(stop - length(hit) AS BIGINT) || ':' || cast(stop AS BIGINT) AS said
          FROM placed WHERE hit IS NOT NULL AND length(judged) >= least)
SELECT d.doc_id, {", ".join(columns)},
       sha256(coalesce(string_agg(said, ',' ORDER BY start, k) FILTER (k < {len(BASE)}), '')) AS base_sha256,
       coalesce(string_agg(said, ',' ORDER BY start, k), '') AS spans
FROM d LEFT JOIN spans USING (r) GROUP BY r, doc_id
"""


SQL = _sql()
