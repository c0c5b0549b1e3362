"""Feed-snapshot analytics on Spark.

Recurring feeds come in as raw records; out go observations with deterministic identities, a
quality verdict per feed run, per-source snapshot differences against a retained state, exact
name resolution that abstains when ambiguous, and report tables with explicit denominators.

Layout
------
``functions``   column expressions (no jobs of their own)
``sources``     scans and sinks: feed documents, catalogue, rules, state, dumps, marts
``operators``   the jobs: normalise, quality, difference, resolve, enrich, aggregate, rank
``plans``       whole pipelines, plus the registered queries over the supplied tables
``streaming``   the same difference job through Structured Streaming
"""

__version__ = "0.1.0"
