"""The log of changes gives the states that whole rewrites give, and moves no row of the base."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedmark import model as m
from feedmark.operators import difference as d
from feedmark.session import stage
from feedmark.sources import state_log as sl

OBSERVED = ("source string, canonical_key string, type string, value string, family string, "
            "kev struct<vendorProject:string, product:string, dueDate:string, knownRansomwareCampaignUse:string>, "
            "last_seen timestamp, confidence int, ingested_at timestamp")  # fmt: skip


def observed(spark, day, keys):
    """Rows of one run: (source, key, family)."""
    at = datetime(2024, 1, 1) + timedelta(days=day)
    rows = [(s, k, m.DOMAIN, f"{k}.example", f, None, at - timedelta(hours=n % 3), 50, at) for n, (s, k, f) in enumerate(keys)]
    return spark.createDataFrame(rows, OBSERVED)


def gated(spark, day, rows, marks, status=m.OK):
    at = datetime(2024, 1, 1) + timedelta(days=day)
    runs = spark.createDataFrame([("a", m.OK, 200, None, at), ("b", status, 200, None, at)],
                                 "source string, status string, http_code int, declared_window string, attempt_time timestamp")
    return d.publication_gate(runs, marks, d.observed_counts(rows)), F.lit(at).cast("timestamp")


def as_set(df):
    return {tuple(map(str, r)) for r in df.select(*d.STATE_COLUMNS).collect()}


@pytest.fixture
def marks(spark):
    return spark.createDataFrame([("a", datetime(2023, 12, 31)), ("b", datetime(2023, 12, 31))], "source string, watermark timestamp")


def test_runs_compaction_and_expiry(spark, tmp_path, marks):
    rng = random.Random(1)
    log = sl.StateLog(spark, str(tmp_path / "log"), buckets=4)
    assert log.load().outcome == "absent"
    empty = observed(spark, 0, []).select(
        "source", "canonical_key", "type", "value", "family", "kev", "last_seen", "ingested_at",
        F.lit("").alias("status"), F.lit(None).cast("timestamp").alias("fallen_since"))
    rows = observed(spark, 0, [(s, f"k{n}", f"f{n % 3}") for s in "ab" for n in range(40)])
    gate, start = gated(spark, 0, rows, marks)
    state = stage(d.rebuild_state(d.compare(rows, empty), gate, m.MODE_BASELINE, start), "state")
    log.begin("r0", 0, state, marks, datetime(2024, 1, 1))
    versions = {0: as_set(state)}
    for run in range(1, 7):
        day = run * 9
        keys = [(s, f"k{rng.randrange(60)}", rng.choice(["f1", "f2", None])) for s in "ab" for _ in range(8)]
        rows = observed(spark, day, keys)
        gate, start = gated(spark, day, rows, marks, m.PARTIAL if run == 3 else m.OK)
        state = stage(d.rebuild_state(d.compare(rows, state), gate, m.MODE_DIFFERENTIAL, start), "state")
        compared = sl.compare(rows, log.load())
        changed = sl.changes(compared, gate, m.MODE_DIFFERENTIAL, start)
        members = {tuple(r) for r in changed.where("member is not null").select("source", "canonical_key", "member").collect()}
        plain = d.diff_members(d.compare(rows, log.load().indicators), gate)
        assert members == {tuple(r) for r in plain.select("source", "canonical_key", "member").collect()}
        assert log.commit(f"r{run}", run, changed, marks, datetime(2024, 1, 1)) == (run if run < 5 else run - 4)
        versions[run] = as_set(state)
        assert as_set(log.load().indicators) == versions[run]
        if run == 4:
            assert log.compact() and as_set(log.load().indicators) == versions[4]
    for run, rows in versions.items():
        assert as_set(log.load(before=run + 1).indicators) == rows, run
    # a rerun replaces its own changes only
    assert log.commit("r6", 6, changed, marks, datetime(2024, 1, 1)) == 2
    assert as_set(log.load().indicators) == versions[6]
    log.compact()
    removed = log.expire(keep=3)
    assert any("base-0-" in f for f in removed)
    assert as_set(log.load().indicators) == versions[6] and as_set(log.load(before=6).indicators) == versions[5]
    # another reader of the same folders, in whose session nothing is declared
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("feedmark_")]:
        spark.sql(f"DROP TABLE {name}")
    assert as_set(sl.StateLog(spark, str(tmp_path / "log")).load().indicators) == versions[6]


@pytest.mark.parametrize("partitions", [8, 200])
def test_the_base_is_neither_shuffled_nor_sorted(spark, tmp_path, marks, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = sl.StateLog(spark, str(tmp_path / "log"), buckets=32)
        keys = spark.range(20_000).select(
            F.lit("a").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("canonical_key"), F.lit(m.DOMAIN).alias("type"),
            F.col("id").cast("string").alias("value"), F.lit("f").alias("family"), F.lit(None).cast(d_kev()).alias("kev"),
            F.lit(datetime(2024, 1, 1)).alias("last_seen"), F.lit(datetime(2024, 1, 1)).alias("ingested_at"),
            F.lit(m.PRESENT).alias("status"), F.lit(None).cast("timestamp").alias("fallen_since"))
        log.begin("r0", 0, keys, marks, datetime(2024, 1, 1))
        rows = observed(spark, 1, [("a", f"k{n}", "f") for n in range(50)])
        gate, start = gated(spark, 1, rows, marks)
        changed = sl.changes(sl.compare(rows, log.load()), gate, m.MODE_DIFFERENTIAL, start)
        plan = changed._jdf.queryExecution().executedPlan().toString()
        side = plan[plan.index("SortMergeJoin") :].splitlines()
        scan = next(n for n, line in enumerate(side) if "FileScan" in line and "feedmark_" in line)
        above = [line for line in side[1 : scan + 1] if line.index(line.lstrip(" :+-")) <= side[scan].index("FileScan")]
        assert not [line for line in above if "Exchange" in line or "Sort " in line], plan
        # rows written follow the changes: the run is the whole feed here, so all but the seen ones fall
        assert log.commit("r1", 1, changed, marks, datetime(2024, 1, 1)) == 1
        few = rows.limit(3)
        partial = sl.changes(sl.compare(few, log.load()), gated(spark, 2, few, marks, m.OK)[0].withColumn("fallen_published", F.lit(False)), m.MODE_DIFFERENTIAL, start)
        assert partial.where("differs").count() <= 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def d_kev():
    return "struct<vendorProject:string, product:string, dueDate:string, knownRansomwareCampaignUse:string>"
