import os
import time
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from feedmark import model as m
from feedmark.operators import enrich as e, lookup
from feedmark.plans import workloads
from feedmark.session import scratch, stage
from feedmark.sources import tables
from feedmark.streaming import snapshots as st
from test_difference import NOW, OBSERVED, held, seen


def test_state_versions(spark, tmp_path):
    store = tables.StateTables(spark, str(tmp_path / "state"))
    assert store.load().outcome == "absent"
    marks = spark.createDataFrame([("a", NOW)], "source string, watermark timestamp")
    store.commit("r1", 1, held(spark, ("a", "k1", m.PRESENT, None)), marks.limit(0), NOW)
    assert store.load().outcome == "no_watermark"
    store.commit("r2", 2, held(spark, ("a", "k2", m.FALLEN, NOW)), marks, NOW)
    loaded = store.load()
    assert loaded.outcome == "ok" and loaded.baseline_instant == NOW
    assert [(r["canonical_key"], r["status"]) for r in loaded.indicators.collect()] == [("k2", m.FALLEN)]
    # The same run again replaces itself; an earlier version stays readable.
    store.commit("r2", 2, held(spark, ("a", "k3", m.PRESENT, None)), marks, NOW)
    assert [r["canonical_key"] for r in store.load().indicators.collect()] == ["k3"]
    assert [r["canonical_key"] for r in store.load(before=2).indicators.collect()] == ["k1"]
    newer = spark.createDataFrame([(9, "r9", 99, NOW)], "sequence long, run_id string, format int, baseline_instant timestamp")
    newer.write.mode("append").partitionBy("sequence").parquet(f"{store.root}/commits")
    assert store.load().outcome == "illegible"


def test_only_a_missing_folder_is_an_absent_state(spark, tmp_path):
    store = tables.StateTables(spark, str(tmp_path / "state"))
    (tmp_path / "state" / "commits").mkdir(parents=True)
    assert store.load().outcome == "illegible"
    (tmp_path / "state" / "commits" / "part-0.parquet").write_bytes(b"PAR1 no parquet")
    assert store.load().outcome == "illegible"


def test_enriched_dump_leaves_broken_rows_out(spark, tmp_path):
    good = spark.createDataFrame([("threatfox", None, 1), ("cisa-kev", m.PRODUCT_UNSPECIFIC, 0)], "source string, reason string, n_techniques long")
    assert tables.write_enriched(good, str(tmp_path / "ok")) == {}
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 2
    # A full dump holds today's sources only, without the rows that break the invariant.
    left_out = tables.write_enriched(good.withColumn("n_techniques", F.lit(0)), str(tmp_path / "ok"))
    assert left_out == {"gap_without_reason": 1}
    assert [r["source"] for r in spark.read.parquet(str(tmp_path / "ok")).collect()] == ["cisa-kev"]
    with pytest.raises(TypeError):
        tables.write_enriched(good.drop("reason"), str(tmp_path / "no"))
    assert not (tmp_path / "no").exists()


def test_a_dump_in_parts_is_the_whole_dump(spark, tmp_path, monkeypatch):
    rows = spark.range(50).select(
        F.when(F.col("id") != 7, F.col("id").cast("string")).alias("id"), F.lit("threatfox").alias("source"),
        F.lit(None).cast("string").alias("reason"), (F.col("id") % 5).alias("n_techniques"))
    assert len(lookup.in_parts(rows, rows)) == 1
    monkeypatch.setattr(lookup, "is_small", lambda *_: False)
    parts = lookup.in_parts(rows, rows)
    assert len(parts) > 1 and all(part.count() < 50 for part in parts)
    assert tables.write_enriched(rows, str(tmp_path / "whole")) == {"gap_without_reason": 10}
    for _ in range(2):  # a dump again replaces all parts of the one before
        assert tables.write_enriched(parts, str(tmp_path / "parts")) == {"gap_without_reason": 10}
    read = lambda name: sorted(map(str, spark.read.parquet(str(tmp_path / name)).collect()))
    assert read("parts") == read("whole") and len(read("parts")) == 40


def test_rows_without_a_family_do_not_travel(spark, monkeypatch):
    mapping = spark.createDataFrame([("f", "why", ["T1"], [("T1", "x")], 1, "high", "r")],
        "family_id string, reason string, technique_ids array<string>, techniques array<struct<technique_id:string,technique_name:string>>, "
        "n_techniques long, mapping_confidence string, rationale string")  # fmt: skip
    rows = spark.createDataFrame([("f", 1), ("g", 2), (None, 3), (None, 3)], "family_id string, n int")
    monkeypatch.setattr(lookup, "is_small", lambda *_: False)
    got = e.enrich_by_family(rows, mapping)
    assert sorted((r["n"], r["reason"]) for r in got.collect()) == [(1, "why"), (2, None), (3, m.NO_ATTRIBUTION), (3, m.NO_ATTRIBUTION)]
    above = e.enrich_by_family(rows, mapping)._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]
    assert "isnull(family_id" in got._jdf.queryExecution().optimizedPlan().toString() and "Union" in above


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for top in folders for _, _, names in os.walk(top) for name in names if name.startswith("shuffle_")}


def test_landed_tables_are_small_and_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workloads, "_LANDED", {})
    before = shuffle_files(spark)
    rows = workloads.landed(spark, str(tmp_path), "counts", lambda at, _: at.range(10_000).groupBy(F.col("id") % 7).count())
    codecs = {pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0).column(0).compression for f in rows.inputFiles()}
    assert codecs == {"ZSTD"}
    end = time.time() + 20  # they are removed beside the job
    while time.time() < end and shuffle_files(spark) - before:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_what_is_staged_in_a_scratch_scope_goes_with_it(spark):
    folder = lambda df: os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    with scratch(spark):
        outer = folder(stage(spark.range(3), "outer"))
        with pytest.raises(ValueError), scratch(spark):
            inner, kept = folder(stage(spark.range(3), "inner")), folder(stage(spark.range(3), "kept", keep=True))
            raise ValueError
        assert not os.path.exists(inner) and os.path.exists(kept) and os.path.exists(outer)
    assert not os.path.exists(outer) and os.path.exists(kept)
    assert os.path.exists(folder(stage(spark.range(3), "plain")))


def test_marts_and_run_history(spark, tmp_path):
    root = str(tmp_path)
    mart = lambda n: {"t": spark.createDataFrame([(n,)], "n int")}
    for day, n in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-02", 3)):
        tables.publish_marts(mart(n), root, day)
    assert tables.latest_mart(spark, root, "t").first()["n"] == 3
    assert spark.read.parquet(f"{root}/t").count() == 2
    runs = lambda run, n, source="a": spark.createDataFrame([(source, run, NOW, n)], "source string, run_id string, attempt_time timestamp, records int")
    for run, n in (("r1", 1), ("r2", 2), ("r2", 5)):
        tables.append_source_runs(runs(run, n), f"{root}/runs")
    tables.append_source_runs(runs("r2", 7, "b"), f"{root}/runs")
    history = spark.read.parquet(f"{root}/runs").collect()
    assert sorted((r["source"], r["run_id"], r["records"]) for r in history) == [("a", "r1", 1), ("a", "r2", 5), ("b", "r2", 7)]


def drop(spark, start, *keys):
    return seen(spark, *(("a", k) for k in keys)).withColumn("run_start", F.lit(start).cast("timestamp"))


def statuses(engine):
    return {r["canonical_key"]: r["status"] for r in engine.state.load().indicators.collect()}


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    engine = st.StreamSnapshots(spark, str(tmp_path))
    days = [datetime(2024, 1, n) for n in (1, 2, 3)]
    engine.apply(drop(spark, days[0], "x", "y"))
    engine.apply(drop(spark, days[1], "x"))
    second = statuses(engine)
    assert second == {"x": m.PRESENT, "y": m.FALLEN}
    engine.apply(drop(spark, days[1], "x"))
    assert statuses(engine) == second
    engine.apply(drop(spark, days[2], "x", "y", "z"))
    assert statuses(engine) == {"x": m.PRESENT, "y": m.PRESENT, "z": m.PRESENT}
    sizes = {r["run_id"]: (r["n_new"], r["n_reappeared"], r["n_fallen"]) for r in spark.read.parquet(f"{tmp_path}/diff_sources").collect()}
    assert sizes == {"20240102T000000.000000Z": (0, 0, 1), "20240103T000000.000000Z": (1, 1, 0)}
    assert engine.state.load().baseline_instant == days[0]


def test_stream_matches_batch(spark, tmp_path):
    engine = st.StreamSnapshots(spark, str(tmp_path / "out"))
    schema = OBSERVED + ", run_start timestamp"
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    for day, keys in ((1, "xy"), (2, "yz"), (3, "x")):
        drop(spark, datetime(2024, 1, day), *keys).write.mode("append").parquet(landing)
        engine.drain(landing, schema, checkpoint)
    assert statuses(engine) == {"x": m.PRESENT, "y": m.FALLEN, "z": m.FALLEN}


def test_runs_that_land_together_are_applied_in_order(spark, tmp_path):
    engine = st.StreamSnapshots(spark, str(tmp_path))
    both = drop(spark, datetime(2024, 1, 2), "y").unionByName(drop(spark, datetime(2024, 1, 1), "x"))
    engine.apply(both)
    assert statuses(engine) == {"x": m.FALLEN, "y": m.PRESENT}


def test_empty_drop_is_no_run(spark, tmp_path):
    engine = st.StreamSnapshots(spark, str(tmp_path))
    engine.apply(drop(spark, NOW))
    assert engine.state.load().outcome == "absent"


def test_a_late_run_and_a_run_in_parts(spark, tmp_path):
    days = [datetime(2024, 1, n) for n in (1, 2, 3)]
    soon = datetime(2024, 1, 3, 0, 0, 0, 5)
    ordered, late = (st.StreamSnapshots(spark, str(tmp_path / name)) for name in ("a", "b"))
    for number, (start, keys) in enumerate(zip((*days, soon), ("xy", "yz", "xw", "w"))):
        ordered.apply(drop(spark, start, *keys), number)
    for number, (start, keys) in enumerate(((days[2], "x"), (soon, "w"), (days[0], "xy"), (days[2], "w"), (days[1], "yz"))):
        late.apply(drop(spark, start, *keys), number)
    rows = lambda e: sorted(map(str, e.state.load().indicators.drop("ingested_at").collect()))
    assert rows(late) == rows(ordered) and late.state.load().run_id == "20240103T000000.000005Z"
    sets = lambda name: sorted(map(str, spark.read.parquet(f"{tmp_path}/{name}/diff_sources").select("run_id", "n_new", "n_reappeared", "n_fallen").collect()))
    assert sets("a") == sets("b")


def test_census_of_batches_out_of_order(spark, tmp_path):
    seen = [(1, "f"), (2, "g"), (9, "f"), (20, "h"), (20, "h"), (21, "f"), (3, None)]
    schema = "seen_at timestamp, family string"
    table = [(datetime(2024, 1, d), f) for d, f in seen]
    once, often = (st.SlidingCensus(spark, str(tmp_path / name), "3 days") for name in ("a", "b"))
    once.apply(spark.createDataFrame(table, schema))
    for number, i in enumerate((3, 0, 6, 5, 2, 4, 1, 1)):
        often.apply(spark.createDataFrame(table[i : i + 1], schema), min(number, 6))
    rows = lambda c: sorted(map(str, c.census().collect()))
    assert rows(once) == rows(often) and once.batches().first()["n_late"] == 0
    # What lies more than the delay behind the newest row of an earlier batch is late, and counted.
    assert sum(r["n_late"] for r in often.batches().collect()) == 4
    windows = {r["start"].day: (r["n_families"], r["n_observations"], r["closed"]) for r in once.census().where("start >= '2024-01-01'").collect()}
    assert windows[1] == (3, 3, True) and 11 not in windows
    assert windows[16] == (1, 2, False) and windows[21] == (1, 1, False)


def test_following_keys_across_the_retention(spark, tmp_path):
    landing, checkpoint = (str(tmp_path / name) for name in ("in", "cp"))
    follower = st.KeySightings(spark, str(tmp_path / "out"), 86_400)
    # "x" misses a day, "y" misses more than the retention, "z" falls and stays away; a run lands late.
    for day, keys in ((1, "xyz"), (3, "xw"), (2, "y"), (50, "xyw")):
        start = datetime(2024, 1, 1) + timedelta(days=day - 1)
        rows = drop(spark, start, *keys).select("source", "canonical_key", "run_start")
        rows.write.mode("append").parquet(landing)
        follower.drain(landing, "source string, canonical_key string, run_start timestamp", checkpoint)
    got = follower.members().collect()
    days = lambda key: [(r["member"], (r["run_start"] - datetime(2024, 1, 1)).days + 1)
                        for r in sorted(got, key=lambda r: r["run_start"]) if r["canonical_key"] == key]
    assert days("x") == [("new", 1), ("fallen", 2), ("reappeared", 3), ("fallen", 4), ("new", 50)]
    assert days("y") == [("new", 1), ("fallen", 3), ("new", 50)]
    assert days("z") == [("new", 1), ("fallen", 2)]
