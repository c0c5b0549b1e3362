from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedmark import model as m
from feedmark.operators import difference as d, lookup
from feedmark.operators.normalize import KEV_TYPE

OBSERVED = f"""source string, canonical_key string, type string, value string, family string, kev {KEV_TYPE},
    last_seen timestamp, confidence int, ingested_at timestamp"""
STATE = f"""source string, canonical_key string, type string, value string, family string, kev {KEV_TYPE},
    last_seen timestamp, ingested_at timestamp, status string, fallen_since timestamp"""
RUNS = "source string, status string, http_code int, declared_window string, attempt_time timestamp"
MARKS = "source string, watermark timestamp"
NOW = datetime(2024, 1, 31)


def seen(spark, *rows):
    full = [(s, k, m.DOMAIN, k, f, None, None, 50, NOW) for s, k, f in ((*r, None)[:3] for r in rows)]
    return spark.createDataFrame(full, OBSERVED)


def held(spark, *rows):
    full = []
    for source, key, status, since, *family in rows:
        full.append((source, key, m.DOMAIN, key, family[0] if family else None, None, None, NOW, status, since))
    return spark.createDataFrame(full, STATE)


def gate_of(spark, runs, marks, observed):
    return d.publication_gate(
        spark.createDataFrame(runs, RUNS), spark.createDataFrame(marks, MARKS), d.observed_counts(observed)
    )


def run(source, status=m.OK, code=200, window="P5D/x", attempt=NOW):
    return (source, status, code, window, attempt)


def before(days):
    return NOW - timedelta(days=days)


def test_gate_cascade(spark):
    observed = seen(spark, ("a", "k"), ("b", "k"), ("e", "k"), ("f", "k"), ("g", "k"), ("h", "k"), ("i", "k"))
    runs = [run("a", m.PARTIAL), run("b"), run("c", code=304), run("d"), run("e"), run("f"), run("g", window=None),
            run("h", window="bad"), run("i", m.FAILED, window="bad")]
    marks = [("a", before(6)), ("c", before(9)), ("d", before(1)), ("e", before(6)), ("f", before(5)),
             ("g", before(60)), ("h", before(1)), ("i", before(9))]
    got = {r["source"]: r for r in gate_of(spark, runs, marks, observed).collect()}
    assert {s: r["rule"] for s, r in got.items()} == {
        "a": d.RULE_NOT_OK, "b": d.RULE_FIRST, "c": d.RULE_UNCHANGED, "d": d.RULE_EMPTY, "e": d.RULE_BEYOND_WINDOW,
        "f": d.RULE_COMPARED,  # exactly the window is not beyond it
        "g": d.RULE_COMPARED, "h": d.RULE_BEYOND_WINDOW, "i": d.RULE_NOT_OK}
    assert [s for s, r in sorted(got.items()) if r["fallen_published"]] == ["c", "f", "g"]
    assert [s for s, r in sorted(got.items()) if r["additions_lost_risk"]] == ["a"]
    assert [s for s, r in sorted(got.items()) if r["in_baseline"]] == ["b"]
    sizes = {r["source"]: (r["n_new"], r["n_fallen"]) for r in d.diff_sources(
        d.diff_members(d.compare(observed, held(spark)), gate_of(spark, runs, marks, observed)),
        gate_of(spark, runs, marks, observed)).collect()}
    assert sizes["a"] == (0, None) and sizes["c"] == (0, 0) and sizes["e"] == (1, None) and sizes["f"] == (1, 0)


@pytest.mark.parametrize(
    "status, produced, code, advances",
    [
        (m.OK, True, 200, True),
        (m.OK, False, 200, False),
        (m.OK, False, 304, True),
        (m.PARTIAL, True, 200, False),
        (m.PARTIAL, True, 304, False),
        (m.FAILED, False, None, False),
    ],
)
def test_watermark(spark, status, produced, code, advances):
    observed = seen(spark, *([("a", "k")] if produced else []))
    gate = gate_of(spark, [run("a", status, code)], [("a", before(1)), ("z", before(3))], observed)
    marks = spark.createDataFrame([("a", before(1)), ("z", before(3))], MARKS)
    got = {r["source"]: r["watermark"] for r in d.advance_watermarks(marks, gate).collect()}
    assert got == {"a": NOW if advances else before(1), "z": before(3)}


def members(spark, observed, state, runs, marks):
    gate = gate_of(spark, runs, marks, observed)
    rows = d.diff_members(d.compare(observed, state), gate).collect()
    return sorted((r["source"], r["canonical_key"], r["member"]) for r in rows)


def rebuilt(spark, observed, state, runs, marks, mode=m.MODE_DIFFERENTIAL, now=NOW):
    gate = gate_of(spark, runs, marks, observed)
    rows = d.rebuild_state(d.compare(observed, state), gate, mode, F.lit(now).cast("timestamp")).collect()
    return {(r["source"], r["canonical_key"]): (r["status"], r["fallen_since"]) for r in rows}


def test_sets_and_two_sources(spark):
    state = held(spark, ("a", "k1", m.PRESENT, None), ("a", "k2", m.PRESENT, None), ("a", "k3", m.FALLEN, before(2)),
                 ("b", "k2", m.PRESENT, None))
    observed = seen(spark, ("a", "k1"), ("a", "k3"), ("a", "k4"), ("b", "k2"))
    runs, marks = [run("a"), run("b")], [("a", before(1)), ("b", before(1))]
    assert members(spark, observed, state, runs, marks) == [
        ("a", "k1", d.KEPT), ("a", "k2", d.FALLEN_SET), ("a", "k3", d.REAPPEARED), ("a", "k4", d.NEW), ("b", "k2", d.KEPT)]
    # It fell from one source only.
    after = rebuilt(spark, observed, state, runs, marks)
    assert after[("a", "k2")] == (m.FALLEN, NOW) and after[("b", "k2")] == (m.PRESENT, None)
    assert after[("a", "k3")] == (m.PRESENT, None)


def test_retention_is_strict_and_carry_never_prunes(spark):
    exactly, older = before(30), before(30) - timedelta(microseconds=1)
    state = held(spark, ("a", "old", m.FALLEN, older), ("a", "edge", m.FALLEN, exactly),
                 ("b", "old", m.FALLEN, older), ("b", "p", m.PRESENT, None), ("gone", "x", m.PRESENT, None))
    observed = seen(spark, ("a", "k"), ("b", "late"))
    runs, marks = [run("a"), run("b", m.PARTIAL)], [("a", before(1)), ("b", before(1))]
    assert rebuilt(spark, observed, state, runs, marks) == {
        ("a", "edge"): (m.FALLEN, exactly),
        ("a", "k"): (m.PRESENT, None),
        # A partial source is carried untouched and its observation deferred.
        ("b", "old"): (m.FALLEN, older),
        ("b", "p"): (m.PRESENT, None),
        ("gone", "x"): (m.PRESENT, None),
    }


def test_baseline_and_suppressed_fallen_keep_rows_present(spark):
    state = held(spark, ("a", "p", m.PRESENT, None), ("a", "f", m.FALLEN, before(3)))
    observed = seen(spark, ("a", "k"))
    kept = {("a", "p"): (m.PRESENT, None), ("a", "f"): (m.FALLEN, before(3)), ("a", "k"): (m.PRESENT, None)}
    assert rebuilt(spark, observed, state, [run("a")], [("a", before(1))], m.MODE_BASELINE) == kept
    assert rebuilt(spark, observed, state, [run("a")], [("a", before(9))]) == kept


def test_three_runs_leave_and_return(spark):
    """A key returns inside the retention (reappeared) and another outside it (new)."""
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 3)

    def step(observed, state, when, last):
        runs, marks = [run("a", window=None, attempt=when)], [("a", last)]
        gate = gate_of(spark, runs, marks, observed)
        compared = d.compare(observed, state)
        rows = d.diff_members(compared, gate).where("member <> 'kept'").collect()
        after = d.rebuild_state(compared, gate, m.MODE_DIFFERENTIAL, F.lit(when).cast("timestamp"))
        after = spark.createDataFrame(after.collect(), STATE)
        return sorted((r["canonical_key"], r["member"]) for r in rows), after

    state = held(spark, ("a", "x", m.PRESENT, None), ("a", "y", m.PRESENT, None))
    sets, state = step(seen(spark, ("a", "z")), state, first, first - timedelta(days=1))
    assert sets == [("x", "fallen"), ("y", "fallen"), ("z", "new")]
    sets, state = step(seen(spark, ("a", "z"), ("a", "x")), state, second, first)
    assert sets == [("x", "reappeared")]
    late = first + timedelta(days=31)
    sets, state = step(seen(spark, ("a", "z"), ("a", "x")), state, late, second)
    assert sets == [] and state.where("canonical_key = 'y'").count() == 0
    sets, _ = step(seen(spark, ("a", "z"), ("a", "x"), ("a", "y")), state, late + timedelta(days=1), late)
    assert sets == [("y", "new")]


def test_dedupe_does_not_depend_on_order(spark):
    rows = [("a", "k", m.DOMAIN, "k", f, None, t, c, NOW)
            for f, t, c in (("f2", before(1), 50), ("f1", before(1), 50), (None, before(1), 50), ("f0", before(2), 90),
                            ("f3", None, 99), ("f9", before(1), 40))]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        best = d.dedupe_observed(spark.createDataFrame(order, OBSERVED).repartition(3)).first()
        assert (best["family"], best["last_seen"]) == ("f1", before(1))


def test_state_rows_are_not_aggregated(spark):
    state = held(spark, ("a", "x", m.PRESENT, None))
    plan = d.compare(seen(spark, ("a", "x")), state)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "Join FullOuter" in plan


def test_merge_sources(spark):
    state = held(spark, ("b", "k", m.FALLEN, NOW, None), ("a", "k", m.PRESENT, None, "fam"))
    row = d.merge_state_sources(state).first()
    assert row["family"] == "fam" and [s["source"] for s in row["sources"]] == ["a", "b"]


def test_run_modes(spark):
    cases = {
        "absent": ("absent", None, False, None, 2), "bad": ("illegible", None, False, None, 2),
        "unmarked": ("no_watermark", None, True, before(1), 2), "future": ("ok", NOW + timedelta(seconds=1), True, before(90), 2),
        "asked": ("ok", before(1), True, before(90), 2), "due": ("ok", before(1), False, before(31), 2),
        "edge": ("ok", NOW, False, before(30), 1), "dead": ("absent", None, False, None, 0), "deaddiff": ("ok", before(1), False, before(3), 0)}
    rows = [(k, o, w, r, b, n, NOW) for k, (o, w, r, b, n) in cases.items()]
    history = spark.createDataFrame(rows, """run_id string, load_outcome string, latest_watermark timestamp,
        regenerate boolean, baseline_instant timestamp, n_usable_sources int, run_start timestamp""")
    got = {r["run_id"]: (r["mode"], r["baseline_reason"]) for r in d.run_mode(history).collect()}
    assert got == {
        "absent": (m.MODE_BASELINE, m.STATE_ABSENT), "bad": (m.MODE_BASELINE, m.STATE_ILLEGIBLE),
        "unmarked": (m.MODE_BASELINE, m.STATE_NO_WATERMARK), "future": (m.MODE_BASELINE, m.WATERMARK_INCOHERENT),
        "asked": (m.MODE_BASELINE, m.REGENERATION_REQUESTED), "due": (m.MODE_BASELINE, m.REGENERATION_DUE),
        "edge": (m.MODE_DIFFERENTIAL, None), "dead": (m.MODE_TOTAL_FAILURE, m.STATE_ABSENT),
        "deaddiff": (m.MODE_TOTAL_FAILURE, None)}


def test_family_variation_null_is_not_empty(spark):
    observed = seen(spark, ("a", "k1", "f1"), ("a", "k2", "f2"), ("b", "k1", "f1"))
    state = held(spark, ("a", "k1", m.PRESENT, None, "f1"), ("a", "k3", m.PRESENT, None, "f3"), ("b", "k9", m.PRESENT, None, "f9"))
    gate = gate_of(spark, [run("a"), run("b", m.PARTIAL)], [("a", before(1)), ("b", before(1))], observed)
    got = {r["family"]: r["delta"] for r in d.family_variation(observed, state, gate).collect()}
    assert got == {"f2": 1, "f3": -1} and d.variation_calculable(gate).first()["calculable"]
    none = gate_of(spark, [run("a", m.PARTIAL)], [("a", before(1))], observed)
    assert not d.variation_calculable(none).first()["calculable"]
    same = gate_of(spark, [run("a", code=304)], [("a", before(1))], seen(spark))
    assert d.family_variation(seen(spark), state, same).collect() == []


def test_lookup_join_gives_the_same_beyond_the_broadcast_bound(spark):
    facts = spark.range(1000).select(F.when(F.col("id") < 700, 0).otherwise(F.col("id") % 5).alias("k"), F.col("id"))
    table = spark.createDataFrame([(0, "x"), (1, "y"), (2, None)], "k long, v string")
    assert lookup.is_small(table, 3) and not lookup.is_small(table, 2)
    assert not lookup.is_small(table, 3, max_bytes=20)
    for how in ("left", "inner"):
        small = lookup.join_lookup(facts, table, ["k"], how)
        salted = lookup.join_lookup(facts, table, ["k"], how, max_rows=0)
        assert sorted(map(str, small.collect())) == sorted(map(str, salted.collect()))


def test_lookup_join_beyond_the_bound_neither_broadcasts_nor_repeats(spark):
    facts = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id"))
    table = spark.range(7).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    plan = lookup.join_lookup(facts, table, ["k"], "left", max_rows=3)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Broadcast" not in plan and "Generate" not in plan and "Sort" not in plan
