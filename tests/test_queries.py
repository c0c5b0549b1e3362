"""Every registered query against its SQL at the smallest scale, and some properties."""

import os

import pytest

import __spark_entry__ as entry
from feedmark.operators import run
from feedmark.operators.normalize import OBSERVATION_COLUMNS
from feedmark.plans import workloads
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    if name not in SQL:
        pytest.skip("no SQL counterpart")
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry_gives_one_row_per_source(spark):
    assert entry.entry(spark).count() == 15


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", ("group_families", "canonicalize_names", "technique_frequency"))
def test_family_queries_do_not_land_whole_observations(spark, name, monkeypatch):
    monkeypatch.setattr(workloads, "_LANDED", {})
    QUERIES[name](spark, SF).collect()
    assert "ioc-normalized" not in {key[-1] for key in workloads._LANDED}


def test_families_are_the_same_from_landed_observations(spark, monkeypatch):
    monkeypatch.setattr(workloads, "_LANDED", {})
    alone = {tuple(row) for row in QUERIES["group_families"](spark, SF).collect()}
    workloads.normalized_ioc(spark, SF)
    assert alone == {tuple(row) for row in QUERIES["group_families"](spark, SF).collect()} and alone


@pytest.mark.parametrize("name", ("group_families", "canonicalize_names", "technique_frequency"))
def test_family_queries_normalise_whole_observations(spark, name, monkeypatch):
    written, stage = {}, workloads.stage

    def noted(df, what):
        rows = stage(df, what)
        written[what] = (set(df.columns), rows.count(), rows.inputFiles()[0].removeprefix("file:"))
        return rows

    monkeypatch.setattr(workloads, "_LANDED", {})
    monkeypatch.setattr(workloads, "stage", noted)
    QUERIES[name](spark, SF).collect()
    columns, n_rows, file = written["ioc-whole"]
    assert columns >= set(OBSERVATION_COLUMNS)
    assert n_rows == workloads.ioc_batch(spark, SF).count()
    assert not os.path.exists(os.path.dirname(file))  # and leave none behind


def test_a_run_leaves_its_state_and_report_only(spark, monkeypatch):
    folders, stage = {}, run.stage

    def noted(df, what):
        rows = stage(df, what)
        folders.setdefault(what, []).append(os.path.dirname(rows.inputFiles()[0].removeprefix("file://")))
        return rows

    monkeypatch.setattr(run, "stage", noted)
    rows = QUERIES["full_run"](spark, SF)
    assert {"threatfox-normalized", "enriched", "changes", "gate"} <= set(folders)
    assert not [f for of_name in folders.values() for f in of_name if os.path.exists(f)]
    assert {r["run"] for r in rows.collect()} == {"run-1", "run-2"}
