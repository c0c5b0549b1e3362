from pyspark.sql import functions as F

from feedmark.operators import families as fam
from feedmark.operators.name_dictionary import NameDictionary, resolve_again

NAMES = "family_id string, name string"


def named(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_second_run_folds_only_unseen_names(spark, tmp_path):
    kept = NameDictionary(spark, str(tmp_path / "names"))
    assert kept.read().count() == 0
    assert rows(kept.add(named(spark, "Café", "A-1", "A-1", "", None), "r1")) == [("", ""), ("A-1", "a1"), ("Café", "cafe")]
    assert rows(kept.add(named(spark, "Café", "a 1", ""), "r2")) == [("a 1", "a1")]
    assert rows(kept.add(named(spark, "Café"), "r3")) == []
    again = fam.canonical_names(named(spark, "Café", "A-1", "", "a 1")).select("canon", "name", "n_names")
    assert rows(kept.canonical()) == rows(again)


def test_a_repeated_run_replaces_its_own_names(spark, tmp_path):
    kept = NameDictionary(spark, str(tmp_path / "names"))
    kept.add(named(spark, "one"), "r1")
    kept.add(named(spark, "one", "two"), "r2")
    for run, names in (("r1", ["one"]), ("r2", ["one", "two"])):
        kept.add(named(spark, *names), run)
        assert rows(kept.read()) == [("one", "one", "r1"), ("two", "two", "r2")]


def resolution(spark, names, software):
    names = spark.createDataFrame(names, NAMES)
    software = spark.createDataFrame(software, "id string, name string, x_mitre_aliases array<string>")
    return names, fam.family_candidates(names), fam.catalog_index(fam.catalog_names(software))


def test_families_are_decided_again_where_something_changed(spark):
    first = [("win.a", "Alpha"), ("win.b", "Beta"), ("win.c", "Gamma"), ("win.d", "Delta"), ("win.gone", "Alpha Two"), ("win.none", None)]
    catalogue = [("s1", "Alpha", None), ("s2", "Beta", ["Bee"]), ("s3", "Gamma", None), ("s4", "Delta", [])]
    steps = [
        ([*first, ("elf.b", "Beta")], catalogue),  # a rival
        (first[:4], catalogue),  # families that went
        (first, [*catalogue, ("s5", "Gamma", None)]),  # a second software of the name
        (first, catalogue[:3]),  # software that went
        ([*first, ("win.b", "Gamma")], catalogue),  # a further name, held by another family
        ([("win.a", "alpha"), *first[1:]], catalogue),  # the same canon from another name
        ([], catalogue),
        (first, [("s9", *s[1:]) if s[0] == "s1" else s for s in catalogue]),  # another software of the name
        (first, catalogue),
    ]
    names, candidates, index = resolution(spark, first, catalogue)
    resolved = fam.resolve_families(names, candidates, index)
    for step in steps:
        now = resolution(spark, *step)
        assert rows(resolve_again(resolved, *now, candidates, index)) == rows(fam.resolve_families(*now))


def test_a_family_that_nothing_touched_keeps_its_row(spark):
    names, candidates, index = resolution(spark, [("win.a", "Alpha"), ("win.b", "Beta")], [("s1", "Alpha", None), ("s2", "Beta", None)])
    marked = fam.resolve_families(names, candidates, index).withColumn("matched_name", F.lit("as before"))
    now = resolution(spark, [("win.a", "Alpha"), ("win.b", "Beta")], [("s1", "Alpha", None), ("s3", "Beta", None)])
    got = {r["family_id"]: (r["software_id"], r["matched_name"]) for r in resolve_again(marked, *now, candidates, index).collect()}
    assert got["win.a"] == ("s1", "as before") and got["win.b"][0] == "s3" and got["win.b"][1] != "as before"
