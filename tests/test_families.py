from pyspark.sql import functions as F

from feedmark import model as m
from feedmark.functions import names
from feedmark.operators import catalog_checks as cc, enrich as e, families as fam, lookup
from feedmark.operators import reports as r
from feedmark.sources import catalog, rules

OBSERVED = "source string, value string, family_id string, malware_printable string, malware_alias string"

SOFTWARE = [
    ("s1", "Alpha", ["Alfa"], None), ("s2", "Beta", [], None), ("s3", "Dup", ["Shared"], None),
    ("s4", "Other", ["SHARED!"], None), ("s5", "Gamma", [], None), ("s6", "Quiet", None, None),
    ("s7", "Sub Only", [], None), ("s8", "Retired", [], "revoked"), ("s9", "Older", ["Beta"], "x_mitre_deprecated"),
]
PATTERNS = [("p1", "T1001", "One"), ("p2", "T1002.001", "Two"), ("p3", "T1003", ""), ("p4", "", "Four"), ("p5", "T1005", "Five")]
USES = [("s1", "p1"), ("s1", "p1"), ("s1", "p5"), ("s1", "p2"), ("s2", "p3"), ("s5", "p5"), ("s7", "p2"), ("s8", "p1"), ("s1", "s2")]


def objects(spark):
    rows = [(i, "malware", n, a, mark == "revoked", mark == "x_mitre_deprecated", None, None, None, None)
            for i, n, a, mark in SOFTWARE]
    for i, technique, name in PATTERNS:
        refs = [("capec", "C1")] + ([("mitre-attack", technique), ("mitre-attack", "T9999")] if technique else [])
        rows.append((i, "attack-pattern", name, None, i == "p5", None, refs, None, None, None))
    rows += [(f"r{n}", "relationship", None, None, None, None, None, "uses", a, b) for n, (a, b) in enumerate(USES)]
    rows.append(("r99", "relationship", None, None, None, None, None, "mitigates", "s5", "p1"))
    return spark.createDataFrame(rows, catalog.OBJECT_SCHEMA)


OBSERVATIONS = [
    ("win.alpha", "Alpha", "Alfa, nothing"), ("win.alpha", "ALPHA", None),  # resolves, by its identifier
    ("win.cat", "Shared", None),  # its canon names two software
    ("win.beta", "Beta", None), ("elf.beta", "Beta", None),  # two families behind one canon
    ("win.two", "Alfa Beta", "Quiet,Gamma"),  # its names lead to two software
    ("win.none", "Nobody", None),
    ("win.subonly", "Sub Only", None),  # only a sub-technique
    ("win.code", "Gamma-", None),  # matched by a feed name only... and shared with win.two
    ("win.x", "Dup", None),  # resolves by a feed name
    ("win.retired", "Retired", None),
    ("elf.cands", "Shared", "Beta"),  # first ambiguous name decides: Beta is origin-ambiguous
]


def mapped(spark, observations):
    rows = [("threatfox", str(i), *o) for i, o in enumerate(observations)]
    objs = objects(spark)
    return fam.map_families(spark.createDataFrame(rows, OBSERVED), catalog.software(objs), catalog.patterns(objs), catalog.uses(objs))


def test_every_outcome_with_its_control(spark):
    mapping, techniques = mapped(spark, OBSERVATIONS)
    got = {x["family_id"]: x["reason"] for x in mapping.collect()}
    assert got == {
        "win.alpha": None,
        "win.cat": m.AMBIGUOUS_CATALOG,
        "win.beta": m.AMBIGUOUS_ORIGIN,
        "elf.beta": m.AMBIGUOUS_ORIGIN,
        "win.two": m.AMBIGUOUS_ORIGIN,
        "win.none": m.FAMILY_NO_ENTRY,
        "win.subonly": m.FAMILY_NO_TECHNIQUES,
        "win.code": m.AMBIGUOUS_ORIGIN,
        "win.x": m.FAMILY_NO_TECHNIQUES,
        "win.retired": m.FAMILY_NO_ENTRY,
        "elf.cands": m.AMBIGUOUS_ORIGIN,
    }
    rows = sorted((t["technique_id"], t["n_edges"], t["mapping_confidence"]) for t in techniques.collect())
    # Repeated edges count; sub-techniques, nameless and unreferenced patterns do not; revoked do.
    assert rows == [("T1001", 2, m.HIGH), ("T1005", 1, m.HIGH)]


def test_a_family_without_a_latin_name_stays(spark):
    mapping, _ = mapped(spark, [("win.漢字", "漢字", None), ("win.alpha", "Alpha", None)])
    assert {x["family_id"]: x["reason"] for x in mapping.collect()} == {"win.漢字": m.FAMILY_NO_ENTRY, "win.alpha": None}
    rows = spark.createDataFrame([("threatfox", "v", "win.漢字")], "source string, value string, family_id string")
    kept, broken = e.enrichment_invariant(e.enrich_by_family(rows, mapping))
    assert kept.first()["reason"] == m.FAMILY_NO_ENTRY and broken.count() == 0


def test_candidate_ambiguity_and_feed_authority(spark):
    mapping, techniques = mapped(spark, [("win.two", "Nope", "Quiet,Gamma"), ("win.y", "Gamma Ray", None)])
    assert {x["family_id"]: x["reason"] for x in mapping.collect()}["win.two"] == m.AMBIGUOUS_CANDIDATES
    mapping, techniques = mapped(spark, [("win.y", "Gamma", None)])
    assert [(t["technique_id"], t["mapping_confidence"], t["matched_name"]) for t in techniques.collect()] == [
        ("T1005", m.MEDIUM, "Gamma")]


def test_resolution_does_not_depend_on_order(spark):
    first = sorted(map(str, mapped(spark, OBSERVATIONS)[0].collect()))
    assert first == sorted(map(str, mapped(spark, OBSERVATIONS[::-1])[0].collect()))


def test_family_name_inside_identifier_comes_first(spark):
    rows = [("threatfox", "1", "win.agent_tesla", "Agent Tesla", "AgentTesla,Negasteal")]
    got = fam.family_candidates(fam.family_names(spark.createDataFrame(rows, OBSERVED))).orderBy("rank", "name").collect()
    assert [(x["canon"], x["authority"], x["name"]) for x in got] == [
        ("agenttesla", m.MALPEDIA, "agent_tesla"), ("negasteal", m.FEED, "Negasteal")]


def test_canonical_names_count_collisions(spark):
    df = spark.createDataFrame([("Agent Tesla",), ("agent_tesla",), ("Ágent Tesla",), ("x",), ("x",)], "name string")
    assert sorted((x["canon"], x["n_names"]) for x in fam.canonical_names(df).collect()) == [("agenttesla", 3)] * 3 + [("x", 1)]


def test_catalog_profile_drift_and_retired(spark):
    profile = cc.catalog_profile(objects(spark))
    got = {x["magnitude"]: x["observed"] for x in profile.collect()}
    assert got == {"objects": 24, "software": 9, "software_live": 7, "live_with_aliases": 3, "software_retired": 2,
                   "canons": 9, "canons_ambiguous": 1, "uses_live": 7}
    baseline = spark.createDataFrame([("objects", 24), ("canons", 8), ("uses_live", 7), ("extra", 1)], "magnitude string, observed long")
    drift = {x["magnitude"]: x["defect"] for x in cc.catalog_drift(profile, baseline).collect()}
    assert drift["objects"] is None and drift["canons"] == "changed"
    assert drift["extra"] == "not_observed" and drift["software"] == "no_baseline"
    declared = spark.createDataFrame([("s8", "x_mitre_deprecated"), ("s9", "x_mitre_deprecated"), ("s0", "revoked")], "id string, marker string")
    found = cc.retired_by_identity(declared, catalog.retired(objects(spark))).orderBy("id").collect()
    assert [x["verdict"] for x in found] == ["absent", "marker_changed", "kept"]
    assert cc.check_declared(declared).first()["checkable"]
    for bad in (declared.limit(0), declared.where("marker <> 'revoked'")):
        assert [tuple(x) for x in cc.retired_by_identity(bad, catalog.retired(objects(spark))).collect()] == [(None, None, None, "not_checkable")]
    assert not cc.check_declared(declared.where("marker <> 'revoked'")).first()["checkable"]
    assert not cc.check_declared(declared.limit(0)).first()["checkable"]


def test_drift_names_the_objects(spark):
    def version(*changed):
        rows = {r[0]: r for r in (
            ("added", "malware", "A"), ("gone", "malware", "G"), ("same", "tool", "S"), ("retired", "tool", "R"),
            ("revived", "tool", "V", None, True), ("remarked", "tool", "M", None, True), ("retyped", "tool", "T"),
            ("renamed", "tool", None), ("aliased", "tool", "L", ["x", "y"]), ("reordered", "tool", "O", ["x", "y"]),
            ("rewired", "relationship", None, None, None, None, "s1", "p1"), ("twice", "tool", "W"), (None, "tool", "no id"))}
        rows |= {r[0]: r for r in changed}
        full = [(*r, *[None] * (8 - len(r))) for r in rows.values()]
        full += [full[[r[0] for r in full].index("twice")]] * bool(changed)
        made = [(i, t, n, a, v, d, None, "uses" if s else None, s, g) for i, t, n, a, v, d, s, g in full]
        return spark.createDataFrame(made, catalog.OBJECT_SCHEMA)

    before = version().where("id IS NULL OR id <> 'added'")
    now = version(("retired", "tool", "R", None, True), ("revived", "tool", "V"), ("remarked", "tool", "M", None, False, True),
                  ("retyped", "malware", "T"), ("renamed", "tool", "N"), ("aliased", "tool", "L", ["x"]),
                  ("reordered", "tool", "O", ["y", "x", "x"]), ("rewired", "relationship", None, None, None, None, "s1", "p2"))
    now = now.where("id IS NULL OR id <> 'gone'")
    got = {x["id"]: x for x in cc.catalog_object_drift(now, before).collect()}
    assert {i: x["change"] for i, x in got.items()} == {
        "added": "added", "gone": "gone", "retired": "retired", "revived": "revived", "remarked": "remarked", "retyped": "retyped",
        "renamed": "renamed", "aliased": "renamed", "rewired": "rewired", "twice": "repeated"}
    assert (got["remarked"]["marker"], got["remarked"]["marker_now"]) == ("revoked", "x_mitre_deprecated")
    assert (got["renamed"]["name"], got["renamed"]["name_now"], got["gone"]["type"]) == (None, "N", "malware")
    shuffled = cc.catalog_object_drift(now.orderBy(F.desc("id")).repartition(3), before.repartition(5))
    assert sorted(shuffled.collect(), key=str) == sorted(got.values(), key=str)
    assert cc.catalog_object_drift(now, now).count() == 0 and cc.catalog_object_drift(now, now.limit(0)).where("change <> 'added'").count() == 0


def test_bundle_files(spark, tmp_path):
    import json

    path = tmp_path / "bundle.json"
    path.write_text(json.dumps({"type": "bundle", "objects": [
        {"id": "malware--1", "type": "malware", "name": "A", "extra": {"x": 1}},
        {"id": "tool--1", "type": "tool", "name": "B", "revoked": True}]}, indent=1))
    objs = catalog.read_bundle(spark, str(path))
    assert [x["id"] for x in catalog.software(objs).collect()] == ["malware--1"]
    assert catalog.retired(objs).first()["marker"] == "revoked"


RULES = [(1, "Acme", "Gate", "T1190", None, "a"), (2, "ACME", "gate!", "T1203", None, "b"), (3, "Acme", "Multiple", None, True, "c"),
         (4, "Bad", "One", "T1059", None, "d"), (5, "Bad", "Two", None, False, "e")]


def test_rules(spark):
    checked = rules.check_rules(spark.createDataFrame(RULES, rules.RULE_SCHEMA))
    assert {x["position"]: x["fault"] for x in checked.collect()} == {
        1: None, 2: None, 3: None, 4: "technique_not_allowed", 5: "no_vector"}
    dimension = rules.rule_dimension(checked)
    assert {(x["product_canon"], x["technique"]) for x in dimension.collect()} == {("gate", "T1203"), ("multiple", None)}
    try:
        rules.require_sound(checked)
        raise AssertionError("faulty rules were accepted")
    except ValueError as fault:
        assert "technique_not_allowed" in str(fault)
    pairs = spark.createDataFrame([("acme", "GATE"), ("Acme", "multiple"), ("Acme", None), (None, None)], "vendor string, product string")
    got = {(x["vendor"], x["product"]): (x["reason"], x["technique_id"], x["mapping_confidence"]) for x in e.vector_lookup(pairs, dimension).collect()}
    assert got[("acme", "GATE")] == (None, "T1203", m.LOW)
    assert got[("Acme", "multiple")] == (m.PRODUCT_UNSPECIFIC, None, None)
    assert got[("Acme", None)] == got[(None, None)] == (m.PRODUCT_UNCLASSIFIED, None, None)


def test_invariant(spark):
    rows = [("threatfox", None, 1), ("threatfox", m.NO_ATTRIBUTION, 0), ("cisa-kev", m.STAGE_UNAVAILABLE, 0),
            ("threatfox", None, 0), ("threatfox", m.FAMILY_NO_ENTRY, 2), ("cisa-kev", m.NO_ATTRIBUTION, 0),
            ("threatfox", m.PRODUCT_UNSPECIFIC, 0), ("threatfox", "made_up", 0)]
    kept, broken = e.enrichment_invariant(spark.createDataFrame(rows, "source string, reason string, n_techniques long"))
    assert kept.count() == 3
    assert sorted(x["violation"] for x in broken.collect()) == [
        "gap_without_reason", "level_not_for_source", "level_not_for_source", "techniques_with_reason", "unknown_reason"]


def test_denominators(spark):
    """One prolific mapped family counts once; unmapped families stay in the denominator."""
    many = [("win.alpha", "Alpha", None)] * 50 + [(f"win.none{i}", f"None{i}", None) for i in range(3)]
    mapping, techniques = mapped(spark, many)
    got = {x["technique_id"]: (x["n_families"], x["total_families"], x["share"]) for x in r.technique_frequency(techniques, mapping).collect()}
    assert got == {"T1001": (1, 4, 0.25), "T1005": (1, 4, 0.25)}
    top = r.technique_frequency_top(techniques, mapping).collect()
    assert [(x["technique_id"], x["percent"]) for x in top] == [("T1001", 25), ("T1005", 25)]
    assert {x["reason"]: x["n_families"] for x in r.reasons_by_family(mapping).collect()} == {m.FAMILY_NO_ENTRY: 3}


def test_enrichment_without_catalogue_and_salted_join(spark, monkeypatch):
    mapping, _ = mapped(spark, OBSERVATIONS)
    rows = spark.createDataFrame([("threatfox", "v1", "win.alpha"), ("threatfox", "v2", None), ("threatfox", "v3", "win.none")],
                                 "source string, value string, family_id string")
    expected = [("v1", None, 3), ("v2", m.NO_ATTRIBUTION, 0), ("v3", m.FAMILY_NO_ENTRY, 0)]
    got = e.enrich_by_family(rows, mapping)
    assert sorted((x["value"], x["reason"], x["n_techniques"]) for x in got.collect()) == expected
    monkeypatch.setattr(lookup, "is_small", lambda *_: False)
    got = e.enrich_by_family(rows, mapping)
    assert sorted((x["value"], x["reason"], x["n_techniques"]) for x in got.collect()) == expected
    down = e.enrich_observations(rows, None, None)
    assert {x["reason"] for x in down.collect()} == {m.STAGE_UNAVAILABLE}


def test_split_names_never_per_character(spark):
    df = spark.createDataFrame([("RemcosRAT,Remvio,Socmer",)], "a string")
    assert df.select(F.size(names.split_aliases(F.col("a")))).first()[0] == 3


def test_joins_of_names_broadcast_nothing(spark):
    seen = fam.family_names(spark.createDataFrame([("win.a", "A", None)], "family_id string, malware_printable string, malware_alias string"))
    index = spark.createDataFrame([("a", 1, "s")], "canon string, n_software long, software_id string")
    resolved = fam.resolve_families(seen, fam.family_candidates(seen), index)
    assert "BroadcastExchange" not in resolved._jdf.queryExecution().executedPlan().toString()
