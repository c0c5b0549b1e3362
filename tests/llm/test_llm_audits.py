"""Manifest, divergences and SentencePiece encoding against brute force on awkward rows, and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from feedmark.llm import divergence, merkle, pieces, vectors
from test_llm_operators import LONG, ROWS, rows_of, whole

CLASHES = "node string, path int, place int, count int, root string, tree int, leaf int, member int, value int, rank int, term string, `row` int, its_tree int"
SCHEMA = f"doc_id bigint, text string, source string, lang string, n_chars bigint, {CLASHES}"
LANGS = ["en", None, "", "é", "en"]


@pytest.fixture(scope="module")
def docs(spark):
    pad = [None] * len(CLASHES.split(","))
    made = [(i, t, s, LANGS[n % 5], None if n % 4 == 0 else len(whole(t)), *pad) for n, (i, t, s) in enumerate(ROWS)]
    made += [(100 + n, f"the common word{n % 7} Word{n % 3} ÜBER über {'x ' * (n % 5)}", f"s{n % 6}", "en" if n % 2 else "fr", n, *pad) for n in range(700)]
    made += [made[0], made[3], made[-1]]  # repeated rows
    return spark.createDataFrame(made, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = -7")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_leaf(r, more=0):
    n_chars = r["n_chars"] if r["n_chars"] is None else r["n_chars"] + more
    said = (None if v is None else str(v) for v in (r["doc_id"], r["source"], r["lang"], n_chars, r["text"]))
    return sha(*("-" if v is None else f"{len(v.encode())}:{v}" for v in said))


def climb(nodes):
    """The root, and for each node [(is a right one, sibling)]."""
    paths, owners = [[] for _ in nodes], [[n] for n in range(len(nodes))]
    while len(nodes) > 1:
        for n, own in enumerate(owners):
            sibling = nodes[n ^ 1] if n ^ 1 < len(nodes) else ""
            for i in own:
                paths[i].append((n % 2 == 1, sibling))
        nodes = [sha(*nodes[n : n + 2]) for n in range(0, len(nodes), 2)]
        owners = [sum(owners[n : n + 2], []) for n in range(0, len(owners), 2)]
    return nodes[0], paths


def fold(node, path):
    for right, sibling in path:
        node = sha(sibling, node) if right else sha(node, sibling)
    return node


def audited(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r["lang"]].append((r["doc_id"] is not None, r["doc_id"] or 0, row_leaf(r), r))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for t in trees.values():
        t.sort(key=lambda x: x[:3])
    done = {t: climb([x[2] for x in trees[t]]) for t in langs}
    root, above = climb([done[t][0] for t in langs])
    for t, rest in zip(langs, above):
        subroot, paths = done[t]
        for (_, _, leaf, r), path in zip(trees[t], paths):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            got = fold(row_leaf(r, 1) if hit else leaf, path + rest)
            yield r["doc_id"], leaf, subroot, root, sha(*(s for _, s in path + rest)), got, got == root


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_manifest_matches_trees_by_hand(docs):
    got = rows_of(merkle.audit(docs), *COLUMNS)
    assert got == sorted(audited(docs.collect()), key=repr)
    assert {g[-1] for g in got} == {True, False}


def test_manifest_with_blocks_of_four_needs_several_tiers(docs, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 2)
    got = rows_of(merkle.audit(docs), *COLUMNS)
    assert got == sorted(audited(docs.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 15, 16, 17, 31, 64, 65])
def test_manifest_of_one_tree_of_each_size(spark, n, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 2)
    rows = spark.range(n).select(F.lit(None).cast("string").alias("part"), F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    found = merkle.manifest(rows, "part", ["key"]).collect()
    root, paths = climb([sha(str(i)) for i in range(n)])
    assert {r["root"] for r in found} == {r["subroot"] for r in found} == {root}
    assert {r["key"]: [tuple(s) for s in r["path"]] for r in found} == dict(enumerate(paths))


def test_manifest_tells_any_change(docs):
    """A proof verifies the leaf it was made for, and no leaf of a changed row."""
    found = merkle.manifest(merkle.leaves(docs), "lang", ["doc_id"])
    for changed, verified in ((F.col("leaf"), True), (F.sha2("leaf", 256), False)):
        assert {r[0] for r in found.select(merkle.folded(changed, F.col("path")) == F.col("root")).collect()} == {verified}


def test_manifest_of_many_trees_and_of_none(spark, none):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("lang"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    found = merkle.manifest(rows, "lang", ["doc_id"]).select("lang", "subroot", "root").collect()
    assert {r["root"] for r in found} == {climb([sha(str(i)) for i in sorted(range(3000), key=str)])[0]} and len(found) == 3000
    assert all(r["subroot"] == sha(r["lang"]) for r in found)
    assert merkle.audit(none).collect() == []


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def diverged(rows, least=3, ranks=200):
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        lang, terms = whole(r["lang"]), TERM.findall(whole(r["text"]).translate(LOWER))
        counts[lang, whole(r["source"])].update(terms)
        held[lang].update(set(terms))
    kept = {lang: sorted((t for t, n in c.items() if n >= least), key=str.encode) for lang, c in held.items()}

    def shares(count, terms):
        total = sum(count[t] for t in terms)
        return [1 + 10**9 * (count[t] + 1) // (total + len(terms)) for t in terms]

    p = {g: shares(c, kept[g[0]]) for g, c in counts.items()}
    for (lang, source), own in p.items():
        whole_lang = shares(sum((c for g, c in counts.items() if g[0] == lang), Counter()), kept[lang])
        parts = {"pair": [(s, sum((a - b) ** 2 // b for a, b in zip(own, other))) for (x, s), other in p.items() if x == lang and s != source]}
        parts["term"] = [(t, (a - b) ** 2 // b) for t, a, b in zip(kept[lang], own, whole_lang) if a > b and counts[lang, source][t]]
        for part, found in parts.items():
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            for n, (item, value) in enumerate(found if part == "pair" else found[:ranks]):
                yield lang, source, part, item, value, n + 1


RANKED = ("lang", "source", "part", "item", "value", "rank")


@pytest.mark.parametrize("group_block, term_block", [(64, 4096), (2, 5)])
def test_divergences_match_brute_force(docs, monkeypatch, group_block, term_block):
    monkeypatch.setattr(divergence, "GROUP_BLOCK", group_block)
    monkeypatch.setattr(divergence, "TERM_BLOCK", term_block)
    assert rows_of(divergence.divergences(docs), *RANKED) == sorted(diverged(docs.collect()), key=repr)


def test_divergences_of_one_document_each_and_of_none(docs, none):
    assert rows_of(divergence.divergences(docs, least=1, ranks=3), *RANKED) == sorted(diverged(docs.collect(), 1, 3), key=repr)
    assert divergence.divergences(none).collect() == []


def test_shares_of_huge_counts_are_exact(spark):
    rows = spark.createDataFrame([(10**14 - 1, 10**14, 10**7), (0, 10**17, 1)], "n bigint, total bigint, terms bigint")
    got = [r[0] for r in rows.select(divergence._share(F.col("n"), F.col("total"), F.col("terms"))).collect()]
    assert got == [1 + 10**9 * 10**14 // (10**14 + 10**7), 1 + 10**9 // (10**17 + 1)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())


def strings():
    random.seed(3)
    parts = ["a", "b", " ", "  ", "▁", "\n", "é", "é", "😀", "中", "the", " the", "ing", "=", "----", "    ", "\x00", "ا", "1", "<s>", "<0x0A>", "\r", "ﬁ", "　"]
    yield from ("".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(3000))
    yield from ("".join(random.choice("etaoinshrdlu") for _ in range(random.randint(1, 60))) for _ in range(500))
    yield from (c * n for c in " -=a*#" for n in range(70))


def test_pieces_are_the_librarys(library):
    coder, texts = pieces.coder(pieces.default_path()), list(strings())
    ids, bounds = coder.encode([coder.seen(t) for t in texts])
    for n, text in enumerate(texts):
        own = ids[bounds[n] : bounds[n + 1]]
        assert own.tolist() == library.encode(text), text
        assert coder.decode(own) == library.decode(own.tolist()), text


def test_any_ids_decode_as_in_the_library(library):
    random.seed(4)
    coder = pieces.coder(pieces.default_path())
    for n in range(2000):
        ids = [random.randrange(coder.count) if n % 2 else random.choice([*coder.bytes, 28705, 259, 0, 1, 2]) for _ in range(6)]
        assert coder.decode(np.array(ids)) == library.decode(ids), ids


def test_backtracking_finds_what_merging_gives():
    """A vocabulary of its own, in which longest matches are often wrong."""
    coder = pieces.coder(pieces.default_path())
    small = object.__new__(pieces.Coder)
    import ahocorasick

    random.seed(6)
    words = sorted({"".join(random.choice("abc") for _ in range(random.randint(2, 6))) for _ in range(60)} | set("abc"))
    small.order = {w: random.random() for w in words}
    small.text = dict(enumerate(words))
    small.size, small.fit = {i: len(w) for i, w in enumerate(words)}, {}
    small.shorter = {i: next((words.index(w[:n]) for n in range(len(w) - 1, 0, -1) if w[:n] in words), None) for i, w in enumerate(words)}
    small.automaton = ahocorasick.Automaton()
    for i, w in enumerate(words):
        small.automaton.add_word(w, i)
    small.automaton.make_automaton()
    greedy = 0
    for _ in range(2000):
        text = "".join(random.choice("abc") for _ in range(random.randint(1, 40)))
        want = small.merged(text)
        assert [words[i] for i in small.backtrack(text)] == want
        greedy += max((w for w in words if text.startswith(w)), key=len) == want[0]
    assert greedy < 1900 and coder.count == 32_000


def test_piece_digests_match_the_library(docs, none, library, monkeypatch):
    monkeypatch.setattr(pieces, "WINDOW", 1000)
    monkeypatch.setattr(pieces.Coder.windows, "__defaults__", (1000,))

    def want(text):
        ids = library.encode(whole(text))
        return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))

    got = rows_of(pieces.digests(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((r["doc_id"], *want(r["text"])) for r in docs.collect()), key=repr)
    assert pieces.digests(none).collect() == [] and pieces.encoded(none).collect() == []


def test_a_long_text_is_encoded_in_windows(library):
    coder = pieces.coder(pieces.default_path())
    for text in (LONG, "a" * 5000, " " * 3000 + "x", "ab" * 40 + LONG):
        parts = list(coder.windows(text, 300))
        assert "".join(parts) == coder.seen(text)
        assert np.concatenate([coder.encode([p])[0] for p in parts]).tolist() == library.encode(text)


def test_pieces_round_trip(docs):
    got = rows_of(pieces.decoded(pieces.encoded(docs)), "doc_id", "text")
    assert got == rows_of(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", "text")


def test_models_that_rewrite_text_are_refused(tmp_path):
    with open(pieces.default_path(), "rb") as file:
        data = file.read()
    changed = tmp_path / "other.model"
    changed.write_bytes(data + b"\x1a\x05\x12\x03abc")  # a later normalizer message with a character map
    with pytest.raises(ValueError):
        pieces.Model(str(changed))


def correlated(inner, n, seed=0):
    """Unit vectors of 64 components that vary in ``inner`` directions, some drawn towards others."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, inner))
    near = rng.random(n) < 0.1
    x[near] = x[rng.integers(0, n, near.sum())] + 0.25 * rng.normal(size=(near.sum(), inner))
    return vectors.unit(x @ rng.normal(size=(inner, 64)))


@pytest.mark.parametrize("inner, recall, least", [(6, vectors.RECALL, 0.99), (10, vectors.RECALL, 0.99), (10, 2.0, 1.0), (64, vectors.RECALL, 0.99)])
def test_a_thousand_lists_miss_few_links_of_correlated_vectors(spark, inner, recall, least):
    n = 12_000 if inner > 6 else 6_000
    x = correlated(inner, n)
    want = np.concatenate([((x[a : a + 1000] @ x.T) >= 0.9).sum(axis=1) - 1 for a in range(0, n, 1000)])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(4)
    found = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(rows, recall=recall, per_list=n // 1000).collect()}
    got = np.array([found[i] for i in range(n)])
    assert (got <= want).all() and want.sum() > 1000
    assert got.sum() >= least * want.sum(), got.sum() / want.sum()
