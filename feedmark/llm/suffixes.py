"""Repeated byte strings, found by a distributed merge sort of suffixes that knows common prefixes.

Only suffixes at anchors are sorted. An anchor is a place whose string of SEED bytes has the least
hash among the places of some window of LENGTH bytes, so equal windows have their anchors at equal
offsets, and about one byte in 137 is an anchor. An anchor whose seed occurs once cannot lie
in a repeated window; the others' suffixes are sorted, together with what stands before them.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedmark.llm.common import numbered, table, whole_text
from feedmark.llm.tokens import slices
from feedmark.session import stage

LENGTH = 400
SEED = 128
HEAD = 8  # first bytes of a suffix, by which the sort is cut into ranges
EVERY = 64  # one anchor in so many tells where to cut
RANGE = 100_000  # anchors in a range, on average
HOT = 20_000  # anchors of one seed; if it has more, its windows are counted over all tasks
SPLIT = 4  # parts of a block of offsets
RUN = 50_000  # distinct suffixes that a task sorts before it sends them
PIECE = 1 << 20  # bytes hashed at once
_BASE = 0x9E3779B97F4A7C15 | 1
_TOP = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n or more."""
    held = max(_POWERS, default=0)
    if held < n:
        _POWERS.clear()
        held = 1 << max(16, (n - 1).bit_length())
        one = np.ones(1, np.uint64)
        made = [np.concatenate([one, np.full(held - 1, b, np.uint64)]).cumprod(dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 2**64))]
        _POWERS[held] = tuple(made)
    up, down = _POWERS[held]
    return up[:n], down[:n]


def seed_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of each string of ``size`` bytes."""
    up, down = _powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data.astype(np.uint64) * up + up, dtype=np.uint64)])
    return _mixed((sums[size:] - sums[:-size]) * down[: len(sums) - size])


def _sliding(x: np.ndarray, w: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of each w neighbours."""
    n = len(x) - w + 1
    fill = np.full(-len(x) % w, _TOP if best is np.minimum else 0, np.uint64)
    blocks = np.concatenate([x, fill]).reshape(-1, w)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n], ahead[w - 1 : w - 1 + n])


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) in joined texts that begin at ``bounds``. Ties are anchors all.

    One long text is taken in pieces that overlap by a window, so that each window lies in one.
    """
    if len(bounds) == 2 and len(data) > 2 * PIECE:
        starts = range(0, len(data), PIECE)
        parts = [data[s : s + PIECE + length] for s in starts]
        found = [anchors(p, np.array([0, len(p)]), length, seed) for p in parts]
        place, first = np.unique(np.concatenate([p + s for s, (p, _) in zip(starts, found)]), return_index=True)
        return place, np.concatenate([h for _, h in found])[first]
    w = length - seed + 1
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = seed_hashes(data, seed)
    for end in bounds[1:-1]:
        hashes[max(0, end - seed + 1) : end] = _TOP  # seeds do not cross texts
    least = _sliding(hashes, w, np.minimum)
    edge = np.zeros(w - 1, np.uint64)
    most = _sliding(np.concatenate([edge, least, edge]), w, np.maximum)
    place = np.flatnonzero((most == hashes) & (hashes != _TOP))
    return place, hashes[place]


def _key_columns(docs: DataFrame) -> DataFrame:
    """A text is found again by doc_id and a hash; rows alike in both are alike in what is removed."""
    return docs.select("doc_id", F.xxhash64(whole_text()).alias("text_hash"), whole_text().alias("text"))


def anchor_table(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """row_id, doc_id, text_hash, places, hashes, heads: the anchors of texts that have any."""

    def run(batches):
        for batch in batches:
            for start, stop in slices(batch.column("text"), PIECE):
                part = batch.slice(start, stop - start)
                texts = pa.concat_arrays([part.column("text").cast(pa.large_binary())])
                _, offsets, raw = texts.buffers()
                bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
                data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.empty(0, np.uint8)
                bounds = bounds - bounds[0]
                place, hashes = anchors(data, bounds, length, seed)
                at = np.searchsorted(place, bounds)
                long = np.flatnonzero((np.diff(bounds) >= length) & (np.diff(at) > 0))
                if not len(long):
                    continue
                rows = [(place[at[i] : at[i + 1]] - bounds[i], hashes[at[i] : at[i + 1]]) for i in long]
                some = [place[at[i] : at[i + 1]][hashes[at[i] : at[i + 1]] % EVERY == 0] for i in long]
                kept = part.select(["row_id", "doc_id", "text_hash"]).take(pa.array(long))
                arrays = [
                    *kept.columns,
                    pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1].astype(np.int64) for r in rows], pa.list_(pa.int64())),
                    pa.array([[_head(data[p : p + HEAD].tobytes()) for p in s] for s in some], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["row_id", "doc_id", "text_hash", "places", "hashes", "heads"])

    schema = "row_id bigint, doc_id bigint, text_hash bigint, places array<int>, hashes array<bigint>, heads array<bigint>"
    return numbered(_key_columns(docs)).select("row_id", "doc_id", "text_hash", "text").mapInArrow(run, schema)


def _head(suffix: bytes) -> int:
    """Sorts as the first bytes do."""
    return int.from_bytes(suffix[:HEAD].ljust(HEAD, b"\0"), "big") - 2**63


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Of two strings that agree in the first ``known`` bytes, which are not read."""
    n = min(len(a), len(b))
    if known >= n:
        return n
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n if not differ else n - (differ.bit_length() + 7) // 8


class Run:
    """Sorted suffixes in front coding, each with what stands before it, backwards, and where it occurs."""

    PARTS = (("shared", "<u2"), ("sizes", "<u2"), ("before", "<u2"), ("times", "<u4"), ("docs", "<i8"), ("none", "u1"), ("texts", "<i8"), ("places", "<i8"))

    @classmethod
    def pack(cls, entries: list[tuple[bytes, bytes, list[tuple]]]) -> bytes:
        """Of sorted (suffix, before, occurrences (doc_id, text_hash, place)), the suffixes without what they share with the last."""
        shared, last, rest = [], b"", []
        for suffix, _, _ in entries:
            shared.append(common_prefix(last, suffix))
            rest.append(suffix[shared[-1] :])
            last = suffix
        where = [o for _, _, found in entries for o in found]
        columns = (
            shared,
            [len(s) for s, _, _ in entries],
            [len(b) for _, b, _ in entries],
            [len(f) for _, _, f in entries],
            [o[0] or 0 for o in where],
            [o[0] is None for o in where],
            [o[1] for o in where],
            [o[2] for o in where],
        )
        head = np.array([len(entries), len(where)], "<i8").tobytes()
        body = b"".join(np.array(c, kind).tobytes() for c, (_, kind) in zip(columns, cls.PARTS))
        return head + body + b"".join(rest) + b"".join(b for _, b, _ in entries)

    def __init__(self, raw: bytes):
        n, m = np.frombuffer(raw, "<i8", 2)
        at = 16
        for i, (name, kind) in enumerate(self.PARTS):
            column = np.frombuffer(raw, kind, n if i < 4 else m, at)
            at += column.nbytes
            setattr(self, name, column)
        self.n, self.raw = int(n), raw
        own = (self.sizes - self.shared).astype(np.int64)
        self.rest = at + np.concatenate([[0], np.cumsum(own)])
        self.lead = self.rest[-1] + np.concatenate([[0], np.cumsum(self.before.astype(np.int64))])
        self.found = np.concatenate([[0], np.cumsum(self.times.astype(np.int64))])

    def suffixes(self):
        last = b""
        rest, shared = self.rest.tolist(), self.shared.tolist()
        for i in range(self.n):
            last = last[: shared[i]] + self.raw[rest[i] : rest[i + 1]]
            yield last, shared[i]

    def left(self, i: int) -> bytes:
        return self.raw[self.lead[i] : self.lead[i + 1]]


def merge(runs: list[Run]):
    """(suffix, common prefix with the last one, run, place in it) in sorted order, by a tree of losers.

    With each contender goes what it shares with the string last put out. Of two the one that
    shares more is the smaller; only if both share as much are bytes compared, from there on.
    """
    k = len(runs)
    streams = [run.suffixes() for run in runs]
    heads, counts = [b""] * k, [-1] * k
    gone = -1

    def advance(r: int) -> int:
        got = next(streams[r], None)
        if got is None:
            return gone
        heads[r] = got[0]
        counts[r] += 1
        return got[1]

    loser, shared = [-1] * k, [0] * k

    def play(r: int, known: int, at: int) -> tuple[int, int]:
        """The winner at a node; the loser stays there with what it shares with the winner."""
        other, theirs = loser[at], shared[at]
        if known == theirs and known != gone:
            agree = common_prefix(heads[r], heads[other], known)
            if heads[r][agree : agree + 1] <= heads[other][agree : agree + 1]:
                shared[at] = agree
                return r, known
            loser[at], shared[at] = r, agree
            return other, theirs
        if known >= theirs:
            return r, known
        loser[at], shared[at] = r, known
        return other, theirs

    top, known = 0, gone
    for r in range(k):
        now, have, at = r, advance(r) if runs[r].n else gone, (r + k) >> 1
        have = min(have, 0)
        while at > 0 and loser[at] >= 0:
            now, have = play(now, have, at)
            at >>= 1
        if at > 0:
            loser[at], shared[at] = now, have
        else:
            top, known = now, have
    while known != gone:
        yield heads[top], known, top, counts[top]
        now, have, at = top, advance(top), (top + k) >> 1
        while at > 0:
            now, have = play(now, have, at)
            at >>= 1
        top, known = now, have


def _range_of(cuts: list[int], suffixes: list[bytes], seed: int) -> np.ndarray:
    """The range of each suffix; a head at which several cuts fall is spread over as many ranges by the seeds."""
    if not cuts:
        return np.zeros(len(suffixes), int)
    heads = [_head(s) for s in suffixes]
    low, high = (np.searchsorted(cuts, heads, side=side) for side in ("left", "right"))
    for i in np.flatnonzero(high - low > 1):
        high[i] -= zlib.crc32(suffixes[i][:seed]) % (high[i] - low[i])
    return high


def _runs(cuts: list[int], length: int, seed: int):
    """Sorted runs for each range of suffixes, from texts and the places of their anchors."""
    ahead = length - seed

    def send(held: dict):
        entries = sorted((suffix, before, found) for (suffix, before), found in held.items())
        to = _range_of(cuts, [e[0] for e in entries], seed)
        order = np.argsort(to, kind="stable")
        entries, to = [entries[i] for i in order], to[order]
        at = np.searchsorted(to, np.arange(len(cuts) + 2))
        some = [i for i in range(len(cuts) + 1) if at[i + 1] > at[i]]
        runs = [Run.pack(entries[at[i] : at[i + 1]]) for i in some]
        for low in range(0, len(some), 64):
            yield pa.RecordBatch.from_arrays([pa.array(some[low : low + 64], pa.int32()), pa.array(runs[low : low + 64], pa.binary())], names=["range", "run"])

    def run(batches):
        held: dict = {}
        for batch in batches:
            for doc, text_hash, text, places in zip(*(batch.column(c) for c in ("doc_id", "text_hash", "text", "places"))):
                if not places.is_valid:
                    continue
                raw, doc, text_hash = text.as_buffer().to_pybytes(), doc.as_py(), text_hash.as_py()
                for p in places.values.to_numpy().tolist():
                    if p + seed > len(raw):
                        continue
                    before = raw[max(0, p - ahead) : p][::-1]
                    held.setdefault((raw[p : p + length], before), []).append((doc, text_hash, p))
                if len(held) >= RUN:
                    yield from send(held)
                    held = {}
        if held:
            yield from send(held)

    return run


def repeated_offsets(suffixes: list[bytes], shared: np.ndarray, befores: list[bytes], times: np.ndarray, length: int = LENGTH, seed: int = SEED) -> np.ndarray:
    """For each sorted suffix and each offset o from 0 to length - seed: whether the window that
    begins o bytes before it occurs elsewhere. Windows are equal if the suffixes share length - o
    bytes and the o bytes before them are equal.
    """
    n, ahead = len(suffixes), length - seed
    sizes, leads = np.array([len(s) for s in suffixes]), np.array([len(b) for b in befores])
    group = np.cumsum(shared < seed)
    order = sorted(range(n), key=lambda i: (group[i], befores[i]))
    padded = np.frombuffer(b"".join(befores[i].ljust(ahead, b"\0") for i in order), np.uint8).reshape(n, ahead)
    same = np.zeros(n, dtype=np.int64)
    if n > 1:
        differ = padded[1:] != padded[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), ahead)
        lead = leads[order]
        same[1:] = np.minimum(first, np.minimum(lead[1:], lead[:-1]))
        same[1:][group[order][1:] != group[order][:-1]] = -1
    same[0] = -1
    back = np.empty(n, dtype=np.int64)
    back[order] = np.arange(n)
    out = np.zeros((n, ahead + 1), dtype=bool)
    for o in range(ahead + 1):
        right = np.cumsum(shared < length - o)
        left = np.cumsum(same < o)[back]
        valid = (sizes >= length - o) & (leads >= o)
        key = np.where(valid, right * (n + 1) + left, -1 - np.arange(n))
        ranked = np.argsort(key, kind="stable")
        equal = key[ranked][1:] == key[ranked][:-1]
        twice = np.zeros(n, dtype=bool)
        twice[ranked[1:][equal]] = True
        twice[ranked[:-1][equal]] = True
        out[:, o] = valid & (twice | (times > 1))
    return out


def _resolve(length: int, seed: int):
    """Merges a range's runs and tells which bytes around each anchor are repeated."""
    ahead = length - seed

    def run(group):
        runs = [Run(raw) for raw in group.run]
        found: list[list] = [[], [], [], []]
        block: list[tuple] = []

        def close():
            times = np.array([runs[r].times[i] for _, _, r, i in block], dtype=np.int64)
            if len(block) > 1 or times[0] > 1:
                pending.append((list(block), times))
            block.clear()

        def settle():
            flat = [e for b, _ in pending for e in b]
            if not flat:
                return
            times = np.concatenate([t for _, t in pending])
            shared = np.array([e[1] for e in flat], dtype=np.int64)
            shared[np.cumsum([0] + [len(b) for b, _ in pending[:-1]])] = 0
            repeated = repeated_offsets([e[0] for e in flat], shared, [runs[r].left(i) for _, _, r, i in flat], times, length, seed)
            edges = np.diff(np.pad(repeated.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, low = np.nonzero(edges == 1)
            high = np.nonzero(edges == -1)[1] - 1
            for e, a, b in zip(row.tolist(), low.tolist(), high.tolist()):
                _, _, r, i = flat[e]
                some = slice(runs[r].found[i], runs[r].found[i + 1])
                place = runs[r].places[some]
                found[0].append(np.where(runs[r].none[some], -1, runs[r].docs[some]))
                found[1].append(runs[r].texts[some])
                found[2].append(place - b)
                found[3].append(place - a + length)
                gone.append(runs[r].none[some])
            pending.clear()

        pending: list[tuple] = []
        gone: list[np.ndarray] = []
        count = 0
        for suffix, shared, r, i in merge(runs):
            if shared < seed and block:
                count += len(block)
                close()
                if count >= RUN:
                    settle()
                    count = 0
            block.append((suffix, shared, r, i))
        if block:
            close()
        settle()
        if not gone:
            return pd.DataFrame({c: pd.Series([], dtype="Int64") for c in ("doc_id", "text_hash", "start", "stop")})
        columns = [np.concatenate(c) for c in found]
        doc = pd.array(columns[0], dtype="Int64")
        doc[np.concatenate(gone).astype(bool)] = pd.NA
        return pd.DataFrame({"doc_id": doc, "text_hash": columns[1], "start": columns[2], "stop": columns[3]})

    return run


def _contexts(length: int, seed: int, hot: np.ndarray):
    """What stands around each anchor of a seed in ``hot``, as far as windows reach."""
    ahead = length - seed
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["doc_id", "text_hash", "place", "lead", "context"]

    def rows(part):
        for doc, text_hash, text in zip(*(part.column(c) for c in ("doc_id", "text_hash", "text"))):
            raw = text.as_buffer().to_pybytes()
            place, hashes = anchors(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), length, seed)
            for p in place[np.isin(hashes.astype(np.int64), hot)].tolist():
                yield doc.as_py(), text_hash.as_py(), p, min(p, ahead), raw[max(0, p - ahead) : p + length]

    def run(batches):
        for batch in batches:
            found = rows(batch)
            while some := list(itertools.islice(found, RUN)):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*some), kinds)], names=names)

    return run


def _blocks(length: int, seed: int, last: int, width: int):
    """id, first, low, high, core, hull: of each block of ``width`` offsets in the blocks of ``last`` that begin at ``firsts``.

    low to high are its offsets whose windows lie in the text; core and hull are digests of the bytes
    common to the windows of the block, and of all bytes of those in the text.
    """
    ahead = length - seed

    def rows(i, lead, context, firsts):
        for start in firsts:
            stop = min(start + last, ahead + 1)
            for first in range(start, stop, width):
                end = min(first + width, stop) - 1
                low, high = max(first, length - (len(context) - lead)), min(end, lead)
                if low <= high:
                    core = b"%d %d " % (first, end) + context[lead - first : lead + length - end]
                    hull = b"%d %d " % (low, high) + context[lead - high : lead + length - low]
                    yield i, first, low, high, *(hashlib.sha256(x).digest()[:16] for x in (core, hull))

    def run(batches):
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [r for entry in zip(*(part.column(c).to_pylist() for c in ("id", "lead", "context", "firsts"))) for r in rows(*entry)]
                if found:
                    arrays = [pa.array(c, kind) for c, kind in zip(zip(*found), kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["id", "first", "low", "high", "core", "hull"])

    return run


def _again(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with the least id of those equal in ``key``, null if there is one only. Very common keys, which are few, are not exchanged."""
    groups = rows.groupBy(key).agg(F.count("*").alias("n"), F.min("id").alias("least")).where("n > 1")
    common = groups.where(F.col("n") > HOT).select(F.col(key).alias("common"), F.col("least").alias("common_id"))
    others = groups.where(F.col("n") <= HOT).select(F.col(key).alias("other"), F.col("least").alias("other_id"))
    rows = rows.join(F.broadcast(common), F.col(key) == F.col("common"), "left")
    rows = rows.withColumn("at", F.when(F.col("common_id").isNull(), F.col(key)).otherwise(F.col("id").cast("string").cast("binary")))
    rows = rows.join(others, F.col("at") == F.col("other"), "left")
    return rows.withColumn(f"{key}_id", F.coalesce("common_id", "other_id")).drop("common", "common_id", "other", "other_id", "at")


def counted(contexts: DataFrame, length: int, seed: int) -> DataFrame:
    """doc_id, text_hash, start, stop: what is repeated around anchors of which very many share a seed.

    Blocks of offsets are cut into SPLIT a round. A block whose core occurs once holds no repeated
    window, one whose hull occurs again only repeated ones; the others are cut, at last to single
    windows, together with one of each equal hull, whose windows others may share. Digests (128 bits of SHA-256) are counted, each task's first, so no seed, and no
    window, gathers more than narrow rows in a task.
    """
    width = 1
    while width < length - seed + 1:
        width *= SPLIT  # a power, so that no block reaches into the next one, whose windows would count twice
    last = width
    todo = contexts.withColumn("firsts", F.array(F.lit(0)))
    whole = []
    while True:
        schema = "id bigint, first int, low int, high int, core binary, hull binary"
        rows = stage(todo.select("id", "lead", "context", "firsts").mapInArrow(_blocks(length, seed, last, width), schema), "blocks")
        rows = _again(_again(rows, "core").where("core_id is not null"), "hull").withColumnRenamed("hull_id", "witness")
        rows = stage(rows.select("id", "first", "low", "high", "witness"), "counted")
        whole.append(rows.where("witness is not null").select("id", "low", "high"))
        if width == 1 or rows.where("witness is null").isEmpty():
            break
        open_ = rows.where("witness is null or witness = id")
        todo = contexts.join(open_.groupBy("id").agg(F.collect_list("first").alias("firsts")), "id")
        last, width = width, width // SPLIT
    found = functools.reduce(DataFrame.unionByName, whole).join(contexts.select("id", "doc_id", "text_hash", "place"), "id")
    return found.select("doc_id", "text_hash", (F.col("place") - F.col("high")).alias("start"), (F.col("place") - F.col("low") + length).alias("stop"))


def _united(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    first = np.flatnonzero(np.concatenate([[True], starts[1:] > stops[:-1]]))
    return list(zip(starts[first].tolist(), stops[np.concatenate([first[1:] - 1, [len(starts) - 1]])].tolist()))


def spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, text, starts, stops: byte ranges covered by strings of ``length`` bytes that also start elsewhere."""
    docs = docs.select("doc_id", "text")
    found = stage(anchor_table(docs, length, seed), "anchors")
    each = found.select("row_id", F.explode(F.arrays_zip("places", "hashes")).alias("a")).select("row_id", "a.places", "a.hashes")
    seeds = stage(each.groupBy("hashes").agg(F.count("*").alias("n")).where("n > 1").select(F.col("hashes").alias("again"), "n"), "seeds")
    twice = seeds.where(F.col("n") <= HOT).drop("n")
    held = each.join(twice, F.col("hashes") == F.col("again")).groupBy("row_id").agg(F.collect_list("places").alias("places"))
    held = held.join(found.select("row_id", "doc_id", "text_hash"), "row_id")
    # rows alike in both have the same places
    held = held.groupBy("doc_id", "text_hash").agg(F.any_value("places").alias("places"))
    n = found.agg(F.sum(F.size("places")).alias("n")).first()["n"] or 0
    parts = max(1, math.ceil(n / RANGE))
    heads = found.select(F.explode("heads").alias("head"))
    shares = [(i + 1) / parts for i in range(parts - 1)]
    cuts = heads.agg(F.percentile_approx("head", shares, 10_000).alias("cuts")).first()["cuts"] if shares else None  # a number for each range
    cuts = sorted(cuts or [])

    whole = _key_columns(docs)

    def beside(other: DataFrame) -> DataFrame:
        """Both times alike, so that the texts are exchanged once."""
        other = other.withColumnsRenamed({"doc_id": "id", "text_hash": "hash"})
        return whole.join(other, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left").drop("id", "hash")

    runs = beside(held).mapInArrow(_runs(cuts, length, seed), "range int, run binary")
    ranges = runs.groupBy("range").applyInPandas(_resolve(length, seed), "doc_id bigint, text_hash bigint, start bigint, stop bigint")
    hot = [r["again"] for r in seeds.where(F.col("n") > HOT).collect()]  # one number for HOT anchors at most
    if hot:
        # texts are read again, not exchanged
        schema = "doc_id bigint, text_hash bigint, place bigint, lead int, context binary"
        around = whole.mapInArrow(_contexts(length, seed, np.array(hot)), schema).withColumn("id", F.monotonically_increasing_id())
        ranges = ranges.unionByName(counted(stage(around, "contexts"), length, seed))
    ranges = ranges.groupBy("doc_id", "text_hash").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    return beside(ranges)


def removed(docs: DataFrame, length: int = LENGTH, seed: int = SEED, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes): one row per row of ``docs``.

    Each byte covered by a string of ``length`` bytes that also starts anywhere else, the same
    document included, goes. Matches are judged on the input and never cross documents. A null text
    is an empty one, texts shorter than ``length`` bytes stay whole, repeated rows repeat each
    other's text, null doc_ids are as any other, other columns are ignored, and an empty table
    gives no rows.
    """

    def rows(batch):
        for text, starts, stops in zip(*(batch.column(c) for c in ("text", "starts", "stops"))):
            raw, ranges = text.as_buffer().to_pybytes(), []
            if starts.is_valid and len(starts):
                ranges = _united(starts.values.to_numpy(), stops.values.to_numpy())
            edges = [0, *(e for r in ranges for e in r), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
            yield len(raw), len(raw) - len(kept), len(ranges), hashlib.sha256(kept).hexdigest(), *([kept] if keep_text else [])

    def run(batches):
        for batch in batches:
            for start, stop in slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows(part)), kinds)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_text else [])]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * keep_text
    return spans(docs, length, seed).select("doc_id", "text", "starts", "stops").mapInArrow(run, schema)


def query(spark, sf_dir):
    """The digests of what stays, and whether the text repeats anything."""
    return removed(table(spark, sf_dir, "documents")).withColumn("repeats", F.col("n_removed") > 0)
