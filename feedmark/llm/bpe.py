"""Encoding and decoding with byte-level BPE; long texts as a tree of halves."""

from __future__ import annotations

import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedmark.llm.common import numbered, table, whole_text
from feedmark.llm.tokens import default_path, encoder, slices

LEAF = 32_768  # code points that one task encodes in one go
WINDOW = 32  # ids on either side of a join, to begin with
AGREE = 4  # ids at an edge inside an unsplit run that must come out as they were


def _kind(c: str) -> str:
    """The classes that the pre-tokenizer tells apart: letters, numbers, white space, others."""
    if c.isspace() and c not in "\x1c\x1d\x1e\x1f":
        return "S"
    return k if (k := unicodedata.category(c)[0]) in "LN" else "O"


def always_cut(before: str, after: str, next_after: str) -> bool:
    """Whether the pre-tokenizer cuts here whatever stands farther away."""
    if after == " " and next_after and _kind(next_after) != "S":
        return True
    if _kind(before) == "S" or "'" in (before, after):
        return False  # white space is cut by what follows it, and apostrophes take letters along
    return _kind(before) != _kind(after)


def _edges(enc, ids: np.ndarray) -> tuple[str, list[int | None]]:
    """The text of ``ids``, and for each id and the end the code point where it begins, None inside one."""
    raw = enc.decode_bytes(ids)
    text = raw.decode("utf-8", "ignore")  # the last character may be cut off
    end = len(text.encode())
    first = (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80
    place = np.concatenate([[0], np.cumsum(first)])
    at = np.concatenate([[0], np.cumsum(enc.lengths[ids])])
    return text, [int(place[i]) if i == end or i < end and first[i] else None for i in at]


def join(enc, left: np.ndarray, right: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The ids of two texts put together, from the ids of each.

    The ids around the join are encoded anew. An edge of the window holds if it is an end of the
    whole, if the pre-tokenizer always cuts there, or if it lies in the very run of characters that
    crosses the join and the first ids inwards come out as they were: neighbours in a BPE encoding
    only depend on each other, so what follows outwards stays as well. Else the window doubles.
    """
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    while True:
        a, z = max(0, len(left) - window), min(len(right), window)
        ltext, lat = _edges_from(enc, left, a)
        rtext, rat = _edges(enc, right[: z + 8])
        found = _try(enc, left, right, a, z, ltext, lat, rtext, rat)
        if found is not None:
            return found
        if a == 0 and z == len(right):
            return enc.encode_one(ltext + rtext)
        window *= 2


def _edges_from(enc, left, a):
    while a > 0 and enc.table[left[a]] and (enc.table[left[a]][0] & 0xC0) == 0x80:
        a -= 1  # begin with a whole character
    return _edges(enc, left[a:])


def _try(enc, left, right, a, z, ltext, lat, rtext, rat):
    base = len(left) - (len(lat) - 1)  # the id that ltext begins with
    start = 0 if base == 0 else None
    for i in range(len(lat) - 2, -1, -1):
        p = lat[i]
        if p is not None and 0 < p < len(ltext) - 1 and always_cut(ltext[p - 1], ltext[p], ltext[p + 1]):
            start = i
            break
    stop = len(right) if z == len(right) else None
    for j in range(1, z + 1):
        p = rat[j] if j < len(rat) else None
        if p is not None and 0 < p < len(rtext) - 1 and always_cut(rtext[p - 1], rtext[p], rtext[p + 1]):
            stop = j
            break
    soft_left, soft_right = start is None, stop is None
    if soft_left:
        start = 0
    if soft_right:
        whole = [j for j in range(z, 0, -1) if rat[j] is not None]
        if not whole:
            return None
        stop = whole[0]
    end = rat[stop] if stop < len(rat) else len(rtext)
    if end is None:
        return None
    text = ltext[lat[start] :] + rtext[:end]
    middle = len(ltext) - lat[start]
    made = enc.encode_one(text)
    if soft_left or soft_right:
        spans = [span for _, span in enc.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        if soft_left and not (spans[0][1] > middle and np.array_equal(made[:AGREE], left[base : base + AGREE]) and base + AGREE <= len(left)):
            return None
        if soft_right and not (spans[-1][0] < middle and np.array_equal(made[-AGREE:], right[stop - AGREE : stop]) and stop >= AGREE):
            return None
    return np.concatenate([left[: base + start], made, right[stop:]])


def tree(enc, parts: list[np.ndarray], window: int = WINDOW) -> np.ndarray:
    """Joins neighbours level by level."""
    while len(parts) > 1:
        pairs = [join(enc, parts[i], parts[i + 1], window) for i in range(0, len(parts) - 1, 2)]
        parts = pairs + parts[len(parts) - len(parts) % 2 :]
    return parts[0] if parts else np.empty(0, np.uint32)


def _as_bytes(enc, rows: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array([ids.astype("<u4").tobytes() for ids in rows], pa.binary())]


def _as_digests(enc, rows: list[np.ndarray]) -> list[pa.Array]:
    """Of each row's ids, and of what they decode to."""
    said = (",".join(map(str, ids.tolist())).encode() for ids in rows)
    return [
        pa.array([len(ids) for ids in rows], pa.int64()),
        pa.array([hashlib.sha256(x).hexdigest() for x in said], pa.string()),
        pa.array([hashlib.sha256(enc.decode(ids).encode()).hexdigest() for ids in rows], pa.string()),
    ]


IDS = ("ids binary", _as_bytes)
DIGESTS = ("n_tokens bigint, ids_sha256 string, decoded_sha256 string", _as_digests)


def _coded(docs: DataFrame, path: str | None, leaf: int, told) -> DataFrame:
    """row_id, doc_id and the columns ``told`` makes of the ids, in the worker that has them."""
    path = path or default_path()
    columns, make = told
    names = ["row_id", "doc_id", *(c.split()[0] for c in columns.split(", "))]
    rows = numbered(docs.select("doc_id", whole_text().alias("text")))
    special = F.lit(False)
    for content in encoder(path).special:
        special = special | F.contains("text", F.lit(content))
    rows = rows.withColumn("long", (F.length("text") > leaf) & ~special)
    schema = f"row_id bigint, doc_id bigint, {columns}"
    short = rows.where("not long").select("row_id", "doc_id", "text").mapInArrow(_encode_rows(path, make, names), schema)
    parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{leaf}}}"), F.lit(0))
    leaves = rows.where("long").select("row_id", "doc_id", F.posexplode(parts).alias("leaf", "text"))
    as_ids = _encode_rows(path, _as_bytes, ["row_id", "doc_id", "leaf", "ids"])
    coded = leaves.repartition("row_id", "leaf").mapInArrow(as_ids, "row_id bigint, doc_id bigint, leaf int, ids binary")

    def joined(group):
        group, enc = group.sort_values("leaf"), encoder(path)
        ids = tree(enc, [np.frombuffer(x, dtype="<u4") for x in group.ids])
        made = pa.table([pa.array(group.row_id[:1]), pa.array(group.doc_id[:1].astype("Int64")), *make(enc, [ids])], names=names)
        return made.to_pandas()

    return short.unionByName(coded.groupBy("row_id").applyInPandas(joined, schema))


def _encode_rows(path: str, make, names: list[str]):
    """Replaces the last column, text, by what is made of its ids."""

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            texts = batch.column("text")
            for start, stop in slices(texts):
                ids, bounds = enc.encode(texts.slice(start, stop - start))
                made = make(enc, [ids[a:b] for a, b in zip(bounds, bounds[1:])])
                rest = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*rest.columns[:-1], *made], names=names)

    return run


def encoded(docs: DataFrame, path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """row_id, doc_id, ids (little-endian unsigned 32-bit): one row per row of ``docs``.

    Texts up to ``leaf`` code points are encoded where they lie. Longer ones are cut blindly into
    leaves, the leaves are encoded in parallel on any executor, and the leaves of one document are
    joined as a tree; only long texts move. A long text that holds an added token's string is
    encoded in one piece. A null text is an empty text with no ids, null and repeated doc_ids pass
    through row by row, other columns are ignored, and an empty table gives no rows.
    """
    return _coded(docs, path, leaf, IDS)


def digests(docs: DataFrame, path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded as by ``encoded``, and decoded again."""
    return _coded(docs, path, leaf, DIGESTS).drop("row_id")


def decoded(coded: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``encoded`` with text in place of ids; bytes that are no UTF-8 become U+FFFD."""
    path = path or default_path()

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                text = enc.decode(np.frombuffer(one.column("ids")[0].as_py(), dtype="<u4"))
                yield pa.RecordBatch.from_arrays([one.column("row_id"), one.column("doc_id"), pa.array([text], pa.string())], names=["row_id", "doc_id", "text"])

    return coded.select("row_id", "doc_id", "ids").mapInArrow(run, "row_id bigint, doc_id bigint, text string")


def query(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
