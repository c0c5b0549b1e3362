"""Token ids in binary files of patched frame-of-reference blocks."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from feedmark.llm.common import table, whole_text
from feedmark.llm.tokens import default_path, encoder, slices
from feedmark.session import new_folder

MAGIC = b"PFR1"
BLOCK = 128
PERCENTILE = 0.9  # of a block's values fit its width, the others are exceptions
END = 0
_HEAD = struct.Struct("<4sIQI")


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """Block starts (unsigned 32-bit, one more than blocks), then the blocks.

    A block is its least id (32 bits), a width and a number of exceptions (8 bits each), the ids
    less the least one in ``width`` bits each, low bits first, then the exceptions' places (8 bits)
    and whole differences (32 bits). The last block is filled up with its last id.
    """
    n = len(ids)
    if not n:
        return struct.pack("<I", 0)
    rows = np.concatenate([ids, np.full(-n % BLOCK, ids[-1], ids.dtype)]).astype(np.uint32).reshape(-1, BLOCK)
    least = rows.min(axis=1)
    over = rows - least[:, None]
    bits = np.frexp(over.astype(np.float64))[1]  # 0 for 0
    width = np.sort(bits, axis=1)[:, int(np.ceil(percentile * BLOCK)) - 1]
    odd = bits > width[:, None]
    odds = odd.sum(axis=1)
    packed = BLOCK // 8 * width
    sizes = 6 + packed + 5 * odds
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], dtype=np.uint8)
    at = starts[:-1]
    out[at[:, None] + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[at + 4], out[at + 5] = width, odds
    for w in np.unique(width[width > 0]):
        some = np.flatnonzero(width == w)
        kind, size = _word(w)  # what an exception loses here is stored with it
        flags = np.unpackbits(over[some].astype(kind).view(np.uint8).reshape(len(some), BLOCK, size), axis=2, bitorder="little")
        made = np.packbits(flags[:, :, :w].reshape(len(some), -1), axis=1, bitorder="little")
        out[at[some][:, None] + 6 + np.arange(made.shape[1])] = made
    row, column = np.nonzero(odd)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(odds) - odds, odds)
    places = at[row] + 6 + packed[row] + nth
    out[places] = column
    values = at[row] + 6 + packed[row] + odds[row] + 4 * nth
    out[values[:, None] + np.arange(4)] = over[row, column].astype("<u4").view(np.uint8).reshape(-1, 4)
    return starts.astype("<u4").tobytes() + out.tobytes()


def _word(width: int) -> tuple[str, int]:
    return ("<u2", 2) if width <= 16 else ("<u4", 4)


def unpack(raw: bytes, n: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` of n; only the blocks that hold them are read, by way of the index."""
    last = n if last is None else min(last, n)
    if first >= last:
        return np.empty(0, np.uint32)
    blocks = -(-n // BLOCK)
    low, high = first // BLOCK, -(-last // BLOCK)
    starts = np.frombuffer(raw, "<u4", blocks + 1)[low:high].astype(np.int64)
    data = np.frombuffer(raw, np.uint8, offset=4 * (blocks + 1))
    least = data[starts[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
    width, odds = data[starts + 4].astype(np.int64), data[starts + 5].astype(np.int64)
    over = np.zeros((high - low, BLOCK), dtype=np.uint32)
    for w in np.unique(width[width > 0]):
        some = np.flatnonzero(width == w)
        flags = np.unpackbits(data[starts[some][:, None] + 6 + np.arange(BLOCK // 8 * w)], axis=1, bitorder="little")
        kind, size = _word(w)
        wide = np.zeros((len(some), BLOCK, 8 * size), dtype=np.uint8)
        wide[:, :, :w] = flags.reshape(len(some), BLOCK, w)
        over[some] = np.packbits(wide, axis=2, bitorder="little").view(kind)[:, :, 0]
    row = np.repeat(np.arange(high - low), odds)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(odds) - odds, odds)
    body = starts[row] + 6 + BLOCK // 8 * width[row]
    values = body + odds[row] + 4 * nth
    over[row, data[body + nth]] = data[values[:, None] + np.arange(4)].copy().view("<u4")[:, 0] if len(row) else 0
    return (over + least[:, None]).reshape(-1)[first - low * BLOCK : last - low * BLOCK]


@dataclass
class TokenFile:
    """A file's documents in order: ids of document i are ``ids[bounds[i]:bounds[i + 1]]``."""

    doc_ids: list[int | None]
    bounds: np.ndarray
    ids: np.ndarray


def write_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """Magic, number of documents, of ids, size of the id part; doc_ids (64 bits), whether null (8), lengths (64); ids; CRC-32."""
    body = pack(ids)
    head = _HEAD.pack(MAGIC, len(doc_ids), len(ids), len(body))
    known = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    missing = np.array([d is None for d in doc_ids], dtype=np.uint8)
    raw = head + known.tobytes() + missing.tobytes() + np.asarray(lengths, dtype="<u8").tobytes() + body
    return raw + struct.pack("<I", zlib.crc32(raw))


def read_file(raw: bytes) -> TokenFile:
    if raw[:4] != MAGIC or zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
        raise ValueError("no token file, or a damaged one")
    _, docs, n, size = _HEAD.unpack_from(raw)
    at = _HEAD.size
    known, missing = np.frombuffer(raw, "<i8", docs, at), np.frombuffer(raw, np.uint8, docs, at + 8 * docs)
    lengths = np.frombuffer(raw, "<u8", docs, at + 9 * docs).astype(np.int64)
    body = raw[at + 17 * docs : at + 17 * docs + size]
    ids = [None if gone else int(d) for d, gone in zip(known, missing)]
    return TokenFile(ids, np.concatenate([[0], np.cumsum(lengths)]), unpack(body, n))


def write(docs: DataFrame, folder: str, path: str | None = None) -> None:
    """Encodes whole texts and writes them to ``folder`` in ascending doc_id order, null first.

    The folder is a table with one row for each token file: part, nth, docs, tokens, content. Spark's
    own committer writes it to any store, so lost or doubled attempts leave nothing behind. Parts
    are ranges of doc_id; rows of one doc_id are told apart by their text, so no doc_id has to fit one part.
    """
    path = path or default_path()
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    order = ("doc_id", "tie")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches):
        enc, part, nth = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for start, stop in slices(batch.column("text")):
                ids, bounds = enc.encode(batch.column("text").slice(start, stop - start))
                lengths = np.diff(bounds) + 1
                full = np.full(int(lengths.sum()), END, dtype=np.uint32)
                keep = np.ones(len(full), dtype=bool)
                keep[np.cumsum(lengths) - 1] = False
                full[keep] = ids
                content = write_file(batch.column("doc_id").slice(start, stop - start).to_pylist(), lengths, full)
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([part], pa.int32()), "nth": pa.array([nth], pa.int32()), "docs": [stop - start], "tokens": [len(full)], "content": [content]}
                )
                nth += 1

    files = ranged.mapInArrow(run, "part int, nth int, docs bigint, tokens bigint, content binary")
    files.write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(folder)


def read(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files of ``folder``; every file is checked."""
    files = spark.read.schema("part int, nth int, docs bigint, tokens bigint, content binary").parquet(folder)
    sizes = files.select("part", "nth", "tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.select("part", "nth", F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("within"))
    places = places.join(parts, "part").select("part", "nth", (F.col("base") + F.col("within")).alias("base"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1).to_pydict()
                file = read_file(one["content"][0])
                raw = file.ids.astype("<u4")
                sums = [zlib.crc32(raw[a:b]) for a, b in zip(file.bounds, file.bounds[1:])]
                n = len(file.doc_ids)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(file.doc_ids, pa.int64()),
                        "part": pa.array(one["part"] * n, pa.int32()),
                        "nth": pa.array(one["nth"] * n, pa.int32()),
                        "within": pa.array(file.bounds[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(file.bounds), pa.int64()),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    schema = "doc_id bigint, part int, nth int, within bigint, n_tokens bigint, ids_crc32 bigint"
    each = files.select("part", "nth", "content").mapInArrow(run, schema)
    out = each.join(places, ["part", "nth"])
    return out.select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the files of ``docs`` to the shared folder and reads them back.

    One row per row of ``docs`` (doc_id, text; other columns are ignored). A null or empty text has
    only the end id; rows with a null doc_id come first; of rows with equal doc_ids the order follows
    a hash of the text; an empty table gives no rows.
    """
    folder = new_folder(docs.sparkSession, "token-files")
    write(docs, folder, path)
    return read(docs.sparkSession, folder)


def query(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"))
