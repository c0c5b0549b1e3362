"""Feed documents of any size: one JSON file read by many tasks.

Spark cuts a text file into byte ranges and hands each task the pieces between closing braces. What
a byte means depends on what stands before it (inside a string or not, how deep), so a first
pass sums up each range for both cases, the summaries are chained per file, and a second pass
reads each range knowing where it starts. It yields the elements of the lists directly below the
document's object, one row each; an element cut by a border is put together from its parts. What is left
of the document, its skeleton with empty lists, is judged like a small document.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedmark import model as m
from feedmark.functions import records
from feedmark.session import stage
from feedmark.sources import documents
from feedmark.sources.documents import TOO_LARGE

SEPARATOR = "}"
ELEMENT_BYTES = 100 << 20  # what a VARIANT holds, with some room
SKELETON_BYTES = 16 << 20
BATCH_BYTES = 8 << 20  # of text that a task hands on at a time
KEY_BYTES = 4096  # before a list's bracket, in which its key is looked for

_IS = {name: np.zeros(256, dtype=bool) for name in ("open", "close", "comma")}
for _name, _bytes in {"open": b"{[", "close": b"}]", "comma": b","}.items():
    _IS[_name][list(_bytes)] = True
_STRUCTURE = _IS["open"] | _IS["close"] | _IS["comma"]
_QUOTE, _BACKSLASH, _LIST = ord('"'), ord("\\"), ord("[")


def _structure(data: np.ndarray, in_string: bool) -> tuple[np.ndarray, bool]:
    """Places of brackets and commas outside of strings, and whether the end lies in a string."""
    quotes = np.flatnonzero(data == _QUOTE)
    if len(quotes):
        # a quote after an odd run of backslashes is escaped
        other = np.flatnonzero(data != _BACKSLASH)
        last = np.searchsorted(other, quotes) - 1
        before = np.where(last >= 0, other[np.maximum(last, 0)], -1)
        quotes = quotes[(quotes - before) % 2 == 1]
    places = np.flatnonzero(_STRUCTURE[data])
    inside = (np.searchsorted(quotes, places) + in_string) % 2 == 1
    return places[~inside], bool((len(quotes) + in_string) % 2)


def _key_before(data: bytes, bracket: int) -> str | None:
    """The key whose value begins with the bracket; None in a list, or when it is not to be seen here."""
    text = data[max(0, bracket - KEY_BYTES) : bracket].rstrip(b" \t\r\n")
    if not text.endswith(b":"):
        return None
    text = text[:-1].rstrip(b" \t\r\n")
    begin = len(text) - 1
    while text.endswith(b'"') and (begin := text.rfind(b'"', 0, begin)) >= 0:
        if (begin - len(text[:begin].rstrip(b"\\"))) % 2 == 0:
            try:
                return json.loads(text[begin:])
            except ValueError:
                return None
    return None


# A summary of a stretch of text, for one state at its beginning: does the end lie in a string; how many brackets
# does it close that stood open before; how many does it leave open, and the first two of these with their keys.
Summary = tuple[bool, int, int, list]


def summary(data: bytes, in_string: bool) -> Summary:
    raw = np.frombuffer(data, dtype=np.uint8)
    places, ends_inside = _structure(raw, in_string)
    places = places[~_IS["comma"][raw[places]]]
    if not len(places):
        return ends_inside, 0, 0, []
    depth = np.cumsum(np.where(_IS["open"][raw[places]], 1, -1))
    least = min(0, int(depth.min()))
    left = int(depth[-1]) - least
    opened = []
    for level in range(least + 1, least + 1 + min(2, left)):
        below = np.flatnonzero(depth < level)
        at = int(places[below[-1] + 1 if len(below) else 0])
        opened.append((raw[at] == _LIST, _key_before(data, at)))
    return ends_inside, -least, left, [(bool(a), b) for a, b in opened]


def chained(a: Summary, b: Summary) -> Summary:
    """Of two stretches one after the other; ``b`` is the one for the state in which ``a`` ends."""
    if b[1] >= a[2]:
        return b[0], a[1] + b[1] - a[2], b[2], b[3]
    left = a[2] - b[1]
    return b[0], a[1], left + b[2], [*a[3][:left], *b[3]][:2]


def _runs(batches) -> Iterator[tuple[str, int, bytes | None]]:
    """(file, first byte of the range, text) in order, a few megabytes at a time; None ends a range."""
    key = None
    for batch in batches:
        files, starts, texts = (batch.column(c) for c in ("file", "start", "value"))
        for n, text in enumerate(texts.to_pylist()):
            now = files[n].as_py(), starts[n].as_py()
            if now != key:
                if key:
                    yield *key, b"".join(held)
                    yield *key, None
                key, held, size = now, [], 0
            held.append(text + b"}")
            size += len(text) + 1
            if size > BATCH_BYTES:
                yield *key, b"".join(held)
                held, size = [], 0
    if key:
        yield *key, b"".join(held)
        yield *key, None


SUMMARIES = "file string, start bigint, summaries string"
EMPTY: Summary = (False, 0, 0, [])


def _summarise(batches):
    """A row for each range: its summaries for a beginning outside and inside of a string."""
    now = None
    for file, start, data in _runs(batches):
        if data is None:
            yield pa.RecordBatch.from_pylist([{"file": file, "start": start, "summaries": json.dumps(now)}])
            now = None
            continue
        now = now or [EMPTY, (True, 0, 0, [])]
        now = [chained(a, summary(data, a[0])) for a in now]


class _Reader:
    """Goes through one range and yields (kind, key, text) of what it holds.

    Kinds: ``skeleton``; ``element``, one from its first to its last byte; ``head``, ``middle`` and
    ``tail``, the parts of one that goes across borders; ``too_large`` instead of any text beyond its bound.
    """

    def __init__(self, begins: Summary, element_bytes: int = ELEMENT_BYTES, skeleton_bytes: int = SKELETON_BYTES):
        self.element_bytes, self.skeleton_bytes = element_bytes, skeleton_bytes
        self.in_string, _, self.depth, opened = begins
        self.listed = self.depth >= 2 and bool(opened[1][0])
        self.key = opened[1][1] if self.listed else None
        self.across = self.listed  # the element that is being read began before this range
        self.held: list[bytes] = []
        self.size = self.skeleton = 0

    def _keep(self, data: bytes) -> None:
        self.size += len(data)
        if self.size <= self.element_bytes:
            self.held.append(data)

    def _element(self, kind: str):
        text, large = b"".join(self.held), self.size > self.element_bytes
        self.held, self.size, self.across = [], 0, False
        return (TOO_LARGE, self.key, b"") if large else (kind, self.key, text)

    def _left(self, data: bytes):
        self.skeleton += len(data)
        return ("skeleton", None, data) if self.skeleton <= self.skeleton_bytes else (TOO_LARGE, None, b"")

    def read(self, data: bytes) -> Iterator[tuple]:
        raw = np.frombuffer(data, dtype=np.uint8)
        places, self.in_string = _structure(raw, self.in_string)
        marks = raw[places]
        opens, closes = _IS["open"][marks], _IS["close"][marks]
        depth = self.depth + np.cumsum(opens.astype(np.int64) - closes)
        told = (opens & (depth == 2)) | (closes & (depth == 1)) | (_IS["comma"][marks] & (depth == 2))
        done = 0
        for place, mark in zip(places[told].tolist(), marks[told].tolist()):
            if self.listed:
                if mark != ord(",") and mark != ord("]"):
                    continue  # a brace that closes the list: the skeleton will not parse
                self._keep(data[done:place])
                yield self._element("tail" if self.across else "element")
                self.listed = mark == ord(",")
                done = place + (mark == ord(","))
            elif mark == _LIST:
                self.listed, self.key = True, _key_before(data, place)
                yield self._left(data[done : place + 1])
                done = place + 1
        if len(depth):
            self.depth = int(depth[-1])
        if self.listed:
            self._keep(data[done:])
        elif done < len(data):
            yield self._left(data[done:])

    def end(self) -> Iterator[tuple]:
        if self.listed:
            yield self._element("middle" if self.across else "head")


PIECES = "file string, start bigint, nth bigint, kind string, key string, text binary, bytes bigint"


def _read_ranges(batches, element_bytes: int, skeleton_bytes: int):
    """PIECES of each range, and how many bytes it has (kind ``range``)."""
    columns = PIECES.replace(" string", "").replace(" bigint", "").replace(" binary", "").split(", ")
    schema = pa.schema(list(zip(columns, [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64()])))
    rows, size, nth, total, reader = [], 0, 0, 0, None

    def with_begins():
        for batch in batches:
            begins.update(zip(batch.column("start").to_pylist(), batch.column("begins").to_pylist()))
            yield batch

    begins: dict[int, str | None] = {}
    for file, start, data in _runs(with_begins()):
        if reader is None:
            told = begins.get(start)
            reader, nth, total = _Reader(tuple(json.loads(told)) if told else EMPTY, element_bytes, skeleton_bytes), 0, 0
        for kind, key, text in reader.end() if data is None else reader.read(data):
            rows.append((file, start, nth, kind, key, text, len(text)))
            nth, size = nth + 1, size + len(text)
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_pylist([dict(zip(columns, r)) for r in rows], schema)
                rows, size = [], 0
        if data is None:
            rows.append((file, start, nth, "range", None, b"", total))
            reader, begins = None, {k: v for k, v in begins.items() if k != start}
        else:
            total += len(data)
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip(columns, r)) for r in rows], schema)


def _chain(ranges: list) -> list:
    """(start, state before it) of each range of a file, from their summaries in order."""
    out, now = [], EMPTY
    for start, both in sorted(ranges):
        out.append((start, json.dumps(now)))
        now = chained(now, tuple(json.loads(both)[now[0]]))
    return out


def _begins(ranges: DataFrame) -> DataFrame:
    """(file, start, begins); a file has a range for each 128 MB or so, one short text each."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        chain = _chain(list(zip(rows.column("start").to_pylist(), rows.column("summaries").to_pylist())))
        made = [pa.array([key[0].as_py()] * len(chain), pa.string()), pa.array([c[0] for c in chain], pa.int64()), pa.array([c[1] for c in chain], pa.string())]
        return pa.table(made, ["file", "start", "begins"])

    return ranges.groupBy("file").applyInArrow(run, "file string, start bigint, begins string")


def split_files(
    spark: SparkSession,
    path: str,
    ids: str = "source string, run_id string",
    element_bytes: int = ELEMENT_BYTES,
    skeleton_bytes: int = SKELETON_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """The documents below ``path``, one uncompressed JSON file each, whatever their size.

    ``ids`` are the partition columns of the folder. Two tables: the documents (ids, doc_id, body, n_damaged, large)
    with their lists emptied, and their elements (ids, doc_id, key, text). Ranges are read in any order by
    any task; memory follows the largest element, not the document. An empty file is a document with an empty body.
    """
    names = [part.split()[0] for part in ids.split(", ")]
    source = spark.read.schema(f"value string, {ids}").option("lineSep", SEPARATOR).text(path)
    meta = {"file": "file_path", "start": "file_block_start", "length": "file_block_length", "size": "file_size"}
    rows = source.select(F.col("value").cast("binary").alias("value"), *(F.col(f"_metadata.{v}").alias(k) for k, v in meta.items()))
    cut = rows.where(F.col("length") < F.col("size")).select("file", "start", "value")
    begins = stage(_begins(stage(cut.mapInArrow(_summarise, SUMMARIES), "ranges")), "range-begins")
    known = rows.select("file", "start", "value").join(F.broadcast(begins), ["file", "start"], "left")
    pieces = stage(known.mapInArrow(lambda batches: _read_ranges(batches, element_bytes, skeleton_bytes), PIECES), "document-pieces")

    listing = f"path string, modificationTime timestamp, length bigint, content binary, {ids}"
    listed = spark.read.format("binaryFile").schema(listing).load(path)  # without content: nothing is read
    files = listed.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), *names)
    # Spark's readers pass over empty files; its listing has them
    every = spark.createDataFrame([(f,) for f in listed.inputFiles()], "file string")
    every = every.select(F.regexp_replace("file", "^(\\w+):///", "$1:/").alias("file"))  # as in _metadata
    of_path = [F.url_decode(F.regexp_extract("file", f"/{name}=([^/]*)/", 1)).alias(name) for name in names]
    empty = every.join(files, "file", "left_anti").select("file", F.lit(0).cast("bigint").alias("size"), *of_path)
    files = stage(files.unionByName(empty), "document-files")
    whole = pieces.where(F.col("kind") == "element").select("file", "key", "text")
    # an element across borders begins with a head; the parts of one are as many as the borders it crosses
    parts = pieces.where(F.col("kind").isin("head", "middle", "tail"))
    nth = F.sum((F.col("kind") == "head").cast("int")).over(Window.partitionBy("file").orderBy("start", "nth"))
    joined = F.array_sort(F.collect_list(F.struct("start", "nth", "text")))
    across = parts.withColumn("element", nth).groupBy("file", "element").agg(
        F.first("key", ignorenulls=True).alias("key"),
        F.sum("bytes").alias("bytes"),
        F.when(F.sum("bytes") <= element_bytes, F.aggregate(joined, F.lit(b""), lambda a, x: F.concat(a, x["text"]))).alias("text"),
    )
    across = stage(across, "elements-across")
    elements = whole.unionByName(across.where("text IS NOT NULL").select("file", "key", "text"))
    blank = F.trim(F.translate(F.col("text").cast("string"), "\t\r\n", "   ")) == ""
    elements = elements.select("file", "key", F.col("text").cast("string").alias("text"), blank.alias("blank"))

    skeleton = pieces.where(F.col("kind") == "skeleton").groupBy("file").agg(joined.alias("parts"), F.sum("bytes").alias("skeleton"))
    body = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["text"]))
    skeleton = skeleton.select("file", "skeleton", F.when(F.col("skeleton") <= skeleton_bytes, body).alias("body"))
    large = pieces.where(F.col("kind") == TOO_LARGE).select("file").union(across.where("text IS NULL").select("file"))
    sizes = pieces.where(F.col("kind") == "range").groupBy("file").agg(F.sum("bytes").alias("read"))
    # a list of one blank element is empty; any other blank one stands beside a comma too many
    counts = elements.groupBy("file", "key").agg(F.count("*").alias("n"), F.count_if("blank").alias("n_blank"))
    damaged = counts.groupBy("file").agg(F.sum(F.when(F.col("n") > 1, F.col("n_blank")).otherwise(0)).alias("n_damaged"))
    found = files.join(skeleton, "file", "left").join(sizes, "file", "left").join(damaged, "file", "left")
    found = found.join(large.distinct().withColumn("large", F.lit(True)), "file", "left")
    # each piece counts with its brace; the last one has none when the file is a byte shorter
    text = F.coalesce(F.col("body").cast("string"), F.lit(""))
    extra = F.coalesce("read", F.lit(0)) - F.col("size")
    found = found.select(
        *names,
        F.col("file").alias("doc_id"),
        F.when(extra == 1, F.substring(text, 1, F.length(text) - 1)).otherwise(text).alias("body"),
        (F.coalesce("n_damaged", F.lit(0)) + F.when(extra.isin(0, 1) | (F.col("size") == 0), 0).otherwise(1)).alias("n_damaged"),
        (F.coalesce("large", F.lit(False)) | F.coalesce(F.col("skeleton") > skeleton_bytes, F.lit(False))).alias("large"),
    )
    named = elements.where(~F.col("blank")).join(files.select("file", *names), "file")
    return found, named.select(*names, F.col("file").alias("doc_id"), "key", "text")


def scan_files(
    spark: SparkSession,
    path: str,
    spec: m.FeedSpec,
    ids: str = "source string, run_id string",
    element_bytes: int = ELEMENT_BYTES,
    skeleton_bytes: int = SKELETON_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Envelopes (as ``documents.open_envelopes`` gives them, without body) and the batch of records (as from
    ``documents.explode_records``, with doc_id) of the document files below ``path``.

    A document with an element that is no JSON, or a comma too many, is not JSON as a whole and brings no records. One with
    an element or a rest beyond the bounds has the fault ``too_large``: a failed run, as nothing can be said about it.
    """
    found, elements = split_files(spark, path, ids, element_bytes, skeleton_bytes)
    parsed = stage(elements.withColumn("record", records.parse(F.col("text"))).drop("text"), "document-elements")
    of_feed = F.col("key") == spec.envelope_key
    counts = parsed.groupBy("doc_id").agg(F.count_if(F.col("record").isNull()).alias("n_bad"), F.count_if(of_feed).alias("n_listed"))
    opened = documents.open_envelopes(found, spec).drop("records", "n_records", "run_ok").join(counts, "doc_id", "left")
    damaged = (F.col("n_damaged") + F.coalesce("n_bad", F.lit(0))) > 0
    fault = F.when(F.col("large"), F.lit(TOO_LARGE)).when(damaged, F.lit("not_json")).otherwise(F.col("fault"))
    usable: Column = F.col("fault").isNull()
    if spec.kind == "window":
        usable = usable & (F.col("query_status") == "ok")
    opened = opened.withColumn("fault", fault).withColumn("run_ok", F.col("fault").isNull())
    opened = opened.withColumn("n_records", F.when(usable, F.coalesce("n_listed", F.lit(0))).otherwise(0))
    envelopes = stage(opened.drop("body", "n_damaged", "large", "n_bad", "n_listed"), "document-envelopes")
    sound = envelopes.where(usable).select("doc_id")
    return envelopes, parsed.where(of_feed).join(sound, "doc_id", "left_semi").drop("key")
