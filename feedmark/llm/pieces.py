"""SentencePiece encoding with merge-type (BPE) models, exactly, by backtracking over longest matches."""

from __future__ import annotations

import codecs
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedmark.llm.common import table, whole_text
from feedmark.llm.tokens import slices, spread

SPACE = "▁"  # what models write for a space
WINDOW = 1 << 19  # code points of a text that are encoded at a time
BATCH_BYTES = 2 << 20
KNOWN = 400_000  # segments, and pairs of pieces, that a worker remembers
LONGEST_KNOWN = 48
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # kinds of pieces in a model file


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes):
    """(number, value) of a protocol buffer message: whole numbers, bytes, or 4 bytes of a float."""

    def number(at):
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                size, at = number(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Model:
    """Pieces, scores and kinds of a model file, and whether a space is put before each text."""

    def __init__(self, path: str):
        self.pieces, self.scores, self.kinds = [], [], []
        trainer, normalizer = {}, {}
        with open(path, "rb") as file:
            for field, value in _fields(file.read()):
                if field == 1:
                    one = dict(_fields(value))
                    self.pieces.append(one[1].decode())
                    self.scores.append(float(np.frombuffer(one.get(2, b"\0\0\0\0"), "<f4")[0]))
                    self.kinds.append(one.get(3, NORMAL))
                elif field == 2:
                    trainer = dict(_fields(value))
                elif field == 3:
                    normalizer = dict(_fields(value))
        self.prefix = bool(normalizer.get(3, 1))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0):
            raise ValueError(f"{path}: not a merge-type model with a piece for each byte and spaces before words")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError(f"{path}: the model rewrites characters or drops spaces")
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE} or self.kinds.count(BYTE) != 256:
            raise ValueError(f"{path}: the model has pieces of the user or unused ones")


def _one_by_one(error):
    """Each byte that belongs to no character becomes U+FFFD by itself."""
    return "�", error.start + 1


codecs.register_error("feedmark-each-byte", _one_by_one)


@lru_cache(maxsize=2)
def coder(path: str) -> "Coder":
    """One for each worker process."""
    return Coder(path)


class Coder:
    """Encodes and decodes with one model.

    The library merges, again and again, the adjacent pair of symbols whose joined text is the piece
    of the best score, leftmost first. A row of pieces is what that gives if, and only if, each piece
    comes out of its own characters and each two neighbours come out of theirs: the first merge across
    a border of the whole would be the first one across it in the two neighbours as well. So each
    prefix has one valid row of pieces at most, and a place from which none goes on has failed for good.
    """

    def __init__(self, path: str):
        import ahocorasick

        model = Model(path)
        self.prefix = SPACE if model.prefix else ""
        self.count = len(model.pieces)
        normal = [i for i, kind in enumerate(model.kinds) if kind == NORMAL]
        self.bytes = [i for i, kind in enumerate(model.kinds) if kind == BYTE]
        self.bytes.sort(key=lambda i: int(model.pieces[i][3:-1], 16))
        self.order = {model.pieces[i]: -model.scores[i] for i in normal}
        characters = sorted({c for piece in self.order for c in piece})
        lone = [c for c in characters if c not in self.order]  # they stand in pieces, but are none
        self.text = dict(zip(normal, (model.pieces[i] for i in normal))) | {self.count + n: c for n, c in enumerate(lone)}
        self.size = {i: len(piece) for i, piece in self.text.items()}
        by_text = {piece: i for i, piece in self.text.items()}
        self.shorter = {i: next((by_text[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in by_text), None) for p, i in by_text.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in by_text.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        # whether two characters stand side by side in any piece; where not, the library never merges
        self.kind = np.zeros(0x110000, dtype=np.int32)
        self.kind[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.kinds = len(characters) + 1
        self.glued = np.zeros(self.kinds * self.kinds, dtype=bool)
        for piece in self.order:
            kinds = self.kind[[ord(c) for c in piece]]
            self.glued[kinds[:-1] * self.kinds + kinds[1:]] = True
        said = [b""] * self.count
        for i, kind in enumerate(model.kinds):
            if kind == NORMAL:
                said[i] = model.pieces[i].replace(SPACE, " ").encode()
            elif kind == UNKNOWN:
                said[i] = " ⁇ ".encode()
        for byte, i in enumerate(self.bytes):
            said[i] = bytes([byte])
        self.spaced = {i for i in normal if model.pieces[i].startswith(SPACE)}
        self.silent = np.array([kind == CONTROL for kind in model.kinds])
        self.said = _Pool(said)
        self.digits = _Pool([f"{i},".encode() for i in range(self.count)])
        self.fit: dict[tuple, bool] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging pair after pair."""
        symbols = list(text)
        while len(symbols) > 1:
            ranks = [self.order.get(a + b, np.inf) for a, b in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == np.inf:
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def fits(self, before: int | None, token: int) -> bool:
        """Whether the two come out again when their characters are merged anew; alone, whether the one does."""
        key = (before, token)
        if (found := self.fit.get(key)) is None:
            wanted = [self.text[i] for i in key if i is not None]
            found = self.merged("".join(wanted)) == wanted
            if len(self.fit) < KNOWN:
                self.fit[key] = found
        return found

    def backtrack(self, text: str) -> list[int]:
        """Pieces of a text whose characters all stand in pieces."""
        size, shorter = self.size, self.shorter
        longest: list[int | None] = [None] * (len(text) + 1)
        for end, token in self.automaton.iter(text):
            longest[end + 1 - size[token]] = token  # ends ascend, so the longest comes last
        failed = bytearray(len(text) // 8 + 1)
        taken: list[int] = []
        at, token = 0, longest[0]
        while at < len(text):
            while token is not None:
                end = at + size[token]
                if not failed[end >> 3] >> (end & 7) & 1 and self.fits(taken[-1] if taken else None, token):
                    break
                token = shorter[token]
            if token is None:
                if not taken:
                    raise ValueError(f"no row of pieces for {text[:80]!r}")
                failed[at >> 3] |= 1 << (at & 7)
                token = taken.pop()
                at -= size[token]
                token = shorter[token]
            else:
                taken.append(token)
                at, token = end, longest[end]
        return taken

    def segment(self, text: str) -> bytes:
        """Ids of a segment, little-endian unsigned 32-bit."""
        ids: list[int] = []
        if self.kind[ord(text[0])]:
            for i in self.backtrack(text):
                ids += [i] if i < self.count else [self.bytes[b] for b in self.text[i].encode()]
        else:
            ids = [self.bytes[b] for b in text.encode()]
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts as the model sees them (spaces written as U+2581, the prefix there), one after
        the other, and where each text's ids begin and the last ones end. The texts are cut wherever
        two characters stand side by side in no piece; each distinct segment is encoded once."""
        joined = "".join(texts)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
        if not joined:
            return np.empty(0, np.uint32), np.zeros(len(bounds), np.int64)
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        kinds = self.kind[codes]
        at = np.ones(len(codes) + 1, dtype=bool)
        at[1:-1] = ~self.glued[kinds[:-1] * self.kinds + kinds[1:]]
        at[bounds] = True
        starts = np.flatnonzero(at)
        width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
        upto = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
        segments = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(upto[starts]), pa.py_buffer(joined.encode()))
        coded = segments.dictionary_encode()
        found = []
        for text in coded.dictionary.to_pylist():
            ids = self.known.get(text)
            if ids is None:
                ids = self.segment(text)
                if len(text) <= LONGEST_KNOWN and len(self.known) < KNOWN:
                    self.known[text] = ids
            found.append(ids)
        index = coded.indices.to_numpy()
        pool = _Pool(found, 4)
        ids = np.frombuffer(pool.take(index), dtype="<u4")
        ends = np.concatenate([[0], np.cumsum(pool.sizes[index])])
        return ids, ends[np.searchsorted(starts, bounds)]

    def windows(self, text: str, most: int = WINDOW):
        """A long text in parts that are encoded apart, cut where the library never merges."""
        text, start = self.seen(text), 0
        while start < len(text):
            stop = start + most
            while stop < len(text):  # forward to the next cut
                ahead = self.kind[np.frombuffer(text[stop - 1 : stop + 65_535].encode("utf-32-le"), dtype="<u4")]
                free = np.flatnonzero(~self.glued[ahead[:-1] * self.kinds + ahead[1:]])
                if len(free):
                    stop += int(free[0])
                    break
                stop += len(ahead) - 1
            yield text[start:stop]
            start = stop

    def seen(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE) if text else ""

    def decode_bytes(self, ids: np.ndarray, first: bool = True) -> bytes:
        """``first``: a space that begins the first piece is the prefix, and goes."""
        out = self.said.take(ids)
        return out[1:] if first and self.prefix and len(ids) and int(ids[0]) in self.spaced else out

    def decode(self, ids: np.ndarray) -> str:
        """The text; bytes on the two sides of a control piece make no character together."""
        text = ""
        for run in np.split(ids, np.flatnonzero(self.silent[ids])):
            text += self.decode_bytes(run[self.silent[run[:1]].sum() :], not text).decode("utf-8", "feedmark-each-byte")
        return text


class _Pool:
    """Byte strings by number, put together by an array of numbers."""

    def __init__(self, strings: list[bytes], unit: int = 1):
        lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings)) // unit
        self.sizes, self.starts = lengths, np.cumsum(lengths) - lengths
        self.data = np.frombuffer(b"".join(strings), dtype=np.uint8 if unit == 1 else "<u4")

    def take(self, numbers: np.ndarray) -> bytes:
        return self.data[spread(self.starts[numbers], self.sizes[numbers])].tobytes() if len(numbers) else b""


def _parts(enc: Coder, texts: pa.Array):
    """(row, ids, whether they are the row's first) for every row in order; a long row in several parts."""
    for start, stop in slices(texts, BATCH_BYTES):
        run = texts.slice(start, stop - start).to_pylist()
        if len(run) == 1 and len(run[0]) > WINDOW:
            for n, part in enumerate(enc.windows(run[0])):
                yield start, enc.encode([part])[0], n == 0
            continue
        ids, bounds = enc.encode([enc.seen(t) for t in run])
        for n in range(len(run)):
            yield start + n, ids[bounds[n] : bounds[n + 1]], True


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit): one row per row of ``docs``.

    Texts are read where they lie and none moves. A text is cut where no piece of the model spans the
    cut; each segment is encoded by longest matches, going back where neighbours don't fit. A text of more than
    ``WINDOW`` code points is encoded window by window in its task, so memory follows the window and the longest
    segment. A null text is an empty text with no ids; null and repeated doc_ids pass through row by
    row, other columns are ignored, and an empty table gives no rows. Models that rewrite characters
    or have pieces of the user are refused.
    """
    path = path or default_path()

    def run(batches):
        enc = coder(path)
        for batch in batches:
            held: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            for row, ids, _ in _parts(enc, batch.column("text")):
                held[row].append(ids.astype("<u4").tobytes())
            made = pa.array([b"".join(x) for x in held], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], names=["doc_id", "ids"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, "doc_id bigint, ids binary")


def decoded(coded: DataFrame, path: str | None = None) -> DataFrame:
    """The rows of ``encoded`` with text in place of ids; bytes that are no UTF-8 become U+FFFD each."""
    path = path or default_path()

    def run(batches):
        enc = coder(path)
        for batch in batches:
            texts = [enc.decode(np.frombuffer(x.as_py() or b"", dtype="<u4")) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded as by ``encoded``, and decoded again, part by part."""
    path = path or default_path()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches):
        enc = coder(path)
        for batch in batches:
            rows = batch.num_rows
            counts = [0] * rows
            said, texts = ([hashlib.sha256() for _ in range(rows)] for _ in range(2))
            for row, ids, first in _parts(enc, batch.column("text")):
                digits = enc.digits.take(ids)
                said[row].update(digits[:-1] if first else b"," + digits[:-1])
                texts[row].update(enc.decode_bytes(ids, first))
                counts[row] += len(ids)
            made = [pa.array(counts, pa.int64()), *(pa.array([h.hexdigest() for h in x], pa.string()) for x in (said, texts))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=names)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def query(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
