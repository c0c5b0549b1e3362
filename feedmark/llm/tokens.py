"""Whole texts through the tokenizers library, a batch at a time."""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 4 << 20
KNOWN = 400_000  # pieces a worker remembers between batches, about 90 MB
LONGEST_KNOWN = 48


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str) -> "Encoder":
    """One for each worker process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def _bytes_of_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _bytes(members) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


ALNUM = _bytes(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
MARKS = _bytes(b",.;:!?")
# Bytes after a space that surely begin no white space: printable ASCII, and lead bytes without any white space.
VISIBLE = _bytes([*range(0x21, 0x7F), *range(0xC3, 0xE0)])


def cuts(data: np.ndarray) -> np.ndarray:
    """Whether a byte of UTF-8 begins a piece, where the byte-level pre-tokenizer cuts whatever stands farther away.

    Before a space and a visible character; between a letter or digit and a mark; before a line
    end after either, and behind that line end if it stands alone.
    """
    at = np.zeros(len(data), dtype=bool)
    if len(data) < 3:
        return at
    space, line = data == 0x20, data == 0x0A
    letter, mark = ALNUM[data], MARKS[data]
    at[:-1] = space[:-1] & VISIBLE[data[1:]]
    at[1:] |= letter[:-1] & (mark[1:] | line[1:])
    at[1:] |= mark[:-1] & line[1:]
    at[2:] |= line[1:-1] & letter[2:] & (letter | mark)[:-2]
    return at


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        letters, size = _bytes_of_letters(), self.tokenizer.get_vocab_size()
        table = [b""] * size
        for token, i in self.tokenizer.get_vocab().items():
            known = i not in added and all(c in letters for c in token)
            table[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.table = table
        self.lengths = np.array([len(b) for b in table], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.pool = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.known: dict[str, np.ndarray] = {}

    def encode_one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self.pool[spread(self.starts[ids], self.lengths[ids])].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        fresh = [p for p in pieces if p not in self.known]
        coded = self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)
        made = {p: array("I", e.ids).tobytes() for p, e in zip(fresh, coded)}
        found = [made[p] if p in made else self.known[p] for p in pieces]
        if len(self.known) + len(fresh) <= KNOWN:
            self.known.update((p, ids) for p, ids in made.items() if len(p) <= LONGEST_KNOWN)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids begin and the last ones end.

        Texts are cut where the tokenizer always cuts, each distinct piece is encoded once, and the
        pieces' ids are put together. A text with an added token's string is a single piece.
        """
        texts = pa.concat_arrays([texts.cast(pa.large_string())])  # offsets from 0
        if not len(texts):
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
        bounds = bounds - bounds[0]
        at = np.append(cuts(raw), True)
        held = np.zeros(len(texts), dtype=bool)
        for content in self.special:
            held |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(held):
            at[bounds[i] : bounds[i + 1]] = False
        at[bounds] = True
        places = np.flatnonzero(at)
        pieces = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(raw.tobytes()))
        coded = pieces.dictionary_encode()
        index = coded.indices.to_numpy()
        found = self._pieces(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        ids = pool[spread((np.cumsum(sizes) - sizes)[index], sizes[index])] if len(pool) else pool
        upto = np.concatenate([[0], np.cumsum(sizes[index])]).astype(np.int64)
        return ids, upto[np.searchsorted(places, bounds)]


def slices(texts: pa.Array, most: int = BATCH_BYTES):
    """(from, to) of runs of rows with no more text than ``most``, single rows aside."""
    sizes = pc.binary_length(texts.cast(pa.large_string())).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)
