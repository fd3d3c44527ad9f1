"""Vectorised word tables for Arrow text columns, used inside Spark tasks.

A chunk of texts is one byte buffer.  Words are found with a byte lookup table
(UTF-8 continuation bytes never equal a separator) and hashed to 64 bits with a
polynomial over prefix sums, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _lower_lut() -> np.ndarray:
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] += 32
    return lut


LOWER = _lower_lut()
#: Separators of the word pattern [^\x20\x09-\x0D]+
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Separators of the word pattern [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
PUNCT = np.zeros(256, dtype=bool)
PUNCT[0x00:0x30] = PUNCT[0x3A:0x61] = PUNCT[0x7B:0x80] = True


def mix64(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _MUL)
_BASE = 0x2545F4914F6CDD1D
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POW or len(_POW["p"]) < n:
        size = max(n, 1 << 18)
        for key, b in (("p", np.uint64(_BASE)), ("i", np.uint64(pow(_BASE, -1, 1 << 64)))):
            a = np.full(size, b, dtype=np.uint64)
            a[0] = 1
            _POW[key] = np.multiply.accumulate(a)
    return _POW["p"][:n], _POW["i"][:n]


def _hash_range(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lo = int(starts[0])
    seg = data[lo:int(ends[-1])]
    power, inverse = _powers(len(seg))
    acc = np.zeros(len(seg) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[seg] * power, out=acc[1:])
    return (acc[ends - lo] - acc[starts - lo]) * inverse[starts - lo]


def _hash_long(data: np.ndarray, step: int) -> np.uint64:
    """The same hash for one word of any length, in pieces."""
    total = 0
    for at in range(0, len(data), step):
        piece = data[at:at + step]
        part = int(_hash_range(piece, np.array([0]), np.array([len(piece)]))[0])
        total += part * pow(_BASE, at, 1 << 64)
    return np.uint64(total % (1 << 64))


def packed(df: DataFrame, *apart: str) -> DataFrame:
    """The columns ``apart`` and the others as one struct _row, so that no name of the table
    can meet a name that an operator uses."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in apart]
    return df.select(*apart, (F.struct(*rest) if rest else F.lit(0)).alias("_row"))


def unpacked(df: DataFrame, columns: list[str], apart: tuple[str, ...]) -> DataFrame:
    """The table of ``columns`` again, those of ``apart`` as they are in ``df``."""
    return df.select(*[F.col(c) if c in apart else F.col("_row").getField(c).alias(c) for c in columns])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """64-bit hashes of byte spans in ascending order (a span may be empty or of any length)."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + step, side="right")))
        if ends[i] - starts[i] > step:
            out[i], j = _hash_long(data[starts[i]:ends[i]], step), i + 1
        else:
            out[i:j] = _hash_range(data, starts[i:j], ends[i:j])
        i = j
    return mix64(out + (ends - starts).astype(np.uint64) * _MUL)


class WordTable:
    """Words of consecutive texts: byte spans, 64-bit hashes and the text of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sep: np.ndarray):
        self.n_docs = len(offsets) - 1
        self.raw = data
        self.offsets = offsets
        self.data = LOWER[data]
        word = ~sep[self.data]
        before = np.zeros(len(word), dtype=bool)
        before[1:] = word[:-1]
        cuts = offsets[:-1]
        before[cuts[cuts < len(word)]] = False
        self.starts = np.flatnonzero(word & ~before)
        after = np.zeros(len(word), dtype=bool)
        after[:-1] = word[1:]
        cuts = offsets[1:]
        after[cuts[cuts > 0] - 1] = False
        self.ends = np.flatnonzero(word & ~after) + 1
        #: index of the first word of each text, and one past the last
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts)

    def hashes(self, step: int = 1 << 18) -> np.ndarray:
        """64-bit hash of each lower-cased word (prefix sums over ~step bytes)."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + step, side="right")))
            if self.ends[i] - self.starts[i] > step:
                out[i] = _hash_long(self.data[self.starts[i]:self.ends[i]], step)
                j = i + 1
            else:
                out[i:j] = _hash_range(self.data, self.starts[i:j], self.ends[i:j])
            i = j
        out += (self.ends - self.starts).astype(np.uint64) * _MUL
        return mix64(out)


def buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a record batch with about ``size`` bytes of text each; a longer
    text is a slice of its own, so no text is ever cut."""
    if not batch.num_rows:
        return
    data, off = buffers(batch.column(batch.schema.get_field_index(column)))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        j = min(j, n)
        yield batch.slice(i, j - i), data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_tables(batch: pa.RecordBatch, column: str, sep: np.ndarray, size: int = CHUNK_BYTES
                ) -> Iterator[tuple[pa.RecordBatch, WordTable]]:
    for part, data, off in chunks(batch, column, size):
        yield part, WordTable(data, off, sep)


def word_hashes(words: list[str]) -> np.ndarray:
    """Hashes of single words, as a word table of texts would give them."""
    data, off = buffers(pa.array(words, pa.string()))
    return WordTable(data, off, PUNCT).hashes()
