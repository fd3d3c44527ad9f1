"""Fill-in-the-middle transformation with content-defined chunk memoization.

A text is n tokens ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: each word
with the blanks before it, and the blanks at the end.  Two cuts between tokens split it into
prefix, middle and suffix; cuts and form come from the first digits of
``sha256('<seed>:<doc_id>')``, so a rerun or a retried task gives the same result.

A rolling hash over the last 32 bytes cuts each text where its low bits are zero, so equal
passages give equal chunks wherever they stand.  A chunk's boundary summary (words that end
inside it, code points, whether it starts and ends in a word) is kept in a cache under the
chunk's hash and used again only where the bytes are equal.  A word's end on a border is
decided by the two chunks that meet there.  Running sums of the summaries give the token
count and the chunk of each cut; only those two chunks are looked at byte by byte.

One pass over whole texts without a shuffle.  Memory is one slice of a batch (4 MB, or one
longer text) and a cache of at most ``CACHE_BYTES``; a full cache starts anew.

Defined results: a null text counts as empty; empty texts and texts that contain a marker
have the form plain.  A null doc_id is hashed as ``<seed>:``.  Repeated rows give equal
rows.  Empty tables give empty results; other columns pass through, but for the added ones
n, form, prefix_chars, middle_chars and output, which are replaced where they exist.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch.llm.text import SPACE, chunks, mix64, span_hashes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CACHE_BYTES = 64 << 20
#: Chunks have at least MIN_CHUNK bytes, MEAN_BITS more bits' worth on average, MAX_CHUNK at most.
MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 256, 10, 8192
_ROLL = (mix64(np.arange(7, 263, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Hash of the (at most 32) bytes up to each position, by doubling of window lengths."""
    h = _ROLL[data]
    for shift in (1, 2, 4, 8, 16):
        h[shift:] += h[:-shift] << np.uint32(shift)
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends of all chunks, number of chunks before each text).

    Chunks never cross texts or split a code point; what a chunk is depends on the bytes
    since its text's last cuts only."""
    roll = rolling_hash(data)
    free = np.ones(len(data) + 1, bool)  # a cut may stand before this byte
    free[:-1] = (data & 0xC0) != 0x80
    cuts = np.flatnonzero(((roll >> np.uint32(32 - MEAN_BITS)) == 0) & free[1:]) + 1
    ends: list[int] = []
    before = [0]
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        at = lo
        while at < hi:
            i = int(np.searchsorted(cuts, at + MIN_CHUNK))
            to = int(cuts[i]) if i < len(cuts) else hi
            if to > min(at + MAX_CHUNK, hi):
                to = min(at + MAX_CHUNK, hi)
                while to < hi and not free[to]:
                    to += 1
            ends.append(to)
            at = to
        before.append(len(ends))
    return np.array(ends, np.int64), np.array(before, np.int64)


def inner_ends(chunk: np.ndarray) -> np.ndarray:
    """Where words end inside a chunk, its last byte left open."""
    blank = SPACE[chunk]
    return np.flatnonzero(blank[1:] & ~blank[:-1]) + 1


def summary(chunk: np.ndarray) -> tuple[int, int, bool, bool]:
    """(words that end inside, code points, first byte blank, last byte blank)."""
    return (len(inner_ends(chunk)), int(((chunk & 0xC0) != 0x80).sum()),
            bool(SPACE[chunk[0]]), bool(SPACE[chunk[-1]]))


class ChunkCache:
    """Summaries by chunk hash, used where the bytes are the same."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.size, self.hits = limit, 0, 0
        self.known: dict[int, tuple[bytes, tuple[int, int, bool, bool]]] = {}

    def summaries(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One row a chunk: words that end inside, code points, first and last byte blank."""
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        out = np.empty((len(ends), 4), np.int64)
        keys = span_hashes(data, starts, ends)
        for k, (key, lo, hi) in enumerate(zip(keys.tolist(), starts.tolist(), ends.tolist())):
            body = data[lo:hi].tobytes()
            found = self.known.get(key)
            if found is not None and found[0] == body:
                self.hits += 1
                out[k] = found[1]
                continue
            out[k] = made = summary(data[lo:hi])
            if found is None:
                if self.size + hi - lo > self.limit:
                    self.known.clear()
                    self.size = 0
                self.known[key] = (body, made)
                self.size += hi - lo
        return out


class TextCuts:
    """Token counts of the texts of a slice, and byte and code point places of token ends."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, cache: ChunkCache):
        self.data, self.offsets = data, offsets
        self.ends, self.before = chunk_ends(data, offsets)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        made = cache.summaries(data, self.ends)
        inside, self.chars, first, last = made.T
        # the border after a chunk ends a word if the chunk ends in one and a blank or the text's end follows
        follows = np.ones(len(self.ends), bool)
        follows[:-1] = first[1:].astype(bool)
        tail = self.before[1:][np.diff(self.before) > 0] - 1
        follows[tail] = True
        self.inside = inside
        border = (~last.astype(bool)) & follows
        self.upto = np.concatenate([[0], np.cumsum(inside + border)])
        self.chars_upto = np.concatenate([[0], np.cumsum(self.chars)])
        self.words = np.diff(self.upto[self.before])
        blank_tail = np.zeros(len(self.words), np.int64)
        blank_tail[np.diff(self.before) > 0] = last[tail]
        self.tokens = self.words + blank_tail

    def place(self, text: int, k: int) -> tuple[int, int]:
        """(byte, code point) in the text after its first k tokens."""
        lo, c0 = int(self.offsets[text]), int(self.before[text])
        if k == 0:
            return 0, 0
        if k > self.words[text]:
            return int(self.offsets[text + 1]) - lo, int(self.chars_upto[self.before[text + 1]] - self.chars_upto[c0])
        want = int(self.upto[c0]) + k
        c = int(np.searchsorted(self.upto, want)) - 1
        start, end = int(self.starts[c]), int(self.ends[c])
        rank = want - int(self.upto[c])
        chars = int(self.chars_upto[c] - self.chars_upto[c0])
        if rank > self.inside[c]:  # the border itself
            return end - lo, chars + int(self.chars[c])
        at = int(inner_ends(self.data[start:end])[rank - 1])
        return start + at - lo, chars + int(((self.data[start:start + at] & 0xC0) != 0x80).sum())


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """h1 to h4: the first four groups of 32 bits of sha256('<seed>:<doc_id>')."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    return struct.unpack(">4I", hashlib.sha256(key.encode()).digest()[:16])


ADDED = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType())])
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))


def _rearranged(cuts: TextCuts, i: int, body: bytes, h: tuple[int, int, int, int], fim_percent: int,
                spm_percent: int) -> tuple[str, int | None, int | None, bytes]:
    n = int(cuts.tokens[i])
    if not body or h[2] % 100 >= fim_percent or any(m in body for m in _MARKS):
        return "plain", None, None, body
    (a, a_chars), (b, b_chars) = sorted(cuts.place(i, x % (n + 1)) for x in h[:2])
    p, s, m = _MARKS
    if h[3] % 100 < spm_percent:
        return "spm", a_chars, b_chars - a_chars, s + body[b:] + p + body[:a] + m + body[a:b]
    return "psm", a_chars, b_chars - a_chars, p + body[:a] + s + body[b:] + m + body[a:b]


def fill_in_middle(docs: DataFrame, seed: int = 42, fim_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """``docs`` with n (tokens), form, prefix_chars, middle_chars and output."""
    keep = [c for c in docs.columns if c not in ADDED.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkCache()
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                cuts = TextCuts(data, offsets, cache)
                ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
                rows = [_rearranged(cuts, i, data[offsets[i]:offsets[i + 1]].tobytes(), draws(seed, doc_id),
                                    fim_percent, spm_percent) for i, doc_id in enumerate(ids)]
                form, prefix, middle, output = zip(*rows)
                cols = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.record_batch(
                    [*cols, pa.array(cuts.tokens), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                    names=[*keep, *ADDED.names])

    base = docs.select(*keep)
    return base.mapInArrow(run, T.StructType([*base.schema.fields, *ADDED.fields]))


def restored(form: Column, output: Column) -> Column:
    """The exact text that ``output`` was made of."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))
