"""Benchmark decontamination with an FM-index per training shard.

A shard is a chunk of documents inside a map task.  Its words become symbols of the
benchmark's vocabulary; other words are separators.  Runs of symbols too short for
any window are left out, which loses no occurrence.  The rest is indexed: suffix
array by prefix doubling, Burrows-Wheeler transform, wavelet matrix with sampled
ranks, suffix positions sampled every ``SAMPLE`` symbols.  All windows of the
benchmark are searched backwards at once; occurrences are located by walking to
a sampled suffix; their word spans merge into removal spans.

Documents are never shuffled.  The benchmark is the query set: it is cut into
blocks of at most ``block_words`` words (a longer item is a block of its own), each
sent to the tasks in turn; the spans of several blocks are merged per document.

Defined results: null and wordless texts have no words and no hits; an item
without words has no window.  A null item_id can be hit but is not listed.  Rows
are handled one by one, so repeated rows each give their own.  Empty tables give
empty results (no benchmark: nothing is hit).  Extra columns are ignored or pass
through ``remove_benchmark`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch.llm.text import PUNCT, WordTable, buffers, packed, unpacked, word_tables

SAMPLE = 8
SHARD_BYTES = 8 << 20


class WaveletMatrix:
    """rank(symbol, position) over an integer sequence, one bit level at a time."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = []
        seq = seq.astype(np.int64)
        for b in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bit = (seq >> b) & 1
            packed = np.packbits(bit.astype(np.uint8))
            ones = np.zeros(len(packed) + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=ones[1:])
            zeros = len(seq) - int(ones[-1])
            self.levels.append((b, np.append(packed, np.uint8(0)), ones, zeros))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    @staticmethod
    def _ones(packed: np.ndarray, ones: np.ndarray, pos: np.ndarray) -> np.ndarray:
        byte = pos >> 3
        part = packed[byte].astype(np.int64) >> (8 - (pos & 7))
        return ones[byte] + np.bitwise_count(part)

    def rank(self, sym: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """How often sym occurs before pos."""
        lo = np.zeros_like(pos)
        for b, packed, ones, zeros in self.levels:
            up = ((sym >> b) & 1).astype(bool)
            r_lo, r_hi = self._ones(packed, ones, lo), self._ones(packed, ones, pos)
            lo = np.where(up, zeros + r_lo, lo - r_lo)
            pos = np.where(up, zeros + r_hi, pos - r_hi)
        return pos - lo


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; later rounds sort unresolved suffixes only."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    s = seq[order]
    first = np.concatenate([[True], s[1:] != s[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]
    h = 1
    while True:
        size = np.diff(np.append(np.flatnonzero(first), n))
        open_at = np.flatnonzero(np.repeat(size > 1, size))
        if not len(open_at):
            return order
        suf = order[open_at]
        nxt = np.full(len(suf), -1, np.int64)
        inside = suf + h < n
        nxt[inside] = rank[suf[inside] + h]
        key = rank[suf]
        by = np.lexsort((nxt, key))
        suf, nxt, key = suf[by], nxt[by], key[by]
        order[open_at] = suf
        split = np.concatenate([[True], (key[1:] != key[:-1]) | (nxt[1:] != nxt[:-1])])
        first[open_at] = split
        rank[suf] = open_at[np.flatnonzero(split)[np.cumsum(split) - 1]]
        h *= 2


class FmIndex:
    """Backward search and location in a sequence of symbols >= 1; 0 ends the text."""

    def __init__(self, seq: np.ndarray, sigma: int):
        seq = np.append(seq, 0)
        sa = suffix_array(seq)
        self.bwt = seq[sa - 1]
        self.tree = WaveletMatrix(self.bwt, sigma)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=sigma))])
        marked = sa % SAMPLE == 0
        self.mark_rank = np.concatenate([[0], np.cumsum(marked)])
        self.marked, self.sampled, self.n = marked, sa[marked], len(seq)

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each window (rows of an int array)."""
        lo, hi = np.zeros(len(windows), np.int64), np.full(len(windows), self.n, np.int64)
        live = np.arange(len(windows))
        for k in range(windows.shape[1] - 1, -1, -1):
            c = windows[live, k]
            lo[live] = self.before[c] + self.tree.rank(c, lo[live])
            hi[live] = self.before[c] + self.tree.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        hi = np.maximum(hi, lo)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        pos, steps = np.zeros(len(rows), np.int64), 0
        live, at = np.arange(len(rows)), rows.copy()
        while len(live):
            hit = self.marked[at]
            pos[live[hit]] = self.sampled[self.mark_rank[at[hit]]] + steps
            live, at = live[~hit], at[~hit]
            c = self.bwt[at]
            at = self.before[c] + self.tree.rank(c, at)
            steps += 1
        return pos


@dataclass
class Queries:
    """A block of benchmark windows over a sorted vocabulary of word hashes."""

    vocab: np.ndarray
    windows: dict[int, np.ndarray]
    items: dict[int, list[list[str]]]

    @classmethod
    def build(cls, ids: list, texts: list, window: int) -> Queries:
        data, off = buffers(pa.array(texts, pa.string()))
        table = WordTable(data, off, PUNCT)
        vocab, sym = np.unique(table.hashes(), return_inverse=True)
        sym = sym + 2
        found: dict[int, dict[bytes, set]] = {}
        for i, a, n in zip(ids, table.first[:-1].tolist(), table.counts.tolist()):
            k = min(n, window)
            for p in range(a, a + n - k + 1) if n else ():
                found.setdefault(k, {}).setdefault(sym[p:p + k].tobytes(), set()).add(None if i is None else str(i))
        windows = {k: np.frombuffer(b"".join(w), dtype=sym.dtype).reshape(len(w), k) for k, w in found.items()}
        return cls(vocab, windows, {k: [sorted(x - {None}) for x in w.values()] for k, w in found.items()})

    def spans(self, table: WordTable) -> tuple[np.ndarray, np.ndarray, list]:
        """(first word, one past the last word, items) of every occurrence."""
        none = np.zeros(0, np.int64)
        if not self.windows or not len(table.starts):
            return none, none, []
        h = table.hashes()
        at = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        sym = np.where(self.vocab[at] == h, at + 2, 1)
        cut = np.zeros(len(sym), bool)  # a run ends before a separator and at a text's end
        cut[table.first[:-1][table.counts > 0]] = True
        cut |= sym == 1
        cut[1:] |= sym[:-1] == 1
        begin = np.flatnonzero(cut)
        length = np.diff(np.append(begin, len(sym)))
        use = (length >= min(self.windows)) & (sym[begin] != 1)
        begin, length = begin[use], length[use]
        if not len(begin):
            return none, none, []
        room = length + 1  # a separator after each run
        start = np.cumsum(room) - room
        origin = np.repeat(begin - start, room) + np.arange(int(room.sum()))
        seq = sym[np.minimum(origin, len(sym) - 1)]
        seq[start + length] = 1
        index = FmIndex(seq, len(self.vocab) + 2)
        lows, highs, names = [], [], []
        for k, w in self.windows.items():
            lo, hi = index.search(w)
            count = hi - lo
            rows = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            word = origin[index.locate(rows)]
            lows.append(word)
            highs.append(word + k)
            names += [self.items[k][i] for i in np.repeat(np.arange(len(w)), count).tolist()]
        return np.concatenate(lows), np.concatenate(highs), names


SPANS = T.StructType([T.StructField("n_words", T.LongType()),
                      T.StructField("spans", T.ArrayType(T.StructType([
                          T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                          T.StructField("byte_start", T.LongType()), T.StructField("byte_end", T.LongType())]))),
                      T.StructField("items", T.ArrayType(T.StringType()))])
_SPAN = pa.struct([(c, pa.int64()) for c in ("first", "last", "byte_start", "byte_end")])


def _merge(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    return lo[new], np.append(hi[:-1][new[1:]], hi[-1])


def _scanner(queries, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = queries.value
        for batch in batches:
            for part, table in word_tables(batch, "text", PUNCT, SHARD_BYTES):
                lo, hi, names = q.spans(table)
                doc = np.searchsorted(table.first, lo, side="right") - 1
                spans: list[list] = [[] for _ in range(table.n_docs)]
                items: list[list] = [[] for _ in range(table.n_docs)]
                order = np.argsort(doc, kind="stable")
                bounds = np.searchsorted(doc[order], np.arange(table.n_docs + 1))
                for d in np.unique(doc).tolist():
                    own = order[bounds[d]:bounds[d + 1]]
                    base = int(table.first[d])
                    a, b = _merge(lo[own], hi[own])
                    spans[d] = [{"first": x - base, "last": y - 1 - base,
                                 "byte_start": int(table.starts[x] - table.offsets[d]),
                                 "byte_end": int(table.ends[y - 1] - table.offsets[d])}
                                for x, y in zip(a.tolist(), b.tolist())]
                    items[d] = sorted({n for i in own.tolist() for n in names[i]})
                cols = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.record_batch([*cols, pa.array(table.counts, pa.int64()),
                                       pa.array(spans, pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))],
                                      names=[*keep, "n_words", "spans", "items"])
    return run


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[tuple[list, list]]:
    """The benchmark in blocks of bounded size, read one at a time."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t"))
    chars = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-chars // (block_words * 6)))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    for b in range(n):
        got = rows.filter(part == b).collect()
        yield [r["i"] for r in got], [r["t"] for r in got]


def occurrences(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10,
                block_words: int = 2_000_000) -> DataFrame:
    """``docs`` with n_words, spans (merged word spans, first and last word, with
    byte offsets in the text) and items (ids found); clashing columns are replaced."""
    keep = [c for c in docs.columns if c not in SPANS.names]
    base = docs.select(*keep)
    schema = T.StructType([*base.schema.fields, *SPANS.fields])
    out = None
    for ids, texts in _blocks(benchmark, block_words):
        block = spark.sparkContext.broadcast(Queries.build(ids, texts, window))
        source = base if out is None else out.withColumnsRenamed({c: f"_{c}" for c in SPANS.names})
        own = T.StructType([*source.schema.fields, *SPANS.fields])
        out = source.mapInArrow(_scanner(block, source.columns), own)
        if "_spans" in source.columns:
            out = out.withColumn("spans", _merged(F.concat("_spans", "spans")))
            out = out.withColumn("items", F.array_sort(F.array_union("_items", "items"))).select(*schema.names)
    return out


def _merged(spans):
    """Merged word spans of a concatenated span array."""
    def step(acc, s):
        last = F.element_at(acc, -1)
        joined = F.struct(last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"),
                          last["byte_start"].alias("byte_start"),
                          F.greatest(last["byte_end"], s["byte_end"]).alias("byte_end"))
        head = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))
        touch = (F.size(acc) > 0) & (s["first"] <= F.try_element_at(acc, F.lit(-1))["last"] + 1)
        return F.when(touch, F.concat(head, F.array(joined))).otherwise(F.concat(acc, F.array(s)))
    empty = F.array().cast("array<struct<first:bigint,last:bigint,byte_start:bigint,byte_end:bigint>>")
    return F.aggregate(F.array_sort(spans), empty, step)


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row."""
    out = occurrences(spark, docs.select("doc_id", "text"), benchmark, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.size("spans") > 0).alias("contaminated"))


def remove_benchmark(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` with the merged removal spans cut out of ``text``."""
    found = occurrences(spark, packed(docs, "text"), benchmark, window)
    raw = F.encode("text", "UTF-8")
    # byte pieces between the spans; spans start and end at word bounds, so UTF-8 stays whole
    cuts = F.concat(F.array(F.struct(F.lit(0).cast("long").alias("byte_start"), F.lit(0).cast("long").alias("byte_end"))),
                    F.transform("spans", lambda s: F.struct(s["byte_start"].alias("byte_start"),
                                                            s["byte_end"].alias("byte_end"))))
    found = found.withColumn("_raw", raw).withColumn("_cuts", cuts)
    pieces = F.expr("""array_join(transform(_cuts, (c, i) -> decode(substring(_raw, cast(c.byte_end + 1 as int),
        cast(coalesce(try_element_at(_cuts, i + 2).byte_start, cast(length(_raw) as bigint)) - c.byte_end as int)),
        'UTF-8')), '')""")
    found = found.withColumn("text", F.when(F.size("spans") > 0, pieces).otherwise(F.col("text")))
    return unpacked(found, docs.columns, ("text",))

