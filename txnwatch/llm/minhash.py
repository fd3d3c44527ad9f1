"""Near-duplicate documents by min-max hashing.

Each document is its set of distinct ``words``-word shingles.  A permutation is
evaluated once per shingle and gives two signature values, the minimum and the
maximum, so 48 evaluations give 96 values.  Two permutations (four values) make
a band; documents that agree on a band land in a bucket.

* Identical sets are one class before anything is banded or shuffled.
* Buckets give star edges (smallest class, member); their components are
  *families*.  No pairs are listed.
* Inside a family every pair is compared on full sets.  A family above
  ``BLOCK`` classes or ``VOLUME`` shingles is cut into blocks by set size and hash,
  down to one class a block, and each pair of blocks whose sizes can reach the
  threshold is a task of its own, which compares ranges of shingle hashes one after
  another and returns a spanning forest of its confirmed links (fewer than 2 * BLOCK
  rows).
* Components of the confirmed links are the result.

A pair at the threshold shares no band with probability (1 - s^4)^24, about
2e-8 for 0.85 and 3e-6 for 0.8.

Defined results: null, empty and wordless texts have an empty set, are linked
with nothing and are kept.  With fewer words than ``words``, the whole sequence is
the one shingle.  Repeated rows have equal sets, so they share a component; rows
that repeat the kept doc_id are all kept.  A null doc_id is never a component
id while another member has one; rows without any component id are kept.
Extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.graph import components
from txnwatch.llm.text import SPACE, WordTable, mix64, packed, unpacked, word_tables

PERMUTATIONS = 48
BANDS = 24
BLOCK = 1024
#: Shingles in a comparison task, about (64 MB of sets), and in one range of hashes.
VOLUME = 8 << 20
RANGE = 1 << 20
#: Tables with a row per family or class in one are broadcast up to this many rows, else joined.
BROADCAST_ROWS = 1_000_000
_COLS = 4096

_SEED = mix64(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64))
_XOR, _ODD = _SEED[:PERMUTATIONS], _SEED[PERMUTATIONS:] | np.uint64(1)


def shingle_sets(table: WordTable, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    h = table.hashes()
    if len(h) >= words:
        roll = h[:len(h) - words + 1].copy()
        for k in range(1, words):
            roll *= np.uint64(0xD6E8FEB86659FD93)
            roll += h[k:len(h) - words + 1 + k]
        roll = mix64(roll)
    else:
        roll = np.zeros(0, np.uint64)
    out = []
    for a, n in zip(table.first[:-1].tolist(), table.counts.tolist()):
        if n >= words:
            out.append(np.unique(roll[a:a + n - words + 1]))
        elif n:
            acc = np.full(1, n, dtype=np.uint64)
            for x in h[a:a + n]:
                acc = acc * np.uint64(0xA0761D6478BD642F) + x
            out.append(mix64(acc))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class_id(s: np.ndarray) -> bytes:
    """128-bit fingerprint of a set."""
    a = mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = mix64(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return np.array([a, b ^ np.uint64(len(s))], dtype=">u8").tobytes()


def _bands(s: np.ndarray) -> np.ndarray:
    low = np.empty(PERMUTATIONS, np.uint64)
    high = np.empty(PERMUTATIONS, np.uint64)
    for p in range(PERMUTATIONS):
        x = (s ^ _XOR[p]) * _ODD[p]
        x ^= x >> np.uint64(32)
        x *= _ODD[p - 1]
        low[p], high[p] = x.min(), x.max()
    v = np.stack([low, high], 1).reshape(BANDS, -1)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for c in range(v.shape[1]):
        key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + v[:, c])
    return key.view(np.int64)


def _signer(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("cid", pa.binary()),
                        ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, table in word_tables(batch, "text", SPACE):
                sets = shingle_sets(table, words)
                yield pa.record_batch([
                    *(part.column(part.schema.get_field_index(c)) for c in ("doc_id", "text_key")),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_class_id(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([_bands(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ], schema=schema)
    return run


def _set_rows(words: int):
    schema = pa.schema([("cid", pa.binary()), ("members", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, table in word_tables(batch, "text", SPACE):
                sets = [s for s in shingle_sets(table, words) if len(s)]
                yield pa.record_batch([pa.array([_class_id(s) for s in sets], pa.binary()),
                                       pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)
    return run


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    value, inv, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), sizes)
    shared = df[inv] > 1
    owner, col = owner[shared], (np.cumsum(df > 1) - 1)[inv[shared]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    common = np.zeros((m, m), np.float32)
    n_cols = int(col[-1]) + 1 if len(col) else 0
    for c in range(0, n_cols, _COLS):
        i, j = np.searchsorted(col, [c, c + _COLS])
        x = np.zeros((m, min(_COLS, n_cols - c)), np.float32)
        x[owner[i:j], col[i:j] - c] = 1
        common += x @ x.T
    return common.astype(np.int64)


def _linked(sets: list[np.ndarray], percent: int, left: int, most: int = RANGE) -> list[tuple[int, int]]:
    """Spanning forest of the pairs (i < j) with 100 * common >= percent * union;
    only pairs across ``left`` if it splits the list, else all."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    n_ranges = max(1, -(-int(sizes.sum()) // most))
    edges = np.array([(r << 64) // n_ranges for r in range(1, n_ranges)], np.uint64)
    cuts = [np.concatenate([[0], np.searchsorted(s, edges), [len(s)]]) for s in sets]
    inter = np.zeros((m, m), np.int64)
    for r in range(n_ranges):
        inter += _common([s[c[r]:c[r + 1]] for s, c in zip(sets, cuts)])
    ok = 100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter)
    ok &= inter > 0
    np.fill_diagonal(ok, False)
    if left:
        ok[:left, :left] = ok[left:, left:] = False
    forest, seen = [], np.zeros(m, bool)
    for root in range(m):
        if seen[root]:
            continue
        seen[root] = True
        stack = [root]
        while stack:
            i = stack.pop()
            new = np.flatnonzero(ok[i] & ~seen)
            seen[new] = True
            forest += [(i, int(j)) for j in new]
            stack += new.tolist()
    return forest


def _compare(percent: int):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        fam, side = t["family"].to_pylist(), t["side"].to_pylist()
        cid, blob = t["cid"].to_pylist(), t["members"].to_pylist()
        rows: dict[bytes, list[int]] = {}
        for i, f in enumerate(fam):
            rows.setdefault(f, []).append(i)
        u, v = [], []
        for own in rows.values():
            own.sort(key=lambda i: side[i])
            sets = [np.frombuffer(blob[i], dtype=np.uint64) for i in own]
            for a, b in _linked(sets, percent, sum(side[i] == 0 for i in own) % len(own)):
                u.append(cid[own[a]])
                v.append(cid[own[b]])
        return pa.table({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})
    return run


def _small(df: DataFrame) -> DataFrame:
    """A checkpointed table, marked for broadcast if it has few enough rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _tasks(classes: DataFrame, percent: int, block: int, volume: int = VOLUME) -> DataFrame:
    """(cid, family, task, side): which comparison task gets a class.  Small
    families are packed into tasks by the volume of their sets; a large family
    has a task for each pair of blocks of equal or neighbouring size level.
    Sides 0 and 1 are the blocks of a task that compares two blocks."""
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    packs = int(shingles // 250_000) + 1  # about 2 MB of sets each
    # a row per large family only, so the join keeps its large side in place
    big = (classes.groupBy("family").agg(F.count(F.lit(1)).alias("family_size"), F.sum("n").alias("family_volume"))
           .filter((F.col("family_size") > block) | (F.col("family_volume") > volume))
           .select("family", "family_size").checkpoint())
    rows = classes.join(_small(big), "family", "left")
    small = (rows.filter("family_size IS NULL")
             .select("cid", "family", F.concat(F.lit("p"), F.pmod(F.xxhash64("family"), F.lit(packs))).alias("task"),
                     F.lit(0).alias("side")))
    level = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int")
    large = rows.filter("family_size IS NOT NULL").select("cid", "family", "n", level.alias("level"))
    parts = F.greatest(F.ceil(F.col("k") / (block // 2)), F.least("k", F.ceil(F.col("v") / (volume // 2))))
    cuts = (large.groupBy("family", "level").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("v"))
            .select("family", "level", parts.cast("int").alias("parts")).checkpoint())
    own = cuts.select("family", "level", "parts")
    near = cuts.select("family", F.col("level").alias("low"), F.col("parts").alias("low_parts"))
    pairs = (own.join(near, "family")
             .filter(F.col("level").between(F.col("low"), F.col("low") + 1))
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("low_parts") - 1)))
             .filter("level > low OR i >= j")
             .withColumn("task", F.concat_ws(":", F.hex("family"), "level", "i", "low", "j")))
    same = F.expr("level = low AND i = j")
    sides = pairs.select("family", "level", F.col("i").alias("part"), "task", F.lit(0).alias("side")).union(
        pairs.filter(~same).select("family", F.col("low").alias("level"), F.col("j").alias("part"), "task",
                                   F.lit(1).alias("side")))
    placed = (large.join(_small(cuts), ["family", "level"])
              .withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
              .join(sides, ["family", "level", "part"])
              .select("cid", "family", "task", "side"))
    return small.union(placed)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, block: int = BLOCK,
                    carry_key: bool = False, volume: int = VOLUME) -> DataFrame:
    """doc_id, n_shingles, cid, component_id, kept: one row per row of ``docs``;
    with ``carry_key`` also text_key, the xxhash64 of the text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = texts.withColumn("text_key", F.xxhash64("text") if carry_key else F.lit(0).cast("long"))
    signed = keyed.mapInArrow(_signer(words), "doc_id long, text_key long, n long, cid binary, bands array<long>"
                              ).checkpoint()
    classes = (signed.filter("n > 0").groupBy("cid")
               .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    member = classes.select("cid", F.explode("bands").alias("bucket"))
    leader = (member.groupBy("bucket").agg(F.min("cid").alias("u"), F.count(F.lit(1)).alias("k"))
              .filter("k > 1").select("bucket", "u"))
    families = components(member.join(leader, "bucket").select("u", F.col("cid").alias("v")))
    families = (families.select(F.col("node").alias("cid"), F.col("root").alias("family"))
                .join(signed.groupBy("cid").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "cid")
                .checkpoint())
    wanted = _small(families.select(F.col("rep").alias("doc_id")).distinct())
    chosen = texts.join(wanted, texts.doc_id.eqNullSafe(wanted.doc_id), "left_semi")
    sets = chosen.mapInArrow(_set_rows(words), "cid binary, members binary")
    sets = sets.join(families.select("cid"), "cid", "left_semi").dropDuplicates(["cid"])
    links = (_tasks(families, percent, block, volume).join(sets, "cid").groupBy("task")
             .applyInArrow(_compare(percent), "u binary, v binary"))
    found = components(links)
    named = (found.join(families.select("cid", "rep"), found.node == F.col("cid"))
             .groupBy("root").agg(F.min("rep").alias("component_id")))
    linked = found.join(named, "root").select(F.col("node").alias("cid"), "component_id")
    alone = classes.select("cid", "rep")
    label = alone.join(linked, "cid", "left").select("cid", F.coalesce("component_id", "rep").alias("component_id"))
    label = label.checkpoint()  # a plain table, so that the join below can split a class of very many copies
    out = signed.select("doc_id", F.col("n").alias("n_shingles"), "cid", *["text_key"] * carry_key).join(label, "cid", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is the kept one of its group.

    Rows are told apart by doc_id and text; exact repeats of a kept row leave one.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_name")
    keyed = packed(docs, "doc_id", "text").withColumns({"_name": name, "_key": F.xxhash64("text")})
    marks = near_duplicates(docs.select("doc_id", "text"), words, percent, carry_key=True)
    lost = marks.filter(~F.col("kept")).select(name, F.col("text_key").alias("_key")).distinct()
    # repeats meet where the join has put them
    kept = keyed.join(lost, ["_name", "_key"], "left_anti").dropDuplicates(["_name", "_key"])
    return unpacked(kept, docs.columns, ("doc_id", "text"))
