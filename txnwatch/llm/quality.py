"""Quality rules: exact text statistics and a hashed n-gram likelihood ratio.

Words are ``[^\\x20\\x09-\\x0D]+``.  The rules count words and their code points, symbols,
repeated lines and words that lie in a repeated window of eight words.

The method compares two multinomials over hashed n-grams: one of documents trusted as good
(labelled quality 1), one of the raw corpus.  Its tokens are runs of letters and digits and
runs of other characters, with their case, so that markup and shouting are words of their
own; tokens and pairs of neighbouring tokens are hashed into 2 ** ``bits`` buckets.  A text's
score is the mean of log p(trusted) - log p(raw) over its n-grams: the length does not tell.
Every document whose score is at least the threshold passes; no draw is involved.

The raw counts cover all n-grams of all documents: one vector of buckets a task, added up in
Spark.  The trusted counts and the threshold are learnt on all labelled documents: one half, by
a hash of the id, gives the counts, the other the threshold that parts the classes best
(largest share of trusted kept less share of the others kept; the lowest of equal ones).
Each half is joined with its labels where it is used; the cut is found by prefix sums over
the distinct scores.  The driver sees 2 ** ``bits`` counts and one cut, whatever the input.

Defined results: null and empty texts have no words and fail the rules.  Several labels of a
document count as trusted if all say so; null labels and null ids are ignored; repeats of a
labelled id are one row, that of smallest text hash.  Without labels of both classes in both
halves all texts score and the threshold is minus infinity, so that the rules alone decide.
Repeated rows score alike; empty tables give empty results; other columns pass through, but
for the added ones, which are replaced where they exist.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch.llm.text import PUNCT, SPACE, WordTable, chunks, mix64, span_hashes
from txnwatch.operators.ordinal import prefix_sums

WINDOW = 8
#: Byte classes of the method's tokens: blank 0, letters and digits 1, others 2.
KIND = np.where(SPACE, 0, 2).astype(np.uint8)
KIND[~PUNCT] = 1
KIND[65:91] = 1  # PUNCT speaks of lower-cased texts
_PAIR = np.uint64(0xD6E8FEB86659FD93)


def is_symbol() -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
    return out


_SYMBOL = is_symbol()


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flagged bytes each text has."""
    upto = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=upto[1:])
    return np.diff(upto[offsets])


def repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n = len(offsets) - 1
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    text = np.searchsorted(offsets, starts, side="right") - 1
    # a feed at the end of a text starts an empty line that belongs to it: it has no word
    ends = np.minimum(np.append(starts[1:], len(data)), len(data))
    ends = ends - ((ends > starts) & (data[np.maximum(ends, 1) - 1] == 10) if len(data) else 0)
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~SPACE[data], out=worded[1:])
    live = np.flatnonzero(worded[ends] > worded[starts])
    if not len(live):
        return np.zeros(n, np.int64)
    keys = mix64(span_hashes(data, starts[live], ends[live]) + mix64(text[live].astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(live), bool)
    again[first] = False
    return np.bincount(text[live][again], minlength=n)


def repeated_words(table: WordTable, hashes: np.ndarray) -> np.ndarray:
    """Words inside windows of WINDOW words that their text holds twice or more."""
    n = len(hashes)
    if n < WINDOW:
        return np.zeros(table.n_docs, np.int64)
    doc = table.doc
    inside = doc[WINDOW - 1:] == doc[:n - WINDOW + 1]
    key = mix64(doc[:n - WINDOW + 1].astype(np.uint64) + np.uint64(1))
    for j in range(WINDOW):
        key = key * _PAIR + hashes[j:n - WINDOW + 1 + j]
    at = np.flatnonzero(inside)
    _, back, times = np.unique(mix64(key[at]), return_inverse=True, return_counts=True)
    hit = at[times[back] > 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + WINDOW, -1)
    return np.bincount(doc[np.cumsum(edge[:n]) > 0], minlength=table.n_docs)


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The rules' counts for each text of a slice."""
    table = WordTable(data, offsets, SPACE)
    table.data = data  # words keep their case here
    return {"n_words": table.counts.astype(np.int64),
            "word_chars": per_text(~SPACE[data] & ((data & 0xC0) != 0x80), offsets),
            "n_symbols": per_text(_SYMBOL[data], offsets),
            "n_dup_lines": repeated_lines(data, offsets),
            "n_repeat_words": repeated_words(table, table.hashes())}


def ngrams(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all tokens and of all pairs of neighbours."""
    kind = KIND[data]
    start = np.ones(len(data), bool)
    start[1:] = kind[1:] != kind[:-1]
    start[offsets[:-1][offsets[:-1] < len(data)]] = True
    edges = np.flatnonzero(start)
    ends = np.append(edges[1:], len(data))
    live = kind[edges] > 0
    starts, ends = edges[live], ends[live]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.searchsorted(offsets, starts, side="right") - 1
    one = span_hashes(data, starts, ends)
    near = text[1:] == text[:-1]
    two = mix64(one[:-1] * _PAIR + one[1:])[near]
    bucket = (np.concatenate([one, two]) >> np.uint64(64 - bits)).astype(np.int64)
    return np.concatenate([text, text[:-1][near]]), bucket


@dataclass
class QualityModel:
    """Log-likelihood ratio of each bucket, and the least score that passes."""

    ratio: np.ndarray
    threshold: float
    bits: int

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, bucket = ngrams(data, offsets, self.bits)
        n = len(offsets) - 1
        total = np.bincount(text, weights=self.ratio[bucket], minlength=n)
        return total / np.maximum(np.bincount(text, minlength=n), 1)


def bucket_counts(docs: DataFrame, bits: int) -> np.ndarray:
    """Counts of all hashed n-grams of ``docs``: 2 ** bits numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for _, data, offsets in chunks(batch, "text"):
                total += np.bincount(ngrams(data, offsets, bits)[1], minlength=1 << bits)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    rows = (docs.select("text").mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(1 << bits)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def in_half() -> Column:
    """Whether a document's labels give the counts (else the threshold)."""
    return F.xxhash64(F.lit(3), F.col("doc_id").cast("string")) % 2 == 0


def labelled_rows(docs: DataFrame, labels: DataFrame, max_rows: int | None = None) -> DataFrame:
    """text, good, half of all labelled documents, or of at most ``max_rows`` of each class."""
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg((F.min("quality") > 0).alias("good")))
    if max_rows is not None:
        order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
        known = known.filter("good").orderBy(*order).limit(max_rows).union(
            known.filter("not good").orderBy(*order).limit(max_rows))
    # by shuffle at any size: labels grow with the documents
    rows = docs.select("doc_id", "text").join(known.hint("merge"), "doc_id")
    one = rows.groupBy("doc_id", "good").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    return one.select(F.col("first.text").alias("text"), "good", in_half().alias("half"))


def log_ratio(trusted: np.ndarray, raw: np.ndarray, smoothing: float) -> np.ndarray:
    """log p(trusted) - log p(raw) of each bucket, both smoothed by ``smoothing`` a bucket."""
    b = len(raw)
    return (np.log((trusted + smoothing) / (trusted.sum() + smoothing * b))
            - np.log((raw + smoothing) / (raw.sum() + smoothing * b)))


def best_threshold(scored: DataFrame) -> float:
    """The lowest llr whose cut keeps the largest share of good less share of others."""
    # a cut stands before all rows of equal score
    found = scored.groupBy("llr").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b")).checkpoint()
    total = found.agg(F.sum("g").alias("g"), F.sum("b").alias("b")).first()
    if not total["g"] or not total["b"]:
        return float("-inf")
    gain = F.col("b_before") / total["b"] - F.col("g_before") / total["g"]
    cuts = prefix_sums(found, ["llr"], ["g", "b"]).select("llr", gain.alias("gain"))
    return float(cuts.orderBy(F.col("gain").desc(), "llr").first()["llr"])


def fit(docs: DataFrame, labels: DataFrame, max_rows: int | None = None, bits: int = 16,
        smoothing: float = 1.0) -> QualityModel:
    raw = bucket_counts(docs, bits)
    # the half is told by the id, so each pass joins and moves the texts of its half only
    trusted = bucket_counts(labelled_rows(docs.filter(in_half()), labels, max_rows).filter("good"), bits)
    model = QualityModel(log_ratio(trusted, raw, smoothing), float("-inf"), bits)
    if trusted.any():
        others = labelled_rows(docs.filter(~in_half()), labels, max_rows)
        model.threshold = best_threshold(score(others, model).select("llr", "good"))
    return model


ADDED = T.StructType([*(T.StructField(c, T.LongType()) for c in
                        ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                      T.StructField("llr", T.DoubleType())])


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs`` with the rules' counts and llr, the mean log-likelihood ratio."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ADDED.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part, data, offsets in chunks(batch, "text"):
                cols = [part.column(part.schema.get_field_index(c)) for c in keep]
                made = [*statistics(data, offsets).values(), m.score(data, offsets)]
                yield pa.record_batch([*cols, *map(pa.array, made)], names=[*keep, *ADDED.names])

    base = docs.select(*keep)
    return base.mapInArrow(run, T.StructType([*base.schema.fields, *ADDED.fields]))


def judge(docs: DataFrame, model: QualityModel, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """``score`` with base_failed (the rules) and kept (the rules and the method)."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return (score(docs, model).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(model.threshold))))
