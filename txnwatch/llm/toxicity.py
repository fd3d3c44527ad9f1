"""Toxicity classifier with counterfactual regularisation.

A logistic model over word presence, fitted on at most ``max_rows`` labelled
documents of each class (a documented bound; the rows of smallest id hash).  Word
counts by class come from a Spark aggregation over that sample; the ``vocabulary``
words of largest association (in at least 3 texts, which a weight needs to be told from
chance) and the identity terms are the features, so what the driver fits on is bounded
by max_rows x features.

Counterfactuals: in each sentence of the sample an identity term is swapped with the
other terms of its group, and the mean squared change of the sentence's score (the log odds)
over all swapped sentences is the penalty, so that a neutral mention of one group scores
like any other.  A change depends on the sentence only by whether it holds the other term
too, so counts of sentences by term and by pair of terms, added up in Spark, give the penalty
of all swapped sentences as one quadratic form.  Terms are the given groups' as far as they
occur, and families of the corpus: words of at least ``2 + STEM`` letters with the
same first ``STEM`` letters (forms of one name, whatever the language) that occur in texts of
both labels, ``FAMILY`` texts at least.

The fit (l1, log loss, penalty) takes accelerated proximal steps on the features that may
move, with the curvature of loss and penalty as the step, until a step moves no weight by
``TOLERANCE`` and no other feature's gradient exceeds l1.

Scoring is one pass over whole texts without a shuffle.

Defined results: null and empty texts get the score of no words.  Rows with a null
doc_id are never learned from and not held out.  Several labels of a document count
as toxic if one says so; null labels are ignored.  Without labelled rows all scores
are 0; with one class only, its smoothed rate.  Repeated rows score alike; empty
tables give empty results; other columns pass through ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch.llm.text import PUNCT, WordTable, span_hashes, word_hashes, word_tables

#: Groups of identity terms; a term is swapped with the others of its group.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girl", "boy"), ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("gay", "lesbian", "bisexual", "transgender", "queer", "straight", "heterosexual"),
    ("black", "white", "asian", "latino", "latina", "hispanic", "african", "european", "arab", "indigenous"),
    ("mexican", "chinese", "indian", "russian", "german", "french", "turkish", "polish", "japanese"),
    ("immigrant", "refugee", "foreigner", "native"), ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "autistic"), ("old", "young", "elderly", "teenage"),
)


STEM = 6
FAMILY = 5
TOLERANCE = 1e-6


@dataclass
class ToxicityModel:
    """Sorted word hashes, their weights and the bias (null bias: no training rows)."""

    words: np.ndarray
    weights: np.ndarray
    bias: float | None

    def __post_init__(self) -> None:
        self.gate = np.zeros(1 << 16, bool)
        self.gate[(self.words >> np.uint64(48)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word position, feature) of the words that are features."""
        maybe = np.flatnonzero(self.gate[(h >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.words, h[maybe]), max(len(self.words) - 1, 0))
        ok = self.words[at] == h[maybe] if len(self.words) else np.zeros(len(maybe), bool)
        return maybe[ok], at[ok]

    def features(self, table: WordTable) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, feature) pairs."""
        pos, feat = self.find(table.hashes())
        doc = np.searchsorted(table.first, pos, side="right") - 1
        pair = np.unique(doc * max(len(self.words), 1) + feat)
        return pair // max(len(self.words), 1), pair % max(len(self.words), 1)

    def score(self, table: WordTable) -> np.ndarray:
        if self.bias is None:
            return np.zeros(table.n_docs)
        doc, feat = self.features(table)
        z = self.bias + np.bincount(doc, weights=self.weights[feat], minlength=table.n_docs)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the doc_id as text, mod 4, is 2 (a null id is not held out)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """text, y: at most max_rows labelled documents of each class, none held out."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("y")))
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    picked = known.filter("y = 1").orderBy(*order).limit(max_rows).union(
        known.filter("y = 0").orderBy(*order).limit(max_rows))
    picked = picked.select(F.col("doc_id").alias("_id"), "y")
    # at most 2 * max_rows ids
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    # repeats of an id are one row, the text of smallest hash
    one = rows.groupBy("_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    return one.select(F.col("first.text").alias("text"), "y")


def given_groups(groups=IDENTITY_GROUPS) -> dict[int, int]:
    """Word hash -> group of the given identity terms."""
    terms = [(t, i) for i, g in enumerate(groups) for t in g]
    return dict(zip(word_hashes([t for t, _ in terms]).view(np.int64).tolist(), (i for _, i in terms)))


def _stems(table: WordTable, at: np.ndarray) -> np.ndarray:
    """Hash of the first STEM letters of the words at ``at``, 0 for shorter words."""
    begins = np.flatnonzero((table.data & 0xC0) != 0x80)
    letter = np.searchsorted(begins, table.starts[at])
    letters = np.searchsorted(begins, table.ends[at]) - letter
    out = np.zeros(len(at), np.int64)
    long = np.flatnonzero(letters >= STEM + 2)
    if len(long):
        order = long[np.argsort(table.starts[at[long]], kind="stable")]
        out[order] = span_hashes(table.data, table.starts[at[order]], begins[letter[order] + STEM]).view(np.int64)
    return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, table in word_tables(batch, "text", PUNCT):
            y = part.column(part.schema.get_field_index("y")).to_numpy(zero_copy_only=False)
            word, at, inv = np.unique(table.hashes(), return_index=True, return_inverse=True)
            pair = np.unique(inv * table.n_docs + table.doc)
            w, d = pair // table.n_docs, pair % table.n_docs
            both = np.bincount(w, minlength=len(word))
            toxic = np.bincount(w, weights=y[d], minlength=len(word)).astype(np.int64)
            yield pa.record_batch([pa.array(word.view(np.int64)), pa.array(_stems(table, at)), pa.array(both), pa.array(toxic)],
                                  names=["word", "stem", "n", "n_toxic"])


def _sentence_pairs(groups):
    """(t, u, n): sentences that hold both of two terms of a group (t = u: that hold t)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = groups.value
        terms = np.array(sorted(known), np.int64).view(np.uint64)
        terms = np.sort(terms)
        for batch in batches:
            for _, table in word_tables(batch, "text", PUNCT):
                h = table.hashes()
                stops = np.flatnonzero(np.isin(table.data, np.frombuffer(b".!?\n", np.uint8)))
                named = np.flatnonzero(np.isin(h, terms))
                sentence = np.searchsorted(stops, table.starts[named]) * (table.n_docs + 1) + table.doc[named]
                found: dict[int, set[int]] = {}
                for s, t in zip(sentence.tolist(), h[named].view(np.int64).tolist()):
                    found.setdefault(s, set()).add(t)
                counts: dict[tuple[int, int], int] = {}
                for held in found.values():
                    for t in held:
                        for u in held:
                            if known[t] == known[u]:
                                counts[t, u] = counts.get((t, u), 0) + 1
                if counts:
                    t, u = zip(*counts)
                    yield pa.record_batch([pa.array(t, pa.int64()), pa.array(u, pa.int64()), pa.array(list(counts.values()), pa.int64())],
                                          names=["t", "u", "n"])
    return run


def _feature_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for part, table in word_tables(batch, "text", PUNCT):
                doc, feat = m.features(table)
                cut = np.searchsorted(doc, np.arange(table.n_docs + 1))
                blobs = [feat[cut[i]:cut[i + 1]].astype(np.int32).tobytes() for i in range(table.n_docs)]
                yield pa.record_batch([part.column(part.schema.get_field_index("y")), pa.array(blobs, pa.binary())],
                                      names=["y", "feats"])
    return run


def swap_form(group: np.ndarray, sentences: dict[tuple[int, int], int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse (i, j, q) of the mean squared score change over all swapped sentences.

    ``group`` numbers the group of each feature (-1: none); ``sentences`` counts those that
    hold features t and u.  Swapping t for u changes the score by w_t - w_u, or by w_t where
    the sentence holds u already."""
    q: dict[tuple[int, int], float] = {}
    total = 0.0
    members: dict[int, list[int]] = {}
    for k in np.flatnonzero(group >= 0).tolist():
        members.setdefault(int(group[k]), []).append(k)
    for group_members in members.values():
        for t in group_members:
            n = sentences.get((t, t), 0)
            for u in group_members:
                if u == t or not n:
                    continue
                total += n
                alone = n - sentences.get((t, u), 0)
                for key, x in (((t, t), n), ((u, u), alone), ((t, u), -alone), ((u, t), -alone)):
                    q[key] = q.get(key, 0.0) + x
    if not total:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    i, j = (np.array(x, np.int64) for x in zip(*q))
    return i, j, np.array(list(q.values())) / total


def _largest(apply, n: int, rounds: int = 30) -> float:
    """Largest eigenvalue of a positive form, a little more."""
    v, size = np.ones(n) / np.sqrt(max(n, 1)), 0.0
    for _ in range(rounds):
        v = apply(v)
        size = np.linalg.norm(v)
        if not size:
            return 0.0
        v = v / size
    return 1.05 * size


def _fit(row: np.ndarray, col: np.ndarray, y: np.ndarray, sample_weight: np.ndarray, k: int,
         form: tuple[np.ndarray, np.ndarray, np.ndarray], l1: float, penalty: float, steps: int = 20_000,
         tolerance: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """Weights and bias of least weighted log loss + l1 + penalty * mean squared score change.

    Steps are taken on the features that have moved or would; when they stand still, those
    whose gradient exceeds l1 join, until there are none."""
    n = len(y)
    sw = sample_weight / sample_weight.sum()
    rate = (sw * y).sum()
    w, bias = np.zeros(k), float(np.log(rate / (1 - rate)))
    qi, qj, q = form

    def gradient(w: np.ndarray, bias: float, row, col, width: int, qi, qj, q) -> tuple[np.ndarray, float]:
        margin = np.bincount(row, weights=w[col], minlength=n) + bias
        err = sw * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y)
        g = np.bincount(col, weights=err[row], minlength=width)
        return g + 2 * penalty * np.bincount(qi, weights=q * w[qj], minlength=width), float(err.sum())

    active = np.zeros(0, np.int64)
    while True:
        g, _ = gradient(w, bias, row, col, k, qi, qj, q)
        over = np.where(w == 0, np.abs(g) - l1, 0.0)
        over[active] = 0
        join = np.argsort(-over, kind="stable")[:256]
        join = join[over[join] > 1e-3 * l1]
        if len(active) and not len(join):
            return w, bias
        active = np.union1d(np.flatnonzero(w), join)
        # the same problem on the active features
        at = np.full(k, -1)
        at[active] = np.arange(len(active))
        mine = at[col] >= 0
        r, c = row[mine], at[col[mine]]
        inside = (at[qi] >= 0) & (at[qj] >= 0)
        part = (at[qi[inside]], at[qj[inside]], q[inside])
        m = len(active)

        def curved(v: np.ndarray) -> np.ndarray:
            u = sw * (np.bincount(r, weights=v[:m][c], minlength=n) + v[m])
            top = 0.25 * np.bincount(c, weights=u[r], minlength=m)
            return np.append(top + 2 * penalty * np.bincount(part[0], weights=part[2] * v[:m][part[1]], minlength=m), 0.25 * u.sum())

        step = 1 / (_largest(curved, m + 1) or 1.0)
        x = np.append(w[active], bias)
        z, t = x.copy(), 1.0
        for _ in range(steps):
            gw, gb = gradient(z[:m], z[m], r, c, m, *part)
            new = z - step * np.append(gw, gb)
            new[:m] = np.sign(new[:m]) * np.maximum(np.abs(new[:m]) - step * l1, 0)
            move = new - x
            if (z - new) @ move > 0:  # the momentum points uphill: start it anew
                t = 1.0
            t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
            z = new + (t - 1) / t_new * move
            x, t = new, t_new
            if np.abs(move).max() < tolerance and np.abs(z - x).max() < 10 * tolerance:
                break
        w = np.zeros(k)
        w[active], bias = x[:m], float(x[m])
        if not m:
            return w, bias


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000, vocabulary: int = 4096,
        l1: float = 3e-4, penalty: float = 1.0, groups=IDENTITY_GROUPS, families: int = 200, steps: int = 20_000) -> ToxicityModel:
    """``families``: at most so many families of the corpus, those of most texts; a family has
    its 32 most frequent members (bounds of the features, as ``vocabulary``)."""
    spark = docs.sparkSession
    train = training_rows(docs, labels, max_rows).checkpoint()  # read several times
    counts = (train.mapInArrow(_word_counts, "word long, stem long, n long, n_toxic long")
              .groupBy("word", "stem").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("p")).checkpoint())
    totals = train.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).first()
    n_all, n_pos = totals["n"], totals["p"] or 0
    if not n_all:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), None)
    if n_pos in (0, n_all):
        rate = (n_pos + 1) / (n_all + 2)
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(rate / (1 - rate))))
    a, b = F.col("p") + 0.5, F.col("n") - F.col("p") + 0.5
    lean = F.abs(F.log(a / (n_pos + 1 - a)) - F.log(b / (n_all - n_pos + 1 - b))) / F.sqrt(1 / a + 1 / b)
    top = (counts.filter("n >= 3").select("word", lean.alias("z"))
           .orderBy(F.desc("z"), "word").limit(vocabulary).collect())
    # terms: the given ones that occur, and families of the corpus
    given = given_groups(groups)
    occur = [r["word"] for r in counts.filter(F.col("word").isin(list(given))).select("word").collect()]
    named = {t: given[t] for t in occur}
    mixed = counts.filter((F.col("stem") != 0) & (F.col("n") >= FAMILY) & (F.col("p") > 0) & (F.col("p") < F.col("n")))
    place = F.row_number().over(Window.partitionBy("stem").orderBy(F.desc("n"), "word"))
    mixed = mixed.withColumn("place", place).filter("place <= 32")
    kin = (mixed.groupBy("stem").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).filter("k > 1")
           .orderBy(F.desc("n"), "stem").limit(families).select("stem"))
    for r in mixed.join(F.broadcast(kin), "stem").select("word", "stem").collect():
        named.setdefault(r["word"], r["stem"])
    ids = {g: i for i, g in enumerate(sorted(set(named.values())))}
    named = {t: ids[g] for t, g in named.items()}
    words = np.unique(np.array([r["word"] for r in top] + list(named), np.int64).view(np.uint64))
    k = len(words)
    group = np.full(k, -1)
    position = {w: i for i, w in enumerate(words.view(np.int64).tolist())}
    for t, g in named.items():
        group[position[t]] = g
    shared = spark.sparkContext.broadcast(named)
    seen = (train.mapInArrow(_sentence_pairs(shared), "t long, u long, n long")
            .groupBy("t", "u").agg(F.sum("n").alias("n")).collect()) if named else []
    form = swap_form(group, {(position[r["t"]], position[r["u"]]): r["n"] for r in seen})
    shape = spark.sparkContext.broadcast(ToxicityModel(words, np.zeros(k), 0.0))
    rows = train.mapInArrow(_feature_rows(shape), "y int, feats binary").toArrow()
    y = rows["y"].to_numpy().astype(float)
    feats = [np.frombuffer(x, np.int32) for x in rows["feats"].to_pylist()]
    row = np.repeat(np.arange(len(y)), [len(x) for x in feats])
    col = np.concatenate(feats).astype(np.int64) if feats else np.zeros(0, np.int64)
    # classes are sampled apart: weigh each back to its share of all labelled rows
    share = labels.filter(F.col("toxic").isNotNull() & ~held_out()).agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
    share = min(max(share, 1e-4), 1 - 1e-4)
    weight = np.where(y > 0, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1))
    w, bias = _fit(row, col, y, weight, k, form, l1, penalty, steps)
    return ToxicityModel(words, w, bias)


def score(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """``docs`` with a score between 0 and 1 for each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, table in word_tables(batch, "text", PUNCT):
                cols = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.record_batch([*cols, pa.array(shared.value.score(table))], names=[*keep, column])

    base = docs.select(*keep)
    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(column, T.DoubleType())]))
