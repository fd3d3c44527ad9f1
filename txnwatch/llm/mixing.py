"""Mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Targets: sources in code point order, null last, have weights repeating
``weights`` and share all words.  A target stops at ``cap`` times its source; the
excess goes to the others by weight.  With sources ordered by cap size / weight
that is one water level: the largest of (words left) / (weights left).

Samples: a document's expected copies are its source's level times its favour (a small
whole number; by default the binary digits of its size, so that long texts come more
often), stopped at ``cap``; the level makes the expected words the target.  As favours are
few, that is one more water level, over the word sums by source and favour.  The whole
part of the expected copies is taken for certain.  The fraction is the inclusion
probability of one more: rank = odds of a uniform number / odds of inclusion, and the
documents of smallest rank are taken until the words reach the rest of the target (the
last one if that comes nearer).  The uniform number is a hash of seed and doc_id.

No source is sorted: ranks fall into buckets (of their logarithm, so that no bucket holds
much of a source, whatever the odds), per-bucket word sums find the bucket where the target
is met, and only that bucket's rows are ordered.  The decision for a row then depends on
its source's cutoff alone, so texts are never shuffled.

Defined results: a null text has 0 words; a null source is a source, the last.  Rows
equal in doc_id and text have equal rank and are taken or left together.  Sources
without words have target 0.  Empty tables give empty results; other columns pass
through ``draw`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 50_000
#: Logarithms of ranks lie between -SPAN and SPAN; a unit holds at most a quarter of a source's favour.
SPAN = 128
#: Tables with a row per source or per source and favour are broadcast up to this many rows, else joined.
BROADCAST_ROWS = 100_000


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _uniform(seed: str) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """source, source_size, target from one row per source (source, source_size)."""
    place = Window.orderBy(F.col("source").asc_nulls_last())
    # one row per source; these windows see the aggregated source table only
    rows = sizes.withColumn("_place", F.row_number().over(place))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    rows = rows.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(cap))
    every = Window.partitionBy()
    by_room = Window.orderBy(F.col("_cap") / F.col("_w"), "_place")
    upto = by_room.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = rows.withColumn("_level", (F.sum("source_size").over(every) - F.sum("_cap").over(upto) + F.col("_cap"))
                           / F.sum("_w").over(onward))
    rows = rows.withColumn("_water", F.max("_level").over(every))
    return rows.select("source", "source_size",
                       F.least(F.col("_cap"), F.col("_water") * F.col("_w")).cast("double").alias("target"))


def size_digits(size: Column | str = "size") -> Column:
    """The default favour: binary digits of the size, 1 for none."""
    return F.length(F.bin(size)).cast("long")


def copy_rates(sums: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """source, favour, source_size, target, rate (expected copies), rest (words to sample in
    the source) from one row per source and favour (source, favour, words)."""
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    targets = targets.withColumnRenamed("source", "_src")
    rows = sums.join(targets, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
    # the favours of a source are few; those of most favour reach the cap first
    order = Window.partitionBy("source").orderBy(F.col("favour").desc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy("source")
    left = F.col("target") - float(cap) * F.coalesce(F.sum("words").over(before), F.lit(0))
    rows = rows.withColumn("_level", F.try_divide(left, F.sum(F.col("favour") * F.col("words")).over(onward)))
    rows = rows.withColumn("rate", F.coalesce(F.least(F.lit(float(cap)), F.max("_level").over(every) * F.col("favour")), F.lit(0.0)))
    rest = F.col("target") - F.sum(F.floor("rate") * F.col("words")).over(every)
    return rows.withColumn("rest", rest).select("source", "favour", "source_size", "target", "rate", "rest")


def _ranked(rows: DataFrame, rates: DataFrame, buckets: int, seed: str) -> DataFrame:
    """Adds target, whole copies, the words that remain to be sampled, rank and bucket (null
    for rows that have whole copies only)."""
    r = rates.withColumnsRenamed({"source": "_src", "favour": "_fav"})
    out = rows.join(r, F.col("source").eqNullSafe(F.col("_src")) & (F.col("favour") == F.col("_fav")), "left").drop("_src", "_fav")
    out = out.withColumn("_whole", F.floor("rate")).withColumn("_p", F.col("rate") - F.floor("rate"))
    out = out.withColumn("_u", _uniform(seed))
    rank = F.col("_u") / (1 - F.col("_u")) / (F.col("_p") / (1 - F.col("_p")))
    out = out.withColumn("_rank", F.when(F.col("_p") > 0, rank))
    return out.withColumn("_bucket", F.floor((F.log("_rank") + SPAN) * (buckets / (2 * SPAN))))


def cutoffs(rows: DataFrame, rates: DataFrame, buckets: int, seed: str) -> DataFrame:
    """source, cut_bucket, cut_at: the bucket where a source's target is met and the
    last (rank, doc_id, text_key) taken in it (null: none of that bucket); no row for a
    source whose sampled rows are all taken."""
    ranked = _ranked(rows, rates, buckets, seed).filter("_rank IS NOT NULL")
    sums = ranked.groupBy("source", "_bucket").agg(F.sum("size").alias("s"), F.first("rest").alias("rest"))
    running = Window.partitionBy("source").orderBy("_bucket")
    cut = (sums.withColumn("upto", F.sum("s").over(running)).filter(F.col("upto") > F.col("rest"))
           .groupBy("source").agg(F.min(F.struct("_bucket", (F.col("upto") - F.col("s")).alias("below"))).alias("b"))
           .select(F.col("source").alias("_src"), F.col("b._bucket").alias("cut_bucket"), F.col("b.below").alias("below")))
    edge = ranked.join(cut, F.col("source").eqNullSafe(F.col("_src")) & (F.col("_bucket") == F.col("cut_bucket")))
    edge = (edge.groupBy("_src", "cut_bucket", "below", "rest", "_rank", "doc_id", "text_key")
            .agg(F.sum("size").alias("s")))
    order = Window.partitionBy("_src", "cut_bucket").orderBy("_rank", F.col("doc_id").asc_nulls_first(), "text_key")
    upto = F.col("below") + F.sum("s").over(order)
    edge = edge.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("s"))
    taken = F.expr("upto <= rest or (before < rest and upto + before < 2 * rest)")
    last = edge.filter(taken).groupBy("_src").agg(F.max(F.struct(
        F.col("_rank").alias("r"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"),
        F.col("text_key").alias("k"))).alias("cut_at"))
    last = last.withColumnRenamed("_src", "_last")
    return (cut.join(last, F.col("_src").eqNullSafe(F.col("_last")), "left")
            .select(F.col("_src").alias("source"), "cut_bucket", "cut_at"))


def _plan(docs: DataFrame, weights: tuple[float, ...], cap: float, seed: str, favour: Column | None):
    liking = favour if favour is not None else size_digits()
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), n_words().alias("size"))
    rows = rows.withColumn("favour", liking.cast("long")).checkpoint()
    sums = rows.groupBy("source", "favour").agg(F.sum("size").alias("words"))
    rates = copy_rates(sums, weights, cap).checkpoint()
    few = rates.count() <= BROADCAST_ROWS
    rates = F.broadcast(rates) if few else rates
    buckets = max(1 << 14, SPAN * rows.count() // ROWS_PER_BUCKET)
    cut = cutoffs(rows, rates, buckets, seed).withColumnRenamed("source", "_src").checkpoint()
    cut = F.broadcast(cut) if few else cut

    def decide(df: DataFrame) -> DataFrame:
        """Adds source_size, target and copies to rows with doc_id, source, text_key, size."""
        out = _ranked(df.withColumn("favour", liking.cast("long")), rates, buckets, seed)
        out = out.join(cut, F.col("source").eqNullSafe(F.col("_src")), "left")
        me = F.struct(F.col("_rank").alias("r"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"),
                      F.col("text_key").alias("k"))
        more = F.col("_rank").isNotNull() & (F.col("cut_bucket").isNull() | (F.col("_bucket") < F.col("cut_bucket")) | (
            (F.col("_bucket") == F.col("cut_bucket")) & F.col("cut_at").isNotNull() & (me <= F.col("cut_at"))))
        return out.withColumn("copies", (F.col("_whole") + F.when(more, 1).otherwise(0)).cast("long"))
    return rows, decide


def mixture(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, seed: str = "mix",
            favour: Column | None = None) -> DataFrame:
    """doc_id, source, text_key, size, source_size, target, copies, taken: a row for
    each row of ``docs``.  ``favour`` is a whole number from 1 over doc_id, source and size,
    of few values; a row's expected copies grow with it."""
    rows, decide = _plan(docs, weights, cap, seed, favour)
    return (decide(rows).withColumn("taken", F.col("copies") * F.col("size"))
            .select("doc_id", "source", "text_key", "size", "source_size", "target", "copies", "taken"))


def draw(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, seed: str = "mix",
         favour: Column | None = None) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    _, decide = _plan(docs, weights, cap, seed, favour)
    packed = docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), n_words().alias("size"),
                         F.struct(*docs.columns).alias("_row"))
    out = decide(packed).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.filter("copies > 0").select("_row.*")
