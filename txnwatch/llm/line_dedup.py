"""Line deduplication with per-document keep bitmaps (DataFrame functions only).

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z
lower-cased.  Keys of at least ``min_chars`` code points that occur in at least
``min_docs`` documents lose all their lines except in the largest doc_id.

128-bit key hashes are range-partitioned with document and sorted by document and
position, so a key that fills a third of all lines still spans many partitions;
each (key, document) run is reduced there to its positions.  Counts and the
keeping document are partial aggregates over those runs.  Decisions leave as a
sparse bitmap per document: 64 lines a word, only words that lose a line.  Texts
are shuffled once, to meet their bitmaps, and never through the key side.

Defined results: a null or empty text is one empty line.  Documents are counted by
distinct doc_id; null ids count together as one document that never keeps.  Rows
that repeat a doc_id get decisions from their own text.  Empty tables give empty
results; other columns pass through ``drop_repeated_lines`` unchanged.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.text import packed, unpacked

STRIP = " \t\n\x0b\x0c\r"


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(stripped: Column) -> Column:
    """A-Z lower-cased; lower() does the same, faster, where all is ASCII."""
    return F.when(F.length(stripped) == F.octet_length(stripped), F.lower(stripped)).otherwise(
        F.translate(stripped, string.ascii_uppercase, string.ascii_lowercase))


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text), keep (map of word number to 64 keep
    bits; a missing word keeps all its lines), n_dropped: documents that lose lines."""
    base = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                       F.posexplode(_lines("text")).alias("pos", "line"))
    keys = (base.select("doc_id", "text_key", "pos", F.btrim("line", F.lit(STRIP)).alias("line"))
            .filter(F.length("line") >= min_chars)
            .select("doc_id", "text_key", "pos", line_key(F.col("line")).alias("key"))
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2"),
                    "doc_id", "text_key", "pos"))
    keys = keys.checkpoint()  # the texts are split and hashed once, not again to sample the ranges
    runs = (keys.repartitionByRange("h1", "h2", "doc_id", "text_key")
            .sortWithinPartitions("h1", "h2", "doc_id", "text_key", "pos")
            .groupBy("h1", "h2", "doc_id", "text_key").agg(F.collect_list("pos").alias("at")))
    per_doc = runs.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    hot = (per_doc.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
           .filter(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper").checkpoint())
    # written first, so that the join below can be split where a key has many runs
    lost = (runs.join(hot, ["h1", "h2"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .select("doc_id", "text_key", F.explode("at").alias("pos")))
    words = (lost.groupBy("doc_id", "text_key", F.expr("pos div 64").cast("int").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, pos % 64))").alias("gone")))
    return words.groupBy("doc_id", "text_key").agg(
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"),
        F.sum(F.bit_count("gone")).cast("long").alias("n_dropped"))


def with_kept_text(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` (no names with an underscore in front) with _n_lines, _n_dropped and _kept_text."""
    marks = keep_bitmaps(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("keep").alias("_keep"),
        F.col("n_dropped").alias("_lost"))
    keyed = docs.withColumn("_text_key", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    out = keyed.join(marks, same, "left")
    out = out.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn("_lines", _lines("text"))
    kept = F.expr("array_join(filter(_lines, (x, i) -> "
                  "getbit(coalesce(try_element_at(_keep, cast(i div 64 as int)), -1L), i % 64) = 1), '\n')")
    return (out.withColumn("_n_lines", F.size("_lines").cast("long"))
            .withColumn("_n_dropped", F.coalesce("_lost", F.lit(0).cast("long")))
            .withColumn("_kept_text", F.when(F.col("_keep").isNull(), F.col("_text")).otherwise(kept)))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text`` (null stays null)."""
    out = with_kept_text(packed(docs, "doc_id", "text"), min_chars, min_docs)
    out = out.withColumn("text", F.when(F.col("text").isNotNull(), F.col("_kept_text")))
    return unpacked(out, docs.columns, ("doc_id", "text"))
