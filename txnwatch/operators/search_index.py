"""Substring search over alert ids through an inverted index of q-grams.

The index holds, for each three-letter piece of the four id columns (lower case), the ids of
the alerts that have it, sorted by piece within files dealt by the piece's hash.  A search
takes the rarest pieces of its text, reads their files only, keeps the ids that have all of
them, and verifies those alerts against the text.  Pieces are never gathered into lists, so
one that stands in every alert is just many rows, and a search whose text has a rarer piece
does not read it.  Texts shorter than a piece scan the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.operators.alerts import alert_search
from txnwatch.schema import SEARCH_COLUMNS

Q = 3
SLOTS = 16
ROWS_PER_FILE = 5_000_000
#: Pieces of a text that are looked up, the rarest first.
PIECES = 4


def _pieces(text: Column) -> Column:
    s = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    starts = F.when(F.length(s) >= Q, F.sequence(F.lit(1), F.length(s) - (Q - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(s, i, F.lit(Q)))


def build(flat: DataFrame, path: str, key: str = "id") -> None:
    """Write the index of a table of alerts with a unique, non-null ``key``."""
    spark = flat.sparkSession
    every = F.array_distinct(F.concat(*[_pieces(F.col(c)) for c in SEARCH_COLUMNS]))
    rows = flat.select(F.col(key).alias("key"), F.explode(every).alias("piece")).checkpoint()  # counted, then written
    counts = rows.groupBy("piece").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    total = counts.agg(F.sum("n")).first()[0] or 0
    files = max(1, -(-total // ROWS_PER_FILE))
    slot = F.pmod(F.xxhash64("piece"), F.lit(SLOTS * files)).cast("int")
    # a common piece is spread over several files of its slot
    dealt = rows.withColumn("slot", slot).repartition(SLOTS * files, "slot", F.pmod(F.xxhash64("key"), F.lit(2)))
    dealt.sortWithinPartitions("slot", "piece", "key").write.mode("overwrite").partitionBy("slot").parquet(f"{path}/postings")
    (counts.withColumn("slot", slot).repartition(files, "slot").sortWithinPartitions("piece")
     .write.mode("overwrite").parquet(f"{path}/pieces"))
    spark.createDataFrame([(SLOTS * files, key)], "slots int, key string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def postings(spark: SparkSession, path: str, search: str) -> DataFrame | None:
    """Keys of the alerts that have the text's rarest pieces; None for a text without pieces."""
    text = search.lower()
    pieces = sorted({text[i:i + Q] for i in range(len(text) - Q + 1)})
    if not pieces:
        return None
    found = spark.read.parquet(f"{path}/pieces").where(F.col("piece").isin(pieces)).collect()  # a row for each piece of the text
    all_rows = spark.read.schema("key bigint, piece string, slot int").option("basePath", f"{path}/postings")
    if len(found) < len(pieces):  # a piece that no alert has
        return all_rows.parquet(f"{path}/postings").where(F.lit(False)).select("key")
    rare = sorted(found, key=lambda r: (r["n"], r["piece"]))[:PIECES]
    folders = sorted({f"{path}/postings/slot={r['slot']}" for r in rare})
    rows = all_rows.parquet(*folders).where(F.col("piece").isin([r["piece"] for r in rare]))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(rare)).select("key")


def search(flat: DataFrame, path: str, text: str, key: str = "id") -> DataFrame:
    """The alerts of ``flat`` that contain ``text`` in one of the id columns, as ``alert_search``
    finds them.  ``flat`` is the table that the index was built of."""
    keys = postings(flat.sparkSession, path, text)
    if keys is None:
        return alert_search(flat, text)
    near = flat.join(keys.withColumnRenamed("key", "_key"), F.col(key) == F.col("_key"), "left_semi")
    return alert_search(near, text)
