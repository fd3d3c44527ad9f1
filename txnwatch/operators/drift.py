"""Data drift between a reference and a current window.

A feature's shares in both windows come from one aggregation: every row of either window
gives one (feature, bin) for each feature, a numeric feature's bin by its reference quantile
edges, a categorical one's by its value.  All features share that pass.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.config import DEFAULT, Params
from txnwatch.operators.ordinal import grouped_quantiles
from txnwatch.schema import DRIFT_CATEGORICAL, DRIFT_NUMERIC

SHARE_FLOOR = 1e-6


def _edges(reference: DataFrame, cols: list[str], bins: int) -> dict[str, list[float]]:
    """Inner reference quantile edges of the columns that have three distinct ones or more."""
    found = {c: sorted(set(q)) for c, q in grouped_quantiles(reference, cols, bins + 1).items()}
    return {c: e[1:-1] for c, e in found.items() if len(e) >= 3}


def _binned(df: DataFrame, edges: dict[str, list[float]], categories: list[str], current: bool) -> DataFrame:
    """(feature, bin, current) for each feature of each row; missing numbers have no bin, a
    missing category is one of its own."""
    out = df.select(*[F.col(c).cast("string").try_cast("double").alias(f"_x{i}") for i, c in enumerate(edges)],
                    *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")).alias(f"_k{i}") for i, c in enumerate(categories)])
    if edges:
        out = Bucketizer(splitsArray=[[-math.inf, *e, math.inf] for e in edges.values()],
                         inputCols=[f"_x{i}" for i in range(len(edges))],
                         outputCols=[f"_b{i}" for i in range(len(edges))], handleInvalid="keep").transform(out)

    def entry(feature: str, value: Column) -> Column:
        return F.struct(F.lit(feature).alias("feature"), value.alias("bin"))

    parts = [F.when(F.col(f"_x{i}").isNotNull() & ~F.isnan(f"_x{i}"), entry(c, F.col(f"_b{i}").cast("int").cast("string")))
             for i, c in enumerate(edges)]
    parts += [entry(c, F.col(f"_k{i}")) for i, c in enumerate(categories)]
    return (out.select(F.explode(F.array(*parts)).alias("e")).where("e is not null")
            .select("e.feature", "e.bin", F.lit(int(current)).alias("current")))


def _shares(reference: DataFrame, current: DataFrame, edges: dict[str, list[float]], categories: list[str]) -> DataFrame:
    """feature, bin, r, c (shares of the windows; null where a window has no rows)."""
    both = _binned(reference, edges, categories, False).union(_binned(current, edges, categories, True))
    n = both.groupBy("feature", "bin").agg(F.count_if(F.col("current") == 0).alias("_r"), F.sum("current").alias("_c"))
    every = Window.partitionBy("feature")  # a row for each bin of a feature
    return n.select("feature", "bin", F.try_divide("_r", F.sum("_r").over(every)).alias("r"),
                    F.try_divide("_c", F.sum("_c").over(every)).alias("c"))


def _psi(shares: DataFrame) -> DataFrame:
    r = F.greatest(F.coalesce("r", F.lit(0.0)), F.lit(SHARE_FLOOR))
    c = F.greatest(F.coalesce("c", F.lit(0.0)), F.lit(SHARE_FLOOR))
    # an empty current window gives 0
    value = F.when(F.count("c") > 0, F.sum((c - r) * F.log(c / r))).otherwise(F.lit(0.0))
    return shares.groupBy("feature").agg(value.alias("value"))


def _distance(shares: DataFrame) -> DataFrame:
    d = F.abs(F.coalesce("r", F.lit(0.0)) - F.coalesce("c", F.lit(0.0)))
    return shares.groupBy("feature").agg((0.5 * F.sum(d)).alias("value"))


def _for_each(spark, names: list[str], found: DataFrame, value: str) -> DataFrame:
    named = spark.createDataFrame([(c,) for c in names], "feature string")
    return named.join(found, "feature", "left").select("feature", F.coalesce("value", F.lit(0.0)).alias(value))


def psi_many(reference: DataFrame, current: DataFrame, cols: list[str], bins: int = 10) -> DataFrame:
    """D1 for several columns at once: (feature, psi).

    Outer edges are infinite, bins [a, b); shares floored at 1e-6; an empty side or
    fewer than three unique edges gives 0.0.
    """
    edges = _edges(reference, cols, bins)
    spark = reference.sparkSession
    if not edges:
        return spark.createDataFrame([(c, 0.0) for c in cols], "feature string, psi double")
    return _for_each(spark, cols, _psi(_shares(reference, current, edges, [])), "psi")


def psi(reference: DataFrame, current: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Population stability index of one column (one row: psi)."""
    return psi_many(reference, current, [col], bins).select("psi")


def category_distances(reference: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    """D2 for several columns at once: (feature, distance)."""
    return _for_each(reference.sparkSession, cols, _distance(_shares(reference, current, {}, cols)), "distance")


def category_distance(reference: DataFrame, current: DataFrame, col: str) -> DataFrame:
    """Total variation (half L1) between category shares (one row: distance)."""
    return category_distances(reference, current, [col]).select("distance")


def drift_values(reference: DataFrame, current: DataFrame, numeric: list[str] = DRIFT_NUMERIC,
                 categorical: list[str] = DRIFT_CATEGORICAL) -> DataFrame:
    """Long table (kind, feature, value): PSI per numeric feature, total
    variation per categorical feature.  Both windows are projected to the
    drift columns and checkpointed once, since edges and shares read them."""
    cols = [*numeric, *categorical]
    reference = reference.select(*cols).checkpoint()
    current = current.select(*cols).checkpoint()
    spark = reference.sparkSession
    shares = _shares(reference, current, _edges(reference, numeric, 10), categorical)
    is_category = F.col("feature").isin(categorical)
    return (_for_each(spark, numeric, _psi(shares.where(~is_category)), "value").select(F.lit("psi").alias("kind"), "feature", "value")
            .union(_for_each(spark, categorical, _distance(shares.where(is_category)), "value")
                   .select(F.lit("total_variation"), "feature", "value")))


def drift_report(reference: DataFrame, current: DataFrame, params: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """D3: (long table, one-row summary with status, max drift and row counts)."""
    values = drift_values(reference, current).checkpoint()
    mx = F.coalesce(F.max("value"), F.lit(0.0))
    summary = values.agg(mx.alias("max_drift")).select(
        F.when(F.col("max_drift") >= params.psi_critical, F.lit("critical"))
        .when(F.col("max_drift") >= params.psi_warning, F.lit("warning"))
        .otherwise(F.lit("healthy")).alias("status"),
        "max_drift",
        reference.select(F.count(F.lit(1))).scalar().alias("reference_rows"),
        current.select(F.count(F.lit(1))).scalar().alias("current_rows"),
    )
    return values, summary
