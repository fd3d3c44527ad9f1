"""Global order without a single-partition window.

``prefix_sums`` range-partitions on a unique order key (so ties and hot
values are split across tasks), runs a per-partition cumulative sum inside
the task (pandas over Arrow batches), and adds the totals of all earlier
partitions from a table with one row per partition (broadcast, bounded by the
partition count).  The partitioned, summed frame is checkpointed to the shared
checkpoint folder, which fixes its layout against recomputation.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch.session import ensure_checkpoint_dir


def prefix_sums(df: DataFrame, order_cols: list[str], sum_cols: list[str], descending: bool = False,
                num_partitions: int | None = None, suffix: str = "_before") -> DataFrame:
    """For each ``c`` in ``sum_cols`` add ``c + suffix``: the sum of ``c`` over
    all rows strictly earlier in the order.  ``order_cols`` must be unique."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if num_partitions:
        n = num_partitions
    else:
        n = max(1, -(-df.count() // 2_000_000))  # about 2M rows per range partition
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    s = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    loc_fields = [T.StructField(f"_loc_{c}", df.schema[c].dataType) for c in sum_cols]
    schema = T.StructType(list(df.schema.fields) + [T.StructField("_pid", T.IntegerType())] + loc_fields)

    def run(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        carry = {c: 0 for c in sum_cols}
        for pdf in batches:
            for c in sum_cols:
                col = pdf[c]
                pdf[f"_loc_{c}"] = col.cumsum() - col + carry[c]
                carry[c] = carry[c] + col.sum()
            pdf["_pid"] = pid
            yield pdf

    loc = s.mapInPandas(run, schema).checkpoint()
    totals = loc.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    # one row per partition: a bounded table, ordered in a single task
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(w), F.lit(0)).alias(f"_o_{c}")
                                   for c in sum_cols])
    out = loc.join(F.broadcast(offs), "_pid")
    return out.select(*df.columns, *[(F.col(f"_loc_{c}") + F.col(f"_o_{c}")).cast(df.schema[c].dataType)
                                     .alias(c + suffix) for c in sum_cols])


def with_ordinal(df: DataFrame, order_cols: list[str], name: str = "ordinal") -> DataFrame:
    """0-based position of each row in ``order_cols`` order (unique key)."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    return prefix_sums(ones, order_cols, ["_one"]).withColumnRenamed("_one_before", name).drop("_one")


def bucket_index(col: str, splits: list[float], out: str) -> Bucketizer:
    return Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol=col, outputCol=out)


#: Values of the cells that hold wanted ranks are counted one by one from here down.
MOST_VALUES = 2_000_000
_SKETCH = 2048
_FIRST_CUTS, _CUTS = 1024, 64


@dataclass(frozen=True)
class _Cell:
    """Values lo <= v < hi of a column: how many are below, and how many it has."""

    column: int
    lo: float
    hi: float
    below: int
    n: int

    @property
    def single(self) -> bool:
        return self.hi <= math.nextafter(self.lo, math.inf)

    def holds(self, ranks: list[int]) -> bool:
        i = bisect.bisect_left(ranks, self.below)
        return i < len(ranks) and ranks[i] < self.below + self.n


def grouped_quantiles(df: DataFrame, cols: list[str], count: int, most: int = MOST_VALUES) -> dict[str, list[float]]:
    """``count`` evenly spaced linear quantiles (exact ranks) of every column.

    A rank lies in a cell of values.  While the cells that hold wanted ranks have more than
    ``most`` values, mergeable quantile sketches of them (a partial aggregate) give cuts, an
    exact count of the values between the cuts tells in which part each rank lies, and the
    others are dropped: a cell gets some hundred times smaller with two reads, and a value
    that fills a cell is a cell of its own.  What is left is counted by value and read in
    order.  Nulls and NaN are ignored; a column without values has none.
    """
    numeric = [F.col(c).cast("double") for c in cols]
    x = df.select(*[F.when(~F.isnan(v), v).alias(f"_x{i}") for i, v in enumerate(numeric)])
    n_of = list(x.agg(*[F.count(f"_x{i}") for i in range(len(cols))]).first())
    steps = count - 1
    wanted = {i: [((n - 1) * k // steps, (n - 1) * k % steps) for k in range(count)] for i, n in enumerate(n_of) if n}
    ranks = {i: sorted({j for j, _ in pos} | {j + 1 for j, r in pos if r}) for i, pos in wanted.items()}
    got = _values_of_ranks(x, ranks, [_Cell(i, -math.inf, math.inf, 0, n_of[i]) for i in ranks], most)
    out: dict[str, list[float]] = {c: [] for c in cols}
    for i, pos in wanted.items():
        v = got[i]
        out[cols[i]] = [v[j] if r == 0 else lerp(v[j], v[j + 1], r / steps) for j, r in pos]
    return out


def _values_of_ranks(x: DataFrame, ranks: dict[int, list[int]], cells: list[_Cell], most: int) -> dict[int, dict[int, float]]:
    cuts = _FIRST_CUTS
    while sum(c.n for c in cells if not c.single) > most:
        cells = [c for c in _narrowed(x, cells, cuts) if c.holds(ranks[c.column])]
        cuts = _CUTS
    got: dict[int, dict[int, float]] = {i: {} for i in ranks}

    def take(column: int, value: float, first: int, n: int) -> None:
        own = ranks[column]
        for r in own[bisect.bisect_left(own, first):bisect.bisect_left(own, first + n)]:
            got[column][r] = value

    for c in cells:
        if c.single:
            take(c.column, c.lo, c.below, c.n)
    many = [c for c in cells if not c.single]
    if many:
        rows = _in_cells(x, many).groupBy("cell", "v").agg(F.count(F.lit(1)).alias("n")).toArrow()  # at most ``most`` rows
        cell, v, n = (rows[k].to_numpy() for k in ("cell", "v", "n"))
        order = np.lexsort((v, cell))
        at = {k: c.below for k, c in enumerate(many)}
        for k, value, times in zip(cell[order].tolist(), v[order].tolist(), n[order].tolist()):
            take(many[k].column, value, at[k], times)
            at[k] += times
    return got


def _in_cells(x: DataFrame, cells: list[_Cell]) -> DataFrame:
    """(cell, v) of the values inside the cells."""
    splits, numbers = {}, {}
    for i in sorted({c.column for c in cells}):
        own = [c for c in cells if c.column == i]
        inner = sorted({e for c in own for e in (c.lo, c.hi)} - {-math.inf, math.inf})
        splits[i] = [-math.inf, *inner, math.inf]
        starts = {c.lo: k for k, c in enumerate(cells) if c.column == i}
        numbers[i] = F.array(*[F.lit(starts.get(e, -1)) for e in splits[i][:-1]])
    y = x.select(*[f"_x{i}" for i in splits])
    cut = [i for i in splits if len(splits[i]) > 2]
    if cut:
        y = Bucketizer(splitsArray=[splits[i] for i in cut], inputCols=[f"_x{i}" for i in cut],
                       outputCols=[f"_p{i}" for i in cut], handleInvalid="keep").transform(y)
    place = {i: F.try_element_at(numbers[i], F.col(f"_p{i}").cast("int") + 1) if i in cut else numbers[i][0] for i in splits}
    parts = [F.when(F.col(f"_x{i}").isNotNull(), F.struct(place[i].alias("cell"), F.col(f"_x{i}").alias("v"))) for i in splits]
    return y.select(F.explode(F.array(*parts)).alias("e")).select("e.cell", "e.v").where("cell >= 0")


def _narrowed(x: DataFrame, cells: list[_Cell], cuts: int) -> list[_Cell]:
    """The cells cut at quantiles of their own values, with exact counts."""
    steps = F.array(*[F.lit(i / cuts) for i in range(cuts + 1)])
    many = [c for c in cells if not c.single]
    sketched = _in_cells(x, many).groupBy("cell").agg(F.kll_sketch_agg_double("v", F.lit(_SKETCH)).alias("s"))
    found = sketched.select("cell", F.kll_sketch_get_quantile_double("s", steps).alias("q")).collect()
    out = [c for c in cells if c.single]
    parts: list[_Cell] = []
    for r in found:
        c = many[r["cell"]]
        inner = sorted({e for q in r["q"] for e in (q, math.nextafter(q, math.inf)) if c.lo < e < c.hi})
        edges = [c.lo, *inner, c.hi]
        parts += [_Cell(c.column, a, b, r["cell"], 0) for a, b in zip(edges, edges[1:])]
    held = {r["cell"]: r["n"] for r in _in_cells(x, parts).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    below = {k: c.below for k, c in enumerate(many)}
    for k, p in enumerate(parts):  # parts of a cell are in ascending order
        n = held.get(k, 0)
        out.append(_Cell(p.column, p.lo, p.hi, below[p.below], n))
        below[p.below] += n
    return out


def values_at_ranks(values: DataFrame, value_col: str, ranks: list[int], most: int = MOST_VALUES) -> dict[int, float]:
    """Exact order statistics: the value at each 0-based rank."""
    x = values.select(F.col(value_col).cast("double").alias("_x0")).where("_x0 is not null and not isnan(_x0)")
    return _values_of_ranks(x, {0: sorted(set(ranks))}, [_Cell(0, -math.inf, math.inf, 0, x.count())], most)[0]


def grouped_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact median of each column (mean of the two middle values); None without values."""
    return {c: q[1] if q else None for c, q in grouped_quantiles(df, cols, 3).items()}


def lerp(a: float, b: float, t: float) -> float:
    """Linear interpolation with the numerically symmetric form (t >= 0.5 from b)."""
    d = b - a
    return b - d * (1.0 - t) if t >= 0.5 else a + d * t
