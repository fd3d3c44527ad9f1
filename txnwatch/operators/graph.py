"""Account graph report (G1-G10) as DataFrame aggregations and joins.

Edges are (src, dst) pair aggregates; node measures are group-bys over the
edge table; PageRank is a power iteration of one join + one aggregation per
step with lineage cut by reliable checkpoints in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.schema import GRAPH_SCORE_COLUMNS
from txnwatch.session import ensure_checkpoint_dir


class PowerIterationFailedConvergence(RuntimeError):
    pass


def graph_edges(txn: DataFrame) -> DataFrame:
    """G1: per ordered pair: transaction count, amount (edge weight), labelled count."""
    return txn.groupBy(F.col("from_account").alias("src"), F.col("to_account").alias("dst")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount_paid").alias("weight"),
        F.sum("is_laundering").cast("long").alias("laundering_count"),
    )


def graph_nodes(edges: DataFrame) -> DataFrame:
    """Every endpoint once."""
    return edges.select(F.col("src").alias("account")).union(edges.select(F.col("dst").alias("account"))).distinct()


def node_measures(edges: DataFrame) -> DataFrame:
    """G3-G6 per node: degrees, flows, reciprocity and labelled-edge exposure.

    A self-loop counts once in each degree, is its own reciprocal edge and
    adds its labelled count twice (once as in-edge, once as out-edge).
    """
    rev = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    recip = edges.join(rev, ["src", "dst"], "left_semi").groupBy("src").agg(
        F.count(F.lit(1)).alias("reciprocal_counterparties"))
    out = edges.groupBy("src").agg(
        F.count(F.lit(1)).alias("out_degree"),
        F.sum("weight").alias("out_amount"),
        F.sum("transaction_count").alias("out_transaction_count"),
        F.sum("laundering_count").alias("_out_lab"),
    ).join(recip, "src", "left").withColumnRenamed("src", "account")
    inn = edges.groupBy(F.col("dst").alias("account")).agg(
        F.count(F.lit(1)).alias("in_degree"),
        F.sum("weight").alias("in_amount"),
        F.sum("transaction_count").alias("in_transaction_count"),
        F.sum("laundering_count").alias("_in_lab"),
    )
    j = out.join(inn, "account", "full_outer")
    z = F.lit(0)
    return j.select(
        "account",
        F.coalesce("in_degree", z).cast("long").alias("in_degree"),
        F.coalesce("out_degree", z).cast("long").alias("out_degree"),
        F.coalesce("in_amount", F.lit(0.0)).alias("in_amount"),
        F.coalesce("out_amount", F.lit(0.0)).alias("out_amount"),
        F.coalesce("in_transaction_count", z).cast("long").alias("in_transaction_count"),
        F.coalesce("out_transaction_count", z).cast("long").alias("out_transaction_count"),
        F.coalesce("reciprocal_counterparties", z).cast("long").alias("reciprocal_counterparties"),
        (F.coalesce("_in_lab", z) + F.coalesce("_out_lab", z)).cast("long").alias("known_laundering_edges"),
    )


def pagerank(edges: DataFrame, alpha: float = 0.85, max_iter: int = 100, tol: float = 1.0e-6,
             fail_if_not_converged: bool = True, checkpoint_every: int = 5,
             edges_per_salt: int = 1_000_000) -> DataFrame:
    """Weighted PageRank over (src, dst, weight).

    Uniform start and restart, dangling mass (out-weight 0) spread uniformly,
    stop when the L1 change is below ``N * tol``.  Returns (account, pagerank).

    One step is a join of the normalised edges (partitioned by ``src`` once)
    with the ranks and an aggregation by ``dst``.  A source with more than
    ``edges_per_salt`` edges is dealt over several salts by ``dst`` and its rank is
    repeated for each, so a hub's edges are spread over tasks.  Ranks are persisted between
    steps, and every ``checkpoint_every`` steps written as a reliable
    checkpoint (shared checkpoint folder) to cut lineage.  One small action
    per step returns both the L1 change and the next dangling mass.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    nodes = graph_nodes(edges).checkpoint()
    n = nodes.count()
    if n == 0:
        return nodes.withColumn("pagerank", F.lit(0.0))
    out_w = edges.groupBy("src").agg(
        F.sum("weight").alias("_ow"),
        F.ceil(F.count(F.lit(1)) / F.lit(edges_per_salt)).cast("int").alias("_salts")).checkpoint()
    # one partition count for edges and ranks, about 2M edges each
    parts = max(1, -(-edges.count() // 2_000_000))
    norm = (edges.join(out_w, "src").where(F.col("_ow") != 0)
            .select("src", F.pmod(F.xxhash64("dst"), F.col("_salts")).cast("int").alias("_salt"), "dst",
                    (F.col("weight") / F.col("_ow")).alias("_nw"))
            .repartition(parts, "src", "_salt").checkpoint())
    dangling = nodes.join(out_w.where(F.col("_ow") != 0).select(F.col("src").alias("account")),
                          "account", "left_anti").select("account", F.lit(True).alias("_dangling"))
    base = nodes.join(dangling, "account", "left").join(
        out_w.select(F.col("src").alias("account"), "_salts"), "account", "left").select(
        "account", F.coalesce("_dangling", F.lit(False)).alias("_dangling"), F.coalesce("_salts", F.lit(1)).alias("_salts")) \
        .repartition(parts, "account").checkpoint()
    a, inv_n = float(alpha), 1.0 / n
    ranks = base.select("account", "_dangling", "_salts", F.lit(inv_n).alias("pr"))
    dangle = base.where("_dangling").count() * inv_n
    held = None
    for it in range(1, max_iter + 1):
        sent = ranks.select(F.col("account").alias("src"), "pr",
                            F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"))
        contrib = (norm.join(sent, ["src", "_salt"])
                   .groupBy(F.col("dst").alias("account")).agg(F.sum(F.col("pr") * F.col("_nw")).alias("_c")))
        new = (ranks.join(contrib, "account", "left")
               .select("account", "_dangling", "_salts",
                       (F.lit(a) * (F.coalesce("_c", F.lit(0.0)) + F.lit(dangle * inv_n)) + F.lit((1 - a) * inv_n)).alias("pr"),
                       F.col("pr").alias("_old")))
        new = new.checkpoint() if it % max(1, checkpoint_every) == 0 else new.persist()
        st = new.agg(F.sum(F.abs(F.col("pr") - F.col("_old"))).alias("err"),
                     F.coalesce(F.sum(F.when(F.col("_dangling"), F.col("pr"))), F.lit(0.0)).alias("dm")).first()
        if held is not None:
            held.unpersist()
        held = new
        ranks = new.drop("_old")
        dangle = float(st["dm"])
        if tol > 0 and float(st["err"]) < n * tol:
            return ranks.select("account", F.col("pr").alias("pagerank"))
    if fail_if_not_converged:
        raise PowerIterationFailedConvergence(f"pagerank did not converge in {max_iter} iterations")
    return ranks.select("account", F.col("pr").alias("pagerank"))


def zscores(report: DataFrame, columns: list[str] = GRAPH_SCORE_COLUMNS) -> DataFrame:
    """Z-score per column (log1p on amount columns), population std,
    std 0 -> 0.0.  One action gives all means and deviations; the report should be
    written before (``graph_risk_report`` checkpoints it)."""
    vals = {c: (F.log1p(F.col(c).cast("double")) if "amount" in c else F.col(c).cast("double")) for c in columns}
    stats = report.select(*[F.avg(v).alias(f"m_{c}") for c, v in vals.items()],
                          *[F.stddev_pop(v).alias(f"s_{c}") for c, v in vals.items()]).first()
    return report.select("*", *[
        ((v - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"]) if stats[f"s_{c}"] else F.lit(0.0)).alias(f"z_{c}")
        for c, v in vals.items()])


REPORT_COLUMNS = [
    "account", "in_degree", "out_degree", "in_amount", "out_amount", "in_transaction_count",
    "out_transaction_count", "pagerank", "reciprocal_counterparties", "known_laundering_edges",
    *[f"z_{c}" for c in GRAPH_SCORE_COLUMNS], "network_risk_score",
]


def graph_risk_report(txn: DataFrame, **pagerank_args) -> DataFrame:
    """17-column report sorted by network risk (mean of the six z-scores)."""
    edges = graph_edges(txn).checkpoint()
    pr = pagerank(edges, **pagerank_args)
    rep = node_measures(edges).join(pr, "account", "left").withColumn(
        "pagerank", F.coalesce("pagerank", F.lit(0.0)))
    rep = zscores(rep.checkpoint())
    zs = [F.col(f"z_{c}") for c in GRAPH_SCORE_COLUMNS]
    total = zs[0]
    for z in zs[1:]:
        total = total + z
    rep = rep.withColumn("network_risk_score", total / F.lit(float(len(zs))))
    return rep.select(*REPORT_COLUMNS).orderBy(F.col("network_risk_score").desc(), "account")


def score_column(columns: list[str]) -> str:
    """The first column whose name contains 'risk' or 'pagerank' (console rule)."""
    for c in columns:
        if "risk" in c or "pagerank" in c:
            return c
    raise ValueError("no score column")


def graph_top(report: DataFrame, k: int = 20, column: str | None = None) -> DataFrame:
    """Top-k accounts by the console's score column (``pagerank``)."""
    col = column or score_column(report.columns)
    return report.orderBy(F.col(col).desc(), "account").limit(k)
