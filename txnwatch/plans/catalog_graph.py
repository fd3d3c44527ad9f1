"""Queries for the graph report (G1-G10) and the CSV report reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.operators import graph as g
from txnwatch.plans.fixtures import duckdb_with, txn
from txnwatch.plans.registry import r6, register
from txnwatch.schema import GRAPH_SCORE_COLUMNS
from txnwatch.sources import files

PR_ITER = 30  # steps written out in the check; ranks are those of the first step within the tolerance


def _pagerank_ctes(k: int = PR_ITER) -> str:
    parts = ["""
edges AS (SELECT from_account AS src, to_account AS dst, count(*) AS transaction_count,
                 sum(amount_paid) AS weight, CAST(sum(is_laundering) AS BIGINT) AS laundering_count
          FROM txn GROUP BY 1, 2),
nodes AS (SELECT src AS account FROM edges UNION SELECT dst FROM edges),
ow AS (SELECT src, sum(weight) AS ow FROM edges GROUP BY 1),
en AS (SELECT e.src, e.dst, e.weight / o.ow AS nw FROM edges e JOIN ow o ON e.src = o.src WHERE o.ow <> 0),
dn AS (SELECT account FROM nodes WHERE account NOT IN (SELECT src FROM ow WHERE ow <> 0)),
nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes),
r0 AS MATERIALIZED (SELECT account, 1.0 / (SELECT n FROM nn) AS pr FROM nodes)"""]
    for i in range(1, k + 1):
        parts.append(f"""
r{i} AS MATERIALIZED (
  SELECT nd.account,
         0.85 * (coalesce(c.s, 0.0) + (SELECT coalesce(sum(pr), 0.0) FROM r{i-1} WHERE account IN (SELECT account FROM dn))
                 / (SELECT n FROM nn)) + 0.15 / (SELECT n FROM nn) AS pr
  FROM nodes nd LEFT JOIN (SELECT en.dst, sum(p.pr * en.nw) AS s FROM en JOIN r{i-1} p ON en.src = p.account
                           GROUP BY en.dst) c ON nd.account = c.dst)""")
    changes = " UNION ALL ".join(
        f"SELECT {i} AS i, sum(abs(a.pr - b.pr)) AS d FROM r{i} a JOIN r{i - 1} b USING (account)" for i in range(1, k + 1))
    parts.append(f"\nstop AS MATERIALIZED (SELECT min(i) AS i FROM ({changes}) "
                 "WHERE d < (SELECT n FROM nn) * 1e-6)")
    ranks = " UNION ALL ".join(f"SELECT account, pr FROM r{i} WHERE (SELECT i FROM stop) = {i}" for i in range(1, k + 1))
    parts.append(f"\npr AS (SELECT account, pr AS pagerank FROM ({ranks}))")
    return ",".join(parts)


MEASURES_SQL = """,
o AS (SELECT src AS account, count(*) AS out_degree, sum(weight) AS out_amount,
             sum(transaction_count) AS out_transaction_count, sum(laundering_count) AS out_lab,
             count(*) FILTER (WHERE EXISTS (SELECT 1 FROM edges e2 WHERE e2.src = edges.dst AND e2.dst = edges.src)) AS recip
      FROM edges GROUP BY 1),
i AS (SELECT dst AS account, count(*) AS in_degree, sum(weight) AS in_amount,
             sum(transaction_count) AS in_transaction_count, sum(laundering_count) AS in_lab
      FROM edges GROUP BY 1),
m AS (SELECT nodes.account,
        CAST(coalesce(in_degree, 0) AS BIGINT) AS in_degree, CAST(coalesce(out_degree, 0) AS BIGINT) AS out_degree,
        coalesce(in_amount, 0.0) AS in_amount, coalesce(out_amount, 0.0) AS out_amount,
        CAST(coalesce(in_transaction_count, 0) AS BIGINT) AS in_transaction_count,
        CAST(coalesce(out_transaction_count, 0) AS BIGINT) AS out_transaction_count,
        CAST(coalesce(recip, 0) AS BIGINT) AS reciprocal_counterparties,
        CAST(coalesce(in_lab, 0) + coalesce(out_lab, 0) AS BIGINT) AS known_laundering_edges
      FROM nodes LEFT JOIN o ON nodes.account = o.account LEFT JOIN i ON nodes.account = i.account)
"""


def _zsql() -> str:
    vals = {c: (f"ln(1 + {c})" if "amount" in c else f"CAST({c} AS DOUBLE)") for c in GRAPH_SCORE_COLUMNS}
    stats = ", ".join([f"avg({v}) AS m_{c}, stddev_pop({v}) AS s_{c}" for c, v in vals.items()])
    zs = ", ".join([f"CASE WHEN s_{c} <> 0 THEN ({v} - m_{c}) / s_{c} ELSE 0.0 END AS z_{c}" for c, v in vals.items()])
    mean = " + ".join(f"z_{c}" for c in GRAPH_SCORE_COLUMNS)
    return f""",
rep0 AS (SELECT m.*, coalesce(pr.pagerank, 0.0) AS pagerank FROM m LEFT JOIN pr ON m.account = pr.account),
st AS (SELECT {stats} FROM rep0),
rep1 AS (SELECT rep0.*, {zs} FROM rep0, st),
rep AS (SELECT *, ({mean}) / {float(len(GRAPH_SCORE_COLUMNS))} AS network_risk_score FROM rep1)
"""


GRAPH_BASE = duckdb_with("txn") + "," + _pagerank_ctes() + MEASURES_SQL
REPORT_BASE = GRAPH_BASE + _zsql()
ROUND_COLS = ["in_amount", "out_amount", "pagerank", *[f"z_{c}" for c in GRAPH_SCORE_COLUMNS], "network_risk_score"]


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.graph_edges(txn(spark, sf_dir))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.graph_risk_report(txn(spark, sf_dir))


def _r(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c) if c in ROUND_COLS else F.col(c) for c in df.columns])


def _sel(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in ROUND_COLS else c for c in cols)


@register("graph_edges", GRAPH_BASE + "SELECT src, dst, transaction_count, round(weight, 6) AS weight, laundering_count FROM edges")
def q_edges(spark, sf_dir):
    e = edges(spark, sf_dir)
    return e.select("src", "dst", "transaction_count", r6("weight"), "laundering_count")


@register("graph_nodes", GRAPH_BASE + "SELECT account FROM nodes")
def q_nodes(spark, sf_dir):
    return g.graph_nodes(edges(spark, sf_dir))


def _measure_query(name: str, cols: list[str]):
    @register(name, GRAPH_BASE + f"SELECT account, {_sel(cols)} FROM m")
    def q(spark, sf_dir):
        return _r(g.node_measures(edges(spark, sf_dir)).select("account", *cols))
    return q


_measure_query("graph_degree", ["in_degree", "out_degree"])
_measure_query("graph_flow", ["in_amount", "out_amount", "in_transaction_count", "out_transaction_count"])
_measure_query("graph_reciprocity", ["reciprocal_counterparties"])
_measure_query("graph_label_exposure", ["known_laundering_edges"])


@register("graph_pagerank", GRAPH_BASE + "SELECT account, round(pagerank, 6) AS pagerank FROM pr")
def q_pagerank(spark, sf_dir):
    pr = g.pagerank(edges(spark, sf_dir))
    return pr.select("account", r6("pagerank"))


ZCOLS = [f"z_{c}" for c in GRAPH_SCORE_COLUMNS]


@register("graph_zscores", REPORT_BASE + f"SELECT account, {_sel(ZCOLS)} FROM rep")
def q_zscores(spark, sf_dir):
    return _r(report(spark, sf_dir).select("account", *ZCOLS))


@register("graph_risk_report", REPORT_BASE + f"SELECT {_sel(g.REPORT_COLUMNS)} FROM rep")
def q_report(spark, sf_dir):
    return _r(report(spark, sf_dir))


@register("graph_top20", REPORT_BASE + "SELECT account, round(pagerank, 6) AS pagerank FROM rep "
          "ORDER BY pagerank DESC, account LIMIT 20")
def q_top20(spark, sf_dir):
    return _r(g.graph_top(report(spark, sf_dir), 20).select("account", "pagerank"))


@register("scan_report_csv", REPORT_BASE + f"SELECT {_sel(g.REPORT_COLUMNS)} FROM rep")
def q_scan_report_csv(spark, sf_dir):
    """Write the graph report as CSV and read all of it back."""
    path = files.scratch_path(spark, "graph-report-csv")
    rep = report(spark, sf_dir)
    files.sink_csv(rep, path)
    missing = files.scan_report_csv(spark, path + "-absent")
    assert missing.count() == 0
    back = files.scan_report_csv(spark, path, schema=rep.schema)
    return _r(back)
