"""Queries for drift (D1-D3): reference = transactions before the cut,
current = the rest; features are built for each window separately."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch import jobs
from txnwatch.config import DEFAULT
from txnwatch.operators import drift as dr
from txnwatch.operators.history import causal_features
from txnwatch.plans.catalog_features import FEAT_SQL
from txnwatch.plans.fixtures import duckdb_with, txn
from txnwatch.plans.registry import ORACLE, r6, register
from txnwatch.sources import files
from txnwatch.schema import DRIFT_CATEGORICAL, DRIFT_NUMERIC

CUT = "2024-01-16 00:00:00"


def windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = txn(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp")
    ref = causal_features(t.where(F.col("timestamp") < cut), DEFAULT.history_rows_per_chunk)
    cur = causal_features(t.where(F.col("timestamp") >= cut), DEFAULT.history_rows_per_chunk)
    return ref, cur


def _feat(src: str, tag: str) -> str:
    sql = FEAT_SQL.replace("FROM txn)", f"FROM {src})")
    for cte in ("f0", "f1", "f2", "feat"):
        sql = sql.replace(f"{cte} AS (", f"{cte}_{tag} AS (").replace(f"FROM {cte})", f"FROM {cte}_{tag})")
    return sql


def _psi_sql(col: str) -> str:
    return f"""
SELECT '{col}' AS feature, (
  WITH rv AS (SELECT CAST({col} AS DOUBLE) AS v FROM feat_r WHERE {col} IS NOT NULL AND NOT isnan(CAST({col} AS DOUBLE))),
  cv AS (SELECT CAST({col} AS DOUBLE) AS v FROM feat_c WHERE {col} IS NOT NULL AND NOT isnan(CAST({col} AS DOUBLE))),
  rs AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM rv),
  rn AS (SELECT count(*) AS n FROM rv),
  qi AS (SELECT ((n - 1) * i) // 10 AS j, ((n - 1) * i) % 10 AS rem FROM range(0, 11) r(i), rn),
  ed AS (SELECT DISTINCT CASE WHEN rem = 0 THEN a.v
                 WHEN CAST(rem AS DOUBLE) / CAST(10 AS DOUBLE) >= 0.5
                   THEN b.v - (b.v - a.v) * (CAST(1 AS DOUBLE) - CAST(rem AS DOUBLE) / CAST(10 AS DOUBLE))
                 ELSE a.v + (b.v - a.v) * (CAST(rem AS DOUBLE) / CAST(10 AS DOUBLE)) END AS e
         FROM qi JOIN rs a ON a.k = qi.j LEFT JOIN rs b ON b.k = qi.j + 1),
  inner_e AS (SELECT e FROM ed WHERE e > (SELECT min(e) FROM ed) AND e < (SELECT max(e) FROM ed)),
  rb AS (SELECT (SELECT count(*) FROM inner_e WHERE inner_e.e <= rv.v) AS b FROM rv),
  cb AS (SELECT (SELECT count(*) FROM inner_e WHERE inner_e.e <= cv.v) AS b FROM cv),
  rh AS (SELECT b, count(*) / (SELECT count(*) FROM rb) AS r FROM rb GROUP BY b),
  ch AS (SELECT b, count(*) / (SELECT count(*) FROM cb) AS c FROM cb GROUP BY b)
  SELECT CASE WHEN (SELECT count(*) FROM ed) < 3 OR (SELECT count(*) FROM cv) = 0 THEN 0.0
              ELSE coalesce(sum((greatest(coalesce(c, 0.0), 1e-6) - greatest(coalesce(r, 0.0), 1e-6))
                                * ln(greatest(coalesce(c, 0.0), 1e-6) / greatest(coalesce(r, 0.0), 1e-6))), 0.0) END
  FROM rh FULL OUTER JOIN ch ON rh.b = ch.b) AS psi"""


def _tv_sql(col: str) -> str:
    return f"""
SELECT '{col}' AS feature, (
  WITH r AS (SELECT coalesce(CAST({col} AS VARCHAR), '<null>') AS k, count(*) / (SELECT count(*) FROM feat_r) AS s FROM feat_r GROUP BY 1),
  c AS (SELECT coalesce(CAST({col} AS VARCHAR), '<null>') AS k, count(*) / (SELECT count(*) FROM feat_c) AS s FROM feat_c GROUP BY 1)
  SELECT coalesce(0.5 * sum(abs(coalesce(r.s, 0.0) - coalesce(c.s, 0.0))), 0.0) FROM r FULL OUTER JOIN c ON r.k = c.k) AS distance"""


BASE = (duckdb_with("txn") + f""", ref AS (SELECT * FROM txn WHERE timestamp < TIMESTAMP '{CUT}'),
cur AS (SELECT * FROM txn WHERE timestamp >= TIMESTAMP '{CUT}'),""" + _feat("ref", "r") + "," + _feat("cur", "c"))
PSI_SQL = " UNION ALL ".join(_psi_sql(c) for c in DRIFT_NUMERIC)
TV_SQL = " UNION ALL ".join(_tv_sql(c) for c in DRIFT_CATEGORICAL)


@register("psi", BASE + f"SELECT feature, round(psi, 6) AS psi FROM ({PSI_SQL})")
def q_psi(spark, sf_dir):
    ref, cur = windows(spark, sf_dir)
    ref, cur = ref.select(*DRIFT_NUMERIC).checkpoint(), cur.select(*DRIFT_NUMERIC).checkpoint()
    return dr.psi_many(ref, cur, DRIFT_NUMERIC).select("feature", r6("psi"))


@register("category_distance", BASE + f"SELECT feature, round(distance, 6) AS distance FROM ({TV_SQL})")
def q_tv(spark, sf_dir):
    return dr.category_distances(*windows(spark, sf_dir), DRIFT_CATEGORICAL).select("feature", r6("distance"))


@register("drift_report", BASE + f""",
v AS (SELECT psi AS value FROM ({PSI_SQL}) UNION ALL SELECT distance FROM ({TV_SQL}))
SELECT CASE WHEN max(value) >= {DEFAULT.psi_critical} THEN 'critical' WHEN max(value) >= {DEFAULT.psi_warning}
            THEN 'warning' ELSE 'healthy' END AS status,
       round(coalesce(max(value), 0.0), 6) AS max_drift,
       (SELECT count(*) FROM ref) AS reference_rows, (SELECT count(*) FROM cur) AS current_rows
FROM v""")
def q_drift(spark, sf_dir):
    ref, cur = windows(spark, sf_dir)
    _, summary = dr.drift_report(ref, cur)
    return summary.withColumn("max_drift", r6("max_drift"))


@register("drift_job", ORACLE["drift_report"])
def q_drift_job(spark, sf_dir):
    """The drift job from two files: written, read, cleaned, compared, its report read back."""
    t = txn(spark, sf_dir)
    cut = F.lit(CUT).cast("timestamp")
    base = files.scratch_path(spark, "drift")
    for name, part in (("reference", t.where(F.col("timestamp") < cut)), ("current", t.where(F.col("timestamp") >= cut))):
        part.drop("seq").write.parquet(f"{base}/{name}.parquet")
    _, summary = jobs.drift_between(spark, f"{base}/reference.parquet", f"{base}/current.parquet", f"{base}/report")
    found = files.scan_report_json(spark, f"{base}/report", schema=summary.schema)
    return found.withColumn("max_drift", r6("max_drift"))
