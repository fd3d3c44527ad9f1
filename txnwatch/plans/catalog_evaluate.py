"""Queries for the temporal split, threshold selection and evaluation
(M1, M8-M16, M18, M19) on the fixture score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.config import DEFAULT
from txnwatch.operators import evaluate as ev
from txnwatch.plans.fixtures import duckdb_with, fixture
from txnwatch.plans.registry import r6, register

P = DEFAULT
TRAIN_FRAC = repr(1.0 - P.validation_fraction - P.test_fraction)
VAL_FRAC = repr(1.0 - P.test_fraction)

SPLIT_SQL = duckdb_with("scored") + f""",
sc AS (SELECT *, row_number() OVER (ORDER BY timestamp, seq) - 1 AS ord, count(*) OVER () AS n FROM scored),
sp AS (SELECT *, CASE WHEN ord < CAST(floor(n * CAST({TRAIN_FRAC} AS DOUBLE)) AS BIGINT) THEN 'train'
                      WHEN ord < CAST(floor(n * CAST({VAL_FRAC} AS DOUBLE)) AS BIGINT) THEN 'validation'
                      ELSE 'test' END AS split FROM sc),
v AS (SELECT risk_score AS p, is_laundering AS y FROM sp WHERE split = 'validation'),
t AS (SELECT risk_score AS p, is_laundering AS y FROM sp WHERE split = 'test'),
vs AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS k FROM v),
vn AS (SELECT count(*) AS n FROM v),
qi AS (SELECT i, ((n - 1) * i) // 400 AS j, ((n - 1) * i) % 400 AS rem FROM range(0, 401) r(i), vn),
qv AS (SELECT CASE WHEN rem = 0 THEN a.p
                   WHEN CAST(rem AS DOUBLE) / CAST(400 AS DOUBLE) >= 0.5
                     THEN b.p - (b.p - a.p) * (CAST(1 AS DOUBLE) - CAST(rem AS DOUBLE) / CAST(400 AS DOUBLE))
                   ELSE a.p + (b.p - a.p) * (CAST(rem AS DOUBLE) / CAST(400 AS DOUBLE)) END AS threshold
       FROM qi JOIN vs a ON a.k = qi.j LEFT JOIN vs b ON b.k = qi.j + 1),
cand AS (SELECT DISTINCT threshold FROM qv),
vt AS (SELECT count(*) AS nn, sum(y) AS pp FROM v),
sw AS (SELECT c.threshold, count_if(v.p >= c.threshold AND v.y = 0) AS fp, count_if(v.p < c.threshold AND v.y = 1) AS fn,
              count_if(v.p >= c.threshold AND v.y = 1) AS tp, count_if(v.p >= c.threshold) AS alerts
       FROM cand c, v GROUP BY c.threshold),
swm AS (SELECT threshold, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
               CAST(fp AS DOUBLE) * {P.false_positive_cost} + CAST(fn AS DOUBLE) * {P.false_negative_cost} AS expected_cost,
               coalesce(tp / nullif(alerts, 0), 0.0) AS precision, coalesce(tp / nullif(pp, 0), 0.0) AS recall,
               alerts / nn AS alert_rate
        FROM sw, vt),
sel AS (SELECT * FROM swm ORDER BY (alert_rate <= {P.max_alert_rate} AND recall >= {P.min_recall}) DESC,
        expected_cost, threshold LIMIT 1)
"""


def _metrics_sql(src: str) -> str:
    return f"""
SELECT '{src}' AS split, th AS threshold, CAST(rows AS BIGINT) AS rows, positives / rows AS positive_rate, alerts / rows AS alert_rate,
       coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
       CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
       CAST(fp AS DOUBLE) * {P.false_positive_cost} + CAST(fn AS DOUBLE) * {P.false_negative_cost} AS expected_cost,
       (SELECT coalesce(sum(pos * tpc / nc) / nullif(sum(pos), 0), 0.0)
          FROM (SELECT pos, sum(pos) OVER (ORDER BY p DESC) AS tpc, sum(n) OVER (ORDER BY p DESC) AS nc
                FROM (SELECT p, count(*) AS n, sum(y) AS pos FROM {src} GROUP BY p))) AS average_precision,
       (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                    THEN sum(pos * (negb + 0.5 * neg)) / (sum(pos) * sum(neg)) END
          FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS negb
                FROM (SELECT p, sum(y) AS pos, count(*) - sum(y) AS neg FROM {src} GROUP BY p))) AS roc_auc
FROM (SELECT count_if(p < th AND y = 0) AS tn, count_if(p >= th AND y = 0) AS fp, count_if(p < th AND y = 1) AS fn,
             count_if(p >= th AND y = 1) AS tp, count(*) AS rows, count_if(y = 1) AS positives, count_if(p >= th) AS alerts,
             max(th) AS th
      FROM {src}, (SELECT threshold AS th FROM sel))
"""


def _q(cols: list[str], src: str = "t", rounded: tuple[str, ...] = ()) -> str:
    sel = ", ".join(f"round({c}, 6) AS {c}" if c in rounded else c for c in cols)
    return SPLIT_SQL + f"SELECT {sel} FROM ({_metrics_sql(src)})"


DOUBLES = ("positive_rate", "alert_rate", "precision", "recall", "f1", "expected_cost",
           "average_precision", "roc_auc", "laundering_rate")


class _Eval:
    """Split, threshold and both evaluation frames for one sf directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        scored = fixture(spark, sf_dir, "scored")
        self.split = ev.temporal_split(scored).checkpoint()
        self.validation = self.split.where(F.col("split") == "validation")
        self.test = self.split.where(F.col("split") == "test")
        self.cands = ev.threshold_candidates(self.validation)
        self.sweep = ev.threshold_sweep(self.validation, self.cands)
        self.selected = ev.select_threshold(self.sweep)
        self.threshold = self.selected.select("threshold").first()[0]

    def metrics(self, which: str) -> DataFrame:
        src = self.test if which == "test" else self.validation
        return ev.evaluate_predictions(src, self.threshold).withColumn("split", F.lit(which))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c) if c in DOUBLES else F.col(c) for c in df.columns])


@register("temporal_split", SPLIT_SQL + "SELECT seq, split FROM sp")
def q_temporal_split(spark, sf_dir):
    return ev.temporal_split(fixture(spark, sf_dir, "scored")).select("seq", "split")


@register("threshold_candidates", SPLIT_SQL + "SELECT threshold FROM cand")
def q_candidates(spark, sf_dir):
    e = _Eval(spark, sf_dir)
    return spark.createDataFrame([(c,) for c in e.cands], "threshold double")


@register("threshold_sweep", SPLIT_SQL + """SELECT threshold, fp, fn, round(expected_cost, 6) AS expected_cost,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(alert_rate, 6) AS alert_rate FROM swm""")
def q_sweep(spark, sf_dir):
    return _rounded(_Eval(spark, sf_dir).sweep)


@register("select_threshold", SPLIT_SQL + """SELECT threshold, round(expected_cost, 6) AS expected_cost,
  round(precision, 6) AS precision, round(recall, 6) AS recall, round(alert_rate, 6) AS alert_rate FROM sel""")
def q_select(spark, sf_dir):
    return _rounded(_Eval(spark, sf_dir).selected)


@register("confusion_counts", _q(["tn", "fp", "fn", "tp"]))
def q_confusion(spark, sf_dir):
    return _Eval(spark, sf_dir).metrics("test").select("tn", "fp", "fn", "tp")


METRIC_COLS = ["rows", "positive_rate", "alert_rate", "precision", "recall", "f1"]


@register("classification_metrics", _q(METRIC_COLS, rounded=DOUBLES))
def q_metrics(spark, sf_dir):
    return _rounded(_Eval(spark, sf_dir).metrics("test").select(*METRIC_COLS))


@register("average_precision", _q(["average_precision"], rounded=DOUBLES))
def q_ap(spark, sf_dir):
    return _rounded(_Eval(spark, sf_dir).metrics("test").select("average_precision"))


@register("roc_auc", _q(["roc_auc"], rounded=DOUBLES))
def q_auc(spark, sf_dir):
    return _rounded(_Eval(spark, sf_dir).metrics("test").select("roc_auc"))


@register("expected_cost", _q(["expected_cost"], rounded=DOUBLES))
def q_cost(spark, sf_dir):
    return _rounded(_Eval(spark, sf_dir).metrics("test").select("expected_cost"))


@register("dataset_summary", SPLIT_SQL + """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count_if(split = 'train') AS BIGINT) AS train_rows,
       CAST(count_if(split = 'validation') AS BIGINT) AS validation_rows, CAST(count_if(split = 'test') AS BIGINT) AS test_rows,
       min(timestamp) AS start_timestamp, max(timestamp) AS end_timestamp, round(avg(is_laundering), 6) AS laundering_rate
FROM sp""")
def q_summary(spark, sf_dir):
    return _rounded(ev.dataset_summary(ev.temporal_split(fixture(spark, sf_dir, "scored"))))


COMPARE_COLS = ["split", "threshold", "precision", "recall", "f1", "average_precision", "roc_auc", "alert_rate"]


@register("evaluation_comparison", SPLIT_SQL + "SELECT " + ", ".join(
    f"round({c}, 6) AS {c}" if c in DOUBLES else c for c in COMPARE_COLS)
    + f" FROM ({_metrics_sql('v')} UNION ALL {_metrics_sql('t')})")
def q_compare(spark, sf_dir):
    e = _Eval(spark, sf_dir)
    both = ev.evaluate_splits(e.split.where("split <> 'train'"), e.threshold)
    both = both.withColumn("split", F.substring("split", 1, 1))
    return _rounded(both.select(*COMPARE_COLS))


@register("confusion_matrix_table", SPLIT_SQL + """
SELECT a.actual, CAST(coalesce(sum(CASE WHEN t.p < s.threshold THEN 1 ELSE 0 END), 0) AS BIGINT) AS predicted_0,
       CAST(coalesce(sum(CASE WHEN t.p >= s.threshold THEN 1 ELSE 0 END), 0) AS BIGINT) AS predicted_1
FROM (SELECT 0 AS actual UNION ALL SELECT 1) a CROSS JOIN sel s LEFT JOIN t ON t.y = a.actual
GROUP BY a.actual""")
def q_matrix(spark, sf_dir):
    e = _Eval(spark, sf_dir)
    return ev.confusion_matrix_table(e.test, e.threshold)
