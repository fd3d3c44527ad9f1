"""Causal history features (W1-W12) and their live / snapshot variants.

Every history feature of a row aggregates the rows of the same sender, receiver
or (sender, receiver) pair that come strictly earlier in ``(timestamp, seq)``
order.  A plain ``Window.partitionBy(account)`` would put all rows of a hot
account into one task, so the history is computed as a two-level prefix sum:

1. Rows are cut into chunks of about equal row counts (quantiles of the timestamp, and of
   seq inside a time of very many rows), so a hot account's part of a chunk is bounded.  Partial
   aggregation gives one small row per (key, chunk); a window over that small
   table gives the totals of all *earlier* chunks (plus a state snapshot, if
   one is given).  These totals become "carry" rows.
2. Carry rows are unioned with the data rows, both hash-partitioned on
   (key, chunk), and a window per (key, chunk) running over
   ``(_kind, timestamp, seq)`` adds the carry to the in-chunk running values.

A hot account is thus split over as many tasks as it has chunks.  The sender
and pair windows share one exchange (hash on (from_account, chunk) clusters
(from_account, to_account, chunk) as well); the receiver windows take a
second.  Carry tables have a row per (key, chunk) with earlier history; rows that
would carry nothing are left out, and with a single chunk there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.functions import features as fx
from txnwatch.operators.ordinal import bucket_index
from txnwatch.schema import MODEL_FEATURES

CHUNK = "_chunk"
_ORDER = ["_kind", "timestamp", "seq"]
_UNB = Window.unboundedPreceding


ROWS_PER_CHUNK = 5_000_000


def chunk_bounds(rows: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> list[tuple[int, list[int]]]:
    """Where the rows are cut into chunks of about equal size, in (timestamp, seq) order.

    Bounds are quantiles of the timestamp (microseconds), so a stray early row or a burst does
    not change how many rows fall into a chunk; as a chunk has about ``rows_per_chunk`` rows
    of all accounts, no account has more in it.  A time that fills chunks by itself (times of
    minute resolution, a day's batch) carries quantiles of its rows' ``seq``, which cut it
    further.  No bounds when one chunk is enough.
    """
    t = F.unix_micros("timestamp")
    n = rows.select(t.alias("t")).agg(F.count("t")).first()[0]
    k = -(-n // rows_per_chunk)
    if k <= 1:
        return []
    steps = [i / k for i in range(1, k)]
    cuts = rows.agg(F.percentile_approx(t, steps, max(10_000, 4 * k)).alias("q")).first()["q"]
    times = sorted(set(cuts))
    heavy = [x for x in times if cuts.count(x) > 1]
    inside: dict[int, list[int]] = {}
    if heavy:
        parts = max(cuts.count(x) for x in heavy) + 1
        shares = [i / parts for i in range(1, parts)]
        found = (rows.where(t.isin(heavy)).groupBy(t.alias("t"))
                 .agg(F.percentile_approx("seq", shares, max(10_000, 4 * parts)).alias("q")).collect())
        inside = {r["t"]: sorted(set(r["q"])) for r in found}
    return [(x, inside.get(x, [])) for x in times]


def with_chunk(df: DataFrame, bounds: list[tuple[int, list[int]]]) -> DataFrame:
    """Adds the chunk number: how many bounds lie at or before the row's (time, seq)."""
    if not bounds:
        # always 0, but no literal: as one it would vanish from the windows and not from the exchanges
        return df.withColumn(CHUNK, F.pmod(F.unix_micros("timestamp"), F.lit(1)))
    timed = df.withColumn("_time", F.unix_micros("timestamp").cast("double"))
    out = bucket_index("_time", [float(x) for x, _ in bounds], CHUNK).setHandleInvalid("keep").transform(timed)
    at = F.col(CHUNK).cast("int")  # times at or before the row's
    if not any(cuts for _, cuts in bounds):
        return out.withColumn(CHUNK, at.cast("long")).drop("_time")
    before = [0]
    for _, cuts in bounds:  # seq cuts of earlier times
        before.append(before[-1] + len(cuts))
    heavy = [(x, cuts) for x, cuts in bounds if cuts]
    of_time = F.create_map(*[e for x, cuts in heavy for e in (F.lit(float(x)), F.array(*[F.lit(c).cast("long") for c in cuts]))])
    own = F.coalesce(F.try_element_at(of_time, F.col("_time")), F.array().cast("array<bigint>"))
    done = F.size(F.filter(own, lambda c: c <= F.col("seq")))
    earlier = F.coalesce(F.try_element_at(F.array(*[F.lit(x) for x in before]), at + 1), F.lit(before[-1])) - F.size(own)
    return out.withColumn(CHUNK, (at + earlier + done).cast("long")).drop("_time")


def _pair_chunks(r: DataFrame, pair_state: DataFrame | None) -> DataFrame:
    """(from, to, chunk) -> rows, amount, last time, and rows of the pair in
    earlier chunks (state included).  The only aggregation over data rows;
    every carry table is derived from it."""
    pc = r.groupBy("from_account", "to_account", CHUNK).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount_paid").alias("_s"), F.max("timestamp").alias("_lt"))
    w = Window.partitionBy("from_account", "to_account").orderBy(CHUNK).rowsBetween(_UNB, -1)
    pc = pc.withColumn("_prior", F.coalesce(F.sum("_n").over(w), F.lit(0)).cast("long"))
    if pair_state is not None:
        st = pair_state.select("from_account", "to_account", F.col("pair_count").alias("_st"))
        pc = (pc.join(st, ["from_account", "to_account"], "left")
              .withColumn("_prior", F.col("_prior") + F.coalesce(F.col("_st"), F.lit(0)).cast("long"))
              .drop("_st"))
    return pc


def _side_carry(pc: DataFrame, key: str, state: DataFrame | None, side: str) -> DataFrame:
    """(key, chunk) -> count, amount sum, new counterparties and last timestamp
    of all earlier chunks of this account (plus its state snapshot), from the
    pair-chunk table.  A pair first seen in a chunk adds one counterparty."""
    c = pc.groupBy(key, CHUNK).agg(
        F.sum("_n").alias("_n"),
        F.sum("_s").alias("_s"),
        F.max("_lt").alias("_lt"),
        F.count_if(F.col("_prior") == 0).alias("_fp"),
    )
    w = Window.partitionBy(key).orderBy(CHUNK)
    prev = w.rowsBetween(_UNB, -1)
    c = c.select(
        key,
        CHUNK,
        F.coalesce(F.sum("_n").over(prev), F.lit(0)).cast("long").alias("_cn"),
        F.coalesce(F.sum("_s").over(prev), F.lit(0.0)).alias("_cs"),
        F.coalesce(F.sum("_fp").over(prev), F.lit(0)).cast("long").alias("_cfp"),
        F.lag("_lt").over(w).alias("_clt"),
    )
    if state is not None:
        st = state.select(
            F.col("account").alias(key),
            F.col(f"{side}_count").alias("_a"),
            F.col(f"{side}_total").alias("_b"),
            F.col(f"{side}_unique").alias("_c"),
            F.col(f"last_{side}_ts").alias("_d"),
        )
        c = c.join(st, key, "left").select(
            key,
            CHUNK,
            (F.col("_cn") + F.coalesce(F.col("_a"), F.lit(0))).cast("long").alias("_cn"),
            (F.col("_cs") + F.coalesce(F.col("_b"), F.lit(0.0))).alias("_cs"),
            (F.col("_cfp") + F.coalesce(F.col("_c"), F.lit(0))).cast("long").alias("_cfp"),
            F.coalesce(F.col("_clt"), F.col("_d")).alias("_clt"),
        )
    return c


def history_counts(rows: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK,
                   account_state: DataFrame | None = None,
                   pair_state: DataFrame | None = None) -> DataFrame:
    """Append raw prior aggregates to ``rows``.

    Requires columns ``seq, timestamp, from_account, to_account, amount_paid``.
    Adds ``pair_prev_count``, ``_first`` (first row of its pair), and for
    sender ``_s_*`` / receiver ``_r_*``: prior count, prior amount sum, prior
    distinct counterparties and the previous timestamp.  With a state snapshot
    (T4) the prior values start from the state instead of zero.
    """
    cols = rows.columns
    bounds = chunk_bounds(rows, rows_per_chunk)
    r = with_chunk(rows, bounds)
    carried = bool(bounds) or account_state is not None or pair_state is not None
    pc = _pair_chunks(r, pair_state)

    # Stage 1: pair + sender, one exchange on (from_account, chunk).
    real = r.select(
        "*",
        F.lit(1).alias("_kind"),
        F.lit(1).cast("long").alias("_pw"),
        F.lit(1).cast("long").alias("_sn"),
        F.col("amount_paid").cast("double").alias("_ss"),
        F.col("timestamp").alias("_sts"),
        F.lit(None).cast("long").alias("_cfp"),
    )
    pair_carry = pc.select("from_account", "to_account", CHUNK, F.lit(0).alias("_kind"),
                           F.col("_prior").alias("_pw")).where("_pw > 0")
    s_carry = _side_carry(pc, "from_account", account_state, "sent").select(
        "from_account", CHUNK, F.lit(0).alias("_kind"), F.col("_cn").alias("_sn"),
        F.col("_cs").alias("_ss"), F.col("_clt").alias("_sts"), F.col("_cfp")).where("_sn > 0")
    u = real.repartition("from_account", CHUNK)
    if carried:
        u = (u.unionByName(pair_carry.repartition("from_account", CHUNK), allowMissingColumns=True)
             .unionByName(s_carry.repartition("from_account", CHUNK), allowMissingColumns=True))
    wp = Window.partitionBy("from_account", "to_account", CHUNK).orderBy(*_ORDER).rowsBetween(_UNB, -1)
    is_real = F.col("_kind") == 1
    pair_prev = F.coalesce(F.sum("_pw").over(wp), F.lit(0)).cast("long")
    first = F.when(is_real & (pair_prev == 0), 1).otherwise(0)
    u = u.select("*", pair_prev.alias("pair_prev_count"), first.alias("_first"),
                 F.when(is_real, first.cast("long")).otherwise(F.col("_cfp")).alias("_sfp"))
    ws = Window.partitionBy("from_account", CHUNK).orderBy(*_ORDER).rowsBetween(_UNB, -1)
    stage1 = u.select(
        *cols, CHUNK, "_kind", "pair_prev_count", "_first",
        F.coalesce(F.sum("_sn").over(ws), F.lit(0)).cast("long").alias("_s_cnt"),
        F.coalesce(F.sum("_ss").over(ws), F.lit(0.0)).alias("_s_sum"),
        F.coalesce(F.sum("_sfp").over(ws), F.lit(0)).cast("long").alias("_s_uniq"),
        F.last("_sts", ignorenulls=True).over(ws).alias("_s_prev_ts"),
    ).where(is_real)

    # Stage 2: receiver, one exchange on (to_account, chunk).
    real2 = stage1.select(
        "*",
        F.lit(1).cast("long").alias("_rn"),
        F.col("amount_paid").cast("double").alias("_rs"),
        F.col("timestamp").alias("_rts"),
        F.col("_first").cast("long").alias("_rfp"),
    )
    r_carry = _side_carry(pc, "to_account", account_state, "received").select(
        "to_account", CHUNK, F.lit(0).alias("_kind"), F.col("_cn").alias("_rn"),
        F.col("_cs").alias("_rs"), F.col("_clt").alias("_rts"), F.col("_cfp").alias("_rfp")).where("_rn > 0")
    u2 = real2.repartition("to_account", CHUNK)
    if carried:
        u2 = u2.unionByName(r_carry.repartition("to_account", CHUNK), allowMissingColumns=True)
    wr = Window.partitionBy("to_account", CHUNK).orderBy(*_ORDER).rowsBetween(_UNB, -1)
    return u2.select(
        *cols, "pair_prev_count", "_first", "_s_cnt", "_s_sum", "_s_uniq", "_s_prev_ts",
        F.coalesce(F.sum("_rn").over(wr), F.lit(0)).cast("long").alias("_r_cnt"),
        F.coalesce(F.sum("_rs").over(wr), F.lit(0.0)).alias("_r_sum"),
        F.coalesce(F.sum("_rfp").over(wr), F.lit(0)).cast("long").alias("_r_uniq"),
        F.last("_rts", ignorenulls=True).over(wr).alias("_r_prev_ts"),
        "_kind",
    ).where(F.col("_kind") == 1).drop("_kind")


def finish_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Turn raw prior aggregates into the 25 model features (+ kept columns)."""
    paid = F.col("amount_paid").cast("double")
    s_avg = fx.prior_average(F.col("_s_sum"), F.col("_s_cnt"))
    r_avg = fx.prior_average(F.col("_r_sum"), F.col("_r_cnt"))
    feats: dict[str, Column] = {
        "amount_paid": paid,
        "amount_received": F.col("amount_received").cast("double"),
        **fx.row_features(),
        "sender_prev_tx_count": F.col("_s_cnt").cast("int"),
        "receiver_prev_tx_count": F.col("_r_cnt").cast("int"),
        "sender_prev_avg_amount": s_avg,
        "receiver_prev_avg_amount": r_avg,
        "sender_amount_to_avg": fx.amount_to_average(paid, s_avg),
        "receiver_amount_to_avg": fx.amount_to_average(paid, r_avg),
        "sender_minutes_since_last": fx.minutes_since_last(F.col("timestamp"), F.col("_s_prev_ts")),
        "receiver_minutes_since_last": fx.minutes_since_last(F.col("timestamp"), F.col("_r_prev_ts")),
        "pair_prev_count": F.col("pair_prev_count").cast("int"),
        "sender_unique_counterparties": F.col("_s_uniq").cast("int"),
        "receiver_unique_counterparties": F.col("_r_uniq").cast("int"),
        "payment_format": F.col("payment_format"),
        "payment_currency": F.col("payment_currency"),
        "receiving_currency": F.col("receiving_currency"),
    }
    keep = [c for c in (keep if keep is not None else df.columns)
            if not c.startswith("_") and c not in feats and c != "pair_prev_count"]
    return df.select(*keep, *[feats[name].alias(name) for name in MODEL_FEATURES])


def causal_features(txn: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """The transaction table plus its 22 numeric + 3 categorical model features."""
    return finish_features(history_counts(txn, rows_per_chunk), keep=txn.columns)


def live_features(batch: DataFrame, account_state: DataFrame, pair_state: DataFrame,
                  rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """T4: each transaction sees the state snapshot plus every earlier row of
    the same batch (state updated row by row in (timestamp, seq) order)."""
    h = history_counts(batch, rows_per_chunk, account_state=account_state, pair_state=pair_state)
    return finish_features(h, keep=batch.columns)


def snapshot_features(batch: DataFrame, account_state: DataFrame, pair_state: DataFrame) -> DataFrame:
    """Features against a frozen state snapshot; rows of the batch do not
    see each other.  Three left joins (sender, receiver, pair)."""
    s = account_state.select(
        F.col("account").alias("from_account"),
        F.col("sent_count").alias("_s_cnt"), F.col("sent_total").alias("_s_sum"),
        F.col("sent_unique").alias("_s_uniq"), F.col("last_sent_ts").alias("_s_prev_ts"))
    r = account_state.select(
        F.col("account").alias("to_account"),
        F.col("received_count").alias("_r_cnt"), F.col("received_total").alias("_r_sum"),
        F.col("received_unique").alias("_r_uniq"), F.col("last_received_ts").alias("_r_prev_ts"))
    p = pair_state.select("from_account", "to_account", F.col("pair_count").alias("pair_prev_count"))
    j = (batch.join(s, "from_account", "left")
         .join(r, "to_account", "left")
         .join(p, ["from_account", "to_account"], "left"))
    j = j.select(
        *batch.columns,
        F.coalesce("_s_cnt", F.lit(0)).alias("_s_cnt"), F.coalesce("_s_sum", F.lit(0.0)).alias("_s_sum"),
        F.coalesce("_s_uniq", F.lit(0)).alias("_s_uniq"), "_s_prev_ts",
        F.coalesce("_r_cnt", F.lit(0)).alias("_r_cnt"), F.coalesce("_r_sum", F.lit(0.0)).alias("_r_sum"),
        F.coalesce("_r_uniq", F.lit(0)).alias("_r_uniq"), "_r_prev_ts",
        F.coalesce("pair_prev_count", F.lit(0)).alias("pair_prev_count"),
    )
    return finish_features(j, keep=batch.columns)
