"""Probability calibration and soft voting over many cells at once.

Platt scaling fits p = 1/(1 + exp(a·s + b)) per cell on out-of-fold scores
with the smoothed targets (N₊+1)/(N₊+2) and 1/(N₋+2).  All cells take their
Newton steps together on the (cell, score) histogram: the scored rows are
aggregated once, each step sums five numbers per cell over distinct scores.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.exprs import clip01

PLATT_MAX_ITER = 50
PLATT_TOL = 1e-12


def _targets(hist: DataFrame, by: Sequence[str]) -> DataFrame:
    c = hist.groupBy(*by).agg(F.sum("n1").alias("npos"), F.sum("n0").alias("nneg"))
    t1 = (F.col("npos") + 1.0) / (F.col("npos") + 2.0)
    t0 = 1.0 / (F.col("nneg") + 2.0)
    return c.select(*by, "npos", "nneg", t1.alias("t1"), t0.alias("t0"))


def platt_fit(scores: DataFrame, by: Sequence[str], y: str = "y_true", s: str = "score",
              max_iter: int = PLATT_MAX_ITER, tol: float = PLATT_TOL, grad_tol: float = 1e-7) -> DataFrame:
    """Per-cell sigmoid parameters ``(cell…, a, b, n_iter, grad_a, grad_b, converged)``.

    ``grad_a`` and ``grad_b`` are the mean gradient at (a, b); ``converged`` says
    that both are below ``grad_tol``, whatever ended the steps.  The driver holds
    one row per cell; cells come from the run's configuration.

    Start a = 0, b = log((N₋+1)/(N₊+1)); Newton steps with step halving on the
    per-cell log-loss.  The per-cell parameters are a cells-sized table that is
    re-created each step, so lineage stays one aggregation deep."""
    by = list(by)
    spark: SparkSession = scores.sparkSession
    yc = F.col(y).cast("long")
    data = scores.groupBy(*by, F.col(s).cast("double").alias("s")).agg(F.sum(yc).alias("n1"), F.sum(1 - yc).alias("n0")).cache()
    tg = _targets(data, by).collect()
    params = {tuple(r[c] for c in by): dict(a=0.0, b=math.log((r.nneg + 1.0) / (r.npos + 1.0)),
                                            t1=r.t1, t0=r.t0, loss=None, it=0)
              for r in tg}
    schema = ", ".join(f"`{c}` {dict(data.dtypes)[c]}" for c in by) + ", a double, b double, t1 double, t0 double"

    def table(cands):
        rows = [(*k, v[0], v[1], params[k]["t1"], params[k]["t0"]) for k, v in cands.items()]
        return spark.createDataFrame(rows, schema)

    def stats(cands):
        t = table(cands)
        j = data.join(F.broadcast(t), by)
        f = F.col("a") * F.col("s") + F.col("b")
        p = 1.0 / (1.0 + F.exp(f))
        n = F.col("n1") + F.col("n0")
        hit = F.col("n1") * F.col("t1") + F.col("n0") * F.col("t0")  # sum of the targets at this score
        eps = 1e-300
        loss = -(hit * F.log(F.greatest(p, F.lit(eps))) + (n - hit) * F.log(F.greatest(1 - p, F.lit(eps))))
        r = hit - n * p
        h = n * p * (1 - p)
        agg = j.groupBy(*by).agg(F.sum(n).alias("n"), F.sum(loss).alias("loss"), F.sum(r * F.col("s")).alias("ga"),
                                 F.sum(r).alias("gb"), F.sum(h * F.col("s") * F.col("s")).alias("haa"),
                                 F.sum(h * F.col("s")).alias("hab"), F.sum(h).alias("hbb"))
        return {tuple(x[c] for c in by): x for x in agg.collect()}

    active = set(params)
    cur = stats({k: (params[k]["a"], params[k]["b"]) for k in active})
    for k in active:
        params[k]["loss"] = cur[k].loss
    for it in range(max_iter):
        if not active:
            break
        pending = {}
        flat = {k for k in active if max(abs(cur[k].ga), abs(cur[k].gb)) <= 1e-4 * grad_tol * cur[k].n}
        for k in active - flat:
            st = cur[k]
            det = st.haa * st.hbb - st.hab * st.hab
            if det <= 0:
                da, db = 0.0, (st.gb / st.hbb if st.hbb > 0 else 0.0)
            else:                       # Newton direction −H⁻¹g
                da = -(st.hbb * st.ga - st.hab * st.gb) / det
                db = -(-st.hab * st.ga + st.haa * st.gb) / det
            pending[k] = (da, db, 1.0)
        finished = flat
        for _ in range(8):              # step halving, all cells in one pass per try
            if not pending:
                break
            cands = {k: (params[k]["a"] + lam * da, params[k]["b"] + lam * db)
                     for k, (da, db, lam) in pending.items()}
            new = stats(cands)
            nxt = {}
            for k, (a2, b2) in cands.items():
                old_loss = params[k]["loss"]
                level = tol * max(1.0, abs(old_loss))   # below it the loss is rounding: the gradient decides
                smaller = max(abs(new[k].ga), abs(new[k].gb)) < max(abs(cur[k].ga), abs(cur[k].gb))
                if new[k].loss <= old_loss - level or (new[k].loss <= old_loss + level and smaller):
                    moved = abs(a2 - params[k]["a"]) + abs(b2 - params[k]["b"])
                    params[k].update(a=a2, b=b2, loss=new[k].loss, it=it + 1)
                    cur[k] = new[k]
                    if moved <= tol * (1.0 + abs(a2) + abs(b2)):
                        finished.add(k)
                else:
                    da, db, lam = pending[k]
                    nxt[k] = (da, db, lam / 2)
            pending = nxt
        finished |= set(pending)        # no descent left: at the optimum to working precision
        active -= finished
    data.unpersist()
    rows = []
    for k, v in params.items():
        ga, gb = cur[k].ga / cur[k].n, cur[k].gb / cur[k].n
        rows.append((*k, v["a"], v["b"], v["it"], ga, gb, max(abs(ga), abs(gb)) < grad_tol))
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {dict(scores.dtypes)[c]}" for c in by)
                                 + ", a double, b double, n_iter int, grad_a double, grad_b double, converged boolean")


def platt_apply(scores: DataFrame, params: DataFrame, by: Sequence[str], s: str = "score",
                out: str = "proba") -> DataFrame:
    """Calibrated probability, clipped to [0, 1], with its complement."""
    j = scores.join(params.select(*by, "a", "b"), list(by))  # AQE measures the parameter side
    p = clip01(1.0 / (1.0 + F.exp(F.col("a") * F.col(s) + F.col("b"))))
    return j.withColumn(out, p).withColumn(f"{out}_pair", F.array(1 - F.col(out), F.col(out))).drop("a", "b")


def soft_vote(pred: DataFrame, members: Sequence[str], keys: Sequence[str], name: str = "Ensemble",
              p: str = "proba") -> DataFrame:
    """Mean calibrated probability of the member models per row —
    an aggregation over (keys), no join.  A row lacking a member, or having one
    twice, raises when the result is computed: no row is dropped."""
    keys = list(keys)
    m = pred.filter(F.col("model").isin(*members))
    flag = F.lit(0).cast("long")
    for k, x in enumerate(members):
        flag = F.when(F.col("model") == x, F.lit(1 << k).cast("long")).otherwise(flag)
    agg = m.groupBy(*keys).agg(F.avg(p).alias("_mean"), F.count(F.lit(1)).alias("_n"), F.bit_or(flag).alias("_m"))
    whole = (F.col("_n") == len(members)) & (F.col("_m") == (1 << len(members)) - 1)
    mean = F.when(whole, F.col("_mean")).otherwise(F.raise_error(F.lit("soft_vote: a row lacks a member or repeats one")).cast("double"))
    return agg.select(*keys, mean.alias(p), F.lit(name).alias("model"))
