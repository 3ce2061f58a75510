"""Quality classifier: a sparse ensemble of rules.

1. A random forest is grown on statistics of a bounded sample of labelled texts.
2. Each path from a root to a node is a rule: a conjunction of thresholds.
3. A lasso logistic regression weighs the rules and leaves few of them.
4. The rules that remain become Spark column expressions; the score of a text
   is the logistic function of the sum of the weights of the rules it meets.

Scoring is one pass over the texts without a shuffle.  Only statistics of the
text enter the score.  A null text is scored as an empty one; repeated rows get
equal scores; an empty table gives no rows; other columns are not read.  Without
labelled rows of both classes the score is the smoothed share of class 1.
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_fold, documents, keyed_texts
from tessera.llm.text_stats import ALL, labelled_sample, with_stats

#: (statistic, "<=" or ">", threshold)
Condition = tuple[str, str, float]
SPLIT = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


@dataclass
class RuleEnsemble:
    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def score(self, stats: str = "stats") -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(meets(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def meets(rule: tuple[Condition, ...], stats: str = "stats") -> Column:
    out = F.lit(True)
    for name, sign, cut in rule:
        col = F.col(f"{stats}.{name}").cast("double")
        out = out & (col <= cut if sign == "<=" else col > cut)
    return out


def simplified(path: list[Condition]) -> tuple[Condition, ...]:
    """One condition for each statistic and sign: the strictest."""
    best: dict[tuple[str, str], float] = {}
    for name, sign, cut in path:
        old = best.get((name, sign), cut)
        best[name, sign] = min(old, cut) if sign == "<=" else max(old, cut)
    return tuple(sorted((name, sign, cut) for (name, sign), cut in best.items()))


def tree_paths(debug: str, names: list[str]) -> list[tuple[Condition, ...]]:
    """The conjunction that leads to each node of a printed tree, root excepted."""
    out, path = [], []
    for line in debug.splitlines():
        if m := SPLIT.match(line):
            depth = len(m[1])
            path = [(d, c) for d, c in path if d < depth] + [(depth, (names[int(m[3])], m[4], float(m[5])))]
            out.append(simplified([c for _, c in path]))
    return out


def fit(sample: DataFrame, trees: int = 24, depth: int = 4, lasso: float = 0.001, seed: int = 7) -> RuleEnsemble:
    """``sample``: columns ``stats`` and ``label`` (0 or 1), of bounded size."""
    counts = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return RuleEnsemble(_logit(share))
    rows = sample.select(F.col("label").cast("double").alias("label"), "stats",
                         array_to_vector(F.array(*[F.col(f"stats.{c}").cast("double") for c in ALL])).alias("features")).coalesce(4).cache()
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=5, subsamplingRate=0.7,
                                    featureSubsetStrategy="onethird", maxBins=64).fit(rows)
    rules = sorted({p for t in forest.trees for p in tree_paths(t.toDebugString, ALL)})
    # texts that meet the same rules count as one weighted row; the sample bounds their number
    flags = rows.select("label", F.array(*[meets(r).cast("double") for r in rules]).alias("met"))
    seen = flags.groupBy("label", "met").agg(F.count(F.lit(1)).alias("n")).orderBy("label", "met").collect()
    rows.unpersist()
    x = np.array([r["met"] for r in seen], float).reshape(len(seen), len(rules))
    weights, intercept = lasso_logistic(x, np.array([r["label"] for r in seen]), np.array([r["n"] for r in seen], float), lasso)
    return RuleEnsemble(float(intercept), [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-9])


def lasso_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, lasso: float, steps: int = 20_000, tol: float = 1e-9) -> tuple[np.ndarray, float]:
    """Weights and intercept of least mean log-loss plus ``lasso`` times the sum of
    absolute weights, for rows that count ``n`` times (accelerated proximal gradient)."""
    share = n / n.sum()
    full = np.hstack([x, np.ones((len(x), 1))])
    rate = 1 / max(1e-12, 0.25 * np.linalg.eigvalsh((full * share[:, None]).T @ full)[-1])
    shrink = np.append(np.full(x.shape[1], lasso * rate), 0.0)
    w = ahead = np.zeros(full.shape[1])
    pace = 1.0
    for _ in range(steps):
        z = ahead - rate * (full.T @ (share * (1 / (1 + np.exp(-full @ ahead)) - y)))
        new = np.sign(z) * np.maximum(np.abs(z) - shrink, 0)
        if (new - w) @ (ahead - new) > 0:  # the momentum overshoots: start it anew
            pace = 1.0
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = new + (pace - 1) / faster * (new - w)
        moved, w, pace = np.abs(new - w).max(), new, faster
        if moved < tol:
            break
    return w[:-1], float(w[-1])


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


def score_texts(docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` for each row."""
    return with_stats(keyed_texts(docs, id_col, text_col), keep_text=False).select("id", model.score().alias("score"))


def trained(spark, docs: DataFrame, sf_dir: str) -> RuleEnsemble:
    return fit(labelled_sample(spark, docs, sf_dir))


THRESHOLD = 0.3


def q_rule_ensemble(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_texts(docs, trained(spark, docs, sf_dir)).select(
        F.col("id").alias("doc_id"), (crc_fold("id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
