"""Quality rules: a decision list learned by sequential covering.

The list is learned from statistics of a bounded sample of labelled texts.  A
rule that rejects is grown condition by condition (greatest information gain
over threshold candidates) on two thirds of the rows not yet covered, pruned
from its end on the other third, and accepted if it is precise enough there; the
rows it covers are then set aside.  The ordered rules become one Spark
conditional expression, whose last branch keeps the text.

Two fixed rules stand before it: fewer than ``MIN_WORDS`` words, or more than
``MAX_REPEAT`` percent of the words in repeated windows.

A null or empty text has no words and fails; repeated rows get equal verdicts;
an empty table gives no rows; other columns are not read.  Without labelled rows
of both classes the list is empty and keeps all that the fixed rules keep.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import documents, keyed_texts
from tessera.llm.rule_ensemble import Condition, meets, simplified
from tessera.llm.text_stats import ALL, COUNTS, labelled_sample, with_stats

MIN_WORDS, MAX_REPEAT = 20, 30


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float
    covered: int


def _candidates(column: np.ndarray, most: int = 48) -> np.ndarray:
    values = np.unique(column)
    if len(values) > most:
        values = np.unique(np.quantile(values, np.linspace(0, 1, most)))
    return (values[1:] + values[:-1]) / 2


def _covers(x: np.ndarray, rule: list[tuple[int, str, float]]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for k, sign, cut in rule:
        out &= x[:, k] <= cut if sign == "<=" else x[:, k] > cut
    return out


def _grow(x: np.ndarray, bad: np.ndarray, longest: int) -> list[tuple[int, str, float]]:
    rule: list[tuple[int, str, float]] = []
    inside = np.ones(len(x), bool)
    while len(rule) < longest and (~bad & inside).any():
        p0, n0 = int((bad & inside).sum()), int((~bad & inside).sum())
        base = np.log2(p0 / (p0 + n0)) if p0 else 0
        best, pick = 1e-9, None
        for k in range(x.shape[1]):
            v, b = x[inside, k], bad[inside]
            for cut in _candidates(v):
                low = v <= cut
                for sign, flag in (("<=", low), (">", ~low)):
                    p, n = int((flag & b).sum()), int((flag & ~b).sum())
                    if p:
                        gain = p * (np.log2(p / (p + n)) - base)
                        if gain > best:
                            best, pick = gain, (k, sign, float(cut))
        if pick is None:
            break
        rule.append(pick)
        inside = _covers(x, rule)
    return rule


def _prune(rule: list, x: np.ndarray, bad: np.ndarray) -> list:
    def worth(r):
        c = _covers(x, r)
        p, n = int((c & bad).sum()), int((c & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    ends = [rule[:k] for k in range(len(rule), 0, -1)]
    return max(ends, key=worth) if ends else []


def learn(x: np.ndarray, good: np.ndarray, names: list[str] = ALL, precision: float = 0.95, least: int = 5,
          longest: int = 4, most_rules: int = 12, seed: int = 3) -> list[Rule]:
    """The ordered rejecting rules for rows ``x`` (statistics) and labels ``good``."""
    rules, left = [], np.ones(len(x), bool)
    rng = np.random.default_rng(seed)
    while len(rules) < most_rules and (~good & left).sum() >= least:
        grow = left & (rng.random(len(x)) < 2 / 3)
        test = left & ~grow
        rule = _prune(_grow(x[grow], ~good[grow], longest), x[test], ~good[test])
        inside = _covers(x, rule) & left if rule else np.zeros(len(x), bool)
        p, n = int((inside & ~good & test).sum()), int((inside & good & test).sum())
        if p + n == 0 or p / (p + n) < precision or inside.sum() < least:
            break
        rules.append(Rule(simplified([(names[k], sign, cut) for k, sign, cut in rule]), p / (p + n), int(inside.sum())))
        left &= ~inside
    return rules


def verdict(rules: list[Rule], stats: str = "stats") -> Column:
    """True to keep: the first rule that a text meets rejects it."""
    if not rules:
        return F.lit(True)
    out = F.when(meets(rules[0].conditions, stats), F.lit(False))
    for r in rules[1:]:
        out = out.when(meets(r.conditions, stats), F.lit(False))
    return out.otherwise(F.lit(True))


def base_failed(stats: str = "stats") -> Column:
    words, again = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (words < MIN_WORDS) | (again * 100 > words * MAX_REPEAT)


def learned(sample: DataFrame) -> list[Rule]:
    """Rules from a sample of bounded size with columns ``stats`` and ``label``."""
    rows = sample.select("label", *[F.col(f"stats.{c}").cast("double").alias(f"s_{c}") for c in ALL]).toPandas()
    rows = rows.sort_values(list(rows.columns)).to_numpy(float)
    if len(rows) == 0 or len(np.unique(rows[:, 0])) < 2:
        return []
    return learn(rows[:, 1:], rows[:, 0] == 1)


def judge(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, stats, base_failed, kept`` for each row."""
    return with_stats(keyed_texts(docs, id_col, text_col), keep_text=False).select(
        "id", "stats", base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


def q_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = learned(labelled_sample(spark, docs, sf_dir))
    return judge(docs, rules).select(F.col("id").alias("doc_id"), *[F.col(f"stats.{c}").cast("long").alias(c) for c in COUNTS], "base_failed", "kept")
