import numpy as np
import pytest

from tessera.operators import stats as S


def test_signed_rank_exact_tail():
    assert 2 * S.signed_rank_tail(20, 17) == pytest.approx(414 / 2 ** 20, abs=0)


def test_chi2_sf_closed_forms():
    assert S.chi2_sf_value(4.0, 2) == pytest.approx(np.exp(-2.0))
    assert S.chi2_sf_value(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-12)


def test_separated_models(spark):
    rng = np.random.default_rng(0)
    rows = []
    for r in range(20):
        for m, (lo, hi) in {"M1": (.7, .8), "M2": (.6, .7), "M3": (.5, .6)}.items():
            rows.append((m, r, float(rng.uniform(lo, hi))))
    df = spark.createDataFrame(rows, "model string, repeat int, macro_f1 double")
    f = S.friedman(df).first()
    assert f.p_value < 0.05 and f.k == 3 and f.n == 20
    w = S.wilcoxon_pairs(df).collect()
    assert len(w) == 3 and all(r.significant for r in w)


def test_golden_values_derived_by_hand(spark):
    # ranks per block (1,2,3), (1,3,2), (1,2,3), (2,1,3): sums 5, 8, 11, so
    # 12 / (4*3*4) * (25 + 64 + 121) - 3*4*4 = 4.5 and p = exp(-4.5 / 2)
    blocks = [(.1, .2, .3), (.1, .3, .2), (.1, .2, .3), (.2, .1, .3)]
    rows = [(m, r, v) for r, b in enumerate(blocks) for m, v in zip("ABC", b)]
    f = S.friedman(spark.createDataFrame(rows, "model string, repeat int, macro_f1 double")).first()
    assert f.statistic == pytest.approx(4.5) and f.p_value == pytest.approx(np.exp(-2.25)) and f.tie_sum == 0
    # five positive differences: W = 0, two of the 32 sign patterns are as extreme;
    # with one zero difference the approximation on n = 4 has W = 0, mean 5, variance 7.5
    rows = [("A", r, .5 + .01 * (r + 1) * (r + 1)) for r in range(5)] + [("B", r, .5) for r in range(5)]
    rows += [("C", r, .5 + (.01 * r * (r + 1))) for r in range(5)]
    w = {(r.model_a, r.model_b): r for r in S.wilcoxon_pairs(spark.createDataFrame(rows, "model string, repeat int, macro_f1 double")).collect()}
    ab, bc = w["A", "B"], w["B", "C"]
    assert (ab.statistic, ab.exact, ab.n) == (0, True, 5) and ab.p_value == pytest.approx(2 / 32) and not ab.significant
    assert (bc.statistic, bc.exact, bc.n) == (0, False, 4)
    from math import erfc, sqrt
    assert bc.p_value == pytest.approx(erfc(5 / sqrt(7.5) / sqrt(2)))


def test_friedman_refuses_incomplete_blocks(spark):
    rows = [(m, r, 0.1 * k + 0.01 * r) for k, m in enumerate("ABC") for r in range(4)]
    schema = "model string, repeat int, macro_f1 double"
    assert S.friedman(spark.createDataFrame(rows, schema)).first()["n"] == 4
    for broken in (rows[1:], rows + rows[:1], rows[:-1] + rows[:1]):
        with pytest.raises(Exception, match="incomplete or repeated"):
            S.friedman(spark.createDataFrame(broken, schema)).collect()


def test_unknown_models_lose_ties(spark):
    df = spark.createDataFrame([("zzz", 0, 0.9), ("RF", 0, 0.9), ("LR", 0, 0.9)], "model string, repeat int, macro_f1 double")
    from tessera.functions.exprs import MODEL_ORDER
    from tessera.operators.report import best_run
    assert best_run(df, model_order=MODEL_ORDER).first()["model"] == "LR"
    assert best_run(df.filter("model <> 'LR'"), model_order=("ET",)).first()["model"] == "RF"
