"""Contributions against the definition: every coalition of features."""
import json
from itertools import combinations
from math import factorial

import numpy as np
import pytest

from tessera.operators import cells as C
from tessera.operators import explain as X
from tessera.operators import trees as T
from tests.test_cells import PROGRAMS, sample


def coalition_value(model, root, x, inside):
    """A tree's output when only the features ``inside`` are known."""
    def walk(node):
        f = int(model["feature"][node])
        if f < 0:
            return float(model["value"][node])
        left = int(model["left"][node])
        if f in inside:
            return walk(left + int(x[f] > model["threshold"][node]))
        return (walk(left) * model["cover"][left] + walk(left + 1) * model["cover"][left + 1]) / model["cover"][node]
    return walk(int(root))


def plain_shapley(model, x, d):
    phi = np.zeros(d)
    for root in model["roots"]:
        for f in range(d):
            others = [g for g in range(d) if g != f]
            for k in range(d):
                for s in combinations(others, k):
                    weight = factorial(k) * factorial(d - 1 - k) / factorial(d)
                    phi[f] += weight * (coalition_value(model, root, x, {*s, f}) - coalition_value(model, root, x, set(s)))
    return phi


@pytest.mark.parametrize("name, params", [
    ("ET", {"n_estimators": 3, "max_depth": 6, "min_samples_leaf": 2, "max_features": "sqrt"}),
    ("RF", {"n_estimators": 3, "max_depth": 5, "min_samples_leaf": 2, "max_features": "sqrt"}),
    ("GB", {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.4, "subsample": 0.7})])
def test_every_coalition(name, params):
    b = sample(80, 5)
    model = C.answered(PROGRAMS[name](5, params, 8), b)
    scale, constant = X.output_scale(model)
    phi, base = X.tree_contributions(model, b.x, scale)
    for row in range(0, 80, 16):
        assert phi[row] == pytest.approx(plain_shapley(model, b.x[row], 5) * scale, abs=1e-10)
    told = T.boosted_margin(model, b.x) if name == "GB" else T.forest_score(model, b.x)
    assert base + constant + phi.sum(1) == pytest.approx(told, abs=1e-10)


def test_stump_by_hand():
    model = {"feature": np.array([0, -1, -1]), "threshold": np.array([0.5, 0, 0]), "left": np.array([1, 0, 0]),
             "value": np.array([0, 0.2, 1.0]), "cover": np.array([4.0, 3.0, 1.0]), "roots": np.array([0])}
    phi, base = X.tree_contributions(model, np.array([[0.0, 9.0], [1.0, 9.0]]), 1.0)
    assert base == pytest.approx(0.4) and phi.tolist() == [[pytest.approx(-0.2), 0.0], [pytest.approx(0.6), 0.0]]


def test_rows_of_many_cells_and_the_summary(spark):
    b = sample(60)
    rows = [(r, int(i), float(y), 1.0, [float(v) for v in x]) for r in (0, 1) for i, y, x in zip(b.key, b.y, b.x)]
    frame = spark.createDataFrame(rows, "repeat int, row_id long, label double, weight double, xs array<double>")
    params = json.dumps({"n_estimators": 6, "max_depth": 5, "min_samples_leaf": 2, "max_features": "sqrt", "mrmr_k": 4})
    fits = spark.createDataFrame([(0, 0, "ET", params), (1, 1, "ET", params)], "fit int, repeat int, program string, params string")
    blocks = C.block_table(frame, ["repeat"], block_rows=25).checkpoint()
    models = C.fit_cells(blocks, fits, ["repeat"], PROGRAMS).checkpoint()
    phi = X.contributions(blocks, fits, models, ["repeat"]).cache()
    got = phi.collect()
    assert len(got) == 120 and all(r.base + sum(r.phi) == pytest.approx(r.output, abs=1e-9) for r in got)
    support = spark.createDataFrame([(0, [7, 3, 5, 1]), (1, [1, 2, 3, 4])], "repeat int, sel array<int>")
    means = {(r.repeat, r.feature_idx): r.mean_abs for r in X.mean_contributions(phi, ["repeat"], support).collect()}
    want = np.abs(np.array([r.phi for r in got if r.repeat == 0])).mean(0)
    assert [means[(0, f)] for f in (7, 3, 5, 1)] == pytest.approx(want)
    top = X.top_features(X.mean_contributions(phi, ["repeat"], support), ["repeat"], 2).filter("repeat = 0").orderBy("rank").collect()
    assert [r.feature_idx for r in top] == [(7, 3, 5, 1)[k] for k in np.argsort(-want)[:2]]


def test_registered_query_adds_up(spark):
    """The whole query: ten ranked features, every row's contributions add up to its output, and the means are those of the rows."""
    from tessera.plans import queries as Q
    from tessera.plans.run import RunConfig, explain_run
    from tests.conftest import SF001

    w, _, _ = Q.prep_inputs(spark, SF001)
    found = explain_run(spark, w, RunConfig(), {"mrmr_k": 20, "n_estimators": 8, "max_depth": 6, "min_samples_leaf": 2, "max_features": "sqrt"})
    rows = found["contributions"].collect()
    order = found["support"].first().sel
    assert all(r.base + sum(r.phi) == pytest.approx(r.output, abs=1e-9) and len(r.phi) == 20 for r in rows)
    means = np.abs(np.array([r.phi for r in rows])).mean(0)
    want = sorted(((round(-m, 12), f) for m, f in zip(means, order)))[:10]
    top = sorted((r["rank"], r.feature_idx, r.mean_abs) for r in found["top"].collect())
    assert [t[1] for t in top] == [f for _, f in want] and [t[2] for t in top] == pytest.approx([-m for m, _ in want])
    assert "shap_top10" in Q.REGISTRY


def test_contributions_of_a_block_take_seconds_and_long_paths_add_up():
    import time

    from tessera.operators import trees
    from tessera.operators.cells import Block, answered
    from tessera.operators.explain import tree_contributions

    rng = np.random.default_rng(0)
    x = rng.normal(size=(8192, 50))
    block = Block(("a",), x, (x[:, 0] + rng.normal(size=8192) > 0).astype(float), np.ones(8192), np.arange(8192))
    model = answered(trees.extra_trees(50, {"n_estimators": 6, "max_depth": 12, "min_samples_leaf": 2, "max_features": "sqrt"}, 1), block)
    t0 = time.process_time()
    phi, base = tree_contributions(model, x, 1 / 6)
    assert time.process_time() - t0 < 20          # 42 s when each leaf sorted the rows' tests
    assert np.allclose(phi.sum(1) + base, trees.forest_score(model, x), atol=1e-12)

    k = 70                                        # one chain of 70 features: more tests than a code has bits
    chain = {"feature": np.full(2 * k + 1, -1, np.int32), "threshold": np.zeros(2 * k + 1), "left": np.zeros(2 * k + 1, np.int32),
             "value": rng.random(2 * k + 1), "cover": np.ones(2 * k + 1), "roots": np.array([0])}
    chain["feature"][:2 * k:2], chain["left"][:2 * k:2] = np.arange(k), np.arange(1, 2 * k, 2)
    chain["cover"][::2], chain["cover"][1::2] = 1 + np.arange(k, -1, -1), 1.0
    x = rng.normal(size=(40, k)) + 1.5
    phi, base = tree_contributions(chain, x, 1.0)
    assert np.allclose(phi.sum(1) + base, chain["value"][trees.leaves(chain, x)].sum(1), atol=1e-12)
