"""Fit programs: brute force, equality of the one-block and many-block ways, Spark ML as a check."""
import json

import numpy as np
import pytest

from tessera.operators import cells as C
from tessera.operators import linear as L
from tessera.operators import trees as T

PROGRAMS = {"ET": T.extra_trees, "RF": T.random_forest, "GB": T.boosting, "LR": L.logistic, "SVM": L.svm}
SCORERS = {"ET": T.forest_score, "RF": T.forest_score, "GB": T.boosted_score, "LR": L.logistic_score, "SVM": L.svm_margin}


def sample(n=120, d=6, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[:, 2] = np.round(x[:, 2])
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 3] + 0.4 * rng.normal(size=n) > 0).astype(float)
    w = np.where(y > 0.5, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    return C.Block((0, 0), x, y, w, np.arange(n) * 7 + 1)


def plain_extra_tree(b, tree, d, p, seed):
    """One tree, node by node, from the same hashes; nested (feature, threshold, left, right) or a share."""
    m = T.sample_size(p["max_features"], d)

    def grow(rows, number, depth):
        w1, w0 = b.w[rows][b.y[rows] > 0.5].sum(), b.w[rows][b.y[rows] < 0.5].sum()
        share = w1 / (w1 + w0)
        if depth == p["max_depth"] or w1 == 0 or w0 == 0 or len(rows) < max(2, 2 * p["min_samples_leaf"]):
            return share
        order = sorted(range(d), key=lambda f: (float(T.uniform(seed, tree, number, f)), f))[:m]
        found = []
        for f in order:
            v = b.x[rows, f]
            if v.max() > v.min():
                t = min(v.min() + float(T.uniform(seed + 2, tree, number, f)) * (v.max() - v.min()), np.nextafter(v.max(), -np.inf))
                sides = rows[v <= t], rows[v > t]
                if min(map(len, sides)) < p["min_samples_leaf"]:
                    continue
                purity = 0.0
                for s in sides:
                    a, c = b.w[s][b.y[s] > 0.5].sum(), b.w[s][b.y[s] < 0.5].sum()
                    purity += (a * a + c * c) / (a + c)
                found.append((purity, f, t, *sides))
        if not found:
            return share
        top = max(c[0] for c in found)
        best = next(c for c in found if c[0] >= top - 1e-10 * abs(top))
        return (best[1], best[2], grow(best[3], 2 * number, depth + 1), grow(best[4], 2 * number + 1, depth + 1))

    return grow(np.arange(len(b.x)), 1, 0)


def nested(model, node):
    if model["feature"][node] < 0:
        return float(model["value"][node])
    left = model["left"][node]
    return (int(model["feature"][node]), float(model["threshold"][node]), nested(model, left), nested(model, left + 1))


def close(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return a == pytest.approx(b, abs=1e-9)
    return a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-12) and close(a[2], b[2]) and close(a[3], b[3])


@pytest.mark.parametrize("leaf, depth, kind", [(1, 20, "sqrt"), (4, 5, "log2"), (1, 1, "sqrt")])
def test_extra_trees_by_brute_force(leaf, depth, kind):
    b, p = sample(), {"n_estimators": 12, "max_depth": depth, "min_samples_leaf": leaf, "max_features": kind}
    model = C.answered(T.extra_trees(6, p, 5), b)
    for tree in range(12):
        assert close(nested(model, model["roots"][tree]), plain_extra_tree(b, tree, 6, p, 5))
    one = T.leaves(model, b.x)
    assert (np.bincount(one.ravel(), minlength=len(model["feature"]))[model["feature"] < 0] >= leaf).all()
    assert model["cover"][model["roots"]] == pytest.approx(np.full(12, b.w.sum()))


def plain_boosting(b, edges, p, seed, d):
    """Scores after all stages, each stage's tree grown node by node."""
    f = np.full(len(b.x), np.log(b.y.mean() / (1 - b.y.mean())))
    for stage in range(p["n_estimators"]):
        q = 1 / (1 + np.exp(-f))
        drawn = np.flatnonzero((T.uniform(seed + 3, stage, b.key) < p["subsample"]) | (p["subsample"] >= 1))
        r, step = b.y - q, np.zeros(len(b.x))

        def grow(rows, member, depth):
            found = []
            for k in range(d):
                for t in edges[k][np.isfinite(edges[k])]:
                    left = rows[b.x[rows, k] <= t]
                    if depth < p["max_depth"] and 0 < len(left) < len(rows):
                        right = rows[b.x[rows, k] > t]
                        g = r[left].sum() ** 2 / len(left) + r[right].sum() ** 2 / len(right) - r[rows].sum() ** 2 / len(rows)
                        found.append((g, k, t, left, right))
            top = max((c[0] for c in found), default=0.0)
            if top <= 1e-12:
                step[member] = p["learning_rate"] * r[rows].sum() / (q * (1 - q))[rows].sum()
                return
            _, k, t, left, right = next(c for c in found if c[0] >= top - 1e-10 * abs(top))
            grow(left, member[b.x[member, k] <= t], depth + 1)
            grow(right, member[b.x[member, k] > t], depth + 1)

        grow(drawn, np.arange(len(b.x)), 0)
        f = f + step
    return 1 / (1 + np.exp(-f))


@pytest.mark.parametrize("share", [1.0, 0.6])
def test_boosting_by_brute_force(share):
    b, p = sample(80, 4), {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3, "subsample": share}
    edges = None
    asks = T.bin_edges(4)
    ask = next(asks)
    try:
        while True:
            ask = asks.send(ask.of(b, **ask.args))
    except StopIteration as end:
        edges = end.value
    model = C.answered(T.boosting(4, p, 9), b)
    assert T.boosted_score(model, b.x) == pytest.approx(plain_boosting(b, edges, p, 9, 4), abs=1e-9)
    inner = model["feature"] >= 0
    assert (model["cover"][inner] == model["cover"][model["left"][inner]] + model["cover"][model["left"][inner] + 1]).all()


def auc(y, s):
    return np.mean([(a > c) + 0.5 * (a == c) for a in s[y > 0.5] for c in s[y < 0.5]])


@pytest.mark.parametrize("name, params", [
    ("ET", {"n_estimators": 60, "max_depth": 8, "min_samples_leaf": 2, "max_features": "sqrt"}),
    ("RF", {"n_estimators": 60, "max_depth": 8, "min_samples_leaf": 2, "max_features": "sqrt"}),
    ("GB", {"n_estimators": 40, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.8}),
    ("LR", {"C": 1.0, "penalty": "l1", "max_iter": 100}), ("SVM", {"C": 1.0, "gamma": 0.1, "max_iter": 2000})])
def test_models_learn(name, params):
    b, t = sample(300, seed=1), sample(300, seed=2)
    model = C.unpacked(C.packed(C.answered(PROGRAMS[name](6, params, 3), b)))
    assert auc(t.y, SCORERS[name](model, t.x)) > 0.85
    assert bool(model.get("converged", True))


def test_one_class_and_constant_features():
    b = sample(30)
    one = C.Block((0, 0), b.x, np.ones(30), np.ones(30), b.key)
    flat = C.Block((0, 0), np.ones((30, 6)), b.y, b.w, b.key)
    p = {"n_estimators": 3, "max_depth": 4, "min_samples_leaf": 1, "max_features": "sqrt", "learning_rate": 0.1, "subsample": 1.0, "C": 1.0,
         "penalty": "l2", "gamma": 0.5, "max_iter": 500}
    for name in PROGRAMS:
        for block in (one, flat):
            score = SCORERS[name](C.answered(PROGRAMS[name](6, p, 1), block), block.x)
            assert np.isfinite(score).all()
    assert (T.forest_score(C.answered(T.extra_trees(6, p, 1), one), b.x) == 1).all()


def objective(model, b, reg, penalty, loss):
    return (b.w * loss).sum() / b.w.sum() + reg * penalty(model["beta"][:-1])


@pytest.mark.parametrize("penalty, c", [("l1", 0.05), ("l1", 10.0), ("l2", 0.05), ("l2", 10.0)])
def test_logistic_against_spark(spark, penalty, c):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    b = sample()
    model = C.answered(L.logistic(6, {"C": c, "penalty": penalty, "max_iter": 200}, 1), b)
    reg = 1 / (c * b.w.sum())
    frame = spark.createDataFrame([(Vectors.dense(x), float(y), float(w)) for x, y, w in zip(b.x, b.y, b.w)], ["features", "label", "weight"])
    other = LogisticRegression(weightCol="weight", regParam=reg, elasticNetParam=float(penalty == "l1"), standardization=False, maxIter=1000, tol=1e-12).fit(frame)
    size = {"l1": lambda v: np.abs(v).sum(), "l2": lambda v: (v ** 2).sum() / 2}[penalty]

    def value(beta):
        margin = b.x @ beta[:-1] + beta[-1]
        return objective({"beta": beta}, b, reg, size, np.logaddexp(0, margin) - b.y * margin)

    assert bool(model["converged"])
    assert value(model["beta"]) <= value(np.append(other.coefficients.toArray(), other.intercept)) + 1e-9


def test_svm_is_the_hinge_optimum(spark):
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.linalg import Vectors
    b = sample()
    params = {"C": 1.0, "gamma": 0.2, "max_iter": 5000, "rff_dim": 16}
    model = C.answered(L.svm(6, params, 4), b)
    z, reg = L.fourier(b.x, 0.2, 16, 4), 1 / b.w.sum()
    frame = spark.createDataFrame([(Vectors.dense(x), float(y), float(w)) for x, y, w in zip(z, b.y, b.w)], ["features", "label", "weight"])
    other = LinearSVC(weightCol="weight", regParam=reg, standardization=False, maxIter=300, tol=1e-10).fit(frame)

    def value(beta):
        return objective({"beta": beta}, b, reg, lambda v: (v ** 2).sum() / 2, np.maximum(0, 1 - (2 * b.y - 1) * (z @ beta[:-1] + beta[-1])))

    assert bool(model["converged"])
    assert value(model["beta"]) <= value(np.append(other.coefficients.toArray(), other.intercept)) + 1e-6


def test_many_blocks_give_the_models_of_one(spark):
    """The same fits over one block in tasks and over many blocks in lockstep."""
    b = sample()
    rows = [(r, int(i), float(y), float(w), [float(v) for v in x]) for r in (0, 1) for i, y, w, x in zip(b.key, b.y, b.w, b.x) if r == 0 or i % 3]
    frame = spark.createDataFrame(rows, "repeat int, row_id long, label double, weight double, xs array<double>")
    params = {"ET": {"n_estimators": 5, "max_depth": 6, "min_samples_leaf": 2, "max_features": "sqrt", "mrmr_k": 4},
              "RF": {"n_estimators": 5, "max_depth": 4, "min_samples_leaf": 2, "max_features": "log2"},
              "GB": {"n_estimators": 4, "max_depth": 2, "learning_rate": 0.2, "subsample": 0.7},
              "LR": {"C": 0.5, "penalty": "l1", "max_iter": 100}}
    fits = spark.createDataFrame([(k, k % 2, m, json.dumps(params[m])) for k, m in enumerate(list(params) * 2)], "fit int, repeat int, program string, params string")
    got = []
    for size in (1000, 30):
        blocks = C.block_table(frame, ["repeat"], block_rows=size).checkpoint()
        models = C.fit_cells(blocks, fits, ["repeat"], PROGRAMS, seed=11)
        scores = C.score_cells(blocks, fits, models, ["repeat"], SCORERS).collect()
        got.append({(r.fit, r.repeat, r.row_id): r.score for r in scores})
    assert blocks.count() > 4 and len(got[0]) == sum(4 * (r[0] == 0) + 4 * (r[0] == 1) for r in rows)
    assert got[0] == pytest.approx(got[1], abs=1e-9)


@pytest.mark.parametrize("c, gamma", [(1.0, 0.01), (100.0, 1.0)])
def test_svm_asks_three_questions_a_step_at_most_where_it_descends(c, gamma):
    """The losses at the cuts of a refused step come in one answer."""
    b, asks = sample(400, 8, 5), 1
    program = L.svm(8, {"C": c, "gamma": gamma, "max_iter": 10_000}, 3)
    ask = next(program)
    while True:
        try:
            ask, asks = program.send(ask.of(b, **ask.args)), asks + 1
        except StopIteration as end:
            model = end.value
            break
    assert bool(model["converged"]) and asks <= 5 * int(model["steps"])
    # several points give the losses that each gives by itself
    points = np.random.default_rng(1).normal(size=(3, 9))
    assert L._logistic(b, points).tolist() == [L._logistic(b, p)[0] for p in points]
    points = np.random.default_rng(1).normal(size=(3, 33))
    args = {"width": 0.5, "gamma": 0.1, "out": 32, "seed": 3}
    assert L._rounded_hinge(b, points, **args).tolist() == [L._rounded_hinge(b, p, **args)[0] for p in points]


def test_a_block_is_sent_once_for_all_fits_of_its_cell(spark, monkeypatch):
    b, sent, totals = sample(90, 5, 2), [], C._totals
    rows = spark.createDataFrame([(k % 2, int(key), int(y), float(w), x.tolist()) for k, (key, y, w, x) in enumerate(zip(b.key, b.y, b.w, b.x))],
                                 "fold int, row_id long, label int, weight double, xs array<double>")
    blocks = C.block_table(rows, ["fold"], block_rows=15).checkpoint()
    params = [{"C": 1.0, "penalty": "l2", "max_iter": 100}, {"C": 0.1, "penalty": "l1", "max_iter": 100}, {"C": 9.0, "penalty": "l2", "max_iter": 2}]
    fits = spark.createDataFrame([(3 * f + k, f, "LR", json.dumps(p)) for f in range(2) for k, p in enumerate(params)], "fit int, fold int, program string, params string")
    monkeypatch.setattr(C, "_totals", lambda work, *more: (sent.append((work.count(), work.select("fold", "block").distinct().count())), totals(work, *more))[1])
    assert C.fit_cells(blocks, fits, ["fold"], PROGRAMS).count() == 6
    assert sent[0] == (blocks.count(),) * 2 and all(n == m for n, m in sent)


@pytest.mark.parametrize("name", ["ET", "RF"])
def test_a_forest_in_parts_is_the_forest(name, monkeypatch):
    """Trees grown a few at a time, from rows that are kept in the order of their nodes, and by questions that start at the roots."""
    b = sample(200, 6, 4)
    odd = C.Block(b.name, b.x, b.y, b.w * (1 + b.key % 3), b.key)  # the rows of a class weigh differently
    p = {"n_estimators": 7, "max_depth": 9, "min_samples_leaf": 1, "max_features": "sqrt"}
    for block in (b, odd):
        program, ask = PROGRAMS[name](6, p, 5), None
        try:
            ask = next(program)
            while True:
                ask = program.send(ask.of(block, **ask.args))
        except StopIteration as end:
            plain = end.value
        for members in (1, 3, 7):
            model = C.in_parts(PROGRAMS[name], 6, p, 5, block, members)
            assert all(close(nested(model, r), nested(plain, q)) for r, q in zip(model["roots"], plain["roots"]))
            assert model["cover"][model["roots"]] == pytest.approx(plain["cover"][plain["roots"]])
        part = C.in_parts(PROGRAMS[name], 6, {**p, "n_estimators": 2, "first": 4}, 5, block)
        assert all(close(nested(part, r), nested(plain, q)) for r, q in zip(part["roots"], plain["roots"][4:6]))
    monkeypatch.setattr(T, "ASKED", 10)  # the nodes of a level in several questions
    model = C.in_parts(PROGRAMS[name], 6, p, 5, odd)
    assert all(close(nested(model, r), nested(plain, q)) for r, q in zip(model["roots"], plain["roots"]))


def test_cells_that_a_task_can_hold_take_no_rounds(spark, monkeypatch):
    b = sample(90, 5, 2)
    rows = spark.createDataFrame([(k % 2, int(key), int(y), float(w), x.tolist()) for k, (key, y, w, x) in enumerate(zip(b.key, b.y, b.w, b.x))],
                                 "fold int, row_id long, label int, weight double, xs array<double>")
    blocks = C.block_table(rows, ["fold"], block_rows=15).checkpoint()
    params = {"ET": {"n_estimators": 9, "max_depth": 3, "min_samples_leaf": 2, "max_features": "sqrt", "mrmr_k": 4}, "LR": {"C": 1.0, "penalty": "l2", "max_iter": 100}}
    fits = spark.createDataFrame([(2 * f + k, f, m, json.dumps(params[m])) for f in range(2) for k, m in enumerate(params)], "fit int, fold int, program string, params string")
    get = lambda models: {(r.fit, r.row_id): r.score for r in C.score_cells(blocks, fits, models, ["fold"], SCORERS).collect()}
    far = get(C.fit_cells(blocks, fits, ["fold"], PROGRAMS).checkpoint())
    monkeypatch.setattr(C, "_totals", lambda *a: pytest.fail("a round over the blocks"))
    near = C.fit_cells(blocks, fits, ["fold"], PROGRAMS, whole=1 << 20).checkpoint()
    assert near.count() == 4 and get(near) == pytest.approx(far, abs=1e-9)
    parts = C.fit_cells(blocks, fits, ["fold"], PROGRAMS, whole=1 << 20, parted=True).checkpoint()
    assert parts.filter("fit % 2 = 0").groupBy("fit").sum("members").collect()[0][1] == 9 and parts.filter("fit % 2 = 0").count() > 2
    assert get(parts) == pytest.approx(get(near), abs=1e-12)


def test_losses_along_lines_are_those_of_the_points():
    """A question about cuts of a few steps goes through a block once for each step."""
    class Counted(np.ndarray):
        products = 0

        def __matmul__(self, other):
            Counted.products += 1
            return np.asarray(self) @ other

    b, rng = sample(150, 5, 6), np.random.default_rng(2)
    for of, size, args in ((L._logistic, 6, {}), (L._rounded_hinge, 33, {"width": 0.3, "gamma": 0.1, "out": 32, "seed": 3})):
        beta, directions = rng.normal(size=size), list(rng.normal(size=(3, size)))
        steps = [(k, 4.0 ** -j) for k in range(3) for j in range(5)]
        want = of(b, np.array([beta + length * directions[k] for k, length in steps]), **args)
        assert of(b, beta, along=(directions, steps), **args) == pytest.approx(want, rel=1e-12)
    Counted.products = 0
    assert len(list(L._margins(b, np.ones((4, 6)).view(Counted), np.ones(6), ([np.ones(6)] * 3, steps)))) == 15 and Counted.products == 4


def test_rows_without_label_keep_their_own_weight():
    """They have no class weight, and are counted on the left of a threshold with the weight that they have."""
    b, forest = sample(60, 4, 8), T.Forest(2)
    none = b.key % 4 == 0
    block = C.Block(b.name, b.x, np.where(none, np.nan, b.y), np.where(none, 1.0, 3 * b.w), b.key)
    model, sampled = {**forest.arrays(), "tree": forest.tree}, np.array([[0, 1], [2, 0]])
    want = T._left_sums(block, model, forest.roots, sampled, np.zeros((2, 2)))
    kept = C.Block(b.name, block.x, block.y, block.w, block.key, {})
    assert T._left_sums(kept, model, forest.roots, sampled, np.zeros((2, 2))) == pytest.approx(want, rel=1e-12) and T._plain_weights(kept) is None
