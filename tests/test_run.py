"""The run's bookkeeping: fingerprints, resuming, refusals."""
import numpy as np
import pytest

from tessera.operators import models as MD
from tessera.plans import run as R


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(14):
        for k in range(6):
            y = g % 2
            rows.append((len(rows), f"g{g}", y, [float(v) for v in rng.normal(y * 1.5, 1, 4)]))
    return spark.createDataFrame(rows, "row_id int, patient_id string, label int, features array<double>").cache()


def test_missing_members_and_changed_inputs(spark, samples, tmp_path):
    with pytest.raises(ValueError, match="ET"):
        R.run_evaluation(spark, samples, R.RunConfig.smoke(models=("RF",)))
    cfg = R.RunConfig.smoke(models=("KNN",), ensemble_members=())
    mark = R.fingerprint(samples, cfg)
    assert mark == R.fingerprint(samples.repartition(3), cfg)
    assert mark != R.fingerprint(samples.filter("row_id > 0"), cfg) and mark != R.fingerprint(samples, R.RunConfig(models=("KNN",), ensemble_members=()))
    assert R._table(spark, f"{tmp_path}/none") is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception):
        R._table(spark, str(tmp_path / "broken")).count()


@pytest.fixture(scope="module")
def small_space():
    """The models' spaces with small forests and no random-feature bound, restored afterwards."""
    own = dict(MD.SEARCH_SPACE)
    for m in ("RF", "ET"):
        MD.SEARCH_SPACE[m] = {**own[m], "n_estimators": ("int", 10, 20, 10)}
    MD.SEARCH_SPACE["GB"] = {**own["GB"], "n_estimators": ("int", 5, 10, 5), "max_depth": ("int", 2, 3, 1)}
    yield
    MD.SEARCH_SPACE.update(own)


def test_whole_run_resumed(spark, samples, tmp_path, monkeypatch, small_space):
    """All six models and the ensemble; killed in the search and in the refits, then resumed."""
    cfg = R.RunConfig(n_repeats=2, n_trials=2, n_folds=2, out_dir=str(tmp_path))
    real, done = R.Run.scores, []

    def limited(self, step, model, tasks, roles):
        if (step, model) == stop:
            raise RuntimeError("killed")
        real(self, step, model, tasks, roles)
        done.append((step, model))

    monkeypatch.setattr(R.Run, "scores", limited)
    for stop in (("cv", "ET"), ("final", "SVM")):
        with pytest.raises(RuntimeError):
            R.run_evaluation(spark, samples, cfg)
    stop = None
    found = R.run_evaluation(spark, samples, cfg)
    metrics = {(r.model, r.repeat): r for r in found["metrics"].collect()}
    assert sorted(metrics) == sorted((m, r) for m in (*MD.MODELS, "Ensemble") for r in (0, 1))
    assert all(metrics[(m, r)].converged is True for m in ("LR", "SVM") for r in (0, 1))
    assert all(r.roc_auc is None or r.roc_auc > 0.6 for r in metrics.values())
    manifest = found["manifest"].first()
    log = spark.read.parquet(f"{manifest.run_dir}/log").collect()
    # each step is logged once, whichever attempt ended it; the manifest adds up all attempts
    assert sorted((r.step, r.model) for r in log) == sorted([("prepare", ""), ("evaluate", ""), *((s, m) for s in ("cv", "final") for m in MD.MODELS)])
    assert manifest.attempts == 3 and manifest.seconds == pytest.approx(sum(r.seconds for r in log), abs=1e-2)
    assert {r.fits for r in log if r.step == "cv"} == {8} and {r.fits for r in log if r.step == "final"} == {2}
    top = max(metrics.values(), key=lambda r: r.macro_f1)
    assert manifest.best_macro_f1 == top.macro_f1 and manifest.n_rows == 84 and 0 <= manifest.friedman_p <= 1
    # out-of-fold scores: each training row once for each model, trial and repeat
    cv = spark.read.parquet(f"{manifest.run_dir}/cv_scores")
    assert cv.groupBy("model", "trial", "repeat", "row_id").count().filter("count != 1").isEmpty()
    train = found["assignments"].filter("split = 'train'").join(samples, "patient_id").groupBy("repeat").count().collect()
    assert {(r.repeat, r["count"]) for r in train} == {(r.repeat, r["count"]) for r in cv.filter("model = 'ET' and trial = 0").groupBy("repeat").count().collect()}
    # the ensemble is the mean of its members at its own threshold
    allp = spark.read.parquet(f"{manifest.run_dir}/predictions").toPandas()
    wide = allp.pivot(index=["repeat", "role", "row_id"], columns="model", values="proba")
    assert np.allclose(wide["Ensemble"], wide[["RF", "ET", "GB"]].mean(axis=1))
    assert found["thresholds"].filter("model = 'Ensemble'").count() == 2
    # best trials: the mean macro-F1 over the folds, recomputed
    scores = cv.filter("model = 'ET' and repeat = 1").toPandas()
    means = {}
    for (trial, fold), g in scores.groupby(["trial", "fold"]):
        means.setdefault(trial, []).append(macro_f1(g.y_true.to_numpy(), (g.score >= 0.5).to_numpy().astype(int)))
    best = found["best_trials"].filter("model = 'ET' and repeat = 1").first()
    assert best.cv_macro_f1 == pytest.approx(max(np.mean(v) for v in means.values())) and best.trial == max(means, key=lambda t: (np.mean(means[t]), -t))
    assert "n_estimators" in best.params
    monkeypatch.setattr(R, "design_table", lambda *a: pytest.fail("a finished run computes no design"))
    assert {(r.model, r.repeat): r for r in R.run_evaluation(spark, samples, cfg)["metrics"].collect()} == metrics


def macro_f1(y, p):
    out = []
    for c in sorted(set(y) | set(p)):
        tp, fp, fn = ((p == c) & (y == c)).sum(), ((p == c) & (y != c)).sum(), ((p != c) & (y == c)).sum()
        out.append(2 * tp / (2 * tp + fp + fn) if tp else 0.0)
    return np.mean(out)


def test_registered_run_has_every_model(monkeypatch):
    from types import SimpleNamespace

    from tessera.plans import queries as Q

    seen = []

    def caught(spark, samples, cfg):
        seen.append(cfg)
        return {"metrics": None}

    monkeypatch.setattr(R, "run_evaluation", caught)
    monkeypatch.setattr(Q, "prep_inputs", lambda *a: (None, None, None))
    monkeypatch.setattr(Q, "round_doubles", lambda df: df)
    Q.REGISTRY["full_run"](SimpleNamespace(), "")
    assert seen[0].models == ("LR", "SVM", "RF", "ET", "GB", "KNN") and seen[0].ensemble_members == ("RF", "ET", "GB")
    assert (seen[0].n_repeats, seen[0].n_trials, seen[0].n_folds) == (2, 3, 3)


def test_knn_of_a_run_uses_every_training_row(spark, samples, tmp_path, monkeypatch):
    """Blocks of a few rows, and a bound on ``knn_scores`` that would show in the scores."""
    monkeypatch.setattr(MD.knn_scores, "__defaults__", tuple(10 if d == MD.KNN_TRAIN_ROWS else d for d in MD.knn_scores.__defaults__))
    cfg = R.RunConfig(n_repeats=1, n_trials=3, n_folds=2, models=("KNN",), ensemble_members=(), out_dir=str(tmp_path), block_rows=9)
    run = R.Run(spark, samples, cfg)
    run.prepare()
    run.search()
    design = {k: g for k, g in run.design.toPandas().groupby(["repeat", "fold"])}
    scores, seen = spark.read.parquet(f"{run.out}/cv_scores").toPandas(), 0
    assert run.fit_blocks.filter("blocks > 1").count() > 3
    for (trial, repeat, fold), g in scores.groupby(["trial", "repeat", "fold"]):
        p, own = run.params[("KNN", trial)], design[(repeat, fold)]
        fit = own[own.role == "fit"].sort_values("row_id")
        x, y, told = np.array([v[:p["mrmr_k"]] for v in fit["xs"]]), fit.label.to_numpy(float), own.set_index("row_id")
        for row_id, score in zip(g.row_id, g.score):
            apart = x - np.array(told["xs"][row_id])[:x.shape[1]]
            d = np.sqrt((apart ** 2).sum(1)) if p["metric"] == "euclidean" else np.abs(apart).sum(1)
            near = np.argsort(d, kind="stable")[:p["n_neighbors"]]
            w = np.ones(len(near)) if p["weights"] == "uniform" else 1 / d[near]
            assert score == pytest.approx((w * y[near]).sum() / w.sum(), abs=1e-12)
            seen += 1
    assert seen == len(scores) > 100
