"""Logistic regression and the RBF support-vector machine as fit programs (see
``cells``): one question a step, loss with gradient and curvature at one point.
Where the whole step is refused, one more question has the losses at its cuts
under several dampings (points on a few lines from where it stands, so that a
block is gone through once for each line, not for each point), and a third the
sums at the first that descends.

Objective, as in Spark ML: ``mean weighted loss + reg * penalty`` with
``reg = 1 / (C * sum of weights)`` and an unpenalised intercept.

* L2: Newton steps with halving.
* L1: Newton steps whose quadratic model is minimised by coordinate descent with
  soft thresholds.
* Hinge loss: Newton steps on the hinge rounded off over a width that shrinks
  from 1 to ``ROUND``; the optimum found is within ``ROUND / 2`` of the hinge's.

``converged`` says that the last step met the tolerance before ``max_iter``.
"""
from __future__ import annotations

from collections import OrderedDict
from collections.abc import Generator
from functools import lru_cache

import numpy as np

from tessera.operators.cells import Ask, Block

TOLERANCE, ROUND = 1e-9, 1e-6
SCALES, DAMPINGS = [4.0 ** -k for k in range(5)], 3  # cuts of a step, and dampings of one question
RFF_DIM = 256


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], 1)


@lru_cache(maxsize=8)
def fourier_weights(d: int, gamma: float, out: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random Fourier features for exp(-gamma |x - y|^2): W ~ N(0, 2 gamma), b ~ U[0, 2 pi)."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2.0 * gamma), (d, out)), rng.uniform(0, 2 * np.pi, out)


def fourier(x: np.ndarray, gamma: float, out: int, seed: int) -> np.ndarray:
    w, b = fourier_weights(x.shape[1], gamma, out, seed)
    return np.sqrt(2.0 / out) * np.cos(x @ w + b)


def _sums(loss: np.ndarray, slope: np.ndarray, curve: np.ndarray, x: np.ndarray) -> np.ndarray:
    bent = np.flatnonzero(curve)  # few rows of a hinge have curvature
    return np.concatenate([[loss.sum()], x.T @ slope, ((x[bent] * curve[bent, None]).T @ x[bent]).ravel()])


def _margins(block: Block, x: np.ndarray, beta: np.ndarray, along: tuple | None):
    """``x @ b`` of points: the rows of ``beta``, or, with ``along`` (directions, and
    the direction and length of every step), where those steps from ``beta`` end."""
    if along is None:
        return (x @ b for b in beta)
    directions, steps = along
    start, lines = x @ beta, [x @ v for v in directions]
    return (start + length * lines[k] for k, length in steps)


def _logistic(block: Block, beta: np.ndarray, along: tuple | None = None) -> np.ndarray:
    """Sums at a point; of several points (``_margins``) their losses only."""
    x = _with_one(block.x)
    if beta.ndim > 1 or along:
        margins = _margins(block, x, beta, along)
        return np.array([(block.w * (np.logaddexp(0, m) - block.y * m)).sum() for m in margins])
    margin = x @ beta
    p = 1.0 / (1.0 + np.exp(-margin))
    loss = block.w * (np.logaddexp(0, margin) - block.y * margin)
    return _sums(loss, block.w * (p - block.y), block.w * p * (1 - p), x)


_MAPPED: OrderedDict = OrderedDict()


def _mapped(block: Block, gamma: float, out: int, seed: int) -> np.ndarray:
    """A block's Fourier features; those of the last few blocks are kept (a task that
    answers all questions of a fit keeps those of its one block)."""
    if block.kept is not None:
        if "mapped" not in block.kept:
            block.kept["mapped"] = _with_one(fourier(block.x, gamma, out, seed))
        return block.kept["mapped"]
    name = (block.name, block.x.shape, block.key.tobytes(), block.x[:1].tobytes(), gamma, out, seed)
    if name not in _MAPPED:
        _MAPPED[name] = _with_one(fourier(block.x, gamma, out, seed))
        if len(_MAPPED) > 4:
            _MAPPED.popitem(last=False)
    return _MAPPED[name]


def _rounded_hinge(block: Block, beta: np.ndarray, width: float, gamma: float, out: int, seed: int, along: tuple | None = None) -> np.ndarray:
    """max(0, 1 - m), a parabola where 1 - m is between 0 and ``width``: sums at a
    point; of several points (``_margins``) their losses only."""
    x = _mapped(block, gamma, out, seed)
    sign = 2 * block.y - 1

    def losses(margin):
        short = 1 - sign * margin
        inside = (short > 0) & (short < width)
        return short, inside, np.where(inside, short ** 2 / (2 * width), np.maximum(0, short - width / 2))

    if beta.ndim > 1 or along:
        return np.array([(block.w * losses(m)[2]).sum() for m in _margins(block, x, beta, along)])
    short, inside, loss = losses(x @ beta)
    slope = -sign * np.clip(short / width, 0, 1)
    return _sums(block.w * loss, block.w * slope, block.w * inside / width, x)


def _weight(block: Block) -> np.ndarray:
    return np.array([block.w.sum()])


def _direction(g: np.ndarray, h: np.ndarray, beta: np.ndarray, reg: float, l1: bool, damping: float) -> np.ndarray:
    """Step to the minimum of the quadratic model (L1: with the penalty in it)."""
    ridge = damping * max(1e-3, np.trace(h) / len(h))
    if not l1:
        return -np.linalg.solve(h + ridge * np.eye(len(h)), g)
    step, slope, diagonal = np.zeros(len(g)), g.copy(), h.diagonal() + ridge
    for _ in range(2000):
        worst = 0.0
        for k in range(len(g)):
            free = beta[k] + step[k] - slope[k] / diagonal[k]
            new = free if k == len(g) - 1 else np.sign(free) * max(abs(free) - reg / diagonal[k], 0.0)
            change = new - beta[k] - step[k]
            if change:
                step[k] += change
                slope += h[:, k] * change
                worst = max(worst, abs(change) * diagonal[k])
        if worst < 1e-13:
            break
    return step


def _descend(ask, d: int, reg: float, l1: bool, beta: np.ndarray, total: float, steps: int) -> Generator[Ask, np.ndarray, tuple]:
    """Newton steps from ``beta`` to the minimum; ``(beta, steps taken, converged)``."""
    penalty = lambda b: reg * (np.abs(b[:-1]).sum() if l1 else (b[:-1] ** 2).sum() / 2)

    def read(sums, b):
        g, h = sums[1:d + 2] / total, sums[d + 2:].reshape(d + 1, d + 1) / total
        if not l1:
            g, h = g + reg * np.append(b[:-1], 0), h + reg * np.diag(np.append(np.ones(d), 0))
        return sums[0] / total + penalty(b), g, h

    def tries(g, h, beta, value, damping):
        """Steps under ``DAMPINGS`` dampings from ``damping`` on, with the descent that each promises (none: it ends there)."""
        for _ in range(DAMPINGS):
            step = _direction(g, h, beta, reg, l1, damping)
            promised = g @ step + (penalty(beta + step) - penalty(beta) if l1 else 0.0)
            ends = -promised <= TOLERANCE * TOLERANCE + 1e-15 * abs(value)
            yield None if ends else step, promised
            damping *= 100
            if ends or damping > 1e6:
                return

    value, g, h = read((yield ask(beta)), beta)
    for taken in range(steps):
        damping, found, first = 1e-12, None, True
        while found is None:  # a step that has to be cut too far is taken again with more damping
            ladder = tries(g, h, beta, value, damping)
            step, promised = next(ladder)
            if step is None:
                return beta, taken, True
            if first:  # the whole step, with all its sums
                first, trial = False, beta + step
                new, new_g, new_h = read((yield ask(trial)), trial)
                if new <= value + 1e-4 * promised:
                    found = trial
                    break
                left = SCALES[1:]
            else:
                left = SCALES
            rungs = [(step, promised, left), *((s, p, SCALES) for s, p in ladder)]
            lines = [(s, p, scales) for s, p, scales in rungs if s is not None]
            points = [(scale, p, beta + scale * s) for s, p, scales in lines for scale in scales]
            along = [s for s, _, _ in lines], [(k, scale) for k, (_, _, scales) in enumerate(lines) for scale in scales]
            for loss, (scale, p, trial) in zip((yield ask(beta, along)), points):
                if loss / total + penalty(trial) <= value + 1e-4 * scale * p:
                    found = trial
                    new, new_g, new_h = read((yield ask(trial)), trial)
                    break
            else:
                if rungs[-1][0] is None:
                    return beta, taken, True
                for _ in rungs:
                    damping *= 100
                if damping > 1e6:  # no descent left in double precision
                    return beta, taken, -rungs[-1][1] <= 1e-9 * max(1.0, abs(value))
        beta, value, g, h = found, new, new_g, new_h
    return beta, steps, False


def logistic(d: int, params: dict, seed: int) -> Generator[Ask, np.ndarray, dict]:
    """M1."""
    total = float((yield Ask(_weight))[0])
    reg = 1.0 / (params["C"] * total)
    beta, steps, converged = yield from _descend(lambda b, along=None: Ask(_logistic, {"beta": b, "along": along}), d, reg, params["penalty"] == "l1", np.zeros(d + 1), total, int(params["max_iter"]))
    return {"beta": beta, "steps": np.int64(steps), "converged": np.bool_(converged)}


def svm(d: int, params: dict, seed: int) -> Generator[Ask, np.ndarray, dict]:
    """M2: hinge loss over random Fourier features (an approximation of the kernel)."""
    total = float((yield Ask(_weight))[0])
    gamma, out, left = float(params["gamma"]), int(params.get("rff_dim", RFF_DIM)), int(params["max_iter"])
    beta, width, converged = np.zeros(out + 1), 1.0, False
    while left > 0:
        ask = lambda b, along=None, width=width: Ask(_rounded_hinge, {"beta": b, "width": width, "gamma": gamma, "out": out, "seed": seed, "along": along})
        beta, steps, converged = yield from _descend(ask, out, 1.0 / (params["C"] * total), False, beta, total, left)
        left -= max(1, steps)
        if width <= ROUND:
            break
        width = max(ROUND, width / 4)
    return {"beta": beta, "gamma": np.float64(gamma), "out": np.int64(out), "seed": np.int64(seed),
            "steps": np.int64(int(params["max_iter"]) - left), "converged": np.bool_(converged and width <= ROUND)}


def logistic_score(model: dict, x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-(_with_one(x) @ model["beta"])))


def svm_margin(model: dict, x: np.ndarray) -> np.ndarray:
    return _with_one(fourier(x, float(model["gamma"]), int(model["out"]), int(model["seed"]))) @ model["beta"]
