"""Tree ensembles as fit programs (see ``cells``): extra-trees, random forest
and gradient boosting.

All trees of a forest grow level by level together.  An extra-trees level takes
two questions: the range of the sampled features in every open node, then the
class weights on the left of one random threshold for each.  Random forest and
boosting ask for histograms over ``BINS`` value bins instead.  Every random
choice is a hash of (seed, tree, node, feature) or (seed, tree, row key), so a
forest does not depend on how rows are dealt into blocks.

A forest is a set of flat arrays: ``feature`` (-1: a leaf), ``threshold`` (up to
it: left), ``left`` (the right child follows it), ``value``, ``cover`` (weight of
the fit rows there) and ``roots``.
"""
from __future__ import annotations

from collections import OrderedDict
from collections.abc import Generator

import numpy as np

from tessera.operators.cells import Ask, Block

BINS, FINE = 64, 2048
ASKED = 400_000   # (node, feature) candidates of one question
ITEMS = 2_000_000  # values that a task handles at once
PIECE = 65_536  # values of a histogram's piece


def uniform(seed: int, *parts) -> np.ndarray:
    """U[0, 1) from integers, elementwise (a chain of splitmix64 steps)."""
    h = np.uint64(seed) + np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ np.asarray(p, np.int64).astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
    return (h >> np.uint64(11)).astype(float) / float(1 << 53)


def sample_size(kind: str, d: int) -> int:
    return max(1, int(np.sqrt(d) if kind == "sqrt" else np.log2(d)))


class Forest:
    """Flat trees that grow at their open nodes."""

    def __init__(self, trees: int, first: int = 0):
        """``first``: the number of the first tree, where these are a part of a forest."""
        self.feature, self.threshold = np.full(trees, -1, np.int32), np.zeros(trees)
        self.left, self.tree, self.roots = np.zeros(trees, np.int32), np.arange(first, first + trees, dtype=np.int32), np.arange(trees)
        self.value, self.cover = np.zeros(trees), np.zeros(trees)

    def split(self, nodes: np.ndarray, feature: np.ndarray, threshold: np.ndarray) -> np.ndarray:
        """Give ``nodes`` two children each; return the left ones."""
        first = len(self.feature) + 2 * np.arange(len(nodes))
        self.feature[nodes], self.threshold[nodes], self.left[nodes] = feature, threshold, first
        more = 2 * len(nodes)
        self.feature = np.concatenate([self.feature, np.full(more, -1, np.int32)])
        self.left = np.concatenate([self.left, np.zeros(more, np.int32)])
        self.tree = np.concatenate([self.tree, np.repeat(self.tree[nodes], 2)])
        self.threshold, self.value, self.cover = (np.concatenate([a, np.zeros(more)]) for a in (self.threshold, self.value, self.cover))
        return first

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: getattr(self, k) for k in ("feature", "threshold", "left", "value", "cover", "roots")}


def leaves(model: dict[str, np.ndarray], x: np.ndarray, roots: np.ndarray | None = None) -> np.ndarray:
    """The node (rows x trees) where each row ends in each tree."""
    roots = model["roots"] if roots is None else roots
    at = np.broadcast_to(roots, (len(x), len(roots))).copy()
    feature, threshold, left = model["feature"], model["threshold"], model["left"]
    rows, columns = np.nonzero(feature[at] >= 0)
    while len(rows):
        node = at[rows, columns]
        node = left[node] + (x[rows, feature[node]] > threshold[node])
        at[rows, columns] = node
        inner = feature[node] >= 0
        rows, columns = rows[inner], columns[inner]
    return at


def forest_score(model: dict, x: np.ndarray) -> np.ndarray:
    """P(class 1): the mean over trees of the leaves' weighted share."""
    out, step = np.zeros(len(x)), max(1, ITEMS // max(1, len(model["roots"])))
    for lo in range(0, len(x), step):
        out[lo:lo + step] = model["value"][leaves(model, x[lo:lo + step])].mean(1)
    return out


def boosted_margin(model: dict, x: np.ndarray) -> np.ndarray:
    out, step = np.zeros(len(x)), max(1, ITEMS // max(1, len(model["roots"])))
    for lo in range(0, len(x), step):
        out[lo:lo + step] = model["value"][leaves(model, x[lo:lo + step])].sum(1)
    return float(model["base"]) + out


def boosted_score(model: dict, x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-boosted_margin(model, x)))


# ---------------------------------------------------------------- what blocks answer
def _items(block: Block, model: dict, nodes: np.ndarray, draws: np.ndarray | None):
    """Pieces of (row, position among ``nodes``, draw weight) of the rows that lie in open nodes."""
    if block.kept is not None:
        row, times, counts, _ = _kept_items(block, model, nodes, draws)
        yield row, np.repeat(np.arange(len(nodes)), counts), times
        return
    lookup = np.full(len(model["feature"]), -1, np.int64)
    lookup[nodes] = np.arange(len(nodes))
    first = model["tree"][0]
    trees = np.unique(model["tree"][nodes])
    step = max(1, ITEMS // max(1, 8 * len(block.x)))
    for lo in range(0, len(trees), step):
        own = trees[lo:lo + step]
        at = lookup[leaves(model, block.x, model["roots"][own - first])]
        row, column = np.nonzero(at >= 0)
        place = at[row, column]
        times = None
        if draws is not None:
            times = _poisson(uniform(int(draws), own[column], block.key[row]))
            row, place, times = row[times > 0], place[times > 0], times[times > 0]
        order = np.argsort(place, kind="stable")
        yield row[order], place[order], None if times is None else times[order]


def _values(block: Block, row: np.ndarray, feature: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``x`` at ``row`` of each node's ``feature``; columns lie together, as a node reads one."""
    if "flat" not in block.kept:
        block.kept["flat"] = np.ascontiguousarray(block.x.T).ravel()
    return block.kept["flat"].take(np.repeat(feature.astype(np.int64) * len(block.x), counts) + row)


def _kept_items(block: Block, model: dict, nodes: np.ndarray, draws: np.ndarray | None):
    """``row, times, counts, values``: the rows that lie in ``nodes`` (ascending), node
    after node, and how many lie in each; ``values`` keeps what was looked up of them.

    Where one task answers all questions of a forest, it keeps the rows in the order
    of their nodes and deals those of a split node to its children, so that no row
    goes down from the root again."""
    kept, n = block.kept, len(block.x)
    if "nodes" not in kept:
        trees = len(model["roots"])
        row, times, counts = np.tile(np.arange(n), trees), None, np.full(trees, n)
        if draws is not None:
            times = _poisson(uniform(int(draws), np.repeat(model["tree"][:trees], n), block.key[row]))
            there = times > 0
            counts = there.reshape(trees, n).sum(1) if n else counts
            row, times = row[there], times[there]
        kept.update(nodes=model["roots"], row=row, times=times, counts=counts)
    ids, row, times, counts = (kept[k] for k in ("nodes", "row", "times", "counts"))
    while len(ids) and (model["feature"][ids] >= 0).any():  # nodes that were asked for and not split are leaves
        split = model["feature"][ids] >= 0
        if not split.all():
            use = np.repeat(split, counts)
            ids, row, times, counts = ids[split], row[use], None if times is None else times[use], counts[split]
        right = _values(block, row, model["feature"][ids], counts) > np.repeat(model["threshold"][ids], counts)
        start = np.cumsum(counts) - counts
        before = np.append(0, np.cumsum(right))  # rows that go right up to each place
        n_right = before[start + counts] - before[start]
        rank = before[:-1] - np.repeat(before[start], counts)
        at = np.where(right, np.repeat(start + counts - n_right, counts) + rank, np.arange(len(row)) - rank)
        moved = np.empty_like(row)
        moved[at] = row
        if times is not None:
            drawn, times = times, np.empty_like(times)
            times[at] = drawn
        ids = np.stack([model["left"][ids], model["left"][ids] + 1], 1).ravel()
        row, counts = moved, np.stack([counts - n_right, n_right], 1).ravel()
        kept.update(nodes=ids, row=row, times=times, counts=counts)
        kept.pop("asked", None)
    asked = kept.get("asked")
    if asked is None or not np.array_equal(asked[0], nodes):
        wanted = np.isin(ids, nodes)
        if wanted.all():
            asked = (nodes, row, times, counts, {})
        else:
            use = np.repeat(wanted, counts)
            asked = (nodes, row[use], None if times is None else times[use], counts[wanted], {})
        kept["asked"] = asked
    return asked[1:]


def _plain_weights(block: Block) -> tuple[float, float] | None:
    """The weights of the two classes, if all rows of a class weigh the same (rows
    without a label stand with the negative ones here, and have a weight of their own)."""
    if "weights" not in block.kept:
        sides = [block.w[~(block.y > 0.5)], block.w[block.y > 0.5]]
        same = all(not len(s) or (s == s[0]).all() for s in sides)
        block.kept["weights"] = tuple(float(s[0]) if len(s) else 0.0 for s in sides) if same else None
    return block.kept["weights"]


def _poisson(u: np.ndarray) -> np.ndarray:
    """Poisson(1) numbers by inversion: how often a row is drawn with replacement."""
    return np.searchsorted(np.cumsum(np.exp(-1.0) / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320.0])), u, side="right")


def _class_sums(block: Block, model: dict, nodes: np.ndarray, draws) -> np.ndarray:
    """``w0, w1, n`` of each node."""
    out = np.zeros((len(nodes), 3))
    for row, place, times in _items(block, model, nodes, draws):
        t = np.ones(len(row)) if times is None else times.astype(float)
        for c, v in enumerate((block.w[row] * t * (block.y[row] <= 0.5), block.w[row] * t * (block.y[row] > 0.5), t)):
            out[:, c] += np.bincount(place, v, len(nodes))
    return out.ravel()


def _ranges(block: Block, model: dict, nodes: np.ndarray, sampled: np.ndarray) -> np.ndarray:
    """Least value and least negated value of the sampled features of each node."""
    out = np.full((2, *sampled.shape), np.inf)
    if block.kept is not None:
        row, _, counts, values = _kept_items(block, model, nodes, None)
        first, there = (np.cumsum(counts) - counts)[counts > 0], counts > 0
        for c in range(sampled.shape[1] if len(row) else 0):
            v = values[c] = _values(block, row, sampled[:, c], counts)
            out[0, there, c], out[1, there, c] = np.minimum.reduceat(v, first), -np.maximum.reduceat(v, first)
        return out.ravel()
    for row, place, _ in _items(block, model, nodes, None):
        if len(row):
            first = np.flatnonzero(np.diff(place, prepend=-1))
            own = place[first]
            for c in range(sampled.shape[1]):
                v = block.x[row, sampled[place, c]]
                out[0, own, c] = np.minimum(out[0, own, c], np.minimum.reduceat(v, first))
                out[1, own, c] = np.minimum(out[1, own, c], np.minimum.reduceat(-v, first))
    return out.ravel()


def _left_sums(block: Block, model: dict, nodes: np.ndarray, sampled: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """``w0, w1, n`` on the left of each candidate threshold."""
    out = np.zeros((3, *sampled.shape))
    weights = None if block.kept is None else _plain_weights(block)
    if weights is not None:
        row, _, counts, values = _kept_items(block, model, nodes, None)
        cell = 2 * np.repeat(np.arange(len(nodes)), counts) + (block.y > 0.5)[row]
        for c in range(sampled.shape[1]):
            v = values.pop(c, None)
            v = _values(block, row, sampled[:, c], counts) if v is None else v
            n = np.bincount(cell[v <= np.repeat(threshold[:, c], counts)], minlength=2 * len(nodes)).reshape(-1, 2)
            out[0, :, c], out[1, :, c], out[2, :, c] = n[:, 0] * weights[0], n[:, 1] * weights[1], n.sum(1)
        return out.ravel()
    for row, place, _ in _items(block, model, nodes, None):
        positive, w = block.y[row] > 0.5, block.w[row]
        for c in range(sampled.shape[1]):
            goes = block.x[row, sampled[place, c]] <= threshold[place, c]
            p = place[goes]
            out[0, :, c] += np.bincount(p, (w * ~positive)[goes], len(nodes))
            out[1, :, c] += np.bincount(p, (w * positive)[goes], len(nodes))
            out[2, :, c] += np.bincount(p, minlength=len(nodes))
    return out.ravel()


def _extent(block: Block) -> np.ndarray:
    x = np.arcsinh(block.x)
    return np.concatenate([x.min(0), (-x).min(0)]) if len(x) else np.full(2 * x.shape[1], np.inf)


def _fine_counts(block: Block, lo: np.ndarray, width: np.ndarray) -> np.ndarray:
    code = np.clip(((np.arcsinh(block.x) - lo) / width).astype(np.int64), 0, FINE - 1)
    return np.bincount((code + FINE * np.arange(code.shape[1])).ravel(), minlength=FINE * code.shape[1]).astype(float)


def bin_edges(d: int, bins: int = BINS) -> Generator[Ask, np.ndarray, np.ndarray]:
    """Up to ``bins - 1`` edges of every feature (features x edges, the rest
    infinite), near its quantiles: from counts in ``FINE`` equal steps of arsinh x."""
    extent = yield Ask(_extent, least=True)
    lo, hi = extent[:d], -extent[d:]
    width = np.where(hi > lo, (hi - lo) / FINE, 1.0)
    counts = (yield Ask(_fine_counts, {"lo": lo, "width": width})).reshape(d, FINE)
    edges = np.full((d, bins - 1), np.inf)
    for f in range(d):
        share = counts[f].cumsum() / max(1.0, counts[f].sum())
        at = np.unique(np.searchsorted(share, np.arange(1, bins) / bins))
        at = at[share[np.minimum(at, FINE - 1)] < 1]
        edges[f, :len(at)] = np.sinh(lo[f] + (at + 1) * width[f])
    return edges


_CODES: OrderedDict = OrderedDict()


def _codes(block: Block, edges: np.ndarray) -> np.ndarray:
    """Bins of a block's values (up to edge b: bin b or less); the last few blocks' are kept."""
    name = (block.name, block.x.shape, block.key.tobytes(), edges.tobytes())
    if name not in _CODES:
        _CODES[name] = np.stack([np.searchsorted(edges[f], block.x[:, f]) for f in range(block.x.shape[1])], 1) if len(block.x) else np.zeros(block.x.shape, np.int64)
        if len(_CODES) > 16:
            _CODES.popitem(last=False)
    return _CODES[name]


def _class_histogram(block: Block, model: dict, nodes: np.ndarray, sampled: np.ndarray, edges: np.ndarray, draws) -> np.ndarray:
    """``w0, w1, n`` of each (node, sampled feature, bin)."""
    codes, bins = _codes(block, edges), edges.shape[1] + 1
    size = sampled.size * bins
    out = np.zeros((3, size))
    weights = None if block.kept is None else _plain_weights(block)
    if weights is not None:
        row, times, counts, _ = _kept_items(block, model, nodes, draws)
        flat, m = codes.ravel(), sampled.shape[1]
        node, base, side = np.repeat(np.arange(len(nodes)), counts) * (m * bins), row * codes.shape[1], (block.y > 0.5)[row] * size
        n = np.zeros(2 * size)
        for c in range(m):
            n += np.bincount(flat.take(base + np.repeat(sampled[:, c], counts)) + node + side + c * bins, times, 2 * size)
        n = n.reshape(2, size)
        out[0], out[1], out[2] = n[0] * weights[0], n[1] * weights[1], n.sum(0)
        return out.ravel()
    for row, place, times in _items(block, model, nodes, draws):
        t = np.ones(len(row)) if times is None else times.astype(float)
        positive, w = block.y[row] > 0.5, block.w[row] * t
        for c in range(sampled.shape[1]):
            cell = (place * sampled.shape[1] + c) * bins + codes[row, sampled[place, c]]
            for k, v in enumerate((w * ~positive, w * positive, t)):
                out[k] += np.bincount(cell, v, size)
    return out.ravel()


# ---------------------------------------------------------------- forests
def _sampled(seed: int, forest: Forest, nodes: np.ndarray, order: np.ndarray, d: int, m: int) -> np.ndarray:
    """``m`` distinct features of each node: those of the least hashes.  A node is
    known by its tree and its number there."""
    u = uniform(seed, forest.tree[nodes][:, None], order[:, None], np.arange(d)[None])
    return np.argsort(u, axis=1, kind="stable")[:, :m]


def _gain(left: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Sum over both children of (w0^2 + w1^2) / w: the larger, the purer (Gini)."""
    right = node - left
    total = lambda s: s[0] + s[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        return (left[0] ** 2 + left[1] ** 2) / total(left) + (right[0] ** 2 + right[1] ** 2) / total(right)


def _first_best(gain: np.ndarray) -> np.ndarray:
    """Per row the first of the largest; what differs by rounding only is equal."""
    top = gain.max(1, keepdims=True)
    return (gain >= top - 1e-10 * np.where(np.isfinite(top), np.abs(top), 0)).argmax(1)


def _forest(d: int, params: dict, seed: int, random_thresholds: bool) -> Generator[Ask, np.ndarray, dict]:
    trees, depth, leaf = int(params["n_estimators"]), int(params["max_depth"]), int(params["min_samples_leaf"])
    m = sample_size(params["max_features"], d)
    draws = None if random_thresholds else np.int64(seed + 1)
    edges = None if random_thresholds else (yield from bin_edges(d))
    forest = Forest(trees, int(params.get("first", 0)))
    state = lambda: {**forest.arrays(), "tree": forest.tree}
    sums = (yield Ask(_class_sums, {"model": state(), "nodes": forest.roots, "draws": draws})).reshape(-1, 3)
    nodes, order = forest.roots, np.ones(trees, np.int64)  # order: root 1, children 2k and 2k + 1
    for level in range(depth + 1):
        weight = sums[:, 0] + sums[:, 1]
        forest.value[nodes] = np.divide(sums[:, 1], weight, out=np.full(len(nodes), 0.5), where=weight > 0)
        forest.cover[nodes] = weight
        keep = (sums[:, 0] > 0) & (sums[:, 1] > 0) & (sums[:, 2] >= max(2, 2 * leaf))
        nodes, order, sums = nodes[keep], order[keep], sums[keep]
        if level == depth or not len(nodes):
            break
        found = []
        size = max(1, ASKED // (m if random_thresholds else m * BINS))
        for lo in range(0, len(nodes), size):
            own, places, total = nodes[lo:lo + size], order[lo:lo + size], sums[lo:lo + size].T
            sampled = _sampled(seed, forest, own, places, d, m)
            if random_thresholds:
                low, high = (yield Ask(_ranges, {"model": state(), "nodes": own, "sampled": sampled}, least=True)).reshape(2, len(own), m)
                high = -high
                spread = high > low
                u = uniform(seed + 2, forest.tree[own][:, None], places[:, None], sampled)
                with np.errstate(invalid="ignore"):
                    threshold = np.where(spread, np.minimum(low + u * (high - low), np.nextafter(high, -np.inf)), np.inf)
                left = (yield Ask(_left_sums, {"model": state(), "nodes": own, "sampled": sampled, "threshold": threshold})).reshape(3, len(own), m)
            else:
                h = (yield Ask(_class_histogram, {"model": state(), "nodes": own, "sampled": sampled, "edges": edges, "draws": draws})).reshape(3, len(own), m, BINS)
                left = h.cumsum(3)[..., :-1].reshape(3, len(own), -1)
                threshold = edges[sampled].reshape(len(own), -1)
                spread = np.isfinite(threshold)
            whole = total[:, :, None]
            valid = spread & (left[2] >= max(1, leaf)) & (whole[2] - left[2] >= max(1, leaf))
            gain = np.where(valid, _gain(left, whole), -np.inf)
            best = _first_best(gain)  # in the order of sampling
            rows = np.arange(len(own))
            ok = valid[rows, best]
            feature = sampled[rows, best if random_thresholds else best // (BINS - 1)]
            found.append((own[ok], places[ok], feature[ok], threshold[rows, best][ok], left[:, rows, best].T[ok], total.T[ok]))
        own, places, feature, threshold, left, total = (np.concatenate(v) for v in zip(*found))
        if not len(own):
            break
        first = forest.split(own, feature, threshold)
        nodes = np.stack([first, first + 1], 1).ravel()
        order = np.stack([2 * places, 2 * places + 1], 1).ravel()
        sums = np.stack([left, total - left], 1).reshape(-1, 3)
        sums[:, :2][sums[:, :2] < 1e-10 * np.repeat(total[:, :2].sum(1), 2)[:, None]] = 0  # what the difference leaves of a class that is not there
    return forest.arrays()


def extra_trees(d: int, params: dict, seed: int):
    """M4.  All rows for each tree; in a node, one uniform threshold for each of
    the sampled features, and the best of them by Gini.  A node whose sampled
    features are all constant is a leaf.  Up to 2**62 nodes a path (depth 20 is
    the deepest of the search space)."""
    return _forest(d, params, seed, True)


extra_trees.members = "n_estimators"  # trees are independent: a part (``first``, so many) may grow by itself


def random_forest(d: int, params: dict, seed: int):
    """M3.  Rows drawn with replacement (Poisson numbers by tree and row key) and
    the best edge of the sampled features by Gini."""
    return _forest(d, params, seed, False)


random_forest.members = "n_estimators"


# ---------------------------------------------------------------- boosting
_MARGINS: OrderedDict = OrderedDict()


def _margin(block: Block, model: dict, run: int) -> np.ndarray:
    """Margins under the trees so far.  A process keeps those of the last blocks
    and adds the trees that are new to it; a lost process starts again."""
    name = (run, block.name)
    done, margin = _MARGINS.pop(name, (0, np.full(len(block.x), float(model["base"]))))
    roots = model["roots"]
    if done < len(roots):
        margin = margin + model["value"][leaves(model, block.x, roots[done:])].sum(1)
    _MARGINS[name] = (len(roots), margin)
    if len(_MARGINS) > 64:
        _MARGINS.popitem(last=False)
    return margin


def _stage_rows(block: Block, stage: int, seed: int, share: float) -> np.ndarray:
    return np.ones(len(block.x), bool) if share >= 1 else uniform(seed + 3, stage, block.key) < share


def _node_sums(block: Block, model: dict, tree: dict, nodes, stage, seed, share, run, edges, features: bool) -> np.ndarray:
    """Of each open node of the growing tree: rows, residuals and curvature; or
    rows and residuals by (feature, bin)."""
    if block.kept is not None:
        return _kept_node_sums(block, model, tree, nodes, stage, seed, share, edges, features)
    margin = _margin(block, model, run)
    p = 1.0 / (1.0 + np.exp(-margin))
    lookup = np.full(len(tree["feature"]), -1, np.int64)
    lookup[nodes] = np.arange(len(nodes))
    place = lookup[leaves(tree, block.x)[:, 0]]
    row = np.flatnonzero((place >= 0) & _stage_rows(block, stage, seed, share))
    place, residual = place[row], (block.y - p)[row]
    if not features:
        return np.concatenate([np.bincount(place, v, len(nodes)) for v in (np.ones(len(row)), residual, (p * (1 - p))[row])])
    codes, bins, d = _codes(block, edges)[row], edges.shape[1] + 1, block.x.shape[1]
    cell = ((place * d)[:, None] + np.arange(d)) * bins + codes
    size = len(nodes) * d * bins
    return np.concatenate([np.bincount(cell.ravel(), minlength=size), np.bincount(cell.ravel(), np.repeat(residual, d), size)]).astype(float)


def _kept_node_sums(block: Block, model: dict, tree: dict, nodes, stage, seed, share, edges, features: bool) -> np.ndarray:
    """``_node_sums`` where one task answers all questions of a fit: it keeps the
    margins, the node of each row, and the bins with their places in a node's histogram."""
    kept, d = block.kept, block.x.shape[1]
    if kept.get("stage") != stage:
        if "margin" not in kept:
            kept["margin"] = np.full(len(block.x), float(model["base"]))
        else:  # the leaves of the tree before
            kept["margin"] = kept["margin"] + model["value"][model["roots"][-1] + kept["at"]]
        p = 1.0 / (1.0 + np.exp(-kept["margin"]))
        kept.update(stage=stage, at=np.zeros(len(block.x), np.int64), p=p, residual=block.y - p, drawn=np.flatnonzero(_stage_rows(block, stage, seed, share)))
    at = kept["at"]
    while True:
        moves = np.flatnonzero(tree["feature"][at] >= 0)
        if not len(moves):
            break
        node = at[moves]
        at[moves] = tree["left"][node] + (block.x[moves, tree["feature"][node]] > tree["threshold"][node])
    lookup = np.full(len(tree["feature"]), -1, np.int64)
    lookup[nodes] = np.arange(len(nodes))
    row = kept["drawn"]
    place = lookup[at[row]]
    if (place < 0).any():
        row, place = row[place >= 0], place[place >= 0]
    residual = kept["residual"][row]
    if not features:
        p = kept["p"][row]
        return np.concatenate([np.bincount(place, v, len(nodes)) for v in (np.ones(len(row)), residual, p * (1 - p))])
    bins = edges.shape[1] + 1
    step = max(1, PIECE // max(1, len(block.x)))  # features at once: a piece that stays in the cache
    if "bins" not in kept:
        kept["bins"] = np.ascontiguousarray((_codes(block, edges) + np.arange(d) % step * bins).T)  # feature by feature
    out = np.empty((2, len(nodes), d, bins))
    for lo in range(0, d, step):
        width = min(step, d - lo)
        cell = (kept["bins"][lo:lo + width].take(row, 1) + place * (width * bins)).ravel()
        for k, v in enumerate((None, np.tile(residual, width))):
            out[k, :, lo:lo + width] = np.bincount(cell, v, len(nodes) * width * bins).reshape(len(nodes), width, bins)
    return out.ravel()


def _label_counts(block: Block) -> np.ndarray:
    return np.array([len(block.y), (block.y > 0.5).sum()], float)


def boosting(d: int, params: dict, seed: int) -> Generator[Ask, np.ndarray, dict]:
    """M5.  Stages of regression trees on the residuals of the logistic loss,
    leaves by one Newton step, no class weights.  A stage draws rows by (stage,
    row key); it takes one question for each level, and one for its leaves."""
    stages, rate, depth, share = int(params["n_estimators"]), float(params["learning_rate"]), int(params["max_depth"]), float(params["subsample"])
    run = int(uniform(seed, np.random.default_rng().integers(1 << 40)) * (1 << 52))  # names this fit's kept margins
    n, positive = yield Ask(_label_counts)
    odds = min(max(positive / max(n, 1.0), 1e-9), 1 - 1e-9)
    edges = yield from bin_edges(d)
    done = {k: [] for k in ("feature", "threshold", "left", "value", "cover")}
    roots, nodes_so_far = [], 0

    def model():
        own = {k: np.concatenate(v) if v else np.zeros(0, np.int32 if k in ("feature", "left") else float) for k, v in done.items()}
        return {**own, "roots": np.array(roots, np.int64), "base": np.float64(np.log(odds / (1 - odds)))}

    for stage in range(stages):
        sofar, tree = model(), Forest(1)
        common = {"model": sofar, "stage": stage, "seed": seed, "share": share, "run": run}
        nodes = tree.roots
        for _ in range(depth):
            h = yield Ask(_node_sums, {**common, "tree": tree.arrays(), "nodes": nodes, "edges": edges, "features": True})
            count, residual = h.reshape(2, len(nodes), d, BINS)
            left_n, left_r = count.cumsum(2)[..., :-1], residual.cumsum(2)[..., :-1]
            total_n, total_r = count.sum(2)[:, :, None], residual.sum(2)[:, :, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = left_r ** 2 / left_n + (total_r - left_r) ** 2 / (total_n - left_n) - total_r ** 2 / total_n
            gain = np.where((left_n >= 1) & (total_n - left_n >= 1) & np.isfinite(edges)[None], gain, -np.inf).reshape(len(nodes), -1)
            best = _first_best(gain)
            ok = gain[np.arange(len(nodes)), best] > 1e-12
            if not ok.any():
                break
            feature, at = best[ok] // (BINS - 1), best[ok] % (BINS - 1)
            first = tree.split(nodes[ok], feature, edges[feature, at])
            nodes = np.stack([first, first + 1], 1).ravel()
        ends = np.flatnonzero(tree.feature < 0)
        count, residual, curve = (yield Ask(_node_sums, {**common, "tree": tree.arrays(), "nodes": ends, "edges": None, "features": False})).reshape(3, len(ends))
        tree.value[ends] = rate * np.divide(residual, curve, out=np.zeros(len(ends)), where=curve > 1e-150)
        tree.cover[ends] = count
        for node in range(len(tree.feature) - 1, -1, -1):  # children follow their parent
            if tree.feature[node] >= 0:
                tree.cover[node] = tree.cover[tree.left[node]] + tree.cover[tree.left[node] + 1]
        for k in done:
            done[k].append(getattr(tree, k) + (nodes_so_far if k == "left" else 0))
        roots.append(nodes_so_far)
        nodes_so_far += len(tree.feature)
    return model()
