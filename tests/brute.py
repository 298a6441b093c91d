"""Plain NumPy versions of the learners, written from the formulas, for small data only."""

from __future__ import annotations

import math

import numpy as np



def settled(gain, size):
    """Gains count above 1e-12 of their size and are compared as 24-bit numbers."""
    return float(np.float32(gain)) if gain > 1e-12 * size else 0.0


def node_gain(kind, left, right, lam, gamma):
    """(gain, what its parts add up to before they cancel out)."""
    if kind == "gini":
        def impurity(y):
            return 1 - sum((np.mean(y == c)) ** 2 for c in range(3))

        whole = np.concatenate([left, right])
        n = len(whole)
        return impurity(whole) - len(left) / n * impurity(left) - len(right) / n * impurity(right), 1.0
    if kind == "mse":
        share, a, b = len(left) * len(right) / (len(left) + len(right)) ** 2, left.mean(), right.mean()
        return share * (a - b) ** 2, 1e-10 * share * (abs(a) + abs(b)) ** 2

    def score(part):
        return part[:, 0].sum() ** 2 / (part[:, 1].sum() + lam)

    size = 0.5 * (score(left) + score(right))
    return size - 0.5 * score(np.concatenate([left, right])) - gamma, size


def search(kind, x, stat, lam=1.0, gamma=0.0, cut="observed", min_rows=1):
    """(gain, feature, threshold) of the best cut, or None."""
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for low, high in zip(values, values[1:]):
            left = x[:, f] <= low
            if left.sum() < min_rows or (~left).sum() < min_rows:
                continue
            gain = settled(*node_gain(kind, stat[left], stat[~left], lam, gamma))
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, f, low if cut == "observed" else (low + high) / 2)
    return best


def leaf(kind, stat, lam):
    if kind == "gini":
        counts = [int((stat == c).sum()) for c in range(3)]
        return float(counts.index(max(counts)))
    if kind == "mse":
        return float(stat.mean())
    return float(-stat[:, 0].sum() / (stat[:, 1].sum() + lam))


def depth_tree(kind, x, stat, depth, lam=1.0, gamma=0.0, cut="observed"):
    """A function from rows to values."""
    found = search(kind, x, stat, lam, gamma, cut) if depth > 0 else None
    if found is None:
        value = leaf(kind, stat, lam)
        return lambda rows: np.full(len(rows), value)
    _, f, point = found
    left = x[:, f] <= point
    low = depth_tree(kind, x[left], stat[left], depth - 1, lam, gamma, cut)
    high = depth_tree(kind, x[~left], stat[~left], depth - 1, lam, gamma, cut)

    def value(rows):
        out = np.empty(len(rows))
        goes = rows[:, f] <= point
        out[goes], out[~goes] = low(rows[goes]), high(rows[~goes])
        return out

    return value


def leaf_tree(x, stat, leaves, lam, min_rows):
    """Best-first growth; a list of (mask function chain, value)."""
    parts = [(np.ones(len(x), bool), [])]
    while len(parts) < leaves:
        options = []
        for order, (mask, _) in enumerate(parts):
            if mask.sum() < 2 * min_rows:
                continue
            found = search("newton", x[mask], stat[mask], lam, 0.0, "midpoint", min_rows)
            if found:
                options.append((-found[0], order, found))
        if not options:
            break
        _, order, (_, f, point) = min(options)
        mask, tests = parts.pop(order)
        parts += [
            (mask & (x[:, f] <= point), [*tests, (f, point, True)]),
            (mask & (x[:, f] > point), [*tests, (f, point, False)]),
        ]
    values = [(tests, leaf("newton", stat[mask], lam)) for mask, tests in parts]

    def value(rows):
        out = np.zeros(len(rows))
        for tests, v in values:
            inside = np.ones(len(rows), bool)
            for f, point, low in tests:
                inside &= (rows[:, f] <= point) == low
            out[inside] = v
        return out

    return value


def level_tree(x, stat, depth, lam, mode):
    node = np.zeros(len(x), int)
    cuts = []
    for _ in range(depth):
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for low, high in zip(values, values[1:]):
                gains = [(0.0, 0.0)]
                for k in np.unique(node):
                    rows = node == k
                    left = rows & (x[:, f] <= low)
                    right = rows & (x[:, f] > low)
                    owned = (x[rows, f] == low).any()
                    if left.any() and right.any() and (owned or mode == "sum"):
                        gains.append(node_gain("newton", stat[left], stat[right], lam, 0.0))
                gain = settled(*map(sum, zip(*gains))) if mode == "sum" else max(settled(*g) for g in gains)
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, f, (low + high) / 2)
        if best is None:
            break
        cuts.append(best[1:])
        node = node * 2 + (x[:, best[1]] > best[2])
    values = np.zeros(2 ** len(cuts))
    for k in range(len(values)):
        if (node == k).any():
            values[k] = leaf("newton", stat[node == k], lam)

    def value(rows):
        place = np.zeros(len(rows), int)
        for f, point in cuts:
            place = place * 2 + (rows[:, f] > point)
        return values[place]

    return value


def softmax(scores):
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def boost(params, x, y, rows):
    """Raw scores of ``rows`` after all rounds; no row sampling."""
    outputs = 3 if params.task == "class" else 1
    start = math.log(1 / 3) if params.task == "class" else float(np.mean(y))
    fitted, scored = np.full((len(x), outputs), start), np.full((len(rows), outputs), start)
    for _ in range(params.rounds):
        p = softmax(fitted) if outputs > 1 else None
        trees = []
        for k in range(outputs):
            if outputs > 1:
                g, h = p[:, k] - (y == k), np.maximum(p[:, k] * (1 - p[:, k]), 1e-6)
            else:
                g, h = fitted[:, 0] - y, np.ones(len(y))
            if params.kind == "mse":
                trees.append(depth_tree("mse", x, -g, params.max_depth, cut=params.cut))
                continue
            stat = np.column_stack([g, h])
            if params.growth == "depth":
                trees.append(depth_tree("newton", x, stat, params.max_depth, params.lam, params.gamma, params.cut))
            elif params.growth == "leaf":
                trees.append(leaf_tree(x, stat, params.num_leaves, params.lam, params.min_rows))
            else:
                trees.append(level_tree(x, stat, params.max_depth, params.lam, params.level_gain))
        for k, tree in enumerate(trees):
            fitted[:, k] += params.learning_rate * tree(x)
            scored[:, k] += params.learning_rate * tree(rows)
    return scored
