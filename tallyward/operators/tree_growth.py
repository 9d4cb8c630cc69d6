"""Growing one regression tree from histograms: settings, losses, best splits, trees. Plain numpy over binned rows.

A row's codes are the numbers of its bins, shifted so that every feature has a range of codes of its own. A histogram holds for each node
and code the sums of gradients, Hessians and rows. The gradient is that of the loss downhill, the Hessian the row's weight.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np

from tallyward.functions import values as V

SUMS = 3  # gradient, Hessian, rows
LOSSES = ("squared_error", "absolute_error", "huber", "quantile")
_CHUNK = 1 << 18
#: Trees of at most this depth are walked by all rows at once.
SHALLOW = 10
#: Sums that the histograms of one level may hold at once; wider levels are looked at by parts.
WIDE = 1 << 23
#: How often a row is drawn at most for a tree of a forest.
_MOST_DRAWN = 64


@dataclass(frozen=True)
class Settings:
    """Settings of a boosted model. ``max_leaves`` grows the leaf of the greatest gain first, else trees grow level by level."""

    n_estimators: int = V.MODEL["n_estimators"]
    learning_rate: float = V.MODEL["learning_rate"]
    max_depth: int | None = V.MODEL["max_depth"]
    min_samples_leaf: int = V.MODEL["min_samples_leaf"]
    min_samples_split: int = V.MODEL["min_samples_split"]
    subsample: float = V.MODEL["subsample"]
    max_features: str | int | float | None = None
    random_state: int = V.MODEL["random_state"]
    loss: str = "squared_error"
    alpha: float = 0.9
    max_leaves: int | None = None
    min_child_weight: float = 0.0
    min_split_gain: float = 0.0
    reg_lambda: float = 0.0
    reg_alpha: float = 0.0
    n_iter_no_change: int | None = None
    tol: float = 1e-4
    bootstrap: bool = False  # a row counts as often as it is drawn, ``subsample`` times on average

    def __post_init__(self):
        if self.loss not in LOSSES:
            raise ValueError(f"unknown loss {self.loss}")
        if self.max_depth is None and self.max_leaves is None:
            raise ValueError("a tree needs a greatest depth or a greatest number of leaves")

    def tried(self, features: int) -> int:
        """How many features a split may choose from."""
        m = self.max_features
        if m is None or m == "all":
            return features
        if m == "sqrt":
            return max(1, int(features**0.5))
        if m == "log2":
            return max(1, int(np.log2(features)))
        return max(1, min(features, int(m * features) if isinstance(m, float) else m))

    def same_trees(self, features: int) -> Settings:
        """The settings that candidates share whose trees are the same, but for their number."""
        return replace(self, n_estimators=0, max_features=self.tried(features),
                       min_samples_split=max(self.min_samples_split, 2 * self.min_samples_leaf))


@dataclass
class Tree:
    """Nodes as arrays; a leaf has feature -1. A row with a code up to ``code`` goes left."""

    feature: np.ndarray
    code: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def depth(self) -> int:
        found, at = 0, np.zeros(1, np.int64)
        while len(at := at[self.feature[at] >= 0]):
            found, at = found + 1, np.concatenate([self.left[at], self.left[at] + 1])
        return found

    def leaves(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of every row; ``codes`` has a line a feature. The right child follows the left one."""
        n, steps = codes.shape[1], self.depth()
        if steps <= SHALLOW:
            # Every row takes every step; one that has reached its leaf stays there.
            inner, flat, base = self.feature >= 0, codes.ravel(), np.arange(n)
            offset = np.where(inner, self.feature, 0).astype(np.int64) * n
            code = np.where(inner, self.code, np.iinfo(np.int32).max)
            left = np.where(inner, self.left, np.arange(len(inner)))
            node = np.zeros(n, np.int64)
            for _ in range(steps):
                node = left[node] + (flat[offset[node] + base] > code[node])
            return node.astype(np.int32)
        node = np.zeros(n, np.int32)
        at = np.arange(n)
        while len(at):
            here = node[at]
            here = self.left[here] + (codes[self.feature[here], at] > self.code[here])
            node[at] = here
            at = at[self.feature[here] >= 0]
        return node


def spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    u = np.uint64
    x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
    return x ^ (x >> u(31))


def draws(digests: np.ndarray, random_state: int, tree: int) -> np.ndarray:
    """A number from 0 to 1 for each row; a tree is grown from those below its ``subsample``."""
    salt = np.uint64((random_state * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (spread(digests ^ salt) >> np.uint64(11)).astype(np.float64) * 2.0**-53


def in_sample(digests: np.ndarray, settings: Settings, tree: int) -> np.ndarray | None:
    """The rows that one tree is grown from, by their digests; None for all."""
    return None if settings.subsample >= 1 else draws(digests, settings.random_state, tree) < settings.subsample


def times_drawn(digests: np.ndarray, settings: Settings, tree: int) -> np.ndarray:
    """How often each row is drawn with replacement for one tree: Poisson numbers of mean ``subsample``, by their digests."""
    k = np.arange(_MOST_DRAWN)
    shares = np.exp(k * np.log(settings.subsample) - settings.subsample - np.cumsum(np.log(np.maximum(k, 1))))
    return np.searchsorted(np.cumsum(shares), draws(digests, settings.random_state, tree), "right")


def start_share(settings: Settings) -> float | None:
    """The quantile of the labels that a model begins with; None for their mean."""
    return {"squared_error": None, "absolute_error": 0.5, "huber": 0.5, "quantile": settings.alpha}[settings.loss]


def downhill(residual: np.ndarray, settings: Settings, delta: float) -> np.ndarray:
    """The negative gradient of the loss; ``delta`` is where Huber's loss turns linear."""
    if settings.loss == "squared_error":
        return residual
    if settings.loss == "absolute_error":
        return np.sign(residual)
    if settings.loss == "huber":
        return np.clip(residual, -delta, delta)
    return np.where(residual > 0, settings.alpha, settings.alpha - 1.0)


def loss_of(residual: np.ndarray, settings: Settings, delta: float) -> np.ndarray:
    size = np.abs(residual)
    if settings.loss == "squared_error":
        return residual * residual
    if settings.loss == "absolute_error":
        return size
    if settings.loss == "huber":
        return np.where(size <= delta, 0.5 * residual * residual, delta * (size - 0.5 * delta))
    return np.where(residual > 0, settings.alpha * residual, (settings.alpha - 1.0) * residual)


def histogram(codes: np.ndarray, slot: np.ndarray, gradient: np.ndarray, weight: np.ndarray | None, slots: int, total: int, counted: bool = True) -> np.ndarray:
    """Sums per slot and code (slots, total, SUMS) of rows that all lie in a slot. Without weights a Hessian is a row; unless ``counted`` a weight is so many rows."""
    features, n = codes.shape
    out = np.zeros((SUMS, slots * total))
    step = max(1, _CHUNK // max(n, 1))
    base = slot.astype(np.int64) * total
    for f in range(0, features, step):
        keys = (base + codes[f : f + step]).ravel()
        times = len(keys) // max(n, 1)
        out[0] += np.bincount(keys, np.tile(gradient, times) if times > 1 else gradient, slots * total)
        if counted:
            out[2] += np.bincount(keys, minlength=slots * total)
        if weight is not None:
            out[1] += np.bincount(keys, np.tile(weight, times) if times > 1 else weight, slots * total)
    if weight is None:
        out[1] = out[2]
    elif not counted:
        out[2] = out[1]
    return np.ascontiguousarray(out.reshape(SUMS, slots, total).transpose(1, 2, 0))


def _score(gradient: np.ndarray, hessian: np.ndarray, settings: Settings) -> np.ndarray:
    if settings.reg_alpha:
        gradient = np.sign(gradient) * np.maximum(np.abs(gradient) - settings.reg_alpha, 0)
    below = hessian + settings.reg_lambda
    return gradient * gradient / np.where(below > 0, below, np.inf)


def leaf_value(sums: np.ndarray, settings: Settings) -> np.ndarray:
    gradient, below = sums[..., 0], sums[..., 1] + settings.reg_lambda
    if settings.reg_alpha:
        gradient = np.sign(gradient) * np.maximum(np.abs(gradient) - settings.reg_alpha, 0)
    return gradient / np.where(below > 0, below, np.inf)


def best_splits(hist: np.ndarray, starts: np.ndarray, settings: Settings, allowed: np.ndarray | None = None):
    """Gain, code, left sums and sums of the best split of each node.

    ``starts`` are the first codes of the features, ``allowed`` (nodes, features) says which ones a node may use. Of equal gains that
    of the least code wins. A node that cannot be split has gain -inf.
    """
    ends = np.append(starts[1:], hist.shape[1])
    running = np.cumsum(hist, axis=1)
    before = np.where(starts[None, :, None] > 0, running[:, np.maximum(starts - 1, 0)], 0.0)
    left = running - np.repeat(before, ends - starts, axis=1)
    whole = running[:, ends[0] - 1]
    right = whole[:, None] - left
    ok = (left[..., 2] >= settings.min_samples_leaf) & (right[..., 2] >= settings.min_samples_leaf)
    if settings.min_child_weight > 0:
        ok &= (left[..., 1] >= settings.min_child_weight) & (right[..., 1] >= settings.min_child_weight)
    ok[:, ends - 1] = False
    if allowed is not None:
        ok &= np.repeat(allowed, ends - starts, axis=1)
    gain = _score(left[..., 0], left[..., 1], settings) + _score(right[..., 0], right[..., 1], settings)
    gain -= _score(whole[:, 0], whole[:, 1], settings)[:, None]
    gain = np.where(ok, gain, -np.inf)
    code = np.argmax(gain, axis=1)
    nodes = np.arange(len(hist))
    return gain[nodes, code], code, left[nodes, code], whole


class Stacked:
    """Trees of at most ``SHALLOW`` steps side by side, so that few rows walk down all of them in as many steps as down one."""

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.feature) for t in trees]
        self.roots = np.cumsum([0, *sizes[:-1]])[: len(trees), None]
        self.steps = max((t.depth() for t in trees), default=0)
        feature, code, left, self.value = (
            np.concatenate([np.zeros(0), *[getattr(t, c) for t in trees]]).astype(k) for c, k in (("feature", np.int64), ("code", np.int64), ("left", np.int64), ("value", np.float64)))
        inner = feature >= 0
        self.feature = np.where(inner, feature, 0)
        # One that has reached its leaf stays there.
        self.code = np.where(inner, code, np.iinfo(np.int64).max)
        self.left = np.where(inner, left + np.repeat(self.roots.ravel(), sizes), np.arange(len(inner)))

    def add_to(self, out: np.ndarray, codes: np.ndarray) -> None:
        """Add what the trees predict to ``out``, a tree after the other."""
        n, flat = codes.shape[1], codes.ravel()
        step = max(1, _CHUNK // max(len(self.roots), 1))
        for at in range(0, n, step):
            base = np.arange(at, min(at + step, n))
            node = np.repeat(self.roots, len(base), axis=1)
            for _ in range(self.steps):
                node = self.left.take(node) + (flat.take(self.feature.take(node) * n + base) > self.code.take(node))
            for value in self.value.take(node):
                out[at : at + step] += value


class Growth:
    """A tree while it grows. ``wanted`` names the nodes whose best splits are asked for, ``take`` goes on with them."""

    def __init__(self, settings: Settings, tree: int, starts: np.ndarray):
        self.settings, self.number, self.starts = settings, tree, starts
        self.feature, self.code, self.left = (np.full(1, -1, np.int32) for _ in range(3))
        self.gain, self.depth = np.zeros(1), np.zeros(1, np.int32)
        self.sums = np.zeros((1, SUMS))
        self.wanted = np.zeros(1, np.int64)
        self.waiting: dict[int, tuple] = {}
        self.split = np.zeros(0, np.int64)

    def allowed(self) -> np.ndarray | None:
        """The features that each wanted node may use, drawn by hash."""
        features = len(self.starts)
        tried = self.settings.tried(features)
        if tried >= features:
            return None
        seed = np.uint64((self.settings.random_state * 7_919 + self.number + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
        cells = self.wanted.astype(np.uint64)[:, None] * np.uint64(features) + np.arange(features, dtype=np.uint64)
        draws = spread(spread(cells + np.uint64(1)) ^ seed)
        return draws <= np.sort(draws, axis=1)[:, tried - 1 : tried]

    def take(self, gain: np.ndarray, code: np.ndarray, left: np.ndarray, whole: np.ndarray) -> None:
        """Split what is best; sets ``split``, the nodes that got children, and the next ``wanted`` nodes."""
        s = self.settings
        self.sums[self.wanted] = whole
        ok = (gain > max(s.min_split_gain, 1e-12)) & (whole[:, 2] >= s.min_samples_split)
        if s.max_depth is not None:
            ok &= self.depth[self.wanted] < s.max_depth
        if s.max_leaves is None:
            self._open(self.wanted[ok], gain[ok], code[ok], left[ok], whole[ok])
            return
        for node, *found in zip(self.wanted[ok].tolist(), gain[ok], code[ok], left[ok], whole[ok]):
            self.waiting[node] = tuple(found)
        leaves = (len(self.feature) + 1) // 2
        if not self.waiting or leaves >= s.max_leaves:
            self._open(self.wanted[:0], gain[:0], code[:0], left[:0], whole[:0])
            return
        node = min(self.waiting, key=lambda k: (-self.waiting[k][0], k))
        self._open(np.array([node]), *(np.array([x]) for x in self.waiting.pop(node)))

    def _open(self, nodes, gain, code, left, whole) -> None:
        s, k, n = self.settings, len(nodes), len(self.feature)
        self.split = nodes
        self.feature[nodes] = np.searchsorted(self.starts, code, "right") - 1
        self.code[nodes], self.gain[nodes] = code, gain
        self.left[nodes] = n + 2 * np.arange(k)
        new = np.full(2 * k, -1, np.int32)
        self.feature, self.code, self.left = (np.concatenate([x, new]) for x in (self.feature, self.code, self.left))
        self.gain = np.concatenate([self.gain, np.zeros(2 * k)])
        self.depth = np.concatenate([self.depth, np.repeat(self.depth[nodes] + 1, 2)])
        self.sums = np.concatenate([self.sums, np.stack([left, whole - left], axis=1).reshape(2 * k, SUMS)])
        children = np.arange(n, n + 2 * k)
        # Nodes that cannot be split any more are not asked for.
        open_ = self.sums[children, 2] >= max(s.min_samples_split, 2 * s.min_samples_leaf)
        if s.max_depth is not None:
            open_ &= self.depth[children] < s.max_depth
        if s.max_leaves is not None and (len(self.feature) + 1) // 2 >= s.max_leaves:
            open_[:] = False
        self.wanted = children[open_]
        if s.max_leaves is not None and not len(self.wanted) and self.waiting and (len(self.feature) + 1) // 2 < s.max_leaves and k:
            none = np.zeros(0)
            self.take(none, none.astype(np.int64), np.zeros((0, SUMS)), np.zeros((0, SUMS)))

    def partial(self) -> Tree:
        return Tree(self.feature, self.code, self.left, np.zeros(len(self.feature)), self.gain, self.sums[:, 2])

    def tree(self, values: np.ndarray | None = None) -> Tree:
        """The finished tree; its leaves hold ``values``, or those of the gradients, times the learning rate."""
        value = leaf_value(self.sums, self.settings) if values is None else values
        return Tree(self.feature, self.code, self.left, np.where(self.feature < 0, value, 0.0) * self.settings.learning_rate, self.gain, self.sums[:, 2])


class Ahead:
    """Splits of leaves that a leaf-wise growth may want later, so that one pass serves many of its steps.

    It holds a larger tree in which every waiting leaf is split already, and what a pass found for each of its nodes.
    """

    def __init__(self):
        self.feature, self.code, self.left = (np.full(1, -1, np.int32) for _ in range(3))
        self.wanted, self.place = np.zeros(1, np.int64), {0: 0}
        self.cells: dict[int, np.ndarray] = {}

    def partial(self) -> Tree:
        none = np.zeros(len(self.feature))
        return Tree(self.feature, self.code, self.left, none, none, none)

    def serve(self, growth: Growth, cells: np.ndarray, take) -> None:
        """Goes on with the growth as far as its nodes are known, then opens what a pass is to find; ``take`` is given (feature, node) cells."""
        self.cells.update(zip(self.wanted.tolist(), np.moveaxis(cells, 1, 0)))
        self.wanted = self.wanted[:0]
        while len(growth.wanted):
            self._follow(growth)
            known = [self.cells.get(self.place.get(node)) for node in growth.wanted.tolist()]
            if any(c is None for c in known):
                self._open(growth)
                return
            take(np.stack(known, axis=1))

    def _follow(self, growth: Growth) -> None:
        for node in np.flatnonzero(growth.feature >= 0).tolist():
            here = self.left[self.place[node]] if node in self.place else -1
            if here >= 0:
                self.place[int(growth.left[node])], self.place[int(growth.left[node]) + 1] = int(here), int(here) + 1

    def _open(self, growth: Growth) -> None:
        """Split the growth's inner nodes and waiting leaves here too."""
        inner = np.flatnonzero(growth.feature >= 0).tolist()
        codes = {node: int(growth.code[node]) for node in inner} | {node: int(found[1]) for node, found in growth.waiting.items()}
        new = {self.place[node]: code for node, code in codes.items() if node in self.place and self.left[self.place[node]] < 0}
        nodes, code, n = np.array(list(new), np.int64), np.array(list(new.values()), np.int64), len(self.feature)
        self.feature[nodes], self.code[nodes] = np.searchsorted(growth.starts, code, "right") - 1, code
        self.left[nodes] = n + 2 * np.arange(len(nodes))
        more = np.full(2 * len(nodes), -1, np.int32)
        self.feature, self.code, self.left = (np.concatenate([x, more]) for x in (self.feature, self.code, self.left))
        self.wanted = np.arange(n, n + 2 * len(nodes))


def leaf_quantiles(leaf: np.ndarray, values: np.ndarray, share: float, nodes: int) -> np.ndarray:
    """The quantile of the values in each leaf, between neighbours by linear interpolation (0 for none)."""
    order = np.lexsort((values, leaf))
    leaf, values = leaf[order], values[order]
    n = np.bincount(leaf, minlength=nodes)
    first = np.cumsum(n) - n
    at = np.maximum(n - 1, 0) * share
    low = np.floor(at).astype(np.int64)
    if not len(values):
        return np.zeros(nodes)
    a = values[np.minimum(first + low, len(values) - 1)]
    b = values[np.minimum(first + np.ceil(at).astype(np.int64), len(values) - 1)]
    return np.where(n > 0, a + (b - a) * (at - low), 0.0)


def huber_values(leaf: np.ndarray, residual: np.ndarray, median: np.ndarray, delta: float, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the clipped distances from the leaf's median, and rows; their ratio and the median make the leaf's value."""
    clipped = np.clip(residual - median[leaf], -delta, delta)
    return np.bincount(leaf, clipped, nodes), np.bincount(leaf, minlength=nodes)


class LocalRows:
    """Binned rows of one task, and the growth of trees from them."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, total: int, label: np.ndarray, weight: np.ndarray | None, digests: np.ndarray):
        self.codes, self.starts, self.total = codes, starts, total
        self.label, self.weight, self.digests = label, weight, digests

    def grow(self, settings: Settings, number: int, gradient: np.ndarray, used: np.ndarray) -> tuple[Growth, np.ndarray]:
        """A tree of the rows ``used``, and the node of every row. Of two children only the smaller one is counted, the other is the rest."""
        growth = Growth(settings, number, self.starts)
        node = np.zeros(len(gradient), np.int32)
        moved, flat = np.arange(len(gradient)), self.codes.ravel()
        hists = dict(zip([0], self._counted(moved[used], np.zeros(1, np.int64), node, gradient)))
        stack = hists[0][None]  # those of the wanted nodes, in order
        while len(growth.wanted):
            asked = growth.wanted
            if stack is None:
                growth.take(*self._best_by_parts(moved[used[moved]], asked, node, gradient, settings, growth.allowed()))
            else:
                growth.take(*best_splits(stack, self.starts, settings, growth.allowed()))
            split = growth.split
            if not len(split):
                continue
            moving = np.zeros(len(growth.feature), bool)
            moving[split] = True
            # Level by level the rows of finished leaves are done with; a leaf that waits may come up later.
            moved = moved[moving[node[moved]]] if settings.max_leaves is None else np.flatnonzero(moving[node])
            here = node[moved]
            node[moved] = growth.left[here] + (flat.take(growth.feature[here] * np.int64(len(node)) + moved) > growth.code[here])
            wanted = np.zeros(len(growth.feature), bool)
            wanted[growth.wanted] = True
            left = growth.left[split]
            either = wanted[left] | wanted[left + 1]
            parents, left = split[either], left[either]
            if stack is None or settings.max_leaves is None and 2 * len(left) * self.total * SUMS > WIDE:
                stack = None
                continue
            goes_left = growth.sums[left, 2] <= growth.sums[left + 1, 2]
            counted = self._counted(moved[used[moved]], np.where(goes_left, left, left + 1), node, gradient)
            if settings.max_leaves is None:
                above = stack[np.searchsorted(asked, parents)]
            else:
                above = np.stack([hists.pop(p) for p in parents.tolist()]) if len(parents) else stack[:0]
            pairs = np.empty((2 * len(left), *counted.shape[1:]))
            at = 2 * np.arange(len(left)) + ~goes_left
            pairs[at], pairs[at ^ 1] = counted, above - counted
            children = np.repeat(left, 2) + np.tile([0, 1], len(left))
            stack = pairs[wanted[children]]
            if settings.max_leaves is not None:
                hists.update(zip(growth.wanted.tolist(), stack))
        return growth, node

    def _counted(self, rows: np.ndarray, nodes: np.ndarray, node: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        place = np.full(max(int(node.max(initial=0)), int(nodes.max(initial=0))) + 1, -1, np.int32)
        place[nodes] = np.arange(len(nodes))
        slot = place[node[rows]]
        inside = slot >= 0
        return self._summed(rows[inside], slot[inside], gradient, len(nodes))

    def _best_by_parts(self, rows: np.ndarray, nodes: np.ndarray, node: np.ndarray, gradient: np.ndarray, settings: Settings, allowed: np.ndarray | None) -> list[np.ndarray]:
        """The best splits of the nodes of a wide level, whose histograms are counted and looked at some nodes at a time."""
        place = np.full(max(int(node.max(initial=0)), int(nodes.max())) + 1, -1, np.int64)
        place[nodes] = np.arange(len(nodes))
        slot = place[node[rows]]
        order = np.argsort(slot, kind="stable")
        rows, slot = rows[order], slot[order]
        step = max(1, WIDE // (self.total * SUMS))
        found = []
        for at in range(0, len(nodes), step):
            to = min(at + step, len(nodes))
            low, high = np.searchsorted(slot, [at, to])
            hist = self._summed(rows[low:high], slot[low:high] - at, gradient, to - at)
            found.append(best_splits(hist, self.starts, settings, None if allowed is None else allowed[at:to]))
        return [np.concatenate(x) for x in zip(*found)]

    def _summed(self, rows: np.ndarray, slot: np.ndarray, gradient: np.ndarray, slots: int) -> np.ndarray:
        weight = None if self.weight is None else self.weight[rows]
        return histogram(self.codes[:, rows], slot, gradient[rows] if weight is None else gradient[rows] * weight, weight, slots, self.total)

    def begin(self, settings: Settings, used: np.ndarray) -> float:
        share = start_share(settings)
        if share is None:
            return float(np.average(self.label[used], weights=None if self.weight is None else self.weight[used]))
        return float(leaf_quantiles(np.zeros(int(used.sum()), np.int64), self.label[used], share, 1)[0])

    def add_tree(self, settings: Settings, number: int, margin: np.ndarray, used: np.ndarray) -> tuple[Tree, float]:
        """One more tree for rows predicted as ``margin``, which is moved; also where Huber's loss turned."""
        sample = in_sample(self.digests, settings, number)
        used = used if sample is None else used & sample
        residual = self.label - margin
        delta = 0.0
        if settings.loss == "huber":
            delta = float(leaf_quantiles(np.zeros(int(used.sum()), np.int64), np.abs(residual[used]), settings.alpha, 1)[0])
        growth, node = self.grow(settings, number, downhill(residual, settings, delta), used)
        values, n = None, len(growth.feature)
        if settings.loss in ("absolute_error", "huber"):
            values = leaf_quantiles(node[used], residual[used], 0.5, n)
        elif settings.loss == "quantile":
            values = leaf_quantiles(node[used], residual[used], settings.alpha, n)
        if settings.loss == "huber":
            total, rows = huber_values(node[used], residual[used], values, delta, n)
            values = values + total / np.maximum(rows, 1)
        tree = growth.tree(values)
        margin += tree.value[node]
        return tree, delta


class LocalCells(LocalRows):
    """Cells, which stand for all rows that lie in the same bins: what is known of a cell are sums over its rows."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, total: int):
        super().__init__(codes, starts, total, np.zeros(0), None, np.zeros(0, np.uint64))
        self.counts, self._all = np.zeros(codes.shape[1]), np.ones(codes.shape[1], bool)

    def add_summed_tree(self, settings: Settings, number: int, margin: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Tree:
        """One more tree under the squared loss for cells predicted as ``margin``, which is moved, from the rows and the sums of labels in its sample."""
        self.counts = counts
        growth, node = self.grow(settings, number, labels - counts * margin, self._all)
        tree = growth.tree()
        # Level by level every cell has been moved to its leaf.
        margin += tree.value[node if settings.max_leaves is None else tree.leaves(self.codes)]
        return tree

    def _summed(self, rows: np.ndarray, slot: np.ndarray, gradient: np.ndarray, slots: int) -> np.ndarray:
        return histogram(self.codes[:, rows], slot, gradient[rows], self.counts[rows], slots, self.total, counted=False)
