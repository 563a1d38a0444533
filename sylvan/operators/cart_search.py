"""The exact split search of large class nodes over rows that several tasks hold.

Every task holds a share of the rows, and all take the same splits.  A level is two exchanges: class counts of each feature's bins, of
the smaller child only (the larger one's are what is left of the parent's), then the values of the few bins that may hold a
better threshold than the bins' ends.  What a level costs in rows is finding its children; nothing is sorted or written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Rows of a bin that are worth a finer bin, and bins of a node at most.
ROWS_A_BIN = 128
MOST_BINS = 1 << 16


class Feature:
    """One feature of a task's rows: the bin of each, and the values where a bin may hold several."""

    def __init__(self, x: np.ndarray, cuts: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.size = 1 << max(len(lo) - 1, 1).bit_length()
        pad = self.size - len(lo)
        self.lo, self.hi = np.r_[lo, np.full(pad, np.inf)], np.r_[hi, np.full(pad, -np.inf)]
        self.exact, self.top = not (self.lo < self.hi).any(), np.maximum.accumulate(self.hi)
        kind = np.uint8 if self.size <= 256 else np.uint16 if self.size <= 65536 else np.uint32
        self.code = np.searchsorted(cuts, x, side="left").astype(kind)
        self.x = None if self.exact else x
        self._several = {}

    def several(self, shift: int) -> np.ndarray:
        """Whether a bin holds several values, with ``2 ** shift`` bins made one."""
        if shift not in self._several:
            of = (self.size >> shift, -1)
            self._several[shift] = self.lo.reshape(of).min(axis=1) < self.hi.reshape(of).max(axis=1)
        return self._several[shift]

    def values(self, rows) -> np.ndarray:
        return self.lo[self.code[rows]] if self.exact else self.x[rows]

    def shift(self, n: int) -> int:
        """How much coarser the bins of a node of ``n`` rows are."""
        want, shift = min(n // ROWS_A_BIN, MOST_BINS), 0
        while not self.exact and self.size >> (shift + 1) >= max(want, 2):
            shift += 1
        return shift


def make_features(x: list[np.ndarray], n: int, max_bins: int, gather: Callable) -> list[Feature]:
    """Features of at most ``max_bins`` values get a bin for each, others bins of about as many rows.  Takes the columns out of ``x``."""
    out = []
    while x:
        v = x.pop(0)
        ordered = np.sort(v)
        cuts = _cut_points(ordered, n, max(max_bins, min(n // ROWS_A_BIN, MOST_BINS)), max_bins, gather)
        at = np.searchsorted(ordered, cuts, side="right")
        starts, stops = np.r_[0, at], np.r_[at, len(v)]
        some = starts < stops
        lo, hi = np.full(len(starts), np.inf), np.full(len(starts), -np.inf)
        lo[some], hi[some] = ordered[starts[some]], ordered[stops[some] - 1]
        del ordered
        parts = gather((lo, hi))
        out.append(Feature(v, cuts, np.minimum.reduce([p[0] for p in parts]), np.maximum.reduce([p[1] for p in parts])))
    return out


def _cut_points(v: np.ndarray, n: int, most: int, max_bins: int, gather: Callable) -> np.ndarray:
    """The highest values of the bins but the last, from every task's sorted values."""
    own = v[np.r_[True, v[1:] != v[:-1]]] if len(v) else v
    few = len(own) <= max_bins
    at = np.arange(1, most + 1) * len(v) // most - 1
    parts = gather((few, own if few else None, v[at[at >= 0]] if len(v) else v, len(v)))
    if all(p[0] for p in parts):
        own = np.unique(np.concatenate([p[1] for p in parts]))
        if len(own) <= max_bins:
            return own
    at = np.concatenate([p[2] for p in parts])
    weight = np.concatenate([np.full(len(p[2]), p[3] / max(len(p[2]), 1)) for p in parts])
    order = np.argsort(at, kind="stable")
    step = np.floor(np.cumsum(weight[order]) / (n / most) + 1e-9)
    return np.unique(at[order][np.flatnonzero(step[1:] != step[:-1])])


@dataclass
class Node:
    """A large node: its class counts, those of its bins by feature (``k`` rows of bins, ``2 ** shift`` of the feature's made one),
    and this task's rows."""

    id: int
    total: np.ndarray
    rows: np.ndarray
    bins: list[np.ndarray]
    shifts: list[int]

    @property
    def n(self) -> int:
        return int(self.total.sum())


def _rank(left: np.ndarray, nl: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The gain to 12 decimals, as ``grow`` has it."""
    n = total.sum()
    nr, sl, sr, parent = n - nl, 0.0, 0.0, 0.0
    for c, t in zip(left, total.astype(float)):
        c = c.astype(float)
        sl, sr, parent = sl + c * c, sr + (t - c) * (t - c), parent + t * t
    return np.round((sl / nl + sr / nr - parent / n) / n, 12)


def _scan(node: Node, features: list[Feature]):
    """The best of the bins' ends (rank, feature, its bin, the next one, class counts to the left), and by feature the bins
    that may hold a better one with the counts before them."""
    n, total = node.n, node.total
    best, states = None, []
    for j, (feature, h, shift) in enumerate(zip(features, node.bins, node.shifts)):
        size = h.sum(axis=0)
        used = np.flatnonzero(size)
        h, size = h[:, used], size[used]
        left, nl = np.cumsum(h, axis=1), np.cumsum(size)
        states.append((used, h, size, left, nl))
        if len(used) > 1:
            r = _rank(left[:, :-1], nl[:-1], total)
            at = int(r.argmax())
            if best is None or r[at] > best[0]:
                best = (r[at], j, int(used[at]), int(used[at + 1]), left[:, at])
    marked, least = [], -np.inf if best is None else best[0] - 1e-11
    for feature, shift, (used, h, size, left, nl) in zip(features, node.shifts, states):
        if feature.exact:
            marked.append(None)
            continue
        first, final, most = nl - size + 1.0, nl - 1.0, 0.0
        # with D the rows of a class left of a threshold less their share, the gain is the sum of D^2 / (nl nr)
        for c, own, t in zip(left, h, total):
            share = t / n
            start = c - own - (nl - size) * share
            low, high = start - share * (size - own), start + (1 - share) * own
            most = most + np.maximum(low * low, high * high)
        with np.errstate(divide="ignore", invalid="ignore"):
            bound = most / np.minimum(first * (n - first), final * (n - final))
        look = feature.several(shift)[used] & (size > 1) & ~(bound * (1 + 1e-9) < least)
        marked.append((used[look], (left - h)[:, look]) if look.any() else None)
    return best, marked


def _counts(values: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order and their class counts."""
    own, at = np.unique(values, return_inverse=True)
    return own, np.bincount(y * len(own) + at, minlength=k * len(own)).reshape(k, len(own))


def _look(node: Node, features: list[Feature], best, marked, y: np.ndarray, k: int):
    """This task's part of what the second exchange asks of a node."""
    found = []
    for j, look in enumerate(marked):
        if look is None:
            found.append(None)
            continue
        wanted = np.zeros(features[j].size >> node.shifts[j], bool)
        wanted[look[0]] = True
        rows = node.rows[wanted[features[j].code[node.rows] >> node.shifts[j]]]
        found.append(_counts(features[j].x[rows], y[rows].astype(np.int64), k))
    ends = None
    if best is not None and not features[best[1]].exact:
        code, x = features[best[1]].code[node.rows] >> node.shifts[best[1]], features[best[1]].x
        below, above = (x[node.rows[code == b]] for b in best[2:4])
        ends = (below.max(initial=-np.inf), above.min(initial=np.inf))
    return found, ends


def _choose(node: Node, features: list[Feature], best, marked, parts):
    """The split: feature, threshold, class counts to the left; None without a threshold."""
    top = None
    for j, look in enumerate(marked):
        if look is None:
            continue
        values = np.concatenate([found[j][0] for found, _ in parts])
        counts = np.concatenate([found[j][1] for found, _ in parts], axis=1)
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[:, order]
        starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        values, counts = values[starts], np.add.reduceat(counts, starts, axis=1)
        bins, before = look
        upper = features[j].top[((bins + 1) << node.shifts[j]) - 1]
        of = np.searchsorted(upper, values, side="left")
        run = np.cumsum(counts, axis=1)
        heads = np.searchsorted(of, np.arange(len(bins)), side="left")
        left = run - (run - counts)[:, heads][:, of] + before[:, of]
        i = np.flatnonzero(of[1:] == of[:-1])
        if not len(i):
            continue
        r = _rank(left[:, i], left[:, i].sum(axis=0), node.total)
        at = int(r.argmax())
        # a bin's end comes after the values within it
        if top is None or r[at] > top[0]:
            top = (r[at], j, bins[of[i[at]]], left[:, i[at]], values[i[at]], values[i[at] + 1])
    if best is not None and (top is None or (best[0], -best[1], -best[2]) > (top[0], -top[1], -top[2])):
        rank, j, b, after, left = best
        f = features[j]
        a, c = (f.lo[b], f.lo[after]) if f.exact else (max(e[0] for _, e in parts), min(e[1] for _, e in parts))
        top = (rank, j, b, left, a, c)
    if top is None:
        return None
    _, j, _, left, a, c = top
    with np.errstate(all="ignore"):
        mid = (a + c) / 2
    return j, float(mid if mid < c else a), left


def _binned(rows: np.ndarray, features: list[Feature], shifts: list[int], y: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The filled bins of each feature and their counts."""
    out, of = [], y[rows].astype(np.int64)
    for f, shift in zip(features, shifts):
        size = f.size >> shift
        key = of * size + (f.code[rows] >> shift)
        if len(key) * 4 < k * size:
            out.append(np.unique(key, return_counts=True))
        else:
            counts = np.bincount(key, minlength=k * size)
            filled = np.flatnonzero(counts)
            out.append((filled.astype(np.int32 if k * size < 1 << 31 else np.int64), counts[filled]))
    return out


def _summed(parts, j: int, size: int, k: int) -> np.ndarray:
    out = np.zeros(k * size, np.int64)
    for p in parts:
        out[p[j][0]] += p[j][1]
    return out.reshape(k, size)


def _coarser(h: np.ndarray, by: int) -> np.ndarray:
    return h.reshape(len(h), -1, 1 << by).sum(axis=2) if by else h


def split_large(x: list[np.ndarray], y: np.ndarray, k: int, limit: int, max_bins: int, max_depth: int | None = None,
                gather: Callable = lambda part: [part]) -> tuple[dict, dict, np.ndarray, int, list[Feature]]:
    """Splits every node of more than ``limit`` rows.  ``gather``: the parts of all tasks that hold rows, in one order.  The columns
    are taken out of ``x``.

    Returns the tree (its ends: feature -1), the values of the ends that are leaves, the end of each of this task's rows, the
    number of levels, and the features."""
    total = np.sum(gather(np.bincount(y, minlength=k)), axis=0)
    tree = {"feature": [-1], "threshold": [-1.0], "left": [-1], "depth": [0], "n": [int(total.sum())]}
    ends, leaves, depth = np.zeros(len(y), np.int32), {}, 0
    features = make_features(x, int(total.sum()), max_bins, gather)
    shifts = [f.shift(int(total.sum())) for f in features]
    rows = np.arange(len(y), dtype=np.int32)
    parts = gather(_binned(rows, features, shifts, y, k))
    live = [Node(0, total, rows, [_summed(parts, j, f.size >> s, k) for j, (f, s) in enumerate(zip(features, shifts))], shifts)]
    while live:
        last = max_depth is not None and depth >= max_depth
        scans = [(None, [None] * len(features)) if last or (node.total > 0).sum() < 2 else _scan(node, features) for node in live]
        asked = [i for i, (best, marked) in enumerate(scans)
                 if any(m is not None for m in marked) or best is not None and not features[best[1]].exact]
        answers = {}
        if asked:
            parts = gather([_look(live[i], features, *scans[i], y, k) for i in asked])
            answers = {i: [p[at] for p in parts] for at, i in enumerate(asked)}
        kept, sent, waiting = [], [], []
        for i, node in enumerate(live):
            split = _choose(node, features, *scans[i], answers.get(i, []))
            if split is None:
                leaves[node.id] = float(node.total.argmax())
                ends[node.rows] = node.id
                continue
            j, cut, left = split
            at = len(tree["left"])
            tree["feature"][node.id], tree["threshold"][node.id], tree["left"][node.id] = j, cut, at
            goes = features[j].values(node.rows) <= cut
            totals, of = (left, node.total - left), (node.rows[goes], node.rows[~goes])
            for name, v in (("feature", -1), ("threshold", -1.0), ("left", -1), ("depth", depth + 1)):
                tree[name] += [v, v]
            tree["n"] += [int(t.sum()) for t in totals]
            large = [side for side in (0, 1) if totals[side].sum() > limit]
            for side in (0, 1):
                if side not in large:
                    ends[of[side]] = at + side
            if large:
                small = int(totals[1].sum() < totals[0].sum())
                sent.append(_binned(of[small], features, node.shifts, y, k))
                waiting.append((node, at, totals, of, large, small))
            node.rows = None
        parts = gather(sent) if sent else []
        for place, (node, at, totals, of, large, small) in enumerate(waiting):
            own = [_summed([p[place] for p in parts], j, h.shape[1], k) for j, h in enumerate(node.bins)]
            for side in large:
                bins = own if side == small else [h - o for h, o in zip(node.bins, own)]
                shifts = [max(s, f.shift(int(totals[side].sum()))) for s, f in zip(node.shifts, features)]
                bins = [_coarser(h, new - s) for h, s, new in zip(bins, node.shifts, shifts)]
                kept.append(Node(at + side, totals[side], of[side], bins, shifts))
            node.bins = None
        live, depth = kept, depth + 1
    return tree, leaves, ends, depth, features
