"""Counts over pairs of a sequence without listing the pairs: how many earlier entries are smaller, and slopes by rank.

Both go down the bits of the ranks: entries that agree in the upper bits are a group, and in each group the next bit tells
which of two is smaller. A level is a few passes of numpy, so n entries take n log n.
"""

from __future__ import annotations

import numpy as np

#: Points up to which all slopes are simply listed, which is faster there: at most 32,640 of them.
FEW = 256


def _next(seq: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bit, start of the group, ones before in the group, the sequence parted by the bit) of a sequence sorted by its bits over b."""
    bit = (seq >> b) & 1
    start = (seq >> (b + 1)) << (b + 1)
    ones = np.concatenate([[0], np.cumsum(bit)])
    before = ones[:-1] - ones[start]
    parted = np.empty_like(seq)
    parted[np.where(bit == 1, start + (1 << b) + before, np.arange(len(seq)) - before)] = seq
    return bit, start, before, parted


def smaller_before(rank: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each entry of a permutation of 0 to n - 1 the weights of earlier entries of smaller rank, added up."""
    rank = rank.astype(np.int64)
    by_rank, out = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
    by_rank[rank] = weight
    seq = rank
    for b in reversed(range(max(len(rank) - 1, 0).bit_length())):
        bit, start, _, parted = _next(seq, b)
        zeros = np.concatenate([[0], np.cumsum(np.where(bit == 0, by_rank[seq], 0))])
        out[seq] += np.where(bit == 1, zeros[:-1] - zeros[start], 0)
        seq = parted
    return out[rank]


def inversions(rank: np.ndarray) -> int:
    """Pairs of a permutation whose earlier entry is larger."""
    n = len(rank)
    return n * (n - 1) // 2 - int(smaller_before(rank, np.ones(n, dtype=np.int64)).sum())


def inverted_pairs(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (earlier, later) of all inverted pairs; as many as there are, so count them first."""
    seq = rank.astype(np.int64)
    place = np.empty(len(seq), dtype=np.int64)
    place[seq] = np.arange(len(seq))
    first, second = [], []
    for b in reversed(range(max(len(seq) - 1, 0).bit_length())):
        bit, start, before, parted = _next(seq, b)
        large, ones = seq[bit == 1], np.concatenate([[0], np.cumsum(bit)])
        zero = np.flatnonzero(bit == 0)
        k = before[zero]
        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        first.append(place[large[np.repeat(ones[start[zero]], k) + step]])
        second.append(place[np.repeat(seq[zero], k)])
        seq = parted
    return (np.concatenate(first), np.concatenate(second)) if first else (seq[:0], seq[:0])


def _ranks(key: np.ndarray) -> np.ndarray:
    out = np.empty(len(key), dtype=np.int64)
    out[np.argsort(key, kind="stable")] = np.arange(len(key))
    return out


def _slope_of_rank(x: np.ndarray, y: np.ndarray, k: int) -> float:
    """The slope with k smaller ones, of points in order of x, then y.

    A slope lies under t just where y - t x turns the pair round, so slopes under t are counted as inversions. Halving narrows t
    down until few slopes are between the bounds, which are listed, or none can be told from another.
    """
    n = len(x)
    u = x - (x[0] / 2 + x[-1] / 2)
    start = np.flatnonzero(np.concatenate([[True], np.diff(x) > 0]))
    end = np.concatenate([start[1:], [n]]) - 1
    run = x[start[1:]] - x[start[:-1]]
    low, high = float(((y[start[1:]] - y[end[:-1]]) / run).min()), float(((y[end[1:]] - y[start[:-1]]) / run).max())
    at_low, below_low = np.arange(n), 0
    at_high = np.empty(n, dtype=np.int64)
    at_high[np.lexsort((y, -x))] = np.arange(n)
    below_high = inversions(at_high)
    while below_high - below_low > 4 * n:
        middle = low / 2 + high / 2
        finest = np.spacing(np.abs(y).max() + max(abs(low), abs(high)) * u[-1]) / (x[-1] - x[0])
        if not low < middle < high or high - low <= finest:
            break
        ranks = _ranks(y - middle * u)
        below = inversions(ranks)
        if below <= k:
            low, at_low, below_low = middle, ranks, below
        else:
            high, at_high, below_high = middle, ranks, below
    line = np.argsort(at_low)
    turned = at_high[line]
    if below_high - below_low > 4 * n:  # all that is left is one slope; two neighbours that change places have it
        at = int(np.argmax(turned[:-1] > turned[1:]))
        i, j = line[at : at + 1], line[at + 1 : at + 2]
    else:
        i, j = (line[p] for p in inverted_pairs(turned))
    i, j = i[i < j], j[i < j]
    slopes = np.sort((y[j] - y[i]) / (x[j] - x[i]))
    return float(slopes[min(max(k - below_low, 0), len(slopes) - 1)]) if len(slopes) else low


def median_slope(x: np.ndarray, y: np.ndarray) -> float | None:
    """The median of the slopes of all pairs of points that differ in x; None without such a pair. Takes n log n, holds a few n."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    n = len(x)
    same = np.unique(x, return_counts=True)[1]
    pairs = n * (n - 1) // 2 - int((same * (same - 1) // 2).sum())
    if not pairs:
        return None
    if n <= FEW:
        i, j = np.triu_indices(n, 1)
        i, j = i[x[i] < x[j]], j[x[i] < x[j]]
        return float(np.median((y[j] - y[i]) / (x[j] - x[i])))
    low, high = (_slope_of_rank(x, y, k) for k in ((pairs - 1) // 2, pairs // 2))
    return low / 2 + high / 2
