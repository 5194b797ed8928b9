"""Order statistics of the slopes of all pairs of a long series, without making the pairs.

For a slope s the points are put in the order of y - s x. A pair whose slope is under s stands in that order against its x, so
the number of slopes under s is a number of inversions, counted in n log n steps. Bounds around a wanted rank are narrowed by such
counts, from the quantiles of sampled pairs on, until few slopes are left between them; these alone are made, as the pairs
that change order between the two bounds. Memory is a few arrays of the series' length and of ENUMERATED pairs.
"""

from __future__ import annotations

import numpy as np

#: Slopes between two bounds that are made at once; pairs sampled for the first bounds.
ENUMERATED = 1 << 21
SAMPLED = 200_000
#: Standard deviations of a sampled quantile between the first bounds and the rank.
SLACK = 5.0
#: Bounds nearer than this, of the slopes' scale, hold one slope many times over.
CLOSE = 1e-12
#: Halvings at most: more than doubles have between their ends.
STEPS = 2200


def inversions(ranks: np.ndarray, pairs: bool = False) -> int | tuple[np.ndarray, np.ndarray]:
    """The number of places i < j with ranks[i] > ranks[j] of a permutation, or these places.

    Ranks are split by their bits, the highest first. Ranks that agree in all higher bits stay together in their order, so
    an inversion shows in the one bit where its two ranks part: a 1 before a 0.
    """
    n = len(ranks)
    order, total, found = np.arange(n), 0, []
    for bit in range(max(n - 1, 0).bit_length() - 1, -1, -1):
        r = ranks[order]
        group, one = r >> (bit + 1), r >> bit & 1
        start = np.searchsorted(group, group)
        ones = np.concatenate([[0], np.cumsum(one)])
        before = ones[:-1] - ones[start]  # ones in the group before each place
        zero = np.flatnonzero(one == 0)
        total += int(before[zero].sum())
        if pairs:
            many = zero[before[zero] > 0]
            count = before[many]
            places = np.flatnonzero(one)
            first = ones[start[many]]  # among all ones, that of the group's first
            at = np.repeat(first, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            found.append((order[places[at]], np.repeat(order[many], count)))
        order = order[np.argsort(r >> bit, kind="stable")]
    if not pairs:
        return total
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *(a for a, _ in found)]), np.concatenate([empty, *(b for _, b in found)])


class PairSlopes:
    """The slopes of pairs of different x of points (x, y)."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        order = np.lexsort((y, x))
        self.x, self.y = x[order], y[order]
        n, same = len(x), np.unique(x, return_counts=True)[1]
        self.pairs = n * (n - 1) // 2 - int((same * (same - 1) // 2).sum())
        width = float(self.x[-1] - self.x[0]) if n else 0.0
        self.scale = float(self.y.max() - self.y.min()) / width if width else 0.0

    def heights(self, slope: float) -> np.ndarray:
        """Places of the points in the order of y - slope x."""
        if np.isinf(slope):
            order = np.lexsort((self.y, -np.sign(slope) * self.x))
        else:
            order = np.lexsort((self.x, self.y - slope * self.x))
        return order

    def below(self, slope: float) -> int:
        """The number of slopes under a slope."""
        if np.isinf(slope):
            return 0 if slope < 0 else self.pairs
        z = self.y - slope * self.x
        order = np.lexsort((z, self.x))
        ranks = np.empty(len(z), np.int64)
        ranks[np.argsort(z[order], kind="stable")] = np.arange(len(z))
        return inversions(ranks)

    def turned(self, low: float, high: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(x, y, ranks) of the points in their order at low, with their places in that at high."""
        order = self.heights(low)
        x, y = self.x[order], self.y[order]
        after = np.lexsort((np.arange(len(x)), y, -x)) if np.isinf(high) else np.argsort(y - high * x, kind="stable")
        ranks = np.empty(len(x), np.int64)
        ranks[after] = np.arange(len(x))
        return x, y, ranks

    def between(self, low: float, high: float) -> np.ndarray:
        """The slopes from low to under high."""
        x, y, ranks = self.turned(low, high)
        a, b = inversions(ranks, pairs=True)
        gap = x[b] - x[a]
        held = gap > 0
        return (y[b] - y[a])[held] / gap[held]

    def some_between(self, low: float, high: float) -> float:
        """One of the slopes from low to under high: of a point that another passes, and the lowest of those."""
        x, y, ranks = self.turned(low, high)
        later = np.minimum.accumulate(ranks[::-1])[::-1]
        a = int(np.argmax(ranks[:-1] > later[1:]))
        b = a + 1 + int(np.argmin(ranks[a + 1 :]))
        return float((y[b] - y[a]) / (x[b] - x[a]))

    def sampled(self) -> np.ndarray:
        """Slopes of pairs drawn at random, always the same ones, sorted."""
        i, j = np.random.default_rng(1).integers(0, len(self.x), (2, SAMPLED))
        gap = self.x[j] - self.x[i]
        held = gap != 0
        return np.sort((self.y[j] - self.y[i])[held] / gap[held])

    def ranked(self, ranks: list[int]) -> list[float]:
        """The slopes of the given ranks, from 0, among all in their order."""
        if not self.scale:  # one y
            return [0.0] * len(ranks)
        known = self.sampled()
        return [self.one(rank, known) for rank in ranks]

    def one(self, rank: int, known: np.ndarray) -> float:
        share, m = (rank + 0.5) / self.pairs, len(known)
        slack = SLACK * np.sqrt(share * (1 - share) * m) + SLACK
        first, last = int(np.floor(share * m - slack)), int(np.ceil(share * m + slack))
        low = known[first] - self.pad(known[first]) if first >= 0 else -np.inf
        high = known[last] + self.pad(known[last]) if last < m else np.inf
        under, over = self.below(low), self.below(high)
        if under > rank:
            low, under, high, over = -np.inf, 0, low, under
        elif over <= rank:
            low, under, high, over = high, over, np.inf, self.pairs
        for _ in range(STEPS):
            if over - under <= ENUMERATED:
                break
            if np.isfinite(high - low) and high - low <= 4 * self.pad(max(abs(low), abs(high))):
                return self.some_between(low, high)
            middle = self.middle(low, high)
            count = self.below(middle)
            if count <= rank:
                low, under = middle, count
            else:
                high, over = middle, count
        slopes = self.between(low, high)
        place = min(rank - under, len(slopes) - 1)
        return float(np.partition(slopes, place)[place])

    def pad(self, slope: float) -> float:
        return CLOSE * max(abs(slope), self.scale)

    def middle(self, low: float, high: float) -> float:
        if np.isinf(low) and np.isinf(high):
            return 0.0
        if np.isinf(low) or np.isinf(high):
            end = high if np.isinf(low) else low
            return end + (-1 if np.isinf(low) else 1) * 2 * max(abs(end), self.scale)
        return low + (high - low) / 2
