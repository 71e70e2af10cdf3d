"""A context tree as dense tables, to compare the one that is dealt out against."""

from __future__ import annotations

import numpy as np
import pandas as pd

from gridjobs.llm.ctw import END, decomposition, log_kt


class Tree:
    """Predictive tables of a context tree: child[state, column] is the next deeper context or -1, logs[state, column] log10 P.

    Each byte of the training texts has a column, by `code`; the last column stands for all other bytes, alike likely.
    """

    def __init__(self, cells: pd.DataFrame, depth: int):
        """cells: d, ctx, sym, n of the contexts to keep, d preceding bytes packed nearest first into ctx."""
        self.depth = depth
        seen = np.union1d([0], cells.loc[cells["d"] == 0, "sym"].to_numpy(int))  # zeros stand before texts
        self.code = np.full(256, len(seen), np.int32)
        self.code[seen] = np.arange(len(seen))
        self.other = -np.log10(max(1, 256 - len(seen)))
        wide = len(seen) + 1
        levels = []  # contexts, and their counts: context number, column, count
        for d in range(depth + 1):
            part = cells[cells["d"] == d].sort_values("ctx")
            ctx, row = np.unique(part["ctx"].to_numpy(np.int64), return_inverse=True)
            levels.append((ctx, row.astype(np.int32), self.code[part["sym"].to_numpy(int)], part["n"].to_numpy(float)))
        if not len(levels[0][0]):
            levels[0] = (np.zeros(1, np.int64), *levels[0][1:])

        def counts(d: int, a: int, b: int) -> np.ndarray:
            _, row, col, n = levels[d]
            own = slice(*np.searchsorted(row, [a, b]))
            out = np.zeros((b - a, wide))
            out[row[own] - a, col[own]] = n[own]
            return out

        self.zero, self.one = decomposition(counts(0, 0, 1)[0])
        sizes = [len(x[0]) for x in levels]
        start = np.cumsum([0, *sizes])
        self.child = np.full((start[-1], wide), -1, np.int32)
        up = [np.zeros(0, int)]  # of each context, in ascending order, the one above it
        for d in range(1, depth + 1):
            up.append(np.searchsorted(levels[d - 1][0], levels[d][0] >> 8))
            self.child[start[d - 1] + up[d], self.code[levels[d][0] & 255]] = start[d] + np.arange(sizes[d])
        blocks = lambda d: ((a, min(a + 2048, sizes[d])) for a in range(0, sizes[d], 2048))  # noqa: E731  few dense rows at a time

        def below_of(d: int, a: int, b: int) -> slice:
            return slice(*np.searchsorted(up[d + 1], [a, b])) if d < depth else slice(0, 0)

        def rest(d: int, a: int, b: int, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Zeros and ones of the continuations that have no context of their own."""
            under = below_of(d, a, b)
            count = count.copy()
            for i, j in ((i, min(i + 2048, under.stop)) for i in range(under.start, under.stop, 2048)):
                np.subtract.at(count, up[d + 1][i:j] - a, counts(d + 1, i, j))
            return count @ self.zero, count @ self.one

        # from the leaves: block probabilities, and the weight of stopping at each context
        self.logs, below = np.ones((start[-1], wide), np.float32), np.zeros((0, wide - 1))
        stop = [self.logs[i:j, :-1] for i, j in zip(start[:-1], start[1:], strict=True)]  # kept where the logs go later
        for d in range(depth, -1, -1):
            total = np.empty((sizes[d], wide - 1))
            for a, b in blocks(d):
                count, under = counts(d, a, b), below_of(d, a, b)
                own = log_kt(count @ self.zero, count @ self.one)
                total[a:b] = own
                if under.start < under.stop:
                    split = log_kt(*rest(d, a, b, count))
                    np.add.at(split, up[d + 1][under] - a, below[under])
                    parted = np.unique(up[d + 1][under]) - a
                    total[a:b][parted] = np.logaddexp(own[parted], split[parted]) - np.log(2)
                    stop[d][a:b][parted] = np.exp(own[parted] - np.log(2) - total[a:b][parted])
            below = total
        del below, total
        # from the root: what the contexts above have given, and the weight that is left
        given, left = np.zeros((1, wide - 1), np.float32), np.ones((1, wide - 1), np.float32)
        for d in range(depth + 1):
            at_given, at_left = given, left
            if d < depth:
                given, left = np.empty((sizes[d], wide - 1), np.float32), np.empty((sizes[d], wide - 1), np.float32)
            for a, b in blocks(d):
                above = up[d][a:b] if d else np.zeros(1, int)
                count = counts(d, a, b)
                z, o = count @ self.zero, count @ self.one
                so_far = at_given[above] + at_left[above] * stop[d][a:b] * ((o + 0.5) / (z + o + 1))
                open_ = at_left[above] * (1 - stop[d][a:b])
                z, o = rest(d, a, b, count)
                one = np.clip(so_far + open_ * ((o + 0.5) / (z + o + 1)), 1e-12, 1 - 1e-12)
                self.logs[start[d] + a : start[d] + b] = np.log10(1 - one) @ self.zero.T + np.log10(one) @ self.one.T
                if d < depth:
                    given[a:b], left[a:b] = so_far, open_

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text and its end."""
        pad = b"\0" * self.depth
        raw = self.code[np.frombuffer(b"".join([pad + t + END for t in texts]), np.uint8)]
        size = np.array([len(t) + self.depth + 1 for t in texts])
        first = np.cumsum(size) - size
        n, child, wide = len(raw) - self.depth, self.child.ravel(), self.child.shape[1]
        state, at = np.zeros(n, np.int32), np.arange(n)
        for d in range(1, self.depth + 1):
            nxt = child[state[at].astype(np.int64) * wide + raw[at + self.depth - d]]
            deeper = nxt >= 0
            at = at[deeper]
            state[at] = nxt[deeper]
        logs = np.zeros(len(raw))
        logs[self.depth :] = self.logs.ravel()[state.astype(np.int64) * wide + raw[self.depth :]] + np.where(raw[self.depth :] == wide - 1, self.other, 0.0)
        for i in range(self.depth):
            logs[first + i] = 0
        return np.add.reduceat(logs, first)
