"""A worker's table of distinct words, filled for a whole slice of texts at a time."""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np

#: Words after which a table is emptied before it takes more; one slice's words are always held together.
LIMIT = 600_000


class Ragged:
    """Arrays of different lengths, one after another in one growing array."""

    def __init__(self, kind):
        self.flat, self.start, self.n = np.zeros(1 << 16, kind), np.zeros(1 << 14, np.int64), 0

    def clear(self) -> None:
        self.n = 0

    def extend(self, parts: list) -> None:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.append(np.fromiter(chain.from_iterable(parts), self.flat.dtype, int(sizes.sum())), sizes)

    def append(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        """len(sizes) more arrays, joined."""
        low = int(self.start[self.n])
        if self.n + len(sizes) >= len(self.start):
            self.start = np.concatenate([self.start, np.zeros(len(self.start) + len(sizes), np.int64)])
        if low + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) + len(flat), self.flat.dtype)])
        self.flat[low : low + len(flat)] = flat
        self.start[self.n + 1 : self.n + 1 + len(sizes)] = low + np.cumsum(sizes)
        self.n += len(sizes)

    def joined(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays numbered k joined, and where each of them ends."""
        n = self.start[k + 1] - self.start[k]
        ends = np.cumsum(n)
        at = np.repeat(self.start[k] - ends + n, n)
        at += np.arange(len(at))
        return self.flat[at], ends


class WordTable:
    """Numbers of distinct words; ``learn(words)`` is called for new ones, in order, ``forget()`` when it is emptied."""

    def __init__(self, learn, forget, limit: int | None = None):
        self.learn, self.forget, self.limit, self.at = learn, forget, limit, {}

    def numbers(self, words: list[str]) -> np.ndarray:
        k = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(k < 0)
        if len(missing):
            new = list(dict.fromkeys(map(words.__getitem__, missing.tolist())))
            if len(self.at) + len(new) > (self.limit or LIMIT) and self.at:
                self.at.clear()
                self.forget()
                return self.numbers(words)
            self.learn(new)
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            k[missing] = np.fromiter(map(self.at.__getitem__, map(words.__getitem__, missing.tolist())), np.int64, len(missing))
        return k
