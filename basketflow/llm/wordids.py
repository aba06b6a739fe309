"""A bounded per-task memory of the ids of words, and its vectorised lookup."""

from __future__ import annotations

from itertools import chain

import numpy as np

BLOCK = 20_000  # words encoded at a time


class _Slots(dict):
    """Number of every word; a word that is asked for first gets the next one
    and is listed in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class WordIds:
    """Ids of the distinct words seen by a task.

    ``encode_new`` maps a list of unseen words to their id sequences: all ids
    end to end, and the number of each word.  ``parts`` may name, by place in a
    list of words, two others whose ids end to end are the word's own; they are
    looked up like any word.  The memory is emptied when it holds ``limit``
    words, which only costs encoding words again."""

    def __init__(self, encode_new, limit: int = 800_000, parts=None):
        self.encode_new, self.limit, self.parts = encode_new, limit, parts
        self._reset()

    def _reset(self) -> None:
        self.slot = _Slots()
        self.start = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate((a, np.zeros(max(n - len(a), len(a)), a.dtype)))

    def _keep(self, at: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """Note the ids, end to end, of the words that have the slots ``at``."""
        n, total = len(self.slot), len(ids)
        self.start, self.size = self._room(self.start, n), self._room(self.size, n)
        self.ids = self._room(self.ids, self.used + total)
        self.start[at] = self.used + np.cumsum(size) - size
        self.size[at] = size
        self.ids[self.used:self.used + total] = ids
        self.used += total

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of the slots, end to end, and where each ends."""
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.start[at] - (ends - size), size) + np.arange(total)], ends

    def _learn(self) -> None:
        """Ids of the words that were asked for first."""
        new, self.slot.new = self.slot.new, []
        known = len(self.slot) - len(new)
        pairs = {}
        if self.parts is not None:
            pairs = self.parts(new)
            two = np.fromiter(map(self.slot.__getitem__, chain.from_iterable(pairs.values())), np.int64)
            new += self.slot.new  # parts that were not known
            self.slot.new = []
        whole = [k for k in range(len(new)) if k not in pairs]
        for i in range(0, len(whole), BLOCK):
            part = whole[i:i + BLOCK]
            ids, size = self.encode_new([new[k] for k in part])
            self._keep(np.array(part, np.int64) + known, ids, size)
        if pairs:
            ids, ends = self._gather(two)
            self._keep(np.fromiter(pairs, np.int64) + known, ids, np.diff(ends[1::2], prepend=0))

    def encode(self, rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows (uint32, end to end) and row offsets into them."""
        if len(self.slot) > self.limit:
            self._reset()
        try:
            at = np.fromiter(map(self.slot.__getitem__, chain.from_iterable(rows)), np.int64)
            self._learn()
        except BaseException:
            self._reset()  # words without ids must not stay
            raise
        ids, ends = self._gather(at)
        row_ends = np.cumsum([0] + [len(row) for row in rows])
        return ids, np.concatenate(([0], ends))[row_ends]
