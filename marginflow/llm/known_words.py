"""Words whose ids a task already knows, as flat arrays."""

from __future__ import annotations

from itertools import chain

from marginflow.llm.byte_bpe import spread


class KnownWords:
    """Numbers words and keeps their ids; forgets all beyond ``most`` words.

    ``encode(words)`` gives (ids one after the other, number of ids of each)
    for words not met before."""

    def __init__(self, encode, most: int):
        self.encode, self.most = encode, most
        self._forget()

    def _forget(self) -> None:
        import numpy as np
        self.number: dict[str, int] = {}
        self.ids = self.count = self.start = np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        import numpy as np
        ids, count = self.encode(words)
        base = len(self.number)
        self.number.update(zip(words, range(base, base + len(words))))
        self.ids = np.concatenate([self.ids, ids])
        self.count = np.concatenate([self.count, count])
        self.start = np.cumsum(self.count) - self.count

    def ids_of(self, cut: list[list[str]]):
        """(ids of all texts one after the other, number of ids of each) of texts given as words."""
        import numpy as np
        if len(self.number) > self.most:
            self._forget()
        new = set(chain.from_iterable(cut)).difference(self.number)
        if new:
            self._learn(list(new))
        n_words = np.fromiter(map(len, cut), np.int64, len(cut))
        words = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, int(n_words.sum()))
        count = self.count[words]
        ids = self.ids[spread(self.start[words], count)]
        ends = np.concatenate([[0], np.cumsum(count)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(n_words)])])
