"""Words as numbers: what operators on word sequences share."""

from __future__ import annotations

import numpy as np


class Numbering(dict):
    """Numbers words in the order in which they come; the first ones may be given."""

    def __init__(self, first: tuple[bytes, ...] = ()) -> None:
        super().__init__((word, k) for k, word in enumerate(first))

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def ranked_windows(numbers: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` numbers a number that equal windows, and no others, share."""
    windows = len(numbers) - size + 1
    if windows <= 0:
        return np.zeros(0, dtype=np.int64)
    ranks, many = numbers[:windows], int(numbers.max()) + 1
    for k in range(1, size):
        ranks = np.unique(ranks * many + numbers[k : k + windows], return_inverse=True)[1]
    return ranks
