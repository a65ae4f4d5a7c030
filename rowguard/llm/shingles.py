"""Hashes of word shingles of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from rowguard.llm.bytewindows import mixed

_BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(n - 1, base, dtype=np.uint64)]).cumprod(dtype=np.uint64)


class Shingler:
    """Sets of ``width``-word shingles as sorted arrays of distinct 64-bit hashes.

    Words are what ASCII white space separates, with A-Z in lower case. A text with fewer words has
    its whole sequence as its one shingle, a text without words the empty set.
    """

    def __init__(self, width: int) -> None:
        self.width = width
        self._up, self._down = _powers(_BASE, _BLOCK), _powers(_INVERSE, _BLOCK)

    def _words(self, raw: bytes) -> np.ndarray:
        """Hashes of the words of a text in lower case."""
        data = np.frombuffer(raw, dtype=np.uint8)
        if len(data) > len(self._up):
            size = 1 << len(data).bit_length()
            self._up, self._down = _powers(_BASE, size), _powers(_INVERSE, size)
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
        start, end = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data + np.uint64(1)) * self._up[: len(data)], dtype=np.uint64, out=sums[1:])
        return mixed((sums[end] - sums[start]) * self._down[start] + (end - start).astype(np.uint64))

    def _blocks(self, texts: list[str | None]) -> Iterator[list[bytes]]:
        block, held = [], 0
        for text in texts:
            raw = (text or "").encode().lower()
            if block and held + len(raw) + 1 > _BLOCK:
                yield block
                block, held = [], 0
            block.append(raw)
            held += len(raw) + 1
        if block:
            yield block

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        for block in self._blocks(texts):
            words = self._words(b"\n".join(block))
            counts = [len(raw.split()) for raw in block]
            ends = np.cumsum(counts)
            whole = self._hashes(words, self.width)
            for end, n in zip(ends.tolist(), counts):
                own = whole[end - n : end - self.width + 1] if n >= self.width else self._hashes(words[end - n : end], n)
                yield np.unique(own)

    @staticmethod
    def _hashes(words: np.ndarray, width: int) -> np.ndarray:
        n = len(words) - width + 1
        if width == 0 or n <= 0:
            return np.zeros(0, dtype=np.uint64)
        out = np.full(n, width, dtype=np.uint64)
        for j in range(width):
            out = out * np.uint64(0xD6E8FEB86659FD93) + words[j : j + n]
            out ^= out >> np.uint64(32)
        return mixed(out)
