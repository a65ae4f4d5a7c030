"""Byte windows of many texts at once: rolling hashes and the anchors that sort them first.

The anchor of a window of ``size`` bytes is the string of two fifths that size in it with the least
hash, the leftmost if several are equal. It depends on the window's bytes alone, so equal windows
have equal anchors at the same place within them, and neighbouring windows mostly share theirs.
"""

from __future__ import annotations

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15
_PLACE_BITS = 23
#: Bytes handled at once; places must fit into ``_PLACE_BITS``.
BLOCK = 1 << 17


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(data: np.ndarray, width: int, multiplier: int = _MULTIPLIER) -> np.ndarray:
    """Hashes (uint64) of all ``width``-byte strings of ``data``, by their first byte."""
    if len(data) < width:
        return np.zeros(0, dtype=np.uint64)
    power, have, need = data.astype(np.uint64) + np.uint64(1), 1, width
    out, covered = None, 0
    while need:
        if need & 1:
            if out is None:
                out = power
            else:
                shift = np.uint64(pow(multiplier, have, 1 << 64))
                n = len(power) - covered
                out = out[:n] * shift + power[covered : covered + n]
            covered += have
        need >>= 1
        if need:
            shift = np.uint64(pow(multiplier, have, 1 << 64))
            power = power[:-have] * shift + power[have:]
            have *= 2
    return mixed(out[: len(data) - width + 1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by the first of them."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(data: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with a common anchor.

    ``data`` holds texts one behind the other, at most ``2 ** 23`` bytes; ``starts`` where each
    begins, and the end. Returns for every run: number of the text, first window, number of
    windows (both as places in ``data``), hash of the anchor. Windows lie within one text.
    """
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < size:
        return empty, empty, empty, np.zeros(0, dtype=np.uint64)
    width = max(1, size * 2 // 5)
    hashes = rolling(data, width)
    place = np.uint64((1 << _PLACE_BITS) - 1)
    packed = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    least = sliding_least(packed, size - width + 1)
    anchor = (least & place).astype(np.int64)
    text_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(anchor)]
    inside = np.arange(len(anchor)) + size <= starts[1:][text_of]
    new = np.ones(len(anchor), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text_of[1:] != text_of[:-1])
    first = np.nonzero(new & inside)[0]
    ends = np.append(np.nonzero(new)[0], len(anchor))
    last = np.minimum(ends[np.searchsorted(ends, first, side="right")], starts[1:][text_of[first]] - size + 1)
    return text_of[first], first, last - first, hashes[anchor[first]]


def window_hashes(data: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows of ``data`` that begin at ``first``."""
    windows = np.zeros((len(first), -(-size // 8) * 8), dtype=np.uint8)
    if len(first):
        windows[:, :size] = np.lib.stride_tricks.sliding_window_view(data, size)[first]
    one = np.full(len(first), 0x243F6A8885A308D3, dtype=np.uint64)
    two = np.full(len(first), 0x13198A2E03707344, dtype=np.uint64)
    for digit in windows.view("<u8").T:
        one = (one ^ digit) * np.uint64(0xD6E8FEB86659FD93)
        one ^= one >> np.uint64(29)
        two = (two + digit) * np.uint64(0x9FB21C651E98DF25)
        two ^= two >> np.uint64(31)
    return mixed(one), mixed(two)
