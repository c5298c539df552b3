"""Hashes of words, and of runs of them, many texts at a time."""

from __future__ import annotations

import numpy as np

from .common import LOWER_TABLE, utf8

_WHITE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_BYTES = np.random.default_rng(8).integers(0, 1 << 64, 256, dtype=np.uint64)
_LOWERED = _BYTES[np.frombuffer(LOWER_TABLE, np.uint8)]
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """The polynomial hashes modulo 2^64 of runs of values."""

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        powers = np.full(len(values) + 1, base, np.uint64)
        self.back = np.full(len(values) + 1, pow(base, -1, 1 << 64), np.uint64)
        powers[:1] = self.back[:1] = 1
        self.back = np.cumprod(self.back)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * np.cumprod(powers)[:-1])))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of some texts in a row, parted by ASCII white space: hash, text, line (blank ones counted), and where each
    text begins and ends. lower takes A-Z as a-z."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        parts = [utf8(t) for t in texts]
        data = np.frombuffer(b"\n".join(parts), np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate(([True], _WHITE[data], [True])).astype(np.int8)))
        self.hash = Rolling((_LOWERED if lower else _BYTES)[data]).of(edges[::2], edges[1::2])
        self.text = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), edges[::2], "right")
        self.line = np.searchsorted(np.flatnonzero(data == 10), edges[::2])
        self.begin = np.searchsorted(self.text, np.arange(len(parts)))
        self.end = np.searchsorted(self.text, np.arange(len(parts)), "right")
