"""Distinct word shingles of whole texts as 64-bit hashes, vectorised over batches of texts."""

from __future__ import annotations

import numpy as np

WORDS = 5
_M = 0xFFFFFFFFFFFFFFFF
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 4 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random 64-bit value per byte; A-Z have the values of a-z.
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_VALUE[65:91] = _VALUE[97:123]
#: A random odd factor per place in a shingle.
_PLACE = mix(np.arange(1001, 1001 + 64, dtype=np.uint64)) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Shingler:
    def __init__(self, words: int = WORDS) -> None:
        self.words = words
        self.up, self.down = _powers(1 << 16)

    def _room(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = _powers(1 << (n - 1).bit_length())

    def word_hashes(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first byte of every word of ``data`` (uint8)."""
        self._room(len(data) + 1)
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
        begin, end = edge[::2], edge[1::2]
        running = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * self.up[:len(data)], out=running[1:])
        h = (running[end] - running[begin]) * self.down[begin]
        return mix(h + (end - begin).astype(np.uint64)), begin

    def long_word_hashes(self, data: np.ndarray) -> np.ndarray:
        """Word hashes of one text, in steps that end at white space, so that memory stays bounded."""
        out, at = [], 0
        while at < len(data):
            stop = min(len(data), at + _STEP)
            while stop < len(data) and not _SPACE[data[stop]]:
                stop += 1
            out.append(self.word_hashes(data[at:stop])[0])
            at = stop
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def join(self, words: np.ndarray) -> np.ndarray:
        """Hashes of all runs of ``self.words`` words, or of the whole sequence if it is shorter."""
        k = min(self.words, len(words))
        if not k:
            return np.zeros(0, np.uint64)
        n = len(words) - k + 1
        total = np.full(n, k, np.uint64)
        for j in range(k):
            total += words[j:n + j] * _PLACE[j]
        return mix(total)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of every text."""
        out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
        group: list[int] = []
        held = 0

        def flush() -> None:
            data = np.frombuffer(b" ".join(texts[i] for i in group), np.uint8)
            words, begin = self.word_hashes(data)
            starts = np.cumsum([0] + [len(texts[i]) + 1 for i in group])
            cut = np.searchsorted(begin, starts)
            for i, a, b in zip(group, cut[:-1], cut[1:], strict=True):
                out[i] = np.unique(self.join(words[a:b]))
            group.clear()

        for i, t in enumerate(texts):
            if len(t) > _STEP:
                out[i] = np.unique(self.join(self.long_word_hashes(np.frombuffer(t, np.uint8))))
                continue
            group.append(i)
            held += len(t)
            if held > _STEP // 4:
                flush()
                held = 0
        if group:
            flush()
        return out


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit key of a set of shingles."""
    with np.errstate(over="ignore"):
        total = mix(s + np.uint64(0x51ED270B)).sum(dtype=np.uint64) + np.uint64(len(s)) * np.uint64(_BASE)
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])
