"""Sets of word shingles as 64-bit hashes, computed for whole Arrow columns at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 20  # bytes of text hashed together


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value (multiply and shift, twice)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class ShingleHasher:
    """Distinct hashes of the ``width``-word shingles of each text.

    Words are runs without space, tab, line feed, vertical tab, form feed and carriage return, after
    lower-casing A-Z. A text with fewer words has its whole sequence as one shingle; one without words
    has none.
    """

    def __init__(self, width: int):
        self.width = width
        table = np.random.default_rng(20240229)  # any fixed table does, as long as all tasks share it
        self._of_byte = table.integers(1, 2**63, 256, dtype=np.uint64)
        self._of_byte[65:91] = self._of_byte[97:123]
        self._place = table.integers(1, 2**63, width, dtype=np.uint64) | np.uint64(1)
        self._space = np.zeros(256, bool)
        self._space[[32, 9, 10, 11, 12, 13]] = True
        self._base = np.uint64(0x9E3779B97F4A7C15)
        self._inverse = np.uint64(pow(int(self._base), -1, 2**64))
        self._powers(1 << 10)

    def _powers(self, size: int) -> None:
        up, down = np.full(size, self._base), np.full(size, self._inverse)
        up[0] = down[0] = 1
        self._up, self._down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)

    def _block(self, data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Hash sets of the texts that end at ``ends`` in ``data``."""
        size, starts = len(data), np.concatenate(([0], ends[:-1]))
        if size == 0:
            return [np.empty(0, np.uint64)] * len(ends)
        if size > len(self._up):
            self._powers(max(size, min(_BLOCK, 2 * size)))
        word = ~self._space[data]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        inner = starts[(starts > 0) & (starts < size)]
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.concatenate(([np.uint64(0)], np.cumsum(self._of_byte[data] * self._up[:size], dtype=np.uint64)))
        hashes = _mix((total[end] - total[begin]) * self._down[begin] + (end - begin).astype(np.uint64))
        cut = np.searchsorted(begin, np.concatenate((starts, [size])))  # a text's words: from cut[i] to cut[i + 1]
        k, n = self.width, len(hashes)
        full = np.zeros(max(0, n - k + 1), np.uint64)
        for i in range(k):
            full += hashes[i : i + len(full)] * self._place[i]
        full = _mix(full)
        out = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(full[a : b - k + 1]))
            elif b > a:
                out.append(_mix(np.array([(hashes[a:b] * self._place[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)])))
            else:
                out.append(np.empty(0, np.uint64))
        return out

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """One sorted array of hashes per text; null counts as empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not len(texts):
            return
        _, where, values = texts.buffers()
        offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _BLOCK, "right")) - 1)
            to = min(to, len(texts))
            yield from self._block(data[offsets[at] : offsets[to]], offsets[at + 1 : to + 1] - offsets[at])
            at = to
