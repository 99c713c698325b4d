"""Words of a slab of texts as 64-bit hashes, by vectors over its bytes."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_FINAL = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: Bytes hashed at a time (longer texts in pieces, cut at white space).
PIECE = 1 << 20


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of a hash."""
    for shift, factor in ((30, _FINAL[0]), (27, _FINAL[1])):
        h = (h ^ (h >> _U(shift))) * _U(factor)
    return h ^ (h >> _U(31))


class WordHasher:
    """A word's hash is a polynomial in its bytes, A-Z lower-cased: a
    difference of running sums, moved back to the word's start."""

    def __init__(self, table: bytes | None = None):
        """`table`: what each byte of the texts is read as (bytes.translate)."""
        self.table = table
        self.power = self.inverse = np.zeros(0, _U)

    def _grow(self, n: int) -> None:
        if n > len(self.power):
            n = max(n, 1 << 16)
            for name, base in (("power", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                p = np.full(n, base, _U)
                p[0] = 1
                setattr(self, name, np.cumprod(p))

    def _piece(self, data: bytes):
        """(hashes, first bytes) of the words."""
        a = np.frombuffer(data, np.uint8)
        self._grow(len(a) + 1)
        space = np.empty(len(a) + 2, bool)
        space[0] = space[-1] = True
        space[1:-1] = _SPACE[a]
        edge = np.flatnonzero(space[1:] != space[:-1])
        first, last = edge[::2], edge[1::2]
        total = np.zeros(len(a) + 1, _U)
        np.cumsum((a.astype(_U) + _U(1)) * self.power[:len(a)], out=total[1:])
        return mixed((total[last] - total[first]) * self.inverse[first]), first

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """The word hashes of each text."""
        raw = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
        if self.table:
            raw = [t.translate(self.table) for t in raw]
        out: list = [None] * len(raw)
        group, size = [], 0

        def flush():
            if group:
                h, first = self._piece(b"\n".join(raw[i] for i in group))
                begin = np.cumsum([0, *(len(raw[i]) + 1 for i in group)])
                at = np.searchsorted(first, begin)
                for i, a, z in zip(group, at, at[1:]):
                    out[i] = h[a:z]

        for i, data in enumerate(raw):
            if len(data) > PIECE:
                out[i] = self._long(data)
                continue
            if size + len(data) > PIECE:
                flush()
                group, size = [], 0
            group.append(i)
            size += len(data) + 1
        flush()
        return out

    def _long(self, data: bytes) -> np.ndarray:
        parts, at = [], 0
        while at < len(data):
            end = at + PIECE
            while end < len(data) and not _SPACE[data[end]]:
                end += 1
            parts.append(self._piece(data[at:end])[0])
            at = end
        return np.concatenate(parts)
