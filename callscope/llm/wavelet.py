"""Wavelet matrix of token ids, and its bytes in a token file."""

from __future__ import annotations

import struct

import numpy as np

_MAGIC = b"WVM1"
#: Bits that one entry of a plane's rank directory covers.
BLOCK = 512
#: Set bits of every byte.
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint8)


class WaveletMatrix:
    """``n`` ids in bit planes, highest bit first.

    In every plane the ids with a zero bit come before those with a one bit in the next plane, in
    their order. A directory counts the ones before each block of a plane, so ``rank`` reads one
    entry and at most one block per plane, and ``access``, ``count`` and ``select`` follow an id
    through the planes without unpacking them.
    """

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]) -> None:
        self.n, self.planes, self.zeros = n, planes, zeros
        self.ones_before = [self._directory(p) for p in planes]

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        step = BLOCK // 8
        padded = np.zeros(-(-len(plane) // step) * step, np.uint8)
        padded[: len(plane)] = _ONES[plane]
        sums = padded.reshape(-1, step).sum(axis=1, dtype=np.int64)
        return np.concatenate([[0], np.cumsum(sums)])

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros = [], []
        current = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for bit in range(bits - 1, -1, -1):
            ones = (current & current.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(ones))
            low, high = current.take(np.flatnonzero(~ones)), current.take(np.flatnonzero(ones))
            zeros.append(len(low))
            current = np.concatenate([low, high])
        return cls(len(ids), planes, zeros)

    def to_bytes(self) -> bytes:
        head = struct.pack("<4sQH", _MAGIC, self.n, len(self.planes))
        return head + struct.pack(f"<{len(self.zeros)}Q", *self.zeros) + b"".join(p.tobytes() for p in self.planes)

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        magic, n, bits = struct.unpack_from("<4sQH", raw)
        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix")
        at = struct.calcsize("<4sQH")
        zeros = list(struct.unpack_from(f"<{bits}Q", raw, at))
        at += 8 * bits
        size = -(-n // 8)
        if len(raw) != at + bits * size:
            raise ValueError("a wavelet matrix of another length")
        planes = [np.frombuffer(raw, np.uint8, size, at + k * size) for k in range(bits)]
        return cls(n, planes, zeros)

    def all(self) -> np.ndarray:
        """All ids in order, put together from the last plane upwards."""
        out = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for bit, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            ones = np.unpackbits(plane, count=self.n).view(bool)
            higher = np.empty_like(out)
            higher[np.flatnonzero(~ones)] = out[:zeros]
            higher[np.flatnonzero(ones)] = out[zeros:] | out.dtype.type(1 << bit)
            out = higher
        return out

    def _ones(self, k: int, at: int) -> int:
        """Ones before a place in plane k."""
        block = at // BLOCK
        first = block * (BLOCK // 8)
        bits = np.unpackbits(self.planes[k][first : -(-at // 8)], count=at - block * BLOCK)
        return int(self.ones_before[k][block]) + int(bits.sum())

    def _bit(self, k: int, at: int) -> int:
        return int(self.planes[k][at >> 3]) >> (7 - (at & 7)) & 1

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        out = 0
        for k, zeros in enumerate(self.zeros):
            bit = self._bit(k, at)
            ones = self._ones(k, at)
            at = zeros + ones if bit else at - ones
            out = out * 2 + bit
        return out

    def rank(self, token: int, upto: int) -> int:
        """Occurrences of an id before a place."""
        return self.count(token, 0, upto)

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of an id between two places."""
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def _range(self, token: int, a: int, b: int) -> tuple[int, int]:
        if token >> len(self.planes):
            return 0, 0
        for k, zeros in enumerate(self.zeros):
            ones_a, ones_b = self._ones(k, a), self._ones(k, b)
            if token >> (len(self.planes) - 1 - k) & 1:
                a, b = zeros + ones_a, zeros + ones_b
            else:
                a, b = a - ones_a, b - ones_b
        return a, b

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence of an id, counted from 0."""
        start, end = self._range(token, 0, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        at = start + k
        for plane in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - plane) & 1
            at = self._find(plane, at - self.zeros[plane] if bit else at, bit)
        return at

    def _find(self, k: int, nth: int, bit: int) -> int:
        """The place of the nth one or zero of plane k, by the directory and then one block."""
        counts = self.ones_before[k]
        if not bit:
            counts = np.minimum(np.arange(len(counts)) * BLOCK, self.n) - counts
        block = int(np.searchsorted(counts, nth, side="right")) - 1
        first = block * (BLOCK // 8)
        bits = np.unpackbits(self.planes[k][first : first + BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(bits == bit)[nth - int(counts[block])])

    def locate(self, token: int) -> list[int]:
        """All places of an id."""
        return [self.select(token, k) for k in range(self.count(token))]
