"""Counting quotient filters: packed n-grams, invertibly permuted, as quotient runs and full remainders with counts."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_ODD = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def _mask(width: int) -> np.uint64:
    return _U((1 << width) - 1)


def permute(x: np.ndarray, width: int) -> np.ndarray:
    """A bijection of the `width`-bit numbers that spreads low bits over the high ones."""
    half, mask = _U((width + 1) // 2), _mask(width)
    x = x ^ (x >> half)
    for odd in _ODD:
        x = (x * _U(odd)) & mask
        x ^= x >> half
    return x


def restore(x: np.ndarray, width: int) -> np.ndarray:
    """The inverse of `permute`: a shift by half the width or more undoes itself."""
    half, mask = _U((width + 1) // 2), _mask(width)
    x = x ^ (x >> half)
    for odd in reversed(_ODD):
        x = (x * _U(pow(odd, -1, 1 << 64))) & mask
        x ^= x >> half
    return x


class Packing:
    """n word ids of `bits` bits each in as few 64-bit numbers as hold whole ids; the first one is permuted.

    With several numbers, a hash of the others is first added to the first one (modulo its width), which can be taken off
    again, so the first one's quotient spreads n-grams that begin alike as well.
    """

    def __init__(self, n: int, bits: int):
        self.n, self.bits = n, bits
        self.each = 64 // bits
        self.limbs = -(-n // self.each)
        self.width = bits * min(n, self.each)

    def _others(self, limbs: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(limbs[0]), dtype=np.uint64)
        for x in limbs[1:]:
            out = permute(out + x * _U(_ODD[0]) + _U(1), 64)
        return out

    def pack(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """Permuted keys of n-grams, given as one array of ids for each place."""
        limbs = []
        for k in range(0, self.n, self.each):
            x = np.zeros(len(ids[0]), dtype=np.uint64)
            for part in ids[k : k + self.each]:
                x = (x << _U(self.bits)) | part.astype(np.uint64)
            limbs.append(x)
        limbs[0] = permute((limbs[0] + self._others(limbs)) & _mask(self.width), self.width)
        return limbs

    def unpack(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        first = (restore(limbs[0], self.width) - self._others(limbs)) & _mask(self.width)
        out = []
        for k, x in enumerate([first, *limbs[1:]]):
            size = min(self.each, self.n - k * self.each)
            out += [((x >> _U(self.bits * (size - 1 - j))) & _mask(self.bits)).astype(np.int64) for j in range(size)]
        return out


def _bytes(x: np.ndarray, size: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _numbers(data: memoryview, count: int, size: int) -> np.ndarray:
    out = np.zeros((count, 8), dtype=np.uint8)
    out[:, :size] = np.frombuffer(data, dtype=np.uint8, count=count * size).reshape(count, size)
    return out.view("<u8").ravel().astype(np.uint64)


def _small(x: np.ndarray) -> bytes:
    """Numbers of a byte each; those of 255 and more follow in full."""
    return np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].astype("<i8").tobytes()


def _read_small(data: memoryview, count: int) -> tuple[np.ndarray, int]:
    out = np.frombuffer(data, dtype=np.uint8, count=count).astype(np.int64)
    large = np.flatnonzero(out == 255)
    out[large] = np.frombuffer(data, dtype="<i8", count=len(large), offset=count)
    return out, count + 8 * len(large)


class Filter:
    """Distinct keys in ascending order with their counts; nothing is rounded or lost."""

    def __init__(self, packing: Packing, limbs: list[np.ndarray], counts: np.ndarray):
        self.packing, self.limbs, self.counts = packing, limbs, counts

    @classmethod
    def empty(cls, packing: Packing) -> Filter:
        return cls(packing, [np.zeros(0, dtype=np.uint64)] * packing.limbs, np.zeros(0, dtype=np.int64))

    @classmethod
    def of(cls, packing: Packing, limbs: list[np.ndarray], counts: np.ndarray) -> Filter:
        """From keys in any order; sorted runs that follow one another are merged, as the sort is a merge sort."""
        if not len(counts):
            return cls.empty(packing)
        order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
        limbs = [x[order] for x in limbs]
        new = np.ones(len(counts), dtype=bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in limbs])
        at = np.flatnonzero(new)
        return cls(packing, [x[at] for x in limbs], np.add.reduceat(counts[order], at))

    @classmethod
    def merged(cls, packing: Packing, filters: list[Filter]) -> Filter:
        if len(filters) == 1:
            return filters[0]
        limbs = [np.concatenate([f.limbs[i] for f in filters]) for i in range(packing.limbs)]
        return cls.of(packing, limbs, np.concatenate([f.counts for f in filters]))

    def __len__(self) -> int:
        return len(self.counts)

    def shards(self, bits: int) -> list[tuple[int, Filter]]:
        """(shard, filter) by the leading bits of the quotient; only those with keys."""
        shift = max(self.packing.width - bits, 0)
        shard = (self.limbs[0] >> _U(shift)).astype(np.int64) if shift < 64 else np.zeros(len(self), dtype=np.int64)
        edges = [*np.flatnonzero(np.diff(shard, prepend=-1)).tolist(), len(shard)]
        return [
            (int(shard[a]), Filter(self.packing, [x[a:b] for x in self.limbs], self.counts[a:b]))
            for a, b in zip(edges[:-1], edges[1:], strict=True)
        ]

    def payload(self, shard: int, bits: int) -> bytes:
        """A shard's bytes: run length of each quotient, remainders without the quotient's bits, other numbers, counts."""
        bits = min(bits, self.packing.width)
        rest = self.packing.width - bits
        own = min(rest, max(len(self) - 1, 0).bit_length())
        low = rest - own
        inside = self.limbs[0] & _mask(rest) if rest else np.zeros(len(self), dtype=np.uint64)
        runs = np.bincount((inside >> _U(low)).astype(np.int64) if low < 64 else np.zeros(len(self), dtype=np.int64), minlength=1 << own)
        parts = [np.array([len(self), own], dtype="<u4").tobytes(), _small(runs)]
        parts.append(_bytes(inside & _mask(low) if low else inside * _U(0), -(-low // 8)))
        for k, x in enumerate(self.limbs[1:], 1):
            size = min(self.packing.each, self.packing.n - k * self.packing.each)
            parts.append(_bytes(x, -(-size * self.packing.bits // 8)))
        parts.append(_small(self.counts))
        return b"".join(parts)

    @classmethod
    def read(cls, packing: Packing, shard: int, bits: int, data: bytes) -> Filter:
        view = memoryview(data)
        bits = min(bits, packing.width)
        rest = packing.width - bits
        n, own = np.frombuffer(view, dtype="<u4", count=2).tolist()
        view, low = view[8:], rest - own
        runs, used = _read_small(view, 1 << own)
        view = view[used:]
        quotient = np.repeat(np.arange(1 << own, dtype=np.uint64), runs)
        size = -(-low // 8)
        first = (quotient << _U(low) if low < 64 else quotient * _U(0)) | _numbers(view, n, size)
        limbs = [first | (_U(shard) << _U(rest)) if rest < 64 else first]
        view = view[n * size :]
        for k in range(1, packing.limbs):
            size = -(-min(packing.each, packing.n - k * packing.each) * packing.bits // 8)
            limbs.append(_numbers(view, n, size))
            view = view[n * size :]
        return cls(packing, limbs, _read_small(view, n)[0])
