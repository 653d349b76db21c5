"""A counting quotient filter over packed n-grams: compact, lossless counters that merge in sorted order.

An n-gram of up to three word numbers of ``bits`` bits is packed into one number of ``3 * bits`` bits (a missing
word is 0). An invertible permutation spreads these numbers evenly. The upper bits of the result are the
quotient: the first of them name a block, the next ``slots`` a bucket of the block's filter. All other bits are
the full remainder, so no two n-grams share a counter, and undoing the permutation gives the n-gram back.

A filter keeps one bit per bucket (whether it is occupied), one bit per entry (whether it ends its bucket's
run), the remainders of all runs in order, and one counter per entry. Entries are therefore sorted by quotient and
remainder: filters of several shards merge like sorted lists, and a counter is found by counting bits.
"""

from __future__ import annotations

import numpy as np

from .blobs import pack, unpack

LEAST_BITS, MOST_BITS = 16, 32


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _u(value: int) -> np.uint64:
    return np.uint64(value)


class Permutation:
    """An invertible map of pairs: ``upper`` of ``bits`` bits and ``lower`` of ``2 * bits`` bits."""

    ODD = 0x9E3779B97F4A7C15
    ROUNDS = 2

    def __init__(self, bits: int):
        self.bits, self.low, self.high = bits, _mask(2 * bits), _mask(bits)
        self.odd = _u(self.ODD & ((1 << 2 * bits) - 1))
        self.back = _u(pow(self.ODD, -1, 1 << 2 * bits))

    def _stir(self, x: np.ndarray) -> np.ndarray:
        """``bits`` bits that depend on all of ``x``."""
        x = (x ^ (x >> _u(29))) * _u(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _u(32))) * _u(0x94D049BB133111EB)
        return (x ^ (x >> _u(31))) & self.high

    def forward(self, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            for _ in range(self.ROUNDS):
                lower = ((lower + upper * _u(0xD6E8FEB86659FD93)) * self.odd) & self.low
                lower = lower ^ (lower >> _u(self.bits))
                upper = (upper + self._stir(lower)) & self.high
        return upper, lower

    def inverse(self, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            for _ in range(self.ROUNDS):
                upper = (upper - self._stir(lower)) & self.high
                lower = lower ^ (lower >> _u(self.bits))  # the shift is half the width, so once undoes it
                lower = ((lower * self.back) - upper * _u(0xD6E8FEB86659FD93)) & self.low
        return upper, lower

    def packed(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.forward(first.astype(np.uint64), (second.astype(np.uint64) << _u(self.bits)) | third.astype(np.uint64))

    def words(self, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
        upper, lower = self.inverse(upper, lower)
        return tuple(x.astype(np.int64) for x in (upper, lower >> _u(self.bits), lower & self.high))


def summed(upper: np.ndarray, lower: np.ndarray, count: np.ndarray, bits: int) -> tuple[np.ndarray, ...]:
    """Distinct permuted n-grams in order, with the sums of their counts."""
    if 3 * bits <= 64:
        whole = (upper << _u(2 * bits)) | lower
        order = np.argsort(whole, kind="stable")  # runs that are sorted already are merged
        whole = whole[order]
        first = np.flatnonzero(np.append(True, whole[1:] != whole[:-1])) if len(whole) else np.zeros(0, dtype=np.int64)
    else:
        order = np.lexsort((lower, upper))
        a, b = upper[order], lower[order]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, dtype=np.int64)
    total = np.add.reduceat(count[order], first) if len(first) else count[:0]
    at = order[first]
    return upper[at], lower[at], total


class Filter:
    """Counters of the n-grams of one block; ``block_bits`` upper bits of the quotient name the block."""

    def __init__(self, bits: int, block_bits: int, slots: int, block: int, occupied: np.ndarray, ends: np.ndarray, upper: np.ndarray, lower: np.ndarray, count: np.ndarray):
        self.bits, self.block_bits, self.slots, self.block = bits, block_bits, slots, block
        self.occupied, self.ends, self.upper, self.lower, self.count = occupied, ends, upper, lower, count

    @classmethod
    def of(cls, upper: np.ndarray, lower: np.ndarray, count: np.ndarray, bits: int, block_bits: int, block: int) -> Filter:
        """From distinct permuted n-grams in ascending order, all of the same block."""
        left = bits - block_bits
        slots = min(left, max(len(upper), 1).bit_length() - 1)
        bucket = ((upper & _mask(left)) >> _u(left - slots)).astype(np.int64)
        occupied = np.zeros(1 << slots, dtype=bool)
        occupied[bucket] = True
        ends = np.append(bucket[1:] != bucket[:-1], True)[: len(bucket)]
        return cls(bits, block_bits, slots, block, occupied, ends, upper & _mask(left - slots), lower, count)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Permuted n-grams in ascending order with their counts."""
        bucket = np.flatnonzero(self.occupied)
        run = np.cumsum(self.ends) - self.ends  # number of the run of each entry
        left = self.bits - self.block_bits
        quotient = (np.uint64(self.block) << _u(left)) | (bucket[run].astype(np.uint64) << _u(left - self.slots))
        return quotient | self.upper, self.lower, self.count

    def find(self, upper: int, lower: int) -> int:
        """The counter of one permuted n-gram; 0 if it is not there."""
        left = self.bits - self.block_bits
        bucket = (upper & ((1 << left) - 1)) >> (left - self.slots)
        if upper >> left != self.block or not self.occupied[bucket]:
            return 0
        run = int(self.occupied[:bucket].sum())  # rank of the bucket among the occupied ones
        stops = np.flatnonzero(self.ends)  # select of the run's end
        a, b = (int(stops[run - 1]) + 1 if run else 0), int(stops[run]) + 1
        hit = np.flatnonzero((self.upper[a:b] == _u(upper & ((1 << (left - self.slots)) - 1))) & (self.lower[a:b] == _u(lower)))
        return int(self.count[a + hit[0]]) if len(hit) else 0

    def dump(self) -> bytes:
        head = np.array([self.bits, self.block_bits, self.slots, self.block, len(self.count)], dtype=np.int64)
        bits = [np.packbits(x) for x in (self.occupied, self.ends)]
        return pack(head, *bits, self.upper, self.lower, self.count.astype(np.uint64))

    @classmethod
    def load(cls, raw: bytes) -> Filter:
        head, occupied, ends, upper, lower, count = unpack(raw)
        bits, block_bits, slots, block, n = head.tolist()
        bit = lambda x, size: np.unpackbits(x, count=size).astype(bool)
        return cls(bits, block_bits, slots, block, bit(occupied, 1 << slots), bit(ends, n), upper, lower, count.astype(np.int64))


def merged(filters: list[Filter]) -> Filter:
    """One filter with the counters of several of the same block."""
    one = filters[0]
    parts = zip(*(f.entries() for f in filters))
    return Filter.of(*summed(*(np.concatenate(p) for p in parts), one.bits), one.bits, one.block_bits, one.block)


def filters(upper: np.ndarray, lower: np.ndarray, bits: int, block_bits: int) -> list[Filter]:
    """The filters, one per block, of permuted n-grams with repeats."""
    upper, lower, count = summed(upper, lower, np.ones(len(upper), dtype=np.int64), bits)
    block = (upper >> _u(bits - block_bits)).astype(np.int64)
    edges = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, dtype=np.int64)
    ends = np.append(edges[1:], len(block)) if len(edges) else edges
    return [Filter.of(upper[a:b], lower[a:b], count[a:b], bits, block_bits, int(block[a])) for a, b in zip(edges.tolist(), ends.tolist())]
