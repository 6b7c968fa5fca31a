"""Counting quotient filters: built at once from sorted fingerprints, merged losslessly by their sorted remainders.

A fingerprint of ``bits`` bits is a quotient (its first ``q`` bits) and a
remainder.  A filter holds, as bytes:

* occupieds: one bit for each of the 2^q quotients, set where some fingerprint has it;
* remainders: of all fingerprints in ascending order, so those of a quotient (its run) lie
  together and ascend, in as few whole bytes as they need;
* run ends: one bit a remainder, set at the last one of its run;
* counted: one bit a remainder, set where the count is above one, and those counts.

Nothing is lost: the filter gives back every fingerprint with its count, whatever
``q`` it was built with, so filters of different sizes merge (the merged one takes
a ``q`` that fits its size).
"""

from __future__ import annotations

import struct

import numpy as np

HEADER = struct.Struct("<BBBBq")  # bits, quotient bits, bytes of a remainder, bytes of a count, fingerprints
MAX_QUOTIENT_BITS = 26


def _narrow(values: np.ndarray, width: int) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data, width: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _bytes_for(largest: int) -> int:
    return max(1, (int(largest).bit_length() + 7) // 8)


def build(values: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of distinct ascending ``values`` (uint64, below 2^bits) with their counts (1 at least)."""
    n = len(values)
    q = min(bits, MAX_QUOTIENT_BITS, max(0, n - 1).bit_length())
    r = bits - q
    quotient = (values >> np.uint64(r)).astype(np.int64) if q else np.zeros(n, np.int64)
    remainder = values & np.uint64((1 << r) - 1)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True) if n else np.zeros(0, bool)
    counted = counts > 1
    width, count_width = _bytes_for((1 << r) - 1), _bytes_for(counts.max() if n else 1)
    return b"".join([HEADER.pack(bits, q, width, count_width, n), np.packbits(occupied).tobytes(),
                     np.packbits(run_end).tobytes(), np.packbits(counted).tobytes(),
                     _narrow(remainder, width), _narrow(counts[counted].astype(np.uint64), count_width)])


class Filter:
    """A filter's parts, read from its bytes."""

    def __init__(self, data: bytes):
        self.bits, q, width, count_width, n = HEADER.unpack_from(data)
        self.remainder_bits, at, view = self.bits - q, HEADER.size, memoryview(data)

        def flags(size):
            nonlocal at
            part = view[at:at + (size + 7) // 8]
            at += len(part)
            return np.unpackbits(np.frombuffer(part, np.uint8), count=size).astype(bool)

        self.occupied, self.run_end, self.counted = flags(1 << q), flags(n), flags(n)
        self.remainder = _wide(view[at:at + n * width], width, n)
        many = int(self.counted.sum())
        self.counts = np.ones(n, np.int64)
        self.counts[self.counted] = _wide(view[at + n * width:], count_width, many).astype(np.int64)

    def values(self) -> np.ndarray:
        """All fingerprints, ascending."""
        run = np.cumsum(self.run_end) - self.run_end
        quotient = np.flatnonzero(self.occupied).astype(np.uint64)
        if not self.remainder_bits:
            return quotient[run]
        return (quotient[run] << np.uint64(self.remainder_bits) if self.remainder_bits < 64 else 0) | self.remainder

    def count(self, value: int) -> int:
        """How often ``value`` came: its quotient's run by rank and select, then the remainder within the run."""
        quotient, remainder = value >> self.remainder_bits, value & ((1 << self.remainder_bits) - 1)
        if not self.occupied[quotient]:
            return 0
        run = int(self.occupied[:quotient].sum())
        ends = np.flatnonzero(self.run_end)
        first, end = (int(ends[run - 1]) + 1 if run else 0), int(ends[run]) + 1
        at = first + int(np.searchsorted(self.remainder[first:end], np.uint64(remainder)))
        return int(self.counts[at]) if at < end and int(self.remainder[at]) == remainder else 0


def summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ascending values with the sums of their counts; ascending stretches of ``values`` are merged, not sorted anew."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def merge(filters: list[bytes], bits: int) -> bytes:
    """One filter with all fingerprints of ``filters`` and the sums of their counts."""
    read = [Filter(f) for f in filters]
    if any(f.bits != bits for f in read):
        raise ValueError("filters of other fingerprints do not merge")
    values = np.concatenate([np.zeros(0, np.uint64), *[f.values() for f in read]])
    return build(*summed(values, np.concatenate([np.zeros(0, np.int64), *[f.counts for f in read]])), bits)
