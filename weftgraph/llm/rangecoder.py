"""Adaptive context-mixing range coder for token ids, many blocks at a time.

A segment of ids is a table and blocks of ``BLOCK`` ids.  The table names the ids of the segment by rank of
their frequency, with their counts, and primes the models.  A block is coded on its own: models start anew
from the table and the header has a checksum of the ids.  Blocks are lanes of numpy arrays: each step
codes one id of every lane, so the interpreter's cost is shared by all lanes.  Coding knows all ids beforehand:
only what depends on the step before (tables, estimates, the weight, the range) is done step by step, all else for
``STEPS`` steps at a time.  Decoding goes step by step.

Model of an id x after the ids p1 (last) and p2 (the one before), all as ranks:

* an order-2 table proposes the id last seen after (p2, p1), an order-1 table the
  one last seen after p1, each with a confidence from 0 to 3;
* one symbol says "order-2 hit", "order-1 hit" or "neither".  Its probabilities
  are a mix of two adaptive estimates, one seen by order-2 confidence and
  agreement of the two proposals, one by order-1 confidence and the last symbol;
  the weight moves towards the estimate that did better;
* ids that neither proposed are coded by order 0 in two symbols: the rank's class (its number of bits),
  an adaptive estimate in the context of the last such class, primed by the segment; then the id within its class, by
  the segment's counts of such ids.

The range coder keeps 48 bits and puts out 16-bit words; carries go into words
already put out.  A block has two streams, symbols and order-0 ids.  Ids may be any unsigned 32-bit integers.
"""

from __future__ import annotations

import struct
import sys
import zlib

import numpy as np

BLOCK, LANES = 2048, 2048
MAGIC = b"WTK2"
HEAD = struct.Struct("<4sIIIII")  # magic, ids, order-0 ids, words of the symbols, words of the ids, crc32
BITS, ID_BITS = 12, 22  # of the frequencies of symbols and classes, and of the ids in a class
RENORM, MASK48 = 1 << 32, (1 << 48) - 1
SLOTS, CONTEXTS = 2048, 16
#: Targets of the adaptive 3-way cumulative frequencies (out of 4096), both bounds of a symbol in one number, 16 bits each.
GOALS = np.array([4032 << 16 | 4064, 32 << 16 | 4064, 32 << 16 | 64], np.uint32)
START, BOTH = 1365 << 16 | 2730, np.uint32(0x0FFF0FFF)
#: Classes of ranks.
CLASSES = 24
#: Steps of all lanes that the coder prepares at a time, and places between the lanes' rows, which else meet in the caches.
STEPS, GAP = 16, 17
_i = np.arange(CLASSES)
GOAL_CLASS = np.where(_i[None, :] >= _i[:, None], 4096 - (CLASSES - 1 - _i)[None, :] * 4, (_i[None, :] + 1) * 4).astype(np.int16)
TABLE = struct.Struct("<4sII")  # magic, ids, bytes of the packed table


class Writer:
    """The range coders of all lanes."""

    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.int64)
        self.rng = np.full(lanes, MASK48, np.int64)
        self.out = np.zeros((lanes, steps + 4), np.uint16)
        self.flat = self.out.reshape(-1)
        self.end = np.arange(lanes, dtype=np.int64) * (steps + 4)  # where a lane's next word goes

    def put(self, cum: np.ndarray, freq: np.ndarray, bits) -> None:
        """Code row after row: a symbol in each of the first lanes; (0, 1 << bits) leaves a lane as it is."""
        steps, n = cum.shape
        low, rng = self.low[:n], self.rng[:n]
        high = low.view(np.uint32)[1::2]  # bits 32 to 47 are the next word, bit 48 is the carry
        tops, small = np.empty((steps, n), np.uint32), np.empty((steps, n), bool)
        place = np.empty((steps + 1, n), np.int64)  # 16 times as many words as were put out before and in a step
        place[0] = 0
        r, shift = np.empty(n, np.int64), np.empty(n, np.int64)
        for c, f, b, top, less, was, now in zip(cum, freq, bits, tops, small, place, place[1:]):
            np.right_shift(rng, b, out=r)
            np.multiply(r, f, out=rng)
            np.multiply(r, c, out=r)
            np.add(low, r, out=low)
            top[:] = high
            np.less(rng, RENORM, out=less)
            np.multiply(less, 16, out=shift)
            np.add(was, shift, out=now)
            np.left_shift(rng, shift, out=rng)
            np.left_shift(low, shift, out=low)
            np.bitwise_and(low, MASK48, out=low)
        end = self.end[:n]
        place = place[1:]
        place >>= 4
        place += end - 1
        words, carries = small.reshape(-1).nonzero()[0], (tops > 0xFFFF).reshape(-1).nonzero()[0]
        end[:] = place[-1] + 1
        place, small = place.reshape(-1), small.reshape(-1)
        self.flat[place[words]] = tops.reshape(-1)[words].astype(np.uint16)
        over = place[carries] - small[carries]  # the last word before the step
        while len(over):
            self.flat[over] += 1
            over = over[self.flat[over] == 0] - 1

    def words(self) -> list[bytes]:
        for k in (32, 16, 0):
            self.flat[self.end] = (self.low >> k & 0xFFFF).astype(np.uint16)
            self.end += 1
        width = self.out.shape[1]
        return [line[:e - i * width].astype("<u2").tobytes() for i, (line, e) in enumerate(zip(self.out, self.end.tolist()))]


class Reader:
    def __init__(self, streams: list[bytes]):
        n = len(streams)
        self.data = np.zeros((n, max((len(s) // 2 for s in streams), default=0) + 4), np.uint16)
        for line, s in zip(self.data, streams):
            line[:len(s) // 2] = np.frombuffer(s, "<u2")
        d = self.data[:, :3].astype(np.int64)
        self.dif = d[:, 0] << 32 | d[:, 1] << 16 | d[:, 2]
        self.rng = np.full(n, MASK48, np.int64)
        self.flat = self.data.reshape(-1)
        self.pos = np.arange(n, dtype=np.int64) * self.data.shape[1] + 3

    def renorm(self, n: int) -> None:
        small = (self.rng[:n] < RENORM).nonzero()[0]
        if len(small):
            at = self.pos[small]
            self.dif[small] = self.dif[small] << 16 | self.flat.take(at, mode="clip")
            self.rng[small] <<= 16
            self.pos[small] = at + 1


class Proposals:
    """Order-1 and order-2 tables and the estimates, each as two rows: of all lanes by order 1, then by order 2.

    Tables hold id * 4 + confidence; an estimate holds both bounds, which stay below 4096, so that sums of 16 parts
    of them fit 16 bits each and one number does for both.
    """

    def __init__(self, lanes: int):
        lane = np.arange(lanes, dtype=np.int64)
        # lanes lie side by side, as many of them use the same few slots and contexts
        self.table = np.zeros(2 * lanes * SLOTS, np.int32)
        self.base = np.stack([lane, lane + lanes * SLOTS])
        self.est = np.full(2 * lanes * CONTEXTS, START, np.uint32)  # by order-2 confidence, then by order-1 confidence
        self.ebase = np.stack([lane, lane + lanes * CONTEXTS])
        self.weight = np.full(lanes, 8, np.int8)
        self.last = np.full(lanes, 2, np.uint8)

    def learn_id(self, at, v, fresh) -> None:
        """Take in an id (as ``fresh``, id * 4) where ``v`` stood: it stays if right, or if sure enough."""
        d = v ^ fresh  # the confidence if the id is right, else more than 3
        stay = ((v & 3) > 0) | (d < 4)
        self.table[at] = np.where(stay, v + np.sign(3 - d), fresh)

    def learn_symbol(self, k, e, goal) -> None:
        """Move the estimates ``e`` by a 16th towards the goal."""
        e = e * np.uint32(15)
        e += goal
        e >>= 4
        e &= BOTH
        self.est[k] = e

    def learn_weight(self, towards) -> None:
        self.weight += towards
        np.maximum(self.weight, 1, out=self.weight)
        np.minimum(self.weight, 15, out=self.weight)


def slots(h1, h2):
    """Slots of the tables after the ids with hashes ``h1`` (last) and ``h2`` (the one before)."""
    return h1 >> 4 & (SLOTS - 1), (h1 + h2) >> 5


def hashes(x):
    x = x.astype(np.uint16)
    return x * np.uint16(40503), x * np.uint16(60493)


def mixed(e, e2, weight):
    """The bounds a, b that the estimates give by the weight of the first; ``e`` is the first less the second."""
    m = e * weight
    m += e2 << 4
    return m >> 20, m >> 4 & 0xFFF


def towards(e, symbol, known):
    """1 where the first estimate gave the symbol more room, -1 where the second did; ``known`` are those that are not 2."""
    halves = e.view(np.int16)
    b = halves[1::2] if sys.byteorder == "big" else halves[::2]
    a = halves[::2] if sys.byteorder == "big" else halves[1::2]
    more = -b
    if len(known):
        second, a, b = symbol[known] > 0, a[known], b[known]
        a = a + (b < 0)  # what the lower half borrowed
        more[known] = np.where(second, b - a, a)
    return np.sign(more).astype(np.int8)


def class_of(rank: np.ndarray) -> np.ndarray:
    """The number of bits of rank + 1, less one."""
    return np.frexp((rank + 1).astype(np.float64))[1] - 1


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """Frequencies in proportion to ``counts``, 1 at least, that sum to ``total``."""
    n = len(counts)
    out = 1 + (counts * (total - n) // max(1, int(counts.sum()))).astype(np.int64)
    out[int(np.argmax(counts))] += total - int(out.sum())
    return out


class Table:
    """The ids of a segment by rank, and how often neither proposal knew them.

    Ranks of a class (1, 2, 4 … of them, by falling frequency) ascend by id.
    """

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        self.ids, self.counts = ids, counts
        n = len(ids)
        self.classes = class_of(np.arange(n))
        starts = np.flatnonzero(np.append(True, np.diff(self.classes) > 0)) if n else np.zeros(0, np.int64)
        per_class = np.zeros(CLASSES, np.int64)
        freq = np.zeros(n, np.int64)
        for c, (i, j) in enumerate(zip(starts, np.append(starts[1:], n))):
            per_class[c] = counts[i:j].sum()
            freq[i:j] = shares(counts[i:j], 1 << ID_BITS)
        self.freq = freq
        before = np.cumsum(freq) - freq
        self.cum = before - (before[starts][self.classes] if n else 0)
        self.keys = self.classes.astype(np.int64) << ID_BITS | self.cum
        self.prime = np.cumsum(shares(per_class, 4096)).astype(np.int16)
        self.last, self.starts = int(self.classes[-1]) if n else 0, None

    @classmethod
    def of(cls, ids: np.ndarray) -> tuple[Table, np.ndarray]:
        """The table of ``ids`` (counts of all their occurrences) and their ranks."""
        if len(ids) and int(ids.max()) < 1 << 20:  # small ids are their own places
            at, n = ids, np.bincount(ids)
            known = n.nonzero()[0]
            n, place = n[known], np.zeros(len(n), np.int64)
        else:
            known, at, n = np.unique(ids, return_inverse=True, return_counts=True)
            place = None
        order = np.argsort(-n, kind="stable")
        rank_class = class_of(np.arange(len(known)))
        order = order[np.lexsort((known[order], rank_class))]
        rank = np.empty(len(known), np.int64)
        rank[order] = np.arange(len(known))
        table = cls(known[order].astype(np.uint32), n[order])
        if place is None:
            return table, rank[at]
        place[known] = rank
        return table, place[at]

    def find(self, symbol: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The rank, in its class, of the id that holds the count ``v``."""
        if self.last > 15:  # the parts would be too many
            return np.searchsorted(self.keys, symbol << ID_BITS | v, side="right") - 1
        if self.starts is None:  # the rank at the start of each of 2, 4, 8 ... equal parts of a class
            c = np.arange(self.last + 1).repeat(2 << np.arange(self.last + 1))
            part = np.arange(2, 4 << self.last) - (2 << c)
            self.starts = np.append([0, 0], np.searchsorted(self.keys, c << ID_BITS | part << ID_BITS - 1 - c, side="right") - 1)
            self.ends = np.append(self.keys[1:], 1 << 62)
        rank = self.starts.take((2 << symbol) + (v >> ID_BITS - 1 - symbol), mode="clip")
        key = symbol << ID_BITS | v
        late = (self.ends.take(rank) <= key).nonzero()[0]
        if len(late):  # the next one most often
            at, key = rank[late] + 1, key[late]
            far = (self.ends.take(at, mode="clip") <= key).nonzero()[0]
            at[far] = np.searchsorted(self.keys, key[far], side="right") - 1
            rank[late] = at
        return rank

    def pack(self) -> bytes:
        steps = np.diff(self.ids.astype(np.int64), prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4)
        counts = self.counts.astype("<u4").view(np.uint8).reshape(-1, 4)
        data = zlib.compress(np.concatenate([steps, counts], axis=1).T.tobytes(), 9)  # byte by byte of all ids
        return TABLE.pack(MAGIC, len(self.ids), len(data)) + data

    @classmethod
    def unpack(cls, payload: bytes) -> tuple[Table, int]:
        """The table at the start of a payload, and where it ends."""
        magic, n, size = TABLE.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        end = TABLE.size + size
        try:
            planes = np.frombuffer(zlib.decompress(payload[TABLE.size:end]), np.uint8).reshape(8, n).T
        except (zlib.error, ValueError) as exc:
            raise ValueError("the table of a token segment is broken") from exc
        steps = np.ascontiguousarray(planes[:, :4]).view("<i4").reshape(-1)
        counts = np.ascontiguousarray(planes[:, 4:]).view("<u4").reshape(-1)
        return cls(np.cumsum(steps, dtype=np.int64).astype(np.uint32), counts.astype(np.int64)), end


def rounded(counts: np.ndarray) -> np.ndarray:
    """Counts with their two highest bits only: as good for coding, and smaller to send."""
    keep = np.maximum(class_of(counts.astype(np.int64)) - 1, 0)
    return np.where(counts > 0, (counts >> keep) << keep, 0)


class Order0:
    """Ids that neither proposal knew: an adaptive class of the rank, then the id in its class by the table."""

    def __init__(self, lanes: int, table: Table):
        self.table = table
        # classes above the segment's last one are never coded, and no bound depends on another
        self.width = next(w for w in (8, 16, CLASSES) if w > table.last)
        self.goal = np.ascontiguousarray(GOAL_CLASS[:, :self.width])
        self.up = np.tile(table.prime[:self.width], (lanes * (table.last + 1), 1))
        self.flat = self.up.reshape(-1)
        # rows in pieces as large as numpy puts in place one by one
        self.cells = self.flat.view(np.complex128).reshape(-1, self.width // 8)
        self.lane, self.lanes = np.arange(lanes, dtype=np.int64), lanes
        self.last = np.zeros(lanes, np.int64)

    def learn(self, k, symbol, rows=None) -> None:
        rows = self.up.take(k, axis=0) if rows is None else rows
        goal = self.goal.take(symbol, axis=0)
        goal -= rows
        goal >>= 5
        goal += rows
        cells = goal.reshape(-1).view(np.complex128).reshape(-1, self.width // 8)
        for i in range(self.width // 8):
            self.cells[:, i][k] = cells[:, i]

    def encode(self, writer: Writer, rank, there) -> None:
        """Code rows of ranks one after the other, where there are any."""
        t, (steps, n) = self.table, rank.shape
        symbols = t.classes.take(rank).astype(np.int64)
        before = np.concatenate([self.last[None, :n], symbols[:-1]])
        self.last[:n] = symbols[-1]
        before *= self.lanes
        before += self.lane[:n]
        at = before * self.width
        at += symbols
        cum, freq = np.empty((steps, 2, n), np.int64), np.empty((steps, 2, n), np.int64)
        for j in range(steps):
            cum[j, 0] = self.flat.take(at[j] - 1, mode="clip")
            freq[j, 0] = self.flat.take(at[j])
            self.learn(before[j], symbols[j])
        cum[:, 0] *= symbols > 0  # the first class begins at 0
        freq[:, 0] -= cum[:, 0]
        cum[:, 1], freq[:, 1] = t.cum.take(rank), t.freq.take(rank)
        none = ~there
        if none.any():
            for i, bits in enumerate((BITS, ID_BITS)):
                cum[:, i][none], freq[:, i][none] = 0, 1 << bits
        writer.put(cum.reshape(2 * steps, n), freq.reshape(2 * steps, n), (BITS, ID_BITS) * steps)

    def decode(self, reader: Reader, n: int):
        t = self.table
        dif, rng = reader.dif[:n], reader.rng[:n]
        k = self.last[:n] * self.lanes + self.lane[:n]
        rows = self.up.take(k, axis=0)
        r = rng >> BITS
        v = np.minimum(quotient(dif, r), 4095).astype(np.int16)
        ones = np.bitwise_count((rows <= v[:, None]).view(np.uint64))
        symbol = ones[:, 0].astype(np.int64)
        for i in range(1, ones.shape[1]):
            symbol += ones[:, i]
        np.minimum(symbol, t.last, out=symbol)
        at = k * self.width + symbol
        lo = self.flat.take(at - 1, mode="clip").astype(np.int64)
        lo *= symbol > 0
        dif -= r * lo
        np.multiply(r, self.flat.take(at) - lo, out=rng)
        reader.renorm(n)
        self.learn(k, symbol, rows)
        self.last[:n] = symbol
        r = rng >> ID_BITS
        rank = t.find(symbol, np.minimum(quotient(dif, r), (1 << ID_BITS) - 1))
        dif -= r * t.cum.take(rank)
        np.multiply(r, t.freq.take(rank), out=rng)
        reader.renorm(n)
        return rank


def quotient(dif, r):
    """``dif // r`` of numbers below 1 << 48 by floats, which hold them and their quotients' distance to the next number."""
    return (dif / r).astype(np.int64)


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """Code a segment of ids: its table, then blocks of ``block`` ids; all are full but perhaps the last."""
    total = len(ids)
    lanes = -(-total // block)
    if not lanes:
        return []
    table, ranks = Table.of(ids)
    by_lane = np.zeros((lanes, block + GAP), np.int32)
    by_lane[:-1, :block] = ranks[:(lanes - 1) * block].reshape(lanes - 1, block)
    by_lane[-1, :total - (lanes - 1) * block] = ranks[(lanes - 1) * block:]
    del ranks
    short = total - (lanes - 1) * block  # ids in the last lane
    steps = block if lanes > 1 else short
    writer, model = Writer(lanes, steps), Proposals(lanes)
    rest = np.zeros((lanes, block + GAP), bool)  # ids that neither proposal knew
    h1, h2 = np.zeros((STEPS + 1, lanes), np.uint16), np.zeros((STEPS + 2, lanes), np.uint16)  # of the ids before
    for t in range(0, steps, STEPS):
        now = np.ascontiguousarray(by_lane[:, t:min(t + STEPS, steps)].T)
        m = len(now)
        h1[1:m + 1], h2[2:m + 2] = hashes(now)
        at = np.empty((m, 2, lanes), np.int64)
        at[:, 0], at[:, 1] = slots(h1[:m], h2[:m])
        h1[0], h2[:2] = h1[m], h2[m:m + 2].copy()
        at *= lanes
        at += model.base
        fresh = now << 2
        v = np.empty((m, 2, lanes), np.int32)
        for j in range(m):
            model.table.take(at[j], out=v[j], mode="clip")
            model.learn_id(at[j], v[j], fresh[j])
        hit = (v ^ fresh[:, None]) < 4
        symbol = 2 - (hit[:, 0] | hit[:, 1]).view(np.uint8) - hit[:, 1].view(np.uint8)
        k = np.empty((m, 2, lanes), np.int64)
        k[:, 0] = (v[:, 1] & 3) * 2 + ((v[:, 0] ^ v[:, 1]) < 4)
        k[:, 1] = (v[:, 0] & 3) * 3 + np.concatenate([model.last[None], symbol[:-1]])
        model.last[:] = symbol[-1]
        k *= lanes
        k += model.ebase
        e = np.empty((m, 2, lanes), np.uint32)
        goal = GOALS.take(symbol)
        for j in range(m):
            model.est.take(k[j], out=e[j], mode="clip")
            model.learn_symbol(k[j], e[j], goal[j])
        diff, weight = e[:, 0] - e[:, 1], np.empty((m, lanes), np.int8)
        flat = symbol.reshape(-1)
        move = towards(diff.reshape(-1), flat, (flat < 2).nonzero()[0]).reshape(m, lanes)
        for j in range(m):
            weight[j] = model.weight
            model.learn_weight(move[j])
        a, b = mixed(diff, e[:, 1], weight.astype(np.uint32))
        cum = np.where(symbol == 2, b, np.where(symbol == 1, a, 0)).astype(np.int64)
        freq = np.where(symbol == 2, 4096, np.where(symbol == 1, b, a)).astype(np.int64) - cum
        if t + m > short:
            past = max(short - t, 0)
            cum[past:, -1], freq[past:, -1], symbol[past:, -1] = 0, 4096, 3
        writer.put(cum, freq, (BITS,) * m)
        rest[:, t:t + m] = (symbol == 2).T
    first = writer.words()
    many = rest.sum(axis=1)
    left = by_lane[rest]  # lane by lane
    del by_lane, writer, model, rest
    table = Table(table.ids, rounded(np.bincount(left, minlength=len(table.ids))))
    order = np.argsort(-many, kind="stable")  # lanes with most order-0 ids first, so that the active ones are a prefix
    depth = int(many.max())
    starts, counts = (np.cumsum(many) - many)[order], many[order]
    writer, zero = Writer(lanes, 2 * depth), Order0(lanes, table)
    for j in range(0, depth, STEPS):
        n = int(np.searchsorted(-counts, -j, side="left"))
        nth = np.arange(j, min(j + STEPS, depth))[:, None]
        zero.encode(writer, left.take(starts[:n] + nth, mode="clip"), nth < counts[:n])
    second = writer.words()
    back = np.argsort(order)
    out = [table.pack()]
    for i in range(lanes):
        n = block if i < lanes - 1 else short
        f, s = first[i], second[back[i]]
        crc = zlib.crc32(ids[i * block:i * block + n].astype("<u4").tobytes())
        out.append(HEAD.pack(MAGIC, n, int(many[i]), len(f) // 2, len(s) // 2, crc) + f + s)
    return out


def split_blocks(payload: bytes) -> list[tuple]:
    """(ids, order-0 ids, symbol stream, id stream, crc) of each of the blocks that follow a table."""
    found, at = [], 0
    while at < len(payload):
        magic, n, many, f, s, crc = HEAD.unpack_from(payload, at)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at += HEAD.size
        found.append((n, many, payload[at:at + 2 * f], payload[at + 2 * f:at + 2 * (f + s)], crc))
        at += 2 * (f + s)
    if at != len(payload):
        raise ValueError("a token block is cut off")
    return found


def decode_blocks(payload: bytes) -> np.ndarray:
    """The ids of a segment, as uint32; raises on a wrong checksum."""
    if not payload:
        return np.zeros(0, np.uint32)
    table, end = Table.unpack(payload)
    found = split_blocks(payload[end:])
    sizes = np.array([b[0] for b in found])
    many = np.array([b[1] for b in found])
    lanes, block = len(found), int(sizes.max())
    order = np.argsort(-many, kind="stable")
    depth = int(many.max())
    left = np.zeros(lanes * (depth + GAP), np.int32)  # lane by lane
    reader, zero = Reader([found[i][3] for i in order]), Order0(lanes, table)
    active = np.searchsorted(-many[order], -np.arange(depth), side="left")
    starts = np.arange(lanes) * (depth + GAP)
    for j in range(depth):
        n = int(active[j])
        left[starts[:n] + j] = zero.decode(reader, n)

    by_size = np.argsort(-sizes, kind="stable")
    taken = starts[np.argsort(order)[by_size]]
    reader, model = Reader([found[i][2] for i in by_size]), Proposals(lanes)
    x = np.zeros((lanes, block + GAP), np.int32)
    out, place = x.reshape(-1), by_size * (block + GAP)
    active = np.searchsorted(-sizes[by_size], -np.arange(block), side="left")
    h1 = h2 = second_last = np.zeros(lanes, np.uint16)
    at, k = np.empty((2, lanes), np.int64), np.empty((2, lanes), np.int64)
    for t in range(block):
        n = int(active[t])
        if n < at.shape[1]:  # some blocks have ended
            at, k, h1, h2, second_last = at[:, :n].copy(), k[:, :n].copy(), h1[:n], h2[:n], second_last[:n]
            model.base, model.ebase, model.weight, model.last = \
                model.base[:, :n], model.ebase[:, :n], model.weight[:n], model.last[:n]
        at[0], at[1] = slots(h1, h2)
        at *= lanes
        at += model.base
        v = model.table.take(at)
        sure = v & 3
        k[0] = sure[1] * 2 + ((v[0] ^ v[1]) < 4)
        k[1] = sure[0] * 3 + model.last
        k *= lanes
        k += model.ebase
        e = model.est.take(k)
        diff = e[0] - e[1]
        a, b = mixed(diff, e[1], model.weight.astype(np.uint32))
        dif, rng = reader.dif[:n], reader.rng[:n]
        r = rng >> BITS
        a, b = r * a, r * b  # as numbers of the range from here on
        symbol = (dif >= a).view(np.uint8) + (dif >= b)
        known = (symbol < 2).nonzero()[0]
        r <<= BITS
        width = r - b
        low = b
        now = left.take(taken[:n], mode="clip")
        taken[:n] += 1
        if len(known):
            second = symbol[known] > 0
            below, upto = a[known], b[known]
            width[known] = np.where(second, upto - below, below)
            low[known] = np.where(second, below, 0)
            now[known] = v[1 - second.view(np.int8), known] >> 2
            taken[known] -= 1
        dif -= low
        rng[:] = width
        reader.renorm(n)
        model.learn_id(at, v, now << 2)
        model.learn_symbol(k, e, GOALS.take(symbol))
        model.learn_weight(towards(diff, symbol, known))
        model.last = symbol
        h2 = second_last
        h1, second_last = hashes(now)
        out[place[:n] + t] = now
    parts = []
    for i, (n, _, _, _, crc) in enumerate(found):
        part = table.ids.take(x[i, :n])
        if zlib.crc32(part.astype("<u4").tobytes()) != crc:
            raise ValueError(f"checksum of block {i} does not match")
        parts.append(part)
    return np.concatenate(parts)
