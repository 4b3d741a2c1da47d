"""Adaptive context-mixing range coder for ids (of tokens, or of runs of tokens), many blocks in lockstep.

A block is a run of ids, coded on its own: its alphabet (distinct ids, ascending) is stored, all statistics start
afresh, and the caller keeps a CRC-32 of its ids. For every id the contexts of order 2 and order 1 each predict one id, with a
confidence; adaptive probabilities under both confidences mix the two predictions with the order-0 distribution,
whose counts are summed up anew as the block goes on. The mixture's interval drives a 64-bit range coder (32-bit
output units, carries added to the code before).

Blocks share no state, so the same step of many blocks is one numpy operation: lane i is block i. A call costs about as
much as a thousand elements, so both contexts share one table and one call, and counts are taken only where they are summed up.
"""

from __future__ import annotations

import numpy as np

SLOTS = 10  # log2 of the order-2 table's slots of a block
BITS, RATE = 16, 5  # of the adaptive probabilities
#: What the upper bounds of the shares (order 2, order 1) move to after a miss, a hit of order 1, a hit of order 2. The three shares
#: keep 64 parts each.
AIMS = np.array([[64, 128], [64, (1 << BITS) - 64], [(1 << BITS) - 128, (1 << BITS) - 64]], np.int32).view(np.int64).reshape(-1)
FIRST = np.array([1 << 14, 7 << 12], np.int32).view(np.int64)
LEAST, U16, U32, LOW16 = np.uint64(1 << 32), np.uint64(BITS), np.uint64(32), np.uint64(0xFFFF)
LONGEST = 8191  # ids in a block: tables of 16 bits hold position << 2 | confidence


class Lanes:
    """Statistics of all blocks, advanced one id at a time. Symbols are alphabet positions + 1; 0: none. What is kept for every
    symbol lies in one array, lane after lane."""

    def __init__(self, sizes: np.ndarray):
        n, self.sizes = len(sizes), sizes + 1
        lane, self.base0 = np.arange(n), np.cumsum(sizes + 1) - sizes - 1
        self.table = np.zeros((n << SLOTS) + int(self.sizes.sum()), np.int16)  # order 2, then order 1
        self.base2, self.base1, self.base16 = lane << SLOTS, (n << SLOTS) + self.base0, lane * 16
        self.odds = np.full(n * 16, FIRST[0])
        self.counts = np.ones(int(self.sizes.sum()), np.int64)
        self.counts[self.base0] = 0
        self.s1, self.s2, self.at = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((2, n), np.int64)
        self.sum()

    def sum(self) -> None:
        """``shares``: of every symbol the counts up to it in all lanes << 16 | its own."""
        shares = np.cumsum(self.counts)
        ends = shares[self.base0 + self.sizes - 1]
        self.total = np.diff(ends, prepend=0)
        self.start, self.total = (ends - self.total).astype(np.uint64), self.total.astype(np.uint64)
        shares -= self.counts
        shares <<= 16
        shares |= self.counts
        self.shares = shares.view(np.uint64)

    def count(self, s: np.ndarray) -> None:
        """Counts the symbols of some steps (a row each), and sums up."""
        self.counts += np.bincount((s + self.base0).reshape(-1), minlength=len(self.counts))
        self.sum()

    def predict(self, n: int) -> None:
        """Of the first ``n`` lanes: predicted symbols (order 2, order 1), and the upper bounds of their shares."""
        at = self.at[:, :n]
        np.multiply(self.s1[:n], 40503, out=at[0])
        at[0] ^= self.s2[:n]
        at[0] &= (1 << SLOTS) - 1
        at[0] += self.base2[:n]
        np.add(self.base1[:n], self.s1[:n], out=at[1])
        self.entry = self.table.take(at)
        self.guess, self.sure = self.entry >> 2, self.entry & 3
        # the same guess twice is one of order 2
        self.differ = self.guess[0] != self.guess[1]
        mix = self.sure[1] * self.differ
        mix += self.sure[0] << 2
        self.mix = self.base16[:n] + mix
        odds = self.odds.take(self.mix)
        self.bounds = odds.view(np.int32).reshape(n, 2)
        wide = self.bounds.astype(np.uint64)
        self.b2, self.b12 = wide[:, 0], wide[:, 1]

    def learn(self, s: np.ndarray, short: np.ndarray, hits: np.ndarray) -> None:
        n = len(s)
        aims = AIMS.take(hits).view(np.int32).reshape(n, 2)
        aims -= self.bounds
        aims >>= RATE
        aims += self.bounds
        self.odds[self.mix] = aims.view(np.int64).reshape(-1)
        match = self.guess == short
        keep = self.sure > 1
        keep |= match
        step = match.view(np.int8) * np.int8(2)
        step -= 1
        step -= (match & (self.sure == 3)).view(np.int8)
        self.entry += step
        self.table[self.at[:, :n]] = np.where(keep, self.entry, short << 2 | 1)
        self.s2[:n], self.s1[:n] = self.s1[:n], s


def sum_at(step: int) -> bool:
    """Order-0 sums are renewed after 16, 32, 64, ... ids."""
    return step >= 16 and step & (step - 1) == 0


def alphabets(blocks: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct ids of each block, ascending, and each id's position among them + 1, a column for each block."""
    top = max(int(b.max(initial=0)) for b in blocks) + 1
    known, place = [], np.zeros(min(top, 1 << 22), np.int16)
    out = np.zeros((len(blocks), len(blocks[0]) | 33), np.int16)  # columns not a power of two apart
    for b, row in zip(blocks, out, strict=True):
        x = np.sort(b)
        distinct = x[np.concatenate([[True], x[1:] != x[:-1]])]
        if top > 1 << 22:
            row[:len(b)] = np.searchsorted(distinct, b) + 1
        else:
            place[distinct] = np.arange(1, len(distinct) + 1)
            row[:len(b)] = place[b]
        known.append(distinct)
    return known, np.ascontiguousarray(out.T[:len(blocks[0])])


def parts(hit2: np.ndarray, hit: np.ndarray, x2: np.ndarray, x12: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and size of the interval: order 2 first, then order 1, the rest is for order 0."""
    skip = np.where(hit, x2, x12)
    skip[hit2] = 0
    size = np.where(hit2, x2, np.where(hit, x12, span))
    size -= skip
    return skip, size


def encode(blocks: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """(alphabet, code) of each block of uint32 ids; block lengths differ by one at most, longer blocks first."""
    n, steps, full = len(blocks), len(blocks[0]), len(blocks[-1])
    last = sum(len(b) == steps for b in blocks)
    if steps > LONGEST:
        raise ValueError(f"a block has at most {LONGEST} ids")
    known, s_all = alphabets(blocks)
    lanes = Lanes(np.array([len(k) for k in known]))
    low, span = np.zeros(n, np.uint64), np.full(n, 2**64 - 1, np.uint64)
    width = steps + 4
    out, counted = np.zeros(n * width, np.uint32), 0
    starts = np.arange(n) * width
    pos = starts.copy()

    def carry(at):
        while len(at):
            out[at] += np.uint32(1)
            at = at[out[at] == 0] - 1
    for t in range(steps):
        m = n if t < full else last
        short = s_all[t, :m]
        s = short.astype(np.int64)
        lanes.predict(m)
        wide = span[:m]
        r = wide >> U16
        x2, x12 = r * lanes.b2, r * lanes.b12
        hit2 = short == lanes.guess[0]
        hit = short == lanes.guess[1]
        hit |= hit2
        skip, size = parts(hit2, hit, x2, x12, wide)
        i = np.flatnonzero(~hit)
        share = lanes.shares.take(lanes.base0.take(i) + s.take(i))
        r = size.take(i) // lanes.total.take(i)
        skip[i] += r * ((share >> U16) - lanes.start.take(i))
        size[i] = r * (share & LOW16)
        low[:m] += skip
        carry(pos[np.flatnonzero(low[:m] < skip)] - 1)
        span[:m] = size
        i = np.flatnonzero(size < LEAST)
        x, at = low.take(i), pos.take(i)
        out[at] = x >> U32
        pos[i] = at + 1
        low[i] = x << U32
        span[i] = size.take(i) << U32
        lanes.learn(s, short, hit.view(np.int8) + hit2.view(np.int8))
        if sum_at(t + 1) and t + 1 < full:
            lanes.count(s_all[counted:t + 1])
            counted = t + 1
    # the last unit is the next multiple of it, within every range left
    x = low + (LEAST - np.uint64(1))
    carry(pos[np.flatnonzero(x < low)] - 1)
    out[pos] = x >> U32
    pos += 1
    out = out.astype("<u4", copy=False)
    return [(_pack_alphabet(k), out[a:b].tobytes()) for k, a, b in zip(known, starts.tolist(), pos.tolist(), strict=True)]


def decode(coded: list[tuple[bytes, bytes]], lengths: list[int]) -> list[np.ndarray]:
    """The blocks of uint32 ids; ``lengths`` differ by one at most, longer ones first."""
    known = [_unpack_alphabet(a) for a, _ in coded]
    n, steps, full = len(coded), lengths[0], lengths[-1]
    last = sum(x == steps for x in lengths)
    sizes = np.array([len(k) for k in known])
    units = np.frombuffer(b"".join(c + bytes(12) for _, c in coded), "<u4").astype(np.uint64)
    nxt = np.concatenate([[0], np.cumsum([len(c) // 4 + 3 for _, c in coded])[:-1]]).astype(np.int64)
    lanes = Lanes(sizes)
    code, span = units[nxt] << U32 | units[nxt + 1], np.full(n, 2**64 - 1, np.uint64)
    nxt += 2
    out, counted = np.zeros((steps, n), np.int16), 0
    symbols = (np.arange(len(lanes.counts)) - np.repeat(lanes.base0, lanes.sizes)).astype(np.int16)
    unit = np.repeat(symbols, lanes.counts)  # the symbol of every unit of the order-0 totals
    for t in range(steps):
        m = n if t < full else last
        lanes.predict(m)
        wide, c = span[:m], code[:m]
        r = wide >> U16
        x2, x12 = r * lanes.b2, r * lanes.b12
        hit2, hit = c < x2, c < x12
        skip, size = parts(hit2, hit, x2, x12, wide)
        c -= skip
        short = np.where(hit2, lanes.guess[0], lanes.guess[1])
        i = np.flatnonzero(~hit)
        x, start, total = c.take(i), lanes.start.take(i), lanes.total.take(i)
        r = size.take(i) // total
        got = unit.take((np.minimum(x // r, total - np.uint64(1)) + start).view(np.int64))
        short[i] = got
        share = lanes.shares.take(lanes.base0.take(i) + got)
        c[i] = x - r * ((share >> U16) - start)
        size[i] = r * (share & LOW16)
        span[:m] = size
        i = np.flatnonzero(size < LEAST)
        k = nxt.take(i)
        code[i] = code.take(i) << U32 | units.take(k)
        nxt[i] = k + 1
        span[i] = size.take(i) << U32
        out[t, :m] = short
        lanes.learn(short.astype(np.int64), short, hit.view(np.int8) + hit2.view(np.int8))
        if sum_at(t + 1) and t + 1 < full:
            lanes.count(out[counted:t + 1])
            counted = t + 1
            unit = np.repeat(symbols, lanes.counts)
    ids = np.concatenate(known)
    begin = np.cumsum(sizes) - sizes - 1
    return [ids[row[:x].astype(np.int64) + b] for b, row, x in zip(begin.tolist(), np.ascontiguousarray(out.T), lengths, strict=True)]


def _pack_alphabet(known: np.ndarray) -> bytes:
    """Gaps of the ids, two bytes each where that is enough."""
    gaps = np.diff(known, prepend=known.dtype.type(0))
    wide = int(gaps.max(initial=0) > 0xFFFF)
    return bytes([wide]) + gaps.astype("<u4" if wide else "<u2").tobytes()


def _unpack_alphabet(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, "<u4" if data[0] else "<u2", offset=1), dtype=np.uint32)
