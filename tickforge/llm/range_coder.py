"""Context-mixing range coder for token ids: order-2, order-1 and order-0 predictions, one adaptive state a block.

The next id is predicted by what followed the last two ids (order 2), by what followed the last one (order 1), and by
the counts of the block so far (order 0). The distribution that is coded is their mixture: learned weights for the two
predicted ids, chosen by how often each prediction has held, and the rest of the mass dealt out by the counts, with an
escape to even odds for ids that the block has not had yet. Everything is integer arithmetic, so all machines agree.

Blocks start from nothing and don't know each other. That makes them independent, and lets numpy code many blocks at a
time: each step codes the next id of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Ids of a block. Order 0 has counts of at most half of them, which must be under 1 << COUNTS.
BLOCK = 4096
#: Bits of the whole distribution and of its order-0 part; slots of the tables of order 2 and order 1; and how fast
#: weights learn.
TOTAL, COUNTS, SLOTS, RATE = 24, 12, 10, 5
#: Least size of a predicted id's interval; what the weights of both predictions share at most.
LEAST, MOST = 1 << 8, (1 << TOTAL) - (1 << 16)
#: What a weight gains when its prediction holds; it loses 1 / 2**RATE of itself each time, rounded down.
STEP = (MOST >> RATE) - 2
#: Counts are taken anew when a block has so many ids, and whenever it has doubled.
FIRST = 16
#: Order-0 tables of at most so many entries are filled at a time.
DENSE = 1 << 22
#: Steps for which intervals are looked up at a time.
AHEAD = 1024

U = np.uint64
LOW32 = U(0xFFFFFFFF)


def _refresh(n: int) -> list[int]:
    """Positions at which order 0 is counted anew."""
    at, out = FIRST, [0]
    while at < n:
        out.append(at)
        at *= 2
    return [*out, n]


class _Counts:
    """Order 0 of all blocks after their first t ids: intervals of the ids seen, and of the escape, in 1 << COUNTS."""

    def __init__(self, seen: np.ndarray):
        n, t = seen.shape
        s = np.sort(seen, axis=1)
        first = np.ones((n, t), bool)
        first[:, 1:] = s[:, 1:] != s[:, :-1]
        distinct = first.sum(1)
        #: Where each block's entries begin; the last entry of a block is its escape.
        self.base = np.concatenate([[0], np.cumsum(distinct + 1)])
        at = np.flatnonzero(first.ravel()).astype(np.int32)
        block = np.repeat(np.arange(n, dtype=np.int32), distinct)
        entry = np.arange(len(at), dtype=np.int32) + block
        count = np.empty(len(at), np.int32)
        count[:-1] = np.diff(at)
        if len(at):
            count[-1] = n * t - at[-1]
        last = self.base[1:] - 1
        self.ids = np.full(self.base[-1], -1, np.int32)
        self.ids[entry] = s.ravel()[at]
        self.size = np.zeros(self.base[-1], np.int32)
        distinct = distinct.astype(np.int32)
        room = (1 << COUNTS) - distinct - 1
        self.size[entry] = 1 + count * room[block] // (t + distinct[block])
        sums = np.concatenate([[0], np.cumsum(self.size, dtype=np.int64)])
        self.size[last] = (1 << COUNTS) - (sums[last] - sums[self.base[:-1]])
        sums = np.cumsum(self.size, dtype=np.int64) - self.size
        self.start = (sums - np.repeat(sums[self.base[:-1]], distinct + 1)).astype(np.int32)
        self.block, self.entry = block, entry

    def entries(self, ids: np.ndarray, vocabulary: int) -> np.ndarray:
        """The entry of each of ids (blocks, times), the escape for ids not seen."""
        out = np.empty(ids.shape, np.int32)
        step = max(1, DENSE // vocabulary)
        for a in range(0, len(ids), step):
            b = min(len(ids), a + step)
            dense = np.repeat((self.base[a + 1 : b + 1] - 1).astype(np.int32), vocabulary)
            e = self.entry[np.searchsorted(self.block, a) : np.searchsorted(self.block, b)]
            dense[self.ids[e] + (np.repeat(np.arange(a, b), np.diff(self.base[a : b + 1]) - 1) - a) * vocabulary] = e
            out[a:b] = dense[ids[a:b] + (np.arange(b - a) * vocabulary)[:, None]]
        return out

    def lookup(self) -> np.ndarray:
        """Entries by block and place in the distribution, counted from the block's first one."""
        n = len(self.base) - 1
        rank = np.arange(self.base[-1]) - np.repeat(self.base[:-1], np.diff(self.base))
        return np.repeat(rank.astype(np.uint16), self.size).reshape(n, 1 << COUNTS)


class _Mixer:
    """Order-2 and order-1 tables and the weights of n blocks."""

    def __init__(self, n: int):
        self.two, self.one = (np.zeros(n << SLOTS, np.uint32) for _ in range(2))
        self.weight2, self.weight1 = (np.full(n * 32, v, np.int64) for v in (1 << TOTAL - 1, 1 << TOTAL - 2))
        self.a = self.b = np.zeros(n, np.uint32)
        self.shrink(n)

    def shrink(self, n: int) -> None:
        """Go on with the first n blocks."""
        self.at, self.gates = np.arange(n, dtype=np.int64) << SLOTS, np.arange(n, dtype=np.int64) * 32
        self.a, self.b = self.a[:n], self.b[:n]

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the intervals of the predicted ids; look_up has what they are."""
        shift = np.uint32(32 - SLOTS)
        h1 = self.a * np.uint32(2654435761)
        self.h1 = (h1 >> shift) + self.at
        self.h2 = (((h1 ^ self.b) * np.uint32(2246822519)) >> shift) + self.at
        self.s1, self.s2 = self.one[self.h1], self.two[self.h2]
        same = (self.s1 ^ self.s2) < 4
        self.gate = ((((self.s2 & 3) << 2 | self.s1 & 3) << 1) | same) + self.gates
        self.w2, self.w1 = self.weight2[self.gate], self.weight1[self.gate]
        return self.w2 + LEAST, self.w1 + LEAST

    def update(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """ids: uint32, one for each block; hit1 leaves out those that order 2 predicts."""
        self.weight2[self.gate] = self.w2 - (self.w2 >> RATE) + hit2 * STEP
        self.weight1[self.gate] = self.w1 - (self.w1 >> RATE) + hit1 * STEP
        fresh = ((ids + 1) << 2) | 1
        for table, h, s in ((self.two, self.h2, self.s2), (self.one, self.h1, self.s1)):
            # A prediction that held counts up to 3, any other is replaced.
            table[h] = np.maximum(fresh, np.minimum(s + 1, s | 3) * ((s ^ fresh) < 4))
        self.a, self.b = ids, self.a


def encode_blocks(ids: np.ndarray, lengths: np.ndarray, vocabulary: int) -> list[bytes]:
    """The code of each block: rows of ids (blocks, BLOCK) of which the first lengths count, longest first."""
    n = len(ids)
    longest = int(lengths[0]) if n else 0
    out = np.zeros((n, longest * 2 + 4), np.uint32)
    width, flat = out.shape[1], out.ravel()
    place = np.arange(n, dtype=np.int64) * width
    low, span = np.zeros(n, U), np.full(n, 0xFFFFFFFFFFFFFFFF, U)
    mix, live = _Mixer(n), n

    def settle(rows: np.ndarray) -> None:
        """Write the first 32 bits of low for rows whose span is too short."""
        lo, sp = low[rows], span[rows]
        sp = np.where((lo ^ (lo + sp)) >> U(32) != 0, (~lo + U(1)) & LOW32, sp)
        at = place[rows]
        flat[at] = lo >> U(32)
        place[rows] = at + 1
        low[rows], span[rows] = lo << U(32), sp << U(32)

    marks = _refresh(longest)
    for begin, end in zip(marks, marks[1:]):
        live = int(np.searchsorted(-lengths, -begin, "left"))
        counts = _Counts(ids[:live, :begin])
        for t in range(begin, end):
            if (t - begin) % AHEAD == 0:
                ahead = t
                now = ids[:live, t : min(end, t + AHEAD)]
                entries = counts.entries(now, vocabulary)
                starts, sizes = (x[entries.T] for x in (counts.start, counts.size))
                escapes = entries.T == counts.base[1 : live + 1] - 1
                now = now.T.astype(np.uint32, order="C")
                del entries
            going = int(np.searchsorted(-lengths[:live], -t, "left")) if t >= lengths[live - 1] else live
            if going != len(mix.a):
                mix.shrink(going)
            x = now[t - ahead, :going]
            z2, z1 = mix.predict()
            hit2 = (mix.s2 >> 2) == x + 1
            hit1 = ((mix.s1 >> 2) == x + 1) & ~hit2
            both = z2 + z1
            rest = (1 << TOTAL) - both
            s0 = starts[t - ahead, :going]
            a = (s0 * rest) >> COUNTS
            z = (((s0 + sizes[t - ahead, :going]) * rest) >> COUNTS) - a
            a += both
            hits = np.flatnonzero(hit2 | hit1)
            if len(hits):
                two = hit2[hits]
                a[hits] = np.where(two, 0, z2[hits])
                z[hits] = np.where(two, z2[hits], z1[hits])
            a, z = a.view(U), z.view(U)
            r = span[:going] >> U(TOTAL)
            low[:going] += r * a
            r *= z
            span[:going] = r
            rows = np.flatnonzero(r <= LOW32)
            if len(rows):
                settle(rows)
            rows = np.flatnonzero(escapes[t - ahead, :going] & ~hit2 & ~hit1)
            if len(rows):
                r = span[rows] // U(vocabulary)
                low[rows] += r * x[rows].astype(U)
                span[rows] = r
                rows = rows[r <= LOW32]
                if len(rows):
                    settle(rows)
            mix.update(x, hit2, hit1)
    for shift in (32, 0):
        flat[place] = (low >> U(shift)) & LOW32
        place += 1
    used = place - np.arange(n, dtype=np.int64) * width
    return [out[k, :m].astype("<u4").tobytes() for k, m in enumerate(used.tolist())]


def decode_blocks(codes: list[bytes], lengths: np.ndarray, vocabulary: int) -> np.ndarray:
    """The ids (blocks, ids) of encode_blocks; lengths are descending. Broken codes give some ids, but always end."""
    n = len(codes)
    longest = int(lengths[0]) if n else 0
    ids = np.zeros((n, longest), np.int32)
    sizes = np.array([len(c) // 4 for c in codes], np.int64)
    words = np.concatenate([np.frombuffer(b"".join(codes), "<u4").astype(U), np.zeros(2, U)])
    place = np.cumsum(sizes) - sizes
    top = len(words) - 1
    low, span = np.zeros(n, U), np.full(n, 0xFFFFFFFFFFFFFFFF, U)
    code = (words[np.minimum(place, top)] << U(32)) | words[np.minimum(place + 1, top)]
    place += 2
    mix = _Mixer(n)

    def settle(rows: np.ndarray) -> None:
        lo, sp = low[rows], span[rows]
        sp = np.where((lo ^ (lo + sp)) >> U(32) != 0, (~lo + U(1)) & LOW32, sp)
        at = place[rows]
        code[rows] = (code[rows] << U(32)) | words[np.minimum(at, top)]
        place[rows] = at + 1
        low[rows], span[rows] = lo << U(32), np.maximum(sp, U(1)) << U(32)

    marks = _refresh(longest)
    for begin, end in zip(marks, marks[1:]):
        live = int(np.searchsorted(-lengths, -begin, "left"))
        counts = _Counts(ids[:live, :begin])
        lookup, base = counts.lookup().ravel(), counts.base[:live]
        escape = counts.base[1 : live + 1] - 1
        corner = np.arange(live, dtype=np.int64) << COUNTS
        for t in range(begin, end):
            going = int(np.searchsorted(-lengths[:live], -t, "left")) if t >= lengths[live - 1] else live
            if going != len(mix.a):
                mix.shrink(going)
            z2, z1 = mix.predict()
            both = z2 + z1
            rest = (1 << TOTAL) - both
            r = span[:going] >> U(TOTAL)
            v = np.minimum((code[:going] - low[:going]) // r, U((1 << TOTAL) - 1)).astype(np.int64)
            hit2 = v < z2
            hit1 = (v < both) & ~hit2
            # Places of hits are looked up too, and replaced.
            w = np.maximum(v - both, 0)
            e = lookup[corner[:going] + (((w + 1) << COUNTS) - 1) // rest] + base[:going]
            s0 = counts.start[e]
            a = (s0 * rest) >> COUNTS
            z = (((s0 + counts.size[e]) * rest) >> COUNTS) - a
            x = counts.ids[e].astype(np.uint32)
            a += both
            hits = np.flatnonzero(v < both)
            if len(hits):
                two = hit2[hits]
                a[hits] = np.where(two, 0, z2[hits])
                z[hits] = np.where(two, z2[hits], z1[hits])
                x[hits] = (np.where(two, mix.s2[hits], mix.s1[hits]) >> 2) - np.uint32(1)
            a, z = a.view(U), z.view(U)
            low[:going] += r * a
            r *= z
            span[:going] = r
            rows = np.flatnonzero(r <= LOW32)
            if len(rows):
                settle(rows)
            rows = np.flatnonzero((e == escape[:going]) & ~hit2 & ~hit1)
            if len(rows):
                r = span[rows] // U(vocabulary)
                v = np.minimum((code[rows] - low[rows]) // r, U(vocabulary - 1))
                x[rows] = v
                low[rows] += r * v
                span[rows] = r
                rows = rows[r <= LOW32]
                if len(rows):
                    settle(rows)
            ids[:going, t] = x
            mix.update(x, hit2, hit1)
    return ids


def to_blocks(ids: np.ndarray, vocabulary: int) -> Iterator[tuple[int, bytes]]:
    """(number of ids, code) of each block of a sequence of ids."""
    n = -(-len(ids) // BLOCK)
    rows = np.zeros((n, BLOCK), np.int32)
    rows.ravel()[: len(ids)] = ids
    lengths = np.full(n, BLOCK, np.int64)
    if n:
        lengths[-1] = len(ids) - (n - 1) * BLOCK
    yield from zip(lengths.tolist(), encode_blocks(rows[:, : int(lengths[0]) if n else 0], lengths, vocabulary))
