"""External induced sorting of a text's suffixes, with their common prefixes.

A suffix is of type S when it is smaller than the one behind it, else of type L;
S* are the S behind an L.  S* substrings are sorted and numbered, the string of
their numbers is sorted by recursion, and from the order of the S* suffixes first
all L and then all S suffixes are induced: taken in order, a suffix sends the one
before it to the queue of that one's first symbol, as a tuple of its position and
the rank of the suffix that sent it.  A queue gives back what came first, so
tuples leave it by (symbol, rank): it is a priority queue whose keys need no
comparison.  Queues keep a bounded number of tuples in memory and the rest in an
unnamed temporary file of the task, which is gone when the sort ends.

Common prefixes are induced along: two neighbours in a queue agree in one symbol
more than the suffixes that sent them, and these in the least common prefix
between their ranks.

Orders hold for the first ``reach`` symbols, ties beyond are arbitrary: suffixes
that agree in ``reach`` symbols are next to each other.  Common prefixes count up
to ``reach``.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Entries that all queues of one sort may keep in memory.
MEMORY = 1 << 24
#: Above so many distinct symbols a level is ordered by doubling instead of queues.
SYMBOLS = 2048


class Queues:
    """First-in-first-out queues of tuples (position, rank) by symbol, spilled beyond ``memory`` tuples."""

    def __init__(self, memory: int):
        self.memory, self.held = memory, 0
        self.parts: dict[int, list] = {}
        self.file = None

    def put(self, symbol: np.ndarray, position: np.ndarray, rank: np.ndarray) -> None:
        """Send each tuple to its symbol's queue, in this order."""
        if not len(position):
            return
        order = np.argsort(symbol, kind="stable")
        symbol, tuples = symbol[order], np.stack([position[order], rank[order]])
        first = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
        for c, part in zip(symbol[first].tolist(), np.split(tuples, first[1:], axis=1)):
            self.parts.setdefault(c, []).append(part)
        self.held += len(position)
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts.values():
            for i, p in enumerate(parts):
                if isinstance(p, np.ndarray):
                    at = self.file.tell()
                    np.ascontiguousarray(p).tofile(self.file)
                    parts[i] = (at, p.size, p.dtype)
        self.held = 0

    def take(self, symbol: int) -> np.ndarray | None:
        """All of a symbol's tuples, first come first, as two rows; the queue is then empty."""
        parts = self.parts.pop(symbol, None)
        if not parts:
            return None
        for i, p in enumerate(parts):
            if isinstance(p, tuple):
                self.file.seek(p[0])
                parts[i] = np.fromfile(self.file, p[2], p[1]).reshape(2, -1)
            else:
                self.held -= p.shape[1]
        return parts[0] if len(parts) == 1 else np.concatenate(parts, axis=1)


def s_types(x: np.ndarray) -> np.ndarray:
    """True for suffixes of type S; the last symbol must be the least and unique."""
    n = len(x)
    out = np.empty(n, bool)
    out[-1] = True
    rises = x[:-1] < x[1:]
    differs = x[:-1] != x[1:]
    differs[-1] = True   # the last pair never is equal
    # equal neighbours take the type of the next place that differs
    at = np.where(differs, np.arange(n - 1), n)
    nxt = np.minimum.accumulate(at[::-1])[::-1]
    out[:-1] = rises[nxt]
    return out


def _names(x: np.ndarray, is_s: np.ndarray, stars: np.ndarray, reach: int) -> np.ndarray:
    """Numbers of the S* substrings in their order (types break ties; at most ``reach`` symbols)."""
    y = (x.astype(np.int64) << 1) | is_s
    length = np.minimum(np.diff(stars, append=len(x) - 1) + 1, reach)
    bits = int(y.max()).bit_length()
    rank = np.zeros(len(stars), np.int64)
    done, most = 0, int(length.max())
    while done < most:
        per = max(1, (62 - int(rank.max()).bit_length()) // bits)
        key = rank
        for k in range(done, min(done + per, most)):
            at = np.minimum(stars + k, len(x) - 1)
            key = (key << bits) | np.where(length > k, y[at], 0)
        rank = np.unique(key, return_inverse=True)[1]
        done += per
        if int(rank.max()) + 1 == len(rank):
            break
    return rank


def _doubling(names: np.ndarray, reach: int) -> np.ndarray:
    """The order of a string's suffixes by at least ``reach`` symbols."""
    rank, have, n = names.astype(np.int64) + 1, 1, len(names)
    while have < reach and int(rank.max()) < n:
        ahead = np.zeros(n, np.int64)
        ahead[:-have] = rank[have:] if have < n else 0
        rank = np.unique(rank * (int(rank.max()) + 1) + ahead, return_inverse=True)[1] + 1
        have *= 2
        if have >= n:
            break
    return np.argsort(rank, kind="stable")


def between(common: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The least common prefix between each rank and the next one (ranks rise)."""
    if len(ranks) < 2:
        return common[:0]
    return np.minimum.reduceat(common[int(ranks[0]) + 1:int(ranks[-1]) + 1], ranks[:-1] - ranks[0])


def _agree_in(x: np.ndarray, a: int, b: int, most: int) -> int:
    """The common prefix of two suffixes, symbol by symbol."""
    n = 0
    while n < most and max(a, b) + n < len(x) and x[a + n] == x[b + n]:
        n += 1
    return n


class _Scan:
    """One pass over the suffixes: what has been taken, in order, with common prefixes."""

    def __init__(self, x: np.ndarray, is_s: np.ndarray, kind: bool, memory: int, reach: int, dtype, carry: bool):
        self.x, self.is_s, self.kind, self.reach, self.carry = x, is_s, kind, reach, carry
        self.queues = Queues(memory)
        self.n = 0
        self.common = np.zeros(len(x) + 1 if carry else 0, np.uint8)
        self.dtype = dtype

    def send(self, positions: np.ndarray, common: np.ndarray | None, symbol: int | None) -> np.ndarray:
        """Take these suffixes next; send those before them.  Those with ``symbol``
        come back as tuples, since its queue is being emptied."""
        if self.carry:
            self.common[self.n:self.n + len(positions)] = common
        ranks = np.arange(self.n, self.n + len(positions), dtype=self.dtype)
        self.n += len(positions)
        some = positions > 0
        p, ranks = positions[some] - 1, ranks[some]
        some = self.is_s[p] == self.kind
        p, ranks = p[some], ranks[some]
        to = self.x[p]
        if symbol is None:
            self.queues.put(to, p, ranks)
            return p[:0]
        same = to == symbol
        self.queues.put(to[~same], p[~same], ranks[~same])
        return np.stack([p[same], ranks[same]])

    def drain(self, symbol: int, tuples: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Empty a symbol's queue; positions in order, each one's common prefix with the one before."""
        positions, commons, last = [], [], None
        while tuples is not None and tuples.shape[1]:
            p, ranks = tuples
            common = None
            if self.carry:
                rising = ranks if last is None else np.concatenate([[last], ranks])
                common = np.minimum(between(self.common, rising), self.reach - 1) + np.uint8(1)
                common = common if last is not None else np.concatenate([np.zeros(1, np.uint8), common])
                last = ranks[-1]
                commons.append(common)
            positions.append(p)
            tuples = self.send(p, common, symbol)
        if not positions:
            return np.empty(0, self.dtype), np.empty(0, np.uint8)
        return np.concatenate(positions), np.concatenate(commons) if self.carry else np.empty(0, np.uint8)


def _induce(x: np.ndarray, is_s: np.ndarray, stars: np.ndarray, star_common: np.ndarray | None, memory: int,
            reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array from the sorted S* suffixes and, from their common prefixes
    (each with the one before), those of all."""
    n, carry = len(x), star_common is not None
    symbols = np.unique(x)
    star_symbol = x[stars]
    a, b = np.searchsorted(star_symbol, symbols), np.searchsorted(star_symbol, symbols, side="right")
    scan = _Scan(x, is_s, False, memory, reach, stars.dtype, carry)
    larger = {}
    for c, lo, hi in zip(symbols.tolist(), a.tolist(), b.tolist()):
        own, common = scan.drain(c, scan.queues.take(c))
        larger[c] = own, common
        if hi > lo:
            joined = None
            if carry:
                joined = star_common[lo:hi].copy()
                joined[0] = _agree_in(x, int(own[-1]), int(stars[lo]), reach) if len(own) else 0
            scan.send(stars[lo:hi], joined, None)
    scan = _Scan(x, is_s, True, memory, reach, stars.dtype, carry)
    out, at = np.empty(n, stars.dtype), n
    for c in symbols[::-1].tolist():
        tuples = scan.queues.take(c)
        if c == symbols[0]:   # the last symbol stands alone
            tuples = np.array([[n - 1], [0]], stars.dtype)
        small, _ = scan.drain(c, tuples)
        out[at - len(small):at] = small[::-1]
        at -= len(small)
        own, common = larger.pop(c)
        if not len(own):
            continue
        out[at - len(own):at] = own
        at -= len(own)
        joined = None
        if carry:
            edge = _agree_in(x, int(small[-1]), int(own[-1]), reach) if len(small) else 0
            joined = np.concatenate([np.array([edge], np.uint8), common[::-1][:-1]])
        scan.send(own[::-1], joined, None)
    if not carry:
        return out, np.empty(0, np.uint8)
    return out, np.concatenate([np.zeros(1, np.uint8), scan.common[1:n][::-1]])


def star_prefixes(x: np.ndarray, stars: np.ndarray, reach: int) -> np.ndarray:
    """Common prefix, up to ``reach``, of each sorted S* suffix with the one before it."""
    out = np.zeros(len(stars), np.uint8)
    live = np.arange(1, len(stars))
    for k in range(reach):
        i, j = stars[live].astype(np.int64) + k, stars[live - 1].astype(np.int64) + k
        inside = np.maximum(i, j) < len(x)
        live = live[inside][x[i[inside]] == x[j[inside]]]
        if not len(live):
            break
        out[live] = k + 1
    return out


def suffix_array(x: np.ndarray, reach: int, memory: int = MEMORY, carry: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a text in suffix order by at least ``reach`` symbols, and the
    common prefix of each with the one before it, up to ``reach`` (less than 256;
    not made without ``carry``).

    ``x``: integers from 1 on, with a last symbol 0 that occurs only there.
    """
    if carry and reach > 255:
        raise ValueError("common prefixes are counted up to 255")
    kind = np.int32 if len(x) < 1 << 31 else np.int64
    if len(x) < 3:
        return np.argsort(x, kind="stable").astype(kind), np.zeros(len(x), np.uint8)
    is_s = s_types(x)
    stars = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(kind)
    names = _names(x, is_s, stars, reach + 1)
    n_names = int(names.max()) + 1
    if n_names == len(names):
        order = np.argsort(names, kind="stable")
    elif n_names <= SYMBOLS:
        # S* are two symbols apart at least
        order = suffix_array(np.append(names + 1, 0).astype(np.int32), reach // 2 + 1, memory, False)[0][1:]
    else:
        order = _doubling(names, reach // 2 + 1)
    stars = stars[order]
    return _induce(x, is_s, stars, star_prefixes(x, stars, reach) if carry else None, memory, reach)
