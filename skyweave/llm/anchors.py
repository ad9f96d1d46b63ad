"""Prefix polynomial hashes of byte strings, anchors that equal windows share, and a suffix sort that compares by hashes."""

from __future__ import annotations

import numpy as np

_random = np.random.default_rng(20_011)
#: Each byte value stands for a random number, so that the polynomial does not see runs of small ones.
VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    filled = 1
    while filled < n:  # doubling: the second half is the first, times base ** filled
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * (out[filled - 1 : filled] * base)
        filled += more
    return out


_powers: dict[str, np.ndarray] = {}


def tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if len(_powers.get("up", ())) < n:
        _powers["up"], _powers["down"] = powers(BASE, n), powers(INVERSE, n)
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Hashes:
    """Prefix hashes of a buffer: the hash of any stretch in constant time."""

    def __init__(self, data: np.ndarray):
        up, self.down = tables(len(data) + 1)
        self.data = data
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(VALUE[data] * up[: len(data)], out=self.prefix[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of data[lo:hi], for arrays of places; equal strings have equal hashes wherever they stand."""
        return (self.prefix[hi] - self.prefix[lo]) * self.down[lo]

    def all_of(self, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes from every place on."""
        n = len(self.data) - size + 1
        return (self.prefix[size:] - self.prefix[:n]) * self.down[:n]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at ``a`` and ``b``, up to ``most``: binary search on hashes."""
        lo, hi = np.zeros_like(most), most.copy()
        for _ in range(int(most.max(initial=0)).bit_length()):
            mid = (lo + hi + 1) >> 1
            same = self.of(a, a + mid) == self.of(b, b + mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo


def anchors(hashed: Hashes, starts: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last): in each text starts[i]:ends[i] of the buffer, the places of the grams that have the smallest
    hash in some window (leftmost among equals), and the first and last window start for which they do. Equal windows
    have equal anchors, so two texts share a window only if they share an anchor at the same distance."""
    n, reach = len(hashed.data), window - gram + 1
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, none
    value = mixed(hashed.all_of(gram))
    place = np.arange(len(value), dtype=np.int32)
    step = 1
    while 2 * step <= reach:
        right = value[step:] < value[:-step]
        value, place = np.where(right, value[step:], value[:-step]), np.where(right, place[step:], place[:-step])
        step *= 2
    rest = reach - step
    if rest:
        right = value[rest:] < value[:-rest]
        place = np.where(right, place[rest:], place[:-rest])
    valid = np.zeros(len(place) + 1, np.int32)
    long = ends - starts >= window
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - window + 1, -1)
    windows = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    at = place[windows].astype(np.int64)
    new = np.append(True, (at[1:] != at[:-1])) if len(at) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(at)) - 1
    return at[begin], windows[begin], windows[stop]


def suffix_sort(hashed: Hashes, at: np.ndarray, size: int, group: np.ndarray | None = None) -> np.ndarray:
    """Order of the suffixes at ``at``, each ``size`` bytes long, by ``group`` and then by bytes: a bottom-up mergesort.

    All runs of a level are merged at once: each suffix finds its rank in the sibling run by binary search. Groups lie one
    after the other, so only those that reach over a boundary between two runs have to be merged there. A comparison
    takes the common extension from prefix hashes, in log2(size) steps, and then the byte after it. Hashes may collide, so
    the bytes of all neighbours are compared in the end; if any stand in the wrong order, the bytes are sorted instead.
    """
    n = len(at)
    group = np.zeros(n, np.int64) if group is None else group
    order = np.argsort(group, kind="stable")
    of = group[order]
    new = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if n else np.zeros(0, np.int64)
    number = np.zeros(n, np.int64)
    number[new[1:]] = 1
    number = np.cumsum(number)
    first, last = new, np.append(new[1:], n)
    most = np.full(n, size, np.int64)

    def less(a: np.ndarray, b: np.ndarray, equal: np.ndarray) -> np.ndarray:
        """Suffix a[i] before b[i]; ``equal`` is what counts for equal ones."""
        inside = np.minimum(hashed.common(a, b, most[: len(a)]), size - 1)
        x, y = hashed.data[a + inside], hashed.data[b + inside]
        return np.where(x != y, x < y, equal)

    width = 1
    while width < n:
        edges = np.arange(width, n, 2 * width)
        edges = edges[number[edges - 1] == number[edges]]  # groups over a boundary, and the parts of them to be merged
        begin = np.maximum(first[number[edges]], edges - width)
        end = np.minimum(last[number[edges]], edges + width)
        count = end - begin
        which = np.repeat(np.arange(len(edges)), count)
        pos = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begin[which]
        left = pos < edges[which]
        lo = np.where(left, edges[which], begin[which])
        hi = np.where(left, end[which], edges[which])
        since = lo.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            # a left element goes before equal right ones, so the sort is stable
            after = less(at[order[mid]], at[order[pos[open_]]], ~left[open_])
            lo[open_] = np.where(after, mid + 1, lo[open_])
            hi[open_] = np.where(after, hi[open_], mid)
        own = pos - np.where(left, begin[which], edges[which])
        merged = order.copy()
        merged[begin[which] + own + (lo - since)] = order[pos]
        order = merged
        width *= 2
    return order if n < 2 or in_order(hashed.data, at[order], size, of) else sorted_bytes(hashed.data, at, size, group)


def words(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes from each place on as rows of big-endian numbers, which order as the bytes do."""
    wide = -(-size // 8) * 8
    rows = np.zeros((len(at), wide), np.uint8)
    rows[:, :size] = data[at[:, None] + np.arange(size)]
    return rows.view(">u8").astype(np.uint64)


def in_order(data: np.ndarray, at: np.ndarray, size: int, group: np.ndarray) -> bool:
    for begin in range(0, len(at) - 1, 1 << 17):
        rows = words(data, at[begin : begin + (1 << 17) + 1], size)
        differ = rows[1:] != rows[:-1]
        first = differ.argmax(1)
        place = np.arange(len(first))
        same = group[begin + 1 : begin + 1 + len(first)] == group[begin : begin + len(first)]
        if (same & differ.any(1) & (rows[1:][place, first] < rows[:-1][place, first])).any():
            return False
    return True


def sorted_bytes(data: np.ndarray, at: np.ndarray, size: int, group: np.ndarray) -> np.ndarray:
    return np.lexsort((*words(data, at, size).T[::-1], group))
