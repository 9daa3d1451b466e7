"""Edit distances of many pairs of strings at once: Myers' bit vectors, a pair in each slot of NumPy's arrays."""

from __future__ import annotations

import numpy as np

#: Entries of the tables that one step may hold.
ROOM = 1 << 21


class Texts:
    """Strings as code points in one array, with their starts and sizes."""

    def __init__(self, strings: list[str]):
        self.size = np.fromiter(map(len, strings), np.int64, len(strings))
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]]).astype(np.int64) if len(strings) else np.zeros(0, np.int64)
        codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.codes = codes.astype(np.int32)

    def padded(self, which: np.ndarray, width: int) -> np.ndarray:
        """Codes of the strings `which`, a row each; -1 after their ends."""
        at = self.start[which, None] + np.arange(width)
        inside = np.arange(width) < self.size[which, None]
        if not self.codes.size:
            return np.full(at.shape, -1, np.int32)
        return np.where(inside, self.codes[np.minimum(at, self.codes.size - 1)], -1)


def prefixes(strings: list[str], a: np.ndarray, b: np.ndarray, take) -> None:
    """Gives take(pairs, table) for all pairs, in blocks: table[j, k] is the distance of strings[a[k]] to the first j characters of strings[b[k]]."""
    if not len(a):
        return
    t = Texts(strings)
    m, n = t.size[a], t.size[b]
    order = np.lexsort((n, (m + 63) // 64))
    low = 0
    while low < len(order):
        blocks = max(1, int(m[order[low]] + 63) // 64)
        high = low + max(1, min(4096, ROOM // (blocks * 64)))
        part = order[low:high]
        part = part[(m[part] + 63) // 64 == (m[part[0]] + 63) // 64]
        # so few at once that neither the masks nor the distances take more than ROOM
        fits = max(1, ROOM // int(n[part].max(initial=1) + 1))
        part = part[:fits]
        low += len(part)
        take(part, _table(t, a[part], b[part], m[part], n[part], blocks))


def _table(t: Texts, a: np.ndarray, b: np.ndarray, m: np.ndarray, n: np.ndarray, blocks: int) -> np.ndarray:
    k, width = len(a), int(n.max(initial=0))
    said, text = t.padded(a, blocks * 64), t.padded(b, width)
    # the letters of these strings alone, so that the masks stay small
    met = np.zeros(max(said.max(initial=-1), text.max(initial=-1)) + 2, bool)
    met[said + 1] = met[text + 1] = True
    letters, at = int(met.sum()), np.cumsum(met) - 1
    said, text = at[said + 1], at[text + 1]
    table = np.empty((width + 1, k), np.int32)
    table[0] = m
    if letters * k * blocks > 4 * ROOM and k > 1:  # many letters: fewer pairs at once
        half = k // 2
        for lo, hi in ((0, half), (half, k)):
            part = _table(t, a[lo:hi], b[lo:hi], m[lo:hi], n[lo:hi], blocks)
            table[: len(part), lo:hi] = part
        return table
    masks = np.zeros((blocks, k * letters), np.uint64)
    base = np.arange(k) * letters
    for i in range(int(m.max(initial=0))):
        has = np.flatnonzero(m > i)
        masks[i // 64, base[has] + said[has, i]] |= np.uint64(1 << (i % 64))
    one, top = np.uint64(1), np.uint64(63)
    pv = [np.full(k, 2**64 - 1, np.uint64) for _ in range(blocks)]
    mv = [np.zeros(k, np.uint64) for _ in range(blocks)]
    last = ((m - 1) % 64).clip(0).astype(np.uint64)
    score = m.astype(np.int32)
    for j in range(width):
        slot = base + text[:, j]
        plus, minus = np.ones(k, np.uint64), np.zeros(k, np.uint64)
        for w in range(blocks):
            eq, p, q = masks[w][slot], pv[w], mv[w]
            xv = eq | q
            eq |= minus
            xh = (((eq & p) + p) ^ p) | eq
            ph, mh = q | ~(xh | p), p & xh
            if w == blocks - 1:
                score = score + ((ph >> last) & one).astype(np.int32) - ((mh >> last) & one).astype(np.int32)
            up, down = ph >> top, mh >> top
            ph, mh = (ph << one) | plus, (mh << one) | minus
            pv[w], mv[w] = mh | ~(xv | ph), ph & xv
            plus, minus = up, down
        table[j + 1] = score
    none = m == 0
    if none.any():
        table[:, none] = np.arange(width + 1)[:, None]
    return table


def edits(strings: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edit distances of strings[a[k]] and strings[b[k]]; a pair that comes again, either way round, is computed once."""
    a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
    if not len(a):
        return np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    keys, back = np.unique(np.minimum(a, b) * len(strings) + np.maximum(a, b), return_inverse=True)
    x, y = keys // len(strings), keys % len(strings)
    x, y = np.where(sizes[x] <= sizes[y], x, y), np.where(sizes[x] <= sizes[y], y, x)
    out = np.where(x == y, 0, np.maximum(sizes[x], sizes[y]))
    todo = np.flatnonzero((x != y) & (sizes[x] > 0))

    def take(part, table):
        out[todo[part]] = table[sizes[y[todo[part]]], np.arange(len(part))]

    prefixes(strings, x[todo], y[todo], take)
    return out[back]


def near(strings: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normalised edit distances of pairs, as alignment.distance gives them."""
    a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    return edits(strings, a, b) / np.maximum(1, np.maximum(sizes[a], sizes[b])) if len(a) else np.zeros(0)


def edits_of(a: str, b: str) -> int:
    """Edit distance of two strings, by one whole number of as many bits as the shorter has characters."""
    if len(a) > len(b):
        a, b = b, a
    m = len(a)
    if not m:
        return len(b)
    eq: dict[str, int] = {}
    for i, c in enumerate(a):
        eq[c] = eq.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    p, q, score = full, 0, m
    for c in b:
        e = eq.get(c, 0)
        xv = e | q
        xh = (((e & p) + p) ^ p) | e
        ph, mh = q | ~(xh | p) & full, p & xh
        score += bool(ph & high) - bool(mh & high)
        ph, mh = (ph << 1 | 1) & full, (mh << 1) & full
        p, q = mh | ~(xv | ph) & full, ph & xv
    return score
