"""Pairs of words of given lengths that share a subsequence long enough, found in a task by how often each letter occurs.

Words whose common subsequence leaves x letters of the one and y of the other
out differ in their counts of letters by at most x one way and y the other.
Words are sorted by the counts of the letters that differ most, so ranges of
both sides are parted from each other by one count after the other; what stays
together is compared by bits, then letter by letter. No pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Letters at most whose counts are looked at by themselves, letters by whose counts ranges are split, pairs of ranges that are not split, pairs gathered, and pairs looked at together letter by letter.
LETTERS, SPLITS, LEAF, CHUNK, STEP = 48, 16, 32_768, 100_000, 16_384


def points(words: np.ndarray, n: int) -> np.ndarray:
    """The code points of words of n letters."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), n)


def numbered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tables of the letters of words, those of a of one length and those of b of one: numbered from the commonest on, in as few bytes as that takes."""
    a, b = points(a, len(a[0])), points(b, len(b[0]))
    letters, times = np.unique(np.concatenate([a.ravel(), b.ravel()]), return_counts=True)
    place = np.empty(len(letters), np.min_scalar_type(len(letters) - 1))
    place[np.argsort(-times, kind="stable")] = np.arange(len(letters))
    return place[np.searchsorted(letters, a)], place[np.searchsorted(letters, b)]


def counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each letter occurs in each word, for words of numbered letters; the rarest letters are counted as one."""
    n = min(int(max(a.max(), b.max())) + 1, LETTERS)

    def of(words: np.ndarray) -> np.ndarray:
        out = np.zeros((len(words), n), np.uint8)
        for column in np.minimum(words, n - 1).T:
            out[np.arange(len(words)), column] += 1
        return out

    return of(a), of(b)


def count_bits(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts as bits of a long, one for each 'letter l occurs c times or more': of these the 64 that part most words. As many bits differ as counts do, at most."""
    out = np.zeros(len(a), np.uint64), np.zeros(len(b), np.uint64)
    told = []
    for c in range(1, int(max(a.max(), b.max())) + 1):
        p, q = (a >= c).mean(0), (b >= c).mean(0)
        told += [(p[x] + q[x] - 2 * p[x] * q[x], x, c) for x in range(a.shape[1])]
    for bit, (_, x, c) in enumerate(sorted(told, reverse=True)[:64]):
        for words, bits in zip((a, b), out):
            bits |= (words[:, x] >= c).astype(np.uint64) << np.uint64(bit)
    return out


def _ranges(counted: np.ndarray, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """The sorted counts between lo and hi, each with where it begins and ends."""
    each, first = np.unique(counted[lo:hi], return_index=True)
    return [(int(v), int(p), int(q)) for v, p, q in zip(each, first + lo, [*(first[1:] + lo), hi])]


def _alike(a: np.ndarray, b: np.ndarray, x: int, y: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) in a and b, tables of counts, of rows that may differ by x one way and y the other."""
    bits = count_bits(a, b)
    most = np.argsort(-(a.var(0) + b.var(0)), kind="stable")[:SPLITS]
    at_a, at_b = (np.lexsort(c[:, most[::-1]].T) for c in (a, b))
    a, b = a[at_a][:, most], b[at_b][:, most]
    bits_a, bits_b = bits[0][at_a], bits[1][at_b]
    todo = [(0, len(a), 0, len(b), 0, x, y)]
    while todo:
        p, q, r, s, k, over, under = todo.pop()
        if k < len(most) and (q - p) * (s - r) > LEAF:
            others = _ranges(b[:, k], r, s)
            for v, p2, q2 in _ranges(a[:, k], p, q):
                todo += [(p2, q2, r2, s2, k + 1, over - max(v - w, 0), under - max(w - v, 0)) for w, r2, s2 in others if -under <= v - w <= over]
            continue
        step = max(1, LEAF // (s - r))
        for p2 in range(p, q, step):
            near = np.flatnonzero(np.bitwise_count(bits_a[p2 : min(q, p2 + step), None] ^ bits_b[None, r:s]) <= x + y)
            if len(near):
                yield at_a[near // (s - r) + p2], at_b[near % (s - r) + r]


def shared(a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """The length of the longest common subsequence of each row of a with that of b where it is ``least`` or more, else a length below that.

    Such a subsequence leaves few letters out, so a letter meets only those at
    about its own place. Lengths of other places are those of shorter beginnings.
    """
    n, m = a.shape[1], b.shape[1]
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    old, new = np.zeros((2, m + 1, a.shape[1]), np.uint8)
    same, further = np.empty(a.shape[1], np.bool_), np.empty(a.shape[1], np.uint8)
    for i in range(1, n + 1):
        for j in range(max(1, i - (n - least)), min(m, i + (m - least)) + 1):
            np.equal(a[i - 1], b[j - 1], out=same)
            np.add(old[j - 1], same.view(np.uint8), out=further)
            np.maximum(further, old[j], out=further)
            np.maximum(further, new[j - 1], out=new[j])
        old, new = new, old
    return old[m]


def matched(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many letters difflib matches in each row of a, of at most 64 letters, and that of b: the longest stretch in both, of equal ones the first in a and then in b, and so on before and after it."""
    total, pair = np.zeros(len(a), np.int64), np.arange(len(a))
    p, q, r, s = (np.full(len(a), x) for x in (0, a.shape[1], 0, b.shape[1]))
    while len(pair):
        size, i, j = _longest(a[pair], b[pair], p, q, r, s)
        total += np.bincount(pair, size, len(total)).astype(np.int64)
        sides = [(pair, p, i, r, j), (pair, i + size, q, j + size, s)]
        left = [(size > 0) & (x[1] < x[2]) & (x[3] < x[4]) for x in sides]
        pair, p, q, r, s = (np.concatenate([x[here] for x, here in zip(both, left)]) for both in zip(*sides))
    return total


def _longest(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray, r: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The length and places of the first longest stretch that each row of a between p and q has in common with that of b between r and s."""
    within = lambda x, lo, hi, other: np.where((np.arange(x.shape[1])[:, None] >= lo) & (np.arange(x.shape[1])[:, None] < hi), x.T.astype(np.int32), other)
    a, b = within(a, p, q, -1), within(b, r, s, -2)
    # A stretch is one number: its length, then 127 less its place in a, then in b. One letter more adds as much to each.
    old, new = np.zeros((2, len(b) + 1, a.shape[1]), np.int32)
    best, more = np.zeros(a.shape[1], np.int32), (1 << 14) + (1 << 7) + 1
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            same = x == y
            np.add(old[j], more, out=new[j + 1])
            np.multiply(new[j + 1], same, out=new[j + 1])
            np.maximum(best, new[j + 1] + same * np.int32(((126 - i) << 7) + 126 - j), out=best)
        old, new = new, old
    return best >> 14, np.where(best > 0, 127 - (best >> 7 & 127), 0), np.where(best > 0, 127 - (best & 127), 0)


def sharing(a: np.ndarray, b: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (i, j) of the rows of a and b, numbered() words, with a common subsequence of ``least`` or more, and its length; some thousand pairs at a time."""
    held, n = [], 0

    def told() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j = (np.concatenate(x) for x in zip(*held))
        length = np.concatenate([shared(a[i[p : p + STEP]], b[j[p : p + STEP]], least) for p in range(0, len(i), STEP)])
        enough = length >= least
        return i[enough], j[enough], length[enough]

    for pair in _alike(*counts(a, b), a.shape[1] - least, b.shape[1] - least):
        held.append(pair)
        n += len(pair[0])
        if n >= CHUNK:
            yield told()
            held, n = [], 0
    if held:
        yield told()


def raised(best: np.ndarray, i: np.ndarray, score: np.ndarray) -> np.ndarray:
    """best, the highest scores of each place in falling order, with more scores of places i."""
    order = np.lexsort((-score, i))
    i, score = i[order], score[order]
    rank = np.arange(len(i)) - np.searchsorted(i, i)
    i, rank, score = (x[rank < best.shape[1]] for x in (i, rank, score))
    at, place = np.unique(i, return_inverse=True)
    more = np.zeros((len(at), best.shape[1]), best.dtype)
    more[place, rank] = score
    out = best.copy()
    out[at] = -np.sort(-np.concatenate([best[at], more], 1), 1)[:, : best.shape[1]]
    return out
