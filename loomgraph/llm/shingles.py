"""Vectorised word hashing over Arrow text buffers: no Python object per word."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
_powers: dict[str, np.ndarray] = {}
#: Bytes that are hashed at once; bounds the scratch arrays.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 8), base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def word_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each word `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased, of the texts raw[bounds[i]:bounds[i+1]]."""
    rows, hashes = [], []
    lo, end = int(bounds[0]), int(bounds[-1])
    while lo < end:
        hi = min(end, lo + PIECE)
        if hi < end:  # cut at a white space or where a text ends; a longer word stays whole
            back = np.flatnonzero(~_SOLID[raw[lo:hi]])
            edge = int(bounds[np.searchsorted(bounds, hi, "right") - 1])
            cut = max(lo + int(back[-1]) + 1 if len(back) else lo, edge)
            while cut <= lo:
                nxt = np.flatnonzero(~_SOLID[raw[hi : min(end, hi + PIECE)]])
                stop = int(bounds[np.searchsorted(bounds, hi, "left")])
                cut = min(stop, hi + int(nxt[0]) + 1) if len(nxt) else min(stop, hi + PIECE)
                if not len(nxt) and cut < stop:
                    hi, cut = cut, lo
            hi = cut
        r, h = _piece(raw, bounds, lo, hi)
        rows.append(r)
        hashes.append(h)
        lo = hi
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(hashes)


def _piece(raw, bounds, lo, hi):
    b = raw[lo:hi]
    n = hi - lo
    solid = _SOLID[b]
    edge = np.zeros(n + 1, bool)
    inner = bounds[(bounds >= lo) & (bounds <= hi)] - lo
    edge[inner] = True
    edge[0] = edge[n] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[b] * _table("up", _BASE, n), dtype=np.uint64, out=total[1:])
    h = (total[ends] - total[starts]) * _table("down", _INVERSE, n + 1)[starts]
    rows = np.searchsorted(bounds, starts + lo, "right") - 1
    return rows, mix(h)


def shingle_hashes(rows: np.ndarray, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each distinct run of `width` words of a row, sorted; of a shorter row, its whole sequence."""
    n = len(words)
    if not n:
        return rows, words
    firsts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    counts = np.diff(np.r_[firsts, n])
    out_r, out_h = [], []
    if n >= width:
        whole = rows[width - 1 :] == rows[: n - width + 1]
        at = np.flatnonzero(whole)
        h = np.full(len(at), np.uint64(width), np.uint64)
        for j in range(width):
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[at + j])
        out_r.append(rows[at])
        out_h.append(h)
    for short in range(1, width):
        at = firsts[counts == short]
        if len(at):
            h = np.full(len(at), np.uint64(short), np.uint64)
            for j in range(short):
                h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[at + j])
            out_r.append(rows[at])
            out_h.append(h)
    r, h = np.concatenate(out_r), np.concatenate(out_h)
    order = np.lexsort((h, r))
    r, h = r[order], h[order]
    keep = np.r_[True, (r[1:] != r[:-1]) | (h[1:] != h[:-1])]
    return r[keep], h[keep]
