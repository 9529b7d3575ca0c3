"""Helpers for sorted suffix runs: rolling hashes, windows' anchors, front coding, merging by loser tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(m, -1, 1 << 64) for m in _MULTIPLIERS)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
# A text is cut here for the choice of anchors; positions below it fit beside a hash in 64 bits.
CHUNK = 1 << 22
_POWERS: dict[int, np.ndarray] = {}


def _byte_values(which: int) -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIERS[1 - which] | 1)
    x ^= x >> np.uint64(31)
    x *= _MIX
    return x ^ (x >> np.uint64(29))


_VALUES = (_byte_values(0), _byte_values(1))


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for later texts of up to a few megabytes."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 17)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= CHUNK:
            _POWERS[base] = known
    return known[:n]


class Rolling:
    """Hashes of the substrings of a text, equal for equal strings wherever they stand."""

    def __init__(self, data: np.ndarray, which: int = 0):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[which][data] * _powers(_MULTIPLIERS[which], len(data)), out=self.sums[1:])
        self.back = _powers(_INVERSES[which], len(data) + 1)

    def at(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[begin]) * self.back[begin]
        x ^= x >> np.uint64(32)
        x *= _MIX
        return x ^ (x >> np.uint64(29))


def anchors(data: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the windows of ``size`` bytes: place of the anchor, first and last window start, hash of the anchor.

    A window's anchor is its substring of ``gram`` bytes with the least hash, the leftmost on a tie. It
    depends on nothing but the window's bytes; neighbouring windows with one anchor are one row.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    starts = len(data) - size + 1
    width = size - gram + 1
    for base in range(0, max(starts, 0), CHUNK):
        n = min(CHUNK, starts - base)
        some = data[base : base + n + size - 1]
        first = np.arange(len(some) - gram + 1)
        h = Rolling(some).at(first, first + gram)
        keyed = (h >> np.uint64(23) << np.uint64(23)) | first.astype(np.uint64)
        padded = np.full(-(-len(keyed) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(keyed)] = keyed
        rows = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
        place = (least & np.uint64((1 << 23) - 1)).astype(np.int64)
        begin = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        end = np.concatenate([begin[1:] - 1, [n - 1]])
        at = place[begin]
        parts.append((at + base, begin + base, end + base, h[at]))
    if not parts:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix of two strings that agree on the first ``known`` bytes."""
    most = min(len(a), len(b))
    step = 16
    while known < most and a[known : known + step] == b[known : known + step]:
        known += step
        step *= 2
    if known >= most:
        return most
    end = min(known + step, most)
    while known < end:  # the mismatch is below end, or the shorter string ends there
        middle = (known + end + 1) // 2
        if a[known:middle] == b[known:middle]:
            known = middle
        else:
            end = middle - 1
    return known


def front_coded(strings: list[bytes]) -> tuple[list[int], list[int], bytes]:
    """Sorted strings as common prefix with the one before, length of the rest, and the rests."""
    shared, lengths, rests = [], [], []
    before = b""
    for s in strings:
        k = common_prefix(before, s)
        shared.append(k)
        lengths.append(len(s) - k)
        rests.append(s[k:])
        before = s
    return shared, lengths, b"".join(rests)


def decoded(shared: list[int], lengths: list[int], rests: bytes) -> Iterator[tuple[bytes, int]]:
    """Strings of a front-coded run, each with its common prefix with the one before."""
    before, at = b"", 0
    for k, n in zip(shared, lengths):
        before = before[:k] + rests[at : at + n]
        at += n
        yield before, k


def merged(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """String, common prefix with the string before, run: all runs in one sorted order.

    A loser tree whose players carry their common prefix with the last string that came out. Of two
    players the one that shares more with it is the smaller; only on a tie are bytes read, from there on.
    A player's own front coding gives its next common prefix, so no known prefix is compared again.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[tuple[bytes, int] | None] = [next(r, None) for r in runs] + [None] * (size - len(runs))
    strings: list[bytes | None] = [h[0] if h else None for h in heads]
    shared = [0] * size
    losers = [0] * size

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared prefix becomes that with the winner."""
        a, b = strings[x], strings[y]
        if b is None:
            return x, y
        if a is None:
            return y, x
        if shared[x] > shared[y]:
            return x, y
        if shared[x] < shared[y]:
            return y, x
        k = common_prefix(a, b, shared[x])
        if k == len(a) or (k < len(b) and a[k] < b[k]):
            shared[y] = k
            return x, y
        shared[x] = k
        return y, x

    winners = list(range(size))
    level = size
    while level > 1:
        level //= 2
        nxt = []
        for i in range(level):
            w, l = play(winners[2 * i], winners[2 * i + 1])
            losers[level + i] = l
            nxt.append(w)
        winners = nxt
    champion = winners[0]
    while strings[champion] is not None:
        yield strings[champion], shared[champion], champion
        head = next(runs[champion], None)
        strings[champion], shared[champion] = head if head else (None, 0)
        node = (champion + size) // 2
        player = champion
        while node:
            player, losers[node] = play(player, losers[node])
            node //= 2
        champion = player
