"""Byte-pair merging of many pre-tokens at once, driven by a queue of ranks.

The symbols of all pre-tokens lie in one linked list with a wall between neighbours. Each
step takes the smallest rank from the queue and merges the pairs waiting for it: of every
pre-token the leftmost one, all pre-tokens together; other pairs of that rank go back to the
queue. So each pre-token sees its merges in its own order, lowest rank first and leftmost
among equals. Pairs that have changed since they were queued are skipped.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Protocol

import numpy as np

#: No merge joins this pair.
NONE = np.iinfo(np.int32).max

#: Longer pre-tokens hold many equal pairs; they are merged one by one.
LONG = 64


class RankQueue(Protocol):
    """Positions by rank. ``push_sorted`` takes positions that are grouped by rank."""

    def push(self, rank: int, position: int) -> None: ...

    def push_group(self, rank: int, positions: list[int]) -> None: ...

    def pop(self) -> tuple[int, list[int]]: ...

    def __bool__(self) -> bool: ...


class PairTable:
    """Rank of a pair of symbols, and the symbol that a rank makes. Symbols 0 to 255 are bytes."""

    def __init__(self, pairs: Iterable[tuple[int, int, int]], made: dict[int, int]):
        rows = sorted({(a << 32 | b): r for a, b, r in pairs}.items())
        self.rank_of = dict(rows)
        self.keys = np.array([k for k, _ in rows] + [1 << 62], np.int64)
        self.ranks = np.array([r for _, r in rows] + [NONE], np.int32)
        self.ranks_size = max(made, default=0) + 1
        self.made = np.full(self.ranks_size, -1, np.int32)
        self.made[list(made)] = list(made.values())
        # The wall is a symbol no pair has.
        self.wall = int(max([255, *made.values()])) + 1
        self.bytes = np.full((256, 257), NONE, np.int32)
        for key, rank in rows:
            if key >> 32 < 256 and key & 0xFFFFFFFF < 256:
                self.bytes[key >> 32, key & 0xFFFFFFFF] = rank

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)


def merge_all(words: list[bytes], table: PairTable, queue: RankQueue) -> tuple[np.ndarray, np.ndarray]:
    """Final symbols of all words in a row, and how many each word has. No word is empty."""
    joined = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes + 1)
    symbol = np.full(len(joined) + len(words) + 1, table.wall, np.int32)
    at = np.arange(len(joined)) + np.repeat(np.arange(len(words)), sizes) + 1
    symbol[at] = joined
    n = len(symbol)
    owner = np.concatenate([[np.int32(-1)], owner])
    after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
    waiting = np.full(n, NONE, np.int32)
    left = at
    waiting[left] = table.bytes[symbol[left], np.minimum(symbol[left + 1], 256)]
    found = left[waiting[left] != NONE]
    found = found[np.argsort(waiting[found], kind="stable")]
    ranks = waiting[found]
    cuts = np.flatnonzero(np.diff(ranks)) + 1
    if len(found):
        for rank, group in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(found, cuts)):
            queue.push_group(rank, group.tolist())

    made, rank_of = table.made, table.rank_of
    while queue:
        rank, positions = queue.pop()
        new = int(made[rank])
        if len(positions) < 6:
            done = -1
            for i in sorted(positions):
                if waiting[i] != rank:
                    continue
                if owner[i] == done:
                    queue.push(rank, i)
                    continue
                done = owner[i]
                j = after[i]
                k, h = after[j], before[i]
                symbol[i], symbol[j] = new, -1
                after[i], before[k] = k, i
                waiting[j] = NONE
                near = rank_of.get(new << 32 | int(symbol[k]), NONE)
                waiting[i] = near
                if near != NONE:
                    queue.push(near, int(i))
                near = rank_of.get(int(symbol[h]) << 32 | new, NONE)
                waiting[h] = near
                if near != NONE:
                    queue.push(near, int(h))
            continue
        i = np.array(positions, np.int64)
        i = i[waiting[i] == rank]
        i.sort()
        if not len(i):
            continue
        own = owner[i]
        first = np.concatenate([[True], own[1:] != own[:-1]])
        again = i[~first]
        if len(again):
            queue.push_group(rank, again.tolist())
            i = i[first]
        j = after[i]
        k, h = after[j], before[i]
        symbol[i] = new
        symbol[j] = -1
        after[i] = k
        before[k] = i
        waiting[j] = NONE
        ends, starts = symbol[k], symbol[h]
        both = table.find(
            np.concatenate([np.full(len(i), new, np.int32), starts]),
            np.concatenate([ends, np.full(len(i), new, np.int32)]),
        )
        places = np.concatenate([i, h])
        waiting[places] = both
        hit = both != NONE
        for near, place in zip(both[hit].tolist(), places[hit].tolist()):
            queue.push(near, place)
    live = (symbol >= 0) & (symbol != table.wall)
    return symbol[live], np.bincount(owner[live], minlength=len(words))


def merge_one(word: bytes, table: PairTable, queue: RankQueue) -> list[int]:
    """Final symbols of one word of any length, merged pair by pair."""
    rank_of, made = table.rank_of, table.made
    n = len(word)
    symbol = [*word, table.wall]
    after, before = list(range(1, n + 2)), list(range(-1, n))
    waiting = [NONE] * (n + 1)
    for i in range(n - 1):
        near = waiting[i] = rank_of.get(symbol[i] << 32 | symbol[i + 1], NONE)
        if near != NONE:
            queue.push(near, i)
    while queue:
        rank, positions = queue.pop()
        positions.sort()
        new = int(made[rank])
        for at, i in enumerate(positions):
            if waiting[i] != rank:
                continue
            j = after[i]
            k, h = after[j], before[i]
            symbol[i], symbol[j], after[i], before[k] = new, -1, k, i
            waiting[j] = NONE
            near = waiting[i] = rank_of.get(new << 32 | symbol[k], NONE)
            lower = near < rank
            if near != NONE:
                queue.push(near, i)
            if h >= 0:
                near = waiting[h] = rank_of.get(symbol[h] << 32 | new, NONE)
                lower |= near < rank
                if near != NONE:
                    queue.push(near, h)
            if lower:
                # A smaller rank has come up: the rest of this bucket waits.
                rest = positions[at + 1 :]
                if rest:
                    queue.push_group(rank, rest)
                break
    return [s for s in symbol[:n] if s >= 0]
