"""Best-fit decreasing with a segment tree over remaining capacities.

Items of one size are interchangeable, and so are bins with the same room left. Packing
therefore works on runs: how many items have each size, and which bins have which room.
The tree holds, over all possible amounts of room, whether a bin has it, and finds the
tightest room of at least a given size in logarithmic time. The result is what placing the
items one by one, largest first, would give.
"""

from __future__ import annotations

import numpy as np


class RoomTree:
    """Which amounts of room 0..capacity some open bin has."""

    def __init__(self, capacity: int):
        self.leaves = 1 << max(1, (capacity + 1 - 1).bit_length())
        self.used = [False] * (2 * self.leaves)

    def set(self, room: int, used: bool) -> None:
        i = room + self.leaves
        while i and self.used[i] != used:
            self.used[i] = used
            i >>= 1
            used = self.used[2 * i] or self.used[2 * i + 1] if i else False

    def tightest(self, size: int) -> int | None:
        """The least room of at least ``size`` that a bin has."""
        i = size + self.leaves
        if self.used[i]:
            return size
        while i > 1:  # up to the first subtree to the right that holds a bin
            if i % 2 == 0 and self.used[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.used[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def pack_runs(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Pack ``counts[size]`` items of each size into bins; returns runs and the number of bins.

    A run is (size, first item of that size, items, first bin, items per bin, offset): its
    item j lies in bin ``first bin + j // items per bin`` at ``offset + (j % items per bin) * size``.
    The work depends on the number of sizes, at most ``capacity``, not on the items.
    """
    tree, rooms, runs, bins = RoomTree(capacity), {}, [], 0

    def open_bins(room: int, first: int, n: int) -> None:
        if n and room:
            rooms.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for size in sorted(counts, reverse=True):
        left, item = counts[size], 0
        if not 0 < size <= capacity:
            raise ValueError(f"an item of size {size} fits no bin of {capacity}")
        while left:
            room = tree.tightest(size)
            if room is None:
                room, first, n = capacity, bins, -(-left // (capacity // size))
                bins += n
            else:
                first, n = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            each = room // size
            full, rest = divmod(min(left, n * each), each)
            for start, number, per_bin in ((first, full, each), (first + full, 1, rest)):
                if number * per_bin:
                    runs.append((size, item, number * per_bin, start, per_bin, capacity - room))
                    open_bins(room - per_bin * size, start, number)
                    item += number * per_bin
                    left -= number * per_bin
            filled = full + (rest > 0)
            open_bins(room, first + filled, n - filled)
    return np.array(runs, dtype=np.int64).reshape(-1, 6), bins


def places(runs: np.ndarray, sizes: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of items given by size and number (from 0) within their size."""
    order = np.lexsort((runs[:, 1], -runs[:, 0]))
    runs = runs[order]
    shift = np.int64(1 << 42)
    run = runs[np.searchsorted(-runs[:, 0] * shift + runs[:, 1], -sizes * shift + items, side="right") - 1]
    inside = items - run[:, 1]
    return run[:, 3] + inside // run[:, 4], run[:, 5] + inside % run[:, 4] * run[:, 0]
