"""A minimal acyclic transducer from byte strings to id sequences, as one block of bytes that can be memory-mapped.

States with equal continuations are shared, so words share their endings as well as their beginnings. Each arc carries a
number; the numbers along a word's path add up to the word's rank in sorted order, which finds its ids.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable

import numpy as np

_ONE = [bytes([i]) for i in range(256)]


def compile_words(entries: dict[bytes, bytes]) -> bytes:
    """The block for words and their packed ids (little-endian unsigned 32-bit)."""
    words = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # (ends a word, ((label, target), ...)), targets before sources

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        got = register.get(key)
        if got is None:
            got = register[key] = len(states)
            states.append(key)
        return got

    path: list[list] = [[False, []]]
    last = b""
    for word in words:
        same = 0
        for x, y in zip(word, last, strict=False):
            if x != y:
                break
            same += 1
        while len(path) > same + 1:
            done = freeze(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        for _ in word[same:]:
            path.append([False, []])
        path[-1][0] = True
        last = word
    while len(path) > 1:
        done = freeze(path.pop())
        path[-1][1].append((last[len(path) - 1], done))
    root = freeze(path.pop())

    below = []
    for final, arcs in states:
        below.append(final + sum(below[t] for _, t in arcs))
    first, labels, targets, numbers = [0], bytearray(), [], []
    for final, arcs in states:
        n = int(final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            numbers.append(n)
            n += below[target]
        first.append(len(labels))
    ends = np.array([int(final) for final, _ in states], np.uint8).tobytes()
    ids = [entries[w] for w in words]
    at = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64))).astype("<u4")
    pad = lambda b: bytes(b) + b"\0" * (-len(b) % 4)
    head = np.array([len(states), len(labels), len(words), root], "<u4").tobytes()
    return b"".join((head, np.array(first, "<u4").tobytes(), np.array(targets, "<u4").tobytes(), np.array(numbers, "<u4").tobytes(), at.tobytes(), pad(labels), pad(ends), b"".join(ids)))


class Transducer:
    def __init__(self, block):
        """block: bytes, or an open file, which is mapped rather than read."""
        self._map = block if isinstance(block, bytes) else mmap.mmap(block.fileno(), 0, access=mmap.ACCESS_READ)
        ints = memoryview(self._map)[: len(self._map) // 4 * 4].cast("I")
        n, arcs, words, self.root = ints[0], ints[1], ints[2], ints[3]
        at = 4
        self.first = ints[at : at + n + 1]
        at += n + 1
        self.target = ints[at : at + arcs]
        at += arcs
        self.number = ints[at : at + arcs]
        at += arcs
        self.place = ints[at : at + words + 1]
        at += words + 1
        self.labels = 4 * at
        self.ends = self.labels + (arcs + 3) // 4 * 4
        self.ids = self.ends + (n + 3) // 4 * 4
        self.words, self.states = words, n

    def get(self, word: bytes) -> bytes | None:
        """The word's packed ids; None for a word that isn't there."""
        find, base, first, target, number = self._map.find, self.labels, self.first, self.target, self.number
        state, rank = self.root, 0
        for b in word:
            arc = find(_ONE[b], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            rank += number[arc]
            state = target[arc]
        if not self._map[self.ends + state]:
            return None
        return self._map[self.ids + 4 * self.place[rank] : self.ids + 4 * self.place[rank + 1]]


def packed(ids: Iterable[int]) -> bytes:
    return np.array(list(ids), "<u4").tobytes()
