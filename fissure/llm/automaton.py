"""Generalised suffix automata of word sequences, bounded in depth.

The states of a suffix automaton are classes of substrings that end at the same places, and its suffix links form the tree of reversed contexts. Both are built here by sorting the contexts of all places
at once: places that share their last k words are one node of depth k, whose parent holds its last k - 1 words. A node that ends at as many places as its parent ends at the same ones, so the two
are one state; a state stands for the substrings from one word more than its link has up to its longest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Automaton:
    #: By state: places where its substrings end, words of its longest one, the state of the longest suffix that ends at more places (-1: the empty one), and one place.
    count: np.ndarray
    length: np.ndarray
    link: np.ndarray
    end: np.ndarray
    #: By depth and place: the state that holds the last ``depth`` words there; -1 where the piece is shorter.
    at: list[np.ndarray]

    def substrings(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """States that hold a substring of ``depth`` words, one for each such substring, and the place where it ends."""
        low = np.where(self.link >= 0, self.length[self.link], 0)
        held = np.flatnonzero((low < depth) & (depth <= self.length))
        return held, self.end[held]


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first place of each distinct key, ascending by key; the number of each place's key; places of each key. ``key`` has no negative numbers."""
    n = len(key)
    bits = n.bit_length()
    if not n or int(key.max()).bit_length() + bits > 63:
        return np.unique(key, return_index=True, return_inverse=True, return_counts=True)[1:]
    # key and place in one number are sorted several times faster than places by key
    pairs = np.sort(key << bits | np.arange(n))
    place, key = pairs & ((1 << bits) - 1), pairs >> bits
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    inverse = np.empty(n, np.int64)
    inverse[place] = np.cumsum(new) - 1
    edges = np.flatnonzero(new)
    return place[edges], inverse, np.diff(edges, append=n)


def build(words: np.ndarray, piece: np.ndarray, depth: int) -> Automaton:
    """The automaton of the substrings of up to ``depth`` words of all pieces. ``words``: numbers; ``piece``: the piece of each word, in a row."""
    n = len(words)
    start = np.zeros(n, np.int64)
    edges = np.flatnonzero(piece[1:] != piece[:-1]) + 1
    start[edges] = edges
    run = np.arange(n) - np.maximum.accumulate(start)
    node, parent, counts, ends, sizes = [], [], [], [], [0]
    above, width = np.zeros(n, np.int64), int(words.max()) + 1 if n else 1
    for k in range(depth):
        places = np.flatnonzero(run >= k)
        key = above[places] * width + words[places - k]
        first, inverse, count = grouped(key)
        parent.append(above[places][first] + sizes[-2] if k else np.full(len(first), -1, np.int64))
        counts.append(count)
        ends.append(places[first])
        here = np.full(n, -1, np.int64)
        here[places] = inverse + sizes[-1]
        node.append(here)
        above = np.where(here >= 0, here - sizes[-1], 0)
        sizes.append(sizes[-1] + len(first))
    count, up, end = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (counts, parent, ends))
    level = np.repeat(np.arange(1, depth + 1), np.diff(sizes))
    # a node with as many places as its parent is the same state: the deeper one's; from the deepest level up
    state = np.arange(len(count))
    for k in range(depth, 1, -1):
        nodes = np.flatnonzero((level == k) & (up >= 0))
        same = nodes[count[nodes] == count[up[nodes]]]
        state[up[same]] = state[same]
    used = np.zeros(len(count), bool)
    used[state] = True
    top = np.flatnonzero(used)
    number = np.zeros(len(count), np.int64)
    number[top] = np.arange(len(top))
    link = up.copy()
    for _ in range(depth):
        inner = link[top] >= 0
        again = inner & (state[np.where(inner, link[top], 0)] == top)
        link[top[again]] = up[link[top[again]]]
    links = np.where(link[top] >= 0, number[state[np.maximum(link[top], 0)]], -1)
    return Automaton(count[top], level[top], links, end[top], [np.where(x >= 0, number[state[np.maximum(x, 0)]], -1) for x in node])
