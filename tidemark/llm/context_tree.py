"""Context-tree weighting over bytes, each byte taken as eight binary decisions.

A node of the tree is a context (the last k bytes, k up to ``DEPTH``) with the bits of the
next byte that are known so far. Its estimate is Krichevsky-Trofimov's, from how often a 0
and a 1 followed. The weighted probability of a node is half its own estimate plus half the
product over its children, which tell apart one byte further back; so the estimates of all
depths are mixed, by how well each explained the training bytes.

A node exists if training bytes pass through it, however few: the tree grows with the corpus
and is never held in one place. Nodes whose contexts end alike in ``TOP + 1`` bytes form a
``Branch``, which one task can weigh; the ``Crown`` above the branches has contexts of up to
``TOP`` bytes and is all that they share. (With ``least`` above 1, what is left out of a
parent's bytes is one more child, which has no children.)

A text is coded as one stream: its lines in lower case (a line that is not empty is followed
by a blank), line ends and the end of the text. Contexts run on over blanks and lines; ends of
texts stand for what would be before the first byte. Probabilities sum to one over all next
bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

DEPTH = 5
TOP = 2
BLANK = b" "
STREAM_END = b"\xff"  # never part of UTF-8
STEP = 1_000_000


LINE_END, TEXT_END = b"\n", b"\r"


def coded(word: bytes) -> bytes:
    """The bytes that are coded for a word; the end of a line or a text is one byte alone."""
    return word if word in (LINE_END, TEXT_END) else word + BLANK


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``windows`` of words that are coded one by one, with blanks before each."""
    return windows([BLANK * DEPTH + coded(w) for w in words])


def windows(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte, it and the ``DEPTH`` before it as one number, and its part's place.

    The first ``DEPTH`` bytes of each part are context only.
    """
    sizes = np.fromiter((len(p) - DEPTH for p in parts), np.int64, len(parts))
    flat = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    codes = np.zeros(len(flat), np.uint64)
    for back in range(DEPTH + 1):
        codes[back:] |= flat[: len(flat) - back] << np.uint64(8 * back)
    coded_here = np.ones(len(flat), bool)
    starts = np.cumsum(sizes + DEPTH) - sizes - DEPTH
    coded_here[(starts[:, None] + np.arange(DEPTH)).reshape(-1)] = False
    return codes[coded_here], np.repeat(np.arange(len(parts)), sizes)


def stream(text: str) -> bytes:
    """The bytes that are coded for a text in lower case."""
    return "".join(line + " \n" if line else "\n" for line in text.split("\n")).encode() + STREAM_END


def stream_grams(streams: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``windows`` of whole streams, and their places, about ``STEP`` bytes at a time."""
    parts: list[bytes] = []
    places: list[int] = []
    size = 0
    for place, data in enumerate(streams):
        data = STREAM_END * DEPTH + data
        for at in range(DEPTH, len(data), STEP):
            parts.append(data[at - DEPTH : at + STEP])
            places.append(place)
            size += len(parts[-1])
            if size >= STEP:
                codes, owner = windows(parts)
                yield codes, np.array(places)[owner]
                parts, places, size = [], [], 0
    if parts:
        codes, owner = windows(parts)
        yield codes, np.array(places)[owner]


def branch_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket for each code; all codes of a branch have the same."""
    last = (codes >> np.uint64(8)) & np.uint64((1 << (8 * (TOP + 1))) - 1)
    return ((last * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets


def cut(codes: np.ndarray, depth: int) -> np.ndarray:
    """Codes with a context of ``depth`` bytes only."""
    return codes & np.uint64((1 << (8 * (depth + 1))) - 1)


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, where = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(where, counts, len(distinct)).astype(np.int64)


def nodes(codes: np.ndarray, counts: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (context and known bits) and the counts of zeros and ones, from codes of one depth.

    ``codes`` must hold all codes of each context that occurs in it.
    """
    contexts, where = np.unique(codes >> np.uint64(8), return_inverse=True)
    enough = np.bincount(where, counts, len(contexts))[where] >= least
    codes, counts = codes[enough], counts[enough]
    keys, bits = node_keys(codes)
    flat = keys.reshape(-1)
    weights = np.repeat(counts, 8)
    distinct, where = np.unique(flat, return_inverse=True)
    ones = np.bincount(where, weights * bits.reshape(-1), len(distinct))
    zeros = np.bincount(where, weights, len(distinct)) - ones
    kept = zeros + ones >= least
    return distinct[kept], zeros[kept].astype(np.int64), ones[kept].astype(np.int64)


def node_keys(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each code its eight nodes, and the bit that follows at each."""
    byte = (codes & np.uint64(255)).astype(np.int64)[:, None]
    place = np.arange(8)
    known = (1 << place) | (byte >> (8 - place))
    keys = ((codes >> np.uint64(8)) << np.uint64(8))[:, None] | known.astype(np.uint64)
    return keys, (byte >> (7 - place)) & 1


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of Krichevsky and Trofimov's block probability."""
    lgamma = np.frompyfunc(math.lgamma, 1, 1)
    value = lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1.0)
    return value.astype(np.float64) - math.log(math.pi)


def parent_keys(keys: np.ndarray, depth: int) -> np.ndarray:
    """Keys without the byte furthest back."""
    return keys & np.uint64((1 << (8 * depth)) - 1)


Level = tuple[np.ndarray, np.ndarray, np.ndarray]
Below = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def by_parent(above: np.ndarray, keys: np.ndarray, depth: int, weighted: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> Below:
    """The children's log weighted probability, zeros and ones, and whether there are any, by parent's place."""
    at, size = np.searchsorted(above, parent_keys(keys, depth)), len(above)
    return (
        np.bincount(at, weighted, size), np.bincount(at, zeros, size), np.bincount(at, ones, size),
        np.bincount(at, minlength=size) > 0,
    )


def rise(levels: list[Level], first: int, below: Below | None = None) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """From the leaves up: the share of a node's weight that its own estimate has, what is in no child, and the first level's weights.

    ``levels`` have sorted keys, zeros and ones for each depth from ``first`` on; ``below`` is known of the last level's children.
    """
    own: list[np.ndarray] = [np.zeros(0)] * len(levels)
    rest: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0))] * len(levels)
    weighted = np.zeros(0)
    for level in range(len(levels) - 1, -1, -1):
        keys, zeros, ones = levels[level]
        estimate = log_estimate(zeros, ones)
        if below is None:
            own[level], weighted = np.ones(len(keys)), estimate
            rest[level] = np.zeros(len(keys)), np.zeros(len(keys))
        else:
            product, child_zeros, child_ones, has = below
            left_zeros, left_ones = zeros - child_zeros, ones - child_ones
            split = product + log_estimate(left_zeros, left_ones)
            mixed = np.logaddexp(estimate, split) - math.log(2)
            weighted = np.where(has, mixed, estimate)
            own[level] = np.where(has, np.exp(estimate - math.log(2) - mixed), 1.0)
            rest[level] = left_zeros, left_ones
        if level:
            below = by_parent(levels[level - 1][0], keys, first + level, weighted, zeros, ones)
    return own, rest, weighted


def sink(levels: list[Level], first: int, own: list[np.ndarray], rest: list[tuple[np.ndarray, np.ndarray]], said: np.ndarray, left: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """From the root down: the chance of a 1 where a node is the last on the way; what the last level's nodes say, and the weight that is left.

    ``said`` and ``left`` are for the first level's nodes what those above them say, and leave.
    """
    chances = []
    for level, (keys, zeros, ones) in enumerate(levels):
        if level:
            at = np.searchsorted(levels[level - 1][0], parent_keys(keys, first + level))
            said, left = said[at], left[at]
        said = said + left * own[level] * (ones + 0.5) / (zeros + ones + 1)
        left = left * (1 - own[level])
        other_zeros, other_ones = rest[level]
        chances.append(said + left * (other_ones + 0.5) / (other_zeros + other_ones + 1))
    return chances, said, left


def in_order(level: Level) -> Level:
    keys, zeros, ones = level
    order = np.argsort(keys)
    return keys[order], zeros[order].astype(float), ones[order].astype(float)


@dataclass
class Crown:
    """The nodes of depth 0 to ``TOP``, and what the last of them say and leave."""

    keys: list[np.ndarray]
    chance: list[np.ndarray]
    said: np.ndarray
    left: np.ndarray

    @classmethod
    def build(cls, codes: np.ndarray, counts: np.ndarray, keys: np.ndarray, product: np.ndarray) -> Crown:
        """From all codes cut to ``TOP``, and the branches' log weights summed by their parents' keys."""
        levels = [in_order(nodes(*summed(cut(codes, depth), counts), 1)) for depth in range(TOP + 1)]
        last, zeros, ones = levels[-1]
        own, rest, _ = rise(levels, 0, (product[np.argsort(keys)], zeros, ones, np.ones(len(last), bool)))
        chance, said, left = sink(levels, 0, own, rest, np.zeros(len(levels[0][0])), np.ones(len(levels[0][0])))
        return cls([level[0] for level in levels], chance, said, left)


@dataclass
class Branch:
    """The nodes of depth ``TOP + 1`` and more that the codes of whole branches make."""

    levels: list[Level]
    own: list[np.ndarray]
    rest: list[tuple[np.ndarray, np.ndarray]]
    weighted: np.ndarray

    @classmethod
    def build(cls, codes: np.ndarray, counts: np.ndarray) -> Branch:
        found = dict(all_levels(codes, counts, 1, TOP + 1))
        levels = [in_order(found[depth]) for depth in range(TOP + 1, DEPTH + 1)]
        return cls(levels, *rise(levels, TOP + 1))

    def product(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of depth ``TOP`` and the log weights of all nodes right below them."""
        parents, where = np.unique(parent_keys(self.levels[0][0], TOP + 1), return_inverse=True)
        return parents, np.bincount(where, self.weighted, len(parents))

    def under(self, crown: Crown) -> Tree:
        """The tree for codes of these branches."""
        at = np.searchsorted(crown.keys[-1], parent_keys(self.levels[0][0], TOP + 1))
        chance, _, _ = sink(self.levels, TOP + 1, self.own, self.rest, crown.said[at], crown.left[at])
        return Tree(crown.keys + [level[0] for level in self.levels], crown.chance + chance)


@dataclass
class Tree:
    """Per depth the nodes' sorted keys, and the chance of a 1 where a node is the last on the way."""

    keys: list[np.ndarray]
    chance: list[np.ndarray]

    @classmethod
    def build(cls, found: list[Level]) -> Tree:
        """``found`` has keys, zeros and ones for each depth, from 0 on."""
        levels = [in_order(level) for level in found]
        own, rest, _ = rise(levels, 0)
        size = len(levels[0][0])
        chances, _, _ = sink(levels, 0, own, rest, np.zeros(size), np.ones(size))
        return cls([level[0] for level in levels], chances)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """Log of each code's byte after its context. Where no node exists, bits are even."""
        keys, bits = node_keys(codes)
        flat = keys.reshape(-1)
        chance = np.full(len(flat), 0.5)
        todo = np.arange(len(flat))
        for depth, (own, values) in enumerate(zip(self.keys, self.chance)):
            wanted = parent_keys(flat[todo], depth + 1)
            at = np.searchsorted(own, wanted)
            at[at == len(own)] = 0
            hit = own[at] == wanted if len(own) else np.zeros(len(todo), bool)
            # Nodes on the way down exist up to some depth and then no more.
            todo = todo[hit]
            chance[todo] = values[at[hit]]
        one = bits.reshape(-1) == 1
        return np.log10(np.where(one, chance, 1 - chance)).reshape(-1, 8).sum(1)


def word_scores(tree: Tree, words: list[bytes], step: int = 50_000) -> np.ndarray:
    """Log10 probability of each word with its closing blank."""
    parts: list[np.ndarray] = []
    for at in range(0, len(words), step):
        codes, owner = grams(words[at : at + step])
        distinct, where = np.unique(codes, return_inverse=True)
        parts.append(np.bincount(owner, tree.log10(distinct)[where], min(step, len(words) - at)))
    return np.concatenate(parts) if parts else np.zeros(0)


def all_levels(codes: np.ndarray, counts: np.ndarray, least: float, first: int = 0) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Nodes of each depth from ``DEPTH`` down to ``first``."""
    for depth in range(DEPTH, first - 1, -1):
        codes, counts = summed(cut(codes, depth), counts)
        yield depth, nodes(codes, counts, least)
