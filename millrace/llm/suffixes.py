"""Deep-shallow sorting of byte strings, and sampled places at which equal passages of texts meet."""

from __future__ import annotations

import numpy as np

#: Bytes a removed string has; bytes of a gram; grams in such a string.
LENGTH, GRAM = 100, 24
GRAMS = LENGTH - GRAM + 1
SHALLOW = 32
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash for each run of 24 bytes: sums of 2, 4, 8 and 16 neighbours put together by doubling, then 16 and 8."""
    level = data.astype(np.uint64) + np.uint64(1)
    powers = [np.uint64(pow(_BASE, width, 1 << 64)) for width in (1, 2, 4, 8)]
    for power, width in zip(powers, (1, 2, 4, 8)):
        if width == 8:
            eight = level
        level = level[:-width] * power + level[width:]
    n = len(data) - GRAM + 1
    both = level[:n] * powers[3] + eight[16 : 16 + n]
    both ^= both >> np.uint64(29)
    both *= np.uint64(0xBF58476D1CE4E5B9)
    return both ^ (both >> np.uint64(32))


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The sampled places of texts that lie one behind the other in ``data`` and end at ``ends``.

    Each string of 100 bytes within a text has its smallest gram, the first of equals, as its anchor; equal strings
    have it at the same distance. For each anchor: its place, gram hash, and the smallest and largest distance from
    the strings that have it (these are all distances between).
    """
    nothing = tuple(np.empty(0, np.int64) for _ in range(4))
    if len(data) < LENGTH:
        return nothing
    hashes = gram_hashes(data)
    bits = np.uint64(max(1, int(len(hashes)).bit_length()))
    # The place in the low bits makes the first of equal grams the smaller.
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while width * 2 <= GRAMS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    starts = len(data) - LENGTH + 1
    least = np.minimum(least[:starts], least[GRAMS - width : GRAMS - width + starts])
    place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # Strings that would reach over the end of their text have no anchor.
    inside = np.ones(starts, bool)
    for end in ends[:-1]:
        inside[max(0, end - LENGTH + 1) : end] = False
    start = np.flatnonzero(inside)
    if not len(start):
        return nothing
    place = place[start]
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1))))
    last = np.concatenate((first[1:], [len(start)])) - 1
    at = place[first]
    return at, hashes[at].view(np.int64), at - start[last], at - start[first]


def _first_difference(a: bytes, b: bytes) -> int:
    """Length of the common beginning of two strings of equal length."""
    if a == b:
        return len(a)
    return len(a) - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8


class BlindTrie:
    """A trie that keeps only where its strings part: a branching depth and one byte for each way on."""

    def __init__(self, string: bytes, name: int) -> None:
        self.strings = {name: string}
        self.root: tuple | list = [name]

    def add(self, string: bytes, name: int) -> None:
        """Descends without comparing, compares once with the leaf met, and branches where the two part."""
        self.strings[name] = string
        node = self.root
        while isinstance(node, tuple):
            depth, ways = node
            node = ways.get(string[depth]) or next(iter(ways.values()))
        common = _first_difference(string, self.strings[node[0]])
        if common == len(string):
            node.append(name)
            return
        above, byte, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < common:
            above, byte = node[1], string[node[0]]
            node = node[1][byte]
        if isinstance(node, tuple) and node[0] == common:
            node[1][string[common]] = [name]
            return
        leaf = node
        while isinstance(leaf, tuple):
            leaf = next(iter(leaf[1].values()))
        branch = (common, {self.strings[leaf[0]][common]: node, string[common]: [name]})
        if above is None:
            self.root = branch
        else:
            above[byte] = branch

    def in_order(self, length: int) -> tuple[list[int], list[int]]:
        """Names in string order, and for each the common length with the one before (0 for the first)."""
        names, common = [], []
        todo: list[tuple] = [(self.root, 0)]
        while todo:
            node, joint = todo.pop()
            if isinstance(node, tuple):
                depth, ways = node
                ordered = sorted(ways)
                todo.extend((ways[b], depth if i else joint) for i, b in reversed(list(enumerate(ordered))))
            else:
                names += node
                common += [joint] + [length] * (len(node) - 1)
        return names, common


def deep_shallow(rows: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts strings (rows of bytes, zeros behind their ``lengths``) within their groups.

    Gives the order and the common length of each string with the one before it, -1 where a group begins. Down to
    ``SHALLOW`` bytes a multikey quicksort takes eight bytes as one key and goes on with the ties only; the rest of
    each tie, all of one long beginning, is ordered by a blind trie. Equal rows stand by length, shorter first.
    """
    n, width = rows.shape
    order = np.lexsort((lengths, group))
    tie = np.cumsum(np.concatenate(([0], np.diff(group[order]) != 0))) if n else np.empty(0, np.int64)
    common = np.where(np.diff(tie, prepend=-1) != 0, -1, 0)
    keys = rows[:, :SHALLOW].reshape(n, -1, 8).view(">u8")[:, :, 0].astype(np.uint64)
    for depth in range(keys.shape[1]):
        same = np.flatnonzero(np.bincount(tie, minlength=1)[tie] > 1) if n else np.empty(0, np.int64)
        if not len(same):
            break
        word = keys[order[same], depth]
        by_key = np.lexsort((word, tie[same]))
        order[same], word = order[same][by_key], word[by_key]
        new = np.flatnonzero((word[1:] != word[:-1]) & (tie[same][1:] == tie[same][:-1])) + 1
        differ = word[new] ^ word[new - 1]
        # Leading zero bits of the difference, in whole bytes.
        lead = np.zeros(len(new), np.int64)
        for shift in range(1, 8):
            lead += differ < (np.uint64(1) << np.uint64(64 - 8 * shift))
        step = np.zeros(n, np.int64)
        step[same[new]] = 1
        common[same[new]] = 8 * depth + lead
        tie = tie + np.cumsum(step)
    begins = np.flatnonzero(np.diff(tie, prepend=-1))
    sizes = np.diff(np.append(begins, n))
    for begin, size in zip(begins[sizes > 1], sizes[sizes > 1]):
        here = order[begin : begin + size]
        strings = [rows[i].tobytes() for i in here]
        trie = BlindTrie(strings[0], 0)
        for name, string in enumerate(strings[1:], 1):
            trie.add(string, name)
        names, joint = trie.in_order(width)
        order[begin : begin + size] = here[names]
        common[begin + 1 : begin + size] = joint[1:]
    joint = np.minimum(common[1:], np.minimum(lengths[order[1:]], lengths[order[:-1]]))
    return order, np.concatenate((common[:1], joint))


def prefix_classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """For each string a number that those with the same first ``depth`` bytes in the same group share."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def repeated(
    group: np.ndarray, left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray, rank: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Which strings of contexts start earlier too: pairs (context, distance of the string's start from its anchor).

    A context is what lies left of an anchor, backwards, and what lies right of it from the anchor on. A string that
    starts ``d`` before the anchor is made of d bytes of the one and 100 - d of the other; contexts of a group share
    it when they agree on both, which the two sorted orders tell for every d. ``rank`` orders the contexts' places.
    """
    orders = [deep_shallow(part, n, group) for part, n in ((left, high), (right, LENGTH - low))]
    who, distance = [], []
    for d in range(int(low.min()), int(high.max()) + 1) if len(group) else ():
        here = np.flatnonzero((low <= d) & (d <= high))
        if len(here) < 2:
            continue
        by_left, by_right = (prefix_classes(*o, depth)[here] for o, depth in zip(orders, (d, LENGTH - d)))
        key = by_right * (len(group) + 1) + by_left
        by_key = np.lexsort((rank[here], key))
        again = by_key[1:][key[by_key][1:] == key[by_key][:-1]]
        who.append(here[again])
        distance.append(np.full(len(again), d))
    return (np.concatenate(who), np.concatenate(distance)) if who else (np.empty(0, np.int64), np.empty(0, np.int64))
