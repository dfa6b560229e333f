"""Deep-shallow sorting of byte strings: multikey quicksort first, then blind tries for long ties.

Strings are rows of a byte matrix. Quicksort works on eight bytes at a time, on all segments side by
side, down to a shallow depth. Groups that still tie there share a long prefix, so each is ordered
by a blind trie, which looks at the bytes where strings differ only.
"""

from __future__ import annotations

import numpy as np

from rankloom.llm import batches

WORD = 8


class Leaf:
    def __init__(self, value: int, item: int) -> None:
        self.value = value
        self.items = [item]


class Branch:
    """Children by the byte at ``place``; all strings below agree before it."""

    def __init__(self, place: int) -> None:
        self.place = place
        self.children: dict[int, Branch | Leaf] = {}


class BlindTrie:
    """Strings of ``width`` bytes, held as big-endian numbers; equal strings share a leaf."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.root: Branch | Leaf | None = None

    def byte(self, value: int, place: int) -> int:
        return value >> 8 * (self.width - 1 - place) & 255

    def add(self, value: int, item: int) -> None:
        node = self.root
        if node is None:
            self.root = Leaf(value, item)
            return
        # Blindly down to any leaf; where no child fits, all of them are as good.
        while isinstance(node, Branch):
            node = node.children.get(self.byte(value, node.place)) or next(iter(node.children.values()))
        if node.value == value:
            node.items.append(item)
            return
        split = self.width - ((value ^ node.value).bit_length() + 7) // 8
        other = self.byte(node.value, split)
        parent, node = None, self.root
        while isinstance(node, Branch) and node.place < split:
            parent, node = node, node.children[self.byte(value, node.place)]
        if isinstance(node, Branch) and node.place == split:
            node.children[self.byte(value, split)] = Leaf(value, item)
            return
        branch = Branch(split)
        branch.children = {other: node, self.byte(value, split): Leaf(value, item)}
        if parent is None:
            self.root = branch
        else:
            parent.children[self.byte(value, parent.place)] = branch

    def ordered(self) -> list[int]:
        """All items by their strings."""
        found: list[int] = []
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if isinstance(node, Leaf):
                found += node.items
            else:
                stack += [node.children[b] for b in sorted(node.children, reverse=True)]
        return found


def quicksort(words: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by their first ``shallow`` words; starts and ends of the groups that tie."""
    n = len(words)
    order = np.arange(n)
    starts, ends, depth = np.array([0]), np.array([n]), np.array([0])
    tied = []
    live = ends - starts > 1
    while live.any():
        starts, ends, depth = starts[live], ends[live], depth[live]
        sizes = ends - starts
        places = batches.gather(starts, sizes)
        segment = np.repeat(np.arange(len(starts)), sizes)
        keys = words[order[places], depth[segment]]
        pivot = words[order[starts + sizes // 2], depth][segment]
        part = segment * 3 + (keys >= pivot) + (keys > pivot)
        order[places] = order[places][np.argsort(part, kind="stable")]
        counts = np.bincount(part, minlength=3 * len(starts)).reshape(-1, 3)
        cuts = starts[:, None] + np.cumsum(counts, axis=1)
        starts = np.column_stack([starts, cuts[:, :2]]).ravel()
        ends = cuts.ravel()
        depth = np.column_stack([depth, depth + 1, depth]).ravel()
        live = ends - starts > 1
        done = live & (depth >= shallow)
        tied.append(np.stack([starts[done], ends[done]]))
        live &= ~done
    both = np.concatenate(tied, axis=1) if tied else np.zeros((2, 0), np.int64)
    return order, both[0], both[1]


def sort(rows: np.ndarray, shallow_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix, and the common prefix of each with the one before."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // WORD) * WORD), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    shallow = -(-shallow_bytes // WORD)
    order, starts, ends = quicksort(words, shallow)
    rest = padded[:, shallow * WORD :]
    for start, end in zip(starts.tolist(), ends.tolist()):
        if not rest.shape[1]:
            break
        items = order[start:end].tolist()
        trie = BlindTrie(rest.shape[1])
        for item in items:
            trie.add(int.from_bytes(rest[item].tobytes(), "big"), item)
        order[start:end] = trie.ordered()
    common = np.zeros(n, np.int64)
    step = 1 << 14
    for at in range(1, n, step):
        last = min(at + step, n)
        differs = padded[order[at:last]] != padded[order[at - 1 : last - 1]]
        common[at:last] = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    return order, np.minimum(common, width)
