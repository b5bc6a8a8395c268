"""Deep-shallow sorting of string windows.

Windows of one fixed length into a buffer are put in order like the suffixes of a suffix array cut
at that length. Multikey quicksort on characters of eight bytes orders all windows to a shallow
depth: each level orders every open group by its next character, and groups of one are done. Groups
that still agree are ordered by a blind trie: it stores branching positions and single bytes only,
is descended without looking at the rest, and compares a window with one stored string in full.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16


def words_at(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The eight bytes at each start as one big-endian number; ``data`` has seven spare bytes at its end."""
    view = np.lib.stride_tricks.as_strided(data[:8].view(">u8"), (len(data) - 7,), (1,))
    return view[starts].astype(np.uint64)


class BlindTrie:
    """Equal strings share a leaf. A node is [branching position, {byte: node or leaf}], a leaf is (string, members)."""

    def __init__(self):
        self.root = None

    def add(self, s: bytes, member: int) -> None:
        if self.root is None:
            self.root = (s, [member])
            return
        node = self.root
        while isinstance(node, list):
            children = node[1]
            node = children.get(s[node[0]]) or next(iter(children.values()))
        t = node[0]
        if s == t:
            node[1].append(member)
            return
        at = next(i for i, (x, y) in enumerate(zip(s, t)) if x != y)
        parent, node = None, self.root
        while isinstance(node, list) and node[0] < at:
            parent, node = node, node[1][s[node[0]]]
        leaf = (s, [member])
        if isinstance(node, list) and node[0] == at:
            node[1][s[at]] = leaf
            return
        made = [at, {s[at]: leaf, t[at]: node}]
        if parent is None:
            self.root = made
        else:
            parent[1][s[parent[0]]] = made

    def groups(self):
        """Members of equal strings, in the strings' order."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                yield node[1]


def sort_windows(data: bytes, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the windows, for each place of the order the first place of an equal window)."""
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    keys = words_at(padded, starts)
    order = np.argsort(keys, kind="quicksort")
    key = keys[order]
    opens = np.r_[True, key[1:] != key[:-1]]
    depth = 8
    while depth < min(SHALLOW, length - 7):
        head = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
        sizes = np.diff(np.r_[np.flatnonzero(opens), n])
        at = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(at):
            break
        key = words_at(padded, starts[order[at]] + depth)
        inner = np.lexsort((key, head[at]))
        order[at] = order[at[inner]]
        key, group = key[inner], head[at]
        opens[at[1:]] |= (key[1:] != key[:-1]) & (group[1:] == group[:-1])
        depth += 8
    heads = np.flatnonzero(opens)
    sizes = np.diff(np.r_[heads, n])
    for head, size in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        trie = BlindTrie()
        for member, p in zip(order[head : head + size].tolist(), starts[order[head : head + size]].tolist()):
            trie.add(data[p + depth : p + length], member)
        at = head
        for members in trie.groups():
            opens[at] = True
            order[at : at + len(members)] = members
            at += len(members)
    return order, np.maximum.accumulate(np.where(opens, np.arange(n), 0))
