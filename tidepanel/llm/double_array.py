"""Double-array tries over short sequences of numbers, built and walked in numpy.

A sequence's items are spelt by digits, so that a node has at most `RADIX`
children. A node is a slot; its child by a digit lies at `base[slot] + digit`
if `check` has the node's slot there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

RADIX = 256
#: Nodes of more children take a stretch of slots that no such node shares.
WIDE = 16
#: Tries of a place for the other nodes before more slots are added.
ROUNDS = 64


@dataclass
class Trie:
    """`code` has the number of each item (0: in no sequence), `digits` the digits of a number."""

    code: np.ndarray
    digits: int
    base: np.ndarray
    check: np.ndarray

    def step(self, states: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of `states` by one item each: which have one, and those."""
        codes = self.code[items]
        alive = np.flatnonzero(codes)
        states, codes = states[alive], codes[alive]
        for shift in range(8 * (self.digits - 1), -1, -8):
            following = self.base[states] + ((codes >> shift) & (RADIX - 1))
            good = np.flatnonzero(self.check[following] == states)
            alive, states, codes = alive[good], following[good], codes[good]
        return alive, states

    def accepted(self, items: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, state) where a sequence of `depth` items begins; all positions advance together."""
        at = np.arange(max(0, len(items) - depth + 1))
        states = np.zeros(len(at), np.int32)
        for level in range(depth):
            alive, states = self.step(states, items[at + level])
            at = at[alive]
        return at, states


def build(sequences: np.ndarray, items: int, seed: int = 3) -> tuple[Trie, np.ndarray]:
    """The trie of distinct `sequences` (a row each, of one length) and the state that accepts each.

    `items` is the number of possible items, which are not negative.
    """
    used = np.unique(sequences)
    code = np.zeros(items, np.int32)
    code[used] = np.arange(1, len(used) + 1)
    digits = 1
    while len(used) >= RADIX**digits:
        digits += 1
    shifts = np.arange(8 * (digits - 1), -1, -8)
    spelt = ((code[sequences][:, :, None] >> shifts) & (RADIX - 1)).reshape(len(sequences), -1)
    order = np.lexsort(spelt.T[::-1])
    spelt = spelt[order]
    # Nodes are numbered level by level; node 0 is the root.
    node = np.zeros(len(spelt), np.int64)
    nodes, parents, symbols = 1, [], []
    for column in spelt.T:
        first = np.append(True, (node[1:] != node[:-1]) | (column[1:] != column[:-1]))[: len(node)]
        parents.append(node[first])
        symbols.append(column[first])
        node = nodes + np.cumsum(first) - 1
        nodes += int(first.sum())
    parent, symbol = np.concatenate(parents), np.concatenate(symbols)
    base = _places(parent, symbol, nodes, np.random.default_rng(seed))
    slot = np.zeros(nodes, np.int32)
    slot[1:] = base[parent] + symbol
    size = int(max(slot.max(), base.max())) + RADIX
    trie = Trie(code, digits, np.zeros(size, np.int32), np.full(size, -1, np.int32))
    trie.base[slot] = base
    trie.check[slot[1:]] = slot[parent]
    states = np.empty(len(sequences), np.int64)
    states[order] = slot[node] if len(node) else 0
    return trie, states


def _places(parent: np.ndarray, symbol: np.ndarray, nodes: int, rng: np.random.Generator) -> np.ndarray:
    """A base for each node, so that no two children meet; `parent` is in ascending order."""
    count = np.bincount(parent, minlength=nodes)
    begin = np.cumsum(count) - count
    base = np.zeros(nodes, np.int32)
    wide = np.flatnonzero(count > WIDE)
    base[wide] = 1 + RADIX * np.arange(len(wide))
    size = 1 + RADIX * (len(wide) + 2) + 3 * int(count[count <= WIDE].sum())
    taken = np.zeros(size, bool)
    taken[0] = True
    edges = np.flatnonzero(count[parent] > WIDE)
    taken[base[parent[edges]] + symbol[edges]] = True
    claim = np.full(size, -1, np.int64)
    for n in range(WIDE, 0, -1):
        left = np.flatnonzero(count == n)
        tries = 0
        while len(left):
            if tries and tries % ROUNDS == 0:
                taken = np.append(taken, np.zeros(len(taken), bool))
                claim = np.full(len(taken), -1, np.int64)
            tries += 1
            start = rng.integers(1, len(taken) - RADIX, len(left))
            slots = start[:, None] + symbol[begin[left][:, None] + np.arange(n)]
            # Of nodes that want one slot the last writer has it.
            claim[slots] = np.arange(len(left))[:, None]
            won = ((claim[slots] == np.arange(len(left))[:, None]) & ~taken[slots]).all(axis=1)
            base[left[won]] = start[won]
            taken[slots[won]] = True
            left = left[~won]
    return base
