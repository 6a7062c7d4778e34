"""Weighted acyclic automata over word sequences, held in arrays.

An automaton reads up to ``DEPTH`` symbols (64-bit word hashes, never 0).  Its
states form a tree below the start; the weight of the state a sequence leads to
is how often the sequence occurred.  It is built from sorted paths: a path adds
only the states after the prefix it shares with the path before it, which is
also how paths are stored (``shape``: shared symbols and length; ``labels``:
the new symbols; ``weights``: how often the whole path occurred).  The weight
of an inner state is the sum over the paths through it.

A block is the part of one shard's automaton that lies in one range of paths.
Blocks of one range are united by merging their paths and adding weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from farelane.llm import textbytes as tb

DEPTH = 4
_HEAVY = 255


def sorted_paths(symbols: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary, ids, counts) of the distinct paths that begin at each word and end with its piece.

    ``symbols`` are the words in order, ``pieces`` a number that changes from
    piece to piece.  ``ids`` has ``DEPTH`` columns of places in the sorted
    vocabulary counted from 1, 0 after the end of a path; rows are ordered.
    """
    vocab, own = np.unique(symbols, return_inverse=True)
    own = own.astype(np.uint64) + np.uint64(1)
    n = len(own)
    nxt = np.zeros(n, np.uint64)
    same = pieces[1:] == pieces[:-1]
    nxt[:-1][same] = own[1:][same]
    pairs, rank = np.unique((own << np.uint64(32)) | nxt, return_inverse=True)
    del nxt, own
    key = (rank.astype(np.uint64) + np.uint64(1)) << np.uint64(32)
    if n > 2:  # the third and fourth word are the pair two words on
        on = np.flatnonzero(pieces[2:] == pieces[:-2])
        key[on] |= rank[on + 2].astype(np.uint64) + np.uint64(1)
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if n else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, n))
    key = key[first]
    pairs = np.concatenate([np.zeros(1, np.uint64), pairs])
    ids = np.empty((len(key), DEPTH), np.uint32)
    for at, pair in ((0, pairs[key >> np.uint64(32)]), (2, pairs[key & np.uint64(0xFFFFFFFF)])):
        ids[:, at], ids[:, at + 1] = pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)
    return vocab, ids, counts


def place_of(vocab: np.ndarray, ids: np.ndarray, bound: tuple[int, ...]) -> int:
    """The first of the ordered paths that is not before ``bound`` (symbols, 0 after its end)."""
    lo, hi = 0, len(ids)
    for k, symbol in enumerate(bound):
        if not symbol:
            return lo
        at = int(np.searchsorted(vocab, np.uint64(symbol)))
        column = ids[lo:hi, k]
        known = at < len(vocab) and int(vocab[at]) == symbol
        lo, hi = lo + int(np.searchsorted(column, at + 1)), lo + int(np.searchsorted(column, at + 1, side="right"))
        if not known:
            return lo
    return lo


@dataclass
class Block:
    symbols: bytes  # the sorted symbols that occur, 64 bits each
    shape: bytes  # per path: shared symbols * 8 + length
    labels: bytes  # places in ``symbols``, 16 bits if they suffice, else 32
    weights: bytes  # per path, 255 for a weight in ``heavy``
    heavy: bytes


def _shared(ids: np.ndarray) -> np.ndarray:
    """Per path the number of leading symbols it shares with the path before it."""
    out = np.zeros(len(ids), np.int64)
    run = np.ones(max(len(ids) - 1, 0), bool)
    for k in range(DEPTH):
        run &= (ids[1:, k] == ids[:-1, k]) & (ids[1:, k] > 0)
        out[1:] += run
    return out


def encode_block(vocab: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> Block:
    """A block of ordered distinct paths."""
    used = np.zeros(len(vocab) + 1, bool)
    for k in range(DEPTH):
        used[ids[:, k]] = True
    used[0] = False
    own = np.cumsum(used) - 1
    keep, length = _shared(ids), (ids > 0).sum(axis=1)
    level = np.arange(DEPTH)
    new = (level >= keep[:, None]) & (level < length[:, None])
    symbols = vocab[np.flatnonzero(used) - 1]
    labels = own[ids[new]].astype("<u2" if len(symbols) <= 1 << 16 else "<u4")
    heavy = counts >= _HEAVY
    return Block(
        symbols.astype("<u8").tobytes(),
        (keep * 8 + length).astype(np.uint8).tobytes(),
        labels.tobytes(),
        np.where(heavy, _HEAVY, counts).astype(np.uint8).tobytes(),
        counts[heavy].astype("<i8").tobytes(),
    )


def decode_block(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary, ids, counts) as ``sorted_paths`` returns them."""
    vocab = np.frombuffer(block.symbols, "<u8")
    shape = np.frombuffer(block.shape, np.uint8)
    keep, length = (shape >> 3).astype(np.int64), (shape & 7).astype(np.int64)
    labels = np.frombuffer(block.labels, "<u2" if len(vocab) <= 1 << 16 else "<u4")
    at = tb.prefix(length - keep)[:-1]
    ids = np.zeros((len(shape), DEPTH), np.uint32)
    rows = np.arange(len(shape))
    for k in range(DEPTH):
        new = (keep <= k) & (k < length)
        source = np.maximum.accumulate(np.where(new, rows, 0))
        has = k < length
        source = source[has]
        ids[has, k] = labels[at[source] + k - keep[source]].astype(np.uint32) + 1
    counts = np.frombuffer(block.weights, np.uint8).astype(np.int64)
    counts[counts == _HEAVY] = np.frombuffer(block.heavy, "<i8")
    return vocab, ids, counts


def unite(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One automaton for several: all paths, weights of equal ones added."""
    if len(parts) == 1:
        return parts[0]
    vocab = np.unique(np.concatenate([v for v, _, _ in parts]))
    high, low = [], []
    for own, ids, _ in parts:
        to = np.concatenate([np.zeros(1, np.uint64), np.searchsorted(vocab, own).astype(np.uint64) + np.uint64(1)])
        high.append((to[ids[:, 0]] << np.uint64(32)) | to[ids[:, 1]])
        low.append((to[ids[:, 2]] << np.uint64(32)) | to[ids[:, 3]])
    high, low = np.concatenate(high), np.concatenate(low)
    counts = np.concatenate([c for _, _, c in parts])
    order = np.lexsort((low, high))
    high, low, counts = high[order], low[order], counts[order]
    first = np.flatnonzero(np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))) if len(high) else np.zeros(0, np.int64)
    ids = np.empty((len(first), DEPTH), np.uint32)
    for at, key in ((0, high[first]), (2, low[first])):
        ids[:, at], ids[:, at + 1] = key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)
    return vocab, ids, np.add.reduceat(counts, first) if len(first) else counts


def states(ids: np.ndarray, counts: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(first path, weight) of each state that reads ``level`` symbols, in order."""
    deep = np.flatnonzero(ids[:, level - 1] > 0)
    if not len(deep):
        return deep, deep
    head = ids[deep, :level]
    change = np.append(True, (head[1:] != head[:-1]).any(axis=1))
    first = np.flatnonzero(change)
    return deep[first], np.add.reduceat(counts[deep], first)


class Lookup:
    """Weights of sequences, read from the start state symbol by symbol."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        """``keys`` are distinct sequences (DEPTH symbols, 0 after the end) in any order."""
        order = np.lexsort(keys.T[::-1])
        keys, self.weights = keys[order], weights[order]
        self.levels = []
        state = np.zeros(len(keys), np.int64)  # of the sequence read so far
        for k in range(DEPTH):
            # arcs are (state, symbol) pairs; their place is the next state
            change = np.append(True, (state[1:] != state[:-1]) | (keys[1:, k] != keys[:-1, k])) if len(keys) else np.zeros(0, bool)
            first = np.flatnonzero(change)
            self.levels.append((state[first], keys[first, k]))
            state = np.cumsum(change) - 1
        self.final = state

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The weight of each sequence; 0 for unknown ones."""
        state = np.zeros(len(keys), np.int64)
        ok = np.ones(len(keys), bool) if len(self.weights) else np.zeros(len(keys), bool)
        for k, (source, symbol) in enumerate(self.levels):
            if not ok.any():
                return np.zeros(len(keys), np.int64)
            # arcs are ordered by (state, symbol): the arcs of a state are one run
            lo, hi = np.searchsorted(source, state), np.searchsorted(source, state, side="right")
            state = _search_runs(symbol, lo, hi, keys[:, k])
            ok &= state < hi
            state = np.where(ok, state, 0)
            ok &= symbol[state] == keys[:, k]
            state = np.where(ok, state, 0)
        return np.where(ok, self.weights[state], 0)


def _search_runs(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Per query the first place in values[lo:hi], an ordered run, that is not below the wanted value."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        below = open_ & (values[np.minimum(mid, len(values) - 1)] < wanted)
        lo = np.where(below, mid + 1, lo)
        hi = np.where(open_ & ~below, mid, hi)
