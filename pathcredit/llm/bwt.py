"""Merging Burrows-Wheeler transforms of text shards.

Every shard's texts are read as strings of eight-byte symbols in each of the
eight phases, so a suffix of symbols starts at every byte and 25 symbols are
200 bytes.  A shard is sorted once, alone.  Shards are then merged without
comparing suffixes again: the interleave (which shard each row of the merged
order comes from) is refined by following the transforms' last-to-first
mapping, one more symbol a round.  A row boundary that first appears in round h
has a common prefix of h - 1 symbols; rows that no boundary separates after
round h form a repeated interval with h symbols in common.
"""

from __future__ import annotations

import numpy as np

WIDTH = 8


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, symbol) of every byte at which a whole symbol of one text starts."""
    if len(data) < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, WIDTH)).view(np.uint64).ravel()
    at = np.arange(len(windows))
    ends = offsets[1:][np.searchsorted(offsets[1:], at, "right")]
    keep = np.flatnonzero(at + WIDTH <= ends)
    return keep, windows[keep]


class Shard:
    """Transform of some texts: rows of the end marks first (one a string, in
    order), then the sorted suffixes."""

    def __init__(self, at: np.ndarray, symbol: np.ndarray, text: np.ndarray, phase: np.ndarray):
        n = len(at)
        self.at = at
        _, string = np.unique(text * WIDTH + phase, return_inverse=True)
        self.strings = int(string.max()) + 1 if n else 0
        place = np.argsort(string, kind="stable")  # positions of one string stand in order
        joined = string[place][1:] == string[place][:-1]
        after, before = np.full(n, -1), np.full(n, -1)
        after[place[:-1][joined]] = place[1:][joined]
        before[place[1:][joined]] = place[:-1][joined]
        rank, jump = symbol + self.strings, after.copy()
        while True:
            key = rank * (int(rank.max(initial=0)) + 1) + np.where(jump >= 0, rank[jump], string)
            _, dense = np.unique(key, return_inverse=True)
            rank = dense + self.strings
            if not (jump >= 0).any() or int(dense.max(initial=0)) == n - 1:
                break
            jump = np.where(jump >= 0, jump[jump], -1)
        self.order = np.argsort(rank, kind="stable")
        closing = np.zeros(self.strings, np.int64)
        closing[string[after < 0]] = symbol[after < 0]
        self.transform = np.concatenate([closing, np.where(before >= 0, symbol[before], 0)[self.order]])


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, common): the merged order as rows of the concatenated shards, and
    for every merged row the symbols it shares with the one before, ``depth``
    or more counting as ``depth``."""
    sizes = [len(s.transform) for s in shards]
    chars = np.concatenate([s.transform for s in shards])
    if int(chars.max(initial=0)) < 1 << 16:
        chars = chars.astype(np.uint16)  # a radix sort then
    source = np.repeat(np.arange(len(shards), dtype=np.uint8 if len(shards) < 256 else np.int32), sizes)
    marks = sum(s.strings for s in shards)
    fixed = np.repeat(np.arange(len(shards), dtype=source.dtype), [s.strings for s in shards])
    ordered = np.sort(chars)[marks:]
    fresh = ordered[1:] != ordered[:-1]  # the symbols stand in this order in every round
    block = np.zeros(len(chars), np.int32)
    common = np.zeros(len(chars), np.int64)
    edge = np.ones(len(chars), bool)
    every = np.arange(len(chars), dtype=np.int32)

    def rows(source):
        """Each shard's rows come in its own order: the next one where it is named."""
        row = np.empty(len(source), np.int32)
        row[np.concatenate([np.flatnonzero(source == k) for k in range(len(shards))]) if len(shards) < 8 else np.argsort(source, kind="stable")] = every
        return row

    for _ in range(depth):
        step = np.argsort(chars[rows(source)], kind="stable")[marks:]
        source = np.concatenate([fixed, source[step]])
        group = block[step]
        np.not_equal(group[1:], group[:-1], out=edge[marks + 1 :])
        edge[marks + 1 :] |= fresh
        common += ~edge  # a boundary stays one
        np.cumsum(edge, dtype=np.int32, out=block)
        if edge.all():
            break
    return rows(source), common


def repeated(data: np.ndarray, offsets: np.ndarray, length: int, shards: int = 2) -> np.ndarray:
    """Which bytes start a string of ``length`` bytes (whole symbols, within one
    text) that also starts at another byte."""
    out = np.zeros(len(data), bool)
    at, symbol = symbols(data, offsets)
    if not len(at):
        return out
    depth = length // WIDTH
    _, symbol = np.unique(symbol, return_inverse=True)
    symbol += 1
    text = np.searchsorted(offsets[1:], at, "right")
    phase = (at - offsets[text]) % WIDTH
    bounds = np.searchsorted(text, np.linspace(0, len(offsets) - 1, min(shards, len(offsets) - 1) + 1).astype(int))
    parts = [Shard(at[a:b], symbol[a:b], text[a:b], phase[a:b]) for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
    row, common = merge(parts, depth)
    interval = np.cumsum(common < depth)
    again = np.bincount(interval)[interval] > 1
    where = np.concatenate([np.concatenate([np.full(p.strings, -1), p.at[p.order]]) for p in parts])[row]
    hit = where[again & (where >= 0)]
    hit = hit[hit + length <= offsets[1:][np.searchsorted(offsets[1:], hit, "right")]]
    out[hit] = True
    return out
