"""Words of whole batches of texts as numpy arrays: positions, owners and 64-bit keys.

A word is a longest run of bytes that are not one of the six ASCII blanks (space, tab to carriage
return). Texts are never cut: a batch is worked through in slices of whole texts, and the hashing
inside a slice in windows that end at word ends, so temporary memory does not follow the longest
text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
UNBASE = U(pow(int(BASE), -1, 1 << 64))
WINDOW = 1 << 19
SLICE_BYTES = 2 << 20


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


class Powers:
    """Powers of the base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = powers(BASE, 2 * WINDOW)
        self.down = powers(UNBASE, 2 * WINDOW)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            return powers(BASE, n), powers(UNBASE, n)
        return self.up, self.down


POWERS: list[Powers] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Texts(NamedTuple):
    """Bytes of some texts in a row; text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray
    first: int  # row of the batch that text 0 is


class Words(NamedTuple):
    """Words in order; counts[i] of them belong to text i."""

    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    counts: np.ndarray

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def bounds(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.counts)))


def slices(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES, rows: int = 1 << 16) -> Iterator[Texts]:
    """Whole texts of a string or binary column, a few megabytes at a time; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null(b"")
    _, raw, values = column.buffers()
    offsets = np.frombuffer(raw, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        to = min(to, n, at + rows)
        yield Texts(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at)
        at = to


def words_of(texts: Texts, breaks: np.ndarray = BLANK, fold: np.ndarray | None = None) -> Words:
    """Every word of the texts; ``breaks`` says which bytes part words, ``fold`` maps bytes before hashing."""
    data, offsets = texts.data, texts.offsets
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none.astype(U), np.zeros(len(offsets) - 1, dtype=np.int64))
    inside = ~breaks[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < n]
    begins[heads] = inside[heads]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    stops[tails] = inside[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    counts = np.diff(np.searchsorted(start, offsets))
    return Words(start, end, span_keys(data, start, end, fold), counts)


def span_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """A key of each span data[start:end]; spans are in order and do not overlap."""
    if not POWERS:
        POWERS.append(Powers())
    out = np.empty(len(start), dtype=U)
    at = 0
    while at < len(start):
        base = int(start[at])
        to = max(at + 1, int(np.searchsorted(end, base + WINDOW, side="right")))
        piece = data[base : end[to - 1]]
        up, down = POWERS[0].upto(len(piece) + 1)
        values = (piece if fold is None else fold[piece]).astype(U)
        values += U(1)
        values *= up[: len(piece)]
        sums = np.empty(len(piece) + 1, dtype=U)
        sums[0] = 0
        np.cumsum(values, out=sums[1:])
        a, b = start[at:to] - base, end[at:to] - base
        out[at:to] = (sums[b] - sums[a]) * down[a]
        at = to
    # bytes are shifted by one before hashing, so a word of other length has another polynomial
    return mix(out)


def grams(words: Words, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Keys of runs of n words inside a text, with the text of each.

    With ``short``, a text with at least one and fewer than n words has its whole sequence as one.
    """
    counts, key = words.counts, words.key
    bounds = words.bounds()
    k = np.maximum(counts - n + 1, 0)
    owner = np.repeat(np.arange(len(counts)), k)
    first = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + bounds[:-1][owner]
    out = np.zeros(len(first), dtype=U)
    for i in range(n):
        out = mix(out * U(0xD1342543DE82EF95) + key[first + i] + U(i + 1))
    if short:
        few = np.flatnonzero((counts > 0) & (counts < n))
        if len(few):
            extra = np.empty(len(few), dtype=U)
            for j, t in enumerate(few):
                h = np.zeros(1, dtype=U)
                for i in range(int(counts[t])):
                    h = mix(h * U(0xD1342543DE82EF95) + key[bounds[t] + i : bounds[t] + i + 1] + U(i + 101))
                extra[j] = h[0]
            owner, out = np.concatenate((owner, few)), np.concatenate((out, extra))
            order = np.argsort(owner, kind="stable")
            owner, out = owner[order], out[order]
    return owner, out
