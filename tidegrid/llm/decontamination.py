"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters and digits (any character outside ASCII counts as a letter).
A document is compared with a benchmark item only if they share seeds, that is, runs of ``seed``
words; if the item's words that lie in shared seeds are too few to reach the threshold, no tiling can.
For the pairs that remain, the longest common run of words that is not yet marked is marked as a tile
in both, again and again, down to runs of ``seed`` words. Runs are found by running Karp-Rabin keys
of a search length that halves. The tiles may stand in any order, so reordered passages are caught.
The share of the item's words in tiles is its coverage.

The benchmark is the stated query set: it is taken in blocks of a bounded number of seeds, each
broadcast to one narrow pass over the documents, and no document is shuffled. Blocks follow the
running number of seeds, so their number, not their size, grows with the benchmark; an item is in one
block whole.

Defined results: null or empty documents and items match nothing; an item with fewer words than a
seed is sought as one seed of its own length; repeated documents are reported each, repeated
items each under their own identifier; an empty table gives an empty result; columns other than
key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.storage import small_batches
from tidegrid.llm.words import U, Texts, Words, grams, mix, slices, words_of

SEED = 4
COVERAGE = 0.6
BLOCK_SEEDS = 1 << 20
LONGEST_SEARCH = 32

#: Bytes that part words: all of ASCII but letters and digits.
PARTS = np.ones(256, dtype=bool)
PARTS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def folded(column: pa.Array) -> pa.Array:
    """Lower-cased texts; bytes that are not UTF-8 are replaced."""
    values = column.cast(pa.large_binary()).to_pylist()
    return pa.array([(v or b"").decode("utf-8", "replace").lower().encode() for v in values], pa.large_binary())


class Item:
    """The words of a benchmark item."""

    def __init__(self, name: int | str | None, keys: np.ndarray) -> None:
        self.name = name
        self.keys = keys


class Block:
    """Some items, with their seeds in a table that a document's seeds are looked up in."""

    def __init__(self, items: list[Item], seed: int) -> None:
        self.items = [i for i in items if len(i.keys)]
        self.seed = seed
        seeds, owners, places, widths = [], [], [], []
        for at, item in enumerate(self.items):
            width = min(seed, len(item.keys))
            own = runs(item.keys, width)
            seeds.append(own)
            owners.append(np.full(len(own), at))
            places.append(np.arange(len(own)))
            widths.append(width)
        self.width = np.array(widths, dtype=np.int64)
        self.seeds = np.concatenate(seeds) if seeds else np.zeros(0, U)
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        place = np.concatenate(places) if places else np.zeros(0, np.int64)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds, self.owner, self.place = self.seeds[order], owner[order], place[order]
        self.bits = max(10, int(4 * max(1, len(self.seeds))).bit_length())
        self.filter = np.zeros(1 << self.bits, dtype=bool)
        self.filter[(self.seeds & U((1 << self.bits) - 1)).astype(np.int64)] = True
        self.lengths = sorted(set(widths))

    def hits(self, seeds: np.ndarray) -> np.ndarray:
        """Which of the seeds occur in the block."""
        maybe = np.flatnonzero(self.filter[(seeds & U((1 << self.bits) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.seeds, seeds[maybe]), max(0, len(self.seeds) - 1))
        return maybe[self.seeds[at] == seeds[maybe]] if len(self.seeds) else maybe[:0]

    def candidates(self, seeds: np.ndarray, least: float) -> list[int]:
        """Items of which enough words lie in the seeds found in one document."""
        low, high = np.searchsorted(self.seeds, seeds, "left"), np.searchsorted(self.seeds, seeds, "right")
        found: dict[int, set[int]] = {}
        for a, b in zip(low, high, strict=True):
            for i in range(a, b):
                found.setdefault(int(self.owner[i]), set()).add(int(self.place[i]))
        chosen = []
        for at, places in sorted(found.items()):
            covered = np.zeros(len(self.items[at].keys), dtype=bool)
            for p in places:
                covered[p : p + self.width[at]] = True
            if covered.sum() >= least * len(covered):
                chosen.append(at)
        return chosen


def runs(keys: np.ndarray, n: int) -> np.ndarray:
    """Keys of all runs of n words, salted with n so that lengths don't mix."""
    words = Words(keys, keys, keys, np.array([len(keys)]))
    return mix(grams(words, n)[1] + U(n)) if len(keys) >= n else np.zeros(0, U)


def karp_rabin(keys: list[int], marked: list[bool], n: int) -> Iterator[tuple[int, int]]:
    """Position and running key of every run of n unmarked words."""
    base, modulus = 1_000_003, (1 << 61) - 1
    power = pow(base, n - 1, modulus)
    value = length = 0
    for i, key in enumerate(keys):
        if marked[i]:
            value = length = 0
            continue
        if length == n:
            value = (value - keys[i - n] * power) % modulus
            length -= 1
        value = (value * base + key) % modulus
        length += 1
        if length == n:
            yield i - n + 1, value


def tiles(item: list[int], doc: list[int], least: int) -> list[tuple[int, int, int]]:
    """Tiles ``(place in item, place in document, words)`` by greedy string tiling."""
    in_item, in_doc = [False] * len(item), [False] * len(doc)
    found: list[tuple[int, int, int]] = []
    search = max(least, min(len(item), LONGEST_SEARCH))
    while search:
        starts: dict[int, list[int]] = {}
        for at, value in karp_rabin(item, in_item, search):
            starts.setdefault(value, []).append(at)
        matches: list[tuple[int, int, int]] = []
        longest = 0
        for at, value in karp_rabin(doc, in_doc, search):
            for begin in starts.get(value, ()):
                n = 0
                while (
                    begin + n < len(item)
                    and at + n < len(doc)
                    and item[begin + n] == doc[at + n]
                    and not in_item[begin + n]
                    and not in_doc[at + n]
                ):
                    n += 1
                if n >= search:
                    matches.append((n, begin, at))
                    longest = max(longest, n)
        if longest > 2 * search:
            search = longest  # a much longer run exists: begin again from it
            continue
        order = [(-n, begin, at) for n, begin, at in matches]
        heapify(order)
        while order:
            n, begin, at = heappop(order)
            n = -n
            free = 0
            while free < n and not in_item[begin + free] and not in_doc[at + free]:
                free += 1
            if free < n:
                # its unmarked beginning waits for its turn by length
                if free >= search:
                    heappush(order, (-free, begin, at))
                continue
            in_item[begin : begin + n] = [True] * n
            in_doc[at : at + n] = [True] * n
            found.append((begin, at, n))
        search = 0 if search == least else max(least, search // 2)
    return sorted(found)


def stretches(places: np.ndarray, reach: int) -> list[tuple[int, int]]:
    """Stretches of words that the seeds at these places cover; every tile lies in one."""
    out: list[tuple[int, int]] = []
    for low in places.tolist():
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], low + reach)
        else:
            out.append((low, low + reach))
    return out


def tile_document(keys: np.ndarray, block: Block, least: float) -> Iterator[tuple[int, int, int]]:
    """``(item, tiles, covered words)`` of every item that the document covers enough."""
    seeds = np.concatenate([runs(keys, n) for n in block.lengths])
    for i in block.candidates(np.unique(seeds[block.hits(seeds)]), least):
        item, width = block.items[i], int(block.width[i])
        own = np.isin(runs(keys, width), runs(item.keys, width))
        # words outside shared seeds can be in no tile, so only the stretches of seeds are tiled
        words: list[int] = []
        for gap, (low, high) in enumerate(stretches(np.flatnonzero(own), width)):
            words += [int(k) >> 4 for k in keys[low:high]] + [-1 - gap]
        made = tiles([int(k) >> 4 for k in item.keys], words, width)
        covered = sum(t[2] for t in made)
        if covered >= least * len(item.keys):
            yield i, len(made), covered


def tiled_rows(column: pa.Array, block: Block, least: float) -> Iterator[tuple[int, int, int, int]]:
    """``(row, item, tiles, covered words)`` of a column of texts."""
    for texts, words in words_in(column):
        bounds = words.bounds()
        hit: set[int] = set()
        for n in block.lengths:
            owner, seeds = grams(words, n)
            hit.update(np.unique(owner[block.hits(mix(seeds + U(n)))]).tolist())
        for d in sorted(hit):
            for found in tile_document(words.key[bounds[d] : bounds[d + 1]], block, least):
                yield texts.first + d, *found


def blocks_of(benchmark: DataFrame, item: str, text: str, seed: int, most: int) -> Iterator[Block]:
    """Items in blocks of at most ``most`` seeds (a longer item makes a block of its own)."""
    small_batches(benchmark.sparkSession)
    held: list[Item] = []
    size = 0
    rows = benchmark.select(item, F.col(text).cast("binary").alias(text)).orderBy(item)
    for row in rows.toLocalIterator():
        keys = next(words_in(pa.array([bytes(row[1] or b"")], pa.binary())))[1].key
        if held and size + len(keys) > most:
            yield Block(held, seed)
            held, size = [], 0
        held.append(Item(row[0], keys))
        size += len(keys)
    if held:
        yield Block(held, seed)


def words_in(column: pa.Array) -> Iterator[tuple[Texts, Words]]:
    for texts in slices(folded(column)):
        yield texts, words_of(texts, breaks=PARTS)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    seed: int = SEED,
    coverage: float = COVERAGE,
    block_seeds: int = BLOCK_SEEDS,
) -> DataFrame:
    """``key, item, n_tiles, covered_words, item_words, coverage``, a row for each item that a document gives away."""
    out = None
    for block in blocks_of(benchmark, item, item_text, seed, block_seeds):
        found = block_hits(docs, block, key, text, item, benchmark.schema[item].dataType.simpleString(), coverage)
        out = found if out is None else out.union(found)
    if out is None:
        kinds = f"`{key}` {docs.schema[key].dataType.simpleString()}, `{item}` {benchmark.schema[item].dataType.simpleString()}"
        return docs.sparkSession.createDataFrame([], f"{kinds}, n_tiles long, covered_words long, item_words long, coverage double")
    return out


def block_hits(docs: DataFrame, block: Block, key: str, text: str, item: str, item_kind: str, coverage: float) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)
    kind = docs.schema[key].dataType.simpleString()

    def tiled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value.items
        for batch in batches:
            found = list(tiled_rows(batch.column(1), sent.value, coverage))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                    pa.array([items[f[1]].name for f in found], pa_type(item_kind)),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[3] for f in found], pa.int64()),
                    pa.array([len(items[f[1]].keys) for f in found], pa.int64()),
                ],
                [key, item, "n_tiles", "covered_words", "item_words"],
            )

    rows = docs.select(F.col(key), F.col(text).cast("binary").alias(text))
    found = rows.mapInArrow(tiled, f"`{key}` {kind}, `{item}` {item_kind}, n_tiles long, covered_words long, item_words long")
    return found.withColumn("coverage", F.col("covered_words") / F.col("item_words"))


def pa_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    seed: int = SEED,
    coverage: float = COVERAGE,
    block_seeds: int = BLOCK_SEEDS,
) -> DataFrame:
    """The documents that give no benchmark item away, with all their columns; a narrow pass for each block."""
    at = docs.columns.index(text)
    for block in blocks_of(benchmark, item, item_text, seed, block_seeds):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[f[0] for f in tiled_rows(batch.column(at), sent.value, coverage)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
