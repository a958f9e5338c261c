"""Exact n-gram Jaccard join with size-aware treatment of small and large sets.

A document's set holds its distinct word shingles. Documents with equal sets form one class, and
links are sought between classes.

Small sets (up to a boundary) enumerate subsets: two sets of sizes s and t reach the threshold
exactly if they share a subset of c(s, t) shingles, the least overlap that suffices. Every small
set emits its subsets of each size that some partner asks for; whoever meets in a subset of the
size its pair needs is linked, without a check.

Large sets scan inverted lists. A shingle whose list holds one component only can link nothing
new, and a set with more such shingles than it may miss has no partner outside its component. So
the lists are scanned in rounds, each on fewer sets:

1. Lists over a hash range of the shingles (wider for smaller sets) hold sets; most sets have
   enough unshared shingles there and are done.
2. Sets that remain are compared with the leaders of the min-hash bands they fall in, the nearest
   ones by sketch, which gathers big groups of near copies into components with few comparisons per
   set. The same lists now hold components; groups of any size count once.
3. What still remains orders its shingles by (wide hash range, list within one component, list
   length): a prefix of the order must be shared by any linked pair. Pairs of different
   components that meet there and whose sketches allow it are checked exactly.

The boundary between small and large is where the number of emitted subsets and list entries is
least, from the counts of sets by size.

Shingles are 50-bit hashes, so equality of shingles is up to such a collision.

Defined results: a null text and a text without words have an empty set and link with nothing,
themselves included; a text with fewer words than a shingle has its whole sequence as one shingle;
repeated rows are one class; a null key takes part and never is a component's identifier unless it
is alone; columns other than key and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidegrid.llm.components import components
from tidegrid.llm.storage import in_slots, slots_of, small_batches, spare, staged, staged_by
from tidegrid.llm.words import LOWER, U, Texts, grams, mix, slices, words_of

BITS = 50
ROWS = 1 << 14  # sets of a slice, so that owner and shingle fit one integer
SMALLEST, LARGEST = 6, 24  # boundaries between small and large sets that are weighed
LIST_COST = 3  # what an entry of a list costs, against a subset: it may pass three rounds
BANDS, BAND_ROWS = 12, 5
NEAREST = 2
SPARE = 0.02  # what is listed beyond the part that a partner may lack
WIDE = 0.35  # the part of the hash range that comes first in the last round
SKETCH_BITS = 1024
HEAD = 12
FINE_BITS = 1 << 14


class Threshold:
    """Links ask for ``den * intersection >= num * union``."""

    def __init__(self, num: int, den: int) -> None:
        if not 0 < 2 * num > den or num > den:
            raise ValueError("the threshold must be over a half and at most one")
        self.num, self.den = num, den

    def overlap(self, s: int, t: int) -> int:
        """Least intersection that links sets of s and t shingles."""
        return -(-self.num * (s + t) // (self.num + self.den))

    def fits(self, s: int, t: int) -> bool:
        return self.overlap(s, t) <= min(s, t)

    def missed(self, n: Column) -> Column:
        """One more than the shingles of a set of n that a partner may lack."""
        return n - self.least(n) + 1

    def least(self, n: Column) -> Column:
        return F.floor((F.lit(self.num) * n + F.lit(self.den - 1)) / F.lit(self.den)).cast("long")

    def linked(self, both: Column, a: Column, b: Column) -> Column:
        return (self.num + self.den) * both >= self.num * (a + b)

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return self.den * F.least(a, b) >= self.num * F.greatest(a, b)

    def partners(self, s: int, most: int) -> list[int]:
        return [t for t in range(max(1, s * self.num // self.den), most + 1) if self.fits(s, t)]

    @property
    def listed(self) -> float:
        """The part of the hash range that large sets list: somewhat more than the part that a partner may lack."""
        return (self.den - self.num) / self.den + SPARE

    def subset_sizes(self, s: int, most: int) -> list[int]:
        """Sizes of the subsets that a set of s emits when sets up to ``most`` are small."""
        return sorted({c for t in self.partners(s, most) if (c := self.overlap(s, t)) < s or t > s})


def share_listed(n: np.ndarray, limit: Threshold) -> np.ndarray:
    """The part of the hash range that a set of n puts into the first lists; never rises with n.

    Somewhat more than the part that a partner may lack, with room for chance in small sets.
    """
    n = np.maximum(n.astype(np.float64), 1)
    part = np.minimum(1.0, limit.listed + 1.3 / np.sqrt(n))
    part[n <= 2 * LARGEST] = 1.0
    return part


def listed_below(n: np.ndarray, limit: Threshold) -> np.ndarray:
    return np.floor(share_listed(n, limit) * (1 << BITS)).astype(np.int64)


def shingle_sets(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the sets and their sorted shingles, one text after another."""
    owner, key = grams(words_of(texts, fold=LOWER), words, short=True)
    packed = (owner.astype(U) << U(BITS)) | (key >> U(64 - BITS))
    packed.sort()
    if len(packed):
        packed = packed[np.concatenate(([True], packed[1:] != packed[:-1]))]
    sizes = np.bincount((packed >> U(BITS)).astype(np.int64), minlength=len(texts.offsets) - 1)
    return sizes, (packed & U((1 << BITS) - 1)).astype(np.int64)


def sums_of(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def class_keys(sizes: np.ndarray, shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = sums_of(mix(shingles.astype(U)), bounds)
    return mix(total + sizes.astype(U) * U(0xA0761D6478BD642F)).view(np.int64)


def kept_list(shingles: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(keep)))[bounds]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(shingles[keep]))


def with_sets(docs: DataFrame, key: str, text: str, words: int, limit: Threshold, marked: bool) -> DataFrame:
    """``key, mark, n, sid, tokens``: hash of the text (null unless ``marked``), size, class and listed shingles."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(2), rows=ROWS):
                sizes, shingles = shingle_sets(texts, words)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                keep = shingles < np.repeat(listed_below(sizes, limit), sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(sizes)),
                        batch.column(1).slice(texts.first, len(sizes)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(class_keys(sizes, shingles, bounds)),
                        kept_list(shingles, bounds, keep),
                    ],
                    [key, "mark", "n", "sid", "tokens"],
                )

    told = docs.select(F.col(key), (F.xxhash64(text) if marked else F.lit(None).cast("long")).alias("mark"), F.col(text))
    return told.mapInArrow(rows, f"`{key}` {kind}, mark long, n long, sid long, tokens array<long>")


def whole_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``sid, n, tokens, sketch, fine, bands`` of the wanted classes (``sid, rep``)."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(0), rows=ROWS):
                sizes, shingles = shingle_sets(texts, words)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                some = sizes > 0
                each = [shingles[bounds[i] : bounds[i + 1]] for i in np.flatnonzero(some)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(class_keys(sizes, shingles, bounds)[some]),
                        pa.array(sizes.astype(np.int64)[some]),
                        kept_list(shingles, bounds, np.ones(len(shingles), dtype=bool)).filter(pa.array(some)),
                        pa.array([parity_sketch(x, len(x), SKETCH_BITS) for x in each], pa.list_(pa.int64())),
                        pa.array([parity_sketch(x, 4 * len(x), FINE_BITS) for x in each], pa.list_(pa.int64())),
                        pa.array(list(band_keys(shingles, bounds[:-1][some])), pa.list_(pa.int64())),
                    ],
                    ["sid", "n", "tokens", "sketch", "fine", "bands"],
                )

    # a representative's own row is among those with its key; others are thinned out before any shuffle
    held = in_slots(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_key", slots_of(wanted, "rep"))
    found = held.select("_text").mapInArrow(
        rows, "sid long, n long, tokens array<long>, sketch array<long>, fine array<long>, bands array<long>"
    )
    once = found.groupBy("sid").agg(*[F.first(c).alias(c) for c in ("n", "tokens", "sketch", "fine", "bands")])
    return once.join(wanted.select("sid"), "sid", "left_semi")


def band_keys(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each set (none empty), a key of each band of min-hashes."""
    keys = np.zeros((len(starts), BANDS), dtype=U)
    if len(starts):
        base = shingles.astype(U)
        for band in range(BANDS):
            for row in range(BAND_ROWS):
                low = np.minimum.reduceat(mix(base + U((band * BAND_ROWS + row + 1) * 0x632BE59BD9B4E019 % (1 << 64))), starts)
                keys[:, band] = mix(keys[:, band] + low + U(band))
    return keys.view(np.int64)


def parity_sketch(shingles: np.ndarray, slots: int, most: int) -> np.ndarray:
    """A bit for each of about so many hash slots: the parity of the number of shingles in it."""
    slots = min(most, max(64, 1 << max(0, int(slots - 1).bit_length())))
    parity = (np.bincount(shingles & (slots - 1), minlength=slots) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def difference(x: Column, y: Column) -> Column:
    """A lower bound of the symmetric difference of two sets, from their sketches."""

    def xor(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda p, q: p.bitwiseXOR(q))

    def bits(a: Column, b: Column) -> Column:
        return F.aggregate(xor(a, b), F.lit(0), lambda t, v: t + F.bit_count(v))

    def folded(a: Column, half: Column) -> Column:
        return xor(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half))

    # sizes that can be linked differ by one doubling of the slots at most
    more = F.size(x) - F.size(y)
    return F.when(more == 0, bits(x, y)).when(more > 0, bits(folded(x, F.size(y)), y)).otherwise(bits(x, folded(y, F.size(x))))


def most_different(limit: Threshold, a: Column, b: Column) -> Column:
    """The largest symmetric difference of linked sets of these sizes."""
    size = a + b
    return size - 2 * F.ceil(F.lit(limit.num) * size / F.lit(limit.num + limit.den))


def sketched(pairs: DataFrame, sets: DataFrame, limit: Threshold, sketch: str) -> DataFrame:
    """The pairs ``a, b`` that their sketches allow, with the least difference as ``apart``."""
    x, y = (sets.select(F.col("sid").alias(k), F.col("n").alias("n" + k), F.col(sketch).alias("x" + k)) for k in "ab")
    met = pairs.join(x, "a").join(y, "b").where(limit.sizes_fit(F.col("na"), F.col("nb")))
    told = met.select("a", "b", difference(F.col("xa"), F.col("xb")).alias("apart"), most_different(limit, F.col("na"), F.col("nb")).alias("most"))
    return told.where("apart <= most").drop("most")


def checked(pairs: DataFrame, sets: DataFrame, limit: Threshold) -> DataFrame:
    """The pairs ``a, b`` that are links: by finer sketches first, then by their whole sets."""

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column("ta"), batch.column("tb"), strict=True)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = (limit.num + limit.den) * both >= limit.num * (len(x) + len(y))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    close = staged(sketched(pairs, sets, limit, "fine").select("a", "b"))
    # few pairs are left: only their sets move, if the pairs are few enough for Spark to broadcast
    x, y = (close.join(sets.select(F.col("sid").alias(k), F.col("tokens").alias("t" + k)), k) for k in "ab")
    return staged(x.join(y, ["a", "b"]).select("a", "b", "ta", "tb").mapInArrow(exact, "a long, b long"))


def band_links(whole: DataFrame, limit: Threshold) -> DataFrame:
    """Links of sets to leaders of their bands, the nearest by sketch."""
    bands = whole.select("sid", F.explode("bands").alias("band"))
    lead = bands.groupBy("band").agg(F.min("sid").alias("first"), F.max("sid").alias("last")).where("first <> last")
    both = bands.join(lead, "band").select(F.col("sid").alias("a"), F.explode(F.array("first", "last")).alias("b"))
    pairs = both.where("a <> b").distinct()
    near = sketched(pairs, whole, limit, "sketch")
    best = near.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("apart", "b"))).alias("best"))
    chosen = best.select("a", F.explode(F.slice("best", 1, NEAREST)).alias("one")).select("a", F.col("one.b").alias("b"))
    return checked(chosen, whole, limit)


def small_boundary(counts: dict[int, int], limit: Threshold) -> int:
    """The size up to which sets enumerate subsets: least subsets and list entries in all."""

    def work(most: int) -> int:
        subsets = sum(k * sum(comb(s, c) for c in limit.subset_sizes(s, most)) for s, k in counts.items() if s <= most)
        return subsets + LIST_COST * sum(k * s for s, k in counts.items() if s >= first_listed(most, limit))

    return min(range(SMALLEST - 1, LARGEST + 1), key=lambda most: (work(most), most))


def first_listed(most: int, limit: Threshold) -> int:
    """The least size that has partners over the boundary."""
    return min(s for s in range(1, most + 2) if any(limit.fits(s, t) for t in range(most + 1, 2 * most + 4)))


def subset_links(sets: DataFrame, most: int, limit: Threshold) -> DataFrame:
    """Links between small sets: they meet in a subset of the size that their pair needs."""
    sizes = {s: limit.subset_sizes(s, most) for s in range(1, most + 1)}

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, n, c, key = [], [], [], []
            for one, tokens in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                parts = mix(tokens.values.to_numpy().astype(U))
                s = len(parts)
                for size in sizes[s]:
                    sums = subset_sums(parts, s - size)
                    sid += [one] * len(sums)
                    n += [s] * len(sums)
                    c += [size] * len(sums)
                    key += mix(sums + U(size)).view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(sid, pa.int64()), pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(key, pa.int64())],
                ["sid", "n", "c", "key"],
            )

    once = sets.where(F.col("n").between(1, most)).groupBy("sid").agg(F.first("tokens").alias("tokens"))
    subsets = staged(once.mapInArrow(rows, "sid long, n long, c long, key long"))
    # who meets the smallest set of a subset is linked to it, or to nobody there
    least = subsets.groupBy("key", "c").agg(F.min(F.struct("n", "sid")).alias("low"), F.count("*").alias("k")).where("k > 1")
    met = subsets.join(least.select("key", "c", "low"), ["key", "c"])
    fits = limit.linked(F.col("c"), F.col("n"), F.col("low.n")) & (F.col("sid") != F.col("low.sid"))
    return met.where(fits).select(F.col("sid").alias("a"), F.col("low.sid").alias("b")).distinct()


def subset_sums(parts: np.ndarray, without: int) -> np.ndarray:
    """Sums over all subsets that leave out so many elements."""
    sums = np.array([parts.sum(dtype=U)], dtype=U)
    last = np.array([-1])
    for _ in range(without):
        more = [(sums[i] - parts[last[i] + 1 :], np.arange(last[i] + 1, len(parts))) for i in range(len(sums))]
        sums, last = np.concatenate([m[0] for m in more]), np.concatenate([m[1] for m in more])
    return sums


def list_links(docs: DataFrame, sets: DataFrame, classes: DataFrame, limit: Threshold, key: str, text: str, words: int) -> DataFrame:
    """Links between classes of which one at least is large, enough of them to connect every component."""
    ratio = limit.den / limit.num

    def countable(frame: DataFrame) -> Column:
        """Shingles that every possible partner of the set has listed too."""
        n = F.col("n") * F.lit(ratio) + 1
        part = F.least(F.lit(1.0), F.lit(limit.listed) + F.lit(1.3) / F.sqrt(n)) * F.lit(1 - 1e-9)
        return F.col("token") < F.when(n <= 2 * LARGEST, F.lit(1.0)).otherwise(part) * F.lit(float(1 << BITS))

    # round 1: sets with enough shingles of their own are alone
    entries = sets.select("sid", "n", F.explode("tokens").alias("token"))
    entries = entries.select("token", "sid", countable(entries).alias("own"))
    alone = (
        entries.groupBy("token")
        .agg(F.min("sid").alias("sid"), F.max("sid").alias("other"), F.max("own").alias("own"))
        .where("sid = other AND own")
        .groupBy("sid")
        .agg(F.count("*").alias("single"))
    )

    def unsettled(frame: DataFrame, singles: DataFrame) -> DataFrame:
        found = F.coalesce(F.col("single"), F.lit(0))
        return frame.join(singles, "sid", "left").where(found < limit.missed(F.col("n"))).drop("single")

    open1 = staged(unsettled(classes, alone))
    whole = staged_by(whole_sets(docs, open1, key, text, words), "sid")

    # round 2: a few comparisons for each set, with the leaders of its bands
    stars = band_links(whole, limit)
    comps = components(stars).withColumnRenamed("node", "sid")

    known = whole.select("sid", "n", "tokens").join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    entries = known.select("sid", "n", "comp", F.explode("tokens").alias("token"))
    listed = F.col("token") < F.when(F.col("n") <= 2 * LARGEST, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.lit(limit.listed) + F.lit(1.3) / F.sqrt(F.col("n")))
    ) * F.lit(float(1 << BITS))
    entries = staged(entries.where(listed).select("token", "sid", "comp", countable(entries).alias("own")))
    shared = entries.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y")
    settled = entries.where("own").join(shared, "token", "left_anti").groupBy("sid").agg(F.count("*").alias("single"))
    open2 = staged(unsettled(open1, settled).join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid")))

    # round 3: a linked pair shares a shingle in both prefixes of one order
    rest = whole.select("sid", "n", "tokens").join(open2.select("sid", "comp"), "sid")
    wide = F.filter("tokens", lambda t: t < F.lit(int(WIDE * (1 << BITS))))
    missed = limit.missed(F.col("n"))
    rest = rest.withColumn("tokens", F.when(F.size(wide) >= missed, wide).otherwise(F.col("tokens")))
    rest = staged(rest.select("sid", "n", "comp", F.explode("tokens").alias("token")))
    lists = rest.groupBy("token").agg(
        F.count("*").alias("length"), (F.min("comp") != F.max("comp")).cast("int").alias("mixed")
    )
    order = Window.partitionBy("sid").orderBy(F.col("token") >= int(WIDE * (1 << BITS)), "mixed", "length", "token")
    ranked = rest.join(lists, "token").withColumn("place", F.row_number().over(order))
    ranked = ranked.where((F.col("place") <= missed) & (F.col("mixed") == 1)).select("token", "sid", "n", "comp", "place")
    ranked = staged(ranked)
    heads = ranked.groupBy("sid").agg(F.slice(F.array_sort(F.collect_list(F.struct("place", "token"))), 1, HEAD).alias("head"))
    prefix = ranked.join(whole.select("sid", "sketch"), "sid").join(heads, "sid")
    # a pair that meets in an earlier shingle too need not be told again
    earlier = F.transform(F.filter("head", lambda h: h["place"] < F.col("place")), lambda h: h["token"])
    prefix = staged(prefix.withColumn("earlier", earlier).drop("place", "head"))
    x, y = (prefix.select(*[F.col(c).alias(c + side) for c in prefix.columns]) for side in ("_a", "_b"))
    apart = difference(F.col("sketch_a"), F.col("sketch_b"))
    meet = x.join(
        y,
        (F.col("token_a") == F.col("token_b"))
        & (F.col("sid_a") < F.col("sid_b"))
        & (F.col("comp_a") != F.col("comp_b"))
        & limit.sizes_fit(F.col("n_a"), F.col("n_b"))
        & ~F.arrays_overlap("earlier_a", "earlier_b")
        & (apart <= most_different(limit, F.col("n_a"), F.col("n_b"))),
    )
    pairs = staged(meet.select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b")).distinct())
    return stars.union(checked(pairs, whole, limit))


def named_classes(docs: DataFrame, key: str, text: str, words: int, limit: Threshold, marked: bool = False) -> tuple[DataFrame, DataFrame]:
    """The sets of all rows, and ``sid, component_id, first`` of every class: the least key and, if ``marked``, the first row of its component."""
    small_batches(docs.sparkSession)
    sets = staged(with_sets(docs, key, text, words, limit, marked))
    filled = sets.where("n > 0")
    first = F.struct(F.col(key).isNull().alias("unkeyed"), F.col(key).alias("key"), F.col("mark"))
    firsts = [F.min(first).alias("first")] if marked else []
    classes = staged(filled.groupBy("sid").agg(F.min(key).alias("rep"), F.max("n").alias("n"), *firsts))
    counts = {r["n"]: r["k"] for r in classes.where(F.col("n") <= 2 * LARGEST).groupBy("n").agg(F.count("*").alias("k")).collect()}
    most = small_boundary(counts, limit)
    large = F.col("n") >= first_listed(most, limit)
    links = subset_links(filled, most, limit).union(
        list_links(docs, filled.where(large), classes.drop("first").where(large), limit, key, text, words)
    )
    comps = components(links).withColumnRenamed("node", "sid")
    joined = staged(classes.join(comps, "sid", "left").withColumn("comp", F.coalesce("comp", "sid")))
    least = joined.groupBy("comp").agg(F.min("rep").alias("component_id"), *[F.min("first").alias("first") for _ in firsts])
    return sets, joined.drop("first").join(least, "comp").select("sid", "component_id", *["first" for _ in firsts])


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, num: int = 85, den: int = 100
) -> DataFrame:
    """``key, n_shingles, component_id`` for every row: the smallest key reachable by links."""
    sets, named = named_classes(docs, key, text, words, Threshold(num, den))
    result = sets.select(F.col(key), F.col("n").alias("n_shingles"), "sid").join(named, "sid", "left")
    return result.select(
        F.col(key), "n_shingles", F.coalesce(F.col("component_id"), F.col(key)).alias("component_id")
    )


def without_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, num: int = 85, den: int = 100
) -> DataFrame:
    """The rows of ``docs`` with one row of each component, the first by key (null last) and text hash; empty sets stay.

    Rows are told by key and text, so neither repeated rows nor another text under the key of a copy are mistaken.
    """
    sets, named = named_classes(docs, key, text, words, Threshold(num, den), marked=True)
    rows = sets.where("n > 0").select("sid", F.col(key).alias("copy_key"), F.col("mark").alias("copy_mark")).join(named, "sid")
    stays = F.col("copy_key").eqNullSafe(F.col("first.key")) & (F.col("copy_mark") == F.col("first.mark"))
    told = rows.groupBy("copy_key", "copy_mark").agg(F.bool_or(stays).alias("stays"), F.count("*").alias("rows"))
    # as a table, its size is known: a small one is broadcast by Spark, a large one is joined by shuffle
    told = staged(told.where("NOT stays OR rows > 1"))
    mark = spare("copy_hash", docs.columns)
    marked = docs.withColumn(mark, F.xxhash64(text))
    same = marked[key].eqNullSafe(told["copy_key"]) & (marked[mark] == told["copy_mark"])
    out = marked.join(told, same, "left_anti").select(docs.columns)
    repeats = staged(told.where("stays"))
    if repeats.isEmpty():
        return out
    same = marked[key].eqNullSafe(repeats["copy_key"]) & (marked[mark] == repeats["copy_mark"])
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = marked.join(repeats, same, "left_semi").groupBy(key, mark).agg(F.first(row).alias("row")).select("row.*")
    return out.union(once.select(docs.columns))
