"""Histogram boosting: binned features, best-first trees, missing values with a side of their own.

Features become one byte each: 0 for missing, else a bin of at most 255. Numbers are cut at quantiles
of the training rows, levels have a bin each. A tree grows best first: of all leaves the one whose
split gains most is split next, until there are ``max_leaves``. Splits of numbers are thresholds,
splits of levels are sets (levels in the order of their mean gradient), and missing values go to the
side that gains more.

What a split needs is a histogram: sums of gradient, weight and rows by (leaf, feature, bin). Gradients
and weights are whole numbers (fixed point, scaled so that no sum leaves 53 bits), so sums do not
depend on how rows are dealt out, and the same trees come from any number of tasks:

* ``LOCAL_BYTES`` of binned rows or fewer (a size that is measured) are boosted inside one task for
  each fit, because a job costs more than the work; the fits of a tuning grid run side by side.
* Larger tables are boosted by jobs: one aggregate for each step of growth serves all leaves that may
  be split next. Tasks leave partial histograms, whose sums (leaves x features x bins) reach the
  driver; the histogram of the larger child is its parent's less its sibling's.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.sources.staging import stage

BINS = 255
#: Measured bytes of binned rows up to which a fit runs inside one task.
LOCAL_BYTES = 64 << 20
#: Rows of a leaf.
LEAST_ROWS = 20
#: Trees grown by jobs between two staged tables of scores.
STAGE_EVERY = 10
EXACT_BITS = 52


@dataclass(frozen=True)
class TreeFeatures:
    """Feature lists of a tree model. Missing values need no declaration.

    Only ``categorical`` columns are split as sets, whatever the number of distinct values: their
    levels are frozen in training and an unseen one is an error. All others stay ordered numbers.
    """

    numeric: tuple[str, ...]
    booleans: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()

    @property
    def sources(self) -> list[str]:
        """Source columns, in the order of their bytes."""
        return [*self.numeric, *self.booleans, *self.categorical]

    @property
    def numbers(self) -> int:
        return len(self.numeric) + len(self.booleans)


@dataclass(frozen=True)
class Bins:
    """Cuts of every number (bin b holds values above cut b-2 up to cut b-1) and levels of every set."""

    features: TreeFeatures
    cuts: tuple[tuple[float, ...], ...]
    levels: tuple[tuple[str, ...], ...]

    def columns(self) -> list:
        numbers = [F.col(c).cast("double") for c in (*self.features.numeric, *self.features.booleans)]
        return [*numbers, *[F.col(c).cast("string") for c in self.features.categorical]]

    def codes(self, columns: Sequence[pa.Array], count: int) -> np.ndarray:
        """One byte a feature for every row; an unseen level is an error."""
        out = np.zeros((count, len(self.cuts) + len(self.levels)), dtype=np.uint8)
        for j, cuts in enumerate(self.cuts):
            x = columns[j].to_numpy(zero_copy_only=False).astype(np.float64)
            out[:, j] = np.where(np.isnan(x), 0, np.searchsorted(np.array(cuts), x, side="left") + 1)
        for k, levels in enumerate(self.levels):
            j = len(self.cuts) + k
            known = {level: i + 1 for i, level in enumerate(levels)}
            for i, value in enumerate(columns[j].to_pylist()):
                if value is not None:
                    if value not in known:
                        raise ValueError(f"unseen level {value!r} of {self.features.categorical[k]}")
                    out[i, j] = known[value]
        return out


def fit_bins(df: DataFrame, features: TreeFeatures, accuracy: int = 10_000) -> Bins:
    """Quantile cuts by mergeable sketches and frozen levels, from one aggregate over the training rows."""
    shares = [i / BINS for i in range(1, BINS)]
    numbers = [*features.numeric, *features.booleans]
    told = []
    for i, c in enumerate(numbers):
        x = F.col(c).cast("double")
        told.append(F.percentile_approx(F.when(~F.isnan(x), x), shares, accuracy).alias(f"q{i}"))
    for i, c in enumerate(features.categorical):
        # sketched, so that a column that is no set of levels is refused before its values are gathered
        told.append(F.approx_count_distinct(F.col(c).cast("string"), 0.01).alias(f"d{i}"))
    row = df.agg(*told).head() if told else ()
    for i, c in enumerate(features.categorical):
        if row[f"d{i}"] > 1.1 * BINS:
            raise ValueError(f"{c} has too many levels for a set")
    cuts = tuple(tuple(sorted(set(row[f"q{i}"] or ()))) for i in range(len(numbers)))
    levels: tuple[tuple[str, ...], ...] = ()
    if features.categorical:
        sets = df.agg(*[F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(c) for c in features.categorical]).head()
        levels = tuple(tuple(s) for s in sets)
        if any(len(s) > BINS for s in levels):
            raise ValueError(f"sets have {BINS} levels at most")
    return Bins(features, cuts, levels)


@dataclass
class Tree:
    """Nodes in order of their making: feature (-1 in leaves), children, which bins go left, value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    lefts: list[np.ndarray] = field(default_factory=lambda: [np.zeros(BINS + 1, dtype=bool)])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, lefts: np.ndarray) -> tuple[int, int]:
        self.feature[node], self.lefts[node] = feature, lefts
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for _ in range(2):
            self.feature.append(-1)
            self.left.append(0)
            self.right.append(0)
            self.lefts.append(np.zeros(BINS + 1, dtype=bool))
            self.value.append(0.0)
        return self.left[node], self.right[node]

    def leaf_of(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        feature, left, right, lefts = map(np.asarray, (self.feature, self.left, self.right, self.lefts))
        node = np.zeros(len(codes), dtype=np.int64)
        at = np.flatnonzero(feature[node] >= 0)
        while len(at):
            here = node[at]
            goes = lefts[here, codes[at, feature[here]]]
            node[at] = np.where(goes, left[here], right[here])
            at = at[feature[node[at]] >= 0]
        return node

    def predict(self, codes: np.ndarray) -> np.ndarray:
        return np.asarray(self.value)[self.leaf_of(codes)]

    def kept(self, inner: set[int]) -> Tree:
        """The tree with splits at the nodes ``inner`` alone."""
        out = Tree()
        todo = [(0, 0)]
        while todo:
            old, new = todo.pop()
            out.value[new] = self.value[old]
            if old in inner:
                a, b = out.split(new, self.feature[old], self.lefts[old])
                todo += [(self.right[old], b), (self.left[old], a)]
        return Tree(*map(np.array, (out.feature, out.left, out.right, out.lefts, out.value)))


class Split:
    """The best split of one leaf: gain, feature and the bins that go left."""

    __slots__ = ("gain", "feature", "lefts")

    def __init__(self, gain: float, feature: int, lefts: np.ndarray | None) -> None:
        self.gain, self.feature, self.lefts = gain, feature, lefts


def best_split(histogram: np.ndarray, numbers: int, least: int) -> Split:
    """Over all features of ``histogram[feature, bin, (gradient, weight, rows)]``; ties to the first."""
    count = len(histogram)
    order = np.tile(np.arange(BINS + 1), (count, 1))
    if numbers < count:
        sets = histogram[numbers:]
        mean = np.where(sets[:, :, 2] > 0, sets[:, :, 0] / np.maximum(sets[:, :, 1], 1e-300), np.inf)
        mean[:, 0] = -np.inf  # missing is no level: it keeps its place, and is tried on both sides
        order[numbers:] = np.argsort(mean, axis=1, kind="stable")
    told = np.take_along_axis(histogram, order[:, :, None], axis=1)
    missing, total = told[:, :1], told.sum(axis=1, keepdims=True)
    below = np.cumsum(told[:, 1:], axis=1)  # without missing
    best = Split(0.0, -1, None)
    base = total[:, :, 0] ** 2 / np.maximum(total[:, :, 1], 1e-300)
    for with_missing in (True, False):
        left = below + missing if with_missing else below
        right = total - left
        fits = (left[:, :, 2] >= least) & (right[:, :, 2] >= least) & (left[:, :, 1] > 0) & (right[:, :, 1] > 0)
        gain = left[:, :, 0] ** 2 / np.maximum(left[:, :, 1], 1e-300) + right[:, :, 0] ** 2 / np.maximum(right[:, :, 1], 1e-300) - base
        gain = np.where(fits, gain, -np.inf)
        at = int(np.argmax(gain))
        if gain.flat[at] > best.gain * (1 + 1e-12) + 1e-12:
            feature, place = divmod(at, BINS)
            lefts = np.zeros(BINS + 1, dtype=bool)
            lefts[order[feature, 1 : place + 2]] = True
            lefts[0] = with_missing
            best = Split(float(gain.flat[at]), feature, lefts)
    return best


#: Maps a tree with splits and some of its leaves to their histograms.
Histograms = Callable[[Tree, Sequence[int]], Mapping[int, np.ndarray]]


def grow(histograms: Histograms, numbers: int, max_leaves: int, least: int, step: float, unit: float) -> Tree:
    """One tree, best leaf first. ``unit`` turns summed gradients over summed weights into values.

    Children of all leaves that may still be split are asked for at once, so that a tree takes about
    as many requests as it is deep; splits that were made in vain are taken out in the end.
    """
    tree = Tree()
    sums = {0: histograms(tree, [0])[0]}
    splits = {0: best_split(sums[0], numbers, least)}
    inner: set[int] = set()
    frontier = [0]
    while len(inner) + 1 < max_leaves:
        able = sorted((n for n in frontier if splits[n].feature >= 0), key=lambda n: (-splits[n].gain, n))
        if not able:
            break
        if tree.feature[able[0]] < 0:
            asked = [n for n in able[: max_leaves - len(inner) - 1] if tree.feature[n] < 0]
            wanted = []
            for n in asked:
                children = tree.split(n, splits[n].feature, splits[n].lefts)
                rows = sums[n][splits[n].feature, :, 2]
                fewer = rows[splits[n].lefts].sum() * 2 <= rows.sum()
                wanted.append((n, *(children if fewer else children[::-1])))
            found = histograms(tree, [small for _, small, _ in wanted])
            for n, small, large in wanted:
                sums[small] = found[small]
                sums[large] = sums[n] - found[small]
                splits[small], splits[large] = (best_split(sums[c], numbers, least) for c in (small, large))
        node = able[0]
        inner.add(node)
        frontier.remove(node)
        frontier += [tree.left[node], tree.right[node]]
    for n in frontier:
        gradient, weight, _ = sums[n][0].sum(axis=0)
        tree.value[n] = step * unit * gradient / weight if weight else 0.0
    return tree.kept(inner)


@dataclass(frozen=True)
class Setting:
    """Step, leaves of a tree and number of trees."""

    step: float
    leaves: int
    rounds: int
    least: int = LEAST_ROWS

    @staticmethod
    def of(params: Mapping[str, float]) -> Setting:
        return Setting(float(params["step"]), int(params["leaves"]), int(params["rounds"]), int(params.get("least", LEAST_ROWS)))


@dataclass(frozen=True)
class Scales:
    """What makes gradients and weights whole: the mean label, and the value of one unit of each."""

    base: float
    gradient: float
    weight: float

    def whole(self, label: np.ndarray, weight: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.rint((label - score) * weight / self.gradient), np.rint(weight / self.weight)

    @property
    def unit(self) -> float:
        return self.gradient / self.weight


def scales_of(rows: int, label_sum: float, weight_sum: float, furthest: float, heaviest: float) -> Scales:
    """Units such that sums over all rows stay inside EXACT_BITS; residuals may grow to four times the first."""
    room = float(2 ** (EXACT_BITS - int(np.ceil(np.log2(max(rows, 2))))))
    base = label_sum / weight_sum if weight_sum else 0.0
    return Scales(base, max(4.0 * furthest * heaviest / room, 1e-300), max(heaviest / room, 1e-300))


@dataclass(frozen=True)
class Ensemble:
    """A fitted model: bins, first score and trees."""

    bins: Bins
    base: float
    trees: tuple[Tree, ...]

    def predict(self, codes: np.ndarray, rounds: int | None = None) -> np.ndarray:
        out = np.full(len(codes), self.base)
        for tree in self.trees[:rounds]:
            out += tree.predict(codes)
        return out


def binned(df: DataFrame, bins: Bins, label: str, weight: str | None) -> DataFrame:
    """``code, label, weight`` of every row with a label and a positive weight."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(*[c.alias(f"c{i}") for i, c in enumerate(bins.columns())], F.col(label).cast("double").alias("label"), w.alias("weight"))
    rows = rows.where(F.col("label").isNotNull() & ~F.isnan("label") & (F.col("weight") > 0) & ~F.isnan("weight"))

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = bins.codes(batch.columns, batch.num_rows)
            yield pa.RecordBatch.from_arrays([fixed(codes), batch.column("label"), batch.column("weight")], ["code", "label", "weight"])

    return rows.mapInArrow(coded, "code binary, label double, weight double")


def fixed(codes: np.ndarray) -> pa.Array:
    width = codes.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(codes), [None, pa.py_buffer(np.ascontiguousarray(codes).tobytes())]).cast(pa.binary())


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a binary column of ``width`` bytes each."""
    if not len(column):
        return np.zeros((0, width), dtype=np.uint8)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)


def sums_by_bin(codes: np.ndarray, slot: np.ndarray, slots: int, gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``[slot, feature, bin, 3]`` over rows whose leaf has a slot."""
    width = codes.shape[1]
    place = ((slot[:, None] * width + np.arange(width)) * (BINS + 1) + codes).reshape(-1)
    size = slots * width * (BINS + 1)
    parts = [np.bincount(place, weights=np.repeat(x, width), minlength=size) for x in (gradient, weight)]
    parts.append(np.bincount(place, minlength=size).astype(np.float64))
    return np.stack(parts, axis=-1).reshape(slots, width, BINS + 1, 3)


def boost_here(codes: np.ndarray, label: np.ndarray, weight: np.ndarray, scales: Scales, numbers: int, setting: Setting) -> list[Tree]:
    """All trees of one fit over rows that are at hand."""
    score, trees = np.full(len(codes), scales.base), []
    for _ in range(setting.rounds):
        gradient, whole = scales.whole(label, weight, score)
        members = {0: np.arange(len(codes))}

        def histograms(tree: Tree, nodes: Sequence[int], gradient=gradient, whole=whole, members=members) -> dict[int, np.ndarray]:
            for node in range(len(tree.feature)):
                if tree.feature[node] >= 0 and tree.left[node] not in members:
                    rows = members[node]
                    goes = tree.lefts[node][codes[rows, tree.feature[node]]]
                    members[tree.left[node]], members[tree.right[node]] = rows[goes], rows[~goes]
            rows = np.concatenate([members[n] for n in nodes])
            slot = np.repeat(np.arange(len(nodes)), [len(members[n]) for n in nodes])
            found = sums_by_bin(codes[rows], slot, len(nodes), gradient[rows], whole[rows])
            return dict(zip(nodes, found, strict=True))

        tree = grow(histograms, numbers, setting.leaves, setting.least, setting.step, scales.unit)
        score += tree.predict(codes)
        trees.append(tree)
    return trees


def boost_by_tasks(rows: DataFrame, width: int, scales: Scales, numbers: int, settings: Sequence[Setting]) -> list[list[Tree]]:
    """Every fit inside a task of its own, over a staged table of at most LOCAL_BYTES."""

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(matrix(b.column(0), width), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches]
        if parts:
            codes, label, weight = (np.concatenate(p) for p in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (codes, label, weight)], ["codes", "label", "weight"])

    def fitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, label, weight, i in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                trees = boost_here(
                    np.frombuffer(codes, dtype=np.uint8).reshape(-1, width), np.frombuffer(label), np.frombuffer(weight), scales, numbers, settings[i]
                )
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([pickle.dumps(trees)], pa.binary())], ["i", "trees"])

    one = rows.select("code", "label", "weight").coalesce(1).mapInArrow(packed, "codes binary, label binary, weight binary")
    each = one.withColumn("i", F.explode(F.array(*[F.lit(i) for i in range(len(settings))]))).repartition(len(settings))
    found = {r["i"]: pickle.loads(r["trees"]) for r in each.mapInArrow(fitted, "i int, trees binary").collect()}
    return [found.get(i, []) for i in range(len(settings))]


def boost_by_jobs(rows: DataFrame, width: int, scales: Scales, numbers: int, setting: Setting) -> list[Tree]:
    """All trees of one fit, with one job for every step of growth; no task holds more than its rows."""
    trees: list[Tree] = []
    state, staged_trees = rows.withColumn("score", F.lit(scales.base)), 0
    names = ["node", "place", "gradient", "weight", "rows"]

    def scored(batch: pa.RecordBatch, since: Sequence[Tree]) -> tuple[np.ndarray, np.ndarray]:
        codes, score = matrix(batch.column(0), width), batch.column(3).to_numpy().copy()
        for tree in since:
            score += tree.predict(codes)
        return codes, score

    for _ in range(setting.rounds):
        since = trees[staged_trees:]

        def histograms(tree: Tree, nodes: Sequence[int], since=since, state=state) -> dict[int, np.ndarray]:
            def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = np.zeros((len(nodes), width, BINS + 1, 3))
                slots = np.full(len(tree.feature), -1)
                slots[list(nodes)] = np.arange(len(nodes))
                for batch in batches:
                    codes, score = scored(batch, since)
                    slot = slots[tree.leaf_of(codes)]
                    at = np.flatnonzero(slot >= 0)
                    gradient, whole = scales.whole(batch.column(1).to_numpy(), batch.column(2).to_numpy(), score)
                    total += sums_by_bin(codes[at], slot[at], len(nodes), gradient[at], whole[at])
                node, place = np.nonzero(total.reshape(len(nodes), -1, 3)[:, :, 2])
                held = total.reshape(len(nodes), -1, 3)[node, place].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (node, place, *held.T)], names)

            partial = state.mapInArrow(summed, ", ".join(f"{n} long" for n in names))
            # leaves x features x bins rows at most
            table = partial.groupBy("node", "place").agg(*[F.sum(n).alias(n) for n in names[2:]]).toArrow()
            out = np.zeros((len(nodes), width * (BINS + 1), 3))
            node, place = table.column("node").to_numpy(), table.column("place").to_numpy()
            for k, n in enumerate(names[2:]):
                out[node, place, k] = table.column(n).to_numpy()
            return dict(zip(nodes, out.reshape(len(nodes), width, BINS + 1, 3), strict=True))

        trees.append(grow(histograms, numbers, setting.leaves, setting.least, setting.step, scales.unit))
        if len(trees) - staged_trees == STAGE_EVERY:
            recent = trees[staged_trees:]

            def advanced(batches: Iterable[pa.RecordBatch], recent=recent) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    score = scored(batch, recent)[1]
                    yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], ["code", "label", "weight", "score"])

            state = stage(state.mapInArrow(advanced, "code binary, label double, weight double, score double"))
            staged_trees = len(trees)
    return trees


def fit_ensembles(
    df: DataFrame, features: TreeFeatures, label: str, settings: Sequence[Setting], weight: str | None = None, local_bytes: int = LOCAL_BYTES
) -> list[Ensemble]:
    """One model for each setting over the same rows; rows without a label or a positive weight are left out."""
    bins = fit_bins(df.where(F.col(label).isNotNull()), features)
    rows = stage(binned(df, bins, label, weight))
    width = len(features.sources)
    first = rows.agg(F.count("*").alias("n"), F.sum(F.col("label") * F.col("weight")).alias("y"), F.sum("weight").alias("w"), F.max("weight").alias("m")).head()
    if not first["n"]:
        raise ValueError(f"no rows with {label}")
    base = first["y"] / first["w"]
    furthest = rows.agg(F.max(F.abs(F.col("label") - F.lit(base)))).head()[0]
    scales = scales_of(first["n"], first["y"], first["w"], furthest, first["m"])
    if first["n"] * (width + 16) <= local_bytes:
        fits = boost_by_tasks(rows, width, scales, features.numbers, settings)
    else:
        fits = [boost_by_jobs(rows, width, scales, features.numbers, s) for s in settings]
    return [Ensemble(bins, scales.base, tuple(trees)) for trees in fits]


def predict(df: DataFrame, models: Mapping[str, tuple[Ensemble, int | None]]) -> DataFrame:
    """``df`` with a column for every name: the prediction of a model after so many rounds, in one narrow pass.

    All models share their features; columns of the same name are replaced.
    """
    told = list(models.items())
    features = told[0][1][0].bins.features
    kept = [c for c in df.columns if c not in models]
    extra = [c.alias(f"_c{i}") for i, c in enumerate(told[0][1][0].bins.columns())]
    schema = df.select(*kept).schema
    for name, _ in told:
        schema = schema.add(name, "double")
    shared = df.sparkSession.sparkContext.broadcast(told)  # trees of a fixed number of rounds

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[len(kept) :]
            codes: dict[int, np.ndarray] = {}
            out = []
            for _, (model, rounds) in shared.value:
                if id(model.bins) not in codes:
                    codes[id(model.bins)] = model.bins.codes(columns, batch.num_rows)
                out.append(pa.array(model.predict(codes[id(model.bins)], rounds)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *out], [*kept, *models])

    if any(m.bins.features != features for m, _ in models.values()):
        raise ValueError("models of one pass share their features")
    return df.select(*[F.col(f"`{c}`") for c in kept], *extra).mapInArrow(scored, schema)
