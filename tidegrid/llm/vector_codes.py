"""Vector code compression: every vector as a few small codebook indices, found through a GNAT.

Components become integers ``floor(scale * x)``; a vector is cut into equal consecutive parts, and
each part position has a codebook. Training is a fixed number of rounds of assignment and
componentwise floor means; one round is a narrow pass over the staged integers that leaves at most
``parts x entries`` partial sums a task, and the sums of all tasks (as many rows again) are all
that reaches the driver, whatever the number of vectors.

The nearest entry is found in a geometric near-neighbour access tree over the entries of a codebook.
A node holds a few split points, and for every pair of a split point and a child the range of
distances from the one to all entries of the other. A distance of the query to a split point
eliminates every child whose range lies beyond the best distance so far, with all its entries.
Distances are compared as integers (squared); only the ranges are floating, widened outwards, and a
subtree goes on strict inequality only, so entries at equal distance are met and the lower index wins.

Defined results: a vector that is null or holds a null or non-finite component is left out; shorter
vectors, and lengths that the parts do not divide, are filled up with zeros; scaled components are
held within +-2^27, which keeps sums of squares inside 64 bits; codebooks start from the smallest
keys (nulls last, then by vector), from fewer than ``entries`` where there are not so many rows;
repeated rows count each; null labels are one label; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.storage import staged

ARITY = 4
LIMIT = 1 << 27
#: Relative widening of rounded distances: far above the error of a square root and a difference.
SLACK = 2.0**-40
#: A label with more than this share of the rows is joined by broadcast: at most as many as its inverse.
HOT_SHARE = 1 / 1000


class Node(NamedTuple):
    """Split points, the distance ranges [low, high] from each of them to each child, and the children."""

    splits: list[int]
    low: np.ndarray
    high: np.ndarray
    children: list[Node | None]


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = a - b
    return (apart * apart).sum(axis=-1)


def build(entries: np.ndarray, members: list[int] | None = None) -> Node:
    """The tree over rows of ``entries``: split points far apart, the rest with their nearest split point."""
    members = list(range(len(entries))) if members is None else members
    splits = members[:1]
    while len(splits) < min(ARITY, len(members)):
        near = np.min([_squared(entries[members], entries[s]) for s in splits], axis=0)
        near[[members.index(s) for s in splits]] = -1
        splits.append(members[int(np.argmax(near))])
    rest = [m for m in members if m not in splits]
    regions: list[list[int]] = [[] for _ in splits]
    for m in rest:
        regions[int(np.argmin([_squared(entries[m], entries[s]) for s in splits]))].append(m)
    shape = (len(splits), len(splits))
    low, high = np.full(shape, np.inf), np.full(shape, -np.inf)
    for i, s in enumerate(splits):
        for j, region in enumerate(regions):
            # of another child its split point too, so that it need not be met when the child goes
            inside = region if i == j else [splits[j], *region]
            if inside:
                far = np.sqrt(_squared(entries[inside], entries[s]).astype(np.float64))
                low[i, j], high[i, j] = far.min() * (1 - SLACK), far.max() * (1 + SLACK)
    return Node(splits, low, high, [build(entries, r) if r else None for r in regions])


def nearest(root: Node, entries: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each query (ties to the lower index), and the squared distance."""
    best = np.full(len(queries), np.iinfo(np.int64).max)
    which = np.full(len(queries), len(entries))
    todo: list[tuple[Node, np.ndarray]] = [(root, np.arange(len(queries)))]
    while todo:
        node, rows = todo.pop()
        count = len(node.splits)
        alive = np.ones((len(rows), count), dtype=bool)
        far = np.zeros((len(rows), count))
        for i, split in enumerate(node.splits):
            at = np.flatnonzero(alive[:, i])
            if not len(at):
                continue
            mine = rows[at]
            exact = _squared(queries[mine], entries[split])
            closer = (exact < best[mine]) | ((exact == best[mine]) & (split < which[mine]))
            best[mine[closer]], which[mine[closer]] = exact[closer], split
            far[at, i] = np.sqrt(exact.astype(np.float64))
            reach = np.sqrt(best[mine].astype(np.float64)) * (1 + SLACK)
            least, most = far[at, i] * (1 - SLACK), far[at, i] * (1 + SLACK)
            for j in range(count):
                if j != i:
                    gone = (least - node.high[i, j] > reach) | (node.low[i, j] - most > reach)
                    alive[at[gone], j] = False
        for j, child in enumerate(node.children):
            if child is None:
                continue
            at = np.flatnonzero(alive[:, j])
            reach = np.sqrt(best[rows[at]].astype(np.float64)) * (1 + SLACK)
            own = far[at, j]
            gone = (own * (1 - SLACK) - node.high[j, j] > reach) | (node.low[j, j] - own * (1 + SLACK) > reach)
            if not gone.all():
                todo.append((child, rows[at[~gone]]))
    return which, best


class Codebooks(NamedTuple):
    """Integer entries by part, entry and position."""

    values: np.ndarray

    def trees(self) -> list[Node]:
        return [build(part) for part in self.values]

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.values.reshape(-1).tolist())).encode()).hexdigest()


def whole(vectors: DataFrame, vector: str, scale: int) -> Column:
    """The vector as integers."""
    held = F.transform(vector, lambda x: F.greatest(F.least(x.cast("double") * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT))))
    return F.transform(held, lambda x: F.floor(x).cast("int"))


def usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & finite


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros to ``width``."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def assigned(rows: np.ndarray, books: Codebooks, trees: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """Code of every part of every row, and its squared distance."""
    parts, _, wide = books.values.shape
    codes = np.empty((len(rows), parts), dtype=np.int64)
    errors = np.empty((len(rows), parts), dtype=np.int64)
    for p in range(parts):
        codes[:, p], errors[:, p] = nearest(trees[p], books.values[p], np.ascontiguousarray(rows[:, p * wide : (p + 1) * wide]))
    return codes, errors


def improved(ints: DataFrame, books: Codebooks) -> Codebooks:
    """One round: floor means of the parts assigned to each entry; an entry without any stays."""
    parts, count, wide = books.values.shape
    trees = books.trees()

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts * count, wide), dtype=np.int64)
        sizes = np.zeros(parts * count, dtype=np.int64)
        for batch in batches:
            rows = matrix(batch.column(0), parts * wide)
            codes, _ = assigned(rows, books, trees)
            place = codes + np.arange(parts) * count
            np.add.at(totals, place.reshape(-1), rows.reshape(-1, wide))
            sizes += np.bincount(place.reshape(-1), minlength=parts * count)
        at = np.flatnonzero(sizes)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sizes[at]), *[pa.array(totals[at, i]) for i in range(wide)]], names)

    sums = [f"s{i}" for i in range(wide)]
    names = ["place", "size", *sums]
    partial = ints.select("ints").mapInArrow(summed, ", ".join(f"{n} long" for n in names))
    # at most parts x entries rows
    rows = partial.groupBy("place").agg(*[F.sum(n).alias(n) for n in names[1:]]).collect()
    values = books.values.copy()
    for row in rows:
        values[row["place"] // count, row["place"] % count] = [row[s] // row["size"] for s in sums]
    return Codebooks(values)


def fit_codebooks(ints: DataFrame, key: str, parts: int = 8, entries: int = 16, rounds: int = 6) -> Codebooks | None:
    """Codebooks of a staged table with ``key`` and integer vectors ``ints``; None without rows."""
    width = ints.agg(F.max(F.size("ints"))).head()[0]
    if width is None:
        return None
    wide = max(1, -(-width // parts))
    first = ints.orderBy(F.col(key).asc_nulls_last(), "ints").select("ints").limit(entries).toArrow().column(0).combine_chunks()
    start = matrix(first, parts * wide).reshape(-1, parts, wide).transpose(1, 0, 2)
    books = Codebooks(np.ascontiguousarray(start))
    for _ in range(rounds):
        after = improved(ints, books)
        if (after.values == books.values).all():
            break  # every further round would repeat this one
        books = after
    return books


def encode(ints: DataFrame, books: Codebooks, keep: list[str]) -> DataFrame:
    """The columns ``keep``, ``code`` (two hex digits a part) and ``error`` (squared distances summed)."""
    parts, _, wide = books.values.shape
    trees = books.trees()
    schema = ints.select(*keep).schema.add("code", "string").add("error", "long")
    digits = np.array([f"{i:02x}" for i in range(max(256, books.values.shape[1]))], dtype=object)

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = assigned(matrix(batch.column(len(keep)), parts * wide), books, trees)
            text = ["".join(row) for row in digits[codes]]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(text, pa.string()), pa.array(errors.sum(axis=1))], [*keep, "code", "error"])

    return ints.select(*keep, "ints").mapInArrow(coded, schema)


def with_totals(coded: DataFrame, label: str) -> DataFrame:
    """``label_error``, the error summed over all rows of equal label, on every row of a staged table.

    Labels with many rows (at most 1 / HOT_SHARE of them) meet their rows by broadcast, so that no
    task gathers a hot label; the others meet by an ordinary join.
    """
    sums = staged(coded.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"), F.count("*").alias("_rows")))
    rows = sums.agg(F.coalesce(F.sum("_rows"), F.lit(0))).head()[0]
    is_hot = F.col("_rows") > rows * HOT_SHARE
    hot, others = sums.where(is_hot).drop("_rows"), sums.where(~is_hot).drop("_rows")
    same = F.col(label).eqNullSafe(F.col("_label"))
    often = coded.join(F.broadcast(hot), same).drop("_label")
    seldom = coded.join(F.broadcast(hot.select("_label")), same, "left_anti").join(others, same).drop("_label")
    return often.unionByName(seldom)


def compress(
    vectors: DataFrame, key: str, vector: str, label: str, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> tuple[DataFrame, Codebooks | None]:
    """Key, label, code, error and error of the label for every usable vector, and the codebooks."""
    rows = vectors.where(usable(vector)).select(F.col(key).alias("_key"), F.col(label).alias("_of"), whole(vectors, vector, scale).alias("ints"))
    ints = staged(rows)
    books = fit_codebooks(ints, "_key", parts, entries, rounds)
    if books is None:
        spark = vectors.sparkSession
        kinds = vectors.select(F.col(key), F.col(label)).schema
        return spark.createDataFrame([], kinds.add("code", "string").add("error", "long").add("label_error", "long")), None
    coded = staged(encode(ints, books, ["_key", "_of"]))
    out = with_totals(coded, "_of")
    return out.select(F.col("_key").alias(key), F.col("_of").alias(label), "code", "error", "label_error"), books


def oracle(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The query in SQL: every distance to every entry, round by round."""
    nearest = """SELECT q.id, q.p, arg_min(b.e, (b.d, b.e)) AS e, min(b.d) AS d
      FROM (SELECT s.id, s.p, c.e, list_sum(list_transform(list_zip(s.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
            FROM cut s JOIN {books} c ON c.p = s.p) b JOIN cut q ON q.id = b.id AND q.p = b.p GROUP BY q.id, q.p"""
    steps = [
        f"""kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id, vec_id, label,
          list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""cut AS (SELECT id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) r(p))""",
        f"b0 AS (SELECT p, id - 1 AS e, x FROM cut WHERE id <= {entries})",
    ]
    for i in range(rounds):
        steps.append(f"a{i} AS (" + nearest.format(books=f"b{i}") + ")")
        steps.append(
            f"""m{i} AS (SELECT p, e, list(m ORDER BY place) AS x FROM (
              SELECT a.p, a.e, u.place, CAST((sum(u.x) - (sum(u.x) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
              FROM a{i} a JOIN (SELECT id, p, unnest(x) AS x, generate_subscripts(x, 1) AS place FROM cut) u ON u.id = a.id AND u.p = a.p
              GROUP BY a.p, a.e, u.place) GROUP BY p, e)"""
        )
        steps.append(f"b{i + 1} AS (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m ON m.p = b.p AND m.e = b.e)")
    return f"""WITH {", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)},
    coded AS MATERIALIZED (SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM ({nearest.format(books=f"b{rounds}")}) GROUP BY id)
    SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
      (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
    FROM kept k JOIN coded c ON c.id = k.id"""
