"""Quality classifier on supervised subword embeddings.

Words and character 3- and 4-grams inside words are hashed into buckets with a learned vector each;
all pairs of equal words in a row share one bucket, so that stuttering is seen whatever the word.
A document is the average of the vectors of its features; a softmax layer gives the class. Vectors
and layer are trained by plain stochastic gradient descent in numpy, on a sample of at most
``sample`` labelled rows, of which only bucket counts (at most ``BUCKETS`` numbers a document)
reach the driver.

The layer is linear, so what a feature adds to the log-odds is one number for its bucket. Scoring
is a narrow pass that averages these numbers over all features of the whole text; the table of
numbers has a fixed size and is broadcast.

Defined results: a null or empty text has one feature (the end mark) and its score; of several
labels of a key the least counts; null labels are left out; without labels of both classes every
score is the share of class 1 (one half without labels); repeated rows are scored each; a null key
reads as an empty one for the fold; an empty table gives an empty result; columns other than key
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.storage import small_batches, spare
from tidegrid.llm.words import U, Texts, slices, words_of

BUCKETS = 1 << 17
END_MARK = BUCKETS - 1
TWICE = BUCKETS - 2
GRAMS = (3, 4)
SAMPLE = 4000
DIMENSIONS = 10
STEPS = 24_000  # of one document each, whatever the size of the sample
RATE = 0.5
SEED = 20240229


def remainder(key: Column, folds: int = 5) -> Column:
    """The fold of a row, from the checksum of its key as text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, text by text, and how many each text has."""
    words = words_of(texts)
    n = len(words.counts)
    owners = [np.arange(n), words.owner()]
    buckets = [np.full(n, END_MARK), (words.key & U(BUCKETS - 1)).astype(np.int64)]
    same = np.flatnonzero((words.key[1:] == words.key[:-1]) & (owners[1][1:] == owners[1][:-1]))
    owners.append(owners[1][same])
    buckets.append(np.full(len(same), TWICE))
    size = words.end - words.start
    data = texts.data.astype(np.uint32)
    for g in GRAMS:
        if len(data) < g:
            continue
        code = np.zeros(len(data) - g + 1, dtype=np.uint32)
        for i in range(g):
            code = code * np.uint32(16777619) + data[i : len(data) - g + 1 + i] + np.uint32(1)
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        code ^= code >> np.uint32(12)
        k = np.maximum(size - g + 1, 0)
        total = int(k.sum())
        at = np.arange(total) + np.repeat(words.start - (np.cumsum(k) - k), k)
        buckets.append((code[at] & np.uint32(BUCKETS - 1)).astype(np.int64))
        owners.append(np.repeat(owners[1], k))
    return np.concatenate(owners), np.concatenate(buckets)


def bucket_counts(rows: DataFrame, text: str, label: str) -> DataFrame:
    """``label, buckets, counts``: the features of each row, merged by bucket."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(1)):
                owner, bucket = features(texts)
                pair, n = np.unique(owner * BUCKETS + bucket, return_counts=True)
                sizes = np.bincount(pair // BUCKETS, minlength=len(texts.offsets) - 1)
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, len(sizes)),
                        pa.ListArray.from_arrays(offsets, pa.array((pair % BUCKETS).astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32))),
                    ],
                    [label, "buckets", "counts"],
                )

    return rows.select(label, text).mapInArrow(counted, f"`{label}` int, buckets array<int>, counts array<int>")


def train(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> np.ndarray:
    """What a feature of each bucket adds to the log-odds of class 1, by stochastic gradient descent."""
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((2, DIMENSIONS), dtype=np.float32)
    epochs = -(-STEPS // len(rows))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            label, bucket, count = rows[i]
            rate = np.float32(RATE * (1 - done / steps))
            share = (count / count.sum()).astype(np.float32)
            hidden = share @ vectors[bucket]
            odds = np.exp(layer @ hidden - (layer @ hidden).max())
            error = -odds / odds.sum()
            error[label] += 1
            back = error @ layer
            layer += rate * np.outer(error, hidden)
            # shares are small numbers: a rare feature would hardly move, so the step is by presence
            vectors[bucket] += rate * np.outer(np.sqrt(share), back)
            done += 1
    return vectors @ (layer[1] - layer[0])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label", sample: int = SAMPLE) -> np.ndarray:
    """The log-odds table, from at most ``sample`` labelled rows, taken in the order of a hash of the key."""
    told = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).cast("int").alias(label))
    chosen = told.orderBy(F.xxhash64(key), key).limit(sample)
    # at most ``sample`` rows
    held = docs.select(key, text).join(F.broadcast(chosen), key).orderBy(F.xxhash64(key, text)).limit(sample)
    table = bucket_counts(held, text, label).toArrow()
    rows = [
        (int(a.as_py()), b.values.to_numpy(), c.values.to_numpy())
        for a, b, c in zip(table.column(0), table.column(1), table.column(2), strict=True)
    ]
    ones = sum(r[0] for r in rows)
    if ones in (0, len(rows)):
        return np.full(BUCKETS, np.log((ones + 0.5) / (len(rows) - ones + 0.5)), dtype=np.float32)
    return train(rows)


def score(docs: DataFrame, table: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``score``, the chance of class 1, for every row of ``docs``; a score it had is replaced."""
    small_batches(docs.sparkSession)
    keep = [c for c in keep if c.lower() != "score"]
    odds = docs.sparkSession.sparkContext.broadcast(table.astype(np.float32))
    schema = docs.select(*keep).schema.add("score", "double")

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for texts in slices(batch.column(len(keep))):
                owner, bucket = features(texts)
                n = len(texts.offsets) - 1
                total = np.bincount(owner, weights=odds.value[bucket], minlength=n)
                scores.append(1 / (1 + np.exp(-total / np.bincount(owner, minlength=n))))
            values = pa.array(np.concatenate(scores) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], values], [*keep, "score"])

    return docs.select(*keep, F.col(text).cast("binary").alias(spare("score_text", keep))).mapInArrow(scored, schema)
