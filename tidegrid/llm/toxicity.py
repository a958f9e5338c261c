"""Toxicity classifier with counterfactual regularisation.

Features of a text are its distinct words, beginnings of words (which stand for inflected forms) and
pairs of neighbouring words inside a sentence, hashed into buckets. The classifier is logistic with
one weight a bucket. Coordinate descent with an L1 term picks the telling buckets, most of the
others stay at zero, and the picked ones are fitted again with a ridge; so a text's length adds
nothing to its score.

In every sentence of a labelled row that names a group, each identity term is swapped for each
other term of its kind, the neutral one included. The row is unchanged in what it says, so the
squared change of its log-odds is penalised: weights of a group's names are drawn together and,
through the neutral term, to zero. What is left to tell toxic rows are the words around the names.

Fitted on at most ``sample`` labelled rows, of which only distinct buckets reach the driver; scoring
is a narrow pass over whole texts with a table of fixed size.

Defined results: a null or empty text has the score of no feature; of several labels of a key the
greatest counts; null labels are left out; without labels of both classes every score is the share
of toxic ones (one half without labels); repeated rows are scored each; an empty table gives an
empty result; columns other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.storage import small_batches, spare
from tidegrid.llm.words import LOWER, U, Texts, Words, mix, slices, span_keys, words_of

BUCKETS = 1 << 19
#: Bytes of the beginnings that are features beside the whole word.
STEMS = (4, 5, 6)
SAMPLE = 4000
#: The L1 term, in deviations of the pull that a bucket without any meaning could have.
SPARSITY = 0.4
RIDGE = 0.1
PASSES = 50
#: Weight of the squared change of log-odds under a swap, a document.
FAIRNESS = 2.0

#: Terms of a kind stand for one another; the first of a kind names no group.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("person", "man", "woman", "boy", "girl", "immigrant", "refugee", "foreigner", "muslim", "christian", "jew", "hindu", "buddhist", "atheist"),
    ("people", "men", "women", "immigrants", "refugees", "foreigners", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("human", "male", "female", "gay", "lesbian", "bisexual", "straight", "transgender", "queer", "disabled", "blind", "deaf"),
    ("local", "black", "white", "asian", "african", "american", "european", "mexican", "chinese", "indian", "arab", "jewish", "islamic", "catholic"),
    ("mensch", "mann", "frau", "ausländer", "flüchtling", "moslem", "christ", "jude"),
    ("personne", "homme", "femme", "étranger", "réfugié", "musulman", "chrétien", "juif"),
    ("persona", "hombre", "mujer", "extranjero", "refugiado", "musulmán", "cristiano", "judío"),
)

#: Words end at every ASCII sign that is neither letter nor digit.
BREAKS = np.array([not chr(i).isalnum() if i < 128 else False for i in range(256)])
ENDS = np.zeros(256, dtype=bool)
ENDS[[ord(c) for c in ".!?\n"]] = True


def term_keys(kinds: Sequence[Sequence[str]]) -> dict[int, tuple[bytes, list[bytes]]]:
    """For the key of every term: the term, and the others of its kind, folded like texts."""
    out: dict[int, tuple[bytes, list[bytes]]] = {}
    for kind in kinds:
        folded = [LOWER[np.frombuffer(term.encode(), dtype=np.uint8)].tobytes() for term in kind]
        for term in folded:
            key = span_keys(np.frombuffer(term, dtype=np.uint8), np.array([0]), np.array([len(term)]))
            out.setdefault(int(key[0]), (term, [t for t in folded if t != term]))
    return out


def bucket_of(key: np.ndarray) -> np.ndarray:
    return (key & U(BUCKETS - 1)).astype(np.int64)


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * U(0xD1342543DE82EF95) + second + U(1))


class Read(NamedTuple):
    texts: Texts
    words: Words
    owner: np.ndarray
    sentence: np.ndarray  # number of the sentence, over all texts


def read(texts: Texts) -> Read:
    words = words_of(texts, BREAKS, LOWER)
    owner = words.owner()
    ends = np.concatenate(([0], np.cumsum(ENDS[texts.data])))
    # every text begins another sentence
    return Read(texts, words, owner, ends[words.start] + owner if len(owner) else owner)


def beginnings(texts: Texts, words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every length of ``STEMS`` the words that are longer, and a key of their beginning."""
    out = []
    for size in STEMS:
        at = np.flatnonzero(words.end - words.start > size)
        begin = words.start[at]
        out.append((at, mix(span_keys(texts.data, begin, begin + size, LOWER) + U(size))))
    return out


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of every text: ``(text, bucket)`` in order."""
    _, words, owner, sentence = read(texts)
    same = np.flatnonzero(sentence[1:] == sentence[:-1])
    stems = beginnings(texts, words)
    owners = np.concatenate([owner, owner[same], *[owner[at] for at, _ in stems]])
    keys = np.concatenate([words.key, pair_key(words.key[same], words.key[same + 1]), *[key for _, key in stems]])
    both = np.unique(owners * BUCKETS + bucket_of(keys))
    return both // BUCKETS, both % BUCKETS


def sentence_buckets(words: Sequence[bytes]) -> set[int]:
    """Buckets of one sentence given by its words."""
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    return set(features(Texts(data, np.array([0, len(data)]), 0))[1].tolist())


def swaps(texts: Texts, terms: dict[int, tuple[bytes, list[bytes]]]) -> list[list[tuple[tuple[int, ...], tuple[int, ...]]]]:
    """For every text the distinct ``(buckets lost, buckets gained)`` of one term swapped in one sentence."""
    _, words, owner, sentence = read(texts)
    out: list[set] = [set() for _ in words.counts]
    named = np.flatnonzero(np.isin(words.key, np.array(list(terms), dtype=U)))
    begins, ends = np.searchsorted(sentence, sentence[named]), np.searchsorted(sentence, sentence[named] + 1)
    for at, begin, end in zip(named, begins, ends, strict=True):
        said = [LOWER[texts.data[words.start[i] : words.end[i]]].tobytes() for i in range(begin, end)]
        before = sentence_buckets(said)
        own, others = terms[int(words.key[at])]
        for other in others:
            after = sentence_buckets([other if word == own else word for word in said])
            out[owner[at]].add((tuple(sorted(before - after)), tuple(sorted(after - before))))
    return [sorted(s) for s in out]


class Example(NamedTuple):
    label: int
    buckets: np.ndarray
    swapped: list[tuple[np.ndarray, np.ndarray]]  # buckets, and -1 for lost or 1 for gained


def gathered(rows: DataFrame, text: str, label: str, kinds: Sequence[Sequence[str]]) -> list[Example]:
    """Distinct buckets and swaps of every row; texts stay where they are."""
    terms = term_keys(kinds)
    names = [label, "buckets", "lost", "gained"]

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(1)):
                owner, bucket = features(texts)
                n = len(texts.offsets) - 1
                offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
                found = swaps(texts, terms)
                lists = pa.list_(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.first, n),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(bucket.astype(np.int32))),
                        pa.array([[lost for lost, _ in one] for one in found], lists),
                        pa.array([[gained for _, gained in one] for one in found], lists),
                    ],
                    names,
                )

    schema = f"`{label}` int, buckets array<int>, lost array<array<int>>, gained array<array<int>>"
    table = rows.select(label, text).mapInArrow(counted, schema).toArrow()
    out = []
    for a, b, lost, gained in zip(*[table.column(i) for i in range(4)], strict=True):
        swapped = [
            (np.array([*x, *y], dtype=np.int64), np.repeat([-1.0, 1.0], [len(x), len(y)])) for x, y in zip(lost.as_py(), gained.as_py(), strict=True)
        ]
        out.append(Example(a.as_py(), b.values.to_numpy().astype(np.int64), swapped))
    return out


class Weights(NamedTuple):
    bias: float
    table: np.ndarray

    def odds(self, buckets: np.ndarray) -> float:
        return self.bias + float(self.table[buckets].sum())


class Columns(NamedTuple):
    """The sample by bucket: the rows that hold a bucket, and the swaps that lose (-1) or gain (1) it."""

    buckets: np.ndarray
    rows: list[np.ndarray]
    swaps: list[tuple[np.ndarray, np.ndarray]]
    weights: np.ndarray  # of the swaps

    @staticmethod
    def of(examples: list[Example]) -> Columns:
        def parted(bucket: np.ndarray, *others: np.ndarray) -> dict[int, list[np.ndarray]]:
            order = np.argsort(bucket, kind="stable")
            names, begins = np.unique(bucket[order], return_index=True)
            parts = [np.split(o[order], begins[1:]) for o in others]
            return {int(n): [p[i] for p in parts] for i, n in enumerate(names)}

        none = np.zeros(0, dtype=np.int64)
        sizes = [len(e.buckets) for e in examples]
        held = parted(np.concatenate([e.buckets for e in examples] or [none]), np.repeat(np.arange(len(examples)), sizes))
        every = [(at, sign, 1 / len(e.swapped)) for e in examples for at, sign in e.swapped]
        moved = parted(
            np.concatenate([at for at, _, _ in every] or [none]),
            np.repeat(np.arange(len(every)), [len(at) for at, _, _ in every]),
            np.concatenate([sign for _, sign, _ in every] or [none.astype(float)]),
        )
        names = sorted(set(held) | set(moved))
        return Columns(
            np.array(names, dtype=np.int64),
            [held[n][0] if n in held else none for n in names],
            [(moved[n][0], moved[n][1]) if n in moved else (none, none.astype(float)) for n in names],
            np.array([w for _, _, w in every]),
        )


def descend(columns: Columns, labels: np.ndarray, active: np.ndarray, start: tuple[float, np.ndarray], shrink: float, ridge: float, fairness: float):
    """Bias and weights of the ``active`` columns by coordinate descent: logistic loss, L1, ridge and penalty of swaps."""
    bias, weights = start[0], start[1].copy()
    odds, change = np.full(len(labels), bias), np.zeros(len(columns.weights))
    for j in np.flatnonzero(weights):
        odds[columns.rows[j]] += weights[j]
        np.add.at(change, columns.swaps[j][0], weights[j] * columns.swaps[j][1])
    for _ in range(PASSES):
        furthest = 0.0
        chance = 1 / (1 + np.exp(-odds))
        step = -(chance - labels).sum() / max((chance * (1 - chance)).sum(), 1e-3)
        step = float(np.clip(step, -1, 1))
        bias, odds = bias + step, odds + step
        for j in active:
            rows, (at, sign) = columns.rows[j], columns.swaps[j]
            chance = 1 / (1 + np.exp(-odds[rows]))
            fair = 2 * fairness * columns.weights[at]
            pull = (chance - labels[rows]).sum() + (fair * change[at] * sign).sum() + ridge * weights[j]
            curve = (chance * (1 - chance)).sum() + fair.sum() + ridge + 1e-3
            wanted = weights[j] - pull / curve
            wanted = np.sign(wanted) * max(abs(wanted) - shrink / curve, 0.0)
            step = float(np.clip(wanted - weights[j], -1, 1))
            if step:
                weights[j] += step
                odds[rows] += step
                np.add.at(change, at, step * sign)
                furthest = max(furthest, abs(step))
        if furthest < 1e-2:
            break
    return bias, weights, odds, change


def train(examples: list[Example], fairness: float = FAIRNESS) -> Weights:
    """Weights of all buckets: L1 picks the telling ones, which are then fitted again with a ridge alone."""
    labels = np.array([e.label for e in examples], dtype=float)
    columns = Columns.of(examples)
    toxic = labels.mean()
    bias, weights = float(np.log(toxic / (1 - toxic))), np.zeros(len(columns.buckets))
    shrink = SPARSITY * float(np.sqrt(len(labels) * toxic * (1 - toxic)))
    active = np.zeros(len(weights), dtype=bool)
    odds, change = np.full(len(labels), bias), np.zeros(len(columns.weights))
    owners = np.repeat(np.arange(len(weights)), [len(r) for r in columns.rows])
    holders = np.concatenate(columns.rows) if columns.rows else np.zeros(0, dtype=np.int64)
    while True:
        # weights at zero stay there unless their pull is above the L1 term
        error = 1 / (1 + np.exp(-odds)) - labels
        pull = np.bincount(owners, weights=error[holders], minlength=len(weights))
        for j in np.flatnonzero([len(at) > 0 for at, _ in columns.swaps]) if change.any() else ():
            at, sign = columns.swaps[j]
            pull[j] += (2 * fairness * columns.weights[at] * change[at] * sign).sum()
        more = (np.abs(pull) > shrink * 1.001) & ~active
        if not more.any():
            break
        active |= more
        bias, weights, odds, change = descend(columns, labels, np.flatnonzero(active), (bias, weights), shrink, 0.0, fairness)
    told = np.flatnonzero(weights)
    bias, weights, _, _ = descend(columns, labels, told, (bias, weights), 0.0, RIDGE, fairness)
    table = np.zeros(BUCKETS)
    table[columns.buckets[told]] = weights[told]
    return Weights(bias, table)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "label",
    sample: int = SAMPLE,
    kinds: Sequence[Sequence[str]] = IDENTITY_TERMS,
    fairness: float = FAIRNESS,
) -> Weights:
    """Weights from at most ``sample`` labelled rows, taken in the order of a hash of the key."""
    told = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).cast("int").alias(label))
    chosen = told.orderBy(F.xxhash64(key), key).limit(sample)
    # at most ``sample`` rows
    held = docs.select(key, text).join(F.broadcast(chosen), key).orderBy(F.xxhash64(key, text)).limit(sample)
    small_batches(docs.sparkSession)
    rows = gathered(held, text, label, kinds)
    ones = sum(r.label for r in rows)
    if ones in (0, len(rows)):
        return Weights(float(np.log((ones + 0.5) / (len(rows) - ones + 0.5))), np.zeros(BUCKETS))
    return train(rows, fairness)


def score(docs: DataFrame, weights: Weights, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``score``, the chance of toxicity, for every row; a score it had is replaced."""
    small_batches(docs.sparkSession)
    keep = [c for c in keep if c.lower() != "score"]
    bias, told = weights.bias, np.flatnonzero(weights.table)
    # only buckets with a weight travel: the L1 term leaves few, and never more than BUCKETS
    odds = docs.sparkSession.sparkContext.broadcast((told, weights.table[told]))
    schema = docs.select(*keep).schema.add("score", "double")

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BUCKETS)
        table[odds.value[0]] = odds.value[1]
        for batch in batches:
            scores = []
            for texts in slices(batch.column(len(keep))):
                owner, bucket = features(texts)
                total = bias + np.bincount(owner, weights=table[bucket], minlength=len(texts.offsets) - 1)
                scores.append(1 / (1 + np.exp(-total)))
            values = pa.array(np.concatenate(scores) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], values], [*keep, "score"])

    return docs.select(*keep, F.col(text).cast("binary").alias(spare("score_text", keep))).mapInArrow(scored, schema)
