"""Quality rules: statistics of each text, and the frequency of its lines across documents.

A line is normalised to its words, with A-Z folded, and hashed. For every
host, the distinct documents that hold a line are counted, where equal texts are one document:
copies are no boilerplate. A line is common if more than ``least`` documents of its host hold it,
whatever the size of the host, so a verdict does not turn as the host grows. A ``share`` of the
host's documents can be asked for on top, but by no query. Common lines are removed, and a document
that loses more than ``depleted`` of its words is rejected, as are those that fail the base rules.

One pass parts the texts into rows of (host, text, line), written once. Counting is an aggregate over
them, so a line that all documents share is summed in parts. The rows are joined to the common lines,
salted by text, and summed to the lost words of each text, which join the documents, salted by row. Nothing
of the corpus passes through the driver, and only keys and numbers are shuffled, unless the cleaned text is asked for.

Defined results: a null or empty text has no words and fails the base rules; lines without a word
count nowhere; a null host is a host of its own; repeated rows are judged each and counted once; an
empty table gives an empty result; other columns pass through, but the names of the result
columns replace columns of the same name, whatever their case.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidegrid.llm.storage import small_batches, spare, staged
from tidegrid.llm.words import BLANK, LOWER, U, Texts, Words, grams, mix, slices, span_keys, words_of

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True

LEAST = 20
SHARE = 0.0
DEPLETED = 0.5
#: Tasks among which the rows of one line, or the copies of one text, can be dealt.
SALTS = 32
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTED = StructType([StructField(c, LongType()) for c in COUNTS])
ENTRY = ["host_key", "same", "line", "words"]


class Lines(NamedTuple):
    """Lines with a word: the text of each, its first and last byte, normalised key and number of words."""

    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    words: np.ndarray


def lines_of(texts: Texts, words: Words, folded: np.ndarray) -> Lines:
    """``folded`` are the keys of the normalised words."""
    owner = words.owner()
    if not len(owner):
        none = np.zeros(0, np.int64)
        return Lines(none, none, none, none.astype(U), none)
    breaks = np.flatnonzero(texts.data == 10)
    line = np.searchsorted(breaks, words.start)
    first = np.flatnonzero(np.concatenate(([True], (line[1:] != line[:-1]) | (owner[1:] != owner[:-1]))))
    number = np.diff(np.concatenate((first, [len(owner)])))
    place = np.arange(len(owner)) - np.repeat(first, number)
    key = np.add.reduceat(mix(folded ^ (place.astype(U) * U(0x9FB21C651E98DF25))), first)
    edges = np.concatenate(([-1], breaks, [len(texts.data)]))
    start = np.maximum(edges[line[first]] + 1, texts.offsets[owner[first]])
    end = np.minimum(edges[line[first] + 1], texts.offsets[owner[first] + 1])
    return Lines(owner[first], start, end, mix(key + number.astype(U)), number)


def repeated(owner: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the same key occurs in the same text elsewhere too."""
    order = np.lexsort((key, owner))
    same = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    out = np.zeros(len(key), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def base_counts(texts: Texts, words: Words, lines: Lines) -> list[np.ndarray]:
    """The columns COUNTS of each text."""
    n = len(texts.offsets) - 1
    data = texts.data
    text_of = np.repeat(np.arange(n), np.diff(texts.offsets))
    letters = np.bincount(text_of[~BLANK[data] & ((data & 0xC0) != 0x80)], minlength=n)
    symbols = np.bincount(text_of[SYMBOL[data]], minlength=n)
    raw = span_keys(data, lines.start, lines.end)
    order = np.lexsort((raw, lines.owner))
    again = (raw[order][1:] == raw[order][:-1]) & (lines.owner[order][1:] == lines.owner[order][:-1])
    duplicate = np.bincount(lines.owner[order][1:][again], minlength=n)
    owner, windows = grams(words, 3)
    twice = np.flatnonzero(repeated(owner, windows))
    # window i of a text begins at word i, and a text has two windows fewer than words
    at = twice + 2 * np.cumsum(np.maximum(words.counts, 0) >= 3)[owner[twice]] - 2
    short = np.where(words.counts < 3, words.counts, 0)
    at += np.cumsum(short)[owner[twice]]
    inside = np.zeros(int(words.counts.sum()) + 2, dtype=bool)
    for i in range(3):
        inside[at + i] = True
    repeats = np.bincount(words.owner()[inside[: len(words.start)]], minlength=n)
    return [words.counts, letters, symbols, duplicate, repeats]


def profiled(texts: Texts) -> tuple[Words, Lines]:
    words = words_of(texts)
    return words, lines_of(texts, words, span_keys(texts.data, words.start, words.end, LOWER))


def line_entries(docs: DataFrame, text: str, host: str) -> DataFrame:
    """``host_key, same, line, words``: a row for each line of each distinct text, with its words in all its places."""

    def emitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, same = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for texts in slices(batch.column(2)):
                _, lines = profiled(texts)
                if not len(lines.owner):
                    continue
                order = np.lexsort((lines.key, lines.owner))
                owner, key = lines.owner[order], lines.key[order]
                first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (key[1:] != key[:-1]))))
                rows = texts.first + owner[first]
                words = np.add.reduceat(lines.words[order], first).astype(np.int64)
                columns = [hosts[rows], same[rows], key[first].view(np.int64), words]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ENTRY)

    keyed = docs.select(F.xxhash64(host).alias("host_key"), F.xxhash64(text).alias("same"), F.col(text).cast("binary").alias("raw"))
    each = keyed.mapInArrow(emitted, "host_key long, same long, line long, words long")
    return each.groupBy("host_key", "same", "line").agg(F.max("words").alias("words"))


def common_lines(entries: DataFrame, docs: DataFrame, text: str, host: str, least: int, share: float) -> DataFrame:
    """``host_key, line`` of the lines above both limits; without a share, hosts are not counted."""
    counts = entries.groupBy("host_key", "line").agg(F.count("*").alias("n")).where(F.col("n") > least)
    if not share:
        return counts.select("host_key", "line")
    sizes = docs.select(F.xxhash64(host).alias("host_key"), F.xxhash64(text).alias("same"))
    sizes = sizes.groupBy("host_key").agg(F.count_distinct("same").alias("docs"))
    return counts.join(sizes, "host_key").where(F.col("n") > share * F.col("docs")).select("host_key", "line")


def salted(small: DataFrame, salts: int) -> DataFrame:
    """Every row once for each ``salt``, so that rows of one key on the other side can go to as many tasks."""
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def lost_words(entries: DataFrame, common: DataFrame, salts: int) -> DataFrame:
    """``host_key, same, lost, gone``: words and keys of the common lines of each text that has one."""
    dealt = entries.withColumn("salt", F.pmod("same", F.lit(salts)).cast("int"))
    hits = dealt.join(salted(common, salts), ["host_key", "line", "salt"])
    return hits.groupBy("host_key", "same").agg(F.sum("words").alias("lost"), F.collect_list("line").alias("gone"))


@F.arrow_udf(COUNTED)
def counted(raw: pa.Array) -> pa.Array:
    columns: list[list[np.ndarray]] = [[] for _ in COUNTS]
    for texts in slices(raw):
        for column, values in zip(columns, base_counts(texts, *profiled(texts)), strict=True):
            column.append(values.astype(np.int64))
    return pa.StructArray.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in columns], COUNTS)


@F.arrow_udf(StringType())
def without_lines(raw: pa.Array, gone: pa.Array) -> pa.Array:
    """The texts without the lines of these keys; a line goes with the break behind it."""
    left: list[str] = []
    for texts in slices(raw):
        _, lines = profiled(texts)
        n = len(texts.offsets) - 1
        first = np.searchsorted(lines.owner, np.arange(n + 1))
        for i in range(n):
            a, b = texts.offsets[i], texts.offsets[i + 1]
            keep = np.ones(b - a, dtype=bool)
            mine = slice(first[i], first[i + 1])
            keys = np.array(gone[texts.first + i].as_py() or [], dtype=np.int64)
            hit = np.flatnonzero(np.isin(lines.key[mine].view(np.int64), keys)) + first[i]
            for h in hit.tolist():
                keep[lines.start[h] - a : min(lines.end[h] + 1, b) - a] = False
            left.append(texts.data[a:b][keep].tobytes().decode("utf-8", "replace"))
    return pa.array(left, pa.string())


def line_rules(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    least: int = LEAST,
    share: float = SHARE,
    depleted: float = DEPLETED,
    cleaned: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """``docs`` with COUNTS, ``n_words_left, base_failed, kept``, and the text without common lines as ``cleaned``."""
    small_batches(docs.sparkSession)
    entries = staged(line_entries(docs, text, host))
    lost = lost_words(entries, common_lines(entries, docs, text, host, least, share), salts)
    new = [*COUNTS, "n_words_left", "base_failed", "kept", *([cleaned] if cleaned else [])]
    others = [c for c in docs.columns if c.lower() not in {n.lower() for n in new}]
    key, same, salt, raw, told, words, gone = (
        spare(f"rules_{c}", [*others, *new]) for c in ("host", "same", "salt", "text", "told", "lost", "gone")
    )
    body = F.col(text).cast("binary")
    profile = docs.select(
        *[F.col(f"`{c}`") for c in others],
        F.xxhash64(host).alias(key),
        F.xxhash64(text).alias(same),
        # copies of one text can be a third of all rows: they meet its row in as many tasks as there are salts
        F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias(salt),
        *([body.alias(raw)] if cleaned else []),
        counted(body).alias(told),
    )
    keys = [key, same, salt]
    if not cleaned:
        lost = lost.drop("gone")
    lost = salted(lost, salts)
    lost = lost.select("host_key", "same", "salt", "lost", *(["gone"] if cleaned else [])).toDF(*keys, words, *([gone] if cleaned else []))
    met = profile.join(lost, keys, "left")
    n_words = F.col(f"{told}.n_words")
    left = n_words - F.coalesce(F.col(words), F.lit(0))
    fails = failed(n_words, F.col(f"{told}.n_repeat_words"))
    none = F.array().cast("array<bigint>")
    return met.select(
        *[F.col(f"`{c}`") for c in others],
        *[F.col(f"{told}.{c}").alias(c) for c in COUNTS],
        left.alias("n_words_left"),
        *([without_lines(F.col(raw), F.coalesce(F.col(gone), none)).alias(cleaned)] if cleaned else []),
        fails.alias("base_failed"),
        (~fails & (left >= (1 - depleted) * n_words)).alias("kept"),
    )


def failed(n_words: Column, n_repeat_words: Column) -> Column:
    """The base rules: too few words, or too many in repeated windows."""
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)
