"""Token counts by heap-and-linked-list byte-pair merging.

A text is a row of symbols in a linked list. A heap holds every adjacent pair that is a piece of
the vocabulary; the pair of best score (leftmost on ties) is merged again and again. The number of
tokens is the number of initial symbols less the merges, and a symbol that is no piece counts its
UTF-8 bytes instead (byte fallback). No identifiers are made.

Pieces of the vocabulary never cross certain places (before a run of blanks, between a letter and
a non-letter), which is checked when the model is loaded. Texts are cut there, so the merging of a
chunk depends on the chunk alone and is remembered in a bounded cache of each worker.

Defined results: a null or empty text has 0 bytes and 0 tokens; texts of any length are counted
whole; repeated rows are counted each; an empty table gives an empty result; other columns are not
read. Bytes that are not UTF-8 read as U+FFFD.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.storage import small_batches

MARK = "▁"  # fixed value: what the vocabulary writes for a blank
CACHED_CHUNKS = 1_200_000
CACHED_LENGTH = 48


class MergeCounter(dict):
    """Tokens of a chunk, counted on first use."""

    def __init__(self, order: dict[str, float], singles: frozenset[str]) -> None:
        super().__init__()
        self.order = order
        self.singles = singles
        self.words = WordTokens(self)
        # word characters that are no letters, like superscript digits, stand with the other signs
        signs = "".join(sorted({c for piece in order for c in piece if c.isalnum() and not c.isalpha() and not c.isdecimal()}))
        #: A chunk: a run of blanks with the letters, or the other signs, after it.
        self.chunk = re.compile(rf" *(?:[^\W\d_{signs}]+|(?:[^\w ]|[\d_{signs}])+)| +")
        for piece in order:
            if self.chunk.fullmatch(piece) is None or "\n" in piece:
                raise ValueError(f"piece {piece!r} crosses a place where texts are cut")

    def __missing__(self, chunk: str) -> int:
        n = self.merged(chunk)
        if len(chunk) <= CACHED_LENGTH:
            if len(self) >= CACHED_CHUNKS:
                self.clear()
            self[chunk] = n
        return n

    def merged(self, chunk: str) -> int:
        order = self.order
        symbols = list(chunk)
        n = len(symbols)
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in order:
                heap.append((order[pair], i, pair))
        merges = 0
        if heap:
            heapify(heap)
            after = list(range(1, n + 1))
            before = list(range(-1, n - 1))
            while heap:
                _, left, pair = heappop(heap)
                right = after[left]
                if right >= n or symbols[left] + symbols[right] != pair or not symbols[left]:
                    continue
                merges += 1
                symbols[left] = pair
                symbols[right] = ""
                beyond = after[left] = after[right]
                if beyond < n:
                    before[beyond] = left
                    longer = pair + symbols[beyond]
                    if longer in order:
                        heappush(heap, (order[longer], left, longer))
                ahead = before[left]
                if ahead >= 0:
                    longer = symbols[ahead] + pair
                    if longer in order:
                        heappush(heap, (order[longer], ahead, longer))
        rest = [s for s in symbols if len(s) == 1 and s not in self.singles]
        return n - merges + sum(len(s.encode("utf-8", "surrogatepass")) - 1 for s in rest)

    def of_run(self, run: str) -> int:
        return sum(map(self.__getitem__, self.chunk.findall(run)))

    def count(self, text: str) -> int:
        """Tokens of one whole text, with the blank that the model puts before it.

        A line break is part of no piece, so lines stand alone; so do words with one blank before.
        """
        if not text:
            return 0
        lines = text.replace(MARK, " ").split("\n")
        lines[0] = " " + lines[0]
        total = len(lines) - 1
        for line in lines:
            head, *words = line.split(" ")
            if head:
                total += self.of_run(head)
            if "" in words:
                total += self.of_run(line[len(head) :])
            elif words:
                total += sum(map(self.words.__getitem__, words))
        return total


class WordTokens(dict):
    """Tokens of a word with one blank before it."""

    def __init__(self, chunks: MergeCounter) -> None:
        super().__init__()
        self.chunks = chunks

    def __missing__(self, word: str) -> int:
        n = self.chunks.of_run(" " + word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_CHUNKS:
                self.clear()
            self[word] = n
        return n


def load_counter(model_file: str) -> MergeCounter:
    """The merge order of a sentencepiece BPE model; refuses models that the cuts do not suit."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    order: dict[str, float] = {}
    singles = set()
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace(MARK, " ")
        if len(piece) == 1:
            singles.add(piece)
        else:
            order[piece] = -model.get_score(i)
    probe = [len(model.encode(x)) for x in ("", " a", "a  b", "\u0085")]
    counter = MergeCounter(order, frozenset(singles))
    if probe != [counter.count(x) for x in ("", " a", "a  b", "\u0085")]:
        raise ValueError("the model normalises texts or lacks byte fallback")
    return counter


COUNTERS: dict[str, MergeCounter] = {}


def counter_of(model_name: str) -> MergeCounter:
    """The worker's own counter; the vocabulary is read from the installed tokenizer files."""
    if model_name not in COUNTERS:
        import public_tokenizers

        COUNTERS[model_name] = load_counter(public_tokenizers.path(model_name))
    return COUNTERS[model_name]


def count_tokens(
    docs: DataFrame, model_name: str = "piece_bpe_32k.model", limit: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for every row of ``docs``; a narrow pass without a shuffle."""
    kind = docs.schema[key].dataType.simpleString()
    small_batches(docs.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model_name)
        for batch in batches:
            sizes, tokens = [], []
            for value in batch.column(1):
                raw = value.as_py() or b""
                sizes.append(len(raw))
                tokens.append(counter.count(raw.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                [key, "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(key), F.col(text).cast("binary").alias(text))
    counted = rows.mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
