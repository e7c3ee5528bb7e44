"""Evaluation passages that leak into documents, found through FM-indexes of document shards."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import local_parts, put_table, spread
from .fm_index import FMIndex

#: A shared run of at least so many words is a leak.
RUN = 9
#: Words in a shard's index, at least; longer texts are indexed in pieces that overlap by RUN - 1 words.
SHARD_WORDS = 400_000
#: Words of a piece of a passage; longer passages are searched in pieces that overlap by RUN - 1 words.
PIECE_WORDS = 2_000
#: Pieces of passages that a task reads and searches at a time.
BLOCK_PIECES = 256
#: Words of passages that a task keeps between shards; beyond them it reads the blocks anew for every shard.
HELD_WORDS = 2_000_000

#: Longest runs of letters or digits of any script.
WORD = re.compile(r"[^\W_]+")

SPANS = "doc_id long, item_id long, start_word long, end_word long"


def words(text: str | None) -> list[str]:
    """The lower-cased words of a text."""
    return WORD.findall(text.lower()) if text else []


class Block:
    """Pieces of passages: their words as numbers in a vocabulary of the block's own, and where runs of RUN words begin."""

    def __init__(self, item_ids: list[int], pieces: pa.ListArray):
        coded = pieces.flatten().dictionary_encode()
        self.vocabulary = coded.dictionary.to_pylist()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        lengths = np.diff(pieces.offsets.to_numpy())
        runs = np.maximum(lengths - RUN + 1, 0)
        begins = np.cumsum(lengths) - lengths
        self.at = np.repeat(begins, runs) + np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
        self.item_ids = np.repeat(np.array(item_ids, np.int64), runs)

    def phrases(self, symbols: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """The runs of words that all have a symbol, as symbols, and their passages."""
        own = np.array([symbols.get(w, 0) for w in self.vocabulary] or [0], np.int64)[self.codes]
        unknown = np.concatenate([[0], np.cumsum(own == 0)])
        known = unknown[self.at + RUN] == unknown[self.at]
        return own[self.at[known][:, None] + np.arange(RUN)], self.item_ids[known]


class Passages:
    """The blocks of all passages, read from the table that put_table() stored; a bounded number of them is kept."""

    def __init__(self, key: str):
        self.paths, self.held, self.whole = local_parts(key), [], False

    def blocks(self) -> Iterator[Block]:
        if self.whole:
            yield from self.held
            return
        held, n = [], 0
        for path in self.paths:
            for batch in pq.ParquetFile(path).iter_batches(BLOCK_PIECES, columns=["item_id", "words"]):
                block = Block(batch.column(0).to_pylist(), batch.column(1))
                n += len(block.codes)
                if n <= HELD_WORDS:
                    held.append(block)
                yield block
        if n <= HELD_WORDS:
            self.held, self.whole = held, True


class Shard:
    """The FM-index of pieces of documents (doc_id, first word's number, words), over the words of these pieces."""

    def __init__(self, pieces: list[tuple[int, int, list[str]]]):
        lengths = np.array([len(w) + 1 for _, _, w in pieces], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(lengths)])
        self.doc_ids = np.array([d for d, _, _ in pieces], np.int64)
        self.offsets = np.array([o for _, o, _ in pieces], np.int64)
        self.symbols: dict[str, int] = {}  # 0 ends the sequence, 1 parts pieces
        text = np.ones(int(self.begins[-1]), np.int64)
        for (_, _, own), b in zip(pieces, self.begins):
            text[b : b + len(own)] = [self.symbols.setdefault(w, len(self.symbols) + 2) for w in own]
        self.index = FMIndex(text, len(self.symbols) + 2)

    def spans(self, block: Block) -> np.ndarray:
        """Spans (doc_id, item_id, first word, behind the last) in columns; those that overlap are merged."""
        phrases, item_ids = block.phrases(self.symbols)
        low, high = self.index.search(phrases)
        n = high - low
        rows = np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        items, at = np.repeat(item_ids, n), self.index.locate(rows)
        piece = np.searchsorted(self.begins, at, "right") - 1
        order = np.lexsort((at, items, piece))
        items, at, piece = items[order], at[order], piece[order]
        new = np.ones(len(at), bool)
        new[1:] = (piece[1:] != piece[:-1]) | (items[1:] != items[:-1]) | (at[1:] > at[:-1] + RUN)
        first, last = np.flatnonzero(new), np.flatnonzero(np.append(new[1:], True)[: len(new)])
        shift = (self.offsets - self.begins[:-1])[piece]
        return np.stack([self.doc_ids[piece[first]], items[first], (at + shift)[first], (at + shift)[last] + RUN])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """The indexes of a partition's documents, one after the other."""
    pieces, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = words(text)
            for offset in range(0, max(1, len(own) - RUN + 1), SHARD_WORDS):
                piece = own[offset : offset + SHARD_WORDS + RUN - 1]
                if len(piece) >= RUN:
                    pieces.append((doc_id, offset, piece))
                    size += len(piece)
                if size >= SHARD_WORDS:
                    yield Shard(pieces)
                    pieces, size = [], 0
    if pieces:
        yield Shard(pieces)


def _find(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Indexes a partition's documents shard by shard, each once, and searches each for all blocks of passages."""
    names, passages = [c.split()[0] for c in SPANS.split(", ")], Passages(key)
    for shard in _shards(batches):
        for block in passages.blocks():
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in shard.spans(block)], names)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages (item_id, item_text) to pieces of their words; those too short to match are left out."""
    for batch in batches:
        out: list[tuple[int, list[str]]] = []
        for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = words(text)
            for at in range(0, len(own) - RUN + 1, PIECE_WORDS):
                out.append((item_id, own[at : at + PIECE_WORDS + RUN - 1]))
        columns = [pa.array([i for i, _ in out], pa.int64()), pa.array([w for _, w in out], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "words"])


def leaked_spans(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Spans of words of documents' `text` that stand in a passage too, `start_word` up to before `end_word`, the
    overlapping ones of a document and passage merged: `doc_id`, `item_id`, `start_word`, `end_word`.

    Passages of fewer than RUN words, and null or empty texts, match nothing. Rows with a null doc_id or item_id are
    ignored, repeated rows give their spans once, empty tables give no row, other columns are not read. Texts of any
    length are indexed whole. Documents are read, split and indexed once, however many passages there are, and aren't
    shuffled; passages are a table that tasks read block by block, so a task holds one shard and one block, or up to
    HELD_WORDS words of passages, and neither is collected or broadcast.
    """
    texts = spread(documents.filter("doc_id is not null").select("doc_id", "text"))
    kept = items.filter("item_id is not null and item_text is not null").select("item_id", "item_text")
    key = put_table(kept.mapInArrow(_pieces, "item_id long, words array<string>").distinct())
    spans = texts.mapInArrow(lambda batches: _find(batches, key), SPANS)
    own = Window.partitionBy("doc_id", "item_id").orderBy("start_word", "end_word")
    reach = F.max("end_word").over(own.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.distinct().withColumn("new", (reach.isNull() | (F.col("start_word") > reach)).cast("int"))
    return (
        opened.withColumn("span", F.sum("new").over(own))
        .groupBy("doc_id", "item_id", "span")
        .agg(F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word"))
        .drop("span")
    )


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that share a run of at least RUN words with a passage: `doc_id`, `item_id`, each pair once."""
    return leaked_spans(documents, items).select("doc_id", "item_id").distinct()
