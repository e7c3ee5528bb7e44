"""Encoding of a corpus by a byte-level BPE vocabulary: lexicon automaton for frequent words, exact merges for others."""

from __future__ import annotations

import base64
import heapq
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import cut, local_file, put_file, spread
from .transducer import Lexicon

#: The most frequent words of the corpus that are compiled into the automaton; it takes some 20 bytes for each.
LEXICON_WORDS = 32_768
#: Longer words (in bytes) are left to the merges: they are rare, and would only make the automaton long.
LONGEST = 48
#: Word counts, and ids of words outside the lexicon, that a task holds at most.
HELD = 200_000
#: Letters of texts, about, whose words are coded together.
CHUNK = 2_000_000

#: How the vocabulary's text is split before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line a token in base 64 and its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word by exact merges: always the pair of lowest rank, the leftmost of equal ones. A heap of pairs
    over a linked list of pieces keeps a word of any length at n log n."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))  # of the piece that begins here
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue  # one of the two pieces has changed since
        alive[end[i]] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (b := before[i]) >= 0 and (r := ranks.get(word[b:stop])) is not None:
            heapq.heappush(heap, (r, b, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _split(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[int], pa.DictionaryArray]]:
    """Rows with the numbers of their texts' words and these words, coded; rows of some CHUNK letters at a time."""
    split = regex.compile(PATTERN).findall
    for batch in batches:
        words, counts, size, begin = [], [], 0, 0
        for i, text in enumerate(batch.column(column).to_pylist(), 1):
            own = split(text) if text else []
            words += own
            counts.append(len(own))
            size += len(text or "")
            if size >= CHUNK or i == batch.num_rows:
                yield batch.slice(begin, i - begin), counts, pa.array(words, pa.string()).dictionary_encode()
                words, counts, size, begin = [], [], 0, i


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of a partition, handed on whenever many are held."""

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

    held: Counter[str] = Counter()
    for _, _, coded in _split(batches, 0):
        counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)).tolist()
        for word, n in zip(coded.dictionary.to_pylist(), counts):
            if len(word) <= LONGEST:
                held[word] += n
        if len(held) > HELD:
            yield rows()
            held.clear()
    if held:
        yield rows()


def frequent_words(texts: DataFrame, words: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of `text` over all documents. The driver gets at most `words` of them: counts are first put
    into some 250 classes (quarters of a doubling), and whole classes are taken from the top as long as they fit."""
    counts = texts.select("text").mapInArrow(_count_words, "word string, n long")
    totals = cut(counts.groupBy("word").agg(F.sum("n").alias("n")))
    place = F.floor(F.log2("n") * 4)
    classes = totals.groupBy(place.alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect()
    least, held = None, 0
    for r in classes:
        held += r["n"]
        if held > words:
            break
        least = r["c"]
    return [] if least is None else [r["word"] for r in totals.filter(place >= least).select("word").collect()]


class _Encoder:
    """A task's ids of words: the lexicon's, else those of exact merges, of which some are kept."""

    def __init__(self, ranks_key: str, lexicon_key: str):
        self.ranks, self.lexicon = load_ranks(local_file(ranks_key)), Lexicon.open(local_file(lexicon_key))
        self.merged: dict[str, list[int]] = {}

    def _merge(self, word: str) -> list[int]:
        ids = self.merged.get(word)
        if ids is None:
            ids = merge_word(word.encode(), self.ranks)
            if len(self.merged) >= HELD:
                self.merged.clear()
            if len(word) <= LONGEST:
                self.merged[word] = ids
        return ids

    def ids_of(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids and, for each word, where its own begin there and how many they are."""
        numbers, start = self.lexicon.numbers(words), self.lexicon.start
        unseen = np.flatnonzero(numbers < 0)
        known = np.maximum(numbers, 0)
        begin = start[known].astype(np.int64)
        length = start[np.minimum(known + 1, len(start) - 1)] - begin
        own = [self._merge(w) for w in words.take(pa.array(unseen)).to_pylist()]
        length[unseen] = [len(ids) for ids in own]
        begin[unseen] = len(self.lexicon.ids) + np.cumsum(length[unseen]) - length[unseen]
        flat = np.fromiter((i for ids in own for i in ids), np.int32, int(length[unseen].sum()))
        return np.concatenate([self.lexicon.ids, flat]), begin, length


def _encode(batches: Iterator[pa.RecordBatch], ranks_key: str, lexicon_key: str) -> Iterator[pa.RecordBatch]:
    """`doc_id` and `ids` of rows (doc_id, text). A chunk's distinct words are looked up together, once each."""
    encoder = _Encoder(ranks_key, lexicon_key)
    for rows, counts, coded in _split(batches, 1):
        pool, begin, length = encoder.ids_of(coded.dictionary)
        word = coded.indices.to_numpy()
        n = length[word]
        ends = np.append(0, np.cumsum(n))  # of the ids of the words up to each
        flat = pool[np.repeat(begin[word] - ends[:-1], n) + np.arange(ends[-1])]
        offsets = ends[np.append(0, np.cumsum(counts, dtype=np.int64))].astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
        yield pa.RecordBatch.from_arrays([rows.column(0), ids], ["doc_id", "ids"])


def token_ids(documents: DataFrame, ranks_path: str, words: int = LEXICON_WORDS) -> DataFrame:
    """`doc_id` and `ids`, the token ids of `text` without special tokens, one row for every row of documents.

    Null and empty texts give an empty list. Strings that look like special tokens are ordinary text. Texts and words of
    any length are encoded whole, repeated rows each give a row, a null doc_id is kept, an empty table gives no row, other
    columns are not read. Two passes over the texts: word counts (only counts are shuffled), then the encoding, which
    shuffles nothing. The lexicon changes only the speed: unseen words are merged exactly.
    """
    spark = documents.sparkSession
    texts = spread(documents.select("doc_id", "text"))
    ranks = load_ranks(ranks_path)
    lexicon = Lexicon.build({(raw := w.encode()): merge_word(raw, ranks) for w in frequent_words(texts, words)})
    with open(ranks_path, "rb") as f:
        ranks_key = put_file(spark, "ranks", f.read())
    lexicon_key = put_file(spark, "lexicon.bin", lexicon.to_bytes())
    return texts.mapInArrow(lambda batches: _encode(batches, ranks_key, lexicon_key), "doc_id long, ids array<int>")
