"""Benchmark decontamination: seeds that no copy can avoid, then local alignment.

Test items come in blocks of bounded size, and every block is looked up in
all documents. Seeds are pairs of words that stand side by side or have one
word between them. An alignment that scores S has m matched words and costs of
at most 2 m - S; between two matched words that are no such pair in both texts
it pays 2 at least, so S / 2 - 1 of its pairs are seeds, whatever was edited.
As many less one may be left out; these are the ones that most documents hold,
which decides about the work and never about the result.
Passages with enough of the other seeds are scored by Smith-Waterman alignment
of their words, which also finds edited and paraphrased copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterloom.llm.batches import WordHashes, mixed, row_key, slices, text_frame, without_rows
from clusterloom.storage import snapshot, work_dir

#: So many words in a row, or what scores as much, are evidence at least.
LEAST_WORDS = 3

#: Items are taken in blocks of so many words; each is whole in its block.
BLOCK_WORDS = 400_000

MATCH, MISMATCH, GAP = 2, -1, -1

#: Share of an item's full alignment score from which a passage counts as a copy.
MIN_SCORE = 0.5
#: Of the seeds that every copy holds, the share that may be left out as common.
COMMON_SEEDS = 0.75
#: Alignments of passages up to this size are remembered.
KNOWN_WORDS = 1024

#: What separates words beside white space.
_MARKS = b""".,;:!?"'()[]{}<>|*#$%&/\\-_=+~`^@"""
_TABLE = bytes(32 if byte in _MARKS else byte for byte in range(256))


def plain_words(text: str) -> list[bytes]:
    """Words in lower case without punctuation."""
    return text.lower().encode("utf-8", "replace").translate(_TABLE).split()


def pair_hashes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every pair of words with at most one word between them, and the place of its first word."""
    factor = np.uint64(0x9E3779B97F4A7C15)
    near, far = words[:-1] * factor + words[1:], words[:-2] * factor + words[2:]
    return mixed(np.concatenate([near, far])), np.concatenate([np.arange(len(near)), np.arange(len(far))])


@dataclass(frozen=True)
class Item:
    """A test item: its words as hashes."""

    name: int
    words: np.ndarray


@dataclass(frozen=True)
class Seeds:
    """Pairs by which an item is found: their hashes, how many places of a copy begin one, words a copy can have."""

    grams: np.ndarray
    needed: int
    span: int


def hashed_items(items: list[tuple[int, str]]) -> tuple[list[Item], dict[bytes, int]]:
    """Items of at least ``LEAST_WORDS`` words, with the hashes of all their words.

    A longer item stays whole, since its score is a share of all its words.
    """
    hashes, found, known = WordHashes(), [], {}
    for name, text in items:
        words = plain_words(text or "")
        if len(words) >= LEAST_WORDS:
            found.append(Item(name, hashes.of(words)))
            known.update(zip(words, found[-1].words.tolist()))
    return found, known


def words_of(text: str | None, known: dict[bytes, int]) -> np.ndarray:
    """The words of a document as hashes; those that no item has are 0, since they match nothing."""
    words = plain_words(text or "")
    return np.fromiter(map(known.get, words, repeat(0)), np.uint64, len(words))


class Lookup:
    """Places of sought hashes in an array; most are dismissed by one look at a table of bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.low = np.zeros(1 << 20, bool)
        self.low[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def places(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``values`` that are keys, and which key each is."""
        at = np.nonzero(self.low[(values & np.uint64((1 << 20) - 1)).astype(np.int64)])[0]
        if len(at) == 0 or len(self.keys) == 0:
            return at[:0], at[:0]
        key = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        hit = self.keys[key] == values[at]
        return at[hit], key[hit]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: its score, and the first and last-but-one passage word it ends within.

    Row by row; gaps along a row come from a running maximum.
    """
    slope = np.arange(len(passage) + 1, dtype=np.int32) * -GAP
    row = np.zeros(len(passage) + 1, np.int32)
    begin = np.arange(len(passage) + 1, dtype=np.int32)
    best, best_start, best_end = 0, 0, 0
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH).astype(np.int32)
        diagonal, above = row[:-1] + step, row[1:] + GAP
        fresh = np.zeros_like(row)
        np.maximum(diagonal, above, out=fresh[1:])
        start = begin.copy()
        start[1:] = np.where(diagonal >= above, begin[:-1], begin[1:])
        restart = fresh <= 0
        start[restart] = np.arange(len(start), dtype=np.int32)[restart]
        fresh[restart] = 0
        lifted = fresh + slope
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(len(lifted)), 0))
        row = top - slope
        begin = start[source]
        end = int(row.argmax())
        if row[end] > best:
            best, best_start, best_end = int(row[end]), int(begin[end]), end
    return best, best_start, best_end


class Searcher:
    """Finds passages of documents that align with items."""

    def __init__(self, items: list[Item], seeds: list[Seeds], min_score: float):
        self.items, self.min_score = items, min_score
        grams = np.concatenate([own.grams for own in seeds] or [np.zeros(0, np.uint64)])
        numbers = np.repeat(np.arange(len(seeds)), [len(own.grams) for own in seeds])
        order = np.argsort(grams, kind="stable")
        self.lookup, self.numbers = Lookup(grams), numbers[order]
        self.begins = np.searchsorted(grams[order], self.lookup.keys)
        self.holders = np.diff(np.append(self.begins, len(grams)))
        self.needed = np.array([own.needed for own in seeds], np.int64)
        self.span = np.array([own.span for own in seeds], np.int64)
        self.known: dict[tuple[int, bytes], tuple[int, int, int]] = {}

    def passages(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Stretches in which every passage that reaches an item's score lies: item, first word, one behind the last."""
        grams, starts = pair_hashes(words)
        places, keys = self.lookup.places(grams)
        counts = self.holders[keys]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        numbers = self.numbers[np.repeat(self.begins[keys], counts) + within]
        hits = np.unique(numbers << 32 | np.repeat(starts[places], counts))
        number, at = hits >> 32, hits & 0xFFFFFFFF
        # As many hits as a copy has, the last one no farther from the first than a copy is long.
        first = np.arange(len(hits))
        last = first + self.needed[number] - 1
        first, last = first[last < len(hits)], last[last < len(hits)]
        span = self.span[number[first]]
        close = (number[first] == number[last]) & (at[last] - at[first] <= span - 2)
        first, last, span = first[close], last[close], span[close]
        begins, ends = np.maximum(0, at[last] + 2 - span), np.minimum(len(words), at[first] + span)
        owner, begin, end = -1, 0, 0
        for following in zip(number[first].tolist(), begins.tolist(), ends.tolist()):
            if following[0] == owner and following[1] <= end:
                end = following[2]
                continue
            if owner >= 0:
                yield owner, begin, end
            owner, begin, end = following
        if owner >= 0:
            yield owner, begin, end

    def matches(self, words: np.ndarray) -> list[tuple[int, float, int, int]]:
        """For each item the best passage: item, score, first word and the one behind the last."""
        best: dict[int, tuple[int, float, int, int]] = {}
        for number, begin, behind in self.passages(words):
            item = self.items[number]
            score, start, end = self.aligned(number, words[begin:behind])
            share = score / (MATCH * len(item.words))
            if score < MATCH * LEAST_WORDS or share < self.min_score:
                continue
            if share > best.get(item.name, (0, 0.0))[1]:
                best[item.name] = (item.name, share, begin + start, begin + end)
        return [best[name] for name in sorted(best)]

    def aligned(self, number: int, passage: np.ndarray) -> tuple[int, int, int]:
        key = (number, passage.tobytes())
        found = self.known.get(key)
        if found is None:
            found = align(self.items[number].words, passage)
            if len(self.known) > 10_000:
                self.known.clear()
            if len(passage) < KNOWN_WORDS:
                self.known[key] = found
        return found


def document_counts(held):
    """Per task, in how many of its documents each pair of the block occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, known = held.value
        lookup = Lookup(grams)
        total = np.zeros(len(lookup.keys), np.int64)
        for batch in slices(batches):
            for text in batch["text"].to_pylist():
                _, keys = lookup.places(pair_hashes(words_of(text, known))[0])
                total[np.unique(keys)] += 1
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lookup.keys[seen].view(np.int64)), pa.array(total[seen])], ["gram", "n"]
        )

    return count


def search_in_batches(held, min_score: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, seeds, known = held.value
        searcher = Searcher(items, seeds, min_score)
        for batch in slices(batches):
            rows, ids = [], []
            for at, text in enumerate(batch["text"].to_pylist()):
                found = searcher.matches(words_of(text, known))
                rows += found
                ids += [at] * len(found)
            columns = list(zip(*rows)) or [[], [], [], []]
            kinds = [pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(pa.array(ids, pa.int64()))]
                + [pa.array(column, kind) for column, kind in zip(columns, kinds)],
                ["id", "item_id", "score", "start_word", "end_word"],
            )

    return search


def seeds_of(item: Item, grams: np.ndarray, counts: np.ndarray, min_score: float) -> Seeds:
    """The pairs of an item but for its most common ones, and what a copy is sure to hold of them."""
    hashes, starts = pair_hashes(item.words)
    full = MATCH * len(item.words)
    least = max(int(np.ceil(min_score * full - 1e-9)), MATCH * LEAST_WORDS)
    held = -(-least // 2) - 1
    own, inverse = np.unique(hashes, return_inverse=True)
    n = counts[np.searchsorted(grams, own)]
    begun = [starts[at] for at in np.split(np.argsort(inverse, kind="stable"), np.cumsum(np.bincount(inverse))[:-1])]
    kept, lost = np.ones(len(own), bool), set()
    for at in np.argsort(-n, kind="stable").tolist():
        # A copy has one pair at most per first word, so it loses no more than there are first words.
        touched = lost.union(begun[at].tolist())
        if n[at] == 0 or len(touched) > COMMON_SEEDS * held:
            break
        kept[at], lost = False, touched
    return Seeds(own[kept], held - len(lost), len(item.words) + full - least)


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in order, in blocks whose size in words is bounded; one item is on the driver at least."""
    block, words = [], 0
    for item, text in items.toLocalIterator():
        block.append((item, text))
        words += len((text or "").split())
        if words >= BLOCK_WORDS:
            yield block
            block, words = [], 0
    if block:
        yield block


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """Pairs of a document and a test item it holds a copy of: id, item_id, score, start_word, end_word.

    The score is the alignment score as a share of the item's own; the words
    are those of ``plain_words``, end exclusive. Every pair that reaches
    ``min_score`` is found, if the alignment scores as much as ``LEAST_WORDS``
    words in a row; an item with fewer words cannot be found. A missing or
    empty text holds nothing. Repeated rows are searched each, repeated items
    give their best score once. Other columns are ignored. Per block of items
    documents are read twice, to count the pairs and to search, and never
    shuffled; what is broadcast is one block.
    """
    spark = df.sparkSession
    rows = text_frame(df, id_column, text_column)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, item_id long, score double, start_word long, end_word long"
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("text"))
    found = []
    for block in item_blocks(items.filter("item_id is not null").orderBy("item_id", "text")):
        whole, known = hashed_items(block)
        grams = np.unique(np.concatenate([pair_hashes(item.words)[0] for item in whole] or [np.zeros(0, np.uint64)]))
        counted = rows.select("text").mapInArrow(document_counts(spark.sparkContext.broadcast((grams, known))), "gram long, n long")
        counted = counted.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # one row per pair of the block at most
        counts = np.zeros(len(grams), np.int64)
        counts[np.searchsorted(grams, counted["gram"].to_numpy().view(np.uint64))] = counted["n"].to_numpy()
        seeds = [seeds_of(item, grams, counts, min_score) for item in whole]
        held = spark.sparkContext.broadcast((whole, seeds, known))
        pairs = rows.mapInArrow(search_in_batches(held, min_score), schema)
        found.append(snapshot(pairs, f"{work_dir(spark)}/leaks"))
    empty = spark.createDataFrame([], T._parse_datatype_string(schema))
    return reduce(DataFrame.unionByName, found, empty).withColumnRenamed("id", id_column)


def without_leaks(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that hold no copy of a test item; rows that share an id, or have none, go or stay each for itself."""
    rows = df.select(row_key(id_column, text_column).alias("row"), F.col(text_column).alias("text"))
    leaks = find_leaks(rows, benchmark, "row", "text").select(F.col("row").alias("dropped_row"))
    return without_rows(df, id_column, text_column, leaks.distinct())
