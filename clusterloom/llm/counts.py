"""Unigram token counts with shared prefixes.

The best segmentation of a pre-token is found by a forward pass over its
characters. What the pass holds after a prefix depends on the prefix alone,
so distinct pre-tokens go into a trie and every node, that is every distinct
prefix, is computed once; the node where a pre-token ends stores its counts.
The trie is walked as its sorted list of pre-tokens: their order is the
depth-first order of the nodes, and the current path is all that is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from clusterloom.llm.batches import CACHE_WORDS, slices, small_file, text_frame, texts_of

#: Scores are whole numbers of this fraction of a nat, so that sums and ties are exact.
SCALE = 1_000_000

SPACE = "▁"

COUNTS = ("n_words", "n_tokens", "n_byte_tokens", "score")


@dataclass(frozen=True)
class Pieces:
    """Scores of the pieces by text, and what a byte that no piece covers costs."""

    scores: dict[str, int]
    byte_score: int

    @classmethod
    def from_model(cls, data: bytes) -> Pieces:
        """Pieces of a sentencepiece file with byte fallback.

        The file orders pieces by frequency without giving probabilities.
        They are taken from the rank by Zipf's law: log p = -log(rank + 1),
        up to a constant. A byte costs as much as the rarest piece.
        """
        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        size = model.get_piece_size()
        usable = [
            i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        rank = {model.id_to_piece(i): n for n, i in enumerate(usable, 1)}
        constant = math.log(sum(1 / n for n in rank.values()))
        scores = {piece: -round(SCALE * (math.log(n) + constant)) for piece, n in rank.items()}
        return cls(scores, min(scores.values()))


class PrefixWalk:
    """Best score, tokens and byte tokens after every prefix of the current path."""

    def __init__(self, pieces: Pieces):
        self.scores = pieces.scores
        self.byte_score = pieces.byte_score
        self.endings = {piece[i:] for piece in pieces.scores for i in range(len(piece))}
        self.path = ""
        self.best: list[tuple[int, int, int]] = [(0, 0, 0)]

    def to(self, text: str) -> tuple[int, int, int]:
        """Move to a text, computing the prefixes it does not share with the one before."""
        path, best, shared = self.path, self.best, 0
        for a, b in zip(path, text):
            if a != b:
                break
            shared += 1
        del best[shared + 1 :]
        scores, endings = self.scores, self.endings
        for end in range(shared + 1, len(text) + 1):
            found = None
            start = end - 1
            while start >= 0 and (ending := text[start:end]) in endings:
                score = scores.get(ending)
                if score is not None:
                    total, tokens, raw = best[start]
                    # Of equally good ways the one with the shorter last piece stays.
                    if found is None or total + score > found[0]:
                        found = (total + score, tokens + 1, raw)
                start -= 1
            size = len(text[end - 1].encode())
            total, tokens, raw = best[end - 1]
            if found is None or total + size * self.byte_score > found[0]:
                found = (total + size * self.byte_score, tokens + size, raw + size)
            best.append(found)
        self.path = text
        return best[-1]


class Counter:
    """Counts of every pre-token met so far, in columns."""

    def __init__(self, pieces: Pieces):
        self.walk = PrefixWalk(pieces)
        self.place: dict[bytes, int] = {}
        self.table = np.zeros((0, 3), np.int64)

    def learn(self, words: set[bytes]) -> None:
        if len(self.place) > CACHE_WORDS:
            self.place.clear()
            self.table = self.table[:0]
        new = sorted((SPACE + word.decode("utf-8", "replace"), word) for word in words if word not in self.place)
        found = []
        for text, word in new:
            self.place[word] = len(self.table) + len(found)
            found.append(self.walk.to(text))
        self.table = np.concatenate([self.table, np.array(found, np.int64).reshape(-1, 3)])

    def count(self, texts: list[bytes]) -> list[tuple[int, ...]]:
        split = [text.split() for text in texts]
        self.learn(set().union(*split))
        rows = []
        for words in split:
            places = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            score, tokens, raw = self.table[places].sum(axis=0)
            rows.append((len(words), int(tokens), int(raw), int(score)))
        return rows


def count_in_batches(data):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = data.value  # lives as long as the worker, and with it the counts learnt
        if "counter" not in held:
            held["counter"] = Counter(Pieces.from_model(held["file"]))
        for batch in slices(batches, 512):
            rows = held["counter"].count(texts_of(batch["text"]))
            columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
            yield pa.RecordBatch.from_arrays([batch["id"], *columns], ["id", *COUNTS])

    return count


def count_tokens(
    df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Words, tokens, byte tokens and score of every text, one row per input row.

    Pre-tokens are the runs without ASCII white space, with a mark for the
    blank before them. The score is the sum over the best segmentation, in
    millionths of a nat. A missing or empty text has zeros. Repeated rows are
    counted each, other columns are ignored. One pass, no shuffle; the model
    file is read on the driver, and only if it is small.
    """
    data = df.sparkSession.sparkContext.broadcast({"file": small_file(model_path)})
    rows = text_frame(df, id_column, text_column)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{name} long" for name in COUNTS)
    return rows.mapInArrow(count_in_batches(data), schema).withColumnRenamed("id", id_column)
