"""Quality classifier from weak labels.

Heuristic labellers vote on every document or abstain. Expectation
maximisation over the counts of their vote patterns estimates how reliable
each is, without needing the truth; what it believes about a pattern is the
label of the documents that show it. A linear scorer over hashed features is
trained on these labels, and scores documents by their words and word shapes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.batches import CACHE_WORDS, slices, text_frame, texts_of
from clusterloom.llm.rules import COUNTS, counts_of
from clusterloom.storage import snapshot, work_dir

#: Words that insult.
INSULTS = frozenset(
    b"loser idiot pathetic scum worthless moron trash clown disgusting stupid".split()
)

#: Buckets of the hashed features.
BUCKETS = 1 << 16

ROUNDS, EPOCHS, RATE, DECAY = 3, 4, 0.5, 1e-5

_PUNCTUATION = b""".,;:!?"'()[]{}"""
_TO_BLANK = bytes(32 if byte in _PUNCTUATION else byte for byte in range(256))
_SHAPE = bytes(
    97 if 97 <= byte < 123 or byte >= 128 else 65 if 65 <= byte < 91 else 48 if 48 <= byte < 58 else byte
    for byte in range(256)
)


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample: so many documents by the smallest hashes of their ids, and parts they train in."""

    max_documents: int = 20_000
    parts: int = 8
    annotated_of_ten: int = 5


def share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def vote(condition: Column, value: int) -> Column:
    """A vote where the condition holds, else no opinion."""
    return F.when(condition, value).otherwise(-1).cast("int")


def quality_votes() -> dict[str, Column]:
    """1 for a document worth keeping, 0 for junk, -1 for no opinion."""
    symbols, marks = share("n_symbols", "n_words"), share("n_marks", "n_words")
    capitals, repeats = share("n_capitals", "word_chars"), share("n_repeat_words", "n_words")
    length = share("word_chars", "n_words")
    prose = (symbols < 0.02) & (marks < 0.05) & (capitals < 0.08) & (repeats < 0.1) & length.between(4.2, 6.2)
    return {
        "symbols": vote(symbols > 0.1, 0),
        "marks": vote(marks > 0.2, 0),
        "capitals": vote(capitals > 0.2, 0),
        "repeats": vote(repeats > 0.3, 0),
        "word_length": vote(~length.between(3.8, 7.0), 0),
        "lines": vote(share("n_dup_lines", "n_lines") > 0.5, 0),
        "prose": vote(prose, 1),
        "annotator": F.coalesce("annotated_quality", F.lit(-1)).cast("int"),
    }


def toxic_votes() -> dict[str, Column]:
    """1 for a document that insults, 0 for one that does not, -1 for no opinion."""
    insults = F.col("n_insults")
    return {
        "any_insult": vote(insults >= 1, 1),
        "more_insults": vote(insults >= 3, 1),
        "no_insult": vote(insults == 0, 0),
        "annotator": F.coalesce("annotated_toxic", F.lit(-1)).cast("int"),
    }


CONCEPTS = {"quality": quality_votes, "toxic": toxic_votes}


def facts_in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for data in texts_of(batch["text"]):
            words = data.lower().translate(_TO_BLANK).split()
            rows.append((*counts_of(data), sum(map(INSULTS.__contains__, words))))
        columns = [pa.array(column, pa.int64()) for column in zip(*rows)]
        yield pa.RecordBatch.from_arrays([batch["id"], *columns], ["id", *COUNTS, "n_insults"])


def believed(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50, prior: float = 0.8) -> np.ndarray:
    """P(concept holds | votes) for every pattern of votes, by expectation maximisation.

    ``patterns`` has a row per pattern and a column per labeller with 1, 0 or
    -1. Labellers are taken as independent given the truth; that one abstains
    tells something as well, since many only ever vote one way. Counts are
    smoothed. Patterns start from their votes, those without any from a half.
    """
    n, voters = patterns.shape
    shown = np.stack([patterns == value for value in (0, 1, -1)]).astype(float)
    yes, no = (patterns == 1).sum(axis=1), (patterns == 0).sum(axis=1)
    odds = (yes - no) * np.log(prior / (1 - prior))
    belief = 1 / (1 + np.exp(-odds))
    total = counts.sum()
    for _ in range(rounds):
        logs = []
        for holds, weight in ((1, belief * counts), (0, (1 - belief) * counts)):
            seen = np.einsum("vpl,p->vl", shown, weight)
            seen += 0.1
            logs.append(
                np.log((weight.sum() + 1) / (total + 2)) + np.einsum("vpl,vl->p", shown, np.log(seen / seen.sum(axis=0)))
            )
        belief = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -500, 500)))
    return belief


class Buckets(dict):
    """Bucket of every text asked for, under the name of a kind of feature."""

    def __init__(self, kind: bytes, shaped=lambda text: text):
        super().__init__()
        self.kind, self.shaped = kind, shaped

    def __missing__(self, text: bytes) -> int:
        if len(self) > CACHE_WORDS // 2:
            self.clear()
        found = self[text] = xxhash.xxh3_64_intdigest(self.kind + self.shaped(text)) & (BUCKETS - 1)
        return found


def collapsed(shape: bytes) -> bytes:
    """A shape with runs of letters and digits of one kind cut down to one."""
    while b"aa" in shape or b"AA" in shape or b"00" in shape:
        shape = shape.replace(b"aa", b"a").replace(b"AA", b"A").replace(b"00", b"0")
    return shape


class Features(dict):
    """Buckets of every word asked for: the word, its first five bytes and its shape."""

    def __init__(self):
        super().__init__()
        self.prefixes, self.shapes = Buckets(b"p"), Buckets(b"s", collapsed)

    def __missing__(self, word: bytes) -> tuple[int, int, int]:
        low = word.lower().translate(_TO_BLANK).strip()
        whole = xxhash.xxh3_64_intdigest(low) & (BUCKETS - 1)
        found = self[word] = (whole, self.prefixes[low[:5]], self.shapes[word.translate(_SHAPE)])
        return found

    def of(self, data: bytes) -> np.ndarray:
        """Distinct buckets of a text."""
        if len(self) > CACHE_WORDS:
            self.clear()
        words = set(data.split())
        return np.unique(np.fromiter(itertools.chain.from_iterable(map(self.__getitem__, words)), np.int32))


def score(weights: np.ndarray, buckets: np.ndarray) -> float:
    """Probability by the linear scorer; the last weight is the bias."""
    total = weights[buckets].sum() / np.sqrt(max(1, len(buckets))) + weights[-1]
    return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def trained(weights: np.ndarray, rows: list[tuple[np.ndarray, float]]) -> np.ndarray:
    """Weights after some epochs of adaptive gradient steps over documents with soft labels."""
    weights, gathered = weights.copy(), np.full(len(weights), 1e-2)
    for _ in range(EPOCHS):
        for buckets, label in rows:
            scale = 1 / np.sqrt(max(1, len(buckets)))
            error = score(weights, buckets) - label
            step = error * scale + DECAY * weights[buckets]
            gathered[buckets] += step * step
            weights[buckets] -= RATE * step / np.sqrt(gathered[buckets])
            gathered[-1] += error * error
            weights[-1] -= RATE * error / np.sqrt(gathered[-1])
    return weights


def training_in_batches(held):
    """One set of weights per part of the sample and concept."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        rows = {concept: [] for concept in held.value}
        for batch in slices(batches):
            found = [features.of(data) for data in texts_of(batch["text"])]
            for concept, column in rows.items():
                column += zip(found, batch[f"p_{concept}"].to_pylist())
        if any(rows.values()):
            weights = [trained(held.value[c], rows[c]).tobytes() for c in rows]
            size = len(next(iter(rows.values())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows)), pa.array(weights, pa.binary()), pa.array([size] * len(rows), pa.int64())],
                ["concept", "weights", "n"],
            )

    return train


def scores_in_batches(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches):
            found = [features.of(data) for data in texts_of(batch["text"])]
            columns = [pa.array([score(weights, f) for f in found], pa.float64()) for weights in held.value.values()]
            yield pa.RecordBatch.from_arrays([batch["id"], *columns], ["id", *[f"s_{c}" for c in held.value]])

    return run


def weak_labels(df: DataFrame, labels: DataFrame, id_column: str, text_column: str, training: Training) -> DataFrame:
    """Columns id, and p_<concept> for every concept; texts are read once."""
    spark = df.sparkSession
    rows = text_frame(df, id_column, text_column)
    kind = rows.schema["id"].dataType.simpleString()
    fields = ", ".join(f"{name} long" for name in (*COUNTS, "n_insults"))
    facts = rows.mapInArrow(facts_in_batches, f"id {kind}, {fields}")
    # The other annotated documents stay unseen, to measure the classifier with.
    annotated = (
        labels.filter(~held_out(F.col(id_column), training))
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.min("quality").alias("annotated_quality"), F.max("toxic").alias("annotated_toxic"))
    )
    marked = facts.join(annotated.withColumnRenamed("id", "annotated_id"), F.col("id") == F.col("annotated_id"), "left")
    votes = [F.concat_ws(",", *of().values()).alias(f"v_{concept}") for concept, of in CONCEPTS.items()]
    voted = snapshot(marked.select("id", *votes), work_dir(spark))
    for concept in CONCEPTS:
        # At most three to the number of labellers rows, whatever the input.
        found = voted.groupBy(f"v_{concept}").agg(F.count(F.lit(1)).alias("n")).toPandas()
        patterns = [list(map(int, text.split(","))) for text in found[f"v_{concept}"]]
        belief = believed(np.array(patterns), found["n"].to_numpy(float)) if patterns else []
        table = pd.DataFrame({f"v_{concept}": found[f"v_{concept}"].astype(str), f"p_{concept}": np.asarray(belief, float)})
        beliefs = spark.createDataFrame(table, f"v_{concept} string, p_{concept} double")
        voted = voted.join(F.broadcast(beliefs), f"v_{concept}")
    return voted


def held_out(id_column: Column, training: Training) -> Column:
    """Is an annotated document kept from the labellers?"""
    return F.pmod(F.xxhash64(id_column, F.lit("annotated")), F.lit(10)) >= training.annotated_of_ten


def fit_scorer(rows: DataFrame, training: Training) -> dict[str, np.ndarray]:
    """Weights of every concept, from columns text and p_<concept>; parts train apart and are averaged."""
    spark = rows.sparkSession
    weights = {concept: np.zeros(BUCKETS + 1) for concept in CONCEPTS}
    for _ in range(ROUNDS):
        held = spark.sparkContext.broadcast(weights)
        found = rows.mapInArrow(training_in_batches(held), "concept string, weights binary, n long").toPandas()
        for concept in weights:
            own = found[found["concept"] == concept].sort_values(["n", "weights"])
            if len(own):
                parts = np.stack([np.frombuffer(data) for data in own["weights"]])
                weights[concept] = np.average(parts, axis=0, weights=own["n"].to_numpy(float))
    return weights


def classify(
    df: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    training: Training = Training(),
) -> DataFrame:
    """Believed and scored quality and toxicity of every document, and whether to keep it.

    ``labels`` (id, quality, toxic) is one labeller among others, for the
    documents of it that are not held out. Kept are documents that score as
    good and not as toxic. A missing or empty text scores by the bias alone.
    Rows that share an id share what is believed of them, their mean, and are
    scored each; other columns are ignored.
    The scorer is fitted on a bounded sample, ``Training.max_documents``
    documents by the hash of their id; everything else covers all rows.
    """
    spark = df.sparkSession
    labelled = weak_labels(df, labels, id_column, text_column, training)
    means = [F.avg(f"p_{concept}").alias(f"p_{concept}") for concept in CONCEPTS]
    labelled = snapshot(labelled.groupBy("id").agg(*means), work_dir(spark))
    texts = text_frame(df, id_column, text_column)
    chosen = (
        labelled.withColumn("place", F.xxhash64("id")).orderBy("place").limit(training.max_documents).drop("place")
    )
    chosen = snapshot(chosen, work_dir(spark))
    chosen = chosen.withColumnRenamed("id", "chosen_id")
    sample = texts.join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("chosen_id"))).repartition(training.parts, "id").sortWithinPartitions("id")
    sample = snapshot(sample.select("id", "text", *[f"p_{concept}" for concept in CONCEPTS]), work_dir(spark))
    held = spark.sparkContext.broadcast(fit_scorer(sample, training))
    kind = texts.schema["id"].dataType.simpleString()
    scored = texts.mapInArrow(
        scores_in_batches(held), f"id {kind}, " + ", ".join(f"s_{concept} double" for concept in CONCEPTS)
    )
    labelled = labelled.withColumnRenamed("id", "labelled_id")
    return scored.join(labelled, F.col("id").eqNullSafe(F.col("labelled_id"))).select(
        F.col("id").alias(id_column),
        *[F.col(f"p_{concept}").alias(f"{concept}_believed") for concept in CONCEPTS],
        *[F.col(f"s_{concept}").alias(f"{concept}_score") for concept in CONCEPTS],
        ((F.col("s_quality") >= 0.5) & (F.col("s_toxic") < 0.5)).alias("kept"),
    )
