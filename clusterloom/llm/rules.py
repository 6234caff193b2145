"""Quality rules whose cutoffs come with a guarantee.

Every rule rejects documents whose signal lies above a cutoff. Per stratum,
labelled holdout documents decide which cutoffs are allowed: a cutoff is
allowed if an exact binomial test shows, at a corrected level, that at most a
stated share of good documents lies above it. The level is divided among
rules and strata; along a rule's cutoffs, which are tested from lenient to
strict in a fixed order up to the first failure, it need not be.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.batches import row_key, slices, text_frame, texts_of, without_rows
from clusterloom.storage import snapshot, work_dir

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8

_WHITE = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_CONTINUATION = bytes(range(0x80, 0xC0))
_ALL = bytes(range(256))

#: Signals in the order of the batch columns; all whole numbers.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")

#: Rule name -> share whose excess rejects, as counted parts of a counted whole.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "marks": ("n_marks", "n_words"),
    "long_words": ("word_chars", "n_words"),
}

#: Cutoffs are tested in steps of a share; word lengths are scaled into shares of this many characters.
STEPS = 50
#: How much more a good document that is rejected counts than a bad one.
GOOD_WEIGHT = 10
LONG_WORD = 40


@dataclass(frozen=True)
class Risk:
    """At most ``rejected`` of the good documents of a stratum, all rules together, at confidence ``1 - level``."""

    rejected: float = 0.05
    level: float = 0.05


def among(data: bytes, members: bytes) -> int:
    """How many bytes are members of a class."""
    return len(data) - len(data.translate(None, members))


def repeated_words(ids: np.ndarray) -> int:
    """Words inside runs of ``WINDOW`` words that occur at least twice, the first one included."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    keys = np.zeros(n, np.uint64)
    for step in range(WINDOW):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + ids[step : step + n].astype(np.uint64)
        keys ^= keys >> np.uint64(29)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)
    pairs = np.nonzero(same)[0]
    if (windows[order[pairs]] != windows[order[pairs + 1]]).any():  # equal keys of unequal runs
        _, inverse, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        repeated = counts[inverse.ravel()] > 1
    else:
        repeated = np.zeros(n, bool)
        repeated[order[pairs]] = repeated[order[pairs + 1]] = True
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, np.nonzero(repeated)[0], 1)
    np.add.at(edges, np.nonzero(repeated)[0] + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def counts_of(data: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = data.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter([number.setdefault(word, len(number)) for word in words], np.int64, len(words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(data) - among(data, _WHITE + _CONTINUATION),
        among(data, _SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(lines),
        among(data, _CAPITALS),
        among(data, b"!?"),
    )


def counts_in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = [counts_of(data) for data in texts_of(batch["text"])]
        columns = [pa.array(column, pa.int64()) for column in zip(*rows)] if rows else [pa.array([], pa.int64())] * 8
        names = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], *columns], [*names, *COUNTS])


def text_counts(df: DataFrame, id_column: str, text_column: str, stratum: Column) -> DataFrame:
    """Columns id, stratum, row and the counts of the text; one pass, no shuffle."""
    key = row_key(id_column, text_column).alias("row")
    rows = text_frame(df, id_column, text_column, stratum.cast("string").alias("stratum"), key)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        counts_in_batches, f"id {kind}, stratum string, row long, " + ", ".join(f"{name} long" for name in COUNTS)
    )


def base_failed() -> Column:
    repeated = F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEATED_PERCENT) * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeated


def rule_steps() -> list[Column]:
    """Per rule the number of whole steps its share exceeds; 0 where the whole is 0."""
    steps = []
    for name, (part, whole) in RULES.items():
        scale = STEPS / LONG_WORD if name == "long_words" else STEPS
        share = F.col(part) * F.lit(scale) / F.greatest(F.col(whole), F.lit(1))
        steps.append(F.least(F.floor(share), F.lit(STEPS)).cast("int").alias(f"step_{name}"))
    return steps


def most_rejected(n: int, share: float, level: float) -> int:
    """The largest k with P(Binomial(n, share) <= k) <= level, or -1.

    With that many or fewer rejected among n, the exact test at this level
    refutes that more than ``share`` of the population would be rejected.
    """
    if n == 0 or n * math.log1p(-share) > math.log(level):
        return -1
    top = int(n * share)  # the median lies here or above, far over any level below a half
    i = np.arange(1, top + 1)
    logs = n * math.log1p(-share) + np.cumsum(np.log((n - i + 1) / i) + math.log(share / (1 - share)))
    heads = np.cumsum(np.exp(np.concatenate([[n * math.log1p(-share)], logs])))
    return int(np.searchsorted(heads, level, side="right")) - 1


def chosen_cutoffs(hist: pd.DataFrame, risk: Risk, n_strata: int) -> pd.DataFrame:
    """The cutoffs of one stratum from histograms (rule, step, good, n) of its holdout.

    Among allowed cutoffs the one that separates best: the largest difference
    between the shares of bad and good documents it rejects, good ones
    counting ``GOOD_WEIGHT`` times; of equals the most lenient. A rule without an allowed or useful cutoff rejects nothing.
    """
    out = []
    for name in RULES:
        rule = hist[hist["rule"] == name]
        above = np.zeros((2, STEPS + 2), np.int64)
        np.add.at(above, (rule["good"].to_numpy(int), rule["step"].to_numpy(int)), rule["n"].to_numpy(int))
        n_bad, n_good = (int(side.sum()) for side in above)
        above = above[:, ::-1].cumsum(axis=1)[:, ::-1]  # at this step or beyond it
        allowed = most_rejected(n_good, risk.rejected / len(RULES), risk.level / (len(RULES) * n_strata))
        best, gain = STEPS + 1, 0.0
        for step in range(STEPS, 0, -1):
            if above[1][step] > allowed:
                break
            found = above[0][step] / max(n_bad, 1) - GOOD_WEIGHT * above[1][step] / max(n_good, 1)
            if found > gain + 1e-12:
                best, gain = step, found
        bound = int(above[1][best]) if best <= STEPS else 0
        out.append((name, best, n_good, bound))
    return pd.DataFrame(out, columns=["rule", "cutoff", "n_good", "n_good_rejected"])


def cutoffs(counted: DataFrame, labels: DataFrame, risk: Risk) -> DataFrame:
    """Cutoffs per stratum and rule, from documents that have a label.

    ``labels`` holds id and quality (1 good, 0 bad). Only histograms are
    grouped, at most a row per rule, step and label in each stratum.
    """
    marked = labels.filter(F.col("quality").isNotNull()).groupBy("id").agg(F.min("quality").alias("quality"))
    holdout = counted.filter(~base_failed()).join(marked, "id")
    rules = F.explode(
        F.array(
            *[F.struct(F.lit(name).alias("rule"), step.alias("step")) for name, step in zip(RULES, rule_steps())]
        )
    )
    hist = (
        holdout.select("stratum", (F.col("quality") > 0).cast("int").alias("good"), rules.alias("r"))
        .groupBy("stratum", "good", F.col("r.rule").alias("rule"), F.col("r.step").alias("step"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n_strata = max(1, counted.agg(F.count_distinct(F.coalesce("stratum", F.lit("\0")))).first()[0])

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        found = chosen_cutoffs(group, risk, n_strata)
        found.insert(0, "stratum", group["stratum"].iloc[0])
        return found

    return hist.groupBy("stratum").applyInPandas(
        choose, "stratum string, rule string, cutoff int, n_good long, n_good_rejected long"
    )


def judge_documents(
    df: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    risk: Risk = Risk(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Counts and verdict for every document: id, ``COUNTS``, base_failed, failed_rules and kept.

    ``labels`` needs the id column and ``quality``. A missing text has no
    words and fails the base rules; a missing stratum is a stratum of its own.
    A document labelled twice counts as bad if any label says so. Without
    enough labels no cutoff can be guaranteed and only the base rules reject.
    Repeated rows are judged each; other columns are ignored. The counts are
    written once to the shared folder; texts are read once and never shuffled.
    """
    return judged_rows(df, labels, stratum, risk, id_column, text_column).drop("row").withColumnRenamed("id", id_column)


def judged_rows(
    df: DataFrame, labels: DataFrame, stratum: str, risk: Risk, id_column: str, text_column: str
) -> DataFrame:
    """What ``judge_documents`` gives, with the ``row_key`` of each row as column row."""
    counted = text_counts(df, id_column, text_column, F.col(stratum))
    counted = snapshot(counted, work_dir(df.sparkSession))
    marked = labels.select(F.col(id_column).alias("id"), F.col("quality").cast("int").alias("quality"))
    limits = (
        cutoffs(counted, marked, risk)
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    )
    judged = counted.select("*", *rule_steps()).alias("d").join(
        limits.alias("l"), F.col("d.stratum").eqNullSafe(F.col("l.stratum")), "left"
    )
    failed = F.filter(
        F.array(*[F.when(F.col(f"step_{name}") >= F.col("limits")[name], F.lit(name)) for name in RULES]),
        lambda name: name.isNotNull(),
    )
    return judged.select(
        "id",
        "row",
        *COUNTS,
        base_failed().alias("base_failed"),
        F.coalesce(failed, F.array().cast("array<string>")).alias("failed_rules"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def without_rejected(
    df: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    risk: Risk = Risk(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows that neither the base rules nor the cutoffs reject, each judged for itself, whatever its id."""
    judged = judged_rows(df, labels, stratum, risk, id_column, text_column)
    rejected = judged.filter(~F.col("kept")).select(F.col("row").alias("dropped_row")).distinct()
    return without_rows(df, id_column, text_column, snapshot(rejected, work_dir(df.sparkSession)))
