"""Small helpers for work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that are turned into Python values at a time.
SLICE_ROWS = 128

#: Distinct words a task remembers before it starts anew.
CACHE_WORDS = 150_000

_WHITE = b" \t\n\v\f\r"

#: Files that are shipped to executors whole are refused beyond this size.
MAX_FILE_BYTES = 64 << 20


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a missing one is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


#: Rows that Spark hands to Python at a time. Texts are long: its own 10 000 would be too many.
BATCH_ROWS = 512
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch to ``BATCH_ROWS``; a lower setting stays."""
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def text_frame(df: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    """Only the columns an operator needs, under names that cannot clash. Its batches are bounded."""
    bound_batches(df.sparkSession)
    return df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), *more)


def small_file(path: str) -> bytes:
    """A vocabulary file, read on the driver; its size is checked, since it is broadcast."""
    if Path(path).stat().st_size > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    return Path(path).read_bytes()


class WordHashes(dict):
    """64-bit hash of every word asked for."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; of all words where there are fewer."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = words[:n]
    for step in range(1, size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[step : step + n]
    return mixed(total + np.uint64(size))


#: Slots of the filter that tells which keys are asked for; its size does not depend on the input.
FILTER_SLOTS = 1 << 24


def slot_of(column: str | Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_SLOTS)).cast("int")


def slot_filter(keys: DataFrame, column: str):
    """A broadcast bit per slot: does any key fall there? Lets through every key and a few others."""
    slots = keys.select(slot_of(column).alias("slot"))
    marked = slots.select(
        F.floor(F.col("slot") / 8).cast("int").alias("place"), F.expr("shiftright(128, slot % 8)").alias("mask")
    )
    bits = np.zeros(FILTER_SLOTS // 8, np.uint8)
    found = marked.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()  # a row per byte at most
    bits[found["place"].to_numpy()] = found["mask"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(bits.tobytes())


def marked_slots(slots: pa.Array, bits: bytes) -> pa.Array:
    """Which of the slots are marked in a filter."""
    places = slots.to_numpy()
    found = np.frombuffer(bits, np.uint8)[places >> 3]
    return pa.array((found >> (7 - (places & 7)) & 1).astype(bool))


def let_through(slot: Column, held) -> Column:
    """Is a slot marked in a filter?"""

    def look(slots: pa.Array) -> pa.Array:
        return marked_slots(slots, held.value)

    return F.arrow_udf(look, "boolean")(slot)


def row_key(id_column: str, text_column: str) -> Column:
    """Tells rows apart: 64 bits of id and text. Equal rows share it, and are judged alike."""
    return F.xxhash64(F.col(id_column), F.col(text_column).cast("string"))


def without_rows(df: DataFrame, id_column: str, text_column: str, dropped: DataFrame) -> DataFrame:
    """The rows whose ``row_key`` is not in the column ``dropped_row``; others with their id, or without one, stay.

    Most rows are passed by the filter alone; only those it marks are joined.
    """
    key = row_key(id_column, text_column)
    marked = let_through(slot_of(key), slot_filter(dropped, "dropped_row"))
    own = "dropped_row" + "_" * max(map(len, df.columns))  # a name that no column has
    checked = df.filter(marked).join(dropped.withColumnRenamed("dropped_row", own), key == F.col(own), "left_anti")
    return df.filter(~marked).unionByName(checked)
