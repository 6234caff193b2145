"""Phrases whose words stand together more often than chance would have it.

One structure answers everything: the stripe of a prefix, a counter of the
words that follow it. Stripes of equal prefixes are merged entry by entry.
An entry is the count of an extension, the sum of a stripe that of its
prefix, and its largest entry tells whether a longer phrase is just as
frequent. A phrase cannot be more frequent than a part of it, so each pass
over the texts asks only for prefixes whose parts the pass before has found
often enough: first words, then words that follow a word, then words that
follow two, then those that follow three or four.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clusterloom.llm.batches import bound_batches, mixed, slices, texts_of
from clusterloom.storage import drop_snapshot, snapshot, work_dir

#: Words of a language that a task counts together before it sends their stripes.
CHUNK_WORDS = 4_000_000

#: Bytes of text that are taken apart at a time.
TEXT_BYTES = 2 << 20

#: A filter has at least so many bits for a phrase, until it is as large as it may get.
BITS_FOR_EACH = 512
LEAST_BITS, MOST_BITS = 16, 28

#: So many of the most frequent prefixes have their stripes cut into parts by the next word.
HOT_PREFIXES = 256
PARTS_OF_HOT = 64

LONGEST = 5

#: Words of the phrases that a pass knows to be frequent, and lengths of the prefixes whose stripes it counts.
PASSES = ((1, (1,)), (2, (2,)), (3, (3, 4)))

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_ENDS = b".,;:!?\n\v\f\r"
_FOLD = bytes.maketrans(_UPPER + b"\t" + _ENDS, _UPPER.lower() + b" " + b"\n" * len(_ENDS))
_BETWEEN = re.compile(b"[ \t" + re.escape(_ENDS) + b"]")

STRIPES = "lang string, prefix array<long>, part int, nexts array<long>, counts array<long>"


class Powers:
    """Powers of a base and of its inverse modulo 2^64, as many as have been asked for."""

    def __init__(self, salt: int):
        self.base = np.uint64((0x9E3779B97F4A7C15 * (2 * salt + 1) + 2 * salt) % (1 << 64) | 1)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size, self.base)])
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size, inverse)])

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash, never 0, of the bytes from each start to its end, wherever they stand."""
        self.reach(len(data) + 1)
        sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)])
        sums = np.r_[np.uint64(0), sums]
        found = mixed((sums[ends] - sums[starts]) * self.down[starts])
        return np.where(found == 0, np.uint64(1), found)


def parts_of(text: bytes) -> Iterator[bytes]:
    """A long text in parts, cut where no word is."""
    start = 0
    while start < len(text):
        end = start + TEXT_BYTES
        if end < len(text):
            found = _BETWEEN.search(text, end)
            end = found.start() if found else len(text)
        yield text[start:end] if start or end < len(text) else text
        start = end


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The folded text, where its words start and end, and which have an end of a piece before them.

    The last entry of these tells the same of what comes after the text.
    """
    data = np.frombuffer(text.translate(_FOLD), np.uint8)
    inside = np.r_[False, (data != 32) & (data != 10), False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    lines = np.r_[0, np.cumsum(data == 10)]
    return data, starts, ends, np.diff(np.r_[0, lines[starts], lines[-1]]) > 0


def keys_of(lang: str, *words: np.ndarray) -> np.ndarray:
    """A hash for every phrase of a language, from the hashes of its words."""
    key = np.array([xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))], np.uint64)
    for word in words:
        key = mixed(word + key * np.uint64(0x9E3779B97F4A7C15))
    return key


@dataclass(frozen=True)
class Filter:
    """Tells which phrases may be frequent; says yes to all that are, and to some others."""

    bits: int
    places: np.ndarray

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        slots = self.slots(keys)
        return (self.places[slots >> 6] >> (slots & 63).astype(np.uint64)) & np.uint64(1) == 1


@dataclass(frozen=True)
class Wanted:
    """What a pass counts: stripes of prefixes of the given lengths, whose parts of ``known`` words are in the filter."""

    salt: int
    known: int
    lengths: tuple[int, ...]
    frequent: Filter
    hot: np.ndarray


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Texts of one language joined, with a line end after each, a few megabytes at a time."""
    waiting: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in slices(batches):
        for lang, text in zip(batch["lang"].to_pylist(), texts_of(batch["text"])):
            waiting.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text) + 1
            if size[lang] >= TEXT_BYTES:
                size[lang] = 0
                for part in parts_of(b"\n".join([*waiting.pop(lang), b""])):
                    yield lang, part
    for lang, texts in waiting.items():
        for part in parts_of(b"\n".join([*texts, b""])):
            yield lang, part


def in_chunks(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[tuple[str, np.ndarray, int]]:
    """Hashes of the words of a language in order, 0 between pieces, and at how many places phrases may start.

    The last words of a chunk, whose phrases may go on, come again in the next one.
    """
    powers = Powers(salt)
    chunks: dict[str, list[np.ndarray]] = {}
    size: dict[str, int] = {}
    for lang, part in in_parts(batches):
        data, starts, ends, begins = word_places(part)
        words = np.zeros(len(starts) + int(begins.sum()), np.uint64)
        words[np.arange(len(starts)) + np.cumsum(begins[:-1])] = powers.hashes(data, starts, ends)
        chunks.setdefault(lang, []).append(words)
        size[lang] = size.get(lang, 0) + len(words)
        if size[lang] >= CHUNK_WORDS:
            joined = np.concatenate(chunks[lang])
            own = max(0, len(joined) - (LONGEST - 1))
            yield lang, joined, own
            chunks[lang] = [joined[own:]]
            size[lang] = len(joined) - own
    for lang, parts in chunks.items():
        joined = np.concatenate(parts)
        yield lang, joined, len(joined)


@dataclass
class Counted:
    """Words of a language with two hashes and a count; equal words can be there several times."""

    hashes: list[np.ndarray]
    others: list[np.ndarray]
    counts: list[np.ndarray]
    words: list[bytes]

    def add(self, hashes: np.ndarray, others: np.ndarray, counts: np.ndarray, words: list[bytes]) -> None:
        self.hashes.append(hashes)
        self.others.append(others)
        self.counts.append(counts)
        self.words += words

    def batch(self, lang: str) -> pa.RecordBatch:
        """A row for every hash, and one without a count for a word that is not the first of its hash."""
        hashes, others, counts = (np.concatenate(parts) for parts in (self.hashes, self.others, self.counts))
        first, sums, clash = by_hash(hashes, others, counts)
        at = np.r_[first, clash]
        columns = [
            pa.array([lang], pa.string()).take(pa.array(np.zeros(len(at), np.int32))),
            pa.array(hashes[at].view(np.int64)),
            pa.array([self.words[i] for i in at.tolist()], pa.binary()),
            pa.array(np.r_[sums, np.zeros(len(clash), np.int64)]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "hash", "word", "n"])


def by_hash(hashes: np.ndarray, others: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each hash comes first, the sum of its counts, and the places where the other hash tells that words differ."""
    codes, found = pd.factorize(hashes)
    first = np.zeros(len(found), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, codes, counts)
    return first, sums, np.flatnonzero(others != others[first[codes]])


def words_in_batches(salt: int):
    """Counts of words: the stripe of the empty prefix."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, check = Powers(salt), Powers(salt + 1_000_003)
        waiting: dict[str, Counted] = {}
        for lang, part in in_parts(batches):
            data, starts, ends, _ = word_places(part)
            hashes, others = powers.hashes(data, starts, ends), check.hashes(data, starts, ends)
            first, sums, clash = by_hash(hashes, others, np.ones(len(hashes), np.int64))
            at, text = np.r_[first, clash], data.tobytes()
            words = [text[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
            own = waiting.setdefault(lang, Counted([], [], [], []))
            own.add(hashes[at], others[at], np.r_[sums, np.zeros(len(clash), np.int64)], words)
            if len(own.words) >= CHUNK_WORDS // 8:
                yield waiting.pop(lang).batch(lang)
        for lang, own in waiting.items():
            yield own.batch(lang)

    return count


def renumbered(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """Equal numbers for equal pairs, from 0."""
    return np.unique(first.astype(np.int64) * size + second, return_inverse=True)[1]


def stripes_in_batches(held: Broadcast):
    """Stripes of the texts of a task, one for a prefix and chunk, or part of it where the prefix is hot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: Wanted = held.value
        for lang, words, starts in in_chunks(batches, wanted.salt):
            numbers, hashes = pd.factorize(np.r_[np.uint64(0), words])  # the end of a piece is 0
            for length in wanted.lengths:
                yield from stripes_of(lang, numbers[1:], starts, hashes, length, wanted)

    return count


def stripes_of(
    lang: str, numbers: np.ndarray, starts: int, hashes: np.ndarray, length: int, wanted: Wanted
) -> Iterator[pa.RecordBatch]:
    size = len(hashes)
    padded = np.concatenate([numbers, np.zeros(LONGEST, numbers.dtype)])
    # At which places does a known phrase begin that may be frequent?
    places = len(padded) - wanted.known + 1
    known = np.ones(places, bool)
    for step in range(wanted.known):
        known &= padded[step : step + places] > 0
    at = np.flatnonzero(known)
    known[at] = wanted.frequent.holds(keys_of(lang, *[hashes[padded[at + step]] for step in range(wanted.known)]))
    steps = length - wanted.known + 1
    ok = known[:starts].copy()
    for step in range(1, steps):
        ok &= known[step : step + starts]
    at = np.flatnonzero(ok)
    if not len(at):
        return
    prefix = padded[at].astype(np.int64)
    for step in range(1, length):
        prefix = renumbered(prefix, padded[at + step], size)
    # A next word that cannot make a frequent phrase counts for the prefix alone.
    following = np.where(known[at + steps], padded[at + length], 0)
    codes, first, counts = np.unique(prefix * size + following, return_index=True, return_counts=True)
    following, at = following[first], at[first]
    words = [hashes[padded[at + step]] for step in range(length)]
    key = keys_of(lang, *words[: wanted.known])
    hot = np.isin(key, wanted.hot) & (following > 0)
    part = np.where(hot, (hashes[following] >> np.uint64(32)) % np.uint64(PARTS_OF_HOT), 0).astype(np.int32)
    prefix = codes // size
    order = np.lexsort((part, prefix)) if hot.any() else np.arange(len(codes))
    prefix, part, counts, following = prefix[order], part[order], counts[order], following[order]
    begins = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])])
    offsets = pa.array(np.r_[begins, len(prefix)].astype(np.int32))
    nexts = pa.array(hashes[following].view(np.int64), mask=following == 0)
    own = np.stack([word[order][begins] for word in words], axis=1).view(np.int64)
    columns = [
        pa.array([lang], pa.string()).take(pa.array(np.zeros(len(begins), np.int32))),
        pa.ListArray.from_arrays(pa.array(np.arange(0, own.size + 1, length, dtype=np.int32)), pa.array(own.ravel())),
        pa.array(part[begins]),
        pa.ListArray.from_arrays(offsets, nexts),
        pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64))),
    ]
    yield pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "part", "nexts", "counts"])


def merged(stripes: DataFrame, least: int) -> DataFrame:
    """Stripes of equal prefixes (and parts) as one: its sum, and the extensions that are frequent."""
    own = ["lang", "prefix", "part"]
    entries = stripes.repartition(*own).select(*own, F.inline(F.arrays_zip("nexts", "counts")).alias("next", "n"))
    summed = entries.groupBy(*own, "next").agg(F.sum("n").alias("n"))
    frequent = F.when((F.col("n") >= least) & F.col("next").isNotNull(), F.struct("next", "n"))
    return summed.groupBy(*own).agg(F.sum("n").alias("total"), F.collect_list(frequent).alias("extensions"))


def slots_in_batches(bits: int):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Filter(bits, np.zeros(0, np.uint64))
        for batch in batches:
            words = batch["words"].flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1)
            langs = np.array(batch["lang"].to_pylist(), object)
            slots = np.zeros(batch.num_rows, np.int64)
            for lang in set(langs):
                at = np.flatnonzero(langs == lang)
                slots[at] = held.slots(keys_of(lang, *words[at].T))
            masks = (np.uint64(1) << (slots & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slots >> 6), pa.array(masks)], ["place", "mask"])

    return mark


def filter_of(phrases: DataFrame) -> Filter:
    """A filter of phrases (lang, words), all of one length; 32 MB at most, whatever their number."""
    bits = min(MOST_BITS, max(LEAST_BITS, (phrases.count() * BITS_FOR_EACH).bit_length()))
    marks = phrases.select("lang", "words").mapInArrow(slots_in_batches(bits), "place long, mask long")
    found = marks.groupBy("place").agg(F.bit_or("mask").alias("mask")).toArrow()
    places = np.zeros(1 << (bits - 6), np.uint64)
    places[found["place"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return Filter(bits, places)


def hottest(phrases: DataFrame) -> np.ndarray:
    """Keys of the most frequent phrases (lang, words, a)."""
    rows = phrases.orderBy(F.desc("a"), "lang", "words").limit(HOT_PREFIXES).collect()
    keys = [keys_of(r["lang"], *[np.array([w], np.int64).view(np.uint64) for w in r["words"]])[0] for r in rows]
    return np.array(keys, np.uint64)


def counted_words(texts: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """Every word of every language with its count, and a salt under which no two words share a hash."""
    salt = 0
    while True:
        schema = "lang string, hash long, word binary, n long"
        found = texts.mapInArrow(words_in_batches(salt), schema).repartition("lang", "hash")
        words = found.groupBy("lang", "hash", "word").agg(F.sum("n").alias("n"))
        words = snapshot(
            words.withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("lang", "hash"))), f"{folder}/words-{salt}"
        )
        if words.filter("same > 1").isEmpty():
            return words, salt
        drop_snapshot(texts.sparkSession, f"{folder}/words-{salt}")
        salt += 1


def _exact(*factors: Column) -> Column:
    product = factors[0].cast("decimal(38,0)")
    for factor in factors[1:]:
        product = product * factor.cast("decimal(38,0)")
    return product


def judged(stripes: DataFrame, words: DataFrame, keep: int) -> DataFrame:
    """The best phrases of every language, from merged stripes and the counts of words."""
    totals = stripes.groupBy("lang", "prefix").agg(F.sum("total").alias("total"))
    found = stripes.select("lang", "prefix", F.inline("extensions").alias("next", "a"))
    found = found.select("lang", F.concat("prefix", F.array("next")).alias("words"), "a")

    # One word more on either side tells: what lies between a phrase and a longer one is as frequent as both.
    longest = F.array_max(F.transform("extensions", lambda e: e["n"]))
    right = stripes.filter(F.size("prefix") > 1).select("lang", F.col("prefix").alias("words"), longest.alias("most"))
    left = found.filter(F.size("words") > 2).select(
        "lang", F.expr("slice(words, 2, size(words) - 1)").alias("words"), F.col("a").alias("most")
    )
    maxima = right.unionByName(left).groupBy("lang", "words").agg(F.max("most").alias("most"))
    own = found.join(maxima, ["lang", "words"], "left").filter("most is null or most < a").select("lang", "words", "a")

    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "*", F.expr("slice(words, 1, k)").alias("first"), F.expr("slice(words, k + 1, size(words) - k)").alias("rest")
    )
    l_totals = totals.select("lang", F.col("prefix").alias("first"), F.col("total").alias("l"))
    r_totals = totals.select("lang", F.col("prefix").alias("rest"), F.col("total").alias("r"))
    all_words = words.groupBy("lang").agg(F.sum("n").alias("n"))
    cuts = cuts.join(l_totals, ["lang", "first"]).join(r_totals, ["lang", "rest"]).join(all_words, "lang")
    cuts = cuts.withColumn("dividend", _exact(F.lit(1000), F.col("a"), F.col("n"))).withColumn(
        "score", F.expr("dividend div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))")
    )
    lowest = cuts.groupBy("lang", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "words", "a", "cut.l", "cut.r", "n", "cut.score")

    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    scored = scored.withColumn("place", F.rank().over(best)).filter(F.col("place") <= keep).drop("place")
    spelled = scored.select("lang", "words", F.posexplode("words").alias("at", "hash"))
    spelled = spelled.join(words.select("lang", "hash", F.col("word").cast("string").alias("word")), ["lang", "hash"])
    texts = F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda p: p["word"])
    spelled = spelled.groupBy("lang", "words").agg(F.array_join(texts, " ").alias("phrase"))
    scored = scored.join(spelled, ["lang", "words"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(
    df: DataFrame,
    least: int = 100,
    keep: int = 2000,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """Columns lang, rank, phrase, a, l, r, n, score: the first ``keep`` phrases of every language.

    Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces,
    those at blanks and tabs into words. Phrases are two to five words of a
    piece that occur at least ``least`` times (a) in their language, a missing
    one being ``und``. Cut after k words into parts that occur l and r times, a phrase
    scores floor(1000 a n / (l r)), n being the words of the language; the
    worst cut counts, of equal ones the first. Phrases inside a longer one of
    the same count are dropped. They rank by score, count and text. Missing
    and empty texts and texts without words add nothing, repeated rows count
    each, other columns are ignored; an empty table gives no rows. Products
    are exact up to 38 digits; more of them ends the job.

    Texts are read four times, counts go through one shuffle each. Words are
    known by 64-bit hashes, which are checked to differ.
    """
    spark = df.sparkSession
    bound_batches(spark)
    texts = df.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"),
        F.col(text_column).cast("string").alias("text"),
    )
    folder = work_dir(spark)
    words, salt = counted_words(texts, folder)
    phrases = words.filter(F.col("n") >= least).select("lang", F.array("hash").alias("words"), F.col("n").alias("a"))
    parts = []
    for known, lengths in PASSES:
        held = spark.sparkContext.broadcast(Wanted(salt, known, lengths, filter_of(phrases), hottest(phrases)))
        found = texts.mapInArrow(stripes_in_batches(held), STRIPES)
        parts.append(snapshot(merged(found, least), f"{folder}/stripes-{known}"))
        phrases = parts[-1].select("lang", "prefix", F.inline("extensions").alias("next", "a"))
        phrases = phrases.select("lang", F.concat("prefix", F.array("next")).alias("words"), "a")
    return judged(reduce(DataFrame.unionByName, parts), words, keep)
