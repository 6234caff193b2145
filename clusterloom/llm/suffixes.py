"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Every string of ``length`` bytes has an anchor: its first gram of smallest
hash. Equal strings have equal anchors, so only suffixes at anchors need
sorting, and of these only those whose gram is the anchor of some other
string, too. Tasks sort such suffixes and front-code them into runs; runs are
exchanged by gram, and loser trees merge them that compare strings only from
the prefix on which they are known to agree. Suffixes that share their gram
come out next to each other; which of their strings occur twice is then told
from the bytes around the anchors. Where a gram is an anchor very often, such a group
would be too large for a task; its strings are told apart by their hashes, over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterloom.llm.batches import let_through, mixed, slices, slot_filter, slot_of, text_frame, texts_of
from clusterloom.storage import snapshot, work_dir

GRAM = 64

#: Strings of a text are looked at in stretches of so many starts.
STRETCH = 1 << 16

#: Suffixes per bucket that runs are exchanged in, and per sorted run.
BUCKET_SUFFIXES = 100_000
RUN_BYTES = 24 << 20

#: A gram that is an anchor more often than this is hot: its strings are dealt out one by one, by their hash.
HOT_ANCHORS = 2_000

#: Strings per bucket of hot grams, and contexts whose strings are held at a time.
BUCKET_STRINGS = 1_000_000
HELD_CONTEXTS = 2_000

#: Places that are known to repeat go on in rows of so many.
KNOWN_PLACES = 10_000

#: Bytes around anchors that are compared at a time.
COMPARED_BYTES = 1 << 20

_BYTE_HASHES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@dataclass(frozen=True)
class Repeats:
    """Strings of ``length`` bytes that occur twice; at most 255 bytes more than a gram."""

    length: int = 200

    @property
    def grams(self) -> int:
        return self.length - GRAM + 1


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` bytes, by doubling."""
    n = len(data) - length + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    power, size = _BYTE_HASHES[data], 1
    total, covered = None, 0
    while True:
        if length & size:
            part = power[covered : covered + n]
            total = part.copy() if total is None else mixed(total * np.uint64(0xC2B2AE3D27D4EB4F) + part)
            covered += size
        if 2 * size > length:
            return total
        power = mixed(power[:-size] * np.uint64(0x9FB21C651E98DF25) + power[size:])
        size *= 2


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of every run of ``width`` keys, by doubling."""
    size, least = 1, keys
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def anchors(data: np.ndarray, rule: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hashes and places of anchors, with the first and last start of the strings they are anchors of."""
    found = []
    for begin in range(0, len(data) - rule.length + 1, STRETCH):
        part = data[begin : begin + STRETCH + rule.length - 1]
        hashes = string_hashes(part, GRAM)
        # The place in the low bits makes the first of equal grams the smallest.
        keys = hashes & ~np.uint64((1 << 20) - 1) | np.arange(len(hashes), dtype=np.uint64)
        least = window_minima(keys, rule.grams)
        first = np.concatenate([[0], np.nonzero(least[1:] != least[:-1])[0] + 1])
        last = np.concatenate([first[1:] - 1, [len(least) - 1]])
        place = (least[first] & np.uint64((1 << 20) - 1)).astype(np.int64)
        found.append((hashes[place], place + begin, first + begin, last + begin))
    if not found:
        return tuple(np.zeros(0, kind) for kind in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(column) for column in zip(*found))


def packed(place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place, its distance from the first start, and the number of further starts, in one integer."""
    return place << 16 | (place - first) << 8 | (last - first)


def unpacked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place = codes >> 16
    first = place - (codes >> 8 & 255)
    return place, first, first + (codes & 255)


def anchors_in_batches(rule: Repeats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            grams, rows, codes = [], [], []
            for row, data in zip(batch["row"].to_pylist(), texts_of(batch["text"])):
                if len(data) >= rule.length:
                    gram, place, first, last = anchors(np.frombuffer(data, np.uint8), rule)
                    grams.append(gram.view(np.int64))
                    rows.append(np.full(len(gram), row, np.int64))
                    codes.append(packed(place, first, last))
            if grams:
                columns = [pa.array(np.concatenate(column)) for column in (grams, rows, codes)]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "row", "code"])

    return run


def shared_lengths(texts: list[bytes]) -> np.ndarray:
    """How many first bytes each text shares with the one before."""
    lengths = np.array([len(text) for text in texts])
    matrix = np.zeros((len(texts), lengths.max(initial=0) + 1), np.uint8)
    for at, text in enumerate(texts):
        matrix[at, : len(text)] = np.frombuffer(text, np.uint8)
    shared = np.zeros(len(texts), np.int64)
    unequal = matrix[1:] != matrix[:-1]
    unequal[:, -1] = True
    shared[1:] = np.minimum(unequal.argmax(axis=1), np.minimum(lengths[1:], lengths[:-1]))
    return shared


def coded_run(suffixes: list[tuple[bytes, bytes, int, int, int]]) -> bytes:
    """A sorted run: suffix, bytes before the anchor, weight, row and first start; suffixes front-coded."""
    shared = shared_lengths([entry[0] for entry in suffixes])
    rests = [entry[0][same:] for entry, same in zip(suffixes, shared)]
    befores = [entry[1] for entry in suffixes]
    columns = [[entry[place] for entry in suffixes] for place in (2, 3, 4)]
    numbers = np.array([shared, list(map(len, rests)), list(map(len, befores)), *columns], np.int64)
    return zstandard.compress(
        len(suffixes).to_bytes(8, "little") + numbers.tobytes() + b"".join(rests) + b"".join(befores), 3
    )


def decoded_run(block: bytes) -> Iterator[tuple[int, bytes, tuple[bytes, int, int, int]]]:
    """Suffixes of a run in order, each with the length it shares with the one before."""
    data = zstandard.decompress(block)
    n = int.from_bytes(data[:8], "little")
    numbers = np.frombuffer(data, np.int64, 6 * n, 8).reshape(6, n)
    at = 8 + 48 * n
    before_at = at + int(numbers[1].sum())
    suffix = b""
    for shared, rest, before, weight, row, first in zip(*numbers.tolist()):
        suffix = suffix[:shared] + data[at : at + rest]
        yield shared, suffix, (data[before_at : before_at + before], weight, row, first)
        at, before_at = at + rest, before_at + before


class LoserTree:
    """Merges sorted runs without comparing known prefixes again.

    Every candidate knows how many bytes it shares with the string that came
    out last. Of two candidates the one that shares more is smaller; only if
    both share the same number of bytes are they compared, and from there on.
    """

    def __init__(self, runs: list[Iterator[tuple[int, bytes, tuple]]]):
        self.runs = runs
        self.leaves = 1 << max(0, (len(runs) - 1).bit_length())
        self.heads: list = [next(run, None) for run in runs] + [None] * (self.leaves - len(runs))
        self.shared = [0] * self.leaves
        self.losers = [0] * self.leaves
        self.winner = self._first_round(1)

    def _first_round(self, node: int) -> int:
        if node >= self.leaves:
            return node - self.leaves
        winner, loser = self._play(self._first_round(2 * node), self._first_round(2 * node + 1))
        self.losers[node] = loser
        return winner

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser then shares with the winner what ``shared`` says."""
        one, two = self.heads[a], self.heads[b]
        if one is None or two is None:
            return (b, a) if one is None else (a, b)
        same_a, same_b = self.shared[a], self.shared[b]
        if same_a != same_b:
            return (a, b) if same_a > same_b else (b, a)
        x, y, at = one[1], two[1], same_a
        if x[at:] == y[at:]:
            same = len(x)
            first = one[2] <= two[2]
        else:
            same = common_length(x, y, at)
            first = x[same:] < y[same:]
        winner, loser = (a, b) if first else (b, a)
        self.shared[loser] = same
        return winner, loser

    def __iter__(self) -> Iterator[tuple[int, bytes, tuple]]:
        while (head := self.heads[self.winner]) is not None:
            leaf = self.winner
            yield self.shared[leaf], head[1], head[2]
            following = next(self.runs[leaf], None) if leaf < len(self.runs) else None
            self.heads[leaf] = following
            self.shared[leaf] = following[0] if following else 0
            winner, node = leaf, (leaf + self.leaves) // 2
            while node:
                winner, self.losers[node] = self._play(winner, self.losers[node])
                node //= 2
            self.winner = winner


def common_length(x: bytes, y: bytes, at: int) -> int:
    """Length of the common prefix of two strings that agree on the first ``at`` bytes and differ later."""
    end, step = min(len(x), len(y)), 16
    while at < end and x[at : at + step] == y[at : at + step]:
        at += step
    at = min(at, end)
    while at < end and x[at] == y[at]:
        at += 1
    return at


def strings_in(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all strings of ``length`` bytes: the text they are in, where they start, and their hashes."""
    sizes = np.array([len(text) for text in texts])
    counts = sizes - length + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(sizes)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    hashes = string_hashes(np.frombuffer(b"".join(texts), np.uint8), length)
    return owner, within, hashes[offsets[owner] + within]


def by_hash(hashes: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by hash, where each hash begins in it, and the weight that it has in all."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    starts = np.concatenate([[0], np.nonzero(ordered[1:] != ordered[:-1])[0] + 1])
    return order, starts, np.add.reduceat(weight[order], starts)


def stretches(owner: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first and last start of runs of strings that touch, from starts in order by owner."""
    if not len(owner):
        return owner, start, start
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] - start[:-1] > length)])
    begins, ends = np.flatnonzero(new), np.flatnonzero(np.concatenate([new[1:], [True]]))
    return owner[begins], start[begins], start[ends]


def hot_strings(entries: list[tuple], length: int, buckets: int) -> tuple[dict[int, bytes], list[tuple[int, int, int]]]:
    """Strings of hot grams by bucket, those that a task has met more than once with weight 2, and their places."""
    owner, within, hashes = strings_in([text for text, *_ in entries], length)
    weight, row, first = (np.array(column, np.int64)[owner] for column in list(zip(*entries))[1:])
    order, starts, totals = by_hash(hashes, weight)
    again = np.zeros(len(hashes), bool)
    again[order] = np.repeat(totals > 1, np.diff(np.concatenate([starts, [len(hashes)]])))
    at = np.flatnonzero(again & (weight == 1))
    texts, begins, ends = stretches(owner[at], within[at], length)
    known = [
        (entries[text][2], entries[text][3] + begin, entries[text][3] + end + length)
        for text, begin, end in zip(texts.tolist(), begins.tolist(), ends.tolist())
    ]
    one = order[starts]
    sent = np.stack([hashes[one].view(np.int64), np.minimum(totals, 2), row[one], (first + within)[one]], axis=1)
    bucket = (mixed(hashes[one]) % np.uint64(buckets)).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[by_bucket])) + 1
    parts = np.split(by_bucket, edges)
    return {int(bucket[part[0]]): zstandard.compress(sent[part].tobytes(), 3) for part in parts}, known


def runs_in_batches(rule: Repeats, buckets: int, hot_buckets: int):
    """Sorted front-coded runs of the suffixes at the listed anchors, by bucket.

    Where a task meets the same bytes around an anchor again, it knows them to
    be repeated: their places go on as they are, under a bucket below zero,
    and the run gets the bytes once, with weight 2. So of a group of copies no
    more travels than one entry per run. Codes below zero are those of hot grams; their
    strings go to buckets from ``buckets`` on.
    """

    def blocks(held: dict[tuple[bool, bytes, bytes], list[tuple[int, int]]]) -> pa.RecordBatch:
        runs, known, hot, out = {}, [], [], []
        for (is_hot, suffix, before), members in held.items():
            if len(members) > 1:
                size = len(before) + len(suffix)
                known += [(row, first, first + size) for row, first in members]
                place = (2, 0, 0)
            else:
                place = (1, *members[0])
            if is_hot:
                hot.append((before + suffix, *place))
            else:
                bucket = xxhash.xxh3_64_intdigest(suffix[:GRAM]) % buckets
                runs.setdefault(bucket, []).append((suffix, before, *place))
        for at in range(0, len(hot), HELD_CONTEXTS):
            strings, places = hot_strings(hot[at : at + HELD_CONTEXTS], rule.length, hot_buckets)
            out += [(buckets + bucket, block) for bucket, block in strings.items()]
            known += places
        out += [(bucket, coded_run(sorted(entries))) for bucket, entries in runs.items()]
        for at in range(0, len(known), KNOWN_PLACES):
            places = np.array(known[at : at + KNOWN_PLACES], np.int64)
            out.append((-1 - int(places[0, 0] % buckets), zstandard.compress(places.tobytes(), 3)))
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], ["bucket", "run"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in slices(batches, 64):
            rows = zip(batch["row"].to_pylist(), texts_of(batch["text"]), batch["codes"].to_pylist())
            for row, data, codes in rows:
                codes = np.unique(np.array(codes, np.int64))
                place, first, last = unpacked(np.where(codes < 0, ~codes, codes))
                for code, at, begin, end in zip(codes.tolist(), place.tolist(), first.tolist(), last.tolist()):
                    key = (code < 0, data[at : end + rule.length], data[begin:at])
                    held.setdefault(key, []).append((row, begin))
                    size += end + rule.length - begin
                if size > RUN_BYTES:
                    yield blocks(held)
                    held, size = {}, 0
        if held:
            yield blocks(held)

    return run


class Comparison:
    """Finds out which strings around anchors occur twice, for groups of suffixes that share their gram."""

    def __init__(self, rule: Repeats):
        self.rule = rule
        self.clear()

    def clear(self) -> None:
        self.group: dict[tuple[int, bytes], list] = {}
        self.closed: list[tuple[bytes, list]] = []
        self.size = 0

    def add(self, suffix: bytes, before: bytes, weight: int, row: int, first: int) -> None:
        """One more entry; one of weight 2 stands for several whose places are known to repeat."""
        entry = self.group.setdefault((len(before), before + suffix), [0])
        entry[0] += weight
        if weight == 1:
            entry.append((row, first))

    def close_group(self) -> None:
        """A group with one suffix has no second occurrence anywhere."""
        if sum(entry[0] for entry in self.group.values()) > 1:
            for (_, text), entry in self.group.items():
                self.closed.append((text, entry))
                self.size += len(text)
        self.group = {}

    def covered(self) -> Iterator[tuple[int, int, int]]:
        """Row, start and end of the bytes that repeated strings cover."""
        if not self.closed:
            return
        length = self.rule.length
        owner, within, hashes = strings_in([text for text, _ in self.closed], length)
        order, starts, totals = by_hash(hashes, np.array([entry[0] for _, entry in self.closed])[owner])
        repeated = np.zeros(len(hashes), bool)
        repeated[order] = np.repeat(totals > 1, np.diff(np.concatenate([starts, [len(hashes)]])))
        at = np.flatnonzero(repeated)
        # Runs of repeated starts in one text become one stretch where they touch.
        for text, start, end in zip(*(column.tolist() for column in stretches(owner[at], within[at], length))):
            for row, first in self.closed[text][1][1:]:
                yield row, first + start, first + end + length


def hot_stretches(blocks: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """Covered stretches from the strings of a bucket of hot grams."""
    strings = np.frombuffer(b"".join(map(zstandard.decompress, blocks)), np.int64).reshape(-1, 4)
    order, starts, totals = by_hash(strings[:, 0], strings[:, 1])
    again = np.repeat(totals > 1, np.diff(np.concatenate([starts, [len(strings)]])))
    found = strings[order[again]]
    found = found[found[:, 1] == 1]  # the places of others are known
    found = found[np.lexsort((found[:, 3], found[:, 2]))]
    for row, start, end in zip(*(column.tolist() for column in stretches(found[:, 2], found[:, 3], length))):
        yield row, start, end + length


def merged_in_batches(rule: Repeats, buckets: int):
    """Covered stretches from the runs of each bucket; buckets come one after another."""

    def of_bucket(number: int | None, blocks: list[bytes], comparison: Comparison) -> Iterator[tuple[int, int, int]]:
        if number is not None:
            yield from merged(blocks, comparison) if number < buckets else hot_stretches(blocks, rule.length)

    def merged(runs: list[bytes], comparison: Comparison) -> Iterator[tuple[int, int, int]]:
        for shared, suffix, (before, weight, row, first) in LoserTree([decoded_run(block) for block in runs]):
            if shared < GRAM:
                comparison.close_group()
                if comparison.size > COMPARED_BYTES:
                    yield from comparison.covered()
                    comparison.clear()
            comparison.add(suffix, before, weight, row, first)
        comparison.close_group()

    def out(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["row", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comparison, bucket, runs, rows = Comparison(rule), None, [], []
        for batch in slices(batches, 16):
            for number, block in zip(batch["bucket"].to_pylist(), batch["run"].to_pylist()):
                if number < 0:
                    places = np.frombuffer(zstandard.decompress(block), np.int64).reshape(-1, 3)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in places.T.copy()], ["row", "start", "end"])
                    continue
                if number != bucket:
                    rows += of_bucket(bucket, runs, comparison)
                    bucket, runs = number, []
                runs.append(block)
            if rows:
                yield out(rows)
                rows = []
        rows += of_bucket(bucket, runs, comparison)
        rows += comparison.covered()
        if rows:
            yield out(rows)

    return run


def cut_in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their covered stretches."""
    for batch in slices(batches, 64):
        spans, kept = [], []
        for data, stretches in zip(texts_of(batch["text"]), batch["stretches"].to_pylist()):
            own, parts, at = [], [], 0
            for start, end in sorted((s["start"], s["end"]) for s in stretches or ()):
                if own and start <= own[-1]["end"]:
                    own[-1]["end"] = max(end, own[-1]["end"])
                else:
                    own.append({"start": start, "end": end})
            for span in own:
                parts.append(data[at : span["start"]])
                at = span["end"]
            spans.append(own)
            kept.append(b"".join([*parts, data[at:]]))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["n_bytes"], pa.array(spans, kind), pa.array(kept, pa.binary())],
            ["id", "n_bytes", "spans", "kept"],
        )


def covered_stretches(rows: DataFrame, rule: Repeats) -> DataFrame:
    """Columns row, start and end (bytes) of what strings that occur twice cover, from columns row and text."""
    folder = work_dir(rows.sparkSession)
    placed = rows.mapInArrow(anchors_in_batches(rule), "gram long, row long, code long")
    placed = snapshot(placed, f"{folder}/anchors")
    # Only grams that are an anchor twice can belong to a string that occurs twice.
    counted = placed.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Read from files, both sides of the join are plain exchanges, whose hot grams Spark can split.
    grams = snapshot(counted, f"{folder}/grams")
    again = placed.join(grams, "gram").withColumn("code", F.when(F.col("n") > HOT_ANCHORS, F.bitwise_not("code")).otherwise(F.col("code")))
    codes = snapshot(again.groupBy("row").agg(F.collect_list("code").alias("codes")), f"{folder}/codes")
    sizes = grams.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("n") > HOT_ANCHORS, F.col("n"))).alias("hot")).first()
    buckets = max(12, -(-(sizes["all"] or 0) // BUCKET_SUFFIXES))
    hot_buckets = max(12, -(-(sizes["hot"] or 0) * rule.grams // BUCKET_STRINGS))
    concerned = rows.filter(let_through(slot_of("row"), slot_filter(codes, "row")))
    listed = concerned.join(codes, "row").select("row", "text", "codes")
    runs = listed.mapInArrow(runs_in_batches(rule, buckets, hot_buckets), "bucket int, run binary")
    exchanged = runs.repartition("bucket").sortWithinPartitions("bucket")
    return snapshot(exchanged.mapInArrow(merged_in_batches(rule, buckets), "row long, start long, end long"), f"{folder}/covered")


def without_repeats(
    df: DataFrame, rule: Repeats = Repeats(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every text without the bytes that strings occurring twice cover: id, n_bytes, spans and kept.

    Texts are UTF-8 bytes; ``spans`` are the removed stretches (bytes, end
    exclusive), ``kept`` is what remains. A string counts as repeated if it
    also starts elsewhere, in the same text or another, judged on the input.
    A missing text is empty. Repeated rows repeat each other; rows that share
    an id are judged each. Other columns are ignored. Strings are told apart
    by 64-bit hashes among those that share a whole gram.
    """
    rows = text_frame(df, id_column, text_column).withColumn("row", F.xxhash64("id", "text"))
    covered = covered_stretches(rows.select("row", "text"), rule)
    held = slot_filter(covered, "row")
    kind = rows.schema["id"].dataType.simpleString()
    whole = rows.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    concerned = let_through(slot_of("row"), held)
    stretches = covered.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("stretches"))
    cut = (
        whole.filter(concerned)
        .join(stretches, "row", "left")
        .select("id", "n_bytes", "text", "stretches")
        .mapInArrow(cut_in_batches, f"id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    )
    uncut = whole.filter(~concerned).select(
        "id",
        "n_bytes",
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("kept"),
    )
    return cut.unionByName(uncut).withColumnRenamed("id", id_column)


def repeats_digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return found.select(
        id_column,
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
