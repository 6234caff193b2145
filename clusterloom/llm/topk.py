"""Exact top-k search by inner product.

No candidate is left out and no list of scores is kept. Every query is
scored against all candidates; a round counts its scores in the bins of a
histogram and so finds the bin that holds the k-th best, and the next round
looks into that bin only. Where many candidates share the k-th score, the
same search goes on over their ids, then over their row numbers. When few
rows are left between the ends of a bin, one last round gives the rows that
are better than its lower end, and these are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clusterloom.llm.vectors import LARGEST, by_length, is_usable, scaled_down, squared_length
from clusterloom.storage import drop_snapshot, snapshot, work_dir

#: Queries of a wave, and bytes of their vectors; a wave is broadcast.
WAVE_QUERIES = 8192
WAVE_BYTES = 8 << 20

#: Bins of a histogram, and scores that a task holds at a time.
BINS = 256
SCORES = 1 << 21

#: A bin with so few rows is not searched further: they are ranked.
RANKED = 64

#: Rows of a candidate file at most.
FILE_ROWS = 250_000

_SIGN = np.uint64(1 << 63)

SCORE, ID, ROW, FOUND = range(4)


def ordered(values: np.ndarray) -> np.ndarray:
    """64-bit integers as unsigned ones of the same order."""
    return np.asarray(values, np.int64).view(np.uint64) ^ _SIGN


def signed(keys: np.ndarray) -> np.ndarray:
    return (keys ^ _SIGN).view(np.int64)


@dataclass
class Search:
    """How far every query of a wave has come.

    ``level`` says what is searched: the score, the id among rows of score
    ``score``, or the row number among rows of that score and id. The k-th
    best has a key from ``low`` to ``high`` there (better is smaller), cut
    into bins of ``width``; ``above`` rows are better than that.
    """

    level: np.ndarray
    score: np.ndarray
    id: np.ndarray
    low: np.ndarray
    high: np.ndarray
    above: np.ndarray

    @classmethod
    def start(cls, bounds: np.ndarray) -> Search:
        n = len(bounds)
        zeros = np.zeros(n, np.int64)
        return cls(np.full(n, SCORE), zeros, zeros.view(np.uint64).copy(), ordered(-bounds), ordered(bounds), zeros.copy())

    def part(self, at: np.ndarray) -> Search:
        return Search(*[getattr(self, f.name)[at].copy() for f in fields(self)])

    @property
    def width(self) -> np.ndarray:
        return (self.high - self.low) // np.uint64(BINS) + np.uint64(1)

    def scores(self) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest score that matters to the search."""
        at_score = self.level == SCORE
        return np.where(at_score, -signed(self.high), self.score), np.where(at_score, -signed(self.low), self.score)

    def narrow(self, query: np.ndarray, bins: np.ndarray, before: np.ndarray, n: np.ndarray, ends: dict) -> None:
        """Go on in the bin of the k-th best; ``ends`` are the keys of all ids and rows."""
        width = self.width[query]
        low = self.low[query] + bins.astype(np.uint64) * width
        self.high[query] = np.minimum(self.high[query], low + (width - np.uint64(1)))
        self.low[query] = low
        self.above[query] += before
        few = n <= RANKED
        self.level[query[few]] = FOUND + self.level[query[few]]
        for level in (ROW, ID, SCORE):  # so that none moves on twice
            single = query[~few & (self.level[query] == level) & (self.low[query] == self.high[query])]
            if level == SCORE:
                self.score[single] = -signed(self.low[single])
            elif level == ID:
                self.id[single] = self.low[single]
            self.level[single] = level + 1
            if level + 1 in ends:
                self.low[single], self.high[single] = ends[level + 1]


def scores_of(queries: np.ndarray, candidates: np.ndarray, exact: type) -> np.ndarray:
    found = queries.astype(exact) @ candidates.astype(exact).T
    return found.astype(np.int64) if exact is object else found


def exact_type(longest: float) -> type:
    """Numbers in which inner products of vectors up to a squared length come out exactly."""
    return np.float32 if longest < 1 << 23 else np.float64 if longest < 1 << 52 else object


class Hits:
    """Of a piece of candidates, those that matter to the queries."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids = batch["id"].fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        self.rows = batch["row"].to_numpy()
        self.vectors = by_length(batch["v"])

    def among(self, wave: dict, which: np.ndarray, least: np.ndarray, most: np.ndarray | None):
        """Positions in ``which``, candidates, and their scores, from ``least`` to ``most``; never a query's own row."""
        for length, (at, matrix) in self.vectors.items():
            if length not in wave["by_length"]:
                continue
            own, queries = wave["by_length"][length]
            place = np.full(len(wave["row"]), -1)
            place[own] = np.arange(len(own))
            mine = np.flatnonzero(place[which] >= 0)
            step = max(1, SCORES // max(1, len(mine)))
            for start in range(0, len(at) if len(mine) else 0, step):
                scores = scores_of(queries[place[which[mine]]], matrix[start : start + step], wave["exact"])
                wanted = scores >= least[mine, None].astype(scores.dtype)
                if most is not None:
                    wanted &= scores <= most[mine, None].astype(scores.dtype)
                q, c = np.nonzero(wanted)
                found = scores[q, c].astype(np.int64)
                q, c = mine[q], at[start + c]
                other = self.rows[c] != wave["row"][which[q]]
                yield q[other], c[other], found[other]


def histograms_in_batches(held, search: Search, which: np.ndarray, k: int):
    """Counts by query and bin, from the best bin to that in which this task alone has found enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave, own, width = held.value, search.part(slice(None)), search.width
        need = k - search.above
        counts = np.zeros((len(which), BINS), np.int64)
        for batch in batches:
            hits = Hits(batch)
            for q, c, found in hits.among(wave, which, *own.scores()):
                level = own.level[q]
                keys = np.where(level == SCORE, ordered(-found), np.where(level == ID, ordered(hits.ids[c]), ordered(hits.rows[c])))
                inside = (keys >= own.low[q]) & (keys <= own.high[q])
                inside &= (level != ROW) | (ordered(hits.ids[c]) == own.id[q])
                q, keys = q[inside], keys[inside]
                bins = ((keys - own.low[q]) // width[q]).astype(np.int64)
                np.add.at(counts, (q, bins), 1)
                changed = np.unique(q)
                last = _enough(counts[changed], need[changed])
                edge = own.low[changed] + last.astype(np.uint64) * width[changed] + (width[changed] - np.uint64(1))
                # The last bin may end beyond the range.
                own.high[changed] = np.where(last < BINS - 1, np.minimum(own.high[changed], edge), own.high[changed])
        last = _enough(counts, need)
        counts[np.arange(BINS) > last[:, None]] = 0
        q, bins = np.nonzero(counts)
        columns = [pa.array(which[q], pa.int32()), pa.array(bins, pa.int32()), pa.array(need[q]), pa.array(counts[q, bins])]
        yield pa.RecordBatch.from_arrays(columns, ["query", "bin", "need", "n"])

    return count


def _enough(counts: np.ndarray, need: np.ndarray) -> np.ndarray:
    """The first bin up to which there are enough rows, the last one where there never are."""
    reached = counts.cumsum(axis=1) >= need[:, None]
    return np.where(reached[:, -1], reached.argmax(axis=1), BINS - 1)


def located(candidates: DataFrame, held, search: Search, which: np.ndarray, k: int) -> pa.Table:
    """The bin of the k-th best of every query, the rows before it and in it; none where there are fewer than k."""
    counts = candidates.mapInArrow(histograms_in_batches(held, search, which, k), "query int, bin int, need long, n long")
    merged = counts.groupBy("query", "bin").agg(F.max("need").alias("need"), F.sum("n").alias("n"))
    reached = F.sum("n").over(Window.partitionBy("query").orderBy("bin"))
    merged = merged.withColumn("before", reached - F.col("n"))
    # A row for each query of the wave at most.
    return merged.filter("before < need and before + n >= need").select("query", "bin", "before", "n").toArrow()


def best_in_batches(held, search: Search):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave, which = held.value, np.arange(len(search.level))
        level = search.level % FOUND
        least = np.where(level == SCORE, -signed(search.high), search.score)
        for batch in batches:
            hits = Hits(batch)
            for q, c, found in hits.among(wave, which, least, None):
                ids, rows = ordered(hits.ids[c]), ordered(hits.rows[c])
                tied = (level[q] != SCORE) & (found == search.score[q])
                by_id = (level[q] == ID) & (ids <= search.high[q])
                by_row = (level[q] == ROW) & ((ids < search.id[q]) | (ids == search.id[q]) & (rows <= search.high[q]))
                kept = ~tied | by_id | by_row
                q, c, found = q[kept], c[kept], found[kept]
                columns = [
                    pa.array(wave["row"][q]), pa.array(wave["id"][q]), batch["id"].take(pa.array(c)),
                    batch["row"].take(pa.array(c)), pa.array(found),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["query_row", "query_id", "vec_id", "row", "score"])

    return run


def search_wave(candidates: DataFrame, queries: pa.Table, facts: dict, k: int, path: str) -> None:
    """Write the k best of every query of a wave."""
    spark = candidates.sparkSession
    wave = {
        "id": queries["id"].to_numpy(), "row": queries["row"].to_numpy(),
        "by_length": by_length(pa.concat_arrays(queries["v"].chunks)), "exact": exact_type(facts["longest"]),
    }
    bounds = np.zeros(len(wave["id"]), np.int64)
    for at, matrix in wave["by_length"].values():
        own = [sum(c * c for c in row) for row in matrix.tolist()]
        bounds[at] = [math.isqrt(n * math.ceil(facts["longest"])) + 1 for n in own]
    search = Search.start(bounds)
    ends = {
        ID: (ordered(facts["least_id"]), ordered(np.iinfo(np.int64).max)),
        ROW: (ordered(0), ordered(facts["last_row"])),
    }
    held = spark.sparkContext.broadcast(wave)
    try:
        while len(which := np.flatnonzero(search.level < FOUND)):
            found = located(candidates, held, search.part(which), which, k)
            query = found["query"].to_numpy().astype(np.int64)
            # Where there are fewer than k rows in all, all of them are the best.
            missing = np.setdiff1d(which, query)
            search.narrow(query, *[found[name].to_numpy() for name in ("bin", "before", "n")], ends)
            search.level[missing] += FOUND
        schema = "query_row long, query_id long, vec_id long, row long, score long"
        best = candidates.mapInArrow(best_in_batches(held, search), schema)
        order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.parquet(path)
    finally:
        held.destroy()


def top_k(
    df: DataFrame,
    k: int = 20,
    scale: int = 64,
    query_every: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Columns query_id, rank (from 1), vec_id, score: the ``k`` best candidates of every query.

    Entries become floor(scale * entry), a score is the inner product of two
    such vectors. Queries are the rows whose id is divisible by
    ``query_every``, candidates all rows but the query's own; equal scores
    rank by the smaller id. A query with fewer candidates gets all of them.
    Vectors that are null, or hold null or non-finite entries, take no part,
    and neither do those whose inner product with themselves passes 62 bits,
    so that every score fits. Only vectors of one length are compared. Rows
    without an id are candidates, after those with one where scores are
    equal, and no queries. Rows that share an id, or are repeated, count one
    by one, as candidates and as queries. Other columns are ignored; an empty
    table gives no rows.

    The usable rows are written once to the shared folder. Queries go in
    waves of bounded size, which are broadcast one after another; a task
    sends at most ``k`` bins for each query and round.
    """
    spark = df.sparkSession
    files = max(spark.sparkContext.defaultParallelism, -(-df.count() // FILE_ROWS))
    vector = F.col(vector_column)
    rows = df.filter(is_usable(vector)).select(F.col(id_column).cast("long").alias("id"), scaled_down(vector, scale).alias("v"))
    rows = rows.filter(squared_length(F.col("v")) < float(LARGEST)).repartition(files)
    folder = work_dir(spark)
    try:
        candidates = snapshot(rows.withColumn("row", F.monotonically_increasing_id()), f"{folder}/candidates")
        queries = candidates.filter(F.col("id") % query_every == 0)
        facts = candidates.agg(
            F.max(squared_length(F.col("v"))).alias("longest"), F.min("id").alias("least_id"), F.max("row").alias("last_row")
        ).first()
        asked = queries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v") * 8).alias("bytes")).first()
        if asked["n"]:
            waves = max(-(-asked["n"] // WAVE_QUERIES), -(-asked["bytes"] // WAVE_BYTES))
            spread = queries.withColumn("wave", F.pmod(F.xxhash64("row"), F.lit(waves)))
            spread.write.partitionBy("wave").parquet(f"{folder}/queries")
            for number in range(waves):
                own = spark.read.schema(spread.schema).parquet(f"{folder}/queries").filter(F.col("wave") == number)
                own = own.drop("wave").toArrow()
                if own.num_rows:
                    search_wave(candidates, own, facts.asDict(), k, f"{folder}/best/{number}")
    finally:
        for part in ("candidates", "queries"):
            drop_snapshot(spark, f"{folder}/{part}")
    schema = "query_id long, rank int, vec_id long, score long"
    if not asked["n"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/best/*")
