import random
from collections import Counter

import numpy as np
import pytest

from clusterloom.llm import topk
from clusterloom.llm.topk import exact_type, ordered, signed, top_k

NAN = float("nan")


def frame(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, query_id long, rank string, score string, row string, v string"
    return spark.createDataFrame([(*row, 1, 7, *"????") for row in rows], schema)


def brute(rows, k=20, scale=64, every=20):
    """Every query against every other row, in Python's whole numbers."""
    usable = []
    for name, vector in rows:
        if vector is not None and all(c is not None and np.isfinite(np.float32(c)) for c in vector):
            usable.append((name, [int(np.floor(float(np.float32(c)) * scale)) for c in vector]))
    found = []
    for at, (query, own) in enumerate(usable):
        if query is None or query % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(own, other)), name is None, name or 0, name)
            for place, (name, other) in enumerate(usable)
            if place != at and len(other) == len(own)
        ]
        for rank, (score, _, _, name) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1):
            found.append((query, rank, name, -score))
    return Counter(found)


def got(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return Counter(map(tuple, df.collect()))


def odd_rows(seed=3):
    rnd = random.Random(seed)
    rows = [(n, [rnd.gauss(0, 0.2) for _ in range(6)]) for n in range(-60, 240)]
    rows += [(500 + n, rows[7][1]) for n in range(150)]  # many ties, ids in the way
    rows += [(600, rows[7][1])] * 90  # repeated rows, which only their number tells apart
    rows += [(None, rows[9][1]), (None, rows[9][1]), (20, rows[11][1]), (20, rows[11][1])]
    rows += [(700, None), (720, [0.1, None, 0.1, 0.1, 0.1, 0.1]), (740, [NAN] * 6), (760, [float("inf")] + [0.0] * 5)]
    rows += [(780, []), (800, []), (820, [1.0, 2.0]), (821, [3.0, -4.0]), (840, [1.0])]
    return rows


@pytest.mark.parametrize("wave, ranked", [(8192, 64), (7, 1)])
def test_equals_brute_force(spark, monkeypatch, wave, ranked):
    """Also with many waves, and with a search that goes on to the very last key."""
    monkeypatch.setattr(topk, "WAVE_QUERIES", wave)
    monkeypatch.setattr(topk, "RANKED", ranked)
    rows = odd_rows()
    assert got(top_k(frame(spark, rows))) == brute(rows)


def test_large_entries_stay_exact(spark):
    rnd = random.Random(5)
    for size in (900.0, 3e5, 2e7):  # single and double precision, and beyond
        rows = [(n, [rnd.uniform(-size, size) for _ in range(3)]) for n in range(80)]
        assert got(top_k(frame(spark, rows), k=5)) == brute(rows, k=5)
    assert [exact_type(n) for n in (1 << 22, 1 << 51, 1 << 60)] == [np.float32, np.float64, object]
    # a vector too long for 64-bit scores takes no part
    assert got(top_k(frame(spark, [(0, [1e30, 1.0]), (20, [1.0, 1.0]), (21, [1.0, 0.0])]))) == Counter([(20, 1, 21, 4096)])


def test_few_rows(spark):
    assert got(top_k(frame(spark, []))) == Counter()
    assert got(top_k(frame(spark, [(3, [1.0]), (None, [1.0])]))) == Counter()
    assert got(top_k(frame(spark, [(40, [1.0])]))) == Counter()
    rows = [(0, [1.0]), (1, [2.0]), (2, [-1.0])]
    assert got(top_k(frame(spark, rows), k=2)) == Counter([(0, 1, 1, 8192), (0, 2, 2, -4096)])


def test_keys_keep_the_order():
    values = np.array([-(1 << 63), -5, -1, 0, 3, (1 << 63) - 1])
    keys = ordered(values)
    assert (np.diff(keys.astype(object)) > 0).all() and (signed(keys) == values).all()


def test_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    plain = [(r["vec_id"], r["embedding"]) for r in rows.collect()]
    assert got(top_k(rows)) == brute(plain)
