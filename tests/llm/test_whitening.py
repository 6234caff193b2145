import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from clusterloom.llm import whitening
from clusterloom.llm.whitening import above, digits, eigenpairs, intervals, leading, whiten

NAN = float("nan")


def frame(spark, rows):
    schema = "vec_id long, embedding array<double>, label int, id string, n string, x string, component string"
    return spark.createDataFrame([(*row, 1, *"????") for row in rows], schema)


def brute(rows, components=8):
    """Whole numbers in Python, the covariance as fractions, eigenpairs of LAPACK."""
    usable = [
        (name, [int(np.floor(c * 1024)) + 100_000 for c in vector])
        for name, vector in rows
        if vector is not None and all(c is not None and np.isfinite(c) for c in vector)
    ]
    counts = Counter(len(x) for _, x in usable)
    length = max(counts, key=lambda size: (counts[size], size))
    usable = [(name, x) for name, x in usable if len(x) == length]
    n, sums = len(usable), [sum(column) for column in zip(*(x for _, x in usable))]
    apart = [[n * c - s for c, s in zip(x, sums)] for _, x in usable]
    matrix = np.array(
        [[float(Fraction(sum(a[i] * a[j] for a in apart), n**3)) for j in range(length)] for i in range(length)]
    )
    values, vectors = np.linalg.eigh(matrix)
    order = [i for i in np.argsort(-values)[:components] if values[i] > 1e-10 * values.max()]
    projected = np.array(apart, float) / n @ vectors[:, order] / np.sqrt(values[order])
    return usable, n, [sum(c * c for c in a) for a in apart], projected, values[order] / np.trace(matrix)


def check(df, rows, components=8):
    names = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    assert df.dtypes == [("vec_id", "bigint"), *[tuple(x.split(" ")) for x in names.split(", ")]]
    usable, n, deviation, projected, explained = brute(rows, components)
    found = df.collect()
    assert len(found) == n * len(explained) and {r["n"] for r in found} == {n}
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9
    for component, share in enumerate(explained, 1):
        own = [r for r in found if r["component"] == component]
        assert [*{r["explained"] for r in own}] == [pytest.approx(share, rel=1e-9)]
        expected = sorted((repr(name), d, w) for (name, _), d, w in zip(usable, deviation, projected[:, component - 1]))
        got = sorted((repr(r["vec_id"]), r["deviation"], r["whitened"]) for r in own)
        assert [x[:2] for x in got] == [x[:2] for x in expected]
        turned = sorted((x[0], x[1], -x[2]) for x in got)
        close = [np.allclose([x[2] for x in side], [x[2] for x in expected], rtol=1e-7, atol=1e-8) for side in (got, turned)]
        assert any(close), component


def odd_rows(d=12, n=200):
    rnd = random.Random(7)
    rows = [(i, [rnd.gauss(0.3 * k, 0.05 * (k % 5 + 1)) for k in range(d)]) for i in range(n)]
    rows += [(None, rows[3][1]), (5, rows[5][1]), (5, rows[5][1])]
    rows += [(900, None), (901, [None] * d), (902, [NAN] * d), (903, [float("-inf")] * d), (904, []), (905, [1.0] * (d + 1))]
    return rows


def test_equals_brute_force(spark):
    check(whiten(frame(spark, odd_rows())), odd_rows())


def test_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(whiten(rows), [(r["vec_id"], r["embedding"]) for r in rows.collect()])


def test_fewer_dimensions_than_components_and_rank(spark):
    check(whiten(frame(spark, odd_rows(3))), odd_rows(3))
    rows = [(i, [i * 0.5, i * 1.0, (i % 3) * 2.0]) for i in range(9)]  # rank 2
    check(whiten(frame(spark, rows)), rows)
    rows = odd_rows(20)[:6]  # fewer rows than dimensions
    check(whiten(frame(spark, rows)), rows)


def test_large_entries_stay_exact(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.uniform(-2e4, 2e4) for _ in range(3)]) for i in range(30)]
    check(whiten(frame(spark, rows)), rows)
    huge = [*rows, (99, [1e30, 0.0, 0.0])]
    check(whiten(frame(spark, huge)), rows)
    values = np.array([[-(1 << 41) - 5, 7, (1 << 40) + 3]])
    assert sum(d * 2.0 ** (18 * i) for i, d in enumerate(digits(values))).tolist() == values.tolist()
    rows = [(i, [rnd.uniform(-1e8, 1e8) for _ in range(2)]) for i in range(40)]
    assert {r["deviation"] for r in whiten(frame(spark, rows)).collect()} == {None}  # beyond 64 bits


def test_no_components(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]):
        assert whiten(frame(spark, rows)).collect() == []
    with pytest.raises(ValueError, match="2049"):
        whiten(frame(spark, [(1, [1.0] * 2049)]))


def symmetric(values, seed=0):
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return basis @ np.diag(values) @ basis.T


def test_inertia_counts():
    rnd = np.random.default_rng(1)
    for _ in range(60):
        values = np.sort(rnd.standard_normal(rnd.integers(1, 25)))
        matrix = symmetric(values, int(rnd.integers(99)))
        for shift in (*rnd.standard_normal(5), -9.0, 9.0):
            assert above(matrix, shift) == (values > shift).sum()
    assert above(np.zeros((3, 3)), 0.0) == 0 and above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert above(np.zeros((0, 0)), 1.0) == 0


@pytest.mark.parametrize(
    "values",
    [
        [*np.linspace(1, 40, 40)], [5.0] * 20 + [1.0] * 20, [1.0] * 40, [*np.geomspace(1e-9, 1, 30)],
        [*(1 + 1e-12 * np.arange(30)), 3.0], [0.0] * 30 + [2.0, 3.0], [*np.linspace(1, 1.001, 30), 900.0],
    ],
)
def test_eigenpairs_of_hard_spectra(spark, values):
    """Ties, clusters, wide ranges and zeros."""
    matrix = symmetric(values)
    matrix = (matrix + matrix.T) / 2
    found, vectors = leading(spark, matrix, 8)
    expected = sorted(values, reverse=True)[:8]
    expected = [v for v in expected if v > 1e-10 * max(values)]
    assert np.allclose(found, expected, rtol=1e-8, atol=1e-13 * max(values))
    assert np.abs(vectors.T @ vectors - np.eye(len(expected))).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * max(values)


def test_intervals_hold_what_they_say():
    values = np.linspace(1, 40, 40)
    matrix = symmetric(values)
    cuts = intervals(matrix, 8)
    assert sum(n for *_, n in cuts) == 8 and all(n <= whitening.PER_INTERVAL for *_, n in cuts)
    for low, high, n in cuts:
        own = values[(values > low) & (values <= high)]
        assert len(own) == n
        assert np.allclose(np.sort(eigenpairs(matrix, low, high, n)[0]), own, rtol=1e-13)


def test_a_missed_eigenvalue_is_noticed(spark, monkeypatch):
    matrix = symmetric(np.linspace(1, 40, 40))
    monkeypatch.setattr(whitening, "intervals", lambda *_: [(0.5, 1.5, 1), (38.5, 41.0, 2)])
    with pytest.raises(ArithmeticError):
        leading(spark, matrix, 8)
