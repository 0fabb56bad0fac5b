import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchbook.llm import negatives, queries
from tests.compare import connect, differences


def test_query_against_sql(spark, folder):
    sql = queries.REGISTRY.oracle_sql()["op12_hard_negatives"]
    for path in (folder, "/root/testdata/sf0.01"):
        assert differences(queries.op12_hard_negatives(spark, path), connect(path), sql) is None


@pytest.mark.parametrize("high,dims", [(0, 3), (1, 1), (127, 64), (300, 2500), (2**20, 64), (2**31, 2), (5, 0)])
def test_scores_are_exact(high, dims):
    rng = np.random.default_rng(dims)
    a, b = (rng.integers(-high, high + 1, (n, dims)) for n in (9, 7))
    if dims and high:
        a[0], b[0], b[1] = high, high, -high
    assert (negatives.scores(a, b) == a @ b.T).all()


def test_scores_beyond_double_precision():
    a = np.array([[2**31, 1, 2**30], [-(2**31), 1, 0]], np.int64)
    b = np.array([[2**31, 1, 0], [2**31 - 1, -3, 2**30]], np.int64)
    wanted = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b] for u in a]
    assert negatives.scores(a, b).tolist() == wanted


def plain(rows, k=5, scale=1, floor=80):
    """Brute force over (id, vector, label); anchors are ids divisible by 100, with their smallest label and vector."""
    usable = [(i, label, [int(np.floor(scale * x)) for x in v]) for i, v, label in rows if good(i, v, label)]
    out = []
    for a in sorted({i for i, *_ in usable if i % 100 == 0}):
        label, v = min((label, v) for i, label, v in usable if i == a)
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), i, other == label) for i, other, w in usable if len(w) == len(v)]
        for p, pid, _ in sorted(s for s in scored if s[2] and s[1] != a)[:k]:
            fits = sorted(s for s in scored if not s[2] and floor * -p <= 100 * -s[0] <= 100 * -p)[:k]
            out += [(a, pid, r + 1, nid, -p, -n) for r, (n, nid, _) in enumerate(fits)]
    return sorted(out)


def good(i, v, label):
    return i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    """Ties, repeated and negative ids, a hot label, rows that take no part; with small packs, blocks and lanes."""
    if small:
        for name, n in (("PACK", 16), ("ANCHORS", 2), ("LANE", 3)):
            monkeypatch.setattr(negatives, name, n)
    rng = random.Random(7)
    rows = [(i - 500, [float(rng.randrange(-3, 5)) for _ in range(6)], rng.choice([0, 0, 0, 1, 2, 3])) for i in range(1000)]
    rows += [rows[520], rows[520], (100, [4.0] * 6, 1), (100, [4.0] * 6, 0), (200, [1.0], 0), (201, [1.0], 0), (202, [1.0], 1), (300, [], 1)]
    rows += [(None, [4.0] * 6, 1), (400, None, 1), (401, [None] * 6, 1), (402, [float("nan")] * 6, 1), (403, [4.0] * 6, None), (404, [float("inf")] * 6, 1)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, label int, score string, part int")
    got = negatives.mine(frame.repartition(4), F.col("vec_id") % 100 == 0, scale=1)
    # Positives that share an id are different rows, which the plain version lists one after the other as well.
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_margins_zero_and_negative_positives(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [10.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [-5.0, 0.0], 1)]
    rows += [(10, [8.0, 0.0], 2), (11, [7.0, 0.0], 2), (12, [10.0, 3.0], 2), (13, [11.0, 0.0], 2), (14, [0.0, 9.0], 2), (15, [-4.0, 1.0], 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label long")
    got = sorted(map(tuple, negatives.mine(frame, F.col("vec_id") == 0, scale=1).collect()))
    assert got == [(0, 1, 1, 12, 10, 10), (0, 1, 2, 10, 10, 8), (0, 2, 1, 14, 0, 0)]


def test_empty_tables_and_no_anchors(spark, odd):
    frame = spark.createDataFrame([(1, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert negatives.mine(frame, F.col("vec_id") % 100 == 0).count() == 0
    assert negatives.mine(frame, F.lit(True)).count() == 0


def test_long_vectors(spark):
    """More terms than single precision can add up at once."""
    rng = np.random.default_rng(1)
    values = rng.integers(-400, 401, (60, 3000))
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(2)
    got = negatives.mine(frame, F.col("vec_id") % 100 == 0, scale=1)
    assert sorted(map(tuple, got.collect())) == plain(rows)
