import random

import numpy as np

from matchbook.llm import blockmax, queries
from tests.compare import connect, differences


def test_query_against_sql(spark, folder):
    sql = queries.REGISTRY.oracle_sql()["op9_block_max_top_k"]
    assert differences(queries.op9_block_max_top_k(spark, folder), connect(folder), sql) is None


def test_ties_repeats_and_bad_vectors(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(-2, 3) / 2 for _ in range(3)]) for i in range(400)]
    rows += [(7, [1.0, 1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (500, None), (501, [1.0, None, 2.0]), (502, [float("nan"), 0.0, 0.0])]
    rows += [(503, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = blockmax.top_k(frame, frame.where("vec_id % 100 = 0"), k=5).collect()
    usable = [(i, [int(x * 1024) for x in v]) for i, v in rows if i is not None and i < 500]
    wanted = []
    for q, v in usable:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q)[:5]
            wanted += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(wanted)


def test_negative_and_repeated_ids_and_other_columns(spark):
    """A negative id is an id like any other; a query id with several vectors is asked with the smallest."""
    rng = random.Random(3)
    rows = [(i - 150, [float(rng.randrange(-9, 10)) for _ in range(70)], "clash", 1.5) for i in range(300)]
    rows += [(100, [9.0] * 70, "clash", 0.0), (-5, [9.0] * 70, "clash", 0.0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, query_id string, score double").repartition(5)
    got = blockmax.top_k(frame, frame.where("vec_id % 100 = 0"), k=7).collect()
    wanted = []
    for q in (-100, 0, 100):
        v = min(e for i, e, *_ in rows if i == q)
        best = sorted((-int(sum(a * b for a, b in zip(v, w, strict=True))) * 1024 * 1024, i) for i, w, *_ in rows if i != q)[:7]
        wanted += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(wanted) and any(r.vec_id < 0 for r in got)


def test_fewer_candidates_and_empty_tables(spark):
    frame = spark.createDataFrame([(0, [1.0, -1.0]), (1, [2.0, 0.5]), (2, [1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in blockmax.top_k(frame, frame.where("vec_id = 0")).collect()] == [(0, 1, 1, 1024 * 2048 - 1024 * 512)]
    assert blockmax.top_k(frame.limit(0), frame).count() == 0
    assert blockmax.top_k(frame, frame.limit(0)).count() == 0


def test_blocks_are_pruned_without_loss():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 900, (40, 16))
    values = (centres[rng.integers(0, 40, 4096)] + rng.normal(0, 60, (4096, 16))).astype(np.int64)
    best = blockmax.Best(np.arange(20), values[:20], 10)
    made = best.search(np.arange(4096), values)
    scores = values[:20] @ values.T
    scores[np.arange(20), np.arange(20)] = blockmax.LOW
    assert (best.scores == -np.sort(-scores, axis=1)[:, :10]).all()
    assert made < 0.5 * 20 * 4096
    again = blockmax.Best(np.arange(20), values[:20], 10)
    for part in np.array_split(np.arange(4096), 5):
        again.search(part, values[part])
    assert (again.found == best.found).all()


def test_large_numbers_stay_exact():
    a = np.array([[2**30, 3]], np.int64)
    assert blockmax.product(a, a)[0, 0] == 2**60 + 9
