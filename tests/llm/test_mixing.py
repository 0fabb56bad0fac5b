import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from matchbook.llm import mixing, queries
from tests.compare import connect, differences


def test_query_against_sql(spark, folder):
    for path in (folder, "/root/testdata/sf0.01"):
        found = differences(queries.op10_mixing(spark, path), connect(path), queries.REGISTRY.oracle_sql()["op10_mixing"])
        assert found is None


def plain_targets(sizes, weights, epochs=3):
    """Words by source in order, and weights; the excess is shared again until none is above its cap."""
    total, free, out = sum(sizes), set(range(len(sizes))), {}
    while free:
        level = (total - sum(out.values())) / sum(weights[i] for i in free)
        over = {i for i in free if level * weights[i] > epochs * sizes[i]}
        if not over:
            return [out.get(i, level * weights[i]) for i in range(len(sizes))]
        out |= {i: epochs * sizes[i] for i in over}
        free -= over
    return [out[i] for i in range(len(sizes))]


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_caps(spark, seed):
    rng = random.Random(seed)
    names = [f"s{i}" for i in range(7)] + ["é", None]
    rows = [(i, rng.choice(names) if rng.random() < 0.6 else "s0", " ".join("w" * rng.choice([1, 4, 90]))) for i in range(300)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)).collect()
    by = defaultdict(list)
    for r in found:
        by[r.source].append(r)
        assert r.size == len(r.text.split()) and 0 <= r.taken <= 3 * r.size
    order = sorted((s for s in by if s is not None), key=str.encode) + [s for s in by if s is None]
    sizes = [sum(r.size for r in by[s]) for s in order]
    wanted = plain_targets(sizes, [i % 3 + 1 for i in range(len(order))])
    for s, n, target in zip(order, sizes, wanted, strict=True):
        assert {r.source_size for r in by[s]} == {n} and by[s][0].target == pytest.approx(target)
        assert abs(sum(r.taken for r in by[s]) - target) <= 1


def test_reruns_agree_and_the_mix_has_the_words(spark):
    rows = [(i, f"s{i % 4}", " ".join(["word"] * (i % 11)) + "\n tail") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    once = sorted(mixing.mix(docs).select("doc_id", "taken").collect())
    assert once == sorted(mixing.mix(docs.repartition(2)).select("doc_id", "taken").collect())
    words = defaultdict(int)
    for r in mixing.mixed(docs).collect():
        words[r.doc_id] += len(r.text.split())
    assert {i: n for i, n in once if n} == dict(words)


def test_rows_without_ids_are_spread(spark):
    """No bucket of the order holds many of them, the target is still met to the word, and reruns agree."""
    rows = [(None if i % 3 else i, "s", f"word{i} " * (1 + i % 7)) for i in range(3000)] + [(None, "t", "x y")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    bucket = F.substring(mixing.order_of("doc_id", mixing.SEED, "text"), 1, 3)
    most = docs.where("source = 's'").groupBy(bucket.alias("b")).count().agg(F.max("count")).first()[0]
    assert most <= 10
    once = mixing.mix(docs).select("text", "size", "target", "taken", "source").collect()
    assert sorted(once) == sorted(mixing.mix(docs.repartition(3)).select("text", "size", "target", "taken", "source").collect())
    for source in "st":
        own = [r for r in once if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1 and all(r.taken <= 3 * r.size for r in own)


def test_odd_rows(odd, nothing):
    found = mixing.mix(odd)
    rows = found.collect()
    assert len(rows) == odd.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert all(r.size == 0 for r in rows if r.doc_id in (0, 1, 2))
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mix(nothing).count() == mixing.mixed(nothing).count() == 0
    empty = odd.where("doc_id < 3")  # no words at all
    assert [r.target for r in mixing.mix(empty).collect()] == [0.0] * 3


def test_ranks_over_many_sources(spark):
    rows = [(f"s{i:05d}",) for i in random.Random(1).sample(range(5000), 3000)] + [(None,)]
    got = mixing.ranked(spark.createDataFrame(rows, "name string").repartition(7), "name").collect()
    wanted = sorted(r[0] for r in rows if r[0]) + [None]
    assert {r.name: r["rank"] for r in got} == {n: i for i, n in enumerate(wanted)}
