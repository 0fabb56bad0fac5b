"""Operators against plain Python, with groups cut into small chunks."""

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from matchbook.functions import measures, text
from matchbook.operators.chunks import chunk_groups, chunk_numbered
from matchbook.bindings import orders
from matchbook.operators.resolve import resolve_listed, resolve_suffixes
from matchbook.operators.scan import ordered_scan, scan_groups
from matchbook.operators.segment import segment_blocks
from matchbook.operators.series import gap_series
from matchbook.operators.stands import collapses, cumulative_deltas


@pytest.fixture(scope="module")
def events(spark):
    """One group with most rows, some small ones; positions repeat and are uneven."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        group = "hot" if rng.random() < 0.7 else f"g{rng.randrange(5)}"
        rows.append((group, rng.randrange(30) ** 2, i, rng.randrange(-5, 40), rng.random() < 0.15))
    return rows, spark.createDataFrame(rows, "g string, t long, id long, v long, mark boolean").repartition(5)


def grouped(rows):
    out = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        out[row[0]].append(row)
    return out


@pytest.mark.parametrize("size", [None, 9])
def test_scan_with_unknown_and_equal_positions(spark, size):
    rows = [("a", None if i % 5 == 0 else i // 4, i, i % 7) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, t long, id long, v long").repartition(3)
    got = scan_groups(df, ["g"], ["t", "id"], size, number="n", sums={"s": "v"}, lags={"p": "id"}, firsts={"f": "id"})
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    want, total = [], 0
    for n, r in enumerate(order, 1):
        total += r[3]
        want.append((r[2], n, total, order[n - 2][2] if n > 1 else None, order[0][2]))
    assert sorted((r.id, r.n, r.s, r.p, r.f) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("size", [None, 5, 40])
def test_scan(events, size):
    rows, df = events
    got = scan_groups(
        df, ["g"], ["t", "id"], size,
        number="n", sums={"s": "v"}, lags={"before": "v"}, firsts={"start": "id"},
    ).collect()
    want = {}
    for members in grouped(rows).values():
        total, before = 0, None
        for n, (g, t, i, v, m) in enumerate(members, 1):
            total += v
            want[i] = (n, total, before, members[0][2])
            before = v
    assert {r.id: (r.n, r.s, r.before, r.start) for r in got} == want


@pytest.mark.parametrize("size", [None, 5, 40])
def test_segments(events, size):
    rows, df = events
    cut = segment_blocks(
        chunk_groups(df, ["g"], ["t", "id"], size), ["g"], ["t", "id"], "mark", {"big": F.col("v") > 35}
    ).collect()
    want = {}
    for members in grouped(rows).values():
        block, blocks = 0, []
        for row in members:
            block += row[4]
            blocks.append(block)
        content = [b for b, r in zip(blocks, members) if not r[4]]
        big = {b for b, r in zip(blocks, members) if r[3] > 35}
        for b, r in zip(blocks, members):
            want[r[2]] = (b, min(content), max(content), b in big)
    assert {r.id: (r.block_id, r.first_content, r.last_content, r.big) for r in cut} == want


@pytest.mark.parametrize("size", [None, 12])
def test_gap_series(spark, size):
    rng = random.Random(3)
    rows = [("a" if rng.random() < 0.8 else "b", date(2026, 1, 1) + timedelta(rng.randrange(900)), i) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, d date, id long")
    got = {
        r.id: (r.series_no, r.series_position, r.series_size, r.opened)
        for r in gap_series(df, ["k"], "d", "id", 10, firsts={"opened": "id"}, pieces=size).collect()
    }
    want = {}
    for k in ("a", "b"):
        series, last = [], None
        for _, d, i in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])):
            if last is None or (d - last).days > 10:
                series.append([])
            series[-1].append(i)
            last = d
        for no, ids in enumerate(series, 1):
            for position, i in enumerate(ids, 1):
                want[i] = (no, position, len(ids), ids[0])
    assert got == want


@pytest.mark.parametrize("size", [3, 1000])
def test_deltas_and_collapses(spark, size):
    scores, total = [], 0
    rng = random.Random(1)
    for n in range(1, 80):
        total += rng.choice([0, 3, 20, 60])
        scores.append(("x", n, total))
    df = spark.createDataFrame(scores, "k string, n long, score long")
    deltas = cumulative_deltas(df, ["k"], "n", "score", "d", size).orderBy("n").collect()
    assert sum(r.d for r in deltas) == total
    assert [r.d for r in deltas] == [s - p for (_, _, s), p in zip(scores, [0] + [s for _, _, s in scores])]
    at = [0] + [s for _, _, s in scores]
    spells = []
    for start in range(len(at) - 3):
        if at[start + 3] - at[start] < 30:
            if spells and start - spells[-1][1] < 3:
                spells[-1][1] = start
            else:
                spells.append([start, start])
    want = sorted((a + 1, b + 3, at[a], at[b + 3]) for a, b in spells)
    got = collapses(df, ["k"], "n", "score", 3, 30, size).collect()
    assert sorted((r.first_fall, r.last_fall, r.score_before, r.score_after) for r in got) == want


def test_chunks_are_bounded(events, spark):
    _, df = events
    chunked = chunk_groups(df, ["g"], ["t", "id"], 16)
    assert max(r["count"] for r in chunked.groupBy("g", "_chunk").count().collect()) <= 2 * 400 / 16
    # One early outlier and equal positions do not undo the cut.
    flat = spark.range(10_000).selectExpr("'x' g", "if(id = 0, 0, 9000000) t", "id")
    uneven = chunk_groups(flat, ["g"], ["t", "id"], 20)
    assert max(r["count"] for r in uneven.groupBy("_chunk").count().collect()) <= 1000
    numbered = chunk_numbered(df.select(F.lit("f").alias("f"), "id"), ["f"], "id", 100)
    assert numbered.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 101


@pytest.mark.parametrize("pieces", [None, 5])
def test_suffix_resolution_matches_brute_force(spark, pieces):
    names = [("n", "A Stone"), ("n", "B Stone"), ("n", "R Vasconcelos"), ("m", "C Stone"), ("n", "A Stone"), ("n", "O'Box")]
    names += [("n", "a Case"), ("n", "A Case"), ("n", None), (None, "N Oone"), ("n", "É Émile"), ("n", "Z\U0010ffffxy")]
    asked = [("n", " stone"), ("n", "oncelos"), ("m", " Stone"), ("m", "oncelos"), ("n", None), ("n", "box"), ("n", "a stone")]
    asked += [("n", "case"), ("n", ""), (None, "one"), ("n", "émile"), ("n", "xy"), ("n", "y"), ("none", "stone"), ("n", "e")]
    roster = spark.createDataFrame(names, "k string, name string")
    rows = [(i, k, f, g) for i, ((k, f), (_, g)) in enumerate(zip(asked, asked[::-1]))]
    asks = spark.createDataFrame(rows + rows[:2], "id long, k string, f string, g string")
    both = {"found": (F.col("f"), "hits"), "other": (F.col("g"), "others")}
    got = resolve_suffixes(asks, roster, ["k"], "name", both, pieces=pieces)
    assert got.columns == ["id", "k", "f", "g", "found", "hits", "other", "others"]

    def plain(k, f):
        hits = {n for kk, n in names if k is not None and kk == k and n and f and n.lower().endswith(f.lower())}
        return next(iter(hits)) if len(hits) == 1 else None, len(hits)

    expected = [(*r, *plain(r[1], r[2]), *plain(r[1], r[3])) for r in rows + rows[:2]]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_names_in_a_list_resolve_as_sorted_ones(spark):
    names = [("n", "A Stone"), ("n", "B Stone"), ("n", "R Vasconcelos"), ("m", "C Stone"), ("n", "A Stone"), ("n", "a Case")]
    names += [("n", "A Case"), ("n", None), (None, "N Oone"), ("n", "É Émile"), ("n", "Z\U0010ffffxy")]
    asked = [(" stone", "n"), ("oncelos", "n"), (" Stone", "m"), (None, "n"), ("", "n"), ("case", "n"), ("émile", "n"), ("XY", "n"), ("e", "o")]
    asks = spark.createDataFrame([*asked, *asked[:2], ("one", None)], "f string, k string")
    roster = spark.createDataFrame(names, "k string, name string")
    by = {"found": (F.col("f"), "hits"), "again": (F.upper("f"), "times")}
    lists = roster.groupBy("k").agg(F.collect_list("name").alias("l"))
    listed = resolve_listed(asks.join(lists, "k", "left"), F.coalesce("l", F.array().cast("array<string>")), by).drop("l")
    swept = resolve_suffixes(asks, roster, ["k"], "name", by).select(*listed.columns)
    assert listed.schema.simpleString() == swept.schema.simpleString()
    assert sorted(map(str, listed.collect())) == sorted(map(str, swept.collect()))


def test_only_large_groups_are_cut(spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small pieces would be merged
    monkeypatch.setattr("matchbook.operators.chunks.LISTED", 0)  # as if too many to broadcast
    rows = [(g, i) for g, n in (("a", 400), ("b", 30), (None, 300), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, id long")
    cut = chunk_groups(df, ["g"], ["id"], max_rows=200)
    whole = {r.g: r.n for r in cut.where("_chunk = -1").groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert whole == {"b": 30, "c": 1, None: 300}
    assert cut.groupBy("g").agg(F.countDistinct("_chunk").alias("n")).where("g = 'a'").first().n > 1
    assert chunk_groups(df, ["g"], ["id"]).select("_chunk").distinct().collect() == [(-1,)]
    got = ordered_scan(cut, ["g"], ["id"], number="n", sums={"s": "id"}, lasts={"l": F.when(F.col("id") % 150 == 7, F.col("id"))})
    for r in got.collect():
        latest = [i for i in range(r.id + 1) if i % 150 == 7]
        assert (r.n, r.s, r.l) == (r.id + 1, r.id * (r.id + 1) // 2, latest[-1] if latest else None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_numbers(spark):
    balls = spark.createDataFrame([(20,), (79,), (0,)], "b long")
    overs = [float(r[0]) for r in balls.select(measures.balls_to_overs("b")).collect()]
    assert overs == [3.2, 13.1, 0.0]
    back = balls.select(measures.overs_to_balls(measures.balls_to_overs("b"))).collect()
    assert [r[0] for r in back] == [20, 79, 0]
    lit = F.lit
    assert one(spark, measures.blended_factor(lit(12.0), lit(3), lit(0), lit(3)))[0] == pytest.approx(4.0)
    assert one(spark, measures.percent(lit(1), lit(3)), measures.percent(lit(1), lit(0))) == (33.33, None)
    assert one(spark, measures.ratio(lit(1), lit(0)))[0] is None
    assert one(spark, measures.pooled_bowling(lit(10), lit(0), lit(10), lit(2)))[0] is None


def test_text(spark):
    lit = F.lit
    got = one(
        spark,
        text.to_int(lit("7.4")), text.to_int(lit("7.5")), text.to_int(lit("x")), text.to_int(lit("")),
        text.rx(lit("abc"), "z(.)"), text.dash_zero(lit("-")), text.part(lit("a b"), " ", 3),
    )
    assert got == (7, 8, None, None, None, 0, "")
    keys = one(spark, text.surrogate_key(lit("a"), lit(None).cast("string")), F.md5(lit("a-_dbt_utils_surrogate_key_null_")))
    assert keys[0] == keys[1]


@pytest.mark.parametrize("size", [None, 12])
def test_sums_inside_a_series(spark, size):
    days = [0, 5, 9, 60, 61, 200, 202, 204, 206]
    rows = [("a", date(2026, 1, 1) + timedelta(d), i, i + 1) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "k string, d date, id long, v long")
    got = gap_series(df, ["k"], "d", "id", 30, sums={"so_far": F.col("v")}, pieces=size).collect()
    assert {r.id: r.so_far for r in got} == {0: 1, 1: 3, 2: 6, 3: 4, 4: 9, 5: 6, 6: 13, 7: 21, 8: 30}


def test_supplier_factors_are_dealt_once_to_as_many_tasks_as_lines_ask_for(spark, tmp_path, monkeypatch):
    lines = spark.range(900).selectExpr(
        "id % 90 l_orderkey", "id % 7 l_suppkey", "id % 5 l_quantity", "id / 4 l_extendedprice", "if(id % 3 = 0, 'R', 'N') l_returnflag"
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    expected = sorted(map(str, orders.factor_blended(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(orders, "FACTOR_ROWS", 30)
    found = orders.factor_blended(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 30
    assert sorted(map(str, found.collect())) == expected
