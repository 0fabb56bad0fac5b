import hashlib
import random

import pytest
from pyspark.sql import functions as F

from matchbook.llm import linededup, queries
from tests.compare import connect, differences

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(rows, least=10):
    """(lines, dropped positions, kept text) of each (id, text); ids that are null are one document after all."""
    order = lambda i: (i is None, i or 0)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key_of(line), set()).add(i)
    first = {k: min(v, key=order) for k, v in holders.items() if len(k) >= least}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        lost = [p for p, line in enumerate(lines) if key_of(line) in first and first[key_of(line)] != i]
        out.append((len(lines), lost, "\n".join(x for p, x in enumerate(lines) if p not in set(lost))))
    return out


def bitmap(edges):
    return [p for a, b in zip(edges[1:-1:2], edges[2::2], strict=True) for p in range(a, b)]


def check(frame, rows, **options):
    found = linededup.with_bitmaps(frame, **options).withColumn("kept", linededup.kept_text()).collect()
    got = sorted((str(r.doc_id), r.text or "", r.n_lines, bitmap(r.keep_edges), r.kept) for r in found)
    assert got == sorted((str(i), t or "", n, lost, kept) for (i, t), (n, lost, kept) in zip(rows, plain(rows), strict=True))
    assert all(r.n_dropped == len(bitmap(r.keep_edges)) and r.keep_edges[-1] == r.n_lines for r in found)


def test_query_against_sql(spark, folder):
    for path in (folder, "/root/testdata/sf0.01"):
        found = differences(queries.op13_line_dedup(spark, path), connect(path), queries.REGISTRY.oracle_sql()["op13_line_dedup"])
        assert found is None


def made(seed):
    rng = random.Random(seed)
    lines = ["a line that many hold", "  A LINE that many hold\t", "short", "another common line", "", "ünïcode lines count", "exactly10!", "only nine", "x" * 5000]
    rows = []
    for i in range(120):
        text = "\n".join(rng.choice([*lines, f"own line of document {i}"]) for _ in range(rng.choice([1, 3, 40])))
        rows.append((rng.choice([i, i, i, 7, None]), text))
    return rows + [rows[3], rows[3], (5, None), (6, ""), (None, None), (None, "a line that many hold"), (7, "a line that many hold\r\n")]


@pytest.mark.parametrize("hot", [3, 1000])
def test_against_brute_force(spark, hot):
    """Repeated, missing and shared ids; with a low limit every common line is summed up before the shuffle."""
    rows = made(hot)
    frame = spark.createDataFrame([(*r, "clash", 9) for r in rows], "doc_id long, text string, keep_edges string, n_lines int")
    check(frame.repartition(5), rows, least_rows=hot)


def test_odd_and_empty_tables(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check(odd, rows)
    assert linededup.deduplicated(odd).columns == odd.columns and linededup.deduplicated(odd).count() == odd.count()
    assert linededup.with_bitmaps(nothing).count() == linededup.deduplicated(nothing).count() == 0


def test_a_document_of_many_lines(spark):
    """Half of 200,000 lines go, every second one: as many runs as lines, in one pass."""
    common = [f"this line is common {k}" for k in range(100_000)]
    text = "\n".join(f"{c}\nthis line is its own {k}" for k, c in enumerate(common))
    frame = spark.createDataFrame([(2, text), (1, "\n".join(common))], "doc_id long, text string")
    got = {r.doc_id: r for r in linededup.deduplicated(frame).collect()}
    assert got[2].text == "\n".join(f"this line is its own {k}" for k in range(100_000)) and got[1].text == "\n".join(common)


def test_hot_keys_are_found(spark):
    rows = [(i, "one very common line\n" + "\n".join(f"line {k} of {i} here" for k in range(3))) for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keys = linededup.line_keys(frame)
    hot = linededup.hot_keys(keys).collect()
    assert [(r.first) for r in hot] == [0] and keys.count() == 8000
    lost = linededup.dropped_lines(keys).groupBy().agg(F.count("*"), F.max("pos")).first()
    assert tuple(lost) == (1999, 0)


def test_no_exchange_between_ranges_and_window(spark):
    keys = linededup.line_keys(spark.createDataFrame([(1, "x" * 20)], "doc_id long, text string"))
    plan = linededup.dropped_lines(keys)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h" in plan and "hashpartitioning(h" not in plan.split("rangepartitioning(h")[0]
    assert "Python" not in plan and "Arrow" not in plan and "mapIn" not in plan


def test_digest_of_an_emptied_text(spark):
    frame = spark.createDataFrame([(1, "the same line"), (2, "the same line")], "doc_id long, text string")
    got = {r.doc_id: r.t for r in linededup.with_bitmaps(frame).select("doc_id", queries.sha256(linededup.kept_text()).alias("t")).collect()}
    assert got[2] == hashlib.sha256(b"").hexdigest()
