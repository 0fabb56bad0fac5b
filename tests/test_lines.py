"""Text files become numbered lines once, whatever their size, line ending or arrival."""

import os
import random
import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from matchbook.bindings import texts
from matchbook.operators.arrays import segment_array
from matchbook.operators.segment import segment_blocks
from matchbook.plans import staging
from matchbook.plans.build import LINES, RAW, Scorecards
from matchbook.sources.lines import large_files, lines_of, read_files, read_lines, scan_text
from matchbook.streaming.ingest import ingest, raw_table
from matchbook.streaming.live import run_live
from tests.fixture_match import MATCH, raw_lines


@pytest.fixture()
def folder(tmp_path):
    source = tmp_path / "in dir"
    (source / "sub + more").mkdir(parents=True)
    rng = random.Random(5)
    long = ["x" * rng.randrange(40) for _ in range(900)] + ["", "  end  "]
    want = {"unix.txt": MATCH, "win.txt": MATCH, "tail.txt": ["a", "", ""], "sub + more/1 May (1st).txt": ["b", " "], "long.txt": long}
    for name, lines in want.items():
        ending = "\r\n" if name == "win.txt" else "\n"
        last = "" if name == "unix.txt" else ending
        (source / name).write_bytes((ending.join(lines) + last).encode())
    (source / "empty.txt").write_bytes(b"")
    (source / "other.csv").write_bytes(b"no")
    return source, want


def test_lines_of_tries_no_pattern(spark):
    rng = random.Random(8)
    parts = ["\r", "\n", "\r\n", "a", " ", "é", "\u2028", "\x0b", ""]
    texts = ["", "\n", "\r", "\r\n", "\n\r", "\r\r\n", "a\n\n", "a\r\r", None]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    cut = spark.createDataFrame([(t,) for t in texts], "t string").select("t", lines_of("t").alias("lines"))
    for row in cut.collect():
        one_ending = None if row.t is None else re.sub(r"\r\n|\r", "\n", row.t)
        assert row.lines == (None if row.t is None else re.sub(r"\n\Z", "", one_ending).split("\n")), repr(row.t)
    broken = spark.sql(r"SELECT cast(x'61C20A' AS string) AS t").select(F.to_json(lines_of("t")).alias("j")).first().j
    assert broken == '["a\ufffd"]'
    assert "rlike" not in str(lines_of("t")).lower() and "regexp" not in str(lines_of("t")).lower()


def as_files(df):
    out = {}
    for r in df.orderBy("source_file_name", "source_file_row_number").collect():
        out.setdefault(r.source_file_name, []).append((r.source_file_row_number, r.raw_line))
    return out


@pytest.mark.parametrize("whole_file_bytes", [10**9, 2000, 0])
def test_read_lines(spark, folder, whole_file_bytes):
    source, want = folder
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        got = as_files(read_lines(spark, str(source), whole_file_bytes))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {name: list(enumerate(lines, 1)) for name, lines in want.items()}


def test_text_of_large_files_is_read_once(spark, folder, tmp_path):
    """What is returned reads the stored lines and offsets, without a shuffle, and stays the same when files change."""
    source, want = folder
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        lines = large_files(scan_text(spark.read, str(source), False), 1000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and plan.count("FileScan parquet") == 2
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    big = {name: rows for name, rows in want.items() if (source / name).stat().st_size > 1000}
    assert "long.txt" in big and "tail.txt" not in big
    (source / "long.txt").unlink()
    for _ in range(2):
        assert as_files(lines) == {name: list(enumerate(rows, 1)) for name, rows in big.items()}
    none = large_files(scan_text(spark.read, str(source), False), 10**9)
    assert none.collect() == [] and none.dtypes == lines.dtypes


def test_files_load_once(spark, folder, tmp_path):
    source, want = folder
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    ingest(spark, str(source), raw, state, whole_file_bytes=3000)
    first = raw_table(spark, raw).count()
    assert first == sum(map(len, want.values()))
    ingest(spark, str(source), raw, state, whole_file_bytes=3000)
    assert raw_table(spark, raw).count() == first
    (source / "late.txt").write_text("late\n")
    ingest(spark, str(source), raw, state, whole_file_bytes=3000)
    assert raw_table(spark, raw).count() == first + 1
    assert raw_table(spark, raw).where("loaded_at is null").count() == 0


def test_old_files_load_too(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    places = str(source), str(tmp_path / "raw"), str(tmp_path / "state")
    (source / "a.txt").write_text("a\n")
    ingest(spark, *places)
    for name, age in (("new.txt", 0), ("old.txt", 30 * 86400)):
        (source / name).write_text(f"{name}\n")
        os.utime(source / name, (time.time() - age,) * 2)
    ingest(spark, *places)
    assert sorted(r.raw_line for r in raw_table(spark, places[1]).collect()) == ["a", "new.txt", "old.txt"]


@pytest.mark.parametrize("whole_file_bytes", [10**9, 0])
def test_byte_order_mark_and_patterns(spark, tmp_path, whole_file_bytes):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.txt").write_bytes("\ufeffhome\naway\n".encode())
    for path, name in ((tmp_path, "sub/a.txt"), (tmp_path / "sub" / "*.txt", "a.txt"), (f"{tmp_path}/s*", "sub/a.txt"), (tmp_path / "sub" / "a.txt", "a.txt")):
        assert as_files(read_lines(spark, str(path), whole_file_bytes)) == {name: [(1, "home"), (2, "away")]}


def test_live_tables_equal_a_full_build(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    second = [line.replace("English FC League - D1 - 1 May", "2nd Test Match (of 3) - 20 May") for line in MATCH]
    third = [line.replace("English FC League - D1 - 1 May", "1st Test Match (of 3) - 2 May") for line in MATCH]
    files = {"a.txt": MATCH, "b.txt": second, "c.txt": third}
    places = [str(tmp_path / p) for p in ("raw", "tables", "state")]
    for names in (["a.txt", "b.txt"], ["c.txt"]):
        for name in names:
            (source / name).write_text("\n".join(files[name]))
        live = run_live(spark, str(source), *places)
    full = Scorecards(spark, str(tmp_path / "full"), raw_lines(spark, files))
    for table in ("dim_match", "dim_player", "fact_batting", "fact_partnership", "fact_player_match_summary"):
        assert sorted(map(str, getattr(live, table).collect())) == sorted(map(str, full.stored(table).collect()))
    tests = live.dim_match.where("series_id is not null").orderBy("match_date").collect()
    assert [t.series_match_number for t in tests] == [1, 2] and tests[0].series_scheduled_matches == 3


def odd_files():
    rng = random.Random(9)
    stars = "*" * 9
    files = {"match.txt": MATCH, "marker.txt": [stars], "two.txt": [stars, stars], "plain.txt": ["a"], "blank.txt": [""]}
    files |= {"first.txt": [stars, "a", "b"], "last.txt": ["a", stars], "gap.txt": ["a", stars, stars, "b", " ** ", " **** "]}
    for i in range(30):
        files[f"random{i}.txt"] = [rng.choice([*MATCH, stars, " ***** ", ""]) for _ in range(rng.choice([3, 60, 400]))]
    return files


def text_files(spark, files):
    rows = [("\n".join(lines) + "\n", name) for name, lines in files.items()]
    return spark.createDataFrame(rows, "value string, source_file_name string").withColumn("loaded_at", F.lit(datetime(2026, 9, 1)).cast("timestamp_ntz"))


def test_whole_files_give_the_rows_of_the_windows(spark):
    """Cut as arrays where they are read, or by windows: the same blocks, types and roles, and no exchange for arrays."""
    files = odd_files()
    whole = text_files(spark, files)
    by_array = staging.classified(staging.file_blocks(whole))
    columns = by_array.columns
    by_window = staging.classified(staging.blocks(raw_lines(spark, files))).select(*columns)
    assert sorted(map(str, by_array.collect())) == sorted(map(str, by_window.collect()))
    assert "Exchange" not in by_array._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, staging.file_lines(whole).collect())) == sorted(map(str, raw_lines(spark, files).collect()))


def test_segment_array_on_any_items(spark):
    """Numbers cut at multiples of five, nulls among them, against the operator that uses windows."""
    rng = random.Random(4)
    rows = [(g, [rng.choice([None, *range(1, 12)]) for _ in range(n)]) for g, n in enumerate([0, 1, 2, 50, 3000])]
    arrays = spark.createDataFrame(rows, "g int, items array<int>")
    cut = segment_array(F.col("items"), lambda x: x % 5 == 0, {"seven": lambda x: x == 7})
    got = arrays.select("g", F.explode(cut).alias("b")).select("g", "b.*").select("*", F.posexplode("items").alias("at", "x"))
    got = got.select("g", (F.col("start") + F.col("at")).alias("i"), "x", "block_id", "first_content", "last_content", "seven")
    lines = arrays.select("g", F.posexplode("items").alias("i", "x")).withColumn("_chunk", F.lit(-1).cast("long"))
    lines = lines.withColumn("marker", F.coalesce(F.col("x") % 5 == 0, F.lit(False)))
    want = segment_blocks(lines, ["g"], ["i"], "marker", {"seven": F.col("x") == 7})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())) and got.count() == 3053


def test_a_large_array_is_cut_in_one_pass(spark):
    n = 400_000
    cut = segment_array(F.expr(f"transform(sequence(1, {n}), x -> x % 2)"), lambda x: x == 0, {})
    started = time.time()
    sizes = spark.range(1).select(F.explode(cut).alias("b")).agg(F.count("*"), F.sum(F.size("b.items"))).first()
    assert tuple(sizes) == (n // 2 + 1, n) and time.time() - started < 60


def test_a_folder_of_small_and_large_files(spark, folder, tmp_path):
    source, want = folder
    cards = Scorecards.of_folder(spark, str(tmp_path / "cards"), str(source), whole_file_bytes=2000)
    assert as_files(cards.frame(RAW)) == {name: list(enumerate(lines, 1)) for name, lines in want.items()}
    small, large = read_files(spark, str(source), 2000)
    assert small.count() and large.count()
    only = Scorecards(spark, str(tmp_path / "only"), read_lines(spark, str(source), 0))
    drop = "loaded_at"
    assert sorted(map(str, cards.stored(LINES).drop(drop).collect())) == sorted(map(str, only.stored(LINES).drop(drop).collect()))


def test_a_source_is_one_numbered_file(spark, tmp_path):
    """However far apart its documents lie, the lines of a source are numbered as one sequence."""
    rows = [(i * 700, f"a{i}\nb{i}", "en", "one" if i % 2 else "two") for i in range(8)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = texts.ingest_lines(spark, str(tmp_path))
    assert got.columns == ["source", "lines", "characters", "last_row", "in_order", "loaded_twice"]
    assert sorted(tuple(r) for r in got.collect()) == [(s, 8, 16, 8, 2 * 36, False) for s in ("one", "two")]
