"""Tables in buckets of whole files: the same rows, and what meets by file is not shuffled or sent to the driver."""

import pytest

from matchbook.operators import quality
from matchbook.plans import checks, entities, staging
from matchbook.plans import reports as reports_of
from matchbook.plans.build import TABLES, VIEWS, Scorecards
from matchbook.streaming.live import LiveTables
from tests.fixture_match import MATCH


def reports(spark):
    rows = [("\n".join(MATCH), f"match-{i}.txt") for i in range(7)]
    return spark.createDataFrame(rows, "value string, source_file_name string").selectExpr(
        "*", "timestamp_ntz'2026-09-01 03:00:00' as loaded_at"
    )


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    plain = Scorecards(spark, str(tmp_path_factory.mktemp("plain")), files=reports(spark)).build()
    return plain, Scorecards(spark, str(tmp_path_factory.mktemp("by_file")), files=reports(spark), buckets=3).build()


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def rows(frame):
    return sorted(map(repr, frame.collect()))


def test_buckets_give_the_same_rows(both):
    plain, bucketed = both
    for table in TABLES:
        assert rows(getattr(bucketed, table)) == rows(getattr(plain, table)), table


@pytest.mark.parametrize(
    "table", ["int_batting_rows", "int_bowling_rows", "int_fow_rows", "int_partnerships", "fact_batting", "fact_bowling", "fact_fow"]
)
def test_what_meets_by_file_is_not_shuffled(both, table):
    assert "Exchange hashpartitioning" not in plan(both[1].frame(table))


def test_a_summary_is_shuffled_once_by_match(both):
    found = plan(both[1].frame("fact_player_match_summary"))
    assert "BroadcastExchange" not in found and found.count("REPARTITION_BY_NUM") == 1


def test_credits_meet_their_side_without_a_shuffle(both):
    assert "Exchange hashpartitioning" not in plan(both[1].frame("int_fielding_dismissals"))


@pytest.mark.parametrize("report", [reports_of.top_performers, reports_of.match_factors])
def test_reports_by_match_are_not_shuffled(both, report):
    assert "Exchange hashpartitioning" not in plan(report(both[1]))
    assert rows(report(both[1])) == rows(report(both[0]))


def test_reports_of_players_give_the_same_rows(both):
    for report in (reports_of.running_factor, reports_of.player_profile):
        assert rows(report(both[1])) == rows(report(both[0]))


def test_checks_give_the_same_failures(both):
    found = [rows(quality.report(checks.all_checks(cards))) for cards in both]
    assert found[0] == found[1]


def test_credits_of_files_with_many_rows_are_sorted(both, monkeypatch):
    expected = rows(both[0].int_fielding_dismissals)
    monkeypatch.setattr(entities, "LISTED_ROWS", 1)
    assert rows(both[1].frame("int_fielding_dismissals")) == expected


def test_matches_are_not_broadcast_to_facts(both):
    for cards in both:
        for table in ("int_batting_rows", "int_bowling_rows", "int_fow_rows", "int_partnerships"):
            assert "BroadcastExchange" not in plan(cards.frame(table)), table


def test_live_batches_in_buckets(spark, both, tmp_path):
    tables, known = LiveTables(spark, str(tmp_path)), len(spark.catalog.listTables())
    tables.apply(None, "one", files=reports(spark), buckets=3)
    live = tables.refresh()
    for table in [t for t in TABLES if t not in VIEWS]:
        assert rows(getattr(live, table)) == rows(getattr(both[0], table)), table
    assert len(spark.catalog.listTables()) == known


def test_a_task_reads_a_bucket(both):
    assert both[1].int_batting_rows.rdd.getNumPartitions() == 3


@pytest.mark.parametrize("buckets", [None, 3])
def test_lines_lost_on_the_way_are_found(spark, tmp_path, monkeypatch, buckets):
    """The raw lines are numbered from the input, so the checks of a build and of a live batch see what is missing."""
    cut = staging.file_blocks
    lost = "source_file_name = 'match-1.txt' OR (source_file_name = 'match-2.txt' AND source_file_row_number = 7)"
    monkeypatch.setattr(staging, "file_blocks", lambda files: cut(files).where(f"NOT ({lost})"))
    cards = Scorecards(spark, str(tmp_path / "cards"), files=reports(spark), buckets=buckets).build()
    faults = LiveTables(spark, str(tmp_path / "live")).apply(None, "one", files=reports(spark), buckets=buckets)
    for found in (quality.report(checks.all_checks(cards)).collect(), faults):
        failures = {(r["check"], r["table_name"]): r["failures"] for r in found}
        assert failures["same_row_count", "stg_blocks"] == failures["same_row_count", "stg_row_classification"] == 2
        assert failures["files_lost", "dim_match"] == 1


def test_a_summary_adds_its_sources_up_where_they_lie(both):
    """One aggregate over the stacked sources: they are neither sorted nor shuffled, and nothing else is joined per source."""
    found = plan(both[1].frame("fact_player_match_summary"))
    assert "SortMergeJoin" not in found and "Exchange hashpartitioning" in found and found.count("Exchange hashpartitioning") == 1
    assert found.count("Union") == 2 and found.count("ShuffledHashJoin") == 3


@pytest.mark.parametrize("table", ["fact_batting", "fact_bowling", "int_batting_rows", "int_fielding_dismissals"])
def test_rows_of_a_bucket_meet_without_a_sort(both, table):
    assert "SortMergeJoin" in plan(both[0].frame(table)) and "SortMergeJoin" not in plan(both[1].frame(table))


def test_what_files_add_up_to_is_counted_in_one_pass(both):
    found = [c for c in checks.table_checks(both[1]) if c.shared]
    assert len(found) == 8 and plan(quality.report(found)).count("Exchange SinglePartition") == 1


def test_rows_without_a_group_stay_apart(spark):
    lines = spark.createDataFrame([(None, 1), ("a", 1), ("a", 2**40), ("b", 3)], "f string, n long")
    sides = quality.numbered(lines, "f", "n", "one"), quality.numbered(lines.where("n <> 3"), "f", "n", "two")
    counted = quality.side_by_side("f", *sides)
    assert counted.count() == 4  # a, b, and one row without a group for each side
    pairwise = quality.same_row_count(lines, lines.where("n <> 3"), "t", "f", "n")
    shared = quality.same_rows_counted(counted, "one", "two", "t", "n")
    assert pairwise.failures.count() == shared.failures.count() == 3
