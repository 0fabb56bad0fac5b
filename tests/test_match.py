"""The hand-made match from lines to marts."""

from decimal import Decimal

import pytest

from matchbook.operators import quality
from matchbook.plans import checks
from matchbook.plans.build import Scorecards
from matchbook.plans.metrics import metric
from tests.fixture_match import MATCH, raw_lines

FILE = "1 May 2026-Ald v Bir.txt"


def build(spark, folder, files, **kw):
    return Scorecards(spark, str(folder), raw_lines(spark, files), **kw)


@pytest.fixture(scope="module")
def cards(spark, tmp_path_factory):
    return build(spark, tmp_path_factory.mktemp("cards"), {FILE: MATCH})


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def by(df, key, value):
    return {r[0]: r[1] for r in df.select(key, value).collect()}


def test_lines_are_kept_and_classified(cards):
    lines = cards.stg_row_classification
    assert lines.count() == len(MATCH)
    kinds = {r[0]: r[1] for r in lines.groupBy("row_type").count().collect()}
    assert kinds[None] == 5 and kinds["batting_data"] == 17 and kinds["bowling_data"] == 4
    assert kinds["fow_data"] == 3 and kinds["result_data"] == 2 and kinds["match_header_data"] == 2


def test_header_and_result(cards):
    head = cards.int_match_header.first()
    assert (head.home_team, head.away_team, str(head.match_date)) == ("Alders", "Birches", "2026-05-01")
    assert (head.match_format, head.competition_name, head.competition_variant) == (
        "FC_LEAGUE",
        "English FC League",
        "D1",
    )
    won = cards.int_result.first()
    assert (won.result_type, won.winning_team, won.result_margin_type, won.result_margin_value) == (
        "WIN",
        "Alders",
        "INNINGS",
        52,
    )
    assert won.man_of_the_match == "A Ash"


def test_innings_and_batting(cards):
    assert rows(cards.int_innings_totals, "team", "total_runs", "wickets_lost", "overs_faced", "extras_total") == [
        ("Alders", 113, 6, Decimal("27.5"), 8),
        ("Birches", 61, 2, Decimal("15.1"), 3),
    ]
    batting = cards.int_batting_rows
    assert batting.where("did_not_bat").count() == 4
    assert batting.where("did_not_bat and runs is null and dismissal_type = 'DID_NOT_BAT'").count() == 4
    ash = batting.where("player_name = 'A Ash'").first()
    assert (ash.runs, ash.balls_faced, ash.fours, ash.sixes, ash.dismissal_type) == (40, 70, 5, 0, "CAUGHT")
    assert batting.where("player_name = 'U Vale'").first().dismissal_type == "RETIRED_HURT"


def test_stands_add_up(cards):
    stands = cards.int_partnerships.orderBy("match_innings_sequence", "partnership_number").collect()
    assert [(s.partnership_runs, s.is_unbroken) for s in stands] == [
        (20, False), (1, False), (0, False), (39, False), (20, False), (20, False), (13, True),
        (1, False), (39, False), (21, True),
    ]


def test_names_resolve_or_stay_open(cards):
    found = {r.batter_name: r for r in cards.int_fielding_dismissals.collect()}
    assert found["A Ash"].fielder_name == "R Vasconcelos" and found["A Ash"].bowler_name == "S Stone"
    own = found["C Elm"]
    assert own.caught_and_bowled and own.fielder_name == "S Stone" and own.fielder_match_count is None
    two = found["R Vasconcelos"]
    assert two.fielder_name is None and two.fielder_match_count == 2 and two.bowler_name == "C Elm"


def test_factors(cards):
    bat = by(cards.int_batting_match_factor, "player_name", "batting_match_factor")
    assert bat["A Ash"] == pytest.approx(2.051282, abs=1e-6)
    assert bat["D Fir"] == pytest.approx(1.653543, abs=1e-6)
    bowl = by(cards.int_bowling_match_factor, "player_name", "bowling_match_factor")
    assert bowl["S Stone"] == pytest.approx(1.241379, abs=1e-6)
    assert bowl["T Reed"] == pytest.approx(0.961957, abs=1e-6)
    assert bowl["C Elm"] == pytest.approx(1.4375) and bowl["H Pine"] is None


def test_pooled_bowling_over_one_match_is_the_match_factor(cards):
    pooled = by(
        metric(
            cards,
            ["fact_player_match_summary.pooled_bowling_match_factor"],
            by=["summary_players.player_name"],
        ),
        "player_name",
        "pooled_bowling_match_factor",
    )
    single = by(cards.int_bowling_match_factor, "player_name", "bowling_match_factor")
    for name, value in single.items():
        assert pooled[name] == (value if value is None else pytest.approx(value))


def test_own_and_peers_make_the_match(cards):
    totals = cards.int_batting_match_factor.selectExpr("own_runs + peer_runs as t").distinct().collect()
    assert len(totals) == 1


def test_all_checks_pass_or_only_warn(cards):
    report = quality.report(checks.all_checks(cards))
    failed = report.where("not passed and severity = 'error'").collect()
    assert failed == []


def test_errors_stop_and_warnings_are_listed(spark):
    df = spark.createDataFrame([(None, 1), ("x", 2)], "a string, b int")
    warned = quality.report([quality.not_null(df, "t", "a", severity="warn"), quality.unique(df, "t", "b")])
    assert [r.column_name for r in quality.enforce(warned).collect()] == ["a"]
    with pytest.raises(ValueError, match="not_null on t.a"):
        quality.enforce(quality.report([quality.not_null(df, "t", "a")]))


def test_unknown_metric_path_is_refused(cards):
    with pytest.raises(ValueError):
        metric(cards, ["fact_batting.total_runs"], by=["fielders.player_name"])
    with pytest.raises(ValueError):
        metric(cards, ["fact_batting.total_runs", "fact_bowling.total_wickets"], by=["batters.player_name"])


def test_facts_side_by_side(cards):
    """Each fact is summed on its own: the figures are those of the facts asked for alone."""
    asked = ["fact_batting.total_runs", "fact_bowling.total_wickets"]
    both = metric(cards, asked).first()
    assert both.total_runs == metric(cards, asked[:1]).first().total_runs
    assert both.total_wickets == metric(cards, asked[1:]).first().total_wickets
    by = {r.player_name: r for r in metric(cards, asked, by=["players.player_name"]).collect()}
    alone = {r.player_name: r.total_wickets for r in metric(cards, asked[1:], by=["bowlers.player_name"]).collect()}
    assert {n: r.total_wickets for n, r in by.items() if r.total_wickets is not None} == alone


def changed(*pairs):
    lines = list(MATCH)
    for old, new in pairs:
        lines[lines.index(old)] = new
    return lines


def test_planted_faults_are_reported(spark, tmp_path):
    """One file per fault; the clean match above shows that none of these fires by itself."""
    one_out = "T Reed          run out                     20   33    1    -"
    files = {
        "falling score.txt": changed(("6-100", "6-70")),
        "total.txt": changed(
            ("T Reed          not out                     20   33    1    -", one_out),
            (
                "TOTAL: (2 wkts, 15.1 overs)                      61",
                "TOTAL: (2 wkts, 15.1 overs)                      30",
            ),
        ),
        "wicket.txt": changed(
            ("S Stone          14.0   2   60   3   4.29", "S Stone          14.0   2   60   2   4.29")
        ),
        "competition.txt": changed(("English FC League - D1 - 1 May 2026", "Village Cup - 1 May 2026")),
        "dismissal.txt": changed(
            (
                "B Oak           lbw b Stone                 10   20    1    -",
                "B Oak           timed out                   10   20    1    -",
            )
        ),
        "no result.txt": MATCH[:-3],
        "no total.txt": [line for line in MATCH if not line.startswith("TOTAL: (2")],
    }
    found = quality.report(checks.all_checks(build(spark, tmp_path, files)))
    fired = {r["check"] + ":" + r["table_name"] for r in found.where("failures > 0").collect()}
    assert fired >= {
        "fow_never_falls:int_fow_rows",
        "stands_sum_to_total:int_partnerships",
        "wickets_reconcile:int_bowling_rows",
        "accepted_values:int_match_header",
        "not_null:int_batting_rows",
        "one_line:int_result",
        "one_of_each:int_innings_totals",
        "not_null:int_innings_totals",
    }


def test_chunked_parse_gives_the_same_tables(spark, tmp_path):
    files = {FILE: MATCH, "b.txt": MATCH[:-1], "no markers.txt": ["a", "", "b"] * 9, "one.txt": ["*"]}
    whole = build(spark, tmp_path / "whole", files)
    for size in (3, 20):
        cut = build(spark, tmp_path / f"cut{size}", files, max_rows=size)
        for table in ("stg_row_classification", "int_innings_totals", "int_batting_rows", "int_bowling_rows",
                      "int_partnerships", "int_match_header"):
            assert sorted(map(str, cut.stored(table).collect())) == sorted(map(str, whole.stored(table).collect()))
