"""Rollups of mergeable sums answer metrics without reading the fact."""

import pytest
from pyspark.sql import functions as F

from matchbook.plans.build import Scorecards
from matchbook.plans.metrics import METRICS, Rollups, merged_states, metric, states_of
from tests.fixture_match import MATCH, raw_lines

GRAIN = {
    "fact_batting": ["batters.player_name", "dim_match.match_format", "batting_teams.team_name"],
    "fact_bowling": ["bowlers.player_name", "dim_match.match_format", "bowling_teams.team_name"],
    "fact_partnership": ["dim_match.match_format", "batting_teams.team_name"],
    "fact_fielding": ["fielders.player_name", "dim_match.match_format", "batting_teams.team_name"],
    "fact_player_match_summary": ["summary_players.player_name", "dim_match.match_format", "summary_teams.team_name"],
    "fact_team_match_summary": ["dim_match.match_format", "summary_teams.team_name"],
}


@pytest.fixture(scope="module")
def cards(spark, tmp_path_factory):
    other = [line.replace("English FC League - D1", "Only Test Match").replace(" 40   70 ", " 55   70 ") for line in MATCH]
    files = {"a.txt": MATCH, "b.txt": other, "c.txt": [line.replace("Alders", "Cedars") for line in MATCH]}
    return Scorecards(spark, str(tmp_path_factory.mktemp("cards")), raw_lines(spark, files)).build()


def rounded(frame):
    kinds = dict(frame.dtypes)
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in frame.select(
        *[F.col(c).cast("double") if kinds[c].startswith("decimal") else F.col(c) for c in frame.columns]).collect())


@pytest.mark.parametrize("fact", sorted(GRAIN))
def test_every_measure_from_its_rollup(spark, cards, fact, tmp_path):
    rollups = Rollups(cards, str(tmp_path)).add(fact, GRAIN[fact]).add(fact, ["dim_match.match_format"])
    names = [f"{fact}.{m}" for m in METRICS[fact]]
    team = GRAIN[fact][-1]
    tests = {"dim_match.match_format": lambda c: c == "TEST"}
    for by, where in (([], None), (["dim_match.match_format"], None), ([team], tests), (GRAIN[fact], None), ([], {team: lambda c: c == "nobody"})):
        from_rollup = metric(rollups, names, by=by, where=where)
        assert rounded(from_rollup) == rounded(metric(cards, names, by=by, where=where))
        plan = from_rollup._jdf.queryExecution().optimizedPlan().toString()
        files = " ".join(from_rollup.inputFiles())
        assert str(tmp_path) in files and f"{cards.path}/{fact}" not in files and "Join" not in plan
    # The smallest that fits is taken; what none has is answered by the fact.
    assert f"{fact}-1" in " ".join(metric(rollups, names, by=["dim_match.match_format"]).inputFiles())
    missing = metric(rollups, names, by=["dim_match.result_type"])
    assert f"{cards.path}/{fact}" in " ".join(missing.inputFiles())
    assert rounded(missing) == rounded(metric(cards, names, by=["dim_match.result_type"]))


def test_merged_rollups_equal_one(spark, cards, tmp_path):
    fact = "fact_player_match_summary"

    class Part:
        def __init__(self, k):
            self.k = k

        def __getattr__(self, table):
            frame = getattr(cards, table)
            return frame.where(F.crc32("match_id") % 3 == self.k) if table == fact else frame

    parts = [states_of(Part(k), fact, GRAIN[fact]) for k in range(3)]
    rollups = Rollups(cards, str(tmp_path)).add(fact, GRAIN[fact], merged_states(parts))
    names = [f"{fact}.{m}" for m in METRICS[fact]]
    by = ["summary_players.player_name"]
    assert rounded(metric(rollups, names, by=by)) == rounded(metric(cards, names, by=by))
