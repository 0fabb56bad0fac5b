"""Typed records -> star schema with hash keys.

A key is a hash of the natural key, and the dimensions hold every name the facts use (the checks
assert it), so player and match keys are computed where they are needed instead of joined in. A
team is joined, because a header could name a side that is not in the match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.functions.measures import percent
from matchbook.functions.text import other_of, rx, surrogate_key, to_int
from matchbook.operators.series import gap_series
from matchbook.operators.star import role, union_names
from matchbook.plans.entities import INTERNATIONALS, is_dismissal
from matchbook.plans.staging import FILE, MERGE
from matchbook.schemas import as_table

SERIES_GAP_DAYS = 30
CENTURY, HALF_CENTURY, HAUL = 100, 50, 5


def dim_team(header: DataFrame) -> DataFrame:
    names = union_names(header.select("home_team"), header.select("away_team"), name="team_name")
    return as_table(names.withColumn("team_id", surrogate_key("team_name")), "dim_team")


def dim_player(batting: DataFrame, bowling: DataFrame, result: DataFrame) -> DataFrame:
    names = union_names(
        batting.select("player_name"),
        bowling.select("player_name"),
        result.select("man_of_the_match").where(F.col("man_of_the_match").isNotNull()),
        name="player_name",
    )
    return as_table(names.withColumn("player_id", surrogate_key("player_name")), "dim_player")


def _key_of(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), surrogate_key(name))


def dim_match(
    header: DataFrame, result: DataFrame, teams: DataFrame, pieces: int | None = None, meet: str = MERGE
) -> DataFrame:
    """One row per match, with its series for internationals.

    A series: the same two sides in the same format, at most 30 days between matches.
    """
    winner = role(teams, "team_id", "winning", "team_name")
    matches = (
        header.join(result.hint(meet), FILE)
        .join(winner, F.col("winning_team") == F.col("winning_team_name"), "left")
        .withColumn("match_id", surrogate_key(FILE))
        .withColumn("home_team_id", surrogate_key("home_team"))
        .withColumn("away_team_id", surrogate_key("away_team"))
        .withColumn("man_of_the_match_id", _key_of("man_of_the_match"))
        .withColumn(
            "innings_per_team", F.when(F.col("match_format").isin("TEST", "FC_LEAGUE"), 2).otherwise(1)
        )
    )
    # The pair key ignores who is at home.
    of_series = (
        header.join(result.select(FILE).hint(meet), FILE)
        .where(F.col("match_format").isin(INTERNATIONALS))
        .select(
            FILE,
            "match_date",
            "match_format",
            F.least("home_team", "away_team").alias("team_a"),
            F.greatest("home_team", "away_team").alias("team_b"),
            F.concat("home_team", F.lit(" v "), "away_team").alias("_title"),
            to_int(rx("competition_variant", r"\(of (\d+)\)")).alias("_label"),
        )
    )
    key = ["match_format", "team_a", "team_b"]
    numbered = gap_series(
        of_series,
        key,
        "match_date",
        FILE,
        SERIES_GAP_DAYS,
        firsts={"_first_title": "_title", "_first_date": "match_date"},
        totals={"_largest_label": F.max("_label")},
        pieces=pieces,
    )
    wording = F.when(F.col("match_format") == "TEST", "Test").otherwise(F.col("match_format"))
    series = numbered.select(
        FILE,
        surrogate_key(*key, "series_no").alias("series_id"),
        F.concat(
            "_first_title", F.lit(" "), wording, F.lit(" series, "), F.date_format("_first_date", "MMM yyyy")
        ).alias("series_name"),
        F.col("series_position").alias("series_match_number"),
        F.col("series_size").alias("series_matches_played"),
        F.greatest("series_size", F.coalesce("_largest_label", F.lit(1))).alias("series_scheduled_matches"),
    )
    return as_table(matches.join(series.hint(meet), FILE, "left"), "dim_match")


def _match_keys(matches: DataFrame, meet: str) -> DataFrame:
    """One row per match: many, so never sent whole to every task."""
    return matches.select(FILE, "match_id", "home_team_id", "away_team_id").hint(meet)


def _with_team(df: DataFrame, teams: DataFrame, column: str) -> DataFrame:
    return df.join(teams.withColumnRenamed("team_name", column), column)


def fact_batting(
    batting: DataFrame,
    matches: DataFrame,
    teams: DataFrame,
    innings: DataFrame,
    factor: DataFrame,
    meet: str = MERGE,
) -> DataFrame:
    totals = innings.select(FILE, F.col("team").alias("batting_team"), "team_innings_number", "total_runs")
    rows = (
        batting.join(factor.select(FILE, "player_name", "batting_match_factor").hint(meet), [FILE, "player_name"], "left")
        .join(totals.hint(meet), [FILE, "batting_team", "team_innings_number"], "left")
        .join(_match_keys(matches, meet), FILE)
    )
    rows = _with_team(rows, teams, "batting_team")
    return as_table(
        rows.withColumns(
            {
                "player_id": surrogate_key("player_name"),
                "opposition_team_id": other_of("team_id", "home_team_id", "away_team_id"),
                "strike_rate": percent("runs", "balls_faced"),
                "pct_of_team_innings_runs": percent("runs", "total_runs"),
            }
        ),
        "fact_batting",
        FILE,
    )


def fact_bowling(
    bowling: DataFrame,
    matches: DataFrame,
    teams: DataFrame,
    innings: DataFrame,
    factor: DataFrame,
    meet: str = MERGE,
) -> DataFrame:
    """The wickets lost belong to the side that batted: same innings number, another team."""
    lost = innings.select(FILE, "team_innings_number", F.col("team").alias("_batting"), "wickets_lost")
    same = [bowling[FILE] == lost[FILE], bowling["team_innings_number"] == lost["team_innings_number"]]
    rows = (
        bowling.join(lost.hint(meet), [*same, F.col("_batting") != F.col("bowling_team")], "left")
        .drop(lost[FILE], lost["team_innings_number"])
        .join(factor.select(FILE, "player_name", "bowling_match_factor").hint(meet), [FILE, "player_name"], "left")
        .join(_match_keys(matches, meet), FILE)
    )
    rows = _with_team(rows, teams, "bowling_team")
    return as_table(
        rows.withColumns(
            {
                "player_id": surrogate_key("player_name"),
                "opposition_team_id": other_of("team_id", "home_team_id", "away_team_id"),
                "pct_of_team_innings_wickets": percent("wickets", "wickets_lost"),
            }
        ),
        "fact_bowling",
        FILE,
    )


def fact_fow(fow: DataFrame, matches: DataFrame, teams: DataFrame, meet: str = MERGE) -> DataFrame:
    return as_table(_with_team(fow.join(_match_keys(matches, meet), FILE), teams, "team"), "fact_fow", FILE)


def fact_partnership(stands: DataFrame, matches: DataFrame, teams: DataFrame, meet: str = MERGE) -> DataFrame:
    return as_table(_with_team(stands.join(_match_keys(matches, meet), FILE), teams, "team"), "fact_partnership", FILE)


def fact_fielding(events: DataFrame, matches: DataFrame, teams: DataFrame, meet: str = MERGE) -> DataFrame:
    rows = _with_team(events.join(_match_keys(matches, meet), FILE), teams, "team")
    people = {f"{who}_id": _key_of(f"{who}_name") for who in ("batter", "fielder", "bowler")}
    return as_table(rows.withColumns(people), "fact_fielding", FILE)


def fact_player_match_summary(
    batting: DataFrame,
    bowling: DataFrame,
    fielding: DataFrame,
    batting_factor: DataFrame,
    bowling_factor: DataFrame,
    matches: DataFrame,
    buckets: int | None = None,
    meet: str = MERGE,
) -> DataFrame:
    """One row per player, team and match. Counts default to 0; raw sums stay NULL without rows.

    The five sources are stacked instead of joined to each other. Where they lie in ``buckets`` by file, they are summed up
    there, and only the sides of the players are shuffled, once. Otherwise the stack is shuffled once, by match: the rows of
    a match stay side by side, and the sums, the sides of a player and the match itself need no other shuffle.
    """
    by_file = bool(buckets) and all(FILE in source.columns for source in (batting, bowling, fielding))
    at = FILE if by_file else "match_id"
    key = [at, "player_id"]
    runs = F.col("runs")

    def one_if(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    def ingredients(factor: DataFrame, prefix: str, names: list[str]) -> DataFrame:
        ids = [F.col(FILE) if by_file else surrogate_key(FILE).alias(at), surrogate_key("player_name").alias("player_id")]
        return factor.select(*ids, *[F.col(n).alias(f"{prefix}_{n}") for n in names])

    sources = [
        batting.select(
            *key,
            "team_id",
            F.col("runs").alias("total_runs"),
            F.col("balls_faced").alias("total_balls_faced"),
            F.col("fours").alias("total_fours"),
            F.col("sixes").alias("total_sixes"),
            is_dismissal(F.col("dismissal_type")).alias("dismissals"),
            one_if(runs >= CENTURY).alias("centuries"),
            one_if((runs >= HALF_CENTURY) & (runs < CENTURY)).alias("half_centuries"),
            "batting_match_factor",
        ),
        bowling.select(
            *key,
            "team_id",
            F.col("overs").alias("total_overs_naive"),
            F.col("runs_conceded").alias("total_runs_conceded"),
            F.col("wickets").alias("total_wickets"),
            one_if(F.col("wickets") >= HAUL).alias("five_wicket_hauls"),
            "bowling_match_factor",
        ),
        ingredients(
            batting_factor, "mf_bat", ["own_runs", "own_dismissals", "peer_runs", "peer_dismissals"]
        ),
        ingredients(
            bowling_factor,
            "mf_bowl",
            ["own_runs_conceded", "own_wickets", "peer_runs_conceded", "peer_wickets"],
        ),
        fielding.where(F.col("fielder_id").isNotNull()).select(
            at,
            F.col("fielder_id").alias("player_id"),
            one_if(F.col("dismissal_type") == "CAUGHT").alias("catches"),
            one_if(F.col("dismissal_type") == "STUMPED").alias("stumpings"),
        ),
    ]
    repeated = {"batting_match_factor", "bowling_match_factor"}  # the same on every innings row

    def summed(rows: DataFrame, *more: Column) -> DataFrame:
        figures = [(F.max(c) if c in repeated else F.sum(c)).alias(c) for c in rows.columns if c not in (*key, "team_id")]
        return rows.groupBy(*key).agg(*figures, *more)

    of_match = matches.select(*dict.fromkeys([at, "match_id"]), "home_team_id", "away_team_id", "man_of_the_match_id").hint(meet)
    if by_file:
        # Without a side of its own a player has no row; a bowler who is also a batter has one from there.
        bats, bowls = (rows.select(*key, "team_id").where(F.col("team_id").isNotNull()).distinct() for rows in sources[:2])
        sides = bats.unionByName(bowls.join(bats.hint(meet), [*key, "team_id"], "left_anti"))
        # A union of rows that lie by a column keeps them there if each side names the column anew.
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.withColumnRenamed(at, "_at") for s in sources])
        sums = summed(stacked.withColumnRenamed("_at", at))
        rows = sides.repartition(buckets, FILE).join(sums.hint(meet), key, "left")
    else:
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
        stacked = stacked.repartition(*([buckets] if buckets else []), "match_id")
        rows = summed(stacked, F.collect_set("team_id").alias("_teams")).withColumn("team_id", F.explode("_teams"))
    rows = rows.join(of_match, at).fillna(
        0, ["dismissals", "centuries", "half_centuries", "five_wicket_hauls", "catches", "stumpings"]
    )
    return as_table(
        rows.withColumns(
            {
                "opposition_team_id": other_of("team_id", "home_team_id", "away_team_id"),
                "is_man_of_the_match": F.col("player_id") == F.col("man_of_the_match_id"),
            }
        ),
        "fact_player_match_summary",
        FILE,
    )


def fact_team_match_summary(
    innings: DataFrame,
    bowling_rows: DataFrame,
    batting: DataFrame,
    bowling: DataFrame,
    matches: DataFrame,
    teams: DataFrame,
    meet: str = MERGE,
) -> DataFrame:
    """One row per team and match. ``won`` is NULL when nobody won."""
    at = FILE if FILE in batting.columns and FILE in bowling.columns else "match_id"
    bats, bowls = (rows.select(at, "team_id").distinct() for rows in (batting, bowling))
    sides = bats.unionByName(bowls).distinct()
    bat = innings.groupBy(FILE, F.col("team").alias("team_name")).agg(
        F.sum("total_runs").alias("total_runs"),
        F.sum("wickets_lost").alias("total_wickets_lost"),
        F.sum("overs_faced").alias("total_overs_faced_naive"),
        F.max(F.col("match_innings_sequence") == 1).alias("_first"),
    )
    bowl = bowling_rows.groupBy(FILE, F.col("bowling_team").alias("team_name")).agg(
        F.sum("runs_conceded").alias("total_runs_conceded"),
        F.sum("wickets").alias("total_wickets_taken"),
    )
    rows = (
        sides.join(matches.hint(meet), at)
        .join(teams, "team_id")
        .join(bat.hint(meet), [FILE, "team_name"], "left")
        .join(bowl.hint(meet), [FILE, "team_name"], "left")
    )
    return as_table(
        rows.withColumns(
            {
                "opposition_team_id": other_of("team_id", "home_team_id", "away_team_id"),
                "batted_first": F.coalesce(F.col("_first"), F.lit(False)),
                "won": F.col("team_id") == F.col("winning_team_id"),
            }
        ),
        "fact_team_match_summary",
        FILE,
    )
