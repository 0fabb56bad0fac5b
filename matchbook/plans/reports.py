"""Ready-made reports over the star schema.

Each takes the built tables and returns a frame; period, format or team filters are optional
arguments on dimensions, so a report without them runs over everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.functions.measures import overs_to_balls, pooled_batting, pooled_bowling, ratio
from matchbook.operators.rank import leaderboard, recent_form, top_per_group
from matchbook.operators.scan import scan_groups
from matchbook.operators.stands import collapses
from matchbook.plans.entities import INTERNATIONALS, is_dismissal
from matchbook.plans.metrics import metric
from matchbook.plans.staging import by_file

COLLAPSE_FALLS, COLLAPSE_RUNS = 3, 30
LONE_HAND_PERCENT = 35
LATE_STAND = 7
TOP_ORDER = 6
SMALL_SAMPLE = 5
INNINGS = ["match_id", "match_innings_sequence"]


def _players(t, name: str = "player_name", key: str = "player_id") -> DataFrame:
    return t.dim_player.select(F.col("player_id").alias(key), F.col("player_name").alias(name))


def _teams(t, name: str = "team_name", key: str = "team_id") -> DataFrame:
    return t.dim_team.select(F.col("team_id").alias(key), F.col("team_name").alias(name))


def _matches(t, *columns: str) -> DataFrame:
    return t.dim_match.select("match_id", *columns)


def level() -> Column:
    """International and domestic figures are different standards and never added."""
    return F.when(F.col("match_format").isin(INTERNATIONALS), "international").otherwise("domestic")


# --- verified questions ------------------------------------------------------------------------
def batting_averages(t) -> DataFrame:
    return metric(
        t,
        [f"fact_batting.{m}" for m in ("total_runs", "dismissals", "batting_average", "batting_strike_rate")],
        by=["batters.player_name"],
    )


def bowling_economy(t) -> DataFrame:
    return metric(
        t,
        [f"fact_bowling.{m}" for m in ("total_wickets", "economy_rate", "economy_exact", "bowling_average")],
        by=["bowlers.player_name"],
    )


def match_results(t) -> DataFrame:
    """Every match with its sides, winner and man of the match by name."""
    return (
        t.dim_match.join(_teams(t, "home_team", "home_team_id"), "home_team_id")
        .join(_teams(t, "away_team", "away_team_id"), "away_team_id")
        .join(_teams(t, "winning_team", "winning_team_id"), "winning_team_id", "left")
        .join(_players(t, "man_of_the_match", "man_of_the_match_id"), "man_of_the_match_id", "left")
        .select(
            "match_id",
            "match_date",
            "match_format",
            "home_team",
            "away_team",
            "winning_team",
            "result_type",
            "result_margin_type",
            "result_margin_value",
            "man_of_the_match",
        )
    )


def match_factors(t) -> DataFrame:
    """Per player and match, once (the facts repeat the value for each innings)."""
    (batting, at), (bowling, _) = by_file(t, "fact_batting"), by_file(t, "fact_bowling")
    bat = batting.select(at, "player_id", "batting_match_factor").distinct()
    bowl = bowling.select(at, "player_id", "bowling_match_factor").distinct()
    both = bat.join(bowl, [at, "player_id"], "left")
    return (
        both.join(t.dim_match.select(*dict.fromkeys([at, "match_id"]), "match_date"), at)
        .join(_players(t), "player_id")
        .select("match_id", "match_date", "player_name", "batting_match_factor", "bowling_match_factor")
    )


def stands(t) -> DataFrame:
    return (
        t.fact_partnership.join(_teams(t), "team_id")
        .join(_matches(t, "match_date"), "match_id")
        .select(
            "match_id",
            "match_date",
            "team_name",
            "team_innings_number",
            F.col("partnership_number").alias("wicket"),
            "partnership_runs",
            "is_unbroken",
        )
        .orderBy("match_id", "team_name", "team_innings_number", "wicket")
    )


def fielding_stats(t) -> DataFrame:
    return metric(
        t, ["fact_fielding.total_catches", "fact_fielding.total_stumpings"], by=["fielders.player_name"]
    ).where(F.col("player_name").isNotNull())


def best_all_rounders(t, n: int = 10, matches: int = SMALL_SAMPLE) -> DataFrame:
    """Pooled batting plus pooled bowling factor, for players with both in enough matches."""
    bat = [f"mf_bat_{c}" for c in ("own_runs", "own_dismissals", "peer_runs", "peer_dismissals")]
    bowl = [f"mf_bowl_{c}" for c in ("own_runs_conceded", "own_wickets", "peer_runs_conceded", "peer_wickets")]
    both = F.col("mf_bat_own_runs").isNotNull() & F.col("mf_bowl_own_wickets").isNotNull()
    sums = t.fact_player_match_summary.groupBy("player_id").agg(
        *[F.sum(c).alias(c) for c in bat + bowl], F.count_if(both).alias("both_matches")
    )
    named = (
        sums.join(_players(t), "player_id")
        .withColumn("pooled_batting_match_factor", pooled_batting(*bat))
        .withColumn("pooled_bowling_match_factor", pooled_bowling(*bowl))
        .withColumn(
            "all_rounder_composite",
            F.col("pooled_batting_match_factor") + F.col("pooled_bowling_match_factor"),
        )
        .select(
            "player_name",
            "pooled_batting_match_factor",
            "pooled_bowling_match_factor",
            "all_rounder_composite",
            "both_matches",
        )
    )
    order = [F.desc_nulls_last("all_rounder_composite"), F.asc("player_name")]
    return leaderboard(named, order, n, at_least=F.col("both_matches") >= matches).drop("both_matches")


def series_results(t) -> DataFrame:
    return (
        match_results(t)
        .drop("match_date", "man_of_the_match", "match_format")
        .join(
            _matches(t, "match_date", "series_name", "series_match_number", "series_scheduled_matches"),
            "match_id",
        )
        .where(F.col("series_name").isNotNull())
        .orderBy("series_name", "series_match_number", "match_id")
    )


def team_totals(t) -> DataFrame:
    return (
        t.fact_team_match_summary.join(_teams(t), "team_id")
        .join(_matches(t, "match_date"), "match_id")
        .select(
            "match_id",
            "match_date",
            "team_name",
            "total_runs",
            "total_wickets_lost",
            "total_runs_conceded",
            "total_wickets_taken",
            "won",
        )
    )


# --- leaderboards and lookups ------------------------------------------------------------------
def most(t, measure: str, start: str, end: str, n: int = 10) -> DataFrame:
    """Top ``n`` players by a summary column over a period, all of a player's teams together."""
    period = F.col("match_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    rows, at = by_file(t, "fact_player_match_summary")
    in_period = t.dim_match.where(period).select(at)
    sums = (
        rows.select(at, "player_id", measure)
        .distinct()
        .join(in_period, at)
        .groupBy("player_id")
        .agg(F.sum(measure).alias(measure))
    )
    named = sums.join(_players(t), "player_id").select("player_name", measure)
    return leaderboard(named, [F.desc_nulls_last(measure), F.asc("player_name")], n)


def best_averages(t, n: int = 10, innings: int = SMALL_SAMPLE) -> DataFrame:
    """Best batting averages among batters with a stated minimum of innings."""
    figures = metric(
        t,
        [f"fact_batting.{m}" for m in ("total_runs", "innings_count", "batting_average")],
        by=["batters.player_name"],
    )
    order = [F.desc_nulls_last("batting_average"), F.asc("player_name")]
    return leaderboard(figures, order, n, at_least=F.col("innings_count") >= innings)


def matches_per_format(t, start: str, end: str) -> DataFrame:
    return metric(
        t,
        ["dim_match.matches_count"],
        by=["dim_match.match_format"],
        where={"dim_match.match_date": lambda c: c.between(F.lit(start).cast("date"), F.lit(end).cast("date"))},
    )


def surname_lookup(t, surname: str | None = None) -> DataFrame:
    """Players behind a surname, and how many there are: one is an answer, several are a list."""
    names = t.dim_player.withColumn("surname", F.regexp_replace("player_name", r"^\S+ ", ""))
    if surname is not None:
        names = names.where(F.lower("surname") == surname.lower())
    counts = names.groupBy("surname").agg(F.count(F.lit(1)).alias("hits"))
    return names.join(counts, "surname").select("surname", "player_name", "hits")


def meetings(t) -> DataFrame:
    """Matches by pair of sides, in either order, numbered in time."""
    played = match_results(t).select(
        "match_id",
        "match_date",
        F.least("home_team", "away_team").alias("team_a"),
        F.greatest("home_team", "away_team").alias("team_b"),
    )
    return scan_groups(
        played,
        ["team_a", "team_b"],
        ["match_date", "match_id"],
        number="meeting",
    )


# --- players -----------------------------------------------------------------------------------
def player_profile(t) -> DataFrame:
    """Season figures of every player over all teams; a discipline not played stays NULL."""
    per_match = [
        "total_runs", "total_balls_faced", "dismissals", "centuries", "half_centuries",
        "total_runs_conceded", "total_wickets", "five_wicket_hauls", "catches", "stumpings",
    ]
    summary, at = by_file(t, "fact_player_match_summary")
    once = summary.select(at, "player_id", *per_match).distinct()
    totals = once.groupBy("player_id").agg(
        F.count(F.lit(1)).alias("matches"), *[F.sum(c).alias(c) for c in per_match]
    )
    teams = (
        t.fact_player_match_summary.select("player_id", "team_id").distinct()
        .groupBy("player_id").agg(F.count(F.lit(1)).alias("teams"))
    )
    formats = (
        summary.select(at, "player_id")
        .join(t.dim_match.select(at, "match_format"), at)
        # At most one entry per format code.
        .groupBy("player_id").agg(F.array_join(F.array_sort(F.collect_set("match_format")), ", ").alias("formats"))
    )
    highest = t.fact_batting.groupBy("player_id").agg(F.max("runs").alias("highest_score"))
    best = F.max(F.struct(F.col("wickets").alias("w"), (-F.col("runs_conceded")).alias("r")))
    figures = t.fact_bowling.groupBy("player_id").agg(best.alias("b")).select(
        "player_id",
        F.concat(F.col("b.w").cast("string"), F.lit("-"), (-F.col("b.r")).cast("string")).alias("best_figures"),
    )
    rows = totals
    for side in (teams, formats, highest, figures):
        rows = rows.join(side, "player_id", "left")
    return (
        rows.join(_players(t), "player_id")
        .drop("player_id")
        .withColumn("batting_average", ratio("total_runs", "dismissals"))
        .withColumn("bowling_average", ratio("total_runs_conceded", "total_wickets"))
    )


def player_teams(t) -> DataFrame:
    """Matches and runs per player and team, as context for the season totals."""
    return metric(
        t,
        ["fact_player_match_summary.matches_played", "fact_player_match_summary.sum_total_runs"],
        by=["summary_players.player_name", "summary_teams.team_name"],
    )


def batting_form(t, n: int = 5) -> DataFrame:
    """Last innings of each batter, oldest first: '45, 3, 67*'."""
    runs = F.col("runs").cast("string")
    text = F.when(F.col("dismissal_type") == "NOT_OUT", F.concat(runs, F.lit("*"))).otherwise(runs)
    played = (
        t.fact_batting.where(~F.col("did_not_bat"))
        .join(_matches(t, "match_date"), "match_id")
        .join(_players(t), "player_id")
    )
    order = ["match_date", *INNINGS, "batting_position", "team_id"]
    return recent_form(played, ["player_name"], order, text, n)


def bowling_form(t, n: int = 5) -> DataFrame:
    """Last figures of each bowler, oldest first: '3-41, 0-28'."""
    text = F.concat(F.col("wickets").cast("string"), F.lit("-"), F.col("runs_conceded").cast("string"))
    played = t.fact_bowling.join(_matches(t, "match_date"), "match_id").join(_players(t), "player_id")
    order = ["match_date", *INNINGS, "team_id", "wickets", "runs_conceded"]
    return recent_form(played, ["player_name"], order, text, n)


# The formats whose figures count for an international format.
MATCHED = {
    "TEST": {"international": ["TEST"], "domestic": ["FC_LEAGUE"]},
    "ODI": {"international": ["ODI"], "domestic": ["LIST_A", "T20"]},
    "T20I": {"international": ["T20I"], "domestic": ["T20", "HUNDRED"]},
}
SIDES = ["domestic", "international"]


def _matched_matches(t) -> DataFrame:
    """Each match once per international format it counts for, with its level."""
    pairs = [
        (fmt, target, side)
        for target, sides in MATCHED.items()
        for side, formats in sides.items()
        for fmt in formats
    ]
    listed = ", ".join(f"('{fmt}', '{target}', '{side}')" for fmt, target, side in pairs)
    counts_for = t.dim_match.sparkSession.sql(
        f"SELECT * FROM VALUES {listed} AS pairs(match_format, selection_format, level)"
    )
    return _matches(t, "match_format").join(counts_for, "match_format")


def batting_candidates(t) -> DataFrame:
    """Batting per player and international format, with the matched domestic formats beside it.

    Figures are pooled from sums within a level; levels are never added together.
    """
    rows = t.fact_batting.join(_matched_matches(t), "match_id").withColumn(
        "out", is_dismissal(F.col("dismissal_type"))
    )
    runs = F.col("runs")
    sums = rows.groupBy("player_id", "selection_format").pivot("level", SIDES).agg(
        F.count("runs").alias("innings"),
        F.sum("runs").alias("runs"),
        F.sum("balls_faced").alias("balls"),
        F.sum("out").alias("outs"),
        F.count_if(runs >= 100).alias("hundreds"),
        F.count_if(runs.between(50, 99)).alias("fifties"),
        # At most the two formats of a level.
        F.array_join(F.array_sort(F.collect_set("match_format")), ", ").alias("formats"),
    )
    out = []
    for side in SIDES:
        innings = F.coalesce(f"{side}_innings", F.lit(0))
        out += [
            F.nullif(F.col(f"{side}_formats"), F.lit("")).alias(f"{side}_formats"),
            innings.alias(f"{side}_innings"),
            F.col(f"{side}_runs"),
            ratio(f"{side}_runs", f"{side}_outs").alias(f"{side}_average"),
            (ratio(f"{side}_runs", f"{side}_balls") * 100).alias(f"{side}_strike_rate"),
            F.coalesce(f"{side}_hundreds", F.lit(0)).alias(f"{side}_hundreds"),
            F.coalesce(f"{side}_fifties", F.lit(0)).alias(f"{side}_fifties"),
            (innings < SMALL_SAMPLE).alias(f"{side}_small_sample"),
        ]
    return sums.join(_players(t), "player_id").select("player_name", "selection_format", *out)


def bowling_candidates(t) -> DataFrame:
    """The same for bowling: wickets, average, economy and balls per wicket."""
    per_match = t.fact_bowling.groupBy("match_id", "player_id").agg(
        F.sum("wickets").alias("wickets"),
        F.sum("runs_conceded").alias("runs_conceded"),
        F.sum(overs_to_balls("overs")).alias("balls"),
    )
    sums = (
        per_match.join(_matched_matches(t), "match_id")
        .groupBy("player_id", "selection_format")
        .pivot("level", SIDES)
        .agg(
            F.count(F.lit(1)).alias("matches"),
            F.sum("wickets").alias("wickets"),
            F.sum("runs_conceded").alias("conceded"),
            F.sum("balls").alias("balls"),
        )
    )
    out = []
    for side in SIDES:
        matches, runs, balls = (F.col(f"{side}_{c}") for c in ("matches", "conceded", "balls"))
        out += [
            F.coalesce(matches, F.lit(0)).alias(f"{side}_matches"),
            F.col(f"{side}_wickets"),
            ratio(runs, f"{side}_wickets").alias(f"{side}_average"),
            ratio(runs * 6, balls).alias(f"{side}_economy"),
            ratio(balls, f"{side}_wickets").alias(f"{side}_strike_rate"),
            (F.coalesce(matches, F.lit(0)) < SMALL_SAMPLE).alias(f"{side}_small_sample"),
        ]
    return sums.join(_players(t), "player_id").select("player_name", "selection_format", *out)


def by_format_and_level(t) -> DataFrame:
    rows = t.fact_bowling.join(_matches(t, "match_format"), "match_id").withColumn("level", level())
    return (
        rows.groupBy("player_id", "match_format", "level")
        .agg(
            F.count(F.lit(1)).alias("innings"),
            F.sum("wickets").alias("wickets"),
            F.sum("runs_conceded").alias("runs_conceded"),
            F.sum(overs_to_balls("overs")).alias("balls"),
        )
        .join(_players(t), "player_id")
        .withColumn("economy", ratio(F.col("runs_conceded") * 6, "balls"))
        .drop("player_id")
    )


def field_benchmark(t, innings: int = SMALL_SAMPLE) -> DataFrame:
    """Every batter of a format against the pooled average of its qualifying batters."""
    own = (
        t.fact_batting.join(_matches(t, "match_format"), "match_id")
        .groupBy("player_id", "match_format")
        .agg(
            F.count("runs").alias("innings"),
            F.sum("runs").alias("runs"),
            F.sum(is_dismissal(F.col("dismissal_type"))).alias("outs"),
        )
    )
    field = own.where(F.col("innings") >= innings).groupBy("match_format").agg(
        ratio(F.sum("runs"), F.sum("outs")).alias("field_average")
    )
    return (
        own.join(field, "match_format", "left")
        .join(_players(t), "player_id")
        .select(
            "player_name",
            "match_format",
            "innings",
            ratio("runs", "outs").alias("own_average"),
            "field_average",
            (F.col("innings") >= innings).alias("qualifies"),
        )
    )


def season_in_innings(t, pieces: int | None = None) -> DataFrame:
    """Each innings of a batter in date order with the running average."""
    rows = (
        t.fact_batting.where(~F.col("did_not_bat"))
        .join(_matches(t, "match_date"), "match_id")
        .withColumn("out", is_dismissal(F.col("dismissal_type")))
    )
    order = ["match_date", *INNINGS, "batting_position", "team_id"]
    run = scan_groups(
        rows,
        ["player_id"],
        order,
        pieces,
        number="innings_number",
        sums={"runs_so_far": "runs", "outs_so_far": "out"},
    )
    return run.join(_players(t), "player_id").select(
        "player_name",
        "innings_number",
        "match_id",
        "runs",
        ratio("runs_so_far", "outs_so_far").alias("running_average"),
    )


def running_factor(t, pieces: int | None = None) -> DataFrame:
    """The pooled factors of each player after each match."""
    bat = [f"mf_bat_{c}" for c in ("own_runs", "own_dismissals", "peer_runs", "peer_dismissals")]
    bowl = [f"mf_bowl_{c}" for c in ("own_runs_conceded", "own_wickets", "peer_runs_conceded", "peer_wickets")]
    summary, at = by_file(t, "fact_player_match_summary")
    rows = (
        summary.select(at, "player_id", *bat, *bowl)
        .distinct()
        .join(t.dim_match.select(*dict.fromkeys([at, "match_id"]), "match_date"), at)
        .select("match_id", "match_date", "player_id", *bat, *bowl)
    )
    run = scan_groups(
        rows,
        ["player_id"],
        ["match_date", "match_id"],
        pieces,
        number="match_number",
        sums={f"_{c}": c for c in bat + bowl},
    )
    return run.join(_players(t), "player_id").select(
        "player_name",
        "match_number",
        "match_id",
        pooled_batting(*[f"_{c}" for c in bat]).alias("running_batting_factor"),
        pooled_bowling(*[f"_{c}" for c in bowl]).alias("running_bowling_factor"),
    )


# --- matches -----------------------------------------------------------------------------------
def innings_scores(t) -> DataFrame:
    return t.int_innings_totals.join(t.dim_match.select("match_id", "source_file_name"), "source_file_name").select(
        "match_id",
        "team",
        "team_innings_number",
        "match_innings_sequence",
        "total_runs",
        "wickets_lost",
        "overs_faced",
    )


def top_performers(t, n: int = 3) -> DataFrame:
    """The best factors of each match across both sides, batting and bowling ranked apart."""
    summary, at = by_file(t, "fact_player_match_summary")
    keys = list(dict.fromkeys([at, "match_id"]))
    parts = []
    for discipline in ("batting", "bowling"):
        factor = F.col(f"{discipline}_match_factor")
        rows = summary.select(*keys, "player_id", factor.alias("factor")).distinct()
        named = rows.where(F.col("factor").isNotNull()).join(_players(t), "player_id").drop("player_id")
        order = [F.desc("factor"), F.asc("player_name")]
        best = top_per_group(named, keys, order, n).select("match_id", "factor", "player_name", "rank")
        parts.append(best.withColumn("discipline", F.lit(discipline)))
    return parts[0].unionByName(parts[1])


def biggest_stands(t) -> DataFrame:
    """The biggest stand of each innings, by wicket; the earlier one on a tie."""
    best = F.max_by(
        F.struct("partnership_number", "partnership_runs", "is_unbroken"),
        F.struct("partnership_runs", -F.col("partnership_number")),
    )
    grouped = t.fact_partnership.groupBy(*INNINGS, "team_id").agg(best.alias("b"))
    return grouped.join(_teams(t), "team_id").select(*INNINGS, "team_name", "b.*")


def collapse_spells(t) -> DataFrame:
    """Three or more wickets for under 30 runs, overlapping spells merged."""
    return collapses(
        t.fact_fow, INNINGS, "wicket_number", "cumulative_score", COLLAPSE_FALLS, COLLAPSE_RUNS
    )


def recoveries(t, runs: int = 50) -> DataFrame:
    """The stand right after a collapse, where it is large."""
    after = t.fact_partnership.select(
        *INNINGS, (F.col("partnership_number") - 1).alias("last_fall"), "partnership_runs"
    )
    return (
        collapse_spells(t)
        .join(after, [*INNINGS, "last_fall"])
        .where(F.col("partnership_runs") >= runs)
        .select(*INNINGS, "first_fall", "last_fall", F.col("partnership_runs").alias("recovery_runs"))
    )


def lone_hands(t, percent_of_runs: float = LONE_HAND_PERCENT) -> DataFrame:
    """Batters with a large share of their side's runs in an innings."""
    return (
        t.fact_batting.where(F.col("pct_of_team_innings_runs") >= percent_of_runs)
        .join(_players(t), "player_id")
        .select(*INNINGS, "player_name", "batting_position", "runs", "pct_of_team_innings_runs")
    )


def rearguards(t) -> DataFrame:
    """Late stands worth more than the runs of the whole top order."""
    top = (
        t.fact_batting.where(F.col("batting_position") <= TOP_ORDER)
        .groupBy(*INNINGS)
        .agg(F.sum("runs").alias("top_order_runs"))
    )
    late = t.fact_partnership.where(F.col("partnership_number") >= LATE_STAND)
    return (
        late.join(top, INNINGS)
        .where(F.col("partnership_runs") > F.col("top_order_runs"))
        .select(*INNINGS, F.col("partnership_number").alias("wicket"), "partnership_runs", "top_order_runs")
    )


def tempo(t) -> DataFrame:
    """Strike rate of each batter against the innings' scoring rate (runs off the bowling per ball)."""
    rate = t.fact_bowling.groupBy(*INNINGS).agg(
        F.sum("runs_conceded").alias("_runs"), F.sum(overs_to_balls("overs")).alias("_balls")
    )
    scoring = rate.select(*INNINGS, (ratio("_runs", "_balls") * 100).alias("innings_rate"))
    return (
        t.fact_batting.where(F.col("balls_faced") > 0)
        .join(scoring, INNINGS)
        .join(_players(t), "player_id")
        .select(
            *INNINGS,
            "player_name",
            "batting_position",
            "strike_rate",
            "innings_rate",
            F.try_divide(F.col("strike_rate"), F.col("innings_rate")).alias("tempo"),
        )
    )


def control(t) -> DataFrame:
    """Economy of each bowler in a match against the match's scoring rate."""
    per = t.fact_bowling.groupBy("match_id", "player_id", "team_id").agg(
        F.sum("runs_conceded").alias("_runs"), F.sum(overs_to_balls("overs")).alias("_balls")
    )
    match = per.groupBy("match_id").agg(ratio(F.sum("_runs") * 6, F.sum("_balls")).alias("match_rate"))
    return (
        per.join(match, "match_id")
        .join(_players(t), "player_id")
        .select("match_id", "player_name", "team_id", ratio(F.col("_runs") * 6, "_balls").alias("economy"), "match_rate")
    )


def incumbents(t, last: int = 5) -> DataFrame:
    """Who batted where in a side's latest match of a format, and in how many of its last five.

    Only each side's last five matches are kept before any batter is joined.
    """
    played = t.fact_team_match_summary.select("match_id", "team_id").join(
        _matches(t, "match_date", "match_format"), "match_id"
    )
    recent = top_per_group(
        played, ["team_id", "match_format"], [F.desc("match_date"), F.desc("match_id")], last, "back"
    )
    who = F.min_by("player_id", "match_innings_sequence").alias("player_id")
    holders = (
        t.fact_batting.join(recent, ["match_id", "team_id"])
        .groupBy("team_id", "match_format", "batting_position", "back")
        .agg(who)
    )
    role = ["team_id", "match_format", "batting_position"]
    now = holders.where(F.col("back") == 1).select(*role, F.col("player_id").alias("incumbent"))
    return (
        holders.join(now, role)
        .groupBy(*role, "incumbent")
        .agg(F.count_if(F.col("player_id") == F.col("incumbent")).alias("held_of_last_five"))
        .join(_players(t, "incumbent_name", "incumbent"), "incumbent")
        .join(_teams(t), "team_id")
        .select("team_name", "match_format", "batting_position", "incumbent_name", "held_of_last_five")
    )


# --- series and teams --------------------------------------------------------------------------
def series_state(t, pieces: int | None = None) -> DataFrame:
    """After each match of a series: wins of both sides, matches left, decided or live.

    Sides are named in alphabetical order; matches left count the scheduled ones not yet played
    at that point.
    """
    played = match_results(t).drop("match_date", "match_format").join(
        _matches(t, "series_id", "series_name", "series_match_number", "series_scheduled_matches"), "match_id"
    ).where(F.col("series_id").isNotNull())
    side_a, side_b = F.least("home_team", "away_team"), F.greatest("home_team", "away_team")
    run = scan_groups(
        played,
        ["series_id"],
        ["series_match_number"],
        pieces,
        sums={
            "wins_a": F.when(F.col("winning_team") == side_a, 1).otherwise(0),
            "wins_b": F.when(F.col("winning_team") == side_b, 1).otherwise(0),
        },
    )
    left = F.col("series_scheduled_matches") - F.col("series_match_number")
    lead = F.abs(F.col("wins_a") - F.col("wins_b"))
    return run.select(
        "series_id",
        "series_name",
        "series_match_number",
        "wins_a",
        "wins_b",
        (F.col("series_match_number") - F.col("wins_a") - F.col("wins_b")).alias("no_winner"),
        left.alias("matches_left"),
        F.when(lead > left, "decided").otherwise("live").alias("state"),
    )


def team_form(t, pieces: int | None = None) -> DataFrame:
    """A side's totals match by match in date order, with wins so far and the change in total."""
    rows = t.fact_team_match_summary.join(_matches(t, "match_date"), "match_id").join(_teams(t), "team_id")
    run = scan_groups(
        rows,
        ["team_name"],
        ["match_date", "match_id"],
        pieces,
        number="match_number",
        sums={"wins_so_far": F.when(F.col("won"), 1).otherwise(0)},
        lags={"_previous": "total_runs"},
    )
    return run.select(
        "team_name",
        "match_number",
        "match_id",
        "total_runs",
        (F.col("total_runs") - F.col("_previous")).alias("change"),
        "wins_so_far",
    )
