"""Reports and metrics over the rendered reports, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchbook.bindings.cards_oracle import expected
from matchbook.bindings.registry import Registry
from matchbook.bindings.scorecards import corpus, plain
from matchbook.operators import quality
from matchbook.plans import checks, reports
from matchbook.plans.build import Scorecards
from matchbook.plans.metrics import LINKS, METRICS, ROLES, Rollups, merged_states, metric, states_of
from matchbook.plans.views import register_views
from matchbook.session import shared_dir
from matchbook.sources.results import Results

REGISTRY = Registry()

_OUT = "dismissal_type NOT IN ('NOT_OUT', 'DID_NOT_BAT', 'RETIRED_HURT')"
_BALLS = "(CAST(round(overs * 10) AS BIGINT) // 10 * 6 + CAST(round(overs * 10) AS BIGINT) % 10)"
_OVERS = "(sum(CAST(round(overs * 10) AS BIGINT))::BIGINT / 10.0::DOUBLE)"


def _over(sql: str) -> Callable[[Callable[[Scorecards], DataFrame]], None]:
    """Register a report under its own name with the expected tables in front of its SQL."""

    def keep(report: Callable[[Scorecards], DataFrame]) -> None:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(report(corpus(spark, folder)))

        run.__name__ = f"report_{report.__name__}"
        REGISTRY.add(expected(sql))(run)

    return keep


_over(
    f"""SELECT player_name, sum(runs)::BIGINT AS total_runs, count(*) FILTER (WHERE {_OUT}) AS dismissals,
    sum(runs)::DOUBLE / nullif(count(*) FILTER (WHERE {_OUT}), 0) AS batting_average,
    sum(runs)::DOUBLE / nullif(sum(balls_faced), 0) * 100 AS batting_strike_rate
    FROM fact_batting b JOIN dim_player p ON b.player_id = p.player_id GROUP BY 1"""
)(reports.batting_averages)
_over(
    f"""SELECT player_name, sum(wickets)::BIGINT AS total_wickets,
    sum(runs_conceded)::DOUBLE / nullif({_OVERS}, 0) AS economy_rate,
    (sum(runs_conceded) * 6)::DOUBLE / nullif(sum({_BALLS}), 0) AS economy_exact,
    sum(runs_conceded)::DOUBLE / nullif(sum(wickets), 0) AS bowling_average
    FROM fact_bowling b JOIN dim_player p ON b.player_id = p.player_id GROUP BY 1"""
)(reports.bowling_economy)
_over(
    """SELECT md5(h.source_file_name) AS match_id, match_date, match_format, home_team, away_team, winning_team,
    result_type, result_margin_type, result_margin_value, man_of_the_match
    FROM int_match_header h JOIN int_result r ON h.source_file_name = r.source_file_name"""
)(reports.match_results)
_over(
    """SELECT b.match_id, match_date, player_name, batting_match_factor, bowling_match_factor
    FROM (SELECT DISTINCT match_id, player_id, batting_match_factor FROM fact_batting) b
    LEFT JOIN (SELECT DISTINCT match_id, player_id, bowling_match_factor FROM fact_bowling) w
        ON b.match_id = w.match_id AND b.player_id = w.player_id
    JOIN dim_match d ON b.match_id = d.match_id JOIN dim_player p ON b.player_id = p.player_id"""
)(reports.match_factors)
_over(
    """SELECT f.match_id, match_date, team_name, team_innings_number, partnership_number AS wicket, partnership_runs,
    is_unbroken FROM fact_partnership f JOIN dim_team t ON f.team_id = t.team_id JOIN dim_match d ON f.match_id = d.match_id"""
)(reports.stands)
_over(
    """SELECT player_name, count(*) FILTER (WHERE dismissal_type = 'CAUGHT') AS total_catches,
    count(*) FILTER (WHERE dismissal_type = 'STUMPED') AS total_stumpings
    FROM fact_fielding f JOIN dim_player p ON f.fielder_id = p.player_id GROUP BY 1"""
)(reports.fielding_stats)

_BAT_POOL = """((own_r + peer_r::DOUBLE / nullif(peer_d, 0)) / (own_d + 1.0::DOUBLE)) / nullif(peer_r::DOUBLE / nullif(peer_d, 0), 0)"""
_BOWL_POOL = """CASE WHEN own_w > 0 THEN (peer_c::DOUBLE / nullif(peer_w, 0))
    / nullif((own_c + peer_c::DOUBLE / nullif(peer_w, 0)) / (own_w + 1.0::DOUBLE), 0) END"""
_SUMS = """sum(mf_bat_own_runs)::BIGINT AS own_r, sum(mf_bat_own_dismissals)::BIGINT AS own_d,
    sum(mf_bat_peer_runs)::BIGINT AS peer_r, sum(mf_bat_peer_dismissals)::BIGINT AS peer_d,
    sum(mf_bowl_own_runs_conceded)::BIGINT AS own_c, sum(mf_bowl_own_wickets)::BIGINT AS own_w,
    sum(mf_bowl_peer_runs_conceded)::BIGINT AS peer_c, sum(mf_bowl_peer_wickets)::BIGINT AS peer_w"""

_over(
    f"""SELECT player_name, {_BAT_POOL} AS pooled_batting_match_factor, {_BOWL_POOL} AS pooled_bowling_match_factor,
    {_BAT_POOL} + {_BOWL_POOL} AS all_rounder_composite FROM (SELECT player_id, {_SUMS},
        count(*) FILTER (WHERE mf_bat_own_runs IS NOT NULL AND mf_bowl_own_wickets IS NOT NULL) AS n
        FROM fact_player_match_summary GROUP BY 1) s JOIN dim_player p ON s.player_id = p.player_id
    WHERE n >= 5 ORDER BY all_rounder_composite DESC NULLS LAST, player_name LIMIT 10"""
)(reports.best_all_rounders)
_over(
    """SELECT d.match_id, series_name, series_match_number, series_scheduled_matches, d.match_date, home_team, away_team,
    winning_team, d.result_type, d.result_margin_type, d.result_margin_value
    FROM dim_match d JOIN int_match_header h ON d.source_file_name = h.source_file_name
    JOIN int_result r ON d.source_file_name = r.source_file_name WHERE series_name IS NOT NULL"""
)(reports.series_results)
_over(
    """SELECT f.match_id, match_date, team_name, total_runs, total_wickets_lost, total_runs_conceded, total_wickets_taken, won
    FROM fact_team_match_summary f JOIN dim_team t ON f.team_id = t.team_id JOIN dim_match d ON f.match_id = d.match_id"""
)(reports.team_totals)


def most_runs(t: Scorecards) -> DataFrame:
    return reports.most(t, "total_runs", "2026-04-01", "2026-06-30")


def most_wickets(t: Scorecards) -> DataFrame:
    return reports.most(t, "total_wickets", "2026-07-01", "2026-08-31")


for _report, _column, _from, _to in (
    (most_runs, "total_runs", "2026-04-01", "2026-06-30"),
    (most_wickets, "total_wickets", "2026-07-01", "2026-08-31"),
):
    _over(
        f"""SELECT player_name, sum({_column})::BIGINT AS {_column}
        FROM (SELECT DISTINCT match_id, player_id, {_column} FROM fact_player_match_summary) f
        JOIN dim_match d ON f.match_id = d.match_id JOIN dim_player p ON f.player_id = p.player_id
        WHERE match_date BETWEEN DATE '{_from}' AND DATE '{_to}' GROUP BY 1
        ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10"""
    )(_report)

_over(
    f"""SELECT player_name, sum(runs)::BIGINT AS total_runs, count(runs) AS innings_count,
    sum(runs)::DOUBLE / nullif(count(*) FILTER (WHERE {_OUT}), 0) AS batting_average
    FROM fact_batting b JOIN dim_player p ON b.player_id = p.player_id GROUP BY 1 HAVING count(runs) >= 5
    ORDER BY 4 DESC NULLS LAST, 1 LIMIT 10"""
)(reports.best_averages)


def matches_per_format(t: Scorecards) -> DataFrame:
    return reports.matches_per_format(t, "2026-06-01", "2026-06-30")


_over(
    """SELECT match_format, count(match_date) AS matches_count FROM dim_match
    WHERE match_date BETWEEN DATE '2026-06-01' AND DATE '2026-06-30' GROUP BY 1"""
)(matches_per_format)
_over(
    """SELECT substr(player_name, 3) AS surname, player_name,
    count(*) OVER (PARTITION BY substr(player_name, 3)) AS hits FROM dim_player"""
)(reports.surname_lookup)
_over(
    """SELECT *, row_number() OVER (PARTITION BY team_a, team_b ORDER BY match_date, match_id) AS meeting FROM
    (SELECT md5(source_file_name) AS match_id, match_date, least(home_team, away_team) AS team_a,
        greatest(home_team, away_team) AS team_b FROM int_match_header)"""
)(reports.meetings)
_over(
    f"""WITH once AS (SELECT DISTINCT match_id, player_id, total_runs, total_balls_faced, dismissals, centuries, half_centuries,
        total_runs_conceded, total_wickets, five_wicket_hauls, catches, stumpings FROM fact_player_match_summary),
    s AS (SELECT player_id, count(*) AS matches, sum(total_runs)::BIGINT AS total_runs,
        sum(total_balls_faced)::BIGINT AS total_balls_faced, sum(dismissals)::BIGINT AS dismissals,
        sum(centuries)::BIGINT AS centuries, sum(half_centuries)::BIGINT AS half_centuries,
        sum(total_runs_conceded)::BIGINT AS total_runs_conceded, sum(total_wickets)::BIGINT AS total_wickets,
        sum(five_wicket_hauls)::BIGINT AS five_wicket_hauls, sum(catches)::BIGINT AS catches,
        sum(stumpings)::BIGINT AS stumpings FROM once GROUP BY 1)
    SELECT player_name, s.* EXCLUDE (player_id), tm.teams, fm.formats, hs.highest_score, bf.best_figures,
        total_runs::DOUBLE / nullif(dismissals, 0) AS batting_average,
        total_runs_conceded::DOUBLE / nullif(total_wickets, 0) AS bowling_average
    FROM s JOIN dim_player p ON s.player_id = p.player_id
    LEFT JOIN (SELECT player_id, count(DISTINCT team_id) AS teams FROM fact_player_match_summary GROUP BY 1) tm
        ON s.player_id = tm.player_id
    LEFT JOIN (SELECT f.player_id, string_agg(DISTINCT match_format, ', ' ORDER BY match_format) AS formats FROM fact_player_match_summary f
        JOIN dim_match d ON f.match_id = d.match_id GROUP BY 1) fm ON s.player_id = fm.player_id
    LEFT JOIN (SELECT player_id, max(runs) AS highest_score FROM fact_batting GROUP BY 1) hs ON s.player_id = hs.player_id
    LEFT JOIN (SELECT player_id, wickets || '-' || runs_conceded AS best_figures FROM (SELECT *, row_number() OVER
        (PARTITION BY player_id ORDER BY wickets DESC, runs_conceded) AS r FROM fact_bowling) WHERE r = 1) bf
        ON s.player_id = bf.player_id"""
)(reports.player_profile)
_over(
    """SELECT player_name, team_name, count(f.match_id) AS matches_played, sum(total_runs)::BIGINT AS sum_total_runs
    FROM fact_player_match_summary f JOIN dim_player p ON f.player_id = p.player_id
    JOIN dim_team t ON f.team_id = t.team_id GROUP BY 1, 2"""
)(reports.player_teams)
_over(
    """SELECT player_name, string_agg(s, ', ' ORDER BY r DESC) AS form FROM (SELECT player_name,
        runs || CASE WHEN dismissal_type = 'NOT_OUT' THEN '*' ELSE '' END AS s, row_number() OVER (PARTITION BY player_name
        ORDER BY match_date DESC, f.match_id DESC, match_innings_sequence DESC, batting_position DESC, team_id DESC) AS r
        FROM (SELECT * REPLACE (coalesce(dismissal_type, '') AS dismissal_type) FROM fact_batting) f
        JOIN dim_match d ON f.match_id = d.match_id JOIN dim_player p ON f.player_id = p.player_id
        WHERE NOT did_not_bat) WHERE r <= 5 GROUP BY 1"""
)(reports.batting_form)
_over(
    """SELECT player_name, string_agg(s, ', ' ORDER BY r DESC) AS form FROM (SELECT player_name,
        wickets || '-' || runs_conceded AS s, row_number() OVER (PARTITION BY player_name ORDER BY match_date DESC,
        f.match_id DESC, match_innings_sequence DESC, team_id DESC, wickets DESC, runs_conceded DESC) AS r
        FROM fact_bowling f JOIN dim_match d ON f.match_id = d.match_id JOIN dim_player p ON f.player_id = p.player_id)
    WHERE r <= 5 GROUP BY 1"""
)(reports.bowling_form)

_LEVEL = "CASE WHEN match_format IN ('TEST', 'ODI', 'T20I') THEN 'international' ELSE 'domestic' END"


_MATCHED = """(VALUES ('TEST', 'TEST', 'international'), ('FC_LEAGUE', 'TEST', 'domestic'), ('ODI', 'ODI', 'international'),
    ('LIST_A', 'ODI', 'domestic'), ('T20', 'ODI', 'domestic'), ('T20I', 'T20I', 'international'),
    ('T20', 'T20I', 'domestic'), ('HUNDRED', 'T20I', 'domestic')) v(fmt, selection_format, lvl)"""


def _batting_side(side: str) -> str:
    at = f"FILTER (WHERE lvl = '{side}')"
    return f"""string_agg(DISTINCT match_format, ', ' ORDER BY match_format) {at} AS {side}_formats,
        count(runs) {at} AS {side}_innings, (sum(runs) {at})::BIGINT AS {side}_runs,
        (sum(runs) {at})::DOUBLE / nullif(sum(outs) {at}, 0) AS {side}_average,
        (sum(runs) {at})::DOUBLE / nullif(sum(balls_faced) {at}, 0) * 100 AS {side}_strike_rate,
        count(*) FILTER (WHERE lvl = '{side}' AND runs >= 100) AS {side}_hundreds,
        count(*) FILTER (WHERE lvl = '{side}' AND runs BETWEEN 50 AND 99) AS {side}_fifties,
        count(runs) {at} < 5 AS {side}_small_sample"""


def _bowling_side(side: str) -> str:
    at = f"FILTER (WHERE lvl = '{side}')"
    return f"""count(*) {at} AS {side}_matches, (sum(w) {at})::BIGINT AS {side}_wickets,
        (sum(c) {at})::DOUBLE / nullif(sum(w) {at}, 0) AS {side}_average,
        (sum(c) {at} * 6)::DOUBLE / nullif(sum(b) {at}, 0) AS {side}_economy,
        (sum(b) {at})::DOUBLE / nullif(sum(w) {at}, 0) AS {side}_strike_rate,
        count(*) {at} < 5 AS {side}_small_sample"""


_over(
    f"""SELECT player_name, selection_format, {_batting_side('domestic')}, {_batting_side('international')}
    FROM (SELECT player_id, match_format, selection_format, lvl, runs, balls_faced, CASE WHEN {_OUT} THEN 1 ELSE 0 END AS outs
        FROM fact_batting f JOIN dim_match d ON f.match_id = d.match_id JOIN {_MATCHED} ON fmt = match_format) f
    JOIN dim_player p ON f.player_id = p.player_id GROUP BY 1, 2"""
)(reports.batting_candidates)
_over(
    f"""SELECT player_name, selection_format, {_bowling_side('domestic')}, {_bowling_side('international')}
    FROM (SELECT match_id, player_id, sum(wickets) AS w, sum(runs_conceded) AS c, sum({_BALLS}) AS b
        FROM fact_bowling GROUP BY 1, 2) f JOIN dim_match d ON f.match_id = d.match_id
    JOIN {_MATCHED} ON fmt = match_format JOIN dim_player p ON f.player_id = p.player_id GROUP BY 1, 2"""
)(reports.bowling_candidates)
_over(
    f"""SELECT player_name, match_format, {_LEVEL} AS level, count(*) AS innings, sum(wickets)::BIGINT AS wickets,
    sum(runs_conceded)::BIGINT AS runs_conceded, sum({_BALLS})::BIGINT AS balls,
    (sum(runs_conceded) * 6)::DOUBLE / nullif(sum({_BALLS}), 0) AS economy
    FROM fact_bowling f JOIN dim_match d ON f.match_id = d.match_id JOIN dim_player p ON f.player_id = p.player_id
    GROUP BY 1, 2, 3"""
)(reports.by_format_and_level)
_over(
    f"""WITH own AS (SELECT player_id, match_format, count(runs) AS innings, sum(runs)::BIGINT AS r,
        count(*) FILTER (WHERE {_OUT}) AS o FROM fact_batting f JOIN dim_match d ON f.match_id = d.match_id GROUP BY 1, 2),
    field AS (SELECT match_format, sum(r)::DOUBLE / nullif(sum(o), 0) AS field_average FROM own WHERE innings >= 5 GROUP BY 1)
    SELECT player_name, own.match_format, innings, r::DOUBLE / nullif(o, 0) AS own_average, field_average,
        innings >= 5 AS qualifies FROM own LEFT JOIN field ON own.match_format = field.match_format
    JOIN dim_player p ON own.player_id = p.player_id"""
)(reports.field_benchmark)
_over(
    f"""SELECT player_name, row_number() OVER w AS innings_number, f.match_id, runs,
    (sum(runs) OVER (w ROWS UNBOUNDED PRECEDING))::DOUBLE
        / nullif(sum(CASE WHEN {_OUT} THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING), 0) AS running_average
    FROM fact_batting f JOIN dim_match d ON f.match_id = d.match_id JOIN dim_player p ON f.player_id = p.player_id
    WHERE NOT did_not_bat WINDOW w AS (PARTITION BY f.player_id
        ORDER BY match_date, f.match_id, match_innings_sequence, batting_position, team_id)"""
)(reports.season_in_innings)
_over(
    f"""SELECT player_name, match_number, match_id, {_BAT_POOL} AS running_batting_factor, {_BOWL_POOL} AS running_bowling_factor
    FROM (SELECT player_id, f.match_id, row_number() OVER w AS match_number,
        (sum(mf_bat_own_runs) OVER w)::BIGINT AS own_r, (sum(mf_bat_own_dismissals) OVER w)::BIGINT AS own_d,
        (sum(mf_bat_peer_runs) OVER w)::BIGINT AS peer_r, (sum(mf_bat_peer_dismissals) OVER w)::BIGINT AS peer_d,
        (sum(mf_bowl_own_runs_conceded) OVER w)::BIGINT AS own_c, (sum(mf_bowl_own_wickets) OVER w)::BIGINT AS own_w,
        (sum(mf_bowl_peer_runs_conceded) OVER w)::BIGINT AS peer_c, (sum(mf_bowl_peer_wickets) OVER w)::BIGINT AS peer_w
        FROM (SELECT DISTINCT match_id, player_id, mf_bat_own_runs, mf_bat_own_dismissals, mf_bat_peer_runs,
            mf_bat_peer_dismissals, mf_bowl_own_runs_conceded, mf_bowl_own_wickets, mf_bowl_peer_runs_conceded,
            mf_bowl_peer_wickets FROM fact_player_match_summary) f JOIN dim_match d ON f.match_id = d.match_id
        WINDOW w AS (PARTITION BY player_id ORDER BY match_date, f.match_id ROWS UNBOUNDED PRECEDING)) s
    JOIN dim_player p ON s.player_id = p.player_id"""
)(reports.running_factor)
_over(
    """SELECT md5(source_file_name) AS match_id, team, team_innings_number, match_innings_sequence, total_runs,
    wickets_lost, overs_faced FROM int_innings_totals"""
)(reports.innings_scores)


def _top(discipline: str) -> str:
    return f"""SELECT match_id, player_name, factor, rank, '{discipline}' AS discipline FROM (SELECT match_id, player_name,
        {discipline}_match_factor AS factor, row_number() OVER (PARTITION BY match_id
        ORDER BY {discipline}_match_factor DESC, player_name) AS rank
        FROM (SELECT DISTINCT match_id, player_id, {discipline}_match_factor FROM fact_player_match_summary) f
        JOIN dim_player p ON f.player_id = p.player_id WHERE {discipline}_match_factor IS NOT NULL) WHERE rank <= 3"""


_over(f"{_top('batting')} UNION ALL {_top('bowling')}")(reports.top_performers)
_over(
    """SELECT match_id, match_innings_sequence, team_name, partnership_number, partnership_runs, is_unbroken FROM
    (SELECT *, row_number() OVER (PARTITION BY match_id, match_innings_sequence
        ORDER BY partnership_runs DESC, partnership_number) AS r FROM fact_partnership) f
    JOIN dim_team t ON f.team_id = t.team_id WHERE r = 1"""
)(reports.biggest_stands)

_SPELLS = """z AS (SELECT DISTINCT match_id, match_innings_sequence, 0 AS n, 0 AS score FROM fact_fow
        UNION ALL SELECT match_id, match_innings_sequence, wicket_number, cumulative_score FROM fact_fow),
    s AS (SELECT *, lead(score, 3) OVER (PARTITION BY match_id, match_innings_sequence ORDER BY n) AS after FROM z),
    f AS (SELECT *, CASE WHEN n - lag(n) OVER (PARTITION BY match_id, match_innings_sequence ORDER BY n) < 3
        THEN 0 ELSE 1 END AS fresh FROM s WHERE after - score < 30),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY match_id, match_innings_sequence ORDER BY n ROWS UNBOUNDED PRECEDING) AS spell FROM f),
    spells AS (SELECT match_id, match_innings_sequence, (min(n) + 1)::BIGINT AS first_fall, (max(n) + 3)::BIGINT AS last_fall,
        min(score)::BIGINT AS score_before, max(after)::BIGINT AS score_after FROM g GROUP BY match_id, match_innings_sequence, spell)"""
_over(f"WITH {_SPELLS} SELECT * FROM spells")(reports.collapse_spells)
_over(
    f"""WITH {_SPELLS} SELECT s.match_id, s.match_innings_sequence, first_fall, last_fall, partnership_runs AS recovery_runs
    FROM spells s JOIN fact_partnership p ON s.match_id = p.match_id
        AND s.match_innings_sequence = p.match_innings_sequence AND p.partnership_number = last_fall + 1
    WHERE partnership_runs >= 50"""
)(reports.recoveries)
_over(
    """SELECT match_id, match_innings_sequence, player_name, batting_position, runs, pct_of_team_innings_runs
    FROM fact_batting b JOIN dim_player p ON b.player_id = p.player_id WHERE pct_of_team_innings_runs >= 35"""
)(reports.lone_hands)
_over(
    """SELECT f.match_id, f.match_innings_sequence, partnership_number AS wicket, partnership_runs, top_order_runs
    FROM fact_partnership f JOIN (SELECT match_id, match_innings_sequence, sum(runs)::BIGINT AS top_order_runs
        FROM fact_batting WHERE batting_position <= 6 GROUP BY 1, 2) b
        ON f.match_id = b.match_id AND f.match_innings_sequence = b.match_innings_sequence
    WHERE partnership_number >= 7 AND partnership_runs > top_order_runs"""
)(reports.rearguards)
_over(
    f"""SELECT b.match_id, b.match_innings_sequence, player_name, batting_position, strike_rate, innings_rate,
    strike_rate / innings_rate AS tempo FROM fact_batting b JOIN (SELECT match_id, match_innings_sequence,
        sum(runs_conceded)::DOUBLE / nullif(sum({_BALLS}), 0) * 100 AS innings_rate FROM fact_bowling GROUP BY 1, 2) r
        ON b.match_id = r.match_id AND b.match_innings_sequence = r.match_innings_sequence
    JOIN dim_player p ON b.player_id = p.player_id WHERE balls_faced > 0"""
)(reports.tempo)
_over(
    f"""WITH per AS (SELECT match_id, player_id, team_id, sum(runs_conceded)::BIGINT AS r, sum({_BALLS})::BIGINT AS b
        FROM fact_bowling GROUP BY 1, 2, 3)
    SELECT per.match_id, player_name, team_id, (r * 6)::DOUBLE / nullif(b, 0) AS economy, match_rate FROM per
    JOIN (SELECT match_id, (sum(r) * 6)::DOUBLE / nullif(sum(b), 0) AS match_rate FROM per GROUP BY 1) m ON per.match_id = m.match_id
    JOIN dim_player p ON per.player_id = p.player_id"""
)(reports.control)
_over(
    """WITH recent AS (SELECT * FROM (SELECT f.match_id, team_id, match_format, row_number() OVER
        (PARTITION BY team_id, match_format ORDER BY match_date DESC, f.match_id DESC) AS back
        FROM fact_team_match_summary f JOIN dim_match d ON f.match_id = d.match_id) WHERE back <= 5),
    holders AS (SELECT b.team_id, match_format, batting_position, back, arg_min(player_id, match_innings_sequence) AS who
        FROM fact_batting b JOIN recent r ON b.match_id = r.match_id AND b.team_id = r.team_id GROUP BY 1, 2, 3, 4)
    SELECT team_name, h.match_format, h.batting_position, player_name AS incumbent_name,
        count(*) FILTER (WHERE h.who = n.who) AS held_of_last_five
    FROM holders h JOIN holders n ON n.back = 1 AND h.team_id = n.team_id AND h.match_format = n.match_format
        AND h.batting_position = n.batting_position
    JOIN dim_team t ON h.team_id = t.team_id JOIN dim_player p ON n.who = p.player_id GROUP BY 1, 2, 3, 4"""
)(reports.incumbents)
_over(
    """WITH s AS (SELECT series_id, series_name, series_match_number, series_scheduled_matches,
        sum(CASE WHEN winning_team = least(home_team, away_team) THEN 1 ELSE 0 END) OVER w AS wins_a,
        sum(CASE WHEN winning_team = greatest(home_team, away_team) THEN 1 ELSE 0 END) OVER w AS wins_b
        FROM dim_match d JOIN int_match_header h ON d.source_file_name = h.source_file_name
        JOIN int_result r ON d.source_file_name = r.source_file_name WHERE series_id IS NOT NULL
        WINDOW w AS (PARTITION BY series_id ORDER BY series_match_number ROWS UNBOUNDED PRECEDING))
    SELECT series_id, series_name, series_match_number, wins_a::BIGINT AS wins_a, wins_b::BIGINT AS wins_b,
        (series_match_number - wins_a - wins_b)::BIGINT AS no_winner,
        series_scheduled_matches - series_match_number AS matches_left,
        CASE WHEN abs(wins_a - wins_b) > series_scheduled_matches - series_match_number THEN 'decided' ELSE 'live' END AS state FROM s"""
)(reports.series_state)
_over(
    """SELECT team_name, row_number() OVER w AS match_number, f.match_id, total_runs,
    total_runs - lag(total_runs) OVER w AS change,
    (sum(CASE WHEN won THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING))::BIGINT AS wins_so_far
    FROM fact_team_match_summary f JOIN dim_match d ON f.match_id = d.match_id JOIN dim_team t ON f.team_id = t.team_id
    WINDOW w AS (PARTITION BY team_name ORDER BY match_date, f.match_id)"""
)(reports.team_form)


# --- metrics -----------------------------------------------------------------------------------
def _metric(fact: str, names: list[str], by: list[str], sql: str) -> None:
    """All metrics of a fact at once, by a choice of dimensions."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        measured = plain(metric(corpus(spark, folder), [f"{fact}.{n}" for n in names], by=by))
        spread = [n for n in names if n.endswith("_stddev")]
        return measured.withColumns({n: F.round(n, 6) for n in spread}) if spread else measured

    run.__name__ = f"metric_{fact}"
    REGISTRY.add(expected(sql))(run)


_metric(
    "fact_batting",
    list(METRICS["fact_batting"]),
    ["dim_match.match_format", "bowling_teams.team_name"],
    f"""SELECT match_format, team_name, sum(runs)::BIGINT AS total_runs, sum(balls_faced)::BIGINT AS total_balls_faced,
    sum(fours)::BIGINT AS total_fours, sum(sixes)::BIGINT AS total_sixes, count(*) FILTER (WHERE {_OUT}) AS dismissals,
    count(runs) AS innings_count, sum(runs)::DOUBLE / nullif(count(*) FILTER (WHERE {_OUT}), 0) AS batting_average,
    sum(runs)::DOUBLE / nullif(sum(balls_faced), 0) * 100 AS batting_strike_rate
    FROM fact_batting b JOIN dim_match d ON b.match_id = d.match_id JOIN dim_team t ON b.opposition_team_id = t.team_id
    GROUP BY 1, 2""",
)
_metric(
    "fact_bowling",
    list(METRICS["fact_bowling"]),
    ["bowling_teams.team_name", "dim_match.competition_name"],
    f"""SELECT team_name, competition_name, sum(runs_conceded)::BIGINT AS total_runs_conceded, sum(wickets)::BIGINT AS total_wickets,
    {_OVERS} AS total_overs_naive, sum(runs_conceded)::DOUBLE / nullif({_OVERS}, 0) AS economy_rate,
    sum(runs_conceded)::DOUBLE / nullif(sum(wickets), 0) AS bowling_average, sum({_BALLS})::BIGINT AS balls_bowled,
    (sum(runs_conceded) * 6)::DOUBLE / nullif(sum({_BALLS}), 0) AS economy_exact
    FROM fact_bowling b JOIN dim_match d ON b.match_id = d.match_id JOIN dim_team t ON b.team_id = t.team_id GROUP BY 1, 2""",
)
_metric(
    "dim_match",
    ["matches_count"],
    ["home_teams.team_name", "winning_teams.team_name", "dim_match.result_type"],
    """SELECT h.team_name AS home_teams__team_name, w.team_name AS winning_teams__team_name,
    result_type AS dim_match__result_type, count(match_date) AS matches_count
    FROM dim_match d JOIN dim_team h ON home_team_id = h.team_id LEFT JOIN dim_team w ON winning_team_id = w.team_id
    GROUP BY 1, 2, 3""",
)
_metric(
    "fact_partnership",
    list(METRICS["fact_partnership"]),
    ["batting_teams.team_name", "fact_partnership.partnership_number", "fact_partnership.is_unbroken"],
    """SELECT team_name, partnership_number, is_unbroken, sum(partnership_runs)::BIGINT AS total_partnership_runs,
    sum(partnership_runs)::DOUBLE / count(partnership_runs) AS avg_partnership_runs
    FROM fact_partnership f JOIN dim_team t ON f.team_id = t.team_id GROUP BY 1, 2, 3""",
)
_metric(
    "fact_fielding",
    list(METRICS["fact_fielding"]),
    ["fielders.player_name", "bowlers.player_name"],
    """SELECT f.player_name AS fielders__player_name, b.player_name AS bowlers__player_name,
    count(*) FILTER (WHERE dismissal_type = 'CAUGHT') AS total_catches,
    count(*) FILTER (WHERE dismissal_type = 'STUMPED') AS total_stumpings FROM fact_fielding x
    LEFT JOIN dim_player f ON fielder_id = f.player_id LEFT JOIN dim_player b ON bowler_id = b.player_id GROUP BY 1, 2""",
)
_metric(
    "fact_player_match_summary",
    list(METRICS["fact_player_match_summary"]),
    ["summary_players.player_name", "dim_match.match_format"],
    f"""SELECT player_name, match_format, matches_played, sum_total_runs, sum_dismissals, sum_centuries, sum_five_wicket_hauls,
    {_BAT_POOL} AS pooled_batting_match_factor, batting_match_factor_stddev, {_BOWL_POOL} AS pooled_bowling_match_factor,
    bowling_match_factor_stddev, {_BAT_POOL} + {_BOWL_POOL} AS all_rounder_composite FROM (SELECT player_name, match_format,
        count(f.match_id) AS matches_played, sum(total_runs)::BIGINT AS sum_total_runs, sum(dismissals)::BIGINT AS sum_dismissals,
        sum(centuries)::BIGINT AS sum_centuries, sum(five_wicket_hauls)::BIGINT AS sum_five_wicket_hauls, {_SUMS},
        round(stddev_samp(batting_match_factor), 6) AS batting_match_factor_stddev,
        round(stddev_samp(bowling_match_factor), 6) AS bowling_match_factor_stddev
        FROM fact_player_match_summary f JOIN dim_match d ON f.match_id = d.match_id
        JOIN dim_player p ON f.player_id = p.player_id GROUP BY 1, 2)""",
)
_metric(
    "fact_team_match_summary",
    list(METRICS["fact_team_match_summary"]),
    ["summary_teams.team_name", "summary_opposition_teams.team_name", "fact_team_match_summary.batted_first"],
    """SELECT t.team_name AS summary_teams__team_name, o.team_name AS summary_opposition_teams__team_name,
    batted_first AS fact_team_match_summary__batted_first, count(match_id) AS matches_played,
    count(*) FILTER (WHERE won) AS wins, sum(total_runs)::BIGINT AS sum_total_runs,
    sum(total_wickets_taken)::BIGINT AS sum_total_wickets_taken FROM fact_team_match_summary f
    JOIN dim_team t ON f.team_id = t.team_id JOIN dim_team o ON f.opposition_team_id = o.team_id GROUP BY 1, 2, 3""",
)


def _metric_batting_and_bowling(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of two facts side by side, by each one's own player and the format."""
    asked = ["fact_batting.total_runs", "fact_batting.innings_count", "fact_bowling.total_wickets", "fact_fielding.total_catches"]
    return plain(metric(corpus(spark, folder), asked, by=["players.player_name", "dim_match.match_format"]))


_metric_batting_and_bowling.__name__ = "metric_batting_and_bowling"
REGISTRY.add(
    expected(
        """SELECT player_name, match_format, any_value(total_runs) AS total_runs, any_value(innings_count) AS innings_count,
        any_value(total_wickets) AS total_wickets, any_value(total_catches) AS total_catches FROM (
            SELECT player_name, match_format, sum(runs)::BIGINT AS total_runs, count(runs) AS innings_count,
                NULL::BIGINT AS total_wickets, NULL::BIGINT AS total_catches
            FROM fact_batting f JOIN dim_match d ON f.match_id = d.match_id LEFT JOIN dim_player p ON f.player_id = p.player_id GROUP BY 1, 2
            UNION ALL SELECT player_name, match_format, NULL, NULL, sum(wickets)::BIGINT, NULL
            FROM fact_bowling f JOIN dim_match d ON f.match_id = d.match_id LEFT JOIN dim_player p ON f.player_id = p.player_id GROUP BY 1, 2
            UNION ALL SELECT player_name, match_format, NULL, NULL, NULL, sum(CASE WHEN dismissal_type = 'CAUGHT' THEN 1 ELSE 0 END)::BIGINT
            FROM fact_fielding f JOIN dim_match d ON f.match_id = d.match_id LEFT JOIN dim_player p ON f.fielder_id = p.player_id GROUP BY 1, 2)
        GROUP BY 1, 2"""
    )
)(_metric_batting_and_bowling)


class _Half:
    """The rows of the player summary from every other match, as a batch would bring them."""

    def __init__(self, tables: Scorecards, odd: bool):
        self.tables, self.odd = tables, odd

    def __getattr__(self, table: str) -> DataFrame:
        frame = getattr(self.tables, table)
        return frame.where((F.crc32("match_id") % 2 == 1) == F.lit(self.odd)) if table.startswith("fact_") else frame


def metric_from_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Averages, pooled factors and their spread by player and format: from rollups of two halves that are merged, at a
    finer grain than is asked; no fact is read for the answer."""
    cards, summary = corpus(spark, folder), ["summary_players.player_name", "dim_match.match_format", "summary_teams.team_name"]
    rollups = Rollups(cards, f"{shared_dir(spark)}/rollups-{uuid4().hex}")
    rollups.add("fact_batting", ["batters.player_name", "dim_match.match_format", "bowling_teams.team_name"])
    halves = [states_of(_Half(cards, odd), "fact_player_match_summary", summary) for odd in (False, True)]
    rollups.add("fact_player_match_summary", summary, merged_states(halves))
    asked = [f"fact_batting.{m}" for m in ("total_runs", "dismissals", "batting_average", "batting_strike_rate")]
    asked += [f"fact_player_match_summary.{m}" for m in METRICS["fact_player_match_summary"]]
    found = plain(metric(rollups, asked, by=["players.player_name", "dim_match.match_format"]))
    return found.withColumns({c: F.round(c, 6) for c in found.columns if c.endswith("_stddev")})


REGISTRY.add(
    expected(
        f"""SELECT coalesce(s.player_name, b.player_name) AS player_name, coalesce(s.match_format, b.match_format) AS match_format,
        total_runs, b.dismissals, batting_average, batting_strike_rate, matches_played, sum_total_runs, sum_dismissals, sum_centuries,
        sum_five_wicket_hauls, {_BAT_POOL} AS pooled_batting_match_factor, batting_match_factor_stddev,
        {_BOWL_POOL} AS pooled_bowling_match_factor, bowling_match_factor_stddev, {_BAT_POOL} + {_BOWL_POOL} AS all_rounder_composite
        FROM (SELECT player_name, match_format, count(f.match_id) AS matches_played, sum(total_runs)::BIGINT AS sum_total_runs,
            sum(dismissals)::BIGINT AS sum_dismissals, sum(centuries)::BIGINT AS sum_centuries,
            sum(five_wicket_hauls)::BIGINT AS sum_five_wicket_hauls, {_SUMS},
            round(stddev_samp(batting_match_factor), 6) AS batting_match_factor_stddev,
            round(stddev_samp(bowling_match_factor), 6) AS bowling_match_factor_stddev
            FROM fact_player_match_summary f JOIN dim_match d ON f.match_id = d.match_id
            JOIN dim_player p ON f.player_id = p.player_id GROUP BY 1, 2) s
        FULL JOIN (SELECT player_name, match_format, sum(runs)::BIGINT AS total_runs, count(*) FILTER (WHERE {_OUT}) AS dismissals,
            sum(runs)::DOUBLE / nullif(count(*) FILTER (WHERE {_OUT}), 0) AS batting_average,
            sum(runs)::DOUBLE / nullif(sum(balls_faced), 0) * 100 AS batting_strike_rate
            FROM fact_batting f JOIN dim_match d ON f.match_id = d.match_id JOIN dim_player p ON f.player_id = p.player_id GROUP BY 1, 2) b
        ON s.player_name = b.player_name AND s.match_format IS NOT DISTINCT FROM b.match_format"""
    )
)(metric_from_rollup)


def report_reloaded(spark: SparkSession, folder: str) -> DataFrame:
    """The batting averages asked for twice: the second time they are read, not made."""
    cards, results = corpus(spark, folder), Results(spark, f"{shared_dir(spark)}/results-{uuid4().hex}")
    results.reload(reports.batting_averages(cards))
    before = len(results.manifests.names("data"))
    again = results.reload(reports.batting_averages(cards))
    return plain(again).withColumn("made_again", F.lit(len(results.manifests.names("data")) != before))


REGISTRY.add(
    expected(
        f"""SELECT player_name, sum(runs)::BIGINT AS total_runs, count(*) FILTER (WHERE {_OUT}) AS dismissals,
        sum(runs)::DOUBLE / nullif(count(*) FILTER (WHERE {_OUT}), 0) AS batting_average,
        sum(runs)::DOUBLE / nullif(sum(balls_faced), 0) * 100 AS batting_strike_rate, false AS made_again
        FROM fact_batting b JOIN dim_player p ON b.player_id = p.player_id GROUP BY 1"""
    )
)(report_reloaded)


def sql_on_views(t: Scorecards) -> DataFrame:
    """Plain SQL on the views: every match with the names its foreign keys stand for, one join per registered link."""
    register_views(t)
    named = {"home_teams": "home_team", "away_teams": "away_team", "winning_teams": "winning_team", "motm_players": "man_of_the_match"}
    picked, joins = ["match_date"], []
    for key, role in LINKS["dim_match"].items():
        dimension, id_column = ROLES[role]
        picked.append(f"{role}.{dimension.removeprefix('dim_')}_name AS {named[role]}")
        joins.append(f"LEFT JOIN {role} ON dim_match.{key} = {role}.{id_column}")
    return t.spark.sql(f"SELECT {', '.join(picked)} FROM dim_match {' '.join(joins)}")


_over(
    """SELECT match_date, home_team, away_team, winning_team, man_of_the_match
    FROM int_match_header h JOIN int_result r ON h.source_file_name = r.source_file_name"""
)(sql_on_views)


# --- data checks of the built tables -----------------------------------------------------------
# Fixed list, stated beside the checks and not made from them: check, table, columns (by semicolons).
CHECKS = """
not_null stg_blocks source_file_name; source_file_row_number; block_id
not_null int_match_header source_file_name; home_team; away_team; match_date
not_null int_result source_file_name
not_null int_innings_totals source_file_name; team; team_innings_number; match_innings_sequence; total_runs; wickets_lost
not_null int_batting_rows source_file_name; batting_team; player_name; dismissal_type; runs; balls_faced
not_null int_bowling_rows source_file_name; bowling_team; player_name; overs; runs_conceded; wickets
not_null int_fow_rows source_file_name; team; wicket_number; cumulative_score
not_null int_batting_match_factor source_file_name; player_name
not_null int_bowling_match_factor source_file_name; player_name
not_null int_fielding_dismissals source_file_name; team; dismissal_type
not_null int_partnerships source_file_name; team; partnership_number; partnership_runs
not_null dim_team team_id; team_name
not_null dim_player player_id; player_name
not_null dim_match match_id; source_file_name; home_team_id; away_team_id; winning_team_id; series_id
not_null fact_batting match_id; player_id; team_id
not_null fact_bowling match_id; player_id; team_id
not_null fact_fow match_id; team_id
not_null fact_partnership match_id; partnership_number; partnership_runs; is_unbroken
not_null fact_fielding match_id; batter_id; dismissal_type
not_null fact_player_match_summary match_id; player_id; dismissals; centuries; five_wicket_hauls
not_null fact_team_match_summary match_id; team_id; batted_first
unique int_match_header source_file_name
unique int_result source_file_name
unique dim_team team_id; team_name
unique dim_player player_id; player_name
unique dim_match match_id; source_file_name
unique_combination fact_partnership match_id,match_innings_sequence,partnership_number
accepted_values stg_blocks block_type
accepted_values stg_row_classification row_type
accepted_values int_match_header match_format
accepted_values int_result result_type; result_margin_type
accepted_values int_innings_totals team_innings_number
accepted_values int_batting_rows dismissal_type
accepted_values int_fow_rows wicket_number
accepted_values int_fielding_dismissals dismissal_type
accepted_values fact_fielding dismissal_type
accepted_range int_batting_match_factor batting_match_factor
accepted_range int_bowling_match_factor bowling_match_factor
expression_is_true dim_match series numbers in order; domestic has no series
relationships fact_batting match_id; player_id; team_id
relationships fact_bowling match_id; player_id
relationships fact_fow match_id; team_id
relationships fact_partnership match_id
relationships fact_fielding match_id; batter_id
relationships fact_player_match_summary match_id; player_id
relationships fact_team_match_summary match_id; team_id
relationships dim_match home_team_id; away_team_id
same_row_count stg_blocks source_file_row_number
same_row_count stg_row_classification source_file_row_number
fow_never_falls int_fow_rows cumulative_score
stands_sum_to_total int_partnerships partnership_runs
wickets_reconcile fact_bowling wickets
wickets_reconcile int_bowling_rows wickets per match
one_batted_first fact_team_match_summary batted_first
one_line int_match_header header lines
one_line int_result result lines
one_of_each int_innings_totals header, extras, total
rows_lost int_batting_rows source_file_name
rows_lost int_bowling_rows source_file_name
files_lost dim_match source_file_name
repeated_name int_batting_rows player_name
shared_name fact_player_match_summary player_id
"""


def _failing() -> str:
    """The planted faults: two unknown formats, unknown results and unclassified dismissals."""
    rows = {
        ("accepted_values", "int_match_header", "match_format"): "SELECT count(*) FROM int_match_header WHERE match_format = 'UNKNOWN'",
        ("accepted_values", "int_result", "result_type"): "SELECT count(*) FROM int_result WHERE result_type = 'UNKNOWN'",
        ("not_null", "int_batting_rows", "dismissal_type"): "SELECT count(*) FROM int_batting_rows WHERE dismissal_type IS NULL",
        ("wickets_reconcile", "fact_bowling", "wickets"): """SELECT CASE WHEN (SELECT sum(wickets) FROM int_bowling_rows) <>
            (SELECT count(*) FROM int_batting_rows WHERE dismissal_type IN ('CAUGHT', 'STUMPED', 'BOWLED', 'LBW')) THEN 1 ELSE 0 END""",
        ("wickets_reconcile", "int_bowling_rows", "wickets per match"): """SELECT count(*) FROM
            (SELECT source_file_name AS f, sum(wickets) AS w FROM int_bowling_rows GROUP BY 1) a JOIN
            (SELECT source_file_name AS g, count(*) FILTER (WHERE dismissal_type IN ('CAUGHT', 'STUMPED', 'BOWLED', 'LBW')) AS d
                FROM int_batting_rows GROUP BY 1) b ON f = g WHERE w <> d""",
        ("one_line", "int_result", "result lines"): "SELECT count(*) FROM int_result WHERE man_of_the_match IS NULL",
        ("shared_name", "fact_player_match_summary", "player_id"): """SELECT count(*) FROM (SELECT match_id, player_id
            FROM fact_player_match_summary GROUP BY 1, 2 HAVING count(*) > 1)""",
        ("repeated_name", "int_batting_rows", "player_name"): """SELECT count(*) FROM (SELECT 1 FROM int_batting_rows
            GROUP BY source_file_name, match_innings_sequence, player_name HAVING count(*) > 1)""",
    }
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"check\", '{t}' AS table_name, '{k}' AS column_name, ({sql})::BIGINT AS failures"
        for (c, t, k), sql in rows.items()
    )


def dq_scorecards(spark: SparkSession, folder: str) -> DataFrame:
    """Every check of the built tables with its failures; a check that is not run is a missing row."""
    found = quality.report(checks.all_checks(corpus(spark, folder)))
    return found.groupBy("check", "table_name", "column_name").agg(F.max("failures").alias("failures"))


def dq_sql() -> str:
    """Every check by name, and the failures of those that find something."""
    listed = []
    for line in CHECKS.strip().splitlines():
        check, table, columns = line.split(maxsplit=2)
        listed += [f"('{check}', '{table}', '{column}')" for column in columns.split("; ")]
    return f"""SELECT c.*, coalesce(f.failures, 0)::BIGINT AS failures
        FROM (VALUES {", ".join(listed)}) c("check", table_name, column_name)
        LEFT JOIN ({_failing()}) f USING ("check", table_name, column_name)"""


REGISTRY.add(expected(dq_sql()))(dq_scorecards)
