"""Table schemas that the pipeline asserts at its boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_LINES = T.StructType(
    [
        T.StructField("raw_line", T.StringType()),
        T.StructField("source_file_name", T.StringType()),
        T.StructField("source_file_row_number", T.LongType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)

# Columns of each modelled table, in order. Types follow from the plan and are asserted in tests.
COLUMNS = {
    "stg_blocks": "raw_line source_file_name source_file_row_number loaded_at is_marker_line "
    "block_id block_type",
    "stg_row_classification": "raw_line source_file_name source_file_row_number loaded_at "
    "is_marker_line block_id block_type row_type",
    "int_match_header": "source_file_name home_team away_team match_date match_format "
    "competition_name competition_variant",
    "int_result": "source_file_name result_type winning_team result_margin_value "
    "result_margin_type man_of_the_match",
    "int_innings_totals": "source_file_name block_id team team_innings_number "
    "match_innings_sequence total_runs wickets_lost overs_faced extras_total",
    "int_batting_rows": "source_file_name batting_team team_innings_number "
    "match_innings_sequence batting_position player_name did_not_bat dismissal_type "
    "dismissal_detail runs balls_faced fours sixes",
    "int_bowling_rows": "source_file_name bowling_team team_innings_number "
    "match_innings_sequence bowling_position player_name overs dots_bowled maidens "
    "runs_conceded wickets economy",
    "int_fow_rows": "source_file_name team team_innings_number match_innings_sequence "
    "wicket_number cumulative_score",
    "int_partnerships": "source_file_name team team_innings_number match_innings_sequence "
    "partnership_number partnership_runs is_unbroken",
    "int_fielding_dismissals": "source_file_name team team_innings_number "
    "match_innings_sequence batter_name dismissal_type caught_and_bowled fielder_name "
    "fielder_match_count bowler_name bowler_match_count",
    "int_batting_match_factor": "source_file_name player_name own_runs own_dismissals "
    "own_batting_average peer_runs peer_dismissals peer_batting_average batting_match_factor",
    "int_bowling_match_factor": "source_file_name player_name own_runs_conceded own_wickets "
    "own_bowling_average peer_runs_conceded peer_wickets peer_bowling_average "
    "bowling_match_factor",
    "dim_team": "team_id team_name",
    "dim_player": "player_id player_name",
    "dim_match": "match_id source_file_name match_date home_team_id away_team_id "
    "competition_name competition_variant match_format innings_per_team winning_team_id "
    "result_type result_margin_type result_margin_value man_of_the_match_id series_id "
    "series_name series_match_number series_matches_played series_scheduled_matches",
    "fact_batting": "match_id player_id team_id opposition_team_id team_innings_number "
    "match_innings_sequence batting_position dismissal_type dismissal_detail did_not_bat runs "
    "balls_faced fours sixes strike_rate pct_of_team_innings_runs batting_match_factor",
    "fact_bowling": "match_id player_id team_id opposition_team_id team_innings_number "
    "match_innings_sequence overs maidens dots_bowled runs_conceded wickets economy "
    "pct_of_team_innings_wickets bowling_match_factor",
    "fact_fow": "match_id team_id team_innings_number match_innings_sequence wicket_number "
    "cumulative_score",
    "fact_partnership": "match_id team_id team_innings_number match_innings_sequence "
    "partnership_number partnership_runs is_unbroken",
    "fact_fielding": "match_id team_id team_innings_number match_innings_sequence fielder_id "
    "bowler_id batter_id dismissal_type caught_and_bowled",
    "fact_player_match_summary": "match_id player_id team_id opposition_team_id total_runs "
    "total_balls_faced total_fours total_sixes dismissals centuries half_centuries "
    "batting_match_factor total_overs_naive total_runs_conceded total_wickets "
    "five_wicket_hauls bowling_match_factor mf_bat_own_runs mf_bat_own_dismissals "
    "mf_bat_peer_runs mf_bat_peer_dismissals mf_bowl_own_runs_conceded mf_bowl_own_wickets "
    "mf_bowl_peer_runs_conceded mf_bowl_peer_wickets catches stumpings is_man_of_the_match",
    "fact_team_match_summary": "match_id team_id opposition_team_id total_runs "
    "total_wickets_lost total_overs_faced_naive total_runs_conceded total_wickets_taken "
    "batted_first won result_type result_margin_type result_margin_value",
}
COLUMNS = {table: names.split() for table, names in COLUMNS.items()}


def as_table(df: DataFrame, table: str, *more: str) -> DataFrame:
    """Project to the table's columns, in the declared order, and to those of ``more`` that the frame has."""
    return df.select(*COLUMNS[table], *[c for c in more if c in df.columns])
