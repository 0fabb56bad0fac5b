"""The data checks of the model: schema checks and reconciliations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.operators import quality as q
from matchbook.operators.quality import Check
from matchbook.plans.staging import FILE, MERGE, ROW, by_file

BLOCK_TYPES = ["match_header", "batting", "bowling", "result"]
ROW_TYPES = [
    "blank", "divider", "match_header_data", "batting_header", "batting_data", "extras", "total",
    "bowling_header", "bowling_data", "fow_header", "fow_data", "result_data",
]
FORMATS = ["TEST", "ODI", "T20", "T20I", "FC_LEAGUE", "LIST_A", "HUNDRED"]
DISMISSALS = ["CAUGHT", "BOWLED", "LBW", "RUN_OUT", "STUMPED", "NOT_OUT", "DID_NOT_BAT", "RETIRED_HURT"]
CREDITED = ["CAUGHT", "STUMPED", "BOWLED", "LBW"]
INNINGS = [FILE, "match_innings_sequence"]

_NOT_NULL = {
    "stg_blocks": [FILE, ROW, "block_id"],
    "int_match_header": [FILE, "home_team", "away_team", "match_date"],
    "int_result": [FILE],
    "int_innings_totals": [
        FILE, "team", "team_innings_number", "match_innings_sequence", "total_runs", "wickets_lost",
    ],
    "int_batting_rows": [FILE, "batting_team", "player_name", "dismissal_type"],
    "int_bowling_rows": [FILE, "bowling_team", "player_name", "overs", "runs_conceded", "wickets"],
    "int_fow_rows": [FILE, "team", "wicket_number", "cumulative_score"],
    "int_batting_match_factor": [FILE, "player_name"],
    "int_bowling_match_factor": [FILE, "player_name"],
    "int_fielding_dismissals": [FILE, "team", "dismissal_type"],
    "int_partnerships": [FILE, "team", "partnership_number", "partnership_runs"],
    "dim_team": ["team_id", "team_name"],
    "dim_player": ["player_id", "player_name"],
    "dim_match": ["match_id", FILE, "home_team_id", "away_team_id"],
    "fact_batting": ["match_id", "player_id", "team_id"],
    "fact_bowling": ["match_id", "player_id", "team_id"],
    "fact_fow": ["match_id", "team_id"],
    "fact_partnership": ["match_id", "partnership_number", "partnership_runs", "is_unbroken"],
    "fact_fielding": ["match_id", "batter_id", "dismissal_type"],
    "fact_player_match_summary": ["match_id", "player_id", "dismissals", "centuries", "five_wicket_hauls"],
    "fact_team_match_summary": ["match_id", "team_id", "batted_first"],
}
_UNIQUE = {
    "int_match_header": [[FILE]],
    "int_result": [[FILE]],
    "dim_team": [["team_id"], ["team_name"]],
    "dim_player": [["player_id"], ["player_name"]],
    "dim_match": [["match_id"], [FILE]],
    "fact_partnership": [["match_id", "match_innings_sequence", "partnership_number"]],
}
_MATCH_FACTS = [
    "fact_batting", "fact_bowling", "fact_fow", "fact_partnership", "fact_fielding",
    "fact_player_match_summary", "fact_team_match_summary",
]


def _near(t, table: str) -> tuple[DataFrame, list[str]]:
    """The rows of a fact, and the file as a further key of its match where they lie together by it."""
    rows, at = by_file(t, table)
    return rows, [at] if at == FILE else []


def _meet(t) -> str:
    """How rows meet by file: as the tables were built, sorted in tables read from plain folders."""
    return getattr(t, "meet", MERGE)


def schema_checks(t) -> list[Check]:
    def rows(table: str):
        return getattr(t, table)

    warn = {"severity": "warn"}
    out = [q.not_null(rows(table), table, c) for table, columns in _NOT_NULL.items() for c in columns]
    for table, keys in _UNIQUE.items():
        near, files = _near(t, table) if table in _MATCH_FACTS else (rows(table), [])
        out += [q.unique(near, table, *columns, near=files) for columns in keys]
    batted, wins = ~F.col("did_not_bat"), F.col("result_type") == "WIN"
    in_series = F.col("match_format").isin("TEST", "ODI", "T20I")
    out += [
        q.not_null(t.int_batting_rows, "int_batting_rows", "runs", where=batted),
        q.not_null(t.int_batting_rows, "int_batting_rows", "balls_faced", where=batted),
        q.not_null(t.dim_match, "dim_match", "winning_team_id", where=wins),
        q.not_null(t.dim_match, "dim_match", "series_id", where=in_series),
        q.accepted_values(t.stg_blocks, "stg_blocks", "block_type", BLOCK_TYPES, **warn),
        q.accepted_values(t.stg_row_classification, "stg_row_classification", "row_type", ROW_TYPES),
        q.accepted_values(t.int_match_header, "int_match_header", "match_format", FORMATS, **warn),
        q.accepted_values(
            t.int_result, "int_result", "result_type", ["WIN", "DRAW", "TIE", "NO_RESULT"], **warn
        ),
        q.accepted_values(
            t.int_result, "int_result", "result_margin_type", ["RUNS", "WICKETS", "INNINGS"], **warn
        ),
        q.accepted_values(t.int_innings_totals, "int_innings_totals", "team_innings_number", [1, 2]),
        q.accepted_values(t.int_batting_rows, "int_batting_rows", "dismissal_type", DISMISSALS, **warn),
        q.accepted_values(t.int_fow_rows, "int_fow_rows", "wicket_number", list(range(1, 11))),
        q.accepted_values(
            t.int_fielding_dismissals, "int_fielding_dismissals", "dismissal_type", ["CAUGHT", "STUMPED"]
        ),
        q.accepted_values(t.fact_fielding, "fact_fielding", "dismissal_type", ["CAUGHT", "STUMPED"]),
        q.accepted_range(t.int_batting_match_factor, "int_batting_match_factor", "batting_match_factor", 0, 50),
        q.accepted_range(
            t.int_bowling_match_factor, "int_bowling_match_factor", "bowling_match_factor", 0, 50, inclusive=False
        ),
        q.expression_true(
            t.dim_match,
            "dim_match",
            "series numbers in order",
            (F.col("series_match_number") <= F.col("series_matches_played"))
            & (F.col("series_matches_played") <= F.col("series_scheduled_matches")),
            where=F.col("series_id").isNotNull(),
        ),
        q.expression_true(
            t.dim_match, "dim_match", "domestic has no series", F.col("series_id").isNull(), where=~in_series
        ),
    ]
    for f in _MATCH_FACTS:
        near, files = _near(t, f)
        out.append(q.relationship(near, f, "match_id", t.dim_match.hint(_meet(t) if files else MERGE), "match_id", near=files))
    out += [
        q.relationship(rows(f), f, "player_id", t.dim_player, "player_id")
        for f in ("fact_batting", "fact_bowling", "fact_player_match_summary")
    ]
    out += [
        q.relationship(rows(f), f, "team_id", t.dim_team, "team_id")
        for f in ("fact_batting", "fact_fow", "fact_team_match_summary")
    ]
    out += [
        q.relationship(t.dim_match, "dim_match", c, t.dim_team, "team_id") for c in ("home_team_id", "away_team_id")
    ]
    out.append(q.relationship(t.fact_fielding, "fact_fielding", "batter_id", t.dim_player, "player_id"))
    return out


def _per_file(t) -> DataFrame:
    """One row per file: its lines in the raw table, in blocks and with their roles, and the rows made of them."""
    kinds = ("match_header_data", "result_data", "batting_data", "bowling_data")
    of_kind = [F.count_if(F.col("row_type") == k).alias(k) for k in kinds]
    rows = F.count(F.lit(1))
    return q.side_by_side(
        FILE,
        q.numbered(t.scorecard_lines, FILE, ROW, "source_lines"),
        q.numbered(t.stg_blocks, FILE, ROW, "block_lines"),
        q.numbered(t.stg_row_classification, FILE, ROW, "lines", *of_kind),
        t.int_batting_rows.groupBy(FILE).agg(rows.alias("batting_rows"), _credited().alias("fallen")),
        t.int_bowling_rows.groupBy(FILE).agg(rows.alias("bowling_rows"), F.sum("wickets").alias("taken")),
        t.dim_match.groupBy(FILE).agg(rows.alias("matches")),
    )


def _credited() -> Column:
    return F.count_if(F.col("dismissal_type").isin(CREDITED))


def reconciliations(t, files: DataFrame | None = None) -> list[Check]:
    """Whole-table agreements between layers. ``files`` is ``_per_file``, if it is at hand."""
    files, meet, by = _per_file(t) if files is None else files, _meet(t), {"shared": "files"}
    fow_key = [FILE, "team", "team_innings_number"]
    score, wicket = F.col("cumulative_score"), F.col("wicket_number")
    # Neighbouring wickets meet by number; a wicket above 1 without a predecessor is a gap.
    earlier = t.int_fow_rows.select(
        *fow_key, (wicket + 1).alias("wicket_number"), score.alias("_before")
    )
    neighbours = t.int_fow_rows.join(earlier.hint(meet), [*fow_key, "wicket_number"], "left")
    first = t.int_fow_rows.groupBy(*fow_key).agg(F.min("wicket_number").alias("_first"))
    steps = neighbours.join(first.hint(meet), fow_key).where(
        (F.col("_before") > score) | (F.col("_before").isNull() & (wicket > F.col("_first")))
    )
    stands = t.int_partnerships.groupBy(*INNINGS).agg(F.sum("partnership_runs").alias("_stands"))
    off = stands.join(t.int_innings_totals.hint(meet), INNINGS).where(F.col("_stands") != F.col("total_runs"))
    taken = t.fact_bowling.agg(F.sum("wickets").alias("_taken"))
    fallen = t.int_batting_rows.agg(_credited().alias("_fallen"))
    totals = taken.crossJoin(fallen).where(F.col("_taken") != F.col("_fallen"))
    sides, near = _near(t, "fact_team_match_summary")
    first_sides = sides.where("batted_first").groupBy(*near, "match_id").count().where("count <> 1")
    return [
        q.same_rows_counted(files, "source_lines", "block_lines", "stg_blocks", ROW, **by),
        q.same_rows_counted(files, "source_lines", "lines", "stg_row_classification", ROW, **by),
        Check("fow_never_falls", "int_fow_rows", "cumulative_score", steps),
        Check("stands_sum_to_total", "int_partnerships", "partnership_runs", off),
        Check("wickets_reconcile", "fact_bowling", "wickets", totals),
        Check("wickets_reconcile", "int_bowling_rows", "wickets per match", files, "warn", F.col("taken") != F.col("fallen"), **by),
        Check("one_batted_first", "fact_team_match_summary", "batted_first", first_sides),
    ]


def parsing_checks(t, files: DataFrame | None = None) -> list[Check]:
    """Faults the positional rules would hide: wrong line counts and rows lost at inner joins."""
    files, by = _per_file(t) if files is None else files, {"shared": "files"}
    lines = t.stg_row_classification

    def two_lines(row_type: str, table: str, label: str) -> Check:
        return Check("one_line", table, label, files, "warn", F.col("lines").isNotNull() & (F.col(row_type) != 2), **by)

    kinds = ("batting_header", "extras", "total")
    per_block = (
        lines.where(F.col("block_type") == "batting")
        .groupBy(FILE, "block_id")
        .agg(*[F.count_if(F.col("row_type") == k).alias(k) for k in kinds])
        .where(" OR ".join(f"{k} <> 1" for k in kinds))
    )

    def lost(row_type: str, table: str, kept: str) -> Check:
        missing = (F.col(row_type) > 0) & (F.col(row_type) != F.coalesce(kept, F.lit(0)))
        return Check("rows_lost", table, FILE, files, bad=missing, **by)

    unmatched = F.col("source_lines").isNotNull() & F.col("matches").isNull()
    repeated = (
        t.int_batting_rows.groupBy(*INNINGS, "player_name").count().where("count > 1")
    )
    players, near = _near(t, "fact_player_match_summary")
    shared = players.groupBy(*near, "match_id", "player_id").count().where("count > 1")
    return [
        two_lines("match_header_data", "int_match_header", "header lines"),
        two_lines("result_data", "int_result", "result lines"),
        Check("one_of_each", "int_innings_totals", "header, extras, total", per_block, "warn"),
        lost("batting_data", "int_batting_rows", "batting_rows"),
        lost("bowling_data", "int_bowling_rows", "bowling_rows"),
        Check("files_lost", "dim_match", FILE, files, bad=unmatched, **by),
        Check("repeated_name", "int_batting_rows", "player_name", repeated, "warn"),
        Check("shared_name", "fact_player_match_summary", "player_id", shared, "warn"),
    ]


def table_checks(t) -> list[Check]:
    """The checks that compare rows or tables; what they need of each file is summed up once."""
    files = _per_file(t)
    return reconciliations(t, files) + parsing_checks(t, files)


def all_checks(t) -> list[Check]:
    return schema_checks(t) + table_checks(t)
