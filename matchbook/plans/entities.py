"""Classified lines -> typed records: header, result, innings, batting, bowling, wickets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.functions.measures import balls_to_overs, blended_factor, ratio
from matchbook.functions.text import (
    dash_zero,
    first_match,
    fixed,
    other_of,
    part,
    rx,
    squeeze,
    to_dec,
    to_int,
)
from matchbook.operators.chunks import CHUNK, MAX_ROWS, chunk_numbered
from matchbook.operators.factor import leave_one_out
from matchbook.operators.pivot import numbered_lines_to_columns
from matchbook.operators.resolve import name_fragment, resolve_listed, resolve_suffixes
from matchbook.operators.scan import ordered_scan
from matchbook.operators.stands import cumulative_deltas
from matchbook.plans.staging import FILE, MERGE, ROW, of_type
from matchbook.schemas import as_table

# Competition wording -> format code, tested in this order.
FORMATS = [
    ("Test Match", "TEST"),
    ("One Day International", "ODI"),
    ("20 Over International", "T20I"),
    ("20 Over Trophy", "T20"),
    ("FC League", "FC_LEAGUE"),
    ("Challenge Trophy", "LIST_A"),
    ("100 Ball Trophy", "HUNDRED"),
]
LEAGUES = ["FC_LEAGUE", "T20", "LIST_A", "HUNDRED"]
INTERNATIONALS = ["TEST", "ODI", "T20I"]
DOT_BALL_FORMATS = ["T20", "T20I", "HUNDRED"]
NOT_A_DISMISSAL = ["NOT_OUT", "DID_NOT_BAT", "RETIRED_HURT"]
DATE_AT_END = r"[0-9]{1,2} [A-Za-z]+ [0-9]{4}$"
TOP_ORDER = 6
#: Rows of batters or bowlers of a file up to which a side's names are held as one list.
LISTED_ROWS = 1_000
NAME_WIDTH = 16
DETAIL_WIDTH = 26
INNINGS = [FILE, "match_innings_sequence"]


def is_dismissal(kind: Column) -> Column:
    """1 for a batter who was out, 0 otherwise (also for an unclassified row)."""
    return F.when(~kind.isin(NOT_A_DISMISSAL), 1).otherwise(0)


def match_header(lines: DataFrame) -> DataFrame:
    """One row per match: teams, date, competition, format."""
    content = of_type(lines, "match_header_data").select(FILE, ROW, F.trim("raw_line").alias("content"))
    top = numbered_lines_to_columns(content, [FILE], [ROW], "content", {1: "teams", 2: "competition"})
    competition, fmt = F.col("competition"), F.col("match_format")
    date_text = rx(competition, f"({DATE_AT_END})")
    title = F.trim(F.regexp_replace(competition, r"\s*-\s*" + DATE_AT_END, ""))

    def without(keyword: str) -> Column:
        return F.trim(F.regexp_replace(title, rf"\s*{keyword}\s*", " "))

    second = F.trim(part(title, " - ", 2))
    keyword_of = {code: text for text, code in FORMATS}
    named = top.withColumn(
        "match_format",
        first_match([(competition.ilike(f"%{text}%"), code) for text, code in FORMATS], "UNKNOWN"),
    )
    return named.select(
        FILE,
        F.trim(part("teams", " v ", 1)).alias("home_team"),
        F.trim(part("teams", " v ", 2)).alias("away_team"),
        F.coalesce(
            F.try_to_date(date_text, "d MMM yyyy"), F.try_to_date(date_text, "d MMMM yyyy")
        ).alias("match_date"),
        "match_format",
        first_match(
            [(fmt.isin(LEAGUES), F.trim(part(title, " - ", 1)))]
            + [(fmt == code, keyword_of[code]) for code in INTERNATIONALS]
        ).alias("competition_name"),
        first_match(
            [(fmt == "HUNDRED", F.nullif(second, F.lit(""))), (fmt.isin(LEAGUES), second)]
            + [(fmt == code, without(keyword_of[code])) for code in INTERNATIONALS]
        ).alias("competition_variant"),
    )


def result(lines: DataFrame) -> DataFrame:
    """One row per match: result type, winner, margin, man of the match."""
    content = of_type(lines, "result_data").select(FILE, ROW, F.trim("raw_line").alias("content"))
    top = numbered_lines_to_columns(content, [FILE], [ROW], "content", {1: "outcome", 2: "award"})
    outcome = F.col("outcome")
    won, by_innings = outcome.ilike("%won by%"), outcome.ilike("%won by an innings%")
    return top.select(
        FILE,
        first_match(
            [
                (won, "WIN"),
                (outcome.ilike("%draw%"), "DRAW"),
                (outcome.ilike("%tied%"), "TIE"),
                (outcome.ilike("%no result%"), "NO_RESULT"),
            ],
            "UNKNOWN",
        ).alias("result_type"),
        F.when(won, F.trim(rx(outcome, r"^(.*) won by"))).alias("winning_team"),
        to_int(
            first_match(
                [(by_innings, rx(outcome, r"and ([0-9]+) run")), (won, rx(outcome, r"won by ([0-9]+)"))]
            )
        ).alias("result_margin_value"),
        first_match(
            [
                (by_innings, "INNINGS"),
                (won & outcome.ilike("%run%"), "RUNS"),
                (won & outcome.ilike("%wicket%"), "WICKETS"),
            ]
        ).alias("result_margin_type"),
        F.trim(F.regexp_replace("award", r"^Man of the match:\s*", "")).alias("man_of_the_match"),
    )


def innings_totals(lines: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per team innings, from its header, extras and total lines in one aggregate."""
    raw, kind = F.col("raw_line"), F.col("row_type")
    last_number = rx(raw, r"([0-9]+)\s*$")

    def from_line(row_type: str, value: Column) -> Column:
        return F.max(F.when(kind == row_type, value))

    number = first_match([(raw.ilike("%1st Innings%"), 1), (raw.ilike("%2nd Innings%"), 2)])
    per_block = (
        of_type(lines, "batting_header", "extras", "total")
        .groupBy(FILE, "block_id")
        .agg(
            from_line("batting_header", F.trim(rx(raw, r"^(.*) - (1st|2nd) Innings"))).alias("team"),
            from_line("batting_header", number).alias("team_innings_number"),
            from_line("batting_header", F.lit(True)).alias("_has_header"),
            from_line("total", to_int(last_number)).alias("total_runs"),
            from_line("total", rx(raw, r"TOTAL:\s*\(([^,]+),")).alias("_detail"),
            from_line("total", to_dec(rx(raw, r"([0-9.]+)\s*overs"), 1)).alias("_overs"),
            from_line("total", to_int(rx(raw, r"([0-9]+)\s*balls"))).alias("_balls"),
            from_line("extras", to_int(last_number)).alias("extras_total"),
        )
        .where(F.col("_has_header"))
    )
    detail = F.col("_detail")
    ranked = ordered_scan(
        chunk_numbered(per_block, [FILE], "block_id", max_rows),
        [FILE],
        ["block_id"],
        number="match_innings_sequence",
    )
    return as_table(
        ranked.withColumn(
            "wickets_lost",
            F.when(detail.ilike("%all out%"), F.lit(10).cast("long")).otherwise(
                to_int(rx(detail, r"([0-9]+)"))
            ),
        ).withColumn("overs_faced", F.coalesce("_overs", balls_to_overs("_balls"))),
        "int_innings_totals",
    )


def _positions(lines: DataFrame, row_type: str, name: str, max_rows: int) -> DataFrame:
    """Number the lines of one type in each block. The (file, chunk) shuffle of staging serves."""
    if CHUNK not in lines.columns:
        lines = chunk_numbered(lines, [FILE], ROW, max_rows)
    return ordered_scan(of_type(lines, row_type), [FILE, "block_id"], [ROW], number=name)


def batting_rows(lines: DataFrame, innings: DataFrame, max_rows: int = MAX_ROWS, meet: str = MERGE) -> DataFrame:
    """One row per batting stint, did-not-bat rows included (their figures are NULL)."""
    absent = F.length("raw_line") == NAME_WIDTH
    detail = F.col("dismissal_detail")
    stats = squeeze(fixed("raw_line", NAME_WIDTH + DETAIL_WIDTH + 1))
    parsed = _positions(lines, "batting_data", "batting_position", max_rows).select(
        FILE,
        "block_id",
        "batting_position",
        F.trim(fixed("raw_line", 1, NAME_WIDTH)).alias("player_name"),
        absent.alias("did_not_bat"),
        F.when(~absent, F.trim(fixed("raw_line", NAME_WIDTH + 1, DETAIL_WIDTH))).alias("dismissal_detail"),
        F.when(~absent, stats).alias("_stats"),
    )
    typed = parsed.withColumn(
        "dismissal_type",
        first_match(
            [
                (F.col("did_not_bat"), "DID_NOT_BAT"),
                (detail.ilike("not out%"), "NOT_OUT"),
                (detail.ilike("rtrd%") | detail.ilike("%retired%"), "RETIRED_HURT"),
                (detail.ilike("c %"), "CAUGHT"),
                (detail.ilike("lbw%"), "LBW"),
                (detail.ilike("run out%"), "RUN_OUT"),
                (detail.ilike("st %"), "STUMPED"),
                (detail.ilike("b %"), "BOWLED"),
            ]
        ),
    ).withColumns(
        {
            name: dash_zero(part("_stats", " ", i))
            for i, name in enumerate(["runs", "balls_faced", "fours", "sixes"], start=1)
        }
    )
    context = innings.select(
        FILE,
        "block_id",
        F.col("team").alias("batting_team"),
        "team_innings_number",
        "match_innings_sequence",
    )
    return as_table(typed.join(context.hint(meet), [FILE, "block_id"]), "int_batting_rows")


def bowling_rows(
    lines: DataFrame, innings: DataFrame, header: DataFrame, max_rows: int = MAX_ROWS, meet: str = MERGE
) -> DataFrame:
    """One row per bowler and innings. The block after a batting block holds its bowlers."""
    stats = [part("_stats", " ", i) for i in range(1, 6)]
    overs, third, runs, wickets, economy = stats
    parsed = _positions(lines, "bowling_data", "bowling_position", max_rows).select(
        FILE,
        "block_id",
        "bowling_position",
        F.trim(fixed("raw_line", 1, NAME_WIDTH)).alias("player_name"),
        squeeze(fixed("raw_line", NAME_WIDTH + 1)).alias("_stats"),
    )
    context = innings.join(header.hint(meet), FILE).select(
        FILE,
        (F.col("block_id") + 1).alias("block_id"),
        "team_innings_number",
        "match_innings_sequence",
        other_of("team", "home_team", "away_team").alias("bowling_team"),
        "match_format",
    )
    by_balls = F.col("match_format") == "HUNDRED"
    has_dots = F.col("match_format").isin(DOT_BALL_FORMATS)
    balls = to_int(overs)
    per_six = F.round(
        F.try_divide((to_int(runs) * 6).cast("decimal(18,0)"), balls.cast("decimal(18,0)")), 2
    ).cast("decimal(10,2)")
    joined = parsed.join(context.hint(meet), [FILE, "block_id"]).withColumns(
        {
            "overs": F.when(by_balls, balls_to_overs(balls)).otherwise(to_dec(overs, 1)),
            "dots_bowled": F.when(has_dots, to_int(third)),
            "maidens": F.when(~has_dots, to_int(third)),
            "runs_conceded": to_int(runs),
            "wickets": to_int(wickets),
            "economy": F.when(by_balls, per_six).otherwise(to_dec(economy, 2)),
        }
    )
    return as_table(joined, "int_bowling_rows")


def fow_rows(lines: DataFrame, innings: DataFrame, meet: str = MERGE) -> DataFrame:
    """One row per wicket: every 'n-score' token of every fall-of-wickets line."""
    tokens = of_type(lines, "fow_data").select(
        FILE,
        (F.col("block_id") - 1).alias("block_id"),
        F.explode(F.split(squeeze("raw_line"), " ")).alias("_token"),
    )
    context = innings.select(FILE, "block_id", "team", "team_innings_number", "match_innings_sequence")
    falls = tokens.where(F.col("_token") != "").select(
        FILE,
        "block_id",
        to_int(part("_token", "-", 1)).alias("wicket_number"),
        to_int(part("_token", "-", 2)).alias("cumulative_score"),
    )
    return as_table(falls.join(context.hint(meet), [FILE, "block_id"]), "int_fow_rows")


def partnerships(
    innings: DataFrame, batting: DataFrame, fow: DataFrame, max_rows: int = MAX_ROWS, meet: str = MERGE
) -> DataFrame:
    """Runs added for each wicket, plus the last stand where there is one."""
    falls = cumulative_deltas(
        fow.drop("team", "team_innings_number"),
        INNINGS,
        "wicket_number",
        "cumulative_score",
        "_stand",
        max_rows,
    )
    per_innings = fow.groupBy(*INNINGS).agg(
        F.count(F.lit(1)).alias("_wickets"), F.max("cumulative_score").alias("_last")
    )
    not_outs = (
        batting.where(~F.col("did_not_bat"))
        .groupBy(*INNINGS)
        .agg(F.count_if(F.col("dismissal_type") == "NOT_OUT").alias("_not_outs"))
    )
    which = [FILE, "team", "team_innings_number", "match_innings_sequence"]
    broken = innings.select(*which).hint(meet).join(falls, INNINGS).select(
        *which,
        F.col("wicket_number").alias("partnership_number"),
        F.col("_stand").alias("partnership_runs"),
        F.lit(False).alias("is_unbroken"),
    )
    left_over = F.col("total_runs") - F.coalesce("_last", F.lit(0))
    last = (
        innings.select(*which, "total_runs")
        .join(not_outs.hint(meet), INNINGS)
        .join(per_innings.hint(meet), INNINGS, "left")
        .where((F.col("_not_outs") == 2) | (left_over > 0))
        .select(
            *which,
            (F.coalesce("_wickets", F.lit(0)) + 1).alias("partnership_number"),
            left_over.alias("partnership_runs"),
            (F.col("_not_outs") == 2).alias("is_unbroken"),
        )
    )
    return as_table(broken.unionByName(last), "int_partnerships")


def fielding_dismissals(
    batting: DataFrame, header: DataFrame, bowling: DataFrame, max_rows: int = MAX_ROWS, meet: str = MERGE
) -> DataFrame:
    """One row per catch or stumping, with surnames resolved against the fielding side's roster."""
    kind, text = F.col("dismissal_type"), F.col("dismissal_detail")

    def credited(group: int) -> Column:
        return F.when(kind == "CAUGHT", rx(text, "^c (.+) b (.+)$", group)).when(
            kind == "STUMPED", rx(text, "^st (.+) b (.+)$", group)
        )

    events = (
        batting.where(kind.isin("CAUGHT", "STUMPED"))
        .join(header.select(FILE, "home_team", "away_team").hint(meet), FILE)
        .select(
            FILE,
            "match_innings_sequence",
            other_of("batting_team", "home_team", "away_team").alias("team"),
            F.col("player_name").alias("batter_name"),
            "dismissal_type",
            credited(1).alias("_fielder"),
            credited(2).alias("_bowler"),
        )
        .withColumn("caught_and_bowled", F.col("_fielder") == "&")
    )
    roster = (
        batting.select(FILE, F.col("batting_team").alias("team"), "player_name")
        .unionByName(bowling.select(FILE, F.col("bowling_team").alias("team"), "player_name"))
    )
    # A caught-and-bowled row keeps its row but is not matched as a fielder.
    fielder = F.when(~F.col("caught_and_bowled"), name_fragment("_fielder"))
    asked = {
        "_fielder_name": (fielder, "_fielder_hits"), "bowler_name": (name_fragment("_bowler"), "bowler_match_count")
    }
    # The names of a side are a short list, unless its file has very many rows; those are sorted with what is asked of them.
    many = min(max_rows, LISTED_ROWS)
    large = reduce(
        DataFrame.unionByName,
        [rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > many).select(FILE) for rows in (batting, bowling)],
    ).distinct()
    any_large = not large.isEmpty()
    few = events.join(large, FILE, "left_anti") if any_large else events
    for rows, team in ((batting, "batting_team"), (bowling, "bowling_team")):
        names = rows.groupBy(FILE, F.col(team).alias("team")).agg(F.collect_set("player_name").alias(f"_{team}"))
        few = few.join(names.hint(meet), [FILE, "team"], "left")
    listed = F.concat(*[F.coalesce(f"_{team}", F.array().cast("array<string>")) for team in ("batting_team", "bowling_team")])
    resolved = resolve_listed(few, listed, asked).drop("_batting_team", "_bowling_team")
    if any_large:
        # Only a file with so many names of one innings can have a side too large for one task.
        longest = [rows.where(F.col(n) > max_rows).select(FILE) for rows, n in ((batting, "batting_position"), (bowling, "bowling_position"))]
        resolved = resolved.unionByName(
            resolve_suffixes(
                events.join(large, FILE, "left_semi"), roster.join(large, FILE, "left_semi"), [FILE, "team"], "player_name", asked,
                suspects=longest[0].unionByName(longest[1]),
            )
        )
    numbers = bowling.select(*INNINGS, "team_innings_number").distinct()
    own = F.col("caught_and_bowled")
    return as_table(
        resolved.join(numbers.hint(meet), INNINGS, "left")
        .withColumn("fielder_name", F.when(own, F.col("bowler_name")).otherwise(F.col("_fielder_name")))
        .withColumn("fielder_match_count", F.when(own, F.lit(None)).otherwise(F.col("_fielder_hits"))),
        "int_fielding_dismissals",
    )


def batting_match_factor(batting: DataFrame, meet: str | None = None) -> DataFrame:
    """Per player and match: own batting average against the other top-order batters of the match.

    A batter never dismissed uses own runs as the average.
    """
    top = batting.where((F.col("batting_position") <= TOP_ORDER) & ~F.col("did_not_bat"))
    own = leave_one_out(
        top,
        [FILE],
        ["player_name"],
        {"runs": F.col("runs"), "dismissals": is_dismissal(F.col("dismissal_type"))},
        meet,
    )
    own_average = F.when(
        F.col("own_dismissals") > 0, ratio("own_runs", "own_dismissals")
    ).otherwise(F.col("own_runs").cast("double"))
    peers = (F.col("peer_dismissals") > 0) & (F.col("peer_runs") > 0)
    peer_average = ratio("peer_runs", "peer_dismissals")
    return as_table(
        own.withColumns(
            {
                "own_batting_average": own_average,
                "peer_batting_average": F.when(F.col("peer_dismissals") > 0, peer_average),
                "batting_match_factor": F.when(peers, F.try_divide(own_average, peer_average)),
            }
        ),
        "int_batting_match_factor",
    )


def bowling_match_factor(bowling: DataFrame, meet: str | None = None) -> DataFrame:
    """Per player and match: the other bowlers' average against the player's blended own average."""
    own = leave_one_out(
        bowling,
        [FILE],
        ["player_name"],
        {"runs_conceded": F.col("runs_conceded"), "wickets": F.col("wickets")},
        meet,
    )
    return as_table(
        own.withColumns(
            {
                "own_bowling_average": F.when(
                    F.col("own_wickets") > 0, ratio("own_runs_conceded", "own_wickets")
                ),
                "peer_bowling_average": F.when(
                    F.col("peer_wickets") > 0, ratio("peer_runs_conceded", "peer_wickets")
                ),
                "bowling_match_factor": blended_factor(
                    "peer_runs_conceded", "peer_wickets", "own_runs_conceded", "own_wickets"
                ),
            }
        ),
        "int_bowling_match_factor",
    )
