"""Expected model tables in DuckDB SQL, computed from the same integers and without any text.

Each entry is a common table expression; ``expected(table)`` puts the needed ones in front of a
select. Only the arithmetic of the seeds is shared with the renderer.
"""

from __future__ import annotations

import re

from matchbook.bindings.cards import LONG_SURNAME, SHORT_SURNAME, SURNAMES

_NAMES = "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in SURNAMES) + "]"
_SHORT = SHORT_SURNAME.replace("'", "''")
_KIND = (
    "['CAUGHT', 'CAUGHT', 'BOWLED', 'LBW', 'STUMPED', 'RUN_OUT']"
)


def _h(k: str, p: str) -> str:
    return f"((s * 7919 + ({k}) * 104729 + ({p}) * 1299709) % 1000003)"


def _player(key: str, p: str) -> str:
    slot = f"(CASE WHEN m % 50 = 0 AND ({p}) = 3 THEN 2 ELSE ({p}) END)"
    named = f"(CASE WHEN {key} % 5 = 0 AND {slot} = 9 THEN 8 ELSE {slot} END)"
    return f"(substr('ABCDEFGHIJK', ({slot})::INT, 1) || ' ' || {_NAMES}[(({key} * 3 + {named}) % 16 + 1)::INT])"


def _credit(name: str) -> str:
    """A player's name as a dismissal gives it."""
    return f"replace(substr({name}, 3), '{LONG_SURNAME}', '{_SHORT}')"


def _fragment(name: str) -> str:
    """What a credit of this player is matched by."""
    short = _credit(name)
    return f"(CASE WHEN contains({short}, '''') THEN split_part({short}, '''', 2) ELSE ' ' || {short} END)"


def _percent(a: str, b: str) -> str:
    six = f"(({a}) * 2000000 + ({b})) // (2 * ({b}))"
    return f"(CASE WHEN ({b}) > 0 THEN (({six} + 50) // 100) / 100.0 END)::DOUBLE"


def _overs(balls: str) -> str:
    return f"((({balls}) // 6) * 10 + ({balls}) % 6)"


def _detail() -> str:
    """The dismissal as it is printed."""
    bowler, fielder = (_credit(_player("bowl_key", p)) for p in ("bowler_p", "fielder_p"))
    return f"""CASE WHEN NOT batted THEN NULL WHEN how = 0 THEN 'c ' || {fielder} || ' b ' || {bowler} WHEN how = 1 THEN 'c & b ' || {bowler}
        WHEN how = 2 THEN CASE WHEN m % 100 = 98 THEN 'hit wkt b ' ELSE 'b ' END || {bowler} WHEN how = 3 THEN 'lbw b ' || {bowler}
        WHEN how = 4 THEN 'st ' || {fielder} || ' b ' || {bowler} WHEN how = 5 THEN 'run out'
        WHEN p = hurt THEN 'rtrd hurt' ELSE 'not out' END"""


_OUT = "(how >= 0 AND NOT (how = 2 AND m % 100 = 98))"

CTES = {
    "spend": """SELECT o_custkey AS m, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS spent
        FROM orders GROUP BY o_custkey""",
    "keyed": """SELECT c_custkey AS m, c_nationkey::BIGINT AS home_key,
        ((c_custkey * 31 + coalesce(spent, 0)) % 1000003)::BIGINT AS s,
        (c_nationkey::BIGINT + 1 + c_custkey % 4) % 25 AS away_key
        FROM customer LEFT JOIN spend ON c_custkey = spend.m""",
    "seeds": """SELECT k.*, h.n_name AS home, a.n_name AS away,
        'match-' || lpad(m::VARCHAR, 9, '0') || '.txt' AS source_file_name,
        (DATE '2026-04-01' + (s % 150)::INT)::DATE AS match_date,
        CASE WHEN m % 100 = 99 THEN 7 ELSE m % 7 END AS fmt,
        CASE WHEN (CASE WHEN m % 100 = 99 THEN 7 ELSE m % 7 END) IN (0, 4)
             THEN CASE WHEN m % 5 = 0 THEN 3 ELSE 4 END ELSE 2 END AS ni,
        CASE WHEN m % 2 = 0 THEN h.n_name ELSE a.n_name END AS side_a,
        CASE WHEN m % 2 = 0 THEN a.n_name ELSE h.n_name END AS side_b
        FROM keyed k JOIN nation h ON h.n_nationkey = home_key JOIN nation a ON a.n_nationkey = away_key""",
    "inn0": f"""SELECT seeds.*, k::BIGINT AS k,
        CASE WHEN (k % 2 = 1) = (m % 2 = 0) THEN home ELSE away END AS bat,
        CASE WHEN (k % 2 = 1) = (m % 2 = 0) THEN away ELSE home END AS bowl,
        CASE WHEN (k % 2 = 1) = (m % 2 = 0) THEN home_key ELSE away_key END AS bat_key,
        CASE WHEN (k % 2 = 1) = (m % 2 = 0) THEN away_key ELSE home_key END AS bowl_key,
        CASE WHEN k <= 2 THEN 1 ELSE 2 END::BIGINT AS tin,
        CASE WHEN m % 90 = 0 THEN 0 WHEN m % 40 = 20 THEN 9 ELSE {_h('k', '0')} % 11 END AS nw,
        {_h('k', '12')} % 15 AS extras
        FROM seeds, range(1, 5) r(k) WHERE k <= ni""",
    "inn1": """SELECT *, CASE WHEN m % 40 = 0 AND nw <= 8 THEN nw + 1 WHEN m % 40 = 20 THEN 10 ELSE 0 END AS hurt
        FROM inn0""",
    "slots": f"""SELECT m, s, k, p::BIGINT AS p, fmt, source_file_name, bat, bowl, bat_key, bowl_key, tin, nw, hurt, extras,
        p <= least(11, nw + 2 + CASE WHEN hurt > 0 THEN 1 ELSE 0 END) AS batted,
        CASE WHEN p <= nw THEN ({_h('k', 'p')} // 61) % 6 ELSE -1 END AS how,
        {_h('k', 'p')} % 61 + CASE WHEN {_h('k', 'p')} % 29 = 0 THEN 100 ELSE 0 END AS raw_runs,
        {_h('k', 'p')} % 17 AS spare,
        5 + ({_h('k', 'p')} // 366) % 5 AS bowler_p,
        1 + ({_h('k', 'p')} // 1830) % 11 AS fielder_p,
        6 * (3 + {_h('k', '20 + p')} % 10) + {_h('k', '30 + p')} % 6 AS balls,
        {_h('k', '40 + p')} % 4 AS third
        FROM inn1, range(1, 12) r(p)""",
    "inn": """SELECT i.*, extras + t.bat_runs AS total, t.all_balls
        FROM inn1 i JOIN (SELECT m, k, sum(CASE WHEN batted THEN raw_runs ELSE 0 END)::BIGINT AS bat_runs,
            sum(CASE WHEN p BETWEEN 5 AND 9 THEN balls ELSE 0 END)::BIGINT AS all_balls FROM slots GROUP BY m, k) t
        ON i.m = t.m AND i.k = t.k""",
    # --- staging -------------------------------------------------------------------------------
    "stg_lines": """SELECT source_file_name, n::BIGINT AS source_file_row_number, 0::BIGINT AS k, n AS j, ni, 0::BIGINT AS nw
            FROM seeds, range(1, 4) r(n)
        UNION ALL SELECT source_file_name, 3 + (k - 1) * 29 + j, k, j, ni, nw FROM inn1, range(1, 30) r(j)
        UNION ALL SELECT source_file_name, 3 + ni * 29 + j, 5, j, ni, 0
            FROM seeds, range(1, 3) r(j) WHERE j = 1 OR m % 13 <> 0""",
    "stg_row_classification": """SELECT source_file_name, source_file_row_number,
        CASE WHEN k = 0 THEN j = 3 WHEN k = 5 THEN false ELSE j IN (17, 29) END AS is_marker_line,
        CASE WHEN k = 0 THEN CASE WHEN j = 3 THEN 1 ELSE 0 END WHEN k = 5 THEN 2 * ni + 1
             WHEN j <= 16 THEN 2 * k - 1 WHEN j <= 28 THEN 2 * k ELSE 2 * k + 1 END::BIGINT AS block_id,
        CASE WHEN k = 0 THEN CASE WHEN j < 3 THEN 'match_header' END WHEN k = 5 THEN 'result'
             WHEN j <= 16 THEN 'batting' WHEN j IN (17, 29) THEN NULL ELSE 'bowling' END AS block_type,
        CASE WHEN k = 0 THEN CASE WHEN j < 3 THEN 'match_header_data' END WHEN k = 5 THEN 'result_data'
             WHEN j = 1 THEN 'batting_header' WHEN j IN (2, 14, 19) THEN 'divider'
             WHEN j <= 13 THEN 'batting_data' WHEN j = 15 THEN 'extras' WHEN j = 16 THEN 'total'
             WHEN j IN (17, 29) THEN NULL WHEN j = 18 THEN 'bowling_header' WHEN j <= 24 THEN 'bowling_data'
             WHEN j = 25 THEN 'blank' WHEN j = 26 THEN 'fow_header'
             WHEN j = 27 THEN CASE WHEN nw = 0 THEN 'blank' ELSE 'fow_data' END
             ELSE CASE WHEN nw <= 5 THEN 'blank' ELSE 'fow_data' END END AS row_type
        FROM stg_lines""",
    "stg_blocks": """SELECT source_file_name, source_file_row_number, is_marker_line, block_id, block_type
        FROM stg_row_classification""",
    # --- entities ------------------------------------------------------------------------------
    "int_match_header": """SELECT source_file_name, home AS home_team, away AS away_team, match_date,
        ['TEST', 'ODI', 'T20I', 'T20', 'FC_LEAGUE', 'LIST_A', 'HUNDRED', 'UNKNOWN'][(fmt + 1)::INT] AS match_format,
        ['Test Match', 'One Day International', '20 Over International', 'English 20 Over Trophy',
         'English FC League', 'English Challenge Trophy', 'English 100 Ball Trophy', NULL][(fmt + 1)::INT] AS competition_name,
        CASE WHEN fmt <= 2 THEN CASE WHEN s % 7 = 0 THEN 'Only'
                ELSE ['1st', '2nd', '3rd'][(1 + s % 3)::INT] || ' (of ' || (1 + s % 5) || ')' END
             WHEN fmt = 3 THEN CASE WHEN s % 4 = 0 THEN '' ELSE 'North' END
             WHEN fmt = 4 THEN 'D1' WHEN fmt = 5 THEN 'Group A'
             WHEN fmt = 6 THEN CASE WHEN s % 2 = 0 THEN NULL ELSE 'Final' END END AS competition_variant
        FROM seeds""",
    "int_result": f"""SELECT source_file_name,
        CASE WHEN s % 10 <= 7 THEN 'WIN' WHEN s % 20 = 8 THEN 'DRAW' WHEN s % 20 = 18 THEN 'TIE'
             WHEN s % 3 = 0 THEN 'NO_RESULT' ELSE 'UNKNOWN' END AS result_type,
        CASE WHEN s % 10 <= 3 OR s % 10 = 7 THEN side_a WHEN s % 10 <= 6 THEN side_b END AS winning_team,
        CASE WHEN s % 10 <= 3 THEN 1 + s % 150 WHEN s % 10 <= 6 THEN 1 + s % 10
             WHEN s % 10 = 7 THEN 1 + s % 200 END AS result_margin_value,
        CASE WHEN s % 10 <= 3 THEN 'RUNS' WHEN s % 10 <= 6 THEN 'WICKETS' WHEN s % 10 = 7 THEN 'INNINGS' END
            AS result_margin_type,
        CASE WHEN m % 13 = 0 THEN NULL WHEN m % 77 = 0 THEN 'Z Substitute'
             ELSE {_player("(CASE WHEN m % 2 = 0 THEN home_key ELSE away_key END)", "1 + s % 11")} END AS man_of_the_match
        FROM seeds""",
    "int_innings_totals": f"""SELECT source_file_name, 2 * k - 1 AS block_id, bat AS team, tin AS team_innings_number,
        k AS match_innings_sequence, total AS total_runs, nw::BIGINT AS wickets_lost,
        ({_overs('all_balls')} / 10.0)::DOUBLE AS overs_faced, extras AS extras_total FROM inn""",
    "int_batting_rows": f"""SELECT source_file_name, bat AS batting_team, tin AS team_innings_number,
        k AS match_innings_sequence, p AS batting_position, {_player('bat_key', 'p')} AS player_name,
        NOT batted AS did_not_bat,
        CASE WHEN NOT batted THEN 'DID_NOT_BAT' WHEN how = -1 THEN CASE WHEN p = hurt THEN 'RETIRED_HURT' ELSE 'NOT_OUT' END
             WHEN how = 2 AND m % 100 = 98 THEN NULL ELSE {_KIND}[(how + 1)::INT] END AS dismissal_type,
        {_detail()} AS dismissal_detail, CASE WHEN batted THEN raw_runs END AS runs, CASE WHEN batted THEN raw_runs + spare END AS balls_faced,
        CASE WHEN batted THEN raw_runs // 8 END AS fours, CASE WHEN batted THEN raw_runs // 20 END AS sixes
        FROM slots""",
    "bowled": f"""SELECT sl.*, i.total, {_player('sl.bowl_key', 'p').replace('m %', 'sl.m %')} AS player_name,
        CASE WHEN p = 9 THEN i.total - 4 * (i.total // 5) ELSE i.total // 5 END AS given,
        coalesce(w.n, 0) AS taken
        FROM slots sl JOIN inn i ON sl.m = i.m AND sl.k = i.k
        LEFT JOIN (SELECT m, k, bowler_p, count(*) AS n FROM slots WHERE how BETWEEN 0 AND 4 GROUP BY 1, 2, 3) w
            ON sl.m = w.m AND sl.k = w.k AND sl.p = w.bowler_p
        WHERE p BETWEEN 5 AND 9""",
    "int_bowling_rows": f"""SELECT source_file_name, bowl AS bowling_team, tin AS team_innings_number,
        k AS match_innings_sequence, p - 4 AS bowling_position, player_name,
        ({_overs('balls')} / 10.0)::DOUBLE AS overs,
        CASE WHEN fmt IN (2, 3, 6) THEN third END AS dots_bowled,
        CASE WHEN fmt NOT IN (2, 3, 6) THEN third END AS maidens,
        given AS runs_conceded, taken AS wickets,
        (CASE WHEN fmt = 6 THEN (given * 1200 + balls) // (2 * balls) ELSE (given * 600 + balls // 2) // balls END
            / 100.0)::DOUBLE AS economy FROM bowled""",
    "int_fow_rows": """SELECT sl.source_file_name, sl.bat AS team, sl.tin AS team_innings_number,
        sl.k AS match_innings_sequence, sl.p AS wicket_number,
        CASE WHEN sl.p = 10 THEN i.total ELSE (i.extras + sum(raw_runs) OVER
            (PARTITION BY sl.m, sl.k ORDER BY sl.p ROWS UNBOUNDED PRECEDING))::BIGINT END AS cumulative_score
        FROM slots sl JOIN inn i ON sl.m = i.m AND sl.k = i.k WHERE sl.p <= sl.nw""",
    # A batter's runs belong to the stand of the wicket at which they are out, or to the last one; extras to the first.
    "stands": """SELECT m, k, source_file_name, bat, tin, nw, CASE WHEN nw = 10 THEN least(p, 10) ELSE least(p, nw + 1) END AS stand,
            sum(CASE WHEN batted THEN raw_runs ELSE 0 END + CASE WHEN p = 1 THEN extras ELSE 0 END)::BIGINT AS runs,
            count(*) FILTER (WHERE batted AND how = -1 AND p <> hurt) AS not_out
        FROM slots GROUP BY ALL""",
    "int_partnerships": """SELECT source_file_name, bat AS team, tin AS team_innings_number, k AS match_innings_sequence,
            stand AS partnership_number, runs AS partnership_runs, stand > nw AND not_out = 2 AS is_unbroken
        FROM stands WHERE stand <= nw OR not_out = 2 OR runs > 0""",
    "rosters": f"""SELECT DISTINCT source_file_name, team, name FROM (
        SELECT source_file_name, home AS team, {_player('home_key', 'p')} AS name FROM seeds, range(1, 12) r(p)
        UNION ALL SELECT source_file_name, away, {_player('away_key', 'p')} FROM seeds, range(1, 12) r(p))""",
    "catches": f"""SELECT *, {_fragment(_player('bowl_key', 'fielder_p'))} AS f_frag,
        {_fragment(_player('bowl_key', 'bowler_p'))} AS b_frag, {_player('bat_key', 'p')} AS batter_name
        FROM slots WHERE how IN (0, 1, 4)""",
    "int_fielding_dismissals": """SELECT c.source_file_name, c.bowl AS team, c.tin AS team_innings_number,
        c.k AS match_innings_sequence, c.batter_name,
        CASE WHEN c.how = 4 THEN 'STUMPED' ELSE 'CAUGHT' END AS dismissal_type, c.how = 1 AS caught_and_bowled,
        CASE WHEN c.how = 1 THEN CASE WHEN b.n = 1 THEN b.name END WHEN f.n = 1 THEN f.name END AS fielder_name,
        CASE WHEN c.how <> 1 THEN f.n END AS fielder_match_count,
        CASE WHEN b.n = 1 THEN b.name END AS bowler_name, b.n AS bowler_match_count
        FROM catches c
        JOIN (SELECT c.m, c.k, c.p, count(DISTINCT r.name) AS n, max(r.name) AS name FROM catches c
            LEFT JOIN rosters r ON r.source_file_name = c.source_file_name AND r.team = c.bowl
                AND lower(r.name) LIKE '%' || lower(c.f_frag) GROUP BY 1, 2, 3) f ON (c.m, c.k, c.p) = (f.m, f.k, f.p)
        JOIN (SELECT c.m, c.k, c.p, count(DISTINCT r.name) AS n, max(r.name) AS name FROM catches c
            LEFT JOIN rosters r ON r.source_file_name = c.source_file_name AND r.team = c.bowl
                AND lower(r.name) LIKE '%' || lower(c.b_frag) GROUP BY 1, 2, 3) b ON (c.m, c.k, c.p) = (b.m, b.k, b.p)""",
    "int_batting_match_factor": f"""SELECT source_file_name, player_name, own_runs, own_dismissals,
        CASE WHEN own_dismissals > 0 THEN own_runs::DOUBLE / own_dismissals ELSE own_runs::DOUBLE END AS own_batting_average,
        peer_runs, peer_dismissals,
        CASE WHEN peer_dismissals > 0 THEN peer_runs::DOUBLE / peer_dismissals END AS peer_batting_average,
        CASE WHEN peer_dismissals > 0 AND peer_runs > 0 THEN
            (CASE WHEN own_dismissals > 0 THEN own_runs::DOUBLE / own_dismissals ELSE own_runs::DOUBLE END)
            / (peer_runs::DOUBLE / peer_dismissals) END AS batting_match_factor
        FROM (SELECT source_file_name, player_name, own_runs, own_dismissals,
            (sum(own_runs) OVER (PARTITION BY source_file_name) - own_runs)::BIGINT AS peer_runs,
            (sum(own_dismissals) OVER (PARTITION BY source_file_name) - own_dismissals)::BIGINT AS peer_dismissals
            FROM (SELECT source_file_name, {_player('bat_key', 'p')} AS player_name, sum(raw_runs)::BIGINT AS own_runs,
                sum(CASE WHEN {_OUT} THEN 1 ELSE 0 END)::BIGINT AS own_dismissals
                FROM slots WHERE p <= 6 AND batted GROUP BY 1, 2))""",
    "int_bowling_match_factor": """SELECT source_file_name, player_name, own_runs_conceded, own_wickets,
        CASE WHEN own_wickets > 0 THEN own_runs_conceded::DOUBLE / own_wickets END AS own_bowling_average,
        peer_runs_conceded, peer_wickets, q AS peer_bowling_average,
        CASE WHEN own_wickets > 0 AND q > 0 THEN q / ((own_runs_conceded + q) / (own_wickets + 1.0::DOUBLE)) END
            AS bowling_match_factor
        FROM (SELECT *, CASE WHEN peer_wickets > 0 THEN peer_runs_conceded::DOUBLE / peer_wickets END AS q FROM (
            SELECT *, (sum(own_runs_conceded) OVER (PARTITION BY source_file_name) - own_runs_conceded)::BIGINT AS peer_runs_conceded,
                (sum(own_wickets) OVER (PARTITION BY source_file_name) - own_wickets)::BIGINT AS peer_wickets
            FROM (SELECT source_file_name, player_name, sum(given)::BIGINT AS own_runs_conceded,
                sum(taken)::BIGINT AS own_wickets FROM bowled GROUP BY 1, 2)))""",
    # --- star ----------------------------------------------------------------------------------
    "dim_team": """SELECT md5(team_name) AS team_id, team_name
        FROM (SELECT home AS team_name FROM seeds UNION SELECT away FROM seeds)""",
    "dim_player": """SELECT md5(player_name) AS player_id, player_name
        FROM (SELECT name AS player_name FROM rosters
            UNION SELECT man_of_the_match FROM int_result WHERE man_of_the_match IS NOT NULL)""",
    "intl": """SELECT h.*, least(home_team, away_team) AS a, greatest(home_team, away_team) AS b
        FROM int_match_header h WHERE match_format IN ('TEST', 'ODI', 'T20I')""",
    "stepped": """SELECT *, CASE WHEN match_date - lag(match_date) OVER (PARTITION BY match_format, a, b
        ORDER BY match_date, source_file_name) <= 30 THEN 0 ELSE 1 END AS fresh FROM intl""",
    "runs_of": """SELECT *, sum(fresh) OVER (PARTITION BY match_format, a, b
        ORDER BY match_date, source_file_name ROWS UNBOUNDED PRECEDING)::BIGINT AS seq FROM stepped""",
    "series": """SELECT source_file_name, md5(match_format || '-' || a || '-' || b || '-' || seq) AS series_id,
        first_value(home_team || ' v ' || away_team) OVER w || ' '
            || CASE match_format WHEN 'TEST' THEN 'Test' ELSE match_format END || ' series, '
            || strftime(first_value(match_date) OVER w, '%b %Y') AS series_name,
        row_number() OVER w AS series_match_number,
        count(*) OVER p AS series_matches_played,
        greatest(count(*) OVER p, coalesce(max(CASE WHEN contains(competition_variant, '(of ') THEN
            substr(split_part(competition_variant, '(of ', 2), 1, 1)::BIGINT END) OVER p, 1)) AS series_scheduled_matches
        FROM runs_of WINDOW p AS (PARTITION BY match_format, a, b, seq),
            w AS (PARTITION BY match_format, a, b, seq ORDER BY match_date, source_file_name
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "dim_match": """SELECT md5(h.source_file_name) AS match_id, h.source_file_name, match_date,
        md5(home_team) AS home_team_id, md5(away_team) AS away_team_id, competition_name, competition_variant,
        match_format, CASE WHEN match_format IN ('TEST', 'FC_LEAGUE') THEN 2 ELSE 1 END::BIGINT AS innings_per_team,
        md5(winning_team) AS winning_team_id, result_type, result_margin_type, result_margin_value,
        md5(man_of_the_match) AS man_of_the_match_id, series_id, series_name, series_match_number,
        series_matches_played, series_scheduled_matches
        FROM int_match_header h JOIN int_result r ON h.source_file_name = r.source_file_name
        LEFT JOIN series s ON h.source_file_name = s.source_file_name""",
    "fact_batting": f"""SELECT md5(b.source_file_name) AS match_id, md5(b.player_name) AS player_id,
        md5(b.batting_team) AS team_id,
        md5(CASE WHEN b.batting_team = h.home_team THEN h.away_team ELSE h.home_team END) AS opposition_team_id,
        b.team_innings_number, b.match_innings_sequence, b.batting_position, b.dismissal_type, b.dismissal_detail, b.did_not_bat,
        b.runs, b.balls_faced, b.fours, b.sixes, {_percent('b.runs', 'b.balls_faced')} AS strike_rate,
        {_percent('b.runs', 'i.total_runs')} AS pct_of_team_innings_runs, f.batting_match_factor
        FROM int_batting_rows b JOIN int_match_header h ON b.source_file_name = h.source_file_name
        JOIN int_innings_totals i ON b.source_file_name = i.source_file_name
            AND b.match_innings_sequence = i.match_innings_sequence
        LEFT JOIN int_batting_match_factor f ON b.source_file_name = f.source_file_name AND b.player_name = f.player_name""",
    "fact_bowling": f"""SELECT md5(b.source_file_name) AS match_id, md5(b.player_name) AS player_id,
        md5(b.bowling_team) AS team_id,
        md5(CASE WHEN b.bowling_team = h.home_team THEN h.away_team ELSE h.home_team END) AS opposition_team_id,
        b.team_innings_number, b.match_innings_sequence, b.overs, b.maidens, b.dots_bowled, b.runs_conceded,
        b.wickets, b.economy, {_percent('b.wickets', 'i.wickets_lost')} AS pct_of_team_innings_wickets,
        f.bowling_match_factor
        FROM int_bowling_rows b JOIN int_match_header h ON b.source_file_name = h.source_file_name
        LEFT JOIN int_innings_totals i ON b.source_file_name = i.source_file_name
            AND b.team_innings_number = i.team_innings_number AND i.team <> b.bowling_team
        LEFT JOIN int_bowling_match_factor f ON b.source_file_name = f.source_file_name AND b.player_name = f.player_name""",
    "fact_fow": """SELECT md5(source_file_name) AS match_id, md5(team) AS team_id, team_innings_number,
        match_innings_sequence, wicket_number, cumulative_score FROM int_fow_rows""",
    "fact_partnership": """SELECT md5(source_file_name) AS match_id, md5(team) AS team_id, team_innings_number,
        match_innings_sequence, partnership_number, partnership_runs, is_unbroken FROM int_partnerships""",
    "fact_fielding": """SELECT md5(source_file_name) AS match_id, md5(team) AS team_id, team_innings_number,
        match_innings_sequence, md5(fielder_name) AS fielder_id, md5(bowler_name) AS bowler_id,
        md5(batter_name) AS batter_id, dismissal_type, caught_and_bowled FROM int_fielding_dismissals""",
    "fact_player_match_summary": """SELECT r.match_id, r.player_id, r.team_id,
        CASE WHEN r.team_id = d.home_team_id THEN d.away_team_id ELSE d.home_team_id END AS opposition_team_id,
        ba.total_runs, ba.total_balls_faced, ba.total_fours, ba.total_sixes,
        coalesce(ba.dismissals, 0) AS dismissals, coalesce(ba.centuries, 0) AS centuries,
        coalesce(ba.half_centuries, 0) AS half_centuries, ba.batting_match_factor,
        bw.total_overs_naive, bw.total_runs_conceded, bw.total_wickets,
        coalesce(bw.five_wicket_hauls, 0) AS five_wicket_hauls, bw.bowling_match_factor,
        mb.own_runs AS mf_bat_own_runs, mb.own_dismissals AS mf_bat_own_dismissals,
        mb.peer_runs AS mf_bat_peer_runs, mb.peer_dismissals AS mf_bat_peer_dismissals,
        mw.own_runs_conceded AS mf_bowl_own_runs_conceded, mw.own_wickets AS mf_bowl_own_wickets,
        mw.peer_runs_conceded AS mf_bowl_peer_runs_conceded, mw.peer_wickets AS mf_bowl_peer_wickets,
        coalesce(fi.catches, 0) AS catches, coalesce(fi.stumpings, 0) AS stumpings,
        r.player_id = d.man_of_the_match_id AS is_man_of_the_match
        FROM (SELECT match_id, player_id, team_id FROM fact_batting UNION
              SELECT match_id, player_id, team_id FROM fact_bowling) r
        JOIN dim_match d ON r.match_id = d.match_id
        LEFT JOIN (SELECT match_id, player_id, sum(runs)::BIGINT AS total_runs, sum(balls_faced)::BIGINT AS total_balls_faced,
            sum(fours)::BIGINT AS total_fours, sum(sixes)::BIGINT AS total_sixes,
            count(*) FILTER (WHERE dismissal_type NOT IN ('NOT_OUT', 'DID_NOT_BAT', 'RETIRED_HURT')) AS dismissals,
            count(*) FILTER (WHERE runs >= 100) AS centuries, count(*) FILTER (WHERE runs BETWEEN 50 AND 99) AS half_centuries,
            max(batting_match_factor) AS batting_match_factor FROM fact_batting GROUP BY 1, 2) ba
            ON r.match_id = ba.match_id AND r.player_id = ba.player_id
        LEFT JOIN (SELECT match_id, player_id, sum(CAST(round(overs * 10) AS BIGINT))::BIGINT / 10.0::DOUBLE AS total_overs_naive,
            sum(runs_conceded)::BIGINT AS total_runs_conceded, sum(wickets)::BIGINT AS total_wickets,
            count(*) FILTER (WHERE wickets >= 5) AS five_wicket_hauls,
            max(bowling_match_factor) AS bowling_match_factor FROM fact_bowling GROUP BY 1, 2) bw
            ON r.match_id = bw.match_id AND r.player_id = bw.player_id
        LEFT JOIN (SELECT md5(source_file_name) AS match_id, md5(player_name) AS player_id, * FROM int_batting_match_factor) mb
            ON r.match_id = mb.match_id AND r.player_id = mb.player_id
        LEFT JOIN (SELECT md5(source_file_name) AS match_id, md5(player_name) AS player_id, * FROM int_bowling_match_factor) mw
            ON r.match_id = mw.match_id AND r.player_id = mw.player_id
        LEFT JOIN (SELECT match_id, fielder_id, count(*) FILTER (WHERE dismissal_type = 'CAUGHT') AS catches,
            count(*) FILTER (WHERE dismissal_type = 'STUMPED') AS stumpings FROM fact_fielding GROUP BY 1, 2) fi
            ON r.match_id = fi.match_id AND r.player_id = fi.fielder_id""",
    "fact_team_match_summary": """SELECT md5(i.source_file_name) AS match_id, md5(i.team) AS team_id,
        CASE WHEN md5(i.team) = d.home_team_id THEN d.away_team_id ELSE d.home_team_id END AS opposition_team_id,
        i.total_runs, i.total_wickets_lost, i.total_overs_faced_naive, b.total_runs_conceded, b.total_wickets_taken,
        i.first = 1 AS batted_first, md5(i.team) = d.winning_team_id AS won, d.result_type, d.result_margin_type,
        d.result_margin_value
        FROM (SELECT source_file_name, team, sum(total_runs)::BIGINT AS total_runs, sum(wickets_lost)::BIGINT AS total_wickets_lost,
            sum(CAST(round(overs_faced * 10) AS BIGINT))::BIGINT / 10.0::DOUBLE AS total_overs_faced_naive,
            min(match_innings_sequence) AS first FROM int_innings_totals GROUP BY 1, 2) i
        JOIN (SELECT source_file_name, bowling_team, sum(runs_conceded)::BIGINT AS total_runs_conceded,
            sum(wickets)::BIGINT AS total_wickets_taken FROM int_bowling_rows GROUP BY 1, 2) b
            ON i.source_file_name = b.source_file_name AND i.team = b.bowling_team
        JOIN dim_match d ON d.source_file_name = i.source_file_name""",
}


def expected(select: str) -> str:
    """The select with the expected tables it needs in front, as views of one statement."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and _mentions(text, name):
                visit(body)
                needed.append(name)

    visit(select)
    ordered = [name for name in CTES if name in needed]
    front = "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    own = select.lstrip()
    return f"{front},\n{own[4:]}" if own.startswith("WITH") else f"{front}\n{own}"


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", text) is not None
