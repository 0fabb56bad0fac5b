"""Match reports rendered by Spark from the customer, orders and nation tables.

One report per customer: teams from nations, all figures by integer arithmetic from a seed that
adds up the customer's orders. The text follows the input grammar, so parsing it must give back the
numbers it was made from; the oracle computes those numbers without any text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchbook.sources.tables import cents, table

# Fixed values shared with the oracle: invented surnames, one of them abbreviated in credits.
SURNAMES = [
    "Ash", "Oak", "Elm", "Fir", "Yew", "Curran", "Vasconcelos", "O'Brien",
    "Reed", "Vale", "Moss", "Fern", "Stone", "Hurst", "Northeast", "Box",
]
LONG_SURNAME, SHORT_SURNAME = "Vasconcelos", "V'oncelos"
LINES_PER_INNINGS = 29
STARS, DASHES = "*" * 60, "-" * 60


def _h(k: str, p: str) -> str:
    """Pseudo-random number of innings k and slot p."""
    return f"((s * 7919 + ({k}) * 104729 + ({p}) * 1299709) % 1000003)"


def seeds(spark: SparkSession, folder: str) -> DataFrame:
    """One row per match: m, seed s, both nations, date, format code 0-6 (7 unknown)."""
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("m")).agg(
        F.sum(cents("o_totalprice")).alias("spent")
    )
    nation = table(spark, folder, "nation")
    sides = {
        side: nation.select(
            F.col("n_nationkey").cast("long").alias(f"{side}_key"), F.col("n_name").alias(f"{side}")
        )
        for side in ("home", "away")
    }
    matches = (
        table(spark, folder, "customer")
        .select(F.col("c_custkey").alias("m"), F.col("c_nationkey").cast("long").alias("home_key"))
        .join(orders, "m", "left")
        .withColumn("s", F.expr("(m * 31 + coalesce(spent, 0)) % 1000003"))
        .withColumn("away_key", F.expr("(home_key + 1 + m % 4) % 25"))
        .join(sides["home"], "home_key")
        .join(sides["away"], "away_key")
    )
    return matches.selectExpr(
        "m",
        "s",
        "home",
        "away",
        "home_key",
        "away_key",
        "date_add(date'2026-04-01', cast(s % 150 as int)) as match_date",
        "case when m % 100 = 99 then 7 else m % 7 end as fmt",
    ).selectExpr(
        "*",
        "case when fmt in (0, 4) then case when m % 5 = 0 then 3 else 4 end else 2 end as innings",
        "concat('match-', lpad(cast(m as string), 9, '0'), '.txt') as source_file_name",
    )


def render(spark: SparkSession, folder: str, buckets: int | None = None) -> DataFrame:
    """The reports as whole files (value, source_file_name, loaded_at): match -> innings -> lines -> text."""

    def player(key: str, p: str) -> str:
        slot = f"case when m % 50 = 0 and ({p}) = 3 then 2 else ({p}) end"
        name_slot = f"case when {key} % 5 = 0 and ({slot}) = 9 then 8 else ({slot}) end"
        surname = f"element_at(surnames, cast(({key} * 3 + {name_slot}) % 16 + 1 as int))"
        return f"concat(substr('ABCDEFGHIJK', cast({slot} as int), 1), ' ', {surname})"

    def credit(p: str) -> str:
        short = SHORT_SURNAME.replace("'", "\\'")
        return f"replace(substr({player('bowl_key', p)}, 3), '{LONG_SURNAME}', '{short}')"

    h = _h("k", "p")
    innings = (
        # One narrow seed row becomes about a hundred lines: spread the work, not the lines. The innings of a report
        # stay where its seed is, so they are put together without another exchange.
        seeds(spark, folder)
        .repartition(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), "source_file_name")
        .withColumn("surnames", F.array(*[F.lit(n) for n in SURNAMES]))
        .selectExpr("*", "explode(sequence(1, innings)) as k")
        .selectExpr("*", "(k % 2 = 1) = (m % 2 = 0) as home_bats", "sequence(1, 11) as slots")
        .selectExpr(
            "*",
            "case when home_bats then home else away end as bat",
            "case when home_bats then home_key else away_key end as bat_key",
            "case when home_bats then away_key else home_key end as bowl_key",
            "case when m % 2 = 0 then home else away end as side_a",
            "case when m % 2 = 0 then away else home end as side_b",
            "case when m % 2 = 0 then home_key else away_key end as side_a_key",
            f"case when m % 90 = 0 then 0 when m % 40 = 20 then 9 else {_h('k', '0')} % 11 end as nw",
            f"{_h('k', '12')} % 15 as extras",
        )
        .selectExpr(
            "*",
            "case when m % 40 = 0 and nw <= 8 then nw + 1 when m % 40 = 20 then 10 else 0 end as hurt",
        )
        .selectExpr("*", "least(11, nw + 2 + case when hurt > 0 then 1 else 0 end) as batted")
        .selectExpr(
            "*",
            f"transform(slots, p -> case when p <= batted then {h} % 61 + case when {h} % 29 = 0 then 100 else 0 end end) as runs",
            f"transform(slots, p -> {h} % 17) as spare",
            f"transform(slots, p -> case when p <= nw then ({h} div 61) % 6 else -1 end) as how",
            f"transform(slots, p -> 5 + ({h} div 366) % 5) as bowler",
            f"transform(slots, p -> 1 + ({h} div 1830) % 11) as fielder",
            f"transform(slots, p -> 6 * (3 + {_h('k', '20 + p')} % 10) + {_h('k', '30 + p')} % 6) as balls",
        )
        .selectExpr(
            "*",
            "extras + aggregate(runs, 0L, (a, r) -> a + coalesce(r, 0L)) as total",
            "aggregate(slice(balls, 5, 5), 0L, (a, b) -> a + b) as all_balls",
        )
    )
    out_text = f"""case how[p - 1]
        when 0 then concat('c ', {credit('fielder[p - 1]')}, ' b ', {credit('bowler[p - 1]')})
        when 1 then concat('c & b ', {credit('bowler[p - 1]')})
        when 2 then concat(case when m % 100 = 98 then 'hit wkt b ' else 'b ' end, {credit('bowler[p - 1]')})
        when 3 then concat('lbw b ', {credit('bowler[p - 1]')})
        when 4 then concat('st ', {credit('fielder[p - 1]')}, ' b ', {credit('bowler[p - 1]')})
        when 5 then 'run out'
        else case when p = hurt then 'rtrd hurt' else 'not out' end end"""
    dash = "lpad(case when {0} = 0 then '-' else cast({0} as string) end, 5)"
    batter = f"""case when p > batted then rpad({player('bat_key', 'p')}, 16)
        else concat(rpad({player('bat_key', 'p')}, 16), rpad({out_text}, 26),
            lpad(cast(runs[p - 1] as string), 5), lpad(cast(runs[p - 1] + spare[p - 1] as string), 5),
            {dash.format('(runs[p - 1] div 8)')}, {dash.format('(runs[p - 1] div 20)')}) end"""
    given = "case when p = 9 then total - 4 * (total div 5) else total div 5 end"
    per = f"((({given}) * case when fmt = 6 then 500 else 600 end + balls[p - 1] div 2) div balls[p - 1])"
    overs = "concat(cast({0} div 6 as string), '.', cast({0} % 6 as string))"
    bowled = f"case when fmt = 6 then cast(balls[p - 1] as string) else {overs.format('balls[p - 1]')} end"
    bowler_line = f"""concat(rpad({player('bowl_key', 'p')}, 16), lpad({bowled}, 6),
        lpad(cast({_h('k', '40 + p')} % 4 as string), 5), lpad(cast({given} as string), 6),
        lpad(cast(size(filter(slots, q -> how[q - 1] between 0 and 4 and bowler[q - 1] = p)) as string), 5),
        lpad(concat(cast({per} div 100 as string), '.', lpad(cast({per} % 100 as string), 2, '0')), 8))"""
    fall = """concat(cast(w as string), '-', cast(case when w = 10 then total
        else extras + aggregate(slice(runs, 1, w), 0L, (a, r) -> a + r) end as string))"""
    falls = f"transform(filter(slots, w -> w <= nw and {{0}}), w -> {fall})"
    ordinal = "element_at(array('1st', '2nd', '3rd'), cast(1 + s % 3 as int))"
    international = (
        f"case when s % 7 = 0 then 'Only {{0}}' else concat({ordinal}, ' {{0}} (of ', 1 + s % 5, ')') end"
    )
    competition = f"""case fmt
        when 0 then {international.format('Test Match')}
        when 1 then {international.format('One Day International')}
        when 2 then {international.format('20 Over International')}
        when 3 then concat('English 20 Over Trophy', case when s % 4 = 0 then '' else ' - North' end)
        when 4 then 'English FC League - D1'
        when 5 then 'English Challenge Trophy - Group A'
        when 6 then concat('English 100 Ball Trophy', case when s % 2 = 0 then '' else ' - Final' end)
        else 'Village Cup' end"""
    date_text = """case when m % 9 = 0 then date_format(match_date, 'd MMMM yyyy')
        else date_format(match_date, 'd MMM yyyy') end"""
    outcome = """case
        when s % 10 <= 3 then concat(side_a, ' won by ', 1 + s % 150, ' runs')
        when s % 10 <= 6 then concat(side_b, ' won by ', 1 + s % 10, ' wickets')
        when s % 10 = 7 then concat(side_a, ' won by an innings and ', 1 + s % 200, ' runs')
        when s % 20 = 8 then 'Match drawn' when s % 20 = 18 then 'Match tied'
        when s % 3 = 0 then 'No result' else 'Abandoned' end"""
    award = f"""case when m % 13 = 0 then array()
        when m % 77 = 0 then array('Man of the match: Z Substitute')
        else array(concat('Man of the match: ', {player('side_a_key', '1 + s % 11')})) end"""
    number_of = "case when k <= 2 then '1st' else '2nd' end"
    wickets_text = """case when nw = 10 then 'all out'
        else concat(nw, case when m % 6 = 1 then ' wkts dec' else ' wkts' end) end"""
    faced = f"case when fmt = 6 then concat(all_balls, ' balls') else concat({overs.format('all_balls')}, ' overs') end"
    lines = f"""concat(
        case when k = 1 then array(concat(home, ' v ', away), concat({competition}, ' - ', {date_text}), '{STARS}')
             else array() end,
        array(concat(bat, ' - ', {number_of}, ' Innings                    R    B   4s   6s'), '{DASHES}'),
        transform(slots, p -> {batter}),
        array('{DASHES}', concat('Extras: (lb 1)', lpad(extras, 30)),
            concat('TOTAL: (', {wickets_text}, ', ', {faced}, ')', lpad(total, 20)), '{STARS}',
            concat('                ', case when fmt = 6 then '   B    D     R    W    Econ'
                when fmt in (2, 3) then '   O    D     R    W    Econ' else '   O    M     R    W    Econ' end),
            '{DASHES}'),
        transform(slice(slots, 5, 5), p -> {bowler_line}),
        array('', 'Fall of Wickets:', array_join({falls.format('w <= 5')}, '   '),
            array_join({falls.format('w > 5')}, '   '), '{STARS}'),
        case when k = innings then concat(array({outcome}), {award}) else array() end)"""
    parts = innings.selectExpr("source_file_name", f"struct(k, {lines} as lines) as part")
    text = "array_join(flatten(transform(array_sort(collect_list(part)), p -> p.lines)), '\\n') as value"
    return (
        parts.groupBy("source_file_name")
        .agg(F.expr(text))
        .selectExpr("value", "source_file_name", "timestamp_ntz'2026-09-01 03:00:00' as loaded_at")
    )
