"""Metric layer: named measures over one fact, by any dimension reachable from it.

Ratios are always recomputed from sums, whatever the grouping. So a measure is either made of the rows of its fact, or of
a rollup: a table of those sums at a coarser grain, which can be merged with the rollup of other rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.functions.measures import overs_to_balls, pooled_batting, pooled_bowling, ratio
from matchbook.plans.entities import is_dismissal

# The published roles and links of the model.
# Logical dimension tables: role -> (stored table, key).
ROLES = {"dim_match": ("dim_match", "match_id")}
ROLES |= {
    f"{role}_teams": ("dim_team", "team_id")
    for role in ("home", "away", "winning", "batting", "bowling", "summary", "summary_opposition")
}
ROLES |= {
    role: ("dim_player", "player_id")
    for role in ("batters", "bowlers", "fielders", "motm_players", "summary_players")
}

# Many-to-one links: table -> {foreign key: role}.
LINKS = {
    "dim_match": {
        "home_team_id": "home_teams",
        "away_team_id": "away_teams",
        "winning_team_id": "winning_teams",
        "man_of_the_match_id": "motm_players",
    },
    "fact_batting": {"player_id": "batters", "team_id": "batting_teams", "opposition_team_id": "bowling_teams"},
    "fact_bowling": {"player_id": "bowlers", "team_id": "bowling_teams", "opposition_team_id": "batting_teams"},
    "fact_fow": {"team_id": "batting_teams"},
    "fact_partnership": {"team_id": "batting_teams"},
    "fact_fielding": {
        "team_id": "batting_teams",
        "batter_id": "batters",
        "fielder_id": "fielders",
        "bowler_id": "bowlers",
    },
    "fact_player_match_summary": {
        "player_id": "summary_players",
        "team_id": "summary_teams",
        "opposition_team_id": "summary_opposition_teams",
    },
    "fact_team_match_summary": {
        "team_id": "summary_teams",
        "opposition_team_id": "summary_opposition_teams",
    },
}

class OfRows:
    """What a measure is made of, summed up over the rows of a fact."""

    def sum(self, key: str, value: Column | None = None) -> Column:
        return F.sum(key if value is None else value)

    def count(self, key: str) -> Column:
        return F.count(key)

    def mean(self, key: str) -> Column:
        return F.avg(key)

    def stddev(self, key: str) -> Column:
        return F.stddev_samp(key)


class OfStates:
    """The same over mergeable states (sums, counts, sums of squares); ``states`` collects how each is made of rows."""

    def __init__(self) -> None:
        self.states: dict[str, Column] = {}

    def _state(self, name: str, made: Column) -> Column:
        self.states[name] = made
        return F.sum(name)

    def sum(self, key: str, value: Column | None = None) -> Column:
        return self._state(f"sum_{key}", F.sum(key if value is None else value))

    def count(self, key: str) -> Column:
        return F.coalesce(self._state(f"n_{key}", F.count(key)), F.lit(0))

    def mean(self, key: str) -> Column:
        return F.try_divide(self.sum(key).cast("double"), self.count(key))

    def stddev(self, key: str) -> Column:
        n, total = self.count(key), self.sum(key)
        squares = self._state(f"squares_{key}", F.sum(F.col(key) * F.col(key)))
        # Below the precision of the sums there is no spread; above it, the result is right to about nine digits.
        spread = squares - F.try_divide(total * total, n)
        spread = F.when(spread > squares * 1e-12, spread).otherwise(0.0)
        return F.when(n > 1, F.sqrt(F.try_divide(spread, n - 1)))


Measure = Callable[[OfRows | OfStates], Column]


def total(column: str) -> Measure:
    return lambda a: a.sum(column)


def tally(name: str, condition: Callable[[], Column]) -> Measure:
    return lambda a: a.sum(name, F.when(condition(), 1).otherwise(0))


def _of(name: str) -> Measure:
    return lambda a: a.count(name)


def _pooled(function, prefix: str, names: Sequence[str]) -> Measure:
    return lambda a: function(*[a.sum(f"{prefix}_{n}") for n in names])


_pooled_bat = _pooled(
    pooled_batting, "mf_bat", ["own_runs", "own_dismissals", "peer_runs", "peer_dismissals"]
)
_pooled_bowl = _pooled(
    pooled_bowling, "mf_bowl", ["own_runs_conceded", "own_wickets", "peer_runs_conceded", "peer_wickets"]
)


def _outs(a) -> Column:
    return a.sum("outs", is_dismissal(F.col("dismissal_type")))


def _balls(a) -> Column:
    return a.sum("balls", overs_to_balls("overs"))


# The published names of the measures.
METRICS: dict[str, dict[str, Measure]] = {
    "fact_batting": {
        "total_runs": total("runs"),
        "total_balls_faced": total("balls_faced"),
        "total_fours": total("fours"),
        "total_sixes": total("sixes"),
        "dismissals": _outs,
        "innings_count": _of("runs"),
        "batting_average": lambda a: ratio(a.sum("runs"), _outs(a)),
        "batting_strike_rate": lambda a: ratio(a.sum("runs"), a.sum("balls_faced")) * 100,
    },
    "fact_bowling": {
        "total_runs_conceded": total("runs_conceded"),
        "total_wickets": total("wickets"),
        # Adds 7.4 as a decimal, as published; the exact figures follow.
        "total_overs_naive": total("overs"),
        "economy_rate": lambda a: ratio(a.sum("runs_conceded"), a.sum("overs")),
        "bowling_average": lambda a: ratio(a.sum("runs_conceded"), a.sum("wickets")),
        "balls_bowled": _balls,
        "economy_exact": lambda a: ratio(a.sum("runs_conceded") * 6, _balls(a)),
    },
    "dim_match": {"matches_count": _of("match_date")},
    "fact_partnership": {
        "total_partnership_runs": total("partnership_runs"),
        "avg_partnership_runs": lambda a: a.mean("partnership_runs"),
    },
    "fact_fielding": {
        "total_catches": tally("caught", lambda: F.col("dismissal_type") == "CAUGHT"),
        "total_stumpings": tally("stumped", lambda: F.col("dismissal_type") == "STUMPED"),
    },
    "fact_player_match_summary": {
        "matches_played": _of("match_id"),
        "sum_total_runs": total("total_runs"),
        "sum_dismissals": total("dismissals"),
        "sum_centuries": total("centuries"),
        "sum_five_wicket_hauls": total("five_wicket_hauls"),
        "pooled_batting_match_factor": _pooled_bat,
        "batting_match_factor_stddev": lambda a: a.stddev("batting_match_factor"),
        "pooled_bowling_match_factor": _pooled_bowl,
        "bowling_match_factor_stddev": lambda a: a.stddev("bowling_match_factor"),
        "all_rounder_composite": lambda a: _pooled_bat(a) + _pooled_bowl(a),
    },
    "fact_team_match_summary": {
        "matches_played": _of("match_id"),
        "wins": tally("wins", lambda: F.col("won")),
        "sum_total_runs": total("total_runs"),
        "sum_total_wickets_taken": total("total_wickets_taken"),
    },
}


def _split(name: str) -> tuple[str, str]:
    table, _, column = name.partition(".")
    if not column:
        raise ValueError(f"use <table>.<name>, not {name!r}")
    return table, column


def flat(name: str) -> str:
    """Column name a dimension has while the metric is computed."""
    return name.replace(".", "__")


def star_frame(tables, fact: str, dimensions: Sequence[str]) -> DataFrame:
    """The fact with the asked dimension columns joined in, each as ``<role>__<column>``."""
    frame: DataFrame = getattr(tables, fact)
    wanted: dict[str, list[str]] = {}
    for name in dimensions:
        role, column = _split(name)
        wanted.setdefault(role, [])
        if column not in wanted[role]:
            wanted[role].append(column)
    for column in wanted.pop(fact, []):
        frame = frame.withColumn(flat(f"{fact}.{column}"), F.col(column))

    def link(frame: DataFrame, role: str, key: Column, columns: Sequence[str]) -> DataFrame:
        table, pk = ROLES[role]
        dim = getattr(tables, table).select(
            F.col(pk).alias(f"_{role}_key"), *[F.col(c).alias(flat(f"{role}.{c}")) for c in columns]
        )
        return frame.join(dim, key == F.col(f"_{role}_key"), "left").drop(f"_{role}_key")

    direct = {role: fk for fk, role in LINKS[fact].items()}
    through = {} if fact == "dim_match" else {role: fk for fk, role in LINKS["dim_match"].items()}
    unknown = [r for r in wanted if r not in direct and r not in through and r != "dim_match"]
    if unknown:
        raise ValueError(f"{unknown} cannot be reached from {fact}")
    second_hop = [r for r in wanted if r not in direct and r in through]
    if fact != "dim_match" and ("dim_match" in wanted or second_hop):
        columns = list(dict.fromkeys([*wanted.get("dim_match", []), *[through[r] for r in second_hop]]))
        frame = link(frame, "dim_match", F.col("match_id"), columns)
    for role, columns in wanted.items():
        if role in direct:
            frame = link(frame, role, F.col(direct[role]), columns)
        elif role in second_hop:
            frame = link(frame, role, F.col(flat(f"dim_match.{through[role]}")), columns)
    return frame


def metric(
    tables,
    metrics: Sequence[str],
    by: Sequence[str] = (),
    where: Mapping[str, Callable[[Column], Column]] | None = None,
    at_least: Column | None = None,
) -> DataFrame:
    """``metrics`` grouped ``by`` dimensions, e.g.

    ``metric(t, ["fact_batting.batting_average"], by=["batters.player_name"],
    where={"dim_match.match_format": lambda c: c == "TEST"})``

    Metrics may come from several facts. Each fact is then grouped on its own and the groups are joined,
    so rows of one do not multiply those of another; a group that one fact lacks has NULLs there. The
    roles ``players`` and ``teams`` stand for each fact's own player and side. ``at_least`` filters the
    groups by their output columns (a minimum sample).
    """
    facts: dict[str, list[str]] = {}
    for name in metrics:
        fact, measure = _split(name)
        facts.setdefault(fact, []).append(measure)
    names = [_split(b)[1] for b in by]
    labels = names if len(set(names)) == len(names) else [flat(b) for b in by]
    parts = [_grouped(tables, fact, measures, by, labels, dict(where or {})) for fact, measures in facts.items()]
    taken = [m for measures in facts.values() for m in measures]
    if len(set(taken)) < len(taken):
        raise ValueError("metrics of different facts with one name cannot stand side by side")
    out = parts[0]
    for part in parts[1:]:
        right = part.select(*[F.col(label).alias(f"_{label}") for label in labels], *[c for c in part.columns if c not in labels])
        met = [F.col(label).eqNullSafe(F.col(f"_{label}")) for label in labels]
        joined = out.join(right, met, "full") if labels else out.crossJoin(right)
        sides = [F.coalesce(label, f"_{label}").alias(label) for label in labels]
        out = joined.select(*sides, *[c for c in [*out.columns, *right.columns] if c in taken])
    return out if at_least is None else out.where(at_least)


def _grouped(tables, fact: str, measures: Sequence[str], by: Sequence[str], labels: Sequence[str], where: dict) -> DataFrame:
    """The measures of one fact by the dimensions."""
    own = [_own_role(fact, b) for b in by]
    conditions = {_own_role(fact, name): condition for name, condition in where.items()}
    needed = [*own, *conditions]
    rollup = tables.fitting(fact, needed) if isinstance(tables, Rollups) else None
    frame, source = (star_frame(tables, fact, needed), OfRows()) if rollup is None else (rollup, OfStates())
    for name, condition in conditions.items():
        frame = frame.where(condition(F.col(flat(name))))
    grouped = frame.groupBy(*[F.col(flat(b)).alias(label) for b, label in zip(own, labels)])
    return grouped.agg(*[METRICS[fact][m](source).alias(m) for m in measures])


def states_of(tables, fact: str, by: Sequence[str]) -> DataFrame:
    """A rollup: one row per value of the dimensions ``by``, with the states of all measures of the fact."""
    own = list(dict.fromkeys(_own_role(fact, b) for b in by))
    source = OfStates()
    for measure in METRICS[fact].values():
        measure(source)
    frame = star_frame(tables, fact, own)
    return frame.groupBy(*[flat(b) for b in own]).agg(*[made.alias(name) for name, made in source.states.items()])


def merged_states(rollups: Sequence[DataFrame]) -> DataFrame:
    """Rollups of one fact and grain over separate rows, such as batches, as the rollup of all rows."""
    both = reduce(DataFrame.unionByName, rollups)
    grain = [c for c in both.columns if "__" in c]
    return both.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in both.columns if c not in grain])


class Rollups:
    """Tables with rollups beside them. ``metric`` answers from the smallest one that has every dimension it needs,
    and from the fact if there is none; everything else is read from the tables."""

    def __init__(self, tables, path: str):
        self.tables, self.path = tables, path
        self._held: dict[str, list[tuple[int, set[str], DataFrame]]] = {}

    def add(self, fact: str, by: Sequence[str], states: DataFrame | None = None) -> "Rollups":
        """Store the states of the fact by these dimensions (``states``, if they are already made)."""
        made = states_of(self.tables, fact, by) if states is None else states
        held = self._held.setdefault(fact, [])
        folder = f"{self.path}/{fact}-{len(held)}"
        made.write.mode("overwrite").parquet(folder)
        frame = made.sparkSession.read.schema(made.schema).parquet(folder)
        held.append((frame.count(), {c for c in frame.columns if "__" in c}, frame))
        return self

    def fitting(self, fact: str, dimensions: Sequence[str]) -> DataFrame | None:
        needed = {flat(d) for d in dimensions}
        fits = [(rows, i) for i, (rows, grain, _) in enumerate(self._held.get(fact, [])) if needed <= grain]
        return self._held[fact][min(fits)[1]][2] if fits else None

    def __getattr__(self, table: str) -> DataFrame:
        return getattr(self.tables, table)


def _own_role(fact: str, name: str) -> str:
    """``players.x`` and ``teams.x`` under the fact's own role."""
    role, column = _split(name)
    if role in ("players", "teams"):
        key = "team_id" if role == "teams" else "fielder_id" if "fielder_id" in LINKS[fact] else "player_id"
        role = LINKS[fact][key]
    return f"{role}.{column}"
