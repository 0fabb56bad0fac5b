"""Number helpers: balls and overs, guarded ratios, factors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchbook.functions.text import col_of

BALLS_PER_OVER = 6


def balls_to_overs(balls: Column | str) -> Column:
    """20 balls -> 3.2 (three overs and two balls), as decimal(20,1): any whole number of balls fits."""
    b = col_of(balls)
    tenths = F.floor(b / BALLS_PER_OVER) * 10 + b % BALLS_PER_OVER
    return (tenths.cast("decimal(19,0)") / F.lit(10).cast("decimal(2,0)")).cast("decimal(20,1)")


def overs_to_balls(overs: Column | str) -> Column:
    """3.2 -> 20, exact."""
    tenths = (col_of(overs).cast("decimal(20,1)") * 10).cast("long")
    return F.floor(tenths / 10).cast("long") * BALLS_PER_OVER + tenths % 10


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Double division, NULL when the bottom is 0 or NULL."""
    return F.try_divide(col_of(top).cast("double"), col_of(bottom).cast("double"))


def six_digit_ratio(top: Column, bottom: Column) -> Column:
    """Exact division rounded half up to six digits (whole-number SQL division)."""
    return F.round(
        F.try_divide(top.cast("decimal(18,0)"), bottom.cast("decimal(18,0)")), 6
    ).cast("decimal(28,6)")


def percent(top: Column | str, bottom: Column | str) -> Column:
    """``round(top / bottom * 100, 2)`` on exact numbers, only where the bottom is positive."""
    value = six_digit_ratio(col_of(top), col_of(bottom)) * 100
    return F.when(col_of(bottom) > 0, F.round(value, 2).cast("double"))


def blended_factor(peer_top, peer_bottom, own_top, own_bottom) -> Column:
    """peer average / ((own + peer average) / (own count + 1)); NULL without own or peer count.

    One extra unit at the peer average keeps tiny samples finite: the result is at most own + 1.
    """
    peer = ratio(peer_top, peer_bottom)
    own = (col_of(own_top) + peer) / (col_of(own_bottom) + F.lit(1.0))
    return F.when((col_of(own_bottom) > 0) & (peer > 0), peer / own)


def pooled_batting(own_runs, own_outs, peer_runs, peer_outs) -> Column:
    """((own runs + Q) / (own outs + 1)) / Q with Q the peers' pooled average."""
    q = ratio(peer_runs, peer_outs)
    return F.try_divide((col_of(own_runs) + q) / (col_of(own_outs) + F.lit(1.0)), q)


def pooled_bowling(own_runs, own_wickets, peer_runs, peer_wickets) -> Column:
    """P / ((own runs + P) / (own wickets + 1)), NULL when no wicket was taken."""
    p = ratio(peer_runs, peer_wickets)
    blended = (col_of(own_runs) + p) / (col_of(own_wickets) + F.lit(1.0))
    return F.when(col_of(own_wickets) > 0, F.try_divide(p, blended))
