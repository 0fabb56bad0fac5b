"""Star, factor, series and ranking operators on the order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchbook.bindings.registry import Registry
from matchbook.bindings.scorecards import plain
from matchbook.functions.measures import (
    balls_to_overs,
    blended_factor,
    overs_to_balls,
    percent,
    pooled_batting,
    pooled_bowling,
    ratio,
)
from matchbook.functions.text import surrogate_key
from matchbook.operators import quality
from matchbook.operators.factor import leave_one_out
from matchbook.operators.rank import leaderboard, recent_form, top_per_group
from matchbook.operators.resolve import resolve_suffixes
from matchbook.operators.scan import scan_groups, with_totals
from matchbook.operators.series import gap_series
from matchbook.operators.stands import collapses, cumulative_deltas
from matchbook.operators.star import role, union_names
from matchbook.session import stored
from matchbook.sources.tables import cents, table

REGISTRY = Registry()
_add = REGISTRY.add

_PRICE = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_TOTAL = "CAST(round(o_totalprice * 100) AS BIGINT)"
_VALUE = "CAST(round(value * 100) AS BIGINT)"


def _percent_sql(a: str, b: str) -> str:
    six = f"(({a})::HUGEINT * 2000000 + ({b})) // (2 * ({b}))"
    return f"(CASE WHEN ({b}) > 0 THEN (({six} + 50) // 100)::BIGINT / 100.0 END)::DOUBLE"


# --- star joins --------------------------------------------------------------------------------
def order_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines summed per order and supplier. Combined before the shuffle, so one huge order shrinks
    to one row per supplier before anything is joined to it."""
    lines = table(spark, folder, "lineitem").where(F.col("l_orderkey").isNotNull())
    return lines.groupBy("l_orderkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
        F.sum(cents("l_extendedprice")).alias("cents"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
    )


_PARTS = f"""parts AS (SELECT l_orderkey, l_suppkey, count(*) AS lines, sum(l_quantity::BIGINT)::BIGINT AS quantity,
    sum({_PRICE})::BIGINT AS cents, count(*) FILTER (WHERE l_returnflag = 'R') AS returned
    FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1, 2)"""


@_add(
    f"""SELECT md5(cn.n_name) AS customer_nation_id, cn.n_name AS customer_nation, sn.n_name AS supplier_nation,
        count(*) AS lines, sum({_PRICE})::BIGINT AS cents
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation cn ON c_nationkey = cn.n_nationkey
    JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY 1, 2, 3"""
)
def dim_nation_roles(spark: SparkSession, folder: str) -> DataFrame:
    """One nation dimension built from two sources and joined twice, under two roles."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    supplier = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    buyers = customer.join(nation, "n_nationkey").withColumnRenamed("n_name", "buyer")
    sellers = supplier.join(nation, "n_nationkey").withColumnRenamed("n_name", "seller")
    dim = union_names(buyers.select("buyer"), sellers.select("seller"), name="name").withColumn(
        "nation_id", surrogate_key("name")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    pairs = (
        order_parts(spark, folder)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(buyers, "c_custkey")
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("buyer", "seller")
        .agg(F.sum("lines").alias("lines"), F.sum("cents").alias("cents"))
    )
    buyer, seller = role(dim, "nation_id", "customer", "name"), role(dim, "nation_id", "supplier", "name")
    return (
        pairs.join(buyer, F.col("buyer") == F.col("customer_name"))
        .join(seller, F.col("seller") == F.col("supplier_name"))
        .select(
            "customer_nation_id",
            F.col("customer_name").alias("customer_nation"),
            F.col("supplier_name").alias("supplier_nation"),
            "lines",
            "cents",
        )
    )


@_add(
    f"""WITH {_PARTS} SELECT md5(o_orderkey::VARCHAR) AS order_id, md5(c_custkey::VARCHAR) AS customer_id,
        md5(s_suppkey::VARCHAR) AS supplier_id, cn.n_name AS customer_nation, sn.n_name AS supplier_nation,
        o_orderdate::DATE AS order_date, lines, quantity, cents
    FROM parts JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey JOIN nation cn ON c_nationkey = cn.n_nationkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey"""
)
def fact_star(spark: SparkSession, folder: str) -> DataFrame:
    """Order facts with hash keys to customer and supplier."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customers = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    suppliers = table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    customers = customers.select("c_custkey", F.col("n_name").alias("customer_nation"))
    suppliers = suppliers.select("s_suppkey", F.col("n_name").alias("supplier_nation"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        order_parts(spark, folder)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            surrogate_key("o_orderkey").alias("order_id"),
            surrogate_key("c_custkey").alias("customer_id"),
            F.when(F.col("s_suppkey").isNotNull(), surrogate_key("s_suppkey")).alias("supplier_id"),
            "customer_nation",
            "supplier_nation",
            F.col("o_orderdate").cast("date").alias("order_date"),
            "lines",
            "quantity",
            "cents",
        )
    )


@_add(
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, {_PRICE} AS cents,
        {_percent_sql(_PRICE, 't.total')} AS pct_of_order
    FROM lineitem LEFT JOIN (SELECT l_orderkey AS k, sum({_PRICE})::BIGINT AS total FROM lineitem GROUP BY 1) t
        ON l_orderkey = t.k"""
)
def share_of_total(spark: SparkSession, folder: str) -> DataFrame:
    """Every line's share of its order, in percent."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", cents("l_extendedprice").alias("cents")
    )
    return plain(
        with_totals(lines, ["l_orderkey"], _total=F.sum("cents"))
        .withColumn("pct_of_order", percent("cents", "_total"))
        .drop("_total")
    )


@_add(
    f"""WITH {_PARTS}, lead AS (SELECT l_orderkey, l_suppkey AS leader, cents AS lead_cents FROM
        (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY cents DESC, l_suppkey) AS r FROM parts) WHERE r = 1)
    SELECT p.l_orderkey, p.l_suppkey, p.cents, t.total - p.cents AS others_cents, lead.leader, lead.lead_cents
    FROM parts p JOIN (SELECT l_orderkey, sum(cents)::BIGINT AS total FROM parts GROUP BY 1) t ON p.l_orderkey = t.l_orderkey
    LEFT JOIN lead ON lead.l_orderkey = p.l_orderkey AND lead.leader <> p.l_suppkey"""
)
def opposition_residual_join(spark: SparkSession, folder: str) -> DataFrame:
    """Each supplier of an order against the others: their sum, and the leader where it is another.

    The side with the inequality holds one row per order, so no pairs of suppliers are formed.
    """
    parts = order_parts(spark, folder).select("l_orderkey", "l_suppkey", "cents")
    best = F.struct(F.col("cents").alias("c"), (-F.col("l_suppkey")).alias("s"))
    order = parts.groupBy("l_orderkey").agg(F.sum("cents").alias("_total"), F.max(best).alias("_best"))
    rows = parts.join(order.select("l_orderkey", "_total"), "l_orderkey")
    lead = order.select(
        F.col("l_orderkey").alias("_order"),
        (-F.col("_best.s")).alias("leader"),
        F.col("_best.c").alias("lead_cents"),
    )
    joined = rows.join(
        lead, (F.col("l_orderkey") == F.col("_order")) & (F.col("l_suppkey") != F.col("leader")), "left"
    )
    return joined.select(
        "l_orderkey",
        "l_suppkey",
        "cents",
        (F.col("_total") - F.col("cents")).alias("others_cents"),
        "leader",
        "lead_cents",
    )


#: Lines for each task that compares the suppliers of an order.
FACTOR_ROWS = 250_000


# --- factors -----------------------------------------------------------------------------------
def supplier_factors(spark: SparkSession, folder: str) -> DataFrame:
    """Per order and supplier: own and peer value and returned lines.

    The combined rows are dealt by order, once, to as many tasks as the lines ask for: own sums, sums of the order and
    their join need no other shuffle, and a task stays as large as the input grows.
    """
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    pieces = max(1, tasks, -(-table(spark, folder, "lineitem").count() // FACTOR_ROWS))
    return leave_one_out(
        order_parts(spark, folder).repartition(pieces, "l_orderkey"),
        ["l_orderkey"],
        ["l_suppkey"],
        {"cents": F.col("cents"), "returned": F.col("returned")},
    )


_OWN = f"""{_PARTS}, own AS (SELECT l_orderkey, l_suppkey, cents AS own_cents, returned AS own_returned,
    (sum(cents) OVER (PARTITION BY l_orderkey) - cents)::BIGINT AS peer_cents,
    (sum(returned) OVER (PARTITION BY l_orderkey) - returned)::BIGINT AS peer_returned FROM parts)"""
_UNBLENDED = """CASE WHEN peer_returned > 0 AND peer_cents > 0 THEN
    (CASE WHEN own_returned > 0 THEN own_cents::DOUBLE / own_returned ELSE own_cents::DOUBLE END)
    / (peer_cents::DOUBLE / peer_returned) END"""
_BLENDED = """CASE WHEN own_returned > 0 AND peer_returned > 0 AND peer_cents > 0 THEN
    (peer_cents::DOUBLE / peer_returned)
    / ((own_cents + peer_cents::DOUBLE / peer_returned) / (own_returned + 1.0::DOUBLE)) END"""


def _unblended() -> Column:
    own = F.when(F.col("own_returned") > 0, ratio("own_cents", "own_returned")).otherwise(
        F.col("own_cents").cast("double")
    )
    known = (F.col("peer_returned") > 0) & (F.col("peer_cents") > 0)
    return F.when(known, F.try_divide(own, ratio("peer_cents", "peer_returned")))


@_add(f"WITH {_OWN} SELECT *, {_UNBLENDED} AS factor FROM own")
def factor_unblended(spark: SparkSession, folder: str) -> DataFrame:
    """Own average against the peers' average in the same order; own total stands in without a count."""
    return supplier_factors(spark, folder).withColumn("factor", _unblended())


@_add(f"WITH {_OWN} SELECT *, {_BLENDED} AS factor FROM own")
def factor_blended(spark: SparkSession, folder: str) -> DataFrame:
    """Peer average against the own average blended with one more unit at the peer average."""
    return supplier_factors(spark, folder).withColumn(
        "factor", blended_factor("peer_cents", "peer_returned", "own_cents", "own_returned")
    )


_POOLED_A = """((oc + pc::DOUBLE / nullif(pr, 0)) / (orr + 1.0::DOUBLE)) / nullif(pc::DOUBLE / nullif(pr, 0), 0)"""
_POOLED_B = """CASE WHEN orr > 0 THEN (pc::DOUBLE / nullif(pr, 0))
    / nullif((oc + pc::DOUBLE / nullif(pr, 0)) / (orr + 1.0::DOUBLE), 0) END"""


@_add(
    f"""WITH {_OWN}, pooled AS (SELECT l_suppkey, count(*) AS orders, sum(own_cents)::BIGINT AS oc, sum(own_returned)::BIGINT AS orr,
        sum(peer_cents)::BIGINT AS pc, sum(peer_returned)::BIGINT AS pr,
        round(stddev_samp({_UNBLENDED}), 6) AS spread FROM own GROUP BY 1)
    SELECT l_suppkey, orders, {_POOLED_A} AS pooled_high, {_POOLED_B} AS pooled_low,
        {_POOLED_A} + {_POOLED_B} AS composite, spread FROM pooled"""
)
def factor_pooled(spark: SparkSession, folder: str) -> DataFrame:
    """Factors over all orders of a supplier, recomputed from sums, with their spread."""
    sums = (
        supplier_factors(spark, folder)
        .withColumn("_factor", _unblended())
        .groupBy("l_suppkey")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            *[F.sum(c).alias(c) for c in ("own_cents", "own_returned", "peer_cents", "peer_returned")],
            F.round(F.stddev_samp("_factor"), 6).alias("spread"),
        )
    )
    parts = ("own_cents", "own_returned", "peer_cents", "peer_returned")
    high, low = pooled_batting(*parts), pooled_bowling(*parts)
    return sums.select(
        "l_suppkey",
        "orders",
        high.alias("pooled_high"),
        low.alias("pooled_low"),
        (high + low).alias("composite"),
        "spread",
    )


@_add(
    f"""WITH {_OWN}, dated AS (SELECT own.*, o_orderdate FROM own JOIN orders ON l_orderkey = o_orderkey),
    running AS (SELECT l_suppkey, l_orderkey, sum(own_cents) OVER w AS oc, sum(own_returned) OVER w AS orr,
        sum(peer_cents) OVER w AS pc, sum(peer_returned) OVER w AS pr, row_number() OVER w AS order_number FROM dated
        WINDOW w AS (PARTITION BY l_suppkey ORDER BY o_orderdate, l_orderkey ROWS UNBOUNDED PRECEDING))
    SELECT l_suppkey, l_orderkey, order_number, {_POOLED_A} AS running_high, {_POOLED_B} AS running_low FROM
        (SELECT l_suppkey, l_orderkey, order_number, oc::BIGINT AS oc, orr::BIGINT AS orr, pc::BIGINT AS pc, pr::BIGINT AS pr FROM running)"""
)
def factor_running(spark: SparkSession, folder: str) -> DataFrame:
    """The pooled factors of each supplier after each of its orders."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    dated = supplier_factors(spark, folder).join(orders, "l_orderkey")
    parts = ("own_cents", "own_returned", "peer_cents", "peer_returned")
    run = scan_groups(
        dated,
        ["l_suppkey"],
        ["o_orderdate", "l_orderkey"],
        number="order_number",
        sums={f"_{c}": c for c in parts},
    )
    sums = [f"_{c}" for c in parts]
    return run.select(
        "l_suppkey",
        "l_orderkey",
        "order_number",
        pooled_batting(*sums).alias("running_high"),
        pooled_bowling(*sums).alias("running_low"),
    )


# --- running values, series, spells -----------------------------------------------------------
def user_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Events of each user numbered in time, with the running sum of their values."""
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", cents("value").alias("c"))
    return scan_groups(
        events, ["user_id"], ["ts", "event_id"], number="n", sums={"score": "c"}
    ).select("user_id", "n", "score", "c")


_SCORES = f"""scores AS (SELECT user_id, {_VALUE} AS c,
    row_number() OVER w AS n, sum({_VALUE}) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS score
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


@_add(
    f"""WITH {_SCORES}, d AS (SELECT *, score - coalesce(lag(score) OVER (PARTITION BY user_id ORDER BY n), 0) AS delta FROM scores)
    SELECT user_id, count(*) AS stands, sum(delta)::BIGINT AS added, max(delta)::BIGINT AS biggest, max(score)::BIGINT AS total,
        sum(delta) = max(score) AND bool_and(delta = c) AS reconciles FROM d GROUP BY user_id"""
)
def delta_stands(spark: SparkSession, folder: str) -> DataFrame:
    """Differences of a cumulative score add up to it again."""
    deltas = cumulative_deltas(stored(user_scores(spark, folder)), ["user_id"], "n", "score", "delta")
    return deltas.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("stands"),
        F.sum("delta").alias("added"),
        F.max("delta").alias("biggest"),
        F.max("score").alias("total"),
        ((F.sum("delta") == F.max("score")) & F.bool_and(F.col("delta") == F.col("c"))).alias("reconciles"),
    )


_SERIES = f"""stepped AS (SELECT *, CASE WHEN date_diff('day', lag(o_orderdate) OVER w, o_orderdate) <= 30 THEN 0 ELSE 1 END AS fresh
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
    numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
        ROWS UNBOUNDED PRECEDING)::BIGINT AS series_no FROM stepped)"""


@_add(
    f"""WITH {_SERIES} SELECT o_orderkey, o_custkey, series_no, row_number() OVER w AS series_position,
        count(*) OVER p AS series_size, first_value(o_orderpriority) OVER w AS first_priority,
        (max({_TOTAL}) OVER p)::BIGINT AS largest FROM numbered
    WINDOW p AS (PARTITION BY o_custkey, series_no), w AS (PARTITION BY o_custkey, series_no
        ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
)
def gap_series_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of a customer with at most 30 days between them, numbered, sized and named."""
    orders = table(spark, folder, "orders").withColumn("_cents", cents("o_totalprice"))
    return gap_series(
        orders,
        ["o_custkey"],
        "o_orderdate",
        "o_orderkey",
        30,
        firsts={"first_priority": "o_orderpriority"},
        totals={"largest": F.max("_cents")},
    ).select("o_orderkey", "o_custkey", "series_no", "series_position", "series_size", "first_priority", "largest")


@_add(
    f"""WITH {_SERIES}, runs AS (SELECT *, row_number() OVER w AS series_position, count(*) OVER p AS series_size,
        sum(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END) OVER w AS f_wins,
        sum(CASE o_orderstatus WHEN 'O' THEN 1 ELSE 0 END) OVER w AS o_wins FROM numbered
        WINDOW p AS (PARTITION BY o_custkey, series_no), w AS (PARTITION BY o_custkey, series_no
            ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT o_orderkey, f_wins::BIGINT AS f_wins, o_wins::BIGINT AS o_wins, series_size - series_position AS left_over,
        CASE WHEN abs(f_wins - o_wins) > series_size - series_position THEN 'decided' ELSE 'live' END AS state FROM runs"""
)
def series_state(spark: SparkSession, folder: str) -> DataFrame:
    """Wins of both sides so far, matches left, and whether the lead can still be caught."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    status = F.col("o_orderstatus")
    run = gap_series(
        orders,
        ["o_custkey"],
        "o_orderdate",
        "o_orderkey",
        30,
        sums={
            "f_wins": F.when(status == "F", 1).otherwise(0),
            "o_wins": F.when(status == "O", 1).otherwise(0),
        },
    )
    left = F.col("series_size") - F.col("series_position")
    lead = F.abs(F.col("f_wins") - F.col("o_wins"))
    return run.select(
        "o_orderkey",
        "f_wins",
        "o_wins",
        left.alias("left_over"),
        F.when(lead > left, "decided").otherwise("live").alias("state"),
    )


@_add(
    f"""WITH {_SCORES}, z AS (SELECT user_id, 0::BIGINT AS n, 0::BIGINT AS score FROM scores WHERE n = 1
        UNION ALL SELECT user_id, n, score FROM scores),
    s AS (SELECT user_id, n, score, lead(score, 3) OVER w AS after FROM z WINDOW w AS (PARTITION BY user_id ORDER BY n)),
    f AS (SELECT *, CASE WHEN n - lag(n) OVER w < 3 THEN 0 ELSE 1 END AS fresh FROM s WHERE after - score < 3000
        WINDOW w AS (PARTITION BY user_id ORDER BY n)),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS spell FROM f)
    SELECT user_id, min(n) + 1 AS first_fall, max(n) + 3 AS last_fall, min(score)::BIGINT AS score_before,
        max(after)::BIGINT AS score_after FROM g GROUP BY user_id, spell"""
)
def collapse_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Spells of three or more events in a row that add less than 30, overlapping ones merged."""
    return plain(collapses(user_scores(spark, folder), ["user_id"], "n", "score", 3, 3000))


@_add(
    f"""SELECT o_orderkey, o_custkey, (sum({_TOTAL}) OVER w)::BIGINT / (count(*) OVER w)::DOUBLE AS running_average
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)"""
)
def running_average(spark: SparkSession, folder: str) -> DataFrame:
    """Average order value of a customer up to each order."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", cents("o_totalprice").alias("c")
    )
    run = scan_groups(
        orders,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        number="n",
        sums={"total": "c"},
    )
    return run.select("o_orderkey", "o_custkey", ratio("total", "n").alias("running_average"))


# --- names -------------------------------------------------------------------------------------
@_add(
    """WITH asked AS (SELECT s_suppkey, s_nationkey, right(s_name, (1 + s_suppkey % 3)::INT) AS fragment FROM supplier)
    SELECT a.s_suppkey, a.fragment, CASE WHEN count(DISTINCT s_name) = 1 THEN max(s_name) END AS resolved,
        count(DISTINCT s_name) AS hits
    FROM asked a LEFT JOIN supplier s ON s.s_nationkey = a.s_nationkey
        AND lower(s_name) LIKE '%' || lower(a.fragment) AND a.s_suppkey % 10 <> 9 GROUP BY 1, 2"""
)
def resolve_suffix_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """Endings of supplier names looked up within their nation; guarded rows stay with 0 hits."""
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    fragment = F.right("s_name", (1 + F.col("s_suppkey") % 3).cast("int"))
    asked = supplier.withColumn("fragment", fragment).drop("s_name")
    guarded = F.when(F.col("s_suppkey") % 10 != 9, F.col("fragment"))
    found = resolve_suffixes(asked, supplier, ["s_nationkey"], "s_name", {"resolved": (guarded, "hits")})
    return found.drop("s_nationkey")


# --- summaries ---------------------------------------------------------------------------------
@_add(
    f"""WITH o AS (SELECT o_custkey AS custkey, year(o_orderdate) AS y, count(*) AS orders, sum({_TOTAL})::BIGINT AS spent,
            count(*) FILTER (WHERE o_totalprice >= 400000) AS large_orders FROM orders GROUP BY 1, 2),
        l AS (SELECT o_custkey AS custkey, year(l_shipdate) AS y, sum(l_quantity::BIGINT)::BIGINT AS quantity,
            count(*) FILTER (WHERE l_quantity >= 45) AS big_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            GROUP BY 1, 2),
        r AS (SELECT custkey, y FROM o UNION SELECT custkey, y FROM l)
    SELECT r.custkey, r.y, coalesce(orders, 0) AS orders, spent, coalesce(large_orders, 0) AS large_orders, quantity,
        coalesce(big_lines, 0) AS big_lines FROM r LEFT JOIN o ON r.custkey = o.custkey AND r.y = o.y
        LEFT JOIN l ON r.custkey = l.custkey AND r.y = l.y"""
)
def summary_multi_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Customer and year over two facts: counts default to 0, sums stay NULL without rows."""
    key = ["custkey", "y"]
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    bought = orders.groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").cast("long").alias("y")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(cents("o_totalprice")).alias("spent"),
        F.count_if(F.col("o_totalprice") >= 400000).alias("large_orders"),
    )
    per_order = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey", F.year("l_shipdate").cast("long").alias("y"))
        .agg(
            F.sum(F.col("l_quantity").cast("long")).alias("q"),
            F.count_if(F.col("l_quantity") >= 45).alias("b"),
        )
    )
    shipped = (
        per_order.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("custkey")), "l_orderkey")
        .groupBy(*key)
        .agg(F.sum("q").alias("quantity"), F.sum("b").alias("big_lines"))
    )
    roster = bought.select(*key).unionByName(shipped.select(*key)).distinct()
    return (
        roster.join(bought, key, "left")
        .join(shipped, key, "left")
        .fillna(0, ["orders", "large_orders", "big_lines"])
    )


@_add(
    f"""WITH t AS (SELECT n_name, year(o_orderdate) AS y, count(*) AS orders, sum({_TOTAL})::BIGINT AS spent,
            count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
    top AS (SELECT y, max(urgent) AS most FROM t GROUP BY y),
    lead AS (SELECT t.y, CASE WHEN count(*) = 1 THEN max(n_name) END AS leader FROM t JOIN top ON t.y = top.y AND urgent = most GROUP BY 1)
    SELECT n_name, t.y, orders, spent, urgent, n_name = leader AS led FROM t JOIN lead ON t.y = lead.y"""
)
def team_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Nation and year, with a flag that is NULL in a year nobody led alone."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    per_customer = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").cast("long").alias("y"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(cents("o_totalprice")).alias("spent"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        )
    )
    teams = (
        per_customer.join(customer, "c_custkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "y")
        .agg(*[F.sum(c).alias(c) for c in ("orders", "spent", "urgent")])
    )
    top = teams.groupBy("y").agg(F.max("urgent").alias("urgent"))
    lead = (
        teams.join(top, ["y", "urgent"])
        .groupBy("y")
        .agg(F.when(F.count(F.lit(1)) == 1, F.max("n_name")).alias("leader"))
    )
    return teams.join(lead, "y").withColumn("led", F.col("n_name") == F.col("leader")).drop("leader")


# --- rankings ----------------------------------------------------------------------------------
@_add(
    """SELECT l_suppkey, count(*) AS lines, count(*) FILTER (WHERE l_returnflag = 'R')::DOUBLE
        / nullif(count(*) FILTER (WHERE l_linestatus = 'F'), 0) AS rate
    FROM lineitem GROUP BY 1 HAVING count(*) >= 20 ORDER BY rate DESC NULLS LAST, l_suppkey LIMIT 10"""
)
def leaderboard_min_sample(spark: SparkSession, folder: str) -> DataFrame:
    """Top ten suppliers by a ratio, among those with at least 20 lines."""
    rates = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("r"),
        F.count_if(F.col("l_linestatus") == "F").alias("f"),
    )
    rated = rates.select("l_suppkey", "lines", ratio("r", "f").alias("rate"))
    order = [F.desc_nulls_last("rate"), F.asc("l_suppkey")]
    return leaderboard(rated, order, 10, at_least=F.col("lines") >= 20)


@_add(
    f"""SELECT o_custkey, string_agg(t, ', ' ORDER BY o_orderdate, o_orderkey) AS form FROM
        (SELECT *, ({_TOTAL} // 100)::VARCHAR || CASE WHEN o_orderstatus = 'O' THEN '*' ELSE '' END AS t,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
    WHERE r <= 5 GROUP BY 1"""
)
def last_five_form(spark: SparkSession, folder: str) -> DataFrame:
    """The last five orders of each customer as text, '*' for an open one."""
    whole = F.floor(cents("o_totalprice") / 100).cast("long").cast("string")
    text = F.concat(whole, F.when(F.col("o_orderstatus") == "O", "*").otherwise(""))
    return recent_form(table(spark, folder, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], text)


@_add(
    f"""SELECT l_suppkey, q::BIGINT AS quantity, c AS cents FROM (SELECT l_suppkey, l_quantity::BIGINT AS q, {_PRICE} AS c,
        row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, {_PRICE}) AS r FROM lineitem) WHERE r = 1"""
)
def best_figures(spark: SparkSession, folder: str) -> DataFrame:
    """The best line of each supplier: highest quantity, then lowest price."""
    best = F.max(F.struct(F.col("l_quantity").cast("long").alias("q"), (-cents("l_extendedprice")).alias("c")))
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey")
        .agg(best.alias("b"))
        .select("l_suppkey", F.col("b.q").alias("quantity"), (-F.col("b.c")).alias("cents"))
    )


@_add(
    f"""SELECT n_name, rank, c_custkey, spent FROM (SELECT n_name, c_custkey, spent,
        row_number() OVER (PARTITION BY n_name ORDER BY spent DESC, c_custkey) AS rank FROM
        (SELECT o_custkey, sum({_TOTAL})::BIGINT AS spent FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey) WHERE rank <= 3"""
)
def top_performers(spark: SparkSession, folder: str) -> DataFrame:
    """The three biggest customers of each nation."""
    spent = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(cents("o_totalprice")).alias("spent")
    )
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    named = (
        spent.join(table(spark, folder, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", "c_custkey", "spent")
    )
    return plain(top_per_group(named, ["n_name"], [F.desc("spent"), F.asc("c_custkey")], 3))


@_add(
    """WITH day AS (SELECT p_type, l_shipdate::DATE AS d, l_suppkey, sum(l_quantity::BIGINT)::BIGINT AS q
            FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
        holder AS (SELECT p_type, d, l_suppkey FROM (SELECT *, row_number() OVER
            (PARTITION BY p_type, d ORDER BY q DESC, l_suppkey) AS r FROM day) WHERE r = 1),
        last AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY d DESC) AS back FROM holder),
        now AS (SELECT p_type, l_suppkey, d FROM last WHERE back = 1)
    SELECT now.p_type, now.l_suppkey AS incumbent, now.d AS latest,
        count(*) FILTER (WHERE last.l_suppkey = now.l_suppkey) AS held_of_last_five
    FROM now JOIN last ON last.p_type = now.p_type AND back <= 5 GROUP BY 1, 2, 3"""
)
def incumbent(spark: SparkSession, folder: str) -> DataFrame:
    """Who held a role on the latest day, and on how many of the last five days.

    A day's holder is found by aggregation; only the last five days of a role meet in one window.
    """
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    day = (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey", F.col("l_shipdate").cast("date").alias("d"), "l_suppkey")
        .agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
        .join(parts, "l_partkey")
        .groupBy("p_type", "d", "l_suppkey")
        .agg(F.sum("q").alias("q"))
    )
    holder = day.groupBy("p_type", "d").agg(
        F.max_by("l_suppkey", F.struct("q", -F.col("l_suppkey"))).alias("holder")
    )
    last = top_per_group(holder, ["p_type"], [F.desc("d")], 5, "back")
    held = last.groupBy("p_type").agg(
        F.max_by("holder", "d").alias("incumbent"),
        F.max("d").alias("latest"),
        F.collect_list("holder").alias("_holders"),  # at most five
    )
    same = F.filter("_holders", lambda h: h == F.col("incumbent"))
    return held.select("p_type", "incumbent", "latest", F.size(same).cast("long").alias("held_of_last_five"))


@_add(
    f"""WITH o AS (SELECT c_mktsegment, c_custkey, count(*) AS n, sum({_TOTAL})::BIGINT AS t FROM orders
        JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
    f AS (SELECT c_mktsegment, sum(t)::BIGINT / sum(n)::DOUBLE AS field FROM o WHERE n >= 5 GROUP BY 1)
    SELECT o.c_custkey, o.c_mktsegment, t::DOUBLE / n AS own_average, field AS field_average,
        (t::DOUBLE / n) / field AS against_field, n < 5 AS small_sample FROM o LEFT JOIN f ON o.c_mktsegment = f.c_mktsegment"""
)
def field_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer's average against the pooled average of the qualifying field."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    own = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("t"))
        .join(customer, "c_custkey")
    )
    field = own.where(F.col("n") >= 5).groupBy("c_mktsegment").agg(
        ratio(F.sum("t"), F.sum("n")).alias("field_average")
    )
    average = ratio("t", "n")
    return own.join(field, "c_mktsegment", "left").select(
        "c_custkey",
        "c_mktsegment",
        average.alias("own_average"),
        "field_average",
        F.try_divide(average, F.col("field_average")).alias("against_field"),
        (F.col("n") < 5).alias("small_sample"),
    )


# Fixed value: the levels shown side by side.
LEVELS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@_add(
    "SELECT c_mktsegment, "
    + ", ".join(
        f"sum({_TOTAL}) FILTER (WHERE r_name = '{r}')::BIGINT AS {r.lower().replace(' ', '_')}" for r in LEVELS
    )
    + """ FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 1"""
)
def pivot_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Spending per segment, one column per region, never added together."""
    spent = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(cents("o_totalprice")).alias("spent")
    )
    nation = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    wide = (
        spent.join(customer, "c_custkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("c_mktsegment")
        .pivot("r_name", LEVELS)
        .agg(F.sum("spent"))
    )
    return wide.select("c_mktsegment", *[F.col(r).alias(r.lower().replace(" ", "_")) for r in LEVELS])


@_add(
    f"""SELECT o_orderpriority, count(*) AS orders, sum({_TOTAL})::BIGINT AS cents FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-03-01' AND o_orderdate < TIMESTAMP '1998-04-01' GROUP BY 1"""
)
def month_by_category(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per priority in one month; the date range reaches the scan."""
    day = F.col("o_orderdate")
    in_month = (day >= F.expr("timestamp_ntz'1998-03-01'")) & (day < F.expr("timestamp_ntz'1998-04-01'"))
    return table(spark, folder, "orders").where(in_month).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(cents("o_totalprice")).alias("cents")
    )


@_add(
    """SELECT l_suppkey, sum((l_quantity::BIGINT // 6) * 10 + l_quantity::BIGINT % 6)::BIGINT / 10.0::DOUBLE AS overs_naive,
        sum(l_quantity::BIGINT)::BIGINT AS balls,
        ((sum(l_quantity::BIGINT)::BIGINT // 6) * 10 + sum(l_quantity::BIGINT)::BIGINT % 6) / 10.0::DOUBLE AS overs_exact
    FROM lineitem GROUP BY 1"""
)
def overs_naive_vs_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Overs added as decimals against overs added as balls."""
    overs = balls_to_overs(F.col("l_quantity").cast("long"))
    sums = table(spark, folder, "lineitem").select("l_suppkey", overs.alias("o")).groupBy("l_suppkey").agg(
        F.sum("o").alias("overs_naive"), F.sum(overs_to_balls("o")).alias("balls")
    )
    return plain(sums.withColumn("overs_exact", balls_to_overs("balls")))


@_add(
    """SELECT (SELECT count(*) FROM lineitem) AS lines,
        (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS credited_lines,
        (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS reconciles"""
)
def reconcile_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Two one-row totals side by side (a join of one row with one row)."""
    per_order = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    all_lines = table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("lines"))
    credited = per_order.join(orders, "l_orderkey").agg(F.sum("n").alias("credited_lines"))
    return all_lines.crossJoin(credited).withColumn("reconciles", F.col("lines") == F.col("credited_lines"))


_CHECKS = [
    ("not_null", "orders", "o_orderdate", "error", "orders WHERE o_orderdate IS NULL"),
    ("unique", "orders", "o_orderkey", "error", "(SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)"),
    (
        "unique_combination",
        "lineitem",
        "l_orderkey,l_linenumber",
        "warn",
        "(SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
    ),
    ("accepted_values", "orders", "o_orderstatus", "warn", "orders WHERE o_orderstatus NOT IN ('F', 'O')"),
    (
        "relationships",
        "lineitem",
        "l_orderkey",
        "error",
        "lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)",
    ),
    (
        "relationships",
        "orders",
        "o_orderkey",
        "warn",
        "orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE o_orderkey = l_orderkey)",
    ),
    ("accepted_range", "lineitem", "l_quantity", "error", "lineitem WHERE l_quantity < 1 OR l_quantity > 50"),
    ("accepted_range", "lineitem", "l_discount", "warn", "lineitem WHERE l_discount <= 0 OR l_discount >= 1"),
    (
        "expression_is_true",
        "lineitem",
        "shipped after 1995",
        "error",
        "lineitem WHERE NOT (l_shipdate >= TIMESTAMP '1995-01-01') AND l_linestatus = 'F'",
    ),
    (
        "same_row_count",
        "long lines",
        "n",
        "warn",
        """(SELECT doc_id FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
            WHERE length(line) < 20 GROUP BY doc_id)""",
    ),
]


@_add(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"check\", '{t}' AS table_name, '{k}' AS column_name, '{s}' AS severity, "
        f"count(*) AS failures, count(*) = 0 AS passed FROM {q}"
        for c, t, k, s, q in _CHECKS
    )
)
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """One row per data check over the given tables."""
    from matchbook.bindings.texts import document_lines

    orders, lineitem = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    lines = document_lines(spark, folder)
    checks = [
        quality.not_null(orders, "orders", "o_orderdate"),
        quality.unique(orders, "orders", "o_orderkey"),
        quality.unique(lineitem, "lineitem", "l_orderkey", "l_linenumber", severity="warn"),
        quality.accepted_values(orders, "orders", "o_orderstatus", ["F", "O"], severity="warn"),
        quality.relationship(lineitem, "lineitem", "l_orderkey", orders, "o_orderkey"),
        quality.relationship(orders, "orders", "o_orderkey", lineitem, "l_orderkey", severity="warn"),
        quality.accepted_range(lineitem, "lineitem", "l_quantity", 1, 50),
        quality.accepted_range(lineitem, "lineitem", "l_discount", 0, 1, inclusive=False, severity="warn"),
        quality.expression_true(
            lineitem,
            "lineitem",
            "shipped after 1995",
            F.col("l_shipdate") >= F.expr("timestamp_ntz'1995-01-01'"),
            where=F.col("l_linestatus") == "F",
        ),
        quality.same_row_count(lines, lines.where(F.length("line") >= 20), "long lines", "doc_id", "n", severity="warn"),
    ]
    return quality.report(checks)


_ORDER_CHECK = """SELECT user_id, n, score, prev_score FROM (SELECT user_id, n, score,
    lag(score) OVER (PARTITION BY user_id ORDER BY n) AS prev_score FROM scores) WHERE score - prev_score < 100"""


@_add(f"WITH {_SCORES} {_ORDER_CHECK}")
def small_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose cumulative score rose by less than one unit: a window column, then a filter on it."""
    scores = user_scores(spark, folder)
    stepped = scan_groups(scores, ["user_id"], ["n"], lags={"prev_score": "score"})
    return stepped.where(F.col("score") - F.col("prev_score") < 100).select("user_id", "n", "score", "prev_score")
