"""Every operator on the driver's tables, next to the same question in plain SQL.

Each function takes (spark, directory) and returns a DataFrame over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonframe import operators as op
from seasonframe.functions import SortKey, exact_ratio, row_differs, sort_keys
from seasonframe.plans.inputs import (
    between_years,
    cents,
    customers,
    nation_years,
    order_years,
    plain_types,
    user_days,
)
from seasonframe.sources import read_driver_table as read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Shared SQL inputs, the counterparts of seasonframe.plans.inputs.
BAT = """bat AS (
    SELECT o_custkey AS pid, year(o_orderdate) AS yr, o_orderstatus AS team,
           CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderkey AS k
    FROM orders)"""
TS = f"""{BAT},
season AS (
    SELECT n_nationkey AS teamid, n_name AS name, n_regionkey AS region, yr,
           count(*) AS w, CAST(sum(cents) AS BIGINT) AS rev
    FROM bat JOIN customer ON c_custkey = pid JOIN nation ON n_nationkey = c_nationkey
    GROUP BY n_nationkey, n_name, n_regionkey, yr),
ts AS (
    SELECT *, CASE WHEN row_number() OVER (PARTITION BY yr ORDER BY w DESC, teamid) = 1
                   THEN 'Y' ELSE 'N' END AS won
    FROM season)"""
DAYS = """days AS (
    SELECT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, event_type
    FROM events)"""


def ratio_sql(num: str, den: str, digits: int = 2, percent: bool = False) -> str:
    """num / den rounded half away from zero on whole numbers, as a double; NULL where den is 0."""
    factor = 2 * (100 if percent else 1) * 10**digits
    units = f"((abs({num}) * {factor} + abs({den})) // nullif(2 * abs({den}), 0))"
    signed = f"CASE WHEN ({num} < 0) <> ({den} < 0) THEN -{units} ELSE {units} END"
    return f"CAST(CAST({signed} AS VARCHAR) || 'e-{digits}' AS DOUBLE)"  # as text, so rounded once only


def big(*columns: str) -> str:
    """``name`` or ``expression AS name``, each as BIGINT."""
    parts = [c.rsplit(" AS ", 1) if " AS " in c else (c, c.split(".")[-1]) for c in columns]
    return ", ".join(f"CAST({e} AS BIGINT) AS {n}" for e, n in parts)


def query(sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return plain_types(build(spark, directory))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        SQL[build.__name__] = sql
        return run

    return register


# Totals -----------------------------------------------------------------------------


@query(
    f"""WITH {BAT}
    SELECT {big('c_custkey AS pid')}, c_name,
           {big('sum(cents) AS total_cents', 'count(DISTINCT yr) AS order_years')}
    FROM customer LEFT JOIN bat ON pid = c_custkey
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)
    GROUP BY c_custkey, c_name"""
)
def region_customer_totals(spark, directory):
    """Order totals of the customers of one region, those without orders included."""
    people = customers(spark, directory)
    homes = read_table(spark, directory, "nation").where("n_regionkey = 2")
    members = people.join(homes, people.c_nationkey == homes.n_nationkey, "left_semi").select("pid")
    return op.entity_totals(
        people, members, order_years(spark, directory), "pid",
        {"total_cents": "cents"}, {"order_years": "yr"}, ["c_name"],
    )


@query(
    f"""SELECT CASE WHEN p_size BETWEEN 1 AND 10 THEN 'small'
                WHEN p_size IN (20, 25, 30, 35) THEN 'medium' ELSE 'other' END AS size_group,
           {big('sum(l_quantity) AS quantity')}
    FROM lineitem JOIN part ON p_partkey = l_partkey
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
    GROUP BY 1"""
)
def size_bucket_quantities(spark, directory):
    """Quantity shipped in one year per part-size group."""
    shipped = read_table(spark, directory, "lineitem").where(between_years("l_shipdate", 1997, 1997))
    per_part = shipped.groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    sized = per_part.join(
        read_table(spark, directory, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey"
    )
    buckets = {"small": range(1, 11), "medium": [20, 25, 30, 35]}
    return op.bucket_agg(
        sized, "p_size", buckets, "other", [F.sum("quantity").alias("quantity")], label="size_group"
    )


def _bins_sql(num: str, den: str) -> str:
    return f"""WITH {BAT},
    bins AS (SELECT range AS bin_start, range + 1 AS bin_end FROM range(1993, 2003, 2)),
    sums AS (
        SELECT bin_start, bin_end, sum(hit) AS num, {den} AS den
        FROM bins LEFT JOIN (SELECT yr, {num} AS hit FROM bat JOIN orders ON o_orderkey = k) ON yr BETWEEN bin_start AND bin_end
        GROUP BY bin_start, bin_end)
    SELECT {big('bin_start AS begin', 'bin_end AS end')}, {ratio_sql('num', 'den')} AS ratio FROM sums"""


@query(_bins_sql("cents", "count(yr)"))
def two_year_amount_per_order(spark, directory):
    """Mean order amount per two-year bin; the first bin is empty and stays."""
    rows = order_years(spark, directory).withColumn("one", F.lit(1))
    return op.spine_ratio(rows, "yr", 1993, 2003, 2, "cents", "one")


@query(_bins_sql("CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END", "count(yr) // 2"))
def two_year_urgent_per_pair(spark, directory):
    """Urgent orders per pair of orders and two-year bin, with the halved count cut to a whole number."""
    rows = read_table(spark, directory, "orders").select(
        F.year("o_orderdate").alias("yr"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("urgent"),
        F.lit(1).alias("one"),
    )
    return op.spine_ratio(rows, "yr", 1993, 2003, 2, "urgent", "one", den_divisor=2)


_CLICKS = """sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clicks,
             sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS views"""


def _clicks(spark: SparkSession, directory: str) -> DataFrame:
    is_type = lambda t: F.when(F.col("event_type") == t, 1).otherwise(0)
    return user_days(spark, directory).select(
        "user_id", "day", is_type("click").alias("clicks"), is_type("view").alias("views")
    )


@query(
    f"""SELECT {big('user_id', 'clicks', 'views', 'clicks + views AS attempts')},
           {ratio_sql('clicks', '(clicks + views)', percent=True)} AS success_percent
    FROM (SELECT user_id, {_CLICKS} FROM events GROUP BY user_id)
    WHERE clicks + views >= 20"""
)
def click_success_by_user(spark, directory):
    """Share of clicks among clicks and views, for users with at least 20 of them."""
    return op.success_rate(_clicks(spark, directory), "clicks", "views", 20, keys="user_id")


@query(
    f"""WITH {DAYS}
    SELECT {big('user_id', 'day', 'clicks', 'views', 'clicks + views AS attempts')},
           {ratio_sql('clicks', '(clicks + views)', percent=True)} AS success_percent
    FROM (SELECT user_id, day, {_CLICKS} FROM days GROUP BY user_id, day)
    WHERE clicks + views >= 3"""
)
def click_success_by_row(spark, directory):
    """The same judged row by row, on rows of one user and day."""
    rows = _clicks(spark, directory).groupBy("user_id", "day").agg(
        F.sum("clicks").alias("clicks"), F.sum("views").alias("views")
    )
    return op.success_rate(rows, "clicks", "views", 3)


def _unit_cost_sql(made: str) -> str:
    return f"""WITH shipped AS (
        SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem
        WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'),
    made AS ({made}),
    spent AS (SELECT l_suppkey, CAST(sum(cents) AS BIGINT) AS total_cost FROM shipped
              WHERE l_discount > 0.095 GROUP BY l_suppkey)
    SELECT {big('made.l_suppkey', 'total_output', 'total_cost')},
           {ratio_sql('total_cost', 'total_output')} AS unit_cost
    FROM made LEFT JOIN spent ON spent.l_suppkey = made.l_suppkey"""


def _unit_cost(spark: SparkSession, directory: str, minimum: int, qualify: str) -> DataFrame:
    shipped = read_table(spark, directory, "lineitem").where(between_years("l_shipdate", 1997, 1997))
    shipped = shipped.select(
        "l_suppkey", "l_discount", cents("l_extendedprice").alias("cents"), F.col("l_quantity").cast("bigint").alias("qty")
    )
    return op.unit_cost(
        shipped.where("l_discount > 0.095D"), shipped, "l_suppkey", "cents", "qty", "qty", minimum, qualify
    )


@query(
    _unit_cost_sql(
        """SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS total_output FROM shipped
           GROUP BY l_suppkey HAVING sum(l_quantity) >= 2000"""
    )
)
def supplier_unit_cost(spark, directory):
    """Discounted revenue per unit shipped, for suppliers with enough units in total."""
    return _unit_cost(spark, directory, 2000, "total")


@query(
    _unit_cost_sql(
        """SELECT l_suppkey, CAST(sum(l_quantity) AS BIGINT) AS total_output FROM shipped
           WHERE l_quantity >= 10 GROUP BY l_suppkey"""
    )
)
def supplier_unit_cost_by_row(spark, directory):
    """The same with the minimum tested on each row."""
    return _unit_cost(spark, directory, 10, "row")


@query(
    f"""WITH {BAT}, {DAYS},
    high AS (SELECT pid, sum(cents) AS total FROM bat GROUP BY pid HAVING sum(cents) >= 450000000),
    first_day AS (SELECT user_id, min(day) AS day FROM days WHERE event_type = 'purchase' GROUP BY user_id)
    SELECT {big('pid', 'total', 'day AS first_purchase')}, c_name
    FROM high JOIN customer ON c_custkey = pid LEFT JOIN first_day ON user_id = pid"""
)
def big_customers_first_purchase(spark, directory):
    """Customers over a career total with the day of their first purchase event, if any."""
    bought = user_days(spark, directory).where("event_type = 'purchase'")
    first = bought.groupBy(F.col("user_id").alias("pid")).agg(F.min("day").alias("first_purchase"))
    high = op.threshold_with_attribute(
        order_years(spark, directory), "pid", "cents", 450_000_000, first, "first_purchase"
    )
    return high.join(customers(spark, directory).select("pid", "c_name"), "pid")


def _repeat_sql(test: str, groups: int) -> str:
    return f"""WITH {BAT}
    SELECT {big('pid', 'count(*) AS groups')}, c_name
    FROM (SELECT pid, team FROM bat GROUP BY pid, team HAVING sum(cents) {test})
    JOIN customer ON c_custkey = pid GROUP BY pid, c_name HAVING count(*) >= {groups}"""


@query(_repeat_sql(">= 100000000", 2))
def repeat_status_customers(spark, directory):
    """Customers who reach a total in at least two order statuses."""
    kept = op.repeat_threshold(order_years(spark, directory), "pid", "team", "cents", 100_000_000)
    return kept.join(customers(spark, directory).select("pid", "c_name"), "pid")


@query(_repeat_sql("> 50000000", 3))
def repeat_status_customers_exclusive(spark, directory):
    """The same strictly above a smaller total, in three statuses."""
    kept = op.repeat_threshold(
        order_years(spark, directory), "pid", "team", "cents", 50_000_000, inclusive=False, min_groups=3
    )
    return kept.join(customers(spark, directory).select("pid", "c_name"), "pid")


@query(
    f"""WITH {DAYS}
    SELECT event_type, {big('day', 'count(*) AS events', 'count(DISTINCT user_id) AS users')}
    FROM days GROUP BY event_type, day"""
)
def event_totals_by_day(spark, directory):
    """Events and users per type and day, by way of one row per type, day and user."""
    per_user = user_days(spark, directory).groupBy("event_type", "day", "user_id").agg(F.count("*").alias("events"))
    rows = per_user.withColumn("users", F.lit(1))
    return op.grouped_totals(rows, ["event_type", "day"], {"events": "events", "users": "users"})


@query(
    f"""WITH {TS},
    total AS (SELECT n_nationkey AS teamid, yr, sum(cents) AS amount, count(*) AS orders
              FROM bat JOIN customer ON c_custkey = pid JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2)
    SELECT {big('total.teamid AS teamid', 'total.yr AS yr', 'amount', 'orders', 'amount // orders AS amount_per_orders')},
           name, won
    FROM total LEFT JOIN ts ON ts.teamid = total.teamid AND ts.yr = total.yr"""
)
def nation_year_average(spark, directory):
    """Amount and orders per nation and year with the whole-number average and the season's name."""
    yearly = order_years(spark, directory).groupBy("pid", "yr").agg(
        F.count("*").alias("orders"), F.sum("cents").alias("amount")
    )
    homes = customers(spark, directory).select("pid", F.col("c_nationkey").alias("teamid"))
    totals = op.grouped_totals(
        yearly.join(homes, "pid"), ["teamid", "yr"], {"amount": "amount", "orders": "orders"}, per="orders"
    )
    return totals.join(nation_years(spark, directory).select("teamid", "yr", "name", "won"), ["teamid", "yr"], "left")


# Ranking ----------------------------------------------------------------------------

_TS_ROW = big("teamid", "region", "yr", "w", "rev") + ", name, won"


def _extreme_sql(where: str, direction: str) -> str:
    return f"WITH {TS} SELECT {_TS_ROW} FROM ts WHERE {where} ORDER BY w {direction}, teamid, yr LIMIT 1"


@query(_extreme_sql("won = 'N' AND yr >= 1996", "DESC"))
def busiest_untitled_season(spark, directory):
    """The season with the most orders that did not win its year."""
    return op.extreme_row(
        nation_years(spark, directory, first=1996), "w", where="won = 'N'", ties="one", tie_break=["teamid", "yr"]
    )


@query(_extreme_sql("won = 'Y'", "ASC"))
def quietest_title_season(spark, directory):
    """The title season with the fewest orders."""
    return op.extreme_row(
        nation_years(spark, directory), "w", "min", where="won = 'Y'", ties="one", tie_break=["teamid", "yr"]
    )


@query(_extreme_sql("won = 'Y' AND yr <> 2001", "ASC"))
def quietest_title_season_full_years(spark, directory):
    """The same without the incomplete last year."""
    return op.extreme_row(
        nation_years(spark, directory), "w", "min", where="won = 'Y'", exclude="yr = 2001",
        ties="one", tie_break=["teamid", "yr"],
    )


@query(
    f"""SELECT {big('o_orderkey', 'o_custkey')}, o_totalprice
    FROM (SELECT *, rank() OVER (ORDER BY o_totalprice DESC) AS place FROM orders) WHERE place <= 10"""
)
def ten_largest_orders(spark, directory):
    """The ten largest orders, ties kept."""
    rows = read_table(spark, directory, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return op.extreme_row(rows, "o_totalprice", n=10)


@query(
    f"""SELECT {big('l_orderkey', 'l_linenumber')}, l_quantity FROM lineitem
    WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)"""
)
def largest_quantity_lines(spark, directory):
    """All lines that hold the largest quantity; very many tie."""
    rows = read_table(spark, directory, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return op.extreme_row(rows, "l_quantity")


@query(
    f"""WITH {TS},
    placed AS (SELECT *, rank() OVER (PARTITION BY yr ORDER BY rev DESC) AS place FROM ts),
    counted AS (SELECT count(*) AS hits FROM placed WHERE won = 'Y' AND place = 1)
    SELECT {big('hits', '8 AS periods')}, {ratio_sql('hits', '8', percent=True)} AS percent FROM counted"""
)
def title_leader_overlap(spark, directory):
    """How often the title season also had the largest amount, out of a fixed number of years."""
    return op.leader_overlap(
        nation_years(spark, directory), "yr", "rev", F.col("won") == "Y", method="rank", denominator=8
    )


@query(
    f"""WITH {TS},
    tops AS (SELECT yr AS top_yr, max(rev) AS top_rev FROM ts GROUP BY yr),
    counted AS (SELECT count(CASE WHEN rev = top_rev THEN 1 END) AS hits, count(DISTINCT yr) AS periods
                FROM ts JOIN tops ON top_yr = yr WHERE won = 'Y')
    SELECT {big('hits', 'periods')}, {ratio_sql('hits', 'periods', percent=True)} AS percent FROM counted"""
)
def title_leader_overlap_by_max(spark, directory):
    """The same through the yearly maximum, out of the years that had a title."""
    return op.leader_overlap(nation_years(spark, directory), "yr", "rev", F.col("won") == "Y", method="max")


@query(
    f"""WITH lines AS (
        SELECT year(l_shipdate) AS yr, l_quantity, l_returnflag,
               rank() OVER (PARTITION BY year(l_shipdate) ORDER BY l_quantity DESC) AS place FROM lineitem),
    counted AS (SELECT count(CASE WHEN place = 1 THEN 1 END) AS hits, count(DISTINCT yr) AS periods
                FROM lines WHERE l_returnflag = 'R')
    SELECT {big('hits', 'periods')}, {ratio_sql('hits', 'periods', percent=True)} AS percent FROM counted"""
)
def returned_lines_at_top_quantity(spark, directory):
    """Returned lines that hold their year's largest quantity, on raw rows with many ties."""
    lines = read_table(spark, directory, "lineitem").select(
        F.year("l_shipdate").alias("yr"), "l_quantity", "l_returnflag"
    )
    return op.leader_overlap(lines, "yr", "l_quantity", F.col("l_returnflag") == "R")


@query(
    f"""WITH {BAT},
    yearly AS (SELECT pid, yr, sum(cents) AS cents FROM bat GROUP BY pid, yr),
    top AS (SELECT pid, max(cents) AS cents, count(yr) AS periods FROM yearly GROUP BY pid HAVING count(yr) >= 5)
    SELECT {big('top.pid AS pid', 'top.cents AS cents', 'periods')}, c_name
    FROM top JOIN yearly ON yearly.pid = top.pid AND yearly.cents = top.cents JOIN customer ON c_custkey = top.pid
    WHERE yr = 2000 AND top.cents > 0"""
)
def peak_year_customers(spark, directory):
    """Customers with at least five years whose best year was 2000."""
    peaks = op.peak_in_period(
        order_years(spark, directory), "pid", "yr", "cents", 2000, min_periods=5, above=0
    )
    return peaks.join(customers(spark, directory).select("pid", "c_name"), "pid")


def _rankings_sql(source: str, columns: str, window: str, unique: str) -> str:
    return f"""{source}
    SELECT {columns}, {big(
        f'row_number() OVER ({window}, {unique}) AS row_number',
        f'rank() OVER ({window}) AS rank',
        f'dense_rank() OVER ({window}) AS dense_rank')}"""


@query(
    _rankings_sql(f"WITH {TS}", big("teamid", "w"), "ORDER BY w DESC NULLS FIRST", "teamid") + " FROM ts WHERE yr = 1997"
)
def season_rankings(spark, directory):
    """Row number, rank and dense rank of one year's seasons."""
    rows = nation_years(spark, directory, first=1997, last=1997).select("teamid", "w")
    return op.rankings(rows, ("w", "desc"), tie_break="teamid")


@query(
    _rankings_sql("", big("p_partkey", "p_size"), "ORDER BY p_size DESC NULLS FIRST", "p_partkey") + " FROM part"
)
def part_size_rankings(spark, directory):
    """The three rankings over a whole table with heavy ties and no partition key."""
    rows = read_table(spark, directory, "part").select("p_partkey", "p_size")
    return op.rankings(rows, ("p_size", "desc"), tie_break="p_partkey")


@query(
    _rankings_sql(
        "", big("o_orderkey") + ", o_orderstatus",
        "PARTITION BY o_orderstatus ORDER BY o_totalprice ASC NULLS LAST", "o_orderkey",
    )
    + " FROM orders"
)
def order_rankings_by_status(spark, directory):
    """The three rankings within three very large groups."""
    rows = read_table(spark, directory, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return op.rankings(rows, "o_totalprice", "o_orderstatus", "o_orderkey").drop("o_totalprice")


@query(
    _rankings_sql("", big("o_orderkey") + ", o_orderpriority", "ORDER BY o_orderpriority DESC NULLS FIRST", "o_orderkey")
    + " FROM orders"
)
def order_priority_rankings(spark, directory):
    """The three rankings of all orders by a column with five values."""
    rows = read_table(spark, directory, "orders").select("o_orderkey", "o_orderpriority")
    return op.rankings(rows, ("o_orderpriority", "desc"), tie_break="o_orderkey")


def _tally_sql(order: str, place: int) -> str:
    return f"""WITH {TS},
    placed AS (SELECT *, rank() OVER (PARTITION BY region, yr ORDER BY {order}) AS place FROM ts)
    SELECT {big('region', 'teamid', 'count(*) AS times')} FROM placed WHERE place = {place} GROUP BY region, teamid"""


@query(_tally_sql("w ASC NULLS LAST", 1))
def last_place_tally(spark, directory):
    """How often each nation had the fewest orders in its region."""
    return op.rank_tally(nation_years(spark, directory), ["region", "yr"], "w", ["region", "teamid"])


@query(_tally_sql("w DESC NULLS FIRST", 3))
def third_place_tally(spark, directory):
    """How often each nation came third in its region."""
    return op.rank_tally(
        nation_years(spark, directory), ["region", "yr"], ("w", "desc"), ["region", "teamid"], target_rank=3
    )


@query(
    f"""WITH placed AS (
        SELECT l_suppkey, rank() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_quantity ASC NULLS LAST) AS place
        FROM lineitem)
    SELECT {big('l_suppkey', 'count(*) AS times')} FROM placed WHERE place = 1 GROUP BY l_suppkey"""
)
def smallest_line_tally(spark, directory):
    """How often a supplier holds the smallest quantity of its group, on raw rows in few large groups."""
    lines = read_table(spark, directory, "lineitem")
    return op.rank_tally(lines, ["l_returnflag", "l_linestatus"], "l_quantity", "l_suppkey")


# Cohorts ----------------------------------------------------------------------------


@query(
    f"""SELECT {big('o_orderkey', 'o_custkey')}, o_orderstatus, c_name, n_name
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE (o_custkey, o_orderpriority) IN (
        SELECT (o_custkey, o_orderpriority) FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_orderstatus IN ('F', 'O')
        GROUP BY o_custkey, o_orderpriority HAVING count(DISTINCT o_orderstatus) = 2)"""
)
def urgent_in_both_statuses(spark, directory):
    """Urgent orders of customers with urgent orders in both statuses, with name and nation."""
    orders = read_table(spark, directory, "orders").where("o_orderpriority = '1-URGENT'")
    kept = op.members_of_all(orders, ["o_custkey", "o_orderpriority"], "o_orderstatus", ["F", "O"])
    people = customers(spark, directory).select(
        F.col("pid").alias("o_custkey"), "c_name", F.col("c_nationkey").alias("n_nationkey")
    )
    nations = read_table(spark, directory, "nation").select("n_nationkey", "n_name")
    detailed = kept.join(people, "o_custkey").join(nations, "n_nationkey")
    return detailed.select("o_orderkey", "o_custkey", "o_orderstatus", "c_name", "n_name")


def _corr_sql(x: str, y: str) -> str:
    spread = f"nullif(stddev_pop({x}) * stddev_pop({y}), 0)"
    return f"round(covar_pop({x}, {y}) / {spread}, 4)"


@query(
    f"""WITH {TS},
    ranked AS (
        SELECT yr, CAST(w AS DOUBLE) AS w, CAST(rev AS DOUBLE) AS rev,
               CAST(dense_rank() OVER (PARTITION BY yr ORDER BY w DESC) AS DOUBLE) AS w_rank,
               CAST(dense_rank() OVER (PARTITION BY yr ORDER BY rev DESC) AS DOUBLE) AS rev_rank,
               CAST(rank() OVER (PARTITION BY yr ORDER BY {ratio_sql('rev', 'w')} DESC) AS DOUBLE) AS mean_rank
        FROM ts)
    SELECT {big('yr')}, {_corr_sql('w', 'rev')} AS value_corr, {_corr_sql('w_rank', 'rev_rank')} AS rank_corr,
           {_corr_sql('mean_rank', 'rev_rank')} AS mean_rank_corr
    FROM ranked GROUP BY yr"""
)
def yearly_orders_amount_corr(spark, directory):
    """Per year: correlation of orders and amount, on values, on dense ranks and with a rank of the mean."""
    rows = nation_years(spark, directory).withColumn("mean", exact_ratio(F.col("rev"), F.col("w")))
    rows = op.add_ranks(rows, ["yr"], ("w", "desc"), None, "w_rank", rows_per_slice=None)
    rows = op.add_ranks(rows, ["yr"], ("rev", "desc"), None, "rev_rank", rows_per_slice=None)
    rows = op.add_ranks(rows, ["yr"], ("mean", "desc"), "mean_rank", None, rows_per_slice=None)
    pairs = {
        "value_corr": ("w", "rev"), "rank_corr": ("w_rank", "rev_rank"), "mean_rank_corr": ("mean_rank", "rev_rank"),
    }
    return op.grouped_corr(rows, "yr", pairs)


@query(
    f"""SELECT l_returnflag, l_linestatus, {_corr_sql('l_quantity', 'l_extendedprice')} AS price_corr,
           {_corr_sql('l_quantity', 'l_discount')} AS discount_corr
    FROM lineitem GROUP BY l_returnflag, l_linestatus"""
)
def line_corr_by_flag(spark, directory):
    """Correlations over all lines of a few large groups."""
    pairs = {"price_corr": ("l_quantity", "l_extendedprice"), "discount_corr": ("l_quantity", "l_discount")}
    return op.grouped_corr(read_table(spark, directory, "lineitem"), ["l_returnflag", "l_linestatus"], pairs)


@query(
    f"""WITH ranked AS (
        SELECT l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS quantity_rank,
               rank() OVER (PARTITION BY l_returnflag ORDER BY nullif(l_discount, 0.05) DESC NULLS FIRST) AS discount_rank,
               rank() OVER (PARTITION BY l_returnflag ORDER BY l_suppkey DESC) AS supplier_rank FROM lineitem)
    SELECT l_returnflag, {_corr_sql('quantity_rank', 'discount_rank')} AS discount_rank_corr,
           {_corr_sql('quantity_rank', 'supplier_rank')} AS supplier_rank_corr FROM ranked GROUP BY l_returnflag"""
)
def line_rank_corr_by_flag(spark, directory):
    """Correlation of two ranks over all lines of a few large groups, from counts of values."""
    lines = read_table(spark, directory, "lineitem").withColumn("l_discount", F.nullif(F.col("l_discount"), F.lit(0.05)))
    pairs = {"discount_rank_corr": ("l_quantity", "l_discount"), "supplier_rank_corr": ("l_quantity", "l_suppkey")}
    return op.grouped_rank_corr(lines, "l_returnflag", pairs)


@query(
    f"""SELECT o_orderstatus, {big('count(DISTINCT o_custkey) AS customers', 'count(DISTINCT o_orderkey) AS orders')}
    FROM orders GROUP BY o_orderstatus"""
)
def distinct_keys_by_status(spark, directory):
    """Distinct customers and orders of three large groups, by bitmaps."""
    orders = read_table(spark, directory, "orders")
    people = op.distinct_counts(orders, "o_orderstatus", "o_custkey", "customers")
    return people.join(op.distinct_counts(orders, "o_orderstatus", "o_orderkey", "orders"), "o_orderstatus")


_BUYERS = "SELECT user_id FROM events WHERE event_type = 'purchase'"
_HIGH = "SELECT o_custkey FROM orders WHERE o_totalprice >= 450000"


def _buyers(spark: SparkSession, directory: str) -> DataFrame:
    bought = read_table(spark, directory, "events").where("event_type = 'purchase'")
    return bought.select(F.col("user_id").alias("pid"))


def _high_orders(spark: SparkSession, directory: str) -> DataFrame:
    return read_table(spark, directory, "orders").where("o_totalprice >= 450000").select(F.col("o_custkey").alias("pid"))


@query(f"SELECT {big('c_custkey AS pid')}, c_name, c_mktsegment FROM customer WHERE c_custkey IN ({_BUYERS})")
def purchasing_customers(spark, directory):
    """Customers with a purchase event."""
    people = customers(spark, directory).select("pid", "c_name", "c_mktsegment")
    return op.cohort(people, _buyers(spark, directory), "pid")


@query(f"SELECT {big('count(DISTINCT c_custkey) AS members')} FROM customer WHERE c_custkey IN ({_BUYERS})")
def purchasing_customer_count(spark, directory):
    """How many customers have a purchase event."""
    people = customers(spark, directory)
    return op.cohort(people, _buyers(spark, directory), "pid").agg(F.count_distinct("pid").alias("members"))


@query(f"SELECT DISTINCT c_mktsegment FROM customer WHERE c_custkey IN ({_BUYERS})")
def purchasing_segments(spark, directory):
    """The segments that occur among them."""
    people = customers(spark, directory)
    return op.cohort(people, _buyers(spark, directory), "pid").select("c_mktsegment").distinct()


def _segment_counts_sql(base: str) -> str:
    return f"""SELECT {big(
        "count(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END) AS building",
        "count(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 END) AS machinery",
        "count(CASE WHEN c_mktsegment IS NULL THEN 1 END) AS unknown")}
    FROM customer WHERE c_custkey IN ({base})"""


_SEGMENTS = {"building": "BUILDING", "machinery": "MACHINERY", "unknown": None}


@query(_segment_counts_sql(_BUYERS))
def purchasing_segment_counts(spark, directory):
    """Purchasing customers counted per listed segment, in one row."""
    members = op.cohort(customers(spark, directory), _buyers(spark, directory), "pid")
    return op.group_counts(members, "c_mktsegment", "pid", _SEGMENTS)


@query(_segment_counts_sql(_HIGH))
def high_order_segment_counts(spark, directory):
    """The same for customers with a very large order."""
    members = op.cohort(customers(spark, directory), _high_orders(spark, directory), "pid")
    return op.group_counts(members, "c_mktsegment", "pid", _SEGMENTS)


@query(
    f"""WITH base AS (SELECT * FROM customer WHERE c_custkey IN ({_BUYERS}))
    SELECT {big('coalesce(c_custkey, o_custkey) AS pid')}, c_mktsegment, c_name,
           {big('CASE WHEN o_custkey IS NULL THEN 0 ELSE 1 END AS won')}
    FROM base FULL JOIN ({_HIGH}) ON o_custkey = c_custkey"""
)
def purchase_and_high_order_listing(spark, directory):
    """Purchasing customers and very large orders side by side, one row per order."""
    listing = op.cohort_conversion(
        customers(spark, directory), _buyers(spark, directory), _high_orders(spark, directory),
        "pid", "c_mktsegment", how="full", distinct=False, labels=["c_name"],
    )
    return listing.withColumn("won", F.col("won").cast("int"))


def _conversion_sql(group: str, base: str, winners: str) -> str:
    return f"""WITH counted AS (
        SELECT {group}, count(*) AS members, count(CASE WHEN c_custkey IN ({winners}) THEN 1 END) AS converted
        FROM customer WHERE c_custkey IN ({base}) GROUP BY {group})
    SELECT {group}, {big('members', 'converted')}, {ratio_sql('converted', 'members', percent=True)} AS percent
    FROM counted"""


@query(_conversion_sql("c_mktsegment", _BUYERS, _HIGH))
def high_order_conversion(spark, directory):
    """Share of purchasing customers with a very large order, per segment."""
    return op.cohort_conversion(
        customers(spark, directory), _buyers(spark, directory), _high_orders(spark, directory), "pid", "c_mktsegment"
    )


@query(_conversion_sql("c_mktsegment", "SELECT o_custkey FROM orders", _BUYERS))
def purchase_conversion(spark, directory):
    """Share of ordering customers with a purchase event, per segment."""
    ordering = read_table(spark, directory, "orders").select(F.col("o_custkey").alias("pid"))
    return op.cohort_conversion(
        customers(spark, directory), ordering, _buyers(spark, directory), "pid", "c_mktsegment"
    )


_ONE_STATUS = f"""WITH {BAT},
    career AS (SELECT pid, min(team) AS team, count(DISTINCT team) AS teams, count(DISTINCT yr) AS periods,
                      min(yr) AS first_period, max(yr) AS last_period
               FROM bat WHERE pid NOT IN (SELECT pid FROM bat WHERE yr = 2001) GROUP BY pid)"""


@query(
    f"""{_ONE_STATUS}
    SELECT {big('pid', 'periods', 'first_period', 'last_period')}, team FROM career
    WHERE teams = 1 AND periods >= 2"""
)
def single_status_customers(spark, directory):
    """Customers with two or more years, one order status only and nothing in the last year."""
    return op.single_group_members(order_years(spark, directory), "pid", "team", "yr", 2, 2001)


@query(f"{_ONE_STATUS} SELECT {big('count(pid) AS members')} FROM career WHERE teams = 1 AND periods >= 2")
def single_status_customer_count(spark, directory):
    """How many those are, under the strict meaning of NOT IN."""
    members = op.single_group_members(order_years(spark, directory), "pid", "team", "yr", 2, 2001, strict=True)
    return members.agg(F.count("pid").alias("members"))


def _bookend_sql(counted: str) -> str:
    return f"""WITH {BAT},
    several AS (SELECT pid, min(yr) AS first_yr, max(yr) AS last_yr FROM bat
                WHERE pid NOT IN (SELECT pid FROM bat WHERE yr = 2001) GROUP BY pid
                HAVING count(DISTINCT yr) >= 3 AND count(DISTINCT team) > 1),
    ends AS (SELECT bat.pid, team, count(CASE WHEN yr = first_yr THEN 1 END) AS firsts,
                    count(CASE WHEN yr = last_yr THEN 1 END) AS lasts
             FROM bat JOIN several ON several.pid = bat.pid GROUP BY bat.pid, team)
    SELECT {big(f'{counted} AS members')} FROM ends WHERE firsts > 0 AND lasts > 0"""


@query(_bookend_sql("count(DISTINCT pid)"))
def bookend_customers(spark, directory):
    """Customers whose first and last year share a status, with others in their career."""
    return op.bookend_members(order_years(spark, directory), "pid", "team", "yr", 3, 2001)


@query(_bookend_sql("coalesce(sum(firsts * lasts), 0)"))
def bookend_pairs(spark, directory):
    """The same counted as pairs of rows."""
    return op.bookend_members(order_years(spark, directory), "pid", "team", "yr", 3, 2001, count="rows")


# Series -----------------------------------------------------------------------------


def _next_sql(where: str, adjacent: bool) -> str:
    keep = "nyr = yr + 1" if adjacent else "TRUE"
    return f"""WITH {TS},
    ahead AS (SELECT *, lead(yr) OVER s AS nyr, lead(rev) OVER s AS nrev, lead(w) OVER s AS nw
              FROM ts WINDOW s AS (PARTITION BY teamid ORDER BY yr)),
    picked AS (SELECT teamid, name, yr, w, rev, CASE WHEN {keep} THEN nyr END AS next_period,
                      CASE WHEN {keep} THEN nw END AS next_w, CASE WHEN {keep} THEN nrev END AS next_rev
               FROM ahead WHERE {where})"""


_NEXT_COLUMNS = big(
    "teamid", "yr", "w", "rev", "next_period", "next_w", "next_rev",
    "next_w - w AS w_change", "next_rev - rev AS rev_change",
) + ", name"


@query(f"""{_next_sql("won = 'Y'", True)} SELECT {_NEXT_COLUMNS} FROM picked""")
def title_next_year(spark, directory):
    """Title seasons with the following year's values and the changes."""
    return op.next_period_change(
        nation_years(spark, directory), "teamid", "yr", ["w", "rev"], where="won = 'Y'", keep="name"
    )


@query(f"""{_next_sql("w >= 90", False)} SELECT {_NEXT_COLUMNS} FROM picked""")
def busy_next_row(spark, directory):
    """Busy seasons with the next season on record, adjacent or not."""
    return op.next_period_change(
        nation_years(spark, directory), "teamid", "yr", ["w", "rev"], where="w >= 90", require_adjacent=False, keep="name"
    )


@query(
    f"""{_next_sql("won = 'Y'", True)},
    sums AS (SELECT sum(next_w - w) AS sw, count(next_w - w) AS nw, sum(next_rev - rev) AS sr,
                    count(next_rev - rev) AS nr FROM picked)
    SELECT {ratio_sql('sw', 'nw', 0)} AS avg_w_change, {ratio_sql('sr', 'nr', 0)} AS avg_rev_change FROM sums"""
)
def title_average_change(spark, directory):
    """Average change from a title season to the following year."""
    return op.next_period_change(
        nation_years(spark, directory), "teamid", "yr", ["w", "rev"], where="won = 'Y'", summary=True
    )


@query(
    f"""WITH {BAT}, yearly AS (SELECT pid, yr, sum(cents) AS cents FROM bat GROUP BY pid, yr)
    SELECT {big('pid', 'yr', 'cents',
                'sum(cents) OVER (PARTITION BY pid ORDER BY yr) AS running_total',
                'row_number() OVER (PARTITION BY pid ORDER BY yr) AS period_number')} FROM yearly"""
)
def customer_running_totals(spark, directory):
    """Each customer's running total and year number."""
    return op.running_total(order_years(spark, directory), "pid", "yr", "cents")


@query(
    f"""WITH {BAT}
    SELECT {big('k', 'pid',
                'sum(cents) OVER (PARTITION BY pid ORDER BY yr RANGE UNBOUNDED PRECEDING) AS running_total',
                'dense_rank() OVER (PARTITION BY pid ORDER BY yr) AS period_number')} FROM bat"""
)
def order_running_totals(spark, directory):
    """The same per order: orders of one year share the total at its end."""
    rows = order_years(spark, directory).select("pid", "yr", "cents", "k")
    return op.running_total(rows, "pid", "yr", "cents", per_row=True).drop("yr", "cents")


@query(
    f"""WITH {BAT}
    SELECT {big('k', 'sum(cents) OVER (PARTITION BY team ORDER BY yr, k ROWS UNBOUNDED PRECEDING) AS running_total',
                'dense_rank() OVER (PARTITION BY team ORDER BY yr) AS period_number')}, team FROM bat"""
)
def status_running_rows(spark, directory):
    """A row-by-row running total within three very large groups."""
    rows = order_years(spark, directory).select("team", "yr", "cents", "k")
    totals = op.running_total(rows, "team", "yr", "cents", frame="rows", tie_break="k")
    return totals.select("k", "team", "running_total", "period_number")


@query(
    f"""WITH {DAYS}, daily AS (SELECT day, count(*) AS events FROM days GROUP BY day)
    SELECT {big('day', 'events', 'sum(events) OVER (ORDER BY day) AS running_total',
                'row_number() OVER (ORDER BY day) AS period_number')} FROM daily"""
)
def daily_running_events(spark, directory):
    """Running number of events over all days, without an entity."""
    rows = user_days(spark, directory).withColumn("events", F.lit(1))
    return op.running_total(rows, None, "day", "events", calendar=True)


@query(
    f"""WITH {BAT}
    SELECT {big('k', 'cents', 'sum(cents) OVER (ORDER BY k) AS running_total', 'row_number() OVER (ORDER BY k) AS period_number')}
    FROM bat"""
)
def order_key_running_amount(spark, directory):
    """Running amount of all orders along their keys, without an entity."""
    return op.running_total(order_years(spark, directory), None, "k", "cents")


_PACE = f"""WITH {BAT},
    yearly AS (SELECT pid, yr, sum(cents) AS cents FROM bat GROUP BY pid, yr),
    paced AS (SELECT pid, yr, sum(cents) OVER (PARTITION BY pid ORDER BY yr) AS running_total,
                     row_number() OVER (PARTITION BY pid ORDER BY yr) AS step FROM yearly),
    bench AS (SELECT step, running_total AS benchmark_total FROM paced WHERE pid = 1)
    SELECT {big('pid', 'paced.step AS step', 'running_total', 'benchmark_total')}
    FROM paced JOIN bench ON bench.step = paced.step WHERE pid <> 1 AND running_total > benchmark_total"""


def _orders_to_2000(spark: SparkSession, directory: str) -> DataFrame:
    """Later orders count for the benchmark alone, which is compared step by step."""
    return order_years(spark, directory, between_years("o_orderdate", last=2000) | (F.col("o_custkey") == 1))


@query(f"{_PACE} AND yr = 2000")
def ahead_of_pace_in_year(spark, directory):
    """Customers who in 2000 were ahead of customer 1 after as many years."""
    return op.pace_vs_benchmark(_orders_to_2000(spark, directory), "pid", "yr", "cents", 1, at_period=2000)


@query(f"{_PACE} AND paced.step = 3")
def ahead_of_pace_at_step(spark, directory):
    """Customers ahead of customer 1 after three years."""
    return op.pace_vs_benchmark(order_years(spark, directory), "pid", "yr", "cents", 1, at_step=3)


@query(
    f"""WITH {BAT},
    paced AS (SELECT pid, yr, k, sum(cents) OVER (PARTITION BY pid ORDER BY yr, k ROWS UNBOUNDED PRECEDING) AS running_total,
                     dense_rank() OVER (PARTITION BY pid ORDER BY yr) AS step FROM bat),
    ends AS (SELECT step, max_by(running_total, k) AS benchmark_total FROM paced WHERE pid = 1 GROUP BY step)
    SELECT {big('pid', 'paced.step AS step', 'running_total', 'benchmark_total')}
    FROM paced JOIN ends ON ends.step = paced.step
    WHERE pid <> 1 AND running_total > benchmark_total AND yr = 2000"""
)
def ahead_of_pace_by_row(spark, directory):
    """The comparison in 2000 on single orders, without summing a year first."""
    return op.pace_vs_benchmark(
        _orders_to_2000(spark, directory), "pid", "yr", "cents", 1, at_period=2000, aggregate=False, tie_break="k"
    )


def _anomaly_sql(frame: str) -> str:
    gap = "(cents * n - s)"
    return f"""WITH {BAT}, yearly AS (SELECT pid, yr, CAST(sum(cents) AS BIGINT) AS cents FROM bat GROUP BY pid, yr),
    framed AS (SELECT *, sum(cents) OVER f AS s, count(cents) OVER f AS n FROM yearly
               WINDOW f AS (PARTITION BY pid ORDER BY yr {frame} BETWEEN 2 PRECEDING AND 2 FOLLOWING))
    SELECT {big('pid', 'yr', 'cents')}, {ratio_sql('s', 'n', 4)} AS window_mean,
           {ratio_sql(gap, 'n', 4)} AS gap, abs({ratio_sql(gap, 'n', 4)}) AS abs_gap FROM framed"""


@query(_anomaly_sql("ROWS"))
def customer_anomalies_by_row(spark, directory):
    """Each customer-year against the mean of the five rows around it."""
    return op.centered_anomaly(order_years(spark, directory), "pid", "yr", "cents", mode="rows")


@query(_anomaly_sql("RANGE"))
def customer_anomalies(spark, directory):
    """Each customer-year against the mean of the five years around it."""
    return op.centered_anomaly(order_years(spark, directory), "pid", "yr", "cents")


_LEADERS = f"""WITH {DAYS},
    daily AS (SELECT day, event_type, row_number() OVER (PARTITION BY day ORDER BY count(*) DESC, event_type) AS place
              FROM days GROUP BY day, event_type),
    leaders AS (SELECT day, event_type, lag(event_type) OVER (ORDER BY day) AS before, lag(day) OVER (ORDER BY day) AS day_before
                FROM daily WHERE place = 1)"""


def _daily_leaders(spark: SparkSession, directory: str) -> DataFrame:
    daily = user_days(spark, directory).groupBy("day", "event_type").agg(F.count("*").alias("n"))
    lead = F.min_by("event_type", F.struct(-F.col("n"), "event_type"))
    return daily.groupBy("day").agg(lead.alias("event_type"))


@query(f"{_LEADERS} SELECT {big('count(*) AS repeats')} FROM leaders WHERE event_type = before AND day = day_before + 1")
def repeated_daily_leader(spark, directory):
    """How often the day's most frequent event type repeats the day before."""
    return op.repeat_winners(_daily_leaders(spark, directory), "day", "event_type")


@query(
    f"""{_LEADERS}, errors AS (SELECT *, lag(event_type) OVER (ORDER BY day) AS prior FROM leaders WHERE event_type <> 'error')
    SELECT {big('count(*) AS repeats')} FROM errors WHERE event_type = prior"""
)
def repeated_leader_without_errors(spark, directory):
    """The same among days not led by errors, whatever lies between."""
    return op.repeat_winners(
        _daily_leaders(spark, directory), "day", "event_type", where="event_type <> 'error'", require_adjacent=False
    )


@query(
    f"""WITH before AS (SELECT o_orderstatus, lag(o_orderstatus) OVER (ORDER BY o_orderkey) AS prior FROM orders)
    SELECT {big('count(*) AS repeats')} FROM before WHERE o_orderstatus = prior"""
)
def repeated_order_status(spark, directory):
    """How often an order has the status of the order before it, over all orders."""
    orders = read_table(spark, directory, "orders")
    return op.repeat_winners(orders, "o_orderkey", "o_orderstatus", require_adjacent=False)


def _streak_sql(where: str, result: str) -> str:
    return f"""WITH {DAYS},
    active AS (SELECT DISTINCT user_id, day FROM days WHERE {where}),
    {result}
    """


_RUNS = """runs AS (SELECT user_id, day, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS run FROM active),
    placed AS (SELECT user_id, day, row_number() OVER (PARTITION BY user_id, run ORDER BY day) AS streak FROM runs)"""


@query(_streak_sql("event_type = 'purchase'", _RUNS) + f"SELECT {big('user_id', 'day', 'streak')} FROM placed")
def purchase_streaks(spark, directory):
    """Runs of consecutive days with a purchase, per user."""
    return op.streaks(user_days(spark, directory), "user_id", "day", where="event_type = 'purchase'", calendar=True)


@query(
    _streak_sql("event_type = 'purchase' OR event_type = 'click' OR event_type = 'signup'", _RUNS)
    + f"SELECT {big('user_id', 'day', 'streak')} FROM placed"
)
def activity_streaks(spark, directory):
    """The same for days with any of three events."""
    where = "event_type = 'purchase' OR event_type = 'click' OR event_type = 'signup'"
    return op.streaks(user_days(spark, directory), "user_id", "day", where=where, calendar=True)


_SKIPPED_DAY = 19737  # 2024-01-15 as a day number


@query(
    _streak_sql(
        "event_type <> 'view'",
        f"""moved AS (SELECT user_id, CASE WHEN day > {_SKIPPED_DAY} THEN day - 1 ELSE day END AS pos
                      FROM active WHERE day <> {_SKIPPED_DAY}),
        runs AS (SELECT user_id, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS run FROM moved),
        lengths AS (SELECT user_id, run, count(*) AS n FROM runs GROUP BY user_id, run)""",
    )
    + f"SELECT {big('user_id', 'max(n) AS longest_streak')} FROM lengths GROUP BY user_id"
)
def longest_streaks_with_skip(spark, directory):
    """Each user's longest run when one day does not count."""
    return op.streaks(
        user_days(spark, directory), "user_id", "day", where="event_type <> 'view'",
        skip=[_SKIPPED_DAY], longest_only=True, calendar=True,
    )


@query(
    _streak_sql(
        "event_type = 'purchase'",
        f"""runs AS (SELECT user_id, day, CASE WHEN day < {_SKIPPED_DAY} THEN day - row_number() OVER u
                                               WHEN day > {_SKIPPED_DAY} THEN day - row_number() OVER u - 1 END AS run
                     FROM active WINDOW u AS (PARTITION BY user_id ORDER BY day)),
        placed AS (SELECT user_id, day, row_number() OVER (PARTITION BY user_id, run ORDER BY day) AS streak FROM runs)""",
    )
    + f"SELECT {big('user_id', 'day', 'streak')} FROM placed"
)
def purchase_streaks_skip_counted(spark, directory):
    """Runs with one day skipped, where a purchase on that day still uses up a position."""
    return op.streaks(
        user_days(spark, directory), "user_id", "day", where="event_type = 'purchase'",
        skip=[_SKIPPED_DAY], skipped_rows="count", calendar=True,
    )


def _before_after_sql(frame: str, event: str) -> str:
    change = "(s1 * n0 - s0 * n1)"
    return f"""WITH {TS},
    framed AS (SELECT teamid, yr, {event} AS event,
                      sum(w) OVER (PARTITION BY teamid ORDER BY yr {frame} BETWEEN 3 PRECEDING AND 1 PRECEDING) AS s0,
                      count(w) OVER (PARTITION BY teamid ORDER BY yr {frame} BETWEEN 3 PRECEDING AND 1 PRECEDING) AS n0,
                      sum(w) OVER (PARTITION BY teamid ORDER BY yr {frame} BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS s1,
                      count(w) OVER (PARTITION BY teamid ORDER BY yr {frame} BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS n1
               FROM ts)
    SELECT {big('teamid', 'yr')}, {ratio_sql('s0', 'n0', 4)} AS pre_mean, {ratio_sql('s1', 'n1', 4)} AS post_mean,
           {ratio_sql(change, '(n0 * n1)', 4)} AS change
    FROM framed WHERE event AND n0 = 3 AND n1 = 2"""


@query(_before_after_sql("RANGE", "yr = 1998"))
def orders_before_after(spark, directory):
    """Mean yearly orders in the three years before 1998 against the two years after."""
    return op.before_after(
        nation_years(spark, directory), "teamid", "yr", F.col("yr") == 1998, "w", pre=3, post=(1, 2)
    )


@query(_before_after_sql("ROWS", "won = 'N'"))
def orders_before_after_by_row(spark, directory):
    """The same around every season without a title, counted in rows."""
    return op.before_after(
        nation_years(spark, directory), "teamid", "yr", F.col("won") == "N", "w", pre=3, post=(1, 2), mode="rows"
    )


# Ranges -----------------------------------------------------------------------------


@query(
    f"""WITH {BAT}, careers AS (
        SELECT o_custkey AS pid, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders GROUP BY o_custkey)
    SELECT {big('careers.pid AS pid', 'count(o_orderkey) AS orders_meanwhile', 'sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents_meanwhile')}
    FROM careers LEFT JOIN orders ON o_orderdate BETWEEN first_day AND last_day GROUP BY careers.pid"""
)
def orders_during_careers(spark, directory):
    """All customers' orders from each customer's first day to the last: ranges of any width that overlap."""
    orders = read_table(spark, directory, "orders")
    careers = orders.groupBy(F.col("o_custkey").alias("pid")).agg(
        F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day")
    )
    facts = orders.select("o_orderdate", cents("o_totalprice").alias("cents"))
    totals = op.range_totals(facts, careers, "o_orderdate", "first_day", "last_day", {"cents_meanwhile": "cents"}, count="orders_meanwhile")
    return totals.select("pid", "orders_meanwhile", "cents_meanwhile")


@query(
    f"""WITH bands AS (
        SELECT s_suppkey, CAST(round(s_acctbal * 100) AS BIGINT) - s_suppkey % 7 * 1000 AS low,
               CAST(round(s_acctbal * 100) AS BIGINT) + s_suppkey % 5 * 2000 AS high FROM supplier),
    people AS (SELECT c_custkey, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer)
    SELECT {big('s_suppkey', 'c_custkey', 'balance')} FROM bands LEFT JOIN people ON balance BETWEEN low AND high"""
)
def customers_in_balance_bands(spark, directory):
    """Every supplier with the customers in a band around its balance, those without any included."""
    balance = F.round(F.col("s_acctbal") * 100).cast("bigint")
    bands = read_table(spark, directory, "supplier").select(
        "s_suppkey", (balance - F.col("s_suppkey") % 7 * 1000).alias("low"), (balance + F.col("s_suppkey") % 5 * 2000).alias("high")
    )
    people = read_table(spark, directory, "customer").select("c_custkey", F.round(F.col("c_acctbal") * 100).cast("bigint").alias("balance"))
    return op.range_join(people, bands, "balance", "low", "high", how="left").select("s_suppkey", "c_custkey", "balance")


_FOLLOW_SQL = f"""WITH spans AS (
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) + 1 AS low, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS high FROM orders),
    later AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderkey AS next_key, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"""


def _spans(spark, directory):
    orders = read_table(spark, directory, "orders")
    day = F.to_date("o_orderdate")
    spans = orders.select("o_orderkey", "o_custkey", F.date_add(day, 1).alias("low"), F.date_add(day, (F.col("o_orderkey") % 400).cast("int")).alias("high"))
    later = orders.select("o_custkey", day.alias("day"), F.col("o_orderkey").alias("next_key"), cents("o_totalprice").alias("cents"))
    return spans, later


@query(
    f"""{_FOLLOW_SQL}
    SELECT {big('o_orderkey', 'next_key')} FROM spans JOIN later ON later.o_custkey = spans.o_custkey AND day BETWEEN low AND high"""
)
def orders_that_follow(spark, directory):
    """The same customer's orders within a stretch after each order; its length differs by order."""
    spans, later = _spans(spark, directory)
    return op.range_join(later, spans, "day", "low", "high", on="o_custkey").select("o_orderkey", "next_key")


@query(
    f"""{_FOLLOW_SQL}
    SELECT {big('o_orderkey', 'count(next_key) AS followers', 'sum(cents) AS cents_after')}
    FROM spans LEFT JOIN later ON later.o_custkey = spans.o_custkey AND day BETWEEN low AND high GROUP BY o_orderkey"""
)
def amount_that_follows(spark, directory):
    """Number and amount of those orders, for every order."""
    spans, later = _spans(spark, directory)
    totals = op.range_totals(later, spans, "day", "low", "high", {"cents_after": "cents"}, on="o_custkey", count="followers")
    return totals.select("o_orderkey", "followers", "cents_after")


# Cut groups -------------------------------------------------------------------------
# The same questions with slices so small that every table here is cut.

SMALL_SLICE = 500


def _priority_ranks(spark: SparkSession, directory: str) -> DataFrame:
    rows = read_table(spark, directory, "orders").select("o_orderkey", "o_orderpriority")
    return op.rankings(rows, ("o_orderpriority", "desc"), tie_break="o_orderkey", rows_per_slice=SMALL_SLICE)


@query(SQL["order_priority_rankings"])
def order_priority_rankings_in_slices(spark, directory):
    """Global rankings by a column with five values, so that ties cross the cuts."""
    return _priority_ranks(spark, directory)


@query(SQL["order_rankings_by_status"])
def order_rankings_by_status_in_slices(spark, directory):
    """Rankings within three large groups, each cut."""
    rows = read_table(spark, directory, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    ranked = op.rankings(rows, "o_totalprice", "o_orderstatus", "o_orderkey", rows_per_slice=SMALL_SLICE)
    return ranked.drop("o_totalprice")


@query(SQL["part_size_rankings"])
def part_size_rankings_in_slices(spark, directory):
    """Global rankings with heavy ties."""
    rows = read_table(spark, directory, "part").select("p_partkey", "p_size")
    return op.rankings(rows, ("p_size", "desc"), tie_break="p_partkey", rows_per_slice=SMALL_SLICE)


@query(
    f"""SELECT {big('l_orderkey', 'l_linenumber', 'rank() OVER w AS price_rank', 'dense_rank() OVER w AS price_level')}
    FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC)"""
)
def line_price_ranks_in_slices(spark, directory):
    """Ranks without a tie-break within three large groups, by distinct prices that are cut."""
    rows = read_table(spark, directory, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    ranked = op.add_ranks(rows, ["l_returnflag"], ("l_extendedprice", "desc"), "price_rank", "price_level", rows_per_slice=SMALL_SLICE)
    return ranked.select("l_orderkey", "l_linenumber", "price_rank", "price_level")


@query(SQL["status_running_rows"])
def status_running_rows_in_slices(spark, directory):
    """Row-by-row running totals within three large groups, each cut."""
    rows = order_years(spark, directory).select("team", "yr", "cents", "k")
    totals = op.running_total(rows, "team", "yr", "cents", frame="rows", tie_break="k", rows_per_slice=SMALL_SLICE)
    return totals.select("k", "team", "running_total", "period_number")


@query(SQL["order_key_running_amount"])
def order_key_running_amount_in_slices(spark, directory):
    """A running amount over all orders, cut along their keys."""
    return op.running_total(order_years(spark, directory), None, "k", "cents", rows_per_slice=SMALL_SLICE)


@query(SQL["repeated_order_status"])
def repeated_order_status_in_slices(spark, directory):
    """Repetitions of the previous order's status, in blocks with copies of the rows at their edges."""
    orders = read_table(spark, directory, "orders")
    return op.repeat_winners(orders, "o_orderkey", "o_orderstatus", require_adjacent=False, rows_per_slice=SMALL_SLICE)


# Missing values and single primitives -----------------------------------------------

_ODD = """odd AS (
    SELECT o_orderkey AS k, nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '1-URGENT') AS priority,
           nullif(o_custkey % 100, 7) AS pid, year(o_orderdate) AS yr FROM orders)"""


def _odd_orders(spark: SparkSession, directory: str) -> DataFrame:
    """Orders in which one status, one priority and one customer group are missing."""
    return read_table(spark, directory, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("priority"),
        F.nullif(F.col("o_custkey") % 100, F.lit(7)).alias("pid"),
        F.year("o_orderdate").alias("yr"),
    )


@query(f"WITH {_ODD} SELECT {big('k')} FROM odd WHERE status <> 'F' OR priority <> '2-HIGH'")
def orders_unlike_a_row(spark, directory):
    """Row inequality under three-valued logic, where both columns have missing values."""
    return _odd_orders(spark, directory).where(row_differs(["status", "priority"], ["F", "2-HIGH"])).select("k")


@query(
    f"""WITH {_ODD}, ranked AS (
        SELECT k, row_number() OVER (PARTITION BY status ORDER BY priority ASC NULLS FIRST, k) AS row_number,
               rank() OVER (PARTITION BY status ORDER BY priority ASC NULLS FIRST) AS rank,
               dense_rank() OVER (PARTITION BY status ORDER BY priority ASC NULLS FIRST) AS dense_rank FROM odd)
    SELECT {big('k', 'row_number', 'rank', 'dense_rank')} FROM ranked"""
)
def odd_rankings_missing_first(spark, directory):
    """Rankings in groups of which one has no key, with missing values sorted first."""
    rows = _odd_orders(spark, directory).select("k", "status", "priority")
    ranked = op.rankings(rows, SortKey("priority", "asc", "first"), "status", "k")
    return ranked.select("k", "row_number", "rank", "dense_rank")


@query(f"WITH {_ODD} SELECT status, priority, {big('count(*) AS n', 'count(priority) AS known')} FROM odd GROUP BY status, priority")
def odd_group_counts(spark, directory):
    """Counts per group, where a missing value is a group of its own."""
    return _odd_orders(spark, directory).groupBy("status", "priority").agg(
        F.count("*").alias("n"), F.count("priority").alias("known")
    )


@query(
    f"""WITH {_ODD}, career AS (
        SELECT pid FROM odd WHERE pid NOT IN (SELECT pid FROM odd WHERE yr = 2001)
        GROUP BY pid HAVING count(DISTINCT status) = 1 AND count(DISTINCT yr) >= 1)
    SELECT {big('count(pid) AS members')} FROM career"""
)
def members_not_in_a_list_with_a_gap(spark, directory):
    """NOT IN a list that holds a missing key: nobody qualifies."""
    rows = _odd_orders(spark, directory)
    members = op.single_group_members(rows, "pid", "status", "yr", 1, 2001, strict=True)
    return members.agg(F.count("pid").alias("members"))


@query(
    f"""SELECT {big('c_custkey')}, c_name || ' / ' || n_name || ' / ' || nullif(c_mktsegment, 'BUILDING') AS label
    FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal BETWEEN 0 AND 5000"""
)
def customer_labels_in_range(spark, directory):
    """Joined text, missing where a part is, for a closed range of balances."""
    people = read_table(spark, directory, "customer").where(F.col("c_acctbal").between(0, 5000))
    nations = read_table(spark, directory, "nation")
    label = F.concat("c_name", F.lit(" / "), "n_name", F.lit(" / "), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    joined = people.join(nations, F.col("n_nationkey") == F.col("c_nationkey"))
    return joined.select("c_custkey", label.alias("label"))


@query(
    f"""WITH pairs AS (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_suppkey)
    SELECT {big('l_orderkey', 'l_linenumber', 'n')} FROM lineitem JOIN pairs USING (l_orderkey, l_suppkey) WHERE n > 1"""
)
def lines_with_a_repeated_supplier(spark, directory):
    """An inner join on two keys."""
    lines = read_table(spark, directory, "lineitem")
    pairs = lines.groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("n")).where("n > 1")
    return lines.join(pairs, ["l_orderkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "n")


@query(
    f"""WITH best AS (
        SELECT l_returnflag, l_linestatus, l_quantity, max(l_orderkey) AS last_order
        FROM lineitem GROUP BY l_returnflag, l_linestatus, l_quantity)
    SELECT {big('l_orderkey', 'l_linenumber')}, l_returnflag FROM lineitem
    JOIN best USING (l_returnflag, l_linestatus, l_quantity) WHERE l_orderkey = last_order"""
)
def last_lines_of_each_quantity(spark, directory):
    """An inner join on three keys, to the last order of each combination."""
    lines = read_table(spark, directory, "lineitem")
    keys = ["l_returnflag", "l_linestatus", "l_quantity"]
    best = lines.groupBy(*keys).agg(F.max("l_orderkey").alias("last_order"))
    joined = lines.join(best, keys).where("l_orderkey = last_order")
    return joined.select("l_orderkey", "l_linenumber", "l_returnflag")


@query(
    f"""SELECT {big('p_partkey AS k')}, {big('row_number() OVER (ORDER BY nullif(p_size, 50) DESC NULLS LAST, p_retailprice ASC, p_partkey) AS sorted_place')}
    FROM part"""
)
def sorted_parts_with_places(spark, directory):
    """Every row's place by several keys, with an explicit place for missing values."""
    rows = read_table(spark, directory, "part").select(
        F.col("p_partkey").alias("k"), F.nullif(F.col("p_size"), F.lit(50)).alias("size"), "p_retailprice"
    )
    keys = sort_keys([("size", "desc", "last"), "p_retailprice", "k"])
    return op.rankings(rows, keys, tie_break="k").select("k", F.col("row_number").alias("sorted_place"))


@query(
    f"""WITH {TS}, scaled AS (SELECT teamid, yr, CAST(rev AS HUGEINT) * 1000000000000 AS rev, w FROM ts)
    SELECT {big('teamid', 'yr', 'w')}, CAST(rev AS DOUBLE) AS rev, {ratio_sql('rev', 'w')} AS rev_per_w FROM scaled"""
)
def scaled_amount_per_order(spark, directory):
    """Averages whose scaled totals are far beyond 64 bits."""
    rows = nation_years(spark, directory).withColumn("rev", F.col("rev").cast("decimal(20,0)") * F.lit(Decimal(10**12)))
    totals = op.grouped_totals(rows, ["teamid", "yr"], {"rev": "rev", "w": "w"}, per="w", integer_per=False)
    return totals.select("teamid", "yr", "w", "rev", "rev_per_w")
