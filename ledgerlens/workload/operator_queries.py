"""Registered queries: one per operator, over the driver tables, with its SQL answer."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators import aggregates, filters, joins, lookback, merge, money, positions, rollup, setops
from ledgerlens.operators.asof import asof_join_left, asof_join_ranged
from ledgerlens.session import ensure_utc
from ledgerlens.workload.driver_tables import EVENTS_AS_OF, load
from ledgerlens.workload.present import present, select_sql

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Operator:
    build: Callable[[SparkSession, Tables], DataFrame]
    columns: tuple[str, ...]
    sql: str

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return present(self.build(spark, lambda name: load(spark, sf_dir, name)), self.columns)

    def oracle(self) -> str:
        return select_sql(self.sql, self.columns)


OPERATORS: dict[str, Operator] = {}


def operator(name: str, columns: str, sql: str):
    def register(build):
        OPERATORS[name] = Operator(build, tuple(columns.split()), " ".join(sql.split()))
        return build

    return register


MONEY = "decimal(18,2)"
AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"


def _money(name: str):
    return F.col(name).cast(MONEY)


# Projections ---------------------------------------------------------------


@operator(
    "proj_rename_cast",
    "order_id:i customer:s_ total:d placed:t".replace(":s_", ""),
    "SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer, CAST(o_totalprice AS DECIMAL(18,2)) AS total, o_orderdate AS placed FROM orders",
)
def _(spark, t):
    return t("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer"),
        _money("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("placed"),
    )


@operator(
    "proj_default",
    "p_partkey:i brand",
    "SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#1'), 'Unknown') AS brand FROM part",
)
def _(spark, t):
    return t("part").select(
        "p_partkey", fn.default_text(F.nullif("p_brand", F.lit("Brand#1"))).alias("brand")
    )


@operator(
    "proj_if_null",
    "c_custkey:i segment",
    """SELECT c_custkey, CASE WHEN x IS NULL OR x IN ('', 'null') THEN c_name ELSE x END AS segment FROM
    (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN '' WHEN 'HOUSEHOLD' THEN 'null' ELSE c_mktsegment END AS x FROM customer)""",
)
def _(spark, t):
    segment = F.col("c_mktsegment")
    rough = (
        F.when(segment == "BUILDING", F.lit(None))
        .when(segment == "MACHINERY", F.lit(""))
        .when(segment == "HOUSEHOLD", F.lit("null"))
        .otherwise(segment)
    )
    return t("customer").select("c_custkey", fn.if_blank(rough, F.col("c_name")).alias("segment"))


@operator(
    "proj_null_to_zero_dec",
    "o_orderkey:i amount:d",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount FROM orders",
)
def _(spark, t):
    text = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(
        _money("o_totalprice").cast("string")
    )
    return t("orders").select("o_orderkey", fn.decimal_or_zero(text).alias("amount"))


@operator(
    "proj_epoch_to_null",
    "o_orderkey:i seen:t",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS seen FROM orders",
)
def _(spark, t):
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    sent = F.when(F.col("o_orderkey") % 5 == 0, epoch).otherwise(F.col("o_orderdate"))
    return t("orders").select("o_orderkey", fn.epoch_to_null(sent).alias("seen"))


@operator(
    "proj_unix_to_ts",
    "o_orderkey:i made:t",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE TIMESTAMP '1970-01-01' + to_seconds(1600000000 + o_orderkey) END AS made FROM orders",
)
def _(spark, t):
    seconds = F.when(F.col("o_orderkey") % 4 != 0, (F.col("o_orderkey") + 1600000000).cast("string"))
    return t("orders").select("o_orderkey", fn.unix_timestamp_or_null(seconds).alias("made"))


@operator(
    "proj_id_split",
    "event_id:i address",
    "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE '0x' || user_id END AS address FROM events",
)
def _(spark, t):
    token = F.when(F.col("event_id") % 3 == 0, F.lit("56")).otherwise(
        F.concat(F.lit("56-0x"), F.col("user_id").cast("string"))
    )
    return t("events").select("event_id", fn.split_part(token, "-", 1).alias("address"))


@operator(
    "proj_diff",
    "l_orderkey:i l_linenumber:i diff:d",
    "SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity AS DECIMAL(18,2)) AS diff FROM lineitem",
)
def _(spark, t):
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", (_money("l_extendedprice") - _money("l_quantity")).alias("diff")
    )


@operator(
    "proj_usd",
    "l_orderkey:i l_linenumber:i usd:d",
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2)) AS usd FROM lineitem",
)
def _(spark, t):
    usd = fn.usd_value(_money("l_quantity"), _money("l_extendedprice"))
    return t("lineitem").select("l_orderkey", "l_linenumber", usd.alias("usd"))


# Amounts as a source with 256-bit decimals sends them: a seventh beyond 20 whole digits, a seventh whose product is.
UNITS, PRICE = "(CAST(l_partkey AS BIGINT) + 1)", "(CAST(l_suppkey AS BIGINT) * 1000 + l_linenumber)"
WIDE_SQL = (
    "(SELECT l_orderkey, l_linenumber, l_returnflag, l_orderkey % 7 AS m, l_orderkey % 11 = 10 AS bad, "
    f"CAST({UNITS} AS HUGEINT) * {PRICE} AS x FROM lineitem)"
)


def _wide_lines(t):
    units, price = F.col("l_partkey").cast("bigint") + 1, F.col("l_suppkey").cast("bigint") * 1000 + F.col("l_linenumber")
    m = F.col("l_orderkey") % 7
    amount = (
        F.when(F.col("l_orderkey") % 11 == 10, F.lit("n/a"))
        .when(m == 0, F.concat(units.cast("string"), F.lit("0" * 24)))
        .when(m == 1, F.concat(units.cast("string"), F.lit("0" * 14)))
        .otherwise(units.cast("string"))
    )
    return money.spread(t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        amount.alias("amount"),
        F.concat(price.cast("string"), F.when(m == 1, F.lit("0" * 8)).otherwise(F.lit(""))).alias("price"),
    ))


@operator(
    "proj_usd_quarantine",
    "l_orderkey:i l_linenumber:i reason usd_wide",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN bad THEN 'amount_unreadable' WHEN m = 0 THEN 'amount_too_large' ELSE 'product_too_large' END AS reason,
    CASE WHEN bad THEN NULL ELSE CAST(x AS VARCHAR) || repeat('0', CASE WHEN m = 0 THEN 24 ELSE 22 END) || '.' || repeat('0', 18) END AS usd_wide
    FROM {WIDE_SQL} WHERE bad OR m IN (0, 1)""",
)
def _(spark, t):
    return money.quarantine(_wide_lines(t), ["l_orderkey", "l_linenumber"], "amount", "price")


@operator(
    "agg_usd_total_wide",
    "l_returnflag usd_total usd:d n_wide:i n_unreadable:i",
    f"""SELECT l_returnflag, CAST(coalesce(sum(CASE WHEN m = 0 THEN x * 100 WHEN m = 1 THEN x END) FILTER (WHERE NOT bad), 0) AS VARCHAR)
    || lpad(CAST(coalesce(sum(x) FILTER (WHERE NOT bad AND m > 1), 0) AS VARCHAR), 22, '0') || '.' || repeat('0', 18) AS usd_total,
    NULL AS usd, count(*) FILTER (WHERE NOT bad AND m IN (0, 1)) AS n_wide, count(*) FILTER (WHERE bad) AS n_unreadable
    FROM {WIDE_SQL} GROUP BY l_returnflag""",
)
def _(spark, t):
    return money.usd_totals(_wide_lines(t), ["l_returnflag"], "amount", "price")


@operator(
    "proj_priority_flag",
    "n_nationkey:i enabled",
    """SELECT n_nationkey, CASE WHEN n_nationkey % 5 <> 0 THEN true WHEN n_nationkey % 2 = 0 THEN n_regionkey = 0 ELSE NOT (n_nationkey % 3 = 0) END AS enabled FROM nation""",
)
def _(spark, t):
    key = F.col("n_nationkey")
    end_of_life = F.when(key % 5 == 0, key)
    stored = F.when(key % 2 == 0, F.col("n_regionkey") == 0)
    enabled = (
        F.when(end_of_life.isNull(), F.lit(True))
        .when(stored.isNotNull(), stored)
        .otherwise(~(key % 3 == 0))
    )
    return t("nation").select("n_nationkey", enabled.alias("enabled"))


@operator(
    "proj_alias_expr",
    "o_orderkey:i cents:i",
    "SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE CAST(round(o_totalprice * 100) AS BIGINT) > 20000000",
)
def _(spark, t):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t("orders").select("o_orderkey", cents.alias("cents")).where(F.col("cents") > 20000000)


@operator(
    "proj_typed_null_pad",
    "event_id:i clicks:d purchases:d",
    """SELECT event_id, value AS clicks, CAST(NULL AS DOUBLE) AS purchases FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, NULL, value FROM events WHERE event_type = 'purchase'""",
)
def _(spark, t):
    events = t("events")

    def kind(name, column):
        rows = events.where(F.col("event_type") == name)
        return rows.select("event_id", F.col("value").alias(column))

    return kind("click", "clicks").unionByName(kind("purchase", "purchases"), allowMissingColumns=True)


@operator(
    "proj_flow_sign",
    "event_id:i signed:d direction",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN value WHEN 'error' THEN -value ELSE 0 END AS signed,
    CASE event_type WHEN 'purchase' THEN 'inflow' WHEN 'error' THEN 'outflow' ELSE 'other' END AS direction FROM events""",
)
def _(spark, t):
    kind = F.col("event_type")
    action = F.when(kind == "purchase", "Deposit").when(kind == "error", "WITHDRAWAL").otherwise(kind)
    amount = fn.to_decimal(_money("value"))
    return t("events").select(
        "event_id",
        fn.signed_by_action(action, amount).alias("signed"),
        fn.flow_direction(action).alias("direction"),
    )


# Filters -------------------------------------------------------------------


@operator(
    "flt_validity",
    "o_orderkey:i o_orderdate:t",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_totalprice IS NOT NULL AND o_totalprice > 0 AND CAST(o_orderdate AS DATE) > DATE '1970-01-01'",
)
def _(spark, t):
    good = (F.col("o_totalprice") > 0) & filters.after_epoch(F.col("o_orderdate"))
    return t("orders").where(good)


@operator(
    "flt_range_outlier",
    "l_orderkey:i l_linenumber:i l_extendedprice:d",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity BETWEEN 5 AND 40 AND l_discount BETWEEN 0.02 AND 0.08 AND l_extendedprice BETWEEN 1000 AND 50000",
)
def _(spark, t):
    bounds = {"l_quantity": (5, 40), "l_discount": (0.02, 0.08), "l_extendedprice": (1000, 50000)}
    return t("lineitem").where(filters.within_bounds(bounds))


@operator(
    "flt_value_cap",
    "l_orderkey:i l_linenumber:i l_quantity:d",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2)) < 1000000",
)
def _(spark, t):
    return t("lineitem").where(
        fn.usd_below(_money("l_quantity"), _money("l_extendedprice"), 1_000_000)
    )


@operator(
    "flt_denylist_tuple",
    "o_orderkey:i o_custkey:i o_orderpriority",
    "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE (o_orderpriority, o_orderstatus) NOT IN (('1-URGENT', 'F'), ('5-LOW', 'O'))",
)
def _(spark, t):
    listed = [("1-URGENT", "F"), ("5-LOW", "O")]
    return filters.drop_listed(t("orders"), listed, ["o_orderpriority", "o_orderstatus"])


@operator(
    "flt_scoped_exclusion",
    "o_orderkey:i o_totalprice:d",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_orderpriority = '2-HIGH'
    AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31' AND o_totalprice > 100000)""",
)
def _(spark, t):
    hit = filters.scoped_exclusion(
        F.col("o_orderpriority"),
        "2-HIGH",
        F.col("o_orderdate"),
        "1996-01-01",
        "1997-12-31",
        F.col("o_totalprice"),
        100000,
    )
    return t("orders").where(~hit)


@operator(
    "flt_suffix",
    "p_partkey:i p_name",
    "SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE '%ring'",
)
def _(spark, t):
    return t("part").where(~F.endswith("p_name", F.lit("ring")))


@operator(
    "flt_recent",
    "event_id:i ts:t",
    f"SELECT event_id, ts FROM events WHERE ts >= {AS_OF_SQL} - INTERVAL 15 DAY",
)
def _(spark, t):
    return t("events").where(filters.since(F.col("ts"), EVENTS_AS_OF, 15))


@operator(
    "flt_future_guard",
    "event_id:i ts:t",
    "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' + INTERVAL 1 DAY",
)
def _(spark, t):
    return t("events").where(filters.not_in_future(F.col("ts"), datetime(2024, 1, 20)))


@operator(
    "flt_bool_expr",
    "p_partkey:i p_size:i",
    """SELECT p_partkey, p_size FROM part WHERE NOT (p_type = 'PROMO') AND (p_size < 20 OR (CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_size END) IS NULL)""",
)
def _(spark, t):
    odd = F.when(F.col("p_size") % 2 != 0, F.col("p_size"))
    keep = (F.col("p_type") != "PROMO") & ((F.col("p_size") < 20) | odd.isNull())
    return t("part").where(keep)


# Joins ---------------------------------------------------------------------


@operator(
    "join_inner_dim",
    "n_name customers:i balance:d",
    "SELECT n_name, count(*) AS customers, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def _(spark, t):
    joined = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(_money("c_acctbal")).alias("balance")
    )


@operator(
    "join_chain_3way",
    "o_orderkey:i n_name r_name",
    """SELECT o_orderkey, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, t):
    return (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


@operator(
    "join_left_enrich",
    "c_custkey:i s_name",
    """SELECT c_custkey, s_name FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey AND c_nationkey = s_nationkey""",
)
def _(spark, t):
    match = (F.col("c_custkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey"))
    return t("customer").join(t("supplier"), match, "left")


@operator(
    "join_left_filtered",
    "c_custkey:i orders:i",
    "SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' AND o_totalprice > 200000 GROUP BY c_custkey",
)
def _(spark, t):
    large = t("orders").where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000))
    counted = large.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    # Counting before the join keeps it one row per customer on both sides.
    return (
        t("customer")
        .join(counted, "c_custkey", "left")
        .select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"))
    )


@operator(
    "join_self_alias_twice",
    "c_custkey:i s_suppkey:i c_nation s_nation",
    """SELECT c_custkey, s_suppkey, a.n_name AS c_nation, b.n_name AS s_nation FROM customer JOIN supplier ON c_custkey = s_suppkey
    LEFT JOIN nation a ON c_nationkey = a.n_nationkey LEFT JOIN nation b ON s_nationkey = b.n_nationkey""",
)
def _(spark, t):
    nation = t("nation").select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("nation"))
    return (
        t("customer")
        .join(t("supplier"), F.col("c_custkey") == F.col("s_suppkey"))
        .join(joins.prefixed(nation, "c_"), "c_nationkey", "left")
        .join(joins.prefixed(nation, "s_"), "s_nationkey", "left")
    )


@operator(
    "join_or_condition",
    "c_custkey:i s_suppkey:i",
    """SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey AND (c_custkey % 100 = s_suppkey % 100 OR c_custkey % 7 = s_suppkey)""",
)
def _(spark, t):
    customers = t("customer").select(
        "c_custkey",
        "c_nationkey",
        (F.col("c_custkey") % 100).alias("c_100"),
        (F.col("c_custkey") % 7).alias("c_7"),
    )
    suppliers = t("supplier").select(
        "s_suppkey", "s_nationkey", (F.col("s_suppkey") % 100).alias("s_100")
    )
    return joins.join_either_key(
        customers,
        suppliers,
        [("c_nationkey", "s_nationkey")],
        [("c_100", "s_100"), ("c_7", "s_suppkey")],
    )


@operator(
    "join_const",
    "o_orderkey:i n_name",
    "SELECT o_orderkey, n_name FROM orders JOIN nation ON n_regionkey = 2",
)
def _(spark, t):
    asia = t("nation").where(F.col("n_regionkey") == 2)
    return joins.join_every_match(t("orders"), asia, ["o_orderkey"])


def _clicks_and_prices(t):
    events = t("events")
    clicks = events.where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    prices = events.where(F.col("event_type") == "purchase").select(
        "user_id",
        F.col("ts").alias("priced_at"),
        F.when(F.col("event_id") % 10 != 0, F.col("value")).alias("price"),
    )
    return clicks, prices


@operator(
    "join_asof_left",
    "event_id:i user_id:i ts:t price:d has_price",
    """SELECT l.event_id, l.user_id, l.ts, r.value AS price, r.event_id IS NOT NULL AS has_price
    FROM (SELECT * FROM events WHERE event_type = 'click') l
    ASOF LEFT JOIN (SELECT event_id, user_id, ts, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value FROM events WHERE event_type = 'purchase') r
    ON l.user_id = r.user_id AND l.ts >= r.ts""",
)
def _(spark, t):
    clicks, prices = _clicks_and_prices(t)
    return asof_join_left(
        clicks, prices, ["user_id"], "ts", "priced_at", ["price"], match_flag="has_price"
    )


@operator("join_asof_ranged", " ".join(OPERATORS["join_asof_left"].columns), OPERATORS["join_asof_left"].sql)
def _(spark, t):
    clicks, prices = _clicks_and_prices(t)
    return asof_join_ranged(
        clicks, prices, ["user_id"], "ts", "priced_at", ["price"], match_flag="has_price"
    )


@operator(
    "join_point_lookup",
    "user_id:i total_1d_ago:d total_1w_ago:d total_1m_ago:d",
    """WITH hourly AS (SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS h, sum(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 1, 2)
    SELECT u.user_id, a.total AS total_1d_ago, b.total AS total_1w_ago, c.total AS total_1m_ago FROM (SELECT DISTINCT user_id FROM events) u
    LEFT JOIN hourly a ON u.user_id = a.user_id AND a.h = TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 1 DAY
    LEFT JOIN hourly b ON u.user_id = b.user_id AND b.h = TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 7 DAY
    LEFT JOIN hourly c ON u.user_id = c.user_id AND c.h = TIMESTAMP '2024-01-30 23:00:00' - INTERVAL 29 DAY""",
)
def _(spark, t):
    events = t("events")
    hourly = events.groupBy("user_id", fn.hour_of(F.col("ts")).alias("date_hour")).agg(
        F.sum(_money("value")).alias("total")
    )
    past = lookback.point_lookback(
        hourly,
        ["user_id"],
        "date_hour",
        "total",
        datetime(2024, 1, 30, 23, 40),
        {"1d": 1, "1w": 7, "1m": 29},
    )
    return events.select("user_id").distinct().join(past, "user_id", "left")


@operator(
    "join_anti_tuple",
    "c_custkey:i c_nationkey:i",
    "SELECT c_custkey, c_nationkey FROM customer WHERE (c_custkey, c_nationkey) NOT IN (SELECT s_suppkey, s_nationkey FROM supplier)",
)
def _(spark, t):
    pairs = [("c_custkey", "s_suppkey"), ("c_nationkey", "s_nationkey")]
    return joins.anti_join_keys(t("customer"), t("supplier"), pairs)


@operator(
    "join_anti_null_check",
    "c_custkey:i c_name",
    "SELECT c_custkey, c_name FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') p ON c_custkey = o_custkey WHERE o_custkey IS NULL",
)
def _(spark, t):
    pending = t("orders").where(F.col("o_orderstatus") == "P")
    return joins.anti_join_keys(t("customer"), pending, [("c_custkey", "o_custkey")])


@operator(
    "join_semi_distinct",
    "p_partkey:i p_brand",
    "SELECT DISTINCT p_partkey, p_brand FROM part JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 49) l ON p_partkey = l_partkey",
)
def _(spark, t):
    bulk = t("lineitem").where(F.col("l_quantity") > 49)
    return joins.semi_join_keys(t("part"), bulk, [("p_partkey", "l_partkey")])


@operator(
    "join_latest_load",
    "o_orderkey:i o_custkey:i load_id",
    """WITH loads AS (SELECT r_regionkey AS n, 'L' || r_regionkey AS load_id, TIMESTAMP '2024-01-01' + to_days((r_regionkey * 3) % 5) AS inserted_at FROM region),
    rows_ AS (SELECT o_orderkey, o_custkey, 'L' || (o_orderkey % 5) AS load_id FROM orders),
    newest AS (SELECT o_custkey, arg_max(r.load_id, inserted_at) AS load_id FROM rows_ r JOIN loads l ON r.load_id = l.load_id GROUP BY 1)
    SELECT r.o_orderkey, r.o_custkey, r.load_id FROM rows_ r JOIN newest n ON r.o_custkey = n.o_custkey AND r.load_id = n.load_id""",
)
def _(spark, t):
    return _latest_loads(t).withColumnRenamed("_load_id", "load_id")


def _latest_loads(t: Tables) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    day = F.make_dt_interval((F.col("r_regionkey") * 3) % 5)
    loads = t("region").select(
        F.concat(F.lit("L"), F.col("r_regionkey").cast("string")).alias("load_id"),
        (start + day).alias("inserted_at"),
    )
    rows = t("orders").select(
        "o_orderkey",
        "o_custkey",
        F.concat(F.lit("L"), (F.col("o_orderkey") % 5).cast("string")).alias("_load_id"),
    )
    return merge.latest_load(rows, loads, {"customer": F.col("o_custkey")})


# Aggregates ----------------------------------------------------------------


@operator(
    "agg_sum_group",
    "l_returnflag l_linestatus quantity:d revenue:d",
    "SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem GROUP BY 1, 2",
)
def _(spark, t):
    return t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum(_money("l_quantity")).alias("quantity"),
        F.sum(_money("l_extendedprice")).alias("revenue"),
    )


@operator(
    "agg_avg_group",
    "user_id:i event_type average:d",
    "SELECT user_id, event_type, avg(value) AS average FROM events GROUP BY 1, 2",
)
def _(spark, t):
    return t("events").groupBy("user_id", "event_type").agg(F.avg("value").alias("average"))


@operator(
    "agg_sum_if",
    "user_id:i clicks:d purchases:d",
    """SELECT user_id, sum(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,2)) END) AS clicks,
    sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase') AS purchases FROM events GROUP BY 1""",
)
def _(spark, t):
    kind = F.col("event_type")
    return t("events").groupBy("user_id").agg(
        aggregates.sum_when(kind == "click", _money("value")).alias("clicks"),
        aggregates.sum_when(kind == "purchase", _money("value")).alias("purchases"),
    )


@operator(
    "agg_max_if_pivot",
    "user_id:i click:d view:d purchase:d",
    """SELECT user_id, max(value) FILTER (WHERE event_type = 'click') AS click, max(value) FILTER (WHERE event_type = 'view') AS view,
    max(value) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY 1""",
)
def _(spark, t):
    kinds = ["click", "view", "purchase"]
    return t("events").groupBy("user_id").agg(
        *[aggregates.max_when(F.col("event_type") == k, F.col("value")).alias(k) for k in kinds]
    )


@operator(
    "agg_filter_clause",
    "total_30d:d total_7d:d",
    """SELECT sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - 30) AS total_30d,
    sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - 7) AS total_7d FROM events""",
)
def _(spark, t):
    day, today = F.to_date("ts"), EVENTS_AS_OF.date()
    return t("events").agg(
        *[
            aggregates.sum_when(day >= F.lit(today - timedelta(days=n)), _money("value")).alias(f"total_{n}d")
            for n in (30, 7)
        ]
    )


@operator(
    "agg_last_by_time",
    "user_id:i date_hour:t last_value:d",
    """SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date_hour, arg_max(v, ts) AS last_value FROM
    (SELECT *, CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END AS v FROM events) GROUP BY 1, 2""",
)
def _(spark, t):
    rows = t("events").withColumn("v", F.when(F.col("event_id") % 6 != 0, F.col("value")))
    return rollup.hourly_last(rows, ["user_id"], "ts", {"last_value": "v"})


@operator(
    "agg_latest_row",
    "user_id:i latest:t event_type value:d",
    """SELECT user_id, max(ts) AS latest, arg_max(event_type, ts) AS event_type, arg_max(v, ts) FILTER (WHERE v IS NOT NULL) AS value FROM
    (SELECT user_id, ts, event_type, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS v FROM events WHERE ts >= TIMESTAMP '2024-01-16') GROUP BY 1""",
)
def _(spark, t):
    recent = t("events").where(filters.since(F.col("ts"), EVENTS_AS_OF, 15)).select(
        "user_id",
        "ts",
        F.col("ts").alias("latest"),
        "event_type",
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"),
    )
    return rollup.latest_per_entity(recent, ["user_id"], "ts", ["latest", "event_type", "value"])


@operator(
    "agg_time_bucket",
    "hour:t day:t month:t n:i total:d",
    """SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, CAST(ts AS DATE) AS day, date_trunc('month', ts) AS month, count(*) AS n,
    sum(CAST(value AS DECIMAL(18,2))) AS total FROM events GROUP BY 1, 2, 3""",
)
def _(spark, t):
    ts = F.col("ts")
    return t("events").groupBy(
        fn.hour_of(ts).alias("hour"), fn.day_of(ts).alias("day"), fn.month_of(ts).alias("month")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(_money("value")).alias("total"))


@operator(
    "agg_count_distinct",
    "event_type users:i days:i",
    "SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1",
)
def _(spark, t):
    return t("events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct(F.to_date("ts")).alias("days")
    )


@operator(
    "agg_quantiles",
    "l_returnflag l_extendedprice_quantiles:q l_quantity_quantiles:q",
    """SELECT l_returnflag, quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 1.0]) AS l_extendedprice_quantiles,
    quantile_cont(l_quantity, [0.0, 0.25, 0.5, 0.75, 1.0]) AS l_quantity_quantiles FROM lineitem GROUP BY 1""",
)
def _(spark, t):
    return positions.exact_quantiles(
        t("lineitem"), ["l_returnflag"], ["l_extendedprice", "l_quantity"]
    )


@operator(
    "agg_quantiles_large_groups",
    "event_type value_quantiles:q",
    "SELECT event_type, quantile_cont(v, [0.0, 0.25, 0.5, 0.75, 1.0]) AS value_quantiles FROM (SELECT event_type, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v FROM events) GROUP BY 1",
)
def _(spark, t):
    rows = t("events").withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return positions.exact_quantiles(rows, ["event_type"], ["value"])


@operator(
    "agg_collect_array",
    "o_orderkey:i parts:s",
    "SELECT l_orderkey AS o_orderkey, list(l_partkey ORDER BY l_partkey) AS parts FROM lineitem GROUP BY 1",
)
def _(spark, t):
    return t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sort_array(F.collect_list("l_partkey")).alias("parts")
    )


@operator(
    "agg_collect_distinct",
    "user_id:i kinds:s",
    "SELECT user_id, list_sort(list_distinct(list(event_type) FILTER (WHERE event_type <> 'error'))) AS kinds FROM events GROUP BY 1",
)
def _(spark, t):
    rows = t("events").withColumn("event_type", F.nullif("event_type", F.lit("error")))
    return aggregates.distinct_values(rows, ["user_id"], "event_type", "kinds")


@operator(
    "agg_collect_topn_distinct",
    "l_suppkey:i parts:s",
    "SELECT l_suppkey, list_slice(list_sort(list_distinct(list(l_partkey))), 1, 10) AS parts FROM lineitem GROUP BY 1",
)
def _(spark, t):
    return aggregates.first_distinct_values(t("lineitem"), ["l_suppkey"], "l_partkey", "parts", 10)


_LEG_FIELDS = {"parts": "l_partkey", "amounts": "l_quantity", "usd_values": "l_extendedprice"}


@operator(
    "agg_collect_if_sorted",
    "l_orderkey:i accepted_parts:s accepted_amounts:n accepted_usd_values:n returned_parts:s returned_amounts:n returned_usd_values:n",
    "SELECT l_orderkey, "
    + ", ".join(
        f"list({c} ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) FILTER (WHERE l_returnflag = '{flag}') AS {name}_{suffix}"
        for name, flag in (("accepted", "A"), ("returned", "R"))
        for suffix, c in _LEG_FIELDS.items()
    )
    + " FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1",
)
def _(spark, t):
    return aggregates.legs_to_arrays(
        t("lineitem"),
        ["l_orderkey"],
        "l_returnflag",
        {"accepted": "A", "returned": "R"},
        ["l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"],
        _LEG_FIELDS,
    )


@operator(
    "agg_any",
    "user_id:i any_type any_value:d",
    "SELECT user_id, arg_min(event_type, event_id) AS any_type, arg_min(value, event_id) AS any_value FROM events GROUP BY 1",
)
def _(spark, t):
    return t("events").groupBy("user_id").agg(
        F.min_by("event_type", "event_id").alias("any_type"),
        F.min_by("value", "event_id").alias("any_value"),
    )


@operator(
    "agg_mode",
    "user_id:i event_type",
    """SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS n
    FROM events GROUP BY 1, 2) WHERE n = 1""",
)
def _(spark, t):
    return aggregates.most_frequent(t("events"), ["user_id"], "event_type")


@operator(
    "agg_min_max_ts",
    "user_id:i first_seen:t last_seen:t",
    "SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1",
)
def _(spark, t):
    return t("events").groupBy("user_id").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")
    )


@operator(
    "agg_bool_or",
    "c_nationkey:i any_debt",
    "SELECT c_nationkey, coalesce(bool_or(c_acctbal < 0), false) AS any_debt FROM customer GROUP BY 1",
)
def _(spark, t):
    debt = F.coalesce(F.bool_or(F.col("c_acctbal") < 0), F.lit(False))
    return t("customer").groupBy("c_nationkey").agg(debt.alias("any_debt"))


@operator(
    "agg_json_array",
    "c_custkey:i orders_json",
    """SELECT c_custkey, coalesce('[' || string_agg('{"key":' || o_orderkey || ',"status":"' || o_orderstatus || '"}', ',' ORDER BY o_orderkey)
    FILTER (WHERE o_orderkey IS NOT NULL) || ']', '[]') AS orders_json FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""",
)
def _(spark, t):
    fields = {"key": F.col("o_orderkey"), "status": F.col("o_orderstatus")}
    lists = aggregates.json_objects(t("orders"), ["o_custkey"], fields, "orders_json")
    return (
        t("customer")
        .join(lists, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", F.coalesce("orders_json", F.lit("[]")).alias("orders_json"))
    )


@operator(
    "agg_two_stage",
    "o_custkey:i orders:i lines:i total:d",
    """SELECT o_custkey, count(*) AS orders, sum(lines) AS lines, sum(total) AS total FROM (SELECT o_custkey, o_orderkey, count(*) AS lines,
    sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY 1""",
)
def _(spark, t):
    per_order = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(_money("l_extendedprice")).alias("total")
    )
    return per_order.join(t("orders"), "o_orderkey").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("lines").alias("lines"), F.sum("total").alias("total")
    )


@operator(
    "agg_multi_source_daily",
    "date_day:t yield_usd:d revenue_usd:d buyback_usd:d",
    """SELECT date_day, coalesce(sum(y), 0) AS yield_usd, coalesce(sum(r), 0) AS revenue_usd, coalesce(sum(b), 0) AS buyback_usd FROM (
    SELECT CAST(l_shipdate AS DATE) AS date_day, CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2)) AS y, NULL AS r, NULL AS b FROM lineitem
    UNION ALL SELECT CAST(o_orderdate AS DATE), NULL, CAST(o_totalprice AS DECIMAL(18,2)), NULL FROM orders
    UNION ALL SELECT CAST(ts AS DATE), NULL, NULL, CAST(value AS DECIMAL(18,2)) FROM events) GROUP BY 1""",
)
def _(spark, t):
    return rollup.daily_totals(
        {
            "yield_usd": (
                t("lineitem"),
                "l_shipdate",
                fn.usd_value(_money("l_quantity"), _money("l_extendedprice")),
            ),
            "revenue_usd": (t("orders"), "o_orderdate", _money("o_totalprice")),
            "buyback_usd": (t("events"), "ts", _money("value")),
        }
    )


@operator(
    "agg_group_by_position",
    "p_brand p_type n:i",
    "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2",
)
def _(spark, t):
    return spark.sql("SELECT p_brand, p_type, count(*) AS n FROM {part} GROUP BY 1, 2", part=t("part"))


@operator(
    "agg_count_star",
    "n:i impossible:i",
    "SELECT count(*) AS n, count(*) FILTER (WHERE l_quantity < 0) AS impossible FROM lineitem",
)
def _(spark, t):
    return t("lineitem").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_quantity") < 0).alias("impossible")
    )


# Ranking, sorting, sets ------------------------------------------------------


@operator(
    "win_global_rank",
    "user_id:i diff:d rank_7d_gainer:i rank_7d_loser:i",
    """WITH d AS (SELECT user_id, sum(CASE WHEN ts >= TIMESTAMP '2024-01-24' THEN CAST(value AS DECIMAL(18,2)) END)
    - sum(CASE WHEN ts < TIMESTAMP '2024-01-24' AND ts >= TIMESTAMP '2024-01-17' THEN CAST(value AS DECIMAL(18,2)) END) AS diff FROM events WHERE user_id % 13 <> 0 OR ts < TIMESTAMP '2024-01-24' GROUP BY 1)
    SELECT user_id, diff, row_number() OVER (ORDER BY diff DESC NULLS LAST, user_id) AS rank_7d_gainer,
    row_number() OVER (ORDER BY diff ASC NULLS LAST, CASE WHEN diff IS NULL THEN user_id ELSE -user_id END) AS rank_7d_loser FROM d""",
)
def _(spark, t):
    weekly = _weekly_change(t)
    ranks = positions.rank_both_ways(weekly, ["user_id"], {"7d": "diff"})
    return weekly.join(ranks, "user_id")


def _weekly_change(t: Tables) -> DataFrame:
    ts = F.col("ts")
    week, before = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-24", "2024-01-17"))
    rows = t("events").where((F.col("user_id") % 13 != 0) | (ts < week))
    return rows.groupBy("user_id").agg(
        (
            aggregates.sum_when(ts >= week, _money("value"))
            - aggregates.sum_when((ts < week) & (ts >= before), _money("value"))
        ).alias("diff")
    )


@operator(
    "win_distinct_on",
    "c_nationkey:i c_mktsegment c_custkey:i c_name",
    "SELECT DISTINCT ON (c_nationkey, c_mktsegment) c_nationkey, c_mktsegment, c_custkey, c_name FROM customer ORDER BY c_nationkey, c_mktsegment, c_custkey",
)
def _(spark, t):
    first = F.min(F.struct("c_custkey", "c_name")).alias("first")
    return t("customer").groupBy("c_nationkey", "c_mktsegment").agg(first).select(
        "c_nationkey", "c_mktsegment", "first.*"
    )


@operator(
    "sort_output",
    "date_day:t total:d",
    "SELECT CAST(o_orderdate AS DATE) AS date_day, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1 ORDER BY 1 DESC",
)
def _(spark, t):
    daily = t("orders").groupBy(F.to_date("o_orderdate").alias("date_day")).agg(
        F.sum(_money("o_totalprice")).alias("total")
    )
    return daily.orderBy(F.col("date_day").desc())


@operator(
    "sort_array_by_field",
    "o_custkey:i orders_by_price:s",
    "SELECT o_custkey, list(o_orderkey ORDER BY o_totalprice, o_orderkey) AS orders_by_price FROM orders GROUP BY 1",
)
def _(spark, t):
    rows = F.sort_array(F.collect_list(F.struct("o_totalprice", "o_orderkey")))
    return t("orders").groupBy("o_custkey").agg(fn.field_list(rows, "o_orderkey").alias("orders_by_price"))


@operator(
    "topk_gainers_losers",
    "user_id:i diff:d side",
    """WITH d AS (SELECT user_id, sum(CASE WHEN ts >= TIMESTAMP '2024-01-24' THEN CAST(value AS DECIMAL(18,2)) END)
    - sum(CASE WHEN ts < TIMESTAMP '2024-01-24' AND ts >= TIMESTAMP '2024-01-17' THEN CAST(value AS DECIMAL(18,2)) END) AS diff FROM events WHERE user_id % 13 <> 0 OR ts < TIMESTAMP '2024-01-24' GROUP BY 1)
    SELECT * FROM (SELECT user_id, diff, 'gainer' AS side FROM d ORDER BY diff DESC NULLS LAST, user_id LIMIT 10)
    UNION ALL SELECT * FROM (SELECT user_id, diff, 'loser' AS side FROM d ORDER BY diff ASC NULLS LAST, user_id LIMIT 10)""",
)
def _(spark, t):
    weekly = _weekly_change(t)
    up = weekly.orderBy(F.col("diff").desc_nulls_last(), "user_id").limit(10)
    down = weekly.orderBy(F.col("diff").asc_nulls_last(), "user_id").limit(10)
    return up.withColumn("side", F.lit("gainer")).unionByName(down.withColumn("side", F.lit("loser")))


@operator(
    "set_union_all",
    "kind key:i name",
    """SELECT 'customer' AS kind, c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
    UNION ALL SELECT 'part', p_partkey, p_name FROM part UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation""",
)
def _(spark, t):
    parts = {
        "customer": t("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")),
        "supplier": t("supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")),
        "part": t("part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name")),
        "nation": t("nation").select(
            F.col("n_nationkey").cast("bigint").alias("key"), F.col("n_name").alias("name")
        ),
    }
    return setops.union_padded(parts, "kind")


_KINDS = ["click", "view", "purchase", "signup", "error"]


def _sparse_hours(t: Tables) -> DataFrame:
    sources = {}
    for kind in _KINDS:
        rows = t("events").where(F.col("event_type") == kind)
        sources[kind] = rollup.hourly_last(rows, ["user_id"], "ts", {f"{kind}_value": "value"})
    return setops.union_padded(sources)


@operator(
    "set_union_all_padded",
    "user_id:i date_hour:t source click_value:d view_value:d purchase_value:d signup_value:d error_value:d",
    " UNION ALL ".join(
        "SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date_hour, '" + kind + "' AS source, "
        + ", ".join(
            ("arg_max(value, ts)" if kind == other else "CAST(NULL AS DOUBLE)") + f" AS {other}_value"
            for other in _KINDS
        )
        + f" FROM events WHERE event_type = '{kind}' GROUP BY 1, 2"
        for kind in _KINDS
    ),
)
def _(spark, t):
    return _sparse_hours(t)


@operator(
    "set_union_cutover",
    "event_id:i ts:t side",
    """SELECT event_id, ts, 'history' AS side FROM events WHERE ts < TIMESTAMP '2024-01-20' UNION ALL
    SELECT event_id, ts, 'recent' FROM events WHERE ts >= TIMESTAMP '2024-01-20'""",
)
def _(spark, t):
    events = t("events").select("event_id", "ts")
    early = events.where(F.col("ts") < F.lit("2024-01-24").cast("timestamp_ntz"))
    late = events.where(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    return setops.union_at_cutover(
        early.withColumn("side", F.lit("history")),
        late.withColumn("side", F.lit("recent")),
        "ts",
        datetime(2024, 1, 20),
    )


@operator(
    "set_distinct",
    "l_suppkey:i l_returnflag",
    "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
)
def _(spark, t):
    return t("lineitem").select("l_suppkey", "l_returnflag").distinct()


@operator(
    "set_inline_values",
    "o_orderkey:i label",
    """SELECT o_orderkey, label FROM orders JOIN (SELECT 'F' AS s, 'finished' AS label UNION ALL SELECT 'O', 'open' UNION ALL SELECT 'P', 'partial') v ON o_orderstatus = s""",
)
def _(spark, t):
    names = [("F", "finished"), ("O", "open"), ("P", "partial")]
    labels = spark.createDataFrame(names, "o_orderstatus string, label string")
    return t("orders").join(F.broadcast(labels), "o_orderstatus")


@operator(
    "set_except_keys",
    "p_partkey:i",
    "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.09)",
)
def _(spark, t):
    sold = t("lineitem").where(F.col("l_discount") > 0.09)
    return joins.anti_join_keys(t("part").select("p_partkey"), sold, [("p_partkey", "l_partkey")])


# Merges ---------------------------------------------------------------------


@operator(
    "dedup_latest",
    "user_id:i event_type event_id:i ts:t value:d",
    """SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""",
)
def _(spark, t):
    return merge.dedup_latest(t("events"), ["user_id", "event_type"], ["ts", "event_id"])


@operator(
    "dedup_latest_load",
    "o_custkey:i rows_kept:i",
    """WITH loads AS (SELECT 'L' || r_regionkey AS load_id, TIMESTAMP '2024-01-01' + to_days((r_regionkey * 3) % 5) AS inserted_at FROM region),
    rows_ AS (SELECT o_custkey, 'L' || (o_orderkey % 5) AS load_id FROM orders),
    newest AS (SELECT o_custkey, arg_max(r.load_id, inserted_at) AS load_id FROM rows_ r JOIN loads l ON r.load_id = l.load_id GROUP BY 1)
    SELECT r.o_custkey, count(*) AS rows_kept FROM rows_ r JOIN newest n ON r.o_custkey = n.o_custkey AND r.load_id = n.load_id GROUP BY 1""",
)
def _(spark, t):
    return _latest_loads(t).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("rows_kept"))


@operator(
    "coalesce_merge",
    "user_id:i date_hour:t click_value:d view_value:d purchase_value:d signup_value:d error_value:d",
    "SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date_hour, "
    + ", ".join(f"arg_max(value, ts) FILTER (WHERE event_type = '{k}') AS {k}_value" for k in _KINDS)
    + " FROM events GROUP BY 1, 2",
)
def _(spark, t):
    return merge.coalesce_merge(
        _sparse_hours(t), ["user_id", "date_hour"], [f"{k}_value" for k in _KINDS]
    )


@operator(
    "coalesce_merge_versions",
    "user_id:i value:d event_type tags:s",
    """SELECT user_id, arg_max(v, (ts, event_id)) FILTER (WHERE v IS NOT NULL) AS value, arg_max(event_type, (ts, event_id)) AS event_type,
    coalesce(arg_max(tags, (ts, event_id)) FILTER (WHERE len(tags) > 0), []) AS tags FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN value END AS v,
    CASE WHEN event_id % 4 = 0 THEN [event_type, 'x'] ELSE [] END AS tags FROM events) GROUP BY 1""",
)
def _(spark, t):
    empty = fn.typed_empty_array("string")
    rows = t("events").withColumns(
        {
            "value": F.when(F.col("event_id") % 3 == 0, F.col("value")),
            "tags": F.when(F.col("event_id") % 4 == 0, F.array("event_type", F.lit("x"))).otherwise(empty),
        }
    )
    return merge.coalesce_merge(rows, ["user_id"], ["value", "event_type", "tags"], ["ts", "event_id"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: op.run for name, op in OPERATORS.items()}


def oracles() -> dict[str, str]:
    return {name: op.oracle() for name, op in OPERATORS.items()}
