"""Registered queries: scalar functions and data tests over the driver tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.quality import checks
from ledgerlens.workload.operator_queries import Operator

FUNCTIONS: dict[str, Operator] = {}


def function(name: str, columns: str, sql: str):
    def register(build):
        FUNCTIONS[name] = Operator(build, tuple(columns.split()), " ".join(sql.split()))
        return build

    return register


ZERO = "'0x0000000000000000000000000000000000000000'"
ADDRESS_SQL = f"CASE WHEN x IS NULL OR lower(trim(x)) IN ('native', 'null', '') THEN {ZERO} ELSE lower(x) END"
ROUGH_SQL = (
    "(SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN ' Native ' WHEN 'HOUSEHOLD' THEN '' "
    "WHEN 'FURNITURE' THEN 'NULL' ELSE '0xAB' || c_custkey END AS x FROM customer)"
)


def _rough_address():
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "BUILDING", F.lit(None))
        .when(segment == "MACHINERY", F.lit(" Native "))
        .when(segment == "HOUSEHOLD", F.lit(""))
        .when(segment == "FURNITURE", F.lit("NULL"))
        .otherwise(F.concat(F.lit("0xAB"), F.col("c_custkey").cast("string")))
    )


@function("fn_lower_addr", "c_custkey:i name", "SELECT c_custkey, lower(c_name) AS name FROM customer")
def _(spark, t):
    return t("customer").select("c_custkey", fn.lower_hash(F.col("c_name")).alias("name"))


@function(
    "fn_format_hex", "c_custkey:i hex", "SELECT c_custkey, '0x' || lower(hex(c_name)) AS hex FROM customer"
)
def _(spark, t):
    return t("customer").select("c_custkey", fn.hex_text(F.col("c_name").cast("binary")).alias("hex"))


@function(
    "fn_norm_network",
    "n_nationkey:i network",
    "SELECT n_nationkey, replace(lower(trim(CASE WHEN n_nationkey % 4 = 0 THEN ' Harmony ' ELSE n_name END)), 'harmony', 'one') AS network FROM nation",
)
def _(spark, t):
    raw = F.when(F.col("n_nationkey") % 4 == 0, F.lit(" Harmony ")).otherwise(F.col("n_name"))
    return t("nation").select("n_nationkey", fn.network_key(raw).alias("network"))


@function(
    "fn_repr_address", "c_custkey:i address", f"SELECT c_custkey, {ADDRESS_SQL} AS address FROM {ROUGH_SQL}"
)
def _(spark, t):
    return t("customer").select("c_custkey", fn.representation_address(_rough_address()).alias("address"))


LIST_SQL = """(SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '[\"' || o_orderpriority || '\",\"1.5\"]' ELSE 'broken' END AS x FROM orders)"""


def _list_text():
    key = F.col("o_orderkey") % 4
    return (
        F.when(key == 0, F.lit(None))
        .when(key == 1, F.lit("[]"))
        .when(key == 2, F.concat(F.lit('["'), F.col("o_orderpriority"), F.lit('","1.5"]')))
        .otherwise(F.lit("broken"))
    )


@function(
    "fn_json_str_list",
    "o_orderkey:i items:s",
    f"SELECT o_orderkey, coalesce(CAST(TRY_CAST(x AS JSON) AS VARCHAR[]), []) AS items FROM {LIST_SQL}",
)
def _(spark, t):
    return t("orders").select("o_orderkey", fn.json_string_list(_list_text()).alias("items"))


@function(
    "fn_decimal_list",
    "o_orderkey:i amounts:n",
    "SELECT o_orderkey, [CAST(o_totalprice AS DECIMAL(18,2)), CAST(1.5 AS DECIMAL(18,2))] AS amounts FROM orders",
)
def _(spark, t):
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return t("orders").select("o_orderkey", fn.decimal_list(F.array(price, F.lit("1.5"))).alias("amounts"))


@function(
    "fn_addr_list",
    "c_custkey:i addresses:s",
    f"SELECT c_custkey, [{ADDRESS_SQL}, '0xcd'] AS addresses FROM {ROUGH_SQL}",
)
def _(spark, t):
    return t("customer").select(
        "c_custkey", fn.address_list(F.array(_rough_address(), F.lit("0xCD"))).alias("addresses")
    )


@function(
    "fn_json_field", "event_id:i k:i", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events"
)
def _(spark, t):
    return t("events").select("event_id", fn.json_field(F.col("props"), "k").alias("k"))


@function(
    "fn_to_json",
    "n_nationkey:i text",
    """SELECT n_nationkey, '{"name":"' || n_name || '","region":' || n_regionkey || '}' AS text FROM nation""",
)
def _(spark, t):
    pair = F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    return t("nation").select("n_nationkey", fn.json_text(pair).alias("text"))


@function(
    "fn_json_checks",
    "o_orderkey:i n:i all_text",
    f"""SELECT o_orderkey, json_array_length(TRY_CAST(x AS JSON)) AS n,
    coalesce(len(list_filter(CAST(TRY_CAST(x AS JSON) AS VARCHAR[]), lambda e: length(e) = 0)) = 0, false) AS all_text FROM {LIST_SQL}""",
)
def _(spark, t):
    items = F.from_json(_list_text(), "array<string>")
    return t("orders").select(
        "o_orderkey",
        F.json_array_length(_list_text()).alias("n"),
        F.coalesce(F.forall(items, lambda x: F.length(x) > 0), F.lit(False)).alias("all_text"),
    )


LEGS_SQL = "(SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY 1)"


@function("fn_array_map_field", "l_orderkey:i parts:s", f"SELECT l_orderkey, parts FROM {LEGS_SQL}")
def _(spark, t):
    legs = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    return t("lineitem").groupBy("l_orderkey").agg(fn.field_list(legs, "l_partkey").alias("parts"))


@function(
    "fn_array_filter_distinct_flatten",
    "l_orderkey:i suppliers:s",
    "SELECT l_orderkey, list_sort(list_distinct(coalesce(list(l_suppkey) FILTER (WHERE l_suppkey % 3 <> 0), []) || [0])) AS suppliers FROM lineitem GROUP BY 1",
)
def _(spark, t):
    kept = F.nullif(F.col("l_suppkey") * F.when(F.col("l_suppkey") % 3 != 0, 1), F.lit(-1))
    nested = F.collect_list(F.array(kept, F.lit(0).cast("bigint")))
    return t("lineitem").groupBy("l_orderkey").agg(fn.distinct_flat(nested).alias("suppliers"))


@function(
    "fn_array_string_concat",
    "l_orderkey:i text",
    f"SELECT l_orderkey, array_to_string(parts, '|') AS text FROM {LEGS_SQL}",
)
def _(spark, t):
    legs = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    texts = fn.field_list(legs, "l_partkey").cast("array<string>")
    return t("lineitem").groupBy("l_orderkey").agg(fn.join_text(texts, "|").alias("text"))


@function(
    "fn_array_explode",
    "o_orderkey:i item",
    f"SELECT o_orderkey, unnest(coalesce(CAST(TRY_CAST(x AS JSON) AS VARCHAR[]), [])) AS item FROM {LIST_SQL}",
)
def _(spark, t):
    return t("orders").select("o_orderkey", F.explode(fn.json_string_list(_list_text())).alias("item"))


@function(
    "fn_split",
    "o_orderkey:i word",
    "SELECT o_orderkey, nullif(split_part(o_orderpriority, '-', 2), '') AS word FROM orders",
)
def _(spark, t):
    return t("orders").select("o_orderkey", fn.split_part(F.col("o_orderpriority"), "-", 1).alias("word"))


@function("fn_concat", "p_partkey:i label", "SELECT p_partkey, p_brand || '/' || p_type AS label FROM part")
def _(spark, t):
    return t("part").select("p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("label"))


@function(
    "fn_trim_length",
    "p_partkey:i size:i",
    "SELECT p_partkey, length(trim('  ' || p_name || ' ')) AS size FROM part",
)
def _(spark, t):
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return t("part").select("p_partkey", F.length(F.trim(padded)).alias("size"))


@function(
    "fn_regex",
    "p_partkey:i hit",
    "SELECT p_partkey, regexp_matches(p_brand, '^Brand#1[0-9]$') AS hit FROM part",
)
def _(spark, t):
    return t("part").select("p_partkey", F.rlike("p_brand", F.lit("^Brand#1[0-9]$")).alias("hit"))


@function(
    "fn_ends_with", "p_partkey:i hit", "SELECT p_partkey, p_name LIKE '%widget' AS hit FROM part"
)
def _(spark, t):
    return t("part").select("p_partkey", F.endswith("p_name", F.lit("widget")).alias("hit"))


@function(
    "fn_safe_int",
    "o_orderkey:i number:i",
    "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_custkey WHEN 1 THEN NULL ELSE NULL END AS number FROM orders",
)
def _(spark, t):
    key = F.col("o_orderkey") % 3
    text = F.when(key == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" "))).when(
        key == 1, F.lit("")
    ).otherwise(F.lit("12x"))
    return t("orders").select("o_orderkey", fn.safe_bigint(text).alias("number"))


@function(
    "fn_cast_numeric",
    "l_orderkey:i l_linenumber:i as_double:d as_int:i as_text",
    "SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DOUBLE) AS as_double, CAST(l_quantity AS BIGINT) AS as_int, CAST(l_suppkey AS VARCHAR) AS as_text FROM lineitem",
)
def _(spark, t):
    return t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fn.to_decimal(F.col("l_quantity")).cast("double").alias("as_double"),
        F.col("l_quantity").cast("int").alias("as_int"),
        F.col("l_suppkey").cast("string").alias("as_text"),
    )


@function(
    "fn_cast_bool",
    "o_orderkey:i flag finished",
    "SELECT o_orderkey, o_orderkey % 2 <> 0 AS flag, coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus = 'F' END, false) AS finished FROM orders",
)
def _(spark, t):
    finished = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus") == "F")
    return t("orders").select(
        "o_orderkey",
        (F.col("o_orderkey") % 2).cast("boolean").alias("flag"),
        fn.bool_or(finished).alias("finished"),
    )


@function(
    "fn_cast_time",
    "o_orderkey:i parsed:t broken:t",
    "SELECT o_orderkey, o_orderdate AS parsed, CAST(NULL AS TIMESTAMP) AS broken FROM orders",
)
def _(spark, t):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t("orders").select(
        "o_orderkey",
        fn.naive(F.try_to_timestamp(text)).alias("parsed"),
        fn.naive(F.try_to_timestamp(F.concat(F.lit("x"), text))).alias("broken"),
    )


@function(
    "fn_typed_null_array",
    "n_nationkey:i nothing:d empty:s",
    "SELECT n_nationkey, CAST(NULL AS DOUBLE) AS nothing, CAST([] AS VARCHAR[]) AS empty FROM nation",
)
def _(spark, t):
    return t("nation").select(
        "n_nationkey",
        F.lit(None).cast(fn.AMOUNT).alias("nothing"),
        fn.typed_empty_array("string").alias("empty"),
    )


@function(
    "fn_key_cast",
    "o_orderkey:i c_name",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON CAST(o_custkey AS VARCHAR) = CAST(c_custkey AS VARCHAR)",
)
def _(spark, t):
    keyed = t("customer").withColumn("id_text", F.col("c_custkey").cast("string"))
    # The text side is cast, so the join runs on the numeric key.
    return t("orders").join(keyed, F.col("o_custkey") == F.col("id_text").try_cast("bigint"))


@function(
    "fn_scaled_int",
    "o_orderkey:i amount:d",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE (o_orderkey * 1000 + 7) / 1000000.0 END AS amount FROM orders",
)
def _(spark, t):
    text = F.when(F.col("o_orderkey") % 9 != 0, (F.col("o_orderkey") * 1000 + 7).cast("string"))
    return t("orders").select("o_orderkey", fn.scaled_integer(text, 6).alias("amount"))


@function(
    "fn_hour",
    "event_id:i date_hour:t",
    "SELECT event_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date_hour FROM events",
)
def _(spark, t):
    return t("events").select("event_id", fn.hour_of(F.col("ts")).alias("date_hour"))


@function("fn_date", "event_id:i day:t", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _(spark, t):
    return t("events").select("event_id", fn.day_of(F.col("ts")).alias("day"))


@function(
    "fn_month", "o_orderkey:i month:t", "SELECT o_orderkey, date_trunc('month', o_orderdate) AS month FROM orders"
)
def _(spark, t):
    return t("orders").select("o_orderkey", fn.month_of(F.col("o_orderdate")).alias("month"))


@function(
    "fn_date_trunc_now",
    "event_id:i ts:t",
    "SELECT event_id, ts FROM events WHERE CAST(date_trunc('hour', ts) AS TIMESTAMP) = date_trunc('hour', TIMESTAMP '2024-01-30 23:40:00') - INTERVAL 7 DAY",
)
def _(spark, t):
    now = F.lit("2024-01-30 23:40:00").cast("timestamp_ntz")
    return t("events").where(fn.hour_of(F.col("ts")) == fn.hour_of(now) - F.expr("INTERVAL '7' DAY"))


@function(
    "fn_today_minus",
    "event_id:i ts:t",
    "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - 7",
)
def _(spark, t):
    return t("events").where(F.to_date("ts") >= F.date_sub(F.lit(date(2024, 1, 31)), 7))


@function(
    "fn_least",
    "event_id:i until:t",
    "SELECT event_id, least(ts + INTERVAL 1 MONTH, TIMESTAMP '2024-02-10') AS until FROM events",
)
def _(spark, t):
    limit = F.lit("2024-02-10 00:00:00").cast("timestamp_ntz")
    later = F.col("ts") + F.expr("INTERVAL '1' MONTH")
    return t("events").select("event_id", F.least(later, limit).alias("until"))


@function(
    "fn_coalesce_nullif",
    "p_partkey:i type",
    "SELECT p_partkey, coalesce(nullif(p_type, 'PROMO'), nullif(p_brand, 'Brand#2'), 'none') AS type FROM part",
)
def _(spark, t):
    first, second = F.nullif("p_type", F.lit("PROMO")), F.nullif("p_brand", F.lit("Brand#2"))
    return t("part").select("p_partkey", F.coalesce(first, second, F.lit("none")).alias("type"))


@function(
    "fn_multi_if",
    "p_partkey:i band",
    "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS band FROM part",
)
def _(spark, t):
    band = F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium").otherwise("large")
    return t("part").select("p_partkey", band.alias("band"))


@function(
    "fn_tuple_access",
    "o_orderkey:i status",
    "SELECT o_orderkey, o_orderstatus AS status FROM orders",
)
def _(spark, t):
    pair = F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))
    return t("orders").select(pair.alias("pair")).select(
        F.col("pair.key").alias("o_orderkey"), F.col("pair.status").alias("status")
    )


@function(
    "fn_iso_parse",
    "o_orderkey:i parsed_at:t",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 3 THEN o_orderdate - INTERVAL 2 HOUR ELSE o_orderdate END AS parsed_at FROM orders",
)
def _(spark, t):
    key = F.col("o_orderkey") % 4
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    iso = (
        F.when(key == 0, F.lit(""))
        .when(key == 1, F.concat(text, F.lit("Z")))
        .when(key == 2, text)
        .otherwise(F.concat(text, F.lit("+02:00")))
    )
    return t("orders").select("o_orderkey", fn.iso_timestamp(iso).alias("parsed_at"))


# Data tests: each returns the violating rows. ---------------------------------


@function(
    "dq_not_null",
    "event_id:i k:i",
    "SELECT event_id, NULL AS k FROM events WHERE CAST(props->>'$.k' AS BIGINT) < 5",
)
def _(spark, t):
    k = fn.json_field(F.col("props"), "k").cast("bigint")
    return checks.not_null(t("events").select("event_id", F.when(k >= 5, k).alias("k")), "k")


@function(
    "dq_unique",
    "l_orderkey:i n_records:i",
    "SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1 HAVING count(*) > 1",
)
def _(spark, t):
    return checks.unique(t("lineitem"), ["l_orderkey"], "l_returnflag = 'A'")


@function(
    "dq_unique_combo",
    "l_orderkey:i l_linenumber:i n_records:i",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(spark, t):
    return checks.unique(t("lineitem"), ["l_orderkey", "l_linenumber"])


@function(
    "dq_accepted_range",
    "l_orderkey:i l_linenumber:i l_quantity:d",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 2 OR l_quantity > 49",
)
def _(spark, t):
    return checks.accepted_range(t("lineitem"), "l_quantity", 2, 49)


@function(
    "dq_accepted_values",
    "o_orderkey:i o_orderpriority",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')",
)
def _(spark, t):
    return checks.accepted_values(t("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@function(
    "dq_relationship",
    "o_orderkey:i o_custkey:i",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)",
)
def _(spark, t):
    return checks.relationship(t("orders"), t("supplier"), {"o_custkey": "s_suppkey"})


@function(
    "dq_relationship_multi",
    "c_custkey:i c_nationkey:i",
    "SELECT c_custkey, c_nationkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey AND s_nationkey = c_nationkey)",
)
def _(spark, t):
    keys = {"c_custkey": "s_suppkey", "c_nationkey": "s_nationkey"}
    return checks.relationship(t("customer"), t("supplier"), keys)


@function(
    "dq_relationship_array",
    "element:i",
    "SELECT e AS element FROM (SELECT unnest([o_custkey, o_orderkey]) AS e FROM orders) WHERE e NOT IN (SELECT c_custkey FROM customer)",
)
def _(spark, t):
    rows = t("orders").select(F.array("o_custkey", "o_orderkey").alias("keys"))
    return checks.relationship_array(rows, "keys", t("customer"), "c_custkey")


@function(
    "dq_relationship_array_multi",
    "c_nationkey:i element:i",
    """SELECT n AS c_nationkey, e AS element FROM (SELECT c_nationkey AS n, unnest([c_custkey, c_custkey + 1]) AS e FROM customer) x
    WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey = x.n AND c.c_custkey = x.e)""",
)
def _(spark, t):
    rows = t("customer").select("c_nationkey", F.array("c_custkey", F.col("c_custkey") + 1).alias("keys"))
    shared = {"c_nationkey": "c_nationkey"}
    return checks.relationship_array(rows, "keys", t("customer"), "c_custkey", shared)


@function(
    "dq_array_length",
    "o_orderkey:i",
    f"SELECT o_orderkey FROM {LIST_SQL} WHERE coalesce(len(CAST(TRY_CAST(x AS JSON) AS VARCHAR[])), 0) <> 2 AND o_orderkey > 100",
)
def _(spark, t):
    rows = t("orders").select("o_orderkey", fn.json_string_list(_list_text()).alias("items"))
    return checks.array_length(rows, "items", 2, 2, "o_orderkey > 100")


@function(
    "dq_expression",
    "p_partkey:i p_retailprice:d",
    "SELECT p_partkey, p_retailprice FROM part WHERE NOT (p_retailprice >= 950 OR p_size > 10)",
)
def _(spark, t):
    return checks.expression(t("part"), "p_retailprice >= 950 OR p_size > 10")


@function(
    "dq_exactly_one_row",
    "row_count:i",
    "SELECT count(*) AS row_count FROM region HAVING count(*) <> 1",
)
def _(spark, t):
    return checks.exactly_one_row(t("region"))


@function(
    "dq_date_exists",
    "row_count:i",
    "SELECT count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '2024-02-20' - 1) AS row_count FROM events HAVING count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '2024-02-20' - 1) = 0",
)
def _(spark, t):
    return checks.date_exists(t("events"), "ts", date(2024, 2, 20), 1)


@function(
    "dq_distinct_count_gt",
    "distinct_count:i",
    "SELECT count(DISTINCT n_regionkey) AS distinct_count FROM nation HAVING count(DISTINCT n_regionkey) <= 5",
)
def _(spark, t):
    return checks.distinct_count_above(t("nation"), "n_regionkey", 5)


HEX_TEXT_SQL = "(SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '0x' || lower(hex(c_name)) ELSE c_name END AS x FROM customer)"


@function(
    "dq_hex_string",
    "c_custkey:i x",
    f"SELECT c_custkey, x FROM {HEX_TEXT_SQL} WHERE NOT regexp_full_match(x, '0x([0-9a-fA-F]{{2}})+') OR length(x) <> 38",
)
def _(spark, t):
    name = F.col("c_name")
    text = F.when(F.col("c_custkey") % 2 == 0, fn.hex_text(name.cast("binary"))).otherwise(name)
    return checks.hex_string(t("customer").select("c_custkey", text.alias("x")), "x", 18)


@function(
    "dq_bytes_string",
    "p_partkey:i",
    "SELECT p_partkey FROM part WHERE length(p_name) <> 8",
)
def _(spark, t):
    rows = t("part").select("p_partkey", F.col("p_name").cast("binary").alias("raw"))
    return checks.bytes_string(rows, "raw", 8).select("p_partkey")


@function(
    "dq_regex",
    "p_partkey:i",
    "SELECT p_partkey FROM part WHERE NOT regexp_matches('0x' || lower(hex(p_name)), '^0x72')",
)
def _(spark, t):
    rows = t("part").select("p_partkey", F.col("p_name").cast("binary").alias("raw"))
    return checks.hex_matches(rows, "raw", "^0x72").select("p_partkey")


@function(
    "dq_row_checks",
    "rule violations:i",
    """SELECT 'cheap' AS rule, count(*) FILTER (WHERE NOT (l_extendedprice < 50000)) AS violations FROM lineitem
    UNION ALL SELECT 'few', count(*) FILTER (WHERE NOT (l_quantity <= 30)) FROM lineitem""",
)
def _(spark, t):
    rules = {"cheap": F.col("l_extendedprice") < 50000, "few": F.col("l_quantity") <= 30}
    return checks.row_checks(t("lineitem"), rules)


@function(
    "dq_contract",
    "rows_read:i column_name declared actual",
    """SELECT count(*) AS rows_read, 'n_comment' AS column_name, 'string' AS declared, CAST(NULL AS VARCHAR) AS actual FROM nation
    UNION ALL SELECT count(*), 'n_regionkey', 'bigint', 'int' FROM nation""",
)
def _(spark, t):
    declared = {
        "n_nationkey": "int",
        "n_name": "string",
        "n_regionkey": "bigint",
        "n_comment": "string",
    }
    nation = t("nation")
    counted = nation.agg(F.count(F.lit(1)).alias("rows_read"))
    return checks.contract(nation, declared).withColumn("_k", F.lit(1)).join(
        counted.withColumn("_k", F.lit(1)), "_k"
    )


def queries():
    return {name: op.run for name, op in FUNCTIONS.items()}


def oracles() -> dict[str, str]:
    return {name: op.oracle() for name, op in FUNCTIONS.items()}
