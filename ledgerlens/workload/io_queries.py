"""Registered queries: sources, sinks, incremental runs and streams over the driver tables.

Queries that write use the session's shared folder and return what a reader of
the written table sees.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens import functions as fn
from ledgerlens.operators import merge, rollup, setops
from ledgerlens.session import scratch_path
from ledgerlens.sinks import loads, upsert, writers
from ledgerlens.sources import payloads, schema, tables
from ledgerlens.streaming import cursors, history, jobs
from ledgerlens.workload.driver_tables import EVENTS_AS_OF, load
from ledgerlens.workload.operator_queries import Operator
from ledgerlens.workload.present import present, select_sql

IO: dict[str, Operator] = {}


def io(name: str, columns: str, sql: str):
    def register(build):
        IO[name] = Operator(build, tuple(columns.split()), " ".join(sql.split()))
        return build

    return register


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _stored(df: DataFrame, label: str, **options) -> tuple[SparkSession, str]:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writers.write_table(df, path, **options)
    return spark, path


# Sources ---------------------------------------------------------------------


@io(
    "src_table_windowed",
    "o_orderkey:i o_custkey:i o_orderdate:t",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-01-01' + INTERVAL 120 DAY
    AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def _(spark, t):
    known = t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return tables.read_window(
        t("orders"), "o_orderdate", datetime(1996, 1, 1), 120, known, "o_custkey"
    )


@io(
    "src_table_replace",
    "o_orderkey:i o_totalprice:d",
    "SELECT o_orderkey, o_totalprice FROM orders",
)
def _(spark, t):
    spark, path = _stored(t("orders").withColumn("o_totalprice", F.lit(0.0)), "replace")
    writers.write_table(t("orders"), path)
    return writers.read_table(spark, path)


def _merged_customers(t: Tables) -> DataFrame:
    old = t("customer").where("c_mktsegment <> 'BUILDING'").withColumn("c_acctbal", F.lit(0.0))
    spark, path = _stored(old, "merge")
    upsert.upsert(t("customer").where("c_acctbal > 0"), path, ["c_custkey"])
    return writers.read_table(spark, path)


MERGED_SQL = "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS c_acctbal FROM customer WHERE c_acctbal > 0 OR c_mktsegment <> 'BUILDING'"

Tables = Callable[[str], DataFrame]


@io("src_table_merge", "c_custkey:i c_acctbal:d", MERGED_SQL)
def _(spark, t):
    return _merged_customers(t)


@io(
    "src_bytes_to_hex",
    "o_orderkey:i status",
    "SELECT o_orderkey, '0x' || lower(hex(o_orderpriority)) AS status FROM orders",
)
def _(spark, t):
    raw = t("orders").select("o_orderkey", F.col("o_orderpriority").cast("binary").alias("status"))
    return tables.bytes_to_hex(raw, ["status"])


@io(
    "src_json_list",
    "l_orderkey:i part:i quantity:d",
    "SELECT l_orderkey, l_partkey AS part, l_quantity AS quantity FROM lineitem",
)
def _(spark, t):
    path = scratch_path(spark, "payloads")
    item = F.struct("l_orderkey", F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"))
    landed = t("lineitem").groupBy("l_orderkey").agg(F.to_json(F.collect_list(item)).alias("value"))
    landed.select("value").write.text(path)
    return payloads.read_json_list(spark, path, "l_orderkey bigint, part bigint, quantity double", lines=True)


def _event_payloads(t: Tables, *levels, value) -> DataFrame:
    """One payload per event: nested objects keyed by the given columns."""
    node = value
    for level in reversed(levels):
        node = F.create_map(F.col(level).cast("string"), node)
    return t("events").select("event_id", F.to_json(node).alias("payload"))


@io(
    "src_json_map1",
    "event_id:i metric reading:d",
    "SELECT event_id, event_type AS metric, value AS reading FROM events",
)
def _(spark, t):
    landed = _event_payloads(t, "event_type", value=F.col("value"))
    rows = payloads.explode_map(landed, "payload", ["metric"], "reading", ["event_id"])
    return rows.withColumn("reading", payloads.number_or_null(F.col("reading")))


@io(
    "src_json_map1_struct",
    "event_id:i user_id:i reading:d kind",
    "SELECT event_id, user_id, value AS reading, event_type AS kind FROM events",
)
def _(spark, t):
    value = F.struct(F.col("value").alias("currentValue"), F.col("event_type").alias("eventKind"))
    landed = _event_payloads(t, "user_id", value=value)
    fields = {"reading": "currentValue", "kind": "eventKind"}
    return payloads.explode_map(landed, "payload", ["user_id"], fields, ["event_id"])


@io(
    "src_json_map2",
    "event_id:i user_id:i metric reading:d",
    "SELECT event_id, user_id, event_type AS metric, CASE WHEN event_id % 8 = 0 THEN NULL ELSE value END AS reading FROM events",
)
def _(spark, t):
    value = F.when(F.col("event_id") % 8 == 0, F.lit("NaN")).otherwise(F.col("value").cast("string"))
    landed = _event_payloads(t, "user_id", "event_type", value=value)
    rows = payloads.explode_map(landed, "payload", ["user_id", "metric"], "reading", ["event_id"])
    return rows.withColumn("reading", payloads.number_or_null(F.col("reading")))


@io(
    "src_json_map3",
    "event_id:i user_id:i metric day:t usd_value:d symbol",
    """SELECT event_id, user_id, event_type AS metric, CAST(ts AS DATE) AS day, CASE WHEN event_id % 8 = 0 THEN NULL ELSE value END AS usd_value,
    'T' || user_id AS symbol FROM events WHERE event_id % 5 <> 0""",
)
def _(spark, t):
    usd = F.when(F.col("event_id") % 8 == 0, F.lit("NaN")).otherwise(F.col("value").cast("string"))
    fields = F.struct(
        usd.alias("usdValue"), F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("symbol")
    )
    value = F.when(F.col("event_id") % 5 != 0, fields)
    with_day = lambda name: t(name).withColumn("day", F.to_date("ts"))
    landed = _event_payloads(with_day, "user_id", "event_type", "day", value=value)
    rows = payloads.explode_map(
        landed,
        "payload",
        ["user_id", "metric", "day"],
        {"usd_value": "usdValue", "symbol": "symbol"},
        ["event_id"],
        drop_null=True,
    )
    return rows.withColumn("usd_value", payloads.number_or_null(F.col("usd_value"))).withColumn(
        "day", F.to_date("day")
    )


@io(
    "src_snapshot_stamp",
    "event_id:i etag date_time:t",
    "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'e' || event_id ELSE sha256(props) END AS etag, ts AS date_time FROM events",
)
def _(spark, t):
    tag = F.concat(F.lit("e"), F.col("event_id").cast("string"))
    landed = t("events").withColumn("etag", F.when(F.col("event_id") % 2 == 0, tag))
    return payloads.stamp_snapshot(landed, "props", "etag", "ts")


@io(
    "src_boundary_feed",
    "event_id:i ts:t value:d",
    "SELECT event_id, ts, value FROM events",
)
def _(spark, t):
    stored = t("events").where(F.col("ts") < _at("2024-01-16 12:00:00"))
    cursor = cursors.max_time(stored, "ts")
    again = tables.feed_since(t("events"), "ts", cursor)
    return merge.dedup_latest(stored.unionByName(again), ["event_id"], ["ts"])


@io(
    "src_bigint_as_text",
    "o_orderkey:i supply",
    "SELECT o_orderkey, CAST(o_orderkey + 1 AS VARCHAR) || '00000000000000000000007' AS supply FROM orders",
)
def _(spark, t):
    text = F.concat((F.col("o_orderkey") + 1).cast("string"), F.lit("00000000000000000000007"))
    landed = t("orders").select("o_orderkey", F.to_json(F.struct(text.alias("totalSupply"))).alias("p"))
    parsed = F.from_json("p", "totalSupply string")["totalSupply"]
    return landed.select(
        "o_orderkey", parsed.try_cast("decimal(38,0)").cast("string").alias("supply")
    )


@io(
    "src_schema_hints",
    "o_orderkey:i price:d price__raw missing:d",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END AS price,
    CASE WHEN o_orderkey % 6 = 0 THEN 'n/a' END AS price__raw, CAST(NULL AS DOUBLE) AS missing FROM orders""",
)
def _(spark, t):
    text = F.when(F.col("o_orderkey") % 6 == 0, F.lit("n/a")).otherwise(
        F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    )
    raw = t("orders").select("o_orderkey", text.alias("price"))
    return schema.apply_hints(raw, {"price": "decimal(30,18)", "missing": "double"}, keep_raw=True)


class _Optional(Operator):
    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        found = {}
        for name in ("supplier", "table_that_does_not_exist", "customer"):
            rows = tables.read_optional(spark, tables.FileTable(f"{sf_dir}/{name}.parquet"))
            if rows is not None:
                found[name] = rows.agg(F.count(F.lit(1)).alias("n"))
        return present(setops.union_padded(found, "name"), self.columns)


IO["src_optional"] = _Optional(
    lambda spark, t: t("supplier"),
    ("name", "n:i"),
    "SELECT 'supplier' AS name, count(*) AS n FROM supplier UNION ALL SELECT 'customer', count(*) FROM customer",
)


@io(
    "src_backfill_loop",
    "o_orderkey:i o_orderdate:t",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1994-12-31'",
)
def _(spark, t):
    path = scratch_path(spark, "backfill")

    def one_window(start: datetime) -> int:
        seen = Observation()
        rows = tables.read_window(t("orders"), "o_orderdate", start, 600)
        writers.append_table(rows.observe(seen, F.count(F.lit(1)).alias("n")), path)
        return seen.get["n"]

    newest = t("orders").agg(F.max("o_orderdate")).first()[0]
    cursors.backfill(one_window, datetime(1994, 12, 31), newest + timedelta(days=1), 600)
    return spark.read.parquet(path)


@io(
    "src_staged_files",
    "l_orderkey:i l_linenumber:i l_quantity:d",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
)
def _(spark, t):
    path = scratch_path(spark, "staged")
    writers.append_table(t("lineitem"), path)
    return tables.FileTable(path).read(spark)


@io(
    "src_load_audit",
    "load_id status:i row_count:i rows_seen:i newest:t",
    """SELECT load_id, 0 AS status, count(*) AS row_count, count(*) AS rows_seen, max(ts) AS newest FROM
    (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'load-1' ELSE 'load-2' END AS load_id FROM events) GROUP BY 1""",
)
def _(spark, t):
    rows_path, loads_path = scratch_path(spark, "rows"), scratch_path(spark, "loads")
    early = F.col("ts") < _at("2024-01-16")
    for i, part in enumerate((t("events").where(early), t("events").where(~early)), start=1):
        at = EVENTS_AS_OF + timedelta(hours=i)
        for _ in range(2):  # a repeated load replaces itself
            loads.append_load(part, rows_path, loads_path, f"load-{i}", "events", at)
    rows = loads.read_loads(spark, rows_path, "ts timestamp_ntz")
    seen = rows.groupBy(F.col("_load_id").alias("load_id")).agg(
        F.count(F.lit(1)).alias("rows_seen"), F.max("ts").alias("newest")
    )
    return loads.read_load_log(spark, loads_path).join(seen, "load_id")


# Sinks ------------------------------------------------------------------------


@io("sink_view", "n_nationkey:i n_name", "SELECT n_nationkey, n_name FROM nation")
def _(spark, t):
    writers.write_view(t("nation"), "ledgerlens_view")
    return spark.table("ledgerlens_view")


@io(
    "sink_table",
    "o_orderkey:i o_orderdate:t",
    "SELECT o_orderkey, o_orderdate FROM orders",
)
def _(spark, t):
    by_year = t("orders").withColumn("year", F.year("o_orderdate"))
    spark, path = _stored(by_year, "table", partition_by="year")
    return writers.read_table(spark, path)


@io(
    "sink_append",
    "o_orderkey:i o_orderstatus",
    "SELECT o_orderkey, o_orderstatus FROM orders",
)
def _(spark, t):
    path = scratch_path(spark, "append")
    for status in ("F", "O", "P"):
        writers.append_table(t("orders").where(F.col("o_orderstatus") == status), path)
    return spark.read.parquet(path)


@io("sink_replace", "p_partkey:i p_name", "SELECT p_partkey, p_name FROM part")
def _(spark, t):
    spark, path = _stored(t("part").withColumn("p_name", F.lit("old")), "replaced")
    writers.write_table(t("part"), path)
    return writers.read_table(spark, path)


@io("sink_merge", "c_custkey:i c_acctbal:d", MERGED_SQL)
def _(spark, t):
    return _merged_customers(t)


HOURLY_SQL = "SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date_hour, arg_max(value, ts) AS value FROM events GROUP BY 1, 2"


def _hourly(rows: DataFrame) -> DataFrame:
    hours = rollup.hourly_last(rows, ["user_id"], "ts", {"value": "value"}, unique_ts=True)
    return hours.withColumn("day", F.to_date("date_hour"))


def _incremental_hours(t: Tables) -> DataFrame:
    """History to 20 January, then one run with a day of look-back, applied twice."""
    events = t("events")
    first = _hourly(events.where(F.col("ts") < _at("2024-01-20 10:30:00")))
    spark, path = _stored(first, "hours", partition_by="day")
    for _ in range(2):
        start = cursors.lookback_start(writers.read_table(spark, path), "date_hour")
        fresh = _hourly(cursors.new_rows(events, "ts", start, EVENTS_AS_OF))
        upsert.upsert(fresh, path, ["user_id", "date_hour"], partition_by="day")
    return writers.read_table(spark, path)


@io("sink_incremental", "user_id:i date_hour:t value:d", HOURLY_SQL)
def _(spark, t):
    return _incremental_hours(t)


@io(
    "sort_storage_key",
    "o_orderkey:i o_custkey:i o_orderdate:t",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders",
)
def _(spark, t):
    spark, path = _stored(t("orders"), "sorted", sort_by=["o_orderdate", "o_custkey", "o_orderkey"])
    return writers.read_table(spark, path)


@io(
    "schema_evolve",
    "c_custkey:i c_name segment",
    "SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS segment FROM customer",
)
def _(spark, t):
    spark, path = _stored(t("customer").select("c_custkey", "c_name"), "evolve")
    batch = t("customer").where("c_acctbal > 0").select(
        "c_custkey", "c_name", F.col("c_mktsegment").alias("segment")
    )
    upsert.upsert(batch, path, ["c_custkey"], on_schema_change="append_new_columns")
    return writers.read_table(spark, path)


@io(
    "upsert_delete_insert",
    "o_orderkey:i o_totalprice:d year:i",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END AS o_totalprice, year(o_orderdate) AS year FROM orders",
)
def _(spark, t):
    orders = t("orders").withColumn("year", F.year("o_orderdate"))
    spark, path = _stored(
        orders.withColumn("o_totalprice", F.lit(0.0)), "upsert", partition_by="year"
    )
    for _ in range(2):
        upsert.upsert(
            orders.where("o_orderstatus = 'F'"), path, ["o_orderkey", "o_orderdate"], partition_by="year"
        )
    return writers.read_table(spark, path)


# Incremental runs ----------------------------------------------------------------


@io("inc_threshold_lookback", "user_id:i date_hour:t value:d", HOURLY_SQL)
def _(spark, t):
    return _incremental_hours(t)


@io(
    "inc_threshold_per_source",
    "event_id:i event_type ts:t",
    "SELECT event_id, event_type, ts FROM events",
)
def _(spark, t):
    wanted = ["click", "view", "purchase", "signup", "error"]
    rows = t("events").select("event_id", "event_type", "ts")
    kind = F.col("event_type")
    cut = F.when(kind == "click", _at("2024-01-10")).when(kind == "view", _at("2024-01-20"))
    # The other types have no history yet, so their start is the beginning.
    history = rows.where(F.col("ts") < cut)
    starts = cursors.lookback_starts(history, "event_type", "ts", wanted)
    fresh = cursors.new_rows_per_source(rows, "event_type", "ts", starts, EVENTS_AS_OF)
    return upsert.merged_rows(history, fresh, ["event_id"])


@io(
    "inc_cursor_default",
    "event_id:i ts:t",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05'",
)
def _(spark, t):
    nothing = t("events").where(F.lit(False))
    start = cursors.max_time(nothing, "ts", datetime(2024, 1, 5))
    return cursors.new_rows(t("events"), "ts", start, EVENTS_AS_OF)


@io(
    "inc_bounded_catchup",
    "event_id:i ts:t",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2023-12-20' AND ts < TIMESTAMP '2024-01-29'",
)
def _(spark, t):
    path = scratch_path(spark, "catchup")

    def month(low: datetime, high: datetime) -> None:
        inside = (F.col("ts") >= _at(str(low))) & (F.col("ts") < _at(str(high)))
        writers.append_table(t("events").where(inside), path)

    cursors.catch_up(datetime(2023, 12, 20), datetime(2024, 2, 5), month)
    return spark.read.parquet(path)


@io("inc_full_refresh", "user_id:i date_hour:t value:d", HOURLY_SQL)
def _(spark, t):
    stale = _hourly(t("events").withColumn("value", F.lit(-1.0)))
    spark, path = _stored(stale, "refresh", partition_by="day")
    writers.write_table(_hourly(t("events")), path, partition_by="day")
    return writers.read_table(spark, path)


# Streams ----------------------------------------------------------------------------


class _Stream(Operator):
    """An operator over the events file as a stream."""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        events = jobs.landed_stream(
            spark, sf_dir, load(spark, sf_dir, "events").schema, name_filter="events.parquet"
        )
        return present(self.build(spark, events), self.columns)


def stream(name: str, columns: str, sql: str):
    def register(build):
        IO[name] = _Stream(build, tuple(columns.split()), " ".join(sql.split()))
        return build

    return register


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@stream("stream_hourly_last", "user_id:i date_hour:t value:d", HOURLY_SQL)
def _(spark, events):
    zoned = events.withColumn("ts", F.col("ts").cast("timestamp"))
    hours = jobs.with_day(jobs.hourly_last_stream(zoned, ["user_id"], "ts", "value"), "date_hour")
    path, state = scratch_path(spark, "hours"), scratch_path(spark, "state")
    keys = ["user_id", "date_hour"]
    _finish(jobs.run_upsert(hours, path, state, keys, partition_by="day", output_mode="update"))
    return writers.read_table(spark, path)


@stream("stream_dedup", "event_id:i event_type value:d", "SELECT event_id, event_type, value FROM events")
def _(spark, events):
    twice = events.union(events).withColumn("ts", F.col("ts").cast("timestamp"))
    path, state = scratch_path(spark, "dedup"), scratch_path(spark, "state")
    _finish(jobs.run_append(jobs.dedup_stream(twice, ["event_id"], "ts"), path, state))
    return spark.read.parquet(path)


# Delivery in four batches of eight days; every eleventh event comes two batches late, and the last batch
# delivers every seventh event once more, however old it is.
CHUNKS = 4
CHUNK_SQL = "least(3, cast(floor((day(ts) - 1) / 8) as int) + case when event_id % 11 = 0 then 2 else 0 end)"


def _deliveries(t, rows_again: bool):
    """The events as they are delivered: one DataFrame per batch."""
    events = t("events")
    for chunk in range(CHUNKS):
        part = events.where(f"{CHUNK_SQL} = {chunk}")
        if rows_again and chunk == CHUNKS - 1:
            part = part.union(events.where("event_id % 7 = 0"))
        yield part


def _delivered(spark, t, run, rows_again: bool = False) -> None:
    """Lands one delivery after the other and calls ``run(stream)`` after each; a run is one micro-batch."""
    landing = scratch_path(spark, "landing")
    for part in _deliveries(t, rows_again):
        writers.append_table(part, landing)
        _finish(run(jobs.landed_stream(spark, landing, t("events").schema)))


@io("stream_dedup_history", "event_id:i event_type value:d ts:t", "SELECT event_id, event_type, value, ts FROM events")
def _(spark, t):
    path, state = scratch_path(spark, "dedup"), scratch_path(spark, "state")
    _delivered(spark, t, lambda rows: history.run_dedup(rows, path, state, ["event_id"], "ts"), rows_again=True)
    return history.stored_rows(spark, path)


LATE_SQL = f"""SELECT e.*, coalesce(ts < before - INTERVAL '1' DAY, false) AS late
    FROM (SELECT *, {CHUNK_SQL} AS chunk FROM events) e LEFT JOIN
    (SELECT a.chunk, max(b.newest) AS before FROM (SELECT unnest([0, 1, 2, 3]) AS chunk) a
     JOIN (SELECT {CHUNK_SQL} AS chunk, max(ts) AS newest FROM events GROUP BY 1) b ON b.chunk < a.chunk GROUP BY a.chunk) n
    ON n.chunk = e.chunk"""


@io("stream_late_rows", "event_id:i ts:t", f"SELECT event_id, ts FROM ({LATE_SQL}) WHERE late")
def _(spark, t):
    path, state = scratch_path(spark, "dedup"), scratch_path(spark, "state")
    _delivered(spark, t, lambda rows: history.run_dedup(rows, path, state, ["event_id"], "ts"))
    return history.stored_rows(spark, path).where("late")


@io("stream_hourly_late", "user_id:i date_hour:t value:d", HOURLY_SQL)
def _(spark, t):
    path, state = scratch_path(spark, "hours"), scratch_path(spark, "state")
    _delivered(spark, t, lambda rows: history.run_hourly_last(rows, path, state, ["user_id"], "ts", "value"), rows_again=True)
    return history.hourly_rows(spark, path, ["user_id"], "value")


@io(
    "stream_late_counts",
    "user_id:i date_hour:t rows:i",
    f"SELECT user_id, date_trunc('hour', ts) AS date_hour, count(*) AS rows FROM ({LATE_SQL}) WHERE late GROUP BY 1, 2",
)
def _(spark, t):
    path, state = scratch_path(spark, "hours"), scratch_path(spark, "state")
    _delivered(spark, t, lambda rows: history.run_hourly_last(rows, path, state, ["user_id"], "ts", "value"))
    return history.late_counts(spark, path, ["user_id"])


LATEST_SQL = "SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, max(ts) AS ts FROM events GROUP BY 1, 2"


@stream("stream_upsert", "user_id:i event_type event_id:i ts:t", LATEST_SQL)
def _(spark, events):
    path, state = scratch_path(spark, "latest"), scratch_path(spark, "state")
    _finish(jobs.run_upsert(events, path, state, ["user_id", "event_type"], version=["ts"]))
    return writers.read_table(spark, path)


@io("stream_availablenow", "event_id:i ts:t", "SELECT event_id, ts FROM events")
def _(spark, t):
    landing, path, state = (scratch_path(spark, n) for n in ("landing", "out", "state"))
    middle = _at("2024-01-16")
    for part in (t("events").where(F.col("ts") < middle), t("events").where(F.col("ts") >= middle)):
        writers.append_table(part, landing)
        rows = jobs.landed_stream(spark, landing, t("events").schema, files_per_trigger=8)
        # The second run resumes from the checkpoint and sees only the new files.
        _finish(jobs.run_append(rows, path, state))
    return spark.read.parquet(path)


@io(
    "stream_hot_cold_union",
    "user_id:i date_hour:t value:d",
    HOURLY_SQL,
)
def _(spark, t):
    cutoff = datetime(2024, 1, 20)
    cold = _hourly(t("events").where(F.col("ts") < _at("2024-01-24")))
    spark, path = _stored(cold, "cold", partition_by="day")
    hot = _hourly(t("events").where(F.col("ts") >= _at("2024-01-16")))
    return setops.union_at_cutover(writers.read_table(spark, path), hot, "date_hour", cutoff)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: op.run for name, op in IO.items()}


def oracles() -> dict[str, str]:
    return {name: select_sql(op.sql, op.columns) for name, op in IO.items()}
