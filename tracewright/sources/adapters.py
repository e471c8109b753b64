"""Adapters from generic tables to the canonical event log and case master.

Each adapter is a projection (plus, for case masters, one aggregate): filters and column
pruning reach the Parquet scan, and no adapter needs a window of its own. Only the order log
counts its rows first, since its tasks follow them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewright.functions.columns import elapsed_us, hours, literal_map
from tracewright.functions.dealing import cut_by
from tracewright.model import CASE_COLUMNS, EVENT_COLUMNS, SLA_TARGET_HOURS

CLICK_IDEAL = ("signup", "view", "click", "purchase")
CLICK_DECISION, CLICK_APPROVAL, CLICK_REWORK = "purchase", "view", "error"
# SLA target hours of click cases by grain: near the median, so both outcomes occur.
CLICK_TARGETS = {
    "day": {"Urgent": 1.0, "Standard": 3.0, "Strategic": 6.0},
    "week": {"Urgent": 96.0, "Standard": 144.0, "Strategic": 156.0},
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(index: Column, labels: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int"))


def _user_dimensions(user: Column) -> dict[str, Column]:
    return {
        "business_unit": F.concat(F.lit("BU-"), (user % 3).cast("string")),
        "department": F.concat(F.lit("Dept-"), (user % 5).cast("string")),
        "country": F.concat(F.lit("Country-"), (user % 4).cast("string")),
        "vendor_id": F.concat(F.lit("V-"), (user % 80).cast("string")),
        "vendor_tier": _pick(F.floor(user / 3) % 3, ("A", "B", "C")),
        "material_category": F.concat(F.lit("Cat-"), (user % 7).cast("string")),
        "priority": _pick(F.floor(user / 9) % 3, ("Urgent", "Standard", "Strategic")),
        "channel": F.concat(F.lit("Channel-"), (user % 2).cast("string")),
    }


def _click_case(grain: str) -> Column:
    day = F.date_format(F.date_trunc(grain, F.col("ts").cast("timestamp")), "yyyy-MM-dd")
    return F.concat_ws("|", F.col("user_id").cast("string"), day)


def clickstream_events(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Click log: a case is one user's day or week; ``event_id`` numbers its events."""
    kind = F.col("event_type")
    system_step = kind.isin("error", "signup")
    columns = {
        "case_id": _click_case(grain),
        "event_index": F.col("event_id"),
        "activity": kind,
        "timestamp": F.col("ts").cast("timestamp"),
        "resource_id": F.concat(F.lit("R-"), F.get_json_object("props", "$.k")),
        "resource_role": F.when(system_step, "Bot").otherwise("Agent"),
        **_user_dimensions(F.col("user_id")),
        "amount_usd": F.col("value"),
        "automated": system_step,
        "processing_minutes": F.col("value"),
        "source_system": F.when(kind == "purchase", "Checkout").when(system_step, "Portal")
        .otherwise("Web"),
    }
    return read(spark, sf_dir, "events").select(
        *[columns[name].alias(name) for name in EVENT_COLUMNS]
    )


def clickstream_cases(spark: SparkSession, sf_dir: str, grain: str = "week") -> DataFrame:
    """Case master of the click log. ``collect_set`` is bounded by the activity labels."""
    table = read(spark, sf_dir, "events").select(
        _click_case(grain).alias("case_id"), "user_id", "event_type", "value",
        F.col("ts").cast("timestamp").alias("ts"),
    )
    grouped = table.groupBy("case_id", "user_id").agg(
        F.min("ts").alias("created_at"),
        F.max("ts").alias("completed_at"),
        F.count(F.lit(1)).cast("int").alias("event_count"),
        F.array_sort(F.collect_set("event_type")).alias("_kinds"),
        F.round(F.sum("value"), 2).alias("amount_usd"),
    )
    dims = _user_dimensions(F.col("user_id"))
    target = F.element_at(literal_map(CLICK_TARGETS[grain]), F.col("priority"))
    cycle = hours(elapsed_us(F.col("created_at"), F.col("completed_at")))
    return (
        grouped.withColumns(dims)
        .withColumn("variant_ground_truth", F.array_join("_kinds", "+"))
        .withColumn("rework_count", F.col("event_count") - F.size("_kinds"))
        .withColumn("cycle_time_hours", cycle)
        .withColumn("sla_target_hours", target)
        .withColumn("sla_breached", F.col("cycle_time_hours") > F.col("sla_target_hours"))
        .select(*CASE_COLUMNS)
    )


# Readable form of the order priorities; the others stay as they are and break the domain.
ORDER_PRIORITIES = {"1-URGENT": "Urgent", "3-MEDIUM": "Standard", "2-HIGH": "Strategic"}
FLAG_TEXT = {"A": "TRUE", "N": "0"}


def line_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as an unchecked log: a case is an order, a line is a shipment event."""
    flag = F.col("l_returnflag")
    columns = {
        "case_id": F.col("l_orderkey").cast("string"),
        "event_index": F.col("l_linenumber"),
        "activity": F.concat(F.lit("Ship "), flag, F.col("l_linestatus")),
        "timestamp": F.col("l_shipdate").cast("timestamp"),
        "resource_id": F.concat(F.lit("S-"), F.col("l_suppkey").cast("string")),
        "resource_role": F.lit("Supplier"),
        "amount_usd": F.col("l_extendedprice"),
        "automated": F.coalesce(F.try_element_at(literal_map(FLAG_TEXT), flag), flag),
        "processing_minutes": F.col("l_quantity"),
        "part": F.col("l_partkey"),
    }
    return read(spark, sf_dir, "lineitem").select(*[c.alias(n) for n, c in columns.items()])


def line_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a feed would write them, all columns text: amounts of open lines carry a
    currency, numbers of returned lines a fraction, and accepted lines a word for their date."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    index = F.col("l_linenumber").cast("string")
    amount = F.col("l_extendedprice").cast("string")
    columns = {
        "case_id": F.col("l_orderkey").cast("string"),
        "event_index": F.when(flag == "R", F.concat(index, F.lit(".5"))).otherwise(index),
        "activity": F.concat(F.lit("Ship "), flag, status),
        "timestamp": F.when(flag == "A", "accepted").otherwise(
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        "amount_usd": F.when(status == "O", F.concat(amount, F.lit(" USD"))).otherwise(amount),
        "processing_minutes": F.col("l_quantity").cast("string"),
        "automated": F.when(status == "F", "TRUE").otherwise(flag),
    }
    return read(spark, sf_dir, "lineitem").select(*[c.alias(n) for n, c in columns.items()])


def order_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the unchecked case master of the shipment log.

    The highest line number is the declared event count. Repeats can come out negative, the
    cycle can run backwards and labels can be out of domain: the rules are there to find it.
    """
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_linenumber").alias("event_count"),
        F.count(F.lit(1)).alias("lines"),
        F.max("l_shipdate").cast("timestamp").alias("completed_at"),
    )
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = read(spark, sf_dir, "orders")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").join(
        customers, orders.o_custkey == customers.c_custkey, "left"
    )
    created = F.col("o_orderdate").cast("timestamp")
    priority = F.col("o_orderpriority")
    label = F.coalesce(F.try_element_at(literal_map(ORDER_PRIORITIES), priority), priority)
    return joined.select(
        F.col("o_orderkey").cast("string").alias("case_id"),
        created.alias("created_at"),
        "completed_at",
        F.substring("c_mktsegment", 1, 1).alias("vendor_tier"),
        label.alias("priority"),
        F.col("o_totalprice").alias("amount_usd"),
        "event_count",
        (F.col("event_count") - F.col("lines")).alias("rework_count"),
        hours(elapsed_us(created, F.col("completed_at"))).alias("cycle_time_hours"),
        F.coalesce(F.try_element_at(literal_map(SLA_TARGET_HOURS), label), F.lit(0.0))
        .alias("sla_target_hours"),
        (F.col("o_orderstatus") == "P").alias("sla_breached"),
    )


# The order process: an order is placed, its lines ship, are accepted or come back, and a settled
# order is closed. Dates, amounts, statuses, customers and suppliers are those of the tables.
ORDER_IDEAL = ("Order Placed", "Goods Shipped", "Goods Accepted", "Order Closed")
ORDER_DECISION, ORDER_APPROVAL, ORDER_REWORK = "Goods Shipped", "Goods Accepted", "Goods Returned"
LINE_ACTIVITIES = {"N": "Goods Shipped", "A": "Goods Accepted", "R": "Goods Returned"}
ORDER_URGENCY = {"1-URGENT": "Urgent", "2-HIGH": "Strategic"}
# SLA target hours of orders: within the time the last orders have left, so both outcomes occur early
# and late.
ORDER_TARGETS = {"Urgent": 3_600.0, "Standard": 7_200.0, "Strategic": 10_800.0}
# Least balance of a supplier of tier A and B, and of a customer who pays ahead.
TIER_BALANCE = {"A": 6_000.0, "B": 3_000.0}
AHEAD_BALANCE = 5_000.0
# Events of a case in time; at one moment lines go by number, and the closing event comes last.
ORDER_SORT = ("timestamp", "event_index", "activity")
CLOSING_INDEX = 1_000_000


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with segment, nation and region; the small dimensions are joined first."""
    regions = read(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("business_unit"))
    nations = read(spark, sf_dir, "nation").join(regions, "n_regionkey", "left").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"),
        "business_unit")
    return read(spark, sf_dir, "customer").join(nations, "c_nationkey", "left").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("department"),
        "country", "business_unit",
        F.when(F.col("c_acctbal") >= AHEAD_BALANCE, "Prepaid").otherwise("Account")
        .alias("channel"))


def _placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgency = F.try_element_at(literal_map(ORDER_URGENCY), F.col("o_orderpriority"))
    return read(spark, sf_dir, "orders").join(_customers(spark, sf_dir), "o_custkey", "left").select(
        F.col("o_orderkey").cast("string").alias("case_id"), "o_custkey", "o_orderstatus",
        F.col("o_orderdate").cast("timestamp").alias("placed_at"),
        F.col("o_totalprice").alias("amount_usd"),
        F.coalesce(urgency, F.lit("Standard")).alias("priority"),
        "business_unit", "department", "country", "channel")


def _lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("case_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipped_at"), *columns)


def order_process_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order log: placing and closing from ``orders``, one event per line from ``lineitem``.

    Lines meet their order in joins by case, in tasks of about ``TASK_ROWS`` rows of both; the
    closing event stands at the last date of the order.
    """
    orders = _placed_orders(spark, sf_dir)
    lines = _lines(spark, sf_dir, "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus",
                   "l_extendedprice", "l_quantity")
    keys = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("case_id"))
    even, *heavy = cut_by("case_id", lines, keys)(orders, lines)
    # A task's share is bounded where rows are dealt, so its orders can be hashed and nothing is sorted.
    logs = [_order_events(*even, join="shuffle_hash"), *[_order_events(*piece) for piece in heavy]]
    return reduce(DataFrame.unionByName, logs)


def _order_events(orders: DataFrame, lines: DataFrame, join: str | None = None) -> DataFrame:
    """``join`` is the hint for the smaller side of each join."""
    def built(frame):
        return frame.hint(join) if join else frame

    last = lines.groupBy("case_id").agg(F.max("shipped_at").alias("last_at"))
    shared = ("case_id", "business_unit", "department", "country", "priority", "channel")

    def events(frame, index, activity, at, resource, role, vendor, amount, automated, minutes, system):
        return frame.select(
            *shared, index.cast("long").alias("event_index"), activity.alias("activity"),
            at.alias("timestamp"), resource.alias("resource_id"),
            F.lit(role).alias("resource_role"), vendor.alias("vendor_id"),
            amount.alias("amount_usd"), automated.alias("automated"),
            minutes.cast("double").alias("processing_minutes"), system.alias("source_system"))

    none = F.lit(None).cast("string")
    placed = events(
        orders, F.lit(0), F.lit("Order Placed"), F.col("placed_at"),
        F.concat(F.lit("C-"), F.col("o_custkey").cast("string")), "Customer", none,
        F.col("amount_usd"), F.lit(False), F.lit(0), F.lit("Order Desk"))
    closed = events(
        orders.where("o_orderstatus = 'F'").join(built(last), "case_id", "left"),
        F.lit(CLOSING_INDEX), F.lit("Order Closed"), F.greatest("placed_at", "last_at"),
        F.lit("DESK"), "Desk", none, F.col("amount_usd"), F.lit(True), F.lit(0), F.lit("Ledger"))
    supplier = F.col("l_suppkey").cast("string")
    shipped = events(
        lines.join(built(orders.drop("amount_usd")), "case_id"), F.col("l_linenumber"),
        F.element_at(literal_map(LINE_ACTIVITIES), F.col("l_returnflag")), F.col("shipped_at"),
        F.concat(F.lit("S-"), supplier), "Supplier", F.concat(F.lit("V-"), supplier),
        F.col("l_extendedprice"), F.col("l_linestatus") == "F", F.col("l_quantity"),
        F.when(F.col("l_linestatus") == "F", "Settled Lines").otherwise("Open Lines"))
    return placed.unionByName(shipped).unionByName(closed)


def order_process_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case master of the order log; supplier and part are those of the dearest line."""
    lines = _lines(spark, sf_dir, "l_suppkey", "l_partkey", "l_returnflag", "l_extendedprice")
    per_order = lines.groupBy("case_id").agg(
        F.max("shipped_at").alias("last_at"), F.count(F.lit(1)).alias("lines"),
        # Bounded by the flags; a distinct count would shuffle the lines twice.
        F.size(F.collect_set("l_returnflag")).alias("kinds"),
        F.max(F.struct("l_extendedprice", "l_suppkey", "l_partkey")).alias("dearest"))
    balance = F.col("s_acctbal")
    tier = F.when(balance >= TIER_BALANCE["A"], "A").when(
        balance >= TIER_BALANCE["B"], "B").otherwise("C")
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", tier.alias("vendor_tier"))
    parts = read(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("material_category"))
    closing = (F.col("o_orderstatus") == "F").cast("int")
    lines_or_0 = F.coalesce("lines", F.lit(0))
    completed = F.greatest("placed_at", "last_at")
    cycle = hours(elapsed_us(F.col("placed_at"), completed))
    target = F.element_at(literal_map(ORDER_TARGETS), F.col("priority"))
    joined = _placed_orders(spark, sf_dir).join(per_order, "case_id", "left")
    joined = joined.withColumns({
        "s_suppkey": F.col("dearest.l_suppkey"), "p_partkey": F.col("dearest.l_partkey")})
    return joined.join(suppliers, "s_suppkey", "left").join(parts, "p_partkey", "left").withColumns({
        "created_at": F.col("placed_at"), "completed_at": completed,
        "vendor_id": F.concat(F.lit("V-"), F.col("s_suppkey").cast("string")),
        "variant_ground_truth": F.col("o_orderstatus"),
        "event_count": (1 + lines_or_0 + closing).cast("int"),
        "rework_count": (lines_or_0 - F.coalesce("kinds", F.lit(0))).cast("int"),
        "cycle_time_hours": cycle, "sla_target_hours": target, "sla_breached": cycle > target,
    }).select(*CASE_COLUMNS)


def chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as traces of speaker roles; turns are one second apart."""
    return read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("case_id"),
        F.col("turn").alias("event_index"),
        F.col("role").alias("activity"),
        F.timestamp_seconds("turn").alias("timestamp"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring samples from the event table: each event reports one analysis run."""
    table = read(spark, sf_dir, "events")
    return table.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("status"),
        (F.col("value") / 20).alias("duration_seconds"),
        (F.floor(F.col("value") * 2500).cast("bigint")).alias("events_loaded"),
        F.col("user_id").alias("cases_loaded"),
        F.least(F.lit(1.0), F.col("value") / 60).alias("sla_adherence"),
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("worker-"), (F.col("user_id") % 4).cast("string")).alias("instance"),
    )


def counter_samples(spark: SparkSession, sf_dir: str, buckets: Sequence[float]) -> DataFrame:
    """What the runs of ``run_log`` look like to a scraper: cumulative counters of each instance,
    which restarts every day. ``durations`` are the runs up to each bucket bound, then all runs."""
    runs = run_log(spark, sf_dir)
    life = Window.partitionBy("instance", F.date_trunc("day", F.col("ts"))).orderBy("ts", "run_id")
    seconds = F.col("duration_seconds")
    upto = [F.count_if(seconds <= F.lit(float(b))).over(life) for b in buckets]
    return runs.select(
        "instance", "ts", "run_id",
        F.count_if(F.col("status") == "failure").over(life).alias("failures"),
        F.array(*upto, F.count(F.lit(1)).over(life)).alias("durations"),
    )
