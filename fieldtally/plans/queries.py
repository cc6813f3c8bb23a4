"""The registered queries: each operator on the driver's tables, whole tables only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldtally import operators as op
from fieldtally.functions import path_text, pico_to_timestamp
from fieldtally.operators.ordered import micros
from fieldtally.plans import roles
from fieldtally.plans.roles import BALLS, CARRY, MIN_BALANCE, PLAYER, SINCE, SOURCE_VERTEX, ZONES, table
from fieldtally.sinks import format_paths, write_paths_report, write_stream, write_table
from fieldtally.sources import (
    CUSTOMERS_SCHEMA,
    ORDERS_SCHEMA,
    read_edge_list,
    read_pipe_table,
    read_positions,
    read_tagged_tables,
    stream_positions,
)
from fieldtally.sources.delimited import CORRUPT
from fieldtally.streaming import (
    account,
    closed_avg_step,
    closed_zone_exits,
    finish_positions,
    live_running_best,
    read_best,
    results,
    run_to_the_end,
    stream_avg_step,
    stream_zone_exits,
    track_best,
)
from fieldtally.streaming.tail import BESTS, EXITS, STEPS
from fieldtally.workspace import folder_bytes, in_name_order, new_run_dir

DAY, SPAN, ROLLUP = "1 day", "5 days", "10 days"
BLOCK = "90 days"
STATE_SLICE = "1 minute"
FILE_ROWS, FILES, FULL_FILE_ROWS = 2_500, 40, 2_000_000  #: least rows of a position file, files that larger tables make of larger files, most rows
TRIGGER_BYTES, TRIGGERS, FULL_TRIGGER_BYTES = 512_000, 12, 1 << 30  #: the same of position files in a micro-batch
LAG, SLOT, DELAY = "15 days", "5 days", "2 days"


def ntz(*names: str):
    """Window bounds back in the zone-less type the tables use."""
    return [F.col(name).cast("timestamp_ntz").alias(name) for name in names]


# --- relational -------------------------------------------------------------------------


def customers(spark: SparkSession, sf: str, inclusive: bool = False) -> DataFrame:
    rich = op.filter_above(table(spark, sf, "customer"), "c_acctbal", MIN_BALANCE, inclusive)
    return rich.select("c_custkey", *CARRY)


def recent_orders(spark: SparkSession, sf: str, inclusive: bool = False) -> DataFrame:
    recent = op.filter_since(table(spark, sf, "orders"), "o_orderdate", SINCE, inclusive)
    return recent.select("o_custkey", "o_totalprice", "o_orderdate")


def customer_orders(spark: SparkSession, sf: str) -> DataFrame:
    joined = op.facts_with_entities(recent_orders(spark, sf), customers(spark, sf), "o_custkey", "c_custkey")
    return joined.select("c_custkey", *CARRY, "o_totalprice", "o_orderdate")


def avg_order_value(spark: SparkSession, sf: str, inclusive: bool = False, tagged: bool = False) -> DataFrame:
    who, what = customers(spark, sf, inclusive), recent_orders(spark, sf, inclusive)
    if tagged:
        mean = op.tagged_avg(who, what, "c_custkey", "o_custkey", roles.price_cents(), CARRY, "avg_cents")
    else:
        mean = op.avg_per_entity(
            who, what, "c_custkey", "o_custkey", roles.price_cents(), CARRY, "avg_cents", unique_entities=True
        )
    return mean.select("c_custkey", *CARRY, (F.col("avg_cents") / 100).alias("avg_price"))


def order_sum_count(spark: SparkSession, sf: str) -> DataFrame:
    return op.sum_and_count(table(spark, sf, "orders"), "o_custkey", roles.price_cents(), "total_cents", "orders")


def customers_without_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer has an order here, so whole tables with an answer stand in: events are the orders."""
    return op.entities_without(
        table(spark, sf, "customer"), table(spark, sf, "events"), "c_custkey", "user_id", ["c_name"], unique_entities=True
    )


def order_existence(spark: SparkSession, sf: str) -> DataFrame:
    return op.existence_flags(table(spark, sf, "customer"), table(spark, sf, "events"), "c_custkey", "user_id", "has_order")


def tagged_files(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and orders written as text, read back as one list of inputs told apart by
    file name, and averaged in the tagged form."""
    folder = new_run_dir(spark, "tagged")
    blank = F.lit(None).cast("string")
    write_table(
        table(spark, sf, "customer").select(
            "c_custkey", "c_name", blank.alias("address"), "c_nationkey", blank.alias("phone"), "c_acctbal", "c_mktsegment",
            blank.alias("comment"),
        ),
        f"{folder}/customers.csv",
    )
    write_orders(spark, sf, f"{folder}/orders.csv")
    read = read_tagged_tables(
        spark,
        [f"{folder}/customers.csv", f"{folder}/orders.csv"],
        {"customers.csv": CUSTOMERS_SCHEMA, "orders.csv": ORDERS_SCHEMA},
        default="customers.csv",
    )
    who = op.filter_above(read["customers.csv"], "acctbal", MIN_BALANCE, inclusive=True)
    what = op.filter_since(read["orders.csv"], "orderdate", SINCE, inclusive=True)
    cents = F.rint(F.col("price") * 100).cast("long")
    return op.tagged_avg(who, what, "custkey", "custkey", cents, ["name", "mktsegment"], "avg_cents").select(
        F.col("custkey").alias("c_custkey"),
        F.col("name").alias("c_name"),
        F.col("mktsegment").alias("c_mktsegment"),
        (F.col("avg_cents") / 100).alias("avg_price"),
    )


# --- graph ------------------------------------------------------------------------------


def frontier_messages(spark: SparkSession, sf: str) -> DataFrame:
    edges = roles.edges(spark, sf)
    state = op.seed(op.vertices(edges), SOURCE_VERTEX)
    first = op.unsettled(op.frontier_messages(state.where(F.col("hops") == 0), edges), state)
    return op.frontier_messages(first, edges)


def merge_state(spark: SparkSession, sf: str) -> DataFrame:
    edges = roles.edges(spark, sf)
    state = op.seed(op.vertices(edges), SOURCE_VERTEX)
    for hops in range(2):
        frontier = state.where(F.col("hops") == hops)
        state = op.merge_state(state, op.unsettled(op.frontier_messages(frontier, edges), state))
        if hops == 0:  # the plan would triple with every round
            path = new_run_dir(spark, "state")
            state.write.parquet(path)
            state = spark.read.schema(state.schema).parquet(path)
    return state


def sssp(spark: SparkSession, sf: str, with_path: bool = True) -> DataFrame:
    return op.shortest_paths(roles.edges(spark, sf), SOURCE_VERTEX, with_path=with_path)


def sssp_paths(spark: SparkSession, sf: str) -> DataFrame:
    reached = sssp(spark, sf).where(F.col("hops").isNotNull())
    return reached.select("id", "hops", "parent", path_text(F.col("path")).alias("path"))


# --- motion -----------------------------------------------------------------------------


def balls(spark: SparkSession, sf: str) -> DataFrame:
    return op.only_entities(roles.positions(spark, sf), BALLS)


def player(spark: SparkSession, sf: str) -> DataFrame:
    return op.only_entities(roles.positions(spark, sf), [PLAYER])


def zone_exits(spark: SparkSession, sf: str, scope: str) -> DataFrame:
    exits = op.zone_exits(balls(spark, sf), ZONES, DAY, scope)
    return exits.select(*ntz("window_start", "window_end"), "zone", "exits")


def zone_exits_total(spark: SparkSession, sf: str) -> DataFrame:
    total = op.rollup_exits(op.zone_exits(balls(spark, sf), ZONES, DAY), ROLLUP)
    return total.select(*ntz("window_start", "window_end"), "zone", "exits")


def zone_table_exits(spark: SparkSession, sf: str) -> DataFrame:
    """Exits per day from each zone of a table of zones."""
    exits = op.zone_table_exits(balls(spark, sf), roles.zone_table(spark, sf), DAY)
    return exits.select(*ntz("window_start", "window_end"), "zone", "exits")


def order_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their place in the order of their customers' numbers as text."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return op.ranked(orders, ["o_custkey"])


def step_distances(spark: SparkSession, sf: str) -> DataFrame:
    steps = op.step_distances(player(spark, sf))
    return steps.select("seq", *ntz("ts"), F.round("step", 6).alias("step"))


def windows(spark: SparkSession, sf: str) -> DataFrame:
    return op.avg_step(player(spark, sf), SPAN, DAY)


def rounded_windows(found: DataFrame) -> DataFrame:
    return found.select(*ntz("window_start", "window_end"), F.round("avg_step", 6).alias("avg_step"))


def running_best(spark: SparkSession, sf: str, since: str | None = None) -> DataFrame:
    emit_from = F.lit(since).cast("timestamp") if since else None
    best = op.running_best(windows(spark, sf), emit_from, BLOCK)
    bounds = ntz("window_start", "window_end", "best_start", "best_end")
    return best.select(*bounds, F.round("best_avg", 6).alias("best_avg"))


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as a stream of positions."""
    events = table(spark, sf, "events")
    # a pattern, because a stream takes a folder or a pattern but not the path of one file
    return roles.as_positions(spark.readStream.schema(events.schema).parquet(f"{sf}/event[s].parquet"))


def streamed_zone_exits(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_run_dir(spark, "exits")
    options = {"entities": BALLS, "checkpoint": f"{folder}/progress"}
    run_to_the_end(event_stream(spark, sf), lambda rows: closed_zone_exits(rows, ZONES, f"{folder}/tables", DAY, ROLLUP, **options))
    return results(spark, f"{folder}/tables", "exits", EXITS).select(*ntz("window_start", "window_end"), "zone", "exits")


def streamed_avg_step(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_run_dir(spark, "steps")
    options = {"entities": [PLAYER], "checkpoint": f"{folder}/progress"}
    run_to_the_end(event_stream(spark, sf), lambda rows: closed_avg_step(rows, f"{folder}/tables", SPAN, DAY, **options))
    return rounded_windows(results(spark, f"{folder}/tables", "steps", STEPS))


def position_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The events in the columns of position files, with their event time in microseconds and their id."""
    events = table(spark, sf, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    sensors = F.array(*[F.lit(x) for x in (*BALLS, PLAYER)])
    picos = F.col("us").cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)") + F.col("event_id")
    return events.select(
        "us", "event_id", F.array_position(sensors, F.col("event_type")).cast("int").alias("sensor"), picos.cast("decimal(38,0)").alias("picos"),
        F.rint(F.col("value") * 100).cast("int").alias("x"), F.get_json_object("props", "$.k").cast("int").alias("y"),
        *[F.lit(0).alias(f"unused_{n}") for n in range(9)],
    )


def file_count(rows: int) -> int:
    """Number of position files. Every file or few files are a micro-batch of a replay, and each costs some seconds whatever it holds, so
    larger tables make larger files, not more, until a file has ``FULL_FILE_ROWS``."""
    size = max(FILE_ROWS, min(-(-rows // FILES), FULL_FILE_ROWS))
    return -(-rows // size) or 1


def trigger_bytes(spark: SparkSession, files: str) -> int:
    """The bound of a micro-batch over a folder of position files: it follows the folder for the same reason."""
    return max(TRIGGER_BYTES, min(-(-folder_bytes(spark, files) // TRIGGERS), FULL_TRIGGER_BYTES))


def position_files(spark: SparkSession, sf: str) -> str:
    """The events as position files, each a range of time, in the order of time; more rows make more files, then larger ones."""
    path = f"{new_run_dir(spark, 'position-files')}/positions"
    rows = position_rows(spark, sf).drop("event_id")
    ordered = rows.repartitionByRange(file_count(rows.count()), "us", "picos").sortWithinPartitions("us", "picos")
    write_table(ordered.drop("us"), path, sep=",")
    in_name_order(spark, path)
    return path


def delayed_files(spark: SparkSession, sf: str) -> str:
    """The events as position files in the order of arrival: one in ten rows arrives ``LAG`` late, and one in 97 lines is damaged. No
    file reaches over more than ``SLOT`` of arrival time."""
    path = f"{new_run_dir(spark, 'delayed-files')}/positions"
    lag = F.when(F.col("event_id") % 10 == 3, F.lit(micros(LAG))).otherwise(F.lit(0))
    rows = position_rows(spark, sf).withColumn("arrival", F.col("us") + lag)
    fields = [c for c in rows.columns if c not in ("us", "event_id", "arrival")]
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in fields])
    line = F.when(F.col("event_id") % 97 == 5, F.concat(F.lit("DAMAGED "), F.col("event_id").cast("string"))).otherwise(line)
    slot = F.floor(F.col("arrival") / micros(SLOT)).cast("long").alias("slot")
    lines = rows.select(slot, "arrival", line.alias("line")).repartitionByRange(file_count(rows.count()), "slot", "arrival").sortWithinPartitions("slot", "arrival")
    lines.drop("arrival").write.partitionBy("slot").text(path)
    in_name_order(spark, path)
    return path


def moving(stream: DataFrame) -> DataFrame:
    """Positions read from files in the columns of the motion operators."""
    kept = [CORRUPT] if CORRUPT in stream.columns else []
    return stream.select(
        "ts", F.col("ts_ps").cast("decimal(38,0)").alias("seq"), F.col("sensor_id").alias("entity"), (F.col("x") / 100).alias("x"), "y", *kept
    )


def to_the_end(spark: SparkSession, files: str, start: Callable[[], StreamingQuery]) -> None:
    """Runs a query over the files that are there, then over the end marker, on one checkpoint."""
    start().awaitTermination()
    finish_positions(spark, files)
    start().awaitTermination()


def file_stream_exits(spark: SparkSession, sf: str) -> DataFrame:
    """Averted goals over position files, a bounded number of bytes per micro-batch, kept as CSV that replaces an older result."""
    files = position_files(spark, sf)
    folder = new_run_dir(spark, "exits")
    stream = moving(stream_positions(spark, files, max_bytes_per_trigger=trigger_bytes(spark, files)))
    balls = list(range(1, len(BALLS) + 1))
    total = stream_zone_exits(stream, ZONES, DAY, ROLLUP, entities=balls, slice_width=STATE_SLICE, delay=DAY)
    to_the_end(spark, files, lambda: write_stream(total, f"{folder}/result", f"{folder}/progress", fmt="csv", replace=True))
    return spark.read.schema(total.schema).csv(f"{folder}/result").select(*ntz("window_start", "window_end"), "zone", "exits")


def live_best(spark: SparkSession, sf: str) -> DataFrame:
    """The best window of a player, kept up to date while position files arrive."""
    files = position_files(spark, sf)
    folder = new_run_dir(spark, "best")
    stream = moving(stream_positions(spark, files, max_bytes_per_trigger=trigger_bytes(spark, files)))
    windows = stream_avg_step(stream, SPAN, DAY, entities=[len(BALLS) + 1], slice_width=STATE_SLICE)
    to_the_end(spark, files, lambda: track_best(windows, f"{folder}/record", f"{folder}/progress"))
    return rounded_windows(read_best(spark, f"{folder}/record"))


def live_bests(spark: SparkSession, sf: str) -> DataFrame:
    """For every window from a time on the best so far, while position files arrive."""
    files, folder = position_files(spark, sf), new_run_dir(spark, "bests")
    stream = moving(stream_positions(spark, files, max_bytes_per_trigger=trigger_bytes(spark, files)))
    since = F.lit("2024-01-15").cast("timestamp")
    options = {"entities": [len(BALLS) + 1], "checkpoint": f"{folder}/progress"}
    to_the_end(spark, files, lambda: live_running_best(stream, f"{folder}/tables", SPAN, DAY, since, BLOCK, **options))
    bests = results(spark, f"{folder}/tables", "bests", BESTS)
    return bests.select(*ntz("window_start", "window_end", "best_start", "best_end"), F.round("best_avg", 6).alias("best_avg"))


def closed_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Mean steps of a stream without rows gathered in arrays."""
    files, folder = position_files(spark, sf), new_run_dir(spark, "steps")
    stream = moving(stream_positions(spark, files, max_bytes_per_trigger=trigger_bytes(spark, files)))
    options = {"entities": [len(BALLS) + 1], "checkpoint": f"{folder}/progress"}
    to_the_end(spark, files, lambda: closed_avg_step(stream, f"{folder}/tables", SPAN, DAY, **options))
    return rounded_windows(results(spark, f"{folder}/tables", "steps", STEPS))


def closed_exits(spark: SparkSession, sf: str) -> DataFrame:
    """Exits of a stream, rolled up, without rows gathered in arrays."""
    files, folder = position_files(spark, sf), new_run_dir(spark, "exits")
    stream = moving(stream_positions(spark, files, max_bytes_per_trigger=trigger_bytes(spark, files)))
    balls = list(range(1, len(BALLS) + 1))
    to_the_end(spark, files, lambda: closed_zone_exits(stream, ZONES, f"{folder}/tables", DAY, ROLLUP, entities=balls, checkpoint=f"{folder}/progress"))
    return results(spark, f"{folder}/tables", "exits", EXITS).select(*ntz("window_start", "window_end"), "zone", "exits")


def delayed_stream(spark: SparkSession, sf: str) -> str:
    """Runs the exits of a stream with late rows and damaged lines; returns the folder of its tables."""
    files, folder = delayed_files(spark, sf), new_run_dir(spark, "delayed")
    stream = moving(stream_positions(spark, files, max_files_per_trigger=1, mode="PERMISSIVE"))
    balls = list(range(1, len(BALLS) + 1))
    options = {"entities": balls, "delay": DELAY, "checkpoint": f"{folder}/progress"}
    to_the_end(spark, files, lambda: closed_zone_exits(stream, ZONES, f"{folder}/tables", DAY, None, **options))
    return f"{folder}/tables"


def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Exits per day of what is neither late nor damaged."""
    found = results(spark, delayed_stream(spark, sf), "exits", EXITS)
    return found.select(*ntz("window_start", "window_end"), "zone", "exits")


def stream_account(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows a stream was given, kept, dropped as late, and could not read. The end marker is not counted."""
    totals = account(spark, delayed_stream(spark, sf)).agg(*[F.sum(c).alias(c) for c in ("given", "kept", "late", "bad")])
    return totals.select((F.col("given") - 1).alias("given"), (F.col("kept") - 1).alias("kept"), "late", "bad")


def paths_report(spark: SparkSession, sf: str) -> DataFrame:
    """The path report written as delimited text and read back."""
    path = new_run_dir(spark, "report")
    write_paths_report(sssp(spark, sf), SOURCE_VERTEX, path)
    read = spark.read.schema("source LONG, dest LONG, path STRING, cost STRING").csv(path, sep="|")
    return read.withColumn("path", F.coalesce("path", F.lit("")))


def pico_event_time(spark: SparkSession, sf: str) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(38,0)")
    picos = (micros * F.lit(1_000_000).cast("decimal(7,0)") + F.col("event_id")).cast("decimal(38,0)").cast("string")
    time = pico_to_timestamp(picos).cast("timestamp_ntz")
    return table(spark, sf, "events").select("event_id", time.alias("event_time"))


# --- sources and sinks ------------------------------------------------------------------


def write_orders(spark: SparkSession, sf: str, path: str) -> None:
    blank = F.lit(None).cast("string")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date"), "o_orderpriority",
        blank.alias("clerk"), blank.alias("shippriority"), blank.alias("comment"),
    )
    write_table(orders, path, order_by=["o_custkey"])


def pipe_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{new_run_dir(spark, 'orders')}/orders.csv"
    write_orders(spark, sf, path)
    back = read_pipe_table(spark, path, ORDERS_SCHEMA)
    return back.select("orderkey", "custkey", "orderstatus", "price", "orderdate", "orderpriority")


def edge_list_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "edges")
    write_table(roles.edges(spark, sf).distinct(), path, sep="\t", header=True)
    return read_edge_list(spark, path)


def positions_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "positions")
    zero = F.lit(0)
    rows = table(spark, sf, "events").select(
        F.col("user_id"),
        (F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")).cast(
            "decimal(38,0)"
        ),
        F.rint(F.col("value") * 100).cast("int"),
        F.get_json_object("props", "$.k").cast("int"),
        *[zero.alias(f"unused_{n}") for n in range(9)],
    )
    write_table(rows, path, sep=",")
    return read_positions(spark, path).select("sensor_id", *ntz("ts"), "x", "y", "z")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "q01_balance_filter": customers,
        "q02_orders_since": recent_orders,
        "q03_orders_since_inclusive": lambda s, d: recent_orders(s, d, inclusive=True),
        "q04_customer_orders": customer_orders,
        "q05_avg_order_value": avg_order_value,
        "q06_avg_order_value_inclusive": lambda s, d: avg_order_value(s, d, inclusive=True),
        "q07_avg_order_value_tagged": lambda s, d: avg_order_value(s, d, inclusive=True, tagged=True),
        "q08_order_sum_count": order_sum_count,
        "q09_customers_without_orders": customers_without_orders,
        "q10_order_existence": order_existence,
        "q11_graph_vertices": lambda s, d: op.vertices(roles.edges(s, d)),
        "q12_graph_edges": lambda s, d: roles.edges(s, d).distinct(),
        "q13_frontier_messages": frontier_messages,
        "q14_merge_state": merge_state,
        "q15_sssp_costs": lambda s, d: sssp(s, d, with_path=False).select("id", "hops"),
        "q16_sssp_paths": sssp_paths,
        "q17_sssp_report": lambda s, d: format_paths(sssp(s, d), SOURCE_VERTEX),
        "q18_sssp_levels": lambda s, d: op.hops_histogram(sssp(s, d, with_path=False)),
        "q19_entity_in_list": lambda s, d: balls(s, d).select(*ntz("ts"), "seq", "entity", "x", "y"),
        "q20_zone_flags": lambda s, d: op.zone_flags(roles.positions(s, d), ZONES).select("seq", "in_A", "in_B"),
        "q21_zone_exits_interleaved": lambda s, d: zone_exits(s, d, "interleaved"),
        "q22_zone_exits_per_entity": lambda s, d: zone_exits(s, d, "per_entity"),
        "q23_zone_exits_total": zone_exits_total,
        "q24_step_distances": step_distances,
        "q25_avg_step_sliding": lambda s, d: rounded_windows(windows(s, d)),
        "q26_running_best": running_best,
        "q27_best_window": lambda s, d: rounded_windows(op.best_window(windows(s, d))),
        "q28_best_since": lambda s, d: running_best(s, d, "2024-01-15"),
        "q29_stream_zone_exits": streamed_zone_exits,
        "q30_stream_avg_step": streamed_avg_step,
        "q31_pico_event_time": pico_event_time,
        "q32_pipe_table_roundtrip": pipe_table_roundtrip,
        "q33_edge_list_roundtrip": edge_list_roundtrip,
        "q34_positions_roundtrip": positions_roundtrip,
        "q35_tagged_files": tagged_files,
        "q36_paths_report_file": paths_report,
        "q37_file_stream_exits_csv": file_stream_exits,
        "q38_live_best_window": live_best,
        "q39_live_running_best": live_bests,
        "q40_late_rows": late_rows,
        "q41_stream_account": stream_account,
        "q42_closed_zone_exits": closed_exits,
        "q43_closed_avg_step": closed_steps,
        "q44_zone_table_exits": zone_table_exits,
        "q45_text_order_rank": order_ranks,
    }
