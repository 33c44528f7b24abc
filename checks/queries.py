"""The registered queries: each runs an operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as V
from tallyshelf.columns import ACCOUNT, INVENTORY_REPORT, ORDERS_REPORT, SUMMARY_HEADERS
from tallyshelf.functions.dates import iso_utc
from tallyshelf.operators.chunks import merge_chunks, union_chunks
from tallyshelf.operators.clean import clean_orders, clean_stock, quarantine
from tallyshelf.operators.coverage import cover_accounts
from tallyshelf.operators.ranking import block_starts, rank_rows, sort_into_blocks
from tallyshelf.operators.report_log import latest_ready, resolve_reports
from tallyshelf.operators.requests import in_window, line_accounting, preset_requests, resolve_windows, split_windows
from tallyshelf.operators.sku_sales import paid_orders, sales_by_sku, sku_rollup, sold_units
from tallyshelf.operators.stock import SNAPSHOT, stock_per_sku, with_stock
from tallyshelf.plans.daily_job import run_daily_job
from tallyshelf.plans.line_store import ingest, read_report, run_stored_job, stored_report
from tallyshelf.plans.on_hand import on_hand_index, on_hand_report
from tallyshelf.plans.presentation import ON_HAND_BARS, sales_display, with_bars
from tallyshelf.plans.sales_report import SalesReport, gates, sales_report
from tallyshelf.scratch import Scratch
from tallyshelf.session import configure
from tallyshelf.sinks.published import read_runs, runs_in_force
from tallyshelf.sinks.tables import write_partitions, write_raw_data, write_summary
from tallyshelf.sources.accounts import account_list, landing_folder, scan_report
from tallyshelf.sources.flat_files import scan_flat_files, write_flat_files
from tallyshelf.sources.log_payloads import parse_log
from tallyshelf.sources.stored import ARRAY_FOLDERS, records_from_text, scan_records, scan_stored, write_arrays, write_records

BY = (ACCOUNT,)
WINDOW_BY = (ACCOUNT, "start_utc", "end_utc")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and instants as text, so that both engines compare equal values."""
    def cast(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return iso_utc(c).alias(f.name)
        if isinstance(f.dataType, T.IntegerType):
            return c.cast("bigint").alias(f.name)
        return c

    return df.select(*[cast(f) for f in df.schema.fields])


def _report(spark: SparkSession, sf: str) -> SalesReport:
    return sales_report(V.orders_view(spark, sf), V.inventory_view(spark, sf))


def q_sales_report(spark, sf):
    return _report(spark, sf).summary


def q_report_index(spark, sf):
    return _report(spark, sf).index


def q_raw_data(spark, sf):
    return _report(spark, sf).raw_data


def _windowed(spark, sf) -> DataFrame:
    windows = split_windows(V.whole_range_requests(spark, sf), V.AS_OF).select(*WINDOW_BY)
    return in_window(V.orders_view(spark, sf), windows)


def q_sales_report_by_window(spark, sf):
    return sales_report(_windowed(spark, sf), V.inventory_view(spark, sf), WINDOW_BY).summary


def q_report_index_by_window(spark, sf):
    return sales_report(_windowed(spark, sf), V.inventory_view(spark, sf), WINDOW_BY).index


def q_window_filter(spark, sf):
    return _windowed(spark, sf).groupBy(*WINDOW_BY).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("item_price").cast("decimal(18,4)")).alias("price")
    )


def q_sales_by_sku(spark, sf):
    return sales_by_sku(clean_orders(paid_orders(V.orders_view(spark, sf))), BY)


def q_units_by_sku(spark, sf):
    return sold_units(clean_orders(V.orders_view(spark, sf)), BY)


def q_sku_rollup(spark, sf):
    return sku_rollup(clean_orders(V.orders_view(spark, sf)), BY)


def q_sales_with_stock(spark, sf):
    sales = sales_by_sku(clean_orders(V.orders_view(spark, sf)), BY)
    return with_stock(sales, stock_per_sku(clean_stock(V.inventory_view(spark, sf)), BY), BY)


def q_sales_totals(spark, sf):
    return _report(spark, sf).totals


def q_sales_report_repeated_stock(spark, sf):
    return sales_report(V.orders_view(spark, sf), V.repeated_inventory_view(spark, sf)).summary


def q_sales_report_hot_stock(spark, sf):
    """A third of the stock and more is one SKU of an account, each row another."""
    return sales_report(V.orders_view(spark, sf), V.hot_inventory_view(spark, sf)).summary


def q_sales_report_summed_stock(spark, sf):
    return sales_report(V.orders_view(spark, sf), V.repeated_inventory_view(spark, sf), inventory_policy="sum_per_sku").summary


def q_sales_report_small_accounts(spark, sf):
    return sales_report(V.small_accounts_view(spark, sf), V.inventory_view(spark, sf).drop(ACCOUNT)).summary


def q_zero_sales_gate(spark, sf):
    return gates(sku_rollup(clean_orders(V.small_accounts_view(spark, sf)), BY), BY)


def q_account_coverage(spark, sf):
    asked = V.table(spark, sf, "orders").select(F.concat(F.lit("ord-"), F.col("o_orderkey")).alias(ACCOUNT))
    index = gates(sku_rollup(clean_orders(V.small_accounts_view(spark, sf)), BY), BY)
    return cover_accounts(account_list(spark, asked), index).select(ACCOUNT, "status")


def q_account_dimension(spark, sf):
    return account_list(spark, V.table(spark, sf, "customer").select(F.col("c_mktsegment").alias(ACCOUNT)))


def q_on_hand_report(spark, sf):
    return on_hand_report(V.orders_view(spark, sf), V.inventory_view(spark, sf))


def q_on_hand_repeated_stock(spark, sf):
    return on_hand_report(V.orders_view(spark, sf), V.repeated_inventory_view(spark, sf))


def q_on_hand_hot_stock(spark, sf):
    return on_hand_report(V.orders_view(spark, sf), V.hot_inventory_view(spark, sf))


def q_on_hand_index(spark, sf):
    orders = V.table(spark, sf, "orders").select(F.concat(F.lit("c-"), F.col("o_custkey")).alias(ACCOUNT), "o_orderdate")
    return on_hand_index(orders.groupBy(ACCOUNT).agg(F.max("o_orderdate").alias("last")), F.col("last"))


def q_clean_orders(spark, sf):
    return clean_orders(V.dirty_orders_view(spark, sf))


def q_quarantine(spark, sf):
    return quarantine(V.dirty_orders_view(spark, sf)).withColumn("reasons", F.concat_ws(",", "reasons"))


def q_dirty_sales_report(spark, sf):
    return sales_report(V.dirty_orders_view(spark, sf), V.inventory_view(spark, sf)).summary


def q_dirty_report_index(spark, sf):
    return sales_report(V.dirty_orders_view(spark, sf), V.inventory_view(spark, sf)).index


def _chunks(spark, sf) -> Sequence[DataFrame]:
    """Three overlapping chunks; the last has other columns in another order."""
    orders = V.orders_view(spark, sf).withColumn("order_id", F.col("order_id").cast("string"))
    paid = orders.filter(F.col("item-price") > 0)
    return orders, paid, paid.select("quantity", "sku", ACCOUNT, F.lit("late").alias("note"))


def q_chunk_union(spark, sf):
    return union_chunks(_chunks(spark, sf))


def q_dedup_chunks(spark, sf):
    return merge_chunks(_chunks(spark, sf))


def q_window_validate(spark, sf):
    return resolve_windows(V.request_view(spark, sf), V.AS_OF_INSIDE)


def q_window_split(spark, sf):
    return split_windows(V.request_view(spark, sf), V.AS_OF)


def q_preset_ranges(spark, sf):
    customers = V.table(spark, sf, "customer").select(F.col("c_name").alias(ACCOUNT))
    return preset_requests(customers, V.AS_OF)


def q_latest_ready_report(spark, sf):
    return latest_ready(V.log_view(spark, sf))


def q_resolve_report(spark, sf):
    return resolve_reports(V.log_view(spark, sf))


def q_report_log_json(spark, sf):
    return parse_log(V.payload_view(spark, sf), "body")


def q_bars(spark, sf):
    return with_bars(q_sales_report(spark, sf))


def q_on_hand_bars(spark, sf):
    return with_bars(q_on_hand_report(spark, sf), ON_HAND_BARS)


def q_display(spark, sf):
    return sales_display(q_sales_report(spark, sf))


def _text(df: DataFrame) -> DataFrame:
    """Cells as the files hold them."""
    money = {n: F.col(f"`{n}`").cast("decimal(18,2)").cast("string") for n in ("item-price", "quantity") if n in df.columns}
    return df.withColumns(money).select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def _land_orders(spark, sf, scratch: Scratch) -> str:
    """Orders as gzipped flat files, returned lines in files with the columns turned round."""
    landing = scratch.path("landing")
    orders = _text(V.orders_view(spark, sf))
    free = F.col("item-price") == "0.00"
    folder = landing_folder(landing)
    write_flat_files(orders.filter(~free), f"{folder}/paid", (ACCOUNT,), "gzip")
    write_flat_files(orders.filter(free).select(*reversed(orders.columns)), f"{folder}/free", (ACCOUNT,))
    return landing


def q_flat_file_scan(spark, sf):
    scratch = Scratch(spark)
    folder = landing_folder(_land_orders(spark, sf, scratch))
    chunks = [scan_flat_files(spark, f"{folder}/{part}", partitions=BY).rows for part in ("paid", "free")]
    return clean_orders(union_chunks(chunks))


def q_mixed_header_scan(spark, sf):
    """One folder whose files list their columns in two orders, plain and gzipped; one kind lacks a column."""
    path, orders = Scratch(spark).path("mixed"), _text(V.orders_view(spark, sf))
    free = F.col("item-price") == "0.00"
    write_flat_files(orders.filter(~free), f"{path}/paid", (), "gzip")
    write_flat_files(orders.filter(free).select(*[c for c in reversed(orders.columns) if c != "order_id"]), f"{path}/free")
    return clean_orders(scan_flat_files(spark, path).rows)


def q_csv_scan(spark, sf):
    path = Scratch(spark).path("csv")
    _text(V.inventory_view(spark, sf)).write.options(header=True).csv(path)
    return scan_stored(spark, path, "csv")


def q_tsv_scan(spark, sf):
    """Two folders of one table, the second with its columns turned round."""
    path, stock = Scratch(spark).path("tsv"), _text(V.inventory_view(spark, sf))
    sold_out = F.col("afn-fulfillable-quantity") == "0"
    for part, rows in (("full", stock.filter(~sold_out)), ("empty", stock.filter(sold_out).select(*reversed(stock.columns)))):
        rows.write.options(header=True, sep="\t", compression="gzip").csv(f"{path}/{part}")
    return scan_stored(spark, path, "tsv")


# Documented parameter: rows of an account that one landed array holds at most.
ARRAY_ROWS = 8192


def q_json_array_scan(spark, sf):
    """Files that each hold an array of an account's stock rows; a large account has several."""
    path, stock = Scratch(spark).path("arrays"), V.inventory_view(spark, sf)
    write_arrays(stock, path, BY, ARRAY_ROWS)
    return scan_records(spark, path, stock.columns).drop(*ARRAY_FOLDERS)


def q_empty_stock_report(spark, sf):
    """Sales of all accounts, none of which has a stock row."""
    return sales_report(V.orders_view(spark, sf), V.inventory_view(spark, sf).filter("false")).summary


def q_raw_data_small_accounts(spark, sf):
    """Raw lines of the accounts whose report is OK, among many whose isn't."""
    report = sales_report(V.small_accounts_view(spark, sf), V.inventory_view(spark, sf).drop(ACCOUNT))
    return report.raw_data.select(ACCOUNT, "sku", "product_name", "item_price", "quantity", "purchase_date_fmt")


def q_txt_scan(spark, sf):
    path = Scratch(spark).path("txt")
    V.table(spark, sf, "conversations").select(F.regexp_replace("text", r"[\r\n]+", " ").alias("value")).write.text(path)
    return scan_stored(spark, path, "txt").groupBy("value").agg(F.count(F.lit(1)).alias("lines"))


def q_json_records(spark, sf):
    path = Scratch(spark).path("json")
    stock = V.inventory_view(spark, sf).withColumn("asin", F.when(F.col("afn-fulfillable-quantity") > 0, F.col("asin")))
    write_records(stock, path)
    return scan_records(spark, path, stock.columns, lines=True)


def q_json_chunks(spark, sf):
    """Each stock row arrives as the text of a one-row array."""
    stock = V.inventory_view(spark, sf)
    cells = F.array(F.struct(*[F.col(f"`{c}`") for c in stock.columns if c != ACCOUNT]))
    chunks = stock.select(ACCOUNT, F.to_json(cells).alias("chunk"))
    return records_from_text(chunks, "chunk", [c for c in stock.columns if c != ACCOUNT], keep=BY)


def q_roundtrip_sink(spark, sf):
    """Written for all accounts, then again for some of them: the others stay."""
    path = Scratch(spark).path("sink")
    stock = V.inventory_view(spark, sf).withColumn("run", F.lit(1))
    write_partitions(stock, path)
    write_partitions(stock.filter(F.col(ACCOUNT) < "F").withColumn("run", F.lit(2)), path)
    return spark.read.parquet(path).withColumn(ACCOUNT, F.col(ACCOUNT).cast("string"))


def q_two_output_report(spark, sf):
    base = Scratch(spark).path("report")
    report = _report(spark, sf)
    write_summary(report.summary, base)
    write_raw_data(report.raw_data, base)
    raw = spark.read.parquet(f"{base}/raw_data").groupBy(ACCOUNT).agg(
        F.count(F.lit(1)).alias("raw_lines"), F.sum(F.col("item-price").cast("decimal(18,4)")).alias("raw_price"))
    top = spark.read.parquet(f"{base}/summary").filter("is_total").select(
        ACCOUNT, F.col("`units sold`").alias("units_sold"), "revenue")
    return raw.join(top, ACCOUNT)


def q_daily_job(spark, sf):
    """Files in, report tables out: the written summary of the whole range, in windows."""
    scratch = Scratch(spark)
    landing, out = scratch.path("landing"), scratch.path("out")
    write_flat_files(_text(V.orders_view(spark, sf)), landing_folder(landing, ORDERS_REPORT), BY, "gzip", gather=False)
    write_flat_files(_text(V.inventory_view(spark, sf)), landing_folder(landing, INVENTORY_REPORT), BY)
    run_daily_job(spark, landing, V.whole_range_requests(spark, sf), V.AS_OF, out)
    index = spark.read.parquet(f"{out}/report_index")
    return index.select(*WINDOW_BY, "units_sold", "revenue", "report_name", "status")


def q_dirty_window_filter(spark, sf):
    """Lines with offsets, unreadable instants and dates, by window."""
    windows = split_windows(V.whole_range_requests(spark, sf), V.AS_OF).select(*WINDOW_BY)
    return in_window(V.odd_orders_view(spark, sf), windows).groupBy(*WINDOW_BY, "line").agg(F.count(F.lit(1)).alias("lines"))


def q_line_accounting(spark, sf):
    """Every landed line is in a window, outside all, or without a day."""
    windows = split_windows(V.half_range_requests(spark, sf), V.AS_OF).select(*WINDOW_BY)
    return line_accounting(V.odd_orders_view(spark, sf), windows)


def q_fine_prices(spark, sf):
    """Exact sums of very fine and very large prices, as text."""
    sales = sales_by_sku(clean_orders(V.odd_orders_view(spark, sf)), BY)
    return sales.withColumns({"revenue": F.col("revenue").cast("string"), "units_sold": F.col("units_sold").cast("double")})


def q_fine_quarantine(spark, sf):
    """Lines with prices finer than amounts hold, or without a day."""
    return quarantine(V.odd_orders_view(spark, sf)).select(
        ACCOUNT, "order_id", "line", "purchase_date", "item_price", F.concat_ws(",", "reasons").alias("reasons"))


# When the two stock snapshots were taken.
SNAPSHOTS = ("2001-06-01T00:00:00", "2001-07-01T00:00:00")


def q_job_latest_snapshot(spark, sf):
    """The summary the job writes from two stock snapshots, for requests that spell accounts in lower case."""
    scratch = Scratch(spark)
    landing, out = scratch.path("landing"), scratch.path("out")
    write_flat_files(_text(V.orders_view(spark, sf)), landing_folder(landing, ORDERS_REPORT), BY, "gzip", gather=False)
    stock, quantity = V.inventory_view(spark, sf), "afn-fulfillable-quantity"
    taken = [stock.withColumn(quantity, F.col(quantity) + more).withColumn(SNAPSHOT, F.lit(at)) for more, at in zip((5, 0), SNAPSHOTS)]
    write_flat_files(_text(taken[0].unionByName(taken[1])), landing_folder(landing, INVENTORY_REPORT), (ACCOUNT, SNAPSHOT))
    requests = V.whole_range_requests(spark, sf).withColumn(ACCOUNT, F.lower(ACCOUNT))
    run_daily_job(spark, landing, requests, V.AS_OF, out)
    rows = spark.read.parquet(f"{out}/summary")
    return rows.withColumnsRenamed({h: i for i, h in SUMMARY_HEADERS.items()})


def q_rerun_job(spark, sf):
    """Run for all accounts, then again for some, whose lines are all free by now: counts of what is written."""
    scratch = Scratch(spark)
    landing, out = scratch.path("landing"), scratch.path("out")
    orders, requests = scratch.table(_text(V.orders_view(spark, sf)), "orders"), V.whole_range_requests(spark, sf)
    some = F.col(ACCOUNT) < "F"
    write_flat_files(orders, landing_folder(landing, ORDERS_REPORT), BY, "gzip", gather=False)
    write_flat_files(_text(V.inventory_view(spark, sf)), landing_folder(landing, INVENTORY_REPORT), BY)
    run_daily_job(spark, landing, requests, V.AS_OF, out)
    again = {ORDERS_REPORT: scratch.path("again"), INVENTORY_REPORT: landing_folder(landing, INVENTORY_REPORT)}
    write_flat_files(orders.filter(some).withColumn("item-price", F.lit("0.00")), again[ORDERS_REPORT], BY, "gzip", gather=False)
    run_daily_job(spark, again, requests.filter(some), V.AS_OF, out)

    def counted(name, what):
        rows = spark.read.parquet(f"{out}/{name}")
        return rows.groupBy(F.lit(name).alias("output"), ACCOUNT, what.alias("what")).agg(F.count(F.lit(1)).alias("n_rows"))

    nothing = F.lit("")
    parts = [counted("summary", nothing), counted("raw_data", nothing), counted("report_index", F.col("status")),
             counted("quarantine", nothing), counted("rejected_lines", nothing), counted("refused_requests", nothing)]
    return union_chunks(parts)


def q_report_type_dispatch(spark, sf):
    """Lines landed under each report type, the unnamed one being orders."""
    scratch = Scratch(spark)
    landing = scratch.path("landing")
    write_flat_files(_text(V.orders_view(spark, sf)), landing_folder(landing), BY)
    write_flat_files(_text(V.inventory_view(spark, sf)), landing_folder(landing, INVENTORY_REPORT), BY)
    counted = [
        scan_report(spark, landing, kind).rows.groupBy(F.lit(kind or "default").alias("kind"), ACCOUNT).agg(
            F.count(F.lit(1)).alias("lines"))
        for kind in (None, ORDERS_REPORT, INVENTORY_REPORT)
    ]
    return union_chunks(counted)


def q_job_resolved_report(spark, sf):
    """The index of a job whose log resolves to some of the landed reports, and what became of the requests."""
    scratch = Scratch(spark)
    landing, out = scratch.path("landing"), scratch.path("out")
    orders, stock, quantity = V.orders_view(spark, sf), V.inventory_view(spark, sf), "afn-fulfillable-quantity"
    by = (ACCOUNT, "report_id")
    orders = orders.withColumn("report_id", F.concat(F.lit("R"), F.substring("purchase-date", 1, 4)))
    write_flat_files(_text(orders), landing_folder(landing, ORDERS_REPORT), by, "gzip")
    snapshots = [stock.withColumn(quantity, F.col(quantity) + more).withColumn("report_id", F.lit(name)) for name, more in (("I1", 5), ("I2", 0))]
    write_flat_files(_text(snapshots[0].unionByName(snapshots[1])), landing_folder(landing, INVENTORY_REPORT), by)
    run_daily_job(spark, landing, V.whole_range_requests(spark, sf), V.AS_OF, out, log=V.report_log_view(spark, sf))
    bound = spark.read.parquet(f"{out}/report_bindings").groupBy(ACCOUNT).agg(
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "report_id", "binding", "resolved_report_id"))), " ").alias("bindings"))
    stocked = spark.read.parquet(f"{out}/on_hand").groupBy(ACCOUNT).agg(F.sum("on-hand").alias("on_hand"))
    totals = spark.read.parquet(f"{out}/report_index").groupBy(ACCOUNT).agg(
        F.sum(F.col("revenue").cast("decimal(18,4)")).alias("revenue"), F.count(F.when(F.col("status") == "OK", 1)).alias("reports"))
    return totals.join(bound, ACCOUNT).join(stocked, ACCOUNT)


def _landings(spark, sf, untils: Sequence[str | None], stock: bool = True) -> Iterator[dict[str, str]]:
    """The order lines before each of some days, or all lines, in files of other names each time; a landing goes when the next one is asked for."""
    joined, kept = Scratch(spark), Scratch(spark)
    orders, more = joined.table(_text(V.orders_view(spark, sf)), "orders"), {}
    if stock:
        more = {INVENTORY_REPORT: kept.path("stock")}
        write_flat_files(_text(V.inventory_view(spark, sf)), more[INVENTORY_REPORT], BY)
    for i, until in enumerate(untils, 1):
        landed = Scratch(spark)
        folder = landed.path("landing")
        lines = orders if until is None else orders.filter(F.col("purchase-date") < until)
        write_flat_files(lines, folder, BY, "gzip", gather=False)
        if i == len(untils):
            joined.clear()
        yield {ORDERS_REPORT: folder, **more}
        landed.clear()


def q_incremental_job(spark, sf):
    """The index after two landings in one store, as the job that reads everything makes it."""
    scratch, requests = Scratch(spark), V.whole_range_requests(spark, sf)
    folder, out = scratch.path("store"), scratch.path("out")
    landings = _landings(spark, sf, ("1998", None))
    ingest(spark, next(landings), folder)
    run_stored_job(spark, next(landings), requests, V.AS_OF, folder, out, raw_data=False)
    return read_report(spark, out, "report_index").select(*WINDOW_BY, "units_sold", "revenue", "report_name", "status")


def q_incremental_summary(spark, sf):
    """The summary of windows that cut days, from kept day sums and the lines of cut days."""
    folder = Scratch(spark).path("store")
    for landing in _landings(spark, sf, ("1998", None)):
        store = ingest(spark, landing, folder)
    return stored_report(store, V.cut_windows(spark, sf), V.inventory_view(spark, sf), "as_is", Scratch(spark)).summary


def q_known_lines(spark, sf):
    """Lines that each of three landings added to a store: the first three years, all years, and all again under other names."""
    folder = Scratch(spark).path("store")
    for landing in _landings(spark, sf, ("1998", "2100", "2100"), stock=False):
        ingest(spark, landing, folder)
    runs = read_runs(spark, folder, "lines", runs_in_force(spark, folder))
    return runs.groupBy(F.substring("run", 1, 8).cast("bigint").alias("landing"), ACCOUNT).agg(F.count(F.lit(1)).alias("lines"))


def q_ranked_lines(spark, sf):
    """Positions of all order lines of an account by price, equal lines counted and written out again."""
    lines = clean_orders(V.orders_view(spark, sf)).groupBy(ACCOUNT, "item_price").agg(F.count(F.lit(1)).alias("copies"))
    ordered = sort_into_blocks(lines, BY, [F.col("item_price").desc()], Scratch(spark))
    return rank_rows(ordered, block_starts(ordered, BY), BY)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(run):
        return lambda spark, sf_dir: plain(run(configure(spark), sf_dir))

    return {name[2:]: bind(run) for name, run in globals().items() if name.startswith("q_")}
