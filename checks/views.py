"""Order, stock, request and log tables in the shape of seller reports, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.columns import ACCOUNT, INVENTORY_REPORT, ORDERS_REPORT

# The market segments, used as accounts.
ACCOUNTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

# Fixed value: a run time after the last order.
AS_OF = "2002-01-01T00:00:00"
# Fixed value: a run time inside the data, so that later requests are in the future.
AS_OF_INSIDE = "2000-01-01T00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders meet their customers first, so that lines are moved for two joins, not three; the last one is by part, so that sums by SKU
    combine where it leaves them."""
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "part", "customer")}
    orders = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
    return t["lineitem"].join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t["part"], F.col("l_partkey") == F.col("p_partkey"))


def _day(c: str) -> Column:
    return F.col(c).cast("date").cast("string")


def _price() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_extendedprice"))


def orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of five accounts; returned lines have no price."""
    return _lines(spark, sf_dir).select(
        F.col("c_mktsegment").alias(ACCOUNT),
        F.col("l_orderkey").alias("order_id"),
        F.concat(F.lit("SKU-"), F.col("l_partkey")).alias("sku"),
        F.col("p_name").alias("product-name"),
        F.concat(_day("o_orderdate"), F.lit("T00:00:00+00:00")).alias("purchase-date"),
        _price().alias("item-price"),
        F.col("l_quantity").alias("quantity"),
    )


def small_accounts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account per order; A lines are refunds, R lines are free. Many accounts fail a gate."""
    price = (
        F.when(F.col("l_returnflag") == "R", F.lit(0.0))
        .when(F.col("l_returnflag") == "A", -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice"))
    )
    return _lines(spark, sf_dir).select(
        F.concat(F.lit("ord-"), F.col("l_orderkey")).alias(ACCOUNT),
        F.concat(F.lit("SKU-"), F.col("l_partkey")).alias("sku"),
        F.col("p_name").alias("product-name"),
        F.concat(_day("l_shipdate"), F.lit("T00:00:00+00:00")).alias("purchase-date"),
        price.alias("item-price"),
        F.col("l_quantity").alias("quantity"),
    )


def dirty_orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines as text, with what goes wrong in files chosen by line number."""
    line = F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    count = F.col("l_quantity").cast("int").cast("string")
    day = _day("o_orderdate")
    return _lines(spark, sf_dir).select(
        F.col("c_mktsegment").alias(ACCOUNT),
        F.col("l_orderkey").alias("order_id"),
        line.alias("line"),
        F.when(line == 7, F.lit("None")).otherwise(F.concat(F.lit("00"), F.col("l_partkey"))).alias("sku"),
        F.when(line == 5, F.lit("")).otherwise(F.col("p_name")).alias("product-name"),
        F.when(line == 1, F.concat(day, F.lit("T23:59:00-08:00")))
        .when(line == 2, F.lit("junk"))
        .when(line == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(day, F.lit("T07:59:00+00:00"))).alias("purchase-date"),
        F.when(line == 1, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(line == 2, F.lit("abc"))
        .when(line == 3, F.lit("nan"))
        .when(line == 4, F.lit(None).cast("string"))
        .when(line == 5, F.lit("1,234"))
        .when(line == 6, F.lit("1e3"))
        .otherwise(price).alias("item-price"),
        F.when(line == 1, F.lit("5d"))
        .when(line == 2, F.concat(F.lit("-"), count))
        .when(line == 3, F.lit(".5"))
        .when(line == 4, F.lit(""))
        .when(line == 6, F.lit("1e5d"))
        .otherwise(count).alias("quantity"),
    )


def odd_orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines as text, with offsets, unreadable instants and dates, and very fine and very large prices."""
    line = F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    day = _day("o_orderdate")
    return _lines(spark, sf_dir).select(
        F.col("c_mktsegment").alias(ACCOUNT), F.col("l_orderkey").alias("order_id"), line.alias("line"),
        F.concat(F.lit("SKU-"), F.col("l_partkey")).alias("sku"), F.col("p_name").alias("product-name"),
        F.when(line == 1, F.concat(day, F.lit("T23:30:00-08:00")))
        .when(line == 2, F.concat(day, F.lit("T99:00")))
        .when(line == 3, F.lit("junk"))
        .when(line == 4, F.lit(None).cast("string"))
        .when(line == 5, F.concat(day, F.lit("Tx")))
        .otherwise(F.concat(day, F.lit("T00:30:00+09:00"))).alias("purchase-date"),
        F.when(line == 1, F.lit("0.00001"))
        .when(line == 2, F.concat(price, F.lit("9999999")))
        .when(line == 3, F.lit("123456789012345.25"))
        .when(line == 4, F.lit("0.000000001"))
        .when(line == 5, F.lit("-0.00001"))
        .when(line == 6, F.lit("1e-5"))
        .otherwise(price).alias("item-price"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
    )


def half_range_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per account over the first half of its orders' days."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    first, last = F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")
    ranges = orders.groupBy(F.col("c_mktsegment").alias(ACCOUNT)).agg(first.alias("first"), last.alias("last"))
    middle = F.expr("date_add(first, cast(datediff(last, first) div 2 as int))")
    return ranges.select(ACCOUNT, F.date_format("first", "MM-dd-yyyy").alias("start_date"), F.date_format(middle, "MM-dd-yyyy").alias("end_date"))


def inventory_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock of every account; promotional products are not stocked, small ones are sold out."""
    account = F.explode(F.array(*[F.lit(a) for a in ACCOUNTS])).alias(ACCOUNT)
    listed = table(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO").select("p_partkey", "p_name", "p_size", account)
    return listed.select(
        ACCOUNT,
        F.concat(F.lit("SKU-"), F.col("p_partkey")).alias("sku"),
        F.concat(F.lit("B"), F.col("p_partkey")).alias("asin"),
        F.col("p_name").alias("product-name"),
        F.when(F.col("p_size") < 10, 0).otherwise(F.col("p_size") + F.length(ACCOUNT)).alias("afn-fulfillable-quantity"),
    )


def hot_inventory_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock, and under one SKU of each account a row of its own for each of the account's order lines."""
    part = table(spark, sf_dir, "part").agg(F.min("p_partkey").alias("hot"))
    lines = _lines(spark, sf_dir).select(F.col("c_mktsegment").alias(ACCOUNT), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("units"))
    hot = part.first()["hot"]
    rows = lines.select(
        ACCOUNT, F.lit(f"SKU-{hot}").alias("sku"), F.lit(f"B{hot}").alias("asin"), F.lit("hot").alias("product-name"),
        F.col("units").alias("afn-fulfillable-quantity"),
    )
    return inventory_view(spark, sf_dir).unionByName(rows)


def repeated_inventory_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock, all of it listed twice with equal rows and once more with one unit added."""
    stock = inventory_view(spark, sf_dir)
    more = stock.withColumn("afn-fulfillable-quantity", F.col("afn-fulfillable-quantity") + 1)
    return stock.unionByName(stock).unionByName(more)


def log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report-request log: one request per event."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user-"), F.col("user_id")).alias(ACCOUNT),
        F.col("event_id").cast("string").alias("report_id"),
        F.when(F.col("value") < 25, F.lit(INVENTORY_REPORT)).otherwise(F.lit(ORDERS_REPORT)).alias("report_type"),
        F.when(F.col("event_type") == "purchase", F.lit("DONE"))
        .when(F.col("event_type") == "error", F.lit("FATAL"))
        .when(F.col("event_type") == "signup", F.lit("CANCELLED"))
        .otherwise(F.lit("IN_PROGRESS")).alias("processing_status"),
        F.when(F.col("value") > 50, F.lit("unknown"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("processing_end_time"),
    )


def payload_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as payloads: each holds the request itself and one with its fields left out."""
    named = F.struct(
        F.col("report_id").alias("reportId"), F.col("report_type").alias("reportType"),
        F.col("processing_status").alias("processingStatus"), F.col("processing_end_time").alias("processingEndTime"),
    )
    bare = F.struct(
        F.concat("report_id", F.lit("-next")).alias("reportId"), F.lit(None).cast("string").alias("reportType"),
        F.lit(None).cast("string").alias("processingStatus"), F.lit(None).cast("string").alias("processingEndTime"),
    )
    body = F.to_json(F.struct(F.array(named, bare).alias("reports"), F.lit("page-2").alias("nextToken")))
    return log_view(spark, sf_dir).select(ACCOUNT, body.alias("body"))


def request_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per order line, from order day to shipping day, dates written in three ways or left out."""
    sep = F.when(F.col("l_returnflag") == "R", F.lit("/")).when(F.col("l_returnflag") == "A", F.lit(".")).otherwise(F.lit("-"))

    def written(c: str) -> Column:
        return F.concat_ws("", F.month(c), sep, F.dayofmonth(c), sep, F.year(c))

    joined = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.when(F.col("l_linenumber") == 6, F.lit("")).otherwise(F.concat(F.lit("c-"), F.col("o_custkey"))).alias(ACCOUNT),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string"))
        .when(F.col("l_linenumber") == 5, F.lit("13-13-2000"))
        .otherwise(written("o_orderdate")).alias("start_date"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
        .when(F.col("l_linenumber") == 4, written("o_orderdate"))
        .otherwise(written("l_shipdate")).alias("end_date"),
    )


def whole_range_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per account over all its orders."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return orders.groupBy(F.col("c_mktsegment").alias(ACCOUNT)).agg(
        F.date_format(F.min("o_orderdate"), "MM-dd-yyyy").alias("start_date"),
        F.date_format(F.date_add(F.max("o_orderdate").cast("date"), 1), "MM/dd/yyyy").alias("end_date"),
    )


# When the first of the windows that cut days begins, their hours and number.
CUT_START, CUT_HOURS, CUTS = "1992-01-01T06:00:00", 1000, 70


def cut_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive windows of 1,000 hours for each account, whose bounds are no midnights."""
    start = F.lit(CUT_START).cast("timestamp")
    accounts = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias(ACCOUNT)).distinct()
    hours = F.make_dt_interval(hours=F.lit(CUT_HOURS) * F.col("n"))
    rows = accounts.select(ACCOUNT, F.explode(F.sequence(F.lit(0), F.lit(CUTS - 1))).alias("n")).withColumn("start_utc", start + hours)
    return rows.select(ACCOUNT, "start_utc", (F.col("start_utc") + F.make_dt_interval(hours=F.lit(CUT_HOURS))).alias("end_utc"))


# The reports of the order years, by what became of them; the last one's files never landed.
YEAR_STATUS = {1995: "DONE", 1996: "FATAL", 1997: "DONE", 1998: "CANCELLED", 1999: "DONE", 2000: "IN_PROGRESS", 2001: "DONE", 2002: "DONE"}


def report_log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each account an order report per year and three stock reports: two ready, and a later one that failed."""
    accounts = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias(ACCOUNT)).distinct()
    rows = [(f"R{y}", ORDERS_REPORT, status, f"2002-01-{y - 1990:02}T00:00:00Z") for y, status in YEAR_STATUS.items()]
    rows += [("I1", INVENTORY_REPORT, "DONE", "2002-01-01T00:00:00Z"), ("I2", INVENTORY_REPORT, "DONE", "2002-01-02T00:00:00Z"), ("I3", INVENTORY_REPORT, "FATAL", None)]
    names = ("report_id", "report_type", "processing_status", "processing_end_time")
    entries = F.array(*[F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, row, strict=True)]) for row in rows])
    return accounts.select(ACCOUNT, F.inline(entries))
